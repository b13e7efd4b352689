"""Contract, date and duplicate checks over documents and reports."""

import json

import pytest
from conftest import rows

from lexmill.operators import quality as Q
from lexmill.plans.validation import validate
from lexmill.sources import files

GOOD = {"document_id": "a", "jurisdiction": "de_nw", "title": "T"}
RELATION = {"source_document_id": "a", "target_document_id": "b", "relation_type": "amends"}


def doc(relations=None, **act):
    return {"legal_act": {**GOOD, **act}, "legal_act_relations": relations}


def violations(spark, *documents):
    raw = [(("f"), True, i, d if isinstance(d, str) else json.dumps(d))
           for i, d in enumerate(documents)]
    frame = spark.createDataFrame(raw, "file STRING, root_ok BOOLEAN, pos INT, raw STRING")
    checked = Q.check_documents(frame).orderBy("pos").collect()
    return [sorted(r["violations"]) for r in checked]


@pytest.mark.parametrize(
    ("document", "expected"),
    [
        (doc(), []),
        (doc([RELATION]), []),
        (doc([{**RELATION, "concerned_sections": None}]), []),
        (doc([{**RELATION, "concerned_sections": [{"subdivision_concerned": "1"}]}]), []),
        ({"legal_act": GOOD}, []),
        (doc(type=None, entity_type=None, summary=None, language="de"), []),
        (doc(is_in_force=False, type="statute", entity_type="consolidated_act"), []),
        (doc(title=5), ["legal_act.title: type"]),
        (doc(title={"a": 1}), ["legal_act.title: type"]),
        (doc(is_in_force=None), ["legal_act.is_in_force: type"]),
        (doc(is_in_force="true"), ["legal_act.is_in_force: type"]),
        (doc(jurisdiction=None), ["legal_act.jurisdiction: type"]),
        (doc(jurisdiction="norms"), ["legal_act.jurisdiction: enum"]),
        (doc(document_id=""), ["legal_act.document_id: minLength"]),
        (doc(type="Law"), ["legal_act.type: enum"]),
        (doc(entity_type="x", colour=1), ["legal_act.colour: unknown", "legal_act.entity_type: enum"]),
        ({"legal_act": {}}, ["legal_act.document_id: required", "legal_act.jurisdiction: required"]),
        ({"legal_act": None}, ["legal_act: type"]),
        ({"legal_act": [GOOD]}, ["legal_act: type"]),
        ({"x": 1, "legal_act": GOOD}, ["x: unknown"]),
        ({}, ["legal_act: required"]),
        (doc("x"), ["legal_act_relations: type"]),
        (doc([RELATION, 7]), ["legal_act_relations[1]: type"]),
        (doc([{**RELATION, "note": "n"}]), ["legal_act_relations[0].note: unknown"]),
        (doc([{**RELATION, "relation_type": None}]), ["legal_act_relations[0].relation_type: type"]),
        (
            doc([{**RELATION, "concerned_sections": [{"comment": 1, "x": 1}]}]),
            [
                "legal_act_relations[0].concerned_sections[0].comment: type",
                "legal_act_relations[0].concerned_sections[0].subdivision_concerned: required",
                "legal_act_relations[0].concerned_sections[0].x: unknown",
            ],
        ),
        ("[1]", ["document: type"]),
        ("7", ["document: type"]),
        ("null", ["document: type"]),
        ('{"legal_act":', ["document: type"]),
    ],
)
def test_contract(spark, document, expected):
    assert violations(spark, document) == [expected]


def write(folder, name, content):
    text = content if isinstance(content, str) else json.dumps(content, indent=2)
    (folder / name).write_text(text, encoding="utf-8")


def test_files(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    write(docs, "ok.json", [doc(document_id="a"), doc(document_id="b")])
    write(docs, "empty.json", [])
    write(docs, "root.json", {"legal_act": GOOD})
    write(docs, "broken.json", "[{")
    write(docs, "twice.json", [doc(enactment_date="x"), doc()])
    write(docs, "dates.json", [doc(enactment_date="2020-02-31", validity_date="x", title=None)])
    write(docs, "warn.json", [doc(title=None)])
    write(docs, "schema.json", [doc(title=1), doc(), doc(enactment_date="x")])
    reports = tmp_path / "reports"
    reports.mkdir()
    good = {key: 0 for key in Q.K.REPORT_KEYS}
    write(reports, "run_report_1.json", good)
    write(reports, "run_report_2.json", {**good, "errors": True})
    write(reports, "run_report_3.json", {k: v for k, v in good.items() if k != "mode"})
    write(reports, "run_report_4.json", {**good, "errors": "1"})
    write(reports, "run_report_example.json", {})
    write(reports, "other.json", {})

    by_file, by_report, overall = validate(
        files.read_documents(spark, str(docs)), files.read_run_reports(spark, str(reports)),
        str(tmp_path / "verdicts"),
    )
    assert rows(by_file) == [
        ("broken.json", 0, 1, 0, 0, 0, "FAIL schema"),
        ("dates.json", 1, 0, 0, 2, 1, "FAIL quality"),
        ("empty.json", 0, 0, 0, 0, 0, "OK"),
        ("ok.json", 2, 0, 0, 0, 0, "OK"),
        ("root.json", 0, 1, 0, 0, 0, "FAIL schema"),
        ("schema.json", 3, 1, 1, 1, 0, "FAIL schema"),
        ("twice.json", 2, 0, 1, 1, 0, "FAIL duplicates"),
        ("warn.json", 1, 0, 0, 0, 1, "WARN"),
    ]
    assert rows(by_report) == [
        ("run_report_1.json", [], "OK"),
        ("run_report_2.json", [], "FAIL errors type"),
        ("run_report_3.json", ["mode"], "FAIL missing keys"),
        ("run_report_4.json", [], "FAIL errors type"),
    ]
    assert rows(overall) == [(False,)]
    fine = by_file.where("verdict in ('OK', 'WARN')")
    assert rows(Q.all_passed(fine)) == [(True,)]
    checked = Q.check_documents(files.read_documents(spark, str(docs)))
    assert rows(Q.duplicate_keys(checked.where("file = 'twice.json'"))) == [("twice.json", "a", 2)]
    assert rows(Q.date_violations(checked.where("file = 'dates.json'"))) == [
        ("a", "enactment_date", "2020-02-31", "calendar"), ("a", "validity_date", "x", "format"),
    ]
    assert rows(Q.title_warnings(checked), "file") == [("dates.json",), ("warn.json",)]
    # files with schema violations are not judged further
    passing = Q.passing_files(checked)
    assert {r["file"] for r in passing.collect()} == {
        "dates.json", "empty.json", "ok.json", "twice.json", "warn.json"
    }
    assert rows(Q.date_violations(passing, "file"), "file") == [
        ("dates.json",), ("dates.json",), ("twice.json",),
    ]


def test_lines_and_arrays_agree(spark, tmp_path):
    documents = [doc(), doc(title=3), doc(title=None, enactment_date="x")]
    (tmp_path / "lines").mkdir()
    (tmp_path / "arrays").mkdir()
    write(tmp_path / "lines", "f.json", "\n".join(json.dumps(d) for d in documents))
    write(tmp_path / "arrays", "f.json", documents)
    lines = files.read_document_lines(spark, str(tmp_path / "lines"))
    arrays = files.read_documents(spark, str(tmp_path / "arrays"))
    assert rows(Q.file_verdicts(Q.check_documents(lines))) == rows(
        Q.file_verdicts(Q.check_documents(arrays))
    )
