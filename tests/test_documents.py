"""Fetch outcomes, documents, lookups and snapshots."""

from conftest import rows
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill.functions.lookups import jurisdictions, map_legal_type, translation_pair
from lexmill.operators import enrich as E
from lexmill.operators import lookups as L
from lexmill.operators import pages as P
from lexmill.operators import snapshots as U
from lexmill.sources.files import parse_outcomes


def test_fetch_outcomes(spark):
    log = {
        "ok": [200], "retried": [503, 200], "down": [503, 503, 503], "gone": [404],
        "late": [503, 404], "silent": [None, None, None], "busy": [429, 200],
        "fourth": [503, 503, 503, 200], "moved": [301],
    }
    attempts = spark.createDataFrame(
        [
            (key, i, status, f"e{i}" if status != 200 else None)
            for key, statuses in log.items() for i, status in enumerate(statuses, 1)
        ],
        "document_id STRING, attempt INT, status INT, error STRING",
    )
    assert rows(P.fetch_outcome(attempts)) == [
        ("busy", "permanent", 1, "e1"), ("down", "transient", 3, "e3"),
        ("fourth", "ok", 4, None), ("gone", "permanent", 1, "e1"),
        ("late", "permanent", 2, "e2"), ("moved", "ok", 1, None), ("ok", "ok", 1, None),
        ("retried", "ok", 2, None), ("silent", "transient", 3, "e3"),
    ]


def test_fetch_outcomes_of_odd_attempts(spark):
    log = {
        "tie": [(1, 404, "b"), (1, 200, None), (1, 404, "a")], "same": [(2, 404, "b"), (2, 410, "a"), (3, 200, None)],
        "unnumbered": [(1, 200, None), (None, 404, "n")], "both": [(None, 404, "n"), (None, 301, None)],
        "waits": [(5, 503, "e5"), (None, 503, "n")], "negative": [(-1, 503, "e"), (-3, 500, "f")],
        "large": [(2**31 - 1, 200, None), (2**31 - 1, 503, "e")], "equal": [(4, None, None), (4, 500, "x"), (4, 500, "x")],
    }
    attempts = spark.createDataFrame(
        [(key, *entry) for key, entries in log.items() for entry in entries] + [(None, 1, 404, "z")],
        "document_id STRING, attempt INT, status INT, error STRING",
    )
    got = P.fetch_outcome(attempts)
    assert rows(got) == [
        ("both", "ok", None, None), ("equal", "transient", 4, None), ("large", "ok", 2**31 - 1, None),
        ("negative", "transient", -1, "e"), ("same", "permanent", 2, "a"), ("tie", "ok", 1, None),
        ("unnumbered", "permanent", None, "n"), ("waits", "transient", None, "n"), (None, "permanent", 1, "z"),
    ]
    plan = got.drop("message")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


EXTRACTED = (
    "document_id STRING, doc_type STRING, url STRING, entry_date STRING, abrogated BOOLEAN, "
    "title STRING, abbreviation STRING, enactment_date STRING, last_amendment_date STRING, "
    "publication_date STRING, text_content STRING, error_type STRING, message STRING"
)


def extracted(spark):
    def law(key, abrogated=False, title="T", text="x", error=None):
        return (key, "gesetz", "u", "2020-01-01", abrogated, title, "", None, None, None, text,
                error, "m" if error else None)

    return P.with_legal_type(spark.createDataFrame(
        [law("a"), law("b", title=""), law("c", text=""), law("d", abrogated=True),
         law("e", None, None, None, "permanent"), law("f", None, None, None, "transient")],
        EXTRACTED,
    ))


def test_outcomes(spark):
    laws = extracted(spark)
    assert rows(E.enrichable(laws), "document_id") == [("a",), ("b",)]
    text = '{{"candidates":[{{"content":{{"parts":[{{"text":"{}"}}]}}}}]}}'
    responses = spark.createDataFrame(
        [("a", text.format("s2")), ("a", text.format("s1")), ("a", "broken"), ("b", ""),
         ("zz", text.format("s"))],
        "document_id STRING, response STRING",
    )
    got = E.outcomes(E.attach_summaries(laws, responses))
    flat = got.select(
        "document_id", "kind", "reason", "message", "legal_act.title", "legal_act.title_short",
        "legal_act.summary", F.size("legal_act_relations").alias("n"),
    )
    assert rows(flat) == [
        ("a", "document", None, None, "T", None, "s1", 0),
        ("b", "document", None, None, None, None, None, 0),
        ("c", "document", None, None, "T", None, None, 0),
        ("d", "error", K.ABROGATED, "abrogated", None, None, None, None),
        ("e", "error", K.PERMANENT, "m", None, None, None, None),
        ("f", "error", K.TRANSIENT, "m", None, None, None, None),
    ]
    first = got.where("document_id = 'a'").first()["legal_act"].asDict()
    assert first == {
        "document_id": "a", "jurisdiction": "de_nw", "entity_type": "legal_act",
        "is_in_force": True, "language": "de", "url": "u", "canonical_source_url": "u",
        "fallback_text_url": None, "title": "T", "title_short": None, "abbreviation": None,
        "type": "law", "summary": "s1", "entry_into_force_date": "2020-01-01",
        "enactment_date": None, "last_amendment_date": None, "validity_date": None,
        "publication_date": None,
    }


def test_requests(spark):
    request = E.summary_requests(extracted(spark)).where("document_id = 'a'").first()["request"]
    assert request.startswith('{"system_instruction":{"parts":[{"text":"Du bist')
    assert '"contents":[{"parts":[{"text":"Titel: T\\n\\nText:\\nx"}]}]' in request
    assert request.endswith('"generationConfig":{"maxOutputTokens":2500,"temperature":0.1}}')


def test_dedup_prefers_documents_with_summary(spark):
    lines = [
        '{"legal_act":{"document_id":"a","summary":null}}',
        '{"legal_act":{"document_id":"a","summary":"s"}}',
        '{"_error":true,"documentId":"a","reason":"r"}', "broken", "broken",
    ]
    raw = spark.createDataFrame([(line,) for line in lines], "value STRING")
    got = E.dedup_outcomes(parse_outcomes(raw))
    assert rows(got, "kind", "document_id", "legal_act.summary") == [
        ("document", "a", "s"), ("parse_error", None, None), ("parse_error", None, None),
    ]
    errors = parse_outcomes(raw)
    merged = E.merge_outcomes(errors, errors.select("kind", "document_id"))
    assert merged.count() == 10


def test_legal_type(values):
    texts = ["gesetz", "rechtsverordnung", "bekanntmachung", "satzung", None]
    assert values(texts, map_legal_type) == ["law", "regulation", "announcement", "law", "law"]


def test_eli_types(spark):
    keys = ["reg", " DIR_impl ", "opin", "nope", "", None, " "]
    frame = spark.createDataFrame([(k,) for k in keys], "eli_type STRING")
    got = {r["eli_type"]: r["act_type"] for r in L.act_type_from_eli(frame).collect()}
    assert got == {
        "reg": "regulation", " DIR_impl ": "directive", "opin": "recommendation",
        "nope": "other", "": None, None: None, " ": "other",
    }


def test_languages(spark):
    keys = ["de", " BE", "ie", "fr", "norms", "", None]
    frame = spark.createDataFrame([(k, [k, "us"]) for k in keys], "jurisdiction STRING, l ARRAY<STRING>")
    columns = ["source_text_language", "content_language", "pair_source", "pair_target"]
    expected = {
        "de": ("de", "de", "de", "en"), " BE": ("fr", "de", "de", "en"),
        "ie": ("en", "en", "en", "de"), "fr": ("en", "en", "en", "de"),
        "norms": ("de", "de", "de", "en"), "": ("en", "en", "en", "de"),
        None: ("en", "en", "en", "de"),
    }
    for got in (L.jurisdiction_languages(frame), L.jurisdiction_languages(frame, "l", True)):
        found = {r["jurisdiction"]: tuple(r[c] for c in columns) for r in got.collect()}
        assert found == expected
    assert jurisdictions(spark).count() == 46 == len(set(K.JURISDICTIONS))
    policy = {row[0] for row in K.pairs(K.LANGUAGE_POLICY)}
    assert len(policy) == 30 and policy - set(K.JURISDICTIONS) == {"norms"}
    assert len(K.pairs(K.ELI_TYPES)) == 16 and len(K.ACT_TYPES) == 12


def test_translation_pair(values):
    got = values([" DE", "en", "fr", None], translation_pair)
    assert [tuple(p) for p in got] == [("de", "en")] + [("en", "de")] * 3


def test_publication_lookup(spark):
    laws = spark.createDataFrame(
        [("a", "2020-01-01", 2020, 1, None), ("b", None, 2020, 1, None), ("c", None, 2020, 9, None),
         ("d", None, None, None, None), ("e", None, 2020, None, 12), ("f", None, 2020, None, 1),
         ("g", None, 2019, None, 12)],
        "document_id STRING, publication_date STRING, issue_year INT, issue_number INT, issue_page INT",
    )
    issues = spark.createDataFrame(
        [(2020, 1, 5, 9, "2020-01-15"), (2020, 1, 5, 9, "2020-01-15"), (2020, 2, 10, 30, "2020-02-15"),
         (2020, 12, None, None, "2020-12-15")],
        "year INT, number INT, first_page INT, last_page INT, issue_date STRING",
    )
    assert rows(L.fill_publication_date(laws, issues), "document_id", "publication_date") == [
        ("a", "2020-01-01"), ("b", "2020-01-15"), ("c", None), ("d", None), ("e", "2020-02-15"),
        ("f", None), ("g", None),
    ]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "document_id STRING, v INT")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "document_id STRING, v INT")
    once = U.upsert(old, new)
    assert rows(once) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(U.upsert(once, new)) == rows(once)


def test_processed_ids(spark):
    frame = spark.createDataFrame(
        [("a", None), ("b", K.TRANSIENT), ("b", K.TRANSIENT), ("c", K.PERMANENT), (None, "x")],
        "document_id STRING, reason STRING",
    )
    assert rows(U.processed_ids(frame)) == [("a",), ("b",), ("c",)]
    assert rows(U.processed_ids(frame, retry_transient=True)) == [("a",), ("c",)]
