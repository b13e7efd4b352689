"""Nested and flat relations."""

from conftest import rows
from pyspark.sql import functions as F

from lexmill import schemas as S
from lexmill.operators import relations as N

FLAT = (
    "source_document_id STRING, target_document_id STRING, relation_type STRING, "
    "subdivision_concerned STRING, comment STRING, whole_document BOOLEAN"
)


def acts(spark, *keys):
    null = {f.name: None for f in S.LEGAL_ACT}
    data = [({**null, "document_id": k, "language": "de", "title": f"T{k}"},) for k in keys]
    return spark.createDataFrame(data, "legal_act " + S.LEGAL_ACT.simpleString())


def relations(spark, data):
    return spark.createDataFrame(data, FLAT)


def test_single_relation(spark):
    document = [{
        "legal_act": None,
        "legal_act_relations": [{
            "source_document_id": "s", "target_document_id": "t", "relation_type": "amends",
            "concerned_sections": [{"subdivision_concerned": "§ 12", "comment": "Ersetzung"}],
        }],
    }]
    flat = N.flatten_relations(spark.createDataFrame(document, S.DOCUMENT))
    assert rows(flat) == [("s", "t", "amends", "§ 12", "Ersetzung", False)]


def test_round_trip_in_parts(spark):
    data = [("a", f"t{i}", "amends", f"§ {i}", None, False) for i in range(300)]
    data += [("a", "t1", "amends", None, None, True), ("a", "t1", "amends", "§ 2", "c", False)]
    data += [("b", "t", "repeals", None, None, True)]
    data += [("b", "t", "repeals", None, None, True)] * 2 + [("b", "u", "amends", "§ 1", None, False)] * 3
    for number in (1, 31):
        nested = N.nest_documents(acts(spark, "a", "b", "c"), relations(spark, data), number)
        assert rows(N.flatten_relations(nested)) == sorted(data, key=repr)
        grain = nested.groupBy(F.col("legal_act.document_id").alias("k"), "part").count()
        assert grain.where("count > 1").count() == 0
        assert rows(grain.where("part = 0"), "k") == [("a",), ("b",), ("c",)]
        largest = nested.agg(F.max(F.size("legal_act_relations"))).first()[0]
        assert largest < (40 if number == 31 else 302)


def test_act_and_text_tables(spark):
    documents = acts(spark, "a")
    act, text = N.split_act_text(documents)
    assert "title" not in act.columns and "document_id" in act.columns
    assert rows(text, "document_id", "language", "title") == [("a", "de", "Ta")]
