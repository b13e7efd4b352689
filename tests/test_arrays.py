"""Array files in byte ranges against the parser of the standard library."""

import json
import random

import pytest
from conftest import rows

from lexmill.operators import quality as Q
from lexmill.sources import files

TEXTS = {
    "plain.json": '[{"a": 1}, {"b": [1, 2, {"c": "}"}]}]',
    "odd.json": ' \n[ {"q":"a,b]\\"}{[" } ,"x}y\\\\", null, 3.5 , [ ], [[{}],{}] ]\n ',
    "empty.json": "[]", "blank.json": " [ \n ] ", "object.json": '{"a":[1]}', "brace.json": '[{"a":1}',
    "open.json": '[{"a":"', "after.json": '[{"a":1}] x', "two.json": "[1][2]", "comma.json": "[1,]", "gap.json": "[1,,2]",
    "word.json": "[{a:1}]", "text.json": '"}"', "close.json": "]", "mixed.json": '[{"a":1]}', "one.json": '[{}]',
    "umlaut.json": '[{"ä}":"🙂"},"é"]',
}


def plain(text):
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return found if isinstance(found, list) else None


def check(got, name, text):
    want = plain(text)
    own = sorted((r for r in got if r[0] == name), key=lambda r: r[2] or 0)
    if not want:
        assert own == [(name, want is not None, None, None)], name
    else:
        assert [r[2] for r in own] == list(range(len(want))) and all(r[1] for r in own), name
        assert [json.loads(r[3]) for r in own] == want, name


def put(path, texts):
    path.mkdir()
    for name, text in texts.items():
        (path / name).write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture
def ranges(spark):
    """Read in ranges of a few bytes."""

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [13, 1 << 20])
def test_odd_files(spark, tmp_path, ranges, size):
    ranges(size)
    got = rows(files.read_documents(spark, put(tmp_path / "in", TEXTS)))
    assert {r[0] for r in got} == set(TEXTS)
    for name, text in TEXTS.items():
        check(got, name, text)


def element(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    text = lambda: "".join(rng.choices('ab"\\}{[],:ä🙂 \n', k=rng.randrange(9)))
    if kind < 2:
        return text()
    if kind < 4:
        return rng.choice([None, True, 17, -2.5])
    if kind < 5:
        return [element(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {text(): element(rng, depth + 1) for _ in range(rng.randrange(4))}


def test_random_files(spark, tmp_path, ranges):
    rng = random.Random(5)
    texts = {
        f"f{i}.json": json.dumps([element(rng) for _ in range(rng.randrange(12))], indent=rng.choice([None, 1]),
                                 ensure_ascii=rng.random() < 0.5)
        for i in range(8)
    }
    ranges(60)
    got = rows(files.read_documents(spark, put(tmp_path / "in", texts)))
    for name, text in texts.items():
        check(got, name, text)


def test_one_file_gives_many_tasks(spark, tmp_path, ranges):
    from lexmill.sources import arrays

    texts = {"big.json": json.dumps([{"legal_act": {"document_id": f"d{i}"}, "legal_act_relations": []} for i in range(2000)])}
    path = put(tmp_path / "in", texts)
    ranges(8192)
    pieces = arrays._pieces(spark, (path,))
    assert pieces.rdd.getNumPartitions() >= len(texts["big.json"]) // 8192
    got = files.read_documents(spark, path)
    assert got.count() == 2000 and got.agg({"pos": "max"}).first()[0] == 1999
    verdict = Q.file_verdicts(Q.check_documents(got)).collect()
    assert len(verdict) == 1


def test_long_element_over_many_ranges(spark, tmp_path, ranges):
    text = json.dumps(["x" * 500, {"a": ["}" * 300, "y" * 400]}, 1])
    ranges(120)
    got = rows(files.read_documents(spark, put(tmp_path / "in", {"long.json": text})))
    check(got, "long.json", text)


def test_elements_do_not_meet_in_one_task(spark, tmp_path):
    """A file's elements stay where they were cut; its one row of judgement goes to them."""
    path = put(tmp_path / "in", {"plain.json": TEXTS["plain.json"]})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = files.read_documents(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [path" in plan


def test_array_is_sorted_in_ranges(spark, tmp_path):
    """Elements by key, nulls first, repeated ones kept; no window and no sort of all rows in one task."""
    from pyspark.sql import functions as F

    from lexmill import schemas as S
    from lexmill.queries import stores

    keys = [None if i % 50 == 0 else i // 2 for i in range(400)]
    acts = spark.createDataFrame([(k,) for k in reversed(keys)], "k INT").repartition(3).select(
        F.from_json(F.to_json(F.struct(F.concat(F.lit("order-"), "k").alias("document_id"))), S.LEGAL_ACT).alias("legal_act"),
        F.array().cast(S.RELATIONS).alias("legal_act_relations"),
    )
    lines = stores.array_lines(acts)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Window", "SinglePartition", "Sort "))
    lines.write.text(str(tmp_path / "array"))
    written = list((tmp_path / "array").glob("part-*"))
    assert len(written) == 1
    got = [a["legal_act"].get("document_id") for a in json.loads(written[0].read_text())]
    assert got == [None if k is None else f"order-{k}" for k in sorted(keys, key=lambda k: (k is not None, k))]


def test_builders_bound_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    from lexmill.queries import raw

    spark.range(1000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t.parquet"))
    monkeypatch.setattr(raw, "ROWS_PER_TASK", 50)
    dealt = raw.spread_columns(spark, str(tmp_path), "t", "k")
    assert 20 <= dealt.rdd.getNumPartitions() < 20 + spark.sparkContext.defaultParallelism and dealt.count() == 1000
