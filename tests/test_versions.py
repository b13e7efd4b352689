"""Sitemaps and the choice of versions."""

import random

from conftest import rows
from lexmill.operators import versions as V
from lexmill.plans.versions import changed_versions, current_versions
from lexmill.sources import sitemaps as S

H = "https://h/lrgv/gesetz"


def block(loc, lastmod=None):
    tail = f"<lastmod>{lastmod}</lastmod>" if lastmod else ""
    return f"<url>\n<loc> {loc} </loc>{tail}</url>"


def pages(spark, *xml):
    return spark.createDataFrame(list(enumerate(xml, 1)), "page INT, xml STRING")


def test_blocks(spark):
    xml = (
        block(f"{H}/01012020-a/", " 2020-01-02T00:00:00+01:00 ")
        + "<url><lastmod>x</lastmod></url>" + block(f"{H}/99999999-b") + block("https://h/x")
        + "<url><loc> </loc></url>" + f"<url><loc>{H}/01012020-open"
    )
    assert rows(S.explode_sitemap(pages(spark, xml, ""))) == [
        (1, 0, f"{H}/01012020-a/", "2020-01-02T00:00:00+01:00"),
        (1, 2, f"{H}/99999999-b", None),
        (1, 3, "https://h/x", None),
    ]
    laws = S.law_entries(pages(spark, xml))
    assert rows(laws, "slug", "entry_date") == [("a", "2020-01-01"), ("b", "9999-99-99")]
    assert S.keep_law_urls(S.explode_sitemap(pages(spark, xml))).count() == 2


def test_count(spark):
    index = spark.createDataFrame(
        [("<sitemap></sitemap><sitemap>",), ("x",), (None,)], "x STRING"
    )
    assert [r[0] for r in index.select(S.count_sitemaps("x")).collect()] == [2, 47, 47]


def test_xml_source(spark, tmp_path):
    (tmp_path / "s.xml").write_text(f"<urlset>{block(H, '2020-01-01')}{block('y')}</urlset>")
    assert rows(S.read_sitemap_xml(spark, str(tmp_path))) == [(H, "2020-01-01"), ("y", None)]


def test_current_version(spark):
    first = block(f"{H}/01012020-a") + block(f"{H}/01012021-a/") + block(f"{H}/00000000-z")
    second = block(f"{H}/01012021-a") + block(f"{H}/01012030-a") + block(f"{H}/01012020-b")
    got = rows(
        current_versions(pages(spark, first, second), "2026-01-01"), "slug", "entry_date", "page", "pos"
    )
    # a tie goes to the one seen first, future versions do not count
    assert got == [("a", "2021-01-01", 1, 1), ("b", "2020-01-01", 2, 2), ("z", "0000-00-00", 1, 2)]
    done = spark.createDataFrame([("a",)], "document_id STRING")
    left = current_versions(pages(spark, first, second), "2026-01-01", done)
    assert rows(left, "slug") == [("b",), ("z",)]


def entries(spark, data):
    return spark.createDataFrame(
        data, "document_id STRING, entry_date STRING, page INT, pos INT"
    )


def test_result_does_not_depend_on_row_order(spark):
    rng = random.Random(1)
    data = [
        (f"d{rng.choice([0, 0, 0, 1, 2, 3])}", f"2020-01-{rng.randint(1, 9):02}", p, q)
        for p in range(20) for q in range(10)
    ]
    best = {}
    for key, date, p, q in data:
        if key not in best or best[key][0] < date:
            best[key] = (date, p, q)
    expected = sorted((k, *v) for k, v in best.items())
    for seed in range(3):
        random.Random(seed).shuffle(data)
        frame = entries(spark, data).repartition(5)
        assert rows(V.latest_version(frame)) == expected
        assert rows(V.rank_versions(frame).drop("version_rank")) == expected


def test_resume_before_or_after_the_choice(spark):
    frame = entries(spark, [("a", "1", 1, 0), ("a", "2", 1, 1), ("b", "1", 1, 2)])
    done = spark.createDataFrame([("a",)], "document_id STRING")
    assert rows(V.latest_version(V.resume(frame, done))) == rows(
        V.resume(V.latest_version(frame), done)
    )


def test_sample_is_in_order_of_appearance(spark):
    frame = entries(
        spark,
        [("b", "2020-01-01", 1, 0), ("a", "2020-01-01", 1, 1), ("c", "2020-01-01", 2, 0),
         ("b", "2021-01-01", 3, 0)],
    )
    got = V.sample_laws(frame, 2).select("document_id", "entry_date").collect()
    assert [tuple(r) for r in got] == [("b", "2021-01-01"), ("a", "2020-01-01")]
    assert V.sample_laws(frame).count() == 3


def test_history(spark):
    frame = entries(
        spark,
        [("a", "2020-01-01", 1, 0), ("a", "2021-01-01", 1, 1), ("a", "2021-01-01", 2, 0)],
    )
    got = rows(V.version_history(frame), "document_id", "valid_from", "valid_to", "page")
    assert got == [("a", "2020-01-01", "2021-01-01", 1), ("a", "2021-01-01", None, 1)]


def test_changed_old_version(spark):
    """An old version was touched, the current one was not."""
    xml = (
        block(f"{H}/01012020-a", "2026-01-09T10:00:00Z") + block(f"{H}/01012025-a", "2025-01-01")
        + block(f"{H}/01012020-b", "2026-01-08") + block(f"{H}/01012020-c", "2026-01-07T23:59:59Z")
        + block(f"{H}/01012020-d")
    )
    args = (pages(spark, xml), "2026-01-10", "2026-01-10")
    assert rows(changed_versions(*args), "slug", "entry_date", "lastmod") == [
        ("a", "2020-01-01", "2026-01-09"), ("b", "2020-01-01", "2026-01-08"),
    ]
    assert rows(changed_versions(*args, latest_first=True), "slug") == [("b",)]


def test_observed_counts(spark):
    frame, seen = V.observe_counts(entries(spark, [("a", "1", 1, 0), ("a", "2", 1, 1)]), "n")
    assert V.latest_version(frame).count() == 1
    assert seen.get["rows"] == 2
