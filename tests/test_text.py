"""Edge cases of the text functions."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill.functions import documents as D
from lexmill.functions import text as X

NBSP, BOM = chr(0xA0), chr(0xFEFF)


def test_law_url(values):
    texts = [
        "https://h/lrgv/gesetz/01012026-ein-gesetz/",
        "https://h/lrgv/gesetz/01012026-ein-gesetz",
        "https://h/x/lrgv/lrgv/01012026-a",
        "https://h/lrgv/gesetz/0101202-a",
        "https://h/lrgv/gesetz/01012026-a/b",
        "https://h/lrgv/gesetz/01012026-a/\n",
        "https://h/other/",
        None,
    ]
    parts = X.parse_law_url("s")
    got = values(texts, lambda s: F.concat_ws("|", *parts.values()))
    assert got == [
        "gesetz|01012026|ein-gesetz", "gesetz|01012026|ein-gesetz", "lrgv|01012026|a",
        "", "", "", "", "",
    ]


def test_dates_are_moved_and_not_checked(values):
    assert values(["01022026", "99999999", None], X.ddmmyyyy_to_iso) == [
        "2026-02-01", "9999-99-99", None,
    ]
    assert values(["31.02.2021", "am 01.02.2020 und 03.04.2021", "x", None], X.german_date_to_iso) == [
        "2021-02-31", "2020-02-01", None, None,
    ]


def test_date_violations(values):
    texts = [
        "2020-02-29", "2020-02-31", "1799-12-31", "1800-01-01", "2100-12-31", "2101-01-01",
        "2020-2-3", "2020-01-01\n", "0000-00-00", "9999-99-99", "", None,
    ]
    assert values(texts, X.date_violation) == [
        None, "calendar", "year_range", None, None, "year_range", "format", "format",
        "year_range", "year_range", "format", None,
    ]


def test_strip_tags(values):
    texts = [
        "<b>a</b><i>b</i>", f" a{NBSP}\t\n b {BOM}", "a &amp; b", "<script>x</script>",
        "1 < 2", "a  b", "a b", "\n", f"x{chr(0x2003)}{chr(0x3000)}y",
    ]
    assert values(texts, X.strip_tags) == [
        "ab", "a b", "a &amp; b", "x", "1 < 2", "a b", "a b", "", "x y",
    ]


def test_title(values):
    texts = [
        '<H1 class="x">A <b>B</b>\n</H1><h1>C</h1>', "<h1></h1>", "<h1> \n </h1>", "none",
        "<h1>open", None,
    ]
    assert values(texts, X.extract_title) == ["A B", None, None, None, None, None]


def test_abbreviation(values):
    def listed(text):
        return f"<dt> Abkürzung </dt>{NBSP}<dd>{text}</dd>"

    texts = [
        listed(" BspG "), listed("x" * 60), listed("x" * 61), listed(" "),
        "<p>Abkürzung: <b>BspG</b>", "ABKÜRZUNG: <b>bspg</b>", "Abkürzung: <b>1G</b>",
        listed(" ") + "<p>Abkürzung: <b>BspG</b>", None,
    ]
    assert values(texts, X.extract_abbreviation) == [
        "BspG", "x" * 60, None, None, "BspG", "bspg", None, None, None,
    ]


def test_enactment_date(values):
    near, far = "x" * 200, "x" * 201
    texts = [
        "<dt>Ausfertigungsdatum</dt>\n<dd> 01.02.2020</dd>",
        "AUSFERTIGUNGSDATUM ist 01.02.2020",
        f"Ausfertigungsdatum{near}01.02.2020",
        f"Ausfertigungsdatum{far}01.02.2020",
        "01.02.2020",
    ]
    assert values(texts, X.extract_enactment_date) == [
        "2020-02-01", "2020-02-01", "2020-02-01", None, None,
    ]


def test_amendment_and_publication_date(values):
    texts = [
        "zuletzt geändert am 01.02.2020", "ZULETZT\nGEÄNDERT 01.02.2020",
        f"zuletzt{NBSP}geandert 01.02.2020", "zuletzt geändert" + "x" * 300 + "01.02.2020",
        "zuletzt geändert" + "x" * 301 + "01.02.2020", "Letzte Änderung: 01.02.2020",
        "letzte änderung" + "x" * 201 + "01.02.2020",
    ]
    good = "2020-02-01"
    assert values(texts, X.extract_last_amendment_date) == [
        good, good, good, good, None, good, None,
    ]
    texts = ["Fundstelle: GV vom 01.02.2020", "FUNDSTELLE" + "x" * 301 + "01.02.2020", "x"]
    assert values(texts, X.extract_publication_date) == [good, None, None]


def test_abrogated_needs_a_class(values):
    texts = [
        '<div class="law Aufgehoben-x">', "<div id='a' class=\"aufgehoben\" x>", "aufgehoben",
        "<div class='aufgehoben'>", None,
    ]
    assert values(texts, X.is_abrogated) == [True, True, False, False, None]


def test_body_text(values):
    texts = [
        "<main>a</main><article>b</article>", "<main></main><article>b</article>",
        "<main>a<article>b</article>", "<p>c</p>", "<main>a < b</main>", None,
    ]
    assert values(texts, X.extract_body_text) == ["a", "", "b", "c", "a < b", None]
    long = "<main>" + "wort " * 1000 + "</main>"
    assert [len(t) for t in values([long], X.extract_body_text)] == [4999]
    assert [len(t) for t in values([long], lambda s: X.extract_body_text(s, 2500))] == [2500]


def test_long_page_does_not_overflow(values):
    page = "<main>" + "<p>x</p>\n" * 200_000 + "</main>"
    assert len(values([page], lambda s: X.extract_body_text(s, None))[0]) == 399_999


@pytest.mark.parametrize(
    ("response", "summary"),
    [
        ('{"candidates":[{"content":{"parts":[{"text":" a\\n"}]}}]}', "a"),
        ('{"candidates":[{"content":{"parts":[{"text":" \\n"}]}}]}', None),
        ('{"candidates":[]}', None),
        ('{"candidates":[{"content":{"parts":[{"text":"a"}]}}', None),
        ("", None),
        (None, None),
    ],
)
def test_response(values, response, summary):
    assert values([response], D.parse_response) == [summary]


def test_prompt(spark):
    frame = spark.createDataFrame(
        [("T", "x"), ("", None), (None, "y" * 4000)], "t STRING, x STRING"
    )
    got = [r[0] for r in frame.select(D.prompt("t", "x")).collect()]
    assert got[0] == "Titel: T\n\nText:\nx"
    assert got[1] == "Titel: Kein Titel\n\nText:\nKein Text vorhanden"
    assert got[2] == "Titel: Kein Titel\n\nText:\n" + "y" * 2500
    third = frame.where("t IS NULL")
    for cuts, kept in (((None, None), 4000), ((3500, 3000), 3000), ((None, 10), 10)):
        assert third.select(D.prompt("t", "x", *cuts)).first()[0] == "Titel: Kein Titel\n\nText:\n" + "y" * kept


def test_body_patterns_find_what_a_lazy_dot_finds(values):
    texts = [
        "<main>a</main>b</main>", "<MAIN x='1'>a\n<b>c</B></Main><main>d</main>", "<main>a<main>b</main>",
        "<main>a</mainx></main >b</main>", "<main>a", "<main", "<main>a<", "<mainframe>ü<</main>", "</main><main></main>",
        "<main a='<'>b</main><article>c</article>", "<main>" + "<b>x</b> " * 50_000 + "</main>y", None,
    ]
    for tag, pattern in (("main", K.MAIN), ("article", K.ARTICLE)):
        given = [t and t.replace("main", tag) for t in texts]
        lazy = rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"
        assert values(given, lambda s: X.capture_or_empty(s, pattern)) == values(given, lambda s: X.capture_or_empty(s, lazy))
        assert "*?" not in pattern  # one step per bracket, not one per character


def test_each_pattern_waits_for_all_its_words(spark):
    lower = F.col("l")
    words = {
        X.extract_abbreviation: ["rzung", "<dt"], X.extract_enactment_date: ["ausfertigungsdatum", "<dt"],
        X.extract_last_amendment_date: ["zuletzt", "letzte", "nderung"],
    }
    pages = spark.createDataFrame(
        [("Abkürzung<b>GX</b> Ausfertigungsdatum 01.02.2003 Letzte Änderung 04.05.2006",),
         ("<DT>ABKÜRZUNG</DT><dd>GY</dd><dt>Ausfertigungsdatum</dt><dd>01.02.2003</dd> zuletzt geändert 04.05.2006",)],
        "html STRING",
    ).withColumn("l", X.lowered("html"))
    for extract, needed in words.items():
        plan = pages.select(extract("html", lower))._jdf.queryExecution().analyzed().toString().lower()
        assert [word for word in needed if f", {word})" not in plan] == []
        assert rows(pages.select(extract("html", lower))) == rows(pages.select(extract("html")))
        assert all(r[0] for r in rows(pages.select(extract("html", lower))))


def test_block_pattern_finds_what_a_lazy_dot_finds(values):
    texts = [
        "<url>a</url><url></url>b<url>c<d>e</d>\n</url>", "<url>a<url>b</url></url>", "<url>a", "<URL>a</URL>",
        "<url>a</urlx></url >b</url><url>c<</url>", "</url><url>ü < x</url>", "", None,
    ]

    def found(pattern):
        return lambda s: F.regexp_extract_all(s, F.lit(pattern), F.lit(1))

    assert values(texts, found(K.URL_BLOCK)) == values(texts, found(r"(?s)<url>(.*?)</url>"))
    assert "*?" not in K.URL_BLOCK  # one step per bracket, not one per character
