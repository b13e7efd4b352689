"""Column functions on addresses, page text and dates. All run inside the JVM."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def falsy_to_null(c) -> Column:
    """'' becomes null."""
    return F.nullif(_col(c), F.lit(""))


def strip(c) -> Column:
    """Cut white space, as class ``WS`` has it, from both ends."""
    return F.btrim(_col(c), F.lit(K.WS_CHARS))


def strip_tags(c) -> Column:
    """Drop tags, turn white space runs into one blank, cut the ends. Entities stay."""
    bare = F.regexp_replace(_col(c), K.TAG, "")
    # after the replacement a blank is the only white space left, so trim is enough
    return F.trim(F.regexp_replace(bare, K.WS_RUN, " "))


def lowered(html) -> Column:
    """Lower-case page for the word tests of the extractors; compute it once per page."""
    return F.lower(_col(html))


def _has(lower: Column | None, word: str) -> Column:
    """Whether a page can match at all. Searching a word is far cheaper than a regex."""
    return F.lit(True) if lower is None else lower.contains(word)


def capture(c, *patterns: str, only_if: Column | list[Column] | None = None) -> Column:
    """Capture of the first pattern that matches, '' or null if none does.

    For patterns whose capture holds at least one character. A later pattern only runs on
    rows without an earlier match, and none runs where its ``only_if`` is false: one condition
    for all patterns, or one for each.
    """
    found = [F.regexp_extract(_col(c), pattern, 1) for pattern in patterns]
    if only_if is not None:
        conditions = only_if if isinstance(only_if, list) else [only_if] * len(found)
        found = [F.when(condition, text) for condition, text in zip(conditions, found, strict=True)]
    *firsts, last = found
    return F.coalesce(*[F.nullif(first, F.lit("")) for first in firsts], last)


def capture_or_empty(c, pattern: str) -> Column:
    """First capture; '' if it is empty, null only if nothing matched."""
    return F.try_element_at(F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(1)), F.lit(1))


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that no later filter or projection computes a second time.

    The optimizer copies the expression of a column into each filter on it. For costly
    expressions that means the work is done per filter; behind a generator it is done once.
    """
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(fields)))


# --- addresses -----------------------------------------------------------------------


def law_path(loc) -> Column:
    """The ``/lrgv/type/date-slug`` end of a law address, '' for other addresses."""
    return F.regexp_extract(_col(loc), K.LAW_URL, 0)


def parse_law_path(path) -> dict[str, Column]:
    """Type, date and slug of a law path; null for ''."""
    parts = F.split(_col(path), "/")
    tail = F.try_element_at(parts, F.lit(4))
    return {
        "doc_type": F.try_element_at(parts, F.lit(3)),
        "date_str": F.substring(tail, 1, 8),
        "slug": F.substring(tail, 10, 2147483647),
    }


def parse_law_url(loc) -> dict[str, Column]:
    """Type, date and slug of a law address; null for other addresses."""
    return parse_law_path(law_path(loc))


# --- dates ---------------------------------------------------------------------------


def ddmmyyyy_to_iso(c) -> Column:
    """Move the parts of DDMMYYYY. The date itself is not checked."""
    s = _col(c)
    return F.concat(
        F.substring(s, 5, 4), F.lit("-"), F.substring(s, 3, 2), F.lit("-"), F.substring(s, 1, 2)
    )


def german_date_to_iso(c) -> Column:
    """First DD.MM.YYYY in the text as YYYY-MM-DD, unchecked; null without one."""
    found = F.regexp_extract(_col(c), K.DATE, 1)
    moved = F.regexp_replace(found, r"([0-9]{2})\.([0-9]{2})\.([0-9]{4})", "$3-$2-$1")
    return falsy_to_null(moved)


def date_violation(c) -> Column:
    """Why a date string is wrong: format, year_range or calendar. Null if right or null."""
    s = _col(c)
    low, high = K.YEAR_RANGE
    year = F.substring(s, 1, 4).try_cast("int")
    return (
        F.when(s.isNull(), None)
        .when(~s.rlike(K.ISO_DATE), "format")
        .when(~year.between(low, high), "year_range")
        .when(s.try_cast("date").isNull(), "calendar")
    )


# --- law pages -----------------------------------------------------------------------
# ``lower`` is the page from :func:`lowered`. With it an extractor skips each pattern on
# pages that lack the words its every match needs; the result is the same.


def extract_title(html, lower: Column | None = None) -> Column:
    return falsy_to_null(strip_tags(capture(html, K.TITLE, only_if=_has(lower, "<h1"))))


def extract_abbreviation(html, lower: Column | None = None) -> Column:
    word = _has(lower, "rzung")
    found = capture(
        html, K.ABBREVIATION_LIST, K.ABBREVIATION_TEXT, only_if=[word & _has(lower, "<dt"), word]
    )
    return falsy_to_null(strip(found))


def extract_enactment_date(html, lower: Column | None = None) -> Column:
    word = _has(lower, "ausfertigungsdatum")
    return german_date_to_iso(
        capture(html, K.ENACTMENT_LIST, K.ENACTMENT_TEXT, only_if=[word & _has(lower, "<dt"), word])
    )


def extract_last_amendment_date(html, lower: Column | None = None) -> Column:
    phrase = _has(lower, "zuletzt")
    heading = _has(lower, "letzte") & _has(lower, "nderung")
    return german_date_to_iso(
        capture(html, K.AMENDMENT_PHRASE, K.AMENDMENT_HEADING, only_if=[phrase, heading])
    )


def extract_publication_date(html, lower: Column | None = None) -> Column:
    return german_date_to_iso(
        capture(html, K.PUBLICATION, only_if=_has(lower, "fundstelle"))
    )


def is_abrogated(
    html, lower: Column | None = None, marker: str = K.ABROGATED_MARKER
) -> Column:
    """True if a tag carries a class with the marker. The word in free text does not count."""
    marked = _col(html).rlike(K.MARKED_CLASS.format(marker))
    return _has(lower, marker) & marked


def extract_body_text(
    html, max_chars: int | None = None, lower: Column | None = None
) -> Column:
    """Text of the first main, else of the first article, else of the page.

    An empty main counts as found. The text is whole unless ``max_chars`` is given.
    """
    body = F.coalesce(
        F.when(_has(lower, "<main"), capture_or_empty(html, K.MAIN)),
        F.when(_has(lower, "<article"), capture_or_empty(html, K.ARTICLE)),
        _col(html),
    )
    text = strip_tags(body)
    return text if max_chars is None else F.substring(text, 1, max_chars)


def extract_issue(html) -> dict[str, Column]:
    """What a page cites of the gazette: year, and issue number (``Nr.``) or page (``S.``).

    Null without a citation, and the one that is not cited.
    """
    sign = F.regexp_extract(_col(html), K.ISSUE, 2)
    value = F.regexp_extract(_col(html), K.ISSUE, 3).try_cast("int")
    return {
        "issue_year": F.regexp_extract(_col(html), K.ISSUE, 1).try_cast("int"),
        "issue_number": F.when(sign == "Nr.", value),
        "issue_page": F.when(sign == "S.", value),
    }
