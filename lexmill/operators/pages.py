"""Page extraction and fetch outcomes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill.functions import text
from lexmill.functions.lookups import map_legal_type

KINDS = ["ok", "permanent", "transient"]  # of two at one attempt the earlier counts
WAITS = 2**62  # rank of what waits lies above half of it, all else below
NO_NUMBER = -(2**58)  # place of an attempt without a number, before all others


def extract_laws(
    pages: DataFrame, max_chars: int | None = None, with_text: bool = True
) -> DataFrame:
    """Fields of every page. The page itself is left behind here, before any shuffle.

    Keeps the input columns except ``html``. ``abrogated`` is null where there is no page.
    The text is whole unless ``max_chars`` is given. It is the costliest field and only summary
    requests need it; leave it out with ``with_text=False``.

    ``abrogated`` and the text are what later filters ask for. Each is computed once, in this
    order, so that a filter on the first runs before the text is taken. The others are plain
    columns: what no reader uses is not computed.
    """
    html, lower = F.col("html"), F.col("_lower")
    lowered = pages.withColumn("_lower", text.lowered(html))
    found = text.compute_once(lowered, abrogated=text.is_abrogated(html, lower))
    if with_text:
        found = text.compute_once(found, text_content=text.extract_body_text(html, max_chars, lower))
    return found.select(
        *[c for c in pages.columns if c != "html"],
        "abrogated",
        text.extract_title(html, lower).alias("title"),
        text.extract_abbreviation(html, lower).alias("abbreviation"),
        text.extract_enactment_date(html, lower).alias("enactment_date"),
        text.extract_last_amendment_date(html, lower).alias("last_amendment_date"),
        text.extract_publication_date(html, lower).alias("publication_date"),
        *(["text_content"] if with_text else []),
    )


def with_legal_type(extracted: DataFrame) -> DataFrame:
    return extracted.withColumn("legal_type", map_legal_type("doc_type"))


def fetch_outcome(attempts: DataFrame) -> DataFrame:
    """Outcome per document of an attempt log ``document_id, attempt, status, error``.

    The first success or 4xx decides: ok or permanent. Anything else (5xx, no status) is
    transient and decides only if nothing better follows; then the last attempt gives the
    message. How often to try is up to whoever fetches; every logged document has a row.

    Waiting, attempt and kind are ranked in one number, which a hash aggregation holds. The
    message needs a sorted one; readers that leave it out are spared that.
    """
    status = F.col("status")
    kind = (
        F.when(status.between(400, 499), KINDS.index("permanent"))
        .when(status < 400, KINDS.index("ok"))
        .otherwise(KINDS.index("transient"))
    )
    tried = attempts.withColumn("_kind", kind).withColumn("_rank", _rank("attempt", "_kind"))
    decided = tried.groupBy("document_id").agg(
        F.min("_rank").alias("_first"),
        F.min(F.struct("_rank", "error")).alias("_said"),
    )
    found = F.get(F.array(*map(F.lit, KINDS)), F.col("_first").bitwiseAND(3).cast("int"))
    waits = F.col("_first") >= WAITS // 2
    place = F.shiftright("_first", 2) - F.when(waits, WAITS // 4).otherwise(0)
    number = F.when(place != NO_NUMBER, F.when(waits, -place).otherwise(place))
    return decided.select(
        "document_id",
        found.alias("fetch_outcome"),
        number.cast(attempts.schema["attempt"].dataType).alias("attempts"),
        F.when(found != "ok", F.col("_said.error")).alias("message"),
    )


def _rank(attempt: str, kind: str) -> Column:
    """Number that sorts attempts: those that wait behind, then the attempt, then the kind.

    Of those that wait the last attempt comes first, and one without a number before all. For
    attempts below 2^57.
    """
    waits = F.col(kind) == KINDS.index("transient")
    signed = F.when(waits, -F.col(attempt)).otherwise(F.col(attempt)).cast("bigint")
    place = F.coalesce(signed, F.lit(NO_NUMBER))
    return F.when(waits, WAITS).otherwise(0) + place * 4 + F.col(kind)
