"""Snapshots of documents by key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K


def upsert(old: DataFrame, new: DataFrame, key: tuple[str, ...] = ("document_id",)) -> DataFrame:
    """``old`` with every row of ``new`` put in by key. Both sides hold a key once.

    Write the result to a new snapshot folder; never over the one being read.
    """
    kept = old.join(new.select(*key), list(key), "left_anti")
    return kept.unionByName(new)


def processed_ids(outcome_rows: DataFrame, retry_transient: bool = False) -> DataFrame:
    """Distinct ids with an outcome. Errors count as processed too.

    ``retry_transient=True`` leaves transient failures out, so that a resumed run tries them
    again.
    """
    rows = outcome_rows.where(F.col("document_id").isNotNull())
    if retry_transient:
        rows = rows.where(
            F.coalesce(F.col("reason") != K.TRANSIENT, F.lit(True))
        )
    return rows.select("document_id").distinct()
