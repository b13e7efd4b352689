"""A training corpus from raw documents, in stages; each one's result is stored and read again.

Stage functions take ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import langid, mixing, packing, secrets, simhash
from lexmill.llm.common import held_out, stored, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters go, and those further from every learned language than held-out labelled ones are."""
    known = ~held_out("doc_id", 4, 2)
    model = langid.fit(docs.where(known))
    return langid.keep_known(docs, model, langid.least_nearness(docs.where(~known), model))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: fingerprints of three-word shingles linked at three bits or fewer."""
    return simhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values are replaced by a mark; no document goes. ``n_chars`` follows the text."""
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return secrets.redact(docs, vocabulary=vocabulary).withColumn("n_chars", F.coalesce(length, "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them: 0, 1 or 2 times."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language id", keep_known_languages),
    ("near-duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each over everything its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name.replace(' ', '_')}")
    return docs
