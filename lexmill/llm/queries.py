"""The registered queries of the dealt operators."""

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import (
    alignment, langid, licenses, lzdedup, mixing, nearest, packing, phrases, ranked, secrets, simhash, toxicity, wrapper,
)
from lexmill.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_secrets(spark, sf):
    found = secrets.find_secrets(
        table(spark, sf, "documents"), vocabulary=public_tokenizers.path("byte_bpe_50k.json")
    )
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [
        (F.size("secrets") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secrets.KINDS[:3]
    ]
    place = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, place), ",")
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
        F.array_join(F.transform("secrets", lambda s: F.format_number(s["guess_bits"], 1)), ";").alias("guess_bits"),
    )


@query
def op2_simhash_dedup(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op3_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    known = ~held_out("doc_id", 5, 0)
    model = toxicity.fit(docs.where(known), table(spark, sf, "labels").where(known))
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op4_substring_dedup(spark, sf):
    found = lzdedup.dedup_substrings(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("factors").alias("n_factors")
    )


@query
def op5_packing(spark, sf):
    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op6_nearest(spark, sf):
    rows = table(spark, sf, "embeddings")
    return nearest.nearest(rows, rows.where(F.col("vec_id") % 100 == 0))


@query
def op7_fingerprints(spark, sf):
    return phrases.compare_edited(table(spark, sf, "documents"))


@query
def op8_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.where(~held_out("doc_id", 4, 2)))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query
def op9_mixing(spark, sf):
    rates = mixing.mix_rates(table(spark, sf, "documents"))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return rates.select("doc_id", "size", "source_size", "target", taken, "rate", "copies")


@query
def op10_main_text(spark, sf):
    found = wrapper.extract_main_text(table(spark, sf, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op11_token_alignment(spark, sf):
    found = alignment.align(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), digest=True,
    )
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op12_license_scan(spark, sf):
    found = licenses.scan_licenses(table(spark, sf, "documents"))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(joined).withColumn("expressions", F.array_join("expressions", ";"))


@query
def op13_ranked_search(spark, sf):
    return ranked.search(table(spark, sf, "benchmark"), table(spark, sf, "documents"))


CHECKS["op13_ranked_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, nn),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(
      w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll))))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
