"""Ranked lexical search by pipelined term partitioning.

Terms have owners by how common they are. An item's bundle carries its terms and a sparse
accumulator of document scores through the owners one after another, rarest terms first; at each
owner the bundle is cogrouped with the owner's lists and their integer contributions are added.
Lists and accumulators are split by blocks of documents, so no task holds a whole list.

After an owner, a document stays in an accumulator unless its score plus all that later owners
could still add is below the score that the k-th best of its block has already: such a document
cannot be among the block's best k. Nothing else is left out, so the ranking is exact.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import alnum_words, stored
from lexmill.session import run_path

OWNERS = 4
BITS = 1 << 23
BUCKET = 1 << 15
BLOCK_POSTINGS = 250_000
BUNDLE_ITEMS = 256
CACHE_TERMS = 500_000


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term``: the different terms of each item; rows with one id are one item."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({w.decode() for w in alnum_words(t.as_py())}) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["item", "terms"])

    terms = items.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"item {kind}, terms array<string>")
    return terms.select("item", F.explode("terms").alias("term")).distinct()


def term_filter(terms: DataFrame) -> bytes:
    """A bitmap of the hashes of all terms, compressed; a megabyte before that, whatever their number."""
    place = F.xxhash64("term").bitwiseAND(F.lit(BITS - 1))
    parts = (
        terms.select(place.alias("place"))
        .groupBy(F.floor(F.col("place") / BUCKET).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("place") % BUCKET).alias("bits"))
        .collect()  # BITS / BUCKET rows at most
    )
    whole = bytearray(BITS // 8)
    for part in parts:
        start = part["bucket"] * BUCKET // 8
        whole[start : start + BUCKET // 8] = part["bits"]
    return zlib.compress(bytes(whole))


def postings(docs: DataFrame, bits: bytes, id_col: str, text_col: str) -> DataFrame:
    """``row, doc, n, terms, tfs`` of each document with a term; only terms that the filter lets pass.

    ``row`` numbers the rows, so repeated ids stay apart.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, known, row = zlib.decompress(bits), {}, TaskContext.get().partitionId() << 33
        for batch in batches:
            rows, places, sizes, terms, tfs = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = alnum_words(text.as_py())
                if not words:
                    continue
                counts = Counter(words)
                own, times = [], []
                for word, tf in counts.items():
                    name = known.get(word)
                    if name is None:
                        place = xxhash.xxh64_intdigest(word, 42) & (BITS - 1)
                        name = word.decode() if asked[place >> 3] >> (place & 7) & 1 else ""
                        if len(known) >= CACHE_TERMS:
                            known.clear()
                        known[word] = name
                    if name:
                        own.append(name)
                        times.append(tf)
                rows.append(row)
                row += 1
                places.append(i)
                sizes.append(len(words))
                terms.append(own)
                tfs.append(times)
            columns = [
                pa.array(rows, pa.int64()), batch.column(0).take(pa.array(places, pa.int64())), pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.string())), pa.array(tfs, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc", "n", "terms", "tfs"])

    frame = docs.select(F.col(id_col), F.col(text_col))
    return frame.mapInArrow(run, f"row long, doc {kind}, n long, terms array<string>, tfs array<long>")


def visit(owner: int, k: int, last: bool, state: T.StructType, out: T.StructType):
    """What happens to the bundles of a block of documents at one owner of terms."""

    def best(scores: np.ndarray) -> int:
        """The k-th best score, 0 if there are fewer."""
        return int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0

    def run(bundle: pa.Table, lists: pa.Table) -> pa.Table:
        bundle = bundle.combine_chunks()
        found, place, number = np.unique(lists.column("row").to_numpy(), return_index=True, return_inverse=True)
        term = lists.column("term_id").to_numpy()
        order = np.argsort(term, kind="stable")
        term, number, gain = term[order], number[order], lists.column("gain").to_numpy()[order]
        documents = lists.column("doc").combine_chunks()
        made: dict[str, list] = {"rows": [], "docs": [], "scores": []}
        for i in range(bundle.num_rows):
            terms = bundle.column("terms")[i].values
            owners, ids, most = (terms.field(f).to_numpy() for f in ("owner", "term_id", "most"))
            total = np.zeros(len(found), dtype=np.int64)
            for t in ids[owners == owner]:
                low, high = np.searchsorted(term, [t, t + 1])
                total[number[low:high]] += gain[low:high]
            held = bundle.column("rows")[i].values.to_numpy()
            score = bundle.column("scores")[i].values.to_numpy()
            held_docs = bundle.column("docs")[i].values
            at = np.searchsorted(found, held)
            met = at < len(found)
            met[met] = found[at[met]] == held[met]
            total[at[met]] += score[met]
            new = np.flatnonzero(total)
            rows = np.concatenate([held[~met], found[new]])
            scores = np.concatenate([score[~met], total[new]])
            docs = pa.concat_arrays([held_docs.filter(pa.array(~met)), documents.take(pa.array(place[new]))])
            rest = int(most[owners > owner].sum())
            keep = np.flatnonzero(scores + rest >= best(scores))
            if last:  # ties at the last place go by document
                table = pa.table({"s": scores[keep], "d": docs.take(pa.array(keep)), "r": rows[keep]})
                ranked = pc.sort_indices(table, [("s", "descending"), ("d", "ascending"), ("r", "ascending")])
                keep = keep[ranked.to_numpy()[:k]]
            made["rows"].append(rows[keep])
            made["scores"].append(scores[keep])
            made["docs"].append(docs.take(pa.array(keep)))
        sizes = [len(r) for r in made["rows"]]
        kind = documents.type
        flat = {
            "rows": pa.array(np.concatenate([*made["rows"], np.zeros(0, dtype=np.int64)])),
            "scores": pa.array(np.concatenate([*made["scores"], np.zeros(0, dtype=np.int64)])),
            "docs": pa.concat_arrays(made["docs"]) if made["docs"] else pa.array([], kind),
        }
        if last:
            item = bundle.column("item").combine_chunks().take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            return pa.table([item, flat["rows"], flat["docs"], flat["scores"]], names=out.names)
        ends = pa.array(np.r_[0, np.cumsum(sizes, dtype=np.int64)].astype(np.int32))
        columns = {c: pa.ListArray.from_arrays(ends, v) for c, v in flat.items()}
        return pa.table([columns[c] if c in columns else bundle.column(c) for c in state.names], names=state.names)

    return run


def search(
    items: DataFrame, docs: DataFrame, k: int = 50, item_col: str = "item_id", id_col: str = "doc_id",
    text_col: str = "text", block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_col, rank, id_col, score``.

    A term's weight is ``floor(1000 * ln((2N + 2) / (2 df + 1)))``; all else is whole numbers, as in
    the sum of ``w * ((1000000000 tf) div (1000 tf + 20 m))`` over the item's different terms, with
    ``m = 50 + (50 n N) div L``. Only scores above 0 count; equal scores go by the smaller id, a null
    id last. Null and empty texts have no terms and are not counted in N. Every row is a document of
    its own, so repeated rows rank side by side; item rows with one id are one item. No items or no
    documents give no rows.
    """
    spark = docs.sparkSession
    asked = stored(item_terms(items, item_col, text_col), "ranked_items")
    listed = stored(postings(docs, term_filter(asked), id_col, text_col), "ranked_postings")
    total = listed.agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length"), F.sum(F.size("terms")).alias("entries")
    ).first()
    n_docs, length = total["docs"], max(total["length"] or 0, 1)
    blocks = max(-(-(total["entries"] or 0) // block_postings), 1)
    bundles = max(-(-asked.select("item").distinct().count() // BUNDLE_ITEMS), 1)

    share = F.expr(
        f"(1000000000L * p.tfs) div (1000L * p.tfs + 20L * (100L - 50L + ((50L * n * {n_docs}L) div {length}L)))"
    )
    entries = listed.select(
        "row", "doc", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("p")
    ).select("row", "doc", F.col("p.terms").alias("term"), share.alias("share"))
    known = entries.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("share").alias("most"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    owner = F.lit(OWNERS - 1)
    for step in range(OWNERS - 2, -1, -1):  # a document in 4, in 16, in 256 or fewer hold the term
        owner = F.when(F.col("df") * (256, 16, 4)[step] <= n_docs, step).otherwise(owner)
    vocabulary = stored(
        known.join(asked.select("term").distinct(), "term").select(
            "term", weight.alias("weight"), owner.cast("int").alias("owner"),
            (F.col("most") * weight).alias("most"), F.monotonically_increasing_id().alias("term_id"),
        ).where("weight > 0"),
        "ranked_terms",
    )
    bundle_of = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int")
    wanted = asked.withColumn("bundle", bundle_of).join(vocabulary, "term")
    gains = entries.join(
        wanted.select("bundle", "term", "term_id", "weight", "owner").distinct(), "term"
    ).select(
        "bundle", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), "row", "doc", "term_id",
        (F.col("weight") * F.col("share")).alias("gain"), "owner",
    )
    path = run_path(spark, "ranked_lists")
    gains.write.partitionBy("owner").parquet(path)
    lists = spark.read.schema(gains.schema).parquet(path)

    doc_type = docs.schema[id_col].dataType
    none = [F.array().cast(T.ArrayType(t)) for t in (T.LongType(), doc_type, T.LongType())]
    bundle = (
        wanted.groupBy("bundle", "item")
        .agg(F.collect_list(F.struct("term_id", "most", "owner")).alias("terms"))
        .select(
            "bundle", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "item", "terms",
            none[0].alias("rows"), none[1].alias("docs"), none[2].alias("scores"),
        )
    )
    state = bundle.schema
    out = T.StructType([
        T.StructField("item", items.schema[item_col].dataType), T.StructField("row", T.LongType()),
        T.StructField("doc", doc_type), T.StructField("score", T.LongType()),
    ])
    for step in range(OWNERS):
        last = step == OWNERS - 1
        own = lists.where(F.col("owner") == step).select(
            F.col("bundle").alias("of_bundle"), F.col("block").alias("of_block"), "row", "doc", "term_id", "gain"
        )
        bundle = bundle.groupBy("bundle", "block").cogroup(own.groupBy("of_bundle", "of_block")).applyInArrow(
            visit(step, k, last, state, out), out if last else state
        )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "row")
    ranked = bundle.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
