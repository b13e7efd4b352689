"""Toxicity from confirmed toxic examples and unlabelled text (non-negative PU learning).

Features say whether a byte 4-gram or 6-gram occurs in the lower-cased text. A sample of bounded
size gives the features that tell most, then a linear classifier is fitted with the
non-negative risk estimator: the loss of unlabelled text as negative, less that of the toxic
share it holds (the class prior), is not allowed to fall below zero.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import stored

POSITIVES = 2000
UNLABELLED = 4000
SELECTED = 2048
FEATURES_PER_POSITIVE = 8
BUCKET_BITS = 22
DEFAULT_PRIOR = 0.1
SPAN = 1 << 19


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Bucket of every 4-gram and 6-gram of a whole text, in parts that overlap."""
    raw = np.frombuffer(b" " + " ".join((text or "").lower().split()).encode("utf-8", "replace") + b" ", dtype=np.uint8)
    shift = np.uint64(64 - BUCKET_BITS)
    for at in range(0, max(len(raw) - 3, 0), SPAN):
        part = raw[at : at + SPAN + 5].astype(np.uint64)
        pair = part[:-1] | part[1:] << np.uint64(8)
        four = pair[:-2] | pair[2:] << np.uint64(16)
        yield (four * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int32)
        if len(four) > 2:
            six = four[:-2] | pair[4:] << np.uint64(32)
            yield (six * np.uint64(0xD6E8FEB86659FD93) >> shift).astype(np.int32)


class Model:
    """Selected buckets, ascending, their weights, and the bias."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.buckets, self.weights, self.bias = buckets, weights, bias
        self.table = None

    def __reduce__(self):
        return (Model, (self.buckets, self.weights, self.bias))

    def present(self, text: str | None) -> np.ndarray:
        """Places of the selected buckets that occur in the text."""
        if self.table is None:
            self.table = np.zeros(1 << BUCKET_BITS, dtype=bool)
            self.table[self.buckets] = True
        found = [part[self.table[part]] for part in grams(text)]
        hits = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)
        return np.searchsorted(self.buckets, hits)

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[self.present(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 200, decay: float = 2e-3):
    """Weights and bias by the non-negative PU risk with logistic loss; full batches, no chance.

    If the corrected negative risk is below zero, the step goes up that risk instead of down the
    whole, which keeps the classifier from learning the toxic examples by heart.
    """
    d = positive.shape[1]
    w, b = np.zeros(d, np.float32), np.float32(np.log(prior / (1 - prior)))
    m, v, t = np.zeros(d + 1), np.zeros(d + 1), 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for _ in range(steps):
        zp, zu = positive @ w + b, unlabelled @ w + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # derivative of each loss by its logit
        as_positive, p_as_negative, u_as_negative = -sigmoid(-zp), sigmoid(zp), sigmoid(zu)
        if negative >= 0:
            gp, gu = prior * (as_positive - p_as_negative) / len(zp), u_as_negative / len(zu)
        else:
            gp, gu = prior * p_as_negative / len(zp), -u_as_negative / len(zu)
        gradient = np.r_[positive.T @ gp.astype(np.float32) + unlabelled.T @ gu.astype(np.float32) + decay * w * (negative >= 0),
                         gp.sum() + gu.sum()]
        t += 1
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), np.float32(b - step[-1])
    return w, float(b)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED, selected: int = SELECTED,
) -> Model:
    """Fit on at most about ``positives`` toxic and ``unlabelled`` other documents.

    Both samples are drawn by a hash of the id, at rates from counts over all rows, a row for each
    drawn id (of repeated rows the smallest text); a row counts as unlabelled if its id has no label. If nearly all rows have one, the second sample is drawn
    from all of them: it stands for the whole table either way. The class prior is the share of
    toxic ids among all labelled ones. Without toxic examples every score is the prior.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(F.col(label_col).cast("int")).alias("_toxic")
    )
    ids = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col)).distinct()
    known = ids.join(marked, id_col, "left").withColumn("_h", F.pmod(F.xxhash64(id_col), F.lit(1 << 30)))
    total = known.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_toxic") == 1).alias("p"), F.count("_toxic").alias("marked")
    ).first()
    prior = min(max(total.p / total.marked, 1e-4), 0.9) if total.marked else DEFAULT_PRIOR
    if total.p == total.marked:
        prior = DEFAULT_PRIOR
    if not total.p:
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), float(np.log(prior / (1 - prior))))
    free = total.n - total.marked
    enough = free >= min(unlabelled, total.n) / 4
    other = F.col("_toxic").isNull() if enough else F.lit(True)
    rate = lambda n, of: int(min(1.0, n / max(of, 1)) * (1 << 30))
    drawn = known.select(
        F.col(id_col),
        (F.coalesce(F.col("_toxic") == 1, F.lit(False)) & (F.col("_h") < rate(positives, total.p))).alias("_p"),
        (other & (F.col("_h") < rate(unlabelled, free if enough else total.n))).alias("_u"),
    ).where("_p or _u")
    # both rates bound the rows of this side, so it can be sent to every task; an id that is repeated,
    # however often, gives one row, reduced where it is read
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text")).join(F.broadcast(drawn), id_col)
    sample = stored(
        texts.groupBy(id_col, "_p", "_u").agg(F.min("_text").alias("_text")).select("_p", "_u", "_text").repartition(16),
        "toxic_sample",
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BUCKET_BITS), dtype=np.int32)
        for batch in batches:
            for p, u, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = list(grams(text))
                if found:
                    own = np.unique(np.concatenate(found))
                    counts[0][own] += bool(p)
                    counts[1][own] += bool(u)
        used = np.flatnonzero(counts.any(axis=0)).astype(np.int32)
        for at in range(0, len(used), 100_000):
            part = used[at : at + 100_000]
            columns = [pa.array(part), pa.array(counts[0][part]), pa.array(counts[1][part])]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "p", "u"])

    sizes = sample.agg(F.count_if("_p").alias("p"), F.count_if("_u").alias("u")).first()
    p, u = F.sum("p") / max(sizes.p, 1), F.sum("u") / max(sizes.u, 1)
    told = sample.mapInArrow(frequencies, "bucket int, p int, u int").groupBy("bucket").agg(
        (F.abs(p - u) / F.sqrt(p + u + F.lit(5.0 / max(sizes.p + sizes.u, 1)))).alias("gain"), F.sum("p").alias("seen")
    )
    # few examples can't carry many features
    best = told.where("seen >= 2").orderBy(F.desc("gain"), "bucket").limit(min(selected, FEATURES_PER_POSITIVE * sizes.p)).select("bucket")
    buckets = np.array(sorted(r.bucket for r in best.collect()), dtype=np.int32)
    shared = Model(buckets, np.zeros(len(buckets), np.float32), 0.0)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for text in batch.column(2):
                x = np.zeros(len(shared.buckets), dtype=bool)
                x[shared.present(text.as_py())] = True
                packed.append(np.packbits(x).tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["_p", "_u", "x"])

    rows = sorted(sample.mapInArrow(vectors, "_p boolean, _u boolean, x binary").collect(), key=lambda r: (r[0], r[1], bytes(r[2])))
    matrix = lambda keep: np.array(
        [np.unpackbits(np.frombuffer(r.x, np.uint8), count=len(buckets)) for r in rows if keep(r)], dtype=np.float32
    ).reshape(-1, len(buckets))
    positive, rest = matrix(lambda r: r[0]), matrix(lambda r: r[1])
    if not len(rest):
        rest = positive
    return Model(buckets, *fit_nnpu(positive, rest, prior))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` per row, from whole texts; null and empty texts get the score of no feature.

    Repeated rows come out as often as they came in, null ids stay null. No documents: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=[id_col, "score"])

    frame = docs.select(F.col(id_col), F.col(text_col))
    return frame.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double")
