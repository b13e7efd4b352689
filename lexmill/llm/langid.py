"""Language identification in two steps: the family first, then the language inside it.

Features are hashed byte n-grams of the whole lower-cased text. Linear support vector machines,
one against one, tell families apart and then the languages of the chosen family. They are
fitted in one task from a bounded sample of labelled rows; the driver gets their weights only.
"""

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 600
BUCKETS = 4096
FEATURES = BUCKETS + 1024
SPAN = 1 << 18
LEAST_ROWS = 100
MARGIN = 0.6

# Families of languages by their codes; a code that is not listed is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk tt".split(),
    "semitic": "ar he mt am".split(),
    "indic": "hi bn ur mr gu pa ne si".split(),
    "celtic": "ga cy gd br".split(),
    "malayic": "id ms jv su".split(),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def features(text: str) -> np.ndarray:
    """Unit vector of square-rooted counts: byte trigrams and bigrams of the lower-cased text."""
    raw = np.frombuffer(b" " + " ".join(text.lower().split()).encode("utf-8", "replace") + b" ", dtype=np.uint8)
    counts = np.zeros(FEATURES)
    for at in range(0, len(raw), SPAN):  # parts overlap by two bytes, so every n-gram counts once
        part = raw[at : at + SPAN + 2].astype(np.uint32)
        pair = part[:-1] * np.uint32(0x9E3779B1) + part[1:] * np.uint32(0x85EBCA6B)
        triple = (pair[:-1] * np.uint32(0xC2B2AE35) + part[2:] * np.uint32(0x27D4EB2F)) >> np.uint32(20)
        counts[:BUCKETS] += np.bincount(triple, minlength=BUCKETS)
        counts[BUCKETS:] += np.bincount(pair >> np.uint32(22), minlength=FEATURES - BUCKETS)
    root = np.sqrt(counts)
    norm = np.linalg.norm(root)
    return (root / norm if norm else root).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, steps: int = 150, strength: float = 1e-3) -> np.ndarray:
    """Weights, bias last, of a linear SVM with squared hinge loss; ``y`` is 1 or -1.

    Both classes weigh the same. Accelerated gradient steps; nothing is random.
    """
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w = v = np.zeros(x.shape[1] + 1)
    rate = 1 / (2 * 2.0 + strength)
    for t in range(steps):
        # vectors of the type of x, so that x is never copied
        slack = np.maximum(0, 1 - y * (x @ v[:-1].astype(x.dtype) + v[-1]))
        pull = weight * y * slack
        gradient = strength * v - 2 * np.r_[pull.astype(x.dtype) @ x, pull.sum()]
        nxt = v - rate * gradient
        v = nxt + t / (t + 3) * (nxt - w)
        w = nxt
    return w


class Model:
    """Pairwise machines of the families, and of the languages of each family."""

    def __init__(self, x: np.ndarray, languages: list[str]):
        self.languages = sorted(set(languages))
        family = {g: FAMILY_OF.get(g, g) for g in self.languages}
        labels = np.array(languages, dtype=object)
        of = np.array([family[g] for g in languages], dtype=object)
        self.families = sorted(set(of.tolist()))
        self.members = {f: [g for g in self.languages if family[g] == f] for f in self.families}
        self.between = self._pairs(x, of, self.families)
        self.within = {f: self._pairs(x, labels, m) for f, m in self.members.items()}
        self.centres = {g: self._centre(x[labels == g]) for g in self.languages}

    @staticmethod
    def _centre(x):
        mean = x.mean(axis=0, dtype=np.float64)
        return mean / (np.linalg.norm(mean) or 1)

    @staticmethod
    def _pairs(x, labels, names):
        machines = {}
        for a, b in combinations(names, 2):
            own = np.flatnonzero((labels == a) | (labels == b))
            machines[a, b] = fit_svm(x[own], np.where(labels[own] == a, 1.0, -1.0))
        return machines

    @staticmethod
    def _choose(names, machines, x) -> tuple[str, float]:
        """Most votes, then the largest sum of margins; the score is that of its closest pair."""
        if len(names) == 1:
            return names[0], 1.0
        votes, margins, worst = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
        for (a, b), w in machines.items():
            margin = float(x @ w[:-1] + w[-1])
            for name, m in ((a, margin), (b, -margin)):
                votes[name] += m > 0
                margins[name] += m
                worst[name] = min(worst[name], m)
        best = max(names, key=lambda n: (votes[n], margins[n]))
        return best, 1 / (1 + np.exp(-4 * np.clip(worst[best], -10, 10)))

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        return self._decide(features(text))

    def _decide(self, x: np.ndarray) -> tuple[str, float]:
        family, first = self._choose(self.families, self.between, x)
        language, second = self._choose(self.members[family], self.within[family], x)
        return language, float(first * second)

    def nearness(self, text: str | None) -> tuple[str, float]:
        """The predicted language, and the cosine between the text and the middle of that language's sample."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x = features(text)
        language = self._decide(x)[0]
        return language, float(x @ self.centres[language])


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model:
    """Fit on a sample of about ``per_language`` labelled rows of each language.

    The sample is drawn by a hash of the id, at a rate by language from counts over all rows;
    at most ``2 * per_language`` rows of a language come to the fitting task, as feature vectors.
    Null and letterless texts and null languages teach nothing. Without rows every prediction
    is ``UNKNOWN``.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, lang_col).alias("h")
    )
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model(np.zeros((0, FEATURES), np.float32), [])
    space = 1 << 30
    rates = F.create_map(*[F.lit(v) for g, n in counts.items() for v in (g, int(min(1.0, per_language / n) * space))])
    drawn = rows.where(F.pmod("h", F.lit(space)) < rates[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                (g, h, features(t).astype(np.float16).tobytes())
                for g, t, h in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                if any(map(str.isalpha, t))
            ]
            columns = [pa.array([k[i] for k in kept], t) for i, t in enumerate((pa.string(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "h", "x"])

    found = drawn.mapInArrow(run, "lang string, h long, x binary")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        sample, taken = [], dict.fromkeys(counts, 0)
        for lang, _, x in sorted(rows, key=lambda r: (r[1], r[0], r[2])):
            if taken[lang] < 2 * per_language:
                taken[lang] += 1
                sample.append((lang, x))
        x = np.zeros((len(sample), FEATURES), np.float32)
        for i, (_, own) in enumerate(sample):
            x[i] = np.frombuffer(own, dtype=np.float16)
        state = vars(Model(x, [s[0] for s in sample]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], names=["model"])

    state = found.repartition(1).mapInArrow(learn, "model binary").first()
    model = Model(np.zeros((0, FEATURES), np.float32), [])
    if state is not None:
        vars(model).update(pickle.loads(state.model))
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` per row, from whole texts.

    Null texts and texts without a letter are ``und`` with score 0. Repeated rows come out as
    often as they came in, null ids stay null. No documents: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            columns = [
                batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "lang_pred", "score"])

    frame = docs.select(F.col(id_col), F.col(text_col))
    return frame.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")


def _length_class(text: str) -> int:
    return len(text.encode("utf-8", "replace")).bit_length()


def least_nearness(labelled: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> list[float]:
    """How near a text must be to its predicted language, by length class (bits of its bytes; the last is open).

    ``MARGIN`` times the least nearness of all labelled texts that long or longer whose label is predicted;
    give rows that ``model`` was not fitted on. The longest texts share a class of ``LEAST_ROWS`` rows at
    least. With fewer rows in all: empty, nothing is known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                language, near = model.nearness(text)
                if language == lang:
                    found.append((_length_class(text), near))
            columns = [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["bits", "near"])

    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col).cast("string"))
    by_class = rows.mapInArrow(run, "bits int, near double").groupBy("bits").agg(F.min("near").alias("near"), F.count("near").alias("n"))
    least, seen, limits = np.inf, 0, {}
    for row in sorted(by_class.collect(), key=lambda r: -r.bits):  # a row for each length class
        least, seen = min(least, row.near), seen + row.n
        if seen >= LEAST_ROWS:
            limits[row.bits] = MARGIN * least
    made: list[float] = []
    for bits in range(max(limits, default=-1), -1, -1):
        made.append(limits.get(bits, made[-1] if made else 0.0))
    return made[::-1]


def keep_known(docs: DataFrame, model: Model, least: list[float] | None = None, text_col: str = "text") -> DataFrame:
    """The documents that have a language and are near enough to it by ``least``; columns as they are.

    Texts of languages that were not learned are far from all that were. Without ``least`` only documents
    without a letter go. A model without languages cannot judge: all documents that have a letter stay.
    """
    at = docs.columns.index(text_col)

    def keeps(text: str | None) -> bool:
        if not model.languages or not least:
            return text is not None and any(map(str.isalpha, text))
        language, near = model.nearness(text)
        return language != UNKNOWN and near >= least[min(_length_class(text), len(least) - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([keeps(t.as_py()) for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
