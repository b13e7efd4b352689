"""Secret scans: fixed patterns, and values in a credential context that are costly to guess.

The cost of guessing a value is that of its cheapest segmentation into words, dates, repeats,
keyboard or alphabet walks and brute-force characters, found by dynamic programming. Costs are
binary logarithms of guesses, so those of the segments add up.
"""

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order of their kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "guess")
SCHEMA = "kind string, start long, end long, value_start long, value_end long, guess_bits double"

#: A name that announces a credential, and what is assigned to it or follows it.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|(?:access|private|signing|encryption)[_-]?key"
    r"|credentials?|authorization|bearer)[\w-]*+[\"']?"
    r"(?:(?:[^\S\r\n]*+|\s{0,4})(?:=>|:=|[:=])(?:[^\S\r\n]*+|\s{0,4})|\s(?=bearer|basic))"
    r"(?:(?:bearer|basic)\s)?(?:\"([^\"\r\n]{6,})\"|'([^'\r\n]{6,})'|([^\s\"'<>,;(){}\[\]]{6,}))",
    re.ASCII | re.IGNORECASE,
)
CUES = (b"password", b"passwd", b"passphrase", b"passcode", b"pwd", b"secret", b"token", b"api", b"key",
        b"credential", b"authorization", b"bearer")
_CUE_WITH_SIGN = re.compile(
    rb"(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|(?:access|private|signing|encryption)[_-]?key"
    rb"|credential|authorization|bearer)"
)
GUESS_BITS = 10 * math.log2(10)

# Common words of passwords and placeholders, most frequent first.
WORDS = """
password pass admin secret welcome login user test example changeme default master root guest qwerty love
monkey dragon letmein sunshine princess football baseball shadow superman batman trustno iloveyou hello freedom
whatever starwars computer internet server system service access token key api private public client
database demo sample dummy placeholder value string your my the this here none null true false undefined
insert replace enter todo xxx foo bar baz temp temporary summer winter spring autumn monday friday january
december correct horse battery staple secure security account manager office company google home house money
""".split()
WORD_BITS = {w: math.log2(i + 2) for i, w in enumerate(WORDS)}
LEET = str.maketrans("0134578@$!+", "oieastbasit")
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "qazwsxedcrfvtgbyhnujmikolp", "abcdefghijklmnopqrstuvwxyz",
         "0123456789", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p")
CHAR_BITS = math.log2(10)
SEGMENT_BITS = 1.0
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"
                  r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)", re.ASCII)  # fmt: skip
DATE_BITS = math.log2(365 * 60)
YEAR_BITS = math.log2(120)
DATE_LENGTHS = (4, 6, 7, 8, 9, 10)
WALK_BITS = math.log2(47 * 4)
_NEXT = {(a, b) for w in WALKS for a, b in zip(w, w[1:], strict=False)}
_NEXT |= {(b, a) for a, b in _NEXT}


def _case_bits(text: str) -> float:
    """What capitals add to a word: nothing, one bit at an end or throughout, else their places."""
    upper = sum(c.isupper() for c in text)
    if not upper:
        return 0.0
    if upper == len(text) or (upper == 1 and (text[0].isupper() or text[-1].isupper())):
        return 1.0
    return math.log2(sum(math.comb(len(text), i) for i in range(1, min(upper, len(text) - upper) + 1)) + 1)


class Dictionary:
    """Words and the binary logarithm of their rank: the fixed list, and the words of a public vocabulary.

    In a byte-level vocabulary a token that begins with a blank and has only letters is a word, and
    ids rise as words get rarer. The file is read when the first word is looked up.
    """

    def __init__(self, path: str | None = None):
        self.path, self.bits, self.longest = path, None, 0

    def load(self) -> "Dictionary":
        if self.bits is None:
            self.bits = {}
            if self.path is not None:
                with open(self.path, encoding="utf-8") as file:
                    vocabulary = json.load(file)["model"]["vocab"]
                for token, rank in vocabulary.items():
                    word = token[1:].lower()
                    if token[0] == "\u0120" and len(word) >= 3 and word.isascii() and word.isalpha():
                        self.bits[word] = min(self.bits.get(word, math.inf), math.log2(rank + 2))
            self.bits |= WORD_BITS
            self.longest = max(map(len, self.bits))
        return self

    def holds(self, word: str) -> bool:
        return word.lower() in self.load().bits


FIXED = Dictionary()


class _Runs:
    """Starts from which a segment of a growing run may begin, each with the cost up to there.

    A segment of a run costs a constant and the logarithm of its length. What a later start gains by
    that over an earlier one is greatest for the shortest segment and shrinks from there, so a start
    that costs more by then never wins; and an earlier start that costs no less than a later one never
    does. Few starts are left, whatever the length of the run.
    """

    def __init__(self, shortest: int):
        self.shortest, self.starts = shortest, []

    def add(self, start: int, cost: float) -> None:
        for s, c in self.starts:
            if cost >= c + math.log2((start - s + self.shortest) / self.shortest):
                return
        self.starts = [(s, c) for s, c in self.starts if c < cost] + [(start, cost)]

    def best(self, end: int, unit: int) -> float:
        return min((c + math.log2((end - s) // unit) for s, c in self.starts), default=math.inf)


def guess_bits(value: str, words: Dictionary = FIXED, _known: dict[str, float] | None = None) -> float:
    """Binary logarithm of the guesses that the cheapest segmentation of a whole value takes.

    Segments are words (plain, reversed, with signs for letters, with capitals), dates, walks of three
    or more keys, three or more equal characters, units of two to eight characters that come twice
    or more (the unit costs what it costs alone), and brute-force spans. All of them, at every
    place and of every length, take part.
    """
    n = len(value)
    known = {} if _known is None else _known
    table = words.load().bits
    lower = value.lower() if len(value.lower()) == n else value
    plain = lower.translate(LEET)
    cost = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)
    # by kind of run (0 walks, 1 equal characters, p units of p): the run's begin, and its starts by their
    # place in a unit
    begin = [0] * 9
    runs: list[dict[int, _Runs]] = [{} for _ in range(9)]

    def step(kind: int, end: int, goes_on: bool, least: int, unit: int, fixed) -> None:
        """Let the run of a kind grow to ``end`` and take its cheapest segment that ends there."""
        nonlocal best
        if not goes_on:
            begin[kind] = end - unit
            runs[kind] = {}
        start = end - least * unit
        if start < begin[kind]:
            return
        own = runs[kind].setdefault(end % unit, _Runs(least * unit))
        own.add(start, cost[start])
        best = min(best, own.best(end, unit) + fixed() + SEGMENT_BITS)

    for end in range(1, n + 1):
        last = end - 1
        # a brute-force character joins a run of such or begins one
        best = brute[end] = min(brute[last], cost[last] + SEGMENT_BITS) + CHAR_BITS
        for length in range(3, min(words.longest, end) + 1):
            word = plain[end - length : end]
            for form, extra in ((word, 0.0), (word[::-1], 1.0)):
                bits = table.get(form)
                if bits is not None:
                    leet = 0.0 if lower[end - length : end] == word else 1.0
                    case = _case_bits(value[end - length : end])
                    best = min(best, cost[end - length] + bits + extra + leet + case + SEGMENT_BITS)
        if value[last].isdigit():
            for length in DATE_LENGTHS:
                if length <= end and (m := DATE.fullmatch(value, end - length, end)):
                    bits = YEAR_BITS if length == 4 else DATE_BITS + (2.0 if m[1] or m[2] else 0.0)
                    best = min(best, cost[end - length] + bits + SEGMENT_BITS)
        walks = last > 0 and (lower[last - 1], lower[last]) in _NEXT
        step(0, end, walks, 3, 1, lambda: WALK_BITS)
        step(1, end, last > 0 and value[last] == value[last - 1], 3, 1, lambda: CHAR_BITS)
        for p in range(2, 9):
            def unit_bits(unit: str = value[max(end - p, 0) : end]) -> float:
                if unit not in known:
                    known[unit] = guess_bits(unit, words, known)
                return known[unit]

            step(p, end, last >= p and value[last] == value[last - p], 2, p, unit_bits)
        cost[end] = best
    return cost[n]


def base_spans(text: str) -> list[tuple]:
    """Matches of the fixed patterns: kind, start, end, start and end of the value."""
    found = [("assign", *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return found


def is_prose(value: str, words: Dictionary) -> bool:
    """Several words, all of them of the dictionary or of one or two letters."""
    parts = [p.strip(".,;:!?()") for p in value.split()]
    return len(parts) > 1 and all(p.isalpha() and (len(p) <= 2 or words.holds(p)) for p in parts if p)


def guessed_spans(text: str, base: list[tuple], bits: float = GUESS_BITS, words: Dictionary = FIXED) -> list[tuple]:
    """Values in a credential context that take ``bits`` or more and that no base span holds whole.

    Words in a row are hard to guess as well, but a sentence is no secret: it counts only where the
    name says that it is a passphrase.
    """
    found = []
    for m in CONTEXT.finditer(text):
        start, end = next(m.span(k) for k in (1, 2, 3) if m[k] is not None)
        if any(s <= start and end <= e for _, s, e, _, _ in base):
            continue
        value = text[start:end]
        if is_prose(value, words) and not m[0].lower().startswith("passphrase"):
            continue
        if guess_bits(value, words) >= bits:
            found.append(("guess", m.start(), end, start, end))
    return found


_HEX_TABLE = bytes(ord("h") if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def may_hold_secret(text: str) -> bool:
    """False only if no pattern can match; three plain searches through the bytes."""
    raw = text.encode("utf-8", "replace")
    lower = raw.lower()
    return (
        (any(c in lower for c in CUES) and _CUE_WITH_SIGN.search(lower) is not None)
        or b"AKIA" in raw
        or b"h" * 24 in raw.translate(_HEX_TABLE)
    )


def spans(text: str | None, bits: float = GUESS_BITS, words: Dictionary = FIXED) -> list[tuple]:
    """All spans of a whole text by start, then kind, with the cost of each value."""
    if not text or not may_hold_secret(text):
        return []
    base = base_spans(text)
    found = base + guessed_spans(text, base, bits, words)
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return [(*s, guess_bits(text[s[3] : s[4]], words)) for s in found]


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: float = GUESS_BITS,
    vocabulary: str | None = None,
) -> DataFrame:
    """``id_col, secrets``: an array of ``SCHEMA`` structs per row, empty where there are none.

    Places are code points, ends exclusive. Null and empty texts have none. Repeated rows come
    out as often as they came in, null ids stay null. Texts of any length are scanned whole.
    ``vocabulary`` is the file of a byte-level vocabulary, whose words join the dictionary.
    """
    # what is broadcast stays with a worker, and so do the words once they are read
    words = docs.sparkSession.sparkContext.broadcast(Dictionary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [pa.string(), *[pa.int64()] * 4, pa.float64()]
        kind = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))
        for batch in batches:
            found = [
                [dict(zip(names, s, strict=True)) for s in spans(t.as_py(), bits, words.value)] for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=[id_col, "secrets"])

    frame = docs.select(F.col(id_col), F.col(text_col))
    fields = ", ".join(f.replace(" ", ": ") for f in SCHEMA.split(", "))
    return frame.mapInArrow(
        run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, secrets array<struct<{fields}>>"
    )


def redacted(text: str | None, mark: str = "[SECRET]", words: Dictionary = FIXED) -> str | None:
    """The text with the value of each secret replaced; values that overlap are one."""
    values = sorted((s[3], s[4]) for s in spans(text, words=words))
    if not values:
        return text
    parts, at = [], 0
    for start, end in values:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(
    docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", vocabulary: str | None = None
) -> DataFrame:
    """The documents with secret values replaced by ``mark``; all other columns as they are."""
    words = docs.sparkSession.sparkContext.broadcast(Dictionary(vocabulary))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            clean = pa.array([redacted(t.as_py(), mark, words.value) for t in column], type=column.type)
            columns = [clean if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
