"""License scans: one automaton finds identifier tags and notice phrases, expressions are evaluated.

An Aho-Corasick automaton reads the word sequence of a whole text once and finds every notice
phrase; a second one finds identifier tags in the text as it is. What follows a tag on its line
is a license expression. A shunting-yard parser turns it into postfix order (``with`` binds
closest, then ``and``, then ``or``) and the postfix form is evaluated: which licenses it names,
and whether it can be met with permissive licenses alone.
"""

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import alnum_words

# The base phrases, as words, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wordings of license notices, as lower-case words, and the license they name.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the mit": "mit",
    "released under the mit": "mit",
    "licensed under the apache": "apache",
    "apache software license": "apache",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "gnu gpl": "gpl",
    "gnu lgpl": "lgpl",
    "gnu agpl": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons": "cc",
    "licensed under cc": "cc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "public domain dedication": "cc0",
    "released into the public domain": "public-domain",
    "boost software license": "bsl",
    "the unlicense": "unlicense",
    "all rights reserved": "proprietary",
}

# Tags after which a license expression stands, in lower case.
TAGS = ("spdx-license-identifier:", "license-expression:")

# Starts of license identifiers and their labels; the longest that fits counts.
IDENTIFIERS = {
    "mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "0bsd": "bsd",
    "isc": "isc", "mpl": "mpl", "epl": "epl", "bsl": "bsl", "zlib": "zlib", "unlicense": "unlicense",
    "cc0": "cc0", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
    "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc-nd": "cc-by-nc-nd",
}

PERMISSIVE = {"mit", "apache", "bsd", "isc", "zlib", "unlicense", "cc0", "cc-by", "bsl", "public-domain"}

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.:+_-]*))")
ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}

# How sure a kind of evidence makes it that a text states a license.
TAG_WEIGHT, NOTICE_WEIGHT, BASE_WEIGHT, BROKEN_WEIGHT = 0.95, 0.8, 0.6, 0.3

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


class Broken(ValueError):
    """An expression that is not well formed."""


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: infix tokens to postfix order. Operators of one rank go from left to right."""
    out, stack, operand = [], [], True
    for token in tokens:
        kind = token.lower()
        if kind in PRECEDENCE:
            if operand:
                raise Broken(token)
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[kind]:
                out.append(stack.pop())
            stack.append(kind)
            operand = True
        elif token == "(":
            if not operand:
                raise Broken(token)
            stack.append(token)
        elif token == ")":
            if operand:
                raise Broken(token)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise Broken(token)
            stack.pop()
        else:
            if not operand:
                raise Broken(token)
            out.append(token)
            operand = False
    if operand:
        raise Broken("end")
    while stack:
        if stack[-1] == "(":
            raise Broken("(")
        out.append(stack.pop())
    return out


def license_label(identifier: str) -> str:
    """Label of an identifier such as ``Apache-2.0`` or ``GPL-2.0+``; an unknown one is its own label."""
    name = identifier.translate(ASCII_LOWER).rstrip("+")
    known = name
    while known and known not in IDENTIFIERS:
        known = known.rpartition("-")[0]
    return IDENTIFIERS.get(known, name)


def evaluate(order: list[str]) -> tuple[set[str], bool]:
    """Labels that a postfix expression names, and whether permissive licenses alone can meet it.

    ``or`` leaves the choice, ``and`` asks for both sides; ``with`` adds an exception to a license
    and keeps the license's own answer.
    """
    stack: list[tuple[set[str], bool, bool]] = []
    for token in order:
        if token not in PRECEDENCE:
            label = license_label(token)
            stack.append(({label}, label in PERMISSIVE, True))
            continue
        (right, right_ok, right_single), (left, left_ok, left_single) = stack.pop(), stack.pop()
        if token == "with":
            if not (left_single and right_single):
                raise Broken(token)
            stack.append((left, left_ok, False))
        else:
            ok = left_ok or right_ok if token == "or" else left_ok and right_ok
            stack.append((left | right, ok, False))
    labels, ok, _ = stack.pop()
    return labels, ok


def read_expression(line: str) -> tuple[str, set[str], bool] | None:
    """The expression that opens a line: its text, labels and answer; None if there is none.

    The expression ends where two names stand side by side, so prose or comment marks after it do no
    harm; operators left at its end are dropped.
    """
    tokens, ends, at = [], [], 0
    while found := TOKEN.match(line, at):
        tokens.append(found.group(1) or found.group(2))
        at = found.end()
        ends.append(at)
    # two names side by side, or a name before a bracket, end the expression
    for i in range(1, len(tokens)):
        before, now = tokens[i - 1].lower(), tokens[i].lower()
        name_before = before not in PRECEDENCE and before != "("
        name_now = now not in PRECEDENCE and now != ")"
        if name_before and name_now:
            tokens, ends = tokens[:i], ends[:i]
            break
    while tokens:
        try:
            labels, ok = evaluate(postfix(tokens))
        except Broken:
            if len(tokens) > 1 and tokens[-1].lower() in PRECEDENCE:
                tokens, ends = tokens[:-1], ends[:-1]
                continue
            return None
        return line[: ends[-1]].strip(), labels, ok
    return None


def _automaton(words: dict[str, tuple]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for word, value in words.items():
        made.add_word(word, value)
    made.make_automaton()
    return made


class Scanner:
    """Both automata; one call per text."""

    def __init__(self) -> None:
        phrases = {p: [p, BASE.get(p), NOTICES.get(p)] for p in {**BASE, **NOTICES}}
        self.phrases = _automaton({f" {p} ": tuple(v) for p, v in phrases.items()})
        self.tags = _automaton({t: (t,) for t in TAGS})

    def scan(self, text: str | None) -> dict:
        words = alnum_words(text)
        line = b" ".join([b"", *words, b""]).decode()
        hits = list(self.phrases.iter(line))
        base, starts, notices = set(), [], set()
        counted, number = 0, 0
        places = []
        for end, (phrase, base_label, notice_label) in hits:
            place = end - len(phrase) - 1  # of the blank before the phrase
            places.append((place, base_label))
            if notice_label:
                notices.add(notice_label)
        for place, base_label in sorted(places, key=lambda p: p[0]):
            number += line.count(" ", counted, place)
            counted = place
            if base_label:
                base.add(base_label)
                starts.append(number)
        expressions, tagged, answers, broken = [], set(), [], False
        raw = text or ""
        lowered = raw.encode("utf-8", "replace").translate(_LOWER).decode()
        for end, _ in self.tags.iter(lowered):
            stop = min((p for p in (raw.find(c, end + 1) for c in "\r\n") if p >= 0), default=len(raw))
            found = read_expression(raw[end + 1 : stop])
            if found is None:
                broken = True
                continue
            expressions.append(found[0])
            tagged |= found[1]
            answers.append(found[2])
        doubt = 1.0
        for weight, times in ((TAG_WEIGHT, len(set(expressions))), (BROKEN_WEIGHT, int(broken)),
                              (NOTICE_WEIGHT, len(notices)), (BASE_WEIGHT, len(base))):
            doubt *= (1 - weight) ** times
        labels = base | notices | tagged
        plain = base | notices
        allowed = all(answers) and all(p in PERMISSIVE for p in plain) if answers or plain else None
        return {
            "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None),
            "last_word": max(starts, default=None), "base_labels": sorted(base), "labels": sorted(labels),
            "expressions": expressions, "permissive": allowed, "score": 1.0 - doubt,
        }


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("expressions", T.ArrayType(T.StringType())), T.StructField("permissive", T.BooleanType()),
    T.StructField("score", T.DoubleType()),
])
_ARROW = {"long": pa.int64(), "bigint": pa.int64(), "array<string>": pa.list_(pa.string()), "boolean": pa.bool_(),
          "double": pa.float64()}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id_col`` and the columns of ``RESULT``.

    ``n_words`` and word places follow the words of :func:`alnum_words`; base phrases are those
    of ``BASE``, everywhere their words stand in a row. ``labels`` has the base labels, those of other
    notices and those named by tagged expressions. ``expressions`` keeps the expressions in text order,
    ``permissive`` says whether permissive licenses alone meet all that was found, null if nothing was.
    ``score`` is how sure it is that the text states a license: each different expression, notice
    label and base label takes its share of the doubt. Null and empty texts have no words, no
    labels and score 0; every row keeps its own result, null ids too; no documents give no rows.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *RESULT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            found = [scanner.scan(t.as_py()) for t in batch.column(1)]
            columns = [
                pa.array([f[c.name] for f in found], type=_ARROW[c.dataType.simpleString()]) for c in RESULT
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
