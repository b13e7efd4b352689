"""License scans against plain versions: word lists by a regex, expressions by recursive descent."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import licenses as L
from tests.llm.helpers import docs

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_places(text, phrases):
    words = plain_words(text)
    return sorted(
        (i, p) for p in phrases for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
    )


def plain_answer(tokens):
    """Labels and answer of a well-formed expression, by recursive descent."""
    at = 0

    def unit():
        nonlocal at
        if tokens[at] == "(":
            at += 1
            found = choice()
            at += 1
            return found
        label = L.license_label(tokens[at])
        at += 1
        if at < len(tokens) and tokens[at].lower() == "with":
            at += 2
        return {label}, label in L.PERMISSIVE

    def chain(part, sign, join):
        nonlocal at
        labels, ok = part()
        while at < len(tokens) and tokens[at].lower() == sign:
            at += 1
            more, also = part()
            labels, ok = labels | more, join(ok, also)
        return labels, ok

    def both():
        return chain(unit, "and", lambda a, b: a and b)

    def choice():
        return chain(both, "or", lambda a, b: a or b)

    return choice()


NAMES = st.sampled_from(["MIT", "GPL-2.0-only", "Apache-2.0", "LicenseRef-x", "LGPL-2.1+", "BSD-3-Clause"])
EXPRESSIONS = st.recursive(
    st.one_of(NAMES.map(lambda n: [n]), NAMES.map(lambda n: [n, "WITH", "Classpath-exception-2.0"])),
    lambda inner: st.one_of(
        st.tuples(inner, st.sampled_from(["and", "OR", "And"]), inner).map(lambda t: [*t[0], t[1], *t[2]]),
        inner.map(lambda t: ["(", *t, ")"]),
    ),
    max_leaves=8,
)


@settings(max_examples=300, deadline=None)
@given(EXPRESSIONS)
def test_expressions_against_recursive_descent(tokens):
    want = plain_answer(tokens)
    assert L.evaluate(L.postfix(tokens)) == want
    line = " " + " ".join(tokens) + "  # and some prose after"
    found = L.read_expression(line)
    assert found[1:] == want and found[0] == " ".join(tokens)


@pytest.mark.parametrize("tokens", [[], ["and"], ["MIT", "MIT"], ["(", "MIT"], ["MIT", ")"], ["MIT", "or"], ["(", ")"],
                                    ["MIT", "with", "with", "x"], ["or", "MIT"]])
def test_broken_expressions(tokens):
    with pytest.raises(L.Broken):
        L.evaluate(L.postfix(tokens))


@pytest.mark.parametrize("line, want", [
    (" MIT", ("MIT", {"mit"}, True)),
    (" GPL-2.0-or-later WITH GCC-exception-3.1 */", ("GPL-2.0-or-later WITH GCC-exception-3.1", {"gpl"}, False)),
    ("(MIT OR GPL-3.0) AND LGPL-2.1", ("(MIT OR GPL-3.0) AND LGPL-2.1", {"mit", "gpl", "lgpl"}, False)),
    ("GPL-3.0 OR MIT AND BSD-2-Clause", ("GPL-3.0 OR MIT AND BSD-2-Clause", {"mit", "gpl", "bsd"}, True)),
    (" MIT and", ("MIT", {"mit"}, True)),
    (" MIT see the file", ("MIT", {"mit"}, True)),
    (" CC-BY-NC-SA-4.0", ("CC-BY-NC-SA-4.0", {"cc-by-nc-sa"}, False)),
    (" (MIT", None), ("", None), (" -->", None), (" AND MIT", None),
])
def test_lines(line, want):
    assert L.read_expression(line) == want


TEXTS = [
    None, "", "no words about it", "Released under the MIT License.", "MIT\n license, mit-LICENSE mit license",
    "GNU General Public License, version 3. general public license", "mit mit license license",
    "Licensed under CC BY-NC 4.0.", "// SPDX-License-Identifier: (MIT OR GPL-2.0) AND Apache-2.0\ncode",
    "SPDX-License-Identifier:\nMIT", "spdx-license-identifier: MIT\r\nSPDX-License-Identifier: MIT",
    "submit license", "mit licenses", "Ämit license", "word " * 50_000 + "apache license", "MIT\x00License",
]


def test_against_plain_version(spark):
    frame = docs(spark, TEXTS)
    rows = L.scan_licenses(frame.unionByName(frame.where("doc_id = 3"))).collect()
    assert sorted(r.doc_id for r in rows) == sorted([*range(len(TEXTS)), 3])
    for r in rows:
        text = TEXTS[r.doc_id]
        places = plain_places(text, L.BASE)
        assert r.n_words == len(plain_words(text)) and r.n_base == len(places)
        assert r.first_word == min((i for i, _ in places), default=None)
        assert r.last_word == max((i for i, _ in places), default=None)
        base = {L.BASE[p] for _, p in places}
        assert r.base_labels == sorted(base)
        notices = {L.NOTICES[p] for _, p in plain_places(text, L.NOTICES)}
        tagged = set().union(*(found[1] for line in re.findall("(?i)spdx-license-identifier:([^\r\n]*)", text or "")
                               if (found := L.read_expression(line))))
        assert r.labels == sorted(base | notices | tagged)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels or "spdx" in (text or "").lower())
    found = {r.doc_id: r for r in rows}
    assert found[8].expressions == ["(MIT OR GPL-2.0) AND Apache-2.0"] and found[8].permissive
    assert found[5].permissive is False and found[2].permissive is None
    assert found[7].labels == ["cc", "cc-by", "cc-by-nc"]
    assert L.scan_licenses(frame.where("false")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["mit", "license", "MIT", "apache", "general", "public", "x", "é"]), max_size=12),
       st.sampled_from([" ", "-", "\n", " ", "\x7f"]))
def test_places(words, gap):
    text = gap.join(words)
    found = L.Scanner().scan(text)
    places = plain_places(text, L.BASE)
    assert (found["n_words"], found["n_base"]) == (len(plain_words(text)), len(places))
    assert found["first_word"] == (places[0][0] if places else None)
