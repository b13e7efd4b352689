import html
import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmill.llm import wrapper as W

KIND = "page_id long, url string, html string"


def page(title, body, menu="", tail=""):
    return (
        f'<!DOCTYPE html><html lang="en"><head><title>{title}</title><style>p{{margin:0}}</style>'
        f'<script>var t="</p>";track(0);</script></head><body><nav><ul>{menu}</ul></nav><!-- ad --><div class="ad">Buy {title}</div>'
        f"<article><h1>{title}</h1>{body}</article><footer>&copy; x &middot; {title}</footer>{tail}"
    )


@pytest.mark.parametrize(
    "source,text",
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
        (page("T", "<p>a <b>b</b>c<br>d</p><p> e\n f"), "T a bc d e f"),
        (page("T", "<p><b>a<br><p>b</p>"), "T a b"),
        ("<body><header><h1>Site</h1></header><main><p>x</p><aside>y</aside></main></body>", "x"),
        ("<article><header><h1>Title</h1></header><p>x</p><div class='social-share'>s</div><section id=comments>c</section></article>", "Title x"),
        ("<div class='with-sidebar'><article>a</article></div><article class='comment'>no</article>", "a"),
        ("<p>one<p>two<!-- no --><form>q</form><![CDATA[z]]>", "one two"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
        ("<p title='a>b'>x &#233;&nbsp;y</p>", "x é y"), ("<p class=\"a>x</p>", "x"), ("a < b and <c", "a < b and <c"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<script>never ends <p>x", ""),
    ],
)
def test_single_pages(source, text):
    assert W.main_text(source) == text


@pytest.mark.parametrize(
    "source,text",
    [
        ("<div class='content with-sidebar'><p>All of the text.</p></div>", "All of the text."),
        ("<div id='notice-of-meeting'><p>The meeting is on Monday at noon.</p></div><div class=notice>x</div>", "The meeting is on Monday at noon."),
        ("<main><h1>Head</h1><p>Lede</p><article>Body</article></main><div>Site</div>", "Head Lede Body"),
        ("<div>The story goes on for a long while.</div><article>Teaser</article><article>Other</article>",
         "The story goes on for a long while. Teaser Other"),
        ("<h1>Head</h1><article>Body of the story</article><div>Site</div>", "Head Body of the story"),
        ("<main>one</main><main>two</main>", "one two"),
        ("<article><p>Story</p><ul class='responses'><li>first!</ul></article>", "Story"),
        ("<div class='no-comments search-results'><p>a b</p></div>", "a b"),
        ("<form id=aspnet><div><p>" + "word " * 60 + "</p></div></form>", ("word " * 60).strip()),
        ("<p>Sign in</p><form>User name and secret word, please</form>", "Sign in"),
        ("<p>Short.</p><div class=comments>A reader writes much more than that.</div>", "Short."),
    ],
)
def test_names_and_regions(source, text):
    assert W.main_text(source) == text


def blocks_of(source):
    return W.outline(source)[1]


def plain_matching(a, b):
    """Simple tree matching as its recurrence says it."""
    if a.key != b.key:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[:-1], ys), best(xs, ys[:-1]), best(xs[:-1], ys[:-1]) + plain_matching(xs[-1], ys[-1]))

    return 1 + best(a.elements, b.elements)


def random_blocks(rng, size):
    blocks = [[-1, "r", "0"]]
    for i in range(1, size):
        blocks.append([rng.choice([len(blocks) - 1, rng.randrange(len(blocks))]), rng.choice("ab"), str(rng.randrange(3))])
    order, children = [], {}
    for i, (parent, _, _) in enumerate(blocks):
        children.setdefault(parent, []).append(i)
    stack, place = [0], {-1: -1}
    while stack:  # page order
        i = stack.pop()
        place[i] = len(order)
        order.append([place[blocks[i][0]], *blocks[i][1:]])
        stack.extend(reversed(children.get(i, [])))
    return order


@pytest.mark.parametrize("cells", [4_000_000, 1])
def test_matching_against_its_recurrence(monkeypatch, cells):
    monkeypatch.setattr(W, "TABLE_CELLS", cells)
    rng = random.Random(3)
    for _ in range(150):
        a, b = W.tree(random_blocks(rng, rng.randrange(1, 12))), W.tree(random_blocks(rng, rng.randrange(1, 12)))
        weight = plain_matching(a[0], b[0])
        pairs = list(W.aligned(a[0], b[0]))
        assert W.matching(a[0], b[0], {}) == weight == len(pairs)
        left, right = [x.index for x, _ in pairs], [y.index for _, y in pairs]
        assert len(set(left)) == len(set(right)) == weight and all(x.key == y.key for x, y in pairs)
        assert [y for _, y in sorted(zip(left, right))] == sorted(right)  # order is kept
        parent = lambda t: {k.index: n.index for n in t for k in n.elements}
        pa, pb, to = parent(a), parent(b), dict(zip(left, right))
        assert all(x == 0 or to[pa[x]] == pb[y] for x, y in to.items())  # parents are kept


def induce(pages):
    """Wrapper of pages of one shape, one page after the other."""
    pages = list(dict.fromkeys(pages))
    made = sorted((W.outline(p) for p in pages), key=lambda m: len(m[1]))
    shape, blocks, texts = made[(len(made) - 1) // 2]
    counts = Counter(i for m in made for i in W.agreeing(W.tree(blocks), W.tree(m[1])))
    found = W.learn(blocks, texts, counts, len(pages))
    return found and W.Wrapper(json.dumps(found))


def host_pages(n, host="h", lines=1):
    """Pages without an article element; the template is told by alignment alone."""
    return [
        f"<html><body><div>Welcome to {host}</div><div><p>Home</p><p>About</p></div><div id=x{0}>"
        f"<p>Story {i} of {host} goes on for a while {i * 7}.</p>" + "".join(f"<p>Line {k} of {i}.</p>" for k in range(lines))
        + "</div><div>All rights reserved</div></body></html>"
        for i in range(n)
    ]


def test_constant_nodes_are_template():
    wrapper = induce(host_pages(6))
    assert W.main_text(host_pages(9)[8], wrapper) == "Story 8 of h goes on for a while 56. Line 0 of 8."
    assert induce(host_pages(1)) is None and induce(host_pages(2)) is None and induce(host_pages(1) * 5) is None


@pytest.mark.parametrize("lines", [20, 500, 4100])
def test_template_goes_from_pages_of_any_size(lines):
    wrapper = induce(host_pages(4, lines=lines))
    text = W.main_text(host_pages(6, lines=lines + 7)[5], wrapper)
    assert text.startswith("Story 5") and text.endswith(f"Line {lines + 6} of 5.") and text.count("Line") == lines + 7


def test_deep_pages_are_aligned():
    deep = [f"<div>Menu</div>{'<div>' * 2500}<p>Text {i} itself</p>{'</div>' * 2500}<div>Foot</div>" for i in range(4)]
    assert W.main_text(deep[3], induce(deep)) == "Text 3 itself"


def plain(source):
    """The article of well-formed pages, by patterns."""
    own = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1]
    own = re.sub(r"</?(p|h1|br)\b[^>]*>", " ", own)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", own)).split())


def test_all_pages_of_hosts(spark):
    rows = []
    for i in range(120):
        host = "http://big.example/" if i % 3 else f"https://User@H{i % 7}.example:80/"
        body = "".join(f"<p>Line {i} {k} &eacute; <b>bold</b>" for k in range(i % 9 + 1)) + "<p>Common line.</p>"
        rows.append((i, f"{host}{i}", page(f"Title {i}", body, menu=f"<li>{i}</li>")))
    rows += [(200, None, page("N", "<p>x</p>")), (201, "http://big.example/x", None), (202, "", ""), (None, "http://big.example/y", rows[1][2])]
    rows += [(300 + i, f"http://plain.example/{i}", s) for i, s in enumerate(host_pages(10, "plain"))]
    # copies of one page and pages of another shape do not hide a template
    rows += [(400 + i, "http://plain.example/copy", host_pages(1, "plain")[0]) for i in range(60)]
    rows += [(500 + i, f"http://plain.example/odd{i}", f"<section>Error {i} here</section>") for i in range(2)]
    frame = spark.createDataFrame(rows, KIND)
    frame = frame.unionByName(frame.where("page_id = 5")).withColumns({"text": F.lit("clash"), "_host": F.lit("y")})
    got = W.extract_main_text(frame).collect()
    assert len(got) == len(rows) + 1
    by_id = {r.page_id: r for r in got}
    for i, url, source in rows[:120]:
        assert by_id[i].url == url and by_id[i].text == plain(source)
    assert by_id[201].text == by_id[202].text == "" and by_id[None].text == plain(rows[1][2])
    assert by_id[304].text == "Story 4 of plain goes on for a while 28. Line 0 of 4."
    assert {by_id[400 + i].text for i in range(60)} == {"Story 0 of plain goes on for a while 0. Line 0 of 0."}
    assert by_id[501].text == "Error 1 here"
    assert W.extract_main_text(frame.where("false")).count() == 0


def test_long_pages_are_whole():
    body = "".join(f"<p>w{i}</p>" for i in range(20_000))
    wrapper = induce([page("A", "<p>1</p><div><p>2</p></div>"), page("B", "<p>3</p>"), page("C", "<p>3</p><p>5</p>")])
    assert W.main_text(page("T", body), wrapper).split() == ["T", *(f"w{i}" for i in range(20_000))]
