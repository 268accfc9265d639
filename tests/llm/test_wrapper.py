"""Trees, matching, induced templates and whole pages."""

import html
import re
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import wrapper
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, tables

SCHEMA = "page_id bigint, url string, html string"


def plain_article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = (html.unescape(re.sub(r"</?b>", "", p)) for p in re.split(r"</?(?:p|h1|br)>", inner))
    return "\n".join(t for t in (re.sub(r"\s+", " ", p).strip() for p in parts) if t)


def test_query_on_small_tables(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op2_html"](spark, SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        want = plain_article(p.html)
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (want, len(want))


def test_template_is_what_pages_of_a_host_share(spark, tmp_path):
    def page(i):
        return (
            f"<body><div>Home of everything</div><div><p>Story {i} tells</p><p>Shared line</p></div>"
            f"<div>All rights {'A' if i % 2 else 'B'}</div></body>"
        )

    rows = [(i, "http://x.test/a" if i % 3 else "http://X.test/b", page(i)) for i in range(12)]
    rows += [(100, "http://alone.test/", "<div>Home of everything</div><p>Only</p>")]
    folder = tables(tmp_path, pages=spark.createDataFrame(rows, SCHEMA))
    got = {r.page_id: r.text for r in QUERIES["op2_html"](spark, folder).collect()}
    assert all(got[i].startswith(f"Story {i} tells") for i in range(12))
    assert not any("Home" in got[i] or "rights" in got[i] for i in range(12))
    assert got[100] == "Home of everything\nOnly"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><h1>T</h1><p>a  b\n c<p>d &amp; &#233;&nbsp;f<ul><li>x<li>y</ul></article><p>out", "T\na b c\nd & é f\nx\ny"),
        ("<main><header><h2>H</h2></header>text<aside>no</aside><div class='comments'>no</div>more</main>", "H\ntext\nmore"),
        ("<div id=content>one<br>two <b>bold <i>x</b> y</i></div><div class=\"cookie-notice\">no</div>", "one\ntwo bold x y"),
        ("<article>a<script>var x='</p><p>no';</script><style>p{}</style><!-- no --><form>no</form>b</article>", "a\nb"),
        ("<nav>no</nav><p title='a > b'>yes</p><footer>no", "yes"),
        ("plain text &lt;p&gt;", "plain text <p>"),
        ("<article>one</article><article>two</article>", "one\ntwo"),
        ("<p>unclosed <b", "unclosed"),
        (None, ""),
        ("", ""),
        ("<><<<//", "<><<<//"),
    ],
)
def test_single_pages(page, want):
    assert wrapper.main_text(page, wrapper.Wrapper(None)) == want


def test_nulls_repeats_long_pages_and_empty_table(spark, tmp_path):
    long = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    deep = "<div>" * 5_000 + "core"
    rows = [(1, None, None), (2, "no address", ""), (3, "http://l.test", long), (3, "http://l.test", long)]
    rows += [(None, "http://d.test", deep), (5, "http://d.test", "<article>x</article>")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS host", "2 AS wrapper")
    got = QUERIES["op2_html"](spark, tables(tmp_path / "a", pages=frame)).collect()
    texts = sorted((r.page_id or 0, r.text) for r in got)
    whole = "\n".join(["word"] * 30_000)
    assert texts == [(0, "core"), (1, ""), (2, ""), (3, whole), (3, whole), (5, "x")]
    empty = tables(tmp_path / "b", pages=spark.createDataFrame([], SCHEMA))
    assert QUERIES["op2_html"](spark, empty).count() == 0


def test_salted_join_gives_the_same(spark, monkeypatch):
    want = sorted(map(tuple, QUERIES["op2_html"](spark, SMALL).collect()))
    monkeypatch.setattr(wrapper, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, QUERIES["op2_html"](spark, SMALL).collect())) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<body class='no-sidebar'><p>text</p></body>", "text"),
        ("<body class='sidebar'><p>text</p></body>", "text"),
        ("<div class='content has-sidebar'><article>a</article></div>", "a"),
        ("<div class='sidebar'><article>a</article></div>", "a"),
        ("<article class='post comments comments-open'>a</article>", "a"),
        ("<div id='social-history'>a</div>", "a"),
        ("<form><div class='widget'><p>most of the text</p></div><p>end</p></form>", "most of the text\nend"),
        ("<div class='menu'><a href=x>many long links</a></div><p>text</p>", "text"),
        ("<p>x <math>y</math> <button>z</button> <textarea>a&amp;b</textarea></p>", "x y z a&b"),
    ],
)
def test_names_do_not_take_the_content(page, want):
    assert wrapper.main_text(page, wrapper.Wrapper(None)) == want


def page_of(body):
    return f"<body><div>Site line of all pages</div>{body}<div>All rights kept</div></body>"


def read_pages(spark, folder, pages):
    rows = [(i, f"http://c.test/{i}", h) for i, h in enumerate(pages)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = QUERIES["op2_html"](spark, tables(folder, pages=frame)).collect()
    return [r.text for r in sorted(got)]


def test_copies_and_headings_are_no_template(spark, tmp_path):
    def body(i, heading):
        return page_of(f"<div><h2>{heading}</h2><p>Story {i} first</p><p>Story {i} second</p></div>")

    heads = ["Introduction", "Background", "Notes", "Method", "Summary"]
    pages = [body(i, heads[i % 5]) for i in range(20)]
    copies = [body(100, "Copied")] * 10
    mirror = [body(100, "Copied").replace("<body>", f"<body data-m='{i}'>") for i in range(4)]
    got = read_pages(spark, tmp_path / "a", pages + copies + mirror)
    want = [f"{heads[i % 5]}\nStory {i} first\nStory {i} second" for i in range(20)]
    assert got == want + ["Copied\nStory 100 first\nStory 100 second"] * 14
    twice = [body(i, f"Head {i}") for i in range(4)] * 2
    got = read_pages(spark, tmp_path / "b", twice)
    assert got == [f"Head {i}\nStory {i} first\nStory {i} second" for i in range(4)] * 2


def test_slots_decide_inside_and_outside_of_articles(spark, tmp_path):
    pages = [
        f"<body><div>Site line</div><div><p>Body {i} one</p><p>Body {i} two</p></div>"
        f"<article><p>Teaser {i}</p><p>Tell your friends</p></article></body>"
        for i in range(8)
    ]
    got = read_pages(spark, tmp_path, pages)
    assert got == [f"Body {i} one\nBody {i} two\nTeaser {i}" for i in range(8)]


def test_teasers_counters_and_dates_outside_of_articles_go(spark, tmp_path):
    pages = [
        f"<body><div>Site line</div><div>2024-03-{10 + i}</div><article><p>Story {i} begins here.</p>"
        f"<p>Share this</p><p>Story {i} ends here.</p></article><div>Views {526635 + i * 7}</div>"
        f"<div>Read next: <a href=x>another long story about number {i * 3} and more of it</a></div></body>"
        for i in range(12)
    ]
    got = read_pages(spark, tmp_path, pages)
    assert got == [f"Story {i} begins here.\nStory {i} ends here." for i in range(12)]


def test_pages_without_articles_keep_their_slots(spark, tmp_path):
    pages = [
        f"<body><div><div>Site line</div><div>Log in</div></div><div><h1>Title {i}</h1><div>Part {i} a</div>"
        f"<div>Part {i} b</div></div><div>All rights kept</div></body>"
        for i in range(9)
    ]
    got = read_pages(spark, tmp_path, pages)
    assert got == [f"Title {i}\nPart {i} a\nPart {i} b" for i in range(9)]


def test_alignment_of_long_pages_is_whole(spark, tmp_path):
    def page(i, n):
        body = "".join(f"<p>Line {k} of {i}</p>" + ("<h2>Part %d</h2>" % i) * (k % 90 == i) for k in range(n))
        return f"<body><div>Top</div>{body}<div>More</div><div>Follow us</div></body>"

    got = read_pages(spark, tmp_path, [page(i, 450 + 60 * i) for i in range(6)])
    for i, text in enumerate(got):
        lines = text.split("\n")
        assert sum(t.startswith("Line") for t in lines) == 450 + 60 * i
        assert not {"Top", "More", "Follow us"} & set(lines)


def test_linear_memory_alignment_is_heaviest():
    import numpy as np

    draw = np.random.default_rng(1)
    for _ in range(60):
        weights = draw.integers(0, 4, (4, 5))
        left, right = draw.integers(0, 4, draw.integers(0, 14)), draw.integers(0, 5, draw.integers(0, 14))

        def total(cells):
            pairs = wrapper.align(left, right, weights, cells)
            assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
            return sum(weights[left[i], right[j]] for i, j in pairs)

        assert total(1) == total(10**6)


trees = st.recursive(
    st.sampled_from("ab").map(lambda t: (t, ())),
    lambda kids: st.tuples(st.sampled_from("ab"), st.lists(kids, max_size=3).map(tuple)),
    max_leaves=7,
)


@settings(max_examples=150, deadline=None)
@given(trees, trees)
def test_matching_is_largest(a, b):
    @cache
    def size(x, y):
        return 0 if x[0] != y[0] else 1 + forest(x[1], y[1])

    @cache
    def forest(xs, ys):
        if not xs or not ys:
            return 0
        return max(forest(xs[1:], ys), forest(xs, ys[1:]), forest(xs[1:], ys[1:]) + size(xs[0], ys[0]))

    def rows(tree):
        out = []

        def walk(node, parent):
            own = len(out)
            out.append((own, parent, node[0], None))
            for child in node[1]:
                walk(child, own)

        walk(tree, -1)
        return out

    left, right = rows(a), rows(b)
    found = wrapper.match(left, right)
    assert len(found) == size(a, b)
    assert all(left[x][2] == right[y][2] for x, y in found.items())
    assert all(left[x][1] == -1 or found[left[x][1]] == right[y][1] for x, y in found.items())
