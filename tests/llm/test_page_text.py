"""Main text of pages: the parser on odd markup, line alignment and the whole operator against brute force."""

import collections
import html
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import queries
from tessera.llm.page_text import OPEN, PROTECTED, common_lines, page_lines, page_texts, url_place
from tessera.session import table

SCHEMA = "page_id long, url string, html string, _node string, blocks int, _host string, text string"


def texts(page):
    return [t for t, _ in page_lines(page)]


@pytest.mark.parametrize("page, want", [
    (None, []), ("", []), (" \n ", []), ("plain &lt;text&gt;\n here", ["plain <text> here"]),
    ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]),
    ("<title>no</title><body><script>var x='</p><p>no';</script><p>yes", ["yes"]),
    ("<p>x</p><script>never closed <p>no", ["x"]), ("<p>x<!-- open comment <p>no", ["x"]),
    ("<p>a</p><style>no</style><!-- <p>no</p> --><p>b</p><p cut=", ["a", "b"]),
    ("<nav>no</nav><header>no</header><article><header><h1>T</h1></header><p>one <b>two</b></article><p>out</p><footer>no", ["T", "one two"]),
    ("<main><h1>T</h1><div class='cookie-notice'>no</div><p>x</main><p>out", ["T", "x"]),
    ("<article><p>a<aside>no</aside><form>no<p>no</form><p class='AdBanner'>no<p>b</article>", ["a", "b"]),
    ("<article><p>a<div id=comments><p>no<article><p>no</article></div></article>", ["a"]),
    ("<article><p>a</p><article><p>a reader</article></article>", ["a"]),
    ("<div class=ad>no<article><p>a</article>", ["a"]),
    ("<div class=sidebar><article><p>teaser</article></div><p>a", ["a"]),
    ("<body class='has-sidebar no-ads'><p class='shadow readers'>a", ["a"]),
    ("<article class='post tag-ads comments-open no-sidebar'><div class=header><p>a</div></article>", ["a"]),
    ("<article class='comment'><p>no</article><p>a", ["a"]),
    ("<div class=header>no</div><div id=siteHeader>no</div><div class='entry-header'>T</div><p>a", ["T", "a"]),
    ("<p hidden>no<p style='color:red; display: none'>no<p>a", ["a"]),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><th>e</table>", ["a", "b", "c d", "e"]),
    ("<p>1 < 2 && 3 > 2 &copy; &am", ["1 < 2 && 3 > 2 © &am"]),
    ("<div role=navigation>no</div><div role=main><p>a</div>b", ["a"]),
    ("a&nbsp;\t b</i></div></article>c", ["a bc"]),
    ('<p title="a > b">c</p><p title="open>d</p>', ["c", "d"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_kinds():
    got = page_lines("<article><p>prose</p><div>Share this</div><p><a href=x>only a link</a></p><p>a <a href=x>link</a> in prose</p></article>")
    assert got == [("prose", PROTECTED), ("Share this", OPEN), ("only a link", OPEN), ("a link in prose", PROTECTED)]


def test_long_page_in_linear_time():
    page = "<div>" * 3000 + "<p>x <b>y" * 30000 + '<a "' * 2000
    assert len(page_lines(page)) == 30000


def dp(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(rows[-1][j] + 1 if x == y else max(row[j], rows[-1][j + 1]))
        rows.append(row)
    return rows[-1][-1]


@pytest.mark.parametrize("most_bits", [1 << 24, 1, 40])
def test_common_lines(most_bits):
    rng = random.Random(most_bits)
    for _ in range(300):
        a, b = ([rng.randrange(rng.choice([2, 6, 40])) for _ in range(rng.randrange(25))] for _ in "ab")
        at = common_lines(a, b, most_bits)
        assert at == sorted(set(at)) and len(at) == dp(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in at)  # a subsequence of b


def test_url_place():
    assert url_place("https://www.A.example/x/9.html#f") == url_place("http://a.example/x/9") == ("a.example", "/x/0019?")
    assert url_place("http://h/x/9")[1] < url_place("http://h/x/10")[1] < url_place("http://h/x/100/")[1]
    assert url_place(None) == url_place("no url") == (None, "")


def fixture():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for i in range(90):
        host = "hot.example" if i % 3 == 0 else f"h{i % 4}.example"
        site = f"<div>Welcome to {host}</div><div>Menu of {host} {i % 2}</div>"
        end = f"<div>Read our terms, {host}</div><span>Call us</span>"
        if i % 5 == 0:
            body = f"<article><h1>Common title</h1><p>Shared passage of many articles.</p><div>Share {host}</div><p>{prose(8)}</p></article>"
        else:
            body = "".join(f"<div>{prose(rng.randrange(4, 19))}</div>" for _ in range(rng.randrange(1, 6)))
        rows.append((i, f"http://{host}/a/{rng.randrange(40)}", site + body + end, "n", 1, "h", "t"))
    rows += [(205, rows[3][1] + "?print=1", rows[3][2], None, None, None, None), rows[8], rows[8]]  # a copy, repeated rows
    rows += [(None, None, None, None, None, None, None), (200, "http://hot.example/z", None, None, None, None, None),
             (201, None, "<p>alone</p>", None, None, None, None), (202, "http://one.example/", "<p>one page</p>", None, None, None, None),
             (203, "http://hot.example/long", "<div>" + "x y<br>" * 60000, None, None, None, None)]
    return rows


def brute(rows, reach=3):
    pages = [(*url_place(u), tuple(page_lines(h)), h) for _, u, h, *_ in rows]
    from tessera.llm.page_text import _node

    node = lambda p: _node(p[0], p[1], list(p[2]))
    order = sorted({(p[0], p[1], node(p), p[2]) for p in pages if p[0]})
    out = collections.Counter()
    for row, page in zip(rows, pages):
        lines = [t for t, _ in page[2]]
        drop = set()
        if page[0]:
            n = order.index((page[0], page[1], node(page), page[2]))
            for side in (-1, 1):
                for d in range(1, reach + 1):
                    m = n + side * d
                    if not 0 <= m < len(order) or order[m][0] != page[0]:
                        break
                    shared = common_lines(lines, [t for t, _ in order[m][3]])
                    assert len(shared) == dp(lines, [t for t, _ in order[m][3]])
                    if 100 * sum(len(lines[i]) for i in shared) <= 80 * sum(map(len, lines)):
                        drop |= {i for i in shared if page[2][i][1] == OPEN}
                        break
        out[row[0], row[1], "\n\n".join(t for i, t in enumerate(lines) if i not in drop), len(drop)] += 1
    return out


def test_matches_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = page_texts(df).select("page_id", "url", F.array_join("blocks", "\n\n"), "n_shared").collect()
    assert collections.Counter(map(tuple, got)) == brute(rows)
    by_id = {r[0]: r[2] for r in got}
    assert "Welcome" not in by_id[4] and "Call us" not in by_id[4] and by_id[4]
    assert all(by_id[i].startswith("Common title\n\nShared passage of many articles.") for i in range(0, 90, 5))
    assert any("Share " not in by_id[i] for i in range(0, 90, 5))
    assert by_id[201] == "alone" and by_id[202] == "one page" and by_id[200] == ""


def test_empty_table(spark):
    assert page_texts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_on_given_pages(spark):
    """The given pages hold one article each; its markup is simple enough to be cut by two patterns."""
    sf = "/root/testdata/sf0.01"
    want = {}
    for r in table(spark, sf, "pages").collect():
        parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", r.html, re.S)[1])
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        want[r.page_id] = "\n\n".join(p for p in parts if p)
    got = queries.op13_page_text(spark, sf).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)
