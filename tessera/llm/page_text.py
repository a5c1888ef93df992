"""Main text of web pages: markup where it speaks, differencing of nearby pages where it doesn't.

A page is cut into blocks (runs of text between block-level tags). Markup
decides first: scripts, styles, menus, headers, footers, sidebars, forms,
notices, adverts and reader comments are left out by tag, role and class names;
if the page has an ``article`` (else a ``main``) with text, only that counts.
What is left are the page's lines.

Then pages are compared with their nearest neighbours by URL path within their
host: all pages are range-sorted by (host, path), and each meets the pages up to
``reach`` places before and after it. On either side the nearest page that isn't
a copy (shares at most ``copy_percent`` of its text) is its partner. Lines are aligned by
longest common subsequence; lines shared with a partner belong to the site, not
to the page, and are deleted. Prose in an explicit article (paragraphs,
headings, list items, not mostly links) is never deleted: the page itself says
that it is the article, and texts repeat between articles, too.

Only hashes of lines are sorted and compared; texts are cut again when the
result is put together, and meet the (few, small) rows that say what to delete
by a hash of the page's URL and lines. No host lies in one task.

Defined results: a null or empty html, and one without text, give an empty
text; pages without a host (null or odd URLs) have no neighbours; equal pages
get equal texts; repeated ids are pages of their own; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import html as references
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stage, stage_sorted

RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
DROPPED = frozenset("head nav footer aside form noscript template svg math button select menu dialog object video audio canvas".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre section
    select summary table tbody tfoot thead tr ul caption""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th tr table tbody caption figcaption ul ol dl".split())
#: A start tag ends open elements of these kinds.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
        "th": {"td", "th", "p"}, "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}}
#: Elements that such a search doesn't leave.
WALLS = frozenset("html body table ul ol dl div article main section nav aside header footer form blockquote select".split())
#: Names in class or id that mark what isn't the article; those of the second group hold whole articles at times.
HINTS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent
    gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    breadcrumb breadcrumbs menu navbar nav navigation topbar masthead footer pagination pager toolbar skip search form
    adsense adslot adbox adunit cookiebar cookiebanner cookienotice topnav subnav sidenav mainnav sitenav sitefooter subfooter""".split())
DEEP_HINTS = frozenset("""comment comments commentlist commentsection commentbox usercomments disqus replies reply respond sidebar
    related recommended recommendations teaser teasers widget widgets""".split())
#: Whole names that mark a page's header; an article has headers of its own.
HEADERS = frozenset("header site-header page-header main-header top-header siteheader pageheader".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NOT_A_MARK = frozenset("has no with without non not".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[/]?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*+>|<[/]?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?=[\s/>])""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

#: What a block is: open to differencing, or prose that the page's own markup calls its article.
OPEN, PROTECTED = 0, 1


def _marks(tag: str, name: str, in_article: bool) -> tuple[bool, bool, bool]:
    """(isn't the article, not even where an article begins inside, is the article) by the attributes of a start tag."""
    out = deep = main = False
    for key, value in _ATTRIBUTE.findall(tag):
        key, value = key.lower(), references.unescape(value.strip("\"'"))
        if key in ("class", "id"):
            for word in value.split() if name not in ("html", "body") else ():
                # an article's names list its topics and settings, too: only a whole name says what it is
                parts = [word.lower()] if name in ("article", "main") else [p.lower() for p in _PART.findall(word)]
                if not NOT_A_MARK.intersection(parts):
                    deep |= not DEEP_HINTS.isdisjoint(parts)
                    out |= not HINTS.isdisjoint(parts) or (word.lower() in HEADERS and not in_article)
        elif key == "role":
            out |= value.lower() in ROLES
            main |= value.lower() == "main"
        elif key == "itemprop":
            main |= value == "articleBody"
            deep |= value.lower() == "comment"
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            deep = True
        elif key == "style":
            deep |= "display:none" in value.replace(" ", "").lower()
    return out or deep, deep, main


class Blocks:
    """The blocks of a page: texts of those that aren't marked as something else, in page order."""

    def __init__(self, page: str):
        self.found = []  # (in article, in main, text, kind)
        self.text, self.linked, self.size = [], 0, 0
        # open elements: name, marked, deeply marked, articles around, mains around
        self.stack = [("", False, False, 0, 0)]
        at = 0
        for token in _TOKEN.finditer(page):
            if token.start() < at:
                continue
            if token.start() > at:
                self._words(page[at:token.start()])
            at = token.end()
            tag = token.group()
            name = _NAME.match(tag)
            if not name or tag.startswith("<!"):
                continue
            name = name[1].lower()
            if tag[1] == "/":
                self._end(name)
            elif not tag.endswith(">"):
                break  # a tag that the page's end cuts off
            elif name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else len(page)
            elif name == "br":
                self._words("\n")
            elif name not in VOID:
                self._start(name, tag)
            elif name == "hr":
                self._close_block()
        if at < len(page):
            self._words(page[at:])
        self._close_block()

    def _words(self, text: str) -> None:
        if not self.stack[-1][1]:
            self.text.append(text)
            n = len(text) - text.count(" ")
            self.size += n
            if any(e[0] == "a" for e in self.stack):
                self.linked += n

    def _close_block(self) -> None:
        if self.text:
            text = " ".join(references.unescape("".join(self.text)).split())
            if text:
                _, _, _, articles, mains = self.stack[-1]
                near = next((e[0] for e in reversed(self.stack) if e[0] in BLOCKS or e[0] in ("td", "th")), "")
                prose = near in PROSE and 2 * self.linked <= self.size
                self.found.append((articles > 0, mains > 0, text, PROTECTED if (articles or mains) and prose else OPEN))
        self.text, self.linked, self.size = [], 0, 0

    def _pop(self, depth: int) -> None:
        if any(e[0] in BLOCKS for e in self.stack[depth:]):
            self._close_block()
        del self.stack[depth:]

    def _start(self, name: str, tag: str) -> None:
        if name == "body" or (name in BLOCKS and name not in ("head", "html")):
            for i, e in enumerate(self.stack):
                if e[0] == "head":
                    self._pop(i)
                    break
        ending = ENDS.get(name) or ({"p"} if name in BLOCKS else None)
        if ending:
            i = len(self.stack) - 1
            while i > 0 and self.stack[i][0] not in WALLS:
                if self.stack[i][0] in ending:
                    self._pop(i)
                i -= 1
        if name in BLOCKS:
            self._close_block()
        elif name in ("td", "th"):
            self._words(" ")
        _, marked, deep, articles, mains = self.stack[-1]
        out, deeper, main = _marks(tag, name, articles > 0) if "=" in tag or "hidden" in tag else (False, False, False)
        if name in DROPPED or (name == "header" and not articles):
            out = deeper = True
        if name == "article":
            if articles:  # an article in an article is a reader's comment
                out = deeper = True
            else:
                marked = deep
                articles += not (deep or out)
        elif name == "main" or main:
            mains += 1
            marked = deep
        self.stack.append((name, marked or out, deep or deeper, articles, mains))

    def _end(self, name: str) -> None:
        if name == "p" or name == "br":
            if name == "br" or not any(e[0] == "p" for e in self.stack):
                self._close_block()
                return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == name:
                self._pop(i)
                return
            if self.stack[i][0] in WALLS and name not in WALLS:
                return  # an end tag without its start in this container

    def lines(self) -> list[tuple[str, int]]:
        """The article's blocks, else those of ``main``, else all: (text, kind)."""
        for place in (0, 1):
            inside = [(b[2], b[3]) for b in self.found if b[place]]
            if inside:
                return inside
        return [(b[2], b[3]) for b in self.found]


def page_lines(page: str | None) -> list[tuple[str, int]]:
    return Blocks(page).lines() if page else []


_URL = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)[^/?#]*([^?#]*)(\?[^#]*)?")


def url_place(url: str | None) -> tuple[str | None, str]:
    """Host and a path that sorts near pages together: numbers count by value, then comes the query."""
    m = _URL.match(url or "")
    if not m:
        return None, ""
    host = m[1].lower().removeprefix("www.")
    path = re.sub(r"(?:\.html?|/)$", "", m[2]) + "?" + (m[3] or "")[1:]
    return host, re.sub(r"[0-9]+", lambda d: f"{len(d[0].lstrip('0')):03d}{d[0].lstrip('0')}", path)


def _node(host: str | None, path: str, lines: list[tuple[str, int]]) -> str:
    import xxhash

    h = xxhash.xxh3_128()
    for x in (host or "", path, *(f"{kind}{text}" for text, kind in lines)):
        h.update(x.encode("utf-8", "surrogatepass"))
        h.update(b"\0")
    return h.hexdigest()


def _parse(emit):
    """Rows made by ``emit(url, lines)`` from each page, next to the columns that ``emit`` asks for."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                urls, pages = part.column("url").to_pylist(), part.column("html").to_pylist()
                rows = [emit(u, page_lines(h)) for u, h in zip(urls, pages)]
                yield pa.RecordBatch.from_pylist(rows, schema=emit.schema) if not emit.kept else pa.RecordBatch.from_arrays(
                    [part.column(c) for c in emit.kept] + [pa.array([r[f.name] for r in rows], f.type) for f in emit.schema],
                    names=[*emit.kept, *emit.schema.names])
    return run


def _places():
    """For neighbours: node, host, path, hashes, sizes and kinds of the lines."""
    import pyarrow as pa
    import xxhash

    def emit(url, lines):
        host, path = url_place(url)
        return {"_node": _node(host, path, lines), "_host": host, "_path": path,
                "_lines": [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _ in lines],
                "_sizes": [len(t) for t, _ in lines], "_open": [k == OPEN for _, k in lines]}

    emit.kept = []
    emit.schema = pa.schema([("_node", pa.string()), ("_host", pa.string()), ("_path", pa.string()), ("_lines", pa.list_(pa.int64())),
                             ("_sizes", pa.list_(pa.int32())), ("_open", pa.list_(pa.bool_()))])
    return emit


def _texts(kept):
    import pyarrow as pa

    def emit(url, lines):
        return {"_node": _node(*url_place(url), lines), "blocks": [t for t, _ in lines]}

    emit.kept, emit.schema = kept, pa.schema([("_node", pa.string()), ("blocks", pa.list_(pa.string()))])
    return emit


def _row(a: list, place: dict, n: int) -> int:
    """Bit-parallel row: bits of ``place`` cleared where the common subsequence with ``a`` grows."""
    full = (1 << n) - 1
    v = full
    for x in a:
        u = v & place.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return v


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    place: dict = {}
    for i, x in enumerate(b):
        place[x] = place.get(x, 0) | 1 << i
    v = _row(a, place, len(b))
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(a: list, b: list, most_bits: int = 1 << 24) -> list[int]:
    """Places in ``a`` of one longest common subsequence of ``a`` and ``b`` (bit-parallel; halved until its table is small)."""
    out, start = [], 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        out.append(start)
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    tail = list(range(len(a) - end, len(a)))
    held_b, held_a = set(b[start:len(b) - end]), set(a[start:len(a) - end])
    at = [i for i in range(start, len(a) - end) if a[i] in held_b]
    x, y = [a[i] for i in at], [v for v in b[start:len(b) - end] if v in held_a]
    return out + [at[i] for i in _common(x, y, most_bits)] + tail


def _common(x: list, y: list, most_bits: int) -> list[int]:
    if not x or not y:
        return []
    if len(x) == 1:
        return [0] if x[0] in y else []
    if len(x) * len(y) > most_bits:
        half = len(x) // 2
        cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        return _common(x[:half], y[:cut], most_bits) + [half + i for i in _common(x[half:], y[cut:], most_bits)]
    place: dict = {}
    for i, v in enumerate(y):
        place[v] = place.get(v, 0) | 1 << i
    full, rows = (1 << len(y)) - 1, [(1 << len(y)) - 1]
    for v in x:
        u = rows[-1] & place.get(v, 0)
        rows.append(((rows[-1] + u) | (rows[-1] - u)) & full)
    length = lambda row, j: j - (row & ((1 << j) - 1)).bit_count()
    out, j = [], len(y)
    for i in range(len(x), 0, -1):
        n = length(rows[i], j)
        if length(rows[i - 1], j) == n:
            continue  # not needed for this length
        while length(rows[i], j - 1) == n:
            j -= 1
        out.append(i - 1)
        j -= 1
    return out[::-1]


def _differ(copy_percent: int):
    """What to delete of each page, after a look at its neighbours: places of lines, if any."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            nodes, gone = [], []
            cols = [batch.column(c).to_pylist() for c in ("_node", "_lines", "_sizes", "_open", "_near")]
            for node, lines, sizes, open_, near in zip(*cols):
                drop = set()
                for side in (-1, 1):
                    for _, other in sorted((abs(n["d"]), n["lines"]) for n in near if n["d"] * side > 0):
                        shared = common_lines(lines, other)
                        if 100 * sum(sizes[i] for i in shared) <= copy_percent * sum(sizes):
                            drop.update(shared)
                            break
                drop = sorted(i for i in drop if open_[i])
                if drop:
                    nodes.append(node)
                    gone.append(drop)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(gone, pa.list_(pa.int32()))], ["_node", "_gone"])
    return run


def shared_lines(pages: DataFrame, url_col: str = "url", html_col: str = "html", reach: int = 3,
                 copy_percent: int = 80) -> DataFrame:
    """``_node, _gone``: for pages that share open lines with a partner, which ones (places from 0)."""
    emit = _places()
    places = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(
        _parse(emit), "_node string, _host string, _path string, _lines array<long>, _sizes array<int>, _open array<boolean>")
    nodes = stage_sorted(places.where("_host IS NOT NULL").distinct(), ["_host", "_path", "_node"], "page-places")
    # rows as many as partitions: a place in all pages is a partition's start plus the place in it
    counts = nodes.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_start"))
    ranked = nodes.join(F.broadcast(starts), "_pid").select(
        "_node", "_host", (F.col("_start") + F.col("_pos")).alias("_rank"), "_lines", "_sizes", "_open")
    steps = F.array(*[F.lit(d) for d in range(-reach, reach + 1) if d])
    offered = ranked.select("_host", F.explode(steps).alias("d"), "_rank", F.col("_lines").alias("lines")).select(
        "_host", (F.col("_rank") - F.col("d")).alias("_rank"), F.struct("d", "lines").alias("_other"))
    asked = ranked.where(F.exists("_open", lambda x: x))  # only these have lines to lose
    near = asked.join(offered, ["_host", "_rank"]).groupBy("_host", "_rank").agg(F.collect_list("_other").alias("_near"))  # 2 * reach at most
    return asked.join(near, ["_host", "_rank"]).select("_node", "_lines", "_sizes", "_open", "_near").mapInArrow(
        _differ(copy_percent), "_node string, _gone array<int>")


def page_texts(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: tuple[str, ...] = ("page_id",),
               reach: int = 3, copy_percent: int = 80) -> DataFrame:
    """The columns ``keep`` and the url, with ``blocks`` (main text by blocks, in page order) and ``n_shared`` (lines deleted)."""
    gone = stage(shared_lines(pages, url_col, html_col, reach, copy_percent).withColumnRenamed("_node", "_of"), "page-shared")
    kept = [f"_k{i}" for i in range(len(keep))]
    rows = pages.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept)
    cut = rows.mapInArrow(_parse(_texts([*kept, "url"])), f"{types}, url string, _node string, blocks array<string>")
    left = F.filter("blocks", lambda b, i: ~F.array_contains("_gone", i))
    return cut.join(gone, cut["_node"] == gone["_of"], "left").select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)], "url",
        F.when(F.col("_gone").isNull(), F.col("blocks")).otherwise(left).alias("blocks"),
        F.coalesce(F.size("_gone"), F.lit(0)).alias("n_shared"))
