"""Main text of web pages by differencing with the page of the nearest URL.

Pages are dealt in ranges of host, URL path and page_id, so a hot host is
spread over many tasks and every page meets its nearest URLs as neighbours;
the first and last page of a range go to the neighbouring range as well, so
the result does not depend on the ranges.  A task parses each page into lines
(block by block) and pairs it with the neighbour of the same host that shares
the longer start of the path (ties: the one before).  The lines of a pair are aligned by longest common
subsequence, and shared lines are deleted.

Two kinds of lines are not left to that comparison:

* lines inside elements that say what they are (menus, headers, footers,
  sidebars, forms, adverts, notices, comments, scripts, ...) always go;
* lines of an ``article`` or ``main`` element stay even if shared: two copies
  of an article on one host would otherwise delete each other.

All other lines are left to the comparison, beside an article too: the main
text is the lines of such elements and what the comparison leaves around them.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import bounded_batches

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Elements whose content is not text of the page, up to their end tag.
RAW = {"script", "style", "title", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "select"}
VOID = {"br", "hr", "img", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "track", "param"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img", "ruby", "rt", "rp", "picture", "source"}
CHROME = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset"}
CORE = {"article", "main"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert"}
#: Words of a class or id that mark an element as not part of the article.
CHROME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright",
    "disclaimer", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promoted",
    "related", "replies", "reply", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget",
}
ZONE_CHROME, ZONE_LOOSE, ZONE_CORE = 0, 1, 2


def _is_chrome(tag: str, attributes: str, in_core: bool) -> bool:
    if tag in CHROME or tag == "header" and not in_core:
        return True
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value in CHROME_ROLES:
            return True
        if name in ("class", "id") and CHROME_WORDS.intersection(re.split(r"[^a-z]+", value)):
            return True
    return False


def page_lines(page: str) -> list[tuple[str, int]]:
    """(text, zone) of the blocks of a page, in order, without empty ones."""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []
    zone, at, lower = ZONE_LOOSE, 0, None

    def flush() -> None:
        if text:
            line = " ".join("".join(text).split())
            if line:
                out.append((line, zone))
            text.clear()

    while at < len(page):
        m = MARKUP.search(page, at)
        if not m:
            text.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            text.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if not m[1] and tag in RAW:
            lower = page.lower() if lower is None else lower
            if len(lower) != len(page):  # a letter whose lower case is longer
                lower = re.sub("[A-Z]", lambda x: x[0].lower(), page)
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            continue
        if tag in RAW:
            continue
        if tag == "br":
            text.append(" ")
            continue
        marked = not m[1] and tag not in VOID and bool(m[3]) and _is_chrome(tag, m[3], zone == ZONE_CORE)
        if tag in INLINE and not marked and not (m[1] and any(t == tag for t, _ in stack)):
            continue
        flush()
        if tag in VOID or m[0].endswith("/>") and tag not in ("p", "div", "article", "main", "section"):
            continue
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    zone = stack[i][1]
                    del stack[i:]
                    break
            continue
        if tag not in INLINE and stack and stack[-1][0] == "p":  # a block ends an open paragraph
            zone = stack.pop()[1]
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    zone = stack[i][1]
                    del stack[i:]
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table"):
                    break
        stack.append((tag, zone))
        if zone != ZONE_CHROME:
            if marked or _is_chrome(tag, "", zone == ZONE_CORE):
                zone = ZONE_CHROME
            elif tag in CORE:
                zone = ZONE_CORE
    flush()
    return out


def shared_places(a: list[str], b: list[str]) -> set[int]:
    """Places of ``a`` in one longest common subsequence with ``b``."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
    out = set(range(lo)) | set(range(ea, len(a)))
    where: dict[str, list[int]] = {}
    for j in range(eb - 1, lo - 1, -1):
        where.setdefault(b[j], []).append(j)
    # longest increasing run of the matching places (Hunt and Szymanski)
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(lo, ea):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            elif ends[k] != j:
                ends[k], links[k] = j, link
    link = links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


class _Page:
    def __init__(self, page_id, url, host, path, page):
        self.page_id, self.url, self.host, self.path = page_id, url, host, path
        found = page_lines(page or "")
        self.lines, self.zones = [x for x, _ in found], [z for _, z in found]

    def nearer(self, before: _Page | None, after: _Page | None) -> _Page | None:
        near = [p for p in (before, after) if p is not None and p.host == self.host]
        return max(near, key=lambda p: _common(p.path, self.path)) if near else None

    def row(self, partner: _Page | None) -> tuple:
        shared = shared_places(self.lines, partner.lines) if partner else set()
        kept = [x for i, (x, z) in enumerate(zip(self.lines, self.zones)) if z == ZONE_CORE or z == ZONE_LOOSE and i not in shared]
        text = "\n".join(kept)
        return self.page_id, self.url, text, len(text), partner.page_id if partner else None, len(shared)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


RESULT = "page_id long, url string, text string, n_chars long, partner_id long, n_shared_lines long"
KINDS = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, own, page ..), sorted: the pages of each range, and not its
    own those of its neighbours at the edge."""
    names = [f.split()[0] for f in RESULT.split(", ")]
    before = this = None
    part, mine = None, False
    rows, size = [], 0

    for b in batches:
        for of, own, *values in zip(*(c.to_pylist() for c in b.columns)):
            after = _Page(*values)
            if mine:
                rows.append(this.row(this.nearer(before, after if of == part else None)))
                size += rows[-1][3] + 200
            before, this, part, mine = this if of == part else None, after, of, own
            if size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], names)
                rows, size = [], 0
    if mine:
        rows.append(this.row(this.nearer(before, None)))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], names)


KEY = "struct<host:string,path:string,page_id:bigint,url:string>"
#: Keys looked at for each range.
SAMPLED = 20


def _literal(rows: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), kind)


def _dealt(src: DataFrame) -> DataFrame:
    """``src`` with ``part``, the number of its range of keys, and ``own``:
    false in the repeats of the rows with the last key of the range before and
    the first key of the range after."""
    key = F.struct("host", "path", "page_id", "url")
    keys, n = src.select(key.alias("key")), int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = keys.count()
    some = keys.sample(min(1.0, SAMPLED * n / max(rows, 1)), seed=1).orderBy("key").collect()  # bounded by the ranges
    step = max(1, -(-len(some) // n))
    starts = [list(r["key"].asDict().values()) for r in some[step::step]]
    names = ["host", "path", "page_id", "url"]
    bounds = _literal([dict(zip(names, x)) for x in starts], f"array<{KEY}>")
    part = lambda k: F.size(F.filter(bounds, lambda b: b <= k)) if starts else F.lit(0)
    ends = sorted(keys.select(part(F.col("key")).alias("part"), "key").groupBy("part").agg(F.min_by("key", "key").alias("a"), F.max_by("key", "key").alias("b")).collect())  # a row per range
    first, last = ({r["part"]: r[x].asDict() for r in ends} for x in "ab")
    used = [r["part"] for r in ends]
    # by the number of the range: the numbers of its neighbours, its first and its last key
    table = [{"a": first.get(p), "b": last.get(p), "before": max((q for q in used if q < p), default=None), "after": min((q for q in used if q > p), default=None)} for p in range(len(starts) + 1)]
    edge = F.get(_literal(table, f"array<struct<a:{KEY},b:{KEY},before:int,after:int>>"), F.col("_part"))
    out = src.withColumn("_part", part(key)).withColumn("_edge", edge)
    here = F.struct(F.col("_part").alias("part"), F.lit(True).alias("own"))
    to = lambda at, end: F.struct(F.when(F.col(f"_edge.{end}") == key, F.col(f"_edge.{at}")).alias("part"), F.lit(False).alias("own"))
    places = F.filter(F.array(here, to("before", "a"), to("after", "b")), lambda x: x["part"].isNotNull())
    return out.select(F.explode(places).alias("at"), *src.columns).select("at.part", "at.own", *src.columns)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def path(url: Column) -> Column:
    """The path without query, fragment, closing slash and page suffix."""
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"(/+|\.html?)$", "")


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text,
    n_chars (code points), and the page it was compared with (partner_id,
    n_shared_lines).

    Character references are decoded, white space in a block is one space,
    blocks are joined by ``\\n`` in page order.  A null html is an empty page;
    pages without a URL, or with one without a host, form a host of their
    own; repeated rows and pages of one URL are neighbours in the order of
    page_id (nulls first), url and html; other columns are ignored; an empty table gives an
    empty table.
    """
    bounded_batches(pages.sparkSession)
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host(url).alias("host"), path(url).alias("path"), F.col("html").cast("string").alias("html"))
    dealt = _dealt(src).repartitionByRange("part")
    return dealt.sortWithinPartitions("part", "host", "path", "page_id", "url", "html").mapInArrow(_difference, RESULT)
