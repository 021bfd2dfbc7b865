"""HTML extraction: nearest-URL page differencing.

Within a host, pages are put in order of URL path; a page's partner is the neighbour in
that order whose path shares the longer head with its own, copies of the page itself left out. The text
lines of the two are aligned by longest common subsequence, and the lines they share, which are the site's
and not the page's, are deleted.

Pages travel once, as text lines. Their keys alone are sorted by range first, over all hosts, and every
task gives the keys at which its part may be cut; a page finds its chunk among the cuts by binary search,
and the pages on both sides of a cut are sent to both chunks. So no host has to be in one task, and every page
meets both its neighbours. Chunks are read as a stream, two pages and the keys of equal ones at a time.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

CHUNK = 1024
#: Cuts are known to all tasks, so there are no more than that; beyond, chunks are longer.
MOST_CUTS = 50_000
_BLOCK = "address|article|aside|blockquote|body|br|button|caption|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|noscript|ol|option|p|pre|section|select|summary|table|tbody|td|tfoot|th|thead|title|tr|ul"
OPEN = re.compile(r"<!--|<(script|style|template|svg|head)(?=[\s/>])[^>]*>|<![^>]*>|<\?[^>]*>", re.I)
END = {k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "template", "svg")}
#: What a head holds, a piece at a time; it ends at its end tag, and without one before anything else.
HEAD = re.compile(
    r"\s+|<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(?:script|style)(?=[\s/>])[^>]*/>|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<title(?=[\s/>])[^>]*>(?:[^<]|<(?![a-z/!]))*|<(noscript|template)(?=[\s/>])[^>]*(?<!/)>(?:(?!</?(?:noscript|template|head|body)\b).)*</\2\s*>|</?(?:title|noscript|template|meta|link|base)(?=[\s/>])[^>]*>",
    re.I | re.S,
)
HEAD_END = re.compile(r"</head\s*>", re.I)
BREAK = re.compile(rf"</?(?:{_BLOCK})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.I)
TAG = re.compile(r"</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>")
BLANKS = re.compile(r"\s+")


def body(html: str) -> str:
    """The page without comments, declarations, head, scripts, styles, templates and drawings.

    A tag that ends in "/>" is empty. Without an end tag, scripts and styles go on to the end of the
    page, a head to the first thing that it can't hold, and of others only the tag goes.
    """
    out, at, unclosed = [], 0, set()
    while m := OPEN.search(html, at):
        out.append(html[at : m.start()])
        at, name = m.end(), (m[1] or "").lower()
        if m[0] == "<!--":
            end = html.find("-->", at)
            at = end + 3 if end >= 0 else len(html)
        elif name == "head":
            while part := HEAD.match(html, at):
                at = part.end()
            if end := HEAD_END.match(html, at):
                at = end.end()
        elif name and not m[0].endswith("/>") and name not in unclosed:
            if end := END[name].search(html, at):
                at = end.end()
            elif name in ("script", "style"):
                at = len(html)
            else:
                unclosed.add(name)
    out.append(html[at:])
    return " ".join(out)


def text_lines(html: str | None) -> list[str]:
    """Text of a page by blocks: no tags, comments, scripts, styles; entities decoded, blanks collapsed."""
    if not html:
        return []
    text = TAG.sub("", BREAK.sub("\0", body(html)))
    return [x for x in (BLANKS.sub(" ", entities.unescape(part)).strip() for part in text.split("\0")) if x]


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """Indices into a of a longest common subsequence of a and b.

    Bit-parallel: row i's integer has a zero bit for each column at which the length
    of the LCS grows; it is walked back from the end. Lines the two share at both ends
    need no table.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    mask: dict[str, int] = {}
    for j, line in enumerate(y):
        mask[line] = mask.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows, v = [full], full
    for line in x:
        m = mask.get(line, 0)
        u = v & m
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    found = []
    i, j = len(x), len(y)
    while i and j:
        if rows[i] >> (j - 1) & 1:  # the length doesn't grow at column j
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:  # it grew there a row earlier
            i -= 1
        else:
            found.append(head + i - 1)
            i, j = i - 1, j - 1
    return [*range(head), *reversed(found), *range(len(a) - tail, len(a))]


def shared_head(a: str, b: str) -> int:
    n = 0
    for p, q in zip(a, b):
        if p != q:
            break
        n += 1
    return n


def nearer(path: str, before: tuple | None, after: tuple | None) -> tuple | None:
    """The neighbour (path, id, lines) that shares the longer head with the path; the one before on a tie."""
    if before is None or after is None:
        return before or after
    return before if shared_head(path, before[0]) >= shared_head(path, after[0]) else after


def _order(host, path, page_id, h) -> tuple:
    """A key that sorts as Spark sorts the columns, nulls first."""
    return host, path, page_id is not None, page_id or 0, h


def _find_cuts(chunk: int):
    """(host, path, page_id, h) of the page before and of the page after each cut of a sorted part of the keys."""

    def run(batches):
        last, n = None, 0
        for b in batches:
            out = []
            for key in zip(*[b.column(k).to_pylist() for k in range(4)]):
                if last is not None and n >= chunk and (key[3] != last[3] or key[0] != last[0]):  # copies aren't parted
                    out.append((*last, *key))
                    n = 0
                last, n = key, n + 1
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), pa.string(), pa.int64(), pa.int64()] * 2)], [f"{x}{k}" for k in (0, 1) for x in ("host", "path", "page_id", "h")])

    return run


def _lines(cuts):
    """The text lines of pages, and the chunk of each; the pages next to a cut are ghosts in the chunk beyond."""
    names = ["chunk", "host", "path", "page_id", "h", "ghost", "text"]

    def run(batches):
        first = [c[1] for c in cuts.value]
        for b in batches:
            for at in range(0, b.num_rows, 200):
                rows = []
                for host, path, page_id, h, html in zip(*[c.to_pylist() for c in b.slice(at, 200).columns]):
                    key, text = _order(host, path, page_id, h), "\n".join(text_lines(html))
                    k = bisect_right(first, key)
                    rows.append((k, host, path, page_id, h, False, text))
                    if k and first[k - 1] == key:
                        rows.append((k - 1, host, path, page_id, h, True, text))
                    if k < len(first) and cuts.value[k][0] == key:
                        rows.append((k + 1, host, path, page_id, h, True, text))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()])], names)
        release()

    return run


def _difference(batches):
    """Pages in order of (chunk, host, path, id, hash); `ghost` pages are neighbours only."""
    before = group = None  # the page before the group, and pages in a row that are equal: [chunk and host, hash, lines, keys]

    def settle(after):
        for path, page_id, ghost in group[3]:
            if not ghost:
                partner = nearer(path, before, after)
                gone = set(common_lines(group[2], partner[2])) if partner else ()
                kept = [x for i, x in enumerate(group[2]) if i not in gone]
                yield page_id, partner and partner[1], len(group[2]), len(group[2]) - len(kept), "\n".join(kept)

    def emit(rows):
        c = list(zip(*rows))
        return pa.record_batch([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.int32()), pa.array(c[4], pa.string())], ["page_id", "partner_id", "n_lines", "n_removed", "text"])

    rows = []
    for b in batches:
        for chunk, host, path, page_id, h, ghost, text in zip(*[b.column(i).to_pylist() for i in range(7)]):
            if group and group[:2] == [(chunk, host), h]:
                group[3].append((path, page_id, ghost))
                continue
            lines = text.split("\n") if text else []
            if group:
                same = group[0] == (chunk, host)
                rows += settle((path, page_id, lines) if same else None)
                before = (*group[3][-1][:2], group[2]) if same else None
            group = [(chunk, host), h, lines, [(path, page_id, ghost)]]
            if len(rows) >= 500:
                yield emit(rows)
                rows = []
    if group:
        rows += settle(None)
    if rows:
        yield emit(rows)
    release()


def host_and_path(url):
    """Columns (host, path): no scheme, user, port, "www.", query or fragment; a null URL is host "" and path ""."""
    u = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(u, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(u, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(host, r"^www\.", ""), path


def page_texts(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, partner_id, n_lines, n_removed, text) of every page.

    Order within a host is (path, page_id, hash of html), null ids first; the partner is
    the nearest page before or after of other html, the one that shares the longer head of the path, and the one before
    on a tie. A page without such a neighbour in its host has no partner (null) and keeps its text, so copies never
    delete each other. A null or empty page has no lines and "" as text. A page with a null URL goes with the others
    that have no host. Repeated rows each get their row. An empty table gives no rows; extra columns are ignored.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(host.alias("host"), path.alias("path"), F.col("page_id").cast("bigint").alias("page_id"), F.xxhash64("html").alias("h"), "html")
    key = ["host", "path", "page_id", "h"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(chunk, -(-pages.count() // MOST_CUTS))
    sides = ", ".join(f"host{k} string, path{k} string, page_id{k} bigint, h{k} bigint" for k in (0, 1))
    found = rows.select(*key).repartitionByRange(parts, *key).sortWithinPartitions(*key).mapInArrow(_find_cuts(size), sides).collect()
    cuts = spark.sparkContext.broadcast(sorted(((_order(*c[:4]), _order(*c[4:])) for c in found), key=lambda c: c[1]))
    sent = rows.mapInArrow(_lines(cuts), "chunk bigint, host string, path string, page_id bigint, h bigint, ghost boolean, text string")
    order = ["chunk", "host", "path", "page_id", "h"]
    sorted_ = sent.repartition(parts, "chunk").sortWithinPartitions(*order)
    return sorted_.mapInArrow(_difference, "page_id bigint, partner_id bigint, n_lines int, n_removed int, text string")
