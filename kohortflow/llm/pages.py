"""Main text of web pages: page structure, and differencing against the page with the nearest url.

A page becomes text lines, one per block, each inside or outside of its main element (article or main). Regions that
are no content by their element, role or class (menus, forms, adverts, notices, comments, ...) give no lines, and if a
page has a main element, only lines inside it are content.

Within a host, pages are ordered by path. Pages with equal lines are one class, whatever their ids and urls, and
classes next to each other that share nearly all of their text (``ALIKE``) are one run: copies, print versions, pages of one
text. What copies share is their text rather than the frame of the site, so a class is paired with the nearest class
outside its run, that of the two that has the longer path in common. Their lines are aligned by longest common subsequence, and shared lines are deleted: what two pages of a site have in
common is its frame. Shared lines that lie inside the main element of both pages stay, since two articles may
quote the same paragraph, and deleting that would lose content. So differencing decides on pages without a main
element, and on lines of a main element that the neighbour shows as its frame. A host that has one run only keeps all lines.

The order is by ranges of (host, path), so a host with a third of all pages is many tasks; only fingerprints of lines
are compared and shuffled. Pages that lose lines are joined by a key; texts are made again rather than stored.

Defined results: a null page is empty; a null url, or one without ``://``, has the host "". A class has the place of its
first page in the order of (host, path, id); of neighbours with equal paths in common the earlier one is taken. An element that is never closed ends with the page, or where a main element begins.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kohortflow.llm.common import shuffle_width, small_batches
from kohortflow.llm.near_dups import _batch
from kohortflow.llm.reputation import host_of, path_of
from kohortflow.session import cut_lineage

MAIN = {"article", "main"}
#: Elements whose content is not markup; they end at their own end tag only.
RAW = {"iframe", "noembed", "noframes", "noscript", "script", "style", "template", "textarea", "title", "xmp"}
FRAME = {"aside", "button", "dialog", "fieldset", "footer", "form", "head", "header", "menu", "nav", "select", "svg"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
ROLES = {"banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search"}
#: Words in a class or id that mark a region as no content.
MARKS = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "disqus", "footer", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup",
    "promo", "related", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Last words of a class whose first word then tells of what the region is, as in comment-list; and words that make a
#: class one of a state or a topic, as in has-sidebar or category-social.
REGION = {
    "area", "bar", "block", "body", "box", "button", "buttons", "container", "form", "group", "inner", "item", "items", "links", "list", "posts",
    "section", "slot", "text", "unit", "widgets", "wrap", "wrapper",
}
STATE = {"category", "has", "is", "no", "not", "tag", "tagged", "with", "without"}

#: Pages are alike if shared lines have this part of the characters of the one and of the other, in either order.
ALIKE = (0.9, 0.5)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[/a-zA-Z!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
PART = re.compile(r"[^a-z0-9]+")


def _is_mark(token: str) -> bool:
    if token in MARKS:
        return True
    words = [w for w in PART.split(token) if w]
    if not words or not STATE.isdisjoint(words):
        return False
    return words[-1] in MARKS or words[0] in MARKS and words[-1] in REGION


def _is_frame(tag: str, attributes: str, inside: list[str]) -> bool:
    """Is it a region that is no content? In html and body all is content, and an article or main element that is in no
    article is none only by a class or id that is a mark as it stands."""
    if tag in ("html", "body"):
        return False
    if tag in FRAME and not (tag == "header" and inside):
        return True
    if not attributes:
        return False
    outermost = tag in MAIN and "article" not in inside
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden" and value in ("", "hidden", "true") or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value.strip() in ROLES or name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("class", "id") and any(t in MARKS if outermost else _is_mark(t) for t in value.split()):
            return True
    return False


def lines_of(page: str | None) -> list[tuple[str, bool]]:
    """(text, inside the main element) of each block of a page that may be content, in page order."""
    page, out, parts = page or "", [], []
    at, inside, skip, depth = 0, [], "", 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, bool(inside)))
            parts.clear()

    while at < len(page):
        token = TOKEN.search(page, at)
        text = page[at : token.start() if token else len(page)]
        if not skip and text:
            parts.append(text)
        if not token:
            break
        at, tag, end = token.end(), (token[2] or "").lower(), token[1] == "/"
        if not tag:
            continue
        if skip and tag in MAIN and not end and skip not in MAIN:
            skip, depth = "", 0  # a region left open
        if skip:
            if tag == skip and not token[3].endswith("/"):
                depth += -1 if end else 1
                if not depth:
                    skip = ""
            continue
        if tag not in INLINE:
            flush()
        if end:
            if tag in MAIN and tag in inside:
                while inside.pop() != tag:
                    pass
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else len(page)
        elif tag not in VOID and not token[3].endswith("/"):
            if _is_frame(tag, token[3], inside):
                skip, depth = tag, 1
            elif tag in MAIN:
                inside.append(tag)
    flush()
    return out


def common(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by bit vectors with one bit per line of ``b``."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    found = {*range(start), *range(len(a) - stop, len(a))}
    x, y = a[start : len(a) - stop], b[start : len(b) - stop]
    where: dict[int, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows = [full]
    for line in x:
        v = rows[-1]
        u = v & where.get(line, 0)
        rows.append(((v + u) | (v - u)) & full)
    i, j = len(x), len(y)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            found.add(start + i)
    return found


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, host, path, page_id, html) to (key, host, path, page_id, hashes, inside, sizes)."""
    import xxhash

    for batch in batches:
        made = [lines_of(page) for page in batch.column(4).to_pylist()]
        hashes = [[int(np.uint64(xxhash.xxh64_intdigest(t)).view(np.int64)) for t, _ in x] for x in made]
        columns = [*batch.columns[:4], pa.array(hashes, pa.list_(pa.int64())), pa.array([[i for _, i in x] for x in made], pa.list_(pa.bool_()))]
        columns.append(pa.array([[len(t) for t, _ in x] for x in made], pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays(columns, names=["key", "host", "path", "page_id", "hashes", "inside", "sizes"])


def alike(a: list[int], sizes: list[int], b: list[int], other_sizes: list[int]) -> bool:
    """Do two pages share nearly all text of one of them, and much of the other's?"""
    rest, shared = Counter(b), 0
    for line, n in zip(a, sizes, strict=True):
        if rest[line]:
            rest[line] -= 1
            shared += n
    small, large = sorted((sum(sizes), sum(other_sizes)))
    return small > 0 and shared >= ALIKE[0] * small and shared >= ALIKE[1] * large


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys whose page is like the other one, of (key, hashes, inside, sizes, other hashes, other inside, other sizes)."""
    for batch in batches:
        key, a, _, n, b, _, m = (batch.column(i).to_pylist() for i in range(7))
        yield _batch(pa.schema([("key", pa.int64())]), [[k for k, *x in zip(key, a, n, b, m, strict=True) if alike(*x)]])


DROPS = pa.schema([("key", pa.int64()), ("drop", pa.list_(pa.int32()))])


def _drops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to delete of (key, hashes, inside, sizes, other hashes, other inside, other sizes)."""
    for batch in batches:
        keys, drops = [], []
        for key, a, own, n, b, other, m in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if alike(a, n, b, m):  # a run may be like the end of the one before it, though not where they meet
                continue
            frame = {h for h, i in zip(b, other, strict=True) if not i}
            drop = [i for i in sorted(common(a, b)) if not own[i] or a[i] in frame]
            if drop and (any(own) is False or any(own[i] for i in drop)):
                keys.append(key)
                drops.append(drop)
        yield _batch(DROPS, [keys, drops])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, drop) to (page_id, url, text)."""
    for batch in batches:
        texts = []
        for page, drop in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            lines, gone = lines_of(page), set(drop or ())
            main = any(i for _, i in lines)
            texts.append(" ".join(t for k, (t, i) in enumerate(lines) if k not in gone and (i or not main)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def _paired(pairs: DataFrame, one: DataFrame) -> DataFrame:
    """Lines of both pages of (key, other)."""
    other = one.select(F.col("key").alias("other"), *[F.col(c).alias(f"{c}2") for c in ("hashes", "inside", "sizes")])
    both = pairs.join(one.select("key", "hashes", "inside", "sizes"), "key").join(other, "other")
    return both.select("key", "hashes", "inside", "sizes", "hashes2", "inside2", "sizes2")


def neighbours(one: DataFrame) -> DataFrame:
    """(key, other): the nearest page of the same host that is not of the same run, of pages with their lines.

    Ranges of the order are tasks; what lies across the end of a range comes from one row per range and end, and so
    does the number of runs before a range.
    """
    order = ["host", "path", "page_id", "key"]
    ranged = one.repartitionByRange(shuffle_width(one.sparkSession), *order).select(F.spark_partition_id().alias("part"), F.struct(*order).alias("row"))
    ranged = cut_lineage(ranged)
    ends = ranged.groupBy("part").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    parts = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(parts).alias("before"), F.lead("first").over(parts).alias("after"))
    within = Window.partitionBy("part").orderBy("row")
    near = ranged.select("part", "row", F.lag("row").over(within).alias("up"), F.lead("row").over(within).alias("down")).join(ends, "part")
    near = cut_lineage(near.select("part", "row", F.coalesce("up", "before").alias("up"), F.coalesce("down", "after").alias("down")))

    follows = _paired(near.where("up.host = row.host").selectExpr("row.key", "up.key AS other"), one).mapInArrow(_alike, "key long")
    follows = follows.select("key", F.lit(0).alias("start"))
    near = near.withColumn("key", F.col("row.key")).join(follows, "key", "left")
    near = cut_lineage(near.select("key", "part", "row", "up", "down", F.coalesce("start", F.lit(1)).alias("start")))
    before = near.groupBy("part").agg(F.sum("start").alias("n"))
    before = before.select("part", F.coalesce(F.sum("n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    number = F.col("before") + F.sum("start").over(within.rowsBetween(Window.unboundedPreceding, 0))
    numbered = near.join(before, "part").select("row", "up", "down", number.alias("run"))
    runs = numbered.groupBy("run").agg(F.min_by("up", "row").alias("up"), F.max_by("down", "row").alias("down"))
    near = numbered.select("row", "run").join(runs, "run")

    def shared(other: str) -> str:  # leading path segments in common, -1 if there is no such page
        segments = f"split(row.path, '/'), split({other}.path, '/')"
        alike = f"aggregate(zip_with({segments}, (a, b) -> a <=> b), named_struct('n', 0, 'on', true), (s, e) -> named_struct('n', s.n + int(s.on AND e), 'on', s.on AND e), s -> s.n)"
        return f"CASE WHEN {other}.host = row.host THEN {alike} ELSE -1 END"

    near = near.withColumns({"u": F.expr(shared("up")), "d": F.expr(shared("down"))}).where("u >= 0 OR d >= 0")
    return near.select("row.key", F.expr("CASE WHEN u >= d THEN up.key ELSE down.key END").alias("other"))


def _keyed(pages: DataFrame) -> DataFrame:
    """(key, page_id, url, html); pages equal in all of these have one key."""
    return pages.select(F.xxhash64("page_id", "url", "html").alias("key"), F.col("page_id").cast("long").alias("page_id"), "url", "html")


def deleted(pages: DataFrame) -> DataFrame:
    """(key, drop): places of the lines that differencing deletes, of pages that lose lines."""
    small_batches(pages.sparkSession, 500)
    placed = _keyed(pages).select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "page_id", "html")
    printed = placed.mapInArrow(_fingerprints, "key long, host string, path string, page_id long, hashes array<long>, inside array<boolean>, sizes array<int>")
    printed = cut_lineage(printed.withColumn("class", F.xxhash64("host", "hashes", "inside")))
    place = F.min(F.struct("path", "page_id")).alias("place")
    one = printed.groupBy("class").agg(place, *[F.first(c).alias(c) for c in ("host", "hashes", "inside", "sizes")])
    one = cut_lineage(one.select(F.col("class").alias("key"), "host", "place.*", "hashes", "inside", "sizes"))
    drops = cut_lineage(_paired(neighbours(one), one).mapInArrow(_drops, "key long, drop array<int>"))
    return printed.select("key", "class").distinct().join(drops.withColumnRenamed("key", "class"), "class").select("key", "drop")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    joined = _keyed(pages).join(cut_lineage(deleted(pages)), "key", "left")
    texts = joined.select("page_id", "url", "html", "drop").mapInArrow(_texts, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
