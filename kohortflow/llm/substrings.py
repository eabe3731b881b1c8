"""Removal of repeated passages with a logarithmic family of suffix indexes.

Every byte covered by a string of 100 bytes that also starts earlier goes; earlier is a smaller id, or the same text
further left. Documents arrive in batches, in the order of their ids.

- The suffix array of a batch is sparse. Of the 77 stretches of 24 bytes in a window of 100 bytes, the one with the
  least hash (the leftmost, if equal) is the window's anchor, so equal windows have equal anchors at the same place,
  and one suffix for each anchor, about every 39th, is enough to find every match of 100 bytes. An entry has the
  fingerprint of the suffix's first 24 bytes, one of its block (all windows with that anchor, at most 176 bytes), and
  its place. Entries are ordered by these fingerprints instead of the letters, which spreads common words.
- A new batch is merge-scanned against all levels. A block that occurs earlier, in a level or in the batch, is
  repeated as a whole. Blocks never seen before become a new level; while the two newest levels are of equal
  rank they are merged into one of the next, so n batches keep about log n levels.
- At the end, suffixes that begin alike but have different blocks, as at the edges of a copied passage, are compared
  window by window on their bytes, in one task for up to 512 blocks that begin alike. The windows of more blocks are
  parted by the place of the anchor in them, at first by 20 places. All windows of a part share at least 81 bytes, so
  parts with different ones part for good, parts that are equal as a whole are repeated as a whole and go on as one, and
  what is left is compared, or parted again by 5 places and at last by single ones, where equal bytes are all there is.

Blocks are first combined in the map tasks, and joins on a very common block or suffix are ones that AQE splits. The
driver sees no entries. Superseded tables are deleted.

Defined results: a null text is empty; one of less than 100 bytes stays. Null ids come last, in the order of a hash of
the text, as do rows that repeat an id; of rows equal in id and text the first stays. In ``deduplicated`` a
character goes only if all its bytes go, and a document that is left without words goes too. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kohortflow.llm.common import WORD, released, small_batches
from kohortflow.llm.near_dups import LETTER, MIX, _batch, _powers, mixed
from kohortflow.session import scratch_dir

LENGTH = 100
GRAM = 24
CHUNK = 1 << 18  # bytes looked at together; positions within fit the low 20 bits
LOW = np.uint64((1 << 20) - 1)
TOGETHER = 512  # different blocks that one task compares
PARTS = (80, 20, 5, 1)  # places of the anchor in the windows that stay together, round by round; a window has 77
BATCHES = 4

ENTRY = pa.schema([("h", pa.int64()), ("bh", pa.int64()), ("doc", pa.int64()), ("version", pa.int64()), ("lo", pa.int64()), ("back", pa.int16()), ("run", pa.int16())])
ENTRY_SQL = "h long, bh long, doc long, version long, lo long, back smallint, run smallint"
LAST = (1 << 63) - 1


def _sums(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a rolling hash modulo 2^64, and the inverse powers that move a stretch to the start."""
    power, inverse = _powers(1 << max(19, len(letters).bit_length()))
    sums = np.zeros(len(letters) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(LETTER[letters] * power[: len(letters)], out=sums[1:])
    return sums, inverse


def _chunk(letters: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """Entries (lo, back, run, h, bh) of all windows that lie within one of the ``bounds``."""
    n = len(letters)
    ok = np.zeros(max(0, n - LENGTH + 1), bool)
    for start, end in bounds:
        ok[start : max(start, end - LENGTH + 1)] = True
    if not ok.any():
        return tuple(np.empty(0, np.int64) for _ in range(5))
    sums, inverse = _sums(letters)
    with np.errstate(over="ignore"):
        gram = mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
        least = (gram & ~LOW) | np.arange(len(gram), dtype=np.uint64)
        width, span = LENGTH - GRAM + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(ok)], least[width - span : width - span + len(ok)])
        at = (least & LOW).astype(np.int64)
        change = np.flatnonzero(np.diff(at)) + 1
        lo = np.concatenate([[0], change])
        hi = np.concatenate([change, [len(at)]]) - 1
        edges = np.diff(np.concatenate([[0], ok.view(np.int8), [0]]))
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        # cut the runs of equal anchors at the ends of texts
        cuts = np.unique(np.concatenate([lo, starts, stops]))
        cuts = cuts[cuts < len(at)]
        lo, hi = cuts, np.concatenate([cuts[1:], [len(at)]]) - 1
        lo, hi = lo[ok[lo]], hi[ok[lo]]
        anchor = at[lo]
        block = mixed((sums[hi + LENGTH] - sums[lo]) * inverse[lo])
        bh = mixed(block + mixed((anchor - lo).astype(np.uint64) * np.uint64(256) + (hi - lo).astype(np.uint64) + MIX))
        return lo, anchor - lo, hi - lo, gram[anchor].view(np.int64), bh.view(np.int64)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix entries of (doc, version, text)."""
    for batch in batches:
        texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
        doc, version = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        waiting: list[tuple[int, int, bytes]] = []  # row, place in its text, bytes
        size = 0
        for row, text in enumerate(texts):
            for first in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
                part = text[first : first + CHUNK + LENGTH - 1]
                if len(part) >= LENGTH:
                    waiting.append((row, first, part))
                    size += len(part)
                if size >= CHUNK:
                    yield _described(waiting, doc, version)
                    waiting, size = [], 0
        if waiting:
            yield _described(waiting, doc, version)


def _described(parts: list[tuple[int, int, bytes]], doc: np.ndarray, version: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum([len(p[2]) for p in parts])
    starts = ends - [len(p[2]) for p in parts]
    lo, back, run, h, bh = _chunk(np.frombuffer(b"".join(p[2] for p in parts), np.uint8), list(zip(starts, ends, strict=True)))
    which = np.searchsorted(starts, lo, "right") - 1
    row = np.array([p[0] for p in parts])[which]
    place = lo - starts[which] + np.array([p[1] for p in parts])[which]
    return _batch(ENTRY, [h, bh, doc[row], version[row], place, back.astype(np.int16), run.astype(np.int16)])


SPANS = pa.schema([("doc", pa.int64()), ("version", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
BLOCKS = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("version", pa.int64()), ("lo", pa.int64()), ("back", pa.int16()), ("n", pa.int64()), ("block", pa.binary())])
BLOCK_SQL = "h long, doc long, version long, lo long, back smallint, n long, block binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted blocks of (doc, version, text, wanted)."""
    for batch in batches:
        rows: list[list] = [[] for _ in BLOCKS]
        for doc, version, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            data = text.encode()
            for w in wanted:
                for column, value in zip(rows, (w["h"], doc, version, w["lo"], w["back"], w["n"], data[w["lo"] : w["lo"] + w["run"] + LENGTH]), strict=True):
                    column.append(value)
        yield _batch(BLOCKS, rows)


def _windows(h: np.ndarray, blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of every block: its block, its place there, and a fingerprint of its bytes."""
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    starts = np.cumsum(sizes) - sizes
    sums, inverse = _sums(np.frombuffer(b"".join(blocks), np.uint8))
    counts = sizes - LENGTH + 1
    which = np.repeat(np.arange(len(blocks)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[which] + place
    with np.errstate(over="ignore"):
        key = mixed((sums[at + LENGTH] - sums[at]) * inverse[at]) ^ mixed(h.view(np.uint64)[which])
    return which, place, key


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows in groups of equal ``h``; rows are sorted by (h, doc, version, lo)."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if not held.num_rows:
            continue
        h = held.column("h").to_numpy()
        cut = int(np.searchsorted(h, h[-1]))
        if cut:
            yield _repeated(held.slice(0, cut))
        held = held.slice(cut)
    if held is not None and held.num_rows:
        yield _repeated(held)


def _repeated(rows: pa.Table) -> pa.RecordBatch:
    h, doc, version, lo = (rows.column(c).to_numpy() for c in ("h", "doc", "version", "lo"))
    out = []
    step = max(1, CHUNK // 200)
    first = 0
    while first < len(h):  # whole groups, some thousand blocks at a time
        last = min(len(h), first + step)
        last = len(h) if last == len(h) else int(np.searchsorted(h, h[last - 1], "right"))
        which, place, key = _windows(h[first:last], rows.column("block").slice(first, last - first).to_pylist())
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        hit = np.flatnonzero(again)
        if len(hit):
            run = np.flatnonzero((np.diff(hit) != 1) | (np.diff(which[hit]) != 0)) + 1
            a, b = hit[np.concatenate([[0], run])], hit[np.concatenate([run, [len(hit)]]) - 1]
            block = which[a] + first
            out.append((doc[block], version[block], lo[block] + place[a], lo[block] + place[b]))
        first = last
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4
    return _batch(SPANS, columns)


def _parts(blocks: DataFrame, width: int, step: int) -> DataFrame:
    """Blocks cut into one row for each ``step`` places of the anchor in their windows; ``low`` is the first of ``width``.

    Equal windows are in rows of equal ``part``, a key of the bytes that all windows of that part share.
    """
    low = F.explode(F.sequence("low", F.col("low") + width - step, F.lit(step))).alias("low")
    cut = blocks.select(F.col("h").alias("of"), "doc", "version", "lo", "back", "block", low)
    cut = cut.withColumn("head", F.greatest(F.lit(0), F.col("back") - F.col("low") - step + 1))
    cut = cut.withColumn("tail", F.least(F.octet_length("block") - LENGTH, F.col("back") - F.col("low"))).where("head <= tail")
    shared = F.substring("block", F.col("back") - F.col("low") + 1, F.lit(LENGTH - step + 1))
    return cut.select(
        F.xxhash64("of", "low", shared).alias("h"),
        "doc",
        "version",
        (F.col("lo") + F.col("head")).alias("lo"),
        (F.col("back") - F.col("head")).alias("back"),
        F.substring("block", F.col("head") + 1, F.col("tail") - F.col("head") + LENGTH).alias("block"),
        "low",
    )


def _rest(text: bytes, spans: list[tuple[int, int]], characters: bool) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes and runs are gone; ``spans`` are first and last starts of windows."""
    gone: list[list[int]] = []
    for lo, hi in sorted(spans):
        if gone and lo <= gone[-1][1]:
            gone[-1][1] = max(gone[-1][1], hi + LENGTH)
        else:
            gone.append([lo, hi + LENGTH])
    removed, runs = sum(b - a for a, b in gone), len(gone)
    left, end = [], 0
    for a, b in gone:
        if characters:  # a character stays unless all its bytes go
            while a < b and text[a] & 0xC0 == 0x80:
                a += 1
            while b < len(text) and text[b] & 0xC0 == 0x80:
                b -= 1
            while a < b < len(text) and text[b] & 0xC0 == 0x80:
                b -= 1
        left.append(text[end : max(a, end)])
        end = max(b, end)
    return b"".join([*left, text[end:]]), removed, runs


def _removed(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Results of (row, text, spans, copy), beside the row."""
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for text, spans, copy in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            data = text.encode()
            whole = [(0, len(data) - LENGTH)] if copy > 1 and len(data) >= LENGTH else []
            rest, gone, runs = _rest(data, whole or [(s["lo"], s["hi"]) for s in spans or []], texts)
            for column, value in zip(columns, (len(data), gone, runs, rest.decode() if texts else hashlib.sha256(rest).hexdigest()), strict=True):
                column.append(value)
        arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "n_bytes", "n_removed", "n_spans", "rest"])


class IndexFamily:
    """Levels of suffix entries; ``add`` scans a batch against them and inserts it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.levels: list[tuple[int, str]] = []  # rank, folder; the newest last

    def stored(self, df: DataFrame, label: str) -> str:
        path = f"{scratch_dir(self.spark, label)}/data"
        df.write.parquet(path)
        return path

    def delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def entries(self) -> DataFrame:
        frames = [self.spark.read.parquet(path) for _, path in self.levels]
        return reduce(DataFrame.union, frames) if frames else self.spark.createDataFrame([], ENTRY_SQL)

    def add(self, texts: DataFrame) -> str:
        """Scan and insert (doc, version, text), all later than what was added before; folder of repeated spans."""
        batch = self.stored(texts.mapInArrow(_entries, ENTRY_SQL), "suffixes")
        new = self.spark.read.parquet(batch)
        seen = new.withColumn("old", F.lit(0))
        if self.levels:
            seen = seen.union(self.entries().withColumn("old", F.lit(1)))
        first = F.min(F.struct("doc", "version", "lo", "back", "run")).alias("first")
        scanned = seen.groupBy("h", "bh").agg(first, F.count("*").alias("n"), F.max("old").alias("old"), F.min("old").alias("only_old"))
        scanned = self.stored(scanned.where("only_old = 0").select("h", "bh", "first.*", "n", "old"), "scanned")
        blocks = self.spark.read.parquet(scanned)
        again = blocks.where("n > 1").select("h", "bh", F.col("doc").alias("doc0"), F.col("version").alias("version0"), F.col("lo").alias("lo0"))
        spans = new.join(again, ["h", "bh"]).where("doc <> doc0 OR version <> version0 OR lo <> lo0")
        spans = self.stored(spans.select("doc", "version", "lo", (F.col("lo") + F.col("run")).alias("hi")), "spans")
        level = self.stored(blocks.where("old = 0").select("h", "bh", "doc", "version", "lo", "back", "run"), "level")
        self.levels.append((0, level))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a), (_, b) = self.levels[-2:]
            both = self.spark.read.parquet(a).union(self.spark.read.parquet(b))
            merged = self.stored(both.repartition("h").sortWithinPartitions("h", "bh"), "level")
            self.levels[-2:] = [(rank + 1, merged)]
            self.delete(a)
            self.delete(b)
        self.delete(batch)
        self.delete(scanned)
        released(self.spark)
        return spans

    def close(self) -> None:
        for _, path in self.levels:
            self.delete(path)
        self.levels = []


def _identified(docs: DataFrame, carried: list[str]) -> tuple[DataFrame, bool]:
    """(doc, version, text, row), which orders all rows, and whether ids are null or repeated.

    ``version`` is 0 where ids are plain and a hash of the text else; ``row`` has the columns to carry.
    """
    repeated = not docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty()
    text = F.coalesce("text", F.lit(""))
    version = F.xxhash64(text) if repeated else F.lit(0).cast("long")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    row = F.struct(*[F.col(f"`{c}`") for c in carried])
    return docs.select(doc.alias("doc"), version.alias("version"), text.alias("text"), row.alias("row")), repeated


def spans(rows: DataFrame, batches: int = BATCHES, repeated: bool = False) -> DataFrame:
    """(doc, version, lo, hi): first and last start of repeated windows, runs in no order.

    If rows are ``repeated``, those equal in doc and version are one here, so that no row repeats its own copy.
    """
    spark = rows.sparkSession
    small_batches(spark)
    family = IndexFamily(spark)
    if repeated:
        once = family.stored(rows.select("doc", "version", "text").dropDuplicates(["doc", "version"]), "once")
        rows = spark.read.parquet(once)
    parts = [k / batches for k in range(1, batches)]
    cuts = rows.where(F.col("doc") < LAST).agg(F.percentile_approx("doc", parts)).first()[0] if parts else []
    cuts = sorted(set(cuts or []))
    found = []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = rows if low is None else rows.where(F.col("doc") > low)
        part = part if high is None else part.where(F.col("doc") <= high)
        found.append(family.add(part.select("doc", "version", "text")))
    entries = family.entries()
    alike = entries.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    wanted = entries.join(alike, "h").select("doc", "version", F.struct("h", "lo", "back", "run", "n").alias("want"))
    wanted = wanted.groupBy("doc", "version").agg(F.collect_list("want").alias("wanted"))  # at most what one text has
    wanted = family.stored(wanted, "wanted")
    family.close()
    released(spark)
    texts = rows.select("doc", "version", "text").join(spark.read.parquet(wanted), ["doc", "version"])
    stored = family.stored(texts.mapInArrow(_blocks, BLOCK_SQL), "blocks")
    released(spark)
    blocks = spark.read.parquet(stored)
    for width, step in zip(PARTS, [*PARTS[1:], None], strict=True):
        few = blocks.where(F.col("n") <= TOGETHER).select("h", "doc", "version", "lo", "block").repartition("h").sortWithinPartitions("h", "doc", "version", "lo")
        found.append(family.stored(few.mapInArrow(_groups, "doc long, version long, lo long, hi long"), "spans"))
        many = blocks.where(F.col("n") > TOGETHER)
        if step is None or many.isEmpty():  # a part of one place has one block
            break
        many = many if "low" in many.columns else many.withColumn("low", F.lit(0))
        parts = family.stored(_parts(many, width, step), "parts")
        family.delete(stored)
        rows_of = spark.read.parquet(parts).withColumn("whole", F.xxhash64("block", "back"))
        first = rows_of.groupBy("h", "whole").agg(F.min(F.struct("doc", "version", "lo", "back", "block", "low")).alias("first"), F.count("*").alias("copies"))
        firsts = family.stored(first.select("h", "whole", "first.*", "copies"), "firsts")
        distinct = spark.read.parquet(firsts)
        heads = distinct.where("copies > 1").select("h", "whole", F.col("doc").alias("doc0"), F.col("version").alias("version0"), F.col("lo").alias("lo0"))
        again = rows_of.join(heads, ["h", "whole"]).where("doc <> doc0 OR version <> version0 OR lo <> lo0")
        found.append(family.stored(again.select("doc", "version", "lo", (F.col("lo") + F.octet_length("block") - LENGTH).alias("hi")), "spans"))
        alike = distinct.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
        stored = family.stored(distinct.drop("whole", "copies").join(alike, "h"), "blocks")
        family.delete(parts)
        family.delete(firsts)
        released(spark)
        blocks = spark.read.parquet(stored)
    family.delete(stored)
    family.delete(wanted)
    if repeated:
        family.delete(once)
    released(spark)
    return reduce(DataFrame.union, [spark.read.parquet(path) for path in found])


def _cleaned(docs: DataFrame, carried: list[str], batches: int, texts: bool) -> DataFrame:
    rows, repeated = _identified(docs, carried)
    gone = spans(rows, batches, repeated).groupBy("doc", "version").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    copy = F.row_number().over(Window.partitionBy("doc", "version").orderBy("doc")) if repeated else F.lit(1)
    joined = rows.join(gone, ["doc", "version"], "left").select("row", "text", "spans", copy.alias("copy"))
    kind = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(lambda b: _removed(b, texts), f"row {kind}, n_bytes long, n_removed long, n_spans long, rest string")


def removals(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): bytes and runs removed, digest of the bytes that stay."""
    out = _cleaned(docs, ["doc_id"], batches, False)
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.col("rest").alias("kept_sha256"))


def deduplicated(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The documents with what is left of their texts, and ``n_chars``, if there, counted again."""
    out = _cleaned(docs, [c for c in docs.columns if c != "text"], batches, True)
    out = out.where(F.col("n_removed").eqNullSafe(0) | F.col("rest").rlike(WORD))
    new = {"text": F.col("rest"), "n_chars": F.length("rest").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
