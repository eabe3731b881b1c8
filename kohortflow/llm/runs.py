"""Periodic runs of words: stretches that repeat with a period, found through Lyndon roots.

A document is a sequence of words. The first phase of Baier's suffix sorter groups suffixes by their longest Lyndon
prefix, so the lengths it keeps per group are the Lyndon array; run once under the order of the words and once under
its reverse it gives a Lyndon root of every run. Each root is extended to both sides by longest common extensions
(exact names of blocks of doubling length, no hashes), which gives the run.

Only documents are independent of each other, so the job is one map over them without a shuffle. A run of at least
``max(6, 4 * period)`` words holds each of its three-word strings three times, so stretches of strings that
occur less often are left out before sorting; that is exact, as a maximal run lies in one such stretch whole.

Defined results: a null or empty text has no runs. Ids may be null or repeat, rows as well: every row is treated by
itself (a null id counts as one whose digest is not divisible by 10). Very long texts take memory
in proportion to n log n of their longest stretch. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.llm.common import small_batches

LEAST = 6  # words of a run, and
PERIODS = 4  # so many times its period
GRAM = 3

FIELDS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def lyndon_array(names: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place: the grouping phase of Baier's suffix sorter.

    Groups stand in a linked list in order of their common Lyndon prefix and are taken from the greatest down. A
    taken suffix is removed from the line; the nearest one left of it that remains lies in a smaller group, and is
    moved behind that group, its prefix longer by the taken group's.
    """
    n = len(names)
    length = [1] * n
    letters = np.unique(names, return_inverse=True)[1]
    group = letters.tolist()
    top = max(group) + 1
    members: list[set[int]] = [set() for _ in range(top)]
    for i, g in enumerate(group):
        members[g].add(i)
    below = list(range(-1, top - 1))  # next smaller group
    above = [*range(1, top), -1]
    left = list(range(-1, n - 1))  # nearest remaining suffix to the left, lazily shortened
    gone = bytearray(n)
    current = top - 1
    while current >= 0:
        taken = members[current]
        if taken:
            own = length[next(iter(taken))]
            for i in taken:
                gone[i] = 1
            pointed: dict[int, int] = defaultdict(int)
            for i in taken:
                j = left[i]
                path = [i]
                while j >= 0 and gone[j]:
                    path.append(j)
                    j = left[j]
                for k in path:
                    left[k] = j
                if j >= 0:
                    pointed[j] += 1
            by_count: dict[int, dict[int, list[int]]] = {}
            for j, count in pointed.items():
                by_count.setdefault(count, {}).setdefault(group[j], []).append(j)
            for count in sorted(by_count, reverse=True):
                for old, moved in by_count[count].items():
                    new = len(members)
                    members.append(set(moved))
                    members[old].difference_update(moved)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = new
                    if up >= 0:
                        below[up] = new
                    for j in moved:
                        group[j] = new
                        length[j] += count * own
        members[current] = set()
        current = below[current]
    return np.array(length, dtype=np.int64)


class Extensions:
    """Longest common extensions of pairs of places, from exact names of blocks of 1, 2, 4, ... letters."""

    def __init__(self, names: np.ndarray):
        self.n = len(names)
        level = np.unique(names, return_inverse=True)[1].astype(np.int64)
        self.levels = [level.astype(np.int32)]
        width = 1
        while 2 * width <= self.n:
            pair = level[:-width] * (int(level.max()) + 1) + level[width:]
            level = np.unique(pair, return_inverse=True)[1].astype(np.int64)
            self.levels.append(level.astype(np.int32))
            width *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Letters that agree from ``a`` and from ``b`` on (a < b)."""
        a, b = a.copy(), b.copy()
        found = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[k], 1 << k
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                fits = np.flatnonzero(b + width <= self.n)
                same = fits[level[a[fits]] == level[b[fits]]]
                a[same] += width
                b[same] += width
                found[same] += width
        return found

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Letters that agree before ``a`` and before ``b`` (a < b)."""
        a, b = a.copy(), b.copy()
        found = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[k], 1 << k
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                fits = np.flatnonzero(a >= width)
                same = fits[level[a[fits] - width] == level[b[fits] - width]]
                a[same] -= width
                b[same] -= width
                found[same] += width
        return found


def _runs_of(names: np.ndarray, least: int, periods: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of a stretch."""
    n = len(names)
    extend = Extensions(names)
    found: set[tuple[int, int, int]] = set()
    for order in (names, int(names.max()) - names):
        root = lyndon_array(order)
        at = np.arange(n)
        if periods >= 3:  # the first root in a run of three periods is followed by a second copy
            at = at[at + 2 * root <= n]
            at = at[names[at] == names[at + root[at]]]
        p = root[at]
        right = extend.right(at, at + p)
        if periods >= 3:
            whole = right >= p
            at, p, right = at[whole], p[whole], right[whole]
        left = extend.left(at, at + p)
        length = left + p + right
        long = (length >= least) & (length >= periods * p)
        found.update(zip((at - left)[long].tolist(), length[long].tolist(), p[long].tolist(), strict=True))
    return found


def find_runs(names: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs of a sequence of small whole numbers, by start, then period.

    ``least`` and ``periods`` of at least 6 and 4 are needed for the stretches (see above); below, the whole
    sequence is searched.
    """
    n = len(names)
    if n < max(least, 2):
        return []
    if least < 6 or periods < 4:
        return sorted(_runs_of(names, least, periods), key=lambda r: (r[0], r[2]))
    grams = names.astype(np.int64)
    for k in range(1, GRAM):
        size = n - k
        grams = grams[:size] * (int(names.max()) + 1) + names[k : k + size]
        grams = np.unique(grams, return_inverse=True)[1]
    often = np.bincount(grams)[grams] >= 3
    edges = np.flatnonzero(np.diff(np.concatenate([[0], often.astype(np.int8), [0]])))
    runs: list[tuple[int, int, int]] = []
    for a, b in zip(edges[::2].tolist(), (edges[1::2] + GRAM - 1).tolist(), strict=True):
        if b - a >= least:
            runs += [(a + s, length, p) for s, length, p in _runs_of(names[a:b], least, periods)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers by first appearance."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Every tenth document (by digest of its id) gets a run to its end, as the query's contract has it."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, least: int = LEAST, periods: int = PERIODS, plant: bool = False) -> DataFrame:
    """(doc_id, runs: array of start, length, period; collapsed: text without the repeats) of every document."""
    small_batches(docs.sparkSession)
    kind = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    arrow = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or b"").split()
                if plant:
                    words = planted(words, doc_id)
                runs = find_runs(numbered(words), least, periods)
                rows.append({
                    "doc_id": doc_id,
                    "runs": [{"start": s, "length": n, "period": p} for s, n, p in runs],
                    "collapsed": b" ".join(collapsed(words, runs)).decode("utf-8", "replace"),
                })
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(search, kind)


def strongest(runs: list[dict]) -> dict | None:
    """The run of greatest exact length over period; ties by start, then period."""
    return min(runs, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None)


def digests(found: DataFrame) -> DataFrame:
    """One row of numbers and digests for each row of ``periodic_runs``."""
    arrow = pa.schema([(name, pa.string() if name.endswith("256") else pa.int64()) for name in (f.split()[0] for f in FIELDS.split(", "))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                best = strongest(row["runs"])
                lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in row["runs"])
                rows.append({
                    "doc_id": row["doc_id"], "n_runs": len(row["runs"]), **(best or {"start": None, "length": None, "period": None}),
                    "exponent_milli": best and 1000 * best["length"] // best["period"],
                    "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
                    "collapsed_sha256": hashlib.sha256(row["collapsed"].encode()).hexdigest(),
                })
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return found.mapInArrow(digest, FIELDS)
