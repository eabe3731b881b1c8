"""Near-duplicate documents by a chosen-path similarity join.

A document is the set of its five-word shingles, embedded as 128 minwise tokens. A tree branches documents by
selected tokens: a node, which is a path of tokens, picks one coordinate (at a root with probability 1/3 a second, below with
1/2), and the documents that agree there form the child. Copies with a similarity of 0.75 stay together in 1 child on average
at the root and in 1.1 below, so pairs survive at any depth, while other documents part. There are 16 independent trees.
A pair at 0.75 is missed at depth 1, where most nodes end, with less than 1 in 10^11; deeper the recall is measured, see the README.

- Equal word sequences are one class first, so copies cost one row.
- Only documents that share 75 % of their shingles with others go on: what no other text holds is in no intersection.
  Shingles meet by ranges of their hashes, as arrays for a batch of texts, in which a frequent one is a single entry. Up to
  256 documents all go on, as the trees then cost less.
- Nodes are compared in cells: a node of at most 256 documents is one, a larger one is cut into slices of about 256 by
  hash. A cell is compared exhaustively on 8-bit sketches, and a document passes on only its best partner and its best
  partner of a smaller id, so the pairs grow with the documents and not with the square of a group. The best of all cells are
  confirmed on the full shingle sets and connected.
- Likely pairs that are still in different components are then judged in their cell on samples of their shingles, which
  are the whole set up to 512 shingles, so documents that are alike but below 0.75 do not go on. The rest is confirmed in
  groups: what pairs connect within a cell is one group, known by a signature, so that a group met in many trees is
  confirmed once. Every text goes to a group once, all intersections are a product of matrices there, and a spanning tree of
  the links comes out.
- Large nodes: rows outside the node's most common component, if at most 256, join every slice. With more, the nodes that
  have documents in common are a family. Its documents are cut into blocks and every two blocks are a cell, if that takes at
  most four rows for each row of its nodes. Otherwise its nodes branch again, as deep as it takes; so no size of a node drops
  a pair. Tables of a finished level are deleted.

Nodes are only counted and split by shuffles; no more than a cell (about 256 documents and 256 apart) is ever compared at once. Components are computed
by star contractions on the links, never on the driver.

Defined results: a null or empty text, or one without words, has no shingles, is linked with nothing and is its own
component; fewer than five words are one shingle. Rows of one id are one document, and a link of any of its texts
counts; a null id is kept apart from all others and never linked. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.llm.common import connected, released, small_batches
from kohortflow.session import cut_lineage, scratch_dir

SHINGLE = 5
TREES = 16
COORDINATES = 128
SMALL = 256  # documents of a node, or of a slice of one, that are compared in one task
MEETINGS = 4  # rows that a family of large nodes takes at most for one of its rows, if its blocks are compared
STEPS = 6  # tokens that a large node takes at most before its children are compared
NEEDED = 75  # percent
DEVIATIONS = 5  # by which a sketch or sample may fall short of the expected agreement
SAMPLE = 512  # shingles that a sample holds about at most; smaller sets are whole
FEW = 256  # documents that all go on
RANGE = 1 << 22  # shingles of all texts that meet in one range of the hashes, at 256 ranges or more
TOGETHER = 1 << 20  # shingles of a batch of texts, if it has more than one
NOBODY = np.uint16((1 << 16) - 1)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LETTER = mixed(np.arange(256, dtype=np.uint64) + MIX)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, n of each."""
    base = 0x5851F42D4C957F2D
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        with np.errstate(over="ignore"):
            row = np.full(n, b, np.uint64)
            row[0] = 1
            out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def shingles(text: str | None) -> tuple[np.ndarray, int, int]:
    """Distinct 64-bit fingerprints of a text's shingles, and two fingerprints of its sequence of words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64), 0, 0
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    letters = np.frombuffer(b"".join(words), np.uint8)
    power, inverse = _powers(1 << max(16, int(len(letters)).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(LETTER[letters] * power[: len(letters)], out=sums[1:])
        starts = ends - lengths
        word = mixed((sums[ends] - sums[starts]) * inverse[starts] + lengths.astype(np.uint64) * MIX)
        n = max(1, len(words) - SHINGLE + 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(SHINGLE, len(words))):
            out = mixed(out * np.uint64(31) + word[k : k + n] + np.uint64(k + 1))
        place = mixed(word ^ (np.arange(len(words), dtype=np.uint64) * MIX))
        return np.unique(out), int(place.sum(dtype=np.uint64)) ^ len(words), int(mixed(place).sum(dtype=np.uint64))


_RNG = np.random.default_rng(5)
#: First hash of each stretch; the last stretch ends with the range.
BUCKET_EDGES = np.array([*range(0, 1 << 64, (1 << 64) // COORDINATES), (1 << 64) - 1], np.uint64)
PROBES = np.array([_RNG.permutation(COORDINATES) for _ in range(COORDINATES)])


def minwise(tokens: np.ndarray) -> np.ndarray:
    """The embedding, by one permutation: the least token of each of 128 stretches of the hash range.

    An empty stretch takes the token of the first stretch that is not, in an order of its own, so that two sets agree
    in a coordinate with a probability of their similarity. ``tokens`` are sorted.
    """
    edges = np.searchsorted(tokens, BUCKET_EDGES)
    filled = edges[1:] > edges[:-1]
    out = tokens[np.minimum(edges[:-1], len(tokens) - 1)].astype(np.uint32)
    empty = np.flatnonzero(~filled)
    if len(empty):
        out[empty] = out[PROBES[empty, filled[PROBES[empty]].argmax(axis=1)]]
    return out


def _batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


PREPARED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("tokens", pa.binary()), ("sketch", pa.binary())])
PREPARED_SQL = "doc_id long, n_shingles long, k1 long, k2 long, tokens binary, sketch binary"


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[] for _ in PREPARED]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s, k1, k2 = shingles(text)
            signed = np.array([k1, k2], np.uint64).view(np.int64).tolist()
            tokens = minwise(s) if len(s) else None
            made = (None, None) if tokens is None else (tokens.tobytes(), tokens.astype(np.uint8).tobytes())
            for column, value in zip(rows, (doc_id, len(s), *signed, *made), strict=True):
                column.append(value)
        yield _batch(PREPARED, rows)


PARTS = pa.schema([("part", pa.int64()), ("batch", pa.int64()), ("values", pa.binary()), ("owners", pa.binary())])
PARTS_SQL = "part long, batch long, values binary, owners binary"


def _own_part(batch: int) -> int:
    """A part, none of a range, for what a batch says of its own texts."""
    return batch if batch < 0 else -1 - batch


def _told(ids: list[int], sets: list[np.ndarray], places: list[int], bits: int) -> pa.RecordBatch:
    """The shingles of a batch of different texts by ranges, and its documents with the shingles that meet in the batch.

    A shingle of several texts is one entry that no text owns. ``places`` tell the text of each of ``ids``.
    """
    owner = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(x) for x in sets])
    every = np.concatenate(sets)
    value, first, place, times = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
    met = np.bincount(owner, weights=times[place] > 1, minlength=len(sets)).astype(np.int64)
    held = np.where(times > 1, NOBODY, owner[first])
    low = ((value >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    part = (value >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    batch = ids[0]
    at = np.array(places)
    documents = np.array([ids, at, np.array([len(x) for x in sets])[at], met[at]], np.int64)
    parts = [_own_part(batch), *part[edges[:-1]].tolist()]
    values = [documents.tobytes(), *(low[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True))]
    owners = [None, *(held[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True))]
    return _batch(PARTS, [parts, [batch] * len(parts), values, owners])


def _parts(bits: int):
    """Shingles of each (doc_id, text), by 2 ** ``bits`` ranges of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets, places, seen, size = [], [], [], {}, 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s, *key = shingles(text)
                if not len(s):
                    continue
                if ids and (size + len(s) > TOGETHER or len(sets) == NOBODY):
                    yield _told(ids, sets, places, bits)
                    ids, sets, places, seen, size = [], [], [], {}, 0
                place = seen.setdefault(tuple(key), len(sets))
                if place == len(sets):
                    sets.append(s)
                    size += len(s)
                ids.append(doc_id)
                places.append(place)
            if ids:
                yield _told(ids, sets, places, bits)

    return run


MET = pa.schema([("batch", pa.int64()), ("documents", pa.binary()), ("owners", pa.binary())])
MET_SQL = "batch long, documents binary, owners binary"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch the owners of shingles that another batch has in the range; what it says of its own texts goes on."""
    for rows in _by_key(batches, "part"):
        part, batch = rows.column("part").to_numpy(), rows.column("batch").to_numpy()
        values, owners = rows.column("values").to_pylist(), rows.column("owners").to_pylist()
        firsts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(firsts, np.r_[firsts[1:], len(part)], strict=True):
            if part[a] < 0:
                yield _batch(MET, [batch[a:b], values[a:b], [None] * (b - a)])
                continue
            value = np.frombuffer(b"".join(values[a:b]), np.uint32)
            owner = np.frombuffer(b"".join(owners[a:b]), np.uint16)
            order = np.argsort(value, kind="stable")
            again = np.diff(value[order]) == 0
            met = np.zeros(len(value), bool)
            met[order] = np.r_[again, False] | np.r_[False, again]
            met &= owner != NOBODY
            ends = np.cumsum([len(x) // 2 for x in owners[a:b]])
            out = [owner[e - len(x) // 2 : e][met[e - len(x) // 2 : e]].tobytes() for e, x in zip(ends, owners[a:b], strict=True)]
            some = [i for i, x in enumerate(out) if x]
            yield _batch(MET, [batch[a:b][some], [None] * len(some), [out[i] for i in some]])


SHARING = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("met", pa.int64())])
SHARING_SQL = "id long, n long, met long"


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, shingles, shingles that another text holds) of the documents whose shared ones reach the similarity."""
    for rows in _by_key(batches, "batch"):
        batch = rows.column("batch").to_numpy()
        documents, owners = rows.column("documents").to_pylist(), rows.column("owners").to_pylist()
        firsts = np.flatnonzero(np.r_[True, batch[1:] != batch[:-1]])
        for a, b in zip(firsts, np.r_[firsts[1:], len(batch)], strict=True):
            told = [np.frombuffer(x, np.int64).reshape(4, -1) for x in documents[a:b] if x is not None]
            # batches that begin with the same id cannot be told apart, so each gets what all of them met
            times = np.bincount(np.frombuffer(b"".join(x for x in owners[a:b] if x is not None), np.uint16), minlength=1 << 16)
            for ids, place, n, met in told:
                met = np.minimum(met + times[place], n)
                ok = 100 * met >= NEEDED * n
                yield _batch(SHARING, [ids[ok], n[ok], met[ok]])


NODES = pa.schema([("node", pa.int64()), ("id", pa.int64())])


def _children(ids: np.ndarray, paths: np.ndarray, tokens: np.ndarray, roots: bool) -> pa.RecordBatch:
    """Child nodes of each document: one by the coordinate its node picks, and with probability 1/3 (below the roots 1/2) a second."""
    rows = np.arange(len(ids))
    with np.errstate(over="ignore"):
        chosen = mixed(paths + np.uint64(11))
        first = (paths * np.uint64(COORDINATES // TREES)) if roots else chosen  # roots: other coordinates for each tree
        spread = (chosen >> np.uint64(8)) % np.uint64(COORDINATES - 1) + np.uint64(1)
        two = (chosen >> np.uint64(40)) % np.uint64(3 if roots else 2) == 0
        a = (first % np.uint64(COORDINATES)).astype(np.int64)
        b = ((first + spread) % np.uint64(COORDINATES)).astype(np.int64)
        path = mixed(paths + MIX)
        one = mixed(path ^ mixed(tokens[rows, a].astype(np.uint64) + MIX * np.uint64(3)))
        other = mixed(path ^ mixed(tokens[rows, b].astype(np.uint64) + MIX * np.uint64(5)))
    nodes = np.concatenate([one, other[two]]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate([ids, ids[two]]))], schema=NODES)


def _embedding(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            ids, tokens = batch.column(0).to_numpy(), _embedding(batch.column(1))
            for tree in range(TREES):
                yield _children(ids, np.full(len(ids), tree, np.uint64), tokens, True)


def _next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Child nodes of each (node, id, tokens)."""
    for batch in batches:
        if batch.num_rows:
            nodes, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield _children(ids, nodes.view(np.uint64), _embedding(batch.column(2)), False)


def _likely(na: np.ndarray, nb: np.ndarray, ma: np.ndarray, mb: np.ndarray, sa: np.ndarray, sb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs may reach the similarity, by their sizes, shared shingles and sketches; how many sketch bytes agree.

    An intersection is not above the shingles (ma, mb) that a text shares with any other.
    """
    agree = (sa == sb).sum(axis=1).astype(np.int32)
    samples = np.minimum(np.minimum(na, nb), COORDINATES)  # a small set gives fewer independent coordinates
    least = COORDINATES * (NEEDED / 100 - DEVIATIONS * np.sqrt(NEEDED * (100 - NEEDED) / 1e4 / samples))
    return ((100 + NEEDED) * np.minimum(ma, mb) >= NEEDED * (na + nb)) & (agree >= least), agree


def _halvings(n: np.ndarray) -> np.ndarray:
    """How often the hash range is halved for the sample of n shingles."""
    return np.ceil(np.log2(np.maximum(n, SAMPLE) / SAMPLE)).astype(np.int64)


def sample(tokens: np.ndarray) -> np.ndarray:
    """Low 16 bits of the sorted ``tokens`` in the lowest part of the hash range, after the number of those in its lower half."""
    shift = 64 - int(_halvings(len(tokens)))
    in_part, in_half = (int(np.searchsorted(tokens, np.uint64(1 << s))) if s < 64 else len(tokens) for s in (shift, shift - 1))
    return np.r_[np.uint16(in_half), tokens[:in_part].astype(np.uint16)]


SAMPLED = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("sketch", pa.binary()), ("sample", pa.binary())])
SAMPLED_SQL = "id long, n_shingles long, sketch binary, sample binary"


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketch and sample of each (id, text) with shingles."""
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = shingles(text)[0]
            if len(s):
                rows.append((doc_id, len(s), minwise(s).astype(np.uint8).tobytes(), sample(s).tobytes()))
        yield _batch(SAMPLED, list(zip(*rows, strict=True)) or [[]] * len(SAMPLED))


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.flatnonzero(times > 1)
    place = np.full(len(times), -1)
    place[common] = np.arange(len(common))
    column = place[token]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    step = 4096  # tokens at a time; a product of zeros and ones is exact
    for first in range(0, len(common), step):
        a, b = np.searchsorted(column, [first, first + step])
        held = np.zeros((len(sets), min(step, len(common) - first)), np.float32)
        held[owner[a:b], column[a:b] - first] = 1
        both += held @ held.T
    return both


def _sharper(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of rows may reach the similarity by their samples; without sampling, which do.

    Two tokens of one set may agree in 16 bits: as many as a set loses so are added to the intersection.
    """
    halved = _halvings(rows.column("n_shingles").to_numpy())
    samples = [np.frombuffer(x, np.uint16) for x in rows.column("sample").to_pylist()]
    cell = rows.column("cell").to_numpy()[i]
    level = np.maximum(halved[i], halved[j])
    out = np.zeros(len(i), bool)
    order = np.lexsort((level, cell))
    changes = (cell[order][1:] != cell[order][:-1]) | (level[order][1:] != level[order][:-1])
    for at in np.split(order, np.flatnonzero(changes) + 1):
        depth = level[at[0]]
        docs, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        a, b = place[: len(at)], place[len(at) :]
        # sizes differ by a third at most, so the other range of a pair is halved once less at most
        parts = [samples[d][1:] if halved[d] == depth else samples[d][1 : 1 + samples[d][0]] for d in docs]
        sets = [np.unique(x) for x in parts]
        n, lost = np.array([(len(x), len(x) - len(y)) for x, y in zip(parts, sets, strict=True)]).T
        if 20 * len(at) < len(docs) ** 2:
            both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)])
        else:
            both = _shared(sets)[a, b]
        both = both + np.minimum(lost[a], lost[b])
        union = n[a] + n[b] - both
        slack = 0 if depth == 0 else DEVIATIONS * np.sqrt(NEEDED * (100 - NEEDED) * np.maximum(union, 1))
        out[at] = 100 * both >= NEEDED * union - slack
    return out


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from a partition sorted by ``key``; a group may continue in the next batch."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if held.num_rows:
            keys = held.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield held.slice(0, cut)
                held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _scan(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions of the likely pairs of different components within each cell, and their agreement."""
    cell, n, component, alone = (rows.column(c).to_numpy() for c in ("cell", "n_shingles", "component", "alone"))
    met = n - alone
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, COORDINATES)
    for d in range(1, rows.num_rows):
        left = np.flatnonzero(cell[:-d] == cell[d:])
        if not len(left):
            return
        for at in np.array_split(left, len(left) // 20_000 + 1):
            at = at[component[at] != component[at + d]]
            ok, agree = _likely(n[at], n[at + d], met[at], met[at + d], sketch[at], sketch[at + d])
            yield at[ok], at[ok] + d, agree[ok]


BEST = pa.schema([("cell", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("agree", pa.int32())])
BEST_SQL = "cell long, a long, b long, agree int"


def _best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The likely pairs of each document of a cell with its best partner and its best partner of a smaller id."""
    for rows in _by_key(batches, "cell"):
        cell, ids = rows.column("cell").to_numpy(), rows.column("id").to_numpy()
        score = np.full((2, len(ids)), -1, np.int32)
        partner = np.zeros((2, len(ids)), np.int64)
        for i, j, agree in _scan(rows):
            for x, y in ((i, j), (j, i)):
                for kind, allowed in enumerate((np.ones(len(x), bool), ids[y] < ids[x])):
                    better = allowed & (agree > score[kind, x])
                    score[kind, x[better]], partner[kind, x[better]] = agree[better], ids[y[better]]
        for kind in (0, 1):
            at = np.flatnonzero(score[kind] >= 0)
            if kind:
                at = at[partner[1, at] != partner[0, at]]
            one, other = ids[at], partner[kind, at]
            yield _batch(BEST, [cell[at], np.minimum(one, other), np.maximum(one, other), score[kind, at]])


GROUPS = pa.schema([("sig", pa.int64()), ("id", pa.int64()), ("size", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
GROUPS_SQL = "sig long, id long, size long, low long, high long"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each cell that likely pairs connect, by sketch and sample, under a signature of the group's ids."""
    for rows in _by_key(batches, "cell"):
        ids = rows.column("id").to_numpy()
        found = [(i, j) for i, j, _ in _scan(rows) if len(i)]
        if not found:
            continue
        i, j = (np.concatenate(side) for side in zip(*found, strict=True))
        near = _sharper(rows, i, j)
        if not near.any():
            continue
        i, j = i[near], j[near]
        label, before = np.arange(len(ids)), None
        while before is None or (label != before).any():
            before = label.copy()
            least = np.minimum(label[i], label[j])
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            label = label[label]
        at = np.unique(np.concatenate([i, j]))
        _, group = np.unique(label[at], return_inverse=True)
        order = np.lexsort((ids[at], group))
        group, member = group[order], ids[at][order]
        firsts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[firsts, len(group)])
        with np.errstate(over="ignore"):
            sig = mixed(np.add.reduceat(mixed(member.view(np.uint64) + MIX), firsts) + size.astype(np.uint64)).view(np.int64)
        lasts = firsts + size - 1
        yield _batch(GROUPS, [sig[group], member, size[group], member[firsts][group], member[lasts][group]])


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text of a, text of b) that reach the similarity on their full sets."""
    last: tuple[int | None, np.ndarray] = (None, np.empty(0, np.uint64))
    for batch in batches:
        found: list[list] = [[], []]
        for a, b, ta, tb in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if last[0] != a:
                last = (a, shingles(ta)[0])
            if _similar(last[1], shingles(tb)[0]):
                found[0].append(a)
                found[1].append(b)
        yield _batch(LINKS, found)


def _similar(sa: np.ndarray, sb: np.ndarray) -> bool:
    both = len(np.intersect1d(sa, sb, assume_unique=True))
    return 100 * both >= NEEDED * (len(sa) + len(sb) - both)


def _forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of sets that reach the similarity, one spanning tree for all that are connected."""
    if len(sets) == 2:
        return [(0, 1)] if _similar(*sets) else []
    sizes = np.array([len(x) for x in sets])
    both = _shared(sets)
    linked = 100 * both >= NEEDED * (sizes[:, None] + sizes[None, :] - both)
    out, left = [], np.ones(len(sets), bool)
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            at = front.pop()
            near = np.flatnonzero(linked[at] & left)
            left[near] = False
            out += [(at, int(x)) for x in near]
            front += near.tolist()
    return out


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within groups (sig, id, text) by their full sets."""
    for rows in _by_key(batches, "sig"):
        sig, ids = rows.column("sig").to_numpy(), rows.column("id").to_numpy()
        firsts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        found: list[list] = [[], []]
        for a, b in zip(firsts, np.r_[firsts[1:], len(sig)], strict=True):
            links = _forest([shingles(t)[0] for t in rows.column("text").slice(a, b - a).to_pylist()])
            found[0] += [ids[a + x] for x, _ in links]
            found[1] += [ids[a + y] for _, y in links]
        yield _batch(LINKS, found)


class _Join:
    """The state of one join: representatives, texts that may be needed, components so far."""

    def __init__(self, docs: DataFrame) -> None:
        self.spark = docs.sparkSession
        small_batches(self.spark)
        one = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
        self.docs = one
        self.steps: list[str] = []
        prepared = self.stored(one.mapInArrow(_prepare, PREPARED_SQL))
        self.prepared = cut_lineage(prepared.select("doc_id", "n_shingles", "k1", "k2"))
        classes = prepared.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("id"))
        self.classes = cut_lineage(classes)
        reps = prepared.join(self.classes.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").where("n_shingles > 0")
        reps = reps.select(F.col("doc_id").alias("id"), "n_shingles", "tokens", "sketch")
        count, total = self.prepared.agg(F.count("*"), F.sum("n_shingles")).first()
        self.reps = cut_lineage(reps.join(self.sharing(total), "id") if count > FEW else reps.withColumn("alone", F.lit(0).cast("long")))
        self.components = None
        self.tried: list[DataFrame] = []  # pairs, groups that were confirmed or refuted on full sets
        self.done: list[DataFrame] = []
        self.texts = None
        self.drop_steps()

    def sharing(self, total: int) -> DataFrame:
        """(id, alone) of the documents that may be linked, by the number of shingles that no other text holds, of ``total``."""
        bits = max(8, (total // RANGE).bit_length())
        parts = self.docs.mapInArrow(_parts(bits), PARTS_SQL)
        met = parts.repartition("part").sortWithinPartitions("part").mapInArrow(_met, MET_SQL)
        rows = met.repartition("batch").sortWithinPartitions("batch").mapInArrow(_sharing, SHARING_SQL)
        return rows.groupBy("id").agg(F.min(F.col("n") - F.col("met")).alias("alone"))

    def stored(self, df: DataFrame) -> DataFrame:
        """``df`` as a table that goes with :meth:`drop_steps`."""
        path = f"{scratch_dir(self.spark, 'step')}/data"
        df.write.parquet(path)
        self.steps.append(path)
        return self.spark.read.parquet(path)

    def drop_steps(self, end: int | None = None) -> None:
        """Delete the oldest step tables, which nothing reads again, and the shuffle files behind them."""
        for path in self.steps[:end]:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.steps = [] if end is None else self.steps[end:]
        released(self.spark)

    def labelled(self, frame: DataFrame) -> DataFrame:
        """``frame`` with the component of its ``id``; an id without links is its own."""
        if self.components is None:
            return frame.withColumn("component", F.col("id"))
        return frame.join(self.components, "id", "left").withColumn("component", F.coalesce("component", "id"))

    def scanned(self, cells: DataFrame, scan, schema: str, sets: DataFrame | None = None) -> DataFrame:
        """``scan`` over (cell, id, component) with the sketches, or what else ``sets`` holds."""
        sets = self.reps.select("id", "n_shingles", "sketch", "alone") if sets is None else sets
        rows = cells.join(sets, "id").select("cell", "id", "n_shingles", "component", *sets.columns[2:])
        return self.stored(rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(scan, schema))

    def confirm_best(self, best: DataFrame) -> None:
        """Confirm each document's best pair and best pair with a smaller id, over all its cells."""
        both = best.select(F.col("a").alias("id"), F.col("b").alias("other"), "agree").union(best.select("b", "a", "agree"))
        by = F.struct("agree", -F.col("other"))
        smaller = F.col("other") < F.col("id")
        top = both.groupBy("id").agg(F.max_by("other", by).alias("any"), F.max_by("other", F.when(smaller, by)).alias("smaller"))
        other = F.explode(F.array("any", "smaller")).alias("other")
        pairs = top.withColumn("smaller", F.when(F.col("smaller") < F.col("id"), F.col("smaller"))).select("id", other).where("other IS NOT NULL")
        pairs = pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
        if self.tried:
            pairs = pairs.join(reduce(DataFrame.union, self.tried), ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        self.tried.append(pairs)
        a = self.texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
        b = self.texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
        self._connect(pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb").mapInArrow(_confirm, "a long, b long"))

    def confirm_groups(self, cells: DataFrame) -> None:
        """Confirm all likely pairs across components within cells; a group met in several cells only once."""
        wanted = self.texts.join(cells.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
        samples = self.stored(wanted.select("doc_id", "text").mapInArrow(_sampled, SAMPLED_SQL)).join(self.reps.select("id", "alone").distinct(), "id")
        groups = self.scanned(cells, _groups, GROUPS_SQL, samples).distinct()
        if self.done:
            groups = groups.join(reduce(DataFrame.union, self.done), "sig", "left_anti")
        pair = self.tried and reduce(DataFrame.union, self.tried).selectExpr("a AS low", "b AS high", "2L AS size")
        if pair:
            groups = groups.join(pair, ["low", "high", "size"], "left_anti")
        groups = self.stored(groups.select("sig", "id"))
        self.done.append(cut_lineage(groups.select("sig").distinct()))
        texts = groups.join(self.texts.withColumnRenamed("doc_id", "id"), "id").select("sig", "id", "text")
        self._connect(texts.repartition("sig").sortWithinPartitions("sig").mapInArrow(_exact, "a long, b long"))

    def _connect(self, links: DataFrame) -> None:
        found = self.stored(links)
        if found.isEmpty():
            return
        # what was connected before is a star already, so only stars and new links are contracted
        before = found if self.components is None else found.union(self.components.select("id", "component"))
        self.components = connected(before)

    def families(self, wide: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(cell, id) of families of large nodes (node, id) that are compared block by block; the rows of all others."""
        least = wide.groupBy("id").agg(F.min("node").alias("b"))
        found = connected(wide.join(least, "id").select(F.col("node").alias("a"), "b").distinct())
        found = found.select(F.col("id").alias("node"), F.col("component").alias("family"))
        rows = wide.join(found, "node", "left").select("node", "id", F.coalesce("family", "node").alias("family"))
        members = rows.groupBy("family", "id").agg(F.count("*").alias("c"))
        sizes = members.groupBy("family").agg(F.sum("c").alias("rows"), F.ceil(F.count("*") / SMALL).alias("blocks"), F.count("*").alias("size"))
        sizes = cut_lineage(sizes.where(F.col("size") * F.col("blocks") <= MEETINGS * F.col("rows")))
        block = F.pmod(F.xxhash64("family", "id"), "blocks")
        # blocks that meet another need no cell of their own
        every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
        other = F.explode(F.filter(every, lambda k: (k != F.col("block")) | (F.col("blocks") == 1)))
        met = members.join(sizes, "family").withColumn("block", block).select("family", "id", "block", other.alias("other"))
        pair = F.xxhash64("family", F.least("block", "other"), F.greatest("block", "other"))
        return met.select((F.shiftleft(pair, 1) + 1).alias("cell"), "id"), rows.join(sizes, "family", "left_anti").select("node", "id")

    def branched(self, large: DataFrame) -> DataFrame:
        """(node, id) below large nodes, branched until they are not large or took ``STEPS`` tokens.

        Documents that are alone in a node leave at every token, so what has nothing but the first token in common makes few rows.
        """
        tokens, ended = self.reps.select("id", "tokens"), []
        for _ in range(STEPS):
            made = self.stored(large.join(tokens, "id").select("node", "id", "tokens").mapInArrow(_next, "node long, id long"))
            counted = made.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
            kept = self.stored(made.join(counted, "node"))
            ended.append(kept.where(F.col("n") <= SMALL).select("node", "id"))
            large = kept.where(F.col("n") > SMALL).select("node", "id")
            if large.isEmpty():
                break
        return reduce(DataFrame.union, [*ended, large])

    def run(self) -> None:
        rep_tokens = self.reps.select("id", "tokens")
        level = self.stored(rep_tokens.mapInArrow(_roots, "node long, id long"))
        while True:
            counted = level.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
            nodes = self.stored(level.join(counted, "node"))
            large = self.stored(nodes.where(F.col("n") > SMALL))
            self.drop_steps(1)  # the level
            slices = F.ceil(F.col("n") / SMALL)
            own = F.pmod(F.xxhash64("node", "id"), slices)
            # the last bit of a cell tells a slice of a large node from a whole small one
            slice_of = lambda number: F.shiftleft(F.xxhash64("node", number), 1) + 1
            cell = F.when(F.col("n") <= SMALL, F.shiftleft("node", 1)).otherwise(slice_of(own)).alias("cell")
            best = self.scanned(self.labelled(nodes.select(cell, "id")), _best, BEST_SQL)
            self.drop_steps(1)  # the nodes
            if self.texts is None:
                wanted = best.select(F.col("a").alias("doc_id")).union(best.select("b")).union(large.select("id")).distinct()
                ids = self.classes.select(F.col("id").alias("doc_id"))
                self.texts = cut_lineage(self.docs.join(wanted.join(ids, "doc_id", "left_semi"), "doc_id", "left_semi"))
            self.confirm_best(best)
            some = best.where("cell % 2 = 0")
            rows = self.stored(self.labelled(some.select("cell", F.col("a").alias("id")).union(some.select("cell", "b")).distinct()))
            open_cells = rows.groupBy("cell").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low <> _high").select("cell")
            cells = rows.join(open_cells, "cell").select("cell", "id", "component")
            # a large node: its most common component, and the rows outside of it
            rows = self.stored(self.labelled(large))
            per = rows.groupBy("node", "component").agg(F.count("*").alias("c"))
            heads = per.groupBy("node").agg(F.max_by("component", F.struct("c", "component")).alias("head"), (F.sum("c") - F.max("c")).alias("apart"))
            heads = self.stored(heads.where("apart > 0"))
            few = rows.join(heads.where(F.col("apart") <= SMALL), "node")
            # the few rows apart meet every slice of the node, which adds at most as many rows as the node has
            everywhere = F.sequence(F.lit(0).cast("long"), slices - 1)
            number = F.explode(F.when(F.col("component") == F.col("head"), F.array(own)).otherwise(everywhere)).alias("number")
            met = few.select("node", "id", "component", number).select(slice_of(F.col("number")).alias("cell"), "id", "component")
            many = heads.where(F.col("apart") > SMALL).select("node")
            blocks, wide = self.families(self.stored(rows.join(many, "node").select("node", "id")))
            wide = self.stored(wide)
            cells = self.stored(cells.select("cell", "id").union(met.select("cell", "id")).union(blocks))
            # most of what is apart here is a piece of one component, which one more round of best pairs joins
            self.confirm_best(self.scanned(self.labelled(cells), _best, BEST_SQL))
            self.confirm_groups(self.labelled(cells))
            if wide.isEmpty():
                break
            level = self.stored(self.branched(wide))
            self.drop_steps(-1)  # all but the next level
        self.drop_steps()


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    join = _Join(docs)
    join.run()
    reached = join.labelled(join.classes).select("k1", "k2", "component")
    rows = join.prepared.join(reached, ["k1", "k2"], "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    none = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long"), "text").mapInArrow(_prepare, PREPARED_SQL)
    rows = rows.unionByName(none.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id; all columns as they were.

    Of different texts under one id the first by hash goes by the id. Every other is a document of its own, which
    stays unless its component holds another that is before it: those that go by their ids come first. So a text
    only goes if a near copy of it stays. Rows equal in id and text stay or go together, rows without id stay.
    """
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    several = docs.groupBy("doc_id").agg(F.min(digest).alias("_first"), F.max(digest).alias("_last")).where("_first <> _last")
    own = F.shiftrightunsigned(F.xxhash64("doc_id", digest), 2) + F.lit(1 << 62)  # above all real ids
    row = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    marked = row.join(several.select(F.col("doc_id").alias("_id"), "_first"), F.col("doc_id") == F.col("_id"), "left")
    marked = marked.withColumn("_node", F.when(digest != F.col("_first"), own).otherwise(F.col("doc_id")))
    gone = components(marked.select(F.col("_node").alias("doc_id"), "text")).where("NOT kept").select(F.col("doc_id").alias("_node"))
    return marked.join(gone.distinct(), "_node", "left_anti").select("_row.*")
