"""Hierarchical multi-length packing.

Documents become token ids and an end id. Full windows of the longest tier are cut off a long document; what is
left is routed to the shortest tier (512, 1,024, 2,048 or 4,096 tokens) it fits. The tiers are packed from the
longest down: a window takes the largest document of its tier, then the largest shorter ones that fit its gap, and
if none fits a piece cut off the shortest. So every window is exactly full; the last one of a group is split into
powers of two, which need no padding either. Sequences are dealt to step groups of about equal tokens.

One group is some million tokens out of one input partition, so packing needs no shuffle, holds one group in
memory, and a lost task makes the same group again. Sequence ids hold the partition and a counter.

Defined results: a null or empty text is the end id alone. Ids may be null or repeated; each row is a document of
its own. Other columns are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.taskcontext import TaskContext

from kohortflow.llm.common import small_batches

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
GROUP_TOKENS = 1 << 21  # tokens packed together
STEP_TOKENS = 1 << 16  # tokens of one step group
KNOWN_WORDS = 600_000  # words whose ids a task keeps
#: ASCII punctuation between a letter and white space: always a piece of its own to the tokenizer's splitting.
LETTERS = re.compile("[a-zß-öø-ÿ]+")
CLOSING = re.compile(rb"(?<=[a-z])([!-/:-@\[-`{-~]+)(?=[\x20\x09-\x0D]|$)")

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class Ids:
    """Token ids as little-endian 32-bit words.

    The tokenizer lower-cases, and its splitting never joins characters across ASCII white space, nor a letter and
    the punctuation that closes its word. So the ids of a text are those of its lower-case words in turn, and a
    frequent word is encoded once. Only a text that may hold a special token's string is split at white space alone.
    A word of lower-case Latin letters is one piece to the splitting and goes to the merges directly.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {ord(c): shown.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}
        self.merges = self.tokenizer.model.tokenize
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        return text.split() if b"<|" in text else CLOSING.sub(rb" \1", text.lower()).split()

    def learn(self, new: set[bytes]) -> None:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        other = []
        for word in new:
            text = word.decode()
            if LETTERS.fullmatch(text):
                merged = self.merges(text if text.isascii() else text.translate(self.letters))
                self.known[word] = array("I", [t.id for t in merged]).tobytes()
            else:
                other.append(word)
        for word, e in zip(other, self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False), strict=True):
            self.known[word] = array("I", e.ids).tobytes()

    def of(self, texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            words = self.words((text or "").encode())
            if new := set(words).difference(self.known):
                self.learn(new | set(words) if len(self.known) > KNOWN_WORDS else new)
            yield b"".join(map(self.known.__getitem__, words)) + END_ID.to_bytes(4, "little")


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences of one group: (tier, [(document, start, length), ...]), all exactly full."""
    longest, out, rest = tiers[-1], [], []
    for doc, n in enumerate(lengths):
        full = n // longest
        out += [(longest, [(doc, i * longest, longest)]) for i in range(full)]
        if n > full * longest:
            rest.append((n - full * longest, doc, full * longest))
    rest.sort()  # (length, document, start)
    for tier, below in zip(reversed(tiers), [*reversed(tiers[:-1]), 0], strict=True):
        while rest and rest[-1][0] > below:
            gap, pieces = tier, []
            while gap and rest:
                at = bisect_left(rest, (gap + 1,)) - 1
                if at >= 0:
                    n, doc, start = rest.pop(at)
                    pieces.append((doc, start, n))
                    gap -= n
                else:  # nothing is as short as the gap: cut the shortest
                    n, doc, start = rest.pop(0)
                    pieces.append((doc, start, gap))
                    insort(rest, (n - gap, doc, start + gap))
                    gap = 0
            if gap:
                out += _halved(pieces, tier - gap)
            else:
                out.append((tier, pieces))
    return out


def _halved(pieces: list[tuple[int, int, int]], total: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The last, not full window as sequences whose lengths are powers of two."""
    out, pieces = [], list(reversed(pieces))
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        gap, taken = size, []
        while gap:
            doc, start, n = pieces.pop()
            taken.append((doc, start, min(n, gap)))
            if n > gap:
                pieces.append((doc, start + gap, n - gap))
            gap -= min(n, gap)
        out.append((size, taken))
    return out


def step_groups(sizes: list[int], tokens: int = STEP_TOKENS) -> list[int]:
    """Step group of each sequence: the longest first, always to the group with the fewest tokens."""
    loads = [(0, g) for g in range(max(1, round(sum(sizes) / tokens)))]
    groups = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, g = heapq.heappop(loads)
        groups[i] = g
        heapq.heappush(loads, (load + sizes[i], g))
    return groups


def packed(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pieces of all documents: which ids of which document lie where in which sequence.

    ``tokenizer`` is the path of a tokenizer file that every executor has.
    """
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, schema = Ids(tokenizer), pa.schema([(n, pa.int32() if n == "tier" else pa.int64()) for n in (c.split()[0] for c in SCHEMA.split(", "))])
        sequence = step = TaskContext.get().partitionId() << 36
        held: list[tuple[int | None, bytes]] = []

        def flush() -> pa.RecordBatch:
            nonlocal sequence, step
            made = pack([len(b) // 4 for _, b in held], tiers)
            groups = step_groups([sum(n for _, _, n in p) for _, p in made])
            columns: list[list] = [[] for _ in schema]
            for (tier, pieces), group in zip(made, groups, strict=True):
                offset = 0
                for doc, start, n in pieces:
                    doc_id, b = held[doc]
                    row = (doc_id, start, n, zlib.crc32(b[4 * start : 4 * (start + n)]), len(b) // 4, sequence, offset, tier, step + group)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += n
                sequence += 1
            step += max(groups, default=0) + 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        tokens = 0
        for batch in batches:
            for doc_id, b in zip(batch.column(0).to_pylist(), ids.of(batch.column(1).to_pylist()), strict=True):
                held.append((doc_id, b))
                tokens += len(b) // 4
                if tokens >= group_tokens:
                    yield flush()
                    tokens = 0
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(rows, SCHEMA)
