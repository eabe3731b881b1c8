"""Log probability of documents under a subword lattice.

The pieces of an existing vocabulary (a SentencePiece file) spell every word in many ways. A unigram model gives each
piece a probability, a segmentation the product over its pieces, and a word the sum over all segmentations, by a forward
recursion in log space. Pieces never cross a space, so a document's probability is the product over its words and one
end. Characters outside the vocabulary are spelled in bytes, which are pieces as well, so every text has a probability.

The vocabulary's own scores are ranks, which Zipf's law turns into the first probabilities. Rounds of expected piece
counts over the training words (forward and backward over each word's lattice) make them log probabilities of the corpus.

The words are counted once over the whole corpus, with sums in the map tasks, and a lattice is evaluated once per
distinct word. Scores go back to documents by a join on the word. Words of more than one in ``RARE`` of all tokens are at most ``RARE`` words, so
they are a broadcast of bounded size, which each task adds up for whole documents, and a hot word never is one task; all others
meet in a shuffle, where no word can have more than that share. Nothing but these words, the piece counts (bounded by the
vocabulary) and three numbers reaches the driver.

Defined results: a null text is empty, its score that of the end alone. Rows equal in id and text get one row
each. A null id has the remainder 0 and so is in training. Without training tokens all probabilities are those of the smoothing. Other columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kohortflow.llm.common import small_batches
from kohortflow.llm.near_dups import LOWER as LOWERED
from kohortflow.session import cut_lineage

END = ""  # no word is empty
RARE = 300_000  # a word with a larger share than one in this is broadcast
SHORT = 64  # bytes of a word that may be broadcast; so RARE words stay below some 50 MB, and a few MB in natural text
ROUNDS = 2  # of expected counts
SMOOTHING = 0.01  # added to every piece's expected count
SPACE_MARK = "▁"
TINY = -math.inf
LEAST = 1e-200  # of a word in plain probabilities: what a double loses below 1e-308 is nothing beside it
LONG = 200  # characters, beyond which a word is not tried
HELD = 1 << 18  # distinct words that a task counts before it passes them on
TOGETHER = 1 << 20  # bytes of texts whose words are in memory at once, or one text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(path: str) -> dict[str, float]:
    """Pieces of a SentencePiece file with the natural log of their first probability, by Zipf's law on their rank.

    Pieces with A-Z cannot occur in lower-cased words and get none; control pieces neither. Bytes get the last rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or (not model.is_byte(i) and any(c in UPPER for c in piece)):
            continue
        rank = model.get_piece_size() if model.is_byte(i) else min(-model.get_score(i), model.get_piece_size())
        pieces[piece] = 1.0 / (1.0 + rank)
    total = math.log(sum(pieces.values()))
    return {p: math.log(v) - total for p, v in pieces.items()}


def _log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    top = max(values)
    return top + math.log(sum([math.exp(v - top) for v in values]))


def beginnings(pieces: dict[str, float]) -> set[str]:
    """Every prefix of every piece: a stretch that is none needs no longer ones tried."""
    return {p[:k] for p in pieces for k in range(1, len(p) + 1)}


def arcs(word: str, pieces: dict[str, float], longest: int, starts: set[str] | None = None) -> list[list[tuple[int, float, tuple[str, ...]]]]:
    """Per end place the arcs (start, log probability, pieces) of a word's lattice; the word begins with the mark.

    A character that is no piece has one arc of its bytes, so every place is reached. ``starts`` holds the pieces' ``beginnings``.
    """
    text = SPACE_MARK + word
    n = len(text)
    out: list[list[tuple[int, float, tuple[str, ...]]]] = [[] for _ in range(n + 1)]
    for start in range(n):
        letter = text[start]
        if letter not in pieces:
            spelled = tuple(f"<0x{b:02X}>" for b in letter.encode("utf-8", "surrogatepass"))
            out[start + 1].append((start, sum([pieces[b] for b in spelled]), spelled))
        for end in range(start + 1, min(n, start + longest) + 1):
            piece = text[start:end]
            value = pieces.get(piece)
            if value is not None:
                out[end].append((start, value, (piece,)))
            elif starts is not None and piece not in starts:
                break
    return out


def forward(lattice: list[list[tuple[int, float, tuple[str, ...]]]]) -> list[float]:
    """Log sum of all paths from the start to each place."""
    reached = [0.0]
    for into in lattice[1:]:
        reached.append(_log_sum([reached[start] + value for start, value, _ in into]))
    return reached


def expected(word: str, weight: float, pieces: dict[str, float], longest: int, counts: dict[str, float], starts: set[str] | None = None) -> None:
    """Add ``weight`` times the expected number of each piece in the word's segmentations to ``counts``."""
    lattice = arcs(word, pieces, longest, starts)
    ahead = forward(lattice)
    whole = ahead[-1]
    back = [TINY] * len(lattice)
    back[-1] = 0.0
    for end in range(len(lattice) - 1, 0, -1):
        after = back[end]
        if after == TINY:
            continue
        for start, value, spelled in lattice[end]:
            through = value + after
            share = math.exp(ahead[start] + through - whole) * weight
            for piece in spelled:
                counts[piece] = counts.get(piece, 0.0) + share
            a, b = back[start], through
            back[start] = b if a == TINY else (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))


def swept(word: str, probabilities: dict[str, float], starts: set[str]) -> tuple[list[float], list[tuple[int, int, float, tuple[str, ...]]]]:
    """Sums of all paths to each place, and the arcs by start, in plain probabilities, which takes no logarithm an arc."""
    text = SPACE_MARK + word
    n = len(text)
    ahead = [1.0] + [0.0] * n
    found = []
    for start in range(n):
        reached = ahead[start]
        letter = text[start]
        if letter not in probabilities:
            spelled = tuple([f"<0x{b:02X}>" for b in letter.encode("utf-8", "surrogatepass")])
            value = math.prod([probabilities[b] for b in spelled])
            ahead[start + 1] += reached * value
            found.append((start, start + 1, value, spelled))
        for end in range(start + 1, n + 1):
            piece = text[start:end]
            value = probabilities.get(piece)
            if value is not None:
                ahead[end] += reached * value
                found.append((start, end, value, (piece,)))
            elif piece not in starts:
                break
    return ahead, found


class Lattices:
    """Word probabilities and expected counts; words too improbable for plain numbers are taken in log space."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces, self.starts, self.longest = pieces, beginnings(pieces), max(map(len, pieces))
        self.probabilities = {p: math.exp(v) for p, v in pieces.items()}

    def log_probability(self, word: str) -> float:
        if len(word) <= LONG:
            whole = swept(word, self.probabilities, self.starts)[0][-1]
            if whole > LEAST:
                return math.log(whole)
        return forward(arcs(word, self.pieces, self.longest, self.starts))[-1]

    def count(self, word: str, weight: float, counts: dict[str, float]) -> None:
        """As :func:`expected`."""
        ahead, found = swept(word, self.probabilities, self.starts) if len(word) <= LONG else ([0.0], [])
        if ahead[-1] <= LEAST:
            expected(word, weight, self.pieces, self.longest, counts, self.starts)
            return
        back = [0.0] * len(ahead)
        back[-1] = weight / ahead[-1]
        for start, end, value, spelled in reversed(found):
            through = value * back[end]
            back[start] += through
            for piece in spelled:
                counts[piece] = counts.get(piece, 0.0) + ahead[start] * through


def lowered(word: Column) -> Column:
    """A-Z in lower case. ``lower`` does the same for a word of ASCII only, at a fraction of the time."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def held_out(doc_id: Column) -> Column:
    """Every seventh document by the digest of its id is not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def words(text: bytes) -> list[bytes]:
    """The lower-cased tokens of a text in UTF-8; ``split`` parts bytes at the six characters that no word has."""
    found = text.translate(LOWERED).split()
    found.append(END.encode())
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (word, c, m) of the texts (text, used), some hundred thousand words together."""
    used, other = Counter(), Counter()

    def rows() -> pa.RecordBatch:
        every = list(used | other)
        c = [used[w] for w in every]
        m = [n + other[w] for n, w in zip(c, every, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(every, pa.binary()), pa.array(c, pa.int64()), pa.array(m, pa.int64())], names=["word", "c", "m"])

    for batch in batches:
        for text, learned in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            (used if learned else other).update(words(text))
            if len(used) + len(other) > HELD:
                yield rows()
                used.clear()
                other.clear()
    yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, m): every token of the corpus with its count in the training documents and in all."""
    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), (~held_out(F.col("doc_id"))).alias("used"))
    parts = texts.mapInArrow(_counted, "word binary, c long, m long").select(F.col("word").cast("string").alias("word"), "c", "m")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("m").alias("m"))


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, digest, text), so many at a time as have ``TOGETHER`` bytes."""
    for batch in batches:
        sizes = np.fromiter(map(len, batch.column(2).to_pylist()), np.int64, batch.num_rows)
        ends = np.flatnonzero(np.diff(np.cumsum(sizes) // TOGETHER)) + 1
        for first, last in zip([0, *ends], [*ends, batch.num_rows], strict=True):
            if first < last:
                yield batch.slice(first, last - first)


class Scored:
    """Documents (doc_id, digest, text) against the frequent words, which are a table (word, known, base, model)."""

    def __init__(self, frequent: pa.Table) -> None:
        self.place = dict(zip(frequent.column("word").cast(pa.binary()).to_pylist(), range(frequent.num_rows), strict=True))
        # the last row is that of any other word
        self.values = [np.append(frequent.column(c).to_numpy(), 0) for c in ("known", "base", "model")]

    def located(self, batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The tokens of all rows, the place of each among the frequent words, and how many a row has."""
        found = [words(t) for t in batch.column(2).to_pylist()]
        every = [w for row in found for w in row]
        place = np.fromiter(map(self.place.get, every, repeat(len(self.place))), np.int64, len(every))
        return every, place, np.fromiter(map(len, found), np.int64, len(found))

    def sums(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """One row for each: how many tokens it has, and the sums over those that are frequent."""
        _, place, n = self.located(batch)
        starts = np.cumsum(n) - n
        summed = [np.add.reduceat(v[place], starts) for v in self.values]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), *map(pa.array, summed)], names=["doc_id", "digest", "n", "known", "base", "model"])

    def others(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """One row for each token that is not frequent."""
        every, place, n = self.located(batch)
        at = np.flatnonzero(place == len(self.place))
        row = pa.array(np.repeat(np.arange(len(n)), n)[at])
        return pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array([every[i] for i in at], pa.binary())], names=["doc_id", "digest", "word"])


def piece_counts(counts: DataFrame, pieces: dict[str, float]) -> dict[str, float]:
    """Expected number of each piece in the training tokens; one row per piece reaches the driver."""
    shared = counts.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, float] = {}
        lattices = Lattices(shared.value)
        for batch in batches:
            for word, c in zip(batch["word"], batch["c"], strict=True):
                lattices.count(word, float(c), found)
        yield pd.DataFrame({"piece": pd.Series(list(found), dtype=object), "n": pd.Series(list(found.values()), dtype="float64")})

    rows = counts.where((F.col("c") > 0) & (F.col("word") != END)).select("word", "c").mapInPandas(count, "piece string, n double")
    return {r.piece: r.n for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def fitted(counts: DataFrame, pieces: dict[str, float], rounds: int = ROUNDS) -> tuple[dict[str, float], float]:
    """Natural log probabilities of the pieces and of a document's end after some rounds of expected counts."""
    ends = counts.where(F.col("word") == END).agg(F.sum("c")).first()[0] or 0
    end = math.log(0.5)
    for _ in range(rounds):
        found = piece_counts(counts, pieces)
        total = sum(found.values()) + ends + SMOOTHING * (len(pieces) + 1)
        pieces = {p: math.log((found.get(p, 0.0) + SMOOTHING) / total) for p in pieces}
        end = math.log((ends + SMOOTHING) / total)
    return pieces, end


def scored_words(counts: DataFrame, pieces: dict[str, float], end: float) -> DataFrame:
    """``counts`` with ``model``: the log10 probability of each token, all segmentations summed."""
    shared = counts.sparkSession.sparkContext.broadcast(pieces)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattices = Lattices(shared.value)
        for batch in batches:
            values = [(end if w == END else lattices.log_probability(w)) / math.log(10) for w in batch["word"]]
            yield batch.assign(model=pd.Series(values, index=batch.index, dtype="float64"))

    return counts.mapInPandas(score, "word string, c long, m long, model double")


def scores(docs: DataFrame, vocabulary_path: str, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    counts = cut_lineage(word_counts(docs))
    row = counts.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v"), F.sum("m").alias("all")).first()
    total, distinct = row.n or 0, row.v or 0
    pieces, end = fitted(counts, vocabulary(vocabulary_path), rounds)
    base = F.log10((F.col("c") + 1.0) / F.lit(float(total + distinct + 1)))
    table = cut_lineage(scored_words(counts, pieces, end).select("word", (F.col("c") > 0).cast("long").alias("known"), base.alias("base"), "model", "m"))
    hot = (F.col("m") * RARE > F.lit(row.all or 0)) & (F.octet_length("word") <= SHORT)
    rare = table.where(~hot).drop("m")
    frequent = spark.sparkContext.broadcast(table.where(hot).drop("m").toArrow())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored = Scored(frequent.value)
        yield from (scored.sums(part) for part in _bounded(batches))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored = Scored(frequent.value)
        yield from (scored.others(part) for part in _bounded(batches))

    key = ["doc_id", "digest"]
    whole = texts.mapInArrow(summed, "doc_id long, digest long, n long, known long, base double, model double")
    whole = whole.select(*key, F.lit(1).cast("long").alias("copies"), "n", "known", "base", "model")
    found = texts.mapInArrow(others, "doc_id long, digest long, word binary").withColumn("word", F.col("word").cast("string"))
    zero = F.lit(0).cast("long")
    parts = whole.union(found.join(rare, "word").select(*key, zero, zero, "known", "base", "model"))
    per_key = parts.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("copies", "n", "known", "base", "model")])
    copies = F.col("copies")
    return per_key.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        (F.col("n") / copies).cast("long").alias("n_tokens"),
        (F.col("known") / copies).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / copies).alias("base_score"),
        (F.col("model") / copies).alias("score"),
        F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("_copy"),
    ).drop("_copy")
