"""Whitening, periodic runs and lattice scores against brute force, with nulls, ties, repeats and odd columns."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from kohortflow.llm import lattice, near_dups, runs, whitening
from kohortflow.llm.queries import vocabulary_path

# ------------------------------------------------------------------ runs


def slow_lyndon(w):
    def lyndon(v):
        return all(v < v[k:] for k in range(1, len(v)))

    return [max(m for m in range(1, len(w) - i + 1) if lyndon(w[i : i + m])) for i in range(len(w))]


def slow_runs(w, least=6, periods=4):
    found = []
    n = len(w)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(least, periods * p):
                s = w[i : i + length]
                if not any(s[q:] == s[:-q] for q in range(1, p)):
                    found.append((i, length, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_lyndon_array(letters):
    rng = random.Random(letters)
    for n in [1, 2, 3, 7, 20, 30]:
        for _ in range(15):
            w = [rng.randrange(letters) for _ in range(n)]
            assert runs.lyndon_array(np.array(w)).tolist() == slow_lyndon(w)


def test_runs_of_sequences():
    rng = random.Random(1)
    for k in range(300):
        w = []
        while len(w) < 60:
            unit = [rng.randrange(3) for _ in range(rng.randint(1, 6))]
            w += unit * rng.choice([1, 1, 4, 5]) + unit[: rng.randrange(len(unit))]
        names = np.array(w)
        assert runs.find_runs(names) == slow_runs(w), (k, w)
        assert runs.find_runs(names, 2, 2) == slow_runs(w, 2, 2)


def expected_runs(doc_id, text):
    words = (text or "").replace("\v", " ").replace("\f", " ").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = slow_runs(words)
    dropped = {k for s, length, p in found for k in range(s + p, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    first = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def key(row):
    return tuple((v is not None, v) for v in row)


def test_runs_of_documents(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["a", "b", "cé", "d"]) for _ in range(rng.choice([0, 1, 6, 40, 150])))) for i in range(80)]
    rows += [(None, "x " * 30), (None, "x " * 30), (3, "x y " * 9 + "\n\tz"), (3, None), (900, ""), (901, " \n "), (902, "na\x00b c " * 12), (903, "one two three " * 3000)]
    df = spark.createDataFrame([(i, t, 7, "clash") for i, t in rows], "doc_id long, text string, n_runs long, runs string").repartition(3)
    got = sorted((tuple(r) for r in runs.digests(runs.periodic_runs(df, plant=True)).collect()), key=key)
    want = sorted((expected_runs(i, t) for i, t in rows if i != 903), key=key)
    assert [r for r in got if r[0] != 903] == want
    long = next(r for r in got if r[0] == 903)
    assert zlib.crc32(b"903") % 10 and long[1:6] == (1, 0, 9000, 3, 3000000)
    assert runs.digests(runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


# ------------------------------------------------------------------ lattice


def paths(text, pieces):
    """All segmentations of a text with their log probability."""
    if not text:
        yield 0.0, ()
        return
    for end in range(1, len(text) + 1):
        if text[:end] in pieces:
            for value, rest in paths(text[end:], pieces):
                yield pieces[text[:end]] + value, (text[:end], *rest)
    if text[0] not in pieces:
        spelled = tuple(f"<0x{b:02X}>" for b in text[0].encode())
        for value, rest in paths(text[1:], pieces):
            yield sum(pieces[b] for b in spelled) + value, (*spelled, *rest)


@pytest.fixture(scope="module")
def toy():
    rng = random.Random(2)
    pieces = {"".join(p): rng.random() for k in (1, 2, 3) for p in itertools.product("ab▁", repeat=k) if rng.random() < 0.6 or k == 1}
    pieces |= {f"<0x{b:02X}>": 0.01 for b in range(256)}
    total = sum(pieces.values())
    return {p: math.log(v / total) for p, v in pieces.items()}


def test_forward_sums_all_segmentations(toy):
    for word in ["", "a", "ab", "abba", "éab", "aaaaaaa", "b🙂a"]:
        whole = math.log(sum(math.exp(v) for v, _ in paths("▁" + word, toy)))
        assert lattice.forward(lattice.arcs(word, toy, 3))[-1] == pytest.approx(whole, abs=1e-10)


def test_expected_counts(toy):
    for word in ["a", "abba", "éab"]:
        every = list(paths("▁" + word, toy))
        whole = sum(math.exp(v) for v, _ in every)
        want = Counter()
        for v, spelled in every:
            for p in spelled:
                want[p] += 3 * math.exp(v) / whole
        got = {}
        lattice.expected(word, 3.0, toy, 3, got)
        assert got == pytest.approx(dict(want), abs=1e-10)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_scores_of_documents(spark, monkeypatch):
    monkeypatch.setattr(lattice, "RARE", 20)  # both joins are used
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["The", "word", "Élan", "é", "of", "rare%d" % rng.randrange(99)]) for _ in range(rng.choice([0, 3, 50])))) for i in range(60)]
    rows += [(None, "the x"), (None, "the x"), (2, None), (2, "other text"), (77, "q" * 5000), (78, "q" * 5000 + " the"), (79, " \n\t")]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, c long, word string").repartition(3)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = [(i, [w.decode() for w in lower(t).encode().split()] + [""]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if not held[i] for w in ws)
    total = sum(counts.values())
    got = sorted((tuple(r) for r in lattice.scores(df, vocabulary_path(), 1).collect()), key=key)
    table = spark.createDataFrame(list(counts.items()), "word string, c long")
    pieces, end = lattice.fitted(table, lattice.vocabulary(vocabulary_path()), 1)
    longest = max(map(len, pieces))
    assert math.fsum(math.exp(v) for v in pieces.values()) + math.exp(end) == pytest.approx(1)
    want = []
    for i, ws in tokens:
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws)
        score = sum((lattice.forward(lattice.arcs(w, pieces, longest))[-1] if w else end) / math.log(10) for w in ws)
        want.append((i, held[i], len(ws), sum(counts[w] > 0 for w in ws), total, base, score))
    want.sort(key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [v for r in got for v in r[5:]] == pytest.approx([v for r in want for v in r[5:]], rel=1e-9)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lattice.scores(empty, vocabulary_path()).count() == 0


def test_plain_and_log_lattices_agree():
    lattices = lattice.Lattices(lattice.vocabulary(vocabulary_path()))
    pieces, longest = lattices.pieces, lattices.longest
    for word in ["the", "x", "Élan", "\u4e2d\U0001f600", "internationalisation", "\U0001f600" * 40, "q" * 190, "q" * 201, "ab" * 2500]:
        assert lattices.log_probability(word) == pytest.approx(lattice.forward(lattice.arcs(word, pieces, longest))[-1], rel=1e-12)
        got, want = {}, {}
        lattices.count(word, 3.0, got)
        lattice.expected(word, 3.0, pieces, longest, want)
        assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p], rel=1e-9, abs=1e-12) for p in want)


def test_only_ascii_capitals_are_lowered(spark):
    words = ["The", "ÉLAN", "İX", "ΑΣ", "a\x00B", "", "ABC9z"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", lattice.lowered(F.col("w")).alias("low"))
    assert [r.low for r in df.collect()] == [lower(w) for w in words]


def test_words_are_counted_and_added_up_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(lattice, "HELD", 3)
    monkeypatch.setattr(lattice, "TOGETHER", 20)
    texts = [b"A b\x0bc\xc2\xa0d a", b"", b"x" * 50, "\u00c9 B".encode(), b" a\ta ", b"rare"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array([True, False] * 3)], names=["text", "used"])
    c, m = Counter(), Counter()
    for part in lattice._counted(iter([batch, batch])):
        for row in part.to_pylist():
            c[row["word"]] += row["c"]
            m[row["word"]] += row["m"]
    want = [(t.lower().split() + [b""], u) for t, u in zip(texts, [True, False] * 3)] * 2
    assert m == Counter(w for ws, _ in want for w in ws) and c == Counter(w for ws, u in want if u for w in ws)
    ids = pa.array(range(6), pa.int64())
    rows = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts, pa.binary())], names=["doc_id", "digest", "text"])
    parts = list(lattice._bounded(iter([rows, rows.slice(0, 0)])))
    assert pa.Table.from_batches(parts) == pa.Table.from_batches([rows]) and len(parts) > 1
    frequent = pa.table({"word": ["a", "", "b"], "known": [1, 1, 0], "base": [0.5, 2.0, 0.25], "model": [1.0, 3.0, 7.0]})
    scored = lattice.Scored(frequent)
    got = [tuple(r.values())[2:] for p in parts for r in scored.sums(p).to_pylist()]
    assert got == [(5, 3, 3.25, 12.0), (1, 1, 2.0, 3.0), (2, 1, 2.0, 3.0), (3, 1, 2.25, 10.0), (3, 3, 3.0, 5.0), (2, 1, 2.0, 3.0)]
    assert [(r["doc_id"], r["word"]) for p in parts for r in scored.others(p).to_pylist()] == [(0, b"c\xc2\xa0d"), (2, b"x" * 50), (3, "\u00c9".encode()), (5, b"rare")]


def test_frequent_words_make_no_rows(spark, monkeypatch):
    """Only the words that are not frequent are rows of a join; the text is not taken apart in a row for each token."""
    docs = spark.createDataFrame([(i, "the " * 50) for i in range(5)], "doc_id long, text string")
    plan = lattice.scores(docs, vocabulary_path(), 1)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "MapInArrow" in plan


def test_rounds_raise_the_held_out_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    score = [lattice.scores(docs, vocabulary_path(), k).where("held_out").selectExpr("sum(score)").first()[0] for k in (0, 2)]
    assert score[1] > score[0]


# ------------------------------------------------------------------ whitening


def test_rank_one_updates():
    rng = np.random.default_rng(3)
    for dim in (1, 2, 5, 20):
        values, basis, full = np.zeros(dim), np.eye(dim), np.zeros((dim, dim))
        for k in range(80):
            v = rng.integers(-3, 4, dim).astype(float) if k % 2 else rng.normal(size=dim) * 10.0 ** rng.integers(-4, 4)
            rho = float(rng.random() + 0.1)
            values, basis = whitening.updated(values, basis, rho, v)
            full += rho * np.outer(v, v)
            scale = np.abs(full).max() + 1e-300
            assert np.abs(basis.T @ basis - np.eye(dim)).max() < 1e-11
            assert np.abs(basis * values @ basis.T - full).max() < 1e-11 * scale
            assert (np.diff(values) >= 0).all()


def test_spectra_merge():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 6)) @ rng.normal(size=(6, 6)) + 50
    parts = []
    for piece in (x[:1], x[1:40], x[40:]):
        own = whitening.Spectrum(6)
        for v in piece:
            own.add(v)
        parts.append(own)
    whole = whitening.Spectrum(6)
    for own in parts:
        whole.merge(own.n, own.mean, own.values, own.basis.T)
    assert whole.n == 90 and np.allclose(whole.mean, x.mean(0))
    assert np.allclose(whole.basis * whole.values @ whole.basis.T, (x - x.mean(0)).T @ (x - x.mean(0)))


def test_whitening(spark):
    rng = np.random.default_rng(5)
    data = (rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20))).astype(np.float32)
    data[:, 3] = data[:, 2]  # a component without variance
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19), (905, [1.0])]
    df = spark.createDataFrame([(i, v, 5, "p") for i, v in rows], "vec_id long, embedding array<float>, n int, part string").repartition(5)
    out = whitening.whitened(df).toPandas()
    used = [(i, v) for i, v in rows if v and len(v) == 20 and all(c is not None and math.isfinite(c) for c in v)]
    ints = [tuple(math.floor(64 * c) + 1000000 for c in v) for _, v in used]
    fit = np.array(sorted(set(ints)))
    n, s = len(fit), fit.sum(0)
    cov = np.cov((fit - s / n).T, bias=True)
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    assert len(out) == len(used) * 16 and set(out["n"]) == {n}
    assert out["identity_error"].nunique() == 1 and out["identity_error"][0] < 1e-9
    for k, part in out.groupby("component"):
        assert np.allclose(part["explained"], e[k - 1] / e.sum(), rtol=1e-9)
        y = (np.array(ints) - s / n) @ q[:, k - 1] / np.sqrt(e[k - 1])
        have = sorted(part["whitened"])
        assert np.allclose(have, sorted(y), atol=1e-7) or np.allclose(have, sorted(-y), atol=1e-7)
    want = sorted(sum((n * a - int(b)) ** 2 for a, b in zip(v, s, strict=True)) for v in ints)
    assert sorted(out[out.component == 1]["deviation"]) == want
    kind = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], kind)).count() == 2


# ------------------------------------------------------------------ near duplicates under repeated ids


def test_no_text_is_lost_under_a_repeated_id(spark):
    rng = random.Random(8)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    rows = [(5, a, "x"), (5, b, "y"), (3, a, "z"), (7, c, "p"), (7, b + " end", "q"), (None, a, "n"), (8, None, "e"), (8, "", "f"), (9, c, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _first string")
    kept = near_dups.deduplicated(df)
    assert kept.columns == ["doc_id", "text", "_first"]
    got = [tuple(r) for r in kept.collect()]
    assert sum(r[1] == a and r[0] is not None for r in got) == 1 and (3, a, "z") in got  # the smallest id of the copies
    assert sum(r[1] in (b, b + " end") for r in got) == 1 and sum(r[1] == c for r in got) == 1
    assert {r[2] for r in got} >= {"n", "e", "f"} and len(got) == 6
