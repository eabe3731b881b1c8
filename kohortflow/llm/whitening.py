"""Whitening of embeddings by incremental eigendecomposition.

Each partition of the distinct vectors keeps the spectrum of its covariance and takes one vector at a time: the mean
moves, and the scatter changes by the centred vector's outer product. The new eigenvalues are the roots of a secular
equation; entries without weight and equal eigenvalues are deflated first, and eigenvectors come from weights recomputed from the
roots, which keeps them orthogonal. Two spectra are combined in the same way, one update per eigenpair and one for the
distance of the means, up a tree of small groups. What moves is one spectrum per partition, its size given by
the dimension alone. The combined basis is then refined by a Rayleigh-Ritz step over all vectors: their covariance within
the basis, summed by partition, is diagonalised, which gives eigenpairs to double precision.

Entries become whole numbers, so means and deviations are exact; every sum of squares is of centred values.

Defined results: null vectors, and those with null or non-finite entries, take no part; neither do empty ones or those
shorter than the longest. Equal vectors count once in the fit, and each row is whitened. Components without variance (below
``FLAT`` of the total) are not returned, so a table of equal vectors, like an empty one, gives an empty result. Entries or deviations
beyond 64 bits raise an error. Ids may be null or repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.llm.common import shuffle_width, small_batches
from kohortflow.session import cut_lineage

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000  # an entry c becomes floor(SCALE * c) + SHIFT
FAN_IN = 16  # spectra combined by one task
FLAT = 1e-12
EPS = float(np.finfo(float).eps)
LIMIT = float(1 << 62)


def _roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum w / (d - x) = 0 for rising distinct ``d`` and positive ``w``, one above each entry.

    Returned as (place of the nearest pole, distance from it), which keeps the differences to all poles accurate. Steps
    replace both sides of the sum by one pole each; a step that leaves its bracket becomes a bisection.
    """
    m = len(d)
    at = np.arange(m)
    upper = np.append(d[1:], d[-1] + w.sum())
    gap = upper - d
    middle = d + gap / 2
    side = 1 + (w / (d[None, :] - middle[:, None])).sum(axis=1)
    near = np.where((side < 0) & (at < m - 1), at + 1, at)  # the root lies right of the middle: measure from the right pole
    delta = d[None, :] - d[near][:, None]
    below = delta[at, at]  # the bracket's poles, as seen from the origin
    above = upper - d[near]
    low, high = np.where(side < 0, below + gap / 2, below), np.where(side < 0, above, below + gap / 2)
    x = (low + high) / 2
    lower_part = at[None, :] <= at[:, None]
    for _ in range(60):
        away = delta - x[:, None]
        term = w / away
        f = 1 + term.sum(axis=1)
        slope = term / away
        psi = np.where(lower_part, slope, 0).sum(axis=1)
        phi = slope.sum(axis=1) - psi
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        error = 8 * EPS * (1 + np.abs(term).sum(axis=1)) + EPS * np.abs(x) * (psi + phi)
        open_ = (np.abs(f) > error) & (high - low > 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if not open_.any():
            break
        left, right = below - x, above - x
        a = (left + right) * f - left * right * (psi + phi)
        b = left * right * f
        c = f - left * psi - right * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        moved = x + step
        good = np.isfinite(moved) & (moved > low) & (moved < high)
        x = np.where(open_, np.where(good, moved, (low + high) / 2), x)
    return near, x


def updated(values: np.ndarray, basis: np.ndarray, rho: float, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of ``basis diag(values) basis' + rho vector vector'``."""
    z = basis.T @ vector
    size = float(z @ z)
    if rho * size == 0:
        return values, basis
    tolerance = 8 * EPS * max(abs(values[-1]), rho * size)
    live = rho * np.abs(z) * np.sqrt(size) > tolerance
    places = np.flatnonzero(live)
    if len(places) > 1 and (np.diff(values[places]) <= tolerance).any():  # equal eigenvalues: turn their weight into one
        basis = basis.copy()
        kept = places[0]
        for k in places[1:].tolist():
            if values[k] - values[kept] <= tolerance:
                r = float(np.hypot(z[kept], z[k]))
                c, s = z[k] / r, z[kept] / r
                basis[:, [kept, k]] = np.stack([c * basis[:, kept] - s * basis[:, k], s * basis[:, kept] + c * basis[:, k]], axis=1)
                z[kept], z[k] = 0.0, r
                live[kept] = False
            kept = k
        places = np.flatnonzero(live)
    if not len(places):
        return values, basis
    d, w = values[places], rho * z[places] ** 2
    near, x = _roots(d, w)
    away = (d[None, :] - d[near][:, None]) - x[:, None]  # pole minus root, row by root
    # weights for which these roots are exact, so that the vectors are orthogonal however near the poles are
    ratio = -away / np.where(np.eye(len(d), dtype=bool), 1.0, d[None, :] - d[:, None])
    ratio[np.arange(len(d)), np.arange(len(d))] = -away.diagonal()
    exact = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=0))), z[places])
    turn = exact[None, :] / away
    turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
    values, basis = values.copy(), basis.copy() if basis.base is None else np.array(basis)
    values[places] = d[near] + x
    basis[:, places] = basis[:, places] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


class Spectrum:
    """Count, mean and eigendecomposition of the scatter of some vectors."""

    def __init__(self, dim: int):
        self.n, self.mean, self.values, self.basis = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def add(self, vector: np.ndarray) -> None:
        away = vector - self.mean
        self.values, self.basis = updated(self.values, self.basis, self.n / (self.n + 1.0), away)
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, n: int, mean: np.ndarray, values: np.ndarray, basis: np.ndarray) -> None:
        """Take in another spectrum, ``basis`` with a vector per row."""
        if not n:
            return
        for value, vector in zip(values, basis, strict=True):
            if value > 0:
                self.values, self.basis = updated(self.values, self.basis, float(value), vector)
        away = mean - self.mean
        self.values, self.basis = updated(self.values, self.basis, self.n * n / (self.n + n), away)
        self.mean = self.mean + away * (n / (self.n + n))
        self.n += n

    def row(self, node: int) -> pd.DataFrame:
        return pd.DataFrame({"node": [node], "n": [self.n], "mean": [self.mean], "vals": [self.values], "basis": [self.basis.T.ravel()]})


SPECTRUM = "node long, n long, mean array<double>, vals array<double>, basis array<double>"


def _vectors(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64)


def spectrum(fit: DataFrame, base: np.ndarray) -> Spectrum:
    """Spectrum of the vectors ``x`` minus ``base``, by partitions and then by a tree of groups of ``FAN_IN``."""
    dim = len(base)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, node = Spectrum(dim), None
        for batch in batches:
            for vector in (_vectors(batch["x"]) - base).astype(float):
                own.add(vector)
            if node is None and len(batch):
                node = int(batch["part"].iloc[0])
        if node is not None:
            yield own.row(node)

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = Spectrum(dim)
        for row in group.sort_values("node").itertuples():
            own.merge(row.n, np.array(row.mean), np.array(row.vals), np.array(row.basis).reshape(dim, dim))
        return own.row(int(key[0]))

    level = cut_lineage(fit.withColumn("part", F.spark_partition_id().cast("long")).mapInPandas(part, SPECTRUM))
    while True:
        nodes = level.agg(F.count("*")).first()[0]
        if nodes <= 1:
            break
        width = level.agg(F.max("node")).first()[0] // FAN_IN + 1
        level = cut_lineage(level.groupBy(F.floor(F.col("node") / FAN_IN).alias("up")).applyInPandas(merge, SPECTRUM))
        if width == 1:
            break
    row = level.first()
    out = Spectrum(dim)
    out.n, out.mean, out.values = row.n, np.array(row.mean), np.array(row.vals)
    out.basis = np.array(row.basis).reshape(dim, dim).T
    return out


def _summed_squares(fit: DataFrame, base: np.ndarray, rest: np.ndarray, basis: np.ndarray, n: int) -> np.ndarray:
    """Covariance of the centred vectors within a basis: one small matrix per partition, added up by Spark."""
    width = basis.shape[1]

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                y = ((_vectors(batch["x"]) - base).astype(float) - rest) @ basis
                total += y.T @ y
        yield pd.DataFrame({"i": np.repeat(np.arange(width), width), "j": np.tile(np.arange(width), width), "v": total.ravel()})

    out = np.zeros((width, width))
    for row in fit.mapInPandas(part, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[row.i, row.j] = row.v / n
    return (out + out.T) / 2


def whole_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows that take part, entries as whole numbers."""
    entries = F.col(vector).cast("array<double>")
    good = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size(entries) > 0)
    x = F.transform(entries, lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long"))
    far = F.exists(entries, lambda c: F.abs(c) * SCALE > LIMIT)
    checked = F.when(far, F.raise_error(F.lit("an entry does not fit 64 bits")).cast("array<bigint>")).otherwise(x)
    return table.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), checked.alias("x"))


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component, components by falling eigenvalue."""
    spark = table.sparkSession
    small_batches(spark)
    rows = whole_vectors(table, vector)
    dim = rows.agg(F.max(F.size("x"))).first()[0]
    nothing = spark.createDataFrame([], RESULT)
    if dim is None:
        return nothing
    rows = rows.where(F.size("x") == dim)
    fit = cut_lineage(rows.select("x").distinct().repartition(shuffle_width(spark)))  # an update costs far more than a row
    sums = fit.agg(F.count("*").alias("n"), *[F.sum(F.get("x", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in range(dim)]).first()
    n, s = sums.n, [int(v) for v in sums[1:]]
    base = np.array([v // n for v in s], dtype=np.int64)
    left = np.array([v - int(b) * n for v, b in zip(s, base, strict=True)], dtype=np.int64)
    rest = left / n
    found = spectrum(fit, base)
    small, turn = np.linalg.eigh(_summed_squares(fit, base, rest, found.basis, n))  # Rayleigh-Ritz in the whole basis
    values, vectors = small[::-1], (found.basis @ turn)[:, ::-1]
    trace = float(values.sum())
    keep = int((values[:components] > FLAT * trace).sum()) if trace > 0 else 0
    if not keep:
        return nothing
    projection = vectors[:, :keep] / np.sqrt(values[:keep])
    explained = values[:keep] / trace
    identity_error = float(np.abs(_summed_squares(fit, base, rest, projection, n) - np.eye(keep)).max())

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = _vectors(batch["x"]) - base
            y = (x.astype(float) - rest) @ projection
            away = n * x.astype(float) - left
            if ((away * away).sum(axis=1) > LIMIT).any():
                raise OverflowError("a deviation does not fit 64 bits")
            away = n * x - left
            deviation = (away * away).sum(axis=1)
            yield pd.DataFrame({
                "vec_id": batch["vec_id"].astype("Int64").repeat(keep).reset_index(drop=True), "component": np.tile(np.arange(1, keep + 1), len(x)), "n": n,
                "deviation": np.repeat(deviation, keep), "whitened": y.ravel(), "explained": np.tile(explained, len(x)), "identity_error": identity_error,
            })

    return rows.mapInPandas(project, RESULT)
