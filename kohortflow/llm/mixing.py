"""Mixing sources to target weights by pivotal rounding.

A source's target over its size is the number of copies each of its documents should have. The whole part is taken
as it is; the fraction is a probability, and probabilities are rounded dependently: two fractional documents of
similar size trade words (what one gains the other loses, so the source's total stays) until one of them is whole,
with the direction drawn so that every expectation stays too. Groups of some thousand documents do that in one task each and leave at
most one fractional document; those of neighbouring groups meet on the next level of a reduction tree, until one is
left per source, which a draw rounds. So a source misses its target by less than one small document.

Groups, orders and draws come from hashes of the rows, never from their place, so reruns agree on any cluster.

Defined results: a null or empty text has size 0, any number of copies and takes 0 words. Null sources are one
source, last in the order. Repeated rows are rounded each for itself. Null ids are allowed. An empty table gives an
empty result; if all sizes are 0, all targets are 0. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kohortflow.llm.common import WORD, shuffle_width
from kohortflow.session import cut_lineage

#: Weights of the sources in order of their names, repeating; share of all words; most copies of a document.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
GROUP = 2048  # documents of one group on the tree's lowest level, and at most so many residuals above
SEED = 20


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, n_docs, target): words each source should give.

    Targets are proportional to the weights, cut at ``most`` times the source, the excess shared again. That is one
    water level for all uncut sources; the loop moves three numbers per step. Sources are ranked by range partition
    plus offset, so many sources need no task that sees all of them.
    """
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = [F.col("source").isNull(), F.col("source")]
    parts = cut_lineage(totals.repartitionByRange(shuffle_width(spark), *order).withColumn("_part", F.spark_partition_id()))
    before = parts.groupBy("_part").count().withColumn("_before", F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1 + F.coalesce("_before", F.lit(0))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = cut_lineage(parts.join(before.select("_part", "_before"), "_part").select("source", "source_size", "n_docs", weight.alias("weight")))
    total, free = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (total or 0)
    level = total / free if free else 0.0
    while True:
        cut = F.col("source_size") * most <= F.col("weight") * level
        held, free = ranked.agg(F.sum(F.when(cut, F.col("source_size") * most).otherwise(0)), F.sum(F.when(cut, 0.0).otherwise(F.col("weight")))).first()
        raised = (total - held) / free if free else level
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return ranked.select("source", "source_size", "n_docs", F.least(F.col("source_size") * float(most), F.col("weight") * F.lit(level)).alias("target"))


def _snapped(p: float) -> float:
    """``p`` within 0 and 1, and whole if only rounding keeps it from that."""
    return 0.0 if p < 1e-12 else 1.0 if p > 1 - 1e-12 else p


def _traded(size: np.ndarray, p: np.ndarray, draws: np.ndarray, items: list[int]) -> int:
    """Pair the fractional ``items`` until at most one is left; its place, or -1."""
    held = -1
    for j in items:
        if not 0 < p[j] < 1:
            continue
        if held < 0:
            held = j
            continue
        up = min((1 - p[held]) * size[held], p[j] * size[j])
        down = min(p[held] * size[held], (1 - p[j]) * size[j])
        if draws[j] * (up + down) < down:  # the held one gains
            full = (1 - p[held]) * size[held] <= p[j] * size[j]
            p[held], p[j] = (1.0, _snapped(p[j] - up / size[j])) if full else (_snapped(p[held] + up / size[held]), 0.0)
        else:
            empty = p[held] * size[held] <= (1 - p[j]) * size[j]
            p[held], p[j] = (0.0, _snapped(p[j] + down / size[j])) if empty else (_snapped(p[held] - down / size[held]), 1.0)
        if not 0 < p[held] < 1:
            held = j if 0 < p[j] < 1 else -1
    return held


def pivoted(group: pd.DataFrame, seed: int) -> pd.DataFrame:
    """One group's trades: ``p`` becomes 0 or 1 for all rows but at most one, the sum of size times p stays.

    Documents trade within a class of sizes (a power of two), largest class first. What a class leaves over is
    drawn, and the words won or lost are spread evenly over the smaller documents' probabilities, which have mean
    zero and so keep every expectation. If the smaller ones have no room for that, it trades on with the next class.
    """
    group = group.sort_values(["size", "order"], ascending=[False, True], ignore_index=True)
    size, p = group["size"].to_numpy(float), group["p"].to_numpy(float).copy()
    draws = np.random.default_rng(seed).random((2, len(p)))
    live = np.flatnonzero((p > 0) & (p < 1))
    ends = np.flatnonzero(np.diff(np.floor(np.log2(size[live])), append=-1)) + 1
    held, start = -1, 0
    for end in ends:
        held = _traded(size, p, draws[0], [held, *live[start:end]] if held >= 0 else list(live[start:end]))
        start, rest = end, live[end:]
        if held >= 0 and len(rest):
            room = np.minimum(p[rest], 1 - p[rest]).min() / 2
            if max(p[held], 1 - p[held]) * size[held] <= room * size[rest].sum():
                taken = float(draws[1, held] < p[held])
                p[rest] += (p[held] - taken) * size[held] / size[rest].sum()
                p[held], held = taken, -1
    group["p"] = p
    return group


def _order(seed: int) -> Column:
    """Draws and orders of a document come from this; equal for repeated rows, which are interchangeable."""
    return F.xxhash64(F.lit(seed), "doc_id", "source", "text")


def mixed(docs: DataFrame, seed: int = SEED, group: int = GROUP, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every document, and ``order`` if it is in ``carry``.

    ``copies`` is what the mix takes of a document: 0 up to 2.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = cut_lineage(docs.select("doc_id", "source", size.alias("size"), _order(seed).alias("order")))
    targets = cut_lineage(source_targets(sized))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12)
    fraction = F.when(F.col("size") > 0, F.greatest(F.lit(0.0), ratio - whole)).otherwise(0.0)
    groups = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / group))
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        sized["*"], "source_size", "target", whole.cast("long").alias("base"), fraction.alias("p"),
        groups.alias("groups"), F.pmod(F.xxhash64("order", F.lit("group")), groups).alias("bucket"),
    )

    def trade(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pivoted(pdf, zlib.crc32(repr((seed, *key)).encode()))

    settled, level, left = None, 0, 1
    while left:
        keyed = rows.withColumn("bucket", F.floor(F.col("bucket") / (1 if level == 0 else group)))
        done = cut_lineage(keyed.withColumn("_level", F.lit(level)).groupBy("_level", "source", "bucket").applyInPandas(trade, keyed.withColumn("_level", F.lit(level)).schema).drop("_level"))
        whole_now = done.where("NOT (p > 0 AND p < 1)")
        settled = whole_now if settled is None else settled.unionByName(whole_now)
        rows = done.where("p > 0 AND p < 1")
        left = rows.select(F.max("groups")).first()[0]
        level += 1
        if left and left <= group ** (level - 1):  # one residual per source
            drawn = F.when(F.pmod(F.xxhash64("order", F.lit("last")), F.lit(1 << 30)) / float(1 << 30) < F.col("p"), 1.0).otherwise(0.0)
            settled, left = settled.unionByName(rows.withColumn("p", drawn)), 0
    copies = F.col("base") + F.col("p").cast("long")
    return settled.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *carry)


def repeated(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed corpus itself: each document as often as it is taken, with its own columns.

    Rows equal in id, source and text share what was decided for them evenly.
    """
    picked = mixed(docs, seed, carry=("order",)).groupBy("order").agg(F.sum("copies").alias("copies"), F.count("*").alias("alike"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), _order(seed).alias("order"))
    place = F.row_number().over(Window.partitionBy("order").orderBy("order"))
    joined = whole.join(picked.where("copies > 0"), "order").withColumn("_place", place)
    share = F.floor(F.col("copies") / F.col("alike")) + F.when(F.col("_place") <= F.col("copies") % F.col("alike"), 1).otherwise(0)
    return joined.where(share > 0).select("_row", F.explode(F.array_repeat(F.lit(0), share.cast("int")))).select("_row.*")
