"""Aggregations: every one combines in the map tasks before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_persons(df: DataFrame, person: str, approximate: bool = False) -> Column:
    """Number of distinct persons as an aggregate expression."""
    return F.approx_count_distinct(person) if approximate else F.count_distinct(F.col(person))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    ``max_by`` instead of a ranked window: a hot key becomes one candidate per map task, never a sort of all
    its rows in one task. Use :func:`null_first_desc` for keys where NULL must win.
    """
    keep = [c for c in (keep or df.columns) if c not in keys]
    best = F.max_by(F.struct(*keep), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("__best")[c].alias(c) for c in keep])


def null_first_desc(name: str) -> list[Column]:
    """Order keys under which NULL beats every value (an open end date is the latest)."""
    return [F.col(name).isNull().cast("int"), F.col(name)]


def family_first_address(
    df: DataFrame, family: str, address: str, order: Sequence[str], result: str
) -> DataFrame:
    """Every member gets the address of the family's first row."""
    first = df.groupBy(family).agg(F.min_by(address, F.struct(*order)).alias(result))
    return df.join(first, family)


def family_size(df: DataFrame, family: str, larger_than: int | None = None) -> DataFrame:
    """Members per family, on request only families above a size."""
    sizes = df.groupBy(family).agg(F.count(F.lit(1)).alias("n_members"))
    return sizes if larger_than is None else sizes.where(F.col("n_members") > larger_than)


def long_form(df: DataFrame, keys: Sequence[str], columns: Sequence[str], kind: str) -> DataFrame:
    """``(keys..., variable, value)``, one row per listed column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(*keys, F.explode(pairs).alias("__pair")).select(
        *keys, F.col("__pair.variable").alias("variable"), F.col("__pair.value").alias("value")
    )


#: Rows above which a group is joined by a broadcast of its single row; a smaller group may be one task's.
LARGE_GROUP = 100_000


def with_group_row(rows: DataFrame, keys: Sequence[str], groups: DataFrame, n: str) -> DataFrame:
    """``rows`` beside the columns of their group's row in ``groups`` (keys, ``n`` = rows of the group, ...).

    NULL is a group. AQE does not turn a join on a few keys into a broadcast, as most partitions of such a side
    are empty, and sorts a whole group in one task. So the rows of large groups are never shuffled: a table has
    at most one such group in :data:`LARGE_GROUP` rows, and these are broadcast. The other groups are shuffled.
    """
    found = groups.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.struct(*groups.columns).alias("__group"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    large = F.col(f"__group.{n}") > LARGE_GROUP
    tagged = rows.join(F.broadcast(found.where(large)), same, "left")
    others = tagged.where(F.col("__group").isNull()).select(*rows.columns).join(found.where(~large), same)
    new = [F.col(f"__group.{c}").alias(c) for c in groups.columns if c not in keys]
    return reduce(DataFrame.union, [df.select(*rows.columns, *new) for df in (tagged.where(F.col("__group").isNotNull()), others)])


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    accuracy: int = 10_000,
    n: str | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group, one column per entry of ``probs`` (name -> probability).

    With ``n``, a column of that name has the group's number of values.

    Spark's ``percentile`` keeps all distinct values of a group in one buffer. Here a quantile sketch first
    brackets every quantile. The second pass keeps the single values inside a bracket and counts whole
    stretches between brackets, each with its lowest and highest value, so that no task ever holds a group:
    what is left of it is a few stretches and at most ``8 / accuracy`` of its values per quantile. A rank
    looked up inside a stretch would mean that the sketch broke its error bound, and raises an error.
    """
    keys, probs = list(keys), dict(probs)
    margin = 4.0 / accuracy
    bounds = [min(1.0, max(0.0, p + m)) for p in probs.values() for m in (-margin, margin)]
    rows = df.select(*keys, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    sketch = F.percentile_approx("__v", F.array(*[F.lit(b) for b in bounds]), F.lit(accuracy))
    stats = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), sketch.alias("__b"))

    below = [F.col("__v") < F.get("__b", F.lit(2 * i)) for i in range(len(probs))]
    above = [F.col("__v") > F.get("__b", F.lit(2 * i + 1)) for i in range(len(probs))]
    outside = reduce(lambda a, b: a & b, [x | y for x, y in zip(below, above, strict=True)])
    stretch = reduce(lambda a, b: a + b, [x.cast("int") for x in below])  # which gap between the brackets
    pieces = (
        with_group_row(rows, keys, stats, "__n")
        .select(
            *keys,
            "__n",
            "__v",
            F.when(outside, stretch).alias("__stretch"),
            F.when(~outside, F.col("__v")).alias("__single"),
        )
        .groupBy(*keys, "__n", "__stretch", "__single")
        .agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__lowest"), F.max("__v").alias("__highest"))
    )
    upto = Window.partitionBy(*keys).orderBy("__lowest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = pieces.withColumn("__last", F.sum("__c").over(upto))
    first = F.col("__last") - F.col("__c") + 1

    def at_rank(rank: Column) -> Column:
        hit = F.when(rank == first, F.col("__lowest")).when(rank == F.col("__last"), F.col("__highest"))
        return F.max(hit.when(F.col("__single").isNotNull() & rank.between(first, F.col("__last")), F.col("__single")))

    picks = []
    for i, p in enumerate(probs.values()):
        position = (F.col("__n") - 1) * F.lit(float(p))
        picks += [at_rank(F.floor(position) + 1).alias(f"__lo{i}"), at_rank(F.ceil(position) + 1).alias(f"__hi{i}")]
    picked = ranked.groupBy(*keys).agg(F.max("__n").alias("__n"), *picks)
    out = []
    for i, (name, p) in enumerate(probs.items()):
        position = (F.col("__n") - 1) * F.lit(float(p))
        missed = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
        low, high = F.coalesce(F.col(f"__lo{i}"), missed), F.coalesce(F.col(f"__hi{i}"), missed)
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return picked.select(*keys, *([F.col("__n").alias(n)] if n else []), *out)


def group_summary(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Mean, median, sample deviation, minimum and maximum per group, one row per group and variable."""
    values = long_form(df, [group], columns, "double")
    moments = values.groupBy(group, "variable").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    medians = group_quantiles(values, [group, "variable"], "value", {"median": 0.5}).select(
        F.col(group).alias("__g"), F.col("variable").alias("__v"), "median"
    )
    same = F.col(group).eqNullSafe(F.col("__g")) & (F.col("variable") == F.col("__v"))
    return moments.join(medians, same, "left").select(
        group, "variable", "mean", "median", "std", "min", "max"
    )


def wide_summary(summary: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """:func:`group_summary` with one row per group and columns ``<variable>_mean``, ``<variable>_median``, ..."""
    cells = [
        F.max(F.when(F.col("variable") == c, F.col(s))).alias(f"{c}_{s}")
        for s in ("mean", "median", "std", "min", "max")
        for c in columns
    ]
    return summary.groupBy(group).agg(*cells)


def value_counts(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Rows per group, variable and category, NULL as a category; long form, no list per group."""
    return long_form(df, [group], columns, "string").groupBy(group, "variable", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def summary_joined(df: DataFrame, group: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Numeric summary next to the category counts of the same group; a NULL group drops out."""
    counts = value_counts(df, group, categorical).withColumnRenamed("variable", "category_variable")
    return group_summary(df, group, numeric).join(counts, group)


def contingency(df: DataFrame, category: str, group: str, groups: Sequence, count: str) -> DataFrame:
    """Category x group table of summed counts; the group values are named, so no extra job finds them."""
    return df.groupBy(category).pivot(group, list(groups)).agg(F.sum(count))


def box_stats(df: DataFrame, group: str, value: str, factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values within ``factor`` IQR) and outlier count per group."""
    quartiles = group_quantiles(df, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, n="__n")
    spread = F.lit(factor) * (F.col("q3") - F.col("q1"))
    inside = F.col("__v").between(F.col("q1") - spread, F.col("q3") + spread)
    rows = df.select(group, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    return (
        with_group_row(rows, [group], quartiles, "__n")
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("__v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("__v"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def mean_by_year(df: DataFrame, value: str, weights: dict[str, str]) -> DataFrame:
    """Weighted mean of ``value`` per year for several weight columns at once (``result -> weight``)."""
    sums = []
    for result, weight in weights.items():
        sums += [
            F.sum(F.col(value) * F.col(weight)).alias(f"__s_{result}"),
            F.sum(weight).alias(f"__w_{result}"),
        ]
    means = [
        F.when(F.col(f"__w_{r}") > 0, F.col(f"__s_{r}").cast("double") / F.col(f"__w_{r}")).alias(r)
        for r in weights
    ]
    return df.groupBy("year").agg(*sums).select("year", *means)
