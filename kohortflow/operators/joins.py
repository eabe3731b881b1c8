"""Joins that stay balanced under hot keys.

Inner, left, semi and anti joins are left to Catalyst: AQE broadcasts a side that turns out small and splits
a skewed shuffle partition into several tasks. Spark cannot split a full outer join, so that one is written
as a left join plus the unmatched rest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join; columns in both sides are kept once, the left value first."""
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    renamed = right.select(*keys, *[F.col(c).alias(f"__right_{c}") for c in right.columns if c not in keys])
    joined = left.join(renamed, list(keys), "left")

    def pick(name: str) -> Column:
        if name in shared:
            return F.coalesce(F.col(name), F.col(f"__right_{name}")).alias(name)
        return F.col(name)

    extra = [c for c in right.columns if c not in keys and c not in shared]
    return joined.select(
        *[pick(c) for c in left.columns], *[F.col(f"__right_{c}").alias(c) for c in extra]
    )


def full_outer_merge(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Chained full outer join with coalesced keys.

    For each table the rows whose key no earlier table has are left-joined to the later tables; the parts
    are united. Left and anti joins are the forms AQE splits when one key is hot, and rows with a NULL key
    never reach one common task in the anti join's list of earlier keys, which is distinct.
    """
    columns: list[str] = list(keys)
    for table in tables:
        columns += [c for c in table.columns if c not in columns]
    parts = []
    for i, table in enumerate(tables):
        part = table
        if i:
            earlier = reduce(DataFrame.union, [t.select(*keys) for t in tables[:i]]).dropna().distinct()
            part = table.join(earlier, list(keys), "left_anti")
        for later in tables[i + 1 :]:
            part = merge_left(part, later, keys)
        parts.append(part)
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.select(*columns)


def link_children_to_parents(child: DataFrame, person: DataFrame) -> DataFrame:
    """Child rows with ``mother_id`` and ``father_id`` of the person of the same number."""
    parents = person.select(F.col("person_id").alias("child_id"), "mother_id", "father_id")
    return child.join(parents, "child_id")


def parent_links(links: DataFrame, *carry: str) -> DataFrame:
    """``(child_id, parent_id)`` long form, a parent in both roles once."""
    return (
        links.select(
            "child_id",
            *carry,
            F.explode(F.array_distinct(F.array("mother_id", "father_id"))).alias("parent_id"),
        )
        .where(F.col("parent_id").isNotNull())
        .distinct()
    )


def parental_income(income: DataFrame, links: DataFrame, *carry: str) -> DataFrame:
    """Income of both parents summed per child and year.

    ``carry`` names columns that depend on the child only and should stay on the row.
    """
    pairs = parent_links(links, *carry)
    earned = income.select(F.col("person_id").alias("parent_id"), "year", "total_income")
    return (
        pairs.join(earned, "parent_id")
        .groupBy("child_id", "year", *carry)
        .agg(F.sum(F.col("total_income").cast("decimal(18,2)")).alias("parental_total_income"))
    )


def link_parent_education(
    child: DataFrame, education: DataFrame, parent_id: str, result: str, known: Callable[..., Column]
) -> DataFrame:
    """Left join of one education row per person on a parent column; ``known`` builds the value."""
    edu = education.select(F.col("PNR").alias(parent_id), "HFAUDD", "HF_VFRA")
    return child.join(edu, parent_id, "left").select(
        *child.columns,
        known(F.col("HFAUDD"), F.col("HF_VFRA"), F.col("FOED_DAG")).alias(result),
    )


def person_child(bef: DataFrame, child: DataFrame) -> DataFrame:
    """Persons that are in the child table, with their relationship mark."""
    return bef.join(child.select("child_id"), F.col("PNR") == F.col("child_id")).select(
        F.col("PNR").cast("string").alias("person_id"),
        F.col("child_id").cast("string").alias("child_id"),
        F.col("FM_MARK").cast("string").alias("relationship_type"),
    )


def person_family(bef: DataFrame, family: DataFrame | None = None) -> DataFrame:
    """Persons with family and role.

    The family table defaults to the families of ``bef``, which every row with a family matches: no join.
    """
    if family is None:
        linked = bef.where(F.col("FAMILIE_ID").isNotNull())
    else:
        known = family.select(F.col("family_id").alias("__family"))
        linked = bef.join(known, F.col("FAMILIE_ID") == F.col("__family"))
    return linked.select(
        F.col("PNR").cast("string").alias("person_id"),
        F.col("FAMILIE_ID").cast("string").alias("family_id"),
        F.col("PLADS").cast("string").alias("role"),
    )


def asof_join(
    left: DataFrame,
    history: DataFrame,
    key: str,
    left_period: str,
    history_period: str,
    order: Sequence[str],
    values: Sequence[str],
) -> DataFrame:
    """For each left row the history values of the last period not after its own.

    Both sides are first reduced to one row per key and period (partial aggregation in the map tasks), so the
    window below sees at most one row per period and side of a key, however many rows that key has.
    """
    last = F.max_by(F.struct(*values), F.struct(*order))
    changes = history.groupBy(F.col(key), F.col(history_period).alias("__period")).agg(last.alias("__value"))
    asked = left.select(F.col(key), F.col(left_period).alias("__period")).dropna().distinct()
    timeline = Window.partitionBy(key).orderBy("__period", "__asked")
    carried = F.last("__value", ignorenulls=True).over(
        timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        changes.withColumn("__asked", F.lit(0))
        .unionByName(asked.withColumn("__asked", F.lit(1)), allowMissingColumns=True)
        .withColumn("__answer", carried)
        .where("__asked = 1")
        .select(
            key, F.col("__period").alias(left_period), *[F.col("__answer")[v].alias(v) for v in values]
        )
    )
    return left.join(answers, [key, left_period], "left")
