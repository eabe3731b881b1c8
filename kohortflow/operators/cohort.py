"""Exposed and unexposed cohorts."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kohortflow.functions.codes import in_code_ranges, not_in_code_ranges
from kohortflow.functions.exprs import MAX_AGE_DAYS, POST_DAYS, PRE_DAYS
from kohortflow.operators.projection import between_dates, has_code, lacks_code

logger = logging.getLogger(__name__)

# Study windows.
DIAGNOSIS_WINDOW = ("2000-01-01", "2018-12-31")
BIRTH_WINDOW = ("1995-01-01", "2018-12-31")


def severe_chronic_cases(
    diagnosis: DataFrame, codes: DataFrame, mode: str = "range", window: tuple[str, str] = DIAGNOSIS_WINDOW
) -> DataFrame:
    """Diagnoses in the code list and the window.

    ``codes`` holds ranges, or end points in ``endpoint`` mode; mode ``any`` takes diagnoses that were filtered
    by code before.
    """
    dated = between_dates(diagnosis, "diagnosis_date", *window)
    if mode == "any":
        return dated
    if mode == "endpoint":
        return has_code(dated, "diagnosis_code", codes.select("code"))
    return in_code_ranges(dated, "diagnosis_code", codes)


def exposed_group(
    cases: DataFrame,
    child: DataFrame | None,
    max_age_days: int = MAX_AGE_DAYS,
    non_negative: bool = False,
    first_index: bool = False,
) -> DataFrame:
    """Children diagnosed at most ``max_age_days`` after birth, one row per child and diagnosis date.

    Without a child table the cases themselves are the group. Without ``birth_date`` there is no age rule and
    a case without a child row stays. ``non_negative`` drops diagnoses dated before birth; ``first_index``
    keeps the first diagnosis date only.
    """
    no_family = F.lit(None).cast("string").alias("family_id")
    if child is None:
        logger.warning("no child table, using the cases as exposed group")
        return cases.select(
            F.col("person_id").alias("child_id"), no_family, F.col("diagnosis_date").alias("index_date")
        ).distinct()

    has_birth = "birth_date" in child.columns
    id_column = "child_id" if "child_id" in child.columns else "person_id"
    keep = [F.col(id_column).alias("__child")]
    keep += [F.col(c) for c in ("family_id", "birth_date") if c in child.columns]
    event = cases.select("person_id", "diagnosis_date").distinct()
    joined = event.join(
        child.select(*keep), F.col("person_id") == F.col("__child"), "inner" if has_birth else "left"
    )
    if has_birth:
        age = F.datediff("diagnosis_date", "birth_date")
        joined = joined.where(age <= max_age_days)
        if non_negative:
            joined = joined.where(age >= 0)
    columns = [
        F.col("person_id").alias("child_id"),
        F.col("family_id") if "family_id" in child.columns else no_family,
    ]
    if has_birth:
        columns.append(F.col("birth_date"))
    if first_index:
        index = F.min("diagnosis_date").alias("index_date")
        return joined.select(*columns, "diagnosis_date").groupBy(
            "child_id", "family_id", *(["birth_date"] if has_birth else [])
        ).agg(index)
    return joined.select(*columns, F.col("diagnosis_date").alias("index_date")).distinct()


def unexposed_pool(
    child: DataFrame, exclude: DataFrame | None = None, window: tuple[str, str] = BIRTH_WINDOW
) -> DataFrame:
    """Children born in the window; ``exclude`` removes the children of an exposed group."""
    extra = [c for c in child.columns if c not in ("family_id", "child_id", "birth_date")]
    pool = between_dates(child, "birth_date", *window).select("family_id", "child_id", "birth_date", *extra)
    if exclude is not None:
        pool = pool.join(exclude.select("child_id").distinct(), "child_id", "left_anti")
    return pool.select("family_id", "child_id", "birth_date", *extra).distinct()


def exact_match(exposed: DataFrame, pool: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pool children that share the match keys with exposed children, carrying the exposed index dates.

    The match is many-to-many. Exposed rows with equal keys and index date give identical matches, so they are
    counted before the join and the result has one row per pool child and index date with ``n_exposed``, the
    number of exposed rows it stands for. A child's rows are bounded by the days of the diagnosis window, not
    by the size of its stratum. Repeating each row ``n_exposed`` times gives the plain pair list.
    """
    keys = keys or ["birth_date"]
    index = exposed.groupBy(*keys, "index_date").agg(F.count(F.lit(1)).alias("n_exposed"))
    return (
        pool.where(F.col("family_id").isNotNull())
        .join(index, keys)
        .select(*keys, "family_id", "child_id", "index_date", "n_exposed")
    )


def exposure_weights(exposed: DataFrame, pool: DataFrame) -> DataFrame:
    """``(child_id, w_exposed, w_unexposed)``: how often each child occurs in the two matched cohorts.

    Same information as the cohorts for any sum or mean over them, without writing out the matches. A birth
    date has one count, so that side has at most one row per calendar day.
    """
    per_day = exposed.groupBy("birth_date").agg(F.count(F.lit(1)).alias("w"))
    unexposed = (
        pool.where(F.col("family_id").isNotNull())
        .join(per_day, "birth_date")
        .select("child_id", F.lit(0).cast("bigint").alias("w_exposed"), F.col("w").alias("w_unexposed"))
    )
    own = exposed.select(
        "child_id", F.lit(1).cast("bigint").alias("w_exposed"), F.lit(0).cast("bigint").alias("w_unexposed")
    )
    return (
        own.unionByName(unexposed)
        .groupBy("child_id")
        .agg(F.sum("w_exposed").alias("w_exposed"), F.sum("w_unexposed").alias("w_unexposed"))
    )


def rank_in_strata(
    df: DataFrame, strata: list[str], draw: Column, tie: str, result: str, slices: int = 64
) -> DataFrame:
    """Row number within a stratum in order of ``draw`` (a value in [0, 1)), ties by ``tie``.

    A stratum is cut into ``slices`` ranges of the draw that are numbered separately, and the sizes of the
    earlier slices are added, so a stratum holding a third of all rows is still sorted by many tasks.
    """
    keys = [*strata, "__slice"]
    cut = df.withColumn("__draw", draw).withColumn("__slice", F.floor(F.col("__draw") * slices).cast("int"))
    local = cut.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy("__draw", tie)))
    before = Window.partitionBy(*strata).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__size"))
        .select(*keys, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    )
    return (
        local.join(offsets, keys)
        .withColumn(result, F.col("__rn") + F.col("__offset"))
        .drop("__slice", "__draw", "__rn", "__offset")
    )


def match_one_to_k(
    exposed: DataFrame,
    pool: DataFrame,
    k: int,
    keys: list[str] | None = None,
    draw: Column | None = None,
) -> DataFrame:
    """1:k matching without replacement inside each stratum of equal keys.

    Exposed children and controls are numbered per stratum; control ``n`` belongs to exposed ``ceil(n / k)``.
    Every control is used at most once and no pair is formed that is not a match. ``exposed`` must have one
    row per child (``first_index``); the draw defaults to a hash of the child id.
    """
    keys = keys or ["birth_date"]
    if draw is None:
        draw = F.shiftrightunsigned(F.xxhash64("child_id"), 11).cast("double") / F.lit(float(2**53))
    cases = rank_in_strata(
        exposed.select(*keys, "child_id", "index_date"), keys, draw, "child_id", "slot"
    ).withColumnRenamed("child_id", "exposed_id")
    controls = rank_in_strata(pool.select(*keys, "child_id"), keys, draw, "child_id", "n")
    controls = controls.withColumn("slot", F.ceil(F.col("n") / F.lit(k)).cast("bigint"))
    return (
        cases.withColumn("slot", F.col("slot").cast("bigint"))
        .join(controls, [*keys, "slot"])
        .select(*keys, "exposed_id", "index_date", "child_id")
    )


def record_split(linked: DataFrame, codes: DataFrame, mode: str = "range") -> tuple[DataFrame, DataFrame]:
    """Health records by code in and not in the list; a child may have records in both."""
    if mode == "endpoint":
        keys = codes.select("code")
        return has_code(linked, "C_DIAG", keys), lacks_code(linked, "C_DIAG", keys)
    return in_code_ranges(linked, "C_DIAG", codes), not_in_code_ranges(linked, "C_DIAG", codes)


def treatment_period(diagnosis: DataFrame, child: DataFrame) -> DataFrame:
    """Per diagnosis of a child: 365 days before and 5 x 365 days after its date, with the family."""
    start = F.col("diagnosis_date").cast("date")
    return diagnosis.join(
        child.select("child_id", "family_id"), F.col("person_id") == F.col("child_id")
    ).select(
        F.col("family_id").cast("string").alias("family_id"),
        start.alias("treatment_start_date"),
        F.date_sub(start, PRE_DAYS).alias("pre_treatment_start"),
        start.alias("pre_treatment_end"),
        F.date_add(start, POST_DAYS).alias("post_treatment_end"),
    )


def pre_post_label(dated: DataFrame, date: str, period: DataFrame) -> DataFrame:
    """Rows labelled ``pre`` or ``post`` relative to any treatment of the family, others left out.

    A day after one treatment and before another is ``post``. A family's distinct treatment days are one array, so
    its rows are not multiplied by its treatments.
    """
    starts = period.groupBy("family_id").agg(F.collect_set("treatment_start_date").alias("_starts"))
    day = F.col(date)
    after = F.exists("_starts", lambda s: day.between(s, F.date_add(s, POST_DAYS)))
    before = F.exists("_starts", lambda s: day.between(F.date_sub(s, PRE_DAYS), s))
    labelled = dated.join(starts, "family_id").withColumn("period", F.when(after, "post").when(before, "pre"))
    return labelled.where(F.col("period").isNotNull()).drop("_starts")


def outcome_by_period(
    exposed: DataFrame, outcomes: DataFrame, key: str, date: str, value: str, years: dict[str, int]
) -> DataFrame:
    """Count and sum of an outcome within 1, 5, 10 ... years (of 365 days) after each child's index date.

    ``exposed`` has one row per child (``first_index``), so one join serves all periods. A child without
    an outcome counts 0.
    """
    days = F.datediff(F.col(date), F.col("index_date"))
    cells = []
    for name, length in years.items():
        inside = days.between(0, length * 365)
        cells += [
            F.count_if(inside).alias(f"n_{name}"),
            F.coalesce(F.sum(F.when(inside, F.col(value))), F.lit(0)).alias(f"sum_{name}"),
        ]
    children = exposed.select("child_id", "index_date")
    # an inner join can be split on either side, an outer one not on the outcomes'; so children without come last
    found = children.join(outcomes.select(F.col(key).alias("child_id"), date, value), "child_id").groupBy("child_id", "index_date").agg(*cells)
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in found.columns[2:]]
    return children.join(found, ["child_id", "index_date"], "left").select("child_id", "index_date", *zeros)
