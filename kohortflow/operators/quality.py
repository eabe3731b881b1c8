"""Data quality reports: each is one pass over the table for all columns or rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kohortflow.functions.exprs import PARENT_AGE_MAX, PARENT_AGE_MIN, person_number_rules
from kohortflow.operators.aggregates import group_quantiles, long_form


def _stack(row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One wide row of results -> one row per struct."""
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def missing_report(df: DataFrame, all_columns: bool = False) -> DataFrame:
    """NULL count and percent per column, only columns with NULLs; an empty table is an error."""
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in enumerate(names)],
    )
    total = F.when(F.col("__n") == 0, F.raise_error(F.lit("the table is empty")).cast("bigint")).otherwise(
        F.col("__n")
    )
    report = _stack(
        counts,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"__{i}").alias("n_missing"),
                (F.col(f"__{i}") * F.lit(100.0) / total).alias("pct_missing"),
            )
            for i, c in enumerate(names)
        ],
    )
    return report if all_columns else report.where("n_missing > 0")


def missing_over_threshold(df: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Columns whose share of NULLs is above the threshold."""
    return missing_report(df).where(F.col("pct_missing") > threshold * 100)


DATE_TYPES = ("date", "timestamp", "timestamp_ntz")


def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Per numeric column: bounds ``Q1 - f IQR`` and ``Q3 + f IQR`` and the rows outside.

    Absent and date columns are skipped. Two passes for all columns together: exact quartiles, then counts.
    """
    types = dict(df.dtypes)
    columns = [c for c in columns if c in types and types[c] not in DATE_TYPES]
    values = long_form(df, [], columns, "double")
    spread = F.lit(factor) * (F.col("q3") - F.col("q1"))
    bounds = group_quantiles(values, ["variable"], "value", {"q1": 0.25, "q3": 0.75}).select(
        "variable", (F.col("q1") - spread).alias("lower"), (F.col("q3") + spread).alias("upper")
    )
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    # one row of bounds per listed column, a handful by construction
    return (
        values.join(F.broadcast(bounds), "variable")
        .groupBy("variable", "lower", "upper")
        .agg(F.count_if(outside).alias("n_outliers"))
        .withColumnRenamed("variable", "column_name")
    )


def default_rules(table: str) -> dict[str, Column]:
    """Built-in consistency rules: a birth date after 2023-01-01 is wrong."""
    if table == "Person":
        return {"invalid_birth_dates": F.col("birth_date") > F.lit("2023-01-01").cast("date")}
    return {}


def consistency_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violating rows per named rule, all in one pass; a rule that does not fit the table reports its error."""
    counts, failed = {}, {}
    for name, rule in rules.items():
        try:
            df.select(rule)
            counts[name] = rule
        except AnalysisException as error:
            failed[name] = str(error).splitlines()[0]
    row = df.agg(F.lit(1).alias("__one"), *[F.count_if(r).alias(f"__{n}") for n, r in counts.items()])
    results = [
        F.struct(
            F.lit(n).alias("rule"),
            (F.col(f"__{n}") if n in counts else F.lit(None)).cast("bigint").alias("n_violations"),
            F.lit(failed.get(n)).cast("string").alias("error"),
        )
        for n in rules
    ]
    return _stack(row, results)


def age_consistency(df: DataFrame, year: str, birth_date: str, age: str) -> DataFrame:
    """Rows whose age is not year minus birth year."""
    return consistency_rules(df, {"age": F.col(year) - F.year(birth_date) != F.col(age)}).drop("error")


def parent_age_gap(child: DataFrame, person: DataFrame) -> DataFrame:
    """Per parental role: children with a known parent and those whose parent is not 15 to 50 years older.

    The roles are united below one join, so both are answered by the same shuffle.
    """
    roles = F.explode(
        F.array(
            F.struct(F.lit("mother").alias("role"), F.col("mother_id").alias("parent_id")),
            F.struct(F.lit("father").alias("role"), F.col("father_id").alias("parent_id")),
        )
    )
    links = child.select(F.year("birth_date").alias("child_year"), roles.alias("r")).select(
        "child_year", "r.role", "r.parent_id"
    )
    parents = person.select(
        F.col("person_id").alias("parent_id"), F.year("birth_date").alias("parent_year")
    )
    gap = F.col("child_year") - F.col("parent_year")
    return (
        links.join(parents, "parent_id")
        .groupBy("role")
        .agg(
            F.count(F.lit(1)).alias("n_links"),
            F.count_if(~gap.between(PARENT_AGE_MIN, PARENT_AGE_MAX)).alias("n_violations"),
        )
    )


def person_number_check(df: DataFrame, number: str, birth_date: str, sex: str) -> DataFrame:
    """Violations per person-number rule: date digits, century digit, sex parity."""
    rules = person_number_rules(F.col(number), F.col(birth_date), F.col(sex))
    return consistency_rules(df, rules).drop("error")
