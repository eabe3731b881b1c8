"""Imputation by column mean and mode.

Fill values come from scalar subqueries: they are computed once, are one value each, and enter the projection
as constants, so the table itself is neither joined nor shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kohortflow.operators.aggregates import long_form


def column_means(df: DataFrame, columns: Sequence[str], scale: int | None = None) -> DataFrame:
    """One row with the mean of each column."""

    def mean(name: str) -> Column:
        out = F.avg(F.col(name).cast("double"))
        if scale is not None:  # exact sum of a rounded amount, for results independent of the row order
            out = F.sum(F.col(name).cast(f"decimal(18,{scale})")).cast("double") / F.count(F.col(name))
        return out.alias(name)

    return df.agg(*[mean(c) for c in columns])


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the most frequent non-NULL value of each column, the lowest value on a tie.

    Counted per value first, then reduced to the best one: no task holds the distinct values of a column.
    """
    counts = (
        long_form(df, [], columns, "string")
        .where(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = [
        F.min_by(
            F.when(F.col("variable") == c, F.col("value")),
            F.when(F.col("variable") == c, F.struct(-F.col("n"), F.col("value"))),
        ).alias(c)
        for c in columns
    ]
    return counts.agg(*best)


def _fill(df: DataFrame, fills: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    values = fills.select(F.struct(*columns)).scalar()
    out = {}
    for c in columns:
        kind = "double" if types[c] in ("float", "int", "bigint", "smallint", "tinyint") else types[c]
        out[c] = F.coalesce(F.col(c).cast(kind), values.getField(c).cast(kind))
    return df.withColumns(out)


def impute_mean(df: DataFrame, columns: Sequence[str], scale: int | None = None) -> DataFrame:
    """NULL -> mean of the column; integer columns become double."""
    return _fill(df, column_means(df, columns, scale), columns) if columns else df


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL -> most frequent value of the column."""
    return _fill(df, column_modes(df, columns), columns) if columns else df


def impute_missing(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], scale: int | None = None
) -> DataFrame:
    """Means for the numeric and modes for the categorical columns present in the table."""
    numeric = [c for c in df.columns if c in numeric and not dict(df.dtypes)[c].startswith(("date", "timestamp"))]
    categorical = [c for c in df.columns if c in categorical and c not in numeric]
    filled = df
    if numeric:
        filled = _fill(filled, column_means(df, numeric, scale), numeric)
    if categorical:
        filled = _fill(filled, column_modes(df, categorical), categorical)
    return filled


def impute_tables(
    tables: Mapping[str, DataFrame | None],
    numeric: Sequence[str] | Mapping[str, Sequence[str]],
    categorical: Sequence[str] | Mapping[str, Sequence[str]],
    scale: int | None = None,
) -> dict[str, DataFrame | None]:
    """:func:`impute_missing` on every table; the column lists are flat or given per table."""

    def listed(columns, name: str) -> Sequence[str]:
        return columns.get(name, []) if isinstance(columns, Mapping) else columns

    return {
        name: None if df is None else impute_missing(df, listed(numeric, name), listed(categorical, name), scale)
        for name, df in tables.items()
    }
