"""Projections, casts and row filters."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

ColumnSpec = tuple[str, str, str]  # source column, target column, target type


def require_columns(df: DataFrame | None, columns: Sequence[str], name: str) -> DataFrame:
    """``df`` when it has all the columns, else ``ValueError``."""
    if df is None:
        raise ValueError(f"{name} data is None")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns in {name} data: {', '.join(missing)}")
    return df


def typed_projection(
    df: DataFrame | None, columns: Sequence[ColumnSpec], name: str, lenient: bool = False
) -> DataFrame | None:
    """Select, rename and cast the listed columns that exist; ``None`` when none does.

    Casts are strict (ANSI mode raises on a bad value); ``lenient`` turns bad values into NULL.
    """
    if df is None:
        return None
    present = [spec for spec in columns if spec[0] in df.columns]
    missing = [source for source, _, _ in columns if source not in df.columns]
    if missing:
        logger.warning("missing columns in %s data: %s", name, ", ".join(missing))
    if not present:
        logger.warning("no valid columns in %s data", name)
        return None
    cast = Column.try_cast if lenient else Column.cast
    return df.select(*[cast(F.col(source), kind).alias(target) for source, target, kind in present])


def between_dates(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Rows dated in the inclusive range; the comparison reaches the Parquet scan."""
    return df.where(F.col(column).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def has_code(df: DataFrame, column: str, codes: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose code is in the set: ``IN`` for a list, a semi join for a one-column table."""
    if isinstance(codes, DataFrame):
        return df.join(codes, df[column] == codes[codes.columns[0]], "left_semi")
    return df.where(F.col(column).isin(list(codes)))


def lacks_code(df: DataFrame, column: str, codes: Sequence[str] | DataFrame) -> DataFrame:
    """Rows with a known code outside the set; a NULL code is in neither set."""
    if isinstance(codes, DataFrame):
        known = df.where(F.col(column).isNotNull())
        return known.join(codes, known[column] == codes[codes.columns[0]], "left_anti")
    return df.where(~F.col(column).isin(list(codes)))


def eligible_children(
    bef: DataFrame, mfr: DataFrame, start_year: int, end_year: int, max_age: int
) -> DataFrame:
    """Persons in the birth register, born in ``[start - max_age, end]`` and observed in ``[start, end]``."""
    born = F.year("FOED_DAG")
    observed = born + F.col("ALDER")
    return (
        bef.where(born.between(start_year - max_age, end_year) & observed.between(start_year, end_year))
        .join(mfr.select("CPR_BARN"), F.col("PNR") == F.col("CPR_BARN"))
        .select("PNR", "FOED_DAG", "KOEN", "MOR_ID", "FAR_ID")
    )


def multi_key_sort(df: DataFrame, ascending: str, descending: str) -> DataFrame:
    """Global sort by two keys, the second descending, NULL first in both."""
    return df.orderBy(F.col(ascending).asc_nulls_first(), F.col(descending).desc_nulls_first())


def limit_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """First ``n`` rows in key order (a top-k, no full sort)."""
    return df.orderBy(*keys).limit(n)
