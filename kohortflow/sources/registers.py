"""Registers stored as one file per year or per year and month."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kohortflow.sources.files import IDENTIFIERS, file_format, read_csv, source_path, with_inferred_types


def _scan(spark: SparkSession, paths: list[str], fmt: str, path_column: str | None = None) -> DataFrame:
    if fmt == "csv":  # by the names in the headers, so all years go together
        return read_csv(spark, paths, types={}, path_column=path_column)
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def _pattern_regex(pattern: str) -> str:
    """File name pattern -> regular expression with year and month groups, anchored at the path's end."""
    text = re.escape(pattern)
    text = text.replace(re.escape("{yearmonth}"), r"(\d{4})(\d{2})")
    text = text.replace(re.escape("{year}"), r"(\d{4})").replace(re.escape("{month}"), r"(\d{2})")
    return f"/{text}$"


def _absent(error: AnalysisException) -> bool:
    """Is there no file, rather than something wrong with one?"""
    return "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error)


def read_register(
    spark: SparkSession,
    location: str,
    pattern: str | None = None,
    years: Sequence[int] | None = None,
    month: int | str | None = None,
    drift: bool = False,
) -> DataFrame | None:
    """One register from its per-period files as a single scan; missing years are skipped.

    ``pattern`` holds ``{year}``, ``{year}``/``{month}`` or ``{yearmonth}``; without them it names one file and
    no year is added. ``month='*'`` takes every month. The period comes from the file path, so a filter on it
    prunes files. ``drift`` unites the years one by one with identifiers as strings, for years whose column
    types disagree; columns missing in a year are NULL either way. Without a pattern the location is a table
    partitioned by ``year``. ``None`` when there is no file at all.
    """
    if pattern is None:
        try:
            table = spark.read.parquet(location)
        except AnalysisException as error:
            if not _absent(error):
                raise
            return None
        return table.where(F.col("year").isin(list(years))) if years else table
    fmt = file_format(pattern)
    periodic = "{year}" in pattern or "{yearmonth}" in pattern
    monthly = "{month}" in pattern or "{yearmonth}" in pattern
    if not periodic:
        try:
            single = _scan(spark, [f"{location}/{pattern}"], fmt)
        except AnalysisException as error:
            if not _absent(error):
                raise
            return None
        return with_inferred_types(single) if fmt == "csv" else single
    month_glob = "[0-9][0-9]" if month in (None, "*") else f"{int(month):02d}"
    year_list = [f"{y:04d}" for y in years] if years else ["[0-9][0-9][0-9][0-9]"]

    def glob(year: str) -> str:
        name = pattern.replace("{yearmonth}", year + month_glob)
        return f"{location}/{name.replace('{year}', year).replace('{month}', month_glob)}"

    groups = [glob("{" + ",".join(year_list) + "}")]
    if drift and fmt != "csv":
        groups = [glob(y) for y in year_list]
    frames = []
    for path in groups:
        try:
            df = _scan(spark, [path], fmt, "__path")
        except AnalysisException as error:
            if not _absent(error):
                raise
            continue
        if fmt != "csv":
            df = df.select("*", source_path().alias("__path"))
        regex = _pattern_regex(pattern)
        df = df.withColumn("year", F.regexp_extract("__path", regex, 1).cast("int"))
        if monthly:
            df = df.withColumn("month", F.regexp_extract("__path", regex, 2).cast("int"))
        df = df.drop("__path")
        if drift:
            df = df.select(*[F.col(c).cast("string").alias(c) if c in IDENTIFIERS else F.col(c) for c in df.columns])
        frames.append(df)
    if not frames:
        return None
    table = union_registers(frames)
    return with_inferred_types(table) if fmt == "csv" else table  # one type per column over all years


def read_registers(
    spark: SparkSession, registers: Mapping[str, Mapping], years: Sequence[int]
) -> dict[str, DataFrame | None]:
    """Named registers; a register's own ``years`` override the common range."""
    return {
        name: read_register(
            spark, spec["location"], spec.get("pattern"), spec.get("years") or years, spec.get("month"),
            spec.get("drift", False),
        )
        for name, spec in registers.items()
    }


def union_registers(frames: Sequence[DataFrame], strict: bool = False) -> DataFrame:
    """Vertical union by name; ``strict`` demands equal columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), frames)
