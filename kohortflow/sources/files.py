"""Parquet and CSV files."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
NULL_TOKENS = ["", "NULL", "null", "NA", "na", "NaN", "nan"]
ENCODINGS = ["utf-8", "iso-8859-1", "windows-1252"]
# Identifier columns, always read as strings.
IDENTIFIERS = [
    "PNR",
    "SENR",
    "CPR",
    "CVR",
    "PNR12",
    "AEGTE_ID",
    "E_FAELLE_ID",
    "FAR_ID",
    "MOR_ID",
    "FAMILIE_ID",
    "ARBGNR",
    "ARBNR",
    "RECNUM",
    "PK_MFR",
    "FK_MFR",
    "YDERNR",
    "CPR_BARN",
    "CPR_FADER",
    "CPR_MODER",
]
FILE = "__file_path"
REPLACEMENT = "�"  # what a decoder leaves where the bytes are not valid in the encoding


def file_format(path: str) -> str:
    """``parquet`` or ``csv`` by suffix, anything else is an error."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in (".parquet", ".csv"):
        raise ValueError(f"unsupported file format: {path}")
    return suffix[1:]


def _raw_csv(spark: SparkSession, paths: Sequence[str], encoding: str, lines: bool = False) -> DataFrame:
    return spark.read.csv(list(paths), header=True, encoding=encoding, escape='"', inferSchema=False, multiLine=lines)


def csv_layouts(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], bool]]:
    """Files that can share a scan, as (paths, values span lines): those of equal header and kind.

    CSV is read by position, so files with other columns, or the same in another order, need a scan of their own.
    A value spans lines if a line holds an odd number of quotes while its file as a whole holds an even one; only
    such files are read unsplit. One pass counts quotes and finds each file's first line by number, a second takes
    the headers; the driver sees one row per file. Empty files are left out.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    files = lines.groupBy("path").agg(
        F.min(F.when(F.col("block") == 0, F.col("line"))).alias("line"),
        F.max(quotes % 2).alias("odd"),
        (F.sum(quotes) % 2).alias("open"),
    )
    heads = lines.where("block = 0").join(files, ["path", "line"]).select("path", "value", "odd", "open")
    found: dict[tuple[str, bool], list[str]] = {}
    for row in heads.orderBy("path").toLocalIterator():
        path = re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(row.path))  # a name, not a pattern
        found.setdefault((row.value, row.odd == 1 and row.open == 0), []).append(path)
    return [(group, spans) for (_, spans), group in found.items()]


def _broken(df: DataFrame) -> Column:
    return F.coalesce(F.greatest(*[F.col(f"`{c}`").contains(REPLACEMENT) for c in df.columns], F.lit(False)), F.lit(False))


def _decoded_csv(spark: SparkSession, paths: Sequence[str], encodings: Sequence[str], lines: bool = False) -> DataFrame:
    """Files of one header, each in the first encoding that leaves no decoding error in it; the header likewise."""
    raw = _raw_csv(spark, paths, encodings[0], lines)
    names = raw.columns
    frame = raw.withColumn(FILE, F.col("_metadata.file_path"))
    for encoding in encodings[1:]:
        clear = not any(REPLACEMENT in c for c in names)
        if clear and frame.where(_broken(frame)).isEmpty():
            break
        bad = frame.where(_broken(frame)).select(FILE).distinct()
        again = _raw_csv(spark, paths, encoding, lines)
        names = names if clear else again.columns
        again = again.withColumn(FILE, F.col("_metadata.file_path")).toDF(*names, FILE)
        frame = frame.toDF(*names, FILE)
        columns = [F.col(f"`{c}`") for c in frame.columns]
        kept = frame.join(bad, FILE, "left_anti").select(*columns)
        frame = kept.union(again.join(bad, FILE, "left_semi").select(*columns))
    return frame


def with_inferred_types(df: DataFrame, string_cols: Sequence[str] = IDENTIFIERS) -> DataFrame:
    """String columns as the narrowest of bigint, double, date that fits all their values; one pass for all."""
    columns = [c for c, kind in df.dtypes if kind == "string" and c not in string_cols]
    found = _fitting_types(df, columns)
    return df.select(*[F.col(c).try_cast(found[c]).alias(c) if c in found else F.col(c) for c in df.columns])


def _fitting_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    kinds = ("bigint", "double", "date")
    fits = [
        F.bool_and(F.col(c).isNull() | F.col(c).try_cast(k).isNotNull()).alias(f"{i}_{k}")
        for i, c in enumerate(columns)
        for k in kinds
    ]
    if not fits:
        return {}
    row = df.agg(*fits, *[F.count(c).alias(f"{i}_n") for i, c in enumerate(columns)]).first()
    found = {}
    for i, c in enumerate(columns):
        good = [k for k in kinds if row[f"{i}_{k}"]]
        if good and row[f"{i}_n"]:
            found[c] = good[0]
    return found


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    nulls: Sequence[str] = NULL_TOKENS,
    encodings: Sequence[str] = ENCODINGS,
    string_cols: Sequence[str] = IDENTIFIERS,
    path_column: str | None = None,
) -> DataFrame:
    """CSV with null tokens, encoding fall-back and identifiers kept as strings.

    Several files are united by the names in their headers, with one scan per different header, whatever the order
    of the columns; a column that a file lacks is NULL. Quoted values may span lines. ``path_column`` adds the
    file a row comes from.

    ``types`` names the target types (no further pass; an empty mapping leaves all columns strings). Without it
    they are inferred from the whole file. A file takes the first encoding in which none of its values shows a decoding error
    (ISO-8859-1 accepts every byte, so none after it is reached); pass a single encoding to skip that pass.
    """
    paths = [path] if isinstance(path, str) else list(path)
    layouts = csv_layouts(spark, paths) or [(paths, False)]
    if len(layouts) == 1:
        layouts = [(paths, layouts[0][1])]
    frames = [_decoded_csv(spark, group, encodings, spans) for group, spans in layouts]
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    raw = raw.select(*[F.col(f"`{c}`") for c in raw.columns if c != FILE], *([F.col(FILE).alias(path_column)] if path_column else []))

    def cleaned(name: str) -> Column:
        value = F.col(f"`{name}`")
        if name == path_column:
            return F.regexp_replace(value, r"/part-[^/]*$", "").alias(name)
        return F.when(value.isin(list(nulls)), None).otherwise(value).alias(name)

    text = raw.select(*[cleaned(c) for c in raw.columns])
    if types is None:
        return with_inferred_types(text, [*string_cols, *([path_column] if path_column else [])])
    return text.select(
        *[
            F.col(c).try_cast(types[c]).alias(c) if c in types and c not in string_cols else F.col(c)
            for c in text.columns
        ]
    )


def read_file(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """One Parquet or CSV file (or folder), the format by suffix."""
    fmt = fmt or file_format(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        return read_csv(spark, path)
    raise ValueError(f"unsupported file format: {fmt}")


def source_path() -> Column:
    """Path of the file a row comes from, without Spark's own part file names."""
    return F.regexp_replace("_metadata.file_path", r"/part-[^/]*$", "")
