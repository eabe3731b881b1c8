"""Raw register files to partitioned Parquet, with verification and a summary."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kohortflow.sources.files import read_csv, source_path
from kohortflow.sources.registers import union_registers

PATH = "__path"


class VerificationError(ValueError):
    """Written data differs from its source."""


# Fixed value: register name followed by the period digits.
NAME_PATTERN = r"^([a-zA-Z_]+)(\d+)"


def file_stem(path: Column) -> Column:
    """Last path segment without its suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def register_name(stem: Column) -> Column:
    """Lower-case register name; a stem without period digits is the name as a whole."""
    named = F.regexp_extract(stem, NAME_PATTERN, 1)
    return F.when(named != "", F.rtrim(F.lower(named), F.lit("_"))).otherwise(F.lower(stem))


def register_year(stem: Column) -> Column:
    """Period digits, empty when there are none."""
    return F.regexp_extract(stem, NAME_PATTERN, 2)


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet and CSV files below a folder: path, size, last change, register, year. Only names are read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{parquet,csv}")
        .load(folder)
        .select(F.regexp_replace("path", r"/part-[^/]*$", "").alias("path"), "length", "modificationTime")
    )
    stem = file_stem(F.col("path"))
    return files.groupBy("path").agg(F.sum("length").alias("n_bytes"), F.max("modificationTime").alias("modified")).select(
        "path", "n_bytes", F.unix_micros("modified").alias("modified"), register_name(stem).alias("register"), register_year(stem).alias("year")
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet and CSV files below a folder: path, size, register, year. Only names are read."""
    return _listing(spark, folder).drop("modified")


MANIFEST = (
    "register string, year string, path string, n_bytes bigint, modified bigint, status string, error string, "
    "n_rows bigint, h64 decimal(38,0), h32 bigint, columns array<string>, types string"
)
FILE_FAILED, FILE_WRITTEN = "failed", "written"


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """The last committed state of an ingest folder, one row per input file."""
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest/version={_version(spark, out_dir)}")


def _filesystem(spark: SparkSession, path: str) -> tuple:
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _version(spark: SparkSession, out_dir: str) -> int:
    """Number of the last manifest that was committed, 0 for none."""
    fs, to_path = _filesystem(spark, out_dir)
    found = fs.globStatus(to_path(f"{out_dir}/manifest/version=*/_SUCCESS")) or []
    return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found), default=0)


def _common_type(kinds: set[str]) -> str:
    """One type for a column that files hold under several: the wider number, otherwise text."""
    whole = {"tinyint", "smallint", "int", "bigint"}
    if len(kinds) == 1:
        return next(iter(kinds))
    if kinds <= whole:
        return "bigint"
    return "double" if kinds <= whole | {"float", "double"} else "string"


def _parquet_by_schema(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One scan if the files' schemas merge; otherwise one per schema, columns brought to a common type."""
    try:
        df = spark.read.option("mergeSchema", "true").parquet(*paths)
        return df.select("*", source_path().alias(PATH))
    except (PySparkException, Py4JJavaError):  # schemas that do not merge surface as either
        pass
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    frames = [spark.read.parquet(*group).select("*", source_path().alias(PATH)) for group in groups.values()]
    kinds: dict[str, set[str]] = {}
    for df in frames:
        for name, kind in df.dtypes:
            kinds.setdefault(name, set()).add(kind)
    return union_registers([df.select(*[F.col(f"`{c}`").cast(_common_type(kinds[c])).alias(c) for c in df.columns]) for df in frames])


def _register_frame(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files of a register as one table with their path, ``source_file`` and ``year``."""
    csv = [p for p in paths if p.lower().endswith(".csv")]
    parquet = [p for p in paths if p not in set(csv)]
    frames = [_parquet_by_schema(spark, parquet)] if parquet else []
    if csv:
        frames.append(read_csv(spark, csv, path_column=PATH))
    if len(frames) == 2:  # types of one register agree over its formats
        kinds = [dict(f.dtypes) for f in frames]
        frames = [f.select(*[F.col(f"`{c}`").cast(_common_type({k[c] for k in kinds if c in k})).alias(c) for c in f.columns]) for f in frames]
    table = union_registers(frames)
    taken = {c.lower() for c in table.columns}
    names = {}
    for c in table.columns:
        if c.lower() in ("year", "source_file"):
            own = f"source_{c.lower()}"
            while own in taken:
                own += "_"
            taken.add(own)
            names[c] = own
    return table.select(
        *[F.col(f"`{c}`").alias(names.get(c, c)) for c in table.columns if c != PATH],
        PATH,
        F.regexp_replace(PATH, "^.*/", "").alias("source_file"),
        register_year(file_stem(F.col(PATH))).alias("year"),
    )


def _types(df: DataFrame) -> str:
    return json.dumps({name: kind for name, kind in df.dtypes if name not in (PATH, "source_file", "year")}, sort_keys=True)


def _by_file(df: DataFrame, key: str) -> dict[str, tuple]:
    """Content digest of each file's rows, by path or by name; one row per file."""
    content = df.drop(PATH, "year")
    return {r[key]: (r.n, r.h64, r.h32) for r in df.groupBy(key).agg(*_digest(content)).toLocalIterator()}


def _by_name(digests: dict[str, tuple]) -> dict[str, tuple]:
    """Digests by path as digests by file name; they are sums, so files of one name add up."""
    out: dict[str, tuple] = {}
    for path, digest in digests.items():
        name = path.rsplit("/", 1)[-1]
        out[name] = tuple(a + b for a, b in zip(out[name], digest, strict=True)) if name in out else digest
    return out


def _staged(df: DataFrame, path: str) -> DataFrame:
    """The table as written to a folder by year."""
    out = df.drop(PATH)
    out.write.partitionBy("year").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def _replace_years(spark: SparkSession, staging: str, target: str) -> None:
    """Move the staged year folders over those of the target."""
    fs, to_path = _filesystem(spark, target)
    fs.mkdirs(to_path(target))
    for status in fs.globStatus(to_path(f"{staging}/year=*")) or []:
        source = status.getPath()
        goal = to_path(f"{target}/{source.getName()}")
        if fs.exists(goal) and not fs.delete(goal, True):
            raise OSError(f"could not replace {goal}")
        if not fs.rename(source, goal):
            raise OSError(f"could not move {source} to {goal}")


def _ingest_register(spark: SparkSession, name: str, files: list[dict], out_dir: str) -> list[dict]:
    """Write the given files' years of one register, verified file by file; returns their manifest rows."""
    df = _register_frame(spark, [f["path"] for f in files])
    staging = f"{out_dir}/.staging-{uuid.uuid4().hex}"
    fs, to_path = _filesystem(spark, staging)
    try:
        source = _by_file(df, PATH)
        copy, wanted = _by_file(_staged(df, staging), "source_file"), _by_name(source)
        if copy != wanted:
            bad = sorted(f for f in wanted.keys() | copy.keys() if wanted.get(f) != copy.get(f))
            raise VerificationError(f"verification failed for {name}: {', '.join(bad)}")
        _replace_years(spark, staging, f"{out_dir}/registers/{name}")
    finally:
        fs.delete(to_path(staging), True)
    kinds = _types(df)
    columns = [c for c in df.columns if c not in (PATH, "source_file", "year")]
    rows = []
    for f in files:
        n, h64, h32 = source.get(f["path"], (0, None, None))
        rows.append(f | {"status": FILE_WRITTEN, "error": None, "n_rows": n, "h64": h64, "h32": h32, "columns": columns, "types": kinds})
    return rows


def _readable(spark: SparkSession, files: list[dict]) -> tuple[list[dict], list[dict]]:
    """Files that can be read to their end, and manifest rows of those that cannot."""
    good, bad = [], []
    for f in files:
        try:
            _by_file(_register_frame(spark, [f["path"]]), PATH)
            good.append(f)
        except Exception as error:  # noqa: BLE001 - whatever a file's content makes a reader raise is recorded
            bad.append(f | {"status": FILE_FAILED, "error": str(error)[:500]})
    return good, bad


def ingest_registers(spark: SparkSession, in_dir: str, out_dir: str) -> list[str]:
    """Every register below ``in_dir`` as ``out_dir/registers/<name>/year=<year>``; returns the names.

    A manifest keeps size, time of change and content digest of every input file. Files it knows as they are and whose
    year is there are skipped; a year with a new or changed file is written anew from all its files, and the register
    as a whole if a column's type has changed by that. Data is written aside, read back and compared with its source by a
    digest per file before it takes a year's place; a difference raises ``VerificationError`` and leaves
    the target as it was. The manifest is committed as a new version once every register is done, so a stopped run is repeated.
    A file that cannot be read is recorded as failed, its year left as it was, and the rest goes on. Years whose files are gone stay.

    The listing (names only, one row per file) is brought to the driver; the data never is. Files of one register are
    one scan per schema or header. Columns ``year`` and ``source_file`` of the files, in any case, become
    ``source_year`` and ``source_source_file``, with underscores after it if they have that too.
    """
    files = [r.asDict() for r in _listing(spark, in_dir).toLocalIterator()]
    version = _version(spark, out_dir)
    known = {r.path: r.asDict() for r in read_manifest(spark, out_dir).toLocalIterator()} if version else {}
    fs, to_path = _filesystem(spark, out_dir)
    done, changed = dict(known), False
    names = sorted({f["register"] for f in files})
    for name in names:
        own = [f for f in files if f["register"] == name]
        target = f"{out_dir}/registers/{name}"

        def current(f: dict, target: str = target) -> bool:
            old = known.get(f["path"])
            if not old or (old["n_bytes"], old["modified"]) != (f["n_bytes"], f["modified"]):
                return False
            folder = f"{target}/year={f['year'] or '__HIVE_DEFAULT_PARTITION__'}"
            return old["status"] == FILE_FAILED or not old["n_rows"] or fs.exists(to_path(folder))

        years = {f["year"] for f in own if not current(f)}
        if not years:
            continue
        changed = True
        broken: set[str] = set()
        pending = [f for f in own if f["year"] in years]
        try:
            rows = _ingest_years(spark, name, own, pending, known, out_dir)
        except VerificationError:
            raise
        except Exception:  # noqa: BLE001 - find the files at fault, let the other years go on
            good, failed = _readable(spark, own)
            broken = {f["year"] for f in failed}
            done |= {f["path"]: f for f in failed}
            pending = [f for f in good if f["year"] in years - broken]
            rows = _ingest_years(spark, name, [f for f in good if f["year"] not in broken], pending, known, out_dir) if pending else []
        done |= {r["path"]: r for r in rows}
    if changed:
        fields = [f.split()[0] for f in MANIFEST.split(", ")]
        table = spark.createDataFrame([tuple(r.get(c) for c in fields) for r in done.values()], MANIFEST)
        table.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/manifest/version={version + 1}")
    return [n for n in names if any(r["register"] == n and r["status"] == FILE_WRITTEN for r in done.values())]


def _ingest_years(spark: SparkSession, name: str, own: list[dict], pending: list[dict], known: dict, out_dir: str) -> list[dict]:
    """The pending years, or all of them if the types of shared columns differ from those already written."""
    old = [json.loads(r["types"]) for r in known.values() if r["register"] == name and r["types"]]
    if old and len(pending) < len(own):
        kinds = json.loads(_types(_register_frame(spark, [f["path"] for f in pending])))
        if any(kinds[c] != before[c] for before in old for c in kinds.keys() & before.keys()):
            pending = own
    return _ingest_register(spark, name, pending, out_dir)


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Per ingested file: register, year, name, rows, number and names of the columns; the data is not read again."""
    return manifest.where(F.col("status") == FILE_WRITTEN).select(
        "register",
        F.expr("try_cast(year AS int)").alias("year"),
        F.regexp_replace("path", "^.*/", "").alias("file_name"),
        F.col("n_rows").alias("num_rows"),
        F.size("columns").alias("num_columns"),
        F.col("columns").alias("column_names"),
    )


def write_summary(spark: SparkSession, out_dir: str) -> str:
    """The summary by file as JSON lines in ``out_dir/summary``; returns the folder."""
    path = f"{out_dir.rstrip('/')}/summary"
    manifest_summary(read_manifest(spark, out_dir)).orderBy("register", "year", "file_name").coalesce(1).write.mode("overwrite").json(path)
    return path


def ingest_summary(df: DataFrame, register: str, file: str, year: str = "year") -> DataFrame:
    """Per year of an ingested register: file, rows, number and names of the columns."""
    names = [c for c in df.columns if c not in (file, year)]
    return (
        df.groupBy(F.col(year).alias("year"))
        .agg(F.min(file).alias("file_name"), F.count(F.lit(1)).alias("num_rows"))
        .select(
            F.lit(register).alias("register"),
            "year",
            "file_name",
            "num_rows",
            F.lit(len(names)).alias("num_columns"),
            F.array(*[F.lit(n) for n in names]).alias("column_names"),
        )
    )


def tables_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: do two tables hold the same rows (any order, with duplicates) and the same schema?

    Both sides are counted per distinct row with opposite sign in one shuffle; duplicates combine in the map
    tasks. Columns are compared by name.
    """
    kinds_a, kinds_b = dict(a.dtypes), dict(b.dtypes)
    same_schema = kinds_a == kinds_b
    names = sorted(set(kinds_a) & set(kinds_b))
    sides = a.select(*names, F.lit(1).alias("__side")).unionByName(b.select(*names, F.lit(-1).alias("__side")))
    balance = sides.groupBy(*names).agg(F.sum("__side").alias("__d"), F.count(F.lit(1)).alias("__n"))
    only_a = F.coalesce(F.sum(F.greatest("__d", F.lit(0))), F.lit(0)).cast("bigint")
    only_b = F.coalesce(F.sum(F.greatest(-F.col("__d"), F.lit(0))), F.lit(0)).cast("bigint")
    return balance.agg(only_a.alias("n_only_a"), only_b.alias("n_only_b")).select(
        F.lit(same_schema).alias("same_schema"),
        "n_only_a",
        "n_only_b",
        (F.lit(same_schema) & (F.col("n_only_a") == 0) & (F.col("n_only_b") == 0)).alias("equal"),
    )


def _digest(df: DataFrame) -> list[Column]:
    """Order-independent content digest: row count and two independent hash sums."""
    names = sorted(df.columns)
    # hashes skip NULLs, so where they are is hashed too
    parts = [p for c in names for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    wide = F.xxhash64(*parts).cast("decimal(38,0)")
    narrow = F.hash(*parts).cast("bigint")
    return [F.count(F.lit(1)).alias("n"), F.sum(wide).alias("h64"), F.sum(narrow).alias("h32")]


def safe_write(df: DataFrame, path: str) -> None:
    """Write to a staging folder, read back, compare content, then take the target's place.

    Source and copy are each reduced to a digest, without a shuffle of rows. A failed comparison leaves the
    existing target untouched.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.write.parquet(staging)
    back = spark.read.parquet(staging)
    digest = back.agg(*_digest(back)).first().asDict()
    source_digest = df.agg(*_digest(df)).first().asDict()
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(staging), hadoop.Path(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if digest != source_digest:
        fs.delete(source, True)
        raise ValueError(f"verification failed: data written for {path} does not match its source")
    old = hadoop.Path(f"{staging}.old")
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(source, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"could not move {staging} to {path}")
    if replaced:
        fs.delete(old, True)


def materialise(df: DataFrame, path: str, fingerprint: str) -> DataFrame:
    """Step result stored under a caller-given fingerprint of its inputs; an existing one is read back."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/{fingerprint}"
    try:
        spark.read.text(f"{target}/_SUCCESS")  # left by the commit of a complete write only
    except AnalysisException:
        df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
