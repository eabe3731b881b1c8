"""Sources, sinks, ingest and the history of families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.checks.registry import check
from kohortflow.checks.roles import Tables
from kohortflow.plans.history import family_history
from kohortflow.session import cut_lineage, scratch_dir
from kohortflow.sources import ingest
from kohortflow.sources.files import NULL_TOKENS, read_csv, read_file
from kohortflow.sources.registers import read_register
from kohortflow.streaming.incremental import incremental_ingest


def by_year(t: Tables) -> DataFrame:
    return t["orders"].withColumn("year", F.year("o_orderdate"))


def write_files(df: DataFrame, name: str, folder: str) -> None:
    """One Parquet folder per value of the column ``name``, called like the value."""
    df.write.partitionBy(name).parquet(folder)
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        called = status.getPath().getName()
        if called.startswith(f"{name}="):
            fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path, called.split("=", 1)[1]))


def yearly_files(t: Tables, pattern: str, label: str) -> str:
    """Orders written as one file set per period; ``pattern`` is a date format."""
    folder = scratch_dir(t.spark, label) + "/files"
    write_files(t["orders"].withColumn("name", F.date_format("o_orderdate", pattern)), "name", folder)
    return folder


@check(
    "read_register",
    "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS year FROM orders",
)
def _(t):
    folder = yearly_files(t, "'ord_'yyyy'.parquet'", "register")
    return read_register(t.spark, folder, "ord_{year}.parquet").select("o_orderkey", "o_totalprice", "year")


@check(
    "read_register_month",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month
       FROM orders""",
)
def _(t):
    folder = yearly_files(t, "'bef'yyyyMM'.parquet'", "register_month")
    return read_register(t.spark, folder, "bef{yearmonth}.parquet", month="*").select(
        "o_orderkey", "year", "month"
    )


@check(
    "read_file",
    """SELECT 'parquet' AS fmt, p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part
       UNION ALL SELECT 'csv', p_partkey, p_name, p_size, p_retailprice FROM part""",
)
def _(t):
    path = scratch_dir(t.spark, "file") + "/part.csv"
    columns = ["p_partkey", "p_name", "p_size", "p_retailprice"]
    t["part"].select(*columns).write.option("header", True).csv(path)
    source = f"{t.folder}/part.parquet"
    return (
        read_file(t.spark, source).select(F.lit("parquet").alias("fmt"), *columns)
        .withColumn("p_size", F.col("p_size").cast("bigint"))
        .unionByName(read_file(t.spark, path).select(F.lit("csv").alias("fmt"), *columns))
    )


@check(
    "csv_null_tokens",
    """SELECT CAST(c_custkey AS VARCHAR) AS PNR,
              CASE WHEN c_custkey % 9 >= 7 THEN c_mktsegment END AS segment,
              CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS balance,
              CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS nation
       FROM customer""",
)
def _(t):
    path = scratch_dir(t.spark, "nulls") + "/customer.csv"
    token = F.get(F.array(*[F.lit(n) for n in NULL_TOKENS]), (F.col("c_custkey") % 9).cast("int"))
    t["customer"].select(
        F.col("c_custkey").alias("PNR"),
        F.when(F.col("c_custkey") % 9 < 7, token).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 5 == 0, "NA").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(F.col("c_custkey") % 4 == 0, "null").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
    ).write.option("header", True).csv(path)
    return read_csv(t.spark, path)


INGESTED = """
    SELECT 'ord' AS register, CAST(year(o_orderdate) AS INT) AS year, count(*) AS n_rows,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY year(o_orderdate)"""


def totals(df: DataFrame, register) -> DataFrame:
    return df.groupBy(register, F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@check("ingest_registers", INGESTED + " UNION ALL SELECT 'kunder', NULL, count(*), NULL FROM customer")
def _(t):
    folder = yearly_files(t, "'ORD_'yyyy'.parquet'", "ingest")
    t["customer"].write.option("header", True).csv(f"{folder}/Kunder.csv")
    out = scratch_dir(t.spark, "ingested")
    names = ingest.ingest_registers(t.spark, folder, out)
    if names != ["kunder", "ord"]:
        raise ValueError(f"unexpected registers {names}")
    read = t.spark.read.parquet
    customers = read(f"{out}/registers/kunder").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("kunder").alias("register"),
        F.lit(None).cast("int").alias("year"),
        "n_rows",
        F.lit(None).cast("double").alias("total"),
    )
    return totals(read(f"{out}/registers/ord"), F.lit("ord").alias("register")).unionByName(customers)


@check(
    "tables_equal",
    """SELECT true AS same_schema, a.n AS n_only_a, b.n AS n_only_b, a.n = 0 AND b.n = 0 AS equal
       FROM (SELECT count(*) AS n FROM (SELECT l_orderkey, l_partkey FROM lineitem EXCEPT ALL
             SELECT l_orderkey, CASE WHEN l_orderkey % 10 = 0 THEN l_partkey + 1 ELSE l_partkey END FROM lineitem)) a,
            (SELECT count(*) AS n FROM (
             SELECT l_orderkey, CASE WHEN l_orderkey % 10 = 0 THEN l_partkey + 1 ELSE l_partkey END FROM lineitem
             EXCEPT ALL SELECT l_orderkey, l_partkey FROM lineitem)) b""",
)
def _(t):
    a = t["lineitem"].select("l_orderkey", "l_partkey")
    shift = F.when(F.col("l_orderkey") % 10 == 0, F.col("l_partkey") + 1).otherwise(F.col("l_partkey"))
    return ingest.tables_equal(a, a.withColumn("l_partkey", shift))


@check(
    "ingest_summary",
    """SELECT 'ord' AS register, CAST(year(o_orderdate) AS INT) AS year,
              concat('ord_', CAST(year(o_orderdate) AS VARCHAR), '.parquet') AS file_name, count(*) AS num_rows,
              6 AS num_columns,
              ['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority'] AS column_names
       FROM orders GROUP BY year(o_orderdate)""",
)
def _(t):
    folder, out = yearly_files(t, "'ord_'yyyy'.parquet'", "summary_in"), scratch_dir(t.spark, "summary_out")
    ingest.ingest_registers(t.spark, folder, out)
    return ingest.manifest_summary(ingest.read_manifest(t.spark, out))


@check(
    "csv_by_header",
    """SELECT CAST(c_custkey AS VARCHAR) AS PNR, c_mktsegment || chr(10) || '"x", y' AS segment,
              CASE WHEN c_custkey % 3 <> 2 THEN c_acctbal END AS balance
       FROM customer""",
)
def _(t):
    """Three files of one table: the columns in two orders, one of them missing a column."""
    folder = scratch_dir(t.spark, "headers")
    segment = F.concat("c_mktsegment", F.lit('\n"x", y')).alias("segment")
    df = t["customer"].select(F.col("c_custkey").cast("string").alias("PNR"), segment, F.col("c_acctbal").alias("balance"), "c_custkey")
    for k, columns in enumerate((["PNR", "segment", "balance"], ["balance", "PNR", "segment"], ["segment", "PNR"])):
        df.where(F.col("c_custkey") % 3 == k).select(*columns).write.option("header", True).option("escape", '"').csv(f"{folder}/{k}.csv")
    return read_csv(t.spark, [f"{folder}/{k}.csv" for k in range(3)])


@check(
    "ingest_manifest",
    """SELECT 'ord_' || CAST(year(o_orderdate) AS VARCHAR) || '.parquet' AS file_name, 'written' AS status,
              count(*) * (CASE WHEN year(o_orderdate) = 1995 THEN 2 ELSE 1 END) AS n_rows, year(o_orderdate) = 1995 AS rewritten
       FROM orders GROUP BY year(o_orderdate)""",
)
def _(t):
    """A second run after one file has changed: only its year is written again."""
    folder, out = yearly_files(t, "'ord_'yyyy'.parquet'", "manifest_in"), scratch_dir(t.spark, "manifest_out")
    ingest.ingest_registers(t.spark, folder, out)
    target = f"{out}/registers/ord"
    stamp = F.col("_metadata.file_modification_time")

    def written():
        return t.spark.read.parquet(target).groupBy("source_file").agg(F.max(stamp).alias("at"))

    first = cut_lineage(written())
    year = t["orders"].where(F.year("o_orderdate") == 1995)
    year.unionAll(year).write.mode("overwrite").parquet(f"{folder}/ord_1995.parquet")
    ingest.ingest_registers(t.spark, folder, out)
    rewritten = first.join(written().withColumnRenamed("at", "now"), "source_file").select("source_file", (F.col("now") > F.col("at")).alias("rewritten"))
    manifest = ingest.read_manifest(t.spark, out).select(F.regexp_replace("path", "^.*/", "").alias("source_file"), "status", "n_rows")
    return manifest.join(rewritten, "source_file").select(F.col("source_file").alias("file_name"), "status", "n_rows", "rewritten")


@check("incremental_ingest", INGESTED)
def _(t):
    folder = yearly_files(t, "'ORD_'yyyy'.parquet'", "stream_in")
    out, checkpoint = scratch_dir(t.spark, "stream_out"), scratch_dir(t.spark, "stream_state")
    schema = t["orders"].schema
    incremental_ingest(t.spark, folder, out, checkpoint, schema)
    incremental_ingest(t.spark, folder, out, checkpoint, schema)  # a second run finds nothing new
    return totals(t.spark.read.parquet(out), "register")


@check("safe_write", "SELECT * FROM events")
def _(t):
    path = scratch_dir(t.spark, "safe") + "/events"
    ingest.safe_write(t["events"], path)
    return t.spark.read.parquet(path)


@check("materialise", "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey")
def _(t):
    path = scratch_dir(t.spark, "steps")
    step = t["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    ingest.materialise(step, path, "orders-v1")
    return ingest.materialise(step, path, "orders-v1")


@check(
    "family_history",
    """SELECT o_custkey AS person_id, CAST(year(o_orderdate) AS INT) AS year,
              concat('F', CAST(max(o_orderkey) AS VARCHAR)) AS family_id
       FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
                      OR (o_orderpriority = '3-MEDIUM' AND o_custkey % 40 >= 18)
       GROUP BY o_custkey, year(o_orderdate)""",
)
def _(t):
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "divorce")
        .when(F.col("o_orderpriority") == "2-HIGH", "death")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "child_moving_out")
        .otherwise("none")
    )
    events = t["orders"].select(
        F.col("o_custkey").alias("person_id"),
        F.year("o_orderdate").alias("year"),
        kind.alias("event_type"),
        (F.col("o_custkey") % 40).alias("age"),
        F.col("o_orderkey").alias("event_id"),
    )
    return family_history(events)
