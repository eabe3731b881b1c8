"""Helpers shared by the operators: words, batches for Python tasks, cutting lineage, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kohortflow.session import cut_lineage

#: A word is a run of anything but these six ASCII characters, which are also what
#: ``bytes.split()`` splits at.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of one Arrow batch, as the texts of a batch are in a Python worker's memory together."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer referenced.

    Its cleaner acts when the driver's JVM collects garbage, which a driver with little to do may not for long.
    """
    spark.sparkContext._jvm.System.gc()


def connected(links: DataFrame) -> DataFrame:
    """Smallest id reachable from each id of ``links`` (a, b), as (id, component); an id that is the smallest has no row.

    Alternating large-star and small-star steps: every step is two aggregations, links never grow in number,
    and a chain of n links takes about log n rounds. An id with very many links is pre-aggregated in the map
    tasks (``min``) and its join is one that AQE splits. Each round is a table in the shared folder. It is the last one
    when all links are stars, which the number of ids that are not at the end of a single link tells; this number
    is the only thing the driver sees.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        # large star: neighbours above u link to the smallest of u's neighbourhood
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its lower neighbours link to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.where("u <> v").distinct())
        ends = edges.selectExpr("u AS id", "1 AS up", "0 AS down").union(edges.selectExpr("v", "0", "1"))
        ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.where("up > 1 OR up = 1 AND down = 1").count():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
