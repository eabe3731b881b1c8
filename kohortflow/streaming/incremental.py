"""Resumable ingest as a file stream."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kohortflow.sources.files import source_path
from kohortflow.sources.ingest import file_stem, register_name, register_year


def incremental_ingest(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: StructType, max_files: int = 1000
) -> None:
    """Append the files that arrived since the last run, each once, partitioned by register and year.

    The checkpoint holds the list of finished files and the sink's log the finished batches, so a run that is
    stopped or loses executors continues where it was.
    """
    stem = file_stem(F.col("source_path"))
    files = (
        spark.readStream.format("parquet")
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .load(in_dir)
        .select("*", source_path().alias("source_path"))
    )
    query = (
        files.withColumn("register", register_name(stem))
        .withColumn("year", register_year(stem))
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .partitionBy("register", "year")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
