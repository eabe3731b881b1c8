"""Session helper and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "kohortflow", cores: int | str = 8, **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster job brings its own session."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("KOHORTFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings for wide projections and hot keys, on a session that was made elsewhere.

    The JVM never compiles a method above 8,000 bytes of bytecode, so a stage fused beyond that runs
    interpreted. With the limit Spark splits such a stage into smaller compiled pieces. By default AQE leaves a skewed join alone when an aggregation on the same key follows,
    because splitting costs that aggregation a shuffle of its own; for a hot key that shuffle, of partial
    results, is by far the smaller price. Equal rows either way.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared scratch folder and read back.

    Columnar, free of the plan behind it, and as durable as the folder.
    """
    path = f"{scratch_dir(df.sparkSession, 'step')}/data"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach: below ``spark.checkpoint.dir`` where that is set.

    Without the setting a temporary folder is used, which is only right when driver and executors are one
    process, so any other master is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    return tempfile.mkdtemp(prefix=f"{label}-")
