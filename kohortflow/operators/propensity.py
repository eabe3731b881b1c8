"""Propensity score matching with a caliper."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kohortflow.operators.cohort import rank_in_strata
from kohortflow.session import cut_lineage


def propensity_logit(df: DataFrame, treated: str, features: Sequence[str]) -> DataFrame:
    """``df`` with ``logit``, the log odds of ``treated`` from a logistic regression on the features."""
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="__x"),
            LogisticRegression(  # standardises the features itself
                featuresCol="__x", labelCol=treated, rawPredictionCol="__margin", maxIter=25, regParam=1e-4
            ),
        ]
    ).fit(df)
    scored = model.transform(df).withColumn("logit", F.get(vector_to_array("__margin"), F.lit(1)))
    return scored.select(*df.columns, "logit")


def _pair_in_bins(df: DataFrame, treated: str, key: str, position: Column) -> DataFrame:
    """k-th treated with k-th control of each caliper-wide bin.

    Both are numbered in hash order, not score order: any two rows of a bin are close enough, and a hash still
    spreads a bin over many tasks when most of its rows have the same score.
    """
    binned = df.withColumn("__bin", F.floor(position))
    draw = F.shiftrightunsigned(F.xxhash64(key), 11).cast("double") / F.lit(float(2**53))
    sides = [
        rank_in_strata(
            binned.where(F.col(treated) == flag).select("__bin", key, "logit"),
            ["__bin"],
            draw,
            key,
            "__k",
        )
        for flag in (1, 0)
    ]
    cases = sides[0].select("__bin", "__k", F.col(key).alias("exposed_id"), F.col("logit").alias("exposed_logit"))
    controls = sides[1].select("__bin", "__k", F.col(key).alias("control_id"), F.col("logit").alias("control_logit"))
    return cases.join(controls, ["__bin", "__k"]).drop("__bin", "__k")


def caliper_match(scored: DataFrame, treated: str, key: str, caliper: float = 0.2) -> DataFrame:
    """1:1 matches no further apart than ``caliper`` standard deviations of the logit.

    Bins as wide as the caliper guarantee the distance, so a match is an equi join on bin and rank. Those left
    over are tried once more in bins shifted by half a width, which reaches across the first bins' edges.
    """
    scored = cut_lineage(scored.select(key, treated, "logit"))  # read six times below
    width = F.lit(caliper) * scored.agg(F.stddev_samp("logit")).scalar()
    position = F.col("logit") / F.when(width > 0, width).otherwise(1.0)
    first = cut_lineage(_pair_in_bins(scored, treated, key, position))
    used = first.select(F.explode(F.array("exposed_id", "control_id")).alias(key))
    rest = scored.join(used, key, "left_anti")
    return first.unionByName(_pair_in_bins(rest, treated, key, position + 0.5))
