"""Hot keys: a third of all rows under one key must not end in one task, and results stay the same."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kohortflow.functions.codes import icd_range_join, parse_code_list, severe_chronic_list
from kohortflow.operators import aggregates as ag
from kohortflow.operators.cohort import exact_match, outcome_by_period, rank_in_strata
from kohortflow.operators.joins import full_outer_merge
from kohortflow.operators.quality import iqr_outliers

N = 60_000


def hot(spark, extra):
    """Rows of which a third share key 0, with distinct payloads."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1)
    return spark.range(N).repartition(8).select(key.alias("k"), F.col("id").alias(extra))


@pytest.fixture
def small_skew_settings(spark):
    """AQE thresholds at test size, broadcast off, so that joins shuffle as they would with large tables."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_full_outer_merge_splits_the_hot_key(spark, small_skew_settings):
    a, b = hot(spark, "x"), spark.range(6000).repartition(8).select(F.col("id").alias("k"), F.col("id").alias("y"))
    merged = full_outer_merge([a, b], ["k"])
    assert "skew=true" in final_plan(merged)
    assert "FullOuter" not in final_plan(merged)
    assert rows(merged, "k", "x", "y") == rows(a.join(b, "k", "full"), "k", "x", "y")


def test_latest_per_key_combines_before_the_shuffle(spark, small_skew_settings):
    df = hot(spark, "x")
    out = ag.latest_per_key(df, ["k"], [F.col("x")])
    plan = final_plan(out)
    assert "partial_max_by" in plan and "Window" not in plan
    assert rows(out, "k", "x") == rows(df.groupBy("k").agg(F.max("x").alias("x")))


def test_quantiles_of_one_group_move_few_rows(spark, small_skew_settings):
    df = spark.range(200_000).select((F.col("id") < 0).cast("int").alias("g"), (F.xxhash64("id") % 10_000_000 / 7).alias("v"))
    probs = {"a": 0.25, "b": 0.5, "c": 0.75}
    out = ag.group_quantiles(df, ["g"], "v", probs)
    want = df.agg(F.percentile("v", F.lit(list(probs.values())))).first()[0]
    assert list(out.first())[1:] == pytest.approx(want)
    plan = final_plan(out)
    assert re.search(r"hashpartitioning\(g#\d+, __n#\d+L?, __stretch#\d+, __single#\d+", plan)
    assert " percentile(" not in plan


@pytest.mark.parametrize("run", [
    lambda df: ag.group_quantiles(df, ["g"], "v", {"m": 0.5}),
    lambda df: ag.group_summary(df, "g", ["v"]).select("g", "median"),
    lambda df: ag.box_stats(df, "g", "v").select("g", "median"),
    lambda df: iqr_outliers(df, ["v"]).select("n_outliers"),
])
def test_rows_of_a_large_group_are_not_shuffled(spark, small_skew_settings, run):
    df = spark.range(0, 300_000, 1, 8).select((F.col("id") < 0).cast("int").alias("g"), (F.xxhash64("id") % 10_000_000 / 7).alias("v"))
    out = run(df)
    assert len(out.collect()) == 1
    joins = re.findall(r"\w+Join [^\n]*__k_\w+#[^\n]*", final_plan(out))
    assert joins and not [j for j in joins if "SortMergeJoin" in j or "Shuffled" in j]


def test_quantiles_with_large_small_and_null_groups(spark, monkeypatch):
    monkeypatch.setattr(ag, "LARGE_GROUP", 50)
    data = [(None if i % 5 == 0 else "a" if i % 5 < 4 else f"s{i % 3}", float(i * 7919 % 1009)) for i in range(400)] + [("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    want = df.where("v IS NOT NULL").groupBy("g").agg(F.percentile("v", F.lit(0.25)), F.percentile("v", F.lit(0.5)))
    got = ag.group_quantiles(df, ["g"], "v", {"q": 0.25, "m": 0.5})
    assert [(r[0], pytest.approx(r[1:])) for r in rows(got)] == [(r[0], r[1:]) for r in rows(want)]


def test_rank_sorts_a_stratum_in_slices(spark, small_skew_settings):
    df = spark.range(20_000).select((F.col("id") < 0).cast("int").alias("s"), F.col("id"), (F.xxhash64("id") % 997).alias("h"))
    df = df.withColumn("u", F.abs("h") / 997)
    plan = final_plan(rank_in_strata(df, ["s"], F.col("u"), "id", "r"))
    assert re.search(r"hashpartitioning\(s#\d+, __slice#\d+", plan)


def test_match_grows_with_the_pool_not_with_the_pairs(spark):
    exposed = spark.range(2000).select(F.lit("2001-01-01").cast("date").alias("birth_date"), F.lit("2002-01-01").cast("date").alias("index_date"))
    pool = spark.range(2000).select(F.lit("2001-01-01").cast("date").alias("birth_date"), F.col("id").cast("string").alias("child_id"), F.lit("F").alias("family_id"))
    out = exact_match(exposed, pool)
    assert out.count() == 2000
    assert out.agg(F.sum("n_exposed")).first()[0] == 2000 * 2000


def test_range_join_is_a_hash_join_with_and_without_broadcast(spark, small_skew_settings):
    ranges = parse_code_list(severe_chronic_list(spark))
    df = spark.range(5000).select(F.concat(F.lit("G"), F.lpad((F.col("id") % 100).cast("string"), 2, "0")).alias("code"))
    plan = final_plan(icd_range_join(df, "code", ranges))
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_child_is_split_although_an_aggregation_follows(spark, small_skew_settings):
    exposed = spark.range(6000).select(F.col("id").alias("child_id"), F.lit("2001-01-01").cast("date").alias("index_date"))
    events = hot(spark, "v").select("k", F.date_add(F.lit("2001-01-01").cast("date"), (F.col("v") % 900).cast("int")).alias("d"), "v")
    out = outcome_by_period(exposed, events, "k", "d", "v", {"one": 1, "five": 5})
    plan = final_plan(out)
    assert "skew=true" in plan
    want = events.where("datediff(d, DATE '2001-01-01') <= 365").groupBy("k").agg(F.sum("v").alias("s"))
    assert rows(out.where("n_one > 0"), "child_id", "sum_one") == rows(want, "k", "s")
