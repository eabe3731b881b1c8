"""Physical plans of the registered queries."""

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
# writes and fits run while the query is built; their plans are checked through the operators they use
PURE = [
    n
    for n in QUERIES
    if not n.startswith(("read_", "csv_", "ingest_reg", "incremental", "safe_", "materialise", "caliper"))
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_product_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["date_window_filter"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_flagship_reads_few_columns_and_filters_codes_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    try:
        text = plan(QUERIES["income_comparison"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "l_extendedprice" not in text and "o_orderpriority" not in text
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01" in text


def test_imputation_neither_joins_nor_shuffles_the_table(spark):
    text = plan(QUERIES["impute_mean"](spark, FOLDER))
    main = text.split("Subquery")[0]
    assert "Join" not in main and "hashpartitioning" not in main


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["limit_rows"](spark, FOLDER))
