"""Aggregations, sorts, set operations, data quality and imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.checks.registry import check, rounded
from kohortflow.checks.tables import child
from kohortflow.functions.exprs import MAX_FAMILY_SIZE, age_at
from kohortflow.operators import aggregates as ag
from kohortflow.operators import impute, quality
from kohortflow.operators.projection import multi_key_sort
from kohortflow.plans.studies import latest_education
from kohortflow.plans.tables import person_year_income, row_counts
from kohortflow.sources.registers import union_registers

# aggregations


@check(
    "count_rows",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in ("customer", "orders", "lineitem", "events")
    ),
)
def _(t):
    return row_counts({n: t[n] for n in ("customer", "orders", "lineitem", "events")})


check(
    "distinct_persons",
    "SELECT sector, count(DISTINCT PNR) AS n_persons FROM {r_adm} GROUP BY sector",
)(lambda t: t["r_adm"].groupBy("sector").agg(ag.distinct_persons(t["r_adm"], "PNR").alias("n_persons")))
check(
    "income_sum",
    """SELECT FAMILIE_ID AS family_id, year, CAST(sum(CAST(PERINDKIALT_13 AS DECIMAL(18,2))) AS DOUBLE) AS income
       FROM {r_indfam} GROUP BY ALL""",
)(
    lambda t: t["r_indfam"].groupBy(F.col("FAMILIE_ID").alias("family_id"), "year").agg(
        F.sum(F.col("PERINDKIALT_13").cast("decimal(18,2)")).cast("double").alias("income")
    )
)


@check(
    "income_mean_by_year",
    """SELECT year,
              round(CAST(sum(CAST(PERINDKIALT_13 AS DECIMAL(18,2))) FILTER (gender = 'K') AS DOUBLE)
                    / count(*) FILTER (gender = 'K'), 3) AS avg_income_k,
              round(CAST(sum(CAST(PERINDKIALT_13 AS DECIMAL(18,2))) FILTER (gender = 'M') AS DOUBLE)
                    / count(*) FILTER (gender = 'M'), 3) AS avg_income_m
       FROM {r_ind} i JOIN {r_child} c ON i.PNR = c.child_id GROUP BY year""",
)
def _(t):
    people = child(t).select(F.col("child_id").alias("person_id"), "gender")
    joined = person_year_income(t["r_ind"]).join(people, "person_id").select(
        "year",
        F.col("total_income").cast("decimal(18,2)").alias("income"),
        (F.col("gender") == "K").cast("bigint").alias("k"),
        (F.col("gender") == "M").cast("bigint").alias("m"),
    )
    means = ag.mean_by_year(joined, "income", {"avg_income_k": "k", "avg_income_m": "m"})
    return means.select("year", rounded("avg_income_k"), rounded("avg_income_m"))


check("latest_per_key", "SELECT PNR, HFAUDD, HF_VFRA FROM {o_latest}")(lambda t: latest_education(t["r_uddf"]))

NUMERIC = ["l_quantity", "l_extendedprice"]
SUMMARY_SQL = " UNION ALL ".join(
    f"""SELECT g AS l_returnflag, '{c}' AS variable, round(avg({c}), 3) AS mean, round(median({c}), 3) AS median,
               round(stddev_samp({c}), 3) AS std, min({c}) AS min, max({c}) AS max
        FROM (SELECT *, nullif(l_returnflag, 'N') AS g FROM lineitem) GROUP BY g"""
    for c in NUMERIC
)


def flagged(t) -> DataFrame:
    return t["lineitem"].withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))


def summary_columns(df: DataFrame) -> DataFrame:
    digits = {"mean", "median", "std"}
    return df.select(*[rounded(c) if c in digits else F.col(c) for c in df.columns])


check("group_summary", SUMMARY_SQL)(
    lambda t: summary_columns(ag.group_summary(flagged(t), "l_returnflag", NUMERIC))
)
WIDE_SQL = ", ".join(
    f"""round(avg({c}), 3) AS {c}_mean, round(median({c}), 3) AS {c}_median,
        round(stddev_samp({c}), 3) AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max"""
    for c in NUMERIC
)
check(
    "group_summary_wide",
    f"""SELECT g AS l_returnflag, {WIDE_SQL}
        FROM (SELECT *, nullif(l_returnflag, 'N') AS g FROM lineitem) GROUP BY g""",
)(
    lambda t: ag.wide_summary(
        summary_columns(ag.group_summary(flagged(t), "l_returnflag", NUMERIC)), "l_returnflag", NUMERIC
    )
)
COUNTS_SQL = " UNION ALL ".join(
    f"""SELECT nullif(l_returnflag, 'N') AS l_returnflag, '{c}' AS variable, CAST({c} AS VARCHAR) AS value,
               count(*) AS n
        FROM (SELECT * REPLACE (nullif(l_linenumber, 2) AS l_linenumber) FROM lineitem) GROUP BY ALL"""
    for c in ("l_linestatus", "l_linenumber")
)


def categories(t) -> DataFrame:
    return flagged(t).withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(2)))


check("value_counts", COUNTS_SQL)(
    lambda t: ag.value_counts(categories(t), "l_returnflag", ["l_linestatus", "l_linenumber"])
)
check(
    "summary_joined",
    f"""SELECT s.*, c.variable AS category_variable, c.value, c.n
        FROM ({SUMMARY_SQL}) s JOIN ({COUNTS_SQL}) c ON s.l_returnflag = c.l_returnflag""",
)(
    lambda t: summary_columns(
        ag.summary_joined(categories(t), "l_returnflag", NUMERIC, ["l_linestatus", "l_linenumber"])
    )
)
check(
    "contingency",
    """SELECT o_orderpriority,
              CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS BIGINT) AS F,
              CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS BIGINT) AS O,
              CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS BIGINT) AS P
       FROM orders GROUP BY o_orderpriority""",
)(
    lambda t: ag.contingency(
        t["orders"].groupBy("o_orderpriority", "o_orderstatus").count(),
        "o_orderpriority", "o_orderstatus", ["F", "O", "P"], "count",
    )
)


@check(
    "box_stats",
    """WITH v AS (SELECT l_returnflag, CASE WHEN l_orderkey % 50 = 0 THEN 8 ELSE 1 END * l_extendedprice AS x
                  FROM lineitem),
            q AS (SELECT l_returnflag, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
                         quantile_cont(x, 0.75) AS q3 FROM v GROUP BY l_returnflag),
            j AS (SELECT q.*, x, x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
                  FROM v JOIN q ON v.l_returnflag = q.l_returnflag)
       SELECT l_returnflag, round(q1, 3) AS q1, round(median, 3) AS median, round(q3, 3) AS q3,
              min(x) FILTER (inside) AS whisker_low, max(x) FILTER (inside) AS whisker_high,
              count(*) FILTER (NOT inside) AS n_outliers
       FROM j GROUP BY ALL""",
)
def _(t):
    factor = F.when(F.col("l_orderkey") % 50 == 0, 8).otherwise(1)
    df = t["lineitem"].select("l_returnflag", (factor * F.col("l_extendedprice")).alias("x"))
    out = ag.box_stats(df, "l_returnflag", "x")
    return out.select(
        "l_returnflag", *[rounded(c) for c in ("q1", "median", "q3")], "whisker_low", "whisker_high", "n_outliers"
    )


check(
    "family_size",
    f"""SELECT FAMILIE_ID, count(*) AS n_members FROM {{r_bef}} GROUP BY FAMILIE_ID
        HAVING count(*) > {MAX_FAMILY_SIZE}""",
)(lambda t: ag.family_size(t["r_bef"], "FAMILIE_ID", MAX_FAMILY_SIZE))
check("distinct_rows", "SELECT DISTINCT PNR, sector, C_SPEC FROM {r_adm}")(
    lambda t: t["r_adm"].select("PNR", "sector", "C_SPEC").distinct()
)

# sorts and set operations


@check(
    "family_first_address",
    """SELECT PNR, year, FAMILIE_ID, first_value(PLADS) OVER (PARTITION BY FAMILIE_ID ORDER BY year, PNR) AS address
       FROM {r_bef}""",
)
def _(t):
    return ag.family_first_address(t["r_bef"], "FAMILIE_ID", "PLADS", ["year", "PNR"], "address").select(
        "PNR", "year", "FAMILIE_ID", "address"
    )


check("multi_key_sort", "SELECT PNR, HF_VTIL, INSTNR FROM {r_uddf} ORDER BY PNR NULLS FIRST, HF_VTIL DESC NULLS FIRST")(
    lambda t: multi_key_sort(t["r_uddf"], "PNR", "HF_VTIL").select("PNR", "HF_VTIL", "INSTNR")
)
check(
    "union_registers",
    """SELECT PNR, year, PERINDKIALT_13, NULL AS ARBGNR, NULL AS SOCIO FROM {r_ind}
       UNION ALL SELECT PNR, year, NULL, ARBGNR, NULL FROM {r_idan}
       UNION ALL SELECT PNR, year, NULL, NULL, SOCIO FROM {r_akm}""",
)(
    lambda t: union_registers(
        [t["r_ind"].drop("SOCIO13"), t["r_idan"].drop("JOBLON"), t["r_akm"]]
    )
)

# data quality


def gaps(t) -> DataFrame:
    """Orders with induced NULLs."""
    return t["orders"].select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("O")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 25 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.to_date("o_orderdate").alias("o_orderdate"),
    )


GAPS = """(SELECT o_orderkey, nullif(o_orderstatus, 'O') AS o_orderstatus,
                  CASE WHEN o_orderkey % 25 <> 0 THEN o_totalprice END AS o_totalprice,
                  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS o_orderpriority,
                  CAST(o_orderdate AS DATE) AS o_orderdate FROM orders)"""
MISSING_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing,
               round((count(*) - count({c})) * 100.0 / count(*), 3) AS pct_missing FROM {GAPS}"""
    for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
)
check("missing_report", f"SELECT * REPLACE (CAST(pct_missing AS DOUBLE) AS pct_missing) FROM ({MISSING_SQL}) WHERE n_missing > 0")(
    lambda t: quality.missing_report(gaps(t)).select("column_name", "n_missing", rounded("pct_missing"))
)
check(
    "missing_over_threshold",
    f"SELECT * REPLACE (CAST(pct_missing AS DOUBLE) AS pct_missing) FROM ({MISSING_SQL}) WHERE pct_missing > 10",
)(
    lambda t: quality.missing_over_threshold(gaps(t)).select("column_name", "n_missing", rounded("pct_missing"))
)
OUTLIER_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(lower, 3) AS lower, round(upper, 3) AS upper,
               count(*) FILTER ({c} < lower OR {c} > upper) AS n_outliers
        FROM v, (SELECT quantile_cont({c}, 0.25) - 0.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lower,
                        quantile_cont({c}, 0.75) + 0.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS upper
                 FROM v) GROUP BY lower, upper"""
    for c in ("l_quantity", "l_extendedprice", "l_tax")
)
check("iqr_outliers", f"WITH v AS (SELECT * FROM lineitem) {OUTLIER_SQL}")(
    lambda t: quality.iqr_outliers(
        t["lineitem"], ["l_quantity", "l_extendedprice", "l_tax", "l_shipdate", "absent"], factor=0.5
    ).select("column_name", rounded("lower"), rounded("upper"), "n_outliers")
)


@check(
    "consistency_rules",
    """SELECT 'invalid_birth_dates' AS rule, count(*) FILTER (FOED_DAG > DATE '2023-01-01') AS n_violations
       FROM {r_snapshot}
       UNION ALL SELECT 'born_after_snapshot', count(*) FILTER (ALDER < 0) FROM {r_snapshot}
       UNION ALL SELECT 'absent_column', NULL FROM (SELECT 1)""",
)
def _(t):
    df = t["r_snapshot"].withColumnRenamed("FOED_DAG", "birth_date")
    rules = {
        **quality.default_rules("Person"),
        "born_after_snapshot": F.col("ALDER") < 0,
        "absent_column": F.col("no_such_column") > 0,
    }
    return quality.consistency_rules(df, rules).drop("error")


check(
    "age_consistency",
    """SELECT 'age' AS rule, count(*) FILTER (year - year(FOED_DAG) <> age) AS n_violations
       FROM (SELECT *, ALDER + CASE WHEN PNR % 7 = 0 THEN 1 ELSE 0 END AS age FROM {r_snapshot})""",
)(
    lambda t: quality.age_consistency(
        t["r_snapshot"].withColumn("age", F.col("ALDER") + (F.col("PNR") % 7 == 0).cast("int")),
        "year", "FOED_DAG", "age",
    )
)
check(
    "parent_age_gap",
    """SELECT l.role, count(*) AS n_links,
              count(*) FILTER (year(l.birth_date) - year(p.birth_date) NOT BETWEEN 15 AND 50) AS n_violations
       FROM (SELECT birth_date, 'mother' AS role, mother_id AS parent_id FROM {r_child}
             UNION ALL SELECT birth_date, 'father', father_id FROM {r_child}) l
       JOIN {r_child} p ON l.parent_id = p.child_id GROUP BY l.role""",
)(
    lambda t: quality.parent_age_gap(
        t["r_child"], t["r_child"].select(F.col("child_id").alias("person_id"), "birth_date")
    )
)
check(
    "person_number_check",
    """SELECT 'malformed' AS rule, count(*) FILTER (NOT coalesce(regexp_matches(number, '^[0-9][0-9][0-9][0-9][0-9][0-9]-[0-9][0-9][0-9][0-9]$'), false))
                AS n_violations FROM {r_number}
       UNION ALL
       SELECT 'birth_date' AS rule, count(*) FILTER (substr(number, 1, 6) <> strftime(birth_date, '%d%m%y'))
                AS n_violations FROM {r_number}
       UNION ALL
       SELECT 'century_digit', count(*) FILTER (NOT CAST(substr(number, 8, 1) AS INT) BETWEEN
                CASE WHEN year(birth_date) BETWEEN 1937 AND 1999 THEN 4 ELSE 0 END AND
                CASE WHEN year(birth_date) BETWEEN 1937 AND 1999 THEN 9 ELSE 3 END) FROM {r_number}
       UNION ALL
       SELECT 'sex_parity', count(*) FILTER (CAST(substr(number, 11, 1) AS INT) % 2
                <> CASE WHEN gender = 'K' THEN 0 ELSE 1 END) FROM {r_number}""",
)(lambda t: quality.person_number_check(t["r_number"], "number", "birth_date", "gender"))

# imputation

MEAN = f"(SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) FROM {GAPS})"


def mode_sql(column: str) -> str:
    return f"""(SELECT {column} FROM {GAPS} WHERE {column} IS NOT NULL GROUP BY {column}
                ORDER BY count(*) DESC, {column} LIMIT 1)"""


check(
    "impute_mean",
    f"SELECT o_orderkey, round(coalesce(o_totalprice, {MEAN}), 3) AS o_totalprice FROM {GAPS}",
)(
    lambda t: impute.impute_mean(gaps(t), ["o_totalprice"], scale=2).select("o_orderkey", rounded("o_totalprice"))
)
check(
    "impute_mode",
    f"""SELECT o_orderkey, coalesce(o_orderstatus, {mode_sql("o_orderstatus")}) AS o_orderstatus,
               coalesce(o_orderpriority, {mode_sql("o_orderpriority")}) AS o_orderpriority FROM {GAPS}""",
)(
    lambda t: impute.impute_mode(gaps(t), ["o_orderstatus", "o_orderpriority"]).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
)


@check(
    "impute_tables",
    f"""SELECT 'Orders' AS table_name, o_orderkey AS id,
               round(coalesce(o_totalprice, {MEAN}), 3) AS amount,
               coalesce(o_orderstatus, {mode_sql("o_orderstatus")}) AS category FROM {GAPS}
        UNION ALL
        SELECT 'Customer', c_custkey,
               round(coalesce(nullif(c_nationkey, 3), (SELECT avg(nullif(c_nationkey, 3)) FROM customer)), 3),
               coalesce(nullif(c_mktsegment, 'BUILDING'),
                        (SELECT c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
                         GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1))
        FROM customer""",
)
def _(t):
    customer = t["customer"].select(
        "c_custkey",
        F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )
    filled = impute.impute_tables(
        {"Orders": gaps(t), "Customer": customer, "Absent": None},
        ["o_totalprice", "c_nationkey", "o_orderdate"],
        {"Orders": ["o_orderstatus"], "Customer": ["c_mktsegment"]},
        scale=2,
    )
    shape = {
        "Orders": ("o_orderkey", "o_totalprice", "o_orderstatus"),
        "Customer": ("c_custkey", "c_nationkey", "c_mktsegment"),
    }
    parts = [
        filled[n].select(
            F.lit(n).alias("table_name"), F.col(i).alias("id"), F.round(a, 3).alias("amount"), F.col(c).alias("category")
        )
        for n, (i, a, c) in shape.items()
    ]
    return reduce(DataFrame.unionByName, parts)


check(
    "age_at_reference",
    """SELECT child_id, round((DATE '2023-01-01' - birth_date) / 365.25, 3) AS age FROM {r_child}""",
)(
    lambda t: t["r_child"].select(
        "child_id", F.round(age_at(F.col("birth_date"), F.lit("2023-01-01").cast("date")), 3).alias("age")
    )
)
