from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kohortflow.operators import cohort as co
from kohortflow.operators.propensity import caliper_match, propensity_logit
from kohortflow.plans import studies

BIRTH = date(2001, 1, 1)


def diagnoses(spark, items):
    return spark.createDataFrame(items, "person_id string, diagnosis_code string, diagnosis_date date")


def children(spark):
    return spark.createDataFrame(
        [("a", "F1", BIRTH), ("b", "F2", BIRTH), ("c", "F3", BIRTH), ("d", None, BIRTH), ("e", "F5", date(1994, 1, 1))],
        "child_id string, family_id string, birth_date date",
    )


def ranges(spark):
    return spark.createDataFrame([("C00", "C99", "x")], "lo string, hi string, grp string")


def test_cases_window_and_modes(spark):
    df = diagnoses(spark, [("a", "C10", date(2000, 1, 1)), ("a", "C10", date(2018, 12, 31)), ("a", "C10", date(2019, 1, 1)),
                           ("a", "B10", date(2005, 1, 1)), ("a", None, date(2005, 1, 1)), ("a", "C99", date(2005, 1, 1))])
    assert co.severe_chronic_cases(df, ranges(spark)).count() == 3
    points = spark.createDataFrame([("C00",), ("C99",)], "code string")
    assert co.severe_chronic_cases(df, points, "endpoint").count() == 1


def test_exposed_age_rule_bounds(spark):
    day = lambda n: BIRTH + timedelta(days=n)
    cases = diagnoses(spark, [("a", "C1", day(1825)), ("b", "C1", day(1826)), ("c", "C1", day(-3)), ("c", "C2", day(-3)), ("zz", "C1", day(1))])
    out = co.exposed_group(cases, children(spark))
    assert rows(out, "child_id", "index_date") == [("a", day(1825)), ("c", day(-3))]
    assert rows(co.exposed_group(cases, children(spark), non_negative=True), "child_id") == [("a",)]


def test_exposed_fallbacks(spark):
    d = date(2005, 1, 1)
    cases = diagnoses(spark, [("a", "C1", d), ("a", "C2", d), ("zz", "C1", d)])
    assert rows(co.exposed_group(cases, None)) == [("a", None, d), ("zz", None, d)]
    no_birth = children(spark).drop("birth_date")
    assert rows(co.exposed_group(cases, no_birth)) == [("a", "F1", d), ("zz", None, d)]
    by_person = children(spark).withColumnRenamed("child_id", "person_id").drop("family_id")
    assert rows(co.exposed_group(cases, by_person), "child_id", "family_id", "index_date") == [("a", None, d)]


def test_first_index(spark):
    cases = diagnoses(spark, [("a", "C1", date(2003, 1, 1)), ("a", "C1", date(2002, 1, 1))])
    assert rows(co.exposed_group(cases, children(spark)), "index_date") == [(date(2002, 1, 1),), (date(2003, 1, 1),)]
    assert rows(co.exposed_group(cases, children(spark), first_index=True), "index_date") == [(date(2002, 1, 1),)]


def test_pool_window_and_exclusion(spark):
    assert rows(co.unexposed_pool(children(spark)), "child_id") == [("a",), ("b",), ("c",), ("d",)]
    gone = spark.createDataFrame([("a",)], "child_id string")
    assert rows(co.unexposed_pool(children(spark), exclude=gone), "child_id") == [("b",), ("c",), ("d",)]


def test_match_counts_equal_the_pair_list(spark):
    cases = diagnoses(spark, [("a", "C1", date(2002, 1, 1)), ("b", "C1", date(2002, 1, 1)), ("b", "C1", date(2003, 1, 1))])
    exposed, pool = co.exposed_group(cases, children(spark)), co.unexposed_pool(children(spark))
    matched = co.exact_match(exposed, pool)
    pairs = (
        exposed.select("birth_date", "index_date")
        .join(pool.select("birth_date", "family_id", "child_id"), "birth_date", "left")
        .where("family_id IS NOT NULL")
        .select("family_id", "child_id", "index_date")
    )
    expanded = matched.select("family_id", "child_id", "index_date", F.explode(F.sequence(F.lit(1), "n_exposed"))).drop("col")
    assert rows(expanded) == rows(pairs)
    weights = {r.child_id: (r.w_exposed, r.w_unexposed) for r in co.exposure_weights(exposed, pool).collect()}
    assert weights == {"a": (1, 3), "b": (2, 3), "c": (0, 3)}


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_rank_in_strata_equals_row_number(spark, slices):
    df = spark.range(500).select((F.col("id") % 3).alias("s"), F.col("id").alias("child_id"), (F.col("id") * 7919 % 101 / 101).alias("u"))
    from pyspark.sql import Window

    got = co.rank_in_strata(df, ["s"], F.col("u"), "child_id", "r", slices)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("s").orderBy("u", "child_id")))
    assert rows(got, "s", "child_id", "r") == rows(want, "s", "child_id", "r")


def test_one_to_k_uses_controls_once(spark):
    exposed = spark.range(10).select(F.lit(1).alias("birth_date"), F.col("id").cast("string").alias("child_id"), F.lit(BIRTH).alias("index_date"))
    pool = spark.range(100, 125).select(F.lit(1).alias("birth_date"), F.col("id").cast("string").alias("child_id"))
    out = co.match_one_to_k(exposed, pool, k=3).collect()
    assert len(out) == 25 and len({r.child_id for r in out}) == 25
    sizes = [sum(r.exposed_id == e for r in out) for e in {r.exposed_id for r in out}]
    assert sorted(sizes) == [1] + [3] * 8


def test_treatment_period_and_labels(spark):
    d = date(2004, 2, 29)
    period = co.treatment_period(diagnoses(spark, [("a", "C1", d), ("a", "C1", date(2010, 1, 1))]), children(spark))
    first = period.orderBy("treatment_start_date").first()
    assert (first.pre_treatment_start, first.post_treatment_end) == (d - timedelta(days=365), d + timedelta(days=1825))
    days = [-366, -365, -1, 0, 1825, 1826]
    dated = spark.createDataFrame([("F1", d + timedelta(days=n), n) for n in days], "family_id string, d date, n int")
    assert rows(co.pre_post_label(dated, "d", period), "n", "period") == [(-365, "pre"), (-1, "pre"), (0, "post"), (1825, "post"), (1826, "pre")]


def test_outcomes_by_period(spark):
    exposed = spark.createDataFrame([("a", BIRTH), ("b", BIRTH)], "child_id string, index_date date")
    events = spark.createDataFrame(
        [("a", BIRTH + timedelta(days=n), 1) for n in (-1, 0, 365, 366, 3650)], "p string, d date, v int"
    )
    r = co.outcome_by_period(exposed, events, "p", "d", "v", {"short": 1, "long": 10}).orderBy("child_id").collect()
    assert [(x.n_short, x.sum_short, x.n_long) for x in r] == [(2, 2, 4), (0, 0, 0)]


def test_caliper_distance_and_single_use(spark):
    df = spark.range(3000).select(
        "id",
        (F.xxhash64("id", F.lit(1)) % 100).cast("double").alias("x"),
        (F.xxhash64("id", F.lit(2)) % 3 == 0).cast("int").alias("treated"),
    )
    scored = propensity_logit(df, "treated", ["x"])
    width = 0.2 * scored.agg(F.stddev_samp("logit")).first()[0]
    out = caliper_match(scored, "treated", "id").collect()
    assert out
    assert max(abs(r.exposed_logit - r.control_logit) for r in out) <= width + 1e-9
    assert len({r.exposed_id for r in out}) == len({r.control_id for r in out}) == len(out)


def test_record_split_child_in_both(spark):
    df = spark.createDataFrame([("a", "C10"), ("a", "B10"), ("a", None)], "PNR string, C_DIAG string")
    inside, outside = co.record_split(df, ranges(spark))
    assert rows(inside) == [("a", "C10")] and rows(outside) == [("a", "B10")]


def test_income_study_on_small_registers(spark):
    """Two exposed diagnoses, one match; means weighted by how often a child is in a cohort."""
    d = date(2003, 5, 1)
    frame = spark.createDataFrame
    registers = {
        "LPR_DIAG": frame([("1", "C10.1"), ("2", "C20"), ("3", "B10")], "RECNUM string, C_DIAG string"),
        "LPR_ADM": frame([("1", "a", d), ("2", "a", d + timedelta(days=1)), ("3", "b", d)],
                         "RECNUM string, PNR string, D_INDDTO date"),
        "MFR": frame([("a", "F1", BIRTH), ("b", "F2", BIRTH), ("x", "F3", date(2002, 1, 1))],
                     "CPR_BARN string, FAMILIE_ID string, FOEDSELSDATO date"),
        "BEF": frame([("a", 2002, "old", "fa"), ("a", 2003, "ma", "fa"), ("b", 2003, "mb", "mb"), ("x", 2003, "mx", "fx")],
                     "PNR string, year int, MOR_ID string, FAR_ID string"),
        "IND": frame([("ma", 2004, 10.0), ("fa", 2004, 20.0), ("mb", 2004, 100.0), ("old", 2004, 999.0), ("mx", 2004, 7.0),
                      ("mb", 2005, 50.0)], "PNR string, year int, PERINDKIALT_13 double"),
    }
    out = rows(studies.income_study(registers, ranges(spark)))
    # exposed: a twice -> 30; matched pool: a and b twice each -> (30 + 100) / 2; 2005 has no exposed income
    assert out == [(2004, 30.0, 65.0)]
    with pytest.raises(ValueError, match="Income"):
        studies.income_study({**registers, "IND": None}, ranges(spark))


def test_latest_education_unknown_start_wins(spark):
    df = spark.createDataFrame([("p", "10", date(2000, 1, 1)), ("p", "20", None), ("q", "30", date(2001, 1, 1)), ("q", "40", date(2000, 1, 1))],
                               "PNR string, HFAUDD string, HF_VFRA date")
    assert rows(studies.latest_education(df)) == [("p", "20", None), ("q", "30", date(2001, 1, 1))]
