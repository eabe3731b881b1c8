from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kohortflow.functions.exprs import age_at, cap_start, first_known_at, known_at
from kohortflow.operators import aggregates as ag
from kohortflow.operators import impute, quality
from kohortflow.operators.joins import (
    asof_join,
    full_outer_merge,
    link_children_to_parents,
    parental_income,
    person_family,
)
from kohortflow.operators.projection import (
    between_dates,
    eligible_children,
    has_code,
    lacks_code,
    limit_rows,
    multi_key_sort,
    require_columns,
    typed_projection,
)
from kohortflow.plans import tables as at


def test_typed_projection_drops_missing_and_casts(spark):
    df = spark.createDataFrame([("1", "2020-01-02")], "a string, b string")
    out = typed_projection(df, [("a", "x", "int"), ("b", "y", "date"), ("c", "z", "int")], "t")
    assert out.dtypes == [("x", "int"), ("y", "date")]
    assert rows(out) == [(1, date(2020, 1, 2))]
    assert typed_projection(df, [("c", "z", "int")], "t") is None
    assert typed_projection(None, [("a", "x", "int")], "t") is None


def test_strict_and_lenient_cast(spark):
    df = spark.createDataFrame([("bad",)], "a string")
    assert rows(typed_projection(df, [("a", "x", "int")], "t", lenient=True)) == [(None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed_projection(df, [("a", "x", "int")], "t").collect()


def test_required_columns(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"], "t") is df
    with pytest.raises(ValueError, match="x"):
        require_columns(df, ["id", "x"], "t")
    with pytest.raises(ValueError):
        require_columns(None, [], "t")


def test_date_window_is_inclusive(spark):
    df = spark.createDataFrame([(date(2000, 1, 1),), (date(2018, 12, 31),), (date(1999, 12, 31),), (None,)], "d date")
    assert between_dates(df, "d", "2000-01-01", "2018-12-31").count() == 2


@pytest.mark.parametrize("as_table", [False, True])
def test_null_code_is_in_neither_set(spark, as_table):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "code string")
    codes = spark.createDataFrame([("a",)], "code string") if as_table else ["a"]
    assert rows(has_code(df, "code", codes)) == [("a",)]
    assert rows(lacks_code(df, "code", codes)) == [("b",)]


def test_eligible_children_bounds(spark):
    bef = spark.createDataFrame(
        [("a", date(1995, 1, 1), "K", 5, "m", "f"), ("b", date(1994, 12, 31), "K", 10, "m", "f"),
         ("c", date(1996, 1, 1), "M", 3, "m", "f"), ("d", date(2018, 1, 1), "M", 1, "m", "f"),
         ("e", date(2018, 6, 1), "M", 0, "m", "f")],
        "PNR string, FOED_DAG date, KOEN string, ALDER int, MOR_ID string, FAR_ID string",
    )
    mfr = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "CPR_BARN string")
    assert [r[0] for r in rows(eligible_children(bef, mfr, 2000, 2018, 5))] == ["a", "e"]


def test_known_at_forms(spark):
    d = date(2000, 1, 1)
    df = spark.createDataFrame(
        [("x", d, d), ("x", date(2000, 1, 2), d), (None, d, d), ("x", None, d)], "v string, vd date, ref date"
    )
    out = df.select(known_at(F.col("v"), F.col("vd"), F.col("ref")).alias("k"))
    assert [r.k for r in out.collect()] == ["x", "Unknown", "Unknown", "Unknown"]
    df = spark.createDataFrame(
        [([(date(2001, 1, 1), "late"), (d, "ok")], d), ([], d), (None, d)],
        "rec array<struct<date:date,value:string>>, ref date",
    )
    out = df.select(first_known_at(F.col("rec"), F.col("ref")).alias("k"))
    assert [r.k for r in out.collect()] == ["ok", "Unknown", "Unknown"]


def test_cap_start_and_age(spark):
    df = spark.createDataFrame(
        [(date(2001, 1, 1), date(2000, 1, 1)), (date(2000, 1, 1), None)], "s date, e date"
    )
    out = df.select(cap_start(F.col("s"), F.col("e")).alias("c"), age_at(F.col("e"), F.col("s")).alias("a"))
    assert [tuple(r) for r in out.collect()] == [(date(2000, 1, 1), 366 / 365.25), (date(2000, 1, 1), None)]


def test_sort_and_limit_put_null_first(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 5), (1, 9)], "a int, b int")
    assert [tuple(r) for r in multi_key_sort(df, "a", "b").collect()] == [(None, 5), (1, None), (1, 9), (1, 1)]
    assert limit_rows(df.dropna(), 1, "a", "b").collect()[0].b == 1


def full_join_fixture(spark):
    a = spark.createDataFrame([(1, "a1"), (1, "a1b"), (2, "a2"), (None, "an")], "k int, a string")
    b = spark.createDataFrame([(1, "b1"), (3, "b3"), (3, "b3b"), (None, "bn")], "k int, b string")
    c = spark.createDataFrame([(3, "c3"), (4, "c4"), (2, "c2")], "k int, c string")
    return a, b, c


def test_full_outer_merge_equals_native_full_join(spark):
    a, b, c = full_join_fixture(spark)
    want = a.join(b, "k", "full").join(c, "k", "full").select("k", "a", "b", "c")
    assert rows(full_outer_merge([a, b, c], ["k"])) == rows(want)


def test_full_outer_merge_keeps_shared_column_left_first(spark):
    a = spark.createDataFrame([(1, "left"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "right"), (2, "right"), (3, "right")], "k int, v string")
    assert rows(full_outer_merge([a, b], ["k"])) == [(1, "left"), (2, "right"), (3, "right")]


def test_full_outer_merge_with_empty_side(spark):
    a, b, _ = full_join_fixture(spark)
    assert full_outer_merge([a.limit(0), b], ["k"]).count() == b.count()
    assert full_outer_merge([a, b.limit(0)], ["k"]).count() == a.count()


def test_parental_income_counts_one_parent_in_both_roles_once(spark):
    child = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "child_id string")
    person = spark.createDataFrame(
        [("c1", "m", "f"), ("c2", "m", "m"), ("c3", None, "f")],
        "person_id string, mother_id string, father_id string",
    )
    income = spark.createDataFrame(
        [("m", 2000, 10.0), ("f", 2000, 5.5), ("f", 2001, 1.0), ("x", 2000, 99.0)],
        "person_id string, year int, total_income double",
    )
    out = parental_income(income, link_children_to_parents(child, person))
    got = [(c, y, float(v)) for c, y, v in rows(out)]
    assert got == [("c1", 2000, 15.5), ("c1", 2001, 1.0), ("c2", 2000, 10.0), ("c3", 2000, 5.5), ("c3", 2001, 1.0)]


def test_asof_takes_last_change_not_after(spark):
    hist = spark.createDataFrame(
        [("p", 2000, 1, "A"), ("p", 2003, 2, "B"), ("p", 2003, 3, "C"), ("q", 2001, 4, "Z")],
        "k string, y int, e int, fam string",
    )
    ask = spark.createDataFrame([("p", 1999), ("p", 2000), ("p", 2002), ("p", 2003), ("p", 2009), ("r", 2000), ("p", 2002)], "k string, t int")
    out = asof_join(ask, hist, "k", "t", "y", ["e"], ["fam"])
    assert rows(out, "k", "t", "fam") == [
        ("p", 1999, None), ("p", 2000, "A"), ("p", 2002, "A"), ("p", 2002, "A"), ("p", 2003, "C"),
        ("p", 2009, "C"), ("r", 2000, None),
    ]


def test_latest_per_key_null_first_and_ties(spark):
    df = spark.createDataFrame(
        [("p", 1, date(2010, 1, 1)), ("p", 2, None), ("q", 3, date(2010, 1, 1)), ("q", 4, date(2010, 1, 1))],
        "k string, id int, d date",
    )
    out = ag.latest_per_key(df, ["k"], [*ag.null_first_desc("d"), F.col("id")])
    assert rows(out, "k", "id", "d") == [("p", 2, None), ("q", 4, date(2010, 1, 1))]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 10, 101, 5000])
def test_quantiles_equal_percentile(spark, n):
    df = spark.range(n).select(
        (F.col("id") % 3).alias("g"), (F.xxhash64("id") % 1000 / 7).alias("v"), F.lit(1).alias("h")
    )
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}
    for key in ("g", "h"):
        want = df.groupBy(key).agg(F.percentile("v", F.lit(list(probs.values()))).alias("q")).collect()
        got = {r[key]: [r[p] for p in probs] for r in ag.group_quantiles(df, [key], "v", probs).collect()}
        assert got.keys() == {r[key] for r in want}
        for r in want:
            assert got[r[key]] == pytest.approx(list(r.q))


def test_quantiles_with_null_group_null_values_and_heavy_tie(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 7.0)] + [("c", 5.0)] * 500 + [("c", 6.0)], "g string, v double")
    out = {r.g: r.m for r in ag.group_quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert out == {None: 2.0, "b": 7.0, "c": 5.0}


def test_quantiles_coarse_sketch_stays_exact(spark):
    df = spark.range(20000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 20011).cast("double").alias("v"))
    want = df.agg(F.percentile("v", F.lit(0.3))).first()[0]
    assert ag.group_quantiles(df, ["g"], "v", {"q": 0.3}, accuracy=100).first().q == pytest.approx(want)


def test_summary_drops_null_group_only_in_the_joined_form(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, None), (None, 5.0, "y")], "g string, v double, c string")
    assert {r.g for r in ag.group_summary(df, "g", ["v"]).collect()} == {"a", None}
    assert rows(ag.value_counts(df, "g", ["c"])) == [(None, "c", "y", 1), ("a", "c", None, 1), ("a", "c", "x", 1)]
    assert {r.g for r in ag.summary_joined(df, "g", ["v"], ["c"]).collect()} == {"a"}


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    r = ag.box_stats(df, "g", "v").first()
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.n_outliers) == (2, 3, 4, 1, 4, 1)


def test_mean_by_year_with_weights(spark):
    df = spark.createDataFrame([(1, 10, 1, 0), (1, 20, 3, 2), (2, 5, 0, 1)], "year int, v int, a int, b int")
    assert rows(ag.mean_by_year(df, "v", {"x": "a", "y": "b"})) == [(1, 17.5, 20.0), (2, None, 5.0)]


def test_missing_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert rows(quality.missing_report(df)) == [("a", 1, pytest.approx(100 / 3)), ("b", 2, pytest.approx(200 / 3))]
    assert [r[0] for r in rows(quality.missing_over_threshold(df, 0.5))] == ["b"]
    with pytest.raises(Exception, match="empty"):
        quality.missing_report(df.limit(0)).collect()


def test_outliers_skip_dates_and_absent_columns(spark):
    df = spark.createDataFrame([(float(v), date(2000, 1, 1)) for v in [1, 2, 3, 4, 100]], "v double, d date")
    assert rows(quality.iqr_outliers(df, ["v", "d", "none"])) == [("v", -1.0, 7.0, 1)]


def test_failing_rule_does_not_stop_the_others(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2000, 1, 1),)], "birth_date date")
    out = quality.consistency_rules(df, {"bad": F.col("none") > 1, **quality.default_rules("Person")})
    got = {r.rule: (r.n_violations, r.error is None) for r in out.collect()}
    assert got == {"bad": (None, False), "invalid_birth_dates": (1, True)}


def test_imputation_mean_mode_and_tie(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (4, None)], "n int, c string")
    out = impute.impute_missing(df, ["n", "zz"], ["c"])
    assert rows(out) == [(1.0, "b"), (2.5, "a"), (4.0, "a")]
    empty = spark.createDataFrame([(None, None)], "n int, c string")
    assert rows(impute.impute_missing(empty, ["n"], ["c"])) == [(None, None)]


def test_person_family_default_family_table(spark):
    bef = spark.createDataFrame([("p", "F1", "1"), ("q", None, "2")], "PNR string, FAMILIE_ID string, PLADS string")
    assert rows(person_family(bef)) == [("p", "F1", "1")]


def test_person_table_keeps_last_snapshot(spark):
    bef = spark.createDataFrame([("p", 2000, "U"), ("p", 2001, "G"), ("q", 2000, "E")], "PNR string, year int, CIVST string")
    assert rows(at.person_table(bef), "person_id", "civil_status", "snapshot_year") == [("p", "G", 2001), ("q", "E", 2000)]
    assert at.person_table(bef, all_snapshots=True).count() == 3
    monthly = spark.createDataFrame([("p", 2001, 3, "U"), ("p", 2001, 9, "G"), ("p", 2000, 12, "X")],
                                    "PNR string, year int, month int, CIVST string")
    assert rows(at.person_table(monthly), "person_id", "civil_status", "snapshot_year") == [("p", "G", 2001)]
    assert at.person_table(None) is None


def test_person_table_death_registers(spark):
    bef = spark.createDataFrame([("p", 2000), ("q", 2000), ("r", 2000)], "PNR string, year int")
    dod = spark.createDataFrame([("p", date(2001, 1, 1))], "PNR string, DODDATO date")
    aars = spark.createDataFrame([("p", "A10"), ("q", "A11")], "PNR string, C_DOD1 string")
    aasg = spark.createDataFrame([("q", "E1"), ("x", "E2")], "PNR string, C_DODTILGRUNDL_ACME string")
    out = at.person_table(bef, dod, aars, aasg)
    assert rows(out, "person_id", "death_date", "primary_cause", "underlying_cause") == [
        ("p", date(2001, 1, 1), "A10", None), ("q", None, "A11", "E1"), ("r", None, None, None),
    ]
    assert "death_date" not in at.person_table(bef, dod, None, aasg).columns


def test_diagnosis_table_sectors(spark):
    diag = spark.createDataFrame([("1", "C1"), ("2", "C2")], "RECNUM string, C_DIAG string")
    adm = spark.createDataFrame([("1", "p", date(2000, 1, 1))], "RECNUM string, PNR string, D_INDDTO date")
    psyk = spark.createDataFrame([("9", "q", date(2001, 1, 1), "S")], "RECNUM string, PNR string, D_INDDTO date, C_SPEC string")
    pdiag = spark.createDataFrame([("9", "F2")], "RECNUM string, C_DIAG string")
    out = at.diagnosis_table([(diag, adm), (diag, None), (pdiag, psyk)])
    assert rows(out, "diagnosis_id", "person_id", "diagnosis_code", "speciality") == [
        ("1", "p", "C1", None), ("9", "q", "F2", "S"),
    ]
    assert at.diagnosis_table([(None, adm), (diag, None)]) is None


def test_healthcare_joins_procedures_of_all_sectors(spark):
    adm = spark.createDataFrame([("1", "p"), ("2", "q")], "RECNUM string, PNR string")
    priv = spark.createDataFrame([("3", "r")], "RECNUM string, PNR string")
    opr = spark.createDataFrame([("1", "OA"), ("1", "OB")], "RECNUM string, C_OPR string")
    popr = spark.createDataFrame([("3", "OP")], "RECNUM string, C_OPR string")
    out = at.healthcare_table([adm, priv, None], [opr, popr])
    assert rows(out, "event_id", "procedure_code") == [("1", "OA"), ("1", "OB"), ("2", None), ("3", "OP")]
    assert at.healthcare_table([None, None, None], [opr]) is None
    assert "procedure_code" not in at.healthcare_table([adm], [None, None]).columns


def test_time_dimension(spark):
    out = at.time_dimension(spark, 2000, 2001)
    assert out.count() == 366 + 365
    r = out.where("date = DATE '2000-12-31'").first()
    assert (r.year, r.month, r.quarter, r.is_pre_treatment) == (2000, 12, 4, True)


def test_missing_registers_leave_tables_out(spark):
    mfr = spark.createDataFrame([("c", "F")], "CPR_BARN string, FAMILIE_ID string")
    assert set(at.build_all_tables({"MFR": mfr, "IND": None})) == {"Child"}
    assert at.employment_table(None, mfr, mfr) is None
    assert at.child_table(None) is None


def test_malformed_person_numbers(spark):
    from kohortflow.operators.quality import person_number_check

    df = spark.createDataFrame([(None,), ("010190-A12B",), ("010190-4122",)], "n string").selectExpr("n", "DATE '1990-01-01' AS b", "'K' AS s")
    assert {r.rule: r.n_violations for r in person_number_check(df, "n", "b", "s").collect()}["malformed"] == 2
