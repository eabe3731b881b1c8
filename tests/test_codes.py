from conftest import rows

from kohortflow.functions.codes import (
    endpoint_codes,
    icd_range_join,
    in_code_ranges,
    not_in_code_ranges,
    parse_code_list,
    severe_chronic_list,
)


def test_parse_ranges_singles_and_en_dash(spark):
    lists = spark.createDataFrame([("D61.0; D61.8-D61.9", "a"), ("G31.8–G31.9;G40", "b")], "codes string, grp string")
    assert rows(parse_code_list(lists)) == [
        ("D61.0", "D61.0", "a"), ("D61.8", "D61.9", "a"), ("G31.8", "G31.9", "b"), ("G40", "G40", "b"),
    ]


def test_built_in_list_has_49_groups_and_81_endpoint_keys(spark):
    lists = severe_chronic_list(spark)
    assert lists.count() == 49
    keys = endpoint_codes(lists).select("code").distinct()
    assert keys.count() == 81
    assert keys.where("code = 'G31.8–G31.9'").count() == 1  # an en dash does not split end points


def test_range_bounds_and_prefixes(spark):
    ranges = spark.createDataFrame(
        [("C00.0", "C99.1", "c"), ("Q01", "Q07", "q"), ("E10", "E10", "e"), ("H95", "J02", "across")],
        "lo string, hi string, grp string",
    )
    codes = ["C00.0", "C50.1", "C99.1", "C99.2", "B99", "Q07.9", "Q08", "E10", "E10.4", "E11", "I50", "J02.1", "J03", None, "X", "C4A"]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    hits = dict(rows(icd_range_join(df, "code", ranges)))
    assert hits == {
        "C00.0": "c", "C50.1": "c", "C99.1": "c", "C4A": "c", "Q07.9": "q", "E10": "e", "E10.4": "e",
        "I50": "across", "J02.1": "across",
    }
    assert {r[0] for r in rows(in_code_ranges(df, "code", ranges))} == set(hits)
    assert {r[0] for r in rows(not_in_code_ranges(df, "code", ranges))} == {c for c in codes if c} - set(hits)


def test_semi_join_keeps_a_row_once_under_overlapping_ranges(spark):
    ranges = spark.createDataFrame([("C00", "C50", "a"), ("C40", "C60", "b")], "lo string, hi string, grp string")
    df = spark.createDataFrame([("C45",), ("C45",)], "code string")
    assert in_code_ranges(df, "code", ranges).count() == 2
    assert icd_range_join(df, "code", ranges).count() == 4


def test_short_lower_case_and_bad_codes(spark):
    from kohortflow.functions.codes import bad_codes, in_code_ranges

    listed = parse_code_list(spark.createDataFrame([("c; d1-d3; 9x; Q", "g")], "codes string, grp string"))
    df = spark.createDataFrame([("C50",), ("D2",), ("Q79",), ("A01",)], "code string")
    assert [r.code for r in in_code_ranges(df, "code", listed).orderBy("code").collect()] == ["C50", "D2", "Q79"]
    assert [r.lo for r in bad_codes(listed).collect()] == ["9X"]
