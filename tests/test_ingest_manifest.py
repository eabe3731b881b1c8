"""CSV files by their headers, and ingest that skips, verifies and records."""

import glob
import json
import os

import pytest
from conftest import rows
from test_sources import put, text

from kohortflow.sources import ingest
from kohortflow.sources.files import csv_layouts, read_csv
from kohortflow.sources.registers import read_register


def test_columns_in_any_order(spark, tmp_path):
    text(f"{tmp_path}/a.csv", "PNR,kode,n\n1,x,3\n")
    text(f"{tmp_path}/b.csv", "n,PNR,kode\n4,2,y\n")
    text(f"{tmp_path}/c.csv", "kode,PNR\nz,3\n")
    df = read_csv(spark, str(tmp_path))
    assert dict(df.dtypes) == {"PNR": "string", "kode": "string", "n": "bigint"}
    assert rows(df, "PNR", "kode", "n") == [("1", "x", 3), ("2", "y", 4), ("3", "z", None)]


def test_month_files_with_other_orders(spark, tmp_path):
    text(f"{tmp_path}/bef200001.csv", "PNR,KODE\n1,Ab\n")
    text(f"{tmp_path}/bef200002.csv", "KODE,PNR\nCd,2\n")
    text(f"{tmp_path}/bef200101.csv", "KODE,PNR,N\nÆø,3,7\n", "iso-8859-1")
    df = read_register(spark, str(tmp_path), "bef{yearmonth}.csv", month="*")
    assert rows(df, "PNR", "KODE", "N", "year", "month") == [("1", "Ab", None, 2000, 1), ("2", "Cd", None, 2000, 2), ("3", "Æø", 7, 2001, 1)]


def test_values_that_span_lines(spark, tmp_path):
    text(f"{tmp_path}/a.csv", 'PNR,note\n1,"one\ntwo, ""three"""\n2,plain\n')
    text(f"{tmp_path}/b.csv", 'PNR,note\n3,5" wide\n4,other\n')  # a stray quote is part of the value
    layouts = sorted((sorted(os.path.basename(p) for p in group), spans) for group, spans in csv_layouts(spark, [str(tmp_path)]))
    assert layouts == [(["a.csv"], True), (["b.csv"], False)]
    assert rows(read_csv(spark, str(tmp_path)), "PNR", "note") == [("1", 'one\ntwo, "three"'), ("2", "plain"), ("3", '5" wide'), ("4", "other")]


def test_odd_file_names_and_empty_files(spark, tmp_path):
    text(f"{tmp_path}/a [1]+b%20 æ.csv", "PNR,x\n1,2\n")
    text(f"{tmp_path}/b.csv", "x,PNR\n3,4\n")
    text(f"{tmp_path}/none.csv", "")
    assert rows(read_csv(spark, str(tmp_path)), "PNR", "x") == [("1", 2), ("4", 3)]


def test_headers_do_not_cost_a_scan_per_file(spark, tmp_path):
    for k in range(12):
        text(f"{tmp_path}/f{k}.csv", f"PNR,x\n{k},{k}\n" if k % 2 else f"x,PNR\n{k},{k}\n")
    df = read_csv(spark, str(tmp_path), types={}, encodings=["utf-8"])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert df.count() == 12


def state(out):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{out}/**/*", recursive=True) if os.path.isfile(p)}


@pytest.fixture
def raw(tmp_path):
    src = str(tmp_path / "raw")
    put(src, "ras2000.parquet", PNR=["a", "b"], V=[1, 2])
    put(src, "ras2001.parquet", PNR=["c"], V=[3])
    text(f"{src}/kom.csv", "PNR,navn\n1,x\n")
    return src


def test_unchanged_rerun_writes_nothing(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    assert ingest.ingest_registers(spark, raw, out) == ["kom", "ras"]
    before = state(out)
    assert ingest.ingest_registers(spark, raw, out) == ["kom", "ras"]
    assert state(out) == before


def test_changed_file_replaces_its_year_only(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    ingest.ingest_registers(spark, raw, out)
    before = state(out)
    put(raw, "ras2001.parquet", PNR=["y", "z"], V=[8, 9])
    ingest.ingest_registers(spark, raw, out)
    same = {p for p, at in state(out).items() if before.get(p) == at}
    assert {p for p in same if "/ras/year=2000/" in p} and not {p for p in same if "/ras/year=2001/" in p}
    assert rows(spark.read.parquet(f"{out}/registers/ras"), "PNR", "V", "year") == [("a", 1, 2000), ("b", 2, 2000), ("y", 8, 2001), ("z", 9, 2001)]
    manifest = {r.path.rsplit("/", 1)[1]: r for r in ingest.read_manifest(spark, out).collect()}
    assert {k: v.n_rows for k, v in manifest.items()} == {"ras2000.parquet": 2, "ras2001.parquet": 2, "kom.csv": 1}
    assert not glob.glob(f"{out}/.staging*")


def test_year_that_is_gone_from_the_output_comes_back(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    ingest.ingest_registers(spark, raw, out)
    os.rename(f"{out}/registers/ras/year=2000", tmp_path / "aside")
    ingest.ingest_registers(spark, raw, out)
    assert rows(spark.read.parquet(f"{out}/registers/ras"), "PNR") == [("a",), ("b",), ("c",)]


def test_changed_type_rewrites_the_register(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    ingest.ingest_registers(spark, raw, out)
    put(raw, "ras2001.parquet", PNR=["c"], V=["text"])
    ingest.ingest_registers(spark, raw, out)
    assert rows(spark.read.parquet(f"{out}/registers/ras"), "PNR", "V") == [("a", "1"), ("b", "2"), ("c", "text")]


def test_damaged_copy_is_refused(spark, tmp_path, raw, monkeypatch):
    out = str(tmp_path / "out")
    ingest.ingest_registers(spark, raw, out)
    before = state(out)
    put(raw, "ras2000.parquet", PNR=["n", "m"], V=[5, 6])
    whole = ingest._staged
    monkeypatch.setattr(ingest, "_staged", lambda df, path: whole(df.where("PNR <> 'n'"), path))
    with pytest.raises(ingest.VerificationError, match="ras2000"):
        ingest.ingest_registers(spark, raw, out)
    assert state(out) == before and not glob.glob(f"{out}/.staging*")
    monkeypatch.undo()
    ingest.ingest_registers(spark, raw, out)  # the manifest did not take the change for done
    assert rows(spark.read.parquet(f"{out}/registers/ras"), "PNR") == [("c",), ("m",), ("n",)]


def test_one_bad_file_does_not_stop_the_others(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    with open(f"{raw}/ras2002.parquet", "wb") as f:
        f.write(b"this is no such file" * 10)
    with open(f"{raw}/bad2000.parquet", "wb") as f:
        f.write(b"nor is this" * 10)
    assert ingest.ingest_registers(spark, raw, out) == ["kom", "ras"]
    assert rows(spark.read.parquet(f"{out}/registers/ras"), "PNR") == [("a",), ("b",), ("c",)]
    failed = ingest.read_manifest(spark, out).where("status = 'failed'").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in failed) == ["bad2000.parquet", "ras2002.parquet"] and all(r.error for r in failed)
    put(raw, "ras2002.parquet", PNR=["d"], V=[4])  # mended
    ingest.ingest_registers(spark, raw, out)
    assert rows(spark.read.parquet(f"{out}/registers/ras"), "PNR") == [("a",), ("b",), ("c",), ("d",)]


def test_own_source_file_and_unlike_types(spark, tmp_path):
    src, out = str(tmp_path / "raw"), str(tmp_path / "out")
    put(src, "ras2000.parquet", PNR=["a"], V=[1], source_file=["own"])
    put(src, "ras2001.parquet", PNR=["b"], V=["x"])
    put(src, "ras2002.parquet", PNR=["c"], V=[2.5])
    put(src, "other2000.parquet", PNR=["d"])
    assert ingest.ingest_registers(spark, src, out) == ["other", "ras"]
    got = rows(spark.read.parquet(f"{out}/registers/ras"), "PNR", "V", "source_source_file", "source_file")
    assert got == [("a", "1", "own", "ras2000.parquet"), ("b", "x", None, "ras2001.parquet"), ("c", "2.5", None, "ras2002.parquet")]


def test_summary_as_json_names_every_file(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    put(f"{raw}/second", "ras_2000.parquet", PNR=["q"], V=[4])
    ingest.ingest_registers(spark, raw, out)
    lines = [json.loads(line) for p in glob.glob(f"{ingest.write_summary(spark, out)}/*.json") for line in open(p)]
    assert [(r["register"], r.get("year"), r["file_name"], r["num_rows"], r["column_names"]) for r in lines] == [
        ("kom", None, "kom.csv", 1, ["PNR", "navn"]),
        ("ras", 2000, "ras2000.parquet", 2, ["PNR", "V"]),
        ("ras", 2000, "ras_2000.parquet", 1, ["PNR", "V"]),
        ("ras", 2001, "ras2001.parquet", 1, ["PNR", "V"]),
    ]


def test_empty_folder(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    out = str(tmp_path / "out")
    assert ingest.ingest_registers(spark, str(tmp_path / "raw"), out) == []
