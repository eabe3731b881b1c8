import os
from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from kohortflow.session import cut_lineage, scratch_dir
from kohortflow.sources import ingest
from kohortflow.sources.files import file_format, read_csv, read_file
from kohortflow.sources.registers import read_register, read_registers, union_registers
from kohortflow.streaming.incremental import incremental_ingest


def files_read(df):
    """Files the scan of an executed plan opened."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    while not leaves.head().metrics().contains("numFiles"):  # inside an adaptive plan
        leaves = leaves.head().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numFiles").value()


def put(folder, name, **columns):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table(columns), f"{folder}/{name}")


def text(path, content, encoding="utf-8"):
    with open(path, "wb") as f:
        f.write(content.encode(encoding))


def test_register_years(spark, tmp_path):
    d = str(tmp_path / "ind")
    put(d, "ind_2001.parquet", PNR=["a"], X=[1])
    put(d, "ind_2003.parquet", PNR=["b"], X=[2], Y=["new"])
    put(d, "other_2001.parquet", PNR=["z"])
    out = read_register(spark, d, "ind_{year}.parquet", range(2000, 2005))
    assert rows(out, "PNR", "X", "Y", "year") == [("a", 1, None, 2001), ("b", 2, "new", 2003)]
    assert rows(read_register(spark, d, "ind_{year}.parquet", [2003]), "PNR") == [("b",)]
    assert rows(read_register(spark, d, "ind_{year}.parquet"), "PNR") == [("a",), ("b",)]
    assert read_register(spark, d, "ind_{year}.parquet", [1990]) is None
    assert read_register(spark, d, "none.parquet") is None
    assert "year" not in read_register(spark, d, "other_2001.parquet").columns


def test_register_filter_on_year_prunes_files(spark, tmp_path):
    d = str(tmp_path / "p")
    for y in (2001, 2002, 2003):
        put(d, f"p_{y}.parquet", PNR=[str(y)])
    out = read_register(spark, d, "p_{year}.parquet").where("year = 2002")
    assert rows(out, "PNR") == [("2002",)]
    assert files_read(out) == 1


def test_register_months(spark, tmp_path):
    d = str(tmp_path / "bef")
    put(d, "bef_200103.parquet", PNR=["a"])
    put(d, "bef_200109.parquet", PNR=["b"])
    out = read_register(spark, d, "bef_{yearmonth}.parquet", [2001], month="*")
    assert rows(out, "PNR", "year", "month") == [("a", 2001, 3), ("b", 2001, 9)]
    assert rows(read_register(spark, d, "bef_{yearmonth}.parquet", [2001], month=9), "PNR") == [("b",)]
    put(d, "q_2001_03.parquet", PNR=["c"])
    assert rows(read_register(spark, d, "q_{year}_{month}.parquet", [2001]), "PNR", "month") == [("c", 3)]


def test_register_type_drift(spark, tmp_path):
    d = str(tmp_path / "drift")
    put(d, "x_2001.parquet", RECNUM=[12], V=[1.5])
    put(d, "x_2002.parquet", RECNUM=["0013"], V=[2.5])
    out = read_register(spark, d, "x_{year}.parquet", [2001, 2002], drift=True)
    assert rows(out, "RECNUM", "year") == [("0013", 2002), ("12", 2001)]


def test_register_csv_years(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    text(d / "k_2001.csv", "PNR,V\n01,1\n")
    text(d / "k_2002.csv", "V,PNR,W\n2,02,NA\n")
    out = read_register(spark, str(d), "k_{year}.csv", [2000, 2001, 2002])
    assert rows(out, "PNR", "V", "year") == [("01", 1, 2001), ("02", 2, 2002)]


def test_csv_column_empty_in_one_year_gets_one_type(spark, tmp_path):
    d = tmp_path / "types"
    d.mkdir()
    text(d / "k_2001.csv", "PNR,V,D\n01,NA,2001-05-06\n")
    text(d / "k_2002.csv", "PNR,V,D\n02,2.5,NA\n")
    text(d / "k_2003.csv", "PNR,V,D\n03,7,\n")
    out = read_register(spark, str(d), "k_{year}.csv", [2001, 2002, 2003])
    assert dict(out.dtypes) == {"PNR": "string", "V": "double", "D": "date", "year": "int"}
    ingest.ingest_registers(spark, str(d), str(tmp_path / "out"))
    got = spark.read.parquet(f"{tmp_path}/out/registers/k")
    assert rows(got, "PNR", "V", "year") == [("01", None, 2001), ("02", 2.5, 2002), ("03", 7.0, 2003)]


def test_own_years_override(spark, tmp_path):
    d = str(tmp_path / "o")
    put(d, "u_2001.parquet", PNR=["a"])
    put(d, "u_2002.parquet", PNR=["b"])
    spec = {"U": {"location": d, "pattern": "u_{year}.parquet", "years": [2002]}, "N": {"location": d, "pattern": "n_{year}.parquet"}}
    out = read_registers(spark, spec, [2001])
    assert rows(out["U"], "PNR") == [("b",)] and out["N"] is None


def test_partitioned_layout(spark, tmp_path):
    path = str(tmp_path / "part")
    spark.createDataFrame([("a", 2001), ("b", 2002)], "PNR string, year int").write.partitionBy("year").parquet(path)
    out = read_register(spark, path, years=[2002])
    assert rows(out, "PNR") == [("b",)]
    assert "PartitionFilters: [isnotnull(year" in out._jdf.queryExecution().executedPlan().toString()


def test_file_formats(spark, tmp_path):
    assert file_format("a/b.PARQUET") == "parquet"
    with pytest.raises(ValueError):
        file_format("a.sas7bdat")
    with pytest.raises(ValueError):
        read_file(spark, str(tmp_path / "x.txt"))


def test_csv_tokens_types_identifiers(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    text(path, 'PNR,n,f,d,s\n0101,1,1.5,2020-01-02,NaN\nNA,null,nan,NULL,"a,b"\n,,,na,x\n')
    df = read_csv(spark, path)
    assert df.dtypes == [("PNR", "string"), ("n", "bigint"), ("f", "double"), ("d", "date"), ("s", "string")]
    assert rows(df) == [(None, None, None, None, "a,b"), (None, None, None, None, "x"), ("0101", 1, 1.5, date(2020, 1, 2), None)]
    typed = read_csv(spark, path, types={"n": "int", "f": "double"})
    assert dict(typed.dtypes)["n"] == "int" and dict(typed.dtypes)["d"] == "string"


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1"])
def test_csv_encodings(spark, tmp_path, encoding):
    path = str(tmp_path / "e.csv")
    text(path, "navn\nSøren Ærø\n", encoding)
    assert rows(read_csv(spark, path)) == [("Søren Ærø",)]


def test_csv_encoding_of_each_file(spark, tmp_path):
    text(str(tmp_path / "a.csv"), "navn\nSøren\n")
    text(str(tmp_path / "b.csv"), "navn\nÆrø\n", "iso-8859-1")
    assert rows(read_csv(spark, str(tmp_path))) == [("Søren",), ("Ærø",)]


def test_register_names(spark):
    stems = ["priv_sksube2012", "ras2000", "LPR_ADM_2005", "Readme", "bef200103", "x-2001"]
    df = spark.createDataFrame([(s,) for s in stems], "s string")
    got = df.select("s", ingest.register_name(F.col("s")).alias("r"), ingest.register_year(F.col("s")).alias("y"))
    assert {r.s: (r.r, r.y) for r in got.collect()} == {
        "priv_sksube2012": ("priv_sksube", "2012"), "ras2000": ("ras", "2000"), "LPR_ADM_2005": ("lpr_adm", "2005"),
        "Readme": ("readme", ""), "bef200103": ("bef", "200103"), "x-2001": ("x-2001", ""),
    }


def test_ingest_and_summary(spark, tmp_path):
    src, out = str(tmp_path / "raw" / "deep"), str(tmp_path / "out")
    put(src, "ras2000.parquet", PNR=["a", "b"], V=[1, 2])
    put(src, "RAS_2001.parquet", PNR=["c"], V=[3])
    text(f"{src}/kom.csv", "PNR,navn\n1,x\n")
    assert ingest.ingest_registers(spark, str(tmp_path / "raw"), out) == ["kom", "ras"]
    ras = spark.read.parquet(f"{out}/registers/ras")
    assert rows(ras, "PNR", "year", "source_file") == [("a", 2000, "ras2000.parquet"), ("b", 2000, "ras2000.parquet"), ("c", 2001, "RAS_2001.parquet")]
    got = {r.year: r for r in ingest.ingest_summary(ras, "ras", "source_file").collect()}
    assert (got[2000].num_rows, got[2000].num_columns, got[2000].column_names, got[2001].file_name) == (2, 2, ["PNR", "V"], "RAS_2001.parquet")
    put(src, "ras2000.parquet", PNR=["z"], V=[9])  # a rerun replaces the years it reads and adds nothing twice
    ingest.ingest_registers(spark, str(tmp_path / "raw"), out)
    assert rows(spark.read.parquet(f"{out}/registers/ras"), "PNR") == [("c",), ("z",)]


def test_tables_equal(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(2, "x"), (1, None), (1, None)], "a int, b string")
    assert ingest.tables_equal(a, b).first().equal
    r = ingest.tables_equal(a, b.distinct()).first()
    assert (r.n_only_a, r.n_only_b, r.equal, r.same_schema) == (1, 0, False, True)
    assert not ingest.tables_equal(a, a.withColumn("c", F.lit(1))).first().equal
    assert ingest.tables_equal(a.limit(0), a.limit(0)).first().equal


def test_safe_write_replaces_and_keeps_on_failure(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    ingest.safe_write(spark.range(3), path)
    ingest.safe_write(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    digests = iter([[F.count(F.lit(1)).alias("n")], [F.lit(-1).alias("n"), F.count(F.lit(1)).alias("m")]])
    monkeypatch.setattr(ingest, "_digest", lambda df: next(digests))
    with pytest.raises(ValueError, match="verification"):
        ingest.safe_write(spark.range(9), path)
    assert spark.read.parquet(path).count() == 5
    assert [n for n in os.listdir(tmp_path) if "staging" in n] == []


def test_lineage_can_be_cut_after_a_verified_write(spark, tmp_path):
    ingest.safe_write(spark.range(3), str(tmp_path / "t"))
    assert cut_lineage(spark.range(4).where("id > 0")).count() == 3


def test_materialise_reuses_by_fingerprint(spark, tmp_path):
    path = str(tmp_path / "steps")
    assert ingest.materialise(spark.range(3), path, "a").count() == 3
    assert ingest.materialise(spark.range(9), path, "a").count() == 3
    assert ingest.materialise(spark.range(9), path, "b").count() == 9


def test_incremental_restart_takes_each_file_once(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put(src, "ras2000.parquet", PNR=["a"], V=[1])
    schema = spark.read.parquet(src).schema
    incremental_ingest(spark, src, out, state, schema)
    put(src, "ras2001.parquet", PNR=["b"], V=[2])
    put(src, "ind_2001.parquet", PNR=["c"], V=[3])
    incremental_ingest(spark, src, out, state, schema)
    incremental_ingest(spark, src, out, state, schema)
    got = spark.read.parquet(out)
    assert rows(got, "register", "year", "PNR") == [("ind", 2001, "c"), ("ras", 2000, "a"), ("ras", 2001, "b")]


def test_union_strict_and_lenient(spark):
    a = spark.createDataFrame([(1,)], "id int")
    b = a.withColumn("x", F.lit(1))
    assert union_registers([a, b]).columns == ["id", "x"]
    with pytest.raises(Exception):
        union_registers([a, b], strict=True).collect()


class FakeSession:
    """Just the settings ``scratch_dir`` looks at; the real one is fixed when a session starts."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: conf.get(key, default))})


def test_scratch_dir_is_in_the_shared_folder():
    shared = FakeSession("spark://host:7077", **{"spark.checkpoint.dir": "/shared/here/"})
    assert scratch_dir(shared, "x").startswith("/shared/here/x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession("spark://host:7077"), "x")
    assert os.path.isdir(scratch_dir(FakeSession("local[2]"), "x"))


def test_ingest_keeps_a_year_column_of_the_source(spark, tmp_path):
    src, out = tmp_path / "in", f"{tmp_path}/out"
    src.mkdir()
    spark.createDataFrame([("a", 1999)], "PNR string, year int").write.parquet(f"{src}/ras2000.parquet")
    spark.createDataFrame([("b", 1998, 7)], "PNR string, YEAR int, source_year int").write.parquet(f"{src}/ind2001.parquet")
    assert ingest.ingest_registers(spark, str(src), out) == ["ind", "ras"]
    assert rows(spark.read.parquet(f"{out}/registers/ras"), "PNR", "source_year", "year") == [("a", 1999, 2000)]
    assert rows(spark.read.parquet(f"{out}/registers/ind"), "PNR", "source_year", "source_year_", "year") == [("b", 7, 1998, 2001)]
