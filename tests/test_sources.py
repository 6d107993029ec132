import os

import pytest
from pyspark.sql import types as T

from ontime.functions.values import NA_TOKENS, convert, known_text
from ontime.schema import RAW_NAMES
from ontime.session import fresh_dir
from ontime.sources import csv, parquet

SMALL = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("d", T.DateType())]
)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_tokens_and_numbers(spark):
    df = spark.createDataFrame([(t,) for t in [*NA_TOKENS, " NA ", "x", "5", "5.0", "5.5"]], "t string")
    known = [r[0] for r in df.select(known_text("t")).collect()]
    assert known == [None] * (len(NA_TOKENS) + 1) + ["x", "5", "5.0", "5.5"]
    assert [r[0] for r in df.select(convert("t", T.DoubleType())).collect()][-4:] == [None, 5.0, 5.0, 5.5]
    assert [r[0] for r in df.select(convert("t", T.IntegerType())).collect()][-4:] == [None, 5, 5, None]


def test_years_with_different_headers(spark, tmp_path):
    put(f"{tmp_path}/2009/a.csv", "name,x,d,Unnamed: 3\nann,1,2009-01-01,\nbob,NA,2009-13-01,\n")
    put(f"{tmp_path}/2010/a.csv", "d,name\n2010-02-03,null\n")
    got = rows(csv.ingest(spark, [f"{tmp_path}/2009", f"{tmp_path}/2010"], SMALL))
    import datetime as dt

    assert got == sorted([("ann", 1.0, dt.date(2009, 1, 1)), ("bob", None, None), (None, None, dt.date(2010, 2, 3))], key=str)


def test_unlike_headers_in_one_folder(spark, tmp_path):
    put(f"{tmp_path}/2009.csv", "name,x,Unnamed: 2\nann,1,\n")
    put(f"{tmp_path}/2010.csv", "x,name\n2,bob\n")
    put(f"{tmp_path}/2011.csv", "name\ncal\n")
    layout = T.StructType(SMALL.fields[:2])
    assert rows(csv.ingest(spark, [str(tmp_path)], layout)) == [("ann", 1.0), ("bob", 2.0), ("cal", None)]
    text = csv.read_text(spark, str(tmp_path), file_column="file")
    counts = csv.rows_per_file(text, csv.list_files(spark, str(tmp_path)), "file")
    assert sorted(r.n for r in counts.collect()) == [1, 1, 1]


def test_one_scan_for_each_header(spark, tmp_path):
    for i in range(6):
        put(f"{tmp_path}/{i}.csv", ("name,x\nann,1\n", "x,name\n1,ann\n")[i % 2])
    df = csv.read_text(spark, str(tmp_path))
    assert df.count() == 6
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def test_files_that_cannot_be_read_are_reported(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "name,x\nann,1\nbob\n")
    put(f"{tmp_path}/b.csv.gz", "this is no gzip\n")
    put(f"{tmp_path}/c.csv", "\n")
    with pytest.raises(ValueError, match="b.csv.gz"):
        csv.read_text(spark, str(tmp_path), pattern="*.csv*")
    report = {r.path.rsplit("/")[-1]: r for r in csv.file_report(spark, str(tmp_path), "*.csv*").collect()}
    assert (report["a.csv"].n, report["a.csv"].n_malformed, report["a.csv"].reason) == (2, 1, None)
    assert report["b.csv.gz"].n == 0 and "gzip" in report["b.csv.gz"].reason
    assert report["c.csv"].reason == "no header line"


def test_doubled_quotes_and_line_breaks(spark, tmp_path):
    put(f"{tmp_path}/a/a.csv", 'name,x\n"x, ""y"" z",1\n')
    layout = T.StructType(SMALL.fields[:2])
    assert rows(csv.ingest(spark, [f"{tmp_path}/a"], layout)) == [('x, "y" z', 1.0)]
    put(f"{tmp_path}/b/b.csv", 'name,x\n"two\nlines",1\n')
    assert rows(csv.ingest(spark, [f"{tmp_path}/b"], layout, multi_line=True)) == [("two\nlines", 1.0)]
    df = spark.createDataFrame([("two\nlines", 1.0)], "name string, x double")
    with pytest.raises(Exception, match="line break"):
        csv.write(df, f"{tmp_path}/c")
    csv.write(df, f"{tmp_path}/d", multi_line=True)
    assert rows(csv.ingest(spark, [f"{tmp_path}/d"], layout, multi_line=True)) == rows(df)


def test_malformed_rows_by_choice(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "name,x\nann,1\nbob\ncal,3,4\n")
    layout = T.StructType(SMALL.fields[:2])
    take = lambda choice: csv.ingest(spark, [str(tmp_path)], layout, on_malformed=choice)
    assert rows(take("keep")) == [("ann", 1.0), ("bob", None), ("cal", 3.0)]
    assert rows(take("drop")) == [("ann", 1.0)]
    assert rows(take("mark")) == [("ann", 1.0, None), ("bob", None, "bob"), ("cal", 3.0, "cal,3,4")]
    with pytest.raises(Exception, match="malformed row"):
        take("fail").collect()
    with pytest.raises(ValueError):
        take("other")


def test_no_year_is_no_row(spark):
    path = fresh_dir(spark, "test")
    df = spark.createDataFrame([("2009-01-01", 1)], "FL_DATE string, n int")
    parquet.write_years(df, path)
    assert parquet.read_years(spark, path, df.schema, []).count() == 0


def test_no_files(spark, tmp_path):
    put(f"{tmp_path}/notes.txt", "x\n")
    with pytest.raises(ValueError):
        csv.read_text(spark, str(tmp_path))
    with pytest.raises(ValueError):
        csv.ingest(spark, [])


def test_only_headers_is_an_error(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "name,x,d\n")
    with pytest.raises(ValueError):
        parquet.csv_to_years(spark, [str(tmp_path)], f"{tmp_path}/out", SMALL)


def test_malformed_rows_are_kept_and_counted(spark, tmp_path):
    put(f"{tmp_path}/y=1/a.csv", "name,x\nann,1\nbob\ncal,3,4\n")
    put(f"{tmp_path}/y=2/b.csv", "name,x\ndan,4\n")
    text = csv.read_text(spark, str(tmp_path))
    assert text.count() == 4
    got = {r.dataset: (r.n, r.n_malformed) for r in csv.row_report(text).collect()}
    assert got == {"y=1": (3, 2), "y=2": (1, 0)}


def test_files_without_rows_are_listed(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "name,x\nann,1\n")
    put(f"{tmp_path}/b.csv", "name,x\n")
    counts = csv.rows_per_file(csv.read_text(spark, str(tmp_path)), csv.list_files(spark, str(tmp_path)))
    assert {r.path.rsplit("/")[-1]: r.n for r in counts.collect()} == {"a.csv": 1, "b.csv": 0}


def test_csv_writing(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1.0), ('say "hi"', None), (None, 2.5)], "name string, x double")
    csv.write(df.repartition(3), f"{tmp_path}/many")
    csv.write(df.repartition(3), f"{tmp_path}/one", one_file=True)
    assert csv.list_files(spark, f"{tmp_path}/one").count() == 1
    layout = T.StructType(SMALL.fields[:2])
    # Quotes inside quotes are read back as written.
    assert rows(csv.ingest(spark, [f"{tmp_path}/many"], layout)) == rows(df) == rows(csv.ingest(spark, [f"{tmp_path}/one"], layout))


def test_inferred_types(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "n,x,t\n1,1.5,a\n2,2.5,b\n")
    assert dict(csv.infer(spark, str(tmp_path)).dtypes) == {"n": "int", "x": "double", "t": "string"}


def test_parquet_years_with_other_types(spark, tmp_path):
    spark.createDataFrame([("a", 1, "x")], "name string, x long, junk string").write.parquet(f"{tmp_path}/2009")
    spark.createDataFrame([(float("nan"),)], "x double").write.parquet(f"{tmp_path}/2010")
    got = rows(parquet.read_conformed(spark, [f"{tmp_path}/2009", f"{tmp_path}/2010"], T.StructType(SMALL.fields[:2])))
    assert got == [("a", 1.0), (None, None)] or got == [(None, None), ("a", 1.0)]


def test_years_are_pruned(spark):
    path = fresh_dir(spark, "test")
    df = spark.createDataFrame([("2009-01-01", 1), ("2010-01-01", 2), ("bad", 3)], "FL_DATE string, n int")
    parquet.write_years(df, path)
    back = parquet.read_years(spark, path, df.schema)
    assert rows(back.select("n", "year")) == [(1, 2009), (2, 2010), (3, None)]
    one = parquet.read_years(spark, path, df.schema, [2010]).select("n")
    assert rows(one) == [(2,)]
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "year#" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_flights_read_only_the_columns_in_use(spark):
    from ontime.plans.flights import flights

    plan = flights(spark, "/root/testdata/sf0.001").select("ORIGIN", "DISTANCE")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<ORIGIN:string,DISTANCE:double>" in plan


def test_flights_table_is_rewritten_when_cleared(spark, tmp_path):
    from ontime.plans import flights as FL

    key = (spark.sparkContext.applicationId, "/root/testdata/sf0.001", "flights")
    FL.stored_path(spark, key[1])
    FL._stored[key] = f"{tmp_path}/gone"
    assert FL.flights(spark, key[1]).columns == RAW_NAMES
    assert FL._stored[key] != f"{tmp_path}/gone"
