"""What must not move or pile up as tables grow."""

from pyspark.sql import functions as F

from ontime.plans import flights as T
from ontime.sources import csv, ingest, parquet

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_key_columns_are_gathered_by_year(spark):
    made = plan(T.derive(spark, SF))
    assert "RebalancePartitions" in made
    gathered = made.split("RebalancePartitions", 1)[1].splitlines()[1]
    assert "l_shipdate" in gathered and "more fields" not in gathered and "n_name" not in gathered


def test_texts_of_the_stored_flights_are_not_stored_again(spark):
    T.flights(spark, SF)
    before = dict(T._stored)
    text = T.flights_text(spark, SF, ["year"])
    assert T._stored == before
    assert text.count() == T.flights(spark, SF).count()
    assert {f.dataType.simpleString() for f in text.drop("year").schema} == {"string"}


def writes(spark, monkeypatch, *modules):
    """The plans that are written from here on."""
    seen, real = [], parquet.write_years

    def spied(df, path, date="FL_DATE", mode="overwrite", gather=True):
        seen.append(gather)
        real(df, path, date, mode, gather)

    for m in modules:
        monkeypatch.setattr(m, "write_years", spied)
    return seen


def test_new_files_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    seen = writes(spark, monkeypatch, ingest)
    rows = T.flights_text(spark, SF, ["year"])
    for odd in (0, 1):
        csv.write(rows.where(F.col("year") % 2 == odd), f"{tmp_path}/in", ["year"], mode="append")
        ingest.ingest_new(spark, f"{tmp_path}/in", ingest.Table(f"{tmp_path}/table"))
    assert seen == [False, False]
    assert ingest.Table(f"{tmp_path}/table").read(spark).count() == rows.count()


def test_a_write_by_year_holds_no_sort_of_whole_rows(spark, tmp_path):
    """As many years as a task may meet, and more."""
    for years in (7, 40):
        rows = spark.range(400).selectExpr("id", f"CAST(1990 + id % {years} AS INT) AS year").coalesce(1)
        parquet.write_years(rows, f"{tmp_path}/{years}", gather=False)
        back = spark.read.parquet(f"{tmp_path}/{years}")
        assert back.exceptAll(rows).isEmpty() and back.count() == 400
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_first_lines_are_read_split_by_split(spark, tmp_path):
    """A large file is not read by one task, and its header is read once for a report."""
    rows = spark.range(3000).selectExpr("id", "concat('text ', id) AS t")
    csv.write(rows.coalesce(1), f"{tmp_path}/a")
    (path,) = [r.path for r in csv.list_files(spark, f"{tmp_path}/a").collect()]
    calls, real = [], csv.first_lines
    csv.first_lines = lambda s, p: calls.append(p) or real(s, p)
    context, before = spark.sparkContext, spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        context.setJobGroup("first-lines", "first lines")
        assert real(spark, [path]) == {csv.plain(path): "id,t"}
        (job,) = context.statusTracker().getJobIdsForGroup("first-lines")
        stage = context.statusTracker().getStageInfo(context.statusTracker().getJobInfo(job).stageIds[0])
        assert stage.numTasks > 5
        context.setJobGroup("other", "other")
        assert [r.n for r in csv.file_report(spark, f"{tmp_path}/a").collect()] == [3000]
    finally:
        csv.first_lines = real
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(calls) == 1


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    from ontime.plans import stores

    seen, real = [], stores.write_bucketed
    monkeypatch.setattr(stores, "write_bucketed", lambda df, keys, buckets: seen.append(buckets) or real(df, keys, buckets))
    n, counts = T.flights(spark, SF).count(), set()
    for rows, wanted in ((1_000_000, 8), (500, -(-n // 500))):
        monkeypatch.setattr(stores, "BUCKET_ROWS", rows)
        counts.add(stores.prediction_join_bucketed(spark, SF).count())
        assert seen[-2:] == [wanted, wanted]
    assert len(counts) == 1


def test_a_stream_of_many_tasks_is_not_dealt_again(spark, monkeypatch):
    from ontime.plans import flow

    rows = T.flights(spark, SF, T.KEY)
    seen, real = [], flow.X.source
    monkeypatch.setattr(flow.X, "source", lambda s, f, o, layout: seen.append((o["maxFilesPerTrigger"], spark.read.parquet(o["path"]).inputFiles())) or real(s, f, o, layout))
    monkeypatch.setattr(flow, "flights", lambda *_: rows.repartition(12))
    found = flow.stream_two_sinks(spark, SF)
    assert seen[0][0] == "4" and len(seen[0][1]) == 12
    assert found.where("n_table = 1 AND n_outbox = 1 AND same").count() == flow.messages(rows).count() > 0
