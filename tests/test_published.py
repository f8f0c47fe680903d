"""Published tables, landed files, outcomes of pages, and streams that are stopped half way."""

import os
from glob import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.constants import CERTIFICATE, DETAIL
from cartouche.plans.filings import with_outcome, write_outcomes
from cartouche.sources import files, published, scratch
from cartouche.streaming import ingest


def table_rows(spark, table):
    return sorted(tuple(r) for r in table.read(spark).collect())


def stored_files(path):
    return {f for f in glob(f"{path}/bucket=*/*.parquet")}


def test_a_merge_replaces_only_what_it_touches(spark):
    table = published.PublishedTable(scratch.fresh_path(spark, "t").removeprefix("file:"), ["id"], 8, "v")
    table.create(spark.range(200).select("id", F.lit(0).alias("v")))
    before = stored_files(table.path)
    delta = spark.createDataFrame([(7, 1), (7, 2), (500, 1)], "id long, v int")
    touched = table.merge(delta)
    after = stored_files(table.path)
    assert 1 <= len(touched) <= 2
    gone = {f.split("bucket=")[1].split("/")[0] for f in before - after}
    assert gone <= {str(t) for t in touched} and before & after == {f for f in before if f.split("bucket=")[1].split("/")[0] not in map(str, touched)}
    want = sorted([(i, 0) for i in range(200) if i != 7] + [(7, 2), (500, 1)])
    assert table_rows(spark, table) == want
    table.merge(delta)
    assert table_rows(spark, table) == want and table.merge(delta.limit(0)) == []


def test_a_merge_may_read_the_table_it_changes(spark):
    table = published.PublishedTable(scratch.fresh_path(spark, "t"), ["id"], 4, "v")
    table.create(spark.range(50).select("id", F.lit(0).alias("v")))
    table.merge(table.read(spark).where("id % 2 = 0").withColumn("v", F.col("v") + 1))
    assert table_rows(spark, table) == [(i, 1 - i % 2) for i in range(50)]


def test_a_stream_that_failed_publishes_the_same(spark, tmp_path):
    """The second micro-batch fails after its merge; started again, the stream repeats it and ends with the same table."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for i in range(4):
        spark.range(i * 5, i * 5 + 10).select("id", F.lit(i).alias("v")).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("id long, v int").option("maxFilesPerTrigger", 1).parquet(source)
    table = published.PublishedTable(str(tmp_path / "t"), ["id"], 4, "v")
    table.create(spark.createDataFrame([], "id long, v int").union(spark.range(3).select("id", F.lit(-1))))
    batches = []

    def fail_once(rows):
        batches.append(rows.count())
        if len(batches) == 2:
            table.merge(rows)
            raise RuntimeError("stopped between merge and commit")
        return rows

    with pytest.raises(Exception):
        table.follow(stream, checkpoint, fail_once).awaitTermination()
    table.follow(stream, checkpoint, fail_once).awaitTermination()
    assert len(batches) == 5  # the second batch ran twice
    assert {i for i, _ in table_rows(spark, table)} == set(range(25))


def test_days_and_growing_schemas(spark):
    path = scratch.fresh_path(spark, "days")
    narrow, wide = T.StructType.fromDDL("x INT, partition_date DATE"), T.StructType.fromDDL("x INT, y STRING, partition_date DATE")
    rows = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", None)], "x int, y string, partition_date string").withColumn(
        "partition_date", F.col("partition_date").cast("date"))
    files.write_parquet(rows, path, narrow, ["partition_date"])
    assert published.write_day(rows, path, "2024-01-02", wide)["total_rows"] == 1
    published.write_day(rows, path, "2024-01-02", wide)
    published.write_day(rows, path, "2024-03-01", wide)  # no such day
    got = sorted((r.x, r.y, str(r.partition_date)) for r in published.read_days(spark, path, wide).collect())
    assert got == [(1, None, "2024-01-01"), (2, "b", "2024-01-02"), (3, None, "None")]


def test_landed_days_are_listed_alone(spark, tmp_path):
    root, target = str(tmp_path / "in"), str(tmp_path / "out")
    pages = spark.createDataFrame(
        [(f"2400100100000{i}", DETAIL if i % 2 else CERTIFICATE, f"2024-01-0{1 + i % 3}", i % 4, f"<p>\n{i}</p>") for i in range(9)],
        "filing_id string, view string, partition_date string, receipt_method int, html string").withColumn("partition_date", F.col("partition_date").cast("date"))
    files.land_html(pages, root)
    one = files.scan_landed_html(spark, root, ["2024-01-02"], [DETAIL])
    assert one.inputFiles() and all("view=cola-detail/partition_date=2024-01-02" in f for f in one.inputFiles())
    got = sorted((r.filing_id, r.view, str(r.partition_date), r.receipt_method, r.html) for r in files.scan_landed_html(spark, root).collect())
    assert got == sorted((r.filing_id, r.view, str(r.partition_date), r.receipt_method, r.html + "\n") for r in pages.collect())
    for _ in range(2):
        files.compact_days(spark, root, target)
    assert files.scan_parquet(spark, target).count() == 9
    files.compact_days(spark, root, target, ["2024-01-03"])
    assert files.scan_parquet(spark, target, "2024-01-03").count() == 3 and files.scan_parquet(spark, target).count() == 9
    # a folder that no listing can make sense of, under another day: a daily run does not see it
    spoiled = tmp_path / "in" / "view=cola-detail" / "partition_date=2024-01-03" / "other=1"
    spoiled.mkdir()
    (spoiled / "x.txt").write_text("x")
    assert files.scan_landed_html(spark, root, ["2024-01-02"]).count() == 3
    with pytest.raises(Exception, match="(?i)conflicting"):
        files.scan_landed_html(spark, root).count()


def test_outcomes_add_up(spark, tmp_path):
    page = lambda i, v, s, html, status=200: (i, v, s, html, status)
    rows = [
        page("1", DETAIL, 1, "a"), page("1", DETAIL, 2, "b"), page("1", CERTIFICATE, 1, "c"), page(None, DETAIL, 1, "d"), page("", "x", 1, ""),
        page("2", None, 1, "e"), page("3", "x", 1, "f"), page("4", DETAIL, 1, "g", 404), page("4", DETAIL, 2, None), page("5", DETAIL, 1, "g", None),
        page("6", DETAIL, 1, "sorry"),
    ] + [page(None, DETAIL, 1, "d")] * 50
    frame = spark.createDataFrame(rows, "filing_id string, view string, sequence int, html string, status_code int")
    sorry = frame.where("html = 'sorry'").select(F.sha2("html", 256)).first()[0]
    marked = write_outcomes(frame, str(tmp_path / "o"), [sorry])
    got = {(r.filing_id, r.sequence, r.html): (r.outcome, r.extraction_errors) for r in marked.collect()}
    assert marked.count() == len(rows) and got["1", 2, "b"] == ("kept", []) and got["1", 1, "a"] == ("replaced", []) and got["1", 1, "c"] == ("kept", [])
    assert got["", 1, ""] == ("unreadable", ["No html", "Unknown data type: x", "No filing id"])
    assert [got[k][0] for k in ((None, 1, "d"), ("2", 1, "e"), ("3", 1, "f"), ("4", 1, "g"), ("4", 2, None), ("5", 1, "g"), ("6", 1, "sorry"))] == [
        "no_id", "unreadable", "unknown_view", "not_fetched", "unreadable", "not_fetched", "error_page"]
    assert {os.path.basename(p) for p in glob(str(tmp_path / "o/outcome=*"))} >= {"outcome=kept", "outcome=replaced"}
    plan = marked.where("outcome = 'kept'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan
    assert with_outcome(frame.limit(0)).count() == 0


def test_dedup_survives_a_restart(spark, tmp_path):
    """Stopped between two micro-batches and started again, the dedup finds its keys in the changelog of the state store."""
    source, checkpoint, out = (str(tmp_path / n) for n in ("in", "checkpoint", "out"))
    rows = lambda ids, day: spark.createDataFrame([(str(i), f"2024-01-0{day}") for i in ids], "filing_id string, fetched_at string").withColumn(
        "fetched_at", F.col("fetched_at").cast("timestamp")).coalesce(1)
    rows(range(10), 1).write.mode("append").parquet(source)
    start = lambda: ingest.land_batches(ingest.dedup_ids(spark.readStream.schema("filing_id string, fetched_at timestamp").parquet(source)), out, checkpoint)
    start().awaitTermination()
    rows(range(5, 15), 1).write.mode("append").parquet(source)
    start().awaitTermination()
    landed = spark.read.parquet(out)
    assert sorted(int(r.filing_id) for r in landed.collect()) == list(range(15))
    assert glob(f"{checkpoint}/state/0/0/*.changelog") and ingest.STATE_STORE.rsplit(".", 1)[1] == "RocksDBStateStoreProvider"
