"""Landing and reading many small files: dealt to all cores, listed and read in few tasks."""

from glob import glob

from pyspark.sql import functions as F

from cartouche.plans.catalog import QUERIES
from cartouche.sources import files, scratch

PAGES = 300


def landed(spark, tmp_path):
    """Pages of one folder out of a single partition, landed as HTML files."""
    pages = spark.range(PAGES, numPartitions=1).selectExpr(
        "'DETAIL' AS view", "date'2024-01-01' AS partition_date", "1 AS receipt_method",
        "lpad(id, 14, '2400100100000') AS filing_id", "concat('<p>', id) AS html")
    root = str(tmp_path / "html")
    files.land_html(pages, root)
    return root


def test_pages_of_one_partition_are_landed_by_many_tasks(spark, tmp_path):
    written = [path.rsplit("/", 1)[1].split("-")[1] for path in glob(f"{landed(spark, tmp_path)}/*/*/*/*/part-*")]
    assert len(written) == PAGES and len(set(written)) > 8


def test_listing_takes_few_tasks_and_leaves_the_session_as_it_was(spark, tmp_path):
    root, before = landed(spark, tmp_path), spark.conf.get(files.LISTING_TASKS)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        found = files.scan_landed_html(spark, root)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert stages and sum(s.numTasks for s in stages if s) <= 8 * files.LISTING_TASKS_A_CORE
    assert spark.conf.get(files.LISTING_TASKS) == before
    rows = {(r.filing_id, r.html) for r in found.collect()}
    assert len(rows) == PAGES and {h.strip() for _, h in rows} == {f"<p>{i}" for i in range(PAGES)}


def test_small_files_are_read_in_a_bounded_number_of_tasks(spark, tmp_path):
    root = landed(spark, tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # one file a task, as Spark plans it
    try:
        assert files.scan_landed_html(spark, root).rdd.getNumPartitions() <= files.small_file_tasks(spark) < PAGES
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_arrays_are_written_by_many_tasks(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_dir", lambda spark: str(tmp_path))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").coalesce(1).select("c_custkey", "c_name", "c_mktsegment")
    many = customers.withColumn("c_custkey", F.col("c_custkey") * 100)  # one customer a file
    many.write.parquet(str(tmp_path / "customer.parquet"))
    rows = QUERIES["json_arrays"](spark, str(tmp_path))
    written = [path.rsplit("/", 1)[1].split("-")[1] for path in glob(f"{tmp_path}/json-arrays-*/*/part-*")]
    assert len(written) == many.count() and len(set(written)) > 8
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, many.collect()))


def test_json_arrays_are_listed_and_read_in_few_tasks(spark, tmp_path):
    rows = spark.range(PAGES).withColumn("block", F.col("id"))
    files.write_json_arrays(rows, str(tmp_path / "arrays"), "block", F.struct("id"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # one file a task, as Spark plans it
    spark.sparkContext.setJobGroup("arrays", "arrays")
    try:
        found = files.scan_json(spark, str(tmp_path / "arrays"), "id BIGINT")
        assert found.rdd.getNumPartitions() <= files.small_file_tasks(spark) < PAGES
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("arrays") for s in tracker.getJobInfo(job).stageIds]
    assert stages and sum(s.numTasks for s in stages if s) <= 8 * files.LISTING_TASKS_A_CORE
    assert sorted(r.id for r in found.collect()) == list(range(PAGES))


def test_streams_read_a_table_of_many_files(spark, sf_dir, tmp_path):
    folder = str(tmp_path)
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).withColumn("lang", F.lit("01"))
    texts.repartition(3).write.parquet(f"{folder}/documents.parquet")
    (tmp_path / "documents.parquet_old").mkdir()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    got = QUERIES["stream_ingest"](spark, folder)
    assert got.count() == 40 and got.where("lang = '01'").count() == 40  # a folder's name is no number
    assert QUERIES["stream_dedup"](spark, folder).count() == events.select("user_id").distinct().count()


def test_stream_of_an_empty_table_is_empty(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["stream_ingest"](spark, str(tmp_path)).count() == 0
