"""Landed files and partitioned tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.operators.structure import fill_to_schema, project_to_schema

PARTITION_COLUMNS = ["view", "partition_date", "receipt_method"]
PAGES_A_FILE = 8192  # a page takes about a third of a millisecond to extract and compresses twentyfold
SMALL_FILE_TASKS = 32  # tasks a core for files that are opened one by one: Spark would plan one for every few files
LISTING_TASKS_A_CORE = 2
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def small_file_tasks(spark: SparkSession) -> int:
    return SMALL_FILE_TASKS * spark.sparkContext.defaultParallelism


@contextmanager
def listing_by(spark: SparkSession, tasks: int) -> Iterator[None]:
    """List folders in so many tasks; by default Spark takes a task for every folder."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(tasks))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def land_html(pages: DataFrame, root: str) -> None:
    """One HTML file per page: ``view=/partition_date=/receipt_method=/page=<id>/``; a page that lands again replaces its file.

    Making a file takes much longer than its bytes do, so pages are dealt to all cores by id, however few files they came
    from. The text writer ends a file with a line end.
    """
    layout = pages.select(*PARTITION_COLUMNS, F.col("filing_id").alias("page"), F.col("html").alias("value"))
    layout = layout.repartition(small_file_tasks(pages.sparkSession), *PARTITION_COLUMNS, "page")
    writer = layout.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTITION_COLUMNS, "page").text(root)


def scan_landed_html(spark: SparkSession, root: str, days: list[str] | None = None, views: list[str] | None = None) -> DataFrame:
    """Landed pages: one file per page under ``view=/partition_date=/receipt_method=``, as ``<id>.html`` or in ``page=<id>/``.

    Id and sequence from the path, size and time from the listing. A landed file was fetched, so there is no status code.
    With ``days`` only their folders are listed, so a daily run does not pay for the days before; a day that did not land is
    an error. Landing many small files is slow to list; compact them once with ``compact_days`` and scan Parquet from then on.
    """
    folders = [f"{root}/view={v}/partition_date={d}" for v in views or ["*"] for d in days or ["*"]]
    with listing_by(spark, LISTING_TASKS_A_CORE * spark.sparkContext.defaultParallelism):
        pages = spark.read.option("basePath", root).text(folders if days or views else root, wholetext=True)
    pages = pages.coalesce(small_file_tasks(spark))
    fid = F.regexp_extract(F.col("_metadata.file_path"), r"([0-9]{14,})(?:/[^/]*|\.html?)$", 1)
    return pages.select(
        fid.alias("filing_id"),
        F.substring(fid, 9, 12).try_cast("int").alias("sequence"),
        F.col("value").alias("html"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("size_bytes"),
        F.col("_metadata.file_modification_time").alias("fetched_at"),
        *[c for c in pages.columns if c not in ("value", "page")],
    )


def compact_days(spark: SparkSession, root: str, target: str, days: list[str] | None = None) -> dict:
    """Landed HTML files of the given days (null: all) as Parquet files of ``PAGES_A_FILE`` pages; a day that is compacted
    again replaces itself."""
    return write_landed(scan_landed_html(spark, root, days), target)


def scan_parquet(spark: SparkSession, root: str, day: str | None = None, views: list[str] | None = None) -> DataFrame:
    """Partitioned Parquet; the day and view filters prune directories."""
    frame = spark.read.parquet(root)
    if day is not None:
        frame = frame.where(F.col("partition_date") == F.lit(day).cast("date"))
    return frame if views is None else frame.where(F.col("view").isin(*views))


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files holding JSON arrays of records; many small ones are listed and read in few tasks."""
    with listing_by(spark, LISTING_TASKS_A_CORE * spark.sparkContext.defaultParallelism):
        records = spark.read.schema(schema).json(path, multiLine=True)
    return records.coalesce(small_file_tasks(spark))


def write_json_arrays(rows: DataFrame, path: str, file_key: str, record: Column) -> None:
    """One file with a JSON array of its records for each value of ``file_key``, in a folder of that value.

    Rows are dealt by the key to more tasks than their bytes ask for: making a file takes much longer than its bytes do.
    """
    dealt = rows.repartition(small_file_tasks(rows.sparkSession), file_key)
    dealt.groupBy(file_key).agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy(file_key).text(path)


READERS = {
    "parquet": lambda spark, path, schema: spark.read.parquet(path),
    "json": lambda spark, path, schema: spark.read.schema(schema).json(path),
    "csv": lambda spark, path, schema: spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True),
}


def read_table(spark: SparkSession, catalog: dict, name: str, day: str | None = None) -> DataFrame:
    """Table by name from a catalog ``{name: {"format", "path", "schema"}}``."""
    entry = catalog[name]
    frame = READERS[entry["format"]](spark, entry["path"], entry.get("schema"))
    return frame if day is None else frame.where(F.col("partition_date") == F.lit(day).cast("date"))


def rows_seen(seen: Observation) -> int:
    try:
        return seen.get["rows"]
    except Py4JJavaError:  # Spark drops the count along with a plan that it knows to be empty
        return 0


def write_parquet(
    frame: DataFrame, path: str, schema: T.StructType | None = None, partition_by: list[str] | None = None,
    complete: bool = False, rows_a_file: int | None = None,
) -> dict:
    """Schema-enforced Parquet write; returns rows written, columns and partitioning.

    Rows are counted while they are written (``Observation``), not in a second
    pass. With partition columns only the partitions present in ``frame`` are
    replaced. Rows are clustered by partition first; AQE splits a partition that
    is much larger than the rest. ``complete`` fills absent booleans with false.
    """
    shaped = frame
    if schema is not None:
        shaped = (fill_to_schema if complete else project_to_schema)(frame, schema)
    seen = Observation()
    writer_frame = shaped.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        writer_frame = writer_frame.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = writer_frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_a_file or 0)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return {
        "total_rows": rows_seen(seen),
        "columns": shaped.columns,
        "schema_fields": len(shaped.columns),
        "output_path": path,
        "partitioned": bool(partition_by),
        "partition_columns": partition_by or [],
    }


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes of a written dataset, from file metadata only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true"
    ).load(path)
    return files.agg(F.count("*").alias("files_written"), F.coalesce(F.sum("length"), F.lit(0)).alias("file_size_bytes"))


def write_landed(pages: DataFrame, path: str) -> dict:
    """Pages as Parquet in the ``view / partition_date / receipt_method`` layout."""
    return write_parquet(pages, path, partition_by=PARTITION_COLUMNS, rows_a_file=PAGES_A_FILE)


def write_json(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").json(path)


def _flat(field: T.StructField) -> Column:
    nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    return (F.to_json(field.name) if nested else F.col(field.name)).alias(field.name)


def flatten_for_csv(frame: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    return frame.select(*[_flat(f) for f in frame.schema.fields])


def write_csv(frame: DataFrame, path: str) -> None:
    flatten_for_csv(frame).write.mode("overwrite").csv(path, header=True, escape='"')


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name over all keys seen; absent ones null."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
