"""Queries that store tables, on executors apart from the driver and under a checkpoint folder named by a plain path."""

import json
import subprocess
import sys
import tempfile
from pathlib import Path

import pytest

STORING = [
    "accumulate_dims", "certificate_types", "check_certificates", "check_facts", "consolidated_day", "export_images", "export_products",
    "export_summary", "fact_certificates", "fact_dates", "fact_products", "fact_stats", "filings_from_html", "filings_from_pages",
    "id_collisions", "image_counters", "id_mismatch", "json_arrays", "landed_html", "landed_scan", "merge_published", "most_common_type",
    "page_certificates", "nested_columns_dropped",
]


def main(sf_dir: str, names: list[str]) -> None:
    """Print the difference from SQL, or the error, of each query as a JSON line."""
    sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]
    from pyspark.sql import SparkSession

    from cartouche.plans.catalog import QUERIES
    from cartouche.plans.oracle import ORACLES
    from compare import connect, difference

    spark = (
        SparkSession.builder.master("local-cluster[1,4,1500]")
        .config("spark.executor.memory", "1g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in names:
        try:
            found = difference(spark, connection, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as error:
            found = f"{type(error).__name__}: {error}"[:600]
        print(json.dumps([name, found]), flush=True)
    spark.stop()


@pytest.fixture(scope="module")
def found(sf_dir):
    work = tempfile.mkdtemp(prefix="spark-", dir="/tmp")  # a cluster's workers keep their logs where it is started
    done = subprocess.run([sys.executable, __file__, sf_dir, *STORING], cwd=work, capture_output=True, text=True, timeout=900)
    return dict(json.loads(line) for line in done.stdout.splitlines() if line.startswith('["'))


@pytest.mark.parametrize("name", STORING)
def test_matches_sql_on_a_cluster(found, name):
    assert found[name] is None


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
