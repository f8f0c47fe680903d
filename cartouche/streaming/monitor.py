"""Hourly run health and failed-check rollups.

The functions take a static or a streaming frame. On a stream the watermark drops
windows' state once they close; in update mode a drained run also gives the windows
that are still open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.functions.numbers import percent

WINDOW = "1 hour"
LATENESS = "10 minutes"


def run_health(runs: DataFrame, window: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    """Runs, failures and success share per window, from ``ts, is_success, is_failure``."""
    return (
        runs.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window).alias("w"))
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if("is_failure").alias("failed_runs"),
            F.count_if("is_success").alias("successful_runs"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "total_runs",
            "failed_runs",
            "successful_runs",
            percent(F.col("successful_runs"), F.col("total_runs")).alias("success_rate"),
        )
    )


def _alert(kind: str, severity: Column, message: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), severity.alias("severity"), message.alias("message"))


def health_alerts(health: DataFrame) -> DataFrame:
    """Alert rows: any failed run (high above two), and a success share under 80 % from five runs on."""
    failed, total, rate = F.col("failed_runs"), F.col("total_runs"), F.col("success_rate")
    failures = _alert(
        "run_failures",
        F.when(failed > 2, "high").otherwise("medium"),
        F.concat(failed.cast("string"), F.lit(" pipeline runs failed in the last hour")),
    )
    low = _alert(
        "low_success_rate",
        F.lit("high"),
        F.concat(F.lit("pipeline success rate dropped to "), F.format_string("%.1f", F.bround(rate, 1)), F.lit("%")),
    )
    alerts = F.array_compact(F.array(F.when(failed > 0, failures), F.when((rate < 80) & (total >= 5), low)))
    return health.select("window_start", F.inline(alerts))


def check_rollup(results: DataFrame, window: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    """Failed checks per window and severity, from ``ts, severity, passed``."""
    failed = results.where(~F.col("passed") & F.col("severity").isin("ERROR", "WARN"))
    return (
        failed.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window).alias("w"), "severity")
        .agg(F.count("*").alias("failed_checks"))
        .select(F.col("w.start").alias("window_start"), "severity", "failed_checks")
    )


def alert_report(alerts: DataFrame) -> DataFrame:
    """Alerts per severity and window, for a static alert table."""
    count = lambda s: F.count_if(F.col("severity") == s).alias(f"{s}_alerts")
    return alerts.groupBy("window_start").agg(count("high"), count("medium"), count("low"))
