"""Run and record statistics. Each report is one aggregation; nothing loops over sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the duration histogram, in seconds.
DURATION_BUCKETS = (0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0)


def recent_runs(runs: DataFrame, days: int | None = None, now: Column | None = None) -> DataFrame:
    """Optional look-back window of 1..90 days; None keeps every run."""
    if days is None:
        return runs
    if not 1 <= days <= 90:
        raise ValueError(f"days must be between 1 and 90: {days}")
    at = F.current_timestamp() if now is None else now
    return runs.filter(F.col("started_at") >= at - F.make_dt_interval(F.lit(days)))


def _zero_is_null(c: Column) -> Column:
    return F.when(c != 0, F.round(c, 2))


def run_summary(runs: DataFrame) -> DataFrame:
    """Counts, processed total, mean duration and the last success and failure times in one pass.
    A mean of exactly 0 shows as NULL."""
    ok = F.col("status") == "success"
    bad = F.col("status") == "failed"
    return runs.agg(
        F.count("*").alias("total_runs"),
        F.count_if(ok).alias("successful_runs"),
        F.count_if(bad).alias("failed_runs"),
        F.coalesce(F.sum("records_processed"), F.lit(0)).alias("total_records_processed"),
        _zero_is_null(F.avg("duration_seconds")).alias("average_duration_seconds"),
        F.max(F.when(ok, F.col("finished_at"))).alias("last_success_at"),
        F.max(F.when(bad, F.col("finished_at"))).alias("last_failure_at"),
    )


def last_outcomes(runs: DataFrame) -> DataFrame:
    """Only the last success and failure times."""
    return run_summary(runs).select("last_success_at", "last_failure_at")


def distinct_sources(unified: DataFrame) -> DataFrame:
    return unified.select("source").distinct()


def records_per_source(unified: DataFrame) -> DataFrame:
    return unified.groupBy("source").agg(F.count("*").alias("total_records"))


def latest_run_per_source(runs: DataFrame) -> DataFrame:
    newest = F.max_by(
        F.struct("started_at", "status", "duration_seconds", "records_processed"),
        F.struct("started_at", "run_id"),
    )
    return runs.groupBy("source").agg(newest.alias("r")).select(
        "source",
        F.col("r.started_at").alias("last_run_at"),
        F.col("r.status").alias("last_run_status"),
        F.col("r.duration_seconds").alias("last_run_duration_seconds"),
        F.col("r.records_processed").alias("last_records_processed"),
    )


def source_stats(unified: DataFrame, runs: DataFrame) -> DataFrame:
    """Record count and latest run per source; a source without runs shows NULLs. Both sides are
    aggregated to one row per source before they meet."""
    return records_per_source(unified).join(latest_run_per_source(runs), "source", "left")


def last_run_epoch(runs: DataFrame) -> DataFrame:
    seconds = F.unix_micros(F.max(F.col("started_at").cast("timestamp"))) / 1e6
    return runs.groupBy("source").agg(seconds.alias("last_run_timestamp"))


def runs_by_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source", "status").agg(F.count("*").alias("runs_total"))


def processed_by_source(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source").agg(
        F.coalesce(F.sum("records_processed"), F.lit(0)).alias("records_processed_total")
    )


def duration_histogram(runs: DataFrame, buckets: tuple[float, ...] = DURATION_BUCKETS) -> DataFrame:
    """Cumulative counts per source and upper bound, plus sum and count. All buckets are counted in
    one hash aggregation; only its one row per source is unfolded into lines."""
    value = F.col("duration_seconds")
    measured = runs.filter(value.isNotNull())
    counted = measured.groupBy("source").agg(
        F.array(*[F.count_if(value <= b) for b in buckets], F.count("*")).alias("counts"),
        F.sum(value.cast("decimal(38,6)")).cast("double").alias("duration_sum"),
        F.count("*").alias("duration_count"),
    )
    bounds = F.array(*[F.lit(f"{b:g}") for b in buckets], F.lit("+Inf"))
    lines = F.arrays_zip(bounds.alias("le"), F.col("counts").alias("cumulative"))
    return counted.select("source", "duration_sum", "duration_count", F.explode(lines).alias("b")).select(
        "source",
        F.col("b.le").alias("le"),
        F.col("b.cumulative").alias("cumulative_count"),
        "duration_sum",
        "duration_count",
    )
