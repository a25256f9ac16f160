"""Run-to-run comparison with anomaly rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.operators.ordered import with_previous
from recordloom.operators.validate import messages

# Thresholds.
DURATION_LIMIT_PCT = 50
RECORDS_LIMIT_PCT = 20
FAILURE_SHARE = 0.1

COMPARED = ("run_id", "status", "duration_seconds", "records_processed", "records_failed")


def duration_diff(d1: Column, d2: Column) -> Column:
    """Rounded difference; NULL when either duration is NULL or 0."""
    return F.when((d1 != 0) & (d2 != 0), F.round(d1 - d2, 2))


def _percent_text(label: str, pct: Column) -> Column:
    return F.format_string(f"{label}: %.1f%%", F.bround(pct, 1))


def duration_anomaly(diff: Column, d2: Column) -> Column:
    pct = F.try_divide(F.abs(diff), d2) * 100
    over = (diff != 0) & (d2 != 0) & (pct > DURATION_LIMIT_PCT)
    return F.when(over, _percent_text("Duration difference", pct))


def records_anomaly(diff: Column, p2: Column) -> Column:
    pct = F.try_divide(F.abs(diff), p2) * 100
    over = (diff != 0) & (p2 != 0) & (pct > RECORDS_LIMIT_PCT)
    return F.when(over, _percent_text("Record count difference", pct))


def status_anomaly(s1: Column, s2: Column) -> Column:
    return F.when(s1 != s2, F.concat(F.lit("Status changed: "), s2, F.lit(" -> "), s1))


def failure_anomaly(run_no: int, failed: Column, processed: Column) -> Column:
    text = F.concat(
        F.lit(f"High failure rate in run {run_no}: "), failed.cast("string"), F.lit(" failed")
    )
    return F.when(failed > processed * FAILURE_SHARE, text)


def compare_columns(one: str, two: str) -> dict[str, Column]:
    """Comparison of two run structs: differences and the ordered anomaly list."""

    def pair(name: str) -> tuple[Column, Column]:
        return F.col(f"{one}.{name}"), F.col(f"{two}.{name}")

    d1, d2 = pair("duration_seconds")
    p1, p2 = pair("records_processed")
    f1, f2 = pair("records_failed")
    s1, s2 = pair("status")
    dur = duration_diff(d1, d2)
    rec = p1 - p2
    rules = [
        duration_anomaly(dur, d2),
        records_anomaly(rec, p2),
        status_anomaly(s1, s2),
        failure_anomaly(1, f1, p1),
        failure_anomaly(2, f2, p2),
    ]
    return {
        "duration_diff_seconds": dur,
        "records_diff": rec,
        "anomalies": messages(rules),
    }


def compare_pairs(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Compare every (run_id_1, run_id_2) of ``pairs``; a pair with an unknown id shows it in
    ``not_found``. Two equi-joins on the unique run id, no hints: sizes decide."""
    side = runs.select(F.struct(*COMPARED).alias("r"))
    one = side.select(F.col("r.run_id").alias("run_id_1"), F.col("r").alias("one"))
    two = side.select(F.col("r.run_id").alias("run_id_2"), F.col("r").alias("two"))
    joined = pairs.join(one, "run_id_1", "left").join(two, "run_id_2", "left")
    missing = F.when(F.col("one").isNull(), F.col("run_id_1")).when(
        F.col("two").isNull(), F.col("run_id_2")
    )
    compared = joined.withColumns({"not_found": missing, **compare_columns("one", "two")})
    return compared.select(
        "run_id_1", "run_id_2", "duration_diff_seconds", "records_diff",
        F.when(F.col("not_found").isNull(), F.col("anomalies")).alias("anomalies"), "not_found",
    )


def compare_runs(runs: DataFrame, run_id_1: str, run_id_2: str) -> DataFrame:
    """Compare two runs by id; raises LookupError naming an unknown id. Both rows come from one
    filtered scan whose id condition reaches the files."""
    row = F.struct(*COMPARED)
    found = runs.filter(F.col("run_id").isin(run_id_1, run_id_2)).agg(
        F.first(F.when(F.col("run_id") == run_id_1, row), ignorenulls=True).alias("one"),
        F.first(F.when(F.col("run_id") == run_id_2, row), ignorenulls=True).alias("two"),
    )
    known = found.select(F.col("one").isNotNull(), F.col("two").isNotNull()).first()
    for run_id, there in zip((run_id_1, run_id_2), known):
        if not there:
            raise LookupError(f"Run not found: {run_id}")
    return found.withColumns(compare_columns("one", "two"))


def compare_consecutive(runs: DataFrame) -> DataFrame:
    """Each run against the previous one of its source (NULLs for a source's first run).

    Sources are few and hot, so the previous run comes from the chunked operator and not from a
    window that would sort a whole source in one task.
    """
    paired = with_previous(
        runs.select("source", "started_at", *COMPARED), "source", ["started_at", "run_id"], list(COMPARED)
    )
    return paired.withColumn("current", F.struct(*COMPARED)).select(
        "source",
        "run_id",
        F.col("previous.run_id").alias("previous_run_id"),
        *[
            (F.when(F.col("previous").isNotNull(), c) if n == "anomalies" else c).alias(n)
            for n, c in compare_columns("current", "previous").items()
        ],
    )
