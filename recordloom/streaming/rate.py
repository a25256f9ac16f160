"""Token bucket over a stream of requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.rate import BURST, PER_MINUTE, bucket_state, token_admission
from recordloom.operators.upsert import versioned
from recordloom.plans.tables import LogTable


def drain_admission(
    requests: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str],
    output: str,
    checkpoint: str,
    per_minute: int = PER_MINUTE,
    burst: int = BURST,
) -> None:
    """Admit or deny everything that has arrived and stop; results go to ``output``.

    A keyed stream operator would run a hot key's whole micro-batch in one task. Here each
    micro-batch goes through the chunked replay, and the buckets between batches are a table next to
    the output. Batch ``n`` reads the buckets of the batches before it and writes its own commit, so a
    repeated batch gives the same result. ``requests`` should be limited per trigger and arrive in
    time order.
    """
    results = f"{output}/admitted"
    buckets = LogTable(f"{output}/buckets", [key], ["tokens", "last_at"])

    def write(batch: DataFrame, batch_no: int) -> None:
        spark = batch.sparkSession
        try:
            state = buckets.current(spark, before=batch_no).select(key, "tokens", "last_at")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            state = None
        admitted = token_admission(batch, key, ts, tiebreak, per_minute, burst, state=state)
        (
            admitted.withColumn("commit", F.lit(batch_no).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("commit")
            .parquet(results)
        )
        stored = spark.read.parquet(results).filter(F.col("commit") == batch_no)
        after = bucket_state(stored, key, ts, tiebreak).withColumn("seq", F.lit(batch_no).cast("bigint"))
        buckets.append(versioned(after), "buckets", batch_no)

    query = (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
