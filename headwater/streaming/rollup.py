"""Incremental application rollup: events in, latest state per application out.

Each trigger aggregates its own events per application and property key and logs
the rows as a run of its own (see :mod:`headwater.streaming.runs`). No state store is kept: all measures are
maxima and sums, so the rows of any number of triggers merge exactly, whenever their
events arrive and however long an application has been quiet. A repeated trigger
replaces its run, so nothing counts twice. Runs are merged level by level, which keeps the log short.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headwater import schemas as S
from headwater.streaming.runs import RunLog

ENTRY = "array<struct<key:string,value:string>>"
LOG = (
    "app_id string, key string, last_ms bigint, end_ms bigint, n_failed bigint, has_ended boolean, "
    "failure struct<ms:bigint,job_id:bigint,message:string>, setting struct<ms:bigint,job_id:bigint,value:string>"
)
# So many runs of one size are merged into one.
FAN = 8


def partial_rows(events: DataFrame) -> DataFrame:
    """One row per application with a NULL key for its run, and one per property key.

    The last failure and the last value are kept with the time that orders them, so
    rows of several batches can be merged.
    """
    is_sql = (F.col("event") == S.JOB_START) & F.try_element_at("properties", F.lit(S.EXECUTION_ID_KEY)).isNotNull()
    of_run = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
    properties = F.when(is_sql, F.map_entries("properties").cast(ENTRY)).otherwise(F.array().cast(ENTRY))
    rows = events.select(
        "app_id", "event", "event_ms", "job_id", "result", "error_message",
        F.explode(F.concat(of_run.cast(ENTRY), properties)).alias("entry"),
    )
    is_run = F.col("entry.key").isNull()
    ended = is_run & (F.col("event") == S.JOB_END)
    failed = ended & (F.col("result") == S.JOB_FAILED)
    order = [F.col("event_ms").alias("ms"), "job_id"]
    return rows.groupBy("app_id", F.col("entry.key").alias("key")).agg(
        F.max("event_ms").alias("last_ms"),
        F.max(F.when(ended, F.col("event_ms"))).alias("end_ms"),
        F.count_if(failed).alias("n_failed"),
        F.max(is_run & (F.col("event") == S.APP_END)).alias("has_ended"),
        F.max(F.when(failed, F.struct(*order, F.col("error_message").alias("message")))).alias("failure"),
        F.max(F.when(~is_run, F.struct(*order, F.col("entry.value").alias("value")))).alias("setting"),
    )


def merge_rows(rows: DataFrame) -> DataFrame:
    """Rows of several batches as one row per application and key."""
    return rows.groupBy("app_id", "key").agg(
        F.max("last_ms").alias("last_ms"),
        F.max("end_ms").alias("end_ms"),
        F.sum("n_failed").alias("n_failed"),
        F.max("has_ended").alias("has_ended"),
        F.max("failure").alias("failure"),
        F.max("setting").alias("setting"),
    )


def log_of(spark: SparkSession, path: str) -> RunLog:
    return RunLog(spark, f"{path}/log", LOG)


def read_rollup(
    spark: SparkSession, path: str, upto: int | None = None, buckets: Sequence[int] | None = None
) -> DataFrame:
    """The state per application and key, now or after the trigger ``upto``, of all applications or of some buckets.

    A state that merged runs no longer tell raises ``LookupError``.
    """
    return merge_rows(log_of(spark, path).read(upto, buckets))


def compact_rollup(spark: SparkSession, path: str, upto: int | None = None) -> bool:
    """Merge all runs of the log into one; false if there is nothing to merge."""
    return log_of(spark, path).merge_all(merge_rows, upto) is not None


def stream_rollup(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = True, compact_every: int = FAN
) -> StreamingQuery:
    """Fold an event stream into the log below ``path``; ``compact_every`` runs of one size become one."""

    def store(batch: DataFrame, number: int) -> None:
        log = log_of(batch.sparkSession, path)
        log.write(partial_rows(batch), number)
        # one trigger behind, so that this one may be repeated
        log.compact(compact_every, merge_rows, number - 1)

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def apps_of(state: DataFrame) -> DataFrame:
    """Run columns per application, as the batch ``run_status`` gives them."""
    return state.where(F.col("key").isNull()).select(
        "app_id",
        F.coalesce("end_ms", F.lit(0)).alias("end_ms"),
        "n_failed",
        F.col("failure.message").alias("status_reason"),
        F.when(F.col("n_failed") > 0, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
    )


def metadata_of(state: DataFrame) -> DataFrame:
    """Property values per application and key, as the batch ``merge_metadata`` gives them."""
    return state.where(F.col("key").isNotNull()).select("app_id", "key", F.col("setting.value").alias("value"))
