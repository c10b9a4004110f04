"""Event routing and the matching of jobs to plans and RDD graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater import schemas as S


def classify_jobs(events: DataFrame) -> DataFrame:
    """Job starts as ``sql`` (with an execution id) or ``rdd`` jobs."""
    key = F.try_element_at("properties", F.lit(S.EXECUTION_ID_KEY))
    return events.where(F.col("event") == S.JOB_START).select(
        "app_id",
        "job_id",
        "event_ms",
        F.when(key.isNotNull(), F.lit("sql")).otherwise(F.lit("rdd")).alias("job_kind"),
        key.try_cast("bigint").alias("execution_id"),
        "properties",
    )


def sql_triggers(events: DataFrame) -> DataFrame:
    """Distinct SQL executions, named by an execution start or by a job start."""
    started = events.where(F.col("event") == S.SQL_START).select("app_id", "execution_id")
    from_jobs = classify_jobs(events).where(F.col("job_kind") == "sql").select("app_id", "execution_id")
    return (
        started.unionByName(from_jobs)
        .where(F.col("execution_id").isNotNull())
        .dropDuplicates(["app_id", "execution_id"])
    )


def with_plans(triggers: DataFrame, plan_nodes: DataFrame, *more: str) -> DataFrame:
    """Plan nodes of triggered executions, with ``more`` columns of the triggers; Spark splits a very large plan's share of the join."""
    keys = ["app_id", "execution_id"]
    return plan_nodes.join(triggers.select(*keys, *more), keys)


def skipped(triggers: DataFrame, plan_nodes: DataFrame) -> DataFrame:
    """Triggers without a plan."""
    keys = ["app_id", "execution_id"]
    return triggers.join(plan_nodes.select(*keys).distinct(), keys, "left_anti")


def with_rdd_job(events: DataFrame, rdd_nodes: DataFrame) -> DataFrame:
    """RDD nodes of started RDD jobs; jobs without a graph have no lineage."""
    keys = ["app_id", "job_id"]
    jobs = classify_jobs(events).where(F.col("job_kind") == "rdd").select(*keys).distinct()
    return rdd_nodes.join(jobs, keys)


def resolved_only(items: DataFrame) -> DataFrame:
    """Items that have a name."""
    return items.where(F.col("name").isNotNull())
