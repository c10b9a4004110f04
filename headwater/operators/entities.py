"""Lineage documents: job and run entities, their entries, envelopes, and the edge table.

An application has one layout whatever its size: a head document with the job and
its run, and one entry for each dataset and property. Nothing gathers the entries
of an application, so it may have any number of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from headwater.functions.names import spark_name
from headwater.functions.scalars import ms_to_ts, run_label
from headwater.skew import lookup_join

# Entity types and the metadata schema reference.
JOB = "JOB"
JOB_RUN = "JOB_RUN"
METADATA_SCHEMA_URL = "http://spark.adapter"

HEAD = "head"


def with_names(apps: DataFrame, routes: DataFrame) -> DataFrame:
    """Applications with host and sink, and the names of source, job and run."""
    host, job = F.col("host"), F.col("app_name")
    return (
        apps.join(routes.select("app_id", "host", "sink", "reason"), "app_id")
        .withColumn("source_name", spark_name(host))
        .withColumn("job_name", spark_name(host, job))
        .withColumn("run_name", spark_name(host, job, F.col("end_ms")))
    )


def entries(lineage: DataFrame, metadata: DataFrame) -> DataFrame:
    """What the job documents list: ``app_id, kind, key, value``, a row for each dataset and property.

    ``lineage`` is ``app_lineage``; its kinds are ``input`` and ``output``, and the
    value is the number of uses. ``metadata`` is ``merge_metadata``.
    """
    datasets = lineage.select(
        "app_id", F.col("direction").alias("kind"), F.col("name").alias("key"), F.col("n").cast("string").alias("value")
    )
    return datasets.unionByName(metadata.select("app_id", F.lit("metadata").alias("kind"), "key", "value"))


def job_entities(named_apps: DataFrame) -> DataFrame:
    """The head of each job document: names, type and schema."""
    return named_apps.select(
        "app_id",
        "host",
        "sink",
        "source_name",
        F.col("app_name").alias("name"),
        F.col("job_name").alias("resource_name"),
        F.lit(JOB).alias("type"),
        F.lit(METADATA_SCHEMA_URL).alias("schema_url"),
    )


def run_entities(named_apps: DataFrame) -> DataFrame:
    """The run document: label, link to the job, start, end, status and reason."""
    return named_apps.select(
        "app_id",
        run_label(F.col("app_name"), F.col("end_ms")).alias("name"),
        F.col("run_name").alias("resource_name"),
        F.lit(JOB_RUN).alias("type"),
        F.col("job_name").alias("transformer"),
        ms_to_ts(F.col("start_ms")).alias("start_time"),
        ms_to_ts(F.col("end_ms")).alias("end_time"),
        "status",
        "status_reason",
        "is_complete",
    )


def envelopes(named_apps: DataFrame, listed: DataFrame, hot: Sequence[Row] | None = None) -> DataFrame:
    """Documents to publish, as JSON texts: ``app_id, host, sink, source_name, kind, key, items``.

    The head of an application holds ``[job, run]`` in this order, and each of its
    entries (``listed``) is a document of its own. ``hot`` names the applications
    with a large share of the entries.
    """
    utc = {"timeZone": "UTC"}
    job_columns = ["name", "resource_name", "type", "schema_url"]
    jobs = job_entities(named_apps).select("app_id", F.to_json(F.struct(*job_columns)).alias("job"))
    run_columns = ["name", "resource_name", "type", "transformer", "start_time", "end_time", "status", "status_reason"]
    runs = run_entities(named_apps).select("app_id", F.to_json(F.struct(*run_columns), utc).alias("run"))
    senders = named_apps.select("app_id", "host", "sink", "source_name", F.col("job_name").alias("_job"))
    heads = senders.join(jobs, "app_id").join(runs, "app_id").select(
        "app_id", "host", "sink", "source_name", F.lit(HEAD).alias("kind"), F.col("_job").alias("key"),
        F.array("job", "run").alias("items"),
    )
    owned = lookup_join(listed, senders, ["app_id"], ["kind", "key"], how="inner", hot=hot)
    details = owned.select(
        "app_id", "host", "sink", "source_name", "kind", "key",
        F.array(F.to_json(F.struct(F.col("_job").alias("job"), "kind", "key", "value"))).alias("items"),
    )
    return heads.unionByName(details)


def edges(named_apps: DataFrame, lineage: DataFrame, hot: Sequence[Row] | None = None) -> DataFrame:
    """Edge table: dataset, direction, job and number of uses."""
    jobs = named_apps.select("app_id", "job_name")
    return lookup_join(lineage, jobs, ["app_id"], ["direction", "name"], how="inner", hot=hot).select(
        "app_id", "job_name", "direction", F.col("name").alias("dataset"), "n"
    )
