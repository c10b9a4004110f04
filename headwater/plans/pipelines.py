"""Whole jobs: lineage of all applications, and the demo ETL jobs."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater import schemas as S
from headwater.operators import conf as C
from headwater.operators import entities as E
from headwater.operators import etl, extract, rddgraph, rollup, routing
from headwater.operators.conf import KEYS, ConfKeys
from headwater.session import cut_at, delete_path, work_path
from headwater.sources import eventlog

# So many plan nodes go through the extraction at once, on average.
SLICE_NODES = 100_000_000


@dataclass(frozen=True)
class Facts:
    """The fact tables of many applications."""

    events: DataFrame
    plan_nodes: DataFrame
    rdd_nodes: DataFrame
    rdd_edges: DataFrame
    rdd_roots: DataFrame
    rdd_output: DataFrame
    conf: DataFrame | None = None
    # the RDDs that each job depends on, where they are known without following the edges
    rdd_closure: DataFrame | None = None

    def conf_kv(self) -> DataFrame:
        return self.conf if self.conf is not None else C.conf_kv(self.events)

    def slice(self, number: int, slices: int) -> Facts:
        """The facts of some applications, chosen by a hash of their id."""
        own = F.pmod(F.xxhash64("app_id"), F.lit(slices)) == number
        return replace(self, **{f.name: df.where(own) for f in fields(self) if (df := getattr(self, f.name)) is not None})


@dataclass(frozen=True)
class Lineage:
    """The result tables."""

    apps: DataFrame
    items: DataFrame
    datasets: DataFrame
    metadata: DataFrame

    def edges(self) -> DataFrame:
        return E.edges(self.apps, self.datasets)

    def jobs(self) -> DataFrame:
        return E.job_entities(self.apps)

    def entries(self) -> DataFrame:
        return E.entries(self.datasets, self.metadata)

    def runs(self) -> DataFrame:
        return E.run_entities(self.apps)

    def envelopes(self) -> DataFrame:
        return E.envelopes(self.apps, self.entries())


def sql_items(facts: Facts, keys: ConfKeys = KEYS, compat: bool = False) -> DataFrame:
    """Lineage items of the triggered SQL executions, errors included."""
    # the endpoints go with the triggers, which are few, so that nodes with all their options are shuffled once
    triggers = C.with_endpoints(routing.sql_triggers(facts.events), facts.conf_kv(), ["execution_id"], keys)
    nodes = routing.with_plans(triggers, facts.plan_nodes, "s3a_endpoint", "s3n_endpoint")
    return extract.plan_items(extract.lower_options(nodes), compat=compat)


def rdd_items(facts: Facts, keys: ConfKeys = KEYS, compat: bool = False) -> DataFrame:
    """Lineage items of the RDD jobs."""
    conf, job = facts.conf_kv(), ["app_id", "job_id"]
    jobs = routing.classify_jobs(facts.events).where(F.col("job_kind") == "rdd").select(*job).distinct()
    if facts.rdd_closure is not None:
        closure = facts.rdd_closure.join(jobs, job, "left_semi")
    else:
        closure = rddgraph.ancestors(facts.rdd_edges, facts.rdd_roots.join(jobs, job, "left_semi"))
    inputs = rddgraph.rdd_inputs(closure, facts.rdd_nodes, conf, keys, compat)
    outputs = rddgraph.rdd_outputs(facts.rdd_output.join(jobs, job, "left_semi"), conf, keys, compat)
    return inputs.unionByName(outputs)


def build_lineage(facts: Facts, keys: ConfKeys = KEYS, compat: bool = False) -> Lineage:
    """All applications at once: events and facts in, lineage tables out.

    Executions and jobs share one id column: even ids are SQL executions, odd
    ones RDD jobs. The items are stored once in the shared folder, since several
    results read them. Nothing of one application needs another, so where there are more than SLICE_NODES plan nodes, the
    applications are dealt into slices that go one after another: the disks hold the shuffle files of one. Joins with the few rows of an application are plain ones: where one application has a large
    share of the rows, Spark splits its partition at run time.
    """
    spark = facts.events.sparkSession
    path, slices = work_path(spark, "lineage"), max(-(-facts.plan_nodes.count() // SLICE_NODES), 1)
    for number in range(slices):
        some = facts.slice(number, slices) if slices > 1 else facts
        sql = sql_items(some, keys, compat).withColumn("dep_id", F.col("dep_id") * 2)
        rdd = rdd_items(some, keys, compat).withColumn("dep_id", F.col("dep_id") * 2 + 1)
        every = cut_at(routing.resolved_only(sql.unionByName(rdd)), f"{path}/every-{number}")
        items = cut_at(rollup.distinct_deps(every), f"{path}/items/slice={number}")
        delete_path(spark, f"{path}/every-{number}")
        datasets = cut_at(rollup.app_lineage(items), f"{path}/datasets/slice={number}")
    items, datasets = (
        spark.read.schema(df.schema).parquet(f"{path}/{name}").select(*df.columns) for name, df in (("items", items), ("datasets", datasets))
    )
    routes = C.route_apps(facts.events, facts.conf_kv(), keys)
    apps = E.with_names(rollup.rollup_apps(facts.events), routes)
    return Lineage(apps, items, datasets, rollup.merge_metadata(facts.events))


def facts_of_log(spark: SparkSession, path: str, app_id_pattern: str = eventlog.APP_ID_IN_PATH) -> Facts:
    """The facts that event logs hold, read from the logs once. A job's stages list its RDDs, so no edges are followed."""
    target = work_path(spark, "facts-of-log")
    eventlog.stage_log(spark, path, target, app_id_pattern)
    return staged_facts(spark, target)


def staged_facts(spark: SparkSession, target: str) -> Facts:
    """The facts that :func:`headwater.sources.eventlog.stage_log` has stored."""
    nodes = eventlog.staged(spark, target, "rdd_node")
    return Facts(
        eventlog.staged(spark, target, "event"),
        eventlog.staged(spark, target, "plan_node"),
        nodes,
        eventlog.staged(spark, target, "rdd_edge"),
        eventlog.staged(spark, target, "rdd_root"),
        spark.createDataFrame([], S.RDD_OUTPUT),
        rdd_closure=nodes.select(*rddgraph.NODE),
    )


# --- The demo ETL jobs, on any tables of the same shape ---------------------


def clean_reports(reports: DataFrame) -> DataFrame:
    """Position reports with a plausible, non-zero position and an hour, without two columns."""
    placed = etl.non_zero_position(etl.valid_position(reports))
    return etl.drop_cols(etl.where_not_null(placed, "report_hour"), "report_date", "id")


def reports_with_vehicles(reports: DataFrame, vehicles: DataFrame) -> DataFrame:
    """The jdbc-to-jdbc job: reports left joined to vehicles, cleaned."""
    return clean_reports(etl.left_join(reports, vehicles, reports["vehicle_id"] == vehicles["id"]))


def reports_with_seen(cleaned: DataFrame, seen: DataFrame) -> DataFrame:
    """The delta job: cleaned reports left joined on latitude (double) = vehicle id (int)."""
    left = etl.drop_cols(cleaned, "vehicle_id")
    right = etl.project(seen, "vehicle_id")
    return etl.left_join(left, right, left["latitude"] == right["vehicle_id"])


def records_as_text(records: DataFrame) -> DataFrame:
    """The kafka job: key and value as text."""
    return etl.project(records, "CAST(key AS STRING)", "CAST(value AS STRING)")


def centers_with_vehicles(centers: DataFrame, vehicles: DataFrame) -> DataFrame:
    """The warehouse job: call centers up to key 10 left joined to vehicles, key dropped."""
    small = etl.where_le(centers, "CC_CALL_CENTER_SK", 10)
    joined = etl.left_join(small, vehicles, small["CC_CALL_CENTER_SK"] == vehicles["vehicle_id"])
    return etl.drop_cols(joined, "vehicle_id")
