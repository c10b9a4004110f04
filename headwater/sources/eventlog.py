"""Spark event logs (JSON lines) to fact tables.

One explicit schema, no inference. A log file names its
application only once, so the application id comes from the file path.

Each fact is an array that one projection makes of a line. :func:`stage_log` makes all of them in one pass over the log and stores
them by kind, :func:`staged` reads one kind; the ``scan_`` functions read the log for one kind alone. :func:`ingest_closed` stages what is
complete of logs that are still written, and :func:`stream_events` is the stream of its events.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamReader

from headwater import schemas as S
from headwater.session import children, path_exists

# Path shapes of rolled logs (one folder per application) and of
# single-file logs.
APP_ID_IN_PATH = r"/(?:eventlog_v2_([^/]+)/events_[0-9]+_[^/]+|([^/]+?)(?:\.inprogress)?)$"

_RDD_INFO = T.StructType(
    [
        T.StructField("RDD ID", T.LongType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Scope", T.StringType()),
        T.StructField("Parent IDs", T.ArrayType(T.LongType())),
    ]
)
_STAGE_INFO = T.StructType(
    [
        T.StructField("Stage ID", T.LongType()),
        T.StructField("RDD Info", T.ArrayType(_RDD_INFO)),
    ]
)
_RESULT = T.StructType(
    [
        T.StructField("Result", T.StringType()),
        T.StructField("Exception", T.StructType([T.StructField("Message", T.StringType())])),
    ]
)
LOG_LINE = T.StructType(
    [
        T.StructField("Event", T.StringType()),
        T.StructField("App Name", T.StringType()),
        T.StructField("Timestamp", T.LongType()),
        T.StructField("Job ID", T.LongType()),
        T.StructField("Submission Time", T.LongType()),
        T.StructField("Completion Time", T.LongType()),
        T.StructField("Job Result", _RESULT),
        T.StructField("Stage Infos", T.ArrayType(_STAGE_INFO)),
        T.StructField("Properties", S.STRING_MAP),
        T.StructField("Spark Properties", S.STRING_MAP),
        T.StructField("executionId", T.LongType()),
        T.StructField("time", T.LongType()),
        T.StructField("sparkPlanInfo", T.StringType()),
        T.StructField("unreadable", T.StringType()),
    ]
)

# How a log names RDDs after their classes or paths, and lists the paths of a file scan.
CLASS_NAME = r"^\w*RDD\d*$"
PATH_NAME = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?/"
SCAN_LOCATION = r'"Location":"\w+(?:\([^)]*\))?\[([^\]]*)\]'


def _app_id(pattern: str) -> Column:
    path = F.col("_metadata.file_path")
    first = F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    if pattern != APP_ID_IN_PATH:
        return first
    return F.coalesce(first, F.regexp_extract(path, pattern, 2))


def _all_lines(spark: SparkSession, path: str | Sequence[str], app_id_pattern: str) -> DataFrame:
    reader = spark.read.schema(LOG_LINE).option("columnNameOfCorruptRecord", "unreadable")
    return reader.json(path if isinstance(path, str) else list(path)).select(_app_id(app_id_pattern).alias("app_id"), "*")


def read_log(spark: SparkSession, path: str, app_id_pattern: str = APP_ID_IN_PATH) -> DataFrame:
    """Log lines with their application id. For rolled logs give ``.../eventlog_v2_*/events_*``.

    Lines that cannot be read are left out; see :func:`scan_unreadable`.
    """
    return _all_lines(spark, path, app_id_pattern).where(F.col("unreadable").isNull()).drop("unreadable")


FACT_TYPES = {
    "event": S.LISTENER_EVENT,
    "plan_node": S.PLAN_NODE,
    "rdd_node": S.RDD_NODE,
    "rdd_edge": S.RDD_EDGE,
    "rdd_root": T.StructType(S.RDD_NODE.fields[:3]),
    "unreadable": T.StructType([T.StructField("app_id", T.StringType()), T.StructField("line", T.StringType())]),
}
# The kinds of facts, and what tells the rows of one kind apart where a log repeats them.
KINDS = {
    "event": None,
    "plan_node": None,
    # numbers first: a sort by them compares few whole keys
    "rdd_node": ["rdd_id", "job_id", "app_id"],
    "rdd_edge": ["rdd_id", "dep_pos", "job_id", "app_id"],
    "rdd_root": ["job_id", "app_id"],
    "unreadable": None,
}


def _one(condition: Column, row: Column) -> Column:
    return F.when(condition, F.array(row))


def _event() -> Column:
    """The event kinds that lineage needs, as ``listener_event`` rows."""
    event = F.col("Event")
    wanted = [S.APP_START, S.APP_END, S.JOB_START, S.JOB_END, S.SQL_START, S.ENVIRONMENT]
    execution = F.when(event == S.SQL_START, F.col("executionId")).when(
        event == S.JOB_START, F.try_element_at("Properties", F.lit(S.EXECUTION_ID_KEY)).try_cast("bigint")
    )
    row = F.struct(
        "app_id",
        F.col("App Name").alias("app_name"),
        event.alias("event"),
        F.coalesce("Timestamp", "Submission Time", "Completion Time", "time").alias("event_ms"),
        F.col("Job ID").alias("job_id"),
        execution.alias("execution_id"),
        F.when(event == S.JOB_START, F.col("Properties")).alias("properties"),
        F.col("Job Result.Result").alias("result"),
        F.col("Job Result.Exception.Message").alias("error_message"),
        F.col("Spark Properties").alias("conf"),
    )
    return _one(event.isin(wanted), row)


def _plan_nodes() -> Column:
    """A root for each execution start, and its scans below."""
    lists = F.regexp_extract_all("sparkPlanInfo", F.lit(SCAN_LOCATION), F.lit(1))
    paths = F.transform(lists, lambda text: F.filter(F.split(text, ", *"), lambda p: (p != "") & ~p.endswith("...")))
    none = F.array().cast("array<string>")

    def node(root_paths: Column, node_id: Column) -> Column:
        is_root = node_id == 0
        return F.struct(
            F.col("app_id"),
            F.col("executionId").alias("execution_id"),
            node_id.cast("bigint").alias("node_id"),
            F.when(~is_root, F.lit(0)).cast("bigint").alias("parent_id"),
            F.when(is_root, F.lit("Execution")).otherwise(F.lit("LogicalRelation")).alias("node_kind"),
            F.when(~is_root, F.lit("HadoopFsRelation")).alias("relation_kind"),
            F.lit(None).cast("string").alias("provider"),
            F.create_map().cast(S.STRING_MAP).alias("options"),
            F.when(~is_root, root_paths).alias("root_paths"),
            F.lit(False).alias("has_catalog_table"),
        )

    has_plan = (F.col("Event") == S.SQL_START) & F.col("sparkPlanInfo").isNotNull()
    return F.when(has_plan, F.transform(F.concat(F.array(none), paths), node))


def _is_job() -> Column:
    return F.col("Event") == S.JOB_START


def _job_rdds() -> Column:
    return F.flatten(F.transform("Stage Infos", lambda stage: F.coalesce(stage["RDD Info"], F.array())))


def _is_class(rdd: Column) -> Column:
    return rdd["Name"].rlike(CLASS_NAME)


def _is_path(rdd: Column) -> Column:
    return rdd["Name"].rlike(PATH_NAME)


def _rdd_node(rdd: Column, is_class: Column, is_path: Column) -> list[Column]:
    name = rdd["Name"]
    is_scan = (F.size(rdd["Parent IDs"]) == 0) & is_path
    rdd_class = (
        F.when(is_class, name)
        .when(is_scan, F.lit("HadoopRDD"))
        .when(is_path, F.lit("MapPartitionsRDD"))
        .otherwise(F.get_json_object(rdd["Scope"], "$.name"))
    )
    return [
        F.col("app_id"),
        F.col("Job ID").alias("job_id"),
        rdd["RDD ID"].alias("rdd_id"),
        rdd_class.alias("rdd_class"),
        F.when(~is_class, name).alias("rdd_name"),
        F.when(is_scan, F.split(name, ",")).alias("input_paths"),
    ]


def _rdd_nodes() -> Column:
    return F.when(_is_job(), F.transform(_job_rdds(), lambda rdd: F.struct(*_rdd_node(rdd, _is_class(rdd), _is_path(rdd)))))


def _rdd_edges() -> Column:
    def edges(rdd: Column) -> Column:
        return F.transform(
            F.coalesce(rdd["Parent IDs"], F.array().cast("array<bigint>")),
            lambda parent, position: F.struct(
                F.col("app_id"),
                F.col("Job ID").alias("job_id"),
                rdd["RDD ID"].alias("rdd_id"),
                parent.alias("dep_rdd_id"),
                position.alias("dep_pos"),
            ),
        )

    return F.when(_is_job(), F.flatten(F.transform(_job_rdds(), edges)))


def _rdd_root() -> Column:
    """The final RDD of a job: the highest of its last stage."""
    stages = F.filter("Stage Infos", lambda s: F.size(s["RDD Info"]) > 0)
    last = F.array_max(F.transform(stages, lambda s: F.struct(s["Stage ID"], F.array_max(s["RDD Info"]["RDD ID"]).alias("rdd_id"))))
    row = F.struct("app_id", F.col("Job ID").alias("job_id"), last["rdd_id"].alias("rdd_id"))
    return _one(_is_job() & last["rdd_id"].isNotNull(), row)


def _unreadable() -> Column:
    return _one(F.col("unreadable").isNotNull(), F.struct("app_id", F.col("unreadable").alias("line")))


_FACTS = {
    "event": _event, "plan_node": _plan_nodes, "rdd_node": _rdd_nodes, "rdd_edge": _rdd_edges, "rdd_root": _rdd_root,
    "unreadable": _unreadable,
}


def _distinct(rows: DataFrame, kind: str) -> DataFrame:
    return rows.dropDuplicates(KINDS[kind]) if KINDS[kind] else rows


def _scan(spark: SparkSession, path: str, app_id_pattern: str, kind: str) -> DataFrame:
    """The facts of one kind, read from the log."""
    found = read_log(spark, path, app_id_pattern).select(F.explode(_FACTS[kind]()).alias("fact")).select("fact.*")
    return _distinct(found, kind)


def _tagged(lines: DataFrame) -> DataFrame:
    """All facts of all lines, each with its ``kind``, in the column of that kind."""
    arrays = {kind: fact() for kind, fact in _FACTS.items()}
    types = {kind: lines.select(array).schema[0].dataType.elementType for kind, array in arrays.items()}

    def rows(kind: str) -> Column:
        def row(fact: Column) -> Column:
            columns = [(fact if other == kind else F.lit(None)).cast(types[other]).alias(other) for other in KINDS]
            return F.struct(F.lit(kind).alias("kind"), *columns)

        return F.coalesce(F.transform(arrays[kind], row), F.array())

    return lines.select(F.explode(F.concat(*[rows(kind) for kind in KINDS])).alias("row")).select("row.*")


def stage_log(spark: SparkSession, path: str | Sequence[str], target: str, app_id_pattern: str = APP_ID_IN_PATH) -> None:
    """Write the facts of a log to folders by kind: the log is read and parsed once, whatever is asked of it later."""
    lines = _all_lines(spark, path, app_id_pattern)
    _tagged(lines).write.partitionBy("kind").mode("overwrite").parquet(target)


def staged(spark: SparkSession, target: str, kind: str) -> DataFrame:
    """The facts of one kind; other kinds are not opened. ``target`` may be a pattern of several folders."""
    return _distinct(_staged_rows(spark.read, target, kind), kind)


def _staged_rows(reader: DataFrameReader | DataStreamReader, target: str, kind: str) -> DataFrame:
    folders = [T.StructField(name, T.StringType()) for name in ("batch", "kind")]
    schema = T.StructType([T.StructField(kind, FACT_TYPES[kind]), *folders])
    found = reader.schema(schema).parquet(target).where(F.col("kind") == kind)
    return found.select(f"{kind}.*")


def scan_events(spark: SparkSession, path: str, app_id_pattern: str = APP_ID_IN_PATH) -> DataFrame:
    """The event kinds that lineage needs, as ``listener_event`` rows; all others are left out."""
    return _scan(spark, path, app_id_pattern, "event")


def scan_unreadable(spark: SparkSession, path: str, app_id_pattern: str = APP_ID_IN_PATH) -> DataFrame:
    """Lines that are no JSON, such as a line that was cut off: ``app_id, line``."""
    # Spark refuses to read nothing but the unreadable lines, so the test looks at the event as well
    any_event = F.coalesce("Event", F.lit("")) != F.lit("\0")
    lines = _all_lines(spark, path, app_id_pattern).where(F.col("unreadable").isNotNull() & any_event)
    return lines.select("app_id", F.col("unreadable").alias("line"))


def scan_plan_nodes(spark: SparkSession, path: str, app_id_pattern: str = APP_ID_IN_PATH) -> DataFrame:
    """The file scans of each SQL execution as ``plan_node`` rows below a root.

    The plan of an execution start lists the locations of its scans; a location that
    the log has cut short is left out. What an execution writes is not in it.
    """
    return _scan(spark, path, app_id_pattern, "plan_node")


def scan_rdd_roots(spark: SparkSession, path: str, app_id_pattern: str = APP_ID_IN_PATH) -> DataFrame:
    """The final RDD of each job: the highest of its last stage."""
    return _scan(spark, path, app_id_pattern, "rdd_root")


def scan_job_rdds(spark: SparkSession, path: str, app_id_pattern: str = APP_ID_IN_PATH) -> DataFrame:
    """The RDDs that each job start lists, as they are: ``app_id, Job ID, rdd``.

    Where both nodes and edges are asked for, they can be stored and given to :func:`scan_rdd_nodes` and
    :func:`scan_rdd_edges`, so that the log is parsed once.
    """
    jobs = read_log(spark, path, app_id_pattern).where(_is_job())
    stages = jobs.select("app_id", "Job ID", F.explode("Stage Infos").alias("stage"))
    return stages.select("app_id", "Job ID", F.explode(F.col("stage")["RDD Info"]).alias("rdd"))


def scan_rdd_nodes(
    spark: SparkSession, path: str, app_id_pattern: str = APP_ID_IN_PATH, rdds: DataFrame | None = None
) -> DataFrame:
    """RDDs of all stages of each job.

    The stages of a job list every RDD it depends on, so this is already the
    closure of its final RDD. A leaf that is named like a path is a file scan;
    its name is the comma list of its paths, which the RDD mapped from it repeats. A
    name like that of a class is the class, and the RDD has no name of its own.
    ``rdds`` are :func:`scan_job_rdds` of the log, if they are stored.
    """
    rdd = F.col("rdd")
    # columns, since an expression would match the name each time it is used
    listed = (scan_job_rdds(spark, path, app_id_pattern) if rdds is None else rdds).withColumns(
        {"is_class": _is_class(rdd), "is_path": _is_path(rdd)}
    )
    return _distinct(listed.select(*_rdd_node(rdd, F.col("is_class"), F.col("is_path"))), "rdd_node")


def scan_rdd_edges(
    spark: SparkSession, path: str, app_id_pattern: str = APP_ID_IN_PATH, rdds: DataFrame | None = None
) -> DataFrame:
    """Dependencies of the RDDs of each job. ``rdds`` are :func:`scan_job_rdds` of the log, if they are stored."""
    listed = scan_job_rdds(spark, path, app_id_pattern) if rdds is None else rdds
    edges = listed.select(
        "app_id",
        F.col("Job ID").alias("job_id"),
        F.col("rdd")["RDD ID"].alias("rdd_id"),
        F.posexplode(F.col("rdd")["Parent IDs"]).alias("dep_pos", "dep_rdd_id"),
    )
    return _distinct(edges.select("app_id", "job_id", "rdd_id", "dep_rdd_id", "dep_pos"), "rdd_edge")


# --- Logs that are still written ------------------------------------------------


def closed_segments(spark: SparkSession, base: str) -> list[str]:
    """The files below ``base`` that no application writes to any more.

    Of a rolled log all segments but the last are closed, and the last one too once the application's status says that it has ended. Of
    single-file logs those are closed whose names do not end in ``.inprogress``.
    """
    found = []
    for child in children(spark, base):
        if not child.is_folder:
            if not child.name.endswith(".inprogress") and not child.name.startswith(("_", ".")):
                found.append(f"{base}/{child.name}")
            continue
        names = [file.name for file in children(spark, f"{base}/{child.name}")]
        ended = any(name.startswith("appstatus_") and not name.endswith(".inprogress") for name in names)
        numbered = sorted((int(m[1]), name) for name in names if (m := re.match(r"events_(\d+)_", name)))
        closed = numbered if ended else numbered[:-1]
        found += [f"{base}/{child.name}/{name}" for _, name in closed]
    return found


def ingest_closed(spark: SparkSession, base: str, target: str, app_id_pattern: str = APP_ID_IN_PATH) -> int:
    """Stage the segments that have been closed since the last call, below ``target``; returns how many.

    A call first lists its segments in a ledger entry, then stages them in a folder of the same number. A call that was
    cut off is made good by the next one, with the same segments, so each is staged once.
    """
    entries = [child.name for child in children(spark, f"{target}/ledger") if child.is_folder]
    listed: set[str] = set()
    for entry in entries:
        paths = [row.path for row in spark.read.schema("path string").parquet(f"{target}/ledger/{entry}").collect()]
        listed.update(paths)
        if not path_exists(spark, f"{target}/facts/{entry}/_SUCCESS"):
            stage_log(spark, paths, f"{target}/facts/{entry}", app_id_pattern)
    new = [path for path in closed_segments(spark, base) if path not in listed]
    if new:
        entry = f"batch={len(entries):08d}"
        ledger = spark.createDataFrame([(path,) for path in new], "path string").coalesce(1)
        ledger.write.mode("overwrite").parquet(f"{target}/ledger/{entry}")
        stage_log(spark, new, f"{target}/facts/{entry}", app_id_pattern)
    return len(new)


def stream_events(spark: SparkSession, target: str) -> DataFrame:
    """The stream of the events that :func:`ingest_closed` stages below ``target``."""
    return _staged_rows(spark.readStream, f"{target}/facts", "event")
