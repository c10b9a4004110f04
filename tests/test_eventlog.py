"""A job of our own writes its event log; the log is then read back as facts."""

import json
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from headwater import schemas as S
from headwater.operators import rddgraph, rollup, routing
from headwater.plans import pipelines
from headwater.sources import eventlog
from headwater.streaming import rollup as streams

JOB = """
import sys
from pyspark.sql import SparkSession
log, text, out = sys.argv[1:]
spark = (SparkSession.builder.master("local[2]").appName("tiny job").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + log)
    .config("spark.eventLog.compress", "false").getOrCreate())
spark.range(10).write.parquet(out + "/numbers")
spark.sparkContext.textFile("file://" + text).map(lambda line: (line, 1)).reduceByKey(lambda a, b: a + b).saveAsTextFile(out + "/counts")
try:
    spark.sparkContext.parallelize([1]).map(lambda x: 1 // 0).count()
except Exception:
    pass
spark.stop()
"""


@pytest.fixture(scope="module")
def log(tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    (base / "log").mkdir()
    (base / "words.txt").write_text("a\nb\na\n")
    (base / "job.py").write_text(JOB)
    command = [sys.executable, str(base / "job.py"), str(base / "log"), str(base / "words.txt"), str(base / "out")]
    subprocess.run(command, check=True, timeout=180, capture_output=True)
    return base


def test_own_event_log(spark, log):
    path = f"{log}/log/eventlog_v2_*/events_*"
    events = eventlog.scan_events(spark, path)
    app = rollup.rollup_apps(events).collect()
    assert len(app) == 1
    assert (app[0]["app_name"], app[0]["status"], app[0]["is_complete"]) == ("tiny job", "FAILED", True)
    assert app[0]["app_id"].startswith("local-") and app[0]["end_ms"] > app[0]["start_ms"] > 0
    kinds = {r["job_kind"] for r in routing.classify_jobs(events).collect()}
    assert kinds == {"sql", "rdd"}
    assert routing.sql_triggers(events).count() == 1
    assert events.where("conf is not null").select(F.col("conf")["spark.app.name"]).first()[0] == "tiny job"
    assert events.where(F.col("event") == S.JOB_END).count() == 3

    assert eventlog.scan_unreadable(spark, path).count() == 0
    roots = {r.job_id: r.rdd_id for r in eventlog.scan_rdd_roots(spark, path).collect()}
    assert len(roots) == 3
    named = rddgraph.lineage_names(eventlog.scan_rdd_nodes(spark, path), eventlog.scan_rdd_edges(spark, path))
    assert named.where("name = 'map_partitions_hadoop'").count() >= 1
    lineage = pipelines.build_lineage(pipelines.facts_of_log(spark, path))
    assert lineage.datasets.count() == 0, "local files have no name"

    nodes = eventlog.scan_rdd_nodes(spark, path)
    paths = rddgraph.explode_input_paths(nodes).select("path").distinct().collect()
    assert [r["path"] for r in paths] == [f"file://{log}/words.txt"]
    job = nodes.where("input_paths is not null").first()["job_id"]
    edges = eventlog.scan_rdd_edges(spark, path).where(F.col("job_id") == job)
    last = nodes.where(F.col("job_id") == job).agg(F.max("rdd_id").alias("rdd_id"))
    roots = last.select(F.lit(nodes.first()["app_id"]).alias("app_id"), F.lit(job).cast("bigint").alias("job_id"), "rdd_id")
    assert rddgraph.ancestors(edges, roots).count() == nodes.where(F.col("job_id") == job).count()


def test_facts_are_read_in_one_pass(spark, log, rows, tmp_path, monkeypatch):
    """The log is read once, and no more: it may be gone when its facts are used."""
    copy = tmp_path / "copy"
    shutil.copytree(log / "log", copy)
    path, scans, real = f"{copy}/eventlog_v2_*/events_*", [], eventlog._all_lines
    monkeypatch.setattr(eventlog, "_all_lines", lambda *args: scans.append(args) or real(*args))
    expected = {
        "event": rows(eventlog.scan_events(spark, path), "app_id", "event", "event_ms", "job_id", "execution_id"),
        "plan_node": rows(eventlog.scan_plan_nodes(spark, path).drop("options")),
        "rdd_node": rows(eventlog.scan_rdd_nodes(spark, path)),
        "rdd_edge": rows(eventlog.scan_rdd_edges(spark, path)),
        "rdd_root": rows(eventlog.scan_rdd_roots(spark, path)),
    }
    scans.clear()
    eventlog.stage_log(spark, path, f"{tmp_path}/facts")
    facts = pipelines.facts_of_log(spark, path)
    assert len(scans) == 2
    shutil.rmtree(copy)
    for kind, found in expected.items():
        again = eventlog.staged(spark, f"{tmp_path}/facts", kind).drop("options")
        columns = ["app_id", "event", "event_ms", "job_id", "execution_id"] if kind == "event" else again.columns
        assert rows(again, *columns) == found and found, kind
    assert eventlog.staged(spark, f"{tmp_path}/facts", "unreadable").count() == 0
    assert rows(facts.rdd_nodes) == expected["rdd_node"]


def line(event, **fields):
    return json.dumps({"Event": event, **fields})


def segment(folder, number, lines, app="app-1"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"events_{number}_{app}").write_text("\n".join(lines) + "\n")


def test_segments_are_staged_once_they_are_closed(spark, rows, tmp_path):
    base, target = tmp_path / "logs", f"{tmp_path}/staged"
    folder = base / "eventlog_v2_app-1"
    (base).mkdir()
    failed = {"Result": "JobFailed", "Exception": {"Message": "lost"}}
    segment(folder, 1, [line("SparkListenerApplicationStart", **{"App Name": "one", "Timestamp": 5}), "{cut off"])
    segment(folder, 2, [line("SparkListenerJobEnd", **{"Job ID": 1, "Completion Time": 7, "Job Result": failed})])
    (folder / "appstatus_app-1.inprogress").touch()
    (base / "local-7.inprogress").write_text(line("SparkListenerApplicationStart", **{"App Name": "two", "Timestamp": 5}))

    def run():
        n = eventlog.ingest_closed(spark, str(base), target)
        events = eventlog.stream_events(spark, target)
        streams.stream_rollup(events, f"{tmp_path}/state", f"{tmp_path}/checkpoint").awaitTermination()
        return n, rows(streams.apps_of(streams.read_rollup(spark, f"{tmp_path}/state")), "app_id", "end_ms", "status")

    assert run() == (1, [("app-1", 0, "SUCCESS")])
    segment(folder, 10, [line("SparkListenerJobEnd", **{"Job ID": 2, "Completion Time": 9, "Job Result": {"Result": "JobSucceeded"}})])
    assert run() == (1, [("app-1", 7, "FAILED")])  # the second segment is closed by the tenth
    assert run() == (0, [("app-1", 7, "FAILED")])
    (folder / "appstatus_app-1.inprogress").rename(folder / "appstatus_app-1")
    (base / "local-7.inprogress").rename(base / "local-7")
    n, state = run()
    assert n == 2 and state == [("app-1", 9, "FAILED"), ("local-7", 0, "SUCCESS")]
    # a call that was cut off after its ledger entry is made good
    facts = tmp_path / "staged" / "facts"
    last = sorted(facts.iterdir())[-1]
    shutil.rmtree(last)
    assert run() == (0, state)
    events = rows(eventlog.staged(spark, f"{target}/facts", "event"), "app_id", "event")
    assert len(events) == 4 and eventlog.staged(spark, f"{target}/facts", "unreadable").count() == 1
