import json

from pyspark.sql import functions as F

from headwater import schemas as S
from headwater.operators import conf as C
from headwater.operators import entities as E
from headwater.operators import rollup, routing
from headwater.skew import find_hot

ITEMS = "app_id string, dep_id bigint, direction string, node_id bigint, item bigint, name string, error string"
KEY = S.EXECUTION_ID_KEY


def item_rows(app, dep, inputs, outputs, start=0):
    rows = [(app, dep, "input", start + i, 0, name, None) for i, name in enumerate(inputs)]
    return rows + [(app, dep, "output", 0, i, name, None) for i, name in enumerate(outputs)]


def event(app, kind, ms=0, job=None, properties=None, result=None, message=None, execution=None, conf=None, name=None):
    return (app, name, kind, ms, job, execution, properties, result, message, conf)


def failed(app, ms, job, message):
    return event(app, S.JOB_END, ms, job, result=S.JOB_FAILED, message=message)


def good(app, ms, job):
    return event(app, S.JOB_END, ms, job, result=S.JOB_SUCCEEDED)


def test_equal_lists_are_one_edge_set(spark, rows):
    data = (
        item_rows("a", 1, ["x", "y"], ["o"])
        + item_rows("a", 2, ["x", "y"], ["o"], start=9_000)  # equal, other node ids
        + item_rows("a", 3, ["y", "x"], ["o"])  # other order
        + item_rows("a", 4, ["x", "x", "y"], ["o"])  # duplicate kept
        + item_rows("a", 5, ["x", "y"], ["p"])  # other output
        + item_rows("b", 6, ["x", "y"], ["o"])  # other application
        + item_rows("a", 7, ["x"], ["y", "o"])  # same names, other sides
    )
    kept = rollup.distinct_deps(spark.createDataFrame(data, ITEMS))
    assert rows(kept.select("dep_id").distinct()) == [(1,), (3,), (4,), (5,), (6,), (7,)]
    bag = rollup.app_lineage(kept).where("app_id = 'a' and name = 'x'")
    assert rows(bag, "direction", "n") == [("input", 6)]
    assert rows(rollup.app_lineage(kept, distinct=True).where("app_id = 'b'"), "name", "n") == [("o", 1), ("x", 1), ("y", 1)]


def test_edge_sets_with_equal_fingerprints_are_told_apart(spark, rows, monkeypatch):
    """Every item has the same hash, so only the comparison can tell the lists apart."""
    lists = {1: ["x", "y"], 2: ["y", "x"], 3: ["x", "y"], 4: ["x", "z"], 5: ["y", "x"], 6: ["x", "z"], 7: ["z", "z"]}
    data = [row for dep, names in lists.items() for row in item_rows("a", dep, names, ["o"], start=100 * dep)]
    monkeypatch.setattr(rollup, "_hash", lambda seed: F.lit(42).cast("bigint"))
    kept = rollup.distinct_deps(spark.createDataFrame(data, ITEMS))
    assert rows(kept.select("dep_id").distinct()) == [(1,), (2,), (4,), (7,)]
    assert kept.count() == 12


def test_merge_keeps_order_and_duplicates(spark):
    data = item_rows("a", 2, ["z", "x"], []) + item_rows("a", 1, ["x"], ["o"])
    merged = rollup.merge_deps(spark.createDataFrame(data, ITEMS), ["app_id"], ["dep_id", "node_id", "item"])
    lists = merged.where("direction = 'input'").orderBy("pos").collect()
    assert [r["name"] for r in lists] == ["x", "z", "x"]


def test_run_status(spark):
    events = spark.createDataFrame(
        [
            failed("a", 5, 1, "first"), failed("a", 9, 2, "last"), good("a", 20, 3),
            good("b", 7, 4),
            event("c", S.APP_START),
            failed("d", 5, 1, "tie 1"), failed("d", 5, 2, "tie 2"),
        ],
        S.LISTENER_EVENT,
    )
    found = {r["app_id"]: (r["end_ms"], r["status"], r["status_reason"]) for r in rollup.run_status(events).collect()}
    assert found == {
        "a": (20, "FAILED", "last"),
        "b": (7, "SUCCESS", None),
        "c": (0, "SUCCESS", None),
        "d": (5, "FAILED", "tie 2"),
    }


def test_metadata_last_value_wins_and_rdd_jobs_do_not_count(spark, rows):
    events = spark.createDataFrame(
        [
            event("a", S.JOB_START, 1, 1, {KEY: "1", "k": "old", "only": "x"}),
            event("a", S.JOB_START, 2, 2, {KEY: "2", "k": "new"}),
            event("a", S.JOB_START, 3, 3, {"k": "rdd"}),
            event("a", S.JOB_START, 4, 4, None),
        ],
        S.LISTENER_EVENT,
    )
    assert rows(rollup.merge_metadata(events), "key", "value") == [("k", "new"), ("only", "x"), (KEY, "2")]
    kinds = {r["job_id"]: (r["job_kind"], r["execution_id"]) for r in routing.classify_jobs(events).collect()}
    assert kinds == {1: ("sql", 1), 2: ("sql", 2), 3: ("rdd", None), 4: ("rdd", None)}


def test_triggers_and_matching(spark, rows):
    events = spark.createDataFrame(
        [
            event("a", S.SQL_START, execution=1),
            event("a", S.JOB_START, 1, 1, {KEY: "1"}),
            event("a", S.JOB_START, 1, 2, {KEY: "2"}),
            event("a", S.JOB_START, 1, 3, {KEY: "not a number"}),
        ],
        S.LISTENER_EVENT,
    )
    triggers = routing.sql_triggers(events)
    assert rows(triggers) == [("a", 1), ("a", 2)]
    plan = spark.createDataFrame([("a", 1, 0), ("a", 1, 1), ("b", 1, 0)], "app_id string, execution_id bigint, node_id bigint")
    assert rows(routing.with_plans(triggers, plan), "node_id") == [(0,), (1,)]
    assert rows(routing.skipped(triggers, plan)) == [("a", 2)]


CONF = [
    ("none", {}),
    ("off", {"spark.lineage.host.key": "h", "spark.lineage.enabled": "yes", "spark.lineage.host.url": "http://x"}),
    ("bad", {"spark.lineage.host.key": "h", "spark.lineage.host.url": "ftp://x"}),
    ("ok", {"spark.lineage.host.key": "h", "spark.lineage.enabled": "True", "spark.lineage.host.url": "http://localhost:1"}),
    ("nokey", {"spark.lineage.host.url": "http://localhost:1"}),
]


def conf_events(spark):
    data = [event(app, S.APP_START, 1000, conf=conf, name=app) for app, conf in CONF]
    data += [event(app, S.APP_END, 9000) for app in ("ok", "bad")] + [good("ok", 8000, 1)]
    return spark.createDataFrame(data, S.LISTENER_EVENT)


def test_routes(spark, rows):
    events = conf_events(spark)
    assert rows(C.route_apps(events, C.conf_kv(events)), "app_id", "host", "sink", "reason") == [
        ("bad", "h", "log", "no_valid_url"),
        ("nokey", "UNKNOWN", "log", "no_host_key"),
        ("none", "UNKNOWN", "log", "no_host_key"),
        ("off", "h", "log", "disabled"),
        ("ok", "h", "publish", "ok"),
    ]


def test_documents_have_one_layout(spark, rows):
    events = conf_events(spark)
    apps = E.with_names(rollup.rollup_apps(events), C.route_apps(events, C.conf_kv(events)))
    lineage = spark.createDataFrame(
        [("ok", d, f"//{d}/{i}", i + 1) for d in ("input", "output") for i in range(60)],
        "app_id string, direction string, name string, n bigint",
    )
    metadata = spark.createDataFrame([("ok", f"k{i}", f"v{i}") for i in range(30)], "app_id string, key string, value string")
    documents = E.envelopes(apps, E.entries(lineage, metadata))
    heads = {r.app_id: r for r in documents.where("kind = 'head'").collect()}
    assert set(heads) == {"none", "off", "bad", "ok", "nokey"}, "an application without entries still has its head"
    job, run = (json.loads(text) for text in heads["ok"]["items"])
    assert heads["ok"]["source_name"] == "//spark/host/h"
    assert (job["type"], job["resource_name"]) == ("JOB", "//spark/host/h/jobs/ok")
    assert run == {
        "name": "ok-8000", "resource_name": "//spark/host/h/jobs/ok/runs/8000", "type": "JOB_RUN",
        "transformer": "//spark/host/h/jobs/ok", "start_time": "1970-01-01T00:00:01.000Z",
        "end_time": "1970-01-01T00:00:08.000Z", "status": "SUCCESS",
    }
    listed = documents.where("kind <> 'head'").collect()
    found = {(r.kind, r.key, json.loads(r["items"][0])["value"]) for r in listed}
    assert len(listed) == 150
    assert found == {(d, f"//{d}/{i}", str(i + 1)) for d in ("input", "output") for i in range(60)} | {
        ("metadata", f"k{i}", f"v{i}") for i in range(30)
    }


def test_documents_of_a_large_application_are_spread(spark):
    """One application holds a third of all entries: they lie in several tasks."""
    events = conf_events(spark)
    apps = E.with_names(rollup.rollup_apps(events), C.route_apps(events, C.conf_kv(events)))
    names = [("ok" if i % 3 == 0 else f"other{i}", "input", f"//d/{i}", 1) for i in range(3000)]
    listed = E.entries(
        spark.createDataFrame(names, "app_id string, direction string, name string, n bigint"),
        spark.createDataFrame([], "app_id string, key string, value string"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        documents = E.envelopes(apps, listed, find_hot(listed, ["app_id"], share=0.05)).where("kind = 'input'")
        parts = documents.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert parts > 1


def test_an_application_without_ended_jobs(spark):
    events = conf_events(spark)
    apps = E.with_names(rollup.rollup_apps(events), C.route_apps(events, C.conf_kv(events)))
    row = apps.where("app_id = 'bad'").first()
    assert (row["end_ms"], row["run_name"], row["is_complete"]) == (0, "//spark/host/h/jobs/bad/runs/0", False)
    assert apps.where("app_id = 'ok'").first()["is_complete"] is True


def test_edges(spark, rows):
    apps = spark.createDataFrame([("a", "//j")], "app_id string, job_name string")
    lineage = spark.createDataFrame([("a", "input", "x", 2), ("a", "output", "y", 1)], "app_id string, direction string, name string, n bigint")
    assert rows(E.edges(apps, lineage)) == [("a", "//j", "input", "x", 2), ("a", "//j", "output", "y", 1)]
    assert E.edges(apps, lineage).where(F.col("n") > 1).count() == 1
