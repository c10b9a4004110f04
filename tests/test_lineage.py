"""Five kinds of jobs as facts, and the quirks of both modes."""

import random

import pytest
from pyspark.sql import functions as F

from headwater import schemas as S
from headwater.operators import extract, rddgraph
from headwater.plans import pipelines
from headwater.session import children, shared_dir

DELTA = "org.apache.spark.sql.delta.sources.DeltaDataSource"
KAFKA = "org.apache.spark.sql.kafka010.KafkaSourceProvider"
SNOWFLAKE = "net.snowflake.spark.snowflake.DefaultSource"
SHOP_QUERY = "(select o.id, c.city from purchases o join buyers c on c.id = o.buyer) bought"
SHOP_TABLES = ["//mysql/host/shop-db/databases/shop/tables/" + t for t in ("purchases", "buyers")]
SHOP = {"url": "jdbc:mysql://shop-db:3306/shop", "dbtable": SHOP_QUERY}
ENDPOINT = [("app", "spark.hadoop.fs.s3a.endpoint", "http://store:9100")]


def write(provider, **options):
    return ("SaveIntoDataSourceCommand", None, provider, options, None, False)


def relation(kind, options=None, paths=None, catalog=False):
    return ("LogicalRelation", kind, None, options or {}, paths, catalog)


def other(kind="Project"):
    return (kind, None, None, {}, None, False)


@pytest.fixture(scope="module")
def items(spark):
    """Inputs, outputs and errors of one plan, given as its nodes with the root first."""

    def run(nodes, conf=(), compat=False, rules=None):
        data = [("app", 1, i, None if i == 0 else 0, *node) for i, node in enumerate(nodes)]
        plan = spark.createDataFrame(data, S.PLAN_NODE)
        prepared = extract.prepare_nodes(plan, spark.createDataFrame(list(conf), S.CONF_KV))
        found = extract.plan_items(prepared, rules, compat).orderBy("node_id", "item").collect()
        inputs = [r["name"] for r in found if r["direction"] == "input" and r["name"]]
        outputs = [r["name"] for r in found if r["direction"] == "output" and r["name"]]
        return inputs, outputs, [r["error"] for r in found if r["error"]]

    return run


@pytest.mark.parametrize("compat", [False, True])
def test_jdbc_to_jdbc(items, compat):
    plan = [
        write("jdbc", url="jdbc:postgresql://report-db:5432/reports", dbtable="bought_by_city"),
        other(),
        other("Filter"),
        relation("JDBCRelation", SHOP),
    ]
    target = "//postgresql/host/report-db/databases/reports/schemas/public/tables/bought_by_city"
    assert items(plan, compat=compat) == (SHOP_TABLES, [target], [])


@pytest.mark.parametrize("compat", [False, True])
def test_kafka_to_kafka(items, compat):
    servers = {"kafka.bootstrap.servers": "bus:9192"}
    plan = [
        write(KAFKA, **servers, topic="all_clicks"),
        other(),
        relation("KafkaRelation", {**servers, "subscribe": "clicks, late_clicks"}),
    ]
    topics = ["//kafka/cluster/bus:9192/topics/" + t for t in ("clicks", "late_clicks", "all_clicks")]
    assert items(plan, compat=compat) == (topics[:2], topics[2:], [])


@pytest.mark.parametrize("compat", [False, True])
def test_delta_and_jdbc_to_delta(items, compat):
    path = "s3a://lake/tables/stock"
    plan = [
        write(DELTA, path=path),
        other("Join"),
        relation("JDBCRelation", SHOP),
        relation("HadoopFsRelation", paths=[path]),
    ]
    host = "store" if compat else "store:9100"
    name = rf"//s3-custom/endpoint/{host}/buckets/lake/keys/tables\\stock"
    assert items(plan, ENDPOINT, compat) == ([*SHOP_TABLES, name], [name], [])


@pytest.mark.parametrize("compat", [False, True])
def test_snowflake_and_jdbc_to_snowflake(items, compat):
    account = {"sfURL": "acct.eu.example.com", "sfDatabase": "DB", "sfSchema": "SC"}
    query = "select f.ORIGIN, f.DELAY, p.RUNWAYS from FLIGHTS f RIGHT JOIN AIRPORTS p ON f.ORIGIN = p.CODE where f.DELAY > 15"
    plan = [
        write(SNOWFLAKE, **account, dbtable="DELAYS"),
        relation("SnowflakeRelation", {**account, "query": query}),
        relation("JDBCRelation", SHOP),
    ]
    names = ["//snowflake/account/acct/databases/DB/schemas/SC/tables/" + t for t in ("FLIGHTS", "AIRPORTS", "DELAYS")]
    assert items(plan, compat=compat) == ([*names[:2], *SHOP_TABLES], names[2:], [])


def test_text_to_text(spark):
    nodes = spark.createDataFrame(
        [
            ("app", 1, 0, "HadoopRDD", "s3a://texts/lines.txt", ["s3a://texts/lines.txt"]),
            ("app", 1, 1, "MapPartitionsRDD", None, None),
            ("app", 1, 9, "HadoopRDD", "unrelated", ["s3a://other/x"]),
        ],
        S.RDD_NODE,
    )
    edges = spark.createDataFrame([("app", 1, 1, 0, 0)], S.RDD_EDGE)
    roots = spark.createDataFrame([("app", 1, 1)], "app_id string, job_id bigint, rdd_id bigint")
    output = spark.createDataFrame([("app", 1, "result", "file:/home/result", None)], S.RDD_OUTPUT)
    conf = spark.createDataFrame(ENDPOINT, S.CONF_KV)
    for compat, endpoint in ((False, "store:9100"), (True, r"http:\\\\store:9100")):
        inputs = rddgraph.rdd_inputs(rddgraph.ancestors(edges, roots), nodes, conf, compat=compat).collect()
        assert [r["name"] for r in inputs] == [rf"//s3-custom/endpoint/{endpoint}/buckets/texts/keys/lines.txt"]
    assert rddgraph.rdd_outputs(output, conf).count() == 0


def test_rdd_outputs(spark, rows):
    output = spark.createDataFrame(
        [
            ("app", 1, "result", "s3://old/x", "s3://new/x"),
            ("app", 2, "result", None, "hdfs://nn/y"),
            ("app", 3, "shuffle_map", "s3://old/x", None),
            ("app", 4, "result", None, None),
        ],
        S.RDD_OUTPUT,
    )
    found = rddgraph.rdd_outputs(output, spark.createDataFrame([], S.CONF_KV))
    assert rows(found, "dep_id", "name") == [
        (1, "//s3/cloud/aws/buckets/old/keys/x"),
        (2, r"//hdfs/site/nn/path/\\y"),
    ]


OUT = write("jdbc", url="jdbc:mysql://h/d", dbtable="o")
OUT_NAME = ["//mysql/host/h/databases/d/tables/o"]
GOOD = relation("JDBCRelation", {"url": "jdbc:mysql://h/d", "dbtable": "(select * from a) q"})
GOOD_NAME = ["//mysql/host/h/databases/d/tables/a"]


def test_plain_jdbc_table(items):
    plan = [OUT, relation("JDBCRelation", {"url": "jdbc:mysql://h/d", "dbtable": "t"})]
    assert items(plan)[0] == ["//mysql/host/h/databases/d/tables/t"]
    assert items(plan, compat=True)[0] == []


def test_unknown_database(items):
    plan = [OUT, relation("JDBCRelation", {"url": "jdbc:sqlserver://h;databaseName=d", "dbtable": "(select * from t) q"}), GOOD]
    assert items(plan) == (GOOD_NAME, OUT_NAME, ["UNSUPPORTED_DATABASE"])


@pytest.mark.parametrize(
    "bad, error",
    [
        (relation("HiveTableRelation", catalog=True), "UNSUPPORTED_RELATION"),
        (relation("KafkaRelation", {"kafka.bootstrap.servers": "k"}), "MISSING_OPTION"),
        (relation("HadoopFsRelation", paths=["s3a:///x"]), "BAD_S3_PATH"),
    ],
)
def test_a_failed_input_loses_all_inputs_only_in_compat(items, bad, error):
    assert items([OUT, bad, GOOD]) == (GOOD_NAME, OUT_NAME, [error])
    assert items([OUT, bad, GOOD], compat=True) == ([], OUT_NAME, [error])


def test_a_failed_output_keeps_the_inputs(items):
    for provider, options in (("jdbc", {"url": "jdbc:mysql://h/d"}), (DELTA, {}), (DELTA, {"path": "s3a:///x"})):
        inputs, outputs, errors = items([write(provider, **options), GOOD])
        assert (inputs, outputs, len(errors)) == (GOOD_NAME, [], 1)


def test_slashes_are_an_error_only_in_compat(items):
    plan = [write(DELTA, path="s3a://b/x//y"), GOOD]
    assert items(plan) == (GOOD_NAME, [r"//s3/cloud/aws/buckets/b/keys/x\\y"], [])
    assert items(plan, compat=True) == (GOOD_NAME, [], ["BAD_S3_PATH"])


def test_a_table_text_with_a_dot(items):
    plan = [write("jdbc", url="jdbc:postgresql://h/d", dbtable="audit.orders"), GOOD]
    base = "//postgresql/host/h/databases/d/schemas/"
    assert items(plan)[1] == [base + "audit/tables/orders"]
    assert items(plan, compat=True)[1] == [base + "public/tables/audit.orders"]


def test_blank_topics_count_only_in_compat(items):
    plan = [OUT, relation("KafkaRelation", {"kafka.bootstrap.servers": "k:1", "subscribe": "x,,y"})]
    topics = ["//kafka/cluster/k:1/topics/" + t for t in ("x", "", "y")]
    assert items(plan)[0] == topics[::2]
    assert items(plan, compat=True)[0] == topics


@pytest.mark.parametrize("endpoint", ["http://store:9100", "s3.eu-west-1.amazonaws.com", "store:9100", None])
def test_one_bucket_is_one_dataset_for_both_kinds_of_jobs(spark, items, endpoint):
    conf = [("app", "spark.hadoop.fs.s3a.endpoint", endpoint)] if endpoint else []
    written = items([write(DELTA, path="s3a://lake/stock/"), GOOD], conf)[1]
    nodes = spark.createDataFrame([("app", 1, 0, "HadoopRDD", None, ["s3a://lake/stock"])], S.RDD_NODE)
    closure = nodes.select("app_id", "job_id", "rdd_id")
    read = rddgraph.rdd_inputs(closure, nodes, spark.createDataFrame(conf, S.CONF_KV)).collect()
    assert [r["name"] for r in read] == written and len(written) == 1


def test_dangling_edges_count_as_none(spark, rows):
    nodes = spark.createDataFrame([("a", 1, i, "ShuffledRDD", f"n{i}", None) for i in (1, 2, 3)], S.RDD_NODE)
    edges = spark.createDataFrame([("a", 1, 1, 2, 0), ("a", 1, 2, 9, 0), ("a", 1, 2, 3, 1)], S.RDD_EDGE)
    found = rddgraph.lineage_names(nodes, edges)
    assert rows(found, "rdd_id", "name") == [(1, "n1_n2_n3"), (2, "n2_n3"), (3, "n3")]


def test_delta_write_to_a_local_path_has_no_output(items):
    assert items([write(DELTA, path="/tmp/x"), GOOD]) == (GOOD_NAME, [], [])


def test_missing_targets_are_unknown(items):
    kafka = items([write(KAFKA, **{"kafka.bootstrap.servers": "k:1"})])
    assert kafka[1] == ["//kafka/cluster/k:1/topics/UNKNOWN"]
    snow = items([write(SNOWFLAKE, sfurl="a.b", sfdatabase="D", sfschema="S")])
    assert snow[1] == ["//snowflake/account/a/databases/D/schemas/S/tables/UNKNOWN"]


def test_plans_that_write_nothing(items):
    assert items([other(), GOOD])[0] == GOOD_NAME
    assert items([other(), GOOD], compat=True)[0] == []
    assert items([GOOD], compat=True)[0] == GOOD_NAME


def test_self_join_lists_the_table_twice(items):
    assert items([OUT, GOOD, GOOD])[0] == GOOD_NAME * 2


def test_snowflake_table_instead_of_query(items):
    plan = [OUT, relation("SnowflakeRelation", {"sfurl": "a.b", "sfdatabase": "D", "sfschema": "S", "dbtable": "T"})]
    assert items(plan)[0] == ["//snowflake/account/a/databases/D/schemas/S/tables/T"]
    assert items(plan, compat=True) == ([], OUT_NAME, ["MISSING_OPTION"])


def test_registered_rule(items):
    rules = extract.register_rule(
        extract.default_rules(),
        "iceberg",
        F.col("relation_kind") == "IcebergRelation",
        F.array(F.concat(F.lit("//iceberg/"), F.try_element_at("options", F.lit("table")))),
    )
    plan = [OUT, relation("IcebergRelation", {"Table": "t"}), relation("IcebergRelation", {}), GOOD]
    assert items(plan, rules=rules) == (["//iceberg/t", *GOOD_NAME], OUT_NAME, ["UNRESOLVED"])


def test_first_match_at_the_root(spark):
    data = [("app", i, 0, None, *node) for i, node in enumerate([OUT, GOOD, relation("KafkaRelation", catalog=True), other()])]
    plan = extract.prepare_nodes(spark.createDataFrame(data, S.PLAN_NODE), spark.createDataFrame([], S.CONF_KV))
    rules = [r["rule"] for r in extract.classify_root(plan).orderBy("execution_id").collect()]
    assert rules == ["write", "jdbc", "catalog", None]


def test_closure_of_a_graph_with_diamonds(spark):
    """Layers of two nodes, fully connected: 2 ** 8 paths, 17 nodes."""
    edges = [("app", 1, 16, 14, 0), ("app", 1, 16, 15, 1)]
    for layer in range(7):
        low = 2 * layer
        edges += [("app", 1, low + 2 + up, low + down, down) for up in (0, 1) for down in (0, 1)]
    edges.append(("app", 2, 16, 0, 0))
    roots = spark.createDataFrame([("app", 1, 16), ("app", 2, 16)], "app_id string, job_id bigint, rdd_id bigint")
    closure = rddgraph.ancestors(spark.createDataFrame(edges, S.RDD_EDGE), roots)
    counts = {r["job_id"]: r["count"] for r in closure.groupBy("job_id").count().collect()}
    assert counts == {1: 17, 2: 2}
    assert closure.distinct().count() == 19


def test_lineage_names(spark):
    nodes = spark.createDataFrame(
        [
            ("app", 1, 0, "HadoopRDD", "hdfs://nn/in", ["hdfs://nn/in"]),
            ("app", 1, 1, "MapPartitionsRDD", "hdfs://nn/in", None),
            ("app", 1, 2, "ParallelCollectionRDD", None, None),
            ("app", 1, 3, "UnionRDD", None, None),
            ("app", 1, 4, "MapPartitionsRDD", "union", None),
        ],
        S.RDD_NODE,
    )
    edges = [("app", 1, 1, 0, 0), ("app", 1, 3, 1, 0), ("app", 1, 3, 2, 1), ("app", 1, 4, 3, 0)]
    named = rddgraph.lineage_names(nodes, spark.createDataFrame(edges, S.RDD_EDGE))
    assert {r["rdd_id"]: r["name"] for r in named.collect()} == {
        0: "hadoop",
        1: "map_partitions_hadoop",
        2: "parallel_collection",
        3: "union_map_partitions_hadoop_parallel_collection",
        4: "union_map_partitions_hadoop_parallel_collection",
    }


def chain(app, n, job=1):
    return [(app, job, k, k - 1, 0) for k in range(1, n)]


def rounds_of(spark, label, below=""):
    """How many rounds the newest run with this label has stored."""
    base = f"{shared_dir(spark)}/headwater"
    newest = max((c for c in children(spark, base) if c.name.startswith(f"{label}-")), key=lambda c: c.modified_ms)
    return sum(c.name.startswith("round=") for c in children(spark, f"{base}/{newest.name}{below}"))


def test_closure_of_a_deep_graph_takes_few_rounds(spark, monkeypatch):
    """Graphs that are too large for a task."""
    monkeypatch.setattr(rddgraph, "GRAPH_SIZE", 5)
    edges = spark.createDataFrame(chain("deep", 200) + chain("short", 3) + chain("rootless", 9), S.RDD_EDGE)
    roots = spark.createDataFrame([("deep", 1, 199), ("short", 1, 1)], "app_id string, job_id bigint, rdd_id bigint")
    closure = rddgraph.ancestors(edges, roots)
    assert {r["app_id"]: r["count"] for r in closure.groupBy("app_id").count().collect()} == {"deep": 200, "short": 2}
    assert closure.distinct().count() == 202
    assert rounds_of(spark, "ancestors", "/reached") <= 10


@pytest.mark.parametrize("size", [10, 200_000])
def test_closure_of_random_graphs(spark, monkeypatch, size):
    monkeypatch.setattr(rddgraph, "GRAPH_SIZE", size)
    rng, edges, expected = random.Random(1), [], set()
    for job in range(12):
        n = rng.randrange(2, 40)
        own = {(k, rng.randrange(k)) for k in range(1, n) for _ in range(rng.randrange(0, 3))}
        edges += [("a", job, k, d, 0) for k, d in own]
        open_ones = [n - 1]
        while open_ones:
            k = open_ones.pop()
            if (job, k) not in expected:
                expected.add((job, k))
                open_ones += [d for x, d in own if x == k]
    roots = {job: max(k for j, k in expected if j == job) for job in range(12)}
    frame = spark.createDataFrame([("a", job, k) for job, k in roots.items()], "app_id string, job_id bigint, rdd_id bigint")
    found = [(r.job_id, r.rdd_id) for r in rddgraph.ancestors(spark.createDataFrame(edges, S.RDD_EDGE), frame).collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def graph_nodes(spark, edges, name=lambda k: f"n{k}"):
    ids = sorted({(app, job, k) for app, job, a, b, _ in edges for k in (a, b)})
    return spark.createDataFrame([(app, job, k, "ShuffledRDD", name(k), None) for app, job, k in ids], S.RDD_NODE)


@pytest.fixture(params=["tasks", "rounds"])
def walk(request, monkeypatch):
    """How graphs are walked: in tasks, or in rounds as very large ones are."""
    if request.param == "rounds":
        monkeypatch.setattr(rddgraph, "GRAPH_SIZE", 3)
    return request.param


def test_names_of_a_deep_graph(spark, walk):
    n = 200 if walk == "tasks" else 20
    edges = chain("deep", n) + chain("small", 2)
    found = rddgraph.lineage_names(graph_nodes(spark, edges), spark.createDataFrame(edges, S.RDD_EDGE)).collect()
    names = {(r.app_id, r.rdd_id): r.name for r in found}
    assert len(found) == n + 2 and names["small", 1] == "n1_n0"
    assert names["deep", n - 1] == "_".join(f"n{k}" for k in range(n - 1, -1, -1))
    assert all(r.n_chars == len(r.name) for r in found)


def test_names_that_double_are_counted_not_spelled_out(spark, monkeypatch, walk):
    """Thirty diamonds on top of each other: the name of the top has some 2 ** 31 parts."""
    edges, levels = [], 30 if walk == "tasks" else 12
    for level in range(levels):
        low = 3 * level
        edges += [("x", 1, low + 1, low, 0), ("x", 1, low + 2, low, 0), ("x", 1, low + 3, low + 1, 0), ("x", 1, low + 3, low + 2, 1)]
    monkeypatch.setattr(rddgraph, "MOST_CHARS", 2000)
    found = {r.rdd_id: r for r in rddgraph.lineage_names(graph_nodes(spark, edges), spark.createDataFrame(edges, S.RDD_EDGE)).collect()}
    text, expected = {0: "n0"}, {0: 2}
    for level in range(levels):
        low = 3 * level
        for k in (low + 1, low + 2):
            expected[k] = len(f"n{k}") + 1 + expected[low]
            text[k] = f"n{k}_{text[low]}"[:5000]
        expected[low + 3] = len(f"n{low + 3}") + 2 + expected[low + 1] + expected[low + 2]
        text[low + 3] = f"n{low + 3}_{text[low + 1]}_{text[low + 2]}"[:5000]
    assert {k: r.n_chars for k, r in found.items()} == expected and expected[3 * levels] > 2 ** (levels + 1)
    assert all(found[k].name == (text[k] if n <= 2000 else None) for k, n in expected.items())


def test_names_wait_for_all_dependencies(spark, walk):
    """An RDD that depends on a leaf and on the end of a chain; a circle gets no names and holds up nothing."""
    edges = chain("a", 6) + [("a", 1, 9, 0, 1), ("a", 1, 9, 5, 0), ("b", 1, 1, 2, 0), ("b", 1, 2, 1, 0), ("b", 1, 3, 4, 0)]
    found = rddgraph.lineage_names(graph_nodes(spark, edges), spark.createDataFrame(edges, S.RDD_EDGE)).collect()
    names = {(r.app_id, r.rdd_id): r.name for r in found}
    assert names["a", 9] == "n9_n5_n4_n3_n2_n1_n0_n0" and names["b", 3] == "n3_n4"
    assert ("b", 1) not in names and len(names) == 9


def test_slices_of_the_applications_give_the_same_lineage(spark, monkeypatch):
    apps = [f"app-{k}" for k in range(12)]
    start = [(a, a, S.APP_START, 1, None, None, None, None, None, {"spark.hadoop.fs.s3a.endpoint": "http://store:9100"}) for a in apps]
    begun = [(a, None, S.SQL_START, 2, None, 1, None, None, None, None) for a in apps]
    nodes = [(a, 1, 0, None, *write(KAFKA, **{"kafka.bootstrap.servers": "k:1", "topic": a})) for a in apps]
    nodes += [(a, 1, 1, 0, *relation("HadoopFsRelation", paths=[f"s3a://lake/{a}"])) for a in apps]
    given = pipelines.Facts(
        spark.createDataFrame([*start, *begun], S.LISTENER_EVENT),
        spark.createDataFrame(nodes, S.PLAN_NODE),
        spark.createDataFrame([], S.RDD_NODE),
        spark.createDataFrame([], S.RDD_EDGE),
        spark.createDataFrame([], "app_id string, job_id bigint, rdd_id bigint"),
        spark.createDataFrame([], S.RDD_OUTPUT),
    )
    made = []
    sql_items = pipelines.sql_items
    monkeypatch.setattr(pipelines, "sql_items", lambda facts, *rest: made.append(facts.plan_nodes.count()) or sql_items(facts, *rest))
    whole = sorted(map(tuple, pipelines.build_lineage(given).edges().collect()))
    monkeypatch.setattr(pipelines, "SLICE_NODES", 10)
    parts = sorted(map(tuple, pipelines.build_lineage(given).edges().collect()))
    assert parts == whole and len(whole) == 24
    assert len(made) == 4 and made[0] == 24 and sum(made[1:]) == 24
