"""Plans of steps that have to scale: where rows are dealt out, and what is worked out how often."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from headwater.functions import sqltext
from headwater.functions.names import s3_name
from headwater.operators import extract, rddgraph, rollup
from headwater.plans import facts
from headwater.session import cut_lineage
from headwater.skew import large_groups
from headwater.sources import eventlog


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def part_dir(spark, tmp_path):
    rows = [(k, f"TYPE {k}", k % 3) for k in range(44)]
    spark.createDataFrame(rows, "p_partkey bigint, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_texts_are_dealt_out_and_read_in_batches(spark, part_dir):
    found = queries()["sql_tables_of_text"](spark, part_dir)
    plan = plan_of(found)
    assert "RoundRobinPartitioning" in plan and "ArrowEvalPython" in plan
    assert found.where("n_tables > 0").count() == 44


def test_each_part_of_an_s3_name_is_worked_out_once(spark):
    uri, endpoint = F.col("uri"), F.col("endpoint")
    named = spark.createDataFrame([("s3a://b//k/", "http://minio:9000")], "uri string, endpoint string").select(
        F.transform(F.array(uri), lambda u: s3_name(u, endpoint, endpoint)).alias("names")
    )
    text = named._jdf.queryExecution().optimizedPlan().expressions().toString()
    # the path and the host once, the bucket and the key once in either branch
    assert text.count("regexp_extract(") == 6
    assert named.first().names == [r"//s3-custom/endpoint/minio:9000/buckets/b/keys/k"]


def test_equal_edge_sets_take_two_shuffles_of_items(spark, rows, monkeypatch):
    names = "app_id string, dep_id bigint, direction string, node_id bigint, item bigint, name string, error string"
    data = [
        (app, dep, direction, node, 0, f"d{node % 2}" if dep % 3 else f"e{dep}", None)
        for app in ("a", "b") for dep in range(9) for direction in ("input", "output") for node in range(dep % 2 + 1)
    ]
    items = cut_lineage(spark.createDataFrame([*data, (None, 1, "input", 0, 0, "x", None), ("a", 1, "input", 9, 0, None, "E")], names))
    found = rollup.distinct_deps(items)
    assert plan_of(found).count("Exchange hashpartitioning") == 2
    kept = rows(found, *items.columns)
    assert {(r[0], r[1]) for r in kept} == {(app, dep) for app in ("a", "b") for dep in (0, 1, 2, 3, 6)}
    assert set(kept) <= set(data)
    monkeypatch.setattr(rollup, "LIST_SIZE", 2)
    assert rows(rollup.distinct_deps(items), *items.columns) == kept
    monkeypatch.setattr(rollup, "LIST_SIZE", 0)
    assert rows(rollup.distinct_deps(items), *items.columns) == kept


def test_visible_items_take_one_shuffle(spark, rows):
    def node(execution, node_id, parent, kind, relation=None, **options):
        return ("app", execution, node_id, parent, kind, relation, None, options, None, relation == "Hive", None, None)

    kafka = {"kafka.bootstrap.servers": "k:9092", "subscribe": "t"}
    nodes = spark.createDataFrame(
        [
            node(1, 0, None, extract.WRITE_NODE), node(1, 1, 0, extract.RELATION_NODE, "KafkaRelation", **kafka),
            node(2, 0, None, extract.WRITE_NODE), node(2, 1, 0, extract.RELATION_NODE, "KafkaRelation", **kafka),
            node(2, 2, 0, extract.RELATION_NODE, "Hive"),
            node(3, 0, None, "Project"), node(3, 1, 0, extract.RELATION_NODE, "KafkaRelation", **kafka),
            node(4, 0, None, extract.RELATION_NODE, "KafkaRelation", **kafka),
            # two roots show the nodes below them twice
            node(5, 0, None, extract.WRITE_NODE), node(5, 0, None, extract.WRITE_NODE),
            node(5, 1, 0, extract.RELATION_NODE, "KafkaRelation", **kafka),
            node(None, 0, None, extract.WRITE_NODE), node(None, 1, 0, extract.RELATION_NODE, "KafkaRelation", **kafka),
        ],
        "app_id string, execution_id bigint, node_id bigint, parent_id bigint, node_kind string, relation_kind string, "
        "provider string, options map<string,string>, root_paths array<string>, has_catalog_table boolean, "
        "s3a_endpoint string, s3n_endpoint string",
    )
    seen = extract.write_inputs(nodes, root_only=True)
    assert plan_of(seen).count("Exchange") == 1
    shown = [(1, 1, None), (2, 1, None), (2, 2, "UNSUPPORTED_RELATION"), (4, 0, None), (5, 1, None), (5, 1, None)]
    assert sorted(rows(seen, "dep_id", "node_id", "error"), key=lambda r: r[:2]) == shown
    compat = extract.plan_items(nodes, compat=True)
    assert plan_of(compat).count("Exchange") == 1
    inputs = sorted(rows(compat.where("direction = 'input'"), "dep_id", "node_id", "error"), key=lambda r: r[:2])
    assert inputs == [r for r in shown if r != (2, 1, None)]
    assert compat.where("direction = 'output'").count() == 5


def test_graphs_are_worked_out_once(spark, rows):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def once(data, schema):
        return spark.createDataFrame(data, schema).mapInArrow(counted, schema)

    nodes = once(
        [("a", 1, 1, "HadoopRDD", "/x", ["/x"]), ("a", 1, 2, "MapPartitionsRDD", "/x", None)],
        "app_id string, job_id bigint, rdd_id bigint, rdd_class string, rdd_name string, input_paths array<string>",
    )
    edges = once([("a", 1, 2, 1, 0)], "app_id string, job_id bigint, rdd_id bigint, dep_rdd_id bigint, dep_pos int")
    found = rows(rddgraph.lineage_names(nodes, edges), "rdd_id", "name")
    assert found == [(1, "hadoop"), (2, "map_partitions_hadoop")]
    assert read.value == 3
    roots = once([("a", 1, 2)], "app_id string, job_id bigint, rdd_id bigint")
    assert rows(rddgraph.ancestors(edges, roots), "rdd_id") == [(1,), (2,)]
    assert read.value == 5


NODES = (
    "app_id string, execution_id bigint, node_id bigint, parent_id bigint, node_kind string, relation_kind string, "
    "provider string, options map<string,string>, root_paths array<string>, has_catalog_table boolean"
)


def test_only_nodes_with_paths_meet_the_configuration(spark, rows):
    delta = f"x.{extract.DELTA_PROVIDER}"
    nodes = spark.createDataFrame(
        [
            ("app", 1, 0, None, extract.WRITE_NODE, None, delta, {"Path": "s3a://b/k"}, None, False),
            ("app", 1, 1, 0, extract.RELATION_NODE, extract.FILE_RELATION, None, {}, ["s3n://c/x", "hdfs://nn/y"], None),
            ("app", 1, 2, 0, extract.RELATION_NODE, extract.JDBC_RELATION, None, {"URL": "jdbc:mysql://h/d", "dbtable": "t"}, None, None),
            (None, None, 3, None, None, None, None, None, None, None),
            ("other", 2, 0, None, extract.RELATION_NODE, extract.FILE_RELATION, None, None, ["s3a://d"], None),
        ],
        NODES,
    )
    keys = extract.KEYS
    conf = spark.createDataFrame([("app", keys.s3a_endpoint, "http://a:1"), ("app", keys.s3n_endpoint, "n")], "app_id string, key string, value string")
    few = extract.prepare_nodes(nodes, conf, paths_only=True)
    ends = {r.node_id: (r.s3a_endpoint, r.s3n_endpoint) for r in few.where("app_id = 'app' or app_id is null").collect()}
    assert ends == {0: ("http://a:1", "n"), 1: ("http://a:1", "n"), 2: (None, None), 3: (None, None)}
    assert few.count() == 5
    for compat in (False, True):
        items = extract.plan_items(few, compat=compat)
        assert rows(items) == rows(extract.plan_items(extract.prepare_nodes(nodes, conf), compat=compat))


def test_plan_nodes_are_spread_without_a_sort(spark, tmp_path):
    tables = {
        "orders": ([(1, 7, "O", "1-URGENT"), (2, None, "P", "5-LOW")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"),
        "lineitem": (
            [(1, 3, 2, 1, "A", "F"), (1, 3, None, 2, "N", "F"), (2, 4, 5, 1, None, "O"), (2, 4, 5, 7, "N", "F")],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_linestatus string",
        ),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    nodes = facts.plan_nodes(spark, str(tmp_path))
    for found in (nodes, facts.rdd_steps(spark, str(tmp_path)), facts.rdd_roots(spark, str(tmp_path))):
        assert "RoundRobinPartitioning" not in plan_of(found)
    options = {(r.execution_id, r.node_id): r.options for r in nodes.collect()}
    assert options[(1, 26)] == {}
    assert options[(2, 39)] == {"Kafka.Bootstrap.Servers": "in-2:9092"} and options[(2, 33)] == {}
    assert options[(2, 0)] == {"kafka.bootstrap.servers": "broker-low:9092", "subscribe": "low"}


def test_wrapped_queries_lose_their_parentheses(spark, rows):
    texts = ["(select 1 from a) q", " \n(x (y) z) q\n", "()", "(", ")", ")(", "(a) (b) c", "(a) b (", "x (a)", "", None, "(é(ü)) ß"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.regexp_replace("t", r"^\s*\(([\s\S]*)\)[^()]*$", "$1")
    different = frame.where(~sqltext._unwrapped(F.col("t")).eqNullSafe(by_pattern))
    assert rows(different) == []


def test_null_texts_of_a_batch_cost_no_loop(spark, rows):
    frame = spark.createDataFrame([(1, None), (2, "select * from a join b"), (3, None), (4, "select 1")], "k int, t string")
    found = frame.coalesce(1).select("k", sqltext.sql_tables(F.col("t")).alias("tables"))
    assert rows(found) == [(1, None), (2, ["a", "b"]), (3, None), (4, [])]


def test_more_items_go_to_more_tasks(spark, rows, monkeypatch):
    items = cut_lineage(
        spark.createDataFrame(
            [("a", k, way, 1, 0, f"{way}-{k % 3}") for k in range(9) for way in ("input", "output")] + [("a", None, "input", 1, 0, "x")],
            "app_id string, dep_id bigint, direction string, node_id bigint, item bigint, name string",
        )
    )
    found = rollup.distinct_deps(items)
    kept = rows(found)
    assert [r[1] for r in kept] == [0, 0, 1, 1, 2, 2] and "REPARTITION" not in plan_of(found)
    monkeypatch.setattr(rollup, "TASK_ITEMS", 2)
    found = rollup.distinct_deps(items)
    assert plan_of(found).count("REPARTITION_BY_NUM") == 2
    assert rows(found) == kept


def test_settings_are_rows_without_a_map(spark, rows, tmp_path):
    customers = [(1, 1, "FURNITURE", "a", 1.0), (2, 10, None, "b", 1.0), (None, None, "BUILDING", "c", 1.0)]
    frame = spark.createDataFrame(customers, "c_custkey bigint, c_nationkey int, c_mktsegment string, c_name string, c_acctbal double")
    frame.write.parquet(f"{tmp_path}/customer.parquet")
    found = facts.conf(spark, str(tmp_path))
    assert "map_filter" not in plan_of(found)
    by_map = facts.conf_map(facts.table(spark, str(tmp_path), "customer")).select("app_id", F.explode("conf").alias("key", "value"))
    assert rows(found) == rows(by_map) and found.count() == 8


PREPARED_NODES = (
    "app_id string, execution_id bigint, node_id bigint, parent_id bigint, node_kind string, relation_kind string, "
    "provider string, options map<string,string>, root_paths array<string>, has_catalog_table boolean, "
    "s3a_endpoint string, s3n_endpoint string"
)


def test_items_are_named_after_their_texts_are_exploded(spark, rows):
    def node(node_id, relation, options, paths=None, catalog=False):
        return ("app", 1, node_id, 0, extract.RELATION_NODE, relation, None, options, paths, catalog, "http://minio:9000", None)

    jdbc = {"url": "jdbc:mysql://h/d", "dbtable": "(select * from a join b on 1 = 1) q"}
    flake = {"sfurl": "acct.x", "sfdatabase": "D", "sfschema": "S"}
    nodes = spark.createDataFrame(
        [
            node(1, extract.FILE_RELATION, {}, ["s3a://b//k/", "hdfs://nn/x", "s3a:///", None, "s3://c"]),
            node(2, extract.JDBC_RELATION, jdbc), node(3, extract.JDBC_RELATION, {"dbtable": "t"}),
            node(4, extract.SNOWFLAKE_RELATION, {**flake, "query": "select 1 from T"}), node(5, extract.SNOWFLAKE_RELATION, flake),
            # two rules accept the node: the items of the second come after those of the first
            node(6, extract.KAFKA_RELATION, {"kafka.bootstrap.servers": "k:1", "subscribe": "t, ,u"}, catalog=True),
        ],
        PREPARED_NODES,
    )
    found = extract.write_inputs(nodes)
    assert plan_of(found).count("_tables_of_texts(") == 1
    assert sorted(rows(found, "node_id", "item", "name", "error"), key=lambda r: r[:2]) == [
        (1, 0, "//s3-custom/endpoint/minio:9000/buckets/b/keys/k", None), (1, 2, None, "BAD_S3_PATH"), (1, 4, "//s3/cloud/aws/buckets/c", None),
        (2, 0, "//mysql/host/h/databases/d/tables/a", None), (2, 1, "//mysql/host/h/databases/d/tables/b", None),
        (3, 0, None, "MISSING_OPTION"),
        (4, 0, "//snowflake/account/acct/databases/D/schemas/S/tables/T", None), (5, 0, None, "MISSING_OPTION"),
        (6, 0, None, "UNSUPPORTED_RELATION"), (6, 1, "//kafka/cluster/k:1/topics/t", None), (6, 2, "//kafka/cluster/k:1/topics/u", None),
    ]


def test_nodes_without_texts_are_counted_and_have_no_items(spark, rows):
    def node(execution, node_id, parent, kind, relation=None, options=None):
        return ("app", execution, node_id, parent, kind, relation, None, options or {}, None, False, None, None)

    topics = {"kafka.bootstrap.servers": "k", "subscribe": "t"}
    nodes = spark.createDataFrame(
        [
            node(1, 0, None, extract.WRITE_NODE), node(1, 1, 0, extract.RELATION_NODE, extract.FILE_RELATION),
            node(1, 2, 0, extract.RELATION_NODE, extract.KAFKA_RELATION, topics),
            # without a query, an error loses the names of its execution
            node(2, 0, None, extract.WRITE_NODE), node(2, 1, 0, extract.RELATION_NODE, extract.SNOWFLAKE_RELATION),
            node(2, 2, 0, extract.RELATION_NODE, extract.KAFKA_RELATION, topics),
        ],
        PREPARED_NODES,
    )
    plain = extract.write_inputs(nodes, root_only=True)
    named = "//kafka/cluster/k/topics/t"
    assert sorted(rows(plain, "dep_id", "node_id", "name")) == [(1, 2, named), (2, 1, None), (2, 2, named)]
    lossy = extract.plan_items(nodes, compat=True).where("direction = 'input'")
    assert sorted(rows(lossy, "dep_id", "node_id", "name")) == [(1, 2, named), (2, 1, None)]


def test_parts_of_a_path_are_worked_out_once_for_its_name(spark, rows):
    closure = spark.createDataFrame([("a", 1, 1)], "app_id string, job_id bigint, rdd_id bigint")
    nodes = spark.createDataFrame(
        [("a", 1, 1, "HadoopRDD", None, ["s3a://b/k", "hdfs://nn:1/x", "file:/y", "s3://c//d/"])],
        "app_id string, job_id bigint, rdd_id bigint, rdd_class string, rdd_name string, input_paths array<string>",
    )
    conf = spark.createDataFrame([("a", extract.KEYS.s3a_endpoint, "http://m:1")], "app_id string, key string, value string")
    for compat, host, last in ((False, "m:1", "c/keys/d"), (True, "http:\\\\\\\\m:1", "c/keys/\\\\d\\\\")):
        found = rddgraph.rdd_inputs(closure, nodes, conf, compat=compat)
        # made in the plan once each: two of a namespace, the path, the site, and for S3 the rest and the host
        assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") <= 6
        assert sorted(rows(found, "item", "name")) == [
            (0, f"//s3-custom/endpoint/{host}/buckets/b/keys/k"), (1, "//hdfs/site/nn:1/path/\\\\x"), (3, f"//s3/cloud/aws/buckets/{last}"),
        ]


def test_values_of_arrow_columns_are_those_of_python():
    lists = pa.array([[1, 2], None, [], [3], [4, None]], pa.list_(pa.int64()))
    ints, texts = pa.array([1, None, 2**62 + 1], pa.int64()), pa.array(["a", None, "é"])
    for column in (lists, lists[1:4], lists[2:], ints, ints[2:], ints[:0], texts, texts[1:]):
        assert rddgraph._values(column) == column.to_pylist()


def test_graphs_without_roots_and_without_keys_give_no_closure(spark, rows):
    edges = spark.createDataFrame(
        [("a", 1, 3, 2), ("a", 1, 2, 1), ("a", 2, 3, 2), (None, 1, 3, 2), ("a", 1, 9, 8), ("a", 1, 3, None)],
        "app_id string, job_id bigint, rdd_id bigint, dep_rdd_id bigint",
    )
    roots = spark.createDataFrame([("a", 1, 3), (None, 1, 3)], "app_id string, job_id bigint, rdd_id bigint")
    found = rows(rddgraph.ancestors(edges, roots), *rddgraph.NODE)
    assert sorted(found, key=str) == [("a", 1, 1), ("a", 1, 2), ("a", 1, 3), (None, 1, 3)]


def test_graphs_are_named_in_one_shuffle_without_joins(spark, rows):
    nodes = spark.createDataFrame(
        [
            ("a", 1, 1, "HadoopRDD", "/x", ["/x/y"]), ("a", 1, 2, "MapPartitionsRDD", "/x", None),
            ("a", 1, 3, "MapPartitionsRDD", "own", None), ("b", 1, 1, "ShuffledRDD", None, None),
            ("a", None, 7, "ShuffledRDD", "n7", None), ("b", 1, 2, None, None, None), ("a", 1, 2, "MapPartitionsRDD", "/x", None),
        ],
        "app_id string, job_id bigint, rdd_id bigint, rdd_class string, rdd_name string, input_paths array<string>",
    )
    # an RDD that comes before what it depends on, one that isn't there, edges without a position and without an end
    edges = [("a", 1, 1, 3, 0), ("a", 1, 2, 1, 0), ("a", 1, 3, 9, 0), ("b", 1, 2, 1, None), ("b", 1, 1, None, 0), ("a", None, 7, 7, 0)]
    found = rddgraph.lineage_names(nodes, spark.createDataFrame(edges, "app_id string, job_id bigint, rdd_id bigint, dep_rdd_id bigint, dep_pos int"))
    plan = plan_of(found)
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert rows(found, "app_id", "job_id", "rdd_id", "name") == [
        ("a", 1, 1, "hadoop_own"), ("a", 1, 2, "map_partitions_hadoop_own"), ("a", 1, 3, "own"), ("a", None, 7, "n7"),
        ("b", 1, 1, "shuffled"), ("b", 1, 2, "shuffled"),
    ]


def test_a_log_is_parsed_once_for_its_names(spark, rows, tmp_path, monkeypatch):
    orders = [(k, k % 3, "OFP"[k % 3], ("1-URGENT", "5-LOW", None)[k % 3]) for k in range(1, 8)]
    given = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string")
    given.withColumn("o_orderdate", F.timestamp_seconds(F.lit(700_000_000)).cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    scans, real = [], eventlog._all_lines
    monkeypatch.setattr(eventlog, "_all_lines", lambda *args: scans.append(args) or real(*args))
    found = rows(queries()["event_log_names"](spark, str(tmp_path)), "job_id", "rdd_id", "name")
    assert len(scans) == 1
    lists = {k: f"s3a://logs/{k},s3a://logs/all" for k, *_ in orders}
    assert found == sorted([(k, 2 * k, lists[k]) for k in lists] + [(k, 2 * k + 1, f"map_partitions_{lists[k]}") for k in lists], key=repr)


def test_groups_are_counted_in_buckets_first(spark, rows):
    given = cut_lineage(spark.createDataFrame([("a", k % 40) for k in range(200)] + [("b", 7)] * 6 + [(None, None)] * 9, "x string, y bigint"))
    assert large_groups(given, ["x", "y"], 9) is None
    assert rows(large_groups(given, ["x", "y"], 8)) == [(None, None)]
    assert rows(large_groups(given, ["x", "y"], 5)) == [("b", 7), (None, None)]
    assert large_groups(given, ["x", "y"], 4).count() == 42


def test_edge_sets_are_sorted_by_numbers_and_their_sizes_counted_in_buckets(spark, rows, monkeypatch):
    items = cut_lineage(
        spark.createDataFrame(
            [(f"a{k % 2}", k, way, 1, 0, f"{way}-{k % 3}") for k in range(12) for way in ("input", "output")],
            "app_id string, dep_id bigint, direction string, node_id bigint, item bigint, name string",
        )
    )
    counted, real = [], rollup.large_groups
    monkeypatch.setattr(rollup, "large_groups", lambda *args: counted.append(args[3]) or real(*args))
    found = rollup.distinct_deps(items)
    assert counted == [24]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate(keys=[dep_id" in plan and "Sort [bits" in plan
    assert {r[1] for r in rows(found)} == {0, 1, 2, 3, 4, 5}


def test_lines_are_joined_before_they_are_named(spark, rows, tmp_path):
    spark.createDataFrame([(1, 7), (2, None)], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 4, 5, 1), (2, 4, 5, 1), (1, None, 5, 2), (3, 4, 5, 1)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    items = facts.order_items(spark, str(tmp_path), coarse=True)
    text = items._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Generate explode") < text.index("Join Inner") and "part-" not in text[text.index("Join Inner") :]
    assert rows(items) == sorted(
        [
            ("app-7", 1, "input", 33, 0, "part-1"), ("app-7", 1, "output", 33, 0, "supp-1"),
            ("app-7", 1, "input", None, 0, None), ("app-7", 1, "output", None, 0, "supp-1"),
            (None, 2, "input", 33, 0, "part-1"), (None, 2, "output", 33, 0, "supp-1"),
        ],
        key=repr,
    )
