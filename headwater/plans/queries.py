"""The registered queries: every operator over the driver's whole tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Lists and maps are shown
as rows or as sorted text, times as epoch milliseconds or ISO text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater import schemas as S
from headwater.functions import names as N
from headwater.functions import scalars as X
from headwater.functions.sqltext import sql_tables
from headwater.operators import conf as C
from headwater.operators import entities as E
from headwater.operators import etl, extract, rddgraph, rollup, routing
from headwater.plans import facts, pipelines
from headwater.session import cut_lineage, work_path
from headwater.sinks import writers as K
from headwater.skew import lookup_join
from headwater.sources import eventlog, readers
from headwater.streaming import flush, rollup as stream_rollups

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[function.__name__] = function
    return function


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.prepare_nodes(facts.plan_nodes(spark, sf_dir), facts.conf(spark, sf_dir), paths_only=True)


# --- Rollups ------------------------------------------------------------------


@query
def lineage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per application: datasets in and out, and the record of its run."""
    items = rollup.distinct_deps(cut_lineage(facts.order_items(spark, sf_dir, coarse=False)))
    is_input = F.col("direction") == "input"
    counts = rollup.app_lineage(items).groupBy("app_id").agg(
        F.sum(F.when(is_input, F.col("n"))).alias("n_inputs"),
        F.count_if(is_input).alias("n_input_datasets"),
        F.sum(F.when(~is_input, F.col("n"))).alias("n_outputs"),
        F.count_if(~is_input).alias("n_output_datasets"),
    )
    runs = rollup.run_status(facts.order_events(spark, sf_dir))
    host = F.lit("orders")
    return runs.join(counts, "app_id", "left").select(
        "app_id",
        N.spark_name(host, F.col("app_id"), F.col("end_ms")).alias("run_name"),
        X.run_label(F.col("app_id"), F.col("end_ms")).alias("run_label"),
        _iso(X.ms_to_ts(F.col("end_ms"))).alias("end_time"),
        "status",
        "status_reason",
        "n_failed",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_inputs", "n_input_datasets", "n_outputs", "n_output_datasets")],
    )


@query
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.run_status(facts.order_events(spark, sf_dir))


@query
def end_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.end_time(facts.events(spark, sf_dir))


@query
def metadata_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.merge_metadata(facts.user_events(facts.table(spark, sf_dir, "events")))


@query
def merged_deps(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = facts.order_items(spark, sf_dir, coarse=False)
    return rollup.merge_deps(items, ["app_id"], ["dep_id", "node_id", "name"]).select(
        "app_id", "direction", "pos", "name"
    )


@query
def deps_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = rollup.distinct_deps(cut_lineage(facts.order_items(spark, sf_dir, coarse=True)))
    return items.select("app_id", "dep_id", "direction", "node_id", "name")


@query
def app_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.app_lineage(rollup.distinct_deps(cut_lineage(facts.order_items(spark, sf_dir, coarse=True))))


@query
def app_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.app_lineage(facts.order_items(spark, sf_dir, coarse=False), distinct=True)


@query
def rollup_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup_apps(facts.events(spark, sf_dir))


# --- Routing ------------------------------------------------------------------


@query
def classify_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = routing.classify_jobs(facts.events(spark, sf_dir))
    return jobs.select("app_id", "job_id", "event_ms", "job_kind", "execution_id")


@query
def sql_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.sql_triggers(facts.events(spark, sf_dir))


@query
def matched_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    triggers = routing.sql_triggers(facts.events(spark, sf_dir))
    matched = routing.with_plans(triggers, facts.plan_nodes(spark, sf_dir))
    return matched.select("app_id", "execution_id", "node_id", "node_kind", "relation_kind")


@query
def skipped_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    triggers = routing.sql_triggers(facts.events(spark, sf_dir))
    return routing.skipped(triggers, facts.plan_children(spark, sf_dir))


@query
def rdd_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = routing.with_rdd_job(facts.events(spark, sf_dir), facts.rdd_nodes(spark, sf_dir))
    return nodes.select("app_id", "job_id", "rdd_id", "rdd_class")


# --- Configuration ------------------------------------------------------------


@query
def conf_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.conf_kv(facts.events(spark, sf_dir))


@query
def conf_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = routing.classify_jobs(facts.events(spark, sf_dir)).select("app_id", "job_id")
    return C.with_conf(jobs, facts.conf(spark, sf_dir), C.KEYS.s3a_endpoint, "none", "endpoint", ["job_id"])


@query
def conf_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = C.conf_columns(facts.conf(spark, sf_dir), flag=C.KEYS.enabled, host=C.KEYS.host_key)
    return flags.select("app_id", X.conf_flag(F.col("flag")).alias("enabled"))


@query
def route_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.route_apps(facts.events(spark, sf_dir), facts.conf(spark, sf_dir))


# --- Plan extraction ----------------------------------------------------------


@query
def classify_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.classify_node(_nodes(spark, sf_dir)).select("app_id", "execution_id", "node_id", "rule")


@query
def classify_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.classify_root(facts.plan_roots(spark, sf_dir).transform(_bare)).select(
        "app_id", "execution_id", "rule"
    )


def _bare(nodes: DataFrame) -> DataFrame:
    """Nodes without endpoints, for operators that name no S3 path."""
    none = F.lit(None).cast("string")
    return nodes.withColumn("options", X.lower_keys(F.col("options"))).withColumns(
        {"s3a_endpoint": none, "s3n_endpoint": none}
    )


@query
def write_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.write_inputs(_nodes(spark, sf_dir))


@query
def write_inputs_root_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.write_inputs(_nodes(spark, sf_dir), root_only=True)


@query
def plan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.plan_items(_nodes(spark, sf_dir))


@query
def plan_items_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.plan_items(_nodes(spark, sf_dir), compat=True)


@query
def file_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.file_inputs(_nodes(spark, sf_dir))


@query
def jdbc_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.jdbc_inputs(facts.plan_nodes(spark, sf_dir).transform(_bare))


@query
def jdbc_inputs_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.jdbc_inputs(facts.plan_nodes(spark, sf_dir).transform(_bare), compat=True)


@query
def file_inputs_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.file_inputs(_nodes(spark, sf_dir), compat=True)


@query
def kafka_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.kafka_inputs(facts.plan_nodes(spark, sf_dir).transform(_bare))


@query
def kafka_inputs_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.kafka_inputs(facts.plan_nodes(spark, sf_dir).transform(_bare), compat=True)


@query
def snowflake_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.snowflake_inputs(facts.plan_nodes(spark, sf_dir).transform(_bare))


@query
def delta_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.delta_outputs(_nodes(spark, sf_dir))


@query
def kafka_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.kafka_outputs(facts.plan_roots(spark, sf_dir).transform(_bare))


@query
def snowflake_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.snowflake_outputs(facts.plan_roots(spark, sf_dir).transform(_bare))


@query
def jdbc_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.jdbc_outputs(facts.plan_roots(spark, sf_dir).transform(_bare))


@query
def jdbc_outputs_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.jdbc_outputs(facts.plan_roots(spark, sf_dir).transform(_bare), compat=True)


@query
def delta_outputs_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.delta_outputs(_nodes(spark, sf_dir), compat=True)


@query
def extract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_errors(extract.plan_items(_nodes(spark, sf_dir)))


@query
def unsupported_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.unsupported(facts.plan_nodes(spark, sf_dir).transform(_bare))


@query
def custom_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered rule that names filter steps, next to the built-in rules."""
    step = F.concat(F.lit("//step/"), F.col("node_id").cast("string"))
    rules = extract.register_rule(
        extract.default_rules(), "filter_step", F.col("node_kind") == "Filter", F.array(step), priority=50
    )
    nodes = extract.write_inputs(facts.plan_nodes(spark, sf_dir).transform(_bare), rules)
    return nodes.groupBy("app_id", F.col("name").startswith("//step/").alias("is_step")).agg(
        F.count(F.lit(1)).alias("n"), F.max("name").alias("last_name")
    )


# --- Names --------------------------------------------------------------------


def _part_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr(
            """concat(case p_size % 5 when 0 then 's3a://' when 1 then 's3n://' when 2 then 's3://'
                 when 3 then 'hdfs://' else 'file:/' end,
                 replace(lower(p_brand), '#', '_'),
                 case p_size % 4 when 0 then '' when 1 then '/' when 2 then concat('/', p_type, '/', p_partkey)
                 else concat('/', p_type, '//', p_partkey) end)"""
        ).alias("uri"),
        F.expr(
            """case p_size % 6 when 1 then 'http://minio:9000' when 2 then 's3.eu-west-1.amazonaws.com'
                 when 3 then 'https://s3.us-east-1.amazonaws.com' when 4 then 'minio:9000'
                 when 5 then 'http://bad host' end"""
        ).alias("s3a"),
        F.expr("if(p_size % 7 < 3, 'https://s3n.example.net:444/', null)").alias("s3n"),
    )


@query
def s3_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri, a, n = F.col("uri"), F.col("s3a"), F.col("s3n")
    return _part_uris(spark, sf_dir).select(
        "p_partkey",
        N.s3_name_sql(uri, a, n).alias("sql_name"),
        N.s3_sql_error(uri).alias("sql_error"),
        N.s3_name(uri, a, n).alias("joint_name"),
    )


@query
def s3_names_rdd(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.col("uri")
    name = N.s3_name_rdd(N.namespace(uri), N.uri_path(uri), F.col("s3a"), F.col("s3n"))
    return _part_uris(spark, sf_dir).select("p_partkey", name.alias("rdd_name"))


def _page_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.table(spark, sf_dir, "pages").select(
        "page_id",
        F.expr(
            """case page_id % 6 when 0 then url when 1 then regexp_replace(url, '^https?:', 's3a:')
                 when 2 then regexp_replace(url, '^https?:', 'hdfs:') when 3 then regexp_replace(url, '^https?://', 'file:/')
                 when 4 then regexp_replace(url, '^https?:', 's3:') else regexp_replace(url, '^https?://', '/') end"""
        ).alias("uri"),
    )


@query
def namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_uris(spark, sf_dir).select("page_id", N.namespace(F.col("uri")).alias("namespace"))


@query
def hdfs_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.col("uri")
    return _page_uris(spark, sf_dir).select(
        "page_id", N.hdfs_name(N.namespace(uri), N.uri_path(uri)).alias("name")
    )


@query
def uri_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    endpoint = F.when(F.col("page_id") % 4 == 1, F.lit("http://minio:9000"))
    name = N.uri_name(F.col("uri"), endpoint, F.lit(None).cast("string"))
    return _page_uris(spark, sf_dir).select("page_id", name.alias("name"))


@query
def jdbc_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as tables of the database of their nation."""
    nation = facts.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation"),
        F.expr(
            """case n_regionkey when 0 then concat('jdbc:mysql://', n_name, ':3306/db')
                 when 1 then concat('jdbc:postgresql://user:pw@', n_name, '/db?ssl=true')
                 when 2 then concat('JDBC:MySQL://', n_name, ',second:3307/db') when 3 then concat('jdbc:oracle:thin:@', n_name)
                 else concat('jdbc:postgresql://', n_name, ':5432/') end"""
        ).alias("url"),
    )
    supplier = facts.table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.col("s_nationkey").alias("nation"),
        F.expr("if(s_suppkey % 2 = 0, concat('t', s_suppkey), concat('sc.t', s_suppkey))").alias("tab"),
    )
    url, tab = F.col("url"), F.col("tab")
    return lookup_join(supplier, nation, ["nation"], ["s_suppkey"]).select(
        "s_suppkey",
        N.jdbc_name(url, tab).alias("name"),
        N.jdbc_name(url, tab, compat=True).alias("compat_name"),
        N.jdbc_error(url).alias("error"),
    )


@query
def sql_tables_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table references of one statement per part, in twenty-two shapes."""
    text = F.expr(
        """case p_partkey % 22
             when 0 then concat('select * from part_', p_size, ' r left join supplier_', p_partkey % 9, ' v on r.k = v.k')
             when 1 then concat('WITH c AS (select * from base_', p_size, ') select * from c join dim_', lower(p_type), ' d on c.k = d.k')
             when 2 then concat('select a from t1_', p_size, ' x, t2_', p_size, ' as y, t1_', p_size, ' z where x.k = y.k')
             when 3 then concat('select extract(year from d) from (select d from inner_', p_size, ') q where a is distinct from b')
             when 4 then concat('select ''from ghost'' s from real_', p_size, ' -- join hidden', chr(10), '/* from x */ JOIN db.other_', p_size, ' on 1=1')
             when 5 then concat('select * from "S', p_size, '"."T" t join `b`.`c` u on 1=1 join generate_series(1, 2) g on 1=1')
             when 6 then concat('select * from (a', p_size, ' x join b on x.k = b.k) j')
             when 7 then concat('select * from (with c as (select * from t', p_size, ') select * from c) q')
             when 8 then concat('select * from (select x from i', p_size, ') q, t')
             when 9 then concat('select * from only t', p_size)
             when 10 then concat('select * from "a,', p_size, '" x')
             when 11 then concat('select * from t1 x (c1, c2), t', p_size)
             when 12 then concat('select * from t', p_size, ' tablesample (10), u cross join lateral f(a.b) z')
             when 13 then concat('select * from l', p_size, ', (values (1)) v, w')
             when 14 then concat('select * from a', p_size, ' x join b y on x.id = y.id, c', p_partkey % 5, ' z where x.k in (1, 2)')
             when 15 then concat('select x, y from a', p_size, ' join b using (id, k), c order by x, y')
             when 16 then concat('MERGE INTO t', p_size, ' USING s', p_size, ' q ON q.k = 1 WHEN MATCHED THEN UPDATE SET a = 1, b = 2')
             when 17 then concat('delete from t', p_size, ' using u, v', p_size, ' where u.k = v.k')
             when 18 then concat('select * from c, (with c as (select * from d', p_size, ') select * from c) q join c on 1 = 1')
             when 19 then concat('select $$ from ghost $$, $t$ join x $$ y $t$ from t', p_size)
             when 20 then concat('select * from ', repeat('(select * from ', 30), 'deep', p_size, repeat(') q', 30), ', after_all')
             else concat('with recursive r as (select 1 from s', p_size, ' union all select * from r), r2 as (select * from r2, r) select * from r, r2') end"""
    )
    parts = facts.dealt(facts.table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type"))
    tables = parts.select("p_partkey", sql_tables(text).alias("tables"))
    return tables.select("p_partkey", F.array_join("tables", ",").alias("tables"), F.size("tables").alias("n_tables"))


@query
def snake_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    class_name = F.expr(
        """concat(initcap(p_type), element_at(array('Partitions', 'JDBC', 'Co', 'SQLScan', 'X1Y'), cast(p_size % 5 + 1 as int)),
             if(p_size % 3 = 0, 'RDD', if(p_size % 3 = 1, concat('RDD', p_size), '')))"""
    )
    return facts.table(spark, sf_dir, "part").select("p_partkey", X.camel_to_snake(class_name).alias("name"))


@query
def arg_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("concat('{cmd=--url ', url, ' --id ', page_id, if(page_id % 2 = 0, ' --last word', ''), '}')")
    return facts.table(spark, sf_dir, "pages").select(
        "page_id", *[X.arg_value(text, key).alias(f"arg_{key}") for key in ("url", "id", "last", "none")]
    )


@query
def url_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs as they are, and seven ways to change them."""
    url = F.expr(
        """case page_id % 8 when 0 then url when 1 then regexp_replace(url, '^https?:', 'ftp:')
             when 2 then concat('http://localhost:8080/', page_id) when 3 then concat(url, ' x')
             when 4 then regexp_replace(url, '^(https?://[^/]+)/', '$1//') when 5 then regexp_replace(url, '^(https?://)[^/]+', '$1')
             when 6 then regexp_replace(url, '^(https?://[^/]+)', '$1:1234567') end"""
    )
    return facts.table(spark, sf_dir, "pages").select("page_id", X.is_http_url(url).alias("ok"))


@query
def run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, labels, times and status of the run that each order stands for."""
    ms = X.utc_ms(F.col("o_orderdate"))
    host, job = F.concat(F.lit("host/"), "o_orderstatus"), F.concat(F.lit("job "), "o_custkey")
    error = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return facts.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        N.spark_name(host).alias("source_name"),
        N.spark_name(host, job).alias("job_name"),
        N.spark_name(host, job, ms).alias("run_name"),
        X.run_label(job, ms).alias("run_label"),
        _iso(X.ms_to_ts(ms)).alias("end_time"),
        X.status(error).alias("status"),
    )


# --- RDD graphs ---------------------------------------------------------------


def _closure(spark: SparkSession, sf_dir: str, steps: DataFrame | None = None) -> DataFrame:
    return rddgraph.ancestors(facts.rdd_edges(spark, sf_dir, steps), facts.rdd_roots(spark, sf_dir, steps))


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The steps of all graphs, stored for queries that read both nodes and edges of them."""
    return cut_lineage(facts.rdd_steps(spark, sf_dir))


@query
def rdd_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closure(spark, sf_dir)


@query
def rdd_input_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rddgraph.explode_input_paths(facts.rdd_nodes(spark, sf_dir))


@query
def rdd_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _steps(spark, sf_dir)
    nodes, conf = facts.rdd_nodes(spark, sf_dir, steps), facts.conf(spark, sf_dir)
    items = rddgraph.rdd_inputs(_closure(spark, sf_dir, steps), nodes, conf)
    return items.select("app_id", "dep_id", "node_id", "item", "name")


@query
def rdd_inputs_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input names as RDD jobs alone give them."""
    steps = _steps(spark, sf_dir)
    nodes, conf = facts.rdd_nodes(spark, sf_dir, steps), facts.conf(spark, sf_dir)
    items = rddgraph.rdd_inputs(_closure(spark, sf_dir, steps), nodes, conf, compat=True)
    return items.select("app_id", "dep_id", "node_id", "item", "name")


@query
def rdd_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = rddgraph.rdd_outputs(facts.rdd_output(spark, sf_dir), facts.conf(spark, sf_dir))
    return outputs.select("app_id", "dep_id", "name")


@query
def rdd_outputs_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = rddgraph.rdd_outputs(facts.rdd_output(spark, sf_dir), facts.conf(spark, sf_dir), compat=True)
    return outputs.select("app_id", "dep_id", "name")


@query
def rdd_names_dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names where the graph lacks the second step of each job: edges to it count as none."""
    steps = _steps(spark, sf_dir)
    nodes = facts.rdd_nodes(spark, sf_dir, steps).where("rdd_id <> 2")
    return rddgraph.lineage_names(nodes, facts.rdd_edges(spark, sf_dir, steps).where("rdd_id <> 2")).drop("n_chars")


@query
def rdd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _steps(spark, sf_dir)
    return rddgraph.lineage_names(facts.rdd_nodes(spark, sf_dir, steps), facts.rdd_edges(spark, sf_dir, steps)).drop("n_chars")


# --- Documents ----------------------------------------------------------------


def _lineage(spark: SparkSession, sf_dir: str, compat: bool = False) -> pipelines.Lineage:
    return pipelines.build_lineage(
        pipelines.Facts(
            facts.events(spark, sf_dir),
            facts.plan_nodes(spark, sf_dir),
            facts.rdd_nodes(spark, sf_dir),
            facts.rdd_edges(spark, sf_dir),
            facts.rdd_roots(spark, sf_dir),
            facts.rdd_output(spark, sf_dir),
        ),
        compat=compat,
    )


@query
def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(spark, sf_dir).edges()


@query
def lineage_edges_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(spark, sf_dir, compat=True).edges()


@query
def job_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heads and entries of all job documents in one table."""
    lineage = _lineage(spark, sf_dir)
    heads = lineage.jobs().select(
        "app_id", F.lit(E.HEAD).alias("kind"), F.col("resource_name").alias("key"), F.col("name").alias("value"),
        "host", "sink", "source_name", "type", "schema_url",
    )
    return heads.unionByName(lineage.entries(), allowMissingColumns=True)


def _named_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = facts.events(spark, sf_dir)
    return E.with_names(rollup.rollup_apps(events), C.route_apps(events, C.conf_kv(events)))


@query
def run_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = E.run_entities(_named_apps(spark, sf_dir))
    return runs.withColumns({c: _iso(F.col(c)) for c in ("start_time", "end_time")})


def _status_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with the metadata of each application and the datasets of its RDD outputs."""
    apps, events = _named_apps(spark, sf_dir), facts.events(spark, sf_dir)
    outputs = rddgraph.rdd_outputs(facts.rdd_output(spark, sf_dir), facts.conf(spark, sf_dir))
    listed = E.entries(rollup.app_lineage(outputs), rollup.merge_metadata(events))
    return E.envelopes(apps, listed)


def _documents_text(documents: DataFrame) -> DataFrame:
    return documents.withColumn("items", F.array_join("items", "|"))


@query
def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents_text(_status_documents(spark, sf_dir)).drop("sink")


def _number_host(key: Column) -> Column:
    return F.concat(F.lit("0"), F.length(key).cast("string"), F.lit(".10"))


@query
def publish_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents published twice with changes, some without a key at first, to hosts that look like numbers."""
    path = work_path(spark, "published")
    documents = cut_lineage(_status_documents(spark, sf_dir).withColumn("host", _number_host(F.col("key"))))
    older = documents.withColumn("items", F.array(F.lit("replaced"))).withColumn(
        "key", F.when(F.length("key") % 7 != 0, F.col("key"))
    )
    K.publish(older, path, 1)
    K.publish(older, path, 1)
    K.publish(documents, path, 2)
    return _documents_text(K.read_published(spark, path)).select("app_id", "host", "kind", "key", "items", "batch")


@query
def failed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that were kept apart for want of a key, and are not published since."""
    path = work_path(spark, "published-failed")
    documents = _status_documents(spark, sf_dir).where("sink = 'publish' and kind = 'head'")
    K.publish(documents.withColumn("key", F.when(F.length("app_id") % 2 == 0, F.col("key"))), path, 0)
    K.publish(documents.withColumn("host", F.when(F.length("app_id") % 3 == 0, F.col("host"))), path, 1)
    return K.read_failed(spark, path).select("app_id", "kind", "key", "error", "batch")


@query
def publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents published from a stream."""
    path = work_path(spark, "published-stream")
    _status_documents(spark, sf_dir).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{path}/in").schema).parquet(f"{path}/in")
    writer = stream.writeStream.foreachBatch(K.publish_each(f"{path}/out")).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{path}/checkpoint").start().awaitTermination()
    return _documents_text(K.read_published(spark, f"{path}/out")).select("app_id", "host", "kind", "key", "items")


@query
def log_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of logging applications as JSON lines, read back."""
    folder = K.sink_text(K.to_json_lines(_status_documents(spark, sf_dir)), work_path(spark, "logged"))
    parsed = F.from_json("value", "source_name string, kind string, key string, items array<string>")
    return _documents_text(readers.scan_text(spark, folder).select(parsed.alias("d")).select("d.*"))


# --- Ordinary ETL -------------------------------------------------------------


@query
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = facts.table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return etl.word_count(text)


@query
def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as text to a folder of their own, read as lines, counted."""
    folder = K.sink_text(facts.table(spark, sf_dir, "conversations").select("text"), work_path(spark, "text"))
    lines = readers.scan_text(spark, folder)
    return lines.groupBy(F.length("value").alias("length")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("last_line")
    )


@query
def position_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as position reports and customers as vehicles, through the jdbc demo job."""
    reports = facts.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("report_id"),
        F.expr("cast(o_orderkey % 200 - 100 as double)").alias("latitude"),
        F.expr("cast(o_orderkey % 400 - 200 as double)").alias("longitude"),
        F.expr("cast(if(o_custkey % 3 = 0, -o_custkey, o_custkey) as int)").alias("vehicle_id"),
        F.expr("if(o_orderstatus = 'P', null, o_orderpriority)").alias("report_hour"),
        F.col("o_orderdate").alias("report_date"),
    )
    vehicles = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return pipelines.reports_with_vehicles(reports, vehicles)


@query
def mixed_type_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as reports and part sizes as vehicles, through the delta demo job: a double equals an int."""
    lines = facts.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("report_id"), F.col("l_quantity").alias("latitude"), F.lit(0).alias("vehicle_id")
    )
    sizes = facts.table(spark, sf_dir, "part").select((F.col("p_size") * 2).alias("vehicle_id")).distinct()
    return pipelines.reports_with_seen(lines, sizes).groupBy("latitude", "vehicle_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("report_id").alias("last_report")
    )


@query
def left_join_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as call centers up to key 10 and suppliers as vehicles, through the warehouse demo job."""
    centers = facts.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("CC_CALL_CENTER_SK"), F.col("p_type").alias("CC_CLASS")
    )
    vehicles = facts.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 2).alias("vehicle_id"), "s_name")
    return pipelines.centers_with_vehicles(centers, vehicles)


@query
def bounded_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers up to key 10 left joined to their nation."""
    suppliers = etl.where_le(facts.table(spark, sf_dir, "supplier"), "s_suppkey", 10)
    nations = facts.table(spark, sf_dir, "nation")
    joined = etl.left_join(suppliers, nations, suppliers["s_nationkey"] == nations["n_nationkey"])
    return etl.project(joined, "s_suppkey", "s_name", "n_name")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.col("role").alias("topic"),
    )


@query
def project_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = etl.with_cast(_records(spark, sf_dir), "value", "string", "value_str")
    return etl.project(cast, "CAST(key AS STRING) AS key", "value_str", "length(value) AS n_bytes")


@query
def topic_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two topics copied to a third: the kafka demo job on topic archives."""
    source, target = work_path(spark, "topics"), work_path(spark, "topics")
    _records(spark, sf_dir).write.partitionBy("topic").parquet(source)
    records = readers.scan_topic_archive(spark, source, "user, assistant")
    K.sink_topic_archive(pipelines.records_as_text(records), target, "total")
    copied = spark.read.parquet(target)
    return etl.project(copied, "key", "value", "topic")


@query
def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return etl.top_rows(rows, 20, [F.desc("value"), F.col("event_id")])


@query
def file_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in four formats, each read back from two root paths."""
    customers = facts.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    scans = []
    for fmt in ("parquet", "orc", "csv", "json"):
        even, odd = work_path(spark, fmt), work_path(spark, fmt)
        customers.where("c_custkey % 2 = 0").write.format(fmt).save(even)
        customers.where("c_custkey % 2 = 1").write.format(fmt).save(odd)
        scan = readers.scan_files(spark, fmt, [even, odd], customers.schema)
        scans.append(scan.withColumn("fmt", F.lit(fmt)))
    first, *rest = scans
    for scan in rest:
        first = first.unionByName(scan)
    return first


@query
def versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a job that reads it, all its versions; a write that builds on an old one is given up."""
    path = work_path(spark, "table")
    suppliers = facts.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.lit(0).alias("hops"))
    K.sink_table(suppliers, path)
    for _ in range(2):
        current, base = K.read_table(spark, path), K.table_version(spark, path)
        K.sink_table(current.withColumn("hops", F.col("hops") + F.lit(1)), path, base)
    try:  # a writer that has read the first version only
        K.sink_table(suppliers.withColumn("hops", F.lit(-1)), path, base=1)
    except K.TableConflict:
        K.sweep_table(spark, path, keep=3, older_than_hours=0)
    versions = [K.read_table(spark, path, n).withColumn("version", F.lit(n)) for n in (1, 2, 3)]
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


# --- Event logs and streams ---------------------------------------------------

LOG_FOLDER_APP = r"/app=([^/]+)/"
# The orders whose log lines one task sorts by application and writes: some 200 MB.
LOG_TASK_ORDERS = 400_000


def _write_log(spark: SparkSession, sf_dir: str, plans: bool = False) -> str:
    """Orders as event-log lines: one folder per priority, which is the application.

    With ``plans`` there are starts of SQL executions with a scan, and some lines are cut off.
    """
    path = work_path(spark, "eventlog")
    orders = facts.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    rows = facts.spread(orders, -(-orders.count() // LOG_TASK_ORDERS)).select(
        F.regexp_replace("o_orderpriority", "[^A-Z0-9]", "-").alias("app"),
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        X.utc_ms(F.col("o_orderdate")).alias("ms"),
    )
    status = F.col("o_orderstatus")
    execution = F.when(status != "P", F.create_map(F.lit(S.EXECUTION_ID_KEY), F.col("o_orderkey").cast("string")))
    leaf = F.struct(
        (F.col("o_orderkey") * 2).alias("RDD ID"),
        F.concat(F.lit("s3a://logs/"), F.col("o_orderkey").cast("string"), F.lit(",s3a://logs/all")).alias("Name"),
        F.array().cast("array<bigint>").alias("Parent IDs"),
    )
    final = F.struct(
        (F.col("o_orderkey") * 2 + 1).alias("RDD ID"),
        F.lit("MapPartitionsRDD").alias("Name"),
        F.array(F.col("o_orderkey") * 2).alias("Parent IDs"),
    )
    stage = F.struct(F.lit(0).alias("Stage ID"), F.array(leaf, final).alias("RDD Info"))
    start = F.to_json(
        F.struct(
            F.lit(S.JOB_START).alias("Event"),
            F.col("o_orderkey").alias("Job ID"),
            F.col("ms").alias("Submission Time"),
            F.array(stage).alias("Stage Infos"),
            execution.alias("Properties"),
        )
    )
    failed = F.struct(F.lit(S.JOB_FAILED).alias("Result"), F.struct(F.lit("lost").alias("Message")).alias("Exception"))
    good = F.struct(
        F.lit(S.JOB_SUCCEEDED).alias("Result"),
        F.lit(None).cast("struct<Message:string>").alias("Exception"),
    )
    end = F.to_json(
        F.struct(
            F.lit(S.JOB_END).alias("Event"),
            F.col("o_orderkey").alias("Job ID"),
            (F.col("ms") + facts.JOB_MS).alias("Completion Time"),
            F.when(status == "F", failed).otherwise(good).alias("Job Result"),
        )
    )
    other = F.lit('{"Event":"SparkListenerBlockManagerAdded","Timestamp":1}')
    texts = [start, end, other]
    if plans:
        scan = F.format_string(
            '{"nodeName":"Scan parquet","metadata":{"Location":"InMemoryFileIndex(1 paths)[s3a://tables/%d]"},"children":[]}',
            F.col("o_custkey") % 5,
        )
        plan = F.concat(F.lit('{"nodeName":"Project","metadata":{},"children":['), scan, F.lit("]}"))
        sql = F.concat(
            F.lit(f'{{"Event":"{S.SQL_START}","executionId":'), F.col("o_orderkey").cast("string"), F.lit(',"time":'),
            F.col("ms").cast("string"), F.lit(',"sparkPlanInfo":'), plan, F.lit("}"),
        )
        cut = F.when(F.col("o_orderkey") % 10 == 7, F.substring(end, F.lit(1), F.length(end) - 1))
        texts += [F.when(status != "P", sql), cut]
    # the lines of an order as one text, since the writer sorts its rows by application
    lines = rows.select("app", F.concat_ws("\n", *texts).alias("value"))
    lines.write.partitionBy("app").text(path)
    return path


@query
def event_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-log lines written from the orders, scanned into listener events."""
    events = eventlog.scan_events(spark, _write_log(spark, sf_dir), LOG_FOLDER_APP)
    return events.select("app_id", "event", "event_ms", "job_id", "execution_id", "result", "error_message")


@query
def event_log_rdds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input paths of the RDDs listed in the event log: the closure without any recursion."""
    path = _write_log(spark, sf_dir)
    rdds = cut_lineage(eventlog.scan_job_rdds(spark, path, LOG_FOLDER_APP))
    nodes = eventlog.scan_rdd_nodes(spark, path, LOG_FOLDER_APP, rdds)
    edges = eventlog.scan_rdd_edges(spark, path, LOG_FOLDER_APP, rdds)
    children = edges.groupBy("app_id", "job_id", F.col("dep_rdd_id").alias("rdd_id")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    return rddgraph.explode_input_paths(nodes).join(children, rddgraph.NODE, "left")


@query
def event_log_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets of each application, from nothing but its event log."""
    log = pipelines.facts_of_log(spark, _write_log(spark, sf_dir, plans=True), LOG_FOLDER_APP)
    return pipelines.build_lineage(log).datasets


@query
def event_log_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage names of the RDDs in the event log."""
    path = _write_log(spark, sf_dir)
    rdds = cut_lineage(eventlog.scan_job_rdds(spark, path, LOG_FOLDER_APP))
    nodes = eventlog.scan_rdd_nodes(spark, path, LOG_FOLDER_APP, rdds)
    return rddgraph.lineage_names(nodes, eventlog.scan_rdd_edges(spark, path, LOG_FOLDER_APP, rdds)).drop("n_chars")


@query
def event_log_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the log that were cut off."""
    lines = eventlog.scan_unreadable(spark, _write_log(spark, sf_dir, plans=True), LOG_FOLDER_APP)
    return lines.groupBy("app_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("line")).alias("longest"))


@query
def event_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records from event logs that arrive in two deliveries, through the stream of their staged events."""
    log, target = _write_log(spark, sf_dir, plans=True), work_path(spark, "log-stream")
    for number, apps in enumerate(("[12]*", "[345]*")):
        eventlog.stage_log(spark, f"{log}/app={apps}", f"{target}/facts/batch={number:08d}", LOG_FOLDER_APP)
        events = eventlog.stream_events(spark, target)
        stream_rollups.stream_rollup(events, f"{target}/rollup", f"{target}/checkpoint").awaitTermination()
    return stream_rollups.apps_of(stream_rollups.read_rollup(spark, f"{target}/rollup"))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = facts.table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return facts.user_events(files)


def _streamed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "stream-rollup")
    running = stream_rollups.stream_rollup(_event_stream(spark, sf_dir), path, f"{path}/checkpoint")
    running.awaitTermination()
    stream_rollups.compact_rollup(spark, path)
    return stream_rollups.read_rollup(spark, path)


@query
def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_rollups.apps_of(_streamed_state(spark, sf_dir))


@query
def stream_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_rollups.metadata_of(_streamed_state(spark, sf_dir))


def _flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "stream-flush")
    flush.stream_flush(_event_stream(spark, sf_dir), path, f"{path}/checkpoint").awaitTermination()
    return flush.read_flushed(spark, path)


@query
def stream_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flush.flushed_apps(_flushed(spark, sf_dir))


@query
def stream_flush_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flush.flushed_metadata(_flushed(spark, sf_dir))


def _sliced(spark: SparkSession, sf_dir: str, run) -> str:
    """Run a stream over the events once after each of four deliveries; returns its folder.

    Odd users deliver one slice late, and every tenth has clocks 120 days behind.
    """
    path = work_path(spark, "stream-slices")
    slices = facts.event_slices(facts.table(spark, sf_dir, "events"))
    for number in range(4):
        slices.where(F.col("slice") == number).drop("slice").write.mode("append").parquet(f"{path}/events")
        files = spark.readStream.schema(S.LISTENER_EVENT).parquet(f"{path}/events")
        run(files, path, f"{path}/checkpoint", compact_every=2).awaitTermination()
    return path


@query
def stream_rollup_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _sliced(spark, sf_dir, stream_rollups.stream_rollup)
    return stream_rollups.apps_of(stream_rollups.read_rollup(spark, path))


@query
def stream_flush_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flush.flushed_apps(flush.read_flushed(spark, _sliced(spark, sf_dir, flush.stream_flush)))


@query
def stream_flush_slices_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flush.flushed_metadata(flush.read_flushed(spark, _sliced(spark, sf_dir, flush.stream_flush)))
