"""Job facts derived from the driver's tables, so that the operators run on whole tables.

One application is ten consecutive orders: an order is one SQL execution and one
job, its line items are the plan nodes below the root, and the customer with the
application's number gives name and configuration. Everything is a projection of
one table; nothing here joins or shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headwater import schemas as S
from headwater.functions.scalars import utc_ms

APP_START_MS = 694_224_000_000
APP_END_MS = 1_262_304_000_000
JOB_MS = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a test table dealt out to all cores before costly work.

    Each test table is one file that a scan cannot split.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def spread(rows: DataFrame, tasks: int = 0) -> DataFrame:
    """The same by a hash of the columns, without the sort that dealing in turn needs; rows equal in all columns meet.

    With ``tasks``, to as many at least.
    """
    return rows.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism), *rows.columns)


def _given(options: str) -> str:
    """The options that are given, of a map whose texts are never blank: only maps with a NULL are filtered."""
    return f"if(array_contains(map_values({options}), '') is null, map_filter({options}, (k, v) -> v is not null), {options})"


# The settings of an application, NULL where one is not set.
CONF = """'spark.lineage.host.key',
        if(c_nationkey % 5 <> 0, concat('cluster-', c_nationkey % 5), null),
    'spark.lineage.enabled',
        case c_mktsegment when 'AUTOMOBILE' then 'false' when 'BUILDING' then 'TRUE'
            when 'FURNITURE' then 'yes' when 'MACHINERY' then 'true' end,
    'spark.lineage.host.url',
        case c_nationkey % 4 when 0 then 'http://localhost:8080'
            when 1 then 'ftp://files.example.com' when 2 then 'https://catalog.example.com/api' end,
    'spark.hadoop.fs.s3a.endpoint',
        case c_nationkey % 6 when 1 then 'http://minio:9000' when 2 then 's3.eu-west-1.amazonaws.com'
            when 3 then 'https://s3.us-east-1.amazonaws.com' when 4 then 'minio:9000'
            when 5 then 'http://bad host' end,
    'spark.hadoop.fs.s3n.endpoint',
        if(c_nationkey % 2 = 1, 'http://s3n.example.net', null)"""


def conf_map(customers: DataFrame) -> DataFrame:
    """``app_id, app_name, c_acctbal, conf`` per customer."""
    return customers.select(
        F.concat(F.lit("app-"), "c_custkey").alias("app_id"),
        F.col("c_name").alias("app_name"),
        "c_acctbal",
        F.expr(
            f"map_filter(map({CONF}), (k, v) -> v is not null)"
        ).alias("conf"),
    )


def conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conf_kv`` of all applications."""
    every = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("app-"), "c_custkey").alias("app_id"), F.expr(f"stack({CONF.count("'spark.")}, {CONF})").alias("key", "value")
    )
    return every.where(F.col("value").isNotNull())


def _job_events(orders: DataFrame) -> DataFrame:
    low, pending = F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus") == "P"
    shared = F.expr(
        """map('spark.priority', o_orderpriority, concat('spark.status.', o_orderstatus), cast(o_orderkey as string),
               'spark.customer', cast(o_custkey as string))"""
    )
    execution = F.create_map(F.lit(S.EXECUTION_ID_KEY), F.col("o_orderkey").cast("string"))
    return orders.select(
        F.concat(F.lit("app-"), F.expr("o_orderkey div 10")).alias("app_id"),
        F.col("o_orderkey").alias("job_id"),
        utc_ms(F.col("o_orderdate")).alias("ms"),
        "o_orderstatus",
        "o_orderpriority",
        F.when(~low, F.map_concat(execution, shared)).when(~pending, shared).alias("job_properties"),
        low.alias("is_rdd"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``listener_event``: starts and ends of jobs, SQL executions and applications."""
    jobs = _job_events(table(spark, sf_dir, "orders"))
    kinds = F.expr(
        f"""array(
            named_struct('event', '{S.JOB_START}', 'shift', 0L),
            named_struct('event', '{S.JOB_END}', 'shift', {JOB_MS}L),
            named_struct('event', '{S.SQL_START}', 'shift', 0L))"""
    )
    exploded = jobs.withColumn("k", F.explode(kinds)).where(
        (F.col("k.event") != S.SQL_START) | (F.col("o_orderstatus") != "P")
    )
    is_start = F.col("k.event") == S.JOB_START
    is_end = F.col("k.event") == S.JOB_END
    is_sql = F.col("k.event") == S.SQL_START
    failed = F.col("o_orderstatus") == "F"
    none = F.lit(None)
    job_rows = exploded.select(
        "app_id",
        none.cast("string").alias("app_name"),
        F.col("k.event").alias("event"),
        (F.col("ms") + F.col("k.shift")).alias("event_ms"),
        F.when(~is_sql, F.col("job_id")).alias("job_id"),
        F.when(is_sql | (is_start & ~F.col("is_rdd")), F.col("job_id")).alias("execution_id"),
        F.when(is_start, F.col("job_properties")).alias("properties"),
        F.when(is_end, F.when(failed, F.lit(S.JOB_FAILED)).otherwise(F.lit(S.JOB_SUCCEEDED))).alias("result"),
        F.when(is_end & failed, F.concat(F.lit("lost "), "o_orderpriority")).alias("error_message"),
        none.cast(S.STRING_MAP).alias("conf"),
    )
    marks = F.expr(
        f"""if(c_acctbal >= 0,
            array(named_struct('event', '{S.APP_START}', 'ms', {APP_START_MS}L),
                  named_struct('event', '{S.APP_END}', 'ms', {APP_END_MS}L)),
            array(named_struct('event', '{S.APP_START}', 'ms', {APP_START_MS}L)))"""
    )
    starting = F.col("k.event") == S.APP_START
    app_rows = (
        conf_map(table(spark, sf_dir, "customer"))
        .withColumn("k", F.explode(marks))
        .select(
            "app_id",
            F.when(starting, F.col("app_name")).alias("app_name"),
            F.col("k.event").alias("event"),
            F.col("k.ms").alias("event_ms"),
            none.cast("bigint").alias("job_id"),
            none.cast("bigint").alias("execution_id"),
            none.cast(S.STRING_MAP).alias("properties"),
            none.cast("string").alias("result"),
            none.cast("string").alias("error_message"),
            F.when(starting, F.col("conf")).alias("conf"),
        )
    )
    return job_rows.unionByName(app_rows)


def _plan(rows: DataFrame, **columns: str) -> DataFrame:
    return rows.select(*[F.expr(text).cast(S.PLAN_NODE[name].dataType).alias(name) for name, text in columns.items()])


def plan_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root of the plan of each order: writes of four kinds, or a plain query."""
    return _plan(
        spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")),
        app_id="concat('app-', o_orderkey div 10)",
        execution_id="o_orderkey",
        node_id="0",
        parent_id="null",
        node_kind="""case when o_orderpriority <> '5-LOW' then 'SaveIntoDataSourceCommand'
            when o_orderstatus = 'O' then 'Project' else 'LogicalRelation' end""",
        relation_kind="""case when o_orderpriority <> '5-LOW' or o_orderstatus = 'O' then null
            when o_orderstatus = 'F' then 'HadoopFsRelation' else 'KafkaRelation' end""",
        provider="""case o_orderpriority when '1-URGENT' then 'org.apache.spark.sql.delta.sources.DeltaDataSource'
            when '2-HIGH' then 'org.apache.spark.sql.kafka010.KafkaSourceProvider'
            when '3-MEDIUM' then 'net.snowflake.spark.snowflake.DefaultSource'
            when '4-NOT SPECIFIED' then 'org.apache.spark.sql.execution.datasources.jdbc.JdbcRelationProvider' end""",
        options=_given("""case o_orderpriority
            when '1-URGENT' then map('path', case o_orderstatus
                when 'O' then if(o_custkey % 2 = 0, concat('s3a://lake-', o_custkey % 3, '/orders/', o_orderkey % 4), 'hdfs://nn:8020/x')
                when 'F' then 's3a://lake//bad' end)
            when '2-HIGH' then map('kafka.bootstrap.servers', concat('broker-', o_custkey % 7, ':9092'),
                'topic', if(o_orderstatus <> 'P', concat('orders_', o_orderstatus), null))
            when '3-MEDIUM' then map('sfURL', concat('acct', o_custkey % 5, '.eu.example.com'), 'sfDatabase', 'DB',
                'sfSchema', concat('SC_', o_orderstatus),
                'dbtable', if(o_orderstatus <> 'P', concat('ORDERS_', o_custkey % 4), null))
            when '4-NOT SPECIFIED' then map('url', case o_custkey % 4
                    when 0 then concat('jdbc:mysql://my-', o_custkey % 3, ':3306/shop')
                    when 1 then concat('jdbc:postgresql://pg-', o_custkey % 3, ':5432/shop?ssl=true')
                    when 2 then 'jdbc:sqlserver://ms:1433;databaseName=shop' end,
                'dbtable', if(o_orderstatus = 'F', 'audit.orders', concat('orders_', o_orderstatus)))
            else map('kafka.bootstrap.servers', 'broker-low:9092', 'subscribe', if(o_orderstatus = 'P', 'low', null))
            end"""),
        root_paths="""if(o_orderpriority = '5-LOW' and o_orderstatus = 'F',
            array(concat('s3a://low-', o_custkey % 3, '/x'), 's3n://low/y'), null)""",
        has_catalog_table="false",
    )


def plan_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes below the root: relations of five kinds, and filters."""
    # generated, so that a test of the kind, of which a filter of nodes has many, doesn't join the texts again
    kind = F.explode(F.array(F.concat("l_returnflag", "l_linestatus")))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", kind.alias("kind")
    )
    return _plan(
        spread(lines),
        app_id="concat('app-', l_orderkey div 10)",
        execution_id="l_orderkey",
        node_id="8 * l_partkey + l_linenumber",
        parent_id="0",
        node_kind="if(kind = 'RF' and l_linenumber < 6, 'Filter', 'LogicalRelation')",
        relation_kind="""case kind when 'AF' then 'HadoopFsRelation' when 'AO' then 'JDBCRelation'
            when 'NF' then 'KafkaRelation' when 'NO' then 'SnowflakeRelation' when 'RO' then 'JDBCRelation'
            else if(l_linenumber >= 6, 'HiveTableRelation', null) end""",
        provider="null",
        options=_given("""case kind
            when 'AO' then map('url', case l_suppkey % 3
                    when 0 then concat('jdbc:mysql://src-', l_suppkey % 4, ':3306/wh')
                    when 1 then concat('jdbc:postgresql://src-', l_suppkey % 4, '/wh')
                    else 'jdbc:sqlserver://ms:1433;databaseName=wh' end,
                'dbtable', concat('(select * from part_', l_partkey % 10, ' r left join s.supp_', l_suppkey % 10, ' v on r.k = v.k) q'))
            when 'RO' then map('url', 'jdbc:mysql://plain:3306/wh', 'dbtable', concat('plain_', l_partkey % 8))
            when 'NF' then map('Kafka.Bootstrap.Servers', concat('in-', l_suppkey % 3, ':9092'),
                'subscribe', if(l_linenumber <> 7, concat('topic_', l_partkey % 9, ' , supplier_', l_suppkey % 4), null))
            when 'NO' then map('sfURL', concat('acct', l_suppkey % 5, '.eu.example.com'), 'sfDatabase', 'DB', 'sfSchema', 'PUBLIC',
                'query', if(l_linenumber > 1, concat('select A from WH_', l_partkey % 6, ' join LOC_', l_suppkey % 6, ' on 1 = 1'), null),
                'dbtable', if(l_linenumber = 1, concat('DIRECT_', l_partkey % 3), null))
            else cast(map() as map<string, string>) end"""),
        root_paths="""if(kind = 'AF', array(concat('s3a://parts-', l_partkey % 5, '/', l_suppkey % 7, '/data'),
            concat('hdfs://nn:8020/p/', l_partkey), concat('s3n://old-', l_suppkey % 3)), null)""",
        has_catalog_table="kind = 'RF' and l_linenumber >= 6",
    )


def plan_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_roots(spark, sf_dir).unionByName(plan_children(spark, sf_dir))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as job ends of the application of their customer."""
    failed = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("app-"), "o_custkey").alias("app_id"),
        F.lit(S.JOB_END).alias("event"),
        utc_ms(F.col("o_orderdate")).alias("event_ms"),
        F.col("o_orderkey").alias("job_id"),
        F.when(failed, F.lit(S.JOB_FAILED)).otherwise(F.lit(S.JOB_SUCCEEDED)).alias("result"),
        F.when(failed, F.col("o_orderpriority")).alias("error_message"),
    )


def user_events(rows: DataFrame, *more: str) -> DataFrame:
    """The ``events`` table as listener events of one application per user.

    Errors are failed jobs, purchases are good ones, the rest are SQL job starts
    with one property; a sign-up with a high number ends the application.
    """
    kind = F.col("event_type")
    number = F.get_json_object("props", "$.k")
    is_end = (kind == "signup") & (number.cast("int") >= 70)
    is_job_end = kind.isin("error", "purchase")
    is_start = ~is_job_end & ~is_end
    properties = F.create_map(F.lit(S.EXECUTION_ID_KEY), F.col("event_id").cast("string"), kind, number)
    return rows.select(
        F.concat(F.lit("user-"), "user_id").alias("app_id"),
        F.lit(None).cast("string").alias("app_name"),
        F.when(is_end, F.lit(S.APP_END)).when(is_job_end, F.lit(S.JOB_END)).otherwise(F.lit(S.JOB_START)).alias("event"),
        utc_ms(F.col("ts")).alias("event_ms"),
        F.when(~is_end, F.col("event_id")).alias("job_id"),
        F.when(is_start, F.col("event_id")).alias("execution_id"),
        F.when(is_start, properties).alias("properties"),
        F.when(kind == "error", F.lit(S.JOB_FAILED)).when(kind == "purchase", F.lit(S.JOB_SUCCEEDED)).alias("result"),
        F.when(kind == "error", F.concat(F.lit("k="), number)).alias("error_message"),
        F.lit(None).cast(S.STRING_MAP).alias("conf"),
        *more,
    )


def event_slices(rows: DataFrame) -> DataFrame:
    """Listener events of the users with the slice, 0 to 3, in which each is delivered.

    Ten days make a slice; odd users deliver one slice later, and the clocks of
    every tenth user are 120 days behind.
    """
    late = F.expr("user_id % 2")
    day = F.datediff("ts", F.lit("2024-01-01"))
    number = (F.least(F.floor(day / 10), F.lit(2)) + late).cast("int")
    behind = F.expr("if(user_id % 10 = 3, interval 120 days, interval 0 days)")
    sliced = rows.withColumns({"slice": number, "ts": F.col("ts") - behind})
    kept = [c for c in S.LISTENER_EVENT.fieldNames()]
    return user_events(sliced, "slice").select(*kept, "slice")


def rdd_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct line numbers of each order, with the numbers one to three steps before.

    At most seven per order, whatever the number of line items.
    """
    before = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    # combined before the shuffle, so they aren't dealt out first
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.lag("l_linenumber", 1).over(before).alias("one"),
        F.lag("l_linenumber", 2).over(before).alias("two"),
        F.lag("l_linenumber", 3).over(before).alias("three"),
    )


def rdd_edges(spark: SparkSession, sf_dir: str, steps: DataFrame | None = None) -> DataFrame:
    """``rdd_edge``: each step depends on the ones two and three before it. ``steps`` are :func:`rdd_steps`, if they are stored."""
    deps = F.filter(F.array("two", "three"), lambda d: d.isNotNull())
    return (rdd_steps(spark, sf_dir) if steps is None else steps).select(
        F.concat(F.lit("app-"), F.expr("l_orderkey div 10")).alias("app_id"),
        F.col("l_orderkey").alias("job_id"),
        F.col("l_linenumber").cast("bigint").alias("rdd_id"),
        F.posexplode(deps).alias("dep_pos", "dep"),
    ).select("app_id", "job_id", "rdd_id", F.col("dep").cast("bigint").alias("dep_rdd_id"), "dep_pos")


def rdd_roots(spark: SparkSession, sf_dir: str, steps: DataFrame | None = None) -> DataFrame:
    """The last step of each order is the final RDD of its job."""
    lines = table(spark, sf_dir, "lineitem") if steps is None else steps
    return lines.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("last")).select(
        F.concat(F.lit("app-"), F.expr("l_orderkey div 10")).alias("app_id"),
        F.col("l_orderkey").alias("job_id"),
        F.col("last").cast("bigint").alias("rdd_id"),
    )


def rdd_nodes(spark: SparkSession, sf_dir: str, steps: DataFrame | None = None) -> DataFrame:
    """``rdd_node``: steps without dependencies scan files; names are absent, copied or own."""
    steps = (rdd_steps(spark, sf_dir) if steps is None else steps).withColumn("path", F.expr(
        """concat(element_at(array('s3a://raw-', 's3://raw-', 'hdfs://nn:8020/raw-', 'file:/tmp/raw-', 's3n://raw-'),
               cast(l_orderkey % 5 + 1 as int)), l_orderkey % 7, '/', l_linenumber)"""
    ))
    is_scan = F.col("two").isNull()
    own = F.expr("l_linenumber % 3 = 0")
    return steps.select(
        F.concat(F.lit("app-"), F.expr("l_orderkey div 10")).alias("app_id"),
        F.col("l_orderkey").alias("job_id"),
        F.col("l_linenumber").cast("bigint").alias("rdd_id"),
        F.when(is_scan, F.lit("HadoopRDD"))
        .when(F.expr("l_linenumber % 2 = 0"), F.lit("MapPartitionsRDD"))
        .otherwise(F.lit("ShuffledRDD"))
        .alias("rdd_class"),
        F.when(is_scan, F.col("path")).when(own, F.lit("step")).alias("rdd_name"),
        F.when(is_scan, F.array(F.col("path"), F.concat("path", F.lit("/more")))).alias("input_paths"),
    )


def rdd_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rdd_output`` of every order."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("app-"), F.expr("o_orderkey div 10")).alias("app_id"),
        F.col("o_orderkey").alias("job_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("shuffle_map")).otherwise(F.lit("result")).alias("final_stage_kind"),
        F.expr("if(o_custkey % 3 = 0, concat('s3a://out/', o_custkey % 10), null)").alias("old_api_path"),
        F.expr(
            """case o_custkey % 4 when 0 then null when 1 then concat('hdfs://nn/out/', o_custkey % 10)
               when 2 then 'file:/tmp/out' else concat('s3://out/new/', o_custkey % 10) end"""
        ).alias("new_api_path"),
    )


def order_items(spark: SparkSession, sf_dir: str, coarse: bool) -> DataFrame:
    """Line items as lineage items of the application of the order's customer.

    Each line reads a part and writes to a supplier; ``coarse`` names groups of
    them, so that many orders have equal lists.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("dep_id"), F.concat(F.lit("app-"), "o_custkey").alias("app_id")
    )
    part = "concat('part-', l_partkey % 3)" if coarse else "concat('part-', l_partkey)"
    supplier = "concat('supp-', l_suppkey % 2)" if coarse else "concat('supp-', l_suppkey)"
    # numbers are joined, names are made of them afterwards
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("dep_id"), "l_partkey", "l_suppkey", "l_linenumber")
    owned = lines.join(orders, "dep_id").select(
        "app_id",
        "dep_id",
        "l_partkey",
        "l_suppkey",
        F.expr("8 * l_partkey + l_linenumber").alias("node_id"),
        F.explode(F.array(F.lit("input"), F.lit("output"))).alias("direction"),
    )
    name = F.when(F.col("direction") == "input", F.expr(part)).otherwise(F.expr(supplier))
    return owned.select("app_id", "dep_id", "direction", "node_id", F.lit(0).cast("bigint").alias("item"), name.alias("name"))
