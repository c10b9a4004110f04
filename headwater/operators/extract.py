"""Dataset references of plan nodes.

Every rule is a test on a node, the raw texts of the nodes that pass, and the item
(name or error) that each text becomes. All rules together are one pass
over ``plan_node``; a new connector is a new rule and nothing else.

Input: ``plan_node`` with lower-case option keys and the columns
``s3a_endpoint`` and ``s3n_endpoint`` (see :func:`prepare_nodes`).
Output: one row per item, ``app_id, dep_id, direction, node_id, item, name,
error``, with ``dep_id`` the SQL execution. The rows of an execution in the order
``(node_id, item)`` are its input and output lists.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headwater.functions import names as N
from headwater.functions.scalars import UNKNOWN, csv_items, lower_keys, opt
from headwater.functions.sqltext import source_tables
from headwater.operators.conf import KEYS, ConfKeys, with_endpoints

# Node, relation and provider names as they appear in plans.
RELATION_NODE = "LogicalRelation"
WRITE_NODE = "SaveIntoDataSourceCommand"
FILE_RELATION = "HadoopFsRelation"
JDBC_RELATION = "JDBCRelation"
KAFKA_RELATION = "KafkaRelation"
SNOWFLAKE_RELATION = "SnowflakeRelation"
DELTA_PROVIDER = "DeltaDataSource"
KAFKA_PROVIDER = "KafkaSourceProvider"
SNOWFLAKE_PROVIDER = "net.snowflake.spark.snowflake.DefaultSource"

# Errors that make the compatible mode lose all inputs of the execution.
FATAL = ("UNSUPPORTED_RELATION", "MISSING_OPTION", "BAD_S3_PATH")

TEXTS = "array<string>"


@dataclass(frozen=True)
class Rule:
    """A node test and the items of nodes that pass it. Lower priority goes first.

    ``texts`` are the raw texts of a node (paths, tables, topics), ``name`` makes a name of one of them and of the node's
    ``prefix``, ``error`` says why there is none. Texts are exploded before they are named, so names are made of plain
    columns, and not inside arrays, where Spark interprets each function. With ``is_path`` the prefix is a column of the text, too:
    the parts of its S3 name.
    """

    name: str
    predicate: Column
    texts: Column
    priority: int
    named: Callable[[Column, Column], Column]
    error: Callable[[Column, Column, Column], Column]
    prefix: Column | None = None
    is_path: Callable[[Column], Column] | None = None


def _no_texts() -> Column:
    return F.array().cast(TEXTS)


def _unknown() -> Column:
    """A text that isn't there; its item is an error."""
    return F.array(F.lit(None).cast("string"))


def _options() -> Column:
    return F.col("options")


def _is_relation(kind: str) -> Column:
    """Only the texts of such relations are read for tables, since a text is read before the rules choose."""
    return (F.col("node_kind") == RELATION_NODE) & (F.col("relation_kind") == kind)


def _s3_rule(name: str, predicate: Column, texts: Column, priority: int, compat: bool) -> Rule:
    """S3 names that all kinds of jobs share, or with ``compat`` those of plans alone."""
    endpoints = F.col("s3a_endpoint"), F.col("s3n_endpoint")
    if not compat:

        def bad_path(found: Column, uri: Column, _: Column) -> Column:
            return F.when(found.isNull() & N.is_s3(uri), F.lit("BAD_S3_PATH"))

        return Rule(
            name, predicate, texts, priority, lambda _, parts: N.s3_of_parts(parts), bad_path, is_path=lambda uri: N.s3_parts(uri, *endpoints)
        )

    def no_name(found: Column, uri: Column, _: Column) -> Column:
        no_host = F.when(uri.rlike("^s3[an]://"), F.lit("BAD_ENDPOINT"))
        return F.when(found.isNull(), F.coalesce(N.s3_sql_error(uri), no_host))

    return Rule(name, predicate, texts, priority, lambda uri, _: N.s3_name_sql(uri, *endpoints), no_name)


def _jdbc_rule(predicate: Column, texts: Column, priority: int, compat: bool) -> Rule:
    def no_name(_: Column, table: Column, database: Column) -> Column:
        return F.when(table.isNull(), F.lit("MISSING_OPTION")).when(database.isNull(), F.lit("UNSUPPORTED_DATABASE"))

    database = N.jdbc_database(opt(_options(), "url"))
    return Rule("jdbc", predicate, texts, priority, lambda table, db: N.jdbc_table(db, table, compat), no_name, database)


def _missing(found: Column, _: Column, __: Column) -> Column:
    return F.when(found.isNull(), F.lit("MISSING_OPTION"))


def _snowflake_rule(predicate: Column, texts: Column, priority: int) -> Rule:
    schema = N.snowflake_schema(_options())
    return Rule("snowflake", predicate, texts, priority, lambda table, prefix: F.concat(prefix, F.lit("/tables/"), N.part(table)), _missing, schema)


def _kafka_rule(predicate: Column, texts: Column, priority: int) -> Rule:
    cluster = opt(_options(), "kafka.bootstrap.servers")
    return Rule("kafka", predicate, texts, priority, lambda topic, servers: N.kafka_name(servers, topic), _missing, cluster)


def _with_tables(nodes: DataFrame, compat: bool) -> DataFrame:
    """Nodes with ``source``, the text that names their tables, and the ``tables`` in it.

    One column serves JDBC and Snowflake relations, so that a node goes through the reader of SQL texts once.
    """
    query = opt(_options(), "query")
    wrapped = F.concat(F.lit("("), query, F.lit(") q"))
    is_jdbc, is_snowflake = _is_relation(JDBC_RELATION), _is_relation(SNOWFLAKE_RELATION)
    source = F.when(is_jdbc, F.coalesce(opt(_options(), "dbtable"), wrapped)).when(is_snowflake, query)
    return nodes.withColumn("source", source).withColumn("tables", source_tables(F.col("source"), is_jdbc, compat))


def _jdbc_texts() -> Column:
    return F.when(opt(_options(), "url").isNull() | F.col("source").isNull(), _unknown()).otherwise(F.col("tables"))


def _kafka_texts(compat: bool) -> Column:
    topics = opt(_options(), "subscribe")
    return F.when(topics.isNull(), _unknown()).otherwise(csv_items(topics, compat))


def _snowflake_texts(compat: bool) -> Column:
    if compat:
        return F.coalesce(F.col("tables"), _unknown())
    return F.coalesce(F.col("tables"), F.array(opt(_options(), "dbtable")))


def default_rules(compat: bool = False) -> list[Rule]:
    """The built-in rules for relations.

    ``compat`` keeps the known gaps of the original rules: no plain JDBC tables,
    queries cut at the first ``)``, no Snowflake ``dbtable``, no ``s3`` paths.
    """
    is_relation = F.col("node_kind") == RELATION_NODE
    kind = F.coalesce("relation_kind", F.lit(""))
    catalog = F.coalesce("has_catalog_table", F.lit(False)) & ~kind.isin(FILE_RELATION, JDBC_RELATION)
    return [
        _s3_rule("file", is_relation & (kind == FILE_RELATION), F.col("root_paths"), 10, compat),
        _jdbc_rule(is_relation & (kind == JDBC_RELATION), _jdbc_texts(), 10, compat),
        Rule("catalog", is_relation & catalog, _unknown(), 10, lambda text, _: text, lambda *_: F.lit("UNSUPPORTED_RELATION")),
        _snowflake_rule(is_relation & (kind == SNOWFLAKE_RELATION), _snowflake_texts(compat), 30),
        _kafka_rule(is_relation & (kind == KAFKA_RELATION), _kafka_texts(compat), 40),
    ]


WRITE_PRIORITY = 20


def register_rule(
    rules: Sequence[Rule], name: str, predicate: Column, names: Column, priority: int = 100
) -> list[Rule]:
    """The rules with one more: ``names`` is an array of names; NULL entries count as errors."""
    unresolved = F.lit("UNRESOLVED")
    return [*rules, Rule(name, predicate, names, priority, lambda text, _: text, lambda found, *_: F.when(found.isNull(), unresolved))]


def _may_name_s3() -> Column:
    """Nodes of which a built-in rule names paths: file relations, and writes to a path."""
    is_file = (F.col("node_kind") == RELATION_NODE) & (F.col("relation_kind") == FILE_RELATION)
    is_delta = (F.col("node_kind") == WRITE_NODE) & F.col("provider").contains(DELTA_PROVIDER)
    return F.coalesce(is_file, F.lit(False)) | F.coalesce(is_delta, F.lit(False))


def lower_options(plan_nodes: DataFrame) -> DataFrame:
    """Plan nodes with lower-case option keys."""
    return plan_nodes.withColumn("options", lower_keys(F.col("options")))


def prepare_nodes(
    plan_nodes: DataFrame, conf: DataFrame, keys: ConfKeys = KEYS, hot: Sequence[Row] | None = None, paths_only: bool = False
) -> DataFrame:
    """Plan nodes with lower-case option keys and the S3 endpoints of their application.

    ``paths_only`` looks endpoints up for the nodes alone whose paths the built-in rules name; others have none, and aren't
    shuffled. It reads ``plan_nodes`` twice.
    """
    lowered = lower_options(plan_nodes)
    spread = ["execution_id", "node_id"]
    if not paths_only:
        return with_endpoints(lowered, conf, spread, keys, hot)
    named, none = with_endpoints(lowered.where(_may_name_s3()), conf, spread, keys, hot), F.lit(None).cast("string")
    others = lowered.where(~_may_name_s3()).withColumns({"s3a_endpoint": none, "s3n_endpoint": none})
    return others.unionByName(named)


def _first_match(rules: Sequence[Rule]) -> Column:
    write = ("write", F.col("node_kind") == WRITE_NODE, WRITE_PRIORITY)
    ordered = sorted([(r.name, r.predicate, r.priority) for r in rules] + [write], key=lambda r: r[2])
    return F.coalesce(*[F.when(predicate, F.lit(name)) for name, predicate, _ in ordered])


def _accepted(rules: Sequence[Rule]) -> Column:
    """Whether any rule accepts a node; one that none does costs the tests alone."""
    return _first_match(rules).isNotNull()


def classify_node(nodes: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Nodes with the first rule that accepts them (``rule``, NULL if none)."""
    return nodes.withColumn("rule", _first_match(rules or default_rules()))


def classify_root(nodes: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The root of each plan with its rule."""
    return classify_node(nodes.where(F.col("parent_id").isNull()), rules)


def _by_priority(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: r.priority)


def _output_rules(compat: bool = False) -> list[Rule]:
    """The rules for write commands; a node passes one of them at most."""
    provider = F.coalesce("provider", F.lit(""))
    path, url, table = (opt(_options(), key) for key in ("path", "url", "dbtable"))
    is_write = F.col("parent_id").isNull() & (F.col("node_kind") == WRITE_NODE)
    kind = (
        F.when(provider.contains(DELTA_PROVIDER) & path.isNotNull(), F.lit("delta"))
        .when(provider.contains(KAFKA_PROVIDER), F.lit("kafka"))
        .when(provider == SNOWFLAKE_PROVIDER, F.lit("snowflake"))
        .otherwise(F.lit("jdbc"))
    )
    target = F.when(url.isNotNull(), table)
    return [
        _s3_rule("delta", is_write & (kind == "delta"), F.array(path), WRITE_PRIORITY, compat),
        _kafka_rule(is_write & (kind == "kafka"), F.array(opt(_options(), "topic", UNKNOWN)), WRITE_PRIORITY),
        _snowflake_rule(is_write & (kind == "snowflake"), F.array(opt(_options(), "dbtable", UNKNOWN)), WRITE_PRIORITY),
        _jdbc_rule(is_write & (kind == "jdbc"), F.array(target), WRITE_PRIORITY, compat),
    ]


def _explode(
    nodes: DataFrame,
    inputs: Sequence[Rule] = (),
    outputs: Sequence[Rule] = (),
    compat: bool = False,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """Item rows of the given directions. The items of a node are numbered in the order of the rules that accept it.

    With ``keep`` the rows have these columns of their nodes, and each node has a row at least: its first text, or ``item`` NULL.
    """
    rules = [*_by_priority(inputs), *outputs]
    prefixed = [k for k, rule in enumerate(rules) if rule.prefix is not None]
    ids = ["app_id", F.col("execution_id").alias("dep_id"), "node_id"]
    kept, keys = keep or {}, ["app_id", "dep_id", "node_id"]
    # what the names need of a node, the rest of it goes no further
    texts = _with_tables(nodes, compat).select(
        *ids,
        *[column.alias(name) for name, column in kept.items()],
        *[F.when(rule.predicate, rule.texts).otherwise(_no_texts()).alias(f"texts_{k}") for k, rule in enumerate(rules)],
        *[F.when(rules[k].predicate, rules[k].prefix).alias(f"prefix_{k}") for k in prefixed],
        "s3a_endpoint",
        "s3n_endpoint",
    )
    carried = [*keys, *kept, *[f"prefix_{k}" for k in prefixed], "s3a_endpoint", "s3n_endpoint"]
    every = F.concat(*[F.col(f"texts_{k}") for k in range(len(rules))])
    first = [reduce(Column.__add__, [F.size(f"texts_{k}") for k in range(end + 1)]).alias(f"end_{end}") for end in range(len(rules) - 1)]
    ends = [f"end_{k}" for k in range(len(rules) - 1)]
    generate = F.posexplode if keep is None else F.posexplode_outer
    # generated from an expression: of a column, Spark would infer a filter, and read the SQL texts for it once more
    rows = texts.select(*carried, *first, generate(every).alias("item", "text"))
    rule = reduce(lambda later, k: F.when(F.col("item") < F.col(f"end_{k}"), F.lit(k)).otherwise(later), reversed(range(len(ends))), F.lit(len(ends)))
    # a node without texts, which is kept to be counted, has no item of any rule
    rows = rows.select(*carried, "item", "text", F.when(F.col("item").isNotNull(), rule).alias("rule"))

    def of_rule(made: Callable[[Rule, int], Column], ks: Sequence[int]) -> Column:
        return F.coalesce(*[F.when(F.col("rule") == k, made(rules[k], k)) for k in ks])

    paths = [k for k, r in enumerate(rules) if r.is_path is not None]
    if paths:
        rows = rows.withColumn("path", F.when(F.col("rule").isin(paths), rules[paths[0]].is_path(F.col("text"))))

    def prefix(k: int) -> Column:
        return F.col("path") if k in paths else F.col(f"prefix_{k}") if k in prefixed else F.lit(None).cast("string")

    text, every_rule = F.col("text"), range(len(rules))
    # generated, so that a test of the name doesn't make it again
    rows = rows.select("*", F.explode(F.array(of_rule(lambda r, k: r.named(text, prefix(k)), every_rule))).alias("name"))
    rows = rows.withColumn("error", of_rule(lambda r, k: r.error(F.col("name"), text, prefix(k)), every_rule))
    direction = F.when(F.col("rule") < len(inputs), F.lit("input")).otherwise(F.lit("output"))
    found = F.col("name").isNotNull() | F.col("error").isNotNull()
    if keep is not None:
        found = found | (F.coalesce("item", F.lit(0)) == 0)
    return rows.where(found).select(
        "app_id", "dep_id", direction.alias("direction"), "node_id", F.col("item").cast("bigint").alias("item"), "name", "error", *kept
    )


def _one_rule(nodes: DataFrame, rule_name: str, compat: bool = False) -> DataFrame:
    rule = next(r for r in default_rules(compat) if r.name == rule_name)
    return _explode(nodes.where(rule.predicate), [rule], compat=compat)


def file_inputs(nodes: DataFrame, compat: bool = False) -> DataFrame:
    """One name per S3 root path of a file relation; other paths give none."""
    return _one_rule(nodes, "file", compat)


def jdbc_inputs(nodes: DataFrame, compat: bool = False) -> DataFrame:
    """Tables in the text of a JDBC relation."""
    return _one_rule(nodes, "jdbc", compat)


def kafka_inputs(nodes: DataFrame, compat: bool = False) -> DataFrame:
    """Subscribed topics of a Kafka relation."""
    return _one_rule(nodes, "kafka", compat)


def snowflake_inputs(nodes: DataFrame, compat: bool = False) -> DataFrame:
    """Tables in the query of a Snowflake relation."""
    return _one_rule(nodes, "snowflake", compat)


def _outputs_of(nodes: DataFrame, provider: Column, compat: bool = False) -> DataFrame:
    return _explode(nodes.where(provider), outputs=_output_rules(compat), compat=compat)


def delta_outputs(nodes: DataFrame, compat: bool = False) -> DataFrame:
    """Targets of writes that name a Delta provider and a path."""
    is_delta = F.col("provider").contains(DELTA_PROVIDER) & opt(_options(), "path").isNotNull()
    return _outputs_of(nodes, is_delta, compat)


def kafka_outputs(nodes: DataFrame) -> DataFrame:
    """Target topics; ``UNKNOWN`` without a topic."""
    return _outputs_of(nodes, F.col("provider").contains(KAFKA_PROVIDER))


def snowflake_outputs(nodes: DataFrame) -> DataFrame:
    """Target tables; ``UNKNOWN`` without a table."""
    return _outputs_of(nodes, F.col("provider") == SNOWFLAKE_PROVIDER)


def jdbc_outputs(nodes: DataFrame, compat: bool = False) -> DataFrame:
    """Targets of all other providers, and of Delta writes without a path.

    ``compat`` writes the whole text as the table, and the schema as ``public``.
    """
    delta = F.col("provider").contains(DELTA_PROVIDER) & opt(_options(), "path").isNotNull()
    others = F.col("provider").contains(KAFKA_PROVIDER) | (F.col("provider") == SNOWFLAKE_PROVIDER)
    return _outputs_of(nodes, ~F.coalesce(delta | others, F.lit(False)), compat)


def _visible_items(nodes: DataFrame, rules: Sequence[Rule], compat: bool = False, lossy: bool = False) -> DataFrame:
    """Input items of the nodes that a test of the root alone would reach: below a write, or a root relation.

    Items are made before the only shuffle, which brings the items and the roots of an execution together, so the options of
    nodes don't go through it. A node counts once for each root that shows it. With ``lossy`` an error among :data:`FATAL`
    loses the names of its execution.
    """
    is_root = F.col("parent_id").isNull()
    keep = {"is_root": is_root, "root_rule": F.when(is_root, _first_match(rules))}
    # a node that no rule accepts neither has items nor decides what is seen
    keyed = F.col("app_id").isNotNull() & F.col("execution_id").isNotNull()
    named = _explode(nodes.where(keyed & _accepted(rules)), rules, compat=compat, keep=keep)
    plan = Window.partitionBy("app_id", "dep_id")
    # a node counts by its first row
    is_node = F.coalesce("item", F.lit(0)) == 0
    counted = named.withColumns(
        {
            "n_writes": F.count_if(is_node & (F.col("root_rule") == "write")).over(plan),
            "n_others": F.count_if(is_node & (F.col("root_rule") != "write")).over(plan),
        }
    )
    times = F.when(F.col("is_root"), F.col("n_others")).otherwise(F.col("n_writes"))
    seen = counted.withColumn("times", times)
    is_seen = (F.col("times") > 0) & (F.col("name").isNotNull() | F.col("error").isNotNull())
    if lossy:
        fatal = (F.col("times") > 0) & F.coalesce(F.col("error").isin(*FATAL), F.lit(False))
        seen = seen.withColumn("lost", F.max(fatal).over(plan))
        is_seen = is_seen & (~F.col("lost") | F.col("error").isNotNull())
    found = seen.where(is_seen).withColumn("time", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))))
    return found.select("app_id", "dep_id", "direction", "node_id", "item", "name", "error")


def write_inputs(
    nodes: DataFrame, rules: Sequence[Rule] | None = None, root_only: bool = False, compat: bool = False
) -> DataFrame:
    """Input items of each plan: all rules on all nodes, duplicates kept.

    By default no join and no shuffle is needed. ``root_only`` looks below write
    commands, or at a root that is itself a relation, and nowhere else.
    """
    rules = rules or default_rules(compat)
    if root_only:
        return _visible_items(nodes, rules, compat=compat)
    seen = nodes.where((F.col("node_kind") != WRITE_NODE) & _accepted(rules))
    return _explode(seen, rules, compat=compat)


def write_outputs(nodes: DataFrame, compat: bool = False) -> DataFrame:
    """Output items of the write commands."""
    writes = nodes.where(F.col("parent_id").isNull() & (F.col("node_kind") == WRITE_NODE))
    return _explode(writes, outputs=_output_rules(compat), compat=compat)


def plan_items(nodes: DataFrame, rules: Sequence[Rule] | None = None, compat: bool = False) -> DataFrame:
    """Input and output items of each plan, errors included.

    The default is one pass over the nodes. ``compat`` tests roots only, and an
    error among the inputs of an execution loses all its inputs; its output
    stays, and a failed output never touches the inputs.
    """
    if not compat:
        rules = rules or default_rules()
        # a node has either
        is_write = F.coalesce(F.col("node_kind") == WRITE_NODE, F.lit(False))
        inputs = [replace(rule, predicate=~is_write & rule.predicate) for rule in rules]
        return _explode(nodes.where(_accepted(rules)), inputs, _output_rules())
    inputs = _visible_items(nodes, rules or default_rules(compat=True), compat=True, lossy=True)
    return inputs.unionByName(write_outputs(nodes, compat=True))


def extract_errors(items: DataFrame) -> DataFrame:
    """What could not be resolved, instead of exceptions: one row per failed reference."""
    return items.where(F.col("error").isNotNull()).select(
        "app_id", "dep_id", "direction", "node_id", "item", F.col("error").alias("extract_error")
    )


def unsupported(nodes: DataFrame) -> DataFrame:
    """Catalog relations that no rule can resolve."""
    return extract_errors(_one_rule(nodes, "catalog"))
