"""RDD graphs: closure of a job's final RDD, its inputs and outputs, lineage names.

A graph belongs to one job, so all keys start with ``(app_id, job_id)``. The
iterative operators keep their rounds as files in the shared folder, and delete those that no later round reads: a lost
executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions.names import hdfs_name, name_of_path, namespace, s3_of_parts, s3_parts, uri_path
from headwater.functions.scalars import camel_to_snake
from headwater.operators.conf import KEYS, ConfKeys, with_endpoints
from headwater.session import cut_lineage, delete_path, path_exists, work_path
from headwater.skew import large_groups

# RDD class names with a meaning of their own.
OLD_API_SCAN = "HadoopRDD"
MAPPED = "MapPartitionsRDD"
RESULT_STAGE = "result"

# The longest name that is spelled out, and up to where longer ones are counted.
MOST_CHARS = 1 << 16
COUNTED_CHARS = 1 << 60
# The largest graph, RDDs and edges together, that one task walks.
GRAPH_SIZE = 200_000
# The characters of names that a batch holds, apart from those of its last graph.
BATCH_CHARS = 4_000_000
# Rows of a graph: RDDs with a name of their own, with the name of their class, with that of the class if the parent has the same, and edges.
OWN, BORROWED, COPIED, EDGE = range(4)
# Before all positions of dependencies.
NO_PLACE = -(1 << 63)
_DEP = "struct<dep_pos:bigint,head:string,n_chars:bigint>"
_NODE_SCHEMA = "app_id string, job_id bigint, rdd_id bigint"

NODE = ["app_id", "job_id", "rdd_id"]
JOB = ["app_id", "job_id"]
# The number first: a sort by it compares few whole keys.
BY_JOB = ["job_id", "app_id"]
_UP = ["_app", "_job", "_rdd"]
DEPENDENCY = ["app_id", "job_id", "dep_rdd_id"]


def explode_input_paths(rdd_nodes: DataFrame) -> DataFrame:
    """One row per input path of a file scan."""
    return rdd_nodes.where(F.col("input_paths").isNotNull()).select(
        *NODE, F.posexplode("input_paths").alias("item", "path")
    )


def _values(column: pa.Array) -> list:
    """The values of a column, without a detour by single Arrow values where numpy has them."""
    if pa.types.is_integer(column.type):
        if not column.null_count:
            return column.to_numpy().tolist()
        given = column.is_valid().to_numpy(zero_copy_only=False).tolist()
        return [value if there else None for value, there in zip(column.fill_null(0).to_numpy().tolist(), given)]
    if pa.types.is_list(column.type):
        # the lists that a batch shows may be part of longer ones
        flat, ends = _values(column.values), column.offsets.to_numpy().tolist()
        lists = [flat[start:end] for start, end in zip(ends, ends[1:])]
        if not column.null_count:
            return lists
        return [below if there else None for below, there in zip(lists, column.is_valid().to_numpy(zero_copy_only=False).tolist())]
    return column.to_numpy(zero_copy_only=False).tolist()


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The RDDs that the roots of whole graphs reach; the rows of a graph come one after another, roots without a dependency."""
    rows: list[tuple] = []

    def walk(key: tuple, roots: set[int], deps: dict[int, list[int]]) -> None:
        seen, open_ones = set(roots), list(roots)
        while open_ones:
            for dep in deps.get(open_ones.pop(), ()):
                if dep not in seen:
                    seen.add(dep)
                    open_ones.append(dep)
        rows.extend((*key, node) for node in seen)

    def flush() -> pa.RecordBatch:
        columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate([pa.string(), pa.int64(), pa.int64()])]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, NODE)

    key, roots, deps = None, set(), {}
    for batch in batches:
        for app, job, rdd, dep in zip(*map(_values, batch.columns)):
            if (app, job) != key:
                if key is not None:
                    walk(key, roots, deps)
                key, roots, deps = (app, job), set(), {}
                if len(rows) >= 1000:
                    yield flush()
            if dep is None:
                roots.add(rdd)
            else:
                deps.setdefault(rdd, []).append(dep)
    if key is not None:
        walk(key, roots, deps)
    yield flush()


def ancestors(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """All RDDs that the root RDDs of each job depend on, and the roots, each once.

    The graph of a job goes to one task, which walks it once; one with more than GRAPH_SIZE edges goes through
    :func:`_ancestors_by_doubling`, with the same result.
    """
    # stored, since they are read twice
    edges, roots = cut_lineage(edges.select(*NODE, "dep_rdd_id")), cut_lineage(roots.select(*NODE))
    wanted = edges.where(F.col("app_id").isNotNull() & F.col("job_id").isNotNull() & F.col("dep_rdd_id").isNotNull())
    large = large_groups(edges, JOB, GRAPH_SIZE)
    # a graph without a root goes along, since a walk that starts nowhere costs less than a join that finds those with roots
    rows = wanted.unionByName(roots.withColumn("dep_rdd_id", F.lit(None).cast("bigint")))
    small = rows.join(large, JOB, "left_anti") if large is not None else rows
    found = small.repartition(*JOB).sortWithinPartitions(*BY_JOB).mapInArrow(_reached, _NODE_SCHEMA)
    if large is not None:
        starts = roots.join(large, JOB, "left_semi")
        found = found.unionByName(_ancestors_by_doubling(wanted.join(starts.select(*JOB).distinct(), JOB, "left_semi"), starts))
    return found


def _ancestors_by_doubling(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The same for graphs of any size.

    Round k knows what is less than 2^k steps away, and the pairs that paths of 2^k steps
    connect. Joining them gives what is less than 2^(k+1) away; joining the pairs with themselves, the pairs
    of the next round. When a round finds nothing new the closure is complete, so a graph of depth d takes about log2(d)
    rounds. Shared dependencies, and paths between the same pair, count once.
    """
    spark = edges.sparkSession
    base = work_path(spark, "ancestors")
    schema = roots.schema
    pairs = edges.distinct()
    roots.distinct().write.parquet(f"{base}/reached/round=0")
    number = 0
    while True:
        reached = spark.read.schema(schema).parquet(f"{base}/reached").select(*NODE)
        # the pairs of this round are stored, as both this round and the next one read them
        path = f"{base}/pairs/round={number}"
        pairs.write.parquet(path)
        stored = spark.read.schema(pairs.schema).parquet(path)
        step = stored.join(reached, NODE, "left_semi").select("app_id", "job_id", F.col("dep_rdd_id").alias("rdd_id"))
        new = step.distinct().join(reached, NODE, "left_anti")
        number += 1
        new.write.parquet(f"{base}/reached/round={number}")
        if number > 1:
            delete_path(spark, f"{base}/pairs/round={number - 2}")
        if spark.read.schema(schema).parquet(f"{base}/reached/round={number}").isEmpty():
            delete_path(spark, f"{base}/pairs")
            return spark.read.schema(schema).parquet(f"{base}/reached").select(*NODE)
        on = stored.select("app_id", "job_id", F.col("rdd_id").alias("dep_rdd_id"), F.col("dep_rdd_id").alias("_far"))
        pairs = stored.join(on, DEPENDENCY).select(*NODE, F.col("_far").alias("dep_rdd_id")).distinct()


def _items(
    paths: DataFrame, direction: str, conf: DataFrame, keys: ConfKeys, compat: bool
) -> DataFrame:
    uri, endpoints = F.col("path"), (F.col("s3a_endpoint"), F.col("s3n_endpoint"))
    located = with_endpoints(paths, conf, ["job_id", "rdd_id", "item"], keys)
    # what a name uses several times are columns, since Spark would work an expression out each time
    ns, behind = F.col("ns"), F.col("uri_path")
    if compat:
        parts = located.withColumns({"ns": namespace(uri), "uri_path": uri_path(uri)})
        name = name_of_path(ns, behind, *endpoints)
    else:
        # one S3 name for both kinds of jobs, unless the RDD flavour is asked for
        is_hdfs = uri.startswith("hdfs://")
        parts = located.withColumns(
            {"s3": s3_parts(uri, *endpoints), "ns": F.when(is_hdfs, namespace(uri)), "uri_path": F.when(is_hdfs, uri_path(uri))}
        )
        name = F.coalesce(s3_of_parts(F.col("s3")), hdfs_name(ns, behind))
    return (
        parts.select(
            "app_id",
            F.col("job_id").alias("dep_id"),
            F.lit(direction).alias("direction"),
            F.col("rdd_id").alias("node_id"),
            F.col("item").cast("bigint").alias("item"),
            # generated, so that the test of the name doesn't make it again
            F.explode(F.array(name)).alias("name"),
            F.lit(None).cast("string").alias("error"),
        )
        .where(F.col("name").isNotNull())
    )


def rdd_inputs(
    closure: DataFrame, rdd_nodes: DataFrame, conf: DataFrame, keys: ConfKeys = KEYS, compat: bool = False
) -> DataFrame:
    """Names of the paths that the file scans in the closure read."""
    scans = rdd_nodes.where(F.col("input_paths").isNotNull()).join(closure, NODE)
    return _items(explode_input_paths(scans), "input", conf, keys, compat)


def rdd_outputs(rdd_output: DataFrame, conf: DataFrame, keys: ConfKeys = KEYS, compat: bool = False) -> DataFrame:
    """Name of the path that a result stage writes: old-API key first, then the new one."""
    written = rdd_output.where(F.col("final_stage_kind") == RESULT_STAGE).select(
        "app_id",
        "job_id",
        F.lit(0).cast("bigint").alias("rdd_id"),
        F.lit(0).alias("item"),
        F.coalesce("old_api_path", "new_api_path").alias("path"),
    )
    named = written.where(F.col("path").isNotNull())
    return _items(named, "output", conf, keys, compat)


def _with_class_names(rdd_nodes: DataFrame) -> DataFrame:
    """``kind, rdd_name, class_name``: the kind says whether the class name stands in for the name, the class name is NULL if it never does."""
    name = F.col("rdd_name")
    from_path = (F.col("rdd_class") == OLD_API_SCAN) & F.exists("input_paths", lambda p: p.contains(name))
    kind = (
        F.when(name.isNull() | F.coalesce(from_path, F.lit(False)), F.lit(BORROWED))
        .when(F.col("rdd_class") == MAPPED, F.lit(COPIED))
        .otherwise(F.lit(OWN))
    )
    class_name = F.when(F.col("kind") != OWN, camel_to_snake(F.col("rdd_class")))
    return rdd_nodes.withColumn("kind", kind).select(*NODE, "kind", "rdd_name", class_name.alias("class_name"))


def own_names(rdd_nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The name an RDD has by itself.

    The class name stands in for a missing name, for a name that is part of an
    input path, and for a name copied from the parent.
    """
    return _own_names(_with_class_names(rdd_nodes), edges)


def _own_names(named: DataFrame, edges: DataFrame) -> DataFrame:
    parents = named.select(
        "app_id", "job_id", F.col("rdd_id").alias("dep_rdd_id"), F.col("rdd_name").alias("parent_name")
    )
    first_deps = edges.where(F.col("dep_pos") == 0).select(*NODE, "dep_rdd_id")
    placed = named.join(first_deps, NODE, "left").join(parents, DEPENDENCY, "left")
    from_parent = (F.col("kind") == COPIED) & F.coalesce(F.col("rdd_name") == F.col("parent_name"), F.lit(False))
    borrowed = (F.col("kind") == BORROWED) | from_parent
    return placed.select(*NODE, F.when(borrowed, F.col("class_name")).otherwise(F.col("rdd_name")).alias("own_name"))


def _joined(own: Column, deps: Column) -> Column:
    """Head and length of the name that follows from the own name and the names of the dependencies, in order."""
    text = F.array_join(F.transform(deps, lambda d: d["head"]), "_")
    length = F.reduce(deps, F.lit(-1).cast("bigint"), lambda n, d: F.least(n + d["n_chars"] + 1, F.lit(COUNTED_CHARS).cast("bigint")))
    stands_alone = F.startswith(text, own)
    head = F.when(stands_alone, text).otherwise(F.concat_ws("_", own, text))
    n_chars = F.when(stands_alone, length).otherwise(F.least(F.coalesce(F.length(own), F.lit(0)) + length + 1, F.lit(COUNTED_CHARS).cast("bigint")))
    bare = F.size(deps) == 0
    return F.struct(
        F.left(F.when(bare, own).otherwise(head), F.lit(MOST_CHARS)).alias("head"),
        F.when(bare, F.coalesce(F.length(own), F.lit(0)).cast("bigint")).otherwise(n_chars).alias("n_chars"),
    )


def _solve(own: dict[int, str | None], deps: dict[int, list[int]], most: int) -> dict[int, tuple[str | None, int]]:
    """The names of one graph: for each RDD the name's beginning, and its length."""
    heads: dict[int, tuple[str | None, int]] = {}

    def name_of(node: int, below: list[int] | None) -> None:
        name = own[node]
        if below:
            found = [heads[dep] for dep in below]
            text = "_".join([head for head, _ in found if head is not None])[:most]
            length = sum([n for _, n in found]) + len(found) - 1
            if name is None or not text.startswith(name):
                text = text if name is None else f"{name}_{text}"[:most]
                length += len(name or "") + 1
            heads[node] = (text, length if length < COUNTED_CHARS else COUNTED_CHARS)
        else:
            heads[node] = (name, 0) if name is None else (name[:most], len(name))

    # the most come after what they depend on
    late = []
    for node in own:
        below = deps.get(node)
        if below and not all([dep in heads for dep in below]):
            late.append(node)
        else:
            name_of(node, below)
    if not late:
        return heads
    above: dict[int, list[int]] = {}
    waiting = {}
    for node in late:
        open_ones = [dep for dep in deps[node] if dep not in heads]
        waiting[node] = len(open_ones)
        for dep in open_ones:
            above.setdefault(dep, []).append(node)
    ready = [node for node in late if not waiting[node]]
    while ready:
        node = ready.pop()
        name_of(node, deps[node])
        for up in above.get(node, ()):
            waiting[up] -= 1
            if not waiting[up]:
                ready.append(up)
    return heads


def _solve_graph(nodes: dict[int, tuple], edges: dict[int, list[tuple]], most: int) -> dict[int, tuple[str | None, int]]:
    """The same from what a graph's rows tell: names of RDDs, and positions of dependencies."""
    own: dict[int, str | None] = {}
    deps: dict[int, list[int]] = {}
    for rdd, (kind, name, class_name) in nodes.items():
        below = edges.get(rdd)
        if below:
            if len(below) > 1:
                below.sort()
            if kind == COPIED and any([place == 0 and dep in nodes and nodes[dep][1] == name for place, dep in below]):
                kind = BORROWED
            deps[rdd] = [dep for _, dep in below if dep in nodes]
        own[rdd] = class_name if kind == BORROWED else name
    return _solve(own, deps, most)


def _solve_graphs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Names of whole graphs, whose RDDs and edges come one after another."""
    key, nodes, edges = None, {}, {}
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    columns: list[list] = [[] for _ in types]
    apps, jobs, rdds, found, lengths = columns
    n_chars = 0

    def flush() -> pa.RecordBatch:
        nonlocal n_chars
        batch = pa.RecordBatch.from_arrays([pa.array(*column) for column in zip(columns, types)], [*NODE, "name", "n_chars"])
        for column in columns:
            column.clear()
        n_chars = 0
        return batch

    def solve() -> None:
        nonlocal n_chars
        app, job = key
        for rdd, (name, length) in _solve_graph(nodes, edges, most).items():
            apps.append(app)
            jobs.append(job)
            rdds.append(rdd)
            found.append(name if length <= most else None)
            lengths.append(length)
            n_chars += length if length <= most else 0

    for batch in batches:
        for app, job, rdd, kind, dep, place, name, class_name in zip(*map(_values, batch.columns)):
            if key is None or job != key[1] or app != key[0]:
                if key is not None:
                    solve()
                key, nodes, edges = (app, job), {}, {}
                if len(apps) >= 10_000 or n_chars >= BATCH_CHARS:
                    yield flush()
            if kind != EDGE:
                nodes[rdd] = (kind, name, class_name)
            elif rdd in edges:
                edges[rdd].append((place, dep))
            else:
                edges[rdd] = [(place, dep)]
    if key is not None:
        solve()
    yield flush()


def _graph_rows(rdd_nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """RDDs, and edges between two of a job, told apart by their ``kind``; numbers of RDDs and edges are never NULL."""
    columns = [*NODE, "kind", "dep_rdd_id", "dep_pos", "rdd_name", "class_name"]
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    whole = [F.col(c).isNotNull() for c in (*NODE, "dep_rdd_id")]
    # an edge without a position comes first
    place = F.coalesce(F.col("dep_pos").cast("bigint"), F.lit(NO_PLACE))
    of_edges = edges.where(reduce(Column.__and__, whole)).select(
        *NODE, F.lit(EDGE).alias("kind"), "dep_rdd_id", place.alias("dep_pos"), none.alias("rdd_name"), none.alias("class_name")
    )
    of_nodes = _with_class_names(rdd_nodes).withColumns({"dep_rdd_id": zero, "dep_pos": zero})
    return of_nodes.select(*columns).unionByName(of_edges)


def lineage_names(rdd_nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Name of each RDD from its own name and those of its dependencies, in order, and its length ``n_chars``.

    A dependency text that already
    starts with the own name stands alone. A dependency on an RDD that is not in
    the graph counts as none, so no RDD loses its name. RDDs that depend on themselves have none. A name repeats the text of
    each dependency, so it may double in length with each level of diamonds: a name of more than
    MOST_CHARS characters is NULL, and only its length (counted up to COUNTED_CHARS) tells of it.

    The RDDs and edges of a job go to one task, in one shuffle without joins, which makes their own names and walks the graph once;
    one with more than GRAPH_SIZE RDDs and edges goes through :func:`_names_by_rounds`, with the same result.
    """
    # stored, since they are read several times
    rows = cut_lineage(_graph_rows(rdd_nodes, edges))
    large = large_groups(rows, JOB, GRAPH_SIZE)
    small = rows.join(large, JOB, "left_anti") if large is not None else rows
    ordered = small.repartition(*JOB).sortWithinPartitions(*BY_JOB)
    most = MOST_CHARS
    names = ordered.mapInArrow(lambda batches: _solve_graphs(batches, most), f"{_NODE_SCHEMA}, name string, n_chars bigint")
    if large is not None:
        names = names.unionByName(_names_of_large(rows.join(large, JOB, "left_semi")))
    return names


def _names_of_large(rows: DataFrame) -> DataFrame:
    """The names of graphs that are too large for one task."""
    nodes, edges = rows.where(F.col("kind") != EDGE), rows.where(F.col("kind") == EDGE).select(*NODE, "dep_rdd_id", "dep_pos")
    present = nodes.select("app_id", "job_id", F.col("rdd_id").alias("dep_rdd_id")).distinct()
    kept = cut_lineage(edges.join(present, DEPENDENCY, "left_semi"))
    counts = kept.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_deps"))
    own = _own_names(nodes.select(*NODE, "kind", "rdd_name", "class_name"), edges).join(counts, NODE, "left")
    return _names_by_rounds(own.fillna(0, ["n_deps"]), kept)


def _names_by_rounds(own: DataFrame, kept: DataFrame) -> DataFrame:
    """The same for graphs of any size: ``own`` are RDDs with their own names and numbers of dependencies.

    From the leaves on, each finished name goes along the edges to the RDDs that depend on it, and an RDD is finished
    when it has the names of all its dependencies. A round groups those messages
    alone, and the edges of finished RDDs are dropped after 2, 4, 8 and so on rounds.
    """
    spark, own = own.sparkSession, cut_lineage(own)
    # along the edges, upwards: the RDD that depends comes with what it needs to make its own name
    up = cut_lineage(
        kept.join(own, NODE).select(
            F.col("app_id").alias("_app"), F.col("job_id").alias("_job"), F.col("dep_rdd_id").alias("_rdd"),
            F.struct("rdd_id", "dep_pos", "own_name", "n_deps").alias("up"),
        )
    )
    base = work_path(spark, "lineage-names")
    number, deps_type = 0, f"array<{_DEP}>"
    messages = own.where(F.col("n_deps") == 0).withColumn("deps", F.array().cast(deps_type))
    schema = messages.schema

    def names() -> DataFrame:
        return spark.read.schema(f"{_NODE_SCHEMA}, name string, n_chars bigint").parquet(f"{base}/round=*/kind=name")

    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("name", "string"), ("n_chars", "bigint"))]
    while True:
        gathered = messages.groupBy(*NODE).agg(
            F.first("own_name").alias("own_name"),
            F.first("n_deps").alias("n_deps"),
            F.array_sort(F.flatten(F.collect_list("deps"))).alias("deps"),
        )
        made = F.when(F.size("deps") == F.col("n_deps"), _joined(F.col("own_name"), F.col("deps")))
        finished = F.col("made").isNotNull()
        same = [F.col(a) == F.col(b) for a, b in zip(NODE, _UP)]
        sent = gathered.withColumn("made", made).join(up, [*same, finished], "left")
        waiting = F.struct(F.lit("message").alias("kind"), "rdd_id", "own_name", "n_deps", "deps", *nothing)
        name = F.struct(
            F.lit("name").alias("kind"),
            "rdd_id",
            F.lit(None).cast("string").alias("own_name"),
            F.lit(None).cast("bigint").alias("n_deps"),
            F.lit(None).cast(deps_type).alias("deps"),
            F.when(F.col("made.n_chars") <= MOST_CHARS, F.col("made.head")).alias("name"),
            F.col("made.n_chars").alias("n_chars"),
        )
        dep = F.struct(F.col("up.dep_pos").alias("dep_pos"), F.col("made.head").alias("head"), F.col("made.n_chars").alias("n_chars"))
        message = F.struct(
            F.lit("message").alias("kind"), "up.rdd_id", "up.own_name", "up.n_deps", F.array(dep).cast(deps_type).alias("deps"), *nothing
        )
        rows = F.when(~finished, F.array(waiting)).when(F.col("up").isNull(), F.array(name)).otherwise(F.array(name, message))
        out = sent.select("app_id", "job_id", F.explode(rows).alias("row")).select("app_id", "job_id", "row.*")
        out.write.partitionBy("kind").parquet(f"{base}/round={number}")
        delete_path(spark, f"{base}/round={number - 1}/kind=message")
        # a round without a name has nothing but dependencies in a circle
        if not all(path_exists(spark, f"{base}/round={number}/kind={kind}") for kind in ("message", "name")):
            break
        messages = spark.read.schema(schema).parquet(f"{base}/round={number}/kind=message")
        number += 1
        if number & (number - 1) == 0:
            # the edges of finished RDDs go, so later rounds read those of deeper graphs alone
            up = cut_lineage(up.join(names().select(*[F.col(a).alias(b) for a, b in zip(NODE, _UP)]), _UP, "left_anti"))
    # a name comes once for each RDD that depends on it
    return names().dropDuplicates(NODE)
