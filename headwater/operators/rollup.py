"""Aggregates over events and lineage items.

Lists are kept as rows, never as one array per application, so an application
with a third of all rows is no different from any other: each aggregate combines
before its shuffle, and its groups are single datasets, keys or executions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater import schemas as S
from headwater.operators.routing import classify_jobs
from headwater.session import cut_lineage
from headwater.skew import large_groups, number_rows

DEP = ["app_id", "dep_id"]
# The largest edge set whose lists are compared as a whole.
LIST_SIZE = 10_000
# The items whose lists one task makes, on average at most.
TASK_ITEMS = 1_000_000


def merge_deps(items: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Concatenate the lists of several edge sets: order kept, duplicates kept.

    ``order`` places the items; the result numbers them from 0 per ``keys`` and
    direction. ``items`` are computed once, and stored.
    """
    return number_rows(items, [*keys, "direction"], order)


def _hash(seed: int) -> Column:
    """A 64-bit hash of an item's direction, position and name."""
    return F.xxhash64(F.lit(seed), "direction", "pos", "name")


def dep_fingerprints(numbered: DataFrame, seed: int = 0) -> DataFrame:
    """One row per edge set: lengths and a sum over its numbered inputs and outputs.

    The sums are of hashes of (direction, position, name), so
    tasks combine them before the shuffle and no list is ever collected.
    """
    return numbered.groupBy(*DEP).agg(
        F.count_if(F.col("direction") == "input").alias("n_inputs"),
        F.count_if(F.col("direction") == "output").alias("n_outputs"),
        F.bit_xor(_hash(seed)).alias("bits"),
    )


def distinct_deps(items: DataFrame) -> DataFrame:
    """Items of one edge set (the one with the lowest id) of each group of equal ones.

    Equal means the same input list and the same output list in one application. The lists of an edge set are compared as
    a whole, so its items are shuffled once to become lists, and once with the lists. Edge sets of more than
    LIST_SIZE items go through :func:`_distinct_large`, with the same result: equal ones have equal sizes.
    ``items`` should be stored, since it is read several times.
    """
    named = items.where(F.col("name").isNotNull() & F.col("app_id").isNotNull() & F.col("dep_id").isNotNull())
    total = items.count()
    large = large_groups(named, DEP, LIST_SIZE, total)
    tasks = -(-total // TASK_ITEMS)
    if large is None:
        return _distinct_small(named, tasks)
    small = _distinct_small(named.join(large, DEP, "left_anti"), tasks)
    return small.unionByName(_distinct_large(cut_lineage(named.join(large, DEP, "left_semi"))))


def _distinct_small(named: DataFrame, tasks: int) -> DataFrame:
    # more tasks than shuffles have by default, where the items of one would be too many
    def over_tasks(rows: DataFrame, *keys: str) -> DataFrame:
        most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(tasks, *keys) if tasks > most else rows

    listed = ["direction", "name"]
    rest = [c for c in named.columns if c not in (*DEP, *listed)]
    order = ["direction", "node_id", "item", "name"]
    row = F.struct(*order, *[c for c in rest if c not in order])
    # numbers come first in the keys: Spark groups lists by sorting, and a sort by them compares few whole keys
    sets = over_tasks(named, *DEP).groupBy("dep_id", "app_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))

    def fields(names: Sequence[str]) -> Column:
        return F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in names]))

    lists = sets.select(*DEP, fields(listed).alias("list"), fields(rest).alias("rest"))
    # the hash spares comparisons of unequal lists
    hashed = over_tasks(lists.withColumn("bits", F.xxhash64("list")), "app_id", "bits")
    equal = hashed.groupBy("bits", "app_id", "list")
    kept = equal.agg(F.min("dep_id").alias("dep_id"), F.min_by("rest", "dep_id").alias("rest"))
    found = kept.select(*DEP, F.explode(F.arrays_zip("list", "rest")).alias("r"))
    return found.select(*[f"r.list.{c}" if c in listed else f"r.rest.{c}" if c in rest else c for c in named.columns])


def _distinct_large(items: DataFrame) -> DataFrame:
    """The same for edge sets of any size, whose lists are never collected. Fingerprints only propose what
    is equal: a group of several has to have one name at each position. Where it has not, its members are compared with its first,
    and those that differ are grouped again by another hash, until none is left, so no edge set is lost to a collision.
    ``items`` should be stored, since it is read several times.
    """
    named = items.where(F.col("name").isNotNull())
    numbered = number_rows(named, DEP, ["direction", "node_id", "item", "name"], stored=True)
    equal = ["app_id", "n_inputs", "n_outputs", "bits"]
    kept, left, seed = [], numbered, 0
    while True:
        prints = cut_lineage(dep_fingerprints(left, seed))
        groups = prints.groupBy(*equal).agg(F.min("dep_id").alias("first"), F.count(F.lit(1)).alias("n"))
        kept.append(groups.select("app_id", F.col("first").alias("dep_id")))
        members = prints.join(groups.where("n > 1"), equal).select(*DEP, "first")
        # lengths are equal, so the lists of a group are if it has one name at each position
        places = left.join(members, DEP).groupBy("app_id", "first", "direction", "pos")
        names = places.agg(F.min("name").alias("least"), F.max("name").alias("greatest"))
        mixed = cut_lineage(names.where("least <> greatest").select("app_id", "first").distinct())
        if mixed.isEmpty():
            break
        left, seed = left.join(_unequal(left, members.join(mixed, ["app_id", "first"], "left_semi")), DEP, "left_semi"), seed + 1
    chosen = reduce(DataFrame.unionByName, kept)
    return numbered.drop("pos").join(chosen, DEP, "left_semi")


def _unequal(numbered: DataFrame, members: DataFrame) -> DataFrame:
    """The members of groups whose lists are not those of the group's first."""
    own = numbered.join(members, DEP).select(*DEP, "first", "direction", "pos", "name")
    theirs = numbered.select("app_id", F.col("dep_id").alias("first"), "direction", "pos", "name")
    differ = own.join(theirs, ["app_id", "first", "direction", "pos", "name"], "left_anti")
    return cut_lineage(differ.select(*DEP).distinct())


def app_lineage(items: DataFrame, distinct: bool = False) -> DataFrame:
    """Datasets of each application: ``app_id, direction, name, n``.

    ``n`` says how often the dataset is in the concatenated list, so the bag is
    kept whole; ``distinct`` reports each dataset with ``n`` = 1.
    """
    named = items.where(F.col("name").isNotNull()).groupBy("app_id", "direction", "name")
    return named.agg(F.lit(1).cast("bigint").alias("n") if distinct else F.count(F.lit(1)).alias("n"))


def _ended() -> Column:
    return F.when(F.col("event") == S.JOB_END, F.col("event_ms"))


def _failed() -> Column:
    return (F.col("event") == S.JOB_END) & (F.col("result") == S.JOB_FAILED)


def _last_error() -> Column:
    # rows that did not fail have a NULL order and never win
    when_failed = F.when(_failed(), F.struct("event_ms", "job_id"))
    return F.max_by("error_message", when_failed)


def _status() -> Column:
    return F.when(F.col("n_failed") > 0, F.lit("FAILED")).otherwise(F.lit("SUCCESS"))


def end_time(events: DataFrame) -> DataFrame:
    """Latest job end per application, 0 if no job ended."""
    return events.groupBy("app_id").agg(F.coalesce(F.max(_ended()), F.lit(0)).alias("end_ms"))


def run_status(events: DataFrame) -> DataFrame:
    """Status and last failure message per application; a later success clears nothing."""
    runs = events.groupBy("app_id").agg(
        F.coalesce(F.max(_ended()), F.lit(0)).alias("end_ms"),
        F.count_if(_failed()).alias("n_failed"),
        _last_error().alias("status_reason"),
    )
    return runs.withColumn("status", _status())


def merge_metadata(events: DataFrame) -> DataFrame:
    """Properties of SQL job starts per application and key; the last value wins."""
    pairs = (
        classify_jobs(events)
        .where(F.col("job_kind") == "sql")
        .select("app_id", "event_ms", "job_id", F.explode("properties").alias("key", "value"))
    )
    return pairs.groupBy("app_id", "key").agg(F.max_by("value", F.struct("event_ms", "job_id")).alias("value"))


def rollup_apps(events: DataFrame) -> DataFrame:
    """One row per application: name, start, latest end, status, last failure, completeness."""
    event = F.col("event")
    start = F.when(event == S.APP_START, F.col("event_ms"))
    apps = events.groupBy("app_id").agg(
        F.max("app_name").alias("app_name"),
        F.min(start).alias("start_ms"),
        F.coalesce(F.max(_ended()), F.lit(0)).alias("end_ms"),
        F.count_if(event == S.JOB_START).alias("n_jobs"),
        F.count_if(_failed()).alias("n_failed"),
        _last_error().alias("status_reason"),
        F.max(event == S.APP_END).alias("has_ended"),
    )
    complete = F.col("has_ended") & (F.col("end_ms") > 0)
    return apps.withColumn("status", _status()).withColumn("is_complete", complete).drop("has_ended")
