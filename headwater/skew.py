"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.session import cut_lineage

# Beside each hot key: into how many pieces its rows are split.
PIECES = "_pieces"


def even_share(spark: SparkSession) -> float:
    """The share of the rows that one shuffle partition holds when all hold the same."""
    return 1 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float | None = None, weight: str | None = None
) -> DataFrame:
    """Keys with more than ``share`` of all rows, and the pieces that bring each below it.

    The default share is that of one shuffle partition. There are never more than
    ``1 / share`` such keys, nor more than ``2 / share`` pieces. With ``weight``, a
    row counts as that many.
    """
    share = share or even_share(df.sparkSession)
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(*keys).agg(rows.alias("_n"))
    fair = counts.agg((F.sum("_n") * F.lit(share)).alias("_fair")).scalar()
    hot = counts.where(F.col("_n") > fair)
    return hot.select(*keys, F.ceil(F.col("_n") / fair).cast("int").alias(PIECES))


def large_groups(rows: DataFrame, keys: Sequence[str], most: int, total: int | None = None) -> DataFrame | None:
    """The keys of groups of more than ``most`` rows, stored; none if there is no such group.

    Rows are counted in buckets first, which are far fewer than groups, and hold a sixteenth of ``most`` on average: a
    group that is too large fills a bucket, so only the groups of buckets with more than ``most`` rows are counted one by
    one. ``rows`` should be stored, since they are read several times; ``total`` is how many they are at most, if that is known.
    """
    buckets = 1 + 16 * (rows.count() if total is None else total) // max(most, 1)
    bucketed = rows.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"))
    full = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("_bucket")
    if full.isEmpty():
        return None
    counts = bucketed.join(full, "_bucket", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = cut_lineage(counts.where(F.col("_n") > most).select(*keys))
    return None if large.isEmpty() else large


def find_hot(
    df: DataFrame, keys: Sequence[str], share: float | None = None, weight: str | None = None
) -> list[Row]:
    """The hot keys themselves, on the driver: at most ``1 / share`` short rows.

    One aggregate over the key columns that combines before its shuffle. Knowing
    the list up front keeps plans small, and leaves a plain join when it is empty.
    """
    return hot_keys(df, keys, share, weight).collect()


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    share: float | None = None,
    hot: Sequence[Row] | None = None,
) -> DataFrame:
    """Join many ``facts`` rows to few ``dim`` rows per key.

    Give ``hot`` (from :func:`find_hot`, counted once for a stored fact table) where
    one key may hold a large share of the rows: its rows are split into pieces by
    the ``spread`` columns, and only the ``dim`` rows of hot keys are repeated, once
    per piece. Rows with a NULL key match nothing and are spread as well. All other
    keys join as usual. With ``share`` the hot keys are counted here. With neither
    it is a plain join, whose large partitions Spark splits at run time.
    """
    keys = list(keys)
    spark = facts.sparkSession
    if hot is None and share is not None:
        hot = find_hot(facts, keys, share)
    if not hot:
        return facts.join(dim, keys, how)
    schema = facts.select(*keys, F.lit(0).alias(PIECES)).schema
    marked = F.broadcast(spark.createDataFrame(list(hot), schema))
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    most = max(row[PIECES] for row in hot)
    pieces = F.coalesce(F.col(PIECES), F.when(null_key, F.lit(most)), F.lit(1))
    # a hash of the row, so that a task that runs twice sends each row the same way
    left = (
        facts.join(marked, keys, "left")
        .withColumn("_piece", F.pmod(F.xxhash64(*spread), pieces).cast("int"))
        .drop(PIECES)
    )
    numbers = F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - F.lit(1))
    right = dim.join(marked, keys, "left").withColumn("_piece", F.explode(numbers)).drop(PIECES)
    return left.join(right, keys + ["_piece"], how).drop("_piece")


def _number_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each group in one sorted partition from 0; ``_row`` is the place in the partition."""
    last, count, row = None, 0, 0
    for batch in batches:
        group = np.asarray(batch.column("_group"))
        n = len(group)
        begins = np.ones(n, bool)
        begins[1:] = group[1:] != group[:-1]
        if n and group[0] == last:
            begins[0] = False
        place = np.arange(n)
        since = np.maximum.accumulate(np.where(begins, place, -count if n and not begins[0] else 0))
        inside = place - since
        if n:
            last, count = group[-1], int(inside[-1]) + 1
        columns = [*batch.columns, pa.array(inside), pa.array(place + row)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_inside", "_row"])
        row += n


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "pos", stored: bool = False) -> DataFrame:
    """Number the rows of each group from 0 in the given order, whatever the sizes of the groups.

    The rows are sorted once by group and order over all tasks, so a large group
    lies in many partitions, in order, and no task needs a group as a whole. Each partition numbers its own rows; only its
    first group may have begun before, so a short table with a row for each partition tells by how much that group's numbers go up.

    The rows are stored in the shared folder before the sort, which reads them twice, unless they are ``stored``, and after
    it, so that a task that runs again cannot see them in another order. Groups are told apart by 64-bit hashes beside the sort. Rows that
    are equal in all columns of the order may be numbered either way.
    """
    group, order = list(group), list(order)
    spark = df.sparkSession
    rows = df if stored else cut_lineage(df)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(partitions, *group, *order).sortWithinPartitions(*group, *order)
    keyed = placed.withColumn("_group", F.xxhash64(*group)).withColumn("_partition", F.spark_partition_id())
    more = T.StructType.fromDDL("_inside bigint, _row bigint").fields
    inside = cut_lineage(keyed.mapInArrow(_number_inside, T.StructType([*keyed.schema.fields, *more])))
    ends = inside.groupBy("_partition").agg(
        F.min_by("_group", "_row").alias("first"),
        F.max(F.struct("_row", "_group", "_inside")).alias("last"),
    )
    shifts, before, tail = [], None, 0
    for end in sorted(ends.collect()):  # a row for each partition
        shift = tail if end.first == before else 0
        whole = end.last._inside == end.last._row  # all rows are of one group
        before, tail = end.last._group, end.last._inside + 1 + (shift if whole else 0)
        shifts.append((end._partition, end.first, shift))
    table = F.broadcast(spark.createDataFrame(shifts, "_partition int, _first bigint, _shift bigint"))
    shift = F.when(F.col("_group") == F.col("_first"), F.col("_shift")).otherwise(F.lit(0))
    numbered = inside.join(table, "_partition").withColumn(out, F.col("_inside") + shift)
    return numbered.select(*df.columns, out)
