"""Running totals and neighbours in a global order, without bringing all rows to one task."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headwater.llm.frames import shuffle_partitions
from headwater.session import cut_lineage


def running_total(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str, place: str = "_place"
) -> DataFrame:
    """Add to each row the sum of ``value`` over its group up to and including it.

    The rows are range-sorted once over all tasks and stored in the shared folder,
    so that equal rows keep one order however often a task runs. ``place`` numbers
    the stored rows uniquely, in order. A row's total is that inside its partition
    plus those of the partitions before, which a table of one row per (group,
    partition) tells. No task sees a whole group. NULL is a group like any other.
    """
    group, order = list(group), list(order)
    stored = cut_lineage(
        rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn(place, F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftrightunsigned(place, 33))
    cell = [*group, "_part"]
    inside = Window.partitionBy(*cell).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    parts = stored.groupBy(*cell).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    parts = parts.select(*[F.col(c).alias(f"_of_{c}") for c in cell], "_before")
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in cell]
    return (
        stored.withColumn("_inside", F.sum(value).over(inside))
        .join(parts, same)
        .withColumn(out, F.col("_inside") + F.col("_before"))
        .drop("_part", "_inside", "_before", *[f"_of_{c}" for c in cell])
    )


def in_order(docs: DataFrame, buckets_per_partition: int = 4) -> DataFrame:
    """``doc_id, text`` dealt into buckets that are ranges of ids, each sorted, its successor's first row last.

    The order is by ``doc_id``, NULL last, then by a hash of the text. A bucket ends
    with the first row of the bucket after it, where ``extra`` is 1, and the last
    bucket with the very first row, so each row meets its successor in one task.
    The bounds of the buckets, a few numbers each, are found by a range partitioning
    of ids and hashes alone; the texts are shuffled once.
    """
    rows = docs.select(
        F.col("doc_id").isNull().alias("_null"), "doc_id", F.xxhash64("text").alias("_hash"), "text"
    )
    key = ["_null", "doc_id", "_hash"]
    partitions = shuffle_partitions(docs.sparkSession)
    ranges = rows.select(*key).repartitionByRange(partitions * buckets_per_partition, *key)
    firsts = ranges.withColumn("_part", F.spark_partition_id()).groupBy("_part").agg(F.min(F.struct(*key)).alias("first"))
    bounds = sorted(tuple(0 if x is None else x for x in row.first) for row in firsts.collect())
    last = max(len(bounds) - 1, 0)

    @F.pandas_udf("int")
    def bucket(null: pd.Series, doc_id: pd.Series, text_hash: pd.Series) -> pd.Series:
        """Twice the bucket, plus 1 for a row that a bucket begins with."""
        ids = [0 if n else i for n, i in zip(null, doc_id)]
        keys = list(zip(null, ids, text_hash))
        at = [bisect_right(bounds, k) - 1 for k in keys]
        return pd.Series([2 * b + (bounds[b] == k) for b, k in zip(at, keys)], dtype="int32")

    some_id = F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))  # no NULL, so that ids stay whole
    placed = rows.withColumn("_at", bucket("_null", some_id, "_hash"))
    own = F.expr("struct(_at div 2 as bucket, 0 as extra)")
    copy = F.expr(f"struct(if(_at = 1, {last}, _at div 2 - 1) as bucket, 1 as extra)")
    places = F.explode(F.when(F.col("_at") % 2 == 1, F.array(own, copy)).otherwise(F.array(own)))
    dealt = placed.withColumn("_place", places).select("_place.bucket", "_place.extra", *key, "text")
    return (
        dealt.repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "extra", *key)
        .select("bucket", "extra", "doc_id", "text")
    )
