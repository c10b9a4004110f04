"""Building blocks of ordinary ETL jobs: filters, projections, left joins, word count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.skew import lookup_join

# The accepted position range. The upper latitude is 80.
LATITUDE = (-90, 80)
LONGITUDE = (-180, 180)


def valid_position(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.where(F.col(lat).between(*LATITUDE) & F.col(lon).between(*LONGITUDE))


def non_zero_position(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows where either coordinate differs from 0; two NULLs drop the row."""
    return df.where((F.col(lat) != 0) | (F.col(lon) != 0))


def where_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def where_le(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.where(F.col(column) <= bound)


def drop_cols(df: DataFrame, *columns: str) -> DataFrame:
    """Without these columns; names that do not exist are ignored."""
    return df.drop(*columns)


def project(df: DataFrame, *expressions: str) -> DataFrame:
    return df.selectExpr(*expressions)


def with_cast(df: DataFrame, source: str, dtype: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source).cast(dtype))


def left_join(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    """Left outer join on any condition; key types may differ, Spark aligns them."""
    return left.join(right, condition, "left")


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread: Sequence[str],
    key_type: str,
) -> DataFrame:
    """Left outer equi-join to a table with few rows per key, with hot keys split.

    Both keys are compared as ``key_type``. The columns of both sides are kept.
    """
    return lookup_join(
        left.withColumn("_key", F.col(left_key).cast(key_type)),
        right.withColumn("_key", F.col(right_key).cast(key_type)),
        ["_key"],
        spread,
    ).drop("_key")


def top_rows(df: DataFrame, n: int, order: Sequence[str | Column] | None = None) -> DataFrame:
    """The first ``n`` rows; with an order the result is repeatable."""
    return (df.orderBy(*order) if order else df).limit(n)


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Count of each blank-separated token of each line; empty tokens count too."""
    words = lines.select(F.explode(F.split(F.col(column), " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
