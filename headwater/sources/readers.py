"""Scans of the systems that jobs read from.

Thin by intent: each is the ``spark.read`` call that lets Catalyst push filters
and columns into the source. ``fmt`` names the connector, so a deployment can
use another build of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Connector names.
KAFKA = "kafka"
DELTA = "delta"
SNOWFLAKE = "net.snowflake.spark.snowflake"


@dataclass(frozen=True)
class Split:
    """How a JDBC scan is split into parallel queries on a numeric or time column."""

    column: str
    lower: int | str
    upper: int | str
    parts: int


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    """A table, or ``(select ...) alias`` run by the database.

    Without ``split`` one task reads everything through one connection: give one
    for any table that is not small.
    """
    options = dict(properties or {})
    if split is None:
        return spark.read.jdbc(url=url, table=table, properties=options)
    return spark.read.jdbc(
        url=url,
        table=table,
        column=split.column,
        lowerBound=split.lower,
        upperBound=split.upper,
        numPartitions=split.parts,
        properties=options,
    )


def scan_kafka(
    spark: SparkSession, servers: str, topics: str, options: Mapping[str, str] | None = None, fmt: str = KAFKA
) -> DataFrame:
    """Batch scan of a comma list of topics."""
    return (
        spark.read.format(fmt)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .options(**dict(options or {}))
        .load()
    )


KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
    ]
)


def scan_topic_archive(spark: SparkSession, path: str, topics: str) -> DataFrame:
    """Records of a comma list of topics from an archive partitioned by topic.

    Only the folders of the named topics are read.
    """
    wanted = [topic.strip() for topic in topics.split(",") if topic.strip()]
    return spark.read.schema(KAFKA_RECORD).parquet(path).where(F.col("topic").isin(wanted))


def scan_delta(spark: SparkSession, path: str, fmt: str = DELTA) -> DataFrame:
    return spark.read.format(fmt).load(path)


def scan_snowflake(
    spark: SparkSession, options: Mapping[str, str], query: str, fmt: str = SNOWFLAKE
) -> DataFrame:
    return spark.read.format(fmt).options(**dict(options)).option("query", query).load()


def scan_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths))


def scan_files(
    spark: SparkSession,
    fmt: str,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Any file relation with one or several root paths."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths if isinstance(paths, str) else list(paths))
