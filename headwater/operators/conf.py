"""Application configuration: lookup, defaults, and the choice of a sink."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from headwater.functions.scalars import UNKNOWN, conf_flag, is_http_url
from headwater.skew import lookup_join


@dataclass(frozen=True)
class ConfKeys:
    """Configuration keys that steer reporting and S3 names."""

    host_key: str = "spark.lineage.host.key"
    enabled: str = "spark.lineage.enabled"
    url: str = "spark.lineage.host.url"
    s3a_endpoint: str = "spark.hadoop.fs.s3a.endpoint"
    s3n_endpoint: str = "spark.hadoop.fs.s3n.endpoint"


KEYS = ConfKeys()


def conf_kv(events: DataFrame) -> DataFrame:
    """One row per application and configuration key."""
    return events.where(F.col("conf").isNotNull()).select("app_id", F.explode("conf").alias("key", "value"))


def conf_columns(conf: DataFrame, **columns: str) -> DataFrame:
    """One row per application with the named keys as columns; combines before the shuffle."""
    return (
        conf.where(F.col("key").isin(list(columns.values())))
        .groupBy("app_id")
        .agg(*[F.max(F.when(F.col("key") == key, F.col("value"))).alias(name) for name, key in columns.items()])
    )


def with_conf(df: DataFrame, conf: DataFrame, key: str, default: str, name: str, spread: list[str]) -> DataFrame:
    """``df`` with the value of one configuration key of its application, or the default."""
    found = lookup_join(df, conf_columns(conf, **{name: key}), ["app_id"], spread)
    return found.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def with_endpoints(
    df: DataFrame, conf: DataFrame, spread: list[str], keys: ConfKeys = KEYS, hot: Sequence[Row] | None = None
) -> DataFrame:
    """``df`` with the S3 endpoints of its application; NULL where none is set.

    ``hot`` names the hot applications if they are already known.
    """
    endpoints = conf_columns(conf, s3a_endpoint=keys.s3a_endpoint, s3n_endpoint=keys.s3n_endpoint)
    return lookup_join(df, endpoints, ["app_id"], spread, hot=hot)


def route_apps(apps: DataFrame, conf: DataFrame, keys: ConfKeys = KEYS) -> DataFrame:
    """Host and sink of each application, with the reason; the order of the tests matters."""
    settings = conf_columns(conf, _host=keys.host_key, _enabled=keys.enabled, _url=keys.url)
    reason = (
        F.when(F.col("_host").isNull(), F.lit("no_host_key"))
        .when(~conf_flag(F.col("_enabled")), F.lit("disabled"))
        .when(~is_http_url(F.col("_url")), F.lit("no_valid_url"))
    )
    return (
        apps.select("app_id")
        .distinct()
        .join(settings, "app_id", "left")
        .select(
            "app_id",
            F.coalesce("_host", F.lit(UNKNOWN)).alias("host"),
            F.when(reason.isNull(), F.lit("publish")).otherwise(F.lit("log")).alias("sink"),
            F.coalesce(reason, F.lit("ok")).alias("reason"),
        )
    )
