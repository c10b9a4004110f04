"""Writes to the systems that jobs write to, and of lineage documents."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from headwater.session import children, claim_path, cut_lineage, delete_path, read_claim
from headwater.sources.readers import DELTA, KAFKA, SNOWFLAKE


def sink_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write to a table; one connection per partition, at most ``numPartitions`` of ``properties``."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=dict(properties or {}))


def sink_kafka(df: DataFrame, servers: str, topic: str, fmt: str = KAFKA) -> None:
    """Write ``key`` and ``value`` to one topic."""
    df.write.format(fmt).option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def sink_topic_archive(df: DataFrame, path: str, topic: str) -> None:
    """Append ``key`` and ``value`` to the folder of one topic of an archive."""
    df.select("key", "value").write.mode("append").parquet(f"{path}/topic={topic}")


def sink_delta(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = DELTA) -> None:
    """Write a Delta table; its snapshots make it safe to overwrite a table the job reads."""
    df.write.format(fmt).mode(mode).save(path)


def sink_snowflake(
    df: DataFrame, options: Mapping[str, str], table: str, mode: str = "overwrite", fmt: str = SNOWFLAKE
) -> None:
    df.write.format(fmt).options(**dict(options)).option("dbtable", table).mode(mode).save()


class Commit(NamedTuple):
    """A version of a table, and the folder of its data."""

    version: int
    folder: str


class TableConflict(RuntimeError):
    """Another writer has committed a version since the one that a write builds on."""


def _commits(spark: SparkSession, path: str) -> list[Commit]:
    """The committed versions of a table, oldest first."""
    found = [child.name for child in children(spark, f"{path}/commits") if re.fullmatch(r"\d{12}", child.name)]
    read = [(int(name), read_claim(spark, f"{path}/commits/{name}")) for name in found]
    return [Commit(version, folder) for version, folder in read if folder]


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if a versioned table has a complete version."""
    return bool(_commits(spark, path))


def table_version(spark: SparkSession, path: str) -> int:
    """The newest version of a versioned table, 0 if it has none."""
    commits = _commits(spark, path)
    return commits[-1].version if commits else 0


def sink_table(df: DataFrame, path: str, base: int | None = None) -> int:
    """Replace a versioned Parquet table; returns the new version.

    Each write is a new folder, and readers take the newest committed one, so a job
    may replace a table that it also reads. The data come first; then the writer
    claims the next number by creating its commit file, which only one writer can, and where another has it, the one after. So commits
    are in one order for all, and none replaces another.

    With ``base`` the write builds on that version (0 for none): if another has been committed since,
    it is given up with :class:`TableConflict`, and the job may read anew and try again.
    """
    spark = df.sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/{folder}")
    commits = _commits(spark, path)
    version = (commits[-1].version if commits else 0) + 1 if base is None else base + 1
    while not claim_path(spark, f"{path}/commits/{version:012d}", folder):
        if base is not None:
            delete_path(spark, f"{path}/{folder}")
            raise TableConflict(f"version {version} of {path} is another writer's")
        version += 1
    return version


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest complete version of a versioned table, or the given one."""
    commits = _commits(spark, path)
    folder = next((c.folder for c in reversed(commits) if version is None or c.version == version), None)
    if folder is None:
        raise LookupError(f"{path} has no version" + (f" {version}" if version is not None else ""))
    return spark.read.parquet(f"{path}/{folder}")


def sweep_table(spark: SparkSession, path: str, keep: int = 1, older_than_hours: float = 24.0) -> list[str]:
    """Delete the data of all but the newest ``keep`` versions, and of writes that were given up; returns the folders.

    Only folders that were last written so long ago go, so a writer that has not committed yet, and readers of a version that was
    replaced a short time ago, are left alone. The commit files of deleted versions go last, so no number is given twice:
    the newest one always stays.
    """
    commits = _commits(spark, path)
    kept, gone = commits[-max(keep, 1) :], commits[: -max(keep, 1)]
    limit = (time.time() - 3600 * older_than_hours) * 1000
    folders = [
        child.name
        for child in children(spark, path)
        if child.name.startswith("data-") and child.modified_ms <= limit and child.name not in {c.folder for c in kept}
    ]
    for folder in folders:
        delete_path(spark, f"{path}/{folder}")
    for commit in gone:
        if commit.folder in folders:
            delete_path(spark, f"{path}/commits/{commit.version:012d}")
    return folders


def sink_text(df: DataFrame, base: str) -> str:
    """Write one string column as text to a folder of its own; returns the folder."""
    path = f"{base}/{uuid.uuid4()}"
    df.write.text(path)
    return path


PUBLISHED = "app_id string, sink string, source_name string, kind string, key string, items array<string>"
FAILED = "error string"
DOCUMENT = ["host", "source_name", "app_id", "kind", "key"]


def _failed_path(path: str) -> str:
    """Documents that cannot be published lie beside those that are."""
    return f"{path.rstrip('/')}-failed"


def _fault() -> Column:
    """Why a document cannot be published, NULL if it can."""
    missing = [F.when(F.col(name).isNull(), F.lit(f"no {name}")) for name in DOCUMENT]
    empty = F.when(F.col("items").isNull() | F.exists("items", lambda item: item.isNull()), F.lit("no items"))
    return F.coalesce(*missing, empty)


def _sent(documents: DataFrame, send: Callable[[str, Row], None]) -> DataFrame:
    """Hand each document without a fault to ``send``; what it raises becomes the document's ``error``."""
    schema = documents.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = []
            for values in batch.itertuples(index=False, name=None):
                row = Row(*schema.names)(*values)
                try:
                    if row.error is None:
                        send(row.host, row)
                    errors.append(row.error)
                except Exception as error:  # one document's failure is no other's
                    errors.append(f"{type(error).__name__}: {error}"[:1000])
            yield batch.assign(error=errors)

    return documents.mapInPandas(run, schema)


def publish(envelopes: DataFrame, path: str, batch: int = 0, send: Callable[[str, Row], None] | None = None) -> None:
    """Write documents whose application publishes, one folder per host.

    A batch has a folder of its own and replaces it when it is published again, so
    nothing doubles. The rebalance gathers a host's documents into few files, and
    splits a host that is too large for one task.

    Documents without a host, source, application, kind, key or content are kept apart with the reason, and hold up no others. With ``send`` each
    document is also handed to it, on the executors, with its host; one that fails is kept apart with the error.
    """
    chosen = envelopes.where(F.col("sink") == "publish").withColumn("error", _fault())
    if send is not None:
        chosen = cut_lineage(_sent(chosen, send))  # sent once, though two tables are written
    good = chosen.where(F.col("error").isNull()).drop("error").hint("rebalance", "host")
    good.write.partitionBy("host").mode("overwrite").parquet(f"{path}/batch={batch}")
    bad = chosen.where(F.col("error").isNotNull())
    bad.write.mode("overwrite").parquet(f"{_failed_path(path)}/batch={batch}")


def publish_each(path: str, send: Callable[[str, Row], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that publishes a stream of documents."""
    return lambda batch, number: publish(batch, path, number, send)


def _newest(documents: DataFrame) -> DataFrame:
    """Of documents of several batches with one key, the one of the newest batch."""
    others = [c for c in documents.columns if c not in (*DOCUMENT, "batch")]
    newest = F.max_by(F.struct("batch", *others), "batch").alias("newest")
    return documents.groupBy(*DOCUMENT).agg(newest).select(*DOCUMENT, "newest.*").select(*documents.columns)


def _batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch bigint, host string").parquet(path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """All published documents; one that several batches have published is read once, as the newest has it.

    Documents are told apart by host, source, application, kind and key.
    """
    return _newest(_batches(spark, path, PUBLISHED))


def read_failed(spark: SparkSession, path: str) -> DataFrame:
    """Documents that were kept apart, with the ``error`` of their newest batch, unless they were published in it or later.

    They have the columns of envelopes, so :func:`publish` takes them again.
    """
    failed = spark.read.schema(f"host string, {PUBLISHED}, {FAILED}, batch bigint").parquet(_failed_path(path))
    done = _batches(spark, path, PUBLISHED).groupBy(*DOCUMENT).agg(F.max("batch").alias("done"))
    renamed = done.select(*[F.col(name).alias(f"_{name}") for name in DOCUMENT], "done")
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in DOCUMENT]
    return _newest(failed).join(renamed, [*same, F.col("done") >= F.col("batch")], "left_anti")


def to_json_lines(envelopes: DataFrame) -> DataFrame:
    """Documents of the applications that only log, one JSON text per row."""
    logged = envelopes.where(F.col("sink") == "log")
    return logged.select(F.to_json(F.struct("source_name", "kind", "key", "items")).alias("value"))
