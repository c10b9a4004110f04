"""What the operators share: their input, folds, sampled labels, and Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# So many rows reach a Python worker at once: with usual texts a few MB.
BATCH_ROWS = 1000

BatchMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, since texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` and the columns named, whatever else ``docs`` has; NULL text is empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def fold(doc_id: Column | str, folds: int) -> Column:
    """The fold of a document; NULL counts as the empty string."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(folds))


def narrow(numbers: np.ndarray) -> bytes:
    """Numbers that aren't negative, in as many bytes each as the largest needs; the first byte tells how many."""
    most = int(numbers.max()) if len(numbers) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def wide(raw: bytes, kind: type = np.int64) -> np.ndarray:
    """The numbers of :func:`narrow`."""
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(kind)


def map_arrow(df: DataFrame, function: BatchMap, schema: StructType | str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def beside(rows: DataFrame, added: str, *without: str) -> StructType:
    """The schema of ``rows`` without some columns, and the columns ``added``."""
    kept = [f for f in rows.schema.fields if f.name not in without]
    return StructType([*kept, *StructType.fromDDL(added).fields])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` documents with a label, chosen by a hash of their id.

    One label for each id: the smallest, where it has several. NULL
    labels and ids count as none. One row for each id: of several, the one whose text has the smallest
    hash. It is aggregated before the shuffle, so an id may have any number of rows.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
