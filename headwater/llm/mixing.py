"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, up to three times over.
A copy's virtual finish time is the source's words up to and including it, divided
by the source's target. All copies are sorted by finish time, whatever their
source, and taken until the total budget, the words of all documents, is reached.

Targets share the budget by the weights 5, 2, 1, repeating over the sources by
code point, NULL last; a target stops at three times its source's words and the
rest is shared anew by weight. The shuffle is the order of the ids' MD5, so reruns
agree. A NULL text has no words. Repeated rows are documents of their own. Columns
other than ``doc_id``, ``text`` and ``source`` are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headwater.llm.order import running_total

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SPACES = " \t\n\x0b\x0c\r"


def n_words(text: Column | str) -> Column:
    """The number of words, 0 for NULL."""
    marks = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), SPACES, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The target of each of ``sources`` (``source, source_size``).

    A source whose target stops at its cap does so once the level, words per
    weight, reaches cap / weight. With the sources in the order of that level, the
    level of all others is what the caps before leave, by the weights that remain;
    the final level is the lowest of these.
    """
    named = sources.withColumns({"_null": F.col("source").isNull(), "_one": F.lit(1)})
    ranked = running_total(named, [], ["_null", "source"], "_one", "_rank")
    kinds = F.array(*[F.lit(w) for w in weights])
    weighed = (
        ranked.withColumn("weight", F.element_at(kinds, (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * most)
        .withColumn("_full_at", F.col("_cap") / F.col("weight"))
        .drop("_place")
    )
    capped = running_total(weighed, [], ["_full_at", "_rank"], "_cap", "_caps").drop("_place")
    leveled = running_total(capped, [], ["_full_at", "_rank"], "weight", "_weights")
    whole = leveled.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weights")).first()
    level = (F.lit(whole.total) - (F.col("_caps") - F.col("_cap"))) / (
        F.lit(whole.weights) - (F.col("_weights") - F.col("weight"))
    )
    # the first source that its level doesn't fill settles the level of all that follow
    leveled = leveled.withColumn("_level", level)
    first = leveled.where(F.col("_level") <= F.col("_full_at")).agg(F.min(F.struct("_place", "_level")).alias("first")).first()
    final = F.lit(first.first["_level"] if first.first else 0.0)
    target = F.least(F.col("_cap").cast("double"), F.col("weight") * final)
    return leveled.select(
        "source", "source_size", "weight", target.alias("target"), F.lit(whole.total or 0).cast("bigint").alias("budget")
    )


def mix(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The copies that the mix takes of each row of ``sizes`` (``doc_id, source, size`` and keys of the caller).

    Adds ``source_size``, ``target``, ``copies`` and ``taken`` (words).
    """
    keys = sizes.columns
    shuffled = sizes.withColumn("_shuffle", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    queue = running_total(shuffled, ["source"], ["_shuffle", "doc_id"], "size", "_upto", place="_row")
    totals = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    # the targets are as many as sources: Spark broadcasts them if they are small
    totals = totals.withColumnRenamed("source", "_source")
    known = queue.join(totals, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    copies = (
        known.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("_finish", (F.col("_copy") * F.col("source_size") + F.col("_upto")) / F.col("target"))
        .withColumn("_last", F.col("source").isNull())
        .where(F.col("target") > 0)
    )
    order = ["_finish", "_last", "source", "_shuffle", "doc_id", "_copy"]
    narrow = copies.select(*order, "_row", "size", "budget")
    sent = running_total(narrow, [], order, "size", "_sent").where(F.col("_sent") <= F.col("budget"))
    counted = sent.groupBy("_row").agg(F.count(F.lit(1)).alias("copies"))
    return known.join(counted, "_row", "left").select(
        *keys,
        "source_size",
        "target",
        F.coalesce("copies", F.lit(0)).alias("copies"),
        (F.coalesce("copies", F.lit(0)) * F.col("size")).alias("taken"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix of documents, one row for each."""
    return mix(docs.select("doc_id", "source", n_words("text").alias("size")))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The documents of the mix themselves, each as often as it is taken, with all their columns.

    Rows are told apart by two hashes over all columns. Rows that are equal in all
    of them share their copies, however many there are.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(
        F.struct(*columns).alias("_doc"),
        F.xxhash64(*columns).alias("_key"),
        F.xxhash64(F.lit(1), *columns).alias("_check"),
    )
    key = ["_key", "_check"]
    sizes = keyed.select("_doc.doc_id", "_doc.source", n_words("_doc.text").alias("size"), *key)
    taken = mix(sizes).groupBy(*key).agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    same = Window.partitionBy(*key).orderBy(F.lit(1))
    share = F.expr("_copies div _rows") + (F.row_number().over(same) <= F.expr("_copies % _rows")).cast("bigint")
    joined = keyed.join(taken.where("_copies > 0"), key).withColumn("_share", share).where("_share > 0")
    return joined.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_share")))).select("_doc.*")
