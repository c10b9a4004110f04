"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.functions.scalars import let
from headwater.llm import bpe, classifier, counts, fingerprint, language, lm, minhash, mixing, negatives, periodic, rules
from headwater.llm import similar, spans
from headwater.llm.frames import fold, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[function.__name__] = function
    return function


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.similar(table(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return found.select("doc_id", *base, "kept", F.col("rule").alias("rejected_by"))


@query
def op1_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.versions(table(spark, sf_dir, "documents"))
    edited = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    near = ["fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_lost", "n_gained", "n_cells"]
    return found.select("doc_id", "n_chars", edited, *near)


@query
def op2_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), fold("doc_id", 5) == 1)


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op3_source_mix"] = r"""
with docs as (
    select row_number() over () as r, doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as h,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size
    from documents),
sources as (
    select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as rank
    from docs group by source),
weighed as (
    select *, case (rank - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight, source_size * 3 as cap from sources),
sums as (
    select *, cap / weight as full_at, sum(source_size) over () as total, sum(weight) over () as weights,
        sum(cap) over w - cap as caps, sum(weight) over w - weight as used
    from weighed window w as (order by cap / weight, rank)),
levels as (
    select *, cast(total - caps as double) / cast(weights - used as double) as level,
        row_number() over (order by full_at, rank) as nr from sums),
final as (select arg_min(level, nr) as level from levels where level <= full_at),
target as (select source, source_size, cast(total as bigint) as total, least(cast(cap as double), weight * (select level from final)) as target from levels),
queue as (
    select d.*, source_size, target, total,
        cast(sum(size) over (partition by d.source order by h, doc_id, r rows unbounded preceding) as bigint) as upto
    from docs d join target t on d.source is not distinct from t.source),
copies as (
    select *, cast(copy * source_size + upto as double) / target as finish
    from queue, (select unnest([0, 1, 2]) as copy) where target > 0),
sent as (
    select r, size, total,
        sum(size) over (order by finish, source nulls last, h, doc_id, copy, r rows unbounded preceding) as upto
    from copies),
taken as (select r, sum(size) as taken from sent where upto <= total group by r)
select doc_id, cast(size as bigint) as size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken
from queue left join taken using (r)
"""


@query
def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE), BYTE_BPE)
    return decoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 5) == 0
    weights = classifier.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = classifier.score(docs, weights, held_out.alias("held_out"))
    return scored.withColumn("predicted", (F.col("score") >= classifier.THRESHOLD).cast("int"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(table(spark, sf_dir, "documents"), PIECES)


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 4) == 2
    return language.identify(docs, language.fit(docs, ~held_out), held_out.alias("held_out"))


@query
def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_sentences", "n_removed", "text")


@query
def op11_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


ORACLE["op12_hard_negatives"] = """
with vectors as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor(256 * cast(x as double)) for x in embedding] as v
    from embeddings
    where label is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scores as (
    select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same,
        cast(list_inner_product(a.v, r.v) as bigint) as score
    from vectors a join vectors r on a.vec_id <> r.vec_id
    where a.vec_id % 50 = 0),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score
    from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
negatives as (
    select p.anchor_id, positive_id, positive_score, other_id as negative_id, score as negative_score,
        row_number() over (partition by p.anchor_id, positive_id order by score desc, other_id) as rank
    from positives p join scores s on p.anchor_id = s.anchor_id and not s.same
        and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from negatives where rank <= 3
"""


def _with_periods(docs: DataFrame) -> DataFrame:
    """The documents, one in ten of them (by a checksum of its id) with words that repeat periodically from some place on."""
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))

    def repeating(words: Column) -> Column:
        n, g = F.size(words).cast("bigint"), F.floor(checksum / 10)
        start = g % n
        period = F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))
        shape = F.struct(start.alias("start"), period.alias("period"))

        def word(of: Column, i: Column) -> Column:
            back = of["start"] + (i - of["start"]) % of["period"]
            return F.get(words, F.when(i < of["start"], i).otherwise(back).cast("int"))

        every = let(shape, lambda of: F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: word(of, i)))
        return F.when(n > 0, F.array_join(every, " ")).otherwise(F.lit(""))

    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.withColumn("text", F.when(checksum % 10 == 0, let(words, repeating)).otherwise(F.col("text")))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_with_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))

    def longer(best: Column, run: Column) -> Column:
        # the runs come by start, then period, so the first of equal ones stays
        more = best["period"].isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.reduce("runs", none, longer))
    return best.select(
        "row.doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
