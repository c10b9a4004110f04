import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from headwater.llm import spans
from headwater.llm import words as W
from headwater.session import cut_lineage
from tests.llm.conftest import WORDS, key, words_of


def cut(text):
    """Sentences of a text as (first byte, byte after the white space that follows, words)."""
    raw = text.encode()
    data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    found = W.find_words(data, offsets)
    hashes = [int(h) for h in W.hash_words(data, found)]
    out, current = [], []
    for i, (a, b) in enumerate(zip(found.starts, found.ends)):
        current.append((a, raw[a:b]))
        last = i + 1 == len(found)
        after = len(raw) if last else found.starts[i + 1]
        peak = (last or hashes[i] > hashes[i + 1]) and (i == 0 or hashes[i] >= hashes[i - 1])
        if raw[b - 1 : b] in (b".", b"!", b"?") or b"\n" in raw[b:after] or not peak or last:
            out.append((current[0][0], after, [w for _, w in current]))
            current = []
    return out


def spans_of(sentences):
    """The words of the span that begins at each sentence, and the sentence after its last."""
    out = {}
    for i in range(len(sentences)):
        words, k = [], i
        while k < len(sentences) and (k - i < 3 or len(words) < 20):
            words += sentences[k][2]
            k += 1
        if k - i >= 3 and len(words) >= 20:
            out[i] = (tuple(words), k)
    if out:
        last = max(out)
        out[last] = (tuple(w for s in sentences[last:] for w in s[2]), len(sentences))
    return out


def brute(rows):
    """What stays of each document that is told apart by id and text."""
    docs = sorted({(r[0], r[1] or "") for r in rows}, key=lambda d: key(d[:1]))
    where = {}
    cuts = {d: cut(d[1]) for d in docs}
    spans = {d: spans_of(cuts[d]) for d in docs}
    for d in docs:
        for i, (words, _) in spans[d].items():
            where.setdefault(words, []).append((d, i))
    removed = {d: set() for d in docs}
    for places in where.values():
        for d, i in places[1:]:
            removed[d] |= set(range(i, spans[d][i][1]))
    out = {}
    for d in docs:
        raw, kept, at = d[1].encode(), b"", 0
        for s, (a, b, _) in enumerate(cuts[d]):
            if s in removed[d]:
                kept += raw[at:a] if at < a else b""
                at = b
        out[d] = ((kept + raw[at:]).decode(), len(cuts[d]), len(removed[d]))
    return out


@pytest.fixture(params=["one shard", "small batches and shards"])
def sizes(request, monkeypatch):
    """Small batches and shards send what several batches share, and equal rows, to different tasks."""
    if request.param != "one shard":
        monkeypatch.setattr(spans, "SHARD_BYTES", 5000)
        monkeypatch.setattr(spans, "BATCH_WORDS", 50)


def test_repeats_are_removed_as_by_hand(docs, edge_rows, sizes):
    rows = [r for r in edge_rows if r[0] != 7]  # ties of an id are ordered by a hash
    found = spans.remove_repeats(docs.where("doc_id is null or doc_id <> 7"))
    got = sorted(key((r.row.doc_id, r.text, r.n_sentences, r.n_removed)) for r in found.collect())
    out = brute(rows)
    assert got == sorted(key((r[0], *out[r[0], r[1] or ""])) for r in rows)
    assert sum(n for _, _, n in out.values()) > 20


def test_shared_passages_stay_once(docs, edge_rows):
    passage = re.split(r"\n", edge_rows[8][1])[-2]
    assert len(passage.split()) > 50
    found = {r.row.doc_id: r.text for r in spans.remove_repeats(docs).collect()}
    holds = [k for k in (8, 9, 10) if passage in found[k]]
    assert holds == [8]
    for k in (0, 1, 17):  # documents that share no passage
        assert found[k] == edge_rows[k][1]


def test_repeated_rows_are_alike_and_ties_keep_one(spark):
    text = "\n".join(" ".join(f"w{i}{j}" for j in range(9)) + "." for i in range(6))
    rows = [(1, text), (1, text), (2, text), (None, text), (1, text + " more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = Counter((r.row.doc_id, len(words_of(r.text)) > 50) for r in spans.remove_repeats(docs).collect())
    assert found[2, False] == 1 and found[None, False] == 1
    assert (found[1, True], found[1, False]) in ((2, 1), (1, 2))  # the two equal rows are one document


def test_rows_and_no_rows(docs, no_docs):
    found = spans.cleaned_rows(docs)
    assert found.schema == docs.schema
    left = Counter(r.doc_id for r in found.collect())
    assert left[4] == 0, "a copy loses all its words"
    assert left[100] == left[101] == left[12] == 1
    assert spans.remove_repeats(no_docs).collect() == [] and spans.cleaned_rows(no_docs).collect() == []


def test_texts_without_an_id_are_told_apart_by_the_whole_hash(spark):
    """Two texts whose hashes agree in their last 24 bits; only one of them holds a passage that stands elsewhere."""
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(9)) + "." for i in range(6))
    ends = spark.range(12_000).select(F.col("id").cast("string").alias("n"))
    with_passage = ends.select("n", F.concat(F.lit(passage + "\nholds "), "n").alias("text"))
    clean_text = "\n".join(" ".join(f"c{i}{j}" for j in range(9)) + "." for i in range(8))
    without = ends.select("n", F.concat(F.lit(clean_text + "\nclean "), "n").alias("text"))
    low = F.pmod(F.xxhash64("text"), F.lit(1 << 24)).alias("low")
    pair = (
        with_passage.select(F.col("text").alias("one"), low)
        .join(without.select(F.col("text").alias("two"), low), "low")
        .orderBy("one", "two")
        .first()
    )
    rows = [(1, passage + "\nfirst"), (None, pair.one), (None, pair.two), (2, "a b c"), (2, "d e f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [r.text for r in spans.remove_repeats(docs).collect()]
    assert pair.two in found and pair.one not in found


def passages(rng, words, every, n):
    """Pairs of documents with one passage in a line, between unpunctuated text of 5 to 39 words."""
    word = lambda: rng.choice(WORDS) + rng.choice(WORDS) + str(rng.randrange(100))
    rows, planted = [], []
    for k in range(n):
        own = [word() for _ in range(words)]
        if every:
            own = [w + "." if i % every == every - 1 else w for i, w in enumerate(own)]
        planted.append(own)
        for doc_id in (k, 10_000 + k):
            around = [[word() for _ in range(rng.randint(5, 39))] for _ in range(2)]
            rows.append((doc_id, " ".join(around[0] + own + around[1]), len(around[0]) + len(around[1])))
    return rows, planted


@pytest.mark.parametrize("words, every", [(24, 6), (24, 0), (30, 0), (51, 0), (51, 6), (60, 0), (60, 6)])
def test_second_copies_of_passages_go(spark, words, every):
    rows, planted = passages(random.Random(words + every), words, every, 150)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, around int").repartition(3)
    found = {r.row.doc_id: (r.text, r.row.around) for r in spans.remove_repeats(docs).collect()}
    assert all(found[k][0] == text for k, text, _ in rows if k < 10_000), "first copies stay"
    left = [max(len(found[10_000 + k][0].split()) - found[10_000 + k][1], 0) / words for k in range(150)]
    assert np.mean(left) < 0.1 and max(left) < 0.6
    assert np.mean([len(found[10_000 + k][0].split()) >= found[10_000 + k][1] for k in range(150)]) > 0.95


def test_common_lines_stay(spark):
    """Lines of up to 19 words that many documents have are no passages."""
    rng = random.Random(8)
    word = lambda: rng.choice(WORDS) + rng.choice(WORDS) + str(rng.randrange(100))
    common = [" ".join(word() for _ in range(n)) + "." for n in (5, 8, 12, 16, 19)]
    rows = []
    for k in range(200):
        lines = [" ".join(word() for _ in range(rng.randint(5, 25))) + "." for _ in range(6)]
        lines.insert(rng.randrange(1, 6), rng.choice(common))
        rows.append((k, "\n".join(lines)))
    found = {r.row.doc_id: r.text for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert np.mean([found[k] == text for k, text in rows]) > 0.95


def test_a_third_of_all_rows_is_one_row(spark):
    text = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, text)] * 300 + [(k, f"d{k} " * 3 + text) for k in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = Counter((r.row.doc_id, len(r.text.split())) for r in spans.remove_repeats(docs).collect())
    assert found[1, 60] == 300
    assert all(n < 7 for doc_id, n in found if doc_id != 1)


def test_a_batch_sends_each_shard_the_keys_of_its_own_texts_only():
    rng = np.random.default_rng(11)
    batch = spans._Batch()
    n, per = 400, 30
    span = rng.integers(0, 2**64, n * per, dtype=np.uint64)
    batch.keys.append((np.arange(n) == 7, np.arange(n) * 3, np.zeros(n, np.int64)))
    batch.parts.append((span, np.repeat(np.arange(n), per), np.tile(np.arange(per), n)))
    few, many = (batch.sent(0, shards).nbytes for shards in (10, 1000))
    assert many < 2 * few  # the keys of all texts to each shard would be 18 times as much
    sent = batch.sent(0, 1000).to_pylist()[1:]
    assert np.concatenate([spans._whole(row["tops"], row["spans"]) for row in sent]).tolist() == np.sort(span).tolist()
    owner = dict(zip(span.tolist(), np.repeat(np.arange(n) * 3, per).tolist()))
    owner.update((int(s), 21) for s in span[7 * per : 8 * per])
    for row in sent:
        ids = spans._climbed(row["ids"])[spans.wide(row["ranks"])]
        assert ids.tolist() == [owner[int(s)] for s in spans._whole(row["tops"], row["spans"])]


def test_a_cut_leaves_no_shuffle_files(spark):
    before = set(_shuffles(spark))
    stored = cut_lineage(spark.range(1000).groupBy(F.col("id") % 10).count())
    assert not set(_shuffles(spark)) - before
    assert stored.agg(F.sum("count")).first()[0] == 1000


def _shuffles(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return [name for name in (blocks.apply(k).getName() for k in range(blocks.size())) if name.startswith("shuffle_")]
