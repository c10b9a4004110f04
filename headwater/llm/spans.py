"""Substring deduplication by sliding spans of sentences.

A sentence ends at a line break or after a word that ends in ``.``, ``!`` or ``?``. Text may have no
punctuation, and passages may begin and end inside a sentence, so sentences are cut further by their content alone: after each word
whose hash is not greater than both of its neighbours', which is two words of three. So equal passages are cut alike wherever they
stand, but for a word or two at their ends. At each of these short sentences begins a span: the shortest run of at least
three of them and 20 words; the last span of a text goes on to its end. Of all spans with equal words in all documents, the first stays, by
``doc_id`` (NULL last), a hash of the text, and place. The sentences that any others
cover are removed, with the white space after them.

SPAN_WORDS decides what counts as a repeated passage: common lines of up to 19 words stay, as do texts that are shorter.

A task takes its texts in batches. It settles the repeats inside a batch, and sends each distinct span of the batch once to the
shard of its hash, with the first of its places and the keys of the texts that the shard needs; so a passage that very many documents share is one entry a batch. A
shard finds the first place of each span among the batches and marks the others, and the marks of a batch
are dealt back to its documents. There is a shard for every SHARD_BYTES of text, so none grows with the input.

NULL and empty texts stay as they are (NULL as empty). Rows with equal
``doc_id`` and text count as one document and are treated alike; texts are told apart
by 64-bit hashes. Ids are integers or NULL. Columns other than
``doc_id`` and ``text`` are ignored, or kept where rows are returned whole. The input is read several times, and should be stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.frames import beside, map_arrow, narrow, wide
from headwater.session import cut_lineage

SPAN_SENTENCES = 3
SPAN_WORDS = 20
BATCH_WORDS = 500_000
SHARD_BYTES = 8 << 20
ID_BUCKETS = 1 << 18
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_BASE = np.uint64(0xF1357AEA2E62A9C5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
HEAD, SPANS, MARKS = range(3)  # kinds of messages
_LOW = np.uint64(48)  # the bits of a hash behind the first 16


@dataclass
class Sentences:
    """The sentences of a block of texts: their first words, the bytes where they begin, and each text's first."""

    word: np.ndarray  # of each sentence, and the number of words at the end
    begin: np.ndarray
    first: np.ndarray


def find_sentences(data: np.ndarray, offsets: np.ndarray, words: W.Words, hashes: np.ndarray) -> Sentences:
    n = len(words)
    if not n:
        empty = np.empty(0, np.int64)
        return Sentences(np.zeros(1, np.int64), empty, np.zeros(len(offsets), np.int64))
    lines = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int64)])
    last = np.append(words.text[1:] != words.text[:-1], True)  # of a text
    over_next = np.append(hashes[:-1] > hashes[1:], True) | last
    over_previous = np.append(True, hashes[1:] >= hashes[:-1])
    over_previous[1:] |= last[:-1]
    ends = _STOP[data[words.ends - 1]] | last | ~(over_next & over_previous)
    ends[:-1] |= lines[words.starts[1:]] > lines[words.ends[:-1]]
    word = np.flatnonzero(np.append(True, ends[:-1]))
    return Sentences(np.append(word, n), words.starts[word], np.searchsorted(word, words.first))


def find_spans(sentences: Sentences, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first sentence of each span, the one after its last, and a hash of its words."""
    n = len(sentences.begin)
    at = np.arange(n)
    text = np.repeat(np.arange(len(sentences.first) - 1), np.diff(sentences.first))
    enough = np.searchsorted(sentences.word, sentences.word[:-1] + SPAN_WORDS)
    end = np.maximum(at + SPAN_SENTENCES, enough)
    whole = end <= sentences.first[text + 1] if n else np.empty(0, bool)
    at, end, text = at[whole], end[whole], text[whole]
    last = np.append(text[1:] != text[:-1], True)[: len(text)]
    end[last] = sentences.first[text[last] + 1]
    ones = np.full(len(hashes), _BASE)
    ones[:1] = 1
    power = np.multiply.accumulate(ones)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power, dtype=np.uint64)])
    ones[1:] = _INVERSE
    back = np.multiply.accumulate(ones)
    a, b = sentences.word[at], sentences.word[end]
    return at, end, W.mix((total[b] - total[a]) * back[a] + (b - a).astype(np.uint64))


def covered(sentences: Sentences, at: np.ndarray, end: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which sentences belong to the spans that begin at the sentences ``listed``; ``at`` and ``end`` are all spans."""
    out = np.zeros(len(sentences.begin) + 1, np.int64)
    np.add.at(out, listed, 1)
    np.subtract.at(out, end[np.searchsorted(at, listed)], 1)
    return np.cumsum(out)[:-1] > 0


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Sentences, np.ndarray]]:
    data, offsets = W.column_bytes(batch.column("text"))
    for first, last in W.blocks(offsets):
        lo = offsets[first]
        own, places = data[lo : offsets[last]], offsets[first : last + 1] - lo
        words = W.find_words(own, places)
        hashes = W.hash_words(own, words)
        yield first, last, own, places, find_sentences(own, places, words, hashes), hashes


def _shared_ids(docs: DataFrame) -> DataFrame:
    """``bucket`` of the ids that several rows have; at most ID_BUCKETS, so that every task can hold them."""
    several = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return cut_lineage(several.select(_bucket(F.col("doc_id")).alias("bucket")).distinct())


def _bucket(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(ID_BUCKETS)).cast("int")


def _named(rows: DataFrame, doc_id: str, shared: DataFrame) -> DataFrame:
    """``rows`` with ``text_hash``, which tells rows of one id apart.

    It has all 64 bits where the id is NULL or may not be unique, and is 0, which
    takes little room in a shuffle, where the id alone names the row.
    """
    marked = shared.select("bucket", F.lit(True).alias("_several"))
    joined = rows.withColumn("bucket", _bucket(F.col(doc_id))).join(F.broadcast(marked), "bucket", "left")
    needed = F.col(doc_id).isNull() | F.col("_several").isNotNull()
    text_hash = F.when(needed, F.xxhash64("text")).otherwise(F.lit(0).cast("bigint"))
    return joined.withColumn("text_hash", text_hash).drop("bucket", "_several")


_MESSAGE = (
    "kind int, target bigint, batch bigint, no_id binary, ids binary, text_hashes binary, ranks binary, "
    "sentences binary, texts binary, tops binary, spans binary"
)
_NAMES = [x.split()[0] for x in _MESSAGE.split(", ")]


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 8]
    packed = [[x.tobytes() if isinstance(x, np.ndarray) else x for x in row] + [None] * (len(types) - len(row)) for row in rows]
    return pa.RecordBatch.from_arrays([pa.array([row[k] for row in packed], t) for k, t in enumerate(types)], _NAMES)


def _tops(spans: np.ndarray) -> bytes:
    """Of ascending hashes, how many have each number in their first 16 bits, and the least such number."""
    top = (spans >> _LOW).astype(np.int64)
    return int(top[0]).to_bytes(2, "little") + narrow(np.bincount(top - top[0]))


def _whole(tops: bytes, low: bytes) -> np.ndarray:
    """The hashes of :func:`_tops`, from it and their other 48 bits."""
    counts = wide(tops[2:])
    out = np.zeros((len(low) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(low, np.uint8).reshape(-1, 6)
    top = np.repeat(np.arange(len(counts)) + int.from_bytes(tops[:2], "little"), counts)
    return out.view("<u8").reshape(-1) | (top.astype(np.uint64) << _LOW)


def _ascending(numbers: np.ndarray) -> bytes:
    """The first number and the steps from each to the next, which are small where numbers are dense; they may wrap around."""
    numbers = numbers.astype(np.int64).view(np.uint64)
    return numbers[:1].tobytes() + narrow(numbers[1:] - numbers[:-1])


def _climbed(raw: bytes) -> np.ndarray:
    """The numbers of :func:`_ascending`."""
    return np.cumsum(np.append(np.frombuffer(raw, np.uint64, 1), wide(raw[8:], np.uint64)), dtype=np.uint64).view(np.int64)


class _Batch:
    """The spans of some texts, until they are sent."""

    def __init__(self) -> None:
        self.keys: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = self.words = 0

    def sent(self, name: int, shards: int) -> pa.RecordBatch:
        no_id, ids, text_hashes = (np.concatenate(x) for x in zip(*self.keys))
        spans, row, sentence = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((text_hashes, ids, no_id))
        new = np.ones(len(order), bool)
        for key in (no_id[order], ids[order], text_hashes[order]):
            new[1:] &= key[1:] == key[:-1]
        new[1:] = ~new[1:]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new) - 1
        heads = [x[order][new] for x in (no_id, ids, text_hashes)]
        rank = rank[row]
        order = np.lexsort((sentence, rank, spans))
        spans, rank, sentence = spans[order], rank[order].astype(np.uint32), sentence[order].astype(np.uint32)
        other_span = np.append(True, spans[1:] != spans[:-1])[: len(spans)]
        other_place = other_span | np.append(True, (rank[1:] != rank[:-1]) | (sentence[1:] != sentence[:-1]))[: len(spans)]
        later = other_place & ~other_span  # equal rows have equal places
        out = [(HEAD, name % shards, name, *heads, rank[later], sentence[later])]
        spans, rank, sentence = spans[other_span], rank[other_span].astype(np.int64), sentence[other_span]
        # ranges of hashes, so those of a shard come one after another and begin alike
        shard = (((spans >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
        ends = np.searchsorted(shard, np.arange(shards + 1))
        low = np.ascontiguousarray(spans.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
        # a shard gets the keys of the texts alone that it has spans of
        n = len(heads[0])
        named, at = np.unique(shard * n + rank, return_inverse=True)
        first = np.searchsorted(named, np.arange(shards + 1) * n)
        at, named = at.reshape(-1) - first[shard], named % max(n, 1)
        for k in np.flatnonzero(np.diff(ends)):
            own = slice(ends[k], ends[k + 1])
            texts = named[first[k] : first[k + 1]]
            no_id, ids, text_hashes = (x[texts] for x in heads)
            keys = narrow(no_id.view(np.uint8)), _ascending(ids), narrow(text_hashes.view(np.uint64))
            out.append((SPANS, int(k), name, *keys, narrow(at[own]), narrow(sentence[own]), _ascending(texts), _tops(spans[own]), low[own]))
        return _messages(out)


def _span_rows(shards: int, batch_words: int):
    """Each batch's documents, with what repeats inside the batch; and its distinct spans, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, _Batch()
        for batch in batches:
            ids = batch.column("doc_id")
            keys = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0)), np.asarray(batch.column("text_hash"))
            for first, last, _, _, sentences, hashes in _blocks(batch):
                at, _, span = find_spans(sentences, hashes)
                text = np.searchsorted(sentences.first, at, "right") - 1
                held.keys.append(tuple(x[first:last] for x in keys))
                held.parts.append((span, held.rows + text, at - sentences.first[text]))
                held.rows += last - first
                held.words += len(hashes)
                if held.words >= batch_words:
                    yield held.sent(number, shards)
                    number, held = number + 1, _Batch()
        if held.rows:
            yield held.sent(number, shards)

    return run


def _joined(rows: list[dict], name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(row[name], kind) for row in rows])


def _mark(table: pa.Table) -> pa.Table:
    """Of each span of a shard, all places but the first one; what the batches say of themselves passes."""
    rows = table.to_pylist()
    out = [tuple(row[name] for name in _NAMES) for row in rows if row["kind"] == HEAD]
    rows = [row for row in rows if row["kind"] == SPANS]
    if rows:
        spans = np.concatenate([_whole(row["tops"], row["spans"]) for row in rows])
        at, sentence = (np.concatenate([wide(row[name], np.uint32) for row in rows]) for name in ("ranks", "sentences"))
        texts = [_climbed(row["texts"]) for row in rows]
        owner = np.repeat(np.arange(len(rows)), [len(row["spans"]) // 6 for row in rows])
        order = np.argsort(spans, kind="stable")
        ordered = spans[order]
        same = ordered[1:] == ordered[:-1]
        several = order[np.append(same, False) | np.append(False, same)]
        spans, at, sentence, owner = spans[several], at[several], sentence[several], owner[several]
        place = np.cumsum([0] + [len(x) for x in texts])[:-1][owner] + at
        rank = np.concatenate(texts)[place].astype(np.uint32)
        no_id, text_hashes = (np.concatenate([wide(row[name], np.uint64) for row in rows])[place] for name in ("no_id", "text_hashes"))
        keys = [no_id, np.concatenate([_climbed(row["ids"]) for row in rows])[place], text_hashes.view(np.int64)]
        order = np.lexsort((sentence, keys[2], keys[1], keys[0], spans))
        begin = np.append(True, spans[order][1:] != spans[order][:-1])[: len(order)]
        first = order[np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))]
        later = np.zeros(len(order), bool)
        for key in (*keys, sentence):
            later |= key[order] != key[first]
        chosen = order[later]
        chosen = chosen[np.argsort(owner[chosen], kind="stable")]
        ends = np.searchsorted(owner[chosen], np.arange(len(rows) + 1))
        for k in np.flatnonzero(np.diff(ends)):
            own = chosen[ends[k] : ends[k + 1]]
            out.append((MARKS, None, rows[k]["batch"], None, None, None, rank[own], sentence[own]))
    return pa.Table.from_batches([_messages(out)])


def _deal(table: pa.Table) -> pa.Table:
    """The marked sentences of each document of a batch, ascending."""
    rows = table.to_pylist()
    head = next(row for row in rows if row["kind"] == HEAD)
    rank, sentence = (_joined(rows, name, np.uint32).astype(np.int64) for name in ("ranks", "sentences"))
    cuts = np.unique(np.stack([rank, sentence], axis=1), axis=0)
    with_cuts, begins = np.unique(cuts[:, 0], return_index=True)
    no_id = np.frombuffer(head["no_id"], bool)[with_cuts]
    lists = pa.ListArray.from_arrays(
        pa.array(np.append(begins, len(cuts)).astype(np.int32)), pa.array(cuts[:, 1].astype(np.int32))
    )
    return pa.table(
        {
            "doc_id": pa.array(np.frombuffer(head["ids"], np.int64)[with_cuts], mask=no_id),
            "text_hash": pa.array(np.frombuffer(head["text_hashes"], np.int64)[with_cuts]),
            "cuts": lists,
        }
    )


def repeated(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """``doc_id, text_hash, cuts``: the first sentences of all spans that an earlier span equals, a sorted list for each document."""
    text = F.coalesce("text", F.lit(""))
    rows = _named(docs.select(F.col("doc_id").cast("bigint"), text.alias("text")), "doc_id", shared)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    shards = max(-(-(n_bytes or 0) // SHARD_BYTES), 1)
    sent = map_arrow(rows, _span_rows(shards, BATCH_WORDS), _MESSAGE)
    marks = sent.groupBy("target").applyInArrow(_mark, _MESSAGE)
    dealt = marks.groupBy("batch").applyInArrow(_deal, "doc_id bigint, text_hash bigint, cuts array<int>")
    # equal rows may lie in several batches, which mark the same: all places of a span but the first
    lists = dealt.groupBy("doc_id", "text_hash").agg(F.first("cuts").alias("cuts"))
    return cut_lineage(lists)  # so that the messages are gone before texts are shuffled


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the sentences that the listed spans cover."""
    for batch in batches:
        cuts = batch.column("cuts")
        rest = [i for i, name in enumerate(batch.schema.names) if name not in ("text", "cuts")]
        for first, last, data, offsets, sentences, hashes in _blocks(batch):
            listed = cuts.slice(first, last - first)
            values = np.asarray(listed.flatten(), np.int64)
            sizes = np.asarray(listed.value_lengths().fill_null(0), np.int64)
            at, end, _ = find_spans(sentences, hashes)
            removed = covered(sentences, at, end, np.repeat(sentences.first[:-1], sizes) + values)
            stops = np.append(sentences.begin[1:], len(data))
            last_of_text = sentences.first[1:][np.diff(sentences.first) > 0] - 1
            stops[last_of_text] = offsets[1:][np.diff(sentences.first) > 0]
            raw = data.tobytes()
            out = []
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if not sizes[k]:
                    out.append(raw[a:b].decode())
                    continue
                parts, kept_from = [], a
                for s in range(sentences.first[k], sentences.first[k + 1]):
                    if removed[s]:
                        parts.append(raw[kept_from : max(kept_from, sentences.begin[s])])
                        kept_from = stops[s]
                parts.append(raw[kept_from:b])
                out.append(b"".join(parts).decode())
            total = np.concatenate([[0], np.cumsum(removed)])
            columns = [batch.column(i).slice(first, last - first) for i in rest]
            columns += [pa.array(out, pa.string()), pa.array(np.diff(sentences.first))]
            columns.append(pa.array(total[sentences.first[1:]] - total[sentences.first[:-1]]))
            names = [batch.schema.names[i] for i in rest] + ["text", "n_sentences", "n_removed"]
            yield pa.RecordBatch.from_arrays(columns, names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Each document's row in ``row``, its ``text`` without repeats, ``n_sentences`` and ``n_removed``."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    shared = _shared_ids(docs)
    keyed = _named(docs.select(F.struct(*rest).alias("row"), text.alias("text")), "row.doc_id", shared)
    lists = repeated(docs, shared).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("cuts")
    )
    same = F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = keyed.join(lists, same, "left").select("row", "text", "cuts")
    return map_arrow(joined, _cut, beside(joined, "text string, n_sentences bigint, n_removed bigint", "text", "cuts"))


def cleaned_rows(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, repeats removed; those that lose all their words go."""
    found = remove_repeats(docs).where((F.col("n_removed") < F.col("n_sentences")) | (F.col("n_sentences") == 0))
    return found.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
