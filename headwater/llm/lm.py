"""Language-model scoring: a bigram model in Elias-Fano tries, one for each shard of its contexts.

Tokens are words, A to Z lower-cased, and one end for each text; a text's first
token follows a start mark. The model is absolute discounting: after a context h
with c(h) tokens and n(h) kinds of successors,

    p(w | h) = max(c(h w) - D, 0) / c(h) + D n(h) / c(h) * p(w)

with p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)) as the base model has it. Frequent words
are the end and those with at least N / 2**20 tokens, at most 2**20, and every task
knows their counts; this saves messages only and changes no probability. Log
probabilities of successors are kept in 16 bits, for rarer words those of the first
summand.

No task holds the whole model, nor all texts. A task cuts its texts into batches
and sends each distinct pair of a batch once to the shard of its context, with its
number of occurrences and the batch's texts that it is in; a frequent word is named by its place among those. There is a shard for every SHARD_BYTES bytes
of text, so a shard's part of the corpus, about a million tokens, stays the same, and one of word counts for HOME_SHARDS of those. It adds up the counts,
builds its trie, answers the pairs of each batch from it, and returns sums for each
text. A context that is frequent enough to fill a shard is split by its successors'
hashes; its n(h) is summed over those shards in a pass of its own. Pairs with a rare second word ask its
shard for its count, and send along the first summand as a multiple of D n(h) / c(h).

Words are told apart by 64-bit hashes; as successors they travel with 48 bits, and those of one context are told apart by 40.
The two marks are the same successor then, but only the end is one. NULL and
empty texts are one end token. Repeated rows are texts of their own. Without
training texts every token has probability 1. Columns other than ``doc_id`` and
``text`` are ignored; ids are integers or NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.frames import map_arrow, narrow, wide
from headwater.llm.trie import Trie
from headwater.session import cut_lineage

DISCOUNT = 0.75
FREQUENT = 1 << 20
BATCH_TOKENS = 700_000
SHARD_BYTES = 4 << 20
HOME_SHARDS = 4  # so many shards ask one shard of word counts
START, END = np.uint64(1), np.uint64(2)
_SPLIT = np.uint64(0x9E3779B97F4A7C15)
SUMS, TEXTS, ASKED, COUNTS = range(4)  # kinds of messages


@dataclass
class Batch:
    """The tokens of some texts, each with the one before it."""

    before: np.ndarray
    token: np.ndarray
    text: np.ndarray
    ids: list[int | None]
    train: np.ndarray
    n_tokens: np.ndarray


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    """Texts in batches of about BATCH_TOKENS tokens; a longer text is a batch of its own."""
    parts: list[tuple[np.ndarray, ...]] = []
    ids: list[int | None] = []
    size = 0
    for batch in batches:
        data, offsets = W.column_bytes(batch.column("text"))
        own_ids = batch.column("doc_id").to_pylist()
        train = np.asarray(batch.column("train"))
        for first, last in W.blocks(offsets):
            lo = offsets[first]
            block, places = data[lo : offsets[last]], offsets[first : last + 1] - lo
            words = W.find_words(block, places)
            ends = words.first[1:]
            token = np.insert(W.hash_words(block, words, lower=True), ends, END)
            text = np.insert(words.text, ends, np.arange(last - first))
            before = np.concatenate([[START], token[:-1]])
            before[np.concatenate([[True], text[1:] != text[:-1]])] = START
            parts.append((before, token, text + len(ids), train[first:last], np.diff(words.first) + 1))
            ids.extend(own_ids[first:last])
            size += len(token)
            if size >= BATCH_TOKENS:
                yield Batch(*(np.concatenate(x) for x in list(zip(*parts))[:3]), ids, *(np.concatenate(x) for x in list(zip(*parts))[3:]))
                parts, ids, size = [], [], 0
    if parts:
        yield Batch(*(np.concatenate(x) for x in list(zip(*parts))[:3]), ids, *(np.concatenate(x) for x in list(zip(*parts))[3:]))


def _slices(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The rows of each shard, of rows sorted by shard."""
    begins = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.empty(0, np.int64)
    for a, b in zip(begins, np.append(begins[1:], len(shard))):
        yield int(shard[a]), slice(a, b)


def _short(words: np.ndarray) -> np.ndarray:
    """The 48 bits of a hash that successors travel with."""
    return words >> np.uint64(16)


def _pack(words: np.ndarray) -> np.ndarray:
    """Hashes as six bytes each."""
    return np.ascontiguousarray(_short(words).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _home(words: np.ndarray, shards: int) -> np.ndarray:
    return (W.mix(_short(words) + _SPLIT) % np.uint64(shards)).astype(np.int64)


def _homes(shards: int) -> int:
    return -(-shards // HOME_SHARDS)


# --- Counts of words ----------------------------------------------------------


def _word_rows(homes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _read(batches):
            tokens = batch.token[batch.train[batch.text]]
            starts = np.full(int(batch.train.sum()), START)
            words, counts = np.unique(np.concatenate([tokens, starts]), return_counts=True)
            home = _home(words, homes)
            order = np.argsort(home, kind="stable")
            rows = [
                (shard, words[order[part]].tobytes(), narrow(counts[order[part]])) for shard, part in _slices(home[order])
            ]
            columns = [pa.array([x[0] for x in rows], pa.int64())]
            columns += [pa.array([x[k] for x in rows], pa.binary()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "words", "counts"])

    return run


def _joined(table: pa.Table, name: str, dtype: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, dtype) for x in table.column(name).to_pylist()])


def _add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, inverse, counts)
    return distinct, total


def _sum_words(table: pa.Table) -> pa.Table:
    sent = np.concatenate([wide(x) for x in table.column("counts").to_pylist()])
    words, counts = _add_up(_joined(table, "words", np.uint64), sent)
    tokens = words != START
    return pa.table(
        {
            "shard": table.column("shard").slice(0, 1),
            "words": pa.array([words.tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
            "n_tokens": pa.array([int(counts[tokens].sum())], pa.int64()),
            "n_words": pa.array([int(tokens.sum())], pa.int64()),
        }
    )


@dataclass(frozen=True)
class Unigrams:
    """What every task knows of the words: totals, and the frequent ones with their counts."""

    n_tokens: int
    n_words: int
    shards: int
    frequent: np.ndarray
    counts: np.ndarray
    # the contexts over several shards, at most as many as shards, and their n(h)
    split: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    kinds: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @property
    def homes(self) -> int:
        """How many shards the counts of words have."""
        return _homes(self.shards)

    def log_whole(self) -> float:
        return float(np.log10(self.n_tokens + 0.5 * (self.n_words + 1)))

    def find(self, words: np.ndarray, short: bool = False) -> np.ndarray:
        """The counts of frequent words, -1 for others; successors are known by the ``short`` part of their hashes."""
        if not len(self.frequent):
            return np.full(len(words), -1, np.int64)
        frequent, words = (_short(self.frequent), _short(words)) if short else (self.frequent, words)
        at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
        return np.where(frequent[at] == words, self.counts[at], -1)

    def places(self, words: np.ndarray) -> np.ndarray:
        """The places of words among the frequent ones, -1 for others."""
        if not len(self.frequent):
            return np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
        return np.where(self.frequent[at] == words, at, -1)

    def splits(self, words: np.ndarray) -> np.ndarray:
        """Over how many shards the pairs of a context are spread."""
        counts = np.maximum(self.find(words), 0)
        return np.maximum(-(-counts * self.shards // max(self.n_tokens, 1)), 1)

    def home(self, before: np.ndarray, token: np.ndarray, splits: np.ndarray | None = None) -> np.ndarray:
        """The shard of each pair."""
        split = W.mix(token) % (self.splits(before) if splits is None else splits).astype(np.uint64)
        return (W.mix(before + (split + np.uint64(1)) * _SPLIT) % np.uint64(self.shards)).astype(np.int64)

    def whole_kinds(self, contexts: np.ndarray, own: np.ndarray) -> np.ndarray:
        """n(h) of contexts with ``own`` kinds in one shard."""
        if not len(self.split):
            return own
        at = np.minimum(np.searchsorted(self.split, contexts), len(self.split) - 1)
        return np.where(self.split[at] == contexts, self.kinds[at], own)


def count_words(rows: DataFrame, shards: int) -> tuple[DataFrame, Unigrams]:
    """The counts of all training words, stored by home, and what tasks need of them."""
    sent = map_arrow(rows, _word_rows(_homes(shards)), "shard bigint, words binary, counts binary")
    stored = cut_lineage(
        sent.groupBy("shard").applyInArrow(
            _sum_words, "shard bigint, words binary, counts binary, n_tokens bigint, n_words bigint"
        )
    )
    total = stored.agg(F.sum("n_tokens").alias("n"), F.sum("n_words").alias("v")).first()
    n, v = total.n or 0, total.v or 0

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = (_joined(pa.Table.from_batches([batch]), x, t) for x, t in (("words", np.uint64), ("counts", np.int64)))
            often = (counts * FREQUENT >= n) | (words <= END)
            columns = [pa.array(words[often].view(np.int64)), pa.array(counts[often])]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    # at most FREQUENT words, and the two marks
    often = map_arrow(stored.select("words", "counts"), pick, "word bigint, n bigint").toPandas()
    words, counts = often["word"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64)
    order = np.argsort(words)
    return stored, Unigrams(n, v, shards, words[order], counts[order])


# --- Kinds of successors of split contexts ------------------------------------


def _split_rows(unigrams: Unigrams):
    """Each batch's distinct training pairs of split contexts, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _read(batches):
            pick = batch.train[batch.text].astype(bool) & (unigrams.splits(batch.before) > 1)
            before, token = batch.before[pick], batch.token[pick]
            shard = unigrams.home(before, token)
            order = np.lexsort((token, before, shard))
            shard, before, token = shard[order], before[order], token[order]
            new = np.ones(len(token), bool)  # a pair has one shard
            new[1:] = (before[1:] != before[:-1]) | (token[1:] != token[:-1])
            shard, before, token = shard[new], before[new], token[new]
            rows = [(own, before[part].tobytes(), token[part].tobytes()) for own, part in _slices(shard)]
            columns = [pa.array([x[0] for x in rows], pa.int64())]
            columns += [pa.array([x[k] for x in rows], pa.binary()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "contexts", "successors"])

    return run


def _count_kinds(table: pa.Table) -> pa.Table:
    """How many successors each split context has in one shard."""
    contexts, successors = (_joined(table, x, np.uint64) for x in ("contexts", "successors"))
    order = np.lexsort((successors, contexts))
    contexts, successors = contexts[order], successors[order]
    new = np.ones(len(contexts), bool)
    new[1:] = (contexts[1:] != contexts[:-1]) | (successors[1:] != successors[:-1])
    own, kinds = np.unique(contexts[new], return_counts=True)
    return pa.table({"context": pa.array(own.view(np.int64)), "kinds": pa.array(kinds.astype(np.int64))})


def count_kinds(rows: DataFrame, unigrams: Unigrams) -> Unigrams:
    """``unigrams`` with n(h) of the contexts that are split, of which there are at most as many as shards."""
    if not (unigrams.splits(unigrams.frequent) > 1).any():
        return unigrams
    sent = map_arrow(rows, _split_rows(unigrams), "shard bigint, contexts binary, successors binary")
    counted = sent.groupBy("shard").applyInArrow(_count_kinds, "context bigint, kinds bigint")
    found = counted.groupBy("context").agg(F.sum("kinds").alias("kinds")).toPandas()
    split, kinds = found["context"].to_numpy(np.int64).view(np.uint64), found["kinds"].to_numpy(np.int64)
    order = np.argsort(split)
    return replace(unigrams, split=split[order], kinds=kinds[order])


# --- Pairs --------------------------------------------------------------------

_PAIR_ROWS = (
    "shard bigint, batch bigint, n_train bigint, contexts binary, degrees binary, successors binary, "
    "occurrences binary, texts binary, ids binary, id_null binary, held_out binary, n_tokens binary, known binary, base binary"
)


def _coded(words: np.ndarray, places: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> list[bytes]:
    """The words of each slice: which are frequent, the places of those in three bytes, and the ``hashes`` (rows of bytes) of others."""
    often = places >= 0
    near = np.ascontiguousarray(places[often].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3])
    far = hashes[~often]
    upto = np.append(0, np.cumsum(often))
    return [
        np.packbits(often[a:b]).tobytes() + near[upto[a] : upto[b]].tobytes() + far[a - upto[a] : b - upto[b]].tobytes()
        for a, b in zip(ends[:-1], ends[1:])
    ]


def _decoded(raw: bytes, n: int, frequent: np.ndarray, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """The words of one slice, and which of them are frequent; ``short`` ones have 48 bits of their hashes."""
    flags = -(-n // 8)
    often = np.unpackbits(np.frombuffer(raw, np.uint8, flags), count=n).astype(bool)
    end = flags + 3 * int(often.sum())
    places = np.zeros((int(often.sum()), 4), np.uint8)
    places[:, :3] = np.frombuffer(raw[flags:end], np.uint8).reshape(-1, 3)
    words = np.empty(n, np.uint64)
    words[often] = frequent[places.view("<u4").reshape(-1)]
    if short:
        words = _short(words) << np.uint64(16)
    words[~often] = _unpack(raw[end:]) if short else np.frombuffer(raw[end:], "<u8")
    return words, often


def _pair_rows(unigrams: Unigrams):
    """Each batch's distinct pairs, by shard. The list of a batch's texts goes with the first; training texts come first in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        for number, batch in enumerate(_read(batches)):
            name = (TaskContext.get().partitionId() << 32) + number
            listed = np.argsort(~batch.train, kind="stable")
            place = np.empty(len(listed), np.int64)
            place[listed] = np.arange(len(listed))
            text, n_train = place[batch.text], int(batch.train.sum())
            # what is known of words is looked up once for each
            words, at = np.unique(np.append(batch.token, START), return_inverse=True)
            at = at.reshape(-1)
            token, start = at[:-1], at[-1]
            before = np.where(batch.before == START, start, np.append(start, token[:-1]))
            places, splits = unigrams.places(words), unigrams.splits(words)
            shard = unigrams.home(words, np.zeros(len(words), np.uint64), np.ones(len(words), np.int64))[before]
            several = np.flatnonzero(splits[before] > 1)
            shard[several] = unigrams.home(batch.before[several], batch.token[several], splits[before[several]])
            heads = _heads(unigrams, batch, listed, text, words, places, token)
            bits = len(words).bit_length()
            if 2 * bits + unigrams.shards.bit_length() < 63:
                order = np.argsort((shard << 2 * bits) + (before << bits) + token)
            else:
                order = np.lexsort((token, before, shard))
            shard, before, token, text = shard[order], before[order], token[order], text[order]
            new_shard = np.append(True, shard[1:] != shard[:-1])
            new_context = new_shard | np.append(True, before[1:] != before[:-1])
            contexts = np.flatnonzero(new_context)
            pairs = np.flatnonzero(new_context | np.append(True, token[1:] != token[:-1]))
            ends = np.append(np.flatnonzero(new_shard), len(shard))
            context_ends, pair_ends = np.searchsorted(contexts, ends), np.searchsorted(pairs, ends)
            degrees = np.diff(np.append(np.searchsorted(pairs, contexts), len(pairs)))
            occurrences = np.diff(np.append(pairs, len(shard)))
            own, next_ones = before[contexts], token[pairs]
            own_hashes = words[own].astype("<u8").view(np.uint8).reshape(-1, 8)
            coded = zip(
                _coded(words[own], places[own], context_ends, own_hashes),
                _coded(words[next_ones], places[next_ones], pair_ends, _pack(words[next_ones])),
            )
            rows = []
            for k, (of_contexts, of_successors) in enumerate(coded):
                part, of_pairs = slice(ends[k], ends[k + 1]), slice(pair_ends[k], pair_ends[k + 1])
                sizes = narrow(degrees[context_ends[k] : context_ends[k + 1]])
                row = (int(shard[ends[k]]), name, n_train, of_contexts, sizes, of_successors, narrow(occurrences[of_pairs]), narrow(text[part]))
                rows.append((*row, *(heads if k == 0 else [None] * len(heads))))
            names = [x.split()[0] for x in _PAIR_ROWS.split(", ")]
            columns = [pa.array([row[k] for row in rows], pa.int64() if k < 3 else pa.binary()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _heads(
    unigrams: Unigrams, batch: Batch, listed: np.ndarray, text: np.ndarray, words: np.ndarray, places: np.ndarray, token: np.ndarray
) -> list[bytes]:
    """What a batch says of its texts, with what their frequent words add to the base model's sums."""
    told = (places >= 0) & (words != END)  # ends are added last
    counts = np.zeros(len(words), np.int64)
    counts[told] = unigrams.counts[places[told]]
    known = np.bincount(text, (counts > 0)[token], len(listed)).astype(np.uint32)
    base = np.bincount(text, np.where(told, np.log10(counts + 0.5), 0.0)[token], len(listed))
    ids = np.array([x or 0 for x in batch.ids], np.int64)[listed]
    id_null = np.array([x is None for x in batch.ids])[listed]
    rest = ~batch.train.astype(bool)[listed], batch.n_tokens.astype(np.int64)[listed]
    return [x.tobytes() for x in (ids, id_null, *rest, known, base)]


def _message(kind: int, target: int, batch: int, *parts: bytes) -> tuple:
    return (kind, target, batch, *parts, *[None] * (6 - len(parts)))


_MESSAGES = "kind int, target bigint, batch bigint, a binary, b binary, c binary, d binary, e binary, f binary"


def _messages(rows: list[tuple]) -> pa.Table:
    types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6]
    names = [x.split()[0] for x in _MESSAGES.split(", ")]
    return pa.table({name: pa.array([row[k] for row in rows], t) for k, (name, t) in enumerate(zip(names, types))})


def _totals(text: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The texts that are concerned, and sums of values for each."""
    n = int(text.max()) + 1 if len(text) else 0
    there = np.flatnonzero(np.bincount(text, minlength=n))
    return there, *[np.bincount(text, x, n)[there] for x in values]


def _scores(text: np.ndarray, score: np.ndarray) -> tuple[bytes, bytes]:
    there, total = _totals(text, score)
    return narrow(there), total.astype(np.float32).tobytes()


class Shard:
    """The model of some contexts, or of parts of frequent ones."""

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, counts: np.ndarray, unigrams: Unigrams) -> None:
        """``counts`` of distinct pairs, sorted by context and successor."""
        new = np.concatenate([[True], contexts[1:] != contexts[:-1]]) if len(contexts) else np.empty(0, bool)
        begins = np.flatnonzero(new)
        own = contexts[begins]
        seen = counts > 0
        total = np.add.reduceat(counts, begins) if len(begins) else np.empty(0, np.int64)
        kinds = np.add.reduceat(seen.astype(np.int64), begins) if len(begins) else np.empty(0, np.int64)
        splits = unigrams.splits(own)
        total = np.where(splits > 1, unigrams.find(own), total)
        self.total = total
        with np.errstate(divide="ignore", invalid="ignore"):
            left = DISCOUNT * unigrams.whole_kinds(own, kinds) / total
        self.log_left = np.where(total > 0, np.log10(np.clip(left, DISCOUNT / np.maximum(total, 1), 1)), 0.0)
        owner = np.cumsum(new) - 1
        owner, words, n = owner[seen], successors[seen], counts[seen]
        often = unigrams.find(words, short=True)
        whole = 10 ** unigrams.log_whole()
        # the second summand of a rare word is added where its count is
        shared = np.where(often >= 0, 10 ** self.log_left[owner] * (often + 0.5) / whole, 0)
        logs = np.log10(np.maximum(n - DISCOUNT, 0) / total[owner] + shared)
        self.trie = Trie(own, np.bincount(owner, minlength=len(own)), words, logs)

    def answer(
        self, contexts: np.ndarray, degrees: np.ndarray, successors: np.ndarray, unigrams: Unigrams
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each pair: the count of its context, its log probability, and whether its second word must be asked for.

        Of a pair that asks, the log is that of D n(h) / c(h); the last array has the first summand's multiple of it.
        """
        place = np.repeat(self.trie.context(contexts), degrees)
        log = self.trie.log(place, successors)
        missing = np.isnan(log)
        often = unigrams.find(successors, short=True)
        asked = often < 0
        ratio = np.where(asked & ~missing, 10 ** (np.where(missing, 0, log) - self.log_left[place]), 0.0)
        log = np.where(missing | asked, self.log_left[place], log)
        fallback = missing & ~asked
        log[fallback] += np.log10(often[fallback] + 0.5) - unigrams.log_whole()
        return self.total[place], log, asked, ratio


def _score_shard(unigrams: Unigrams):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        read = []
        for row in rows:
            degrees, occurrences, text = (wide(row[x]) for x in ("degrees", "occurrences", "texts"))
            contexts, often = _decoded(row["contexts"], len(degrees), unigrams.frequent, False)
            successors, _ = _decoded(row["successors"], len(occurrences), unigrams.frequent, True)
            counts = np.add.reduceat((text < row["n_train"]).astype(np.int64), np.cumsum(occurrences) - occurrences)
            read.append((contexts, degrees, successors, counts, occurrences, text, often))
        contexts = np.concatenate([np.repeat(x[0], x[1]) for x in read])
        successors, counts = (np.concatenate([x[k] for x in read]) for k in (2, 3))
        order = np.lexsort((successors, contexts))
        contexts, successors, counts = contexts[order], successors[order], counts[order]
        new = np.concatenate([[True], (contexts[1:] != contexts[:-1]) | (successors[1:] != successors[:-1])])
        begins = np.flatnonzero(new)
        shard = Shard(contexts[begins], successors[begins], np.add.reduceat(counts, begins), unigrams)
        out = []
        asking: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        names = np.array([row["batch"] for row in rows], np.int64)
        for number, (row, (contexts, degrees, successors, _, occurrences, text, often)) in enumerate(zip(rows, read)):
            name = row["batch"]
            if row["ids"] is not None:
                heads = (row[x] for x in ("ids", "id_null", "held_out", "n_tokens", "known", "base"))
                out.append(_message(TEXTS, name, name, *heads))
            total, log, asked, ratio = shard.answer(contexts, degrees, successors, unigrams)
            # each word is the context of one token; the start is none, and batches know of frequent ones
            words = np.repeat(np.repeat(~often & (contexts != START), degrees), occurrences)
            total = np.repeat(total, occurrences)[words]
            there, known, base = _totals(text[words], total > 0, np.log10(total + 0.5))
            sums = narrow(there), narrow(known.astype(np.int64)), base.tobytes()
            out.append(_message(SUMS, name, name, *_scores(text, np.repeat(log, occurrences)), *sums))
            pick = np.repeat(asked, occurrences)
            ratio = np.repeat(ratio.astype(np.float32), occurrences)[pick]
            asking.append((np.repeat(successors, occurrences)[pick], text[pick], np.full(int(pick.sum()), number), ratio))
        # one message to each shard of counts that is asked, for all batches together
        words, texts, numbers, ratios = (np.concatenate(x) for x in zip(*asking))
        home = _home(words, unigrams.homes)
        order = np.lexsort((words, home))
        words, texts, numbers, ratios = words[order], texts[order], numbers[order], ratios[order]
        for target, part in _slices(home[order]):
            distinct, first = np.unique(words[part], return_index=True)
            sizes = np.diff(np.append(first, part.stop - part.start))
            # the names of the batches that ask, and no others
            those, which = np.unique(numbers[part], return_inverse=True)
            places = narrow(texts[part]), narrow(which.reshape(-1)), ratios[part].tobytes()
            out.append(_message(ASKED, target, -1, _pack(distinct).tobytes(), narrow(sizes), *places, names[those].tobytes()))
        return _messages(out)

    return run


def _answer_counts(unigrams: Unigrams):
    """The logs that rare words add, for the batches that ask."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for row in rows:
            if row["kind"] == COUNTS:
                words, counts = np.frombuffer(row["a"], np.uint64), np.frombuffer(row["b"], np.int64)
        words = _short(words)
        answers: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for row in rows:
            if row["kind"] == ASKED:
                asked = _short(_unpack(row["a"]))
                found = np.zeros(len(asked), np.int64)
                if len(words):
                    at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
                    found = np.where(words[at] == asked, counts[at], 0)
                share = np.repeat((found + 0.5) / 10 ** unigrams.log_whole(), wide(row["b"]))
                log = np.log10(np.frombuffer(row["e"], np.float32) + share)
                answers.append((np.frombuffer(row["f"], np.int64)[wide(row["d"])], wide(row["c"]), log))
        out = []
        if answers:
            name, text, log = (np.concatenate(x) for x in zip(*answers))
            order = np.lexsort((log, text, name))  # one order of adding, whatever arrives first
            name, text, log = name[order], text[order], log[order]
            for batch, part in _slices(name):
                out.append(_message(SUMS, batch, batch, *_scores(text[part], log[part])))
        return _messages(out)

    return run


_RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def _combine(unigrams: Unigrams):
    """The sums of each text of a batch."""
    ends = int(unigrams.find(np.array([END]))[0])
    ends = max(ends, 0)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(row for row in rows if row["kind"] == TEXTS)
        ids, null = np.frombuffer(head["a"], np.int64), np.frombuffer(head["b"], bool)
        n_tokens = np.frombuffer(head["d"], np.int64)
        known = int(ends > 0) + np.frombuffer(head["e"], np.uint32).astype(np.int64)
        base = np.log10(ends + 0.5) + np.frombuffer(head["f"], np.float64)
        score = np.zeros(len(ids))
        sums = [row for row in rows if row["kind"] == SUMS]
        for row in sorted(sums, key=lambda r: (r["a"], r["b"])):  # one order of adding, whatever arrives first
            score[wide(row["a"])] += np.frombuffer(row["b"], np.float32)
            if row["c"] is not None:
                at = wide(row["c"])
                known[at] += wide(row["d"])
                base[at] += np.frombuffer(row["e"], np.float64)
        return pa.table(
            {
                "doc_id": pa.array(ids, mask=null),
                "held_out": pa.array(np.frombuffer(head["c"], bool)),
                "n_tokens": pa.array(n_tokens),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(ids), unigrams.n_tokens, np.int64)),
                "base_score": pa.array(base - n_tokens * unigrams.log_whole()),
                "score": pa.array(score),
            }
        )

    return run


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from the documents where ``held_out`` is false, and score all."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"), (~held_out).alias("train"))
    # a shard's work and memory are bounded, so the shards grow with the texts
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    counts, unigrams = count_words(rows, max(-(-(n_bytes or 0) // SHARD_BYTES), 1))
    unigrams = count_kinds(rows, unigrams)
    pairs = map_arrow(rows, _pair_rows(unigrams), _PAIR_ROWS)
    found = cut_lineage(pairs.groupBy("shard").applyInArrow(_score_shard(unigrams), _MESSAGES))
    none = F.lit(None)
    known = counts.select(
        F.lit(COUNTS).alias("kind"),
        F.col("shard").alias("target"),
        none.cast("bigint").alias("batch"),
        F.col("words").alias("a"),
        F.col("counts").alias("b"),
        *[none.cast("binary").alias(c) for c in "cdef"],
    )
    asked = found.where(F.col("kind") == ASKED).unionByName(known)
    answers = asked.groupBy("target").applyInArrow(_answer_counts(unigrams), _MESSAGES)
    sums = found.where(F.col("kind") != ASKED).unionByName(answers)
    return sums.groupBy("batch").applyInArrow(_combine(unigrams), _RESULT)
