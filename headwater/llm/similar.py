"""Near-duplicate documents: a prefix-tree join of n-gram sets by Jaccard similarity.

A document's set holds the hashes of its word shingles, in the order of the hashes,
which is the same everywhere. Documents with equal sets are one node. Two sets are
linked if their intersection is a given share of their union at least. Shingles of
three words and a share of 9/10 are the default; :data:`NEAR` has five and 4/5.

1. *Which sets can meet.* Sets that are linked differ in at most a known part of
   their sizes' sum, d (a nineteenth for 9/10, a ninth for 4/5). The range of hashes is cut into d + 2 parts; at least two
   parts hold the same of both. A set has a signature for each of its parts, so
   linked sets share one. (A part without hashes tells little. As one such part
   of each set may be left out without losing a link, it is; a set with more of
   them has signatures for all.) Sets of sizes that can be linked are cut alike:
   each is cut for its own class of sizes and for the class below.

   Below 7/8 a part holds three or four hashes only, and common passages would tie
   unrelated sets. There the range is cut into more than d / 2 groups of three parts.
   Some group has one differing hash at most, so two of its parts are the same in
   both: signatures are those of pairs of parts of a group. As some groups more are
   cut, pairs without hashes are left out in the same way.
2. *Clusters.* Each set is tied to the least set of its signatures, and the
   connected components of these ties are found: a link never leaves its cluster.
   Below 7/8 the cuts of a set for its two classes are nodes of their own, so that
   ties do not lead on from one class of sizes to the next.
3. *Prefix tree.* The sets of a cluster are put into a tree by their hashes in order.
   Each set walks down it, one level of nodes at a time; the overlap with a path's
   beginning is shared by all sets below, and a subtree is left out once the lengths
   that remain cannot reach the bound any more, or if all its sets are connected with
   the walker already. A
   cluster too large for one task is cut into blocks, and all pairs of blocks are
   joined, each on its own.
4. The links' connected components are the result.

Copies are one node, so they never become pairs, and a block of near-copies is
connected after a few walks. Equality of shingles, parts and sets is that of 64-bit
hashes.

NULL and empty texts have empty sets, linked with nothing; fewer words than a shingle
are one shingle. Rows of equal ``doc_id`` are documents of their own. Columns other than
``doc_id`` and ``text`` are ignored, or kept where rows are returned whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.frames import beside, map_arrow
from headwater.llm.graph import components
from headwater.session import cut_lineage

BLOCK_SETS = 4_000
BLOCK_SHINGLES = 1_000_000
HELD_SIGNATURES = 500_000
_PART = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = np.uint64(0xC2B2AE3D27D4EB4F)
STRETCH = 32  # the most hashes of a tree node


@dataclass(frozen=True)
class Likeness:
    """Which sets are linked: shingles of so many words, and the intersection's share of the union."""

    words: int = 3
    share: tuple[int, int] = (9, 10)

    def reached(self, overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether an overlap links two sets of these sizes' sum."""
        part, whole = self.share
        return (part + whole) * overlap >= part * sizes

    @property
    def paired(self) -> bool:
        """Whether a signature takes two parts, since one would hold few hashes."""
        part, whole = self.share
        return 8 * part < 7 * whole

    @cached_property
    def bounds(self) -> np.ndarray:
        """Where classes of set sizes begin: linked sets are of one class or of neighbouring classes."""
        part, whole = self.share
        found = [1]
        while found[-1] < 1 << 40:
            found.append(found[-1] * whole // part + 1)
        return np.array(found)

    def size_class(self, n: int) -> int:
        return int(np.searchsorted(self.bounds, n, "right")) - 1

    def differing(self, level: int) -> int:
        """The most by which linked sets of class ``level``, or of it and the next, differ."""
        part, whole = self.share
        most = int(self.bounds[level + 1] - 1 + self.bounds[level + 2] - 1)
        return most * (whole - part) // (whole + part)


NEAR = Likeness(5, (4, 5))


def block_sets(data: np.ndarray, offsets: np.ndarray, n_words: int = 3) -> list[np.ndarray]:
    """The sorted shingle hashes of each text of a block."""
    words = W.find_words(data, offsets)
    hashes = W.hash_words(data, words, lower=True)
    found, at = W.shingles(hashes, words, n_words)
    ends = np.searchsorted(words.text[at], np.arange(len(offsets)))
    out = []
    for k in range(len(offsets) - 1):
        a, b = words.first[k], words.first[k + 1]
        if 0 < b - a < n_words:
            whole = np.full(1, b - a, np.uint64)
            for h in hashes[a:b]:
                whole = W.mix(whole * _PART + h)
            out.append(whole)
        else:
            out.append(np.unique(found[ends[k] : ends[k + 1]]))
    return out


def node_of(shingles: np.ndarray) -> int:
    """A number for a set; equal sets have equal numbers."""
    total = np.add.reduce(W.mix(shingles), keepdims=True) + np.uint64(len(shingles)) * np.ones(1, np.uint64)
    return int(W.mix(total).view(np.int64)[0])


def levels(like: Likeness, n_shingles: int) -> list[int]:
    """The classes that a set of this size is cut for; at others, linked sets are equal."""
    own = like.size_class(n_shingles)
    return [level for level in (own, own - 1) if level >= 0 and like.differing(level)]


def vertex(nodes: np.ndarray, level: int, like: Likeness) -> np.ndarray:
    """The node of a set in the graph of ties, where it is cut for the class ``level``."""
    if not like.paired:
        return nodes
    return W.mix(nodes.view(np.uint64) + np.uint64((level + 1) * int(_LEVEL) % 2**64)).view(np.int64)


def _single(shingles: np.ndarray, differing: int, shift: np.uint64) -> np.ndarray:
    """Signatures of single parts."""
    parts = differing + 2
    part = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    content = np.add.reduceat(W.mix(shingles), begins)
    where = part[begins]
    if parts - len(begins) > 1:
        bare = np.setdiff1d(np.arange(parts, dtype=np.uint64), where)
        where = np.concatenate([where, bare])
        content = np.concatenate([content, np.zeros(len(bare), np.uint64)])
    return W.mix(W.mix(content + shift) + where * _PART)


def _pairs(shingles: np.ndarray, differing: int, shift: np.uint64) -> np.ndarray:
    """Signatures of pairs of parts, three for each group of three parts.

    ``alike`` groups at least have one differing hash at most. A set with fewer groups
    of two bare parts needs no signatures of bare pairs.
    """
    alike = 2 + differing // 16
    groups = differing // 2 + alike
    part = (((shingles >> np.uint64(32)) * np.uint64(3 * groups)) >> np.uint64(32)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    content = np.zeros(3 * groups, np.uint64)
    content[part[begins]] = W.mix(np.add.reduceat(W.mix(shingles), begins) + shift)
    filled = np.zeros(3 * groups, bool)
    filled[part[begins]] = True
    content, filled = content.reshape(-1, 3), filled.reshape(-1, 3)
    every = int((filled.sum(axis=1) < 2).sum()) >= alike
    out = []
    for number, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        group = np.arange(groups) if every else np.flatnonzero(filled[:, a] | filled[:, b])
        both = W.mix(content[group, a] + _PART) + content[group, b] + shift
        out.append(W.mix(W.mix(both) + (group * 3 + number + 1).astype(np.uint64) * _PART))
    return np.concatenate(out)


def level_signatures(shingles: np.ndarray, like: Likeness) -> list[tuple[int, np.ndarray]]:
    """The signatures of a set, for each class that it is cut for."""
    of_parts = _pairs if like.paired else _single
    return [
        (level, of_parts(shingles, like.differing(level), np.uint64((level + 1) * int(_LEVEL) % 2**64)))
        for level in levels(like, len(shingles))
    ]


def signatures(shingles: np.ndarray, like: Likeness = Likeness()) -> np.ndarray:
    """The signatures of a set: a linked set has one of them at least, unless it is equal."""
    out = [found for _, found in level_signatures(shingles, like)]
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _sets(batch: pa.RecordBatch, like: Likeness) -> Iterator[tuple[int, list[np.ndarray]]]:
    data, offsets = W.column_bytes(batch.column("text"))
    for first, last in W.blocks(offsets):
        lo = offsets[first]
        yield first, block_sets(data[lo : offsets[last]], offsets[first : last + 1] - lo, like.words)


def _node_rows(batches: Iterator[pa.RecordBatch], like: Likeness) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s for _, found in _sets(batch, like) for s in found]
        columns = [batch.column(name) for name in ("doc_id", "text_hash")]
        columns += [pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node"])


def _signature_rows(batches: Iterator[pa.RecordBatch], like: Likeness) -> Iterator[pa.RecordBatch]:
    """The least set of each signature, and ties to it, of as many texts as a task holds at once."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            keys, nodes = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((nodes, keys))
            keys, nodes = keys[order], nodes[order]
            begins = np.concatenate([[True], keys[1:] != keys[:-1]])
            least = nodes[begins][np.cumsum(begins) - 1]
            ties = np.unique(np.stack([nodes[nodes != least], least[nodes != least]], axis=1), axis=0)
            spread = W.mix(ties[:, 0].view(np.uint64) + _LEVEL).view(np.int64)  # ties can go anywhere
            key = pa.array(np.concatenate([keys[begins].view(np.int64), spread]))
            node = pa.array(np.concatenate([nodes[begins], ties[:, 0]]))
            other = pa.array(np.concatenate([nodes[begins], ties[:, 1]]))
            yield pa.RecordBatch.from_arrays([key, node, other], ["signature", "node", "other"])

    for batch in batches:
        for _, sets in _sets(batch, like):
            for shingles in sets:
                if len(shingles):
                    node = np.full(1, node_of(shingles), np.int64)
                    for level, found in level_signatures(shingles, like):
                        held.append((found, np.repeat(vertex(node, level, like), len(found))))
                        size += len(found)
            if size >= HELD_SIGNATURES:
                yield from flush()
                held, size = [], 0
    yield from flush()


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by signature and node: each node of a signature tied to the least one."""
    last_key, last_least = None, 0
    for batch in batches:
        keys, nodes, others = (np.asarray(batch.column(x)) for x in ("signature", "node", "other"))
        tied = nodes != others
        pairs = [np.stack([nodes[tied], others[tied]], axis=1)]
        keys, nodes = keys[~tied], nodes[~tied]
        if len(keys):
            begins = np.concatenate([[keys[0] != last_key], keys[1:] != keys[:-1]])
            least = np.concatenate([[last_least], nodes[begins]])[np.cumsum(begins)]
            last_key, last_least = keys[-1], least[-1]
            more = nodes != least
            pairs.append(np.stack([nodes[more], least[more]], axis=1))
        found = np.unique(np.concatenate(pairs), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["node", "other"])


class PrefixTree:
    """The sets of a block by their beginnings, as arrays over nodes.

    A node is a stretch of at most STRETCH hashes that all sets below it share. The
    sets lie in the order of their hashes, so those below a node are neighbours, and
    those that end at a node come first.
    """

    def __init__(self, sets: list[np.ndarray], which: list[int]) -> None:
        """``sets`` are sorted numbers; the tree holds those of ``which``."""
        self.order = np.array(sorted(which, key=lambda i: sets[i].astype(">u4").tobytes()), np.int64)
        rows = [sets[i] for i in self.order]
        size = [len(x) for x in rows]
        # how much of its beginning each set shares with the one before
        shared = [0] + [_common(x, y) for x, y in zip(rows, rows[1:])]
        nodes: list[tuple[int, int, int, int, int]] = []  # first set, set after the last, begin, end, sets that end
        stretches: list[np.ndarray] = []
        children: list[list[int]] = [[]]  # the first list is the root's
        stack = [(0, len(rows), 0, 0)] if rows else []
        while stack:
            lo, hi, begin, parent = stack.pop()
            end = min([size[lo], *shared[lo + 1 : hi], begin + STRETCH]) if hi - lo > 1 else min(size[lo], begin + STRETCH)
            if end > begin:
                children[parent].append(len(nodes))
                stretches.append(rows[lo][begin:end])
                ending = lo
                while ending < hi and size[ending] == end:
                    ending += 1
                nodes.append((lo, hi, begin, end, ending - lo))
                children.append([])
                parent = len(nodes)
            else:
                ending = lo
            first = ending
            for k in range(ending + 1, hi + 1):
                if k == hi or shared[k] <= end:
                    if first < k:
                        stack.append((first, k, end, parent))
                    first = k
        self.lo, self.hi, self.begin, self.end, self.ending = np.array(nodes, np.int64).reshape(-1, 5).T
        self.hashes = np.concatenate(stretches) if stretches else np.empty(0, np.uint32)
        self.at = np.concatenate([[0], np.cumsum(self.end - self.begin)])
        self.child = np.array([c for below in children for c in below], np.int64)
        self.child_at = np.concatenate([[0], np.cumsum([len(below) for below in children])])
        lengths = np.array(size, np.int64)
        self.lengths = lengths
        self.shortest = np.array([lengths[lo:hi].min() for lo, hi, *_ in nodes], np.int64)
        self.longest = np.array([lengths[lo:hi].max() for lo, hi, *_ in nodes], np.int64)

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of nodes, and for each the place of its parent in ``nodes``."""
        sizes = self.child_at[nodes + 2] - self.child_at[nodes + 1]
        return self.child[_ranges(self.child_at[nodes + 1], sizes)], np.repeat(np.arange(len(nodes)), sizes)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)


def linked_sets(
    tree: PrefixTree, own: np.ndarray, is_own: np.ndarray, wanted: np.ndarray, like: Likeness
) -> np.ndarray:
    """The places in the tree of the ``wanted`` sets that are linked with a set.

    All nodes of a level are looked at together. A node's overlap is its parent's,
    counted once for all sets below, plus that of its own stretch. A node is left if
    no wanted set lies below, or if none of the lengths below can reach the bound.
    ``is_own`` marks the hashes of the set.
    """
    size = len(own)
    above = np.concatenate([[0], np.cumsum(wanted)])
    found = []
    nodes = tree.child[: tree.child_at[1]]
    overlap = np.zeros(len(nodes), np.int64)
    while len(nodes):
        keep = above[tree.hi[nodes]] > above[tree.lo[nodes]]
        nodes, overlap = nodes[keep], overlap[keep]
        if not len(nodes):
            break
        sizes = tree.end[nodes] - tree.begin[nodes]
        hits = is_own[tree.hashes[_ranges(tree.at[nodes], sizes)]]
        overlap = overlap + np.add.reduceat(hits, np.cumsum(sizes) - sizes, dtype=np.int64)
        depth = tree.end[nodes]
        left = size - np.searchsorted(own, tree.hashes[tree.at[nodes + 1] - 1], "right")
        best = np.clip(left + depth, tree.shortest[nodes], tree.longest[nodes])
        can = like.reached(overlap + np.minimum(best - depth, left), size + best)
        nodes, overlap, depth = nodes[can], overlap[can], depth[can]
        linked = (tree.ending[nodes] > 0) & like.reached(overlap, size + depth)
        found.append(_ranges(tree.lo[nodes[linked]], tree.ending[nodes[linked]]))
        nodes, parent = tree.below(nodes)
        overlap = overlap[parent]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def join_block(table: pa.Table, like: Likeness = Likeness()) -> pa.Table:
    """Links between the sets of one block, or of two: as many as connect what is linked.

    The sets walk down the tree one after another; sets that are connected with the
    walker already are no longer wanted.
    """
    nodes = table.column("node").to_numpy()
    hashes = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    in_first = np.asarray(table.column("in_first"))
    every, numbers = np.unique(np.concatenate(hashes), return_inverse=True)  # smaller numbers, in the same order
    sets = np.split(numbers.astype(np.uint32), np.cumsum([len(x) for x in hashes])[:-1])
    tree = PrefixTree(sets, np.flatnonzero(in_first).tolist())
    group = np.arange(len(sets))
    is_own = np.zeros(len(every), bool)
    links: list[tuple[int, int]] = []
    for i in range(len(sets)) if in_first.all() else np.flatnonzero(~in_first):
        wanted = group[tree.order] != group[i]
        if not wanted.any():
            continue
        is_own[sets[i]] = True
        for j in tree.order[linked_sets(tree, sets[i], is_own, wanted, like)]:
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                links.append((int(nodes[i]), int(nodes[j])))
        is_own[sets[i]] = False
    return pa.table({"node": pa.array([x[0] for x in links], pa.int64()), "other": pa.array([x[1] for x in links], pa.int64())})


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def set_nodes(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node`` of each document."""
    rows = _hashed(docs)
    schema = beside(rows, "n_shingles bigint, node bigint", "text")
    return map_arrow(rows, lambda batches: _node_rows(batches, like), schema)


def clusters(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``node, component``: sets that share a signature, directly or through others; see :func:`vertex`."""
    schema = "signature bigint, node bigint, other bigint"
    rows = map_arrow(_hashed(docs).select("text"), lambda batches: _signature_rows(batches, like), schema)
    ordered = rows.repartition("signature").sortWithinPartitions("signature", "node")
    return components(map_arrow(ordered, _ties, "node bigint, other bigint").distinct())


def _vertices(rows: DataFrame, like: Likeness) -> DataFrame:
    """The rows of sets ``node, text_hash, n`` with each ``vertex`` of theirs."""
    if not like.paired:
        return rows.withColumn("vertex", F.col("node"))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.asarray(batch.column("node"))
            found = [(k, level) for k, n in enumerate(batch.column("n").to_pylist()) if n for level in levels(like, n)]
            own = pa.array([k for k, _ in found], pa.int64())
            ids = [int(vertex(nodes[k : k + 1], level, like)[0]) for k, level in found]
            columns = [batch.column(name).take(own) for name in names] + [pa.array(ids, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "vertex"])

    return map_arrow(rows, run, beside(rows, "vertex bigint"))


def links(docs: DataFrame, nodes: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """Links that connect all linked sets; ``nodes`` is the result of :func:`set_nodes`."""
    found = cut_lineage(clusters(docs, like))
    one_text = nodes.groupBy("node").agg(F.min("text_hash").alias("text_hash"), F.max("n_shingles").alias("n"))
    members = cut_lineage(_vertices(one_text, like).join(found.withColumnRenamed("node", "vertex"), "vertex").drop("vertex"))
    sums = members.groupBy("component").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    cut = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    blocks = members.join(sums.select("component", cut.alias("blocks")), "component").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # one text of each node; copies of it fall away before they are shuffled
    texts = _hashed(docs).select("text_hash", "text").dropDuplicates(["text_hash"]).join(blocks, "text_hash")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["component", "blocks", "block", "node"]
        for batch in batches:
            for first, sets in _sets(batch, like):
                own = [batch.column(name).slice(first, len(sets)) for name in names]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array([s.tobytes() for s in sets], pa.binary())], [*names, "shingles"]
                )

    with_sets = map_arrow(
        texts.select("component", "blocks", "block", "node", "text"),
        to_sets,
        "component bigint, blocks int, block int, node bigint, shingles binary",
    )
    units = with_sets.withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component",
        F.least("block", "other_block").alias("one"),
        F.greatest("block", "other_block").alias("two"),
        (F.col("block") <= F.col("other_block")).alias("in_first"),
        "node",
        "shingles",
    )
    by_unit = units.groupBy("component", "one", "two")
    return by_unit.applyInArrow(lambda table: join_block(table, like), "node bigint, other bigint")


def grouped(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node`` and ``group`` of each document: the group of linked sets.

    The group of a document that is linked with no other set is its node; that of an
    empty one is NULL.
    """
    nodes = cut_lineage(set_nodes(docs, like))
    groups = components(links(docs, nodes, like)).withColumnRenamed("component", "_group")
    found = nodes.join(groups, "node", "left")
    return found.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        "node",
        F.when(F.col("n_shingles") > 0, F.coalesce("_group", "node")).alias("group"),
    )


def similar(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``: the smallest ``doc_id`` that links reach."""
    found = cut_lineage(grouped(docs, like))
    least = found.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("component_id"))
    joined = found.join(least, "group", "left")
    own = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The documents with all their columns, one of each group of linked documents.

    The one with the smallest ``doc_id`` stays, NULL last, then by a hash of its text.
    Of rows that are equal in both, one stays. Empty texts all stay.
    """
    found = grouped(docs, like)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = (
        found.where(F.col("group").isNotNull())
        .groupBy("group")
        .agg(F.min(place).alias("first"))
        .select(F.xxhash64("first.doc_id").alias("id_hash"), "first.text_hash")
    )
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64("doc_id").alias("id_hash"),
        F.xxhash64(text).alias("text_hash"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("bare"),
    )
    # equal rows fall away before they are shuffled, so an id and text that very many rows have is no large group
    one = keyed.where("not bare").dropDuplicates(["id_hash", "text_hash"]).join(kept, ["id_hash", "text_hash"], "left_semi")
    return keyed.where("bare").unionByName(one).select("row.*")
