"""Quality rules: ordered threshold rules, learned from labelled statistics by sequential covering.

The statistics of each text are counted over whole texts. A rule is a conjunction
of thresholds on ratios of them; rules are grown on two thirds of a labelled sample
and pruned on the rest, one after another, each on what its predecessors leave.
The list is emitted as one Spark ``CASE WHEN``, which any table of statistics can use.

NULL text counts as empty; an empty text has no words and fails the base rule.
Repeated rows are judged alike. Without labelled documents of both kinds the list
is empty and only the base rule decides. Columns other than ``doc_id`` and ``text``
are ignored, or kept where rows are returned whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.frames import beside, labelled_sample, map_arrow, texts

SAMPLE_ROWS = 20_000  # labelled documents that the rules are learned from, at most
WINDOW = 5
COUNTS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_digits",
    "n_marks",
    "n_distinct",
]
COUNT_SCHEMA = ", ".join(f"{name} bigint" for name in COUNTS)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def count_block(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of a block of texts."""
    n = len(offsets) - 1
    words = W.find_words(data, offsets)
    hashes = W.hash_words(data, words)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts] += 1
    np.subtract.at(inside, words.ends, 1)
    in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    own = W.mix(words.text.astype(np.uint64) + np.uint64(1))  # hashes that differ between texts
    distinct = np.unique(hashes ^ own, return_index=True)[1]
    windows, at = W.shingles(hashes, words, WINDOW)
    keys = windows ^ own[at]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = at[counts[inverse] > 1] if len(at) else at
    cover = np.zeros(len(words) + WINDOW, np.int32)
    np.add.at(cover, twice, 1)
    np.subtract.at(cover, twice + WINDOW, 1)
    repeated = np.cumsum(cover)[: len(words)] > 0
    raw = data.tobytes()
    lines = [_lines(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return {
        "n_words": np.diff(words.first),
        "word_chars": _per_text(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.array([x[1] for x in lines], np.int64),
        "n_repeat_words": np.bincount(words.text[repeated], minlength=n),
        "n_lines": np.array([x[0] for x in lines], np.int64),
        "n_upper": _per_text(_UPPER[data], offsets),
        "n_letters": _per_text(_LETTER[data], offsets),
        "n_digits": _per_text(_DIGIT[data], offsets),
        "n_marks": _per_text(_MARK[data], offsets),
        "n_distinct": np.bincount(words.text[distinct], minlength=n),
    }


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.column_bytes(batch.column("text"))
        kept = batch.select(_carried(batch.schema.names))
        for first, last in W.blocks(offsets):
            lo = offsets[first]
            found = count_block(data[lo : offsets[last]], offsets[first : last + 1] - lo)
            arrays = [*kept.slice(first, last - first).columns, *(pa.array(found[name], pa.int64()) for name in COUNTS)]
            yield pa.RecordBatch.from_arrays(arrays, kept.schema.names + COUNTS)


def _carried(names: Sequence[str]) -> list[str]:
    """The columns that stand beside the statistics: the text only if a ``row`` needs it back."""
    return [name for name in names if name != "text" or "row" in names]


def text_counts(rows: DataFrame) -> DataFrame:
    """The statistics of ``text``, beside the other columns of ``rows``; ``text`` stays if there is a ``row``."""
    gone = set(rows.columns) - set(_carried(rows.columns))
    return map_arrow(rows, _count_batches, beside(rows, COUNT_SCHEMA, *gone))


# The ratios that rules test, as (name, part, whole).
RATIOS = [
    ("symbol_share", "n_symbols", "word_chars"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
    ("repeat_share", "n_repeat_words", "n_words"),
    ("upper_share", "n_upper", "n_letters"),
    ("digit_share", "n_digits", "word_chars"),
    ("mark_share", "n_marks", "n_words"),
    ("distinct_share", "n_distinct", "n_words"),
    ("word_length", "word_chars", "n_words"),
    ("line_words", "n_words", "n_lines"),
    ("words", "n_words", None),
]


def _ratio(part: str, whole: str | None) -> Column:
    return F.col(part) / (F.greatest(F.col(whole), F.lit(1)) if whole else F.lit(1))


@dataclass(frozen=True)
class Condition:
    """``ratio >= value`` or, with ``above`` false, ``ratio <= value``."""

    ratio: str
    above: bool
    value: float

    def holds(self, table: pd.DataFrame) -> np.ndarray:
        column = table[self.ratio].to_numpy()
        return column >= self.value if self.above else column <= self.value

    def column(self) -> Column:
        part, whole = next((p, w) for name, p, w in RATIOS if name == self.ratio)
        ratio = _ratio(part, whole)
        return ratio >= F.lit(self.value) if self.above else ratio <= F.lit(self.value)

    def __str__(self) -> str:
        return f"{self.ratio} {'>=' if self.above else '<='} {self.value:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Sequence[Condition], table: pd.DataFrame) -> np.ndarray:
    covered = np.ones(len(table), bool)
    for condition in rule:
        covered &= condition.holds(table)
    return covered


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """The information that a narrower rule gains over one with ``p0`` bad and ``n0`` good rows."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _best_condition(table: pd.DataFrame, bad: np.ndarray) -> tuple[float, Condition] | None:
    best: tuple[float, Condition] | None = None
    p0, n0 = float(bad.sum()), float((~bad).sum())
    for name, _, _ in RATIOS:
        values = table[name].to_numpy()
        order = np.argsort(values, kind="stable")
        ordered, hits = values[order], np.cumsum(bad[order])
        ends = np.flatnonzero(np.diff(ordered) > 0)  # a threshold lies halfway between two values
        if not len(ends):
            continue
        p, n = hits[ends].astype(float), ends + 1.0 - hits[ends]
        cuts = (ordered[ends] + ordered[ends + 1]) / 2
        for above, gain in ((False, _gain(p, n, p0, n0)), (True, _gain(p0 - p, n0 - n, p0, n0))):
            k = int(np.argmax(gain))
            if gain[k] > 0 and (best is None or gain[k] > best[0]):
                best = (float(gain[k]), Condition(name, above, float(cuts[k])))
    return best


def grow_rule(table: pd.DataFrame, bad: np.ndarray, longest: int = 4) -> Rule:
    """Add the condition of the largest gain until only bad rows are covered."""
    rule: list[Condition] = []
    covered = np.ones(len(table), bool)
    while len(rule) < longest and bad[covered].any() and not bad[covered].all():
        found = _best_condition(table[covered], bad[covered])
        if found is None:
            break
        rule.append(found[1])
        covered &= found[1].holds(table)
    return tuple(rule)


def prune_rule(rule: Rule, table: pd.DataFrame, bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule that does best on other rows."""

    def worth(length: int) -> float:
        covered = _covers(rule[:length], table)
        p, n = bad[covered].sum(), (~bad[covered]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))]


def learn_rules(table: pd.DataFrame, bad: np.ndarray, precision: float = 0.95, least: int = 5) -> list[Rule]:
    """Rules for the bad rows, in order.

    A rule is kept if at least ``precision`` of the rows that it newly covers, of
    at least ``least``, are bad; the first that isn't ends the list. Rows are taken
    as they come: every third one prunes.
    """
    prunes = np.arange(len(table)) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(table), bool)
    while True:
        grows, tests = left & ~prunes, left & prunes
        if bad[grows].sum() < least:
            return rules
        rule = grow_rule(table[grows], bad[grows])
        if not rule:
            return rules
        rule = prune_rule(rule, table[tests], bad[tests])
        covered = left & _covers(rule, table)
        if covered.sum() < least or bad[covered].mean() < precision:
            return rules
        rules.append(rule)
        left &= ~covered


def decision(rules: Sequence[Rule]) -> Column:
    """The number of the first rule that holds, from 1; NULL if none does."""
    number: Column | None = None
    for k, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        number = F.when(holds, F.lit(k)) if number is None else number.when(holds, F.lit(k))
    return F.lit(None).cast("int") if number is None else number


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn the rules from documents whose ``label`` is 0 (bad) or not (good).

    The driver sees at most ``most`` rows of ten numbers, no texts.
    """
    counted = text_counts(labelled_sample(docs, labels, label, most))
    rows = counted.select(
        F.xxhash64("doc_id").alias("at"), "label", *[_ratio(p, w).cast("double").alias(name) for name, p, w in RATIOS]
    ).toPandas()
    rows = rows.sort_values(list(rows.columns), kind="stable").reset_index(drop=True)
    return learn_rules(rows, rows["label"].to_numpy() == 0)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def judge(counted: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``base_failed``, the ``rule`` that rejects and the verdict ``kept``."""
    return (
        counted.withColumn("base_failed", base_failed())
        .withColumn("rule", decision(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every document."""
    return judge(text_counts(texts(docs)), fit(docs, labels))


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; a NULL text is never kept."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    counted = text_counts(docs.where(F.col("text").isNotNull()).select(F.struct(*rest).alias("row"), "text"))
    kept = judge(counted, fit(docs, labels)).where("kept")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
