import random

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

# Names that the operators use themselves, as further columns of the documents.
CLASHING = ["score", "n_words", "size", "group", "node", "row", "held_out", "span", "label", "at", "part", "bucket", "kept"]
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        *[StructField(name, StringType()) for name in CLASHING],
    ]
)
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("label", StringType())])


def sentence(rng, words):
    chosen = [rng.choice(WORDS) for _ in range(words)]
    return " ".join(chosen).capitalize() + "."


WORDS = [a + b for a in "ka lo mi tu re sa".split() for b in "na ti go bu pe zu le xo".split()]


def prose(rng, sentences):
    return "\n".join(" ".join(sentence(rng, rng.randint(4, 14)) for _ in range(3)) for _ in range(sentences // 3 + 1))


@pytest.fixture(scope="session")
def edge_rows():
    """Documents with NULLs, empty and very long texts, ties, repeated rows, copies and shared passages."""
    rng = random.Random(7)
    passage = " ".join(sentence(rng, 11) for _ in range(6))
    texts = [prose(rng, rng.randint(3, 20)) for _ in range(30)]
    texts[3] = texts[4]  # a copy
    long_words = texts[5].split(" ")
    long_words[len(long_words) // 2] = "changed"
    texts[6] = " ".join(long_words)  # a near-copy
    for k in (8, 9, 10):
        texts[k] = f"{texts[k]}\n{passage}\n{texts[k + 10][:80]}"
    texts[11] = "same same " * 1000  # repeats itself
    texts[12] = "x" * 150_000  # one very long word
    texts[13] = prose(rng, 1500)  # a very long text
    texts[14] = "Ünï ÇÖDÉ 漢字 😀    é\ttab\r\nline\x0bfeed\x0c end ▁ <|endoftext|> it's 12٣ $$$"
    texts[15] = "one"
    texts[16] = "one two"
    rows = [(k, text, "ab"[k % 2], f"s{k % 4}") for k, text in enumerate(texts)]
    rows += [(100, None, "a", "s0"), (101, "", "a", None), (102, " \n\t ", "b", None), (103, " leading space", None, "s1")]
    rows += [(None, texts[2], "a", "s1"), (None, None, None, None), (None, "no id at all", "b", "s2")]
    rows += [rows[7], rows[7], (7, "the same id, another text", "a", "s9"), (7, None, "a", "s9")]
    return [(*row, None if row[1] is None else len(row[1]), *["?"] * len(CLASHING)) for row in rows]


@pytest.fixture(scope="session")
def docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(k, int(k % 5 != 0), "?") for k in range(30)] + [(None, 1, "?"), (3, None, "?"), (4, 0, "?"), (4, 1, "?")]
    return spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


def words_of(text, lower=False):
    raw = (text or "").encode()
    if lower:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    return raw.split()


def key(row):
    return tuple((value is None, value if value is not None else 0) for value in row)
