import random

import pytest
from pyspark.sql import functions as F

from headwater.skew import PIECES, find_hot, lookup_join, number_rows


def _facts(spark):
    generator = random.Random(7)
    data = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{generator.randrange(40)}", i) for i in range(3000)]
    return spark.createDataFrame(data, "k string, i bigint")


def test_hot_keys_are_few_and_cut_below_the_share(spark):
    hot = find_hot(_facts(spark), ["k"], share=0.05)
    found = {row["k"]: row[PIECES] for row in hot}
    assert set(found) == {"hot", None}
    assert found["hot"] == 7 and len(hot) <= 20


def test_lookup_join_equals_a_plain_join(spark, rows):
    facts = _facts(spark)
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)] + [(f"k{n}", n) for n in range(30)], "k string, d int")
    for how in ("left", "inner"):
        for share in (0.05, 0.9):
            assert rows(lookup_join(facts, dim, ["k"], ["i"], how, share)) == rows(facts.join(dim, ["k"], how))


def test_hot_rows_are_spread(spark):
    facts = _facts(spark)
    dim = spark.createDataFrame([("hot", 1)], "k string, d int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(facts, dim, ["k"], ["i"], share=0.02)
        parts = joined.where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert parts > 1


@pytest.mark.parametrize("partitions", ["2", "7", "40"])
def test_number_rows_matches_a_sort(spark, partitions):
    """Groups from one row to two thirds of all rows, ones that fill several partitions, and small Arrow batches."""
    generator = random.Random(3)
    names = ["hot"] * 600 + ["a", "b", None] * 60 + [f"g{k}" for k in range(200)]
    data = [(generator.choice(names), generator.randrange(100), f"n{i}") for i in range(2000)]
    df = spark.createDataFrame(data, "g string, o bigint, n string").repartition(5)
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        numbered = number_rows(df, ["g"], ["o", "n"]).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(numbered) == len(data)
    for group in {g for g, _, _ in data}:
        expected = sorted((o, n) for g, o, n in data if g == group)
        got = [(r["o"], r["n"]) for r in sorted((r for r in numbered if r["g"] == group), key=lambda r: r["pos"])]
        assert got == expected
        assert sorted(r["pos"] for r in numbered if r["g"] == group) == list(range(len(expected)))


def test_rows_are_numbered_from_one_run_of_what_they_come_from(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    df = spark.range(500).selectExpr("id % 3 as g", "id as o").mapInArrow(count, "g bigint, o bigint")
    assert number_rows(df, ["g"], ["o"]).count() == 500 and runs.value == 500
    assert number_rows(df.where("g > 5"), ["g"], ["o"]).count() == 0
