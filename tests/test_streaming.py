import random

import pytest

from headwater import schemas as S
from headwater.operators import rollup
from headwater.streaming import flush
from headwater.streaming import rollup as streams
from headwater.streaming.runs import BUCKETS, Run, RunLog, buckets_of

from tests.test_rollup import KEY, event, failed, good

DAY = 86_400_000
APP = "ended"


def batches():
    first = [
        event(APP, S.JOB_START, DAY, 1, {KEY: "1", "k": "old", "x": "1"}),
        good(APP, DAY + 5, 1),
        failed(APP, DAY + 9, 2, "late clock"),
        event("open", S.JOB_START, DAY, 1, {KEY: "1", "k": "v"}),
        good("open", DAY + 1, 1),
    ]
    second = [
        event(APP, S.JOB_START, DAY + 20, 3, {KEY: "3", "k": "new"}),
        failed(APP, DAY + 8, 3, "early clock"),
        good(APP, DAY + 30, 4),
        event(APP, S.APP_END, DAY + 31),
    ]
    third = [
        failed(APP, DAY + 40, 5, "after the end"),
        event(APP, S.JOB_START, DAY + 40, 6, {KEY: "6", "k": "lost"}),
        event(APP, S.APP_END, DAY + 41),
        failed("open", DAY + 41, 2, "still open"),
    ]
    return [first, second, third]


def feed(spark, path, rows):
    spark.createDataFrame(rows, S.LISTENER_EVENT).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(S.LISTENER_EVENT).parquet(path)


def test_streamed_rollup_equals_the_batch(spark, rows, tmp_path):
    source, state, seen = f"{tmp_path}/in", f"{tmp_path}/state", []
    for number, batch in enumerate(batches()):
        feed(spark, source, batch)
        seen += batch
        streams.stream_rollup(stream(spark, source), state, f"{tmp_path}/checkpoint").awaitTermination()
        if number == 1:
            streams.compact_rollup(spark, state)
        batch_events = spark.createDataFrame(seen, S.LISTENER_EVENT)
        streamed = streams.read_rollup(spark, state)
        columns = ["app_id", "end_ms", "n_failed", "status_reason", "status"]
        assert rows(streams.apps_of(streamed), *columns) == rows(rollup.run_status(batch_events), *columns)
        columns = ["app_id", "key", "value"]
        assert rows(streams.metadata_of(streamed), *columns) == rows(rollup.merge_metadata(batch_events), *columns)


def test_flush_once_at_the_end(spark, rows, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    counts, left = [], []
    for batch in batches():
        feed(spark, source, batch)
        flush.stream_flush(stream(spark, source), target, f"{tmp_path}/checkpoint", compact_every=1).awaitTermination()
        stored = flush.read_flushed(spark, target)
        counts.append(flush.flushed_apps(stored).count())
        left.append(rows(flush.open_apps(spark, target)))
    assert counts == [0, 1, 1]
    assert left == [[("ended", DAY + 9), ("open", DAY + 1)], [("open", DAY + 1)], [("open", DAY + 41)]]
    # the first two batches, complete; nothing of the third
    until_end = spark.createDataFrame(sum(batches()[:2], []), S.LISTENER_EVENT).where(f"app_id = '{APP}'")
    columns = ["app_id", "end_ms", "n_failed", "status_reason", "status"]
    assert rows(flush.flushed_apps(stored), *columns) == rows(rollup.run_status(until_end), *columns)
    assert rows(flush.flushed_apps(stored), "status_reason") == [("late clock",)]
    columns = ["app_id", "key", "value"]
    assert rows(flush.flushed_metadata(stored), *columns) == rows(rollup.merge_metadata(until_end), *columns)


def test_old_and_quiet_applications_are_kept(spark, rows, tmp_path):
    """One application lies 300 days behind, one is quiet for 120 days before a good job and its end."""
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    deliveries = [
        [failed("quiet", 400 * DAY, 1, "lost"), good("new", 400 * DAY, 1), event("new", S.APP_END, 400 * DAY + 1)],
        [good("tick", 520 * DAY, 1)],
        [failed("old", 100 * DAY, 1, "late"), event("old", S.APP_END, 100 * DAY + 1)],
        [good("quiet", 521 * DAY, 2), event("quiet", S.APP_END, 521 * DAY + 1)],
    ]
    for batch in deliveries:
        feed(spark, source, batch)
        flush.stream_flush(stream(spark, source), target, f"{tmp_path}/checkpoint", compact_every=2).awaitTermination()
    found = rows(flush.flushed_apps(flush.read_flushed(spark, target)), "app_id", "status", "n_failed", "status_reason")
    assert found == [("new", "SUCCESS", 0, None), ("old", "FAILED", 1, "late"), ("quiet", "FAILED", 1, "lost")]
    assert rows(flush.open_apps(spark, target)) == [("tick", 520 * DAY)]


def test_a_repeated_trigger_counts_once(spark, rows, tmp_path):
    first, second, _ = (spark.createDataFrame(b, S.LISTENER_EVENT) for b in batches())
    path = str(tmp_path)
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        flush.flush_batch(batch, number, path)
    found = flush.read_flushed(spark, path)
    until_end = first.unionByName(second).where(f"app_id = '{APP}'")
    columns = ["app_id", "end_ms", "n_failed", "status_reason", "status"]
    assert rows(flush.flushed_apps(found), *columns) == rows(rollup.run_status(until_end), *columns)


def test_a_state_of_the_past_is_exact_or_refused(spark, rows, tmp_path):
    """Once runs are merged, the state between their triggers is not made up."""
    path = str(tmp_path)
    log = streams.log_of(spark, path)
    days = [[good("a", DAY, 1)], [failed("b", DAY, 2, "x")], [failed("a", DAY + 1, 3, "y")], [good("c", DAY, 4)]]
    states = []
    for number, batch in enumerate(days):
        log.write(streams.partial_rows(spark.createDataFrame(batch, S.LISTENER_EVENT)), number)
        states.append(rows(streams.read_rollup(spark, path)))
    for number in range(4):
        assert rows(streams.read_rollup(spark, path, number)) == states[number]
    streams.compact_rollup(spark, path, 2)
    # the merged runs are there until the next merge
    for number in range(4):
        assert rows(streams.read_rollup(spark, path, number)) == states[number]
    log.write(streams.partial_rows(spark.createDataFrame(days[0], S.LISTENER_EVENT)), 4)
    streams.compact_rollup(spark, path)
    with pytest.raises(LookupError):
        streams.read_rollup(spark, path, 1)
    assert rows(streams.read_rollup(spark, path, 2)) == states[2]
    assert rows(streams.read_rollup(spark, path, 4)) == rows(streams.read_rollup(spark, path))


def test_only_the_buckets_of_ended_applications_are_read(spark, tmp_path):
    path = str(tmp_path)
    events = [good(f"app-{k}", DAY + k, k) for k in range(300)]
    flush.flush_batch(spark.createDataFrame(events, S.LISTENER_EVENT), 0, path)
    ended = spark.createDataFrame([("app-7",), ("app-8",)], "app_id string")
    buckets = buckets_of(ended)
    found = streams.log_of(spark, path).read(buckets=buckets)
    opened = {name.split("bucket=")[1].split("/")[0] for name in found.inputFiles()}
    plan = found._jdf.queryExecution().explainString(spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters" in plan and opened <= {str(b) for b in range(BUCKETS)}
    assert found.select("app_id").distinct().count() < 60
    flush.flush_batch(spark.createDataFrame([event("app-7", S.APP_END, 2 * DAY)], S.LISTENER_EVENT), 1, path)
    assert [r.app_id for r in flush.flushed_apps(flush.read_flushed(spark, path)).collect()] == ["app-7"]


class InMemory(RunLog):
    """A log that only remembers its runs and how many rows each has."""

    def __init__(self):
        self.kept, self.rewritten, self.most = {}, 0, 0

    def add(self, number):
        self.kept[Run(number, number)] = 1

    def every_run(self):
        return sorted(self.kept)

    def read(self, runs):
        return sum(self.kept[run] for run in runs)

    def _merge(self, runs, merge):
        for old in self._covered():
            del self.kept[old]
        whole = Run(runs[0].first, runs[-1].last)
        self.kept[whole] = self.read(runs)
        self.rewritten += self.kept[whole]
        return whole


@pytest.mark.parametrize(("fan", "gap"), [(2, 1), (8, 1), (3, 5), (50, 1)])
def test_folders_stay_few_over_many_triggers(fan, gap):
    log, number, rng = InMemory(), 0, random.Random(fan)
    for written in range(1, 501):
        log.add(number)
        log.compact(fan, None, number - 1)
        assert sum(log.kept[run] for run in log.runs()) == written
        log.most = max(log.most, len(log.kept))
        number += rng.randint(1, gap)
    levels = 1
    while fan**levels < number:
        levels += 1
    assert log.most <= 2 * fan * (levels + 1)
    assert log.rewritten <= 500 * (levels + 1)


def test_many_triggers_with_merges_equal_the_batch(spark, rows, tmp_path):
    rng, path, seen = random.Random(2), str(tmp_path), []
    for number in range(14):
        batch = [failed(f"a{rng.randrange(6)}", DAY + rng.randrange(50), 10 * number + k, f"e{k}") for k in range(3)]
        batch += [event(f"a{rng.randrange(6)}", S.APP_END, DAY + 60)] if number in (5, 9) else []
        seen += batch
        flush.flush_batch(spark.createDataFrame(batch, S.LISTENER_EVENT), number, path)
        flush.compact_flush(spark, path, number - 1, fan=3)
    assert len(streams.log_of(spark, path).every_run()) <= 12
    reported = {r.app_id for r in flush.read_flushed(spark, path).collect()}
    ended = {e[0] for e in seen if e[2] == S.APP_END}
    assert reported == ended
    still_open = spark.createDataFrame([e for e in seen if e[0] not in ended], S.LISTENER_EVENT)
    state = streams.apps_of(streams.read_rollup(spark, path)).where(~streams.F.col("app_id").isin(list(ended)))
    columns = ["app_id", "end_ms", "n_failed", "status_reason", "status"]
    assert rows(state, *columns) == rows(rollup.run_status(still_open), *columns)
