"""The demo jobs on fixtures of the demo's shape, the sinks, and the connector options."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from headwater.operators import etl
from headwater.plans import pipelines
from headwater.sinks import writers as K
from headwater.sources import readers

REPORT = "latitude double, longitude double, vehicle_id int, report_hour string, report_date string, speed double"


def reports(spark):
    """Twelve reports of the buses 1 to 12; the last three have no hour."""
    data = [(48.1 + i / 100, 11.5, 1 + i, f"{i:02}" if i < 9 else None, "2023-05-04", 30.0 + i) for i in range(12)]
    return spark.createDataFrame(data, REPORT)


def vehicles(spark):
    return spark.createDataFrame([(1 + i, f"bus {i}") for i in range(12)], "id int, name string")


def test_jdbc_job(spark):
    found = pipelines.reports_with_vehicles(reports(spark), vehicles(spark))
    assert found.count() == 9
    assert found.columns == [c for c in reports(spark).columns if c != "report_date"] + ["name"]
    assert found.where("name is null").count() == 0


def test_delta_job(spark):
    cleaned = pipelines.reports_with_vehicles(reports(spark), vehicles(spark))
    seen = spark.createDataFrame([(1, "x"), (2, "y")], "vehicle_id int, other string")
    found = pipelines.reports_with_seen(cleaned, seen)
    assert found.count() == 9 and found.where("vehicle_id is not null").count() == 0
    # a double that equals an int matches
    one = spark.createDataFrame([(1, 40.0)], "vehicle_id int, latitude double")
    assert pipelines.reports_with_seen(one, spark.createDataFrame([(40,)], "vehicle_id int")).first()["vehicle_id"] == 40


def test_kafka_job(spark, rows, tmp_path):
    records = spark.createDataFrame(
        [(bytearray(b"1"), bytearray(b'{"page": 7, "ms": 120}'), t) for t in ("clicks", "late_clicks", "x")],
        readers.KAFKA_RECORD,
    )
    records.write.partitionBy("topic").parquet(f"{tmp_path}/in")
    read = readers.scan_topic_archive(spark, f"{tmp_path}/in", "clicks, late_clicks")
    assert etl.top_rows(etl.with_cast(read, "value", "string", "value_str"), 2).count() == 2
    K.sink_topic_archive(pipelines.records_as_text(read), f"{tmp_path}/out", "all_clicks")
    expected = ("1", '{"page": 7, "ms": 120}', "all_clicks")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [expected, expected]


def test_warehouse_job(spark, rows):
    centers = spark.createDataFrame([(1, "small"), (10, "big"), (11, "far")], "CC_CALL_CENTER_SK int, CC_CLASS string")
    buses = spark.createDataFrame([(10,)], "vehicle_id int")
    assert rows(pipelines.centers_with_vehicles(centers, buses)) == [(1, "small"), (10, "big")]


def test_word_count(spark, rows, tmp_path):
    words = "one two three four five six seven eight nine ten".split()
    folder = K.sink_text(spark.createDataFrame([(w,) for w in words], "value string"), f"{tmp_path}/words")
    assert rows(etl.word_count(readers.scan_text(spark, folder))) == sorted((w, 1) for w in words)
    blanks = spark.createDataFrame([("a  b",), ("",)], "value string")
    assert rows(etl.word_count(blanks)) == [("", 2), ("a", 1), ("b", 1)]


def test_filters(spark, rows):
    data = [(80.0, 180.0), (80.1, 0.0), (-90.0, -180.0), (0.0, 0.0), (0.0, 1.0), (None, None), (None, 5.0)]
    df = spark.createDataFrame(data, "latitude double, longitude double")
    assert rows(etl.valid_position(df)) == sorted([(80.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (0.0, 1.0)], key=repr)
    assert (None, 5.0) in rows(etl.non_zero_position(df))
    assert (0.0, 0.0) not in rows(etl.non_zero_position(df))
    assert etl.drop_cols(df, "longitude", "no_such").columns == ["latitude"]


def test_left_lookup_equals_the_plain_join(spark, rows):
    left = spark.createDataFrame([(float(i % 5), i) for i in range(100)], "a double, i int")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (9, "z")], "b int, s string")
    assert rows(etl.left_lookup(left, right, "a", "b", ["i"], "double")) == rows(etl.left_join(left, right, left["a"] == right["b"]))


def test_versioned_table_survives_its_own_overwrite(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    assert not K.table_exists(spark, path)
    assert K.sink_table(spark.createDataFrame([(1,)], "n int"), path) == 1
    assert K.sink_table(K.read_table(spark, path).selectExpr("n + 1 as n"), path) == 2
    (tmp_path / "t" / "version=3").mkdir()  # an unfinished write
    assert rows(K.read_table(spark, path)) == [(2,)]
    assert rows(K.read_table(spark, path, 1)) == [(1,)]


def test_publish_and_log(spark, rows, tmp_path):
    docs = spark.createDataFrame(
        [("a", "h1", "publish", "//s", "head", "//j", ["j", "r"]), ("b", "h2", "publish", "//s", "input", "//d", ["e"]),
         ("c", "h1", "log", "//t", "head", "//k", ["j", "r"])],
        "app_id string, host string, sink string, source_name string, kind string, key string, items array<string>",
    )
    for _ in range(2):
        K.publish(docs, f"{tmp_path}/p")
    assert rows(K.read_published(spark, f"{tmp_path}/p"), "app_id", "host") == [("a", "h1"), ("b", "h2")]
    K.publish(docs, f"{tmp_path}/p", batch=1)
    assert K.read_published(spark, f"{tmp_path}/p").count() == 2
    assert (tmp_path / "p" / "batch=0" / "host=h1").is_dir()
    assert rows(K.to_json_lines(docs)) == [('{"source_name":"//t","kind":"head","key":"//k","items":["j","r"]}',)]


def test_two_writers_at_one_number_keep_both_versions(spark, rows, tmp_path, monkeypatch):
    """The second writer has read the commits before the first one commits."""
    path = str(tmp_path / "t")
    assert K.sink_table(spark.createDataFrame([(1,)], "n int"), path) == 1
    real = K._commits

    def interleaved(session, where):
        found = real(session, where)
        monkeypatch.setattr(K, "_commits", real)
        assert K.sink_table(spark.createDataFrame([(2,)], "n int"), path) == 2
        return found

    monkeypatch.setattr(K, "_commits", interleaved)
    assert K.sink_table(spark.createDataFrame([(3,)], "n int"), path) == 3
    assert [rows(K.read_table(spark, path, v)) for v in (1, 2, 3)] == [[(1,)], [(2,)], [(3,)]]
    assert rows(K.read_table(spark, path)) == [(3,)]


def test_many_writers_at_once(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(lambda n: (K.sink_table(spark.createDataFrame([(n,)], "n int"), path), n), range(12)))
    assert sorted(v for v, _ in versions) == list(range(1, 13))
    assert all(rows(K.read_table(spark, path, v)) == [(n,)] for v, n in versions)


def test_a_write_that_builds_on_a_replaced_version_is_given_up(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "n int")
    assert K.sink_table(one, path, base=0) == 1
    base = K.table_version(spark, path)
    mine = K.read_table(spark, path, base).selectExpr("n + 10 as n")
    assert K.sink_table(K.read_table(spark, path, base).selectExpr("n + 1 as n"), path, base) == 2
    with pytest.raises(K.TableConflict):
        K.sink_table(mine, path, base)
    assert rows(K.read_table(spark, path)) == [(2,)] and len(list((tmp_path / "t").glob("data-*"))) == 2
    assert K.sink_table(K.read_table(spark, path, 2).selectExpr("n + 10 as n"), path, 2) == 3
    with pytest.raises(LookupError):
        K.read_table(spark, path, 9)


def test_old_versions_are_swept_when_nobody_needs_them(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        K.sink_table(spark.createDataFrame([(n,)], "n int"), path)
    spark.range(1).write.parquet(f"{path}/data-given-up")
    assert K.sweep_table(spark, path, keep=2) == []  # all were written just now
    old = K.read_table(spark, path, 1)
    assert rows(old) == [(0,)]
    assert len(K.sweep_table(spark, path, keep=2, older_than_hours=0)) == 3
    assert rows(K.read_table(spark, path, 3)) == [(2,)] and rows(K.read_table(spark, path)) == [(3,)]
    with pytest.raises(LookupError):
        K.read_table(spark, path, 1)
    assert K.sink_table(spark.createDataFrame([(9,)], "n int"), path) == 5


DOCUMENT = "app_id string, host string, sink string, source_name string, kind string, key string, items array<string>"


def document(app_id="a", host="h", items=("x",), key="//k", source="//s", kind="head"):
    return (app_id, host, "publish", source, kind, key, list(items) if items is not None else None)


def test_the_newest_document_is_read_once(spark, rows, tmp_path):
    path, frame = f"{tmp_path}/p", lambda docs: spark.createDataFrame(docs, DOCUMENT)
    K.publish(frame([document(items=["old"]), document("b", items=["b"]), document(key="//d", kind="input", items=["e"])]), path, 1)
    K.publish(frame([document(items=["new"]), document("c", items=["c"])]), path, 2)
    found = rows(K.read_published(spark, path), "app_id", "key", "items", "batch")
    assert found == [("a", "//d", ["e"], 1), ("a", "//k", ["new"], 2), ("b", "//k", ["b"], 1), ("c", "//k", ["c"], 2)]


def test_host_names_come_back_as_written(spark, rows, tmp_path):
    hosts = ["007", "10.10", "1e3", "2024-01-01", "true", "a b/c=d", "NULL"]
    K.publish(spark.createDataFrame([document(f"a{k}", host) for k, host in enumerate(hosts)], DOCUMENT), f"{tmp_path}/p")
    assert rows(K.read_published(spark, f"{tmp_path}/p"), "app_id", "host") == [(f"a{k}", h) for k, h in enumerate(hosts)]


def refuses_bad(host, row):
    if host == "bad":
        raise ConnectionError(f"no answer for {row.key}")


def test_failed_documents_are_kept_apart_and_published_later(spark, rows, tmp_path):
    path = f"{tmp_path}/p"
    docs = [document("a"), document("b", "bad"), document("c", None), document("d", items=None), document("e", source=None)]
    K.publish(spark.createDataFrame(docs, DOCUMENT), path, 0, refuses_bad)
    assert rows(K.read_published(spark, path), "app_id") == [("a",)]
    errors = dict(rows(K.read_failed(spark, path), "app_id", "error"))
    assert errors == {"b": "ConnectionError: no answer for //k", "c": "no host", "d": "no items", "e": "no source_name"}
    again = K.read_failed(spark, path).drop("error", "batch").where("app_id in ('b', 'd')")
    K.publish(again, path, 1)
    assert rows(K.read_published(spark, path), "app_id", "host") == [("a", "h"), ("b", "bad")]
    assert rows(K.read_failed(spark, path), "app_id", "batch") == [("c", 0), ("d", 1), ("e", 0)]


def test_no_documents(spark, tmp_path):
    path = f"{tmp_path}/p"
    K.publish(spark.createDataFrame([], DOCUMENT), path)
    assert K.read_published(spark, path).count() == 0 and K.read_failed(spark, path).count() == 0


class Calls:
    """Stands in for a reader or writer and records what is asked of it."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def load(self, *args):
        self.seen["load"] = args
        return self

    def save(self, *args):
        self.seen["save"] = args

    def jdbc(self, **arguments):
        self.seen.update(arguments)
        return self

    @property
    def read(self):
        return self

    @property
    def write(self):
        return self


@pytest.mark.parametrize(
    "call, expected",
    [
        (lambda c: readers.scan_kafka(c, "k:1", "a, b"),
         {"format": "kafka", "kafka.bootstrap.servers": "k:1", "subscribe": "a, b", "load": ()}),
        (lambda c: readers.scan_delta(c, "s3a://b/t"), {"format": "delta", "load": ("s3a://b/t",)}),
        (lambda c: readers.scan_snowflake(c, {"sfURL": "u"}, "select 1"),
         {"format": "net.snowflake.spark.snowflake", "sfURL": "u", "query": "select 1", "load": ()}),
        (lambda c: readers.scan_jdbc(c, "jdbc:x", "(select 1) v", {"user": "u"}),
         {"url": "jdbc:x", "table": "(select 1) v", "properties": {"user": "u"}}),
        (lambda c: readers.scan_jdbc(c, "jdbc:x", "t", None, readers.Split("id", 0, 100, 8)),
         {"url": "jdbc:x", "table": "t", "column": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 8,
          "properties": {}}),
        (lambda c: K.sink_jdbc(c, "jdbc:x", "t", properties={"user": "u"}),
         {"url": "jdbc:x", "table": "t", "mode": "overwrite", "properties": {"user": "u"}}),
        (lambda c: K.sink_kafka(c, "k:1", "t"), {"format": "kafka", "kafka.bootstrap.servers": "k:1", "topic": "t", "save": ()}),
        (lambda c: K.sink_delta(c, "s3a://b/t"), {"format": "delta", "mode": "overwrite", "save": ("s3a://b/t",)}),
        (lambda c: K.sink_snowflake(c, {"sfURL": "u"}, "T"),
         {"format": "net.snowflake.spark.snowflake", "sfURL": "u", "dbtable": "T", "mode": "overwrite", "save": ()}),
    ],
)
def test_connector_options(call, expected):
    calls = Calls()
    call(calls)
    assert calls.seen == expected
