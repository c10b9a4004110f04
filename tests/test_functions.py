import pytest
from pyspark.sql import functions as F

from headwater.functions import names as N
from headwater.functions import scalars as X
from headwater.functions.sqltext import jdbc_tables, sql_tables

NONE = "cast(null as string)"


@pytest.fixture(scope="module")
def value(spark):
    """The value of one column expression over literal columns a, b, c."""

    def evaluate(expression, a=None, b=None, c=None):
        df = spark.createDataFrame([(a, b, c)], "a string, b string, c string")
        return df.select(expression.alias("v")).first()["v"]

    return evaluate


A, B, C = (lambda: F.col("a")), (lambda: F.col("b")), (lambda: F.col("c"))


@pytest.mark.parametrize(
    "uri, endpoint, expected",
    [
        ("s3a://b/k/x", None, r"//s3/cloud/aws/buckets/b/keys/k\\x"),
        ("s3a://b", None, "//s3/cloud/aws/buckets/b"),
        ("s3a://b/k/", None, "//s3/cloud/aws/buckets/b/keys/k"),
        ("s3a://lake/stock", "http://minio:9000",
         "//s3-custom/endpoint/minio/buckets/lake/keys/stock"),
        ("s3a://b/k", "https://s3.us-east-1.amazonaws.com", "//s3-custom/endpoint/s3.us-east-1.amazonaws.com/buckets/b/keys/k"),
        ("s3a://b/k", "minio:9000", None),
        ("s3a://b/k", "s3.eu-west-1.amazonaws.com", None),
        ("s3a://b/k", "http://bad host", "//s3/cloud/aws/buckets/b/keys/k"),
        ("s3a://b/x//y", None, None),
        ("s3a://", None, None),
        ("s3a:///x", None, None),
        ("s3://b/k", None, None),
        ("hdfs://nn:8020/a/b", None, None),
        ("file:/a/b", None, None),
        ("/a/b", None, None),
    ],
)
def test_s3_name_of_a_plan_path(value, uri, endpoint, expected):
    assert value(N.s3_name_sql(A(), B(), C()), uri, endpoint) == expected


@pytest.mark.parametrize("uri, expected", [("s3a://b/x//y", "BAD_S3_PATH"), ("s3a://b", None), ("s3://b//c", None)])
def test_s3_errors(value, uri, expected):
    assert value(N.s3_sql_error(A()), uri) == expected


@pytest.mark.parametrize(
    "uri, endpoint, expected",
    [
        ("s3a://texts/lines.txt", "http://minio:9000",
         r"//s3-custom/endpoint/http:\\\\minio:9000/buckets/texts/keys/lines.txt"),
        ("s3://b/k", "http://minio:9000", "//s3/cloud/aws/buckets/b/keys/k"),
        ("s3a://b/k", "s3.eu-west-1.amazonaws.com", "//s3/cloud/aws/buckets/b/keys/k"),
        ("s3a://b", None, "//s3/cloud/aws/buckets/b"),
        ("s3a://b/x//y", None, r"//s3/cloud/aws/buckets/b/keys/x\\\\y"),
        ("hdfs://nn:8020/a/b", None, r"//hdfs/site/nn:8020/path/\\a\\b"),
        ("hdfs:///a", None, None),
        ("file:/a/b", None, None),
        ("/a/b", None, None),
    ],
)
def test_name_of_an_rdd_path(value, uri, endpoint, expected):
    assert value(N.uri_name(A(), B(), C()), uri, endpoint) == expected


def test_joint_s3_name_is_the_same_for_all_schemes(value):
    names = {value(N.s3_name(A(), B(), B()), f"{s}://b/x//y/", "http://minio:9000") for s in ("s3a", "s3n")}
    assert names == {r"//s3-custom/endpoint/minio:9000/buckets/b/keys/x\\y"}
    assert value(N.s3_name(A(), B(), B()), "s3://b/k") == "//s3/cloud/aws/buckets/b/keys/k"


@pytest.mark.parametrize(
    "uri, expected",
    [("http://a_b/c", "http://a_b"), ("file:/x", "file"), ("hdfs:///x", "hdfs"), ("/x", None)],
)
def test_namespace(value, uri, expected):
    assert value(N.namespace(A()), uri) == expected


MYSQL = "//mysql/host/shop-db/databases/shop/tables/"


@pytest.mark.parametrize(
    "url, table, compat, expected",
    [
        ("jdbc:mysql://shop-db:3306/shop", "buyers", False, MYSQL + "buyers"),
        ("JDBC:MYSQL://u:p@shop-db/shop?x=1", "buyers", False, MYSQL + "buyers"),
        ("jdbc:postgresql://h:5432/d", "t", False, "//postgresql/host/h/databases/d/schemas/public/tables/t"),
        ("jdbc:postgresql://h:5432/d", "s.t", False, "//postgresql/host/h/databases/d/schemas/s/tables/t"),
        ("jdbc:postgresql://h:5432/d", "s.t", True, "//postgresql/host/h/databases/d/schemas/public/tables/s.t"),
        ("jdbc:sqlserver://h:1433;databaseName=d", "t", False, None),
        (None, "t", False, None),
        ("jdbc:mysql://h?x=/a", "t", False, None),
        ("jdbc:postgresql://[::1]:5432/db", "t", False, "//postgresql/host/[::1]/databases/db/schemas/public/tables/t"),
    ],
)
def test_jdbc_name(value, url, table, compat, expected):
    assert value(N.jdbc_name(A(), B(), compat), url, table) == expected


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("select o.id from purchases o left join buyers c on c.id = o.buyer", ["purchases", "buyers"]),
        ("select * from a x, b as y, c where x.k = y.k", ["a", "b", "c"]),
        ("select * from a join a on 1 = 1", ["a"]),
        ("with c as (select * from base), d(x) as (select 1 from b2) select * from C join d on 1=1", ["base", "b2"]),
        ("select extract(year from d) from (select d from inner_t) q", ["inner_t"]),
        ("select 'from ghost', 'it''s' from t -- from hidden\n/* from x */ JOIN z on 1=1", ["t", "z"]),
        ('select * from "S"."T 2" t join `b`.`c` u on 1=1 join [d].[e] on 1=1', ["S.T 2", "b.c", "d.e"]),
        ("select * from a join b on a.x is not distinct from b.x", ["a", "b"]),
        ("select * from generate_series(1, 2) g join t on 1=1", ["t"]),
        ("select * from (select * from n1 where x in (select y from n2)) q", ["n1", "n2"]),
        ("select * from s . t", ["s.t"]),
        ("select 1", []),
        ("select * from (a join b on a.x = b.x) j", ["a", "b"]),
        ("select * from ((a join b on a.x = b.x) join c on 1 = 1)", ["c", "a", "b"]),
        ("select * from (with c as (select * from t) select * from c) q", ["t"]),
        ("select * from (select x from i) q, t", ["t", "i"]),
        ("select * from only t", ["t"]),
        ('select * from "a,b" x', ["a,b"]),
        ("select * from t1 x (c1, c2), t2", ["t1", "t2"]),
        ("select * from a cross join lateral f(a.b) z", ["a"]),
        ("select * from t tablesample (10), u", ["t", "u"]),
        ("select * from l, (values (1)) v, w", ["l", "w"]),
        ("select a from t union select b from u order by 1", ["t", "u"]),
        ("insert into o select f(x, (select max(y) from m)) from n where g(h(i(1))) > 0", ["n", "m"]),
        ("select * from a join b on a.id = b.id, c", ["a", "b", "c"]),
        ("select * from a join b using (id), c", ["a", "b", "c"]),
        ("select a, b, (select max(x), y from m, n) from t x, u", ["t", "u", "m", "n"]),
        ("select * from t1 full outer join t2 on (t1.a = t2.a), t3 order by a, b, c", ["t1", "t2", "t3"]),
        ("merge into t using s on t.a = s.a when matched then update set x = 1, y = 2", ["s"]),
        ("merge into t using (select * from s, r) q on 1 = 1", ["s", "r"]),
        ("delete from t using u where t.a = u.a", ["t", "u"]),
        ("delete from t using u join v using (id), w", ["t", "u", "v", "w"]),
        ("update t set a = 1, b = 2 from s, r where 1 = 1", ["s", "r"]),
        ("select $$ from zzz $$ from t", ["t"]),
        ("select $q$ it's from zzz $q$, $1 from t", ["t"]),
        ("select * from c, (with c as (select 1) select * from c) q", ["c"]),
        ("with t as (select * from t) select * from t", ["t"]),
        ("with recursive r as (select 1 from s union select * from r) select * from R", ["s"]),
        ("with a as materialized (select * from x), b as not materialized (select * from a, y) select * from b, a, z",
         ["z", "x", "y"]),
        ("with c(x) as (select 1 from b), d as (select * from c, e) insert into o select * from d join f on f.a in (1, 2), g",
         ["f", "g", "b", "e"]),
        ("select 1 from a; select 2 from b, c", ["a", "b", "c"]),
        ("with a as (select 1) select * from a; select * from a", ["a"]),
        ("from t select a, b", ["t"]),
        ("select * from t with (nolock), u", ["t", "u"]),
        ("select * from a left join lateral (select * from z where z.i = a.i) y on true, only k", ["a", "k", "z"]),
        ("select trim(both 'x' from y), overlay(a placing b from 1) from t", ["t"]),
        ("select * from f(1, (select 2 from h)), v", ["v", "h"]),
        ("select * from " + "(" * 30 + "select * from deep" + ")" * 30 + " q, t", ["t", "deep"]),
        ("select * from " + "(" * 30 + "a join b on 1 = 1" + ")" * 30, ["a", "b"]),
        ("select * from a)) , b", ["a", "b"]),
        ("", []),
    ],
)
def test_tables_in_sql_text(value, sql, expected):
    assert value(sql_tables(A()), sql) == expected


def test_no_sql_text(value):
    assert value(sql_tables(A()), None) is None


@pytest.mark.parametrize(
    "text, default, compat",
    [
        ("t", ["t"], []),
        ("s.t", ["s.t"], []),
        ("(select * from a) v", ["a"], ["a"]),
        ("(select count(*) from t) v", ["t"], []),
        ("(select a from t where x in (select 1) and y = 1) v", ["t"], []),
        ("select * from a join b on 1 = 1", ["a", "b"], []),
    ],
)
def test_tables_of_a_jdbc_relation(value, text, default, compat):
    assert value(jdbc_tables(A()), text) == default
    assert value(jdbc_tables(A(), compat=True), text) == compat


@pytest.mark.parametrize(
    "name, expected",
    [
        ("MapPartitionsRDD", "map_partitions"),
        ("HadoopRDD", "hadoop"),
        ("ZippedPartitionsRDD2", "zipped_partitions"),
        ("JDBCRDD", "jdbc"),
        ("SQLExecutionRDD", "sql_execution"),
        ("my-class name", "my_class_name"),
    ],
)
def test_camel_to_snake(value, name, expected):
    assert value(X.camel_to_snake(A()), name) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("{a=--k v1 --z 3}", "v1"), ("--k v w", "v w"), ("--k ", None), ("none", None), ("--k a --k b", "a ")],
)
def test_arg_value(value, text, expected):
    assert value(X.arg_value(A(), "k"), text) == expected


@pytest.mark.parametrize(
    "url, expected",
    [
        ("http://localhost:8080", True),
        ("https://c.example.com/api?x=1#f", True),
        ("ftp://x", False),
        ("http://", False),
        ("http://a//b", False),
        ("not a url", False),
        (None, False),
    ],
)
def test_url_check(value, url, expected):
    assert value(X.is_http_url(A()), url) is expected


@pytest.mark.parametrize("text, expected", [("true", True), ("TRUE", True), ("yes", False), ("", False), (None, True)])
def test_conf_flag(value, text, expected):
    assert value(X.conf_flag(A()), text) is expected


def test_scalars(value):
    assert value(X.csv_items(A()), "clicks, late_clicks") == ["clicks", "late_clicks"]
    assert value(X.csv_items(A()), " , a,,") == ["a"]
    for text, items in (("x,,y", ["x", "", "y"]), (" , a,,", ["", "a"]), (",,", []), ("", [""])):
        assert value(X.csv_items(A(), compat=True), text) == items
    assert value(X.status(A())) == "SUCCESS"
    assert value(X.status(A()), "boom") == "FAILED"
    assert value(X.run_label(A(), F.lit(0)), "app") == "app-0"
    options = F.create_map(F.lit("Topic"), A(), F.lit("TOPIC"), B())
    assert value(X.lower_keys(options), "first", "second") == {"topic": "first"}
    assert value(X.opt(X.lower_keys(options), "none", "UNKNOWN"), "x", "y") == "UNKNOWN"
    assert value(N.spark_name(A(), B(), F.lit(5)), "h/1", "job") == r"//spark/host/h\\1/jobs/job/runs/5"


def test_utc_ms_needs_no_session_zone(spark):
    query = "select timestamp_ntz'2024-01-01 00:00:07.179575' a, timestamp_ntz'1969-12-31 23:59:59.5' b"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = spark.sql(query).select(X.utc_ms(F.col("a")).alias("a"), X.utc_ms(F.col("b")).alias("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (1704067207179, -500)
