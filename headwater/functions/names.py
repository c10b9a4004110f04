r"""Canonical resource names as column expressions.

A name is ``//kind/part/value/...``. A ``/`` inside a value is written as two
backslashes, so a value never runs into the next part. A name with a missing
part is NULL (unresolved).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headwater.functions.scalars import let, opt

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?(/.*)?$"
URI_HOST = (
    r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^@/?#]*@)?"
    r"([A-Za-z0-9.\-]+|\[[0-9A-Fa-f:.]+\])(?::[0-9]*)?(?:[/?#].*)?$"
)
URI_HOST_PORT = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?(?:[^@/?#]*@)?([^/?#]+)"
# Characters, escapes and shapes that no URI may have.
BAD_URI = r"[\s<>\"{}|\\^`]|%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)|^:|^[^:/?#]+:(//)?$"
# A second "//" in what follows the scheme, with something behind it.
SECOND_SLASHES = r"^[^/]*(?:/[^/]+)*//(?://)*(?:[^/]|/(?:[^/]|$))"
JDBC_URL = r"^(?i:jdbc:(mysql|postgresql))://(?:[^@/?]*@)?(\[[0-9A-Fa-f:.]+\]|[^:/?,;\[\]]+)[^/?;]*/([^/?;]+)"

# Name kinds of the known databases, and the AWS endpoint domain.
MYSQL = "mysql"
POSTGRES = "postgresql"
AWS_DOMAIN = ".amazonaws.com"


def _blank_to_null(c: Column) -> Column:
    return let(c, lambda text: F.when(text != "", text))


def _extract(c: Column, pattern: str, group: int = 1) -> Column:
    return _blank_to_null(F.regexp_extract(c, pattern, group))


def part(value: Column) -> Column:
    """One value of a name, with ``/`` escaped."""
    return F.replace(value, F.lit("/"), F.lit("\\\\"))


def _render(kind: str, *parts: tuple[str, Column]) -> Column:
    pieces: list[Column] = [F.lit(f"//{kind}")]
    for label, value in parts:
        pieces += [F.lit(f"/{label}/"), part(value)]
    return F.concat(*pieces)


# --- URIs ------------------------------------------------------------------


def namespace(uri: Column) -> Column:
    """``scheme://authority``, or the scheme alone when there is no authority."""
    authority = _extract(uri, AUTHORITY)
    return let(_extract(uri, SCHEME), lambda scheme: F.coalesce(F.concat(scheme, F.lit("://"), authority), scheme))


def uri_path(uri: Column) -> Column:
    """What follows the authority; ``?`` and ``#`` belong to the path, as in file names."""
    return F.regexp_extract(uri, PATH, 1)


def uri_host(uri: Column) -> Column:
    return _extract(uri, URI_HOST)


def is_bad_uri(uri: Column) -> Column:
    return uri.rlike(BAD_URI)


# --- S3 and HDFS -----------------------------------------------------------


def s3_aws(bucket: Column, key: Column) -> Column:
    base = _render("s3/cloud/aws", ("buckets", bucket))
    return F.concat(base, F.coalesce(F.concat(F.lit("/keys/"), part(_blank_to_null(key))), F.lit("")))


def s3_custom(endpoint: Column, bucket: Column, key: Column) -> Column:
    base = _render("s3-custom", ("endpoint", endpoint), ("buckets", bucket))
    return F.concat(base, F.coalesce(F.concat(F.lit("/keys/"), part(_blank_to_null(key))), F.lit("")))


def _is_s3_sql(uri: Column) -> Column:
    return uri.startswith("s3a://") | uri.startswith("s3n://")


def _rest(uri: Column) -> Column:
    """What follows ``s3a://`` or ``s3n://``."""
    return F.substr(uri, F.lit(7))


def _bucket_key(rest: Column) -> tuple[Column, Column]:
    bucket = F.substring_index(rest, "/", 1)
    return _blank_to_null(bucket), F.substr(rest, F.length(bucket) + F.lit(2))


def s3_sql_error(uri: Column) -> Column:
    """``BAD_S3_PATH`` for an s3a or s3n path that cannot be split into bucket and key."""
    rest = _rest(uri)
    bad = (rest == "") | rest.startswith("/") | (rest.contains("//") & rest.rlike(SECOND_SLASHES))
    return F.when(_is_s3_sql(uri) & bad, F.lit("BAD_S3_PATH"))


def s3_name_sql(uri: Column, s3a_endpoint: Column, s3n_endpoint: Column) -> Column:
    """S3 name of a path in a query plan: s3a and s3n only.

    No endpoint, or a malformed one, means AWS. Any other endpoint is custom and
    counts with its host only, so an endpoint without a host gives no name.
    """
    endpoint = F.when(uri.startswith("s3a://"), s3a_endpoint).otherwise(s3n_endpoint)

    def name(bucket: Column, key: Column) -> Column:
        return F.when(endpoint.isNull() | is_bad_uri(endpoint), s3_aws(bucket, key)).otherwise(
            s3_custom(uri_host(endpoint), bucket, key)
        )

    named = let(F.rtrim(_rest(uri), F.lit("/")), lambda rest: name(*_bucket_key(rest)))
    return F.when(_is_s3_sql(uri) & s3_sql_error(uri).isNull(), named)


def s3_name_rdd(ns: Column, path: Column, s3a_endpoint: Column, s3n_endpoint: Column) -> Column:
    """S3 name of a path of an RDD job: s3, s3a and s3n.

    A blank or AWS endpoint means AWS; a custom one counts as its whole text.
    """
    endpoint = F.coalesce(
        F.when(ns.startswith("s3a://"), s3a_endpoint).when(ns.startswith("s3n://"), s3n_endpoint),
        F.lit(""),
    )
    bucket = F.regexp_replace(ns, "^s3[an]?://", "")
    key = F.regexp_replace(path, "^/", "")
    name = F.when((endpoint == "") | endpoint.contains(AWS_DOMAIN), s3_aws(bucket, key)).otherwise(
        s3_custom(endpoint, bucket, key)
    )
    return F.when(ns.rlike("^s3[an]?://"), name)


def s3_name(uri: Column, s3a_endpoint: Column, s3n_endpoint: Column) -> Column:
    """One S3 name for both kinds of job, for joins across jobs.

    All three schemes; an AWS endpoint means AWS; a custom endpoint counts as
    ``host[:port]``.
    """
    endpoint = F.when(uri.startswith("s3a://"), s3a_endpoint).when(uri.startswith("s3n://"), s3n_endpoint)
    rest = F.regexp_extract(uri, r"^s3[an]?://(.*)$", 1)
    plain = F.regexp_replace(F.regexp_replace(rest, "/+", "/"), "/$", "")

    def name(plain: Column, host: Column) -> Column:
        bucket = _extract(plain, "^([^/]+)")
        key = F.regexp_extract(plain, "^[^/]+/(.*)$", 1)
        return F.when(host.isNull() | host.contains(AWS_DOMAIN), s3_aws(bucket, key)).otherwise(
            s3_custom(host, bucket, key)
        )

    named = let(plain, lambda p: let(_extract(endpoint, URI_HOST_PORT), lambda host: name(p, host)))
    return F.when(uri.rlike("^s3[an]?://"), named)


def is_s3(uri: Column) -> Column:
    return uri.startswith("s3://") | uri.startswith("s3a://") | uri.startswith("s3n://")


def s3_parts(uri: Column, s3a_endpoint: Column, s3n_endpoint: Column) -> Column:
    """What an S3 path is without scheme and needless slashes, and the host of its endpoint; NULL for other paths.

    As a column of its own, from which :func:`s3_of_parts` makes the name that :func:`s3_name` gives, it is worked out once, without
    a function that Spark interprets.
    """
    endpoint = F.when(uri.startswith("s3a://"), s3a_endpoint).when(uri.startswith("s3n://"), s3n_endpoint)
    single = F.regexp_replace(F.regexp_extract(uri, r"^s3[an]?://(.*)$", 1), "/{2,}", "/")
    host = F.when(endpoint.isNotNull(), F.regexp_extract(endpoint, URI_HOST_PORT, 1))
    return F.when(is_s3(uri), F.struct(single.alias("rest"), host.alias("host")))


def s3_of_parts(parts: Column) -> Column:
    """The S3 name that :func:`s3_parts` are of."""
    rest, host = parts["rest"], parts["host"]
    bucket = F.substring_index(rest, "/", 1)
    behind = F.substr(rest, F.length(bucket) + F.lit(2))
    key = F.when(behind.endswith("/"), F.left(behind, F.length(behind) - F.lit(1))).otherwise(behind)
    base = F.when((host == "") | F.coalesce(host, F.lit(AWS_DOMAIN)).contains(AWS_DOMAIN), F.lit("//s3/cloud/aws")).otherwise(
        F.concat(F.lit("//s3-custom/endpoint/"), part(host))
    )
    keys = F.when(key != "", F.concat(F.lit("/keys/"), part(key))).otherwise(F.lit(""))
    return F.when(bucket != "", F.concat(base, F.lit("/buckets/"), part(bucket), keys))


def hdfs_name(ns: Column, path: Column) -> Column:
    """Name of an ``hdfs://site`` path; other schemes give none."""
    site = _extract(ns, "^hdfs://(.+)$")
    return _render("hdfs", ("site", site), ("path", path))


def uri_name(uri: Column, s3a_endpoint: Column, s3n_endpoint: Column) -> Column:
    """Name of an input or output path of an RDD job: S3, else HDFS, else none."""
    return name_of_path(namespace(uri), uri_path(uri), s3a_endpoint, s3n_endpoint)


def name_of_path(ns: Column, path: Column, s3a_endpoint: Column, s3n_endpoint: Column) -> Column:
    """The same from namespace and path, which are used several times and so should be columns."""
    return F.coalesce(s3_name_rdd(ns, path, s3a_endpoint, s3n_endpoint), hdfs_name(ns, path))


# --- Databases, topics, warehouses, jobs -----------------------------------


def jdbc_database(url: Column) -> Column:
    """Database name behind a MySQL or PostgreSQL URL, NULL for others."""
    host, database = _extract(url, JDBC_URL, 2), _extract(url, JDBC_URL, 3)

    def name(kind: Column) -> Column:
        named = F.concat(F.lit("//"), kind, F.lit("/host/"), part(host), F.lit("/databases/"), part(database))
        return F.when(kind.isin(MYSQL, POSTGRES), named)

    return let(F.lower(F.regexp_extract(url, JDBC_URL, 1)), name)


def jdbc_table(database: Column, table: Column, compat: bool = False) -> Column:
    """Name of a table of a database (see :func:`jdbc_database`).

    The PostgreSQL schema is ``public``. Unless ``compat``, a ``schema.table``
    text overrides it.
    """
    plain = F.concat(database, F.lit("/tables/"), part(table))
    public = F.concat(database, F.lit("/schemas/public/tables/"), part(table))
    if not compat:
        schema = F.substring_index(F.substring_index(table, ".", -2), ".", 1)
        own = F.concat(
            database, F.lit("/schemas/"), part(schema), F.lit("/tables/"), part(F.substring_index(table, ".", -1))
        )
        public = F.when(table.contains("."), own).otherwise(public)
    return F.when(database.startswith(f"//{MYSQL}/"), plain).when(database.startswith(f"//{POSTGRES}/"), public)


def jdbc_name(url: Column, table: Column, compat: bool = False) -> Column:
    """Table name behind a MySQL or PostgreSQL URL; other databases give none."""
    return let(jdbc_database(url), lambda database: jdbc_table(database, table, compat))


def jdbc_error(url: Column, database: Column | None = None) -> Column:
    """Why a JDBC URL gives no name, or NULL."""
    known = database if database is not None else jdbc_database(url)
    return F.when(url.isNull(), F.lit("MISSING_OPTION")).when(known.isNull(), F.lit("UNSUPPORTED_DATABASE"))


def kafka_name(cluster: Column, topic: Column) -> Column:
    return _render("kafka", ("cluster", cluster), ("topics", topic))


def snowflake_account(sfurl: Column) -> Column:
    """The first dotted part of the service URL."""
    return F.substring_index(sfurl, ".", 1)


def snowflake_schema(options: Column) -> Column:
    """Schema name from the ``sfurl``, ``sfdatabase`` and ``sfschema`` options."""
    return _render(
        "snowflake",
        ("account", snowflake_account(opt(options, "sfurl"))),
        ("databases", opt(options, "sfdatabase")),
        ("schemas", opt(options, "sfschema")),
    )


def snowflake_name(options: Column, table: Column) -> Column:
    return F.concat(snowflake_schema(options), F.lit("/tables/"), part(table))


def spark_name(host: Column, job: Column | None = None, run: Column | None = None) -> Column:
    """Name of a host, of a job on it, or of a run of that job."""
    parts = [("host", host)]
    if job is not None:
        parts.append(("jobs", job))
        if run is not None:
            parts.append(("runs", run.cast("string")))
    return _render("spark", *parts)
