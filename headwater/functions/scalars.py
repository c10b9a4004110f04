"""Scalar column functions used across the operators."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The class-name rules that decide an RDD's lineage name.
RDD_SUFFIX = r"RDD\d*$"
CAMEL_BOUNDARY = r"[\s\-_]?((?<=.)[A-Z](?=[a-z\s\-_])|(?<=[^A-Z])[A-Z]|((?<=[\s\-_])[a-z\d]))"

# Absolute http(s) URL with a host name, a local name or an IP address, and an
# optional port, path, query and fragment.
HTTP_URL = (
    r"^(?i:https?)://([^\s/?#@]*@)?"
    r"(\[[0-9A-Fa-f:.]+\]|[A-Za-z0-9]([A-Za-z0-9.-]*[A-Za-z0-9])?)"
    r"(:[0-9]{1,5})?(/[^\s?#]*)?(\?[^\s#]*)?(#\S*)?$"
)
DOUBLE_SLASH_PATH = r"^[A-Za-z]+://[^?#]*//"

UNKNOWN = "UNKNOWN"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ms_to_ts(ms: Column) -> Column:
    """Epoch milliseconds to an instant."""
    return F.timestamp_millis(ms)


def run_label(name: Column, ms: Column) -> Column:
    """``name-ms``."""
    return F.concat_ws("-", name, ms.cast("string"))


def status(error: Column) -> Column:
    """No error means success."""
    return F.when(error.isNull(), F.lit("SUCCESS")).otherwise(F.lit("FAILED"))


def camel_to_snake(class_name: Column) -> Column:
    """``MapPartitionsRDD`` to ``map_partitions``."""
    stem = F.regexp_replace(class_name, RDD_SUFFIX, "")
    return F.lower(F.regexp_replace(stem, CAMEL_BOUNDARY, "_$1"))


def arg_value(text: Column, key: str) -> Column:
    """Value of ``--key value`` up to the next `` --``; NULL if the key is absent."""
    after = F.get(F.split(text, re.escape(f"--{key} ")), F.lit(1))
    ends_there = text.endswith(f"--{key} ")
    value = F.get(F.split(after, " --"), F.lit(0))
    return F.when(ends_there & (after == ""), F.lit(None)).otherwise(value)


def is_http_url(url: Column) -> Column:
    """True for an absolute http or https URL; local host names are allowed."""
    return F.coalesce(url.rlike(HTTP_URL) & ~url.rlike(DOUBLE_SLASH_PATH), F.lit(False))


def conf_flag(value: Column, default: bool = True) -> Column:
    """Only the text ``true`` (any case) is true; an absent value is ``default``."""
    return F.coalesce(F.lower(value) == "true", F.lit(default))


def opt(options: Column, key: str, default: str | None = None) -> Column:
    """Option value by lower-case key (see :func:`lower_keys`)."""
    value = F.try_element_at(options, F.lit(key.lower()))
    return value if default is None else F.coalesce(value, F.lit(default))


def lower_keys(options: Column) -> Column:
    """The option map with lower-case keys; of equal keys the first one stays."""
    lowered = F.transform(F.map_keys(options), lambda k: F.lower(k))
    values = F.map_values(options)

    def first_wins(keys: Column) -> Column:
        unique = F.array_distinct(keys)
        firsts = F.transform(unique, lambda k: F.get(values, (F.array_position(keys, k) - 1).cast("int")))
        plain = F.map_from_arrays(keys, values)
        return F.when(F.size(unique) == F.size(keys), plain).otherwise(F.map_from_arrays(unique, firsts))

    text = F.array_join(F.map_keys(options), " ")
    return F.when(F.lower(text) == text, options).otherwise(let(lowered, first_wins))


def csv_items(text: Column, compat: bool = False) -> Column:
    """Comma list to trimmed items; blank items are dropped.

    ``compat`` keeps blank items, but for those that only commas follow.
    """
    if compat:
        kept = F.transform(F.split(F.regexp_replace(text, ",+$", ""), ","), lambda item: F.trim(item))
        return F.when(text.rlike("^,+$"), F.array().cast("array<string>")).otherwise(kept)
    items = F.transform(F.split(text, ","), lambda item: F.trim(item))
    return F.filter(items, lambda item: item != "")


def utc_ms(ts_ntz: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC; no session zone involved."""
    gap = ts_ntz - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    # an interval of days to seconds, as whole milliseconds
    return F.floor(
        F.extract(F.lit("DAY"), gap).cast("bigint") * 86_400_000
        + F.extract(F.lit("HOUR"), gap).cast("bigint") * 3_600_000
        + F.extract(F.lit("MINUTE"), gap).cast("bigint") * 60_000
        + F.floor(F.extract(F.lit("SECOND"), gap) * 1000)
    ).cast("bigint")
