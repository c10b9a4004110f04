r"""SQL twins of the registered queries, for DuckDB on the same tables.

Written from the derivations in ``facts`` and the rules of the names, without
maps or plan tables: each twin computes names straight from the source columns.
A ``/`` inside a name part is written as two backslashes.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _esc(value: str) -> str:
    return rf"replace({value}, '/', '\\')"


def _aws(bucket: str, key: str) -> str:
    tail = f"case when {key} = '' then '' else '/keys/' || {_esc(key)} end"
    return f"'//s3/cloud/aws/buckets/' || {_esc(bucket)} || {tail}"


def _custom(endpoint: str, bucket: str, key: str) -> str:
    tail = f"case when {key} = '' then '' else '/keys/' || {_esc(key)} end"
    return f"'//s3-custom/endpoint/' || {_esc(endpoint)} || '/buckets/' || {_esc(bucket)} || {tail}"


def _null(value: str) -> str:
    return f"nullif({value}, '')"


def _bad_s3(uri: str) -> str:
    """A second // with text behind it, or no bucket, in an s3a or s3n path."""
    rest = f"substr({uri}, 7)"
    return (
        f"(regexp_matches({uri}, '^s3[an]://') and ({rest} = '' or starts_with({rest}, '/') "
        f"or rtrim(substr({rest}, nullif(strpos({rest}, '//'), 0)), '/') <> ''))"
    )


def _s3_sql(uri: str, a: str, n: str) -> str:
    endpoint = f"(case when starts_with({uri}, 's3a:') then {a} when starts_with({uri}, 's3n:') then {n} end)"
    bucket = f"regexp_extract({uri}, '^s3[an]://([^/]+)', 1)"
    key = f"rtrim(regexp_extract({uri}, '^s3[an]://[^/]+/(.*)$', 1), '/')"
    host = _null(f"regexp_extract({endpoint}, '^[a-z]+://([^:/]+)', 1)")
    return (
        f"case when regexp_matches({uri}, '^s3[an]://') and not coalesce({_bad_s3(uri)}, false) then "
        f"case when {endpoint} is null or contains({endpoint}, ' ') then {_aws(bucket, key)} "
        f"else {_custom(host, bucket, key)} end end"
    )


def _s3_rdd(uri: str, a: str, n: str) -> str:
    endpoint = f"coalesce(case when starts_with({uri}, 's3a:') then {a} when starts_with({uri}, 's3n:') then {n} end, '')"
    bucket = f"regexp_extract({uri}, '^s3[an]?://([^/?#]+)', 1)"
    key = f"regexp_extract({uri}, '^s3[an]?://[^/]+/(.*)$', 1)"
    return (
        f"case when regexp_matches({uri}, '^s3[an]?://[^/]') then "
        f"case when {endpoint} = '' or contains({endpoint}, '.amazonaws.com') then {_aws(bucket, key)} "
        f"else {_custom(endpoint, bucket, key)} end end"
    )


def _s3_joint(uri: str, a: str, n: str) -> str:
    endpoint = f"(case when starts_with({uri}, 's3a:') then {a} when starts_with({uri}, 's3n:') then {n} end)"
    host = f"regexp_extract({endpoint}, '^(?:[a-z]+://)?([^/]+)', 1)"
    plain = f"rtrim(regexp_replace(regexp_extract({uri}, '^s3[an]?://(.*)$', 1), '/+', '/', 'g'), '/')"
    bucket = f"split_part({plain}, '/', 1)"
    key = f"regexp_extract({plain}, '^[^/]+/(.*)$', 1)"
    return (
        f"case when regexp_matches({uri}, '^s3[an]?://') then "
        f"case when {endpoint} is null or contains({host}, '.amazonaws.com') then {_aws(bucket, key)} "
        f"else {_custom(host, bucket, key)} end end"
    )


def _hdfs(uri: str) -> str:
    site = f"regexp_extract({uri}, '^hdfs://([^/?#]+)', 1)"
    path = f"regexp_extract({uri}, '^hdfs://[^/]+(/.*)$', 1)"
    return (
        f"case when regexp_matches({uri}, '^hdfs://[^/?#]') then "
        f"'//hdfs/site/' || {_esc(site)} || '/path/' || {_esc(path)} end"
    )


def _uri(uri: str, a: str, n: str, compat: bool = False) -> str:
    return f"coalesce({(_s3_rdd if compat else _s3_joint)(uri, a, n)}, {_hdfs(uri)})"


def _mysql(host: str, db: str, tab: str) -> str:
    return f"'//mysql/host/' || {host} || '/databases/' || {db} || '/tables/' || {tab}"


def _postgres(host: str, db: str, schema: str, tab: str) -> str:
    return f"'//postgresql/host/' || {host} || '/databases/' || {db} || '/schemas/' || {schema} || '/tables/' || {tab}"


def _snowflake(account: str, db: str, schema: str, tab: str) -> str:
    return f"'//snowflake/account/' || {account} || '/databases/' || {db} || '/schemas/' || {schema} || '/tables/' || {tab}"


def _kafka(cluster: str, topic: str) -> str:
    return f"'//kafka/cluster/' || {_esc(cluster)} || '/topics/' || {topic}"


# --- Shared parts -------------------------------------------------------------

APPS = """
apps as (
  select 'app-' || c_custkey as app_id, c_name as app_name, c_acctbal,
    case when c_nationkey % 5 <> 0 then 'cluster-' || (c_nationkey % 5) end as host_key,
    case c_mktsegment when 'AUTOMOBILE' then 'false' when 'BUILDING' then 'TRUE'
      when 'FURNITURE' then 'yes' when 'MACHINERY' then 'true' end as enabled,
    case c_nationkey % 4 when 0 then 'http://localhost:8080' when 1 then 'ftp://files.example.com'
      when 2 then 'https://catalog.example.com/api' end as url,
    case c_nationkey % 6 when 1 then 'http://minio:9000' when 2 then 's3.eu-west-1.amazonaws.com'
      when 3 then 'https://s3.us-east-1.amazonaws.com' when 4 then 'minio:9000' when 5 then 'http://bad host' end as s3a,
    case when c_nationkey % 2 = 1 then 'http://s3n.example.net' end as s3n
  from customer)"""

CONF = """
conf as (
  select app_id, 'spark.lineage.host.key' as key, host_key as value from apps where host_key is not null
  union all select app_id, 'spark.lineage.enabled', enabled from apps where enabled is not null
  union all select app_id, 'spark.lineage.host.url', url from apps where url is not null
  union all select app_id, 'spark.hadoop.fs.s3a.endpoint', s3a from apps where s3a is not null
  union all select app_id, 'spark.hadoop.fs.s3n.endpoint', s3n from apps where s3n is not null)"""

JOBS = """
jobs as (
  select 'app-' || (o_orderkey // 10) as app_id, o_orderkey as job_id, epoch_ms(o_orderdate) as ms,
    o_orderpriority as priority, o_orderstatus as status, o_custkey as custkey,
    o_orderpriority <> '5-LOW' as is_sql
  from orders)"""

TRIGGERS = """
triggers as (select app_id, job_id as execution_id from jobs where is_sql or status <> 'P')"""

ROLLUP = """
run as (
  select app_id, max(ms) + 3600000 as end_ms, count(*) as n_jobs, count(*) filter (status = 'F') as n_failed,
    arg_max('lost ' || priority, (ms, job_id)) filter (status = 'F') as status_reason
  from jobs group by app_id),
rollup as (
  select app_id, app_name, 694224000000 as start_ms, coalesce(end_ms, 0) as end_ms,
    coalesce(n_jobs, 0) as n_jobs, coalesce(n_failed, 0) as n_failed, status_reason,
    case when n_failed > 0 then 'FAILED' else 'SUCCESS' end as status,
    c_acctbal >= 0 and end_ms is not null as is_complete
  from apps left join run using (app_id)),
routes as (
  select app_id, coalesce(host_key, 'UNKNOWN') as host,
    case when host_key is null then 'no_host_key' when lower(coalesce(enabled, 'true')) <> 'true' then 'disabled'
      when url is null or url like 'ftp:%' then 'no_valid_url' else 'ok' end as reason
  from apps),
named as (
  select *, case when reason = 'ok' then 'publish' else 'log' end as sink,
    '//spark/host/' || host as source_name,
    '//spark/host/' || host || '/jobs/' || app_name as job_name,
    '//spark/host/' || host || '/jobs/' || app_name || '/runs/' || end_ms as run_name
  from rollup join routes using (app_id))"""

METADATA = """
metadata as (
  select app_id, key, arg_max(value, (ms, job_id)) as value from (
    select app_id, ms, job_id, 'spark.sql.execution.id' as key, job_id::varchar as value from jobs where is_sql
    union all select app_id, ms, job_id, 'spark.priority', priority from jobs where is_sql
    union all select app_id, ms, job_id, 'spark.status.' || status, job_id::varchar from jobs where is_sql
    union all select app_id, ms, job_id, 'spark.customer', custkey::varchar from jobs where is_sql)
  group by app_id, key)"""

LINES = """
lines as (
  select 'app-' || (l_orderkey // 10) as app_id, l_orderkey as execution_id, 8 * l_partkey + l_linenumber as node_id,
    l_returnflag || l_linestatus as kind, l_linenumber as num, l_partkey as p, l_suppkey as s
  from lineitem)"""


def _child_items(compat: bool = False) -> str:
    """All items of the nodes below the root: app, execution, node, item, name, error, rule."""
    ids = "l.app_id, execution_id as dep_id, node_id"
    src_host = "'src-' || (s % 4)"
    file_paths = [
        (0, "'s3a://parts-' || (p % 5) || '/' || (s % 7) || '/data'"),
        (2, "'s3n://old-' || (s % 3)"),
    ]
    files = [
        f"select {ids}, {at} as item, {(_s3_sql if compat else _s3_joint)(path, 's3a', 's3n')} as name, 'file' as rule "
        f"from lines l left join apps using (app_id) where kind = 'AF'"
        for at, path in file_paths
    ]
    files = [
        f"select *, case when name is null then 'BAD_ENDPOINT' end as error from ({text})" for text in files
    ]
    left_tab, right_tab = "'part_' || (p % 10)", "'s.supp_' || (s % 10)"
    right_pg = (
        _postgres(src_host, "'wh'", "'public'", right_tab)
        if compat
        else _postgres(src_host, "'wh'", "'s'", "'supp_' || (s % 10)")
    )

    def jdbc(at: int, tab: str, pg: str) -> str:
        return (
            f"select {ids}, {at} as item, case s % 3 when 0 then {_mysql(src_host, chr(39) + 'wh' + chr(39), tab)} "
            f"when 1 then {pg} end as name, 'jdbc' as rule, "
            f"case when s % 3 = 2 then 'UNSUPPORTED_DATABASE' end as error from lines l where kind = 'AO'"
        )

    parts = files + [jdbc(0, left_tab, _postgres(src_host, "'wh'", "'public'", left_tab)), jdbc(1, right_tab, right_pg)]
    if not compat:
        plain = _mysql("'plain'", "'wh'", "'plain_' || (p % 8)")
        parts.append(f"select {ids}, 0, {plain}, 'jdbc', null from lines l where kind = 'RO'")
    kafka = "'in-' || (s % 3) || ':9092'"
    topic_a, topic_b = "'topic_' || (p % 9)", "'supplier_' || (s % 4)"
    parts += [
        f"select {ids}, 0, {_kafka(kafka, topic_a)}, 'kafka', null from lines l where kind = 'NF' and num <> 7",
        f"select {ids}, 1, {_kafka(kafka, topic_b)}, 'kafka', null from lines l where kind = 'NF' and num <> 7",
        f"select {ids}, 0, null, 'kafka', 'MISSING_OPTION' from lines l where kind = 'NF' and num = 7",
    ]

    def snow(tab: str) -> str:
        return _snowflake("'acct' || (s % 5)", "'DB'", "'PUBLIC'", tab)

    warehouse, location, direct = "'WH_' || (p % 6)", "'LOC_' || (s % 6)", "'DIRECT_' || (p % 3)"
    parts += [
        f"select {ids}, 0, {snow(warehouse)}, 'snowflake', null from lines l where kind = 'NO' and num > 1",
        f"select {ids}, 1, {snow(location)}, 'snowflake', null from lines l where kind = 'NO' and num > 1",
    ]
    if compat:
        parts.append(f"select {ids}, 0, null, 'snowflake', 'MISSING_OPTION' from lines l where kind = 'NO' and num = 1")
    else:
        parts.append(f"select {ids}, 0, {snow(direct)}, 'snowflake', null from lines l where kind = 'NO' and num = 1")
    parts.append(
        f"select {ids}, 0, null, 'catalog', 'UNSUPPORTED_RELATION' from lines l where kind = 'RF' and num >= 6"
    )
    return "children as (" + "\nunion all by name ".join(
        f"select app_id, dep_id, node_id, item, name, rule, error from ({text}) t(app_id, dep_id, node_id, item, name, rule, error)"
        for text in parts
    ) + ")"


def _root_items(compat: bool = False) -> str:
    """Items of the roots: inputs of plain relations, outputs of writes."""
    s3 = _s3_sql if compat else _s3_joint
    ids = "j.app_id, job_id as dep_id, 0 as node_id"
    low = [
        (0, "'s3a://low-' || (custkey % 3) || '/x'"),
        (1, "'s3n://low/y'"),
    ]
    low_inputs = [
        f"select {ids}, {at}, {s3(path, 's3a', 's3n')}, 'file', "
        f"case when {s3(path, 's3a', 's3n')} is null then 'BAD_ENDPOINT' end, 'input' "
        f"from jobs j left join apps using (app_id) where not is_sql and status = 'F'"
        for at, path in low
    ]
    low_kafka = _kafka("'broker-low:9092'", "'low'")
    low_inputs.append(f"select {ids}, 0, {low_kafka}, 'kafka', null, 'input' from jobs j where not is_sql and status = 'P'")
    lake = "'s3a://lake-' || (custkey % 3) || '/orders/' || (job_id % 4)"
    lake_name = s3(lake, "s3a", "s3n")
    slashes = s3("'s3a://lake//bad'", "s3a", "s3n")
    delta = [
        f"select {ids}, 0, {lake_name}, 'delta', case when {lake_name} is null then 'BAD_ENDPOINT' end, 'output' "
        "from jobs j left join apps using (app_id) where priority = '1-URGENT' and status = 'O' and custkey % 2 = 0",
        f"select {ids}, 0, {slashes}, 'delta', {repr('BAD_S3_PATH') if compat else 'null'}, 'output' "
        "from jobs j left join apps using (app_id) where priority = '1-URGENT' and status = 'F'",
        f"select {ids}, 0, null, 'jdbc', 'MISSING_OPTION', 'output' from jobs j where priority = '1-URGENT' and status = 'P'",
    ]
    topic = "case when status = 'P' then 'UNKNOWN' else 'orders_' || status end"
    kafka_name = _kafka("'broker-' || (custkey % 7) || ':9092'", topic)
    snow_name = _snowflake(
        "'acct' || (custkey % 5)", "'DB'", "'SC_' || status",
        "case when status = 'P' then 'UNKNOWN' else 'ORDERS_' || (custkey % 4) end",
    )
    tab = "case when status = 'F' then 'audit.orders' else 'orders_' || status end"
    # a text with a dot names schema and table, but not for the original rules
    pg_schema = "'public'" if compat else "case when status = 'F' then 'audit' else 'public' end"
    pg_tab = tab if compat else "case when status = 'F' then 'orders' else 'orders_' || status end"
    jdbc_name = (
        f"case custkey % 4 when 0 then {_mysql(chr(39) + 'my-' + chr(39) + ' || (custkey % 3)', chr(39) + 'shop' + chr(39), tab)} "
        f"when 1 then {_postgres(chr(39) + 'pg-' + chr(39) + ' || (custkey % 3)', chr(39) + 'shop' + chr(39), pg_schema, pg_tab)} end"
    )
    outputs = delta + [
        f"select {ids}, 0, {kafka_name}, 'kafka', null, 'output' from jobs j where priority = '2-HIGH'",
        f"select {ids}, 0, {snow_name}, 'snowflake', null, 'output' from jobs j where priority = '3-MEDIUM'",
        f"select {ids}, 0, {jdbc_name}, 'jdbc', case custkey % 4 when 2 then 'UNSUPPORTED_DATABASE' when 3 then 'MISSING_OPTION' end, "
        "'output' from jobs j where priority = '4-NOT SPECIFIED'",
    ]
    return "roots as (" + "\nunion all ".join(
        f"select app_id, dep_id, node_id, item, name, rule, error, direction from ({text}) "
        "t(app_id, dep_id, node_id, item, name, rule, error, direction)"
        for text in low_inputs + outputs
    ) + ")"


ITEM_COLUMNS = "app_id, dep_id, direction, node_id, item, name, error"


def _all_items() -> str:
    return (
        f"items as (select {ITEM_COLUMNS} from (select *, 'input' as direction from children) "
        f"union all select {ITEM_COLUMNS} from roots)"
    )


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


PLAN = _with(APPS, JOBS, LINES, _child_items(), _root_items(), _all_items())
PLAN_COMPAT = _with(APPS, JOBS, LINES, _child_items(compat=True), _root_items(compat=True), _all_items())

DEPTH = """
steps as (
  select *, lag(num, 1) over w as one, lag(num, 2) over w as two, lag(num, 3) over w as three
  from (select distinct l_orderkey as job_id, l_linenumber as num from lineitem)
  window w as (partition by job_id order by num)),
edge as (
  select job_id, num, two as dep, 0 as pos from steps where two is not null
  union all select job_id, num, three, 1 from steps where three is not null),
closure as (
  select job_id, max(num) as num from steps group by job_id
  union select e.job_id, e.dep from closure c join edge e on e.job_id = c.job_id and e.num = c.num)"""

SCANS = """
scans as (
  select 'app-' || (job_id // 10) as app_id, job_id, num,
    case job_id % 5 when 0 then 's3a://raw-' when 1 then 's3://raw-' when 2 then 'hdfs://nn:8020/raw-'
      when 3 then 'file:/tmp/raw-' else 's3n://raw-' end || (job_id % 7) || '/' || num as base
  from steps where two is null),
paths as (select app_id, job_id, num, 0 as item, base as path from scans
  union all select app_id, job_id, num, 1, base || '/more' from scans)"""

OUTS = """
outs as (
  select app_id, job_id, coalesce(
    case when custkey % 3 = 0 then 's3a://out/' || (custkey % 10) end,
    case custkey % 4 when 1 then 'hdfs://nn/out/' || (custkey % 10) when 2 then 'file:/tmp/out'
      when 3 then 's3://out/new/' || (custkey % 10) end) as path
  from jobs where status <> 'P')"""


def _order_items(coarse: bool) -> str:
    part, supplier = ("l_partkey % 3", "l_suppkey % 2") if coarse else ("l_partkey", "l_suppkey")
    return f"""
oitems as (
  select 'app-' || o_custkey as app_id, l_orderkey as dep_id, 8 * l_partkey + l_linenumber as node_id,
    'part-' || ({part}) as i, 'supp-' || ({supplier}) as o
  from lineitem join orders on l_orderkey = o_orderkey),
lists as (
  select app_id, dep_id, list(i order by node_id, i) as ins, list(o order by node_id, o) as outs
  from oitems group by app_id, dep_id),
kept as (select app_id, min(dep_id) as dep_id, ins, outs from lists group by app_id, ins, outs)"""


# --- Rollups ------------------------------------------------------------------

ORACLE["lineage_summary"] = _with(_order_items(False)) + """
, ins as (select app_id, count(*) as n, count(distinct x) as d from (select app_id, unnest(ins) as x from kept) group by app_id),
outs as (select app_id, count(*) as n, count(distinct x) as d from (select app_id, unnest(outs) as x from kept) group by app_id),
runs as (
  select 'app-' || o_custkey as app_id, max(epoch_ms(o_orderdate)) as end_ms, max(o_orderdate) as end_at,
    count(*) filter (o_orderstatus = 'F') as n_failed,
    arg_max(o_orderpriority, (o_orderdate, o_orderkey)) filter (o_orderstatus = 'F') as status_reason
  from orders group by o_custkey)
select app_id, '//spark/host/orders/jobs/' || app_id || '/runs/' || end_ms as run_name,
  app_id || '-' || end_ms as run_label, strftime(end_at, '%Y-%m-%dT%H:%M:%S.%g') as end_time,
  case when n_failed > 0 then 'FAILED' else 'SUCCESS' end as status, status_reason, n_failed,
  coalesce(ins.n, 0) as n_inputs, coalesce(ins.d, 0) as n_input_datasets,
  coalesce(outs.n, 0) as n_outputs, coalesce(outs.d, 0) as n_output_datasets
from runs left join ins using (app_id) left join outs using (app_id)"""

ORACLE["run_status"] = """
select 'app-' || o_custkey as app_id, max(epoch_ms(o_orderdate)) as end_ms,
  count(*) filter (o_orderstatus = 'F') as n_failed,
  arg_max(o_orderpriority, (o_orderdate, o_orderkey)) filter (o_orderstatus = 'F') as status_reason,
  case when count(*) filter (o_orderstatus = 'F') > 0 then 'FAILED' else 'SUCCESS' end as status
from orders group by o_custkey"""

ORACLE["end_times"] = _with(APPS, JOBS) + """
select app_id, coalesce(max(ms) + 3600000, 0) as end_ms
from (select app_id from apps union select app_id from jobs) left join jobs using (app_id) group by app_id"""

USER_STARTS = """
starts as (
  select 'user-' || user_id as app_id, event_id, epoch_us(ts) // 1000 as ms, event_type as kind, props->>'$.k' as k
  from events where event_type not in ('error', 'purchase')
    and not (event_type = 'signup' and (props->>'$.k')::int >= 70)),
meta as (
  select app_id, key, arg_max(value, (ms, event_id)) as value from (
    select app_id, ms, event_id, kind as key, k as value from starts
    union all select app_id, ms, event_id, 'spark.sql.execution.id', event_id::varchar from starts)
  group by app_id, key)"""

ORACLE["metadata_last_wins"] = _with(USER_STARTS) + "select app_id, key, value from meta"
ORACLE["stream_metadata"] = ORACLE["metadata_last_wins"]

USER_ENDS = """
ended as (select distinct 'user-' || user_id as app_id from events
  where event_type = 'signup' and (props->>'$.k')::int >= 70),
uruns as (
  select 'user-' || user_id as app_id,
    coalesce(max(epoch_us(ts) // 1000) filter (event_type in ('error', 'purchase')), 0) as end_ms,
    count(*) filter (event_type = 'error') as n_failed,
    arg_max('k=' || (props->>'$.k'), (epoch_us(ts) // 1000, event_id)) filter (event_type = 'error') as status_reason,
    case when count(*) filter (event_type = 'error') > 0 then 'FAILED' else 'SUCCESS' end as status
  from events group by user_id)"""

ORACLE["stream_rollup"] = _with(USER_ENDS) + "select app_id, end_ms, n_failed, status_reason, status from uruns"
ORACLE["stream_flush"] = _with(USER_ENDS) + (
    "select app_id, end_ms, n_failed, status_reason, status from uruns semi join ended using (app_id)"
)
ORACLE["stream_flush_metadata"] = _with(USER_STARTS, USER_ENDS) + (
    "select app_id, key, value from meta semi join ended using (app_id)"
)

SLICED = """
sliced as (
  select 'user-' || user_id as app_id, event_id, event_type as kind, props->>'$.k' as k,
    epoch_us(ts) // 1000 - case when user_id % 10 = 3 then 120 * 86400000::bigint else 0 end as ms,
    least(date_diff('day', date '2024-01-01', cast(ts as date)) // 10, 2) + user_id % 2 as slice,
    event_type = 'signup' and (props->>'$.k')::int >= 70 as is_end
  from events),
reported as (select app_id, min(slice) as slice from sliced where is_end group by app_id),
upto as (select s.* from sliced s join reported r on s.app_id = r.app_id and s.slice <= r.slice)"""


def _sliced_runs(rows: str) -> str:
    return f"""
select app_id, coalesce(max(ms) filter (kind in ('error', 'purchase')), 0) as end_ms,
  count(*) filter (kind = 'error') as n_failed,
  arg_max('k=' || k, (ms, event_id)) filter (kind = 'error') as status_reason,
  case when count(*) filter (kind = 'error') > 0 then 'FAILED' else 'SUCCESS' end as status
from {rows} group by app_id"""


ORACLE["stream_rollup_slices"] = _with(SLICED) + _sliced_runs("sliced")
ORACLE["stream_flush_slices"] = _with(SLICED) + _sliced_runs("upto")
ORACLE["stream_flush_slices_metadata"] = _with(SLICED) + """
select app_id, key, arg_max(value, (ms, event_id)) as value from (
  select app_id, ms, event_id, kind as key, k as value from upto where kind not in ('error', 'purchase') and not is_end
  union all select app_id, ms, event_id, 'spark.sql.execution.id', event_id::varchar
  from upto where kind not in ('error', 'purchase') and not is_end)
group by app_id, key"""
ORACLE["merged_deps"] = """
with t as (
  select 'app-' || o_custkey as app_id, l_orderkey, 8 * l_partkey + l_linenumber as node_id,
    'part-' || l_partkey as i, 'supp-' || l_suppkey as o
  from lineitem join orders on l_orderkey = o_orderkey)
select app_id, 'input' as direction, row_number() over (partition by app_id order by l_orderkey, node_id, i) - 1 as pos, i as name from t
union all
select app_id, 'output', row_number() over (partition by app_id order by l_orderkey, node_id, o) - 1, o from t"""

ORACLE["deps_distinct"] = _with(_order_items(True)) + """
select app_id, dep_id, 'input' as direction, node_id, i as name from oitems semi join kept using (app_id, dep_id)
union all select app_id, dep_id, 'output', node_id, o from oitems semi join kept using (app_id, dep_id)"""

ORACLE["app_lineage"] = _with(_order_items(True)) + """
select app_id, 'input' as direction, name, count(*) as n from (select app_id, unnest(ins) as name from kept) group by app_id, name
union all
select app_id, 'output', name, count(*) from (select app_id, unnest(outs) as name from kept) group by app_id, name"""

ORACLE["app_datasets"] = _with(_order_items(False)) + """
select distinct app_id, 'input' as direction, i as name, 1 as n from oitems
union all select distinct app_id, 'output', o, 1 from oitems"""

ORACLE["rollup_apps"] = _with(APPS, JOBS, ROLLUP) + (
    "select app_id, app_name, start_ms, end_ms, n_jobs, n_failed, status_reason, status, is_complete from rollup"
)

# --- Routing ------------------------------------------------------------------

ORACLE["classify_jobs"] = _with(JOBS) + """
select app_id, job_id, ms as event_ms, case when is_sql then 'sql' else 'rdd' end as job_kind,
  case when is_sql then job_id end as execution_id from jobs"""

ORACLE["sql_triggers"] = _with(JOBS, TRIGGERS) + "select app_id, execution_id from triggers"

ORACLE["matched_plans"] = _with(JOBS, TRIGGERS, LINES) + """
select app_id, execution_id, node_id, node_kind, relation_kind from (
  select app_id, job_id as execution_id, 0 as node_id,
    case when is_sql then 'SaveIntoDataSourceCommand' when status = 'O' then 'Project' else 'LogicalRelation' end as node_kind,
    case when is_sql or status = 'O' then null when status = 'F' then 'HadoopFsRelation' else 'KafkaRelation' end as relation_kind
  from jobs
  union all
  select app_id, execution_id, node_id,
    case when kind = 'RF' and num < 6 then 'Filter' else 'LogicalRelation' end,
    case kind when 'AF' then 'HadoopFsRelation' when 'AO' then 'JDBCRelation' when 'NF' then 'KafkaRelation'
      when 'NO' then 'SnowflakeRelation' when 'RO' then 'JDBCRelation' else case when num >= 6 then 'HiveTableRelation' end end
  from lines) join triggers using (app_id, execution_id)"""

ORACLE["skipped_jobs"] = _with(JOBS, TRIGGERS) + """
select app_id, execution_id from triggers where execution_id not in (select l_orderkey from lineitem)"""

ORACLE["rdd_jobs"] = _with(JOBS, DEPTH.replace("closure as", "unused as").split("unused as")[0].rstrip().rstrip(",")) + """
select j.app_id, job_id, num as rdd_id,
  case when two is null then 'HadoopRDD' when num % 2 = 0 then 'MapPartitionsRDD' else 'ShuffledRDD' end as rdd_class
from steps join jobs j using (job_id) where not is_sql"""

# --- Configuration ------------------------------------------------------------

ORACLE["conf_entries"] = _with(APPS, CONF) + "select app_id, key, value from conf"

ORACLE["conf_lookup"] = _with(APPS, JOBS) + (
    "select app_id, job_id, coalesce(s3a, 'none') as endpoint from jobs left join apps using (app_id)"
)

ORACLE["conf_flags"] = _with(APPS) + """
select app_id, lower(coalesce(enabled, 'true')) = 'true' as enabled from apps
where enabled is not null or host_key is not null"""

ORACLE["route_apps"] = _with(APPS, JOBS, ROLLUP) + "select app_id, host, sink, reason from named"

# --- Plan extraction ----------------------------------------------------------

ROOT_RULE = """case when is_sql then 'write' when status = 'F' then 'file' when status = 'P' then 'kafka' end"""

ORACLE["classify_nodes"] = _with(JOBS, LINES) + f"""
select app_id, job_id as execution_id, 0 as node_id, {ROOT_RULE} as rule from jobs
union all
select app_id, execution_id, node_id,
  case kind when 'AF' then 'file' when 'AO' then 'jdbc' when 'NF' then 'kafka' when 'NO' then 'snowflake'
    when 'RO' then 'jdbc' else case when num >= 6 then 'catalog' end end from lines"""

ORACLE["classify_roots"] = _with(JOBS) + f"select app_id, job_id as execution_id, {ROOT_RULE} as rule from jobs"

ORACLE["plan_items"] = PLAN + f"select {ITEM_COLUMNS} from items"
ORACLE["write_inputs"] = PLAN + f"select {ITEM_COLUMNS} from items where direction = 'input'"
ORACLE["extract_errors"] = PLAN + (
    "select app_id, dep_id, direction, node_id, item, error as extract_error from items where error is not null"
)
ORACLE["write_inputs_root_only"] = PLAN + f"""
select {ITEM_COLUMNS} from items where direction = 'input' and (node_id = 0 or dep_id in (select job_id from jobs where is_sql))"""

ORACLE["plan_items_compat"] = PLAN_COMPAT + f"""
, seen as (
  select * from items where direction = 'output' or node_id = 0 or dep_id in (select job_id from jobs where is_sql)),
lost as (
  select distinct dep_id from seen
  where direction = 'input' and error in ('UNSUPPORTED_RELATION', 'MISSING_OPTION', 'BAD_S3_PATH'))
select {ITEM_COLUMNS} from seen
where direction = 'output' or error is not null or dep_id not in (select dep_id from lost)"""


def _rule_inputs(rule: str, plan: str = PLAN) -> str:
    return plan + f"""
select {ITEM_COLUMNS} from (
  select *, 'input' as direction from children where rule = '{rule}'
  union all by name select * from roots where rule = '{rule}' and direction = 'input')"""


def _rule_outputs(rule: str, plan: str = PLAN) -> str:
    return plan + f"select {ITEM_COLUMNS} from roots where rule = '{rule}' and direction = 'output'"


ORACLE["file_inputs"] = _rule_inputs("file")
ORACLE["jdbc_inputs"] = _rule_inputs("jdbc")
ORACLE["jdbc_inputs_compat"] = _rule_inputs("jdbc", PLAN_COMPAT)
ORACLE["file_inputs_compat"] = _rule_inputs("file", PLAN_COMPAT)
ORACLE["kafka_inputs"] = _rule_inputs("kafka")
ORACLE["kafka_inputs_compat"] = _rule_inputs("kafka", PLAN_COMPAT)
ORACLE["snowflake_inputs"] = _rule_inputs("snowflake")
ORACLE["delta_outputs"] = _rule_outputs("delta")
ORACLE["kafka_outputs"] = _rule_outputs("kafka")
ORACLE["snowflake_outputs"] = _rule_outputs("snowflake")
ORACLE["jdbc_outputs"] = _rule_outputs("jdbc")
ORACLE["jdbc_outputs_compat"] = _rule_outputs("jdbc", PLAN_COMPAT)
ORACLE["delta_outputs_compat"] = _rule_outputs("delta", PLAN_COMPAT)
ORACLE["unsupported_relations"] = PLAN + """
select app_id, dep_id, 'input' as direction, node_id, item, error as extract_error from children where rule = 'catalog'"""

ORACLE["custom_rule"] = (
    _with(
        "apps as (select null::varchar as app_id, null::varchar as s3a, null::varchar as s3n where false)",
        JOBS,
        LINES,
        _child_items(),
        _root_items(),
    )
    + """
, named as (
  select app_id, name from children where name is not null or error is not null
  union all select app_id, name from roots where direction = 'input'
  union all select app_id, '//step/' || node_id from lines where kind = 'RF' and num < 6)
select app_id, starts_with(name, '//step/') as is_step, count(*) as n, max(name) as last_name
from named group by app_id, is_step"""
)

# --- Names --------------------------------------------------------------------

PART_URIS = """
with u as (
  select p_partkey,
    case p_size % 5 when 0 then 's3a://' when 1 then 's3n://' when 2 then 's3://' when 3 then 'hdfs://' else 'file:/' end
    || replace(lower(p_brand), '#', '_')
    || case p_size % 4 when 0 then '' when 1 then '/' when 2 then '/' || p_type || '/' || p_partkey
         else '/' || p_type || '//' || p_partkey end as uri,
    case p_size % 6 when 1 then 'http://minio:9000' when 2 then 's3.eu-west-1.amazonaws.com'
      when 3 then 'https://s3.us-east-1.amazonaws.com' when 4 then 'minio:9000' when 5 then 'http://bad host' end as s3a,
    case when p_size % 7 < 3 then 'https://s3n.example.net:444/' end as s3n
  from part)
"""

ORACLE["s3_names"] = PART_URIS + f"""
select p_partkey, {_s3_sql('uri', 's3a', 's3n')} as sql_name,
  case when {_bad_s3('uri')} then 'BAD_S3_PATH' end as sql_error,
  {_s3_joint('uri', 's3a', 's3n')} as joint_name from u"""
ORACLE["s3_names_rdd"] = PART_URIS + f"select p_partkey, {_s3_rdd('uri', 's3a', 's3n')} as rdd_name from u"

PAGE_URIS = """
with u as (
  select page_id, case page_id % 6 when 0 then url when 1 then regexp_replace(url, '^https?:', 's3a:')
    when 2 then regexp_replace(url, '^https?:', 'hdfs:') when 3 then regexp_replace(url, '^https?://', 'file:/')
    when 4 then regexp_replace(url, '^https?:', 's3:') else regexp_replace(url, '^https?://', '/') end as uri
  from pages)
"""

ORACLE["namespaces"] = PAGE_URIS + f"""
select page_id, coalesce({_null("regexp_extract(uri, '^[a-z0-9]+://[^/?#]+')")}, {_null("regexp_extract(uri, '^([a-z0-9]+):', 1)")}) as namespace from u"""
ORACLE["hdfs_names"] = PAGE_URIS + f"select page_id, {_hdfs('uri')} as name from u"
PAGE_ENDPOINT = "case when page_id % 4 = 1 then 'http://minio:9000' end"
ORACLE["uri_names"] = PAGE_URIS + f"select page_id, {_uri('uri', PAGE_ENDPOINT, 'null', compat=True)} as name from u"
ORACLE["url_checks"] = "select page_id, page_id % 8 in (0, 2) as ok from pages"

ORACLE["jdbc_names"] = f"""
with t as (
  select s_suppkey, n_name, n_regionkey as r, case when s_suppkey % 2 = 0 then 't' || s_suppkey else 'sc.t' || s_suppkey end as tab
  from supplier left join nation on s_nationkey = n_nationkey)
select s_suppkey,
  case r when 0 then {_mysql('n_name', "'db'", 'tab')} when 2 then {_mysql('n_name', "'db'", 'tab')}
    when 1 then {_postgres('n_name', "'db'", "case when s_suppkey % 2 = 0 then 'public' else 'sc' end", "'t' || s_suppkey")} end as name,
  case r when 0 then {_mysql('n_name', "'db'", 'tab')} when 2 then {_mysql('n_name', "'db'", 'tab')}
    when 1 then {_postgres('n_name', "'db'", "'public'", 'tab')} end as compat_name,
  case when r is null then 'MISSING_OPTION' when r >= 3 then 'UNSUPPORTED_DATABASE' end as error
from t"""

# the names that each shape of statement was made of
ORACLE["sql_tables_of_text"] = """
with t as (
  select p_partkey, case p_partkey % 22
    when 0 then ['part_' || p_size, 'supplier_' || (p_partkey % 9)] when 1 then ['dim_' || lower(split_part(p_type, ' ', 1)), 'base_' || p_size]
    when 2 then ['t1_' || p_size, 't2_' || p_size] when 3 then ['inner_' || p_size]
    when 4 then ['real_' || p_size, 'db.other_' || p_size] when 5 then ['S' || p_size || '.T', 'b.c']
    when 6 then ['a' || p_size, 'b'] when 7 then ['t' || p_size] when 8 then ['t', 'i' || p_size]
    when 9 then ['t' || p_size] when 10 then ['a,' || p_size] when 11 then ['t1', 't' || p_size]
    when 12 then ['t' || p_size, 'u'] when 13 then ['l' || p_size, 'w']
    when 14 then ['a' || p_size, 'b', 'c' || (p_partkey % 5)] when 15 then ['a' || p_size, 'b', 'c'] when 16 then ['s' || p_size]
    when 17 then ['t' || p_size, 'u', 'v' || p_size] when 18 then ['c', 'd' || p_size] when 19 then ['t' || p_size]
    when 20 then ['after_all', 'deep' || p_size] else ['s' || p_size] end as names
  from part)
select p_partkey, array_to_string(list_distinct_in_order, ',') as tables, len(list_distinct_in_order)::int as n_tables
from (select p_partkey, list_filter(names, lambda x, i: list_position(names, x) = i) as list_distinct_in_order from t)"""

ORACLE["snake_names"] = r"""
with t as (
  select p_partkey, p_type[1] || lower(p_type[2:]) || case p_size % 5 when 0 then 'Partitions' when 1 then 'JDBC'
      when 2 then 'Co' when 3 then 'SQLScan' else 'X1Y' end
    || case p_size % 3 when 0 then 'RDD' when 1 then 'RDD' || p_size else '' end as c
  from part)
select p_partkey, lower(regexp_replace(regexp_replace(regexp_replace(c, 'RDD\d*$', ''), '([a-z0-9])([A-Z])', '\1_\2', 'g'),
  '([A-Z])([A-Z][a-z])', '\1_\2', 'g')) as name from t"""

ORACLE["arg_values"] = """
select page_id, url as arg_url,
  case when page_id % 2 = 0 then page_id::varchar else page_id || '}' end as arg_id,
  case when page_id % 2 = 0 then 'word}' end as arg_last, null::varchar as arg_none
from pages"""

ORACLE["run_names"] = r"""
select o_orderkey, '//spark/host/host\\' || o_orderstatus as source_name,
  '//spark/host/host\\' || o_orderstatus || '/jobs/job ' || o_custkey as job_name,
  '//spark/host/host\\' || o_orderstatus || '/jobs/job ' || o_custkey || '/runs/' || epoch_ms(o_orderdate) as run_name,
  'job ' || o_custkey || '-' || epoch_ms(o_orderdate) as run_label,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') as end_time,
  case when o_orderstatus = 'F' then 'FAILED' else 'SUCCESS' end as status
from orders"""

# --- RDD graphs ---------------------------------------------------------------

RECURSIVE = "with recursive "

ORACLE["rdd_ancestors"] = RECURSIVE + DEPTH + (
    "select 'app-' || (job_id // 10) as app_id, job_id, num as rdd_id from closure"
)
ORACLE["rdd_input_paths"] = RECURSIVE + DEPTH + "," + SCANS + (
    "select app_id, job_id, num as rdd_id, item, path from paths"
)
for _name, _compat in (("", False), ("_compat", True)):
    ORACLE[f"rdd_inputs{_name}"] = RECURSIVE + ",".join([DEPTH, SCANS, APPS]) + f"""
select app_id, job_id as dep_id, num as node_id, item, name from (
  select p.*, {_uri('path', 's3a', 's3n', _compat)} as name
  from paths p semi join closure using (job_id, num) left join apps using (app_id))
where name is not null"""
    ORACLE[f"rdd_outputs{_name}"] = _with(JOBS, APPS, OUTS) + f"""
select app_id, job_id as dep_id, name from (
  select o.*, {_uri('path', 's3a', 's3n', _compat)} as name from outs o left join apps using (app_id))
where name is not null"""

_LEVELS = 4  # seven steps, two back at a time
_level_sql = [
    """
own as (
  select s.job_id, s.num, s.two, s.three,
    case when s.two is null then 'hadoop'
      when s.num % 3 = 0 and not (s.num % 2 = 0 and parent.two is not null and parent.num % 3 = 0) then 'step'
      when s.num % 2 = 0 then 'map_partitions' else 'shuffled' end as own_name
  from steps s left join steps parent on parent.job_id = s.job_id and parent.num = s.two),
name0 as (select job_id, num, own_name as name from own where two is null)"""
]
for _n in range(1, _LEVELS):
    _level_sql.append(
        f"""
name{_n} as (
  select * from name{_n - 1} union all
  select job_id, num, case when starts_with(deps, own_name) then deps else own_name || '_' || deps end from (
    select o.job_id, o.num, own_name, a.name || coalesce('_' || b.name, '') as deps
    from own o join name{_n - 1} a on a.job_id = o.job_id and a.num = o.two
      left join name{_n - 1} b on b.job_id = o.job_id and b.num = o.three
    where (o.three is null or b.name is not null)
      and not exists (select 1 from name{_n - 1} d where d.job_id = o.job_id and d.num = o.num)))"""
    )
ORACLE["rdd_names"] = RECURSIVE + DEPTH + "," + ",".join(_level_sql) + (
    f"select 'app-' || (job_id // 10) as app_id, job_id, num as rdd_id, name from name{_LEVELS - 1}"
)

# the same without step 2: an edge to it counts as none
_present_sql = [
    """
own as (
  select s.job_id, s.num, nullif(s.two, 2) as d1, nullif(s.three, 2) as d2,
    case when s.two is null then 'hadoop'
      when s.num % 3 = 0 and not (s.num % 2 = 0 and parent.two is not null and parent.num % 3 = 0) then 'step'
      when s.num % 2 = 0 then 'map_partitions' else 'shuffled' end as own_name
  from steps s left join steps parent on parent.job_id = s.job_id and parent.num = s.two and parent.num <> 2
  where s.num <> 2),
name0 as (select job_id, num, own_name as name from own where d1 is null and d2 is null)"""
]
for _n in range(1, _LEVELS):
    _present_sql.append(
        f"""
name{_n} as (
  select * from name{_n - 1} union all
  select job_id, num, case when starts_with(deps, own_name) then deps else own_name || '_' || deps end from (
    select o.job_id, o.num, own_name, concat_ws('_', a.name, b.name) as deps
    from own o left join name{_n - 1} a on a.job_id = o.job_id and a.num = o.d1
      left join name{_n - 1} b on b.job_id = o.job_id and b.num = o.d2
    where (o.d1 is null or a.name is not null) and (o.d2 is null or b.name is not null)
      and not exists (select 1 from name{_n - 1} d where d.job_id = o.job_id and d.num = o.num)))"""
    )
ORACLE["rdd_names_dangling"] = RECURSIVE + DEPTH + "," + ",".join(_present_sql) + (
    f"select 'app-' || (job_id // 10) as app_id, job_id, num as rdd_id, name from name{_LEVELS - 1}"
)

# --- Documents ----------------------------------------------------------------


def _lineage(compat: bool) -> str:
    items = "items"
    seen = ""
    if compat:
        items = "kept"
        seen = """
seen as (
  select * from items where direction = 'output' or node_id = 0 or dep_id in (select job_id from jobs where is_sql)),
lost as (
  select distinct dep_id from seen
  where direction = 'input' and error in ('UNSUPPORTED_RELATION', 'MISSING_OPTION', 'BAD_S3_PATH')),
kept as (select * from seen where direction = 'output' or error is not null or dep_id not in (select dep_id from lost)),"""
    uri = _uri("path", "s3a", "s3n", compat)
    return (
        RECURSIVE
        + ",".join([APPS, JOBS, TRIGGERS, LINES, ROLLUP, METADATA, DEPTH, SCANS, OUTS])
        + ",\n"
        + ",\n".join([_child_items(compat), _root_items(compat), _all_items()])
        + f""",{seen}
rdd_items as (
  select app_id, 2 * job_id + 1 as dep_id, 'input' as direction, num as node_id, item, {uri} as name
  from paths p semi join closure using (job_id, num) semi join (select job_id from jobs where not is_sql) using (job_id)
    left join apps using (app_id)
  union all
  select app_id, 2 * job_id + 1, 'output', 0, 0, {uri}
  from outs semi join (select job_id from jobs where not is_sql) using (job_id) left join apps using (app_id)),
every as (
  select app_id, 2 * dep_id as dep_id, direction, node_id, item, name
  from {items} semi join (select execution_id as dep_id from triggers) using (dep_id)
  union all select * from rdd_items),
deps as (
  select app_id, dep_id, list(name order by node_id, item, name) filter (direction = 'input') as ins,
    list(name order by node_id, item, name) filter (direction = 'output') as outs
  from every where name is not null group by app_id, dep_id),
distinct_deps as (select distinct app_id, ins, outs from deps),
datasets as (
  select app_id, 'input' as direction, name, count(*) as n
  from (select app_id, unnest(ins) as name from distinct_deps) group by app_id, name
  union all
  select app_id, 'output', name, count(*)
  from (select app_id, unnest(outs) as name from distinct_deps) group by app_id, name)
"""
    )


LINEAGE = _lineage(False)
ORACLE["lineage_edges_compat"] = _lineage(True) + (
    "select app_id, job_name, direction, name as dataset, n from datasets join named using (app_id)"
)

ORACLE["lineage_edges"] = LINEAGE + (
    "select app_id, job_name, direction, name as dataset, n from datasets join named using (app_id)"
)

ORACLE["job_entities"] = LINEAGE + """
select app_id, 'head' as kind, job_name as key, app_name as value, host, sink, source_name, 'JOB' as type,
  'http://spark.adapter' as schema_url
from named
union all by name select app_id, direction as kind, name as key, n::varchar as value from datasets
union all by name select app_id, 'metadata' as kind, key, value from metadata"""

ORACLE["run_entities"] = _with(APPS, JOBS, ROLLUP) + """
select app_id, app_name || '-' || end_ms as name, run_name as resource_name, 'JOB_RUN' as type, job_name as transformer,
  '1992-01-01T00:00:00.000' as start_time, strftime(make_timestamp(end_ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') as end_time,
  status, status_reason, is_complete
from named"""

STATUS_DOCS = (
    _with(APPS, JOBS, ROLLUP, METADATA, OUTS)
    + f""",
outputs as (
  select app_id, name, count(*) as n from (
    select name, app_id from (
      select app_id, job_id, {_uri('path', 's3a', 's3n')} as name from outs left join apps using (app_id)))
  where name is not null group by app_id, name)"""
)

DOCUMENTS = STATUS_DOCS + r"""
, listed as (
  select app_id, 'output' as kind, name as key, n::varchar as value from outputs
  union all select app_id, 'metadata', key, value from metadata),
documents as (
  select app_id, host, sink, source_name, 'head' as kind, job_name as key,
    '{"name":"' || app_name || '","resource_name":"' || job_name || '","type":"JOB","schema_url":"http://spark.adapter"}|'
    || '{"name":"' || app_name || '-' || end_ms || '","resource_name":"' || run_name || '","type":"JOB_RUN","transformer":"' || job_name
    || '","start_time":"1992-01-01T00:00:00.000Z","end_time":"' || strftime(make_timestamp(end_ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z","status":"'
    || status || '"' || coalesce(',"status_reason":"' || status_reason || '"', '') || '}' as items
  from named
  union all
  select app_id, host, sink, source_name, kind, key,
    '{"job":"' || job_name || '","kind":"' || kind || '","key":"' || replace(key, '\', '\\') || '","value":"' || value || '"}'
  from listed join named using (app_id))"""

ORACLE["envelopes"] = DOCUMENTS + "select app_id, host, source_name, kind, key, items from documents"
ORACLE["publish_documents"] = DOCUMENTS + (
    "select app_id, '0' || length(key) || '.10' as host, kind, key, items, 2::bigint as batch from documents where sink = 'publish'"
)
ORACLE["publish_stream"] = DOCUMENTS + "select app_id, host, kind, key, items from documents where sink = 'publish'"
ORACLE["failed_documents"] = DOCUMENTS + """
select app_id, kind, key, 'no host' as error, 1::bigint as batch from documents
where sink = 'publish' and kind = 'head' and length(app_id) % 3 <> 0
union all
select app_id, kind, null, 'no key', 0::bigint from documents
where sink = 'publish' and kind = 'head' and length(app_id) % 2 <> 0"""
ORACLE["log_documents"] = DOCUMENTS + "select source_name, kind, key, items from documents where sink = 'log'"

# --- Ordinary ETL -------------------------------------------------------------

ORACLE["word_count"] = """
select word, count(*) as n from (select unnest(string_split(replace(text, chr(10), ' '), ' ')) as word from documents) group by word"""

ORACLE["text_roundtrip"] = """
with l as (select string_split(text, chr(10)) as parts from conversations),
lines as (select unnest(case when parts[len(parts)] = '' and len(parts) > 1 then parts[:len(parts) - 1] else parts end) as value from l)
select length(value)::int as length, count(*) as n, max(value) as last_line from lines group by length(value)"""

ORACLE["position_etl"] = """
with r as (
  select o_orderkey as report_id, (o_orderkey % 200 - 100)::double as latitude, (o_orderkey % 400 - 200)::double as longitude,
    (case when o_custkey % 3 = 0 then -o_custkey else o_custkey end)::int as vehicle_id,
    case when o_orderstatus <> 'P' then o_orderpriority end as report_hour
  from orders)
select report_id, latitude, longitude, vehicle_id, report_hour, c_name as name from r left join customer on vehicle_id = c_custkey
where latitude <= 80 and latitude >= -90 and longitude <= 180 and longitude >= -180
  and (latitude != 0 or longitude != 0) and report_hour is not null"""

ORACLE["mixed_type_join"] = """
with sizes as (select distinct p_size * 2 as vehicle_id from part)
select l_quantity as latitude, vehicle_id, count(*) as n, max(l_orderkey) as last_report
from lineitem left join sizes on l_quantity = vehicle_id group by l_quantity, vehicle_id"""

ORACLE["left_join_drop"] = """
select p_partkey as CC_CALL_CENTER_SK, p_type as CC_CLASS, s_name
from part left join supplier on p_partkey = s_suppkey * 2 where p_partkey <= 10"""

ORACLE["bounded_join"] = """
select s_suppkey, s_name, n_name from supplier left join nation on s_nationkey = n_nationkey where s_suppkey <= 10"""

ORACLE["project_cast"] = """
select conv_id || '-' || turn as key, text as value_str, strlen(text)::int as n_bytes from conversations"""

ORACLE["topic_copy"] = """
select conv_id || '-' || turn as key, text as value, 'total' as topic from conversations where role in ('user', 'assistant')"""

ORACLE["top_rows"] = """
select event_id, user_id, event_type, value from events order by value desc, event_id limit 20"""

ORACLE["file_formats"] = """
select c_custkey, c_name, c_mktsegment, c_nationkey, fmt
from customer, (select unnest(['parquet', 'orc', 'csv', 'json']) as fmt)"""

ORACLE["versioned_table"] = """
select s_suppkey, s_nationkey, (v - 1)::int as hops, v::int as version from supplier, (select unnest([1, 2, 3]) as v)"""

# --- Event logs ---------------------------------------------------------------

ORACLE["event_log_scan"] = """
with t as (
  select regexp_replace(o_orderpriority, '[^A-Z0-9]', '-', 'g') as app_id, epoch_ms(o_orderdate) as ms, o_orderkey, o_orderstatus
  from orders)
select app_id, 'SparkListenerJobStart' as event, ms as event_ms, o_orderkey as job_id,
  case when o_orderstatus <> 'P' then o_orderkey end as execution_id, null::varchar as result, null::varchar as error_message from t
union all
select app_id, 'SparkListenerJobEnd', ms + 3600000, o_orderkey, null,
  case when o_orderstatus = 'F' then 'JobFailed' else 'JobSucceeded' end, case when o_orderstatus = 'F' then 'lost' end from t"""

ORACLE["event_log_stream"] = """
with t as (
  select regexp_replace(o_orderpriority, '[^A-Z0-9]', '-', 'g') as app_id, epoch_ms(o_orderdate) as ms, o_orderkey, o_orderstatus
  from orders)
select app_id, max(ms + 3600000)::bigint as end_ms, count(*) filter (o_orderstatus = 'F') as n_failed,
  case when count(*) filter (o_orderstatus = 'F') > 0 then 'lost' end as status_reason,
  case when count(*) filter (o_orderstatus = 'F') > 0 then 'FAILED' else 'SUCCESS' end as status
from t group by app_id"""

ORACLE["event_log_rdds"] = """
with t as (select regexp_replace(o_orderpriority, '[^A-Z0-9]', '-', 'g') as app_id, o_orderkey from orders)
select app_id, o_orderkey as job_id, 2 * o_orderkey as rdd_id, 0 as item, 's3a://logs/' || o_orderkey as path, 1 as n_children from t
union all select app_id, o_orderkey, 2 * o_orderkey, 1, 's3a://logs/all', 1 from t"""

LOG_APP = "regexp_replace(o_orderpriority, '[^A-Z0-9]', '-', 'g') as app_id"
ORACLE["event_log_lineage"] = f"""
with o as (select {LOG_APP}, * from orders)
select app_id, 'input' as direction, '//s3/cloud/aws/buckets/tables/keys/' || (o_custkey % 5) as name, 1 as n
from o where o_orderstatus <> 'P' group by app_id, o_custkey % 5
union all select app_id, 'input', '//s3/cloud/aws/buckets/logs/keys/' || o_orderkey, 1 from o where o_orderstatus = 'P'
union all select app_id, 'input', '//s3/cloud/aws/buckets/logs/keys/all', count(*) from o where o_orderstatus = 'P' group by app_id"""
ORACLE["event_log_names"] = f"""
with o as (select {LOG_APP}, o_orderkey, 's3a://logs/' || o_orderkey || ',s3a://logs/all' as list from orders)
select app_id, o_orderkey as job_id, 2 * o_orderkey as rdd_id, list as name from o
union all select app_id, o_orderkey, 2 * o_orderkey + 1, 'map_partitions_' || list from o"""
ORACLE["event_log_unreadable"] = f"""
select app_id, count(*) as n, max(len(line))::int as longest from (
  select {LOG_APP}, '{{"Event":"SparkListenerJobEnd","Job ID":' || o_orderkey || ',"Completion Time":' || (epoch_ms(o_orderdate) + 3600000)
    || ',"Job Result":{{"Result":"' || case when o_orderstatus = 'F' then 'JobFailed","Exception":{{"Message":"lost"}}}}'
    else 'JobSucceeded"}}' end as line
  from orders where o_orderkey % 10 = 7) group by app_id"""
