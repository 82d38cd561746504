"""DuckDB SQL equal to each registered query (same column names)."""

from __future__ import annotations

# Record fixture over `events` (FIXTURES.md): one topic per event type,
# partition = user_id % 3, offset = position in the topic-partition.
MSG = """
msg as (
  select event_id, ts, user_id, event_type, value, props,
         cast(user_id as varchar) as kafka_key,
         'pg.public.' || event_type as kafka_topic,
         cast(user_id % 3 as integer) as kafka_partition,
         cast(row_number() over (partition by event_type, user_id % 3
                                 order by event_id) - 1 as bigint) as kafka_offset,
         ts as kafka_timestamp
  from events)
"""

PROC = "timestamp '2024-02-01 00:00:00'"

ENRICHED = f"""
enriched as (
  select kafka_key, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
         props as avro_value_hex,
         {PROC} as processing_timestamp,
         split_part(kafka_topic, '.', 3) as source_table,
         kafka_partition = 0 as is_primary_partition,
         cast(epoch({PROC}) as bigint) * 1000
           - cast(epoch(date_trunc('second', kafka_timestamp)) as bigint) * 1000
           as message_age_ms,
         kafka_offset as message_sequence,
         hex(props) as value_hex,
         epoch_us({PROC}) // 1000 - epoch_us(kafka_timestamp) // 1000
           as message_age_exact_ms,
         event_id, ts, user_id, event_type, value, props
  from msg)
"""

ENRICHED_COLS = """kafka_key, kafka_topic, kafka_partition, kafka_offset,
  kafka_timestamp, avro_value_hex, processing_timestamp, source_table,
  is_primary_partition, message_age_ms, message_sequence, value_hex,
  message_age_exact_ms"""

SQL: dict[str, str] = {}

SQL["enrich"] = f"with {MSG}, {ENRICHED} select {ENRICHED_COLS} from enriched"

SQL["message_sequence"] = f"""with {MSG}
select kafka_topic, kafka_partition, kafka_offset, kafka_key,
       cast(row_number() over (partition by kafka_topic, kafka_partition
                               order by kafka_offset) as bigint) as message_sequence
from msg"""

SQL["count_by_table"] = f"""with {MSG}, {ENRICHED}
select source_table, count(*) as "count" from enriched group by 1"""

SQL["count_by_topic"] = f"""with {MSG}
select kafka_topic, count(*) as "count" from msg group by 1"""

SQL["topic_end_offsets"] = f"""with {MSG},
p as (select kafka_topic, kafka_partition, max(kafka_offset) + 1 as end_offset
      from msg group by 1, 2)
select kafka_topic as topic, cast(sum(end_offset) as bigint) as messages
from p group by 1"""

SQL["table_counts"] = """
select count(*) as row_count, 'customer' as table_name from customer
union all select count(*), 'orders' from orders
union all select count(*), 'lineitem' from lineitem"""


SQL["topics_by_prefix"] = f"""with {MSG}
select kafka_topic as topic, count(*) as "count" from msg
where starts_with(kafka_topic, 'pg.') group by 1"""

SQL["expected_tables"] = f"""with {MSG}, {ENRICHED}
select source_table, count(*) as "count" from enriched
where regexp_full_match(source_table, '(click|purchase|view)') group by 1"""

SQL["include_list"] = f"""with {MSG}
select kafka_topic as topic, count(*) as "count" from msg
where regexp_full_match(split_part(kafka_topic, '.', 2) || '.' || split_part(kafka_topic, '.', 3),
                        'public\\..*')
group by 1"""

SQL["topic_replay"] = f"""with {MSG}
select kafka_topic as topic, kafka_partition as "partition", kafka_offset as "offset",
       kafka_key as key, props as value
from msg where kafka_topic in ('pg.public.click', 'pg.public.view')"""

SQL["replay_range"] = f"""with {MSG},
r(t, p, lo, hi) as (values ('click', 0, 3, 20), ('click', 1, 0, 12), ('click', 2, 10, null),
  ('view', 0, 0, null), ('view', 1, 7, 30), ('view', 2, 5, 6))
select kafka_topic as topic, kafka_partition as "partition", kafka_offset as "offset",
       kafka_key as key, props as value
from msg join r on event_type = t and kafka_partition = p
where kafka_offset >= lo and (hi is null or kafka_offset < hi)"""

SQL["offset_gaps"] = f"""with {MSG},
log as (
  select kafka_topic, kafka_partition, kafka_offset from msg
  where event_type in ('click', 'purchase', 'view')
    and kafka_offset >= 5 and kafka_offset % 7 > 1),
ends as (
  select kafka_topic, kafka_partition, max(kafka_offset) as hi from log group by all),
lost as (
  select e.*, o from (select *, unnest(generate_series(0, hi)) as o from ends) e
  anti join log l on e.kafka_topic = l.kafka_topic and e.kafka_partition = l.kafka_partition
                 and o = l.kafka_offset),
islands as (
  select *, o - row_number() over (partition by kafka_topic, kafka_partition order by o) as i
  from lost)
select kafka_topic as topic, kafka_partition as "partition", min(o) as first_missing,
       max(o) as last_missing, count(*) as missing
from islands group by kafka_topic, kafka_partition, i"""

SQL["table_names"] = r"""
select page_id, url,
       lower(regexp_replace(
         regexp_replace(regexp_extract(url, '([^/]*)$', 1), '^(\.*[^.].*)\.[^.]*$', '\1'),
         '[^\p{L}\p{N}]', '_', 'g')) as table_name
from pages"""

# Envelope fixture: op from event_id, damaged payloads on topic `error`.
OP = """case when event_id % 10 = 0 then 'd'
            when event_id % 10 between 1 and 3 then 'u' else 'c' end"""

SQL["json_status"] = f"""
select case when event_type = 'error' then 'unknown' else {OP} end as status,
       count(*) as "count"
from events group by 1"""

SQL["offset_lines"] = SQL["topic_end_offsets"]

SQL["table_sample"] = """
select * from orders order by o_orderkey limit 5"""

SQL["schema_count"] = """
select count(distinct 'pg.public.' || event_type || '-value') as schema_count from events"""

SQL["wire_header"] = f"""with {MSG}
select kafka_topic, kafka_partition, kafka_offset,
       case when event_type = 'view' then ascii(props) else 0 end as magic,
       case when event_type = 'view' then null
            else cast(length(event_type) as bigint) end as schema_id,
       case when event_type = 'view' then null else props end as payload_text,
       true as value_is_utf8
from msg"""

SQL["decode_envelope"] = f"""with {MSG}, env as (select *, {OP} as op from msg)
select kafka_topic, event_type as source_table, kafka_partition, kafka_offset,
       op, event_id as lsn, user_id as k, epoch_us(ts) // 1000 as ts_ms,
       event_type as source_event_type,
       case when op in ('u', 'd') then user_id end as before_user_id,
       case when op in ('u', 'd') then value end as before_value,
       case when op <> 'd' then user_id end as after_user_id,
       case when op <> 'd' then value end as after_value
from env"""

SQL["decode_errors"] = """
select event_type as source_table,
       count(*) filter (where event_type <> 'error') as decoded,
       count(*) filter (where event_type = 'error') as failed
from events group by 1"""

SQL["current_state"] = f"""with env as (
  select user_id as k, event_id as lsn, user_id, value, {OP} as op,
         row_number() over (partition by user_id order by event_id desc) as rn
  from events)
select k, op, lsn, user_id, value from env where rn = 1 and op <> 'd'"""

SQL["op_counts"] = f"""
select {OP} as op, count(*) as "count" from events group by 1"""

SQL["decode_latest"] = f"""with {MSG},
w as (
  select *, cast(json_extract(props, '$.k') as bigint) as k, event_id % 13 = 0 as plain,
         cast([5, 6, 8, 9][event_id % 4 + 1] as bigint) as id from msg)
select kafka_topic, kafka_partition, kafka_offset, case when not plain then id end as schema_id,
       k + case when id = 9 and not plain then 0.25::double else 0 end as key_no,
       case when id >= 8 and not plain then event_type else 'none' end as kind,
       case when id = 9 and not plain then k / 2.0::double else 1.5 end as weight,
       case when id = 9 and not plain then 'n' end as note
from w"""

SQL["snapshot_events"] = """
select o_orderkey, 'r' as op,
       o_orderkey as after_o_orderkey, o_custkey as after_o_custkey,
       o_orderstatus as after_o_orderstatus, o_totalprice as after_o_totalprice,
       o_orderdate as after_o_orderdate, o_orderpriority as after_o_orderpriority
from orders"""

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
              "o_orderdate", "o_orderpriority"]

SQL["snapshot_diff"] = """
with a as (select * from orders where o_orderdate < timestamp '2001-01-01 00:00:00'),
b as (select o_orderkey, o_custkey,
             case when o_orderstatus = 'P' and o_orderdate < timestamp '2000-01-01 00:00:00'
                  then 'F' else o_orderstatus end as o_orderstatus,
             o_totalprice, o_orderdate, o_orderpriority
      from orders where o_orderdate >= timestamp '1996-01-01 00:00:00')
select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
       case when a.o_orderkey is null then 'c'
            when b.o_orderkey is null then 'd' else 'u' end as op,
       """ + ",\n       ".join(f"a.{c} as before_{c}" for c in ORDER_COLS) + """,
       """ + ",\n       ".join(f"b.{c} as after_{c}" for c in ORDER_COLS) + """
from a full join b on a.o_orderkey = b.o_orderkey
where a.o_orderkey is null or b.o_orderkey is null or """ + \
    " or ".join(f"a.{c} is distinct from b.{c}" for c in ORDER_COLS)

SQL["snapshot_diff_digest"] = SQL["snapshot_diff"]

SQL["route_topics"] = """
select 'pg.public.customer' as topic, cast(c_custkey as varchar) as k, 'r' as op,
       c_name as name, cast(c_nationkey as varchar) as parent_key from customer
union all select 'pg.public.nation', cast(n_nationkey as varchar), 'r', n_name,
       cast(n_regionkey as varchar) from nation
union all select 'pg.public.supplier', cast(s_suppkey as varchar), 'r', s_name,
       cast(s_nationkey as varchar) from supplier"""

SQL["csv_inventory"] = """
select 'customer' as table_name, 'customer.csv' as path, count(*) > 0 as has_rows from customer
union all select 'orders', 'orders.csv', count(*) > 0 from orders
union all select 'supplier', 'supplier.csv', count(*) > 0 from supplier"""

SQL["file_inventory"] = """
select 'customer.csv' as path, count(*) > 0 as has_rows from customer
union all select 'orders.csv', count(*) > 0 from orders
union all select 'supplier.csv', count(*) > 0 from supplier"""

SQL["csv_roundtrip"] = """
select 'customer' as table_name, c_custkey, c_name,
       cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment from customer
union all by name
select 'orders' as table_name, * replace (
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate) from orders
union all by name
select 'supplier' as table_name, * replace (
  cast(s_nationkey as bigint) as s_nationkey) from supplier"""

SQL["csv_text_roundtrip"] = """
select 'documents' as table_name, * from documents
union all by name select 'pages' as table_name, * from pages"""


def _infer_sql(table: str, columns: list[str]) -> str:
    parts = []
    for i, c in enumerate(columns):
        v = f"cast({c} as varchar)"
        parts.append(f"""
select {i} as position, '{c}' as column_name,
  case when count({c}) = 0 then 'REAL'
       when bool_and({c} is null or regexp_full_match({v}, '[+-]?[0-9]+'))
            and count({c}) = count(*) then 'INTEGER'
       when bool_and({c} is null or {v} in ('True', 'TRUE', 'true', 'False', 'FALSE', 'false'))
            and count({c}) = count(*) then 'BOOLEAN'
       when bool_and({c} is null or regexp_full_match({v},
            '[+-]?(([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))'))
            then 'REAL'
       else 'TEXT' end as sql_type
from {table}""")
    return "\nunion all".join(parts)


SQL["infer_types"] = _infer_sql("orders", ORDER_COLS)

SQL["infer_types_text"] = """
select * from (values (0, 'doc_id', 'INTEGER'), (1, 'text', 'TEXT'), (2, 'lang', 'TEXT'),
  (3, 'padded', 'INTEGER'), (4, 'sparse', 'REAL'), (5, 'huge', 'TEXT'), (6, 'flag', 'BOOLEAN'),
  (7, 'nothing', 'REAL')) t(position, column_name, sql_type)
where exists (select 1 from documents)"""

SQL["append_load"] = """
with c as (
  select *, c_custkey % 2 = 1 and (c_custkey % 7 = 0 or c_custkey % 11 = 0) as bad from customer)
select c_custkey, case when c_custkey % 2 = 0 then c_name end as c_name,
       case when not bad then c_acctbal end as c_acctbal,
       concat_ws(',', case when bad and c_custkey % 7 = 0 then 'c_acctbal' end,
                 case when bad and c_custkey % 11 = 0 then 'c_custkey' end) as misfit
from c"""

SQL["seed_rows"] = """
select count(*) + 1 as row_count, 'nation' as table_name from nation
union all select count(*) + 1, 'region' from region
union all select count(*) + 1, 'supplier' from supplier"""

SQL["seeded_rows"] = """
select n_name as key, cast(n_regionkey as varchar) as value, 'nation' as table_name from nation
union all select c_name, cast(c_custkey as varchar), 'customer' from customer
union all select 'seed_nation_1706745600', 'value_1706745600', 'nation'
union all select 'seed_customer_1706745600', 'value_1706745600', 'customer'"""

SQL["report_error_lines"] = """
select doc_id, unnest([0, 1, 2]) as n,
       unnest(['(Serialization issue - data processed but cannot display details)',
               'Error: ' || left(text, 100), '=== Batch 4 error: ' || text || ' ===']) as line
from documents where text is not null"""

CUT = """case when ts < timestamp '2024-01-08 00:00:00' then 0
              when ts < timestamp '2024-01-16 00:00:00' then 1
              when ts < timestamp '2024-01-24 00:00:00' then 2 else 3 end"""


def lake_sql(batch: str = "cut", extra_from: int = 0, cols: str | None = None,
             tail: str = "") -> str:
    """The lake table written batch by batch: processing time of batch b is
    2024-02-01 plus b days (also its committed_at)."""
    proc = f"({PROC} + to_days(cast(batch_id as integer)))"
    extra = f"batch_id >= {extra_from}"
    select = cols or f"""kafka_key, kafka_topic, kafka_partition, kafka_offset,
       kafka_timestamp, props as avro_value_hex, {proc} as processing_timestamp,
       split_part(kafka_topic, '.', 3) as source_table,
       kafka_partition = 0 as is_primary_partition,
       cast(epoch({proc}) as bigint) * 1000
         - cast(epoch(date_trunc('second', kafka_timestamp)) as bigint) * 1000
         as message_age_ms,
       kafka_offset as message_sequence,
       case when {extra} then hex(props) end as value_hex,
       case when {extra} then epoch_us({proc}) // 1000 - epoch_us(kafka_timestamp) // 1000
       end as message_age_exact_ms,
       {proc} as committed_at, batch_id"""
    return f"""with {MSG},
cuts as (select *, {CUT} as cut from msg),
staged as (select *, cast({batch} as bigint) as batch_id from cuts)
select {select} from staged {tail}"""


SQL["stream_enrich"] = SQL["enrich"]
SQL["stream_lake"] = lake_sql()
SQL["lake_read"] = lake_sql()
SQL["lake_count"] = "select count(*) as row_count from events"
SQL["lake_preview"] = lake_sql(tail="order by kafka_topic, kafka_partition, kafka_offset limit 20")
SQL["as_of_version"] = lake_sql(tail="where batch_id <= 1")
SQL["as_of_timestamp"] = lake_sql(tail="where batch_id <= 2")
SQL["table_history"] = lake_sql(
    cols=f"batch_id, count(*) as row_count, max({PROC} + to_days(cast(batch_id as integer))) as committed_at",
    tail="group by batch_id")
SQL["packed_lake"] = SQL["lake_read"]
SQL["packed_version"] = SQL["as_of_version"]
SQL["packed_history"] = SQL["table_history"]
SQL["schema_evolution"] = lake_sql(extra_from=1)
SQL["schema_widening"] = lake_sql(cols=f"""batch_id, kafka_offset as at,
       case when cut < 3 then cast(event_id as double) end as k,
       case when cut < 2 then cast(length(kafka_key) as varchar) else 'u' || kafka_key end as who,
       case when cut in (1, 3) then kafka_partition end as part,
       case when cut = 3 then kafka_topic end as topic,
       {PROC} + to_days(cast(batch_id as integer)) as committed_at""")
SQL["stream_resume"] = lake_sql(batch="cut // 2")
SQL["stream_metrics"] = lake_sql(
    cols="batch_id, count(*) as input_rows, cast(0 as bigint) as state_rows, true as timed",
    tail="group by batch_id")
SQL["stream_replay"] = SQL["table_history"]
SQL["batch_report"] = """select cast(-1 as bigint) as batch_id, '=== Spark Streaming Output ===' as line
union all select * from (""" + lake_sql(
    cols="""batch_id, format('Key: {}, Topic: {}, Partition: {}, Offset: {}, Table: {}',
       kafka_key, kafka_topic, kafka_partition, kafka_offset,
       split_part(kafka_topic, '.', 3)) as line""") + """)
union all
select * from (""" + lake_sql(
    cols="batch_id, format('=== Micro-batch {} ({} rows) ===', batch_id, count(*)) as line",
    tail="group by batch_id") + ")"

SQL["dq_non_empty"] = """
select count(*) as row_count, 'customer' as table_name, count(*) > 0 as passed from customer
union all select count(*), 'orders', count(*) > 0 from orders
union all select count(*), 'lineitem', count(*) > 0 from lineitem
union all select count(*), 'labels', count(*) > 0 from labels"""

SQL["dq_missing"] = """
select topic from (values ('pg.public.click'), ('pg.public.error'), ('pg.public.purchase'),
                          ('pg.public.refund'), ('pg.public.signup'), ('pg.public.view')) t(topic)
where topic not in (select distinct 'pg.public.' || event_type from events)"""

SQL["dq_unexpected"] = """
select distinct 'pg.public.' || event_type as topic from events
where event_type not in ('click', 'error', 'purchase')"""

SQL["dq_schemas"] = """
select 'schemas_registered' as "check",
       cast(count(distinct event_type) as bigint) as value,
       case when count(distinct event_type) >= 1 then 'ok' else 'warn' end as severity
from events"""

SQL["stream_current_state"] = SQL["current_state"]
SQL["stream_expiring_state"] = SQL["current_state"]

SQL["decode_framed"] = f"""with {MSG}
select kafka_topic, kafka_partition, kafka_offset,
       case when event_type = 'view' then null
            else cast(length(event_type) as bigint) end as schema_id,
       cast(json_extract(props, '$.k') as bigint) as k
from msg"""

SQL["filter_table"] = lake_sql(tail="where split_part(kafka_topic, '.', 3) = 'error'")

SQL["json_lists"] = """
select o_orderkey, cast(case when o_orderkey % 5 = 0 then 0
  else len(regexp_split_to_array(o_orderpriority, '[- ]')) end as bigint) as n
from orders"""
