"""Query key to SQL: the expected result of every query, written independently."""

from __future__ import annotations

_MESSAGES = """
  select event_id, ts, hour(ts) // 8 as shift,
    cast(user_id as varchar) as series_id,
    cast(year(ts) as int) as year,
    case event_type when 'view' then 'M01' when 'click' then 'M02'
      when 'purchase' then 'M03' when 'signup' then 'M13' else 'Q01' end as period,
    event_type as "periodName", value, props as notes,
    event_type = 'purchase' as is_latest,
    case event_type when 'view' then 1 when 'click' then 2
      when 'purchase' then 3 when 'signup' then 13 end as month,
    case event_type when 'view' then make_date(year(ts), 1, 1)
      when 'click' then make_date(year(ts), 2, 1)
      when 'purchase' then make_date(year(ts), 3, 1) end as dt
  from events"""

_SILVER = "series_id, ts, year, period, \"periodName\", value, notes, is_latest, month, dt"
_SERVED = (
    "series_id, ts, year, period, \"periodName\" as periodname, value, notes, is_latest, month, dt"
)
_VALID = "period in ('M01', 'M02', 'M03')"

_FACT = """
  select 'SM' as data_type_code,
    cast(dayofweek(o_orderdate) + 1 as int) as time_slot_id,
    case o_orderstatus when 'P' then true when 'F' then false end as is_seasonally_adjusted,
    o_orderpriority as category_code,
    o_totalprice as cell_value,
    cast(o_orderkey as varchar) as error_data,
    case when o_orderpriority = '5-LOW' then strftime(o_orderdate, '%Y') || '-Q1'
      else strftime(date_trunc('quarter', o_orderdate), '%Y-%m') end as time,
    case when o_orderpriority <> '5-LOW'
      then cast(date_trunc('quarter', o_orderdate) as date) end as dt,
    cast(date_trunc('month', o_orderdate) as date) as ingest_date
  from orders"""

_TYPED_FACT = f"""
  select data_type_code, time_slot_id, is_seasonally_adjusted, category_code, cell_value,
    error_data, time, dt, cast(year(dt) as int) as year, cast(month(dt) as int) as month,
    ingest_date
  from ({_FACT})"""

_FACT_ROWS = f"""
  select * from ({_TYPED_FACT})
  where dt is not null and is_seasonally_adjusted is not null
  qualify row_number() over (
    partition by dt, category_code, data_type_code, time_slot_id, is_seasonally_adjusted
    order by ingest_date desc, time desc, cell_value desc, error_data desc) = 1"""

_RAW_FACT = """
  select 'SM' as data_type_code,
    cast(dayofweek(o_orderdate) + 1 as varchar) as time_slot_id,
    case o_orderstatus when 'P' then ' Yes' when 'F' then 'no' else o_orderstatus end
      as seasonally_adj,
    o_orderpriority as category_code,
    format('{:,.2f}', o_totalprice) as cell_value,
    cast(o_orderkey as varchar) as error_data,
    case when o_orderpriority = '5-LOW' then strftime(o_orderdate, '%Y') || '-Q1'
      else strftime(date_trunc('quarter', o_orderdate), '%Y-%m') end as time
  from orders"""

_PERIODS = """
  select o_orderkey,
    case o_orderpriority when '1-URGENT' then 13 when '5-LOW' then null
      else cast(month(o_orderdate) as int) end as m,
    case when o_orderpriority not in ('1-URGENT', '5-LOW')
      then cast(date_trunc('month', o_orderdate) as date) end as dt
  from orders"""

_POINTS = """
  select event_id, event_id // 500 as document, cast(user_id as varchar) as "seriesID",
    strftime(ts, '%Y') as year,
    case event_type when 'view' then 'M01' when 'click' then 'M02'
      when 'purchase' then 'M03' when 'signup' then 'M13' else 'Q01' end as period,
    event_type as "periodName", value,
    case when event_type = 'purchase' then 'true' else 'false' end as latest, props as notes
  from events"""

_POINT_COLUMNS = '"seriesID", year, period, "periodName", value, latest, notes'


def _latest_events(keys: str, where: str = "true", order: str = "ts desc, event_id desc") -> str:
    return f"""
  select event_id, user_id, event_type, ts, value from events where {where}
  qualify row_number() over (partition by {keys} order by {order}) = 1"""


_FIRST = "event_type in ('view', 'click', 'signup')"
_BASE = _latest_events("user_id", _FIRST)
_DELTA = _latest_events("user_id", f"not ({_FIRST})")
_UPSERTED = f"""
  with base as ({_BASE}), delta as ({_DELTA})
  select * from delta
  union all
  select * from base where not exists (select 1 from delta where delta.user_id = base.user_id)"""

_HELD = _latest_events("user_id, event_type", "hour(ts) // 8 < 2")
_LATER = _latest_events("user_id, event_type", "hour(ts) // 8 > 0")


def _latest_points(where: str, partition: str, order: str, columns: str) -> str:
    return f"""
  select {columns} from (
    select * from ({_MESSAGES}) where {where}
    qualify row_number() over (partition by {partition} order by {order}) = 1)"""


_WHOLE_SILVER = _latest_points(
    "true", "series_id, year, period", "ts desc", _SILVER + ", 0 as batch_id"
)

_FACT_LATEST = f"""
  select distinct on (category_code, data_type_code, time_slot_id, is_seasonally_adjusted)
    time, dt, year, month, is_seasonally_adjusted, category_code, data_type_code, time_slot_id,
    cell_value as value, error_data, ingest_date
  from ({_FACT_ROWS})
  order by category_code, data_type_code, time_slot_id, is_seasonally_adjusted, dt desc"""

ORACLES: dict[str, str] = {
    "decode_json_props": """
  select event_id, cast(json_extract_string(props, '$.k') as int) as k from events""",
    "flag_tristate": """
  select o_orderkey, case o_orderstatus when 'P' then true when 'F' then false end as flag
  from orders""",
    "flag_default_false": "select o_orderkey, o_orderstatus = 'P' as flag from orders",
    "numeric_clean": """
  select cast(o_orderkey as int) as o_orderkey, o_totalprice as v,
    cast(null as double) as not_a_number
  from orders""",
    "year_month_date": f"""
  select cast(error_data as bigint) as o_orderkey, dt, cast(year(dt) as int) as y,
    cast(month(dt) as int) as m
  from ({_FACT})""",
    "period_month": _PERIODS,
    "parse_timestamp": """
  select event_id, case when event_type <> 'error' then ts end as ts from events""",
    "footnote_texts": """
  select event_id,
    cast(case event_type when 'view' then 0 when 'click' then 0 when 'error' then 2 else 1 end
      as int) as n,
    case when event_type not in ('view', 'click', 'error') then props end as first_text,
    case when event_type = 'error' then props end as second_text
  from events""",
    "tabular_payload_records": _RAW_FACT,
    "payload_all_points": f"select {_POINT_COLUMNS} from ({_POINTS})",
    "payload_latest_point": f"""
  select {_POINT_COLUMNS} from ({_POINTS})
  qualify row_number() over (
    partition by document, "seriesID" order by latest desc, event_id) = 1""",
    "encode_messages": f"""
  select series_id || '|' || year || '|' || period as key,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as ts_ingested,
    series_id, year, period, value, notes, is_latest
  from ({_MESSAGES})""",
    "publish_window": f"""
  select series_id || '|' || year || '|' || period as key, value from ({_MESSAGES})
  where cast(series_id as int) between 1 and 99 and year between 2000 and 2030""",
    "decode_messages": f"""
  select case when ok then ts end as ts, case when ok then series_id end as series_id,
    case when ok then year end as year, case when ok then period end as period,
    case when ok then "periodName" end as "periodName", case when ok then value end as value,
    case when ok then notes end as notes, ok and is_latest as is_latest
  from (select *, period <> 'Q01' as ok from ({_MESSAGES}))""",
    "undeclared_fields": """
  select event_id,
    case when event_type <> 'error' then cast(json_extract_string(props, '$.k') as bigint) end
      as revision,
    case when event_type = 'view' then 'view' end as feed
  from events""",
    "select_window": """
  select o_orderkey, o_orderpriority, o_totalprice from orders
  where o_orderdate >= timestamp '1997-01-01' and o_orderdate <= timestamp '2000-12-31'
    and o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "latest_per_key": _latest_events("user_id, event_type"),
    "latest_per_series": _latest_events("user_id"),
    "latest_per_fact_key": _FACT_ROWS,
    "drop_duplicates": "select distinct user_id, event_type from events",
    "drop_duplicates_newest": _latest_events("user_id, event_type"),
    "distinct_on_latest": """
  select distinct on (user_id) user_id, event_id, ts from events
  order by user_id, ts desc, event_id desc""",
    "upsert_snapshot": _UPSERTED,
    "upsert_latest_unguarded": _UPSERTED,
    "upsert_latest_guarded": _latest_events("user_id"),
    "history_insert_if_absent": f"""
  with held as ({_HELD}), later as ({_LATER})
  select * from held
  union all
  select * from later where not exists (
    select 1 from held
    where held.user_id = later.user_id and held.event_type = later.event_type)""",
    "history_conflict_staged": f"""
  with held as ({_HELD}), later as ({_LATER})
  select * from held
  union all
  select * from later where not exists (
    select 1 from held
    where held.user_id = later.user_id and held.event_type = later.event_type)""",
    "quality_gate_valid": f"select * from ({_PERIODS}) where dt is not null",
    "quality_gate_rejects": """
  select o_orderkey, case o_orderpriority when '5-LOW' then 'm' else 'dt' end as reject_reason
  from orders where o_orderpriority in ('1-URGENT', '5-LOW')""",
    "fact_rejects": f"""
  select error_data as order_text,
    case when dt is null then 'dt' else 'is_seasonally_adjusted' end as reject_reason
  from ({_FACT}) where dt is null or is_seasonally_adjusted is null""",
    "duplicate_keys": """
  select user_id, event_type, count(*) as n from events
  group by user_id, event_type having count(*) > 1""",
    "jsonl_roundtrip": "select * from events",
    "partition_append_scan": """
  select o_orderkey, o_orderstatus, o_totalprice,
    case when o_orderstatus = 'F' then date '2024-01-31' else date '2024-02-01' end as ingest_date
  from orders""",
    "partition_overwrite": """
  select *, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month
  from orders""",
    "clustered_layout": "select * from orders",
    "schema_fallback": "select * from orders",
    "job_batch_bronze": f"select *, date '2024-01-31' as ingest_date from ({_RAW_FACT})",
    "bronze_to_silver": f"""
  select data_type_code, time_slot_id, is_seasonally_adjusted, category_code, cell_value,
    error_data, time, dt as date, year, month, ingest_date
  from ({_TYPED_FACT})""",
    "silver_to_gold": _FACT_ROWS,
    "fact_latest": _FACT_LATEST,
    "fact_latest_maintained": _FACT_LATEST,
    "series_monthly": f"""
  select dt, year, month, category_code, data_type_code, time_slot_id, is_seasonally_adjusted,
    cell_value as value
  from ({_FACT_ROWS})""",
    "dim_date": """
  select cast(d as date) as dt, cast(year(d) as int) as year, cast(month(d) as int) as month,
    strftime(d, '%b') as month_abbr, strftime(d, '%Y-%m') as year_month
  from (select unnest(generate_series(
    cast(cast((select min(o_orderdate) from orders) as date) as timestamp),
    cast(cast((select max(o_orderdate) from orders) as date) as timestamp),
    interval 1 day)) as d)""",
    "latest_view": _latest_points(_VALID, "series_id", "ts desc", _SERVED),
    "database_staging_rows": _latest_points(
        _VALID,
        "series_id",
        "ts desc",
        'series_id, ts as ts_ingested, dt, year, month, period, "periodName" as periodname, '
        "value, is_latest, cast(to_json([notes]) as varchar) as footnotes",
    ),
    "gold_counts": f"""
  select 'fact' as table_name, count(*) as n from ({_FACT_ROWS})
  union all
  select 'series_latest', count(distinct series_id) from ({_MESSAGES}) where {_VALID}""",
    "stream_bronze": f"""
  select ts, series_id, year, period, "periodName", value, notes, is_latest from ({_MESSAGES})""",
    "stream_silver_latest": _latest_points(
        "true",
        "shift, series_id, year, period",
        "ts desc",
        _SILVER + ", cast(shift as int) as batch_id",
    ),
    "stream_restart": _WHOLE_SILVER,
    "stream_empty_source": _WHOLE_SILVER,
    "stream_gold_history": _latest_points(
        _VALID, "shift, series_id", "ts desc", _SERVED + ", cast(shift as int) as batch_id"
    ),
    "stream_gold_after_reset": _latest_points(_VALID, "series_id", "ts desc", _SERVED),
    "stream_history_after_reset": f"""
  select {_SERVED} from (
    {_latest_points(_VALID, "shift, series_id", "ts desc", "*")})
  where shift < 2
  union all
  select {_SERVED} from (
    {_latest_points(_VALID, "series_id", "ts desc", "*")})
  where shift = 2""",
    "stream_gold_latest": _latest_points(_VALID, "series_id", "ts desc", _SERVED),
    "stream_gold_latest_unguarded": _latest_points(
        _VALID, "series_id", "shift desc, ts desc", _SERVED
    ),
    "history_compacted": _latest_points(
        _VALID, "shift, series_id", "ts desc", _SERVED + ", cast(shift as int) as batch_id"
    ),
    "sketched_counts": f"""
  select 'series' as measure, count(distinct series_id) as n, true as within
  from ({_MESSAGES}) where {_VALID}
  union all
  select 'values', count(*), true from (
    {_latest_points(_VALID, "shift, series_id, year, period", "ts desc", "series_id")})""",
    "silver_compacted": _latest_points(
        "true",
        "shift, series_id, year, period",
        "ts desc",
        _SILVER + ", cast(shift as int) as batch_id",
    ),
    "stream_archived_source": _latest_points(
        "true",
        "shift, series_id, year, period",
        "ts desc",
        _SILVER + ", cast(shift as int) as batch_id, 2 as archived",
    ),
    "stream_state_read": _latest_points(
        "shift < 2", "series_id", "ts desc", 'series_id, ts, year, period, "periodName", value'
    ),
    "gate_metrics": f"""
  with r as (
    select case when dt is null then 'dt' when is_seasonally_adjusted is null
      then 'is_seasonally_adjusted' end as reason
    from ({_FACT}))
  select 'rows' as measure, count(*) as n from r
  union all
  select 'valid', count(*) from r where reason is null
  union all
  select reason, count(*) from r where reason is not null group by reason""",
    "partition_window_scan": """
  select *, cast(date_trunc('month', o_orderdate) as date) as ingest_date from orders
  where o_orderdate >= timestamp '1997-03-01' and o_orderdate < timestamp '1998-03-01'""",
    "stream_state_latest": _latest_points(
        "true", "series_id", "ts desc", 'series_id, ts, year, period, "periodName", value'
    ),
}
