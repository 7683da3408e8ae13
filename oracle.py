"""ANSI SQL twins of the named queries, for DuckDB on the same tables."""

from __future__ import annotations

UNIFIED = """
u as (
  select *, "timestamp" + ((l_orderkey * 7 + l_linenumber) % 5) * 1200000 as arrival_ms
  from (
    select cast(l_partkey // 100 as varchar) as product_id, cast(l_suppkey % 5 as varchar) as store_id,
      case when l_returnflag = 'N' and l_linenumber = 7 then 'RESET'
           when l_returnflag = 'R' then 'RETURN'
           when l_linestatus = 'O' then 'SALE'
           when l_returnflag = 'A' then 'RECEIPT'
           else 'SHIPMENT' end as event_type,
      cast(l_quantity as bigint) as quantity,
      1704067200000 + ((l_orderkey + l_linenumber) % 7) * 86400000 + ((l_orderkey * 13) % 1440) * 60000
        + l_linenumber * 1000 as "timestamp",
      l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
    from lineitem)
),
seq as (
  select *, row_number() over (partition by store_id, product_id
    order by arrival_ms, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) as n
  from u
)"""

EVENT_COLS = "store_id, product_id, event_type, quantity, \"timestamp\", arrival_ms, l_orderkey, l_linenumber"

INVENTORY = f"""{UNIFIED},
barrier as (
  select *,
    last_value(case when event_type = 'RESET' then "timestamp" end ignore nulls)
      over (partition by store_id, product_id order by n rows unbounded preceding) as last_reset,
    count(case when event_type = 'RESET' then 1 end)
      over (partition by store_id, product_id order by n rows unbounded preceding) as epoch
  from seq
),
on_hand as (
  select *, cast(sum(case when event_type in ('SALE', 'SHIPMENT') then -quantity else quantity end)
    over (partition by store_id, product_id, epoch order by n rows unbounded preceding) as bigint) as on_hand
  from barrier
  where event_type = 'RESET' or last_reset is null or "timestamp" >= last_reset
)"""

VELOCITY = f"""{UNIFIED},
s as (
  select *, "timestamp" // 60000 as m, abs(quantity) as sold,
    max("timestamp") over (partition by store_id, product_id order by n rows unbounded preceding) // 60000 as ref
  from seq where event_type = 'SALE'
),
sums as (
  select a.store_id, a.product_id, a.n,
    cast(sum(case when b.m > a.ref - 60 then b.sold else 0 end) as bigint) as h,
    cast(sum(b.sold) as bigint) as d
  from s a join s b on a.store_id = b.store_id and a.product_id = b.product_id
    and b.n <= a.n and b.m > a.ref - 1440
  group by a.store_id, a.product_id, a.n
),
signal as (
  select s.*, coalesce(h, 0) as h, coalesce(d, 0) as d from s left join sums using (store_id, product_id, n)
)"""


def _signal(threshold: int) -> str:
    return f"""with {VELOCITY}
select store_id, product_id, quantity, "timestamp", arrival_ms, l_orderkey, l_linenumber,
  case when h >= {threshold} then 'FAST' else 'SLOW' end as type,
  case when h >= {threshold} then '1h' else '24h' end as "window",
  case when h >= {threshold} then h else d end as count
from signal"""


CLICKS = """
e as (
  select *, epoch_us(ts) // 1000 as ms, cast(json_extract_string(props, '$.k') as int) as k from events
),
c as (
  select event_id, ms as arrival_ms, ms as "timestamp",
    case event_type when 'view' then 'browse' when 'click' then 'view_item'
      when 'signup' then case when event_id % 2 = 0 then 'add-to-cart' else 'add_to_cart' end
      when 'purchase' then 'purchase' else 'ERROR' end as event,
    case when event_id % 97 = 0 then 'BROKEN DATE FORMAT!!!'
      when event_id % 89 = 0 then strftime(ts + interval 30 days, '%Y-%m-%d %H:%M:%S')
      else strftime(ts, '%Y-%m-%d %H:%M:%S') end as event_datetime,
    case when event_id % 83 <> 0 then user_id end as user_id,
    'C' || user_id as client_id, 'P' || (k % 10) as page, 'P' || (k // 10) as page_previous,
    case when event_type in ('signup', 'purchase') then case when event_id % 7 = 0 then 0 else 1 end end as n_items,
    case when event_id % 5 <> 0 then 'N' || k end as raw_name,
    case when event_id % 13 = 0 then 'X' || k else cast(k as varchar) end as shown_item, k, value, ts
  from e
),
i as (
  select *, coalesce(n_items, 0) = 1 as has_item, event in ('add_to_cart', 'purchase') as needs_item from c
)"""

ITEM_COLS = """
  n_items,
  case when has_item then shown_item end as item_id,
  case when has_item then raw_name end as item_name,
  case when has_item then 'B' end as item_brand,
  case when has_item then 'cat' end as item_category,
  case when has_item then cast(cast(value as float) as double) end as price,
  case when has_item then 1 + k % 3 end as item_quantity"""

CHECKED = f"""{CLICKS},
checked as (
  select *,
    needs_item and has_item and raw_name is null as bad_item,
    event_id % 97 = 0 or event_id % 89 = 0 as bad_time,
    epoch_us(date_trunc('second', ts)) // 1000 as event_ms
  from i
)"""

BROKEN = "event_id % 101 = 0 or event_id % 103 = 0"


def _page_views(ms: int) -> str:
    return f"""with {CLICKS}
select cast({ms} as bigint) as "durationMS", "timestamp" // {ms} * {ms} as "startTime", page, count(*) as count
from c where event = 'browse' group by 2, 3"""


LINE_TIME = """1704067200000 + ((l_orderkey + l_linenumber) % 7) * 86400000 + ((l_orderkey * 13) % 1440) * 60000
    + l_linenumber * 1000"""

STOCK = f"""
stock as (
  select cast(l_quantity as int) as count, 0 as sku, cast(l_partkey // 100 as int) as product_id,
    cast(l_suppkey as int) as store_id, 0 as "aisleId", cast(null as varchar) as product_name,
    cast(l_linenumber as int) as "departmentId", cast(null as double) as price, cast(null as varchar) as "recipeId",
    cast(null as varchar) as image, {LINE_TIME} as "timestamp"
  from lineitem where l_returnflag = 'A' and l_linestatus = 'F'
)"""

TRANSACTIONS = f"""
tx as (
  select {LINE_TIME} as "timestamp", cast(o_custkey as int) as uid, 'O-' || l_orderkey || '-' || l_linenumber as order_number,
    cast(o_custkey as int) as user_id, cast(l_suppkey + if(l_orderkey % 11 = 0, 1000000, 0) as int) as store_id, {LINE_TIME} as time_of_sale,
    cast(l_linenumber as int) as department_id, cast(l_partkey // 100 as int) as product_id,
    cast(l_quantity as int) as product_count, cast(cast(l_extendedprice as float) as double) as price
  from lineitem join orders on l_orderkey = o_orderkey where l_linestatus = 'O'
)"""

STORES = """
stores as (
  select cast(s_suppkey as int) as id, cast(10000 + s_suppkey as int) as zip, n_name as city, r_name as state,
    cast(1 as double) as lat, cast(1 as double) as lng
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""

STOCK_COUNTS = f"""{STOCK},
counted as (
  select "timestamp" // 5000 * 5000 as "startTime", product_id, store_id, count(*) as count from stock group by 1, 2, 3
)"""
TX_COUNTS = f"""{TRANSACTIONS},
counted as (
  select "timestamp" // 5000 * 5000 as w, product_id, store_id, count(*) as count from tx group by 1, 2, 3
)"""


def _sessions(gap: int) -> str:
    return f"""{CLICKS},
marked as (
  select *, case when "timestamp" - lag("timestamp") over (partition by client_id order by "timestamp", event_id) < {gap}
    then 0 else 1 end as opens
  from c
),
numbered as (
  select *, sum(opens) over (partition by client_id order by "timestamp", event_id rows unbounded preceding) as no from marked
),
tagged as (
  select *, min("timestamp") over (partition by client_id, no) as session_start from numbered
),
summary as (
  select client_id, session_start, max("timestamp") as session_end, count(*) as n_events from tagged group by 1, 2
)"""


ALL_FEEDS = f"""{CLICKS}, {STOCK}, {TRANSACTIONS},
feeds as (
  select page as product_id, 'WEB' as store_id,
    case when event in ('view_item', 'browse') then 'VIEW' when event = 'add-to-cart' then 'CART_ADD' else 'SALE' end as event_type,
    cast(1 as bigint) as quantity, "timestamp"
  from c where event in ('view_item', 'browse', 'add-to-cart', 'purchase') and not ({BROKEN})
  union all
  select cast(product_id as varchar), cast(store_id as varchar), 'RECEIPT', cast(count as bigint), "timestamp" from stock
  union all
  select cast(product_id as varchar), cast(store_id as varchar), 'SALE', cast(product_count as bigint), time_of_sale from tx
)"""

UNIFY_STOCK = f"""with {STOCK}
select cast(product_id as varchar) as product_id, cast(store_id as varchar) as store_id, 'RECEIPT' as event_type,
  cast(count as bigint) as quantity, "timestamp", cast(null as varchar) as metadata
from stock"""

LATEST_STOCK = f"""with {INVENTORY}
select 'stock:' || store_id || ':' || product_id as key, cast(on_hand as varchar) as value
from on_hand qualify row_number() over (partition by store_id, product_id order by n desc) = 1"""

NO_STORE = "'unknown store ' || store_id"
TX_COLS = """"timestamp", uid, order_number, user_id, store_id, time_of_sale, department_id, product_id, product_count, price"""
STORE_COLS = "id, zip, city, state, lat, lng"
MISSING_TEXT = "Event requires item to be set, but not set"
PARSE_TEXT = "case when event_id % 101 = 0 then 'Message does not match the schema' else 'Empty message' end"
PARSE_DATA = "case when event_id % 101 = 0 then '{broken' else '' end"

PAGE_CELLS = f"""with v as ({_page_views(3600000)})
select page || '-' || "startTime" as row_key, 'pageViewAgg' as family, 'pageViewRef' as qualifier,
  hex(encode(page)) as value from v
union all
select page || '-' || "startTime", 'pageViewAgg', 'pageViewCount', lpad(hex(count), 16, '0') from v"""

CLICK_JOB_VIEWS = f"""with {CHECKED}
select cast(5000 as bigint) as "durationMS", t // 5000 * 5000 as "startTime", page, count(*) as count
from (select *, case when bad_time then arrival_ms else event_ms end as t from checked)
where event = 'browse' and not ({BROKEN}) group by 2, 3"""

LATEST_SIGNAL = f"""with {VELOCITY}
select 'signal:' || store_id || ':' || product_id as key,
  case when h >= 100 then printf('Signal{{type=''FAST'', window=''1h'', count=%d}}', h)
       else printf('Signal{{type=''SLOW'', window=''24h'', count=%d}}', d) end as value
from signal qualify row_number() over (partition by store_id, product_id order by n desc) = 1"""

ORACLE = {
    "inventory_on_hand": f"with {INVENTORY} select {EVENT_COLS}, on_hand from on_hand",
    "inventory_on_hand_stream": f"with {INVENTORY} select {EVENT_COLS}, on_hand from on_hand",
    "inventory_on_hand_split": f"with {INVENTORY} select {EVENT_COLS}, on_hand from on_hand",
    "velocity_signal_split": _signal(100),
    "session_events_split": f"""with {_sessions(43200000)} select event_id, client_id, "timestamp", session_start from tagged""",
    "two_loads_clean_rows": f"with {STOCK} select * from stock",
    "inventory_latest_kv": LATEST_STOCK,
    "serving_table_stock": LATEST_STOCK,
    "dropped_by_reset_audit": f"""with {INVENTORY} select {EVENT_COLS}, last_reset from barrier
        where event_type <> 'RESET' and "timestamp" < last_reset""",
    "velocity_signal": _signal(100),
    "velocity_signal_stream": _signal(100),
    "velocity_signal_20": _signal(20),
    "velocity_latest_kv": LATEST_SIGNAL,
    "unify_clickstream": f"""with {CLICKS}
        select event_id, page as product_id, 'WEB' as store_id,
          case when event in ('view_item', 'browse') then 'VIEW' when event = 'add-to-cart' then 'CART_ADD' else 'SALE' end as event_type,
          cast(1 as bigint) as quantity, "timestamp", cast(null as varchar) as metadata
        from c where event in ('view_item', 'browse', 'add-to-cart', 'purchase') and not ({BROKEN})""",
    "unify_stock": UNIFY_STOCK,
    "json_lines_roundtrip": UNIFY_STOCK,
    "unify_transactions": f"""with {TRANSACTIONS}
        select cast(product_id as varchar) as product_id, cast(store_id as varchar) as store_id, 'SALE' as event_type,
          cast(product_count as bigint) as quantity, time_of_sale as "timestamp", order_number as metadata
        from tx""",
    "union_events": f"""with {ALL_FEEDS}
        select store_id || '-' || product_id as key, event_type, count(*) as n, cast(sum(quantity) as bigint) as quantity
        from feeds group by 1, 2""",
    "parse_clickstream_good": f"""with {CLICKS}
        select event_datetime, event, "timestamp", user_id, client_id, page, page_previous, event_id, arrival_ms, {ITEM_COLS}
        from i where not ({BROKEN})""",
    "parse_clickstream_bad": f"""with {CLICKS}
        select cast(null as varchar) as transform, {PARSE_TEXT} as error, {PARSE_DATA} as data, arrival_ms as at_ms
        from c where {BROKEN}""",
    "dead_letter_log_lines": f"""with {CLICKS}
        select {PARSE_DATA} || ' failed with ' || {PARSE_TEXT} || ' at '
          || strftime(make_timestamp(arrival_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') || ' in null' as line
        from c where {BROKEN}""",
    "dead_letter_clamped": f"""with {CLICKS}
        select event as data, event_id, case when event = 'browse' then arrival_ms else 253402214400000 end as at_ms from c""",
    "parse_stock_rows": f"with {STOCK} select * from stock",
    "parse_transaction_rows": f"with {TRANSACTIONS} select * from tx",
    "page_views_5s": _page_views(5000),
    "aggregate_table_roundtrip": _page_views(5000),
    "page_views_1h": _page_views(3600000),
    "page_views_1h_stream": _page_views(3600000),
    "page_view_cells": PAGE_CELLS,
    "non_error_events": f"with {CLICKS} select event, count(*) as n from c where event <> 'ERROR' group by 1",
    "stock_counts": f"""with {STOCK_COUNTS}
        select cast(5000 as bigint) as "durationMS", "startTime", product_id, store_id, count from counted""",
    "global_stock_updates": f"""with {STOCK_COUNTS}
        select cast(5000 as bigint) as "durationMS", "startTime", product_id, cast(null as int) as store_id, count(*) as count
        from counted group by 2, 3""",
    "global_stock_updates_stream": f"""with {STOCK_COUNTS}
        select cast(5000 as bigint) as "durationMS", "startTime", product_id, cast(null as int) as store_id, count(*) as count
        from counted group by 2, 3""",
    "transaction_counts": f"""with {TX_COUNTS}
        select cast(null as bigint) as "durationMS", cast(null as bigint) as "startTime", product_id, store_id, count from counted""",
    "global_stock_from_transactions": f"""with {TX_COUNTS}
        select cast(5000 as bigint) as "durationMS", w as "startTime", product_id, cast(null as int) as store_id, count(*) as count
        from counted group by 2, 3""",
    "sessions_30s": f"with {_sessions(30000)} select * from summary",
    "sessions_12h": f"with {_sessions(43200000)} select * from summary",
    "sessions_12h_stream": f"""with {_sessions(43200000)} select * from summary""",
    "session_events_12h": f"""with {_sessions(43200000)} select event_id, client_id, "timestamp", session_start from tagged""",
    "sessionized_12h": f"""with {_sessions(43200000)}
        select client_id, session_start, cast(0 as bigint) as part, cast(count(*) as int) as n_events,
          string_agg(event, ',' order by "timestamp", event_datetime, event) as events
        from tagged group by 1, 2""",
    "sessionized_12h_stream": f"""with {_sessions(43200000)}
        select client_id, session_start, cast(0 as bigint) as part, cast(count(*) as int) as n_events,
          string_agg(event, ',' order by "timestamp", event_datetime, event) as events
        from tagged group by 1, 2""",
    "late_views_stream": f"""with {CLICKS},
        span as (select min(arrival_ms) as low, max(arrival_ms) as high from c),
        planted as (select c.*, event_id % 50 = 0 and arrival_ms * 10 > low + 9 * high as late from c, span)
        select page, "timestamp" // 3600000 * 3600000 as "startTime", count(*) as count
        from planted where event = 'browse' and not late group by 1, 2
        union all select 'late', null, count(*) from planted where late""",
    "clickstream_job_stream": CLICK_JOB_VIEWS,
    "clickstream_job_stream_sessions": f"""with {CHECKED},
        clean as (
          select *, case when bad_time then arrival_ms else event_ms end as t from checked
          where not (needs_item and not has_item) and not ({BROKEN})),
        marked as (
          select *, case when t - lag(t) over (partition by client_id order by t, event_id) < 30000 then 0 else 1 end as opens from clean),
        numbered as (select *, sum(opens) over (partition by client_id order by t, event_id rows unbounded preceding) as no from marked)
        select client_id, min(t) as session_start, cast(count(*) as int) as n_events from numbered group by client_id, no""",
    "inventory_job_stream": f"select * from ({LATEST_STOCK}) union all select * from ({LATEST_SIGNAL})",
    "attribute_time_views_stream": f"""with {CLICKS}
        select cast(3600000 as bigint) as "durationMS", arrival_ms // 3600000 * 3600000 as "startTime", page, count(*) as count
        from c where event = 'browse' and not ({BROKEN}) group by 2, 3""",
    "versioned_stores_stream": f"""with {TRANSACTIONS}, {STORES}
        select {TX_COLS}, id, cast(zip + 100000 * least(2, ("timestamp" - 1704067200000) // 259200000) as int) as zip, city, state, lat, lng
        from tx join stores on store_id = id""",
    "parse_failure_metrics": f"""with {CLICKS}
        select 'clickstream' as feed, true as has_good, true as same, count(*) as failures from c where {BROKEN}
        union all select 'stock', true, true, null""",
    "raw_archive_content": f"""with {CLICKS}
        select event_datetime, event, "timestamp", user_id, client_id, page, page_previous, {ITEM_COLS}
        from i where not ({BROKEN})""",
    "page_view_cells_table": PAGE_CELLS,
    "missing_items_dead_letter": f"""with {CLICKS}
        select event_id, '{MISSING_TEXT}' as error, arrival_ms as at_ms from i where needs_item and not has_item""",
    "invalid_items": f"""with {CHECKED}
        select event_id, case when bad_item then 'CORR_ITEM' else '' end as errors from checked where not (needs_item and not has_item)""",
    "bad_event_time": f"""with {CHECKED}
        select event_id, case when bad_time then 'CORR_TIME' else '' end as errors,
          case when bad_time then "timestamp" else event_ms end as "timestamp"
        from checked""",
    "validated_clean": f"""with {CHECKED},
        k as (select cast(p_partkey as varchar) as known_id, p_name, p_brand, p_type from part)
        select event_datetime, event, case when bad_time then arrival_ms else event_ms end as "timestamp", user_id, client_id,
          page, page_previous, event_id, arrival_ms, n_items,
          case when has_item then shown_item end as item_id,
          case when bad_item and known_id is not null then p_name when has_item then raw_name end as item_name,
          case when bad_item and known_id is not null then p_brand when has_item then 'B' end as item_brand,
          case when bad_item and known_id is not null then p_type when has_item then 'cat' end as item_category,
          case when has_item then cast(cast(value as float) as double) end as price,
          case when has_item then 1 + k % 3 end as item_quantity
        from checked left join k on checked.shown_item = known_id where not (needs_item and not has_item)""",
    "store_dimension": f"with {STORES} select {STORE_COLS} from stores",
    "store_locations_table": f"with {STORES} select {STORE_COLS} from stores",
    "enriched_transactions": f"with {TRANSACTIONS}, {STORES} select {TX_COLS}, {STORE_COLS} from tx join stores on store_id = id",
    "enriched_transactions_stream": f"with {TRANSACTIONS}, {STORES} select {TX_COLS}, {STORE_COLS} from tx join stores on store_id = id",
    "unknown_store_dead_letter": f"""with {TRANSACTIONS}, {STORES}
        select order_number, {NO_STORE} as error, "timestamp" as at_ms from tx anti join stores on store_id = id""",
    "raw_archive_counts": f"""with {CLICKS},
        lines as (select case when {BROKEN} then {PARSE_DATA} else cast(event_id as varchar) end as json from c),
        per_line as (select json, count(*) as n from lines group by 1)
        select n, count(*) as messages from per_line group by 1""",
    "feeds_to_stock_values": f"""with {ALL_FEEDS}
        select 'stock:' || store_id || ':' || product_id as key,
          cast(cast(sum(case when event_type = 'SALE' then -quantity else quantity end) as bigint) as varchar) as value
        from feeds where event_type in ('SALE', 'RECEIPT') group by store_id, product_id""",
    "feeds_to_signal_values": f"""with {ALL_FEEDS},
        sales as (
          select *, max("timestamp") over (partition by store_id, product_id) // 60000 as ref, "timestamp" // 60000 as m
          from feeds where event_type = 'SALE'),
        sums as (
          select store_id, product_id, cast(sum(case when m > ref - 60 then quantity else 0 end) as bigint) as h,
            cast(sum(case when m > ref - 1440 then quantity else 0 end) as bigint) as d
          from sales group by 1, 2)
        select 'signal:' || store_id || ':' || product_id as key,
          case when h >= 100 then printf('Signal{{type=''FAST'', window=''1h'', count=%d}}', h)
               else printf('Signal{{type=''SLOW'', window=''24h'', count=%d}}', d) end as value
        from sums""",
    "clickstream_job_views": CLICK_JOB_VIEWS,
    "clickstream_job_letters": f"""with {CLICKS}
        select error, count(*) as n, max(arrival_ms) as last_ms from (
          select '{MISSING_TEXT}' as error, arrival_ms from i where needs_item and not has_item and not ({BROKEN})
          union all select {PARSE_TEXT}, arrival_ms from c where {BROKEN})
        group by 1""",
    "transaction_job_rows": f"""with {TRANSACTIONS}, {STORES}
        select {TX_COLS}, "timestamp" // 5000 * 5000 as window_ms, {STORE_COLS} from tx join stores on store_id = id""",
    "stock_job_rows": f"""with {STOCK}
        select product_id, store_id, count, "timestamp", "timestamp" // 5000 * 5000 as window_ms from stock""",
}
