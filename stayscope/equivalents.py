"""SQL that gives the same result as each query of the catalog, over the same tables."""

from __future__ import annotations

from stayscope.catalog import PARTITION_YEAR, WARM

_BOOKINGS = """
bookings AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_id, l_suppkey AS hotel_id,
         strftime(l_shipdate, '%Y-%m-%d') AS srch_ci,
         CASE WHEN l_quantity = 50 THEN NULL
              ELSE strftime(l_shipdate + to_days(CAST(l_quantity AS INT) - 8), '%Y-%m-%d')
         END AS srch_co,
         {children} AS srch_children_cnt
  FROM lineitem)"""

_WEATHER = """
weather AS (
  SELECT s_suppkey AS "Id", strftime(o_orderdate, '%Y-%m-%d') AS "wthrDate",
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 45 - 10 AS DOUBLE) AS "avgTmprC",
         {name} AS hotel_name
  FROM orders JOIN supplier ON o_custkey % (SELECT count(*) FROM supplier) = s_suppkey)"""

_ENRICHED = """
enriched AS (
  SELECT order_id, srch_ci, srch_co, srch_children_cnt, hotel_id, hotel_name,
         avg("avgTmprC") AS avg_tmpr,
         abs(date_diff('day', CAST(srch_ci AS DATE), CAST(srch_co AS DATE))) AS duration_stay
  FROM bookings JOIN weather ON "Id" = hotel_id AND "wthrDate" = srch_ci
  WHERE "avgTmprC" > 0
  GROUP BY order_id, srch_ci, srch_co, srch_children_cnt, hotel_id, hotel_name)"""

_PREFERENCES = """
preferences AS (
  SELECT hotel_name, hotel_id, order_id, duration_stay, srch_children_cnt AS children_cnt,
         initial_state,
         CASE initial_state
              WHEN 'Erroneous data' THEN 'null/ more than 30 days/ less or equal to 0'
              WHEN 'Short stay' THEN '1 day stay'
              WHEN 'Standart stay' THEN '2-7 days'
              WHEN 'Standart extended stay' THEN ' 1-2 weeks'
              WHEN 'Long stay' THEN '2-4 weeks (less than month)' END AS initial_state_value
  FROM (SELECT *, CASE WHEN duration_stay = 1 THEN 'Short stay'
                       WHEN duration_stay BETWEEN 2 AND 7 THEN 'Standart stay'
                       WHEN duration_stay BETWEEN 8 AND 14 THEN 'Standart extended stay'
                       WHEN duration_stay BETWEEN 15 AND 30 THEN 'Long stay'
                       ELSE 'Erroneous data' END AS initial_state
        FROM enriched))"""

_COUNTERS = """
         count(*) FILTER (initial_state = 'Erroneous data') AS erroneous_data_cnt,
         count(*) FILTER (initial_state = 'Short stay') AS short_stay_cnt,
         count(*) FILTER (initial_state = 'Standart stay') AS standart_stay_cnt,
         count(*) FILTER (initial_state = 'Standart extended stay')
             AS standart_extended_stay_cnt,
         count(*) FILTER (initial_state = 'Long stay') AS long_stay_cnt"""

_FLAGS = """
         count(*) FILTER (children_cnt > 0) AS with_children_true,
         count(*) FILTER (children_cnt <= 0) AS with_children_false,"""

_POPULAR = """
  CASE greatest(erroneous_data_cnt, short_stay_cnt, standart_stay_cnt,
                standart_extended_stay_cnt, long_stay_cnt)
       WHEN standart_stay_cnt THEN 'standart_stay_cnt'
       WHEN standart_extended_stay_cnt THEN 'standart_extended_stay_cnt'
       WHEN short_stay_cnt THEN 'short_stay_cnt'
       WHEN long_stay_cnt THEN 'long_stay_cnt'
       ELSE 'erroneous_data_cnt' END AS most_popular_stay_type"""

_BY_HOTEL = f"""
by_hotel AS (
  SELECT hotel_name, hotel_id,{_COUNTERS}
  FROM preferences GROUP BY hotel_name, hotel_id)"""

_BY_CHILDREN = f"""
by_children AS (
  SELECT hotel_name, children_cnt,{_FLAGS}{_COUNTERS}
  FROM preferences GROUP BY hotel_name, children_cnt)"""

_PLAIN_CHILDREN = "l_linenumber % 4"
_SOME_UNKNOWN = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber % 4 END"
_OWN_NAME = "s_name"
_SHARED_NAME = "'Hotel ' || CAST(s_suppkey % 7 AS VARCHAR)"


def _sql(select: str, children: str = _PLAIN_CHILDREN, name: str = _OWN_NAME) -> str:
    views = [
        _BOOKINGS.format(children=children),
        _WEATHER.format(name=name),
        _ENRICHED,
        _PREFERENCES,
        _BY_HOTEL,
        _BY_CHILDREN,
    ]
    return f"WITH {','.join(views)}\n{select}"


_HOTEL_RESULT = f"SELECT *,{_POPULAR} FROM by_hotel"
_CHILDREN_RESULT = f"SELECT * EXCLUDE (children_cnt),{_POPULAR} FROM by_children"
_BOOKING_ROWS = "SELECT order_id AS id, * EXCLUDE (order_id) FROM bookings"
_PROPS = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"

_ENCODED = """SELECT CAST(CASE WHEN duration_stay IS NULL
  THEN json_object('hotel_name', hotel_name, 'hotel_id', hotel_id, 'order_id', order_id,
                   'children_cnt', children_cnt, 'initial_state', initial_state,
                   'initial_state_value', initial_state_value)
  ELSE json_object('hotel_name', hotel_name, 'hotel_id', hotel_id, 'order_id', order_id,
                   'duration_stay', duration_stay, 'children_cnt', children_cnt,
                   'initial_state', initial_state, 'initial_state_value', initial_state_value)
  END AS VARCHAR) AS value FROM preferences"""

_WINDOWS = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n
FROM events GROUP BY 1
HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
       <= (SELECT max(ts) FROM events) - INTERVAL 5 SECOND"""

SQL: dict[str, str] = {
    "batch_popular_by_hotel": _sql(_HOTEL_RESULT),
    "batch_popular_by_hotel_counting_first": _sql(_HOTEL_RESULT),
    "batch_popular_by_hotel_copies": _sql(_HOTEL_RESULT),
    "batch_popular_by_hotel_adaptive": _sql(_HOTEL_RESULT),
    "project_weather": _sql("SELECT * FROM weather"),
    "filter_min_temperature": _sql(f'SELECT * FROM weather WHERE "avgTmprC" > {WARM}'),
    "enrich_bookings": _sql("SELECT * FROM enriched"),
    "distinct_bookings": _sql("SELECT DISTINCT * FROM bookings"),
    "stay_duration": _sql(
        "SELECT order_id, abs(date_diff('day', CAST(srch_ci AS DATE), "
        "CAST(srch_co AS DATE))) AS duration_stay FROM bookings"
    ),
    "classify_stay": _sql("SELECT * FROM preferences"),
    "stay_counts_by_hotel": _sql("SELECT * FROM by_hotel"),
    "stay_counts_by_hotel_children": _sql("SELECT * FROM by_children"),
    "most_popular": _sql(f"SELECT hotel_id, most_popular_stay_type FROM ({_HOTEL_RESULT})"),
    "popular_by_children": _sql(_CHILDREN_RESULT),
    "popular_by_children_counting_first": _sql(_CHILDREN_RESULT),
    "popular_merged_names": _sql(_HOTEL_RESULT, _SOME_UNKNOWN, _SHARED_NAME),
    "popular_by_children_merged_names": _sql(_CHILDREN_RESULT, _SOME_UNKNOWN, _SHARED_NAME),
    "count_by_type": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "json_encode": (
        "SELECT event_id, CAST(json_object('event_id', event_id, 'event_type', event_type) "
        "AS VARCHAR) AS value FROM events"
    ),
    "encode_preferences": _sql(_ENCODED),
    "json_topic_parse": _PROPS,
    "json_topic_infer": _PROPS,
    "json_topic_stored": (
        "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
        "CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events"
    ),
    "popular_from_topic": _sql(_HOTEL_RESULT),
    "scan_bookings": _sql(_BOOKING_ROWS),
    "partition_scan": _sql(f"{_BOOKING_ROWS} WHERE CAST(srch_ci[1:4] AS INT) = {PARTITION_YEAR}"),
    "bookings_by_month": _sql("SELECT * FROM enriched"),
    "enrich_bucketed": _sql("SELECT * FROM enriched"),
    "parquet_roundtrip": _sql(_HOTEL_RESULT),
    "stream_scan_bookings": _sql(_BOOKING_ROWS),
    "stream_enrich": _sql("SELECT * FROM enriched"),
    "stream_popular_by_children": _sql(_CHILDREN_RESULT),
    "stream_popular_by_children_copies": _sql(_CHILDREN_RESULT),
    "stream_popular_by_hotel": _sql(_HOTEL_RESULT),
    "stream_popular_collapsed": _sql(_HOTEL_RESULT),
    "stream_restart": _sql(_HOTEL_RESULT),
    "stream_late_bookings": _sql(_HOTEL_RESULT),
    "stream_copies_after_bound": _sql(_HOTEL_RESULT),
    "stream_weather_later": _sql(_HOTEL_RESULT),
    "stream_via_topic": _sql(_CHILDREN_RESULT),
    "topic_complete": _sql(_HOTEL_RESULT),
    "stamped_snapshot": _sql(_HOTEL_RESULT),
    "windowed_count": _WINDOWS,
    "windowed_count_resumed": _WINDOWS,
    "windowed_count_amended": _WINDOWS,
    "atomic_replace": _sql(_BOOKING_ROWS),
    "batch_popular_incremental": _sql(_HOTEL_RESULT),
}
