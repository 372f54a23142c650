"""The same results in plain SQL, for an engine with the tables as views.

A key is missing where no statement could give the result; none is at present.
"""

from __future__ import annotations

NAME = "'지표 ' || event_type"
MILLIS = "epoch_us(ts) // 1000"
PARTITION = "ascii(event_type) % 3"
FULL_TEXT = (
    f"""'{{"indicator":"' || event_type || '","name":"' || {NAME} || '","value":' || value """
    f"""|| ',"ts":' || ({MILLIS}) || ',"source":"mock"}}'"""
)


def mean(value: str) -> str:
    """The mean, rounded half up to 4 digits, in whole cents: exact, where a sum of doubles would
    make ties depend on the order of the rows. Readings have two decimals and are not negative."""
    cents = f"CAST(round(({value}) * 100) AS BIGINT)"
    return f"CAST((200 * sum({cents}) + count({value})) // (2 * count({value})) AS DOUBLE) / 10000"


def windows(slide: str, value: str = "value", rows: str = "events", where: str = "true") -> str:
    """Statistics per window of twice the slide; each row lies in two of them."""
    step = f"INTERVAL '{slide}'"
    return f"""
        SELECT w AS "start", w + 2 * {step} AS "end", event_type AS indicator,
               {mean(value)} AS avg_value, round(max({value}), 4) AS max_value,
               count(*) AS cnt
        FROM (SELECT *, unnest([time_bucket({step}, ts), time_bucket({step}, ts) - {step}]) AS w
              FROM {rows})
        WHERE {where}
        GROUP BY w, event_type"""


CLOSED = "w + INTERVAL '1 minute' <= (SELECT max(ts) FROM events) - INTERVAL '2 minutes'"
MINUTE = windows("30 seconds")
MINUTE_CLOSED = windows("30 seconds", where=CLOSED)
HOUR = windows("30 minutes")
# Messages carry milliseconds, and so does the time that closes their windows.
CLOSED_MILLIS = CLOSED.replace("max(ts)", f"make_timestamp(max({MILLIS}) * 1000)")

RESPONSE = """
        SELECT event_type AS stat_code, event_id, strftime(ts, '%Y%m%d') AS time,
               CAST(user_id AS VARCHAR) AS item_code, value AS data_value"""
PER_DATE = f"""
        SELECT CAST(ts AS DATE) AS dt, event_type AS indicator, count(*) AS n,
               max(value) AS max_value, min({MILLIS}) AS first_ts
        FROM events GROUP BY ALL"""
LINES = f"""
        SELECT '[' || ({PARTITION}) || '@' || event_id || '] ' || {NAME} || '=' || value AS line
        FROM events"""
# Days from the first event to the last window's end, and the one in the middle.
HALF = """
        SELECT low + greatest(1, (high - low) // 2)::INTEGER AS half
        FROM (SELECT min(ts)::DATE AS low, (max(ts) + INTERVAL '1 minute' - INTERVAL '1 microsecond')::DATE + 1 AS high
              FROM events)"""
OFFSETS = f"""
        SELECT dt, partition, min(place) AS first_offset, max(place) + 1 AS next_offset
        FROM (SELECT dt, partition, place,
                     place - row_number() OVER (PARTITION BY dt, partition ORDER BY place) AS run
              FROM (SELECT ts::DATE AS dt, (event_id % 3)::INTEGER AS partition, event_id // 3 AS place, value
                    FROM events)
              WHERE value < 100 OR dt < ({HALF}))
        GROUP BY dt, partition, run"""
# Pages of 20 entries, as the feed makes and damages them; entries held by none, as ranges.
PAGES = """
        WITH entries AS (
            SELECT event_type AS stat_code, event_id // 500 AS block,
                   row_number() OVER (PARTITION BY event_type, event_id // 500 ORDER BY event_id) AS entry
            FROM events
        ), pages AS (
            SELECT stat_code, block, count(*) AS total, unnest(range(0, (count(*) - 1) // 20 + 1)) AS page
            FROM entries GROUP BY stat_code, block
        ), landed AS (
            SELECT stat_code, block, page * 20 + 1 - CASE WHEN (block + page) % 6 = 0 AND page > 0 THEN 5 ELSE 0 END AS first,
                   least(page * 20 + 20, total) AS last
            FROM pages WHERE (block + page) % 4 <> 1 AND (block + page) % 7 <> 2
        ), asked AS (
            SELECT DISTINCT stat_code, block FROM pages WHERE (block + page) % 4 <> 1
        ), gaps AS (
            SELECT stat_code, block, entry, entry - row_number() OVER (PARTITION BY stat_code, block ORDER BY entry) AS run
            FROM entries JOIN asked USING (stat_code, block)
            WHERE NOT EXISTS (FROM landed l WHERE l.stat_code = entries.stat_code AND l.block = entries.block
                              AND entry BETWEEN first AND last)
        )
        SELECT stat_code, block, min(entry)::BIGINT AS first, max(entry)::BIGINT AS last
        FROM gaps GROUP BY stat_code, block, run"""

ORACLES: dict[str, str] = {
    "sliding_agg_1m": MINUTE,
    "sliding_agg_1h": HOUR,
    "null_value_count": windows("30 minutes", "CASE WHEN value >= 5 THEN value END"),
    "parse_events": f"""
        SELECT CAST({PARTITION} AS INTEGER) AS partition, event_id AS "offset",
               event_type AS indicator, {NAME} AS name, value, {MILLIS} AS ts, 'mock' AS source,
               make_timestamp(({MILLIS}) * 1000) AS event_time
        FROM events""",
    "message_agg_1m": MINUTE,
    "envelope_build": f"""
        SELECT event_id, event_type AS key, event_type AS indicator, {NAME} AS name,
               round(value / 7, 4) AS value, {MILLIS} AS ts, 'replay' AS source
        FROM events""",
    "null_time_drop": windows("30 minutes", where="value >= 10 AND value < 200"),
    "json_quarantine": f"""
        SELECT CASE WHEN value >= 100 OR value < 12 THEN 'bad' ELSE 'good' END AS verdict,
               event_id AS "offset",
               CASE WHEN value >= 12 AND value < 100 THEN event_type END AS indicator,
               CASE WHEN value >= 12 AND value < 100 THEN value END AS value,
               CASE WHEN value >= 100 THEN left(body, length(body) - 10)
                    WHEN value < 2
                    THEN replace(body, '"value":' || value || ',', '"value":"none",')
                    WHEN value < 4 THEN ''
                    WHEN value < 6 THEN ' '
                    WHEN value < 8 THEN '{{}}'
                    WHEN value < 10 THEN body || body
                    WHEN value < 12 THEN body || 'xyz' END AS raw
        FROM (SELECT *, {FULL_TEXT} AS body FROM events)""",
    "strict_events": f"""
        SELECT event_id AS "offset", {NAME} AS name, value, {MILLIS} AS ts FROM events""",
    "response_explode": f"{RESPONSE} FROM events",
    "response_page": f"""{RESPONSE} FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type, event_id // 500 ORDER BY event_id)
                <= 100""",
    "response_pages": f"""{RESPONSE}, ((row_number() OVER
                   (PARTITION BY event_type, event_id // 500 ORDER BY event_id) - 1) // 100 + 1)::INTEGER AS page
        FROM events""",
    "missing_pages": PAGES,
    "series_select": """
        SELECT event_id, event_type AS stat_code, CAST(user_id AS VARCHAR) AS item_code,
               value AS data_value, 'D' AS cycle, strftime(ts, '%Y%m%d') AS time
        FROM events
        WHERE event_type = 'view' AND CAST(ts AS DATE) BETWEEN '2024-01-05' AND '2024-01-20'
        UNION ALL
        SELECT event_id, event_type, CAST(user_id AS VARCHAR), value, 'M', strftime(ts, '%Y%m')
        FROM events
        WHERE event_type = 'error' AND user_id = 8 AND year(ts) = 2024 AND month(ts) = 1""",
    "provider_union": """
        SELECT event_id, event_type AS indicator, value,
               CASE WHEN value < 10 THEN 'ecos' WHEN value < 50 THEN 'kosis' ELSE 'fiscal' END
                   AS source
        FROM events""",
    "catalogue_join": """
        SELECT event_type AS indicator, event_id, value, c.name
        FROM events
        LEFT JOIN (VALUES ('click', '클릭'), ('view', '조회'), ('purchase', '구매'),
                          ('signup', '가입')) AS c(code, name) ON event_type = c.code""",
    "consumer_lines": LINES,
    "commit_progress": f"""
        SELECT 'econ-consumer-1' AS "group", 'readings' AS topic,
               CAST({PARTITION} AS INTEGER) AS partition, max(event_id) + 1 AS "offset"
        FROM events GROUP BY ALL""",
    "lag_report": f"""
        SELECT 'readings' AS topic, p AS partition, end_offset, committed,
               end_offset - coalesce(committed, begin_offset) AS lag
        FROM (SELECT CAST({PARTITION} AS INTEGER) AS p, min(event_id) AS begin_offset,
                     max(event_id) + 1 AS end_offset FROM events GROUP BY 1)
        LEFT JOIN (SELECT CAST({PARTITION} AS INTEGER) AS p, max(event_id) + 1 AS committed
                   FROM events
                   WHERE ts < TIMESTAMP '2024-01-21' AND {PARTITION} <> 2 GROUP BY 1) USING (p)""",
    "delivery_report": f"""
        SELECT 'readings' AS topic, CAST({PARTITION} AS INTEGER) AS partition,
               count(*) FILTER (value <= 100) AS delivered,
               count(*) FILTER (value > 100) AS failed,
               max(event_id) FILTER (value <= 100) AS last_offset
        FROM events GROUP BY ALL""",
    "stream_append": MINUTE_CLOSED,
    "stream_open_windows": f"""
        SELECT *, 0 AS open FROM ({MINUTE_CLOSED}) UNION ALL
        SELECT *, 1 FROM ({windows("30 seconds", where=f"NOT ({CLOSED})")})""",
    "stream_quarantine": f"""
        SELECT event_id AS "offset", CASE WHEN value >= 8 AND value < 100 THEN event_type END AS indicator,
               CASE WHEN value >= 8 AND value < 100 THEN value END AS value,
               CASE WHEN value >= 100 THEN left(body, length(body) - 10) WHEN value < 8 THEN '{{}}' END AS raw
        FROM (SELECT *, {FULL_TEXT} AS body FROM events)""",
    "stream_message_agg": windows("30 seconds", where=CLOSED_MILLIS),
    "stream_late_drop": MINUTE_CLOSED,
    "stream_restart": MINUTE_CLOSED,
    "stream_update_latest": MINUTE,
    "results_compacted": MINUTE,
    "stream_compacted": MINUTE_CLOSED,
    "stream_foreach_batch": LINES,
    "stream_raw_landing": PER_DATE,
    "parquet_partitioned": HOUR,
    "raw_by_date": PER_DATE,
    "results_latest": HOUR,
    "interval_ingest_agg": MINUTE,
    "interval_late": MINUTE,
    "interval_offsets": OFFSETS,
    "interval_panes": MINUTE,
    "backfill": f"""
        SELECT dt, sum(event)::BIGINT AS events, sum(win)::BIGINT AS windows
        FROM (SELECT CAST(ts AS DATE) AS dt, 1 AS event, 0 AS win FROM events
              UNION ALL
              SELECT CAST("end" - INTERVAL '1 microsecond' AS DATE), 0, 1 FROM ({MINUTE}))
        GROUP BY dt""",
}
