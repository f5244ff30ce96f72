"""The bound queries as standard SQL, for an independent engine on the same tables."""

from __future__ import annotations

from tidemark.functions.hashing import word_filter_shape

_RATE = """
WITH rate AS (
  SELECT event_id, user_id, ts AS et, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ts,
         event_type AS hbdm, CAST(json_extract_string(props, '$.k') AS INTEGER) AS num
  FROM events
), closing AS (
  SELECT (max(us) // 1000 - 1000) * 1000 AS closed_us FROM rate
)
"""

_MS_TIME = "make_timestamp((us // 1000) * 1000)"
_TIME_TEXT = f"strftime({_MS_TIME}, '%Y-%m-%d %H:%M:%S.%g')"

_DECODE_JSON = """
SELECT event_id,
       CASE WHEN event_id % 10 <> 0 THEN ts END AS ts,
       CASE WHEN event_id % 10 <> 0 THEN hbdm END AS hbdm,
       CASE WHEN event_id % 10 <> 0 THEN num END AS num,
       event_id % 10 <> 0 AS is_valid
FROM rate
"""

_DECODE_CSV = _DECODE_JSON.replace("event_id % 10 <> 0", "event_id % 5 <> 0")

_COMMAND_TYPE = """
CASE hbdm WHEN 'purchase' THEN 'AIRPORT_RETRY' WHEN 'error' THEN 'DRONE_RETRY'
          WHEN 'signup' THEN 'SIGNUP' ELSE 'AIRPORT' END
"""

_JSON = "'{\"hbdm\":\"' || hbdm || '\",\"num\":' || num || ',\"timestamp\":' || ts || '}'"

_RETRACT = """
numbered AS (
  SELECT hbdm, event_id, row_number() OVER (PARTITION BY hbdm ORDER BY event_id) AS n FROM rate
), changes AS (
  SELECT true AS acc, hbdm, n AS cnt_num, event_id FROM numbered
  UNION ALL
  SELECT false, hbdm, n - 1, event_id FROM numbered WHERE n > 1
)
"""


def _with(*parts: str) -> str:
    return _RATE.rstrip() + "".join(f", {p.strip()}" for p in parts) + "\n"


_SESSIONS = """
flagged AS (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY hbdm ORDER BY us, event_id) <= 1800000000
                 THEN 0 ELSE 1 END AS opens
  FROM rate
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY hbdm ORDER BY us, event_id) AS n FROM flagged
), sessions AS (
  SELECT hbdm, min(et) AS s_start, max(et) + INTERVAL 30 MINUTE AS s_end,
         max(us) + 1800000000 AS end_us, count(num) AS cnt_num
  FROM numbered GROUP BY hbdm, n
)
"""


def _hops(size_hours: int) -> str:
    starts = ", ".join(
        f"time_bucket(INTERVAL '1 hour', et) - INTERVAL '{i} hour'" for i in range(size_hours)
    )
    return f"hopped AS (SELECT hbdm, num, unnest([{starts}]) AS w_start FROM rate)"


_SESSION_AGG = (
    _with(_SESSIONS) + "SELECT hbdm, s_start AS w_start, s_end AS w_end, cnt_num FROM sessions"
)

_OVER_ROWS = """
SELECT event_id, hbdm, num,
       CAST(sum(num) OVER (PARTITION BY hbdm ORDER BY et, event_id
            ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS BIGINT) AS sum_num
FROM rate
"""

_OVER_UNBOUNDED = """
SELECT event_id, hbdm, num,
       CAST(sum(num) OVER (PARTITION BY hbdm ORDER BY et
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS sum_num
FROM rate
"""

_OVER_TIME = """
SELECT event_id, hbdm, num,
       CAST(sum(num) OVER (PARTITION BY hbdm ORDER BY et
            RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS BIGINT) AS sum_num
FROM rate
"""


def _closed(over: str) -> str:
    """Only the rows that a stream has released at its end."""
    return (
        _with(f"framed AS ({over})")
        + "SELECT f.* FROM framed f JOIN rate USING (event_id), closing WHERE us <= closed_us"
    )


def _stream_runs(key: str) -> str:
    """Runs of five and six purchases that a stream has completed at its end, with their events."""

    def of(length: int) -> str:
        ids = ", ".join(f"lead(event_id, {i}) OVER w" for i in range(1, length))
        return (
            f"SELECT {key + ', ' if key else ''}et, event_id, {length} AS length, lead(et, {length - 1}) OVER w AS end_et, "
            f"lead(us, {length - 1}) OVER w AS end_us, concat_ws(',', event_id, {ids}) AS matched_ids "
            f"FROM rate WHERE hbdm = 'purchase' WINDOW w AS ({f'PARTITION BY {key} ' if key else ''}ORDER BY et, event_id)"
        )

    return (
        _with()
        + f"SELECT * EXCLUDE (end_us, closed_us) FROM ({of(5)} UNION ALL {of(6)}), "
        + "(SELECT (max(us) // 1000 - 1000) * 1000 AS closed_us FROM rate WHERE hbdm = 'purchase') WHERE end_us <= closed_us"
    )


def _first(partition: str, columns: str, source: str = "rate") -> str:
    return f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY event_id) AS rn FROM {source}
) WHERE rn = 1
"""


def _session_first(key: str, gap_us: int, columns: str) -> str:
    return f"""
SELECT {columns} FROM (
  SELECT *, lag(us) OVER (PARTITION BY {key} ORDER BY us, event_id) AS before_us FROM rate
) WHERE before_us IS NULL OR us - before_us > {gap_us}
"""


_HASH = """
list_reduce(list_prepend(0::BIGINT, list_transform(string_split({key}, ''),
            lambda ch: ascii(ch)::BIGINT)), lambda a, b: (a * 32 + b) & 1073741823)
"""

_BITMAP = f"""
placed AS (
  SELECT *, (ts // 3600000 + 1) * 3600000 AS window_end,
         {_HASH.format(key="((ts // 1000)::VARCHAR || hbdm)")} AS "offset"
  FROM rate
)
"""

_WORDS = r"""
WITH lines AS (
  SELECT doc_id, string_split(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '\n$', ''), chr(10)) AS l
  FROM documents WHERE text <> ''
), words AS (
  SELECT doc_id, unnest(flatten(list_transform(l, lambda x: CASE WHEN x = '' THEN ['']
         WHEN rtrim(x, ' ') = '' THEN [] ELSE string_split(rtrim(x, ' '), ' ') END))) AS word
  FROM lines
)
"""

_JOIN = """
SELECT o.ts, o.hbdm AS catlog, o.num % 10 AS subcat, o.user_id::VARCHAR AS hbdm,
       o.num AS "value", r.ts AS rate_ts, r.user_id::VARCHAR AS rate_hbdm, r.num AS num,
       o.num::BIGINT * r.num::BIGINT AS amount
FROM rate o JOIN rate r
  ON o.user_id = r.user_id
 AND time_bucket(INTERVAL '1 hour', o.et) = time_bucket(INTERVAL '1 hour', r.et)
WHERE o.hbdm = 'purchase' AND r.hbdm = 'error'
"""


def _runs(partition: str, within_us: int | None = None) -> str:
    w = f"OVER ({partition} ORDER BY et, event_id)"
    bound = "" if within_us is None else f" AND last_us - us < {within_us}"
    branches = " UNION ALL ".join(
        f"SELECT event_id, et, us, hbdm, num, {n} AS length, lead(event_id, {n - 1}) {w} AS last_event_id,"
        f" lead(us, {n - 1}) {w} AS last_us FROM rate WHERE hbdm = 'purchase'"
        for n in (5, 6)
    )
    return f"""
SELECT event_id, et, length, last_event_id, length AS matched_count,
       '{{"hbdm":"' || hbdm || '","num":' || num || '}}' AS json
FROM ({branches}) WHERE last_event_id IS NOT NULL{bound}
"""


_SUCCESSION = """
next_events AS (
  SELECT *, lead(et) OVER w AS next_et, lead(us) OVER w AS next_us, lead(hbdm) OVER w AS next_hbdm
  FROM rate WINDOW w AS (PARTITION BY user_id ORDER BY et, event_id)
)
"""


def _alerts(key: str, hours: int) -> str:
    return f"""
SELECT event_id, {key}, et, cnt, first_task, {key}::VARCHAR || ',' || first_task::VARCHAR AS alert
FROM (
  SELECT *, count(*) OVER w AS cnt, first_value(event_id) OVER w AS first_task
  FROM rate
  WINDOW w AS (PARTITION BY {key} ORDER BY et
               RANGE BETWEEN INTERVAL {hours} HOURS PRECEDING AND CURRENT ROW)
) WHERE cnt >= 5
"""


_SEEN = """
seen AS (SELECT DISTINCT user_id, num FROM rate WHERE et < TIMESTAMP '2024-01-16'),
candidates AS (SELECT * FROM rate WHERE et >= TIMESTAMP '2024-01-16')
"""

_BITS_A_KEY, _K = word_filter_shape(64, 0.01)


def _md5_hash(seed: int) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', user_id::VARCHAR, num::VARCHAR)), 1, 15))::BIGINT"


_BLOOM = f"""
, shape AS (
  SELECT greatest(1, (greatest(1, count(*)) * {_BITS_A_KEY} + 63) // 64) AS words FROM rate WHERE et < TIMESTAMP '2024-01-16'
), placed AS (
  SELECT event_id, user_id, num, et, {_md5_hash(1)} % words AS word,
         list_transform(range({_K}), lambda i: ({_md5_hash(2)} >> (6 * i)) & 63) AS positions
  FROM rate, shape
), filter AS (
  SELECT DISTINCT word, unnest(positions) AS position FROM placed WHERE et < TIMESTAMP '2024-01-16'
), asked AS (
  SELECT event_id, user_id, num, word, unnest(positions) AS position FROM placed WHERE et >= TIMESTAMP '2024-01-16'
)
SELECT event_id, any_value(user_id) AS user_id, any_value(num) AS num
FROM asked LEFT JOIN (SELECT *, true AS set FROM filter) USING (word, position)
GROUP BY event_id HAVING count(*) FILTER (WHERE set IS NULL) > 0
"""

ORACLE: dict[str, str] = {
    "bloom_antifilter": _with(_SEEN) + _BLOOM,
    "decode_json_rate": _with() + _DECODE_JSON,
    "decode_csv_rate": _with() + _DECODE_CSV,
    "decode_csv_order": """
SELECT o_orderkey,
       CASE WHEN ok THEN epoch_us(o_orderdate) // 1000 END AS ts,
       CASE WHEN ok THEN o_orderstatus END AS catlog,
       CASE WHEN ok THEN CAST(o_custkey % 10 AS INTEGER) END AS subcat,
       CASE WHEN ok THEN substr(o_orderpriority, 1, 1) END AS hbdm,
       CASE WHEN ok THEN CAST(o_custkey AS INTEGER) END AS "value",
       ok AS is_valid
FROM (SELECT *, o_orderkey % 10 <> 0 AS ok FROM orders)
""",
    "decode_command_log": _with()
    + f"""
SELECT event_id, {_COMMAND_TYPE} AS type, user_id::VARCHAR AS serialnumber,
       event_id::VARCHAR AS task_id, strftime(et, '%Y-%m-%d') AS dt,
       {_MS_TIME} AS et, hbdm <> 'signup' AS is_valid
FROM rate
""",
    "parse_event_time": _with()
    + f"SELECT event_id, {_TIME_TEXT} AS ts_text, {_MS_TIME} AS et FROM rate",
    "table_source_strict": _with() + 'SELECT ts AS "timestamp", hbdm, num FROM rate',
    "encode_row": _with()
    + """
SELECT event_id, line AS row_text, '(' || line || ')' AS tuple_text
FROM (SELECT event_id, ts || ',' || hbdm || ',' ||
             CASE WHEN num > 0 THEN num::VARCHAR ELSE 'null' END AS line FROM rate)
""",
    "encode_changelog": _with(_RETRACT)
    + """
SELECT event_id, acc::VARCHAR || ',' || hbdm || ',' || cnt_num AS with_comma,
       acc::VARCHAR || hbdm || ',' || cnt_num AS joined
FROM changes
""",
    "encode_json": _with() + f"SELECT event_id, {_JSON} AS json FROM rate",
    "project_rename": _with() + "SELECT ts, hbdm, num, event_id AS pt FROM rate",
    "filter_eq": _with() + "SELECT event_id, ts, hbdm, num FROM rate WHERE hbdm = 'purchase'",
    "route_two_way": _with()
    + """
SELECT event_id, hbdm, num, CASE WHEN hbdm = 'purchase' THEN 'side' ELSE 'main' END AS route
FROM rate
""",
    "route_three_way": _with()
    + f"""
SELECT event_id, type, CASE type WHEN 'AIRPORT_RETRY' THEN 'airport_retry'
       WHEN 'DRONE_RETRY' THEN 'drone_retry' ELSE 'main' END AS route
FROM (SELECT event_id, {_COMMAND_TYPE} AS type FROM rate) WHERE type <> 'SIGNUP'
""",
    "split_words": _WORDS + "SELECT doc_id, word FROM words",
    "split_words_distinct": _WORDS + "SELECT DISTINCT word FROM words",
    "time_bucket": _with()
    + """
SELECT event_id, ts // 1000 AS "second", ts // 10000 AS ten_seconds,
       (ts // 10000)::VARCHAR || hbdm AS bucket_key, (ts // 3600000 + 1) * 3600000 AS hour_end,
       strftime(make_timestamp((ts // 30000 + 1) * 30000000), '%Y-%m-%d %H:%M:%S.0') AS window_end_text
FROM rate
""",
    "hash_offset": _with()
    + f"""
SELECT event_id, key, {_HASH.format(key="key")} AS "offset"
FROM (SELECT event_id, (ts // 1000)::VARCHAR || hbdm AS key FROM rate)
""",
    "group_count": _with() + "SELECT hbdm, count(num) AS cnt_num FROM rate GROUP BY hbdm",
    "group_sum_sql": _with()
    + "SELECT hbdm, CAST(sum(num) AS BIGINT) AS sum_num FROM rate GROUP BY hbdm",
    "retract_count": _with(_RETRACT) + "SELECT acc, hbdm, cnt_num, event_id FROM changes",
    "net_changelog": _with()
    + """
SELECT acc, hbdm, batch, CASE WHEN acc THEN total ELSE total - own END AS cnt_num FROM (
  SELECT hbdm, batch, own, CAST(sum(own) OVER (PARTITION BY hbdm ORDER BY batch) AS BIGINT) AS total
  FROM (SELECT hbdm, event_id // 1000 AS batch, count(num) AS own FROM rate GROUP BY ALL)
), (SELECT unnest([true, false]) AS acc) WHERE acc OR total > own
""",
    "upsert_latest": _with()
    + """
SELECT user_id, event_id, ts, hbdm, num FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM rate
) WHERE rn = 1
""",
    "tumble_agg": _with()
    + """
SELECT hbdm, time_bucket(INTERVAL '1 hour', et) AS w_start,
       time_bucket(INTERVAL '1 hour', et) + INTERVAL '1 hour' AS w_end,
       CAST(sum(num) AS BIGINT) AS sum_num, min(ts) AS min_ts, max(ts) AS max_ts
FROM rate GROUP BY ALL
""",
    "hop_agg": _with(_hops(5))
    + """
SELECT hbdm, w_start, w_start + INTERVAL '5 hour' AS w_end, count(*) AS cnt_all,
       CAST(sum(num) AS BIGINT) AS sum_num
FROM hopped GROUP BY hbdm, w_start
""",
    "session_agg": _SESSION_AGG,
    "sql_tumble": _with()
    + """
SELECT hbdm, time_bucket(INTERVAL '1 hour', et) AS r_start,
       time_bucket(INTERVAL '1 hour', et) + INTERVAL '1 hour' AS r_end,
       time_bucket(INTERVAL '1 hour', et) + INTERVAL '1 hour' - INTERVAL '1 millisecond' AS r_time,
       count(num) AS cnt_num, count(*) AS cnt_all
FROM rate GROUP BY ALL
""",
    "sql_hop": _with(_hops(2))
    + """
SELECT hbdm, w_start AS r_start, w_start + INTERVAL '2 hour' AS r_end, count(num) AS cnt_num
FROM hopped GROUP BY hbdm, w_start
""",
    "sql_session": _with(_SESSIONS) + "SELECT hbdm, s_start, s_end, cnt_num FROM sessions",
    "over_rows": _with() + _OVER_ROWS,
    "over_range_unbounded": _with() + _OVER_UNBOUNDED,
    "over_range_time": _with() + _OVER_TIME,
    "dedup_bucket": _with() + _first("hbdm, ts // 600000", "event_id, ts, hbdm, num"),
    "dedup_second": _with() + _first("hbdm, ts // 1000", "event_id, ts, hbdm, num"),
    "dedup_hour": _with()
    + _first("user_id, ts // 3600000", "event_id, user_id, ts, (ts // 3600000 + 1) * 3600000 AS hour_end"),
    "dedup_window": _with()
    + _first(
        "user_id, hbdm, ts // 21600000",
        "event_id, ts, user_id AS source_id, hbdm AS code, "
        "(ts // 21600000 + 1) * 21600000 AS window_end",
    ),
    "dedup_bitmap": _with(_BITMAP)
    + _first('window_end, "offset"', 'event_id, ts, hbdm, window_end, "offset"', "placed"),
    "bloom_error_bound": _with(_SEEN)
    + """
SELECT count(*) AS candidates, count(*) FILTER (WHERE s.user_id IS NOT NULL) AS known,
       CAST(0 AS BIGINT) AS missed, true AS within_bound
FROM candidates c LEFT JOIN seen s ON c.user_id = s.user_id AND c.num = s.num
""",
    "dedup_session_first": _with()
    + _session_first("user_id", 21600000000, "event_id, user_id, et"),
    "dedup_session_first_split": _with()
    + _session_first("hbdm", 1800000000, "event_id, hbdm, et"),
    "session_arrival": _with()
    + """
SELECT hbdm, min(event_id) AS first_id, max(event_id) AS last_id, count(num) AS cnt_num, max(event_id) + 3 AS closes FROM (
  SELECT *, sum(opens) OVER (ORDER BY event_id) AS n FROM (
    SELECT *, CASE WHEN event_id - lag(event_id) OVER (ORDER BY event_id) <= 3 THEN 0 ELSE 1 END AS opens
    FROM rate WHERE hbdm = 'purchase'
  )
) GROUP BY hbdm, n
""",
    "promote_event_time": _with()
    + """
SELECT hbdm, time_bucket(INTERVAL '2 hours', make_timestamp(ts * 1000)) AS w_start,
       time_bucket(INTERVAL '2 hours', make_timestamp(ts * 1000)) + INTERVAL '2 hours' AS w_end,
       CAST(sum(num) AS BIGINT) AS sum_num, min(ts) AS min_ts, max(ts) AS max_ts
FROM rate GROUP BY ALL
""",
    "window_join": _with() + _JOIN,
    "cep_times": _with() + _runs(""),
    "cep_times_user": _with() + _runs("PARTITION BY user_id"),
    "cep_times_within": _with() + _runs("", 7200000000),
    "cep_times_timeout": _with()
    + """
SELECT event_id, et, CAST(n AS INTEGER) AS matched_count FROM (
  SELECT *, least(6, count(*) OVER (ORDER BY us RANGE BETWEEN CURRENT ROW AND 7199999999 FOLLOWING)) AS n
  FROM rate WHERE hbdm = 'purchase'
) WHERE n < 6
""",
    "cep_next_within": _with(_SUCCESSION)
    + """
SELECT event_id, user_id, et, hbdm, next_et FROM next_events
WHERE hbdm = 'purchase' AND next_hbdm = 'purchase' AND next_us - us < 21600000000
""",
    "cep_next_within_split": _with(_SUCCESSION.replace("PARTITION BY user_id ", ""))
    + """
SELECT event_id, et, hbdm, next_et FROM next_events
WHERE hbdm = 'purchase' AND next_hbdm = 'purchase' AND next_us - us < 300000000
""",
    "cep_timeout": _with(_SUCCESSION)
    + """
SELECT event_id, user_id, et, hbdm, next_et FROM next_events
WHERE hbdm = 'purchase' AND (next_us IS NULL OR next_us - us >= 21600000000)
""",
    "retry_alert": _with() + _alerts("user_id", 6),
    "retry_alert_split": _with() + _alerts("hbdm", 1),
    "stream_tumble": _with()
    + """
SELECT hbdm, w_start, w_start + INTERVAL '1 hour' AS w_end, CAST(sum(num) AS BIGINT) AS sum_num,
       min(ts) AS min_ts, max(ts) AS max_ts
FROM (SELECT *, time_bucket(INTERVAL '1 hour', et) AS w_start FROM rate), closing
WHERE epoch_us(w_start) + 3600000000 <= closed_us GROUP BY hbdm, w_start
""",
    "stream_hop": _with(_hops(2))
    + """
SELECT hbdm, w_start AS r_start, w_start + INTERVAL '2 hour' AS r_end, count(num) AS cnt_num
FROM hopped, closing WHERE epoch_us(w_start) + 7200000000 <= closed_us GROUP BY hbdm, w_start
""",
    "stream_session": _with(_SESSIONS)
    + "SELECT hbdm, s_start, s_end, cnt_num FROM sessions, closing WHERE end_us <= closed_us",
    "stream_dedup_bucket": _with() + "SELECT DISTINCT hbdm, ts // 600000 AS bucket FROM rate",
    "stream_dedup_bucket_first": _with()
    + _first("hbdm, ts // 600000", "event_id, ts, hbdm, num", "rate").replace(
        "WHERE rn = 1", ", closing WHERE rn = 1 AND (us // 1800000000 + 1) * 1800000000 <= closed_us"
    ),
    "stream_dedup_hour": _with()
    + "SELECT DISTINCT user_id, time_bucket(INTERVAL '1 hour', et) + INTERVAL '1 hour' AS hour_end FROM rate",
    "stream_dedup_bitmap": _with(_BITMAP)
    + 'SELECT DISTINCT make_timestamp(window_end * 1000) AS window_end, "offset" FROM placed',
    "stream_dedup_session_first": _with() + _session_first("user_id", 21600000000, "user_id, et, event_id"),
    "stream_over_rows": _closed(_OVER_ROWS),
    "stream_over_range_time": _closed(_OVER_TIME),
    "stream_over_range_unbounded": _closed(_OVER_UNBOUNDED),
    "stream_cep_times": _stream_runs("user_id"),
    "stream_cep_times_any": _stream_runs(""),
    "stream_cep_succession": _with(_SUCCESSION)
    + """
SELECT user_id, et, event_id, 'match' AS kind, next_et FROM next_events, closing
WHERE hbdm = 'purchase' AND next_hbdm = 'purchase' AND next_us - us < 21600000000
  AND next_us <= closed_us
UNION ALL
SELECT user_id, et, event_id, 'timeout', CAST(NULL AS TIMESTAMP) FROM next_events, closing
WHERE hbdm = 'purchase' AND (next_us IS NULL OR next_us - us >= 21600000000)
  AND us // 1000 * 1000 + 21600000000 <= closed_us
""",
    "stream_retry_alert": _with(f"alerts AS ({_alerts('user_id', 6)})")
    + "SELECT a.* FROM alerts a JOIN rate USING (event_id), closing WHERE us <= closed_us",
}

ORACLE["sql_filter"] = ORACLE["filter_eq"]
ORACLE["stream_upsert_latest"] = ORACLE["upsert_latest"]
ORACLE["stream_group_count"] = ORACLE["group_count"]
ORACLE["stream_retract_count"] = ORACLE["retract_count"]
ORACLE["window_join_salted"] = ORACLE["stream_window_join"] = ORACLE["window_join"]
for _name in (
    "retract_count",
    "session_agg",
    "over_rows",
    "over_range_unbounded",
    "over_range_time",
    "cep_times",
):
    ORACLE[f"{_name}_split"] = ORACLE[_name]
