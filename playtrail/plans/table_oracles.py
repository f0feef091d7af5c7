"""The registered queries in plain SQL over the same tables, for DuckDB to check them against."""

from playtrail.plans.table_queries import MONTH, TOP_N

BROWSE = """
browse AS (
  SELECT event_id,
         CAST(n >> 24 AS VARCHAR) || '.' || CAST((n >> 16) & 255 AS VARCHAR) || '.' ||
         CAST((n >> 8) & 255 AS VARCHAR) || '.' || CAST(n & 255 AS VARCHAR) AS ip,
         strftime(ts, '%Y%m%d%H%M') AS date,
         'Android ' || CAST(user_id % 8 AS VARCHAR) AS "androidVersion",
         CASE WHEN event_type = 'error' THEN '_' ELSE event_type END AS "phoneModel",
         p_name AS "gameName", game AS "gameId", n AS ip_number,
         CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_time
  FROM (SELECT *, (167772160 + user_id * 8192 + 5) % 4294967296 AS n,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS game
        FROM events) e
  LEFT JOIN part ON p_partkey = game)"""

RANGES = """
ranges AS (
  SELECT 167772160 + n_nationkey * width AS ip_lo, 167772160 + (n_nationkey + 1) * width - 1 AS ip_hi,
         n_name AS city
  FROM nation, (SELECT greatest(1, count(DISTINCT user_id) // 30) * 8192 AS width FROM events))"""

LOCATED = """
located AS (
  SELECT b.*, city FROM browse b LEFT JOIN ranges ON ip_number BETWEEN ip_lo AND ip_hi)"""

DAILY = """
daily AS (
  SELECT event_id, ip, substr(date, 1, 8) AS date, "androidVersion", "phoneModel", "gameName", "gameId"
  FROM browse),
newest AS (
  SELECT * FROM daily
  QUALIFY row_number() OVER (PARTITION BY date, ip, "gameId" ORDER BY event_id DESC) = 1)"""

DOWNLOADS = """
d AS (
  SELECT strftime(ts, '%Y%m%d%H%M%S') AS time, date_trunc('second', ts) AS event_time, user_id
  FROM events WHERE event_type = 'click')"""

PAYMENTS = """
p AS (
  SELECT strftime(ts, '%Y%m%d%H%M%S') AS time, date_trunc('second', ts) AS event_time, user_id,
         CAST(event_id AS VARCHAR) AS order_id,
         CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS paid,
         CAST(floor(value) AS BIGINT) AS fee
  FROM events WHERE event_type IN ('purchase', 'error'))"""

BLOCKED = """
blocked AS (
  SELECT DISTINCT user_id FROM events
  WHERE user_id * 10 < (SELECT count(DISTINCT user_id) * 9 FROM events))"""

TIME_PARTS = "substr(time, 1, 8) AS day, substr(time, 9, 2) AS hour, substr(time, 11, 2) AS minute"

PAYMENT_SUMS = """count(*) AS orders, CAST(sum(paid) AS BIGINT) AS paid, CAST(sum(fee) AS BIGINT) AS fee_total,
       CAST(sum(fee * paid) AS BIGINT) AS fee_paid"""

NOT_BLOCKED = "NOT EXISTS (SELECT 1 FROM blocked b WHERE b.user_id = e.user_id)"

# Where a bucket starts in a compact time and how long it is.
BUCKETS = {
    "day": (1, 8),
    "hour": (1, 10),
    "minute": (1, 12),
    "hour_pooled": (9, 2),
    "minute_pooled": (11, 2),
}


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _by_month(limit: str) -> str:
    return _with(BROWSE) + f"""
        SELECT CAST({MONTH} AS INTEGER) AS month, min("gameName") AS "gameName", "gameId", count(*) AS times
        FROM browse WHERE CAST(substr(date, 5, 2) AS INTEGER) = {MONTH}
        GROUP BY "gameId" ORDER BY times DESC, "gameId" {limit}"""


def _by_city(cut: str) -> str:
    return _with(BROWSE, RANGES, LOCATED) + f"""
        SELECT * FROM (
          SELECT city, "gameId", "gameName", times,
                 CAST(row_number() OVER (PARTITION BY city ORDER BY times DESC, "gameId") AS INTEGER) AS rank
          FROM (SELECT city, "gameId", min("gameName") AS "gameName", count(*) AS times
                FROM located GROUP BY city, "gameId")) {cut}"""


BY_PHONE = _with(BROWSE) + 'SELECT "phoneModel", count(*) AS times FROM browse GROUP BY "phoneModel"'

BY_HOUR = _with(BROWSE) + "SELECT substr(date, 9, 2) AS hour, count(*) AS times FROM browse GROUP BY 1"

PARSED = _with(BROWSE) + """
    SELECT ip, date, "androidVersion", "phoneModel", "gameName", "gameId", event_time FROM browse"""

CLEAN = _with(BROWSE) + """
    SELECT ip, date, "androidVersion", "phoneModel", "gameName", "gameId", event_time,
           CAST(substr(date, 1, 4) AS INTEGER) AS year, CAST(substr(date, 5, 2) AS INTEGER) AS month
    FROM browse"""

IP_TO_CITY = _with(BROWSE, RANGES, LOCATED) + "SELECT event_id, ip, city FROM located"

NESTED = """
around AS (SELECT max(ip_hi - ip_lo + 1) AS width FROM ranges),
nested AS (
  SELECT * FROM ranges
  UNION ALL SELECT 167772160, 167772160 + 40 * width, 'elsewhere' FROM around
  UNION ALL SELECT 167772160 + r_regionkey * 5 * width, 167772160 + (r_regionkey * 5 + 20) * width, r_name FROM region, around
  UNION ALL
  SELECT lo, lo + 1 + (s_suppkey * 7919) % (2 * width), s_name
  FROM (SELECT *, 167772160 + (s_suppkey * 247711) % (30 * width) AS lo FROM supplier, around))"""

IP_TO_CITY_NESTED = _with(BROWSE, RANGES, NESTED) + """
    SELECT event_id, ip, city FROM browse LEFT JOIN nested ON ip_number BETWEEN ip_lo AND ip_hi
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ip_hi - ip_lo, ip_lo DESC, city NULLS LAST) = 1"""

# CRC-32 bit by bit: characters are folded into the register, eight shifts each.
CRC32 = """
xor(4294967295::BIGINT, list_reduce(
  list_prepend(4294967295::BIGINT,
               list_transform(string_split(ip || "gameId"::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""

ROW_KEY = f"date || '_' || ({CRC32})::VARCHAR"

CELL_COLUMNS = ["ip", "date", "androidVersion", "phoneModel", "gameName", "gameId"]

KEYED = f"keyed AS (SELECT *, {ROW_KEY} || '_' || ip || '_' || \"gameId\" AS row_key FROM newest)"

CELLS = _with(BROWSE, DAILY, KEYED) + " UNION ALL ".join(
    f"SELECT row_key, '{c}' AS qualifier, CAST(\"{c}\" AS VARCHAR) AS value FROM keyed" for c in CELL_COLUMNS
)

REJECTS = _with(BROWSE) + """
    SELECT CASE "phoneModel"
             WHEN 'view' THEN ip || chr(9) || time || chr(9) || device || chr(9) || "gameName" || chr(9) || game
             WHEN '_' THEN ip || chr(9) || '[' || time || ']' || chr(9) || '(' || "androidVersion" || ')' ||
                           chr(9) || "gameName" || chr(9) || game
             WHEN 'signup' THEN ip || chr(9) || '[' || time || ']' || chr(9) || device || chr(9) ||
                                "gameName" || chr(9) || 'x'
             WHEN 'purchase' THEN ip || chr(9) || '[' || time || ']' || chr(9) || device || chr(9) || "gameName"
           END AS line,
           CASE "phoneModel"
             WHEN 'view' THEN 'unreadable time' WHEN '_' THEN 'unreadable device'
             WHEN 'signup' THEN 'unreadable game id' WHEN 'purchase' THEN 'fewer than five fields'
           END AS reason
    FROM (SELECT *, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS time,
                 '(' || "androidVersion" || ',' || "phoneModel" || ')' AS device,
                 CAST("gameId" AS VARCHAR) AS game
          FROM browse)
    WHERE "phoneModel" <> 'click'"""

STAT_MONTH = f"""
    SELECT month, "gameName" AS game_name, "gameId" AS game_id, times FROM ({_by_month("")})"""

STAT_CITY = f"""
    SELECT city, "gameId" AS game_id, "gameName" AS game_name, times, rank AS ranks
    FROM ({_by_city("WHERE rank <= 3")})"""

STAT_PHONE = f'SELECT "phoneModel" AS phonemodel, times FROM ({BY_PHONE})'

BATCH = " UNION ALL ".join(
    f"SELECT '{name}' AS report, count(*) AS result_rows, CAST(sum(times) AS BIGINT) AS visits FROM ({sql})"
    for name, sql in (
        ("by_month", _by_month("")),
        ("by_city", _by_city("WHERE rank <= 3")),
        ("by_phone_model", BY_PHONE),
        ("by_hour", BY_HOUR),
    )
)


def _totals(ctes: list[str], source: str, sums: str, bucket: str, where: str = "TRUE") -> str:
    start, length = BUCKETS[bucket]
    return _with(*ctes) + f"""
        SELECT substr(time, {start}, {length}) AS bucket, {sums}
        FROM {source} e WHERE {where} GROUP BY 1"""


def _sliding(cte: str, source: str, sums: str) -> str:
    """Each event lies in two of the ten-second windows that start every five seconds."""
    return _with(cte) + f"""
        SELECT window_start, window_start + INTERVAL 10 SECOND AS window_end, {sums}
        FROM (SELECT *, unnest([slot, slot - INTERVAL 5 SECOND]) AS window_start
              FROM (SELECT *, time_bucket(INTERVAL 5 SECOND, event_time) AS slot FROM {source}))
        GROUP BY 1, 2"""


DOWNLOAD_COUNT = "count(*) AS downloads"

DOWNLOADS_NOT_BLOCKED = _with(DOWNLOADS, BLOCKED) + f"""
    SELECT time, {TIME_PARTS}, user_id FROM d e WHERE {NOT_BLOCKED}"""

PAYMENTS_NOT_BLOCKED = _with(PAYMENTS, BLOCKED) + f"""
    SELECT order_id, {TIME_PARTS}, user_id, paid, fee FROM p e WHERE {NOT_BLOCKED}"""

TOPIC_REJECTS = """
    SELECT CASE event_type
             WHEN 'error' THEN 'order ' || event_id
             WHEN 'signup' THEN '{"order_id":"' || event_id || '","fee":"' || fee || '","time":"' || time || '"}'
             WHEN 'view' THEN '{"order_id":"' || event_id || '","fee":"' || fee ||
                              '","time":"soon","user_id":' || user_id || '}'
             WHEN 'click' THEN '{"order_id":"' || event_id || '","fee":"free","time":"' || time ||
                               '","user_id":' || user_id || '}'
           END AS value,
           CASE event_type WHEN 'signup' THEN 'unreadable user' WHEN 'click' THEN 'unreadable fee'
                           ELSE 'unreadable time' END AS reason
    FROM (SELECT *, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS fee, strftime(ts, '%Y%m%d%H%M%S') AS time
          FROM events)
    WHERE event_type <> 'purchase'"""


# Name, number of events and SQL of each output.
LIVE_TABLES = (
    ("downloads", "sum(downloads)", _totals([DOWNLOADS], "d", DOWNLOAD_COUNT, "day")),
    ("payments", "sum(orders)", _totals([PAYMENTS], "p", PAYMENT_SUMS, "day")),
    (
        "downloads_not_blocked_totals", "sum(downloads)",
        _totals([DOWNLOADS, BLOCKED], "d", DOWNLOAD_COUNT, "day", NOT_BLOCKED),
    ),
    (
        "payments_not_blocked_totals", "sum(orders)",
        _totals([PAYMENTS, BLOCKED], "p", PAYMENT_SUMS, "day", NOT_BLOCKED),
    ),
    ("downloads_sliding", "sum(downloads)", _sliding(DOWNLOADS, "d", DOWNLOAD_COUNT)),
    ("payments_sliding", "sum(orders)", _sliding(PAYMENTS, "p", PAYMENT_SUMS)),
    ("downloads_rejected", "count(*)", "SELECT 1 FROM events WHERE FALSE"),
    ("payments_rejected", "count(*)", "SELECT 1 FROM events WHERE FALSE"),
    ("downloads_not_blocked", "count(*)", DOWNLOADS_NOT_BLOCKED),
    ("payments_not_blocked", "count(*)", PAYMENTS_NOT_BLOCKED),
)

LIVE = " UNION ALL ".join(
    f"SELECT '{name}' AS output, count(*) AS result_rows, CAST({events} AS BIGINT) AS events FROM ({sql})"
    for name, events, sql in LIVE_TABLES
)


def _as_values(name: str, columns: str, sql: str) -> str:
    """Every column's value by its name, times to the second."""
    times = ("event_time", "window_start", "window_end")
    values = [
        f"'{c}=' || coalesce(" + (f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c in times else f"CAST({c} AS VARCHAR)") + ", 'null')"
        for c in sorted(columns.split())
    ]
    return f"SELECT '{name}' AS output, {" || ';' || ".join(values)} AS row FROM ({sql})"


_EVENT = "time day hour minute event_time user_id game_id"
# The row tables also have the game.
_GAME = " user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS game_id"
LIVE_ROWS = " UNION ALL ".join(
    [
        _as_values(name, f"bucket {sums}", sql) if "sliding" not in name else _as_values(name, f"window_start window_end {sums}", sql)
        for name, events, sql in LIVE_TABLES[:6]
        for sums in ["downloads" if "downloads" in events else "orders paid fee_total fee_paid"]
    ]
    + [
        _as_values("downloads_not_blocked", _EVENT, _with(DOWNLOADS.replace(" user_id", _GAME), BLOCKED) + f"SELECT e.*, {TIME_PARTS} FROM d e WHERE {NOT_BLOCKED}"),
        _as_values("payments_not_blocked", f"{_EVENT} order_id paid fee", _with(PAYMENTS.replace(" user_id", _GAME), BLOCKED) + f"SELECT e.*, {TIME_PARTS} FROM p e WHERE {NOT_BLOCKED}"),
    ]
)

EVERY_GRAIN = {
    "downloads": " UNION ALL ".join(f"SELECT '{name}' AS grain, * FROM ({_totals([DOWNLOADS], 'd', DOWNLOAD_COUNT, name)})" for name in BUCKETS),
    "payments": " UNION ALL ".join(f"SELECT '{name}' AS grain, * FROM ({_totals([PAYMENTS], 'p', PAYMENT_SUMS, name)})" for name in BUCKETS),
}


BATCH_ROWS = " UNION ALL ".join(
    _as_values(name, columns, sql)
    for name, columns, sql in (
        ("by_month", "month game_name game_id times", STAT_MONTH),
        ("by_city", "city game_id game_name times ranks", STAT_CITY),
        ("by_phone_model", "phonemodel times", STAT_PHONE),
        ("by_hour", "hour times", BY_HOUR),
    )
)


def table_oracles() -> dict[str, str]:
    found = {
        "top_games_by_month": _by_month(f"LIMIT {TOP_N}"),
        "games_by_month_all": _by_month(""),
        "report_month_sql": _by_month(f"LIMIT {TOP_N}"),
        "top_games_by_city": _by_city("WHERE rank <= 3"),
        "games_by_city_ranked": _by_city(""),
        "report_city_sql": _by_city("WHERE rank <= 3"),
        "top_games_by_city_shuffled": _by_city("WHERE rank <= 3"),
        "phone_model_times": BY_PHONE,
        "report_phone_sql": BY_PHONE,
        "visits_by_hour": BY_HOUR,
        "report_hour_sql": BY_HOUR,
        "browse_log_parse": PARSED,
        "browse_log_rejects": REJECTS,
        "clean_roundtrip": CLEAN,
        "ip_to_city": IP_TO_CITY,
        "ip_to_city_shuffled": IP_TO_CITY,
        "ip_to_city_nested": IP_TO_CITY_NESTED,
        "row_key": _with(BROWSE) + f"SELECT event_id, {ROW_KEY} AS row_key FROM browse",
        "keyed_upsert": _with(BROWSE, DAILY) + "SELECT * FROM newest",
        "keyed_scan": _with(BROWSE, DAILY) + f"""
            SELECT CAST({MONTH} AS INTEGER) AS month, min("gameName") AS "gameName", "gameId", count(*) AS times
            FROM newest WHERE CAST(substr(date, 5, 2) AS INTEGER) = {MONTH} GROUP BY "gameId" """,
        "keyed_range": _with(BROWSE, DAILY) + """
            SELECT daily.* FROM daily, (SELECT CAST(min(date) AS BIGINT) AS first FROM daily)
            WHERE CAST(date AS BIGINT) BETWEEN first + 1 AND first + 7""",
        "cells_unpivot": CELLS,
        "cells_pivot": _with(BROWSE, DAILY, KEYED) + """
            SELECT row_key, ip, date, "androidVersion", "phoneModel", "gameName", "gameId" FROM keyed""",
        "stat_sink_month": STAT_MONTH,
        "stat_sink_city": STAT_CITY,
        "stat_sink_phone": STAT_PHONE,
        "stat_sink_hour": BY_HOUR,
        "stat_sink_empty_month": f"SELECT * FROM ({STAT_MONTH}) WHERE FALSE",
        "growing_log": CLEAN,
        "games_by_city_counts": _by_city(""),
        "games_by_month_counts": _by_month(""),
        "phone_models_counts": BY_PHONE,
        "visits_by_hour_counts": BY_HOUR,
        "games_of_newest_day": _with(BROWSE) + """
            SELECT min("gameName") AS "gameName", "gameId", count(*) AS times, substr(date, 1, 8) AS day
            FROM browse WHERE substr(date, 1, 8) = (SELECT max(substr(date, 1, 8)) FROM browse) GROUP BY "gameId", 4""",
        "batch_reports": BATCH,
        "batch_report_rows": BATCH_ROWS,
        "downloads_by_hour_daily": _totals([DOWNLOADS], "d", DOWNLOAD_COUNT, "hour"),
        "payments_by_minute_daily": _totals([PAYMENTS], "p", PAYMENT_SUMS, "minute"),
        "downloads_sliding": _sliding(DOWNLOADS, "d", DOWNLOAD_COUNT),
        "payments_sliding": _sliding(PAYMENTS, "p", PAYMENT_SUMS),
        "downloads_not_blocked": DOWNLOADS_NOT_BLOCKED,
        "downloads_not_listed": DOWNLOADS_NOT_BLOCKED,
        "payments_not_blocked": PAYMENTS_NOT_BLOCKED,
        "downloads_by_day_not_blocked": _totals([DOWNLOADS, BLOCKED], "d", DOWNLOAD_COUNT, "day", NOT_BLOCKED),
        "payments_by_day_not_blocked": _totals([PAYMENTS, BLOCKED], "p", PAYMENT_SUMS, "day", NOT_BLOCKED),
        "topic_rejects": TOPIC_REJECTS,
        "live_run": LIVE,
        "live_run_rows": LIVE_ROWS,
        "downloads_every_grain": EVERY_GRAIN["downloads"],
        "payments_every_grain": EVERY_GRAIN["payments"],
    }
    for name in BUCKETS:
        found[f"downloads_by_{name}"] = _totals([DOWNLOADS], "d", DOWNLOAD_COUNT, name)
        found[f"payments_by_{name}"] = _totals([PAYMENTS], "p", PAYMENT_SUMS, name)
    return found
