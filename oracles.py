"""SQL twins of the registered queries, for the side-by-side check in DuckDB."""

from __future__ import annotations

from tidelog.sources.rebuilt import BROWSERS, METHODS, PATHS, ROW_TYPES, SCHEMA_EVERY, STATUS_CODES
from tidelog.sources.synthetic import LOG_DIGITS


def values(fixed: tuple[str, ...]) -> str:
    """A fixed set as an SQL list."""
    return "[" + ", ".join(f"'{v}'" for v in fixed) + "]"


LOGS = f"""
logs AS (
  SELECT '198.51.100.' || user_id AS client_ip, '-' AS client_identity, '-' AS userid,
    CASE WHEN event_id % 97 = 0 THEN '///' ELSE
      {values(BROWSERS)}[event_id % 4 + 1]
      || '/' || (1 + event_id % 9) || '.0' END AS user_agent,
    date_trunc('millisecond', ts) AS log_time,
    {values(METHODS)}[event_id % 4 + 1] || ' '
      || {values(PATHS)}[event_id % 5 + 1]
      || ' HTTP/1.1' AS request_line,
    CASE WHEN event_id % 101 = 0 THEN '1404' WHEN event_id % 103 = 0 THEN NULL ELSE
      {values(STATUS_CODES)}[event_id % 7 + 1] END AS status_code,
    CAST(100 + (event_id * 7919) % 9999900 AS INTEGER) AS size
  FROM events),
browsers AS (
  SELECT nullif(regexp_extract(user_agent, '[^/]+', 0), '') AS browser, status_code, log_time
  FROM logs)
"""

CHANGES = """
numbered AS (
  SELECT event_id, ts, user_id, CAST(user_id % 2147483648 AS INTEGER) AS id,
    CAST(event_id % 2147483648 AS INTEGER) AS num,
    lag(CAST(event_id % 2147483648 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY event_id) AS old_num,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
  FROM events),
msgs AS (
  SELECT event_id AS "offset", id, num, old_num,
    CASE WHEN rn % 5 = 0 THEN 'd' WHEN rn = 1 AND user_id % 10 = 0 THEN 'r'
      WHEN rn % 5 = 1 THEN 'c' ELSE 'u' END AS op,
    date_trunc('millisecond', ts) AS cut_ts
  FROM numbered),
log AS (
  SELECT *, CASE WHEN op = 'd' THEN old_num ELSE num END AS log_num
  FROM msgs WHERE op <> 'r'),
full_log AS (
  SELECT 2 * "offset" + 1 AS seq, CASE op WHEN 'u' THEN '+U' ELSE '+I' END AS kind,
    id, num, cut_ts - INTERVAL 5 MILLISECOND AS operation_ts FROM msgs WHERE op <> 'd'
  UNION ALL
  SELECT 2 * "offset", CASE op WHEN 'u' THEN '-U' ELSE '-D' END,
    id, old_num, cut_ts - INTERVAL 5 MILLISECOND FROM msgs WHERE op IN ('u', 'd'))
"""

RETRACT = """
revenue AS (
  SELECT o_orderkey AS order_id, o_orderpriority AS name,
    CAST(round(o_totalprice * 100) AS BIGINT) AS revenue FROM orders),
sums AS (
  SELECT order_id, name, row_number() OVER w AS n,
    CAST(sum(revenue) OVER w AS BIGINT) AS total,
    CAST(sum(revenue) OVER w - revenue AS BIGINT) AS old_total
  FROM revenue WINDOW w AS (PARTITION BY name ORDER BY order_id))
SELECT order_id, '+I' AS kind, true AS added, name, total AS rev_sum FROM sums WHERE n = 1
UNION ALL
SELECT order_id, '-U', false, name, old_total FROM sums WHERE n > 1 AND total <> old_total
UNION ALL
SELECT order_id, '+U', true, name, total FROM sums WHERE n > 1 AND total <> old_total
"""


# The log with event ids 600 ms apart.
DENSE_LOGS = (
    "dense AS (SELECT event_id, user_id, TIMESTAMP '2024-01-01 00:00:00' "
    "+ to_milliseconds(event_id * 600) AS ts FROM events),"
    + LOGS.replace("FROM events", "FROM dense")
)


def dense(query: str) -> str:
    """A query over the dense log."""
    return query.replace(LOGS, DENSE_LOGS)


def browser_counts(size: str, closed: str = "") -> str:
    return f"""WITH {LOGS}
SELECT time_bucket(INTERVAL '{size}', log_time) + INTERVAL '{size}'
    - INTERVAL 1 MILLISECOND AS window_time,
  browser, count(*) AS cnt_browser
FROM browsers GROUP BY 1, 2 {closed} ORDER BY 1, 3 DESC"""


def slowest_browser_counts(partitions: int, size: str, delay: str) -> str:
    """Windows that every partition has passed; partition ``p`` is ``p`` days behind."""
    behind = LOGS.replace("FROM events", "FROM behind").replace(
        "SELECT '198", f"SELECT event_id % {partitions} AS part, '198"
    )
    return f"""WITH behind AS (SELECT * REPLACE (ts - to_days(CAST(event_id % {partitions} AS INTEGER)) AS ts) FROM events),
{behind}, slowest AS (SELECT min(latest) AS latest FROM (SELECT max(log_time) AS latest FROM logs GROUP BY part) p)
SELECT browser, time_bucket(INTERVAL '{size}', log_time) AS window_start,
  time_bucket(INTERVAL '{size}', log_time) + INTERVAL '{size}' AS window_end,
  time_bucket(INTERVAL '{size}', log_time) + INTERVAL '{size}' - INTERVAL 1 MILLISECOND AS window_time,
  count(*) AS cnt_browser
FROM browsers GROUP BY 1, 2, 3, 4 HAVING time_bucket(INTERVAL '{size}', min(log_time)) + INTERVAL '{size}' <= (SELECT latest - INTERVAL '{delay}' FROM slowest)"""


def _gated(steps: int, size: str, delay: str) -> str:
    """The disordered log by step, and whether the steps before had passed a line's window."""
    lines = LOGS.replace("FROM events", "FROM disordered").replace("SELECT '198", "SELECT step, '198")
    return f"""disordered AS (SELECT * REPLACE (ts - CASE WHEN event_id % 7 = 0 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS ts),
  event_id * {steps} // ((SELECT max(event_id) FROM events) + 1) AS step FROM events),
{lines.replace("status_code, log_time", "status_code, log_time, step")},
passed AS (SELECT step, max(max(log_time)) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - INTERVAL '{delay}' AS mark FROM logs GROUP BY step),
gated AS (SELECT b.*, coalesce(time_bucket(INTERVAL '{size}', log_time) + INTERVAL '{size}' <= mark, false) AS late
  FROM browsers b JOIN passed p ON b.step = p.step)"""


def late_rows(steps: int, size: str, delay: str) -> str:
    return f"""WITH {_gated(steps, size, delay)}
SELECT step, status_code, late, count(*) AS n FROM gated GROUP BY ALL"""


def kept_counts(steps: int, size: str, delay: str) -> str:
    return f"""WITH {_gated(steps, size, delay)}
SELECT time_bucket(INTERVAL '{size}', log_time) + INTERVAL '{size}' - INTERVAL 1 MILLISECOND AS window_time,
  browser, count(*) AS cnt_browser
FROM gated WHERE NOT late GROUP BY 1, 2 HAVING window_time < (SELECT max(log_time) - INTERVAL '{delay}' FROM logs)"""


def _status_counted(size: str, closed: str) -> str:
    return f"""WITH {LOGS}, counted AS (
  SELECT browser, status_code,
    time_bucket(INTERVAL '{size}', log_time) + INTERVAL '{size}'
      - INTERVAL 1 MILLISECOND AS end_time,
    count(*) AS requests
  FROM browsers GROUP BY 1, 2, 3 {closed})"""


def status_counts(size: str, closed: str = "") -> str:
    return f"""{_status_counted(size, closed)}
SELECT browser, status_code, end_time, requests FROM counted"""


def warehouse(size: str, closed: str = "") -> str:
    return f"""{_status_counted(size, closed)}
SELECT browser, status_code, strftime(end_time, '%Y-%m-%d') AS dt,
  strftime(end_time, '%H') AS hour, strftime(end_time, '%M') AS minute, requests
FROM counted"""


def distinct_ips(size: str, legacy: bool = False, closed: str = "") -> str:
    clock = ", window_end AS window_interval" if legacy else ""
    return f"""WITH {LOGS}, bucketed AS (
  SELECT time_bucket(INTERVAL '{size}', log_time) AS window_start, client_ip, log_time
  FROM logs),
counted AS (
  SELECT window_start, window_start + INTERVAL '{size}' AS window_end,
    count(DISTINCT client_ip) AS ip_addresses FROM bucketed GROUP BY 1 {closed})
SELECT window_start, window_end, ip_addresses{clock} FROM counted"""


def metadata(column: str) -> str:
    return f"""WITH {CHANGES}
SELECT "offset", id, log_num AS num, {column} AS meta FROM log"""


def closed_windows(size: str, delay: str) -> str:
    """Windows a stream has closed once all rows are in: it ends by the watermark."""
    return (
        f"HAVING time_bucket(INTERVAL '{size}', min(log_time)) + INTERVAL '{size}' <= "
        f"(SELECT max(log_time) - INTERVAL '{delay}' FROM logs)"
    )


def log_bits(column: str, row_id: str) -> str:
    names = list(LOG_DIGITS)
    start = 1 + sum(LOG_DIGITS[n] for n in names[: names.index(column)])
    return f"CAST('0x' || substr(sha256('0:' || {row_id}), {start}, {LOG_DIGITS[column]}) AS BIGINT)"


def draw(column: str, row_id: str) -> str:
    return f"CAST('0x' || substr(md5('0:{column}:' || {row_id}), 1, 15) AS BIGINT)"


def words(value: str) -> str:
    return (
        f"CASE WHEN {value} = '' THEN [''] WHEN rtrim({value}, ' ') = '' THEN [] "
        f"ELSE string_split(rtrim({value}, ' '), ' ') END"
    )


def schema_history() -> str:
    """Changes by the row type in force: text of numbers keeps its zeros only where ``num`` is text."""
    kept = lambda c: f"CASE WHEN kind_no = 3 THEN lpad(CAST({c} AS VARCHAR), 12, '0') ELSE CAST({c} AS VARCHAR) END"
    return f"""WITH {CHANGES}, versioned AS (
  SELECT *, CAST(sum(CASE WHEN "offset" % {SCHEMA_EVERY} = 0 THEN 1 ELSE 0 END) OVER (ORDER BY "offset") AS BIGINT) AS schema_version,
    CASE WHEN any_value("offset") FILTER ("offset" % {SCHEMA_EVERY} = 0) OVER (ORDER BY "offset") IS NULL THEN 0
      ELSE "offset" // {SCHEMA_EVERY} % {len(ROW_TYPES)} END AS kind_no FROM msgs),
rows AS (SELECT *, CASE WHEN kind_no IN (1, 2) THEN 'n' || "offset" END AS note FROM versioned
  WHERE "offset" % {SCHEMA_EVERY} <> 0)
SELECT schema_version, 2 * "offset" + 1 AS seq, CASE op WHEN 'u' THEN '+U' ELSE '+I' END AS kind,
  id, {kept('num')} AS num, note FROM rows WHERE op <> 'd'
UNION ALL
SELECT schema_version, 2 * "offset", CASE op WHEN 'u' THEN '-U' ELSE '-D' END,
  id, {kept('old_num')}, note FROM rows WHERE op IN ('u', 'd')"""
