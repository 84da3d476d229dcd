"""The same answers in plain SQL over the given tables, for comparison."""

from __future__ import annotations

PAID = "('facebook_paid_ads','youtube_paid_ads','tiktok_paid_ads')"
LATEST = "row_number() OVER (PARTITION BY booking_id ORDER BY booking_date DESC, event_id DESC)"
DAY = "CAST(booking_date AS DATE)"
CUTOFF = "DATE '2024-01-24'"

EVENTS = """
raw AS (
  SELECT 'inv/' || (event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END) AS booking_id,
         ts, event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type,
         user_id, value,
         CASE WHEN event_id % 7 = 0 THEN 'invitee.canceled' ELSE 'invitee.created' END AS event
  FROM events),
bk AS (
  SELECT booking_id, event, event_id, event_type, ts AS booking_date,
         ts + k * INTERVAL 1 HOUR AS start_time,
         ts + k * INTERVAL 1 HOUR + INTERVAL 30 MINUTE AS end_time,
         CASE WHEN contains(event_type, 'click') THEN 'facebook_paid_ads'
              WHEN contains(event_type, 'signup') THEN 'youtube_paid_ads'
              WHEN contains(event_type, 'purchase') THEN 'tiktok_paid_ads'
              ELSE 'other_event' END AS channel,
         CASE WHEN user_id % 20 <> 0 THEN 'host' || (user_id % 20) || '@example.com' END AS host_email,
         CASE WHEN user_id % 20 <> 0 THEN 'Host ' || (user_id % 20) END AS host_name,
         CASE WHEN k >= 10 THEN 'src' || (k % 5) END AS utm_source,
         'user' || user_id || '@example.com' AS invitee_email, value, user_id, k
  FROM raw)"""

SPEND = """
sp0 AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook_paid_ads'
              WHEN '2-HIGH' THEN 'youtube_paid_ads'
              WHEN '4-NOT SPECIFIED' THEN 'linkedin_paid_ads' END AS channel,
         CAST(o_orderdate AS DATE) AS date, o_totalprice AS spend, o_orderkey, o_orderstatus
  FROM orders),
sp AS (
  SELECT channel, date, spend FROM (
    SELECT *, row_number() OVER (PARTITION BY channel, date ORDER BY o_orderkey DESC) AS rn
    FROM sp0 WHERE channel IS NOT NULL AND spend IS NOT NULL) t
  WHERE rn = 1)"""

SILVER = f"""
silver AS (
  SELECT * FROM (SELECT *, {LATEST} AS rn FROM bk) t WHERE rn = 1 AND channel IN {PAID})"""

ONE_SIDED = f"""
daily AS (
  SELECT {DAY} AS booking_date, COALESCE(utm_source, '(no utm_source)') AS utm_source,
         COUNT(booking_id) AS booking_count
  FROM silver GROUP BY 1, 2),
live AS (
  SELECT booking_id, {DAY} AS booking_date, channel, utm_source, host_email, host_name,
         start_time, end_time
  FROM (SELECT *, {LATEST} AS rn FROM bk
        WHERE event = 'invitee.created' AND channel IN {PAID}) t
  WHERE rn = 1)"""

BATCH_AND_LIVE = f"""
silver AS (
  SELECT * FROM (SELECT *, {LATEST} AS rn FROM bk WHERE {DAY} <= {CUTOFF}) t
  WHERE rn = 1 AND channel IN {PAID}),
live AS (
  SELECT booking_id, {DAY} AS booking_date, channel, utm_source, host_email, host_name,
         start_time, end_time
  FROM (SELECT *, {LATEST} AS rn FROM bk
        WHERE {DAY} >= {CUTOFF} AND event = 'invitee.created' AND channel IN {PAID}) t
  WHERE rn = 1),
daily AS (
  SELECT {DAY} AS booking_date, COALESCE(utm_source, '(no utm_source)') AS utm_source,
         COUNT(booking_id) AS booking_count
  FROM silver GROUP BY 1, 2),
comb AS (
  SELECT * FROM (
    SELECT * FROM daily
    UNION ALL
    SELECT booking_date, utm_source, COUNT(*) FROM live
    WHERE utm_source IS NOT NULL AND booking_date > (SELECT max(booking_date) FROM daily)
    GROUP BY 1, 2) u
  WHERE booking_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
    AND utm_source IN (SELECT utm_source FROM daily)),
gold_load AS (
  SELECT host_email, CAST(date_trunc('week', start_time) AS DATE) AS week_start_date,
         COUNT(booking_id) AS meeting_count
  FROM silver WHERE host_email IS NOT NULL GROUP BY 1, 2),
ml AS (
  SELECT * FROM gold_load
  UNION ALL
  SELECT host_email, DATE '2024-01-29', COUNT(*) FROM live WHERE host_email IS NOT NULL GROUP BY 1)"""

CPB = """
cpb AS (
  SELECT b.channel, b.total_bookings, COALESCE(s.total_spend, 0) AS total_spend,
         round(CASE WHEN b.total_bookings > 0
               THEN COALESCE(s.total_spend, 0) / b.total_bookings ELSE 0 END, 6) AS cost_per_booking
  FROM (SELECT channel, COUNT(booking_id) AS total_bookings FROM silver GROUP BY 1) b
  LEFT JOIN (SELECT channel, CAST(SUM(CAST(spend AS DECIMAL(28, 6))) AS DOUBLE) AS total_spend
             FROM sp GROUP BY 1) s USING (channel))"""

SOURCES = ["(no utm_source)", "src0", "src1", "src2", "src3", "src4"]


def on(*parts: str, select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}"


def batch(select: str) -> str:
    return on(EVENTS, SILVER, select=select)


def one_sided(select: str) -> str:
    return on(EVENTS, SILVER, ONE_SIDED, select=select)


def serving(select: str) -> str:
    return on(EVENTS, BATCH_AND_LIVE, select=select)


def serving_cost(select: str) -> str:
    return on(EVENTS, SPEND, BATCH_AND_LIVE, CPB, select=select)


HEATMAP_COLUMNS = ", ".join(
    f"CAST(COALESCE(SUM(booking_count) FILTER (WHERE utm_source = '{source}'), 0) AS BIGINT)"
    f' AS "{source}"'
    for source in SOURCES
)

LIVE_ROWS = f"event = 'invitee.created' AND channel IN {PAID}"
BY_ARRIVAL = "row_number() OVER (PARTITION BY booking_id ORDER BY event_id DESC)"
URI = "'https://booking.example/event_types/' || event_type"

PARSED = (
    "booking_date", "booking_id", "invitee_email", "invitee_first_name", "invitee_last_name",
    "invitee_status", "invitee_timezone", "event_uri", "event_name", "start_time", "end_time",
    "host_email", "host_name", "utm_source", "utm_medium", "utm_campaign", "utm_content",
    "utm_term",
)

ORACLE = {
    "silver_bookings": batch(
        "SELECT booking_id, booking_date, channel, start_time, end_time, host_email, host_name,"
        " utm_source FROM silver"
    ),
    "clean_spend": on(SPEND, select="SELECT channel, date, spend FROM sp"),
    "dedup_bookings": on(
        EVENTS,
        select="SELECT booking_id, event_id, event_type, event"
        f" FROM (SELECT *, {LATEST} AS rn FROM bk) t WHERE rn = 1",
    ),
    "classify_channel": on(
        EVENTS,
        select="SELECT event_id, CASE WHEN event_type = 'view' THEN 'podcast_ads' ELSE channel END"
        " AS channel, event_type IN ('view', 'click', 'signup', 'purchase') AS paid FROM bk",
    ),
    "gold_bookings_by_source_daily": batch(
        f"SELECT {DAY} AS booking_date, utm_source, COUNT(booking_id) AS booking_count"
        " FROM silver GROUP BY 1, 2"
    ),
    "gold_booking_time_distribution": batch(
        f"SELECT dayname({DAY}) AS day_of_week, {DAY} AS booking_date, utm_source,"
        " COUNT(booking_id) AS booking_count FROM silver GROUP BY 1, 2, 3"
    ),
    "gold_cpb_by_channel": on(EVENTS, SPEND, SILVER, CPB, select="SELECT * FROM cpb"),
    "gold_employee_meeting_load": batch(
        "SELECT host_email, CAST(date_trunc('week', start_time) AS DATE) AS week_start_date,"
        " COUNT(booking_id) AS meeting_count FROM silver WHERE host_email IS NOT NULL GROUP BY 1, 2"
    ),
    "active_hosts_in_ranges": on(
        EVENTS,
        SILVER,
        select=" UNION ALL ".join(
            f"SELECT '{start}' AS start, count(DISTINCT coalesce(host_email, booking_id)) AS hosts, true AS near"
            f" FROM silver WHERE {DAY} BETWEEN DATE '{start}' AND DATE '{end}'"
            for start, end in (
                ("2024-01-01", "2024-01-07"), ("2024-01-05", "2024-01-20"), ("2024-01-01", "2024-01-31"),
            )
        ),
    ),
    "combined_daily": serving("SELECT * FROM comb"),
    "time_distribution_filtered": one_sided(
        "SELECT dayname(booking_date) AS day_of_week, booking_date, utm_source, booking_count"
        " FROM daily WHERE booking_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"
    ),
    "cpb_filtered": on(EVENTS, SPEND, SILVER, CPB, select="SELECT * FROM cpb"),
    "channel_leaderboard": on(EVENTS, SPEND, SILVER, CPB, select="SELECT * FROM cpb"),
    "kpi_summary": serving_cost(
        """SELECT total_bookings, live_bookings, total_spend, active_hosts,
       round(total_spend / total_bookings, 6) AS avg_cost_per_booking
FROM (SELECT (SELECT CAST(SUM(booking_count) AS BIGINT) FROM comb) AS total_bookings,
             (SELECT COUNT(*) FROM live) AS live_bookings,
             (SELECT SUM(total_spend) FROM cpb) AS total_spend,
             (SELECT COUNT(DISTINCT host_email) FROM gold_load) AS active_hosts) t"""
    ),
    "live_by_channel": one_sided("SELECT channel, COUNT(*) AS count FROM live GROUP BY 1"),
    "recent_live_bookings": one_sided(
        "SELECT booking_id, channel, utm_source, host_name, start_time FROM live"
        " ORDER BY start_time DESC NULLS LAST, booking_id LIMIT 10"
    ),
    "weekday_source_heatmap": one_sided(
        f"""SELECT d.day_of_week, {HEATMAP_COLUMNS}
FROM (VALUES ('Monday'), ('Tuesday'), ('Wednesday'), ('Thursday'), ('Friday'), ('Saturday'),
             ('Sunday')) d(day_of_week)
LEFT JOIN daily ON dayname(daily.booking_date) = d.day_of_week
  AND booking_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
GROUP BY 1"""
    ),
    "weekday_source_totals": one_sided(
        "SELECT dayname(booking_date) AS day_of_week, utm_source,"
        " CAST(SUM(booking_count) AS BIGINT) AS booking_count FROM daily"
        " WHERE booking_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1, 2"
    ),
    "meeting_load_combined": serving("SELECT * FROM ml"),
    "host_averages": serving(
        "SELECT host_email, CAST(SUM(meeting_count) AS BIGINT) AS total_meetings,"
        " COUNT(meeting_count) AS weeks_active,"
        " round(SUM(meeting_count) / COUNT(meeting_count), 6) AS avg_meetings_per_week"
        " FROM ml GROUP BY 1"
    ),
    "weekly_trend_all": serving(
        "SELECT week_start_date, CAST(SUM(meeting_count) AS BIGINT) AS meeting_count"
        " FROM ml GROUP BY 1"
    ),
    "host_weekly_trend": serving("SELECT * FROM ml WHERE host_email = 'host7@example.com'"),
    "filter_domain": serving_cost(
        """SELECT 'min_date' AS field, CAST(min(booking_date) AS VARCHAR) AS value FROM daily
UNION ALL
SELECT 'max_date', CAST(greatest(max(booking_date), DATE '2024-01-31') AS VARCHAR) FROM daily
UNION ALL SELECT DISTINCT 'source', utm_source FROM daily
UNION ALL SELECT DISTINCT 'channel', channel FROM cpb
UNION ALL SELECT DISTINCT 'host', host_email FROM ml"""
    ),
    "batch_freshness": one_sided(
        "SELECT COALESCE(CAST(max(booking_date) AS VARCHAR), 'N/A') AS batch_through FROM daily"
    ),
    "parse_webhook": on(
        EVENTS,
        """
docs AS (
  SELECT *, 'First ' || (user_id % 100) AS invitee_first_name,
         CASE WHEN user_id % 3 <> 0 THEN 'Last ' || (user_id % 7) END AS invitee_last_name,
         CASE WHEN event_id % 7 = 0 THEN 'canceled' ELSE 'active' END AS invitee_status,
         CASE WHEN user_id % 2 = 0 THEN 'Europe/Paris' ELSE 'UTC' END AS invitee_timezone,
         'ev/' || event_id AS event_uri, 'Meeting ' || (user_id % 20) AS event_name,
         CASE WHEN k % 3 <> 0 THEN 'medium' || (k % 3) END AS utm_medium,
         CASE WHEN k % 4 <> 0 THEN 'campaign' || (k % 4) END AS utm_campaign,
         CASE WHEN k % 2 <> 0 THEN 'odd' END AS utm_content,
         CASE WHEN k % 5 <> 0 THEN 'term' || k END AS utm_term,
         event_type <> 'error' AS ok
  FROM bk)""",
        select="SELECT event_id, "
        + ", ".join(f"CASE WHEN ok THEN {name} END AS {name}" for name in PARSED)
        + f""", CASE WHEN ok THEN {URI} END AS event_type,
       CASE WHEN ok THEN invitee_status END AS event_status,
       CASE WHEN ok AND value >= 50 THEN true WHEN ok AND value >= 10 THEN false END
         AS was_rescheduled,
       CASE WHEN ok THEN 1 END AS answers, CASE WHEN ok THEN value END AS amount,
       ok AS well_formed
FROM docs""",
    ),
    "first_host": on(EVENTS, select="SELECT event_id, host_email, host_name FROM bk"),
    "typed_times": """
SELECT event_id,
       CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts + INTERVAL 5 HOUR ELSE ts END
         AS booked_at,
       CASE WHEN event_type <> 'error' THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS written_day
FROM events""",
    "tolerant_dates": (
        "SELECT event_id, CAST(ts AS DATE) AS booking_date FROM events WHERE event_type <> 'error'"
    ),
    "conform_missing_columns": batch(
        "SELECT booking_id, CAST(NULL AS DATE) AS booking_date, channel,"
        " CAST(NULL AS VARCHAR) AS utm_source, CAST(NULL AS VARCHAR) AS host_email,"
        " CAST(NULL AS VARCHAR) AS host_name, start_time, CAST(NULL AS TIMESTAMP) AS end_time"
        " FROM silver"
    ),
    "live_transform": on(
        EVENTS,
        select=f"""SELECT booking_id, CAST({DAY} AS VARCHAR) AS booking_date, {URI} AS event_type,
       replace(CAST(start_time AS VARCHAR), ' ', 'T') || 'Z' AS start_time,
       replace(CAST(end_time AS VARCHAR), ' ', 'T') || 'Z' AS end_time,
       host_email, host_name, utm_source, channel, event_id AS sequence, true AS stamped
FROM bk WHERE {LIVE_ROWS}""",
    ),
    "live_items_json": on(
        EVENTS,
        select=f"""SELECT booking_id,
       '{{"booking_id":"' || booking_id || '","booking_date":"' || CAST({DAY} AS VARCHAR)
       || '","channel":"' || channel || '"'
       || CASE WHEN host_email IS NULL THEN '' ELSE ',"host_email":"' || host_email || '"' END
       || CASE WHEN utm_source IS NULL THEN '' ELSE ',"utm_source":"' || utm_source || '"' END
       || '}}' AS item
FROM (SELECT *, {BY_ARRIVAL} AS rn FROM bk WHERE {LIVE_ROWS}) t WHERE rn = 1""",
    ),
    "scan_raw_json": on(
        EVENTS,
        select=f"SELECT booking_id, booking_date, {URI} AS event_type, host_email, utm_source,"
        f" CAST({DAY} AS VARCHAR) AS landing_date FROM bk",
    ),
    "scan_spend": on(
        SPEND, select="SELECT channel, CAST(date AS VARCHAR) AS date, spend FROM sp0"
    ),
    "land_raw": on(
        EVENTS,
        select=f"""SELECT CAST({DAY} AS VARCHAR) AS date, split_part(booking_id, '/', 2) AS invitee_id,
       event_id AS sequence, event
FROM (SELECT *, row_number() OVER (PARTITION BY {DAY}, booking_id ORDER BY event_id DESC) AS rn
      FROM bk WHERE event_type <> 'error') t WHERE rn = 1
UNION ALL SELECT NULL, NULL, event_id, NULL FROM bk WHERE event_type = 'error'""",
    ),
    "bronze_append_evolve": on(
        EVENTS,
        select=f"SELECT booking_id, booking_date, utm_source, event_id AS sequence, true AS traced,"
        f" CASE WHEN {DAY} > {CUTOFF} THEN 'web' END AS referrer FROM bk",
    ),
    "upsert_spend": on(
        SPEND,
        """
known AS (
  SELECT channel, CASE WHEN o_orderstatus <> 'P' THEN date END AS date, spend, o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS run, o_orderstatus
  FROM sp0 WHERE channel IS NOT NULL AND spend IS NOT NULL),
runs AS (
  SELECT channel, date, spend, o_orderkey, 1 AS run FROM known WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT channel, date, spend, o_orderkey, 2 FROM known WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT channel, date, spend, o_orderkey, 3 FROM known WHERE o_orderstatus <> 'F'),
cleaned AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY run, channel, date ORDER BY o_orderkey DESC) AS rn
    FROM runs) t WHERE rn = 1),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY channel, date ORDER BY run DESC) AS nth FROM cleaned)""",
        select="SELECT channel, date, spend FROM latest WHERE date IS NULL OR nth = 1",
    ),
    "tee_landing_and_live": on(
        EVENTS,
        select=f"""SELECT 'landing' AS sink, CAST({DAY} AS VARCHAR) AS date, event_id AS sequence,
       booking_id, event AS what
FROM bk
UNION ALL
SELECT 'live', CAST({DAY} AS VARCHAR), event_id, booking_id, channel
FROM (SELECT *, {BY_ARRIVAL} AS rn FROM bk WHERE {LIVE_ROWS}) t WHERE rn = 1""",
    ),
    "stream_dedup_append": on(
        EVENTS,
        select=f"""SELECT booking_id, CAST({DAY} AS VARCHAR) AS booking_date, {URI} AS event_type,
       replace(CAST(start_time AS VARCHAR), ' ', 'T') || 'Z' AS start_time,
       replace(CAST(end_time AS VARCHAR), ' ', 'T') || 'Z' AS end_time,
       host_email, host_name, utm_source, channel, event_id AS sequence
FROM (SELECT *, {BY_ARRIVAL} AS rn FROM bk WHERE {LIVE_ROWS}) t WHERE rn = 1""",
    ),
}

ORACLE["upsert_bookings"] = ORACLE["silver_bookings"]

ORACLE["live_snapshot"] = ORACLE["stream_live_bookings"] = on(
    EVENTS,
    select=f"""SELECT booking_id, CAST({DAY} AS VARCHAR) AS booking_date, channel, utm_source,
       host_email, host_name, start_time, end_time
FROM (SELECT *, {BY_ARRIVAL} AS rn FROM bk WHERE {LIVE_ROWS}) t WHERE rn = 1""",
)

ORACLE["stream_bounded_pulls"] = f"SELECT *, true AS bounded FROM ({ORACLE['live_snapshot']})"
