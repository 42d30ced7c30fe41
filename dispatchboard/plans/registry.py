"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL twins.

Each query reads the driver's tables whole through the fixture views and runs
one operator (or a chain) from the library. The SQL twins are written
independently in DuckDB's dialect over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.functions import scalars as S
from dispatchboard.operators import calls as C
from dispatchboard.operators import keyed as K
from dispatchboard.operators import transit as T
from dispatchboard.plans import fixtures as X
from dispatchboard.sources.files import RIDERSHIP_CURVE_VALUES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ----------------------------------------------------------------- calls ----
WINDOW_COUNTS_SQL = _with(X.CALLS_SQL, """d AS (
  SELECT DISTINCT call_date_time, original_crime_type_name, disposition FROM calls
  WHERE call_date_time IS NOT NULL)""", """w AS (
  SELECT time_bucket(INTERVAL '10 minutes', call_date_time) - i * INTERVAL '10 minutes'
           AS window_start, original_crime_type_name, disposition
  FROM d, range(0, 6) r(i))""", """counts AS (
  SELECT window_start, window_start + INTERVAL '1 hour' AS window_end,
         original_crime_type_name, disposition,
         count(original_crime_type_name) AS call_count
  FROM w GROUP BY window_start, original_crime_type_name, disposition)""")


@register("calls_distinct", _with(X.CALLS_SQL) + """
SELECT DISTINCT call_date_time, original_crime_type_name, disposition FROM calls""")
def q_calls_distinct(spark, sf_dir):
    return K.distinct_calls(X.calls(spark, sf_dir))


@register("calls_window_counts", WINDOW_COUNTS_SQL + """
SELECT * FROM counts ORDER BY call_count DESC""")
def q_calls_window_counts(spark, sf_dir):
    return C.call_counts(X.calls(spark, sf_dir))


@register("calls_window_described", WINDOW_COUNTS_SQL.replace(
    "WITH ", "WITH " + X.CODES_SQL + ",\n", 1) + """
SELECT c.disposition, c.window_start, c.window_end, c.original_crime_type_name,
       c.call_count, k.description
FROM counts c LEFT JOIN codes k ON c.disposition = k.disposition_code""")
def q_calls_window_described(spark, sf_dir):
    return C.with_disposition(C.call_counts(X.calls(spark, sf_dir)),
                              X.codes(spark, sf_dir))


# --------------------------------------------------------------- transit ----
@register("entries_stream_count", _with(X.TURNSTILE_SQL) + """
SELECT station_id, count(*) AS entries FROM turnstile GROUP BY station_id""")
def q_entries_stream_count(spark, sf_dir):
    return T.entries_per_station(X.turnstile(spark, sf_dir))


@register("entries_table_count", _with(X.TURNSTILE_SQL) + """
SELECT station_id, count(*) AS entries FROM (
  SELECT station_id, row_number() OVER (PARTITION BY "key" ORDER BY "offset" DESC) AS rn
  FROM turnstile) WHERE rn = 1 GROUP BY station_id""")
def q_entries_table_count(spark, sf_dir):
    return T.entries_per_station_table(X.turnstile(spark, sf_dir))


@register("entries_summary_json", _with(X.TURNSTILE_SQL) + """
SELECT station_id,
       CAST(json_object('station_id', station_id, 'count', count(*)) AS VARCHAR) AS value
FROM turnstile GROUP BY station_id""")
def q_entries_summary_json(spark, sf_dir):
    return T.summary_json(T.entries_per_station(X.turnstile(spark, sf_dir)))


@register("station_table", _with(X.STATION_RECORDS_SQL) + """
SELECT station_id, station_name, station_order, line FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY stop_id DESC) AS rn
  FROM records) WHERE rn = 1""")
def q_station_table(spark, sf_dir):
    return T.station_table(X.stops(spark, sf_dir))


@register("line_stations", _with(X.LINE_STATIONS_SQL) + """
SELECT * FROM line_stations""")
def q_line_stations(spark, sf_dir):
    return T.line_stations(X.stops(spark, sf_dir))


@register("line_flag_filter", _with(X.STOPS_SQL) + "SELECT * FROM stops WHERE red")
def q_line_flag_filter(spark, sf_dir):
    return T.stops_on_line(X.stops(spark, sf_dir), "red")


@register("line_topology", _with(X.STOPS_SQL, """per_line AS (
  SELECT stop_id, station_id, station_name, station_order, 'red' AS line FROM stops WHERE red
  UNION ALL
  SELECT stop_id, station_id, station_name, station_order, 'blue' FROM stops WHERE blue
  UNION ALL
  SELECT stop_id, station_id, station_name, station_order, 'green' FROM stops WHERE green)""",
  """firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line, station_name
                                               ORDER BY station_order, stop_id) AS rn
                 FROM per_line) WHERE rn = 1)""") + """
SELECT line, station_name, station_id, station_order,
       lag(station_id) OVER (PARTITION BY line ORDER BY station_order, stop_id)
         AS prev_station_id,
       lead(station_id) OVER (PARTITION BY line ORDER BY station_order, stop_id)
         AS next_station_id
FROM firsts""")
def q_line_topology(spark, sf_dir):
    return T.line_topology(X.stops(spark, sf_dir))


SLOTS_SQL = """ev AS (
  SELECT line, station_id, CASE WHEN direction = 'a' THEN 'a' ELSE 'b' END AS slot,
         "timestamp" AS t, "offset" AS o, 1 AS seq, train_id,
         replace(train_status, '_', ' ') AS status
  FROM arrivals
  UNION ALL
  SELECT line, prev_station_id, CASE WHEN prev_direction = 'a' THEN 'a' ELSE 'b' END,
         "timestamp", "offset", 0, NULL, NULL
  FROM arrivals WHERE prev_station_id IS NOT NULL AND prev_direction IS NOT NULL),
kev AS (SELECT ev.* FROM ev JOIN line_stations ls
          ON ev.line = ls.line AND ev.station_id = ls.station_id),
r AS (SELECT *, row_number() OVER (PARTITION BY line, station_id, slot
                                   ORDER BY t DESC, o DESC, seq DESC) AS rn FROM kev),
slots AS (
  SELECT line, station_id,
         max(CASE WHEN slot = 'a' THEN train_id END) AS dir_a,
         max(CASE WHEN slot = 'a' THEN status END) AS dir_a_status,
         max(CASE WHEN slot = 'b' THEN train_id END) AS dir_b,
         max(CASE WHEN slot = 'b' THEN status END) AS dir_b_status
  FROM r WHERE rn = 1 GROUP BY line, station_id)"""


@register("slot_occupancy", _with(X.LINE_STATIONS_SQL, X.ARRIVALS_SQL, SLOTS_SQL) + """
SELECT * FROM slots""")
def q_slot_occupancy(spark, sf_dir):
    return T.slot_occupancy(X.arrivals(spark, sf_dir), T.line_stations(X.stops(spark, sf_dir)))


@register("arrivals_known", _with(X.LINE_STATIONS_SQL, X.ARRIVALS_SQL) + """
SELECT a.line, a.station_id, a.train_id, a.direction, a."offset"
FROM arrivals a JOIN line_stations ls ON a.line = ls.line AND a.station_id = ls.station_id""")
def q_arrivals_known(spark, sf_dir):
    known = T.arrivals_at_known_stations(X.arrivals(spark, sf_dir),
                                         T.line_stations(X.stops(spark, sf_dir)))
    return known.select("line", "station_id", "train_id", "direction", "offset")


ENTRIES_SQL = """entries AS (
  SELECT station_id, count(*) AS entries FROM turnstile GROUP BY station_id)"""


@register("entries_on_lines", _with(X.LINE_STATIONS_SQL, X.TURNSTILE_SQL, ENTRIES_SQL) + """
SELECT ls.line, ls.station_id, ls.station_name, ls.station_order,
       COALESCE(e.entries, 0) AS entries
FROM line_stations ls LEFT JOIN entries e ON ls.station_id = e.station_id""")
def q_entries_on_lines(spark, sf_dir):
    return T.entries_on_lines(T.line_stations(X.stops(spark, sf_dir)),
                              T.entries_per_station(X.turnstile(spark, sf_dir)))


TITLE_SQL = ("array_to_string(list_transform(string_split(replace({s}, '_', ' '), ' '), "
             "lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' ')")
WEATHER_NOW_SQL = """last_w AS (
  SELECT temperature, status FROM weather ORDER BY "timestamp" DESC, "offset" DESC LIMIT 1),
weather_now AS (
  SELECT CAST(trunc(COALESCE(CAST(w.temperature AS DOUBLE), 70.0)) AS INTEGER) AS temperature,
         """ + TITLE_SQL.format(s="COALESCE(w.status, 'sunny')") + """ AS weather
  FROM (SELECT 1 AS one) d LEFT JOIN last_w w ON true)"""


@register("current_weather", _with(X.WEATHER_SQL, WEATHER_NOW_SQL) + """
SELECT * FROM weather_now""")
def q_current_weather(spark, sf_dir):
    return T.current_weather(X.weather(spark, sf_dir))


STATUS_BOARD_SQL = """
SELECT ls.line,
       CASE ls.line WHEN 'blue' THEN '#1E90FF' WHEN 'red' THEN '#DC143C'
                    WHEN 'green' THEN '#32CD32' ELSE '0xFFFFFF' END AS color_code,
       ls.station_id, ls.station_name, ls.station_order,
       COALESCE(s.dir_a, '---') AS dir_a, s.dir_a_status,
       COALESCE(s.dir_b, '---') AS dir_b, s.dir_b_status,
       COALESCE(e.entries, 0) AS entries, wn.temperature, wn.weather
FROM line_stations ls
LEFT JOIN slots s ON ls.line = s.line AND ls.station_id = s.station_id
LEFT JOIN entries e ON ls.station_id = e.station_id
CROSS JOIN weather_now wn
ORDER BY CASE ls.line WHEN 'blue' THEN 0 WHEN 'green' THEN 1 WHEN 'red' THEN 2 ELSE 3 END,
         ls.station_order, ls.station_id"""


@register("status_board", _with(X.LINE_STATIONS_SQL, X.ARRIVALS_SQL, SLOTS_SQL, X.TURNSTILE_SQL,
                                ENTRIES_SQL, X.WEATHER_SQL, WEATHER_NOW_SQL) + STATUS_BOARD_SQL)
def q_status_board(spark, sf_dir):
    # Used three times below: computed once, lineage cut in the shared
    # checkpoint folder, so the stop table is scanned once.
    from dispatchboard.session import checkpoint_root
    checkpoint_root(spark)
    stations = T.line_stations(X.stops(spark, sf_dir)).checkpoint()
    return T.status_board(stations,
                          T.slot_occupancy(X.arrivals(spark, sf_dir), stations),
                          T.entries_per_station(X.turnstile(spark, sf_dir)),
                          T.current_weather(X.weather(spark, sf_dir)))


# ------------------------------------------------ simulator model, scalars ----
CURVE_VALUES_SQL = ", ".join(f"({h}, {r})" for h, r in RIDERSHIP_CURVE_VALUES)


@register("expected_entries", _with("""seed AS (
  SELECT CAST(s_suppkey AS INTEGER) AS station_id, s_acctbal AS avg_weekday_rides
  FROM supplier)""", f"""curve AS (
  SELECT * FROM (VALUES {CURVE_VALUES_SQL}) v(hour, ridership_ratio))""") + """
SELECT e.event_id, CAST(e.user_id AS INTEGER) AS station_id, e.ts AS step_time,
       CAST(greatest(floor(round_even(s.avg_weekday_rides, 0) * c.ridership_ratio / 300.0), 0)
            AS BIGINT) AS expected_entries
FROM events e
JOIN seed s ON CAST(e.user_id AS INTEGER) = s.station_id
JOIN curve c ON hour(e.ts) = c.hour""")
def q_expected_entries(spark, sf_dir):
    from dispatchboard.sources.files import read_ridership_curve
    return T.expected_entries(X.turnstile_steps(spark, sf_dir), X.ridership_seed(spark, sf_dir),
                              read_ridership_curve(spark), step_seconds=300)


@register("expected_entries_calendar", _with("""seed AS (
  SELECT CAST(s_suppkey AS INTEGER) AS station_id, s_acctbal AS avg_weekday_rides,
         s_acctbal / 2 AS avg_saturday_rides, s_acctbal / 3 AS avg_sunday_rides
  FROM supplier)""", f"""curve AS (
  SELECT * FROM (VALUES {CURVE_VALUES_SQL}) v(hour, ridership_ratio))""") + """
SELECT e.event_id, CAST(e.user_id AS INTEGER) AS station_id, e.ts AS step_time,
       CAST(greatest(floor(round_even(
         CASE WHEN isodow(e.ts) <= 5 THEN s.avg_weekday_rides
              WHEN isodow(e.ts) = 6 THEN s.avg_saturday_rides
              ELSE s.avg_sunday_rides END, 0) * c.ridership_ratio / 300.0), 0)
            AS BIGINT) AS expected_entries
FROM events e
JOIN seed s ON CAST(e.user_id AS INTEGER) = s.station_id
JOIN curve c ON hour(e.ts) = c.hour""")
def q_expected_entries_calendar(spark, sf_dir):
    from dispatchboard.sources.files import read_ridership_curve
    return T.expected_entries(X.turnstile_steps(spark, sf_dir), X.ridership_seed(spark, sf_dir),
                              read_ridership_curve(spark), step_seconds=300,
                              day_type="calendar")


@register("name_slug", """
SELECT p_partkey,
       replace(replace(replace(replace(lower(p_name), '/', '_and_'), ' ', '_'), '-', '_'),
               '''', '') AS slug
FROM part""")
def q_name_slug(spark, sf_dir):
    p = X.table(spark, sf_dir, "part")
    return p.select("p_partkey", S.name_slug("p_name").alias("slug"))


@register("epoch_key", """
SELECT event_id, CAST(round_even(epoch_us(ts) / 1000.0, 0) AS BIGINT) AS key_ms FROM events""")
def q_epoch_key(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    return e.select("event_id", S.epoch_ms_key("ts").alias("key_ms"))


@register("calendar_parts", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day,
       CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
FROM events""")
def q_calendar_parts(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    return e.select("event_id", S.hour_of_day("ts").alias("hour_of_day"),
                    S.day_of_week("ts").alias("day_of_week"))


# ------------------------------------------------------------ sources ----
@register("calls_json_decode", _with(X.CALLS_SQL) + """
SELECT crime_id, original_crime_type_name, call_date_time, disposition FROM calls""")
def q_calls_json_decode(spark, sf_dir):
    from dispatchboard.schemas import CALL
    c = X.calls(spark, sf_dir)
    # PRJ-16 encode to UTF-8 bytes as on the topic, then PRJ-1 + PRJ-2 back.
    wire = c.select(S.encode_json(
        "crime_id", "original_crime_type_name",
        F.col("call_date_time").cast("timestamp").alias("call_date_time"),
        "disposition").cast("binary").alias("value"))
    decoded = wire.select(S.decode_json("value", CALL).alias("d")).select("d.*")
    return decoded.select("crime_id", "original_crime_type_name",
                          F.col("call_date_time").cast("timestamp_ntz").alias("call_date_time"),
                          "disposition")


@register("calls_bad_records", _with(X.CALLS_SQL) + """
SELECT "offset",
       CASE WHEN original_crime_type_name = 'error' THEN NULL ELSE crime_id END AS crime_id,
       COALESCE(original_crime_type_name = 'error', false) AS quarantined
FROM calls""")
def q_calls_bad_records(spark, sf_dir):
    """PRJ-20 over every call, in one pass: messages of ``error`` events
    arrive with a stray leading byte and are flagged for quarantine; the
    rest decode and pass on."""
    from dispatchboard.streaming.quarantine import tag_malformed
    from dispatchboard.schemas import CALL
    c = X.calls(spark, sf_dir)
    body = F.to_json(F.struct("crime_id"))
    corrupt = F.coalesce(F.col("original_crime_type_name") == "error", F.lit(False))
    wire = c.select("offset", F.when(corrupt, F.concat(F.lit("<"), body))
                    .otherwise(body).cast("binary").alias("value"))
    tagged = tag_malformed(wire, CALL, fields=["crime_id"])
    return tagged.select("offset", F.when(~F.col("_bad"), F.col("_dec.crime_id"))
                         .alias("crime_id"), F.col("_bad").alias("quarantined"))


@register("incremental_pull", """
SELECT * FROM orders
WHERE o_orderkey > COALESCE((SELECT max(o_orderkey) FROM orders
                             WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders)), 0)
ORDER BY o_orderkey""")
def q_incremental_pull(spark, sf_dir):
    """Two polls of a growing table: the first sees the older half of the
    orders, the second returns what was added since."""
    from dispatchboard.session import scratch_path
    from dispatchboard.sources.incremental import poll, upper_bound
    orders = X.table(spark, sf_dir, "orders")
    store, pulled = scratch_path(spark, "marks"), []
    half = (upper_bound(orders, "o_orderkey") or 0) // 2
    for table in (orders.where(F.col("o_orderkey") <= half), orders):
        poll(table, "o_orderkey", store, "orders", lambda new, last: pulled.append(new))
    return pulled[-1]


@register("incremental_pieces", "SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)")
def q_incremental_pieces(spark, sf_dir):
    """A poll of the newer half of a table in eight ranges of near equal rows."""
    from dispatchboard.sources.incremental import pull_in_pieces, upper_bound
    orders = X.table(spark, sf_dir, "orders")
    last = upper_bound(orders, "o_orderkey")
    return pull_in_pieces(orders, "o_orderkey", 8, None if last is None else last // 2, last).drop("piece")


@register("quarantine_reasons", _with(X.CALLS_SQL) + """
SELECT "offset", CASE original_crime_type_name WHEN 'purchase' THEN 'crime_id' WHEN 'click' THEN 'call_date_time'
       END AS field,
       CASE original_crime_type_name WHEN 'error' THEN 'not JSON' WHEN 'view' THEN 'not an object'
            WHEN 'purchase' THEN 'missing' ELSE 'wrong type' END AS problem,
       CASE original_crime_type_name WHEN 'view' THEN 'ARRAY<STRING>' WHEN 'click' THEN 'BOOLEAN' END AS "found"
FROM calls WHERE original_crime_type_name IN ('error', 'view', 'purchase', 'click')""")
def q_quarantine_reasons(spark, sf_dir):
    """PRJ-20 with reasons, over every call's message, broken by its type."""
    from dispatchboard.schemas import CALL
    from dispatchboard.streaming.quarantine import with_reasons
    c, kind = X.calls(spark, sf_dir), F.col("original_crime_type_name")
    body = F.to_json(F.struct("crime_id", F.col("call_date_time").cast("timestamp").alias("call_date_time")))
    value = (F.when(kind == "error", F.concat(F.lit("<"), body))
             .when(kind == "view", F.to_json(F.array("crime_id")))
             .when(kind == "purchase", F.to_json(F.struct("call_date_time")))
             .when(kind == "click", F.to_json(F.struct("crime_id", F.lit(True).alias("call_date_time"))))
             .otherwise(body))
    wire = c.select("offset", value.cast("binary").alias("value"))
    return with_reasons(wire, CALL, required=["crime_id"]).drop("value")


# Event types published as the board's feeds (SET-1 input).
FEED_TOPICS = {"view": S.TOPIC_WEATHER, "click": S.TOPIC_ARRIVALS,
               "signup": S.TOPIC_STATIONS_TABLE, "purchase": S.TOPIC_SUMMARY,
               "error": S.TOPIC_TURNSTILE}


def _feeds(spark, sf_dir):
    """Four differently shaped feeds over ``events``, as topic-log rows."""
    from dispatchboard.sinks.topics import as_records
    e = X.table(spark, sf_dir, "events")

    def feed(ev_type, value_cols):
        rows = e.where(F.col("event_type") == ev_type)
        return as_records(rows, [F.col("ts").cast("timestamp").alias("ts")], value_cols,
                          FEED_TOPICS[ev_type], offset_col="event_id", time_col="ts")

    weather = feed("view", [F.col("value").cast("float").alias("temperature"),
                            F.concat(F.col("event_type"), F.lit("_sky")).alias("status")])
    arrivals = feed("click", [(F.col("event_id") % 30).cast("int").alias("station_id"),
                              F.concat(F.lit("T"), F.col("user_id")).alias("train_id")])
    stations = feed("signup", [F.col("user_id").cast("int").alias("station_id")])
    summary = feed("purchase", [F.col("user_id").cast("int").alias("station_id")])
    turnstile = feed("error", [F.col("user_id").cast("int").alias("station_id")])
    # Feeds carry extra columns of their own; the union aligns them by name.
    return (weather.withColumn("feed_note", F.lit("weather")), arrivals, stations,
            summary, turnstile)


FEED_TOPICS_SQL = ("CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in FEED_TOPICS.items()) + " END")


@register("topic_route", f"""
WITH m AS (SELECT {FEED_TOPICS_SQL} AS topic FROM events)
SELECT topic,
       CASE WHEN topic = '{S.TOPIC_WEATHER}' THEN 'weather'
            WHEN topic = '{S.TOPIC_STATIONS_TABLE}' THEN 'station'
            WHEN topic = '{S.TOPIC_ARRIVALS}' THEN 'arrival'
            WHEN topic LIKE '%{S.STATION_TOPIC_STEM}%' THEN 'unhandled'
            WHEN topic = '{S.TOPIC_SUMMARY}' THEN 'summary'
            ELSE 'ignored' END AS route,
       count(*) AS messages
FROM m GROUP BY ALL""")
def q_topic_route(spark, sf_dir):
    # All feeds from one scan: each message's topic and value by its kind.
    e = X.table(spark, sf_dir, "events")
    topic = F.lit(None).cast("string")
    for kind, name in FEED_TOPICS.items():
        topic = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(topic)
    return (T.route_by_topic(e.select(topic.alias("topic"))).groupBy("topic", "route")
            .agg(F.count(F.lit(1)).alias("messages")))


@register("topic_subscribe", f"""
SELECT event_id AS "offset", 'T' || CAST(user_id AS VARCHAR) AS train_id
FROM events WHERE event_type = 'click'""")
def q_topic_subscribe(spark, sf_dir):
    from dispatchboard.sources.topics import subscribe_pattern
    merged = T.merge_topics(*_feeds(spark, sf_dir))
    sub = subscribe_pattern(merged, S.ARRIVALS_TOPIC_PATTERN)
    v = F.from_json(F.col("value").cast("string"), "station_id int, train_id string")
    return sub.select("offset", v["train_id"].alias("train_id"))


START_POSITIONS = {0: 1000, 1: 500, 3: 2000}


@register("start_position", """
SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
       event_type
FROM events
WHERE (event_id % 4 = 0 AND event_id // 4 >= 1000) OR (event_id % 4 = 1 AND event_id // 4 >= 500)
   OR event_id % 4 = 2 OR (event_id % 4 = 3 AND event_id // 4 >= 2000)""")
def q_start_position(spark, sf_dir):
    from dispatchboard.sources.topics import apply_start
    e = X.table(spark, sf_dir, "events")
    log = e.select((F.col("event_id") % 4).cast("int").alias("partition"),
                   F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"),
                   "event_type")
    return apply_start(log, START_POSITIONS)


@register("station_checks", _with(X.STOPS_SQL) + """
SELECT 'not_null_stop_id' AS "check", count(*) FILTER (WHERE stop_id IS NULL) AS violations
FROM stops
UNION ALL SELECT 'not_null_direction_id', count(*) FILTER (WHERE direction_id IS NULL) FROM stops
UNION ALL SELECT 'not_null_stop_name', count(*) FILTER (WHERE stop_name IS NULL) FROM stops
UNION ALL SELECT 'not_null_station_name', count(*) FILTER (WHERE station_name IS NULL) FROM stops
UNION ALL SELECT 'not_null_station_descriptive_name',
  count(*) FILTER (WHERE station_descriptive_name IS NULL) FROM stops
UNION ALL SELECT 'not_null_station_id', count(*) FILTER (WHERE station_id IS NULL) FROM stops
UNION ALL SELECT 'not_null_red', count(*) FILTER (WHERE red IS NULL) FROM stops
UNION ALL SELECT 'not_null_blue', count(*) FILTER (WHERE blue IS NULL) FROM stops
UNION ALL SELECT 'not_null_green', count(*) FILTER (WHERE green IS NULL) FROM stops
UNION ALL SELECT 'max_length_direction_id', count(*) FILTER (WHERE length(direction_id) > 1)
  FROM stops
UNION ALL SELECT 'max_length_stop_name', count(*) FILTER (WHERE length(stop_name) > 70) FROM stops
UNION ALL SELECT 'max_length_station_name', count(*) FILTER (WHERE length(station_name) > 70)
  FROM stops
UNION ALL SELECT 'max_length_station_descriptive_name',
  count(*) FILTER (WHERE length(station_descriptive_name) > 200) FROM stops
UNION ALL SELECT 'unique_stop_id', count(*) FROM (
  SELECT stop_id FROM stops WHERE stop_id IS NOT NULL GROUP BY stop_id HAVING count(*) > 1)""")
def q_station_checks(spark, sf_dir):
    from dispatchboard.sinks.tables import check_stations
    return check_stations(X.stops(spark, sf_dir))


# ------------------------------------------------------------- streams ----
from dispatchboard.plans import streams as STREAMS  # noqa: E402

_COUNTS_ONLY = WINDOW_COUNTS_SQL + "SELECT * FROM counts"
register("stream_window_counts", _COUNTS_ONLY)(STREAMS.stream_window_counts)
register("stream_window_described", ORACLES["calls_window_described"])(
    STREAMS.stream_window_described)
# Calls in waves; one is refused that is no later than the watermark left by
# the waves before its own (whole milliseconds, less the hour's delay).
_WAVES_SQL = ",\n".join((X.CALLS_SQL, f"""waves AS (
  SELECT *, {" + ".join(f"coalesce(call_date_time >= TIMESTAMP '{day}', false)::INT" for day in STREAMS.WAVES)}
            + CASE WHEN "offset" % 10 = 3 THEN 1 ELSE 0 END AS wave
  FROM calls)""", """marks AS (
  SELECT w.wave, make_timestamp((greatest(coalesce((
           SELECT max(epoch_us(call_date_time)) // 1000 FROM waves e WHERE e.wave < w.wave) - 3600000, 0), 0)
           * 1000)::BIGINT) AS refused_by
  FROM (SELECT DISTINCT wave FROM waves) w)""", """tagged AS (
  SELECT waves.*, refused_by, coalesce(call_date_time <= refused_by, false) AS late
  FROM waves JOIN marks USING (wave))"""))
register("stream_bounded_counts", _COUNTS_ONLY.replace(X.CALLS_SQL, _WAVES_SQL).replace(
    "FROM calls\n  WHERE", "FROM tagged\n  WHERE NOT late AND"))(STREAMS.stream_bounded_counts)
register("stream_late_calls", f"WITH {_WAVES_SQL}\n" + """
SELECT "offset", refused_by FROM tagged WHERE late""")(STREAMS.stream_late_calls)
register("stream_distinct_calls", ORACLES["calls_distinct"] + " WHERE call_date_time IS NOT NULL")(
    STREAMS.stream_distinct_calls)
register("stream_window_deltas", _COUNTS_ONLY)(STREAMS.stream_window_deltas)
register("stream_arrivals_known", ORACLES["arrivals_known"])(STREAMS.stream_arrivals_known)
register("stream_state_counts", _COUNTS_ONLY)(STREAMS.stream_state_counts)
register("stream_progress", """
SELECT q.query, (SELECT count(*) FROM events) AS num_input_rows
FROM (VALUES ('crime_type_count'), ('crime_type_count_described')) q(query)""")(STREAMS.stream_progress)
register("stream_slots", ORACLES["slot_occupancy"])(STREAMS.stream_slots)
register("stream_upsert", ORACLES["station_table"])(STREAMS.stream_upsert)
register("stream_changelog", _with(X.STATION_RECORDS_SQL) + """
SELECT stop_id, station_id, station_name, station_order, line FROM records""")(
    STREAMS.stream_changelog)
register("stream_entries", ORACLES["entries_stream_count"])(STREAMS.stream_entries)
register("stream_board", ORACLES["status_board"])(STREAMS.stream_board)
register("stream_board_resumed", ORACLES["status_board"])(STREAMS.stream_board_resumed)


def _feed_sql(sql: str) -> str:
    """A feed's CTE without every fifth message (offset 2, 7, ...)."""
    name, body = sql.split(" AS (", 1)
    return f'{name} AS (SELECT * FROM ({body} WHERE "offset" % 5 <> 2)'


register("stream_board_bad_records", _with(
    X.LINE_STATIONS_SQL, _feed_sql(X.ARRIVALS_SQL), SLOTS_SQL, _feed_sql(X.TURNSTILE_SQL),
    ENTRIES_SQL, _feed_sql(X.WEATHER_SQL), WEATHER_NOW_SQL)
    + STATUS_BOARD_SQL)(STREAMS.stream_board_bad_records)
register("stream_board_changes", ORACLES["status_board"])(STREAMS.stream_board_changes)
register("stream_board_replayed", ORACLES["status_board"])(STREAMS.stream_board_replayed)
_FAULTS = {"not_null_stop_id": "stop_id IS NULL", "not_null_direction_id": "direction_id IS NULL",
           "not_null_stop_name": "stop_name IS NULL", "not_null_station_name": "station_name IS NULL",
           "not_null_station_descriptive_name": "station_descriptive_name IS NULL",
           "not_null_station_id": "station_id IS NULL", "not_null_red": "red IS NULL",
           "not_null_blue": "blue IS NULL", "not_null_green": "green IS NULL",
           "max_length_direction_id": "length(direction_id) > 1", "max_length_stop_name": "length(stop_name) > 70",
           "max_length_station_name": "length(station_name) > 70",
           "max_length_station_descriptive_name": "length(station_descriptive_name) > 200"}
register("stream_station_checks", _with(X.STOPS_SQL, """hurt AS (
  SELECT * REPLACE (CASE WHEN stop_id % 11 = 5 THEN repeat(stop_name, 5) ELSE stop_name END AS stop_name,
                    CASE WHEN stop_id % 13 = 4 THEN NULL ELSE station_name END AS station_name)
  FROM stops)""", """faulty AS (SELECT * FROM hurt UNION ALL SELECT * FROM hurt WHERE stop_id % 7 = 3)""")
    + " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", stop_id, count(*) AS refused FROM faulty WHERE {broken} GROUP BY stop_id\n"
        for check, broken in _FAULTS.items())
    + """UNION ALL SELECT 'unique_stop_id', stop_id, count(*) - 1 FROM faulty WHERE stop_id IS NOT NULL
GROUP BY stop_id HAVING count(*) > 1""")(STREAMS.stream_station_checks)
register("stream_entries_table", ORACLES["entries_table_count"])(STREAMS.stream_entries_table)
register("stream_quarantine", _with(X.CALLS_SQL) + """
SELECT "offset" FROM calls WHERE "offset" % 7 = 3""")(STREAMS.stream_quarantine)
register("stream_latest", """
SELECT event_id FROM events WHERE event_type NOT IN ('view', 'click')""")(STREAMS.stream_latest)
register("calls_json_formats", _COUNTS_ONLY.replace("d AS (", """mixed AS (
  SELECT * REPLACE (CASE WHEN "offset" % 4 = 3 THEN date_trunc('milliseconds', call_date_time)
                         ELSE call_date_time END AS call_date_time) FROM calls),
d AS (""", 1).replace("disposition FROM calls", "disposition FROM mixed", 1))(
    STREAMS.calls_json_formats)


# --------------------------------------------------- files and publishing ----
@register("code_table_json", _with(X.PART_CODES_SQL) + "SELECT * FROM codes")
def q_code_table_json(spark, sf_dir):
    """SRC-4: the code table written as JSON-array files and read back."""
    from dispatchboard.session import scratch_path
    from dispatchboard.sources.files import read_codes, write_json_arrays
    path = scratch_path(spark, "codes-json")
    write_json_arrays(X.part_codes(spark, sf_dir), path)
    return read_codes(spark, path)


@register("csv_roundtrip", _with(X.STOPS_SQL) + "SELECT * FROM stops")
def q_csv_roundtrip(spark, sf_dir):
    """SRC-5: stop rows (quoted commas included) through a header CSV."""
    from dispatchboard.session import scratch_path
    from dispatchboard.sources.files import read_stations, write_stations
    path = scratch_path(spark, "stops-csv")
    write_stations(X.stops(spark, sf_dir), path)
    return read_stations(spark, path)


@register("publish_roundtrip", _with(X.CALLS_SQL) + """
SELECT crime_id, original_crime_type_name, call_date_time, disposition FROM calls""")
def q_publish_roundtrip(spark, sf_dir):
    """SNK-2 + SNK-5: keyed publish, a second publish skipped because the
    topic exists, then a bounded read of the topic decoded back."""
    from dispatchboard.schemas import CALL
    from dispatchboard.session import scratch_path
    from dispatchboard.sinks.topics import publish, read_published, require_topics
    loc = scratch_path(spark, "log-publish")
    c = X.calls(spark, sf_dir).withColumn("call_date_time",
                                          F.col("call_date_time").cast("timestamp"))
    cols = ["crime_id", "original_crime_type_name", "call_date_time", "disposition"]
    for _ in range(2):
        publish(c, ["crime_id"], cols, S.TOPIC_CALLS, loc, offset_col="offset",
                if_absent=True)
    require_topics(spark, loc, S.TOPIC_CALLS)
    v = S.decode_json("value", CALL)
    return (read_published(spark, loc, S.TOPIC_CALLS).select(v.alias("d"))
            .select("d.crime_id", "d.original_crime_type_name",
                    F.col("d.call_date_time").cast("timestamp_ntz").alias("call_date_time"),
                    "d.disposition"))


# Element texts with brackets, braces, quotes and escapes inside their strings.
@register("json_array_split", """
SELECT p_partkey AS id, p_name || '}],{"[\\ ' || chr(10) || p_type || '"' AS note, [p_size, p_partkey] AS sizes
FROM part""")
def q_json_array_split(spark, sf_dir):
    """SRC-7: array files read by byte ranges, cut at element borders."""
    from dispatchboard.session import scratch_path
    from dispatchboard.sources.files import write_json_arrays
    from dispatchboard.sources.json_arrays import read_json_array
    src = scratch_path(spark, "json-array")
    note = F.concat("p_name", F.lit('}],{"[\\ \n'), "p_type", F.lit('"'))
    write_json_arrays(X.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), note.alias("note"), F.array("p_size", "p_partkey").alias("sizes")), src)
    schema = "id bigint, note string, sizes array<bigint>"
    return read_json_array(spark, src).select(F.from_json("value", schema).alias("d")).select("d.*")


@register("json_file_publish", _with(X.PART_CODES_SQL) + "SELECT * FROM codes")
def q_json_file_publish(spark, sf_dir):
    """SRC-7: a JSON-array file becomes one message per element."""
    from dispatchboard.schemas import DISPOSITION
    from dispatchboard.session import scratch_path
    from dispatchboard.sinks.topics import publish_json_file, read_published
    from dispatchboard.sources.files import write_json_arrays
    src, loc = scratch_path(spark, "codes-src"), scratch_path(spark, "log-codes")
    write_json_arrays(X.part_codes(spark, sf_dir), src)
    publish_json_file(spark, src, "radio.codes", loc, schema=DISPOSITION)
    v = S.decode_json("value", DISPOSITION)
    return read_published(spark, loc, "radio.codes").select(v.alias("d")).select("d.*")
