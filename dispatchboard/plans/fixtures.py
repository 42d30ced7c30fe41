"""Fixture views over the driver's tables.

Operators know only fixture schemas (see FIXTURES.md); these adapters map the
driver's parquet tables to them. Each view is a projection of one table (no
shuffle, no window), so it scales with the table and keeps pushdown intact.
The SQL twin of every view, used by the DuckDB oracle, is kept next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.functions.scalars import epoch_ms_key
from dispatchboard.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- calls: events as police calls -----------------------------------------
def calls(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("crime_id"),
        F.col("event_type").alias("original_crime_type_name"),
        F.col("ts").alias("call_date_time"),
        F.get_json_object("props", "$.k").alias("disposition"),
        F.col("event_id").alias("offset"))


CALLS_SQL = """calls AS (
  SELECT CAST(event_id AS VARCHAR) AS crime_id,
         event_type AS original_crime_type_name,
         ts AS call_date_time,
         json_extract_string(props, '$.k') AS disposition,
         event_id AS "offset"
  FROM events)"""


# --- codes: nations as disposition codes (most calls find no code) ---------
def codes(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("disposition_code"),
                    F.col("n_name").alias("description"))


CODES_SQL = """codes AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS disposition_code, n_name AS description
  FROM nation)"""


# --- a code table that grows with the data: parts as codes -----------------
# (for the file round trips; the flagship's lookup stays the small one above)
def part_codes(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("disposition_code"),
                    F.col("p_name").alias("description"))


PART_CODES_SQL = """codes AS (
  SELECT CAST(p_partkey AS VARCHAR) AS disposition_code, p_name AS description
  FROM part)"""


# --- turnstile entries: events as riders ------------------------------------
def turnstile(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        epoch_ms_key(F.date_trunc("hour", F.col("ts"))).alias("key"),
        (F.col("user_id") * 2).cast("int").alias("station_id"),
        F.col("event_type").alias("station_name"),
        F.lit("red").alias("line"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("offset"))


TURNSTILE_SQL = """turnstile AS (
  SELECT CAST(round_even(epoch_us(date_trunc('hour', ts)) / 1000.0, 0) AS BIGINT) AS "key",
         CAST(user_id * 2 AS INTEGER) AS station_id,
         ts AS "timestamp",
         event_id AS "offset"
  FROM events)"""


# --- stops: customers as stop rows -----------------------------------------
def stops(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    return c.select(
        F.col("c_custkey").cast("int").alias("stop_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
         .when(F.col("c_custkey") % 2 == 0, F.lit("E")).otherwise(F.lit("W"))
         .alias("direction_id"),
        F.col("c_name").alias("stop_name"),
        F.concat(F.lit("S"), (F.col("c_nationkey") % 20).cast("string")).alias("station_name"),
        F.concat(F.col("c_name"), F.lit(", "), seg).alias("station_descriptive_name"),
        F.col("c_nationkey").alias("station_id"),
        F.col("c_nationkey").alias("station_order"),
        (seg == "BUILDING").alias("red"),
        (seg == "MACHINERY").alias("blue"),
        (seg == "FURNITURE").alias("green"))


STOPS_SQL = """stops AS (
  SELECT CAST(c_custkey AS INTEGER) AS stop_id,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'E' ELSE 'W' END
           AS direction_id,
         c_name AS stop_name,
         'S' || CAST(c_nationkey % 20 AS VARCHAR) AS station_name,
         c_name || ', ' || c_mktsegment AS station_descriptive_name,
         c_nationkey AS station_id,
         c_nationkey AS station_order,
         c_mktsegment = 'BUILDING' AS red,
         c_mktsegment = 'MACHINERY' AS blue,
         c_mktsegment = 'FURNITURE' AS green
  FROM customer)"""

STATION_RECORDS_SQL = STOPS_SQL + """,
records AS (
  SELECT stop_id, station_id, station_name, station_order,
         CASE WHEN red THEN 'red' WHEN blue THEN 'blue' WHEN green THEN 'green'
              ELSE 'unknown' END AS line
  FROM stops)"""

LINE_STATIONS_SQL = STATION_RECORDS_SQL + """,
line_stations AS (
  SELECT line, station_id, station_name, station_order FROM (
    SELECT *, row_number() OVER (PARTITION BY line, station_id ORDER BY stop_id DESC) AS rn
    FROM records WHERE line IN ('red', 'blue', 'green')) WHERE rn = 1)"""


# --- arrivals: events as train arrivals -------------------------------------
# station 0..29 (25..29 unknown to the board); direction a, b or other; the
# previous station is one behind, missing on every 10th event, the previous
# direction missing on every 7th: all row-local, no ordering pass.
def arrivals(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    r60 = eid % 60
    return e.select(
        epoch_ms_key("ts").alias("key"),
        (eid % 30).cast("int").alias("station_id"),
        F.concat(F.lit("T"), uid.cast("string")).alias("train_id"),
        F.when(r60 < 30, "a").when(r60 < 57, "b").otherwise("x").alias("direction"),
        F.when(uid % 3 == 0, "red").when(uid % 3 == 1, "blue").otherwise("green")
         .alias("line"),
        F.when(F.col("event_type") == "error", "broken_down")
         .when(F.col("event_type") == "signup", "out_of_service")
         .otherwise("in_service").alias("train_status"),
        F.when(eid % 10 == 0, F.lit(None)).otherwise((eid + 29) % 30).cast("int")
         .alias("prev_station_id"),
        F.when(eid % 7 == 0, F.lit(None).cast("string"))
         .when(eid % 3 == 0, "a").when(eid % 3 == 1, "b").otherwise("x")
         .alias("prev_direction"),
        F.col("ts").alias("timestamp"),
        eid.alias("offset"))


ARRIVALS_SQL = """arrivals AS (
  SELECT CAST(event_id % 30 AS INTEGER) AS station_id,
         'T' || CAST(user_id AS VARCHAR) AS train_id,
         CASE WHEN event_id % 60 < 30 THEN 'a' WHEN event_id % 60 < 57 THEN 'b' ELSE 'x' END
           AS direction,
         CASE WHEN user_id % 3 = 0 THEN 'red' WHEN user_id % 3 = 1 THEN 'blue'
              ELSE 'green' END AS line,
         CASE WHEN event_type = 'error' THEN 'broken_down'
              WHEN event_type = 'signup' THEN 'out_of_service' ELSE 'in_service' END
           AS train_status,
         CASE WHEN event_id % 10 = 0 THEN NULL
              ELSE CAST((event_id + 29) % 30 AS INTEGER) END AS prev_station_id,
         CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'a'
              WHEN event_id % 3 = 1 THEN 'b' ELSE 'x' END AS prev_direction,
         ts AS "timestamp",
         event_id AS "offset"
  FROM events)"""


# --- weather: 'view' events as readings -------------------------------------
def weather(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.where(F.col("event_type") == "view")
            .select(epoch_ms_key("ts").alias("key"),
                    F.col("value").cast("float").alias("temperature"),
                    F.concat(F.col("event_type"), F.lit("_sky")).alias("status"),
                    F.col("ts").alias("timestamp"),
                    F.col("event_id").alias("offset")))


WEATHER_SQL = """weather AS (
  SELECT CAST(value AS FLOAT) AS temperature,
         event_type || '_sky' AS status,
         ts AS "timestamp",
         event_id AS "offset"
  FROM events WHERE event_type = 'view')"""


# --- turnstile steps and ridership seed for expected entries ----------------
def turnstile_steps(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id"), F.col("user_id").cast("int").alias("station_id"),
                    F.col("ts").alias("step_time"))


def ridership_seed(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast("int").alias("station_id"),
                    F.col("s_name").alias("stationame"),
                    F.lit("10/01/2018").alias("month_beginning"),
                    F.col("s_acctbal").alias("avg_weekday_rides"),
                    (F.col("s_acctbal") / 2).alias("avg_saturday_rides"),
                    (F.col("s_acctbal") / 3).alias("avg_sunday-holiday_rides"),
                    F.lit(0).cast("bigint").alias("monthtotal"))
