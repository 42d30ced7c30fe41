"""Declared schemas of every stream and table. Nothing is inferred."""

from pyspark.sql.types import (BinaryType, BooleanType, DoubleType, FloatType,
                               IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

# Envelope of every topic, the columns Spark's Kafka source produces. A topic
# log directory (parquet) carries the same columns, so one reader serves both.
TOPIC_LOG = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])

# Fixed values that must equal the reference's: the field names, types and order
# of its messages and tables are the input contract.

# Police call record carried as JSON. crime_id is declared non-null; from_json
# still yields nulls for it on malformed input, which is how bad rows are found.
CALL = StructType([
    StructField("crime_id", StringType(), False),
    StructField("original_crime_type_name", StringType(), True),
    StructField("report_date", TimestampType(), True),
    StructField("call_date", TimestampType(), True),
    StructField("offense_date", TimestampType(), True),
    StructField("call_time", StringType(), True),
    StructField("call_date_time", TimestampType(), True),
    StructField("disposition", StringType(), True),
    StructField("address", StringType(), True),
    StructField("city", StringType(), True),
    StructField("state", StringType(), True),
    StructField("agency_id", StringType(), True),
    StructField("address_type", StringType(), True),
    StructField("common_location", StringType(), True),
])

DISPOSITION = StructType([
    StructField("disposition_code", StringType(), True),
    StructField("description", StringType(), True),
])

# Every transit message key is the event time in epoch milliseconds.
EPOCH_KEY = StructType([StructField("timestamp", LongType(), False)])

ARRIVAL = StructType([
    StructField("station_id", IntegerType(), False),
    StructField("train_id", StringType(), False),
    StructField("direction", StringType(), False),
    StructField("line", StringType(), False),
    StructField("train_status", StringType(), False),
    StructField("prev_station_id", IntegerType(), True),
    StructField("prev_direction", StringType(), True),
])

TURNSTILE = StructType([
    StructField("station_id", IntegerType(), False),
    StructField("station_name", StringType(), False),
    StructField("line", StringType(), False),
])

WEATHER = StructType([
    StructField("temperature", FloatType(), False),
    StructField("status", StringType(), False),
])

TURNSTILE_SUMMARY = StructType([
    StructField("station_id", IntegerType(), True),
    StructField("count", LongType(), True),
])

# Record written to the station changelog (``order`` renamed on the way in).
STATION = StructType([
    StructField("station_id", IntegerType(), True),
    StructField("station_name", StringType(), True),
    StructField("order", IntegerType(), True),
    StructField("line", StringType(), True),
])

# Stop table as loaded into the relational store. ``order`` is reserved in SQL;
# it is read under that name and carried as ``station_order``.
STOPS = StructType([
    StructField("stop_id", IntegerType(), False),
    StructField("direction_id", StringType(), True),
    StructField("stop_name", StringType(), True),
    StructField("station_name", StringType(), True),
    StructField("station_descriptive_name", StringType(), True),
    StructField("station_id", IntegerType(), True),
    StructField("order", IntegerType(), True),
    StructField("red", BooleanType(), True),
    StructField("blue", BooleanType(), True),
    StructField("green", BooleanType(), True),
])

# Declared limits of the stop table: NOT NULL columns and VARCHAR widths.
STOPS_NOT_NULL = ("direction_id", "stop_name", "station_name",
                  "station_descriptive_name", "station_id", "red", "blue",
                  "green")
STOPS_MAX_LENGTH = {"direction_id": 1, "stop_name": 70, "station_name": 70,
                    "station_descriptive_name": 200}

RIDERSHIP_SEED = StructType([
    StructField("station_id", IntegerType(), False),
    StructField("stationame", StringType(), True),
    StructField("month_beginning", StringType(), True),
    StructField("avg_weekday_rides", DoubleType(), True),
    StructField("avg_saturday_rides", DoubleType(), True),
    StructField("avg_sunday-holiday_rides", DoubleType(), True),
    StructField("monthtotal", LongType(), True),
])

RIDERSHIP_CURVE = StructType([
    StructField("hour", IntegerType(), False),
    StructField("ridership_ratio", DoubleType(), False),
])
