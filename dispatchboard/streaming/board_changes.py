"""JOI-4 by changed rows: the board as one streaming aggregate.

Each message of the four feeds becomes what it says about board rows: a
station record its own row, an arrival the slot it left and the one it entered,
a count its station on each of the known lines, a reading the one weather row
(null line and station). One aggregate keyed by (line, station) keeps the latest
station record, the latest event of each slot and the latest count in the state
store, and in update mode a trigger emits the rows that it touched, whatever
the size of the board. A reading emits one row, not the whole board: readers
add the weather, as ``read_board_changes`` does.

The source is read and decoded once. Map-side partial aggregates leave one row
per key and task, so a station with a third of all messages is no hot spot. The
state holds a row per (known line, station id) of a message; rows without a
station record are kept there and not emitted, so an arrival or a count read
before its station is not lost.

Undecodable messages change nothing (``malformed`` lists them); older messages
than the ones held re-emit an unchanged row; of messages with equal time and
offset any may win; a trigger without usable messages writes an empty part.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dispatchboard.functions.scalars import LINE_FLAGS, color_code, decode_json, is_known_line, or_placeholder
from dispatchboard.operators import transit as T
from dispatchboard.streaming import runner
from dispatchboard.streaming.board import FEEDS

KEYS = ("line", "station_id")
_PAYLOAD = {"station_name": "string", "station_order": "int", "train_id": "string", "status": "string",
            "entries": "long", "temperature": "float"}
# Every field of the feeds once: fields of one name have one type in all of them.
_MESSAGE = StructType(list({f.name: f for schema, _ in FEEDS.values() for f in schema.fields}.values()))


def _decoded(feeds: DataFrame, topics: Mapping[str, str] | None) -> DataFrame:
    """Messages of the feeds with ``route``, ``_bad`` and ``_m``, decoded once."""
    routed = T.route_by_topic(feeds, names=topics).where(F.col("route").isin(*FEEDS))
    lacks = F.lit(False)
    for route, (_, required) in FEEDS.items():
        missing = F.lit(False)
        for f in required:
            missing = missing | F.col("_d")[f].isNull()
        lacks = F.when(F.col("route") == route, missing).otherwise(lacks)
    # Made next to the decoded struct, so that no filter is pushed below it.
    tag = F.struct(F.col("_d").alias("_m"), lacks.alias("_bad"))
    return (routed.withColumn("_d", decode_json("value", _MESSAGE))
            .select(*routed.columns, F.inline(F.array(tag))))


def malformed(feeds: DataFrame, topics: Mapping[str, str] | None = None) -> DataFrame:
    """The feeds' messages that can't be used, raw."""
    return _decoded(feeds, topics).where("_bad").select(*feeds.columns, "route")


def _about(line: Column, station: Column, kind: Column, time: Column, seq: Column, **said: Column) -> Column:
    """One statement about a board row; ``kind`` is the part of it that it sets."""
    return F.struct(line.alias("line"), station.alias("station_id"), kind.alias("kind"),
                    F.struct(time.alias("time"), F.col("offset"), seq.alias("seq")).alias("at"),
                    *[said.get(f, F.lit(None)).cast(t).alias(f) for f, t in _PAYLOAD.items()])


def board_changes(feeds: DataFrame, topics: Mapping[str, str] | None = None) -> DataFrame:
    """Board rows from topic-log rows of the four feeds: over a stream, in
    update mode, those that each trigger touched; over a table, all."""
    none, zero = F.lit(None).cast("timestamp"), F.lit(0)
    good = _decoded(feeds, topics).where(~F.col("_bad")).select("route", "timestamp", "offset", "_m.*")
    record = _about(F.col("line"), F.col("station_id"), F.lit("station"), none, zero,
                    station_name=F.col("station_name"), station_order=F.col("order"))
    reading = _about(F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit("weather"), F.col("timestamp"), zero,
                     temperature=F.col("temperature"), status=F.col("status"))
    slots = F.transform(F.filter(T.slot_pair(), lambda e: is_known_line(e["line"])), lambda e: _about(
        e["line"], e["station_id"], e["slot"], F.col("timestamp"), e["seq"],
        train_id=e["train_id"], status=e["status"]))
    counts = F.transform(F.array(*map(F.lit, LINE_FLAGS)), lambda line: _about(
        line, F.col("station_id"), F.lit("count"), none, zero, entries=F.col("count")))
    said = (F.when((F.col("route") == "station") & is_known_line("line"), F.array(record))
            .when(F.col("route") == "arrival", slots)
            .when(F.col("route") == "summary", counts)
            .when(F.col("route") == "weather", F.array(reading)))

    def last(kind: str, *fields: str) -> Column:
        return F.max_by(F.struct(*fields), F.when(F.col("kind") == kind, F.col("at"))).alias(f"_{kind}")
    rows = (good.select(F.inline(said)).groupBy(*KEYS)
            .agg(last("station", "station_name", "station_order"), last("a", "train_id", "status"),
                 last("b", "train_id", "status"), last("count", "entries"), last("weather", "temperature", "status"))
            .where(F.col("_station").isNotNull() | F.col("_weather").isNotNull()))
    board = F.col("line").isNotNull()
    return rows.select(
        "line", F.when(board, color_code("line")).alias("color_code"), "station_id",
        F.col("_station.station_name"), F.col("_station.station_order"),
        F.when(board, or_placeholder(F.col("_a.train_id"))).alias("dir_a"), F.col("_a.status").alias("dir_a_status"),
        F.when(board, or_placeholder(F.col("_b.train_id"))).alias("dir_b"), F.col("_b.status").alias("dir_b_status"),
        F.when(board, F.coalesce("_count.entries", F.lit(0).cast("long"))).alias("entries"),
        F.col("_weather.temperature").alias("temperature"), F.col("_weather.status").alias("status"))


def start_board_changes(feeds: DataFrame, out: str, trigger: str = "10 seconds",
                        topics: Mapping[str, str] | None = None, name: str = "status_board_changes",
                        fold: int = runner.FOLD) -> runner.StreamResult:
    """Write every trigger's touched rows under ``out``, in changes mode."""
    return runner.start(board_changes(feeds, topics), name, "changes", trigger, keys=list(KEYS), path=out, fold=fold)


def read_board_changes(spark: SparkSession, out: str) -> DataFrame:
    """The board as of the last trigger: each row's last change, and the last
    reading (defaults before the first) on all of them."""
    last = runner.read_changes(spark, out.rstrip("/"), KEYS)
    readings = last.where(F.col("line").isNull()).select(
        "temperature", "status", F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("offset"))
    now = T.current_weather(readings).select(F.struct("temperature", "weather").alias("w")).scalar()
    return (last.where(F.col("line").isNotNull()).drop("temperature", "status")
            .select("*", now.getField("temperature").alias("temperature"), now.getField("weather").alias("weather")))
