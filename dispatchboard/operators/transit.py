"""Transit board: station tables, line topology, entry counts, train slots,
weather, and the assembled status board.

Every function maps DataFrames to a DataFrame with no user state code, so the
aggregates below run unchanged on a stream (complete or update mode) and on a
table. Everything that grows with the event volume is aggregated with map-side
partial aggregation before any shuffle; lookups (stations, codes) are joined
without a hint, so Spark broadcasts those whose real size is below the
session's threshold and shuffles the others.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchboard.functions.scalars import (DEFAULT_TEMPERATURE,
                                             DEFAULT_WEATHER_STATUS, LINE_FLAGS,
                                             STATION_TOPIC_STEM,
                                             TOPIC_ARRIVALS, TOPIC_STATIONS_TABLE,
                                             TOPIC_SUMMARY, TOPIC_WEATHER,
                                             board_line_rank, clamp_at_zero,
                                             color_code, day_of_week,
                                             hour_of_day, is_known_line,
                                             line_color, or_placeholder,
                                             round_half_even, slot_of, spaced,
                                             title_words, truncate_int)
from dispatchboard.operators.keyed import first_by, latest_by, neighbours

# Stop rows arrive in the order of their increasing id (incremental pull), so
# the last write per station is the row with the greatest stop_id.
STOP_ORDER = "stop_id"


# PRJ-5 + PRJ-6
def station_records(stops: DataFrame) -> DataFrame:
    """Raw stop row -> (stop_id, station_id, station_name, station_order, line)."""
    return stops.select("stop_id", "station_id", "station_name",
                        F.col("station_order"), line_color().alias("line"))


# DED-2 keyed by station: the table the station stream keeps.
def station_table(stops: DataFrame) -> DataFrame:
    return latest_by(station_records(stops), "station_id", STOP_ORDER,
                     ["station_name", "station_order", "line"])


# DED-2 keyed by (line, station) with unknown lines dropped (PRJ-8): what each
# line of the board holds after replaying the station changelog.
def line_stations(stops: DataFrame) -> DataFrame:
    recs = station_records(stops).where(is_known_line("line"))
    return latest_by(recs, ["line", "station_id"], STOP_ORDER,
                     ["station_name", "station_order"])


# PRJ-7
def stops_on_line(stops: DataFrame, line: str) -> DataFrame:
    if line not in LINE_FLAGS:
        raise ValueError(f"unknown line flag {line!r}")
    return stops.where(F.col(line))


# DED-3 + WIN-2 + SRT-3
def line_topology(stops: DataFrame) -> DataFrame:
    """Previous and next station along each line.

    Stops of a line are those with its flag set. Within a line each station
    name counts once, at its first stop in (order, stop_id); that stop gives
    the name its station id. Neighbours along (order, stop_id) come from
    ``neighbours``, which cuts each line into range slices, so a line of any
    length is spread over many tasks.
    """
    flags = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in LINE_FLAGS]))
    per_line = stops.select("stop_id", "station_id", "station_name", "station_order",
                            F.explode(flags).alias("line"))
    firsts = first_by(per_line, ["line", "station_name"],
                      ["station_order", "stop_id"],
                      ["station_id", "station_order", "stop_id"])
    linked = neighbours(firsts, ["line"], ["station_order", "stop_id"], "station_id",
                        "prev_station_id", "next_station_id")
    return linked.select("line", "station_name", "station_id", "station_order",
                         "prev_station_id", "next_station_id")


# AGG-2: stream reading, every entry event counts.
def entries_per_station(turnstile: DataFrame) -> DataFrame:
    return turnstile.groupBy("station_id").agg(F.count(F.lit(1)).alias("entries"))


# AGG-3: table reading, latest row per message key first, then count.
def entries_per_station_table(turnstile: DataFrame, key: str = "key",
                              order=("offset",)) -> DataFrame:
    latest = latest_by(turnstile, key, list(order), ["station_id"])
    return latest.groupBy("station_id").agg(F.count(F.lit(1)).alias("entries"))


# SNK-4 value shape of the summary topic
def summary_json(entries: DataFrame) -> DataFrame:
    return entries.select(
        "station_id",
        F.to_json(F.struct(F.col("station_id"), F.col("entries").alias("count")))
        .alias("value"))


# STR-6 step 1: each arrival becomes a clear event (seq 0) for the slot it
# left and a set event (seq 1) for the slot it entered, in one pass.
def slot_pair() -> Column:
    """The one or two slot events of an arrival's columns, as an array."""
    left_slot = F.when(
        F.col("prev_station_id").isNotNull() & F.col("prev_direction").isNotNull(),
        F.struct(F.col("line"), F.col("prev_station_id").alias("station_id"),
                 slot_of("prev_direction").alias("slot"), F.lit(0).alias("seq"),
                 F.lit(None).cast("string").alias("train_id"),
                 F.lit(None).cast("string").alias("status")))
    entered = F.struct(F.col("line"), F.col("station_id"),
                       slot_of("direction").alias("slot"), F.lit(1).alias("seq"),
                       F.col("train_id"), spaced("train_status").alias("status"))
    return F.array_compact(F.array(left_slot, entered))


def slot_events(arrivals: DataFrame, time_col: str = "timestamp",
                offset_col: str = "offset") -> DataFrame:
    return arrivals.select(
        F.col(time_col).alias("event_time"), F.col(offset_col).alias("event_offset"),
        F.inline(slot_pair()))


# STR-6: which train stands in slot a and slot b of each known station.
def slot_occupancy(arrivals: DataFrame, stations: DataFrame,
                   time_col: str = "timestamp", offset_col: str = "offset") -> DataFrame:
    """Departure clears its slot whatever train is in it; arrival sets its
    slot; events apply in (time, offset, clear-before-set) order. An event
    half that names an unknown (line, station) is ignored.

    One hash aggregate per (line, station): ``max_by`` with the ordering
    masked to one slot picks each slot's last event, and the partial
    aggregate keeps the shuffle to one row per key and map task. The known
    stations are joined after it: the join keys are the group keys, so the
    result is the same, and the join sees one row per station on each side
    however large either input is.
    """
    ev = slot_events(arrivals, time_col, offset_col)
    order = F.struct("event_time", "event_offset", "seq")
    who = F.struct("train_id", "status")
    last_in = {s: F.max_by(who, F.when(F.col("slot") == s, order)) for s in ("a", "b")}
    slots = (ev.groupBy("line", "station_id")
             .agg(last_in["a"].alias("_a"), last_in["b"].alias("_b")))
    known = stations.select("line", "station_id").distinct()
    return (slots.join(known, ["line", "station_id"])
            .select("line", "station_id",
                    F.col("_a.train_id").alias("dir_a"),
                    F.col("_a.status").alias("dir_a_status"),
                    F.col("_b.train_id").alias("dir_b"),
                    F.col("_b.status").alias("dir_b_status")))


# JOI-2: arrivals whose (line, station) is known to the board (a semi join:
# each arrival at most once, however the station list is keyed).
def arrivals_at_known_stations(arrivals: DataFrame, stations: DataFrame) -> DataFrame:
    known = stations.select("line", "station_id")
    return arrivals.join(known, ["line", "station_id"], "left_semi")


# JOI-2 with both sides live: arrivals against the station changelog.
def arrivals_at_live_stations(arrivals: DataFrame, changes: DataFrame, wait: str = "1 hour",
                              delay: str = "1 hour", time_col: str = "timestamp") -> DataFrame:
    """Arrivals at a (line, station) that a station record names, each once, as
    soon as both are there: a stream-stream semi join in append mode. A record
    makes its station known from ``wait`` before its own time on, for good, so
    an arrival read before its station is not lost.

    State: one record per (line, station) of a known line, the first one read,
    which the size of the network bounds; and the arrivals without a station
    so far, which go once the watermark is ``wait`` past them. Both feeds have
    a watermark of ``delay`` and Spark follows the slower one, so a station feed
    that is silent holds such arrivals back (and refuses none). Arrivals and
    records no later than the watermark are refused; a null line, station or
    time matches nothing."""
    def marked(df: DataFrame, col: str) -> DataFrame:
        return df.withWatermark(col, delay) if df.isStreaming else df
    known = marked(changes.where(is_known_line("line")).select(
        F.col("line").alias("_line"), F.col("station_id").alias("_station"),
        F.col("timestamp").alias("_known")), "_known").dropDuplicates(["_line", "_station"])
    return marked(arrivals, time_col).join(
        known, (F.col("line") == F.col("_line")) & (F.col("station_id") == F.col("_station"))
        & (F.col("_known") <= F.col(time_col) + F.expr(f"INTERVAL {wait}")), "left_semi")


# JOI-3: each station's total lands on every line that has the station.
def entries_on_lines(stations: DataFrame, entries: DataFrame) -> DataFrame:
    return (stations.join(entries, "station_id", "left")
            .select("line", "station_id", "station_name", "station_order",
                    F.coalesce(F.col("entries"), F.lit(0).cast("bigint")).alias("entries")))


# STR-7: latest weather reading, defaults before the first one.
def current_weather(weather: DataFrame, time_col: str = "timestamp",
                    offset_col: str = "offset") -> DataFrame:
    """Exactly one row: a global aggregate (partial per task, one row each to
    the final step), so the result's size is fixed whatever the input."""
    last = F.max_by(F.struct("temperature", "status"),
                    F.struct(F.col(time_col), F.col(offset_col)))
    return (weather.agg(last.alias("w"))
            .select(F.coalesce(F.col("w.temperature").cast("double"),
                               F.lit(DEFAULT_TEMPERATURE)).alias("temperature_raw"),
                    F.coalesce(F.col("w.status"),
                               F.lit(DEFAULT_WEATHER_STATUS)).alias("status_raw"))
            .select(truncate_int("temperature_raw").alias("temperature"),
                    title_words("status_raw").alias("weather")))


# JOI-4 + PRJ-10 + PRJ-14 + SRT-2
def status_board(stations: DataFrame, slots: DataFrame, entries: DataFrame,
                 weather: DataFrame, sort: bool = True) -> DataFrame:
    """One row per (line, station): both slots, entries, current weather.

    ``weather`` must be the one-row frame of ``current_weather``; it enters
    as one scalar subquery (computed once, then a constant of the plan), so
    no join against it is needed.
    """
    now = weather.select(F.struct("temperature", "weather").alias("w")).scalar()
    board = (stations.join(slots, ["line", "station_id"], "left")
             .join(entries, "station_id", "left")
             .select("line", color_code("line").alias("color_code"),
                     "station_id", "station_name", "station_order",
                     or_placeholder("dir_a").alias("dir_a"), "dir_a_status",
                     or_placeholder("dir_b").alias("dir_b"), "dir_b_status",
                     F.coalesce(F.col("entries"), F.lit(0).cast("bigint")).alias("entries"),
                     now.getField("temperature").alias("temperature"),
                     now.getField("weather").alias("weather")))
    if sort:
        board = board.orderBy(board_line_rank("line"), "station_order", "station_id")
    return board


# JOI-5 + PRJ-18 + PRJ-19: expected turnstile entries per station and step.
def expected_entries(steps: DataFrame, seed: DataFrame, curve: DataFrame,
                     step_seconds: int = 300, day_type: str = "reference",
                     time_col: str = "step_time") -> DataFrame:
    """floor(round_half_even(rides(day)) * ratio(hour) / step_seconds), at
    least 0, per (station, step). ``reference`` uses weekday rides on every
    day (the reference's day test is always true); ``calendar`` uses
    Saturday and Sunday rides on those days. The random term is not modelled.
    """
    if day_type == "reference":
        rides = F.col("avg_weekday_rides")
    elif day_type == "calendar":
        dow = day_of_week(time_col)
        rides = (F.when(dow <= 4, F.col("avg_weekday_rides"))
                 .when(dow == 5, F.col("avg_saturday_rides"))
                 .otherwise(F.col("avg_sunday-holiday_rides")))
    else:
        raise ValueError(f"unknown day_type {day_type!r}")
    seed_cols = seed.select("station_id", "avg_weekday_rides", "avg_saturday_rides",
                            "avg_sunday-holiday_rides")
    curve_cols = curve.select(F.col("hour").alias("_hour"), "ridership_ratio")
    joined = (steps.join(seed_cols, "station_id")
              .join(curve_cols, hour_of_day(time_col) == F.col("_hour")))
    riders = round_half_even(rides) * F.col("ridership_ratio") / F.lit(float(step_seconds))
    return joined.select(
        *[c for c in steps.columns],
        clamp_at_zero(F.floor(riders)).alias("expected_entries"))


# SET-1: one frame over several topic feeds (topic-log shape).
def merge_topics(*feeds: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


# PRJ-9: which handler a message goes to, by topic name. ``names`` are the
# deployment's own topics where they differ from the defaults.
DEFAULT_TOPICS = {"weather": TOPIC_WEATHER, "station": TOPIC_STATIONS_TABLE,
                  "arrival": TOPIC_ARRIVALS, "summary": TOPIC_SUMMARY}


def route_by_topic(df: DataFrame, topic_col: str = "topic",
                   names: Mapping[str, str] | None = None) -> DataFrame:
    t, own = F.col(topic_col), {**DEFAULT_TOPICS, **(names or {})}
    route = F.lit(None).cast("string")
    for handler, name in own.items():
        route = F.when(t == name, F.lit(handler)).otherwise(route)
    rest = F.when(t.contains(STATION_TOPIC_STEM), F.lit("unhandled")).otherwise(F.lit("ignored"))
    return df.withColumn("route", F.coalesce(route, rest))
