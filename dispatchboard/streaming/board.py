"""The live status board as one streaming query (STR-6, STR-7, JOI-3, JOI-4).

The board subscribes to its four feeds (weather, station changelog,
arrivals, turnstile summary). Each micro-batch is routed by topic (PRJ-9),
decoded, and folded into four keyed tables (SNK-3): stations per (line,
station), the last event per train slot, the last count per station, and
the last weather reading. Then the board is rendered from those tables as a
batch plan and stored as a new version. Chained aggregations are not allowed
inside one streaming plan; ``foreachBatch`` over keyed tables is how the
state is carried instead, and the tables survive restarts next to the
query's checkpoint.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.functions.scalars import is_known_line
from dispatchboard.operators import transit as T
from dispatchboard.schemas import ARRIVAL, STATION, TURNSTILE_SUMMARY, WEATHER
from dispatchboard.sinks import versions
from dispatchboard.sinks.tables import KeyedTable
from dispatchboard.streaming.quarantine import split_malformed


# Feed -> (schema, fields without which a message can't be used).
FEEDS = {"station": (STATION, ("station_id", "line")),
         "arrival": (ARRIVAL, ("line", "station_id", "train_id")),
         "summary": (TURNSTILE_SUMMARY, ("station_id", "count")),
         "weather": (WEATHER, ("temperature", "status"))}


class BoardState:
    def __init__(self, spark: SparkSession, path: str, topics: Mapping[str, str] | None = None):
        """``topics`` names the deployment's feeds where they differ from
        ``transit.DEFAULT_TOPICS``."""
        self.spark, self.path, self.topics = spark, path.rstrip("/"), topics
        self.stations = KeyedTable(spark, f"{path}/stations", ["line", "station_id"], ["offset"])
        self.slots = KeyedTable(spark, f"{path}/slots", ["line", "station_id", "slot"],
                                ["event_time", "event_offset", "seq"])
        self.counts = KeyedTable(spark, f"{path}/counts", ["station_id"], ["offset"])
        self.weather = KeyedTable(spark, f"{path}/weather", ["_k"], ["timestamp", "offset"])

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        routed = T.route_by_topic(batch, names=self.topics).persist()
        try:
            # Which feeds this batch carries (at most one row per route).
            present = [r["route"] for r in routed.select("route").distinct().collect()
                       if r["route"] in FEEDS]
            good, bad = {}, []
            for route in present:
                schema, required = FEEDS[route]
                good[route], broken = split_malformed(
                    routed.where(F.col("route") == route), schema, required=required)
                bad.append(broken)
            if bad:
                # Undecodable messages change nothing on the board; they are
                # kept raw, a folder a batch.
                (reduce(DataFrame.unionByName, bad).write.mode("overwrite")
                 .parquet(f"{self.path}/quarantine/batch={batch_id:020d}"))
            if "station" in good:
                self._stations(good["station"], batch_id)
            if "arrival" in good:
                self.slots.upsert(T.slot_events(good["arrival"]), batch_id)
            if "summary" in good:
                cnt = good["summary"].select("station_id", F.col("count").alias("entries"), "offset")
                self.counts.upsert(cnt, batch_id)
            if "weather" in good:
                w = good["weather"].select(F.lit(0).alias("_k"), "temperature", "status", "timestamp",
                                           "offset")
                self.weather.upsert(w, batch_id)
        finally:
            routed.unpersist()
        versions.commit(self.render(), f"{self.path}/board", batch_id)

    def quarantined(self) -> DataFrame:
        """The undecodable messages so far, as topic-log rows with their route."""
        return (self.spark.read.option("recursiveFileLookup", "true")
                .parquet(f"{self.path}/quarantine"))

    def _stations(self, records: DataFrame, batch_id: int) -> None:
        st = (records.select("line", "station_id", "station_name",
                      F.col("order").alias("station_order"), "offset")
              .where(is_known_line("line")))
        self.stations.upsert(st, batch_id)

    def _table(self, t: KeyedTable, schema_ddl: str) -> DataFrame:
        df = t.read()
        return df if df is not None else self.spark.createDataFrame([], schema_ddl)

    def render(self) -> DataFrame:
        stations = self._table(self.stations, "line string, station_id int, "
                               "station_name string, station_order int, offset long")
        stations = stations.drop("offset")
        last = self._table(self.slots, "line string, station_id int, slot string, "
                           "event_time timestamp, event_offset long, seq int, "
                           "train_id string, status string")
        known = last.join(stations.select("line", "station_id"), ["line", "station_id"])
        pick = {s: F.max(F.when(F.col("slot") == s, F.struct("train_id", "status")))
                for s in ("a", "b")}
        slots = (known.groupBy("line", "station_id")
                 .agg(pick["a"].alias("_a"), pick["b"].alias("_b"))
                 .select("line", "station_id", F.col("_a.train_id").alias("dir_a"),
                         F.col("_a.status").alias("dir_a_status"),
                         F.col("_b.train_id").alias("dir_b"),
                         F.col("_b.status").alias("dir_b_status")))
        counts = self._table(self.counts, "station_id int, entries long, offset long")
        weather = self._table(self.weather, "_k int, temperature float, status string, "
                              "timestamp timestamp, offset long")
        return T.status_board(stations, slots, counts.select("station_id", "entries"),
                              T.current_weather(weather), sort=False)

    def read(self) -> DataFrame:
        return versions.read_latest(self.spark, f"{self.path}/board")
