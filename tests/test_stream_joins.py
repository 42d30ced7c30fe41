"""Arrivals joined with the live station changelog."""

import datetime as dt

from dispatchboard.operators import transit as T
from dispatchboard.session import scratch_path
from dispatchboard.streaming import runner

DAY = dt.datetime(2024, 1, 1)
ARRIVALS = "line string, station_id int, train_id string, timestamp timestamp"
CHANGES = "line string, station_id int, timestamp timestamp"


def _at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


def _put(spark, path, rows, ddl):
    (spark.createDataFrame([(*r[:-1], _at(r[-1])) for r in rows], ddl).coalesce(1)
     .write.mode("append").parquet(path))


class Feeds:
    """Both feeds as folders; every ``step`` is a start of the same query."""

    def __init__(self, spark):
        self.spark, self.out = spark, scratch_path(spark, "live-out")
        self.a, self.s = scratch_path(spark, "live-arrivals"), scratch_path(spark, "live-stations")

    def step(self, arrivals=(), changes=()):
        for path, rows, ddl in ((self.a, arrivals, ARRIVALS), (self.s, changes, CHANGES)):
            if rows:
                _put(self.spark, path, rows, ddl)
        read = [self.spark.readStream.schema(ddl).parquet(path) for path, ddl in ((self.a, ARRIVALS), (self.s, CHANGES))]
        result = runner.start(T.arrivals_at_live_stations(*read, wait="1 hour", delay="10 minutes"), "live",
                              "append", path=self.out).wait()
        held = [op["numRowsTotal"] for p in result.query.recentProgress[-1:] for op in p["stateOperators"]]
        seen = sorted(r["train_id"] for r in result.read(self.spark).collect())
        return seen, held


def test_an_arrival_before_its_station_is_met_once(spark):
    feeds = Feeds(spark)
    assert feeds.step([("red", 1, "early", 0), ("red", 2, "other", 0), ("gray", 1, "line", 0), (None, 1, "null", 0)],
                      [("blue", 9, 0)])[0] == []
    # Known from an hour before its record, and repeated records change nothing.
    assert feeds.step([], [("red", 1, 50), ("red", 1, 55), ("gray", 1, 50)])[0] == ["early"]
    assert feeds.step([("red", 1, "next", 60), ("red", 1, "next", 60)], [("red", 1, 65)])[0] == ["early", "next", "next"]


def test_a_record_too_long_after_an_arrival_does_not_make_it_known(spark):
    feeds = Feeds(spark)
    feeds.step([("red", 1, "too early", 0), ("red", 1, "in time", 31)], [("blue", 9, 0)])
    assert feeds.step([], [("red", 1, 90)])[0] == ["in time"]


def test_arrivals_without_a_station_leave_the_state(spark):
    feeds = Feeds(spark)
    _, held = feeds.step([("red", k, "x", 0) for k in range(20)], [("blue", 9, 0)])
    assert max(held) >= 20
    # Both feeds go on two hours: the unmatched are given up, the stations stay.
    seen, held = feeds.step([("blue", 9, "later", 120)], [("red", 99, 120)])
    assert seen == ["later"] and max(held) <= 3
    # A silent station feed holds the watermark back.
    _, held = feeds.step([("red", k, "y", 600) for k in range(20)])
    assert max(held) >= 20


def test_table_form_is_the_same(spark):
    a = spark.createDataFrame([("red", 1, "a", _at(0)), ("red", 2, "b", _at(0))], ARRIVALS)
    s = spark.createDataFrame([("red", 1, _at(60)), ("red", 2, _at(61))], CHANGES)
    assert [r["train_id"] for r in T.arrivals_at_live_stations(a, s).collect()] == ["a"]
