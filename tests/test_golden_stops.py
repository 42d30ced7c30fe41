"""Station counts worked out by hand on a small stop table; with
``STATIONS_CSV`` naming a copy of the published CSV (FIXTURES.md), its known
counts too."""

import os

import pytest
from pyspark.sql import functions as F

from dispatchboard.operators import transit as T
from dispatchboard.schemas import STOPS
from dispatchboard.sources.files import read_stations

# stop, direction, stop name, station, descriptive name, station id, order, red, blue, green
ROWS = [
    (1, "N", "Oak (N)", "Oak", "Oak (Red)", 10, 1, True, False, False),
    (2, "S", "Oak (S)", "Oak", "Oak (Red)", 10, 1, True, False, False),
    (3, "E", "Elm (E)", "Elm", "Elm (Red & Blue)", 20, 2, True, False, False),
    (4, "W", "Elm (W)", "Elm", "Elm (Red & Blue)", 20, 5, False, True, False),
    (5, "E", "Ash", "Ash", "Ash (Blue)", 30, 6, False, True, False),
    (6, "W", "Ash", "Ash", "Ash (Blue)", 31, 7, False, True, False),
    (7, "N", "Fir", "Fir", "Fir", 40, None, False, False, False),
    (8, "N", "Bay", "Bay", "Bay (Green)", 50, 3, False, False, True),
]
CSV = os.environ.get("STATIONS_CSV", "")
published = pytest.mark.skipif(not (CSV and os.path.exists(CSV)), reason="STATIONS_CSV not set")


@pytest.fixture()
def stops(spark):
    return spark.createDataFrame(ROWS, STOPS).withColumnRenamed("order", "station_order")


def _by_line(df):
    return {r.line: r["count"] for r in df.groupBy("line").count().collect()}


def test_station_table(stops):
    st = T.station_table(stops)
    assert _by_line(st) == {"red": 1, "blue": 3, "green": 1, "unknown": 1}
    assert {r.station_id: r.line for r in st.collect()}[20] == "blue"  # the last write


def test_line_stations(stops):
    assert _by_line(T.line_stations(stops)) == {"red": 2, "blue": 3, "green": 1}


def test_topology(stops):
    got = {(r.line, r.station_name): (r.prev_station_id, r.station_id, r.next_station_id)
           for r in T.line_topology(stops).collect()}
    assert got == {("red", "Oak"): (None, 10, 20), ("red", "Elm"): (10, 20, None),
                   ("blue", "Elm"): (None, 20, 30), ("blue", "Ash"): (20, 30, None),
                   ("green", "Bay"): (None, 50, None)}


@published
def test_published_stops(spark):
    s = read_stations(spark, CSV)
    assert s.count() == s.select("stop_id").distinct().count() == 230
    assert s.select("station_id").distinct().count() == 111
    st = T.station_table(s)
    assert _by_line(st) == {"blue": 33, "red": 31, "green": 26, "unknown": 21}
    lines = {r.station_id: r.line for r in st.where(
        F.col("station_id").isin(41320, 41220, 41400, 40380)).collect()}
    assert lines == {41320: "unknown", 41220: "unknown", 41400: "red", 40380: "blue"}
    assert _by_line(T.line_stations(s)) == {"red": 33, "blue": 33, "green": 28}
    assert _by_line(T.line_topology(s)) == {"red": 34, "blue": 32, "green": 28}
