"""The board by changed rows, folded changes, checks on a stream, quarantine
reasons and replay, pulls in pieces."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from dispatchboard.functions import scalars as S
from dispatchboard.operators.transit import DEFAULT_TOPICS
from dispatchboard.schemas import CALL, STOPS
from dispatchboard.session import scratch_path
from dispatchboard.sinks.tables import check_stations
from dispatchboard.sources import incremental as I
from dispatchboard.sources.topics import read_topic, read_topic_list
from dispatchboard.streaming import board_changes as B
from dispatchboard.streaming import runner
from dispatchboard.streaming.checks import start_checked_load
from dispatchboard.streaming.quarantine import replay, with_reasons

DAY = dt.datetime(2024, 1, 1)
LOG = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


class Board:
    """Feeds in a folder; every ``step`` adds messages and starts the same query."""

    def __init__(self, spark, fold=50):
        self.spark, self.fold, self.offset = spark, fold, 0
        self.loc, self.out = scratch_path(spark, "feeds"), scratch_path(spark, "changes")
        for feed in DEFAULT_TOPICS.values():  # the pattern of folders must exist
            spark.createDataFrame([], LOG).write.parquet(f"{self.loc}/{feed}")

    def feeds(self):
        return read_topic_list(self.spark, self.loc, list(DEFAULT_TOPICS.values()))

    def step(self, *messages):
        for feed, body in messages:
            self.offset += 1
            value = body if isinstance(body, str) else json.dumps(body)
            row = (None, bytearray(value.encode()), DEFAULT_TOPICS[feed], 0, self.offset,
                   DAY + dt.timedelta(minutes=self.offset))
            (self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append")
             .parquet(f"{self.loc}/{DEFAULT_TOPICS[feed]}"))
        result = B.start_board_changes(self.feeds(), self.out, fold=self.fold, trigger="availableNow").wait()
        done = [p for p in result.query.recentProgress if p.numInputRows]
        return self.part(done[-1].batchId) if done else []

    def part(self, batch):
        rows = self.spark.read.parquet(f"{self.out}/parts/batch={batch:020d}").collect()
        return sorted((r["line"], r["station_id"], r["dir_a"], r["dir_b"], r["entries"]) if r["line"]
                      else ("weather", r["status"]) for r in rows)

    def board(self):
        return {(r["line"], r["station_id"]): (r["station_name"], r["dir_a"], r["dir_b"], r["entries"],
                                               r["temperature"], r["weather"])
                for r in B.read_board_changes(self.spark, self.out).collect()}


def station(line, i, name="s"):
    return "station", {"station_id": i, "station_name": name, "order": i, "line": line}


def arrival(line, i, train, direction, prev=None):
    return "arrival", {"station_id": i, "train_id": train, "direction": direction, "line": line, "train_status": "ok",
                       "prev_station_id": prev, "prev_direction": prev and direction}


def test_a_trigger_emits_only_the_rows_it_touched(spark):
    b = Board(spark, fold=2)
    none = S.or_placeholder(F.lit(None).cast("string"))
    none = spark.range(1).select(none).first()[0]
    rows = b.step(station("red", 1), station("blue", 1), station("red", 2), station("unknown", 3))
    assert [r[:2] for r in rows] == [("blue", 1), ("red", 1), ("red", 2)]
    assert b.step(arrival("red", 2, "T", "a", prev=1)) == [("red", 1, none, none, 0), ("red", 2, "T", none, 0)]
    # A count reaches every line that has the station, and no other row.
    assert b.step(("summary", {"station_id": 1, "count": 7})) == [
        ("blue", 1, none, none, 7), ("red", 1, none, none, 7)]
    # A reading is one row, whatever the board's size.
    assert b.step(("weather", {"temperature": 70.9, "status": "light_rain"})) == [("weather", "light_rain")]
    # Broken messages touch nothing; unknown stations are kept but not shown.
    assert b.step(("summary", "{"), ("arrival", "[]"), ("weather", "{}"), arrival("red", 9, "U", "b")) == []
    assert B.malformed(spark.read.schema(LOG).option("recursiveFileLookup", "true").parquet(b.loc)).count() == 3
    assert b.step(station("red", 9, "late")) == [("red", 9, none, "U", 0)]
    assert {k: v[:4] for k, v in b.board().items()} == {
        ("red", 1): ("s", none, none, 7), ("blue", 1): ("s", none, none, 7), ("red", 2): ("s", "T", none, 0),
        ("red", 9): ("late", none, "U", 0)}
    assert {v[4:] for v in b.board().values()} == {(70, "Light Rain")}


def test_parts_are_folded_and_the_fold_is_safe_to_replay(spark):
    b = Board(spark, fold=2)
    for i in range(6):
        b.step(station("red", 1, f"n{i}"), station("red", 10 + i))
    left = sorted(int(n.split("=")[1]) for n in os.listdir(f"{b.out}/parts".replace("file:", "")) if "=" in n)
    assert len(left) <= 4 and left[-1] >= 5
    want = b.board()
    assert len(want) == 7 and want["red", 1][0] == "n5"
    runner.fold_changes(spark, b.out, B.KEYS, 5, 2)
    assert b.board() == want


def test_stream_checks_list_what_the_table_check_counts(spark):
    long = "x" * 71
    rows = [(1, "E", "a", "s", "d", 1, 1, True, False, False), (2, "EE", long, "s", "d", 1, 1, True, False, False),
            (1, "E", "again", "s", "d", 1, 1, True, False, False), (None, "E", "n", "s", "d", 1, 1, True, False, None),
            (None, "E", "n", "s", "d", 1, 1, True, False, False), (3, None, "c", "s", None, 1, 1, True, False, False),
            (1, "E", "third", "s", "d", 1, 1, True, False, False), (4, "W", "ok", "s", "d", 1, 1, True, False, False)]
    src, out, ddl = scratch_path(spark, "stops"), scratch_path(spark, "checked"), "offset long, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in STOPS.fields)
    for cut in (rows[:2], rows[2:5], rows[5:]):  # a start each, keys of earlier ones known
        first = rows.index(cut[0])
        (spark.createDataFrame([(first + i, *r) for i, r in enumerate(cut)], ddl).coalesce(1)
         .write.mode("append").parquet(src))
        load = start_checked_load(spark.readStream.schema(ddl).parquet(src), out, "availableNow").wait()
    table = spark.read.schema(ddl).parquet(src)
    refused = load.refused(spark)
    listed = {(r["check"], r["offset"]) for r in refused.collect()}
    assert {o for c, o in listed if c == "unique_stop_id"} == {2, 6}
    want = {r["check"]: r["violations"] for r in check_stations(table).collect() if r["violations"]}
    got = {r["check"]: r["n"] for r in refused.groupBy("check").agg(F.count(F.lit(1)).alias("n")).collect()}
    # The table counts repeated keys, the stream lists the rows that repeat them.
    got["unique_stop_id"] = refused.where("check = 'unique_stop_id'").select("stop_id").distinct().count()
    assert got == want
    assert sorted(r["offset"] for r in load.read(spark).collect()) == [0, 7]
    assert load.read(spark).columns == table.columns


def test_reasons(spark):
    bodies = [None, "", " ", "<{}", "[1]", "5", "{}", '{"crime_id": null}', '{"crime_id": 5}',
              '{"crime_id": "a", "call_date_time": true, "city": "c"}', '{"crime_id": "a", "crime_id": "b"}',
              '{"crime_id": "a", "call_date_time": "2024-01-01T00:00:00.000Z"}']
    df = spark.createDataFrame([(i, b, "x") for i, b in enumerate(bodies)], "id int, value string, field string")
    got = sorted((r["id"], r["problem"]) for r in with_reasons(
        df.drop("field"), CALL, required=["crime_id"]).collect())
    assert got == [(0, "empty"), (1, "empty"), (2, "empty"), (3, "not JSON"), (4, "not an object"),
                   (5, "not an object"), (6, "missing"), (7, "missing"), (9, "wrong type"), (10, "not JSON")]
    assert with_reasons(df.drop("field").limit(0), CALL).collect() == []


def test_replay_adds_its_messages_once(spark):
    loc = scratch_path(spark, "replay")
    bad = spark.createDataFrame([(None, bytearray(v), t, 0, i, DAY, "r") for i, (t, v) in enumerate(
        [("t1", b'"a": 1}'), ("t1", b""), ("t2", b'"a": 2}')])], LOG + ", route string")
    text = F.col("value").cast("string")
    mend = F.when(text != "", F.concat(F.lit("{"), text))
    for _ in range(2):
        replay(spark, bad, mend, loc, 0)
    seen = [r for t in ("t1", "t2") for r in read_topic(spark, loc, t, stream=False).collect()]
    assert sorted((r["topic"], r["offset"], bytes(r["value"])) for r in seen) == [
        ("t1", 0, b'{"a": 1}'), ("t2", 2, b'{"a": 2}')]


@pytest.mark.parametrize("pieces", [1, 4, 8])
def test_pieces_are_disjoint_complete_and_even_on_a_skewed_column(spark, pieces):
    # Nine tenths of the values lie in a hundredth of the range.
    i = F.col("id")
    df = spark.range(40_000, numPartitions=4).select(
        F.when(i < 36_000, i).otherwise(i * 1000).alias("n"), F.lit("x").alias("pieces"))
    got = I.pull_in_pieces(df, "n", pieces, last_seen=100)
    assert got.select("n").distinct().count() == got.count() == 40_000 - 101
    sizes = [r["count"] for r in got.groupBy("piece").count().collect()]
    assert len(sizes) == pieces and max(sizes) <= 1.5 * min(sizes)


def test_pieces_of_ties_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None,), (1,), (1,), (1,), (1,), (2,)], "n int")
    assert I.pull_in_pieces(df, "n", 4).count() == 6
    assert I.pull_in_pieces(df.limit(0), "n", 4).collect() == []
    assert I.split_points(df.limit(0), "n", 4) == []
    assert I.piece_sql("n", [1, 5]) == ["n <= 1 OR n IS NULL", "n > 1 AND n <= 5", "n > 5"]
    assert I.piece_sql("at", [dt.date(2024, 1, 1)])[1] == "at > '2024-01-01'"


def test_poll_command_publishes_what_is_new_once(spark):
    from dispatchboard.streaming import apps
    table, store, logs = (scratch_path(spark, n) for n in ("polled", "marks", "poll-logs"))
    args = ["poll", "--table", table, "--column", "n", "--store", store, "--logs", logs, "--topic", "raw"]
    for rows in ([(1,), (2,)], [], [(5,)]):
        spark.createDataFrame(rows, "n int").write.mode("append").parquet(table)
        apps.main(args)
    assert sorted(r["offset"] for r in read_topic(spark, logs, "raw", stream=False).collect()) == [1, 2, 5]


def test_a_poll_that_crashed_is_repeated_with_its_own_rows(spark):
    """Published but not marked: the next poll must not take rows that came
    since for published ones."""
    store, logs = scratch_path(spark, "marks"), scratch_path(spark, "poll-logs")

    def poll(rows):
        df = spark.createDataFrame([(n,) for n in rows], "n int")
        return df, I.poll_and_publish(df, "n", store, "raw", logs)
    poll([1, 2])
    more = spark.createDataFrame([(1,), (2,), (5,)], "n int")
    with pytest.raises(RuntimeError):
        def use(new, last):
            from dispatchboard.sinks.topics import publish
            publish(new, ["n"], ["n"], "raw", logs, offset_col="n", batch=int(last) + 1)
            raise RuntimeError("lost")
        I.poll(more, "n", store, "raw", use)
    assert poll([1, 2, 5, 8])[1] == 5
    assert poll([1, 2, 5, 8])[1] == 8
    assert poll([1, 2, 5, 8])[1] == 8
    assert sorted(r["offset"] for r in read_topic(spark, logs, "raw", stream=False).collect()) == [1, 2, 5, 8]
