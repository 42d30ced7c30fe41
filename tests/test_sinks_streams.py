"""Sinks and streaming helpers on small inputs."""

import os

import pytest
from pyspark.sql import functions as F

from dispatchboard.functions import scalars as S
from dispatchboard.schemas import CALL
from dispatchboard.session import scratch_path
from dispatchboard.sinks import tables as TB
from dispatchboard.sinks import topics as TP
from dispatchboard.sources import incremental as INC
from dispatchboard.sources.topics import read_topic, read_topics
from dispatchboard.streaming import runner


def test_trigger_kwargs():
    assert runner.trigger_kwargs("availableNow") == {"availableNow": True}
    assert runner.trigger_kwargs("once") == {"once": True}
    assert runner.trigger_kwargs("10 seconds") == {"processingTime": "10 seconds"}


def test_publish_if_absent_and_require(spark):
    loc = scratch_path(spark, "log-test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    with pytest.raises(RuntimeError):
        TP.require_topics(spark, loc, "t1")
    TP.publish(df, ["id"], ["id", "v"], "t1", loc, if_absent=True)
    TP.publish(df, ["id"], ["id", "v"], "t1", loc, if_absent=True)  # skipped
    TP.require_topics(spark, loc, "t1")
    log = TP.read_published(spark, loc, "t1")
    assert log.count() == 2
    assert {r.k for r in log.select(F.get_json_object(
        F.col("key").cast("string"), "$.id").alias("k")).collect()} == {"1", "2"}


def test_topic_stream_reads_every_file_once(spark):
    loc = scratch_path(spark, "log-test")
    df = spark.range(0, 40).select(F.col("id").cast("string").alias("crime_id"))
    for part in range(4):
        TP.publish(df.where(F.col("crime_id").cast("int") % 4 == part), None, ["crime_id"],
                   S.TOPIC_CALLS, loc)
    s = read_topic(spark, loc, S.TOPIC_CALLS, max_files_per_trigger=1)
    dec = s.select(S.decode_json("value", CALL).alias("d")).select("d.crime_id")
    out = runner.run(dec, "readback", "append")
    assert out.count() == 40
    # pattern subscription over the same log root
    assert read_topics(spark, loc, r"^police\..*", stream=False).count() == 40
    assert read_topics(spark, loc, r"^nothing$", stream=False).count() == 0


def test_console_sink_runs(spark):
    loc = scratch_path(spark, "log-test")
    TP.publish(spark.range(3), None, ["id"], "c", loc)
    q = TB.start_console(read_topic(spark, loc, "c").select("offset"), "console_test",
                         mode="append", trigger="1 second")
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None


def test_save_if_absent(spark):
    name = f"db_test_{os.getpid()}"
    TB.save_if_absent(spark.range(3), name)
    TB.save_if_absent(spark.range(10), name)  # exists: left alone
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_incremental_marks(spark):
    store = scratch_path(spark, "marks")
    df = spark.range(1, 11).withColumnRenamed("id", "k")
    assert INC.read_mark(spark, store, "s") is None
    got = []
    use = lambda new, last: got.append([r.k for r in new.collect()])
    INC.poll(df.where("k <= 6"), "k", store, "s", use)
    INC.poll(df, "k", store, "s", use)
    INC.poll(df.where("k > 100"), "k", store, "s", use)  # an empty table: no new mark
    assert got == [[1, 2, 3, 4, 5, 6], [7, 8, 9, 10], []]
    assert INC.read_mark(spark, store, "s") == 10


def test_poll_loses_nothing_that_arrives_meanwhile(spark):
    """Rows added between the use of a poll and its mark come with the next."""
    path, store, got = scratch_path(spark, "grow"), scratch_path(spark, "marks"), []
    add = lambda a, b: spark.range(a, b).write.mode("append").parquet(path)
    add(0, 5)

    def use(new, last):
        add(5, 8)  # arrives after the bound was fixed
        got.append(sorted(r.id for r in spark.read.parquet(path).where(
            new.select("id").schema["id"].name + " >= 0").join(new, "id", "left_semi").collect()))
    INC.poll(spark.read.parquet(path), "id", store, "s", use)
    INC.poll(spark.read.parquet(path), "id", store, "s",
             lambda new, last: got.append(sorted(r.id for r in new.collect())))
    assert got == [[0, 1, 2, 3, 4], [5, 6, 7]]


def test_marks_keep_their_type_and_broken_stores_fail(spark):
    store = scratch_path(spark, "marks")
    texts = spark.createDataFrame([("007",), ("006",)], "k string")
    INC.commit_mark(texts, "k", "007", store, "s")
    assert INC.read_mark(spark, store, "s") == "007"
    broken = scratch_path(spark, "marks")
    with open(f"{broken.replace('file:', '')}/part-0.parquet", "w") as fh:
        fh.write("junk")
    with pytest.raises(Exception):
        INC.read_mark(spark, broken, "s")


def test_polling_job_publishes_each_row_once(spark):
    loc, store = scratch_path(spark, "poll-log"), scratch_path(spark, "marks")
    df = spark.range(0, 20).withColumn("v", F.col("id") * 2)
    for n in (8, 20, 20):
        INC.poll_and_publish(df.where(F.col("id") < n), "id", store, "raw", loc)
    log = TP.read_published(spark, loc, "raw")
    assert sorted(r.offset for r in log.collect()) == list(range(20))


def test_check_stations_finds_violations(spark):
    rows = [(1, "E", "a", "s", "d", 1, 1, True, False, False),
            (1, "EW", "a", "s", "d", 1, 1, True, False, False),
            (2, None, "x" * 71, "s", "d", 1, 1, None, False, False)]
    ddl = ("stop_id int, direction_id string, stop_name string, station_name string, "
           "station_descriptive_name string, station_id int, station_order int, "
           "red boolean, blue boolean, green boolean")
    got = {r.check: r.violations for r in TB.check_stations(spark.createDataFrame(rows, ddl)).collect()}
    assert got["unique_stop_id"] == 1
    assert got["max_length_direction_id"] == 1
    assert got["not_null_direction_id"] == 1
    assert got["max_length_stop_name"] == 1
    assert got["not_null_red"] == 1
    assert got["not_null_stop_id"] == 0


def test_ridership_seed_csv(spark):
    """SRC-5: seed CSV with a header, a hyphenated column and a date text."""
    from dispatchboard.sources.files import read_ridership_seed
    path = scratch_path(spark, "seed-test")
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/seed.csv", "w") as fh:
        fh.write("station_id,stationame,month_beginning,avg_weekday_rides,"
                 "avg_saturday_rides,avg_sunday-holiday_rides,monthtotal\n"
                 "40010,Austin-Forest Park,10/01/2018,1000.5,500.0,250.0,27000\n")
    r = read_ridership_seed(spark, path).first()
    assert (r.station_id, r.month_beginning, r["avg_sunday-holiday_rides"]) == \
        (40010, "10/01/2018", 250.0)


def test_publish_summary_json(spark):
    """SNK-4: per-station counts out as JSON keyed by station."""
    loc = scratch_path(spark, "log-summary")
    entries = spark.createDataFrame([(2, 5), (4, 1)], "station_id int, entries long")
    TP.publish_summary(entries, S.TOPIC_SUMMARY, loc)
    got = {(r.k, r.v) for r in TP.read_published(spark, loc, S.TOPIC_SUMMARY).select(
        F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v"))
        .collect()}
    assert got == {('{"station_id":2}', '{"station_id":2,"count":5}'),
                   ('{"station_id":4}', '{"station_id":4,"count":1}')}


def test_epoch_ms_round_trip(spark):
    """PRJ-17 and its inverse: a whole-ms time survives the key and back."""
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 5, 0, 123000),)], "ts timestamp")
    r = df.select(S.from_epoch_ms(S.epoch_ms_key("ts")).alias("back"), "ts").first()
    assert r.back == r.ts


def test_upsert_latest_replay(spark):
    """SNK-3: a replayed batch leaves the same contents."""
    t = TB.KeyedTable(spark, scratch_path(spark, "keyed-test"), ["k"], ["o"])
    b0 = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, o int, v string")
    b1 = spark.createDataFrame([(1, 2, "c"), (1, 0, "z")], "k int, o int, v string")
    t.upsert(b0, 0)
    t.upsert(b1, 1)
    t.upsert(b1, 1)  # replay
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "c"), (2, "b")]


@pytest.mark.parametrize("shared", [False, True])
def test_calls_app_command_line(spark, shared):
    """The calls application, as launched from the command line, writes both
    results (two named queries, or one shared stateful query); they equal
    the batch flagship."""
    from dispatchboard.operators import calls as C
    from dispatchboard.plans import fixtures as X
    from dispatchboard.plans.streams import publish_calls
    from dispatchboard.sources.files import write_json_arrays
    from dispatchboard.streaming import apps
    from tests.conftest import SF_SMALL
    loc, codes, out = (scratch_path(spark, n) for n in ("log-app", "codes-app", "out-app"))
    publish_calls(spark, SF_SMALL, loc)
    write_json_arrays(X.codes(spark, SF_SMALL), codes)
    apps.main(["calls", "--source", loc, "--codes", codes, "--out", out,
               "--trigger", "availableNow", "--max-files-per-trigger", "1"]
              + (["--shared"] if shared else []))
    want = C.with_disposition(C.call_counts(X.calls(spark, SF_SMALL), sort=False),
                              X.codes(spark, SF_SMALL))
    for name, expected in (("crime_type_count", want.drop("description")),
                           ("crime_type_count_described", want)):
        res = runner.StreamResult(None, f"{out}/{name}", "complete").read(spark)
        cols = sorted(expected.columns)
        assert (sorted(res.select(cols).collect(), key=repr)
                == sorted(expected.select(cols).collect(), key=repr))


def test_versions_keep_newest_committed(spark):
    """Readers take the newest committed version; older ones stay as long as
    a reader may be on them; a folder without the writer's marker (a rewrite
    in progress) is ignored."""
    from dispatchboard.sinks import versions as V
    path = scratch_path(spark, "versions-test")
    for b in range(4):
        V.commit(spark.range(b + 1), path, b)
    assert V.committed(spark, path) == [0, 1, 2, 3]
    V.commit(spark.range(4), path, 3, retain=0)
    assert V.committed(spark, path) == [2, 3]
    assert V.read_latest(spark, path).count() == 4
    assert V.read_latest(spark, path, below=3).count() == 3
    os.makedirs(V.version_path(path, 9))  # started, never finished
    assert V.latest(spark, path) == 3
    V.commit(spark.range(4), path, 3)  # replay of batch 3
    assert V.committed(spark, path) == [2, 3]


def test_bounded_counts_drop_late_calls(spark):
    """Bounded flagship: a call older than the watermark is dropped; windows
    are emitted once they close. Spark filters late rows against the
    watermark of the batch before (eviction uses the current one), so the
    late call comes two triggers after the call that set the watermark."""
    import datetime as dt
    from dispatchboard.operators import calls as C
    src = scratch_path(spark, "bounded-test")
    ddl = "call_date_time timestamp, original_crime_type_name string, disposition string"
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    files = [[(t(12, 0), "theft", "A")], [(t(12, 30), "theft", "A")],
             [(t(10, 0), "theft", "A"), (t(14, 5), "theft", "A")]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{src}/f{i}")
    stream = (spark.readStream.schema(ddl).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", 1).parquet(src))
    out = runner.run(C.bounded_call_counts(stream), "bounded_test", "append")
    got = sorted((r.window_start.time(), r.call_count) for r in out.collect())
    # The watermark ends at 13:05, so windows ending by then are out; the
    # 10:00 call met an 11:00 watermark and is gone (no 09:10 .. 10:00 rows).
    assert got == [(dt.time(11, 10), 1), (dt.time(11, 20), 1), (dt.time(11, 30), 1),
                   (dt.time(11, 40), 2), (dt.time(11, 50), 2), (dt.time(12, 0), 2)]


def _two_waves(spark, publish_wave):
    """Publish calls in two arrival waves split by time (wave 2 is later)."""
    from dispatchboard.plans import fixtures as X
    from tests.conftest import SF_SMALL
    calls = X.calls(spark, SF_SMALL)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    early = F.coalesce(F.col("call_date_time") < cut, F.lit(True))
    return calls, (lambda: publish_wave(calls.where(early)),
                   lambda: publish_wave(calls.where(~early)))


def test_flagship_stream_resumes_from_checkpoint(spark):
    """A stopped flagship stream restarted on its checkpoint picks up only
    the new calls and ends equal to the batch result (exactly once)."""
    from dispatchboard.operators import calls as C
    from dispatchboard.streaming import apps
    src, out = scratch_path(spark, "resume-src"), scratch_path(spark, "resume-out")
    cols = ["crime_id", "original_crime_type_name", "call_date_time", "disposition"]

    def publish_wave(df):
        TP.publish(df.withColumn("call_date_time", F.col("call_date_time").cast("timestamp")),
                   None, cols, S.TOPIC_CALLS, src, offset_col="offset",
                   time_col="call_date_time")

    calls, waves = _two_waves(spark, publish_wave)
    for wave in waves:
        wave()
        good, _ = apps.call_stream(spark, src)
        (res,) = apps.start_call_queries(good, None, "availableNow", out)
        res.wait()
    assert res.query.recentProgress[0].batchId > 0  # resumed, not restarted
    want = C.call_counts(calls, sort=False)
    got = res.read(spark)
    assert (sorted(got.select(want.columns).collect(), key=repr)
            == sorted(want.collect(), key=repr))


def test_board_app_command_line(spark):
    """The board application, from the command line, over published feeds:
    the board it renders equals the batch board."""
    from dispatchboard.operators import transit as T
    from dispatchboard.plans import fixtures as X
    from dispatchboard.schemas import ARRIVAL, TURNSTILE
    from dispatchboard.streaming import apps
    from dispatchboard.streaming.board import BoardState
    from tests.conftest import SF_SMALL
    logs, out = scratch_path(spark, "board-logs"), scratch_path(spark, "board-out")
    recs = T.station_records(X.stops(spark, SF_SMALL)).withColumnRenamed("station_order", "order")
    TP.publish(recs, ["station_id"], ["station_id", "station_name", "order", "line"],
               S.TOPIC_STATIONS_TABLE, logs, offset_col="stop_id")
    TP.publish(X.arrivals(spark, SF_SMALL), [F.col("key").alias("timestamp")],
               [f.name for f in ARRIVAL.fields], S.TOPIC_ARRIVALS, logs,
               offset_col="offset", time_col="timestamp")
    TP.publish(X.weather(spark, SF_SMALL), [F.col("key").alias("timestamp")],
               ["temperature", "status"], S.TOPIC_WEATHER, logs,
               offset_col="offset", time_col="timestamp")
    TP.publish(X.turnstile(spark, SF_SMALL), [F.col("key").alias("timestamp")],
               [f.name for f in TURNSTILE.fields], S.TOPIC_TURNSTILE, logs,
               offset_col="offset", time_col="timestamp")
    apps.main(["board", "--logs", logs, "--out", out, "--trigger", "availableNow"])
    got = BoardState(spark, out).read()
    stations = T.line_stations(X.stops(spark, SF_SMALL))
    want = T.status_board(stations, T.slot_occupancy(X.arrivals(spark, SF_SMALL), stations),
                          T.entries_per_station(X.turnstile(spark, SF_SMALL)),
                          T.current_weather(X.weather(spark, SF_SMALL)), sort=False)
    cols = sorted(want.columns)
    assert (sorted(got.select(cols).collect(), key=repr)
            == sorted(want.select(cols).collect(), key=repr))


def test_board_app_refuses_missing_feeds(spark):
    from dispatchboard.streaming import apps
    logs = scratch_path(spark, "board-empty")
    with pytest.raises(RuntimeError, match="missing input topics"):
        apps.main(["board", "--logs", logs, "--out", scratch_path(spark, "board-x"),
                   "--trigger", "availableNow"])


def test_calls_app_console(spark):
    """Without --out the calls app prints both named queries' results."""
    from dispatchboard.plans.streams import publish_calls
    from dispatchboard.streaming import apps
    from tests.conftest import SF_SMALL
    loc = scratch_path(spark, "log-console")
    publish_calls(spark, SF_SMALL, loc)
    apps.main(["calls", "--source", loc, "--trigger", "availableNow"])


def test_offsets_go_on_and_numbered_parts_replace(spark):
    loc = scratch_path(spark, "log-offsets")
    df = spark.range(0, 6, 1, 2).withColumn("o", F.col("id") + 1000)
    TP.publish(df, None, ["id"], "t", loc)
    first = TP.next_offset(spark, loc, "t")
    TP.publish(df, None, ["id"], "t", loc)
    log = TP.read_published(spark, loc, "t")
    assert log.select("offset").distinct().count() == 12
    assert log.where(F.col("offset") >= first).count() == 6
    for _ in range(2):  # a retried job
        TP.publish(df, None, ["id"], "u", loc, offset_col="o", batch=4)
    assert TP.read_published(spark, loc, "u").count() == 6
    os.makedirs(f"{loc.replace('file:', '')}/empty/_temporary/0")
    assert not TP.topic_exists(spark, loc, "empty")
    with pytest.raises(ValueError):
        TP.publish(df, None, ["id"], "t", "broker:9092", fmt="kafka", if_absent=True)


def test_pattern_opens_only_matching_topics(spark):
    from dispatchboard.sources.topics import kafka_offsets, subscribe_pattern
    loc = scratch_path(spark, "log-pattern")
    for topic in ("a.one", "a.two", "b.one"):
        TP.publish(spark.range(2), None, ["id"], topic, loc)
    df = read_topics(spark, loc, r"a\..*", stream=False)
    assert {f.split("/")[-2] for f in df.inputFiles()} == {"a.one", "a.two"}
    assert read_topics(spark, loc, r"a\.", stream=False).count() == 0  # whole names, as a broker
    assert subscribe_pattern(read_topics(spark, loc, ".*", stream=False), r"a\.").count() == 0
    assert subscribe_pattern(read_topics(spark, loc, ".*", stream=False), r"[ab]\.one").count() == 4
    assert kafka_offsets({0: 5, 1: -1}, "t") == '{"t": {"0": 5, "1": -1}}'
    assert kafka_offsets("latest", "t") == "latest"
    with pytest.raises(ValueError):
        kafka_offsets({0: 5}, None)


def test_latest_stream_reads_what_comes_after_its_first_start(spark):
    loc, store, out = (scratch_path(spark, n) for n in ("log-latest", "start", "latest-out"))
    put = lambda a, b: TP.publish(spark.range(a, b), None, ["id"], "t", loc)
    put(0, 5)

    def run(starting):
        s = read_topic(spark, loc, "t", starting=starting, start_store=f"{store}/s").select("offset", "value")
        return runner.start(s, "latest_test", "append", path=out).wait()
    run({0: -1})
    put(5, 8)
    run({0: -1})
    put(8, 9)
    got = run({0: -1}).read(spark).select(F.get_json_object(F.col("value").cast("string"), "$.id").alias("i"))
    assert sorted(r.i for r in got.collect()) == ["5", "6", "7", "8"]


def test_progress_table_keeps_every_report(spark):
    loc = scratch_path(spark, "log-progress")
    for i in range(5):
        TP.publish(spark.range(3), None, ["id"], "t", loc)
    reports = runner.ProgressTable(spark, f"{scratch_path(spark, 'reports')}/r", hold=2)
    try:
        q = runner.start(read_topic(spark, loc, "t", max_files_per_trigger=1).select("offset"),
                         "progress_test", "append").wait().query
        rows = reports.wait(q).read().where(F.col("id") == str(q.id))
        assert rows.agg(F.sum("num_input_rows")).first()[0] == 15 and rows.count() >= 5
    finally:
        reports.close()


def test_restarted_summary_goes_on(spark):
    """Three riders, a restart, two more: the topic's last total is five."""
    from dispatchboard.streaming import apps
    loc, state = scratch_path(spark, "log-summary"), scratch_path(spark, "state")
    for riders in (3, 2):
        rows = spark.range(riders).select(F.lit(7).alias("station_id"), F.lit("x").alias("station_name"),
                                          F.lit("red").alias("line"))
        TP.publish(rows, None, rows.columns, S.TOPIC_TURNSTILE, loc)
        q = apps.start_summary_query(spark, apps.turnstile_stream(spark, loc), loc, "availableNow",
                                     f"{state}/ck")
        q.awaitTermination()
        assert q.exception() is None
    last = (TP.read_published(spark, loc, S.TOPIC_SUMMARY).orderBy(F.desc("offset"))
            .select(F.col("value").cast("string").alias("v")).first().v)
    assert last == '{"station_id":7,"count":5}'


def test_a_bad_weather_message_keeps_the_last_reading(spark):
    import datetime as dt
    from dispatchboard.streaming.board import BoardState
    from dispatchboard.sources.topics import LOG_COLUMNS
    state = BoardState(spark, scratch_path(spark, "board-weather"))
    station = '{"station_id": 1, "station_name": "n", "order": 1, "line": "red"}'
    rows = [(None, v, t, 0, o, dt.datetime(2024, 1, 1, 0, o)) for o, (t, v) in enumerate([
        (S.TOPIC_STATIONS_TABLE, station), (S.TOPIC_WEATHER, '{"temperature": 12.5, "status": "windy"}'),
        (S.TOPIC_WEATHER, "{oops"), (S.TOPIC_SUMMARY, '{"count": 1}'), (S.TOPIC_ARRIVALS, "?")])]
    batch = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, "
                                        "timestamp timestamp").select(*LOG_COLUMNS)
    for i in (0, 1):
        state.apply(batch.where(F.col("offset") < 2 if i == 0 else F.col("offset") >= 2), i)
    r = state.read().first()
    assert (r.temperature, r.weather) == (12, "Windy")
    assert sorted(x.offset for x in state.quarantined().collect()) == [2, 3, 4]


def test_board_opens_only_its_feeds(spark):
    from dispatchboard.sources.topics import read_topic_list
    loc, out = scratch_path(spark, "log-feeds"), scratch_path(spark, "feeds-out")
    for topic in ("weather", "turnstile"):
        TP.publish(spark.range(4), None, ["id"], topic, loc)
    q = runner.start(read_topic_list(spark, loc, ["weather", "later"]), "feeds", "append", path=out).wait()
    assert q.read(spark).select("topic").distinct().collect()[0].topic == "weather"
    assert q.query.lastProgress is None or "turnstile" not in str(q.query.lastProgress.sources)
    TP.publish(spark.range(2), None, ["id"], "later", loc)
    q = runner.start(read_topic_list(spark, loc, ["weather", "later"]), "feeds", "append", path=out).wait()
    assert q.read(spark).groupBy("topic").count().orderBy("topic").collect()[0].asDict() == {
        "topic": "later", "count": 2}


def test_cluster_sessions_must_name_a_shared_folder():
    from dispatchboard.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class Sc:
                    @staticmethod
                    def getCheckpointDir():
                        class None_:
                            @staticmethod
                            def isDefined():
                                return False
                        return None_
                return Sc

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)


def test_changes_mode_writes_only_what_changed(spark):
    """Flagship in changes mode over two triggers: the second part holds the
    touched buckets alone, and the reader sees newest totals."""
    import datetime as dt
    from dispatchboard.operators import calls as C
    from dispatchboard.streaming import apps
    src, out = scratch_path(spark, "changes-src"), scratch_path(spark, "changes-out")
    ddl = "call_date_time timestamp, original_crime_type_name string, disposition string"
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    waves = [[(t(12, 1), "a", None), (t(15, 2), "a", "X")], [(t(15, 3), "a", "X"), (t(12, 1), "a", None)]]
    for i, rows in enumerate(waves):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{src}/f{i}")
        stream = spark.readStream.schema(ddl).option("recursiveFileLookup", "true").parquet(src)
        res = apps.start_call_counts(stream, out, "availableNow").wait()
    parts = {r["batch"]: r["count"] for r in spark.read.parquet(f"{out}/parts").groupBy("batch").count().collect()}
    assert sorted(parts.values()) == [1, 2]
    want = C.call_counts(spark.createDataFrame(waves[0] + waves[1], ddl), sort=False)
    got = apps.read_call_counts(spark, res)
    assert sorted(got.select(want.columns).collect(), key=repr) == sorted(want.collect(), key=repr)
