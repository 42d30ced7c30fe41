"""Stream-backed queries: the driver's tables are published as topic logs,
then read back as streams and run through the same operators as the batch
queries. Results equal the batch results (complete mode) and are checked
against the same SQL twins."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.functions import scalars as S
from dispatchboard.operators import calls as C
from dispatchboard.operators import transit as T
from dispatchboard.plans import fixtures as X
from dispatchboard.schemas import ARRIVAL, STATION, STOPS, TURNSTILE
from dispatchboard.session import drop_path, scratch_path
from dispatchboard.sinks.topics import as_records, publish, topic_files
from dispatchboard.sources.topics import LOG_COLUMNS, read_topic, read_topic_list
from dispatchboard.streaming import apps, runner
from dispatchboard.streaming.board import BoardState
from dispatchboard.streaming.board_changes import read_board_changes, start_board_changes
from dispatchboard.streaming.checks import start_checked_load
from dispatchboard.streaming.quarantine import replay, split_malformed

# Triggers that a registered stream takes its log in at least, and rows that
# each has at least; logs are written by their table's own scan tasks.
TRIGGERS, LEAST_ROWS = 5, 100


def publish_parts(df: DataFrame, key_cols, value_cols, topic: str, location: str, **options) -> None:
    """``publish`` in files of at most a fifth of the rows, so that a stream
    over the log, however small, needs several triggers."""
    rows = df.count()
    publish(df, key_cols, value_cols, topic, location,
            max_records=max(LEAST_ROWS, -(-rows // TRIGGERS)), **options)


def intake(spark: SparkSession, location: str, *topics: str) -> int:
    """Files of the logs that a trigger takes (STR-8): three to five triggers."""
    files = sum(topic_files(spark, location, t) for t in topics)
    return max(1, -(-files // TRIGGERS))


def _log(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"log-{name}")


@contextmanager
def _feed(spark: SparkSession, name: str):
    """A folder of topic logs for one run, removed when its streams have
    taken it in: results never read it."""
    path = _log(spark, name)
    try:
        yield path
    finally:
        drop_path(spark, path)


def publish_calls(spark, sf_dir, location) -> None:
    c = X.calls(spark, sf_dir).withColumn(
        "call_date_time", F.col("call_date_time").cast("timestamp"))
    publish_parts(c, None, ["crime_id", "original_crime_type_name", "call_date_time", "disposition"],
                  S.TOPIC_CALLS, location, offset_col="offset", time_col="call_date_time")


def call_stream(spark, location) -> tuple[DataFrame, DataFrame]:
    return apps.call_stream(spark, location, max_files_per_trigger=intake(spark, location, S.TOPIC_CALLS))


def run_call_counts(spark, sf_dir, described: bool = False, publish_feed=publish_calls):
    """The flagship over the published calls, each trigger writing what it
    changed; the ended query and its result folder."""
    name = "crime_type_count_described" if described else "crime_type_count"
    with _feed(spark, "calls") as loc:
        publish_feed(spark, sf_dir, loc)
        good, _ = call_stream(spark, loc)
        return apps.start_call_counts(good, _log(spark, "results"), "availableNow", name).wait()


def stream_call_queries(spark, sf_dir):
    """STR-4: both named queries of the flagship, from one published lineage,
    running side by side in one session (each with its own state). A trigger
    writes what it changed, and the end each query's whole result once."""
    with _feed(spark, "calls") as loc:
        publish_calls(spark, sf_dir, loc)
        good, _ = call_stream(spark, loc)
        q1, q2 = apps.start_call_queries(good, X.codes(spark, sf_dir), "availableNow",
                                         _log(spark, "results"), mode="changes")
        q1.wait(), q2.wait()
    for q in (q1, q2):
        q.read(spark).write.parquet(f"{q.path}/result")
    return q1, q2


def stream_window_counts(spark, sf_dir):
    return C.by_count_desc(apps.read_call_counts(spark, run_call_counts(spark, sf_dir)))


def stream_window_described(spark, sf_dir):
    return C.by_count_desc(apps.read_call_counts(spark, run_call_counts(spark, sf_dir, True),
                                                 X.codes(spark, sf_dir)))


def stream_progress(spark, sf_dir):
    """STR-5: rows each named query took in, summed over all its reports."""
    reports = runner.ProgressTable(spark, f"{_log(spark, 'progress')}/reports")
    try:
        q1, q2 = stream_call_queries(spark, sf_dir)
        rows = reports.wait(q1.query, q2.query).read()
    finally:
        reports.close()
    own = rows.where(F.col("id").isin(str(q1.query.id), str(q2.query.id)))
    return own.groupBy("query").agg(F.sum("num_input_rows").alias("num_input_rows"))


# Message texts of the same call: time forms a feed may use, in turn, and
# calls without an id.
def publish_mixed_calls(spark, sf_dir, location) -> None:
    t = F.col("call_date_time").cast("timestamp")
    micros, millis = "HH:mm:ss.SSSSSS", "HH:mm:ss.SSS"
    forms = [F.date_format(t, f"yyyy-MM-dd'T'{micros}"), F.date_format(t, f"yyyy-MM-dd {micros}"),
             F.date_format(t, f"yyyy-MM-dd'T'{micros}XXX"), F.date_format(t, f"yyyy-MM-dd'T'{millis}")]
    turn = F.col("offset") % len(forms)
    text = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        text = F.when(turn == i, form).otherwise(text)
    c = X.calls(spark, sf_dir).select(
        "offset", F.when(F.col("offset") % 3 > 0, F.col("crime_id")).alias("crime_id"),
        "original_crime_type_name", text.alias("call_date_time"), "disposition")
    publish_parts(c, None, ["crime_id", "original_crime_type_name", "call_date_time", "disposition"],
                  S.TOPIC_CALLS, location, offset_col="offset")


def calls_json_formats(spark, sf_dir):
    """The flagship over messages as a feed writes them."""
    return apps.read_call_counts(spark, run_call_counts(spark, sf_dir, publish_feed=publish_mixed_calls))


def stream_quarantine(spark, sf_dir):
    """PRJ-20 as a stream: offsets of the messages that don't decode, kept
    in the quarantine output while the others go on."""
    from dispatchboard.streaming.quarantine import start_quarantine
    c = X.calls(spark, sf_dir).withColumn("call_date_time", F.col("call_date_time").cast("timestamp"))
    cols = ["crime_id", "original_crime_type_name", "call_date_time", "disposition"]
    with _feed(spark, "calls") as loc:
        _broken(c, F.col("offset") % 7 == 3, None, cols, S.TOPIC_CALLS, loc, offset_col="offset")
        _, bad = call_stream(spark, loc)
        kept = start_quarantine(bad, "calls_quarantine", _log(spark, "quarantine"), "availableNow").wait()
    return kept.read(spark).select("offset")


def _broken(df, where, key_cols, value_cols, topic, location, **options) -> None:
    """Publish ``df`` with the messages chosen by ``where`` cut short."""
    broken = F.coalesce(where, F.lit(False))
    publish(df.where(~broken), key_cols, value_cols, topic, location, **options)
    text = F.col("value").cast("string")
    (as_records(df.where(broken), key_cols, value_cols, topic, **options)
     .withColumn("value", F.substring(text, 2, 1 << 30).cast("binary"))
     .write.mode("append").parquet(f"{location}/{topic}"))


def stream_latest(spark, sf_dir):
    """SRC-3: a stream from "latest" reads what is published after its start
    and nothing before, also over a restart."""
    store, out = f"{_log(spark, 'latest-start')}/start", _log(spark, "latest-out")
    e = X.table(spark, sf_dir, "events").select("event_id", "event_type")
    early = F.col("event_type").isin("view", "click")

    later = e.where(~early).withColumn("offset", F.col("event_id") + (1 << 40))
    with _feed(spark, "latest") as loc:
        publish(e.where(early), None, ["event_id"], "events", loc, offset_col="event_id")
        for rows in (None, later):
            if rows is not None:
                publish(rows, None, ["event_id"], "events", loc, offset_col="offset")
            log = read_topic(spark, loc, "events", starting="latest", start_store=store)
            seen = runner.start(log.select("offset", "value"), "latest", "append", path=out).wait()
    return seen.read(spark).select(F.get_json_object(F.col("value").cast("string"), "$.event_id")
                                   .cast("long").alias("event_id"))


# Days that cut the calls into the waves of the streams below, by SQL too.
WAVES = ("2024-01-08", "2024-01-15", "2024-01-22")


def wave(time, offset):
    """Which wave a call comes in: its time's, but every tenth call one later."""
    by_time = sum((F.coalesce(time >= F.lit(day).cast("timestamp_ntz"), F.lit(False)).cast("int") for day in WAVES),
                  F.lit(0))
    return by_time + F.when(offset % 10 == 3, 1).otherwise(0)


def run_bounded_counts(spark, sf_dir):
    """The bounded flagship over calls that come in five waves, each a
    trigger of its own with a restart between, some calls a wave late."""
    from dispatchboard.streaming.late import start_bounded_counts
    out = _log(spark, "bounded")
    c = X.calls(spark, sf_dir).withColumn("wave", wave(F.col("call_date_time"), F.col("offset")))
    c = c.withColumn("call_date_time", F.col("call_date_time").cast("timestamp"))
    cols = ["crime_id", "original_crime_type_name", "call_date_time", "disposition"]
    with _feed(spark, "calls") as loc:
        for n in range(len(WAVES) + 2):
            publish(c.where(F.col("wave") == n), None, cols, S.TOPIC_CALLS, loc, offset_col="offset")
            good, _ = apps.call_stream(spark, loc)
            result = start_bounded_counts(good, out, "availableNow").wait()
    return result


def stream_bounded_counts(spark, sf_dir):
    """STR-1: all accepted calls counted, closed windows and open ones."""
    return run_bounded_counts(spark, sf_dir).read(spark)


def stream_late_calls(spark, sf_dir):
    """STR-1: the calls that the watermark refused, and that watermark."""
    return run_bounded_counts(spark, sf_dir).late(spark).select(
        "offset", F.col("refused_by").cast("timestamp_ntz").alias("refused_by"))


def stream_distinct_calls(spark, sf_dir):
    """DED-1 within a bound: calls in waves of a week, each call twice in its
    wave, with a restart between."""
    out = _log(spark, "distinct")
    c = X.calls(spark, sf_dir)
    c = (c.withColumn("wave", wave(F.col("call_date_time"), F.lit(0)))
         .withColumn("call_date_time", F.col("call_date_time").cast("timestamp")))
    twice = c.unionByName(c.withColumn("offset", F.col("offset") + (1 << 40)))
    with _feed(spark, "calls") as loc:
        for n in range(len(WAVES) + 1):
            publish(twice.where(F.col("wave") == n), None, [C.TIME_COL, C.TYPE_COL, C.DISPOSITION_COL],
                    S.TOPIC_CALLS, loc, offset_col="offset")
            good, _ = apps.call_stream(spark, loc)
            seen = runner.start(C.distinct_calls_within(good), "distinct_calls", "append", path=out).wait()
    return seen.read(spark).withColumn(C.TIME_COL, F.col(C.TIME_COL).cast("timestamp_ntz"))


def stream_window_deltas(spark, sf_dir):
    """AGG-1, WIN-1: the flagship kept by changes, summed; folded on the way."""
    from dispatchboard.streaming.deltas import read_delta_counts, start_call_deltas
    out = _log(spark, "deltas")
    with _feed(spark, "calls") as loc:
        publish_calls(spark, sf_dir, loc)
        good, _ = call_stream(spark, loc)
        start_call_deltas(good, out, "availableNow", fold=2).wait()
    return read_delta_counts(spark, out)


def stream_slots(spark, sf_dir):
    """STR-6 as a stream: arrivals topic log -> slot aggregate, complete mode."""
    stations = T.line_stations(X.stops(spark, sf_dir))
    with _feed(spark, "arrivals") as loc:
        publish_parts(X.arrivals(spark, sf_dir), [F.col("key").alias("timestamp")], ARRIVAL.names,
                      S.TOPIC_ARRIVALS, loc, offset_col="offset", time_col="timestamp")
        log = read_topic(spark, loc, S.TOPIC_ARRIVALS,
                         max_files_per_trigger=intake(spark, loc, S.TOPIC_ARRIVALS))
        arr, _ = split_malformed(log, ARRIVAL)
        return runner.run(T.slot_occupancy(arr, stations), "slots", "complete")


def stream_arrivals_known(spark, sf_dir):
    """JOI-2 as a stream-stream join: a week's arrivals come before any
    station record, then the records, whose times run over the first day, then
    the other arrivals, with a restart between."""
    a = X.arrivals(spark, sf_dir)
    first_week = F.coalesce(F.col("timestamp") < F.lit(WAVES[0]).cast("timestamp_ntz"), F.lit(True))
    records = T.station_records(X.stops(spark, sf_dir)).withColumnRenamed("station_order", "order")
    records = records.withColumn("time", F.lit("2024-01-01").cast("timestamp")
                                 + F.make_dt_interval(hours=F.col("station_id") % 24))
    out = _log(spark, "arrivals-known")

    def arrive(rows, loc):
        publish(rows, [F.col("key").alias("timestamp")], ARRIVAL.names, S.TOPIC_ARRIVALS, loc,
                offset_col="offset", time_col="timestamp")

    def recorded(rows, loc):
        publish(rows, ["station_id"], STATION.names, S.TOPIC_STATIONS_TABLE, loc, offset_col="stop_id",
                time_col="time")
    with _feed(spark, "arrivals") as loc:
        for waves in ((a.where(first_week), records.limit(0)), (None, records), (a.where(~first_week), None)):
            for rows, put in zip(waves, (arrive, recorded)):
                if rows is not None:
                    put(rows, loc)
            feeds = [split_malformed(read_topic(spark, loc, topic), schema)[0]
                     for topic, schema in ((S.TOPIC_ARRIVALS, ARRIVAL), (S.TOPIC_STATIONS_TABLE, STATION))]
            met = T.arrivals_at_live_stations(*feeds, wait="1 day")
            seen = runner.start(met, "arrivals_known", "append", path=out).wait()
    return seen.read(spark).select("line", "station_id", "train_id", "direction", "offset")


def publish_stops(spark, sf_dir, location) -> None:
    stops = X.stops(spark, sf_dir).withColumnRenamed("station_order", "order")
    publish_parts(stops, ["stop_id"], [f.name for f in STOPS.fields], S.TOPIC_STATIONS_RAW, location,
                  offset_col="stop_id")


def _stations(spark, sf_dir, changes: str):
    """The station job over the raw stops; its changelog goes to ``changes``."""
    with _feed(spark, "stations") as loc:
        publish_stops(spark, sf_dir, loc)
        q, table = apps.start_station_job(spark, loc, _log(spark, "station-job"), changes, "availableNow",
                                          max_files_per_trigger=intake(spark, loc, S.TOPIC_STATIONS_RAW))
        _ended(q)
    return table


def _ended(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_upsert(spark, sf_dir):
    """SNK-3: raw stop rows stream into the keyed station table."""
    return (_stations(spark, sf_dir, _log(spark, "changes")).read()
            .select("station_id", "station_name", "station_order", "line"))


def stream_changelog(spark, sf_dir):
    """SNK-3: every write to the station table, read back from its topic."""
    changes = _log(spark, "changes")
    _stations(spark, sf_dir, changes)
    log = read_topic(spark, changes, S.TOPIC_STATIONS_TABLE, stream=False)
    good, _ = split_malformed(log, STATION)
    return good.select(F.col("offset").alias("stop_id"), "station_id", "station_name",
                       F.col("order").alias("station_order"), "line")


def stream_entries(spark, sf_dir):
    """AGG-2 in update mode, rows upserted by station (the summary table)."""
    with _feed(spark, "turnstile") as loc:
        publish_parts(X.turnstile(spark, sf_dir), [F.col("key").alias("timestamp")], TURNSTILE.names,
                      S.TOPIC_TURNSTILE, loc, offset_col="offset", time_col="timestamp")
        rows = apps.turnstile_stream(spark, loc, max_files_per_trigger=intake(spark, loc, S.TOPIC_TURNSTILE))
        return runner.run(T.entries_per_station(rows), "turnstile_summary", "update",
                          keys=["station_id"])


def _board_feeds(spark, sf_dir) -> dict:
    """Rows, key, value columns and options of the feeds the board and its
    summary query read, by topic."""
    def timed(df, fields):
        return (df, [F.col("key").alias("timestamp")], fields, dict(offset_col="offset", time_col="timestamp"))
    return {S.TOPIC_ARRIVALS: timed(X.arrivals(spark, sf_dir), ARRIVAL.names),
            S.TOPIC_WEATHER: timed(X.weather(spark, sf_dir), ["temperature", "status"]),
            S.TOPIC_TURNSTILE: timed(X.turnstile(spark, sf_dir), TURNSTILE.names)}


def _run_board(spark, root, state) -> DataFrame:
    """Summary query and board over all that ``root`` holds, then stop."""
    turn = apps.turnstile_stream(spark, root, max_files_per_trigger=intake(spark, root, S.TOPIC_TURNSTILE))
    _ended(apps.start_summary_query(spark, turn, root, "availableNow", f"{state}/_summary_checkpoint"))
    q, board = apps.start_board(spark, root, state, "availableNow",
                                intake(spark, root, *T.DEFAULT_TOPICS.values()))
    _ended(q)
    return board


def stream_board(spark, sf_dir):
    """The assembled board as a stream: stations from the station job's
    changelog, arrivals, weather, and the summary query's counts."""
    with _feed(spark, "board") as root:
        _stations(spark, sf_dir, root)
        for topic, (df, key, fields, options) in _board_feeds(spark, sf_dir).items():
            publish(df, key, fields, topic, root, **options)
        return _run_board(spark, root, _log(spark, "board-state")).read()


def stream_board_resumed(spark, sf_dir):
    """The board stopped after half of its feeds and started again on the
    rest, taken in as one larger batch."""
    state, cut = _log(spark, "board-state"), F.lit("2024-01-12").cast("timestamp_ntz")
    early = F.coalesce(F.col("timestamp") < cut, F.lit(True))
    with _feed(spark, "board") as root:
        _stations(spark, sf_dir, root)
        for part in (early, ~early):
            for topic, (df, key, fields, options) in _board_feeds(spark, sf_dir).items():
                publish(df.where(part), key, fields, topic, root, **options)
            board = _run_board(spark, root, state)
    return board.read()


def stream_board_bad_records(spark, sf_dir):
    """The board over feeds in which some messages are broken: it shows what
    it would without them."""
    junk = (spark.createDataFrame([("{",), ("[1]",), ("{}",), ("",)], "text string")
            .select(F.lit(None).cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
                    F.lit(0).alias("partition"), F.lit(1 << 50).alias("offset"),
                    F.lit("2099-01-01").cast("timestamp").alias("timestamp")))
    feeds = _board_feeds(spark, sf_dir)
    with _feed(spark, "board") as root:
        _stations(spark, sf_dir, root)
        for topic in (*feeds, S.TOPIC_STATIONS_TABLE, S.TOPIC_SUMMARY):
            (junk.withColumn("topic", F.lit(topic)).select(*LOG_COLUMNS).write.mode("append")
             .parquet(f"{root}/{topic}"))
        for topic, (df, key, fields, options) in feeds.items():
            _broken(df, F.col("offset") % 5 == 2, key, fields, topic, root, **options)
        return _run_board(spark, root, _log(spark, "board-state")).read()


def _publish_board(spark, sf_dir, root) -> None:
    """All four feeds of the board in ``root``: the summary query has run."""
    _stations(spark, sf_dir, root)
    for topic, (df, key, fields, options) in _board_feeds(spark, sf_dir).items():
        publish_parts(df, key, fields, topic, root, **options)
    turn = apps.turnstile_stream(spark, root, max_files_per_trigger=intake(spark, root, S.TOPIC_TURNSTILE))
    _ended(apps.start_summary_query(spark, turn, root, "availableNow", _log(spark, "summary-ck")))


def stream_board_changes(spark, sf_dir):
    """JOI-4 by changed rows: every trigger writes the board rows it touched,
    folded every other trigger; the board is each row's last change."""
    out = _log(spark, "board-changes")
    names = list(T.DEFAULT_TOPICS.values())
    with _feed(spark, "board") as root:
        _publish_board(spark, sf_dir, root)
        feeds = read_topic_list(spark, root, names, max_files_per_trigger=intake(spark, root, *names))
        start_board_changes(feeds, out, "availableNow", fold=2).wait()
    return read_board_changes(spark, out)


def stream_board_replayed(spark, sf_dir):
    """PRJ-20 with replay: arrivals and readings that lost their first
    character go to quarantine, are mended and put back; the board is then
    that of the clean feeds."""
    state = _log(spark, "board-state")
    with _feed(spark, "board") as root:
        _stations(spark, sf_dir, root)
        for topic, (df, key, fields, options) in _board_feeds(spark, sf_dir).items():
            hurt = F.lit(False) if topic == S.TOPIC_TURNSTILE else F.col("offset") % 5 == 2
            _broken(df, hurt, key, fields, topic, root, **options)
        _run_board(spark, root, state)
        kept = BoardState(spark, state).quarantined()
        replay(spark, kept, F.concat(F.lit("{"), F.col("value").cast("string")), root, 0)
        return _run_board(spark, root, state).read()


def faulty_stops(spark, sf_dir) -> DataFrame:
    """Stop rows with over-long and missing names and repeated stop ids; a
    repeat lies 2^40 offsets behind its first."""
    stops, n = X.stops(spark, sf_dir), F.col("stop_id")
    rows = (stops.withColumn("stop_name", F.when(n % 11 == 5, F.repeat("stop_name", F.lit(5))).otherwise(
        F.col("stop_name"))).withColumn("station_name", F.when(n % 13 != 4, F.col("station_name")))
        .withColumn("offset", n.cast("long")))
    return rows.unionByName(rows.where(n % 7 == 3).withColumn("offset", F.col("offset") + (1 << 40)))


def stream_station_checks(spark, sf_dir):
    """SNK-6 over triggers: rows that each check refuses, by stop."""
    with _feed(spark, "stops") as loc:
        publish_parts(faulty_stops(spark, sf_dir).withColumnRenamed("station_order", "order"), ["stop_id"],
                      STOPS.names, S.TOPIC_STATIONS_RAW, loc, offset_col="offset")
        log = read_topic(spark, loc, S.TOPIC_STATIONS_RAW,
                         max_files_per_trigger=intake(spark, loc, S.TOPIC_STATIONS_RAW))
        rows, _ = split_malformed(log, STOPS)
        load = start_checked_load(rows.select("offset", *STOPS.names), _log(spark, "station-checks"),
                                  "availableNow").wait()
    return load.refused(spark).groupBy("check", "stop_id").agg(F.count(F.lit(1)).alias("refused"))


def stream_entries_table(spark, sf_dir):
    """AGG-3 as a stream: the latest station of each message key is a hash
    aggregate in the state store; a trigger writes the keys it changed, and
    the stations are counted when the result is read. Messages that don't
    decode, the latest of their keys among them, change nothing."""
    turnstile = X.turnstile(spark, sf_dir)
    with _feed(spark, "turnstile") as loc:
        key_cols = [F.col("key").alias("timestamp")]
        options = dict(offset_col="offset", time_col="timestamp")
        publish_parts(turnstile, key_cols, TURNSTILE.names, S.TOPIC_TURNSTILE, loc, **options)
        # The same messages again, later and broken: they replace nothing.
        again = turnstile.withColumn("offset", F.col("offset") + (1 << 40))
        _broken(again, F.lit(True), key_cols, TURNSTILE.names, S.TOPIC_TURNSTILE, loc, **options)
        rows = apps.turnstile_stream(spark, loc, max_files_per_trigger=intake(spark, loc, S.TOPIC_TURNSTILE))
        table = apps.start_turnstile_table(rows, _log(spark, "turnstile-table"), "availableNow").wait().read(spark)
    return T.entries_per_station(table)


def stream_state_counts(spark, sf_dir):
    """STR-3, SNK-4: the flagship over several triggers, its result read from
    the state store; the query writes no part."""
    out = _log(spark, "state-counts")
    with _feed(spark, "calls") as loc:
        publish_calls(spark, sf_dir, loc)
        good, _ = call_stream(spark, loc)
        apps.start_call_state(good, out, "availableNow").wait()
    return apps.read_call_state(spark, out)
