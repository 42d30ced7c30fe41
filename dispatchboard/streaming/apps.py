"""The reference's applications as Spark streaming jobs.

* ``calls``: police calls from a topic, counted in sliding windows (the
  flagship), as two named queries from one lineage: plain counts, and counts
  described from the disposition code table (STR-4). Results go to the
  console, as in the reference, or to result folders under ``out``.
* ``stations``: raw stop rows to the station table and its changelog topic.
* ``board``: the transit status board over its four feeds, plus the
  turnstile summary query that feeds it (AGG-2 + SNK-4).

Every application keeps undecodable messages in a quarantine folder.

Sources are topic logs (parquet, one folder per topic) or Kafka
(``fmt="kafka"``; the Kafka package must be on the classpath). Run
``python -m dispatchboard.streaming.apps calls|stations|board|poll ...``, or call ``main``
from a script given to spark-submit; each query checkpoints under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.functions import scalars as S
from dispatchboard.operators import calls as C
from dispatchboard.operators import transit as T
from dispatchboard.operators.keyed import latest_by
from dispatchboard.schemas import CALL, STOPS, TURNSTILE
from dispatchboard.session import prepare, scratch_path
from dispatchboard.sinks.tables import start_console
from dispatchboard.sinks.topics import finish_part, part_done
from dispatchboard.sources.files import read_codes
from dispatchboard.sources.topics import read_topic, read_topic_list
from dispatchboard.streaming import runner
from dispatchboard.streaming.quarantine import split_malformed, start_quarantine

# Call fields the flagship reads (the rest of the record is skipped unparsed).
FLAGSHIP_FIELDS = (C.TYPE_COL, C.TIME_COL, C.DISPOSITION_COL)
# State partitions whose changed stations share a file of the summary topic.
PARTITIONS_PER_FILE = 32


def call_stream(spark: SparkSession, source: str, topic: str = S.TOPIC_CALLS,
                fmt: str = "log", max_files_per_trigger: int | None = None,
                max_offsets_per_trigger: int | None = None,
                fields=FLAGSHIP_FIELDS, starting="earliest", start_store: str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """SRC-1 + PRJ-1 + PRJ-2 + PRJ-20: decoded calls and quarantined rows."""
    log = read_topic(spark, source, topic, stream=True, fmt=fmt, starting=starting,
                     max_files_per_trigger=max_files_per_trigger,
                     max_offsets_per_trigger=max_offsets_per_trigger, start_store=start_store)
    return split_malformed(log, CALL, fields=fields)


def start_call_queries(calls: DataFrame, codes: DataFrame | None = None,
                       trigger: str = "10 seconds", out: str | None = None,
                       described_only: bool = False, shared: bool = False, mode: str = "complete") -> list:
    """Start the flagship's named queries over a decoded call stream.

    ``out=None`` prints each trigger's full result to the console (the
    reference's output; the plain counts sorted, the described ones in the
    join's order; the console sink brings results to the driver, so use it
    for inspection only). With ``out`` every query writes result
    versions to ``out/<name>``: the stream keeps distinct triples and counts
    per slide bucket in state, and each trigger turns the buckets into
    windows (and joins the codes) as a batch step. Returns
    ``runner.StreamResult`` objects (folders) or console queries.

    ``shared=True`` (with ``out`` and ``codes``) runs one stateful query
    instead of two and writes both results from its batch step, so the
    dedup and bucket state are kept once, not once per output.

    ``mode="changes"`` (with ``out``) writes the buckets that a trigger
    changed instead of the whole result; ``read`` turns the newest into
    windows and joins the codes.
    """
    named = []
    if not described_only:
        named.append(("crime_type_count", None))
    if codes is not None:
        named.append(("crime_type_count_described", codes))
    started = []
    if out is None:
        for name, lookup in named:
            counts = C.call_counts(calls)
            df = counts if lookup is None else C.with_disposition(counts, lookup)
            started.append(start_console(df, name, "complete", trigger))
        return started
    buckets = C.call_bucket_counts(calls)
    out = out.rstrip("/")
    lookup = C.prepared_codes(codes) if codes is not None else None
    if shared and len(named) == 2:
        return _start_shared(buckets, lookup, trigger, out)
    for name, uses_codes in named:
        if mode == "changes":
            started.append(CallCounts(start_call_counts(calls, f"{out}/{name}", trigger, name),
                                      None if uses_codes is None else codes))
            continue
        if uses_codes is None:
            transform = C.windows_from_buckets
        else:
            def transform(b):
                return C.join_disposition(C.windows_from_buckets(b), lookup)
        started.append(runner.start(buckets, name, "complete", trigger,
                                    path=f"{out}/{name}", transform=transform))
    return started


def start_call_counts(calls: DataFrame, out: str, trigger: str = "10 seconds",
                      name: str = "crime_type_count"):
    """The flagship's counts in changes mode: a trigger writes the counts of
    the slide buckets it changed, however large the result has grown. Read
    with ``read_call_counts``."""
    return runner.start(C.call_bucket_counts(calls), name, "changes", trigger,
                        keys=["bucket_start", C.TYPE_COL, C.DISPOSITION_COL], path=out)


class CallCounts(runner.StreamResult):
    """A query of the flagship in changes mode, read as windows."""

    def __init__(self, started: runner.StreamResult, codes: DataFrame | None):
        super().__init__(started.query, started.path, started.mode, keys=started.keys)
        self._codes = codes

    def read(self, spark: SparkSession) -> DataFrame:
        windows = C.windows_from_buckets(super().read(spark))
        return windows if self._codes is None else C.with_disposition(windows, self._codes)


def start_call_state(calls: DataFrame, out: str, trigger: str = "10 seconds", name: str = "crime_type_count"):
    """The flagship's counts in state mode: a trigger writes only its state's
    changes, and readers take the bucket counts from the state itself."""
    return runner.start(C.call_bucket_counts(calls), name, "state", trigger, path=out)


def read_call_state(spark: SparkSession, out: str, codes: DataFrame | None = None) -> DataFrame:
    """Window counts from the bucket counts in the state of the query that
    ``start_call_state`` started with folder ``out``, as of its last committed
    trigger, whether it is still running or not."""
    held = runner.read_state(spark, f"{out.rstrip('/')}/_checkpoint")
    bucket, kind, disposition = (F.col("key")[f] for f in held.schema["key"].dataType.names)
    count = held.schema["value"].dataType.names[0]
    windows = C.windows_from_buckets(held.select(
        bucket["start"].alias("bucket_start"), kind.alias(C.TYPE_COL), disposition.alias(C.DISPOSITION_COL),
        F.col("value")[count].alias("call_count")))
    return windows if codes is None else C.with_disposition(windows, codes)


def read_call_counts(spark: SparkSession, result, codes: DataFrame | None = None) -> DataFrame:
    """Window counts from the newest bucket counts, described if ``codes``
    are given."""
    windows = C.windows_from_buckets(result.read(spark))
    return windows if codes is None else C.with_disposition(windows, codes)


def _start_shared(buckets: DataFrame, lookup: DataFrame, trigger: str, out: str) -> list:
    from dispatchboard.sinks import versions
    plain, described = f"{out}/crime_type_count", f"{out}/crime_type_count_described"

    def sink(batch: DataFrame, batch_id: int) -> None:
        # Both results come from this batch's windows; keep them for the
        # second write instead of running the stateful plan again.
        windows = C.windows_from_buckets(batch).persist()
        try:
            versions.commit(windows, plain, batch_id)
            versions.commit(C.join_disposition(windows, lookup), described, batch_id)
        finally:
            windows.unpersist()

    q = (buckets.writeStream.queryName("crime_type_counts").outputMode("complete")
         .option("checkpointLocation", f"{out}/_checkpoint_shared").foreachBatch(sink)
         .trigger(**runner.trigger_kwargs(trigger)).start())
    return [runner.StreamResult(q, plain, "complete"),
            runner.StreamResult(q, described, "complete")]


def _put(records: DataFrame, location: str, topic: str, batch_id: int, fmt: str) -> None:
    """One micro-batch's records out: a numbered part of a topic log, which a
    replay leaves alone once it is whole, or messages to Kafka (a replay
    repeats them; readers keep the latest per key)."""
    if fmt == "kafka":
        (records.select("key", "value", "topic").write.format("kafka")
         .option("kafka.bootstrap.servers", location).save())
    elif not part_done(records.sparkSession, location, topic, batch_id):
        records.write.mode("overwrite").parquet(f"{location}/{topic}/batch={batch_id:020d}")
        finish_part(records.sparkSession, location, topic, batch_id)


def start_summary_query(spark: SparkSession, turnstile: DataFrame, location: str,
                        trigger: str = "10 seconds", checkpoint: str | None = None,
                        topic: str = S.TOPIC_SUMMARY, fmt: str = "log"):
    """AGG-2 + SNK-4: running entries per station; each trigger's updated
    rows are published to the summary topic as JSON keyed by station. The
    batch id is the record offset, so later counts of a station win on the
    board; a replayed batch rewrites its own folder. ``checkpoint`` must stay
    the same over restarts (the launcher keeps it next to the board's): then
    batch ids and totals go on where they stopped."""
    from dispatchboard.sinks.topics import as_records
    counts = T.entries_per_station(turnstile)
    ck = checkpoint or scratch_path(spark, "summary-ck")

    def sink(batch: DataFrame, batch_id: int) -> None:
        recs = as_records(batch.withColumn("_off", F.lit(batch_id))
                          .select("station_id", F.col("entries").alias("count"), "_off"),
                          ["station_id"], ["station_id", "count"], topic, offset_col="_off")
        # A shuffle between state and files: the rows, one per changed station,
        # go to few files, and no task holds more than one state partition.
        files = -(-int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_FILE)
        _put(recs.repartition(files, F.col("key")), location, topic, batch_id, fmt)

    return (counts.writeStream.queryName("turnstile_summary_topic").outputMode("update")
            .option("checkpointLocation", ck).foreachBatch(sink)
            .trigger(**runner.trigger_kwargs(trigger)).start())


def start_station_job(spark: SparkSession, source: str, out: str, location: str,
                      trigger: str = "10 seconds", fmt: str = "log",
                      raw_topic: str = S.TOPIC_STATIONS_RAW, topic: str = S.TOPIC_STATIONS_TABLE,
                      max_files_per_trigger: int | None = None):
    """PRJ-5 + PRJ-6 + SNK-3: raw stop rows become the keyed station table
    under ``out``, and every write to it a record of the changelog topic the
    board reads. Undecodable rows are kept under ``out/quarantine``."""
    from dispatchboard.sinks.tables import KeyedTable
    from dispatchboard.sinks.topics import as_records
    log = read_topic(spark, source, raw_topic, fmt=fmt, max_files_per_trigger=max_files_per_trigger)
    table = KeyedTable(spark, f"{out.rstrip('/')}/table", ["station_id"], ["stop_id"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_malformed(batch.select("value"), STOPS, required=("stop_id", "station_id"))
            records = T.station_records(good.withColumnRenamed("order", "station_order"))
            bad.write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id:020d}")
            changes = as_records(records.withColumnRenamed("station_order", "order"), ["station_id"],
                                 ["station_id", "station_name", "order", "line"], topic, offset_col="stop_id")
            _put(changes, location, topic, batch_id, fmt)
            table.upsert(records, batch_id)
        finally:
            batch.unpersist()

    q = (log.writeStream.queryName("station_table").outputMode("append")
         .option("checkpointLocation", f"{out.rstrip('/')}/_checkpoint").foreachBatch(sink)
         .trigger(**runner.trigger_kwargs(trigger)).start())
    return q, table


def start_board(spark: SparkSession, location: str, out: str, trigger: str = "10 seconds",
                max_files_per_trigger: int | None = None, topics: Mapping[str, str] | None = None,
                fmt: str = "log"):
    """The live board: subscribe to the four feeds, fold each micro-batch into
    the board's keyed tables and render a new board version under ``out``
    (read it with ``BoardState(spark, out).read()``). ``topics`` names feeds
    that differ from ``transit.DEFAULT_TOPICS``. Of a log only the feeds' own
    folders are opened."""
    from dispatchboard.streaming.board import BoardState
    names = {**T.DEFAULT_TOPICS, **(topics or {})}
    feeds = read_topic_list(spark, location, list(names.values()), fmt=fmt,
                            max_files_per_trigger=max_files_per_trigger)
    state = BoardState(spark, out, names)
    q = (feeds.writeStream.queryName("status_board").outputMode("append")
         .option("checkpointLocation", f"{state.path}/_checkpoint")
         .foreachBatch(state.apply).trigger(**runner.trigger_kwargs(trigger)).start())
    return q, state


def turnstile_split(spark: SparkSession, source: str, fmt: str = "log",
                    max_files_per_trigger: int | None = None, topic: str = S.TOPIC_TURNSTILE
                    ) -> tuple[DataFrame, DataFrame]:
    """Decoded turnstile entries and the rows that name no station."""
    log = read_topic(spark, source, topic, fmt=fmt, max_files_per_trigger=max_files_per_trigger)
    return split_malformed(log, TURNSTILE, required=("station_id",))


def turnstile_stream(spark: SparkSession, source: str, fmt: str = "log",
                     max_files_per_trigger: int | None = None, topic: str = S.TOPIC_TURNSTILE
                     ) -> DataFrame:
    good, _ = turnstile_split(spark, source, fmt, max_files_per_trigger, topic)
    return good


def start_turnstile_table(turnstile: DataFrame, out: str, trigger: str = "10 seconds",
                          name: str = "turnstile_table"):
    """AGG-3: the latest station of each message key of a decoded turnstile
    stream, in changes mode. Count its rows per station when it is read."""
    key = F.get_json_object(F.col("key").cast("string"), "$.timestamp").cast("long").alias("key")
    latest = latest_by(turnstile.select(key, "offset", "station_id"), "key", "offset", ["station_id"])
    return runner.start(latest, name, "changes", trigger, keys=["key"], path=out)


def poll_table(spark: SparkSession, table: str, column: str, store: str, topic: str, location: str,
               fmt: str = "log", every: float | None = None) -> None:
    """SRC-6 as a job: publish what is new in a table, once or every so many
    seconds until it is stopped. The table is listed anew for each poll."""
    from dispatchboard.sources.incremental import poll_and_publish
    while True:
        poll_and_publish(spark.read.parquet(table), column, store, topic, location, fmt=fmt)
        if every is None:
            return
        time.sleep(every)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="python -m dispatchboard.streaming.apps")
    sub = p.add_subparsers(dest="app", required=True)
    c = sub.add_parser("calls", help="police-call window counts")
    c.add_argument("--source", required=True, help="topic-log root, or Kafka servers")
    c.add_argument("--topic", default=S.TOPIC_CALLS)
    c.add_argument("--codes", help="disposition code table (multi-line JSON)")
    c.add_argument("--kafka", action="store_true")
    c.add_argument("--out", help="result folder (default: console)")
    c.add_argument("--trigger", default="10 seconds")
    c.add_argument("--max-offsets-per-trigger", type=int)
    c.add_argument("--max-files-per-trigger", type=int)
    c.add_argument("--mode", choices=("complete", "changes", "state", "deltas", "bounded"), default="complete",
                   help="complete: every trigger rewrites the result (the default); changes: it writes what"
                        " changed; state: the result is read from the state store; deltas: it writes what each"
                        " window gains; bounded: state shrinks and late calls go to a side output (all but"
                        " complete need --out)")
    c.add_argument("--shared", action="store_true",
                   help="one stateful query writes both results (needs --out, --codes)")
    t = sub.add_parser("stations", help="raw stops to station table and changelog topic")
    t.add_argument("--source", required=True, help="topic-log root of the raw stops, or Kafka servers")
    t.add_argument("--logs", required=True, help="topic-log root of the changelog, or Kafka servers")
    t.add_argument("--out", required=True)
    t.add_argument("--raw-topic", default=S.TOPIC_STATIONS_RAW)
    t.add_argument("--topic", default=S.TOPIC_STATIONS_TABLE)
    t.add_argument("--kafka", action="store_true")
    t.add_argument("--trigger", default="10 seconds")
    t.add_argument("--max-files-per-trigger", type=int)
    b = sub.add_parser("board", help="transit status board")
    b.add_argument("--logs", required=True, help="topic-log root of the feeds, or Kafka servers")
    b.add_argument("--out", required=True)
    b.add_argument("--trigger", default="10 seconds")
    b.add_argument("--max-files-per-trigger", type=int)
    b.add_argument("--kafka", action="store_true")
    b.add_argument("--turnstile-topic", default=S.TOPIC_TURNSTILE)
    b.add_argument("--mode", choices=("tables", "changes"), default="tables",
                   help="tables: every trigger renders the whole board (the default); changes: it writes the rows"
                        " it touched (read with board_changes.read_board_changes)")
    for feed, name in T.DEFAULT_TOPICS.items():
        b.add_argument(f"--{feed}-topic", default=name)
    i = sub.add_parser("poll", help="what is new in a parquet table to a raw topic")
    i.add_argument("--table", required=True)
    i.add_argument("--column", default="stop_id", help="a unique, increasing whole number")
    i.add_argument("--store", required=True, help="folder of the high-water marks")
    i.add_argument("--logs", required=True, help="topic-log root, or Kafka servers")
    i.add_argument("--topic", default=S.TOPIC_STATIONS_RAW)
    i.add_argument("--kafka", action="store_true")
    i.add_argument("--every", type=float, help="seconds from poll to poll (default: poll once)")
    a = p.parse_args(argv)

    spark = prepare(SparkSession.builder.appName(f"dispatchboard-{a.app}").getOrCreate())
    if a.app == "poll":
        poll_table(spark, a.table, a.column, a.store, a.topic, a.logs, "kafka" if a.kafka else "log", a.every)
        return
    drain = a.trigger in ("availableNow", "once")
    fmt = "kafka" if a.kafka else "log"
    if a.app == "calls":
        good, bad = call_stream(spark, a.source, a.topic, fmt,
                                a.max_files_per_trigger, a.max_offsets_per_trigger)
        codes = read_codes(spark, a.codes) if a.codes else None
        if a.mode != "complete":
            if not a.out:
                p.error(f"--mode {a.mode} needs --out")
            from dispatchboard.streaming.deltas import start_call_deltas
            from dispatchboard.streaming.late import start_bounded_counts
            start = {"changes": start_call_counts, "state": start_call_state, "deltas": start_call_deltas,
                     "bounded": start_bounded_counts}[a.mode]
            started = [start(good, f"{a.out.rstrip('/')}/crime_type_count", a.trigger)]
        else:
            started = start_call_queries(good, codes, a.trigger, a.out, shared=a.shared)
        queries = [getattr(q, "query", q) for q in started]
        if a.out:
            queries.append(start_quarantine(bad, "calls_quarantine", f"{a.out}/quarantine",
                                            a.trigger).query)
    elif a.app == "stations":
        q, _ = start_station_job(spark, a.source, a.out, a.logs, a.trigger, fmt, a.raw_topic, a.topic,
                                 a.max_files_per_trigger)
        queries = [q]
    else:
        names = {feed: getattr(a, f"{feed}_topic") for feed in T.DEFAULT_TOPICS}
        if not a.kafka:
            # SNK-5: refuse to start without the feeds (the summary topic is
            # made by the summary query below).
            from dispatchboard.sinks.topics import require_topics
            require_topics(spark, a.logs, names["station"], names["arrival"], names["weather"],
                           a.turnstile_topic)
        good, bad = turnstile_split(spark, a.logs, fmt, a.max_files_per_trigger, a.turnstile_topic)
        summary = start_summary_query(spark, good, a.logs, a.trigger, f"{a.out}/_summary_checkpoint",
                                      names["summary"], fmt)
        queries = [summary, start_quarantine(bad, "turnstile_quarantine", f"{a.out}/turnstile_quarantine",
                                             a.trigger).query]
        if drain:  # the board should see every summary written by this run
            summary.awaitTermination()
        if a.mode == "changes":
            from dispatchboard.streaming.board_changes import malformed, start_board_changes
            feeds = read_topic_list(spark, a.logs, list(names.values()), fmt=fmt,
                                    max_files_per_trigger=a.max_files_per_trigger)
            queries += [start_board_changes(feeds, f"{a.out}/board_changes", a.trigger, names).query,
                        start_quarantine(malformed(feeds, names), "board_quarantine", f"{a.out}/board_quarantine",
                                         a.trigger).query]
        else:
            board, _ = start_board(spark, a.logs, a.out, a.trigger, a.max_files_per_trigger, names, fmt)
            queries.append(board)
    if drain:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    failed = [q for q in queries if q.exception() is not None]
    if failed:
        raise RuntimeError(str(failed[0].exception()))


if __name__ == "__main__":
    main()
