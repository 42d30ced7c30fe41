"""Results of streams: read from state, replayed parts, several triggers."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from dispatchboard.schemas import CALL
from dispatchboard.session import scratch_path
from dispatchboard.sinks import topics as TP
from dispatchboard.sources.topics import read_topic
from dispatchboard.streaming import apps, runner
from dispatchboard.streaming.quarantine import split_malformed


def _call_log(spark, batches):
    """A log of calls, one file for each batch of (minute, type, disposition)."""
    loc = scratch_path(spark, "log-state-calls")
    start = datetime.datetime(2024, 1, 1)
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(
            [(f"{i}-{k}", kind, start + datetime.timedelta(minutes=m), d, 100 * i + k)
             for k, (m, kind, d) in enumerate(rows)],
            "crime_id string, original_crime_type_name string, call_date_time timestamp, disposition string,"
            " offset long").coalesce(1)
        TP.publish(df, None, df.columns[:-1], "police.calls.v1", loc, offset_col="offset")
    return loc


def _window_rows(df):
    return sorted(map(str, df.collect()))


def test_state_is_the_result_of_a_running_and_a_restarted_query(spark):
    """The result grows trigger by trigger, late calls and repeats included,
    and no part is written."""
    from dispatchboard.operators import calls as C
    batches = [[(0, "a", "x"), (0, "a", "x"), (5, "b", None)], [(600, "a", "x")],
               [(1, "a", "x"), (0, "a", "x"), (700, None, "y")]]
    out = scratch_path(spark, "state-result")
    loc = _call_log(spark, batches[:2])
    for more in (None, batches[2]):
        if more:
            extra = _call_log(spark, [more])
            (spark.read.parquet(f"{extra}/police.calls.v1").withColumn("offset", F.col("offset") + 900)
             .coalesce(1).write.mode("append").parquet(f"{loc}/police.calls.v1"))
        good, _ = apps.call_stream(spark, loc, max_files_per_trigger=1)
        result = apps.start_call_state(good, out, "availableNow").wait()
        got = _window_rows(apps.read_call_state(spark, out))
        table, _ = split_malformed(TP.read_published(spark, loc, "police.calls.v1"), CALL)
        assert got == _window_rows(C.call_counts(table, sort=False))
        assert result.read(spark).columns == ["key", "value"]
    assert sorted(os.listdir(out.replace("file:", ""))) == ["_checkpoint"]
    codes = spark.createDataFrame([("x", "X-ray")], "disposition_code string, description string")
    assert apps.read_call_state(spark, out, codes).where("description = 'X-ray'").count() > 0


def test_state_reader_names_what_it_cannot_read(spark):
    rows = (spark.readStream.schema("a int").parquet(_int_folder(spark)))
    res = runner.start(rows, "no_state", "state").wait()
    with pytest.raises(ValueError):
        res.read(spark)


def _int_folder(spark):
    path = scratch_path(spark, "ints")
    spark.range(3).selectExpr("cast(id as int) a").write.mode("append").parquet(path)
    return path


def test_calls_app_modes(spark):
    loc = _call_log(spark, [[(0, "a", "x")], [(0, "a", "x"), (30, "a", "x")]])
    results = []
    for mode in ("state", "changes"):
        out = scratch_path(spark, f"app-{mode}")
        apps.main(["calls", "--source", loc, "--out", out, "--mode", mode, "--trigger", "availableNow",
                   "--max-files-per-trigger", "1"])
        if mode == "state":
            results.append(_window_rows(apps.read_call_state(spark, f"{out}/crime_type_count")))
        else:
            result = runner.StreamResult(None, f"{out}/crime_type_count", "changes",
                                         keys=["bucket_start", "original_crime_type_name", "disposition"])
            results.append(_window_rows(apps.read_call_counts(spark, result)))
    assert results[0] == results[1] and len(results[0]) == 9


def test_a_part_published_twice_is_read_once(spark):
    """By a stream that goes on and by one that starts anew; a part that was
    not finished is written again."""
    loc, out = scratch_path(spark, "log-replay"), scratch_path(spark, "replay-out")
    df = spark.range(5).withColumn("o", F.col("id"))
    for _ in range(2):
        TP.publish(df, None, ["id"], "t", loc, offset_col="o", batch=0)
        seen = runner.start(read_topic(spark, loc, "t"), "replayed", "append", path=out).wait()
    assert seen.read(spark).count() == 5
    anew = runner.start(read_topic(spark, loc, "t"), "anew", "append").wait()
    assert anew.read(spark).count() == 5
    (spark.range(3).select(F.lit(None).cast("binary").alias("key")).write.parquet(f"{loc}/u/batch={0:020d}"))
    TP.publish(df, None, ["id"], "u", loc, offset_col="o", batch=0)
    assert TP.read_published(spark, loc, "u").count() == 5
    # The summary and station jobs' own records go the same way.
    for _ in range(2):
        apps._put(TP.as_records(df, None, ["id"], "v", offset_col="o"), loc, "v", 7, "log")
    assert TP.part_done(spark, loc, "v", 7) and not TP.part_done(spark, loc, "v", 8)


@pytest.mark.parametrize("name", ["run_call_counts", "stream_call_queries"])
def test_registered_streams_take_several_triggers(spark, name):
    from dispatchboard.plans import streams
    from tests.conftest import SF_ORACLE
    found = getattr(streams, name)(spark, SF_ORACLE)
    for result in found if isinstance(found, tuple) else (found,):
        took = [p for p in result.query.recentProgress if p["numInputRows"]]
        assert len(took) >= 3


def test_a_broken_turnstile_message_replaces_nothing(spark):
    loc = scratch_path(spark, "log-broken-turnstile")
    good = '{"station_id":7,"station_name":"s","line":"red"}'
    rows = [('{"timestamp":1}', good, 0), ('{"timestamp":1}', "{", 1), ('{"timestamp":1}', '{"line":"red"}', 2),
            ('{"timestamp":2}', good, 3)]
    (spark.createDataFrame(rows, "key string, value string, offset long")
     .selectExpr("cast(key as binary) key", "cast(value as binary) value", "'t' topic", "0 partition", "offset",
                 "timestamp'2024-01-01' timestamp").coalesce(1).write.parquet(f"{loc}/t"))
    table = apps.start_turnstile_table(apps.turnstile_stream(spark, loc, topic="t"),
                                       scratch_path(spark, "broken-table"), "availableNow").wait().read(spark)
    assert {(r["key"], r["station_id"]) for r in table.collect()} == {(1, 7), (2, 7)}
