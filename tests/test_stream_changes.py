"""Windows kept by changes, and the late calls' side output."""

import datetime as dt
import os

from pyspark.sql import functions as F

from dispatchboard.operators import calls as C
from dispatchboard.session import scratch_path
from dispatchboard.streaming import apps, runner
from dispatchboard.streaming.deltas import fold_parts, read_changes, read_delta_counts, start_call_deltas
from dispatchboard.streaming.late import start_bounded_counts

DDL = "call_date_time timestamp, original_crime_type_name string, disposition string, offset long"
DAY = dt.datetime(2024, 1, 1)


def _at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


def _stream(spark, batches, path=None):
    """A stream of calls (minutes, type, disposition), one trigger a batch."""
    path = path or scratch_path(spark, "calls-in")
    at = len(os.listdir(path.replace("file:", "")))
    for i, rows in enumerate(batches, at):
        (spark.createDataFrame([(_at(m), kind, d, 100 * i + k) for k, (m, kind, d) in enumerate(rows)], DDL)
         .coalesce(1).write.parquet(f"{path}/f{i}"))
    calls = (spark.readStream.schema(DDL).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", 1).parquet(path))
    return calls, path


def _table(spark, batches):
    rows = [(_at(m), kind, d, 0) for batch in batches for m, kind, d in batch]
    return C.call_counts(spark.createDataFrame(rows, DDL), sort=False)


def _rows(df):
    return sorted(map(str, df.select("window_start", "window_end", C.TYPE_COL, C.DISPOSITION_COL, "call_count")
                      .collect()))


BATCHES = [[(0, "a", "x"), (0, "a", "x"), (5, "a", "x"), (9, None, "y")],
           [(0, "a", "x"), (9, None, "y")],                      # seen before: nothing changes
           [(7, "a", "x"), (300, "b", None), (None, "a", "x")],  # one old bucket, one new, one call without a time
           [(1, "a", "x"), (2, "a", "x"), (3, "a", "x")],        # late calls count
           [(900, "c", "z")]]


def test_summed_changes_are_the_counts_whatever_the_fold(spark):
    for fold in (1, 2, 50):
        calls, _ = _stream(spark, BATCHES)
        out = scratch_path(spark, "deltas")
        start_call_deltas(calls, out, "availableNow", fold=fold).wait()
        assert _rows(read_delta_counts(spark, out)) == _rows(_table(spark, BATCHES))


def test_a_trigger_writes_only_the_windows_it_touches(spark):
    calls, _ = _stream(spark, BATCHES)
    out = scratch_path(spark, "deltas")
    start_call_deltas(calls, out, "availableNow").wait()
    rows = read_changes(spark, out).groupBy("batch").agg(F.count("*").alias("n"), F.sum("change").alias("s"))
    got = {r["batch"]: (r["n"], r["s"]) for r in rows.collect()}
    # Changed buckets: 2, none, 2, 1, 1; a null type's group adds rows, not counts.
    assert got == {0: (12, 12), 2: (12, 12), 3: (6, 18), 4: (6, 6)}


def test_changes_go_on_after_a_restart_and_old_parts_go(spark):
    out, path = scratch_path(spark, "deltas"), None
    for k in range(len(BATCHES)):
        calls, path = _stream(spark, BATCHES[k:k + 1], path)
        start_call_deltas(calls, out, "availableNow", fold=2).wait()
        assert _rows(read_delta_counts(spark, out)) == _rows(_table(spark, BATCHES[:k + 1]))
    parts = sorted(p for p in os.listdir(f"{out.replace('file:', '')}/parts") if p.startswith("batch="))
    assert [int(p[6:]) for p in parts] == [2, 3, 4]
    # The last part again, as a replayed trigger writes it.
    last = f"{out}/parts/batch={4:020d}"
    kept = [tuple(r) for r in spark.read.parquet(last).collect()]
    spark.createDataFrame(kept, spark.read.parquet(last).schema).write.mode("overwrite").parquet(last)
    assert _rows(read_delta_counts(spark, out)) == _rows(_table(spark, BATCHES))
    for _ in range(2):  # a trigger that folds, replayed
        fold_parts(spark, out, 4, 1)
        assert _rows(read_delta_counts(spark, out)) == _rows(_table(spark, BATCHES))


# Trigger by trigger; a trigger's late calls are those no later than the
# watermark of the trigger before it: an hour less than the latest call then.
LATE = [[(720, "a", "x")],                                   # no watermark yet
        [(100, "a", "x"), (750, "a", "x")],                  # refused by nothing: the mark of trigger -1
        [(660, "b", "x"), (661, "b", "x")],                  # watermark 660 (12:00 less an hour), inclusive
        [(690, "c", None), (691, None, "y"), (None, "a", "x")],  # watermark 690
        [(691, None, "y")]]                                  # a repeat, in time


def test_late_calls_come_with_the_watermark_that_refused_them(spark):
    calls, _ = _stream(spark, LATE)
    result = start_bounded_counts(calls, scratch_path(spark, "bounded"), "availableNow").wait()
    late = {r["offset"]: (r["original_crime_type_name"], r["refused_by"]) for r in result.late(spark).collect()}
    assert late == {200: ("b", _at(660)), 300: ("c", _at(690))}
    taken = [[c for k, c in enumerate(batch) if 100 * i + k not in late] for i, batch in enumerate(LATE)]
    assert _rows(result.read(spark)) == _rows(_table(spark, taken))


def test_every_call_is_counted_or_late_over_restarts(spark):
    """Distinct calls in waves, some long before the wave's time."""
    waves = [[(60 * n + 7 * k, "abc"[k % 3], str(n)) for k in range(8)]
             + [(60 * (n - 4) + k + 1, "late", str(n)) for k in range(3)] for n in range(4, 10)]
    out, path = scratch_path(spark, "bounded"), None
    for n in range(0, len(waves), 2):
        calls, path = _stream(spark, waves[n:n + 2], path)
        result = start_bounded_counts(calls, out, "availableNow").wait()
    counted = result.read(spark).agg(F.sum("call_count")).first()[0]
    late = result.late(spark).count()
    assert late > 0 and counted % 6 == 0 and counted // 6 + late == sum(map(len, waves))
    marks = [p for p in os.listdir(f"{out.replace('file:', '')}/marks") if p.startswith("batch=")]
    assert len(marks) <= 4


def test_distinct_calls_within_a_bound_forget_what_they_passed_on(spark):
    batches = [[(k, "a", "x") for k in range(30)] + [(k, "a", "x") for k in range(30)] + [(None, "a", "x")],
               [(29, "a", "x"), (29, None, None), (29, None, None)],  # inside the bound
               [(600, "a", "x")], [(601, "a", "x")],
               [(5, "a", "x"), (601, "a", "x")]]                     # a repeat long after it, refused
    calls, _ = _stream(spark, batches)
    result = runner.start(C.distinct_calls_within(calls), "within", "append").wait()
    got = [(r[C.TIME_COL], r[C.TYPE_COL], r[C.DISPOSITION_COL]) for r in result.read(spark).collect()]
    want = {(_at(m), kind, d) for batch in batches for m, kind, d in batch if m is not None}
    assert len(got) == len(want) and set(got) == want
    held = [p["stateOperators"][0]["numRowsTotal"] for p in result.query.recentProgress if p["stateOperators"]]
    assert max(held) >= 31 and held[-1] <= 2
    table = spark.createDataFrame([(_at(0), "a", "x", 0), (_at(0), "a", "x", 1), (None, "a", "x", 2)], DDL)
    assert C.distinct_calls_within(table).count() == 1


def test_app_modes(spark):
    from tests.test_stream_results import _call_log
    loc = _call_log(spark, [[(0, "a", "x")], [(0, "a", "x"), (30, "a", "x")]])
    for mode in ("deltas", "bounded"):
        out = scratch_path(spark, f"app-{mode}")
        apps.main(["calls", "--source", loc, "--out", out, "--mode", mode, "--trigger", "availableNow",
                   "--max-files-per-trigger", "1"])
        assert os.path.isdir(f"{out.replace('file:', '')}/crime_type_count/parts")
