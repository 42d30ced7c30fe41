"""What one task of a stream holds, and how often a trigger runs its plan."""

import datetime as dt

from pyspark.sql import functions as F

from dispatchboard.functions import scalars as S
from dispatchboard.operators import calls as C
from dispatchboard.plans import fixtures as X
from dispatchboard.plans import streams
from dispatchboard.session import scratch_path
from dispatchboard.sinks.topics import publish, topic_files
from dispatchboard.sources.topics import read_topic
from dispatchboard.streaming import apps
from dispatchboard.streaming.late import start_bounded_counts
from tests.conftest import SF_SMALL

DAY = dt.datetime(2024, 1, 1)


def test_summary_query_keeps_state_partitions_in_tasks_of_their_own(spark, monkeypatch):
    loc, plans, put = scratch_path(spark, "log-turnstile"), [], apps._put

    def seen(records, *rest):
        plans.append(records._jdf.queryExecution().optimizedPlan().toString())
        put(records, *rest)
    monkeypatch.setattr(apps, "_put", seen)
    rows = spark.range(600).select((F.col("id") % 40).alias("station_id"), F.lit("s").alias("station_name"),
                                   F.lit("red").alias("line"), F.col("id").alias("offset"))
    publish(rows, None, ["station_id", "station_name", "line"], S.TOPIC_TURNSTILE, loc, offset_col="offset")
    q = apps.start_summary_query(spark, apps.turnstile_stream(spark, loc), loc, "availableNow")
    q.awaitTermination()
    assert q.exception() is None
    assert plans and not any("Repartition 1, false" in p for p in plans)  # what coalesce(1) is
    counts = (read_topic(spark, loc, S.TOPIC_SUMMARY, stream=False)
              .select(F.from_json(F.col("value").cast("string"), "station_id int, count long").alias("v")).select("v.*"))
    assert sorted(map(tuple, counts.collect())) == [(s, 15) for s in range(40)]
    assert topic_files(spark, loc, S.TOPIC_SUMMARY) == 1  # few rows are still one file


def test_bounded_counts_keep_a_call_in_one_row_of_state_and_parts(spark):
    """Not in each of the six windows that cover it."""
    rows = spark.range(300).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("call_date_time"),
        F.lit("a").alias("original_crime_type_name"), F.lit("x").alias("disposition"), F.col("id").alias("offset"))
    loc, out = scratch_path(spark, "log-bounded"), scratch_path(spark, "bounded")
    publish(rows, None, rows.columns[:-1], S.TOPIC_CALLS, loc, offset_col="offset")
    good, _ = apps.call_stream(spark, loc)
    result = start_bounded_counts(good, out, "availableNow").wait()
    held = [o["numRowsUpdated"] for p in result.query.recentProgress for o in p["stateOperators"]]
    assert max(held) == 300
    assert spark.read.parquet(f"{out}/parts").count() <= 300
    want = C.call_counts(rows, sort=False)
    got = result.read(spark)
    assert got.count() == 1800 and got.exceptAll(want).isEmpty()


def test_named_queries_write_a_result_once(spark):
    """Not in every trigger again; both whole, as the batch gives them."""
    q1, q2 = streams.stream_call_queries(spark, SF_SMALL)
    want = C.call_counts(X.calls(spark, SF_SMALL), sort=False)
    for q, result in ((q1, want), (q2, C.with_disposition(want, X.codes(spark, SF_SMALL)))):
        assert len(q.query.recentProgress) >= 3
        buckets = C.bucket_counts(C.distinct_calls(X.calls(spark, SF_SMALL)))
        parts = spark.read.parquet(f"{q.path}/parts")
        assert parts.select(*q.keys).distinct().count() == buckets.count()
        assert parts.groupBy("batch").count().agg(F.sum("count")).first()[0] < 2 * buckets.count()
        got = spark.read.parquet(f"{q.path}/result").select(result.columns)
        assert got.count() == result.count() and got.exceptAll(result).isEmpty()
