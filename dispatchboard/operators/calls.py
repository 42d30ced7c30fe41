"""Police-call analytics: distinct calls counted in sliding event-time windows,
then described from the disposition code table.

Batch plan: scan -> project 3 columns -> hash aggregate (dedup, partial +
final, shuffled on the full triple, so no hot key can pile up in one task)
-> count per 10-minute bucket (partial + final) -> expand each bucket group
into the 6 windows that cover it -> partial sum -> shuffle on (window, type,
disposition) -> final sum -> range-sorted output. Counting buckets first
means the 6-fold expansion runs over bucket groups, not over every call.
The code table joins by broadcast once its size is proven small. A stream
keeps the bucket counts in state and expands them per trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchboard.operators.keyed import distinct_calls

TIME_COL = "call_date_time"
TYPE_COL = "original_crime_type_name"
DISPOSITION_COL = "disposition"
WINDOW_LENGTH = "1 hour"
WINDOW_SLIDE = "10 minutes"
WATERMARK_DELAY = "1 hour"


def _watermarked(df: DataFrame, time_col: str, delay: str) -> DataFrame:
    # A watermark only means something on a stream; on a table it is skipped
    # (it would also refuse the zone-less timestamps of stored tables).
    return df.withWatermark(time_col, delay) if df.isStreaming else df


# WIN-1 + AGG-1
def windowed_counts(df: DataFrame, time_col: str = TIME_COL,
                    type_col: str = TYPE_COL,
                    disposition_col: str = DISPOSITION_COL,
                    length: str = WINDOW_LENGTH,
                    slide: str = WINDOW_SLIDE) -> DataFrame:
    """Count of non-null types per (window, type, disposition).

    Windows are half-open and aligned to the epoch; a row with a null time
    falls in no window; a null type forms its own group with count 0.
    """
    win = F.window(F.col(time_col), length, slide)
    return (df.groupBy(win.alias("window"), F.col(type_col), F.col(disposition_col))
            .agg(F.count(type_col).alias("call_count"))
            .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                    type_col, disposition_col, "call_count"))


# SRT-1
def by_count_desc(df: DataFrame, col: str = "call_count") -> DataFrame:
    """Largest counts first. The window and group columns break ties: a
    range-partitioned sort cannot split rows with equal sort keys, and most
    windows share a few small counts, so without them one task would sort
    most of the result."""
    ties = [c for c in ("window_start", TYPE_COL, DISPOSITION_COL) if c in df.columns]
    return df.orderBy(F.col(col).desc(), *ties)


# DED-1 within a bound
def distinct_calls_within(calls: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Distinct (time, type, disposition) triples of a stream whose repeats
    come at most ``delay`` behind the latest call: each triple is passed on
    once, and its state goes when the watermark is ``delay`` past it. A repeat
    behind the watermark is refused, so none comes twice. Calls
    without a time can't expire and are left out; on a table all repeats go."""
    timed = calls.select(TIME_COL, TYPE_COL, DISPOSITION_COL).where(F.col(TIME_COL).isNotNull())
    if not calls.isStreaming:
        return timed.distinct()
    return timed.withWatermark(TIME_COL, delay).dropDuplicatesWithinWatermark([TIME_COL, TYPE_COL, DISPOSITION_COL])


# Flagship: DED-1, STR-1, WIN-1, AGG-1, SRT-1 (reference semantics).
def call_counts(calls: DataFrame, sort: bool = True) -> DataFrame:
    """Distinct (time, type, disposition) triples counted in 1-hour windows
    sliding by 10 minutes, largest counts first.

    As in the reference the watermark sits above the dedup, so on a stream it
    bounds nothing and the query must run in complete mode with state that
    grows with the input; ``bounded_call_counts`` is the variant for long runs.
    """
    d = distinct_calls(calls, (TIME_COL, TYPE_COL, DISPOSITION_COL))
    if calls.isStreaming:
        # one streaming aggregation only: Spark's window() directly
        out = windowed_counts(_watermarked(d, TIME_COL, WATERMARK_DELAY))
    else:
        out = windows_from_buckets(bucket_counts(d))
    return by_count_desc(out) if sort else out


def bounded_call_counts(calls: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Watermark below the dedup so both state stores shrink; append mode.

    Rows later than the watermark are dropped by Spark; counts of windows
    still open are emitted once they close. Use for unbounded runs only.
    """
    return windowed_counts(_bounded_calls(calls, delay))


def bounded_bucket_counts(calls: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """The same calls counted per slide bucket, emitted once the bucket has
    closed: a call is in one row of state, not in each window that covers it.
    ``windows_from_buckets`` adds the buckets into windows."""
    return bucket_counts(_bounded_calls(calls, delay))


def _bounded_calls(calls: DataFrame, delay: str) -> DataFrame:
    d = _watermarked(calls.select(TIME_COL, TYPE_COL, DISPOSITION_COL), TIME_COL, delay)
    return d.dropDuplicates([TIME_COL, TYPE_COL, DISPOSITION_COL])


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


# WIN-1 split in two exact steps, for streams: a stream keeps counts per
# slide-sized bucket (1/6 of the window keys in state), and each micro-batch
# adds six neighbouring buckets into each window. A window of 1 hour aligned
# to the epoch is exactly the six 10-minute buckets it starts at or covers.
def bucket_counts(df: DataFrame, time_col: str = TIME_COL, type_col: str = TYPE_COL,
                  disposition_col: str = DISPOSITION_COL,
                  slide: str = WINDOW_SLIDE) -> DataFrame:
    b = F.window(F.col(time_col), slide)
    return (df.groupBy(b.alias("bucket"), F.col(type_col), F.col(disposition_col))
            .agg(F.count(type_col).alias("call_count"))
            .select(F.col("bucket.start").alias("bucket_start"), type_col,
                    disposition_col, "call_count"))


def windows_from_buckets(buckets: DataFrame, type_col: str = TYPE_COL,
                         disposition_col: str = DISPOSITION_COL,
                         length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE
                         ) -> DataFrame:
    length_s, slide_s = _seconds(length), _seconds(slide)
    if length_s % slide_s:
        raise ValueError("window length must be a multiple of the slide")
    k = length_s // slide_s
    start_us = F.unix_micros(F.col("bucket_start").cast("timestamp"))
    ws = F.timestamp_micros(start_us - F.col("_i").cast("bigint") * F.lit(slide_s * 1_000_000))
    return (buckets.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .groupBy(ws.alias("ws"), F.col(type_col), F.col(disposition_col))
            .agg(F.sum("call_count").alias("call_count"))
            .select(F.col("ws").cast("timestamp_ntz").alias("window_start"),
                    (F.col("ws") + F.expr(f"INTERVAL {length_s} SECONDS"))
                    .cast("timestamp_ntz").alias("window_end"),
                    type_col, disposition_col, "call_count"))


def call_bucket_counts(calls: DataFrame) -> DataFrame:
    """Streaming half of the flagship: distinct triples, counted per bucket.
    No watermark: in complete mode it would have no effect, as in the
    reference, and in the other modes Spark would drop calls that come late
    and forget buckets that are part of the result."""
    return bucket_counts(distinct_calls(calls, (TIME_COL, TYPE_COL, DISPOSITION_COL)))


# PRJ-4
def disposition_lookup(codes: DataFrame) -> DataFrame:
    return codes.withColumnRenamed("disposition_code", DISPOSITION_COL)


# JOI-1
def prepared_codes(codes: DataFrame) -> DataFrame:
    """The code table as the join's right side, renamed (PRJ-4). Spark
    broadcasts it where its real size is below the session's threshold."""
    return disposition_lookup(codes)


def join_disposition(counts: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on ``disposition`` (USING: the key appears once, first).
    A null disposition never matches; a code listed twice doubles its rows."""
    return counts.join(lookup, on=DISPOSITION_COL, how="left")


def with_disposition(counts: DataFrame, codes: DataFrame) -> DataFrame:
    return join_disposition(counts, prepared_codes(codes))
