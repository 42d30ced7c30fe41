"""AGG-1, WIN-1 as a stream of changes: what every trigger adds to the
windows its new calls touch.

The dedup's state passes on each (time, type, disposition) triple once, in the
trigger it is first seen. A batch step counts these new triples per slide
bucket and adds every changed bucket to the windows that cover it, so a
trigger writes at most ``length / slide`` rows a changed bucket and reads
nothing it wrote before. A window's count is the sum of its ``change`` rows;
a sum has no order, so parts may be read, merged and replayed in any.

Every ``fold`` triggers the parts are summed into a base (a version of
``sinks.versions``), and the parts of the fold before are removed: a reader
opens the base and at most ``2 * fold`` parts however long the query has run.

A type of null keeps its group with a count of 0, a null time falls in no
window, repeated calls change nothing, and a trigger without new triples
writes an empty part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from dispatchboard.operators import calls as C
from dispatchboard.operators.keyed import distinct_calls
from dispatchboard.sinks import versions
from dispatchboard.streaming.runner import StreamResult
from dispatchboard.streaming.triggers import trigger_kwargs

GROUP = ("window_start", "window_end", C.TYPE_COL, C.DISPOSITION_COL)
SCHEMA = StructType([StructField("window_start", TimestampNTZType()), StructField("window_end", TimestampNTZType()),
                     StructField(C.TYPE_COL, StringType()), StructField(C.DISPOSITION_COL, StringType()),
                     StructField("change", LongType()), StructField("batch", LongType())])
FOLD = 50


def window_changes(triples: DataFrame) -> DataFrame:
    """What a table of new distinct triples adds to each window."""
    return C.windows_from_buckets(C.bucket_counts(triples)).withColumnRenamed("call_count", "change")


def _part(path: str, batch_id: int) -> str:
    return f"{path}/parts/batch={batch_id:020d}"


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All parts that are still there, with the trigger (``batch``) of each row."""
    return spark.read.schema(SCHEMA).parquet(f"{path}/parts")


def read_delta_counts(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """Window counts: the newest base (of a trigger ``below`` the given one)
    and the parts after it, summed."""
    folded = versions.latest(spark, f"{path}/base", below)
    rows = read_changes(spark, path)
    if folded is not None:
        base = spark.read.schema(StructType(SCHEMA.fields[:-1])).parquet(
            versions.version_path(f"{path}/base", folded))
        rows = rows.where(F.col("batch") > folded).drop("batch").unionByName(base)
    return rows.groupBy(*GROUP).agg(F.sum("change").alias("call_count"))


def fold_parts(spark: SparkSession, path: str, batch_id: int, fold: int) -> None:
    """Sum all up to trigger ``batch_id`` into a base, and remove the parts of
    the fold before, whose readers have had ``fold`` triggers to end. Replayed,
    it makes the same base from the one before."""
    base = read_delta_counts(spark, path, below=batch_id).withColumnRenamed("call_count", "change")
    versions.commit(base, f"{path}/base", batch_id)
    for old in range(max(0, batch_id - 2 * fold + 1), batch_id - fold + 1):
        versions.remove(spark, _part(path, old))


def start_call_deltas(calls: DataFrame, out: str, trigger: str = "10 seconds",
                      name: str = "crime_type_deltas", fold: int = FOLD) -> StreamResult:
    """The flagship's counts as changes under ``out``, read with
    ``read_delta_counts``. A replayed trigger rewrites its own part."""
    spark, path = calls.sparkSession, out.rstrip("/")
    triples = distinct_calls(calls, (C.TIME_COL, C.TYPE_COL, C.DISPOSITION_COL))

    def sink(batch: DataFrame, batch_id: int) -> None:
        window_changes(batch).write.mode("overwrite").parquet(_part(path, batch_id))
        if (batch_id + 1) % fold == 0:
            fold_parts(spark, path, batch_id, fold)

    q = (triples.writeStream.queryName(name).outputMode("append")
         .option("checkpointLocation", f"{path}/_checkpoint").foreachBatch(sink)
         .trigger(**trigger_kwargs(trigger)).start())
    return StreamResult(q, path, "deltas")
