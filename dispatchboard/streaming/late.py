"""STR-1 with a side output: the bounded flagship, and the calls it refuses.

Spark drops a row that is no later than the watermark of the trigger before
and tells only how many. Here one query carries two branches of the same
calls: the bounded counts (watermark below the dedup, append mode) and the
calls as they are. Both come to the batch step in the same trigger, which
keeps the counts that closed, and of the calls those that the watermark
refused, each with that watermark. So every call is counted or is in the late
output, and none is in both.

Counts are kept and written per slide bucket: a call is in one row of state
and of the parts, not in the six windows that cover it.

The watermark a trigger refuses by follows from the latest call times seen:
the ``marks`` folder keeps, per trigger, the latest up to and including it.
Trigger n refuses by the mark of trigger n - 2 less the delay (its own
eviction uses the mark of n - 1), at 1970 before that; in whole milliseconds,
as Spark keeps it. A call without a time is in no window and never late.

Buckets still open are in the state store: ``read`` adds them and turns the
buckets into windows, so the result holds all accepted calls at any moment,
not only closed windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from dispatchboard.operators import calls as C
from dispatchboard.sinks import versions
from dispatchboard.streaming.runner import StreamResult, state_operator
from dispatchboard.streaming.triggers import trigger_kwargs


class BoundedCounts(StreamResult):
    """A started query, its counts and its late calls."""

    def __init__(self, query, path: str, schema: StructType):
        super().__init__(query, path, "bounded")
        self._schema = schema

    def _parts(self, spark: SparkSession, kind: str) -> DataFrame:
        return spark.read.schema(self._schema).parquet(f"{self.path}/parts").where(F.col("kind") == kind)

    def late(self, spark: SparkSession) -> DataFrame:
        """The refused calls, whole, and ``refused_by``, the watermark."""
        return self._parts(spark, "late").select("call.*", "refused_by")

    def read(self, spark: SparkSession) -> DataFrame:
        """Counts per window of all accepted calls, as of the last committed
        trigger: closed buckets as written, open ones as they are in state."""
        checkpoint = f"{self.path}/_checkpoint"
        operator, batch_id = state_operator(spark, checkpoint)
        closed = self._parts(spark, "bucket").where(F.col("batch") <= batch_id).select("counted.*")
        held = (spark.read.format("statestore").option("operatorId", operator)
                .option("batchId", batch_id).load(checkpoint))
        bucket, kind, disposition = (F.col("key")[f] for f in held.schema["key"].dataType.names)
        count = held.schema["value"].dataType.names[0]
        return C.windows_from_buckets(closed.unionByName(held.select(
            bucket["start"].alias("bucket_start"), kind.alias(C.TYPE_COL),
            disposition.alias(C.DISPOSITION_COL), F.col("value")[count].alias("call_count"))))


def _seconds_ms(delay: str) -> int:
    return C._seconds(delay) * 1000


def start_bounded_counts(calls: DataFrame, out: str, trigger: str = "10 seconds",
                         name: str = "crime_type_count_bounded",
                         delay: str = C.WATERMARK_DELAY) -> BoundedCounts:
    """The bounded flagship over a decoded call stream, under ``out``. A
    replayed trigger rewrites its own part and mark."""
    spark, path, time = calls.sparkSession, out.rstrip("/"), F.col(f"call.{C.TIME_COL}")
    counted = C.bounded_bucket_counts(calls, delay)
    kinds = F.struct(*counted.columns), F.struct(*calls.columns)
    both = (counted.select(F.lit("bucket").alias("kind"), kinds[0].alias("counted"))
            .unionByName(calls.select(F.lit("late").alias("kind"), kinds[1].alias("call")),
                         allowMissingColumns=True))

    def mark_path(batch_id: int) -> str:
        return f"{path}/marks/batch={batch_id:020d}"

    def mark(batch_id: int) -> int:
        """Latest call time, in milliseconds, up to that trigger."""
        return spark.read.parquet(mark_path(batch_id)).first()["latest"] if batch_id >= 0 else 0

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # written and measured: the stateful plan runs once
        try:
            refused = F.timestamp_millis(F.lit(max(0, mark(batch_id - 2) - _seconds_ms(delay))))
            (batch.where((F.col("kind") == "bucket") | (time <= refused))
             .withColumn("refused_by", F.when(F.col("kind") == "late", refused))
             .write.mode("overwrite").partitionBy("kind").parquet(f"{path}/parts/batch={batch_id:020d}"))
            latest = batch.agg(F.max(F.unix_millis(time)).alias("m")).first()["m"]
            latest = max(mark(batch_id - 1), latest or 0)
            (spark.createDataFrame([(latest,)], "latest long").coalesce(1)
             .write.mode("overwrite").parquet(mark_path(batch_id)))
            if batch_id > 3:
                versions.remove(spark, mark_path(batch_id - 4))
        finally:
            batch.unpersist()

    q = (both.writeStream.queryName(name).outputMode("append")
         .option("checkpointLocation", f"{path}/_checkpoint").foreachBatch(sink)
         .trigger(**trigger_kwargs(trigger)).start())
    fields = [f for f in both.schema.fields if f.name != "kind"]
    return BoundedCounts(q, path, StructType([*fields, StructField("refused_by", TimestampType()),
                                              StructField("batch", LongType()), StructField("kind", StringType())]))
