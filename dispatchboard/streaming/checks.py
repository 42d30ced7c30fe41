"""SNK-6 on a stream: the stop table's constraints, over all triggers.

``station_rules`` decide a row by itself. Uniqueness needs the keys of every
earlier trigger: a deduplication by key keeps them in the state store (a key
each, for good) and passes on the row that took its key first. A trigger's
rows that it doesn't pass on repeat a key. Rows and passed rows meet in the
batch step, grouped by key and place, so a key with a third of all rows is
spread over the tasks.

One write a trigger: rows that hold to all checks under ``fit=true``, the others
under ``fit=false`` with the names of the checks they fail; a replayed trigger
rewrites its own part. A refused row has taken its key nevertheless, as the
table's own check counts it. Null keys are no repeats of each other (they
fail ``not_null``). ``place`` columns tell rows apart: a message that is read
twice at one place is one row. Of a key's rows in one trigger any may be first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from dispatchboard.sinks.tables import station_rules
from dispatchboard.streaming.runner import StreamResult
from dispatchboard.streaming.triggers import trigger_kwargs


class CheckedLoad(StreamResult):
    """A running load; ``read`` gives the accepted rows, ``refused`` the
    others, a row per check they fail."""

    def __init__(self, query, path: str, rows: StructType):
        super().__init__(query, path, "checked")
        self._schema = StructType([*rows.fields, StructField("failed", ArrayType(StringType())),
                                   StructField("batch", LongType()), StructField("fit", BooleanType())])

    def _parts(self, spark: SparkSession, fit: bool) -> DataFrame:
        rows = spark.read.schema(self._schema).parquet(f"{self.path}/parts")
        return rows.where(F.col("fit") == fit).drop("fit", "batch")

    def read(self, spark: SparkSession) -> DataFrame:
        return self._parts(spark, True).drop("failed")

    def refused(self, spark: SparkSession) -> DataFrame:
        return self._parts(spark, False).withColumn("check", F.explode("failed")).drop("failed")


def start_checked_load(stops: DataFrame, out: str, trigger: str = "10 seconds", key: str = "stop_id",
                       place: Sequence[str] = ("offset",), name: str = "station_checks") -> CheckedLoad:
    """Load a stream of stop rows under ``out``, the offending ones apart."""
    path, row = out.rstrip("/"), F.struct(*stops.columns)
    met = (stops.select(row.alias("row"), F.lit(False).alias("first"))
           .unionByName(stops.dropDuplicates([key]).select(row.alias("row"), F.lit(True).alias("first"))))

    def sink(batch: DataFrame, batch_id: int) -> None:
        at = [F.col("row")[c] for c in (key, *place)]
        rows = (batch.groupBy(*[c.alias(f"_{i}") for i, c in enumerate(at)])
                .agg(F.any_value("row").alias("row"), F.max("first").alias("first")).select("row.*", "first"))
        repeated = ~F.col("first") & F.col(key).isNotNull()
        failed = F.array_compact(F.array(*[F.when(broken, F.lit(check)) for check, broken in (
            *station_rules(key), (f"unique_{key}", repeated))]))
        (rows.withColumn("failed", failed).drop("first").withColumn("fit", F.size("failed") == 0)
         .write.mode("overwrite").partitionBy("fit").parquet(f"{path}/parts/batch={batch_id:020d}"))

    q = (met.writeStream.queryName(name).outputMode("append").option("checkpointLocation", f"{path}/_checkpoint")
         .foreachBatch(sink).trigger(**trigger_kwargs(trigger)).start())
    return CheckedLoad(q, path, stops.schema)
