"""Starting streaming queries (STR-2 to STR-5, STR-8).

Results of a streaming query land in a folder under the shared checkpoint
root, never in driver memory:

* complete mode: each micro-batch writes the whole result as a new version
  (``v=<batch>``); readers take the newest committed version, and older ones
  are removed by age (``sinks.versions``).
* append mode: each micro-batch writes its own part (``batch=<id>``),
  overwritten on replay, so at-least-once delivery gives exactly-once files.
* update mode: rows are merged into a ``KeyedTable`` by key (small tables).
* state mode: the query writes nothing; its result is what its aggregate holds
  in the state store, read through Spark's state data source as of the last
  committed batch. Storage and reading cost grow with the result, not with
  the number of triggers.
* changes mode: update mode for results that grow with the input. A
  micro-batch writes only the rows it changed, as its own part, and a reader
  takes the newest row of each key. Every ``fold`` triggers the newest rows are
  written as a base and the parts of the fold before are removed, so a reader
  opens the base and at most ``2 * fold`` parts however long the query has run.

Every query has its own checkpoint folder, so a lost executor or a restarted
driver resumes from the last committed offsets and state.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from dispatchboard.operators.keyed import latest_by
from dispatchboard.session import scratch_path
from dispatchboard.sinks import versions
from dispatchboard.sinks.tables import KeyedTable
from dispatchboard.streaming.triggers import trigger_kwargs  # noqa: F401 (re-export)


# Triggers between two bases of a query in changes mode.
FOLD = 50


class StreamResult:
    """A started query and the folder its results go to."""

    def __init__(self, query, path: str, mode: str, table: KeyedTable | None = None, keys=()):
        self.query, self.path, self.mode, self.table, self.keys = query, path, mode, table, list(keys)

    def wait(self) -> "StreamResult":
        self.query.awaitTermination()
        if self.query.exception() is not None:
            raise RuntimeError(str(self.query.exception()))
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        if self.mode == "state":
            return read_state(spark, f"{self.path}/_checkpoint")
        if self.mode == "update":
            return self.table.read()
        if self.mode == "complete":
            return versions.read_latest(spark, self.path)
        if self.mode == "changes":
            return read_changes(spark, self.path, self.keys)
        return spark.read.parquet(f"{self.path}/parts").drop("batch")


def state_operator(spark: SparkSession, checkpoint: str, operator: str = "stateStoreSave") -> tuple[int, int]:
    """Id of a query's one operator of that name and the last batch its state
    was committed for. A few short metadata rows come to the driver."""
    known = (spark.read.format("state-metadata").load(checkpoint)
             .where(F.col("operatorName") == operator)
             .groupBy("operatorId").agg(F.max("maxBatchId").alias("batch")).collect())
    if len(known) != 1:
        raise ValueError(f"{len(known)} operators named {operator!r} keep state under {checkpoint}")
    return known[0]["operatorId"], known[0]["batch"]


def read_state(spark: SparkSession, checkpoint: str, operator: str = "stateStoreSave") -> DataFrame:
    """Keys and values that a query's one operator of that name (the
    aggregate's, by default) holds in state as of its last committed batch:
    ``key, value``. Works next to the running query and after it has ended;
    a query that has committed nothing yet is an error."""
    operator_id, _ = state_operator(spark, checkpoint, operator)
    held = spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)
    return held.select("key", "value")


def _part(path: str, batch_id: int) -> str:
    return f"{path}/parts/batch={batch_id:020d}"


def read_changes(spark: SparkSession, path: str, keys: Sequence[str], below: int | None = None) -> DataFrame:
    """Newest row of each key of a query in changes mode: its newest base (of
    a trigger ``below`` the given one) and the parts after it."""
    folded = versions.latest(spark, f"{path}/base", below)
    rows = spark.read.parquet(f"{path}/parts")
    if folded is not None:
        base = spark.read.parquet(versions.version_path(f"{path}/base", folded))
        rows = (rows.where(F.col("batch") > folded)
                .unionByName(base.withColumn("batch", F.lit(folded).cast(rows.schema["batch"].dataType))))
    return latest_by(rows, keys, "batch", [c for c in rows.columns if c not in (*keys, "batch")])


def fold_changes(spark: SparkSession, path: str, keys: Sequence[str], batch_id: int, fold: int) -> None:
    """Write the newest rows as of trigger ``batch_id`` as a base, and remove
    the parts of the fold before, whose readers have had ``fold`` triggers to
    end. Replayed, it makes the same base from the one before."""
    versions.commit(read_changes(spark, path, keys, below=batch_id), f"{path}/base", batch_id)
    for old in range(max(0, batch_id - 2 * fold + 1), batch_id - fold + 1):
        versions.remove(spark, _part(path, old))


def start(df: DataFrame, name: str, mode: str = "complete",
          trigger: str = "availableNow", keys: Sequence[str] | None = None,
          path: str | None = None, transform=None, fold: int = FOLD) -> StreamResult:
    """Start ``df`` (a streaming frame) as query ``name`` writing to a folder.

    ``keys`` are required for update and changes mode: later batches win. ``transform`` (complete mode) maps each micro-batch's
    full result, a static frame, before it is written; batch-only steps such
    as a second aggregation go there. ``fold`` is for changes mode.
    """
    spark = df.sparkSession
    path = (path or scratch_path(spark, name)).rstrip("/")
    table = None

    if mode == "complete":
        def sink(batch: DataFrame, batch_id: int) -> None:
            if transform is not None:
                batch = transform(batch)
            versions.commit(batch, path, batch_id)
    elif mode in ("append", "changes"):
        if mode == "changes" and not keys:
            raise ValueError("changes mode needs keys")

        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(_part(path, batch_id))
            if mode == "changes" and (batch_id + 1) % fold == 0:
                fold_changes(spark, path, keys, batch_id, fold)
    elif mode == "state":
        sink = None
    elif mode == "update":
        if not keys:
            raise ValueError("update mode needs keys")
        table = KeyedTable(spark, f"{path}/table", keys, ["_batch"])

        def sink(batch: DataFrame, batch_id: int) -> None:
            table.upsert(batch.withColumn("_batch", F.lit(batch_id)), batch_id)
    else:
        raise ValueError(f"unknown output mode {mode!r}")

    writer = (df.writeStream.queryName(name).outputMode("update" if mode in ("changes", "state") else mode)
              .option("checkpointLocation", f"{path}/_checkpoint"))
    writer = writer.format("noop") if sink is None else writer.foreachBatch(sink)
    q = writer.trigger(**trigger_kwargs(trigger)).start()
    return StreamResult(q, path, mode, table, keys or ())


def run(df: DataFrame, name: str, mode: str = "complete", keys=None) -> DataFrame:
    """Drain the available input through the query and return its result."""
    spark = df.sparkSession
    res = start(df, name, mode, "availableNow", keys).wait()
    out = res.read(spark)
    return out.drop("_batch") if "_batch" in out.columns else out


# STR-5
class ProgressTable(StreamingQueryListener):
    """Every progress report of the session's queries as rows of a table at
    ``path``, however many there are: reports are held until ``hold`` of them
    are written together, and the rest when the table is read."""

    COLUMNS = ("query string, id string, batch_id long, num_input_rows long, "
               "input_rows_per_second double, processed_rows_per_second double, trigger_ms long")

    def __init__(self, spark: SparkSession, path: str, hold: int = 1000):
        self.spark, self.path, self.hold = spark, path, hold
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._lock = threading.Lock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            self._rows.append((p.name or "", str(p.id), int(p.batchId), int(p.numInputRows),
                               float(p.inputRowsPerSecond or 0.0), float(p.processedRowsPerSecond or 0.0),
                               int((p.durationMs or {}).get("triggerExecution", 0))))
            full = len(self._rows) >= self.hold
        if full:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.id))

    def _write(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, self.COLUMNS).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, *queries, seconds: float = 60.0) -> "ProgressTable":
        """Until the reports of the given ended queries have all arrived."""
        left = time.monotonic() + seconds
        while not {str(q.id) for q in queries} <= self._ended:
            if time.monotonic() > left:
                raise TimeoutError("progress reports did not arrive")
            time.sleep(0.05)
        return self

    def read(self) -> DataFrame:
        self._write()
        return self.spark.read.schema(self.COLUMNS).parquet(self.path)

    def close(self) -> None:
        self.spark.streams.removeListener(self)
        self._write()
