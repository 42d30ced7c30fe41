"""Keyed upsert table with changelog (SNK-3), console (SNK-1), create-if-absent
tables (SNK-5) and constrained-load checks (SNK-6)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.operators.keyed import latest_by
from dispatchboard.sinks import versions
from dispatchboard.schemas import STOPS_MAX_LENGTH, STOPS_NOT_NULL



# SNK-1
def start_console(df: DataFrame, name: str, mode: str = "complete",
                  trigger: str = "10 seconds"):
    """Full result after every trigger, untruncated (debug output only; the
    console sink brings each result to the driver)."""
    from dispatchboard.streaming.triggers import trigger_kwargs
    return (df.writeStream.format("console").outputMode(mode)
            .option("truncate", "false").option("numRows", (1 << 31) - 1)
            .queryName(name).trigger(**trigger_kwargs(trigger)).start())


class VersionedTable:
    """A table kept as immutable versions ``v=<batch_id>`` (see
    ``sinks.versions``). Writing version ``batch_id`` from the newest version
    before it makes a replayed micro-batch rewrite its own version with the
    same contents, so ``foreachBatch`` delivery (at least once) gives
    exactly-once contents. Readers only ever see a committed version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame | None:
        return versions.read_latest(self.spark, self.path)

    def _base(self, batch_id: int) -> DataFrame | None:
        return versions.read_latest(self.spark, self.path, below=batch_id)

    def _commit(self, df: DataFrame, batch_id: int) -> None:
        versions.commit(df, self.path, batch_id)


# SNK-3
class KeyedTable(VersionedTable):
    """Latest row per key, kept as immutable versions.

    ``upsert(batch_df, batch_id)`` merges a micro-batch into the version
    before ``batch_id`` and writes version ``batch_id``. Each upsert rewrites
    the table, which suits tables the size of a station list or a board;
    a keyed table that grows with the input belongs in the state store
    (``runner`` modes changes and state).
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str],
                 order: Sequence[str], changelog: str | None = None,
                 as_log: Callable[[DataFrame], DataFrame] | None = None):
        """``changelog`` is the folder of a topic log; ``as_log`` makes a
        batch's rows its records (default: key and row as JSON)."""
        super().__init__(spark, path)
        self.keys, self.order = list(keys), list(order)
        self.changelog = changelog
        self.as_log = as_log or self._records

    def _records(self, batch: DataFrame) -> DataFrame:
        from dispatchboard.sinks.topics import as_records
        return as_records(batch, self.keys, batch.columns, self.changelog.rsplit("/", 1)[-1],
                          offset_col=self.order[0])

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        payload = [c for c in batch.columns if c not in self.keys]
        if self.changelog:
            # The batch is read twice (changelog, merge): keep it once.
            batch = batch.persist()
        try:
            latest = latest_by(batch, self.keys, self.order, payload)
            if self.changelog:
                # Every write is a changelog record, not only the last per
                # key: readers that keep their own per-key maps see them all.
                self.as_log(batch).write.mode("overwrite").parquet(
                    f"{self.changelog}/batch={batch_id:020d}")
            base = self._base(batch_id)
            merged = latest
            if base is not None:
                merged = latest_by(base.unionByName(latest), self.keys, self.order, payload)
            self._commit(merged, batch_id)
        finally:
            if self.changelog:
                batch.unpersist()


# SNK-5
def save_if_absent(df: DataFrame, name: str) -> None:
    """Create a catalog table only when it does not exist."""
    if not df.sparkSession.catalog.tableExists(name):
        df.write.mode("ignore").saveAsTable(name)


# SNK-6
def station_rules(key: str = "stop_id") -> list[tuple[str, Column]]:
    """Name and violation of every check that a stop row alone decides."""
    rules = [(f"not_null_{c}", F.col(c).isNull()) for c in (key, *STOPS_NOT_NULL)]
    return rules + [(f"max_length_{c}", F.length(c) > n) for c, n in STOPS_MAX_LENGTH.items()]


def check_stations(stops: DataFrame, key: str = "stop_id") -> DataFrame:
    """Violations of the stop table's declared constraints, one row per check:
    key null or repeated, NOT NULL columns, VARCHAR lengths. One aggregate pass
    for the column checks and one keyed count for uniqueness."""
    checks = station_rules(key)
    names = [n for n, _ in checks]
    exprs = [F.sum(cond.cast("int")).alias(n) for n, cond in checks]
    per_col = stops.agg(*exprs)
    stacked = per_col.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("check"),
                 F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("violations"))
        for n in names])).alias("c")).select("c.*")
    dup = (stops.where(F.col(key).isNotNull()).groupBy(key).count()
           .where(F.col("count") > 1)
           .agg(F.count(F.lit(1)).alias("violations"))
           .select(F.lit(f"unique_{key}").alias("check"), "violations"))
    return stacked.unionByName(dup)
