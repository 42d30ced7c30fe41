"""Exact dedup by a stateful stream over content digests.

A streaming aggregate keyed by digest keeps, for every text ever seen, the
stable identifier and the place of the row that stays, and the number of
copies. Its state is kept on disk (RocksDB, checkpointed to the shared
folder) and never expires. A digest that was hit more than once is then
checked on the full bytes: if its rows hold more than one text, they are
regrouped by the text itself. Everything runs as DataFrame operations.

Cases: a null text counts as an empty one and equals it; of repeated rows
with one doc_id and one text exactly one is kept, the last by place; null
doc_ids rank below all others; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.llm.shared import located, saved, scratch, text_or_empty, without

# Files of the digest table that one micro-batch takes in.
FILES_PER_TRIGGER = 1000
# Memory all state stores of one executor share, in MB; the rest is on disk.
STATE_MB = 300


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for stateful streams, so the
    caller's own settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    prefix = "spark.sql.streaming.stateStore."
    own.conf.set(prefix + "providerClass", "org.apache.spark.sql.execution.streaming.state."
                                           "RocksDBStateStoreProvider")
    own.conf.set(prefix + "rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set(prefix + "rocksdb.boundedMemoryUsage", "true")
    own.conf.set(prefix + "rocksdb.maxMemoryUsageMB", str(STATE_MB))
    # Else every state partition sets 4 MB of disk aside, however small it is.
    own.conf.set(prefix + "rocksdb.allowFAllocate", "false")
    return own


def digest_state(stream: DataFrame, state: str) -> None:
    """Take all that is new in ``stream`` (streaming ``doc_id, digest, at``)
    into the keyed state at ``state``; a later call goes on from there. Map
    tasks pre-aggregate, so a digest with most rows sends one row a task."""
    last = F.struct(F.col("doc_id"), F.col("at"))
    query = (stream.groupBy("digest").agg(F.max(last).alias("keep"), F.count(F.lit(1)).alias("n"))
             .writeStream.format("noop").outputMode("update")
             .option("checkpointLocation", state).trigger(availableNow=True).start())
    query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """The state as a table: ``digest, keep<doc_id, at>, n``."""
    held = spark.read.format("statestore").load(state)
    return held.select("key.digest", F.col("value.max").alias("keep"), F.col("value.count").alias("n"))


def _grouped(rows: DataFrame, at: str, digest: Callable[[Column], Column]) -> DataFrame:
    spark = rows.sparkSession
    text = text_or_empty()
    seen = scratch(spark, "digests")
    (rows.select("doc_id", digest(text).alias("digest"), F.col(at).alias("at"))
     .write.parquet(seen))
    table = spark.read.parquet(seen)
    own, state, groups = state_session(spark), scratch(spark, "state"), scratch(spark, "groups")
    digest_state(own.readStream.schema(table.schema)
                 .option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(seen), state)
    read_state(own, state).write.parquet(groups)
    groups = spark.read.parquet(groups)

    # Full bytes of every hit: copies collapse in the map tasks.
    full = rows.select(digest(text).alias("digest"), text.alias("text"), "doc_id",
                       F.col(at).alias("at"))
    hits = groups.where(F.col("n") > 1).select("digest")
    clash = saved(full.join(hits, "digest", "left_semi").select("digest", "text").distinct()
                  .groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
                  .where(F.col("texts") > 1).select("digest"), "clashes")
    out = ["doc_id", "digest", "keep", "n", "at"]
    if clash.isEmpty():
        return table.join(groups, "digest").select(*out)
    torn = full.join(clash, "digest", "left_semi")
    exact = (torn.groupBy("digest", "text")
             .agg(F.max(F.struct("doc_id", "at")).alias("keep"), F.count(F.lit(1)).alias("n")))
    return (table.join(clash, "digest", "left_anti").join(groups, "digest").select(*out)
            .union(torn.join(exact, ["digest", "text"]).select(*out)))


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """A row per document: ``doc_id, keep_id`` (the largest doc_id among
    equal texts), ``group_size, kept, digest, at`` (the row's place)."""
    return _marked(*located(docs), digest)


def _marked(rows: DataFrame, at: str, digest: Callable[[Column], Column]) -> DataFrame:
    return _grouped(rows, at, digest).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("keep.at") == F.col("at")).alias("kept"), "digest", "at")


def drop_exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256
                          ) -> DataFrame:
    """``docs`` with one row of each text, its columns unchanged."""
    rows, at = located(docs)
    return without(rows, at, _marked(rows, at, digest).where(~F.col("kept")))
