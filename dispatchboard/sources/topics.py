"""Topic sources (SRC-1, SRC-2, SRC-3, STR-8).

A topic is read either from Kafka (``format="kafka"``; needs the Kafka
package on the cluster's classpath, untested here since no broker exists) or
from a *topic log*: one parquet folder per topic under a log root, holding
the Kafka source's columns. Both give the same six columns, so everything
downstream is shared. Subscribing to one topic reads only its folder; a
pattern reads only the folders of the topics whose whole name matches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.schemas import TOPIC_LOG

LOG_COLUMNS = [f.name for f in TOPIC_LOG.fields]
# Kafka's markers inside a starting-offsets map.
EARLIEST, LATEST = -2, -1


def _log_reader(spark: SparkSession, stream: bool, max_files_per_trigger: int | None):
    # A log has no partition columns; files may sit in per-batch subfolders
    # (written by replay-safe sinks), so directories are searched, not parsed.
    if stream:
        r = spark.readStream.schema(TOPIC_LOG).option("recursiveFileLookup", "true")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r
    return spark.read.schema(TOPIC_LOG).option("recursiveFileLookup", "true")


def _kafka(spark: SparkSession, stream: bool, servers: str, sub_key: str, sub: str,
           starting, max_offsets_per_trigger: int | None) -> DataFrame:
    r = (spark.readStream if stream else spark.read).format("kafka")
    r = r.option("kafka.bootstrap.servers", servers).option(sub_key, sub)
    r = r.option("startingOffsets", kafka_offsets(starting, sub if sub_key == "subscribe" else None))
    if stream and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(*LOG_COLUMNS)


def kafka_offsets(starting, topic: str | None) -> str:
    """A start position as Kafka's option text. Kafka wants a map to list
    every partition of every topic."""
    if isinstance(starting, str):
        return starting
    if not _keyed_by_topic(starting):
        if topic is None:
            raise ValueError("a pattern subscription needs a start map keyed by topic")
        starting = {topic: starting}
    return json.dumps({t: {str(p): int(o) for p, o in parts.items()} for t, parts in starting.items()})


def _keyed_by_topic(starting: Mapping) -> bool:
    return all(isinstance(v, Mapping) for v in starting.values())


# SRC-1
def read_topic(spark: SparkSession, location: str, topic: str, stream: bool = True,
               starting="earliest", max_files_per_trigger: int | None = None,
               fmt: str = "log", max_offsets_per_trigger: int | None = None,
               start_store: str | None = None) -> DataFrame:
    """Unbounded (``stream=True``) or bounded read of one topic.

    ``location`` is a topic-log directory, or the bootstrap servers when
    ``fmt="kafka"``. A restarted stream resumes from its checkpoint, so the
    start position only applies to the first run; for a stream over a log
    give ``start_store`` (see ``fixed_start``) with a position that has
    "latest" in it.
    """
    if fmt == "kafka":
        return _kafka(spark, stream, location, "subscribe", topic, starting,
                      max_offsets_per_trigger)
    if stream:
        starting = fixed_start(spark, location, [topic], starting, start_store)
    df = (_log_reader(spark, stream, max_files_per_trigger)
          .parquet(f"{location}/{topic}").select(*LOG_COLUMNS))
    return apply_start(df, starting)


# SRC-2
def read_topics(spark: SparkSession, location: str, pattern: str, stream: bool = True,
                starting="earliest", max_files_per_trigger: int | None = None,
                fmt: str = "log", max_offsets_per_trigger: int | None = None,
                start_store: str | None = None) -> DataFrame:
    """All topics whose whole name matches the regex ``pattern``, as a broker
    matches it. Of a log only the matching topics' folders are opened; a
    topic made later joins when the reader is started again."""
    if fmt == "kafka":
        return _kafka(spark, stream, location, "subscribePattern", pattern, starting,
                      max_offsets_per_trigger)
    topics = [t for t in log_topics(spark, location) if re.fullmatch(pattern, t)]
    if not topics:
        if stream:
            raise ValueError(f"no topic under {location} matches {pattern!r}")
        return spark.createDataFrame([], TOPIC_LOG)
    if stream:
        starting = fixed_start(spark, location, topics, starting, start_store)
    folders = f"{location}/{{{','.join(topics)}}}" if len(topics) > 1 else f"{location}/{topics[0]}"
    df = _log_reader(spark, stream, max_files_per_trigger).parquet(folders).select(*LOG_COLUMNS)
    return apply_start(df, starting)


def read_topic_list(spark: SparkSession, location: str, topics: list[str],
                    fmt: str = "log", max_files_per_trigger: int | None = None,
                    max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A stream of several named topics from their earliest offsets. A log's
    topic may be made after the start; its folder is looked for on every
    trigger."""
    if fmt == "kafka":
        return _kafka(spark, True, location, "subscribe", ",".join(topics), "earliest",
                      max_offsets_per_trigger)
    return (_log_reader(spark, True, max_files_per_trigger)
            .parquet(f"{location}/{{{','.join(topics)}}}").select(*LOG_COLUMNS))


def log_topics(spark: SparkSession, location: str) -> list[str]:
    """Names of the topics of a log: its folders, in order."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def log_ends(log: DataFrame) -> dict[str, dict[int, int]]:
    """{topic: {partition: the offset after its last}}; one row per topic
    partition comes to the driver."""
    ends: dict[str, dict[int, int]] = {}
    for r in log.groupBy("topic", "partition").agg(F.max("offset").alias("last")).collect():
        ends.setdefault(r["topic"], {})[r["partition"]] = r["last"] + 1
    return ends


def fixed_start(spark: SparkSession, location: str, topics: list[str], starting, store: str | None):
    """``starting`` with every "latest" (-1) made the offset it means now, so
    that a stream over a log reads what arrives from now on, and nothing that
    was there. ``store`` is a folder that keeps these offsets from the first
    start on: a restart means the same position."""
    maps = [] if not isinstance(starting, Mapping) else (
        list(starting.values()) if _keyed_by_topic(starting) else [starting])
    if starting != "latest" and not any(o == LATEST for m in maps for o in m.values()):
        return starting
    if store:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path):
            return {t: {int(p): o for p, o in parts.items()}
                    for t, parts in json.loads(spark.read.text(store).first()[0]).items()}
    made = set(log_topics(spark, location))
    there = [f"{location}/{t}" for t in topics if t in made]
    ends = log_ends(_log_reader(spark, False, None).parquet(*there)) if there else {}
    if starting == "latest":
        fixed = ends
    else:
        each = starting if _keyed_by_topic(starting) else {t: starting for t in topics}
        fixed = {t: {int(p): ends.get(t, {}).get(int(p), EARLIEST) if o == LATEST else int(o)
                     for p, o in parts.items()} for t, parts in each.items()}
    if store:
        (spark.createDataFrame([(json.dumps(fixed),)], "value string").coalesce(1)
         .write.mode("overwrite").text(store))
    return fixed


def subscribe_pattern(log: DataFrame, pattern: str) -> DataFrame:
    """Pattern subscription over any frame in topic-log shape."""
    return log.where(F.col("topic").rlike(f"^(?:{pattern})$"))


# SRC-3
def start_predicate(starting) -> Column | None:
    """Row filter for a start position. ``"earliest"``: everything.
    ``"latest"``: nothing that is already there (a bounded read is empty; for
    a stream see ``fixed_start``).
    A mapping ``{partition: offset}`` starts each listed partition at that
    offset, inclusive (``-2`` earliest, ``-1`` latest); partitions not
    listed start at the earliest offset. Mappings may be keyed by topic too:
    ``{topic: {partition: offset}}``."""
    if starting is None or starting == "earliest":
        return None
    if starting == "latest":
        return F.lit(False)
    if not isinstance(starting, Mapping):
        raise ValueError(f"bad start position {starting!r}")
    by_topic = bool(starting) and _keyed_by_topic(starting)
    items = (starting.items() if by_topic else [(None, starting)])
    cond, listed = None, None
    for topic, parts in items:
        for p, off in parts.items():
            where = F.col("partition") == int(p)
            if topic is not None:
                where = where & (F.col("topic") == topic)
            keep = (F.lit(True) if off == EARLIEST else F.lit(False) if off == LATEST
                    else F.col("offset") >= int(off))
            cond = (where & keep) if cond is None else cond | (where & keep)
            listed = where if listed is None else listed | where
    return cond | ~listed if cond is not None else None


def apply_start(log: DataFrame, starting) -> DataFrame:
    pred = start_predicate(starting)
    return log if pred is None else log.where(pred)
