"""Publishing rows as keyed topic records (SNK-2, SNK-4, SNK-5, SRC-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.functions.scalars import JSON_OPTIONS
from dispatchboard.schemas import TOPIC_LOG
from dispatchboard.sources.topics import LOG_COLUMNS


def _json(cols) -> Column:
    cols = [cols] if isinstance(cols, (str, Column)) else list(cols)
    return F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]),
                     JSON_OPTIONS).cast("binary")


def as_records(df: DataFrame, key_cols, value_cols, topic: str,
               partitions: int = 1, offset_col: str | None = None,
               time_col: str | None = None, first_offset: int = 0) -> DataFrame:
    """Rows in topic-log shape: JSON key and value, partition by key hash.

    Offsets come from ``offset_col`` when the source has a natural order;
    otherwise from ``monotonically_increasing_id`` (unique and increasing in
    partition order, computed inside each task, no shuffle), counted from
    ``first_offset``.
    """
    key = _json(key_cols) if key_cols else F.lit(None).cast("binary")
    part = (F.lit(0) if partitions == 1
            else F.pmod(F.xxhash64(key), F.lit(partitions)))
    off = (F.col(offset_col) if offset_col
           else F.monotonically_increasing_id() + F.lit(first_offset))
    ts = (F.col(time_col).cast("timestamp") if time_col else F.current_timestamp())
    return df.select(key.alias("key"), _json(value_cols).alias("value"),
                     F.lit(topic).alias("topic"), part.cast("int").alias("partition"),
                     off.cast("bigint").alias("offset"), ts.alias("timestamp"))


def topic_files(spark: SparkSession, location: str, topic: str) -> int:
    """Finished data files of a topic log (a write in progress keeps its
    files under ``_temporary``)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{location}/{topic}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = 0
    if fs.exists(path):
        files = fs.listFiles(path, True)
        while files.hasNext():
            at = files.next().getPath()
            found += "/_temporary/" not in at.toString() and not at.getName().startswith(("_", "."))
    return found


def topic_exists(spark: SparkSession, location: str, topic: str) -> bool:
    """SNK-5 guard for a topic log: its folder holds a data file."""
    return topic_files(spark, location, topic) > 0


def next_offset(spark: SparkSession, location: str, topic: str) -> int:
    """The offset after the topic's last, 0 for a new topic; one aggregate
    over the offset column."""
    if not topic_exists(spark, location, topic):
        return 0
    last = read_published(spark, location, topic).agg(F.max("offset")).first()[0]
    return 0 if last is None else last + 1


def require_topics(spark: SparkSession, location: str, *topics: str) -> None:
    """Refuse to start a reader whose inputs are missing."""
    missing = [t for t in topics if not topic_exists(spark, location, t)]
    if missing:
        raise RuntimeError(f"missing input topics: {missing}")


# SNK-2
def publish(df: DataFrame, key_cols, value_cols, topic: str, location: str,
            partitions: int = 1, offset_col: str | None = None,
            time_col: str | None = None, if_absent: bool = False,
            fmt: str = "log", batch: int | None = None, max_records: int = 0) -> None:
    """Add records to a topic log (or to Kafka with ``fmt="kafka"``,
    ``location`` then being the bootstrap servers). With ``if_absent`` an
    existing topic is left untouched (SNK-5; logs only). Offsets go on from
    the topic's last.

    A retried job would append its rows again; give ``batch``, a number of
    the caller's: a finished part of that number is left alone, so a stream
    that has read its files doesn't get them again under new names, and an
    unfinished one is written anew. Such a part needs ``offset_col``, since
    its rows must keep their offsets. ``max_records`` bounds a file's rows."""
    spark = df.sparkSession
    if fmt == "kafka":
        if if_absent:
            raise ValueError("if_absent needs a topic log")
        recs = as_records(df, key_cols, value_cols, topic, partitions, offset_col, time_col)
        (recs.select("key", "value", "topic").write.format("kafka")
         .option("kafka.bootstrap.servers", location).save())
        return
    if if_absent and topic_exists(spark, location, topic):
        return
    if batch is not None and not offset_col:
        raise ValueError("a numbered batch needs offset_col")
    first = 0 if offset_col else next_offset(spark, location, topic)
    recs = as_records(df, key_cols, value_cols, topic, partitions, offset_col, time_col, first)
    writer = recs.write.option("maxRecordsPerFile", max_records)
    if batch is None:
        writer.mode("append").parquet(f"{location}/{topic}")
    elif not part_done(spark, location, topic, batch):
        writer.mode("overwrite").parquet(f"{location}/{topic}/batch={batch:020d}")
        finish_part(spark, location, topic, batch)


def _part_mark(spark: SparkSession, location: str, topic: str, batch: int):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{location}/_parts/{topic}/{batch:020d}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def part_done(spark: SparkSession, location: str, topic: str, batch: int) -> bool:
    """The numbered part was written whole. Marks lie outside the topics'
    folders, where readers of a log don't look."""
    fs, mark = _part_mark(spark, location, topic, batch)
    return fs.exists(mark)


def finish_part(spark: SparkSession, location: str, topic: str, batch: int) -> None:
    fs, mark = _part_mark(spark, location, topic, batch)
    fs.create(mark, True).close()


def read_published(spark: SparkSession, location: str, topic: str) -> DataFrame:
    return (spark.read.schema(TOPIC_LOG).option("recursiveFileLookup", "true")
            .parquet(f"{location}/{topic}").select(*LOG_COLUMNS))


# SRC-7
def publish_json_file(spark: SparkSession, path: str, topic: str, location: str,
                      schema=None) -> None:
    """Files holding JSON arrays become one message per element, however large
    one file is. With a ``schema`` a message has its fields, without one it is
    the element's own text."""
    from dispatchboard.sources.json_arrays import read_json_array
    elements = read_json_array(spark, path)
    if schema is not None:
        src = elements.select(F.from_json("value", schema).alias("d")).select("d.*")
        publish(src, None, src.columns, topic, location)
        return
    off = F.monotonically_increasing_id() + F.lit(next_offset(spark, location, topic))
    (elements.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                     F.lit(topic).alias("topic"), F.lit(0).alias("partition"), off.alias("offset"),
                     F.current_timestamp().alias("timestamp"))
     .write.mode("append").parquet(f"{location}/{topic}"))


# SNK-4
def publish_summary(entries: DataFrame, topic: str, location: str) -> None:
    """Per-station counts out as JSON records keyed by station."""
    publish(entries.select("station_id", F.col("entries").alias("count")),
            ["station_id"], ["station_id", "count"], topic, location)
