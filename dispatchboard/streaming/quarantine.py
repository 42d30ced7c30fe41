"""Bad-record split (PRJ-20): messages that do not decode go to a quarantine
output and the stream goes on. Works on tables and streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dispatchboard.functions.scalars import decode_json, is_malformed


def narrowed(schema: StructType, fields: Sequence[str] | None) -> StructType:
    """``schema`` cut to ``fields`` (in schema order). The JSON reader skips
    fields it is not asked for, so a query pays only for what it reads."""
    if fields is None:
        return schema
    keep = set(fields)
    return StructType([f for f in schema.fields if f.name in keep])


def tag_malformed(df: DataFrame, schema: StructType, value_col: str = "value",
                  fields: Sequence[str] | None = None, required: Sequence[str] = ()
                  ) -> DataFrame:
    """Every row once, with ``_dec`` (the decoded struct) and ``_bad``: the
    value is present but isn't a JSON object, or lacks a ``required`` field.
    Any other field may be missing; it is null then.

    Each value is decoded once. The tag is produced next to the decoded
    struct by a one-element ``inline``, so the optimizer cannot push a filter
    on it below the decode and parse every message a second time.
    ``fields`` limits decoding to the fields a query uses.
    """
    wanted = narrowed(schema, fields)
    dec = df.withColumn("_d", decode_json(value_col, wanted))
    bad = is_malformed(value_col, "_d", wanted.names)
    for f in required:
        bad = bad | F.col("_d")[f].isNull()
    tag = F.struct(F.col("_d").alias("_dec"), bad.alias("_bad"))
    return dec.select(*df.columns, F.inline(F.array(tag)))


def split_malformed(df: DataFrame, schema: StructType, value_col: str = "value",
                    fields: Sequence[str] | None = None, required: Sequence[str] = ()
                    ) -> tuple[DataFrame, DataFrame]:
    """(good, bad): ``good`` has the decoded fields expanded; ``bad`` keeps
    the raw rows that did not decode (see ``tag_malformed``)."""
    tagged = tag_malformed(df, schema, value_col, fields, required)
    rest = [c for c in df.columns if c != value_col]
    good = tagged.where(~F.col("_bad")).select(*rest, "_dec.*")
    bad = tagged.where(F.col("_bad")).select(*df.columns)
    return good, bad


def start_quarantine(bad: DataFrame, name: str, out: str, trigger: str = "10 seconds"):
    """Keep a stream's undecodable rows, raw, under ``out``: one folder a
    micro-batch, overwritten on replay."""
    from dispatchboard.streaming import runner
    return runner.start(bad, name, "append", trigger, path=out)


def with_reasons(rows: DataFrame, schema: StructType, value_col: str = "value", required: Sequence[str] = ()
                 ) -> DataFrame:
    """What is wrong with each message, a row per fault: the columns of
    ``rows``, ``field`` (null: the message as a whole), ``problem`` and
    ``found``, the JSON type that is there. Problems: ``empty`` (no value),
    ``not JSON``, ``not an object``, ``missing`` (a required field absent or
    null) and ``wrong type`` (any field the decoder can't read). Messages
    without a fault give no row. A repeated field makes a value no JSON here,
    though the decoder takes its last one."""
    text = F.col(value_col).cast("string")
    doc, dec = F.col("_v"), F.col("_d")
    kind = F.schema_of_variant(doc)

    def fault(problem: str, field: Column, found: Column) -> Column:
        return F.struct(field.cast("string").alias("field"), F.lit(problem).alias("problem"),
                        found.cast("string").alias("found"))
    per_field = []
    for f in schema.names:
        at = F.try_variant_get(doc, f"$['{f}']", "variant")
        there = at.isNotNull() & ~F.is_variant_null(at)
        wrong = F.when(there & dec[f].isNull(), fault("wrong type", F.lit(f), F.schema_of_variant(at)))
        per_field.append(wrong if f not in required else wrong.when(
            ~there, fault("missing", F.lit(f), F.lit(None))))
    faults = (F.when(text.isNull() | (F.trim(text) == ""), F.array(fault("empty", F.lit(None), F.lit(None))))
              .when(doc.isNull(), F.array(fault("not JSON", F.lit(None), F.lit(None))))
              .when(~kind.startswith("OBJECT"), F.array(fault("not an object", F.lit(None), kind)))
              .otherwise(F.array_compact(F.array(*per_field))))
    parsed = rows.withColumn("_v", F.try_parse_json(text)).withColumn("_d", decode_json(value_col, schema))
    return parsed.select(*rows.columns, F.inline(faults))


def replay(spark: SparkSession, bad: DataFrame, mend: Column, location: str, batch: int) -> None:
    """Put mended messages back: ``bad`` are quarantined topic-log rows, ``mend``
    the new value of each (null: leave it in quarantine). They keep their key,
    partition, offset and time and become part ``batch`` of their topics' logs;
    a finished part is left alone, so a repeated replay adds nothing."""
    from dispatchboard.sinks.topics import finish_part, part_done
    from dispatchboard.sources.topics import LOG_COLUMNS
    mended = bad.withColumn("value", mend.cast("binary")).where(F.col("value").isNotNull()).select(*LOG_COLUMNS)
    # One row per topic comes to the driver.
    for row in mended.select("topic").distinct().collect():
        topic = row["topic"]
        if not part_done(spark, location, topic, batch):
            (mended.where(F.col("topic") == topic).write.mode("overwrite")
             .parquet(f"{location}/{topic}/batch={batch:020d}"))
            finish_part(spark, location, topic, batch)
