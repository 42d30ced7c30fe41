"""Helpers the operators of this subpackage share.

Intermediate tables live under the folder the cluster names in
``spark.checkpoint.dir``: written once, read by any executor, and still there
when an executor is lost. They stay until that folder is cleared, because the
frames handed back read them lazily.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.session import checkpoint_root


def scratch(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, under the shared folder."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage,
    fixes the rows, and gives the optimizer their real size."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, or the first variant of it that clashes with no column."""
    taken = {c.lower() for c in columns}
    name, n = wanted, 0
    while name.lower() in taken:
        n += 1
        name = f"{wanted}_{n}"
    return name


def located(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells every row apart, repeated rows too,
    and the name of that column: ``struct<file, row>``, the place the row is
    read from. A frame that isn't a plain file scan is saved first."""
    at = fresh(docs.columns, "at")

    def add(frame: DataFrame) -> DataFrame:
        place = frame.metadataColumn("_metadata")
        return frame.withColumn(at, F.struct(place["file_path"].alias("file"),
                                             place["row_index"].alias("row")))
    try:
        return add(docs), at
    except AnalysisException:
        return add(saved(docs, "rows")), at


def small_table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A few rows the driver has worked out, as part of the plan itself."""
    text = F.lit(json.dumps(rows))
    return spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{ddl}>>")))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def without(docs: DataFrame, at: str, dropped: DataFrame) -> DataFrame:
    """Rows of located ``docs`` whose place isn't in ``dropped.at``, with the
    columns they had before they were located."""
    gone = dropped.select(F.col("at").alias("_gone"))
    return docs.join(gone, docs[at] == gone["_gone"], "left_anti").drop(at)
