"""Deduplication, latest row per key, neighbours along an order.

``latest_by`` and ``first_by`` are single hash aggregates with ``max_by`` /
``min_by`` over a struct ordering. Spark runs them with a map-side partial
aggregate, so a key that holds a third of all rows still sends one row per
map task to the shuffle; no group is ever gathered in one place. The same
aggregate is accepted by Structured Streaming, where ``row_number`` is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

def _cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _names(cs) -> list[str]:
    if isinstance(cs, str):
        return [cs]
    return list(cs)


# DED-1
def distinct_calls(df: DataFrame,
                   cols: Sequence[str] = ("call_date_time",
                                          "original_crime_type_name",
                                          "disposition")) -> DataFrame:
    """Keep the three compared columns and collapse exact repeats.

    The projection is part of the meaning: two different calls with the same
    (time, type, disposition) collapse too, as in the reference.
    """
    return df.select(*cols).distinct()


# DED-2
def latest_by(df: DataFrame, keys, order, payload: Sequence[str] | None = None
              ) -> DataFrame:
    """Last write per key: the row with the greatest ``order`` (a column or
    list of columns compared as a struct). Null payload fields are kept."""
    key_names = _names(keys)
    order_cols = _cols(order)
    if payload is None:
        payload = [c for c in df.columns if c not in key_names]
    ordering = F.struct(*order_cols) if len(order_cols) > 1 else order_cols[0]
    if len(payload) == 1 and isinstance(df.schema[payload[0]].dataType, NumericType):
        # A fixed-width value is updated in place, so Spark aggregates by hash.
        return df.groupBy(*key_names).agg(F.max_by(payload[0], ordering).alias(payload[0]))
    latest = F.max_by(F.struct(*[F.col(c) for c in payload]), ordering)
    return (df.groupBy(*key_names).agg(latest.alias("_latest"))
            .select(*key_names, *[F.col("_latest")[c].alias(c) for c in payload]))


# DED-3
def first_by(df: DataFrame, keys, order, payload: Sequence[str] | None = None
             ) -> DataFrame:
    """First row per key by ``order`` (ties must be broken by the caller's
    ordering columns, e.g. a unique id as the last one)."""
    key_names = _names(keys)
    order_cols = _cols(order)
    if payload is None:
        payload = [c for c in df.columns if c not in key_names]
    ordering = F.struct(*order_cols) if len(order_cols) > 1 else order_cols[0]
    first = F.min_by(F.struct(*[F.col(c) for c in payload]), ordering)
    return (df.groupBy(*key_names).agg(first.alias("_first"))
            .select(*key_names, *[F.col("_first")[c].alias(c) for c in payload]))


# WIN-2 building block
def neighbours(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
               prev_col: str = "prev", next_col: str = "next",
               slices: int | None = None) -> DataFrame:
    """Add the previous and next ``value`` within each ``group`` along
    ``order`` (unique within a group): ``lag``/``lead`` over a window
    partitioned by ``group``, without gathering any group in one task.

    Rows are range-partitioned on (group, order) into ``slices`` ordered
    slices (default: the shuffle width), so a group of any size is cut
    across many tasks. ``lag``/``lead`` run within each (slice, group)
    piece; the first and last row of a piece take their missing neighbour
    from the adjacent piece of the same group, read off a summary with one
    row per piece (at most ``slices`` per group).

    The sliced rows are checkpointed to the shared checkpoint folder before
    they are read twice (rows and summary). Range bounds come from a sample,
    so two evaluations of the range shuffle could cut different slices; the
    checkpoint fixes one cut, and survives lost executors.
    """
    from dispatchboard.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    group, order = list(group), list(order)
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = (df.repartitionByRange(n, *[F.col(c) for c in group + order])
              .withColumn("_slice", F.spark_partition_id()))
    w = Window.partitionBy("_slice", *group).orderBy(*order)
    local = sliced.select(
        "*", F.lag(value).over(w).alias("_lag"), F.lead(value).over(w).alias("_lead"),
        F.lag(F.lit(True)).over(w).isNull().alias("_first"),
        F.lead(F.lit(True)).over(w).isNull().alias("_last")).checkpoint()
    # One row per piece: its first and last value (wrapped, so a null value
    # is told apart from a missing piece).
    held = F.struct(F.col(value).alias("v"))
    ends = (local.where(F.col("_first") | F.col("_last")).groupBy("_slice", *group)
            .agg(F.max(F.when(F.col("_first"), held)).alias("_head"),
                 F.max(F.when(F.col("_last"), held)).alias("_tail")))
    across = Window.partitionBy(*group).orderBy("_slice")
    links = ends.select("_slice", *group,
                        F.lag("_tail").over(across)["v"].alias("_before"),
                        F.lead("_head").over(across)["v"].alias("_after"))
    # ``local`` is already hash-partitioned on (slice, group) by its window,
    # so this join moves only the summary.
    out = local.join(links, ["_slice", *group], "left")
    return out.select(
        *df.columns,
        F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_lag")).alias(prev_col),
        F.when(F.col("_last"), F.col("_after")).otherwise(F.col("_lead")).alias(next_col))
