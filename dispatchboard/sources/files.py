"""File sources: JSON lookup (SRC-4), CSV seed tables (SRC-5), and the
ridership curve that ships with the transit data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.schemas import (DISPOSITION, RIDERSHIP_CURVE, RIDERSHIP_SEED,
                                   STOPS)

# --- fixed values that must equal the reference's -------------------------
# Share of a day's riders entering in each hour (hour 0 to 24; 24 never
# matches an hour of day).
RIDERSHIP_CURVE_VALUES = [
    (0, 0.01), (1, 0.01), (2, 0.01), (3, 0.01), (4, 0.0125), (5, 0.025),
    (6, 0.05), (7, 0.075), (8, 0.125), (9, 0.075), (10, 0.05), (11, 0.025),
    (12, 0.0225), (13, 0.0225), (14, 0.0225), (15, 0.025), (16, 0.05),
    (17, 0.075), (18, 0.125), (19, 0.075), (20, 0.05), (21, 0.025),
    (22, 0.01), (23, 0.01), (24, 0.01),
]
# ---------------------------------------------------------------------------


# SRC-4
def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line JSON (each file one array of objects), declared schema."""
    return spark.read.option("multiline", "true").schema(DISPOSITION).json(path)


def _array_lines(batches):
    """One partition's JSON objects as the lines of one JSON array: ``[``,
    the first object, ``,`` + each further object, ``]``. Rows stream through
    in Arrow batches; no partition is held whole."""
    import pandas as pd
    yield pd.DataFrame({"value": ["["]})
    first = True
    for pdf in batches:
        if pdf.empty:
            continue
        sep = pd.Series(",", index=pdf.index)
        if first:
            sep.iloc[0] = ""
            first = False
        yield pd.DataFrame({"value": sep + pdf["_j"]})
    yield pd.DataFrame({"value": ["]"]})


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Write ``df`` as JSON-array files readable by ``read_codes``: one file
    (one array) per Spark partition, written by that partition's task."""
    (df.select(F.to_json(F.struct(*df.columns)).alias("_j"))
       .mapInPandas(_array_lines, "value string")
       .write.mode("overwrite").text(path))


# SRC-5
def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Stop table CSV with header; quoted commas handled; ``order`` is read
    under its own name and carried as ``station_order``."""
    return (spark.read.option("header", "true").option("quote", '"')
            .option("escape", '"').schema(STOPS).csv(path)
            .withColumnRenamed("order", "station_order"))


def write_stations(stops: DataFrame, path: str) -> None:
    (stops.withColumnRenamed("station_order", "order")
     .write.mode("overwrite").option("header", "true").option("escape", '"').csv(path))


def read_ridership_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").schema(RIDERSHIP_SEED).csv(path)


def read_ridership_curve(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The curve CSV, or the shipped values when no path is given."""
    if path is None:
        return spark.createDataFrame(RIDERSHIP_CURVE_VALUES, RIDERSHIP_CURVE)
    return spark.read.option("header", "true").schema(RIDERSHIP_CURVE).csv(path)
