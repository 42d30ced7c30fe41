"""Incremental table pull with a stored high-water mark (SRC-6).

A poll first fixes its upper bound (the column's greatest value now), pulls
``last < column <= bound``, and, when the rows are safe, commits the bound. Rows
that arrive while it runs lie above the bound and belong to the next poll. The
column must be unique and increasing: of rows that share a value, those that
arrive after a poll are below its mark. On a JDBC source both predicates reach
the database (``read.format("jdbc")`` pushes filters; give
``partitionColumn``/bounds and ``fetchsize`` for parallel paged reads); on
parquet they reach the scan. Marks live in a small parquet table, one row per
poll with its value's type, so a crash between pull and mark only repeats a
pull.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def incremental_pull(df: DataFrame, column: str, last_seen=None,
                     ordered: bool = True, tiebreak=(), bound=None) -> DataFrame:
    """Rows past ``last_seen``, up to ``bound``, in ``column`` order.
    ``tiebreak`` columns let the range-partitioned sort split a value shared
    by many rows across tasks."""
    out = df if last_seen is None else df.where(F.col(column) > F.lit(last_seen))
    out = out if bound is None else out.where(F.col(column) <= F.lit(bound))
    return out.orderBy(column, *tiebreak) if ordered else out


def upper_bound(df: DataFrame, column: str):
    """The greatest value of ``column`` now (None for an empty table)."""
    return df.agg(F.max(column)).first()[0]


# SRC-6 in parallel pieces
def split_points(df: DataFrame, column: str, pieces: int, accuracy: int = 10_000) -> list:
    """Values that cut ``df`` into ``pieces`` runs of near equal rows, ascending:
    quantiles of the column (numbers, dates or times) from one pass, merged
    from a sketch a task, whose error in rank is the rows / ``accuracy``. Fewer
    values come back where one value holds several pieces' rows."""
    shares = [i / pieces for i in range(1, pieces)]
    found = df.agg(F.percentile_approx(column, shares, accuracy)).first()[0] if shares else None
    return sorted(set(found or []))


def piece_predicates(column: str, points: list) -> list[Column]:
    """One condition per piece: together they take every row once, those with
    a null in ``column`` with the first piece."""
    if not points:
        return [F.lit(True)]
    c = F.col(column)
    return [(c <= F.lit(points[0])) | c.isNull(),
            *[(c > F.lit(a)) & (c <= F.lit(b)) for a, b in zip(points, points[1:])], c > F.lit(points[-1])]


def piece_sql(column: str, points: list) -> list[str]:
    """The same conditions as SQL text, for a database's reader."""
    def text(v) -> str:
        return str(v) if isinstance(v, (int, float, Decimal)) else f"'{v}'"
    if not points:
        return ["1 = 1"]
    return [f"{column} <= {text(points[0])} OR {column} IS NULL",
            *[f"{column} > {text(a)} AND {column} <= {text(b)}" for a, b in zip(points, points[1:])],
            f"{column} > {text(points[-1])}"]


def pull_in_pieces(df: DataFrame, column: str, pieces: int, last_seen=None, bound=None) -> DataFrame:
    """Rows past ``last_seen`` up to ``bound``, read in ``pieces`` ranges of
    near equal rows (``piece`` numbers them), each its own filtered scan: the
    range reaches the scan, and no row is shuffled. Of parquet sorted by the
    column a piece opens only its own row groups; of unsorted files every
    piece reads the column."""
    new = incremental_pull(df, column, last_seen, ordered=False, bound=bound)
    ranges = piece_predicates(column, split_points(new, column, pieces))
    return reduce(DataFrame.unionByName,
                  [new.where(r).withColumn("piece", F.lit(i)) for i, r in enumerate(ranges)])


def _exists(spark: SparkSession, store: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path) and any(not s.getPath().getName().startswith(("_", "."))
                                   for s in fs.listStatus(path))


def read_mark(spark: SparkSession, store: str, source: str):
    """Last committed mark of ``source`` as a value of its own type, or None
    where no mark was ever stored. A store that can't be read is an error,
    not a first pull."""
    if not _exists(spark, store):
        return None
    row = (spark.read.parquet(store).where(F.col("source") == source)
           .agg(F.max_by(F.struct("mark", "type"), "at").alias("m")).first())["m"]
    if row is None:
        return None
    return spark.range(1).select(F.lit(row["mark"]).cast(row["type"])).first()[0]


def commit_mark(df: DataFrame, column: str, bound, store: str, source: str) -> None:
    """Store ``bound`` as the new mark, with the type ``column`` has in
    ``df``. A poll without a bound (an empty table) commits nothing."""
    if bound is None:
        return
    kind = df.schema[column].dataType.simpleString()
    (df.sparkSession.range(1).coalesce(1)
     .select(F.lit(source).alias("source"), F.lit(bound).cast(kind).cast("string").alias("mark"),
             F.lit(kind).alias("type"), F.current_timestamp().alias("at"))
     .write.mode("append").parquet(store))


def poll(df: DataFrame, column: str, store: str, source: str, use, tiebreak=()):
    """One poll: pull what is new, hand it to ``use`` (a function of the
    pulled frame and the mark before it), then commit the bound. The bound is
    stored as planned before ``use``: a poll that follows a crashed one pulls
    the very same rows, whatever has come since. Where nothing is new
    ``use`` gets no rows and no mark is stored. Returns the mark after the poll."""
    spark, planned = df.sparkSession, f"{source}#planned"
    last, bound = read_mark(spark, store, source), read_mark(spark, store, planned)
    if bound is None or (last is not None and bound <= last):
        bound = upper_bound(df, column)
        if bound is None or (last is not None and bound <= last):
            use(incremental_pull(df, column, last, tiebreak=tiebreak, bound=last), last)
            return last
        commit_mark(df, column, bound, store, planned)
    use(incremental_pull(df, column, last, tiebreak=tiebreak, bound=bound), last)
    commit_mark(df, column, bound, store, source)
    return bound


def poll_and_publish(df: DataFrame, column: str, store: str, topic: str, location: str,
                     key_cols=None, value_cols=None, fmt: str = "log"):
    """The polling job, to be run on a schedule (the reference's period is 30
    minutes): what is new in a table becomes messages of a raw topic. The
    column (a whole number) is the record offset, and a poll's part of the
    log is numbered by the mark before it, so a repeated poll finds its own
    part, with the same rows."""
    from dispatchboard.sinks.topics import publish

    def use(new: DataFrame, last) -> None:
        if new.isEmpty():  # or the part of the next poll would be taken for done
            return
        publish(new, key_cols or [column], value_cols or new.columns, topic, location,
                offset_col=column, fmt=fmt,
                batch=None if fmt == "kafka" else 0 if last is None else int(last) + 1)
    return poll(df, column, store, topic, use)


def jdbc_pull_in_pieces(spark: SparkSession, url: str, table: str, column: str, points: list,
                        **props) -> DataFrame:
    """A database's table in pieces, one predicate and one task each (untested
    here: no database)."""
    return spark.read.jdbc(url, table, predicates=piece_sql(column, points),
                           properties={k: str(v) for k, v in props.items()})


def jdbc_pull(spark: SparkSession, url: str, table: str, column: str, last_seen,
              fetchsize: int = 500, tiebreak=(), **props) -> DataFrame:
    """The same pull against a database (untested here: no database)."""
    df = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
          .option("fetchsize", fetchsize).options(**props).load())
    return incremental_pull(df, column, last_seen, tiebreak=tiebreak)
