"""JSON array files read by many tasks (SRC-7).

Spark's multi-line JSON reader gives a whole file to one task. Here a file is
read as text that ends at every closing brace, which Spark splits by bytes
wherever it likes. What a split's bytes mean depends on all that comes before
it, so the file is read twice:

1. Every split is summed up for both ways it may begin, outside a string or
   inside one: how it ends, and how many brackets it opens or closes. These
   summaries, one short row a split, are composed from the file's start on,
   which tells each split how it really begins.
2. Every split is cut at the commas between the array's elements. What
   stands before its first cut and after its last one are pieces of elements
   that reach over a split's end; they are put together by the number of cuts
   before them.

A task streams its split and holds one element and one batch of text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A split never begins or ends within an escape: both lie behind a brace.
_OUTSIDE = re.compile(rb'"(?:[^"\\]++|\\.)*+"|["{}\[\],]', re.S)
_INSIDE = re.compile(rb'(?:[^"\\]++|\\.)*+"', re.S)
_OPEN, _CLOSE = b"{[", b"}]"


def _tokens(text: bytes, inside: bool) -> Iterator[tuple[int, bytes]]:
    """Place and byte of every bracket and comma outside strings; at the end
    ``(-1, b'"')`` if the text ends inside one."""
    at = 0
    if inside:
        closed = _INSIDE.match(text)
        if closed is None:
            yield -1, b'"'
            return
        at = closed.end()
    for found in _OUTSIDE.finditer(text, at):
        if text[found.start()] != 0x22:
            yield found.start(), found.group()
        elif found.end() - found.start() == 1:
            yield -1, b'"'
            return


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, text``: text up to each closing brace, in order in
    each split; ``start`` is the split's first byte."""
    lines = spark.read.option("lineSep", "}").text(path)
    at = lines.metadataColumn("_metadata")
    return lines.select(at["file_path"].alias("file"), at["file_block_start"].alias("start"),
                        F.col("value").cast("binary").alias("text"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """(file, start, depth, inside) and a stretch of its text, batch by batch."""
    names = ["file", "start", "depth", "inside"]
    for batch in batches:
        keys = list(zip(*(batch[c].to_pylist() if c in batch.schema.names else [None] * len(batch)
                          for c in names)))
        texts, first = batch["text"].to_pylist(), 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[first]:
                yield keys[first], b"}".join(texts[first:i]) + b"}"
                first = i


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, list] = {}
    for (file, start, _, _), text in _splits(batches):
        ways = held.setdefault((file, start), [(False, 0), (True, 0)])
        for way, (inside, depth) in enumerate(ways):
            inside_after = False
            for _, byte in _tokens(text, inside):
                if byte == b'"':
                    inside_after = True
                else:
                    depth += (byte in _OPEN) - (byte in _CLOSE)
            ways[way] = (inside_after, depth)
    rows = [(file, start, *ways[0], *ways[1]) for (file, start), ways in held.items()]
    yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["file", "start", "inside0", "depth0", "inside1",
                                                                 "depth1"]).astype(
        {"file": str, "start": "int64", "inside0": bool, "depth0": "int64", "inside1": bool, "depth1": "int64"}),
        preserve_index=False)


def _composed(sums: pd.DataFrame) -> pd.DataFrame:
    """How each split of one file begins: ``depth``, ``inside``."""
    sums = sums.sort_values("start")
    depth, inside, begins = 0, False, []
    for row in sums.itertuples():
        begins.append((row.file, row.start, depth, inside))
        depth += row.depth1 if inside else row.depth0
        inside = row.inside1 if inside else row.inside0
    return pd.DataFrame(begins, columns=["file", "start", "depth", "inside"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole elements and, with their place, the pieces at a split's ends:
    ``file, start, cuts, text``; ``cuts`` counts a split's cuts before a piece
    and is null for whole elements."""
    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
            pa.string(), pa.int64(), pa.int64(), pa.binary()))], ["file", "start", "cuts", "text"])

    at, rows, parts, cuts, depth, inside = None, [], [], 0, 0, False
    for (file, start, first_depth, first_inside), text in _splits(batches):
        if at != (file, start):
            if at is not None:
                rows.append((*at, cuts, b"".join(parts)))
            at, parts, cuts, depth, inside = (file, start), [], 0, first_depth, first_inside
        begin, ends_inside = 0, False
        for place, byte in _tokens(text, inside):
            if byte == b'"':
                ends_inside = True
                continue
            if depth == 0 and byte == b"{":
                raise ValueError(f"{file}: not a JSON array")
            border = depth == (0 if byte == b"[" else 1) and byte in (b"[", b"]", b",")
            depth += (byte in _OPEN) - (byte in _CLOSE)
            if border:
                piece = b"".join(parts) + text[begin:place]
                rows.append((*at, None if cuts else 0, piece))
                parts, begin, cuts = [], place + 1, cuts + 1
        parts.append(text[begin:])
        inside = ends_inside
        yield out(rows)
        rows = []
    if at is not None:
        rows.append((*at, cuts, b"".join(parts)))
    yield out(rows)


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """The elements of the JSON arrays in the files at ``path`` as text
    (``value``), one row each, in no order. Files are UTF-8. An empty file or
    array has no rows; a file that holds an object is an error."""
    lines = _lines(spark, path)
    begins = (lines.mapInArrow(_summaries, "file string, start long, inside0 boolean, depth0 long, "
                                           "inside1 boolean, depth1 long")
              .groupBy("file").applyInPandas(_composed, "file string, start long, depth long, inside boolean"))
    # One row a split: broadcast, so the text isn't shuffled and keeps its order.
    known = lines.join(F.broadcast(begins), ["file", "start"]).select("file", "start", "depth", "inside", "text")
    found = known.mapInArrow(_cut, "file string, start long, cuts long, text binary")
    whole = found.where(F.col("cuts").isNull()).select("text")
    pieces = found.where(F.col("cuts").isNotNull())
    # A split's first piece ends an element; its last one, if it has a cut,
    # begins another. Splits are few, and only their own ends are ordered.
    before = Window.partitionBy("file").orderBy("start", "cuts").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.sum((F.col("cuts") > 0).cast("int")).over(before)
    across = (pieces.withColumn("element", opens).groupBy("file", "element")
              .agg(F.sort_array(F.collect_list(F.struct("start", "cuts", "text"))).alias("parts"))
              .select(F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.text))").alias("text")))
    return whole.unionByName(across).select(_element("text").alias("value")).where(F.col("value") != "")


def _element(text: str) -> Column:
    """Without the white space around it; what stands outside the array (the
    bytes after its end, the brace that the reader adds) is no element."""
    trimmed = F.regexp_replace(F.col(text).cast("string"), r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    return F.when(trimmed == "}", "").otherwise(trimmed)
