"""SimHash near-dedup by deletion-variant signatures.

A 64-bit fingerprint sums the hashes of a text's word shingles bit by bit.
Two fingerprints within ``max_bits`` bits, cut into ``max_bits // 2 + 1``
segments, agree but for one bit in one segment at least. So every segment is
indexed once per bit position with that bit wildcarded, an equality join on
the variants finds all candidates, and each is verified on all 64 bits.

Cases: null and empty texts (and texts of white space) have fingerprint 0 and
link like any other; texts of fewer words than a shingle hash their whole
word sequence; repeated rows share a fingerprint, so a component, and the one
row with the smallest doc_id (then the first place) is kept; null doc_ids rank
last and a component of null doc_ids alone has a null component_id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchboard.llm.components import components
from dispatchboard.llm.shared import located, saved, text_or_empty, without

SHINGLE_WORDS = 3
MAX_BITS = 3
BITS = 64
# Fingerprints compared with each other in one piece of work: a bucket with
# more is cut into blocks, and every pair of blocks is one piece.
BLOCK = 1024
# Shingles summed at a time, so a text of any length needs little memory.
STEP = 1 << 14


def _fingerprint(text: str, shingle: int) -> int:
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    total = len(words) - width + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, total, STEP):
        some = words[at:at + STEP + width - 1]
        hashes = [xxhash.xxh64_intdigest(b" ".join(some[i:i + width]), 42)
                  for i in range(len(some) - width + 1)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a long (its bits read as a signed number)."""
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([_fingerprint(t, shingle) for t in batch], dtype="int64")
    return of(text)


def variants(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(key, fp)``: each fingerprint under each of its one-wildcard segment
    variants, ``BITS`` rows a fingerprint whatever the segment count. The key
    packs the wildcard's position above the segment's other bits."""
    segments = max_bits // 2 + 1
    if BITS % segments:
        raise ValueError("the segments must divide the fingerprint evenly")
    width = BITS // segments
    mask = -1 if width == BITS else (1 << width) - 1
    one = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    part = F.expr(f"shiftrightunsigned(fp, cast(floor(bit / {width}) * {width} as int)) & {mask}L")
    rest = part.bitwiseAND(F.bitwise_not(F.expr(f"shiftleft(1L, bit % {width})")))
    if width <= 32:
        return one.select(F.expr("shiftleft(cast(bit as long), 32)").bitwiseOR(rest).alias("key"), "fp")
    return one.select(F.struct(F.col("bit"), rest.alias("rest")).alias("key"), "fp")


def _forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that join the same fingerprints as all pairs within max_bits."""
    own = np.unique(np.asarray(prints, np.int64))
    n = len(own)
    near = np.bitwise_count(own[:, None].view(np.uint64) ^ own[None].view(np.uint64)) <= max_bits
    label = np.arange(n)
    while True:
        low = np.where(near, label[None], n).min(1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    return [(int(own[i]), int(own[label[i]])) for i in range(n) if label[i] != i]


def links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints (``prints.fp``,
    distinct) that pairs within ``max_bits`` bits connect.

    Keys that only one fingerprint has are counted away first. The members of
    one key are compared block against block, so no piece of work holds more
    than about two blocks, and each returns a spanning forest of its verified
    pairs instead of the pairs."""
    all_ = variants(prints, max_bits)
    shared = all_.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # Always by a merge join, which can split a hot key: the same plan at every size.
    parts = (all_.join(shared.hint("merge"), "key")
             .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .where((F.col("blocks") == 1) | (F.col("own") != F.col("other")))
             .groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
             .agg(F.collect_list("fp").alias("fps")))

    @F.pandas_udf("array<struct<a:long,b:long>>")
    def forest(lists: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in _forest(x, max_bits)] for x in lists])

    return (parts.select(F.explode(forest("fps")).alias("e")).select("e.a", "e.b").distinct())


def _classified(rows: DataFrame, at: str, shingle: int, max_bits: int) -> DataFrame:
    marked = saved(rows.select("doc_id", fingerprint(text_or_empty(), shingle).alias("fp"),
                               F.col(at).alias("at")), "prints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("at"))
    prints = saved(marked.groupBy("fp").agg(F.min(rank).alias("first")), "classes")
    linked = saved(components(links(prints.select("fp"), max_bits)).withColumnRenamed("node", "fp"),
                   "components")
    best = linked.join(prints, "fp").groupBy("root").agg(F.min("first").alias("best"))
    classes = (prints.join(linked.join(best, "root").select("fp", "best"), "fp", "left")
               .select("fp", F.coalesce("best", "first").alias("best")))
    return marked.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
        (F.col("best.at") == F.col("at")).alias("kept"), "at")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
                    ) -> DataFrame:
    """A row per document: ``doc_id, fingerprint`` (16 hex digits),
    ``component_id`` (the smallest doc_id in reach), ``kept`` (one row of
    each component), ``at`` (the row's place)."""
    return _classified(*located(docs), shingle, max_bits)


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
                         ) -> DataFrame:
    """``docs`` with one row of each component, its columns unchanged."""
    rows, at = located(docs)
    return without(rows, at, _classified(rows, at, shingle, max_bits).where(~F.col("kept")))
