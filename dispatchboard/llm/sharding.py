"""Sharding by sampled splitters, as DataFrame operations only.

Records are ordered by a hash of their text, then of their doc_id and row
number, so equal texts lie together. A size-weighted sample of these keys gives quantile
boundaries of many narrow ranges; ranges are summed exactly and dealt to the
shards, largest first to the emptiest, which makes the shards' bytes near
equal. A text whose copies weigh more than a range is one range of its own
up to nine tenths of a shard; above that its range is overfull and is subdivided by the
second hash.

The driver sees the sample and the range sums: both have a fixed size, set by
the number of shards, whatever the input.

Cases: a null text has size 0 (plus the overhead) and the CRC of an empty
one; null and repeated doc_ids are allowed, each row takes a slot; an empty table gives no rows; shards may stay empty when
there are few rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispatchboard.llm.shared import located, saved, small_table, text_or_empty

SHARDS = 40
OVERHEAD_BYTES = 16
# Ranges drawn for each shard, and sampled keys for each range.
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 16
# A text's copies are kept in one range up to this part of a shard.
WHOLE_SHARE = 0.9
# Records that one piece of slot numbering aims at.
CHUNK_ROWS = 4096
# Boundaries are looked up by this many leading bits of the key.
LOOKUP_BITS = 10
SEED = 11


def _top(key: Column) -> Column:
    """Leading bits of a signed 64-bit key, 0 for the smallest keys."""
    return (F.shiftright(key, 64 - LOOKUP_BITS) + F.lit(1 << (LOOKUP_BITS - 1))).cast("int")


def _splitters(records: DataFrame, total: int, shards: int) -> tuple[list[int], dict[int, list[int]]]:
    """First keys of the ranges, and for every text that is too heavy for one
    range the doc_id hashes that subdivide it."""
    ranges = shards * RANGES_PER_SHARD
    unit = max(1.0, total / (ranges * SAMPLES_PER_RANGE))  # bytes one draw stands for
    # A record is drawn once for each unit of bytes it covers, the rest of its
    # size by a seeded chance: no row is random, so a rerun draws the same.
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "key", "tie"), 11) / F.lit(float(1 << 53))
    draws = F.floor(F.col("size") / F.lit(unit) + chance)
    keys: dict[int, int] = {}
    sample = records.select("key", "tie", draws.alias("draws")).where(F.col("draws") > 0)
    per_key = sample.groupBy("key").agg(F.sum("draws").alias("draws"))
    for key, n in per_key.orderBy("key").collect():
        keys[key] = n
    heavy_at = WHOLE_SHARE * RANGES_PER_SHARD * SAMPLES_PER_RANGE
    heavy = [k for k, n in keys.items() if n > heavy_at]
    firsts, filled = [], 0
    for key, n in keys.items():
        own = n > SAMPLES_PER_RANGE
        if own or filled >= SAMPLES_PER_RANGE:
            firsts.append(key)
            filled = 0
        if own:
            firsts.append(min(key + 1, (1 << 63) - 1))  # what follows starts anew
        else:
            filled += n
    ties: dict[int, list[int]] = {}
    if heavy:
        inside = (sample.where(F.col("key").isin(heavy)).groupBy("key", "tie")
                  .agg(F.sum("draws").alias("draws")).orderBy("key", "tie").collect())
        for key in heavy:
            step, filled, cuts = SAMPLES_PER_RANGE * RANGES_PER_SHARD // 16, 0, []
            for r in (r for r in inside if r["key"] == key):
                if filled >= step:
                    cuts.append(r["tie"])
                    filled = 0
                filled += r["draws"]
            ties[key] = cuts
    return sorted(set(firsts)), ties


def _range_of(firsts: list[int], ties: dict[int, list[int]]) -> Column:
    """The number of a record's range: boundaries at or below its key, found
    among those that share the key's leading bits; a heavy text's records by
    their ties."""
    step = 1 << (64 - LOOKUP_BITS)
    lows = [(i - (1 << (LOOKUP_BITS - 1))) * step for i in range(1 << LOOKUP_BITS)]
    start = [bisect_left(firsts, low) for low in lows] + [len(firsts)]
    held = [firsts[a:b] for a, b in zip(start, start[1:])]

    def longs(values: list[int]) -> Column:
        return F.from_json(F.lit(str(values)), "array<bigint>")
    table = F.from_json(F.lit(str(held)), "array<array<bigint>>")
    base = F.from_json(F.lit(str(start[:-1])), "array<int>")
    number = (F.get(base, _top(F.col("key")))
              + F.size(F.filter(F.get(table, _top(F.col("key"))), lambda b: b <= F.col("key"))))
    sub = F.lit(0)
    for key, cuts in ties.items():
        sub = F.when(F.col("key") == F.lit(key),
                     F.size(F.filter(longs(cuts), lambda b: b <= F.col("tie")))).otherwise(sub)
    return F.struct(number.alias("range"), sub.alias("part"))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD_BYTES
                   ) -> DataFrame:
    """A row per document: ``doc_id, size, text_crc32, shard, slot``. Shards
    hold near equal bytes; slots run from 0 in each without gaps; equal texts
    share a shard unless their copies fill nearly a whole one."""
    spark = docs.sparkSession
    text = text_or_empty()
    rows, at = located(docs)
    records = saved(rows.select(
        "doc_id", (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
        F.xxhash64(F.lit(SEED), F.col("doc_id"), rows[at]["row"]).alias("tie")), "records")
    total = records.agg(F.sum("size")).first()[0] or 0
    firsts, ties = _splitters(records, total, shards)
    ranged = saved(records.withColumn("at", _range_of(firsts, ties)).select("*", "at.*").drop("at"),
                   "ranges")
    sums = (ranged.groupBy("range", "part").agg(F.sum("size").alias("bytes"),
                                                F.count(F.lit(1)).alias("rows")).collect())
    # Largest range first to the shard with the fewest bytes so far.
    free = [(0, s) for s in range(shards)]
    dealt = []
    for r in sorted(sums, key=lambda r: (-r["bytes"], r["range"], r["part"])):
        filled, shard = heapq.heappop(free)
        dealt.append({"range": r["range"], "part": r["part"], "shard": shard,
                      "chunks": -(-r["rows"] // CHUNK_ROWS)})
        heapq.heappush(free, (filled + r["bytes"], shard))
    # A fixed number of ranges, so this side's size is bounded.
    deal = F.broadcast(small_table(spark, dealt, "range: int, part: int, shard: int, chunks: bigint"))
    placed = (ranged.join(deal, ["range", "part"])
              .withColumn("chunk", F.pmod(F.xxhash64("tie", "key"), F.col("chunks"))))
    piece = ["shard", "range", "part", "chunk"]
    before = Window.partitionBy("shard").orderBy("range", "part", "chunk")
    starts = (placed.groupBy(*piece).agg(F.count(F.lit(1)).alias("rows"))
              .withColumn("first", F.sum("rows").over(before) - F.col("rows")).drop("rows"))
    within = Window.partitionBy(*piece).orderBy("key", "tie", "doc_id")
    return (placed.withColumn("n", F.row_number().over(within))
            .join(starts, piece)
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first") + F.col("n") - 1).alias("slot")))
