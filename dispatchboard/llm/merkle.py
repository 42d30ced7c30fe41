"""Merkle manifest of a table as a content-addressed DAG.

Every row is a leaf, the digest of its fields. Per source, leaves in id order
are joined three at a time until one node is left; the sources' nodes, in
source order, are joined likewise into the root. The manifest stores a record
``digest -> children`` for every inner node. A leaf's proof is found from the
root downwards: the base-3 digits of its rank say which child to follow, the
children not followed are collected, and the path's segments are then
reversed so that the proof runs from the leaf to the root. A proof folds any
leaf digest back to a root with Spark expressions alone.

Nodes are handled in segments of ``SEGMENT_LEVELS`` levels (6,561 nodes at
the base). A segment's rows are brought together by one shuffle and streamed,
so a task holds one segment, however many leaves one source has; a path
through the levels above a segment is worked out once for it. The number of
rounds is the number of segments on a path (three for 280 billion leaves).
Every round's records are saved in the shared folder.

Cases: a null field counts as ``-``; a null source is a source of its own and
comes first, null ids come first in their source; rows with one id are
ordered by their digest, and repeated rows are leaves as often as they stand
there; empty and very long texts are hashed whole; a source of one row has
that leaf as its node; an empty table gives no rows and no root; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchboard.llm.shared import located, saved

ARITY = 3
SEGMENT_LEVELS = 8
SEGMENT_NODES = ARITY ** SEGMENT_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Rows a task hands on at a time.
BATCH_ROWS = 4096
STEP = "struct<place: int, others: array<string>>"
_STRINGS = pa.list_(pa.string())
_PATH = pa.list_(pa.struct([("place", pa.int32()), ("others", _STRINGS)]))


def field(value: Column) -> Column:
    """A field as it enters a leaf: its UTF-8 byte count, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def joined(children: Sequence[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def levels_above(nodes: int) -> int:
    """Levels until ``nodes`` are one."""
    n = 0
    while nodes > 1:
        nodes, n = -(-nodes // ARITY), n + 1
    return n


def ranked(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in their ``key`` along ``order`` and
    ``total``, the key's rows. Rows are cut into ranges of (key, order), so a
    key of any size is numbered by many tasks; the ranges are saved, since a
    second sample could cut elsewhere."""
    cut = saved(rows.repartitionByRange(F.col(key), *order).withColumn("_slice", F.spark_partition_id()),
                "slices")
    sums = cut.groupBy("_slice", key).agg(F.count(F.lit(1)).alias("_rows"))
    along, whole = Window.partitionBy(key).orderBy("_slice"), Window.partitionBy(key)
    starts = sums.select("_slice", key, (F.sum("_rows").over(along) - F.col("_rows")).alias("_first"),
                         F.sum("_rows").over(whole).alias("total"))
    place = F.row_number().over(Window.partitionBy("_slice", key).orderBy(*order))
    return (cut.withColumn("_n", place).join(starts, ["_slice", key])
            .withColumn("rank", F.col("_first") + F.col("_n") - 1).drop("_slice", "_first", "_n"))


def _grow(nodes: DataFrame) -> DataFrame:
    """Records of the segments over ``nodes`` (``key, rank, total, digest``):
    ``key, segment, total, top, digest, children``; ``top`` marks a segment's
    last node, which has no children where it is the only node of its key."""
    rows = (nodes.select("key", F.expr(f"rank div {SEGMENT_NODES}").alias("segment"), "rank", "total", "digest")
            .repartition("key", "segment").sortWithinPartitions("key", "segment", "rank"))

    def records(at: tuple[str, int], total: int, level: list[str]) -> Iterator[tuple]:
        above = -(-total // SEGMENT_NODES)
        steps = min(SEGMENT_LEVELS, levels_above(total))
        if not steps:
            yield (*at, above, True, level[0], [])
        for step in range(1, steps + 1):
            runs = [level[i:i + ARITY] for i in range(0, len(level), ARITY)]
            level = [joined(run) for run in runs]
            for digest, run in zip(level, runs):
                yield (*at, above, step == steps, digest, run)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, level, made = None, 0, [], []
        for batch in batches:
            for key, segment, n, digest in zip(*(batch[c].to_pylist()
                                                 for c in ("key", "segment", "total", "digest"))):
                if (key, segment) != at:
                    if level:
                        made += records(at, total, level)
                    at, total, level = (key, segment), n, []
                    if len(made) >= BATCH_ROWS:
                        yield _batch(made)
                        made = []
                level.append(digest)
        if level:
            made += records(at, total, level)
        yield _batch(made)

    def _batch(made: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), _STRINGS]
        columns = list(zip(*made)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          ["key", "segment", "total", "top", "digest", "children"])

    return rows.mapInArrow(run, "key string, segment long, total long, top boolean, digest string, "
                                "children array<string>")


@dataclass
class Tree:
    """Trees over ranked ``nodes``, one a key; ``rounds`` holds the saved
    records of the segments, lowest first."""
    nodes: DataFrame
    rounds: list[DataFrame]

    def roots(self) -> DataFrame:
        """``key, digest`` of each tree's last node."""
        return self.rounds[-1].where("top").select("key", "digest")


def grown(nodes: DataFrame) -> Tree:
    """The trees over ``nodes`` (saved: ``key, rank, total, digest``)."""
    largest = nodes.agg(F.max("total")).first()[0] or 0
    rounds, base = [saved(_grow(nodes), "merkle")], nodes
    while largest > SEGMENT_NODES:
        base = rounds[-1].where("top").select("key", F.col("segment").alias("rank"), "total", "digest")
        rounds.append(saved(_grow(base), "merkle"))
        largest = -(-largest // SEGMENT_NODES)
    return Tree(nodes, rounds)


def _descend(starts: DataFrame, records: DataFrame, requests: DataFrame) -> DataFrame:
    """For ``requests`` (``key, rank, load``) the digest that their rank's
    digits lead to from the ``start`` of their segment, and the path back:
    ``key, rank, load, digest, path, origin``. ``starts`` (``key, segment,
    digest, path, origin``) has a row for each segment; ``origin`` is handed on."""
    load = requests.schema["load"].dataType.simpleString()
    shape = ["key", "segment", "kind", "rank", "total", "digest", "children", "path", "origin", "load"]

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        types = {"rank": "long", "total": "long", "digest": "string", "children": "array<string>",
                 "path": f"array<{STEP}>", "origin": "string", "load": load}
        return df.select([F.lit(kind).alias(c) if c == "kind" else F.col(c) if c in df.columns
                          else F.lit(None).cast(types[c]).alias(c) for c in shape])

    asked = requests.withColumn("segment", F.expr(f"rank div {SEGMENT_NODES}"))
    rows = (shaped(starts, 0).unionByName(shaped(records.where(F.size("children") > 0).drop("total", "top"), 1))
            .unionByName(shaped(asked, 2))
            .repartition("key", "segment").sortWithinPartitions("key", "segment", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, above, origin, children = None, [], None, {}
        for batch in batches:
            held = {c: batch[c].to_pylist() for c in ("kind", "rank", "total", "digest", "children", "path",
                                                      "origin")}
            chosen, digests, paths, origins = [], [], [], []
            for i, kind in enumerate(held["kind"]):
                if kind == 0:
                    start, children = held["digest"][i], {}
                    above, origin = held["path"][i], held["origin"][i]
                elif kind == 1:
                    children[held["digest"][i]] = held["children"][i]
                else:
                    rank, segments = held["rank"][i], []
                    steps = min(SEGMENT_LEVELS, levels_above(held["total"][i]))
                    node = start
                    for step in reversed(range(steps)):
                        digit = rank // ARITY ** step % ARITY
                        below = children[node]
                        segments.append({"place": digit, "others": below[:digit] + below[digit + 1:]})
                        node = below[digit]
                    chosen.append(i)
                    digests.append(node)
                    paths.append(segments[::-1] + above)
                    origins.append(origin)
                    if len(chosen) >= BATCH_ROWS:
                        yield _batch(batch, chosen, digests, paths, origins)
                        chosen, digests, paths, origins = [], [], [], []
            yield _batch(batch, chosen, digests, paths, origins)

    def _batch(batch: pa.RecordBatch, chosen: list[int], digests: list, paths: list, origins: list
               ) -> pa.RecordBatch:
        some = pa.array(chosen, pa.int64())
        made = [pa.array(digests, pa.string()), pa.array(paths, _PATH), pa.array(origins, pa.string())]
        return pa.RecordBatch.from_arrays([*(batch[c].take(some) for c in ("key", "rank", "load")), *made],
                                          ["key", "rank", "load", "digest", "path", "origin"])

    return rows.mapInArrow(run, T.StructType([
        *(rows.schema[c] for c in ("key", "rank", "load", "digest", "path", "origin"))]))


def proved(tree: Tree, starts: DataFrame, load: Column) -> DataFrame:
    """Proofs of all leaves of ``tree``: ``key, rank, load, digest, path,
    origin``. ``starts`` has the trees' roots: ``key, digest, path, origin``."""
    starts = starts.withColumn("segment", F.lit(0).cast("long"))
    for k in reversed(range(len(tree.rounds))):
        asked = tree.nodes.select("key", "rank", "total", load.alias("load")) if k == 0 else (
            tree.rounds[k - 1].where("top").select("key", F.col("segment").alias("rank"), "total",
                                                   F.lit(None).cast("string").alias("load")))
        found = _descend(starts, tree.rounds[k], asked)
        if k == 0:
            return found
        starts = saved(found.select("key", F.col("rank").alias("segment"), "digest", "path", "origin"), "starts")


@dataclass
class Manifest:
    root: str | None
    leaves: Tree
    sources: Tree

    def records(self) -> DataFrame:
        """The stored DAG: ``digest, children`` of every inner node."""
        parts = [r.where(F.size("children") > 0).select("digest", "children")
                 for r in (*self.leaves.rounds, *self.sources.rounds)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.distinct()

    def proofs(self, load: Column | None = None) -> DataFrame:
        """``load, leaf, subroot, proof`` of every leaf; ``proof`` lists, from
        the leaf to the root, the node's place in its run and the run's other
        digests."""
        top = self.sources.nodes.sparkSession.range(1).select(
            F.lit("").alias("key"), F.lit(self.root).cast("string").alias("digest"),
            F.from_json(F.lit("[]"), f"array<{STEP}>").alias("path"), F.lit(None).cast("string").alias("origin"))
        subroots = proved(self.sources, top, F.col("source"))
        starts = saved(subroots.select(F.col("load").alias("key"), "digest", "path",
                                       F.col("digest").alias("origin")), "starts")
        load = F.lit(None).cast("string") if load is None else load
        return proved(self.leaves, starts, load).select(
            "load", F.col("digest").alias("leaf"), F.col("origin").alias("subroot"), F.col("path").alias("proof"))


def manifest(rows: DataFrame, source: str = "source", order: str = "doc_id", digest: str = "leaf") -> Manifest:
    """The manifest of ``rows``, whose column ``digest`` holds the leaves."""
    placed, at = located(rows)
    keyed = placed.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")))
    keyed = keyed.withColumnRenamed(digest, "digest")
    nodes = saved(ranked(keyed, "key", [F.col(order).asc_nulls_first(), F.col("digest"), F.xxhash64(at)]).drop(at),
                  "leaves")
    leaves = grown(nodes)
    roots = leaves.roots().select(F.col("key").alias("source"), "digest", F.lit("").alias("key"))
    sources = grown(saved(ranked(roots, "key", [F.col("source")]), "sources"))
    last = sources.roots().first()
    return Manifest(last["digest"] if last else None, leaves, sources)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to by ``proof``."""
    def step(node: Column, run: Column) -> Column:
        before = F.slice(run["others"], F.lit(1), run["place"])
        after = F.slice(run["others"], run["place"] + 1, F.lit(ARITY))
        return F.sha2(F.concat(F.concat_ws("", before), node, F.concat_ws("", after)), 256)
    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """H of a proof's digests, from the leaf to the root, left to right."""
    return F.sha2(F.concat_ws("", F.flatten(F.transform(proof, lambda run: run["others"]))), 256)


def checked(docs: DataFrame, suspect: Column, changed: Column) -> DataFrame:
    """Proofs of all ``docs`` and their check against texts as found:
    ``doc_id, leaf, subroot, root, proof, folded_root, verified``. Rows where
    ``suspect`` holds are checked with the text ``changed``."""
    fields = [F.col(c) for c in FIELDS]
    rows = docs.select("doc_id", "source", leaf(*fields).alias("leaf"),
                       F.when(suspect, leaf(*fields[:-1], changed)).alias("found"))
    made = manifest(rows)
    proofs = made.proofs(F.struct("doc_id", "found"))
    back = folded(F.coalesce("load.found", "leaf"), F.col("proof"))
    return (proofs.select("load.doc_id", "leaf", "subroot", F.lit(made.root).cast("string").alias("root"),
                          "proof", back.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
