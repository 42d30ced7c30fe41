"""Mixing sources to target weights by a min-cost flow.

Documents may belong to several sources. They are aggregated by membership
pattern (the set of their sources); a flow network routes each pattern's
tokens to the quotas of its sources, every further repetition of a pattern
costing more than the one before it; then each pattern gives whole passes
over its documents and, for the rest of its flow, a seeded choice of them.

The driver holds one row per source and per membership pattern: the mix's
configuration, not its data. Documents are reduced to sizes once, patterns
are pre-aggregated in the map tasks, and the seeded choice cuts a pattern by
hash into about ``sqrt(rows)`` buckets: whole buckets are taken by their sums,
and only the bucket where the quota ends is looked at row by row. What stays
unfilled there goes to the later buckets in the same way, with the documents
that still fit, until none does; this is the choice that takes a pattern's
documents one by one in drawn order, each that still fits.

Cases: null and empty texts have size 0; a null source is a source of its
own (last in order); null doc_ids are allowed; rows repeated with one doc_id,
pattern and text count as often as they stand there; a source of size 0 gets
target 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchboard.llm.shared import fresh, located, saved, text_or_empty

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
SEED = 7


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORDS)).cast("long")


def capped_targets(sizes: dict, weights: dict, total: float, most: float = MOST_REPEATS) -> dict:
    """Shares of ``total`` by weight; none exceeds ``most`` times its size,
    and what is above goes to the others by weight."""
    target = {s: 0.0 for s in sizes}
    free, left = set(sizes), min(float(total), most * sum(sizes.values()))
    while free:
        unit = left / sum(weights[s] for s in free)
        full = {s for s in free if weights[s] * unit >= most * sizes[s]}
        for s in full or free:
            target[s] = float(most * sizes[s]) if full else weights[s] * unit
        if not full:
            break
        left -= sum(target[s] for s in full)
        free -= full
    return target


def cycled_weights(sources: Sequence, weights: Sequence[float] = WEIGHTS) -> dict:
    """The weights in turn over the sources in code point order, null last."""
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: weights[i % len(weights)] for i, s in enumerate(order)}


def route(capacity: dict, quota: dict, most: int = MOST_REPEATS) -> dict:
    """Min-cost flow ``{(pattern, source): tokens}`` from patterns (tuples of
    sources; ``capacity``: tokens of one pass) to ``quota``. The n-th pass of
    a pattern costs more than any earlier pass of any pattern, so costs are
    convex, and all flow that an earlier pass can carry is routed before a
    later one opens; each opening is a maximum flow over shortest augmenting
    paths, which may reroute what was placed before."""
    flow: dict = defaultdict(int)
    users = defaultdict(list)
    for p in capacity:
        for s in p:
            users[s].append(p)
    spare, need = {p: 0 for p in capacity}, {s: int(q) for s, q in quota.items()}
    for _ in range(most):
        for p, tokens in capacity.items():
            spare[p] += int(tokens)
        while True:
            # Breadth first from every pattern that can still give.
            came: dict = {("p", p): None for p, n in spare.items() if n}
            todo, end = deque(came), None
            while todo and end is None:
                kind, x = todo.popleft()
                if kind == "p":
                    for s in x:
                        if ("s", s) not in came:
                            came["s", s] = (kind, x)
                            if need.get(s, 0):
                                end = ("s", s)
                                break
                            todo.append(("s", s))
                else:
                    for p in users[x]:
                        if ("p", p) not in came and flow[p, x]:
                            came["p", p] = (kind, x)
                            todo.append(("p", p))
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            amount = min([spare[path[0][1]], need[end[1]]]
                         + [flow[b[1], a[1]] for a, b in zip(path, path[1:]) if a[0] == "s"])
            for a, b in zip(path, path[1:]):
                if a[0] == "p":
                    flow[a[1], b[1]] += amount
                else:
                    flow[b[1], a[1]] -= amount
            spare[path[0][1]] -= amount
            need[end[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def _plan(sizes: DataFrame, most: int, weights, share) -> list[tuple]:
    """A row per pattern: ``sources, passes, rest, buckets`` and the sizes and
    targets of its sources in their order."""
    rows = sizes.groupBy("sources").agg(F.sum("size").alias("tokens"),
                                        F.count(F.lit(1)).alias("docs")).collect()
    capacity = {tuple(r["sources"]): r["tokens"] for r in rows}
    docs = {tuple(r["sources"]): r["docs"] for r in rows}
    size: dict = defaultdict(int)
    for p, tokens in capacity.items():
        for s in p:
            size[s] += tokens
    target = capped_targets(size, cycled_weights(list(size), weights),
                            share * sum(capacity.values()), most)
    given: dict = defaultdict(int)
    for (p, _), n in route(capacity, {s: round(t) for s, t in target.items()}, most).items():
        given[p] += n
    out = []
    for p, tokens in capacity.items():
        passes, rest = divmod(given[p], tokens) if tokens else (0, 0)
        out.append((list(p), passes, rest, max(1, int(docs[p] ** 0.5 / 4)),
                    [size[s] for s in p], [target[s] for s in p]))
    return out


def _by_pattern(rows: DataFrame, plan: list[tuple], ddl: str) -> DataFrame:
    """``rows`` with the columns of their pattern's row in ``plan``."""
    table = rows.sparkSession.createDataFrame(plan, "pattern array<string>, " + ddl)
    return rows.join(table, F.col("sources").eqNullSafe(F.col("pattern"))).drop("pattern")


def _bucket(seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "draw"), F.col("buckets"))


def _chosen(some: pa.Table) -> tuple[pa.Table, list[int], int]:
    """Documents in drawn order, 1 for each that still fits, and the room left."""
    some = some.take(pc.sort_indices(some, [("draw", "ascending"), ("size", "ascending")]))
    room, extra = some["room"][0].as_py(), []
    for n in some["size"].to_pylist():
        extra.append(int(0 < n <= room))
        room -= n * extra[-1]
    return some, extra, room


def _steps(sizes: DataFrame, plan: list[tuple], seed: int) -> dict[tuple, list[tuple]]:
    """``{pattern: [(after, edge, cap, room)]}``: of the documents no larger
    than ``cap``, buckets between ``after`` and ``edge`` are taken whole, and
    bucket ``edge`` gives ``room`` tokens. A step starts from the room that
    its predecessor's edge left, so the last one leaves no document that fits."""
    buckets = {tuple(p): n for p, _, _, n, *_ in plan}
    steps: dict = defaultdict(list)
    todo = {tuple(p): (-1, rest) for p, _, rest, *_ in plan if rest}
    left_type = T.StructType([T.StructField("sources", T.ArrayType(T.StringType())),
                              T.StructField("left", T.LongType())])

    def left(some: pa.Table) -> pa.Table:
        return pa.table({"sources": some["sources"].slice(0, 1),
                         "left": pa.array([_chosen(some)[2]], pa.int64())})

    order = Window.partitionBy("sources").orderBy("bucket")
    while todo:
        fit = (_by_pattern(sizes, [(list(p), buckets[p], after, cap) for p, (after, cap) in todo.items()],
                           "buckets int, after int, cap long")
               .withColumn("bucket", _bucket(seed))
               .where((F.col("bucket") > F.col("after")) & F.col("size").between(1, F.col("cap"))))
        before = F.coalesce(F.sum("sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ends = (fit.groupBy("sources", "bucket", "cap").agg(F.sum("size").alias("sum"))
                .withColumn("room", F.col("cap") - before)
                .where((F.col("room") >= 0) & (F.col("room") < F.col("sum"))).collect())
        edges = {tuple(r["sources"]): (r["bucket"], r["room"]) for r in ends}
        for p, (after, cap) in todo.items():
            edge, room = edges.get(p, (buckets[p], 0))
            steps[p].append((after, edge, cap, room))
        at_edge = [(list(p), buckets[p], edge, room) for p, (edge, room) in edges.items() if room]
        rooms = [] if not at_edge else (
            _by_pattern(sizes, at_edge, "buckets int, edge int, room long")
            .where((_bucket(seed) == F.col("edge")) & F.col("size").between(1, F.col("room")))
            .groupBy("sources").applyInArrow(left, left_type).collect())
        # An edge where nothing fits passes its room on whole.
        after_edge = {tuple(p): room for p, _, _, room in at_edge}
        after_edge |= {tuple(r["sources"]): r["left"] for r in rooms}
        todo = {p: (edges[p][0], room) for p, room in after_edge.items() if room}
    return steps


def mix(docs: DataFrame, sources: Column | None = None, weights: Sequence[float] = WEIGHTS,
        share: float = SHARE, most: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """A row per document: ``doc_id, sources, size, source_sizes, targets,
    copies, taken, at``. ``sources`` is an array column of the sources a
    document belongs to (default: its ``source`` alone); ``copies`` says how
    often the mix takes it."""
    return _mixed(*located(docs), sources, weights, share, most, seed)


def _mixed(rows: DataFrame, at: str, sources, weights, share, most, seed) -> DataFrame:
    text = text_or_empty()
    member = F.array(F.col("source").cast("string")) if sources is None else sources
    sizes = saved(rows.select(
        "doc_id", F.array_sort(F.array_distinct(member)).alias("sources"),
        word_count(text).alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), text).alias("draw"), F.col(at).alias("at")), "sizes")
    plan = _plan(sizes, most, weights, share)
    steps = _steps(sizes, plan, seed)
    full = (_by_pattern(sizes, [(*row, steps.get(tuple(row[0]), [])) for row in plan],
                        "passes long, rest long, buckets int, source_sizes array<long>, targets array<double>, "
                        "steps array<struct<after: int, edge: int, cap: long, room: long>>")
            .withColumn("bucket", _bucket(seed))
            .withColumn("step", F.get(F.filter("steps", lambda s: (F.col("bucket") > s["after"])
                                               & (F.col("bucket") <= s["edge"])), F.lit(0)))
            .withColumn("room", F.col("step.room")).drop("steps"))
    out = ["doc_id", "sources", "size", "source_sizes", "targets", "copies", "at"]
    edge = F.coalesce(F.col("bucket") == F.col("step.edge"), F.lit(False))
    whole = F.coalesce(F.col("size").between(1, F.col("step.cap")), F.lit(False))
    plain = full.where(~edge).withColumn("copies", F.col("passes") + whole.cast("long"))
    schema = T.StructType([*(f for f in full.schema.fields if f.name in out),
                           T.StructField("copies", T.LongType())])

    def choose(some: pa.Table) -> pa.Table:
        some, extra, _ = _chosen(some)
        copies = pc.add(some["passes"], pa.array(extra, pa.int64()))
        return some.append_column("copies", copies).select(schema.names)

    split = full.where(edge).drop("step").groupBy("sources", "bucket").applyInArrow(choose, schema)
    return (plain.select(*out).union(split.select(*out))
            .withColumn("taken", F.col("copies") * F.col("size")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for every copy, columns unchanged."""
    settings = {"sources": None, "weights": WEIGHTS, "share": SHARE, "most": MOST_REPEATS,
                "seed": SEED} | options
    rows, at = located(docs)
    there, copy = fresh(rows.columns, "there"), fresh(rows.columns, "copy")
    taken = (_mixed(rows, at, **settings).where(F.col("copies") > 0)
             .select(F.col("at").alias(there), F.explode(F.sequence(F.lit(1), "copies")).alias(copy)))
    return rows.join(taken, rows[at] == taken[there]).drop(at, there, copy)
