"""Embedding near-dedup by lattice hashing.

Unit vectors are projected at random to eight dimensions, once per table, and
decoded to the nearest point of the E8 lattice: the vector's home cell. Close
vectors often share a cell, and where they don't, their cells are neighbours,
so each vector also visits the neighbouring cells nearest to it. Vectors that
meet in a cell are verified by their cosine in double precision.

Equal vectors are one class from the start. Members of a cell are compared
block against block, and each piece of work returns a spanning forest of its
links, not the links. All links of a vector lie in its component, so they are
counted there, again block against block; every pair with the threshold's
cosine in a component counts, whether or not a cell had brought it together.

The scale of the projections sets the cell size: unrelated vectors share a
home cell with probability about ``1 / (4 pi scale^2)^4``, 1 in 4,000 at
``SCALE``. ``sized`` takes scale and tables from the number of different
vectors: the scale grows with its eighth root beyond 400,000, so that a home
cell holds about ``CELL`` unrelated vectors however many there are, and the
tables follow the recall of one table at that scale, measured on a fixed draw
of pairs just at the threshold. ``RECALL`` 0.94 at cosine 0.9 leaves all but a
few in a thousand at 0.93 and above. Tables, and with them the work for a
vector, grow like the number of vectors to the power 0.57 (4 tables up to
400,000 vectors, 8 for 2.4 million, 36 for 35 million).

Cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, not even their copies; vectors of different
length never link; labels are ignored; repeated rows are copies; null vec_ids
rank last, and a component of them alone has a null component_id (then
kept); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchboard.llm.components import components
from dispatchboard.llm.shared import saved

COSINE = 0.9
VISITS = 8
SCALE = 0.8
CELL = 100
RECALL = 0.94
TRIALS = 4096
SEED = 2
BLOCK = 1024
# Vectors hashed at a time.
STEP = 2048


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, the steps to a cell's neighbours."""
    steps = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            steps.append(v)
    steps += [np.array(s) for s in product((0.5, -0.5), repeat=8) if np.prod(s) > 0]
    return np.array(steps)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum of coordinates."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: even integer points, or those
    shifted by one half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def _packed(cells: np.ndarray) -> np.ndarray:
    """A cell's doubled coordinates, one byte each, as a long."""
    return np.ascontiguousarray(np.rint(2 * cells).astype(np.int8)).view("<i8")[..., 0]


def _visited(x: np.ndarray, visits: int) -> np.ndarray:
    """(row, 1 + visits) packed cells of projected rows; the home cell is the first."""
    steps, home = _shortest(), decode(x)
    nearest = np.argsort(-((x - home) @ steps.T), axis=1, kind="stable")[:, :visits]
    return np.concatenate([_packed(home)[:, None], _packed(
        (home[:, None] + steps[nearest]).reshape(-1, 8)).reshape(-1, visits)], axis=1)


def cells(unit: np.ndarray, tables: int, visits: int = VISITS, scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """(row, table, 1 + visits) packed cells; the home cell is the first."""
    out = np.empty((len(unit), tables, 1 + visits), np.int64)
    for t in range(tables):
        spread = np.random.default_rng([seed, t, unit.shape[1]]).normal(0, scale, (unit.shape[1], 8))
        out[:, t] = _visited(unit @ spread, visits)
    return out


def table_recall(scale: float, cosine: float = COSINE, visits: int = VISITS, trials: int = TRIALS) -> float:
    """Share of pairs at that cosine which one table brings together: a random
    projection of two such vectors is eight pairs of correlated normals."""
    rng = np.random.default_rng(SEED)
    x, z = rng.normal(0, scale, (2, trials, 8))
    a, b = _visited(x, visits), _visited(cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * z, visits)
    return float(((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)).mean())


def sized(vectors: int, cosine: float = COSINE, visits: int = VISITS, cell: float = CELL, recall: float = RECALL
          ) -> tuple[float, int]:
    """Scale and tables for that many different vectors."""
    scale = max(SCALE, (vectors / cell) ** 0.125 / np.sqrt(4 * np.pi))
    one = table_recall(scale, cosine, visits)
    one = min(max(one, 1 / TRIALS), 1 - 1 / TRIALS)
    return scale, int(np.ceil(np.log(1 - recall) / np.log(1 - one)))


def _units(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, float) for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a stream sorted by ``keys``, one frame each."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        if held:
            batch = pd.concat([*held, batch], ignore_index=True)
        change = np.zeros(len(batch), bool)
        for k in keys:
            v = batch[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.iloc[a:b]
        held = [batch.iloc[cuts[-1]:]]
    if held:
        yield held[0]


def _pieces(rows: DataFrame, keys: list[str], count: str, block: int, within: bool) -> DataFrame:
    """``rows`` (``count``: how many share their keys) dealt to pairs of
    blocks ``(i, j)``; ``own`` is a row's block. A single block is paired with
    itself; of several, blocks meet themselves only if ``within``."""
    return (rows.withColumn("blocks", F.ceil(F.col(count) / block).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .where(F.lit(within) | (F.col("blocks") == 1) | (F.col("own") != F.col("other")))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j"))


def _forest(rid: np.ndarray, home: np.ndarray, unit: np.ndarray, cosine: float
            ) -> list[tuple[int, int]]:
    near = unit[home] @ unit.T >= cosine
    if near.sum() <= len(near):  # each with itself
        return []
    at, label = np.flatnonzero(home), np.arange(len(rid))
    while True:
        low = np.where(near, label[None], len(rid)).min(1)
        new = label.copy()
        new[at] = np.minimum(new[at], low)
        new = np.minimum(new, np.where(near, new[at][:, None], len(rid)).min(0))
        if (new == label).all():
            break
        label = new
    return [(int(rid[k]), int(rid[label[k]])) for k in range(len(rid)) if label[k] != k]


def links(classes: DataFrame, cosine: float, tables: int, visits: int, scale: float, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that connect the classes (``rid, embedding``, a saved
    table) which pairs found connect."""
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        per = tables * (1 + visits)
        for batch in batches:
            width = batch["embedding"].map(len)
            for n in sorted(width.unique()):
                same = batch[width == n]
                for k in range(0, len(same), STEP):
                    some = same.iloc[k:k + STEP]
                    yield pd.DataFrame({
                        "rid": np.repeat(some["rid"].to_numpy(), per),
                        "width": np.int32(n),
                        "tab": np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + visits), len(some)),
                        "cell": cells(_units(some["embedding"]), tables, visits, scale).ravel(),
                        "home": np.tile(np.arange(1 + visits) == 0, len(some) * tables)})

    key = ["width", "tab", "cell"]
    index = saved(classes.select("rid", "embedding").mapInPandas(
        hashed, "rid long, width int, tab int, cell long, home boolean"), "cells")
    met = (index.groupBy(*key).agg(F.count(F.lit(1)).alias("n"),
                                   F.max("home").alias("any"))
           .where((F.col("n") > 1) & F.col("any")).drop("any"))
    rows = index.join(met, key).join(classes.select("rid", "embedding"), "rid")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _runs(batches, [*key, "i", "j"]):
            home = group["home"].to_numpy()
            if len(group) > 1 and home.any():
                found = _forest(group["rid"].to_numpy(), home, _units(group["embedding"]), cosine)
                if found:
                    yield pd.DataFrame(found, columns=["a", "b"])

    return (_pieces(rows, key, "n", block, within=False)
            .select(*key, "i", "j", "home", "rid", "embedding")
            .mapInPandas(compared, "a long, b long").distinct())


def _counted(members: DataFrame, cosine: float, block: int) -> DataFrame:
    """``rid, found``: vectors linked to each class in its component.
    ``members``: ``rid, root, copies, embedding``, a saved table."""
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    rows = members.join(sizes, "root")

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _runs(batches, ["root", "i", "j"]):
            copies, unit = group["copies"].to_numpy(), _units(group["embedding"])
            near = unit @ unit.T >= cosine
            np.fill_diagonal(near, False)
            if group["i"].iloc[0] != group["j"].iloc[0]:
                own = group["own"].to_numpy()
                near &= own[:, None] != own[None]
            yield pd.DataFrame({"rid": group["rid"].to_numpy(), "found": near @ copies})

    return (_pieces(rows, ["root"], "n", block, within=True)
            .select("root", "i", "j", "own", "rid", "copies", "embedding")
            .mapInPandas(tally, "rid long, found long")
            .groupBy("rid").agg(F.sum("found").alias("found")))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, visits: int = VISITS, cell: float = CELL,
                    recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """A row per vector: ``vec_id, n_links, component_id, kept``. ``cell`` and
    ``recall`` set the lattice (see ``sized``)."""
    element = vectors.schema["embedding"].dataType.elementType
    real = element if isinstance(element, (T.FloatType, T.DoubleType)) else T.DoubleType()
    rows = vectors.select("vec_id", F.col("embedding").cast(T.ArrayType(real)).alias("embedding"))
    fit = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                              & (F.abs(x) < float("inf")))
                     & F.exists("embedding", lambda x: x != 0), F.lit(False))
    first = F.min(F.struct(F.col("vec_id").isNull().alias("none"), F.col("vec_id")))
    classes = saved(rows.where(fit).groupBy("embedding")
                    .agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
                    .withColumn("rid", F.monotonically_increasing_id()), "vectors")
    scale, tables = sized(classes.count(), cosine, visits, cell, recall)
    linked = saved(components(links(classes, cosine, tables, visits, scale, block)), "components")
    members = saved(classes.join(linked.withColumnRenamed("node", "rid"), "rid"), "members")
    least = members.groupBy("root").agg(F.min("first").alias("least"))
    known = (members.join(least, "root").join(_counted(members, cosine, block), "rid")
             .select("rid", "least", "found"))
    full = (classes.join(known, "rid", "left")
            .select("embedding", (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("least", "first")["vec_id"].alias("component_id")))
    out = rows.where(fit).join(full, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                    F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
