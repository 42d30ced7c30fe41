import math

import numpy as np
import pytest

from dispatchboard.llm import lattice, queries
from tests.conftest import SF_ORACLE
from tests.llm.cases import from_table


def plain(ids, vectors, cosine=0.9):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        low = np.minimum(label, np.where(near, label[None], max(ids)).min(1))
        if (low == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), label)}
        label = low


def found(rows):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


def test_query_on_the_whole_table(spark):
    rows = queries.op2_lattice(spark, SF_ORACLE).collect()
    data = from_table(spark, SF_ORACLE, "embeddings").toPandas()
    assert found(rows) == plain(data["vec_id"].tolist(), np.array(data["embedding"].tolist(), float))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)


def clusters(seed, groups, size, cosine, width=64):
    """Copies turned away from a centre by the angle of half the cosine's."""
    rng = np.random.default_rng(seed)
    turn = math.acos(cosine) / 2
    out = []
    for _ in range(groups):
        c = rng.normal(size=width)
        c /= np.linalg.norm(c)
        for _ in range(size):
            z = rng.normal(size=width)
            z -= (z @ c) * c
            out.append((math.cos(turn) * c + math.sin(turn) * z / np.linalg.norm(z)) * rng.uniform(0.5, 3))
    return np.array(out)


@pytest.mark.parametrize("cosine", [0.9, 0.95])
def test_recall_of_close_pairs(spark, cosine):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 64))
    z = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = (cosine + 1e-9) * x + math.sqrt(1 - (cosine + 1e-9) ** 2) * z
    both = np.concatenate([x, y])
    rows = lattice.near_duplicates(spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")).collect()
    want = plain(list(range(len(both))), both)
    got = found(rows)
    linked = [i for i in want if want[i][0]]
    assert len(linked) >= 2900
    assert sum(got[i][0] for i in linked) >= 0.9 * sum(want[i][0] for i in linked)
    assert all(got[i][0] <= want[i][0] for i in want)


@pytest.mark.parametrize("block", [1024, 16])
def test_dense_groups_count_every_link_once(spark, block):
    v = np.concatenate([clusters(3, 3, 70, 0.97), np.random.default_rng(4).normal(size=(200, 64))])
    rows = lattice.near_duplicates(spark.createDataFrame(
        [(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"),
        block=block).collect()
    assert found(rows) == plain(list(range(len(v))), v)


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 2, (200, 8))
    got = lattice.decode(x)
    steps = lattice._shortest()
    assert len(steps) == 240 and np.allclose((steps ** 2).sum(1), 2)
    doubled = 2 * got
    assert np.allclose(doubled, np.rint(doubled)) and np.allclose(got.sum(1) % 2, 0)
    near = ((x - got) ** 2).sum(1)
    others = ((x[:, None] - got[:, None] - steps[None]) ** 2).sum(2).min(1)
    assert (near <= others + 1e-9).all()


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    a = [1.0, 0.0, 0.5]
    data = [(1, a), (2, a), (2, a), (3, None), (4, [0.0, 0.0, 0.0]), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 0.0]),
            (7, [nan, 1.0, 0.0]), (8, [inf, 1.0, 0.0]), (9, [None, 1.0, 0.0]), (10, []), (None, a),
            (11, [2.0, 0.0, 1.0]), (12, [1.0, 0.0]), (13, [-1.0, 0.0, -0.5])]
    frame = spark.createDataFrame([(*r, 0, "x", "x") for r in data],
                                  "vec_id long, embedding array<float>, label int, rid string, cell string")
    rows = lattice.near_duplicates(frame).collect()
    assert len(rows) == len(data)
    for r in rows:
        want = (4, 1) if r["vec_id"] in (1, 2, 11, None) else (0, r["vec_id"])
        assert (r["n_links"], r["component_id"]) == want, r
    assert lattice.near_duplicates(frame.where("false")).collect() == []
    nulls = lattice.near_duplicates(frame.where("vec_id is null")).collect()
    assert [(r["component_id"], r["kept"]) for r in nulls] == [(None, True)]


def test_lattice_is_sized_by_the_table():
    assert lattice.sized(0) == lattice.sized(400_000) == (0.8, 4)
    last = 4
    for n in (10 ** 6, 10 ** 7, 10 ** 8):
        scale, tables = lattice.sized(n)
        one = lattice.table_recall(scale)
        assert 1 - (1 - one) ** tables >= lattice.RECALL and tables > last
        assert n / (4 * math.pi * scale ** 2) ** 4 <= lattice.CELL * 1.001
        assert tables < last * 10 ** 0.65 + 3  # well below the growth of the table
        last = tables
    # The chance of a shared home cell, and recall on vectors.
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    home = lattice.cells(x, 3, 8, 1.0)[:, :, 0]
    shared = sum(int((c * (c - 1) // 2).sum()) for t in range(3) for c in [np.unique(home[:, t], return_counts=True)[1]])
    assert shared / (3 * 4000 * 3999 / 2) == pytest.approx((4 * math.pi) ** -4, rel=0.6)


def test_recall_with_a_larger_scale(spark):
    """2,000 vectors hashed as 800,000,000 would be, by a small cell."""
    rng = np.random.default_rng(9)
    x, z = rng.normal(size=(2, 1000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    both = np.concatenate([x, 0.9 * (1 + 1e-9) * x + math.sqrt(1 - 0.81) * z])
    assert lattice.sized(2000, cell=0.025)[1] > 4
    rows = lattice.near_duplicates(spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>"), cell=0.025).collect()
    want, got = plain(list(range(len(both))), both), found(rows)
    assert sum(got[i][0] for i in got) >= 0.9 * sum(want[i][0] for i in want) > 1000
    assert all(got[i][0] <= want[i][0] for i in want)
