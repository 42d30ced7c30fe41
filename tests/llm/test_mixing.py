import collections
import itertools
import random
import re
from collections import defaultdict

import pytest

from dispatchboard.llm import mixing, queries
from tests.conftest import SF_ORACLE
from tests.llm.cases import DOCS, docs_frame, empty_frame, from_table


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights, total, most=2):
    """The rule as it is said: stop at the cap, share the excess again."""
    target = {s: 0.0 for s in sizes}
    left = total
    while left > 1e-6:
        free = [s for s in sizes if target[s] < most * sizes[s]]
        if not free:
            break
        unit, left_now = left / sum(weights[s] for s in free), 0.0
        for s in free:
            target[s] += weights[s] * unit
            if target[s] > most * sizes[s]:
                left_now += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
        left = left_now
    return target


def test_query_on_the_whole_table(spark):
    docs = {r["doc_id"]: r for r in from_table(spark, SF_ORACLE).collect()}
    rows = queries.op1_mixing(spark, SF_ORACLE).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    size, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == words(docs[r["doc_id"]]["text"])
        assert 0 <= r["taken"] <= 2 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        size[source] += r["size"]
        taken[source] += r["taken"]
    order = sorted(size)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = plain_targets(size, weights, 1.5 * sum(size.values()))
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert r["source_size"] == size[source]
        assert r["target"] == pytest.approx(target[source])
    for s in order:
        assert taken[s] <= target[s] + 1 and taken[s] >= 0.97 * target[s], (s, taken[s], target[s])
    again = {r["doc_id"]: r["taken"] for r in queries.op1_mixing(spark, SF_ORACLE).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_route_reroutes_an_overlapping_pattern():
    # (a, b) must give way so that pattern (a,) alone can't starve b.
    flow = mixing.route({("a", "b"): 10, ("a",): 10}, {"a": 12, "b": 8}, most=1)
    assert sum(n for (_, s), n in flow.items() if s == "a") == 12
    assert sum(n for (_, s), n in flow.items() if s == "b") == 8
    assert flow["a", "b"] if ("a", "b") in flow else True


def test_route_opens_second_passes_only_when_needed():
    flow = mixing.route({("a",): 10, ("a", "b"): 10}, {"a": 15, "b": 0}, most=2)
    given = defaultdict(int)
    for (p, _), n in flow.items():
        given[p] += n
    assert sum(given.values()) == 15 and max(given.values()) <= 10
    flow = mixing.route({("a",): 10}, {"a": 50}, most=2)
    assert sum(flow.values()) == 20


def test_overlapping_sources_meet_their_quotas(spark):
    from pyspark.sql import functions as F
    rows = [(i, "w " * 10, "en", "a" if i % 3 else "b", 1) for i in range(300)]
    both = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(
        F.array(F.col("source")))
    got = mixing.mix(docs_frame(spark, rows), sources=both, share=1.0).collect()
    assert sum(r["taken"] for r in got) == pytest.approx(sum(r["targets"][0] for r in {
        (tuple(r["sources"]), r["targets"][0]): r for r in got if len(r["sources"]) == 1}.values()), rel=0.05)


def test_cases(spark):
    rows = mixing.mix(docs_frame(spark)).collect()
    assert len(rows) == len(DOCS)
    assert {tuple(r["sources"]) for r in rows} == {("a",), ("b",), ("c",), (None,)}
    assert mixing.mix(empty_frame(spark)).collect() == []
    out = mixing.mixed_documents(docs_frame(spark))
    assert out.columns == docs_frame(spark).columns
    assert out.count() == sum(r["copies"] for r in rows)


def test_one_very_long_document_costs_no_room(spark):
    # Patterns whose last pass can hold all short documents but not the long one.
    for seed in range(4):
        rows = [(i, "w " * 10, "en", "a", 1) for i in range(399)] + [(399, "w " * 10_000, "en", "a", 1)]
        got = mixing.mix(docs_frame(spark, rows), share=7000 / 13_990, seed=seed).collect()
        assert sum(r["taken"] for r in got) == 3990, seed


def test_no_document_that_fits_is_left_out(spark):
    sizes = [1 + (i * i * 7919) % 97 + (5000 if i % 40 == 0 else 0) for i in range(900)]
    rows = [(i, "w " * n, "en", "ab"[i % 2], 1) for i, n in enumerate(sizes)]
    for seed in range(3):
        got = mixing.mix(docs_frame(spark, rows), share=0.5, seed=seed).collect()
        for source in "ab":
            own = [r for r in got if r["sources"] == [source]]
            room = round(own[0]["targets"][0]) - sum(r["taken"] for r in own)
            base = min(r["copies"] for r in own)
            assert 0 <= room < min(r["size"] for r in own if r["copies"] == base), (seed, source)


def _cut(capacity, targets, passes):
    """The most that can flow: the least cut over every set of sources."""
    names = list(targets)
    best = None
    for chosen in itertools.product((False, True), repeat=len(names)):
        filled = {s for s, c in zip(names, chosen) if c}
        worth = sum(targets[s] for s in filled) + sum(
            passes * n for p, n in capacity.items() if set(p) - filled)
        best = worth if best is None else min(best, worth)
    return best


@pytest.mark.parametrize("seed", range(40))
def test_flow_of_overlapping_sources_against_every_cut(seed):
    """As much as any flow can bring, and as little of it by repeats."""
    rng = random.Random(seed)
    names = list("abcde")[:rng.randint(1, 5)]
    capacity = {}
    for _ in range(rng.randint(1, 9)):
        capacity[tuple(sorted(rng.sample(names, rng.randint(1, len(names)))))] = rng.choice([0, 1, 7, rng.randint(1, 900)])
    targets = {s: rng.choice([0, rng.randint(0, 1500)]) for s in names}
    routed = mixing.route(capacity, targets, 2)
    given, got = collections.Counter(), collections.Counter()
    for (p, s), n in routed.items():
        assert n >= 0 and s in p
        given[p] += n
        got[s] += n
    assert all(given[p] <= 2 * n for p, n in capacity.items())
    assert all(got[s] <= n for s, n in targets.items())
    assert sum(given.values()) == _cut(capacity, targets, 2)
    assert sum(min(given[p], n) for p, n in capacity.items()) == _cut(capacity, targets, 1)
