import zlib
from collections import defaultdict

import pytest

from dispatchboard.llm import queries, sharding
from tests.conftest import SF_ORACLE
from tests.llm.cases import DOCS, docs_frame, empty_frame, from_table


def slots_are_gapless(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert set(by) <= set(range(40))


def test_query_on_the_whole_table(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in from_table(spark, SF_ORACLE).collect()}
    rows = queries.op9_sharding(spark, SF_ORACLE).collect()
    slots_are_gapless(rows)
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    load, homes = defaultdict(int), defaultdict(set)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        load[r["shard"]] += r["size"]
        homes[raw].add(r["shard"])
    mean = sum(load.values()) / 40
    assert max(load.values()) <= 1.05 * mean and min(load[s] for s in range(40)) >= 0.95 * mean
    weight = {t: sum((len(x.encode()) + 16) for x in docs.values() if x.encode() == t) for t in homes}
    assert all(len(h) == 1 for t, h in homes.items() if weight[t] < 0.8 * mean)
    again = queries.op9_sharding(spark, SF_ORACLE).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


@pytest.mark.parametrize("same_id", [False, True])
def test_a_third_of_all_rows_in_one_text_is_subdivided(spark, same_id):
    hot = [(9 if same_id else i, "hot text " * 40, "en", "a", 1) for i in range(3000)]
    rows = sharding.shard_by_bytes(docs_frame(spark, hot + [
        (5000 + i, f"text {i} " * 40, "en", "b", 1) for i in range(6000)])).collect()
    slots_are_gapless(rows)
    load = defaultdict(int)
    for r in rows:
        load[r["shard"]] += r["size"]
    mean = sum(load.values()) / 40
    assert len(rows) == 9000
    assert max(load.values()) <= 1.08 * mean and min(load[s] for s in range(40)) >= 0.92 * mean


def test_cases(spark):
    rows = sharding.shard_by_bytes(docs_frame(spark)).collect()
    slots_are_gapless(rows)
    assert len(rows) == len(DOCS)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (3, 4)} == {(16, 0)}
    assert sharding.shard_by_bytes(empty_frame(spark)).collect() == []


def test_main_path_runs_no_python(spark):
    plan = sharding.shard_by_bytes(from_table(spark, SF_ORACLE))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
