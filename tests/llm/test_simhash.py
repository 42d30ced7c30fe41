import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dispatchboard.llm import queries, simhash
from dispatchboard.llm.components import components
from tests.conftest import SF_ORACLE
from tests.llm.cases import DOCS, docs_frame, empty_frame, from_table


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)})
             .translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=3):
    """prints: list of (doc_id, fingerprint) -> doc_id of each row's component."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= bits:
                label[max(find(i), find(j))] = min(find(i), find(j))
    out: dict = {}
    for i, (doc_id, _) in enumerate(prints):
        out.setdefault(find(i), []).append(doc_id)
    return [min((d for d in out[find(i)] if d is not None), default=None) for i in range(len(prints))]


def test_query_on_the_whole_table(spark):
    docs = from_table(spark, SF_ORACLE).orderBy("doc_id").collect()
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs]
    want = {d: (f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in queries.op5_simhash(spark, SF_ORACLE).collect()}
    assert got == want
    assert any(d != c for d, (_, c) in got.items())


@pytest.mark.parametrize("block", [1024, 8])
def test_links_join_what_all_pairs_join(spark, block):
    rng = np.random.default_rng(5)
    base = rng.integers(-2**63, 2**63 - 1, 40)
    own = {int(b) for b in base}
    for b in base:
        at = int(b)
        for _ in range(12):  # chains of small steps, so components are long
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                at ^= -(1 << 63) if bit == 63 else 1 << int(bit)
            own.add(at)
    own = sorted(own)
    prints = [(i, p % (1 << 64)) for i, p in enumerate(own)]
    want = plain_components(prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in own], "fp long"), block=block)
    number = {p: i for i, p in enumerate(own)}
    label = {i: i for i in range(len(own))}
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    groups: dict = {}
    for p in own:
        groups.setdefault(root.get(p, p), []).append(number[p])
    for g in groups.values():
        for i in g:
            label[i] = min(g)
    assert [label[i] for i in range(len(own))] == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 3000).select((F.col("id") - 1).alias("a"), F.col("id").alias("b"))
    got = components(edges.where("id != 1500")).groupBy("root").count().collect()
    assert {r["root"]: r["count"] for r in got} == {0: 1500, 1500: 1500}
    assert components(edges.where("id < 0")).count() == 0


def test_cases(spark):
    rows = simhash.near_duplicates(docs_frame(spark)).collect()
    assert len(rows) == len(DOCS)
    by = {}
    for r in rows:
        by.setdefault((r["fingerprint"], r["component_id"]), []).append(r)
    assert {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {3}
    same = by[f"{plain_fingerprint(DOCS[0][1]):016x}", 1]
    assert len(same) == 4 and sum(r["kept"] for r in same) == 1
    assert simhash.near_duplicates(empty_frame(spark)).collect() == []
    kept = simhash.drop_near_duplicates(docs_frame(spark))
    assert kept.columns == docs_frame(spark).columns
    assert kept.count() == sum(r["kept"] for r in rows)
