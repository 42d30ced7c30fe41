"""The Merkle manifest against a tree built level by level in plain Python."""

import hashlib
import zlib

import pytest

from dispatchboard.llm import merkle, queries
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, docs_frame, empty_frame, from_table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return sha("".join(map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, i):
    for level in tree[:-1]:
        first = i - i % 3
        run = level[first:first + 3]
        yield i - first, run[:i - first] + run[i - first + 1:]
        i //= 3


def plain(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {s: levels([leaf(r, r["text"]) for r in sources[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(sources[s]):
            proof, text = [*way(trees[s], i), *way(top, k)], r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for place, others in proof:
                node = sha("".join([*others[:place], node, *others[place:]]))
            out.append((r["doc_id"], leaf(r, r["text"]), trees[s][-1][0], top[-1][0],
                        sha("".join(d for _, others in proof for d in others)), node, node == top[-1][0]))
    return out


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def query(spark, docs, monkeypatch):
    monkeypatch.setattr(queries, "_table", lambda *_: docs)
    return rows(queries.op12_merkle(spark, ""))


@pytest.mark.parametrize("levels_a_segment", [8, 2])
def test_whole_table(spark, monkeypatch, levels_a_segment):
    monkeypatch.setattr(merkle, "SEGMENT_LEVELS", levels_a_segment)
    monkeypatch.setattr(merkle, "SEGMENT_NODES", 3 ** levels_a_segment)
    docs = from_table(spark, SF_SMALL)
    assert query(spark, docs, monkeypatch) == sorted(plain(docs.collect()), key=str)


def test_cases(spark, monkeypatch):
    docs = docs_frame(spark)
    got = query(spark, docs, monkeypatch)
    assert len(got) == len(DOCS) and got == sorted(plain(docs.collect()), key=str)
    assert query(spark, empty_frame(spark), monkeypatch) == []


def test_one_row_is_its_own_root(spark):
    made = merkle.manifest(spark.createDataFrame([(1, "a", "d" * 64)], "doc_id long, source string, leaf string"))
    assert made.root == "d" * 64 and made.records().count() == 0
    (proof,) = made.proofs().collect()
    assert proof["proof"] == [] and proof["subroot"] == made.root


def test_records_are_addressed_by_their_content(spark):
    docs = from_table(spark, SF_SMALL)
    made = merkle.manifest(docs.select("doc_id", "source", merkle.leaf(*map(F.col, merkle.FIELDS)).alias("leaf")))
    stored = {r["digest"]: r["children"] for r in made.records().collect()}
    assert all(digest == merkle.joined(children) and 1 <= len(children) <= 3 for digest, children in stored.items())
    seen, todo = set(), [made.root]
    while todo:
        node = todo.pop()
        if node in stored:
            todo += stored[node]
        else:
            seen.add(node)
    assert seen == {r["leaf"] for r in made.proofs().collect()}


def test_any_change_is_found(spark):
    docs = from_table(spark, SF_SMALL)
    out = merkle.checked(docs, F.col("doc_id") % 3 == 0, F.concat(F.lit("x"), "text"))
    assert {(r["doc_id"] % 3 != 0) == r["verified"] for r in out.collect()} == {True}
