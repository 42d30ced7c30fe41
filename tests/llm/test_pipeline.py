import re
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from dispatchboard.llm import toxicity
from dispatchboard.llm.queries import tokenizer_path
from dispatchboard.llm.shared import saved
from tests.conftest import SF_ORACLE
from tests.llm.cases import empty_frame, from_table
from tests.llm.test_mixing import plain_targets, words
from tests.llm.test_packing import gapless
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_every_stage_against_brute_force(spark):
    docs = from_table(spark, SF_ORACLE)
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(saved(stage(spark, tables[-1], SF_ORACLE), "stage"))
    rows = [t.collect() for t in tables]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    assert all(t.columns == columns for t in tables[:-1])
    given, clean, single, apart, mixed, packed = rows

    # Toxicity: what the model trained on this input predicts.
    rejected = {r["doc_id"] for r in toxicity.scored(docs, from_table(spark, SF_ORACLE, "labels")).collect()
                if r["predicted"]}
    assert {r["doc_id"] for r in given} - {r["doc_id"] for r in clean} == rejected
    assert len(rejected) < 0.2 * len(given)

    # Exact dedup: the largest doc_id of each text.
    last = defaultdict(int)
    for r in clean:
        last[r["text"]] = max(last[r["text"]], r["doc_id"])
    assert sorted(r["doc_id"] for r in single) == sorted(last.values())

    # SimHash: the smallest doc_id of each component.
    prints = sorted((r["doc_id"], plain_fingerprint(r["text"])) for r in single)
    assert sorted(r["doc_id"] for r in apart) == sorted(set(plain_components(prints)))

    # Mixing: repeats up to twice, words near the targets.
    times = Counter(r["doc_id"] for r in mixed)
    by = {r["doc_id"]: r for r in apart}
    assert set(times) <= set(by) and max(times.values()) <= 2
    size, taken = defaultdict(int), defaultdict(int)
    for doc_id, r in by.items():
        size[r["source"]] += words(r["text"])
        taken[r["source"]] += times[doc_id] * words(r["text"])
    order = sorted(size)
    target = plain_targets(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(size.values()))
    assert all(0.95 * target[s] <= taken[s] <= target[s] + 1 for s in order)
    assert {tuple(r) for r in mixed} <= {tuple(r) for r in given}

    # Packing: all tokens of every taken copy, without gaps.
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    length = Counter()
    for r in packed:
        length[r["doc_id"]] += r["length"]
    some = sorted(times)[:100]
    assert set(length) == set(times)
    for d in some:
        ids = tokenizer.encode(by[d]["text"] or "", add_special_tokens=False).ids
        assert length[d] == times[d] * (len(ids) + 1)
    assert gapless(packed) <= -(-sum(length.values()) // 4096) * 1.02 + 2


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_ORACLE)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 500


def test_an_empty_table_passes_through(spark):
    docs = empty_frame(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF_ORACLE), "stage")
        assert docs.count() == 0


def test_packing_stage_holds_every_piece_of_every_copy(spark):
    from tokenizers import Tokenizer
    docs = from_table(spark, SF_ORACLE)
    docs = saved(docs.union(docs.where("doc_id % 3 = 0")), "mixed")
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    want = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start:start + 4096], "<u4")
            want[r["doc_id"], piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    rows = dict(corpus_pipeline.STAGES)["best-fit packing"](spark, docs, SF_ORACLE).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    gapless(rows)


def plain_odds(model, text):
    """Weights of whole words and of their first 4 to 8 letters, per 50 words."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)
    total = 0.0
    for w in own:
        w = w.lower()
        total += model.weights.get(w, 0.0)
        total += sum(model.weights.get(w[:n] + "-", 0.0) for n in range(4, 9) if len(w) >= n)
    return model.bias + 50 * total / (len(own) + 40)


def test_toxicity_stage_by_plain_scores_of_a_fixed_model(spark, monkeypatch):
    docs = from_table(spark, SF_ORACLE)
    given = docs.collect()
    seen = Counter(w for r in given for w in set(re.findall("[a-z]+", (r["text"] or "").lower())))
    some = sorted(w for w, n in seen.items() if 50 < n < 500 and len(w) > 4)[:40]
    weights = {w: (-1.0) ** i * (1 + i % 5) for i, w in enumerate(some)}
    model = toxicity.Model(weights | {w[:4] + "-": 0.7 for w in some[::3]}, -0.3)
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: model)
    kept = dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, SF_ORACLE).collect()
    want = {r["doc_id"] for r in given if plain_odds(model, r["text"]) < 0}
    assert {r["doc_id"] for r in kept} == want and 0 < len(want) < len(given)
