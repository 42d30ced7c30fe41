import zlib

import numpy as np
import pytest

from dispatchboard.llm import packing, queries
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.cases import DOCS, docs_frame, empty_frame, from_table


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    return t


def check(rows, texts, tokenizer, sequence=4096):
    """rows: (doc_id, piece, ...) of unique doc_ids; every piece round-trips."""
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == set(texts)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(by[doc_id], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), sequence))
        for r in own:
            part = np.array(ids[r["start"]:r["start"] + sequence], "<u4")
            assert (r["length"], r["ids_crc32"]) == (len(part), zlib.crc32(part.tobytes()))
    gapless(rows, sequence)


def gapless(rows, sequence=4096):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= sequence
    return len(bins)


def test_query_round_trips_and_packs_tightly(spark, tokenizer):
    rows = queries.op4_packing(spark, SF_ORACLE).collect()
    check(rows, {r["doc_id"]: r["text"] for r in from_table(spark, SF_ORACLE).collect()}, tokenizer)
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert gapless(rows) <= least * 1.005 + 1


def test_words_with_odd_characters(tokenizer):
    encode = packing._encoder(queries.tokenizer_path())
    for text in ["", "It's. I'LL?., İstanbul É É K <|endoftext|> ΑΣ ΟΔΥΣΣΕΥΣ 3.14, 5.,x a.b, , b\x1cc\x85d é.",
                 "a" * 5000, "ß.ẞ, ﬁ ａ，ｂ 中文。", "x.\ny,\tz", "İ İx"]:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == \
            tokenizer.encode(text, add_special_tokens=False).ids, text


def test_control_characters_and_uncomposed_capitals(tokenizer):
    encode = packing._encoder(queries.tokenizer_path())
    for text in ["ab\x01.", "ab\x00,", "ab\x1f!", "ab\x7f?", "J\u030c", "H\u0331", "T\u0308x", "J\u030c. j\u030c",
                 "W\u030a, Y\u030a", "\u0130.", "\u0958.", "\ufb2a,", "\u00c9T\u00c9. \u212b.", "AB\x01. \u00aa."]:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == \
            tokenizer.encode(text, add_special_tokens=False).ids, text


def test_random_odd_words(tokenizer):
    rng = np.random.default_rng(5)
    some = [*"abcJHTWYK019'.,!<|=-\"", *map(chr, range(1, 9)), "\x0b", "\x1c", "\x1f", "\x7f", "\x85", "\xa0", "\u2028",
            "\u0130", "\u0131", "\u00e9", "\u00c9", "\u0301", "\u030c", "\u0331", "\u0338", "\u0308", "\u1100", "\u1161",
            "\u0958", "\u4e2d", "\u03a3", "\u03c3", "\u212b", "\u00b2", "\ufb01", "\u200d", "\U0001f600", " "]
    encode = packing._encoder(queries.tokenizer_path())
    for _ in range(3000):
        text = "".join(rng.choice(some, rng.integers(1, 12)))
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == \
            tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_cache_limit_changes_nothing(monkeypatch, tokenizer):
    text = "alpha beta, gamma. delta " * 20 + "alpha."
    encode = packing._encoder(queries.tokenizer_path())
    whole = encode(text.encode())
    monkeypatch.setattr(packing, "CACHED_WORDS", 2)
    assert packing._encoder(queries.tokenizer_path())(text.encode()) == whole


def test_rule_takes_the_smallest_sum_of_squares():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 21, 400)
    where, offset = packing.sum_of_squares(lengths, 20)
    fill: dict = {}
    for i, (w, o) in enumerate(zip(where.tolist(), offset.tolist())):
        def cost(target):
            after = dict(fill)
            after[target] = after.get(target, 0) + int(lengths[i])
            gaps = [20 - f for f in after.values() if f < 20]
            return sum(gaps.count(g) ** 2 for g in set(gaps))
        options = [b for b, f in fill.items() if f + lengths[i] <= 20]
        if not options or len(fill) < -(-lengths.sum() // 20):
            options.append(len(fill))
        assert cost(w) == min(map(cost, options))
        assert o == fill.get(w, 0)
        fill[w] = fill.get(w, 0) + int(lengths[i])


def test_groups_hold_every_piece_once(spark):
    pieces = packing.saved(packing.tokenized_pieces(from_table(spark, SF_SMALL),
                                                    queries.tokenizer_path()), "pieces")
    rows = packing.pack(pieces, group=50).collect()
    assert len(rows) == pieces.count()
    gapless(rows)


def test_cases(spark):
    rows = packing.pack_documents(docs_frame(spark), queries.tokenizer_path(), with_ids=True).collect()
    gapless(rows)
    assert sum(r["piece"] == 0 for r in rows) == len(DOCS)
    assert {r["length"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)
    assert packing.pack_documents(empty_frame(spark), queries.tokenizer_path()).collect() == []
