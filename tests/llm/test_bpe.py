"""The BPE operator against the tokenizers library: ids and decoded texts."""

import hashlib
import random
import time

import numpy as np
import pytest

from dispatchboard.llm import bpe, queries
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, docs_frame, empty_frame, from_table

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


def plain(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_whole_table_as_the_library_does(spark, library):
    rows = {r["doc_id"]: r["text"] for r in from_table(spark, SF_SMALL).collect()}
    got = queries.op11_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        ids, text = plain(library, rows[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_cases(spark, library):
    docs = docs_frame(spark)
    out = bpe.decoded(bpe.encoded(docs, PATH, keep=["doc_id", "text", "at"]), PATH).collect()
    assert len(out) == len(DOCS)
    for r in out:
        assert (r["ids"], r["decoded"]) == plain(library, r["text"])
    assert sorted(map(str, out)) == sorted(map(str, bpe.recoded(docs, PATH, keep=["doc_id", "text", "at"]).collect()))
    assert bpe.decoded(bpe.encoded(empty_frame(spark), PATH), PATH).count() == 0


def test_bytes_that_are_no_text(spark, library):
    docs = spark.sql("select 1L doc_id, cast(X'6162FF20E9' as string) text")
    (row,) = bpe.encoded(docs, PATH).collect()
    assert row["ids"] == plain(library, b"ab\xff \xe9".decode("utf-8", "replace"))[0]


def test_odd_texts(library):
    ours, back, rng = bpe.encoder(PATH), bpe.decoder(PATH), random.Random(5)
    parts = ["a", "b", "e", "t", "in", "ing", "tion", "é", "ß", "İ", "Σ", "ς", "中", "한", "́", "̸", ">", "ﬁ", "1",
             "²", "٣", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "　", ".", ",", "'s", "'", "'LL", "'Re", "_", "-",
             "<|endoftext|>", "<|startoftext|>", "<|", "|>", "\x00", "\x7f", "🙂", "aaaa", "Ǆ", "J̌", "ª"]
    for n in range(6000):
        text = "".join(rng.choice(parts if n % 3 else "abc") for _ in range(rng.randint(0, 16)))
        ids = np.frombuffer(ours.encode(text.encode()), "<u4").astype("int32")
        assert (list(ids), back.decode(ids).decode()) == plain(library, text), repr(text)


def test_words_without_end_take_linear_time(library):
    ours, back = bpe.encoder(PATH), bpe.decoder(PATH)
    for word in (b"a" * 1_000_000, bytes(random.Random(1).choices(b"abcdefgh", k=200_000))):
        began = time.monotonic()
        ids = np.frombuffer(ours.encode(word), "<u4")
        assert time.monotonic() - began < 20
        assert back.decode(ids).replace(b" ", b"") == word + b"</w>"
    word = "ab" * 5000
    assert list(np.frombuffer(ours.encode(word.encode()), "<u4")) == plain(library, word)[0]


def test_full_tables_start_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 2)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 2)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 2)
    ours, text = bpe.Encoder(PATH), "retitioning ouen the of, nterti thorreou ndernt. " * 2
    assert list(np.frombuffer(ours.encode(text.encode()), "<u4")) == plain(library, text)[0]
