"""Exact BPE encoding by backtracking, and decoding by an offset table.

A word's longest tokens come from one Aho-Corasick pass. They are tried from
the left: a token is taken where it may follow the one before it, otherwise
the next shorter one, and where none is left the last token is taken back and
its end is not tried again. Two tokens may stand side by side if the merges,
applied to both together, never join them across their border; the answers
are kept in a table that fills as pairs are met. A text has exactly one
sequence of tokens whose neighbours all fit, which is what the merges in their
order give, so the work is linear in the word and no merge is ever replayed.

The tokenizer's file also says how texts become words: special tokens'
strings first, as tokens of their own, then NFC, single spaces, lower case,
then words of letters, single digits or other characters. Decoding joins the
tokens' strings with one space, as this file's missing decoder says; the
strings lie in one buffer that is addressed by offsets.

Both run inside map tasks, without a shuffle; a task streams its rows and
holds the vocabulary and caches of fixed size.

Cases: a null or empty text, or one of white space alone, has no tokens and
decodes to the empty text; bytes that aren't UTF-8 count as U+FFFD; a very
long text or word takes memory in proportion to it and time linear in it;
repeated rows, null and repeated doc_ids are encoded row by row; an empty table gives no rows; other columns are kept or
ignored as the caller asks.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sizes of the tables a worker keeps; each is emptied when it is full.
KEPT_CHUNKS, KEPT_WORDS, KEPT_PAIRS = 1 << 18, 1 << 18, 1 << 18
# A longer stretch without white space is encoded but not remembered.
KEPT_BYTES = 64
# Rows that a worker takes and hands on at a time.
SLICE_ROWS = 256
# Ids that are decoded at a time.
DECODED_IDS = 1 << 16
# Letters below this are put in lower case one by one and never composed.
LATIN_END = "İ"
# Fixed values of the tokenizer's file: contractions, end of a word.
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
WORD_END = "</w>"


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level file:
    printable Latin-1 bytes for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _latin_words() -> re.Pattern:
    """The file's word pattern for lower-case text below ``LATIN_END``."""
    kinds = {"L": "", "N": ""}
    for c in map(chr, range(ord(LATIN_END))):
        if (kind := unicodedata.category(c)[0]) in kinds:
            kinds[kind] += re.escape(c)
    space = "\\t-\\r \u0085 "
    return re.compile("|".join(CONTRACTIONS) + f"|[{kinds['L']}]+|[{kinds['N']}]"
                      f"|[^{space}{kinds['L']}{kinds['N']}]+")


class Merges:
    """The merge rules over one alphabet: a character below 256 is a byte
    inside a word, one from 256 on is the byte that ends it."""

    def __init__(self, model: dict):
        if (model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or model["ignore_merges"]
                or model["dropout"] or model["byte_fallback"]):
            raise ValueError("not a plain BPE file with word ends")
        byte = {letter: b for b, letter in _byte_letters().items()}
        vocab = model["vocab"]

        def symbols(name: str) -> str:
            inner = name.removesuffix(WORD_END)
            codes = [byte[c] for c in inner]
            if len(inner) < len(name):
                codes[-1] += 256
            return "".join(map(chr, codes))

        self.text = {i: symbols(name) for name, i in vocab.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> rank, left, right
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        for rank, (left, right) in enumerate(pairs):
            a, b = vocab[left], vocab[right]
            whole = vocab[left + right]
            self.rank[a, b] = (rank, whole)
            self.made.setdefault(whole, (rank, a, b))
        self.fits: dict[tuple[int, int], bool] = {}
        # Tokens the merges can really make; the others never come out.
        self.real = {i for i in self.text if i not in self.made}
        for whole, (rank, a, b) in sorted(self.made.items(), key=lambda m: m[1]):
            if a in self.real and b in self.real and self._apart(a, b, rank):
                self.real.add(whole)
        of_text = {self.text[i]: i for i in self.real}
        import ahocorasick
        self.finder = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.shorter, self.size = [-1] * (max(vocab.values()) + 1), [0] * (max(vocab.values()) + 1)
        for s, i in of_text.items():
            self.finder.add_word(s, i)
            self.size[i] = len(s)
            # The longest real token that begins this one and isn't all of it.
            self.shorter[i] = next((of_text[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in of_text), -1)
        self.reach = max(self.size)
        self.finder.make_automaton()

    def _grown(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols that stand at one edge of a token (side 1 left, 2
        right) while it grows, first its byte, each with the rank of the
        merge that makes it."""
        steps = []
        while token in self.made:
            steps.append((self.made[token][0], token))
            token = self.made[token][side]
        steps.append((-1, token))
        return steps[::-1]

    def _apart(self, a: int, b: int, until: int) -> bool:
        """No merge of a rank below ``until`` joins ``a`` and ``b`` across
        their border while both grow from their bytes."""
        left, right = self._grown(a, 2), self._grown(b, 1)
        never = len(self.rank)
        i = j = 0
        while True:
            more_left = left[i + 1][0] if i + 1 < len(left) else never
            more_right = right[j + 1][0] if j + 1 < len(right) else never
            join = self.rank.get((left[i][1], right[j][1]), (never,))[0]
            # Of equal merges the one further left comes first.
            if join < until and join < more_left and join <= more_right:
                return False
            if more_left == never and more_right == never:
                return True
            if more_left <= more_right:
                i += 1
            else:
                j += 1

    def fit(self, pair: tuple[int, int]) -> bool:
        """The two tokens may be neighbours in an encoding; -1 is the start
        of the word. The answer goes into the table of pairs."""
        if len(self.fits) >= KEPT_PAIRS:
            self.fits.clear()
        known = self.fits[pair] = pair[0] < 0 or self._apart(*pair, len(self.rank))
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one word, given in the alphabet of this class."""
        found, size, fits, fit = self.finder.iter_long, self.size, self.fits, self.fit
        dead = None  # places no fitting sequence goes on from
        out: list[int] = []
        at, end, before = 0, len(word), -1
        reach = self.reach  # no token is longer, and the finder copies what it is given
        token = next(found(word[:reach]))[1]
        while at < end:
            while token >= 0:
                if dead is None or not dead[at + size[token]]:
                    pair = (before, token)
                    known = fits.get(pair)
                    if known or (known is None and fit(pair)):
                        break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                before = token
                token = next(found(word[at:at + reach]))[1] if at < end else -1
            else:
                dead = dead or bytearray(end + 1)
                dead[at] = 1
                token = out.pop()
                at -= size[token]
                before = out[-1] if out else -1
        return out


class _Kept(dict):
    """Stretch of text -> its ids, worked out when it is first asked for."""

    def __init__(self, make: Callable[[bytes], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.make(chunk)
        if len(chunk) <= KEPT_BYTES:
            if len(self) >= KEPT_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """Texts to ids by the file at ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.merges = Merges(spec["model"])
        # For text beyond Latin letters the file's own normalizer and splitter.
        library = Library.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        letters = _byte_letters()
        self.bytes_of = {ord(letter): chr(b) for b, letter in letters.items()}
        self.latin = _latin_words()
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        self.words: dict[str, bytes] = {}
        self.chunks = _Kept(self._chunk)

    def _word(self, word: str) -> bytes:
        """Ids of a word whose characters are its bytes, as little-endian
        unsigned 32-bit bytes."""
        ids = self.words.get(word)
        if ids is None:
            found = self.merges.encode(word[:-1] + chr(ord(word[-1]) + 256))
            ids = struct.pack(f"<{len(found)}I", *found)
            if len(word) <= KEPT_BYTES:
                if len(self.words) >= KEPT_WORDS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            low = text.lower()
            found = [low] if low.isalpha() else self.latin.findall(low)
        elif max(text) < LATIN_END:
            found = (w.encode().decode("latin-1") for w in self.latin.findall(text.lower()))
        else:
            clean = self.normalizer.normalize_str(text)
            found = (w.translate(self.bytes_of) for w, _ in self.splitter.pre_tokenize_str(clean))
        return b"".join(map(self._word, found))

    def _chunk(self, chunk: bytes) -> bytes:
        """Ids of a stretch without ASCII white space. No word and no
        composed letter spans white space, so a text's ids are those of its
        stretches."""
        if b"<|" not in chunk:
            return self._plain(chunk.decode("utf-8", "replace"))
        parts = self.special_at.split(chunk)
        return b"".join(struct.pack("<I", self.special[p]) if p in self.special
                        else self._plain(p.decode("utf-8", "replace")) for p in parts if p)

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.split()))


class Decoder:
    """Ids to texts by the file at ``path``: its tokens' strings, each with a
    space behind it, in one buffer, and the offsets at which they begin."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        strings = {i: name.encode() for name, i in spec["model"]["vocab"].items()}
        strings |= {i: name for name, i in special.items()}
        parts = [strings.get(i, b"") + b" " for i in range(max(strings) + 1)]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' strings, one space between them."""
        out = []
        for k in range(0, len(ids), DECODED_IDS):
            some = ids[k:k + DECODED_IDS]
            start, size = self.offsets[some], self.offsets[some + 1] - self.offsets[some]
            ends = np.cumsum(size)
            # Every byte's place in the buffer: its token's offset plus its place there.
            out.append(self.blob[np.arange(ends[-1]) + np.repeat(start - ends + size, size)].tobytes())
        return b"".join(out)[:-1]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The file's tables for encoding, made once a worker."""
    return Encoder(path)


@lru_cache(maxsize=1)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so a worker holds few texts at once."""
    for batch in batches:
        for k in range(0, len(batch), SLICE_ROWS):
            yield batch.slice(k, SLICE_ROWS)


def _ids(batch: pa.RecordBatch, path: str) -> pa.ListArray:
    encode = encoder(path).encode
    parts = [encode(t or b"") for t in batch["_text"].to_pylist()]
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int64) // 4
    ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)


def _texts(lists: pa.ListArray, path: str) -> pa.Array:
    decode = decoder(path).decode
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    return pa.array([decode(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.binary()).cast(pa.string())


def _source(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    return docs.select(*keep, F.col(text).cast("string").cast("binary").alias("_text"))


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
_TEXT = T.StructField("decoded", T.StringType())


def encoded(docs: DataFrame, path: str, keep: Iterable[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns of ``docs`` and ``ids``, the token ids of its
    ``text`` by the tokenizer file at ``path`` (on every machine)."""
    keep = list(keep)
    source = _source(docs, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), _ids(batch, path)], [*keep, "ids"])

    return source.mapInArrow(run, T.StructType([*(source.schema[c] for c in keep), _IDS]))


def decoded(rows: DataFrame, path: str, keep: Iterable[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``rows`` (default: all) and ``decoded``, the
    text of its ``ids``; null ids decode to the empty text."""
    keep = rows.columns if keep is None else list(keep)
    source = rows.select(*keep, F.coalesce("ids", F.array().cast("array<int>")).alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), _texts(batch["_ids"], path)],
                                             [*keep, "decoded"])

    return source.mapInArrow(run, T.StructType([*(source.schema[c] for c in keep), _TEXT]))


def recoded(docs: DataFrame, path: str, keep: Iterable[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``encoded`` and ``decoded`` in one pass: the ``keep`` columns, ``ids``
    and the text that they decode to."""
    keep = list(keep)
    source = _source(docs, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids = _ids(batch, path)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), ids, _texts(ids, path)],
                                             [*keep, "ids", "decoded"])

    return source.mapInArrow(run, T.StructType([*(source.schema[c] for c in keep), _IDS, _TEXT]))
