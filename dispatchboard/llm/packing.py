"""Best-fit packing of tokenised documents by the sum-of-squares rule.

Documents are tokenised, cut where they exceed a sequence, and every piece is
placed where the sum of the squared counts of open sequences per residual gap
becomes smallest, which keeps all gaps in supply so that later pieces find
one that they fill.

Pieces are dealt evenly to groups of ``GROUP_PIECES`` by the place of their
row, whatever their ids, so no document, source or group of copies makes one
large; the number of groups follows the data and a group's waste is a
few sequences at its end.

Cases: a null or empty text is a document of the end token alone; a repeated
row is packed as often as it stands there; doc_ids may be null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string
import struct
import zlib
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchboard.llm.shared import located, saved

SEQUENCE_TOKENS = 4096
END_TOKEN = 1
GROUP_PIECES = 1 << 15
# Letters below this need no special case when they are put in lower case.
LATIN_END = "\u0130"
PUNCTUATION = string.punctuation.encode()
# Words whose ids a worker remembers (about 200 bytes each).
CACHED_WORDS = 1 << 20


class _Words(dict):
    """word (as it stands in the text) -> its ids as little-endian unsigned
    32-bit bytes; a word is encoded when it is first asked for. Only ASCII is
    put in lower case here: elsewhere the tokenizer composes letters first."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # words are remembered here
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, ord(LATIN_END))}

    def _ids(self, word: bytes) -> bytes:
        # Letters in their final form are one piece of the model's own input.
        if word.isalpha():
            ids = [t.id for t in self.model.tokenize(word.decode())]
        else:
            text = word.decode("utf-8", "replace")
            if text.isalpha() and max(text) < LATIN_END and is_normalized("NFC", text):
                ids = [t.id for t in self.model.tokenize(text.lower().translate(self.letters))]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        small = word.lower() if word.isascii() else word
        # ASCII punctuation after a letter or digit makes tokens by itself;
        # control characters and some letters' composed forms join it.
        stem = small.rstrip(PUNCTUATION)
        if small != word:
            found = self[small]
        elif stem and len(stem) < len(word) and _ends_plainly(stem):
            found = self[stem] + self[word[len(stem):]]
        else:
            found = self._ids(word)
        self[word] = found
        return found


def _ends_plainly(stem: bytes) -> bool:
    """It ends with a letter or digit that the tokenizer leaves one."""
    if stem[-1] < 128:
        return stem[-1:].isalnum()
    last = stem.decode("utf-8", "replace")[-1]
    return last.isalpha() and last < LATIN_END


def _encoder(path: str) -> Callable[[bytes], bytes]:
    """UTF-8 text -> its ids as little-endian unsigned 32-bit bytes.

    This tokenizer's words never span white space and don't depend on what
    stands before them, so a text's ids are those of its words one after the
    other."""
    ids = _Words(path).__getitem__
    return lambda text: b"".join(map(ids, text.split()))


def tokenized_pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE_TOKENS,
                     end: int = END_TOKEN, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, place`` and, on request,
    ``ids`` (the piece's ids as little-endian unsigned 32-bit bytes).
    ``tokenizer`` is the path of a white-space-bounded tokenizer's file."""
    rows, at = located(docs)
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType),
              T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("place", T.LongType())]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    if with_ids:
        kinds.append(pa.binary())
        fields.append(T.StructField("ids", T.BinaryType()))
    last = np.array([end], "<u4").tobytes()
    step = 4 * sequence

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in batches:
            owner, columns = [], [[] for _ in fields[1:]]
            for i, (text, place) in enumerate(zip(batch["text"].to_pylist(), batch["place"].to_pylist())):
                ids = encode((text or "").encode("utf-8", "replace")) + last
                for piece, k in enumerate(range(0, len(ids), step)):
                    part = ids[k:k + step]
                    owner.append(i)
                    for column, value in zip(columns, (piece, k // 4, len(part) // 4, zlib.crc32(part),
                                                       place, part)):
                        column.append(value)
            made = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(owner, pa.int64())), *made],
                                             [f.name for f in fields])

    return (rows.select("doc_id", F.col("text").cast("string").alias("text"),
                        F.xxhash64(at).alias("place"))
            .mapInArrow(cut, T.StructType(fields)))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every length (each from 1 to capacity), in
    the given order. A new bin is one of the choices while fewer are open
    than all lengths need at least, and afterwards only where no open bin has
    room. Where choices tie, the smallest gap wins, then an open bin before a
    new one."""
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap; gap 0 is not open
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made, least = 0, -(-int(np.sum(lengths)) // capacity)
    for i, size in enumerate(map(int, lengths)):
        rest = capacity - size
        best, cost = -1, 2 * int(count[rest]) + 1 if rest else 0
        if rest and count[size:capacity].any():
            gaps = count[size:capacity]
            change = 2 * (count[:capacity - size] - gaps) + 2
            change[0] = 1 - 2 * gaps[0]  # the bin is filled and closes
            change[gaps == 0] = np.iinfo(np.int64).max
            k = int(change.argmin())
            if change[k] <= cost or made >= least:
                best = size + k
        if best < 0:
            where[i], offset[i] = made, 0
            made += 1
            if rest:
                bins[rest].append(int(where[i]))
                count[rest] += 1
            continue
        number = bins[best].pop()
        count[best] -= 1
        where[i], offset[i] = number, capacity - best
        if best > size:
            bins[best - size].append(number)
            count[best - size] += 1
    return where, offset


def pack(pieces: DataFrame, sequence: int = SEQUENCE_TOKENS, group: int = GROUP_PIECES
         ) -> DataFrame:
    """``pieces`` (a saved table with ``length`` and ``place``) without
    ``place`` and with ``sequence_id`` and ``offset``, gapless from 0 in
    each sequence. Longest pieces are placed first."""
    groups = max(1, -(-pieces.count() // group))
    kept = [f for f in pieces.schema.fields if f.name != "place"]
    out = T.StructType([*kept, T.StructField("sequence_id", T.LongType()),
                        T.StructField("offset", T.LongType())])

    def placed(key: tuple, some: pa.Table) -> pa.Table:
        some = some.take(pc.sort_indices(some, [("length", "descending"), ("place", "ascending"),
                                                ("piece", "ascending")]))
        where, offset = sum_of_squares(some["length"].to_numpy(), sequence)
        return (some.append_column("sequence_id", pa.array(where + (key[0].as_py() << 32)))
                .append_column("offset", pa.array(offset)).select(out.names))

    dealt = F.pmod(F.xxhash64("place", "piece"), F.lit(groups))
    return pieces.groupBy(dealt.alias("group")).applyInArrow(placed, out)


def pack_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE_TOKENS,
                   end: int = END_TOKEN, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``: a row per piece."""
    pieces = saved(tokenized_pieces(docs, tokenizer, sequence, end, with_ids), "pieces")
    return pack(pieces, sequence)
