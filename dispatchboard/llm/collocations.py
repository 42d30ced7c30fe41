"""Phrase collocations counted by a trie of hash containers.

A map task counts, for every word, the window of up to ``LONGEST`` words that
starts there. Windows live under a shallow trie of word ids: the language's
node leads to a hash container for every 64 neighbouring ids of first words; a
container that grows past ``BURST`` entries bursts into one container per first
word, and one of those into one per next word. Windows of many texts are
grouped by their containers before they are counted there. When the trie holds
``HELD`` windows, whole subtrees, the largest first, are spilled as sorted runs
until half of it is free.

The runs are merged per prefix partition: ranges of the sorted windows, cut at
windows of a bounded sample of documents (``splitters``), so a word or word
pair with any share of all rows is spread over as many partitions as its
windows need. Only the cuts depend on the sample, no count does. In sorted order all windows that
begin with a phrase are neighbours, so one pass counts phrases of every length
at once. A phrase whose windows lie inside one batch is whole and counts if it
is frequent; the phrases at a batch's two ends are handed on and summed. No
table of phrases is broadcast, and a task holds one batch.

Scores, containment and ranks are joins and aggregates over the frequent
phrases only. Single words, which many phrases share, are salted for the join.

Cases: a null or empty text has no words; a null language is ``und``; the
words of very long texts are counted like any others, piece by piece; repeated rows
count as often as they stand there; equal scores are ordered by count, then by
the phrase's bytes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispatchboard.llm.shared import saved, text_or_empty

LONGEST = 4
LEAST = 30
TOP = 2000
SCALE = 2_000_000
# A phrase goes if a longer one holds this percentage of its occurrences.
CONTAINED = 80
# Entries of a container that bursts, and of a whole trie that spills.
BURST = 4096
HELD = 1 << 19
# Words of a language that are counted at a time, and words that may wait for
# that in all languages.
PART = 1 << 16
WAITING = 1 << 18
# Runs are handed on in batches of this many windows.
BATCH_ROWS = 1 << 14
# Copies of a single word's row, over which the phrases that share it spread.
SALTS = 16
# A sample of this many documents, and windows of each, for a partition.
SAMPLED = 16
# Languages of the sample that a key names by one byte, from this one on; the
# others are spelled out.
SHORT_TOKENS, FIRST_TOKEN = 200, 0x22
# Bits of a word's id in a window's key, and those of its first word's id that
# are in the key too; the others name the top of its subtree.
ID_BITS = 19
REST_BITS = (LONGEST - 1) * ID_BITS
LOW_BITS = 63 - REST_BITS
# Ids of a trie that is emptied: those of the next part still fit.
CROWDED = (1 << ID_BITS) - (1 << 17)
# Letters in lower case, and what ends a piece of text as a line end.
_PLAIN = bytes.maketrans(b"".join(bytes([c]) for c in range(65, 91)) + b".,;:!?\n\x0b\x0c\r",
                         b"".join(bytes([c]) for c in range(97, 123)) + b"\n" * 10)
# The same with a full stop, which no word holds, as a word of its own.
STOP = b"."
_STOPPED = _PLAIN.replace(b"\n", STOP)
# Ends every word in a window: words hold neither space nor tab.
END = b" "


class _Node(dict):
    """A burst container: containers or further nodes by what the windows'
    keys begin with, one word more than above."""


class _Ids(dict):
    """Word -> its id, from 1 on; 0 ends a piece of text."""

    def __init__(self):
        super().__init__({STOP: 0})
        self.words = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self.words)
        self.words.append(word + END)
        return i


def _boxes(box: dict) -> Iterator[Counter]:
    if type(box) is _Node:
        for below in box.values():
            yield from _boxes(below)
    else:
        yield box


def _groups(values: np.ndarray) -> list[int]:
    """Where runs of equal neighbours begin, and the end."""
    return [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]


class Trie:
    """Counts of windows of word ids, by language. A window's key packs the
    low bits of its first word's id and the ids of the next words into one
    number; the high bits of the first name the subtree."""

    def __init__(self, burst: int = BURST, held: int = HELD):
        self.burst, self.held = burst, held
        self._clear()

    def _clear(self) -> None:
        self.ids, self.made = _Ids(), 0
        self.langs: dict[str, dict[int, dict]] = {}
        # Ids that wait to be counted, a 0 behind every piece.
        self.waiting: dict[str, list[int]] = {}
        self.n_waiting = 0

    @property
    def size(self) -> int:
        """Windows held."""
        for lang, ids in self.waiting.items():
            self._count(lang, ids, len(ids))
        self.waiting, self.n_waiting = {}, 0
        return self.made

    def full(self) -> bool:
        """Whether it is to be spilled; counts the words of all languages if
        too many wait."""
        return (self.size if self.n_waiting >= min(self.held, WAITING) else self.made) >= self.held

    def add(self, lang: str, ids: list[int], starts: int) -> None:
        """Count the windows that begin at the first ``starts`` ids."""
        if starts < len(ids):
            self._count(lang, ids, starts)
            return
        waiting = self.waiting.setdefault(lang, [])
        waiting += ids
        waiting.append(0)
        self.n_waiting += len(ids) + 1
        if len(waiting) >= PART:
            del self.waiting[lang]
            self.n_waiting -= len(waiting)
            self._count(lang, waiting, len(waiting))

    def _count(self, lang: str, ids: list[int], starts: int) -> None:
        padded = np.array(ids + [0] * (LONGEST - 1), np.int64)
        first = padded[:starts]
        keys, follows = first & (1 << LOW_BITS) - 1, True
        for k in range(1, LONGEST):
            word = np.where(follows, padded[k:k + starts], 0)
            keys, follows = keys << ID_BITS | word, word > 0
        some = first > 0
        tops, keys = (first[some] >> LOW_BITS).astype(np.int16), keys[some]
        if not len(keys):
            return
        along = np.argsort(keys)
        along = along[np.argsort(tops[along], kind="stable")]
        tops, keys = tops[along], keys[along]
        at = _groups(tops)
        below = self.langs.setdefault(lang, {})
        for top, low, high in zip(tops[at[:-1]].tolist(), at, at[1:]):
            self._into(below, top, keys[low:high], REST_BITS)

    def _into(self, above: dict, name: int, keys: np.ndarray, shift: int) -> None:
        """Count sorted keys in what ``above`` has under ``name``; its
        container bursts by ``shift``."""
        box = above.get(name)
        if type(box) is _Node:
            names = keys >> shift
            at = _groups(names)
            for name, low, high in zip(names[at[:-1]].tolist(), at, at[1:]):
                self._into(box, name, keys[low:high], shift - ID_BITS)
            return
        if box is None:
            box = above[name] = Counter()
        before = len(box)
        box.update(keys.tolist())
        self.made += len(box) - before
        if len(box) > self.burst and shift:
            above[name] = node = _Node()
            for key, n in box.items():
                below = node.get(key >> shift)
                if below is None:
                    below = node[key >> shift] = Counter()
                below[key] = n

    def parts(self, text: bytes) -> Iterator[tuple[list[int], int]]:
        """Ids of a text's words, a 0 behind every piece, in parts of bounded
        size, and how many of a part's windows begin in it. Ids hold until
        the next part is asked for."""
        out, get = [], self.ids.__getitem__
        if len(text) < PART:
            words = text.translate(_STOPPED).replace(STOP, b" . ").split()
            if words:
                yield list(map(get, words)), len(words)
            return
        for piece in text.translate(_PLAIN).split(b"\n"):
            words = piece.split()
            if len(words) < PART:
                out.extend(map(get, words))
                out.append(0)
                if len(out) < PART:
                    continue
            if out:
                yield out, len(out)
                out, get = [], self.ids.__getitem__
            # A long piece goes on in the next part, which its last windows
            # reach into.
            for k in range(0, len(words) if len(words) >= PART else 0, PART):
                yield list(map(get, words[k:k + PART + LONGEST - 1])), min(PART, len(words) - k)
                get = self.ids.__getitem__
        if out:
            yield out, len(out)

    def crowded(self) -> bool:
        return len(self.ids.words) >= CROWDED

    def spill(self, everything: bool) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
        """Take out whole subtrees, the largest first, until half of the trie
        is free, or all of them: a language and its windows with their
        counts, sorted."""
        held = self.size
        trees = [(lang, top) for lang, tops in self.langs.items() for top in tops]
        sizes = np.array([len(box) if type(box) is Counter else sum(map(len, _boxes(box)))
                          for tops in self.langs.values() for box in tops.values()], np.int64)
        along = np.argsort(-sizes, kind="stable")
        if not everything:
            free = np.cumsum(sizes[along])
            along = along[:1 + np.searchsorted(free, held - self.held // 2)]
        taken: dict[str, tuple[list, list, list]] = {}
        for lang, top, n in ((*trees[i], n) for i, n in zip(along.tolist(), sizes[along].tolist())):
            tops, counted, boxes = taken.setdefault(lang, ([], [], []))
            tops.append(top)
            counted.append(n)
            boxes.extend(_boxes(self.langs[lang].pop(top)))
        self.made -= int(sizes[along].sum())
        words = self.ids.words
        if everything:
            self._clear()
        for lang, (tops, counted, boxes) in taken.items():
            keys = np.fromiter(chain.from_iterable(boxes), np.int64, sum(counted))
            counts = np.fromiter(chain.from_iterable(box.values() for box in boxes), np.int64, len(keys))
            boxes.clear()
            first = np.repeat(np.array(tops, np.int64), counted) << LOW_BITS | keys >> REST_BITS
            yield lang, *_sorted(words, first, keys, counts)


def _sorted(words: list[bytes], first: np.ndarray, keys: np.ndarray, counts: np.ndarray
            ) -> tuple[pa.Array, np.ndarray]:
    """The windows as bytes, in their order, and their counts."""
    mask = (1 << ID_BITS) - 1
    ids = [first, *(keys >> ID_BITS * k & mask for k in reversed(range(LONGEST - 1)))]
    used = np.zeros(len(words), bool)
    for column in ids:
        used[column] = True
    used = np.flatnonzero(used)
    texts = pa.array([words[i] for i in used.tolist()], pa.binary())
    order = pc.sort_indices(texts).to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[used[order]] = np.arange(len(used))
    ranks = [rank[column] for column in ids]
    packed = ranks[1]
    for column in ranks[2:]:
        packed = packed << ID_BITS | column
    along = np.argsort(packed)
    along = along[np.argsort(ranks[0][along], kind="stable")]
    texts = texts.take(pa.array(order))
    parts = [texts.take(pa.array(column[along])) for column in ranks]
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary())), counts[along]


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       text_or_empty().cast("binary").alias("text"))


def splitters(docs: DataFrame, ranges: int) -> tuple[list[str], list[bytes]]:
    """Languages with a short token, and first keys of the prefix partitions but the first, from a sample
    that is bounded by the number of partitions: documents in the order of
    their hash, one in every ``total / (ranges * SAMPLED)``, and of each the
    windows that begin ``SAMPLED`` evenly spaced pieces."""
    rows = _docs(docs)
    step = max(1, rows.count() // (ranges * SAMPLED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, windows = [], []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                pieces = [p for p in text.translate(_PLAIN).split(b"\n") if p.split()]
                for piece in pieces[::max(1, len(pieces) // SAMPLED)]:
                    langs.append(lang)
                    windows.append(b"".join([w + END for w in piece.split()[:LONGEST]]))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(windows, pa.binary())],
                                             ["lang", "window"])

    sampled = rows.where(F.pmod(F.xxhash64("lang", "text"), F.lit(step)) == 0)
    found = [(r["lang"], bytes(r["window"])) for r in
             sampled.mapInArrow(run, "lang string, window binary").collect()]
    langs = sorted({lang for lang, _ in found})[:SHORT_TOKENS]
    keys = sorted(_token(langs, lang) + window for lang, window in found)
    return langs, sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)} if keys else ())


def _token(langs: list[str], lang: str) -> bytes:
    """What a language's keys begin with: one byte for those in ``langs``."""
    return (bytes([FIRST_TOKEN + langs.index(lang)]) if lang in langs
            else b"!" + lang.encode().hex().encode()) + END


def _language(langs: list[str], token: bytes) -> str:
    return bytes.fromhex(token[1:].decode()).decode() if token[:1] == b"!" else langs[token[0] - FIRST_TOKEN]


def runs(docs: DataFrame, langs: list[str], cuts: list[bytes], burst: int = BURST, held: int = HELD
         ) -> DataFrame:
    """Sorted runs of ``part, window, n``: each task's counts of windows, the
    language's token and the words, each with a space behind it, and their
    prefix partitions."""
    def spilled(trie: Trie, everything: bool) -> Iterator[pa.RecordBatch]:
        for lang, windows, counts in trie.spill(everything):
            token = _token(langs, lang)
            windows = pc.binary_join_element_wise(pa.scalar(token, pa.binary()), windows, pa.scalar(b"", pa.binary()))
            keys = _Bytes(windows)
            low, high = bisect_right(cuts, keys[0]), bisect_right(cuts, keys[len(keys) - 1])
            starts = [bisect_left(keys, w) for w in cuts[low:high]]
            part = low + np.searchsorted(starts, np.arange(len(windows)), side="right")
            for k in range(0, len(windows), BATCH_ROWS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[k:k + BATCH_ROWS], pa.int32()), windows[k:k + BATCH_ROWS],
                     pa.array(counts[k:k + BATCH_ROWS])], ["part", "window", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(burst, held)
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                for ids, starts in trie.parts(text):
                    trie.add(lang, ids, starts)
                    if trie.full() or trie.crowded():
                        yield from spilled(trie, trie.crowded())
        yield from spilled(trie, True)

    return _docs(docs).mapInArrow(run, "part int, window binary, n long")


class _Bytes:
    """An Arrow array as a sequence of bytes."""

    def __init__(self, values: pa.Array):
        self.values = values

    def __len__(self) -> int:
        return len(self.values)

    def __getitem__(self, i: int) -> bytes:
        return self.values[i].as_py()


def _counted(batch: pa.RecordBatch, langs: list[str], least: int) -> pa.RecordBatch:
    """Counts of the phrases that a sorted batch's windows begin with, if they
    are frequent or lie at one of its ends; the empty phrase counts words."""
    n, rows = batch["n"].to_numpy(), len(batch)
    split = pc.split_pattern(batch["window"], END)
    starts, sizes = split.offsets.to_numpy()[:-1], np.diff(split.offsets.to_numpy()) - 1
    new = np.zeros(rows, bool)  # the row begins a group
    new[0] = True
    names, phrases, counts = [], [], []
    for depth in range(1, LONGEST + 2):  # the language, then its words
        at = pa.array(np.where(sizes >= depth, starts + depth - 1, -1), mask=sizes < depth)
        word = split.values.take(at)
        new[1:] |= pc.fill_null(pc.not_equal(word[1:], word[:-1]), True).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(new)
        sums = np.add.reduceat(n, first)
        kept = sums >= least
        kept[[0, -1]] = True
        kept &= sizes[first] >= depth
        for i in first[kept].tolist():
            token, *words = batch["window"][i].as_py().split(END)[:depth]
            names.append(_language(langs, token))
            phrases.append(b" ".join(words))
        counts.append(sums[kept])
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(phrases, pa.binary()),
                                       pa.array(np.concatenate(counts), pa.int64())], ["lang", "phrase", "f"])


def merged(counted: DataFrame, langs: list[str], ranges: int, least: int = LEAST) -> DataFrame:
    """``lang, phrase, f`` of all phrases that occur ``least`` times, and for
    each language the empty phrase with its words, from ``runs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if len(batch):
                parts = {own, *pc.unique(batch["part"]).to_pylist()} - {None}
                if len(parts) > 1:
                    raise ValueError("a task holds more than one prefix partition")
                (own,) = parts
                yield _counted(batch, langs, least)

    # A task's rows are one range, so their windows alone order them.
    ordered = counted.repartitionById(ranges, "part").sortWithinPartitions("window")
    parts = ordered.mapInArrow(run, "lang string, phrase binary, f long")
    return (parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
            .where((F.col("f") >= least) | (F.octet_length("phrase") == 0))
            .withColumn("phrase", F.col("phrase").cast("string")))


def _part(first: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def scored(frequent: DataFrame, scale: int = SCALE) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases of two words or more in
    ``frequent`` (``lang, phrase, f, words``), by their lowest-scoring cut."""
    cuts = [F.when(F.size("words") > k, F.array(
        F.struct(F.lit(f"l{k}").alias("side"), _part(1, k).alias("part"), F.lit(k == 1).alias("single")),
        F.struct(F.lit(f"r{k}").alias("side"), _part(k + 1, LONGEST).alias("part"),
                 (F.size("words") == k + 1).alias("single")))) for k in range(1, LONGEST)]
    empty = F.array().cast("array<struct<side:string,part:string,single:boolean>>")
    parts = (frequent.where(F.size("words") > 1)
             .select("lang", "phrase", F.col("f").alias("a"),
                     F.inline(F.concat(*[F.coalesce(c, empty) for c in cuts])))
             .withColumn("salt", F.when(F.col("single"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
                         .otherwise(F.lit(0)).cast("int")))
    copies = F.when(F.size("words") == 1, F.lit(SALTS - 1)).otherwise(F.lit(0))
    counts = frequent.select("lang", F.col("phrase").alias("part"), "f",
                             F.explode(F.sequence(F.lit(0), copies)).alias("salt"))
    sides = [f"{side}{k}" for k in range(1, LONGEST) for side in "lr"]
    wide = (parts.join(counts, ["lang", "part", "salt"]).groupBy("lang", "phrase")
            .agg(F.max("a").alias("a"), *[F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in sides]))
    # Decimals, since the product may pass 64 bits.
    best = F.array_min(F.array(*[F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(f"(cast({scale} as decimal(10,0)) * cast(a as decimal(19,0)))"
               f" div (cast(l{k} as decimal(19,0)) + cast(r{k} as decimal(19,0)))").alias("score"),
        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST)]))
    return wide.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def uncontained(found: DataFrame, frequent: DataFrame, contained: int = CONTAINED) -> DataFrame:
    """``found`` without phrases most of whose occurrences lie inside one
    longer phrase of ``frequent``."""
    words = F.size("words")
    inner = [F.when((words >= k + size) & (words > size), F.array(_part(k + 1, size)))
             for size in range(2, LONGEST) for k in range(LONGEST - size + 1)]
    empty = F.array().cast("array<string>")
    longer = (frequent.where(F.size("words") > 2)
              .select("lang", "f", F.explode(F.concat(*[F.coalesce(i, empty) for i in inner])).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = F.expr(f"cast(100 as decimal(10,0)) * cast(longer as decimal(19,0))"
                  f" < cast({contained} as decimal(10,0)) * cast(a as decimal(19,0))")
    return (found.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | kept).drop("longer"))


def best(found: DataFrame, top: int = TOP, buckets: int = 256) -> DataFrame:
    """The ``top`` rows of each language with their ``rank``. Every bucket of
    a language hands on its own best, so no task sorts a whole language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(buckets))
    first = (found.withColumn("bucket", bucket)
             .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
             .where(F.col("rank") <= top).drop("rank", "bucket"))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, scale: int = SCALE,
                 contained: int = CONTAINED, burst: int = BURST, held: int = HELD) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    langs, cuts = splitters(docs, ranges)
    counts = saved(merged(runs(docs, langs, cuts, burst, held), langs, ranges, least), "phrases")
    frequent = counts.where(F.col("phrase") != "").withColumn("words", F.split("phrase", " "))
    total = counts.where(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    found = best(uncontained(scored(frequent, scale), frequent, contained), top)
    return found.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
