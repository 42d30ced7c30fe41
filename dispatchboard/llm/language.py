"""Language of web pages by Bayesian evidence fusion.

Three kinds of evidence about a page are combined in log odds:

* its text, by hashed character trigrams whose counts per language come from
  all labelled documents;
* the language its markup declares, weighed by how often each declaration
  goes with each language's text over all pages;
* its address: the share of each language on its host, smoothed towards its
  domain, that towards the address suffix, and that towards all pages. The
  shares are grouped sums of what the texts say, each page left out of its own.

A text's likelihood is tempered to that of ``EVIDENCE`` trigrams, since the
trigrams of one text are far from independent.

Sums are pre-aggregated in the map tasks, so a host with a third of the pages
is one row a task; pages meet their host's sums in a join Spark can split.
The driver holds the trigram table (its size fixed by the languages) and the
table of declarations.

Cases: a null html has no text and declares nothing; a null or odd url has the
empty host; without labelled documents the language and its confidence are
null; ties go to the first language in order; repeated rows and null page_ids
each get their row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchboard.llm.shared import saved

BUCKETS = 1 << 15
EVIDENCE = 20
# Pages' worth of belief each level takes from the one above it.
SMOOTHING = 5.0
# Pages' worth of belief, before any is seen, that markup declares the truth.
HONEST, OTHERWISE = 8.0, 1.0

_HIDDEN = re.compile(r"<!--|<(script|style)\b", re.I)
_ENDS = {None: re.compile("-->"), "script": re.compile(r"</script\s*+>", re.I),
         "style": re.compile(r"</style\s*+>", re.I)}
_TAG = re.compile(r"<[^>]*>")
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"\blang\s*+=\s*+[\"']?+\s*+([A-Za-z]{2,})", re.I)


def visible(page: str) -> str:
    """The page's text without comments, scripts, styles and tags; what is
    opened and never closed stays. Every byte is looked at a few times,
    however many openings have no end."""
    kept, at, endless = [], 0, set()
    for opened in _HIDDEN.finditer(page):
        kind = opened.group(1) and opened.group(1).lower()
        if opened.start() < at or kind in endless:
            continue
        closed = _ENDS[kind].search(page, opened.end())
        if closed is None:
            endless.add(kind)  # nor is there one further on
            continue
        kept += page[at:opened.start()], " "
        at = closed.end()
    kept.append(page[at:])
    text = "".join(kept)
    last = text.rfind(">") + 1  # up to here every tag has an end
    return html.unescape(_TAG.sub(" ", text[:last]) + text[last:])


def declared(page: str) -> str | None:
    """The primary subtag of the first language an html tag declares."""
    at = 0
    while opened := _HTML.search(page, at):
        end = page.find(">", opened.end())
        end = len(page) if end < 0 else end
        if found := _LANG.search(page, opened.end(), end):
            return found.group(1).lower()
        at = end  # openings before it were part of this tag
    return None


def address(url: str | None) -> tuple[str, str, str]:
    """Host, its last two labels and its last label, lower case; empty where
    there is none."""
    try:
        host = (urlsplit((url or "").strip()).hostname or "").rstrip(".")
    except ValueError:
        host = ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased text, white space run together."""
    points = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"), "<u4")
    if len(points) < 3:
        return np.empty(0, np.int64)
    p = points.astype(np.uint64)
    mixed = (p[:-2] * np.uint64(0x9E3779B1) + p[1:-1]) * np.uint64(0x85EBCA77) + p[2:]
    return ((mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)).astype(np.int64) % BUCKETS


@dataclass
class Model:
    """Log likelihood of each trigram bucket (rows) per language (columns)."""
    languages: list[str]
    table: np.ndarray

    def likelihood(self, text: str) -> np.ndarray:
        found = trigrams(text)
        if not len(found):
            return np.zeros(len(self.languages))
        return self.table[found].mean(0) * min(len(found), EVIDENCE)


def train(docs: DataFrame) -> Model:
    """Trigram counts per ``lang`` over the whole ``docs``."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, own in counts.items():
            seen = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": seen, "n": own[seen]})

    some = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    rows = (some.mapInPandas(counted, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    table = np.ones((BUCKETS, len(languages)))
    table[rows["bucket"], rows["lang"].map({x: i for i, x in enumerate(languages)}).astype(int)] += rows["n"]
    return Model(languages, np.log(table / table.sum(0)))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def evidence(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, host, domain, suffix, declared, text`` (log likelihoods)
    and ``belief`` (what the text alone says; zeros where there is none)."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page_id, url, page in zip(batch["page_id"], batch["url"], batch["html"]):
                page = page or ""
                text = model.likelihood(visible(page))
                belief = _softmax(text) if text.any() else text
                out.append((page_id, *address(url), declared(page), text.tolist(), belief.tolist()))
            yield pd.DataFrame(out, columns=["page_id", "host", "domain", "suffix", "declared", "text", "belief"])

    return pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"),
                        F.col("html").cast("string")).mapInPandas(
        read, "page_id string, host string, domain string, suffix string, declared string, "
              "text array<double>, belief array<double>")


def _sums(rows: DataFrame, keys: list[str], width: int, column: str) -> DataFrame:
    sums = [F.sum(F.col(column)[i]).alias(f"s{i}") for i in range(width)]
    return rows.groupBy(*keys).agg(*sums).select(
        *keys, F.array(*[F.col(f"s{i}") for i in range(width)]).alias("sums"))


def fused(pages: DataFrame, docs: DataFrame, model: Model | None = None) -> DataFrame:
    """A row per page: ``page_id, lang, confidence, text_lang, declared,
    host``."""
    model = model or train(docs)
    languages, width = model.languages, len(model.languages)
    kind = pages.schema["page_id"].dataType
    if not languages:
        return pages.select("page_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("lang", "string"), ("confidence", "double"), ("text_lang", "string"),
            ("declared", "string"), ("host", "string"))])
    rows = saved(evidence(pages, model), "evidence")
    hosts = _sums(rows, ["host", "domain", "suffix"], width, "belief")
    domains = _sums(hosts.withColumnRenamed("sums", "of"), ["domain", "suffix"], width, "of")
    suffixes = _sums(domains.withColumnRenamed("sums", "of"), ["suffix"], width, "of")
    whole = _sums(suffixes.withColumnRenamed("sums", "of"), [], width, "of")
    levels = saved(hosts.withColumnRenamed("sums", "on_host")
                   .join(domains.withColumnRenamed("sums", "on_domain"), ["domain", "suffix"])
                   .join(suffixes.withColumnRenamed("sums", "on_suffix"), "suffix")
                   .select("host", "on_host", "on_domain", "on_suffix"), "levels")
    everywhere = np.array(whole.first()["sums"] or [0.0] * width)
    # Declarations outside the known languages are one kind, so this is small.
    said = F.when(F.col("declared").isin(languages), F.col("declared")).otherwise(
        F.when(F.col("declared").isNotNull(), F.lit("*")).otherwise(F.lit("")))
    heard = {r["said"]: np.array(r["sums"]) for r in
             _sums(rows.withColumn("said", said), ["said"], width, "belief").collect()}
    kinds = [*languages, "*", ""]
    chance = np.array([heard.get(k, np.zeros(width))
                       + [HONEST if k == x else OTHERWISE for x in languages] for k in kinds])
    chance = np.log(chance / chance.sum(0))  # log P(declaration | language)

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {k: i for i, k in enumerate(kinds)}
        for b in batches:
            own = np.array(b["belief"].tolist())
            share = np.full(width, 1 / width)
            for sums in (everywhere, *(np.array(b[c].tolist()) for c in ("on_suffix", "on_domain", "on_host"))):
                others = np.maximum(sums - own, 0)
                share = (others + SMOOTHING * share) / (others.sum(1, keepdims=True) + SMOOTHING)
            said = [place.get(d, place["*"]) if d else place[""] for d in b["declared"]]
            text = np.array(b["text"].tolist())
            odds = np.log(share) + text + chance[said]
            best, text_best = odds.argmax(1), text.argmax(1)
            yield pd.DataFrame({
                "page_id": b["page_id"], "lang": [languages[i] for i in best],
                "confidence": _softmax(odds)[np.arange(len(b)), best],
                "text_lang": [languages[i] if t.any() else None for i, t in zip(text_best, text)],
                "declared": b["declared"], "host": b["host"]})

    return (rows.join(levels, "host").select("page_id", "declared", "host", "text", "belief", "on_host",
                                             "on_domain", "on_suffix")
            .mapInPandas(decide, "page_id string, lang string, confidence double, text_lang string, "
                                 "declared string, host string")
            .withColumn("page_id", F.col("page_id").cast(kind)))
