"""Registered queries of the training-data operators, and their SQL twins.

Every query applies its operator, with production parameters, to its whole
table. A query without SQL is held against a brute-force version in
``tests/llm``.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.llm import (bpe, collocations, exact, language, lattice, licenses, merkle, mixing,
                               packing, sharding, simhash, toxicity, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", F.col("source_sizes")[0].alias("source_size"),
        F.col("targets")[0].alias("target"), "taken")


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents")).drop("at")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.fused(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.recoded(_table(spark, sf_dir, "documents"), tokenizer_path())
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = merkle.checked(_table(spark, sf_dir, "documents"), tampered, F.translate("text", "\n", ""))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                       "folded_root", "verified")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_lattice, op3_licenses, op4_packing,
                                   op5_simhash, op6_exact_dedup, op7_language, op8_toxicity,
                                   op9_sharding, op10_warc, op11_bpe, op12_merkle,
                                   op13_collocations)}

def _license_sql() -> str:
    """The rule of ``licenses`` for every template, by looking at every place."""
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    known = ", ".join(f"('{t['label'].split(' ')[0]}', {t['words']}, {t['keys']}, {t['before']}, {t['after']})"
                      for t in licenses.notices(licenses.NOTICES, licenses.KEYS))
    spots = ", ".join(
        "list_filter(range(0, len(words)), lambda i: "
        + " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(), 1)) + f") AS p{n}"
        for n, phrase in enumerate(licenses.BASE))
    everywhere = " || ".join(f"p{n}" for n in range(len(licenses.BASE)))
    labels = ", ".join(f"CASE WHEN len(p{n}) > 0 THEN '{label}' END"
                       for n, label in enumerate(licenses.BASE.values()))

    def holds(line: str) -> str:
        return (f"len(list_filter(keys, lambda o: len(list_filter(o, lambda k: "
                f"contains({line}, ' ' || k || ' '))) > 0)) = len(keys)")
    return f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS low
                   FROM documents),
        w AS (SELECT doc_id, regexp_extract_all(low, '{licenses.WORD}') AS words FROM d),
        s AS (SELECT doc_id, len(words) AS n_words, {spots} FROM w),
        b AS (SELECT doc_id, n_words, {everywhere} AS spots,
                     list_filter([{labels}], lambda x: x IS NOT NULL) AS base FROM s),
        t AS (SELECT * FROM (VALUES {known}) v(label, own, keys, before, after)),
        h AS (SELECT w.doc_id, w.words, t.* FROM
                (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS line FROM w) w, t WHERE {holds("line")}),
        i AS (SELECT *, unnest(list_filter(range(0, len(words)), lambda i: len(list_filter(keys[1], lambda k:
                array_to_string(words[i + 1 : i + len(string_split(k, ' '))], ' ') = k)) > 0)) AS i FROM h),
        p AS (SELECT doc_id, label, own, keys, words[greatest(i - before, 0) + 1 : i + after] AS part FROM i),
        c AS (SELECT doc_id, label, len(list_intersect(own, part)) / len(own) AS contained
              FROM p WHERE {holds("' ' || array_to_string(part, ' ') || ' '")}),
        f AS (SELECT doc_id, list(DISTINCT label) AS more, max(contained) AS best
              FROM c WHERE contained >= {licenses.CONTAINMENT} GROUP BY doc_id)
        SELECT b.doc_id, n_words, len(spots) AS n_base, list_min(spots) AS first_word,
               list_max(spots) AS last_word,
               coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ','), '')
                 AS labels,
               CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
        FROM b LEFT JOIN f ON b.doc_id = f.doc_id"""


ORACLES = {
    "op3_licenses": _license_sql(),
    "op6_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY text)""",
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size
                   FROM pages),
        q AS (SELECT *, size >= 100 AND page_id > min(page_id) OVER w AS again,
                     min(page_id) OVER w AS first FROM p WINDOW w AS (PARTITION BY html))
        SELECT page_id, size AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to
        FROM q""",
}
