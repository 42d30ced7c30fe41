"""From raw documents to packed training sequences, one operator a stage.

Every stage takes all that its predecessor kept, as a table read back from
Parquet, and all but the last return the columns of documents. An empty table
passes through every stage; the operators' own modules say what becomes of
nulls, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dispatchboard.llm import exact, mixing, packing, simhash, toxicity
from dispatchboard.llm.queries import tokenizer_path
from dispatchboard.llm.shared import saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it is trained on
    this input and the labels table."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close fingerprints."""
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time the mix takes a document, none if it doesn't."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies),
          ("SimHash near-dedup", drop_near_copies), ("mixing sources to target weights", mix),
          ("best-fit packing", pack)]

# Training, XXH64 fingerprints and the tokenizer have no SQL; tests/llm holds
# each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
