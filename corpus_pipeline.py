"""The corpus pipeline: language, near duplicates, personal data, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.llm.common import step
from clickledger.llm.language import UNKNOWN, identify, train
from clickledger.llm.minhash import near_duplicates
from clickledger.llm.mixing import emit, mix_sources
from clickledger.llm.packing import pack
from clickledger.llm.personal_data import find_personal_data

# fixed value: words in a shingle; the pairs of op7_near_dedup are looser
SHINGLE = 5
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told go on, with that language; the others go.

    A document is rejected if its text is NULL or has no letter.
    """
    found = identify(docs, train(docs), spans=False, keep=DOCUMENT)
    return found.filter(F.col("lang_pred") != UNKNOWN).select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars"
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id.

    Near duplicates share 0.8 of their five-word shingles. Rows without an id were not compared and stay.
    """
    own = docs.select(*DOCUMENT)
    kept = near_duplicates(docs, width=SHINGLE).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    one = own.join(kept, "doc_id").dropDuplicates(["doc_id"]).select(*DOCUMENT)
    return one.unionByName(own.filter("doc_id IS NULL"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, plain or in disguise, is replaced by the name of its kind."""
    clean = find_personal_data(docs, mask=True, keep=["doc_id", "lang", "source"])
    return clean.select(
        "doc_id",
        F.col("masked").alias("text"),
        "lang",
        "source",
        F.length("masked").cast(dict(docs.dtypes)["n_chars"]).alias("n_chars"),
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return emit(docs.select(*DOCUMENT), mix_sources(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their texts, by length bucket and batch."""
    return pack(docs, with_text=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix", mix),
    ("packing", packing),
]
# language models, signatures and transducers are beyond SQL; tests/llm compares with plain code
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = step(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
