"""From raw documents to packed training sequences, one operator per stage.

Every stage reads what its predecessor kept, written as Parquet in between, and works on its
own input alone: language models and site rates are learned from the documents that reach
the stage.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import language, minhash, packing, quality, suffixes
from clientele.llm.common import keep
from clientele.llm.queries import BYTE_BPE, fit_for_training
from clientele.session import tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A repeated passage has over fifty words, or so many bytes in fewer words.
WORDS = 51
PASSAGE = 250
SEQUENCE = 2_048


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or too unlike any go.

    Learned from the rows that are not held out; a table without languages keeps all texts
    with letters.
    """
    model = language.fit(docs, ~language.held_out(F.col("doc_id")))
    found = language.identify(docs.select(F.struct(*docs.columns).alias("_row"), "text"), model)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & language.alike(model)).select("_row.*")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text and site make them more likely good than not."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    slim = docs.select(F.struct(*docs.columns).alias("_all"), "doc_id", "text", "source", "lang")
    return quality.judge(slim, labels, fit_for_training()).filter("kept").select("_all.*")


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity 0.8.

    The one with the smallest id stays; of equal rows one.
    """
    judged = minhash.near_duplicates(docs, shingle=5, percent=80).filter("stands")
    key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(minhash.LAST)).alias("_at")
    stay = judged.select(key("doc_id"), F.col("text_hash").alias("_hash"))
    marked = docs.select(F.struct(*docs.columns).alias("_row"), key("doc_id"), F.xxhash64("text").alias("_hash"))
    return marked.join(stay, ["_at", "_hash"], "left_semi").dropDuplicates(["_at", "_hash"]).select("_row.*")


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere, byte for byte: those of WORDS
    words, however short, and those of PASSAGE bytes."""
    shorter = suffixes.remove(docs, length=PASSAGE, words=WORDS)
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents left, packed into sequences."""
    return packing.pack_documents(docs, BYTE_BPE, "spaced", size=SEQUENCE, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_language),
    ("quality classifier", good_quality),
    ("MinHash near-dedup", no_near_copies),
    ("suffix-array dedup", no_repeated_passages),
    ("best-fit packing", packed),
]

# Learned models and token ids are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written and read again as the next one's input."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = keep(docs, f"stage-{k}")
    return docs
