"""The corpus pipeline: quality, boilerplate lines, near duplicates, mixture, tokens.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; it works on all that the stage before it kept.
All but the last return the columns of documents. A runner writes each result as Parquet and reads it again as the next
stage's docs; run() chains them without that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import bpe, line_dedup, mixing, ngram_join, quality
from recordloom.llm.common import free_name, read, release, reliable
from recordloom.llm.queries import tokenizer_path

#: Ids of dropped documents that may be broadcast; beyond, they are joined by shuffling.
FEW_IDS = 500_000
#: Near duplicates of the pipeline: likeness in hundredths, words in a shingle. op9_ngram_join has values of its own.
LIKENESS, WORDS = 80, 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps. Null text is judged as empty text, repeated rows alike; very long texts are read
    whole; null sources and languages are groups; without labels, or documents, all (none) are kept."""
    release(spark)
    name = free_name(docs, "quality")
    return quality.classify(docs, read(spark, sf_dir, "labels"), into=name).where(F.col(f"{name}.keep")).drop(name)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without boilerplate lines, whatever share of a document they are; n_chars follows the text. Lines that
    only near copies of one text take to many sites stay. Null text stays null, a document of nothing but boilerplate becomes
    empty; repeated rows are cleaned alike; a null source is a site."""
    release(spark)
    name = free_name(docs, "cleaned")
    out = line_dedup.remove_lines(docs, line_dedup.independent_lines(docs, likeness=LIKENESS, words=WORDS), into=name)
    changed = F.col(f"{name}.n_removed") > 0
    values = {"text": F.when(changed, F.col(f"{name}.text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(changed, F.length(f"{name}.text").cast("long")).otherwise(F.col("n_chars"))
    return out.select(*[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that of smallest id. Rows that repeat an id go with it; rows without an
    id stay. Texts without words, null ones included, are like nothing and stay; an empty table stays empty."""
    release(spark)
    found, name = ngram_join.near_duplicates(docs, LIKENESS, WORDS), free_name(docs, "gone")
    gone = reliable(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(name)).distinct())
    if gone.count() <= FEW_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document comes as many times as its source's target takes it. Its weight is the classifier's posterior, rounded
    so that reruns agree; texts and tables that are empty have weights and mixes too."""
    name = free_name(docs, "quality")
    release(spark)
    scored = quality.classify(docs, read(spark, sf_dir, "labels"), into=name)
    return mixing.mixed_documents(scored, quality=F.greatest(F.lit(0.01), F.round(F.col(f"{name}.posterior"), 3))).drop(name)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of the mix, repeats included. Null text is encoded as empty."""
    release(spark)
    return bpe.encode_digests(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: SQL has no form of the classifier's fit and of the merges; the tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on documents. Between stages the lineage is cut in the shared folder, so no stage is computed twice."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = reliable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
