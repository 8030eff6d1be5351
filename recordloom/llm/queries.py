"""One query for each operator, over its whole table with production parameters, and the SQL that gives the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprint, html_extract, line_dedup, media, mixing, ngram_join, quality, sharding, suffix_dedup
from .common import read


def tokenizer_path(name: str) -> str:
    """Where the vocabulary file is: in the folder named by RECORDLOOM_TOKENIZERS, else in the installed package."""
    if folder := os.environ.get("RECORDLOOM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.classify(docs, read(spark, sf_dir, "labels"), into="found", carry=["doc_id"]).select("doc_id", "found.*")


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(read(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(read(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleaved_shards(read(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_fingerprint": op2_fingerprint,
    "op3_quality": op3_quality,
    "op4_media": op4_media,
    "op5_html": op5_html,
    "op6_mixing": op6_mixing,
    "op7_repeats": op7_repeats,
    "op8_sharding": op8_sharding,
    "op9_ngram_join": op9_ngram_join,
    "op10_lines": op10_lines,
}

#: The merges of 1, the normalisation of 2, the fit of 3, the media of 4, the parser of 5, the byte windows of 7 and the check sums
#: of 8 have no SQL form, or none that is fast enough; their tests compare with the tokenizers library, held-out labels, exact
#: round trips, marked pages and brute force.
ORACLE_SQL: dict[str, str] = {
    "op6_mixing": mixing.mix_sql(),
    "op9_ngram_join": ngram_join.near_duplicates_sql(),
    "op10_lines": line_dedup.line_sql(),
}
