"""Removal of lines that stand on many sites.

Each line's hash gathers a HyperLogLog sketch of the sites that have it; sketches merge by aggregation, so a line that a
third of all documents has is reduced on the map side. Lines whose estimate is clearly above the threshold are
boilerplate, those clearly below aren't, and those near it get an exact distinct count.

The pipeline counts sites over near-distinct texts: a group of near copies counts as one text on one site, so a document
that is copied to many sites doesn't make boilerplate of its lines.
"""

from __future__ import annotations

import math

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, key_of, lean, reliable, text_of
from .ngram_join import near_duplicates

#: Production parameters: sites from which a line is boilerplate; log2 of a sketch's registers; hashes that may be broadcast.
MIN_SITES, LG_K, FEW_LINES = 10, 12, 200_000
#: Near copies that count as one text: likeness in hundredths, words in an n-gram; texts whose hashes may be broadcast.
COPY_LIKENESS, COPY_WORDS, FEW_TEXTS = 80, 5, 500_000


def _line_hashes(text: Column) -> Column:
    """Hashes of the lines that aren't blank, spaces around them left out, each once."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES, text_col: str = "text", site_col: str = "source", lg_k: int = LG_K, few_lines: int = FEW_LINES) -> DataFrame:
    """line (64-bit hash) of each line that stands on min_sites or more distinct sites; a null site is a site."""
    lines = docs.select(key_of(site_col).alias("site"), F.explode(_line_hashes(text_of(text_col))).alias("line"))
    near = math.ceil(min_sites * 4 * 1.04 / math.sqrt(1 << lg_k)) + 1  # four standard errors, and rounding
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch")).select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = reliable(spread.where(F.col("sites") >= min_sites - near))
    sure = spread.where(F.col("sites") > min_sites + near).select("line")
    unsure = spread.where(F.col("sites") <= min_sites + near).select("line")
    # a line that a third of all documents have must not be shuffled by its hash before it's counted once for each site
    pairs = lines.join(F.broadcast(unsure), "line", "left_semi").distinct() if unsure.count() <= few_lines else lines.distinct().join(unsure, "line", "left_semi")
    return sure.union(pairs.groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites).select("line"))


def independent_lines(docs: DataFrame, min_sites: int = MIN_SITES, likeness: int = COPY_LIKENESS, words: int = COPY_WORDS, few_texts: int = FEW_TEXTS, text_col: str = "text", site_col: str = "source") -> DataFrame:
    """line of each of boilerplate_lines that stands on min_sites sites still when sites are counted over near-distinct texts.

    Texts that hold such a line are grouped by near_duplicates, equal ones included. Of a group's sites that have a line,
    the one of smallest hash counts, so which one is the same in every run and not the same for all groups.
    """
    candidates = reliable(boilerplate_lines(docs, min_sites, text_col, site_col))
    candidates = F.broadcast(candidates) if candidates.count() <= few_texts else candidates
    keyed = docs.select(F.xxhash64(text_of(text_col)).alias("doc_id"), text_of(text_col).alias("text"), key_of(site_col).alias("site"))
    held = keyed.select(F.col("doc_id").alias("held"), "site", F.explode(_line_hashes(F.col("text"))).alias("line")).join(candidates, "line", "left_semi")
    held = reliable(held.distinct())
    keys = held.select("held").distinct()
    if keys.count() <= few_texts:
        keys = F.broadcast(keys)
    texts = keyed.select("doc_id", "text").join(keys, F.col("doc_id") == F.col("held"), "left_semi")
    groups = near_duplicates(texts, likeness, words).select("doc_id", "component_id").distinct()
    places = held.join(groups, F.col("held") == F.col("doc_id")).groupBy("line", "component_id").agg(F.min(F.struct(F.xxhash64("component_id", "site"), "site")).getField("site").alias("site"))
    return places.select("line", "site").distinct().groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites).select("line")


def _clean(text: str, hit: set[int] | frozenset[int], least_kept: float) -> tuple[str, int, int]:
    lines = text.split("\n")
    kept = []
    for x in lines:
        core = x.strip(" ")
        h = xxhash.xxh64_intdigest(core.encode(), seed=42) if core else None
        if h is None or (h - (1 << 64) if h >> 63 else h) not in hit:
            kept.append(x)
    out = "\n".join(kept)
    if len(kept) == len(lines) or len(out) < least_kept * len(text):
        return text, len(lines), 0
    return out, len(lines), len(lines) - len(kept)


def remove_lines(docs: DataFrame, lines: DataFrame, least_kept: float = 0.0, few_lines: int = FEW_LINES, id_col: str = "doc_id", text_col: str = "text", into: str = "cleaned") -> DataFrame:
    """docs with one more column, a struct: text, n_lines, n_removed.

    Every line of `lines` goes, whatever is left. With `least_kept` over 0, a document that would keep less than that share
    of its characters stays as it is, boilerplate and all; no query or stage asks for that. Hashes are broadcast only if there are few_lines of them at most;
    beyond, they're joined to the lines of the documents, and each document gets its own.
    """
    lines, docs = reliable(lines), lean(docs)
    kind = "text string, n_lines long, n_removed long"
    if lines.count() <= few_lines:
        hit = docs.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in lines.collect()))

        @F.pandas_udf(kind)
        def clean(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([_clean(t, hit.value, least_kept) for t in texts], columns=["text", "n_lines", "n_removed"])

        return docs.withColumn(into, clean(text_of(text_col)))

    @F.pandas_udf(kind)
    def clean_by(texts: pd.Series, hits: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_clean(t, frozenset(map(int, h)) if h is not None else frozenset(), least_kept) for t, h in zip(texts, hits, strict=True)], columns=["text", "n_lines", "n_removed"])

    own, hits, k = free_name(docs, "own"), free_name(docs, "hits"), free_name(docs, "k")
    keyed = docs.withColumn(own, F.sha2(F.encode(text_of(text_col), "utf-8"), 256))
    found = keyed.select(F.col(own).alias(k), F.explode(_line_hashes(text_of(text_col))).alias("line")).distinct().join(lines, "line", "left_semi")
    found = found.groupBy(k).agg(F.collect_set("line").alias(hits))
    out = keyed.join(found, F.col(own) == F.col(k), "left").withColumn(into, clean_by(text_of(text_col), F.col(hits)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], into)


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, text_col: str = "text", site_col: str = "source", into: str = "cleaned", **options) -> DataFrame:
    """`remove_lines` of the corpus's own boilerplate: docs and a struct of text, n_lines, n_removed.

    Null text is an empty document of one blank line; blank lines are never boilerplate; repeated rows are cleaned
    alike; an empty table gives no rows; extra columns are kept.
    """
    return remove_lines(docs, boilerplate_lines(docs, min_sites, text_col, site_col), text_col=text_col, into=into, **options)


def line_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_removed, n_chars, kept_sha256 for each document."""
    out = dedup_lines(docs.select("doc_id", "text", "source"), into="cleaned", **options)
    return out.select("doc_id", "cleaned.n_lines", "cleaned.n_removed", F.length("cleaned.text").cast("long").alias("n_chars"), F.sha2(F.encode("cleaned.text", "utf-8"), 256).alias("kept_sha256"))


def line_sql(min_sites: int = MIN_SITES) -> str:
    """The same rows with exact counts throughout."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
l AS (SELECT r, doc_id, text, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
b AS (SELECT trim(line, ' ') AS line FROM l WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT coalesce('=' || source, '-')) >= {min_sites}),
k AS (SELECT l.r, l.doc_id, l.text, l.line, l.i, b.line IS NOT NULL AS hit FROM l LEFT JOIN b ON trim(l.line, ' ') = b.line),
g AS (SELECT r, doc_id, text, count(*) AS n_lines, count(*) FILTER (WHERE hit) AS n_hit,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT hit), '') AS kept FROM k GROUP BY ALL)
SELECT doc_id, n_lines, n_hit AS n_removed, length(kept) AS n_chars, sha256(kept) AS kept_sha256 FROM g"""
