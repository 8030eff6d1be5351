"""Sharding by proportional stratified interleaving, with DataFrame operations only.

Rows of each source are put into a seeded random order; a row's fractional rank is (rank - 1/2) / rows of its source.
Sorted by fractional rank, any run of rows has the sources in the proportions of the whole, so cutting that order into
equal runs gives shards that all match the mixture.

Neither order is made in one task. A rank is the number of rows in earlier bins plus the rank within a bin; the bins of
the first order are ranges of the hash, those of the second are ranges of the fractional rank, both of about
`per_bin` rows. So a source with a third of all rows is spread over many tasks, and only the counts by bin are summed up
in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import key_of, order_bits


def interleaved_shards(docs: DataFrame, shards: int = 8, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", per_bin: int = 20_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; law is always `rows`: counts differ by one at most.

    size is the text's UTF-8 bytes plus 1. slot numbers the rows of a shard from 0 without gaps, in interleaved order.
    grown_shard is null, for only a `key` law has one. Null text counts as empty (size 1), null sources are a stratum
    of their own, a null id is kept. Repeated rows are rows like others: each has a slot; which of two equal rows has
    which doesn't matter. An empty table gives no rows. Other columns, whatever their names, are not read.
    """
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), key_of(source_col).alias("src"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    bits = order_bits(docs.count(), per_bin)
    ties = [F.col("h"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]

    rows = rows.withColumn("bin", F.shiftright("h", 64 - bits))
    by_source = Window.partitionBy("src")
    bins = rows.groupBy("src", "bin").agg(F.count("*").alias("n_bin")).select(
        "src", "bin",
        (F.sum("n_bin").over(by_source.orderBy("bin")) - F.col("n_bin")).alias("earlier"),
        F.sum("n_bin").over(by_source).alias("n_src"),
    )
    ranked = rows.withColumn("in_bin", F.row_number().over(Window.partitionBy("src", "bin").orderBy(*ties))).join(bins, ["src", "bin"])
    ranked = ranked.withColumn("at", (F.col("earlier") + F.col("in_bin") - F.lit(0.5)) / F.col("n_src"))

    ranked = ranked.withColumn("run", F.least(F.floor(F.col("at") * F.lit(1 << bits)), F.lit((1 << bits) - 1)).cast("int"))
    runs = ranked.groupBy("run").agg(F.count("*").alias("n_run"))
    runs = runs.select("run", (F.sum("n_run").over(Window.orderBy("run")) - F.col("n_run")).alias("before"), F.sum("n_run").over(Window.partitionBy()).alias("n_all"))
    placed = ranked.withColumn("in_run", F.row_number().over(Window.partitionBy("run").orderBy("at", "src", *ties))).join(runs, "run")
    place = F.col("before") + F.col("in_run") - 1
    placed = placed.withColumn("place", place).withColumn("shard", F.expr(f"(place * {shards}) div n_all"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.expr(f"place - ((shard * n_all + {shards - 1}) div {shards})").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
