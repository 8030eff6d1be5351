"""Sinks: list-valued tab-separated outputs, reports, and the binary point cloud."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Boxes of the point cloud's axes.
BOXES = (330.0, 260.0, 300.0)


def list_rows(anchors: DataFrame, pairs: DataFrame, name: str, order: str) -> DataFrame:
    """source1_entity_id and the anchor's targets joined by commas; an anchor without any has an empty string. Blanks, the anchor itself,
    repeats and ids that aren't targets are left out."""
    good = pairs.select("s1_id", F.trim("target_id").alias("target_id"), order).where(F.col("target_id").rlike("^S[23]-") & (F.col("target_id") != F.col("s1_id")))
    first = good.groupBy("s1_id", "target_id").agg(F.min(order).alias("o")).groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct("o", "target_id"))).alias("x"))
    return anchors.join(first, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(F.array_join("x.target_id", ","), F.lit("")).alias(name))


def write_tsv(rows: DataFrame, path: str, ordered: bool = True) -> None:
    """Tab-separated with a header; quotes are data, empty strings stay empty."""
    rows = rows.orderBy(rows.columns[0]) if ordered else rows
    rows.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def write_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def point(crc: Column) -> list[Column]:
    """x, y, z, colour of a row from 32 bits: three times ten bits scaled to a box around 0, and two bits."""
    bits = lambda shift, mask: F.shiftright(crc, shift).bitwiseAND(F.lit(mask))
    axes = [((bits(10 * i, 1023) / 1023.0 - 0.5) * box).cast("float").alias(n) for i, (n, box) in enumerate(zip("xyz", BOXES, strict=True))]
    return [*axes, bits(30, 3).cast("int").alias("colour")]


def point_cloud(ent: DataFrame) -> DataFrame:
    """entity_id, x, y, z, colour: a place for each row by the CRC of its id, name and country."""
    crc = F.crc32(F.encode(F.concat("entity_id", "business_name", "country"), "utf-8")).cast("long")
    return ent.select("entity_id", *point(crc))
