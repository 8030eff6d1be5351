"""Browsing: row numbers, substring filters, free search, pages and lists of rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of a page, and the widest range in a list of rows.
PAGE, MOST, WIDEST = 25, 500, 500


def numbered(ent: DataFrame, bins: int = 64) -> DataFrame:
    """ent with n, its row number in the order of src and num. Numbers are counts of earlier bins plus the place within a bin; bins are
    ranges of num, so no task numbers all rows."""
    top = ent.agg(F.max("num").alias("top"), F.min("num").alias("low")).first()
    low, span = (top["low"] or 0), max(1, ((top["top"] or 0) - (top["low"] or 0)) // bins + 1)
    rows = ent.withColumn("_bin", F.expr(f"(num - {low}) div {span}"))
    counts = rows.groupBy("src", "_bin").agg(F.count("*").alias("_n"))
    counts = counts.select("src", "_bin", (F.sum("_n").over(Window.orderBy("src", "_bin")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("src", "_bin").orderBy("num"))
    return rows.withColumn("_in", within).join(counts, ["src", "_bin"]).withColumn("n", F.col("_before") + F.col("_in")).drop("_bin", "_before", "_in")


def matching(ent: DataFrame, entity_id: str = "", name: str = "", address: str = "", country: str = "all") -> DataFrame:
    """Rows whose fields contain the given strings, whatever their case; country "all" is any."""
    for col, value in (("entity_id", entity_id), ("business_name", name), ("business_address", address)):
        if value:
            ent = ent.where(F.contains(F.lower(col), F.lit(value.lower())))
    return ent if country.lower() == "all" else ent.where(F.lower("country") == country.lower())


def search(rows: DataFrame, text: str) -> DataFrame:
    hay = F.concat_ws(" ", F.col("n").cast("string"), F.concat(F.lit("#"), F.col("n").cast("string")), "entity_id", "business_name", "business_address", "country")
    return rows.where(F.contains(F.lower(hay), F.lit(text.lower())))


def page(rows: DataFrame, offset: int = 0, limit: int = PAGE) -> DataFrame:
    """The rows offset + 1 to offset + limit by number: a range filter, not a sort. limit is held to 1 to 500."""
    offset, limit = max(0, offset), min(MOST, max(1, limit))
    return rows.where(F.col("n").between(offset + 1, offset + limit))


def row_list(rows: DataFrame, spec: str) -> DataFrame:
    """The rows named in a list such as 5,10-20,#7; ranges wider than 500 are left out."""
    wanted = F.lit(False)
    for part in spec.split(","):
        if m := re.fullmatch(r"\s*#?(\d+)\s*(?:-\s*#?(\d+)\s*)?", part):
            a, b = int(m[1]), int(m[2] or m[1])
            if 0 <= b - a <= WIDEST:
                wanted = wanted | F.col("n").between(a, b)
    return rows.where(wanted)


def route(text: str, field: str, total: int) -> tuple[str, str | int]:
    """What a query means: ("row", n) for a number within the table asked of all fields, else (field, text) or ("search", text)."""
    if field == "all":
        number = text.strip().removeprefix("#")
        return ("row", int(number)) if number.isdigit() and 1 <= int(number) <= total else ("search", text)
    return field, text
