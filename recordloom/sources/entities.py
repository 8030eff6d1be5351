"""Sources of entity rows: the view over the documents table, and tab-separated files with quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import INGEST_MISSING, clean_field, strip

ENTITY_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
# Forms of the id and the prefixes of the three sources.
ID_FORM, TARGET_FORM, PREFIXES = r"^(S[123])-(\d+)$", r"^S[23]-", ["S1", "S2", "S3"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, src, num, business_name, business_address, country, text_md5: documents as noisy entity rows of three sources."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    words = F.filter(F.split(F.col("text"), r"[ \t\n\r]+", 20), lambda x: x != "")
    d = d.withColumn("w", F.slice(words, 1, 12)).withColumn("core", F.array_join(F.slice("w", 1, 5), " "))
    suffixes = F.array(*map(F.lit, ["", " Ltd", " Pvt. Ltd.", " Inc", "", " S.A.R.L.", " Company", " LLC"]))
    name = F.when(F.col("doc_id") % 13 == 5, F.concat(F.lit("www."), "core", F.lit(".com"))).otherwise(F.concat("core", F.element_at(suffixes, (F.col("doc_id") % 8 + 1).cast("int"))))
    name = F.concat(F.when(F.col("doc_id") % 11 == 0, F.lit("M/s ")).otherwise(F.lit("")), name)
    address = F.concat(F.col("n_chars").cast("string"), F.lit(" "), "source", F.lit(" Road, "), F.array_join(F.slice("w", 6, 7), " "), F.lit(", 2nd Floor "), (F.col("n_chars") % 90000 + 10000).cast("string"))
    return d.select(
        F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string")).alias("src"), F.col("doc_id").alias("num"), name.alias("business_name"),
        F.when(F.col("doc_id") % 19 == 3, F.lit("N/A")).otherwise(address).alias("business_address"),
        F.when(F.col("doc_id") % 17 == 4, F.lit("null")).when(F.col("lang") == "en", F.lit("U.S.A.")).otherwise(F.col("lang")).alias("country"),
        F.md5(F.encode("text", "utf-8")).alias("text_md5"),
    )


ENTITIES_SQL = r"""
ent_w AS (SELECT doc_id, text, lang, source, n_chars, list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> '') AS w FROM documents),
ent AS (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, 'S' || (doc_id % 3 + 1) AS src, doc_id AS num,
  CASE WHEN doc_id % 11 = 0 THEN 'M/s ' ELSE '' END || CASE WHEN doc_id % 13 = 5 THEN 'www.' || array_to_string(w[1:5], ' ') || '.com'
    ELSE array_to_string(w[1:5], ' ') || (['', ' Ltd', ' Pvt. Ltd.', ' Inc', '', ' S.A.R.L.', ' Company', ' LLC'])[doc_id % 8 + 1] END AS business_name,
  CASE WHEN doc_id % 19 = 3 THEN 'N/A' ELSE n_chars || ' ' || source || ' Road, ' || array_to_string(w[6:12], ' ') || ', 2nd Floor ' || (n_chars % 90000 + 10000) END AS business_address,
  CASE WHEN doc_id % 17 = 4 THEN 'null' WHEN lang = 'en' THEN 'U.S.A.' ELSE lang END AS country, md5(text) AS text_md5 FROM ent_w)"""


def truth_pairs(ent: DataFrame) -> DataFrame:
    """s1_id, target_id: rows of different sources with the same text, the anchor in source 1."""
    a = ent.where("src = 'S1'").select(F.col("entity_id").alias("s1_id"), "text_md5")
    return a.join(ent.where("src <> 'S1'").select(F.col("entity_id").alias("target_id"), "text_md5"), "text_md5").select("s1_id", "target_id")


# --- tab-separated files ---


def check_lines(lines: DataFrame, prefix: str | None = None) -> DataFrame:
    """Lines (value) of an entity file as columns and a reason: null for good rows, else why the row goes to quarantine.

    A row needs four columns, an id of the right form and of the expected source, a country, and a name that isn't the
    word "undefined". Fields are stripped; words for "missing" become empty.
    """
    cells = F.split("value", "\t")
    rows = lines.where(F.trim("value") != "").select("value", F.size(cells).alias("n"), *[clean_field(F.get(cells, F.lit(i))).alias(c) for i, c in enumerate(ENTITY_COLUMNS)])
    reason = F.when(F.col("n") != 4, F.lit("COLUMN_COUNT")).when(~F.col("entity_id").rlike(ID_FORM), F.lit("ID_FORM"))
    if prefix:
        reason = reason.when(~F.col("entity_id").startswith(prefix), F.lit("ID_PREFIX"))
    reason = reason.when(F.lower("business_name") == "undefined", F.lit("NAME_MISSING")).when(F.col("country") == "", F.lit("COUNTRY_MISSING"))
    return rows.select(*ENTITY_COLUMNS, "value", reason.alias("reason"))


def scan_entities(spark: SparkSession, path: str, prefix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) of a file with a header line; quarantine has value, reason, file."""
    header = "\t".join(ENTITY_COLUMNS)
    lines = spark.read.text(path).where(~F.lower("value").isin(header, header.replace("business_", "")))
    checked = check_lines(lines, prefix)
    return checked.where("reason is null").select(*ENTITY_COLUMNS), checked.where("reason is not null").select("value", "reason", F.lit(path).alias("file"))


def scan_truth(spark: SparkSession, path: str) -> DataFrame:
    """s1_id, targets (array) of a ground-truth file of one or two columns; ids that aren't targets are left out."""
    cells = F.split("value", "\t")
    rows = spark.read.text(path).select(strip(F.get(cells, F.lit(0))).alias("s1_id"), F.coalesce(F.get(cells, F.lit(1)), F.lit("")).alias("ids"))
    return rows.where(F.col("s1_id").rlike(r"^S1-\d+$")).select("s1_id", F.filter(F.split("ids", r"[\s,]+"), lambda x: x.rlike(TARGET_FORM)).alias("targets"))


def expected_prefix(file_name: str) -> str | None:
    """S1-, S2- or S3- from names such as source2_train.tsv or s2.tsv."""
    low = file_name.lower()
    return next((f"S{i}-" for i in (1, 2, 3) if f"source{i}" in low or low.startswith(f"s{i}")), None)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256, md5, lines of each file under path; the file source leaves out files of no bytes."""
    files = spark.read.format("binaryFile").load(path)
    text = F.col("content").cast("string")
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"), F.regexp_count(text, F.lit("\n")).cast("long").alias("lines"))


def manifest_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """path, change (MISSING, ADDED, SIZE, CONTENT) between two manifests."""
    both = old.alias("o").join(new.alias("n"), "path", "full")
    change = F.when(F.col("n.bytes").isNull(), "MISSING").when(F.col("o.bytes").isNull(), "ADDED").when(F.col("o.bytes") != F.col("n.bytes"), "SIZE").when(F.col("o.sha256") != F.col("n.sha256"), "CONTENT")
    return both.select("path", change.alias("change")).where("change is not null")


MISSING_SQL = ", ".join(f"'{x}'" for x in INGEST_MISSING)
