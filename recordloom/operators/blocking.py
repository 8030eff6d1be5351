"""Candidate generation: blocking keys, capped postings, probes, and the audits of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Caps of the rule engine and of the standard blocker.
RULE_POSTINGS, RULE_CANDIDATES, STANDARD_POSTINGS, STANDARD_CANDIDATES = 300, 150, 1000, 50


def _when(condition: Column, key: Column) -> Column:
    return F.when(condition, key)


def rule_keys(norm: DataFrame) -> DataFrame:
    """src, num, entity_id, key, key_ord: keys of the rule engine, each once, numbered in the order that caps consume."""
    t, a, n, canon = F.col("name_tokens"), F.col("addr_tokens"), F.get(F.col("addr_numbers"), F.lit(0)), F.col("name_canonical")
    t0, a0, a1 = F.get(t, F.lit(0)), F.get(a, F.lit(0)), F.get(a, F.lit(1))
    usable = F.filter(t, lambda x: F.length(x) >= 2)
    u0, u1, joined = F.get(usable, F.lit(0)), F.get(usable, F.lit(1)), F.array_join(t, "")
    word = lambda i: F.get(a, F.lit(i))
    named, long0 = canon != "", F.length(t0) >= 3
    one = F.when(F.size(t) >= 2, F.when(F.size(usable) == 1, u0)).otherwise(t0)
    made = [
        _when(named, F.concat(F.lit("NC:"), canon)),
        _when(named & (F.length(joined) >= 6), F.concat(F.lit("NCONCAT:"), F.substring(joined, 1, 20))),
        *[_when(n.isNotNull() & (F.length(word(i)) >= 4), F.concat(F.lit("ADDR_NW:"), n, F.lit("_"), word(i))) for i in range(3)],
        _when(named & (F.size(usable) >= 2) & (F.size(t) >= 2), F.concat(F.lit("NS:"), F.array_join(F.array_sort(F.slice(usable, 1, 4)), "_"))),
        _when(named & (F.size(usable) >= 2) & (F.size(t) >= 2), F.concat(F.lit("NP:"), u0, F.lit("_"), u1)),
        _when(named & (F.length(one) >= 3), F.concat(F.lit("N1:"), one)),
        _when(F.size(a) >= 2, F.concat(F.lit("ADDR_WW:"), a0, F.lit("_"), a1)),
        _when(n.isNotNull() & long0, F.concat(F.lit("ADDR_N1:"), n, F.lit("_"), F.substring(t0, 1, 4))),
        _when(F.col("addr_postal").isNotNull() & long0, F.concat(F.lit("PIN_N1:"), "addr_postal", F.lit("_"), F.substring(t0, 1, 4))),
        _when(F.length(t0) >= 5, F.concat(F.lit("N1L:"), t0)),
    ]
    keys = F.array_distinct(F.array_compact(F.array(*made)))
    return norm.select("src", "num", "entity_id", F.posexplode(keys).alias("key_ord", "key"))


def standard_keys(norm: DataFrame) -> DataFrame:
    """src, num, entity_id, key: keys of the standard blocker."""
    t, canon = F.col("name_tokens"), F.col("name_canonical")
    t0, t1 = F.get(t, F.lit(0)), F.get(t, F.lit(1))
    country = F.when(F.col("country_canonical") == "", F.lit("UNK")).otherwise(F.col("country_canonical"))
    made = [
        _when(canon != "", F.concat(F.lit("NAME_CANON:"), canon)),
        _when(canon != "", F.concat(F.lit("CTRY_NAME:"), country, F.lit(":"), canon)),
        _when(F.size("name_sorted") >= 2, F.concat(F.lit("NAME_SORTED:"), F.array_join("name_sorted", " "))),
        _when(F.col("addr_postal").isNotNull() & (F.length(t0) >= 3), F.concat(F.lit("POSTAL_NAME:"), "addr_postal", F.lit(":"), t0)),
        _when(F.size(t) >= 2, F.concat(F.lit("NAME_2TOK:"), t0, F.lit("_"), t1)),
    ]
    return norm.select("src", "num", "entity_id", F.explode(F.array_distinct(F.array_compact(F.array(*made)))).alias("key"))


def postings(keys: DataFrame, cap: int, per_source: bool = False) -> DataFrame:
    """key, target_id, post_ord: the first `cap` targets of each key (of each source, if asked) in source and row order. The cap is a top-k per key, which
    runs before the shuffle as well, so a key that all rows share sends `cap` rows per task."""
    first = F.row_number().over(Window.partitionBy("key", *["src"] * per_source).orderBy("src", "num"))
    return keys.where("src <> 'S1'").withColumn("post_ord", first).where(F.col("post_ord") <= cap).select("key", F.col("entity_id").alias("target_id"), "post_ord")


def probe_rules(keys: DataFrame, posts: DataFrame, cap: int = RULE_CANDIDATES, per_source: bool = False) -> DataFrame:
    """s1_id, target_id, cand_ord: candidates of each anchor in the order of its keys and their postings, `cap` at most (of each
    source, if asked)."""
    hits = keys.where("src = 'S1'").select(F.col("entity_id").alias("s1_id"), "key", "key_ord").join(posts, "key").where("s1_id <> target_id")
    each = hits.groupBy("s1_id", "target_id").agg(F.min(F.struct("key_ord", "post_ord")).alias("at"))
    return each.withColumn("cand_ord", F.row_number().over(Window.partitionBy("s1_id", *[F.substring("target_id", 1, 2)] * per_source).orderBy("at", "target_id"))).where(F.col("cand_ord") <= cap).select("s1_id", "target_id", "cand_ord")


def probe_standard(keys: DataFrame, posts: DataFrame, cap: int = STANDARD_CANDIDATES) -> DataFrame:
    """s1_id, target_id: the union over an anchor's keys, the `cap` first by id. Of a key's postings only so many smallest ids can be among
    them (one more, for the anchor itself), so the others aren't paired."""
    least = F.row_number().over(Window.partitionBy("key").orderBy("target_id"))
    posts = posts.select("key", "target_id").distinct().withColumn("least", least).where(F.col("least") <= cap + 1).drop("least")
    hits = keys.where("src = 'S1'").select(F.col("entity_id").alias("s1_id"), "key").join(posts, "key").where("s1_id <> target_id").select("s1_id", "target_id").distinct()
    return hits.withColumn("r", F.row_number().over(Window.partitionBy("s1_id").orderBy("target_id"))).where(F.col("r") <= cap).select("s1_id", "target_id")


def shared_keys(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    """s1_id, target_id, n_shared, channels of given pairs: how many keys they share, and of which kinds."""
    a = pairs.join(keys.select(F.col("entity_id").alias("s1_id"), "key"), "s1_id")
    both = a.join(keys.select(F.col("entity_id").alias("target_id"), "key"), ["target_id", "key"])
    kind = F.substring_index("key", ":", 1)
    found = both.groupBy("s1_id", "target_id").agg(F.count("*").alias("n_shared"), F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("channels"))
    return pairs.join(found, ["s1_id", "target_id"], "left").select("s1_id", "target_id", F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared"), F.coalesce("channels", F.lit("")).alias("channels"))


def targets_with_keys(keys: DataFrame) -> DataFrame:
    """target_id of each target that shares a key with some anchor: a semi join that can go before everything else."""
    return keys.where("src <> 'S1'").join(keys.where("src = 'S1'").select("key").distinct(), "key", "left_semi").select(F.col("entity_id").alias("target_id")).distinct()


RULE_KEYS_SQL = """
rk0 AS (SELECT src, num, entity_id, addr_postal, name_canonical AS c, name_tokens AS t, addr_tokens AS a, addr_numbers[1] AS n, list_filter(name_tokens, lambda x: length(x) >= 2) AS u FROM norm),
rk1 AS (SELECT src, num, entity_id, list_filter([
  CASE WHEN c <> '' THEN 'NC:' || c END, CASE WHEN c <> '' AND length(array_to_string(t, '')) >= 6 THEN 'NCONCAT:' || left(array_to_string(t, ''), 20) END,
  CASE WHEN length(a[1]) >= 4 THEN 'ADDR_NW:' || n || '_' || a[1] END, CASE WHEN length(a[2]) >= 4 THEN 'ADDR_NW:' || n || '_' || a[2] END, CASE WHEN length(a[3]) >= 4 THEN 'ADDR_NW:' || n || '_' || a[3] END,
  CASE WHEN len(u) >= 2 THEN 'NS:' || array_to_string(list_sort(u[1:4]), '_') END, CASE WHEN len(u) >= 2 THEN 'NP:' || u[1] || '_' || u[2] END,
  CASE WHEN c <> '' AND len(t) >= 2 AND len(u) = 1 AND length(u[1]) >= 3 THEN 'N1:' || u[1] WHEN c <> '' AND len(t) = 1 AND length(t[1]) >= 3 THEN 'N1:' || t[1] END,
  CASE WHEN len(a) >= 2 THEN 'ADDR_WW:' || a[1] || '_' || a[2] END, CASE WHEN length(t[1]) >= 3 THEN 'ADDR_N1:' || n || '_' || left(t[1], 4) END,
  CASE WHEN length(t[1]) >= 3 THEN 'PIN_N1:' || addr_postal || '_' || left(t[1], 4) END, CASE WHEN length(t[1]) >= 5 THEN 'N1L:' || t[1] END], lambda x: x IS NOT NULL) AS ks FROM rk0),
rk2 AS (SELECT src, num, entity_id, ks, unnest(ks) AS key, generate_subscripts(ks, 1) AS i FROM rk1),
rk3 AS (SELECT src, num, entity_id, key, min(i) AS i FROM rk2 GROUP BY ALL),
rkeys AS (SELECT src, num, entity_id, key, row_number() OVER (PARTITION BY entity_id ORDER BY i) - 1 AS key_ord FROM rk3)"""
STANDARD_KEYS_SQL = """
sk0 AS (SELECT src, num, entity_id, unnest(list_distinct(list_filter([CASE WHEN name_canonical <> '' THEN 'NAME_CANON:' || name_canonical END,
  CASE WHEN name_canonical <> '' THEN 'CTRY_NAME:' || coalesce(nullif(country_canonical, ''), 'UNK') || ':' || name_canonical END,
  CASE WHEN len(name_sorted) >= 2 THEN 'NAME_SORTED:' || array_to_string(name_sorted, ' ') END,
  CASE WHEN length(name_tokens[1]) >= 3 THEN 'POSTAL_NAME:' || addr_postal || ':' || name_tokens[1] END,
  CASE WHEN len(name_tokens) >= 2 THEN 'NAME_2TOK:' || name_tokens[1] || '_' || name_tokens[2] END], lambda x: x IS NOT NULL))) AS key FROM norm),
skeys AS (SELECT * FROM sk0)"""
POSTINGS_SQL = """
posts AS (SELECT key, entity_id AS target_id, row_number() OVER (PARTITION BY key ORDER BY src, num) AS post_ord FROM rkeys WHERE src <> 'S1' QUALIFY post_ord <= 300)"""
RULE_CANDIDATES_SQL = """
rhits AS (SELECT k.entity_id AS s1_id, p.target_id, min((k.key_ord, p.post_ord)) AS spot FROM rkeys k JOIN posts p USING (key) WHERE k.src = 'S1' GROUP BY ALL),
rcands AS (SELECT s1_id, target_id, row_number() OVER (PARTITION BY s1_id ORDER BY spot, target_id) AS cand_ord FROM rhits QUALIFY cand_ord <= 150)"""
STANDARD_CANDIDATES_SQL = """
sposts AS (SELECT key, entity_id AS target_id, row_number() OVER (PARTITION BY key ORDER BY src, num) AS post_ord FROM skeys WHERE src <> 'S1' QUALIFY post_ord <= 1000),
shits AS (SELECT DISTINCT k.entity_id AS s1_id, p.target_id FROM skeys k JOIN sposts p USING (key) WHERE k.src = 'S1'),
scands AS (SELECT s1_id, target_id FROM shits QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY target_id) <= 50)"""
TRUTH_SQL = """
truth AS (SELECT a.entity_id AS s1_id, b.entity_id AS target_id FROM ent a JOIN ent b ON a.text_md5 = b.text_md5 WHERE a.src = 'S1' AND b.src <> 'S1')"""
