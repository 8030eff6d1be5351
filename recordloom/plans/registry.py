"""All queries of the engine by name, and the SQL that gives the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.text import char_ngrams
from ..operators import blocking as B
from ..operators import checks as C
from ..operators import evaluate as E
from ..operators import models as M
from ..operators import pairs as P
from ..operators import tfidf as T
from ..operators.normalise import NORM_SQL, normalise
from ..sources.entities import ENTITIES_SQL, entities, table, truth_pairs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of (spark, sf_dir) under its own name, and its SQL."""

    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLE_SQL[key] = sql
        return f

    return add


# --- building blocks, Spark and SQL side by side ---


def _norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(entities(spark, sf_dir))


def _anchors(spark, sf_dir):
    return entities(spark, sf_dir).where("src = 'S1'").select(F.col("entity_id").alias("s1_id"))


def _truth(spark, sf_dir):
    return truth_pairs(entities(spark, sf_dir))


def _rule_cands(spark, sf_dir):
    keys = B.rule_keys(_norm(spark, sf_dir))
    return B.probe_rules(keys, B.postings(keys, B.RULE_POSTINGS))


def _standard_cands(spark, sf_dir, norm=None):
    keys = B.standard_keys(_norm(spark, sf_dir) if norm is None else norm)
    return B.probe_standard(keys, B.postings(keys, B.STANDARD_POSTINGS))


def _tfidf_cands(spark, sf_dir, norm=None):
    norm = _norm(spark, sf_dir) if norm is None else norm
    return T.similar_texts(norm.select(F.col("entity_id").alias("id"), F.col("name_canonical").alias("text"), (F.col("src") != "S1").alias("target")))


def _merged(spark, sf_dir, norm=None):
    """norm is read five times, so it is made once."""
    norm = T.cut(_norm(spark, sf_dir)) if norm is None else norm
    return E.merge_candidates(_standard_cands(spark, sf_dir, norm), _tfidf_cands(spark, sf_dir, norm))


def _features(spark, sf_dir, only=None):
    """All features of the merged candidates, or those named."""
    norm = T.cut(_norm(spark, sf_dir))
    return P.pair_features(_merged(spark, sf_dir, norm), norm, only)


def _scored(spark, sf_dir, fuzzy=False):
    return P.rule_score(_rule_cands(spark, sf_dir), _norm(spark, sf_dir), fuzzy=fuzzy)


def _matches(spark, sf_dir, tau=P.TAU):
    return E.top_matches(_scored(spark, sf_dir), tau)


def sql(*parts: str, then: str) -> str:
    return "WITH " + ", ".join([ENTITIES_SQL, NORM_SQL, *parts]) + " " + then


join = lambda c: F.array_join(c, " ")
RULES = [B.RULE_KEYS_SQL, B.POSTINGS_SQL, B.RULE_CANDIDATES_SQL]
STANDARD = [B.STANDARD_KEYS_SQL, B.STANDARD_CANDIDATES_SQL]
MERGED = """
merged AS (SELECT s1_id, target_id, s.s1_id IS NOT NULL AS in_standard, t.s1_id IS NOT NULL AS in_tfidf, coalesce(t.score, 0.0) AS tfidf,
  row_number() OVER (PARTITION BY s1_id ORDER BY (s.s1_id IS NOT NULL AND t.s1_id IS NOT NULL) DESC, coalesce(t.score, 0.0) DESC, target_id) AS place
  FROM scands s FULL JOIN ttop t USING (s1_id, target_id) QUALIFY place <= 50)"""
JACCARD = "CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) END"
CONTRADICTS = """(len({a}.addr_numbers) > 0 AND len({b}.addr_numbers) > 0 AND CASE WHEN len(list_filter({a}.addr_numbers, lambda v: v IS DISTINCT FROM {a}.addr_postal)) > 0 AND len(list_filter({b}.addr_numbers, lambda w: w IS DISTINCT FROM {b}.addr_postal)) > 0
  THEN len(list_intersect(list_filter({a}.addr_numbers, lambda v: v IS DISTINCT FROM {a}.addr_postal), list_filter({b}.addr_numbers, lambda w: w IS DISTINCT FROM {b}.addr_postal))) = 0 ELSE len(list_intersect({a}.addr_numbers, {b}.addr_numbers)) = 0 END)"""


def _jac(a, b):
    return JACCARD.format(a=a, b=b)


def _both(a, b, then):
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE {then} END"


def _lev(a, b):
    return _both(a, b, f"1 - levenshtein({a}, {b}) / greatest(length({a}), length({b}))")


# --- normalisation and scalar functions ---


@query(f"WITH {ENTITIES_SQL} SELECT entity_id, business_name, business_address, country, text_md5 FROM ent")
def entity_view(spark, sf_dir):
    return entities(spark, sf_dir).select("entity_id", "business_name", "business_address", "country", "text_md5")


@query(sql(then="SELECT entity_id, name_clean, name_canonical, array_to_string(name_sorted, ' ') AS name_sorted, name_suffix, name_url FROM norm"))
def name_norm(spark, sf_dir):
    return _norm(spark, sf_dir).select("entity_id", "name_clean", "name_canonical", join("name_sorted").alias("name_sorted"), "name_suffix", "name_url")


@query(sql(then="SELECT entity_id, addr_clean, addr_canonical, array_to_string(addr_sorted, ' ') AS addr_sorted, array_to_string(addr_numbers, ' ') AS addr_numbers, addr_postal, addr_empty FROM norm"))
def addr_norm(spark, sf_dir):
    return _norm(spark, sf_dir).select("entity_id", "addr_clean", "addr_canonical", join("addr_sorted").alias("addr_sorted"), join("addr_numbers").alias("addr_numbers"), "addr_postal", "addr_empty")


@query(sql(then="SELECT entity_id, country_canonical, country_missing, country_seen FROM norm"))
def country_norm(spark, sf_dir):
    return _norm(spark, sf_dir).select("entity_id", "country_canonical", "country_missing", "country_seen")


@query(sql(T.TFIDF_SQL.split("ttf AS")[0].rstrip().rstrip(","), then="SELECT id AS entity_id, len(gs) AS n_grams, array_to_string(gs, '|') AS grams FROM tgrams"))
def char_ngrams_of_names(spark, sf_dir):
    grams = char_ngrams(F.col("name_canonical"))
    return _norm(spark, sf_dir).select("entity_id", F.size(grams).cast("long").alias("n_grams"), F.array_join(grams, "|").alias("grams"))


PAIRED = "pn AS (SELECT r.s1_id, r.target_id, a, t FROM rcands r JOIN norm a ON r.s1_id = a.entity_id JOIN norm t ON r.target_id = t.entity_id)"


@query(sql(*RULES, PAIRED, then=f"""SELECT s1_id, target_id, {_jac('a.name_tokens', 't.name_tokens')} AS jaccard, len(list_intersect(a.name_tokens, t.name_tokens)) AS overlap,
  CASE WHEN len(a.name_tokens) = 0 OR len(t.name_tokens) = 0 THEN 0.0 ELSE len(list_intersect(a.name_tokens, t.name_tokens)) / least(len(a.name_sorted), len(t.name_sorted)) END AS containment FROM pn"""))
def token_sets(spark, sf_dir):
    a, t = F.col("a.name_tokens"), F.col("t.name_tokens")
    return P.paired(_rule_cands(spark, sf_dir), _norm(spark, sf_dir)).select("s1_id", "target_id", S.jaccard(a, t).alias("jaccard"), S.overlap(a, t).cast("long").alias("overlap"), S.containment(a, t).alias("containment"))


@query(sql(*RULES, PAIRED, then=f"""SELECT s1_id, target_id, levenshtein(a.name_canonical, t.name_canonical) AS distance, least(levenshtein(a.name_canonical, t.name_canonical), 6) AS bounded,
  {_lev('a.name_canonical', 't.name_canonical')} AS similarity, {_both('a.name_canonical', 't.name_canonical', 'least(length(a.name_canonical), length(t.name_canonical)) / greatest(length(a.name_canonical), length(t.name_canonical))')} AS length_ratio FROM pn"""))
def edit_similarity(spark, sf_dir):
    a, t = F.col("a.name_canonical"), F.col("t.name_canonical")
    return P.paired(_rule_cands(spark, sf_dir), _norm(spark, sf_dir)).select("s1_id", "target_id", S.edit_distance(a, t).cast("long").alias("distance"), S.edit_distance(a, t, 5).cast("long").alias("bounded"), S.edit_similarity(a, t).alias("similarity"), S.length_ratio(a, t).alias("length_ratio"))


@query(sql(*RULES, PAIRED, then=f"SELECT s1_id, target_id, {_jac('a.addr_numbers', 't.addr_numbers')} AS number_jaccard, {CONTRADICTS.format(a='a', b='t')} AS contradiction FROM pn"))
def numeric_evidence(spark, sf_dir):
    a, t = F.col("a.addr_numbers"), F.col("t.addr_numbers")
    return P.paired(_rule_cands(spark, sf_dir), _norm(spark, sf_dir)).select("s1_id", "target_id", S.jaccard(a, t).alias("number_jaccard"), S.numeric_contradiction(a, t, F.col("a.addr_postal"), F.col("t.addr_postal")).alias("contradiction"))


NEAR = "len(list_filter({a}.addr_numbers, lambda v: length(v) >= 2 AND len(list_filter({b}.addr_numbers, lambda w: length(w) >= 2 AND (starts_with(v, w) OR starts_with(w, v)) AND abs(length(v) - length(w)) <= 1)) > 0)) > 0"


@query(sql(*RULES, PAIRED, then=f"SELECT s1_id, target_id, {NEAR.format(a='a', b='t')} AS near FROM pn"))
def ocr_number_match(spark, sf_dir):
    return P.paired(_rule_cands(spark, sf_dir), _norm(spark, sf_dir)).select("s1_id", "target_id", S.near_numbers(F.col("a.addr_numbers"), F.col("t.addr_numbers")).alias("near"))


# --- blocking and retrieval ---


@query(sql(B.RULE_KEYS_SQL, then="SELECT entity_id, key, key_ord FROM rkeys"))
def blocking_keys(spark, sf_dir):
    return B.rule_keys(_norm(spark, sf_dir)).select("entity_id", "key", F.col("key_ord").cast("long").alias("key_ord"))


@query(sql(B.STANDARD_KEYS_SQL, then="SELECT entity_id, key FROM skeys"))
def standard_blocking_keys(spark, sf_dir):
    return B.standard_keys(_norm(spark, sf_dir)).select("entity_id", "key")


@query(sql(B.RULE_KEYS_SQL, B.POSTINGS_SQL, then="SELECT key, target_id, post_ord FROM posts"))
def postings_capped(spark, sf_dir):
    return B.postings(B.rule_keys(_norm(spark, sf_dir)), B.RULE_POSTINGS).withColumn("post_ord", F.col("post_ord").cast("long"))


@query(sql(*RULES, then="SELECT s1_id, target_id, cand_ord FROM rcands"))
def candidates_rule(spark, sf_dir):
    return _rule_cands(spark, sf_dir).withColumn("cand_ord", F.col("cand_ord").cast("long"))


@query(sql(*STANDARD, then="SELECT s1_id, target_id FROM scands"))
def candidates_std(spark, sf_dir):
    return _standard_cands(spark, sf_dir)


@query(sql(B.RULE_KEYS_SQL, then="SELECT DISTINCT entity_id AS target_id FROM rkeys WHERE src <> 'S1' AND key IN (SELECT key FROM rkeys WHERE src = 'S1')"))
def semi_join_targets(spark, sf_dir):
    return B.targets_with_keys(B.rule_keys(_norm(spark, sf_dir)))


@query(sql(B.RULE_KEYS_SQL, B.TRUTH_SQL, then="""SELECT t.s1_id, t.target_id, count(b.key) AS n_shared, coalesce(string_agg(DISTINCT split_part(b.key, ':', 1), ',' ORDER BY split_part(b.key, ':', 1)), '') AS channels
  FROM truth t LEFT JOIN rkeys a ON a.entity_id = t.s1_id LEFT JOIN rkeys b ON b.entity_id = t.target_id AND b.key = a.key GROUP BY ALL"""))
def shared_keys(spark, sf_dir):
    return B.shared_keys(B.rule_keys(_norm(spark, sf_dir)), _truth(spark, sf_dir))


@query(sql(B.TRUTH_SQL, then="""SELECT x.s1_id, x.target_id AS s2_id, y.target_id AS s3_id FROM (SELECT * FROM truth WHERE target_id LIKE 'S2-%' QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY target_id) <= 2) x
  JOIN (SELECT * FROM truth WHERE target_id LIKE 'S3-%' QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY target_id) <= 2) y USING (s1_id)"""))
def cross_source_pairs(spark, sf_dir):
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy("s1_id", F.substring("target_id", 1, 2)).orderBy("target_id"))
    top = _truth(spark, sf_dir).withColumn("r", first).where("r <= 2")
    a = top.where(F.col("target_id").startswith("S2-")).select("s1_id", F.col("target_id").alias("s2_id"))
    return a.join(top.where(F.col("target_id").startswith("S3-")).select("s1_id", F.col("target_id").alias("s3_id")), "s1_id")


@query(sql(T.TFIDF_SQL, then="SELECT gram, df, round(idf, 9) AS idf FROM tidf"))
def tfidf_idf(spark, sf_dir):
    norm = _norm(spark, sf_dir).where("src <> 'S1'")
    return T.idf(T.counts(norm, "entity_id", "name_canonical"), norm.count()).select("gram", "df", F.round("idf", 9).alias("idf"))


@query(sql(T.TFIDF_SQL, then="SELECT s1_id, target_id, score FROM ttop"))
def tfidf_topk(spark, sf_dir):
    return _tfidf_cands(spark, sf_dir)


def _grams_sql(x):
    return f"CASE WHEN {x} = '' THEN [] ELSE list_transform(range(1, length({x}) + 1), lambda i: substr('#' || {x} || '#', i, 3)) END"


def _cosine_sql(a, b):
    """Cosine of n-gram counts with sublinear weights, from lists."""
    w = lambda g, v: f"(1 + ln(len(list_filter({g}, lambda q: q = {v}))))"
    ga, gb = _grams_sql(a), _grams_sql(b)
    total = lambda items, f: f"coalesce(list_sum(list_transform({items}, lambda u: {f})), 0.0)"
    dot = total(f"list_sort(list_distinct(list_intersect({ga}, {gb})))", f"{w(ga, 'u')} * {w(gb, 'u')}")
    norm = lambda g: f"sqrt({total(f'list_distinct({g})', f'{w(g, chr(117))} * {w(g, chr(117))}')})"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE least(1.0, {dot} / ({norm(ga)} * {norm(gb)})) END"


@query(sql(*RULES, PAIRED, then=f"SELECT s1_id, target_id, round({_cosine_sql('a.name_canonical', 't.name_canonical')}, 6) AS cosine FROM pn"))
def pair_cosine(spark, sf_dir):
    return P.paired(_rule_cands(spark, sf_dir), _norm(spark, sf_dir)).select("s1_id", "target_id", F.round(T.cosine(F.col("a.name_canonical"), F.col("t.name_canonical")), 6).alias("cosine"))


@query(sql(*STANDARD, T.TFIDF_SQL, MERGED, then="SELECT s1_id, target_id, in_standard, in_tfidf, tfidf, place FROM merged"))
def candidate_merge(spark, sf_dir):
    return _merged(spark, sf_dir).withColumn("place", F.col("place").cast("long"))


# --- features and scores ---


def _f(expr: str) -> str:
    return f"CAST(coalesce({expr}, false) AS INTEGER)::DOUBLE"


FEATURES_SQL = f"""
fp AS (SELECT m.*, a, t, (a.addr_empty OR t.addr_empty) AS gone FROM merged m JOIN norm a ON m.s1_id = a.entity_id JOIN norm t ON m.target_id = t.entity_id),
f1 AS (SELECT s1_id, target_id, in_standard, in_tfidf, tfidf,
  {_f("a.name_raw <> '' AND a.name_raw = t.name_raw")} AS name_exact_match, {_f("a.name_clean <> '' AND a.name_clean = t.name_clean")} AS name_clean_exact_match,
  {_f("a.name_canonical <> '' AND a.name_canonical = t.name_canonical")} AS name_canonical_exact_match, round({_jac('a.name_tokens', 't.name_tokens')}, 4) AS name_token_jaccard,
  len(list_intersect(a.name_tokens, t.name_tokens))::DOUBLE AS name_token_overlap_count,
  round(CASE WHEN len(a.name_tokens) = 0 OR len(t.name_tokens) = 0 THEN 0.0 ELSE len(list_intersect(a.name_tokens, t.name_tokens)) / least(len(a.name_sorted), len(t.name_sorted)) END, 4) AS name_token_containment,
  round({_lev('a.name_canonical', 't.name_canonical')}, 4) AS name_levenshtein_sim,
  round({_both('a.name_canonical', 't.name_canonical', 'least(length(a.name_canonical), length(t.name_canonical)) / greatest(length(a.name_canonical), length(t.name_canonical))')}, 4) AS name_length_ratio,
  round({_jac("list_filter(a.name_tokens, lambda x: regexp_full_match(x, '[0-9]+'))", "list_filter(t.name_tokens, lambda x: regexp_full_match(x, '[0-9]+'))")}, 4) AS name_numeric_overlap,
  round({_cosine_sql('a.name_canonical', 't.name_canonical')}, 4) AS name_char_ngram_cosine,
  CASE WHEN gone THEN 0.0 ELSE {_f("a.addr_raw = t.addr_raw")} END AS address_exact_match, CASE WHEN gone THEN 0.0 ELSE {_f("a.addr_clean <> '' AND a.addr_clean = t.addr_clean")} END AS address_clean_exact_match,
  CASE WHEN gone THEN 0.0 ELSE {_f("a.addr_canonical <> '' AND a.addr_canonical = t.addr_canonical")} END AS address_canonical_exact_match,
  CASE WHEN gone THEN 0.0 ELSE round({_jac('a.addr_tokens', 't.addr_tokens')}, 4) END AS address_token_jaccard, CASE WHEN gone THEN 0.0 ELSE len(list_intersect(a.addr_tokens, t.addr_tokens))::DOUBLE END AS address_token_overlap_count,
  CASE WHEN gone THEN 0.0 ELSE round({_lev('a.addr_canonical', 't.addr_canonical')}, 4) END AS address_levenshtein_sim, CASE WHEN gone THEN 0.0 ELSE round({_jac('a.addr_numbers', 't.addr_numbers')}, 4) END AS address_numeric_jaccard,
  CASE WHEN gone THEN 0.0 ELSE {_f(CONTRADICTS.format(a='a', b='t'))} END AS address_numeric_contradiction, CASE WHEN gone THEN 0.0 ELSE {_f("a.addr_postal = t.addr_postal")} END AS address_postal_code_match,
  {_f("gone")} AS address_is_missing, CASE WHEN gone THEN 0.0 ELSE round({_cosine_sql('a.addr_canonical', 't.addr_canonical')}, 4) END AS address_char_ngram_cosine,
  {_f("NOT (a.country_missing OR t.country_missing) AND a.country_canonical = t.country_canonical")} AS country_exact_match,
  {_f("a.country_missing OR t.country_missing OR a.country_canonical = t.country_canonical")} AS country_compatible,
  {_f("NOT (a.country_missing OR t.country_missing) AND a.country_canonical <> t.country_canonical")} AS country_contradiction, {_f("NOT (a.country_seen AND t.country_seen)")} AS has_unseen_country FROM fp),
f2 AS (SELECT *, (name_token_jaccard >= 0.70 OR name_canonical_exact_match = 1 OR name_levenshtein_sim >= 0.85) AS hn,
  (address_is_missing = 0 AND (address_token_jaccard >= 0.50 OR address_canonical_exact_match = 1 OR address_levenshtein_sim >= 0.75)) AS ha,
  CASE WHEN name_exact_match = 1 THEN 1.0 WHEN name_canonical_exact_match = 1 THEN greatest(name_token_jaccard, name_levenshtein_sim, name_char_ngram_cosine, 0.95) ELSE greatest(name_token_jaccard, name_levenshtein_sim, name_char_ngram_cosine) END AS ns,
  CASE WHEN address_exact_match = 1 THEN 1.0 WHEN address_canonical_exact_match = 1 THEN greatest(address_token_jaccard, address_levenshtein_sim, address_char_ngram_cosine, 0.95) ELSE greatest(address_token_jaccard, address_levenshtein_sim, address_char_ngram_cosine) END AS ads,
  CASE WHEN country_exact_match = 1 THEN 1.0::DOUBLE WHEN country_compatible = 1 THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END AS cs FROM f1),
feats AS (SELECT * EXCLUDE (hn, ha, ns, ads, cs), {_f("hn AND ha")} AS name_and_address_high_sim, {_f("hn AND address_numeric_contradiction = 1")} AS name_high_address_contradiction,
  {_f("(name_exact_match = 1 OR name_clean_exact_match = 1 OR name_canonical_exact_match = 1) AND country_contradiction = 1")} AS name_exact_diff_country,
  greatest(0.0, least(1.0, round((CASE WHEN address_is_missing = 1 THEN 0.85::DOUBLE * ns + 0.15::DOUBLE * cs ELSE 0.55::DOUBLE * ns + 0.35::DOUBLE * ads + 0.10::DOUBLE * cs END) * CASE WHEN country_contradiction = 1 THEN 0.15::DOUBLE ELSE 1.0::DOUBLE END * CASE WHEN address_numeric_contradiction = 1 THEN 0.30::DOUBLE ELSE 1.0::DOUBLE END, 4))) AS overall_composite_similarity,
  {_f("in_standard")} AS retrieved_by_standard, {_f("in_tfidf")} AS retrieved_by_tfidf, {_f("in_standard AND in_tfidf")} AS retrieved_by_both, tfidf AS tfidf_retrieval_score FROM f2)"""
FEATURE_PARTS = [*STANDARD, T.TFIDF_SQL, MERGED, FEATURES_SQL]
GROUPS = {"features_name": "name_", "features_address": "address_", "features_country": "country_", "features_provenance": "retriev"}


def _feature_query(name: str, columns: list[str]) -> None:
    query(sql(*FEATURE_PARTS, then=f"SELECT s1_id, target_id, {', '.join(f'{c}::DOUBLE AS {c}' for c in columns)} FROM feats"), name)(lambda spark, sf_dir: _features(spark, sf_dir, columns).select("s1_id", "target_id", *columns))


CROSS = list(P.CROSS)
for _name, _start in GROUPS.items():
    _feature_query(_name, [c for c in P.FEATURES if c.startswith(_start) and c not in CROSS or _name == "features_provenance" and c == "tfidf_retrieval_score" or _name == "features_country" and c == "has_unseen_country"])
_feature_query("features_cross", CROSS)

BASELINE_SQL = """
base AS (SELECT s1_id, target_id, CASE WHEN country_contradiction = 1 THEN 'REJECT_COUNTRY_CONTRADICTION' WHEN address_numeric_contradiction = 1 THEN 'REJECT_ADDRESS_NUMERIC_CONTRADICTION'
  WHEN (name_canonical_exact_match = 1 OR name_clean_exact_match = 1) AND (fits OR address_is_missing = 1) THEN 'RULE_EXACT_CANONICAL_WITH_COMPATIBLE_ADDRESS'
  WHEN name_and_address_high_sim = 1 THEN 'RULE_NAME_AND_ADDRESS_HIGH_SIM' WHEN overall_composite_similarity >= 0.85 THEN 'RULE_HIGH_COMPOSITE_SCORE' ELSE 'INSUFFICIENT_EVIDENCE' END AS rule, fits, overall_composite_similarity AS o
  FROM (SELECT *, address_canonical_exact_match = 1 OR address_postal_code_match = 1 OR address_token_jaccard >= 0.30 OR address_levenshtein_sim >= 0.50 AS fits FROM feats))"""


@query(sql(*FEATURE_PARTS, BASELINE_SQL, then="""SELECT s1_id, target_id, rule LIKE 'RULE%' AS is_match, rule, CASE WHEN rule LIKE 'REJECT%' THEN 0.0 WHEN rule = 'RULE_EXACT_CANONICAL_WITH_COMPATIBLE_ADDRESS' THEN CASE WHEN fits THEN 0.96 ELSE 0.88 END
  WHEN rule = 'RULE_NAME_AND_ADDRESS_HIGH_SIM' THEN 0.92 ELSE o END::DOUBLE AS confidence FROM base"""))
def baseline_decision(spark, sf_dir):
    return P.baseline(_features(spark, sf_dir))


@query(sql(*FEATURE_PARTS, then="SELECT s1_id, target_id, overall_composite_similarity::DOUBLE AS composite FROM feats WHERE country_contradiction = 0 AND address_numeric_contradiction = 0"))
def veto_filter(spark, sf_dir):
    return _features(spark, sf_dir).where("country_contradiction = 0 and address_numeric_contradiction = 0").select("s1_id", "target_id", F.col("overall_composite_similarity").alias("composite"))


SCORE_SQL = f"""
q0 AS (SELECT r.s1_id, r.target_id, r.cand_ord, a, t, list_distinct(list_filter(a.name_tokens, lambda v: length(v) >= 2)) AS an, list_distinct(list_filter(t.name_tokens, lambda v: length(v) >= 2)) AS tn,
  list_distinct(list_filter(a.addr_tokens, lambda v: length(v) >= 2)) AS aa, list_distinct(list_filter(t.addr_tokens, lambda v: length(v) >= 2)) AS ta, a.addr_numbers AS x, t.addr_numbers AS y, a.name_canonical AS ac, t.name_canonical AS tc,
  array_to_string(a.name_tokens, '') AS aj, array_to_string(t.name_tokens, '') AS tj, coalesce(a.addr_postal, '') AS ap, coalesce(t.addr_postal, '') AS tp, {NEAR.format(a='a', b='t')} AS near_num
  FROM rcands r JOIN norm a ON r.s1_id = a.entity_id JOIN norm t ON r.target_id = t.entity_id),
q1 AS (SELECT *, len(x) > 0 AND len(y) > 0 AS both_num, len(list_intersect(x, y)) > 0 AS common, {_jac('an', 'tn')} AS jac, len(list_intersect(an, tn)) AS over, least(len(an), len(tn)) AS lo, greatest(len(an), len(tn)) AS hi, {_jac('aa', 'ta')} AS s, ac <> '' AND tc <> '' AS named, ap <> '' AND ap = tp AS postal FROM q0),
q2 AS (SELECT *, lo >= 2 AND over = lo AS subset,
  (a.country_canonical <> '' AND t.country_canonical <> '' AND a.country_canonical <> t.country_canonical) OR CASE WHEN both_num AND common THEN len(x) >= 2 AND len(y) >= 2 AND ((x[1] <> y[1] AND NOT list_contains(y, x[1]) AND NOT list_contains(x, y[1])) OR (x[-1] <> y[-1] AND NOT list_contains(y, x[-1]) AND NOT list_contains(x, y[-1]))) WHEN both_num THEN NOT near_num ELSE false END AS veto FROM q1),
q3 AS (SELECT *, CASE WHEN named AND ac = tc THEN 1.0 WHEN len(an) > 0 AND tc <> '' AND len(tn) > 0 THEN CASE WHEN subset AND jac < 0.85 THEN greatest(jac, 0.70::DOUBLE + 0.20::DOUBLE * (lo / hi)) ELSE jac END ELSE 0.0 END AS n1 FROM q2),
q4 AS (SELECT *, CASE WHEN n1 < 0.85 AND named THEN CASE WHEN aj <> '' AND (aj = replace(tc, ' ', '') OR tj = replace(ac, ' ', '') OR aj = tj) THEN greatest(n1, 0.95) WHEN length(ac) >= 8 AND length(tc) >= 8 AND (contains(tc, ac) OR contains(ac, tc)) THEN greatest(n1, 0.90) ELSE n1 END ELSE n1 END AS n FROM q3),
q5 AS (SELECT *, CASE WHEN n >= 0.85 THEN CASE WHEN s >= 0.20 THEN 0.60::DOUBLE * n + 0.40::DOUBLE * s WHEN len(ta) = 0 THEN 0.55::DOUBLE * n ELSE 0.40::DOUBLE * n END WHEN n >= 0.65 THEN CASE WHEN s >= 0.30 THEN 0.50::DOUBLE * n + 0.50::DOUBLE * s WHEN len(ta) = 0 THEN 0.45::DOUBLE * n ELSE 0.35::DOUBLE * n END
  WHEN n >= 0.50 AND s >= 0.40 THEN 0.45::DOUBLE * n + 0.55::DOUBLE * s ELSE 0.0 END AS mixed, s >= 0.82 AND len(ta) > 0 AND len(aa) > 0 AND over >= 1 AS by_address FROM q4),
scored AS (SELECT s1_id, target_id, cand_ord, CASE WHEN veto THEN 0.0 WHEN n < 0.45 AND by_address THEN 0.585 WHEN n < 0.45 THEN 0.0 WHEN mixed >= 0.58 THEN mixed WHEN named AND ac = tc AND length(ac) >= 10 AND postal AND length(ap) >= 5 THEN 0.59
  WHEN both_num AND common AND postal AND subset THEN 0.585 WHEN len(an) >= 3 AND len(an) = len(tn) AND over = len(an) AND postal THEN 0.585 WHEN mixed >= 0.56 AND mixed < 0.58 AND len(ta) > 0 AND s >= 0.15 THEN 0.5801::DOUBLE + (mixed - 0.56::DOUBLE) * 0.1::DOUBLE
  WHEN by_address THEN 0.585 WHEN postal AND length(ap) >= 5 AND jac >= 0.80 THEN 0.585 ELSE 0.0 END::DOUBLE AS score FROM q5)"""
MATCHES_SQL = "matches AS (SELECT s1_id, target_id, score, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_ord) AS rank FROM scored WHERE score >= 0.58 QUALIFY rank <= 8)"
SCORED = [*RULES, SCORE_SQL]
MATCHED = [*SCORED, MATCHES_SQL, B.TRUTH_SQL, "anchors AS (SELECT entity_id AS s1_id FROM ent WHERE src = 'S1')"]


@query(sql(*SCORED, then="SELECT s1_id, target_id, round(score, 9) AS score FROM scored"))
def rule_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("s1_id", "target_id", F.round("score", 9).alias("score"))


@query(sql(*MATCHED, then="SELECT s1_id, target_id, round(score, 9) AS score, rank FROM matches"))
def match_topk(spark, sf_dir):
    return _matches(spark, sf_dir).select("s1_id", "target_id", F.round("score", 9).alias("score"), F.col("rank").cast("long").alias("rank"))


@query()
def rule_score_fuzzy(spark, sf_dir):
    """With the character ratio, which SQL doesn't have."""
    return _scored(spark, sf_dir, fuzzy=True).select("s1_id", "target_id", "score")


# --- metrics ---

F05 = "CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25::DOUBLE * (tp / n_pred) * (tp / n_true) / (0.25::DOUBLE * (tp / n_pred) + (tp / n_true)) END"
ENTITY_SQL = f"""
es0 AS (SELECT s1_id, (SELECT count(DISTINCT target_id) FROM truth t WHERE t.s1_id = a.s1_id) AS n_true, (SELECT count(DISTINCT target_id) FROM matches m WHERE m.s1_id = a.s1_id) AS n_pred,
  (SELECT count(DISTINCT t.target_id) FROM truth t JOIN matches m ON t.s1_id = m.s1_id AND t.target_id = m.target_id WHERE t.s1_id = a.s1_id) AS tp FROM anchors a),
es AS (SELECT *, n_true = 0 AS is_singleton, n_pred - tp AS fp, n_true - tp AS fn, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE tp / n_pred END AS precision,
  CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE tp / n_true END AS recall, {F05} AS f05 FROM es0)"""
EVALUATED = [*MATCHED, ENTITY_SQL]


def _entity_scores(spark, sf_dir):
    return E.entity_scores(_anchors(spark, sf_dir), _truth(spark, sf_dir), _matches(spark, sf_dir))


@query(sql(*EVALUATED, then="SELECT s1_id, is_singleton, n_true, n_pred, tp, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f05, 9) AS f05 FROM es"))
def entity_f05(spark, sf_dir):
    return _entity_scores(spark, sf_dir).select("s1_id", "is_singleton", "n_true", "n_pred", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f05")])


@query(sql(*EVALUATED, then="""SELECT count(*) AS anchors, count(*) FILTER (WHERE is_singleton) AS singletons, count(*) FILTER (WHERE NOT is_singleton) AS matched, round(avg(f05), 9) AS macro_f05, round(avg(precision), 9) AS mean_precision, round(avg(recall), 9) AS mean_recall,
  round(coalesce(avg(f05) FILTER (WHERE is_singleton), 0), 9) AS singleton_f05, round(coalesce(avg(f05) FILTER (WHERE NOT is_singleton), 0), 9) AS matched_f05, count(*) FILTER (WHERE f05 >= 0.999999) AS perfect, count(*) FILTER (WHERE f05 <= 1e-6) AS zero FROM es"""))
def macro_f05(spark, sf_dir):
    return E.macro(_entity_scores(spark, sf_dir))


MICRO_COLUMNS = """sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round(coalesce(sum(tp) / nullif(sum(tp) + sum(fp), 0), 0), 9) AS precision, round(coalesce(sum(tp) / nullif(sum(tp) + sum(fn), 0), 0), 9) AS recall,
  round(coalesce(2 * (sum(tp) / nullif(sum(tp) + sum(fp), 0)) * (sum(tp) / nullif(sum(tp) + sum(fn), 0)) / nullif((sum(tp) / nullif(sum(tp) + sum(fp), 0)) + (sum(tp) / nullif(sum(tp) + sum(fn), 0)), 0), 0), 9) AS f1,
  round(coalesce(1.25::DOUBLE * (sum(tp) / nullif(sum(tp) + sum(fp), 0)) * (sum(tp) / nullif(sum(tp) + sum(fn), 0)) / nullif(0.25::DOUBLE * (sum(tp) / nullif(sum(tp) + sum(fp), 0)) + (sum(tp) / nullif(sum(tp) + sum(fn), 0)), 0), 0), 9) AS f05"""


@query(sql(*EVALUATED, then=f"SELECT {MICRO_COLUMNS} FROM es"))
def micro_f05(spark, sf_dir):
    return E.micro(_entity_scores(spark, sf_dir))


@query(sql(*EVALUATED, then=f"SELECT country_canonical AS country, {MICRO_COLUMNS} FROM es JOIN norm ON s1_id = entity_id GROUP BY 1"))
def country_breakdown(spark, sf_dir):
    countries = _norm(spark, sf_dir).select(F.col("entity_id").alias("s1_id"), F.col("country_canonical").alias("country"))
    return E.micro(_entity_scores(spark, sf_dir).join(countries, "s1_id"), ["country"])


CURVE_SQL = f"""
grid AS (SELECT unnest([{", ".join(f"{t}::DOUBLE" for t in E.TAUS)}]) AS tau),
rk AS (SELECT s1_id, target_id, score, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_ord) AS rank FROM scored QUALIFY rank <= 8),
cv0 AS (SELECT tau, s1_id, (SELECT count(*) FROM truth t WHERE t.s1_id = a.s1_id) AS n_true, (SELECT count(*) FROM rk WHERE rk.s1_id = a.s1_id AND score >= tau) AS n_pred,
  (SELECT count(*) FROM rk JOIN truth t ON t.s1_id = rk.s1_id AND t.target_id = rk.target_id WHERE rk.s1_id = a.s1_id AND score >= tau) AS tp FROM grid, anchors a),
curve AS (SELECT tau, round(avg({F05}), 9) AS macro_f05, sum(n_pred)::BIGINT AS matches FROM cv0 GROUP BY tau)"""


@query(sql(*MATCHED, CURVE_SQL, then="SELECT tau, macro_f05, matches FROM curve"))
def threshold_curve(spark, sf_dir):
    return E.threshold_curve(_anchors(spark, sf_dir), _truth(spark, sf_dir), _scored(spark, sf_dir))


@query(sql(*MATCHED, CURVE_SQL, then="SELECT tau, macro_f05, matches FROM curve ORDER BY macro_f05 DESC, tau LIMIT 1"))
def threshold_best(spark, sf_dir):
    return E.best_threshold(E.threshold_curve(_anchors(spark, sf_dir), _truth(spark, sf_dir), _scored(spark, sf_dir)))


@query(sql(*SCORED, B.TRUTH_SQL, then="""SELECT cap, count(*) FILTER (WHERE n > cap) AS truncated_anchors, coalesce(sum(greatest(n - cap, 0)), 0)::BIGINT AS truncated_matches FROM (SELECT unnest([1, 2, 8, 16, 32, 64]) AS cap),
  (SELECT s1_id, count(*) AS n FROM scored WHERE score >= 0.4 GROUP BY 1) GROUP BY cap"""))
def cap_audit(spark, sf_dir):
    n = _scored(spark, sf_dir).where("score >= 0.4").groupBy("s1_id").agg(F.count("*").alias("n"))
    caps = spark.createDataFrame([(c,) for c in (1, 2, *E.CAPS)], "cap int")
    return n.crossJoin(F.broadcast(caps)).groupBy("cap").agg(F.count_if(F.col("n") > F.col("cap")).alias("truncated_anchors"), F.sum(F.greatest(F.col("n") - F.col("cap"), F.lit(0).cast("long"))).alias("truncated_matches"))


# --- audits ---

CANDS = [*MATCHED, "cands AS (SELECT s1_id, target_id FROM rcands)"]
OUTCOMES_SQL = """
oc0 AS (SELECT s1_id, target_id, max(t) AS t, max(p) AS p, max(c) AS c FROM (SELECT s1_id, target_id, 1 AS t, 0 AS p, 0 AS c FROM truth UNION ALL SELECT s1_id, target_id, 0, 1, 0 FROM matches UNION ALL SELECT s1_id, target_id, 0, 0, 1 FROM cands) GROUP BY ALL),
oc AS (SELECT *, sum(t) OVER (PARTITION BY s1_id) AS n_true, sum(p) OVER (PARTITION BY s1_id) AS n_pred, sum(t * c) OVER (PARTITION BY s1_id) AS n_hit, sum(t * p) OVER (PARTITION BY s1_id) AS n_tp FROM oc0)"""


def _outcomes(spark, sf_dir):
    return E.pair_outcomes(_anchors(spark, sf_dir), _truth(spark, sf_dir), _matches(spark, sf_dir), _rule_cands(spark, sf_dir))


@query(sql(*CANDS, OUTCOMES_SQL, then="""SELECT s1_id, target_id, CASE WHEN t = 0 AND n_true = 0 THEN 'SINGLETON_FALSE_MERGE' WHEN t = 0 THEN 'MODEL_FALSE_POSITIVE' WHEN c = 0 THEN 'BLOCKING_MISS' ELSE 'MODEL_FALSE_NEGATIVE' END AS error_type
  FROM oc WHERE NOT (n_true = n_tp AND n_pred = n_tp) AND t <> p AND NOT (t = 1 AND c = 1 AND n_pred = 0)
  UNION ALL SELECT DISTINCT s1_id, NULL, 'SINGLETON_FALSE_DISMISSAL' FROM oc WHERE n_true > 0 AND n_pred = 0 AND n_hit > 0"""))
def error_taxonomy(spark, sf_dir):
    return E.error_records(_outcomes(spark, sf_dir))


@query(sql(*CANDS, OUTCOMES_SQL, then="""SELECT CASE WHEN t = 0 AND n_true = 0 THEN 'SINGLETON_FALSE_MERGE' WHEN t = 0 THEN 'FALSE_MERGE' WHEN c = 0 THEN 'BLOCKING' WHEN coalesce(score, 0) = 0 THEN 'FEATURE' WHEN score < 0.45 THEN 'MODEL' WHEN score < 0.58 THEN 'THRESHOLD'
  ELSE 'MULTI_MATCH_TRUNCATION' END AS cause, count(*) AS n FROM oc LEFT JOIN scored USING (s1_id, target_id) WHERE t <> p GROUP BY 1"""))
def root_cause(spark, sf_dir):
    return E.root_causes(_outcomes(spark, sf_dir), _scored(spark, sf_dir), P.TAU)


@query(sql(*MATCHED, *STANDARD, T.TFIDF_SQL, MERGED, FEATURES_SQL, then="""SELECT CASE WHEN m.s1_id IS NOT NULL THEN 'SUCCESS' WHEN c.s1_id IS NULL THEN 'RETRIEVAL_MISS' WHEN country_contradiction = 1 THEN 'COUNTRY_VETO' WHEN address_numeric_contradiction = 1 THEN 'BUILDING_NUM_VETO'
  WHEN coalesce(s.score, 0) < 0.58 THEN 'BELOW_THRESHOLD' ELSE 'MATCH_CAP_EXCLUDED' END AS stage, count(*) AS n FROM truth t LEFT JOIN rcands c USING (s1_id, target_id) LEFT JOIN feats f USING (s1_id, target_id) LEFT JOIN scored s USING (s1_id, target_id) LEFT JOIN matches m USING (s1_id, target_id) GROUP BY 1"""))
def fn_stage_map(spark, sf_dir):
    return E.stage_map(_truth(spark, sf_dir), _rule_cands(spark, sf_dir), _features(spark, sf_dir, ["country_contradiction", "address_numeric_contradiction"]), _scored(spark, sf_dir), _matches(spark, sf_dir), P.TAU)


@query(sql(*RULES, B.TRUTH_SQL, then="""SELECT count(*) AS anchors, sum(n_true)::BIGINT AS true_pairs, sum(n_hit)::BIGINT AS found_pairs, round(sum(n_hit) / sum(n_true), 9) AS recall,
  round(count(*) FILTER (WHERE n_true > 0 AND n_hit = n_true) / count(*) FILTER (WHERE n_true > 0), 9) AS full_rate, round(count(*) FILTER (WHERE n_hit > 0 AND n_hit < n_true) / count(*) FILTER (WHERE n_true > 0), 9) AS partial_rate,
  round(count(*) FILTER (WHERE n_true > 0 AND n_hit = 0) / count(*) FILTER (WHERE n_true > 0), 9) AS zero_rate, round(avg(k), 9) AS mean_candidates, list_sort(list(k))[(floor(count(*) * 0.5) + 1)::INT] AS median_candidates,
  list_sort(list(k))[(floor(count(*) * 0.9) + 1)::INT] AS p90_candidates, max(k) AS max_candidates, round(1 - sum(k) / (count(*) * 10000000.0::DOUBLE), 12) AS reduction_ratio
  FROM (SELECT entity_id, (SELECT count(*) FROM rcands c WHERE c.s1_id = e.entity_id) AS k, (SELECT count(*) FROM truth t WHERE t.s1_id = e.entity_id) AS n_true, (SELECT count(*) FROM truth t JOIN rcands c USING (s1_id, target_id) WHERE t.s1_id = e.entity_id) AS n_hit FROM ent e WHERE src = 'S1')"""))
def recall_audit(spark, sf_dir):
    return E.recall_audit(_anchors(spark, sf_dir), _truth(spark, sf_dir), _rule_cands(spark, sf_dir))


@query(sql(*STANDARD, B.TRUTH_SQL, then="""SELECT count(*) AS anchors, sum(k)::BIGINT AS pairs, round(avg(k), 9) AS mean_candidates, max(k) AS max_candidates, count(*) FILTER (WHERE k = 0) AS zero_anchors,
  round((SELECT count(*) FROM truth JOIN scands USING (s1_id, target_id)) / (SELECT count(*) FROM truth), 9) AS recall FROM (SELECT e.entity_id, count(c.target_id) AS k FROM ent e LEFT JOIN scands c ON c.s1_id = e.entity_id WHERE e.src = 'S1' GROUP BY 1)"""))
def blocking_audit(spark, sf_dir):
    audit = E.recall_audit(_anchors(spark, sf_dir), _truth(spark, sf_dir), _standard_cands(spark, sf_dir))
    k = _anchors(spark, sf_dir).join(_standard_cands(spark, sf_dir).groupBy("s1_id").agg(F.count("*").alias("k")), "s1_id", "left").fillna(0)
    return audit.select("anchors", "mean_candidates", "max_candidates", "recall").crossJoin(k.agg(F.sum("k").alias("pairs"), F.count_if(F.col("k") == 0).alias("zero_anchors")))


@query(sql(*STANDARD, T.TFIDF_SQL, MERGED, B.TRUTH_SQL, then="""SELECT count(*) AS pairs, count(*) FILTER (WHERE in_standard AND NOT in_tfidf) AS standard_only, count(*) FILTER (WHERE in_tfidf AND NOT in_standard) AS tfidf_only,
  count(*) FILTER (WHERE in_standard AND in_tfidf) AS both, count(t.s1_id) AS true_found FROM merged LEFT JOIN truth t USING (s1_id, target_id)"""))
def multipass_audit(spark, sf_dir):
    return E.multipass_audit(_merged(spark, sf_dir), entities(spark, sf_dir))


@query(sql(*SCORED, then="SELECT CASE WHEN score = 0 THEN '0 zero' WHEN score < 0.3 THEN '1 under .30' WHEN score < 0.5 THEN '2 under .50' WHEN score < 0.58 THEN '3 under tau' ELSE '4 from tau' END AS bucket, count(*) AS n FROM scored GROUP BY 1"))
def score_histogram(spark, sf_dir):
    s = F.col("score")
    bucket = F.when(s == 0, "0 zero").when(s < 0.3, "1 under .30").when(s < 0.5, "2 under .50").when(s < 0.58, "3 under tau").otherwise("4 from tau")
    return _scored(spark, sf_dir).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(sql(*SCORED, B.TRUTH_SQL, then="SELECT t.s1_id IS NOT NULL AS is_true, count(*) AS n, round(min(score), 9) AS lowest, round(quantile_cont(score, 0.05), 9) AS p05, round(avg(score), 9) AS mean, round(quantile_cont(score, 0.95), 9) AS p95, round(max(score), 9) AS highest FROM scored LEFT JOIN truth t USING (s1_id, target_id) GROUP BY 1"))
def score_separation(spark, sf_dir):
    x = _scored(spark, sf_dir).join(_truth(spark, sf_dir).withColumn("t", F.lit(1)), ["s1_id", "target_id"], "left")
    r = lambda c, name: F.round(c, 9).alias(name)
    return x.groupBy(F.col("t").isNotNull().alias("is_true")).agg(F.count("*").alias("n"), r(F.min("score"), "lowest"), r(F.percentile("score", 0.05), "p05"), r(F.avg("score"), "mean"), r(F.percentile("score", 0.95), "p95"), r(F.max("score"), "highest"))


# --- outputs ---


@query(sql(*MATCHED, then="SELECT s1_id AS source1_entity_id, coalesce(string_agg(target_id, ',' ORDER BY rank), '') AS matched_entity_ids FROM anchors LEFT JOIN matches USING (s1_id) GROUP BY s1_id"))
def matching_rows(spark, sf_dir):
    lists = E.listed(_matches(spark, sf_dir), "ids", "rank")
    return _anchors(spark, sf_dir).join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(F.array_join("ids", ","), F.lit("")).alias("matched_entity_ids"))


@query(sql(*RULES, "anchors AS (SELECT entity_id AS s1_id FROM ent WHERE src = 'S1')", then="SELECT s1_id AS source1_entity_id, coalesce(string_agg(target_id, ',' ORDER BY cand_ord), '') AS candidate_entity_ids FROM anchors LEFT JOIN rcands USING (s1_id) GROUP BY s1_id"))
def candidate_rows(spark, sf_dir):
    lists = E.listed(_rule_cands(spark, sf_dir), "ids", "cand_ord")
    return _anchors(spark, sf_dir).join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(F.array_join("ids", ","), F.lit("")).alias("candidate_entity_ids"))


@query(sql(*MATCHED, then="""SELECT s1_id, target_id, place FROM (SELECT s1_id, target_id, row_number() OVER (PARTITION BY s1_id ORDER BY kind, o, target_id) AS place, sum(1 - kind) OVER (PARTITION BY s1_id) AS n FROM
  (SELECT s1_id, target_id, min(kind) AS kind, arg_min(o, kind) AS o FROM (SELECT s1_id, target_id, 0 AS kind, rank AS o FROM matches UNION ALL SELECT s1_id, target_id, 1, cand_ord FROM rcands) GROUP BY ALL)) WHERE place <= greatest(5, n)"""))
def prune_candidates(spark, sf_dir):
    return E.prune(_matches(spark, sf_dir), _rule_cands(spark, sf_dir), 5).withColumn("place", F.col("place").cast("long"))


@query(sql(*FEATURE_PARTS, *MATCHED[:1], then="SELECT f.s1_id, f.target_id FROM feats f WHERE overall_composite_similarity >= 0.3 AND NOT EXISTS (SELECT 1 FROM scands s WHERE s.s1_id = f.s1_id AND s.target_id = f.target_id)"))
def subset_violations(spark, sf_dir):
    """Pairs that a looser decision would output though one pass alone never proposed them. The merged candidates say which those are,
    so only they get features."""
    norm = T.cut(_norm(spark, sf_dir))
    alone = _merged(spark, sf_dir, norm).where("not in_standard")
    return P.at_least(alone, norm, 0.3)


@query(sql(*MATCHED, *STANDARD, then="""SELECT * FROM (SELECT 'UNKNOWN_ANCHOR' AS rule, count(*) AS n FROM matches WHERE s1_id NOT IN (SELECT s1_id FROM anchors) UNION ALL SELECT 'UNKNOWN_TARGET', count(*) FROM matches WHERE target_id NOT IN (SELECT entity_id FROM ent WHERE src <> 'S1')
  UNION ALL SELECT 'MATCH_NOT_A_CANDIDATE', count(*) FROM matches m WHERE NOT EXISTS (SELECT 1 FROM scands s WHERE s.s1_id = m.s1_id AND s.target_id = m.target_id)
  UNION ALL SELECT 'ANCHOR_WITHOUT_CANDIDATES', count(*) FROM anchors WHERE s1_id NOT IN (SELECT s1_id FROM scands)) WHERE n > 0"""))
def contract_report(spark, sf_dir):
    targets = entities(spark, sf_dir).where("src <> 'S1'").select(F.col("entity_id").alias("target_id"))
    return C.contract(_anchors(spark, sf_dir), targets, _matches(spark, sf_dir), _standard_cands(spark, sf_dir))


@query(sql(*MATCHED, "ma AS (SELECT s1_id, list(target_id) AS x FROM rk GROUP BY 1), mb AS (SELECT s1_id, list(target_id) AS x FROM rk WHERE score >= 0.58 GROUP BY 1)".replace("FROM rk", "FROM (SELECT s1_id, target_id, score FROM scored WHERE score >= 0.4 QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_ord) <= 8)"),
           then="SELECT count(*) FILTER (WHERE a.x IS NOT NULL AND b.x IS NOT NULL) AS both, count(*) FILTER (WHERE list_sort(a.x) <> list_sort(b.x)) AS changed, count(*) FILTER (WHERE b.x IS NULL) AS only_old, count(*) FILTER (WHERE a.x IS NULL) AS only_new, coalesce(sum(len(a.x)), 0)::BIGINT AS old_targets, coalesce(sum(len(b.x)), 0)::BIGINT AS new_targets FROM ma a FULL JOIN mb b USING (s1_id)"))
def output_diff(spark, sf_dir):
    return E.output_diff(E.listed(_matches(spark, sf_dir, 0.4), "ids"), E.listed(_matches(spark, sf_dir, 0.58), "ids"), "ids")


@query(sql(*MATCHED, then="""SELECT count(*) AS anchors, count(*) FILTER (WHERE m = 0) AS singletons, count(*) FILTER (WHERE m > 0) AS matched, sum(c)::BIGINT AS candidate_pairs, sum(m)::BIGINT AS matches, round(avg(c), 9) AS mean_candidates, round(avg(m), 9) AS mean_matches
  FROM (SELECT s1_id, (SELECT count(*) FROM rcands r WHERE r.s1_id = a.s1_id) AS c, (SELECT count(*) FROM matches x WHERE x.s1_id = a.s1_id) AS m FROM anchors a)"""))
def inference_stats(spark, sf_dir):
    n = lambda df, name: df.groupBy("s1_id").agg(F.count("*").alias(name))
    e = _anchors(spark, sf_dir).join(n(_rule_cands(spark, sf_dir), "c"), "s1_id", "left").join(n(_matches(spark, sf_dir), "m"), "s1_id", "left").fillna(0)
    return e.agg(F.count("*").alias("anchors"), F.count_if(F.col("m") == 0).alias("singletons"), F.count_if(F.col("m") > 0).alias("matched"), F.sum("c").alias("candidate_pairs"), F.sum("m").alias("matches"), F.round(F.avg("c"), 9).alias("mean_candidates"), F.round(F.avg("m"), 9).alias("mean_matches"))


# --- validation, profiles, browsing ---


@query(f"""WITH {ENTITIES_SQL}, v AS (SELECT src, entity_id, business_name, business_address, country FROM ent UNION ALL SELECT src, entity_id, business_name, business_address, country FROM ent WHERE num % 50 = 0)
  SELECT src, 'DUPLICATE_ID' AS rule, count(*) AS n FROM (SELECT src, entity_id FROM v GROUP BY ALL HAVING count(*) > 1) GROUP BY 1 UNION ALL SELECT src, 'MISSING_ADDRESS', count(*) FROM v WHERE lower(business_address) IN ('', 'n/a') GROUP BY 1
  UNION ALL SELECT src, 'MISSING_COUNTRY', count(*) FROM v WHERE lower(country) IN ('', 'null') GROUP BY 1 UNION ALL SELECT src, 'MISSING_NAME', count(*) FROM v WHERE trim(business_name) = '' GROUP BY 1""")
def validation_report(spark, sf_dir):
    """Over the entity view with every fiftieth row twice."""
    ent = entities(spark, sf_dir)
    return C.validation(ent.unionByName(ent.where("num % 50 = 0")))


LINES_SQL = r"""
ln AS (SELECT CASE num % 10 WHEN 1 THEN entity_id || chr(9) || business_name WHEN 2 THEN 'X' || entity_id || chr(9) || business_name || chr(9) || business_address || chr(9) || country WHEN 3 THEN '' ELSE '  ' || entity_id || chr(9) || business_name || ' ' || chr(9) || business_address || chr(9) || country END AS value FROM ent),
lc AS (SELECT value, string_split(value, chr(9)) AS x FROM ln WHERE trim(value) <> ''),
lf AS (SELECT value, len(x) AS n, list_transform(x, lambda c: CASE WHEN lower(trim(c)) IN ('nan', 'null', 'none', 'n/a', 'na', '#n/a', '<na>') THEN '' ELSE trim(c) END) AS c FROM lc),
lr AS (SELECT c[1] AS entity_id, coalesce(c[2], '') AS business_name, coalesce(c[3], '') AS business_address, coalesce(c[4], '') AS country, CASE WHEN n <> 4 THEN 'COLUMN_COUNT' WHEN NOT regexp_matches(c[1], '^(S[123])-(\d+)$') THEN 'ID_FORM' WHEN lower(c[2]) = 'undefined' THEN 'NAME_MISSING' WHEN c[4] = '' THEN 'COUNTRY_MISSING' END AS reason FROM lf)"""


def _checked_lines(spark, sf_dir):
    from ..sources.entities import check_lines

    e = entities(spark, sf_dir)
    row = lambda first, name: F.concat_ws("\t", first, name, "business_address", "country")
    m = F.col("num") % 10
    value = F.when(m == 1, F.concat_ws("\t", "entity_id", "business_name")).when(m == 2, row(F.concat(F.lit("X"), "entity_id"), F.col("business_name"))).when(m == 3, F.lit("")).otherwise(row(F.concat(F.lit("  "), "entity_id"), F.concat("business_name", F.lit(" "))))
    return check_lines(e.select(value.alias("value")))


@query(f"WITH {ENTITIES_SQL}, {LINES_SQL} SELECT entity_id, business_name, business_address, country, reason FROM lr")
def ingest_quarantine(spark, sf_dir):
    return _checked_lines(spark, sf_dir).select("entity_id", "business_name", "business_address", "country", "reason")


@query(f"WITH {ENTITIES_SQL}, {LINES_SQL} SELECT count(*) AS lines, count(*) FILTER (WHERE reason IS NULL) AS valid, count(reason) AS quarantined, count(*) FILTER (WHERE reason IS NULL AND business_name = '') AS empty_names, count(*) FILTER (WHERE reason IS NULL AND business_address = '') AS missing_addresses FROM lr")
def ingest_stats(spark, sf_dir):
    good = F.col("reason").isNull()
    return _checked_lines(spark, sf_dir).agg(F.count("*").alias("lines"), F.count_if(good).alias("valid"), F.count("reason").alias("quarantined"), F.count_if(good & (F.col("business_name") == "")).alias("empty_names"), F.count_if(good & (F.col("business_address") == "")).alias("missing_addresses"))


@query("SELECT count(*) AS orphans, count(DISTINCT doc_id) AS orphan_ids FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def referential_orphans(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    return d.agg(F.count("*").alias("orphans"), F.countDistinct("doc_id").alias("orphan_ids"))


@query("SELECT count(*) AS shared FROM (SELECT md5(text) FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT md5(text) FROM documents WHERE doc_id % 2 = 1)")
def split_overlap(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode("text", "utf-8")).alias("m"))
    return d.where("doc_id % 2 = 0").select("m").intersect(d.where("doc_id % 2 = 1").select("m")).agg(F.count("*").alias("shared"))


@query(rf"""WITH {ENTITIES_SQL} SELECT src, count(*) AS rows, min(length(business_name)) AS min_chars, max(length(business_name)) AS max_chars, round(avg(length(business_name)), 6) AS mean_chars, round(avg(len(list_filter(regexp_split_to_array(business_name, '\s+'), lambda x: x <> ''))), 6) AS mean_tokens,
  count(*) FILTER (WHERE regexp_matches(business_name, '[0-9]')) AS digits, count(*) FILTER (WHERE regexp_matches(business_name, '[\x{{900}}-\x{{97F}}]')) AS devanagari, count(*) FILTER (WHERE regexp_matches(business_name, '[\x{{B80}}-\x{{BFF}}]')) AS tamil,
  count(*) FILTER (WHERE regexp_matches(business_name, '[^\x00-\x7F]')) AS non_ascii, count(*) FILTER (WHERE regexp_matches(lower(business_name), '{C.URL_START}') OR regexp_matches(lower(business_name), '{C.URL_END}')) AS urls,
  round(100 * count(*) FILTER (WHERE business_address IN ('', 'N/A')) / count(*), 6) AS missing_address_pct FROM ent GROUP BY src""")
def source_profile(spark, sf_dir):
    return C.source_profile(entities(spark, sf_dir))


@query(sql(B.TRUTH_SQL, then="""SELECT count(*) AS anchors, count(*) FILTER (WHERE n = 0) AS singletons, count(*) FILTER (WHERE n = 1) AS single, count(*) FILTER (WHERE n >= 2) AS multi, sum(n2)::BIGINT AS s2_targets, sum(n3)::BIGINT AS s3_targets, round(avg(n), 9) AS mean_targets, max(n) AS max_targets,
  count(*) FILTER (WHERE n2 > 0 AND n3 = 0) AS s2_only, count(*) FILTER (WHERE n3 > 0 AND n2 = 0) AS s3_only, count(*) FILTER (WHERE n2 > 0 AND n3 > 0) AS both, (SELECT count(DISTINCT target_id) FROM truth) AS distinct_targets
  FROM (SELECT e.entity_id, count(t.target_id) AS n, count(*) FILTER (WHERE t.target_id LIKE 'S2-%') AS n2, count(*) FILTER (WHERE t.target_id LIKE 'S3-%') AS n3 FROM ent e LEFT JOIN truth t ON t.s1_id = e.entity_id WHERE e.src = 'S1' GROUP BY 1)"""))
def gt_profile(spark, sf_dir):
    return C.truth_profile(_anchors(spark, sf_dir), _truth(spark, sf_dir))


@query(f"WITH {ENTITIES_SQL} SELECT src, country, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (PARTITION BY src), 6) AS pct FROM ent GROUP BY src, country")
def country_share(spark, sf_dir):
    return C.country_share(entities(spark, sf_dir))


@query(f"""WITH {ENTITIES_SQL}, l AS (SELECT *, length(business_name) AS len FROM ent) SELECT src, count(*) AS rows, round(avg(len), 6) AS mean_len, list_sort(list(len))[(floor(count(*) * 0.5) + 1)::INT] AS median_len, list_sort(list(len))[(floor(count(*) * 0.95) + 1)::INT] AS p95_len,
  round((count(*) - count(DISTINCT business_name)) / count(*), 9) AS repeat_rate FROM l GROUP BY src""")
def shift_report(spark, sf_dir):
    return C.shift_report(entities(spark, sf_dir))


def _top_sql(col, words):
    return f"WITH {ENTITIES_SQL} SELECT word, count(*) AS n FROM (SELECT unnest([{', '.join(repr(w) for w in words)}]) AS word), ent WHERE contains(lower({col}), word) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"


@query(_top_sql("business_address", C.KEYWORDS))
def top_keywords(spark, sf_dir):
    return C.substring_counts(entities(spark, sf_dir), "business_address", C.KEYWORDS)


@query(_top_sql("business_name", list(C.LEGAL_FORMS)))
def top_legal_forms(spark, sf_dir):
    return C.top_legal_forms(entities(spark, sf_dir))


@query(sql(B.TRUTH_SQL, then=f"""SELECT substr(t.target_id, 1, 2) AS target_src, count(*) AS pairs, count(*) FILTER (WHERE a.name_raw = b.name_raw) AS exact_raw, count(*) FILTER (WHERE a.name_canonical = b.name_canonical) AS exact_canonical, round(avg({_jac('a.name_tokens', 'b.name_tokens')}), 9) AS mean_jaccard,
  count(*) FILTER (WHERE regexp_matches(b.name_raw, '[^\\x00-\\x7F]')) AS non_ascii, count(*) FILTER (WHERE len(a.addr_numbers) > 0 AND len(b.addr_numbers) > 0 AND len(list_intersect(a.addr_numbers, b.addr_numbers)) > 0) AS numbers_match,
  count(*) FILTER (WHERE len(a.addr_numbers) > 0 AND len(b.addr_numbers) > 0 AND len(list_intersect(a.addr_numbers, b.addr_numbers)) = 0) AS numbers_conflict, count(*) FILTER (WHERE len(a.addr_numbers) = 0 OR len(b.addr_numbers) = 0) AS numbers_na
  FROM truth t JOIN norm a ON a.entity_id = t.s1_id JOIN norm b ON b.entity_id = t.target_id GROUP BY 1"""))
def link_transformations(spark, sf_dir):
    return C.link_transformations(P.paired(_truth(spark, sf_dir), _norm(spark, sf_dir)))


@query(f"WITH {ENTITIES_SQL} SELECT entity_id, business_name, country FROM ent WHERE contains(lower(business_name), 'th') AND contains(lower(business_address), 'src1') AND lower(country) = 'u.s.a.'")
def browse_filter(spark, sf_dir):
    from ..operators.browse import matching

    return matching(entities(spark, sf_dir), name="TH", address="src1", country="U.S.A.").select("entity_id", "business_name", "country")


@query(f"WITH {ENTITIES_SQL} SELECT entity_id, n FROM (SELECT *, row_number() OVER (ORDER BY src, num) AS n FROM ent) WHERE contains(lower(n || ' #' || n || ' ' || entity_id || ' ' || business_name || ' ' || business_address || ' ' || country), 'and ')")
def browse_search(spark, sf_dir):
    from ..operators.browse import numbered, search

    return search(numbered(entities(spark, sf_dir)), "AND ").select("entity_id", "n")


@query(f"WITH {ENTITIES_SQL} SELECT entity_id, n FROM (SELECT *, row_number() OVER (ORDER BY src, num) AS n FROM ent) WHERE n BETWEEN 51 AND 75")
def browse_page(spark, sf_dir):
    from ..operators.browse import numbered, page

    return page(numbered(entities(spark, sf_dir)), offset=50, limit=25).select("entity_id", "n")


@query(f"WITH {ENTITIES_SQL} SELECT entity_id, n FROM (SELECT *, row_number() OVER (ORDER BY src, num) AS n FROM ent) WHERE n IN (5, 7) OR n BETWEEN 10 AND 20")
def browse_rows(spark, sf_dir):
    from ..operators.browse import numbered, row_list

    return row_list(numbered(entities(spark, sf_dir)), "5,10-20,#7,1-900").select("entity_id", "n")


@query(f"WITH {ENTITIES_SQL} SELECT coalesce(src, 'ALL') AS src, count(*) AS rows FROM ent GROUP BY ROLLUP (src)")
def source_summary(spark, sf_dir):
    return entities(spark, sf_dir).rollup("src").agg(F.count("*").alias("rows")).select(F.coalesce("src", F.lit("ALL")).alias("src"), "rows")


# --- splits, samples, models ---


def _country_anchors(spark, sf_dir):
    return _norm(spark, sf_dir).where("src = 'S1'").select(F.col("entity_id").alias("s1_id"), F.col("country_canonical").alias("country"))


SPLIT_SQL = """
sp0 AS (SELECT entity_id AS s1_id, country_canonical || '/' || CASE WHEN n >= 4 THEN '4+' WHEN n >= 2 THEN '2-3' ELSE n::VARCHAR END AS stratum FROM (SELECT entity_id, country_canonical, (SELECT count(*) FROM truth t WHERE t.s1_id = norm.entity_id) AS n FROM norm WHERE src = 'S1')),
parts AS (SELECT s1_id, stratum, CASE WHEN row_number() OVER (PARTITION BY stratum ORDER BY md5('split|' || s1_id), s1_id) <= greatest(round(count(*) OVER (PARTITION BY stratum) * 0.2), CASE WHEN count(*) OVER (PARTITION BY stratum) >= 4 THEN 1 ELSE 0 END) THEN 'valid' ELSE 'train' END AS part FROM sp0)"""
SAMPLE_SQL = """
lp0 AS (SELECT r.s1_id, r.target_id, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM rcands r LEFT JOIN truth t USING (s1_id, target_id)),
lp AS (SELECT s1_id, target_id, label FROM lp0 QUALIFY label = 1 OR row_number() OVER (PARTITION BY s1_id, label ORDER BY md5('pairs|' || s1_id || '|' || target_id), target_id) <= 5 * greatest(1, sum(label) OVER (PARTITION BY s1_id)))"""


@query(sql(B.TRUTH_SQL, SPLIT_SQL, then="SELECT s1_id, stratum, part FROM parts"))
def hash_split(spark, sf_dir):
    return M.split(_country_anchors(spark, sf_dir), _truth(spark, sf_dir))


@query(sql(B.TRUTH_SQL, SPLIT_SQL, then="""SELECT count(*) FILTER (WHERE part = 'train') AS train, count(*) FILTER (WHERE part = 'valid') AS valid, count(DISTINCT stratum) AS strata,
  (SELECT count(*) FROM (SELECT target_id FROM truth JOIN parts USING (s1_id) GROUP BY 1 HAVING count(DISTINCT part) > 1)) AS shared_targets FROM parts"""))
def split_audit(spark, sf_dir):
    return M.split_audit(M.split(_country_anchors(spark, sf_dir), _truth(spark, sf_dir)), _truth(spark, sf_dir))


@query(sql(*RULES, B.TRUTH_SQL, SAMPLE_SQL, then="SELECT s1_id, target_id, label FROM lp"))
def pair_sample(spark, sf_dir):
    return M.labelled_pairs(_rule_cands(spark, sf_dir), _truth(spark, sf_dir))


@query(sql(*RULES, B.TRUTH_SQL, SAMPLE_SQL, then="SELECT count(*) AS pairs, sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, count(DISTINCT s1_id) AS anchors, count(DISTINCT target_id) AS targets FROM lp"))
def pair_summary(spark, sf_dir):
    return M.pair_summary(M.labelled_pairs(_rule_cands(spark, sf_dir), _truth(spark, sf_dir)))


LEARNED = ["name_token_jaccard", "name_levenshtein_sim", "name_char_ngram_cosine", "address_token_jaccard", "address_levenshtein_sim", "address_numeric_jaccard", "country_compatible", "tfidf_retrieval_score"]


def _labelled_features(spark, sf_dir):
    truth = _truth(spark, sf_dir).distinct().withColumn("t", F.lit(1))
    return _features(spark, sf_dir, LEARNED).join(truth, ["s1_id", "target_id"], "left").withColumn("label", F.coalesce("t", F.lit(0))).select("s1_id", "target_id", "label", *LEARNED)


@query()
def lr_fit_score(spark, sf_dir):
    x = _labelled_features(spark, sf_dir).persist()
    return x.select("s1_id", "target_id", "label", M.fit_logistic(x, LEARNED).score().alias("score"))


@query()
def stumps_fit_score(spark, sf_dir):
    x = _labelled_features(spark, sf_dir).persist()
    return x.select("s1_id", "target_id", "label", M.fit_stumps(x, LEARNED, trees=10).score().alias("score"))


@query()
def gbt_fit_score(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    x = _labelled_features(spark, sf_dir).persist()
    return M.library_model(x, LEARNED).transform(x).select("s1_id", "target_id", "label", F.round(vector_to_array("probability")[1], 4).alias("score"))


# --- the rest: Python-only functions, streams, points ---


@query()
def fuzzy_ratio(spark, sf_dir):
    from ..functions.fuzzy import char_ratio

    pairs = P.paired(_rule_cands(spark, sf_dir), _norm(spark, sf_dir))
    return pairs.select("s1_id", "target_id", char_ratio(F.array_join("a.name_tokens", ""), F.array_join("t.name_tokens", "")).alias("ratio"))


@query()
def indic_fold(spark, sf_dir):
    """Names with a Devanagari legal form put on, folded to Latin; the oracle corpus has no Indic text of its own."""
    from ..functions.fuzzy import fold_any

    e = entities(spark, sf_dir).withColumn("business_name", F.concat("business_name", F.lit(" प्राइवेट लिमिटेड")))
    from ..operators.normalise import normalise_names

    return normalise_names(e, folded=fold_any("name_raw")).select("entity_id", "name_clean", "name_canonical", "name_suffix")


@query()
def point_cloud(spark, sf_dir):
    from ..sources.sinks import point_cloud as points

    return points(entities(spark, sf_dir))


@query("""SELECT user_id, start, count(*) AS n, count(*) > 240 AS limited FROM (SELECT user_id, ts, unnest(range(0, 6)) AS k FROM events),
  LATERAL (SELECT time_bucket(INTERVAL '10 seconds', ts) - k * INTERVAL '10 seconds' AS start) GROUP BY user_id, start""")
def request_window(spark, sf_dir):
    from ..streaming.match import request_counts

    return request_counts(table(spark, sf_dir, "events"))


@query(sql(*MATCHED, then="SELECT s1_id, target_id, round(score, 9) AS score, rank FROM matches"))
def stream_match(spark, sf_dir):
    """The body of the stream, over all anchors as one micro-batch."""
    from ..streaming.match import match_batch

    e = entities(spark, sf_dir)
    norm = _norm(spark, sf_dir).where("src <> 'S1'")
    found = match_batch(e.where("src = 'S1'"), B.rule_keys(norm), norm, fuzzy=False)
    return found.select("s1_id", "target_id", F.round("score", 9).alias("score"), F.col("rank").cast("long").alias("rank"))


# --- more reports ---


def _details(spark, sf_dir):
    return P.rule_score(_rule_cands(spark, sf_dir), _norm(spark, sf_dir), fuzzy=False, expand_address=False, details=True)


DETAILS_SQL = """
details AS (SELECT s1_id, target_id, cand_ord, veto, s AS addr_sim, n AS name_sim, jac, over, postal, len(ta) = 0 AS no_address, a.name_raw AS a_name, t.name_raw AS t_name, CASE WHEN veto OR n < 0.45 THEN 0.0 WHEN mixed >= 0.58 THEN mixed
  WHEN named AND ac = tc AND length(ac) >= 10 AND postal AND length(ap) >= 5 THEN 0.59 WHEN both_num AND common AND postal AND subset THEN 0.585 WHEN len(an) >= 3 AND len(an) = len(tn) AND over = len(an) AND postal THEN 0.585
  WHEN mixed >= 0.56 AND mixed < 0.58 AND len(ta) > 0 AND s >= 0.15 THEN 0.5801::DOUBLE + (mixed - 0.56::DOUBLE) * 0.1::DOUBLE ELSE 0.0 END::DOUBLE AS score FROM q5)"""
ADDRESSES, JACCARDS = (0.80, 0.82, 0.84, 0.85, 0.86), (0.75, 0.80, 0.85)


@query(sql(*MATCHED, SPLIT_SQL, DETAILS_SQL, f"grid2 AS (SELECT a AS min_addr, j AS min_jaccard FROM (SELECT unnest([{', '.join(f'{a}::DOUBLE' for a in ADDRESSES)}]) AS a), (SELECT unnest([{', '.join(f'{j}::DOUBLE' for j in JACCARDS)}]) AS j))",
           """sw AS (SELECT min_addr, min_jaccard, s1_id, target_id, CASE WHEN score >= 0.58 THEN score WHEN (addr_sim >= min_addr AND over >= 1) OR (postal AND jac >= min_jaccard) THEN 0.585 ELSE 0.0 END AS final, cand_ord FROM details, grid2 WHERE NOT veto),
sp AS (SELECT * FROM sw QUALIFY row_number() OVER (PARTITION BY min_addr, min_jaccard, s1_id ORDER BY final DESC, cand_ord) <= 8)""",
           then="""SELECT min_addr, min_jaccard, part, (SELECT count(*) FROM sp JOIN truth USING (s1_id, target_id) JOIN parts p USING (s1_id) WHERE sp.min_addr = g.min_addr AND sp.min_jaccard = g.min_jaccard AND p.part = q.part AND final >= 0.58) AS tp,
  (SELECT count(*) FROM sp JOIN parts p USING (s1_id) LEFT JOIN truth t USING (s1_id, target_id) WHERE sp.min_addr = g.min_addr AND sp.min_jaccard = g.min_jaccard AND p.part = q.part AND final >= 0.58 AND t.target_id IS NULL) AS fp,
  n - (SELECT count(*) FROM sp JOIN truth USING (s1_id, target_id) JOIN parts p USING (s1_id) WHERE sp.min_addr = g.min_addr AND sp.min_jaccard = g.min_jaccard AND p.part = q.part AND final >= 0.58) AS fn
  FROM grid2 g, (SELECT part, count(*) AS n FROM truth JOIN parts USING (s1_id) GROUP BY 1) q"""))
def parameter_sweep(spark, sf_dir):
    parts = M.split(_country_anchors(spark, sf_dir), _truth(spark, sf_dir))
    return E.sweep(_details(spark, sf_dir), _truth(spark, sf_dir), parts, ADDRESSES, JACCARDS)


WORDS_SQL = r"list_filter(regexp_split_to_array(lower({c}), '\s+'), lambda x: {cond})"
LONG_A, LONG_T = (f"list_sort(list_distinct({WORDS_SQL.format(c=c, cond='length(x) >= 3')}))" for c in ("a_name", "t_name"))
SHORT_A, SHORT_T = (WORDS_SQL.format(c=c, cond="length(x) <= 2 AND x <> ''") for c in ("a_name", "t_name"))


@query(sql(*MATCHED, DETAILS_SQL, then=f"""SELECT CASE WHEN same AND short_differ THEN 'SHORT_ACRONYM_ERASURE' WHEN same AND no_address THEN 'IDENTICAL_NAME_MISSING_ADDR' WHEN same AND addr_sim > 0 THEN 'SHARED_NAME_DIFF_ADDR' WHEN addr_sim > 0.8 AND name_sim < 0.5 THEN 'SHARED_ADDR_DIFF_NAME'
  WHEN name_sim > 0.85 THEN 'GENERIC_BRAND_COLLISION' ELSE 'OTHER_PARTIAL_OVERLAP' END AS kind, count(*) AS n FROM (SELECT d.*, {LONG_A} = {LONG_T} AS same, {SHORT_A} <> {SHORT_T} AS short_differ FROM details d WHERE score >= 0.3 AND NOT EXISTS (SELECT 1 FROM truth t WHERE t.s1_id = d.s1_id AND t.target_id = d.target_id)) GROUP BY 1"""))
def fp_categories(spark, sf_dir):
    """Over all pairs that a threshold of 0.3 would output, so that there are some on any table."""
    d = _details(spark, sf_dir).persist()
    return E.false_positive_kinds(d, _truth(spark, sf_dir), d.where("score >= 0.3"))


@query(f"WITH {ENTITIES_SQL}, u AS (SELECT src, lower(trim(business_name)) IN ('') AS a, lower(trim(business_address)) IN ('', 'n/a') AS b, lower(trim(country)) IN ('', 'null') AS c FROM ent) SELECT src, field, count(*) FILTER (WHERE m) AS missing, round(100 * count(*) FILTER (WHERE m) / count(*), 6) AS pct FROM (SELECT src, 'business_name' AS field, a AS m FROM u UNION ALL SELECT src, 'business_address', b FROM u UNION ALL SELECT src, 'country', c FROM u) GROUP BY 1, 2")
def missingness(spark, sf_dir):
    return C.missingness(entities(spark, sf_dir))


@query(f"WITH {ENTITIES_SQL} SELECT business_name, count(*) AS n FROM ent GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark, sf_dir):
    return entities(spark, sf_dir).groupBy("business_name").agg(F.count("*").alias("n")).where("n > 1")


@query(sql(B.TRUTH_SQL, then="""SELECT target_src, token, n FROM (SELECT substr(target_id, 1, 2) AS target_src, token, count(*) AS n FROM (SELECT t.target_id, unnest(list_distinct(list_filter(b.name_tokens, lambda x: length(x) >= 3 AND NOT list_contains(a.name_tokens, x)))) AS token
  FROM truth t JOIN norm a ON a.entity_id = t.s1_id JOIN norm b ON b.entity_id = t.target_id) GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY target_src ORDER BY n DESC, token) <= 15"""))
def added_tokens(spark, sf_dir):
    return C.added_tokens(P.paired(_truth(spark, sf_dir), _norm(spark, sf_dir)))


@query(sql(B.TRUTH_SQL, then="""SELECT count(*) FILTER (WHERE src = 'S1') AS anchors, count(*) FILTER (WHERE src = 'S1' AND entity_id IN (SELECT s1_id FROM truth)) AS with_truth,
  (SELECT count(DISTINCT target_id) FROM truth WHERE target_id NOT IN (SELECT entity_id FROM ent)) AS orphans, count(*) FILTER (WHERE src <> 'S1' AND entity_id NOT IN (SELECT target_id FROM truth)) AS never_named FROM ent"""))
def dataset_coverage(spark, sf_dir):
    return C.dataset_coverage(entities(spark, sf_dir), _truth(spark, sf_dir))


@query(sql(B.TRUTH_SQL, then="SELECT target_id, max(s1_id) AS s1_id FROM truth GROUP BY 1"))
def reverse_lookup(spark, sf_dir):
    return C.reverse_lookup(_truth(spark, sf_dir))


PER_SOURCE_SQL = """
posts2 AS (SELECT key, entity_id AS target_id, row_number() OVER (PARTITION BY key, src ORDER BY num) AS post_ord FROM rkeys WHERE src <> 'S1' QUALIFY post_ord <= 300),
hits2 AS (SELECT k.entity_id AS s1_id, p.target_id, min((k.key_ord, p.post_ord)) AS spot FROM rkeys k JOIN posts2 p USING (key) WHERE k.src = 'S1' GROUP BY ALL),
rcands AS (SELECT s1_id, target_id, row_number() OVER (PARTITION BY s1_id, substr(target_id, 1, 2) ORDER BY spot, target_id) AS cand_ord FROM hits2 QUALIFY cand_ord <= 150)"""


def _per_source_cands(spark, sf_dir):
    keys = B.rule_keys(_norm(spark, sf_dir))
    return B.probe_rules(keys, B.postings(keys, B.RULE_POSTINGS, per_source=True), per_source=True)


@query(sql(B.RULE_KEYS_SQL, PER_SOURCE_SQL, then="SELECT s1_id, target_id, cand_ord FROM rcands"))
def candidates_per_source(spark, sf_dir):
    return _per_source_cands(spark, sf_dir).withColumn("cand_ord", F.col("cand_ord").cast("long"))


@query(sql(B.RULE_KEYS_SQL, PER_SOURCE_SQL, SCORE_SQL, then="SELECT s1_id, target_id, round(score, 9) AS score, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, target_id) AS rank FROM scored WHERE score >= 0.58 QUALIFY rank <= 8"))
def partitioned_matches(spark, sf_dir):
    """Sources matched one by one under their own caps, merged and ranked again at full precision, source 2 before source 3."""
    scored = P.rule_score(_per_source_cands(spark, sf_dir), _norm(spark, sf_dir), fuzzy=False)
    return E.top_matches(scored, P.TAU, order="target_id").select("s1_id", "target_id", F.round("score", 9).alias("score"), F.col("rank").cast("long").alias("rank"))


@query()
def source_manifest(spark, sf_dir):
    from ..sources.entities import manifest

    return manifest(spark, f"{sf_dir}/nation.parquet")


from . import studies  # noqa: E402, F401  (registers its queries)
