"""Features of candidate pairs, the rule scorer and the deterministic baseline, as projections over joined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.fuzzy import char_ratio
from ..functions.text import tokens
from .tfidf import cosine, cut

# The registry of features in order, with what stands for a missing value.
FEATURES = {
    "name_exact_match": 0.0, "name_clean_exact_match": 0.0, "name_canonical_exact_match": 0.0, "name_token_jaccard": 0.0, "name_token_overlap_count": 0.0,
    "name_token_containment": 0.0, "name_levenshtein_sim": 0.0, "name_length_ratio": 0.0, "name_numeric_overlap": 0.0, "name_char_ngram_cosine": 0.0,
    "address_exact_match": 0.0, "address_clean_exact_match": 0.0, "address_canonical_exact_match": 0.0, "address_token_jaccard": 0.0,
    "address_token_overlap_count": 0.0, "address_levenshtein_sim": 0.0, "address_numeric_jaccard": 0.0, "address_numeric_contradiction": 0.0,
    "address_postal_code_match": 0.0, "address_is_missing": 1.0, "address_char_ngram_cosine": 0.0,
    "country_exact_match": 0.0, "country_compatible": 1.0, "country_contradiction": 0.0, "has_unseen_country": 0.0,
    "name_and_address_high_sim": 0.0, "name_high_address_contradiction": 0.0, "name_exact_diff_country": 0.0, "overall_composite_similarity": 0.0,
    "retrieved_by_standard": 0.0, "retrieved_by_tfidf": 0.0, "retrieved_by_both": 0.0, "tfidf_retrieval_score": 0.0,
}
# The features that are made of others, and of which.
_SIMILAR = [f"{kind}_{c}" for kind in ("name", "address") for c in ("exact_match", "canonical_exact_match", "token_jaccard", "levenshtein_sim", "char_ngram_cosine")]
_HIGH_NAME, _EXACT_NAME = ["name_token_jaccard", "name_canonical_exact_match", "name_levenshtein_sim"], ["name_exact_match", "name_clean_exact_match", "name_canonical_exact_match"]
CROSS = {
    "name_and_address_high_sim": [*_HIGH_NAME, "address_is_missing", "address_token_jaccard", "address_canonical_exact_match", "address_levenshtein_sim"],
    "name_high_address_contradiction": [*_HIGH_NAME, "address_numeric_contradiction"], "name_exact_diff_country": [*_EXACT_NAME, "country_contradiction"],
    "overall_composite_similarity": [*_SIMILAR, "address_is_missing", "address_numeric_contradiction", "country_exact_match", "country_compatible", "country_contradiction"],
}
# Weights and thresholds of the rule scorer.
TAU, RULE_SCORE, RULE_SCORE_EXACT, SHIFT_FROM, SHIFT_TO = 0.58, 0.585, 0.59, 0.56, 0.5801


def paired(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    """pairs with the normalised rows of both sides as structs a and t."""
    cols = [c for c in norm.columns if c.startswith(("name_", "addr_", "country_"))]
    a = norm.where("src = 'S1'").select(F.col("entity_id").alias("s1_id"), F.struct(*cols).alias("a"))
    t = norm.where("src <> 'S1'").select(F.col("entity_id").alias("target_id"), F.struct(*cols).alias("t"))
    return pairs.join(a, "s1_id").join(t, "target_id")


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int").cast("double")


def name_features(df: DataFrame) -> DataFrame:
    a, t = (lambda c: F.col(f"a.name_{c}")), (lambda c: F.col(f"t.name_{c}"))
    same = lambda c: _flag((a(c) != "") & (a(c) == t(c)))
    return df.withColumns({
        "name_exact_match": same("raw"), "name_clean_exact_match": same("clean"), "name_canonical_exact_match": same("canonical"),
        "name_token_jaccard": F.round(S.jaccard(a("tokens"), t("tokens")), 4), "name_token_overlap_count": S.overlap(a("tokens"), t("tokens")).cast("double"),
        "name_token_containment": F.round(S.containment(a("tokens"), t("tokens")), 4), "name_levenshtein_sim": F.round(S.edit_similarity(a("canonical"), t("canonical")), 4),
        "name_length_ratio": F.round(S.length_ratio(a("canonical"), t("canonical")), 4), "name_numeric_overlap": F.round(S.numeric_overlap(a("tokens"), t("tokens")), 4),
        "name_char_ngram_cosine": F.round(cosine(a("canonical"), t("canonical")), 4),
    })


def address_features(df: DataFrame) -> DataFrame:
    a, t = (lambda c: F.col(f"a.addr_{c}")), (lambda c: F.col(f"t.addr_{c}"))
    gone = a("empty") | t("empty")
    value = lambda c: F.when(gone, F.lit(0.0)).otherwise(c)
    same = lambda c: value(_flag((a(c) != "") & (a(c) == t(c))))
    return df.withColumns({
        "address_exact_match": same("raw"), "address_clean_exact_match": same("clean"), "address_canonical_exact_match": same("canonical"),
        "address_token_jaccard": value(F.round(S.jaccard(a("tokens"), t("tokens")), 4)), "address_token_overlap_count": value(S.overlap(a("tokens"), t("tokens")).cast("double")),
        "address_levenshtein_sim": value(F.round(S.edit_similarity(a("canonical"), t("canonical")), 4)),
        "address_numeric_jaccard": value(F.round(S.jaccard(a("numbers"), t("numbers")), 4)),
        "address_numeric_contradiction": value(_flag(S.numeric_contradiction(a("numbers"), t("numbers"), a("postal"), t("postal")))),
        "address_postal_code_match": value(_flag(a("postal") == t("postal"))), "address_is_missing": _flag(gone),
        "address_char_ngram_cosine": value(F.round(cosine(a("canonical"), t("canonical")), 4)),
    })


def country_features(df: DataFrame) -> DataFrame:
    a, t = F.col("a.country_canonical"), F.col("t.country_canonical")
    known = ~(F.col("a.country_missing") | F.col("t.country_missing"))
    return df.withColumns({
        "country_exact_match": _flag(known & (a == t)), "country_compatible": _flag(~known | (a == t)), "country_contradiction": _flag(known & (a != t)),
        "has_unseen_country": _flag(~(F.col("a.country_seen") & F.col("t.country_seen"))),
    })


def composite(address: bool = True, numeric_guard: bool = True, country_guard: bool = True) -> Column:
    """Weighted similarity of names, addresses and countries, lowered by contradictions, from the rounded features. Switches leave out
    the address, or what a contradiction of numbers or countries costs."""
    c = F.col

    def part(kind: str) -> Column:
        best = F.greatest(f"{kind}_token_jaccard", f"{kind}_levenshtein_sim", f"{kind}_char_ngram_cosine")
        return F.when(c(f"{kind}_exact_match") == 1, F.lit(1.0)).when(c(f"{kind}_canonical_exact_match") == 1, F.greatest(best, F.lit(0.95))).otherwise(best)

    country = F.when(c("country_exact_match") == 1, F.lit(1.0)).when(c("country_compatible") == 1, F.lit(0.8)).otherwise(F.lit(0.0))
    whole = 0.85 * part("name") + 0.15 * country
    if address:
        whole = F.when(c("address_is_missing") == 1, whole).otherwise(0.55 * part("name") + 0.35 * part("address") + 0.10 * country)
    if country_guard:
        whole = whole * F.when(c("country_contradiction") == 1, F.lit(0.15)).otherwise(F.lit(1.0))
    if numeric_guard:
        whole = whole * F.when(c("address_numeric_contradiction") == 1, F.lit(0.30)).otherwise(F.lit(1.0))
    return whole


def cross_features(df: DataFrame, only: list[str] | None = None) -> DataFrame:
    """What names, addresses and countries say together, or what is named of that; reads the rounded features."""
    c = F.col
    high_name = (c("name_token_jaccard") >= 0.70) | (c("name_canonical_exact_match") == 1) | (c("name_levenshtein_sim") >= 0.85)
    high_addr = (c("address_is_missing") == 0) & ((c("address_token_jaccard") >= 0.50) | (c("address_canonical_exact_match") == 1) | (c("address_levenshtein_sim") >= 0.75))
    exact = (c("name_exact_match") == 1) | (c("name_clean_exact_match") == 1) | (c("name_canonical_exact_match") == 1)

    whole = composite()
    made = {
        "name_and_address_high_sim": _flag(high_name & high_addr), "name_high_address_contradiction": _flag(high_name & (c("address_numeric_contradiction") == 1)),
        "name_exact_diff_country": _flag(exact & (c("country_contradiction") == 1)), "overall_composite_similarity": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(whole, 4))),
    }
    return df.withColumns({name: x for name, x in made.items() if only is None or name in only})


def provenance_features(df: DataFrame) -> DataFrame:
    """From columns in_standard, in_tfidf, tfidf (score)."""
    return df.withColumns({
        "retrieved_by_standard": _flag(F.col("in_standard")), "retrieved_by_tfidf": _flag(F.col("in_tfidf")),
        "retrieved_by_both": _flag(F.col("in_standard") & F.col("in_tfidf")), "tfidf_retrieval_score": F.coalesce("tfidf", F.lit(0.0)),
    })


def pair_features(pairs: DataFrame, norm: DataFrame, only: list[str] | None = None) -> DataFrame:
    """All features of pairs (s1_id, target_id, in_standard, in_tfidf, tfidf), or those named, in registry order."""
    wanted = [c for c in FEATURES if only is None or c in only]
    df = country_features(address_features(name_features(paired(pairs, norm))))
    if any(c in CROSS for c in wanted):
        # a generator, so that the composite reads the features and isn't written out with the expressions of each of them;
        # nothing can be pruned behind it, so it has only the features that are named or that named ones are made of
        needed = set(wanted).union(*(CROSS[c] for c in wanted if c in CROSS))
        df = cross_features(df.select("s1_id", "target_id", "in_standard", "in_tfidf", "tfidf", F.inline(F.array(F.struct(*[c for c in FEATURES if c in df.columns and c in needed])))), wanted)
    df = provenance_features(df)
    return df.select("s1_id", "target_id", *[F.coalesce(F.nanvl(F.col(c), F.lit(FEATURES[c])), F.lit(FEATURES[c])).alias(c) for c in wanted])


def at_least(pairs: DataFrame, norm: DataFrame, least: float) -> DataFrame:
    """s1_id, target_id of the pairs whose overall_composite_similarity is `least` or more; norm should be made already.

    Names, countries and numbers bound the composite from both sides, as it only grows with the likeness of addresses. They are short, so
    the many pairs that they decide are shuffled with little; the others get the features that the composite is made of."""
    whole = "overall_composite_similarity"
    rest = pairs
    decided = None
    if norm.groupBy("entity_id").count().where("count > 1").isEmpty():  # a repeated id has pairs of different rows under one name
        brief = cut(_bounds(pairs, norm).select("s1_id", "target_id", F.when(F.col("low") >= least, True).when(F.col("high") < least, False).alias("yes")))
        rest, decided = brief.where("yes is null"), brief.where("yes").select("s1_id", "target_id")
    rest = rest.select("s1_id", "target_id", F.lit(False).alias("in_standard"), F.lit(False).alias("in_tfidf"), F.lit(0.0).alias("tfidf"))
    rest = pair_features(rest, norm, [whole]).where(F.col(whole) >= least).select("s1_id", "target_id")
    return rest if decided is None else decided.unionByName(rest)


def _bounds(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    """s1_id, target_id, low, high: between which the composite is, whatever the addresses say beside their numbers."""
    short = norm.select("src", "entity_id", "name_canonical", F.array_join("addr_numbers", " ").alias("name_numbers"), "addr_postal", "addr_empty", "country_canonical", "country_missing")
    df = paired(pairs.select("s1_id", "target_id"), short)

    def row(side: str) -> Column:
        c, none = (lambda name: F.col(f"{side}.{name}")), F.lit(None).cast("string")
        numbers = F.filter(F.split(c("name_numbers"), " "), lambda x: x != "")
        return F.struct(
            none.alias("name_raw"), none.alias("name_clean"), c("name_canonical").alias("name_canonical"), tokens(c("name_canonical")).alias("name_tokens"),
            none.alias("addr_raw"), none.alias("addr_clean"), none.alias("addr_canonical"), F.array(none).alias("addr_tokens"), numbers.alias("addr_numbers"), c("addr_postal").alias("addr_postal"), c("addr_empty").alias("addr_empty"),
            c("country_canonical").alias("country_canonical"), c("country_missing").alias("country_missing"), F.lit(True).alias("country_seen"),
        ).alias(side)

    df = country_features(address_features(name_features(df.select("s1_id", "target_id", row("a"), row("t")))))
    open_ = [c for c in CROSS["overall_composite_similarity"] if c.startswith("address_") and c not in ("address_is_missing", "address_numeric_contradiction")]
    known = [c for c in CROSS["overall_composite_similarity"] if c not in open_]
    df = df.select("s1_id", "target_id", F.inline(F.array(F.struct(*known))))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(composite(), 4)))
    df = df.withColumns({c: F.lit(0.0) for c in open_}).withColumn("low", score)  # the raw names, which aren't here, can only add to it
    df = df.withColumns({c: F.lit(1.0) for c in open_} | {"name_exact_match": F.col("name_canonical_exact_match")}).withColumn("high", score)
    return df.select("s1_id", "target_id", "low", "high")


def baseline(features: DataFrame, high: float = 0.85, least_address: float = 0.30, missing_address: bool = True) -> DataFrame:
    """s1_id, target_id, is_match, confidence, rule of the deterministic rules, in their order."""
    c = F.col
    exact = (c("name_canonical_exact_match") == 1) | (c("name_clean_exact_match") == 1)
    fits = (c("address_canonical_exact_match") == 1) | (c("address_postal_code_match") == 1) | (c("address_token_jaccard") >= least_address) | (c("address_levenshtein_sim") >= 0.50)
    alone = (c("address_is_missing") == 1) & F.lit(missing_address)
    whole = c("overall_composite_similarity")
    rules = [
        ("REJECT_COUNTRY_CONTRADICTION", c("country_contradiction") == 1, False, F.lit(0.0)),
        ("REJECT_ADDRESS_NUMERIC_CONTRADICTION", c("address_numeric_contradiction") == 1, False, F.lit(0.0)),
        ("RULE_EXACT_CANONICAL_WITH_COMPATIBLE_ADDRESS", exact & (fits | alone), True, F.when(fits, F.lit(0.96)).otherwise(F.lit(0.88))),
        ("RULE_NAME_AND_ADDRESS_HIGH_SIM", c("name_and_address_high_sim") == 1, True, F.lit(0.92)),
        ("RULE_HIGH_COMPOSITE_SCORE", whole >= high, True, whole),
    ]
    name, match, confidence = F.lit("INSUFFICIENT_EVIDENCE"), F.lit(False), whole
    for rule, holds, yes, value in reversed(rules):
        name, match, confidence = (F.when(holds, F.lit(x) if not isinstance(x, Column) else x).otherwise(y) for x, y in ((rule, name), (yes, match), (value, confidence)))
    return features.select("s1_id", "target_id", match.alias("is_match"), confidence.alias("confidence"), name.alias("rule"))


def rule_score(pairs: DataFrame, norm: DataFrame, fuzzy: bool = True, tau: float = TAU, expand: bool = True, expand_address: bool = True, details: bool = False) -> DataFrame:
    """pairs with `score`: 0 where the pair is rejected, else the rule engine's score; details adds what it was made from.

    Cheap vetoes come first; the character ratio, the only Python step, gets nulls for the rows that don't need it.
    fuzzy=False leaves that step out.
    """
    c = F.col
    df = paired(pairs, norm)
    keep = lambda x: F.array_distinct(F.filter(F.col(x), lambda v: F.length(v) >= 2))
    df = df.withColumns({"an": keep("a.name_tokens"), "tn": F.array_distinct(F.filter(F.split("t.name_canonical", " "), lambda v: F.length(v) >= 2)), "aa": keep("a.addr_tokens"), "ta": keep("t.addr_tokens"),
                         "x": c("a.addr_numbers"), "y": c("t.addr_numbers"), "ac": c("a.name_canonical"), "tc": c("t.name_canonical"),
                         "aj": F.array_join("a.name_tokens", ""), "tj": F.array_join("t.name_tokens", ""), "ap": F.coalesce("a.addr_postal", F.lit("")), "tp": F.coalesce("t.addr_postal", F.lit(""))})
    both = (F.size("x") > 0) & (F.size("y") > 0)
    common = F.size(F.array_intersect("x", "y")) > 0
    end = lambda i: (F.element_at("x", i) != F.element_at("y", i)) & ~F.array_contains(c("y"), F.element_at("x", i)) & ~F.array_contains(c("x"), F.element_at("y", i))
    clash = F.when(both & common, (F.size("x") >= 2) & (F.size("y") >= 2) & (end(1) | end(-1))).when(both, ~S.near_numbers(c("x"), c("y"))).otherwise(F.lit(False))
    country_a, country_t = F.coalesce(F.nullif("a.country_canonical", F.lit("")), F.lit("UNKNOWN")), F.coalesce(F.nullif("t.country_canonical", F.lit("")), F.lit("UNKNOWN"))
    veto = (country_a != "UNKNOWN") & (country_t != "UNKNOWN") & (country_a != country_t) | clash
    df = df.withColumns({"veto": veto, "num_match": both & (common | S.near_numbers(c("x"), c("y"))), "jac": S.jaccard(c("an"), c("tn")), "over": S.overlap(c("an"), c("tn"))})
    low, high = F.least(F.size("an"), F.size("tn")), F.greatest(F.size("an"), F.size("tn"))
    subset = (low >= 2) & (c("over") == low)
    named = (c("ac") != "") & (c("tc") != "")
    inside = F.when(subset & (c("jac") < 0.85), F.greatest(c("jac"), 0.70 + 0.20 * (low / high))).otherwise(c("jac"))
    df = df.withColumn("n1", F.when(named & (c("ac") == c("tc")), F.lit(1.0)).when((F.size("an") > 0) & (c("tc") != "") & (F.size("tn") > 0), inside).otherwise(F.lit(0.0)))
    glued = (c("aj") != "") & ((c("aj") == F.replace(c("tc"), F.lit(" "), F.lit(""))) | (c("tj") == F.replace(c("ac"), F.lit(" "), F.lit(""))) | (c("aj") == c("tj")))
    part = (F.length("ac") >= 8) & (F.length("tc") >= 8) & (c("tc").contains(c("ac")) | c("ac").contains(c("tc")))
    joined = F.when(glued, F.greatest(c("n1"), F.lit(0.95))).when(part, F.greatest(c("n1"), F.lit(0.90))).otherwise(c("n1"))
    df = df.withColumn("n2", F.when((c("n1") < 0.85) & named, joined).otherwise(c("n1"))).withColumn("asim", S.jaccard(c("aa"), c("ta")))
    near = (c("asim") >= 0.82) & (F.size("ta") > 0) & (F.size("aa") > 0)
    asks = ~c("veto") & (((c("n2") < 0.80) & named & ((c("over") > 0) | c("num_match")) & (F.length("aj") >= 6) & (F.length("tj") >= 6)) | near & (c("over") == 0))
    df = df.withColumn("ratio", char_ratio(F.when(asks, c("aj")), F.when(asks, c("tj"))) if fuzzy else F.lit(0.0))
    fuzz = (c("n2") < 0.80) & named & ((c("over") > 0) | c("num_match")) & (F.length("aj") >= 6) & (F.length("tj") >= 6) & (c("ratio") >= 0.78)
    df = df.withColumn("n", F.when(fuzz, F.greatest(c("n2"), c("ratio") * 0.90)).otherwise(c("n2")))
    n, s, no_addr = c("n"), c("asim"), F.size("ta") == 0
    mixed = (
        F.when(n >= 0.85, F.when(s >= 0.20, 0.60 * n + 0.40 * s).when(no_addr, 0.55 * n).otherwise(0.40 * n))
        .when(n >= 0.65, F.when(s >= 0.30, 0.50 * n + 0.50 * s).when(no_addr, 0.45 * n).otherwise(0.35 * n))
        .when((n >= 0.50) & (s >= 0.40), 0.45 * n + 0.55 * s).otherwise(F.lit(0.0))
    )
    df = df.withColumn("mixed", mixed)
    postal = (c("ap") != "") & (c("ap") == c("tp"))
    by_address = near & ((c("over") >= 1) | (c("aj") != "") & (c("tj") != "") & (c("ratio") >= 0.70)) & F.lit(expand_address)
    rules = [
        (c("veto"), F.lit(0.0)),
        ((n < 0.45) & by_address, F.lit(RULE_SCORE)),
        (n < 0.45, F.lit(0.0)),
        (c("mixed") >= tau, c("mixed")),
    ]
    if expand:
        rules += [
            (named & (c("ac") == c("tc")) & (F.length("ac") >= 10) & postal & (F.length("ap") >= 5), F.lit(RULE_SCORE_EXACT)),
            (both & common & postal & subset, F.lit(RULE_SCORE)),
            ((F.size("an") >= 3) & (F.size("an") == F.size("tn")) & (c("over") == F.size("an")) & postal, F.lit(RULE_SCORE)),
            ((c("mixed") >= SHIFT_FROM) & (c("mixed") < 0.58) & ~no_addr & (s >= 0.15), SHIFT_TO + (c("mixed") - SHIFT_FROM) * 0.1),
        ]
    if expand_address:
        rules += [(by_address, F.lit(RULE_SCORE)), (postal & (F.length("ap") >= 5) & (c("jac") >= 0.80), F.lit(RULE_SCORE))]
    score = F.lit(0.0)
    for holds, value in reversed(rules):
        score = F.when(holds, value).otherwise(score)
    more = [n.alias("name_sim"), s.alias("addr_sim"), c("jac").alias("jaccard"), c("over").alias("overlap"), postal.alias("same_postal"), c("veto"), no_addr.alias("no_address"), c("a.name_raw").alias("a_name"), c("t.name_raw").alias("t_name"),
            "a", "t", "mixed", "an", "tn", "aa", "ta", "x", "y", "ac", "tc", "aj", "tj", "ap", "tp"] if details else []
    return df.select(*pairs.columns, score.alias("score"), *more)
