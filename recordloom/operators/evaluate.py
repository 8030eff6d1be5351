"""Decisions on scored pairs, the precision-weighted metrics, and the audits of errors and candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Matches kept per anchor by the rule engine and by the matcher, and thresholds.
RULE_MATCHES, MATCHER_MATCHES, MATCHER_TAU = 8, 15, 0.70
TAUS = (0.40, 0.45, 0.50, 0.55, 0.58, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90)
CAPS = (8, 16, 32, 64)


def top_matches(scored: DataFrame, tau: float, most: int = RULE_MATCHES, order: str = "cand_ord") -> DataFrame:
    """s1_id, target_id, score, rank: the best `most` pairs of each anchor from tau on; equal scores keep retrieval order.

    The threshold stands after the window, where it picks the same rows: before it, the optimiser would write the whole scoring
    expression out once more for each of its parts."""
    r = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.col("score").desc(), order))
    ranked = scored.where(F.col("s1_id") != F.col("target_id")).withColumn("rank", r).where(F.col("rank") <= most)
    return ranked.where(F.col("score") >= tau).select("s1_id", "target_id", "score", "rank")


def listed(pairs: DataFrame, name: str, order: str = "target_id") -> DataFrame:
    """s1_id and the anchor's targets as an array in order."""
    got = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("target_id").alias("t")))).alias("x"))
    return got.select("s1_id", F.col("x.t").alias(name))


def entity_scores(anchors: DataFrame, truth: DataFrame, predicted: DataFrame, cands: DataFrame | None = None) -> DataFrame:
    """For each anchor: is_singleton, n_true, n_pred, tp, fp, fn, precision, recall, f05. Repeated pairs count once. One shuffle:
    truth and predictions are tagged, unioned and counted per pair, then per anchor."""
    tagged = truth.select("s1_id", "target_id", F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(predicted.select("s1_id", "target_id", F.lit(0).alias("t"), F.lit(1).alias("p")))
    pairs = tagged.groupBy("s1_id", "target_id").agg(F.max("t").alias("t"), F.max("p").alias("p"))
    sums = pairs.groupBy("s1_id").agg(F.sum("t").alias("n_true"), F.sum("p").alias("n_pred"), F.sum(F.col("t") * F.col("p")).alias("tp"))
    e = anchors.select("s1_id").join(sums, "s1_id", "left").fillna(0, ["n_true", "n_pred", "tp"])
    return rates(e)


def rates(e: DataFrame) -> DataFrame:
    """e, a row with n_true, n_pred and tp for each anchor, with is_singleton, fp, fn, precision, recall and f05."""
    e = e.withColumns({"is_singleton": F.col("n_true") == 0, "fp": F.col("n_pred") - F.col("tp"), "fn": F.col("n_true") - F.col("tp")})
    none = F.col("is_singleton") & (F.col("n_pred") == 0)
    precision = F.when(none, F.lit(1.0)).when(F.col("tp") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("n_pred"))
    recall = F.when(none, F.lit(1.0)).when(F.col("tp") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("n_true"))
    e = e.withColumns({"precision": precision, "recall": recall})
    f05 = F.when(none, F.lit(1.0)).when(F.col("tp") == 0, F.lit(0.0)).otherwise(1.25 * F.col("precision") * F.col("recall") / (0.25 * F.col("precision") + F.col("recall")))
    return e.withColumn("f05", f05)


def macro(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row, or one for each group if named: counts and means over anchors, means rounded to 9 decimals."""
    mean = lambda c, when=None: F.round(F.coalesce(F.avg(F.col(c) if when is None else F.when(when, F.col(c))), F.lit(0.0)), 9)
    single = F.col("is_singleton")
    return scores.groupBy(*(by or [])).agg(
        F.count("*").alias("anchors"), F.count_if(single).alias("singletons"), F.count_if(~single).alias("matched"), mean("f05").alias("macro_f05"), mean("precision").alias("mean_precision"),
        mean("recall").alias("mean_recall"), mean("f05", single).alias("singleton_f05"), mean("f05", ~single).alias("matched_f05"),
        F.count_if(F.col("f05") >= 0.999999).alias("perfect"), F.count_if(F.col("f05") <= 1e-6).alias("zero"),
    )


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def micro(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Pooled tp, fp, fn and precision, recall, f1, f05 (9 decimals), by groups if named."""
    s = scores.groupBy(*(by or [])).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    p, r = _div(F.col("tp"), F.col("tp") + F.col("fp")), _div(F.col("tp"), F.col("tp") + F.col("fn"))
    return s.select(*(by or []), "tp", "fp", "fn", F.round(p, 9).alias("precision"), F.round(r, 9).alias("recall"), F.round(_div(2 * p * r, p + r), 9).alias("f1"), F.round(_div(1.25 * p * r, 0.25 * p + r), 9).alias("f05"))


def threshold_curve(anchors: DataFrame, truth: DataFrame, scored: DataFrame, taus: tuple[float, ...] = TAUS, most: int = RULE_MATCHES) -> DataFrame:
    """tau, macro_f05, matches for each threshold: ranks don't depend on tau, so pairs are ranked once and dealt to all taus."""
    spark = anchors.sparkSession
    grid = spark.createDataFrame([(float(t),) for t in taus], "tau double")
    ranked = top_matches(scored, -1.0, most)
    pred = ranked.join(F.broadcast(grid), F.col("score") >= F.col("tau")).select("tau", "s1_id", "target_id")
    true_n = truth.groupBy("s1_id").agg(F.countDistinct("target_id").alias("n_true"))
    hits = pred.join(truth.distinct().withColumn("hit", F.lit(1)), ["s1_id", "target_id"], "left").groupBy("tau", "s1_id").agg(F.count("*").alias("n_pred"), F.sum(F.coalesce("hit", F.lit(0))).alias("tp"))
    each = anchors.select("s1_id").join(true_n, "s1_id", "left").crossJoin(F.broadcast(grid)).join(hits, ["tau", "s1_id"], "left").fillna(0)
    p, r = F.col("tp") / F.col("n_pred"), F.col("tp") / F.col("n_true")
    f = F.when((F.col("n_true") == 0) & (F.col("n_pred") == 0), F.lit(1.0)).when(F.col("tp") == 0, F.lit(0.0)).otherwise(1.25 * p * r / (0.25 * p + r))
    return each.groupBy("tau").agg(F.round(F.avg(f), 9).alias("macro_f05"), F.sum("n_pred").alias("matches"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row of the highest macro_f05; of equal ones the lowest tau."""
    return curve.orderBy(F.col("macro_f05").desc(), "tau").limit(1)


def pair_outcomes(anchors: DataFrame, truth: DataFrame, predicted: DataFrame, cands: DataFrame) -> DataFrame:
    """One row per pair that is true, predicted or a candidate: flags t, p, c, and the anchor's n_true, n_pred, n_hit (true candidates)."""
    flag = lambda df, a, b, c: df.select("s1_id", "target_id", F.lit(a).alias("t"), F.lit(b).alias("p"), F.lit(c).alias("c"))
    every = flag(truth, 1, 0, 0).unionByName(flag(predicted, 0, 1, 0)).unionByName(flag(cands, 0, 0, 1)).join(anchors.select("s1_id"), "s1_id", "left_semi")
    pairs = every.groupBy("s1_id", "target_id").agg(F.max("t").alias("t"), F.max("p").alias("p"), F.max("c").alias("c"))
    w = Window.partitionBy("s1_id")
    return pairs.withColumns({"n_true": F.sum("t").over(w), "n_pred": F.sum("p").over(w), "n_hit": F.sum(F.col("t") * F.col("c")).over(w), "n_tp": F.sum(F.col("t") * F.col("p")).over(w)})


def error_records(outcomes: DataFrame) -> DataFrame:
    """s1_id, target_id, error_type of each error; an anchor whose sets are equal has none. A matched anchor without any prediction
    but with a true candidate has one record without a target more."""
    c = F.col
    wrong = ~((c("n_true") == c("n_tp")) & (c("n_pred") == c("n_tp")))
    missed, extra = (c("t") == 1) & (c("p") == 0), (c("t") == 0) & (c("p") == 1)
    kind = (
        F.when(extra & (c("n_true") == 0), "SINGLETON_FALSE_MERGE").when(extra, "MODEL_FALSE_POSITIVE")
        .when(missed & (c("c") == 0), "BLOCKING_MISS").when(missed & (c("n_pred") > 0), "MODEL_FALSE_NEGATIVE")
    )
    outcomes = outcomes.withColumn("place", F.row_number().over(Window.partitionBy("s1_id").orderBy("target_id")))
    gone = (c("place") == 1) & (c("n_true") > 0) & (c("n_pred") == 0) & (c("n_hit") > 0)
    record = lambda target, error: F.struct(target.alias("target_id"), error.alias("error_type"))
    own = F.when(wrong & kind.isNotNull(), record(c("target_id"), kind))
    whole = F.when(gone, record(F.lit(None).cast("string"), F.lit("SINGLETON_FALSE_DISMISSAL")))
    return outcomes.select("s1_id", F.explode(F.array_compact(F.array(own, whole))).alias("e")).select("s1_id", "e.*")


def root_causes(outcomes: DataFrame, scored: DataFrame, tau: float) -> DataFrame:
    """cause, n of each true pair that wasn't predicted and each wrong prediction."""
    x = outcomes.join(scored.select("s1_id", "target_id", "score"), ["s1_id", "target_id"], "left")
    c = F.col
    cause = (
        F.when((c("t") == 0) & (c("n_true") == 0), "SINGLETON_FALSE_MERGE").when(c("t") == 0, "FALSE_MERGE").when(c("c") == 0, "BLOCKING")
        .when(F.coalesce("score", F.lit(0.0)) == 0, "FEATURE").when(c("score") < 0.45, "MODEL").when(c("score") < tau, "THRESHOLD").otherwise("MULTI_MATCH_TRUNCATION")
    )
    return x.where(c("t") != c("p")).groupBy(cause.alias("cause")).agg(F.count("*").alias("n"))


def stage_map(truth: DataFrame, cands: DataFrame, features: DataFrame, scored: DataFrame, predicted: DataFrame, tau: float) -> DataFrame:
    """stage, n: where each true pair was lost, or SUCCESS."""
    x = truth.distinct().join(cands.select("s1_id", "target_id", F.lit(1).alias("c")).distinct(), ["s1_id", "target_id"], "left")
    x = x.join(features.select("s1_id", "target_id", "country_contradiction", "address_numeric_contradiction"), ["s1_id", "target_id"], "left")
    x = x.join(scored.select("s1_id", "target_id", "score"), ["s1_id", "target_id"], "left").join(predicted.select("s1_id", "target_id", F.lit(1).alias("p")).distinct(), ["s1_id", "target_id"], "left")
    stage = (
        F.when(F.col("p") == 1, "SUCCESS").when(F.col("c").isNull(), "RETRIEVAL_MISS").when(F.col("country_contradiction") == 1, "COUNTRY_VETO").when(F.col("address_numeric_contradiction") == 1, "BUILDING_NUM_VETO")
        .when(F.coalesce("score", F.lit(0.0)) < tau, "BELOW_THRESHOLD").otherwise("MATCH_CAP_EXCLUDED")
    )
    return x.groupBy(stage.alias("stage")).agg(F.count("*").alias("n"))


def positional(df: DataFrame, value: str, places: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact order statistics: for each name the value at place floor(rows * q) of the sorted rows. Rows are counted by value
    first, so only the counts of distinct values are sorted."""
    by = by or []
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy(value))
    counts = counts.withColumns({"_upto": upto, "_all": F.sum("_n").over(Window.partitionBy(*by))})
    return counts.groupBy(*by).agg(*[F.min(F.when(F.col("_upto") > F.floor(F.col("_all") * q), F.col(value))).alias(name) for name, q in places.items()])


def recall_audit(anchors: DataFrame, truth: DataFrame, cands: DataFrame, universe: int = 10_000_000) -> DataFrame:
    """One row: recall, share of anchors found fully, partly and not at all, candidates per anchor (mean, positional median and p90, maximum),
    reduction of the pairs against anchors * universe."""
    n = cands.groupBy("s1_id").agg(F.count("*").alias("k"))
    hit = truth.distinct().join(cands.select("s1_id", "target_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "target_id"], "left")
    per = hit.groupBy("s1_id").agg(F.count("*").alias("n_true"), F.sum(F.coalesce("hit", F.lit(0))).alias("n_hit"))
    e = anchors.select("s1_id").join(n, "s1_id", "left").join(per, "s1_id", "left").fillna(0)
    with_truth = F.count_if(F.col("n_true") > 0)
    places = positional(e, "k", {"median_candidates": 0.5, "p90_candidates": 0.9})
    return places.crossJoin(e.agg(
        F.count("*").alias("anchors"), F.sum("n_true").alias("true_pairs"), F.sum("n_hit").alias("found_pairs"), F.round(_div(F.sum("n_hit"), F.sum("n_true")), 9).alias("recall"),
        F.round(_div(F.count_if((F.col("n_true") > 0) & (F.col("n_hit") == F.col("n_true"))), with_truth), 9).alias("full_rate"),
        F.round(_div(F.count_if((F.col("n_hit") > 0) & (F.col("n_hit") < F.col("n_true"))), with_truth), 9).alias("partial_rate"),
        F.round(_div(F.count_if((F.col("n_true") > 0) & (F.col("n_hit") == 0)), with_truth), 9).alias("zero_rate"),
        F.round(F.avg("k"), 9).alias("mean_candidates"), F.max("k").alias("max_candidates"),
        F.round(1 - F.sum("k") / (F.count("*") * F.lit(float(universe))), 12).alias("reduction_ratio"),
    ))


def prune(matches: DataFrame, cands: DataFrame, most: int = 40) -> DataFrame:
    """s1_id, target_id, place: all matches by rank, then candidates in order, `most` in all; matches are never cut."""
    every = matches.select("s1_id", "target_id", F.lit(0).alias("kind"), F.col("rank").alias("o")).unionByName(cands.select("s1_id", "target_id", F.lit(1).alias("kind"), F.col("cand_ord").alias("o")))
    first = every.groupBy("s1_id", "target_id").agg(F.min(F.struct("kind", "o")).alias("at"))
    w = Window.partitionBy("s1_id")
    placed = first.withColumn("place", F.row_number().over(w.orderBy("at", "target_id"))).withColumn("n_matches", F.sum(F.when(F.col("at.kind") == 0, 1).otherwise(0)).over(w))
    return placed.where(F.col("place") <= F.greatest(F.lit(most), F.col("n_matches"))).select("s1_id", "target_id", "place")


def merge_candidates(standard: DataFrame, tfidf: DataFrame, most: int = 50) -> DataFrame:
    """s1_id, target_id, in_standard, in_tfidf, tfidf, place: both passes first, then by similarity, then by id."""
    m = standard.select("s1_id", "target_id", F.lit(True).alias("in_standard")).join(tfidf.select("s1_id", "target_id", F.col("score").alias("tfidf"), F.lit(True).alias("in_tfidf")), ["s1_id", "target_id"], "full")
    m = m.fillna(False, ["in_standard", "in_tfidf"]).fillna(0.0, ["tfidf"])
    both = (F.col("in_standard") & F.col("in_tfidf")).cast("int")
    return m.withColumn("place", F.row_number().over(Window.partitionBy("s1_id").orderBy(both.desc(), F.col("tfidf").desc(), "target_id"))).where(F.col("place") <= most)


def multipass_audit(merged: DataFrame, ent: DataFrame) -> DataFrame:
    """One row: merged candidates by the passes that found them, and the true pairs (of equal text) among them. A pair counts once for each
    row of truth_pairs() that it meets, once if there is none.

    The true pairs aren't made, as a group of copies has the square of its size: candidates carry the texts of their anchor, if a target has
    them too, to the texts of their target."""
    texts = ent.select("entity_id", (F.col("src") == "S1").alias("anchor"), F.unhex("text_md5").alias("x"))
    a = texts.where("anchor").join(texts.where("not anchor").select("x").distinct(), "x", "left_semi").groupBy(F.col("entity_id").alias("s1_id")).agg(F.collect_list("x").alias("xs"))
    t = texts.where("not anchor").groupBy(F.col("entity_id").alias("target_id")).agg(F.collect_list("x").alias("ys"))
    m = merged.select("s1_id", "target_id", "in_standard", "in_tfidf").join(a, "s1_id", "left").drop("s1_id").join(t, "target_id", "left")
    same = F.flatten(F.transform("xs", lambda x: F.filter("ys", lambda y: y == x)))
    m = m.withColumn("n", F.coalesce(F.when(F.col("xs").isNotNull() & F.col("ys").isNotNull(), F.size(same)), F.lit(0)))
    s, f, rows = F.col("in_standard"), F.col("in_tfidf"), F.greatest("n", F.lit(1))
    total = lambda c, when=F.lit(True): F.coalesce(F.sum(F.when(when, c)), F.lit(0)).cast("long")
    return m.agg(total(rows).alias("pairs"), total(rows, s & ~f).alias("standard_only"), total(rows, f & ~s).alias("tfidf_only"), total(rows, s & f).alias("both"), total(F.col("n")).alias("true_found"))


def output_diff(old: DataFrame, new: DataFrame, col: str) -> DataFrame:
    """One row: rows in both, changed, only in one, and targets in each, of two tables of s1_id and an array."""
    j = old.select("s1_id", F.col(col).alias("x")).join(new.select("s1_id", F.col(col).alias("y")), "s1_id", "full")
    size = lambda c: F.coalesce(F.sum(F.size(c)), F.lit(0)).cast("long")
    return j.agg(F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("both"), F.count_if(F.array_sort("x") != F.array_sort("y")).alias("changed"), F.count_if(F.col("y").isNull()).alias("only_old"), F.count_if(F.col("x").isNull()).alias("only_new"), size("x").alias("old_targets"), size("y").alias("new_targets"))


def sweep(details: DataFrame, truth: DataFrame, parts: DataFrame, addresses: tuple[float, ...], jaccards: tuple[float, ...], tau: float = 0.58, most: int = RULE_MATCHES) -> DataFrame:
    """min_addr, min_jaccard, part, tp, fp, fn for each pair of bounds of the expansion rules, on each part (s1_id, part). Pairs are scored
    once; each setting is an element of an array, so the grid costs no join."""
    c = F.col
    grid = F.array(*[F.struct(F.lit(a).alias("min_addr"), F.lit(j).alias("min_jaccard")) for a in addresses for j in jaccards])
    x = details.where("not veto").select("s1_id", "target_id", "cand_ord", "score", "addr_sim", "overlap", "same_postal", "jaccard", F.explode(grid).alias("g"))
    lifted = ((c("addr_sim") >= c("g.min_addr")) & (c("overlap") >= 1)) | (c("same_postal") & (c("jaccard") >= c("g.min_jaccard")))
    x = x.select("s1_id", "target_id", "cand_ord", "g.*", F.when(c("score") >= tau, c("score")).when(lifted, F.lit(0.585)).otherwise(F.lit(0.0)).alias("final"))
    rank = F.row_number().over(Window.partitionBy("min_addr", "min_jaccard", "s1_id").orderBy(c("final").desc(), "cand_ord"))
    pred = x.withColumn("r", rank).where(c("r") <= most).where(c("final") >= tau)
    hits = pred.join(truth.distinct().withColumn("hit", F.lit(1)), ["s1_id", "target_id"], "left").join(parts.select("s1_id", "part"), "s1_id")
    got = hits.groupBy("min_addr", "min_jaccard", "part").agg(F.count("hit").alias("tp"), F.count_if(c("hit").isNull()).alias("fp"))
    total = truth.distinct().join(parts.select("s1_id", "part"), "s1_id").groupBy("part").agg(F.count("*").alias("n"))
    every = total.select("part", "n", F.explode(grid).alias("g")).select("part", "n", "g.*")
    out = every.join(got, ["min_addr", "min_jaccard", "part"], "left").fillna(0, ["tp", "fp"])
    return out.select("min_addr", "min_jaccard", "part", "tp", "fp", (c("n") - c("tp")).alias("fn"))


def false_positive_kinds(details: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """kind, n of predictions that aren't true, by what their names and addresses share."""
    wrong = predicted.select("s1_id", "target_id").join(truth, ["s1_id", "target_id"], "left_anti").join(details, ["s1_id", "target_id"])
    words = lambda col, keep: F.filter(F.split(F.lower(col), r"\s+"), keep)
    long, short = (lambda x: F.length(x) >= 3), (lambda x: (F.length(x) <= 2) & (x != ""))
    same = F.array_sort(F.array_distinct(words("a_name", long))) == F.array_sort(F.array_distinct(words("t_name", long)))
    c = F.col
    kind = (
        F.when(same & (words("a_name", short) != words("t_name", short)), "SHORT_ACRONYM_ERASURE").when(same & c("no_address"), "IDENTICAL_NAME_MISSING_ADDR").when(same & (c("addr_sim") > 0), "SHARED_NAME_DIFF_ADDR")
        .when((c("addr_sim") > 0.8) & (c("name_sim") < 0.5), "SHARED_ADDR_DIFF_NAME").when(c("name_sim") > 0.85, "GENERIC_BRAND_COLLISION").otherwise("OTHER_PARTIAL_OVERLAP")
    )
    return wrong.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
