"""Blocking, retrieval, scoring, decisions, metrics and audits on small hand-made tables."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.operators import blocking as B
from recordloom.operators import checks as C
from recordloom.operators import evaluate as E
from recordloom.operators import models as M
from recordloom.operators import pairs as P
from recordloom.operators import tfidf as T
from recordloom.operators.browse import matching, numbered, page, route, row_list
from recordloom.operators.normalise import normalise

ROWS = [
    ("S1-1", "Acme Widgets Inc", "12 Main Street, New York 10001", "US"),
    ("S1-2", "Sharma Traders Pvt Ltd", "5 MG Road, Pune 411001", "India"),
    ("S1-3", "Boulangerie Dupont SARL", "7 rue de Lyon 75002", "France"),
    ("S1-4", "Lonely Star Holdings", "99 Nowhere Lane", "US"),
    ("S2-1", "ACME Widgets", "12 Main St, New York 10001", "USA"),
    ("S2-2", "Sharma Traders", "5 MG Rd, Pune 411001", "India"),
    ("S2-3", "Acme Widgets", "14 Main St, New York 10001", "USA"),
    ("S3-1", "Dupont Boulangerie", "7 rue de Lyon 75002", "FR"),
    ("S3-2", "Acme Widgets", "12 Main St", "Canada"),
]


@pytest.fixture(scope="module")
def norm(spark):
    rows = [(i, i[:2], int(i[3:]), n, a, c) for i, n, a, c in ROWS]
    return normalise(spark.createDataFrame(rows, "entity_id string, src string, num long, business_name string, business_address string, country string")).cache()


@pytest.fixture(scope="module")
def scored(norm):
    keys = B.rule_keys(norm)
    return P.rule_score(B.probe_rules(keys, B.postings(keys, 300)), norm).cache()


def pairs_of(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_matches_end_to_end(scored):
    got = pairs_of(E.top_matches(scored, P.TAU), "s1_id", "target_id")
    assert got == {("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-3", "S3-1")}


def test_vetoes(scored):
    score = {(r.s1_id, r.target_id): r.score for r in scored.collect()}
    assert score["S1-1", "S2-3"] == 0 and score["S1-1", "S3-2"] == 0  # another building, another country


def test_postings_and_candidates_are_capped(spark):
    rows = [(f"S2-{i}", "S2", i, f"k{i % 2}", 0) for i in range(10)] + [("S1-1", "S1", 1, "k0", 0), ("S1-1", "S1", 1, "k1", 1)]
    keys = spark.createDataFrame(rows, "entity_id string, src string, num long, key string, key_ord int")
    posts = B.postings(keys, 2)
    assert pairs_of(posts, "key", "target_id") == {("k0", "S2-0"), ("k0", "S2-2"), ("k1", "S2-1"), ("k1", "S2-3")}
    assert [r.target_id for r in B.probe_rules(keys, posts, 3).orderBy("cand_ord").collect()] == ["S2-0", "S2-2", "S2-1"]
    assert B.probe_standard(keys, posts, 3).count() == 3


def test_keys(norm):
    keys = {r.key for r in B.rule_keys(norm).where("entity_id = 'S1-1'").collect()}
    assert {"NC:acme widgets", "NCONCAT:acmewidgets", "NS:acme_widgets", "NP:acme_widgets", "ADDR_N1:10001_acme", "PIN_N1:10001_acme", "ADDR_WW:12_main"} <= keys and "N1L:acme" not in keys
    standard = {r.key for r in B.standard_keys(norm).where("entity_id = 'S1-1'").collect()}
    assert standard == {"NAME_CANON:acme widgets", "CTRY_NAME:US:acme widgets", "NAME_SORTED:acme widgets", "POSTAL_NAME:10001:acme", "NAME_2TOK:acme_widgets"}
    assert B.targets_with_keys(B.standard_keys(norm)).count() == 5


def test_standard_probe_pairs_few_postings(spark):
    """Pairing only a key's smallest postings gives what the union of all postings gives."""
    rows = [("S1", i, f"S1-{i}", k) for i in range(200) for k in ("a", f"b{i % 3}")] + [("S2", i, f"S2-{i}", k) for i in range(400) for k in ("a", f"b{i % 3}", "c")]
    keys = spark.createDataFrame(rows, "src string, num long, entity_id string, key string")
    got = {}
    posts = B.postings(keys, 300)
    for r in B.probe_standard(keys, posts, 5).collect():
        got.setdefault(r.s1_id, set()).add(r.target_id)
    first = {}
    for r in posts.collect():
        first.setdefault(r.key, set()).add(r.target_id)
    assert got == {f"S1-{i}": set(sorted(first["a"] | first[f"b{i % 3}"])[:5]) for i in range(200)}


def test_retrieval(spark):
    docs = spark.createDataFrame([("d1", "starbucks coffee"), ("d2", "mcdonalds"), ("d3", "acme logistics"), ("d4", "coffee house"), ("d5", "")], "id string, x string")
    tf = T.counts(docs, "id", "x")
    model = T.idf(tf, 5)
    index = T.unit_vectors(tf, model)
    queries = T.unit_vectors(T.counts(spark.createDataFrame([("q1", "starbuks coffee"), ("q2", "zzzz"), ("q3", "acme logistics")], "id string, x string"), "id", "x"), model)
    got = {(r.s1_id, r.target_id): r.score for r in T.top_k(queries, index, k=1).collect()}
    assert got["q1", "d1"] > 0.55 and got["q3", "d3"] == pytest.approx(1.0) and len(got) == 2


def test_retrieval_of_copies_and_blocks(spark):
    """All of brute force in any deal of blocks; copies of a name are scored once."""
    import random

    rng = random.Random(3)
    words = ["acme", "widget", "north", "star", "coffee", "house", "logistics", "été", "व्यापार"]
    names = [" ".join(rng.choices(words, k=rng.randint(0, 4))) for _ in range(60)]
    rows = [(f"S{i % 3 + 1}-{i}", rng.choice(names), i % 3 != 0) for i in range(300)]
    texts = {i: x for i, x, _ in rows}
    targets, anchors = [i for i, _, t in rows if t], [i for i, _, t in rows if not t]
    grams = {i: Counter(f"#{x}#"[j : j + 3] for j in range(len(x))) for i, x in texts.items()}
    df = Counter(g for i in targets for g in grams[i])
    n = len(targets)
    w = {i: {g: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[g])) + 1) for g, c in grams[i].items() if 0 < df[g] <= n * 0.8} for i in texts}
    norm = {i: math.sqrt(math.fsum(x * x for x in v.values())) for i, v in w.items()}
    want = set()
    for a in anchors:
        scored = [(-round(s, 4), t) for t in targets if norm[a] and norm[t] and (s := math.fsum(x * w[t].get(g, 0) for g, x in w[a].items()) / norm[a] / norm[t]) >= 0.35]
        want |= {(a, t, -s) for s, t in sorted(scored)[:5]}
    df = spark.createDataFrame(rows, "id string, text string, target boolean")
    for block in (10, 100_000):
        assert {tuple(r) for r in T.similar_texts(df, k=5, block=block).collect()} == want
    copies = [(f"S{1 + i % 2}-c{i}", "one name that many rows have", i % 2 == 1) for i in range(1200)]
    got = [tuple(r) for r in T.similar_texts(spark.createDataFrame(copies + rows, "id string, text string, target boolean"), k=2).where(F.col("s1_id").startswith("S1-c")).collect()]
    assert sorted(got) == sorted((a, t, 1.0) for a, _, t in copies if not t for t in ("S2-c1", "S2-c1001"))
    assert T.similar_texts(df.where("not target")).count() == T.similar_texts(df.where("target")).count() == T.similar_texts(df.limit(0)).count() == 0
    assert T.rounded(np.array([0.12345, 0.4, 0.99995, 0.123449])).tolist() == [1235, 4000, 10000, 1234]


def test_features(norm, spark):
    pairs = spark.createDataFrame([("S1-1", "S2-1", True, True, 0.9), ("S1-1", "S2-3", True, False, 0.0), ("S1-1", "S3-2", False, False, 0.0)], "s1_id string, target_id string, in_standard boolean, in_tfidf boolean, tfidf double")
    f = {r.target_id: r for r in P.pair_features(pairs, norm).collect()}
    assert len(P.FEATURES) == 33 and all(0 <= v for r in f.values() for v in r[2:])
    assert f["S2-1"].name_canonical_exact_match == 1 and f["S2-1"].retrieved_by_both == 1 and f["S2-1"].address_numeric_contradiction == 0
    assert f["S2-3"].address_numeric_contradiction == 1 and f["S2-3"].name_high_address_contradiction == 1
    assert f["S3-2"].country_contradiction == 1 and f["S3-2"].name_exact_diff_country == 1
    decisions = {r.target_id: r for r in P.baseline(P.pair_features(pairs, norm)).collect()}
    assert decisions["S2-1"].is_match and decisions["S2-1"].confidence == 0.96 and decisions["S3-2"].rule == "REJECT_COUNTRY_CONTRADICTION" and decisions["S2-3"].rule == "REJECT_ADDRESS_NUMERIC_CONTRADICTION"


def test_composite_reads_features(norm, spark):
    """The plan says each edit distance once; without the generator the composite repeated them."""
    pairs = spark.createDataFrame([("S1-1", "S2-1", True, True, 0.9)], "s1_id string, target_id string, in_standard boolean, in_tfidf boolean, tfidf double")
    plan = P.pair_features(pairs, norm).select("overall_composite_similarity")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan and plan.count("levenshtein(") <= 2


def frame(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, target_id string")


def test_metric_values(spark):
    anchors = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "s1_id string")
    truth = frame(spark, [("a", "S2-47"), ("a", "S3-812"), ("c", "S2-1")])
    pred = frame(spark, [("a", "S2-47"), ("a", "S2-193"), ("a", "S3-812"), ("d", "S2-9"), ("d", "S2-9")])
    r = {x.s1_id: x for x in E.entity_scores(anchors, truth, pred).collect()}
    assert r["a"].f05 == pytest.approx(5 / 7) and r["a"].precision == pytest.approx(2 / 3) and r["a"].recall == 1
    assert (r["b"].f05, r["c"].f05, r["d"].f05) == (1, 0, 0) and r["d"].fp == 1 and r["c"].fn == 1
    m = E.macro(E.entity_scores(anchors, truth, pred)).first()
    assert m.singletons == 2 and m.singleton_f05 == 0.5 and m.zero == 2 and m.perfect == 1
    assert E.micro(E.entity_scores(anchors, truth, pred)).first().tp == 2


def test_macro_of_the_mixed_fixture(spark):
    anchors = spark.createDataFrame([(f"a{i}",) for i in range(100)], "s1_id string")
    truth = frame(spark, [(f"a{i}", t) for i in range(15, 100) for t in ("S2-1", "S3-1")])
    pred = frame(spark, [(f"a{i}", "S2-9") for i in range(10, 15)] + [(f"a{i}", t) for i in range(15, 85) for t in ("S2-1", "S3-1")])
    m = E.macro(E.entity_scores(anchors, truth, pred)).first()
    assert (m.macro_f05, round(m.singleton_f05, 4), round(m.matched_f05, 4), m.perfect, m.zero) == (0.8, 0.6667, 0.8235, 80, 20)


def test_error_kinds(spark):
    anchors = spark.createDataFrame([(x,) for x in "abcde"], "s1_id string")
    truth = frame(spark, [("a", "S2-1"), ("b", "S2-2"), ("b", "S3-2"), ("c", "S2-3"), ("c", "S3-3")])
    pred = frame(spark, [("a", "S2-1"), ("c", "S2-3"), ("c", "S2-8"), ("d", "S2-9")])
    cands = frame(spark, [("a", "S2-1"), ("b", "S2-2"), ("c", "S2-3"), ("c", "S3-3"), ("c", "S2-8"), ("d", "S2-9")])
    got = pairs_of(E.error_records(E.pair_outcomes(anchors, truth, pred, cands)), "s1_id", "target_id", "error_type")
    assert got == {("b", "S3-2", "BLOCKING_MISS"), ("b", None, "SINGLETON_FALSE_DISMISSAL"), ("c", "S3-3", "MODEL_FALSE_NEGATIVE"), ("c", "S2-8", "MODEL_FALSE_POSITIVE"), ("d", "S2-9", "SINGLETON_FALSE_MERGE")}
    audit = E.recall_audit(anchors, truth, cands).first()
    assert audit.true_pairs == 5 and audit.found_pairs == 4 and audit.median_candidates == 1 and audit.max_candidates == 3


def test_prune_and_merge(spark):
    matches = spark.createDataFrame([("a", f"S2-{i}", i) for i in range(1, 4)], "s1_id string, target_id string, rank int")
    cands = spark.createDataFrame([("a", f"S2-{9 - i}", i) for i in range(9)] + [("b", "S2-1", 1)], "s1_id string, target_id string, cand_ord int")
    got = [r.target_id for r in E.prune(matches, cands, 5).where("s1_id = 'a'").orderBy("place").collect()]
    assert got == ["S2-1", "S2-2", "S2-3", "S2-9", "S2-8"] and E.prune(matches, cands, 1).where("s1_id = 'a'").count() == 3
    tfidf = spark.createDataFrame([("a", "S2-1", 0.4), ("a", "S2-7", 0.9)], "s1_id string, target_id string, score double")
    order = [r.target_id for r in E.merge_candidates(frame(spark, [("a", "S2-1"), ("a", "S2-0")]), tfidf, 2).orderBy("place").collect()]
    assert order == ["S2-1", "S2-7"]


def test_threshold_curve(spark):
    anchors = spark.createDataFrame([("a",), ("b",)], "s1_id string")
    truth = frame(spark, [("a", "S2-1")])
    scored = spark.createDataFrame([("a", "S2-1", 0.7, 1), ("b", "S2-2", 0.5, 1)], "s1_id string, target_id string, score double, cand_ord int")
    curve = E.threshold_curve(anchors, truth, scored, taus=(0.4, 0.6, 0.65, 0.8))
    assert {r.tau: r.macro_f05 for r in curve.collect()} == {0.4: 0.5, 0.6: 1.0, 0.65: 1.0, 0.8: 0.5} and E.best_threshold(curve).first().tau == 0.6


def test_contract(spark):
    anchors, targets = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string"), spark.createDataFrame([("S2-1",), ("S2-2",)], "target_id string")
    matches = frame(spark, [("S1-1", "S2-1"), ("S1-1", "S2-1"), ("S1-9", "S2-2"), ("S1-1", "S1-1"), ("S1-1", "S2-7")])
    got = pairs_of(C.contract(anchors, targets, matches, frame(spark, [("S1-1", "S2-1")])), "rule", "n")
    assert got == {("UNKNOWN_ANCHOR", 1), ("UNKNOWN_TARGET", 2), ("NOT_A_TARGET_ID", 1), ("SELF_MATCH", 1), ("REPEATED_TARGET", 1), ("MATCH_NOT_A_CANDIDATE", 3), ("ANCHOR_WITHOUT_CANDIDATES", 1)}


def test_models(spark):
    rows = [(f"a{i}", f"S2-{i}", float(i % 10) / 10, float(i * 7 % 13), int(i % 10 >= 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "s1_id string, target_id string, x double, noise double, label int")
    for model in (M.fit_logistic(df, ["x", "noise"]), M.fit_stumps(df, ["x", "noise"], trees=5), M.fit_logistic(df.limit(1), ["x"])):
        again = type(model).from_json(model.to_json())
        assert df.select(F.max(F.abs(model.score() - again.score()))).first()[0] == 0
    good = df.select((F.round(M.fit_stumps(df, ["x", "noise"], trees=5).score()) == F.col("label")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert good == 1.0 and df.select((F.round(M.fit_logistic(df, ["x", "noise"]).score()) == F.col("label")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0] > 0.95
    steps = M.calibrate(df.withColumn("score", F.col("x")))
    assert [p for _, p in steps] == sorted(p for _, p in steps)
    assert df.select(F.max(M.calibrated(F.col("x"), steps))).first()[0] == 1.0
    assert spark.range(1).select(M.hybrid_score(F.lit(1.0), F.lit(0.5), F.lit(False))).first()[0] == pytest.approx(0.8)


def test_splits(spark):
    anchors = spark.createDataFrame([(f"S1-{i}", "US" if i % 2 else "INDIA") for i in range(40)], "s1_id string, country string")
    truth = frame(spark, [(f"S1-{i}", f"S2-{i}") for i in range(0, 40, 4)])
    parts = M.split(anchors, truth)
    assert pairs_of(parts, "s1_id", "part") == pairs_of(M.split(anchors.repartition(5), truth), "s1_id", "part")
    assert parts.where("part = 'valid'").count() == 8 and M.split_audit(parts, truth).first().shared_targets == 0
    cands = frame(spark, [(f"S1-{i}", f"S2-{j}") for i in range(3) for j in range(20)])
    s = M.pair_summary(M.labelled_pairs(cands, truth)).first()
    assert (s.positives, s.negatives, s.anchors) == (1, 15, 3)


def test_browsing(norm):
    rows = numbered(norm, bins=3)
    assert [r.entity_id for r in rows.orderBy("n").collect()] == [r[0] for r in ROWS]
    assert [r.n for r in page(rows, 2, 3).orderBy("n").collect()] == [3, 4, 5] and page(rows, -5, 0).count() == 1
    assert {r.n for r in row_list(rows, "1, #3, 7-8, 2-900, x").collect()} == {1, 3, 7, 8}
    assert matching(norm, name="acme", country="usa").count() == 2
    assert route("#7", "all", 9) == ("row", 7) and route("70", "all", 9) == ("search", "70") and route("x", "name", 9) == ("name", "x")


def test_feature_queries_compute_what_they_return(spark):
    """The cosines in Python are the dearest features; norm is made once, so nothing behind the candidates reads the table again."""
    from recordloom.plans import registry

    for name, cosines in (("features_provenance", 0), ("features_address", 1), ("features_name", 1), ("features_cross", 2)):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert len({m for m in re.findall(r"gram_cosine\(.*?\)#(\d+)", plan)}) == cosines, name
        assert "documents.parquet" not in plan and "Relation [" not in plan, name


def test_threshold_on_the_composite_by_bounds(spark, norm):
    """Pairs that names, countries and numbers decide need no address; the result is that of the features, for repeated ids as well."""
    odd = [("S1-8", "S1", 8, "", "", ""), ("S1-9", "S1", 9, "!!!", None, "US"), ("S2-8", "S2", 8, None, "1 Main St", "USA"), ("S2-9", "S2", 9, "!!!", "n/a", None), ("S3-9", "S3", 9, "Acme Widgets", "12 Elm Road", "US")]
    more = norm.unionByName(normalise(spark.createDataFrame(odd, "entity_id string, src string, num long, business_name string, business_address string, country string"))).cache()
    cross = lambda n: n.where("src = 'S1'").select(F.col("entity_id").alias("s1_id")).distinct().crossJoin(n.where("src <> 'S1'").select(F.col("entity_id").alias("target_id")).distinct())
    for rows in (norm, more, norm.unionByName(norm.where("num = 1"))):
        pairs = cross(rows)
        features = P.pair_features(pairs.withColumns({"in_standard": F.lit(False), "in_tfidf": F.lit(True), "tfidf": F.lit(0.5)}), rows).cache()
        values = sorted({r[0] for r in features.select("overall_composite_similarity").collect()})
        for least in (0.3, values[len(values) // 2], values[-1]):
            want = features.where(F.col("overall_composite_similarity") >= least)
            assert Counter(tuple(r) for r in P.at_least(pairs, rows, least).collect()) == Counter(tuple(r) for r in want.select("s1_id", "target_id").collect())
    low_high = P._bounds(cross(norm), norm).where("low >= 0.3 or high < 0.3").count()
    assert low_high > 10  # most are decided


def test_cross_features_read_only_what_they_are_made_of(norm):
    pairs = norm.where("src = 'S1'").select(F.col("entity_id").alias("s1_id")).crossJoin(norm.where("src <> 'S1'").select(F.col("entity_id").alias("target_id"))).withColumns({"in_standard": F.lit(True), "in_tfidf": F.lit(True), "tfidf": F.lit(0.5)})
    whole = {(r.s1_id, r.target_id): r for r in P.pair_features(pairs, norm).collect()}
    for name in P.CROSS:
        df = P.pair_features(pairs, norm, [name])
        assert {(r.s1_id, r.target_id): r[name] for r in df.collect()} == {k: r[name] for k, r in whole.items()}
        assert "name_numeric_overlap" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_of_retrieval_send_few_vectors():
    """With one pile of documents and twelve of queries, each document was sent twelve times."""
    assert T.grid(58_008, 110_763) == (4, 3)
    for n, m in ((0, 0), (10, 10), (700, 100), (58_008, 110_763), (3_000_000, 9_000_000)):
        a, b = T.grid(n, m)
        assert a * b >= min(T.TASKS, -(-n // T.FEW)) and a * T.BLOCK >= n and b * T.BLOCK >= m
        assert m * a + 2 * n * b <= m * max(-(-n // T.BLOCK), min(T.TASKS, -(-n // T.FEW)), 1) + 2 * n * max(-(-m // T.BLOCK), 1)


def test_subset_violations_compute_only_pairs_of_one_pass(spark):
    """The standard candidates aren't made again from the table: the plan reads only what was cut."""
    from recordloom.plans import registry

    plan = registry.QUERIES["subset_violations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "documents.parquet" not in plan and "Relation [" not in plan and "name_numeric_overlap" not in plan


def test_multipass_audit_makes_no_true_pairs(spark):
    """Copies are compared by text; the square of a group is never made. Repeated ids and null texts count as in the join."""
    rows = [(f"S{i % 3 + 1}-{i}", f"S{i % 3 + 1}", "ab" * 16 if i < 30 else None if i < 36 else f"{i:032x}") for i in range(60)]
    rows += [("S1-0", "S1", "cd" * 16), ("S2-1", "S2", "cd" * 16), ("S2-1", "S2", "ab" * 16), ("S1-0", "S1", "ab" * 16)]
    ent = spark.createDataFrame(rows, "entity_id string, src string, text_md5 string")
    merged = spark.createDataFrame([(f"S1-{3 * i}", f"S2-{3 * j + 1}", i % 2 == 0, j % 3 == 0 or i % 2 == 1) for i in range(20) for j in range(20)] + [("S1-0", "S2-99", True, False)], "s1_id string, target_id string, in_standard boolean, in_tfidf boolean")
    from recordloom.sources.entities import truth_pairs

    m = merged.join(truth_pairs(ent).withColumn("t", F.lit(1)), ["s1_id", "target_id"], "left")
    s, f = F.col("in_standard"), F.col("in_tfidf")
    want = m.agg(F.count("*"), F.count_if(s & ~f), F.count_if(f & ~s), F.count_if(s & f), F.count("t")).first()
    got = E.multipass_audit(merged, ent)
    assert tuple(got.first()) == tuple(want) and want[0] > merged.count() and want[4] > 100
    assert tuple(E.multipass_audit(merged.limit(0), ent).first()) == (0, 0, 0, 0, 0)
    assert [x.dataType.simpleString() for x in got.schema] == ["bigint"] * 5
    from recordloom.plans import registry

    plan = registry.QUERIES["multipass_audit"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Join Inner, \(text_md5", plan)
