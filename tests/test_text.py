"""Normalisation and similarity against worked values."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.functions import fuzzy
from recordloom.functions import similarity as S
from recordloom.functions.text import char_ngrams, clean_field, fold
from recordloom.operators.normalise import normalise_addresses, normalise_countries, normalise_names

NAMES = {
    "Acme Corporation": ("acme", "corp"),
    "Reliance Industries Ltd": ("reliance", "industries"),  # the longest form names it
    "Reliance Industries Private Limited": ("reliance", "pvt ltd"),
    "RELIANCE INDUSTRIES PVT. LTD.": ("reliance", "industries"),
    "Reliance Pvt. Ltd.": ("reliance", "pvt ltd"),
    "Café Société SARL": ("cafe societe", "sarl"),
    "M/s Sharma Traders": ("sharma traders", None),
    "https://www.globex.com/about": ("globex", None),
    "Globex 555-123-4567 Inc": ("globex", "inc"),
    "Limited": ("limited", "ltd"),
    "Dr": ("dr", None),
    "  ": ("", None),
    None: ("", None),
    "nan": ("nan", None),
    "😀 Emoji‍ Shop": ("emoji shop", None),
}


def test_names(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "business_name string")
    got = {r.business_name: (r.name_canonical, r.name_suffix) for r in normalise_names(df).collect()}
    assert got == NAMES
    exact = {r.business_name: (r.name_canonical, r.name_suffix) for r in normalise_names(df, folded=fuzzy.fold_any("name_raw")).collect()}
    assert exact == NAMES


def test_name_parts(spark):
    df = spark.createDataFrame([("beta alpha beta Ltd",), ("",), ("x" * 10_000,)], "business_name string")
    r = normalise_names(df).collect()
    assert r[0].name_tokens == ["beta", "alpha", "beta"] and r[0].name_sorted == ["alpha", "beta"] and r[1].name_tokens == [] and len(r[2].name_canonical) == 10_000


def test_extended_names(spark):
    df = spark.createDataFrame([("The Acme Traders dba Other Name",), ("globexworldcom",), ("The",)], "business_name string")
    assert [r.name_canonical for r in normalise_names(df, extended=True).collect()] == ["acme traders", "globexworld", "the"]


def test_hindi_names(spark):
    df = spark.createDataFrame([("गणेश ट्रेडर्स प्राइवेट लिमिटेड",), ("গণেশ",)], "business_name string")
    r = normalise_names(df, folded=fuzzy.fold_any("name_raw")).collect()
    assert r[0].name_canonical == "ganesh traders" and r[0].name_suffix == "pvt ltd" and r[1].name_canonical == "ganesh"
    assert fuzzy.indic_to_latin("plain text") == "plain text" and fuzzy.indic_to_latin("क१") == "k1"


def test_addresses(spark):
    rows = ["123 Main Street, Suite 400, 2nd Floor", "12 MG Road, Bengaluru 560066", "5 Rue de Rivoli 75002 Paris", "007 North Avenue 12345-6789", "N/A", None, "101 Main St", "105 Main St"]
    r = normalise_addresses(spark.createDataFrame([(x,) for x in rows], "business_address string")).collect()
    assert r[0].addr_numbers == ["123", "2", "400"] and r[0].addr_canonical == "123 main st ste 400 2 fl"
    assert [x.addr_postal for x in r[:4]] == [None, "560066", "75002", "12345-6789"]
    assert r[3].addr_tokens[:3] == ["7", "n", "ave"] and r[4].addr_empty and r[5].addr_empty and r[4].addr_tokens == []


def test_contradictions(spark):
    df = spark.createDataFrame([(["101"], ["105"], None, None), (["101"], ["101", "5"], None, None), (["101", "560066"], ["105", "560066"], "560066", "560066"), (["560066"], ["560066"], "560066", "560066"), ([], ["1"], None, None)], "a array<string>, b array<string>, p string, q string")
    assert [r[0] for r in df.select(S.numeric_contradiction(F.col("a"), F.col("b"), F.col("p"), F.col("q"))).collect()] == [True, False, True, False, False]


def test_countries(spark):
    rows = ["usa", "U.S.A.", "Bharat", "République Française", "Brazil", "jp", "nan", "", None, "undefined"]
    r = normalise_countries(spark.createDataFrame([(x,) for x in rows], "country string")).collect()
    assert [x.country_canonical for x in r] == ["US", "US", "INDIA", "FRANCE", "BRAZIL", "JAPAN", "", "", "", ""]
    assert [x.country_seen for x in r] == [True, True, True] + [False] * 7 and [x.country_missing for x in r] == [False] * 6 + [True] * 4
    own = normalise_countries(spark.createDataFrame([("Freedonia",)], "country string"), aliases={"freedonia": "FD"}, seen=["FD"]).first()
    assert own.country_canonical == "FD" and own.country_seen


def test_similarity_values(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    arr = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    assert one(S.jaccard(arr("a", "b", "c"), arr("b", "c", "d"))) == 0.5 and one(S.overlap(arr("a", "b", "c"), arr("b", "c", "d"))) == 2
    assert one(S.jaccard(arr(), arr())) == 0 and one(S.containment(arr("a", "b"), arr("a", "b", "c"))) == 1
    assert one(S.edit_similarity(F.lit("starbucks"), F.lit("starbuckz"))) == pytest.approx(8 / 9) and one(S.length_ratio(F.lit("cat"), F.lit("cats"))) == 0.75
    assert one(S.edit_distance(F.lit("kitten"), F.lit("sitting"), 2)) == 3 and one(S.edit_distance(F.lit("kitten"), F.lit("sitting"))) == 3
    assert one(S.edit_similarity(F.lit(""), F.lit(""))) == 1 and one(S.edit_similarity(F.lit(""), F.lit("x"))) == 0
    assert one(S.numeric_overlap(arr("acme", "77"), arr("77", "corp"))) == 1 and one(S.near_numbers(arr("9327"), arr("932"))) and not one(S.near_numbers(arr("9327"), arr("93")))
    assert one(char_ngrams(F.lit("ab"))) == ["#ab", "ab#"] and one(char_ngrams(F.lit(""))) == [] and one(char_ngrams(F.lit("a"))) == ["#a#"]
    assert one(clean_field(F.lit("  N/A "))) == "" and one(clean_field(F.lit(" x "))) == "x" and one(clean_field(F.lit(None).cast("string"))) == ""
    assert one(S.sigmoid(F.lit(0.0))) == 0.5 and one(S.sigmoid(F.lit(-1000.0))) == 0.0


def test_ratio_depends_on_order():
    assert fuzzy.ratio("tide", "diet") == 0.25 and fuzzy.ratio("diet", "tide") == 0.5 and fuzzy.ratio("", "x") == 0 and fuzzy.ratio("a", "a") == 1
    assert fuzzy.gram_cosine_of("acme", "acme") == 1 and fuzzy.gram_cosine_of("acme", "") == 0 and 0 < fuzzy.gram_cosine_of("acme", "acma") < 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.text("aàÅñçz ", max_size=6), st.text("aàÅñçz ", max_size=6)), min_size=1, max_size=8))
def test_jaccard_is_symmetric_and_folding_agrees(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    x, y = F.split("a", " "), F.split("b", " ")
    for r in df.select("a", S.jaccard(x, y).alias("p"), S.jaccard(y, x).alias("q"), fold(F.col("a")).alias("f")).collect():
        assert r.p == r.q and 0 <= r.p <= 1 and r.f.strip() == fuzzy.fold_text(r.a)
