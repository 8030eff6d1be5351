"""The pipeline's stages on the smallest table and on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(out := str(tmp_path / name))
        docs = spark.read.parquet(out)
        ids = {r[0] for r in docs.select("doc_id").collect()}
        assert ids <= before and len(ids) > 0.8 * len(before)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "quality":
            bad = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").select("doc_id")
            good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
            assert docs.join(bad, "doc_id").count() == 0 and docs.join(good, "doc_id").count() == good.count()
        if name == "near_duplicates":
            assert docs.groupBy(F.md5("text")).count().where("count > 1").count() == 0
        before = ids
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("few", [500_000, 0])
def test_odd_rows(spark, few, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "FEW_IDS", few)
    rows = [(None, None, None, None, None, 1), (None, "a b c d e f", "en", None, 11, 2), (1, "a b c d e f", "en", "s", 11, 3), (1, "a b c d e f", "en", "s", 11, 3), (2, "a b c d e f", None, "s", 11, 3), (3, "", "en", "s", 0, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, gone int")
    for d, n in ((docs, 5), (docs.limit(0), 0)):
        assert corpus_pipeline.line_stage(spark, d, SF).columns == docs.columns
        kept = corpus_pipeline.near_duplicate_stage(spark, d, SF)
        assert kept.columns == docs.columns and kept.count() == n
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, d, SF).count()


@pytest.mark.parametrize("few", [500_000, 0])
def test_boilerplate_of_any_share_goes_and_copies_stay(spark, few, monkeypatch):
    monkeypatch.setattr(corpus_pipeline.line_dedup.independent_lines, "__defaults__", (10, 80, 5, few, "text", "source"))
    menu = ["home news sport weather travel culture money", " read our terms and our privacy notice here ", "all rights are with the owner of this site"]
    own = [" ".join(f"own{i}x{j}" for j in range(4 if i < 6 else 60)) for i in range(12)]
    rows = [(i, "\n".join([menu[0], own[i], *menu[1:]]), "en", f"s{i}", 0) for i in range(12)]
    rows.append((20, "\n".join(menu), "en", "s0", 0))  # nothing else
    story = ["\n".join(" ".join(f"line{k}word{j}" for j in range(30)) for k in range(4)) + (f" end{i}" if i % 2 else "") for i in range(12)]
    rows += [(30 + i, t, "en", f"s{i}", 0) for i, t in enumerate(story)]  # exact and near copies on all sites
    rows += [(50, own[0], "en", "s1", 0), (None, None, None, None, None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), SF).collect()}
    assert len(got) == len(rows) and got[20] == ("", 0) and got[None] == (None, None)
    assert all(got[i] == (own[i], len(own[i])) for i in range(12))
    assert all(got[30 + i] == (t, 0) for i, t in enumerate(story)) and got[50] == (own[0], 0)


def test_near_duplicates_link_five_words_at_four_fifths(spark):
    r = random.Random(4)
    rows = []
    for i in range(0, 60, 2):  # pairs of 5-word likeness about 0.8, by one to three words changed
        w = [f"w{r.randrange(10**6)}" for _ in range(r.randint(40, 130))]
        v = list(w)
        for _ in range(1 + i % 3):
            v[r.randrange(len(v))] = "changed"
        rows += [(i, " ".join(w)), (i + 1, " ".join(v))]
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    like = {i: len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 60, 2)}
    assert any(0.8 <= x < 0.83 for x in like.values()) and any(0.75 < x < 0.8 for x in like.values())
    want = {i for i in sets if i % 2 == 0 or like[i - 1] < 0.8}
    assert {x.doc_id for x in corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()} == want


def test_tables_stay_apart():
    """Nothing outside the subpackage imports it."""
    import re
    from pathlib import Path

    top = Path(corpus_pipeline.__file__).parent
    for f in (top / "recordloom").rglob("*.py"):
        if "llm" not in f.relative_to(top).parts:
            assert not re.search(r"^\s*(from|import) .*\bllm\b", f.read_text(), re.M), f


def test_the_driver_gives_freed_memory_back(spark):
    """One round of the stages leaves 200 MB and more in the arenas of the driver's threads."""
    from recordloom.llm.common import trim_driver

    assert "Trim native heap" in trim_driver(spark)
