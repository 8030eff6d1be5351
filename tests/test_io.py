"""Files, streams, and the driver's entry points."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from recordloom.operators.normalise import normalise
from recordloom.sources import entities as S
from recordloom.sources import sinks
from recordloom.streaming.match import request_counts, stream_matches

SF = "/root/testdata/sf0.001"


def test_entity_files(spark, tmp_path):
    path = tmp_path / "source1_train.tsv"
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t\"Acme\" \tn/a\tUS\nS1-2\tx\ty\n\n S1-3\tUndefined\ta\tUS\nS2-1\tx\ty\tUS\nS1-x\tx\ty\tUS\nS1-4\tx\ty\tnull\n")
    good, bad = S.scan_entities(spark, str(path), S.expected_prefix(path.name))
    assert [tuple(r) for r in good.collect()] == [("S1-1", '"Acme"', "", "US")]
    assert sorted(r.reason for r in bad.collect()) == ["COLUMN_COUNT", "COUNTRY_MISSING", "ID_FORM", "ID_PREFIX", "NAME_MISSING"]
    assert [S.expected_prefix(x) for x in ("source3_test.tsv", "s2.tsv", "truth.tsv")] == ["S3-", "S2-", None]


def test_truth_file(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2 S1-9\nS1-2\t\nS1-3\nbad\tS2-1\n")
    assert {r.s1_id: r.targets for r in S.scan_truth(spark, str(tmp_path / "t.tsv")).collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": [], "S1-3": []}


def test_manifest(spark, tmp_path):
    d = tmp_path / "files"
    d.mkdir()
    (d / "a.tsv").write_text("x\ny\n")
    (d / "b.tsv").write_text("1\n")
    old = S.manifest(spark, str(d))
    a = old.where(F.col("path").endswith("a.tsv")).first()
    assert (a.bytes, a.lines, a.sha256) == (4, 2, hashlib.sha256(b"x\ny\n").hexdigest())
    old = spark.createDataFrame(old.collect(), old.schema)
    (d / "b.tsv").write_text("2\n")
    (d / "a.tsv").unlink()
    (d / "c.tsv").write_text("3\n")
    assert {r.path[-5:]: r.change for r in S.manifest_changes(old, S.manifest(spark, str(d))).collect()} == {"a.tsv": "MISSING", "b.tsv": "CONTENT", "c.tsv": "ADDED"}


def test_list_outputs(spark, tmp_path):
    anchors = spark.createDataFrame([("S1-2",), ("S1-1",)], "s1_id string")
    pairs = spark.createDataFrame([("S1-1", "S2-5", 2), ("S1-1", "S3-1", 1), ("S1-1", " S2-5", 3), ("S1-1", "S1-1", 0), ("S1-1", "", 0)], "s1_id string, target_id string, rank int")
    sinks.write_tsv(sinks.list_rows(anchors, pairs, "matched_entity_ids", "rank"), str(tmp_path / "out"))
    lines = [x for f in sorted((tmp_path / "out").glob("*.csv")) for x in f.read_text().splitlines()]
    assert [x for x in lines if not x.startswith("source1")] == ["S1-1\tS3-1,S2-5", "S1-2\t"]
    sinks.write_report(anchors, str(tmp_path / "report"))
    assert sorted(json.loads(x)["s1_id"] for f in (tmp_path / "report").glob("*.json") for x in f.read_text().splitlines()) == ["S1-1", "S1-2"]


def test_point_cloud(spark):
    points = sinks.point_cloud(S.entities(spark, SF)).collect()
    assert all(abs(p.x) <= 165 and abs(p.y) <= 130 and abs(p.z) <= 150 and p.colour in range(4) for p in points) and len(points) == 200


def test_stream_equals_batch(spark, tmp_path):
    ent = S.entities(spark, SF)
    anchors = ent.where("src = 'S1'")
    anchors.repartition(3).write.parquet(str(tmp_path / "in"))
    targets = normalise(ent.where("src <> 'S1'")).cache()
    stream = spark.readStream.schema(anchors.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream_matches(stream, targets, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert q.awaitTermination(240)
    got = {(r.s1_id, r.target_id, round(r.score, 9)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = __spark_entry__.queries()["match_topk"](spark, SF)
    assert {(a, b) for a, b, _ in got} >= {(r.s1_id, r.target_id) for r in want.collect()}


def test_request_counts_of_a_stream(spark, tmp_path):
    rows = [(i, i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "i long, user_id long").select("user_id", F.timestamp_seconds(F.col("i") / 10).alias("ts"))
    df.write.parquet(str(tmp_path / "ev"))
    batch = request_counts(df, limit=150)
    assert batch.where("limited").count() > 0
    stream = request_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "ev")), limit=150, late="0 seconds")
    q = stream.writeStream.outputMode("update").format("memory").queryName("req").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("req").collect()} == {tuple(r) for r in batch.collect()}


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["s1_id", "target_id", "score", "rank"]


@pytest.mark.parametrize("name", ["match_topk", "macro_f05", "error_taxonomy", "validation_report", "features_cross", "hash_split"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "labels", "events"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    r = c.execute(__spark_entry__.oracle_sql()[name])
    cols = [d[0] for d in r.description]
    norm = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
    want = sorted((norm(x) for x in r.fetchall()), key=repr)
    got = sorted((norm(x) for x in __spark_entry__.queries()[name](spark, SF).select(*cols).collect()), key=repr)
    assert got == want


def test_every_oracle_has_its_query():
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 70


def test_works_without_the_corpus_operators(tmp_path):
    """The engine without its corpus subpackage and pipeline."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__spark_entry__.__file__).parent
    shutil.copytree(top / "recordloom", tmp_path / "recordloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'match_topk' in q and not any(n.startswith('op') for n in q if n[2:3].isdigit()) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}, check=True)
