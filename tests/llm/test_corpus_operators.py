"""Operators that compare documents with each other, against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import components, fingerprint, line_dedup, mixing, ngram_join, quality, sharding, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=1, n=120):
    """Texts with exact and near copies, shared passages, repeated lines, nulls, empties and one long text."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda k: " ".join(r.choice(words) for _ in range(k))
    passage, line, base = say(60), "This line stands on every site", say(80)
    texts = [None, "", "  \n", "one", "Two words", say(4000), "ab" * 400, "x" * 1000, "x" * 1000]
    while len(texts) < n:
        kind = r.randint(0, 7)
        if kind == 0:
            texts.append(r.choice([t for t in texts if t]))
        elif kind == 1:
            w = base.split()
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(words)
            texts.append(" ".join(w))
        elif kind == 2:
            texts.append(say(r.randint(0, 30)) + " " + passage + " " + say(r.randint(0, 30)))
        elif kind == 3:
            texts.append(say(20) + "\n " + line + " \n" + say(20) + "\n\n" + line)
        else:
            texts.append(say(r.randint(1, 120)))
    return [(i * 3 % 1009, t, r.choice(["en", "fr", None]), r.choice(["s1", "s2", "s3", "s4", None, "s1", "s1"]), len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, repeated rows, and columns whose names the operators use inside."""
    names = "calc state site gone own hits k k1 k2 bin src size copies target left h p e mix key anchor cut0 text_ n".split()
    base = [(None, None, None, None, None), (None, "a b c d e", None, None, 9), (1, "a b c d e", "en", "s", 9), (1, "a b c d e", "en", "s", 9), (2, "", "en", "s", 0)]
    return spark.createDataFrame([(*b, *range(len(names))) for b in base], SCHEMA + ", " + ", ".join(f"{x} int" for x in names))


# --- fingerprints ---


def edited_brute(rows):
    order = sorted(rows, key=lambda x: (-x[0], x[1] or ""))
    out = {}
    for k, (i, t, *_) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        out[i] = (t, t[: len(t) - len(t) // 2] + nxt[: len(t) // 2], nxt)
    return out


@pytest.mark.parametrize("bits", [128, 3])
def test_edited_pairs(docs, rows, bits):
    want = edited_brute(rows)
    got = fingerprint.edited_pairs(docs, bits=bits).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    forms = {}
    for r in got:
        t, e, nxt = want[r.doc_id]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.near_edited == (fingerprint.canonical(t) == fingerprint.canonical(e)) and r.near_next == (fingerprint.canonical(t) == fingerprint.canonical(nxt))
        for text, name in ((t, r.fingerprint), (e, r.edited_fingerprint)):
            forms.setdefault(name, fingerprint.canonical(text))
            assert forms[name] == fingerprint.canonical(text)  # equal fingerprints mean equal bytes, also where hashes clash
    assert len(forms) == len(set(forms.values())) or bits == 3


def test_canonical_form():
    assert fingerprint.canonical("Ｆｕｌｌ Ｗidth ﬁ  STRASSE\n") == fingerprint.canonical("full width fi straße") == b"full width fi strasse"
    assert fingerprint.canonical("é") == fingerprint.canonical("É") and fingerprint.canonical(None) == b""


def test_clashes_by_bytes(docs, rows):
    forms = {fingerprint.canonical(t) for _, t, *_ in rows}
    buckets = defaultdict(set)
    for f in forms:
        buckets[fingerprint.digest(f, 5)].add(f)
    assert {r[0] for r in fingerprint.clashes(docs, bits=5).collect()} == {d for d, s in buckets.items() if len(s) > 1}
    assert fingerprint.clashes(docs).count() == 0
    for few in (0, 1000):  # every name widened, or those of clashing buckets
        named = fingerprint.fingerprints(docs, bits=5, few=few).select("text", "fingerprint").collect()
        assert len({(fingerprint.canonical(r.text), r.fingerprint) for r in named}) == len(forms) == len({r.fingerprint for r in named})


def test_fingerprint_corner_cases(odd):
    got = fingerprint.edited_pairs(odd).collect()
    assert len(got) == 5 and sum(r.near_next for r in got) == 1
    assert fingerprint.edited_pairs(odd.limit(0)).collect() == []
    assert len(fingerprint.edited_pairs(odd.where("doc_id is null")).collect()) == 2
    assert fingerprint.edited_pairs(odd.where("doc_id = 2")).collect()[0].near_next == 1.0


# --- quality ---


@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(5)
    good = lambda: ". ".join(" ".join(r.choice(["the", "of", "water", "river", "stone", "and", "moves", "slowly"]) for _ in range(r.randint(5, 12))).capitalize() for _ in range(r.randint(2, 8)))
    rows = []
    for i in range(400):
        t = good()
        kind = i % 5
        bad = kind in (0, 1)
        if kind == 0:
            t = " ".join(w.upper() + "!!" for w in t.split())
        elif kind == 1:
            t = " | ".join(t.split()) if i % 2 else " ".join([t.split()[0]] * 60)
        rows.append((i, t, "en", f"s{i % 7}", len(t), int(not bad)))
    return spark.createDataFrame(rows, SCHEMA + ", truth int")


def test_quality_on_held_out_documents(judged):
    labels = judged.where("doc_id < 200").select("doc_id", F.col("truth").alias("quality"))
    got = quality.classify(judged, labels).where("doc_id >= 200").select("truth", "quality.*").collect()
    assert np.mean([r.keep == bool(r.truth) for r in got]) > 0.97
    assert all(0 < r.path_rate < 1 and 0 < r.host_rate < 1 for r in got)


def test_distinct_words_are_of_the_whole_text():
    same = ["word"] * 2400
    between = [f"w{i}" if i % 6 else "word" for i in range(2400)]  # a stride of six words sees no difference
    far = quality.features([" ".join(w) for w in (same, between, [f"w{i}" for i in range(2400)])])[:, 5]
    assert 0 <= far[0] < far[1] < far[2] == 1 and far[1] > 0.9
    assert not quality.features(["", " \n"])[:, 1:].any() and quality.features([]).shape == (0, 522)


def test_features_by_brute_force(rows):
    texts = [t or "" for _, t, *_ in rows] + ["A!! b,b 12 É", "x " * 3000]
    got = quality.features(texts, piece=500)
    assert (got == quality.features(texts)).all()
    for t, x in zip(texts, got, strict=True):
        w = WORD.findall(t)
        if not w:
            continue
        raw, solid = t.encode(), "".join(w).encode()
        letters = lambda a, b, c, d: sum(a <= v < b or c <= v < d for v in raw)  # noqa: B023, E731
        low, up = letters(97, 123, 0xA0, 0xC0), letters(65, 91, 0x80, 0xA0)
        want = [1, up / max(1, low + up), sum(chr(v) in "!#$%&*+<=>@\\^_`{|}~" for v in raw) / len(raw), (len(solid) - low - up) / len(solid), sum(a == b for a, b in zip(w, w[1:], strict=False)) / len(w)]
        lower = {re.sub("[A-Z]", lambda m: m[0].lower(), y) for y in w}
        want += [math.log1p(len(lower)) / math.log1p(len(w)), math.log1p(len(w)) / 10, sum(chr(v) in ".," for v in raw) / len(w), sum(48 <= v < 58 for v in raw) / len(raw), min(3, len(solid) / len(w) / 8)]
        want[4] = sum(a.lower() == b.lower() for a, b in zip(w, w[1:], strict=False)) / len(w)
        assert x[:10] == pytest.approx(want, abs=1e-5)
        assert np.linalg.norm(x[10:266]) == pytest.approx(1, abs=1e-4)


def test_posteriors_by_brute_force(judged):
    labels = judged.where("doc_id < 150").select("doc_id", F.col("truth").alias("quality"))
    weights, base = quality.train(judged, labels)
    rows = judged.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "fr").otherwise("en")).orderBy("doc_id").collect()
    docs = judged.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "fr").otherwise("en"))
    e = 1 / (1 + np.exp(-(quality.features([r.text for r in rows]).astype(float) @ weights)))
    host, path = np.array([r.source for r in rows]), np.array([f"{r.source}/{r.lang}" for r in rows])
    n, mean = len(e), e.mean()

    def parts(g):
        groups = [e[g == x] for x in set(g)]
        return len(groups), sum(((x - x.mean()) ** 2).sum() for x in groups), sum(len(x) ** 2 for x in groups)

    def strength(k, inner, outer, n2, above):
        noise = max(inner / (n - k), 1e-9)
        return float(np.clip(noise / max((outer - inner - (k - above) * noise) / max(n - n2 / n, 1.0), 1e-9), 2, 10_000))

    (kh, wh, nh), (kp, wp, np_) = parts(host), parts(path)
    s_host, s_path = strength(kh, wh, ((e - mean) ** 2).sum(), nh, 1), strength(kp, wp, wh, np_, kh)
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    want = []
    for i in range(n):
        h, p = e[host == host[i]], e[path == path[i]]
        rate = (h.sum() - e[i] + s_host * mean) / (len(h) - 1 + s_host)
        own = (p.sum() - e[i] + s_path * rate) / (len(p) - 1 + s_path)
        want.append((e[i], rate, own, 1 / (1 + math.exp(-(logit(e[i]) - math.log(base / (1 - base)) + logit(own))))))
    for carry in (None, ["doc_id"]):
        got = quality.classify(docs, labels, carry=carry).orderBy("doc_id").select("quality.*").collect()
        assert np.array([r[:4] for r in got], dtype=float) == pytest.approx(np.array(want), abs=1e-5)


def test_sites_change_the_odds_of_equal_texts(spark, judged):
    labels = judged.where("doc_id < 200").select("doc_id", F.col("truth").alias("quality"))
    more = [(5000 + i, t, "en", s, 0) for s, t in (("good", "The river moves slowly. Stone and water of the river."), ("bad", "RIVER!! STONE!! WATER!!")) for i in range(60)]
    open_ = [(9000, "River stone!!", "en", "good", 0), (9001, "River stone!!", "en", "bad", 0)]
    got = quality.classify(judged.drop("truth").union(spark.createDataFrame(more + open_, SCHEMA)), labels).where("doc_id >= 9000").orderBy("doc_id").select("quality.*").collect()
    odds = [r.posterior / (1 - r.posterior) for r in got]
    assert got[0].evidence == got[1].evidence and odds[0] > 20 * odds[1]


def test_repeated_labelled_ids_are_one_row(spark, judged):
    labels = judged.where("doc_id < 100").select("doc_id", F.col("truth").alias("quality"))
    often = judged.union(judged).union(judged.where("doc_id < 5"))
    assert quality.train(often, labels)[0] == pytest.approx(quality.train(judged, labels)[0], abs=1e-6)
    with pytest.raises(ValueError):
        quality.classify(judged, labels, into="text")


def test_rates_are_shrunk(spark, judged):
    labels = judged.select("doc_id", F.col("truth").alias("quality"))
    few = judged.where("doc_id = 0").withColumn("source", F.lit("rare")).withColumn("doc_id", F.lit(1000).cast("long"))
    got = quality.classify(judged.drop("truth").union(few.drop("truth")), labels).select("source", "doc_id", "quality.*")
    mean = got.agg(F.avg("evidence")).first()[0]
    rare = got.where("source = 'rare'").first()
    assert rare.evidence < 0.1 and abs(rare.host_rate - mean) < 0.01  # one document says nothing about itself


def test_quality_corner_cases(spark, odd, judged):
    none = judged.limit(0).select("doc_id", F.col("truth").alias("quality"))
    got = quality.classify(odd, none, into="found")
    assert got.columns == [*odd.columns, "found"] and all(r.found.keep for r in got.collect())
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (7, 0)], "doc_id long, quality int")
    assert quality.classify(odd, labels).count() == 5 and quality.classify(odd.limit(0), labels).count() == 0
    one = [r.quality for r in quality.classify(judged, judged.select("doc_id", F.col("truth").alias("quality"))).orderBy("doc_id").collect()]
    joined = [r.quality for r in quality.classify(judged, judged.select("doc_id", F.col("truth").alias("quality")), few_paths=0).orderBy("doc_id").collect()]
    assert [x.keep for x in one] == [x.keep for x in joined]


# --- mixing ---


def test_targets(spark):
    sizes = {"=a": 10, "=b": 1000, "=c": 500, "=d": 7, "\U0010ffff": 90, "=e": 0}
    got = {r.src: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "src string, source_size long")).collect()}
    weights = dict(zip(sorted(sizes), [5, 2, 1] * 2, strict=True))
    left, open_, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        level = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if level * weights[s] > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            want[s] = 2 * sizes[s]
            left -= want[s]
            open_.discard(s)
    want |= {s: level * weights[s] for s in open_}
    assert got == pytest.approx(want)


def test_mix(docs, rows):
    got = mixing.mix_report(docs).collect()
    text = {i: t or "" for i, t, *_ in rows}
    source = {i: s for i, _, _, s, _ in rows}
    assert all(r.size == len(WORD.findall(text[r.doc_id])) for r in got) and len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[source[r.doc_id]].append(r)
        assert r.taken in (0, r.size, 2 * r.size)
    total = sum(r.size for r in got)
    assert sum(g[0].target for g in by.values()) == pytest.approx(1.5 * total)
    for g in by.values():
        size = sum(r.size for r in g)
        assert g[0].source_size == size and g[0].target <= 2 * size + 1e-9
        sizes = sorted(r.size for r in g if r.size)
        assert abs(g[0].target - sum(r.taken for r in g)) <= max(3, 0.02 * size, 0.51 * max(sizes) if len(sizes) < 40 else 0)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_report(docs.repartition(5)).collect()))
    joined = mixing.take_counts(docs, few_sources=0).select("doc_id", "mix.copies").collect()
    assert sorted(map(tuple, joined)) == sorted((r.doc_id, c.copies) for r, c in zip(sorted(got, key=lambda r: r.doc_id), sorted(mixing.take_counts(docs).select("doc_id", "mix.copies").collect(), key=lambda r: r.doc_id), strict=True))


def test_heavier_documents_come_first(spark):
    df = spark.createDataFrame([(i, "w " * 10, "en", "a" if i < 4000 else "b", 20) for i in range(4400)], SCHEMA)
    taken = mixing.take_counts(df, quality=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)).where("doc_id < 4000 and mix.copies = 2").select("doc_id").collect()
    share = np.mean([r.doc_id % 2 == 0 for r in taken]) if taken else 0
    assert share > 0.6


def test_mix_corner_cases(odd):
    got = mixing.take_counts(odd, into="mixed")
    assert got.columns == [*odd.columns, "mixed"] and got.count() == 5
    with pytest.raises(ValueError):
        mixing.take_counts(odd)
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    assert mixing.mixed_documents(odd.limit(0)).count() == 0


# --- repeats ---


def removal_brute(rows, width):
    seen = defaultdict(list)
    raws = [(i, (t or "").encode()) for i, t, *_ in rows]
    for n, (_, raw) in enumerate(raws):
        for a in range(len(raw) - width + 1):
            seen[raw[a : a + width]].append((n, a))
    cover = [bytearray(len(raw)) for _, raw in raws]
    for places in seen.values():
        if len(places) > 1:
            for n, a in places:
                cover[n][a : a + width] = b"\1" * width
    out = []
    for (i, raw), c in zip(raws, cover, strict=True):
        kept = bytes(b for b, x in zip(raw, c, strict=True) if not x)
        out.append((i, len(raw), sum(c), len(re.findall(b"\1+", bytes(c))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_windows_of_hot_anchors_are_small(spark):
    """Near copies with a hot anchor: their windows are shuffled as numbers (all shuffles of this test took 2.67 MB with the hash of their context, 2.24 MB without)."""
    rng = random.Random(5)
    base = "".join(rng.choices("abcdefgh ", k=700))
    rows = [(i, base[: (at := rng.randrange(600))] + f"<{i}>" + base[at:]) for i in range(150)]
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = written()
        got = suffix_dedup.removal_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), hot=2).collect()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        moved = written() - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    places = Counter(t[i : i + 200] for _, t in rows for i in range(len(t) - 199))
    for r in got:
        t = rows[r.doc_id][1]
        gone = {j for i in range(len(t) - 199) if places[t[i : i + 200]] > 1 for j in range(i, i + 200)}
        assert r.n_removed == len(gone)
    assert moved < 2_450_000, moved


@pytest.mark.parametrize(("width", "k", "hot"), [(200, 64, 200_000), (60, 20, 200_000), (60, 20, 1), (200, 64, 2)])
def test_repeats(docs, rows, width, k, hot):
    got = suffix_dedup.removal_report(docs, width=width, k=k, hot=hot).collect()
    assert sorted(map(tuple, got)) == removal_brute(rows, width)


@pytest.mark.parametrize(("often", "few"), [(3, 1_000_000), (2, 1_000_000), (3, 2)])
def test_anchors_known_to_be_hot(spark, rows, often, few, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FEW_HOT", few)
    plain = suffix_dedup.hot_anchors
    monkeypatch.setattr(suffix_dedup, "hot_anchors", lambda keyed, width, k, hot: plain(keyed, width, k, hot, often=often))
    r = random.Random(6)
    say = lambda n: " ".join(str(r.randint(0, 999)) for _ in range(n))
    line = say(30)
    more = [(2000 + i, f"{say(i % 9)} {line} " * (1 + i % 4) + ("ab" * 200 if i % 5 == 0 else ""), None, None, 0) for i in range(40)]
    every = rows + more
    assert sorted(map(tuple, suffix_dedup.removal_report(spark.createDataFrame(every, SCHEMA).repartition(3), width=60, k=20).collect())) == removal_brute(every, 60)


def test_repeat_corner_cases(odd, spark):
    got = suffix_dedup.removal_report(odd).collect()
    assert len(got) == 5 and all(r.n_removed == 0 for r in got)
    assert suffix_dedup.removal_report(odd.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "é" * 100), (1, "é" * 100), (None, "é" * 100), (2, "é" * 99)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in suffix_dedup.removal_report(twice).collect()) == [(0, 200, 1), (1, 200, 1), (1, 200, 1), (2, 0, 0)]


def test_maximal_repeats():
    places = sorted([(b"abcX", b"zyx"), (b"abcY", b"zyw"), (b"abcY", b"zyw"), (b"abdd", b"qq")])
    groups = {(left, right, tuple(sorted(m))) for left, right, m in suffix_dedup.maximal_repeats([p[0] for p in places], [p[1] for p in places], 3)}
    assert (2, 3, (0, 1, 2)) in groups and (3, 4, (1, 2)) in groups and (0, 3, (0, 1, 2)) not in groups


def test_long_texts_are_whole(spark, monkeypatch):
    r = random.Random(2)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 256)
    raw = bytes(r.choice(b"abcdefgh ") for _ in range(3000))
    p, h = suffix_dedup.anchors(raw, 40, 8)
    hashes = suffix_dedup.span_hashes(np.frombuffer(raw, np.uint8), np.arange(2993), np.arange(2993) + 8)
    want = sorted({min(range(a, a + 33), key=lambda i: (int(hashes[i]) >> 22, i)) for a in range(2961)})
    assert p.tolist() == want and (hashes[p] == h).all()


# --- shards ---


@pytest.mark.parametrize("per_bin", [20_000, 5])
def test_shards(docs, rows, per_bin):
    got = sharding.interleaved_shards(docs, per_bin=per_bin).collect()
    text = {i: (t or "").encode() for i, t, *_ in rows}
    source = {i: s for i, _, _, s, _ in rows}
    count = Counter(r.shard for r in got)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1 and len(got) == len(rows)
    for shard in count:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(count[shard]))
    assert all(r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id]) and r.law == "rows" and r.grown_shard is None for r in got)
    each = Counter((source[r.doc_id], r.shard) for r in got)
    for s, n in Counter(source.values()).items():
        assert all(abs(each[s, k] - n / 8) <= 2 for k in range(8))
    assert sorted(map(tuple, got)) == sorted(map(tuple, sharding.interleaved_shards(docs.repartition(7), per_bin=per_bin).collect()))


def test_shard_corner_cases(odd):
    got = sharding.interleaved_shards(odd, shards=2).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert sharding.interleaved_shards(odd.limit(0)).collect() == []
    assert "Python" not in sharding.interleaved_shards(odd)._jdf.queryExecution().toString()


# --- near duplicates ---


def link_brute(rows, words=4, likeness=85):
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= likeness * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(sets[i]), find(i)) for i in sets)


@pytest.mark.parametrize(("short", "block", "few"), [(2, 3, 0), (2, 2000, 200_000)])
def test_long_lists_are_whole(docs, rows, short, block, few, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW_LISTS", few)
    plain = ngram_join.set_links
    monkeypatch.setattr(ngram_join, "set_links", lambda sets, likeness: plain(sets, likeness, short, block))
    assert sorted(map(tuple, ngram_join.near_duplicates(docs, frequent=1, likeness=70).collect())) == link_brute(rows, likeness=70)


@pytest.mark.parametrize("options", [{}, {"frequent": 1}, {"frequent": 1, "long": 10}, {"frequent": 3, "long": 60, "likeness": 60}, {"words": 2, "likeness": 70, "frequent": 2}])
def test_near_duplicates(docs, rows, options):
    got = ngram_join.near_duplicates(docs, **options).collect()
    assert sorted(map(tuple, got)) == link_brute(rows, options.get("words", 4), options.get("likeness", 85))


def test_very_frequent_tokens(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SKEW_SHARE", 0.05)
    r = random.Random(9)
    passage = " ".join(str(i) for i in range(40))
    rows = [(i, passage + " " + " ".join(r.choice("abcdef") + str(r.randint(0, 50)) for _ in range(i % 12)), None, None, 0) for i in range(90)]
    assert len(ngram_join.skewed_tokens(spark.createDataFrame(rows, SCHEMA), 90)) >= 37
    assert sorted(map(tuple, ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())) == link_brute(rows)


def test_chains_of_links(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for step in range(12):  # each is like the next, the ends aren't alike
        w = list(base)
        w[: step * 3] = [f"v{i}" for i in range(step * 3)]
        rows.append((50 - step, " ".join(w), None, None, 0))
    got = {r.component_id for r in ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA), frequent=2).collect()}
    assert got == {c for _, _, c in link_brute(rows)}


def test_near_duplicate_corner_cases(odd):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(odd).collect())
    assert got == [(-1, 0, None), (-1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)]
    assert ngram_join.near_duplicates(odd.limit(0)).collect() == []


def test_texts_whose_short_hashes_clash_are_not_linked(spark):
    rows = [(1, "a246354 b150 c28 d", None, None, 0), (2, "a999454 b960 c14 d", None, None, 0)]  # alike in 36 bits
    assert sorted(map(tuple, ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())) == [(1, 1, 1), (2, 1, 2)]


@pytest.mark.parametrize("bits", [3, 8, 12, 20])
def test_clashing_hashes_change_nothing(spark, bits):
    r = random.Random(bits)
    rows = [(i, " ".join(str(r.randint(0, 9)) for _ in range(r.randint(1, 9))), None, None, 0) for i in range(60)]
    assert sorted(map(tuple, ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA), bits=bits, likeness=60).collect())) == link_brute(rows, likeness=60)


@pytest.mark.parametrize("few", [0, 1000])
def test_links_are_confirmed_on_texts(spark, few):
    rows = [(1, "a b c d e f"), (2, "A b c d  e f g"), (3, "x y z"), (3, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.xxhash64(F.lit(1), "text").alias("k1"), F.xxhash64(F.lit(2), "text").alias("k2"), "text")
    table = ngram_join.set_table(docs).dropDuplicates(["set"])
    ids = {r.doc_id: r.set for r in table.collect()}
    links = spark.createDataFrame([(ids[1], ids[2]), (ids[1], ids[3])], "a long, b long")
    assert [tuple(r) for r in ngram_join.false_links(links, table, docs, 75, 4, few).collect()] == [(ids[1], ids[3])]
    assert ngram_join.false_links(links, table, docs, 76, 4, few).count() == 2


@pytest.mark.parametrize("hub", [1, 3, 10_000])
def test_hubs(spark, hub):
    r = random.Random(3)
    edges = [(0, i) for i in range(1, 60)] + [(500 + i, 400) for i in range(50)] + [(r.randint(600, 700), r.randint(600, 700)) for _ in range(60)] + [(59, 620), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = components.components(spark.createDataFrame(edges, "a long, b long"), hub=hub).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root} and len(got) == len(root)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (200, 150), (150, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100, 150: 150, 200: 150}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- lines ---


def lines_brute(rows, least):
    sites = defaultdict(set)
    for _, t, _, s, _ in rows:
        for x in (t or "").split("\n"):
            if x.strip(" "):
                sites[x.strip(" ")].add(s)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(sites.get(x.strip(" "), ())) < least]
        text = "\n".join(kept)
        out.append((i, len(lines), len(lines) - len(kept), len(text), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("least", "few"), [(3, 1000), (3, 0), (5, 1000), (2, 0)])
def test_lines(docs, rows, least, few):
    got = line_dedup.line_report(docs, min_sites=least, few_lines=few).collect()
    assert sorted(map(tuple, got)) == lines_brute(rows, least)
    assert any(r.n_removed for r in got) or least == 5


def test_lines_go_whatever_is_left(spark):
    rows = [(i, "same line\nand this one" + (f"\nown {i}" if i % 2 else ""), None, f"s{i}", 0) for i in range(12)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_chars) for r in line_dedup.line_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (3, 2, len(f"own {i}")) if i % 2 else (2, 2, 0) for i in range(12)}


@pytest.mark.parametrize("few", [1000, 0])
def test_exact_counts_with_and_without_broadcast(spark, few):
    df = spark.createDataFrame([(i, f"line {n}", None, f"site {i}", 0) for n in (9, 10, 11) for i in [*range(n), *range(n)]], SCHEMA)
    assert line_dedup.boilerplate_lines(df, 10, few_lines=few).count() == 2


def test_sketches_near_the_threshold(spark):
    """Spreads around the threshold are exact, though sketches of few registers are not."""
    df = spark.createDataFrame([(i, f"line {n}", None, f"site {i}", 0) for n in range(190, 211) for i in range(n)], SCHEMA)
    got = {r[0] for r in line_dedup.boilerplate_lines(df, 200, lg_k=6).collect()}
    want = {r[0] for r in spark.createDataFrame([(f"line {n}",) for n in range(200, 211)], "x string").select(F.xxhash64("x")).collect()}
    assert got == want


def test_line_corner_cases(odd):
    got = line_dedup.dedup_lines(odd, min_sites=2)
    assert got.columns == [*odd.columns, "cleaned"] and got.count() == 5
    assert line_dedup.dedup_lines(odd, min_sites=2, few_lines=0).columns == got.columns
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0
    assert math.isclose(got.where("doc_id is null and text is null").first().cleaned.n_lines, 1)
