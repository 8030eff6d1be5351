"""Jaccard self-join of documents as sets of word n-grams, with token-combination prefixes.

Every set is ordered by one global order, rare tokens first. Linked sets x and y share at least ceil(t * |x|) tokens, so
they share k tokens within the first |x| - ceil(t * |x|) + k of x and as many of y. Prefixes are extended to k = 2. Rare
tokens of a prefix are index keys by themselves; of frequent ones, each pair is a key. Linked sets share a rare
token there, or two frequent ones. (Sets of LONG tokens and more have single frequent tokens as keys, for their pairs
would be too many; sets of lengths near that border have both kinds, so no linked pair misses.)

How it runs:

1. Texts become sets of 64-bit hashes, batch by batch with array operations. Tokens go to buckets by hash in packed
   arrays; a bucket finds the tokens that two or more distinct sets have, with their frequencies. Most are unique and
   end here.
2. Sets gather their shared tokens. As unique tokens never match, a set with fewer shared tokens than t of its size is
   linked with nothing and ends here too.
3. The rest are indexed. In each key's list the most central set is the pivot, and the other sets are verified against it
   by exact intersection. Lists whose sets are in one component by then are done: a list of near copies costs as much
   as it is long. In the other short lists, pairs across components are verified.
4. The other long lists overlap, for they come from groups of texts that are alike but not enough. Lists that share sets
   make a cluster, which is cut into blocks; a task has two blocks, counts all their intersections as a matrix product
   over the tokens, in slices, and gives the links that join components. No pair is a row, and no link between
   components is lost.

Tokens that a third of all documents have would fill one bucket. A bounded sample of documents names tokens that are that
frequent; these are dealt with their sets instead, as shared ones. The sample decides only where a token is handled.
Equal sets are one set from the start.

Hashes name tokens and sets, and nothing relies on their being different. A second hash with another base tells whether two
tokens of a text have one name, and whether two sets have one id; at last every link is confirmed on the n-grams of the
texts themselves. If a name ever stands for two things, all is done again with other names (near_duplicates).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_BYTES, WORD, lean, mix64, reliable, scratch, slices, span_hashes, text_of, trim
from .components import components

#: Production parameters: likeness in hundredths, words in an n-gram.
LIKENESS, WORDS = 85, 4
#: Tokens in more sets than this are frequent; sets from this size have single frequent tokens as keys.
FREQUENT, LONG = 40, 400
#: Documents of the sample that names very frequent tokens, and the share of them from which a token is one.
SKEW_SAMPLE, SKEW_SHARE = 4000, 0.005
#: Characters of text whose tokens one bucket has, and one partition at least; buckets that are partitions by themselves.
BUCKET_CHARS, PART_CHARS, FEW_BUCKETS = 1 << 23, 1 << 26, 64
#: Linked sets whose texts' keys may be broadcast, and lists of keys that may be.
FEW_SETS, FEW_LISTS = 500_000, 200_000
#: Sets of a list whose pairs are rows at most; sets of a block.
SHORT, BLOCK = 16, 2000
#: Bytes of text that a worker packs at a time.
SLICE = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = [np.uint64(int(xxhash.xxh3_64_intdigest(f"word {i}")) | 1) for i in range(64)]
_WORD = re.compile(WORD)
_TO_LOWER = {c: c + 32 for c in range(65, 91)}


class Naming(NamedTuple):
    """How n-grams are named: words in one, number of the hash function, bits of a hash (fewer than 64 only in tests)."""

    words: int = WORDS
    seed: int = 0
    bits: int = 64

    @property
    def base(self) -> int:
        return (0x9E3779B97F4A7C55 + 0x5851F42D4C957F2E * self.seed) % (1 << 64) | 1

    @property
    def second(self) -> "Naming":
        """Names that don't depend on these."""
        return Naming(self.words, -1 - self.seed)


def grams(text: str, words: int = WORDS) -> frozenset[str]:
    """The n-grams of a text themselves."""
    w = _WORD.findall(text.translate(_TO_LOWER))
    return frozenset(" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def token_sets(texts: list[str], naming: Naming = Naming()) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's n-grams: A-Z lower-cased, words between white space; a text with
    fewer words is one token; one without words has none."""
    raw = [t.encode() for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(raw):
        size, stop = 0, at
        while stop < len(raw) and (stop == at or size + len(raw[stop]) < 1 << 20):
            size += len(raw[stop]) + 1
            stop += 1
        out += _sets_of(raw[at:stop], naming)
        at = stop
    return out


def _sets_of(raw: list[bytes], naming: Naming) -> list[np.ndarray]:
    words, mask = naming.words, np.uint64((1 << naming.bits) - 1)
    data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)]
    space = SPACE_BYTES[data]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    h = span_hashes(data, starts, ends, naming.base)
    offsets = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    firsts = np.searchsorted(starts, offsets)
    out = []
    if len(h) >= words:
        with np.errstate(over="ignore"):
            grams = np.zeros(len(h) - words + 1, dtype=np.uint64)
            for j in range(words):
                grams += h[j : len(h) - words + 1 + j] * _FACTORS[j]
            grams = mix64(grams) & mask
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                total = np.uint64(b - a)
                for j in range(b - a):
                    total = total + h[a + j] * _FACTORS[words + j]
                out.append(mix64(np.array([total], dtype=np.uint64)) & mask)
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def set_id(tokens: np.ndarray) -> int:
    return int(xxhash.xxh3_64_intdigest(tokens.tobytes())) - (1 << 63)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values start, and their lengths."""
    if not len(values):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    starts = np.concatenate([[0], np.nonzero(values[1:] != values[:-1])[0] + 1])
    return starts, np.diff(np.concatenate([starts, [len(values)]]))


def set_table(docs: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """doc_id, k1, k2, n, set, check, clash of docs with doc_id, k1, k2, text: the size and the id of each document's set, a
    digest of it under the second naming, and whether two of its tokens have one name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "k1", "k2", "n", "set", "check", "clash"]
        for b in (x for batch in batches for x in slices(batch, 3, SLICE)):
            texts = b.column(3).to_pylist()
            sets, others = token_sets(texts, naming), token_sets(texts, naming.second)
            own = [pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in others], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *own, pa.array([len(s) != len(t) for s, t in zip(sets, others, strict=True)], pa.bool_())], names=names)
        trim()

    return docs.select("doc_id", "k1", "k2", "text").mapInArrow(run, "doc_id long, k1 long, k2 long, n long, set long, check long, clash boolean")


def skewed_tokens(docs: DataFrame, n_docs: int, naming: Naming = Naming(), sample: int = SKEW_SAMPLE, share: float = SKEW_SHARE, text_col: str = "text") -> np.ndarray:
    """Sorted tokens that `share` of a sample's distinct sets have, 8 sets at least. Their number is bounded by the mean
    size of a set over share."""
    text = text_of(text_col)
    some = docs.select(text.alias("text")).where(F.pmod(F.xxhash64(text), F.lit(max(1, n_docs // sample))) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in slices(batch, 0, SLICE)):
            sets = {s.tobytes() for s in token_sets(b.column(0).to_pylist(), naming)}
            own = np.concatenate([np.frombuffer(s, dtype=np.uint64) for s in sets] or [np.empty(0, np.uint64)])
            tokens, count = np.unique(own, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(count)], names=["token", "n"])

    least = max(8, int(share * min(n_docs, sample)))
    rows = some.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("token").toPandas()
    return np.sort(rows["token"].to_numpy(dtype=np.int64).view(np.uint64))


#: Kinds of packed rows: tokens by bucket; sizes of sets; very frequent tokens of sets; shared tokens of sets.
TOKENS, SIZES, SKEWED, SHARED = 0, 1, 2, 3
_PACKED = "part int, kind int, bucket int, payload binary"


def _row(part: int, kind: int, bucket: int, *arrays: np.ndarray) -> tuple:
    return part, kind, bucket, len(arrays[0]).to_bytes(4, "little") + b"".join(x.tobytes() for x in arrays)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)], names=["part", "kind", "bucket", "payload"])


def _pack(texts: list[str], naming: Naming, buckets: int, parts: int, skewed: np.ndarray) -> Iterator[tuple]:
    sets = {}
    for s in token_sets(texts, naming):
        if len(s):
            sets[set_id(s)] = s
    if not sets:
        return
    ids = np.fromiter(sets, dtype=np.int64)
    sizes = np.fromiter(map(len, sets.values()), dtype=np.uint32)
    home = (ids.view(np.uint64) % np.uint64(parts)).astype(np.int32)
    tokens, owner = np.concatenate(list(sets.values())), np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(home, kind="stable")
    for a, n in zip(*_runs(home[order]), strict=True):
        part = order[a : a + n]
        yield _row(int(home[part[0]]), SIZES, 0, ids[part], sizes[part])
    if len(skewed):
        at = np.minimum(np.searchsorted(skewed, tokens), len(skewed) - 1)
        known = skewed[at] == tokens
        if known.any():
            at, who = at[known].astype(np.uint32), owner[known]
            order = np.argsort(home[who], kind="stable")
            at, who = at[order], who[order]
            for a, n in zip(*_runs(home[who]), strict=True):
                yield _row(int(home[who[a]]), SKEWED, 0, ids[who[a : a + n]], at[a : a + n])
            tokens, owner = tokens[~known], owner[~known]
    bucket = (mix64(tokens) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    bucket, owner, tokens = bucket[order], owner[order], tokens[order]
    for a, n in zip(*_runs(bucket), strict=True):
        who = owner[a : a + n]
        starts, count = _runs(who)
        yield _row(int(bucket[a]) % parts, TOKENS, int(bucket[a]), ids[who[starts]], count.astype(np.uint32), tokens[a : a + n])


def _unpack(payload: bytes, *kinds: type, rest: type | None = None) -> list[np.ndarray]:
    n, at, out = int.from_bytes(payload[:4], "little"), 4, []
    for k in kinds:
        out.append(np.frombuffer(payload, dtype=k, count=n, offset=at))
        at += n * np.dtype(k).itemsize
    if rest is not None:
        out.append(np.frombuffer(payload, dtype=rest, offset=at))
    return out


def _shared(bucket: int, blobs: list[bytes], parts: int) -> Iterator[tuple]:
    """Tokens of a bucket that two or more sets have, dealt to the homes of those sets."""
    who, name = [], []
    for p in blobs:
        ids, count, tokens = _unpack(p, np.int64, np.uint32, rest=np.uint64)
        who.append(np.repeat(ids, count))
        name.append(tokens)
    blobs.clear()
    who, name = np.concatenate(who), np.concatenate(name)
    order = np.argsort(name, kind="stable")
    who, name = who[order], name[order]
    starts, count = _runs(name)
    often = np.repeat(count > 1, count)
    who, name = who[often], name[often]
    order = np.lexsort((who, name))
    who, name = who[order], name[order]
    new = np.ones(len(who), dtype=bool)
    new[1:] = (who[1:] != who[:-1]) | (name[1:] != name[:-1])
    who, name = who[new], name[new]
    starts, count = _runs(name)
    often = np.repeat(count > 1, count)
    token = np.repeat(np.arange(len(count), dtype=np.uint32), count)[often]
    freq, who = np.minimum(np.repeat(count, count)[often], 65_534).astype(np.uint16), who[often]
    home = (who.view(np.uint64) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(home, kind="stable")
    who, token, freq, home = who[order], token[order], freq[order], home[order]
    for a, n in zip(*_runs(home), strict=True):
        yield _row(int(home[a]), SHARED, bucket, who[a : a + n], token[a : a + n], freq[a : a + n])


def _by_part(batches: Iterator[pa.RecordBatch], buckets: bool = False) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """(part, rows) of sorted rows, or (part, rows of one kind and bucket)."""
    now, rows = None, []
    for b in batches:
        for part, kind, bucket, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
            key = (part, kind, bucket) if buckets else (part,)
            if key != now and rows:
                yield now[0], rows
                rows = []
            now = key
            rows.append((kind, bucket, payload))
    if rows:
        yield now[0], rows


def keys_of(n: int, tokens: np.ndarray, freq: np.ndarray, likeness: int, frequent: int, long: int) -> np.ndarray:
    """Index keys of a set of n tokens, of which these are shared, in the global order (frequency, then token)."""
    prefix = n - -(-likeness * n // 100) + 2 - (n - len(tokens))  # tokens that only this set has come first
    if prefix <= 0:
        return np.empty(0, dtype=np.int64)
    tokens, freq = tokens[:prefix].astype(np.uint64), freq[:prefix]
    rare, common = tokens[freq <= frequent], tokens[freq > frequent]
    with np.errstate(over="ignore"):
        keys = [mix64(rare)]
        if n * likeness <= long * 100 and len(common) > 1:
            i, j = np.triu_indices(len(common), 1)
            keys.append(mix64(mix64(common)[i] * _FACTORS[0] + mix64(common)[j] * _FACTORS[1]))
        if n >= long:
            keys.append(mix64(common * _FACTORS[2] + _FACTORS[3]))
    return np.concatenate(keys).view(np.int64)


def _survivors(rows: list[tuple[int, int, bytes]], skew_bucket: int, likeness: int, frequent: int, long: int) -> Iterator[tuple]:
    ids, sizes, who, token, freq = [], [], [], [], []
    for kind, bucket, p in rows:
        if kind == SIZES:
            a, b = _unpack(p, np.int64, np.uint32)
            ids.append(a)
            sizes.append(b)
        elif kind == SKEWED:
            a, b = _unpack(p, np.int64, np.uint32)
            who.append(a)
            token.append(b.astype(np.int64) + (skew_bucket << 32))
            freq.append(np.full(len(a), 65_535, dtype=np.uint16))
        else:
            a, b, c = _unpack(p, np.int64, np.uint32, np.uint16)
            who.append(a)
            token.append(b.astype(np.int64) + (bucket << 32))
            freq.append(c)
    if not who or not ids:
        return
    ids, first = np.unique(np.concatenate(ids), return_index=True)
    sizes = np.concatenate(sizes)[first].astype(np.int64)
    who, token, freq = np.concatenate(who), np.concatenate(token), np.concatenate(freq)
    at = np.searchsorted(ids, who)
    alive = np.bincount(at, minlength=len(ids)) * 100 >= sizes * likeness  # copies from several tasks count twice, so this only sorts out
    kept = alive[at]
    at, token, freq = at[kept], token[kept], freq[kept]
    order = np.lexsort((token, freq, at))
    at, token, freq = at[order], token[order], freq[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (token[1:] != token[:-1])
    at, token, freq = at[new], token[new], freq[new]
    for a, m in zip(*_runs(at), strict=True):
        n = int(sizes[at[a]])
        if m * 100 >= n * likeness:
            own, f = token[a : a + m], freq[a : a + m]
            yield int(ids[at[a]]), n, float(f.mean()), np.sort(own).tobytes(), keys_of(n, own, f, likeness, frequent, long).tolist()


def candidate_sets(docs: DataFrame, likeness: int = LIKENESS, naming: Naming = Naming(), frequent: int = FREQUENT, long: int = LONG, text_col: str = "text") -> DataFrame:
    """set, n, central, tokens (packed, sorted ids of its shared tokens), keys: the sets that can have links at all.

    Buckets and partitions follow the number of characters, so a task's share doesn't grow with the corpus.
    """
    counts = docs.select(F.count("*").alias("n"), F.sum(F.length(text_of(text_col))).alias("c")).first()
    skewed = docs.sparkSession.sparkContext.broadcast(skewed_tokens(docs, counts["n"], naming, text_col=text_col))
    buckets = int(max(16, (counts["c"] or 0) // BUCKET_CHARS))
    parts = int(min(buckets, max(FEW_BUCKETS, (counts["c"] or 0) // PART_CHARS)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 0, SLICE):
                yield _batch(list(_pack(part.column(0).to_pylist(), naming, buckets, parts, skewed.value)))
        trim()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches, buckets=True):
            out = [(part, kind, 0, p) for kind, _, p in rows if kind != TOKENS]
            if rows[0][0] == TOKENS:
                bucket, blobs = rows[0][1], [p for *_, p in rows]
                rows.clear()
                out = list(_shared(bucket, blobs, parts))
            for a in range(0, len(out), 256):
                yield _batch(out[a : a + 256])
        trim()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.list_(pa.int64())]
        for _, rows in _by_part(batches):
            out = list(_survivors(rows, buckets, likeness, frequent, long))
            for a in range(0, len(out), 512):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[a : a + 512], strict=True), kinds, strict=True)], names=["set", "n", "central", "tokens", "keys"])
        trim()

    dealt = docs.select(text_of(text_col).alias("text")).mapInArrow(pack, _PACKED)
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind", "bucket").mapInArrow(match, _PACKED)
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part").mapInArrow(gather, "set long, n long, central double, tokens binary, keys array<long>")
    return reliable(dealt)


def _verified(pairs: DataFrame, sets: DataFrame, likeness: int) -> DataFrame:
    """Of pairs (a, b), those whose sets are as like as asked, by exact intersection."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        out = []
        for p, q, i, j in zip(x, y, n, m, strict=True):
            common = len(np.intersect1d(np.frombuffer(p, dtype=np.int64), np.frombuffer(q, dtype=np.int64), assume_unique=True))
            out.append(100 * common >= likeness * (i + j - common))
        return pd.Series(out, dtype=bool)

    one = sets.select(F.col("set").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    two = sets.select(F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    return pairs.join(one, "a").join(two, "b").where(linked("t_a", "t_b", "n_a", "n_b")).select("a", "b")


def _fits(x: Column, y: Column, x_shared: Column, y_shared: Column, likeness: int) -> Column:
    """Whether sets of x and y tokens, x_shared and y_shared of them in other sets too, can be as like as asked."""
    most = F.least(x_shared, y_shared)
    return most * 100 >= (x + y - most) * likeness


def _block_links(rows: list[tuple], likeness: int) -> Iterator[tuple[int, int]]:
    """Links that join components among the sets (block, set, n, root, packed tokens) of one block or two."""
    low = min(r[0] for r in rows)
    rows.sort(key=lambda r: (r[0], r[1]))
    first = [r for r in rows if r[0] == low]
    second = [r for r in rows if r[0] != low] or first
    every = first if second is first else first + second
    tokens = [np.frombuffer(r[4], dtype=np.int64) for r in every]
    flat, owner = np.concatenate(tokens), np.repeat(np.arange(len(every)), [len(t) for t in tokens])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    often = count[column] > 1
    names, column = np.unique(column[often], return_inverse=True)
    owner = owner[often]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(first), len(second)), dtype=np.float32)
    shift = 0 if second is first else len(first)
    for at in range(0, len(names), 1024):
        i, j = np.searchsorted(column, [at, at + 1024])
        part = np.zeros((len(every), min(1024, len(names) - at)), dtype=np.float32)
        part[owner[i:j], column[i:j] - at] = 1
        common += part[: len(first)] @ part[shift:].T
    sizes = np.array([r[2] for r in every], dtype=np.float64)
    linked = common * (100.0 + likeness) >= likeness * (sizes[: len(first), None] + sizes[None, shift:])
    roots = np.array([r[3] for r in every])
    linked &= roots[: len(first), None] != roots[None, shift:]
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(*np.nonzero(linked), strict=True):
        a, b = top(int(roots[x])), top(int(roots[shift + y]))
        if a != b:
            up[a] = b
            yield first[x][1], second[y][1]


def _cluster_links(keyed: DataFrame, sets: DataFrame, likeness: int, block: int) -> DataFrame:
    """a, b: the links that join components among sets (key, set, root) of lists that overlap."""
    stars = keyed.withColumn("hub", F.min("set").over(Window.partitionBy("key"))).select(F.col("set").alias("a"), F.col("hub").alias("b"))
    clusters = components(stars).select("node", F.col("root").alias("cluster"))
    members = keyed.select("set", "root").distinct().join(clusters, F.col("set") == F.col("node")).select("set", "root", "cluster")
    counts = members.groupBy("cluster").agg((F.floor((F.count("*") - 1) / block) + 1).cast("int").alias("blocks"))
    dealt = members.join(counts, "cluster").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set", "root")
    dealt = dealt.join(sets.select("set", "n", "tokens"), "set").select("cluster", "i", "j", "block", "set", "n", "root", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int]]:
            now, rows = None, []
            for b in batches:
                for cluster, i, j, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if (cluster, i, j) != now and rows:
                        yield from _block_links(rows, likeness)
                        rows = []
                    now = (cluster, i, j)
                    rows.append(tuple(row))
            if rows:
                yield from _block_links(rows, likeness)

        links = list(found())
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(run, "a long, b long")


def set_links(sets: DataFrame, likeness: int = LIKENESS, short: int = SHORT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(node, root) of the sets that have links: equal roots exactly where links connect; and the links (a, b) found, which
    connect them."""
    def bounded(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= FEW_LISTS else df

    # a set has its keys by the hundreds: they're met where the sets are, as long as the lists can be sent there
    slim = sets.select("set", "n", F.expr("octet_length(tokens) div 8").alias("m"), "central", "keys")
    each = slim.select("set", "n", "m", "central", F.explode("keys").alias("key"))
    lists = reliable(each.groupBy("key").agg(F.count("*").alias("size"), F.max(F.struct("central", "set", "n", "m")).alias("pivot")).where("size > 1").select("key", "pivot"))
    stars = each.join(bounded(lists), "key").where((F.col("set") != F.col("pivot.set")) & _fits(F.col("n"), F.col("pivot.n"), F.col("m"), F.col("pivot.m"), likeness))
    stars = reliable(stars.select(F.least("set", "pivot.set").alias("a"), F.greatest("set", "pivot.set").alias("b")).distinct())
    links = reliable(_verified(stars, sets, likeness))
    roots = components(links)

    rooted = slim.drop("central").join(roots, slim["set"] == roots["node"], "left").select("set", "n", "m", F.coalesce("root", "set").alias("root"), F.explode("keys").alias("key"))
    open_ = reliable(rooted.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key", "size"))
    mixed = reliable(rooted.join(bounded(open_), "key").select("key", "size", "set", "n", "m", "root"))
    x, y = mixed.where(F.col("size") <= short).alias("x"), mixed.where(F.col("size") <= short).alias("y")
    differ = (F.col("x.key") == F.col("y.key")) & (F.col("x.set") < F.col("y.set")) & (F.col("x.root") != F.col("y.root"))
    across = x.join(y, differ & _fits(F.col("x.n"), F.col("y.n"), F.col("x.m"), F.col("y.m"), likeness))
    across = across.select(F.col("x.set").alias("a"), F.col("y.set").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    more = _verified(across, sets, likeness)
    crowded = mixed.where(F.col("size") > short)
    if not crowded.isEmpty():
        more = more.union(_cluster_links(crowded, sets, likeness, block))
    more = reliable(more)
    if more.isEmpty():
        return roots, links
    links = links.union(more)
    return components(links), links


def false_links(links: DataFrame, first: DataFrame, docs: DataFrame, likeness: int, words: int, few: int = FEW_SETS) -> DataFrame:
    """Of links (a, b), those that the n-grams of the sets' texts don't confirm; first has the key k1, k2 of one text of each
    set. Only texts of linked sets move."""

    @F.pandas_udf("boolean")
    def unlike(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            one, two = grams(p, words), grams(q, words)
            common = len(one & two)
            out.append(100 * common < likeness * (len(one) + len(two) - common))
        return pd.Series(out, dtype=bool)

    linked = links.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    keys = reliable(first.select("set", F.col("k1").alias("x1"), F.col("k2").alias("x2")).join(linked, "set", "left_semi"))
    keys = F.broadcast(keys) if keys.count() <= few else keys
    texts = docs.join(keys, (F.col("k1") == F.col("x1")) & (F.col("k2") == F.col("x2"))).groupBy("set").agg(F.first("text").alias("text"))
    one, two = texts.select(F.col("set").alias("a"), F.col("text").alias("t_a")), texts.select(F.col("set").alias("b"), F.col("text").alias("t_b"))
    return links.join(one, "a").join(two, "b").where(unlike("t_a", "t_b")).select("a", "b")


def _named_links(docs: DataFrame, naming: Naming, likeness: int, frequent: int, long: int, keep: list[DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """The table of sets, one row for each set, and the roots of linked ones; None if names clash."""
    table = reliable(set_table(docs, naming))
    first = table.groupBy("set").agg(F.min(F.when(F.col("n") > 0, F.col("doc_id"))).alias("own"), F.max("n").alias("n"), F.min(F.struct("k1", "k2")).alias("k"), F.max("clash").alias("clash"), (F.min("check") != F.max("check")).alias("twofold"))
    first = reliable(first.select("set", "own", "n", "k.k1", "k.k2", "clash", "twofold"))
    if not first.where("clash or twofold").isEmpty():
        return None
    with scratch(docs.sparkSession) as own:
        roots, links = set_links(candidate_sets(docs, likeness, naming, frequent, long), likeness)
        roots, links = reliable(roots), reliable(links)
        own += [roots, links]
    if not false_links(links, first, docs, likeness, naming.words).isEmpty():
        return None
    keep += [table, first, roots]
    return table, first, roots


def near_duplicates(docs: DataFrame, likeness: int = LIKENESS, words: int = WORDS, frequent: int = FREQUENT, long: int = LONG, bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for each row: the smallest id reachable over links, its own included.

    Texts without words, null ones included, are linked with nothing, not even each other. Rows of equal sets are linked.
    Rows with a null id link others but never name a component (null where all ids are null). Repeated rows are rows.
    Very long texts are whole sets. An empty table gives no rows; other columns are not read. Links are those of the n-grams,
    whatever their hashes are: where hashes don't tell n-grams or sets apart, all is done again with other ones (`bits`,
    for tests, are those of the first).
    """
    text = text_of(text_col)
    slim = lean(docs).select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(F.lit(1), text).alias("k1"), F.xxhash64(F.lit(2), text).alias("k2"), text.alias("text"))
    spark = docs.sparkSession
    for seed in itertools.count():
        naming = Naming(words, seed, 64 if seed else bits)
        with scratch(spark) as keep:
            if found := _named_links(slim, naming, likeness, frequent, long, keep):
                break
    table, first, roots = found
    first = first.where("n > 0").select("set", "own")
    named = first.join(roots, first["set"] == roots["node"], "left").select("set", "own", "root")
    groups = named.where("root is not null").groupBy(F.col("root").alias("group")).agg(F.min("own").alias("least"))
    named = named.join(groups, F.col("root") == F.col("group"), "left").select(F.col("set").alias("s"), F.coalesce("least", "own").alias("component_id"))
    full = table.where("n > 0").join(named, F.col("set") == F.col("s")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.union(table.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def near_duplicates_sql(likeness: int = LIKENESS, words: int = WORDS) -> str:
    """The same rows by all pairs that share an n-gram, and all nodes that each node reaches; for small tables."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {words} + 2), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM g a JOIN g b USING (gram) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * common >= {likeness} * (a.n + b.n - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id"""
