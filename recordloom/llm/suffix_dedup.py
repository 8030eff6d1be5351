"""Removal of repeated byte strings through maximal repeats of an enhanced suffix array.

A suffix array of all bytes would be sorted and shuffled as a whole, so it is sparse here: of the suffixes, only those at
anchors are sorted. Anchors are minimizers: of the k-byte strings in each window of `width` bytes, the one of smallest
hash (the leftmost of equals). Equal windows have their anchors at equal offsets, so two occurrences of any string of
`width` bytes meet at an anchor, and a string that has one occurrence can be left out as soon as its anchor has one.

1. Batches give the anchors of their texts (hash, text, place); sorted by hash, the unique ones go. Equal texts are one
   text from here on; a text with copies is removed whole if it is long enough.
2. Anchors that are left fetch their contexts: `width` bytes to the right, width - k bytes to the left.
3. Contexts are sorted by anchor and right side: a sparse suffix array. Neighbours' common prefixes make an interval tree,
   which a stack scan walks from the deepest intervals up. In each interval the left sides are sorted and scanned
   in the same way: an interval of left extensions whose members differ further left, and not all of whose members are in
   one deeper right interval, is a maximal repeat with all its occurrences. Those of `width` bytes or more cover bytes.
4. Texts gather what covers them, and lose it.

Equal contexts within a text, as periodic passages have by thousands, cover each other at once, and one of them goes on.
An anchor that very many texts have isn't brought together in one task. A sample of texts names such anchors before anything
is shuffled: their places are dealt at random, as they need no company to be known as repeated; anchors that the sample misses
and more than `hot` texts have are found afterwards. For both, equal contexts are counted by partial aggregation, the windows of
different ones are hashed and counted in the same way, and those with two places cover bytes. The result is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, reliable, slices, span_hashes, text_of, trim

#: Production parameters: bytes of a repeat, bytes of an anchor, texts with an anchor that one task may hold.
WIDTH, ANCHOR, HOT = 200, 64, 200_000
#: Texts of the sample at least, places of an anchor in it from which it's hot, tasks that a hot anchor's places are dealt to,
#: and hot anchors that may be broadcast (beyond, only `hot` counts).
SAMPLE, OFTEN, DEAL, FEW_HOT = 4000, 32, 997, 1_000_000
_PIECE = 1 << 19


def _windows_min(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by running minima within blocks from both sides."""
    n = len(keys)
    blocks = -(-n // w)
    full = np.full(blocks * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[:n] = keys
    full = full.reshape(blocks, w)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(raw: bytes, width: int = WIDTH, k: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Places of the minimizers of all windows of raw, in order, and the hashes of the k bytes there."""
    places, hashes = [], []
    for at in range(0, max(0, len(raw) - width + 1), _PIECE):
        data = np.frombuffer(raw, dtype=np.uint8, count=min(len(raw) - at, _PIECE + width - 1), offset=at)
        first = np.arange(len(data) - k + 1)
        h = span_hashes(data, first, first + k)
        keys = (h & ~np.uint64((1 << 22) - 1)) | first.astype(np.uint64)
        best = (_windows_min(keys, width - k + 1) & np.uint64((1 << 22) - 1)).astype(np.int64)
        best = best[np.concatenate([[True], best[1:] != best[:-1]])]
        places.append(best + at)
        hashes.append(h[best])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    p, h = np.concatenate(places), np.concatenate(hashes)
    p, i = np.unique(p, return_index=True)
    return p, h[i]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    if a == b:
        return len(a)
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8 if x else n


def _intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the intervals of neighbours with common prefixes of `least` and more, deepest first."""
    stack: list[tuple[int, int]] = []
    for i, now in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > now:
            size, first = stack.pop()
            yield size, first, i
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def maximal_repeats(rights: list[bytes], lefts: list[bytes], width: int = WIDTH) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members): groups of places that share `left` bytes before them and `right` from them on, width bytes
    and more together, and neither side can be extended for all of them. rights are sorted; lefts read leftwards."""
    lcp = [_common(a, b) for a, b in zip(rights, rights[1:], strict=False)]
    below: list[tuple[int, int]] = []  # intervals seen whose parent wasn't seen yet
    for right, first, last in _intervals(lcp, width - max(map(len, lefts), default=0)):
        children = []
        while below and below[-1][0] >= first:
            children.append(below.pop())
        below.append((first, last))
        order = sorted(range(first, last + 1), key=lefts.__getitem__)
        shared = [_common(lefts[a], lefts[b]) for a, b in zip(order, order[1:], strict=False)]
        for left, i, j in _intervals(shared, width - right):
            members = order[i : j + 1]
            if children:
                low, high = min(members), max(members)
                if any(a <= low and high <= b for a, b in children):
                    continue
            yield left, right, members


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    now, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[0] != now and rows:
                yield rows
                rows = []
            now = row[0]
            rows.append(row)
    if rows:
        yield rows


def _covers(rows: list[tuple], width: int) -> Iterator[tuple[int, int, int, int]]:
    """(k1, k2, from, to) for each row (anchor, k1, k2, place, stop, right, left) that is in a maximal repeat; rows with a
    stop are ranges that are covered already."""
    yield from (r[1:5] for r in rows if r[4] is not None)
    rows = [r for r in rows if r[4] is None]
    if len(rows) < 2:
        return
    far = [[0, 0] for _ in rows]
    for left, right, members in maximal_repeats([r[5] for r in rows], [r[6] for r in rows], width):
        for i in members:
            far[i] = [max(far[i][0], left), max(far[i][1], right)]
    for (_, k1, k2, at, *_), (left, right) in zip(rows, far, strict=True):
        if right:
            yield k1, k2, at - left, at + right


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _batches(rows: Iterator[tuple], schema: str, size: int) -> Iterator[pa.RecordBatch]:
    names, kinds = zip(*((x.split()[0], _KINDS[x.split()[1]]) for x in schema.split(",")), strict=True)
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=list(names))
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=list(names))


def hot_anchors(keyed: DataFrame, width: int = WIDTH, k: int = ANCHOR, hot: int = HOT, sample: int = SAMPLE, often: int = OFTEN) -> np.ndarray:
    """Sorted anchors with `often` places or more in a sample of the texts, by hash. The sample has `sample` texts at
    least, and enough of a large corpus for anchors that `hot` texts have; their number is bounded by its size over `often`."""
    rows = keyed.count()
    step = max(1, min(rows // sample, hot // (2 * often)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in slices(batch, 0, 1 << 23)):
            own = [anchors(t.encode(), width, k)[1] for t in set(b.column(0).to_pylist())]
            names, n = np.unique(np.concatenate([np.empty(0, np.uint64), *own]).view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n, pa.int64())], names=["anchor", "n"])
        trim()

    some = keyed.where(F.pmod(F.xxhash64("k1", "k2"), F.lit(step)) == 0).select("text").mapInArrow(find, "anchor long, n long")
    found = some.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= often).select("anchor").limit(FEW_HOT + 1).toPandas()["anchor"].to_numpy(dtype=np.int64)
    return np.sort(found) if len(found) <= FEW_HOT else found[:0]


def _repeated_anchors(keyed: DataFrame, width: int, k: int, hot: np.ndarray) -> DataFrame:
    """anchor, k1, k2, place, rank of the anchors that stand at two places or more; rank numbers an anchor's texts, and is -1
    for those known to be hot."""
    known_hot = keyed.sparkSession.sparkContext.broadcast(hot)

    def is_hot(names: np.ndarray) -> np.ndarray:
        table = known_hot.value
        return table[np.minimum(np.searchsorted(table, names), len(table) - 1)] == names if len(table) else np.zeros(len(names), dtype=bool)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for b in slices(batch, 2, 1 << 23):
                cols = [[], [], [], [], []]
                for *key, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    raw = t.encode()
                    if len(raw) < width or tuple(key) in seen:
                        continue
                    seen.add(tuple(key))
                    places, hashes = anchors(raw, width, k)
                    hashes = hashes.view(np.int64)
                    deal = np.where(is_hot(hashes), 1 + (places + key[0] % DEAL) % DEAL, 0)  # equal rows are dealt alike
                    for c, v in zip(cols, (hashes, np.full(len(places), key[0]), np.full(len(places), key[1]), places, deal), strict=True):
                        c.append(v)
                flat = [np.concatenate(c) if c else np.empty(0, np.int64) for c in cols]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in flat[:4]), pa.array(flat[4].astype(np.int16))], names=["anchor", "k1", "k2", "place", "deal"])
        trim()

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "k1", "k2", "place", "rank"]
        tail = None  # the last row, of which it isn't known yet whether its anchor comes again
        known, rank = False, 0  # whether its anchor has come before, and its rank
        for b in batches:
            if not b.num_rows:
                continue
            now = np.stack([c.to_numpy() for c in b.columns[:4]])
            if tail is not None:
                now = np.concatenate([tail, now], axis=1)
            now = now[:, np.concatenate([[True], (now[:, 1:] != now[:, :-1]).any(axis=0)])]  # copies from several tasks
            same = now[0, 1:] == now[0, :-1]
            step = np.concatenate([[0], np.cumsum(same & (now[1:3, 1:] != now[1:3, :-1]).any(axis=0))])
            starts = np.concatenate([[0], np.nonzero(~same)[0] + 1])
            ranks = step - np.repeat(step[starts], np.diff(np.concatenate([starts, [now.shape[1]]])))
            ranks[: starts[1] if len(starts) > 1 else now.shape[1]] += rank
            keep = np.zeros(now.shape[1], dtype=bool)
            keep[:-1] |= same
            keep[1:] |= same
            keep[0] |= known
            sure = is_hot(now[0])
            keep |= sure
            tail, known, rank = now[:, -1:], bool(keep[-1]), int(ranks[-1])
            ranks[sure] = -1
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in now[:, :-1][:, keep[:-1]]), pa.array(ranks[:-1][keep[:-1]])], names=names)
        if known:
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in tail), pa.array([-1 if is_hot(tail[0])[0] else rank], pa.int64())], names=names)

    found = keyed.select("k1", "k2", "text").mapInArrow(find, "anchor long, k1 long, k2 long, place long, deal short")
    return found.repartition("anchor", "deal").sortWithinPartitions("anchor", "deal", "k1", "k2", "place").mapInArrow(repeated, "anchor long, k1 long, k2 long, place long, rank long")


def covered(keyed: DataFrame, texts: DataFrame, width: int = WIDTH, k: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """k1, k2, start, stop: byte ranges of texts that maximal repeats cover. keyed has k1, k2, text for each row, texts k1,
    k2, text, copies for each text."""
    places = reliable(_repeated_anchors(keyed, width, k, hot_anchors(keyed, width, k, hot)))
    crowded = reliable(places.where((F.col("rank") >= hot) | (F.col("rank") < 0)).select(F.col("anchor").alias("crowd")).distinct())
    n_crowded = crowded.count()
    crowded = F.broadcast(crowded) if n_crowded <= FEW_HOT else crowded
    fields = "anchor long,k1 long,k2 long,place long,stop long,right binary,left binary"
    ranges = "k1 long,k2 long,start long,stop long"

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for k1, k2, text, _, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    raw, seen, again = text.encode(), {}, []
                    for p in own:
                        at = p["place"]
                        low, high = max(0, at - width + k), min(len(raw), at + width)
                        first = seen.setdefault((raw[low:high], at - low), at)
                        if first != at:
                            again += [{"start": x - at + low, "stop": x - at + high} for x in (first, at)]
                            continue
                        yield p["anchor"], k1, k2, at, None, raw[at:high], raw[low:at][::-1]
                    for a, z in _spans(again):
                        yield k1, k1, k2, a, z, None, None

        yield from _batches(rows(), fields, 4096)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((x for rows in _groups(batches) for x in _covers(rows, width)), ranges, 8192)

    def windows(places: bool):
        """The windows of contexts (kind, right, left, low, high), with the least and greatest place of each if asked."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for b in batches:
                for kind, right, left, low, high in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    whole = left[::-1] + right
                    for i in range(len(whole) - width + 1):
                        h, shift = xxhash.xxh3_128_intdigest(whole[i : i + width]), i - len(left)
                        at = (low["k1"], low["k2"], low["place"] + shift, high["k1"], high["k2"], high["place"] + shift) if places else (kind, shift)
                        yield (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63), *at

        fields = "w1 long,w2 long," + ("a1 long,a2 long,a long,b1 long,b2 long,b long" if places else "kind long,shift long")
        return lambda df: df.select("kind", "right", "left", "low", "high").mapInArrow(lambda batches: _batches(rows(batches), fields, 8192), fields)

    def found(of: DataFrame) -> DataFrame:
        by_text = of.groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "anchor")).alias("places"))
        return texts.select("k1", "k2", "text", "copies").join(by_text, ["k1", "k2"]).mapInArrow(contexts, fields)

    grouped = lambda df: df.repartition("anchor").sortWithinPartitions("anchor", "right").mapInArrow(cover, ranges)
    if not n_crowded:
        return grouped(found(places))
    is_crowded = F.col("anchor") == F.col("crowd")
    calm = grouped(found(places.join(crowded, is_crowded, "left_anti")))
    dense = found(places.join(crowded, is_crowded, "left_semi"))
    calm = calm.union(dense.where("stop is not null").select("k1", "k2", F.col("place").alias("start"), "stop"))
    dense = dense.where("stop is null").withColumn("c", F.unhex(F.sha2(F.concat(F.sha2("right", 256), F.sha2("left", 256)), 256)))
    place = F.struct("k1", "k2", "place")
    kinds = dense.groupBy("anchor", "c").agg(F.first("right").alias("right"), F.first("left").alias("left"), F.min(place).alias("low"), F.max(place).alias("high"))
    kinds = reliable(kinds.where(F.length("right") + F.length("left") >= width)).withColumn("kind", F.monotonically_increasing_id())
    twice = windows(True)(kinds).groupBy("w1", "w2").agg(F.min(F.struct("a1", "a2", "a")).alias("low"), F.max(F.struct("b1", "b2", "b")).alias("high"))
    twice = twice.where((F.col("low.a1") != F.col("high.b1")) | (F.col("low.a2") != F.col("high.b2")) | (F.col("low.a") != F.col("high.b"))).select("w1", "w2")
    # all of a context that has two places is repeated; of the others, the windows that other contexts have
    alone = windows(False)(kinds.where(F.col("low") == F.col("high"))).join(twice, ["w1", "w2"], "left_semi").groupBy("kind").agg(F.min("shift").alias("from"), F.max("shift").alias("to"))
    whole = kinds.where(F.col("low") != F.col("high")).select("kind", (-F.length("left")).cast("long").alias("from"), (F.length("right") - width).cast("long").alias("to"))
    shifts = kinds.select("kind", "anchor", "c").join(alone.union(whole), "kind").drop("kind")
    return calm.union(dense.join(shifts, ["anchor", "c"]).select("k1", "k2", (F.col("place") + F.col("from")).alias("start"), (F.col("place") + F.col("to") + width).alias("stop")))


def _spans(own: list[dict]) -> list[tuple[int, int]]:
    """The ranges merged, touching ones too."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["start"], x["stop"]) for x in own):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, width: int = WIDTH, k: int = ANCHOR, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256 for each row.

    A byte goes if a string of `width` bytes that covers it also starts elsewhere, in any row; strings are judged on
    the input. Null and empty texts keep nothing and lose nothing; texts shorter than `width` stay; repeated rows are
    copies of each other and lose all from `width` bytes on; null ids are kept. An empty table gives no rows.
    """
    text = text_of(text_col)
    keyed = lean(docs).select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(F.lit(1), text).alias("k1"), F.xxhash64(F.lit(2), text).alias("k2"), text.alias("text"))
    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    ranges = covered(keyed, texts, width, k, hot).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    fields = "k1 long,k2 long,n_bytes long,n_removed long,n_spans long,kept binary,kept_sha256 string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for k1, k2, text, copies, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    raw = text.encode()
                    spans = [(0, len(raw))] if copies > 1 and len(raw) >= width else _spans(own or [])
                    kept, at = [], 0
                    for a, z in spans:
                        kept.append(raw[at:a])
                        at = z
                    kept = b"".join([*kept, raw[at:]])
                    yield k1, k2, len(raw), len(raw) - len(kept), len(spans), kept, hashlib.sha256(kept).hexdigest()

        yield from _batches(rows(), fields, 512)

    done = texts.join(ranges, ["k1", "k2"], "left").select("k1", "k2", "text", "copies", "ranges").mapInArrow(cut, fields)
    return keyed.select("doc_id", "k1", "k2").join(done, ["k1", "k2"]).drop("k1", "k2")


def removal_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs, **options).drop("kept")
