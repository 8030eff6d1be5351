"""Exact fingerprints of canonical documents.

A text's canonical form has compatibility-normalised, case-folded characters and single spaces; its fingerprint is the
128-bit xxHash of that form in UTF-8. Documents are grouped by the hash, and inside a bucket the bytes are compared. If a
bucket holds different bytes, the fingerprints of its members go on with a cryptographic digest that tells them apart.

Bytes are compared without moving the corpus: a first pass has only hashes; a bitmap of fixed size marks those that
occur more than once; a second pass sends on the canonical bytes of marked rows only, each once per task. The bitmap
spares work and decides nothing: an unmarked hash is unique, a marked one is compared.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, reliable, text_of

#: log2 of the bitmap's bits (1 MB), and different-bytes buckets that may be broadcast.
MAP_BITS, FEW_CLASHES = 23, 100_000


def canonical(text: str | None) -> bytes:
    """The canonical form in UTF-8; null is empty."""
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text or "").casefold())
    return " ".join(folded.split()).encode()


def digest(form: bytes, bits: int = 128) -> str:
    """The wide hash in hexadecimal. Fewer bits are for tests, so that buckets clash."""
    h = xxhash.xxh3_128_hexdigest(form)
    return h if bits >= 128 else f"{int(h, 16) & ((1 << bits) - 1):032x}"


def _place(d: str) -> int:
    return int(d[-16:], 16) & ((1 << MAP_BITS) - 1)


def clashes(docs: DataFrame, text_col: str = "text", bits: int = 128) -> DataFrame:
    """digest of each bucket whose members have different canonical bytes; normally no rows."""
    slim = lean(docs).select(text_of(text_col).alias("text"))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([digest(canonical(t), bits) for t in b.column(0).to_pylist()], pa.string())], names=["digest"])

    again = slim.mapInArrow(hashes, "digest string").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    place = F.conv(F.substring("digest", 17, 16), 16, 10).cast("decimal(20,0)") % F.lit(1 << MAP_BITS)
    words = again.select(place.cast("long").alias("at")).groupBy(F.expr("at div 32").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("marks")).toPandas()
    marks = np.zeros(1 << (MAP_BITS - 5), dtype=np.uint32)
    marks[words["word"].to_numpy(dtype=np.int64)] = words["marks"].to_numpy(dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(marks.tobytes())

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, dtype=np.uint32)
        for b in batches:
            seen: dict[bytes, str] = {}
            for t in b.column(0).to_pylist():
                form = canonical(t)
                d = digest(form, bits)
                at = _place(d)
                if table[at >> 5] >> np.uint32(at & 31) & np.uint32(1):
                    seen[form] = d
            yield pa.RecordBatch.from_arrays([pa.array(list(seen.values()), pa.string()), pa.array(list(seen), pa.binary())], names=["digest", "form"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, found = None, b"", []
        for b in batches:
            for d, form in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if d != now:
                    now, first = d, form
                elif form != first and (not found or found[-1] != d):
                    found.append(d)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["digest"])

    forms = slim.mapInArrow(marked, "digest string, form binary")
    return forms.repartition("digest").sortWithinPartitions("digest").mapInArrow(compare, "digest string")


def _widen(docs: DataFrame, text_col: str, bits: int, few: int) -> tuple[bool, frozenset[str]]:
    """Whether all fingerprints go on with a digest (so many clashes that they can't be broadcast), else which do."""
    clash = reliable(clashes(docs, text_col, bits))
    if clash.count() > few:
        return True, frozenset()
    return False, frozenset(r[0] for r in clash.collect())


def _name(form: bytes, bits: int, wide: bool, clash: frozenset[str]) -> str:
    d = digest(form, bits)
    return f"{d}-{hashlib.sha256(form).hexdigest()}" if wide or d in clash else d


def fingerprints(docs: DataFrame, text_col: str = "text", bits: int = 128, few: int = FEW_CLASHES, into: str = "fingerprint") -> DataFrame:
    """docs with a fingerprint: equal exactly where the canonical bytes are. Null counts as empty; empty texts are alike."""
    wide, clash = _widen(docs, text_col, bits, few)

    @F.pandas_udf("string")
    def name(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _name(canonical(t), bits, wide, clash))

    return docs.withColumn(into, name(text_of(text_col)))


def edited_pairs(docs: DataFrame, bits: int = 128, few: int = FEW_CLASHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each document.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many of the next document in
    descending doc_id, the first document coming after the last. Rows of equal id follow in order of their text, null
    ids after all others. near_* is 1 where the canonical bytes are equal, else 0. An empty table gives no rows.

    Rows are cut into ranges of ids at approximate quantiles; a cut is an id that occurs, so the row after the last of a
    range is known beforehand, and is dealt to that range as well. One shuffle of the texts; no task has more than a range.
    """
    wide, clash = _widen(docs, text_col, bits, few)
    spark = docs.sparkSession
    rows = lean(docs).select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    quantiles = rows.agg(F.max("doc_id").alias("top"), F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("cuts")).first()
    cuts = np.array(sorted({*(quantiles["cuts"] or []), quantiles["top"]} if quantiles["top"] is not None else [], reverse=True), dtype=np.int64)
    last = max(0, len(cuts) - 1)

    @F.pandas_udf("array<long>")
    def ranges(ids: pd.Series) -> pd.Series:
        out = []
        for i in ids:
            if i is None or i != i:
                out.append([2 * last])
                continue
            r = int(np.searchsorted(-cuts, -int(i), side="right")) - 1  # cuts[r] >= i > cuts[r + 1]
            out.append([2 * r, 2 * ((r - 1) if r else last) + 1] if cuts[r] == int(i) else [2 * r])
        return pd.Series(out)

    dealt = rows.select("doc_id", "text", F.explode(ranges(F.col("doc_id").cast("string"))).alias("to"))
    dealt = dealt.select("doc_id", "text", F.expr("cast(to div 2 as int)").alias("part"), (F.col("to") % 2).cast("int").alias("after"))
    dealt = dealt.repartitionById(last + 1, F.col("part")).sortWithinPartitions("part", "after", F.col("doc_id").desc_nulls_last(), "text")
    dealt = dealt.select("doc_id", "text", "after")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        first: tuple | None = None
        held: tuple | None = None
        out: list[tuple] = []

        def close(row: tuple, nxt: tuple) -> None:
            i, t, form = row
            half = len(t) // 2
            edited = t[: len(t) - half] + nxt[1][:half]
            changed = canonical(edited)
            out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), _name(form, bits, wide, clash), _name(changed, bits, wide, clash), float(changed == form), float(nxt[2] == form)))

        for b in batches:
            for i, t, after in zip(*(c.to_pylist() for c in b.columns), strict=True):
                row = (i, t, canonical(t))
                if held is not None:
                    close(held, row)
                first = first or row
                held = None if after else row
                if after:
                    break  # rows after it are other rows of the same id, which come later in the order
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                out.clear()
            if held is None and first is not None:
                for _ in batches:  # read on, or the sender waits
                    pass
                return
        if held is not None:
            close(held, first)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
