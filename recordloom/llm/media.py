"""Media columns: what binary values really are.

An Aho-Corasick automaton finds every place of a value where magic bytes stand. A validator for each format then reads
the structure from there (chunk lengths, check sums, markers) and says where the object ends, or that there is none. An
object at place 0 gives the value its type, whatever type was declared; objects further on are carved out.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, text_of

#: Magic bytes, how far from an object's start they stand, and the format.
MAGIC = [
    (b"\x89PNG\r\n\x1a\n", 0, "image/png"),
    (b"\xff\xd8\xff", 0, "image/jpeg"),
    (b"GIF87a", 0, "image/gif"),
    (b"GIF89a", 0, "image/gif"),
    (b"BM", 0, "image/bmp"),
    (b"RIFF", 0, "riff"),
    (b"fLaC", 0, "audio/flac"),
    (b"OggS", 0, "audio/ogg"),
    (b"ftyp", 4, "video/mp4"),
    (b"%PDF-", 0, "application/pdf"),
    (b"PK\x03\x04", 0, "application/zip"),
]


@dataclass(frozen=True)
class Found:
    start: int
    end: int
    kind: str
    detail: str = ""


def _png(b: bytes, at: int) -> tuple[int, str, str] | None:
    i, detail = at + 8, ""
    while i + 12 <= len(b):
        n, name = struct.unpack_from(">I4s", b, i)
        if i + 12 + n > len(b) or zlib.crc32(b[i + 4 : i + 8 + n]) != struct.unpack_from(">I", b, i + 8 + n)[0]:
            return None
        if i == at + 8:
            if name != b"IHDR" or n != 13:
                return None
            w, h, depth, colour = struct.unpack_from(">IIBB", b, i + 8)
            detail = f"{w}x{h}x{depth}c{colour}"
        i += 12 + n
        if name == b"IEND":
            return i, "image/png", detail
    return None


def _jpeg(b: bytes, at: int) -> tuple[int, str, str] | None:
    i, detail = at + 2, ""
    while i + 4 <= len(b):
        if b[i] != 0xFF:
            return None
        mark = b[i + 1]
        if mark == 0xFF:
            i += 1
            continue
        n = struct.unpack_from(">H", b, i + 2)[0]
        if n < 2 or i + 2 + n > len(b):
            return None
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC) and n >= 8:
            h, w = struct.unpack_from(">HH", b, i + 5)
            detail = f"{w}x{h}"
        i += 2 + n
        if mark == 0xDA:
            while (i := b.find(b"\xff", i)) >= 0 and i + 1 < len(b):
                if b[i + 1] == 0xD9:
                    return (i + 2, "image/jpeg", detail) if detail else None
                if b[i + 1] != 0 and not 0xD0 <= b[i + 1] <= 0xD7:
                    break
                i += 2
            else:
                return None
    return None


def _gif(b: bytes, at: int) -> tuple[int, str, str] | None:
    if at + 13 > len(b):
        return None
    w, h, flags = struct.unpack_from("<HHB", b, at + 6)
    i = at + 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)
    while i < len(b):
        if b[i] == 0x3B:
            return i + 1, "image/gif", f"{w}x{h}"
        if b[i] == 0x21:
            i += 2
        elif b[i] == 0x2C and i + 10 <= len(b):
            i += 11 + (3 << ((b[i + 9] & 7) + 1) if b[i + 9] & 0x80 else 0)
        else:
            return None
        while i < len(b) and b[i]:
            i += 1 + b[i]
        i += 1
    return None


def _bmp(b: bytes, at: int) -> tuple[int, str, str] | None:
    if at + 30 > len(b):
        return None
    size, reserved, offset, header, w, h, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    if reserved or header not in (40, 52, 56, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or w <= 0 or not h:
        return None
    if offset < 14 + header or at + size > len(b) or size < offset or (size - offset) < ((w * bits + 31) // 32 * 4 * abs(h) if bits >= 16 else 0):
        return None
    return at + size, "image/bmp", f"{w}x{abs(h)}x{bits}"


def _riff(b: bytes, at: int) -> tuple[int, str, str] | None:
    if at + 12 > len(b):
        return None
    size, form = struct.unpack_from("<I4s", b, at + 4)
    kinds = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/avi"}
    end, i, detail, data = at + 8 + size, at + 12, "", False
    if form not in kinds or end > len(b):
        return None
    while i + 8 <= end:
        name, n = struct.unpack_from("<4sI", b, i)
        if i + 8 + n > end:
            return None
        if name == b"fmt " and n >= 16:
            code, channels, rate, _, block, bits = struct.unpack_from("<HHIIHH", b, i + 8)
            if form == b"WAVE" and (not channels or code == 1 and block != channels * ((bits + 7) // 8)):
                return None
            detail = f"pcm{code}:{channels}ch:{rate}Hz:{bits}bit"
        data |= name in (b"data", b"VP8 ", b"VP8L", b"VP8X", b"LIST")
        i += 8 + n + (n & 1)
    return (end, kinds[form], detail) if i in (end, end + 1) and data and (form != b"WAVE" or detail) else None


def _flac(b: bytes, at: int) -> tuple[int, str, str] | None:
    """Blocks of metadata, then frames. The format has no length of the whole, so the object is taken to end with the value."""
    i, first = at + 4, True
    while i + 4 <= len(b):
        n = int.from_bytes(b[i + 1 : i + 4], "big")
        if first and (b[i] & 0x7F or n != 34):
            return None
        if first and i + 38 <= len(b):  # stream parameters: 20 bits of rate, 3 of channels, 5 of sample size
            packed = int.from_bytes(b[i + 14 : i + 18], "big")
            rate, channels, bits = packed >> 12, (packed >> 9 & 7) + 1, (packed >> 4 & 31) + 1
        elif first:
            return None
        last, first = b[i] & 0x80, False
        i += 4 + n
        if last:
            return (len(b), "audio/flac", f"{rate}Hz:{channels}ch:{bits}bit") if i + 2 <= len(b) and b[i] == 0xFF and b[i + 1] & 0xFC == 0xF8 else None
    return None


def _ogg(b: bytes, at: int) -> tuple[int, str, str] | None:
    i = at
    while b.startswith(b"OggS\x00", i) and i + 27 <= len(b):
        n = b[i + 26]
        end = i + 27 + n + sum(b[i + 27 : i + 27 + n])
        if i + 27 + n > len(b) or end > len(b):
            return None
        flags, i = b[i + 5], end
        if flags & 4:
            return i, "audio/ogg", ""
    return None


def _mp4(b: bytes, at: int) -> tuple[int, str, str] | None:
    i, names = at, []
    while i + 8 <= len(b):
        n, name = struct.unpack_from(">I4s", b, i)
        if n < 8 or i + n > len(b) or not (name.isalnum() or name.strip().isalnum()):
            break
        names.append(name)
        i += n
    return (i, "video/mp4", b[at + 8 : at + 12].decode("latin-1")) if b"moov" in names or b"mdat" in names or b"moof" in names else None


def _pdf(b: bytes, at: int, ends: "Ends") -> tuple[int, str, str] | None:
    """From the header to the last end mark before the next header; updates of a file append sections with end marks of their
    own, another file starts with a header."""
    if at + 8 > len(b) or not b[at + 5 : at + 6].isdigit():
        return None
    mark = ends.last(b"startxref", at, ends.next(b"%PDF-", at + 5, len(b)))
    end = ends.next(b"%%EOF", mark, -1) if mark >= 0 else -1
    return (end + 5, "application/pdf", b[at + 5 : at + 8].decode("latin-1")) if end > 0 and ends.next(b" obj", at, len(b)) < end else None


def _zip(b: bytes, at: int, ends: "Ends") -> tuple[int, str, str] | None:
    """The end record that counts its places from here; entries that are stored archives have end records of their own."""
    mark = ends.zipped().get(at, -1)
    if mark < 0:
        return None
    n, note = struct.unpack_from("<H", b, mark + 10)[0], struct.unpack_from("<H", b, mark + 20)[0]
    return mark + 22 + note, "application/zip", f"{n} entries"


class Ends:
    """Places of end marks in a value, each kind found once."""

    def __init__(self, value: bytes) -> None:
        self.value = value
        self.places: dict[bytes, list[int]] = {}
        self.archives: dict[int, int] | None = None

    def all(self, word: bytes) -> list[int]:
        if word not in self.places:
            self.places[word] = [m.start() for m in re.finditer(re.escape(word), self.value)]
        return self.places[word]

    def next(self, word: bytes, at: int, none: int) -> int:
        """The first place from `at` on."""
        places = self.all(word)
        i = bisect_left(places, at)
        return places[i] if i < len(places) else none

    def last(self, word: bytes, at: int, stop: int) -> int:
        """The last place from `at` on that is before `stop`, -1 if there is none."""
        places = self.all(word)
        i = bisect_left(places, stop) - 1
        return places[i] if i >= 0 and places[i] >= at else -1

    def zipped(self) -> dict[int, int]:
        """The last end record of each archive, by the place where the archive starts."""
        if self.archives is None:
            self.archives = {}
            for mark in self.all(b"PK\x05\x06"):
                if mark + 22 <= len(self.value):
                    size, offset, note = struct.unpack_from("<IIH", self.value, mark + 12)
                    if mark + 22 + note <= len(self.value) and mark >= offset + size:
                        self.archives[mark - offset - size] = mark
        return self.archives


VALIDATORS = {"image/png": _png, "image/jpeg": _jpeg, "image/gif": _gif, "image/bmp": _bmp, "riff": _riff, "audio/flac": _flac, "audio/ogg": _ogg, "video/mp4": _mp4, "application/pdf": _pdf, "application/zip": _zip}
#: Validators that search for an end mark; they share one search of the value.
LOOK_AHEAD = frozenset(("application/pdf", "application/zip"))


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for magic, before, kind in MAGIC:
        a.add_word(magic.decode("latin-1"), (len(magic), before, kind))
    a.make_automaton()
    return a


def sniff(value: bytes | None) -> list[Found]:
    """The valid objects in a value, outermost only, in order of place. Null and empty values have none."""
    out: list[Found] = []
    if not value:
        return out
    ends = Ends(value)
    places = sorted({(stop + 1 - size - before, kind) for stop, (size, before, kind) in _automaton().iter(value.decode("latin-1"))})
    free = 0
    for at, kind in places:
        if at >= free and (got := VALIDATORS[kind](value, at, ends) if kind in LOOK_AHEAD else VALIDATORS[kind](value, at)):
            out.append(Found(at, got[0], got[1], got[2]))
            free = got[0]
    return out


def wav8(payload: bytes, rate: int = 8000) -> bytes:
    """A RIFF/WAVE file of one channel whose unsigned 8-bit samples are the payload's bytes."""
    pad = b"\0" * (len(payload) & 1)
    head = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, rate, 1, 8)
    return b"RIFF" + struct.pack("<I", 4 + len(head) + 8 + len(payload) + len(pad)) + b"WAVE" + head + struct.pack("<4sI", b"data", len(payload)) + payload + pad


def wav_samples(value: bytes, start: int, end: int) -> bytes:
    """The bytes of the data chunk of the WAVE object that stands at start."""
    i = start + 12
    while i + 8 <= end:
        name, n = struct.unpack_from("<4sI", value, i)
        if name == b"data":
            return value[i + 8 : i + 8 + n]
        i += 8 + n + (n & 1)
    raise ValueError("no data chunk")


def sample_features(samples: bytes) -> str:
    """What unsigned 8-bit samples are like: peak, mean, root mean square around the middle, crossings of the middle, entropy in
    bits, and energy in eight bands of the spectrum (in thousandths, over windows of 192 samples, all of them)."""
    x = np.frombuffer(samples, dtype=np.uint8)
    if not len(x):
        return "peak=0;mean=0;rms=0;cross=0;entropy=0;bands="
    n, total, square, cross, peak = len(x), 0, 0, 0, 0
    counts, bands = np.zeros(256, dtype=np.int64), np.zeros(8)
    for at in range(0, n, 192 << 10):
        part = x[at : at + (192 << 10)].astype(np.int64) - 128
        counts += np.bincount(part + 128, minlength=256)
        total, square, peak = total + int(part.sum()), square + int((part * part).sum()), max(peak, int(np.abs(part).max()))
        sign = (x[max(0, at - 1) : at + (192 << 10)] >= 128).astype(np.int8)
        cross += int(np.abs(np.diff(sign)).sum())
        frames = part[: len(part) // 192 * 192].reshape(-1, 192)
        if len(frames):
            power = np.abs(np.fft.rfft(frames - frames.mean(axis=1, keepdims=True), axis=1)[:, 1:97]) ** 2
            bands += power.sum(axis=0).reshape(8, 12).sum(axis=1)
    share = counts[counts > 0] / n
    shown = (1000 * bands / max(bands.sum(), 1e-9)).round().astype(int)
    return f"peak={peak};mean={total / n:.3f};rms={(square / n) ** 0.5:.3f};cross={cross};entropy={-(share * np.log2(share)).sum() + 0.0:.3f};bands={','.join(map(str, shown))}"


def inspect(df: DataFrame, value_col: str, declared_col: str | None = None, id_col: str = "id") -> DataFrame:
    """id, declared, kind, corrected, objects (array of start, end, kind, detail, sha256) for each row of a binary column.

    kind is the type of the object that spans from place 0 to the end (null if there is none: null, empty, cut off or
    foreign values); corrected says that it differs from the declared one. objects has every carved object, also those
    inside foreign bytes. Rows are independent: no shuffle; repeated rows, null ids and empty tables need no care.
    """
    cols = [df[id_col].cast("string").alias("id"), df[value_col].cast("binary").alias("value")]
    cols.append(df[declared_col].cast("string").alias("declared") if declared_col else F.lit(None).cast("string").alias("declared"))
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("detail", pa.string()), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, fixed, objects = [], [], []
            for value, said in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found = sniff(value)
                real = found[0].kind if found and found[0].start == 0 and found[0].end == len(value) else None
                kinds.append(real)
                fixed.append(bool(real and said and real != said))
                objects.append([{"start": f.start, "end": f.end, "kind": f.kind, "detail": f.detail, "sha256": hashlib.sha256(value[f.start : f.end]).hexdigest()} for f in found])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(kinds, pa.string()), pa.array(fixed, pa.bool_()), pa.array(objects, pa.list_(kind))], names=["id", "declared", "kind", "corrected", "objects"])

    return lean(df).select(*cols).mapInArrow(run, "id string, declared string, kind string, corrected boolean, objects array<struct<start:long,end:long,kind:string,detail:string,sha256:string>>")


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = 192) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, declared, kind,
    corrected, objects.

    Each whole text (null: empty) as UTF-8, with spaces up to a positive multiple of `unit`, becomes the samples of a
    stored WAVE value, which is declared to be unknown bytes. The stored bytes alone are then sniffed: the object that
    spans them is validated and corrects the declared type, its samples are read back, and objects inside the samples are
    carved (type:place:length, joined by commas). The digests and features are of what was read. feature: type, parameters
    and sample_features. One row for each row; equal texts give equal values; ids may be null or repeated.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "declared", "kind", "corrected", "objects"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string()]
    declared = "application/octet-stream"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = text.encode()
                stored = wav8(raw + b" " * (-len(raw) % unit or unit * (not raw)))
                whole = sniff(stored)[0]
                back = wav_samples(stored, whole.start, whole.end)
                objects = ",".join(f"{f.kind}:{f.start}:{f.end - f.start}" for f in sniff(back))
                feature = f"{whole.kind};{whole.detail};{len(back)} samples;{sample_features(back)}"
                rows.append((i, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, declared, whole.kind, whole.kind != declared, objects))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(names), types, strict=True)], names=names)

    rows = lean(docs).select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, declared string, kind string, corrected boolean, objects string")
