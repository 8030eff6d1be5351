"""Byte-pair encoding and decoding with a trie that shares prefixes between words.

The vocabulary file has merges for words whose last symbol carries an end mark. Texts are cut into words; the distinct
words of a batch that were not met before make a trie. One depth-first walk keeps, for each prefix on the path, the
last token of the prefix's encoding, found when a word below first needs it. Byte-pair encoding has the property that a sequence of tokens is the encoding of
its text if and only if each pair of neighbours is the encoding of its own text; so the last token of a prefix is the
token that ends there and may follow the last token of the shorter prefix before it. Each prefix is thus worked out once
for all words that begin with it.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import lean, text_of, trim

#: Fixed values of the vocabulary's format: the end mark, white space as the format's patterns see it, the word pattern.
END = "</w>"
#: Symbols from which the states of a path are found as it grows, so that finding them doesn't nest deep.
EAGER = 64
_WS = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_WS}\p{{L}}\p{{N}}]+")
#: From this character on, Python's Unicode tables may be of another version than the format's. Below it, the same pattern
#: with its classes spelled out, which the standard library matches faster.
_FAR = re.compile("[\u0250-\U0010ffff]")
_LETTERS, _NUMBERS = ("".join(re.escape(c) for c in map(chr, range(0x250)) if regex.match(k, c)) for k in (r"\p{L}", r"\p{N}"))
_NEAR_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_WS}{_LETTERS}{_NUMBERS}]+")


def _byte_signs() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def _rare() -> re.Pattern:
    """Characters without a meaning in Python's Unicode tables, or with another one in the pattern library's; the texts that have
    any are cut by the tokenizer's own tables."""
    from tokenizers import Regex, pre_tokenizers

    codes = np.concatenate([np.arange(0x250, 0xD800), np.arange(0xE000, 0x110000)])
    chars = codes.astype("<u4").tobytes().decode("utf-32-le")
    odd = np.fromiter((unicodedata.category(c) == "Cn" for c in chars), dtype=bool, count=len(chars))
    for kind in (r"\p{L}+", r"\p{N}+"):
        differ = np.zeros(len(chars), dtype=bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(kind), "removed", invert=True).pre_tokenize_str(chars):
            differ[a:b] ^= True
        for m in regex.finditer(kind, chars):
            differ[m.start() : m.end()] ^= True
        odd |= differ
    codes = codes[odd].tolist()
    cuts = [0, *(i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1), len(codes)]
    return re.compile("[" + "".join(f"{chr(codes[a])}-{chr(codes[b - 1])}" for a, b in zip(cuts, cuts[1:], strict=False)) + "]")


class TrieBpe:
    """Encoder and decoder of one vocabulary file. `cached` bounds the words whose encodings are kept between batches."""

    def __init__(self, path: str, cached: int = 120_000, max_pairs: int = 120_000):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[a, b] = r
            self.parts[a + b] = (a, b)
        self.tails: dict[str, bool] = {}  # all ends of tokens, so that the search for those that end at a place can stop; True: a token
        for t in self.ids:
            stem = t[: -len(END)] if t.endswith(END) and t != END else t
            self.tails.update(dict.fromkeys((t[i:] for i in range(len(stem))), False))
        self.tails.update(dict.fromkeys(self.ids, True))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_at = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.signs = _byte_signs()
        self.sign_bytes = {c: b for b, c in enumerate(self.signs)}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.names: list[str] = [""] * size
        for t, i in [*self.ids.items(), *self.special.items()]:
            self.names[i] = t
        self.cached, self.max_pairs = cached, max_pairs
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.plain = {i: self.signs[i] for i in range(256)}

    def _spine(self, token: str, right: bool) -> list[tuple[str, float]]:
        """The symbols that stand at one end of the token while it is being merged, each with the rank of the merge
        that uses it up (infinite for the token itself)."""
        out, t, until = [], token, float("inf")
        while True:
            out.append((t, until))
            if t not in self.parts:
                return out[::-1]
            until = self.rank[self.parts[t]]
            t = self.parts[t][1 if right else 0]

    def may_follow(self, a: str, b: str) -> bool:
        """Whether encoding the text of a and b together gives just a, b: no merge across the border comes first."""
        known = self.pairs.get((a, b))
        if known is None:
            left, right, i, j, known = self._spine(a, True), self._spine(b, False), 0, 0, True
            while True:
                (x, x_until), (y, y_until) = left[i], right[j]
                across = self.rank.get((x, y), float("inf"))
                if across < x_until and across <= y_until and across != float("inf"):  # of equal ranks the leftmost merges first
                    known = False
                    break
                if i == len(left) - 1 and j == len(right) - 1:
                    break
                if x_until <= y_until:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) >= self.max_pairs:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def _last(self, path: str, tail: str, last: list[str]) -> str:
        """The last token of the encoding of path, which ends in the symbol tail; last[d] is that of its first d + 1 symbols,
        None until it's asked for."""
        tails, pairs, at, found = self.tails, self.pairs, len(path) - 1, []
        while (whole := tails.get(tail)) is not None:
            if whole:
                found.append((at, tail))
            if not at:
                break
            at -= 1
            tail = path[at] + tail
        for at, token in reversed(found):
            if not at:
                return token
            before = last[at - 1]
            if before is None:
                before = last[at - 1] = self._last(path[:at], path[at - 1], last)
            pair = (before, token)
            fits = pairs.get(pair)
            if fits or fits is None and self.may_follow(*pair):
                return token
        raise ValueError(f"the vocabulary has no symbol for {path[-1]!r}")

    def learn(self, new: dict[str, str]) -> None:
        """Work out the encodings of words through a trie of them all; new: the words by their byte signs.

        Sorted, the words are their trie in depth-first order: from one word to the next, the path is cut back to what
        they share and grows again, and so is the list of the path's last tokens.
        """
        find, words, ids, last, before = self._last, self.words, self.ids, [], ""
        for w in sorted(new):
            n = len(w) - 1
            shared = 0
            for x, y in zip(before, w, strict=False):
                if x != y:
                    break
                shared += 1
            before = w[:n]  # the last symbol carries the end mark, so it is a leaf of its own
            if shared > n:
                shared = n
            del last[shared:]
            last += [None] * (n - shared)
            for at in range(max(shared, EAGER), n):
                last[at] = find(w[: at + 1], w[at], last)
            token = find(w, w[n] + END, last)
            found = [ids[token]]
            at = n + 1 + len(END) - len(token)
            while at:
                token = last[at - 1]
                if token is None:
                    token = last[at - 1] = find(w[:at], w[at - 1], last)
                found.append(ids[token])
                at -= len(token)
            words[new[w]] = pack(f"<{len(found)}I", *found[::-1])

    def words_of(self, text: str) -> list[str]:
        """The words of a text without special tokens, composed and lower-cased."""
        low = text.lower()
        if not _FAR.search(low):  # nothing in it can be composed
            return _NEAR_WORDS.findall(low)
        if _rare().search(text):
            return [bytes(self.sign_bytes[c] for c in w).decode() for w, _ in self.exact.pre_tokenizer.pre_tokenize_str(self.exact.normalizer.normalize_str(text))]
        return _WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _encode_plain(self, texts: list[list[str]]) -> list[bytes]:
        words = set().union(*texts)
        missing = words - self.words.keys()
        if len(self.words) + len(missing) > self.cached:  # frequent words are in any batch, so they stay
            self.words = {w: self.words[w] for w in words - missing}
        kept = self.words
        self.learn({w.encode().decode("latin-1").translate(self.plain): w for w in missing})
        return [b"".join(map(kept.__getitem__, words)) for words in texts]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. Special tokens in a text become their ids."""
        pieces: list[list[str]] = []
        plan: list[list[tuple[bool, int]]] = []
        for t in texts:
            own = []
            for p in self.special_at.split(t) if self.special_at is not None else [t]:
                if p in self.special:
                    own.append((True, self.special[p]))
                elif p:
                    own.append((False, len(pieces)))
                    pieces.append(self.words_of(p))
            plan.append(own)
        done = self._encode_plain(pieces)
        return [b"".join([np.uint32(i).astype("<u4").tobytes() if s else done[i] for s, i in own]) for own in plan]

    def decode(self, ids: bytes) -> str:
        """The tokens' strings with a space between, as the format without a decoder has it."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


@lru_cache(maxsize=2)
def coder(path: str) -> TrieBpe:
    return TrieBpe(path)


def _release() -> None:
    """Let the tables go at the end of a partition: a worker outlives the stage, and the next one needs the memory. They load in a
    fraction of a second, and a partition meets most of its frequent words in its first batches."""
    coder.cache_clear()
    trim()


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (binary, little-endian unsigned 32-bit), decoded (string), a row for each row of docs, without a shuffle.

    Null and empty texts have no ids and an empty decoded text. Very long texts are encoded whole. Repeated rows, null
    ids and an empty table need no care; columns other than the two are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocab_path)
        for batch in batches:
            for part in _slices(batch):
                ids = bpe.encode_batch(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])
        _release()

    rows = lean(docs).select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")


def encode_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: `encode` with the outputs digested where they are made, so that
    only digests leave the Python worker. Same cases as `encode`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocab_path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for part in _slices(batch):
                ids = bpe.encode_batch(part.column(1).to_pylist())
                out = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([sha(x) for x in ids]), pa.array([sha(bpe.decode(x).encode()) for x in ids])]
                yield pa.RecordBatch.from_arrays([part.column(0), *out], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        _release()

    rows = lean(docs).select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
