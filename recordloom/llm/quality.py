"""Quality classifier: a document's own evidence with the posterior rates of its host and path.

A logistic regression on words, pairs of words and the shape of the whole text, fitted on a bounded sample of labelled
documents, gives each document's evidence as a log-likelihood ratio. Words and pairs are hashed into a fixed number of
features, so the model's size doesn't depend on the corpus. Hosts and paths are a hierarchy of rates of good documents: a
path's rate is shrunk towards its host's, and a host's towards the global one, the more the fewer documents it has. The
strengths of both priors come from the data as well (within-group over between-group variance, as in credibility theory).
The sums by path are one grouped aggregation; a document's own share is taken out before its rate is used.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_BYTES, claim, free_name, key_of, lean, mix64, reliable, span_hashes, text_of

#: Labelled documents that the classifier is fitted on at most, and paths whose table may be broadcast.
SAMPLE, FEW_PATHS = 6000, 200_000
#: Features of shape, of words and of pairs of words; their penalties.
SHAPE, WORDS, PAIRS = 10, 256, 256
RIDGE, RIDGE_WORDS = 1e-3, 0.5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Classes of bytes: lower and upper case (with the second bytes of accented Latin letters), digits, marks that prose has few of,
#: points and commas.
_CLASSES = np.zeros((5, 256), dtype=bool)
for _row, _bytes in enumerate(((*range(97, 123), *range(0xA0, 0xC0)), (*range(65, 91), *range(0x80, 0xA0)), range(48, 58), (33, 35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 123, 124, 125, 126), (44, 46))):
    _CLASSES[_row, list(_bytes)] = True


def features(texts: Iterable[str], piece: int = 1 << 20) -> np.ndarray:
    """A row for each text: shares and logarithms that describe its shape (0 but for the first one, for a text without words),
    and the weights of its hashed words and pairs, each kind of length 1. Whole texts are read, whatever their length."""
    raw = [t.encode() for t in texts]
    out = np.zeros((len(raw), SHAPE + WORDS + PAIRS), dtype=np.float32)
    at = 0
    while at < len(raw):
        size, stop = 0, at
        while stop < len(raw) and (stop == at or size + len(raw[stop]) < piece):
            size += len(raw[stop]) + 1
            stop += 1
        _fill(raw[at:stop], out[at:stop])
        at = stop
    return out


def _fill(raw: list[bytes], out: np.ndarray) -> None:
    plain = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    size = np.array([len(r) for r in raw])
    offsets = np.concatenate([[0], np.cumsum(size + 1)])
    edge = np.diff(np.concatenate([[True], SPACE_BYTES[plain]]).astype(np.int8))
    starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    h = span_hashes(_LOWER[plain], starts, ends)
    n = np.diff(np.searchsorted(starts, offsets))
    owner = np.repeat(np.arange(len(raw)), n)
    with np.errstate(over="ignore"):
        own = mix64(h ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C55)))
    _, first = np.unique(own, return_index=True)
    distinct = np.bincount(owner[first], minlength=len(raw))
    low, up, digits, marks, stops = (np.add.reduceat(c[plain], offsets[:-1]) if len(raw) else np.zeros(0) for c in _CLASSES)
    beside = owner[1:] == owner[:-1]
    again = np.bincount(owner[1:][beside & (h[1:] == h[:-1])], minlength=len(raw))
    letters, count, whole = np.maximum(1, low + up), np.maximum(1, n), np.maximum(1, size)
    length = np.bincount(owner, weights=ends - starts, minlength=len(raw))
    shape = [np.ones(len(raw)), up / letters, marks / whole, (length - low - up) / np.maximum(1, length), again / count, np.log1p(distinct) / np.log1p(count), np.log1p(n) / 10, stops / count, digits / whole, np.minimum(3.0, length / count / 8)]
    out[:, :SHAPE] = np.stack(shape, axis=1)
    out[n == 0, 1:SHAPE] = 0
    with np.errstate(over="ignore"):
        pairs = mix64(h[:-1] * np.uint64(3) + h[1:])[beside]
    for at, width, names, who in ((SHAPE, WORDS, h, owner), (SHAPE + WORDS, PAIRS, pairs, owner[1:][beside])):
        grid = np.log1p(np.bincount(who * width + (names % np.uint64(width)).astype(np.int64), minlength=len(raw) * width).reshape(len(raw), width))
        out[:, at : at + width] = grid / np.maximum(1e-12, np.sqrt((grid * grid).sum(axis=1, keepdims=True)))


def fit(x: np.ndarray, y: np.ndarray, ridge: np.ndarray | float = RIDGE, rounds: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps with halving; zeros without rows."""
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    ridge = np.broadcast_to(np.asarray(ridge, dtype=float), w.shape)
    loss = lambda v: np.logaddexp(0, x @ v).sum() - y @ (x @ v) + (ridge * v * v).sum() / 2
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, float]:
    """Weights and the sample's rate of good documents. The sample is the `sample` labelled ids of smallest hash, and of the
    rows that repeat an id the text of smallest hash, so reruns agree and no more rows than that reach the driver."""
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("labelled")).agg(F.max(label_col).cast("double").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("labelled"), "labelled").limit(sample)

    @F.pandas_udf("binary")
    def shape(texts: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in features(texts)])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).join(F.broadcast(chosen), F.col("id") == F.col("labelled"))
    rows = rows.groupBy("labelled", "y").agg(F.min(F.struct(F.xxhash64("t"), "t")).getField("t").alias("t")).select("labelled", shape("t").alias("x"), "y").toPandas().sort_values("labelled")
    y = rows["y"].to_numpy(dtype=float)
    rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    x = np.frombuffer(b"".join(rows["x"]), dtype=np.float32).reshape(len(y), SHAPE + WORDS + PAIRS).astype(float)
    return fit(x, y, np.repeat([RIDGE, RIDGE_WORDS], [SHAPE, WORDS + PAIRS])), rate


def _logit(c: Column) -> Column:
    p = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), c))
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, threshold: float = 0.5, sample: int = SAMPLE, few_paths: int = FEW_PATHS, id_col: str = "doc_id", text_col: str = "text", into: str = "quality", carry: list[str] | None = None) -> DataFrame:
    """docs with one more column, a struct: evidence (probability from the text alone), host_rate, path_rate, posterior, keep.

    host is the column `source` and path `source` with `lang`, unless given. Null hosts and paths are groups of their own;
    null text is classified as empty text. Without labels the evidence is 0.5 and everything is kept. Repeated rows
    are classified alike; an empty table gives no rows. Extra columns are kept (of them, those in `carry`, if given: without the
    text among them, evidence is found once and kept in the shared folder); ValueError if the struct's name is taken.
    """
    claim(docs if carry is None else docs.select(*carry), into)
    docs = lean(docs)
    weights, base = train(docs, labels, sample, id_col, text_col)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(features(texts).astype(float) @ weights)

    calc, rest = free_name(docs, "calc"), [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]
    host = key_of("source") if host is None else F.coalesce(host.cast("string"), F.lit(""))
    path = F.concat_ws("/", host, key_of("lang")) if path is None else F.concat_ws("/", host, F.coalesce(path.cast("string"), F.lit("")))
    rows = docs.select(*rest, F.struct(host.alias("h"), path.alias("p"), (1 / (1 + F.exp(-score(text_of(text_col))))).alias("e")).alias(calc))
    rows = rows if carry is None or text_col in carry else reliable(rows)

    slim = rows.select(f"{calc}.*")
    paths = reliable(slim.groupBy("h", "p").agg(F.count("*").alias("n_p"), F.sum("e").alias("s_p"), F.sum(F.col("e") * F.col("e")).alias("q_p")))
    hosts = paths.groupBy("h").agg(F.sum("n_p").alias("n_h"), F.sum("s_p").alias("s_h"), F.sum("q_p").alias("q_h"))
    within = lambda n, s, q: F.sum(F.col(q) - F.col(s) * F.col(s) / F.col(n))
    by_host = hosts.agg(F.sum("n_h").alias("n"), F.sum("s_h").alias("s"), F.count("*").alias("k"), within("n_h", "s_h", "q_h").alias("w"), F.sum(F.col("n_h") * F.col("n_h").cast("double")).alias("n2"), F.sum("q_h").alias("q")).first()
    by_path = paths.agg(F.count("*").alias("k"), within("n_p", "s_p", "q_p").alias("w"), F.sum(F.col("n_p") * F.col("n_p").cast("double")).alias("n2")).first()
    total, mean = (by_host["n"], by_host["s"] / by_host["n"]) if by_host["n"] else (0, base)

    def strength(groups: int, inner: float, outer: float, n2: float, above: int) -> float:
        """Documents that the prior counts for: variance within groups over variance between them."""
        if total <= groups or groups <= above:
            return 100.0
        noise = max(inner / (total - groups), 1e-9)
        between = (outer - inner - (groups - above) * noise) / max(total - n2 / total, 1.0)
        return float(np.clip(noise / max(between, 1e-9), 2.0, 10_000.0))

    spread = (by_host["q"] - by_host["s"] ** 2 / total) if total else 0.0
    k_host = strength(by_host["k"], by_host["w"] or 0.0, spread, by_host["n2"] or 0.0, 1)
    k_path = strength(by_path["k"], by_path["w"] or 0.0, by_host["w"] or 0.0, by_path["n2"] or 0.0, by_host["k"])

    by = free_name(docs, "site")
    sites = reliable(paths.join(hosts, "h").select(F.struct("p", "n_p", "s_p", "n_h", "s_h").alias(by)))
    if sites.count() <= few_paths:
        sites = F.broadcast(sites)
    e = F.col(f"{calc}.e")
    host_rate = (F.col(f"{by}.s_h") - e + k_host * mean) / (F.col(f"{by}.n_h") - 1 + k_host)
    path_rate = (F.col(f"{by}.s_p") - e + k_path * host_rate) / (F.col(f"{by}.n_p") - 1 + k_path)
    log_odds = _logit(e) - float(np.log(base / (1 - base))) + _logit(path_rate)
    posterior = 1 / (1 + F.exp(-log_odds))
    if not np.any(weights):
        posterior = F.lit(0.5)
    out = rows.join(sites, F.col(f"{calc}.p") == F.col(f"{by}.p"), "left")
    return out.select(*rest, F.struct(e.alias("evidence"), host_rate.alias("host_rate"), path_rate.alias("path_rate"), posterior.alias("posterior"), (posterior >= threshold).alias("keep")).alias(into))
