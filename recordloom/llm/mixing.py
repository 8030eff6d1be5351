"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources in code-point order have weights from a repeating pattern and share a budget; no target passes `most` times its
source's size. That water filling has a closed form: sorted by cap over weight, a source is capped if what the earlier
caps leave, shared by weight among it and all later ones, reaches its cap. So it's a window over one row per source.

A source takes whole epochs first. What then remains is a sample without replacement: each document has a key
-ln(u) / quality weight with u a hash in (0, 1), and documents are taken in the order of their keys while the sum fits the
budget. The gap before the document that doesn't fit is filled in the same way, in the same order, from the documents
that are no larger than the gap; a few such rounds leave a gap of a few words, except where only large documents are left.

The running sum over a source isn't made in one task: keys fall into bins of a fixed map, the sums by bin are run up, and
only the one bin of each source in which the budget ends is ordered. The result is a few cut keys for each source, so
whether a document is taken is seen from its own row; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, claim, free_name, key_of, order_bits, reliable, text_of

PATTERN = (5, 2, 1)


def word_count(text_col: str = "text") -> Column:
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def _uniform(text: Column) -> Column:
    """A number in (0, 1) from 52 bits of the text's md5, which SQL engines share."""
    return (F.conv(F.substring(F.md5(F.encode(text, "utf-8")), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def quality_weight(text_col: str = "text", size: Column | None = None) -> Column:
    """From 0.25 to 1: highest where words have 6 characters on average, white space included."""
    n = F.greatest(F.lit(1), word_count(text_col) if size is None else size)
    return F.lit(0.25) + F.lit(0.75) * F.exp(-F.pow((F.length(text_of(text_col)) / n - 6) / 4, F.lit(2)))


def source_targets(sizes: DataFrame, share: float = 1.5, most: int = 2, pattern: tuple[int, ...] = PATTERN) -> DataFrame:
    """src, source_size, target for a table of src, source_size with one row per source."""
    every = Window.partitionBy()
    s = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, pattern)), (F.row_number().over(Window.orderBy("src")) - 1) % len(pattern) + 1))
    s = s.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    in_order = Window.orderBy("ratio", "src")
    left = F.lit(share) * F.sum("source_size").over(every) - (F.sum("cap").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    s = s.withColumn("level", left / F.sum("w").over(in_order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("capped", F.col("level") >= F.col("ratio"))
    open_level = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)
    return s.select("src", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("w") * open_level).alias("target"))


def _in_cut(size: Column, bin_: Column, at: Column, cut: str) -> Column:
    """Whether a document is taken by a round's cut: it's no larger than the gap, and its key isn't after the cut."""
    early = (bin_ < F.col(f"{cut}.end_bin")) | (bin_ == F.col(f"{cut}.end_bin")) & (at <= F.col(f"{cut}.last"))
    return F.coalesce((size <= F.col(f"{cut}.gap")) & early, F.lit(False))


def _fill(slim: DataFrame, state: DataFrame, bins: int, done: list[str], cut: str) -> DataFrame:
    """state with one more cut (gap, end_bin, last) and with what is left after it."""
    free = slim.join(state, "src").where(F.col("size") <= F.col("left"))
    for c in done:
        free = free.where(~_in_cut(F.col("size"), F.col("bin"), F.col("at"), c))
    free = free.select("src", "size", "bin", "at", "left")
    sums = free.groupBy("src", "bin", "left").agg(F.sum("size").alias("in_bin"))
    sums = sums.withColumn("up_to", F.sum("in_bin").over(Window.partitionBy("src").orderBy("bin")))
    ends = sums.groupBy("src").agg(
        F.min(F.when(F.col("up_to") > F.col("left"), F.col("bin"))).alias("end_bin"),
        F.coalesce(F.max(F.when(F.col("up_to") <= F.col("left"), F.col("up_to"))), F.lit(0)).alias("before"),
    )
    open_ = ends.where(F.col("end_bin").isNotNull()).select(F.col("src").alias("s"), F.col("end_bin").alias("b"), "before")
    inside = free.join(open_, (F.col("src") == F.col("s")) & (F.col("bin") == F.col("b")))
    up_to = F.col("before") + F.sum("size").over(Window.partitionBy("src").orderBy("at"))  # equal rows stand or fall together
    last = inside.withColumn("up_to", up_to).where(F.col("up_to") <= F.col("left")).groupBy("src").agg(F.max("at").alias("last"), F.max("up_to").alias("reached"))
    out = state.join(ends, "src", "left").join(last, "src", "left")
    taken = F.coalesce(F.col("reached"), F.col("before"), F.lit(0))
    found = F.struct(F.col("left").alias("gap"), F.when(F.col("before").isNotNull(), F.coalesce(F.col("end_bin"), F.lit(bins))).otherwise(F.lit(0)).alias("end_bin"), F.col("last"))
    return out.select(*[c for c in state.columns if c != "left"], (F.col("left") - taken).alias("left"), found.alias(cut))


def take_counts(docs: DataFrame, quality: Column | None = None, seed: int = 29, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5, most: int = 2, pattern: tuple[int, ...] = PATTERN, rounds: int = 3, few_sources: int = 100_000, into: str = "mix") -> DataFrame:
    """docs with one more column, a struct: size, source_size, target, copies (times the mix takes the whole document).

    The first round comes as near as half a document's size on average, each further round much nearer; at last the
    smallest document that is left goes in too, if that brings the sum nearer to the target than without. Null text has size 0; null sources are one source, last in order; null ids count like others. Equal
    rows have equal keys and are taken or left together. A source of size 0 has target 0. Reruns agree. An empty table
    gives no rows. Extra columns are kept; ValueError if the struct's name is taken.
    """
    claim(docs, into)
    size = word_count(text_col)
    calc, rest = free_name(docs, "calc"), [F.col(f"`{c}`") for c in docs.columns]
    u = _uniform(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.encode(text_of(text_col), "utf-8"))))
    q = quality_weight(text_col, size) if quality is None else F.greatest(F.lit(1e-6), F.coalesce(quality, F.lit(1.0)))
    key = -F.log(u) / q
    bins = 1 << max(8, order_bits(docs.count()))
    bin_ = F.least(F.lit(bins - 1), F.floor((1 - F.exp(-key / 2)) * bins)).cast("int")
    rows = docs.select(*rest, F.struct(key_of(source_col).alias("src"), size.alias("size"), bin_.alias("bin"), F.struct(key.alias("key"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("id")).alias("at")).alias(calc))

    slim = reliable(rows.select(f"{calc}.*"))
    targets = source_targets(slim.groupBy("src").agg(F.sum("size").alias("source_size")), share, most, pattern)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    state = reliable(targets.withColumn("epochs", epochs).withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size")))
    few = state.count() <= few_sources
    cuts = [f"cut{r}" for r in range(rounds)]
    for r, cut in enumerate(cuts):
        state = reliable(_fill(slim, F.broadcast(state) if few else state, bins, cuts[:r], cut))
    free = slim.join(F.broadcast(state) if few else state, "src").where("size > 0 and size < 2 * left")
    for cut in cuts:
        free = free.where(~_in_cut(F.col("size"), F.col("bin"), F.col("at"), cut))
    extra = free.groupBy("src").agg(F.min(F.struct("size", "at")).alias("extra"))
    state = reliable(state.join(extra.select("src", F.col("extra.at").alias("extra")), "src", "left"))
    by = free_name(docs, "state")
    state = state.select(F.struct(*state.columns).alias(by))
    out = rows.join(F.broadcast(state) if few else state, F.col(f"{calc}.src") == F.col(f"{by}.src"), "left")
    taken = F.coalesce(F.col(f"{calc}.at") == F.col(f"{by}.extra"), F.lit(False))
    for cut in cuts:
        taken = taken | _in_cut(F.col(f"{calc}.size"), F.col(f"{calc}.bin"), F.col(f"{calc}.at"), f"{by}.{cut}")
    copies = (F.col(f"{by}.epochs") + taken.cast("int")).cast("int")
    return out.select(*rest, F.struct(F.col(f"{calc}.size").alias("size"), F.col(f"{by}.source_size").alias("source_size"), F.col(f"{by}.target").alias("target"), copies.alias("copies")).alias(into))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each document as many times as `take_counts` takes it, with the columns of docs."""
    name = free_name(docs, "mix")
    taken = take_counts(docs, into=name, **options).where(F.col(f"{name}.copies") > 0)
    return taken.withColumn(name, F.explode(F.array_repeat(F.lit(1), F.col(f"{name}.copies")))).drop(name)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for each document."""
    taken = take_counts(docs.select("doc_id", "text", "source"), into="mix", **options)
    return taken.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).cast("long").alias("taken"))


def mix_sql(seed: int = 29, share: float = 1.5, most: int = 2, pattern: tuple[int, ...] = PATTERN, rounds: int = 3) -> str:
    """The same rows, with one running sum per source and round."""
    steps = []
    for r in range(rounds):
        free = " AND ".join([f"size <= left{r}", *[f"NOT taken{x}" for x in range(r)]])
        before, own = (f"s{r - 1}", f"s{r}") if r else ("s", "s0")
        steps.append(f"""
a{r} AS (SELECT *, CASE WHEN {free} THEN sum(size) FILTER (WHERE {free}) OVER (PARTITION BY src ORDER BY key, id) END AS up{r} FROM {before}),
{own} AS (SELECT *, coalesce(up{r} <= left{r}, false) AS taken{r}, left{r} - coalesce(max(up{r}) FILTER (WHERE up{r} <= left{r}) OVER (PARTITION BY src), 0) AS left{r + 1} FROM a{r})""")
    weights = ", ".join(map(str, pattern))
    last = " OR ".join(f"taken{r}" for r in range(rounds))
    fits = f"NOT ({last}) AND size > 0 AND size < 2 * left{rounds}"
    return f"""
WITH d AS (SELECT doc_id, coalesce(doc_id, -1) AS id, coalesce(text, '') AS t, CASE WHEN source IS NULL THEN chr(1114111) ELSE '=' || source END AS src FROM documents),
k0 AS (SELECT doc_id, id, src, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size, length(t) AS nc, md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(t)) AS h FROM d),
k AS (SELECT doc_id, id, src, size, -ln((('0x' || substr(h, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / (0.25::DOUBLE + 0.75::DOUBLE * exp(-pow((nc / greatest(1, size) - 6) / 4, 2))) AS key FROM k0),
z AS (SELECT src, sum(size)::BIGINT AS source_size, ([{weights}])[(row_number() OVER (ORDER BY src) - 1) % {len(pattern)} + 1] AS w FROM k GROUP BY src),
y AS (SELECT *, {most} * source_size AS cap, {most} * source_size / w AS ratio FROM z),
x AS (SELECT *, ({share}::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER (ORDER BY ratio, src ROWS UNBOUNDED PRECEDING) - cap)) / sum(w) OVER (ORDER BY ratio, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM y),
v AS (SELECT src, source_size, CASE WHEN level >= ratio THEN cap::DOUBLE ELSE w * max(CASE WHEN level < ratio THEN level END) OVER () END AS target FROM x),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM v),
s AS (SELECT k.*, g.source_size, g.target, g.epochs, g.target - g.epochs * g.source_size AS left0 FROM k JOIN g USING (src)),{",".join(steps)}
SELECT doc_id, size, source_size, target, (size * (epochs + ({last} OR ({fits} AND rank() OVER (PARTITION BY src, {fits} ORDER BY size, key, id) = 1))::INT))::BIGINT AS taken FROM s{rounds - 1}"""
