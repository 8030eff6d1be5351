"""Incremental matching: a stream of anchors against static postings, and counts of requests in sliding windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocking, evaluate, pairs
from ..operators.normalise import normalise


def match_batch(anchors: DataFrame, target_keys: DataFrame, target_norm: DataFrame, tau: float = pairs.TAU, fuzzy: bool = True) -> DataFrame:
    """Matches of a micro-batch of anchor rows (entity_id, src, num, business_name, business_address, country) against targets that are there
    already: the same operators as in batch, so the caps and ranks that need all candidates of an anchor are per batch."""
    norm = normalise(anchors)
    posts = blocking.postings(target_keys, blocking.RULE_POSTINGS)
    cands = blocking.probe_rules(blocking.rule_keys(norm), posts)
    both = norm.unionByName(target_norm.select(*norm.columns), allowMissingColumns=True)
    return evaluate.top_matches(pairs.rule_score(cands, both, fuzzy=fuzzy, tau=tau), tau)


def stream_matches(stream: DataFrame, target_norm: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Start a query that appends the matches of each micro-batch of anchors to path as Parquet; target_norm is read for each batch. An anchor
    arrives whole in one batch, so its result never changes later. The batch's id names its folder: a batch that is replayed after a failure
    overwrites its own output."""
    keys = blocking.rule_keys(target_norm)

    def write(batch: DataFrame, batch_id: int) -> None:
        match_batch(batch, keys, target_norm).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (q.trigger(availableNow=True) if once else q).start()


def request_counts(events: DataFrame, limit: int = 240, length: str = "60 seconds", slide: str = "10 seconds", late: str = "5 minutes") -> DataFrame:
    """user_id, start, n, limited: requests of each user in sliding windows, batch or stream; late rows are dropped after the watermark."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    n = events.groupBy("user_id", F.window("ts", length, slide)).agg(F.count("*").alias("n"))
    return n.select("user_id", F.col("window.start").alias("start"), "n", (F.col("n") > limit).alias("limited"))
