"""Streaming variants: files that arrive become contexts, generated pairs are guarded as they are committed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomgrain.functions.text import build_context, usable_context
from loomgrain.operators.grounding import check_pairs
from loomgrain.sources.state import StateStore


def context_stream(pages: DataFrame, key: str, markup: str) -> DataFrame:
    """(key, context) of a stream of marked-up documents, usable ones only; stateless, so it needs no watermark."""
    rows = pages.select(key, build_context(F.col(markup)).alias("context"))
    return rows.where(usable_context(F.col("context")))


def first_seen(rows: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Rows whose key was not seen before, remembering keys for as long as rows may be late."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, time: str, kind: str, window: str, delay: str) -> DataFrame:
    """(start, kind, n) of tumbling event-time windows; late rows count until the watermark passes."""
    counts = events.withWatermark(time, delay).groupBy(F.window(time, window), kind).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("start"), kind, "n")


def replace_table(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the whole result anew with every micro-batch; a batch that is run again writes the same."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    out = rows.writeStream.outputMode("complete").foreachBatch(write)
    return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def guard_stream(spark: SparkSession, pairs: DataFrame, contexts: DataFrame, state: StateStore, checkpoint: str) -> StreamingQuery:
    """Guard every micro-batch of pairs against the contexts and commit it to the state table of pairs.

    A batch that is run again after a failure commits the same ids once more, of which the latest count.
    """

    def commit(batch: DataFrame, _: int) -> None:
        checked = check_pairs(batch, contexts)
        state.append("pair", checked.select("id", "pmcid", "type", "question", "answer", "span", "kept", "reason"))

    return pairs.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
