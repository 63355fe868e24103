"""Token blocks and source mixing: packing into fixed lengths, interleaving, step budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.functions.text import uniform


def pack_blocks(tokens: DataFrame, length: int, batch: int = 1000, end_id: int | None = None) -> DataFrame:
    """(batch, block, input_ids, labels, attention_mask): the ids of each batch of documents, cut into blocks.

    tokens has doc_pos and input_ids. A running sum inside the batch gives every document its offset; it sends slices,
    not single ids, to its blocks; a batch's tail is dropped.
    """
    if length <= 0:
        raise ValueError("the block length must be positive")
    parts = fragments(tokens, length, batch, end_id)
    blocks = parts.groupBy("batch", "block").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    full = blocks.select("batch", "block", ids.alias("input_ids")).where(F.size("input_ids") == length)
    return full.select(
        "*", F.col("input_ids").alias("labels"), F.array_repeat(F.lit(1).cast("tinyint"), length).alias("attention_mask")
    )


def fragments(tokens: DataFrame, length: int, batch: int, end_id: int | None = None) -> DataFrame:
    """(batch, block, at, ids): each document's ids by the block they fall in; at is their place in the batch."""
    ids = F.col("input_ids") if end_id is None else F.concat("input_ids", F.array(F.lit(end_id)))
    base = tokens.select(F.floor(F.col("doc_pos") / batch).cast("long").alias("batch"), "doc_pos", ids.cast("array<int>").alias("ids"))
    base = base.where(F.size("ids") > 0)
    w = Window.partitionBy("batch").orderBy("doc_pos").rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumn("stop", F.sum(F.size("ids").cast("long")).over(w))
    base = base.withColumn("start", F.col("stop") - F.size("ids"))
    numbers = F.sequence(F.floor(F.col("start") / length), F.floor((F.col("stop") - 1) / length))
    cut = base.select("batch", "start", "stop", "ids", F.explode(numbers).alias("block"))
    lo = F.greatest(F.col("start"), F.col("block") * length)
    hi = F.least(F.col("stop"), (F.col("block") + 1) * length)
    piece = F.slice("ids", (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int"))
    return cut.select("batch", F.col("block").cast("long").alias("block"), lo.alias("at"), piece.alias("ids"))


def packing_loss(tokens: DataFrame, length: int, batch: int = 1000) -> DataFrame:
    """(batch, tokens, blocks, dropped) of each batch."""
    sums = tokens.groupBy(F.floor(F.col("doc_pos") / batch).cast("long").alias("batch")).agg(
        F.sum(F.size("input_ids").cast("long")).alias("tokens")
    )
    blocks = F.floor(F.col("tokens") / length).cast("long")
    return sums.select("batch", "tokens", blocks.alias("blocks"), (F.col("tokens") % length).alias("dropped"))


def interleave_schedule(first: int, second: int, fraction: float, seed: int, spark) -> DataFrame:
    """(step, source, idx): source 1 with the given chance, else 0; ends with the step that empties a source.

    The schedule is two narrow columns, one row a block; numbered by ranges so that no task counts all of it.
    """
    if fraction <= 0 or second == 0:
        return spark.range(first).select(F.col("id").alias("step"), F.lit(0).alias("source"), F.col("id").alias("idx"))
    span = 65_536
    steps = spark.range(first + second).select(F.col("id").alias("step"), F.floor(F.col("id") / span).alias("part"))
    drawn = steps.withColumn("source", F.when(uniform(seed, F.col("step")) < fraction, 1).otherwise(0))
    sums = drawn.groupBy("part").agg(F.sum("source").alias("ones"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "part", F.coalesce(F.sum("ones").over(before), F.lit(0)).alias("ones"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n")
    )
    inside = Window.partitionBy("part").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    counted = drawn.withColumn("here", F.sum("source").over(inside)).join(F.broadcast(sums), "part")
    ones = F.col("ones") + F.col("here")
    zeros = F.col("step") + 1 - ones
    known = counted.select("step", "source", ones.alias("ones"), zeros.alias("zeros"))
    end = known.where((F.col("ones") >= second) | (F.col("zeros") >= first)).agg(F.min("step").alias("end"))
    idx = F.when(F.col("source") == 1, F.col("ones")).otherwise(F.col("zeros")) - 1
    return known.crossJoin(F.broadcast(end)).where(F.col("step") <= F.col("end")).select("step", "source", idx.cast("long").alias("idx"))


def interleave(first: DataFrame, second: DataFrame, fraction: float, seed: int) -> DataFrame:
    """(step, source, pos, payload) in the schedule's order; both inputs have dense pos from 0 and payload."""
    schedule = interleave_schedule(first.count(), second.count(), fraction, seed, first.sparkSession)
    both = first.select(F.lit(0).alias("source"), F.col("pos").alias("idx"), "payload").unionByName(
        second.select(F.lit(1).alias("source"), F.col("pos").alias("idx"), "payload")
    )
    return schedule.join(both, ["source", "idx"]).select("step", "source", F.col("idx").alias("pos"), "payload")


def step_budget(blocks: int, batch: int, epochs: float, fraction: float, has_replay: bool = True, max_steps: int | None = None) -> int:
    """Optimiser steps for the wanted epochs of domain blocks when a share of the mix is replay."""
    if max_steps:
        return max_steps
    f = fraction if has_replay else 0.0
    once = -(-blocks // batch)
    exact = once * epochs / max(1e-9, 1 - f)
    return -int(-exact // 1)
