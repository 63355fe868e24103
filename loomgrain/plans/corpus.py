"""Corpus preparation: packed blocks for pretraining, deduplicated and split chat pairs for fine-tuning."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.functions.text import fingerprint, word_ids
from loomgrain.operators import blocks, records
from loomgrain.plans.config import infer_stage
from loomgrain.sources import readers, sinks

SCHEMA_VERSION = 1


def cache_key(spark: SparkSession, config: dict, files: list[tuple[str, int, int]]) -> str:
    """What the packed blocks depend on: settings and each file's name, size and time of change, as its store gives them."""
    data = config["data"]
    parts = [SCHEMA_VERSION, config["model"]["name"], data.get("text_field", "text"), data["sequence_length"]]
    parts += [data.get("heldout_fraction", 0.0), config["train"].get("seed", 0), data.get("max_docs")]
    parts += [f"{path.rsplit('/', 1)[-1]}:{size}:{changed}" for path, size, changed in files]
    return spark.range(1).select(fingerprint(*[F.lit(str(x)) for x in parts]).alias("k")).first().k


def prepare_blocks(
    spark: SparkSession, config: dict, tokenise: Callable[[Column], Column] = word_ids, end_id: int = 0, batch: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """Packed train and held-out blocks of a shard folder, from the cache if its key still fits."""
    data = config["data"]
    key = cache_key(spark, config, readers.shard_states(spark, data["corpus_dir"]))
    cached = sinks.cached_blocks(spark, data["processed_dir"], key)
    if cached:
        return cached
    docs = readers.read_shards(spark, data["corpus_dir"], data.get("text_field", "text"), data.get("max_docs"))
    docs = records.dense_positions(docs, ["file_rank", "line_id"])
    tokens = docs.select("doc_pos", tokenise(F.col("text")).alias("input_ids"))
    packed = blocks.pack_blocks(tokens, data["sequence_length"], batch, end_id)
    packed = packed.withColumn("key", F.concat_ws(":", "batch", "block"))
    split = records.holdout(packed, data.get("heldout_fraction", 0.0), config["train"].get("seed", 0), "key").drop("key")
    sinks.write_blocks(split, data["processed_dir"], key)
    return sinks.cached_blocks(spark, data["processed_dir"], key)


def prepare_chat(spark: SparkSession, config: dict) -> tuple[DataFrame, dict[str, int]]:
    """(user, assistant, split) of the distinct valid records of a chat file, and how many were kept, malformed, duplicate."""
    lines = records.chat_pairs(readers.read_chat_lines(spark, config["data"]["train_file"]))
    valid = lines.where(~F.col("malformed")).select("line_id", "user", "assistant")
    first = records.first_of_equal(valid, ["user", "assistant"], ["line_id"])
    counts = lines.agg(F.count_if("malformed").alias("malformed"), F.count_if(~F.col("malformed")).alias("valid")).first()
    kept = first.count()
    if not kept:
        raise ValueError("no valid chat records")
    rows = records.holdout(first, config["data"].get("val_fraction", 0.0), config["train"].get("seed", 0), "line_id")
    if config["data"].get("processed_dir"):
        sinks.write_splits(rows, config["data"]["processed_dir"])
    return rows, {"kept": kept, "malformed": counts.malformed, "duplicate": counts.valid - kept}


def mix_replay(train: DataFrame, replay: DataFrame | None, fraction: float, seed: int) -> DataFrame:
    """(step, source, pos, payload) of train rows with a share of replay; train alone without a source."""
    if replay is None or fraction <= 0:
        return train.select(F.col("pos").alias("step"), F.lit(0).alias("source"), "pos", "payload")
    return blocks.interleave(train, replay, fraction, seed)


def prepare(spark: SparkSession, config: dict, stage: str | None = None):
    stage = stage or infer_stage(config)
    if stage == "dapt":
        return prepare_blocks(spark, config)
    if stage == "sft":
        return prepare_chat(spark, config)
    raise ValueError(f"unknown stage {stage}")


def main(argv: list[str] | None = None) -> None:
    from loomgrain.plans.config import load_stage_config
    from loomgrain.session import build_session

    p = argparse.ArgumentParser(description="Prepare the data of a training stage.")
    p.add_argument("--config", required=True)
    p.add_argument("--stage", choices=["dapt", "sft"])
    a = p.parse_args(argv)
    config = load_stage_config(a.config)
    first, second = prepare(build_session("prepare"), config, a.stage)
    if isinstance(second, dict):
        print(" ".join(f"{k}={v}" for k, v in second.items()))
    else:
        print(f"train={first.count()} heldout={second.count()}")


if __name__ == "__main__":
    main()
