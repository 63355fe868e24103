"""Sinks: chat export, split files, packed cache with a fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def export_rows(pairs: DataFrame, require_judge: bool = True) -> DataFrame:
    """(question, answer) of kept pairs; with require_judge only those the judge supported."""
    kept = (F.col("kept") == 1) & (F.col("judged") == 1) if require_judge else F.col("kept") == 1
    return pairs.where(kept).select("question", "answer")


def chat_json(question: Column, answer: Column) -> Column:
    """A chat record of one user and one assistant message as JSON; letters beyond ASCII stay as they are."""
    turn = [F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in (("user", question), ("assistant", answer))]
    return F.to_json(F.struct(F.array(*turn).alias("messages")))


def write_chat(pairs: DataFrame, path: str, require_judge: bool = True) -> None:
    rows = export_rows(pairs, require_judge)
    rows.select(chat_json(F.col("question"), F.col("answer")).alias("value")).write.mode("overwrite").text(path)


def write_splits(rows: DataFrame, folder: str) -> None:
    """train and validation as JSON lines, each in its own folder."""
    for split in ("train", "validation"):
        part = rows.where(F.col("split") == split)
        part.select(chat_json(F.col("user"), F.col("assistant")).alias("value")).write.mode("overwrite").text(f"{folder}/{split}.jsonl")


def cached_blocks(spark: SparkSession, folder: str, key: str) -> tuple[DataFrame, DataFrame] | None:
    """The packed train and held-out blocks if they were written under the same fingerprint."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/meta/_SUCCESS")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    meta = spark.read.json(f"{folder}/meta").first()
    if meta is None or meta["fingerprint"] != key:
        return None
    return spark.read.parquet(f"{folder}/packed_train"), spark.read.parquet(f"{folder}/packed_heldout")


def write_blocks(blocks: DataFrame, folder: str, key: str) -> None:
    """Blocks by their split, and then the fingerprint that makes them valid."""
    for split, name in (("train", "packed_train"), ("validation", "packed_heldout")):
        blocks.where(F.col("split") == split).drop("split").write.mode("overwrite").parquet(f"{folder}/{name}")
    n = blocks.count()
    blocks.sparkSession.createDataFrame([(key, n)], "fingerprint string, blocks long").write.mode("overwrite").json(f"{folder}/meta")
