"""The corpus pipeline: toxicity, line dedup, near-duplicates, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``; n_chars follows the text where a stage changes it.

Defined results of all stages: extra columns are left out; an empty table gives an empty table; a null or empty text is
neither toxic nor a duplicate and stays, as it was, to be packed as the end id alone; rows are judged by their text, so that
repeated rows of one doc_id stay or go together; rows with a null doc_id stay unless they are toxic, and lose only repeated windows of lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.llm import line_dedup, near_dup, packing, suffix_dedup, toxicity
from loomgrain.llm.registry import VOCABULARY
from loomgrain.session import Scratch, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    Only 128-bit hashes of (doc_id, text) go through the scoring; rows with a rejected one's hashes are left out.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    seeds = {f"__h{k}": F.xxhash64(F.lit(k), F.col("doc_id"), F.col("text")) for k in (1, 2)}
    keyed = docs.select(*COLUMNS).withColumns(seeds)
    scored = toxicity.score_documents(keyed.select(*seeds, "text"), model, carry=list(seeds))
    gone = scored.where("predicted = 1").select(*seeds).distinct()
    return keyed.join(gone, list(seeds), "left_anti").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines of repeated three-line windows; those of which no word is left go."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS), counts=True)
    return _resized(out, F.col("n_removed") > 0, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words a shingle, similarity 0.8): the one of smallest doc_id.

    All rows of a doc_id that is not its group's smallest go; rows without a doc_id stay.
    """
    judged = near_dup.near_duplicates(docs, width=5, percent=80)
    gone = judged.where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less repeated 50-byte strings, by whole characters; those of which no word is left go."""
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), carry=["lang", "source"], whole_characters=True)
    return _resized(cut.withColumn("text", F.decode("kept", "utf-8")), F.size("spans") > 0, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document's ids; repeated rows give pieces of their own."""
    return packing.pack_documents(docs, VOCABULARY)


def _resized(out: DataFrame, cut: Column, docs: DataFrame) -> DataFrame:
    """The columns of docs, n_chars as long as the text; rows that were cut and have no word left are left out."""
    word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.where(word | ~cut).withColumn("n_chars", size).select(*COLUMNS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dup", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]

#: Toxicity and packing cannot be said in SQL; tests/llm compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and read again."""
    ship_package(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.keep_only(docs)
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's pieces with a checksum in place of their ids."""
    out = run(spark, sf_dir)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
