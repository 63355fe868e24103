"""The opN queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from loomgrain.llm import bpe, line_dedup, near_dup, oracles, packing, quality, suffix_dedup, topk, toxicity, url_filter, warc
from loomgrain.session import Scratch, ship_package

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
URL_RULES = [
    url_filter.Rule("block", "com", "/en/"),
    url_filter.Rule("allow", "example.com", "/en/7"),
    url_filter.Rule("allow", "net", "/de/"),
    url_filter.Rule("block", "example.net", "/de/8"),
    url_filter.Rule("block", "org", "/es/"),
]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_read(spark, sf_dir, "documents"), counts=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge_quality(_read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model, carry=["doc_id"])
    return scored.select("doc_id", (toxicity.training_fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, VOCABULARY, bpe.build_lexicon(docs, VOCABULARY), digest=True)


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"), width=2, percent=80)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents"))
    left = F.coalesce("kept", F.lit("").cast("binary"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length(left)).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2(left, 256).alias("kept_sha256"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    path = scratch.path("archive")
    warc.write_archive(_read(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    records = warc.read_archive(spark, path, payload_of=("metadata",))
    notes = F.regexp_extract(F.decode("payload", "utf-8"), r"pageId: (-?\d+)", 1)
    records = records.withColumn("note", F.when(F.col("record_type") == "metadata", notes))
    kept = ["refers_to", "digest", "http_head", "payload_length", "payload_sha1", "note"]
    records = scratch.save(records.select("record_id", "record_type", "concurrent_to", *kept), "records")
    captures = warc.assemble(records)
    told = F.regexp_extract("http_head", r"(?i)content-length: (\d+)", 1).cast("long")
    first = F.col("record_type") == "response"
    rows = captures.select(
        "capture_id",
        F.try_element_at(F.col("metadata.note"), F.lit(1)).try_cast("long").alias("page_id"),
        F.when(first, F.col("payload_length")).otherwise(told).alias("payload_bytes"),
        F.when(first, F.col("payload_sha1")).otherwise(F.substring_index("digest", ":", -1)).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    target = rows.where("record_type = 'response'").select(
        F.col("capture_id").alias("refers_to"), F.col("page_id").alias("target_page")
    )
    told = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    # responses refer to nothing: only revisits take part in the join
    again = rows.where("record_type = 'revisit'").join(target, "refers_to", "left").select(*told, F.col("target_page").alias("refers_to"))
    return rows.where("record_type = 'response'").select(*told, F.lit(None).cast("long").alias("refers_to")).unionByName(again)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_read(spark, sf_dir, "documents"), VOCABULARY)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_quality": op2_quality,
        "op3_topk": op3_topk,
        "op4_toxicity": op4_toxicity,
        "op5_bpe": op5_bpe,
        "op6_near_dup": op6_near_dup,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_url_filter": op8_url_filter,
        "op9_warc": op9_warc,
        "op10_packing": op10_packing,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
