"""The pair guard over tables: sources are normalised once for each paper, not once for each pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.functions import grounding as g
from loomgrain.functions.text import normalise, strip


def prepare_sources(contexts: DataFrame, key: str = "pmcid", text: str = "context", compose: bool = True) -> DataFrame:
    """key, source (normalised) and values (its numbers)."""
    return contexts.select(key, normalise(F.col(text), compose).alias("source")).withColumn("values", g.number_values(F.col("source")))


def check_pairs(pairs: DataFrame, contexts: DataFrame, key: str = "pmcid", compose: bool = True) -> DataFrame:
    """pairs with stripped question, answer and span, and kept (1 or 0) and reason.

    Fields that the pair does not have are empty. A pair without a context is checked against an empty one.
    """
    have = set(pairs.columns)
    text = {c: strip(F.coalesce(F.col(c), F.lit(""))) if c in have else F.lit("") for c in ("question", "answer")}
    first = F.col("span") if "span" in have else F.lit(None).cast("string")
    other = F.col("supporting_span") if "supporting_span" in have else F.lit(None).cast("string")
    ready = pairs.withColumns({**text, "span": g.span_of(first, other)})
    ready = ready.withColumn("__fragments", g.span_fragments(F.col("span"), compose))
    ready = ready.withColumn("__answer", normalise(F.col("answer"), compose))
    joined = ready.join(prepare_sources(contexts, key, compose=compose), key, "left")
    source = F.coalesce("source", F.lit(""))
    values = F.coalesce("values", F.array().cast("array<double>"))
    reason = g.pair_reason(
        F.col("question"), F.col("answer"), F.col("span"),
        g.fragments_grounded(F.col("__fragments"), source), g.first_ungrounded(F.col("__answer"), source, values),
    )
    out = joined.withColumn("reason", reason).withColumn("kept", F.when(F.col("reason") == "", 1).otherwise(0))
    return out.drop("__fragments", "__answer", "source", "values")


def reason_counts(checked: DataFrame) -> DataFrame:
    """(kind, n): kept pairs and dropped pairs by what stands before the colon of their reason."""
    kind = F.when(F.col("kept") == 1, "kept").otherwise(F.split("reason", ":")[0])
    return checked.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def drop_reasons(checked: DataFrame, top: int = 8) -> DataFrame:
    """The most frequent full reasons of dropped pairs; ties go by reason."""
    dropped = checked.where("kept = 0").groupBy(F.coalesce("reason", F.lit("")).alias("reason"))
    return dropped.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(top)


def kept_by_type(checked: DataFrame) -> DataFrame:
    return checked.where("kept = 1").groupBy("type").agg(F.count(F.lit(1)).alias("n"))
