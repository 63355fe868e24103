"""Line deduplication by overlapping windows of consecutive lines.

A document's lines are its text split at ``\\n``. Every run of ``width`` consecutive lines is a window,
known by a 128-bit hash. Of the windows that are equal anywhere in the corpus, the one with the
smallest (doc_id, line number) is the first; all others are later occurrences, and every line that a later
occurrence covers is removed. All of it is DataFrame code: windows are hashed and numbered map-side, equal
windows meet through a partial aggregate (one row per task and window however frequent it is), and the
way back is an equi-join that adaptive execution may split when a window is hot.

Defined results: null text stays null and has no lines; texts with fewer lines than a window stay as they
are; windows that overlap inside one document count as occurrences; rows that share both doc_id and text are one
document stored twice (they do not make each other repeats), rows that share a doc_id only are documents of their own, in
order of their texts' hashes; a null doc_id counts as one id and comes first; an empty table gives an empty table; columns other than ``doc_id`` and ``text`` pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrain.session import Scratch


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n")


def line_windows(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, th, line, h1, h2): one row per window; th tells texts of one doc_id apart, h1 and h2 together are the window's hash."""
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), _lines().alias("__l")).where(F.size("__l") >= width)
    starts = F.sequence(F.lit(1), F.size("__l") - F.lit(width - 1))
    hashed = F.transform(
        starts,
        lambda i: F.struct(
            F.xxhash64(F.slice("__l", i, width)).alias("h1"), F.xxhash64(F.lit(width), F.slice("__l", i, width)).alias("h2")
        ),
    )
    return base.select("doc_id", "th", F.posexplode(hashed).alias("line", "__h")).select("doc_id", "th", "line", "__h.h1", "__h.h2")


def later_lines(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, th, lines): the sorted numbers (from 0) of the lines that later occurrences cover; only documents with any."""
    windows = line_windows(docs, width)
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "th", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # written, so that the join deals both sides out and adaptive execution can split a window that is everywhere
    first = Scratch(docs.sparkSession, "lines").save(first, "first")
    later = windows.join(first, ["h1", "h2"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")) & (F.col("line") == F.col("first.line")))
    )
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.lit(width - 1)))))
    return (
        later.groupBy("doc_id", "th")
        .agg(F.collect_set("line").alias("starts"))
        .select("doc_id", "th", F.sort_array(covered).alias("lines"))
    )


def dedup_lines(docs: DataFrame, width: int = 3, counts: bool = False) -> DataFrame:
    """docs with ``text`` less the lines covered by later occurrences; with counts also n_lines and n_removed."""
    columns = [c for c in docs.columns if not (counts and c in ("n_lines", "n_removed"))]
    gone = later_lines(docs, width).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("lines").alias("__gone"))
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__th"])
    joined = docs.join(gone, same, "left").withColumn("__l", _lines())
    size = F.size("__l")
    stay = F.array_except(F.sequence(F.lit(0), size - 1), F.col("__gone"))
    cut = F.array_join(F.transform(stay, lambda i: F.col("__l")[i]), "\n")
    text = F.when(F.col("__gone").isNull() | F.col("text").isNull(), F.col("text")).otherwise(cut)
    out = [text.alias("text") if c == "text" else F.col(c) for c in columns]
    if counts:
        n_gone = F.size(F.filter("__gone", lambda i: i < F.size("__l")))
        out += [
            F.when(F.col("text").isNull(), 0).otherwise(size).cast("long").alias("n_lines"),
            F.when(F.col("__gone").isNull() | F.col("text").isNull(), 0).otherwise(n_gone).cast("long").alias("n_removed"),
        ]
    return joined.select(*out)
