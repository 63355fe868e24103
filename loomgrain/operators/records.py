"""Chat records: first turns, exact dedup, seeded splits, resume joins and latest-wins views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.functions.text import keyed_order, strip

MESSAGES = "array<struct<role:string,content:string>>"


def first_turn(messages: Column, role: str) -> Column:
    """The unstripped content of the first message of a role that is not blank; null without one."""
    fits = F.filter(messages, lambda m: (m["role"] == role) & (strip(m["content"]) != ""))
    return F.get(fits, F.lit(0))["content"]


def chat_pairs(records: DataFrame, messages: str = "messages") -> DataFrame:
    """records with user and assistant, and malformed where either is missing."""
    out = records.withColumns({"user": first_turn(F.col(messages), "user"), "assistant": first_turn(F.col(messages), "assistant")})
    return out.withColumn("malformed", F.col("user").isNull() | F.col("assistant").isNull())


def first_of_equal(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the first by order (which must be total); others go.

    The smallest row of each key is a partial aggregate, so a key with very many rows is reduced before it is shuffled.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    whole = F.min(F.struct(*order, *rest)).alias("__r") if order else F.first(F.struct(*rest)).alias("__r")
    return rows.groupBy(*keys).agg(whole).select(*keys, "__r.*").select(*rows.columns)


def holdout(rows: DataFrame, fraction: float, seed: int, key: str) -> DataFrame:
    """rows with split: exactly ceil(n * fraction) are validation, by keyed order; none if there is but one row.

    The cut is found from the counts of the keyed order's leading hex digits, so that only the rows around it are ranked.
    """
    n = rows.count()
    want = 0
    if fraction > 0 and n > 1:
        want = min(n, -int(-(n * fraction) // 1))
    mark = rows.withColumn("__o", keyed_order(seed, F.col(key)))
    if want == 0:
        return mark.drop("__o").withColumn("split", F.lit("train"))
    digits = 4
    sizes = sorted(tuple(r) for r in mark.groupBy(F.substring("__o", 1, digits).alias("p")).count().collect())
    held, edge = 0, ""
    for edge, size in sizes:
        if held + size >= want:
            break
        held += size
    inside = mark.where(F.substring("__o", 1, digits) == edge).select("__o", F.col(key).alias("__k"))
    last = inside.orderBy("__o", "__k").limit(want - held).agg(F.max(F.struct("__o", "__k")).alias("m")).first().m
    cut = F.struct(F.lit(last["__o"]).alias("__o"), F.lit(last["__k"]).alias("__k"))
    below = F.struct("__o", F.col(key).alias("__k")) <= cut
    return mark.withColumn("split", F.when(below, "validation").otherwise("train")).drop("__o")


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a stage still has to do: wanted rows whose key is not done."""
    return wanted.join(done.select(key), key, "left_anti")


def with_default(left: DataFrame, right: DataFrame, key: str, column: str, default: object) -> DataFrame:
    """left with a column of right, or the default where right has no row."""
    return left.join(right.select(key, column), key, "left").withColumn(column, F.coalesce(column, F.lit(default)))


def limited_lookup(wanted: DataFrame, paths: DataFrame, key: str, limit: int | None) -> DataFrame:
    """The first wanted keys (limit counts before the lookup) with their path; keys without a path drop out."""
    first = wanted if limit is None else wanted.orderBy(key).limit(limit)
    return first.join(paths, key)


def latest(versions: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Of each key's rows the one of the highest version: the upsert view of an append-only table."""
    rest = [c for c in versions.columns if c not in keys and c != version]
    top = F.max_by(F.struct(version, *rest), version).alias("__r")
    return versions.groupBy(*keys).agg(top).select(*keys, "__r.*").select(*versions.columns)


def dense_positions(rows: DataFrame, order: list[str], name: str = "doc_pos") -> DataFrame:
    """rows with a dense position from 0 in the given order: ranges are sorted apart and shifted by what precedes them."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    ranged = ranged.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1)
    before = Window.partitionBy().orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    shift = sizes.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    return ranged.join(F.broadcast(shift), "__p").withColumn(name, F.col("__i") + F.col("__s")).drop("__p", "__i", "__s")
