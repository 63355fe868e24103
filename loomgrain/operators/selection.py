"""Paper selection: best subtopics, strata, largest-remainder allocation, seeded samples, question types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.functions.text import keyed_order

# Question types in order of priority with the facets of which any one enables them.
TYPE_FACETS = {
    "artifact_diagnosis": "BC",
    "modality_selection": "AE",
    "result_interpretation": "EJ",
    "instrumentation": "C",
    "image_analysis": "D",
    "sample_prep": "B",
    "limitations": "J",
    "comparative_tradeoff": "A",
}
MAX_TYPES = 6
FLOOR = 10
#: Leading hex digits of the keyed order by which a stratum is counted before any of it is ranked.
_DIGITS = 4


def relevant_topics(topics: DataFrame, relevance: DataFrame, key: str = "pmcid") -> DataFrame:
    """Topic rows of relevant papers only, before anything is aggregated."""
    return topics.join(relevance.where("is_micro = 1").select(key), key, "left_semi")


def facet_profile(topics: DataFrame, tie: list[str], key: str = "pmcid") -> DataFrame:
    """key, a, e (best subtopics of facets A and E), facets (sorted letters): one aggregate over one scan.

    Null, negative and NaN probabilities never win; ties go to the largest ``tie`` columns.
    """
    rank = F.struct("prob", *tie)

    def best(facet: str) -> Column:
        ok = (F.col("facet") == facet) & (F.col("prob") >= 0) & ~F.isnan("prob")
        return F.max_by("subtopic", F.when(ok, rank))

    letters = F.array_join(F.array_sort(F.collect_set("facet")), "")
    return topics.groupBy(key).agg(best("A").alias("a"), best("E").alias("e"), letters.alias("facets"))


def stratum(c: Column) -> Column:
    """A stratum label: null and empty are none."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("none"))


def count_strata(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("size"))


def allocate(strata: DataFrame, n: int, by: list[str], floor: int = FLOOR) -> DataFrame:
    """strata with ``alloc``: everyone's floor first, the rest in proportion to room by largest remainder.

    Whole-number arithmetic throughout; equal remainders go by the stratum's labels. If the floors alone reach
    the target they stand, so the sum may exceed it. The table has one row a stratum, which is why its windows are global.
    """
    everything = Window.partitionBy()
    size = F.col("size").cast("long")
    s = strata.withColumn("__floor", F.least(size, F.lit(floor).cast("long")))
    s = s.withColumn("__room", size - F.col("__floor"))
    s = s.withColumn("__rest", F.least(F.lit(n).cast("long"), F.sum(size).over(everything)) - F.sum("__floor").over(everything))
    s = s.withColumn("__rooms", F.sum("__room").over(everything))
    open_ = (F.col("__rest") > 0) & (F.col("__rooms") > 0)
    s = s.withColumn("__base", F.when(open_, F.expr("(__rest * __room) div __rooms")).otherwise(F.lit(0).cast("long")))
    s = s.withColumn("__frac", F.when(open_, F.expr("(__rest * __room) % __rooms")).otherwise(F.lit(0).cast("long")))
    s = s.withColumn("__left", F.when(open_, F.col("__rest") - F.sum("__base").over(everything)).otherwise(F.lit(0).cast("long")))
    order = Window.partitionBy().orderBy(F.desc("__frac"), *by)
    extra = F.when(F.row_number().over(order) <= F.col("__left"), 1).otherwise(0)
    s = s.withColumn("alloc", (F.col("__floor") + F.col("__base") + extra).cast("long"))
    return s.select(*strata.columns, "alloc")


def stratified_sample(rows: DataFrame, allocation: DataFrame, by: list[str], key: str, seed: int) -> DataFrame:
    """Exactly ``alloc`` rows of each stratum (all, if it has fewer), the same for a seed whatever the partitioning.

    A stratum's cut is found from the counts of the keyed order's leading hex digits, so that only rows with the digits
    of the cut are ranked, however large the stratum is.
    """
    mark = rows.join(allocation.where("alloc > 0").select(*by, "alloc"), by).withColumn("__o", keyed_order(seed, F.col(key)))
    mark = mark.withColumn("__p", F.substring("__o", 1, _DIGITS))
    before = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = mark.groupBy(*by, "__p", "alloc").agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    cut = sizes.where((F.col("__before") < F.col("alloc")) & (F.col("alloc") <= F.col("__before") + F.col("__n")))
    cut = cut.select(*by, F.col("__p").alias("__cut"), (F.col("alloc") - F.col("__before")).alias("__take"))
    known = mark.join(cut, by, "left")
    sure = known.where(F.col("__cut").isNull() | (F.col("__p") < F.col("__cut")))
    w = Window.partitionBy(*by, "__p").orderBy("__o", key)
    ranked = known.where(F.col("__p") == F.col("__cut")).withColumn("__k", F.row_number().over(w))
    edge = ranked.where(F.col("__k") <= F.col("__take")).drop("__k")
    return sure.unionByName(edge).drop("alloc", "__o", "__p", "__cut", "__take")


def question_types(facets: Column, cap: int = MAX_TYPES) -> Column:
    """The enabled question types of a string of facet letters, by priority, at most cap."""
    enabled = [F.when(F.coalesce(facets, F.lit("")).rlike(f"[{letters}]"), F.lit(t)) for t, letters in TYPE_FACETS.items()]
    return F.slice(F.array_compact(F.array(*enabled)), 1, cap)


def select_papers(topics: DataFrame, relevance: DataFrame, n: int, seed: int, tie: list[str], key: str = "pmcid") -> DataFrame:
    """key, a, e, facets of the selected papers; papers without topic rows drop out."""
    profile = facet_profile(relevant_topics(topics, relevance, key), tie, key)
    profile = profile.withColumns({"a": stratum(F.col("a")), "e": stratum(F.col("e"))})
    return stratified_sample(profile, allocate(count_strata(profile, ["a", "e"]), n, ["a", "e"]), ["a", "e"], key, seed)
