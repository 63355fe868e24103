"""Answer and loss metrics over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrain.functions.text import answer_tokens


def token_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two token arrays: one walk over both in order.

    A token's places in the first array come before those in the second, each of which uses up one of the former.
    """

    def marked(tokens: Column, k: int) -> Column:
        return F.transform(tokens, lambda t: F.struct(t.alias("t"), F.lit(k).alias("k")))

    def state(token: Column, unused: Column, shared: Column) -> Column:
        return F.struct(token.alias("t"), unused.alias("unused"), shared.alias("shared"))

    def step(acc: Column, x: Column) -> Column:
        unused = F.when(acc["t"].eqNullSafe(x["t"]), acc["unused"]).otherwise(0)
        hit = (x["k"] == 1) & (unused > 0)
        change = F.when(x["k"] == 0, 1).when(hit, -1).otherwise(0)
        return state(x["t"], unused + change, acc["shared"] + F.when(hit, 1).otherwise(0))

    start = state(F.lit(None).cast("string"), F.lit(0), F.lit(0))
    return F.aggregate(F.sort_array(F.concat(marked(a, 0), marked(b, 1))), start, step, lambda acc: acc["shared"])


def token_f1(a: Column, b: Column) -> Column:
    """Harmonic mean of token precision and recall; two empty arrays agree, one empty does not."""
    common = token_overlap(a, b)
    p, r = common / F.size(a), common / F.size(b)
    empty = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(empty, F.when(a == b, 1.0).otherwise(0.0)).when(common == 0, 0.0).otherwise(2 * p * r / (p + r))


def score_answers(rows: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """rows with exact (0 or 1) and f1 of normalised tokens."""
    t = rows.withColumns({"__a": answer_tokens(F.col(prediction)), "__b": answer_tokens(F.col(reference))})
    exact = F.when(F.col("__a") == F.col("__b"), 1).otherwise(0)
    return t.withColumns({"exact": exact, "f1": token_f1(F.col("__a"), F.col("__b"))}).drop("__a", "__b")


def weighted_perplexity(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """loss (weighted by n_tokens) and perplexity; rows without tokens weigh nothing."""
    used = rows.where("n_tokens > 0")
    loss = F.sum(F.col("loss") * F.col("n_tokens")) / F.greatest(F.lit(1), F.sum("n_tokens"))
    out = used.groupBy(*(by or [])).agg(F.coalesce(loss, F.lit(0.0)).alias("loss"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))
    return out.withColumn("perplexity", F.exp("loss"))


def answer_metrics(rows: DataFrame) -> DataFrame:
    """One row: n, exact_match, f1 and the weighted loss and perplexity of all rows."""
    scored = score_answers(rows)
    n = F.greatest(F.lit(1), F.count(F.lit(1)))
    tokens = F.sum(F.when(F.col("n_tokens") > 0, F.col("n_tokens")))
    loss = F.coalesce(F.sum(F.when(F.col("n_tokens") > 0, F.col("loss") * F.col("n_tokens"))) / F.greatest(F.lit(1), tokens), F.lit(0.0))
    out = scored.agg(
        F.count(F.lit(1)).alias("n"), (F.sum("exact") / n).alias("exact_match"), (F.sum("f1") / n).alias("f1"), loss.alias("loss")
    )
    return out.withColumn("perplexity", F.exp("loss"))
