"""URL filtering: host and path rules first, then a ratio of character language models.

A rule names a host and a path; it fits a URL on that host or a subdomain of it whose path starts with the
rule's, and the longest fitting rule decides. URLs that a rule decides are the training data of two smoothed
variable-order Markov models over the characters of host and path, one of accepted and one of rejected URLs
(orders 0 to ``order``, each mixed with the next shorter context by Witten-Bell weights). The host and path that the rule
itself names are masked: the models read only what stands before and after them, so they learn the pages, not
the rules. Host and path are read apart, each from its first character.

The score of any other URL is its log-likelihood under the rejected model less that under the accepted one, divided by its
length; it is blocked above a cut calibrated on a held-out fifth of the decided URLs: the lowest score that at most
``max_false_block`` of the accepted ones among them exceed. So where masked URLs say nothing about the verdict, few are blocked.

All n-grams stay a table, and tables that grow with the corpus are joined by shuffle (their files pack so well that their size
would mislead the planner into a broadcast). Each distinct n-gram that a text asks for meets the table's rows for its own endings and their
contexts by two equi-joins; only order 0's totals and a histogram of held-out scores reach the driver.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule with a host, scores
0 and is allowed; so is any text without characters. With no decided URL of one class every undecided URL is allowed with
score 0; without a held-out accepted URL the cut is 0; repeated rows repeat; other columns pass.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrain.session import Scratch


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    lower = F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def matched_rule(host: Column, path: Column, rules: list[Rule], part: str) -> Column:
    """The longest fitting rule's text or verdict; null if none fits."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.host + r.path if part == "rule" else r.verdict)).otherwise(out)
    return out


#: Scores are added as whole numbers of this fraction, so that sums do not depend on their order.
_UNIT = 1 << 40
_BINS = 4096
#: Stands between host and path in a text, which neither can contain; n-grams do not cross it.
_APART = "\n"
_CLASSES = ("accepted", "rejected")


def text_of(host: Column, path: Column) -> Column:
    """One text of host and path; empty if both are."""
    clean = [F.regexp_replace(x, _APART, " ") for x in (host, path)]
    return F.when((host == "") & (path == ""), "").otherwise(F.concat(clean[0], F.lit(_APART), clean[1]))


def masked(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The text of a decided URL without what its rule names."""
    out = F.lit("")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        left = F.substr(host, F.lit(1), F.length(host) - len(r.host))
        out = F.when(fits, text_of(left, F.substr(path, F.lit(len(r.path) + 1)))).otherwise(out)
    return out


def _cut(text: Column, order: int, every: bool) -> Column:
    """For each character the longest n-gram that ends with it, or all of them; none crosses host and path."""

    def ends(part: Column) -> Column:
        places = F.when(F.length(part) > 0, F.sequence(F.lit(1), F.length(part))).otherwise(F.array().cast("array<int>"))
        longest = F.transform(places, lambda i: F.substring(part, F.greatest(F.lit(1), i - order), F.least(i, F.lit(order + 1))))
        return F.flatten(F.transform(longest, _endings)) if every else longest

    return F.flatten(F.transform(F.split(text, _APART), ends))


def _endings(gram: Column) -> Column:
    """All endings of an n-gram, the shortest first."""
    n = F.length(gram)
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.substring(gram, n - k + 1, n))


def gram_counts(decided: DataFrame, order: int) -> DataFrame:
    """(gram, accepted, rejected): how often each n-gram up to order + 1 characters is in (text, verdict, n) rows, n times each."""
    bad = F.col("verdict") == "block"
    weights = [F.when(t, F.col("n")).otherwise(0).alias(c) for t, c in zip((~bad, bad), _CLASSES, strict=True)]
    grams = decided.select("text", *weights).select(F.explode(_cut(F.col("text"), order, True)).alias("gram"), *_CLASSES)
    return grams.groupBy("gram").agg(*[F.sum(c).alias(c) for c in _CLASSES])


def gram_ratios(asked: DataFrame, counts: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, part): log chance under the rejected model less that under the accepted one of each asked n-gram's last character.

    A context that a class has not seen leaves the shorter one's chance; below order 0 all known characters and one unknown are alike.
    """
    sums = [F.sum(c).alias(f"total_{c}") for c in _CLASSES] + [F.sum((F.col(c) > 0).cast("long")).alias(f"types_{c}") for c in _CLASSES]
    letters = counts.where(F.length("gram") == 1).agg(F.count(F.lit(1)).alias("n"), *sums).first()
    longer = counts.where(F.length("gram") > 1)
    contexts = longer.groupBy(F.expr("left(gram, length(gram) - 1)").alias("context")).agg(*sums)
    ends = asked.select("gram", F.explode(_endings(F.col("gram"))).alias("end"))
    # each ending meets its context once, so that a context is asked for no more often than it has next characters
    known = ends.select("end").distinct().withColumn("context", F.expr("left(end, length(end) - 1)"))
    facts = [*_CLASSES, *contexts.columns[1:]]
    known = known.join(counts.withColumnRenamed("gram", "end").hint("merge"), "end", "left")
    first = known.where("context = ''").withColumns({n: F.lit(letters[n] or 0) for n in contexts.columns[1:]})
    rest = known.where("context <> ''").join(contexts.hint("merge"), "context", "left")
    told = scratch.save(first.select("end", *facts).unionByName(rest.select("end", *facts)), "facts")
    levels = ends.join(told.hint("merge"), "end").groupBy("gram").agg(F.sort_array(F.collect_list(F.struct(F.length("end").alias("n"), *facts))).alias("levels"))

    def chance(c: str) -> Column:
        def step(q: Column, x: Column) -> Column:
            total, types = x[f"total_{c}"], x[f"types_{c}"]
            return F.when(total > 0, (F.coalesce(x[c], F.lit(0)) + types * q) / (total + types)).otherwise(q)

        return F.aggregate("levels", F.lit(1.0 / (letters["n"] + 1)), step)

    return levels.select("gram", F.round((F.log(chance("rejected")) - F.log(chance("accepted"))) * _UNIT).cast("long").alias("part"))


def score_texts(texts: DataFrame, counts: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """(text, score) of distinct texts with characters: length-normalised log-likelihood of rejected less accepted."""
    grams = texts.select("text", F.explode(_cut(F.col("text"), order, False)).alias("gram"))
    ratios = scratch.save(gram_ratios(grams.select("gram").distinct(), counts, scratch), "ratios")
    scored = grams.join(ratios.hint("merge"), "gram").groupBy("text").agg(F.sum("part").alias("part"), F.count(F.lit(1)).alias("n"))
    return scored.select("text", (F.col("part") / _UNIT / F.col("n")).alias("score"))


def calibrated_cut(good: DataFrame, most: float) -> float:
    """The lowest edge, by bins of equal width, that at most a share ``most`` of (score, n) rows lies above; 0 without rows."""
    ends = good.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    if ends.low is None:
        return 0.0
    width = (ends.high - ends.low) / _BINS or 1.0
    step = F.least(F.floor((F.col("score") - ends.low) / width), F.lit(_BINS - 1))
    bins = good.groupBy(step.alias("bin")).agg(F.sum("n").alias("n"), F.max("score").alias("high")).orderBy("bin").collect()
    total, above, cut = sum(r.n for r in bins), 0, bins[-1].high
    for low, high in zip(reversed(bins[:-1]), reversed(bins[1:]), strict=True):
        above += high.n
        if above > most * total:
            break
        cut = low.high
    return cut


def filter_urls(pages: DataFrame, rules: list[Rule], order: int = 5, max_false_block: float = 0.05) -> DataFrame:
    """pages with host, path, rule, verdict and score (null where a rule decides)."""
    spark = pages.sparkSession
    own = ["host", "path", "rule", "verdict", "score"]
    known = pages.drop(*own).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    known = known.withColumns({p: matched_rule(F.col("host"), F.col("path"), rules, p) for p in ("rule", "verdict")})
    host, path, open_ = F.col("host"), F.col("path"), F.col("verdict").isNull()
    text = F.when(open_, text_of(host, path)).otherwise(masked(host, path, rules))
    scratch = Scratch(spark, "urls")
    texts = known.groupBy(text.alias("text"), "verdict").agg(F.count(F.lit(1)).alias("n"))
    texts = scratch.save(texts.withColumn("held", F.pmod(F.crc32("text"), F.lit(5)) == 0), "texts")
    counts = scratch.save(gram_counts(texts.where("verdict is not null and not held"), order), "grams")
    classes = counts.agg(*[F.sum(c).alias(c) for c in _CLASSES]).first()
    if not classes.accepted or not classes.rejected:
        return known.withColumns({"score": F.when(open_, 0.0), "verdict": F.coalesce("verdict", F.lit("allow"))})
    asked = texts.where("verdict is null or (held and verdict = 'allow')").select("text").distinct()
    scores = scratch.save(score_texts(asked, counts, order, scratch), "scores")
    good = texts.where("held and verdict = 'allow'").join(scores, "text")
    cut = calibrated_cut(good, max_false_block)
    scratch.keep_only(scores)
    told = scores.select(F.col("text").alias("__text"), F.col("score").alias("__score"))
    out = known.join(told.hint("merge"), F.when(open_, text) == F.col("__text"), "left").drop("__text")
    blocked = F.coalesce(F.col("__score") > cut, F.lit(False))
    out = out.withColumns(
        {"score": F.when(open_, F.coalesce("__score", F.lit(0.0))), "verdict": F.coalesce("verdict", F.when(blocked, "block").otherwise("allow"))}
    )
    return out.drop("__score")
