"""Prompts for a model and tables from its replies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrain.functions.jsonx import extract_json, is_object, reply_items, verdict_items
from loomgrain.operators.selection import question_types
from loomgrain.sources.model import Generator, ask

#: What each question type asks for, in our own words.
TYPE_BRIEFS = {
    "artifact_diagnosis": "name the likely cause of an observation that the text describes",
    "modality_selection": "say which technique serves a stated aim and for what reason",
    "result_interpretation": "explain what a reported finding means where it stands",
    "instrumentation": "ask about a device setting or what limits an acquisition",
    "image_analysis": "ask about a step or parameter of processing or measuring",
    "sample_prep": "ask about a choice in preparing samples and its grounds",
    "limitations": "ask about a weakness or caveat that the text admits",
    "comparative_tradeoff": "ask about a trade-off that the text itself weighs",
}
SYSTEM_GENERATE = (
    "Write teaching questions with answers from one text and nothing else. Every answer needs a passage copied from the text "
    "letter by letter, and every number must stand in the text. Questions make sense without the text; leave out figures, "
    'tables and references. Answer in JSON: {"pairs":[{"type":"","question":"","answer":"","supporting_span":""}]}, '
    "one object for each type asked for, in that order."
)
SYSTEM_JUDGE = (
    "Check each numbered answer against the source. It is supported only if all it says, numbers too, is in the source. "
    'Answer in JSON: {"verdicts":[{"n":1,"supported":true}]}, one for each item, in order.'
)


def _briefs(t: Column) -> Column:
    out = F.lit("")
    for name, brief in TYPE_BRIEFS.items():
        out = F.when(t == name, brief).otherwise(out)
    return out


def generation_prompt(context: Column, types: Column) -> Column:
    """Numbered types with what each asks for, then the text."""
    asked = F.transform(types, lambda t, i: F.concat((i + 1).cast("string"), F.lit(". "), t, F.lit(": "), _briefs(t)))
    return F.concat(
        F.lit("Types, in order:\n"), F.array_join(asked, "\n"), F.lit("\n\n--- text ---\n"), context, F.lit("\n--- end ---")
    )


def judge_prompt(context: Column, pairs: Column) -> Column:
    """The source and numbered questions with answers."""
    listed = F.transform(
        pairs,
        lambda p, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), p["question"], F.lit("\n -> "), p["answer"]),
    )
    return F.concat(F.lit("--- source ---\n"), context, F.lit("\n--- items ---\n"), F.array_join(listed, "\n"))


def generation_prompts(contexts: DataFrame, papers: DataFrame, cap: int, key: str = "pmcid") -> DataFrame:
    """(key, types, prompt) of papers that enable a question type; the selection is the narrow side of the join."""
    facets = papers.select(key, "facets")
    rows = contexts.join(facets, key, "left").withColumn("types", question_types(F.coalesce("facets", F.lit("")), cap))
    rows = rows.where(F.size("types") > 0)
    return rows.select(key, "types", generation_prompt(F.col("context"), F.col("types")).alias("prompt"))


def parse_generation(replies: DataFrame, key: str = "pmcid") -> DataFrame:
    """(key, items, pairs_json, ok): ok is 1 for a list with anything in it; errors and other replies are 0 and null."""
    items = F.when(F.col("error").isNull(), reply_items(F.col("reply"), "pairs"))
    rows = replies.select(key, items.alias("items"))
    good = F.coalesce(F.size("items") > 0, F.lit(False))
    return rows.select(
        key,
        F.when(good, F.col("items")).alias("items"),
        F.when(good, F.concat(F.lit("["), F.array_join("items", ", "), F.lit("]"))).alias("pairs_json"),
        good.cast("int").alias("ok"),
    )


def explode_pairs(parsed: DataFrame, key: str = "pmcid") -> DataFrame:
    """(key, ord, id, type, question, answer, span, supporting_span) of the items that are objects.

    Values that are not strings count as empty, which the guard drops, rather than stopping the stage.
    """
    each = parsed.where("ok = 1").select(key, F.posexplode("items").alias("ord", "item")).where(is_object(F.col("item")))

    def text(name: str) -> Column:
        raw = F.get_json_object("item", f"$.{name}")
        quoted = F.col("item").rlike(rf'"{name}"\s*:\s*"')
        return F.when(quoted, raw)

    ids = F.sha2(F.concat_ws("|", key, F.col("ord").cast("string")), 256)
    return each.select(key, "ord", ids.alias("id"), *[text(n).alias(n) for n in ("type", "question", "answer", "span", "supporting_span")])


def unjudged_by_paper(pairs: DataFrame, key: str = "pmcid") -> DataFrame:
    """(key, pairs): kept pairs without a verdict, in order; bounded by the pairs asked for from one paper."""
    open_ = pairs.where("kept = 1 and judged = -1")
    return open_.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("id", "question", "answer"))).alias("pairs"))


def parse_verdicts(replies: DataFrame, asked: DataFrame, key: str = "pmcid", on_error: str = "reject") -> DataFrame:
    """(id, judged) for every pair asked about: the last verdict with its number, 0 without one.

    on_error='retry' leaves the pairs of failed calls unjudged instead.
    """
    told = replies.select(key, F.posexplode(verdict_items(F.coalesce("reply", F.lit("")))).alias("at", "v"))
    last = told.groupBy(key, F.col("v.n").alias("n")).agg(F.max_by("v.supported", "at").alias("supported"))
    items = asked.select(key, F.posexplode("pairs").alias("i", "p")).select(key, (F.col("i") + 1).cast("long").alias("n"), "p.id")
    if on_error == "retry":
        items = items.join(replies.where("error is null").select(key), key, "left_semi")
    out = items.join(last, [key, "n"], "left")
    return out.select("id", F.when(F.coalesce("supported", F.lit(False)), 1).otherwise(0).alias("judged"))


def classify(prompts: DataFrame, make: Callable[[], Generator], key: str, system: str = "", max_tokens: int = 256) -> DataFrame:
    """(key, label, error): the model's replies as canonical JSON; null where nothing parses."""
    replies = ask(prompts, make, key=key, system=system, max_tokens=max_tokens)
    return replies.select(key, extract_json(F.coalesce("reply", F.lit(""))).alias("label"), "error")


def usage_totals(replies: DataFrame) -> DataFrame:
    """Requests, retries and tokens over all replies."""
    return replies.agg(
        F.count(F.lit(1)).alias("requests"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "retries")],
    )
