"""All queries of the engine over the driver's tables; their DuckDB equivalents are in catalog_sql."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgrain import catalog_sql
from loomgrain.functions import jsonx, text
from loomgrain.functions.tokenize import library_ids
from loomgrain.operators import blocks, generation, grounding, metrics, records, report, selection
from loomgrain.session import Scratch, ship_package
from loomgrain.sources import sinks
from loomgrain.sources.model import StubGenerator, ask


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{d}/{table}.parquet")


def _topics(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("pmcid"),
        F.expr("substring('ABCDEFJ', l_linenumber, 1)").alias("facet"),
        F.concat("l_returnflag", "l_linestatus").alias("subtopic"),
        F.col("l_discount").alias("prob"),
        "l_partkey",
        "l_suppkey",
    )


def _relevance(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "orders").select(
        F.col("o_orderkey").alias("pmcid"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_micro")
    )


TIE = ["l_partkey", "l_suppkey"]


def select_semi_join(spark, d):
    return selection.relevant_topics(_topics(spark, d), _relevance(spark, d)).select("pmcid", "facet", "subtopic", "prob")


def _profile(spark, d):
    return selection.facet_profile(selection.relevant_topics(_topics(spark, d), _relevance(spark, d)), TIE)


def facet_sets(spark, d):
    return _profile(spark, d).select("pmcid", "facets")


def facet_argmax(spark, d):
    p = _profile(spark, d)
    return p.select("pmcid", selection.stratum(F.col("a")).alias("a"), selection.stratum(F.col("e")).alias("e"))


def strata_counts(spark, d):
    return selection.count_strata(_read(spark, d, "documents"), ["lang", "source"])


def allocate_floor(spark, d):
    return selection.allocate(strata_counts(spark, d), 400, ["lang", "source"])


def allocate_overshoot(spark, d):
    return selection.allocate(strata_counts(spark, d), 50, ["lang", "source"])


def stratified_sample(spark, d):
    docs = _read(spark, d, "documents").select("doc_id", "lang", "source")
    return selection.stratified_sample(docs, allocate_floor(spark, d), ["lang", "source"], "doc_id", 7)


def select_papers(spark, d):
    return selection.select_papers(_topics(spark, d), _relevance(spark, d), 300, 7, TIE).select("pmcid", "a", "e", "facets")


def type_selection(spark, d):
    return facet_sets(spark, d).select("pmcid", F.array_join(selection.question_types(F.col("facets")), ",").alias("types"))


def resume_antijoin(spark, d):
    return records.pending(_read(spark, d, "documents").select("doc_id"), _read(spark, d, "labels"), "doc_id")


def missing_path_inner(spark, d):
    paths = _read(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return records.limited_lookup(_read(spark, d, "labels").select("doc_id"), paths, "doc_id", 200)


def left_default(spark, d):
    docs = _read(spark, d, "documents").select("doc_id")
    return records.with_default(docs, _read(spark, d, "labels"), "doc_id", "toxic", -1)


def state_upsert(spark, d):
    o = _read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return records.latest(o, ["o_custkey"], "o_orderkey")


def state_store(spark, d):
    """Verdicts committed to a state store: a table loaded anew, then a part that replaces some of its rows."""
    from loomgrain.sources.state import StateStore

    o = _read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderkey").alias("k"))
    store = StateStore(spark, Scratch(spark, "state").path("store"))
    store.replace("verdict", o.select("id", F.lit(0).alias("judged")))
    store.append("verdict", o.where("k % 3 = 0").select("id", F.lit(1).alias("judged")))
    return store.read("verdict")


def markup_clean(spark, d):
    c = text.clean_markup(F.col("html"))
    return _read(spark, d, "pages").select("page_id", F.length(c).cast("long").alias("n_chars"), F.md5(c).alias("digest"))


def title_body_extract(spark, d):
    body = text.element(F.col("html"), "body", boundary=True)
    return _read(spark, d, "pages").select(
        "page_id",
        text.clean_markup(text.element(F.col("html"), "title")).alias("title"),
        body.isNotNull().alias("has_body"),
        F.length(F.coalesce(body, "html")).cast("long").alias("body_chars"),
    )


def _articles(spark, d):
    """Pages whose headings have an article's section marks before them."""
    html = F.regexp_replace("html", "<h1", '<sec sec-type="materials|methods"><h1')
    return _read(spark, d, "pages").select("page_id", F.regexp_replace(html, "<h2", "<title>Results </title><h2").alias("html"))


def section_excerpt(spark, d):
    return _articles(spark, d).select("page_id", text.section_excerpt(F.col("html"), text.METHODS_ANCHOR, 200).alias("excerpt"))


def context_build(spark, d):
    c = text.build_context(F.col("html"), 300, 400, 400, title_tag="title", abstract_tag="p")
    rows = _articles(spark, d).select("page_id", c.alias("context"))
    return rows.select(
        "page_id", F.length("context").cast("long").alias("n_chars"), F.md5("context").alias("digest"), text.usable_context(F.col("context")).alias("usable")
    )


def _pairs(spark, d):
    """Six derived pairs for each document, which between them meet every verdict of the guard."""
    t, n = F.col("text"), F.col("doc_id").cast("string")
    verbatim, stated = F.substring(t, 11, 60), F.lit("as stated")
    kinds = [
        ("verbatim", stated, verbatim),
        ("stitched", stated, F.concat(F.substring(t, 1, 40), F.lit(" ... "), F.substring(t, 60, 40))),
        ("foreign", stated, F.concat(F.lit("zz"), verbatim)),
        ("number", F.concat(F.lit("about "), (F.col("doc_id") % 100).cast("string")), verbatim),
        ("blank", F.lit(" \n "), verbatim),
        ("short", stated, F.substring(t, 1, 8)),
    ]
    each = F.array(*[F.struct(F.lit(k).alias("type"), a.alias("answer"), s.alias("span")) for k, a, s in kinds])
    rows = _read(spark, d, "documents").select("doc_id", F.explode(each).alias("p"), F.concat(F.lit("what of "), n).alias("question"))
    return rows.select("doc_id", "question", "p.type", "p.answer", "p.span")


def _guarded(spark, d):
    contexts = _read(spark, d, "documents").select("doc_id", F.col("text").alias("context"))
    return grounding.check_pairs(_pairs(spark, d), contexts, key="doc_id")


def _judged(spark, d):
    told = F.when(F.col("kept") == 1, (F.col("doc_id") % 3).cast("int") - 1).otherwise(-1)
    return _guarded(spark, d).withColumn("judged", told)


def span_grounding(spark, d):
    rows = _guarded(spark, d).where("type in ('verbatim', 'foreign', 'short')")
    return rows.select("doc_id", "type", (F.col("reason") != "span").alias("grounded"))


def ellipsis_stitch(spark, d):
    return _guarded(spark, d).where("type = 'stitched'").select("doc_id", (F.col("reason") != "span").alias("grounded"))


def number_grounding(spark, d):
    rows = _guarded(spark, d).where("type = 'number' and (reason = '' or reason like 'num:%')")
    return rows.select("doc_id", F.nullif(F.substring_index("reason", ":", -1), F.lit("")).alias("offender"))


def pair_guard(spark, d):
    return _guarded(spark, d).select("doc_id", "type", "kept", "reason")


def guard_reasons(spark, d):
    return grounding.reason_counts(_guarded(spark, d))


def drop_reason_topk(spark, d):
    return grounding.drop_reasons(_guarded(spark, d))


def kept_by_type(spark, d):
    return grounding.kept_by_type(_guarded(spark, d))


def status_counts(spark, d):
    return report.pair_status(_judged(spark, d)).withColumn("kept_percent", F.round("kept_percent", 6))


def export_chat(spark, d):
    return sinks.export_rows(_judged(spark, d))


def _replies(spark, d):
    """Model replies of every shape that the parsers know, one for each document."""
    n = F.col("doc_id").cast("string")
    item = F.concat(F.lit('{"type":"t","question":"q'), n, F.lit('","answer":"a","supporting_span":"s","n":1,"supported":true}'))
    shapes = [
        F.concat(F.lit('{"pairs":['), item, F.lit("]}")),
        F.concat(F.lit("Sure:\n```json\n["), item, F.lit("]\n```\nDone.")),
        F.concat(F.lit("It is {"), n, F.lit("} or "), item),
        F.lit(""),
        F.concat(F.lit('{"verdicts":['), item, F.lit(',{"n":"2","supported":"false"},{"n":1.7,"supported":false}]}')),
    ]
    out = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        out = F.when(F.col("doc_id") % 5 == i, shape).otherwise(out)
    return _read(spark, d, "documents").select("doc_id", out.alias("reply"), F.lit(None).cast("string").alias("error"))


def json_extract_tolerant(spark, d):
    return _replies(spark, d).select("doc_id", jsonx.extract_json(F.col("reply")).alias("parsed"))


def json_objects_all(spark, d):
    return _replies(spark, d).select("doc_id", F.size(jsonx.extract_objects(F.col("reply"))).cast("long").alias("n_objects"))


def generation_parse(spark, d):
    return generation.parse_generation(_replies(spark, d), "doc_id").select("doc_id", "ok", "pairs_json")


def judge_verdicts(spark, d):
    pair = [F.struct(F.concat_ws(":", "doc_id", F.lit(i)).alias("id"), F.lit("q").alias("question"), F.lit("a").alias("answer")) for i in (1, 2, 3)]
    asked = _read(spark, d, "documents").select("doc_id", F.array(*pair).alias("pairs"))
    return generation.parse_verdicts(_replies(spark, d), asked, "doc_id")


def generation_prompts(spark, d):
    contexts = _read(spark, d, "documents").select(F.col("doc_id").alias("pmcid"), F.col("text").alias("context"))
    rows = generation.generation_prompts(contexts, facet_sets(spark, d), 6)
    return rows.select("pmcid", F.size("types").cast("long").alias("n_types"), F.length("prompt").cast("long").alias("n_chars"))


def model_stub_batch(spark, d):
    prompts = _read(spark, d, "documents").select("doc_id", F.col("text").alias("prompt"))
    return ask(prompts, StubGenerator, key="doc_id").select("doc_id", "reply", "prompt_tokens", "completion_tokens")


def classify_batch(spark, d):
    prompts = _read(spark, d, "benchmark").select("item_id", F.col("text").alias("prompt"))
    return generation.classify(prompts, StubGenerator, "item_id")


def usage_totals(spark, d):
    prompts = _read(spark, d, "benchmark").select("item_id", F.col("text").alias("prompt"))
    return generation.usage_totals(ask(prompts, StubGenerator, key="item_id"))


def _chats(spark, d):
    """First turns by role: a partial aggregate, so that no conversation is gathered however long it is."""
    t = _read(spark, d, "conversations")

    def first(role: str):
        fits = (F.col("role") == role) & (text.strip(F.col("text")) != "")
        return F.min(F.when(fits, F.struct("turn", "text")))["text"].alias(role)

    return t.groupBy("conv_id").agg(first("user"), first("assistant"))


def chat_first_turns(spark, d):
    bad = F.col("user").isNull() | F.col("assistant").isNull()
    return _chats(spark, d).select("conv_id", "user", "assistant", bad.alias("malformed"))


def _valid_chats(spark, d):
    rows = _chats(spark, d).where("user is not null and assistant is not null")
    return rows.select(F.col("conv_id").alias("line_id"), "user", "assistant")


def sft_dedup(spark, d):
    once = _valid_chats(spark, d)
    twice = once.unionByName(once.withColumn("line_id", F.col("line_id") + 1_000_000_000))
    return records.first_of_equal(twice, ["user", "assistant"], ["line_id"])


def sft_split(spark, d):
    first = records.first_of_equal(_valid_chats(spark, d), ["user", "assistant"], ["line_id"])
    return records.holdout(first, 0.1, 3, "line_id").select("line_id", "split")


def normalize_tokens(spark, d):
    rows = _read(spark, d, "documents").select("doc_id", text.answer_tokens(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


def _answers(spark, d):
    t = _read(spark, d, "conversations").where("role = 'assistant'")
    w = Window.partitionBy("conv_id").orderBy("turn", "text")
    rows = t.withColumn("reference", F.lag("text").over(w)).where("reference is not null")
    return rows.select("conv_id", "turn", F.col("text").alias("prediction"), "reference")


def token_f1(spark, d):
    return metrics.score_answers(_answers(spark, d)).select("conv_id", "turn", F.round("f1", 6).alias("f1"))


def exact_match(spark, d):
    return metrics.score_answers(_answers(spark, d)).select("conv_id", "turn", "exact")


def _losses(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return _read(spark, d, "events").select("event_type", (F.col("value") / 100).alias("loss"), k.alias("n_tokens"))


def weighted_perplexity(spark, d):
    out = metrics.weighted_perplexity(_losses(spark, d), ["event_type"])
    return out.select("event_type", F.round("loss", 6).alias("loss"), F.round("perplexity", 6).alias("perplexity"))


def answer_metrics(spark, d):
    rows = _answers(spark, d).withColumns({"loss": F.length("prediction") / 1000, "n_tokens": (F.col("turn") % 4).cast("long")})
    out = metrics.answer_metrics(rows)
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("exact_match", "f1", "loss", "perplexity")])


def _word_ids(spark, d):
    return _read(spark, d, "documents").select(F.col("doc_id").alias("doc_pos"), text.word_ids(F.col("text")).alias("input_ids"))


def word_tokenize(spark, d):
    total = F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x)
    return _word_ids(spark, d).select(
        F.col("doc_pos").alias("doc_id"), F.size("input_ids").cast("long").alias("n"), F.get("input_ids", F.lit(0)).alias("first_id"), total.alias("total")
    )


def pack_blocks(spark, d):
    packed = blocks.pack_blocks(_word_ids(spark, d), 64, 256)
    total = F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x)
    return packed.select(
        "batch", "block", F.col("input_ids")[0].alias("first_id"), F.col("input_ids")[63].alias("last_id"), total.alias("total")
    )


def pack_dropped(spark, d):
    return blocks.packing_loss(_word_ids(spark, d), 64, 256)


def interleave_schedule(spark, d):
    n, m = _read(spark, d, "documents").count(), _read(spark, d, "benchmark").count()
    return blocks.interleave_schedule(n, m, 0.15, 0, spark)


def interleave_rows(spark, d):
    a = _read(spark, d, "documents").select(F.col("doc_id").alias("pos"), F.col("text").alias("payload"))
    b = _read(spark, d, "benchmark").select(F.col("item_id").alias("pos"), F.col("text").alias("payload"))
    return blocks.interleave(a, b, 0.15, 0).select("step", "source", "pos", F.md5("payload").alias("digest"))


def max_docs_prefix(spark, d):
    """The first documents by position: the cap is the feature."""
    return _read(spark, d, "documents").where("doc_id < 100").select("doc_id", "n_chars")


def step_budget(spark, d):
    n = pack_blocks(spark, d).count()
    return spark.createDataFrame([(n, blocks.step_budget(n, 32, 2, 0.15))], "blocks long, steps long")


def cache_fingerprint(spark, d):
    parts = ["1", "a model", "text", "4096", "0.01", "0", "a.jsonl.gz:120:1700000000"]
    return spark.range(1).select(text.fingerprint(*[F.lit(p) for p in parts]).alias("fingerprint"))


def next_stage(spark, d):
    s = _judged(spark, d).agg(
        F.count_distinct("doc_id").alias("papers"), report.count_where("kept = 1").alias("kept"), report.count_where("judged <> -1").alias("judged")
    ).first()
    stage = report.next_stage(s.papers, s.papers, s.papers, s.kept, s.judged, {"sections", "guard"})
    return spark.createDataFrame([(s.papers, s.kept, s.judged, stage)], "papers long, kept long, judged long, stage string")


#: Text with characters that NFKC changes, by doc_id modulo 3.
COMPOSED = [" ﬁne ①② Ａｂ", " x² ½ ㎏", " a\u2009b Å"]


def nfkc_normalize(spark, d):
    tail = F.element_at(F.array(*[F.lit(x) for x in COMPOSED]), (F.col("doc_id") % 3 + 1).cast("int"))
    n = text.normalise(F.concat("text", tail))
    return _read(spark, d, "documents").select("doc_id", F.length(n).cast("long").alias("n_chars"), F.md5(n).alias("digest"))


def bpe_tokenize(spark, d):
    import public_tokenizers

    ids = library_ids(F.col("text"), public_tokenizers.path("byte_bpe_50k.json"))
    rows = _read(spark, d, "documents").select("doc_id", ids.alias("ids"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"))


def chat_export_roundtrip(spark, d):
    """Pairs exported as chat lines and read back through the chat reader."""
    from loomgrain.sources.readers import read_chat_lines

    path = Scratch(spark, "export").path("chat")
    sinks.write_chat(_judged(spark, d), path)
    rows = records.chat_pairs(read_chat_lines(spark, path))
    return rows.where(~F.col("malformed")).groupBy("user", "assistant").agg(F.count(F.lit(1)).alias("n"))


def stream_counts(spark, d):
    """The event table as a stream of files, counted by hour and kind; every micro-batch replaces the table of counts."""
    from loomgrain.streaming import contexts as streams

    schema = _read(spark, d, "events").schema
    scratch = Scratch(spark, "stream")
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = streams.windowed_counts(events, "ts", "event_type", "1 hour", "1 day")
    path = scratch.path("counts")
    streams.replace_table(counts, path, scratch.path("offsets")).awaitTermination()
    return spark.read.parquet(path).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


_QUERIES = [
    select_semi_join, facet_sets, facet_argmax, strata_counts, allocate_floor, allocate_overshoot, stratified_sample, select_papers,
    type_selection, resume_antijoin, missing_path_inner, left_default, state_upsert, state_store, markup_clean, title_body_extract, section_excerpt,
    context_build, span_grounding, ellipsis_stitch, number_grounding, pair_guard, guard_reasons, drop_reason_topk, kept_by_type,
    status_counts, export_chat, json_extract_tolerant, json_objects_all, generation_parse, judge_verdicts, generation_prompts,
    model_stub_batch, classify_batch, usage_totals, chat_first_turns, sft_dedup, sft_split, normalize_tokens, token_f1, exact_match, weighted_perplexity,
    answer_metrics, word_tokenize, pack_blocks, pack_dropped, interleave_schedule, interleave_rows, max_docs_prefix, step_budget,
    cache_fingerprint, next_stage, nfkc_normalize, bpe_tokenize, chat_export_roundtrip, stream_counts,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(catalog_sql.SQL)
