"""The resumable curation pipeline: select, sections, generate, guard, judge, export; each stage does what is left to do."""

from __future__ import annotations

import argparse
import datetime
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loomgrain.functions.text import build_context, usable_context
from loomgrain.operators import generation, grounding, records, report, selection
from loomgrain.plans.config import CurationConfig, load_curation_config
from loomgrain.plans.progress import Progress
from loomgrain.session import Scratch
from loomgrain.sources.model import Generator, HttpGenerator, ask
from loomgrain.sources.readers import read_whole_files
from loomgrain.sources.sinks import write_chat
from loomgrain.sources.state import StateStore

# Papers that one commit holds.
SECTION_CHUNK = 1000
GUARD_CHUNK = 1000


class Curation:
    """The stages over a corpus folder (relevance, topics, candidates as Parquet), a store of files and a state folder."""

    def __init__(
        self, spark: SparkSession, config: CurationConfig, make: Callable[[], Generator] | None = None, on_error: str = "reject",
        model_tasks: int = 1, progress_file: str | None = None,
    ):
        """model_tasks: tasks that call the model at once, each with the configured concurrency."""
        self.spark, self.config, self.on_error, self.model_tasks, self.progress_file = spark, config, on_error, model_tasks, progress_file
        self.state = StateStore(spark, config.state_db)
        self.make = make or (lambda c=config: HttpGenerator(c.base_url, c.model, c.concurrency, json_mode=True))

    def _corpus(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.config.source_db}/{table}")

    def _limited(self, rows: DataFrame, key: str = "pmcid") -> DataFrame:
        return rows.orderBy(key).limit(self.config.limit) if self.config.limit else rows

    def _chunks(self, label: str, rows: DataFrame, size: int, deadline: float | None = None, key: str = "pmcid") -> Iterator[DataFrame]:
        """rows in order of key, size at a time, each chunk to be committed before the next; none begins after the deadline.

        What is left to do is worked out once and written with a chunk number, so that a chunk reads its own rows only.
        """
        scratch = Scratch(self.spark, "pending")
        path = scratch.path(label)
        placed = records.dense_positions(rows, [key], "__at")
        chunk = F.floor(F.col("__at") / (size or 1 << 62)).cast("long")
        placed.withColumn("__chunk", chunk).drop("__at").write.partitionBy("__chunk").parquet(path)
        schema = StructType([*rows.schema.fields, StructField("__chunk", LongType())])
        stored = self.spark.read.schema(schema).parquet(path)
        sizes = sorted((r[0], r[1]) for r in stored.groupBy("__chunk").count().collect())
        progress, done = Progress(label, sum(n for _, n in sizes), self.progress_file), 0
        for number, n in sizes:
            if deadline is not None and time.time() >= deadline:
                break
            yield stored.where(F.col("__chunk") == number).drop("__chunk")
            done += n
            progress.update(done)
        scratch.drop_path(path)

    def select(self) -> None:
        topics = self._corpus("paper_topics_bert")
        tie = [c for c in ("row_no",) if c in topics.columns] or ["subtopic"]
        chosen = selection.select_papers(topics, self._corpus("paper_relevance"), self.config.select_n, self.config.select_seed, tie)
        self.state.replace("sft_paper", chosen.select("pmcid", "a", "e", "facets"))

    def sections(self) -> None:
        c = self.config
        left = self._limited(records.pending(self.state.read("sft_paper").select("pmcid"), self.state.read("paper_ctx"), "pmcid"))
        fetched = self._corpus("candidates").where("fetch_state = 'fetched'")
        # of several rows of a paper the last one counts: by number if rows have one, else by place
        place = F.col("row_no") if "row_no" in fetched.columns else F.monotonically_increasing_id()
        fetched = fetched.withColumn("__place", place).groupBy("pmcid").agg(F.max_by("local_path", "__place").alias("local_path"))
        for part in self._chunks("sections", left.join(fetched, "pmcid").select("pmcid", "local_path"), SECTION_CHUNK):
            files = read_whole_files(self.spark, c.store, [tuple(r) for r in part.collect()])
            context = build_context(F.col("text"), c.abstract_chars, c.methods_chars, c.results_chars)
            rows = files.select("pmcid", context.alias("context"))
            # unusable papers are recorded with a null context, so that they are not parsed again
            rows = rows.withColumn("context", F.when(usable_context(F.col("context")), F.col("context")))
            self.state.append("paper_ctx", rows)

    def contexts(self) -> DataFrame:
        return self.state.read("paper_ctx").where("context is not null")

    def generate(self, deadline: float | None = None) -> None:
        c = self.config
        done = self.state.read("gen").where("ok = 1")
        left = self._limited(records.pending(self.contexts(), done, "pmcid"))
        papers = self.state.read("sft_paper")
        for part in self._chunks("generate", left, c.generate_chunk, deadline):
            prompts = generation.generation_prompts(part, papers, c.pairs_per_paper)
            replies = ask(
                prompts, self.make, system=generation.SYSTEM_GENERATE, max_tokens=c.generate_max_tokens, temperature=c.generate_temperature,
                tasks=self.model_tasks,
            )
            parsed = generation.parse_generation(replies)
            now = datetime.datetime.now().strftime("%Y-%m-%dT%H:%M:%S")
            self.state.append("gen", parsed.select("pmcid", "pairs_json", "ok", F.lit(now).alias("ts")))

    def guard(self) -> None:
        good = self.state.read("gen").where("ok = 1")
        left = self._limited(records.pending(good, self.state.read("pair").select("pmcid").distinct(), "pmcid"))
        items = F.from_json("pairs_json", "array<string>")
        for part in self._chunks("guard", left.select("pmcid", "ok", items.alias("items")), GUARD_CHUNK):
            checked = grounding.check_pairs(generation.explode_pairs(part), self.contexts())
            self.state.append("pair", checked.select("id", "pmcid", "type", "question", "answer", "span", "kept", "reason"))

    def judge(self, deadline: float | None = None) -> None:
        c = self.config
        asked = self._limited(generation.unjudged_by_paper(self.state.pairs()))
        contexts = self.contexts()
        for part in self._chunks("judge", asked, c.judge_chunk, deadline):
            rows = part.join(contexts, "pmcid", "left")
            prompt = generation.judge_prompt(F.coalesce("context", F.lit("")), F.col("pairs"))
            replies = ask(
                rows.select("pmcid", prompt.alias("prompt")), self.make, system=generation.SYSTEM_JUDGE,
                max_tokens=c.judge_max_tokens, temperature=c.judge_temperature, tasks=self.model_tasks,
            )
            replies = replies.persist()
            self.state.append("verdict", generation.parse_verdicts(replies, part, on_error=self.on_error))
            replies.unpersist()

    def export(self) -> None:
        write_chat(self.state.pairs(), self.config.export_file, self.config.require_judge)

    def stats(self) -> DataFrame:
        return report.pair_status(self.state.pairs())

    def advance(self, marks: set[str] | None = None, hours: float = 4.0) -> str | None:
        """Run the stage that the state calls for, model stages until the time is up; returns it, or None when all is done.

        marks has the finished stages and gains those that this call finishes; without it they are kept in the state folder.
        """
        stored = marks is None
        marks = self.state.marks() if stored else marks
        told = self.state.pairs().agg(report.count_where("kept = 1").alias("kept"), report.count_where("judged <> -1").alias("judged")).first()
        contexts = self.contexts().count()

        def generated() -> int:
            return self.state.read("gen").where("ok = 1").count()

        stage = report.next_stage(self.state.read("sft_paper").count(), contexts, generated(), told.kept, told.judged, marks)
        if stage in ("generate", "judge"):
            getattr(self, stage)(time.time() + 3600 * hours)
        elif stage:
            getattr(self, stage)()
            marks.add(stage)
            if stored:
                self.state.mark(stage)
        return stage

    def run(self, stage: str) -> None:
        if stage not in (*report.STAGES, "all"):
            raise ValueError(f"unknown stage {stage}")
        for name in report.STAGES if stage == "all" else [stage]:
            getattr(self, name)()


def main(argv: list[str] | None = None) -> None:
    from loomgrain.session import build_session

    p = argparse.ArgumentParser(description="Run stages of the curation pipeline.")
    p.add_argument("--config", required=True)
    p.add_argument("--stage", default="all", choices=[*report.STAGES, "all", "stats", "next"], help="next: whatever the state calls for")
    p.add_argument("--hours", type=float, default=4.0, help="how long a model stage may take with --stage next")
    for name in ("store", "source-db", "state-db", "export-file", "base-url", "model"):
        p.add_argument(f"--{name}")
    p.add_argument("--concurrency", type=int)
    p.add_argument("--progress-file")
    p.add_argument("--limit", type=int)
    a = vars(p.parse_args(argv))
    config = load_curation_config(a.pop("config"), a)
    curation = Curation(build_session("curation"), config, progress_file=a["progress_file"])
    if a["stage"] == "stats":
        curation.stats().show(truncate=False)
    elif a["stage"] == "next":
        print(curation.advance(hours=a["hours"]) or "done")
    else:
        curation.run(a["stage"])


if __name__ == "__main__":
    main()
