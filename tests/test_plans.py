import gzip
import json

import pytest
from pyspark.sql import functions as F

from loomgrain.functions import jsonx
from loomgrain.operators import generation, metrics, report
from loomgrain.plans import config, corpus, curation, evaluate, progress
from loomgrain.sources import model, readers, state
from loomgrain.streaming import contexts as streaming

GOOD = {"model": {"name": "m"}, "data": {}, "train": {}, "output": {}}


def write_yaml(path, value):
    path.write_text(json.dumps(value))
    return path


def test_stage_config(tmp_path):
    assert config.load_stage_config(write_yaml(tmp_path / "a.yaml", GOOD)) == GOOD
    with pytest.raises(KeyError, match="train"):
        config.load_stage_config(write_yaml(tmp_path / "b.yaml", {k: v for k, v in GOOD.items() if k != "train"}))
    with pytest.raises(TypeError, match="data"):
        config.load_stage_config(write_yaml(tmp_path / "c.yaml", GOOD | {"data": []}))
    with pytest.raises(ValueError):
        config.load_stage_config(write_yaml(tmp_path / "d.yaml", [1]))
    with pytest.raises(FileNotFoundError):
        config.load_stage_config(tmp_path / "none.yaml")
    with pytest.raises(ValueError):
        config.infer_stage(GOOD)


@pytest.mark.parametrize(
    "reply, wanted",
    [
        ('{"pairs": [1]}', {"pairs": [1]}),
        ("[1, 2]", [1, 2]),
        ('say ```json\n{"a": 1}\n``` end', {"a": 1}),
        ('so {"a": {"b": 2}} it is', {"a": {"b": 2}}),
        ("see [3] only", [3]),
        ("7", 7),
        ("", None),
        ("none", None),
        ('{"a": 1, "a": 2}', {"a": 2}),
        ("{oops", None),
    ],
)
def test_tolerant_json(reply, wanted):
    assert jsonx.parse_tolerant(reply) == wanted


def test_balanced_objects():
    assert jsonx.balanced_objects('x {"a": "}{"} y {bad} {"b": {"c": 1}} {') == ['{"a": "}{"}', '{"b": {"c": 1}}']
    assert jsonx.balanced_objects(None) == []


def test_generation_and_verdicts(spark):
    replies = [
        ("a", '{"pairs":[{"type":"t","question":"q","answer":5,"span":"","supporting_span":"s"}, 3]}', None),
        ("b", "[]", None),
        ("c", '{"pairs":[{}]}', "timeout"),
        ("d", None, None),
    ]
    parsed = generation.parse_generation(spark.createDataFrame(replies, "pmcid string, reply string, error string"))
    assert {r.pmcid: r.ok for r in parsed.collect()} == {"a": 1, "b": 0, "c": 0, "d": 0}
    rows = generation.explode_pairs(parsed).collect()
    assert [(r.pmcid, r.ord, r.question, r.answer, r.span, r.supporting_span) for r in rows] == [("a", 0, "q", None, "", "s")]
    asked = spark.createDataFrame(
        [(k, [(f"{k}{i}", "q", "a") for i in (1, 2, 3)]) for k in "ab"], "pmcid string, pairs array<struct<id:string,question:string,answer:string>>"
    )
    told = [
        ("a", '{"verdicts":[{"n":"1","supported":true},{"n":2.7,"supported":true},{"n":2,"supported":0},{"n":"x"},{"n":9,"supported":true},{"supported":true}]}', None),
        ("b", None, "down"),
    ]
    told = spark.createDataFrame(told, "pmcid string, reply string, error string")
    assert {r.id: r.judged for r in generation.parse_verdicts(told, asked).collect()} == {"a1": 1, "a2": 0, "a3": 0, "b1": 0, "b2": 0, "b3": 0}
    assert {r.id for r in generation.parse_verdicts(told, asked, on_error="retry").collect()} == {"a1", "a2", "a3"}


def test_prompts_name_types_and_questions(spark):
    c = spark.createDataFrame([("p", "the text", "BC"), ("q", "other", "")], "pmcid string, context string, facets string")
    rows = generation.generation_prompts(c.drop("facets"), c, 6).collect()
    assert len(rows) == 1 and all(t in rows[0].prompt for t in ("artifact_diagnosis", "sample_prep", "the text"))
    pairs = spark.createDataFrame([([("why?", "so")],)], "pairs array<struct<question:string,answer:string>>")
    assert "[1] why?" in pairs.select(generation.judge_prompt(F.lit("s"), F.col("pairs")).alias("p")).first().p


def test_metrics(spark):
    rows = [("a b b", "b b c", 1.0, 2), ("Ä, x!", "ä x", 2.0, 0), ("", "", 3.0, 4), ("!", "a", 1.0, 1)]
    df = spark.createDataFrame(rows, "prediction string, reference string, loss double, n_tokens long")
    got = metrics.score_answers(df).collect()
    assert [round(r.f1, 6) for r in got] == [round(2 / 3, 6), 1.0, 1.0, 0.0] and [r.exact for r in got] == [0, 1, 1, 0]
    m = evaluate.evaluate(df, "sft")
    assert m["n"] == 4 and m["loss"] == round((2 + 12 + 1) / 7, 4)
    assert evaluate.evaluate(df.limit(0), "dapt")["perplexity"] == 1.0


def test_report():
    assert report.tolerance(10) == 200 and report.tolerance(100_000) == 500
    assert report.next_stage(0, 0, 0, 0, 0, set()) == "select"
    assert report.next_stage(9, 0, 0, 0, 0, set()) == "sections"
    assert report.next_stage(9, 900, 0, 0, 0, {"sections"}) == "generate"
    assert report.next_stage(9, 900, 800, 0, 0, {"sections"}) == "guard"
    assert report.next_stage(9, 900, 800, 900, 0, {"sections", "guard"}) == "judge"
    assert report.next_stage(9, 900, 800, 900, 900, {"sections", "guard"}) == "export"
    assert report.next_stage(9, 900, 800, 900, 900, {"sections", "guard", "judge", "export"}) is None
    assert [report.duration(s) for s in (5, 90, 7200)] == ["5s", "1.5m", "2.0h"]


def chat(user, assistant):
    return json.dumps({"messages": [{"role": "user", "content": user}, {"role": "assistant", "content": assistant}]}, ensure_ascii=False)


def test_chat_preparation(spark, tmp_path):
    lines = [chat("a", "b"), chat("a", "b"), chat("ü", "c"), chat("d", "e"), "junk", json.dumps({"messages": [{"role": "user", "content": "x"}]}), chat("f", "  "), ""]
    (tmp_path / "chat.jsonl").write_text("\n".join(lines))
    c = GOOD | {"data": {"train_file": str(tmp_path / "chat.jsonl"), "val_fraction": 0.5, "processed_dir": str(tmp_path / "out")}}
    rows, counts = corpus.prepare(spark, c)
    assert counts == {"kept": 3, "malformed": 3, "duplicate": 1}
    assert sorted(r.split for r in rows.collect()) == ["train", "validation", "validation"]
    again, _ = corpus.prepare(spark, c)
    assert {tuple(r) for r in rows.collect()} == {tuple(r) for r in again.collect()}
    written = [r.value for s in ("train", "validation") for r in spark.read.text(str(tmp_path / "out" / f"{s}.jsonl")).collect()]
    assert len(written) == 3 and any("ü" in w for w in written)


def test_block_preparation(spark, tmp_path):
    shards = tmp_path / "shards"
    shards.mkdir()
    docs = [f"w{i} " * (i % 7) for i in range(40)]
    with gzip.open(shards / "b.jsonl.gz", "wt") as f:
        f.writelines(json.dumps({"text": t, "other": 1}) + "\n" for t in docs[:25])
    (shards / "a.jsonl").write_text("".join(json.dumps({"text": t}) + "\n" for t in docs[25:]))
    data = {"corpus_dir": str(shards), "processed_dir": str(tmp_path / "packed"), "sequence_length": 8, "heldout_fraction": 0.25}
    train, held = corpus.prepare(spark, GOOD | {"data": data})
    n = sum(i % 7 + 1 for i in range(40)) // 8
    assert train.count() + held.count() == n and held.count() == -(-n // 4)
    first = train.unionByName(held).where("batch = 0 and block = 0").first().input_ids
    assert first[0] == 0 and first[2] == 0  # the first document of the .gz file is empty: its end id, then w1 and its end id
    marker = (tmp_path / "packed" / "packed_train").stat().st_mtime_ns
    corpus.prepare(spark, GOOD | {"data": data})
    assert (tmp_path / "packed" / "packed_train").stat().st_mtime_ns == marker
    with pytest.raises(FileNotFoundError):
        readers.list_shards(spark, str(tmp_path / "empty"))
    assert readers.resolve_replay(spark, str(shards)).count() == 40


MARKUP = '<article-title>T {i}</article-title><body><sec sec-type="methods"><p>We kept cell line {i} at 37 C for days.</p></sec></body>'


class Scripted:
    """A model that quotes the prompt for even papers, makes things up for odd ones, and supports every answer."""

    def generate(self, prompts, system, max_tokens, temperature):
        out = []
        for p in prompts:
            if system == generation.SYSTEM_JUDGE:
                out.append(model.Reply('{"verdicts":[{"n":1,"supported":true}]}'))
                continue
            i = int(p.split("cell line ")[1].split()[0])
            span = f"We kept cell line {i} at 37 C" if i % 2 == 0 else "We lost the cell line there"
            out.append(model.Reply(json.dumps({"pairs": [{"type": "t", "question": "q", "answer": "a", "supporting_span": span}]})))
        return out


def test_curation_resumes(spark, tmp_path):
    store = tmp_path / "store"
    store.mkdir()
    ids = [f"p{i:02d}" for i in range(12)]
    for i, p in enumerate(ids[:10]):
        (store / f"{p}.xml").write_bytes(MARKUP.format(i=i).encode() + b"\xff")
    db = tmp_path / "db"
    spark.createDataFrame([(p, 1) for p in ids], "pmcid string, is_micro int").write.parquet(str(db / "paper_relevance"))
    spark.createDataFrame([(p, "A", "s", 0.5, i) for i, p in enumerate(ids)], "pmcid string, facet string, subtopic string, prob double, row_no long").write.parquet(str(db / "paper_topics_bert"))
    spark.createDataFrame([(p, f"{p}.xml", "fetched") for p in ids], "pmcid string, local_path string, fetch_state string").write.parquet(str(db / "candidates"))
    values = dict.fromkeys(config.CurationConfig.__dataclass_fields__, 0) | {
        "store": str(store), "source_db": str(db), "state_db": str(tmp_path / "state"), "export_file": str(tmp_path / "out.jsonl"),
        "select_n": 12, "abstract_chars": 50, "methods_chars": 200, "results_chars": 50, "pairs_per_paper": 6, "require_judge": True,
        "generate_max_tokens": 10, "judge_max_tokens": 10, "limit": None, "generate_chunk": 4,
    }
    c = curation.Curation(spark, config.CurationConfig(**values), Scripted)
    c.run("all")
    s = c.stats().first()
    assert (s.pairs, s.kept, s.supported, s.unjudged) == (10, 5, 5, 0)
    assert spark.read.text(str(tmp_path / "out.jsonl")).count() == 5
    assert c.contexts().count() == 10 and c.state.read("paper_ctx").count() == 12
    c.run("all")
    assert c.stats().first().pairs == 10
    with pytest.raises(ValueError):
        c.run("nothing")
    marks = {"sections"}
    assert [c.advance(marks) for _ in range(3)] == ["guard", "export", None] and marks == {"sections", "guard", "export"}
    assert [c.advance() for _ in range(4)] == ["sections", "guard", "export", None] and c.state.marks() == marks


def test_progress(tmp_path):
    now = [0.0]
    p = progress.Progress("stage", 10, tmp_path / "p.json", clock=lambda: now[0])
    now[0] = 5.0
    p.update(2, "x")
    now[0] = 6.0
    p.update(3)
    said = json.loads((tmp_path / "p.json").read_text())
    assert (said["done"], said["pct"], said["eta_s"], said["extra"]) == (2, 20.0, 20.0, "x")
    p.update(10)
    assert json.loads((tmp_path / "p.json").read_text())["done"] == 10 and p.line(10) == "stage 10/10 in 6s"
    progress.Progress("s", 1, tmp_path / "no" / "p.json").update(1)


def test_state_store(spark, tmp_path):
    s = state.StateStore(spark, str(tmp_path))
    assert s.read("gen").count() == 0
    s.append("gen", spark.createDataFrame([("a", None, 0, "t1"), ("b", "[1]", 1, "t1")], state.SCHEMAS["gen"]))
    s.append("gen", spark.createDataFrame([("a", "[2]", 1, "t2")], state.SCHEMAS["gen"]))
    assert {(r.pmcid, r.ok) for r in s.read("gen").collect()} == {("a", 1), ("b", 1)}
    s.replace("gen", spark.createDataFrame([("c", None, 0, "t3")], state.SCHEMAS["gen"]))
    assert [r.pmcid for r in s.read("gen").collect()] == ["c"]


def test_http_generator(monkeypatch):
    seen = []

    class Answer:
        def __init__(self, body):
            self.body = body

        def read(self):
            return json.dumps(self.body).encode()

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

    def answer(request, timeout):
        seen.append(request)
        if len(seen) == 1:
            raise model.urllib.error.HTTPError("u", 503, "busy", {}, None)
        if len(seen) == 3:
            raise model.urllib.error.HTTPError("u", 400, "bad", {}, None)
        return Answer({"choices": [{"message": {"content": "hi"}}], "usage": {"prompt_tokens": 3, "completion_tokens": 1}})

    monkeypatch.setattr(model.urllib.request, "urlopen", answer)
    g = model.HttpGenerator("http://h/v1/", "m", concurrency=99, sleep=lambda s: None)
    assert g.concurrency == 32
    r = g.one("p", "s", 5, 0.0)
    assert (r.text, r.retries, r.prompt_tokens) == ("hi", 1, 3)
    assert g.one("p", "s", 5, 0.0).error == "HTTP 400"
    with pytest.raises(ValueError):
        model.HttpGenerator("http://h", "m", dialect="other")


def test_streaming(spark, tmp_path):
    folder = tmp_path / "in"
    rows = [(i, MARKUP.format(i=i) if i % 3 else "<p>no section</p>") for i in range(9)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(folder))
    pages = spark.readStream.schema("page_id long, html string").parquet(str(folder))
    out = streaming.context_stream(pages, "page_id", "html")
    q = out.writeStream.format("memory").queryName("contexts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("contexts").count() == 6
    pairs = spark.createDataFrame([("1", "p", "t", "q", "a", "We kept cell line 1 at 37 C")], "id string, pmcid string, type string, question string, answer string, span string")
    pairs.write.parquet(str(tmp_path / "pairs"))
    contexts = spark.createDataFrame([("p", "We kept cell line 1 at 37 C for days.")], "pmcid string, context string")
    s = state.StateStore(spark, str(tmp_path / "state"))
    stream = spark.readStream.schema(pairs.schema).parquet(str(tmp_path / "pairs"))
    streaming.guard_stream(spark, stream, contexts, s, str(tmp_path / "check")).awaitTermination()
    assert s.pairs().first().kept == 1


def test_cache_key_follows_the_store(spark, tmp_path):
    """A shard that changes makes a new key, under a path that only Spark's file systems understand."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shards.link./data", f"file://{tmp_path}")
    folder = "viewfs://shards/data/in"
    (tmp_path / "in").mkdir()
    shard = tmp_path / "in" / "a.jsonl"
    shard.write_text('{"text": "one"}\n')
    c = GOOD | {"data": {"corpus_dir": folder, "processed_dir": "p", "sequence_length": 8}}
    first = corpus.cache_key(spark, c, readers.shard_states(spark, folder))
    assert corpus.cache_key(spark, c, readers.shard_states(spark, folder)) == first
    shard.write_text('{"text": "one and more"}\n')
    assert corpus.cache_key(spark, c, readers.shard_states(spark, folder)) != first
    assert [r.text for r in readers.resolve_replay(spark, folder).collect()] == ["one and more"]


def test_whole_files(spark, tmp_path):
    for name, data in (("a b.xml", b"x\xffy"), ("[1]+%20.xml", b"brackets"), ("not wanted.xml", b"z")):
        (tmp_path / name).write_bytes(data)
    wanted = [("1", "a b.xml"), ("2", "[1]+%20.xml"), ("3", "missing.xml"), ("4", None), ("5", "a b.xml")]
    got = {r.pmcid: r.text for r in readers.read_whole_files(spark, str(tmp_path), wanted).collect()}
    assert got == {"1": "xy", "2": "brackets", "3": None, "4": None, "5": "xy"}
    assert readers.read_whole_files(spark, str(tmp_path), [("9", "no")]).collect()[0].text is None


def test_chat_replay(spark, tmp_path):
    (tmp_path / "chat.jsonl").write_text("\n".join([chat("a", "b"), "junk", chat("c", "d")]))
    got = sorted((r.pos, json.loads(r.payload)[0]["content"]) for r in readers.read_chat_replay(spark, str(tmp_path / "chat.jsonl")).collect())
    assert got == [(0, "a"), (1, "c")]


def test_state_is_compacted(spark, tmp_path):
    s = state.StateStore(spark, str(tmp_path), most_versions=3)
    for i in range(9):
        s.append("gen", spark.createDataFrame([(f"p{i % 4}", None, i, "t")], state.SCHEMAS["gen"]))
    assert len(s.versions("gen")) <= 4
    assert {(r.pmcid, r.ok) for r in s.read("gen").collect()} == {("p0", 8), ("p1", 5), ("p2", 6), ("p3", 7)}


def test_replies_are_told_as_they_come(monkeypatch):
    g = model.HttpGenerator("http://h", "m", concurrency=4)
    monkeypatch.setattr(g, "one", lambda p, *a: model.Reply(p.upper()))
    told = {}
    out = g.generate(["a", "b", "c"], "", 1, 0.0, done=lambda i, r: told.update({i: r.text}))
    assert [r.text for r in out] == ["A", "B", "C"] and told == {0: "A", 1: "B", 2: "C"}


def test_command_lines(spark, tmp_path, capsys):
    import yaml

    (tmp_path / "chat.jsonl").write_text("\n".join([chat("a", "b"), chat("c", "d")]))
    c = GOOD | {"data": {"train_file": str(tmp_path / "chat.jsonl")}}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(c))
    corpus.main(["--config", str(tmp_path / "c.yaml")])
    assert "kept=2 malformed=0 duplicate=0" in capsys.readouterr().out
    spark.createDataFrame([("a", "a", 1.0, 2, 0)], "prediction string, reference string, loss double, n_tokens long, pos long").write.parquet(str(tmp_path / "rows"))
    evaluate.main(["--config", str(tmp_path / "c.yaml"), "--rows", str(tmp_path / "rows")])
    assert json.loads(capsys.readouterr().out)["exact_match"] == 1.0


def test_public_names():
    import loomgrain

    assert all(getattr(loomgrain, n) is not None for n in loomgrain.__all__)
