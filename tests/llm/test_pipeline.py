"""Every stage of the pipeline against a brute-force version on its own input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomgrain.llm import near_dup, toxicity
from tests.llm.test_edges import components, library
from tests.llm.test_queries import FOLDER

COLUMNS = ["doc_id", "lang", "n_chars", "source", "text"]


def rows_of(df):
    assert sorted(df.columns) == COLUMNS
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input, output) frames of each stage by name."""
    out, docs = {}, spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        result = spark.read.parquet(path)
        out[name] = docs, result
        docs = result
    return out


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    given = sorted(rows_of(before).values(), key=lambda r: r.doc_id)
    clean = {r.doc_id for r, s in zip(given, model.scores([r.text for r in given]), strict=True) if s < 0.5}
    assert rows_of(after).keys() == clean and len(clean) < len(given)


def has_word(text):
    return bool((text or "").encode().split())


def test_line_stage(stages):
    before, after = (rows_of(x) for x in stages["line_dedup"])
    seen, wanted = set(), {}
    for i in sorted(before):
        lines = before[i].text.split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if w in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        text = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        if not gone or has_word(text):
            wanted[i] = text
    assert {i: r.text for i, r in after.items()} == wanted
    assert all(r.n_chars == len(r.text) and r.lang == before[i].lang for i, r in after.items())


def test_near_dup_stage(stages):
    before, after = (rows_of(x) for x in stages["near_dup"])
    found = components({i: r.text for i, r in before.items()}, 5, 80)
    assert after.keys() == {i for i, (_, c) in found.items() if c == i}
    assert all(after[i] == before[i] for i in after)


def test_suffix_stage(stages):
    before, after = (rows_of(x) for x in stages["suffix_dedup"])
    first, wanted = {}, {}
    raw = {i: r.text.encode() for i, r in before.items()}
    for i in sorted(raw):
        for k in range(len(raw[i]) - 49):
            first.setdefault(raw[i][k : k + 50], i)
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        text, at = "", 0
        for ch in before[i].text:
            n = len(ch.encode())
            text += "" if any(gone[at : at + n]) else ch
            at += n
        if not any(gone) or has_word(text):
            wanted[i] = text
    assert {i: r.text for i, r in after.items()} == wanted
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_packing_stage(stages):
    before, after = stages["packing"]
    found = {}
    for r in sorted(after.collect(), key=lambda r: (r.doc_id, r.start)):
        found.setdefault(r.doc_id, []).append(r)
    for i, r in rows_of(before).items():
        ids = np.array([*library().encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        assert b"".join(bytes(p.ids) for p in found.pop(i)) == ids.tobytes()
    assert not found


def test_run_and_registry(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    summed = corpus_pipeline.queries()["pipeline"](spark, FOLDER)
    assert out.agg(F.sum("length")).first() == summed.agg(F.sum("length")).first()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dup", "suffix_dedup", "packing"]


def test_odd_rows(spark, tmp_path):
    """Null and empty texts, null and repeated ids, extra columns of clashing names, long texts: every stage keeps to its docstring."""
    lines = "line one of it\nline two of it\nline three of it"
    same = "these are some words of a text that comes back later on in just the same form as before " * 2
    rows = [(1, None), (2, ""), (3, lines + "\nown"), (3, lines + "\nown"), (None, lines + "\nno id"), (4, same), (5, same), (None, same), (6, "word " * 100_000), (7, "a\n\n\n\n")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int, copy int, score int")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert sorted(out.columns) == COLUMNS
        got = [(r.doc_id, r.text) for r in out.collect()]
        assert (1, None) in got and (2, "") in got, name
        assert [i for i, _ in got].count(3) == 2 and [i for i, _ in got].count(None) == 2, name
        assert (5 in [i for i, _ in got]) == (name not in ("near_dup", "suffix_dedup")), name
    pieces = corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces) and {p.doc_tokens for p in pieces if p.doc_id in (1, 2)} == {1}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name


def test_near_copies_found(spark):
    """Of pairs of documents at a similarity of 0.8 or more by five words, found by comparing all of them, all are linked."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, width=5).collect()}
    sets = {i: near_dup.shingle_set(t, 5) for i, t in texts.items()}
    owners = {}
    for i, s in sets.items():
        for x in s.tolist():
            owners.setdefault(x, []).append(i)
    pairs = {(a, b) for o in owners.values() if 1 < len(o) < 200 for k, a in enumerate(o) for b in o[k + 1 :]}
    linked = [(a, b) for a, b in pairs if 100 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    assert len(linked) > 50 and sum(found[a] == found[b] for a, b in linked) >= 0.999 * len(linked)
