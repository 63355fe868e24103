"""The opN queries over a whole small table: against DuckDB where SQL can say it, else against brute force."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomgrain.llm import oracles, registry, toxicity
from tests.compare import connect, oracle_rows, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_against_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, FOLDER)) == oracle_rows(duck, oracles.SQL[name])


def test_all_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]


def test_bpe(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op5_bpe"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_packing(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op10_packing"](spark, FOLDER).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == texts.keys()
    for doc, pieces in by.items():
        ids = np.array([*t.encode(texts[doc], add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length & (p.length - 1) == 0 and p.length <= 2048 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def remaining(texts, length=50):
    """(n_bytes, n_removed, n_spans, sha256) of each document by brute force."""
    first, out = {}, {}
    raw = {i: (t or "").encode() for i, t in texts.items()}
    for i in sorted(raw):
        for k in range(len(raw[i]) - length + 1):
            first.setdefault(raw[i][k : k + length], i)
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()
    return out


def test_suffix_dedup(spark, texts):
    rows = QUERIES["op7_suffix_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == remaining(texts)


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    scored = QUERIES["op4_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = scored.where("held_out").join(labels, "doc_id").join(docs, "doc_id").collect()
    assert scored.count() == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    caught = {lang: [r.predicted for r in rows if r.toxic and r.lang == lang] for lang in ("de", "en", "es", "fr")}
    recall = {lang: sum(x) / len(x) for lang, x in caught.items()}
    assert recall["en"] > 0.9 and min(recall.values()) > 0.8 and sum(map(sum, caught.values())) / sum(map(len, caught.values())) > 0.9
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(1 - r.toxic for r in rows)
    assert wrong < 0.02


def test_quality_held_out(spark):
    """Of labelled documents that the thresholds were not read off and that pass the base rules: poor ones go, good ones stay."""
    folder = "/root/testdata/sf0.1"
    held = spark.read.parquet(f"{folder}/labels.parquet").where(toxicity.training_fold(F.col("doc_id")) == 0)
    rows = QUERIES["op2_quality"](spark, folder).where("not base_failed").join(held, "doc_id")
    told = {r.quality: (r.n, r.kept) for r in rows.groupBy("quality").agg(F.count("*").alias("n"), F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert told[1][0] > 500 and told[1][1] > 0.99 and told[0][1] < 0.2


def test_url_filter(spark):
    rows = QUERIES["op8_url_filter"](spark, FOLDER).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        after = urls[r.page_id].split("://", 1)[1]
        end = min([after.find(c) for c in "/?#" if c in after] or [len(after)])
        host = after[:end].lower()
        path = after[end:].split("?")[0].split("#")[0]
        fits = [x for x in registry.URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.host + x.path), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best.host + best.path)
        assert r.verdict == best.verdict if best else r.verdict in ("allow", "block")


def test_tables_with_extra_columns_and_many_partitions(spark, tmp_path):
    for t in ("documents", "pages", "embeddings", "labels"):
        df = spark.read.parquet(f"{FOLDER}/{t}.parquet").repartition(9)
        df.withColumns({c: F.lit(1) for c in ("text2", "host", "kept", "anchor", "copy", "rep", "score", "h1", "n")}).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).count() == query(spark, FOLDER).count(), name


def test_empty_tables(spark, tmp_path):
    for t in ("documents", "pages", "embeddings", "labels"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
