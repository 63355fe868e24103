"""Nulls, empty and long texts, ties and repeated rows: each operator's defined results."""

import gzip
import random
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomgrain.llm import bpe, line_dedup, near_dup, packing, quality, suffix_dedup, topk, toxicity, url_filter, warc
from loomgrain.session import Scratch
from tests.llm.test_queries import remaining

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, start=0):
    rows = [(None if i < 0 else i, t, None, None, None) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts, start))]
    return spark.createDataFrame(rows, DOC)


LONG = "many words of one very long text " * 40_000
ODD = [None, "", " \n\t ", "one", LONG, "same text here\nand there\nand so on\nend", "same text here\nand there\nand so on\nend", "\n\n\n\n\n\n"]


def test_line_dedup(spark):
    d = docs(spark, [*ODD, "a\na\na\na\na", "x\nsame text here\nand there\nand so on\ny"]).withColumn("lines", F.lit(7))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(d, counts=True).collect()}
    assert got[0].text is None and got[0].n_lines == 0 and got[4].text == LONG
    assert got[5].n_removed == 0 and got[6].text == "" and got[6].n_removed == 4
    assert (got[7].text, got[7].n_removed, got[7].n_lines) == ("", 6, 7)
    assert got[8].text == "a" and got[9].text == "x\ny" and got[9].lines == 7
    twice = d.unionByName(d.where("doc_id = 5"))
    assert {r.text for r in line_dedup.dedup_lines(twice).where("doc_id = 5").collect()} == {ODD[5]}
    # rows of one id, or of none, with texts of their own: only what repeats goes
    mixed = docs(spark, {1: "a\nb\nc\nown", -1: "a\nb\nc\nno id"}).unionByName(docs(spark, {1: "other\nlines\nhere\na\nb\nc"}))
    assert {r.text for r in line_dedup.dedup_lines(mixed).collect()} == {"a\nb\nc\nno id", "own", "other\nlines\nhere"}


def test_quality(spark):
    got = {r.doc_id: r for r in quality.judge_quality(docs(spark, ODD)).collect()}
    assert all(got[i].n_words == 0 and got[i].base_failed and not got[i].kept for i in (0, 1, 2, 7))
    assert got[4].n_words == 280_000 and got[4].n_repeat_words == 280_000 and got[4].base_failed
    assert got[5].n_words == 9 and got[5].word_chars == 30
    assert quality.judge_quality(docs(spark, [ODD[5]] * 3).withColumn("doc_id", F.lit(1).cast("long"))).count() == 3


def test_quality_unknown_languages(spark):
    text = "some words of a text that is long enough to count for something " * 20
    rows = [(i, text, lang, None, None) for i, lang in enumerate(["en", None, "", "xx", "und", "en"])] + [(9, None, None, None, None)]
    got = {r.doc_id: r for r in quality.judge_quality(spark.createDataFrame(rows, DOC), most_languages=2).collect()}
    assert len(got) == 7 and not got[9].kept and all(got[i].word_distance is not None and got[i].word_distance < 1e-6 for i in range(6))
    # the words that most documents have, ties by word
    few = spark.createDataFrame([(i, t, "en", None, None) for i, t in enumerate(["b a a a", "b c", "c d d"])], DOC)
    assert quality.common_words(few, ["en"], 3) == {"en": ["b", "c", "a"]}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_topk_edges(spark):
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (3, None, 1), (4, [float("nan"), 1.0], 1), (5, [None, 1.0], 1), (None, [1.0, 1.0], 1), (6, [float("inf"), 0.0], 1), (7, [0.5], 1), (100, [], 1), (200, [1e30, 1.0], 1)]
    v = vectors(spark, rows)
    got = topk.top_k(v, v.where("vec_id % 100 = 0"), k=2).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 0] == [(1, 200), (2, 1)]
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 100] == [(0, 0), (1, 0)]
    assert {r.query_id for r in got} == {0, 100, 200}
    assert topk.top_k(v.unionByName(v), v, k=3).where("query_id = 0").count() == 3


def test_topk_brute_force(spark):
    r = np.random.default_rng(1)
    data = r.normal(size=(3000, 6)).astype(np.float32)
    data[::50] = data[0]
    v = vectors(spark, [(int(i), [float(x) for x in row], 0) for i, row in enumerate(data)])
    got = topk.top_k(v, v.where("vec_id % 100 = 0"), k=10, block_bytes=64 * 48, shard_bytes=512 * 48, group_bytes=1 << 9).collect()
    whole = np.floor(1024 * data.astype(np.float64)).astype(np.int64)
    for q in range(0, 3000, 100):
        s = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(3000), -s)) if i != q][:10]
        assert [(x.rank, x.vec_id, x.score) for x in sorted(got, key=lambda x: x.rank) if x.query_id == q] == [(k + 1, i, s[i]) for k, i in enumerate(order)]


def scored_share(data, queries, k=10, block_rows=64):
    """Share of (query, candidate) pairs that block-at-a-time search scores, and whether the result is right."""
    order = np.argsort(topk.AxisTree(data[:4096]).leaves(data.astype(float)), kind="stable")
    cuts = [order[i : i + block_rows] for i in range(0, len(data), block_rows)]
    blocks, scored = [(c, data[c]) for c in cuts], []
    tops, lows = np.array([data[c].max(0) for c in cuts]), np.array([data[c].min(0) for c in cuts])
    floor = topk._floors(queries, data[queries], np.arange(min(4096, len(data))), data[:4096], k)
    at, ids, scores = topk.block_topk(queries, data[queries], blocks, tops, lows, k, floor, scored)
    for i, q in enumerate(queries):
        s = (data @ data[q]).astype(float)
        s[q] = -np.inf
        assert ids[at == i].tolist() == np.lexsort((np.arange(len(data)), -s))[:k].tolist()
    return sum(scored) / (len(queries) * len(data))


def test_topk_bounds_prune():
    """Vectors around centres: most blocks are never scored. Without structure next to all are."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(60, 32)) * 800
    data = np.floor(centres[r.integers(0, 60, 12_000)] + r.normal(size=(12_000, 32)) * 40).astype(np.int64)
    assert scored_share(data, np.arange(0, 12_000, 400)) < 0.1


def test_topk_wide_and_repeated(spark):
    r = np.random.default_rng(5)
    data = r.normal(size=(400, 1024)).astype(np.float32)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(data)] + [(7, data[7].tolist(), 0)] * 500
    v = vectors(spark, rows)
    got = topk.top_k(v, v.where("vec_id % 100 = 0"), k=3, shard_bytes=1 << 20, group_bytes=1 << 14).collect()
    whole = np.floor(1024 * data.astype(np.float64)).astype(np.int64)
    for q in range(0, 400, 100):
        best = sorted(((-int(whole[q] @ whole[i]), i) for i in [*range(400), *[7] * 500] if i != q))[:3]
        assert [(-x.score, x.vec_id) for x in sorted(got, key=lambda x: x.rank) if x.query_id == q] == best


def test_toxicity_edges(spark):
    bad, good = "you are a worthless fool and a scoundrel", "the river runs along the quiet green valley"
    texts = {i: (bad if i % 2 else good) + f" in part {i}" for i in range(300)}
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in texts] + [(None, 1, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    d = docs(spark, texts)
    model = toxicity.fit(d, labels)
    odd = docs(spark, {1000 + i: t for i, t in enumerate([*ODD, "a worthless fool", "q" * 100_000])}).withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in toxicity.score_documents(d.withColumn("score", F.lit("clash")).unionByName(odd), model).collect()}
    assert all(got[i].predicted == i % 2 for i in texts) and got[1008].predicted == 1
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == 310
    empty = toxicity.fit(d, labels.limit(0))
    assert {r.predicted for r in toxicity.score_documents(d, empty).collect()} == {0}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\tabé'sd12!.,日👍\u3000\x85<|>endoftx")), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_bpe_like_library(text):
    t = library()
    for s in (text, text + "<|endoftext|>" + text):
        ids = t.encode(s, add_special_tokens=False).ids
        for encode in (ENCODER.encode, packing.whole_text_ids(PATH)):
            assert list(memoryview(encode(s)).cast("I")) == ids
        assert ENCODER.vocab.decode(ids) == t.decode(ids, skip_special_tokens=False)


def library(held=[]):  # noqa: B006
    if not held:
        held.append(Tokenizer.from_file(PATH))
    return held[0]


LEXICON = bpe.compile_lexicon({w.encode(): bpe.vocabulary(PATH).merge(w.encode()) for w in (" a", "a", " and", " ands", "é", "ing", " endoftext")})
ENCODER = bpe.Encoder(bpe.vocabulary(PATH), bpe.mapped(LEXICON), held=60)


def test_lexicon():
    words = ["tap", "taps", "top", "tops", "stop", "stops", ""]
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w.encode(): [i, i + 1] for i, w in enumerate(words)}))
    assert [list(lexicon.get(w.encode())) for w in words] == [[i, i + 1] for i in range(len(words))]
    assert all(lexicon.get(w) is None for w in (b"t", b"tapss", b"x", b"sto"))
    assert lexicon.states < sum(map(len, words))
    assert bpe.Lexicon(bpe.compile_lexicon({})).get(b"a") is None


def test_bpe_tables(spark):
    d = docs(spark, ODD)
    t = library()
    encoded = bpe.encode_documents(d, PATH, bpe.build_lexicon(d, PATH))
    got = {r.doc_id: bytes(r.ids) for r in encoded.collect()}
    assert got == {i: np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for i, x in enumerate(ODD)}
    assert {r.doc_id: r.text for r in bpe.decode_documents(encoded, PATH).collect()} == {i: x or "" for i, x in enumerate(ODD)}


def test_repeated_rows_are_encoded_and_packed_each(spark):
    d = docs(spark, {1: "some text", 2: "some text"}).unionByName(docs(spark, {1: "some text", -1: None}))
    rows = bpe.encode_documents(d, PATH, bpe.build_lexicon(d, PATH), digest=True).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 0), (1, 2), (1, 2), (2, 2)] and len({r.ids_sha256 for r in rows}) == 2
    pieces = packing.pack_documents(d, PATH).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces) == 7 and sum(p.length for p in pieces) == 10


def test_packing_edges(spark):
    assert packing.lengths_of(0, 8) == [] and packing.lengths_of(29, 8) == [8, 8, 8, 4, 1]
    got = packing.pack_documents(docs(spark, [None, "", "a b c d e"]).unionByName(docs(spark, {-1: "x"})), PATH, max_length=2).collect()
    assert [(r.doc_id, r.start, r.length) for r in got if r.doc_id in (0, 1)] == [(0, 0, 1), (1, 0, 1)]
    assert sum(r.length for r in got if r.doc_id == 2) == 6 and sum(r.length for r in got if r.doc_id is None) == 2
    with pytest.raises(ValueError):
        packing.pack_documents(docs(spark, []), PATH, max_length=3)


def components(texts, width, percent):
    """Smallest reachable doc_id by brute force over word shingles."""
    table = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().translate(table).split()
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and root[a] < root[b]:
                    root[b], changed = root[a], True
    return {i: (len(sets[i]), root[i]) for i in texts}


def test_near_dup_brute_force(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [r.choice(words) for _ in range(60)]
    texts = {}
    for i in range(90):
        t = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 4, 5, 7])):
            t[r.randrange(len(t))] = r.choice(words)
        texts[i] = " ".join(t)
    texts |= {90 + i: t for i, t in enumerate([*ODD, "ONE", "one two", "One TWO"])}
    texts |= {200 + i: " ".join(r.choice(words) for _ in range(r.randrange(1, 50))) for i in range(40)}
    got = near_dup.near_duplicates(docs(spark, texts).withColumn("component_id", F.lit("clash")), width=2)
    found = {x.doc_id: (x.n_shingles, x.component_id) for x in got.collect()}
    assert found == components(texts, 2, 80)
    assert {x.doc_id: x.kept for x in got.collect()} == {i: c == i for i, (_, c) in found.items()}


def test_near_dup_repeated_and_null_ids(spark):
    d = docs(spark, {3: "a b c d", 5: "a b c d"}).unionByName(docs(spark, {3: "a b c d", -1: "a b c d"})).unionByName(docs(spark, {3: "other words entirely here"}))
    got = [(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(d, width=2).collect()]
    assert sorted(got, key=str) == sorted([(3, 3, True)] * 3 + [(5, 3, False), (None, None, True)], key=str)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 49), st.randoms())
def test_signature_index_guarantee(errors, r):
    index = near_dup.ChunkIndex(128, 49, 1)
    a = np.array([r.randrange(65536) for _ in range(128)], np.uint16)
    b = a.copy()
    for i in r.sample(range(128), errors):
        b[i] ^= 1
    e = index.entries(np.stack([a, b]))
    assert (e[0] == e[1]).any()


def test_suffix_dedup_brute_force(spark):
    r = random.Random(9)
    pool = ["".join(r.choice("abé ") for _ in range(r.randrange(20, 200))) for _ in range(12)]
    texts = {i: "".join(r.choice(pool) for _ in range(r.randrange(0, 6))) for i in range(60)}
    texts |= {60: None, 61: "", 62: "x" * 49, 63: "x" * 50, 64: "x" * 51, 65: "x" * 500, 66: pool[0] * 20, 67: texts[3], 68: texts[3] + "z"}
    for chunk in (300, 1 << 20):
        got = suffix_dedup.remove_repeats(docs(spark, texts).withColumn("chunk", F.lit("clash")), chunk_bytes=chunk).collect()
        mine = {x.doc_id: (x.n_bytes, x.n_bytes - len(x.kept or b""), len(x.spans) // 2) for x in got}
        assert mine == {i: v[:3] for i, v in remaining(texts).items()}
        for x in got:
            raw, left, at = (texts[x.doc_id] or "").encode(), b"", 0
            for a, b in zip(x.spans[::2], x.spans[1::2], strict=True):
                left, at = left + raw[at:a], b
            assert left + raw[at:] == bytes(x.kept or b"")


def test_suffix_dedup_does_not_trust_hashes(monkeypatch):
    """Stretches whose hashes all collide are still told apart by their bytes; so are strings of one anchor."""
    made = suffix_dedup.Stretches.__init__

    def collide(self, *args):
        made(self, *args)
        self.content = np.zeros_like(self.content)
        self.anchor = np.zeros_like(self.anchor)

    monkeypatch.setattr(suffix_dedup.Stretches, "__init__", collide)
    r = random.Random(4)
    pool = ["".join(r.choice("ab ") for _ in range(60)) for _ in range(5)]
    texts = ["".join(r.choice(pool) for _ in range(4)) for _ in range(20)]
    rows = pd.DataFrame({"doc_id": range(20), "h1": 0, "h2": 0, "text": texts, "copy": False})
    c = suffix_dedup.Chunk(suffix_dedup._gathered(rows), 50, 25)
    raw = [c.raw[a:b] for a, b in zip(c.lo, c.hi, strict=True)]
    assert all(raw[i] == raw[c.first[n]] for i, n in enumerate(c.number))
    at = sorted(range(len(c.first)), key=lambda n: raw[c.first[n]])
    columns = [[0] * len(at), [raw[c.first[n]] for n in at], [int(c.ids[c.row[c.first[n]]]) for n in at], [7] * len(at), at]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["anchor", "bytes", "doc", "chunk", "number"])
    told = {n: v for b in suffix_dedup._answer(50)(iter([batch])) for n, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)}
    first = {}
    for i in range(20):
        for k in range(len(texts[i]) - 49):
            first.setdefault(texts[i][k : k + 50].encode(), i)
    for n, f in enumerate(c.first):
        wanted = [first[raw[f][k : k + 50]] for k in range(len(raw[f]) - 49)]
        own = int(c.ids[c.row[f]])
        assert (n in told) == (min(wanted) < own)
        if n in told:
            found = np.frombuffer(told[n], np.int64).tolist()
            assert (found * len(wanted) if len(found) == 1 else found) == wanted


def test_suffix_dedup_repeated_ids_and_copies(spark):
    """A row that shares its doc_id with a copy, but not its text, keeps what is its own."""
    a, b = "first text " * 9, "another text altogether " * 5
    d = docs(spark, {1: a, 2: a}).unionByName(docs(spark, {2: b}))
    got = sorted((x.doc_id, bytes(x.kept).decode()) for x in suffix_dedup.remove_repeats(d).collect())
    assert got == [(1, a), (2, ""), (2, b)]


def test_suffix_dedup_long_null_and_whole_characters(spark):
    passage = "é" * 40
    d = docs(spark, {1: "A" + passage, 2: passage + "B", -1: passage}).unionByName(docs(spark, {2: passage + "B"}))
    got = suffix_dedup.remove_repeats(d, carry=["lang"], whole_characters=True).collect()
    assert sorted((x.doc_id or 0, bytes(x.kept).decode()) for x in got) == [(0, passage), (1, "A" + passage), (2, "B"), (2, "B")]
    s = {7: LONG * 8 + "end", 8: "start" + LONG}
    got = {x.doc_id: x for x in suffix_dedup.remove_repeats(docs(spark, s)).collect()}
    assert len(got[7].kept) == len(s[7]) and bytes(got[8].kept) == b"start"


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM", "http://a.com/en/x?y#z", "http://com/en/", "http://xcom/en/", "http://é.net/de/ü", "http://a.net?q=/de/", "x://a.org:80/es/", "http://q.net/zz/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = [url_filter.Rule("block", "com", "/en/"), url_filter.Rule("allow", "net", "/de/"), url_filter.Rule("block", "a.com", "/en/x")]
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.filter_urls(pages, rules).collect()}
    assert [got[i] for i in range(12)] == [
        ("", "", None), ("", "", None), ("", "", None), ("", "", None), ("www.example.com", "", None), ("a.com", "/en/x", "a.com/en/x"),
        ("com", "/en/", "com/en/"), ("xcom", "/en/", None), ("é.net", "/de/ü", "net/de/"), ("a.net", "", None), ("a.org:80", "/es/", None), ("q.net", "/zz/1", None),
    ]
    assert {r.verdict for r in url_filter.filter_urls(pages.where("page_id < 4"), rules).collect()} == {"allow"}


def test_url_model_on_held_out(spark):
    r = random.Random(2)
    rows = [(i, f"http://{r.choice(['pills', 'casino', 'win'])}{r.randrange(99)}.bad.com/en/{r.randrange(999)}" if i % 2 else f"http://{r.choice(['school', 'museum', 'library'])}{r.randrange(99)}.net/de/{r.randrange(999)}") for i in range(600)]
    rows += [(1000 + i, u) for i, u in enumerate(["http://casino7.info/x/1", "http://museum3.org/9", "http://pills1.info/x/9", "http://library5.org/2"])]
    rows += [(2000, None), (2001, "nothing"), (2002, "http://")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = [url_filter.Rule("block", "com", "/en/"), url_filter.Rule("allow", "net", "/de/")]
    got = {x.page_id: x for x in url_filter.filter_urls(pages, rules).where("rule is null").collect()}
    assert min(got[1000].score, got[1002].score) > max(got[1001].score, got[1003].score)
    assert [got[1000 + i].verdict for i in range(4)] == ["block", "allow", "block", "allow"]
    assert all((got[i].verdict, got[i].score) == ("allow", 0.0) for i in (2000, 2001, 2002))


def witten_bell(texts, order):
    """Chance of a letter after a context by brute force over (text, n) of one class; alphabet is the size over all classes."""
    seen = {}
    for text, n in texts:
        for part in text.split("\n"):
            for i in range(len(part)):
                for k in range(min(order, i) + 1):
                    after = seen.setdefault(part[i - k : i], {})
                    after[part[i]] = after.get(part[i], 0) + n

    def chance(letter, context, alphabet):
        p = 1 / (alphabet + 1)
        for k in range(len(context) + 1):
            after = seen.get(context[len(context) - k :])
            if after:
                p = (after.get(letter, 0) + len(after) * p) / (sum(after.values()) + len(after))
        return p

    return chance


def test_url_model_brute_force(spark):
    """Masked texts, counts, Witten-Bell chances that add up to 1, scores, cut and verdicts."""
    r = random.Random(11)
    hosts, parts = ["aba", "bab", "abc", "cab"], ["x1", "y2", "xy", "zz"]
    urls = [f"http://{r.choice(hosts)}.{r.choice(['s.com', 't.net', 'u.org'])}/{r.choice(['en', 'de'])}/{r.choice(parts)}{r.randrange(30)}" for _ in range(500)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [url_filter.Rule("block", "com", "/en/"), url_filter.Rule("allow", "net", "/de/")]
    order, got = 3, url_filter.filter_urls(pages, rules, order=3, max_false_block=0.1).collect()
    train, held, alphabet = {"allow": [], "block": []}, [], set()
    for u in urls:
        host, path = u[7:].split("/", 1)
        for rule in rules:
            if host.endswith("." + rule.host) and ("/" + path).startswith(rule.path):
                text = host[: -len(rule.host)] + "\n" + path[3:]
                if zlib.crc32(text.encode()) % 5:
                    train[rule.verdict].append((text, 1))
                    alphabet |= set(text) - {"\n"}
                elif rule.verdict == "allow":
                    held.append(text)
    good, bad = (witten_bell(train[v], order) for v in ("allow", "block"))
    for model in (good, bad):
        assert abs(sum(model(x, "ab", len(alphabet)) for x in [*alphabet, "?"]) - 1) < 1e-12

    def score(text):
        logs = [np.log(bad(p[i], p[max(0, i - order) : i], len(alphabet)) / good(p[i], p[max(0, i - order) : i], len(alphabet))) for p in text.split("\n") for i in range(len(p))]
        return sum(logs) / len(logs)

    scores = sorted(score(t) for t in held)
    for x in got:
        if x.rule is None:
            assert abs(x.score - score(x.host + "\n" + x.path)) < 1e-9
            above = sum(s > x.score for s in scores)
            if x.verdict == "block":
                assert above <= 0.1 * len(scores)
            else:
                assert sum(s >= x.score - (scores[-1] - scores[0]) / 4096 for s in scores) > 0.1 * len(scores)


def test_warc_roundtrip(spark, tmp_path):
    long = "long payload " * 100
    rows = [(1, "http://a/b c\r\nx", "short"), (2, None, None), (3, "http://a/1", long), (4, "http://a/2", long), (5, "u", long), (6, "http://a/3#f", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 40), (5, "u", long), (None, "http://n", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    for compression in ("none", "gzip"):
        path = f"{tmp_path}/{compression}"
        warc.write_archive(pages, path, compression=compression, file_bytes=4000)
        records = warc.read_archive(spark, path).cache()
        assert records.groupBy("record_type").count().where("record_type in ('request', 'metadata') and count = 8").count() == 2
        got = warc.assemble(records).collect()
        assert len(got) == 8 and all(len(r.requests) == 1 and len(r.metadata) == 1 for r in got)
        bodies = sorted(bytes(r.payload).decode() for r in got if r.record_type == "response")
        assert bodies == sorted(["short", "", long, long, rows[5][2], "x"])
        assert sum(r.record_type == "revisit" for r in got) == 2
        assert {r.refers_to for r in got if r.record_type == "revisit"} <= {r.record_id for r in got}


def test_warc_links_in_both_directions_and_damage(spark):
    def record(kind, rid, block, to=None, extra=""):
        to = f"WARC-Concurrent-To: {to}\r\n" if to else ""
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n{to}{extra}Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n".encode()

    data = (
        b"junk" + record("response", "<r>", "body", to="<q>") + record("request", "<q>", "get") + record("metadata", "<m>", "note", to="<q>")
        + record("metadata", "<o>", "orphan", to="<gone>") + b"WARC/1.0\r\nContent-Length: x\r\n\r\n" + record("response", "<s>", "b2", extra="X: a\r\n b\r\n")
        + b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\ncut"
    )
    rows = list(warc.parse_records([data]))
    for step in (1, 7, 50):
        assert list(warc.parse_records(data[i : i + step] for i in range(0, len(data), step))) == rows
    assert [r[0] for r in rows] == ["<r>", "<q>", "<m>", "<o>", "<s>"] and rows[4][7]["x"] == "a b"
    schema = warc._RECORD
    got = {r.capture_id: r for r in warc.assemble(spark.createDataFrame(rows, schema)).collect()}
    assert [x.record_id for x in got["<r>"].requests] == ["<q>"] and [x.record_id for x in got["<r>"].metadata] == ["<m>"]
    assert got["<s>"].requests == [] and got["<gone>"].record_id is None and [x.record_id for x in got["<gone>"].metadata] == ["<o>"]


def warc_record(kind, rid, block=b"x", to=()):
    links = "".join(f"WARC-Concurrent-To: {t}\r\n" for t in to)
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n{links}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_warc_chains_and_repeated_links(spark):
    data = (
        warc_record("response", "<a>") + warc_record("response", "<b>") + warc_record("request", "<1>", to=["<a>"]) + warc_record("metadata", "<2>", to=["<1>"])
        + warc_record("metadata", "<3>", to=["<2>"]) + warc_record("metadata", "<4>", to=["<3>", "<none>"]) + warc_record("metadata", "<5>", to=["<b>", "<a>"])
        + warc_record("request", "<6>", to=["<5>", "<7>"]) + warc_record("metadata", "<7>") + warc_record("metadata", "<8>", to=["<9>"]) + warc_record("metadata", "<9>", to=["<8>"])
    )
    rows = list(warc.parse_records([data]))
    assert rows[6][2] == ["<b>", "<a>"] and rows[0][2] is None
    got = {r.capture_id: (sorted(x.record_id for x in r.requests), sorted(x.record_id for x in r.metadata)) for r in warc.assemble(spark.createDataFrame(rows, warc._RECORD)).collect()}
    assert got["<a>"] == (["<1>", "<6>"], ["<2>", "<3>", "<4>", "<5>", "<7>"]) and got["<b>"] == ([], [])
    assert sorted(x for c, v in got.items() if c not in ("<a>", "<b>") for x in v[1]) == ["<8>", "<9>"]


def test_warc_members_and_damage():
    """Many gzip members in linear time; a damaged member loses its own records only."""
    parts = [gzip.compress(warc_record("response", f"<{i}>", b"payload %d" % i)) for i in range(20_000)]
    began = time.time()
    assert [r[0] for r in warc.parse_records(warc._pieces(b"".join(parts)))] == [f"<{i}>" for i in range(20_000)]
    assert time.time() - began < 20
    bad = bytearray(parts[1])
    bad[20] ^= 0xFF
    bad[25] ^= 0xFF
    found = [r[0] for r in warc.parse_records(warc._pieces(parts[0] + bytes(bad) + parts[2] + b"junk" + parts[3] + parts[4][:-9]))]
    assert found[0] == "<0>" and {"<2>", "<3>"} <= set(found)


def test_toxicity_keeps_every_gram(spark):
    """More distinct n-grams than the model once kept (400,000), each with its count."""
    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(r.choice(letters) for _ in range(12)) for _ in range(45_000)]
    rows = spark.createDataFrame([(" ".join(words[k::50]), k % 2, k % 3 == 0) for k in range(50)], "text string, toxic int, held boolean")
    wanted = [set(), set()]
    for i, w in enumerate(words):
        padded = " " * 5 + w + "\n"
        wanted[i % 50 % 2] |= {padded[j : j + 6] for j in range(len(w) + 1)}
    counts = toxicity.gram_counts(rows, 6).cache()
    assert counts.count() == len(wanted[0] | wanted[1]) > 400_000
    assert [counts.where(f"{c} > 0").count() for c in ("ordinary", "toxic")] == [len(x) for x in wanted]
    told = counts.agg(*[F.sum(c).alias(c) for c in counts.columns[1:]]).first()
    assert told.toxic + told.ordinary == 45_000 * 13 and told.held_toxic + told.held_ordinary == 13 * sum(len(words[k::50]) for k in range(0, 50, 3))


class PlainKneserNey:
    """Both classes' chances by brute force over word counts: counts less the floor, the rest to one interpolated model of both."""

    def __init__(self, words, order, floor):
        self.order, self.floor = order, floor
        self.own = [Counter(), Counter()]
        for k, counted in enumerate(words):
            for w, n in counted.items():
                padded = " " * (order - 1) + w + "\n"
                for i in range(len(w) + 1):
                    self.own[k][padded[i : i + order]] += n
        self.levels = {order: self.own[0] + self.own[1]}
        for n in range(order - 1, 0, -1):
            self.levels[n] = Counter(g[1:] for g in self.levels[n + 1])
        self.after = {n: self.by_context(x) for n, x in self.levels.items()}
        self.own_after = [self.by_context(x) for x in self.own]

    @staticmethod
    def by_context(counts):
        out = {}
        for g, n in counts.items():
            out.setdefault(g[:-1], []).append(n)
        return out

    def shared(self, gram):
        p = 1 / (len(self.levels[1]) + 1)
        for n in range(1, self.order + 1):
            g = gram[-n:]
            seen = self.after[n].get(g[:-1])
            if seen:
                values = list(self.levels[n].values())
                ones, twos = values.count(1), values.count(2)
                d = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))
                p = (max(self.levels[n][g] - d, 0) + d * len(seen) * p) / sum(seen)
        return p

    def chance(self, k, gram):
        seen, q = self.own_after[k].get(gram[:-1]), self.shared(gram)
        return (max(self.own[k][gram] - self.floor, 0) + sum(min(n, self.floor) for n in seen) * q) / sum(seen) if seen else q

    def difference(self, word):
        padded = " " * (self.order - 1) + word + "\n"
        grams = [padded[i : i + self.order] for i in range(len(word) + 1)]
        return sum(np.log(self.chance(0, g) / self.chance(1, g)) for g in grams)


def test_toxicity_model_brute_force(spark):
    """Chances add up to 1, every word's difference is the brute force's, and the screen lets every word over the noise through."""
    r = random.Random(8)
    syllables = ["ba", "lo", "ñi", "ch", "er", "日本", "x9", "-"]
    word = lambda bad: ("scum" if bad and r.random() < 0.3 else "") + "".join(r.choice(syllables) for _ in range(r.randrange(1, 4)))
    texts = [(" ".join(word(i % 4 == 0) for _ in range(30)), int(i % 4 == 0), False) for i in range(120)]
    counts = toxicity.gram_counts(spark.createDataFrame(texts, "text string, toxic int, held boolean"), 4).select("key", "toxic", "ordinary")
    model = toxicity.KneserNey(counts.cache(), 4, 2, Scratch(spark, "test"))
    plain = PlainKneserNey([Counter(w for t, k, _ in texts if k == c for w in toxicity.words_in(t)) for c in (1, 0)], 4, 2)
    for k in (0, 1):
        for context in ("   ", "  s", "scu", "ch日", "zzz", "ba\n"):
            alphabet = [g for g in plain.levels[1]] + ["?"]
            assert abs(sum(plain.chance(k, context + x) for x in alphabet) - 1) < 1e-9
    words = sorted({w for t, *_ in texts for w in toxicity.words_in(t)} | {"scumbag", "unseen", "日", "scum" * 10, "?"})
    asked = spark.createDataFrame([(w,) for w in words], "word string")
    got = {x.word: x.units / toxicity._UNIT for x in model.differences(asked).collect()}
    for w in words:
        assert abs(got.get(w, 0.0) - plain.difference(w)) < 1e-6, w
    likely = dict(zip(words, toxicity.likely_words(words, toxicity.Bounds(model), 1.0), strict=True))
    over = [w for w in words if plain.difference(w) > 1.0]
    assert over and all(likely[w] for w in over) and sum(likely.values()) < len(words)


def test_url_model_keeps_every_gram(spark):
    """More n-grams than the model once kept (300,000): a text of one seen context still scores by it."""
    r = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(r.choice(letters) for _ in range(24))
    rows = [(i, f"http://{word()}.com/en/" if i % 2 else f"http://{word()}.net/de/") for i in range(8000)]
    seen = next(u for _, u in rows if u.endswith("/de/") and zlib.crc32(u[7:].encode()) % 5)
    rows.append((9000, f"http://{seen[7:31]}.org/x"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = [url_filter.Rule("block", "com", "/en/"), url_filter.Rule("allow", "net", "/de/")]
    got = url_filter.filter_urls(pages, rules).where("page_id = 9000").first()
    assert got.verdict == "allow" and got.score < -0.5
