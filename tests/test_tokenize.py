import os
import random
import threading
from collections import Counter

import psutil
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, normalizers, pre_tokenizers

from loomgrain import catalog
from loomgrain.functions import tokenize
from loomgrain.functions.tokenize import PORTION, library_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(texts):
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


class PeakRise:
    """MB by which the Python worker that grows most grows while the block runs."""

    def __enter__(self):
        self.mb, self.done, self.first = 0.0, threading.Event(), {}
        self.first = dict(self._sizes())
        self.thread = threading.Thread(target=self._watch)
        self.thread.start()
        return self

    def __exit__(self, *_):
        self.done.set()
        self.thread.join()

    @staticmethod
    def _sizes():
        for p in psutil.Process(os.getpid()).children(recursive=True):
            try:
                if "python" in p.name():
                    yield p.pid, p.memory_info().rss / 1e6
            except psutil.Error:
                pass

    def _watch(self):
        while not self.done.wait(0.02):
            for pid, mb in self._sizes():
                self.mb = max(self.mb, mb - self.first.get(pid, 0.0))


def test_library_ids_memory_bounded(spark, tmp_path):
    """One batch of 4,000 documents: a worker must not hold the library's results for all of them at once."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    copies = docs.crossJoin(spark.range(4)).select((F.col("doc_id") * 4 + F.col("id")).alias("doc_id"), "text")
    copies.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    with PeakRise() as rise:
        found = {r.doc_id: r.n_ids for r in catalog.bpe_tokenize(spark, str(tmp_path)).collect()}
    rows = docs.collect()
    wanted = [(r.doc_id, len(ids)) for r, ids in zip(rows, plain_ids(r.text for r in rows), strict=True)]
    assert found == {4 * doc + k: n for doc, n in wanted for k in range(4)}
    assert rise.mb < 400


def test_library_ids_odd_texts(spark):
    """Nulls, empty texts and texts around and beyond a portion's size keep their rows, in every batch size."""
    long = ["ab " * (PORTION // 3 + 1), "word 12 " * (PORTION // 4)]
    texts = [None, "", " ", "<|endoftext|> a", "naïve — 漢字 🙂", None, long[0], "x", "", long[1], "\x00\n\t"]
    df = spark.createDataFrame(list(enumerate(texts * 3)), "i long, t string").coalesce(1)
    wanted = Counter((i, tuple(x)) for i, x in enumerate(plain_ids(texts) * 3))
    for size in ("1", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found = df.select("i", library_ids(F.col("t"), PATH).alias("ids")).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert Counter((r.i, tuple(r.ids)) for r in found) == wanted
    assert df.where("i < 0").select(library_ids(F.col("t"), PATH)).collect() == []


def test_library_ids_long_text_memory_bounded(spark):
    """One text of 5 million characters: its tokens' results must not be held all at once."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    text = " ".join(r.text for r in docs * 3)[:5_000_000]
    df = spark.createDataFrame([(text,)], "t string").coalesce(1)
    with PeakRise() as rise:
        found = df.select(F.size(library_ids(F.col("t"), PATH)).alias("n")).first().n
    assert found == len(plain_ids([text])[0])
    assert rise.mb < 400


def test_cut_texts_equal_whole_ones(monkeypatch):
    """Cuts after every few characters, among all kinds of white space, marks and special tokens, change no id."""
    assert tokenize._cuttable(PATH)
    parts = ["a", "Bc", "don't", "'s", " 's", "12", " ", " ", "  ", "\t", "\n", " \n", "\r", "\x1c", "\x85"]
    parts += ["\xa0", "\u2028", "\u3000", "\u200b", "\u180e", "é", "漢", "🙂", ".", "--", "<|endoftext|>", "<|end", "\x00"]
    rng = random.Random(7)
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(3000)]
    wanted = plain_ids(texts)
    for size in (1, 2, 9):
        monkeypatch.setattr(tokenize, "PORTION", size)
        assert [tokenize._ids(PATH, [t])[0].tolist() for t in texts] == wanted
        assert all("".join(tokenize._pieces(t)) == t for t in texts)
    assert sum(len(list(tokenize._pieces(t))) > 1 for t in texts) > 1000


def test_other_files_are_not_cut(tmp_path):
    """A file whose words, normalizer or added tokens may go over spaces keeps texts whole."""
    changes = [
        lambda t: setattr(t, "normalizer", normalizers.Lowercase()),
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=True)),
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)),
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.Metaspace()),
        lambda t: t.add_tokens([AddedToken("of the", normalized=False)]),
        lambda t: t.add_special_tokens([AddedToken("<x>", rstrip=True)]),
    ]
    for k, change in enumerate(changes):
        t = Tokenizer.from_file(PATH)
        change(t)
        t.save(path := f"{tmp_path}/{k}.json")
        assert not tokenize._cuttable(path)
