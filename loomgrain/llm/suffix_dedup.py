"""Removal of repeated byte strings by bucket-pointer refinement of suffixes.

Texts are UTF-8 bytes. Every byte covered by a ``length``-byte string that also starts in a document with a smaller
doc_id goes; matches stay inside documents and are judged on the input.

1. Anchors. In each ``length``-byte string one q-gram is its anchor (the one of least hash, leftmost first;
   q is half the length). Equal strings have equal anchors, so strings are only compared with those of one anchor.
   Documents are dealt into chunks of a few MB; a chunk reports each of its distinct anchors once, however often it
   has it, and learns which of them occur in two documents.
   Documents that are exact copies (by 128-bit hash and length) of one with a smaller doc_id go whole and take no further part.
2. Buckets. For shared anchors a chunk sends its distinct stretches, a stretch being the bytes of consecutive strings with
   the same anchor, each with the smallest doc_id that has it and its number in the chunk. Stretches of one anchor meet in one
   task, in order of their bytes, so that equal ones become one. Where several are left, their
   strings' positions are put into buckets of equal q0-grams; a bucket is refined by sorting its positions on the bucket
   numbers at later offsets, which the last refinement made, so the compared length doubles each time; positions
   alone in their bucket are done. The smallest doc_id of each final bucket is the answer for its strings.
3. Answers go back to the chunk that asked, by the stretch's number; it marks the covered bytes of its documents.

Chunks bound what most tasks hold, and a string that a third of all documents share is one row a chunk and stretch. The
stretches of one anchor are held together, each distinct one once. All exchange is by chunk or anchor; nothing is collected or broadcast.

Defined results: null text counts as empty; texts shorter than a string stay; rows with a null doc_id stay and remove
nothing; rows that share a doc_id are one document (they do not remove each other's bytes); an empty table gives an empty
result. Anchors are compared by 64-bit hash, which only decides who meets; stretches and strings byte by byte.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.llm.memory import give_back, tidy
from loomgrain.session import Scratch

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SLICE = 1 << 20
_POS_BITS = np.uint64(24)
_POS_MASK = np.uint64((1 << 24) - 1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class GramHasher:
    """Hashes of all q-grams and all longer ranges of a byte array, from one running sum."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data) + 1:
            n = max(len(data) + 1, 1 << 21)
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        h = (sums[hi] - sums[lo]) * self.down[lo]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


_HASHER = GramHasher()


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


class Stretches:
    """The stretches of a slice of documents: anchor hash, begin and end of the bytes, content hash, document row."""

    def __init__(self, texts: list[bytes], length: int, q: int, shift: int = 0):
        self.shift = shift
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        n = len(self.data)
        empty = np.zeros(0, np.int64)
        self.anchor, self.lo, self.hi, self.content, self.row = empty.astype(np.uint64), empty, empty, empty.astype(np.uint64), empty
        if n < length:
            return
        sums = _HASHER.sums(self.data)
        at = np.arange(n - q + 1)
        grams = _HASHER.ranges(sums, at, at + q)
        ranked = (grams & ~_POS_MASK) | at.astype(np.uint64)
        best = _sliding_min(ranked, length - q + 1)
        owner = np.repeat(np.arange(len(texts)), sizes)[: n - length + 1]
        inside = np.arange(n - length + 1) + length <= self.starts[owner + 1]
        change = np.ones(len(best), bool)
        change[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
        first = np.nonzero(change & inside)[0]
        if not len(first):
            return
        stop = np.append(np.nonzero(change | ~inside)[0], len(best))
        last = stop[np.searchsorted(stop, first, "right")]
        self.lo, self.hi, self.row = first, last - 1 + length, owner[first]
        self.anchor = grams[(best[first] & _POS_MASK).astype(np.int64)]
        self.content = _HASHER.ranges(sums, self.lo, self.hi) ^ (self.hi - self.lo).astype(np.uint64)


def _slices(texts: list[bytes], length: int, q: int) -> Iterator[tuple[int, Stretches]]:
    """Stretches of consecutive documents, about a MB at a time; a longer document is cut with an overlap."""
    a = 0
    while a < len(texts):
        b, held = a, 0
        while b < len(texts) and (b == a or held + len(texts[b]) <= _SLICE):
            held += len(texts[b])
            b += 1
        if b - a == 1 and held > 8 * _SLICE:
            part = 8 * _SLICE
            for lo in range(0, held - length + 1, part):
                yield a, Stretches([texts[a][lo : lo + part + length - 1]], length, q, lo)
        else:
            yield a, Stretches(texts[a:b], length, q)
        a = b


def refine(data: np.ndarray, positions: np.ndarray, length: int, q0: int = 8) -> np.ndarray:
    """Bucket numbers of the length-byte strings at positions: equal numbers for equal strings.

    Every position from which bytes may be compared must be followed by enough bytes. Buckets of q0-grams come
    first; each round sorts the positions that still share a bucket on (bucket, bucket at the reached offset).
    """
    n = len(data) - q0 + 1
    key = np.zeros(n, np.uint64)
    for k in range(q0):
        key = key << np.uint64(8) | data[k : k + n].astype(np.uint64)
    bucket = np.unique(key, return_inverse=True)[1].astype(np.int64)
    reach = q0
    while reach < length:
        step = min(reach, length - reach)
        m = n - step
        pair = bucket[:m] * (int(bucket.max(initial=0)) + 1) + bucket[step : step + m]
        # a bucket with one position cannot be divided: only the others are sorted again
        counts = np.bincount(bucket[:m])
        open_ = counts[bucket[:m]] > 1
        inner = np.unique(pair[open_], return_inverse=True)[1]
        new = np.empty(m, np.int64)
        new[open_] = inner
        alone = np.nonzero(~open_)[0]
        new[alone] = np.arange(len(alone)) + (int(inner.max(initial=-1)) + 1)
        bucket, n, reach = new, m, reach + step
    return bucket[positions]


def least_documents(stretches: list[bytes], docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch of each string, smallest doc_id of the strings equal to it), strings in order."""
    sizes = np.array([len(s) for s in stretches], np.int64)
    data = np.frombuffer(b"".join(stretches) + bytes(length), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    n = sizes - length + 1
    owner = np.repeat(np.arange(len(stretches)), n)
    positions = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    bucket = refine(data, positions, length)
    least = np.full(int(bucket.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, bucket, docs[owner])
    return owner, least[bucket]


def _texts(pdf: pd.DataFrame) -> list[bytes]:
    """UTF-8 of each row's text; exact copies of a smaller document are marked and count as empty here."""
    return [b"" if t is None or c else t.encode() for t, c in zip(pdf["text"], pdf["copy"], strict=True)]


def _gathered(pdf: pd.DataFrame) -> pd.DataFrame:
    """A chunk's documents in a fixed order, with the rows that mark copies (by doc_id and text) taken into ``copy``."""
    keys, marks = ["doc_id", "h1", "h2"], pdf["copy"].to_numpy(bool)
    docs = pdf[~marks].sort_values(keys, kind="stable").reset_index(drop=True)
    copies = set(pdf.loc[marks, keys].itertuples(index=False, name=None))
    docs["copy"] = [k in copies for k in docs[keys].itertuples(index=False, name=None)]
    return docs


class Chunk:
    """All stretches of a chunk's documents, and which are the same bytes; the same whenever it is made again."""

    def __init__(self, docs: pd.DataFrame, length: int, q: int):
        self.ids, self.texts = docs["doc_id"].to_numpy(np.int64), _texts(docs)
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.raw = b"".join(self.texts)
        anchor, content, lo, hi, row = ([np.zeros(0, t)] for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
        for a, s in _slices(self.texts, length, q):
            anchor.append(s.anchor)
            content.append(s.content)
            lo.append(s.lo + s.shift + self.starts[a])
            hi.append(s.hi + s.shift + self.starts[a])
            row.append(a + s.row)
        self.anchor, content, self.lo, self.hi, self.row = (np.concatenate(x) for x in (anchor, content, lo, hi, row))
        o = np.lexsort((content, self.anchor))
        new = np.ones(len(o), bool)
        new[1:] = (self.anchor[o[1:]] != self.anchor[o[:-1]]) | (content[o[1:]] != content[o[:-1]])
        # equal hashes are not trusted: each is compared with the one before it
        same = np.nonzero(~new)[0]
        pairs = (x[o[at]].tolist() for at in (same, same - 1) for x in (self.lo, self.hi))
        new[same] = [self.raw[a:b] != self.raw[c:d] for a, b, c, d in zip(*pairs, strict=True)]
        #: The number of each stretch's bytes, and for each number its first stretch, which is that of the smallest doc_id.
        self.number = np.empty(len(o), np.int64)
        self.number[o] = np.cumsum(new) - 1
        self.first = o[new]


def _report(length: int, q: int) -> Callable:
    """Chunk to (anchor, many): its distinct anchors, and whether two of its documents have it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _gathered(pdf)
        ids = pdf["doc_id"].to_numpy(np.int64)
        anchors, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for a, s in _slices(_texts(pdf), length, q):
            anchors.append(s.anchor)
            owners.append(ids[a + s.row])
        h, d = np.concatenate(anchors), np.concatenate(owners)
        o = np.argsort(h, kind="stable")
        h, d = h[o], d[o]
        at = np.nonzero(np.append(True, h[1:] != h[:-1]))[0] if len(h) else np.zeros(0, np.int64)
        many = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at) if len(at) else np.zeros(0, bool)
        chunk = pdf["chunk"].iloc[0] if len(pdf) else 0
        give_back()
        return pd.DataFrame({"chunk": chunk, "anchor": h[at].view(np.int64), "many": many})

    return run


def _is_in(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(keys), bool)
    i = np.searchsorted(ordered, keys)
    i[i == len(ordered)] = 0
    return ordered[i] == keys


def _send(length: int, q: int) -> Callable:
    """Chunk and its shared anchors to (anchor, bytes, doc, chunk, number): its distinct stretches of shared anchors."""

    def run(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(_gathered(pdf), length, q)
        shared = np.sort(known["anchor"].to_numpy(np.int64).view(np.uint64))
        number = np.nonzero(_is_in(c.anchor[c.first], shared))[0]
        at = c.first[number]
        parts = [c.raw[x:y] for x, y in zip(c.lo[at].tolist(), c.hi[at].tolist(), strict=True)]
        chunk = pdf["chunk"].iloc[0] if len(pdf) else 0
        give_back()
        return pd.DataFrame({"anchor": c.anchor[at].view(np.int64), "bytes": parts, "doc": c.ids[c.row[at]], "chunk": chunk, "number": number})

    return run


def _answer(length: int, most: int = 2 << 20) -> Callable:
    """Rows of stretches in order of anchor and bytes to answers (chunk, number, least).

    ``least`` has the smallest doc_id for each string of the stretch, or one value if it is the same for all; stretches
    whose own doc_id is the smallest for all of their strings get no answer.
    """

    def answers(anchors: np.ndarray, parts: list[bytes], docs: np.ndarray, chunks: np.ndarray, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        opens = np.append(True, anchors[1:] != anchors[:-1])
        new = opens.copy()
        for i in np.nonzero(~opens)[0].tolist():
            new[i] = parts[i] != parts[i - 1]
        # distinct stretches, the smallest doc_id of each, and how many its anchor has
        kind, at = np.cumsum(new) - 1, np.nonzero(new)[0]
        least = np.minimum.reduceat(docs, at)
        group = (np.cumsum(opens) - 1)[at]
        several = np.bincount(group)[group] > 1
        values: list[bytes | None] = [x.tobytes() for x in least]
        low = least.copy()
        mixed, a = np.nonzero(several)[0], 0
        while a < len(mixed):
            # whole groups, a bounded number of bytes at a time
            b, held = a, 0
            while b < len(mixed) and (held <= most or group[mixed[b]] == group[mixed[b - 1]]):
                held += len(parts[at[mixed[b]]])
                b += 1
            kinds = mixed[a:b]
            owner, found = least_documents([parts[i] for i in at[kinds].tolist()], least[kinds], length)
            bounds = np.searchsorted(owner, np.arange(len(kinds) + 1))
            low[kinds], high = np.minimum.reduceat(found, bounds[:-1]), np.maximum.reduceat(found, bounds[:-1])
            for i, k in enumerate(kinds.tolist()):
                values[k] = found[bounds[i] : bounds[i] + 1 if low[k] == high[i] else bounds[i + 1]].tobytes()
            a = b
        told = np.nonzero(low[kind] < docs)[0]
        for i in range(0, len(told), 20_000):
            rows = told[i : i + 20_000]
            least_of = pa.array([values[k] for k in kind[rows].tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(chunks[rows]), pa.array(numbers[rows]), least_of], names=["chunk", "number", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            yield from answers(t.column(0).to_numpy(), t.column(1).to_pylist(), *(t.column(i).to_numpy() for i in (2, 3, 4)))

        for b in batches:
            if not b.num_rows:
                continue
            anchors = b.column(0).to_numpy()
            begin = 0
            # what is held ends where the first anchor that is not held's last begins
            if held and rows > 30_000:
                last = held[-1].column(0)[-1].as_py()
                begin = int(np.searchsorted(anchors, last, "right"))
                if begin < b.num_rows:
                    held.append(b.slice(0, begin))
                    yield from flush()
                    held, rows = [], 0
                else:
                    begin = 0
            held.append(b.slice(begin))
            rows += b.num_rows - begin
        if held:
            yield from flush()

    return run


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """gone, widened to all bytes of every UTF-8 character that it touches."""
    begins = (data & 0xC0) != 0x80
    any_gone = np.maximum.reduceat(gone, np.nonzero(begins)[0])
    return any_gone[np.cumsum(begins) - 1]


def _mark(length: int, q: int, carry: list[str], whole: bool) -> Callable:
    """Chunk and its answers to (doc_id, carried columns, n_bytes, spans, kept): the removed runs of every row, the bytes left."""

    def run(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        docs = _gathered(pdf)
        if not len(docs):
            return pd.DataFrame({c: [] for c in ["doc_id", *carry, "n_bytes", "spans", "kept"]})
        c = Chunk(docs, length, q)
        ids, texts, sizes, starts, lo, hi = c.ids, c.texts, c.sizes, c.starts, c.lo, c.hi
        own = ids[c.row]
        edges = np.zeros(int(starts[-1]) + 1, np.int32)
        # what the chunk itself knows: the smallest of its documents that has the same stretch
        least = own[c.first]
        answer: list[bytes | None] = [None] * len(least)
        for number, x in zip(told["number"].tolist(), told["least"].tolist(), strict=True):
            if len(x) == 8:
                least[number] = min(least[number], int.from_bytes(x, "little", signed=True))
            else:
                answer[number] = x
        gone = least[c.number] < own
        several = np.array([x is not None for x in answer], bool)[c.number] if len(answer) else gone
        for k in np.nonzero(several & ~gone)[0].tolist():
            less = np.nonzero(np.frombuffer(answer[c.number[k]], np.int64) < own[k])[0]
            if len(less):
                cut = np.nonzero(np.diff(less) > 1)[0]
                edges[lo[k] + less[np.append(0, cut + 1)]] += 1
                np.add.at(edges, lo[k] + less[np.append(cut, len(less) - 1)] + length, -1)
        np.add.at(edges, lo[gone], 1)
        np.add.at(edges, hi[gone], -1)
        gone = np.cumsum(edges[:-1]) > 0
        data = np.frombuffer(c.raw, np.uint8)
        if whole and len(data):
            gone = _whole_characters(data, gone)
        # a run ends with its document
        step = np.zeros(len(data) + 1, np.int8)
        step[: len(data)] = gone
        border = np.zeros(len(data) + 1, bool)
        border[starts] = True
        before = np.append(0, step[:-1])
        opens = np.nonzero((step == 1) & ((before == 0) | border))[0]
        closes = np.nonzero((before == 1) & ((step == 0) | border))[0]
        first = np.searchsorted(opens, starts)
        spans = [
            np.column_stack([opens[a:b], closes[a:b]]).ravel() - s if b > a else np.zeros(0, np.int64)
            for a, b, s in zip(first[:-1].tolist(), first[1:].tolist(), starts[:-1].tolist(), strict=True)
        ]
        left = data[~gone].tobytes()
        cuts = np.concatenate([[0], np.cumsum(~gone)])[starts].tolist()
        kept = [left[a:b] for a, b in itertools.pairwise(cuts)]
        n_bytes = sizes.copy()
        for i in np.nonzero(docs["copy"].to_numpy())[0].tolist():
            n_bytes[i] = len(docs["text"].iloc[i].encode())
            spans[i], kept[i] = np.array([0, n_bytes[i]]), b""
        kept = [None if t is None else k for t, k in zip(docs["text"], kept, strict=True)]
        give_back()
        carried = {n: docs[n].to_numpy() for n in carry}
        return pd.DataFrame({"doc_id": ids, **carried, "n_bytes": n_bytes, "spans": spans, "kept": kept})

    return run


def exact_copies(known: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(doc_id, h1, h2) of the documents whose whole text, at least ``length`` bytes, is also that of a smaller doc_id."""
    narrow = known.where(F.octet_length("text") >= length).select("doc_id", "h1", "h2", F.octet_length("text").alias("n"))
    first = narrow.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    # written, so that the join deals both sides out and adaptive execution can split a text that many documents have
    first = scratch.save(first.drop("last"), "first")
    return narrow.join(first, ["h1", "h2", "n"]).where("doc_id > first").select("doc_id", "h1", "h2").distinct()


def remove_repeats(
    docs: DataFrame,
    length: int = 50,
    chunk_bytes: int = 4 << 20,
    carry: list[str] | None = None,
    whole_characters: bool = False,
) -> DataFrame:
    """doc_id, n_bytes, spans (begin and end of each removed run, flat), kept (the bytes left; null for null text) of each row.

    carry names string columns to keep. With whole_characters a character goes if any byte of it does, so that kept is UTF-8.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    carry = list(carry or [])
    q = length // 2
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    chunks = max(1, -(-int(total) // chunk_bytes))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(c).cast("string").alias(c) for c in carry])
    hashes = {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), F.col("text"))}
    known = base.where("doc_id is not null").withColumns(hashes)
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")
    copies = scratch.save(exact_copies(known, length, scratch), "copies")
    nothing = F.lit(None).cast("string")

    def dealt(names: list[str]) -> DataFrame:
        docs = known.select(chunk, "doc_id", "h1", "h2", "text", *names, F.lit(False).alias("copy"))
        marks = copies.select(chunk, "doc_id", "h1", "h2", nothing.alias("text"), *[nothing.alias(c) for c in names], F.lit(True).alias("copy"))
        return docs.unionByName(marks)

    shared = _shared_anchors(dealt([]), length, q, scratch)
    scratch.release()
    told = _told(dealt([]), shared, length, q, int(total), scratch)
    scratch.keep_only(copies, told)
    scratch.release()
    kept = "".join(f"{c} string, " for c in carry)
    marked = (
        dealt(carry)
        .groupBy("chunk")
        .cogroup(told.groupBy("chunk"))
        .applyInPandas(_mark(length, q, carry, whole_characters), f"doc_id long, {kept}n_bytes long, spans array<long>, kept binary")
    )
    raw = F.col("text").cast("binary")
    alone = base.where("doc_id is null").select(
        "doc_id",
        *carry,
        F.coalesce(F.octet_length(raw), F.lit(0)).cast("long").alias("n_bytes"),
        F.array().cast("array<long>").alias("spans"),
        raw.alias("kept"),
    )
    return marked.unionByName(alone)


def _shared_anchors(dealt: DataFrame, length: int, q: int, scratch: Scratch) -> DataFrame:
    """(chunk, anchor) of every anchor that two documents have."""
    reported = dealt.groupBy("chunk").applyInPandas(_report(length, q), "chunk long, anchor long, many boolean")
    # an anchor has one row a chunk, so that the window holds few rows however many documents have it
    w = Window.partitionBy("anchor")
    seen = reported.withColumns({"n": F.count(F.lit(1)).over(w), "any": F.max("many").over(w)})
    return scratch.save(seen.where((F.col("n") > 1) | F.col("any")).select("chunk", "anchor"), "shared")


def _told(dealt: DataFrame, shared: DataFrame, length: int, q: int, total: int, scratch: Scratch) -> DataFrame:
    """(chunk, number, least): the answers for every chunk."""
    schema = "anchor long, bytes binary, doc long, chunk long, number long"
    asked = dealt.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInPandas(_send(length, q), schema)
    parts = max(int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (16 << 20)))
    met = asked.repartition(parts, "anchor").sortWithinPartitions("anchor", "bytes")
    return scratch.save(met.mapInArrow(tidy(_answer(length)), "chunk long, number long, least binary"), "told")
