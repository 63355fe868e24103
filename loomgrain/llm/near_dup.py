"""Near-duplicates by a multi-index Hamming join of b-bit min-hash signatures.

A document's set holds its distinct word shingles. Equal sets form one class, known by its smallest doc_id; only
classes are compared. A class has a signature of ``components`` min-hashes of 16 bits. Two sets of similarity s differ in
a component with chance at most 1 - s, so the distance threshold is set ``sigmas`` standard deviations above the
mean at the wanted similarity. By the pigeonhole principle signatures at that distance agree in some chunk of components
but for at most ``chunk_errors`` of them; so each chunk is indexed once for every choice of components that may
be wrong, which guarantees every pair under the threshold. All pairs that share an index entry and matter are
confirmed: signature distance, then similarity of the full sets.

Groups of thousands of copies do not become all pairs. Every entry's members are first tried against the
entry's smallest class, one edge a class and round; what that links is merged. Only members of one entry that are
still in different components are then paired, so that no link between components is lost. An
entry's smallest class is found by a partial aggregate, and the joins on entries are equi-joins that adaptive execution
can split.

Defined results: texts without words, and null texts, have an empty set and are linked with nothing; a text with fewer
words than a shingle is one shingle; a row with a null doc_id is linked with nothing; rows that share a
doc_id are linked with each other, and with whatever any of their texts is; an empty table gives an empty result; other columns are not read.
Shingles are compared by 64-bit hash.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.memory import tidy
from loomgrain.session import Scratch

_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, kept for those seen so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = WordHashes()


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; A-Z count as a-z, words end at ASCII white space."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for k in range(min(width, len(h))):
        out = (out ^ h[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


class Signer:
    """Min-hash signatures of a fixed number of 16-bit components."""

    def __init__(self, components: int):
        r = np.random.default_rng(20_240_117)
        self.flip = r.integers(0, 2**63, (components, 1), dtype=np.uint64) << np.uint64(1)
        self.odd = r.integers(0, 2**63, (components, 1), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
        self.components = components

    def __call__(self, hashes: np.ndarray) -> bytes:
        least = np.full(self.components, np.iinfo(np.uint64).max, np.uint64)
        for a in range(0, len(hashes), 1024):
            least = np.minimum(least, ((hashes[None, a : a + 1024] ^ self.flip) * self.odd).min(1))
        return (least >> np.uint64(13)).astype("<u2").tobytes()


class ChunkIndex:
    """Which index entries a signature has, so that any two within ``distance`` share one."""

    def __init__(self, components: int, distance: int, chunk_errors: int):
        self.distance = distance
        chunks = -(-(distance + 1) // (chunk_errors + 1))
        if chunks * (chunk_errors + 1) > components:
            raise ValueError("the signature is too short for this distance")
        bounds = [round(i * components / chunks) for i in range(chunks + 1)]
        self.picks: list[tuple[int, np.ndarray]] = []
        for lo, hi in itertools.pairwise(bounds):
            for wrong in itertools.combinations(range(lo, hi), chunk_errors):
                self.picks.append((len(self.picks), np.array([c for c in range(lo, hi) if c not in wrong])))

    def entries(self, signatures: np.ndarray) -> np.ndarray:
        """(rows, entries) 64-bit entries of (rows, components) signatures."""
        out = np.empty((len(signatures), len(self.picks)), np.uint64)
        wide = signatures.astype(np.uint64)
        for number, cols in self.picks:
            h = np.full(len(wide), number + 1, np.uint64) * _MIX
            for c in cols:
                h = (h ^ wide[:, c]) * _MIX
                h ^= h >> np.uint64(31)
            out[:, number] = h
        return out


def allowed_distance(components: int, percent: int, sigmas: float) -> int:
    """Differing components at which a pair of exactly the wanted similarity is missed only beyond so many sigmas."""
    q = 1 - percent / 100
    return math.ceil(components * q + sigmas * math.sqrt(components * q * (1 - q)))


def describe(docs: DataFrame, width: int, signer: Signer) -> DataFrame:
    """(doc_id, n_shingles, digest, signature) of each row; an empty set has no digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                n, digests, signatures = [], [], []
                for t in b.column(1):
                    s = shingle_set(t.as_py(), width)
                    n.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    signatures.append(signer(s) if len(s) else None)
                arrays = [b.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "digest", "signature"])
        _WORDS.clear()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        tidy(run), "doc_id long, n_shingles long, digest binary, signature binary"
    )


def _entries(classes: DataFrame, index: ChunkIndex, components: int) -> DataFrame:
    """(entry, rep) of every class; a narrow table in few files, so it is dealt out before it grows."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 2000):
                part = b.slice(a, 2000)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                m = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u2").reshape(-1, components)
                e = index.entries(m)
                arrays = [pa.array(e.ravel().view(np.int64)), pa.array(np.repeat(ids, e.shape[1]))]
                yield pa.RecordBatch.from_arrays(arrays, names=["entry", "rep"])

    return classes.select("rep", "signature").repartition(parts).mapInArrow(tidy(run), "entry long, rep long")


def _confirm(pairs: DataFrame, facts: DataFrame, width: int, percent: int, distance: int, scratch: Scratch) -> DataFrame:
    """The (a, b) pairs whose signatures are near and whose full sets have the similarity.

    The near pairs are written, so that one task never runs the Python of both steps at once.
    """
    side = facts.select("rep", "n_shingles", "signature")
    near = pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
    near = near.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(b.num_rows, -1) for c in (2, 3))
            keep = pa.array((x != y).sum(1) <= distance)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    near = scratch.save(near.mapInArrow(tidy(close), "a long, b long"), "near")
    texts = facts.select("rep", "text")
    both = near.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def of(rep: int, text: str) -> np.ndarray:
            if rep not in held:
                if len(held) > 200:
                    held.clear()
                held[rep] = shingle_set(text, width)
            return held[rep]

        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                out = []
                for a, b, ta, tb in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    x, y = of(a, ta), of(b, tb)
                    z = np.concatenate([x, y])
                    z.sort(kind="stable")
                    common = int((z[1:] == z[:-1]).sum())
                    if 100 * common >= percent * (len(x) + len(y) - common):
                        out.append((a, b))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], names=["a", "b"]
                )

    return both.mapInArrow(tidy(alike), "a long, b long")


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root): the smallest id that each linked id can reach; by alternating large and small stars."""

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.save(edges, "edges")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        new = scratch.save(small, "edges")
        after = state(new)
        scratch.drop(edges)
        edges = new
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _relabel(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """pairs (a, b, ...) with ``ca`` and ``cb``, the components of both, and only those that differ."""
    ra, rb = roots.select(F.col("id").alias("a"), F.col("root").alias("ra")), roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
    out = pairs.join(ra, "a", "left").join(rb, "b", "left")
    out = out.withColumns({"ca": F.coalesce("ra", "a"), "cb": F.coalesce("rb", "b")}).drop("ra", "rb")
    return out.where("ca <> cb")


def _differences(pairs: DataFrame, facts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, c, elements, reach, nb) for pairs (a, b) with b's component c: how b's set differs from that of its reference a.

    With s the sum of two set sizes and k = (1 - p) / (1 + p), sets have similarity p or more just if their symmetric
    difference is at most s k. Two members of one reference with differences X and Y to it therefore need
    |X & Y| >= (|X| + |Y| - s k) / 2, and so share an element of their first |X| - t + 1 and |Y| - t + 1 elements in
    any common order; ``reach`` is how many that can be at most.
    """
    texts = facts.select("rep", "text")
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "c", "ta", "tb")
    p = percent / 100
    k = (1 - p) / (1 + p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                reach, sizes, elements = [], [], []
                for a, b, c, ta, tb in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                    if a not in held:
                        if len(held) > 200:
                            held.clear()
                        held[a] = shingle_set(ta, width)
                    x, y = held[a], shingle_set(tb, width)
                    added, lost = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
                    delta, most = len(added) + len(lost), (len(y) + len(y) / p) * k
                    apart = len(x) * k + p * len(y) * k  # what an unlinked partner differs by, at least
                    t = (delta + apart - most) / 2
                    if delta > (len(x) + len(y)) * k:
                        t = min(t, delta - most)
                    n = min(delta, max(0, delta - max(1, math.ceil(t - 1e-6)) + 1))
                    elements.append(np.concatenate([added, lost ^ _MIX]).view(np.int64))
                    reach.append(n)
                    sizes.append(len(y))
                told = [pa.array(elements, pa.list_(pa.int64())), pa.array(reach, pa.int64()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *told], names=["a", "b", "c", "elements", "reach", "nb"])

    return both.mapInArrow(tidy(run), "a long, b long, c long, elements array<long>, reach long, nb long")


#: Counters for how often a reference's differences have an element.
_COUNTERS = 1 << 21


def _counters(a: np.ndarray, elements: np.ndarray) -> np.ndarray:
    h = (elements.view(np.uint64) ^ (a.view(np.uint64) * _MIX)) * _MIX
    return ((h ^ (h >> np.uint64(32))) * _MIX >> np.uint64(43)).astype(np.int64)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, reference, element) of every element of a batch of differences."""
    lists = batch.column(3)
    row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    return row, batch.column(0).to_numpy()[row], lists.flatten().to_numpy()


def _prefixes(d: DataFrame) -> DataFrame:
    """(a, element, b, c, at, delta, nb): the first ``reach`` elements of each difference, rare ones first.

    Any common order will do. Rarity is read from a fixed number of counters that elements share by hash, so it takes no
    window or join by element, of which a reference's differences may have one in all of them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(_COUNTERS, np.int64)
        for b in batches:
            _, a, e = _flat(b)
            held += np.bincount(_counters(a, e), minlength=_COUNTERS)
        at = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["counter", "n"])

    told = d.mapInArrow(tidy(count), "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(_COUNTERS, np.int64)
    often[told.column("counter").to_numpy()] = told.column("n").to_numpy()
    shared = d.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, a, e = _flat(b)
            n = shared.value[_counters(a, e)]
            o = np.lexsort((e, n, row))
            row, a, e = row[o], a[o], e[o]
            at = np.arange(len(row)) - np.searchsorted(row, row)
            delta = np.bincount(row, minlength=b.num_rows)
            keep = at < b.column(4).to_numpy()[row]
            row = row[keep]
            columns = [a[keep], e[keep], *(b.column(i).to_numpy()[row] for i in (1, 2)), at[keep], delta[row], b.column(5).to_numpy()[row]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["a", "element", "b", "c", "at", "delta", "nb"])

    return d.mapInArrow(tidy(run), "a long, element long, b long, c long, at long, delta long, nb long")


def _apart(
    members: DataFrame, stars: DataFrame, tested: DataFrame, refs: DataFrame, roots: DataFrame, facts: DataFrame,
    width: int, percent: int, scratch: Scratch,
) -> DataFrame:
    """(a, b) of different components that share an entry and may be alike; no such pair that is alike is left out.

    Each class has a reference, of its entries' smallest classes the one with most entry mates. Classes of one
    reference are paired through their differences to it, for which copies of one text that are no copies of each other
    share nothing. In entries whose members have several references the entry's smallest class is one for all of them, so
    every pair that shares an entry has a reference in common. Smallest classes themselves are paired with all their mates.
    """
    p = percent / 100
    k = (1 - p) / (1 + p)
    root = roots.select(F.col("id").alias("rep"), "root")
    m = members.join(root, "rep", "left").join(refs.select("ref", "rep"), "rep", "left")
    m = m.select("entry", "center", "rep", F.coalesce("root", "rep").alias("c"), F.coalesce("ref", "rep").alias("ref"))
    kinds = m.groupBy("entry").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("ref").alias("r1"), F.max("ref").alias("r2"))
    kinds = kinds.where("lo < hi").select("entry", (F.col("r1") < F.col("r2")).alias("many"))
    m = scratch.save(m.join(kinds, "entry"), "apart")
    by_ref = m.select(F.col("ref").alias("a"), F.col("rep").alias("b"), "c")
    by_center = m.where("many").select(F.col("center").alias("a"), F.col("rep").alias("b"), "c")
    edges = scratch.save(by_ref.unionByName(by_center).where("a <> b").distinct(), "references")
    mixed = edges.groupBy("a").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("a")
    near = edges.join(mixed, "a")
    d = scratch.save(_differences(near.select("a", "b", "c"), facts, width, percent), "differences")
    # the rarest elements come first, so that few members meet in one
    d = scratch.save(_prefixes(d), "prefixes")
    x = d.select("a", "element", F.col("b").alias("x"), F.col("c").alias("cx"), F.col("at").alias("ax"), F.col("delta").alias("dx"), F.col("nb").alias("nx"))
    y = d.select("a", "element", F.col("b").alias("y"), F.col("c").alias("cy"), F.col("at").alias("ay"), F.col("delta").alias("dy"), F.col("nb").alias("ny"))
    t = F.greatest(F.lit(1), F.ceil((F.col("dx") + F.col("dy") - (F.col("nx") + F.col("ny")) * k) / 2 - 1e-6))
    prefix = (F.col("ax") <= F.col("dx") - t) & (F.col("ay") <= F.col("dy") - t)
    sizes = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    same = x.join(y, ["a", "element"]).where((F.col("cx") < F.col("cy")) & sizes & prefix).select(F.col("x").alias("a"), F.col("y").alias("b"))
    open_ = stars.select(F.col("center").alias("a"), F.col("rep").alias("b")).join(tested, ["a", "b"], "left_anti")
    open_ = _relabel(open_, roots).select("a", "b")
    return same.distinct().unionByName(open_)


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    components: int = 128,
    chunk_errors: int = 1,
    sigmas: float = 5.0,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; see the module for the method."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    signer = Signer(components)
    distance = allowed_distance(components, percent, sigmas)
    index = ChunkIndex(components, distance, chunk_errors)
    described = scratch.save(describe(docs, width, signer), "described")
    classes = (
        described.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
    )
    classes = scratch.save(classes, "classes")
    entries = _entries(classes, index, components)
    shared = entries.groupBy("entry").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).where("center < last")
    # written, so that the join deals both sides out and adaptive execution can split an entry that many classes have
    shared = scratch.save(shared.drop("last"), "shared")
    scratch.release()
    members = scratch.save(entries.join(shared, "entry"), "members")
    scratch.release()
    involved = members.select("rep").distinct()
    owned = classes.join(involved, "rep", "left_semi")
    facts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(owned, "rep")
    facts = scratch.save(_of_class(facts, width), "facts")
    scratch.release()

    stars = scratch.save(members.where("rep <> center").groupBy("center", "rep").agg(F.count(F.lit(1)).alias("n")), "stars")
    best = stars.groupBy("rep").agg(F.max_by("center", F.struct(F.col("n"), -F.col("center"))).alias("center"))
    tried = scratch.save(best.select(F.col("center").alias("a"), F.col("rep").alias("b")), "tried")
    links = scratch.save(_confirm(tried, facts, width, percent, distance, scratch), "links")
    roots = scratch.save(connected_components(links, scratch), "roots")
    rest = stars.select(F.col("center").alias("a"), F.col("rep").alias("b")).join(tried, ["a", "b"], "left_anti")
    # one try for each pair of components that a star edge joins
    open_pairs = _relabel(rest, roots)
    pairs = open_pairs.groupBy(F.least("ca", "cb"), F.greatest("ca", "cb")).agg(F.min(F.struct("a", "b")).alias("p"))
    pairs = scratch.save(pairs.select("p.a", "p.b"), "second")
    new = _confirm(pairs, facts, width, percent, distance, scratch)
    links = scratch.save(links.unionByName(new), "links")
    roots = scratch.save(connected_components(links, scratch), "roots")
    # whatever else could join two components
    mates = scratch.save(stars.groupBy("center").agg(F.count(F.lit(1)).alias("mates")), "mates")
    likely = F.struct(F.col("mates"), -F.col("center"))
    refs = stars.join(mates, "center").groupBy("rep").agg(F.max_by("center", likely).alias("ref"))
    refs = scratch.save(refs, "refs")
    pairs = scratch.save(_apart(members, stars, tried.unionByName(pairs), refs, roots, facts, width, percent, scratch), "pairs")
    links = scratch.save(links.unionByName(_confirm(pairs, facts, width, percent, distance, scratch)), "links")
    roots = scratch.save(connected_components(links, scratch), "roots")
    scratch.keep_only(described, classes, roots)
    placed = classes.select("digest", "rep").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    placed = placed.select("digest", F.coalesce("root", "rep").alias("component_id"))
    out = described.select("doc_id", "n_shingles", "digest").join(placed, "digest", "left")
    known = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", known.alias("component_id"), F.coalesce(F.col("doc_id") == known, F.lit(True)).alias("kept")
    )


def _of_class(facts: DataFrame, width: int) -> DataFrame:
    """(rep, n_shingles, signature, text): of rows with one doc_id, those whose set is the class's; each text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            digests = b.column(names.index("digest")).to_pylist()
            texts = b.column(names.index("text")).to_pylist()
            keep = [xxhash.xxh3_128_digest(shingle_set(t, width).tobytes()) == d for t, d in zip(texts, digests, strict=True)]
            yield b.filter(pa.array(keep, pa.bool_())).select(["rep", "n_shingles", "signature", "text"])

    plain = facts.withColumn("th", F.xxhash64("text")).dropDuplicates(["rep", "digest", "th"])
    plain = plain.select("rep", "n_shingles", "signature", "digest", "text")
    return plain.mapInArrow(tidy(run), "rep long, n_shingles long, signature binary, text string")
