"""Byte-level BPE with a memory-mapped lexicon of frequent words.

A text splits at special tokens, then into words by the vocabulary's word pattern, then each word into ids by the
ranked merges. Three layers answer "which ids has this word": a bounded cache in each Python worker, the lexicon, and
the exact merge loop. The lexicon is a minimal acyclic automaton: frequent words, which the corpus is counted for,
share prefixes and suffixes; every transition carries how many words come before it, so a path gives the word's
number and that its ids. It is built once, broadcast as bytes (at most ``max_words`` words of at most
``MAX_WORD_BYTES``) and mapped from an unlinked file by each worker.

New words of a batch of texts are looked up and merged together, one step or merge of every word at a time.

Texts are cut at single spaces into pieces first, because a word can start with a space but never goes over one that
follows a non-space; only where white space meets a space from both sides is the whole text matched at once.

Defined results: null text counts as empty and has no ids; special tokens' strings become their ids; decoding turns
invalid UTF-8 into U+FFFD as the public library does; a null list of ids decodes to null.
"""

from __future__ import annotations

import array
import functools
import hashlib
import heapq
import json
import mmap
import operator
import os
import struct
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.frequent import most_frequent
from loomgrain.llm.memory import tidy
from loomgrain.session import Scratch

MAX_WORD_BYTES = 64
#: Fixed value: the public word pattern of this byte-level vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = regex.compile(WORD_PATTERN)
#: Marks that end a word of letters and are words of their own.
_CLOSERS = frozenset(".,;:!?")
_TANGLED = regex.compile(r"\s (?:\s|\Z)")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + other.index(b)) for b in range(256)]


class Vocabulary:
    """Ids, their bytes, merge ranks and special tokens of a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        symbols = _byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        vocab = d["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in d["added_tokens"] if t["special"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.first = [vocab[c] for c in symbols]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, m in enumerate(d["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.decimal = [str(i) for i in range(size)]
        self._table: tuple[np.ndarray, np.ndarray] | None = None
        self._pairs: np.ndarray | None = None

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: always the pair of least rank, the leftmost first."""
        ids = [self.first[b] for b in word]
        if len(ids) > 40:
            return self._merge_long(ids)
        get, made = self.ranks.get, self.made
        none = len(made)
        found = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        found.append(none)
        while (best := min(found)) < none:
            at = found.index(best)
            ids[at : at + 2] = [made[best]]
            del found[at]
            if at:
                found[at - 1] = get(ids[at - 1] << 32 | ids[at], none)
            if at + 1 < len(ids):
                found[at] = get(ids[at] << 32 | ids[at + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.ranks.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j] = self.made[rank], True
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (r := self.ranks.get(ids[left] << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [x for x, g in zip(ids, gone, strict=True) if not g]

    def _rank_table(self) -> tuple[np.ndarray, np.ndarray]:
        """An open hash table of pair to rank, a quarter full: keys (first id, second id) and ranks."""
        if self._table is None:
            keys = np.array([(k >> 32) << 20 | (k & 0xFFFFFFFF) for k in self.ranks], np.int64)
            ranks = np.array(list(self.ranks.values()), np.int32)
            bits = max(4, int(len(keys) * 4).bit_length())
            table, values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, len(self.made), np.int32)
            at = self._slots(keys, bits)
            left = np.arange(len(keys))
            while len(left):
                free = table[at[left]] < 0
                _, first = np.unique(at[left][free], return_index=True)
                won = left[free][first]
                table[at[won]], values[at[won]] = keys[won], ranks[won]
                left = left[table[at[left]] != keys[left]]
                at[left] = (at[left] + 1) & ((1 << bits) - 1)
            self._table = table, values
        return self._table

    def _byte_pairs(self) -> np.ndarray:
        """The rank of every pair of bytes."""
        if self._pairs is None:
            first = np.array(self.first, np.int32)
            self._pairs = self._ranks_of(np.repeat(first, 256), np.tile(first, 256))
        return self._pairs

    @staticmethod
    def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        table, values = self._rank_table()
        keys = a.astype(np.int64) << 20 | b
        at = self._slots(keys, len(table).bit_length() - 1)
        out = np.full(len(keys), len(self.made), np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            there = table[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = values[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
            at[open_] = (at[open_] + 1) & (len(table) - 1)
        return out

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of many short words: in each round every word that still can merges its pair of least rank."""
        none = len(self.made)
        made = np.array(self.made, np.int32)
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        ids = np.array(self.first, np.int32)[data]
        out: list[bytes] = [b""] * len(words)
        who = np.nonzero(sizes)[0]
        sizes = sizes[who]
        starts = np.cumsum(sizes) - sizes
        last = np.zeros(len(ids), bool)
        last[starts + sizes - 1] = True
        ranks = np.full(len(ids), none, np.int32)
        ranks[:-1] = self._byte_pairs()[data[:-1].astype(np.int64) << 8 | data[1:]]
        ranks[last] = none
        while len(who):
            best = np.minimum.reduceat(ranks, starts)
            done = best == none
            if done.any():
                ends = starts + sizes
                packed = ids.astype("<u4").tobytes()
                for i, a, b in zip(who[done].tolist(), (4 * starts[done]).tolist(), (4 * ends[done]).tolist(), strict=True):
                    out[i] = packed[a:b]
                stay = np.repeat(~done, sizes)
                ids, ranks, last = ids[stay], ranks[stay], last[stay]
                who, sizes, best = who[~done], sizes[~done], best[~done]
                starts = np.cumsum(sizes) - sizes
                if not len(who):
                    break
            owner = np.repeat(np.arange(len(who)), sizes)
            hits = np.nonzero(ranks == best[owner])[0]
            at = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])]
            ids[at] = made[best]
            last[at] = last[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, ranks, last = ids[keep], ranks[keep], last[keep]
            at = at - np.arange(len(at))
            sizes = sizes - 1
            starts = np.cumsum(sizes) - sizes
            ranks[at] = none
            right = at[~last[at]]
            ranks[right] = self._ranks_of(ids[right], ids[right + 1])
            left = at[at > starts] - 1
            ranks[left] = self._ranks_of(ids[left], ids[left + 1])
        return out

    def decode(self, ids) -> str:
        return b"".join(picked(self.bytes, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic automaton of the words, with their ids, as one block of bytes."""
    words = sorted(entries)
    register: dict[tuple, int] = {}
    nodes: list[tuple[bool, list[tuple[int, int]]]] = []
    counts: list[int] = []

    def freeze(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(nodes)
            nodes.append((final, edges))
            counts.append(final + sum(counts[t] for _, t in edges))
        return register[key]

    path: list[list] = [[False, []]]
    letters: list[int] = []

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            path[-1][1].append((letters.pop(), freeze(final, edges)))

    previous = b""
    for w in words:
        same = len(os.path.commonprefix([previous, w]))
        close(same)
        for b in w[same:]:
            letters.append(b)
            path.append([False, []])
        path[-1][0] = True
        previous = w
    close(0)
    root = freeze(*path[0])
    first, labels, targets, skips = [0], bytearray(), [], []
    for final, edges in nodes:
        skip = int(final)
        for label, target in edges:
            labels.append(label)
            targets.append(target)
            skips.append(skip)
            skip += counts[target]
        first.append(len(labels))
    finals = bytes(int(f) for f, _ in nodes)
    offsets, ids = [0], []
    for w in words:
        ids += entries[w]
        offsets.append(len(ids))
    ints = [*first, *targets, *skips, *offsets, *ids]
    head = struct.pack("<6I", len(nodes), len(targets), len(words), len(ids), root, 0)
    return head + struct.pack(f"<{len(ints)}I", *ints) + finals + bytes(labels)


class Lexicon:
    """A compiled lexicon, mapped from a file that no longer has a name."""

    def __init__(self, block: bytes):
        fd, name = tempfile.mkstemp(prefix="lexicon-")
        try:
            os.unlink(name)
            with os.fdopen(fd, "w+b") as f:
                f.write(block)
                f.flush()
                self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        except BaseException:
            raise
        n, e, w, i, self.root, _ = struct.unpack_from("<6I", self.map)
        view, at = memoryview(self.map), 24
        parts = []
        for size in (n + 1, e, e, w + 1, i):
            parts.append(view[at : at + 4 * size].cast("I"))
            at += 4 * size
        self.first, self.targets, self.skips, self.offsets, self.ids = parts
        self.finals, self.labels = at, at + n
        self.words, self.states = w, n

    def get(self, word: bytes):
        """The ids of a word, or None if it is not in the lexicon."""
        state, number = self.root, 0
        find, labels, first = self.map.find, self.labels, self.first
        for i in range(len(word)):
            e = find(word[i : i + 1], labels + first[state], labels + first[state + 1]) - labels
            if e < 0:
                return None
            number += self.skips[e]
            state = self.targets[e]
        if not self.map[self.finals + state]:
            return None
        return self.ids[self.offsets[number] : self.offsets[number + 1]]


    def get_all(self, words: list[bytes]) -> list[bytes | None]:
        """The packed ids of many words, None for those not in the lexicon; all words take each step together."""
        out: list[bytes | None] = [None] * len(words)
        if not self.words:
            return out
        first = np.frombuffer(self.first, np.uint32).astype(np.int64)
        source = np.repeat(np.arange(self.states), np.diff(first))
        steps = source << 8 | np.frombuffer(self.map, np.uint8, len(source), self.labels)
        targets, skips = np.frombuffer(self.targets, np.uint32), np.frombuffer(self.skips, np.uint32)
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        state, number = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        alive = np.ones(len(words), bool)
        for k in range(int(sizes.max(initial=0))):
            i = np.nonzero(alive & (sizes > k))[0]
            if not len(i):
                break
            key = state[i] << 8 | data[starts[i] + k]
            e = np.minimum(np.searchsorted(steps, key), len(steps) - 1)
            good = steps[e] == key if len(steps) else np.zeros(len(i), bool)
            alive[i[~good]] = False
            i, e = i[good], e[good]
            number[i] += skips[e]
            state[i] = targets[e]
        finals = np.frombuffer(self.map, np.uint8, self.states, self.finals)
        found = np.nonzero(alive & (finals[state] == 1))[0]
        offsets, ids = np.frombuffer(self.offsets, np.uint32), np.frombuffer(self.ids, np.uint32).tobytes()
        lo, hi = 4 * offsets[number[found]].astype(np.int64), 4 * offsets[number[found] + 1].astype(np.int64)
        for i, a, b in zip(found.tolist(), lo.tolist(), hi.tolist(), strict=True):
            out[i] = ids[a:b]
        return out


_LEXICONS: dict[bytes, Lexicon] = {}


def mapped(block: bytes | None) -> Lexicon | None:
    """The lexicon of a block, mapped once in each worker."""
    if not block:
        return None
    key = hashlib.sha256(block).digest()
    if key not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[key] = Lexicon(block)
    return _LEXICONS[key]


def picked(table, keys) -> tuple:
    """table's values at keys, in one call."""
    if len(keys) < 2:
        return tuple(table[k] for k in keys)
    return operator.itemgetter(*keys)(table)


class Memo(dict):
    """A bounded memory in two generations: when the young one is full it becomes the old one, which is then asked first."""

    def __init__(self, make, held: int):
        super().__init__()
        self.make, self.half, self.old = make, held // 2, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        self[key] = out
        return out

    def lacks(self, keys: set[str]) -> list[str]:
        return list(keys.difference(self).difference(self.old))

    def put(self, keys: list[str], values: list[bytes]) -> None:
        if len(self) + len(keys) > self.half:
            self.old = dict(self)
            self.clear()
        self.update(zip(keys, values, strict=True))


class Encoder:
    """Texts to ids, as little-endian 32-bit words."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None = None, held: int = 500_000):
        self.vocab, self.lexicon = vocab, lexicon
        self.after_space = Memo(lambda rest: self.ids_of(" " + rest), held)
        self.whole = Memo(self.ids_of, held // 6)
        self.words = Memo(self._word, held // 2)
        self.specials = {k: struct.pack("<I", v) for k, v in vocab.special.items()}

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        known = self.lexicon.get(raw) if self.lexicon and len(raw) <= MAX_WORD_BYTES else None
        return array.array("I", self.vocab.merge(raw) if known is None else known).tobytes()

    @staticmethod
    def _split(piece: str) -> list[str]:
        """The words of a piece of text that no word crosses the ends of."""
        word = piece[1:] if piece[:1] == " " else piece
        if word.isalpha():
            return [piece]
        if word[-1:] in _CLOSERS and word[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return _WORDS.findall(piece)

    def ids_of(self, piece: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self._split(piece)))

    def parts(self, text: str) -> list[tuple[str, list[str]]]:
        """Stretches of a text: (what stands first, what follows single spaces), or (one word, nothing) where spaces are tangled."""
        split = self.vocab.split
        stretches = [text] if split is None or not any(x in text for x in self.vocab.special) else split.split(text)
        out: list[tuple[str, list[str]]] = []
        for t in stretches:
            if t in self.vocab.special or not _TANGLED.search(t):
                first, *rest = t.split(" ")
                out.append((first, rest))
            else:
                out += [(w, []) for w in _WORDS.findall(t)]
        return out

    def learn(self, batch: list[list[tuple[str, list[str]]]]) -> None:
        """Find what a batch of parts has that is not held yet, its short words all at once."""
        new = self.after_space.lacks({w for parts in batch for _, rest in parts for w in rest})
        split = [
            (" " + w,) if w.isalpha() else (" " + w[:-1], w[-1]) if w[-1:] in _CLOSERS and w[:-1].isalpha() else self._split(" " + w)
            for w in new
        ]
        words = self.words.lacks({w for ws in split for w in ws if len(w) <= MAX_WORD_BYTES // 4})
        for a in range(0, len(words), 30_000):
            part = words[a : a + 30_000]
            raw = [w.encode() for w in part]
            known = self.lexicon.get_all(raw) if self.lexicon else [None] * len(raw)
            unseen = [i for i, x in enumerate(known) if x is None]
            for i, x in zip(unseen, self.vocab.merge_all([raw[i] for i in unseen]), strict=True):
                known[i] = x
            self.words.put(part, known)
        ids = self.words.__getitem__
        self.after_space.put(new, [ids(ws[0]) if len(ws) == 1 else b"".join(map(ids, ws)) for ws in split])

    def joined(self, parts: list[tuple[str, list[str]]]) -> bytes:
        out = []
        for first, rest in parts:
            out.append(self.specials[first] if first in self.vocab.special else self.whole[first])
            out += picked(self.after_space, rest)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        return self.joined(self.parts(text))


_ENCODERS: dict[tuple, Encoder] = {}


def worker_encoder(path: str, block: bytes | None = None) -> Encoder:
    """This worker's encoder; it lives as long as the worker, so later tasks find earlier words."""
    key = (path, hashlib.sha256(block).digest() if block else b"")
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary(path), mapped(block))
    return _ENCODERS[key]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents, counted in each task first: pieces, and then the words of the distinct pieces."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words: dict[str, int] = {}
            get = words.get
            for piece, n in seen.items():
                if piece.isalpha():
                    words[piece] = get(piece, 0) + n
                else:
                    for w in Encoder._split(piece):
                        words[w] = get(w, 0) + n
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"]
            )

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    first, *rest = t.split(" ")
                    seen[first] += 1
                    seen.update(rest)
            if len(seen) > 1_000_000:
                yield flush()
        yield flush()

    return docs.select("text").mapInArrow(tidy(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, max_words: int = 65_536) -> bytes:
    """Compile the most frequent words of the corpus that occur at least twice, as words that follow a space."""
    scratch = Scratch(docs.sparkSession, "lexicon")
    counts = word_counts(docs).where((F.col("n") > 1) & (F.octet_length("word") < MAX_WORD_BYTES))
    counts = scratch.save(counts, "words")
    top = most_frequent(counts, F.col("n"), max_words // 2).select("word").collect()
    scratch.drop(counts)
    vocab = vocabulary(path)
    forms = {form.encode() for r in top for w in (r.word, " " + r.word) for form in _WORDS.findall(w)}
    return compile_lexicon({w: vocab.merge(w) for w in forms})


def encode_documents(docs: DataFrame, path: str, lexicon: bytes | None, digest: bool = False) -> DataFrame:
    """doc_id and ``ids`` (binary, little-endian 32-bit); with digest, the digests of ids and decoded text instead."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, shared.value)
        vocab = encoder.vocab
        for b in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            parts = [encoder.parts(t or "") for t in b.column(1).to_pylist()]
            encoder.learn(parts)
            packed = (encoder.joined(p) for p in parts)
            if not digest:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], names=["doc_id", "ids"])
                continue
            n, shas, decoded = [], [], []
            for p in packed:
                ids = memoryview(p).cast("I")
                n.append(len(ids))
                shas.append(hashlib.sha256(",".join(picked(vocab.decimal, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(vocab.decode(ids).encode()).hexdigest())
            arrays = [b.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), schema)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of (doc_id, ids) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for b in batches:
            texts = [None if p is None else vocab.decode(memoryview(p).cast("I")) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, text string")
