"""Packing by power-of-two decomposition: no sequence crosses documents and none needs padding.

A document's ids, with the end id, are cut from the front into as many pieces of ``max_length`` as fit and then into
the binary decomposition of the rest, longest first. Each piece is a sequence of its own. Equal lengths form a
bucket; a sequence's number starts with its bucket, then has the task that made it and its place there, so the
numbers are unique and each bucket is one range of numbers, without any shuffle or global count. A batch
takes sequences of one bucket only (``write_buckets`` stores each in a folder of its own).

Defined results: null text is empty and becomes the end id alone; rows are packed one by one, so repeated rows give
repeated pieces with numbers of their own; other columns are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import functools
import itertools
import struct
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm.bpe import WORD_PATTERN, worker_encoder
from loomgrain.llm.memory import tidy

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WholeTextIds:
    """Ids of whole texts by a public library over the same vocabulary; by our own encoder where it can't be used.

    The library takes ranks as ids, which holds if later merges have larger ids, and gives up on very long runs of white
    space; both cases go to the encoder of ``bpe``, which gives the same ids.
    """

    def __init__(self, path: str):
        self.own = worker_encoder(path)
        vocab = self.own.vocab
        self.library = None
        if all(a < b for a, b in itertools.pairwise(vocab.made)) and max(vocab.first) < vocab.made[0]:
            special = set(vocab.special.values())
            ranks = {raw: i for i, raw in enumerate(vocab.bytes) if i not in special}
            self.library = tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=vocab.special)

    def __call__(self, text: str) -> bytes:
        if self.library is not None:
            try:
                return self.library.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except ValueError:  # the pattern matcher's limit on very long runs
                pass
        return self.own.encode(text)


@functools.lru_cache(maxsize=2)
def whole_text_ids(path: str) -> WholeTextIds:
    return WholeTextIds(path)


def lengths_of(n: int, most: int) -> list[int]:
    """n as pieces: most, as often as it fits, then falling powers of two."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack_documents(docs: DataFrame, path: str, max_length: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece; ``ids`` are little-endian 32-bit. max_length must be a power of two."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        ids_of = whole_text_ids(path)
        made = [0] * max_length.bit_length()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                rows = []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    raw = ids_of(text or "") + end
                    n, start = len(raw) // 4, 0
                    for length in lengths_of(n, max_length):
                        k = length.bit_length() - 1
                        rows.append((doc, start, length, raw[4 * start : 4 * (start + length)], n, k << 56 | task << 32 | made[k], 0))
                        made[k] += 1
                        start += length
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                columns = zip(*rows, strict=True)
                names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), SCHEMA)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store each bucket of equal lengths in its own folder."""
    pieces.write.partitionBy("length").parquet(path)
