"""Pluggable tokenizers as column functions: word hashes in SQL, or a vocabulary file of the tokenizers library."""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType

#: Characters that the library gets at once. It holds some hundred bytes a token until a call's results are freed.
PORTION = 250_000
_BREAK = re.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=2)
def _loaded(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.lru_cache(maxsize=2)
def _cuttable(path: str) -> bool:
    """Whether no token of this file goes over a space between two other characters but at its own start."""
    d = json.loads(_loaded(path).to_str())
    before = d["pre_tokenizer"] or {}
    by_word = before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
    return d["normalizer"] is None and by_word and all(
        x["content"].split() == [x["content"]] and not (x["lstrip"] or x["rstrip"] or x["single_word"]) for x in d["added_tokens"]
    )


def _portions(part: pa.Array) -> Iterator[list[str]]:
    """A batch's texts in order, null as empty: lists of at most PORTION characters, longer texts alone."""
    texts, size = [], 0
    for at in range(0, len(part), 64):
        for t in part.slice(at, 64).to_pylist():
            t = t or ""
            if texts and size + len(t) > PORTION:
                yield texts
                texts, size = [], 0
            texts.append(t)
            size += len(t)
    if texts:
        yield texts


def _pieces(text: str) -> Iterator[str]:
    """A text cut at the first space between two other characters after each PORTION of it; whole where there is none."""
    at = 0
    while len(text) - at > PORTION and (m := _BREAK.search(text, at + PORTION)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def _ids(path: str, texts: list[str]) -> list[np.ndarray]:
    """The ids of one portion's texts."""
    if len(texts) == 1 and len(texts[0]) > PORTION and _cuttable(path):
        return [np.concatenate([_encoded(path, [p])[0] for p in _pieces(texts[0])])]
    return _encoded(path, texts)


def _encoded(path: str, texts: list[str]) -> list[np.ndarray]:
    return [np.array(e.ids, np.int32) for e in _loaded(path).encode_batch_fast(texts, add_special_tokens=False)]


def library_ids(text: Column, path: str) -> Column:
    """Ids by a tokenizers JSON file, without special tokens; the file is loaded once in each worker.

    Null counts as empty. A worker holds the library's results of one portion, whatever the batch's size, and uses one
    thread, as a task has one core (unless TOKENIZERS_PARALLELISM is set). Texts longer than a portion are cut where no
    token can go over the cut, if the file has byte-level words; by other files, and without such a place, they are
    encoded whole.
    """

    @arrow_udf(ArrayType(IntegerType()))
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        for part in parts:
            for texts in _portions(part):
                ids = _ids(path, texts)
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))

    return run(text)
