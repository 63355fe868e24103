"""Tolerant JSON: what models write around, instead of or as JSON."""

from __future__ import annotations

import contextlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Where a reply may have its JSON, most trusted first: all of it, a fenced part, between the outermost brackets.
_PLACES = [
    re.compile(p, re.DOTALL)
    for p in (r"\A(.+)", r"(?:\A(?=.*```)|```)\s*(?:json)?\s*([\[{].*?)(?=```|\Z)", r"(\{.*\})", r"(\[.*\])")
]
_MARK = re.compile(r'"(?:[^"\\]|\\.|\\\Z)*(?:"|\Z)|[{}]', re.DOTALL)
_STEP = {"{": 1, "}": -1}


def parse_tolerant(text: str | None) -> object:
    """The value of the first place that parses; None if none does."""
    for place in _PLACES:
        for found in place.finditer(text or ""):
            with contextlib.suppress(ValueError, RecursionError):
                return json.loads(found[1].strip())
    return None


def _group_end(text: str, start: int) -> int | None:
    """Where the braces that open at start are closed again, quoted text not counting; None if they are not."""
    depth = 0
    for m in _MARK.finditer(text, start):
        depth += _STEP.get(m[0], 0)
        if depth == 0:
            return m.end()
    return None


def balanced_objects(text: str | None) -> list[str]:
    """Every outermost {...} of a text that parses, in order; braces inside strings do not count."""
    out, text, end = [], text or "", 0
    while end is not None and (start := text.find("{", end)) >= 0:
        end = _group_end(text, start)
        with contextlib.suppress(ValueError, RecursionError):
            out.append(json.dumps(json.loads(text[start:end]), ensure_ascii=False))
    return out


def _members(value: object, envelope: str) -> list | None:
    items = value.get(envelope) if isinstance(value, dict) else value
    return items if isinstance(items, list) else None


def extract_json(text: Column) -> Column:
    """The tolerant parse as canonical JSON text; null if nothing parses."""

    @pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            parsed = [parse_tolerant(t) for t in s]
            yield pd.Series([None if v is None else json.dumps(v, ensure_ascii=False) for v in parsed], dtype=object)

    return run(text)


def extract_objects(text: Column) -> Column:
    """All outermost JSON objects of a text as JSON texts."""

    @pandas_udf("array<string>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([balanced_objects(t) for t in s], dtype=object)

    return run(text)


def reply_items(text: Column, envelope: str) -> Column:
    """The items of {"<envelope>": [...]} or of a bare array, each as JSON text; null if the reply has no such list."""

    @pandas_udf("array<string>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            out = []
            for t in s:
                items = _members(parse_tolerant(t), envelope)
                out.append(None if items is None else [json.dumps(x, ensure_ascii=False) for x in items])
            yield pd.Series(out, dtype=object)

    return run(text)


def verdict_items(text: Column) -> Column:
    """The (n, supported) items of a judge's reply: n as a whole number, support by truthiness; others are skipped."""

    @pandas_udf("array<struct<n:long,supported:boolean>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            out = []
            for t in s:
                found = []
                for x in _members(parse_tolerant(t), "verdicts") or []:
                    if isinstance(x, dict) and "n" in x:
                        try:
                            found.append({"n": int(x["n"]), "supported": bool(x.get("supported"))})
                        except (TypeError, ValueError, OverflowError):
                            continue
                out.append(found)
            yield pd.Series(out, dtype=object)

    return run(text)


def is_object(item: Column) -> Column:
    """Whether a JSON text is an object."""
    return F.ltrim(item).startswith("{")
