"""Text functions as Spark column expressions; only Unicode NFKC, which Spark lacks, runs in Python."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Marks folded to ASCII so that a verbatim quote matches its source.
SINGLE_QUOTES = "‘’‛′´`"
DOUBLE_QUOTES = "“”‟″"
DASHES = "‐‑‒–—―−"

#: White space as Python's str methods and patterns see it.
SPACE = r"[\s\x1C-\x1F\x85]"
NUMBER = r"-?\d+(?:\.\d+)?"
ELLIPSIS = rf"(?U){SPACE}*(?:\.\.\.|…){SPACE}*"
#: A private-use character: NFKC leaves it alone and nothing composes across it.
CUT = ""
# What marks a methods or results section in article markup.
METHODS_ANCHOR = (
    r'(?:sec-type="[^"]*(?:method|material)[^"]*"'
    r"|<title[^>]*>\s*(?:materials?\s+and\s+methods?|methods?(?:\s+and\s+materials?)?|experimental(?:\s+section)?)\s*</title>)"
)
RESULTS_ANCHOR = r'(?:sec-type="[^"]*result[^"]*"|<title[^>]*>\s*results?(?:\s+and\s+discussion)?\s*</title>)'


@pandas_udf(StringType())
def _nfkc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda t: t if t is None or t.isascii() or unicodedata.is_normalized("NFKC", t) else unicodedata.normalize("NFKC", t))


def nfkc(text: Column) -> Column:
    """Unicode NFKC, vectorised by Arrow; text that is already normal is passed through."""
    return _nfkc(text)


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind (Spark's trim takes spaces only)."""
    return F.regexp_replace(F.regexp_replace(text, rf"(?U)^{SPACE}+", ""), rf"(?U){SPACE}+$", "")


def collapse(text: Column) -> Column:
    """Runs of white space as one space, ends stripped."""
    return F.trim(F.regexp_replace(text, rf"(?U){SPACE}+", " "))


def fold_marks(text: Column) -> Column:
    """Curly quotes and long dashes as their ASCII forms."""
    marks = SINGLE_QUOTES + DOUBLE_QUOTES + DASHES
    plain = "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES) + "-" * len(DASHES)
    return F.translate(text, marks, plain)


def normalise(text: Column, compose: bool = True) -> Column:
    """NFKC, then quotes, then dashes, then white space; null is empty. compose=False for text known to be NFKC."""
    base = F.coalesce(text, F.lit(""))
    return collapse(fold_marks(nfkc(base) if compose else base))


def numbers(text: Column) -> Column:
    """All number literals of a text, in order."""
    return F.regexp_extract_all(text, F.lit(f"(?U)({NUMBER})"), F.lit(1))


def clean_markup(text: Column) -> Column:
    """Tags to spaces, runs of horizontal white space to one; newlines and entities stay."""
    return strip(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), r"[ \t\r\f\x0B]+", " "))


def element(text: Column, tag: str, boundary: bool = False) -> Column:
    """The raw content of the first element with a tag; null without one (an empty element gives '')."""
    pattern = rf"(?is)<{tag}{r'\b' if boundary else ''}[^>]*>(.*?)</{tag}>"
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def elements(text: Column, tag: str) -> Column:
    """The raw contents of all elements with a tag."""
    return F.regexp_extract_all(text, F.lit(rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1))


def section_excerpt(body: Column, anchor: str, max_chars: int) -> Column:
    """From the first anchor: a raw window of three times max_chars, cleaned and cut; '' without an anchor."""
    window = F.substring(F.regexp_extract(body, rf"(?is)({anchor}.*)", 1), 1, 3 * max_chars)
    return F.coalesce(F.substring(clean_markup(window), 1, max_chars), F.lit(""))


def build_context(
    markup: Column,
    abstract_chars: int = 1600,
    methods_chars: int = 7000,
    results_chars: int = 7000,
    title_tag: str = "article-title",
    abstract_tag: str = "abstract",
    methods: str = METHODS_ANCHOR,
    results: str = RESULTS_ANCHOR,
) -> Column:
    """Labelled title, abstract and, where found, methods and results, parted by blank lines; null markup gives null."""
    title = F.coalesce(clean_markup(element(markup, title_tag)), F.lit(""))
    abstract = F.substring(clean_markup(F.array_join(elements(markup, abstract_tag), " ")), 1, abstract_chars)
    body = F.coalesce(element(markup, "body", boundary=True), markup)
    m, r = section_excerpt(body, methods, methods_chars), section_excerpt(body, results, results_chars)
    parts = [
        F.concat(F.lit("TITLE: "), title),
        F.concat(F.lit("ABSTRACT: "), abstract),
        F.when(m != "", F.concat(F.lit("METHODS: "), m)),
        F.when(r != "", F.concat(F.lit("RESULTS: "), r)),
    ]
    return F.when(markup.isNotNull(), F.concat_ws("\n\n", *parts))


def usable_context(context: Column) -> Column:
    """Whether either section label occurs anywhere in the context."""
    return F.coalesce(F.contains(context, F.lit("METHODS:")) | F.contains(context, F.lit("RESULTS:")), F.lit(False))


def answer_tokens(text: Column) -> Column:
    """Lower-case words for answer comparison: punctuation to spaces, split on white space."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\p{L}\p{N}_\s]", " ")
    return F.filter(F.split(spaced, rf"(?U){SPACE}+"), lambda t: t != "")


def word_ids(text: Column, size: int = 1 << 28) -> Column:
    """Ids of white-space separated words: the first seven hex digits of each word's MD5, modulo size."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda t: t != "")
    return F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("long") % size).cast("int"))


def uniform(seed: Column | int, key: Column) -> Column:
    """A draw in [0, 1) that depends on seed and key only."""
    s = F.lit(seed) if isinstance(seed, int) else seed
    digits = F.substring(F.md5(F.concat_ws(":", s.cast("string"), key.cast("string"))), 1, 7)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 28))


def keyed_order(seed: int, key: Column) -> Column:
    """A pseudo-random sort key that depends on seed and key only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def fingerprint(*parts: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of newline-joined parts."""
    return F.substring(F.sha2(F.concat_ws("\n", *[p.cast("string") for p in parts]), 256), 1, 16)
