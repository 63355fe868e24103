"""Grounding checks: quoted spans and numbers must be present in the source they are drawn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgrain.functions.text import CUT, ELLIPSIS, collapse, fold_marks, nfkc, numbers, strip

MIN_FRAGMENT = 12


def span_fragments(span: Column, compose: bool = True) -> Column:
    """Normalised fragments of a span, cut at its raw ellipses, of at least MIN_FRAGMENT characters."""
    marked = F.regexp_replace(F.coalesce(span, F.lit("")), ELLIPSIS, CUT)
    folded = fold_marks(nfkc(marked) if compose else marked)
    return F.filter(F.transform(F.split(folded, CUT), collapse), lambda f: F.length(f) >= MIN_FRAGMENT)


def fragments_grounded(fragments: Column, source: Column) -> Column:
    """Whether there is a fragment and all are parts of the normalised source."""
    return (F.size(fragments) > 0) & F.forall(fragments, lambda f: F.contains(source, f))


def number_values(source: Column) -> Column:
    """The numbers of a normalised source as doubles."""
    return F.filter(F.transform(numbers(source), lambda n: n.try_cast("double")), lambda v: v.isNotNull())


def first_ungrounded(answer: Column, source: Column, values: Column) -> Column:
    """The first number of a normalised answer that is neither written in the source nor equal to one of its numbers."""

    def missing(n: Column) -> Column:
        return ~F.contains(source, n) & ~F.coalesce(F.array_contains(values, n.try_cast("double")), F.lit(False))

    return F.get(F.filter(numbers(answer), missing), F.lit(0))


def span_of(span: Column, supporting_span: Column) -> Column:
    """The span, or else its alias, stripped; empty counts as absent."""
    return strip(F.coalesce(F.nullif(span, F.lit("")), supporting_span, F.lit("")))


def pair_reason(question: Column, answer: Column, span: Column, grounded: Column, offender: Column) -> Column:
    """'' if the pair is kept, else why it goes: empty, span, or num: with the offending number."""
    blank = (F.coalesce(question, F.lit("")) == "") | (F.coalesce(answer, F.lit("")) == "") | (F.coalesce(span, F.lit("")) == "")
    return (
        F.when(blank, "empty").when(~grounded, "span").when(offender.isNotNull(), F.concat(F.lit("num:"), offender)).otherwise("")
    )
