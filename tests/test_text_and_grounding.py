import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomgrain.functions import text
from loomgrain.operators.grounding import check_pairs, drop_reasons, kept_by_type, reason_counts

SOURCE = "TITLE: A lens study\n\nMETHODS: Cells were kept at 37 C for 90 min in “fresh” medium—twice.\n\nRESULTS: Gain rose by 1.40 µm to 25."


def one(spark, column, *values):
    df = spark.createDataFrame([values], [f"c{i}" for i in range(len(values))])
    return df.select(column(*[F.col(c) for c in df.columns]).alias("x")).first().x


@pytest.mark.parametrize(
    "raw, wanted",
    [
        ("´a‛", "́a'"),
        ("″x′", "''x'"),
        ("a‑b−c–d", "a-b-c-d"),
        ("10² µm", "102 μm"),
        ("ﬁne 　print\u0085x\x1cy", "fine print x y"),
        ("  a \n\t b ", "a b"),
        ("", ""),
    ],
)
def test_normalise(spark, raw, wanted):
    assert one(spark, text.normalise, raw) == wanted


def test_normalise_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(text.normalise(F.col("t")).alias("x")).first().x == ""


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=1, max_size=30))
def test_normalise_like_python(spark, texts):
    def plain(s):
        s = unicodedata.normalize("NFKC", s)
        s = s.translate({ord(c): "'" for c in text.SINGLE_QUOTES} | {ord(c): '"' for c in text.DOUBLE_QUOTES} | {ord(c): "-" for c in text.DASHES})
        return " ".join(s.split())

    rows = [(i, t) for i, t in enumerate(texts)]
    got = spark.createDataFrame(rows, "i int, t string").select("i", text.normalise(F.col("t")).alias("x")).collect()
    assert {r.i: r.x for r in got} == {i: plain(t) for i, t in rows}


def pair(answer="as the text says", span="Cells were kept at 37 C", question="what was kept?", kind="t"):
    return ("p", kind, question, answer, span)


CASES = [
    (pair(), ""),
    (pair(span="Cells  were \n kept at 37 C"), ""),
    (pair(span="Cells were lost at 37 C"), "span"),
    (pair(span="Cells were"), "span"),
    (pair(span="   "), "empty"),
    (pair(span='in "fresh" medium-twice'), ""),
    (pair(span="Cells were kept ... Gain rose by 1.40"), ""),
    (pair(span="Cells were kept … Gain fell by 1.40"), "span"),
    (pair(span="Cells were kept ... odd"), ""),
    (pair(answer="it took 90 min"), ""),
    (pair(answer="a gain of 1.4"), ""),
    (pair(answer="about 9 times"), ""),
    (pair(answer="after 77 or 78 min"), "num:77"),
    (pair(answer=" "), "empty"),
    (pair(question=""), "empty"),
]


def test_check_pairs(spark):
    rows = [(*p, i) for i, (p, _) in enumerate(CASES)]
    pairs = spark.createDataFrame(rows, "pmcid string, type string, question string, answer string, span string, i int")
    contexts = spark.createDataFrame([("p", SOURCE)], "pmcid string, context string")
    checked = check_pairs(pairs, contexts)
    assert {r.i: r.reason for r in checked.collect()} == {i: w for i, (_, w) in enumerate(CASES)}
    assert {r.i: r.kept for r in checked.collect()} == {i: int(w == "") for i, (_, w) in enumerate(CASES)}
    assert {(r.kind, r.n) for r in reason_counts(checked).collect()} == {("kept", 8), ("span", 3), ("empty", 3), ("num", 1)}
    assert [r.reason for r in drop_reasons(checked, 2).collect()] == ["empty", "span"]
    assert kept_by_type(checked).first().n == 8


def test_check_pairs_without_context_or_fields(spark):
    pairs = spark.createDataFrame([("q", "a", None, "a span that is long")], "pmcid string, answer string, question string, supporting_span string")
    contexts = spark.createDataFrame([], "pmcid string, context string")
    assert check_pairs(pairs, contexts).first().reason == "empty"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 60), st.integers(12, 60))
def test_any_long_substring_is_grounded(spark, start, size):
    span = SOURCE[start : start + size]
    if len(" ".join(span.split())) < 12:
        return
    pairs = spark.createDataFrame([pair(span=span)], "pmcid string, type string, question string, answer string, span string")
    contexts = spark.createDataFrame([("p", SOURCE)], "pmcid string, context string")
    assert check_pairs(pairs, contexts).first().kept == 1


MARKUP = (
    '<article><article-title>On <i>lenses</i></article-title><abstract>First.</abstract><abstract lang="x">Second &amp; last.</abstract>'
    '<body><sec sec-type="materials|methods"><title>Methods</title><p>We\nmixed.</p></sec><sec><title>Results and discussion</title><p>It grew.</p></sec></body></article>'
)


def test_context(spark):
    c = one(spark, lambda m: text.build_context(m, 100, 200, 30), MARKUP)
    assert c.startswith("TITLE: On lenses\n\nABSTRACT: First. Second &amp; last.\n\nMETHODS: sec-type=\"materials|methods\">")
    assert "RESULTS: Results and discussion It grew" in c and c.index("METHODS") < c.index("RESULTS")
    assert one(spark, lambda m: text.usable_context(text.build_context(m)), MARKUP)
    assert not one(spark, lambda m: text.usable_context(text.build_context(m)), "<p>nothing</p>")
    assert one(spark, lambda m: text.build_context(m), "") == "TITLE: \n\nABSTRACT: "
