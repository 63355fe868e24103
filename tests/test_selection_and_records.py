import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomgrain.operators import blocks, records, selection


def topics(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "pmcid string, facet string, subtopic string, prob double, row_no long")


def test_profile(spark):
    rows = [("p", "A", "x", 0.5), ("p", "A", "y", 0.5), ("p", "A", "n", None), ("p", "E", "neg", -1.0), ("p", "B", "b", 0.9), ("q", "E", "z", 0.0), ("q", "E", "nan", float("nan"))]
    got = {r.pmcid: (r.a, r.e, r.facets) for r in selection.facet_profile(topics(spark, rows), ["row_no"]).collect()}
    assert got == {"p": ("y", None, "ABE"), "q": (None, "z", "E")}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 60), min_size=1, max_size=9), st.integers(1, 300))
def test_allocation(spark, sizes, n):
    strata = spark.createDataFrame([(f"k{i}", s) for i, s in enumerate(sizes)], "k string, size long")
    got = {r.k: r.alloc for r in selection.allocate(strata, n, ["k"]).collect()}
    floors = [min(s, 10) for s in sizes]
    assert all(f <= got[f"k{i}"] <= s for i, (f, s) in enumerate(zip(floors, sizes, strict=True)))
    assert sum(got.values()) == max(sum(floors), min(n, sum(sizes)))


def test_selection_end_to_end(spark):
    rows = [(f"p{i:03d}", "AE"[i % 2], "s", 0.5) for i in range(60)]
    relevance = spark.createDataFrame([(f"p{i:03d}", int(i < 50)) for i in range(70)], "pmcid string, is_micro int")
    one = selection.select_papers(topics(spark, rows), relevance, 30, 1, ["row_no"])
    two = selection.select_papers(topics(spark, rows).repartition(7), relevance, 30, 1, ["row_no"])
    assert one.count() == 30 and set(map(tuple, one.collect())) == set(map(tuple, two.collect()))
    assert all(int(r.pmcid[1:]) < 50 for r in one.collect())


@pytest.mark.parametrize(
    "facets, wanted",
    [
        ("AE", ["modality_selection", "result_interpretation", "comparative_tradeoff"]),
        ("BC", ["artifact_diagnosis", "instrumentation", "sample_prep"]),
        ("ABCDEJ", ["artifact_diagnosis", "modality_selection", "result_interpretation", "instrumentation", "image_analysis", "sample_prep"]),
        ("", []),
        (None, []),
    ],
)
def test_types(spark, facets, wanted):
    df = spark.createDataFrame([(facets,)], "f string")
    assert df.select(selection.question_types(F.col("f")).alias("t")).first().t == wanted


def test_first_of_equal(spark):
    rows = spark.createDataFrame([(3, "a", "b", "z"), (1, "a", "b", "y"), (2, "a", None, "x"), (5, "a", None, "w")], "i int, u string, v string, extra string")
    got = {tuple(r) for r in records.first_of_equal(rows, ["u", "v"], ["i"]).collect()}
    assert got == {(1, "a", "b", "y"), (2, "a", None, "x")}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 40), st.sampled_from([0.0, 0.02, 0.3, 0.5, 1.0]))
def test_holdout(spark, n, fraction):
    rows = spark.range(n).select(F.col("id").alias("k"))
    got = {r.k: r.split for r in records.holdout(rows, fraction, 0, "k").collect()}
    again = {r.k: r.split for r in records.holdout(rows.repartition(3), fraction, 0, "k").collect()}
    wanted = 0 if fraction == 0 or n <= 1 else min(n, -int(-(n * fraction) // 1))
    assert got == again and len(got) == n and sum(v == "validation" for v in got.values()) == wanted


def test_latest_and_defaults(spark):
    v = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, v int, c string")
    assert {tuple(r) for r in records.latest(v, ["k"], "v").collect()} == {("a", 2, None), ("b", 1, "y")}
    assert records.pending(v.select("k").distinct(), v.where("k = 'a'"), "k").first().k == "b"
    got = records.with_default(v.select("k").distinct(), spark.createDataFrame([("a", "q")], "k string, c string"), "k", "c", "")
    assert {tuple(r) for r in got.collect()} == {("a", "q"), ("b", "")}


def token_rows(spark, arrays):
    return spark.createDataFrame(list(enumerate(arrays)), "doc_pos long, input_ids array<int>")


def test_pack(spark):
    rows = token_rows(spark, [list(range(10)), list(range(10, 25))])
    got = blocks.pack_blocks(rows, 4).orderBy("block").collect()
    assert [r.input_ids for r in got] == [list(range(4 * b, 4 * b + 4)) for b in range(6)]
    assert all(r.labels == r.input_ids and r.attention_mask == [1] * 4 for r in got)
    with pytest.raises(ValueError):
        blocks.pack_blocks(rows, 0)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 9), max_size=12), min_size=1, max_size=12), st.integers(1, 7), st.integers(1, 5))
def test_pack_like_python(spark, arrays, length, batch):
    wanted = []
    for a in range(0, len(arrays), batch):
        flat = [x for ids in arrays[a : a + batch] for x in [*ids, 7]]
        wanted += [(a // batch, b, flat[b * length : (b + 1) * length]) for b in range(len(flat) // length)]
    got = blocks.pack_blocks(token_rows(spark, arrays), length, batch, end_id=7)
    assert sorted((r.batch, r.block, r.input_ids) for r in got.collect()) == wanted


def test_interleave(spark):
    a = spark.range(40).select(F.col("id").alias("pos"), F.lit("a").alias("payload"))
    b = spark.range(9).select(F.col("id").alias("pos"), F.lit("b").alias("payload"))
    got = blocks.interleave(a, b, 0.4, 1).orderBy("step").collect()
    for source in (0, 1):
        assert [r.pos for r in got if r.source == source] == list(range(sum(r.source == source for r in got)))
    assert got[-1].pos == (8 if got[-1].source else 39)
    assert [r.step for r in got] == list(range(len(got)))
    assert blocks.interleave(a, b, 0.0, 1).count() == 40
    assert blocks.interleave(a, b.limit(0), 0.4, 1).count() == 40
    assert {r.source for r in blocks.interleave(a, b, 1.0, 1).collect()} == {1}


def test_step_budget():
    assert blocks.step_budget(100, 32, 2, 0.0) == 8
    assert blocks.step_budget(100, 32, 2, 0.5) == 16
    assert blocks.step_budget(100, 32, 2, 0.5, has_replay=False) == 8
    assert blocks.step_budget(100, 32, 2, 0.5, max_steps=20) == 20


def test_stratified_sample_ranks_only_around_the_cut(spark):
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 5 < 4, "big").otherwise("small").alias("k"))
    allocation = spark.createDataFrame([("big", 1500), ("small", 4000), ("none", 3)], "k string, alloc long")
    sample = selection.stratified_sample(rows, allocation, ["k"], "id", 3)
    got = {k: {r.id for r in sample.where(F.col("k") == k).collect()} for k in ("big", "small")}
    order = sorted((r.o, r.id) for r in rows.where("k = 'big'").select("id", selection.keyed_order(3, F.col("id")).alias("o")).collect())
    assert got["big"] == {i for _, i in order[:1500]} and len(got["small"]) == 1000
    plan = sample._jdf.queryExecution().optimizedPlan().toString()
    assert all("__p" in line or "sum(" in line for line in plan.splitlines() if "Window [" in line)
    none = selection.stratified_sample(rows, allocation.withColumn("alloc", F.lit(0).cast("long")), ["k"], "id", 3)
    assert none.count() == 0
