"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

A model of toxic and one of ordinary documents are counted over the labelled rows of all folds but 0. Each predicts the next
character of a word from the ``order - 1`` before it: a count less the discount ``floor``, the rest of the context's mass going to a
backoff that both classes share, an interpolated Kneser-Ney model of all orders down to 1 over the counts of both classes
together. So an expression that a class has no more than ``floor`` times is as likely as in the corpus as a whole. A word's
difference is its log-likelihood in the toxic model less that in the ordinary one. A document's is the sum over its
words of what exceeds ``noise`` (words within it count as equally likely in both), divided by the number of words. A
logistic curve over the logarithm of that gives the score from 0 to 1; its weight must be positive. It is fitted on the last fold with
models that have not counted that fold; the final models count it too.

Nothing is capped or sampled. Where neither class has a context more than ``floor`` times with any one next character, both
models are the backoff and differ by nothing; all other contexts and n-grams stay, in tables that grow with the
labelled rows. Tables of fixed size, whose buckets hold the highest ratio of any n-gram or context that falls into them, bound every
word's difference from above; so the one pass over the texts writes only the words that may exceed the noise (a larger model shares
buckets and lets more through, but loses none: n-grams are told apart by 64-bit hash). Distinct such words get their differences by equi-joins with
the model's tables, and rows their sums. Discounts, class totals, the curve's two weights and those tables reach the driver.

Words are runs without white space, less punctuation at either end, so masked spellings stay whole. Expressions of
several words are seen only through their words.

Defined results: null and empty texts have no words and get the score of no difference (never missing);
without training rows of both classes every score is 0.5 less a hair, so nothing is predicted toxic; repeated rows
repeat; label rows with a null doc_id or label are not used; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomgrain.llm.memory import tidy
from loomgrain.session import Scratch

_WORD = regex.compile(r"[\w\p{M}](?:\S*[\w\p{M}])?|\S+")
#: Words longer than this are cut into stretches of this length, so that all of a word counts.
_STRETCH = 40
_CHUNK = 4 << 20
#: Log-likelihoods are added as whole numbers of this fraction, so that sums do not depend on their order.
_UNIT = 1 << 40
_CLASSES = ("toxic", "ordinary")


def words_in(text: str | None) -> list[str]:
    """The words of a text in order, long ones in stretches."""
    words = _WORD.findall(text.lower()) if text else []
    if any(len(w) > _STRETCH for w in words):
        words = [w[i : i + _STRETCH] for w in words for i in range(0, len(w), _STRETCH)]
    return words


def training_fold(doc_id: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def word_grams(word: Column, order: int) -> Column:
    """All n-grams of a word; spaces stand before it and a line end after it."""
    padded = F.concat(F.lit(" " * (order - 1)), word, F.lit("\n"))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substring(padded, i, F.lit(order)))


def gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """(key, toxic, ordinary, held_toxic, held_ordinary) over (text, toxic, held) rows; the last two are of held rows alone.

    Words are counted per task, then summed, then cut into n-grams.
    """
    names = ["toxic", "ordinary", "held_toxic", "held_ordinary"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bool], Counter] = {(t, h): Counter() for t in (0, 1) for h in (False, True)}

        def flush() -> pa.RecordBatch:
            words = list(set().union(*seen.values()))
            held = {t: np.array([seen[t, True][w] for w in words], np.int64) for t in (0, 1)}
            every = {t: held[t] + np.array([seen[t, False][w] for w in words], np.int64) for t in (0, 1)}
            for c in seen.values():
                c.clear()
            arrays = [pa.array(words, pa.string()), *map(pa.array, (every[1], every[0], held[1], held[0]))]
            return pa.RecordBatch.from_arrays(arrays, names=["word", *names])

        for b in batches:
            for text, toxic, held in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                seen[toxic, held].update(words_in(text))
            if sum(map(len, seen.values())) > 200_000:
                yield flush()
        yield flush()

    def total(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])

    schema = "word string, " + ", ".join(f"{n} long" for n in names)
    words = total(rows.select("text", "toxic", "held").mapInArrow(tidy(count), schema), "word")
    return total(words.select(F.explode(word_grams(F.col("word"), order)).alias("key"), *names), "key")


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))


def shared_backoff(counts: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """(key, p): interpolated Kneser-Ney chance of each n-gram's last character over (key, n) counts of both classes.

    Lower orders count in how many contexts of one character more an n-gram occurs.
    """
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        shorter = levels[n + 1].groupBy(F.expr(f"right(key, {n})").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        levels[n] = scratch.save(shorter, f"order{n}")
    chances = None
    for n in range(1, order + 1):
        told = levels[n].agg(*[F.coalesce(F.sum((F.col("n") == k).cast("long")), F.lit(0)) for k in (1, 2)], F.sum("n"), F.count(F.lit(1))).first()
        d = F.lit(_discount(told[0], told[1]))
        if chances is None:
            kinds = F.lit(float(told[3]))
            value = (F.col("n") - d + d * kinds / (kinds + 1)) / F.lit(float(told[2] or 1))
            chances = levels[n].select("key", value.alias("p"))
            continue
        rows = levels[n].withColumns({"context": F.expr(f"left(key, {n - 1})"), "shorter": F.expr(f"right(key, {n - 1})")})
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        lower = chances.select(F.col("key").alias("shorter"), F.col("p").alias("q"))
        value = (F.col("n") - d + d * F.col("kinds") * F.col("q")) / F.col("total")
        chances = rows.join(contexts, "context").join(lower, "shorter").select("key", value.alias("p"))
        if 1 < n < order:
            chances = scratch.save(chances, f"chances{n}")
    return chances


class KneserNey:
    """Both classes' models over (key, toxic, ordinary) counts, as the tables by which they differ.

    ``contexts`` (context, base): the log ratio of both classes' backoff mass, for contexts in which a class has
    an n-gram more than ``floor`` times; ``grams`` (context, letter, more): what such an n-gram's log ratio is beyond that.
    """

    def __init__(self, counts: DataFrame, order: int, floor: int, scratch: Scratch):
        self.order = order
        shared = shared_backoff(counts.select("key", (F.col("toxic") + F.col("ordinary")).alias("n")), order, scratch)
        counts = counts.withColumn("context", F.expr(f"left(key, {order - 1})"))
        often = F.greatest(*_CLASSES) > floor
        sums = [F.sum(c).alias(f"total_{c}") for c in _CLASSES] + [F.sum(F.least(F.col(c), F.lit(floor))).alias(f"left_{c}") for c in _CLASSES]
        contexts = counts.groupBy("context").agg(*sums, F.max(often).alias("often")).where("often").drop("often")

        def log_ratio(chance) -> Column:
            return F.log(chance("toxic")) - F.log(chance("ordinary"))

        def whole(x: Column) -> Column:
            return F.round(x * _UNIT).cast("long")

        def backoff(c: str) -> Column:
            return F.when(F.col(f"total_{c}") > 0, F.col(f"left_{c}") / F.col(f"total_{c}")).otherwise(1.0)

        def chance(c: str) -> Column:
            own = F.greatest(F.col(c) - floor, F.lit(0)) + F.col(f"left_{c}") * F.col("p")
            return F.when(F.col(f"total_{c}") > 0, own / F.col(f"total_{c}")).otherwise(F.col("p"))

        contexts = scratch.save(contexts.withColumn("base", whole(log_ratio(backoff))), "contexts")
        grams = counts.where(often).join(contexts, "context").join(shared, "key")
        more = whole(log_ratio(chance)) - F.col("base")
        self.grams = scratch.save(grams.select("context", F.expr("right(key, 1)").alias("letter"), more.alias("more")), "grams")
        self.contexts = contexts.select("context", "base")
        self.stored = contexts, self.grams

    def differences(self, words: DataFrame) -> DataFrame:
        """(word, units) of distinct words: log-likelihood in the toxic model less that in the ordinary one; no row for no difference."""
        grams = words.select("word", F.explode(word_grams(F.col("word"), self.order)).alias("key"))
        letters = grams.select("word", F.expr(f"left(key, {self.order - 1})").alias("context"), F.expr("right(key, 1)").alias("letter"))
        met = letters.join(self.contexts, "context").join(self.grams, ["context", "letter"], "left")
        return met.groupBy("word").agg(F.sum(F.col("base") + F.coalesce("more", F.lit(0))).alias("units"))


_BITS = 21
_CONTEXT_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes, never 0, of code points by column."""
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for x in columns:
        h = (h ^ x) * _MIX
        h ^= h >> np.uint64(29)
    return np.maximum(h * _MIX, np.uint64(1))


def _hashes(letters: np.ndarray, n: int) -> np.ndarray:
    """The hashes of all runs of n characters in an array of code points."""
    m = max(0, len(letters) - n + 1)
    return _mixed([letters[k : k + m] for k in range(n)])


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


class Bounds:
    """Upper bounds of all log ratios, in tables of fixed size.

    A bucket of n-grams holds their highest ratio and, if it has but one, that one's hash; a bucket of contexts holds their
    highest base, 0 at least. An n-gram that is alone in its bucket has its own ratio; one that shares it has the
    highest of bucket and context; any other is unseen and has its context's.
    """

    def __init__(self, model: KneserNey):
        self.order = model.order
        grams = model.grams.join(model.contexts, "context")
        grams = self._summed(grams.select(F.concat("context", "letter").alias("key"), (F.col("base") + F.col("more")).alias("units")), _BITS)
        self.alone, self.most = np.zeros(1 << _BITS, np.uint64), np.full(1 << _BITS, -np.inf, np.float32)
        self._fill(self.most, grams)
        lo, hi = (grams.column(c).to_numpy().view(np.uint64) for c in ("lo", "hi"))
        self.alone[grams.column("bucket").to_numpy()] = np.where(lo == hi, lo, np.uint64(0))
        contexts = self._summed(model.contexts.select(F.col("context").alias("key"), F.col("base").alias("units")).where("units > 0"), _CONTEXT_BITS)
        self.base = np.zeros(1 << _CONTEXT_BITS, np.float32)
        self._fill(self.base, contexts)

    @staticmethod
    def _summed(rows: DataFrame, bits: int) -> pa.Table:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                h = _mixed(list(_letters("".join(b.column(0).to_pylist())).reshape(b.num_rows, -1).T))
                at = (h >> np.uint64(64 - bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(h.view(np.int64)), b.column(1)], names=["bucket", "h", "units"])

        found = rows.mapInArrow(tidy(run), "bucket long, h long, units long").groupBy("bucket")
        return found.agg(F.max("units").alias("units"), F.min("h").alias("lo"), F.max("h").alias("hi")).toArrow()

    @staticmethod
    def _fill(table: np.ndarray, rows: pa.Table) -> None:
        ratios = (rows.column("units").to_numpy() / _UNIT).astype(np.float32)
        table[rows.column("bucket").to_numpy()] = np.nextafter(ratios, np.float32(np.inf))

    def of(self, letters: np.ndarray) -> np.ndarray:
        """A bound for each run of ``order`` characters."""
        grams = _hashes(letters, self.order)
        base = self.base[(_hashes(letters, self.order - 1)[: len(grams)] >> np.uint64(64 - _CONTEXT_BITS)).astype(np.int64)]
        at = (grams >> np.uint64(64 - _BITS)).astype(np.int64)
        alone, most = self.alone[at], self.most[at]
        return np.where(alone == grams, most, np.where(alone == 0, np.maximum(most, base), base))


def likely_words(words: list[str], bounds: Bounds, noise: float) -> np.ndarray:
    """Whether each word's difference may exceed the noise."""
    order = bounds.order
    pad = " " * (order - 1)
    letters = _letters("".join(pad + w + "\n" for w in words))
    sizes = np.array([len(w) + order for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    most = np.zeros(len(letters), np.float64)
    most[: len(letters) - order + 1] = bounds.of(letters)
    # runs that reach into the next word are none of this word's
    at = np.arange(len(letters)) - np.repeat(starts, sizes)
    most[at > np.repeat(sizes, sizes) - order] = 0
    return np.add.reduceat(most, starts) > noise - 1e-3


def screened(docs: DataFrame, model: KneserNey, noise: float, carry: list[str]) -> DataFrame:
    """The carried columns with a row number, the number of words, and the words (as often as they occur) that may exceed the noise."""
    base = docs.select(*carry, F.col("text").alias("__text"))
    at, shared = len(carry), docs.sparkSession.sparkContext.broadcast(Bounds(model))
    schema = StructType([*base.drop("__text").schema.fields, *StructType.fromDDL("__row long, __n long, __words array<string>").fields])
    for f in schema:
        f.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, bounds, likely = TaskContext.get().partitionId() << 40, shared.value, {}
        for whole in batches:
            for a in range(0, whole.num_rows, 200):
                b = whole.slice(a, 200)
                texts = [words_in(t) for t in b.column(at).to_pylist()]
                new = list(set().union(*texts).difference(likely))
                if new:
                    if len(likely) > 200_000:
                        likely.clear()
                        new = list(set().union(*texts))
                    likely.update(zip(new, likely_words(new, bounds, noise).tolist(), strict=True))
                found = [[w for w in words if likely[w]] for words in texts]
                arrays = [*b.columns[:at], pa.array(np.arange(row, row + b.num_rows)), pa.array([len(x) for x in texts], pa.int64())]
                row += b.num_rows
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.list_(pa.string()))], names=schema.names)

    return base.mapInArrow(tidy(run), schema)


def excesses(docs: DataFrame, model: KneserNey, noise: float, carry: list[str]) -> DataFrame:
    """The carried columns with ``__excess``: the mean over a text's words of what their difference exceeds the noise by."""
    scratch = Scratch(docs.sparkSession, "words")
    rows = scratch.save(screened(docs, model, noise, carry), "screened")
    said = rows.select("__row", F.explode("__words").alias("word"))
    over = F.col("units") - F.lit(round(noise * _UNIT))
    told = scratch.save(model.differences(said.select("word").distinct()).where(over > 0).select("word", over.alias("over")), "over")
    sums = said.join(told, "word").groupBy("__row").agg(F.sum("over").alias("__over"))
    mean = F.coalesce(F.col("__over") / _UNIT / F.col("__n"), F.lit(0.0))
    return rows.drop("__words").join(sums, "__row", "left").select(*carry, mean.alias("__excess"))


#: Added to an excess before its logarithm is taken.
_LEAST = 0.01


def _feature() -> Column:
    return F.log(F.col("__excess") + _LEAST)


def fit_logistic(rows: DataFrame, names: list[str], ridge: float = 1e-2) -> np.ndarray | None:
    """Weights (bias first) of a logistic curve over standardised features, by Newton steps; classes weigh alike.

    Every step sums over all rows in their tasks. None without rows of both classes.
    """
    k = len(names)
    moments = [f(c) for f in (F.avg, F.stddev_pop) for c in names]
    told = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)), *moments).first()
    size, positive = told[0], told[1]
    if positive in (0, size):
        return None
    mean, scale = np.array(told[2 : 2 + k]), np.array(told[2 + k :]) + 1e-9
    half = 0.5 * size / positive, 0.5 * size / (size - positive)

    def sums(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((k + 1) * (k + 2))
            for b in batches:
                x = np.column_stack([b.column(i).to_numpy() for i in range(k)])
                y = b.column(k).to_numpy()
                z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
                weight = np.where(y == 1, *half)
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                hess = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z
                out += np.concatenate([z.T @ (weight * (p - y)), hess.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], names=["sums"])

        parts = rows.select(*names, "toxic").mapInArrow(run, "sums array<double>").collect()
        return np.sum([r.sums for r in parts], axis=0)

    w = np.zeros(k + 1)
    for _ in range(50):
        s = sums(w)
        grad = s[: k + 1] + ridge * size * np.r_[0, w[1:]]
        hess = s[k + 1 :].reshape(k + 1, k + 1) + ridge * size * np.diag(np.r_[1e-9, np.ones(k)])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([[w[0] - (w[1:] * mean / scale).sum()], w[1:] / scale])


#: The curve where there is nothing to fit it on: one half at a mean excess of 0.04.
_PLAIN = np.array([3.0, 1.0])


class ToxicityModel:
    """A fitted model: tables of contexts and n-grams, and the curve's weights."""

    def __init__(self, model: KneserNey | None, weights: np.ndarray | None, noise: float, spark: SparkSession):
        self.model, self.weights, self.noise, self.spark = model, weights, noise, spark

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows = self.spark.createDataFrame(list(enumerate(texts)), "at long, text string")
        found = score_documents(rows, self, carry=["at"]).select("at", "score").collect()
        return np.array([r.score for r in sorted(found, key=lambda r: r["at"])])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    order: int = 5,
    floor: int = 2,
    noise: float = 2.0,
    max_broadcast_labels: int = 4_000_000,
    folds: int = 5,
) -> ToxicityModel:
    """Learn from labelled rows whose fold is not 0: the curve from the last fold, the models from all of them."""
    spark = docs.sparkSession
    told = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (training_fold(F.col("doc_id"), folds) > 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    scratch = Scratch(spark, "toxicity")
    told = scratch.save(told, "labels")
    # labels are narrow: up to a checked size they are broadcast, else both sides are shuffled
    near = F.broadcast(told) if told.count() <= max_broadcast_labels else told
    held = training_fold(F.col("doc_id"), folds) == folds - 1
    rows = docs.select("doc_id", "text").join(near, "doc_id").withColumn("held", held)
    counts = scratch.save(gram_counts(rows, order), "counts")
    seen = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns[1:]]).first()
    if not seen.toxic or not seen.ordinary:
        return ToxicityModel(None, None, noise, spark)
    weights = None
    if all((0 < seen[f"held_{c}"] < seen[c]) for c in _CLASSES):
        part = counts.select("key", *[(F.col(c) - F.col(f"held_{c}")).alias(c) for c in _CLASSES]).where(F.greatest(*_CLASSES) > 0)
        first = KneserNey(part, order, floor, scratch)
        found = excesses(rows.where("held"), first, noise, ["toxic"]).select("toxic", _feature().alias("x"))
        found = scratch.save(found, "found")
        weights = fit_logistic(found, ["x"])
    if weights is None or not weights[1] > 0:
        weights = _PLAIN
    scratch.release()
    model = KneserNey(counts.select("key", *_CLASSES), order, floor, scratch)
    scratch.keep_only(*model.stored)
    return ToxicityModel(model, weights, noise, spark)


def score_documents(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """The carried columns of docs (all by default) with ``score`` and ``predicted``."""
    carried = [c for c in (docs.columns if carry is None else carry) if c not in ("score", "predicted")]
    if model.model is None:
        return docs.select(*carried, F.lit(0.499).alias("score"), F.lit(int(threshold <= 0.499)).alias("predicted"))
    z = F.lit(float(model.weights[0])) + F.lit(float(model.weights[1])) * _feature()
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    described = excesses(docs, model.model, model.noise, carried).withColumn("score", score)
    return described.select(*carried, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
