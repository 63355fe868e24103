"""Document quality by distribution divergence, in DataFrame functions only.

Each document gets two histograms: its code points by character class and its words by common word of its
language (the last bin holds all other words). A language's common words are the ``list_size`` that most of its documents
have, ties by word, counted over all documents. References are the same histograms summed over all documents
of a language. A document is rejected if its Jensen-Shannon distance (base 2, so 0 to 1) to its language's
reference is above a threshold, unless it is too short for the histogram to mean anything. Base rules on
length and on repeated word triples come first.

The ``most_languages`` languages with most documents have lists and references of their own; all others and null share
those named ``und``. So lists and references are bounded whatever the corpus, and are literals and a broadcast.
The documents' own counts are written once to a scratch table.

The thresholds were read off ``threshold_table`` over labelled documents (documents and labels of 10,000 rows, those whose
crc32(doc_id) mod 5 is not 0): the lowest distance, in steps of 0.005, at which at most 1 in 1000 good documents that pass the base
rules is rejected. A test holds them against the labels of the other fifth.

Defined results: null or wordless texts have all counts 0, fail the base rules and are not kept; rows are judged
one by one, so repeated rows give repeated results; other columns of the input are not read.
Equal word triples are found by 128-bit hash within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.session import Scratch

#: The key of languages without a list of their own; "und" is what language tags use for undetermined.
POOLED = "und"
WORD_GAPS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs of characters other than space and \\x09-\\x0D."""
    return F.array_remove(F.split(F.translate(text, WORD_GAPS[1:], "     "), " "), "")


def _triple(i: Column) -> list[Column]:
    """128 bits of the three words from a place on."""
    words = [F.col("w")[i + k] for k in range(3)]
    return [F.xxhash64(*words).alias("a"), F.xxhash64(F.lit(1), *words).alias("b")]


def _equal(x: Column, y: Column) -> Column:
    return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))


def own_languages(docs: DataFrame, most: int) -> list[str]:
    """The languages with most documents, at most ``most``; ties by name."""
    sizes = docs.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most)
    return sorted(r.lang for r in sizes.collect())


def language_key(languages: list[str]) -> Column:
    return F.when(F.col("lang").isin(languages), F.col("lang")).otherwise(POOLED) if languages else F.lit(POOLED)


def common_words(docs: DataFrame, languages: list[str], size: int) -> dict[str, list[str]]:
    """The words that most documents of each language have, the most frequent first."""
    each = docs.select(language_key(languages).alias("lang"), F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = each.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).withColumn("k", place).where(F.col("k") <= size)
    lists: dict[str, list[str]] = {}
    for r in sorted(top.collect(), key=lambda r: (r.lang, r.k)):
        lists.setdefault(r.lang, []).append(r.word)
    return lists


def document_features(docs: DataFrame, languages: list[str], lists: dict[str, list[str]]) -> DataFrame:
    """doc_id, the language key, the base counts and both histograms of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id",
        language_key(languages).alias("lang"),
        text.alias("text"),
        words_of(text).alias("w"),
        F.regexp_replace(text, "[a-z]+", "").alias("t1"),
    )
    hashed = F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.struct(*_triple(i), i.alias("i")),
    )
    pooled = sorted({w for ws in lists.values() for w in ws})
    known = F.create_map(*[x for lang, ws in sorted(lists.items()) for x in (F.lit(lang), F.array(*map(F.lit, ws)))])
    none = F.array().cast("array<string>")
    listed = F.coalesce(F.try_element_at(known, F.col("lang")), none) if lists else none
    step = base.select(
        "*",
        F.regexp_replace("t1", r"[^\x00-\x7F]+", "").alias("t2"),
        F.when(F.size("w") >= 4, F.sort_array(hashed)).alias("s"),
        listed.alias("listed"),
        F.filter("w", lambda x: x.isin(pooled) if pooled else F.lit(False)).alias("common"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    step = step.select(
        "*",
        F.regexp_replace("t2", "[A-Z]+", "").alias("t3"),
        F.transform(
            F.filter(
                "s",
                lambda x, j: _equal(F.get("s", j - 1), x) | _equal(F.get("s", j + 1), x),
            ),
            lambda x: x["i"],
        ).alias("d"),
    )
    step = step.select(
        "*",
        F.length(F.array_join("w", "")).alias("word_chars"),
        (F.length("t3") - F.length(F.translate("t3", "#*$%&|<>", ""))).alias("n_symbols"),
        F.length(F.regexp_replace("t3", "[^0-9]+", "")).alias("n_digits"),
        F.transform("listed", lambda c: F.size(F.filter("common", lambda x: x == c))).alias("hits"),
    )
    n_words = F.size("w")
    covered = F.array_distinct(F.concat("d", F.transform("d", lambda i: i + 1), F.transform("d", lambda i: i + 2)))
    n_space = F.length("text") - F.col("word_chars")
    n_other = F.length("t3") - F.col("n_symbols") - F.col("n_digits") - n_space
    classes = [
        F.length("text") - F.length("t1"),
        F.length("t1") - F.length("t2"),
        F.length("t2") - F.length("t3"),
        F.col("n_symbols"),
        F.col("n_digits"),
        n_space,
        n_other,
    ]
    listed_words = F.aggregate("hits", F.lit(0), lambda a, x: a + x)
    return step.select(
        "doc_id",
        "lang",
        n_words.cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("d").isNull(), 0).otherwise(F.size(covered)).cast("long").alias("n_repeat_words"),
        F.array(*[c.cast("long") for c in classes]).alias("char_hist"),
        F.concat(F.transform("hits", lambda x: x.cast("long")), F.array((n_words - listed_words).cast("long"))).alias("word_hist"),
    )


def language_references(features: DataFrame) -> DataFrame:
    """One row per language: both histograms as shares, summed over all documents of the language."""

    def summed(name: str) -> DataFrame:
        at = features.select("lang", F.posexplode(name).alias("i", "n")).groupBy("lang", "i").agg(F.sum("n").alias("n"))
        arrays = at.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "n"))).alias("a"), F.sum("n").alias("total"))
        share = F.transform("a", lambda x: F.when(F.col("total") > 0, x["n"] / F.col("total")).otherwise(0.0))
        return arrays.select("lang", share.alias(f"ref_{name}"))

    return summed("char_hist").join(summed("word_hist"), "lang")


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, base 2, between counts and shares; null if there is nothing counted."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def term(n: Column, q: Column) -> Column:
        p = n / total
        m = (p + q) / 2
        return (part(p, m) + part(q, m)) / 2

    d = F.aggregate(F.zip_with(counts, reference, term), F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.sqrt(F.greatest(d, F.lit(0.0))))


def threshold_table(judged: DataFrame, labels: DataFrame, distance: str, step: float = 0.005) -> DataFrame:
    """(cut, good_rejected, poor_rejected): shares of labelled documents that pass the base rules whose distance is above each cut."""
    rows = judged.where(f"not base_failed and {distance} is not null").join(labels.select("doc_id", "quality"), "doc_id")
    bins = rows.groupBy(F.floor(F.col(distance) / step).alias("bin")).agg(*[F.sum((F.col("quality") == q).cast("long")).alias(n) for q, n in ((1, "good"), (0, "poor"))])
    above = Window.partitionBy().orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    shares = [(F.sum(n).over(above) / F.sum(n).over(whole)).alias(f"{n}_rejected") for n in ("good", "poor")]
    return bins.select((F.col("bin") * step).alias("cut"), *shares)


def judge_quality(
    docs: DataFrame,
    max_char_distance: float = 0.235,
    max_word_distance: float = 0.24,
    min_chars: int = 200,
    min_words: int = 100,
    min_base_words: int = 50,
    max_repeat_percent: int = 50,
    list_size: int = 16,
    most_languages: int = 200,
) -> DataFrame:
    """Base counts, both distances and the verdict of every row; see the module for what each means."""
    scratch = Scratch(docs.sparkSession, "quality")
    languages = own_languages(docs, most_languages)
    lists = common_words(docs, languages, list_size)
    features = scratch.save(document_features(docs, languages, lists), "features")
    refs = F.broadcast(language_references(features))
    judged = features.join(refs, "lang").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ((F.col("n_words") < min_base_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))).alias(
            "base_failed"
        ),
        js_distance(F.col("char_hist"), F.col("ref_char_hist")).alias("char_distance"),
        js_distance(F.col("word_hist"), F.col("ref_word_hist")).alias("word_distance"),
    )
    odd_chars = (F.col("word_chars") >= min_chars) & (F.col("char_distance") > max_char_distance)
    odd_words = (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance)
    odd = F.coalesce(odd_chars, F.lit(False)) | F.coalesce(odd_words, F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~odd)
