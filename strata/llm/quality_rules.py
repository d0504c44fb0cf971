"""Quality rules: plain text rules, then a hashed n-gram log-likelihood ratio with one threshold for every document.

Each word and each pair of neighbours is hashed to a bucket. Bucket counts over trusted documents and over the whole
corpus give two smoothed multinomials; a document's score is the mean log ratio of its n-grams (trusted over corpus).
The threshold is the cut that best separates the labelled documents that pass the base rules: it costs least, where
losing a trusted share costs ``keep_weight`` times what keeping an untrusted share does (of equal cuts the lowest,
which keeps most). DataFrame functions only.

The trusted documents are all that are labelled so, and the threshold is set on all labelled documents (``max_labelled``
sets it on that many of smallest id hash only, where a caller asks for it). Counts, scores and verdicts cover every
document. Bucket tables have a fixed length. Texts meet the labels once, for the counts; for the threshold only their
figures do, which are computed once and stored beside the columns that come out.

Defined cases: a null text has no words and fails the base rules; a text without n-grams scores 0; a document with
repeated rows is judged row by row; of conflicting labels the worse holds; without trusted labels the ratio is 0 and
only the base rules decide; without labels of both kinds, and where no cut costs less than none, every score passes. Empty tables give empty results. Extra
columns pass through ``judge``; its own columns replace those of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, store, words

BUCKETS = 1 << 14
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
CUTS = 100  # cuts tried for the threshold in a unit of score
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")


def _count_out(text: Column, pattern: str) -> Column:
    """Length of a text without what matches."""
    return F.length(F.regexp_replace(text, pattern, ""))


def dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def pair_hashes(hashes: Column, step: int = 1) -> Column:
    """Hash of each entry with the one ``step`` further (the last ones alone)."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))


def repeat_words(pairs: Column) -> Column:
    """Words in eight-word windows that occur twice or more, from the array of neighbours' pair hashes."""
    fours = let(pairs, lambda p: pair_hashes(p, 2))
    windows = F.slice(let(fours, lambda f: pair_hashes(f, 4)), 1, F.size(pairs) - (WINDOW - 1))

    def covered(win: Column) -> Column:
        ordered = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            found = F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                             | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))
            return F.sort_array(F.transform(found, lambda e: e["i"]))

        total = let(let(ordered, starts), lambda at: F.aggregate(
            F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(p - F.get(at, j - 1), F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))
        return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(total)

    return F.when(F.size(pairs) <= WINDOW, F.lit(0)).otherwise(let(windows, covered)).cast("long")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def buckets(hashes: Column, pairs: Column, n: int = BUCKETS) -> Column:
    """Buckets of a text's words and pairs of neighbours (the last word pairs with the end)."""
    return F.transform(F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(n)).cast("int"))


def log_ratio(docs: DataFrame, trusted: Column, text: str = "text", n: int = BUCKETS,
              smoothing: float = 0.5) -> list[float]:
    """Log ratio of every bucket, trusted documents over all documents."""
    grams = docs.select(trusted.cast("int").alias("t"),
                        F.explode(let(word_hashes(F.col(text)), lambda h: buckets(h, pair_hashes(h), n))).alias("b"))
    rows = grams.groupBy("b").agg(F.count("*").alias("n"), F.sum("t").alias("t")).collect()  # a row a bucket
    raw, good = [0] * n, [0] * n
    for r in rows:
        raw[r["b"]], good[r["b"]] = r["n"], r["t"] or 0
    if not sum(good):
        return [0.0] * n
    raw_all, good_all = sum(raw) + smoothing * n, sum(good) + smoothing * n
    return [math.log((g + smoothing) / good_all) - math.log((r + smoothing) / raw_all) for g, r in zip(good, raw)]


def score(hashes: Column, pairs: Column, ratio: list[float]) -> Column:
    """Mean log ratio of a text's n-grams."""
    table = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")
    grams = buckets(hashes, pairs, len(ratio))
    return F.when(F.size(hashes) > 0, F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(table, b))
                  / (2 * F.size(hashes))).otherwise(F.lit(0.0))


def labelled(labels: DataFrame) -> DataFrame:
    """(__id, __good) of every labelled id."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    return one.select(F.col("doc_id").alias("__id"), (F.col("q") > 0).alias("__good"))


def labelled_sample(known: DataFrame, max_labelled: int) -> DataFrame:
    """At most ``max_labelled`` labelled ids, those of smallest hash."""
    return known.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)


def threshold(scored: DataFrame, keep_weight: float = 10.0) -> float:
    """Cut between rows of (good, score) that costs least, in the range of the scores; -inf without both classes, or if
    the lowest cut, which keeps all, costs least."""
    at = F.floor(F.col("score") * CUTS).cast("int")
    rows = scored.groupBy(at.alias("at")).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")) \
        .orderBy("at").collect()  # a row a cut; scores are within the logarithm of the corpus size
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not good or not bad:
        return -math.inf
    best, cut = 1.0, -math.inf  # keeping all
    lost, dropped = 0, 0
    for r in rows[:-1]:
        lost, dropped = lost + r["good"], dropped + r["bad"]
        cost = keep_weight * lost / good + (bad - dropped) / bad
        if cost < best - 1e-12:
            best, cut = cost, (r["at"] + 1) / CUTS
    return cut


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = 20,
          max_repeat_percent: int = 30, max_labelled: int | None = None, n: int = BUCKETS,
          keep_weight: float = 10.0, passed: list[str] | None = None) -> DataFrame:
    """Adds the base figures, ``score``, ``base_failed`` and ``kept`` to every document. ``passed`` names the columns of
    ``docs`` that come out beside them (all, if not given)."""
    docs = docs.drop(*COLUMNS)
    labels = store(labelled(labels), "quality-labels")
    texts = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    marked = texts.join(labels.hint("shuffle_hash"), "__id", "left")  # one plan at every size; labels may be many
    ratio = log_ratio(marked, F.coalesce("__good", F.lit(False)), "__text", n)
    t = F.coalesce(F.col(text), F.lit(""))
    measured = let(word_hashes(t), lambda h: let(pair_hashes(h), lambda p: F.struct(
        F.size(h).cast("long").alias("n_words"), repeat_words(p).alias("n_repeat_words"),
        score(h, p, ratio).alias("score"))))
    # stored, so that every text is measured once: for the threshold and for the result
    figures = docs.select(F.struct(*(docs.columns if passed is None else passed)).alias("doc"),
                          F.col(doc_id).alias("id"), measured.alias("m"), t.alias("t"))
    figures = store(figures.select(
        "doc", "id",
        F.col("m.n_words").alias("n_words"),
        _count_out(F.col("t"), SPACE + "+").cast("long").alias("word_chars"),
        _count_out(F.col("t"), f"[^{SYMBOLS}]+").cast("long").alias("n_symbols"),
        dup_lines(F.col("t")).cast("long").alias("n_dup_lines"),
        F.col("m.n_repeat_words").alias("n_repeat_words"),
        F.col("m.score").alias("score"),
    ), "quality-figures")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    figures = figures.withColumn("base_failed", failed)
    deciding = labels if max_labelled is None else labelled_sample(labels, max_labelled)
    known = figures.where("not base_failed").select(F.col("id").alias("__id"), "score") \
        .join(deciding.hint("shuffle_hash"), "__id")
    cut = threshold(known.select(F.col("__good").alias("good"), "score"), keep_weight)
    return figures.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(cut))) \
        .select("doc.*", *COLUMNS)
