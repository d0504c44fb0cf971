"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending array of the ``k`` smallest distinct hashes of a text's five-word shingles (a shorter text
is one shingle; a text without words has none). Sketches merge: the k smallest of two sketches are the sketch of both
texts' shingles. They estimate resemblance, containment and the number of distinct shingles. DataFrame functions only.

Hashes are xxhash64 values mapped to unsigned order by flipping the sign bit, so smallness is uniform.

Defined cases: null and blank texts have an empty sketch; two empty sketches resemble each other fully (1.0), an empty
and a non-empty one not at all (0.0). Repeated rows have equal sketches. Texts are read whole: a very long one is one row,
with eight bytes a word beside it. Empty tables give empty results. ``with_next`` reads the key and the value and
returns them under the names given; no other column enters, and working columns begin with ``__``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, shuffle_parts, store, words

K = 128
SHINGLE = 5


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Distinct shingle hashes of a text."""
    def shingles(h: Column) -> Column:
        full = F.transform(F.sequence(F.lit(1), F.size(h) - (n - 1)), lambda i: F.xxhash64(F.slice(h, i, n)))
        return F.when(F.size(h) >= n, full).when(F.size(h) > 0, F.array(F.xxhash64(h))) \
            .otherwise(F.array().cast("array<bigint>"))

    return F.array_distinct(let(F.transform(words(text), lambda w: F.xxhash64(w)), shingles))


def sketch(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(shingle_hashes(text, n)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two texts' shingles together, from their sketches."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(parts: DataFrame, keys: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """Sketch of each group of parts. Only each task's k smallest hashes of a group are shuffled."""
    hashes = parts.select(*keys, F.explode(sketch_col).alias("__h")).distinct()
    small = hashes.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy("__h"))).where(F.col("__r") <= k)
    return small.groupBy(*keys).agg(F.sort_array(F.collect_list("__h")).alias(sketch_col))


def _common_below(a: Column, b: Column, k: int) -> tuple[Column, Column]:
    """Sizes of the merged sketch and of what both sketches have of it."""
    both = merge(a, b, k)
    return F.size(both), F.size(F.array_intersect(both, F.array_intersect(a, b)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    size, common = _common_below(a, b, k)
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).when(F.least(F.size(a), F.size(b)) == 0, F.lit(0.0)) \
        .otherwise(common / size).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    at = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / at)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    both = distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, k) * both / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """Sketch as a string of hexadecimal hashes."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


ROWS = 1024  # of a bucket, about
MOST = 1024  # coarse buckets, and fine ones in each
HOT = 64 * ROWS  # rows of one key beyond which they are dealt by value


def _cuts(keys: DataFrame, n: int, by: list[str]) -> DataFrame:
    """``by`` and n - 1 of its keys that cut them into n about equal parts (``c``, ascending)."""
    shares = F.array(*[F.lit((i + 1) / n) for i in range(n - 1)])
    return keys.groupBy(*by).agg(F.percentile_approx("k", shares, F.lit(10 * n)).alias("c")) \
        .select(*by, F.coalesce("c", F.array().cast("array<bigint>")).alias("c"))


def _below(cuts: Column, k: Column) -> Column:
    """How many cuts are below a key; a null comes before all."""
    return F.when(k.isNull(), -1).otherwise(F.size(F.filter(cuts, lambda c: c < k)))


def _number(place: Column, part: Column) -> Column:
    """Coarse and fine place (-1 to 1023), place among hot keys (-1 to 16382) and part (below 2 ** 24) in one number."""
    a, b = F.col("__a").cast("bigint") + 1, F.col("__b").cast("bigint") + 1
    return ((a * 2048 + b) * 16384 + place.cast("bigint") + 1) * (1 << 24) + part.cast("bigint")


def _dealt(docs: DataFrame, k: Column) -> DataFrame:
    """Adds ``__bucket`` (a number in the order of keys) of about ROWS rows each, whatever the keys are.

    Cuts come from the keys themselves, in two levels of at most MOST parts (to the precision of a double: up to 1024
    neighbouring keys beyond 2 ** 53 can't be told apart). A key that more than HOT rows have gets buckets of its own,
    as many as it needs, by ``__tie``, a hash.
    """
    keys = docs.select(k.alias("k"))
    n = min(MOST, max(1, math.ceil(math.sqrt(keys.count() / ROWS))))
    if n == 1:
        out = docs.withColumns({"__a": F.lit(0), "__b": F.lit(0)})
    else:
        coarse = F.array(*[F.lit(c).cast("bigint") for c in _cuts(keys, n, []).first()["c"]]).cast("array<bigint>")
        fine = store(_cuts(keys.select("k", _below(coarse, F.col("k")).alias("a")), n, ["a"]), "cuts")
        fine = F.broadcast(fine.select(F.col("a").alias("__f"), F.col("c").alias("__cuts")))  # MOST rows of MOST numbers
        out = docs.withColumn("__a", _below(coarse, k)).join(fine, F.col("__a") == F.col("__f")) \
            .withColumn("__b", _below(F.col("__cuts"), k)).drop("__f", "__cuts")
    many = out.groupBy("__a", "__b", k.alias("k")).agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    hot = store(many.groupBy("__a", "__b").agg(F.collect_list(F.struct("k", "n")).alias("__hot")), "hot-keys")
    if n == 1 or hot.isEmpty():
        return out.withColumn("__bucket", _number(F.lit(0), F.lit(0))).drop("__a", "__b")
    # among the hot keys of its bucket a key lies before, between, after or on one, and then goes by hash
    mine = F.filter("__hot", lambda h: h["k"].eqNullSafe(k))
    parts = F.least(F.coalesce(F.ceil(F.get(mine, F.lit(0))["n"] / ROWS), F.lit(1)), F.lit(1 << 24))
    share = (F.col("__tie").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    place = F.when(k.isNull(), -1).otherwise(F.coalesce(
        F.size(F.filter("__hot", lambda h: h["k"] < k)) + F.size(F.filter("__hot", lambda h: h["k"] <= k)), F.lit(0)))
    return out.join(hot, ["__a", "__b"], "left") \
        .withColumn("__bucket", _number(place, F.least(F.floor(share * parts), parts - 1))).drop("__a", "__b", "__hot")


def with_next(docs: DataFrame, key: str, value: Column, own: str, out: str, tie: Column | None = None) -> DataFrame:
    """``key``, ``value`` of the row itself as ``own`` and of the next row by descending key (after the last: of the
    first) as ``out``. Rows of one key are ordered by ``tie`` (a 64-bit hash, of the value if not given), then by value;
    a null key comes last.

    Rows are dealt into buckets of about ROWS rows by cuts taken from the keys and ordered within; only the first row
    of a bucket looks further, to the last row of the bucket before. The buckets, one short row each, are ordered in
    one task: a few for each ROWS rows, whatever the keys are, and no more than MOST * MOST but for keys that very many
    rows have.
    """
    k = F.col(key).cast("long")
    df = _dealt(docs.withColumn("__tie", F.xxhash64(value) if tie is None else tie), k)
    edges = store(df.groupBy("__bucket").agg(F.max(F.struct(F.col(key).alias("k"), F.col("__tie").alias("t"))).alias("__k")),
                  "edges")
    before = F.coalesce(F.lag("__bucket").over(W.orderBy("__bucket")), F.max("__bucket").over(W.partitionBy()))
    source = edges.withColumn("__from", before).select("__from", F.col("__bucket").alias("__to"))
    keys = edges.select(F.col("__bucket").alias("__of"), "__k")
    last = df.join(keys, (F.col("__bucket") == F.col("__of")) & F.col(key).eqNullSafe(F.col("__k.k"))
                   & (F.col("__tie") == F.col("__k.t"))) \
        .select("__of", value.alias("__e")).groupBy("__of").agg(F.max("__e").alias("__far"))
    far = source.join(last, F.col("__from") == F.col("__of")).select(F.col("__to").alias("__bucket"), "__far")
    at = W.partitionBy("__bucket").orderBy(key, "__tie", own)
    # dealt by bucket first, so that only the rows themselves are shuffled, not their values; the join finds them in place
    inner = df.repartition(shuffle_parts(docs.sparkSession), "__bucket").select("__bucket", key, "__tie", value.alias(own)) \
        .withColumns({"__near": F.lag(own).over(at), "__rank": F.row_number().over(at)})
    return inner.join(far, "__bucket", "left") \
        .select(key, own, F.when(F.col("__rank") == 1, F.col("__far")).otherwise(F.col("__near")).alias(out))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points of a text replaced by the first as many (or all) of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
