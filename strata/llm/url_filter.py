"""URL filters: host rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs: by default those that a rule decides. Every URL is judged.
Defined cases: a null URL, or one without ``://``, has an empty host and path and fits no rule; it is judged by
the trees on the features of an empty host. Repeated rows are judged alike, each on its own. Without labelled
URLs of both verdicts there is nothing to learn and the verdict of the one known class (else ``allow``) holds.
Extra columns pass through ``judge``; its five own columns replace those of the same name. Names that begin with ``__``
are for working columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lower_ascii, store


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# Fixed values of the query: the rules, as verdict, host and path prefix.
QUERY_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

FEATURES = tuple(f"__f_{x}" for x in (
    "url_chars", "host_chars", "path_chars", "depth", "labels", "digit_ratio", "hyphens", "entropy", "params",
    "has_fragment", "is_https", "log_suffix_urls", "log_site_urls", "log_site_hosts"))


def with_host_path(urls: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``."""
    u = F.coalesce(F.col(url), F.lit(""))
    scheme = F.substring_index(u, "://", 1)  # the whole url without one, which leaves nothing after it
    rest = F.substring(u, F.length(scheme) + 4, F.length(u))
    return urls.withColumns({
        host: lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        path: F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    })


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null when none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):  # the longest is tested first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.host + r.path)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _entropy(s: Column) -> Column:
    """Shannon entropy of a string's characters, in bits."""
    n = F.length(s).cast("double")

    def over(chars: Column) -> Column:
        return F.aggregate(chars, F.lit(0.0), lambda acc, c: let(
            (F.length(s) - F.length(F.replace(s, c, F.lit("")))) / n, lambda p: acc - p * F.log2(p)))

    return F.when(F.length(s) > 0, over(F.array_distinct(F.split(s, "")))).otherwise(F.lit(0.0))


def with_features(urls: DataFrame, url: str = "url") -> DataFrame:
    """Lexical features of each URL (needs ``host`` and ``path``). The suffix statistics count all URLs."""
    u = F.coalesce(F.col(url), F.lit(""))
    host = F.col("host")
    suffix, site = F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)
    df = urls.withColumns({"__suffix": suffix, "__site": site})
    by_host = df.groupBy("__suffix", "__site", "host").agg(F.count("*").alias("__n"))
    by_site = by_host.groupBy("__suffix", "__site").agg(F.sum("__n").alias("__n"), F.count("*").alias("__hosts"))
    sites = by_site.select("__site", F.log1p(F.col("__n").cast("double")).alias("__f_log_site_urls"),
                           F.log1p(F.col("__hosts").cast("double")).alias("__f_log_site_hosts"))
    suffixes = by_site.groupBy("__suffix").agg(
        F.log1p(F.sum("__n").cast("double")).alias("__f_log_suffix_urls"))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return df.join(sites, "__site").join(suffixes, "__suffix").withColumns({
        "__f_url_chars": F.length(u).cast("double"),
        "__f_host_chars": F.length(host).cast("double"),
        "__f_path_chars": F.length("path").cast("double"),
        "__f_depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
        "__f_labels": F.size(F.filter(F.split(host, r"\."), lambda x: x != "")).cast("double"),
        "__f_digit_ratio": F.when(F.length(u) > 0, F.length(F.regexp_replace(u, "[^0-9]", ""))
                              / F.length(u)).otherwise(0.0).cast("double"),
        "__f_hyphens": (F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).cast("double"),
        "__f_entropy": _entropy(u),
        "__f_params": F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"),
        "__f_has_fragment": F.contains(u, F.lit("#")).cast("double"),
        "__f_is_https": F.startswith(u, F.lit("https://")).cast("double"),
    }).drop("__site", "__suffix")


def fit(labelled: DataFrame, max_rows: int = 20_000, trees: int = 10, depth: int = 4):
    """Boosted trees on rows with FEATURES and ``blocked`` (0.0 or 1.0).

    Learns from the ``max_rows`` distinct rows of smallest hash, so a run repeats. None when only one class is there.
    """
    cols = [*FEATURES, "blocked"]
    sample = labelled.select(*cols).distinct().orderBy(F.xxhash64(*cols), *cols).limit(max_rows)
    sample = store(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
                   .select("features", "blocked").coalesce(1), "url-sample")
    if sample.select("blocked").distinct().count() < 2:
        return None
    return GBTClassifier(labelCol="blocked", maxIter=trees, maxDepth=depth, seed=7).fit(sample)


def judge(urls: DataFrame, rules=QUERY_RULES, url: str = "url", max_rows: int = 20_000) -> DataFrame:
    """Adds host, path, rule (null if none fits), verdict and ``by`` (rule or model) to every row."""
    df = urls.drop("host", "path", "rule", "verdict", "by")
    df = with_host_path(df, url)
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    df = with_features(df.withColumns({"rule": rule, "__ruled": ruled}), url)
    df = store(df, "url-features")
    labelled = df.where("__ruled is not null").withColumn("blocked", (F.col("__ruled") == "block").cast("double"))
    model = fit(labelled, max_rows)
    if model is None:
        only = labelled.agg(F.min("__ruled").alias("v")).first()["v"] or "allow"
        judged = df.withColumn("__model", F.lit(only))
    else:
        vec = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(df)
        model.setFeaturesCol("__features").setPredictionCol("__p").setRawPredictionCol("").setProbabilityCol("")
        judged = model.transform(vec).withColumn("__model", F.when(F.col("__p") > 0.5, "block").otherwise("allow"))
    return judged.withColumns({
        "verdict": F.coalesce("__ruled", "__model"),
        "by": F.when(F.col("__ruled").isNotNull(), "rule").otherwise("model"),
    }).drop("__ruled", "__model", "__features", "__p", *FEATURES)
