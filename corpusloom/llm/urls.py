"""URL filtering: rules by host and path, and boosted trees on lexical features for the URLs that no rule fits."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize

#: The trees are trained on at most so many labelled URLs, those with the least hashes.
TRAIN_ROWS = 20_000
FEATURES = (
    "length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "entropy", "params", "hyphens",
    "secure", "suffix_blocked", "suffix_seen",
)


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return _lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: str) -> Column:
    """From the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def apply_rules(df: DataFrame, rules: Sequence[tuple[str, str]], host: str = "host", path: str = "path") -> DataFrame:
    """Add ``rule`` and ``verdict`` of the longest of ``rules`` (verdict, ``host/path``) that fits, else nulls.

    A rule fits its host and all subdomains of it where the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = text.partition("/")
        fits = ((F.col(host) == name) | F.col(host).endswith("." + name)) & F.col(path).startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return df.withColumns({"rule": rule, "verdict": verdict})


def _entropy(c: str) -> Column:
    """Bits per character."""
    n = F.length(c)
    share = lambda x: (n - F.length(F.replace(F.col(c), x, F.lit("")))) / n
    letters = F.array_distinct(F.array_remove(F.split(F.col(c), ""), ""))
    bits = F.aggregate(letters, F.lit(0.0), lambda total, x: total - share(x) * F.log2(share(x)))
    return F.when(n > 0, bits).otherwise(0.0)


def suffix(host: str) -> Column:
    return F.substring_index(F.col(host), ".", -1)


def features(df: DataFrame, suffixes: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Add the lexical features; those of suffixes never seen in training are neutral."""
    text = df.withColumns({"_u": F.coalesce(F.col(url), F.lit("")), "_suffix": suffix(host)})
    count = lambda c, sign: F.length(c) - F.length(F.replace(F.col(c), F.lit(sign), F.lit("")))
    length = F.length("_u")
    digits = F.length(F.translate("_u", "0123456789", ""))
    return (
        text.join(suffixes, "_suffix", "left")
        .withColumns(
            {
                "length": length, "host_length": F.length(host), "path_length": F.length(path),
                "depth": count(path, "/"), "host_labels": count(host, ".") + 1,
                "digit_ratio": F.when(length > 0, (length - digits) / length).otherwise(0.0),
                "entropy": _entropy("_u"), "params": count("_u", "=") + count("_u", "&"), "hyphens": count(host, "-"),
                "secure": F.lower("_u").startswith("https").cast("int"),
                "suffix_blocked": F.coalesce("suffix_blocked", F.lit(0.5)),
                "suffix_seen": F.coalesce("suffix_seen", F.lit(0.0)),
            }
        )
        .drop("_u", "_suffix")
    )


def suffix_statistics(labelled: DataFrame, host: str = "host") -> DataFrame:
    """Per last label of the hosts: the smoothed share of blocked URLs and the logarithm of their number."""
    blocked = F.sum((F.col("verdict") == "block").cast("int"))
    return labelled.groupBy(suffix(host).alias("_suffix")).agg(
        ((blocked + 1) / (F.count("*") + 2)).alias("suffix_blocked"), F.log1p(F.count("*")).alias("suffix_seen")
    )


def fit(labelled: DataFrame, suffixes: DataFrame, url: str = "url", train_rows: int = TRAIN_ROWS) -> GBTClassificationModel | None:
    """Boosted trees on labelled URLs (``url``, ``host``, ``path``, ``verdict``); none without both verdicts."""
    picked = labelled.orderBy(F.xxhash64(url), url).limit(train_rows)
    rows = features(picked, suffixes, url).withColumn("label", (F.col("verdict") == "block").cast("double"))
    rows = materialize(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows).select("label", "x"), "urls")
    if rows.select("label").distinct().count() < 2:
        return None
    # a few thousand rows: more tasks would only wait for each other
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=20, maxDepth=4, seed=7)
    return trees.fit(rows.coalesce(2))


def judge(pages: DataFrame, key: str, url: str, rules: Sequence[tuple[str, str]], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row: ``key``, ``host``, ``path``, ``rule``, ``verdict`` (the longest fitting rule's, else the trees') and
    ``blocked`` (the trees' probability, where they decide).

    The rules label the URLs that the trees learn from. A null URL, or one without ``://``, has an empty host and path
    and no rule. Without labels of both kinds the trees' verdict is ``allow``. Other columns are not looked at, and
    repeated rows are judged alike.
    """
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("url"), host(url).alias("host"), path(url).alias("path"))
    ruled = materialize(apply_rules(rows, rules), "ruled")
    labelled = ruled.where(F.col("verdict").isNotNull()).select("url", "host", "path", "verdict")
    suffixes = materialize(suffix_statistics(labelled), "suffixes")
    model = fit(labelled, suffixes, "url", train_rows)
    out = ("_key", "host", "path", "rule", "verdict")
    decided = ruled.where(F.col("verdict").isNotNull()).select(*out, F.lit(None).cast("double").alias("blocked"))
    open_ = ruled.where(F.col("verdict").isNull())
    if model is None:
        judged = open_.withColumn("blocked", F.lit(0.0))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(features(open_, suffixes)))
        judged = scored.withColumn("blocked", F.element_at(vector_to_array("probability"), 2))
    judged = judged.withColumn("verdict", F.when(F.col("blocked") >= 0.5, "block").otherwise("allow"))
    return decided.unionByName(judged.select(*out, "blocked")).withColumnRenamed("_key", key)
