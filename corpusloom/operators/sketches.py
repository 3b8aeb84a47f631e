"""Profiles and distinct counts that are stored small and added up later, without the texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.aggregates import with_lengths

#: Size of the quantile sketches, and the error of a quantile's rank that it brings (99 % of the time, as a share of all).
KLL_K, KLL_ERROR = 800, 0.005
#: Size of the sets' sketches as a power of two, and the error of a count that it brings (three standard errors).
THETA_K, THETA_ERROR = 14, 3 / 2**7
_LENGTHS = (("tokens", "token_count"), ("chars", "char_count"), ("words", "word_count"))


def length_sketches(df: DataFrame, by: Sequence[str], text: str = "text", tokenizer=None) -> DataFrame:
    """One row per value of ``by`` (a file, say): counts, sums, least and largest lengths, and quantile sketches."""
    lengths = with_lengths(df, text, tokenizer)
    aggs = [F.count("*").alias("n")]
    for name, column in _LENGTHS:
        value = F.col(column).cast("bigint")
        aggs += [
            F.sum(value).alias(f"{name}_sum"), F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max"),
            F.kll_sketch_agg_bigint(value, F.lit(KLL_K)).alias(f"{name}_sketch"),
        ]
    return lengths.groupBy(*by).agg(*aggs)


def merge_length_sketches(
    sketches: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = (0.5, 0.95)
) -> DataFrame:
    """The profile of all rows behind the stored sketches, per value of ``by``: means, least and largest are exact,
    quantiles within ``KLL_ERROR`` of their rank."""
    aggs = [F.sum("n").alias("total_samples")]
    for name, _ in _LENGTHS:
        merged = F.kll_merge_agg_bigint(F.col(f"{name}_sketch"), F.lit(KLL_K))
        aggs += [
            (F.sum(f"{name}_sum") / F.sum("n")).alias(f"{name}_mean"),
            F.min(f"{name}_min").alias(f"{name}_min"),
            F.max(f"{name}_max").alias(f"{name}_max"),
            *[F.kll_sketch_get_quantile_bigint(merged, F.lit(q)).alias(f"{name}_q{round(q * 100)}") for q in quantiles],
        ]
    return sketches.groupBy(*by).agg(*aggs)


def key_sketch(df: DataFrame, keys: Sequence[str] = ("text",), by: Sequence[str] = ()) -> DataFrame:
    """``rows`` and ``keys`` (a theta sketch of the distinct keys) per value of ``by``; null keys count as equal."""
    digest = F.to_json(F.struct(*[F.col(k).alias(str(i)) for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.theta_sketch_agg(digest, F.lit(THETA_K)).alias("keys"))


def overlap(left: Column, right: Column) -> list[Column]:
    """Distinct keys of either and of both, and what they share, within ``THETA_ERROR`` of the count of either or both."""
    size = lambda sketch, name: F.theta_sketch_estimate(sketch).alias(name)
    return [
        size(left, "left_keys"), size(right, "right_keys"), size(F.theta_union(left, right), "all_keys"),
        size(F.theta_intersection(left, right), "shared_keys"),
    ]
