"""Counts, length profiles, sentence labels and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import CONTENT_LIMIT, LENGTH_BINS, length_bin
from corpusloom.functions.tokens import char_count, token_count, word_count
from corpusloom.session import materialize


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return sort_counts(counts, column)


def sort_counts(df: DataFrame, key: str, count: str = "count") -> DataFrame:
    """Largest count first, ties by key."""
    return df.orderBy(F.desc(count), F.asc(key))


def words_to_sentences(words: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Word rows to one row per distinct sentence (and ``keys``).

    A sentence with any word labelled 1 is a metaphor. The null sentence counts no words.
    """
    hit = (F.col("label") == 1) & F.col("sentence").isNotNull()
    grouped = words.groupBy(*keys, F.col("sentence").alias("text")).agg(
        F.count("sentence").alias("num_words"), F.count_if(hit).alias("num_metaphors")
    )
    return grouped.select(
        *keys,
        "text",
        F.when(F.col("num_metaphors") > 0, "metaphor").otherwise("literal").alias("label"),
        "num_words",
        "num_metaphors",
        F.coalesce(F.try_divide(F.col("num_metaphors"), F.col("num_words")), F.lit(0.0)).alias("metaphor_ratio"),
    )


def with_lengths(df: DataFrame, column: str = "text", tokenizer=None) -> DataFrame:
    """Add ``token_count, char_count, word_count, token_bin``; the text is tokenised once."""
    counted = df.withColumns(
        {
            "token_count": token_count(column, tokenizer).cast("bigint"),
            "char_count": char_count(column).cast("bigint"),
            **({} if tokenizer is None else {"word_count": word_count(column).cast("bigint")}),
        }
    )
    if tokenizer is None:
        counted = counted.withColumn("word_count", F.col("token_count"))
    return counted.withColumn("token_bin", length_bin("token_count"))


def length_stats(
    df: DataFrame,
    column: str = "text",
    limit: int = CONTENT_LIMIT,
    by: Sequence[str] = (),
    tokenizer=None,
    approximate: bool = False,
) -> DataFrame:
    """Length profile: tokens, characters and words, and how many texts exceed ``limit`` tokens.

    A frame that already has the ``with_lengths`` columns is not tokenised again. The exact median keeps
    one counter per distinct length, so its memory follows the longest text, not the number of rows;
    ``approximate`` bounds it outright.
    """
    have = {"token_count", "char_count", "word_count"} <= set(df.columns)
    lengths = df if have else with_lengths(df, column, tokenizer)
    median = (lambda c: F.percentile_approx(c, 0.5, 10_000).cast("double")) if approximate else F.median
    over = F.count_if(F.col("token_count") > limit)
    aggs = [F.count("*").alias("total_samples")]
    for name, c in (("tokens", "token_count"), ("chars", "char_count"), ("words", "word_count")):
        aggs += [F.avg(c).alias(f"{name}_mean"), median(c).alias(f"{name}_median"), F.max(c).alias(f"{name}_max")]
    aggs += [
        F.min("token_count").alias("tokens_min"),
        F.stddev_samp("token_count").alias("tokens_std"),
        over.alias("over_limit_count"),
        (F.try_divide(over, F.count("*")) * 100).alias("over_limit_pct"),
    ]
    return lengths.groupBy(*by).agg(*aggs)


def length_histogram(df: DataFrame, value: str = "token_count", short_labels: bool = False) -> DataFrame:
    """``(bin_rank, token_bin, count)``: every bin in order, empty ones as 0."""
    names = [short if short_labels else label for _, label, short in LENGTH_BINS]
    # by the exact length first: each text is tokenised once, and the bins are of a few thousand lengths
    exact = df.groupBy(F.col(value).alias("_length")).agg(F.count("*").alias("_n"))
    counts = exact.groupBy(length_bin("_length", short_labels).alias("token_bin")).agg(F.sum("_n").alias("count"))
    # Zero rows for all bins instead of a join: the union is at most fifteen rows.
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("name")) for i, n in enumerate(names)]))
    one = df.sparkSession.range(1).select(rows.alias("b"))
    empty = one.select(F.col("b.name").alias("token_bin"), F.lit(0).cast("bigint").alias("count"))
    ranked = counts.where(F.col("token_bin").isNotNull()).unionByName(empty)
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("token_bin")) - 1
    return (
        ranked.groupBy(rank.cast("int").alias("bin_rank"), "token_bin")
        .agg(F.sum("count").alias("count"))
        .orderBy("bin_rank")
    )


def truncation_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals, truncation rate (%) and mean and maximum tokens before and after."""
    cut = F.count_if("was_truncated")
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        cut.alias("truncated"),
        (F.try_divide(cut, F.count("*")) * 100).alias("truncation_rate"),
        F.avg("original_tokens").alias("mean_original_tokens"),
        F.avg("final_tokens").alias("mean_final_tokens"),
        F.max("original_tokens").alias("max_original_tokens"),
        F.max("final_tokens").alias("max_final_tokens"),
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, n, share, weight, weight_ratio)`` with balanced weights ``total / (classes * n)``.

    ``share`` is in percent; ``weight_ratio`` is relative to the first label in order. A null label is no class and is
    not counted.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(
        F.struct(
            F.sum("n").alias("total"), F.count("*").alias("n_classes"), F.min_by("n", label).alias("first_n")
        )
    )
    n, total = F.col("n"), F.col("_t.total")
    return counts.withColumn("_t", totals.scalar()).select(
        label,
        "n",
        (n / total * 100).alias("share"),
        (total / (F.col("_t.n_classes") * n)).alias("weight"),
        (F.col("_t.first_n") / n).alias("weight_ratio"),
    )


def attach_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Put each row's class weight on it; a row without a label keeps a null weight."""
    # written, so that the optimizer knows how small it is
    weights = materialize(class_weights(df, label).select(label, F.col("weight").alias(out)), "weights")
    return df.join(weights, label, "left")


def require_classes(df: DataFrame, label: str = "label", at_least: int = 2) -> DataFrame:
    """The frame itself, or ``ValueError`` when it has fewer classes."""
    found = df.select(label).where(F.col(label).isNotNull()).distinct().limit(at_least).count()
    if found < at_least:
        raise ValueError(f"only {found} class(es) in {label!r}, need {at_least}")
    return df


def dedupe_report(
    df: DataFrame, keys: Sequence[str] = ("text",), by: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Rows before and after keeping one per key; null keys count as equal."""
    key = F.struct(*keys)
    kept = F.approx_count_distinct(key, 0.01) if approximate else F.count_distinct(key)
    return df.groupBy(*by).agg(F.count("*").alias("rows_before"), kept.alias("rows_after"))


def split_report(df: DataFrame, labels: Sequence[str], label: str = "label", split: str = "split") -> DataFrame:
    """Rows per split and class, and in total."""
    counts = df.groupBy(split, label).agg(F.count("*").alias("n"))
    per_class = [
        F.coalesce(F.sum(F.when(F.col(label) == name, F.col("n"))), F.lit(0).cast("bigint")).alias(name)
        for name in labels
    ]
    return counts.groupBy(split).agg(*per_class, F.sum("n").alias("total"))
