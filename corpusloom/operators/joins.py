"""Lookups, alignment by position and resume. Which side is broadcast is left to the optimizer, which goes by bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup(df: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Attach the dimension's columns; a key the dimension lacks gets nulls."""
    return df.join(dim, [key] if isinstance(key, str) else list(key), "left")


def align_answers(batches: DataFrame, answers: DataFrame, by: str = "batch_id") -> DataFrame:
    """Pair the k-th text of a batch with its k-th answer.

    ``batches``: ``by, pos, ...`` one row per text, ``n_texts`` per batch; ``answers``: ``by, answers`` (array). A batch
    whose two counts differ is dropped whole.
    """
    exploded = answers.where(F.col("answers").isNotNull()).select(
        by,
        F.size("answers").alias("_n_answers"),
        F.posexplode("answers").alias("pos", "answer"),
    )
    return (
        batches.join(exploded, [by, "pos"], "inner")
        .where(F.col("n_texts") == F.col("_n_answers"))
        .drop("_n_answers")
    )


def pending(df: DataFrame, done: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows whose key is not done yet."""
    return df.join(done.select(key), key, "left_anti")


def join_predictions(df: DataFrame, predictions: DataFrame, key: str = "doc_id") -> DataFrame:
    """Attach externally computed predictions by key."""
    return df.join(predictions, key, "inner")


def split_leakage(df: DataFrame, text: str = "text", split: str = "split") -> DataFrame:
    """The rows whose text is in more than one split. Only digests are grouped; null texts leak nothing."""
    keyed = df.withColumn("_digest", F.sha2(F.col(text), 256))
    shared = keyed.groupBy("_digest").agg(F.min(split).alias("_lo"), F.max(split).alias("_hi")).where("_lo < _hi")
    return keyed.join(shared, "_digest", "left_semi").drop("_digest")


def with_totals(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, total, n_classes)``: the totals ride on every class row, as a scalar subquery."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("total"), F.count("*").alias("n_classes")))
    return counts.withColumn("_t", totals.scalar()).select(label, "n", "_t.total", "_t.n_classes")
