"""Order-dependent steps: caps per group, batches, shuffles and best-of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.text import ellipsize
from corpusloom.operators.split import order_hash

SALTS = 1024
_PREFIX = 4


def _columns(value) -> list:
    return list(value) if isinstance(value, (list, tuple)) else [value]


def cap_per_group(
    df: DataFrame, key: str | Sequence[str], order, n: int, rank: str | None = None, salts: int = SALTS
) -> DataFrame:
    """The first ``n`` rows of every group in ``order`` (which must be total within a group).

    Two rounds: first within (group, salt), then within the group. The salt is the input partition, so a map
    task sends at most ``n`` rows of a group, all to one salt: with M map tasks a group with a third of all
    rows costs a first-round task ``n * M / salts`` rows and the last one ``n * salts``, never the group.
    """
    keys, order = _columns(key), _columns(order)
    name = rank or "_rank"
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    first = F.row_number().over(W.partitionBy(*keys, "_salt").orderBy(*order))
    second = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    capped = salted.withColumn(name, first).where(F.col(name) <= n).drop("_salt", name)
    capped = capped.withColumn(name, second).where(F.col(name) <= n)
    return capped if rank else capped.drop(name)


def limit_per_source(
    df: DataFrame, limit: int, order, source: str = "source", kind: str = "type", salts: int = SALTS
) -> DataFrame:
    """Half the limit for posts and half for comments of every source."""
    return cap_per_group(df, [source, kind], order, limit // 2, salts=salts)


def order_by_helpfulness(df: DataFrame) -> DataFrame:
    """Most upvoted first within each title, arrival order among equals."""
    return df.orderBy("movie_id", F.desc("upvotes"), "page", "pos")


def error_samples(
    df: DataFrame, n: int = 3, key: str = "doc_id", text: str = "text", width: int = 100, by: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` wrong rows per true and original label, with the text cut to ``width`` characters."""
    labels = ["binary_label", "original_label"]
    wrong = df.where(~F.col("correct")).select(
        *by, *labels, "predicted_binary", key, ellipsize(text, width).alias("excerpt")
    )
    return cap_per_group(wrong, [*by, *labels], key, n, rank="sample")


def assign_batches(df: DataFrame, key: str = "row_id", size: int = 10) -> DataFrame:
    """Add ``batch_id`` and ``batch_pos``: consecutive batches of exactly ``size`` rows, the last may be short.

    ``key`` must be unique. Rows are numbered in hash order of the key. Buckets of the hash are counted, their running totals
    (at most 65,536 rows) are broadcast, and rows are ranked inside their bucket only.
    """
    hashed = df.withColumn("_hash", F.md5(F.col(key).cast("string")))
    bucket = F.substring("_hash", 1, _PREFIX)
    counts = hashed.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    below = F.sum("_rows").over(W.partitionBy(F.lit(0)).orderBy("_bucket")) - F.col("_rows")
    offsets = counts.select("_bucket", below.alias("_below"))
    within = F.row_number().over(W.partitionBy("_bucket").orderBy("_hash", key))
    position = F.col("_below") + F.col("_within") - 1
    return (
        hashed.withColumn("_bucket", bucket)
        .withColumn("_within", within)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("batch_id", F.floor(position / size).cast("bigint"))
        .withColumn("batch_pos", F.pmod(position, F.lit(size)).cast("int"))
        .select(*df.columns, "batch_id", "batch_pos")
    )


def shuffle_rows(df: DataFrame, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """All rows in a reproducible random order (a range-partitioned sort)."""
    return df.orderBy(order_hash(key, seed), key)


def best(df: DataFrame, metric: str, rank: str | Column) -> DataFrame:
    """The row with the largest metric; the lowest ``rank`` among equals."""
    return df.orderBy(F.desc(metric), rank).limit(1)
