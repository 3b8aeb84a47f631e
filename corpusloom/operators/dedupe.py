"""Keep-first deduplication. "First" always means an explicit, unique order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.normalize import normalize_title, normalize_url
from corpusloom.session import materialize
from corpusloom.sinks.ledger import Ledger


def _as_list(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _order_value(order: list[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def dedupe_first(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order``. Null keys count as equal.

    An aggregate, not a window: copies collapse before the shuffle, so a key with a third of all rows
    reaches its reducer as one row per map task.
    """
    keys, order = _as_list(keys), _as_list(order)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), _order_value(order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[c if c in keys else f"_first.{c}" for c in df.columns])


def url_title_winners(
    df: DataFrame, order: str | Sequence[str], source: str = "source", url: str = "url", title: str = "title"
) -> DataFrame:
    """The ``order`` columns of the rows that survive both passes.

    Pass one keeps the first row per normalised URL within a source, pass two the first per normalised
    title among the survivors. A null URL or an empty title exempts a row from that pass. Only keys travel.
    """
    order = _as_list(order)
    exempt = lambda key: F.when(F.col(key).isNull(), F.struct(*order))
    narrow = df.select(
        F.col(source).alias("_source"),
        normalize_url(url).alias("_url"),
        F.nullif(normalize_title(title), F.lit("")).alias("_title"),
        *order,
    )
    by_url = (
        narrow.groupBy("_source", "_url", exempt("_url").alias("_own"))
        .agg(F.min_by(F.struct("_title", *order), _order_value(order)).alias("_row"))
        .select("_source", "_row.*")
    )
    by_title = by_url.groupBy("_source", "_title", exempt("_title").alias("_own")).agg(
        F.min(F.struct(*order)).alias("_row")
    )
    return by_title.select("_row.*")


def dedupe_url_title(
    df: DataFrame, order: str | Sequence[str], source: str = "source", url: str = "url", title: str = "title"
) -> DataFrame:
    """Rows that are first by URL and then by title within their source."""
    winners = url_title_winners(df, order, source, url, title)
    return df.join(winners, _as_list(order), "left_semi")


#: The index column of ``dedupe_arrivals``; a null text has a digest of its own.
DIGEST = "digest"


def _digest(key: str) -> Column:
    return F.coalesce(F.unhex(F.sha2(F.col(key).cast("binary"), 256)), F.lit(b"null"))


def dedupe_arrivals(df: DataFrame, index: str, batch: str, key: str = "text", order: str = "doc_id") -> DataFrame:
    """``dedupe_first`` over a corpus that arrives in batches: the rows of this batch that are first so far, with
    ``replaces``, the order of the row that was first before (null mostly).

    Old texts are never read again: ``index`` keeps a digest (SHA-256) of each key and its least order, in hash buckets, and
    only the buckets this batch touches are read. The batch counts from when the index says so; the same batch delivered
    again gives the same rows. Batches may come in any order: ``first_arrivals`` is always what ``dedupe_first`` would
    keep of all of them.
    """
    spark = df.sparkSession
    ledger = Ledger(spark, index, DIGEST)
    if ledger.has(batch):
        mine = _entries(ledger.known()).where(F.col("batch") == batch)
    else:
        own = df.groupBy(_digest(key).alias(DIGEST)).agg(F.min(order).alias("first"))
        own = materialize(own.withColumn("batch", F.lit(batch)), "arrivals")
        known = ledger.known(own)
        before = _entries(known if known is not None else own.limit(0).withColumn("replaces", F.col("first")))
        before = before.groupBy(DIGEST).agg(F.min("first").alias("replaces"))
        fresh = own.join(before, DIGEST, "left").where("replaces IS NULL OR first < replaces")
        mine = materialize(fresh.select(DIGEST, "first", "replaces", "batch"), "firsts")
        ledger.commit(batch, mine, f"index-{batch}", mine.count())
    kept = mine.select(F.col("first").alias(order), "replaces")
    return df.join(kept, order).select(*df.columns, "replaces")


def _entries(index: DataFrame) -> DataFrame:
    return index.select(DIGEST, "first", "replaces", "batch")


def first_arrivals(spark, index: str) -> DataFrame:
    """``digest`` and ``first``: the least order of every key that has arrived."""
    known = Ledger(spark, index, DIGEST).known()
    if known is None:
        raise ValueError(f"nothing has arrived in {index}")
    return known.groupBy(DIGEST).agg(F.min("first").alias("first"))
