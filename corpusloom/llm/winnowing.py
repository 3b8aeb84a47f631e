"""Benchmark decontamination by winnowing, in DataFrame functions alone.

A text's fingerprints are the least hashes of ``GRAM`` consecutive words among each ``SPAN`` neighbours. Any
``WINDOW`` words hold one, chosen by these words alone, so a document that shares a window with an item shares a
fingerprint with it. Fingerprints are joined; documents with a hit have their full windows looked up in the items'.
Items shorter than a window are one window, found through the least of their words' hashes.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import id_or_null, row_id, text_tag
from corpusloom.session import materialize

WINDOW, GRAM = 13, 6
SPAN = WINDOW - GRAM + 1
#: The items' side of a join is broadcast up to so many rows of two longs, 16 MB; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """Words of a text with A-Z in lower case; none of a null text."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, _BREAKS), "")


def _hashes(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """``n`` words and their hashes ``h``."""
    read = df.select(*keep, words(text).alias("w"))
    return read.select(*keep, F.size("w").cast("long").alias("n"), F.transform("w", lambda w: F.xxhash64(w)).alias("h"))


def _grams(values: str, size: int) -> Column:
    """Hashes of every ``size`` consecutive values, by start."""
    places = F.sequence(F.lit(0), F.size(values) - size)
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(F.col(values), i + j) for j in range(size)]))
    return F.when(F.size(values) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def fingerprints(hashed: DataFrame, *keep: str) -> DataFrame:
    """``keep``, the number of words ``n`` and the distinct winnowed hashes ``prints`` of texts of a window at least."""
    grams = hashed.select(*keep, "n", _grams("h", GRAM).alias("g"))
    places = F.sequence(F.lit(1), F.size("g") - SPAN + 1)
    least = F.array_distinct(F.transform(places, lambda i: F.array_min(F.slice("g", i, SPAN))))
    none = F.array().cast("array<bigint>")
    return grams.select(*keep, "n", F.when(F.size("g") >= SPAN, least).otherwise(none).alias("prints"))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast, if the frame is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _windows(df: DataFrame, text: str, length: int, *keep: str) -> DataFrame:
    """A row per window of ``length`` words: its place and hash."""
    hashed = _hashes(df, text, *keep).select(*keep, _grams("h", length).alias("g"))
    return hashed.select(*keep, F.posexplode("g").alias("pos", "hash"), F.lit(length).alias("len"))


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_words``, ``n_hit`` (words inside any occurrence of an item's window) and
    ``items`` (ids of the items with such a window, as sorted strings).

    Null and empty texts have no words and no windows, as documents and as items. Rows with the same key and text
    get the same result each; rows with the same key and different texts stay apart. Null item ids are not listed,
    but their windows count. Windows are compared by 64-bit hashes of the words' 64-bit hashes.
    """
    rows = docs.select(row_id(key).alias("id"), text_tag(text).alias("tag"), F.col(text).alias("_text"))
    tests = items.select(F.col(item).cast("string").alias("item"), F.col(text).alias("_text"))
    sizes = materialize(_hashes(tests, "_text", "item"), "items").where("n > 0")
    lengths = [r[0] for r in sizes.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect()]  # 13 at most
    tests_by_hash = materialize(
        reduce(
            DataFrame.union,
            [
                (sizes.where(f"n >= {WINDOW}") if length == WINDOW else sizes.where(f"n = {length}"))
                .select("item", F.explode(_grams("h", length)).alias("hash"), F.lit(length).alias("len"))
                for length in sorted(lengths)
            ],
            sizes.select("item", F.lit(0).cast("bigint").alias("hash"), F.lit(0).alias("len")).limit(0),
        ),
        "windows",
    )
    keys = _small(tests_by_hash.select("hash", "len").distinct())

    prints = fingerprints(sizes).select(F.explode("prints").alias("print")).distinct()
    exploded = fingerprints(_hashes(rows, "_text", "id", "tag"), "id", "tag").select("id", "tag", "n", F.explode_outer("prints").alias("print"))
    met = exploded.join(_small(prints.withColumn("met", F.lit(True))), "print", "left")
    # a task holds all rows of a document, so this collapses before the shuffle
    counted = materialize(
        met.groupBy("id", "tag").agg(F.max("n").alias("n_words"), F.coalesce(F.max("met"), F.lit(False)).alias("met")),
        "counted",
    )
    found = []
    for length in lengths:
        if length == WINDOW:
            likely = counted.where("met").select("id", "tag")
        else:
            rare = sizes.where(f"n = {length}").select(F.array_min("h").alias("word")).distinct()
            spoken = _hashes(rows, "_text", "id", "tag").select("id", "tag", F.explode(F.array_distinct("h")).alias("word"))
            likely = spoken.join(_small(rare), "word", "left_semi").select("id", "tag").distinct()
        near = rows.join(materialize(likely, "likely"), ["id", "tag"], "left_semi").dropDuplicates(["id", "tag"])
        found.append(_windows(near, "_text", length, "id", "tag").join(keys, ["hash", "len"], "left_semi"))
    none = counted.select(F.lit(0).cast("bigint").alias("hash"), F.lit(0).alias("len"), "id", "tag", F.lit(0).alias("pos"))
    hits = materialize(reduce(DataFrame.unionByName, found, none.limit(0)), "hits")

    before = W.partitionBy("id", "tag").orderBy("pos", "len").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("pos") + F.col("len")
    own = F.greatest(end - F.greatest("pos", F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    covered = hits.select("id", "tag", own.alias("own")).groupBy("id", "tag").agg(F.sum("own").alias("n_hit"))
    listed = (
        hits.select("id", "tag", "hash", "len").distinct()
        .join(_small(tests_by_hash), ["hash", "len"])
        .groupBy("id", "tag")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    result = counted.join(covered, ["id", "tag"], "left").join(listed, ["id", "tag"], "left")
    return (
        rows.select("id", "tag")
        .join(result, ["id", "tag"])
        .select(
            id_or_null(F.col("id")).alias(key),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
