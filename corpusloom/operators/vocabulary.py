"""A counted vocabulary, and texts as fixed-length arrays of its ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.tokens import WHITESPACE
from corpusloom.session import materialize

PAD, UNKNOWN = 0, 1
#: Largest vocabulary: it is sent to every executor, a few MB.
MOST = 1 << 17


def build_vocabulary(df: DataFrame, text: str = "text", size: int = 30_000, least: int = 1, tokenizer=None) -> DataFrame:
    """``token``, ``n`` and ``id``: the ``size`` most frequent tokens with ``least`` occurrences, the most frequent first,
    equals in byte order. Ids begin after ``PAD`` and ``UNKNOWN``.

    All tokens of all texts are counted (before the shuffle, then after it); only the ``size`` first of the counts meet in
    one task, each task sending its own ``size`` first.
    """
    if not 0 < size <= MOST:
        raise ValueError(f"a vocabulary has 1 to {MOST} tokens, not {size}")
    tokens = df.select(F.explode((tokenizer or WHITESPACE).tokens(F.col(text))).alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    order = [F.desc("n"), F.asc("token")]
    top = counts.orderBy(*order).limit(size)
    ranked = top.withColumn("id", (F.row_number().over(W.orderBy(*order)) + UNKNOWN).cast("int"))
    return materialize(ranked, "vocabulary")


def encode_vocabulary(
    df: DataFrame, vocabulary: DataFrame, key: str = "doc_id", text: str = "text", length: int = 512, tokenizer=None
) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` of exactly ``length`` entries; tokens the vocabulary lacks are ``UNKNOWN``.

    The first ``length`` tokens of a text meet the vocabulary in a broadcast join (it is no larger than ``MOST``); a
    text's ids are gathered again where its tokens are, so what is shuffled is an array of ids per text. ``key`` is
    unique. A null text is all padding.
    """
    tokens = F.slice((tokenizer or WHITESPACE).tokens(F.col(text)), 1, length)
    spoken = df.select(F.col(key).alias("_key"), F.posexplode(tokens).alias("pos", "token"))
    known = spoken.join(F.broadcast(vocabulary.select("token", "id")), "token", "left")
    own = F.struct("pos", F.coalesce("id", F.lit(UNKNOWN)).alias("id"))
    ids = known.groupBy("_key").agg(F.array_sort(F.collect_list(own)).alias("_ids"))
    real = F.coalesce(F.col("_ids.id"), F.array().cast("array<int>"))
    padded = lambda values, fill: F.slice(F.concat(values, F.array_repeat(F.lit(fill).cast("int"), length)), 1, length)
    joined = df.join(ids, F.col(key) == F.col("_key"), "left")
    return joined.select(
        *df.columns,
        padded(real, PAD).alias("input_ids"),
        padded(F.transform(real, lambda _: F.lit(1)), 0).alias("attention_mask"),
    )
