"""Frame-level truncation and chunking, tokenising every text once."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.tokens import WHITESPACE, is_blank, word_count

STRATEGIES = ("simple", "smart_truncate", "chunk")


def chunk(
    df: DataFrame, column: str = "text", limit: int = T.CONTENT_LIMIT, overlap: int = 50, tokenizer=None
) -> DataFrame:
    """One row per chunk: ``column`` holds the chunk, ``chunk_pos`` its position. Null text is one null chunk."""
    pieces = F.coalesce(T.chunks(column, limit, overlap, tokenizer), F.array(F.lit(None).cast("string")))
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.posexplode(pieces).alias("chunk_pos", column))


def encode_fixed(
    df: DataFrame, column: str = "text", length: int = 512, tokenizer=None, buckets: int = 2**18
) -> DataFrame:
    """Add ``input_ids`` (1 to ``buckets``, 0 is padding) and ``attention_mask`` of exactly ``length`` entries."""
    encoded = T.fixed_length_ids(column, length, buckets, tokenizer=tokenizer)
    return df.withColumn("_encoded", encoded).select(*df.columns, "_encoded.input_ids", "_encoded.attention_mask")


def with_truncation_record(
    df: DataFrame, column: str = "text", limit: int = T.CONTENT_LIMIT, out: str = "record", tokenizer=None
) -> DataFrame:
    """Add the truncation record of ``column`` as a struct; null for null or blank text."""
    if tokenizer is None:
        return df.withColumn(out, T.truncation_record(column, limit))
    text = F.col(column)
    steps = df.withColumn("_tokens", tokenizer.tokens(text)).withColumn("_n", F.size("_tokens"))
    steps = steps.withColumn("_cut", T.smart_truncate(text, limit, tokenizer, F.col("_tokens")))
    steps = steps.withColumn("_m", tokenizer.count("_cut"))
    fields = T.truncation_fields(text, F.col("_cut"), F.col("_n"), F.col("_m"), limit)
    return steps.withColumn(out, F.when(~is_blank(text), fields)).drop("_tokens", "_n", "_cut", "_m")


def shorten(
    df: DataFrame,
    column: str = "text",
    strategy: str = "smart_truncate",
    limit: int = T.CONTENT_LIMIT,
    overlap: int = 50,
    tokenizer=None,
    keep_original: bool = False,
) -> DataFrame:
    """Bring every text within ``limit`` tokens, by ``simple``, ``smart_truncate`` or ``chunk``.

    Output: the input with ``column`` shortened, ``original_tokens``, ``was_truncated`` and the length
    columns of the new text; ``chunk`` adds ``chunk_pos`` and keeps all tokens. ``keep_original`` adds
    ``original_chars`` and ``original_words``.
    """
    if strategy not in STRATEGIES:
        warnings.warn(f"unknown strategy {strategy!r}, using smart_truncate", stacklevel=2)
        strategy = "smart_truncate"
    tk = tokenizer or WHITESPACE
    tokenised = df.withColumn("_tokens", tk.tokens(column)).withColumn(
        "original_tokens", F.size("_tokens").cast("bigint")
    )
    tokens = F.col("_tokens")
    kept = ["original_tokens"]
    if keep_original:
        words = F.col("original_tokens") if tokenizer is None else word_count(column).cast("bigint")
        tokenised = tokenised.withColumns(
            {"original_chars": F.length(column).cast("bigint"), "original_words": words}
        )
        kept += ["original_chars", "original_words"]
    if strategy == "chunk":
        pieces = F.coalesce(
            T.chunks(column, limit, overlap, tokenizer, tokens), F.array(F.lit(None).cast("string"))
        )
        others = [c for c in df.columns if c != column]
        out = tokenised.select(*others, *kept, F.posexplode(pieces).alias("chunk_pos", column))
    else:
        cut = (
            T.truncate(column, limit, "head", tokenizer, tokens)
            if strategy == "simple"
            else T.smart_truncate(column, limit, tokenizer, tokens)
        )
        out = tokenised.withColumn(column, cut).drop("_tokens")
    over = F.col("original_tokens") > limit
    # Only shortened texts are counted again.
    out = out.withColumns(
        {
            "was_truncated": over,
            "token_count": F.when(over, tk.count(column).cast("bigint")).otherwise(F.col("original_tokens")),
            "char_count": F.length(column).cast("bigint"),
        }
    )
    words = F.col("token_count") if tokenizer is None else word_count(column).cast("bigint")
    return out.withColumn("word_count", words).withColumn("token_bin", T.length_bin("token_count"))
