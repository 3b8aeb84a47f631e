"""Truncation, chunking and length functions over a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.tokens import (
    WHITESPACE,
    WHITESPACE_CLASS,
    FunctionTokenizer,
    col,
    fit_prefix,
    is_blank,
    let,
    strip,
)

CONTENT_LIMIT = 510  # 512 positions less two special tokens

# Right-closed length bins (upper bound, label, label in the collection report).
LENGTH_BINS = (
    (128, "0-128", "0-128"),
    (256, "128-256", "128-256"),
    (384, "256-384", "256-384"),
    (512, "384-512", "384-512"),
    (1024, "512-1024", "512-1K"),
    (2048, "1024-2048", "1K-2K"),
    (None, "2048+", "2K+"),
)


def _window(tokens: Column, limit: int, strategy: str) -> Column:
    if strategy == "tail":
        return F.slice(tokens, -limit, limit)
    if strategy == "middle":
        start = F.floor((F.size(tokens) - limit) / 2).cast("int")
        return F.slice(tokens, start + 1, F.lit(limit))
    return F.slice(tokens, 1, limit)


def _tokens(tk, c: Column, tokens: Column | None) -> Column:
    """The token array a caller already has as a column, else a fresh one."""
    return tk.tokens(c) if tokens is None else tokens


def truncate(
    c: Column | str, limit: int = CONTENT_LIMIT, strategy: str = "head", tokenizer=None, tokens: Column | None = None
) -> Column:
    """Keep ``limit`` tokens from the head, tail or middle; short text is returned as it is.

    An unknown strategy means head.
    """
    c, tk = col(c), tokenizer or WHITESPACE
    return let(
        F.struct(c.alias("text"), _tokens(tk, c, tokens).alias("tokens")),
        lambda s: F.when(
            F.size(s["tokens"]) > limit, tk.join(_window(s["tokens"], limit, strategy))
        ).otherwise(s["text"]),
    )


def split_sentences(c: Column | str, rule: str = "period") -> Column:
    """``period``: on ``'. '``; ``punctuation``: after ``.``, ``!`` or ``?`` at the whitespace that follows."""
    if rule == "period":
        return F.split(col(c), r"\. ")
    if rule == "punctuation":
        return F.split(col(c), rf"(?U)(?<=[.!?]){WHITESPACE_CLASS}+")
    raise ValueError(f"unknown sentence rule: {rule}")


def _sentences_with_suffix(c: Column) -> Column:
    return F.transform(split_sentences(c), lambda p: F.concat(p, F.lit(". ")))


def smart_truncate(c: Column | str, limit: int = CONTENT_LIMIT, tokenizer=None, tokens: Column | None = None) -> Column:
    """Keep whole leading sentences within ``limit`` tokens; the head when not even the first one fits."""
    c, tk = col(c), tokenizer or WHITESPACE

    def shortened(pieces: Column, kept: Column, tokens: Column) -> Column:
        return F.when(kept > 0, strip(F.array_join(F.slice(pieces, F.lit(1), kept), ""))).otherwise(
            tk.join(F.slice(tokens, 1, limit))
        )

    values = [c.alias("text"), _tokens(tk, c, tokens).alias("tokens")]
    if isinstance(tk, FunctionTokenizer):  # a Python function cannot run inside a lambda: count first
        values.append(tk.fit(_sentences_with_suffix(c), limit).alias("kept"))

    def body(s: Column) -> Column:
        if isinstance(tk, FunctionTokenizer):
            cut = let(_sentences_with_suffix(s["text"]), lambda p: shortened(p, s["kept"], s["tokens"]))
        else:
            cut = let(
                _sentences_with_suffix(s["text"]),
                lambda p: let(tk.fit(p, limit), lambda kept: shortened(p, kept, s["tokens"])),
            )
        return F.when(F.size(s["tokens"]) > limit, cut).otherwise(s["text"])

    return let(F.struct(*values), body)


def chunks(
    c: Column | str, limit: int = CONTENT_LIMIT, overlap: int = 50, tokenizer=None, tokens: Column | None = None
) -> Column:
    """Array of overlapping windows of ``limit`` tokens; short text is one chunk, unchanged."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below limit")
    c, tk = col(c), tokenizer or WHITESPACE
    stride = limit - overlap

    def windows(tokens: Column) -> Column:
        last = F.ceil((F.size(tokens) - limit) / F.lit(stride)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: tk.join(F.slice(tokens, i * stride + 1, F.lit(limit)))
        )

    return let(
        F.struct(c.alias("text"), _tokens(tk, c, tokens).alias("tokens")),
        lambda s: F.when(F.size(s["tokens"]) > limit, windows(s["tokens"])).otherwise(F.array(s["text"])),
    )


def head_tail(c: Column | str, budget: int = 450, head_ratio: float = 0.75, mode: str = "token") -> Column:
    """Keep the lead and the ending of a text longer than ``budget`` whitespace tokens.

    ``token`` cuts at tokens. ``sentence`` keeps whole sentences within both budgets and falls back to
    ``token`` when none fits.
    """
    if mode not in ("token", "sentence"):
        raise ValueError(f"unknown mode: {mode}")
    head = max(1, int(budget * head_ratio))
    tail = budget - head
    dots = F.array(F.lit("..."))

    def by_token(tokens: Column) -> Column:
        parts = [F.slice(tokens, 1, head), dots]
        if tail > 0:
            parts.append(F.slice(tokens, -tail, tail))
        return F.array_join(F.concat(*parts), " ")

    def by_sentence(s: Column) -> Column:
        def build(sentences: Column) -> Column:
            fitted = F.struct(
                fit_prefix(sentences, head, WHITESPACE.count).alias("head"),
                fit_prefix(F.reverse(sentences), tail, WHITESPACE.count).alias("tail"),
            )

            def join(kept: Column) -> Column:
                ending = F.slice(sentences, F.size(sentences) - kept["tail"] + 1, kept["tail"])
                return F.when(
                    (kept["head"] > 0) | (kept["tail"] > 0),
                    F.array_join(F.concat(F.slice(sentences, F.lit(1), kept["head"]), dots, ending), " "),
                ).otherwise(by_token(s["tokens"]))

            return let(fitted, join)

        return let(split_sentences(s["text"], "punctuation"), build)

    c = col(c)
    return let(
        F.struct(c.alias("text"), WHITESPACE.tokens(c).alias("tokens")),
        lambda s: F.when(
            F.size(s["tokens"]) > budget, by_token(s["tokens"]) if mode == "token" else by_sentence(s)
        ).otherwise(s["text"]),
    )


def ellipsize(c: Column | str, n: int) -> Column:
    """The first ``n`` characters and ``...`` when there are more."""
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def length_bin(c: Column | str, short_labels: bool = False) -> Column:
    """Label of the right-closed length bin; 0, negative and null values have none."""
    c = col(c)
    expr = F.when(c <= 0, F.lit(None).cast("string"))
    for upper, label, short in LENGTH_BINS:
        name = short if short_labels else label
        expr = expr.when(c > 0 if upper is None else c <= upper, name)
    return expr


def truncation_fields(text: Column, cut: Column, n: Column, m: Column, limit: int) -> Column:
    """The record's struct from the text, its shortened form and both token counts."""
    return F.struct(
        cut.alias("text"),
        F.length(text).cast("bigint").alias("original_chars"),
        F.length(cut).cast("bigint").alias("final_chars"),
        n.cast("bigint").alias("original_tokens"),
        m.cast("bigint").alias("final_tokens"),
        (n > limit).alias("was_truncated"),
    )


def truncation_record(c: Column | str, limit: int = CONTENT_LIMIT) -> Column:
    """Struct of the shortened text with its lengths before and after; null for null or blank text.

    For whitespace tokens; ``with_truncation_record`` takes any tokenizer.
    """
    c = col(c)

    def fields(s: Column) -> Column:
        n = F.size(s["tokens"])
        cut = smart_truncate(s["text"], limit, tokens=s["tokens"])
        return let(
            cut,
            lambda x: truncation_fields(
                s["text"], x, n, F.when(n > limit, WHITESPACE.count(x)).otherwise(n), limit
            ),
        )

    values = F.struct(c.alias("text"), WHITESPACE.tokens(c).alias("tokens"))
    return F.when(~is_blank(c), let(values, fields))


def fixed_length_ids(
    c: Column | str, length: int = 512, buckets: int = 2**18, pad_id: int = 0, tokenizer=None
) -> Column:
    """Struct ``(input_ids, attention_mask)`` of exactly ``length`` entries; ids are hashed tokens 1..buckets."""
    tk = tokenizer or WHITESPACE

    def encode(tokens: Column) -> Column:
        ids = F.transform(
            F.slice(tokens, 1, length), lambda t: (F.pmod(F.xxhash64(t), F.lit(buckets)) + 1).cast("int")
        )
        padded = lambda values, fill: F.slice(
            F.concat(values, F.array_repeat(F.lit(fill).cast("int"), length)), 1, length
        )
        return F.struct(
            padded(ids, pad_id).alias("input_ids"),
            padded(F.transform(ids, lambda _: F.lit(1)), 0).alias("attention_mask"),
        )

    return let(tk.tokens(c), encode)
