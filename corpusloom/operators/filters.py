"""Row filters, label mapping and projections."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.normalize import as_timestamp, first_filled, parse_date
from corpusloom.functions.scores import argmax_label, confidence, is_correct, softmax
from corpusloom.functions.tokens import col, is_blank, strip
from corpusloom.schemas import BINARY_LABELS, ORIGINAL_LABELS


def min_length(df: DataFrame, column: str, n: int, strip_first: bool = False) -> DataFrame:
    """Rows whose text has at least ``n`` characters; null text is dropped."""
    text = strip(column) if strip_first else F.col(column)
    return df.where(F.length(text) >= n)


def binary_label(c: Column | str) -> Column:
    """``literal`` stays, anything else (null included) is ``figurative``."""
    return F.when(col(c) == "literal", "literal").otherwise("figurative")


def to_binary(df: DataFrame, label: str = "label", out: str = "binary_label", strict: bool = False) -> DataFrame:
    """Four classes to two. ``strict`` drops null and unknown labels first."""
    if strict:
        df = keep_labels(df, ORIGINAL_LABELS, label)
    return df.withColumn(out, binary_label(label))


def label_id(c: Column | str, labels: Sequence[str] = BINARY_LABELS) -> Column:
    """Position of the label in ``labels``; null for an unknown one."""
    pairs = [F.lit(v) for i, name in enumerate(labels) for v in (name, i)]
    return F.try_element_at(F.create_map(*pairs), col(c))


def label_name(c: Column | str, labels: Sequence[str] = BINARY_LABELS) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), col(c))


def encode_label(df: DataFrame, label: str, out: str = "label_id", labels: Sequence[str] = BINARY_LABELS) -> DataFrame:
    return df.withColumn(out, label_id(label, labels))


def decode_label(df: DataFrame, ids: str, out: str = "label", labels: Sequence[str] = BINARY_LABELS) -> DataFrame:
    return df.withColumn(out, label_name(ids, labels))


def keep_labels(df: DataFrame, vocabulary: Sequence[str], label: str = "label") -> DataFrame:
    return df.where(F.col(label).isin(list(vocabulary)))


def drop_invalid(df: DataFrame, label_id_col: str = "label_id") -> DataFrame:
    """Rows with a mapped label. ``invalid_count`` tells how many the rest are."""
    return df.where(F.col(label_id_col).isNotNull())


def invalid_count(df: DataFrame, label_id_col: str = "label_id") -> DataFrame:
    return df.agg(F.count_if(F.col(label_id_col).isNull()).alias("invalid"), F.count("*").alias("total"))


def harmonise(df: DataFrame, domain: str) -> DataFrame:
    """Set ``text`` from a domain's own columns: reviews (``imdb``), ``news`` or forum (``reddit``)."""
    blank = F.lit("")
    if domain == "imdb":
        joined = F.concat(
            F.coalesce(F.col("review_title"), blank), F.lit(" "), F.coalesce(F.col("review_body"), blank)
        )
        return df.withColumn("text", strip(joined))
    if domain == "news":
        source = "text" if "text" in df.columns else "title"
        return df.withColumn("text", F.coalesce(F.col(source), blank))
    if domain == "reddit":
        if "text" not in df.columns:
            raise ValueError("forum data needs a text column")
        return df
    raise ValueError(f"unknown domain: {domain}")


TEXT_COLUMNS = ("text", "review", "body", "content", "review_body")
SENTIMENT_COLUMNS = ("sentiment_label", "sentiment", "rating")


def pick_text(df: DataFrame, out: str = "text") -> DataFrame:
    """First non-empty of the known text columns."""
    return df.withColumn(out, first_filled(df.columns, TEXT_COLUMNS))


def pick_sentiment(df: DataFrame, out: str = "original_sentiment") -> DataFrame:
    return df.withColumn(out, first_filled(df.columns, SENTIMENT_COLUMNS))


def keep_language(df: DataFrame, column: str, language: str = "en") -> DataFrame:
    """Rows in the language, and rows that do not say."""
    c = F.col(column)
    return df.where(c.isNull() | (c == "") | (F.lower(c) == language))


def recent(df: DataFrame, column: str, as_of: dt.datetime | str | Column, max_days: int = 31) -> DataFrame:
    """Rows whose age at ``as_of`` is at most ``max_days`` whole days; future dates stay, no date drops.

    A string column is read as an ISO date. The comparison is on the bare column, so that it reaches the scan.
    """
    value = F.col(column)
    if dict(df.dtypes)[column] == "string":
        value = parse_date(value)
    return df.where(value > as_timestamp(as_of) - F.expr(f"INTERVAL {max_days + 1} DAYS"))


def drop_blank(df: DataFrame, column: str = "text") -> DataFrame:
    return df.where(~is_blank(column))


def search(df: DataFrame, query: str, column: str = "text") -> DataFrame:
    """Rows whose text contains the query, ignoring case."""
    return df.where(F.contains(F.lower(F.col(column)), F.lit(query.lower())))


def attach_predictions(
    df: DataFrame, logits: str = "logits", true: str = "binary_label", labels: Sequence[str] = BINARY_LABELS
) -> DataFrame:
    """Add ``predicted_binary, prob_<label>..., confidence, correct`` to every row."""
    scored = df.withColumn("_probs", softmax(logits)).withColumn("predicted_binary", argmax_label(logits, labels))
    columns = {f"prob_{name}": F.get("_probs", F.lit(i)) for i, name in enumerate(labels)}
    columns["confidence"] = confidence("_probs")
    columns["correct"] = is_correct(true, "predicted_binary")
    return scored.withColumns(columns).drop("_probs")


def model_columns(df: DataFrame, text: str = "text", label: str = "label_id") -> DataFrame:
    """Only what a model reads: the text and ``labels``."""
    return df.select(F.col(text).alias("text"), F.col(label).alias("labels"))


def flags_to_label(df: DataFrame, metaphor: str = "label_metaphor", irony: str = "label_irony") -> DataFrame:
    """Two 0/1 flags to one of the four classes."""
    m, i = F.col(metaphor) == 1, F.col(irony) == 1
    label = F.when(m & i, "both").when(m, "metaphor").when(i, "irony").otherwise("literal")
    return df.withColumn("label", label)
