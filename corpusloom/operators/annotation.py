"""Prompts out, answers in: batched annotation as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.text import ellipsize
from corpusloom.functions.tokens import col
from corpusloom.operators.filters import drop_blank, pick_sentiment, pick_text
from corpusloom.operators.joins import align_answers, pending
from corpusloom.operators.ranking import assign_batches
from corpusloom.schemas import ANSWERS_JSON

INSTRUCTION = (
    "You will read several numbered passages. Say of each one how it is meant.\n"
    "Mark is_metaphor where words are used figuratively, is_irony where the writer means the opposite of the words,\n"
    "and is_literal where neither holds. Give your grounds in reasoning, in a sentence.\n"
    "Reply with nothing but a JSON array: one object for every passage, in their order, with the booleans\n"
    "is_metaphor, is_irony, is_literal and the string reasoning.\n"
)


def build_prompts(
    df: DataFrame, batch: str = "batch_id", pos: str = "pos", text: str = "text", instruction: str = INSTRUCTION
) -> DataFrame:
    """``(batch_id, n_texts, prompt)``: the instruction and the batch's texts, numbered from 1.

    A group is one batch, so what is collected is bounded by the batch size.
    """
    texts = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), F.col(text).alias("text"))))
    numbered = F.transform(
        F.col("_texts"),
        lambda t, i: F.concat(F.lit("\n--- TEXT "), (i + 1).cast("string"), F.lit(" ---\n"), t["text"], F.lit("\n")),
    )
    return (
        df.groupBy(batch)
        .agg(texts.alias("_texts"))
        .select(
            batch,
            F.size("_texts").alias("n_texts"),
            F.concat(F.lit(instruction), F.array_join(numbered, "")).alias("prompt"),
        )
    )


def parsed_answers(c: Column | str) -> Column:
    """Array of ``(label_metaphor, label_irony, reasoning)``; a lone object counts as an array of one.

    Null when the response is malformed or an entry is no object.
    """
    parsed = F.from_json(col(c), ANSWERS_JSON)
    flag = lambda x: F.coalesce(x.cast("int"), F.lit(0))
    entries = F.transform(
        parsed,
        lambda a: F.struct(
            flag(a["is_metaphor"]).alias("label_metaphor"),
            flag(a["is_irony"]).alias("label_irony"),
            F.coalesce(a["reasoning"], F.lit("")).alias("reasoning"),
        ),
    )
    return F.when(~F.exists(parsed, lambda a: a.isNull()), entries)


def parse_answers(df: DataFrame, json_col: str = "response") -> DataFrame:
    """Add ``answers``; malformed responses get null and are dropped by the alignment."""
    return df.withColumn("answers", parsed_answers(json_col))


def annotation_requests(
    df: DataFrame, done: DataFrame | None = None, key: str = "row_id", size: int = 10, width: int = 2000
) -> DataFrame:
    """Rows still to annotate: ``key, batch_id, request_id, pos, n_texts, text, original_sentiment``.

    ``batch_id`` numbers what is pending now, so it changes from one round to the next. ``request_id`` is derived from
    the keys of the batch's texts: a response that carries it can never be given to other texts. Batches are cut before blank texts are skipped, so a batch may hold fewer texts than ``size`` and an
    all-blank batch sends nothing.
    """
    todo = df if done is None else pending(df, done, key)
    texts = drop_blank(pick_sentiment(pick_text(assign_batches(todo, key, size))), "text")
    batch = W.partitionBy("batch_id")
    members = lambda x: x.cast("string")
    return texts.select(
        key,
        "batch_id",
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(key).over(batch)), members), ",")).alias("request_id"),
        (F.row_number().over(batch.orderBy("batch_pos")) - 1).alias("pos"),
        F.count("*").over(batch).alias("n_texts"),
        ellipsize("text", width).alias("text"),
        "original_sentiment",
    )


def annotation_results(requests: DataFrame, responses: DataFrame, source: str, key: str = "row_id") -> DataFrame:
    """Aligned annotations of all batches whose response is usable. ``responses``: ``response`` and ``request_id``, or
    ``batch_id`` if they answer these very ``requests``."""
    by = "request_id" if "request_id" in responses.columns else "batch_id"
    aligned = align_answers(requests, parse_answers(responses, "response").select(by, "answers"), by)
    return aligned.select(
        key,
        "text",
        "answer.label_metaphor",
        "answer.label_irony",
        "answer.reasoning",
        "original_sentiment",
        F.lit(source).alias("source"),
    )
