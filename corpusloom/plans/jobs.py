"""Whole jobs, composed from the operators.

Each returns frames. Given ``out``, a job also writes its files there and returns frames over what it wrote
where later steps would otherwise compute the rows again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.normalize import format_date, parse_date
from corpusloom.functions.text import CONTENT_LIMIT, head_tail, length_bin
from corpusloom.operators import metrics as M
from corpusloom.operators.aggregates import (
    length_histogram,
    length_stats,
    split_report,
    truncation_summary,
    value_counts,
    words_to_sentences,
)
from corpusloom.operators.annotation import annotation_requests, annotation_results
from corpusloom.operators.dedupe import dedupe_first, url_title_winners
from corpusloom.operators.filters import (
    attach_predictions,
    drop_blank,
    encode_label,
    harmonise,
    keep_language,
    min_length,
    recent,
    search,
    to_binary,
)
from corpusloom.operators.joins import pending
from corpusloom.operators.learning import adapt, apply_model, fit_weighted, select_model
from corpusloom.operators.long_texts import shorten, with_truncation_record
from corpusloom.operators.ranking import cap_per_group, error_samples, limit_per_source, shuffle_rows
from corpusloom.operators.sets import union_sources
from corpusloom.operators.split import split_60_20_20, stratified_split
from corpusloom.schemas import BINARY_LABELS
from corpusloom.session import materialize
from corpusloom.sinks import writers
from corpusloom.sources.corpus import scan_corpus
from corpusloom.sources.files import require_columns
from corpusloom.sources.documents import extract_article, parse_reviews, to_comment_rows, to_post_rows


def sentence_corpus(words: DataFrame) -> DataFrame:
    """Tagged word rows to sentences, first copy per split kept in folder order."""
    keys = ["split", "source", "pos_folder", "source_rank", "pos_rank"]
    sentences = words_to_sentences(words, keys)
    return dedupe_first(sentences, ["split", "text"], ["source_rank", "pos_rank"])


def split_sentence_corpus(sentences: DataFrame, val_size: float = 0.1, seed: int = 42) -> DataFrame:
    """Carve the validation split out of ``train``; ``test`` stays as it is."""
    columns = ["text", "label", "num_words", "num_metaphors", "metaphor_ratio", "pos", "source", "split"]
    corpus = materialize(sentences.withColumnRenamed("pos_folder", "pos").select(*columns), "sentences")
    train = corpus.where(F.col("split") == "train").drop("split")
    parts = stratified_split(train, "label", val_size, seed, key="text")
    return union_sources([parts, corpus.where(F.col("split") == "test")]).select(*columns)


def prepare_word_corpus(
    spark: SparkSession, root: str, val_size: float = 0.1, seed: int = 42, out: str | None = None
) -> DataFrame:
    """Word-level corpus folders to one sentence frame with ``split`` in train, val and test.

    ``out`` gets ``basic`` (text and label) and ``detailed``, a folder per split each.
    """
    corpus = split_sentence_corpus(sentence_corpus(scan_corpus(spark, root)), val_size, seed)
    if out is None:
        return corpus
    writers.write_basic_detailed(corpus, out, ["text", "label", "split"], partition=["split"])
    return spark.read.parquet(f"{out}/detailed").select(*corpus.columns)


def prepare_domain(
    df: DataFrame, domain: str, key: str = "doc_id", seed: int = 42, min_chars: int = 11, out: str | None = None
) -> DataFrame:
    """One domain's annotations to ``(key, text, label, split)`` with binary labels.

    Fails when fewer than two classes are left. ``out`` gets ``(text, label)`` as CSV, a folder per split.
    """
    rows = min_length(harmonise(df, domain), "text", min_chars)
    binary = to_binary(rows, "label", "label").select(key, "text", "label")
    rows = split_60_20_20(binary, "label", seed, key, min_classes=2)
    if out is not None:
        writers.write_splits(rows, out, "label")
    return rows


def prepare_annotations(df: DataFrame, key: str = "doc_id", seed: int = 42, out: str | None = None) -> DataFrame:
    """Annotated rows to ``binary_label`` and an exact 60/20/20 ``split``.

    ``out`` gets ``(text, label)`` as CSV, a folder per split.
    """
    rows = split_60_20_20(to_binary(df), "binary_label", seed, key)
    if out is not None:
        writers.write_splits(rows, out, "binary_label")
    return rows


def annotations_report(df: DataFrame) -> DataFrame:
    return split_report(df, BINARY_LABELS, "binary_label")


@dataclass(frozen=True)
class LongTexts:
    """``profile`` has one row per ``stage``, ``before`` and ``after``."""

    rows: DataFrame
    profile: DataFrame
    summary: DataFrame


def process_long_texts(
    df: DataFrame,
    strategy: str = "smart_truncate",
    column: str = "text",
    limit: int = CONTENT_LIMIT,
    tokenizer=None,
    out: str | None = None,
) -> LongTexts:
    """Shortened rows, the length profile before and after, and the truncation summary.

    Both profiles come from one pass: every row carries its lengths of before and after. ``out`` gets the
    rows and a text report.
    """
    wide = shorten(df, column, strategy, limit, tokenizer=tokenizer, keep_original=True)
    if out is not None:
        wide.write.parquet(f"{out}/rows")
        wide = df.sparkSession.read.schema(wide.schema).parquet(f"{out}/rows")
    lengths = lambda stage, *columns: F.struct(
        F.lit(stage).alias("stage"),
        *[F.col(c).alias(n) for c, n in zip(columns, ("token_count", "char_count", "word_count"))],
    )
    before = lengths("before", "original_tokens", "original_chars", "original_words")
    after = lengths("after", "token_count", "char_count", "word_count")
    sides = F.array(before, after)
    if "chunk_pos" in wide.columns:  # a text counts once before, each of its chunks after
        sides = F.when(F.col("chunk_pos") == 0, sides).otherwise(F.array(after))
    both = wide.select(F.explode(sides).alias("s")).select("s.*")
    profile = length_stats(both, limit=limit, by=["stage"])
    summary = truncation_summary(wide.withColumn("final_tokens", F.col("token_count")))
    if out is not None:
        sections = [("Shortened texts", summary, None), ("Lengths before and after", profile, "stage")]
        writers.write_report(sections, f"{out}/report")
    return LongTexts(wide.drop("original_chars", "original_words"), profile, summary)


def collect_news(
    pages: DataFrame,
    as_of: dt.datetime | str | Column,
    key: str = "page_id",
    date: str = "publish_date",
    language: str = "en",
    min_chars: int = 500,
    seed: int = 42,
    out: str | None = None,
) -> DataFrame:
    """Landed pages ``(key, source, url, html)`` to articles in random order, written to ``out`` with a report of the
    articles of each source.

    Duplicates are judged over all pages, so a page dropped later by a filter still shadows its copies.
    That pass moves keys only; the pages are filtered and extracted on their own and joined to the
    winners last.
    """
    articles = extract_article(pages) if date == "publish_date" else extract_article(pages).drop("publish_date")
    winners = url_title_winners(articles, key)
    kept = min_length(recent(keep_language(articles, "meta_lang", language), date, as_of), "text", min_chars)
    day = parse_date(date) if dict(kept.dtypes)[date] == "string" else F.col(date)
    rows = kept.join(winners, key, "left_semi").select(
        key,
        "source",
        "url",
        "title",
        head_tail("text").alias("text"),
        format_date(day).alias("publish_date"),
    )
    rows = shuffle_rows(rows, seed, key)
    if out is not None:
        rows.write.parquet(f"{out}/articles")
        rows = pages.sparkSession.read.schema(rows.schema).parquet(f"{out}/articles")
        writers.write_report([("Articles of each source", value_counts(rows, "source"), "source")], f"{out}/report")
    return rows


@dataclass(frozen=True)
class ForumCollection:
    rows: DataFrame
    summary: DataFrame
    histogram: DataFrame
    by_source: DataFrame
    by_type: DataFrame


def collect_forum(
    posts: DataFrame,
    comments: DataFrame,
    limit: int = 1000,
    order: str | Sequence[str] = "position",
    query: str | None = None,
    min_chars: int = 50,
    token_limit: int = CONTENT_LIMIT,
    tokenizer=None,
    out: str | None = None,
) -> ForumCollection:
    """Posts and comments to detailed rows, with the collection's statistics.

    The per-source limit comes before the length filter. Posts are measured stripped, comments as they are.
    ``out`` gets ``basic`` and ``detailed`` rows and a text report.
    """
    order = [order] if isinstance(order, str) else list(order)
    post_rows = to_post_rows(posts, tuple(order))
    if query:
        post_rows = search(post_rows, query)
    post_rows = min_length(limit_per_source(post_rows, limit, order), "text", min_chars, strip_first=True)
    comment_rows = limit_per_source(to_comment_rows(comments, tuple(order)), limit, order)
    comment_rows = min_length(comment_rows, "text", min_chars)
    # blank texts have no record; they go before it is computed, so that no filter computes it a second time
    both = drop_blank(union_sources([post_rows, comment_rows]), "text")
    rows = with_truncation_record(both, "text", token_limit, "_r", tokenizer).select(
        "_r.text",
        "source",
        "type",
        "score",
        "timestamp",
        "url",
        "_r.original_tokens",
        "_r.final_tokens",
        "_r.was_truncated",
        length_bin("_r.original_tokens", short_labels=True).alias("token_bin"),
    )
    if out is not None:
        writers.write_basic_detailed(rows, out, ["text", "source", "type", "score", "timestamp", "url"])
        rows = posts.sparkSession.read.schema(rows.schema).parquet(f"{out}/detailed")
    else:
        rows = materialize(rows, "forum")  # at most ``limit`` rows per source; four statistics read them
    result = ForumCollection(
        rows=rows,
        summary=truncation_summary(rows),
        histogram=length_histogram(rows, "original_tokens", short_labels=True),
        by_source=value_counts(rows, "source"),
        by_type=value_counts(rows, "type"),
    )
    if out is not None:
        sections = [
            ("Collected rows", result.summary, None),
            ("Rows of each source", result.by_source, "source"),
            ("Rows of each type", result.by_type, "type"),
        ]
        writers.write_report(sections, f"{out}/report")
    return result


def collect_reviews(
    responses: DataFrame, n: int = 100, json_col: str = "json", page_col: str | None = None, out: str | None = None
) -> DataFrame:
    """Landed review pages to at most ``n`` reviews per title, in arrival order; appended to ``out``."""
    reviews = cap_per_group(parse_reviews(responses, json_col, page_col), "movie_id", ["page", "pos"], n)
    if out is not None:
        writers.append_reviews(reviews, out)
    return reviews


def annotation_round_trip(
    df: DataFrame,
    responses: DataFrame,
    done: DataFrame | None = None,
    source: str = "news",
    key: str = "row_id",
    out: str | None = None,
    requests: DataFrame | None = None,
) -> DataFrame:
    """Annotations of the rows not done yet, from the landed responses to their batches; appended to ``out``.

    ``requests`` is the table written when the prompts went out; with it any part of the responses can be taken up in
    any round. Without it the requests are computed again from what is pending, and ``responses`` must carry their
    ``request_id``: those to batches that are cut differently by now match nothing.
    """
    if requests is None:
        require_columns(responses, ["request_id"])
        results = annotation_results(annotation_requests(df, done, key), responses, source, key)
    else:
        results = annotation_results(requests, responses, source, key)
        results = results if done is None else pending(results, done, key)
    if out is not None:
        writers.append_annotations(results, out, key)
    return results


def evaluate(
    df: DataFrame,
    true: str = "true_label",
    logits: str = "logits",
    labels: Sequence[str] = BINARY_LABELS,
    key: Sequence[str] = ("doc_id",),
    out: str | None = None,
    by: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """All frames of a single-domain evaluation, by the names of their files; written to ``out``.

    ``by``: columns, as of models, whose values are evaluated apart, all in one pass; every frame has them.
    """
    scored = attach_predictions(df, logits, true, labels).withColumnRenamed("predicted_binary", "pred_label")
    cells = materialize(M.outcome_counts(scored, true, "pred_label", by), "outcomes")  # a few rows for four frames
    names = {"true": "true_label", "pred": "pred_label", "n": "n", "by": by}
    order = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("class"))
    classes = M.per_class(cells, **names).where(F.col("support") > 0)
    frames = {
        "classification_report": M.report(cells, **names),
        "per_class_metrics": classes.withColumn("class_rank", order.cast("int") - 1),
        "overall_metrics": M.overall(cells, **names),
        "confusion_matrix": M.confusion(cells, labels=labels, **names),
        "detailed_predictions": scored.select(
            *by,
            *key,
            F.col(true).alias("true_label"),
            "pred_label",
            "correct",
            *[f"prob_{x}" for x in labels],
            "confidence",
        ),
    }
    if out is not None:
        writers.write_evaluation(frames, out, by=by)
    return frames


@dataclass(frozen=True)
class CrossDomain:
    predictions: DataFrame
    metrics: DataFrame
    classes: DataFrame
    confusion: DataFrame
    breakdown: DataFrame
    errors: DataFrame
    samples: DataFrame
    comparison: DataFrame
    grid: DataFrame


def evaluate_cross_domain(
    df: DataFrame, domains: Sequence[str] = ("Reddit", "News"), out: str | None = None
) -> CrossDomain:
    """Several models on several domains at once: both are columns, so one pass counts all outcomes.

    ``df``: ``doc_id, model, domain, text, label`` (four classes) and ``logits``. The outcome counts, some
    thirty rows per model and domain, are written once; every metric frame reads those. ``out`` gets the
    predictions by model and domain, and the nested summary.
    """
    by = ["model", "domain"]
    scored = attach_predictions(to_binary(df.withColumn("original_label", F.col("label"))))
    cells = materialize(M.prediction_cells(scored, by), "outcomes")
    names = {"true": "binary_label", "pred": "predicted_binary", "by": by, "n": "n"}
    metrics = M.overall(cells, **names)
    first, second = domains
    result = CrossDomain(
        predictions=scored,
        metrics=metrics,
        classes=M.per_class(cells, labels=BINARY_LABELS, **names),
        confusion=M.confusion(cells, labels=BINARY_LABELS, **names),
        breakdown=M.breakdown(cells, by, n="n"),
        errors=M.error_rates(cells, by, n="n"),
        samples=error_samples(scored, by=by),
        comparison=M.compare_domains(metrics, first, second),
        grid=M.model_grid(metrics, domains),
    )
    if out is not None:
        scored.write.partitionBy(*by).parquet(f"{out}/predictions")
        summary = writers.summary_frame(result.metrics, result.classes, result.breakdown, result.comparison, domains)
        writers.write_summary(summary, f"{out}/results_summary")
    return result


def train_domains(
    domains: dict[str, DataFrame],
    kind: str = "unigram",
    base: PipelineModel | None = None,
    out: str | None = None,
    grid: Sequence[dict] | None = None,
    key: str = "doc_id",
    **options,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit every prepared domain on its ``train`` rows, adapting ``base`` if given, and compare on ``test``.

    With a ``grid`` of options a domain's model is the candidate with the best macro F1 on its ``val`` rows. ``out`` also
    gets every domain's evaluation files. Returns the models and ``(Domain, Macro_F1, Accuracy, Model, domain_rank)``; ``best(scores, "Macro_F1",
    "domain_rank")`` picks the winner. ``out`` gets the models and the comparison.
    """
    models, scores = {}, []
    for rank, (name, df) in enumerate(domains.items()):
        rows = materialize(encode_label(df, "label"), f"domain-{name}")  # several passes read it
        train = rows.where(F.col("split") == "train")
        if base is not None:
            models[name] = adapt(base, train, **options)
        elif grid:
            val = rows.where(F.col("split") == "val")
            models[name] = select_model(train, val, [{"kind": kind, **options, **g} for g in grid]).model
        else:
            models[name] = fit_weighted(train, kind=kind, **options)
        predicted = apply_model(models[name], rows.where(F.col("split") == "test"))
        if out is not None:
            judged = predicted.select(key, F.col("label").alias("true_label"), "logits")
            evaluate(judged, key=(key,), out=f"{out}/evaluation/{name}")
        scores.append(
            M.overall(predicted, "label_id", "predicted_id").select(
                F.lit(name).alias("Domain"),
                F.col("f1_macro").alias("Macro_F1"),
                F.col("accuracy").alias("Accuracy"),
                F.lit(f"{name}_{'adapted' if base is not None else 'trained'}_{kind}").alias("Model"),
                F.lit(rank).alias("domain_rank"),
            )
        )
    if not scores:
        raise ValueError("no domain to train on")
    compared = union_sources(scores)
    if out is not None:
        for name, model in models.items():
            model.write().save(f"{out}/models/{name}")
        writers.write_comparison(compared, f"{out}/comparison")
    return models, compared
