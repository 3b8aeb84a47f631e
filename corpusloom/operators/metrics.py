"""Classification metrics. Everything derives from one aggregation into (true, predicted) counts.

Every function takes rows, or counts of rows: ``n`` names the column that says how many rows one stands for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.schemas import BINARY_LABELS, ORIGINAL_LABELS

def _ratio(a: Column, b: Column) -> Column:
    """Quotient with 0 for a zero denominator."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _rows(n: str | None) -> Column:
    return F.count("*") if n is None else F.sum(n)


def _rows_where(condition: Column, n: str | None) -> Column:
    one = F.lit(1) if n is None else F.col(n)
    return F.sum(F.when(condition, one).otherwise(F.lit(0)).cast("bigint"))


def outcome_counts(df: DataFrame, true: str, pred: str, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """``(by..., true_label, pred_label, n)``: the only pass over the rows."""
    return df.groupBy(*by, F.col(true).alias("true_label"), F.col(pred).alias("pred_label")).agg(_rows(n).alias("n"))


def prediction_cells(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts by binary, original and predicted label and ``correct``: all a full evaluation needs."""
    return df.groupBy(*by, "binary_label", "original_label", "predicted_binary", "correct").agg(
        F.count("*").alias("n")
    )


def confusion(
    df: DataFrame,
    true: str,
    pred: str,
    labels: Sequence[str] = BINARY_LABELS,
    by: Sequence[str] = (),
    n: str | None = None,
) -> DataFrame:
    """One row per true label in the given order, one column ``pred_<label>`` each; absent cells are 0."""
    counts = outcome_counts(df, true, pred, by, n)
    zero = F.lit(0).cast("bigint")
    cell = lambda t, p, rows: F.struct(t.alias("t"), p.alias("p"), rows.alias("rows"))
    cells = [cell(F.col("true_label"), F.col("pred_label"), F.col("n"))]
    cells += [cell(F.lit(x), F.lit(x), zero) for x in labels]  # so that absent labels get their row
    flat = counts.select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, "c.*")
    rank = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("true_label")) - 1
    sums = [F.sum(F.when(F.col("p") == x, F.col("rows")).otherwise(zero)).alias(f"pred_{x}") for x in labels]
    grouped = flat.where(F.col("t").isin(list(labels))).groupBy(*by, F.col("t").alias("true_label")).agg(*sums)
    return grouped.withColumn("label_rank", rank.cast("int"))


def per_class(
    df: DataFrame,
    true: str,
    pred: str,
    by: Sequence[str] = (),
    labels: Sequence[str] | None = None,
    n: str | None = None,
) -> DataFrame:
    """Precision, recall, F1, support, correct and class accuracy per class.

    Without ``labels``: every class in truth or prediction. With them: exactly these, absent ones as 0.
    """
    return _class_scores(outcome_counts(df, true, pred, by, n), by, labels)


def _class_scores(counts: DataFrame, by: Sequence[str], labels: Sequence[str] | None = None) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    n, t, p = F.col("n"), F.col("true_label"), F.col("pred_label")
    part = lambda name, hit, support, predicted: F.struct(
        name.alias("class"), hit.alias("tp"), support.alias("support"), predicted.alias("predicted")
    )
    parts = [part(t, F.when(t == p, n).otherwise(zero), n, zero), part(p, zero, zero, n)]
    parts += [part(F.lit(x), zero, zero, zero) for x in labels or ()]
    flat = counts.select(*by, F.explode(F.array(*parts)).alias("x")).select(*by, "x.*")
    if labels:
        flat = flat.where(F.col("class").isin(list(labels)))
    sums = flat.groupBy(*by, "class").agg(
        F.sum("tp").alias("correct"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")
    )
    tp = F.col("correct")
    return sums.select(
        *by,
        "class",
        _ratio(tp, F.col("predicted")).alias("precision"),
        _ratio(tp, F.col("support")).alias("recall"),
        _ratio(2 * tp, F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "correct",
        _ratio(tp, F.col("support")).alias("accuracy"),
    )


def overall(df: DataFrame, true: str, pred: str, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """Accuracy, macro and weighted averages, total and correct, one row per group.

    Macro averages run over the classes present in truth or prediction.
    """
    return _overall(_class_scores(outcome_counts(df, true, pred, by, n), by), by)


def _overall(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    support = F.col("support")
    weighted = lambda c: _ratio(F.sum(F.col(c) * support), F.sum(support))
    return scores.groupBy(*by).agg(
        _ratio(F.sum("correct"), F.sum(support)).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        weighted("f1").alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        F.sum(support).alias("total"),
        F.sum("correct").alias("correct"),
    )


def report(df: DataFrame, true: str, pred: str, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """Class rows, then ``accuracy`` (the scalar in every column), ``macro avg`` and ``weighted avg``."""
    scores = per_class(df, true, pred, by, n=n)
    total = _overall(scores, by)
    line = lambda rank, name, *values: F.struct(
        F.lit(rank).alias("section"),
        F.lit(name).alias("row"),
        *[v.cast("double").alias(k) for k, v in zip(("precision", "recall", "f1", "support"), values)],
    )
    c = F.col
    lines = F.array(
        line(1, "accuracy", c("accuracy"), c("accuracy"), c("accuracy"), c("accuracy")),
        line(2, "macro avg", c("precision_macro"), c("recall_macro"), c("f1_macro"), c("total")),
        line(3, "weighted avg", c("precision_weighted"), c("recall_weighted"), c("f1_weighted"), c("total")),
    )
    summary = total.select(*by, F.explode(lines).alias("l")).select(*by, "l.*")
    classes = scores.select(
        *by,
        F.lit(0).alias("section"),
        F.col("class").alias("row"),
        "precision",
        "recall",
        "f1",
        F.col("support").cast("double").alias("support"),
    )
    return classes.unionByName(summary)


def binary_metrics(
    df: DataFrame, true: str, pred: str, positive: str = "figurative", by: Sequence[str] = (), n: str | None = None
) -> DataFrame:
    """Precision, recall and F1 of the positive class, and the macro F1."""
    pick = lambda c: F.coalesce(F.max(F.when(F.col("class") == positive, F.col(c))), F.lit(0.0)).alias(c)
    scores = per_class(df, true, pred, by, n=n)
    return scores.groupBy(*by).agg(
        F.avg("f1").alias("macro_f1"), pick("precision"), pick("recall"), pick("f1")
    )


def breakdown(
    df: DataFrame,
    by: Sequence[str] = (),
    original: str = "original_label",
    correct: str = "correct",
    n: str | None = None,
) -> DataFrame:
    """Total, correct and accuracy per original label, and a ``Total`` row over all rows.

    Labels outside the four classes get no row of their own but count in the total.
    """
    counts = df.groupBy(*by, F.col(original).alias("original_label")).agg(
        _rows(n).alias("total"), _rows_where(F.col(correct), n).alias("correct")
    )
    sets = [[*by, "original_label"], [*by]]
    names = F.array(*[F.lit(x) for x in ORIGINAL_LABELS])
    grouped = counts.groupingSets(sets, *by, "original_label").agg(
        F.grouping("original_label").cast("int").alias("is_total"),
        F.sum("total").alias("total"),
        F.sum("correct").alias("correct"),
    )
    label = F.col("original_label")
    return grouped.where((F.col("is_total") == 1) | label.isin(list(ORIGINAL_LABELS))).select(
        *by,
        F.when(F.col("is_total") == 1, F.lit(len(ORIGINAL_LABELS)))
        .otherwise(F.array_position(names, label).cast("int") - 1)
        .alias("label_rank"),
        F.when(F.col("is_total") == 1, "Total").otherwise(label).alias("label"),
        "total",
        "correct",
        _ratio(F.col("correct"), F.col("total")).alias("accuracy"),
        F.when(F.col("is_total") == 0, F.when(label == "literal", "literal").otherwise("figurative")).alias("maps_to"),
    )


def error_rates(
    df: DataFrame,
    by: Sequence[str] = (),
    binary: str = "binary_label",
    original: str = "original_label",
    correct: str = "correct",
    n: str | None = None,
) -> DataFrame:
    """Errors, rows and error rate (%) overall, per binary label and per original label."""
    counts = df.groupBy(*by, F.col(binary).alias("binary_label"), F.col(original).alias("original_label")).agg(
        _rows(n).alias("total"), _rows_where(~F.col(correct), n).alias("errors")
    )
    sets = [[*by], [*by, "binary_label"], [*by, "original_label"]]
    grouped = counts.groupingSets(sets, *by, "binary_label", "original_label").agg(
        F.grouping("binary_label").alias("_gb"),
        F.grouping("original_label").alias("_go"),
        F.sum("errors").alias("errors"),
        F.sum("total").alias("total"),
    )
    level = F.when(F.col("_gb") == 0, "binary").when(F.col("_go") == 0, "original").otherwise("all")
    name = F.when(F.col("_gb") == 0, F.col("binary_label")).when(F.col("_go") == 0, F.col("original_label"))
    return grouped.select(
        *by,
        level.alias("level"),
        name.alias("label"),
        "errors",
        "total",
        (_ratio(F.col("errors"), F.col("total")) * 100).alias("error_rate"),
    )


def compare_domains(metrics: DataFrame, first: str = "Reddit", second: str = "News") -> DataFrame:
    """Per model: both domains' metrics, absolute differences, the better domain by accuracy (ties: ``second``)
    and its improvement in percent of the other one's accuracy."""
    names = ("accuracy", "f1_macro", "f1_weighted")
    pick = lambda d, m: F.max(F.when(F.col("domain") == d, F.col(m))).alias(f"{d.lower()}_{m}")
    wide = metrics.groupBy("model").agg(*[pick(d, m) for m in names for d in (first, second)])
    a, b = (F.col(f"{d.lower()}_accuracy") for d in (first, second))
    diff = lambda m: F.abs(F.col(f"{first.lower()}_{m}") - F.col(f"{second.lower()}_{m}")).alias(f"{m}_diff")
    low, high = F.least(a, b), F.greatest(a, b)
    return wide.select(
        "*",
        *[diff(m) for m in names],
        F.when(a > b, first).otherwise(second).alias("better_domain"),
        (F.try_divide(high - low, low) * 100).alias("improvement_pct"),
    )


def model_grid(metrics: DataFrame, domains: Sequence[str] = ("Reddit", "News")) -> DataFrame:
    """Accuracy and macro F1 of every model on every domain."""
    pick = lambda d, m, short: F.max(F.when(F.col("domain") == d, F.col(m))).alias(f"{d.lower()}_{short}")
    return metrics.groupBy("model").agg(
        *[pick(d, "accuracy", "acc") for d in domains], *[pick(d, "f1_macro", "f1") for d in domains]
    )
