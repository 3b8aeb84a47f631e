"""Batch scoring with a caller's model, and linear text classifiers in Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.aggregates import class_weights
from corpusloom.operators.metrics import overall
from corpusloom.session import materialize

KINDS = ("unigram", "ngram", "bayes")


def score(
    df: DataFrame, make_predict: Callable, inputs: Sequence[str] = ("text",), batch_size: int = 16, out: str = "logits"
) -> DataFrame:
    """Add an array of logits per row.

    ``make_predict()`` runs once per Python worker, loads the model and returns a function from NumPy
    batches (one array per input column) to a ``rows x classes`` array.
    """
    udf = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    return df.withColumn(out, udf(*inputs))


def _counting_stages(kind: str, text: str, features: int) -> tuple[list[Transformer], str]:
    """Stages that need no fitting, from text to term counts, and the column the counts end up in."""
    words = RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[\s\x1c-\x1f]+")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features)
    if kind != "ngram":
        return [words, counts], "_counts"
    pairs = [
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        HashingTF(inputCol="_pairs", outputCol="_pair_counts", numFeatures=features),
        VectorAssembler(inputCols=["_counts", "_pair_counts"], outputCol="_all_counts"),
    ]
    return [words, counts, *pairs], "_all_counts"


def _fitted_stages(
    kind: str, counts: str, label: str, weight: str | None, reg: float, iterations: int
) -> list[Estimator]:
    extra = {"weightCol": weight} if weight else {}
    if kind == "bayes":
        return [NaiveBayes(featuresCol=counts, labelCol=label, modelType="multinomial", **extra)]
    return [
        IDF(inputCol=counts, outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label, maxIter=iterations, regParam=reg, **extra),
    ]


def make_pipeline(
    kind: str = "unigram",
    text: str = "text",
    label: str = "label_id",
    weight: str | None = "weight",
    features: int = 2**16,
    reg: float = 0.01,
    iterations: int = 20,
) -> Pipeline:
    """One of three interchangeable classifiers: word or word-pair logistic regression, or naive Bayes."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    stages, counts = _counting_stages(kind, text, features)
    return Pipeline(stages=[*stages, *_fitted_stages(kind, counts, label, weight, reg, iterations)])


def weights_of(rows: DataFrame, label: str) -> list[tuple]:
    """Label and balanced weight of every class; classes are few."""
    return [tuple(r) for r in class_weights(rows, label).select(label, "weight").collect()]


def _weighted(rows: DataFrame, label: str) -> DataFrame:
    """Add balanced class weights as literals, looked up once per fit."""
    pairs = [F.lit(v) for row in weights_of(rows, label) for v in row]
    return rows.withColumn("weight", F.try_element_at(F.create_map(*pairs), F.col(label)))


def _counted(df: DataFrame, kind: str, label: str, features: int) -> tuple[DataFrame, PipelineModel, str]:
    """Weighted term counts of the usable rows, written once: fitting reads them several times, the text once."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    usable = df.where(F.col("text").isNotNull() & F.col(label).isNotNull())
    stages, counts = _counting_stages(kind, "text", features)
    counting = PipelineModel(stages)
    rows = materialize(counting.transform(usable.select("text", label)).select(label, counts), "counts")
    return _weighted(rows, label), counting, counts


def _same_counts(kind: str) -> str:
    """Word counts serve the unigram and the Bayes classifier alike."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    return "ngram" if kind == "ngram" else "unigram"


def fit_kinds(
    df: DataFrame,
    kinds: Sequence[str] = KINDS,
    label: str = "label_id",
    features: int = 2**16,
    reg: float = 0.01,
    iterations: int = 20,
) -> dict[str, PipelineModel]:
    """One model of each kind, as ``fit_weighted`` makes them; those with the same counts share one pass over the text."""
    seen, models = {}, {}
    for kind in kinds:
        if _same_counts(kind) not in seen:
            seen[_same_counts(kind)] = _counted(df, kind, label, features)
        rows, counting, counts = seen[_same_counts(kind)]
        stages = _fitted_stages(kind, counts, label, "weight", reg, iterations)
        models[kind] = PipelineModel([*counting.stages, *Pipeline(stages=stages).fit(rows).stages])
    return models


def fit_weighted(
    df: DataFrame,
    label: str = "label_id",
    kind: str = "unigram",
    features: int = 2**16,
    reg: float = 0.01,
    iterations: int = 20,
) -> PipelineModel:
    """Fit with balanced class weights on the rows with text and label."""
    rows, counting, counts = _counted(df, kind, label, features)
    fitted = Pipeline(stages=_fitted_stages(kind, counts, label, "weight", reg, iterations)).fit(rows)
    return PipelineModel([*counting.stages, *fitted.stages])


def apply_model(model: Transformer, df: DataFrame) -> DataFrame:
    """Add ``logits`` (raw scores), ``probabilities`` and ``predicted_id``; helper columns are left out."""
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        vector_to_array("rawPrediction").alias("logits"),
        vector_to_array("probability").alias("probabilities"),
        F.col("prediction").cast("int").alias("predicted_id"),
    )


@dataclass(frozen=True)
class Selection:
    """The best model, its place in the grid and the validation score of every candidate tried."""

    model: PipelineModel
    index: int
    scores: list[float]


def select_model(
    train: DataFrame, val: DataFrame, grid: Sequence[dict], label: str = "label_id", patience: int = 3
) -> Selection:
    """Fit the candidates in order and keep the one with the best macro F1 on ``val`` (first maximum).

    Stops after ``patience`` candidates in a row without improvement.
    """
    best, index, scores, seen = None, -1, [], {}
    for i, options in enumerate(grid):
        kind, features = options.get("kind", "unigram"), options.get("features", 2**16)
        shared = (_same_counts(kind), features)
        if shared not in seen:  # candidates over the same counts share one pass over the text
            seen[shared] = _counted(train, kind, label, features)
        rows, counting, counts = seen[shared]
        stages = _fitted_stages(
            kind, counts, label, "weight", options.get("reg", 0.01), options.get("iterations", 20)
        )
        model = PipelineModel([*counting.stages, *Pipeline(stages=stages).fit(rows).stages])
        predicted = apply_model(model, val)
        value = overall(predicted, label, "predicted_id").select("f1_macro").first()[0]
        scores.append(value)
        if best is None or value > scores[index]:
            best, index = model, i
        elif i - index >= patience:
            break
    if best is None:
        raise ValueError("the grid is empty")
    return Selection(best, index, scores)


def adapt(
    base: PipelineModel,
    df: DataFrame,
    label: str = "label_id",
    features: int = 2**16,
    reg: float = 0.01,
    iterations: int = 20,
) -> PipelineModel:
    """Transfer to a domain: refit on its rows with the base model's probabilities as more features.

    The base's stages come first, with their outputs renamed; its words are reused. The result is an ordinary
    pipeline model.
    """
    judge = base.stages[-1].copy()
    judge.setRawPredictionCol("_base_raw").setProbabilityCol("_base_probability").setPredictionCol("_base_prediction")
    first = PipelineModel([*base.stages[:-1], judge])
    counting = HashingTF(inputCol="_words", outputCol="_own_counts", numFeatures=features)
    head = Pipeline(
        stages=[
            IDF(inputCol="_own_counts", outputCol="_own_features"),
            VectorAssembler(inputCols=["_own_features", "_base_probability"], outputCol="_adapted_features"),
            LogisticRegression(
                featuresCol="_adapted_features", labelCol=label, weightCol="weight", maxIter=iterations, regParam=reg
            ),
        ]
    )
    usable = df.where(F.col("text").isNotNull() & F.col(label).isNotNull()).select("text", label)
    rows = counting.transform(first.transform(usable)).select(label, "_own_counts", "_base_probability")
    rows = _weighted(materialize(rows, "counts"), label)
    return PipelineModel([*first.stages, counting, *head.fit(rows).stages])
