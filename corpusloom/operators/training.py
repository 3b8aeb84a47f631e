"""A linear text classifier trained step by step: checked every few steps, stopped by patience, restored to its best
state, and adaptable from where another one ended.

Texts become arrays of hashed word ids, written once. A step's gradient is summed where the rows are: every task sends one
partial sum, tasks' sums are added in a second round, and the driver gets a few arrays of ``classes x (features + 1)``
numbers, whatever the number of rows. The state on the driver has that size too.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.scores import softmax
from corpusloom.operators.learning import weights_of
from corpusloom.session import scratch_path

#: Partial sums that reach the driver in a step, at most.
SUMS = 16


@dataclass(frozen=True)
class Setting:
    """``features``: word ids. ``rate``: of the steps, which shrink per weight with the gradients it has seen. ``reg``: pull
    of all weights to zero. ``steps``: at most; step ``s`` reads part ``s`` modulo ``batches`` of the rows. ``every``:
    steps between two looks at the validation rows. ``patience``: looks without a better score before the end."""

    features: int = 2**16
    rate: float = 0.5
    reg: float = 1e-4
    steps: int = 40
    every: int = 5
    patience: int = 3
    batches: int = 1


def word_ids(text: str, features: int) -> Column:
    """Hashed ids, from 0, of a text's words (runs of anything but white space), lowered; a null text has none."""
    words = F.filter(F.split(F.lower(F.col(text)), r"[\s\x1c-\x1f]+"), lambda w: w != "")
    ids = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(features)).cast("int"))
    return F.coalesce(ids, F.array().cast("array<int>"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, and how many each row has."""
    return column.flatten().to_numpy().astype(np.int64), np.diff(column.offsets.to_numpy())


def logits(weights: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``rows x classes``: the bias, and the mean of the words' weights times the root of their number."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    sums = [np.bincount(row, weights=w[ids], minlength=len(sizes)) * scale + w[-1] for w in weights]
    return np.stack(sums, axis=1)


def gradient(weights: np.ndarray, ids: np.ndarray, sizes: np.ndarray, label: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Of the weighted log loss, summed over the rows."""
    z = logits(weights, ids, sizes)
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(label)), label] -= 1
    p *= share[:, None]
    each = np.repeat(p / np.sqrt(np.maximum(sizes, 1))[:, None], sizes, axis=0)
    words = [np.bincount(ids, weights=each[:, k], minlength=weights.shape[1] - 1) for k in range(len(weights))]
    return np.concatenate([np.stack(words), p.sum(axis=0)[:, None]], axis=1)


def macro_f1(counts: dict[tuple[int, int], int]) -> float:
    """From counts by (label, prediction); a class without a true positive scores 0."""
    scores = []
    for c in {x for pair in counts for x in pair}:
        hit = counts.get((c, c), 0)
        wrong = sum(n for (a, b), n in counts.items() if (a == c) != (b == c))
        scores.append(2 * hit / (2 * hit + wrong))
    return float(np.mean(scores)) if scores else 0.0


@dataclass(frozen=True)
class Trained:
    """Weights (a row per class, the bias last), the step they are from, and the score at every look."""

    weights: np.ndarray
    setting: Setting
    step: int = 0
    scores: list[tuple[int, float]] = field(default_factory=list)
    class_weights: list[float] = field(default_factory=list)

    def apply(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``logits``, ``probabilities`` and ``predicted_id`` (the first of equals), in Arrow batches."""
        shared = df.sparkSession.sparkContext.broadcast(self.weights)

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def score(ids: pd.Series) -> pd.Series:
            sizes = ids.map(len).to_numpy()
            flat = np.concatenate([*ids, np.zeros(0)]).astype(np.int64)
            return pd.Series(list(logits(shared.value, flat, sizes)))

        scored = df.withColumn("logits", score(word_ids(text, self.setting.features)))
        scored = scored.withColumn("probabilities", softmax("logits"))
        best = F.array_position("logits", F.array_max("logits")) - 1
        return scored.withColumn("predicted_id", best.cast("int"))

    def save(self, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
        about = {"setting": asdict(self.setting), "step": self.step, "scores": self.scores, "class_weights": self.class_weights}
        rows = [(json.dumps(about), self.weights.shape[0], self.weights.astype("<f8").tobytes())]
        spark.createDataFrame(rows, "about string, classes int, weights binary").coalesce(1).write.mode(mode).parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Trained:
        row = spark.read.parquet(path).first()
        about = json.loads(row.about)
        weights = np.frombuffer(row.weights, "<f8").reshape(row.classes, -1).copy()
        scores = [tuple(s) for s in about["scores"]]
        return cls(weights, Setting(**about["setting"]), about["step"], scores, about["class_weights"])


def _numbered(df: DataFrame, label: str, setting: Setting, text: str, batches: int) -> DataFrame:
    """Word ids and labels of the usable rows, written once, a folder per part."""
    path = scratch_path(df.sparkSession, "word-ids")
    rows = df.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        word_ids(text, setting.features).alias("ids"),
        F.col(label).cast("int").alias("label"),
        F.pmod(F.xxhash64(text), F.lit(batches)).cast("int").alias("part"),
    )
    rows.write.partitionBy("part").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def _summed(rows: DataFrame, weights: np.ndarray, shares: Sequence[float]) -> tuple[np.ndarray, float]:
    """The gradient over all rows, and the sum of their weights."""
    shared = rows.sparkSession.sparkContext.broadcast((weights, np.array(shares)))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, share = shared.value
        total, weight = np.zeros_like(own), 0.0
        for batch in batches:
            ids, sizes = _lists(batch.column(0))
            label = batch.column(1).to_numpy()
            total += gradient(own, ids, sizes, label, share[label])
            weight += float(share[label].sum())
        slot = TaskContext.get().partitionId() % SUMS
        yield pa.RecordBatch.from_pylist([{"slot": slot, "sums": total.tobytes(), "weight": weight}])

    def added(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("sums"))
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary()), "weight": [sum(table.column("weight").to_pylist())]})

    sent = rows.select("ids", "label").mapInArrow(partial, "slot long, sums binary, weight double")
    parts = sent.groupBy("slot").applyInArrow(added, "sums binary, weight double").collect()  # SUMS rows at most
    shared.destroy()
    total = sum((np.frombuffer(p.sums, np.float64) for p in parts), np.zeros(weights.size))
    return total.reshape(weights.shape), sum(p.weight for p in parts)


def _score(rows: DataFrame, weights: np.ndarray) -> float:
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            predicted = logits(shared.value, *_lists(batch.column(0))).argmax(axis=1)
            pairs, n = np.unique(np.stack([batch.column(1).to_numpy(), predicted]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_pydict({"label": pairs[0].astype(np.int32), "predicted": pairs[1].astype(np.int32), "n": n})

    counts = rows.select("ids", "label").mapInArrow(judged, "label int, predicted int, n long")
    found = counts.groupBy("label", "predicted").agg(F.sum("n").alias("n")).collect()  # classes squared at most
    shared.destroy()
    return macro_f1({(r.label, r.predicted): r.n for r in found})


def train(
    rows: DataFrame,
    val: DataFrame,
    label: str = "label_id",
    setting: Setting = Setting(),
    start: Trained | None = None,
    pull: float = 0.0,
    text: str = "text",
) -> Trained:
    """Train with balanced class weights on the rows that have text and label.

    Labels are 0, 1, ... Before the first step and after every ``every`` steps, the macro F1 on ``val`` is taken; the
    weights with the best score so far are kept (the first of equals), and returned when ``patience`` looks in a row
    were no better or the steps are used up.

    ``start`` begins at another one's weights, for transfer to a domain: its setting's ``features`` hold, and ``pull``
    draws the weights back to where they began, by a proximal step after each one, in place of ``reg``, which draws them
    to zero. With no
    steps the result is the start itself.
    """
    if start is not None and start.setting.features != setting.features:
        raise ValueError(f"the start has {start.setting.features} features, not {setting.features}")
    train_rows, val_rows = (_numbered(df, label, setting, text, n) for df, n in ((rows, setting.batches), (val, 1)))
    by_class = dict(weights_of(train_rows, "label"))
    if not by_class:
        raise ValueError("no row has both text and label")
    classes = max(max(by_class) + 1, len(start.weights) if start else 2)
    shares = [by_class.get(c, 0.0) for c in range(classes)]
    weights = np.zeros((classes, setting.features + 1))
    if start is not None:
        weights[: len(start.weights)] = start.weights
    home, seen = weights.copy(), np.zeros_like(weights)
    scores = [(0, _score(val_rows, weights))]
    best, best_step, worse = weights.copy(), 0, 0
    for step in range(1, setting.steps + 1):
        part = train_rows.where(F.col("part") == (step - 1) % setting.batches)
        total, weight = _summed(part, weights, shares)
        slope = total / max(weight, 1e-12) + (0 if start is not None else setting.reg * weights)
        seen += slope**2
        rate = setting.rate / (np.sqrt(seen) + 1e-6)
        weights = weights - rate * slope
        if start is not None:  # the proximal step: however strong the pull, it never goes beyond home
            weights = (weights + rate * pull * home) / (1 + rate * pull)
        if step % setting.every == 0 or step == setting.steps:
            scores.append((step, _score(val_rows, weights)))
            if scores[-1][1] > max(s for _, s in scores[:-1]):
                best, best_step, worse = weights.copy(), step, 0
            else:
                worse += 1
                if worse == setting.patience:
                    break
    return Trained(best, setting, best_step, scores, shares)
