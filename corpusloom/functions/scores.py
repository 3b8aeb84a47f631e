"""Functions over a column of logits or probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.tokens import col, let


def softmax(c: Column | str) -> Column:
    """Probabilities of a logit array; the maximum is taken off first, so large logits do not overflow."""
    powers = let(
        F.transform(col(c), lambda x: x.cast("double")),
        lambda a: let(F.array_max(a), lambda top: F.transform(a, lambda x: F.exp(x - top))),
    )
    return let(
        powers,
        lambda e: let(
            F.aggregate(e, F.lit(0.0), lambda s, x: s + x), lambda total: F.transform(e, lambda x: x / total)
        ),
    )


def argmax(c: Column | str) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(col(c), F.array_max(col(c))) - 1).cast("int")


def argmax_label(c: Column | str, labels: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), argmax(c))


def confidence(c: Column | str) -> Column:
    return F.array_max(col(c))


def is_correct(true: Column | str, pred: Column | str) -> Column:
    return col(true) == col(pred)
