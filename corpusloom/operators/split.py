"""Exact, seeded, stratified splits without ranking whole classes.

Rows are ordered inside a class by ``md5(seed:key)``. A split boundary is one row of that order, found in
three light steps that read only the label and the key:

1. count rows per class and hash bucket (the first four hex digits);
2. derive the exact class quotas and the bucket each boundary falls into;
3. rank the rows of the boundary buckets only, about 1/65,536 of a class each.

Membership is then a comparison with the boundary, joined by class. The boundaries, one row per class, are written
first, so the optimizer knows their size and broadcasts them: the full rows are neither shuffled nor sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.session import materialize

_PREFIX = 4


def order_hash(key: str, seed: int) -> Column:
    """The order key: the same text on every engine, uniform whatever the keys look like."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def _check(bad: Column, message: str, value: Column) -> Column:
    return F.when(bad, F.raise_error(F.lit(message))).otherwise(value)


def split_quotas(counts: DataFrame, label: str, fractions: Sequence[float], min_classes: int = 1) -> DataFrame:
    """Exact rows per class and part, from ``(label, n)``.

    Each fraction is held out of what is left: ``ceil(fraction * rows)``. The kept part is shared out
    proportionally; what rounding leaves goes to the largest remainders, ties to the later class name, so
    the held-out side of a tie favours the earlier one. Adds ``upto_0, upto_1, ...``: the ranks in the
    class at which the parts end. All steps run on one row per class.
    """
    everyone = W.partitionBy(F.lit(0))
    big = lambda c: c.cast("decimal(19,0)")
    q = counts.withColumn("_classes", F.count("*").over(everyone))
    q = q.withColumn(
        "_left",
        _check(
            F.col(label).isNull(),
            "stratified split: a label is null",
            _check(F.col("_classes") < min_classes, "stratified split: too few classes", F.col("n")),
        ),
    ).withColumn("_end", F.lit(0).cast("bigint"))
    for i, fraction in enumerate(fractions):
        q = q.withColumn(
            "_left", _check(F.col("_left") < 2, "stratified split: a class has fewer than two rows", F.col("_left"))
        ).withColumn("_total", F.sum("_left").over(everyone))
        q = q.withColumn(
            "_kept", F.col("_total") - F.ceil(F.lit(float(fraction)) * F.col("_total")).cast("bigint")
        )
        q = q.withColumn("_product", (big(F.col("_left")) * big(F.col("_kept"))).cast("decimal(38,0)"))
        q = q.withColumn("_rest", F.col("_product") % big(F.col("_total")))
        q = q.withColumn("_base", ((F.col("_product") - F.col("_rest")) / big(F.col("_total"))).cast("bigint"))
        q = q.withColumns(
            {
                "_missing": F.col("_kept") - F.sum("_base").over(everyone),
                "_turn": F.row_number().over(everyone.orderBy(F.desc("_rest"), F.desc(label))),
            }
        )
        quota = F.col("_base") + (F.col("_turn") <= F.col("_missing")).cast("bigint")
        q = q.withColumn("_end", F.col("_end") + quota).withColumn(f"upto_{i}", F.col("_end"))
        q = q.withColumn("_left", F.col("n") - F.col("_end"))
    return q.select(label, "n", *[f"upto_{i}" for i in range(len(fractions))])


def assign_splits(
    df: DataFrame,
    label: str,
    key: str,
    fractions: Sequence[float],
    names: Sequence[str],
    seed: int = 42,
    out: str = "split",
    min_classes: int = 1,
) -> DataFrame:
    """Add the split column; ``names`` has one entry more than ``fractions``. ``key`` must be unique."""
    if len(names) != len(fractions) + 1:
        raise ValueError("one name more than fractions is needed")
    hashed = df.select(label, F.col(key).alias("_key"), order_hash(key, seed).alias("_hash"))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, _PREFIX))
    histogram = hashed.groupBy(label, "_bucket").agg(F.count("*").alias("_rows"))
    counts = histogram.groupBy(label).agg(F.sum("_rows").alias("n"))
    quotas = split_quotas(counts, label, fractions, min_classes)
    ends = F.explode(
        F.array(*[F.struct(F.lit(i).alias("part"), F.col(f"upto_{i}").alias("upto")) for i in range(len(fractions))])
    )
    below = F.sum("_rows").over(W.partitionBy(label).orderBy("_bucket")) - F.col("_rows")
    boundaries = (
        histogram.withColumn("_below", below)
        .join(quotas.select(label, ends.alias("_e")), label)  # classes x parts rows
        .where((F.col("_below") < F.col("_e.upto")) & (F.col("_e.upto") <= F.col("_below") + F.col("_rows")))
        .select(label, "_bucket", F.col("_e.part").alias("_part"), (F.col("_e.upto") - F.col("_below")).alias("_need"))
    )
    rank = F.row_number().over(W.partitionBy(label, "_part").orderBy("_hash", "_key"))
    cuts = (
        hashed.join(boundaries, [label, "_bucket"])  # classes x parts rows
        .withColumn("_rank", rank)
        .where(F.col("_rank") == F.col("_need"))
        .groupBy(label)
        .agg(
            *[
                F.max(F.when(F.col("_part") == i, F.struct("_hash", "_key"))).alias(f"_cut_{i}")
                for i in range(len(fractions))
            ]
        )
    )
    own = F.struct(order_hash(key, seed).alias("_hash"), F.col(key).alias("_key"))
    chosen = F.lit(names[-1])
    for i in reversed(range(len(fractions))):
        chosen = F.when(own <= F.col(f"_cut_{i}"), names[i]).otherwise(chosen)
    # Written, so that its size is known: the optimizer then broadcasts it unless the classes are very many.
    cuts = materialize(cuts, "cuts")
    # Left join: a class all of whose earlier parts are empty has no boundary and belongs to the last part.
    return df.join(cuts, label, "left").withColumn(out, chosen).select(*df.columns, out)


def stratified_split(
    df: DataFrame,
    label: str = "label",
    frac: float = 0.1,
    seed: int = 42,
    key: str = "doc_id",
    names: Sequence[str] = ("train", "val"),
) -> DataFrame:
    """Two parts; the second holds exactly ``ceil(frac * rows)`` rows with the class ratios kept."""
    return assign_splits(df, label, key, [frac], names, seed)


def split_60_20_20(
    df: DataFrame,
    label: str = "label",
    seed: int = 42,
    key: str = "doc_id",
    names: Sequence[str] = ("train", "val", "test"),
    min_classes: int = 1,
) -> DataFrame:
    """Forty percent held out, then halved."""
    return assign_splits(df, label, key, [0.4, 0.5], names, seed, min_classes=min_classes)
