"""Writers. Every frame is written by its tasks; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.sets import union_sources
from corpusloom.schemas import ORIGINAL_LABELS
from corpusloom.sinks.ledger import Ledger

CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _write(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists", partition: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV)
    if partition:
        writer = writer.partitionBy(*partition)
    writer.save(path)


def write_splits(
    df: DataFrame, path: str, label: str = "binary_label", fmt: str = "csv", mode: str = "errorifexists"
) -> None:
    """``(text, label)`` in one folder per split."""
    _write(df.select("text", F.col(label).alias("label"), "split"), path, fmt, mode, ["split"])


def write_basic_detailed(
    df: DataFrame,
    path: str,
    basic: Sequence[str],
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition: Sequence[str] = (),
) -> None:
    """All columns to ``<path>/detailed``, the ``basic`` ones to ``<path>/basic``.

    The second copy is read from the first, so the frame is computed once and nothing is cached.
    """
    _write(df, f"{path}/detailed", fmt, mode, partition)
    ordered = [f.name for f in df.schema if f.name not in partition] + list(partition)  # as stored
    reader = df.sparkSession.read.schema(df.select(*ordered).schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV, multiLine=True)
    _write(reader.load(f"{path}/detailed").select(*basic), f"{path}/basic", fmt, mode, partition)


def append_annotations(df: DataFrame, path: str, key: str = "row_id", batch: str | None = None) -> int:
    """Append the rows whose key the table does not hold yet, so that a rerun adds nothing; how many.

    Only the touched buckets of the key index are read (``sinks.ledger``), never the rows. A ``batch`` that has been
    appended before is left alone altogether. Read the table with ``read_annotations``.
    """
    return Ledger(df.sparkSession, path, key).append(df, batch)


def read_annotations(spark: SparkSession, path: str, key: str = "row_id") -> DataFrame | None:
    """The rows of all committed batches; None before the first."""
    return Ledger(spark, path, key).rows()


REVIEW_BUCKETS = 64


def append_reviews(df: DataFrame, path: str) -> None:
    """Append reviews, partitioned by a hash bucket of the title.

    A folder per title would be one folder per title and batch; a bucket prunes as well for a lookup by
    title. Rebalancing keeps the files large and splits a bucket with many rows.
    """
    bucket = F.pmod(F.xxhash64("movie_id"), F.lit(REVIEW_BUCKETS)).cast("int")
    bucketed = df.withColumn("movie_bucket", bucket).hint("rebalance", "movie_bucket")
    _write(bucketed, path, "parquet", "append", ["movie_bucket"])


def read_reviews(spark: SparkSession, path: str, movie_id: str | None = None) -> DataFrame:
    """All reviews, or those of one title (its bucket only)."""
    rows = spark.read.parquet(path)
    if movie_id is not None:
        wanted = F.pmod(F.xxhash64(F.lit(movie_id)), F.lit(REVIEW_BUCKETS)).cast("int")
        rows = rows.where((F.col("movie_bucket") == wanted) & (F.col("movie_id") == movie_id))
    return rows.drop("movie_bucket")


def summary_frame(
    metrics: DataFrame,
    classes: DataFrame,
    breakdown: DataFrame,
    comparison: DataFrame,
    domains: Sequence[str] = ("Reddit", "News"),
    model_path: Column | None = None,
) -> DataFrame:
    """One nested row per model, ready for JSON: metrics and breakdown per domain, label map, comparison.

    Inputs are the metric frames by model and domain (a handful of rows each).
    """

    def pick(frame: DataFrame, name: str, value: Column) -> Column:
        return F.max(F.when(F.col("domain") == name, value))

    def per_label(key: str, names: Sequence[str], value: Column) -> list[Column]:
        return [F.max(F.when(F.col(key) == n, value)).alias(n) for n in names]

    scores = F.struct("precision", "recall", "f1", "support")
    by_class = classes.groupBy("model", "domain").agg(
        F.struct(*per_label("class", ("literal", "figurative"), scores)).alias("per_class")
    )
    cell = F.struct("total", "correct", "accuracy", "maps_to")
    by_label = breakdown.groupBy("model", "domain").agg(
        F.struct(*per_label("label", ORIGINAL_LABELS, cell)).alias("breakdown_by_original_label")
    )
    joined = metrics.join(by_class, ["model", "domain"]).join(by_label, ["model", "domain"])
    block = F.struct(
        F.struct(
            "model", F.lit("binary").alias("task"), "accuracy", "f1_macro", "f1_weighted", "per_class"
        ).alias("binary_metrics"),
        "breakdown_by_original_label",
    )
    wide = joined.groupBy("model").agg(*[pick(joined, d, block).alias(d.lower()) for d in domains])
    mapping = F.struct(*[F.lit("literal" if n == "literal" else "figurative").alias(n) for n in ORIGINAL_LABELS])
    compared = comparison.select(
        "model", F.struct("accuracy_diff", "f1_macro_diff", "better_domain", "improvement_pct").alias("comparison")
    )
    return wide.join(compared, "model").select(
        "model",
        (model_path if model_path is not None else F.lit(None).cast("string")).alias("model_path"),
        F.lit("binary_classification").alias("task"),
        mapping.alias("label_mapping"),
        *[d.lower() for d in domains],
        "comparison",
    )


def write_summary(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, one nested object per model."""
    _write(df, path, "json", mode)


def report_lines(df: DataFrame, title: str, key: str | None = None, section: int = 0) -> DataFrame:
    """``(line_no, line)``: a title and ``name: value`` for every column of a small statistics frame."""
    types = dict(df.dtypes)
    names = [c for c in df.columns if c != key]

    def shown(c: str) -> Column:
        value = F.format_string("%.4f" if "rate" not in c and "mean" not in c else "%.1f", F.col(c).cast("double"))
        return F.coalesce(value if types[c] == "double" else F.col(c).cast("string"), F.lit("n/a"))

    number = lambda *parts: F.concat_ws("|", F.lpad(F.lit(section).cast("string"), 3, "0"), *parts)
    group = F.coalesce(F.col(key).cast("string"), F.lit("")) if key else F.lit("")
    label = F.concat(group, F.lit(" ")) if key else F.lit("")
    lines = F.array(*[F.concat(label, F.lit(f"{c.replace('_', ' ')}: "), shown(c)) for c in names])
    body = df.select(group.alias("_group"), F.posexplode(lines).alias("i", "line"))
    body = body.select(number(F.lit("1"), "_group", F.lpad(F.col("i").cast("string"), 4, "0")).alias("line_no"), "line")
    head = df.sparkSession.range(1).select(number(F.lit("0")).alias("line_no"), F.lit(title).alias("line"))
    return head.unionByName(body)


def write_report(sections: Sequence[tuple[str, DataFrame, str | None]], path: str, mode: str = "errorifexists") -> None:
    """Plain-text report as one file. A section is a title, a small statistics frame and its key column, if any."""
    parts = [report_lines(frame, title, key, i) for i, (title, frame, key) in enumerate(sections)]
    lines = union_sources(parts).orderBy("line_no").select("line")
    lines.coalesce(1).write.mode(mode).text(path)  # a few lines by construction


def write_evaluation(
    frames: dict[str, DataFrame], path: str, mode: str = "errorifexists", by: Sequence[str] = ()
) -> None:
    """One CSV folder per frame of an evaluation, and the text summary of its metrics; ``by`` as in ``jobs.evaluate``."""
    for name, frame in frames.items():
        _write(frame, f"{path}/{name}", "csv", mode)

    def keyed(frame: DataFrame, key: str | None) -> tuple[DataFrame, str | None]:
        if not by:
            return frame, key
        name = F.concat_ws(" ", *by, *([key] if key else []))
        return frame.withColumn("_of", name).drop(*by, *([key] if key else [])), "_of"

    summary = [
        (title, *keyed(frames[name], key))
        for title, name, key in (
            ("Scores", "overall_metrics", None),
            ("Outcomes", "confusion_matrix", "true_label"),
            ("Scores of each class", "per_class_metrics", "class"),
        )
        if name in frames
    ]
    if summary:
        write_report(summary, f"{path}/evaluation_summary", mode)


def write_comparison(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``(Domain, Macro_F1, Model)`` as CSV."""
    _write(df.select("Domain", "Macro_F1", "Model"), path, "csv", mode)


