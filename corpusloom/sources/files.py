"""File readers with declared schemas, and the checks around them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.operators.aggregates import length_stats
from corpusloom.session import materialize
from corpusloom.sources import resilient

# Field contents that mean "missing" in the source data's tools, besides the empty field.
MISSING = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or ``ValueError`` naming what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def _with_missing(df: DataFrame, missing: Sequence[str]) -> DataFrame:
    """String fields that spell a missing value become null. An empty field is null already."""
    if not missing:
        return df
    clean = lambda c: F.when(~F.col(c).isin(list(missing)), F.col(c)).alias(c)
    return df.select(*[clean(f.name) if isinstance(f.dataType, T.StringType) else f.name for f in df.schema])


def _read_by_name(spark: SparkSession, path: str | list[str], schema: str, **options) -> DataFrame:
    """The declared columns, found by their names in the header, whatever their order and whatever else is there.

    The header is looked up in the first file; files whose header differs fail instead of swapping columns.
    """
    declared = {f.name: f for f in T.StructType.fromDDL(schema)}
    header = spark.read.options(**_CSV | options).csv(path).columns
    found = T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in header])
    rows = spark.read.schema(found).options(**_CSV | options, enforceSchema=False).csv(path)
    return require_columns(rows, list(declared)).select(*declared)


def read_labeled(
    spark: SparkSession,
    path: str,
    schema: str = schemas.SPLIT_FILE,
    missing: Sequence[str] = MISSING,
    multi_line: bool = True,
) -> DataFrame:
    """Labelled CSV with a header and quoted text, or Parquet when the path says so.

    Quoted fields may hold line breaks, for which a file is one task; ``multi_line=False`` splits large files that have
    none. To read such a corpus more than once, land it as Parquet first.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    return _with_missing(_read_by_name(spark, path, schema, multiLine=multi_line), missing)


def read_word_tsv(spark: SparkSession, path: str | list[str], missing: Sequence[str] = MISSING) -> DataFrame:
    """Word-level corpus: one row per word, eight tab-separated columns and one line each, so large files split."""
    return _with_missing(_read_by_name(spark, path, schemas.WORD_LEVEL, sep="\t", multiLine=False), missing)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def available(spark: SparkSession, inputs: dict[str, str]) -> dict[str, str]:
    """The named inputs whose path (or glob) exists; the rest are left out."""
    return {name: path for name, path in inputs.items() if path_exists(spark, path)}


@dataclass(frozen=True)
class TolerantRead:
    """Accepted rows, rejected raw records with their file, and the last word on each file."""

    rows: DataFrame
    rejected: DataFrame
    files: DataFrame

    def report(self) -> DataFrame:
        """One row per input file: ``input_file``, ``accepted``, ``rejected``, ``status`` and ``error``.

        ``status`` is ``read`` (to its end), ``damaged`` (an error ended it; the counts say what came before),
        ``no record`` or ``no column`` (a declared column is not in its header).
        """
        counted = self.rows.groupBy("input_file").agg(F.count("*").alias("accepted"))
        refused = self.rejected.groupBy("input_file").agg(F.count("*").alias("rejected"))
        zero = lambda name: F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)
        return (
            self.files.select("input_file", "status", "error")
            .join(counted, "input_file", "left")
            .join(refused, "input_file", "left")
            .select("input_file", zero("accepted"), zero("rejected"), "status", "error")
        )


def read_tolerant(spark: SparkSession, path: str | list[str], schema: str, fmt: str = "csv") -> TolerantRead:
    """Read what can be read, from every file once: it lands as Parquet, from which all three frames read.

    A record is rejected if it has the wrong number of fields, is no valid UTF-8 or JSON, ends with the file in an open
    quote, or holds a value that its column's type cannot take. Columns are found by name. Columns the schema
    declares ``NOT NULL`` are not enforced here; use a filter for that.
    """
    fields = T.StructType.fromDDL(schema).fields
    landed = materialize(resilient.read_files(spark, path, [f.name for f in fields], fmt), "tolerant")
    cast = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in fields}
    wrong = reduce(
        lambda x, y: x | y, [F.col(f"`{name}`").isNotNull() & value.isNull() for name, value in cast.items()], F.lit(False)
    )
    records = landed.where("status IS NULL AND record IS NULL")
    refused = F.array_join(F.array(*[F.col(f"`{f.name}`") for f in fields]), ",", "").alias("record")
    return TolerantRead(
        rows=records.where(~wrong).select(*[value.alias(name) for name, value in cast.items()], "input_file"),
        rejected=landed.where("record IS NOT NULL").select("record", "input_file").union(
            records.where(wrong).select(refused, "input_file")
        ),
        files=landed.where("status IS NOT NULL").select("input_file", "status", "error"),
    )


def profile_files(
    spark: SparkSession, files: str | dict[str, str], limit: int = 510, column: str = "text", fmt: str = "auto"
) -> DataFrame:
    """Length profile of every input, one row each, with its ``status``, ``accepted`` and ``rejected``.

    ``files`` is a glob or a folder, or files (or folders) by name. Inputs of one name are profiled together; a damaged one
    by what could be read of it, and one without the column, or without records, has nulls. All formats are read in
    one pass, and only the profiles' counters are shuffled.
    """
    by_name = {} if isinstance(files, str) else files
    tail = F.element_at(F.split("input_file", "/"), -1)
    landed = materialize(resilient.read_files(spark, list(by_name.values()) or files, [column], fmt), "profiled")
    name = tail
    for label, path in by_name.items():
        root = F.lit(re.sub("^file:/+", "/", path).rstrip("/"))
        plain = F.regexp_replace("input_file", "^file:/+", "/")
        name = F.when((plain == root) | plain.startswith(F.concat(root, F.lit("/"))), F.lit(label)).otherwise(name)
    named = landed.withColumn("input_name", name)
    texts = named.where("status IS NULL AND record IS NULL").select("input_name", F.col(column))
    worst = F.array(*[F.lit(s) for s in (resilient.DAMAGED, resilient.READ, resilient.NO_COLUMN, resilient.NO_RECORD)])
    said = (
        named.where("status IS NOT NULL")
        .groupBy("input_name")
        .agg(
            F.element_at(worst, F.min(F.array_position(worst, F.col("status"))).cast("int")).alias("status"),
            F.sum("accepted").alias("accepted"),
            F.sum("rejected").alias("rejected"),
        )
    )
    return said.join(length_stats(texts, column, limit, by=["input_name"]), "input_name", "left")
