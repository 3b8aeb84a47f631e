"""A training corpus from ``documents``: one operator of ``corpusloom.llm`` per stage.

Each stage works on all that its predecessor kept and returns the columns of ``documents``; the last returns digests of
the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import minhash, secrets, toxicity, winnowing
from corpusloom.llm.common import row_id, table, text_hash
from corpusloom.llm.queries import bpe_digests, is_toxic, toxicity_model
from corpusloom.session import materialize


def _named(docs: DataFrame) -> DataFrame:
    """With ``_row``, a hash of id and text: rows that share an id, or have none, are judged by their own text alone."""
    return docs.withColumn("_row", F.xxhash64(row_id("doc_id"), text_hash("text")))


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose ``_row`` is not in ``dropped``."""
    return _named(docs).join(dropped.select("_row"), "_row", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return _without(docs, toxicity.toxicity(_named(docs), "_row", "text", model).where(is_toxic()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, and one row of those that repeat it."""
    rows = minhash.linked(docs, "doc_id", "text").where("id <> head.id OR tag <> head.tag")
    kept = _without(docs, rows.select(F.xxhash64("id", "tag").alias("_row")))
    return _named(kept).dropDuplicates(["_row"]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = winnowing.contamination(_named(docs), table(spark, sf_dir, "benchmark"), "_row")
    return _without(docs, rows.where(winnowing.is_contaminated()))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; ``n_chars`` follows where it was the text's length."""
    clean = secrets.redact(docs, "doc_id", "text", secrets.scan(docs, "doc_id", "text"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode),
]
#: SQL can state neither the scores nor the merges; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
