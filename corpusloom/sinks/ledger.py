"""Appends that happen once: a ledger of batches, and an index of the keys that are there.

Below a table's folder lie its rows (``attempt=<id>/``), the index (``_index-<version>/attempt=<id>/bucket=<n>/``, key
columns alone) and the ledger (``_ledger/``, a row per committed batch). An append writes its rows, then its part of the
index, then its line of the ledger; what no line names does not count, so a crash in between leaves nothing behind
but files that ``compact`` removes, and a batch that is delivered again is found in the ledger and adds nothing.

An append looks its keys up in the index, of which it reads the buckets that its own keys fall into. Index files carry
Bloom filters on the key, which a lookup of single keys uses. One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.files import path_exists

#: Index buckets. More for large tables: an append reads the buckets it touches, and a bucket is a file per batch.
BUCKETS = 64
_LEDGER = "batch string, attempt string, n_rows bigint"
_MERGED = "merged"


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Ledger:
    """One table's committed batches and key index. ``key`` is hashed into ``buckets``, which is fixed for the table."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def batches(self) -> DataFrame:
        path = f"{self.root}/_ledger"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(path)

    def has(self, batch: str) -> bool:
        return not self.batches().where(F.col("batch") == batch).isEmpty()

    def _committed(self, df: DataFrame) -> DataFrame:
        return df.join(self.batches().select("attempt").union(self.spark.createDataFrame([(_MERGED,)], "attempt string")), "attempt", "left_semi")

    def rows(self) -> DataFrame | None:
        """The rows of all committed batches; None before the first."""
        if not path_exists(self.spark, f"{self.root}/attempt=*"):
            return None
        return self._committed(self.spark.read.parquet(self.root)).drop("attempt")

    def _index(self) -> str:
        """The index folder in use: the newest that was written to its end."""
        path, fs = _fs(self.spark, f"{self.root}/_index-*/_SUCCESS")
        found = [re.search(r"_index-(\d+)/_SUCCESS$", s.getPath().toString()) for s in fs.globStatus(path) or []]
        return f"{self.root}/_index-{max([int(m[1]) for m in found if m], default=0)}"

    def known(self, df: DataFrame | None = None) -> DataFrame | None:
        """Index rows of committed batches, of the buckets that ``df``'s keys fall into; None where there are none."""
        path = self._index()
        if not path_exists(self.spark, f"{path}/attempt=*/bucket=*"):
            return None
        index = self.spark.read.parquet(path)
        if df is not None:
            touched = sorted(r[0] for r in df.select(self.bucket().alias("b")).distinct().collect())  # BUCKETS at most
            if len(touched) < self.buckets:
                index = index.where(F.col("bucket").isin(touched))
        return self._committed(index).drop("attempt", "bucket")

    def holds(self, values: Sequence) -> DataFrame:
        """Index rows of a few single keys: one bucket each, and there the files whose Bloom filter admits the key."""
        path = self._index()
        wanted = self.spark.createDataFrame([(v,) for v in values], self.spark.read.parquet(path).select(self.key).schema)
        touched = [r[0] for r in wanted.select(self.bucket()).distinct().collect()]
        rows = self.spark.read.parquet(path).where(F.col("bucket").isin(touched) & F.col(self.key).isin(list(values)))
        return self._committed(rows).drop("attempt", "bucket")

    def _write(self, indexed: DataFrame, partitions: list[str], path: str, n_rows: int) -> None:
        """A file per bucket, sorted, with a Bloom filter of the size that a bucket's share of the keys needs."""
        keys = str(max(100, 2 * n_rows // self.buckets))
        writer = indexed.repartition("bucket").sortWithinPartitions("bucket", self.key).write.partitionBy(*partitions)
        writer = writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        writer.option(f"parquet.bloom.filter.expected.ndv#{self.key}", keys).mode("overwrite").parquet(path)

    def commit(self, batch: str, index: DataFrame, attempt: str, n_rows: int) -> None:
        """Index rows (the key and whatever belongs to it), then the line that makes the batch count."""
        path = self._index()
        indexed = index.withColumn("bucket", self.bucket())
        self._write(indexed, ["bucket"], f"{path}/attempt={attempt}", n_rows)
        line = self.spark.createDataFrame([(batch, attempt, n_rows)], _LEDGER)
        line.coalesce(1).write.mode("append").parquet(f"{self.root}/_ledger")

    def append(self, df: DataFrame, batch: str | None = None) -> int:
        """Append the rows whose key is not there yet; how many. Nothing where ``batch`` has been committed before.

        Rows of one batch that share a key are all appended. ``df`` is read twice (its keys first).
        """
        batch = batch or uuid.uuid4().hex
        if self.has(batch):
            return 0
        known = self.known(df)
        fresh = df if known is None else df.join(known.select(self.key), self.key, "left_anti").select(*df.columns)
        attempt = uuid.uuid4().hex
        fresh.write.mode("overwrite").parquet(f"{self.root}/attempt={attempt}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.root}/attempt={attempt}")
        n_rows = written.count()
        self.commit(batch, written.select(self.key).distinct(), attempt, n_rows)
        return n_rows

    def compact(self, merge=None) -> None:
        """One index file per bucket instead of one per bucket and batch, and no files of attempts that never counted.

        ``merge`` may reduce the index rows of a key to one.
        """
        old = self._index()
        known = self.known()
        if known is None:
            return
        known = known.distinct() if merge is None else merge(known)
        new = f"{self.root}/_index-{int(old.rpartition('-')[2]) + 1}"
        indexed = known.withColumn("bucket", self.bucket()).withColumn("attempt", F.lit(_MERGED))
        total = self.batches().agg(F.sum("n_rows")).first()[0]
        self._write(indexed, ["attempt", "bucket"], new, total or 0)
        path, fs = _fs(self.spark, old)
        fs.delete(path, True)
        counted = {r.attempt for r in self.batches().select("attempt").collect()}  # one short line per batch
        rows, _ = _fs(self.spark, f"{self.root}/attempt=*")
        for status in fs.globStatus(rows) or []:
            if status.getPath().getName().partition("=")[2] not in counted:
                fs.delete(status.getPath(), True)
