"""First arrivals among streamed articles, with a verdict on every row.

Each pass is a ``transformWithState`` operator over buckets of keys: the state of a key is one small entry in its bucket's
map, the order of the row that came first, and it expires. Needs the RocksDB state store (``use_rocksdb``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpusloom.functions.normalize import normalize_title, normalize_url

FIRST, REPEAT, LATE, UNDATED = "first", "repeat", "late", "undated"
_ORDER = ["time", "place", "own"]
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Settings that the passes need. Without data no batch is run: with a processing clock one would follow another for
    ever, also under ``availableNow``; what has expired goes with the next data."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")


class FirstOfKey(StatefulProcessor):
    """Of each key's rows that are ``first`` so far, the earliest stays so, unless the state knows an earlier batch's; the
    others are ``repeat``. Rows with another verdict pass.

    A call takes a bucket of keys, since a call per key costs some ten milliseconds; the state holds an entry per key,
    which expires by itself. Of a batch, only the earliest rows of a bucket's new keys are held.
    """

    def __init__(self, keys: Sequence[str], ttl_ms: int):
        self.keys, self.ttl_ms = list(keys), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        names = ", ".join(f"{k} string" for k in self.keys)
        self.seen = handle.getMapState("seen", names, "time timestamp, place string, own string", self.ttl_ms)

    def _split(self, parts: list[pd.DataFrame]) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The earliest row of each key, and the others."""
        rows = pd.concat(parts).sort_values(_ORDER, kind="stable")
        again = rows.duplicated(self.keys)
        return rows[~again], rows[again].assign(verdict=REPEAT)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []
        for chunk in rows:
            open_ = chunk["verdict"] == FIRST
            if not open_.all():
                yield chunk[~open_]
            parts.append(chunk[open_])
            if sum(map(len, parts[1:])) > len(parts[0]):  # not at every chunk: the earliest are sorted anew each time
                best, later = self._split(parts)
                parts = [best]
                yield later
        best, later = self._split(parts)
        yield later
        names = list(best[self.keys].itertuples(index=False, name=None))
        if names and self.seen.exists():
            held = pd.Series([self.seen.containsKey(n) for n in names], index=best.index, dtype=bool).to_numpy()
            yield best[held].assign(verdict=REPEAT)
            best, names = best[~held], [n for n, h in zip(names, held, strict=True) if not h]
        for name, time, place, own in zip(names, best["time"], best["place"], best["own"], strict=True):
            self.seen.updateValue(name, (None if pd.isna(time) else time.to_pydatetime(), place, own))
        yield best

    def close(self) -> None:
        pass


def _pass(stream: DataFrame, keys: Sequence[str], ttl_ms: int, buckets: int) -> DataFrame:
    grouped = stream.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).groupBy("bucket")
    schema = T.StructType([*stream.schema.fields, T.StructField("bucket", T.IntegerType())])
    return grouped.transformWithStateInPandas(FirstOfKey(keys, ttl_ms), schema, "Append", "ProcessingTime").drop("bucket")


def stream_first_articles(
    stream: DataFrame,
    key: str = "page_id",
    date: str = "publish_ts",
    source: str = "source",
    url: str = "url",
    title: str = "title",
    arrived: str | None = None,
    recent_days: int = 31,
    ttl_days: float = 32,
    salts: int = 1,
    buckets: int = 256,
) -> DataFrame:
    """Every row with its ``verdict``: ``first`` (by normalised URL, and among these by normalised title, in its source),
    ``repeat``, ``late`` (dated more than ``recent_days`` before its arrival) or ``undated``.

    Arrival is the column ``arrived`` (a timestamp) or, for a stream of files, the file's time; equal times go by file and
    ``key``. Late and undated rows leave no trace in the state. Rows without a URL or title are exempt from that pass.
    A key is forgotten ``ttl_days`` after its first row came (of the processing clock), so the state holds one value per URL
    and title of that time. With ``salts`` above 1 a pass goes in two rounds, the first per key and salt, so that a
    key with very many rows in a batch is thinned out by several tasks. ``buckets`` (fixed for a checkpoint) says into how
    many groups the keys of a pass are dealt: more for batches of very many new keys, which a task holds bucket by bucket.
    """
    ttl_ms = max(1, int(ttl_days * 86_400_000))
    own = F.coalesce(F.col(key).cast("string"), F.lit(""))
    time = F.col(arrived).cast("timestamp") if arrived else F.col("_metadata.file_modification_time")
    place = F.lit("") if arrived else F.concat_ws("#", "_metadata.file_path", F.lpad(F.col("_metadata.file_block_start"), 15, "0"))
    when = F.col(date).cast("timestamp")
    exempt = F.concat(F.lit("#"), own)
    verdict: Column = F.when(when.isNull(), UNDATED).when(when < time - F.make_dt_interval(F.lit(recent_days)), LATE)
    # rows travel under plain names, whatever the columns are called, and numbers as text, since pandas has no null for them
    fields = [(f"c{i}", f.name, f.dataType) for i, f in enumerate(stream.schema.fields)]
    rows = stream.select(
        *[(F.col(f"`{c}`").cast("string") if isinstance(t, _NUMBERS) else F.col(f"`{c}`")).alias(n) for n, c, t in fields],
        time.alias("time"), place.alias("place"), F.lpad(own, 20, "0").alias("own"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("site"),
        F.coalesce(normalize_url(url), exempt).alias("url"),
        F.coalesce(F.nullif(normalize_title(title), F.lit("")), exempt).alias("title"),
        verdict.otherwise(FIRST).alias("verdict"),
    )
    for name in ("url", "title"):
        if salts > 1:
            salted = rows.withColumn("salt", F.pmod(F.xxhash64("own", "place"), F.lit(salts)).cast("string"))
            rows = _pass(salted, ["site", name, "salt"], ttl_ms, buckets).drop("salt")
        rows = _pass(rows, ["site", name], ttl_ms, buckets)
    return rows.select(*[F.col(n).cast(t).alias(c) if isinstance(t, _NUMBERS) else F.col(n).alias(c) for n, c, t in fields], "verdict")


def write_verdicts(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """One folder per verdict: the first arrivals, and as side outputs the repeats, the late and the undated rows."""
    writer = rows.writeStream.format("parquet").partitionBy("verdict").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)


def read_verdicts(spark: SparkSession, path: str, schema: T.StructType, verdict: str = FIRST) -> DataFrame:
    full = T.StructType([*[f for f in schema if f.name != "verdict"], T.StructField("verdict", T.StringType())])
    return spark.read.schema(full).parquet(path).where(F.col("verdict") == verdict).drop("verdict")
