"""Continuous intake with Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.normalize import normalize_title, normalize_url
from corpusloom.operators.dedupe import dedupe_first
from corpusloom.sinks.writers import append_annotations


def _once(stream: DataFrame, keys: list[str], own: Column, salts: int) -> DataFrame:
    """First arrival per key, in two rounds: per (key, salt), then per key.

    A key with a third of all rows is thinned out by ``salts`` tasks before one task sees it.
    """
    salted = stream.withColumn("_salt", F.pmod(F.xxhash64(own), F.lit(salts)))
    return salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt").dropDuplicatesWithinWatermark(keys)


def stream_articles(
    stream: DataFrame,
    key: str = "page_id",
    date: str = "publish_ts",
    delay: str = "32 days",
    source: str = "source",
    url: str = "url",
    title: str = "title",
    salts: int = 16,
) -> DataFrame:
    """Drop repeats of a normalised URL, then of a normalised title, within a source.

    Rows without a date are dropped first. State lives as long as the watermark: ``delay`` behind the
    newest date seen, so recency is relative to the events, not to a clock. The first arrival wins. Rows
    without a URL or title are exempt from that pass (their own key stands in). For large state run with
    the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    own = F.concat(F.lit("#"), F.col(key).cast("string"))
    dated = stream.where(F.col(date).isNotNull()).withWatermark(date, delay)
    keyed = dated.withColumns(
        {
            "url_key": F.coalesce(normalize_url(url), own),
            "title_key": F.coalesce(F.nullif(normalize_title(title), F.lit("")), own),
        }
    )
    by_url = _once(keyed, [source, "url_key"], F.col(key), salts)
    return _once(by_url, [source, "title_key"], F.col(key), salts).drop("url_key", "title_key")


def stream_annotations(
    stream: DataFrame, sink: str, checkpoint: str, key: str = "row_id", arrived: str | None = None
) -> StreamingQuery:
    """Append annotations as they arrive; redelivered or repeated keys add nothing.

    ``foreachBatch`` delivers at least once. A batch is committed under the query's id and its number, so one that is
    replayed after a crash is found in the ledger and skipped; under a new checkpoint its keys are found in the index. Of
    rows that share a key within a batch, the first to arrive stays: by the column ``arrived`` or, without it, the row of
    the earliest file (streams of files only) and of these the earliest in the file.
    """
    by_file = [F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_path", "file_block_start")]
    when = F.col(arrived) if arrived else F.struct(*by_file)
    seen = stream.select(*stream.columns, when.alias("_arrived"))
    run = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex

    def append(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("_row", F.monotonically_increasing_id())  # rises within a file's split
        first = dedupe_first(numbered, key, ["_arrived", "_row"]).drop("_arrived", "_row")
        append_annotations(first, sink, key, f"{run}-{number}")

    return (
        seen.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
