"""Removal of repeated word windows, level by level.

Windows of half the size are looked for first, at the anchors that winnowing picks: each full window holds one. Those
that occur once end there. The others are extended to twice the length: an anchor's full windows are equal to another
document's where all they can reach is equal, and only one member of each class with such a context has its full
windows hashed and looked up among the other classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import repeats
from corpusloom.llm.common import Words, documents, id_or_null


def _words():
    words = Words()
    # bytes.split() splits at just the six signs 0x20 and 0x09-0x0D
    return lambda body: words.hashes(body.split())


def remove_repeats(df: DataFrame, key: str, text: str, window: int = 50) -> DataFrame:
    """Remove every word covered by a ``window``-word sequence that also starts in a document with a smaller key.

    Words are runs of anything but ASCII white space, unchanged. Per row: ``key``, ``n_words``, ``removed`` (maximal
    stretches of words, ``s`` to before ``e``) and ``kept`` (the other words, joined by one space, as UTF-8). Null
    texts have no words; texts shorter than the window keep all. A null key is smaller than any other. Rows with the
    same key are no reason to remove anything from each other. Other columns are not looked at.
    """
    size = (window + 1) // 2
    reach = window - size
    docs = documents(df, key, text)
    anchors = repeats.repeated(repeats.find_anchors(docs, _words, window, size))
    classes = repeats.classes(anchors)
    rows = repeats.window_hashes(classes, docs, _words, window, size)
    # of each full window the first document; the rest of the group is never gathered
    firsts = rows.groupBy("gram", "back", "hash").agg(F.min("id").alias("least_id"))
    lost = (
        rows.join(firsts, ["gram", "back", "hash"])
        .where("least_id < id")
        .groupBy("gram", "ctx")
        .agg(F.max("back").alias("most"), F.min("back").alias("least"))
    )
    heads = classes.select("gram", "ctx", F.col("id").alias("head")).join(lost, ["gram", "ctx"], "left")
    full = [F.lit(reach).alias("most"), F.lit(0).alias("least")]
    later = anchors.where("NOT one").join(heads, ["gram", "ctx"])
    covered = (
        anchors.where("one AND id > first")
        .select("id", "tag", "pos", *full)
        .union(later.where("id > head").select("id", "tag", "pos", *full))
        .union(later.where("id = head AND most IS NOT NULL").select("id", "tag", "pos", "most", "least"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                sizes, removed, kept = [], [], []
                for body, own in zip(part.column(1), part.column(2), strict=True):
                    words = body.as_py().split()
                    gone = repeats.merged(own.as_py(), len(words))
                    ends = [0, *(x for s in gone for x in s), len(words)]
                    sizes.append(len(words))
                    removed.append([{"s": s, "e": e} for s, e in gone])
                    kept.append(b" ".join([w for a, b in zip(ends[::2], ends[1::2], strict=True) for w in words[a:b]]))
                kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
                    ["k", "n_words", "removed", "kept"],
                )

    out = (
        docs.join(repeats.spans(covered, window, size), ["id", "tag"], "left")
        .select(F.col("id").alias("k"), "body", "spans")
        .mapInArrow(run, "k long, n_words long, removed array<struct<s: long, e: long>>, kept binary")
    )
    return out.select(id_or_null(F.col("k")).alias(key), "n_words", "removed", "kept")
