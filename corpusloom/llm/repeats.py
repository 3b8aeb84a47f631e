"""Repeated windows over a corpus, found through content-chosen anchors.

Both substring operators ask which windows of a fixed size occur elsewhere. A row per window would be a row per byte
or word. Instead winnowing picks anchors: places whose short hash is the least among its neighbours, so that every
window holds one and equal windows hold it at the same distance. Windows can be equal only if they lie around anchors
with equal hashes; those that occur once are dropped. Anchors with the same hash fall into classes with equal
contexts (all that a window around the anchor can reach), and only one member of a class is ever compared with the
other classes. All counts are taken before and after the shuffle, so a passage with a third of all rows is one row per
task.

Rows: ``gram`` (hash at the anchor), ``ctx`` (hash of its context), ``id``, ``tag`` (document), ``pos`` (place).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import GRAM, anchor_rows, as_long
from corpusloom.session import discard, materialize

#: From a text's bytes to its items: the values that are hashed.
Items = Callable[[bytes], np.ndarray]
ANCHORS = "gram long, ctx long, id long, tag long, pos long"


def find_anchors(docs: DataFrame, items: Callable[[], Items], window: int, size: int) -> DataFrame:
    """The anchors of all documents (``id``, ``tag``, ``body``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = items()
        for batch in batches:
            ids, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, body in enumerate(batch.column(2)):
                place, gram, context = anchor_rows(read(body.as_py()), window, size)
                if len(place):
                    n = len(place)
                    for column, x in zip(out, (gram, context, np.full(n, ids[i]), np.full(n, tags[i]), place), strict=True):
                        column.append(x)
                if i % 500 == 499 or i == batch.num_rows - 1:
                    if out[0]:
                        yield pa.RecordBatch.from_arrays(
                            [as_long(np.concatenate(c)) for c in out], ["gram", "ctx", "id", "tag", "pos"]
                        )
                    out = [[], [], [], [], []]

    return docs.select("id", "tag", "body").mapInArrow(run, ANCHORS)


def repeated(found: DataFrame) -> DataFrame:
    """The anchors whose hash occurs twice at least, with the first document (``first``) and, in ``one``, whether all
    their contexts are equal. Written once: later steps read it several times."""
    found = materialize(found, "found")
    # written too, so that the join deals out both sides anew and Spark can split a hash with very many rows
    grams = materialize(
        found.groupBy("gram")
        .agg(F.count("*").alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi"), F.min("id").alias("first"))
        .where("n > 1")
        .select("gram", (F.col("lo") == F.col("hi")).alias("one"), "first"),
        "grams",
    )
    # the number of hashes grows with the input, so the plan must not depend on how few there are: no broadcast
    anchors = materialize(found.join(grams.hint("merge"), "gram"), "anchors")
    discard(found, grams)
    return anchors


def classes(anchors: DataFrame) -> DataFrame:
    """One row per class of anchors that has others with the same hash: size ``n``, first member, number of classes and
    the least size among them."""
    own = (
        anchors.where("NOT one")
        .groupBy("gram", "ctx")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "tag", "pos")).alias("rep"))
        .select("gram", "ctx", "n", "rep.*")
    )
    own = materialize(own, "own")
    numbers = own.groupBy("gram").agg(F.count("*").alias("n_classes"), F.min("n").alias("least_n"))
    return materialize(own.join(numbers.hint("merge"), "gram"), "classes")


def with_text(reps: DataFrame, docs: DataFrame, *fields: str) -> DataFrame:
    """Documents that hold a representative, each with the list of its own."""
    lists = reps.groupBy("id", "tag").agg(F.collect_list(F.struct(*fields)).alias("reps"))
    return docs.join(lists, ["id", "tag"])


def window_hashes(reps: DataFrame, docs: DataFrame, items: Callable[[], Items], window: int, size: int) -> DataFrame:
    """Every window around each representative: ``gram``, ``ctx``, ``back`` (how far before the anchor it begins),
    ``hash`` and the representative's document. One row per window, so no group is ever gathered."""
    reach = window - size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = items()
        for batch in batches:
            for own, body, reps_of in zip(*(batch.column(i) for i in range(3)), strict=True):
                values = read(body.as_py())
                rows = reps_of.as_py()
                for k in range(0, len(rows), 2000):
                    part = rows[k : k + 2000]
                    place = np.array([r["pos"] for r in part])
                    # positions are hashed as slices of the whole text
                    start = place[:, None] - np.arange(reach + 1)[None, :]
                    ok = (start >= 0) & (start + window <= len(values))
                    flat = start[ok]
                    if not len(flat):
                        continue
                    low = int(flat.min())
                    prefix = GRAM.prefix(values[low : int(flat.max()) + window])
                    hashes = GRAM.slices(prefix, flat - low, flat - low + window)
                    which, back = np.nonzero(ok)
                    gram = np.array([r["gram"] for r in part])[which]
                    context = np.array([r["ctx"] for r in part])[which]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram), pa.array(context), pa.array(back), as_long(hashes), pa.array(np.full(len(gram), own.as_py()))],
                        ["gram", "ctx", "back", "hash", "id"],
                    )

    joined = with_text(reps, docs, "gram", "ctx", "pos").select("id", "body", "reps")
    return joined.mapInArrow(run, "gram long, ctx long, back long, hash long, id long")


def spans(anchors: DataFrame, window: int, size: int) -> DataFrame:
    """The stretches that an anchor's removed windows cover, gathered per document. ``most`` and ``least`` say how
    far before the anchor the first and the last of those windows begin (more than exist at a text's end are cut).
    Rows with the same id and text send the same stretches, which count once."""
    start = F.greatest(F.col("pos") - F.col("most"), F.lit(0))
    end = F.col("pos") + window - F.col("least")
    return anchors.groupBy("id", "tag").agg(F.collect_set(F.struct(start.alias("s"), end.alias("e"))).alias("spans"))


def merged(spans: list[dict] | None, n: int) -> list[tuple[int, int]]:
    """The union of the stretches, in order, within a text of ``n`` items."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], min(x["e"], n)) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        elif s < e:
            out.append([s, e])
    return [(s, e) for s, e in out]
