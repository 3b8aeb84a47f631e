"""Near-duplicate documents by min-max hashing.

A signature keeps both the least and the greatest hash of a set under each permutation, so it takes half as many
hash evaluations as values. Bands of values find candidates, whose links are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import GRAM, Words, id_or_null, mix, row_id, text_hash
from corpusloom.llm.components import components
from corpusloom.session import materialize

#: Two sets that are just similar enough (0.8) agree in no band with a probability of (1 - 0.8 ** 5) ** 32 = 3e-6.
BANDS, VALUES = 32, 5
PERMUTATIONS = BANDS * VALUES // 2
#: Sets of a bucket that are compared in one task; larger buckets are cut into tiles.
TILE = 256


def shingles(body: bytes, words: Words, size: int) -> np.ndarray:
    """The distinct hashes of ``size`` consecutive words (A-Z lower-cased), sorted; of all words, if there are fewer."""
    # bytes.lower() changes A-Z alone, bytes.split() splits at just the six signs 0x20 and 0x09-0x0D
    hashes = words.hashes(body.lower().split())
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    return np.unique(GRAM.grams(GRAM.prefix(hashes), size) + np.uint64(size))


def _doc(key: str, tag: str) -> Column:
    """A document: its id and the hash of its text. Rows that share an id, or have none, may hold different texts."""
    return F.struct(F.col(key).alias("id"), F.col(tag).alias("tag"))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:PERMUTATIONS] | np.uint64(1), seeds[PERMUTATIONS:]


def band_keys(sets: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """One hash per band. A permutation's least value and its greatest go to different bands."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    most = np.zeros(len(factors), np.uint64)
    for i in range(0, len(sets), 2048):
        permuted = sets[i : i + 2048, None] * factors + shifts
        least, most = np.minimum(least, permuted.min(axis=0)), np.maximum(most, permuted.max(axis=0))
    rows = np.concatenate([least.reshape(-1, VALUES), most.reshape(-1, VALUES)])
    keys = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys + np.arange(len(rows), dtype=np.uint64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``id``, ``tag``, ``n`` (set size), ``d1``/``d2`` (digest of the set) and ``bands``; no bands for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (factors, shifts) = Words(), _permutations()
        for batch in batches:
            sizes, first, second, bands = [], [], [], []
            for body in batch.column(2):
                found = shingles(body.as_py(), words, size)
                digest = xxhash.xxh3_128_intdigest(found.tobytes())
                sizes.append(len(found))
                first.append((digest >> 64) - 2**63)
                second.append((digest & (2**64 - 1)) - 2**63)
                bands.append(band_keys(found, factors, shifts).view(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (sizes, first, second)),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["id", "tag", "n", "d1", "d2", "bands"],
            )

    kinds = "id long, tag long, n long, d1 long, d2 long, bands array<long>"
    return docs.select("id", "tag", "body").mapInArrow(run, kinds)


def _with_sets(wanted: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """The full sets (packed) of the documents ``doc`` that are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                sets = [shingles(b.as_py(), words, size).tobytes() for b in part.column(2)]
                columns = [part.column(0), part.column(1), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "tag", "shingles"])

    rows = docs.join(wanted.select("doc.id", "doc.tag"), ["id", "tag"], "left_semi").select("id", "tag", "body")
    sets = rows.mapInArrow(run, "id long, tag long, shingles binary").dropDuplicates(["id", "tag"])
    return sets.select(_doc("id", "tag").alias("doc"), "shingles")


def similar(n_common: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * n_common >= percent * (n_a + n_b - n_common)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``u``, ``v``) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sure = []
            for a, b in zip(batch.column(4), batch.column(5), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                sure.append(similar(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent))
            yield batch.select(_ENDS).filter(pa.array(sure, pa.bool_()))

    left = sets.select(F.col("doc").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("doc").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(left, "u").join(right, "v").select(*_flat("u"), *_flat("v"), "a", "b")
    return _links(both.mapInArrow(run, _KINDS))


_ENDS = ["u_id", "u_tag", "v_id", "v_tag"]
_KINDS = ", ".join(f"{c} long" for c in _ENDS)


def _flat(doc: str) -> list[Column]:
    return [F.col(f"{doc}.{c}").alias(f"{doc}_{c}") for c in ("id", "tag")]


def _links(ends: DataFrame) -> DataFrame:
    return ends.select(_doc("u_id", "u_tag").alias("u"), _doc("v_id", "v_tag").alias("v"))


def _tiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of a bucket that are in different components (``c``) so far.

    A bucket's members are cut into blocks and each two blocks meet in a tile. A component with a block's size or more
    has blocks of its own, which never meet each other; smaller ones share blocks.
    """
    parts = members.groupBy("bucket", "c").agg(F.count("*").alias("m"))
    large = F.col("m") >= TILE
    own = F.when(large, F.ceil(F.col("m") / TILE)).otherwise(0)
    in_bucket = W.partitionBy("bucket")
    parts = parts.select(
        "bucket", "c", large.alias("large"), own.alias("own"),
        F.ceil(F.sum(F.when(large, 0).otherwise(F.col("m"))).over(in_bucket) / TILE).alias("shared"),
        F.sum(own).over(in_bucket).alias("owned"),
        F.coalesce(F.sum(own).over(in_bucket.orderBy("c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("skip"),
    )
    parts = parts.withColumns({"lo": F.col("shared") + F.col("skip"), "hi": F.col("shared") + F.col("skip") + F.col("own")})
    block = F.expr("CASE WHEN large THEN lo + pmod(xxhash64(doc), own) ELSE pmod(xxhash64(c), shared) END")
    blocks = members.join(parts, ["bucket", "c"]).withColumn("block", block)
    others = F.filter(
        F.sequence(F.lit(0).cast("long"), (F.col("shared") + F.col("owned") - 1).cast("long")),
        lambda b: ~F.col("large") | (b < F.col("lo")) | (b >= F.col("hi")),
    )
    placed = blocks.select("bucket", "doc", "c", "n", "block", F.explode(others).alias("other")).select(
        "bucket", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "doc", "c", "n"
    )

    def run(key, group):
        import pandas as pd

        x, y = key[1], key[2]
        group = group.sort_values(["doc_id", "doc_tag"])
        found = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        docs, n, block = group[["doc_id", "doc_tag"]].to_numpy(), group["n"].to_numpy(), group["block"].to_numpy()
        comps = np.unique(group[["c_id", "c_tag"]].to_numpy(), axis=0, return_inverse=True)[1].ravel()
        joined: dict[int, int] = {}

        def root(c: int) -> int:
            while c in joined:
                c = joined[c]
            return c

        universe, place = np.unique(np.concatenate(found), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum([len(f) for f in found])])
        out = []
        for i in range(len(docs) - 1):
            if (comps[i + 1 :] == comps[i]).all():
                continue
            mine = np.zeros(len(universe), bool)
            mine[place[starts[i] : starts[i + 1]]] = True
            rest = place[starts[i + 1] :]
            shared = np.add.reduceat(mine[rest].astype(np.int64), starts[i + 1 : -1] - starts[i + 1])
            enough = (100 * shared >= percent * (n[i] + n[i + 1 :] - shared)) & (comps[i + 1 :] != comps[i])
            if x != y:  # pairs within a block are another tile's
                enough &= block[i + 1 :] != block[i]
            for j in np.nonzero(enough)[0] + i + 1:
                a, b = root(comps[i]), root(comps[j])
                if a != b:
                    joined[max(a, b)] = min(a, b)
                    out.append((*docs[i], *docs[j]))
        return pd.DataFrame(out, columns=_ENDS, dtype="int64")

    tiles = placed.join(sets, "doc").select("bucket", "x", "y", "block", *_flat("doc"), *_flat("c"), "n", "shingles")
    return _links(tiles.groupBy("bucket", "x", "y").applyInPandas(run, _KINDS))


def near_duplicates(df: DataFrame, key: str, text: str, size: int = 4, percent: int = 80) -> DataFrame:
    """Link documents whose sets of ``size``-word shingles have 100 * intersection >= ``percent`` * union.

    Per row: ``key``, ``n_shingles``, ``component_id`` (the smallest key reachable by links, itself included) and
    ``kept`` (it is its component's smallest). A text of fewer words is one shingle; a null text or one without words
    has none and no links. Equal sets are linked. A null key is smaller than any other and shown as null; rows with
    the same key are one node of the graph, which has the links of all their texts.
    """
    rows = materialize(linked(df, key, text, size, percent), "linked")
    # rows that share a key are one node, and a key of several rows may hold several sets
    every = components(rows.select(F.col("id").alias("u"), F.col("head.id").alias("v")))
    out = rows.join(every, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return out.select(
        id_or_null(F.col("id")).alias(key),
        F.col("n").alias("n_shingles"),
        id_or_null(F.col("component")).alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def linked(df: DataFrame, key: str, text: str, size: int = 4, percent: int = 80) -> DataFrame:
    """The links of ``near_duplicates`` among texts, whatever rows share a key: ``id``, ``tag`` (the hash of the text),
    ``n`` and ``head`` of every row, the smallest ``id`` and ``tag`` reachable.

    Equal sets become one node first. In each bucket all sets are then compared with its first one, and components
    are formed; only buckets whose sets are still in different components are compared further, tile by tile. So a
    group of copies or near copies, however large, costs about a comparison per member and bucket, and no link between
    components is missed.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    docs = df.select(row_id(key).alias("id"), text_hash(text).alias("tag"), body)
    signed = materialize(signatures(docs, size), "signatures").withColumn("doc", _doc("id", "tag"))
    full = signed.where("n > 0")
    nodes = materialize(full.groupBy("d1", "d2").agg(F.min("doc").alias("node")), "nodes")
    same = full.join(nodes, ["d1", "d2"])
    # equal sets: the first row of each stands for all of them
    rows = same.where("doc = node").select("doc", "n", "bands").dropDuplicates(["doc"])
    rows = rows.select("doc", "n", F.explode("bands").alias("bucket"))
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("doc", "n")).alias("first"), F.count("*").alias("size"))
    firsts = firsts.where("size > 1").select("bucket", F.col("first.doc").alias("v"), F.col("first.n").alias("m"))
    members = materialize(rows.join(firsts, "bucket").where("doc <> v"), "members")
    pairs = materialize(
        members.where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))  # else too unlike in size
        .select(F.col("doc").alias("u"), "v").distinct(), "pairs",
    )
    wanted = members.select("doc").union(pairs.select("v")).distinct()
    sets = materialize(_with_sets(wanted, docs, size), "sets")
    links = materialize(_confirm(pairs, sets, percent), "links")
    grouped = components(links).withColumnRenamed("id", "doc")
    # each member has been compared with the bucket's first; what is left are pairs of the others
    labelled = members.join(grouped, "doc", "left").withColumn("c", F.coalesce("component", "doc"))
    mixed = labelled.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    left = labelled.join(mixed, "bucket", "left_semi").select("bucket", "doc", "c", "n")
    more = _tiles(left, sets, percent)
    copies = same.where("doc <> node").select(F.col("doc").alias("u"), F.col("node").alias("v"))
    # the links so far are passed on as their components: one step from each member to its smallest, so fewer rounds
    so_far = grouped.select(F.col("doc").alias("u"), F.col("component").alias("v"))
    every = components(so_far.union(more).union(copies)).withColumnRenamed("id", "doc")
    out = signed.select("id", "tag", "n", "doc").join(every, "doc", "left")
    return out.select("id", "tag", "n", F.coalesce("component", "doc").alias("head"))
