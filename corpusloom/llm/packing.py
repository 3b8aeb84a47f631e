"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Groups of equal texts are placed where the dot product of their size with the shard's residual capacity is highest. So
that the placing itself stays small at any scale, groups below a small share of the corpus are bundled by hash first,
and groups above a larger share are cut into pieces: the number of things to place is bounded by these shares.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import id_or_null, row_id
from corpusloom.session import materialize

#: A group with 1/BUNDLES of the bytes, tokens or rows is placed alone, smaller ones in one of BUNDLES bundles.
BUNDLES = 2048
#: A group of several rows that exceeds this share of a shard's capacity is cut into pieces of a sixteenth of that.
CUT = 1.0
_SIZES = ("rows", "size", "tokens")


def place(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (a row of sizes, each column a share of the whole): largest items first, to the shard
    whose residual capacity has the highest dot product with the item (of equals, the first)."""
    residual = np.full((shards, sizes.shape[1]), 1.0 / shards)
    out = np.zeros(len(sizes), int)
    for i in np.argsort(-sizes.max(axis=1), kind="stable"):
        out[i] = int((residual @ sizes[i]).argmax())
        residual[out[i]] -= sizes[i]
    return out


def shard(docs: DataFrame, key: str, text: str, shards: int = 16, bundles: int = BUNDLES) -> DataFrame:
    """Per row: ``key``, ``size`` (UTF-8 bytes plus 1), ``tokens`` (spaces plus 1), ``text_crc32``, ``shard`` and
    ``slot`` (gapless from 0 within its shard).

    Rows with equal texts stay together unless they are more than a shard holds. Null texts count as empty. Rows may
    share a key, and keys may be null. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        row_id(key).alias("id"),
        # written with the sizes, so it is the same whenever it is read; ids may be missing or repeated
        F.monotonically_increasing_id().alias("row"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        (F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit(""))) + 1).cast("long").alias("tokens"),
        F.crc32(body.cast("binary")).alias("crc"),
        F.xxhash64(body).alias("text_hash"),
    )
    rows = materialize(rows, "sizes")
    sums = [F.count("*").alias("rows"), F.sum("size").alias("size"), F.sum("tokens").alias("tokens")]
    groups = materialize(rows.groupBy("text_hash", "crc").agg(*sums), "groups")
    total = groups.agg(*[F.sum(c).alias(c) for c in _SIZES]).first()
    whole = {c: float(total[c] or 1) for c in _SIZES}
    share = F.greatest(*[F.col(c) / whole[c] for c in _SIZES])
    piece = CUT / shards / 16
    pieces = F.least(F.ceil(share / piece), "rows").cast("long").alias("pieces")
    cut = ((F.col("rows") > 1) & (share > CUT / shards)).alias("cut")
    alone = groups.where(share > 1.0 / bundles).select("text_hash", "crc", pieces, cut)
    # at most three times BUNDLES groups are that large, one for each kind of size
    named = rows.join(F.broadcast(alone), ["text_hash", "crc"], "left")
    own = F.col("pieces").isNotNull()
    named = named.select(
        "id", "row", "size", "tokens", "crc",
        F.when(own, F.col("text_hash")).otherwise(F.expr(f"pmod(text_hash, {bundles})")).alias("a"),
        F.when(own, F.col("crc")).otherwise(F.lit(-1)).alias("b"),
        # large groups are numbered piece by piece, also those that stay in one shard
        F.when(own, F.expr("pmod(xxhash64(row, 5), pieces)")).otherwise(F.lit(0)).alias("c"),
        F.coalesce("cut", F.lit(False)).alias("cut"),
    )
    named = materialize(named, "named")
    items = named.groupBy("a", "b", "c", "cut").agg(*sums).orderBy("a", "b", "c").collect()
    groups_of = {}  # what is placed as one: a bundle, a group, or a piece of a group that is cut
    for r in items:
        groups_of.setdefault((r.a, r.b, r.c if r.cut else None), []).append(r)
    sizes = [[sum(r[c] for r in rs) / whole[c] for c in _SIZES] for rs in groups_of.values()]
    where = place(np.array(sizes).reshape(-1, len(_SIZES)), shards)
    used, placed = [0] * shards, []
    for rs, s in zip(groups_of.values(), where.tolist(), strict=True):
        for r in rs:
            placed.append((r.a, r.b, r.c, s, used[s]))
            used[s] += r.rows
    spots = docs.sparkSession.createDataFrame(placed, "a long, b long, c long, shard int, before long")
    within = F.row_number().over(W.partitionBy("a", "b", "c").orderBy("id", "crc", "size", "row"))
    return named.join(F.broadcast(spots), ["a", "b", "c"]).select(
        id_or_null(F.col("id")).alias(key), "size", "tokens", F.col("crc").alias("text_crc32"), "shard",
        (F.col("before") + within - 1).cast("long").alias("slot"),
    )
