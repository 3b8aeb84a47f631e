"""Near-duplicate vectors: int8 tile products with error bounds, full precision only where the bounds leave it open.

A unit vector x is kept as integers q times a scale, with the length of what that loses. For two vectors the product of
the integers differs from the cosine by at most ``e_x + (1 + e_x) * e_y``, so pairs below the threshold by more than
that are settled by the integers alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_or_null, row_id
from corpusloom.llm.components import components
from corpusloom.session import materialize

#: Vectors in a block; two blocks meet in a task. Cells that vectors are sorted into, to leave out blocks too far apart.
BLOCK, CELLS = 4096, 64
#: Beyond the rigorous bound: what float32 products and scales may lose, far above their true rounding.
SLACK = 1e-5
#: Integer products stay exact in float32 up to this many components; longer vectors are multiplied in float64.
EXACT_FLOAT32 = 2**24 // 127**2


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales and, per vector, the length of the quantisation error."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - q * scale[:, None], axis=1)
    return q, scale, error


def scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near 1: cosines stay, bit for bit, and no norm
    of a very short or very long vector underflows or overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in ``a``, in ``b``) of the pairs with a cosine of ``threshold`` at least; ``within``: of one block."""
    a, b = scaled(a), scaled(b)
    unit_a, unit_b = (x / np.linalg.norm(x, axis=1)[:, None] for x in (a, b))
    (qa, sa, ea), (qb, sb, eb) = quantised(unit_a), quantised(unit_b)
    wide = np.float32 if a.shape[1] <= EXACT_FLOAT32 else np.float64
    fb, sb32 = qb.astype(wide).T, sb.astype(wide)
    worst = eb.max()
    for i in range(0, len(a), 256):
        rows = slice(i, i + 256)
        rough = qa[rows].astype(wide) @ fb
        rough *= sb32
        rough *= sa[rows].astype(wide)[:, None]
        e = ea[rows]
        open_ = rough >= (threshold - SLACK - e - (1 + e) * worst).astype(wide)[:, None]
        u, v = np.nonzero(open_)
        keep = rough[u, v] >= threshold - SLACK - e[u] - (1 + e[u]) * eb[v]
        if within:
            keep &= v > u + i
        u, v = u[keep], v[keep]
        for j in range(0, len(u), 100_000):
            x, y = u[j : j + 100_000], v[j : j + 100_000]
            cosine = np.einsum("ij,ij->i", a[x + i], b[y]) / (
                np.linalg.norm(a[x + i], axis=1) * np.linalg.norm(b[y], axis=1)
            )
            sure = cosine >= threshold
            yield x[sure] + i, y[sure]


def forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect just what ``pairs`` connect: from each node to the least ``rank`` of its component."""
    label = np.argsort(np.argsort(rank))
    by_rank = np.argsort(rank)
    changed = True
    while changed:
        before = label.copy()
        for u, v in pairs:
            least = np.minimum(label[u], label[v])
            np.minimum.at(label, u, least)
            np.minimum.at(label, v, least)
        label = label[by_rank[label]]
        changed = not (label == before).all()
    head = by_rank[label]
    away = np.nonzero(head != np.arange(n))[0]
    return away, head[away]


def _vectors(key: str, vector: str, df: DataFrame) -> DataFrame:
    """``id``, ``v`` and whether it is ``usable``: not null, empty or zero, and all components finite."""
    v = F.col("v")
    kind = "array<float>" if dict(df.dtypes)[vector] == "array<float>" else "array<double>"
    wide = df.select(row_id(key).alias("id"), F.col(vector).cast(kind).alias("v"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, fine) & F.exists(v, lambda x: x != 0.0)
    return wide.withColumn("usable", F.coalesce(usable, F.lit(False)))


def _cells(distinct: DataFrame, cells: int) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Add ``dim``, ``cell`` (the nearest of at most ``cells`` pivots, fixed in number whatever the input) and
    ``angle`` to it. Pivots are the vectors with the least hashes; they decide speed alone, not results."""
    pivots = [r[0] for r in distinct.orderBy(F.xxhash64("v"), "id").limit(cells).select("v").collect()]
    by_dim: dict[int, np.ndarray] = {}
    for dim in {len(p) for p in pivots}:
        rows = np.array([p for p in pivots if len(p) == dim], float)
        rows = scaled(rows)
        by_dim[dim] = rows / np.linalg.norm(rows, axis=1)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, angle = [], []
            for row in batch.column(3):
                x = row.values.to_numpy().astype(float)
                if len(x) in by_dim:
                    x = scaled(x[None, :])[0]
                    cosines = by_dim[len(x)] @ (x / np.linalg.norm(x))
                    cell.append(int(cosines.argmax()))
                    angle.append(float(np.arccos(min(1.0, cosines.max()))))
                else:
                    cell.append(0)
                    angle.append(float(np.pi))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int64()), pa.array(angle, pa.float64())],
                [*batch.schema.names, "cell", "angle"],
            )

    kinds = f"id long, node long, m long, v {dict(distinct.dtypes)['v']}, cell long, angle double"
    return distinct.select("id", "node", "m", "v").mapInArrow(run, kinds).withColumn("dim", F.size("v").cast("long")), by_dim


def _tiles(placed: DataFrame, by_dim: dict[int, np.ndarray], threshold: float, block: int) -> DataFrame:
    """Two blocks of vectors a row. Blocks of two cells meet unless the cells' pivots are further apart than their
    widest vectors and the threshold's angle allow."""
    stats = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("angle").alias("far")).collect()
    limit = float(np.arccos(threshold)) + 1e-9
    cells: dict[tuple[int, int], tuple[int, float]] = {(r.dim, r.cell): (-(-r.n // block), r.far) for r in stats}
    near = []
    for (dim, a), (_, far_a) in cells.items():
        for (other, b), (n_b, far_b) in cells.items():
            if dim == other:
                apart = 0.0
                if dim in by_dim and a < len(by_dim[dim]) and b < len(by_dim[dim]):
                    apart = float(np.arccos(np.clip(by_dim[dim][a] @ by_dim[dim][b], -1, 1)))
                if a == b or apart - far_a - far_b <= limit:
                    near.append((dim, a, b, n_b))
    spark = placed.sparkSession
    meets = spark.createDataFrame(near, "dim long, cell long, other long, n_other long")
    sizes = spark.createDataFrame([(d, c, n) for (d, c), (n, _) in cells.items()], "dim long, cell long, n_blocks long")
    # CELLS rows for each length of vector: the number of pivots bounds both
    blocks = materialize(
        placed.join(F.broadcast(sizes), ["dim", "cell"])
        .withColumn("block", F.expr("pmod(xxhash64(id, 7), n_blocks)"))
        .groupBy("dim", "cell", "block")
        .agg(F.collect_list(F.struct("id", "node", "m", "v")).alias("rows")),
        "blocks",
    )
    pairs = (
        blocks.select("dim", "cell", "block")
        .join(F.broadcast(meets), ["dim", "cell"])
        .select("dim", "cell", "block", "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_other") - 1)).alias("to"))
        .where("cell < other OR (cell = other AND block <= to)")
    )
    left = blocks.withColumnRenamed("rows", "a")
    right = blocks.select("dim", F.col("cell").alias("other"), F.col("block").alias("to"), F.col("rows").alias("b"))
    dealt = pairs.repartition("dim", "cell", "block", "other", "to")
    return dealt.join(left, ["dim", "cell", "block"]).join(right, ["dim", "other", "to"]).select("a", "b")


def near_vectors(
    df: DataFrame, key: str, vector: str, threshold: float = 0.95, block: int = BLOCK, cells: int = CELLS
) -> DataFrame:
    """Link vectors with a cosine (in double precision) of ``threshold`` at least.

    Per row: ``key``, ``n_links`` (other rows linked directly), ``component_id`` (smallest key reachable, itself
    included) and ``kept``. A vector that is null, empty or zero, or has null or non-finite components, links with
    nothing, nor do vectors of different lengths. Equal vectors are compared once and counted as often as they occur. A
    null key is smaller than any other and shown as null; rows with the same key are separate vectors, but one node
    of the graph.
    """
    rows = materialize(_vectors(key, vector, df), "vectors")
    usable = rows.where("usable").select("id", "v")
    distinct = usable.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("m"))
    # a number of its own for each vector, since several may have the same least id; it holds once it is written
    distinct = materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    # fewer cells than full blocks would make small blocks and more of them
    placed, by_dim = _cells(distinct, min(cells, distinct.count() // block + 1))
    tiles = _tiles(materialize(placed, "placed"), by_dim, threshold, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                sides = [x.values.flatten() for x in (a, b)]  # id, node, m, v
                ids = [s[0].to_numpy() for s in sides]
                nodes = [s[1].to_numpy() for s in sides]
                times = [s[2].to_numpy() for s in sides]
                vectors = [s[3].flatten().to_numpy().astype(float).reshape(len(i), -1) for s, i in zip(sides, ids, strict=True)]
                within = len(nodes[0]) == len(nodes[1]) and (nodes[0] == nodes[1]).all()
                links = [np.zeros(len(i), np.int64) for i in ids]
                offset = 0 if within else len(ids[0])
                pairs = []
                for u, v in close_pairs(vectors[0], vectors[1], threshold, bool(within)):
                    if len(u):
                        np.add.at(links[0], u, times[1][v])
                        np.add.at(links[1], v, times[0][u])
                        pairs.append((u, v + offset))
                id_, node = (x[0] if within else np.concatenate(x) for x in (ids, nodes))
                counts = links[0] + links[1] if within else np.concatenate(links)
                head = np.arange(len(id_))
                if pairs:
                    away, to = forest(len(id_), pairs, id_)
                    head[away] = to
                some = np.nonzero(counts)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (id_[some], node[some], counts[some], id_[head[some]])],
                    ["id", "node", "links", "head"],
                )

    found = materialize(tiles.mapInArrow(run, "id long, node long, links long, head long"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = distinct.join(counts, "node", "left").select(
        "v", F.col("id").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links")
    )
    counted = materialize(usable.join(classes, "v").select("id", "first", "n_links"), "rows")
    grouped = components(found.select(F.col("id").alias("u"), F.col("head").alias("v")).union(counted.select("id", "first")))
    others = rows.where("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"))
    return (
        counted.select("id", "n_links")
        .union(others)
        .join(grouped, "id", "left")
        .select(
            id_or_null(F.col("id")).alias(key),
            "n_links",
            id_or_null(F.coalesce("component", "id")).alias("component_id"),
            (F.coalesce("component", "id") == F.col("id")).alias("kept"),
        )
    )
