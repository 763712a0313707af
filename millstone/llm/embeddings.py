"""Operator 4: near-duplicate vectors by PCA-ordered tiled comparison.

Equal vectors are collapsed first (with their counts), so a vector that holds a
third of all rows is one row.  Vectors are normalised in double precision and
turned to principal axes (fitted on at most ``FIT`` vectors, which decides the
order of the dimensions only).  They are cut into blocks by quantiles of all
leading coordinates; a tile compares two blocks, and tiles whose leading coordinates lie
too far apart for the threshold are not made.  Inside a tile the products of
the leading dimensions are accumulated first, the rest is bounded by the
product of the suffix norms, and pairs stop as soon as that bound falls below
the threshold.  What is left is decided by the full cosine in double precision.

Links are not sent out: a tile returns per vector the number of its links and
one link to the smallest vector of its group inside the tile, from which the
connected components follow.

Defined cases: NULL, empty and zero vectors and such with NULL or non-finite
components link with nothing; vectors of different lengths do not link; rows
with equal vectors link with each other; vectors of doubles are scaled by their
largest component, so that none is too long or too short to compare; equal
vectors go by their smallest id that is not NULL; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstone.llm.common import connected_components, staged, table, union_pairs

THRESHOLD = 0.95
BLOCK_ROWS = 2048
FIT = 4096
STRIP = 256
#: float32 products of unit vectors are off by less than this
SLOP = 1e-4


def principal_axes(x: np.ndarray) -> np.ndarray:
    """Orthonormal axes (columns) by falling second moment."""
    _, axes = np.linalg.eigh(x.T @ x)
    return axes[:, ::-1]


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _steps(dim: int) -> list[int]:
    """Ends of the runs of dimensions that are accumulated one after another."""
    ends = sorted({min(dim, e) for e in (max(8, dim // 4), max(16, dim // 2), dim)})
    return ends


def tile_links(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, threshold: float, same: bool):
    """Yields (i, j) of the links of strips of rows of ``a``; ``ra`` and ``rb``
    are the rotated vectors.  With ``same`` only i < j."""
    ends = _steps(ra.shape[1])
    fa, fb = ra.astype(np.float32), rb.astype(np.float32)
    tails = [[np.sqrt(np.maximum((r[:, e:] ** 2).sum(axis=1), 0)).astype(np.float32) for r in (ra, rb)] for e in ends]
    low = np.float32(threshold - SLOP)
    for s in range(0, len(a), STRIP):
        t = slice(s, min(s + STRIP, len(a)))
        part = fa[t, : ends[0]] @ fb[:, : ends[0]].T
        alive = part + np.outer(tails[0][0][t], tails[0][1]) >= low
        if same:
            alive &= np.arange(len(b))[None, :] > np.arange(t.start, t.stop)[:, None]
        i, j = np.nonzero(alive)
        if len(i) > alive.size // 16:  # mostly alive: one product settles the strip
            i, j = np.nonzero(alive & (a[t] @ b.T >= threshold))
            yield i + s, j
            continue
        i += s
        dot = part[i - s, j]
        for k in range(1, len(ends)):
            run = slice(ends[k - 1], ends[k])
            dot = dot + np.einsum("ij,ij->i", fa[i, run], fb[j, run])
            go = dot + tails[k][0][i] * tails[k][1][j] >= low
            i, j, dot = i[go], j[go], dot[go]
        go = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
        yield i[go], j[go]


def _tile(axes: np.ndarray, threshold: float):
    dim = len(axes)

    def run(t: pa.Table) -> pa.Table:
        side = t.column("side").to_numpy()
        x = _matrix(t.column("v"), dim)
        n = t.column("n").to_numpy()
        order = np.argsort(side, kind="stable")
        k = int((side == 0).sum())
        same = bool(t.column("bi")[0].as_py() == t.column("bj")[0].as_py())
        rows, cols = order[:k], (order[:k] if same else order[k:])
        r = x @ axes
        links = np.zeros(len(x), np.int64)
        root = np.arange(len(x))
        for i, j in tile_links(x[rows], x[cols], r[rows], r[cols], threshold, same):
            i, j = rows[i], cols[j]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            union_pairs(root, i, j)
        hit = np.flatnonzero(links)
        ids = t.column("id").combine_chunks()
        return pa.table({"id": ids.take(pa.array(hit)), "links": pa.array(links[hit]),
                         "root": ids.take(pa.array(root[hit]))})
    return run


def _links_of_dim(nodes: DataFrame, dim: int, threshold: float, block_rows: int) -> DataFrame:
    """(id, links, root) rows of the tiles of the vectors of one length."""
    own = nodes.where(F.size("v") == dim)
    sample = own.orderBy(F.xxhash64("v"), "id").limit(FIT).select("v").collect()
    x = np.array([r.v for r in sample], np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    axes = principal_axes(x)
    blocks = max(1, -(-own.count() // block_rows))
    reach = float(np.sqrt(2 * (1 - threshold))) + 1e-6
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    first = F.aggregate(F.zip_with("v", F.lit(axes[:, 0].tolist()), lambda c, w: c.cast("double") * w),
                        F.lit(0.0), lambda s, c: s + c) / norm
    own = own.withColumn("lead", first)
    bounds = [-np.inf, *block_bounds(own, blocks), np.inf]
    inner = F.lit([float(b) for b in bounds[1:-1]]).cast("array<double>")
    own = own.withColumn("own", F.size(F.filter(inner, lambda b: b <= F.col("lead"))))
    edges = F.lit([float(b) for b in bounds]).cast("array<double>")
    near = F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda k: (
        (F.get(edges, k + 1) >= F.col("lead") - reach) & (F.get(edges, k) <= F.col("lead") + reach)))
    spread = own.select("id", "n", "v", "own", F.explode(near).alias("other"))
    tiles = spread.select(
        F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "n", "v")
    kind = own.schema["id"].dataType.simpleString()
    return tiles.groupBy("bi", "bj").applyInArrow(_tile(axes, threshold), f"id {kind}, links long, root {kind}")


def block_bounds(own: DataFrame, blocks: int) -> list[float]:
    """Quantiles of all leads: however many blocks there are, each holds about
    as many of the rows (one number per block comes to the driver)."""
    if blocks < 2:
        return []
    cuts = [k / blocks for k in range(1, blocks)]
    return own.agg(F.percentile_approx("lead", cuts, max(10_000, 4 * blocks)).alias("b")).first().b


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row of ``vectors``: (id, n_links, component_id)."""
    v = F.col(vec_col)
    fine = (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) \
        & F.exists(v, lambda c: c != 0)
    if isinstance(vectors.schema[vec_col].dataType.elementType, T.DoubleType):
        # squares of doubles may leave the range of doubles; those of floats don't
        v = F.when(fine, F.transform(v, lambda c: c / F.array_max(F.transform(v, F.abs))))
    rows = vectors.select(F.col(id_col).alias("vec"), F.when(fine, v).alias("v"))
    copies = rows.where("v is not null").groupBy("v").agg(F.min("vec").alias("vec"), F.count("*").alias("n"))
    nodes = staged(copies.select(F.struct("vec", F.xxhash64("v").alias("h")).alias("id"), "n", "v"), "vectors")
    found = None
    for r in nodes.select(F.size("v").alias("d")).distinct().collect():
        part = _links_of_dim(nodes, r.d, threshold, block_rows)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"))
    found = staged(found, "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comps = connected_components(found.select(F.col("id").alias("u"), F.col("root").alias("v")), "vectors")
    answer = (nodes.join(links, "id", "left").join(comps, "id", "left")
              .select("v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "id")["vec"].alias("component_id")))
    lone = rows.where("v is null").select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"))
    return (rows.where("v is not null").join(answer, "v").select("vec", "n_links", "component_id")).union(lone)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = near_vectors(table(spark, sf_dir, "embeddings"))
    return d.select(F.col("vec").alias("vec_id"), "n_links", "component_id",
                    F.col("vec").eqNullSafe(F.col("component_id")).alias("kept"))
