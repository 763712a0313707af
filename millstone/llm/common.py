"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and reread it, so
    that several branches can start from it and a lost executor costs no more
    than the tasks it ran."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(*cols) -> list:
    """Two independent 64-bit hashes of the columns (never NULL): the identity
    of a row even where ids are NULL or repeated."""
    return [F.xxhash64(*cols).alias("rk1"), F.xxhash64(F.lit("~"), *cols).alias("rk2")]


def union_pairs(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of i[k] and j[k]; ``root`` names every member's set by
    its smallest member, before and after."""
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root[root] != root).any():
            root[:] = root[root]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(u, v) links -> (id, component): the smallest id each id can reach.

    Every round each id points to its smallest neighbour, the pointers are
    followed twice, and the links are contracted to the pointed-to ids: at
    least half of the ids that still have links vanish per round.  All of it is
    joins and partial aggregates on written tables; only one count per round
    comes to the driver.  Ids without links are absent from the result.
    """
    edges = staged(edges.where("u is not null and v is not null and u <> v")
                   .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
                   f"{name}-edges")
    labels = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ptr = both.groupBy(F.col("u").alias("id")).agg(F.least(F.col("u"), F.min("v")).alias("p"))
        ptr = staged(ptr, f"{name}-ptr")
        for _ in range(2):
            up = ptr.select(F.col("id").alias("p"), F.col("p").alias("pp"))
            ptr = ptr.join(up, "p").select("id", F.col("pp").alias("p"))
        ptr = staged(ptr, f"{name}-ptr")
        if labels is None:
            labels = ptr.select("id", F.col("p").alias("component"))
        else:
            step = ptr.select(F.col("id").alias("component"), "p")
            labels = (labels.join(step, "component", "left")
                      .select("id", F.coalesce("p", "component").alias("component")))
        labels = staged(labels, f"{name}-labels")
        pu, pv = (ptr.select(F.col("id").alias(c), F.col("p").alias(f"p{c}")) for c in ("u", "v"))
        edges = staged(edges.join(pu, "u").join(pv, "v").where("pu <> pv")
                       .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(),
                       f"{name}-edges")
        if edges.isEmpty():
            return labels
