"""Columns that clash with added ones, NULLs, extreme vectors, many blocks."""

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from millstone.llm import compression, embeddings

SMALL = "/root/testdata/sf0.001"
CLASH = ["_score", "_lines_removed", "_lines_total", "_spans", "_items", "_n_words", "_row", "row", "t"]


def test_vectors_of_extreme_sizes_link(spark):
    v = [[1e200, 1e200], [2e200, 2e200], [1e-200, 1e-200], [1.0, 1.0], [1e300, -1e300], [5e-324, 0.0], [3.0, 0.0],
         [float("inf"), 1.0], [0.0, 0.0]]
    d = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")
    got = {r.vec: (r.n_links, r.component_id) for r in embeddings.near_vectors(d).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (3, 0), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (0, 8)}
    f = spark.createDataFrame([(None, [3e38, 3e38]), (1, [1e-38, 1e-38]), (2, None)], "vec_id long, embedding array<float>")
    assert sorted(r.n_links for r in embeddings.near_vectors(f).collect()) == [0, 1, 1]


def test_block_bounds_come_from_all_rows(spark, monkeypatch):
    own = spark.range(20_000).select((F.col("id") / 20_000).alias("lead"))
    b = embeddings.block_bounds(own, 10_000)                       # more blocks than FIT
    assert len(b) == 9_999 > embeddings.FIT and len(set(b)) == len(b) and b == sorted(b)
    assert embeddings.block_bounds(own, 1) == []
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 6))
    x = np.concatenate([x, x[:30] + 0.1 * rng.normal(size=(30, 6))])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    g = u @ u.T >= 0.95
    np.fill_diagonal(g, False)
    monkeypatch.setattr(embeddings, "FIT", 8)                      # more blocks than fitted vectors
    d = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec: r.n_links for r in embeddings.near_vectors(d, block_rows=4).collect()}
    assert got == {i: int(g[i].sum()) for i in range(len(x))}


def test_pipeline_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long"))
    docs = docs.unionByName(odd)
    for c in CLASH:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        rows = out.select("doc_id", "text", "n_chars", *CLASH).collect()
        assert 0 < len(rows) <= docs.count() and any(r.doc_id is None and r.text is None for r in rows), name
        assert all(r[c] == f"{c}-{'none' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASH), name
        assert all(r.text is None or r.n_chars is None or name in ("toxicity", "near_dedup") or r.n_chars == len(r.text)
                   for r in rows), name
    assert "doc_id" in corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).columns


def test_quality_of_null_ids_repeated_rows_and_long_texts(spark):
    good, bad = (" ".join(f"{w}{k % 7}" for k in range(30)) for w in ("alpha", "zq!"))
    model = compression.fit_quality([f"{t} {k}" for k in range(20) for t in (good, bad)], np.array([1, 0] * 20), 0.5)
    d = spark.createDataFrame([(None, good), (1, bad), (1, bad), (2, None), (3, ""), (4, good * 4000)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r._score) for r in compression.score_quality(d, model).collect())
    s = dict(got)
    assert len(got) == 6 and got[0] == got[1] and s["2"] == s["3"]
    assert s["None"] > 0.5 > s["1"] and s["4"] > 0.5
