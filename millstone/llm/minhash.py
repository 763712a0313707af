"""Operator 6: near-duplicate texts by ProbMinHash, banding and verification.

Weighted shingles (five consecutive words; weight 1 + ln(count)) draw arrival
times from Poisson processes whose rates are their weights; each arrival falls
into one of m registers, which keeps the earliest.  A shingle stops when its
next arrival comes after the latest register of its document.  Two documents
agree in a register with the probability Jaccard similarity of their shingles,
which for equal weights is the Jaccard similarity of the sets.

The link rule is the Jaccard similarity of the sets, which weights can hide: a
text that repeats passages another holds once is near it as a set only.  So a
text has registers of weight 1 as well; those alone bound a pair's similarity.

Banding: b bands of r registers of weight 1, and the bands of the weighted
registers where they differ; equal band keys make a bucket.  Each member of
a bucket is compared with the bucket's smallest member.  Members that these
links leave in different components are compared by their registers in tiles
of at most ``TILE`` a side; texts that look alike there (a spanning forest per
tile, never the pairs) make clusters, whose members meet with their shingles in
tiles again, where every pair between components is verified and one link for
each join of components comes out.  So a huge bucket neither lands in one task
nor emits its pairs.  A pair is dropped when its registers of weight 1 agree in too few
places for the threshold (``SLACK`` standard deviations below), the rest is
verified exactly: the Jaccard similarity of the sets of 64-bit shingle hashes
must reach the threshold.  Classes are the connected components of the links.

Defined cases: a NULL text is a class of its own; texts without words (the
empty one too) are near only to equal texts; a text of one to four words is one
shingle; rows with equal texts share a class, with or without words and
whatever their ids; the class id is the smallest doc_id of the class
(NULL ids first); an empty table gives no rows; other columns pass or are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstone.llm.common import connected_components, staged, table, union_pairs
from millstone.llm.tokens import Words, cut_words, mix, slices

SHINGLE = 5
BANDS, ROWS = 24, 5
THRESHOLD = (4, 5)
SLACK = 5.5
TILE = 512

_MULT = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def shingles(w: Words, n_docs: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit hash) of every shingle, in order of the documents."""
    n = len(w.hash)
    count = np.bincount(w.doc, minlength=n_docs)
    length = np.minimum(count, size)[w.doc]
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(n)
    start = at + length <= first[w.doc + 1]
    start &= (length == size) | (at == first[w.doc])
    s, length = at[start], length[start]
    h = length.astype(np.uint64)
    pad = np.concatenate([w.hash, np.zeros(size, np.uint64)])
    for k in range(size):
        part = pad[s + k] * np.uint64(_MULT[k % len(_MULT)] + 2 * (k // len(_MULT)))
        h = h + np.where(k < length, part, np.uint64(0))
    return w.doc[s], mix(h)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(doc: np.ndarray, h: np.ndarray, n_docs: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n_docs x m winning shingles of weight 1, the same of weighted shingles,
    distinct shingles of each document); 0 where a document has none.  Shingles
    count by 40 bits of their hash here, as many in any slice, so sizes may be
    off by one in long documents."""
    if not len(doc):
        none = np.zeros((n_docs, m), np.uint64)
        return none, none, np.zeros(n_docs, np.int64)
    key = (doc.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    weight = 1.0 + np.log(np.diff(np.append(at, len(key))))
    key = key[at]
    d = (key >> np.uint64(40)).astype(np.int64)
    size = np.bincount(d, minlength=n_docs)
    e = key & np.uint64((1 << 40) - 1)
    plain = _winners(d, e, np.ones(len(e)), n_docs, m)
    again = np.bincount(d, weight, n_docs) > size  # equal weights of 1 have the same winners
    weighted, some = plain.copy(), again[d]
    if some.any():
        number = np.cumsum(again) - 1
        weighted[again] = _winners(number[d[some]], e[some], weight[some], int(again.sum()), m)
    return plain, weighted, size


def _winners(d: np.ndarray, e: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """The earliest shingle of each register: document d, shingle e, weight."""
    sig = np.zeros(n_docs * m, np.uint64)
    q = np.full(n_docs * m, np.inf)
    t = np.zeros(len(e))
    ids = e + np.uint64(1)
    state = ids
    r = 0
    while len(d):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        t = t - np.log(_uniform(state)) / weight
        reg = d * m + (mix(state ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(q, reg, t)
        won = t == q[reg]
        sig[reg[won]] = ids[won]
        if r < 4 or r % 8 == 0:
            latest = q.reshape(n_docs, m).max(axis=1)
        go = t < latest[d]
        d, t, state, ids, weight = d[go], t[go], state[go], ids[go], weight[go]
        r += 1
    return sig.reshape(n_docs, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """n_docs x bands bucket keys; the band is part of the key."""
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, np.uint64)
        for k in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * rows + k])
        out[:, b] = h
    return out


def _sign(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for a, b, data, off in slices(batch.column(3)):
                w = cut_words(data, off)
                n = b - a
                doc, h = shingles(w, n)
                sig, weighted, size = signatures(doc, h, n, bands * rows)
                keep = batch.column(3).slice(a, n).is_valid()  # texts without words: no keys, no registers
                sig, weighted, size = sig[size > 0], weighted[size > 0], size[np.asarray(keep)]
                keys, more = band_keys(sig, bands, rows), band_keys(weighted, bands, rows)
                own = np.concatenate([np.ones(keys.shape, bool), keys != more], axis=1)
                keys = np.concatenate([keys, more], axis=1)[own].view(np.int64)
                keys_of = np.zeros(len(size), np.int64)
                keys_of[size > 0] = own.sum(axis=1)
                keys_of = np.concatenate([[0], np.cumsum(keys_of)]).astype(np.int32)
                reg = (mix(sig) & np.uint64(0xFF)).astype(np.uint8).view(np.int8).ravel()
                rows_of = np.concatenate([[0], np.cumsum(size > 0)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, n).filter(keep) for c in range(3)]
                    + [pa.array(size, pa.int32()),
                       pa.ListArray.from_arrays(pa.array(keys_of), pa.array(keys)),
                       pa.ListArray.from_arrays(pa.array(rows_of * (bands * rows)), pa.array(reg))],
                    names=["doc", "h1", "h2", "size", "keys", "reg"])
    return run


def _shingle_sets(batches):
    for batch in batches:
        for a, b, data, off in slices(batch.column(1)):
            doc, h = shingles(cut_words(data, off), b - a)
            order = np.lexsort((h, doc))
            d, x = doc[order], h[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
            d, x = d[new], x[new]
            ends = np.searchsorted(d, np.arange(b - a + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(x.view(np.int64)))], names=["id", "set"])


def _similar(pairs: DataFrame, nodes: DataFrame, bands: int, rows: int, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (u, v) whose sizes and registers allow the threshold."""
    a = nodes.select(F.col("id").alias("u"), F.col("size").alias("su"), F.col("reg").alias("ru"))
    b = nodes.select(F.col("id").alias("v"), F.col("size").alias("sv"), F.col("reg").alias("rv"))
    both = pairs.join(a, "u").join(b, "v").where(
        (F.least("su", "sv") + 2) * threshold[1] >= F.greatest("su", "sv") * threshold[0])
    same = F.size(F.filter(F.zip_with("ru", "rv", lambda x, y: x == y), lambda x: x))
    return both.where(same >= _least(bands, rows, threshold)).select("u", "v")


def _shingle_table(ids: DataFrame, src: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, set): sorted distinct 64-bit shingle hashes of some texts."""
    want = nodes.join(ids, "id").select("id", F.col("id.doc").alias("doc"), "h1", "h2")
    texts = src.join(want, [src.h1 == want.h1, src.h2 == want.h2, src.doc.eqNullSafe(want.doc)]).select("id", "t")
    return staged(texts.dropDuplicates(["id"]).mapInArrow(
        _shingle_sets, texts.select("id").schema.add("set", T.ArrayType(T.LongType()))), "minhash-sets")


def _verified(pairs: DataFrame, src: DataFrame, nodes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs whose shingle sets reach the threshold."""
    sets = _shingle_table(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), src, nodes)
    a = sets.select(F.col("id").alias("u"), F.col("set").alias("su"))
    b = sets.select(F.col("id").alias("v"), F.col("set").alias("sv"))
    j = pairs.join(a, "u").join(b, "v").withColumn("both", F.size(F.array_intersect("su", "sv")))
    j = j.where((F.col("both") * threshold[1]) >= (F.size("su") + F.size("sv") - F.col("both")) * threshold[0])
    return j.select("u", "v")


def _least(bands: int, rows: int, threshold: tuple[int, int]) -> int:
    """Equal registers of weight 1 that a pair at the threshold has almost surely."""
    m, p = bands * rows, threshold[0] / threshold[1]
    return math.ceil(m * p - SLACK * math.sqrt(m * p * (1 - p)))


def _tiled(members: DataFrame, group: str, size: str) -> DataFrame:
    """Members of a group dealt to the tiles (ti, tj) of a grid of at most
    ``TILE`` members a side: once to a row of tiles (side 0), once to a column
    (side 1).  Any two members meet in a tile; ``rank`` orders them."""
    m = members.withColumn("rank", F.xxhash64("id")).withColumn("n", F.ceil(F.col(size) / TILE).cast("int"))
    m = m.withColumn("own", F.pmod(F.col("rank"), F.col("n")).cast("int"))
    grid = F.expr("""concat(transform(sequence(0, n - 1), x -> struct(own AS ti, cast(x AS int) AS tj, 0 AS side)),
                            transform(sequence(0, n - 1), x -> struct(cast(x AS int) AS ti, own AS tj, 1 AS side)))""")
    keep = [c for c in members.columns if c not in (group, size)]
    return m.withColumn("g", F.explode(grid)).select(group, "g.ti", "g.tj", "g.side", "rank", *keep)


def _registers(t: pa.Table) -> np.ndarray:
    return t.column("reg").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)


def _alike(least: int):
    """A tile's pairs of different components with enough equal registers, as
    a spanning forest: no more links than members."""
    def run(t: pa.Table) -> pa.Table:
        side, comp, rank = (t.column(c).to_numpy() for c in ("side", "comp", "rank"))
        reg = _registers(t)
        _, first, node = np.unique(rank, return_index=True, return_inverse=True)
        root = np.arange(len(first))
        cols = np.flatnonzero(side == 1)
        for a in np.flatnonzero(side == 0):
            ok = cols[(comp[cols] != comp[a]) & (rank[cols] > rank[a])]
            ok = ok[(reg[ok] == reg[a]).sum(axis=1) >= least]
            if len(ok):
                union_pairs(root, np.full(len(ok), node[a]), node[ok])
        at = np.flatnonzero(root != np.arange(len(root)))
        ids = t.column("id").combine_chunks()
        return pa.table({"u": ids.take(pa.array(first[root[at]])), "v": ids.take(pa.array(first[at]))})
    return run


def _proven(least: int, threshold: tuple[int, int]):
    """A tile's verified links between components, one for each that they join."""
    def run(t: pa.Table) -> pa.Table:
        side, rank = (t.column(c).to_numpy() for c in ("side", "rank"))
        reg = _registers(t)
        _, comp = np.unique(t.column("comp").to_numpy(), return_inverse=True)
        root = np.arange(comp.max() + 1)
        sets = t.column("set").combine_chunks()
        flat, edge = sets.values.to_numpy(), sets.offsets.to_numpy().astype(np.int64)
        size = np.diff(edge)
        cols, us, vs = np.flatnonzero(side == 1), [], []
        for a in np.flatnonzero(side == 0):
            ok = cols[(root[comp[cols]] != root[comp[a]]) & (rank[cols] > rank[a])]
            ok = ok[(np.minimum(size[ok], size[a]) * threshold[1] >= np.maximum(size[ok], size[a]) * threshold[0])]
            ok = ok[(reg[ok] == reg[a]).sum(axis=1) >= least]
            if not len(ok):
                continue
            own = flat[edge[a]: edge[a + 1]]
            n = size[ok]
            idx = np.arange(int(n.sum())) + np.repeat(edge[ok] - (np.cumsum(n) - n), n)
            at = np.minimum(np.searchsorted(own, flat[idx]), len(own) - 1)
            both = np.add.reduceat((own[at] == flat[idx]).astype(np.int64), np.cumsum(n) - n)
            ok = ok[both * threshold[1] >= (n + size[a] - both) * threshold[0]]
            _, one = np.unique(root[comp[ok]], return_index=True)
            us += [a] * len(one)
            vs += ok[one].tolist()
            union_pairs(root, np.full(len(one), comp[a]), comp[ok[one]])
        ids = t.column("id").combine_chunks()
        return pa.table({"u": ids.take(pa.array(us, pa.int64())), "v": ids.take(pa.array(vs, pa.int64()))})
    return run


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS,
                           rows: int = ROWS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: (doc, h1, h2, class_doc, class_hash): id and
    two text hashes of the row; id and first hash of its class's smallest row."""
    src = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.lit(1), text_col).alias("h1"),
                      F.xxhash64(F.lit(2), text_col).alias("h2"), F.col(text_col).alias("t"))
    doc_type = src.schema["doc"].dataType.simpleString()
    signed = staged(src.mapInArrow(_sign(bands, rows), f"doc {doc_type}, h1 long, h2 long, size int, "
                                                       "keys array<bigint>, reg array<tinyint>"), "minhash-signed")
    nodes = staged(_first_rows(signed), "minhash-nodes")

    members = nodes.select("id", F.explode("keys").alias("key"))
    heads = (members.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("n"))
             .where("n > 1"))
    member_heads = staged(members.join(heads, "key").select("key", "id", "head", "n"), "minhash-members")
    star = member_heads.where("id <> head").select(F.col("head").alias("u"), F.col("id").alias("v")).distinct()
    star = staged(_similar(star, nodes, bands, rows, threshold), "minhash-star")
    links = staged(_verified(star, src, nodes, threshold), "minhash-links")
    comps = connected_components(links, "minhash-first")

    # members of a bucket in different components, beyond pairs with its head
    placed = (member_heads.where("n > 2 and id <> head").join(comps, "id", "left")
              .withColumn("component", F.coalesce("component", "id")))
    open_keys = (placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                           F.count("*").alias("k")).where("lo <> hi").select("key", "k"))
    rest = staged(placed.join(open_keys, "key").select("key", "k", "id", "component"), "minhash-open")
    if not rest.isEmpty():
        least = _least(bands, rows, threshold)
        own = rest.join(nodes.select("id", "reg"), "id").select(
            "key", "k", "id", F.xxhash64("component").alias("comp"), "reg")
        pair = own.select(F.col("id").alias("u"), F.col("id").alias("v")).schema
        alike = staged(_tiled(own, "key", "k").groupBy("key", "ti", "tj").applyInArrow(_alike(least), pair)
                       .distinct(), "minhash-alike")
        if not alike.isEmpty():
            clusters = connected_components(alike, "minhash-clusters")
            sizes = clusters.groupBy("component").agg(F.count("*").alias("k"))
            own = (clusters.join(sizes, "component").withColumnRenamed("component", "cluster")
                   .join(nodes.select("id", "reg"), "id").join(comps, "id", "left")
                   .join(_shingle_table(clusters.select("id"), src, nodes), "id")
                   .select(F.xxhash64("cluster").alias("cluster"), "k", "id",
                           F.xxhash64(F.coalesce("component", "id")).alias("comp"), "reg", "set"))
            more = staged(_tiled(own, "cluster", "k").groupBy("cluster", "ti", "tj")
                          .applyInArrow(_proven(least, threshold), pair), "minhash-more")
            if not more.isEmpty():
                comps = connected_components(links.union(more), "minhash-all")

    classes = nodes.select("h1", "h2", "id").join(comps, "id", "left").select(
        "h1", "h2", F.coalesce("component", "id").alias("class"))
    out = src.drop("t").join(classes, ["h1", "h2"], "left")
    return out.select("doc", "h1", "h2",
                      F.when(F.col("class").isNull(), F.col("doc")).otherwise(F.col("class.doc")).alias("class_doc"),
                      F.coalesce("class.h", "h1").alias("class_hash"), F.col("class").isNotNull().alias("compared"))


def _first_rows(signed: DataFrame) -> DataFrame:
    """One row per distinct text, with the smallest of its ids."""
    return signed.groupBy("h1", "h2").agg(
        F.min("doc").alias("doc"), F.max("size").alias("size"), F.first("keys").alias("keys"),
        F.first("reg").alias("reg")).select(
        F.struct("doc", F.col("h1").alias("h")).alias("id"), "h1", "h2", "size", "keys", "reg")


def keep_one_per_class(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per class: of the texts that hold the class's
    smallest doc_id the one named by the class, and one of its repeated rows.
    Rows with a NULL text all stay."""
    cols = docs.columns
    c = near_duplicate_classes(docs)
    stay = (c.where("not compared or (doc <=> class_doc and h1 = class_hash)")
            .select(F.col("doc").alias("d"), F.col("h1").alias("a"), F.col("h2").alias("b"), "compared").distinct())
    d = docs.select(F.struct(*[F.col(f"`{x}`") for x in cols]).alias("row"), F.col("doc_id").alias("doc"),
                    F.xxhash64(F.lit(1), "text").alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"))
    d = d.join(stay, (d.h1 == stay.a) & (d.h2 == stay.b) & d.doc.eqNullSafe(stay.d))
    d = d.withColumn("own", F.when(F.col("compared"), F.lit(-1).cast("long")).otherwise(F.monotonically_increasing_id()))
    return d.dropDuplicates(["h1", "h2", "doc", "own"]).select("row.*")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = near_duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return c.select(F.col("doc").alias("doc_id"), F.col("class_doc").alias("class_id"),
                    F.col("doc").eqNullSafe(F.col("class_doc")).alias("kept"))
