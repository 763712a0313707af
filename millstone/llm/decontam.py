"""Operator 2: benchmark decontamination with an FM-index per shard of texts.

The benchmark's windows (10 consecutive words; a shorter item is one window)
are the phrases.  A shard is a slice of a scan task's documents.  Its words are
mapped to the benchmark's vocabulary; a word that lies in no run of the
benchmark's word triples long enough for a phrase (pairs or words, for shorter
phrases) can be in no occurrence and cuts the shard.  Only the rest is indexed:
suffix array, Burrows-Wheeler transform in a wavelet matrix, and suffix
positions sampled every 8 words.  The phrases whose last triple stands in the
shard are searched backwards at once by wavelet ranks, their occurrences located
by walking to sampled positions, and the covered words merged to removal spans.
What a shard costs follows its own words, not the size of the benchmark.

No shuffle: a document lies in one task, and no task waits for another.  Tasks
turn the benchmark into tables of phrases, a block of ``BLOCK_BYTES`` of text
each, written to the checkpoint folder.  Every block is one pass over the
documents; the spans of the passes after the first are staged, merged by text
and joined to all rows of it, so that one block at a time is broadcast.

Defined cases: NULL or empty text has no words; an item without words has no
window; a NULL item_id is the item "null"; repeated items count once per id;
documents with equal id and text get equal rows; an empty benchmark hits
nothing and empty documents give no rows; other columns pass or are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstone.llm.common import row_key, staged, table
from millstone.llm.tokens import Words, cut_words, mix, slices

WINDOW = 10
SAMPLE = 8
BLOCK_BYTES = 8 << 20
#: words of the n-grams that a phrase is looked up by
GRAM = 3
#: items that one batch of rows names at most (a row names all of its own)
NAMED = 1 << 18


@dataclass
class Lookup:
    """Phrases of one length n: phrase i is the n symbols of the block's
    sequence from ``at[i]``, its window ``number[i]``, and ``last[i]`` the hash
    of its last n-gram, by which they are sorted.  ``grams`` are the hashes of
    all their n-grams of ``k`` words."""

    n: int
    k: int
    at: np.ndarray
    number: np.ndarray
    last: np.ndarray
    grams: np.ndarray
    maybe: np.ndarray


@dataclass
class Phrases:
    """Distinct windows of a benchmark block.  Symbols start at 1; symbol s is
    the word ``low[edge[s - 1]:edge[s]]``; ``seq`` are the items' symbols;
    ``items`` of window w are ``item[first[w]:first[w + 1]]``."""

    low: np.ndarray
    edge: np.ndarray
    hashes: np.ndarray
    symbols: np.ndarray
    maybe: np.ndarray
    seq: np.ndarray
    lookups: list[Lookup]
    first: np.ndarray
    item: np.ndarray
    names: list[str]

    def symbols_of(self, w: Words) -> np.ndarray:
        """Symbol of each word, 0 if none; words are compared byte by byte."""
        sym = np.zeros(len(w.hash), np.int64)
        if not len(self.hashes):
            return sym
        near = _in_sorted(w.hash, self.hashes, self.maybe)
        at = np.searchsorted(self.hashes, w.hash[near])
        s = self.symbols[at]
        size = w.end[near] - w.start[near]
        ok = size == self.edge[s] - self.edge[s - 1]
        near, s, size = near[ok], s[ok], size[ok]
        if len(near):
            begin = np.cumsum(size) - size
            step = np.arange(int(size.sum())) - np.repeat(begin, size)
            same = w.low[np.repeat(w.start[near], size) + step] == self.low[np.repeat(self.edge[s - 1], size) + step]
            ok = np.logical_and.reduceat(same, begin)
            sym[near[ok]] = s[ok]
        return sym

    def keep(self, sym: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(symbols of the words that can be in an occurrence, 0 elsewhere;
        for each length the phrases whose last n-gram is among them)."""
        kept, chosen = np.zeros(len(sym), bool), []
        grams = {k: _grams(sym, doc, k) for k in {p.k for p in self.lookups}}
        for p in self.lookups:
            g, at = grams[p.k]
            hit = _in_sorted(g, p.grams, p.maybe)
            g, at = g[hit], at[hit]
            if len(at):  # runs of n-grams that hold a whole phrase
                new = np.append(True, (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]]))
                run = np.cumsum(new) - 1
                ok = np.bincount(run)[run] >= p.n - p.k + 1
                g, at = g[ok], at[ok]
            for j in range(p.k):
                kept[at + j] = True
            g = np.unique(g)
            lo, hi = np.searchsorted(p.last, g, "left"), np.searchsorted(p.last, g, "right")
            chosen.append(_ranges(lo, hi - lo))
        return np.where(kept, sym, 0), chosen


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (count[i] of them), one after the other."""
    return np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count)


def _maybe(hashes: np.ndarray) -> np.ndarray:
    """Bitmap over the top bits of hashes, eight places a hash or more."""
    bits = max(10, int(8 * len(hashes)).bit_length())
    out = np.zeros(1 << bits, bool)
    out[(hashes >> np.uint64(64 - bits)).astype(np.int64)] = True
    return out


def _in_sorted(h: np.ndarray, known: np.ndarray, maybe: np.ndarray) -> np.ndarray:
    """Places of the hashes that are in ``known``."""
    if not len(known):
        return np.zeros(0, np.int64)
    near = np.flatnonzero(maybe[(h >> np.uint64(65 - len(maybe).bit_length())).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, h[near]), len(known) - 1)
    return near[known[at] == h[near]]


def _hash(rows: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of symbols."""
    h = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, j].astype(np.uint64))
    return h


def _grams(sym: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first place) of the n-grams of k known words of one document."""
    if len(sym) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(sym) - k + 1
    ok = doc[:m] == doc[k - 1:]
    for j in range(k):
        ok &= sym[j: m + j] > 0
    at = np.flatnonzero(ok)
    return _hash(np.stack([sym[at + j] for j in range(k)], 1)), at


def phrases(items: list[tuple[str, str]], window: int = WINDOW) -> Phrases:
    texts = pa.array([t for _, t in items], pa.large_string())
    vocab: dict[bytes, int] = {}
    hashes: dict[int, int] = {}
    names = sorted({n for n, _ in items})
    number = {n: i for i, n in enumerate(names)}
    seqs, sizes = [], []
    for a, b, data, off in slices(texts):
        w = cut_words(data, off)
        ids = np.zeros(len(w.hash), np.int64)
        for i in range(len(ids)):
            ids[i] = s = vocab.setdefault(w.text(i), len(vocab) + 1)
            hashes[int(w.hash[i])] = s
        seqs.append(ids)
        sizes.append(np.bincount(w.doc, minlength=b - a))
    seq = np.concatenate([*seqs, np.zeros(0, np.int64)])
    size = np.concatenate([*sizes, np.zeros(0, np.int64)])
    begin = np.cumsum(size) - size
    owner = np.array([number[n] for n, _ in items], np.int64)
    lookups, pairs, done = [], [], 0
    for n in np.unique(np.minimum(size[size > 0], window)).tolist():
        of = np.flatnonzero((size == n) if n < window else (size >= window))
        count = size[of] - n + 1
        at = _ranges(begin[of], count)
        rows = np.stack([seq[at + j] for j in range(n)], 1).astype(np.int32)
        _, one, inv = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        pairs.append(np.unique(np.stack([inv.ravel() + done, np.repeat(owner[of], count)], 1), axis=0))
        k, rows = min(n, GRAM), rows[one]
        last = _hash(rows[:, n - k:])
        order = np.argsort(last, kind="stable")
        grams = np.unique(np.concatenate([_hash(rows[:, j: j + k]) for j in range(n - k + 1)]))
        lookups.append(Lookup(n, k, at[one][order], np.arange(len(one))[order] + done, last[order], grams, _maybe(grams)))
        done += len(one)
    pair = np.concatenate([*pairs, np.zeros((0, 2), np.int64)])
    h = np.array(sorted(hashes), np.uint64)
    return Phrases(np.frombuffer(b"".join(vocab), np.uint8), np.cumsum([0, *map(len, vocab)]), h,
                   np.array([hashes[int(x)] for x in h], np.int64), _maybe(h), seq, lookups,
                   np.searchsorted(pair[:, 0], np.arange(done + 1)), pair[:, 1], names)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Prefix doubling; only suffixes that are still tied are sorted again."""
    n = len(t)
    sa = np.argsort(t, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    new = np.ones(n, bool)
    new[1:] = t[sa[1:]] != t[sa[:-1]]
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank[sa] = group
    k = 1
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(tied):
        s = sa[tied]
        second = rank[np.minimum(s + k, n)]
        order = np.lexsort((second, group[tied]))
        s, second = s[order], second[order]
        sa[tied] = s
        g = group[tied]
        first = np.ones(len(tied), bool)
        first[1:] = (g[1:] != g[:-1]) | (second[1:] != second[:-1])
        g = tied[np.flatnonzero(first)][np.cumsum(first) - 1]
        group[tied] = g
        rank[s] = g
        tied = tied[~(first & np.append(first[1:], True))]
        k *= 2
    return sa


class FMIndex:
    """Index of a sequence of symbols > 0 in which 0 separates stretches (and
    ends the sequence).  Every separator is a symbol of its own to the suffix
    order and the same symbol 0 to the wavelet matrix."""

    def __init__(self, t: np.ndarray, sigma: int, sample: int = SAMPLE):
        n, zero = len(t), t == 0
        seps = int(zero.sum())
        order = t + seps
        order[zero] = np.arange(seps)
        sa = suffix_array(order)
        bwt = t[sa - 1]
        self.n = n
        self.before = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=sigma + 1))])
        self.ones, self.bits, self.zeros = [], [], []
        b = bwt
        for level in range(int(sigma).bit_length() - 1, -1, -1):
            bit = (b >> level) & 1
            self.bits.append(bit.astype(np.int8))
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(n - int(bit.sum()))
            b = np.concatenate([b[bit == 0], b[bit == 1]])
        after_sep = np.zeros(n, bool)
        after_sep[0] = True
        after_sep[1:] = zero[:-1]
        keep = (np.arange(n) % sample == 0) | after_sep
        self.sampled = np.where(keep[sa], sa, -1)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol c in the first i places of the BWT."""
        lo, hi = np.zeros_like(i), i
        top = len(self.bits) - 1
        for level, (ones, z) in enumerate(zip(self.ones, self.zeros)):
            bit = ((c >> (top - level)) & 1).astype(bool)
            lo = np.where(bit, z + ones[lo], lo - ones[lo])
            hi = np.where(bit, z + ones[hi], hi - ones[hi])
        return hi - lo

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of many phrases of one length; a phrase whose
        range is empty is not followed further."""
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), self.n, np.int64)
        todo = np.arange(len(rows))
        for j in range(rows.shape[1] - 1, -1, -1):
            c = rows[todo, j]
            for x in (lo, hi):
                x[todo] = self.before[c] + self.rank(c, x[todo])
            todo = todo[hi[todo] > lo[todo]]
        return lo, np.maximum(lo, hi)

    def _step(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix one place to the left."""
        sym, i, lo = np.zeros_like(row), row, np.zeros_like(row)
        for bits, ones, z in zip(self.bits, self.ones, self.zeros):
            b = bits[i].astype(bool)
            i = np.where(b, z + ones[i], i - ones[i])
            lo = np.where(b, z + ones[lo], lo - ones[lo])
            sym = 2 * sym + b
        return self.before[sym] + i - lo

    def locate(self, row: np.ndarray) -> np.ndarray:
        out, steps, todo = np.empty(len(row), np.int64), np.zeros(len(row), np.int64), np.arange(len(row))
        row = row.copy()
        while len(todo):
            at = self.sampled[row[todo]]
            done = at >= 0
            out[todo[done]] = at[done] + steps[todo[done]]
            todo = todo[~done]
            row[todo] = self._step(row[todo])
            steps[todo] += 1
        return out


def find(w: Words, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hit flag of each word, document and window of each distinct pair)."""
    hit = np.zeros(len(w.hash), bool)
    sym, chosen = p.keep(p.symbols_of(w), w.doc)
    at = np.flatnonzero(sym)
    none = np.zeros(0, np.int64)
    if not len(at):
        return hit, none, none
    cut = np.ones(len(at), bool)
    cut[:-1] = (at[1:] != at[:-1] + 1) | (w.doc[at[1:]] != w.doc[at[:-1]])
    place = np.arange(len(at)) + np.concatenate([[0], np.cumsum(cut)[:-1]])
    t = np.zeros(len(at) + int(cut.sum()), np.int64)
    word = np.zeros(len(t), np.int64)
    present, t[place] = np.unique(sym[at], return_inverse=True)  # the shard's own alphabet
    t[place] += 1
    word[place] = at
    index = FMIndex(t, len(present))
    windows = len(p.first) - 1
    delta, pairs = np.zeros(len(hit) + 1, np.int64), [none]
    for look, which in zip(p.lookups, chosen):
        rows = p.seq[look.at[which][:, None] + np.arange(look.n)]
        code = np.minimum(np.searchsorted(present, rows), len(present) - 1)
        ok = (present[code] == rows).all(1)
        which, code = which[ok], code[ok] + 1
        lo, hi = index.search(code)
        first = word[index.locate(_ranges(lo, hi - lo))]
        delta += np.bincount(first, minlength=len(delta)) - np.bincount(first + look.n, minlength=len(delta))
        pairs.append(np.unique(w.doc[first] * windows + np.repeat(look.number[which], hi - lo)))
    pair = np.unique(np.concatenate(pairs))
    return np.cumsum(delta[:-1]) > 0, pair // windows, pair % windows


def _items(p: Phrases, doc: np.ndarray, win: np.ndarray, docs: int):
    """(first text, end text, their lists of item names): as many texts at a
    time as name ``NAMED`` items, before repeats are dropped."""
    per = p.first[win + 1] - p.first[win]
    edge = np.searchsorted(doc, np.arange(docs + 1))
    total = np.append(0, np.cumsum(per))[edge]
    names, a = pa.array(p.names, pa.string()), 0
    while a < docs:
        b = max(a + 1, int(np.searchsorted(total, total[a] + NAMED, "right")) - 1)
        own = slice(edge[a], edge[b])
        pair = np.unique(np.repeat(doc[own] - a, per[own]) * len(p.names) + p.item[_ranges(p.first[win[own]], per[own])])
        off = np.searchsorted(pair, np.arange(b - a + 1) * len(p.names)).astype(np.int32)
        yield a, b, pa.ListArray.from_arrays(pa.array(off), names.take(pa.array(pair % max(len(p.names), 1))))
        a = b


def _spans(w: Words, hit: np.ndarray, docs: int) -> list[list[int]]:
    """Per text: flat [first word, end word, first byte, end byte] per run of
    hit words."""
    out: list[list[int]] = [[] for _ in range(docs)]
    at = np.flatnonzero(hit)
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (w.doc[at[1:]] != w.doc[at[:-1]])
        first = at[new]
        last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
        base = np.searchsorted(w.doc, w.doc[first])
        for d, a, b, x, y in zip(w.doc[first], first - base, last - base + 1,
                                 w.start[first] - w.offsets[w.doc[first]], w.end[last] - w.offsets[w.doc[first]]):
            out[d] += [int(a), int(b), int(x), int(y)]
    return out


def _benchmark_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """(block, data): pickled phrases, one row a block, written by tasks."""
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"),
                         F.col("text").alias("t")).where("t is not null").distinct()
    total = b.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // block_bytes)

    def build(items: pa.Table) -> pa.Table:
        p = phrases(list(zip(items["i"].to_pylist(), items["t"].to_pylist())), window)
        return pa.table({"block": items["block"][:1], "data": pa.array([pickle.dumps(p, 5)], pa.binary())})

    dealt = b.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(max(blocks, 1))).cast("int"))
    return staged(dealt.groupBy("block").applyInArrow(build, "block int, data binary"), "phrases")


def _search(src: DataFrame, data: bytes, schema: T.StructType) -> tuple[DataFrame, Broadcast]:
    """One pass over the documents: what a block's phrases hit."""
    shared = src.sparkSession.sparkContext.broadcast(data)

    def search(batches):
        p = pickle.loads(shared.value)
        for batch in batches:
            rows = batch.column(0)
            for a, b, data, off in slices(batch.column(1)):
                w = cut_words(data, off)
                hit, doc, win = find(w, p)
                spans = pa.array(_spans(w, hit, b - a), pa.list_(pa.int32()))
                words = pa.array(np.bincount(w.doc, minlength=b - a), pa.int64())
                for x, z, items in _items(p, doc, win, b - a):
                    yield pa.RecordBatch.from_arrays(
                        [rows.slice(a + x, z - x), words.slice(x, z - x), spans.slice(x, z - x), items],
                        names=["row", "_n_words", "_spans", "_items"])

    return src.mapInArrow(search, schema), shared


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` plus ``_n_words`` long, ``_spans`` array<int>
    (first word, end word, first byte, end byte of each run of hit words, flat)
    and ``_items`` array<string> (sorted ids of the items with windows here)."""
    cols = docs.columns
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("text").alias("t"))
    schema = (src.select("row").schema.add("_n_words", T.LongType()).add("_spans", T.ArrayType(T.IntegerType()))
              .add("_items", T.ArrayType(T.StringType())))
    blocks = _benchmark_blocks(benchmark, window, block_bytes)
    numbers = sorted(r.block for r in blocks.select("block").collect())
    out, more = None, None
    for k in numbers or [None]:
        data = pickle.dumps(phrases([], window)) if k is None else bytes(blocks.where(F.col("block") == k).first().data)
        found, shared = _search(src, data, schema)
        if out is None:
            out = found
            continue
        # what later blocks hit, once per text, is written; their tables go
        key = row_key("row.text")
        hits = staged(found.where("size(_spans) > 0").select(*key, "_spans", "_items").dropDuplicates(["rk1", "rk2"]), "hits")
        shared.destroy()
        more = hits if more is None else more.unionByName(hits)
    if more is not None:
        key = row_key("row.text")
        more = more.groupBy("rk1", "rk2").agg(F.flatten(F.collect_list("_spans")).alias("s"),
                                              F.flatten(F.collect_list("_items")).alias("i"))
        out = out.select("row", "_n_words", "_spans", "_items", *key).join(more, ["rk1", "rk2"], "left")
        out = out.select("row", "_n_words", F.concat("_spans", F.coalesce("s", F.array())).alias("s"), F.array_sort(
            F.array_distinct(F.concat("_items", F.coalesce("i", F.array())))).alias("_items")).mapInArrow(_merge_spans, schema)
    return out.select("row.*", "_n_words", "_spans", "_items")


def _merge_spans(batches):
    """Runs found in several passes over the benchmark, merged row by row."""
    for b in batches:
        merged = []
        for flat in b.column("s").to_pylist():
            runs: list[list[int]] = []
            for a, z, x, y in sorted(zip(*[iter(flat)] * 4)):
                if runs and a <= runs[-1][1]:
                    if z > runs[-1][1]:
                        runs[-1][1], runs[-1][3] = z, y
                else:
                    runs.append([a, z, x, y])
            merged.append([v for r in runs for v in r])
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), b.column("_n_words"), pa.array(merged, pa.list_(pa.int32())), b.column("_items")],
            names=["row", "_n_words", "_spans", "_items"])


def remove_spans(found: DataFrame) -> DataFrame:
    """The documents of ``find_contamination`` without the hit runs, each of
    which becomes one line end; the three added columns go."""
    cols = [c for c in found.columns if c not in ("_n_words", "_spans", "_items")]
    cut = F.expr("""array_join(transform(sequence(0, size(_spans) div 4), i -> decode(substring(cast(text as binary),
        (CASE WHEN i = 0 THEN 0 ELSE _spans[cast(i as int) * 4 - 1] END) + 1,
        coalesce(get(_spans, cast(i as int) * 4 + 2), octet_length(text))
          - (CASE WHEN i = 0 THEN 0 ELSE _spans[cast(i as int) * 4 - 1] END)), 'UTF-8')), '\n')""")
    text = F.when(F.size("_spans") > 0, cut).otherwise(F.col("text"))
    return found.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in cols])


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                           table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("""aggregate(sequence(0, size(_spans) div 4), 0L, (s, i) -> s + coalesce(
        get(_spans, cast(i as int) * 4 + 1) - get(_spans, cast(i as int) * 4), 0))""")
    return d.select("doc_id", F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"),
                    F.size("_items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated"))


OP2_SQL = r"""
WITH t AS (
  SELECT 'd' AS k, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
p AS (SELECT DISTINCT id AS item_id, list_slice(w, i + 1, i + least(10, len(w))) AS win FROM (
        SELECT id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM t WHERE k = 'b' AND len(w) > 0)),
n AS (SELECT DISTINCT len(win) AS n FROM p),
dw AS (SELECT id, i, n, list_slice(w, i + 1, i + n) AS win FROM (
        SELECT id, w, n, unnest(range(0, greatest(len(w) - n + 1, 0))) AS i FROM t, n WHERE k = 'd')),
o AS (SELECT dw.id, dw.i, dw.n, p.item_id FROM dw JOIN p USING (win)),
h AS (SELECT id, count(DISTINCT pos) AS n_hit FROM (SELECT id, i + unnest(range(0, n)) AS pos FROM o) GROUP BY id),
m AS (SELECT id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (
        SELECT DISTINCT id, item_id::VARCHAR AS s FROM o) GROUP BY id)
SELECT t.id AS doc_id, coalesce(len(t.w), 0)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
  coalesce(m.n_items, 0)::BIGINT AS n_items, sha256(coalesce(m.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN h USING (id) LEFT JOIN m USING (id) WHERE t.k = 'd'
"""
