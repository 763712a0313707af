"""Operator 12: phrase collocations from stripes.

A stripe is the next-word counter of a prefix (of 0, 1 or 2 words, per
language): the empty prefix counts words, a word its successors, a pair the
words behind it.  A prefix's own total is its entry in the stripe one word
shorter, and the entries of a pair's stripe are the pair's extensions, so that
frequencies, parts of a cut and subsumption are all read off one structure.

1. Every block (a run of rows of one scan task) counts its stripe entries by
   48-bit hashes and sends the counts to the cells of a hash range.  A cell adds
   them up and answers with one bit an entry: may it reach the minimum count?
   Different phrases that share a hash are counted too high, never too low, so
   nothing is lost here.
2. The answers meet the block's texts.  The block builds its stripes from the
   entries that may be frequent, with their words, and the stripes are merged
   elementwise by (language, prefix).  A stripe is dealt in segments of its next
   words (the empty prefix in as many as there are cells), so that a word which
   holds a third of the corpus does not land in one task.  These counts are
   exact.
3. The merged entries are a small table of frequent phrases.  Each candidate
   asks it for the two parts of each cut, and each triple tells the pairs inside
   it how often it occurs.

Defined cases: NULL and empty texts hold no words; a NULL language is ``und``;
repeated rows count each time; a table without candidates gives no rows; ids
and other columns are not read; words are what lies between blanks, tabs and
piece ends, whatever their bytes and length; counts are exact below 10^14.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millstone.llm.blocks import cell_batches, kept_texts, n_cells, row_blocks, split_parts
from millstone.llm.common import staged, table
from millstone.llm.tokens import LOWER, mix, release, span_hashes

UNDETERMINED = "und"
MIN_COUNT = 10
#: longest phrase, in words
LONGEST = 3
#: a phrase goes where a longer one holds this share (per cent) of it
SUBSUMED = 50
TOP = 2000
PARTS = 16
#: segments of a stripe are the cells over this
CELLS_PER_SEGMENT = 64
BLOCK_BYTES = 6 << 20
HASH_BYTES = 1 << 20

BLANK, PIECE = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = BLANK
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = PIECE
#: keys keep 48 bits
_SHORT = np.uint64(16)
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


class Phrases:
    """Words of a block: spans of ``low``, and per phrase length k the first
    word and the key (a hash of language and words) of every occurrence."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        self.low = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]       # a line feed ends a piece
        kind = _KIND[self.low]
        inside = kind == 0
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        piece = np.cumsum(kind == PIECE, dtype=np.int32)[self.start] if len(self.start) else np.zeros(0, np.int32)
        first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        self.langs, code = np.unique(np.array(langs, object).astype(str), return_inverse=True)
        self.lang = code[np.searchsorted(first, self.start, "right") - 1].astype(np.int32)
        h = self._hashes()
        self.salt = salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in self.langs],
                                    np.uint64)
        self.at = [np.arange(len(h))]
        lead = mix(h ^ salt[self.lang])
        self.keys = [lead >> _SHORT]
        whole = np.ones(len(h), bool)
        for k in range(1, LONGEST):
            whole = whole[:-1] & (piece[k:] == piece[:len(piece) - k]) if len(whole) else whole
            at = np.flatnonzero(whole)
            prefix = np.zeros(len(h), np.uint64)
            prefix[self.at[-1]] = lead
            lead = mix(prefix[at] * _A + h[at + k] * _B + np.uint64(k))
            self.at.append(at)
            self.keys.append(lead >> _SHORT)
        self.word_hash = h

    def _hashes(self) -> np.ndarray:
        out = np.zeros(len(self.start), np.uint64)
        a = 0
        while a < len(out):
            lo = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.end, lo + HASH_BYTES, "right")))
            out[a:b] = span_hashes(self.low[lo: self.end[b - 1]], self.start[a:b] - lo, self.end[a:b] - lo)
            a = b
        return out

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of all lengths in order, and their counts."""
        return np.unique(np.concatenate(self.keys), return_counts=True)

    def words(self, i: np.ndarray) -> pa.Array:
        start, size = self.start[i], self.end[i] - self.start[i]
        off = np.concatenate([[0], np.cumsum(size)])
        raw = self.low[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
        return pa.Array.from_buffers(pa.large_string(), len(i), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(raw)])


def _cell_ends(keys: np.ndarray, cells: int) -> list[int]:
    """Cells are ranges of the upper 32 bits of a key."""
    return np.searchsorted(((keys >> np.uint64(16)) * np.uint64(cells)) >> np.uint64(32), np.arange(cells + 1)).tolist()


def _pack(a: np.ndarray) -> bytes:
    """Bytes of like rank lie together, so that the empty upper ones cost nothing."""
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _read_keys(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, np.uint64), dtype=np.uint64)


def _in_sorted(a: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(a), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, a), len(sorted_values) - 1)] == a


def stripe_entries(docs: DataFrame, lang_col: str | None = "lang", text_col: str = "text",
                   min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, k, prefix, next, f) of every stripe entry of k words with f >=
    min_count occurrences; and per language a row k = 0 whose f is its words."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)) if lang_col else F.lit(UNDETERMINED)
    src = docs.select(lang.alias("i"), F.col(text_col).alias("t"))
    cells = n_cells(docs)
    segments = max(8, cells // CELLS_PER_SEGMENT)

    def count_entries(batches):
        for name, langs, texts, _, _ in row_blocks(batches, BLOCK_BYTES):
            keys, n = Phrases(langs, texts).counted()
            ends = _cell_ends(keys, cells)
            rows = [(c, _pack(np.diff(keys[a:b], prepend=np.uint64(0))), _pack(n[a:b].astype(np.uint32)))
                    for c, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
            yield from cell_batches(name, rows, [("keys", pa.binary()), ("n", pa.binary())])
        release()

    def answer(t: pa.Table) -> pa.Table:
        asked = [_read_keys(x) for x in t["keys"].to_pylist()]
        n = np.concatenate([_unpack(x, np.uint32) for x in t["n"].to_pylist()]).astype(np.int64)
        keys = np.concatenate(asked)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        often = keys[first][np.add.reduceat(n[order], first) >= min_count]
        found = [np.packbits(_in_sorted(a, often)).tobytes() for a in asked]
        return pa.table({"block": t["block"], "cell": t["cell"], "often": pa.array(found, pa.binary())})

    def build(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = dict(zip(right["cell"].to_pylist(), right["often"].to_pylist()))
        out = []
        for langs, blob, sizes in zip(*(left[c].to_pylist() for c in ("ids", "blob", "sizes"))):
            p = Phrases(langs, split_parts(blob, sizes))
            keys, _ = p.counted()
            ends = _cell_ends(keys, cells)
            bits = [np.unpackbits(np.frombuffer(answers[c], np.uint8), count=b - a)
                    for c, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
            often = keys[np.concatenate(bits).astype(bool)] if bits else keys
            out += _stripes(p, often, cells, segments)
        release()
        return pa.concat_tables(out) if out else _STRIPES.empty_table()

    def merge(t: pa.Table) -> pa.Table:
        part = []
        for lang, lines, n in zip(*(t[c].to_pylist() for c in ("lang", "lines", "n"))):
            f = _unpack(n, np.uint32).astype(np.int64)
            line = zstandard.ZstdDecompressor().decompress(lines).decode().split("\n")
            part.append(pa.table({"lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(len(f), np.int64))),
                                  "line": pa.array(line, pa.string()), "f": f}))
        m = pa.concat_tables(part).group_by(["lang", "line"]).aggregate([("f", "sum")])
        m = m.filter(pc.or_(pc.equal(m["line"], "\t"), pc.greater_equal(m["f_sum"], min_count)))
        return pa.table({"lang": m["lang"], "line": m["line"], "f": m["f_sum"]})

    asked = src.mapInArrow(count_entries, "block string, cell int, keys binary, n binary")
    answers = asked.groupBy("cell").applyInArrow(answer, "block string, cell int, often binary")
    stripes = kept_texts(src, BLOCK_BYTES).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        build, "cell int, lang string, lines binary, n binary")
    merged = stripes.groupBy("cell").applyInArrow(merge, "lang string, line string, f long")
    prefix = F.substring_index("line", "\t", 1)
    return merged.select("lang", F.expr("""case when line = '\\t' then 0 when line like '\\t%' then 1
                                           when line like '% %\\t%' then 3 else 2 end""").alias("k"),
                         prefix.alias("prefix"), F.substring_index("line", "\t", -1).alias("next"), "f")


_STRIPES = pa.schema([("cell", pa.int32()), ("lang", pa.string()), ("lines", pa.binary()), ("n", pa.binary())])


def _stripes(p: Phrases, often: np.ndarray, cells: int, segments: int) -> list[pa.Table]:
    """The block's stripes: per cell and language the entries (a line ``prefix
    tab next`` each; no word holds either) and their counts.  Entries of a
    stripe's segment share a cell; the line of a lone tab counts all words."""
    seen, n = np.unique(p.lang, return_counts=True)
    part = [pa.table({"cell": (p.salt[seen] % np.uint64(cells)).astype(np.int32), "lang": seen.astype(np.int32),
                      "line": pa.array(["\t"] * len(seen), pa.large_string()), "f": n.astype(np.int64)})]
    for k, (at, keys) in enumerate(zip(p.at, p.keys)):
        at = at[_in_sorted(keys, often)]
        if not len(at):
            continue
        text = [p.words(at + j) for j in range(k + 1)]
        blank, tab, none = (pa.scalar(x, pa.large_string()) for x in (" ", "\t", ""))
        prefix = pc.binary_join_element_wise(*text[:-1], blank) if k else none
        # dealt by the hash of the prefix and a segment of the next word
        lead = np.zeros(len(at), np.uint64)
        for j in range(k):
            lead = mix(lead * _A + p.word_hash[at + j])
        segment = mix(p.word_hash[at + k] ^ _B) % np.uint64(segments if k else cells)
        cell = (mix(lead * _B + segment + np.uint64(k)) % np.uint64(cells)).astype(np.int32)
        t = pa.table({"cell": cell, "lang": p.lang[at], "line": pc.binary_join_element_wise(prefix, text[-1], tab)})
        t = t.group_by(["cell", "lang", "line"]).aggregate([([], "count_all")])
        part.append(pa.table({"cell": t["cell"], "lang": t["lang"], "line": t["line"], "f": t["count_all"]}))
    t = pa.concat_tables(part)
    t = t.take(pc.sort_indices(t, [("cell", "ascending"), ("lang", "ascending")])).combine_chunks()
    cell, lang, f = (t[c].to_numpy() for c in ("cell", "lang", "f"))
    line = t["line"].combine_chunks()
    first = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (lang[1:] != lang[:-1])])) if len(cell) else []
    z = zstandard.ZstdCompressor(level=3)
    rows = [(cell[a], p.langs[lang[a]], z.compress("\n".join(line[a:b].to_pylist()).encode()), _pack(f[a:b].astype(np.uint32)))
            for a, b in zip(first, [*first[1:], len(cell)])]
    return [pa.Table.from_pylist([dict(zip(_STRIPES.names, r)) for r in rows], schema=_STRIPES)]


def _score(a, left, right):
    """floor(1000000 a a / (l r)) in whole numbers of up to 37 digits."""
    d = "decimal(14,0)"
    return F.expr(f"(cast({a} as {d}) * cast({a} as {d}) * cast(1000000 as decimal(7,0))) div "
                  f"(cast({left} as {d}) * cast({right} as {d}))")


def collocations(docs: DataFrame, lang_col: str | None = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the ``top``
    phrases of 2 to 3 words by the score of their weakest cut."""
    t = staged(stripe_entries(docs, lang_col, text_col, min_count), "phrases")
    phrases = t.where("k > 0").select("lang", "k", "prefix", "next", "f", F.expr(
        "if(k = 1, next, concat(prefix, ' ', next))").alias("phrase"))
    cand = (phrases.where("k > 1").withColumnRenamed("f", "a")
            .withColumn("head", F.substring_index("prefix", " ", 1))
            .withColumn("tail", F.expr("if(k = 3, concat(substring(prefix, length(head) + 2), ' ', next), next)")))
    # the parts of each cut: the prefix and the next word, of a triple also the
    # first word and the rest
    asks = cand.select("lang", "phrase", "k", "a", F.explode(F.expr("""
        if(k = 2, array(named_struct('slot', 'l1', 'part', prefix), named_struct('slot', 'r1', 'part', next)),
                  array(named_struct('slot', 'l1', 'part', head), named_struct('slot', 'r1', 'part', tail),
                        named_struct('slot', 'l2', 'part', prefix), named_struct('slot', 'r2', 'part', next)))""")).alias("ask"))
    asks = asks.select("lang", "phrase", "k", "a", "ask.slot", F.col("ask.part").alias("part"))
    found = phrases.select("lang", F.col("phrase").alias("part"), "f")
    parts = asks.join(found, ["lang", "part"]).groupBy("lang", "phrase", "k", "a").agg(
        *[F.max(F.when(F.col("slot") == s, F.col("f"))).alias(s) for s in ("l1", "r1", "l2", "r2")])
    # a triple is the longest phrase: it covers the pair it starts with and the one it ends with
    covers = (cand.where("k = 3").select("lang", "a", F.explode(F.array("prefix", "tail")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (parts.join(covers, ["lang", "phrase"], "left")
            .where(f"k = {LONGEST} or longer is null or 100 * longer < {SUBSUMED} * a")
            .withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
            .withColumn("second", F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))))
    kept = kept.select("lang", "phrase", "a", F.expr("if(second, l2, l1)").alias("l"), F.expr("if(second, r2, r1)").alias("r"),
                       F.expr("if(second, s2, s1)").alias("score"))
    # a language's phrases are ranked in parts first: its last task gets PARTS * top rows at most
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    ranked = kept
    words = t.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest([array_to_string(ws[i : i + k - 1], ' ') FOR i IN range(1, len(ws) - k + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10),
cuts AS (SELECT lang, k, phrase, a, unnest(range(1, k)) AS cut, ws FROM c),
parts AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cut, x.f AS l, y.f AS r,
         (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1 : cut], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[cut + 1 : cuts.k], ' ')),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS pick FROM parts),
covered AS (
  SELECT lang, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS phrase, a FROM c WHERE k = 3),
cover AS (SELECT lang, phrase, max(a) AS longer FROM covered GROUP BY ALL),
kept AS (
  SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score FROM best b LEFT JOIN cover v USING (lang, phrase)
  WHERE pick = 1 AND (longer IS NULL OR 100 * longer < 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
