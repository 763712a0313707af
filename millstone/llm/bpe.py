"""Operator 5: byte-level BPE over a global shuffle of distinct words.

1. Texts are cut into pre-tokens.  Every block (a run of rows of one scan task)
   explodes its distinct words; the word at position p of the block's list goes
   to the cell of its hash: (block, cell, words).
2. The cells are shuffled, so that all occurrences of a word meet in one task:
   each distinct word is encoded once there and its ids are joined back to
   every (block, cell, position) that holds it.
3. The block's texts (kept compressed) meet the ids of its words by block, and
   the ids of a text are reassembled by position.  Decoding joins the
   token-byte table, which is as large as the vocabulary and no larger.

A hot word has at most one entry per block, a hot document lies in one block,
and a task holds one block or one cell partition, never the corpus.  Blocks are
named by their content, so a task that is run again gives the same blocks.

Words are compared by 64-bit hashes inside a block; every text is decoded again
and, should it differ, encoded directly, so a collision cannot change a result.

Defined cases: NULL and empty texts have no ids; repeated rows and NULL ids
each give their own row; an empty table gives no rows; only the id column and
the text column are read, others are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millstone.llm.blocks import cell_batches, cell_split, join_parts, kept_texts, n_cells, row_blocks, source, split_parts
from millstone.llm.common import table
from millstone.llm.tokens import mix, span_hashes

#: bytes of text in a block and characters in one array operation, about
BLOCK_BYTES = 4 << 20
SLICE_CHARS = 1 << 18

LETTER, NUMBER, SPACE, OTHER = range(4)
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]


@cache
def _char_class() -> np.ndarray:
    """Class of every code point, by the pattern's own character classes."""
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    for first in range(0, 0x110000, 1 << 14):
        text = "".join(chr(c) for c in range(first, first + (1 << 14)) if not 0xD800 <= c < 0xE000)
        for cls, pat in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
            out[[ord(c) for c in regex.findall(pat, text)]] = cls
    return out


def pre_tokens(chars: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Start of every match of the byte-BPE pattern

        's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

    over texts that lie one after another in ``chars`` (code points); ``edges``
    are the ends of the texts.  Matches cover everything, so starts say it all:
    runs of one class; of white space before something else the last character
    is a match of its own, or the prefix of the next one if it is a blank; and
    a contraction that starts a match ends behind its letters.
    """
    n = len(chars)
    if not n:
        return np.zeros(0, np.int64)
    cls = _char_class()[chars]
    first = np.zeros(n + 1, bool)
    first[0] = first[edges] = True
    start = first[:n].copy()
    start[1:] |= cls[1:] != cls[:-1]
    last = np.append(start[1:], True)
    # the last white-space character before something else in the same text
    tail = np.flatnonzero((cls == SPACE) & last & ~np.append(first[1:n], True))
    start[tail] = True
    blank = tail[chars[tail] == 32]
    start[blank + 1] = False
    # contractions: a lone apostrophe that starts a match, and letters
    quote = np.flatnonzero((chars == 39) & start & last)
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1]]
    pad = np.append(chars, [0, 0, 0])
    stop = np.flatnonzero(first)
    room = stop[np.minimum(np.searchsorted(stop, quote, "right"), len(stop) - 1)]
    room = np.where(room > quote, room, n) - quote
    size = np.zeros(len(quote), np.int64)
    for c in CONTRACTIONS:
        same = room >= len(c)
        for k, ch in enumerate(c):
            same &= pad[quote + k] == ord(ch)
        size = np.where((size == 0) & same, len(c), size)
    quote, size = quote[size > 0], size[size > 0]
    start[quote + 1] = False
    end = quote + size
    inner = end[(end < n)]
    start[inner] = True
    return np.flatnonzero(start)


@cache
def _encoding(path: str, pattern: str):
    import tiktoken

    ranks = {v: k for k, v in token_bytes(path).items()}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def token_bytes(path: str) -> dict[int, bytes]:
    """The token-byte table of a rank file."""
    with open(path, "rb") as f:
        return {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}


class Block:
    """The words of some texts: distinct ones in order of their hash, and for
    each text the numbers of its words."""

    def __init__(self, texts: list[str], spell: bool = False):
        """``spell``: keep what ``words`` needs."""
        hashes, self.count, where = [], [], []
        k = 0
        while k < len(texts):
            a, size = k, 0
            while k < len(texts) and (k == a or size + len(texts[k]) <= SLICE_CHARS):
                size += len(texts[k])
                k += 1
            whole = "".join(texts[a:k])
            chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            edges = np.cumsum([len(t) for t in texts[a:k]])
            start = pre_tokens(chars, edges)
            end = np.append(start[1:], len(chars))
            h = span_hashes(chars, start, end) if len(chars) else np.zeros(0, np.uint64)
            self.count.append(np.diff(np.searchsorted(start, np.concatenate([[0], edges]))))
            hashes.append(h)
            if spell:
                _, one = np.unique(h, return_index=True)
                where.append((h[one], whole, start[one], end[one]))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.hash, self.inv = np.unique(h, return_inverse=True)
        self.inv = self.inv.astype(np.int32)
        self.count = np.concatenate(self.count) if self.count else np.zeros(0, np.int64)
        self._where = where

    def words(self) -> list[bytes]:
        out: list = [None] * len(self.hash)
        for h, whole, start, end in self._where:
            for i, a, b in zip(np.searchsorted(self.hash, h).tolist(), start.tolist(), end.tolist()):
                if out[i] is None:
                    out[i] = whole[a:b].encode()
        return out

    def cells(self, n: int) -> list[np.ndarray]:
        """Positions of the words of each of n cells."""
        return cell_split((mix(self.hash) % np.uint64(n)).astype(np.int64), n)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           digest: bool = False) -> DataFrame:
    """(id, ids array<int>) for every row of ``docs``.  ``path`` names a rank
    file, ``pattern`` its pre-token pattern (the one ``pre_tokens`` cuts by).
    With ``digest`` the rows are those of ``decode`` instead, made where the
    ids are reassembled, so that they need not travel."""
    src = source(docs, id_col, text_col)
    cells = n_cells(docs)
    arrow_id, id_field = to_arrow_type(src.schema["i"].dataType), src.schema["i"].dataType.simpleString()
    schema = "block string, cell int, blob binary, sizes binary"
    packed = [("blob", pa.binary()), ("sizes", pa.binary())]

    def explode_words(batches):
        for name, _, texts, _, _ in row_blocks(batches, BLOCK_BYTES):
            block = Block([t.decode() for t in texts], spell=True)
            words = block.words()
            rows = [(c, *join_parts([words[i] for i in at])) for c, at in enumerate(block.cells(cells)) if len(at)]
            yield from cell_batches(name, rows, packed)

    def encode_words(batches):
        enc, known = _encoding(path, pattern)._encode_single_piece, {}
        for b in batches:
            rows = []
            for blob, sizes in zip(b.column("blob").to_pylist(), b.column("sizes").to_pylist()):
                out = []
                for w in split_parts(blob, sizes):
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = np.array(enc(w), np.uint32).tobytes()
                    out.append(ids)
                rows.append(join_parts(out))
            x, y = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("cell"), pa.array(x, pa.binary()),
                                              pa.array(y, pa.binary())], names=["block", "cell", "blob", "sizes"])

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        by_id = token_bytes(path)
        flat_ids: list = []
        found: list[np.ndarray] = []
        decoded: list[bytes] = []
        answers = list(zip(*(right.column(k).to_pylist() for k in ("cell", "blob", "sizes"))))
        for ids, blob, sizes in zip(*(left.column(c).to_pylist() for c in ("ids", "blob", "sizes"))):
            raw = split_parts(blob, sizes)
            block = Block([t.decode() for t in raw])
            of_word: list = [b""] * len(block.hash)
            at_cell = block.cells(cells)
            for c, x, y in answers:
                for i, w in zip(at_cell[c].tolist(), split_parts(x, y)):
                    of_word[i] = w
            at = 0
            for text, k in zip(raw, block.count.tolist()):
                row = np.frombuffer(b"".join([of_word[i] for i in block.inv[at: at + k].tolist()]), np.uint32)
                at += k
                back = b"".join([by_id[i] for i in row.tolist()])
                if back != text:
                    row = np.array(_encoding(path, pattern).encode_ordinary(text.decode()), np.uint32)
                    back = b"".join([by_id[i] for i in row.tolist()])
                found.append(row)
                decoded.append(back if digest else b"")
            flat_ids += ids
        if digest:
            return pa.table({id_col: pa.array(flat_ids, arrow_id), "n_tokens": pa.array(map(len, found), pa.int64()),
                             "ids_sha256": pa.array([_digest(r.tolist()) for r in found], pa.string()),
                             "text": pa.array(decoded, pa.binary())})
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        values = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
        return pa.table({id_col: pa.array(flat_ids, arrow_id),
                         "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(values))})

    words = src.mapInArrow(explode_words, schema).repartition("cell").mapInArrow(encode_words, schema)
    columns = DECODED if digest else "ids array<int>"
    return (kept_texts(src, BLOCK_BYTES).groupBy("block").cogroup(words.groupBy("block"))
            .applyInArrow(reassemble, f"`{id_col}` {id_field}, {columns}"))


DECODED = "n_tokens long, ids_sha256 string, text binary"


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, text binary) of ``encode``'s rows: every id is
    joined to its bytes by the token-byte table."""
    id_field = encoded.schema[id_col].dataType.simpleString()

    def look_up(batches):
        by_id = token_bytes(path)
        for b in batches:
            n, digest, raw = [], [], []
            for ids in b.column(1):
                ids = ids.values.to_numpy().tolist() if ids.is_valid else []
                n.append(len(ids))
                digest.append(_digest(ids))
                raw.append(b"".join([by_id[i] for i in ids]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(raw, pa.binary())],
                names=[id_col, "n_tokens", "ids_sha256", "text"])

    return encoded.select(id_col, "ids").mapInArrow(
        look_up, f"`{id_col}` {id_field}, {DECODED}")


def multi_50k() -> tuple[str, str]:
    """(rank file, pattern) of the installed many-language vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = multi_50k()
    d = encode(table(spark, sf_dir, "documents"), path, pattern, digest=True)
    return d.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
