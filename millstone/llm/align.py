"""Operator 11: alignment of two tokenizers by byte spans.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model with
byte fallback.  Both read a blank and the text.  The libraries' character
offsets are coarse cuts; tokens that end inside a character (parts of a
multibyte one, byte-fallback pieces) are placed by the lengths of their decoded
bytes.  Byte offsets where tokens of both end cut a text into groups.

1. Neither tokenizer joins what precedes a blank with the blank, unless it is
   white space (``\\s`` of A, a blank of B; no piece of B holds a blank behind
   another character, which is checked when it is loaded).  A block's texts are
   therefore cut there into units, each distinct unit is encoded once, in runs
   of units, and groups never leave a unit.  Runs whose bytes do not come back,
   or that do not end where their units end, are encoded unit by unit.
2. Each block's digests, counts and linked id pairs (with their numbers) are
   written once.  Its distinct pairs with the documents that hold them go to the
   cells of their hash; a cell adds up, over all blocks, the documents of each
   pair and answers.  The highest count of each A id (no more numbers than A's
   vocabulary has) is sent to all tasks.
3. The answers meet the block's pairs and give the sums per document.

Pairs within a group are made from the distinct ids of both sides with their
numbers of occurrences, so a long group costs the square of its distinct ids at
most.  A hot pair has one entry per block.

Defined cases: NULL and empty texts, and texts whose joined bytes of A or B
differ from a blank and the text (such as those that hold U+2581, or bytes that
are not UTF-8), have no tokens: zeros and an empty string; strings of special
tokens are plain text; repeated rows and NULL ids each give their own row and
count as documents; an empty table gives no rows; only the id and text columns
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millstone.llm.blocks import cell_batches, n_cells, row_blocks, source
from millstone.llm.common import staged, table
from millstone.llm.tokens import mix, release, span_hashes

BLOCK_BYTES = 4 << 20
HASH_BYTES = 1 << 20
#: bytes of units encoded in one call, about
RUN_BYTES = 1 << 15
#: units that a worker remembers between blocks, at most about
KNOWN = 1 << 18

_ROW = ["n_a", "n_b", "n_groups", "n_links"]


@cache
def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 characters stand for themselves, the others follow in
    order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


def _columns(pairs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.fromiter(chain.from_iterable(pairs), np.int64, 2 * len(pairs))
    return flat[::2], flat[1::2]


class TokenizerA:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.encode_special_tokens = True
        of = byte_level()
        vocab = self.t.get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        self.size = np.array([len(b) for b in self.bytes], np.int64)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first characters, end characters)"""
        e = self.t.encode(text, add_special_tokens=False)
        return (np.array(e.ids, np.int64), *_columns(e.offsets))


class TokenizerB:
    """``text`` begins with the blank that the model adds itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.t = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.t.id_to_piece(i) for i in range(self.t.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a blank behind another character: units cannot be cut at blanks")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.t.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.size = np.array([len(b) for b in self.bytes], np.int64)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r = self.t.encode(text[1:], return_type="offset_mapping")
        start, end = _columns(r["offsets"])
        start, end = start + 1, end + 1
        start[:1] = 0
        return np.array(r["ids"], np.int64), start, end


@cache
def tokenizer(kind: str, path: str):
    return {"A": TokenizerA, "B": TokenizerB}[kind](path)


def byte_ends(tok, text: str, raw: bytes) -> tuple[np.ndarray, np.ndarray] | None:
    """(ids, byte offset behind each token), or None if the tokens' bytes are
    not ``raw``."""
    ids, start, end = tok.spans(text)
    if b"".join([tok.bytes[i] for i in ids.tolist()]) != raw:
        return None
    if not len(ids):
        return ids, end
    if len(raw) != len(text):
        c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        byte_of = np.concatenate([[0], np.cumsum(1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))])
    else:
        byte_of = np.arange(len(raw) + 1)
    ends = byte_of[np.minimum(end, len(text))]
    # a cut is clean where the token has characters and the next starts behind them
    clean = (end > start) & (np.append(start[1:], len(text)) >= end)
    length = np.cumsum(tok.size[ids])
    k = np.arange(len(ids))
    last = np.maximum.accumulate(np.where(clean, k, -1))
    inside = ~clean
    base = np.where(last[inside] >= 0, ends[last[inside]] - length[last[inside]], 0)
    ends[inside] = base + length[inside]
    return (ids, ends) if np.array_equal(ends, length) else (ids, length)


def cut_units(data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, open) of the units of texts that lie one after another, each
    behind a blank; ``texts`` are their starts.  ``open``: the unit ends in white
    space, so nothing may follow it in one run."""
    n = len(data)
    pad = np.concatenate([np.zeros(3, np.uint8), data])
    last, second, third = pad[2:-1], pad[1:-2], pad[:-3]      # of the bytes before each position
    space = (last <= 0x20) | ((second == 0xC2) & ((last == 0x85) | (last == 0xA0)))
    space |= (((third == 0xE2) & ((second == 0x80) | (second == 0x81))) | ((third == 0xE1) & (second == 0x9A))
              | ((third == 0xE3) & (second == 0x80))) & (last >= 0x80)
    first = (data == 0x20) & ~space
    # a blank that ends a text stays with what it follows: alone, it would be an empty text to B
    first[texts[1:] - 1] = False
    first[-1:] = False
    first[texts] = True
    start = np.flatnonzero(first)
    behind = np.append(start[1:], n)
    tail = np.append(space, np.zeros(1, bool))
    tail[n] = bool(n) and (data[-1] <= 0x20 or data[-1] >= 0x80)
    return start, tail[behind]


@dataclass
class Units:
    """Per unit: sizes, the digest text, and its linked pairs
    ``code[first[i]:first[i + 1]]`` with their numbers."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    text: list
    first: np.ndarray
    code: np.ndarray
    times: np.ndarray

    def take(self, i: np.ndarray) -> Units:
        n = self.first[i + 1] - self.first[i]
        first = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.first[i] - first[:-1], n) + np.arange(first[-1])
        return Units(*(getattr(self, c)[i] for c in ("good", *_ROW)), [self.text[k] for k in i.tolist()], first,
                     self.code[at], self.times[at])

    def join(self, other: Units) -> Units:
        return Units(*(np.concatenate([getattr(self, c), getattr(other, c)]) for c in ("good", *_ROW)), self.text + other.text,
                     np.concatenate([self.first, self.first[-1] + other.first[1:]]),
                     np.concatenate([self.code, other.code]), np.concatenate([self.times, other.times]))


def _gather(raw: np.ndarray, first: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts) of the entries i of a list of byte strings."""
    n = first[i + 1] - first[i]
    out = np.concatenate([[0], np.cumsum(n)])
    return raw[np.repeat(first[i] - out[:-1], n) + np.arange(out[-1])], out


class Known:
    """Units of earlier blocks, found by hash and compared by bytes.  At most
    ``KNOWN`` of them: beyond it those stay that several blocks held."""

    def __init__(self):
        self.hash, self.uses = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.raw, self.first, self.units = np.zeros(0, np.uint8), np.zeros(1, np.int64), None

    def find(self, hashes: np.ndarray, raw: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The place of each unit here, or -1; ``hashes`` are distinct."""
        place = np.full(len(hashes), -1, np.int64)
        if not len(self.hash):
            return place
        order = np.argsort(self.hash)
        at = order[np.minimum(np.searchsorted(self.hash[order], hashes), len(order) - 1)]
        size = first[1:] - first[:-1]
        k = np.flatnonzero((self.hash[at] == hashes) & ((self.first[1:] - self.first[:-1])[at] == size))
        theirs, edge = _gather(self.raw, self.first, at[k])
        mine, _ = _gather(raw, first, k)
        differ = np.concatenate([[0], np.cumsum(theirs != mine)])
        k = k[differ[edge[1:]] == differ[edge[:-1]]]
        place[k] = at[k]
        self.uses[at[k]] += 1
        return place

    def add(self, hashes: np.ndarray, raw: np.ndarray, first: np.ndarray, units: Units) -> None:
        if len(self.hash) + len(hashes) > KNOWN and len(self.hash):
            keep = np.flatnonzero(self.uses > 1)
            keep = keep[np.argsort(-self.uses[keep], kind="stable")[: KNOWN // 2]]
            (self.raw, self.first), self.units = _gather(self.raw, self.first, keep), self.units.take(keep)
            self.hash, self.uses = self.hash[keep], self.uses[keep]
        self.units = self.units.join(units) if self.units else units
        self.hash = np.concatenate([self.hash, hashes])
        self.uses = np.concatenate([self.uses, np.ones(len(hashes), np.int64)])
        self.first = np.concatenate([self.first, self.first[-1] + first[1:]])
        self.raw = np.concatenate([self.raw, raw])


def _entries(group: np.ndarray, ids: np.ndarray, width: int):
    """Distinct (group, id), their numbers, and the entries of each group."""
    key, n = np.unique(group * width + ids, return_counts=True)
    return key // width, key % width, n


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = tokenizer("A", path_a), tokenizer("B", path_b)
        self.names = [str(i) for i in range(max(len(self.a.bytes), len(self.b.bytes)))]
        self.width = len(self.b.bytes)
        self.known = Known()

    def runs(self, units: list[bytes], may_end: np.ndarray) -> Iterator[tuple[list[int], bytes]]:
        """Runs of units as (numbers, bytes)."""
        run, size = [], 0
        for i, (u, tail) in enumerate(zip(units, may_end.tolist())):
            if tail:
                yield [i], u
                continue
            run.append(i)
            size += len(u)
            if size >= RUN_BYTES:
                yield run, b"".join([units[k] for k in run])
                run, size = [], 0
        if run:
            yield run, b"".join([units[k] for k in run])

    def encode(self, raw: bytes, edges: np.ndarray):
        """(ids, ends) of A and of B, or None unless both give ``raw`` back and
        end where its units end."""
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return None
        a, b = byte_ends(self.a, text, raw), byte_ends(self.b, text, raw)
        if a is None or b is None or not (np.isin(edges, a[1]).all() and np.isin(edges, b[1]).all()):
            return None
        return a, b

    def units(self, units: list[bytes], tail: np.ndarray) -> Units:
        n = len(units)
        out = Units(np.zeros(n, bool), *(np.zeros(n, np.int64) for _ in range(4)), [b""] * n, np.zeros(n + 1, np.int64),
                    np.zeros(0, np.int64), np.zeros(0, np.int64))
        pairs = []
        for run, raw in self.runs(units, tail):
            edges = np.cumsum([len(units[i]) for i in run])
            found = self.encode(raw, edges)
            if found is None and len(run) > 1:
                for i in run:
                    one = self.encode(units[i], np.array([len(units[i])]))
                    if one is not None:
                        pairs.append(self.groups(out, [i], np.array([len(units[i])]), *one))
            elif found is not None:
                pairs.append(self.groups(out, run, edges, *found))
        if pairs:
            unit, code, times = (np.concatenate(x) for x in zip(*pairs))
            order = np.argsort(unit, kind="stable")
            out.code, out.times = code[order], times[order]
            out.first = np.searchsorted(unit[order], np.arange(n + 1))
        return out

    def groups(self, out: Units, run: list[int], edges: np.ndarray, a, b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fills in the run's units; returns (unit, pair, number of links)."""
        (ids_a, end_a), (ids_b, end_b) = a, b
        cuts = np.intersect1d(end_a, end_b)
        run = np.array(run)
        in_a, in_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        unit = np.searchsorted(edges, cuts)                       # of each group
        k = len(run)
        size_a, size_b = np.bincount(in_a, minlength=len(cuts)), np.bincount(in_b, minlength=len(cuts))
        out.good[run] = True
        out.n_groups[run] = np.bincount(unit, minlength=k)
        for column, v in ((out.n_a, size_a), (out.n_b, size_b), (out.n_links, size_a * size_b)):
            column[run] = np.bincount(unit, weights=v, minlength=k).astype(np.int64)
        name = self.names
        name_a, name_b = [name[i] for i in ids_a.tolist()], [name[i] for i in ids_b.tolist()]
        x, y, parts = 0, 0, []
        for p, q in zip(size_a.tolist(), size_b.tolist()):
            parts.append(",".join(name_a[x: x + p]) + "|" + ",".join(name_b[y: y + q]))
            x, y = x + p, y + q
        at = 0
        for i, m in zip(run.tolist(), out.n_groups[run].tolist()):
            out.text[i] = ";".join(parts[at: at + m]).encode()
            at += m
        # distinct ids of each group on both sides, all of one with all of the other
        ga, ia, ma = _entries(in_a, ids_a, len(self.a.bytes))
        gb, ib, mb = _entries(in_b, ids_b, self.width)
        b_of, nb = np.searchsorted(gb, np.arange(len(cuts))), np.bincount(gb, minlength=len(cuts))
        n = nb[ga]
        off = np.cumsum(n) - n
        other = np.repeat(b_of[ga] - off, n) + np.arange(n.sum())
        code = np.repeat(ia * self.width, n) + ib[other]
        return run[np.repeat(unit[ga], n)], code, np.repeat(ma, n) * mb[other]

    def texts(self, texts: list[bytes]) -> tuple[Units, np.ndarray, np.ndarray]:
        """(distinct units, unit numbers in order, first unit of each text);
        empty texts have none."""
        full = [b" " + t for t in texts if t]
        data = np.frombuffer(b"".join(full), np.uint8)
        first = np.cumsum([0] + [len(t) for t in full])[:-1]
        start, tail = cut_units(data, first) if len(data) else (np.zeros(0, np.int64), np.zeros(0, bool))
        end = np.append(start[1:], len(data))[: len(start)]
        h = np.zeros(len(start), np.uint64)
        a = 0
        while a < len(h):
            b = max(a + 1, int(np.searchsorted(end, start[a] + HASH_BYTES, "right")))
            lo = start[a]
            h[a:b] = span_hashes(data[lo: end[b - 1]], start[a:b] - lo, end[a:b] - lo)
            a = b
        h ^= tail.astype(np.uint64)
        _, one, inv = np.unique(h, return_index=True, return_inverse=True)
        # equal hashes, equal bytes? else by the bytes themselves
        size = end - start
        same = np.array_equal(size, size[one][inv])
        if same and len(data):
            shift = np.repeat(start[one][inv] - start, size)
            same = np.array_equal(data, data[shift + np.arange(len(data))])
        if not same:
            seen: dict = {}
            raw = data.tobytes()
            inv = np.array([seen.setdefault((raw[x:y], z), len(seen)) for x, y, z in zip(start.tolist(), end.tolist(), tail.tolist())])
            _, one = np.unique(inv, return_index=True)
        raw, edge = _gather(data, np.append(start, len(data)), one)
        place = self.known.find(h[one], raw, edge) if same else np.full(len(one), -1, np.int64)
        new = np.flatnonzero(place < 0)
        fresh, cuts = _gather(raw, edge, new)
        whole = fresh.tobytes()
        found = self.units([whole[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())], tail[one][new])
        if len(new) < len(one):
            at = np.empty(len(one), np.int64)
            at[new], at[place >= 0] = np.arange(len(new)), len(new) + np.arange(len(one) - len(new))
            units = found.join(self.known.units.take(place[place >= 0])).take(at)
        else:
            units = found
        if same:
            self.known.add(h[one][new], fresh, cuts, found)
        sizes = np.array([len(t) for t in texts], np.int64)
        lead = np.zeros(len(texts) + 1, np.int64)
        lead[:-1][sizes > 0] = np.searchsorted(start, first)
        lead[-1] = len(start)
        for i in np.flatnonzero(sizes == 0)[::-1].tolist():
            lead[i] = lead[i + 1]
        return units, inv, lead


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _cells(codes: np.ndarray, cells: int) -> np.ndarray:
    return (mix(codes.astype(np.uint64)) % np.uint64(cells)).astype(np.int64)


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """One row per block: per document its id, sizes and digest; the block's
    distinct pairs, the documents of each, and per document its pairs as
    positions among them with their numbers."""
    src = source(docs, id_col, text_col)
    arrow_id, kind = to_arrow_type(src.schema["i"].dataType), src.schema["i"].dataType.simpleString()

    def align_texts(batches):
        al = aligner(path_a, path_b)
        for name, ids, texts, _, _ in row_blocks(batches, BLOCK_BYTES):
            u, inv, lead = al.texts(texts)
            k = len(texts)
            doc = np.repeat(np.arange(k), np.diff(lead))
            good = (np.diff(lead) > 0) & (np.bincount(doc, weights=~u.good[inv], minlength=k) == 0)
            row = {c: np.where(good, np.bincount(doc, weights=getattr(u, c)[inv], minlength=k), 0).astype(np.int64) for c in _ROW}
            digest = [hashlib.sha256(b";".join([u.text[i] for i in inv[a:b].tolist()])).hexdigest() if ok else ""
                      for a, b, ok in zip(lead[:-1].tolist(), lead[1:].tolist(), good.tolist())]
            mine = inv[good[doc]]
            n = (u.first[1:] - u.first[:-1])[mine]
            off = np.cumsum(n) - n
            at = np.repeat(u.first[:-1][mine] - off, n) + np.arange(n.sum())
            owner = np.repeat(doc[good[doc]], n)
            pairs, pos = np.unique(u.code[at], return_inverse=True)
            key = owner * max(len(pairs), 1) + pos
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            times = np.add.reduceat(u.times[at][order], first) if len(first) else np.zeros(0, np.int64)
            key = key[first]
            owner, pos = key // max(len(pairs), 1), key % max(len(pairs), 1)
            held = np.bincount(pos, minlength=len(pairs))
            lists = lambda v, t: pa.array([v], pa.list_(t))
            yield pa.RecordBatch.from_pydict({
                "block": [name], "ids": lists(ids, arrow_id), **{c: lists(row[c], pa.int64()) for c in _ROW},
                "digest": lists(digest, pa.string()), "docs": lists(np.bincount(owner, minlength=k), pa.int64()),
                "pairs": pa.array([_pack(np.diff(pairs, prepend=0).astype(np.uint32))], pa.binary()),
                "held": pa.array([_pack(held.astype(np.uint32))], pa.binary()),
                "pos": pa.array([_pack(np.diff(pos, prepend=0).astype(np.int32))], pa.binary()),
                "times": pa.array([_pack(times.astype(np.uint64))], pa.binary())})
        release()

    return src.mapInArrow(align_texts, f"block string, ids array<{kind}>, "
                          + ", ".join(f"{c} array<long>" for c in _ROW)
                          + ", digest array<string>, docs array<long>, pairs binary, held binary, pos binary, times binary")


def _pairs(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, np.uint32), dtype=np.int64)


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every row."""
    cells = n_cells(docs)
    id_type = source(docs, id_col, text_col).schema["i"].dataType
    blocks = staged(aligned_blocks(docs, path_a, path_b, id_col, text_col), "align-blocks")

    def ask(batches):
        for b in batches:
            for name, pairs, held in zip(*(b.column(c).to_pylist() for c in ("block", "pairs", "held"))):
                pairs, held = _pairs(pairs), _unpack(held, np.uint32)
                cell = _cells(pairs, cells)
                order = np.argsort(cell, kind="stable")
                ends = np.searchsorted(cell[order], np.arange(cells + 1)).tolist()
                rows = [(c, _pack(np.diff(pairs[order[x:y]], prepend=0).astype(np.uint32)), _pack(held[order[x:y]]))
                        for c, (x, y) in enumerate(zip(ends, ends[1:])) if y > x]
                yield from cell_batches(name, rows, [("pairs", pa.binary()), ("held", pa.binary())])

    width = aligner(path_a, path_b).width

    def answer(t: pa.Table) -> pa.Table:
        asked = [_pairs(x) for x in t["pairs"].to_pylist()]
        held = np.concatenate([_unpack(x, np.uint32) for x in t["held"].to_pylist()]).astype(np.int64)
        pairs, pos = np.unique(np.concatenate(asked), return_inverse=True)
        count = np.zeros(len(pairs), np.int64)
        np.add.at(count, pos, held)
        a_id, first = np.unique(pairs // width, return_index=True)
        best = np.maximum.reduceat(count, first)
        ends = np.cumsum([0, *map(len, asked)]).tolist()
        found = [_pack(count[pos[x:y]]) for x, y in zip(ends, ends[1:])]
        # the last row: the highest count of each A id in this cell
        return pa.table({"block": pa.array([*t["block"].to_pylist(), None], pa.string()),
                         "cell": pa.array([*t["cell"].to_pylist(), -1], pa.int32()),
                         "n": pa.array([*found, _pack(best)], pa.binary()),
                         "a": pa.array([*[None] * len(found), _pack(a_id)], pa.binary())})

    asked = blocks.select("block", "pairs", "held").mapInArrow(ask, "block string, cell int, pairs binary, held binary")
    answers = staged(asked.groupBy("cell").applyInArrow(answer, "block string, cell int, n binary, a binary"), "align-answers")

    def spell(batches):
        for b in batches:
            for a, n in zip(b.column("a").to_pylist(), b.column("n").to_pylist()):
                yield pa.RecordBatch.from_pydict({"a": _unpack(a, np.int64), "n": _unpack(n, np.int64)})

    best = answers.where("block is null").select("a", "n").mapInArrow(spell, "a long, n long").groupBy("a").agg(F.max("n").alias("n"))
    highest = np.zeros(len(aligner(path_a, path_b).a.bytes), np.int64)       # one number per A id of the vocabulary
    for r in best.collect():
        highest[r.a] = r.n

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        found = dict(zip(right["cell"].to_pylist(), right["n"].to_pylist()))
        out: dict[str, list] = {c: [] for c in ["ids", *_ROW, "digest", "n_best", "count_sum"]}
        for r in left.to_pylist():
            pairs = _pairs(r["pairs"])
            cell = _cells(pairs, cells)
            order = np.argsort(cell, kind="stable")
            count = np.zeros(len(pairs), np.int64)
            if len(pairs):
                count[order] = np.concatenate([_unpack(found[c], np.int64) for c in np.unique(cell).tolist()])
            pos = np.cumsum(_unpack(r["pos"], np.int32), dtype=np.int64)
            times = _unpack(r["times"], np.uint64).astype(np.int64)
            owner = np.repeat(np.arange(len(r["docs"])), r["docs"])
            total, good = np.zeros((2, len(r["docs"])), np.int64)
            np.add.at(total, owner, times * count[pos])
            np.add.at(good, owner, times * (count == highest[pairs // width])[pos])
            for c in ("ids", *_ROW, "digest"):
                out[c] += r[c]
            out["n_best"] += good.tolist()
            out["count_sum"] += total.tolist()
        return pa.table({id_col: pa.array(out["ids"], to_arrow_type(id_type)),
                         **{c: pa.array(out[c], pa.int64()) for c in [*_ROW, "n_best", "count_sum"]},
                         "groups_sha256": pa.array(out["digest"], pa.string())})

    replies = answers.where("block is not null").select("block", "cell", "n")
    return blocks.drop("held").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        sums, f"`{id_col}` {id_type.simpleString()}, " + ", ".join(f"{c} long" for c in [*_ROW, "n_best", "count_sum"])
        + ", groups_sha256 string")


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, groups): the groups of every row as byte ranges of a blank and the
    text, with the ids of both sides in order."""
    src = source(docs, id_col, text_col)
    kind = src.schema["i"].dataType.simpleString()

    def spans(batches):
        al = aligner(path_a, path_b)
        for b in batches:
            found = []
            for t in b.column(1).cast(pa.large_binary()).to_pylist():
                raw = b" " + (t or b"")
                got = al.encode(raw, np.array([len(raw)])) if t else None
                groups, x, y, start = [], 0, 0, 0
                if got:
                    (ids_a, end_a), (ids_b, end_b) = got
                    for cut in np.intersect1d(end_a, end_b).tolist():
                        p, q = int(np.searchsorted(end_a, cut, "right")), int(np.searchsorted(end_b, cut, "right"))
                        groups.append({"start": start, "end": cut, "a": ids_a[x:p].tolist(), "b": ids_b[y:q].tolist()})
                        x, y, start = p, q, cut
                found.append(groups)
            item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(item))], names=[id_col, "groups"])

    return src.mapInArrow(spans, f"`{id_col}` {kind}, groups array<struct<start: long, end: long, a: array<int>, b: array<int>>>")


def vocabularies() -> tuple[str, str]:
    """Files of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"), *vocabularies())
