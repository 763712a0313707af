"""Operator 10: repeated 50-byte strings by common-prefix interval trees.

Every 50-byte window contains an anchor: the k-gram with the smallest hash of
those inside it.  Equal windows have equal anchors, so the work is dealt out by
anchor:

1. Blocks of texts send the hashes of their anchors to cells; a cell answers
   which occur in more than one document (all other text is unique).
2. For those anchors the blocks send the stretch of text whose windows have
   that anchor (50 to 84 bytes), each distinct stretch once per block with its
   smallest doc_id.  Anchors with very many occurrences send the single windows
   instead, to cells of their own hash: the unequal surroundings of a hot
   passage spread over all cells, and the passage itself is one entry a block.
3. A cell collapses equal stretches.  Over stretches that share an anchor and
   differ it builds an enhanced suffix array (suffix array and common-prefix
   lengths) of the places whose 50-byte window occurs twice, walks its interval tree with a stack, and keeps the intervals of
   50 bytes or more whose occurrences are preceded by different bytes: the
   maximal repeats, with all their occurrences.  An occurrence is removed where
   its group has a smaller doc_id.
4. The answers return to the blocks, where the covered bytes are merged.

The input should be a table read (it is scanned three times and must give the
same rows); blocks that miss an answer raise an error.

Defined cases: NULL is an empty text; texts of fewer than 50 bytes lose
nothing; rows with equal doc_id do not remove from each other; a NULL doc_id
sorts before all others; an empty table gives no rows; other columns are
ignored.  Kept bytes need not be valid UTF-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millstone.llm.blocks import cell_batches, cell_split, join_parts, kept_texts, n_cells, row_blocks, source, split_parts
from millstone.llm.common import table
from millstone.llm.tokens import mix, powers, span_hashes

LENGTH = 50
K = 16
#: occurrences beyond which an anchor sends single windows
HOT = 20_000
#: bytes of text whose anchors are found at once (the arrays stay in a core's cache)
SLICE = 1 << 18
#: symbols of a stretch that are compared at once
PACK = 7
#: low bits of a k-gram's number that hold its place
PLACE_BITS = 19
MISSING = "a block's answers are missing: the input gave other rows when it was read again"
_NONE = np.int64(-(1 << 63))


def _kgram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each place, whatever text they lie in."""
    n = len(data) - k + 1
    buf = data.tobytes()
    h = np.zeros(n, np.uint64)
    for at in sorted({*range(0, k - 8, 8), k - 8}):  # eight bytes at a time, the last overlapping
        h ^= np.ndarray((n,), "<u8", buf, at, (1,))
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchors(data: np.ndarray, edges: np.ndarray, length: int = LENGTH, k: int = K):
    """(hash, first window, last window) of every anchor: the windows
    first..last (by their first byte) have their smallest k-gram there, the
    leftmost of equal ones.  The low bits of a hash give way to the place, so
    that one number per window names the hash and the k-gram.  Texts beyond
    ``SLICE`` windows are taken in pieces; the anchor at a seam is two."""
    w = length - k + 1
    windows = max(len(data) - length + 1, 0)
    if not 8 <= k <= length or SLICE + w > 1 << PLACE_BITS:
        raise ValueError("a k-gram has 8 bytes or more, and a piece's places fit their bits")
    fits = np.zeros(windows, bool)
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
        fits[a: max(z - length + 1, a)] = True
    low = np.uint64((1 << PLACE_BITS) - 1)
    parts = []
    for p in range(0, windows, SLICE):
        start = np.flatnonzero(fits[p: p + SLICE])
        if not len(start):
            continue
        h = _kgram_hashes(data[p: p + SLICE + length - 1], k)
        h &= ~low
        h |= np.arange(len(h), dtype=np.uint64)
        m, size = h, 1
        while size * 2 <= w:
            m = np.minimum(m[: len(m) - size], m[size:])
            size *= 2
        n = len(h) - w + 1
        m = np.minimum(m[:n], m[w - size: w - size + n])[start]
        new = np.ones(len(m), bool)
        new[1:] = (m[1:] != m[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(m) - 1)
        parts.append((m[first] & ~low, start[first] + p, start[last] + p))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*parts))


def text_slices(raw: list[bytes], limit: int = SLICE):
    """(first text, end text, bytes, edges) of runs of texts."""
    k = 0
    while k < len(raw):
        a, size = k, 0
        while k < len(raw) and (k == a or size + len(raw[k]) <= limit):
            size += len(raw[k])
            k += 1
        data = np.frombuffer(b"".join(raw[a:k]), np.uint8)
        yield a, k, data, np.cumsum([0, *map(len, raw[a:k])])


class BlockAnchors:
    """Anchors of a block's texts, and their distinct hashes in cell order."""

    def __init__(self, ids: list, raw: list[bytes], cells: int):
        self.doc = np.array([_NONE if i is None else i for i in ids], np.int64)
        parts = []
        self.slices = list(text_slices(raw))
        for s, (a, _, data, edges) in enumerate(self.slices):
            h, first, last = anchors(data, edges)
            owner = np.searchsorted(edges, first, "right") - 1 + a
            parts.append((np.full(len(h), s), h, first, last, self.doc[owner]))
        self.slice, self.h, self.first, self.last, self.owner = (
            np.concatenate(c) if parts else np.zeros(0, np.int64) for c in (zip(*parts) if parts else [[]] * 5))
        self.distinct, self.inv, self.count = np.unique(self.h, return_inverse=True, return_counts=True)
        self.cells = cell_split((mix(self.distinct.astype(np.uint64)) % np.uint64(cells)).astype(np.int64), cells)

    def spread(self) -> np.ndarray:
        """Whether a distinct anchor lies in several documents of the block."""
        order = np.lexsort((self.owner, self.inv))
        d, i = self.owner[order], self.inv[order]
        out = np.zeros(len(self.distinct), bool)
        if len(d):
            out[i[1:][(i[1:] == i[:-1]) & (d[1:] != d[:-1])]] = True
        return out


class Stretches:
    """Distinct stretches of a block under repeated (and hot) anchors."""

    def __init__(self, b: BlockAnchors, repeated: np.ndarray, hot: np.ndarray, cells: int):
        take = np.flatnonzero(repeated[b.inv])
        single = hot[b.inv[take]]
        n = np.where(single, b.last[take] - b.first[take] + 1, 1)
        occ = np.repeat(take, n)
        off = np.arange(len(occ)) - np.repeat(np.cumsum(n) - n, n)
        one = np.repeat(single, n)
        self.slice, self.owner = b.slice[occ], b.owner[occ]
        self.start = b.first[occ] + np.where(one, off, 0)
        self.end = np.where(one, self.start + LENGTH, b.last[occ] + LENGTH)
        key = np.zeros(len(occ), np.uint64)
        turn = np.searchsorted(self.slice, np.arange(len(b.slices) + 1))
        for s, (_, _, data, _) in enumerate(b.slices):
            mine = slice(turn[s], turn[s + 1])
            if turn[s] < turn[s + 1]:
                key[mine] = span_hashes(data, self.start[mine], self.end[mine])
        self.key, at, self.inv = np.unique(key, return_index=True, return_inverse=True)
        self.sample = at
        self.anchor = np.where(one, key, b.h[occ])[at] if len(occ) else np.zeros(0, np.uint64)
        self.least = np.full(len(self.key), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.inv, self.owner)
        self.cell = (mix(self.anchor.astype(np.uint64)) % np.uint64(cells)).astype(np.int64)
        self.cells = cell_split(self.cell, cells)
        self._slices = b.slices

    def places(self) -> list[bytes]:
        """What the block needs to apply the answers: of every occurrence its
        first byte in the block, its size, its stretch and whether a smaller
        doc_id of the block holds the stretch; of every stretch its cell."""
        base = np.cumsum([0, *[len(data) for _, _, data, _ in self._slices]])
        start = base[self.slice] + self.start if len(self.start) else self.start
        later = self.owner > self.least[self.inv]
        return [start.astype(np.int32).tobytes(), (self.end - self.start).astype(np.uint8).tobytes(),
                self.inv.astype(np.int32).tobytes(), later.astype(np.uint8).tobytes(),
                self.cell.astype(np.int32).tobytes()]

    def content(self, which: np.ndarray) -> list[bytes]:
        out = []
        for i in self.sample[which].tolist():
            data = self._slices[self.slice[i]][2]
            out.append(data[self.start[i]: self.end[i]].tobytes())
        return out


def packed_symbols(t: np.ndarray) -> np.ndarray:
    """Seven symbols (of 9 bits) from each place as one number, in their
    order; places beyond the end count as 0."""
    pad = np.concatenate([t, np.zeros(PACK, t.dtype)]).astype(np.uint64)
    out = pad[: len(t)].copy()
    for k in range(1, PACK):
        out <<= np.uint64(9)
        out |= pad[k: k + len(t)]
    return np.concatenate([out, [np.uint64(0)]])


def suffix_array(pack: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes at ``starts`` sorted by their first ``depth`` symbols: seven
    symbols at a time, of which only ties are sorted again."""
    n = len(pack) - 1
    sa = starts[np.argsort(pack[starts])]
    first = np.ones(len(sa), bool)
    first[1:] = pack[sa[1:]] != pack[sa[:-1]]
    group = np.flatnonzero(first)[np.cumsum(first) - 1]
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    for d in range(PACK, depth, PACK):
        if not len(tied):
            break
        s, g = sa[tied], group[tied]
        nxt = pack[np.minimum(s + d, n)]
        same = (g[1:] == g[:-1])
        if (nxt[1:] < nxt[:-1])[same].any():  # else in order already
            order = np.lexsort((nxt, g))
            s, nxt = s[order], nxt[order]
            sa[tied] = s
        first = np.ones(len(tied), bool)
        first[1:] = ~same | (nxt[1:] != nxt[:-1])
        group[tied] = tied[np.flatnonzero(first)][np.cumsum(first) - 1]
        tied = tied[~(first & np.append(first[1:], True))]
    return sa


def common_prefixes(t: np.ndarray, pack: np.ndarray, left: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Common-prefix length of each suffix with the one before it, inside their
    stretches; ``left`` are the bytes left in a stretch from each place."""
    lcp = np.zeros(len(sa), np.int64)
    n = len(pack) - 1
    a, b = sa[:-1], sa[1:]
    limit = np.minimum(left[a], left[b])
    go = np.arange(len(b))
    d = 0
    whole = np.zeros(len(b), np.int64)
    while len(go):  # whole packs of symbols, then the symbols of the first that differs
        go = go[pack[np.minimum(a[go] + d, n)] == pack[np.minimum(b[go] + d, n)]]
        d += PACK
        whole[go] = d
        go = go[limit[go] > d]
    go = np.flatnonzero(whole < limit)
    for _ in range(PACK):
        at = whole[go]
        go = go[t[a[go] + at] == t[b[go] + at]]
        whole[go] += 1
        go = go[whole[go] < limit[go]]
    lcp[1:] = np.minimum(whole, limit)
    return lcp


def maximal_repeats(t: np.ndarray, sa: np.ndarray, lcp: np.ndarray, doc: np.ndarray, least: int = LENGTH):
    """Stack scan of the interval tree: yields (length, first row, end row,
    smallest doc) of every interval of at least ``least`` common symbols whose
    suffixes are preceded by different symbols (0, the start of a stretch,
    differs from everything, itself too).  An interval that is preceded by one
    symbol only is a part of the one that starts there."""
    before = t[sa - 1]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], lcp >= least, [False]]).astype(np.int8)))
    begin, end = edge[::2] - 1, edge[1::2]
    two = end - begin == 2  # a leaf pair: one interval, decided without a stack
    a = begin[two]
    p, q = before[a], before[a + 1]
    a = a[(p == 0) | (q == 0) | (p != q)]
    yield from zip(lcp[a + 1].tolist(), a.tolist(), (a + 2).tolist(), np.minimum(doc[a], doc[a + 1]).tolist())
    for a, z in zip(begin[~two].tolist(), end[~two].tolist()):
        # rows a..z-1, in which neighbours share at least ``least`` symbols
        own, prev, depth = doc[a:z].tolist(), before[a:z].tolist(), lcp[a:z].tolist()
        n = z - a
        stack: list[list[int]] = []  # length, first row, smallest doc, symbol before (-1: several)
        for i in range(1, n + 1):
            here = depth[i] if i < n else 0
            first, low, symbol = i - 1, own[i - 1], prev[i - 1] or -1
            while stack and stack[-1][0] > here:
                length, first, m, p = stack.pop()
                low = m if m < low else low
                symbol = symbol if symbol == p else -1
                if symbol == -1:
                    yield length, a + first, a + i, low
            if stack and stack[-1][0] == here:
                top = stack[-1]
                top[2] = min(top[2], low)
                top[3] = symbol if symbol == top[3] else -1
            elif i < n:
                stack.append([here, first, low, symbol])


def covered_stretches(contents: list[bytes], doc: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """For distinct stretches with their smallest doc_ids: by number, the
    places (start, end) repeated in a stretch of a smaller doc_id."""
    size = np.array([len(c) for c in contents])
    t = np.frombuffer(b"".join(c + b"\0" for c in contents), np.uint8).astype(np.int16) + 1
    ends = np.cumsum(size + 1) - 1
    t[ends] = 0
    begin = ends - size
    # a repeat of LENGTH symbols starts where such a window occurs twice: equal
    # windows have equal hashes, all other places stay out of the suffix array
    n = size - LENGTH + 1
    owner = np.repeat(np.arange(len(contents)), n)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + begin[owner]
    h = span_hashes(t, starts, starts + LENGTH)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    starts = starts[twice]
    if not len(starts):
        return {}
    left = np.zeros(len(t), np.int64)
    left[starts] = ends[owner[twice]] - starts
    of_place = np.zeros(len(t), np.int32)
    of_place[starts] = owner[twice]
    pack = packed_symbols(t)
    sa = suffix_array(pack, starts, int(size.max()))
    lcp = common_prefixes(t, pack, left, sa)
    t = np.append(t, t.dtype.type(0))  # t[-1] is what stands before the first place
    of = of_place[sa]
    out: dict[int, list[tuple[int, int]]] = {}
    at, own, low = (sa - begin[of]).tolist(), of.tolist(), doc[of].tolist()
    for length, a, z, m in maximal_repeats(t, sa, lcp, doc[of]):
        for r in range(a, z):
            if low[r] > m:
                out.setdefault(own[r], []).append((at[r], at[r] + length))
    return out


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(id, n_bytes, spans array<int>, kept binary): removed runs as flat
    (start, end) byte pairs of each row, and what is left."""
    src = source(docs, id_col, text_col).withColumn("i", F.col("i").cast("long"))
    cells = n_cells(docs)
    packed = [("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())]
    schema = "block string, cell int, a binary, b binary, c binary, d binary"
    names = ["block", "cell", "a", "b", "c", "d"]
    dealt = "deal int, " + schema

    def send_anchors(batches):
        """a: six bytes of each distinct hash, b and c: which occur more than
        once here and how often, d: which lie in several documents here."""
        for name, ids, raw, _, _ in row_blocks(batches):
            b = BlockAnchors(ids, raw, cells)
            spread = b.spread()
            rows = []
            for c, at in enumerate(b.cells):
                if len(at):
                    six = mix(b.distinct[at].astype(np.uint64)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]
                    many = np.flatnonzero(b.count[at] > 1)
                    rows.append((c, six.tobytes(), many.astype(np.int32).tobytes(),
                                 b.count[at][many].astype(np.int32).tobytes(), np.packbits(spread[at]).tobytes()))
            yield from cell_batches(name, rows, packed)

    def judge_anchors(t: pa.Table) -> pa.Table:
        """Which anchors of each block are repeated (a) and hot (b), as bits."""
        six = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in t.column("a").to_pylist()]
        counts, spread = [], []
        for x, many, count, bits in zip(six, *(t.column(k).to_pylist() for k in "bcd")):
            n = np.ones(len(x), np.int64)
            n[np.frombuffer(many, np.int32)] = np.frombuffer(count, np.int32)
            counts.append(n)
            spread.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(x)))
        flat = np.concatenate(six)
        key = np.zeros((len(flat), 8), np.uint8)
        key[:, 2:] = flat
        key = key.view(">u8").ravel().astype(np.uint64)
        order = np.argsort(key)
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        at = np.flatnonzero(new)
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(new) - 1
        total = np.add.reduceat(np.concatenate(counts)[order], at)
        many = (np.diff(np.append(at, len(key))) > 1) | (np.add.reduceat(np.concatenate(spread)[order].astype(np.int64), at) > 0)
        edge = np.cumsum([len(x) for x in six])[:-1]
        bits = [[np.packbits(p).tobytes() for p in np.split(f[group], edge)] for f in (many, many & (total > hot))]
        empty = pa.array([b""] * len(six), pa.binary())
        return pa.table([t.column("block"), t.column("cell"), pa.array(bits[0], pa.binary()),
                         pa.array(bits[1], pa.binary()), empty, empty], names=names)

    def flags_of(b: BlockAnchors, right: pa.Table):
        out = [np.zeros(len(b.distinct), bool) for _ in range(2)]
        seen = 0
        for c, *bits in zip(*(right.column(k).to_pylist() for k in ("cell", "a", "b"))):
            at = b.cells[c]
            for f, x in zip(out, bits):
                f[at] = np.unpackbits(np.frombuffer(x, np.uint8), count=len(at)).astype(bool)
            seen += 1
        if seen != sum(len(at) > 0 for at in b.cells):
            raise RuntimeError(MISSING)
        return out

    def blocks_of(left: pa.Table):
        """A block's rows; repeated blocks of equal content are one."""
        ids, blob, sizes = (left.column(c).to_pylist() for c in ("ids", "blob", "sizes"))
        return len(ids), ids[0], split_parts(blob[0], sizes[0])

    def send_stretches(left: pa.Table, right: pa.Table) -> pa.Table:
        """a, b: distinct stretches, c: anchors, d: smallest doc_ids here; the
        answers of step 1 travel on as a row of cell -1."""
        _, ids, raw = blocks_of(left)
        b = BlockAnchors(ids, raw, cells)
        repeated, is_hot = flags_of(b, once(right))
        st = Stretches(b, repeated, is_hot, cells)
        name = left.column("block")[0].as_py()
        rows = [(int(name[:8], 16) % cells, name, -1, *join_parts(st.places()), b"", b"")]
        for c, at in enumerate(st.cells):
            if len(at):
                blob, sizes = join_parts(st.content(at))
                rows.append((c, name, c, blob, sizes, st.anchor[at].tobytes(), st.least[at].tobytes()))
        types = [pa.int32(), pa.string(), pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array(x, ty) for x, ty in zip(zip(*rows), types)], names=["deal", *names])

    def once(right: pa.Table) -> pa.Table:
        """Equal blocks sent equal requests: one answer per cell."""
        _, one = np.unique(right.column("cell").to_numpy(), return_index=True)
        return right.take(pa.array(one))

    def judge_stretches(t: pa.Table) -> pa.Table:
        """a: bits of stretches that lie in a smaller doc_id; b: number, start,
        end (int32) of repeated places of the others.  Rows of cell -1 pass."""
        stay = pa.compute.less(t.column("cell"), 0)
        passed, t = t.filter(stay).select(names), t.filter(pa.compute.invert(stay)).select(names)
        if not t.num_rows:
            return passed
        parts = [split_parts(x, y) for x, y in zip(t.column("a").to_pylist(), t.column("b").to_pylist())]
        anchor = np.concatenate([np.frombuffer(x, np.uint64) for x in t.column("c").to_pylist()])
        least = np.concatenate([np.frombuffer(x, np.int64) for x in t.column("d").to_pylist()])
        number: dict[bytes, int] = {}
        of = np.array([number.setdefault(s, len(number)) for p in parts for s in p], np.int64)
        contents = list(number)
        m = np.full(len(contents), np.iinfo(np.int64).max)
        np.minimum.at(m, of, least)
        own = np.zeros(len(contents), np.uint64)
        own[of] = anchor
        _, group, size = np.unique(own, return_inverse=True, return_counts=True)
        differ = np.flatnonzero(size[group] > 1)
        places: dict[int, list[tuple[int, int]]] = {}
        if len(differ):
            got = covered_stretches([contents[i] for i in differ.tolist()], m[differ])
            places = {int(differ[k]): v for k, v in got.items()}
        bits, spans, at = [], [], 0
        for p in parts:
            mine, low = of[at: at + len(p)], least[at: at + len(p)]
            at += len(p)
            full = low > m[mine]
            bits.append(np.packbits(full).tobytes())
            rows = [(k, a, z) for k in np.flatnonzero(~full).tolist() for a, z in places.get(int(mine[k]), ())]
            spans.append(np.array(rows, np.int32).tobytes())
        empty = pa.array([b""] * len(parts), pa.binary())
        return pa.concat_tables([passed, pa.table(
            [t.column("block"), t.column("cell"), pa.array(bits, pa.binary()), pa.array(spans, pa.binary()),
             empty, empty], names=names)])

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        copies, ids, raw = blocks_of(left)
        head = right.filter(pa.compute.less(right.column("cell"), 0))
        if head.num_rows != 1:
            raise RuntimeError(MISSING)
        kinds = (np.int32, np.uint8, np.int32, np.uint8, np.int32)
        start, size, inv, later, cell = (np.frombuffer(x, k).astype(np.int64) for x, k in zip(
            split_parts(head.column("a")[0].as_py(), head.column("b")[0].as_py()), kinds))
        places = cell_split(cell, cells)
        full = np.zeros(len(cell), bool)
        parts: dict[int, list[tuple[int, int]]] = {}
        seen = 0
        for c, bits, spans in zip(*(right.column(k).to_pylist() for k in ("cell", "a", "b"))):
            if c < 0:
                continue
            seen += 1
            at = places[c]
            full[at] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at)).astype(bool)
            for k, x, y in np.frombuffer(spans, np.int32).reshape(-1, 3).tolist():
                parts.setdefault(int(at[k]), []).append((x, y))
        if seen != sum(len(at) > 0 for at in places):
            raise RuntimeError(MISSING)
        data = np.frombuffer(b"".join(raw), np.uint8)
        edges = np.cumsum([0, *map(len, raw)])
        whole = full[inv] | (later > 0)
        delta = np.zeros(len(data) + 1, np.int32)
        np.add.at(delta, start[whole], 1)
        np.add.at(delta, (start + size)[whole], -1)
        has = np.zeros(len(cell), bool)
        has[list(parts)] = True
        for i in np.flatnonzero(~whole & has[inv]).tolist():
            for x, y in parts[int(inv[i])]:
                delta[start[i] + x] += 1
                delta[start[i] + y] -= 1
        gone = np.cumsum(delta[:-1], dtype=np.int32) > 0
        spans_out, kept = [], []
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = gone[x:y]
            turn = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
            spans_out.append(turn.tolist())
            kept.append(data[x:y][~own].tobytes() if len(turn) else raw[len(kept)])
        return pa.table([pa.array(ids * copies, arrow_id), pa.array([len(r) for r in raw] * copies, pa.int64()),
                         pa.array(spans_out * copies, pa.list_(pa.int32())), pa.array(kept * copies, pa.binary())],
                        names=[id_col, "n_bytes", "spans", "kept"])

    arrow_id = to_arrow_type(src.schema["i"].dataType)
    by = lambda df: df.groupBy("block")
    texts = kept_texts(src)
    judged = src.mapInArrow(send_anchors, schema).groupBy("cell").applyInArrow(judge_anchors, schema)
    sent = by(texts).cogroup(by(judged)).applyInArrow(send_stretches, dealt)
    answers = sent.groupBy("deal").applyInArrow(judge_stretches, schema)
    return by(texts).cogroup(by(answers)).applyInArrow(
        remove, f"`{id_col}` long, n_bytes long, spans array<int>, kept binary")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = find_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.expr("""aggregate(sequence(0, size(spans) div 2), 0L, (s, k) -> s + coalesce(
        get(spans, cast(k as int) * 2 + 1) - get(spans, cast(k as int) * 2), 0))""")
    return d.select("doc_id", "n_bytes", n_removed.alias("n_removed"),
                    F.expr("size(spans) div 2").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))
