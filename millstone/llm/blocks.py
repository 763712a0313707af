"""Blocks of rows that stay together while what they ask for is shuffled.

A block is a run of rows of one scan task.  Operators send small per-block
requests through a shuffle (in cells of a hash) and bring the answers back to
the block's texts by its name.  Blocks are named by their content: a task that
is run again, or a second scan of the same table, makes the same blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millstone.llm.tokens import release

#: bytes of text in a block, about
BLOCK_BYTES = 8 << 20


def join_parts(parts: list[bytes], level: int = 3) -> tuple[bytes, bytes]:
    z = zstandard.ZstdCompressor(level=level)
    return z.compress(b"".join(parts)), z.compress(np.array([len(p) for p in parts], np.int32).tobytes())


def split_parts(blob: bytes, sizes: bytes) -> list[bytes]:
    z = zstandard.ZstdDecompressor()
    raw = z.decompress(blob)
    ends = np.cumsum(np.frombuffer(z.decompress(sizes), np.int32).astype(np.int64)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def row_blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[str, list, list[bytes], bytes, bytes]]:
    """(name, ids, texts, packed texts, packed sizes) of each block."""
    ids: list = []
    texts: list[bytes] = []
    held = 0

    def block():
        blob, sizes = join_parts(texts, level=1)
        h = hashlib.blake2b(repr(ids).encode(), digest_size=16)
        h.update(sizes)
        h.update(blob)
        return h.hexdigest(), ids, texts, blob, sizes

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist()):
            ids.append(i)
            texts.append(t or b"")
            held += len(texts[-1])
            if held >= limit:
                yield block()
                ids, texts, held = [], [], 0
    if ids:
        yield block()
    release()


def kept_texts(src: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """(block, ids, blob, sizes): the packed texts of (i, t) rows, one row per
    block."""
    arrow_id, kind = to_arrow_type(src.schema["i"].dataType), src.schema["i"].dataType.simpleString()

    def keep(batches):
        for name, ids, _, blob, sizes in row_blocks(batches, limit):
            yield pa.RecordBatch.from_pydict({
                "block": [name], "ids": pa.array([ids], pa.list_(arrow_id)),
                "blob": pa.array([blob], pa.binary()), "sizes": pa.array([sizes], pa.binary())})

    return src.mapInArrow(keep, f"block string, ids array<{kind}>, blob binary, sizes binary")


def n_cells(df: DataFrame) -> int:
    """Cells of a shuffle: a few per shuffle partition, so that they even out."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cell_batches(name: str, rows: list[tuple], fields: list[tuple[str, pa.DataType]],
                 step: int = 64) -> Iterator[pa.RecordBatch]:
    """Rows (cell, *fields) of a block as batches."""
    for k in range(0, len(rows), step):
        part = rows[k: k + step]
        cols = list(zip(*part))
        yield pa.RecordBatch.from_pydict(
            {"block": [name] * len(part), "cell": pa.array(cols[0], pa.int32())}
            | {f: pa.array(c, t) for (f, t), c in zip(fields, cols[1:])})


def cell_split(cell: np.ndarray, n: int) -> list[np.ndarray]:
    """Positions of the entries of each of n cells, in order."""
    order = np.argsort(cell, kind="stable")
    return np.split(order, np.searchsorted(cell[order], np.arange(1, n)))


def source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
