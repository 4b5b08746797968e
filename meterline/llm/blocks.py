"""Documents in blocks of doc_id ranges, and hashed keys that travel from blocks to buckets.

A block is a range of doc_id holding a set number of bytes of text. A bucket is a share of a key space. Blocks
send each bucket its sorted distinct keys as one binary value; a bucket answers each block in the order of the
keys it got. Keys are 64-bit hashes; a bucket is chosen by a second, independent hash, so two keys are only
taken for one if both agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID = 1024
CHUNK_SCHEMA = "block long, payload binary"


@dataclass(frozen=True)
class Layout:
    bounds: np.ndarray
    n_blocks: int
    n_buckets: int
    n_bytes: int

    def block_of(self, doc_ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, doc_ids, side="right")


def layout(docs: DataFrame, block_bytes: int = 8 << 20, bucket_bytes: int = 6 << 20, fewest: int = 16) -> Layout:
    """Bounds of blocks from quantiles of doc_id; between GRID quantiles ids count as evenly spread.

    Equal ids share a block. Sizes follow the bytes of all texts; only numbers come to the driver.
    """
    grid = F.percentile_approx("doc_id", F.array(*[F.lit(k / GRID) for k in range(GRID + 1)]), F.lit(20_000))
    row = docs.agg(grid.alias("grid"), F.sum(F.octet_length("text")).alias("n_bytes")).head()
    n_bytes = row.n_bytes or 0
    n_blocks = max(fewest, -(-n_bytes // block_bytes))
    bounds = np.zeros(0, np.int64)
    if row.grid:
        at = np.arange(1, n_blocks) * GRID / n_blocks
        low = np.floor(at).astype(int)
        values = np.array(row.grid, dtype=object)
        bounds = np.array([a + int((b - a) * f) for a, b, f in zip(values[low], values[np.minimum(low + 1, GRID)], at - low)], dtype=np.int64)
    return Layout(bounds, n_blocks, max(2 * fewest, -(-n_bytes // bucket_bytes)), n_bytes)


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def chunks(docs: DataFrame, lay: Layout, view: Callable[[pa.Table], pa.Table] | None = None) -> DataFrame:
    """(block, payload): compressed runs of (doc_id, text), or of what view makes of such rows. Rows without doc_id are dealt to all blocks in turn."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not len(table):
                continue
            block = lay.block_of(table["doc_id"].fill_null(0).to_numpy())
            bare = np.flatnonzero(table["doc_id"].is_null().to_numpy())
            block[bare] = bare % lay.n_blocks
            order = np.argsort(block, kind="stable")
            cut = np.flatnonzero(np.diff(block[order])) + 1
            if view:  # some rows at a time, as what it makes on the way is large
                table = pa.concat_tables([view(table.slice(k, 1000)) for k in range(0, len(table), 1000)]).combine_chunks()
            parts = [x for x in np.split(order, cut) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(block[x[0]]) for x in parts], pa.int64()), pa.array([packed(table.take(pa.array(x)).combine_chunks()) for x in parts], pa.binary())],
                ["block", "payload"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, CHUNK_SCHEMA)


def opened(payloads: pa.ChunkedArray) -> pa.Table:
    """The (doc_id, text) rows of a block, by doc_id; those without come last."""
    tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for p in payloads]
    return pa.concat_tables(tables).sort_by("doc_id").combine_chunks()


def raw_texts(column: pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 bytes of each text; a null is empty."""
    for chunk in column.chunks:
        chunk = chunk.cast(pa.large_binary())
        for value in chunk:
            yield value.as_py() or b""


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_RNG = np.random.default_rng(20240229)
#: Odd multipliers by place in a window, for the key and for the bucket.
FOR_KEY, FOR_BUCKET = (_RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finisher of SplitMix."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int, factors: np.ndarray) -> np.ndarray:
    """A hash for each window of so many words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * factors[0]
    for k in range(1, size):
        total += hashes[k : k + n] * factors[k]
    return mixed(total)


def by_bucket(bucket: np.ndarray, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, with the places of its keys in order."""
    order = np.argsort(bucket.astype(np.uint16) if n_buckets < 65536 else bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=n_buckets)) if n_buckets < 4 * len(bucket) + 1024 else None
    if ends is None:
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        yield from ((int(bucket[x[0]]), x) for x in np.split(order, cut) if len(x))
        return
    begin = 0
    for b, end in enumerate(ends):
        if end > begin:
            yield b, order[begin:end]
        begin = end
