"""Chunks: whole rows of a table, a few megabytes each, kept in shared storage under a fixed number.

Some operators ask something of all occurrences of a word or a passage in the corpus and need the answer back where
the text is. They first sum up each chunk (a key counts once per chunk, however often it occurs there), deal the
sorted keys out by value range, settle each range in one task, and send the answers back to the chunk. So the hottest
key costs one entry per chunk, and a text moves only with its chunk, compressed.
"""

from __future__ import annotations

import io
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gridtide.session import scratch_folder

CHUNK_BYTES = 4 << 20
RANGE_BYTES = 64 << 20


def _pack(batch: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return out.getvalue()


def unpack(payload) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(payload)).read_all().combine_chunks()


def pieces(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about `limit` bytes of text each."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def store(docs: DataFrame, text: str = "text", limit: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """The table `chunk, size, payload` in the shared scratch folder, and the number of ranges that suits its size."""

    def pack(batches):
        base = TaskContext.get().partitionId() << 32
        waiting, held, n = [], 0, itertools.count()

        def flush():
            whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            size = int(pa.compute.sum(pa.compute.binary_length(whole.column(whole.schema.get_field_index(text)))).as_py() or 0)
            return pa.RecordBatch.from_pydict(
                {"chunk": pa.array([base | next(n)], pa.int64()), "size": pa.array([size], pa.int64()), "payload": pa.array([_pack(whole)], pa.binary())}
            )

        for batch in batches:
            for piece in pieces(batch, text, limit):
                waiting.append(piece)
                held += int(pa.compute.sum(pa.compute.binary_length(piece.column(piece.schema.get_field_index(text)))).as_py() or 0)
                if held >= limit:
                    yield flush()
                    waiting, held = [], 0
        if sum(b.num_rows for b in waiting):
            yield flush()

    spark = docs.sparkSession
    folder = scratch_folder(spark, "chunks")
    docs.mapInArrow(pack, "chunk long, size long, payload binary").write.option("compression", "uncompressed").parquet(folder)
    stored = spark.read.parquet(folder)
    total = stored.agg(F.sum("size")).first()[0] or 0
    return stored, ranges(spark, total)


def ranges(spark, size: int) -> int:
    """A few ranges per shuffle partition, and enough that each has a bounded share of the text."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))


def range_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Which of n equal ranges of 32 leading bits each 64-bit key is in; rises with the key."""
    return (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def by_range(chunk: int, keys: np.ndarray, n: int, **columns: np.ndarray) -> pa.RecordBatch | None:
    """Rows `chunk, part, keys, ...` of one chunk's sorted keys; every column is cut like the keys."""
    if not len(keys):
        return None
    part = range_of(keys, n)
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    offsets = pa.array(np.r_[cuts, len(keys)].astype(np.int32))
    fields = {"chunk": pa.array(np.full(len(cuts), chunk, np.int64)), "part": pa.array(part[cuts])}
    fields |= {c: pa.ListArray.from_arrays(offsets, pa.array(v)) for c, v in ({"keys": keys.view(np.int64)} | columns).items()}
    return pa.RecordBatch.from_pydict(fields)


class Gathered:
    """All rows of one range: keys of all chunks one after the other, and where each chunk's run begins."""

    def __init__(self, table: pa.Table):
        self.table = table.combine_chunks()
        self.sizes = pa.compute.list_value_length(self.table["keys"]).to_numpy().astype(np.int64)
        self.bounds = np.r_[0, np.cumsum(self.sizes)]
        self.keys = self.column("keys").view(np.uint64)

    def column(self, name: str) -> np.ndarray:
        return self.table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)

    def answer(self, **columns: np.ndarray) -> pa.Table:
        """Rows `chunk, part, ...`, each column cut as the keys were; booleans are packed into bytes."""
        fields = {"chunk": self.table["chunk"], "part": self.table["part"]}
        offsets = pa.array(self.bounds.astype(np.int32))
        for c, v in columns.items():
            if v.dtype == bool:
                cut = [np.packbits(v[a:b]).tobytes() for a, b in itertools.pairwise(self.bounds)]
                fields[c] = pa.array(cut, pa.binary())
            else:
                fields[c] = pa.ListArray.from_arrays(offsets, pa.array(v))
        return pa.table(fields)


def settle(emitted: DataFrame, work: Callable[[Gathered], pa.Table], schema: str) -> DataFrame:
    """Apply `work` to each range of the emitted rows."""
    return emitted.groupBy("part").applyInArrow(lambda table: work(Gathered(table)), schema)


def bits_of(answers: pa.Table, keys: np.ndarray, n: int, column: str) -> np.ndarray:
    """One chunk's packed answers, laid out like its sorted keys; parts without a row are all false."""
    out = np.zeros(len(keys), bool)
    part = range_of(keys, n)
    for p, packed in zip(answers["part"].to_pylist(), answers[column].to_pylist()):
        lo, hi = np.searchsorted(part, p), np.searchsorted(part, p, "right")
        out[lo:hi] = np.unpackbits(np.frombuffer(packed, np.uint8), count=hi - lo).astype(bool)
    return out
