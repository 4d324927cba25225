"""Packing into fixed windows by Karmarkar-Karp multiway differencing.

A document's ids (and one end id) are cut at whole windows first; those windows are full. What is
left of each document, in pieces of at most `PIECE` ids, is gathered until it fills `WINDOWS`
windows but for a small slack; the last share of a group is halved down to small pieces, which even
out the large ones. The group is then partitioned: every piece starts as a partial partition
(its size, and zeros), and the two partial partitions with the largest imbalance are merged again
and again, the largest sums of one onto the smallest of the other, until one is left. Its windows
are nearly equal. Whenever one of them exceeds the capacity, the number of windows rises by one and
the partition is made anew.

A task packs what it reads, as it reads it: no shuffle, no document is ever held by another task,
and memory is bounded by one batch and one group of pieces. Rows are read in the scan's order, so a
repeated task gives the same sequences.
"""
from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticeguard.llm import bpe

CAPACITY = 1024
END_ID = 0
#: Largest piece of a document's rest, and the windows that are filled together.
PIECE = 512
WINDOWS = 32
#: Share of a group that is cut finely, and the size down to which it is.
FINE = 0.2
LEAST_PIECE = 16
#: Ids that a group of windows leaves free so that the partition fits at once nearly always.
SLACK = 8 * WINDOWS
_TEXTS_AT_ONCE = 256


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of `sizes` by window: Karmarkar-Karp's largest differencing method for `windows` parts."""
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [(size, (i,))] + [(0, ())] * (windows - 1)))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        merged = [(a + b, (x, y) if x and y else x or y) for (a, x), (b, y) in zip(one, reversed(two), strict=True)]
        merged.sort(key=lambda part: -part[0])
        least = merged[-1][0]
        if least:
            merged = [(total - least, members) for total, members in merged]
        heapq.heappush(heap, (-merged[0][0], serial, merged))
        serial += 1
    return [_flat(members) for _, members in heap[0][2]] if heap else []


def _flat(members: tuple) -> list[int]:
    out, stack = [], [members]
    while stack:
        at = stack.pop()
        if isinstance(at, tuple):
            stack.extend(at)
        else:
            out.append(at)
    return sorted(out)


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of piece indices, none over `capacity`; pieces must not exceed it themselves."""
    if not sizes:
        return []
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = differencing(sizes, windows)
        if all(sum(sizes[i] for i in part) <= capacity for part in parts):
            return [part for part in parts if part]
        windows += 1


def rest_pieces(rest: int, piece: int = PIECE, fine: bool = False) -> list[int]:
    """Sizes into which `rest` ids are cut: at `piece`, or, finely, each half of what is still there."""
    sizes = []
    while rest:
        size = min(rest, piece, max(LEAST_PIECE, (rest + 1) // 2)) if fine else min(rest, piece)
        sizes.append(size)
        rest -= size
    return sizes


class _Packer:
    """Pieces of one task: `rows` gets (document, start, length, crc32, document's ids, sequence, offset)."""

    def __init__(self, first_sequence: int, capacity: int, piece: int, windows: int, slack: int):
        self.sequence, self.capacity, self.piece = first_sequence, capacity, piece
        self.target = windows * capacity - slack
        self.waiting, self.held, self.rows = [], 0, []

    def add(self, key, ids: bytes) -> None:
        total = len(ids) // 4
        start = 0
        while total - start >= self.capacity:
            self._emit(self._piece(key, ids, total, start, self.capacity), 0)
            self.sequence += 1
            start += self.capacity
        for length in rest_pieces(total - start, self.piece, self.held >= self.target * (1 - FINE)):
            while length:
                some = min(length, self.target - self.held)
                self.waiting.append(self._piece(key, ids, total, start, some))
                self.held += some
                start, length = start + some, length - some
                if self.held == self.target:
                    self.flush()

    def _piece(self, key, ids: bytes, total: int, start: int, length: int) -> tuple:
        return key, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), total

    def _emit(self, piece: tuple, offset: int) -> None:
        self.rows.append((*piece, self.sequence, offset))

    def flush(self) -> None:
        for part in pack([p[2] for p in self.waiting], self.capacity):
            offset = 0
            for i in part:
                self._emit(self.waiting[i], offset)
                offset += self.waiting[i][2]
            self.sequence += 1
        self.waiting, self.held = [], 0


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   tokenizer: str = bpe.TOKENIZER, ranks: str = bpe.RANKS, end_id: int = END_ID, piece: int = PIECE,
                   windows: int = WINDOWS, slack: int = SLACK) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text is empty text: its document is the end id alone. Repeated rows are packed once each;
    texts of any length are cut; an empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(tokenizer, ranks)
        packer = _Packer(TaskContext.get().partitionId() << 40, capacity, piece, windows, slack)
        key_type = None

        def done() -> pa.RecordBatch:
            columns = zip(*packer.rows, strict=True)
            arrays = [pa.array(next(columns), key_type), *(pa.array(c, pa.int64()) for c in columns)]
            packer.rows = []
            return pa.RecordBatch.from_arrays(arrays, names=["key", *names])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                some = batch.slice(at, _TEXTS_AT_ONCE)
                keys = some.column(0).to_pylist()
                for k, ids in zip(keys, encoder.encode([t or "" for t in some.column(1).to_pylist()]), strict=True):
                    packer.add(k, ids + end)
                if packer.rows:
                    yield done()
        packer.flush()
        if packer.rows:
            yield done()

    schema = f"key {kind}, " + ", ".join(f"{n} long" for n in names)
    packed = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    return packed.withColumnRenamed("key", key)
