"""Best-fit packing of tokenised documents into sequences of a fixed length, with a fixed number of open bins."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from vitalsieve.llm.common import utf8, written
from vitalsieve.llm.tokens import document_ids, frequent_words, id_bytes, tokenizer_text, worker_table

SEQUENCE = 2048
#: Open bins of a task, and pieces a task packs (one bin set each; fewer tasks leave fewer bins half full at the end).
OPEN_BINS = 4096
PIECES_PER_TASK = 100_000


class OpenBins:
    """Bounded-space best fit. Bit f of ``spaces`` is set while some open bin has f places free."""

    def __init__(self, capacity: int, most: int, first: int):
        self.capacity, self.most, self.next = capacity, most, first
        self.spaces, self.open, self.bins = 0, 0, [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        bin_id = self.bins[space].pop()
        if not self.bins[space]:
            self.spaces ^= 1 << space
        self.open -= 1
        return bin_id

    def place(self, size: int) -> tuple[int, int]:
        """Bin and offset of a piece: the fullest open bin that has room, or a new one. When all bins are open, the fullest closes."""
        fits = self.spaces >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            bin_id = self._take(space)
        else:
            if self.open >= self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            bin_id, space = self.next, self.capacity
            self.next += 1
        left = space - size
        if left:
            self.bins[left].append(bin_id)
            self.spaces |= 1 << left
            self.open += 1
        return bin_id, self.capacity - space


def pieces(docs: DataFrame, tokenizer_path: str, length: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents as ids with ``end_id`` behind, cut only where longer than ``length``.

    NULL and empty texts are the closing id alone. Repeated rows give pieces each.
    """
    model = tokenizer_text(docs.sparkSession, tokenizer_path)
    first = docs.sparkSession.sparkContext.broadcast(frequent_words(Tokenizer.from_str(model.value), make=id_bytes))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(model.value, id_bytes, first.value)
        step = 4 * length
        for batch in batches:
            out = [[] for _ in names]
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = document_ids(value.as_py(), table, end_id.to_bytes(4, "little"))
                for i, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    for column, x in zip(out, (doc_id, i, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(pieces: DataFrame, length: int = SEQUENCE, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Pieces are spread evenly by a hash, about ``per_task`` to a task, and each task packs its own as they come, longest first, so
    a task holds its open bins and one batch. A written table of pieces keeps repeats of a task equal.
    """
    pieces = written(pieces, "pieces")
    tasks = 1 + pieces.count() // per_task
    columns = pieces.columns
    schema = pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, open_bins, TaskContext.get().partitionId() << 40)
        at = columns.index("length")
        for batch in batches:
            places = [bins.place(size) for size in batch.column(at).to_pylist()]
            more = [pa.array([p[i] for p in places], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*columns, "sequence_id", "offset"])

    spread = pieces.repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32"))
    return spread.sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32").mapInArrow(pack, schema)
