"""How filters act together: a sparse document-term matrix with global word numbers, and what each filter takes in every order.

Each task counts the words of its documents under local numbers and hands them on as shards of compressed rows. Only the distinct
words of a shard travel to the global dictionary and their numbers back, packed by shard; then each shard is unpacked and recoded alone, and
its row sums and nonzero counts are the documents' words and distinct words.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalsieve.llm.common import shared_path, utf8, written

#: Text bytes after which a task closes a shard; one longer text is a shard of its own.
SHARD_BYTES = 16 << 20
#: Numbered words that a task holds before it packs them by shard.
PACKED = 1 << 20
#: Keys with more than this share of the rows are joined apart; there are at most 1 / HOT of them.
HOT = 0.001

FILTERS = "ABCDE"
LEAST_WORDS = 200
_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))
_MARKS = re.compile(rb"[#$%&*|]")
_ROWS = "doc_id array<long>, part array<string>, marks array<int>, digest array<binary>"
_SHARD = pa.schema([
    ("shard", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("part", pa.list_(pa.string())), ("marks", pa.list_(pa.int32())), ("digest", pa.list_(pa.binary())),
    ("row_ends", pa.list_(pa.int64())), ("codes", pa.binary()), ("data", pa.binary()), ("words", pa.list_(pa.binary())),
])


def _planes(numbers: np.ndarray) -> bytes:
    """Small 32-bit numbers byte place by byte place, compressed: the high places are zeros nearly throughout."""
    return pa.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True) if len(numbers) else b""


def _from_planes(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``_planes``."""
    plain = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b""
    return np.frombuffer(plain, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def text_marks(text: bytes) -> int:
    """Bits of the filters that read characters: 4 for C (over 3 % capitals), 8 for D (a mark)."""
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    return 4 * (100 * capitals > 3 * points) + 8 * bool(_MARKS.search(text))


class _Codes(dict):
    """Local word numbers in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class _Shard:
    def __init__(self):
        self.size, self.codes, self.rows, self.ends, self.columns, self.data = 0, _Codes(), [], [0], [], []

    def add(self, doc_id: int | None, part: str, text: bytes) -> None:
        words = Counter(text.split())
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words))
        order = np.argsort(codes)
        self.columns.append(codes[order])
        self.data.append(np.fromiter(words.values(), np.int32, len(words))[order])
        self.ends.append(self.ends[-1] + len(words))
        self.rows.append((doc_id, part, text_marks(text), hashlib.sha256(text).digest()))
        self.size += len(text)

    def batch(self, number: int) -> pa.RecordBatch:
        steps = np.diff(np.concatenate(self.columns), prepend=np.int32(0))  # rows ascend, so steps are small
        values = [number, *map(list, zip(*self.rows, strict=True)), self.ends, _planes(steps), _planes(np.concatenate(self.data)), list(self.codes)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _SHARD, strict=True)], schema=_SHARD)


def _local_shards(docs: DataFrame, shard_bytes: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for doc_id, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                shard.add(doc_id, part, text.as_py())
                if shard.size >= shard_bytes:
                    yield shard.batch(number)
                    number, shard = number + 1, _Shard()
        if shard.rows:
            yield shard.batch(number)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), utf8().alias("text"))
    return rows.mapInArrow(count, f"shard long, {_ROWS}, row_ends array<long>, codes binary, data binary, words array<binary>")


def encoded(terms: DataFrame) -> DataFrame:
    """(shard, n, codes, first, steps) from (shard, code, word): equal words get equal numbers, different words different ones.

    A row has ``n`` words of a shard: their codes, and their numbers as the first one and the steps to the others. The dictionary lies dealt
    by the word over all tasks, and none holds its part: words come sorted, so each task counts on where the word changes, from a start of
    its own. The numbers of a repeated task are the same again.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at, held, size = None, (TaskContext.get().partitionId() << 33) - 1, [], 0
        for batch in batches:
            words = batch.column(2)
            if not len(words):
                continue
            changes = np.ones(len(words), np.int64)
            changes[0] = words[0].as_py() != last
            changes[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
            ids = at + np.cumsum(changes)
            last, at = words[-1].as_py(), int(ids[-1])
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), ids))
            size += len(ids)
            if size >= PACKED:
                yield _packed(held)
                held, size = [], 0
        if held:
            yield _packed(held)

    return terms.repartition("word").sortWithinPartitions("word").mapInArrow(number, "shard long, n int, codes binary, first long, steps binary")


def _packed(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row per shard. A shard's words differ, so their numbers ascend; steps are below the rows held."""
    shards, codes, ids = map(np.concatenate, zip(*held, strict=True))
    order = np.argsort(shards, kind="stable")
    shards, codes, ids = shards[order], codes[order], ids[order]
    cuts = np.flatnonzero(shards[1:] != shards[:-1]) + 1
    first, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(shards)]])
    spans = list(zip(first, end, strict=True))
    values = [
        pa.array(shards[first]), pa.array((end - first).astype(np.int32)), pa.array([_planes(codes[i:j]) for i, j in spans], pa.binary()),
        pa.array(ids[first]), pa.array([_planes(np.diff(ids[i:j], prepend=ids[i])) for i, j in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(values, ["shard", "n", "codes", "first", "steps"])


def _numbered(docs: DataFrame, shard_bytes: int) -> DataFrame:
    """Local shards with ``at``: the numbers of their words, as ``encoded`` packs them; NULL for shards without words."""
    path, local = shared_path(docs.sparkSession, "audit-shards"), _local_shards(docs, shard_bytes)
    local.write.option("compression", "zstd").parquet(path)
    shards = docs.sparkSession.read.schema(local.schema).parquet(path)
    numbers = encoded(shards.select("shard", F.posexplode("words").alias("code", "word")))
    numbers = numbers.groupBy("shard").agg(F.collect_list(F.struct("n", "codes", "first", "steps")).alias("at"))
    return shards.drop("words").join(numbers, "shard", "left")


_MATRIX = f"shard long, {_ROWS}, row_ends array<long>, columns array<long>, data array<int>"
_MATRIX_COLUMNS = ["shard", "doc_id", "part", "marks", "digest", "row_ends", "columns", "data"]


def _recoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of ``_numbered`` with global numbers, one at a time."""
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1)
            size, parts = row.column("row_ends")[0].values[-1].as_py(), row.column("at")[0].as_py() or []
            ids = np.empty(sum(p["n"] for p in parts), np.int64)
            for p in parts:
                ids[_from_planes(p["codes"], p["n"])] = p["first"] + np.cumsum(_from_planes(p["steps"], p["n"]), dtype=np.int64)
            columns = ids[np.cumsum(_from_planes(row.column("codes")[0].as_py(), size), dtype=np.int32)]
            counts = _from_planes(row.column("data")[0].as_py(), size)
            named = {n: row.column(n) for n in row.schema.names} | {"columns": _listed(columns, pa.int64()), "data": _listed(counts, pa.int32())}
            yield pa.RecordBatch.from_arrays([named[n] for n in _MATRIX_COLUMNS], _MATRIX_COLUMNS)


def _listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """All values as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def term_matrix(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(shard, doc_id, part, marks, digest, row_ends, columns, data): the document-term matrix of all texts, in shards of compressed rows.

    Row r of a shard has the word numbers ``columns[row_ends[r] : row_ends[r + 1]]`` and their counts in ``data`` beside them; ``doc_id``,
    ``part``, ``marks`` and ``digest`` have one entry per row. A word occurs once in a shard's list, so the commonest word travels
    once a shard. NULL and empty texts are rows without entries; repeated rows are rows each.
    """
    return _numbered(docs, shard_bytes).mapInArrow(_recoded, _MATRIX)


_COUNTS = "doc_id long, part string, marks int, digest binary, n_words long, n_distinct long"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "part", "marks", "digest", "n_words", "n_distinct"]
    for batch in batches:
        for i in range(len(batch)):
            ends = batch.column("row_ends")[i].values.to_numpy()
            totals = np.concatenate(([0], np.cumsum(batch.column("data")[i].values.to_numpy(), dtype=np.int64)))[ends]
            rows = [batch.column(n)[i].values for n in ("doc_id", "part", "marks", "digest")]
            yield pa.RecordBatch.from_arrays([*rows, pa.array(np.diff(totals)), pa.array(np.diff(ends))], names)


def row_counts(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, part, marks, digest, n_words, n_distinct) of every row of the matrix: its sum and its number of entries.

    A worker makes each shard of the matrix and reads it on the spot, so that recoded shards do not travel between processes.
    """
    return _numbered(docs, shard_bytes).mapInArrow(lambda batches: _sums(_recoded(batches)), _COUNTS)


def attached(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``facts``, which has one row a key. Rows of keys above a share HOT never meet in one task.

    Such keys are at most 1 / HOT, so their facts are broadcast; rows without a key have no facts and stay where they are.
    """
    hot = F.broadcast(rows.groupBy(key).count().filter(F.col(key).isNotNull() & (F.col("count") > max(total * HOT, 1))).select(key))
    known = rows.filter(F.col(key).isNotNull())
    often = known.join(hot, key, "left_semi").join(F.broadcast(facts.join(hot, key, "left_semi")), key, "left")
    rest = known.join(hot, key, "left_anti").join(facts, key, "left")
    without = rows.filter(F.col(key).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema if f.name != key])
    return often.unionByName(rest).unionByName(without)


def document_flags(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, part, fails, good, toxic) for every row: ``fails`` has bit 1 for A, 2 for B, 4 for C, 8 for D and 16 for E.

    E compares SHA-256 digests; a row without doc_id is no smaller one and has none. Of repeated labels the largest counts; labels without
    doc_id count for no row.
    """
    rows = written(row_counts(docs.select("doc_id", "lang", "text"), shard_bytes), "audit-rows")
    total = rows.count()
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic"))
    rows = attached(attached(rows, copies, "digest", total), known, "doc_id", total)
    short = (F.col("n_words") < LEAST_WORDS).cast("int")
    poor = (100 * F.col("n_distinct") < 50 * F.col("n_words")).cast("int")
    later = F.coalesce((F.col("doc_id") > F.col("first_id")).cast("int"), F.lit(0))
    fails = short + 2 * poor + F.col("marks") + 16 * later
    return rows.select("doc_id", "part", fails.alias("fails"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])


def _plan(letters: str) -> Column:
    """Every step of every order: the order, the step from 1 on, the step's bit, and the bits before it."""
    bit = {c: 1 << i for i, c in enumerate(letters)}
    steps = [{"o": "".join(p), "s": i + 1, "f": bit[p[i]], "b": sum(bit[c] for c in p[:i])} for p in permutations(letters) for i in range(len(p))]
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<o:string,s:int,f:int,b:int>>")


def interactions(flags: DataFrame, letters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from (part, fails, good, toxic).

    Documents are counted by their pattern of failures first, combined before the shuffle; all orders are then worked out on the
    patterns, at most ``2 ** len(letters)`` a part. Parts appear as they are in the rows; no rows, no parts.
    """
    n = F.count(F.lit(1))
    patterns = flags.groupBy("part", "fails").agg(n.alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    rows = patterns.select("*", F.explode(_plan(letters)).alias("at")).select("*", "at.*")
    fails, before = F.col("fails").bitwiseAND(F.col("f")) != 0, F.col("fails").bitwiseAND(F.col("b")) != 0

    def total(what: str, where: Column, name: str) -> Column:
        return F.sum(F.when(where, F.col(what)).otherwise(0)).cast("long").alias(name)

    steps = rows.groupBy("part", F.col("o").alias("filter_order"), F.col("s").alias("step"), "f").agg(
        total("n", ~fails & ~before, "kept"), total("n", fails & ~before, "removed"), total("n", fails & before, "redundant"),
        total("n", F.col("fails") == F.col("f"), "unique_fails"), total("good", fails & ~before, "good_lost"), total("toxic", fails & ~before, "toxic_lost"))
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "f"))).drop("f")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters over whole texts of ``docs``, by language; NULL counts as an empty language."""
    return interactions(document_flags(docs, labels))
