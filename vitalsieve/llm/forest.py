"""Near-duplicate documents by an LSH forest: several sorted orders of MinHash signatures, links confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitalsieve.llm.common import located, restored, utf8, written
from vitalsieve.llm.graph import components
from vitalsieve.llm.shingles import MinHash, Powers, shingle_sets

WIDTH, PERCENT = 5, 80
#: Trees, values of a signature that each tree sorts by, neighbours behind each place that are candidates.
TREES, DEPTH, NEAR = 16, 6, 4
MINIMA = 64
#: Candidates must agree in so many of the signature's 64 four-bit remainders; at 80 % overlap 52 are expected, with deviation 3.1.
AGREE = 38
#: Depths at which a crowded region's middle document is paired with the rest of it.
MIDDLES = (1, 2, 4)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, locator, n_shingles, digest, minima) of every row; ``docs`` must have ``locator``. Without words the digest is NULL."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, minima = Powers(), MinHash(MINIMA)
        for batch in batches:
            sizes, digests, lows = [], [], []
            for s in shingle_sets(batch.column(2).to_pylist(), width, powers):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                lows.append(minima(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(lows, pa.binary())], names)

    names = ["doc_id", "locator", "n_shingles", "digest", "minima"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "locator", utf8().alias("text"))
    return rows.mapInArrow(sign, "doc_id long, locator struct<file:long,row:long>, n_shingles long, digest binary, minima binary")


def _places(nodes: DataFrame) -> DataFrame:
    """(key, sketch, id): a row for each tree. A key is the tree's number and DEPTH minima in the tree's order, big-endian, so that bytes sort
    like numbers; the sketch holds four bits of every minimum."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            low = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, MINIMA)
            four = (low & np.uint32(15)).astype(np.uint8)
            sketch = [x.tobytes() for x in four[:, 0::2] | four[:, 1::2] << 4]
            for tree in range(TREES):
                order = [(tree + TREES * i + (i // (MINIMA // TREES)) * 5) % MINIMA for i in range(DEPTH)]
                keys = np.empty((n, 1 + 4 * DEPTH), np.uint8)
                keys[:, 0] = tree
                keys[:, 1:] = np.ascontiguousarray(low[:, order].astype(">u4")).view(np.uint8).reshape(n, -1)
                yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(sketch, pa.binary()), batch.column(0)], ["key", "sketch", "id"])

    return nodes.select("id", "minima").mapInArrow(plant, "key binary, sketch binary, id long")


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    return ((x & 15) == 0).sum(axis=1) + ((x >> 4) == 0).sum(axis=1)


def _votes(sketch: np.ndarray) -> np.ndarray:
    """How often each of the 16 values comes at each of the 64 places, flat."""
    four = np.concatenate([sketch & 15, sketch >> 4], axis=1)
    return np.bincount((four + np.arange(MINIMA, dtype=np.int64) * 16).ravel(), minlength=16 * MINIMA)


def _centre(votes: np.ndarray) -> np.ndarray:
    """The sketch of the commonest values."""
    four = votes.reshape(MINIMA, 16).argmax(axis=1).astype(np.uint8)
    return four[: MINIMA // 2] | four[MINIMA // 2 :] << 4


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, MINIMA // 2)


def _pairs(keys: np.ndarray, sketch: np.ndarray, old: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates among neighbours in sorted order, of which the first ``old`` were seen with the rows before."""
    n = len(keys)
    for step in range(1, min(NEAR, n - 1) + 1):
        i = np.arange(max(0, old - step), n - step)
        i = i[(keys[i, :5] == keys[i + step, :5]).all(axis=1)]
        yield i, i + step, _agreement(sketch[i], sketch[i + step])


def _regions(keys: np.ndarray, old: int, depth: int) -> Iterator[tuple[int, int, bool]]:
    """(first, end, whole) of the regions of ``depth`` among the rows from ``old`` on that are crowded, or that may go on in another batch and so are
    not whole."""
    end = 1 + 4 * depth
    n = len(keys)
    cuts = np.flatnonzero((keys[old + 1 :, :end] != keys[old:-1, :end]).any(axis=1)) + old + 1
    first, last = np.concatenate([[old], cuts]), np.concatenate([cuts, [n]])
    whole = last < n
    whole[0] &= old > 0 and (keys[old - 1, :end] != keys[old, :end]).any()
    for k in np.flatnonzero(~whole | (last - first > NEAR + 1)):
        yield int(first[k]), int(last[k]), bool(whole[k])


def _spread(found: DataFrame) -> DataFrame:
    """(a, b, agree): every member of the regions that lie in several batches with the region's middle, which is chosen over the whole region."""

    def sum_up(group: pa.Table) -> pa.Table:
        votes = sum(np.frombuffer(x.as_buffer(), np.int64) for x in group.column("votes"))
        return pa.table({"region": group.column("region")[:1], "centre": pa.array([_centre(votes).tobytes()], pa.binary())})

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            agree = _agreement(_sketches(batch.column(2)), _sketches(batch.column(3)))
            order = np.lexsort((ids, agree, region))
            best = order[np.flatnonzero(np.append(region[order][1:] != region[order][:-1], True))] if len(order) else order
            yield pa.RecordBatch.from_arrays([pa.array(region[best]), pa.array(agree[best].astype(np.int32)), pa.array(ids[best]), batch.column(2).take(pa.array(best))], ["region", "agree", "id", "sketch"])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            agree = _agreement(_sketches(batch.column(1)), _sketches(batch.column(3)))
            ok = (agree >= AGREE) & (a != b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[ok]), pa.array(np.maximum(a, b)[ok]), pa.array(agree[ok].astype(np.int32))], ["a", "b", "agree"])

    members = found.filter("sketch IS NOT NULL").select("region", F.col("a").alias("id"), "sketch")
    centres = found.filter("votes IS NOT NULL").select("region", "votes").groupBy("region").applyInArrow(sum_up, "region long, centre binary")
    bests = members.join(centres, "region").select("region", "id", "sketch", "centre").mapInArrow(nearest, "region long, agree int, id long, sketch binary")
    middles = bests.groupBy("region").agg(F.max(F.struct("agree", "id", "sketch")).alias("m"))
    middles = written(middles.select("region", F.col("m.id").alias("middle"), F.col("m.sketch").alias("middle_sketch")), "middles")
    return members.join(middles, "region").select("id", "sketch", "middle", "middle_sketch").mapInArrow(close, "a long, b long, agree int")


def candidates(nodes: DataFrame) -> DataFrame:
    """(a, b, agree) of distinct sets that may overlap enough.

    Every tree is one sorted order, dealt out by ranges of the whole key and a hash of key and id, so equal keys don't gather in one task
    and are mixed anew by each tree. In an order, places close to each other have the longest common prefixes: how deep the
    comparison goes follows from how crowded the region is. Each place is paired with the NEAR ones behind it that share the
    tree's first minimum, and in crowded regions the middle document, whose sketch is nearest to the commonest values, with all
    of the region. Regions inside one batch are settled there; those that reach the edge of a batch are put together over all batches
    and partitions, their votes summed up per task.
    """
    names = ["region", "a", "b", "agree", "sketch", "votes"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sketch, ids = np.zeros((0, 1 + 4 * DEPTH), np.uint8), np.zeros((0, MINIMA // 2), np.uint8), np.zeros(0, np.int64)
        votes: dict[int, tuple[int, np.ndarray]] = {}  # of the last region that is not whole, by depth

        def paired(i: np.ndarray, j: np.ndarray, agree: np.ndarray) -> pa.RecordBatch:
            ok = agree >= AGREE
            a, b = ids[i[ok]], ids[j[ok]]
            return rows(len(a), a=np.minimum(a, b), b=np.maximum(a, b), agree=agree[ok].astype(np.int32))

        for batch in batches:
            if not batch.num_rows:
                continue
            old = len(ids)
            keys = np.concatenate([keys, np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, 1 + 4 * DEPTH)])
            sketch = np.concatenate([sketch, _sketches(batch.column(1))])
            ids = np.concatenate([ids, batch.column(2).to_numpy()])
            for found in _pairs(keys, sketch, old):
                yield paired(*found)
            for depth in MIDDLES:
                for first, end, whole in _regions(keys, old, depth):
                    own = _votes(sketch[first:end])
                    if whole:
                        middle = first + int(np.argmax(_agreement(sketch[first:end], _centre(own)[None, :])))
                        rest = np.delete(np.arange(first, end), middle - first)
                        yield paired(np.full(len(rest), middle), rest, _agreement(sketch[rest], sketch[[middle]]))
                        continue
                    region = int.from_bytes(hashlib.blake2b(keys[first, : 1 + 4 * depth].tobytes(), digest_size=8).digest(), "little", signed=True)
                    yield rows(end - first, region=np.full(end - first, region), a=ids[first:end], sketch=[x.tobytes() for x in sketch[first:end]])
                    before, so_far = votes.get(depth, (region, 0))
                    if before != region:
                        yield rows(1, region=[before], votes=[so_far.tobytes()])
                        so_far = 0
                    votes[depth] = region, so_far + own
            keys, sketch, ids = keys[-NEAR:], sketch[-NEAR:], ids[-NEAR:]
        for region, so_far in votes.values():
            yield rows(1, region=[region], votes=[so_far.tobytes()])

    turn = F.xxhash64("key", "id")
    order = _places(nodes).repartitionByRange("key", turn).sortWithinPartitions("key", turn)
    found = written(order.mapInArrow(neighbours, "region long, a long, b long, agree int, sketch binary, votes binary"), "neighbours")
    pairs = found.filter("b IS NOT NULL").select("a", "b", "agree").union(_spread(found))
    return pairs.groupBy("a", "b").agg(F.max("agree").alias("agree"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets overlap by ``percent``."""

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = sorted((len(s), len(t)))
                both = len(s) + len(t) - len(np.union1d(s, t)) if 100 * small >= percent * large else 0
                ok.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(overlap, "a long, b long")


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(id, shingles) of nodes, from the whole texts of the rows that stand for them."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(1).to_pylist(), width, powers)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    rows = docs.select("locator", utf8().alias("text")).join(nodes.select("id", F.col("first.locator").alias("locator")), "locator")
    return rows.select("id", "text").mapInArrow(make, "id long, shingles binary")


def _joined(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, root) of the nodes that are linked to others, by confirmed links.

    Only components count, so links are confirmed in rounds: each component takes up its closest candidates outside, 4, then 16, 64 and so on of
    them, the links found are contracted, and candidates inside one component are settled. It ends when every candidate is either
    confirmed, refuted or inside a component.
    """
    open_pairs = written(candidates(nodes), "candidates")
    roots = None
    if open_pairs.isEmpty():
        return nodes.select("id", F.col("id").alias("root")).limit(0)
    near = open_pairs.select(F.col("a").alias("id")).union(open_pairs.select("b")).distinct()
    sets = written(_sets(docs, nodes.join(near, "id"), width), "sets")
    open_pairs = open_pairs.select("a", "b", "agree", F.col("a").alias("ra"), F.col("b").alias("rb"))
    picks_each = 4
    while True:
        best = F.max(F.struct("agree", "a", "b")).alias("best")
        salted = open_pairs.withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.lit(picks_each)))
        picked = salted.select(F.col("ra").alias("r"), "salt", "agree", "a", "b").union(salted.select("rb", "salt", "agree", "a", "b")).groupBy("r", "salt").agg(best)
        picked = written(picked.select("best.a", "best.b").distinct(), "picked")
        links = written(_confirmed(picked, sets, percent), "links")
        rest = open_pairs.join(picked, ["a", "b"], "left_anti")
        by_root = open_pairs.select("a", "b", "ra", "rb").join(links, ["a", "b"]).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        merged = components(by_root)
        to_a = merged.select(F.col("id").alias("ra"), F.col("root").alias("na"))
        to_b = merged.select(F.col("id").alias("rb"), F.col("root").alias("nb"))
        moved = rest.join(to_a, "ra", "left").join(to_b, "rb", "left")
        moved = moved.select("a", "b", "agree", F.coalesce("na", "ra").alias("ra"), F.coalesce("nb", "rb").alias("rb"))
        open_pairs = written(moved.filter("ra != rb"), "open")
        if roots is None:
            roots = merged
        else:
            newer = merged.select(F.col("id").alias("root"), F.col("root").alias("newer"))
            kept = roots.join(newer, "root", "left").select("id", F.coalesce("newer", "root").alias("root"))
            roots = written(kept.union(merged), "roots")
        if open_pairs.isEmpty():
            return roots
        picks_each *= 4


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, locator, n_shingles, keeper) for every row of ``docs``, which must have ``locator``; keeper is the smallest
    (doc_id, locator) of its component, NULL ids last."""
    rows = written(signed(docs, width), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "locator")
    nodes = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min(order).alias("first"), F.first("minima").alias("minima"))
    nodes = written(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    roots = _joined(nodes, docs, width, percent)
    firsts = nodes.select("digest", "id", "first").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    keepers = firsts.groupBy("root").agg(F.min("first").alias("keeper"))
    known = firsts.select("digest", "root").join(keepers, "root").select("digest", "keeper")
    joined = rows.select("doc_id", "locator", "n_shingles", "digest", order.alias("own")).join(known, "digest", "left")
    return joined.select("doc_id", "locator", "n_shingles", F.coalesce("keeper", "own").alias("keeper"))


def near_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows with equal sets are one node from the start, however many they are. Texts without words have an empty set, are linked with
    nothing and stand for themselves. component_id is NULL only where no row of the component has an id; such rows aren't kept
    here. Rows that repeat an id each have their own set.
    """
    rows = _grouped(located(docs.select("doc_id", "text")), width, percent)
    kept = F.coalesce(F.col("doc_id") == F.col("keeper.doc_id"), F.lit(False))
    return rows.select("doc_id", "n_shingles", F.col("keeper.doc_id").alias("component_id"), kept.alias("kept"))


def without_near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns."""
    placed = located(docs)
    gone = _grouped(placed, width, percent).filter(F.col("locator") != F.col("keeper.locator")).select("locator")
    return restored(placed.join(gone, "locator", "left_anti"), docs.columns)
