"""Removal of byte strings that an earlier document has, by sorted suffixes and a Burrows-Wheeler transform in shards of candidate passages.

Every string of ``LENGTH`` bytes has one anchor, the smallest of the hashes of the grams in it, and equal strings have equal anchors. So strings are
grouped by the runs of places that share an anchor; the passage of a run is what its strings cover. Anchors meet in shards by hash:

1. each batch of documents sends 8 bytes for every run: which anchors come more than once, and which of those with different passages;
2. for anchors that come more than once, passages that agree as a whole are joined by their hash, the others are sent as bytes, and the shard
   finds equal strings among them in a Burrows-Wheeler transform; anchors with very many different passages send the hash of each string
   instead, to the shard of that hash;
3. shards answer blocks of documents with the smallest id that has each string, and blocks remove what a smaller id has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from vitalsieve.llm.common import free_shuffles, located, utf8, written
from vitalsieve.llm.shingles import Powers, mixed

LENGTH, GRAM = 50, 20
#: Bytes of text for each shard, rows of a block, bits of each of the three maps that are broadcast, at most (32 MB each).
SHARD_BYTES, BLOCK_ROWS, MAP_BITS = 1 << 22, 512, 1 << 28
#: Shards from which on they grow to four times their bytes before there are more: each block writes to each shard.
_FEW = 1 << 8
#: Bytes whose anchors are taken at once, bytes of passages that are compared at once, and that one transform holds.
_PART, _COMPARED, _TRANSFORM = 1 << 16, 1 << 21, 1 << 18
#: Different passages from which on an anchor is hot: its strings then go to shards by their own hashes, without their bytes.
HOT = 1 << 10
#: Between passages; no UTF-8 text has this byte.
_END = 0xFF
_NO_ID = (1 << 63) - 1
_VALUE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(0x7654321))
_POWERS = Powers()


@dataclass
class Runs:
    """Runs of strings with one anchor: text, first and last string's place in it, hash of the anchor, hash of the passage, the anchor's place."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    passage: np.ndarray
    place: np.ndarray


def _runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs in ``data``, some texts behind one another that end at ``ends``: (text, first, last, anchor, passage, place), places in ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:-1], out=total[1:])
    grams = mixed((total[gram:] - total[:-gram]) * down[: len(data) - gram + 1])
    place = np.uint64((1 << 24) - 1)
    low = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)  # ties go to the first place, in every document alike
    width, wide = length - gram + 1, 1
    while 2 * wide <= width:
        low = np.minimum(low[:-wide], low[wide:])
        wide *= 2
    low = np.minimum(low[: len(data) - length + 1], low[width - wide :][: len(data) - length + 1])
    at = np.arange(len(low))
    text = np.searchsorted(ends, at, side="right")
    inside = at + length <= ends[np.minimum(text, len(ends) - 1)]
    at, text, anchor = at[inside], text[inside], (low[inside] & place).astype(np.int64)
    if not len(at):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    first, last = at[new], at[np.concatenate([new[1:] - 1, [len(at) - 1]])]
    shape = ((last - first).astype(np.uint64) << np.uint64(8)) + (anchor[new] - first).astype(np.uint64)
    passage = mixed((total[last + length] - total[first]) * down[first] + mixed(shape + np.uint64(1)))
    # A smallest hash is a small number: spread it again, or the first shards get most of the anchors.
    return text[new], first, last, mixed(grams[anchor[new]] + np.uint64(1)), passage, anchor[new]


def runs_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Runs:
    """Runs of whole texts. Long texts are taken in parts that overlap, so that each string is in one part whole."""
    found: list[tuple[np.ndarray, ...]] = []
    pending: list[tuple[int, int, bytes]] = []

    def flush() -> None:
        ends = np.cumsum([len(t) for _, _, t in pending])
        text, first, last, anchor, passage, place = _runs(np.frombuffer(b"".join(t for _, _, t in pending), np.uint8), ends, length, gram)
        shift = np.array([s - (e - len(t)) for (_, s, t), e in zip(pending, ends, strict=True)], np.int64)
        which = np.array([d for d, _, _ in pending], np.int64)
        found.append((which[text], first + shift[text], last + shift[text], anchor, passage, place + shift[text]))
        pending.clear()

    size = 0
    for doc, text in enumerate(texts):
        for start in range(0, max(1, len(text) - length + 1), _PART):
            part = text[start : start + _PART + length - 1]
            if pending and size + len(part) > 2 * _PART:
                flush()
                size = 0
            pending.append((doc, start, part))
            size += len(part)
    if pending:
        flush()
    if not found:
        return Runs(*[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 2, np.zeros(0, np.int64))
    return Runs(*[np.concatenate(x) for x in zip(*found, strict=True)])


def _opened(r: Runs, hot: np.ndarray, texts: list[bytes], length: int) -> Runs:
    """The runs but the hot ones, then each string of those as a run of its own, whose anchor is a hash of the whole string."""
    some = np.flatnonzero(hot)
    kept = [x[~hot] for x in (r.doc, r.first, r.last, r.anchor, r.passage, r.place)]
    if not len(some):
        return Runs(*kept)
    data = np.frombuffer(b"".join(texts[d][f : e + length] for d, f, e in zip(r.doc[some], r.first[some], r.last[some], strict=True)), np.uint8)
    counts = r.last[some] - r.first[some] + 1
    run = np.repeat(np.arange(len(some)), counts)
    within = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = within + np.repeat(np.cumsum(counts + length - 1) - (counts + length - 1), counts)
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:-1], out=total[1:])
    string = mixed((total[at + length] - total[at]) * down[at] + np.uint64(0x51A7))
    first = r.first[some][run] + within
    strings = (r.doc[some][run], first, first, mixed(string + np.uint64(1)), string, first)
    return Runs(*[np.concatenate(x) for x in zip(kept, strings, strict=True)])


def _packed(records: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Records behind one another as binary values of so many records each."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * records.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(records.tobytes())])


def _unpacked(column: pa.ChunkedArray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(records, counts): the records of all values of a column, and how many each value has."""
    kind, parts, counts = np.dtype(kind), [np.zeros(0, kind)], [np.zeros(0, np.int64)]
    for x in column.chunks:
        offsets = np.frombuffer(x.buffers()[1], np.int64 if pa.types.is_large_binary(x.type) else np.int32)[x.offset : x.offset + len(x) + 1].astype(np.int64) if len(x) else np.zeros(1, np.int64)
        counts.append(np.diff(offsets) // kind.itemsize)
        if offsets[-1] > offsets[0]:
            parts.append(np.frombuffer(x.buffers()[2], kind, (offsets[-1] - offsets[0]) // kind.itemsize, offsets[0]))
    return np.concatenate(parts), np.concatenate(counts)


def _shards(total: int) -> int:
    """Shards of so many bytes of text, a power of two."""
    of = lambda size: 1 << (total // size).bit_length()
    return of(SHARD_BYTES) if of(SHARD_BYTES) <= _FEW else max(_FEW, of(4 * SHARD_BYTES))


def _shard(anchor: np.ndarray, shards: int) -> np.ndarray:
    return (anchor >> np.uint64(64 - shards.bit_length() + 1)).astype(np.int64) if shards > 1 else np.zeros(len(anchor), np.int64)


def _flags(bitmap: bytes, anchor: np.ndarray, shards: int, bits: int) -> np.ndarray:
    each = bits // shards
    bit = _shard(anchor, shards) * each + ((anchor << np.uint64(shards.bit_length() - 1) >> np.uint64(32)) * np.uint64(each) >> np.uint64(32)).astype(np.int64)
    return ((np.frombuffer(bitmap, np.uint8)[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(bool)


def suffixes(text: np.ndarray, upto: int) -> np.ndarray:
    """Places of ``text`` sorted by the ``upto`` bytes from there, by doubling."""
    n = len(text)
    rank = np.zeros(n, np.int64)
    for i in range(4):  # the first four bytes as one number
        rank[: max(0, n - i)] += (text[i:].astype(np.int64) + 1) * 257 ** (3 - i)
    wide = 4
    order = np.argsort(rank)
    ranked = rank[order]
    rank[order] = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]]))
    while wide < upto:
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - wide)] = rank[wide:]
        key = rank * (n + 1) + behind
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]]))
        wide *= 2
    return order


def equal_strings(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): places in suffix order, and where in it a new string of ``length`` bytes starts.

    Breadth-first over intervals of the Burrows-Wheeler transform: the intervals of all strings of one size are extended backward by each byte
    that stands before them, which gives those of the next size. The end of an interval reached for the first time is a place whose
    common prefix with the one before has that size; so common prefixes come by increasing value, and the search stops at
    ``length``. What has no value then has at least ``length`` bytes in common.
    """
    n = len(text)
    order = suffixes(text, length).astype(np.int32)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    before = order - 1  # the place before the first is the last
    byte, back = text[before], place[before]
    del place, before
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.zeros(1, np.int64), np.full(1, n)
    for _ in range(length):
        if not len(low):
            break
        sizes = high - low
        rows = np.arange(sizes.sum(), dtype=np.int32) + np.repeat((low - np.cumsum(sizes) + sizes).astype(np.int32), sizes)
        key = np.repeat(np.arange(len(low), dtype=np.int64) << 8, sizes) | byte[rows]
        by = np.argsort(key, kind="stable")
        key = key[by]
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        reached = back[rows[by]]
        first, end = np.minimum.reduceat(reached, cut).astype(np.int64), np.maximum.reduceat(reached, cut).astype(np.int64) + 1
        new = ~known[end] | ((end == n) & (first > 0) & ~known[first])
        known[end] = True
        low, high = first[new], end[new]
    return order, np.flatnonzero(known[:n])


def smallest_holders(passages: list[bytes], ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, place, id) for each string of ``length`` bytes, in order: the smallest id of all passages that hold the string."""
    sizes = np.array([len(p) for p in passages])
    text = np.frombuffer(bytes([_END]).join([*passages, b""]), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(passages)), sizes + 1)
    order, cuts = equal_strings(text, length)
    place = np.arange(len(text)) - starts[owner]
    whole = place + length <= sizes[owner]
    value = np.where(whole[order], ids[owner[order]], _NO_ID)
    least = np.empty(len(text), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(value, cuts), np.diff(np.append(cuts, len(text))))
    return owner[whole], place[whole], least[whole]


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(_NO_ID))


def _blocks(docs: DataFrame) -> DataFrame:
    """(file, block, row, key, text): blocks are neighbouring rows of a file, so a scan meets each block once or twice."""
    row = F.col("locator.row")
    return docs.select(F.col("locator.file").alias("file"), F.floor(row / BLOCK_ROWS).alias("block"), row.alias("row"), _key(F.col("doc_id")).alias("key"), utf8().alias("text"))


def _maps(docs: DataFrame, shards: int, bits: int, length: int, hot: int) -> tuple[bytes, bytes, bytes]:
    """Bit maps over hashes of anchors: those that may come more than once, of them those that may have different passages, and of these
    those that have ``hot`` different ones or more.

    A map has a fixed size whatever the corpus holds; where hashes meet in a bit, more is looked at than need be. Each shard makes its own
    part of the maps.
    """
    shift = np.uint64(64 - shards.bit_length() + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(i, 2 * BLOCK_ROWS) for batch in batches for i in range(0, batch.num_rows, 2 * BLOCK_ROWS)):
            r = runs_of(part.column(0).to_pylist(), length)
            if not len(r.doc):
                continue
            shard = (r.anchor >> shift).astype(np.int64) if shards > 1 else np.zeros(len(r.anchor), np.int64)
            entry = (r.anchor << np.uint64(shards.bit_length() - 1) >> np.uint64(32) << np.uint64(32)) | (r.passage >> np.uint64(32))
            order = np.lexsort((r.doc, entry, shard))
            shard, entry, doc = shard[order], entry[order], r.doc[order]
            same = np.concatenate([[False], (shard[1:] == shard[:-1]) & (entry[1:] == entry[:-1])])
            keep = ~same | np.concatenate([[False], doc[1:] != doc[:-1]])
            shard, entry = shard[keep], entry[keep]
            third = np.zeros(len(entry), bool)
            third[2:] = (shard[2:] == shard[:-2]) & (entry[2:] == entry[:-2])  # two of a kind say that it comes again
            shard, entry = shard[~third], entry[~third]
            names, counts = np.unique(shard, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), _packed(entry, counts)], ["shard", "entries"])

    each = bits // shards

    def count(group: pa.Table) -> pa.Table:
        entries = np.sort(_unpacked(group.column("entries"), np.uint64)[0])
        anchor = entries >> np.uint64(32)
        again, other = anchor[1:] == anchor[:-1], entries[1:] != entries[:-1]
        out = []
        different, count_of = np.unique(anchor[np.append(True, other)], return_counts=True)
        for hit in (anchor[1:][again], anchor[1:][again & other], different[count_of >= hot]):
            flags = np.zeros(each, bool)
            flags[(hit * np.uint64(each) >> np.uint64(32)).astype(np.int64)] = True
            out.append(np.packbits(flags).tobytes())
        return pa.table({"shard": group.column("shard")[:1], **{n: pa.array([x], pa.binary()) for n, x in zip(("again", "other", "hot"), out, strict=True)}})

    sent = docs.select(utf8().alias("text")).mapInArrow(send, "shard long, entries binary")
    made = {r["shard"]: r for r in sent.groupBy("shard").applyInArrow(count, "shard long, again binary, other binary, hot binary").collect()}
    empty = bytes(each // 8)
    return tuple(b"".join(bytes(made[s][k]) if s in made else empty for s in range(shards)) for k in ("again", "other", "hot"))


def _asked(docs: DataFrame, maps: Broadcast, shards: int, bits: int, length: int) -> DataFrame:
    """(shard, file, block, single, multi, texts): what each block asks each shard. Passages of anchors with others go with their bytes, those of
    hot anchors as the hashes of their strings, which are dealt to all shards."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again, other, hot = maps.value
        for batch in batches:
            files, blocks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])]))
            for a, b in zip(cuts, np.append(cuts[1:], len(files)), strict=True):
                texts, keys = batch.column(4)[a:b].to_pylist(), batch.column(3)[a:b].to_numpy()
                r = runs_of(texts, length)
                hit = _flags(again, r.anchor, shards, bits)
                r = Runs(*[x[hit] for x in (r.doc, r.first, r.last, r.anchor, r.passage, r.place)])
                opened = _flags(hot, r.anchor, shards, bits)
                differs = _flags(other, r.anchor, shards, bits)[~opened]
                r = _opened(r, opened, texts, length)
                differs = np.append(differs, np.zeros(len(r.doc) - len(differs), bool))
                shard = _shard(r.anchor, shards)
                order = np.lexsort((keys[r.doc], r.passage))
                if not len(order):
                    continue
                passage, key = r.passage[order], keys[r.doc[order]]
                head = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
                tail = np.append(head[1:], len(order)) - 1
                several = key[head] != key[tail]
                by = np.lexsort((differs[order[head]], shard[order[head]]))  # by shard, so that a block's work does not grow with their number
                own = order[head][by]
                entries, multi = np.empty(len(by), _ENTRY), differs[own]
                for name, x in zip(_ENTRY.names, (passage[head][by], key[head][by], several[by], (r.last - r.first)[own]), strict=True):
                    entries[name] = x
                names, shard_of = np.unique(shard[own], return_inverse=True)
                ones, many = (np.bincount(shard_of[x], minlength=len(names)) for x in (~multi, multi))
                passages = pa.array([texts[d][f : e + length] for d, f, e in zip(r.doc[own[multi]], r.first[own[multi]], r.last[own[multi]], strict=True)], pa.binary())
                columns = {
                    "shard": pa.array(names, pa.int64()), "file": pa.array(np.full(len(names), files[a]), pa.int64()), "block": pa.array(np.full(len(names), blocks[a]), pa.int64()),
                    "single": _packed(entries[~multi], ones), "multi": _packed(entries[multi], many),
                    "texts": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), passages),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return _blocks(docs).select("file", "block", "row", "key", "text").mapInArrow(ask, "shard long, file long, block long, single binary, multi binary, texts array<binary>")


def _answers(docs: DataFrame, maps: Broadcast, shards: int, bits: int, length: int) -> DataFrame:
    """(file, block, data): for passages of each block, the smallest id that holds each of their strings, where a smaller one than the block's
    own may exist. ``data`` packs (passage hash, first string, last string, id)."""

    def answer(group: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []  # (row of the group, passage, first, last, id)
        for kind in ("single", "multi"):
            e, counts = _unpacked(group.column(kind), _ENTRY)
            row = np.repeat(np.arange(len(counts)), counts)
            if not len(e):
                continue
            order = np.argsort(e["passage"], kind="stable")
            head = np.flatnonzero(np.concatenate([[True], e["passage"][order][1:] != e["passage"][order][:-1]]))
            number = np.empty(len(e), np.int64)
            number[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(e))))
            least = np.minimum.reduceat(e["id"][order], head)
            wanted = (least[number] < e["id"]) | e["several"]
            if kind == "single":
                found.append((row[wanted], e["passage"][wanted], np.zeros(wanted.sum(), np.int64), e["more"][wanted].astype(np.int64), least[number][wanted]))
                continue
            flat = group.column("texts").combine_chunks().flatten()
            passages = flat.take(pa.array(order[head])).to_pylist()
            first, last, ids, of = _by_strings(passages, least, length)
            begin = np.searchsorted(of, np.arange(len(passages) + 1))
            counts = (begin[1:] - begin[:-1])[number]
            entry = np.repeat(np.arange(len(e)), counts)
            at = np.arange(len(entry)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[number[entry]]
            use = (ids[at] < e["id"][entry]) | e["several"][entry]
            entry, at = entry[use], at[use]
            found.append((row[entry], e["passage"][entry], first[at], last[at], ids[at]))
        row, passage, first, last, ids = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 5
        data = np.rec.fromarrays([passage, first, last, ids], dtype=_ANSWER)[np.argsort(row, kind="stable")]
        counts = np.bincount(row, minlength=len(group))
        some = np.flatnonzero(counts)
        return pa.table({"file": group.column("file").take(pa.array(some)), "block": group.column("block").take(pa.array(some)), "data": _packed(data, counts[some])})

    return _asked(docs, maps, shards, bits, length).groupBy("shard").applyInArrow(answer, "file long, block long, data binary")


_ENTRY = np.dtype([("passage", np.uint64), ("id", np.int64), ("several", np.bool_), ("more", np.uint8)])
_ANSWER = np.dtype([("passage", np.uint64), ("first", np.uint8), ("last", np.uint8), ("id", np.int64)])


def _by_strings(passages: list[bytes], ids: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first, last, id, passage): runs of strings in each passage with one smallest holder.

    Passages with equal strings have equal anchors, so they are dealt to transforms of bounded size by the gram they share. A single anchor
    with more than that is one transform; it has fewer than HOT passages, the others are opened before.
    """
    r = runs_of(passages, length)  # a passage is one run
    anchors = r.anchor.tolist()
    sorted_, sizes = np.argsort(r.anchor, kind="stable"), np.array([len(p) for p in passages])
    new = np.flatnonzero(np.concatenate([[True], r.anchor[sorted_][1:] != r.anchor[sorted_][:-1]]))
    lot = (np.cumsum(sizes[sorted_]) - sizes[sorted_])[new] // _COMPARED  # whole anchors are compared at once, as many as have so many bytes
    near = np.zeros(len(passages), bool)
    for some in np.split(sorted_, new[1:][lot[1:] != lot[:-1]]):
        near[some] = _akin([passages[i] for i in some], r.place[some], length)
    order = sorted_[near[sorted_]].tolist()
    out: list[np.ndarray] = []
    group, size = [], 0
    for i in order:
        if size > _TRANSFORM and anchors[i] != anchors[group[-1]]:
            out.append(_transformed(group, passages, ids, length))
            group, size = [], 0
        group.append(i)
        size += len(passages[i]) + 1
    if group:
        out.append(_transformed(group, passages, ids, length))
    alone = np.flatnonzero(~near)
    out.append(np.column_stack([alone, np.zeros(len(alone), np.int64), np.array([len(passages[i]) - length for i in alone], np.int64), ids[alone]]))
    table = np.concatenate(out)
    table = table[np.argsort(table[:, 0], kind="stable")]
    return table[:, 1], table[:, 2], table[:, 3], table[:, 0]


def _akin(passages: list[bytes], place: np.ndarray, length: int) -> np.ndarray:
    """Passages that may share a string with another: a common string holds the gram and at least half of the other bytes on one side of
    it, so two passages without an equal half on either side have none in common."""
    sizes = np.array([len(p) for p in passages])
    data = np.frombuffer(b"".join(passages), np.uint8)
    starts = np.cumsum(sizes) - sizes
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:-1], out=total[1:])
    half = (length - GRAM) // 2
    near = np.zeros(len(passages), bool)
    for low, high in ((place - half, place + GRAM), (place, place + GRAM + half)):
        some = np.flatnonzero((low >= 0) & (high <= sizes))
        a, b = starts[some] + low[some], starts[some] + high[some]
        key = (total[b] - total[a]) * down[a]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        near[some] |= count[which] > 1
    return near


def _transformed(group: list[int], passages: list[bytes], ids: np.ndarray, length: int) -> np.ndarray:
    """Rows (passage, first, last, id) of one transform."""
    owner, place, least = smallest_holders([passages[i] for i in group], ids[group], length)
    head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])]))
    tail = np.append(head[1:], len(owner)) - 1
    return np.column_stack([np.array(group)[owner[head]], place[head], place[tail], least[head]])


def _removed(known: np.ndarray, texts: list[bytes], keys: np.ndarray, length: int, hot: bytes, shards: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the maximal runs that go, in order, by the answers sorted by passage."""
    r = runs_of(texts, length)
    r = _opened(r, _flags(hot, r.anchor, shards, bits), texts, length)
    low, high = np.searchsorted(known["passage"], r.passage, side="left"), np.searchsorted(known["passage"], r.passage, side="right")
    run = np.repeat(np.arange(len(low)), high - low)
    answer = known[np.arange(len(run)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[run]]
    doc, first = r.doc[run], r.first[run]
    less = answer["id"] < keys[doc]
    doc, start, end = doc[less], (first + answer["first"])[less], (first + answer["last"])[less] + length
    base = np.cumsum([0] + [len(t) + 1 for t in texts])  # texts side by side with a gap, so that no run reaches into the next
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order] + base[doc[order]], end[order] + base[doc[order]]
    reach = np.maximum.accumulate(end) if len(end) else end
    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]])) if len(end) else np.zeros(0, np.int64)
    doc, start, end = doc[new], start[new], reach[np.append(new[1:] - 1, len(end) - 1)] if len(new) else end
    return doc, start - base[doc], end - base[doc]


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row: ``kept`` is the text without each byte that is covered by a string of ``length``
    bytes which also starts in a document with a smaller id.

    NULL texts are empty; a NULL id is larger than any other and equal to another NULL. Rows that share an id take nothing from each other. Strings
    are judged on the input. Texts of fewer than ``length`` bytes stay as they are.
    """
    placed = located(docs.select("doc_id", "text"))
    total = placed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = _shards(total)
    bits = min(MAP_BITS, max(1 << 16, 1 << int(total).bit_length()))
    shards = min(shards, bits // 8)
    spark = docs.sparkSession
    maps = spark.sparkContext.broadcast(_maps(placed, shards, bits, length, hot))
    free_shuffles(spark)  # of the runs: the passages take as much disk again
    answers = written(_answers(placed, maps, shards, bits, length), "answers")
    free_shuffles(spark)

    def clean(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        known = _unpacked(right.column("data"), _ANSWER)[0]
        known = known[np.argsort(known["passage"], kind="stable")]
        counts, kept = [[], [], []], []
        texts, keys = left.column("text").to_pylist(), left.column("key").to_numpy()
        doc, start, end = _removed(known, texts, keys, length, maps.value[2], shards, bits)
        cut = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i, text in enumerate(texts):
            spans = [(int(a), int(b)) for a, b in zip(start[cut[i] : cut[i + 1]], end[cut[i] : cut[i + 1]], strict=True)]
            edges = [0, *(x for span in spans for x in span), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            for column, x in zip(counts, (len(text), len(text) - len(kept[-1]), len(spans)), strict=True):
                column.append(x)
        return pa.table({"key": left.column("key"), **{n: pa.array(c, pa.int64()) for n, c in zip(("n_bytes", "n_removed", "n_spans"), counts, strict=True)}, "kept": pa.array(kept, pa.binary())})

    left = _blocks(placed).groupBy("file", "block")
    out = left.cogroup(answers.groupBy("file", "block")).applyInArrow(clean, "key long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.nullif(F.col("key"), F.lit(_NO_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``without_repeats`` with the hash of what is left in place of the bytes."""
    rows = without_repeats(docs, length)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
