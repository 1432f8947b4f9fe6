"""Token counts and ids by a public tokenizer, looked up word by word inside the tasks. No word is ever shuffled.

A text is cut at ASCII white space. The tokenizer drops white space and never lets a token reach across it, so the ids of a text
are the ids of its words in order, and each distinct word needs the tokenizer once. Two tiers hold the answers: a broadcast
table of frequent words, and what the worker has met since.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from vitalsieve.llm.common import utf8

#: Entries of the broadcast table (under 4 MB), and words of each of the two generations a worker remembers beside it (about 50 MB each).
FREQUENT = 65_536
REMEMBERED = 250_000
MAX_TOKENS = 2048


#: Letters whose case and composition need no library, single digits, and runs of marks; an apostrophe may start a contraction.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~]+")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: How byte-level vocabularies write each byte: printable Latin-1 as itself, the others from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = {b: chr(b) for b in _PRINTED} | {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}


def _encoded(tokenizer: Tokenizer, words: list[bytes]) -> Iterator[list[int]]:
    texts = [w.decode("utf-8", "replace") for w in words]
    return (e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False))


def frequent_words(tokenizer: Tokenizer, most: int = FREQUENT, make: Callable = len) -> dict:
    """What ``make`` says of the ids of words that the vocabulary itself holds whole, the most frequent first, also with a mark behind.

    The order of a byte-pair vocabulary is the order of its merges, so low ids are the frequent words of the text it was made
    from. The size is bounded by ``most`` whatever the corpus holds.
    """
    whole = sorted((i, w[:-4]) for w, i in tokenizer.get_vocab().items() if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalnum())
    words = [x.encode() for _, w in whole[: most // 3] for x in (w, w + ",", w + ".")]
    return dict(zip(words, map(make, _encoded(tokenizer, words)), strict=True))


class WordTable:
    """Word -> what the tokenizer makes of it. ``first`` stays; the rest is bounded by two generations of ``most`` words.

    When the young generation is full, it becomes the old one and the older one goes; old words that come again move over. Entries must add up: the
    entry of two neighbouring pieces is the sum (of counts) or the concatenation (of id bytes).
    """

    def __init__(self, tokenizer: Tokenizer, make: Callable, first: dict = {}, most: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        self.tokenizer, self.make, self.first, self.most = tokenizer, make, first, most
        self.young, self.old = dict(first), {}

    def all(self, words: list[bytes]) -> list:
        """One entry per word."""
        entries = list(map(self.young.get, words))
        missing = [i for i, entry in enumerate(entries) if entry is None]
        if missing:
            if len(self.young) > len(self.first) + self.most:
                self.young, self.old = dict(self.first), self.young
            young, old = self.young, self.old
            new = {words[i] for i in missing}
            again = [w for w in new if w in old]
            for w in again:
                young[w] = old[w]
            self._learn(new.difference(again))
            for i in missing:
                entries[i] = young[words[i]]
        return entries

    def _piece(self, piece: bytes) -> object:
        """Entry of a piece that the tokenizer does not cut further."""
        table = self.young
        if (entry := table.get(piece)) is None:
            shown = piece.decode() if piece.isalnum() else "".join(map(_SHOWN.__getitem__, piece))
            entry = table[piece] = self.make([t.id for t in self.tokenizer.model.tokenize(shown)])
        return entry

    def _learn(self, new: set[bytes]) -> None:
        """Words of plain letters, digits and marks are cut as the tokenizer cuts them, so that each of their pieces is merged once; other
        words go through the whole tokenizer."""
        table, piece, hard = self.young, self._piece, []
        for w in new:
            if w.isalpha() and w.islower():
                piece(w)
                continue
            text = w.decode("utf-8", "replace")
            if _PLAIN.fullmatch(text) and "<|" not in text:
                entries = [piece(x.encode()) for x in _PIECE.findall(text.lower())]
                entry = entries[0]
                for more in entries[1:]:
                    entry = entry + more
                table[w] = entry
            else:
                hard.append(w)
        table.update(zip(hard, map(self.make, _encoded(self.tokenizer, hard)), strict=True))


#: The table of this worker process, under what it was made from; later tasks of the process go on with it.
_HELD: dict[tuple, WordTable] = {}


def worker_table(model: str, make: Callable, first: dict) -> WordTable:
    """A table for the tokenizer text ``model``, kept between tasks. Another tokenizer or ``make`` replaces it, so a worker holds one."""
    key = (model, make, len(first))
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = WordTable(Tokenizer.from_str(model), make, first)
    return _HELD[key]


def words_of(text: bytes) -> list[bytes]:
    """Words for the lookup. The tokenizer lower-cases, so ASCII capitals go first; special strings keep the case they have."""
    return (text if b"<|" in text else text.lower()).split()


def tokenizer_text(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's file, read by the driver and sent to the executors; its size is that of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def blocks_of(words: list[bytes], size: int = 1 << 16) -> Iterable[list[bytes]]:
    """Very long texts in blocks, so that a lookup never holds more than one block's answers."""
    return [words] if len(words) <= size else (words[i : i + size] for i in range(0, len(words), size))


def token_counts(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``, over whole texts.

    NULL and empty texts have no bytes and no tokens. Repeated rows are counted each. Other columns are not read.
    """
    spark = docs.sparkSession
    model = tokenizer_text(spark, tokenizer_path)
    first = spark.sparkContext.broadcast(frequent_words(Tokenizer.from_str(model.value), frequent))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_table(model.value, len, first.value)
        for batch in batches:
            sizes, counts = [], []
            for value in batch.column(1):
                text = value.as_py()
                sizes.append(len(text))
                counts.append(sum(sum(words.all(block)) for block in blocks_of(words_of(text))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > max_tokens)


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def document_ids(text: bytes, table: WordTable, end: bytes) -> bytes:
    """Ids of a whole document and the closing id, as bytes. ``table`` makes ``id_bytes``."""
    return b"".join(chain(chain.from_iterable(table.all(block) for block in blocks_of(words_of(text))), (end,)))
