"""Quality rules: counts of one document, and lines that too many documents of a host share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitalsieve.llm.common import located, utf8, written
from vitalsieve.llm.shingles import mixed

#: A line goes if it is in more than LINE_DOCS different documents of its host, or in more than LINE_SHARE of them and in LINE_LEAST at least.
LINE_DOCS, LINE_SHARE, LINE_LEAST = 20, 0.1, 3
#: A document goes if fewer than this share of its words are left.
LEAST_LEFT = 0.3
LEAST_WORDS, MOST_REPEATED = 10, 20
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside a run of ``width`` words that occurs at two or more places."""
    if len(words) <= width:
        return 0
    index: dict[bytes, int] = {}
    ids = mixed(np.array([index.setdefault(w, len(index)) for w in words], np.uint64) + np.uint64(1))
    runs = np.zeros(len(ids) - width + 1, np.uint64)
    for i in range(width):
        runs = (runs + ids[i : i + len(runs)]) * np.uint64(0xD6E8FEB86659FD93)
    order = np.sort(runs)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(runs, twice))
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def _line_key(line: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(line.lower().split()), digest_size=8).digest(), "little", signed=True)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, locator, host, digest, the counts, lines) of every row; lines are the hashes of the document's different normalised
    lines with the words they hold. ``docs`` must have ``locator``."""
    names = ["doc_id", "locator", "host", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"]
    line = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, counts, lines = [], [[], [], [], [], []], []
            for value in batch.column(3):
                text = value.as_py()
                words = text.split()
                seen: set[bytes] = set()
                again, own = 0, {}
                for part in text.split(b"\n"):
                    n = len(part.split())
                    if n:
                        again += part in seen
                        seen.add(part)
                        key = _line_key(part)
                        own[key] = own.get(key, 0) + n
                digests.append(hashlib.blake2b(text, digest_size=16).digest())
                lines.append([{"line": k, "words": n} for k, n in own.items()])
                symbols = len(text) - len(text.translate(None, _SYMBOLS))
                for column, x in zip(counts, (len(words), len(b"".join(words).decode("utf-8", "replace")), symbols, again, repeated_words(words)), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(digests, pa.binary()), *(pa.array(c, pa.int64()) for c in counts), pa.array(lines, line)], names)

    host = F.when(F.col("source").isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), F.col("source")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "locator", host.alias("host"), utf8().alias("text"))
    return rows.mapInArrow(measure, (
        "doc_id long, locator struct<file:long,row:long>, host string, digest binary, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        "n_repeat_words long, lines array<struct<line:long,words:long>>"))


def frequent_lines(rows: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """(host, line) of lines above one of the limits, over all documents. Equal texts count as one document, so copies alone make no line
    frequent. The share decides only for hosts so small that it is below the count; the lines of one of those are few."""
    lines = rows.select("host", "digest", F.explode("lines").alias("l")).select("host", "digest", "l.line")
    docs = lines.groupBy("host", "line").agg(F.countDistinct("digest").alias("docs"))
    docs = written(docs.filter(F.col("docs") >= min(LINE_LEAST, line_docs + 1)), "shared-lines")
    hosts = rows.groupBy("host").agg(F.countDistinct("digest").alias("of")).filter(F.col("of") * line_share < line_docs)
    by_share = docs.filter((F.col("docs") <= line_docs) & (F.col("docs") >= LINE_LEAST)).join(hosts, "host").filter(F.col("docs") > F.col("of") * line_share)
    return docs.filter(F.col("docs") > line_docs).select("host", "line").union(by_share.select("host", "line"))


def judged(docs: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE, least_left: float = LEAST_LEFT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed, kept) for every row.

    The host is the source; NULL is a host of its own. NULL and empty texts have no words, so they fail the base rule. Repeated rows are
    judged each and count once for their lines.
    """
    rows = written(measured(located(docs.select("doc_id", "text", "source"))), "measured")
    gone = (
        rows.select("locator", "host", F.explode("lines").alias("l")).select("locator", "host", "l.line", "l.words")
        .join(frequent_lines(rows, line_docs, line_share), ["host", "line"]).groupBy("locator").agg(F.sum("words").alias("removed_words"))
    )
    out = rows.drop("lines", "digest", "host").join(gone, "locator", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words") >= F.col("n_words") * least_left
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & left).drop("locator")
