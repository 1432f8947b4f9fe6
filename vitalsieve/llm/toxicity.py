"""Toxicity by a weighted lexicon: stems and words learned from labels, matched by Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitalsieve.llm.common import body, held_out, training_rows

#: Labelled documents of each class that the lexicon is learned from, at most.
PER_CLASS = 12_000
#: Entries of the lexicon and exception phrases, at most; both are broadcast.
MOST_ENTRIES, MOST_PHRASES = 4096, 1024
#: Terms that a task sums up before it hands their counts on.
SUMMED = 100_000
#: A term enters if it is LIFT times (as a log) more frequent in toxic documents, with EVIDENCE (G statistic) behind it.
LIFT, EVIDENCE = 2.0, 25.0
STEM = range(4, 9)

# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ԁ": "d", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ԛ": "q", "с": "c", "ѕ": "s", "т": "t", "х": "x",
    "у": "y", "ц": "u", "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_LOOKALIKE = str.maketrans(HOMOGLYPHS)
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_SIGN = re.compile(r"(?<![^\W\d_])(?<!\d)[0134578@$!](?=[^\W\d_]{2})|(?<=[^\W\d_])[0134578@$!](?=[^\W\d_])|(?<=[^\W\d_])[013457](?=[013457]?[^\W\d_])")
_GAP = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """Lower case, compatibility forms, lookalikes and digits as letters; everything between words becomes one space."""
    text = text.lower()
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text)).lower()
        words = []
        for word in text.split():  # lookalikes only inside words that also have Latin letters: whole words of another script stay
            words.append(word.translate(_LOOKALIKE) if any("a" <= c <= "z" for c in word) else word)
        text = " ".join(words)
    text = _SIGN.sub(lambda m: DIGITS[m[0]], text)
    return f" {_GAP.sub(' ', text).strip()} "


def terms(folded: str) -> set[str]:
    """Candidate entries: " word " for whole words, " stem" for their beginnings."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in STEM if len(w) > k}


@dataclass(frozen=True)
class Lexicon:
    """Weighted entries, phrases whose hits don't count, and the logistic curve on the document's features."""

    weights: dict[str, float]
    phrases: tuple[str, ...]
    curve: tuple[float, ...]

    def matcher(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            machine.add_word(term, (len(term), weight))
        for phrase in self.phrases:
            machine.add_word(phrase, (len(phrase), None))
        machine.make_automaton()
        return machine


def hits(machine: ahocorasick.Automaton, folded: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of entries outside exception phrases; of entries that start together the heaviest counts."""
    found: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, weight) in machine.iter(folded) if len(machine) else ():
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        elif weight > found.get(start, (0, 0.0))[1]:
            found[start] = (end, weight)
    if not spared:
        return [(a, b, w) for a, (b, w) in found.items()]
    spared.sort()
    starts, reach = [a for a, _ in spared], np.maximum.accumulate([b for _, b in spared])
    at = np.searchsorted(starts, list(found), side="right") - 1
    return [(a, b, w) for (a, (b, w)), i in zip(found.items(), at, strict=True) if i < 0 or reach[i] < a + 1]


def features(machine: ahocorasick.Automaton, folded: str) -> tuple[float, float]:
    """Weight of all hits, and the same by the length of the document."""
    total = sum(w for _, _, w in hits(machine, folded))
    words = folded.count(" ") - 1
    return math.log1p(total), math.log1p(100 * total / (words + 50))


def _counted(rows: DataFrame, terms_of: Callable[[], Callable[[str], set[str]]]) -> DataFrame:
    """(term, bad, fine): documents with each term by class. Up to SUMMED terms are summed in a task before they are shuffled.

    Each task calls ``terms_of`` once for the function that cuts a folded text into terms."""

    def handed(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(seen[0].keys() | seen[1].keys())
        counts = [pa.array([part[x] for x in names], pa.int64()) for part in reversed(seen)]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["term", "bad", "fine"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, seen = terms_of(), (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[label].update(of(fold(text.as_py())))
                if len(seen[0]) + len(seen[1]) > SUMMED:
                    yield handed(seen)
                    seen = Counter(), Counter()
        yield handed(seen)

    return rows.select("text", "label").mapInArrow(count, "term string, bad long, fine long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))


def _judged(counts: DataFrame, n_bad: int, n_fine: int) -> DataFrame:
    """Log of the ratio of the class rates, and the G statistic of the two counts."""
    rate = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("fine") + 0.5) / (n_fine + 1))
    n, share = F.col("bad") + F.col("fine"), n_bad / (n_bad + n_fine)
    part = lambda k, expected: F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)
    return counts.withColumn("lift", rate).withColumn("evidence", 2 * (part(F.col("bad"), n * share) + part(F.col("fine"), n * (1 - share))))


def _supported(rows: DataFrame, weights: dict[str, float]) -> dict[str, float]:
    """The entries that toxic training documents support, each document sharing one vote among the entries it holds.

    Words that only a group of copies shares fall out: its documents hold hundreds of such words, so each has next to no vote. The
    lists of entries by document are bounded by the number of training rows.
    """
    order = {term: i for i, term in enumerate(weights)}
    shared = rows.sparkSession.sparkContext.broadcast(Lexicon({t: float(len(order) - i) for t, i in order.items()}, (), ()))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, n = shared.value.matcher(), len(order)
        for batch in batches:
            lists = [sorted({n - int(w) for _, _, w in hits(machine, fold(text))}) for text in (x.as_py() for x in batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], ["entries"])

    votes = [0.0] * len(order)
    for r in rows.filter("label = 1").select("text").mapInArrow(found, "entries array<int>").collect():
        for i in r["entries"]:
            votes[i] += 1 / len(r["entries"])
    return {term: weights[term] for term, i in order.items() if votes[i] >= 1}


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic curve by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = np.array([1e-6] + [0.05] * (len(beta) - 1))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (y - p)) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Lexicon:
    """A lexicon from at most ``per_class`` labelled rows of each class that are not held out.

    Only counts of terms that pass the test of evidence (bounded) and two numbers per training row (bounded) reach the driver.
    Without labels of both classes the lexicon is empty and every score is one half, just below it.
    """
    rows = training_rows(docs, labels, "toxic", per_class)
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_bad, n_fine = size.get(1, 0), size.get(0, 0)
    if not n_bad or not n_fine:
        return Lexicon({}, (), (-0.01, 0.0, 0.0))
    strong = _judged(_counted(rows, lambda: terms).filter("bad >= 4"), n_bad, n_fine).filter((F.col("lift") > LIFT) & (F.col("evidence") > EVIDENCE))
    weights: dict[str, float] = {}
    for r in strong.orderBy(F.desc("evidence"), F.length("term"), "term").limit(MOST_ENTRIES).collect():
        if not any(r["term"][:k] in weights for k in range(2, len(r["term"]))):  # a kept stem speaks for its words
            weights[r["term"]] = float(r["lift"])
    weights = _supported(rows, weights)
    spared = rows.sparkSession.sparkContext.broadcast(Lexicon(weights, (), ()))

    def around() -> Callable[[str], set[str]]:
        """Entries with the word before or behind them."""
        machine = spared.value.matcher()

        def of(folded: str) -> set[str]:
            out = set()
            for start, end, _ in hits(machine, folded):
                stop = folded.find(" ", start + 1)
                before, behind = folded.rfind(" ", 0, start) if start else -1, folded.find(" ", stop + 1)
                out |= {folded[before : stop + 1]} if before >= 0 else set()
                out |= {folded[start : behind + 1]} if behind >= 0 else set()
            return out

        return of

    harmless = _counted(rows, around).filter((F.col("fine") >= 5) & ((F.col("bad") + 0.5) / (n_bad + 1) < (F.col("fine") + 0.5) / (n_fine + 1))) if weights else None
    phrases = tuple(r["term"] for r in harmless.orderBy(F.desc("fine"), "term").limit(MOST_PHRASES).collect()) if weights else ()
    lexicon = Lexicon(weights, phrases, (0.0, 0.0, 0.0))
    points = np.array([(*p, r) for p, r in _features(rows, lexicon, "label")], dtype=float).reshape(-1, 3)
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out()).agg(F.avg("toxic")).first()[0]
    balance = np.where(points[:, 2] == 1, known / n_bad, (1 - known) / n_fine) * len(points)  # classes as frequent as among all labels
    return Lexicon(weights, phrases, _logistic(points[:, :2], points[:, 2], balance))


def _features(rows: DataFrame, lexicon: Lexicon, label: str) -> list[tuple[tuple[float, float], int]]:
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value.matcher()
        for batch in batches:
            found = [features(machine, fold(text)) for text in (x.as_py() for x in batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), batch.column(1)], ["a", "b", "label"])

    return [((r["a"], r["b"]), r["label"]) for r in rows.select("text", F.col(label).alias("label")).mapInArrow(measure, "a double, b double, label int").collect()]


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with score (0 to 1) as the last column; a column of that name is replaced. One pass, no shuffle.

    NULL and empty texts have no hits and get the score of a text without any.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon)
    kept = [c for c in docs.columns if c != "score"]
    schema = docs.select(*kept, F.lit(0.0).alias("score")).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, (base, a, b) = shared.value.matcher(), shared.value.curve
        for batch in batches:
            scores = []
            for value in batch.column(kept.index("text")):
                x, y = features(machine, fold(value.as_py() or ""))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, base + a * x + b * y)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*kept, "score"])

    return docs.select(*kept).mapInArrow(judge, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; no id, language, source or label goes into a score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    return scored(rows, learn(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns. A column ``score`` of theirs is kept."""
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(c).alias(n) for c, n in names.items()], body().alias("text"))
    left = scored(rows, learn(docs, labels)).filter("score < 0.5")
    return left.select(*[F.col(n).alias(c) for c, n in names.items()])
