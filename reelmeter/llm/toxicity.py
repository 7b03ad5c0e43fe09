"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding undoes the usual disguises: look-alike letters of other scripts, digits
and signs for letters, invisible characters. The lexicon is learned from labelled
documents: words and beginnings of words that toxic documents use more often,
weighted by the lower confidence bound of their log odds, besides a short list
of known insults. The weights that a text collects, also taken per word of its
length, give the score through a logistic curve. Phrases in which an entry is
harmless are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmeter.llm.common import arrow_rows, discard, free_name, kept_on_disk

# Letters that look alike, signs that stand for letters.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "к": "k",
    "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ɡ": "g", "һ": "h", "ո": "n", "ԛ": "q", "ԝ": "w", "ı": "i",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
INSULTS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
HARMLESS = ("trash can", "trash bin", "trash bag", "clown fish", "pathetic fallacy", "worthless check", "sore loser rule")

#: Labelled documents that the lexicon is learned from: this many at most, on average, chosen by a hash of the id.
TRAINING_ROWS = 20_000
#: Entries of the lexicon: the strongest so many.
ENTRIES = 5_000
PREFIXES = range(3, 11)
LONGEST = 30
#: Entries that a task counts before it hands them on.
COUNTED = 100_000


class _Fold(dict):
    """The table of ``str.translate``: filled when a character is first seen."""

    def __missing__(self, code: int):
        c = chr(code)
        wide = chr(code - 0xFEE0) if 0xFF01 <= code <= 0xFF5E else c
        low = wide.lower()
        to = "" if c in INVISIBLE else LOOK_ALIKES.get(low, low if low.isalnum() else " ")
        self[code] = to
        return to


_TABLE = _Fold()
_SIGN = re.compile(r"[$@](?=[^\W_])")


def fold(text: str | None) -> str:
    """Lower-case words between single or repeated spaces, with a space at both ends."""
    text = text or ""
    if "$" in text or "@" in text:
        text = _SIGN.sub(lambda m: "s" if m[0] == "$" else "a", text)
    return f" {text.translate(_TABLE)} "


def entries_of(folded: str) -> set[str]:
    """What a document offers to the lexicon: " word " and " beginning", just what the automaton finds in it."""
    out = set()
    for w in set(folded.split()):
        if len(w) <= LONGEST:
            out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in PREFIXES if k <= len(w))
    return out


def weight(p: int, n: int, toxic: int, clean: int, seed: bool = False) -> float:
    """Lower bound of the log odds of an entry in p toxic and n clean documents; 0 when not above chance."""
    known = 3.0 if seed and 4 * n <= p + 4 else 0.0
    if p < 3:
        return known
    odds = math.log((p + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (clean + 1))
    bound = odds - 2 * math.sqrt(1 / (p + 0.5) + 1 / (n + 0.5))
    return max(known, bound if bound > 1 else 0.0)


@dataclass
class Lexicon:
    """Counts per entry, the numbers of toxic and clean documents, and the curve."""

    counts: dict[str, tuple[int, int]]
    toxic: int
    clean: int
    harmless: tuple[str, ...] = HARMLESS
    curve: tuple[float, ...] = (-4.0, 0.6, 0.6, 0.3, 0.3)
    seeds: frozenset[str] = field(default=frozenset(f" {w} " for w in INSULTS))

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    """The automaton of a lexicon, built once per task."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for entry in set(lexicon.counts) | lexicon.seeds:
            self.automaton.add_word(entry, entry)
        for phrase in lexicon.harmless:
            self.automaton.add_word(f" {phrase} ", f" {phrase} ")
        self.phrases = {f" {p} " for p in lexicon.harmless}
        self.automaton.make_automaton()
        self.weights = {None: {}, 0: {}, 1: {}}

    def _weight(self, entry: str, left_out: int | None) -> float:
        """Of an entry, as if one document of the label ``left_out`` that has it had not been counted."""
        known = self.weights[left_out]
        if entry not in known:
            x, (p, n) = self.lexicon, self.lexicon.counts.get(entry, (0, 0))
            if left_out is not None and p + n:
                p, n = p - left_out, n - (1 - left_out)
            known[entry] = weight(p, n, x.toxic, x.clean, entry in x.seeds)
        return known[entry]

    def features(self, text: str | None, left_out: int | None = None) -> np.ndarray:
        folded = fold(text)
        found: dict[int, float] = {}
        spans = []
        for end, entry in self.automaton.iter(folded):
            start = end - len(entry) + 1
            if entry in self.phrases:
                spans.append((start, end))
            elif (w := self._weight(entry, left_out)) > found.get(start, 0.0):
                found[start] = w
        if spans:  # starts are blanks before words
            found = {s: w for s, w in found.items() if not any(a <= s < b for a, b in spans)}
        total = sum(found.values())
        words = len(folded.split()) if found else 1
        return np.array(
            [1.0, math.log1p(total), math.log1p(100 * total / max(words, 1)), max(found.values(), default=0.0), math.log1p(len(found))]
        )

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ np.array(self.lexicon.curve))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def remainder(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; rows with remainder 2 are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p, n = Counter(), Counter()

    def out():
        names = list(p.keys() | n.keys())
        return pa.RecordBatch.from_pydict(
            {
                "entry": pa.array(names, pa.string()),
                "p": pa.array([p[x] for x in names], pa.int64()),
                "n": pa.array([n[x] for x in names], pa.int64()),
            }
        )

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"].to_pylist()):
            (p if toxic else n).update(entries_of(fold(text.as_py())))
            if len(p) + len(n) > COUNTED:
                yield out()
                p, n = Counter(), Counter()
    if p or n:
        yield out()


def _featured(batches: Iterator[pa.RecordBatch], lexicon) -> Iterator[pa.RecordBatch]:
    matcher = lexicon.value.matcher()
    for batch in batches:
        labels = batch["toxic"].to_pylist()
        x = [matcher.features(t.as_py(), y) for t, y in zip(batch["text"], labels)]
        yield pa.RecordBatch.from_pydict({"x": pa.array(x, pa.list_(pa.float64())), "y": pa.array(labels, pa.int32())})


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton's method."""
    b = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-3
    for _ in range(50):
        m = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (m * (1 - m))) @ x + np.diag(keep), x.T @ (y - m) - keep * b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(b.tolist())


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, entries: int = ENTRIES) -> Lexicon:
    """A lexicon from labelled documents that are not held out.

    ``rows`` bounds the labelled rows that are used, ``entries`` the lexicon; both
    are what a driver and a task hold. Rows without a label or id are not used, equal
    texts count once. Without labels of both kinds the known insults and a
    fixed curve remain.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(remainder() != 2)
    usable = usable.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, rows / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64(F.lit("chosen"), "__id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # about ``rows`` rows of two numbers
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    training, path = kept_on_disk(
        found.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")),
        "toxicity",
    )
    totals = dict(training.groupBy("toxic").count().collect())
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        discard(docs.sparkSession, path)
        return Lexicon({}, toxic, clean)
    counts = training.select("text", "toxic").mapInArrow(_counted, "entry string, p long, n long")
    counts = counts.groupBy("entry").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    odds = F.log((F.col("p") + 0.5) / (toxic + 1)) - F.log((F.col("n") + 0.5) / (clean + 1))
    bound = odds - 2 * F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") + 0.5))
    # somewhat below the bound too: leaving out a clean document may lift an entry over it
    best = counts.where("p >= 3").withColumn("b", bound).where("b > 0.5").orderBy(F.desc("b"), "entry").limit(entries)
    with arrow_rows(docs.sparkSession, 1_000):
        lexicon = Lexicon({r.entry: (r.p, r.n) for r in best.collect()}, toxic, clean)
        shared = docs.sparkSession.sparkContext.broadcast(lexicon)
        sample = training.select("text", "toxic").mapInArrow(lambda b: _featured(b, shared), "x array<double>, y int")
        sample = sample.toPandas()
    lexicon.curve = fit_curve(np.stack(sample["x"].to_list()), sample["y"].to_numpy(float))
    discard(docs.sparkSession, path)
    return lexicon


def _scored(batches: Iterator[pa.RecordBatch], lexicon, name: str) -> Iterator[pa.RecordBatch]:
    matcher = lexicon.value.matcher()
    for batch in batches:
        scores = pa.array([matcher.score(t.as_py()) for t in batch["text"]], pa.float64())
        yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])


def with_scores(docs: DataFrame, lexicon: Lexicon, name: str = "__score") -> DataFrame:
    """``docs`` and the score of its ``text`` as ``name``; null and empty texts get the score of no match. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    return docs.mapInArrow(lambda b: _scored(b, shared, name), docs.withColumn(name, F.lit(0.0)).schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Scores depend on the whole text alone, however long; a score that equals the threshold counts as toxic. Repeated rows give repeated results; a null
    doc_id is not held out; other columns are left out; an empty table gives an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = with_scores(rows, learn(rows, labels))
    return scored.select(
        "doc_id",
        F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with the columns of ``docs``, whatever their names.

    Whole texts are scored, however long; rows with equal texts go or stay together.
    """
    name = free_name(docs.columns, "__score")
    scored = with_scores(docs, learn(docs, labels), name)
    return scored.where(F.col(name) < threshold).drop(name)
