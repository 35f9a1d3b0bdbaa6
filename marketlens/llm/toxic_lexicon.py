"""Toxicity by a weighted lexicon and Aho-Corasick matching.

Texts are folded first: lower case, look-alike letters of other scripts, digits and signs that
stand for letters, and invisible characters. The lexicon is learned from labels: word beginnings
that occur clearly more often in toxic documents than in clean ones, each with its log-odds as
weight. One automaton finds all of them, anchored at the start of a word. A term inside an exception
phrase (two words that clean documents use together) does not count. The matched weights, as a
sum and relative to the length, give a score through a logistic curve fitted on the same documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import id_remainder
from marketlens.llm.words import chunks
from marketlens.sources.workspace import stored

LABELLED = 20_000  # most labelled documents that the lexicon is learned from
SHORTEST, LONGEST = 3, 14  # characters of a term
MIN_DOCS = 5  # toxic documents with the term
MIN_Z = 6.0  # how sure its log-odds must be
MIN_WEIGHT = 1.0
GAIN = 0.5  # a longer term must weigh so much more than its beginning
CLEAN_WEIGHT = -1.5  # log-odds of an exception phrase

# Letters that look like Latin ones, and signs that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "€": "e"}
INVISIBLE = "­​‌‍⁠﻿"

_FOLD = str.maketrans(LOOK_ALIKES | SIGNS | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | dict.fromkeys(INVISIBLE, ""))
_BREAKS = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Folded words, one space before and after each."""
    return f" {_BREAKS.sub(' ', text.lower().translate(_FOLD)).strip()} "


def _presences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, all): in how many documents of the task a word is."""
    seen: dict[str, list[int]] = {}
    for batch, texts in chunks(batches, 0):
        for raw, toxic in zip(texts, batch.column(1).to_pylist()):
            for word in set(fold(raw.decode()).split()):
                n = seen.setdefault(word, [0, 0])
                n[0] += toxic
                n[1] += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.string()), *[pa.array([n[k] for n in seen.values()], pa.int64()) for k in (0, 1)]],
        names=["word", "toxic", "all"],
    )


def _log_odds(a, b, toxic: int, clean: int):
    """Log-odds of a term in ``a`` toxic and ``b`` clean documents, and how sure they are: the root of
    the likelihood ratio against no connection, with the sign of the log-odds."""
    weight = F.log(a + 0.5) - F.log(b + 0.5) - F.log(F.lit((toxic + 1) / (clean + 1)))
    share = toxic / (toxic + clean)
    part = lambda n, p: F.when(n > 0, n * F.log(n / (p * (a + b)))).otherwise(0.0)
    return weight, F.signum(weight) * F.sqrt(F.greatest(2 * (part(a, share) + part(b, 1 - share)), F.lit(0.0)))


@dataclass
class Lexicon:
    weights: dict[str, float]  # a word's beginning -> weight
    exceptions: set[str] = field(default_factory=set)  # "word word"
    curve: np.ndarray = field(default_factory=lambda: np.zeros(4))
    base: float = 0.0

    def automaton(self):
        built = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            built.add_word(f" {term}", (len(term), weight, False))
        for phrase in self.exceptions:
            built.add_word(f" {phrase} ", (len(phrase), 0.0, True))
        if len(built):
            built.make_automaton()
        return built

    def matches(self, automaton, folded: str) -> dict[int, float]:
        """Where a word starts -> its weight: the longest term of each word, without exceptions."""
        found: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        if not len(automaton):
            return found
        for end, (size, weight, exception) in automaton.iter(folded):
            if exception:
                excused.append((end - size, end))
            else:
                found[end - size + 1] = weight  # a longer term of the same word comes later
        for a, b in excused:
            for at in [x for x in found if a <= x < b]:
                del found[at]
        return found

    def features(self, automaton, folded: str) -> list[float]:
        total = sum(self.matches(automaton, folded).values())
        words = folded.count(" ") - 1 if folded.strip() else 0
        return [1.0, np.log1p(max(0.0, total)), 100.0 * total / (words + 20), np.log1p(words)]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve, -30, 30))) if len(features) else np.zeros(0)


def _phrases(lexicon: Lexicon):
    """(phrase, toxic, all) around the lexicon's terms, and per document its features."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, seen = lexicon.automaton(), {}
        for batch, texts in chunks(batches, 0):
            for raw, toxic in zip(texts, batch.column(1).to_pylist()):
                folded, here = fold(raw.decode()), set()
                for at in lexicon.matches(automaton, folded):
                    end = folded.index(" ", at)
                    before, after = folded.rfind(" ", 0, at - 1), folded.find(" ", end + 1)
                    here |= {folded[before + 1 : end]} if at > 1 else set()
                    here |= {folded[at:after]} if after > 0 else set()
                for phrase in here:
                    n = seen.setdefault(phrase, [0, 0])
                    n[0] += toxic
                    n[1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), *[pa.array([n[k] for n in seen.values()], pa.int64()) for k in (0, 1)]],
            names=["phrase", "toxic", "all"],
        )

    return of


def _features(lexicon: Lexicon):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch, texts in chunks(batches, 0):
            rows = [lexicon.features(automaton, fold(t.decode())) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "x"])

    return of


def _fitted(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps on at most LABELLED rows."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learning_labels(labels: DataFrame, folds: int, held_out: int, most: int = LABELLED) -> DataFrame:
    """(doc_id, toxic) to learn from: outside the held-out fold, at most ``most`` documents, chosen by a hash."""
    rows = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.filter(id_remainder(F.col("doc_id"), folds) != held_out)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Lexicon:
    """A lexicon from the labelled documents. Empty, with score 0, if no label is left to learn from."""
    chosen = stored(learning_labels(labels, folds, held_out), "labels").withColumnRenamed("doc_id", "_labelled")
    rows = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("_labelled")).filter("text IS NOT NULL")
    # Copies of one text say no more than the text.
    rows = stored(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled-texts")
    totals = rows.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("all")).first()  # one row
    toxic, clean = totals["toxic"] or 0, totals["all"] - (totals["toxic"] or 0)
    if not toxic or not clean:
        return Lexicon({}, base=float(toxic > 0))
    words = rows.mapInArrow(_presences, "word string, toxic long, all long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("all").alias("all")
    )
    ends = F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST)))
    terms = words.filter(F.length("word") >= SHORTEST).select(
        F.explode(F.transform(ends, lambda n: F.substring("word", F.lit(1), n))).alias("term"), "toxic", "all"
    )
    terms = terms.groupBy("term").agg(F.sum("toxic").alias("a"), (F.sum("all") - F.sum("toxic")).alias("b"))
    weight, z = _log_odds(F.col("a"), F.col("b"), toxic, clean)
    found = terms.select("term", weight.alias("weight"), z.alias("z"), "a")
    found = found.filter((F.col("a") >= MIN_DOCS) & (F.col("z") >= MIN_Z) & (F.col("weight") >= MIN_WEIGHT))
    lexicon = Lexicon(_lasting({r["term"]: r["weight"] for r in found.collect()}))  # beginnings of words of LABELLED documents
    phrases = rows.mapInArrow(_phrases(lexicon), "phrase string, toxic long, all long").groupBy("phrase").agg(
        F.sum("toxic").alias("a"), (F.sum("all") - F.sum("toxic")).alias("b")
    )
    weight, z = _log_odds(F.col("a"), F.col("b"), toxic, clean)
    excused = phrases.filter((F.col("b") >= MIN_DOCS) & (weight <= CLEAN_WEIGHT) & (z <= -MIN_Z / 2))
    lexicon.exceptions = {r["phrase"] for r in excused.select("phrase").collect()}
    fit = rows.mapInArrow(_features(lexicon), "toxic int, x array<double>").toPandas()  # at most LABELLED rows
    lexicon.curve = _fitted(np.stack(fit["x"].to_numpy()), fit["toxic"].to_numpy(dtype=float))
    return lexicon


def _lasting(weights: dict[str, float]) -> dict[str, float]:
    """Terms that say more than their own beginnings."""
    kept: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t), t)):
        best = max((kept[term[:k]] for k in range(1, len(term)) if term[:k] in kept), default=0.0)
        if weights[term] >= best + GAIN:
            kept[term] = weights[term]
    return kept


def _score(lexicon: Lexicon):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch, texts in chunks(batches, 1):
            if lexicon.weights:
                x = np.array([lexicon.features(automaton, fold(t.decode())) for t in texts])
                score = lexicon.scores(x)
            else:
                score = np.full(len(texts), lexicon.base)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    return of


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), predicted (1 from 0.5 on).

    A null or empty text has no match and gets the score of such a text. Repeated rows and null ids each
    get a row. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(lexicon), "doc_id long, score double, predicted int")
