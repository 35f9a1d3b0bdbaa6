"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

Every n-gram of a test item that at most COMMON documents hold is a seed, so that an edited copy is
found by any run of words that its edits spare. So is every n-gram that is no more frequent than is
usual for its item: the n-grams of a passage that is all over the corpus are frequent with it. Of the
rest, phrases more frequent than their item, every stretch lends the rarest. N-grams that no document
holds find nothing and are left out. A seed found in a document leads to a passage about as long as
the item. Passages that share too few words with the item to reach the score are passed over; the rest are
aligned word by word with Smith-Waterman, so that edited and paraphrased copies score by how much of
the item they keep.

Documents are never shuffled: the test items are a query set held by every task, in slices of
bounded size, and all documents are read once per slice to count and once to align.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import text_mark, without
from marketlens.llm.words import Words, chunks, inside, windows

SEED_WORDS = 3
COMMON = 1000  # documents; n-grams that no more hold are all seeds
USUAL = 2  # times the median of its item's n-grams: what a seed may be held by in any case
STRETCH = 6  # n-grams of an item of which the more frequent rest lends SPARE seeds
SPARE = 3
LEAST = 0.5  # of the score of a verbatim copy
MATCH, MISMATCH, GAP = 2, -1, -1
SLICE_BYTES = 16 << 20  # of item texts held at once

_SIGNS = re.compile(r"[\W_]+")


def plain(text: bytes) -> bytes:
    """Lower-cased words without signs."""
    return _SIGNS.sub(" ", text.decode().lower()).encode()


class Items:
    """The words of the items of one slice, and their n-grams in sorted order."""

    def __init__(self, ids: list[int], texts: list[bytes]):
        self.ids, self.words = ids, Words([plain(t) for t in texts])
        self.at = inside(self.words, SEED_WORDS)
        self.grams = windows(self.words.hashes, SEED_WORDS, 3)[self.at] if len(self.at) else np.zeros(0, dtype=np.uint64)
        self.sorted = np.unique(self.grams)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``grams`` occur, their place in ``sorted``)."""
        if not len(self.sorted):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        near = np.minimum(np.searchsorted(self.sorted, grams), len(self.sorted) - 1)
        hit = np.flatnonzero(self.sorted[near] == grams)
        return hit, near[hit]

    def seeds(self, documents: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Place in ``sorted`` -> (item, word of the item) of the chosen n-grams, given how many
        documents hold each."""
        place = np.searchsorted(self.sorted, self.grams)
        item = self.words.doc[self.at]
        inner = self.at - self.words.first[item]
        held = documents[place]
        usual = np.zeros(len(self.ids))
        cuts = np.searchsorted(item, np.arange(len(self.ids) + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            usual[i] = USUAL * np.median(held[cuts[i] : cuts[i + 1]])
        seed = (held > 0) & (held <= np.maximum(COMMON, usual[item]))
        lent: dict[tuple[int, int], int] = defaultdict(int)
        rest = np.flatnonzero((held > 0) & ~seed)
        for k in rest[np.lexsort((inner[rest], held[rest]))].tolist():  # rarest first
            stretch = int(item[k]), int(inner[k]) // STRETCH
            seed[k] = lent[stretch] < SPARE
            lent[stretch] += 1
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k in np.flatnonzero(seed).tolist():
            out[int(place[k])].append((int(item[k]), int(inner[k])))
        return out

    def item(self, i: int) -> np.ndarray:
        return self.words.hashes[self.words.first[i] : self.words.first[i + 1]]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """(best local score, index after its last word in the passage) of two word sequences."""
    n, best, end = len(passage), 0, 0
    before = np.zeros(n + 1, dtype=np.int64)
    ramp = np.arange(n + 1) * -GAP
    for word in item:
        row = np.zeros(n + 1, dtype=np.int64)
        row[1:] = np.maximum(before[:-1] + np.where(passage == word, MATCH, MISMATCH), before[1:] + GAP)
        row = np.maximum(np.maximum.accumulate(np.maximum(row, 0) + ramp) - ramp, 0)  # gaps in the item
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        before = row
    return best, end


def _documents(items: Items):
    """(place, n): in how many documents of a task each n-gram of the items is."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(items.sorted), dtype=np.int64)
        for _, texts in chunks(batches, 1):
            words = Words([plain(t) for t in texts])
            at = inside(words, SEED_WORDS)
            hit, place = items.find(windows(words.hashes, SEED_WORDS, 3)[at])
            pairs = np.unique(np.stack([words.doc[at[hit]], place]), axis=1)
            n += np.bincount(pairs[1], minlength=len(n))
        place = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(n[place])], names=["place", "n"])

    return of


_FOUND = "doc_id long, item_id long, score double, first_word long, last_word long, mark long"


def _aligned(items: Items, seeds: dict[int, list[tuple[int, int]]], least: float):
    sizes = np.diff(items.words.first)
    seeded = np.zeros(max(1, len(items.sorted)), dtype=bool)
    seeded[list(seeds)] = True

    def passages(words: Words) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, first word, word after the last) to align, each once."""
        at = inside(words, SEED_WORDS)
        hit, place = items.find(windows(words.hashes, SEED_WORDS, 3)[at])
        keep = seeded[place] if len(place) else np.zeros(0, dtype=bool)
        seen = set()
        for w, p in zip(at[hit[keep]].tolist(), place[keep].tolist()):
            doc = int(words.doc[w])
            for item, inner in seeds[p]:
                size = int(sizes[item])
                spot = (doc, item, (w - inner) // size)
                if spot not in seen:
                    seen.add(spot)
                    a = spot[2] * size - size // 2
                    yield doc, item, max(a, int(words.first[doc])), min(a + 3 * size, int(words.first[doc + 1]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [np.unique(items.item(i), return_counts=True) for i in range(len(items.ids))]
        for batch, texts in chunks(batches, 1):
            words = Words([plain(t) for t in texts])
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            for doc, item, a, b in passages(words):
                own, passage = items.item(item), words.hashes[a:b]
                values, counts = kinds[item]
                # What a passage can score at most: a match for every word that it shares.
                near = np.minimum(np.searchsorted(values, passage), len(values) - 1)
                shared = np.bincount(near[values[near] == passage], minlength=len(values))
                if np.minimum(shared, counts).sum() < least * len(own):
                    continue
                score, end = align(own, passage)
                share = score / (MATCH * len(own))
                if share >= least and (doc, item) not in best or share > best.get((doc, item), (2.0,))[0]:
                    base = int(words.first[doc])
                    best[doc, item] = share, max(0, a + end - len(own) - base), a + end - 1 - base
            ids, marks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = [(ids[d], items.ids[i], *v, marks[d]) for (d, i), v in best.items()]
            kinds_out = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            cols = [pa.array([r[k] for r in rows], kinds_out[k]) for k in range(6)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "score", "first_word", "last_word", "mark"])

    return of


def _found(docs: DataFrame, benchmark: DataFrame, least: float, slice_bytes: int) -> DataFrame:
    """Every document and item that align, per slice and passage, with the mark of the document's text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_mark(F.col("text")).alias("mark"))
    bench = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one row
    slices = -(-total // slice_bytes) or 1
    found = []
    for k in range(slices):
        part = bench.filter(F.pmod(F.xxhash64("text"), F.lit(slices)) == k).toArrow()  # about slice_bytes; ids may be null
        items = Items(part["item_id"].to_pylist(), [t.encode() for t in part["text"].to_pylist()])
        counted = rows.mapInArrow(_documents(items), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
        documents = np.zeros(len(items.sorted), dtype=np.int64)
        documents[counted["place"]] = counted["n"]
        found.append(rows.mapInArrow(_aligned(items, items.seeds(documents), least), _FOUND))
    return reduce(DataFrame.unionByName, found)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document and test item that it holds at least in part: doc_id, item_id, score
    (share of a verbatim copy's score), first_word and last_word (about where, in words without signs).

    A null or empty text holds nothing; an item of fewer than SEED_WORDS words is never found. Several
    rows of one doc_id (or without one) give one row with the best score, and so do several items of one
    item_id or without one. Other columns are ignored; without documents or items the result is empty.
    """
    found = _found(docs, benchmark, least, slice_bytes)
    best = F.max(F.struct("score", -F.col("first_word"), "last_word")).alias("best")
    grouped = found.groupBy("doc_id", "item_id").agg(best)
    return grouped.select("doc_id", "item_id", "best.score", (-F.col("best.col2")).alias("first_word"), "best.last_word")


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` without those that hold a test item. Rows are judged by their own text, also where they share
    a doc_id or have none; all columns stay."""
    return without(docs, _found(docs, benchmark, least, SLICE_BYTES).select("doc_id", "mark").distinct())
