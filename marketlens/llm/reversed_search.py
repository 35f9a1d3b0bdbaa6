"""Ranked lexical search, reversed: the items are indexed and the documents stream by.

Every task holds the inverted index of the items' terms (a query set in slices of checked size). Its
documents' term counts run through the index, chunk by chunk; each item keeps a bounded heap of its
best documents. A task hands on its heaps alone, and heaps are merged in two rounds, so that no
merge reads more than its share. Documents are never shuffled: they are read once per slice for the
statistics (documents with a term, all terms, documents per term) and once for the scores.

A document's score sums, over the terms of the item, weight * ((10**9 * tf) div (1000 * tf + 8 * m))
with weight = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and m = 100 - 90 + ((90 * n * N) div L).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BEST = 10
SLICE_BYTES = 8 << 20  # of item texts indexed at once
CHUNK = 4 << 20  # bytes of text whose terms are counted together
CELLS = 1 << 22  # scores (documents x items) held at once
MERGES = 64  # heaps merged side by side before the last merge

_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)  # A-Z to a-z
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of some texts (binary, without nulls) in a row, and the index of each text's first
    one (with one more entry at the end). A term is a run of digits, letters and characters beyond
    ASCII; only A-Z are lower-cased."""
    flat = b" ".join([*texts.to_pylist(), b""])
    folded = _FOLD[np.frombuffer(flat, dtype=np.uint8)]
    gap = folded == 0x20
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sizes = pc.binary_length(texts).to_numpy().astype(np.int64) + 1
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int64)
    body = pa.py_buffer(folded[~gap].tobytes())
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), body])
    return words.dictionary_encode(), first


class Index:
    """The items' terms, and for each term the items that hold it: ``items[at[t]:at[t + 1]]``."""

    def __init__(self, texts: list[bytes]):
        coded, first = terms(pa.array(texts, pa.binary()))
        self.number = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        pairs = np.unique(np.stack([coded.indices.to_numpy().astype(np.int64), owner]), axis=1)
        self.items = pairs[1]
        self.at = np.searchsorted(pairs[0], np.arange(len(self.number) + 1))
        self.n_items = len(texts)

    def __len__(self) -> int:
        return len(self.number)

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of the indexed terms, by text; and each text's number of terms."""
        coded, first = terms(texts)
        get = self.number.get
        known = np.fromiter((get(t, -1) for t in coded.dictionary.to_pylist()), dtype=np.int64, count=len(coded.dictionary))
        term = known[coded.indices.to_numpy()]
        n = np.diff(first)
        text = np.repeat(np.arange(len(texts)), n)
        hit = term >= 0
        key, tf = np.unique(text[hit] * len(self) + term[hit], return_counts=True)
        return key // max(1, len(self)), key % max(1, len(self)), tf, n


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of about CHUNK bytes; a longer text is a chunk of its own."""
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        upto = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CHUNK, side="right")))
            yield batch.column(0).slice(at, end - at), texts.slice(at, end - at)
            at = end


def _statistics(index: Index):
    """One row a task: documents with a term, all terms, and per indexed term its documents."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = total = 0
        held = np.zeros(len(index), dtype=np.int64)
        for _, texts in _chunks(batches):
            _, term, _, n = index.counts(texts)
            documents += int((n > 0).sum())
            total += int(n.sum())
            held += np.bincount(term, minlength=len(index))
        place = np.flatnonzero(held)
        kinds = pa.array(np.concatenate(([-2, -1], place)), pa.int64())
        yield pa.RecordBatch.from_arrays([kinds, pa.array(np.concatenate(([documents, total], held[place])), pa.int64())], names=["term", "n"])

    return of


class _Heaps:
    """The best documents of each item: highest score, then smallest id (null last)."""

    def __init__(self, n: int, best: int):
        self.best, self.heaps = best, [[] for _ in range(n)]
        self.least = np.ones(n, dtype=np.int64)  # a score that may still enter

    def add(self, item: int, score: int, doc_id: int | None) -> None:
        heap, entry = self.heaps[item], (score, doc_id is not None, -(doc_id or 0))
        if len(heap) < self.best:
            heapq.heappush(heap, entry)
        else:
            heapq.heappushpop(heap, entry)
        if len(heap) == self.best:
            self.least[item] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.heaps):
            yield from ((item, -i if known else None, score) for score, known, i in heap)


def _streamed(index: Index, weights: np.ndarray, documents: int, total: int, best: int):
    """Per task: the heaps of all items after its documents."""

    def part(text: np.ndarray, gain: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Scores (texts x items) of ``n`` texts."""
        width = index.at[term + 1] - index.at[term]
        upto = np.cumsum(width)
        places = np.arange(upto[-1] if len(upto) else 0) + np.repeat(index.at[term] - upto + width, width)
        cell = np.repeat(text * index.n_items, width) + index.items[places]
        # Whole numbers far below 2**53: sums in doubles are exact.
        sums = np.bincount(cell, weights=np.repeat(gain, width), minlength=n * index.n_items)
        return sums.astype(np.int64).reshape(n, index.n_items)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = _Heaps(index.n_items, best)
        widths = np.diff(index.at)
        most = max(1, CELLS // max(1, index.n_items))
        for ids, texts in _chunks(batches):
            text, term, tf, n = index.counts(texts)
            m = np.array([10 + 90 * k * documents // total for k in n.tolist()], dtype=np.int64) if total else n
            gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[text]))
            held = np.cumsum(np.bincount(text, weights=widths[term], minlength=len(texts)))
            b = 0
            while b < len(texts):  # some texts, bounded by their scores and by their entries in the index
                a, upto = b, (held[b - 1] if b else 0) + CELLS
                b = min(a + most, max(a + 1, int(np.searchsorted(held, upto, side="right"))), len(texts))
                i, j = np.searchsorted(text, [a, b])
                scores = part(text[i:j] - a, gain[i:j], term[i:j], b - a)
                rows, items = np.nonzero(scores >= heaps.least)
                for r, item in zip(rows.tolist(), items.tolist()):
                    if scores[r, item] >= heaps.least[item]:
                        heaps.add(item, int(scores[r, item]), ids[a + r].as_py())
        found = list(heaps.rows())
        cols = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(cols, names=["slot", "doc_id", "score"])

    return of


def _best(found: DataFrame, keys: list[str], best: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= best)


def _searched(rows: DataFrame, part: list[tuple[Any, bytes]], best: int) -> DataFrame:
    index = Index([text for _, text in part])
    counted = rows.mapInArrow(_statistics(index), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    sums = counted.toArrow()  # at most one row per indexed term, and two more
    known = dict(zip(sums["term"].to_pylist(), sums["n"].to_pylist()))
    documents, total = known.get(-2, 0), known.get(-1, 0)
    held = [known.get(t, 0) for t in range(len(index))]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held], dtype=np.int64)
    found = rows.mapInArrow(_streamed(index, weights, documents, total, best), "slot long, doc_id long, score long")
    shares = _best(found.withColumn("share", F.spark_partition_id() % MERGES), ["slot", "share"], best)
    merged = _best(shares.select("slot", "doc_id", "score"), ["slot"], best)
    names = rows.sparkSession.createDataFrame([(k, i) for k, (i, _) in enumerate(part)], "slot long, item_id long")
    return merged.join(F.broadcast(names), "slot").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``best`` documents of each item with a score above 0: item_id, rank (from 1), doc_id, score.

    Equal scores are ranked by ascending doc_id, a null doc_id last. Null and empty texts hold no
    term; an item without terms, or whose terms no document holds, has no row. Each row of ``docs``
    is a document and each row of ``items`` an item of its own, also where ids repeat or are null:
    an item_id given twice has two rankings. Other columns are ignored. Without documents or items
    the result is empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), text)
    total = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0  # one row; each item also has a heap
    slices = -(-total // slice_bytes) or 1
    found = []
    for k in range(slices):
        part = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).toArrow()  # about slice_bytes
        pairs = zip(part.column(0).to_pylist(), (t.encode() for t in part.column(1).to_pylist()))
        found.append(_searched(rows, sorted(pairs, key=lambda p: (p[0] is None, p)), best))
    return reduce(DataFrame.unionByName, found)
