"""LM scoring by masked pseudo-likelihood.

A small bidirectional network predicts every word from the words on both sides of it: embeddings
of the neighbours, weighted by place, a tanh layer and a softmax over word classes; within its class
a word has its share of the corpus. The sum of the conditional log-probabilities of all words of
a document is its score.

Words are hashed into buckets, so the network has a fixed size. Counts of all buckets over all
documents make the classes: buckets by frequency, cut into classes of equal mass. Training is
data-parallel: in every round each task trains its own copy on its documents (every word is a target
once, in an order that its hash and place decide; a target is never among its own neighbours), and the copies are averaged by
their number of targets, block by block, in two levels of grouping. Each document is trained on in one round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import Words, chunks, mixed

BUCKETS = 1 << 15
CLASSES = 128
WIDTH = 16  # of an embedding
SIDE = 3  # neighbours on either side
ROUNDS = 2
BATCH = 4096
RATE = 0.25
BLOCK = 1 << 14  # parameters averaged together
_STEP = 1 << 13  # words scored at once
_SHORT = 4  # rows of a run that are added place by place
_SAFE = 60.0  # exponentials of numbers up to this size, and sums of CLASSES of them, are far from a float's ends
_ONES = np.ones(CLASSES, dtype=np.float32)


@dataclass(frozen=True)
class Network:
    """Parameters as one vector of floats, and the classes of the buckets."""

    flat: np.ndarray
    klass: np.ndarray  # of a bucket
    log_share: np.ndarray  # of a bucket in its class

    def parts(self, flat: np.ndarray) -> tuple[np.ndarray, ...]:
        shapes = [(BUCKETS + 1, WIDTH), (2 * SIDE, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,)]
        out, at = [], 0
        for shape in shapes:
            n = math.prod(shape)
            out.append(flat[at : at + n].reshape(shape))
            at += n
        return tuple(out)


def start(counts: np.ndarray) -> Network:
    """An untrained network; its first guess for a class is the class's share."""
    smooth = counts + 1.0
    order = np.lexsort((np.arange(BUCKETS), -smooth))
    mass = np.cumsum(smooth[order]) / smooth.sum()
    klass = np.empty(BUCKETS, dtype=np.int64)
    klass[order] = np.minimum((mass * CLASSES).astype(np.int64), CLASSES - 1)
    totals = np.bincount(klass, weights=smooth, minlength=CLASSES)
    rng = np.random.default_rng(5)
    embed = rng.normal(0, 0.3, (BUCKETS + 1, WIDTH))
    embed[BUCKETS] = 0  # beyond the text's ends
    flat = np.concatenate(
        [
            embed.ravel(),
            np.full(2 * SIDE * WIDTH, 1 / math.sqrt(2 * SIDE)),
            np.zeros(WIDTH),
            rng.normal(0, 0.1, WIDTH * CLASSES),
            np.log(np.maximum(totals, 1.0) / totals.sum()),
        ]
    ).astype(np.float32)
    return Network(flat, klass, np.log(smooth / totals[klass]))


def buckets(words: Words) -> np.ndarray:
    return (words.hashes % np.uint64(BUCKETS)).astype(np.int64)


def neighbours(words: Words, ids: np.ndarray) -> np.ndarray:
    """(words, 2 * SIDE) bucket numbers around every word; BUCKETS beyond the ends of its text."""
    out = np.full((len(ids), 2 * SIDE), BUCKETS, dtype=np.uint16)  # 16 bits sort by radix
    for k, s in enumerate(s for s in range(-SIDE, SIDE + 1) if s):
        n = max(0, len(ids) - abs(s))
        here, there = slice(max(0, -s), max(0, -s) + n), slice(max(0, s), max(0, s) + n)
        out[here, k] = np.where(words.doc[here] == words.doc[there], ids[there], BUCKETS)
    return out


def _forward(parts: tuple[np.ndarray, ...], around: np.ndarray) -> tuple[np.ndarray, ...]:
    embed, place, bias, out, shift = parts
    seen = embed.take(around, axis=0)
    hidden = np.tanh(np.einsum("nkd,kd->nd", seen, place) + bias)
    logits = hidden @ out
    logits += shift
    if not (logits.min() > -_SAFE and logits.max() < _SAFE):  # only there a sum of exponentials could overflow or vanish
        logits -= logits.max(axis=1, keepdims=True)
    return seen, hidden, logits


def _sums(rows: np.ndarray, order: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Of each run of ``rows[order]``. Most runs are short: their rows are added place by place."""
    size = np.diff(np.append(cuts, len(order)))
    out = rows.take(order.take(cuts), axis=0)
    for k in range(1, _SHORT):
        longer = np.flatnonzero(size > k)
        out[longer] += rows.take(order.take(cuts.take(longer) + k), axis=0)
    longest = np.flatnonzero(size > _SHORT)
    if len(longest):
        left = size.take(longest) - _SHORT
        ends = np.cumsum(left)
        at = np.arange(ends[-1]) + np.repeat(cuts.take(longest) + _SHORT - (ends - left), left)
        out[longest] += np.add.reduceat(rows.take(order.take(at), axis=0), ends - left, axis=0)
    return out


def log_probabilities(net: Network, words: Words) -> np.ndarray:
    """Of every word, given the words on both sides of it."""
    ids, parts = buckets(words), net.parts(net.flat)
    around, out = neighbours(words, ids), np.empty(len(ids))
    for a in range(0, len(ids), _STEP):
        at = np.arange(a, min(a + _STEP, len(ids)))
        _, _, logits = _forward(parts, around[at])
        own = ids[at]
        chosen = logits[np.arange(len(at)), net.klass[own]]
        out[at] = chosen - np.log(np.exp(logits, out=logits) @ _ONES) + net.log_share[own]
    return out


def train(net: Network, flat: np.ndarray, squares: np.ndarray, around: np.ndarray, target: np.ndarray) -> None:
    """One Adagrad step on ``flat`` in place."""
    parts, sums = net.parts(flat), net.parts(squares)
    embed, place, _, out, _ = parts
    seen, hidden, logits = _forward(parts, around)
    n = len(target)
    p = np.exp(logits, out=logits)
    p *= (1 / (n * (p @ _ONES)))[:, None]
    p[np.arange(n), net.klass[target]] -= np.float32(1 / n)
    back = (p @ out.T) * (1 - hidden**2)
    grads = [None, np.einsum("nkd,nd->kd", seen, back), back.sum(axis=0), hidden.T @ p, np.ones(n, dtype=p.dtype) @ p]
    pull = (back[:, None, :] * place).reshape(-1, WIDTH)
    order = np.argsort(around, axis=None, kind="stable")
    sorted_ = around.ravel()[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(sorted_)) + 1))
    touched = sorted_[cuts]
    rows = _sums(pull, order, cuts)
    rows[touched == BUCKETS] = 0
    sums[0][touched] += rows**2
    embed[touched] -= RATE * rows / (np.sqrt(sums[0][touched]) + 1e-6)
    for param, total, grad in zip(parts[1:], sums[1:], grads[1:]):
        total += grad**2
        param -= RATE * grad / (np.sqrt(total) + 1e-6)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, dtype=np.int64)
    for _, texts in chunks(batches, 0):
        n += np.bincount(buckets(Words([t.lower() for t in texts])), minlength=BUCKETS)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["bucket", "n"])


_COPY = "block long, salt long, weight double, sums binary"


def _trained(net: Network, salts: int):
    """A task's copy of the network after its documents, in blocks, each times the number of targets."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, squares, n, mark = net.flat.copy(), np.zeros_like(net.flat), 0, 0
        for _, texts in chunks(batches, 0):
            words = Words([t.lower() for t in texts])
            ids = buckets(words)
            # The order depends on the words and their places alone, so a retry trains the same.
            spot = mixed(words.hashes ^ (np.arange(len(ids)) - words.first[words.doc]).astype(np.uint64))
            order = np.argsort(spot, kind="stable")
            around, target = neighbours(words, ids)[order], ids[order]
            for a in range(0, len(ids), BATCH):
                train(net, flat, squares, around[a : a + BATCH], target[a : a + BATCH])
            n += len(ids)
            mark ^= int(spot[0]) if len(spot) else 0
        if n:
            for block, a in enumerate(range(0, len(flat), BLOCK)):
                sums = (flat[a : a + BLOCK].astype(np.float64) * n).astype(np.float32).tobytes()
                yield pa.RecordBatch.from_pylist([{"block": block, "salt": mark % salts, "weight": float(n), "sums": sums}])

    return of


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros(len(group.column("sums")[0].as_py()) // 4, dtype=np.float64)
    for x in group.column("sums"):
        total += np.frombuffer(x.as_py(), dtype=np.float32)
    return pa.table(
        {
            "block": group.column("block").slice(0, 1),
            "salt": pa.array([0], pa.int64()),
            "weight": pa.array([float(sum(group.column("weight").to_pylist()))]),
            "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
        }
    )


def learn(docs: DataFrame, rounds: int = ROUNDS) -> Network:
    """A network trained on all texts of ``docs``. Without any word it knows no more than that."""
    rows = docs.filter("text IS NOT NULL").select(F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS rows
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[counted["bucket"]] = counted["n"]
    net = start(counts)
    salts = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    for k in range(rounds):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k)
        copies = part.mapInArrow(_trained(net, salts), _COPY)
        mean = copies.groupBy("block", "salt").applyInArrow(_summed, _COPY).groupBy("block").applyInArrow(_summed, _COPY)
        flat = net.flat.copy()
        for r in mean.collect():  # the network's fixed number of blocks
            flat[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["sums"], dtype=np.float32) / r["weight"]
        net = replace(net, flat=flat)
    return net


def _scores(net: Network):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 1):
            words = Words([t.lower() for t in texts])
            sums = np.concatenate(([0.0], np.cumsum(log_probabilities(net, words))))
            n = np.diff(words.first)
            total = sums[words.first[1:]] - sums[words.first[:-1]]
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.array(total), mean], names=["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"]
            )

    return of


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, log_likelihood (sum over all words), and its mean.

    A null or empty text has no words, sum 0 and a null mean. Repeated rows and null ids each get a
    row; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scores(net), "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double")
