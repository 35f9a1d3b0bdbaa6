"""SimHash with covering anchors at a wide reach: near-duplicates by shingles of five words.

Texts whose sets of shingles have a Jaccard similarity of 0.8 differ in some 15 % of the bits of
their SimHashes: an angle, not two bits. So a fingerprint here has ``BLOCKS`` blocks of 31 bits, and
two are linked if they differ in at most ``REACH`` bits in all and in at most two bits of some block.
The anchors of a block are the words of the [31, 26] Hamming code (see ``simhash_anchors``). Between
two blocks that differ in two bits lies a word within one bit of both, and its anchor, within the
covering radius of it, is within two bits of either: covering radius plus half of the threshold
of two bits. A fingerprint is replicated to these some 15 anchors per block, and all that meet at one
are compared over all their bits, so every link of the rule is found.

The number of fingerprints that meet by chance at an anchor is 15 of 2**26 of all; a family of near copies
may crowd one. There, a fingerprint is first compared with the heads of the groups found so far, and
only what is not yet in one group is compared pair by pair. A task replaces its links by stars, each component's
members with the smallest of them, so what goes on grows with the members of a family and not with its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.components import component_minima
from marketlens.llm.simhash_anchors import HALF, anchors, one_of_each, read
from marketlens.llm.words import Words, chunks, inside, mixed, windows
from marketlens.sources.workspace import stored

SHINGLE = 5
BLOCKS = 8
REACH = 40  # of 248 bits: the angle of a similarity of 0.8 is 37.6 of them
PARTS = BLOCKS // 2  # 64-bit numbers, each with two blocks
SMALL = 64  # fingerprints at an anchor that are compared pair by pair at once
_SLICE = 1 << 14  # shingles whose bits are counted at once
_STEP = 4096  # fingerprints replicated at once
_PLACE = 10  # bits of an anchor by which the exchange deals
_HELD = 1 << 18  # links that a task holds before it replaces them by stars
_USED = np.uint64((1 << 2 * HALF) - 1)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of the distinct shingles of each text, by text; a text of fewer words has one, all its words."""
    at = inside(words, size)
    doc, found = words.doc[at], windows(words.hashes, size, 17)[at]
    n = np.diff(words.first)
    for k in range(1, size):
        short = np.flatnonzero(n == k)
        if len(short):
            doc, found = np.concatenate((doc, short)), np.concatenate((found, windows(words.hashes, k, 17 + k)[words.first[short]]))
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    return doc[new], found[new]


def fingerprints(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """(texts, PARTS) numbers of 62 bits; a bit is set if it is set for over half of the text's distinct shingles.
    Zero without a word."""
    words = Words([t.lower() for t in texts])
    doc, found = shingles(words, size)
    counts = np.zeros((len(texts), 64 * PARTS), dtype=np.int64)
    for a in range(0, len(doc), _SLICE):
        part, own = found[a : a + _SLICE], doc[a : a + _SLICE]
        values = np.stack([mixed(part + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) for k in range(PARTS)], axis=1)
        bits = np.unpackbits(values.view(np.uint8), axis=1, bitorder="little")
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
        counts[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    n = np.bincount(doc, minlength=len(texts))
    packed = np.packbits(counts * 2 > n[:, None], axis=1, bitorder="little")
    return packed.view(np.uint64).reshape(len(texts), PARTS) & _USED


def names(prints: np.ndarray) -> np.ndarray:
    """A number of 64 bits for each fingerprint. Two of n texts share one by chance in n * n / 2**65 cases."""
    out = np.zeros(len(prints), dtype=np.uint64)
    for k in range(PARTS):
        out = mixed(out ^ prints[:, k])
    return out.view(np.int64)


_FIELDS = [f"p{k}" for k in range(PARTS)]
_PRINT = ", ".join(f"{f} long" for f in _FIELDS)


def _columns(prints: np.ndarray) -> list[pa.Array]:
    return [pa.array(prints[:, k].view(np.int64)) for k in range(PARTS)]


def _matrix(batch: pa.RecordBatch, at: int) -> np.ndarray:
    return np.stack([batch.column(at + k).to_numpy().view(np.uint64) for k in range(PARTS)], axis=1)


def _prints(size: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 1):
            prints = fingerprints(texts, size)
            cols = [batch.column(0), batch.column(2), pa.array(names(prints)), *_columns(prints)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "mark", "fp", *_FIELDS])

    return of


def _block(prints: np.ndarray, block: np.ndarray | int) -> np.ndarray:
    """The 31 bits of a block of each fingerprint."""
    block = np.broadcast_to(block, len(prints))
    bits = prints[np.arange(len(prints)), block // 2] >> (HALF * (block % 2)).astype(np.uint64)
    return (bits & np.uint64((1 << HALF) - 1)).astype(np.uint32)


def replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, parts): each distinct fingerprint once for all its anchors of a block that share their last bits."""
    for batch in batches:
        every = _matrix(batch, 0)
        for a in range(0, len(every), _STEP):
            prints = every[a : a + _STEP]
            for block in range(BLOCKS):
                rows, found = anchors(_block(prints, block))
                place = (found & np.uint32((1 << _PLACE) - 1)).astype(np.int64) | block << _PLACE
                both = np.unique(rows.astype(np.int64) << 32 | place)
                yield pa.RecordBatch.from_arrays([pa.array(both & 0xFFFFFFFF), *_columns(prints[both >> 32])], names=["place", *_FIELDS])


def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, parts): what comes to a place, at all its anchors there."""
    for batch in batches:
        for a in range(0, batch.num_rows, _STEP):
            part = batch.slice(a, _STEP)
            place, prints = part.column(0).to_numpy(), _matrix(part, 1)
            block = place >> _PLACE
            rows, found = anchors(_block(prints, block))
            here = (found.astype(np.int64) ^ place[rows]) & ((1 << _PLACE) - 1) == 0
            rows, found = rows[here], found[here]
            key = found.astype(np.int64) | block[rows] << HALF
            yield pa.RecordBatch.from_arrays([pa.array(key), *_columns(prints[rows])], names=["anchor", *_FIELDS])


def linked(one: np.ndarray, other: np.ndarray, reach: int) -> np.ndarray:
    """Whether fingerprints (their numbers are the last axis) keep to the rule for a link."""
    odd = one ^ other
    far = np.bitwise_count(odd).sum(axis=-1, dtype=np.int64) > reach
    low = np.bitwise_count(odd & np.uint64((1 << HALF) - 1)).min(axis=-1)
    high = np.bitwise_count(odd >> np.uint64(HALF)).min(axis=-1)
    return ~far & (np.minimum(low, high) <= 2)


def _crowd(prints: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Links that hold together the components of the fingerprints of one crowded anchor."""
    n = len(prints)
    group, kept, heads = np.full(n, -1), [], []
    left = np.arange(n)
    while len(left):  # the first of those left is the head of all that link to it
        head, rest = left[0], left[1:]
        near = linked(prints[rest], prints[head], reach)
        group[head] = len(heads)
        group[rest[near]] = len(heads)
        kept += [(int(head), int(x)) for x in rest[near]]
        heads.append(head)
        left = rest[~near]
    label, largest = np.arange(len(heads)), np.argmax(np.bincount(group))
    for x in np.flatnonzero(group != largest):  # what remains apart: each with all those of other groups
        own = label[group]
        if (own == own[0]).all():
            break
        others = np.flatnonzero(own != own[x])
        for y in others[linked(prints[others], prints[x], reach)]:
            if label[group[y]] != label[group[x]]:
                kept.append((int(x), int(y)))
                label[label == label[group[y]]] = label[group[x]]
    return kept


def links_of(key: np.ndarray, prints: np.ndarray, reach: int) -> np.ndarray:
    """(links, 2) names: links among rows sorted by anchor, those of small anchors all at once."""
    name, out = names(prints), []
    cuts = np.flatnonzero(np.diff(key)) + 1
    starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(key)]))
    size = stops - starts
    stop = np.repeat(np.where(size <= SMALL, stops, 0), size)
    at = np.arange(len(key))
    for step in range(1, SMALL):
        at = at[at + step < stop[at]]
        if not len(at):
            break
        near = at[linked(prints[at], prints[at + step], reach)]
        out.append(np.stack((name[near], name[near + step]), axis=1))
    for a, b in zip(starts[size > SMALL], stops[size > SMALL]):
        pairs = _crowd(prints[a:b], reach)
        if pairs:
            out.append(name[a + np.array(pairs)])
    return np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)


def stars(links: np.ndarray) -> np.ndarray:
    """(members, 2): each node of some links but the smallest of its component, and that smallest one."""
    nodes, ends = np.unique(links, return_inverse=True)
    ends = ends.reshape(-1, 2)
    label = np.arange(len(nodes))
    while len(ends):
        ends = np.sort(label[ends], axis=1)
        ends = ends[ends[:, 0] != ends[:, 1]]
        np.minimum.at(label, ends[:, 1], ends[:, 0])
        while (label[label] != label).any():
            label = label[label]
    apart = label != np.arange(len(nodes))
    return np.stack((nodes[apart], nodes[label[apart]]), axis=1)


def _links(reach: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit(rows: list[pa.RecordBatch], last: bool = False) -> Iterator[pa.RecordBatch]:
            rows = [r for r in spread(iter(rows)) if r.num_rows]
            if rows:
                key = np.concatenate([r.column(0).to_numpy() for r in rows])
                order = np.argsort(key, kind="stable")
                found = links_of(key[order], np.concatenate([_matrix(r, 1) for r in rows])[order], reach)
                found = found[found[:, 0] != found[:, 1]]
                if len(found):
                    held.append(found)
            if held and (last or sum(map(len, held)) > _HELD):
                held[:] = [stars(np.concatenate(held))]
                if last or len(held[0]) > _HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][:, 0]), pa.array(held[0][:, 1])], names=["src", "dst"])
                    held.clear()

        # The rows come sorted by place; the last place of a batch may go on in the next ones.
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut or rest and rest[-1].column(0)[-1].as_py() != key[0]:
                yield from emit([*rest, batch.slice(0, cut)])
                rest = []
            rest.append(batch.slice(cut))
        yield from emit(rest, last=True)

    return of


def wide_links(distinct: DataFrame, reach: int = REACH) -> DataFrame:
    """(src, dst): names of fingerprints that links lead from one to the other; they hold each component together."""
    placed = distinct.select(*_FIELDS).mapInArrow(replicas, f"place long, {_PRINT}").repartition("place")
    # Spread and compared in one Python step: two in a row would need two workers for each core.
    return placed.sortWithinPartitions("place").mapInArrow(_links(reach), "src long, dst long").distinct()


def keep_one_near(docs: DataFrame, size: int = SHINGLE, reach: int = REACH) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates: the one with the smallest doc_id.

    Rows are judged one by one as in ``simhash_anchors.keep_one``, also where they share a doc_id or have none. Texts
    without a word, null among them, are one component. All columns stay; an empty table gives an empty one.
    """
    prints = stored(read(docs).select("doc_id", "text", "mark").mapInArrow(_prints(size), f"doc_id long, mark long, fp long, {_PRINT}"), "wide-prints")
    distinct = stored(prints.groupBy("fp").agg(*[F.min(f).alias(f) for f in _FIELDS]), "distinct-wide-prints")
    found = component_minima(stored(wide_links(distinct, reach), "wide-links"))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return one_of_each(docs, prints, stored(rooted, "wide-roots"))
