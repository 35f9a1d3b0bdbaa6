"""SimHash near-dedup with a covering code as anchors.

The 64 bits of a fingerprint hold two halves of 31 bits (two bits are left over). Two fingerprints
that differ in at most two bits differ in at most one bit of one half. The anchors of a half are the
words of the [31, 26] Hamming code, whose covering radius is 1: every half lies within one bit of
exactly one anchor, its home. A fingerprint is replicated to every anchor within covering radius
plus threshold, 1 + 1 bits, of each half. Of a linked pair, one half differs by at most one bit, so
the home of the one lies within two bits of the other: they meet there and are compared in full.

Copies collapse first: the anchors see each distinct fingerprint once. A crowded anchor is split
once more by thirds of its remaining bits, of which a linked pair shares one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketlens.llm.common import only_one, text_mark
from marketlens.llm.components import component_minima
from marketlens.sources.workspace import stored

SHINGLE = 3
THRESHOLD = 2
SEED = 42
HALF = 31  # 2**5 - 1: the length of the Hamming code
CROWDED = 2048  # distinct fingerprints at one anchor before it is split
BLOCK = 1 << 21  # comparisons held at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text: a bit is set if it is set in over half of the shingles' hashes."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - k + 1].tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    hashes = [xxh64_intdigest(flat[a:b], SEED) for a, b in zip(starts, stops)]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype=">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(shingle: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py() or b"", shingle) for t in batch.column(1).cast(pa.binary())]
            signed = np.array(prints, dtype=np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed), batch.column(2)], names=["doc_id", "fp", "mark"])

    return of


def _syndromes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte tables of the parity check (column j is j + 1), and all ways to flip up to two bits."""
    columns = np.arange(1, HALF + 1, dtype=np.uint8)
    tables = np.zeros((4, 256), dtype=np.uint8)
    for byte in range(4):
        for bit in range(8):
            if byte * 8 + bit < HALF:
                tables[byte, (np.arange(256) >> bit) & 1 == 1] ^= columns[byte * 8 + bit]
    return tables, columns, np.array([(i, j) for i in range(HALF) for j in range(i + 1, HALF)])


_TABLES, _COLUMNS, _FLIPS = _syndromes()
#: For each syndrome, the masks of two flipped bits that lead to an anchor.
_BY_SYNDROME = [
    np.array([(1 << i) | (1 << j) for i, j in _FLIPS if _COLUMNS[i] ^ _COLUMNS[j] == s], dtype=np.uint32) for s in range(HALF + 1)
]


def _syndrome(half: np.ndarray) -> np.ndarray:
    s = np.zeros(len(half), dtype=np.uint8)
    for byte in range(4):
        s ^= _TABLES[byte, (half >> np.uint32(8 * byte)) & np.uint32(255)]
    return s


def homes(half: np.ndarray) -> np.ndarray:
    """The anchor within one bit of each 31-bit half."""
    s = _syndrome(half)
    return np.where(s > 0, half ^ (np.uint32(1) << (np.maximum(s, 1).astype(np.uint32) - np.uint32(1))), half)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every anchor within two bits of each half, its home included."""
    s = _syndrome(half)
    rows, found = [np.arange(len(half))], [homes(half)]
    for value in range(HALF + 1):
        at = np.flatnonzero(s == value)
        masks = _BY_SYNDROME[value]
        if len(at) and len(masks):
            rows.append(np.repeat(at, len(masks)))
            found.append((half[at][:, None] ^ masks[None, :]).ravel())
    return np.concatenate(rows), np.concatenate(found)


def halves(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = (prints & np.uint64((1 << HALF) - 1)).astype(np.uint32)
    high = ((prints >> np.uint64(HALF)) & np.uint64((1 << HALF) - 1)).astype(np.uint32)
    return low, high


def _replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, fp, home): each distinct fingerprint at all its anchors of both halves."""
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(prints), 20_000):
            part = prints[at : at + 20_000]
            for side, half in enumerate(halves(part)):
                rows, found = anchors(half)
                key = found.astype(np.int64) | np.int64(side << HALF)
                cols = [pa.array(key), pa.array(part[rows].view(np.int64)), pa.array(homes(half)[rows] == found)]
                yield pa.RecordBatch.from_arrays(cols, names=["anchor", "fp", "home"])


def _tree(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Of the links between n nodes, as many as hold their components together."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for left, right in links:
        for a, b in zip(left.tolist(), right.tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                kept.append((a, b))
    return kept


def _close(one: np.ndarray, other: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, BLOCK // max(1, len(other)))
    for at in range(0, len(one), step):
        near = np.bitwise_count(one[at : at + step, None] ^ other[None, :]) <= threshold
        left, right = np.nonzero(near)
        yield left + at, right


def links_at(prints: np.ndarray, home: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """A spanning set of the links between the home fingerprints of one anchor and all that visit it."""
    prints, first = np.unique(prints, return_index=True)
    own = np.flatnonzero(home[first])
    if len(prints) < 2 or not len(own):
        return []
    if len(prints) <= CROWDED:
        pairs = ((own[a], b) for a, b in _close(prints[own], prints, threshold))
    else:
        pairs = _split(prints, home[first], threshold)
    return [(int(prints[a]), int(prints[b])) for a, b in _tree(len(prints), pairs)]


def _split(prints: np.ndarray, home: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links at a crowded anchor: by one of ``threshold + 1`` parts of the bits, which each link shares."""
    width = 64 // (threshold + 1) + 1
    for part in range(threshold + 1):
        key = (prints >> np.uint64(part * width)) & np.uint64((1 << width) - 1)
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for at in np.split(order, cuts):
            own = at[home[at]]
            if len(at) > 1 and len(own):
                for a, b in _close(prints[own], prints[at], threshold):
                    yield own[a], at[b]


def _links(threshold: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(key, prints, home):
            order = np.argsort(key, kind="stable")
            key, prints, home = key[order], prints[order], home[order]
            cuts = np.flatnonzero(np.diff(key)) + 1
            edges = []
            starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(key)]))
            for a, b in zip(starts[stops - starts > 1], stops[stops - starts > 1]):
                edges += links_at(prints[a:b], home[a:b], threshold)
            if edges:
                e = np.array(edges, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["src", "dst"])

        # The rows come sorted by anchor; the last anchor of a batch may go on in the next.
        rest: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False)]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            done = now[0] != now[0][-1]
            yield from emit(*[x[done] for x in now])
            rest = [x[~done] for x in now]
        if rest is not None:
            yield from emit(*rest)

    return of


def fingerprint_links(distinct: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(src, dst): links between distinct fingerprints ``fp``, at least those that hold each
    component together. Every link spans at most ``threshold`` bits."""
    if threshold not in (1, 2):
        raise ValueError("the anchors cover one or two bits")
    placed = distinct.select("fp").mapInArrow(_replicas, "anchor long, fp long, home boolean")
    placed = placed.repartition("anchor").sortWithinPartitions("anchor")
    return placed.mapInArrow(_links(threshold), "src long, dst long").distinct()


def _rooted(rows: DataFrame, shingle: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, fp) of every row, and (fp, root) of every distinct fingerprint: equal roots, one component."""
    prints = stored(rows.mapInArrow(_fingerprints(shingle), "doc_id long, fp long, mark long"), "fingerprints")
    distinct = stored(prints.select("fp").distinct(), "distinct-prints")
    found = component_minima(stored(fingerprint_links(distinct, threshold), "links"))
    # The rest stand alone.
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints, stored(rooted, "roots")


def read(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string").alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, text_mark(F.col("text")).alias("mark"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the smallest
    doc_id that links lead to, its own included).

    A null or empty text has fingerprint zero and links like any other. Repeated rows each get a
    row. A null doc_id never is a component_id unless its component has no other id. Other columns
    are ignored; an empty table gives an empty result.
    """
    prints, rooted = _rooted(read(docs), shingle, threshold)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")).join(rooted, "fp")
    least = first.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = stored(first.join(least, "root").select("fp", "component_id"), "components")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, prints: DataFrame, rooted: DataFrame) -> DataFrame:
    """The row of ``docs`` with the smallest doc_id of each component: ``prints`` (doc_id, mark, fp) per row, ``rooted`` (fp, root)."""
    rows = prints.groupBy("fp", "doc_id", "mark").agg(F.count(F.lit(1)).alias("copies"))
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark", "copies")).alias("best")
    chosen = rows.groupBy("fp").agg(best).join(rooted, "fp").groupBy("root").agg(F.min("best").alias("best"))
    return only_one(docs, stored(chosen.select("best.doc_id", "best.mark", "best.copies"), "kept"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates: the one with the smallest doc_id.

    Rows are judged one by one, also where they share a doc_id or have none: a null doc_id comes last, and
    of rows with one doc_id a hash of the text decides. Of rows that agree in doc_id and text the least
    by all columns stays. All columns stay; an empty table gives an empty one.
    """
    prints, rooted = _rooted(read(docs), shingle, threshold)
    return one_of_each(docs, prints, rooted)
