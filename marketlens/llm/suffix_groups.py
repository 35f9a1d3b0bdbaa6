"""Substring dedup by prefix-partitioned suffix trees.

Every word starts a suffix. Suffixes are split into groups by a prefix of variable length: one
word where few suffixes start with it, more words where many do, so that a group fits into memory
and equal suffixes always share a group. A group's subtree is read off its suffixes in sorted
order: a deep internal node, one below which suffixes agree on at least ``depth`` words, is a
run of equal digests of the first ``depth`` words. Adjacent repeated suffixes of a document are one
longer repeat, so merging them gives the maximal repeats.

Suffixes of one group are compared by 64 bits of digest, besides the prefix that makes the group.
A node with more suffixes than a group may hold cannot be split by any prefix. For such hot nodes
only the smallest doc_id is gathered, with a combine in each task, and their suffixes are judged
where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketlens.llm.common import only
from marketlens.llm.words import Words, chunks, inside, windows
from marketlens.sources.workspace import stored

DEPTH = 13
GROUP = 1_500_000  # suffixes in a group: about 150 MB while its subtree is read
SLOTS = 1 << 16  # classes of prefixes of one length, at least; more for a corpus of many groups
BROADCAST_IDS = 4_000_000  # ids of affected documents that are broadcast, 8 bytes each
FAN = 256  # groups that a task writes to at once
RESPLIT = 4_000_000  # suffixes held while groups are split again
HOT = -1  # the group of suffixes that are known to repeat
LAST = (1 << 63) - 1  # a null doc_id comes after all others


def prefix_lengths(depth: int) -> list[int]:
    """Lengths of the prefixes tried, in words: 1, 2, 4 and so on, then the whole depth."""
    out = [1]
    while out[-1] * 2 < depth:
        out.append(out[-1] * 2)
    return [*out, depth] if depth > 1 else out


def _slots(words: Words, at: np.ndarray, length: int, slots: int) -> np.ndarray:
    return (windows(words.hashes, length, 100 + length)[at] % np.uint64(slots)).astype(np.int64)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(LAST).to_numpy()


def _counts(depth: int, slots: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = prefix_lengths(depth)
        totals = np.zeros((len(lengths), slots), dtype=np.int64)
        for _, texts in chunks(batches, 1):
            words = Words(texts)
            at = inside(words, depth)
            for k, length in enumerate(lengths):
                totals[k] += np.bincount(_slots(words, at, length, slots), minlength=slots)
        level, slot = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(level, pa.int64()), pa.array(slot, pa.int64()), pa.array(totals[level, slot])], names=["level", "slot", "n"]
        )

    return of


class Groups:
    """Which group a suffix belongs to: the first prefix length whose class is small enough decides;
    small classes share a group."""

    def __init__(self, counts: np.ndarray, depth: int, group: int):
        self.lengths, self.fits = prefix_lengths(depth), counts <= max(1, group // 4)  # so that groups come out alike
        self.bins = max(1, -(-int(counts[0].sum()) // group))

    def place(self, words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The group of each suffix, and whether even its longest prefix is in too large a class."""
        out, crowded = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=bool)
        open_ = np.arange(len(at))
        for level, length in enumerate(self.lengths):
            slots = _slots(words, at[open_], length, self.fits.shape[1])
            out[open_] = (slots + level * 7919) % self.bins
            open_ = open_[~self.fits[level, slots]]
            if not len(open_):
                break
        crowded[open_] = True
        return out, crowded


def _digests(words: Words, at: np.ndarray, depth: int) -> np.ndarray:
    return windows(words.hashes, depth, 7)[at]


def _keys(texts: list[bytes]) -> np.ndarray:
    """Tells rows with the same doc_id apart."""
    return np.array([xxh64_intdigest(t) & 0xFFFFFFFF for t in texts], dtype=np.int64)


def _hot(groups, depth: int):
    """(digest, least, n) of the suffixes in classes that no prefix makes small enough."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 1):
            words = Words(texts)
            at = inside(words, depth)
            at = at[groups.place(words, at)[1]]
            if len(at):
                digest, doc = _digests(words, at, depth), _ids(batch)[words.doc[at]]
                order = np.lexsort((doc, digest))
                digest, doc = digest[order], doc[order]
                new = np.flatnonzero(np.concatenate(([True], digest[1:] != digest[:-1])))
                n = np.diff(np.concatenate((new, [len(digest)])))
                yield pa.RecordBatch.from_arrays([pa.array(digest[new].view(np.int64)), pa.array(doc[new]), pa.array(n)], names=["digest", "least", "n"])

    return of


_SUFFIXES = "grp long, ids binary, keys binary, counts binary, at binary, digests binary, fine binary"


def _narrow(values: np.ndarray) -> bytes:
    """Numbers from their least one on, in as few bytes as the largest needs."""
    base = values.min() if len(values) else np.int64(0)
    # Unsigned, so that a span of more than half the range still fits.
    span = values.astype(np.int64).view(np.uint64) - np.int64(base).astype(np.uint64)
    kind = next(k for k in (np.uint16, np.uint32, np.uint64) if not len(span) or span.max() <= np.iinfo(k).max)
    return np.int64(base).tobytes() + span.astype(kind).tobytes()


def _wide(packed: bytes, n: int) -> np.ndarray:
    kind = {2: np.uint16, 4: np.uint32, 8: np.uint64}[(len(packed) - 8) // max(n, 1) or 2]
    span = np.frombuffer(packed, kind, offset=8).astype(np.uint64)
    return (span + np.frombuffer(packed, np.int64, 1).astype(np.uint64)).view(np.int64)


def _packed(group: np.ndarray, ids: np.ndarray, keys: np.ndarray, at: np.ndarray, digest: np.ndarray, fine: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """One row per group: its documents (ids and keys, with the number of their suffixes), and the
    suffixes' word numbers in the document, digests and, if they are to be split again, final groups."""
    order = np.lexsort((keys, ids, group))
    group, ids, keys, at, digest = group[order], ids[order], keys[order], at[order], digest[order]
    rows = []
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)])) if len(group) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        new = np.flatnonzero(np.concatenate(([True], (np.diff(ids[a:b]) != 0) | (np.diff(keys[a:b]) != 0))))
        counts = np.diff(np.concatenate((new, [b - a])))
        arrays = (_narrow(ids[a:b][new]), keys[a:b][new].astype(np.uint32).tobytes(), _narrow(counts), _narrow(at[a:b]), digest[a:b].tobytes())
        rows.append((int(group[a]), *arrays, fine[order][a:b].astype(np.uint32).tobytes() if fine is not None else b""))
    if rows:
        names = ["grp", "ids", "keys", "counts", "at", "digests", "fine"]
        cols = [pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 7)]]
        yield pa.RecordBatch.from_arrays(cols, names=names)


def _unpacked(row: dict) -> tuple[np.ndarray, ...]:
    """(ids, keys, word numbers, digests, final groups), one of each per suffix."""
    keys, digests = np.frombuffer(row["keys"], np.uint32).astype(np.int64), np.frombuffer(row["digests"], np.uint64)
    counts = _wide(row["counts"], len(keys))
    ids = np.repeat(_wide(row["ids"], len(keys)), counts)
    return ids, np.repeat(keys, counts), _wide(row["at"], len(digests)), digests, np.frombuffer(row["fine"], np.uint32)


def _suffixes(groups, hot, depth: int, width: int):
    """The suffixes of a task by group, ``width`` final groups taken together; group HOT has those
    of hot nodes that a smaller doc_id has too."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, least = hot
        for batch, texts in chunks(batches, 1):
            words = Words(texts)
            at = inside(words, depth)
            if not len(at):
                continue
            (fine, _), digest, ids = groups.place(words, at), _digests(words, at, depth), _ids(batch)
            coarse = fine // width
            if len(digests):
                near = np.minimum(np.searchsorted(digests, digest), len(digests) - 1)
                known = digests[near] == digest
                coarse[known] = HOT
                keep = ~known | (least[near] < ids[words.doc[at]])
                at, fine, coarse, digest = at[keep], fine[keep], coarse[keep], digest[keep]
            doc = words.doc[at]
            yield from _packed(coarse, ids[doc].astype(np.int64), _keys(texts)[doc], at - words.first[doc], digest, fine if width > 1 else None)

    return of


def _resplit(width: int):
    """Rows sorted by group, each group split into final groups, ``width`` of them taken together."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size, now = 0, None

        def emit() -> Iterator[pa.RecordBatch]:
            if held:
                ids, keys, at, digest, fine = (np.concatenate(x) for x in zip(*held))
                yield from _packed(fine.astype(np.int64) // width, ids, keys, at, digest, fine if width > 1 else None)

        for batch in batches:
            for row in batch.to_pylist():
                if row["grp"] == HOT:
                    yield pa.RecordBatch.from_pylist([row])
                    continue
                if row["grp"] != now or size > RESPLIT:
                    yield from emit()
                    held, size, now = [], 0, row["grp"]
                held.append(_unpacked(row))
                size += len(held[-1][0])
        yield from emit()

    return of


_REPEATS = "doc_id long, key long, block int, mask long"


def _bits(ids: np.ndarray, keys: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """A row per repeated suffix: its place as one bit of a block of 64."""
    order = np.lexsort((at, keys, ids))
    at = at[order]
    mask = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[order]), pa.array(keys[order]), pa.array((at >> 6).astype(np.int32)), pa.array(mask)], names=["doc_id", "key", "block", "mask"]
    )


def _subtree(group: pa.Table) -> pa.Table:
    """Suffixes of one group below a deep node that also has a suffix of a smaller doc_id."""
    ids, keys, at, digest, _ = (np.concatenate(x) for x in zip(*[_unpacked(r) for r in group.to_pylist()]))
    order = np.lexsort((ids, digest))
    digest, ids, keys, at = digest[order], ids[order], keys[order], at[order]
    new = np.concatenate(([True], digest[1:] != digest[:-1]))
    least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]  # the node's first suffix has its smallest doc_id
    again = ids > least
    return pa.Table.from_batches([_bits(ids[again], keys[again], at[again])])


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _bits(*_unpacked(row)[:3])


def places(blocks: list[int], masks: list[int]) -> np.ndarray:
    """Word numbers from blocks of 64 bits."""
    bits = np.unpackbits(np.array(masks, dtype="<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return np.array(blocks, dtype=np.int64)[row] * 64 + bit


def repeats(docs: DataFrame, depth: int = DEPTH, group: int = GROUP, fan: int = FAN) -> DataFrame:
    """(doc_id, key, block, mask): the places, as bits, of runs of ``depth`` words that also start in a
    document with a smaller doc_id. ``key`` is a hash of the text; a null doc_id is given as LAST."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one row; a word takes two bytes at least
    slots = max(SLOTS, 1 << (size // 2 // group).bit_length())
    counted = rows.mapInArrow(_counts(depth, slots), "level long, slot long, n long").groupBy("level", "slot").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(prefix_lengths(depth)), slots), dtype=np.int64)
    table = counted.toPandas()  # at most ``slots`` rows for each prefix length
    counts[table["level"], table["slot"]] = table["n"]
    groups = Groups(counts, depth, group)
    hot, crowded = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)), bool((counts[-1] > max(1, group // 4)).any())
    if crowded:
        found = rows.mapInArrow(_hot(groups, depth), "digest long, least long, n long").groupBy("digest")
        found = found.agg(F.min("least").alias("least"), F.sum("n").alias("n")).filter(F.col("n") > group // 8)
        found = found.toPandas()  # fewer than eight times as many as groups
        digests = found["digest"].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.argsort(digests)
        hot = digests[order], found["least"].to_numpy(dtype=np.int64)[order]
    # A task writes to at most ``fan`` groups at once; more groups are reached in several exchanges.
    width = 1
    while groups.bins > width * fan:
        width *= fan
    suffixes = rows.mapInArrow(_suffixes(groups, hot, depth, width), _SUFFIXES)
    while width > 1:
        width //= fan
        suffixes = suffixes.repartition("grp").sortWithinPartitions("grp").mapInArrow(_resplit(width), _SUFFIXES)
    if not crowded:
        return suffixes.groupBy("grp").applyInArrow(_subtree, _REPEATS)
    suffixes = stored(suffixes, "suffixes")
    known = suffixes.filter(F.col("grp") == HOT).mapInArrow(_known, _REPEATS)
    return suffixes.filter(F.col("grp") != HOT).groupBy("grp").applyInArrow(_subtree, _REPEATS).unionByName(known)


def covered(positions: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Which of ``n`` words a run of ``depth`` words at one of the positions covers."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, positions, 1)
    np.add.at(edge, positions + depth, -1)
    return np.cumsum(edge[:n]) > 0


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document as if nothing were removed."""
    for batch, texts in chunks(batches, 1):
        words = [t.split() for t in texts]
        sha = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(_keys(texts)), pa.array([len(w) for w in words], pa.int64()), pa.array(sha)],
            names=["doc_id", "key", "n_words", "kept_sha256"],
        )


def _cut(depth: int):
    """(doc_id, key, text, blocks, masks) to (doc_id, key, kept text, n_removed, digest)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, 2):
            kept, removed = [], []
            for text, blocks, masks in zip(texts, batch.column(3), batch.column(4)):
                words = text.split()
                gone = covered(places(blocks.as_py(), masks.as_py()), len(words), depth)
                kept.append(b" ".join([w for w, g in zip(words, gone) if not g]))
                removed.append(int(gone.sum()))
            sha = [hashlib.sha256(k).hexdigest() for k in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(removed, pa.int64()), pa.array(sha)],
                names=["doc_id", "key", "kept", "n_removed", "sha"],
            )

    return of


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches, 1):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_keys(texts)), batch.column(1)], names=["doc_id", "key", "text"])


def cut_texts(docs: DataFrame, depth: int = DEPTH, group: int = GROUP, fan: int = FAN) -> DataFrame:
    """(doc_id, key, kept, n_removed, sha) of the documents that lose words, one row per distinct text."""
    found = repeats(docs, depth, group, fan)
    blocks = found.groupBy("doc_id", "key", "block").agg(F.bit_or("mask").alias("mask"))
    lists = blocks.groupBy("doc_id", "key").agg(F.collect_list(F.struct("block", "mask")).alias("blocks"))  # of one document
    lists = stored(lists.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id"))), "repeats")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = lists.select("doc_id").distinct()
    if ids.count() <= BROADCAST_IDS:  # beyond, the join below shuffles the texts of all documents
        rows = only(rows, F.broadcast(stored(ids, "affected")))
    rows = rows.mapInArrow(_with_key, "doc_id long, key long, text string").dropDuplicates(["doc_id", "key"])
    hit = rows.join(lists, rows["doc_id"].eqNullSafe(lists["doc_id"]) & (rows["key"] == lists["key"]))
    hit = hit.select(rows["doc_id"], rows["key"], "text", F.col("blocks.block").alias("blocks"), F.col("blocks.mask").alias("masks"))
    return hit.mapInArrow(_cut(depth), "doc_id long, key long, kept string, n_removed long, sha string")


def repeated_words_removed(docs: DataFrame, depth: int = DEPTH, group: int = GROUP, fan: int = FAN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A word is removed if a run of ``depth`` words covers it that also starts in a document with a
    smaller doc_id; runs are judged on the input. Words are separated by ASCII white space. A null
    text has no words and the digest of the empty text. Rows with the same doc_id are never each
    other's earlier copy; a null doc_id comes after all others. Other columns are ignored; an empty
    table gives an empty result.
    """
    cut = stored(cut_texts(docs, depth, group, fan).drop("kept"), "cut")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    whole = rows.mapInArrow(_whole, "doc_id long, key long, n_words long, kept_sha256 string")
    out = whole.join(cut, whole["doc_id"].eqNullSafe(cut["doc_id"]) & (whole["key"] == cut["key"]), "left")
    return out.select(
        whole["doc_id"],
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("sha", "kept_sha256").alias("kept_sha256"),
    )
