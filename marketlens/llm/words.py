"""Words of a batch of texts as numpy arrays, hashed without a Python loop over the words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20  # texts scanned together; a longer text is a chunk of its own
_REACH = 64  # byte positions with a random table of their own

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _random(seed: int, *shape: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, size=shape, dtype=np.uint64)


_TABLES = _random(11, 256, _REACH)
_LONG = _random(12, 1 << 10) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(body: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64 bits for each word; ``body`` holds their bytes in a row, none of them is empty."""
    if not len(sizes):
        return np.zeros(0, dtype=np.uint64)
    inner = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(inner, sizes)
    values = _TABLES[body, place % _REACH]
    if place.max() >= _REACH:
        turn = place // _REACH
        values = mixed(values * _LONG[turn % len(_LONG)] + (turn // len(_LONG)).astype(np.uint64))
    return mixed(np.add.reduceat(values, inner) + sizes.astype(np.uint64))


class Words:
    """The words of some texts, in one row: ``starts`` and ``ends`` in ``flat``, ``doc`` (index of the
    text), ``hashes`` (64 bits, by tables of random numbers per byte and place) and, per text,
    ``first`` (index of its first word; one more entry at the end)."""

    def __init__(self, texts: list[bytes]):
        self.flat = b" ".join([*texts, b""])
        raw = np.frombuffer(self.flat, dtype=np.uint8)
        space = _IS_SPACE[raw]
        edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        bounds = np.cumsum([0, *[len(t) + 1 for t in texts]])
        self.first = np.searchsorted(self.starts, bounds)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hashes = hashed(raw[~space], self.ends - self.starts)

    def __len__(self) -> int:
        return len(self.starts)


def windows(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash for each run of ``size`` words; runs may cross texts (see ``inside``)."""
    n = max(0, len(hashes) - size + 1)
    weights = _random(seed, size) | np.uint64(1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        out += mixed(hashes[j : j + n] ^ weights[j]) * weights[j] if j else hashes[:n] * weights[0]
    return mixed(out)


def inside(words: Words, size: int) -> np.ndarray:
    """Indices of the words at which a run of ``size`` words of one text starts."""
    n = max(0, len(words) - size + 1)
    return np.flatnonzero(words.doc[:n] == words.doc[size - 1 : size - 1 + n]) if n else np.zeros(0, dtype=np.int64)


def chunks(batches: Iterator[pa.RecordBatch], text: int, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``size`` bytes of text each, and their texts (null: empty)."""
    for batch in batches:
        texts = batch.column(text).cast(pa.binary())
        sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + size, side="right")))
            yield batch.slice(at, end - at), [t.as_py() or b"" for t in texts[at:end]]
            at = end
