"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the longest
length as fit, then the binary digits of the rest, longest first. Pieces of equal length form
one bucket, from which batches are drawn; each piece is a sequence of its own, so no sequence
crosses a document and nothing is padded.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import chunks, hashed
from marketlens.sources.workspace import stored

SEQUENCE = 2048  # a power of two
END = 1  # the id that closes a document
CACHED_WORDS = 100_000  # pieces of odd words as Python objects; some 200 bytes each, held until the task ends
HELD_WORDS = 1 << 19  # words in arrays, and as many pieces of words; some 60 bytes each, likewise
TOKENIZED = 8192  # pieces whose tokens are Python objects at a time
CHUNK = 1 << 20  # bytes of text whose distinct words are looked up together


def binary_pieces(n: int, longest: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of each piece of ``n`` ids."""
    out = [(s, longest) for s in range(0, n - n % longest, longest)]
    start, size = n - n % longest, longest >> 1
    while size:
        if n & size:
            out.append((start, size))
            start += size
        size >>= 1
    return out


# How the vocabulary of the query splits a word of ASCII characters. Another vocabulary is
# found out by PROBES, and splits its words by itself.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

LATIN = 0x250  # characters up to here are asked for one by one how they are normalised and split
_LETTER, _DIGIT, _OTHER, _ODD = range(4)

PROBES = "don't we'll've i'm they're she'd 's a1b22c x--y (end.) http://a.b/c?d=e 'tis o'clock a_b #1 UPPER Mixed9".split(" ")


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Encoder:
    """Ids of words. White space always ends a token of this vocabulary and leaves no id, so a text's
    ids are its words' ids in a row; a word's are those of its pieces in a row.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known_split = all(self._own_split(w) == _ASCII_PIECES.findall(w.lower()) for w in PROBES)
        self.forget()
        self.kind, self.norm = self._characters()

    def forget(self) -> None:
        """Drop all words: a worker outlives its task, and other stages run in it."""
        # Ids are kept as bytes: joined at once, and of no interest to the garbage collector.
        self.pieces: dict[str, bytes] = {}
        self.held, self.held_pieces = _Held(), _Held()
        pa.default_memory_pool().release_unused()

    def _own_split(self, word: str) -> list[str]:
        norm = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(norm)]

    def _characters(self) -> tuple[np.ndarray, np.ndarray]:
        """(kind, normalised) of each character below ``LATIN``; the last entry is for all others."""
        kind, norm = np.full(LATIN + 1, _ODD, dtype=np.uint8), np.zeros(LATIN + 1, dtype=np.uint32)
        for at in range(0x21, LATIN) if self.known_split else ():
            c = chr(at)
            low = self.tokenizer.normalizer.normalize_str(c) if self.tokenizer.normalizer else c
            if c in "'|" or c.isspace() or not c.isprintable() or len(low) != 1 or not 0x20 < ord(low) < LATIN:
                continue  # contractions and special tokens among them
            norm[at] = ord(low)
            if at < 0x80:
                kind[at] = _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _OTHER
            elif len(self._own_split(f"a{c}{c}b")) == 1:
                kind[at] = _LETTER
            elif len(self._own_split(f"a{c}.{c}{c}b")) == 3:
                kind[at] = _OTHER
        return kind, norm

    def encode(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, begins, sizes) of the ids of some words; those of known characters are cut into pieces all at once."""
        listed = words.to_pylist()
        chars = np.frombuffer(b" ".join(listed).decode().encode("utf-32-le"), dtype="<u4")
        gap = chars == 0x20
        word, known = np.cumsum(gap), np.minimum(chars, LATIN)
        odd = np.zeros(len(listed), dtype=bool)
        odd[word[~gap & (self.kind[known] == _ODD)]] = True
        use = np.flatnonzero(~gap & ~odd[word])
        kind, norm, word = self.kind[known[use]], self.norm[known[use]], word[use]
        start = np.ones(len(use), dtype=bool)
        start[1:] = (word[1:] != word[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        first = np.flatnonzero(start)
        ends = np.concatenate(([0], np.cumsum(1 + (norm >= 0x80))))  # in UTF-8
        offsets = np.append(ends[first], ends[-1]).astype(np.int64)
        body = norm.astype("<u4").tobytes().decode("utf-32-le").encode()
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body)])
        pieces = pieces.dictionary_encode()
        begins, sizes = self.held_pieces.look_up(pieces.dictionary, self._tokens)
        which = pieces.indices.to_numpy()
        flat = gathered(self.held_pieces.flat, begins[which], sizes[which])
        self.held_pieces.trim()
        out = np.bincount(word[first], weights=sizes[which], minlength=len(listed)).astype(np.int64)
        at = np.cumsum(out) - out
        if odd.any():
            lists = self.ids([listed[k] for k in np.flatnonzero(odd)])
            out[odd] = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)) // 4
            at[odd] = len(flat) + np.cumsum(out[odd]) - out[odd]
            flat = np.concatenate((flat, np.frombuffer(b"".join(lists), dtype="<u4")))
        return flat, at, out

    def _tokens(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tokenize, forms = self.tokenizer.model.tokenize, [p.decode() for p in pieces.to_pylist()]
        wide = [k for k, p in enumerate(forms) if not p.isascii()]  # the splitter may write their bytes as other characters
        split = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(" ".join(forms[k] for k in wide))]
        for k, p in zip(wide, split if len(split) == len(wide) else ["".join(self._own_split(forms[k])) for k in wide]):
            forms[k] = p
        flat, sizes = [np.zeros(0, dtype="<u4")], np.zeros(len(forms), dtype=np.int64)
        for at in range(0, len(forms), TOKENIZED):
            found = [tokenize(p) for p in forms[at : at + TOKENIZED]]
            sizes[at : at + len(found)] = list(map(len, found))
            flat.append(np.array([t.id for tokens in found for t in tokens], dtype="<u4"))
        return np.concatenate(flat), np.cumsum(sizes) - sizes, sizes

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces[piece] = _packed_ids([t.id for t in self.tokenizer.model.tokenize(piece)])
        return ids

    def _learn(self, words: list[bytes]) -> Iterator[bytes]:
        """Normalise and split many words in one call; spaces keep them apart."""
        norm = self.tokenizer.normalizer.normalize_str(" ".join(w.decode() for w in words))
        ends = iter([*(i for i, c in enumerate(norm) if c == " "), len(norm)])
        done, end, now = 0, next(ends), b""
        for piece, (start, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(norm):
            while start >= end:
                yield now
                done, end, now = done + 1, next(ends), b""
            now += self.pieces.get(piece) or self._piece(piece)
        for _ in range(done, len(words)):
            yield now
            now = b""

    def ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of odd words, one by one."""
        if len(self.pieces) > CACHED_WORDS:
            self.pieces = {}
        known = self.pieces
        # What may hold a special token, or white space of another script, is encoded as it stands.
        odd = {w for w in words if b"<|" in w or (not w.isascii() and w.decode().split() != [w.decode()])}
        out: list[bytes] = []
        plain = []
        for at, (w, lower) in enumerate(zip(words, b"\n".join(words).decode().lower().split("\n"))):
            ids = b""
            if w in odd:
                ids = _packed_ids(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids)
            elif not (self.known_split and w.isascii() and lower.isprintable()):
                plain.append(at)
            elif lower.isalpha():
                ids = known.get(lower) or self._piece(lower)
            else:
                for piece in _ASCII_PIECES.findall(lower):
                    ids += known.get(piece) or self._piece(piece)
            out.append(ids)
        if plain:
            for at, ids in zip(plain, self._learn([words[at] for at in plain])):
                out[at] = ids
        return out


class _Held:
    """Words and their ids as arrays, in the order of the words' hashes. A hash only leads to a word; the words
    themselves are compared. Beyond ``HELD_WORDS``, the half that was met last stays."""

    def __init__(self):
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.words = pa.array([], pa.large_binary())
        self.begins, self.sizes, self.met = (np.zeros(0, dtype=np.int64) for _ in range(3))  # ids in ``flat``; last turn
        self.flat = np.zeros(0, dtype="<u4")
        self.turn = 0

    def look_up(self, words: pa.LargeBinaryArray, encode: Callable) -> tuple[np.ndarray, np.ndarray]:
        """(begins, sizes) in ``flat`` of the ids of some distinct words; ``encode`` gives (flat, begins, sizes) of new ones."""
        self.turn += 1
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        body = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        hashes = hashed(body, np.diff(offsets))
        begins, sizes = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        new = np.ones(len(words), dtype=bool)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            taken = self.hashes[at] == hashes
            new = ~(taken & pc.equal(self.words.take(pa.array(at)), words).to_numpy(zero_copy_only=False))
            begins[~new], sizes[~new] = self.begins[at[~new]], self.sizes[at[~new]]
            self.met[at[~new]] = self.turn
        else:
            taken = ~new
        found = np.flatnonzero(new)
        if len(found):
            more, at, sizes[found] = encode(words.take(pa.array(found)))
            begins[found] = len(self.flat) + at
            self.flat = np.concatenate((self.flat, more))
            _, first = np.unique(hashes, return_index=True)  # two words of one hash: the first is held
            first = first[~taken[first]]
            self._add(hashes[first], words.take(pa.array(first)), begins[first], sizes[first])
        return begins, sizes

    def _add(self, hashes: np.ndarray, words: pa.LargeBinaryArray, begins: np.ndarray, sizes: np.ndarray) -> None:
        every = np.concatenate((self.hashes, hashes))
        order = np.argsort(every, kind="stable")
        self.hashes, self.words = every[order], pa.concat_arrays([self.words, words]).take(pa.array(order))
        self.begins, self.sizes = np.concatenate((self.begins, begins))[order], np.concatenate((self.sizes, sizes))[order]
        self.met = np.concatenate((self.met, np.full(len(hashes), self.turn)))[order]

    def trim(self) -> None:
        """Forget the words that were not met for longest, if there are too many."""
        if len(self.hashes) <= HELD_WORDS:
            return
        stay = np.sort(np.argsort(self.met, kind="stable")[-(HELD_WORDS // 2) :])
        self.hashes, self.words, self.met = self.hashes[stay], self.words.take(pa.array(stay)), self.met[stay]
        self.flat = gathered(self.flat, self.begins[stay], self.sizes[stay])
        self.sizes = self.sizes[stay]
        self.begins = np.cumsum(self.sizes) - self.sizes


def gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` in a row."""
    ends = np.cumsum(sizes)
    return flat[np.arange(sizes.sum()) + np.repeat(begins - (ends - sizes), sizes)]


def _encoder(path: str) -> _Encoder:
    """This worker's encoder. Workers are reused: the next task finds the vocabulary read, but no words."""
    kept = sys.modules.setdefault("_marketlens_packing", types.ModuleType("_marketlens_packing"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.encoder = path, _Encoder(path)
    return kept.encoder


_SPACE_FOLD = np.arange(256, dtype=np.uint8)
_SPACE_FOLD[[0x20, *range(0x09, 0x0E)]] = 0x20


def _split(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of some texts in a row, and the index of each text's first one (one more at the end)."""
    raw = _SPACE_FOLD[np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)]
    gap = raw == 0x20
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    first = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for t in texts]]))
    offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int64)
    body = pa.py_buffer(raw[~gap].tobytes())
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), body])
    return words.dictionary_encode(), first


def _encoded(encoder: _Encoder, texts: list[bytes]) -> list[np.ndarray]:
    """The ids of each text: every distinct word of the chunk is looked up once."""
    words, first = _split(texts)
    begins, sizes = encoder.held.look_up(words.dictionary, encoder.encode)
    which = words.indices.to_numpy()
    ids = gathered(encoder.held.flat, begins[which], sizes[which])
    encoder.held.trim()
    cuts = np.concatenate(([0], np.cumsum(sizes[which])))[first]
    return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _pieces(place: Callable[[], str], longest: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(place()), np.array([END], dtype="<u4")
        for batch, texts in chunks(batches, 1, CHUNK):
            doc, start, length, crc, total, ids_out = [], [], [], [], [], []
            for doc_id, body in zip(batch.column(0).to_pylist(), _encoded(encoder, texts)):
                ids = np.concatenate((body, end))
                for s, n in binary_pieces(len(ids), longest):
                    piece = ids[s : s + n]
                    doc.append(doc_id)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
                    if with_ids:
                        ids_out.append(piece.astype("int32"))
            cols = [pa.array(doc, pa.int64()), *[pa.array(c, pa.int64()) for c in (start, length, crc, total)]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols, names = [*cols, pa.array(ids_out, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
        encoder.forget()

    return cut


def packed(docs: DataFrame, place: Callable[[], str], longest: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and on
    request the ids themselves.

    ``place`` gives the path of the vocabulary and is called in every task. The pieces are stored in one
    folder per ``length``, the buckets: a reader of one length reads that bucket alone.
    A null or empty text has the closing id alone. Every row of ``docs`` is packed, repeated ids and
    null ids too; other columns are ignored; an empty table gives no piece. White space here is
    what the vocabulary drops; ids do not depend on where a text is split at it.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest sequence must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The table is fixed once written, so row numbers over its files stay the same on a retry.
    pieces = stored(rows.mapInArrow(_pieces(place, longest, with_ids), schema), "pieces", by=["length"])
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
