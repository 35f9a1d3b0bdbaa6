"""Token counts by the whole-token shortcut.

A sentencepiece BPE model turns spaces into a mark, puts one mark before the text and merges
neighbours as long as the union is a piece. No merge crosses a place at which no piece of the
vocabulary has those two characters next to each other. Two such places are proved from the
vocabulary itself, before any text is read:

* before a run of marks, if no piece holds a mark after another character;
* on both sides of a character that occurs in no piece of two or more characters (a line break, as a rule).

Between these places lie the pre-tokens; a text's count is the sum of theirs. Which strings of the
vocabulary encode alone as one token is proved in the same way, by encoding each of them once. A
pre-token among them counts one without any merging; only the others go to the model, each distinct
one once per task. A vocabulary for which the proof fails (another normaliser, pieces that cross
words, symbols of the user's own) is counted by the model over whole texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from sentencepiece import SentencePieceProcessor

LIMIT = 4096
MARK = "▁"
BREAK = "\n"
CHUNK = 4 << 20  # bytes of text whose distinct pre-tokens are looked up together
MERGED = 400_000  # merged pre-tokens remembered by a task
LONGEST = 64  # characters of a pre-token that is remembered
_PLAIN, _BYTE, _KNOWN_TYPES = 1, 6, {1, 2, 3, 6}  # fixed values: piece types of the model file


@dataclass(frozen=True)
class Shortcut:
    """What was proved of a vocabulary. ``whole``: strings without their leading mark that with it are
    one token, and strings after BREAK that are one token, each with its count of tokens."""

    whole: dict[str, int]
    break_tokens: int  # of BREAK itself


def prove(path: str) -> Shortcut | None:
    """The shortcut that holds for the vocabulary at ``path``, or None if the proof fails."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece.sentencepiece_model_pb2 import ModelProto

    model = ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm = model.normalizer_spec
    plain = [p.piece for p in model.pieces if p.type == _PLAIN]
    sure = (
        model.trainer_spec.model_type == model.trainer_spec.BPE
        and not norm.precompiled_charsmap
        and not norm.normalization_rule_tsv
        and norm.add_dummy_prefix
        and norm.escape_whitespaces
        and not norm.remove_extra_whitespaces
        and not model.trainer_spec.treat_whitespace_as_suffix
        and {p.type for p in model.pieces} <= _KNOWN_TYPES
        and not any(MARK in p.lstrip(MARK) for p in plain)
        and not any(BREAK in p and len(p) > 1 for p in plain)
    )
    if not sure:
        return None
    encoder = SentencePieceProcessor(model_file=path)
    bare = len(encoder.encode(BREAK))  # the mark before it and its own tokens
    own = len(encoder.encode(BREAK * 2)) - bare
    marked = [p[1:] for p in plain if p.startswith(MARK) and not p.startswith(MARK * 2) and len(p) > 1]
    inner = [BREAK + p for p in plain if not p.startswith(MARK)]
    whole = {p: 1 for p, n in zip(marked, _sizes(encoder, marked)) if n == 1}
    whole |= {p: own + 1 for p, n in zip(inner, _sizes(encoder, inner)) if n == bare + 1}
    return Shortcut(whole, own)


def _sizes(encoder: SentencePieceProcessor, texts: list[str]) -> list[int]:
    return [len(ids) for ids in encoder.encode(texts, num_threads=1)]


class _Counter:
    """Tokens of pre-tokens: proved, remembered or merged."""

    def __init__(self, encoder: SentencePieceProcessor, shortcut: Shortcut):
        self.encoder, self.shortcut = encoder, shortcut
        self.known = dict(shortcut.whole)
        self.lead = len(encoder.encode(BREAK)) - shortcut.break_tokens  # the mark put before a text

    def _merge(self, words: list[str]) -> list[int]:
        """Tokens of pre-tokens, written without their own mark; those that begin with BREAK have none."""
        return [n - self.lead * w.startswith(BREAK) for w, n in zip(words, _sizes(self.encoder, words))]

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > len(self.shortcut.whole) + MERGED:
            known = self.known = dict(self.shortcut.whole)
            new = [w for w in words if w not in known]
        merged = dict(zip(new, self._merge(new)))
        known.update((w, n) for w, n in merged.items() if len(w) <= LONGEST)
        return np.fromiter((known[w] if w in known else merged[w] for w in words), dtype=np.int64, count=len(words))

    def marks(self, n: int) -> int:
        """Tokens of ``n`` marks that no word follows."""
        return len(self.encoder.encode(" " * (n - 1) + BREAK)) - self.shortcut.break_tokens

    def texts(self, texts: pa.Array) -> np.ndarray:
        """The tokens of each text of an Arrow array of strings without nulls."""
        if pc.any(pc.match_substring(texts, MARK)).as_py():
            texts = pc.replace_substring(texts, MARK, " ")
        # A break starts a pre-token without a mark: the space put before it only separates.
        parts = pc.split_pattern(pc.replace_substring(texts, BREAK, " " + BREAK), " ")
        cuts = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        tokens = self.of(words)[codes] if words else np.zeros(0, dtype=np.int64)
        if "" in words:
            self._runs(words, codes, cuts, tokens)
        sums = np.concatenate(([0], np.cumsum(tokens)))
        return np.where(pc.equal(texts, "").to_numpy(zero_copy_only=False), 0, sums[cuts[1:]] - sums[cuts[:-1]])

    def _runs(self, words: list[str], codes: np.ndarray, cuts: np.ndarray, tokens: np.ndarray) -> None:
        """Runs of spaces: empty parts are marks that belong to the word after them, if one follows."""
        empty = codes == words.index("")
        tokens[empty] = 0
        first = np.zeros(len(codes) + 1, dtype=bool)
        first[cuts[:-1]] = True
        starts = np.flatnonzero(empty & (first[:-1] | ~np.concatenate(([False], empty[:-1]))))
        stops = np.flatnonzero(empty & (first[1:] | ~np.concatenate((empty[1:], [False]))) | empty & (np.arange(len(codes)) == len(codes) - 1)) + 1
        breaks = np.fromiter((w.startswith(BREAK) for w in words), dtype=bool, count=len(words))
        nexts = np.append(codes, 0)[stops]
        alone = np.append(first[:-1], True)[stops] | breaks[nexts]
        runs = stops - starts
        kinds, which = np.unique(np.stack([runs, np.where(alone, -1, nexts)]), axis=1, return_inverse=True)
        which = which.ravel()
        sizes = np.zeros(kinds.shape[1], dtype=np.int64)
        joined = kinds[1] >= 0
        sizes[joined] = self.of([" " * int(n) + words[c] for n, c in kinds.T[joined]])
        sizes[~joined] = [self.marks(int(n)) for n in kinds[0][~joined]]
        tokens[np.where(alone, starts, stops)] = sizes[which]


def _counted(place: Callable[[], str], proved, whole_texts: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        encoder = SentencePieceProcessor(model_file=place())
        counter = None if whole_texts else _Counter(encoder, proved.value)
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK, side="right")))
                part = batch.slice(at, end - at)
                texts = part.column(1)
                n = counter.texts(texts) if counter else np.array(_sizes(encoder, texts.to_pylist()))
                cols = [part.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_tokens"])
                at = end

    return count


def token_counts(docs: DataFrame, place: Callable[[], str], limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    ``place`` gives the path of a sentencepiece model; it is called on the driver for the proof and in
    every task. Null and empty texts have no bytes and no tokens. Strings of control symbols within
    texts are ordinary text. Repeated rows, repeated ids and null ids each get their row; other columns
    are ignored; an empty table gives an empty result. Nothing is shuffled; what every task holds is
    bounded by the vocabulary, by MERGED short pre-tokens and by the texts of one chunk.
    """
    shortcut = prove(place())
    proved = docs.sparkSession.sparkContext.broadcast(shortcut)  # at most one entry per piece
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    counted = rows.mapInArrow(_counted(place, proved, shortcut is None), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
