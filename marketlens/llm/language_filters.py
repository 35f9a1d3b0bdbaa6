"""Language identification by bit-sliced Bloom filters of n-grams.

The n-grams of every language are counted over all documents of the learning part. A language's
filter holds the n-grams that are about as frequent in it as in any other. The filters of all
languages share their hash functions and are stored bit-sliced: one machine word per slot, with
one bit per language. Reading the slots of an n-gram and intersecting them gives the mask of all
languages that hold it. Per document the bits are counted by language and corrected for the false
positives that the filter's fill leads one to expect; the largest corrected count decides.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import id_remainder
from marketlens.llm.words import chunks
from marketlens.sources.workspace import stored

GRAM = 4  # bytes, the space before and after a word included
MIN_SHARE = 2e-6  # of a language's n-grams: bounds its filter to half a million
NEAR = 0.25  # of the highest share in any language
SLOTS_PER_GRAM = 16
PROBES = 3
MAX_LANGUAGES = 64  # bits of a mask
UNSETTLED = 1_000_000  # n-grams of a language that a task holds before it counts them; four bytes each
UNKNOWN = "und"
MIN_SCORE = 0.2  # below, the filtering stage rejects a document

_NO_LETTERS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = [0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35]  # odd


def letters(text: str) -> bytes:
    """The lower-cased text as UTF-8 with one space for whatever is not a letter."""
    return b" %b " % _NO_LETTERS.sub(" ", text.lower()).encode()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the texts in a row (four bytes as a number), and where each text's end.

    An n-gram may start or end with a space but not hold one inside.
    """
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    if len(raw) < GRAM:
        return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
    wide = raw.astype(np.uint32)
    values = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    good = (raw[1:-2] != 32) & (raw[2:-1] != 32)
    upto = np.concatenate(([0], np.cumsum(good)))
    return values[good], upto[np.minimum(bounds[1:], len(good))]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): counts of one task."""
    held: dict[str, list[np.ndarray]] = defaultdict(list)
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def settle(lang: str) -> None:
        values, counts = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        if lang in sums:
            old, n = sums[lang]
            both, where = np.unique(np.concatenate((old, values)), return_inverse=True)
            values, counts = both, np.bincount(where, weights=np.concatenate((n, counts))).astype(np.int64)
        sums[lang] = values, counts

    size: dict[str, int] = defaultdict(int)
    for batch, texts in chunks(batches, 0):
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for lang in dict.fromkeys(langs.tolist()):
            found = grams([letters(texts[i].decode()) for i in np.flatnonzero(langs == lang)])[0]
            held[lang].append(found)
            size[lang] += len(found)
            if size[lang] > UNSETTLED:
                settle(lang)
                size[lang] = 0
    for lang in list(held):
        settle(lang)
    for lang, (values, counts) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64))],
            names=["lang", "gram", "n"],
        )


@dataclass(frozen=True)
class Filters:
    languages: list[str]  # in alphabetical order; the index is the bit
    fallback: int  # the most frequent one
    slots: np.ndarray
    false_rate: np.ndarray  # per language

    def masks(self, values: np.ndarray) -> np.ndarray:
        """The languages that hold each n-gram, one bit for each."""
        bits = np.uint32(32 - int(len(self.slots)).bit_length() + 1)
        out = None
        for m in _MULTIPLIERS[:PROBES]:
            found = self.slots[_slot(values, m, bits)]
            out = found if out is None else out & found
        return out

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: its n-grams, and per language those it holds, corrected for false positives."""
        values, ends = grams(texts)
        starts = np.concatenate(([0], ends[:-1]))
        total = ends - starts
        masks = self.masks(values)
        out = np.zeros((len(texts), len(self.languages)))
        for bit in range(len(self.languages)):
            upto = np.concatenate(([0], np.cumsum(masks >> masks.dtype.type(bit) & masks.dtype.type(1), dtype=np.int64)))
            found = upto[ends] - upto[starts]
            rate = self.false_rate[bit]
            out[:, bit] = np.clip((found - total * rate) / max(1e-9, 1 - rate), 0, None)
        return total, out


def _slot(values: np.ndarray, multiplier: int, shift: np.uint32) -> np.ndarray:
    mixed = (values ^ (values >> np.uint32(15))) * np.uint32(multiplier)
    mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x27D4EB2F)
    return mixed >> shift


def learn(labelled: DataFrame) -> Filters | None:
    """Filters from (text, lang) rows: every row with a text and a language counts. None without any.

    The n-grams that reach the driver are those of the filters: at most 1 / MIN_SHARE for each of
    at most MAX_LANGUAGES languages.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES + 1).collect()}
    if not per_lang:
        return None
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"a mask has {MAX_LANGUAGES} bits; there are more languages")
    counts = stored(rows.mapInArrow(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # one row per language
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total"))
    best = shares.groupBy(F.col("gram").alias("_gram")).agg(F.max("share").alias("best"))
    kept = shares.filter(F.col("share") >= MIN_SHARE).join(best, F.col("gram") == F.col("_gram"))
    kept = kept.filter(F.col("share") >= NEAR * F.col("best")).select("lang", "gram").toPandas()
    languages = sorted(per_lang)
    size = 1 << max(10, int(kept["gram"].nunique() * SLOTS_PER_GRAM).bit_length())
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= np.dtype(k).itemsize * 8)
    slots = np.zeros(size, dtype=kind)
    shift = np.uint32(32 - size.bit_length() + 1)
    for bit, lang in enumerate(languages):
        values = kept.loc[kept["lang"] == lang, "gram"].to_numpy().astype(np.uint32)
        for m in _MULTIPLIERS[:PROBES]:
            slots[_slot(values, m, shift)] |= kind(1 << bit)
    fill = np.array([np.count_nonzero(slots & kind(1 << b)) / size for b in range(len(languages))])
    fallback = max(range(len(languages)), key=lambda b: (per_lang[languages[b]], -b))
    return Filters(languages, fallback, slots, fill**PROBES)


def _predict(filters: Filters | None):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in chunks(batches, 1):
            texts = [t.decode() for t in raw]
            pred = [UNKNOWN] * len(texts)
            score = np.zeros(len(texts))
            if filters is not None:
                total, hits = filters.hits([letters(t) for t in texts])
                best = hits.argmax(axis=1)  # of equal counts the first in alphabetical order
                top = hits[np.arange(len(texts)), best]
                best = np.where(top > 0, best, filters.fallback)
                score = np.clip(np.where(top > 0, top / np.maximum(total, 1), 0.0), 0.0, 1.0)
                lettered = [has_letter(t) for t in texts]
                pred = [filters.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                score = np.where(lettered, score, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return of


def learning_part(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    return docs.filter(id_remainder(F.col("doc_id"), folds) != held_out)


def identified(docs: DataFrame, filters: Filters | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (the share of the text's n-grams that the
    language holds).

    ``und`` with score 0 for a null text, for one without a letter, and for every text if nothing was
    learned. A text with letters but no known n-gram gets the most frequent language and score 0.
    Equal counts go to the first language in alphabetical order. Repeated rows and null ids each get
    a row; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(filters), "doc_id long, lang_pred string, score double")


def with_fold(judged: DataFrame, folds: int, held_out: int) -> DataFrame:
    """Add ``held_out``; a null doc_id is in no fold, so it is neither learned from nor held out."""
    fold = F.coalesce(id_remainder(F.col("doc_id"), folds) == held_out, F.lit(False))
    return judged.withColumn("held_out", fold)


def keep_identified(docs: DataFrame, folds: int = 4, held_out: int = 2, least: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the documents in which no learned language is found. What is in a language
    stays, whatever its ``lang`` column says.

    Each row is judged by its own text: repeated rows, repeated ids and null ids stay or go one by one.
    A null text, or one without a letter, goes. Without a labelled text to learn from all rows stay.
    """
    filters = learn(learning_part(docs, folds, held_out))
    if filters is None:
        return docs
    batch_text = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in chunks(batches, batch_text):
            texts = [t.decode() for t in raw]
            total, hits = filters.hits([letters(t) for t in texts])
            share = hits.max(axis=1) / np.maximum(total, 1)
            good = [has_letter(t) and (s >= least or n == 0) for t, s, n in zip(texts, share, total)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

