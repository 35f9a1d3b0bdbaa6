"""Token counts, the manifest and the reversed search against brute-force versions and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlens.llm import merkle_manifest, reversed_search, token_counts
from marketlens.llm.queries import piece_model

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, score double, tree string, n long, pos long"


def table(spark, rows):
    """(doc_id, text[, source]) with extra columns whose names the operators use themselves."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 5, 1, 0.5, "x", 7, 9) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "no id"), (4, "very long " * 6000), (5, "a b"), (5, "a b"), (5, "a  b"), (6, "x" * 30_000)]
    return table(spark, rows)


# --- token counts


def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=piece_model())


BITS = [" ", "  ", "\n", "\n\n", "a", "the", "1", "94", "▁", "é", "世界", "\x00", "<s>", "</s>", "\t", "<0x0A>", "🙂", ".", "   ", "In", "\r\n", "xyzzy"]


def test_counts_equal_the_library_on_any_mixture():
    encoder, r = library(), random.Random(5)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 14))) for _ in range(20_000)]
    texts += ["", " ", "  ", "\n", " \n", "\n ", "▁", " " * 9000, "a" * 9000, "\n" * 50]
    counter = token_counts._Counter(encoder, token_counts.prove(piece_model()))
    got = counter.texts(pa.array(texts)).tolist()
    assert got == [len(ids) for ids in encoder.encode(texts)]


def test_every_shortcut_is_one_token():
    encoder, proved = library(), token_counts.prove(piece_model())
    assert len(proved.whole) > 25_000
    for word in random.Random(1).sample(sorted(proved.whole), 2000):
        if word.startswith("\n"):
            assert len(encoder.encode("a" + word)) == 3 and proved.whole[word] == 2
        else:
            assert len(encoder.encode(word)) == 1 == proved.whole[word]


@pytest.mark.parametrize("fails", [False, True])
def test_counts_of_odd_rows(spark, odd, monkeypatch, fails):
    if fails:  # a vocabulary for which nothing is proved
        monkeypatch.setattr(token_counts, "prove", lambda path: None)
    encoder = library()
    got = token_counts.token_counts(odd, piece_model, limit=100).collect()
    want = [(x.doc_id, len((x.text or "").encode()), len(encoder.encode(x.text or ""))) for x in odd.collect()]
    assert sorted(map(str, ((x.doc_id, x.n_bytes, x.n_tokens) for x in got))) == sorted(map(str, want))
    assert all(x.over_limit == (x.n_tokens > 100) for x in got)
    assert token_counts.token_counts(odd.limit(0), piece_model).count() == 0


def test_forgetting_merged_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "MERGED", 3)
    monkeypatch.setattr(token_counts, "LONGEST", 4)
    encoder = library()
    counter = token_counts._Counter(encoder, token_counts.prove(piece_model()))
    for text in ["thon onsh erstlyat thon", "onsh qwzx qqqq zzzz thon", "  qwzx  qwzx"]:
        assert counter.texts(pa.array([text])).tolist() == [len(encoder.encode(text))]


# --- manifest


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def tree_of(leaves):
    """(root, the siblings of each leaf as one string)."""
    level, members, proofs = leaves, [[i] for i in range(len(leaves))], [""] * len(leaves)
    while len(level) > 1:
        up, above = [], []
        for a in range(0, len(level), 3):
            run = level[a : a + 3]
            for k in range(len(run)):
                for i in members[a + k]:
                    proofs[i] += "".join(run[:k] + run[k + 1 :])
            up.append(h(run))
            above.append([i for m in members[a : a + 3] for i in m])
        level, members = up, above
    return level[0], proofs


def manifest_of(rows):
    by: dict = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in names:
        leaves = sorted((x.doc_id is not None, x.doc_id or 0, leaf_of(x.doc_id, x.source, x.lang, x.n_chars, x.text)) for x in by[s])
        built[s] = leaves, *tree_of([x[2] for x in leaves])
    root, tops = tree_of([built[s][1] for s in names])
    out = []
    for s, top in zip(names, tops):
        leaves, subroot, proofs = built[s]
        out += [(d if known else None, leaf, subroot, root, h([p, top])) for (known, d, leaf), p in zip(leaves, proofs)]
    return out


def shape(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("height", [1, 2, 5])
def test_manifest_matches_brute_force(spark, height, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "HEIGHT", height)
    r = random.Random(7)
    sizes = {"hot": 40, None: 10, "": 3, "é": 9, "z": 1, "Z": 28}
    rows = [(i * 7, r.choice(["a\nb", "plain", None, "", "\n"]), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = table(spark, rows)
    now = merkle_manifest.without_line_breaks(F.col("doc_id"), F.col("text"))
    got = merkle_manifest.manifest(docs, now).collect()
    assert shape((x.doc_id, x.leaf, x.subroot, x.root, x.proof_sha256) for x in got) == shape(manifest_of(docs.collect()))
    texts = {i: t for i, t, _ in rows}
    for x in got:
        changed = zlib.crc32(str(x.doc_id).encode()) % 2 == 0 and "\n" in (texts[x.doc_id] or "")
        assert x.verified == (not changed) == (x.folded_root == x.root)


def test_manifest_odd_rows(spark, odd):
    got = merkle_manifest.manifest(odd).collect()
    assert shape((x.doc_id, x.leaf, x.subroot, x.root, x.proof_sha256) for x in got) == shape(manifest_of(odd.collect()))
    assert all(x.verified for x in got)
    one = merkle_manifest.manifest(odd.limit(1)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == h([])
    assert merkle_manifest.manifest(odd.limit(0)).count() == 0


def test_fields_do_not_run_together(spark):
    rows = [(1, "a", "1:b"), (1, "a1:b", None), (1, None, "-"), (1, "-", None)]
    leaves = {x.leaf for x in merkle_manifest.manifest(table(spark, rows)).collect()}
    assert len(leaves) == 4


def test_the_queue_stays_small():
    longest, push = 0, merkle_manifest.heapq.heappush

    def watched(queue, message):
        nonlocal longest
        push(queue, message)
        longest = max(longest, len(queue))

    class Heap:
        heappush, heappop = staticmethod(watched), staticmethod(merkle_manifest.heapq.heappop)

    original, merkle_manifest.heapq = merkle_manifest.heapq, Heap
    try:
        merkle_manifest.Sweep([str(i) for i in range(3**5)], 5)
    finally:
        merkle_manifest.heapq = original
    assert longest <= 3 * 5


# --- reversed search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def search(docs, items, best=10):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            score = 0
            for t in set(terms_of(text)) & set(b):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 10 + 90 * sum(b.values()) * n_docs // total
                score += w * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:best])]
    return sorted(map(str, out))


def found(frame):
    return sorted(str((x.item_id, x["rank"], x.doc_id, x.score)) for x in frame.collect())


@pytest.mark.parametrize("limits", [{}, {"slice_bytes": 100}, {"cells": 7}])
def test_search_matches_brute_force(spark, monkeypatch, limits):
    if "cells" in limits:
        monkeypatch.setattr(reversed_search, "CELLS", limits["cells"])
        monkeypatch.setattr(reversed_search, "CHUNK", 200)
    r = random.Random(9)
    some = ["Alpha", "beta", "GAMMA", "ÉTÉ", "été", "x1", "_", "-", "the", "日本"]
    docs = [(i, " ".join(r.choice(some) for _ in range(r.randint(0, 12)))) for i in range(120)]
    docs += [(900 + i, "Beta, beta! x1") for i in range(15)] + [(None, "Beta, beta! x1"), (1, None), (2, "")]
    items = [(i, " ".join(r.choice(some) for _ in range(4))) for i in range(9)] + [(50, None), (51, "?"), (52, "unheard"), (None, "x1 beta")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    got = reversed_search.ranked(table(spark, docs).repartition(7), bench, slice_bytes=limits.get("slice_bytes", 1 << 20))
    assert found(got) == search(docs, items)


def test_search_odd_rows(spark, odd):
    items = [(1, "a b very"), (1, "id"), (2, "a B")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert found(reversed_search.ranked(odd, bench)) == search([(x.doc_id, x.text) for x in odd.collect()], items)
    assert reversed_search.ranked(odd.limit(0), bench).count() == 0
    assert reversed_search.ranked(odd, bench.limit(0)).count() == 0
