"""The wide near-dedup against all pairs by its own rule and by exact Jaccard similarity."""

import itertools
import random

import numpy as np
import pytest

from marketlens.llm import near_texts
from tests.llm.test_operators import odd, table, words  # noqa: F401


def families(r, n_families, size, length):
    """Texts of some words, and copies with up to a tenth of the words replaced."""
    rows = []
    for _ in range(n_families):
        base = words(r, length).split()
        for _ in range(size):
            w = list(base)
            for _ in range(r.randrange(0, max(2, length // 25))):
                w[r.randrange(len(w))] = words(r, 1)
            rows.append(" ".join(w))
    r.shuffle(rows)
    return list(enumerate(rows))


def components(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        ra, rb = root[a], root[b]
        if ra != rb:
            root = [min(ra, rb) if x in (ra, rb) else x for x in root]
    return root


def by_rule(texts):
    prints = near_texts.fingerprints([t.encode() for t in texts])
    return [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if near_texts.linked(prints[a], prints[b], near_texts.REACH)]


def jaccard(a, b):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("small", [64, 2])
def test_stage_matches_all_pairs(spark, small, monkeypatch):
    monkeypatch.setattr(near_texts, "SMALL", small)
    rows = families(random.Random(4), 6, 12, 150) + [(100 + i, words(random.Random(i), 60)) for i in range(20)]
    texts = [t for _, t in rows]
    root = components(len(texts), by_rule(texts))
    ids = [i for i, _ in rows]
    want = {min(ids[k] for k in range(len(ids)) if root[k] == c) for c in set(root)}
    kept = {x.doc_id for x in near_texts.keep_one_near(table(spark, rows)).collect()}
    assert kept == want and len(want) < len(ids)


def test_similar_texts_are_linked_and_others_are_not():
    rows = families(random.Random(5), 50, 6, 200)
    texts = [t for _, t in rows]
    linked = set(by_rule(texts))
    alike = {p for p in itertools.combinations(range(len(texts)), 2) if jaccard(texts[p[0]], texts[p[1]]) >= 0.8}
    far = {p for p in linked if jaccard(texts[p[0]], texts[p[1]]) < 0.65}
    assert len(alike) > 100 and len(linked & alike) >= 0.8 * len(alike)
    assert len(far) <= 0.02 * len(linked)  # an estimate from 248 bits: some pairs below stray in


def test_rows_meet_wherever_a_block_differs_by_two_bits():
    rng = np.random.default_rng(2)
    for _ in range(200):
        x = rng.integers(0, 1 << 31, dtype=np.uint32)
        i, j = rng.choice(31, 2)
        pair = np.array([x, x ^ np.uint32(1 << int(i)) ^ np.uint32(1 << int(j))], dtype=np.uint32)
        at, found = near_texts.anchors(pair)
        assert set(found[at == 0].tolist()) & set(found[at == 1].tolist())


def test_crowded_anchor_holds_components_together():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, (3, near_texts.PARTS), dtype=np.uint64)
    prints = []
    for k in range(150):  # chains: each a few bits from the one before
        base[k % 3, k % near_texts.PARTS] ^= np.uint64(1 << int(rng.integers(0, 62))) | np.uint64(1 << int(rng.integers(0, 62)))
        prints.append(base[k % 3].copy())
    prints = np.unique(np.array(prints), axis=0)
    pairs = [(a, b) for a, b in itertools.combinations(range(len(prints)), 2) if near_texts.linked(prints[a], prints[b], 12)]
    crowd = near_texts._crowd(prints, 12)
    assert set(map(tuple, map(sorted, crowd))) <= set(pairs)
    assert components(len(prints), crowd) == components(len(prints), pairs)
    assert len(crowd) < len(prints)


def test_links_grow_with_the_members_of_a_family(spark):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, near_texts.PARTS, dtype=np.uint64)
    prints = np.tile(base, (300, 1))
    for row in prints:  # any two differ in at most four bits
        for k in rng.integers(0, near_texts.PARTS, 2):
            row[k] ^= np.uint64(1 << int(rng.integers(0, 62)))
    prints = np.unique(prints, axis=0)
    rows = [[int(x) for x in row.view(np.int64)] for row in prints]
    distinct = spark.createDataFrame(rows, near_texts._PRINT)
    links = near_texts.wide_links(distinct).collect()
    place = {int(n): k for k, n in enumerate(near_texts.names(prints))}
    assert components(len(prints), [(place[x.src], place[x.dst]) for x in links]) == [0] * len(prints)
    assert len(links) <= (len(prints) - 1) * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_places_hold_every_anchor_once():
    rng = np.random.default_rng(11)
    prints = rng.integers(0, 1 << 62, (50, near_texts.PARTS), dtype=np.uint64)
    batch = near_texts.pa.RecordBatch.from_arrays(near_texts._columns(prints), names=near_texts._FIELDS)
    sent = list(near_texts.replicas(iter([batch])))
    got = [(x.column(0)[k].as_py(), x.column(1)[k].as_py()) for x in near_texts.spread(iter(sent)) for k in range(x.num_rows)]
    want = []
    for block in range(near_texts.BLOCKS):
        rows, found = near_texts.anchors(near_texts._block(prints, block))
        want += [(int(f) | block << near_texts.HALF, int(prints[r, 0])) for r, f in zip(rows, found)]
    assert sorted(got) == sorted(want)
    assert sum(x.num_rows for x in sent) < 0.7 * len(want)


def test_stars_keep_components(monkeypatch):
    rng = np.random.default_rng(10)
    links = rng.integers(-500, 500, (400, 2))
    got = near_texts.stars(links)
    nodes = sorted(set(links.ravel().tolist()))
    at = {x: k for k, x in enumerate(nodes)}
    want = components(len(nodes), [(at[a], at[b]) for a, b in links.tolist()])
    assert sorted(map(tuple, got.tolist())) == sorted((x, nodes[want[at[x]]]) for x in nodes if want[at[x]] != at[x])


def test_long_and_short_texts():
    r = random.Random(6)
    long = words(r, 40_000)
    changed = long.split()
    for k in range(0, 40_000, 100):
        changed[k] = "other"
    texts = [long, " ".join(changed), "", "one", "One", "one two three four"]
    prints = near_texts.fingerprints([t.encode() for t in texts])
    assert near_texts.linked(prints[0], prints[1], near_texts.REACH)
    assert not prints[2].any() and (prints[3] == prints[4]).all() and (prints[3] != prints[5]).any()
    apart = np.concatenate([near_texts.fingerprints([t.encode()]) for t in texts])
    assert (apart == prints).all()


def test_odd_rows(spark, odd):
    kept = near_texts.keep_one_near(odd)
    assert kept.columns == odd.columns
    assert kept.count() < odd.count()
    assert near_texts.keep_one_near(odd.limit(0)).count() == 0
    near = words(random.Random(7), 60)
    other = words(random.Random(8), 60)
    rows = [(5, near), (6, near + " end"), (None, near), (7, near), (7, other), (7, other), (None, None), (8, "")]
    got = near_texts.keep_one_near(table(spark, rows)).collect()
    assert sorted((x.doc_id, x.text) for x in got) == [(5, near), (7, other), (8, "")]


def test_no_task_needs_two_python_workers(spark):
    """Two Python steps without an exchange between them would hold two workers for each core."""
    distinct = spark.createDataFrame([(1, 2, 3, 4)], ", ".join(f"p{k} long" for k in range(near_texts.PARTS)))
    plan = near_texts.wide_links(distinct)._jdf.queryExecution().executedPlan().toString()
    steps = [x for x in plan.splitlines() if "MapInArrow" in x or "Exchange" in x]
    kinds = ["MapInArrow" if "MapInArrow" in x else "Exchange" for x in steps]
    assert kinds.count("MapInArrow") == 2
    assert all(a == "Exchange" or b == "Exchange" for a, b in zip(kinds, kinds[1:]))
