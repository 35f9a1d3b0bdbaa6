"""Each operator against a brute-force version, and on nulls, empties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketlens.llm import block_naming, language_filters, packing, pseudo_likelihood, seed_alignment
from marketlens.llm import simhash_anchors, suffix_groups, surrogates, toxic_lexicon, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, name string, score double, fp long, kept boolean"


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "x", 0.5, 7, False) for i, t in rows], SCHEMA)


def words(r, n, of="abcdefgh"):
    return " ".join(r.choice(of) + r.choice(of) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    long = "very long " * 6000
    return table(spark, [(1, None), (2, ""), (3, " \t\n"), (None, "no id"), (4, long), (5, "a b"), (5, "a b"), (5, "a  b"), (6, "7 + 8 = 15")])


def test_block_naming_matches_grouping_by_text(spark):
    r = random.Random(2)
    texts = [words(r, r.choice([1, 3, 40, 90])) for _ in range(25)]
    rows = [(i, re.sub(" ", r.choice([" ", "  ", "\n"]), r.choice(texts))) for i in range(120)]
    for size in (3, 16, 4096):
        got = {x.doc_id: x for x in block_naming.exact_groups(table(spark, rows), size).collect()}
        groups: dict[str, list] = {}
        for i, t in rows:
            groups.setdefault(re.sub(r"\s", "", t), []).append((-len(t), i))
        for norm, members in groups.items():
            for _, i in members:
                x = got[i]
                assert (x.keep_id, x.group_size, x.kept) == (min(members)[1], len(members), i == min(members)[1])
                assert x.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()


def test_hot_blocks_bypass_the_sort(spark, monkeypatch):
    monkeypatch.setattr(block_naming, "HOT_SHARE", 4)
    rows = [(i, "same text here" if i % 2 else f"other {i}") for i in range(40)]
    got = block_naming.exact_groups(table(spark, rows), 4).collect()
    assert sorted((x.group_size, x.kept) for x in got)[-20:] == [(20, False)] * 19 + [(20, True)]


def test_block_naming_odd_rows(spark, odd):
    got = block_naming.exact_groups(odd).collect()
    assert len(got) == 9
    assert sorted(x.doc_id for x in got if x.group_size == 3 and x.text_sha256 == hashlib.sha256(b"").hexdigest()) == [1, 2, 3]
    ab = [x for x in got if x.text_sha256 == hashlib.sha256(b"ab").hexdigest()]
    assert len(ab) == 3 and sum(x.kept for x in ab) == 1
    kept = block_naming.keep_exact(odd)
    assert kept.columns == odd.columns and kept.count() == 5
    assert kept.filter("doc_id = 5").first().text == "a  b"
    assert block_naming.exact_groups(odd.limit(0)).count() == 0


def test_anchors_cover_every_pair_within_two_bits():
    rng = np.random.default_rng(1)
    for x in rng.integers(0, 1 << 63, 40, dtype=np.uint64):
        flips = [(i, j) for i in range(64) for j in range(i, 64)]
        for i, j in random.Random(int(x) % 99).sample(flips, 40):
            y = x ^ np.uint64((1 << i) | (1 << j))
            met = False
            for a, b in zip(simhash_anchors.halves(np.array([x])), simhash_anchors.halves(np.array([y]))):
                met |= int(simhash_anchors.homes(a)[0]) in simhash_anchors.anchors(b)[1].tolist()
            assert met


def simhash(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hs = [xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(prints):
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in prints}


@pytest.mark.parametrize("crowded", [2048, 3])
def test_simhash_matches_all_pairs(spark, crowded, monkeypatch):
    monkeypatch.setattr(simhash_anchors, "CROWDED", crowded)
    r = random.Random(3)
    base = [words(r, 80) for _ in range(6)]
    rows = []
    for i in range(90):
        w = r.choice(base).split()
        for _ in range(r.choice([0, 0, 1, 2])):
            w[r.randrange(len(w))] = words(r, 1)
        rows.append((i, " ".join(w)))
    got = {x.doc_id: (x.fingerprint, x.component_id) for x in simhash_anchors.near_duplicates(table(spark, rows)).collect()}
    prints = {i: simhash(t) for i, t in rows}
    want = components(prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    assert len(set(want.values())) < 90


def test_simhash_odd_rows(spark, odd):
    got = simhash_anchors.near_duplicates(odd).collect()
    assert len(got) == 9
    assert {x.component_id for x in got if x.doc_id in (1, 2, 3)} == {1}
    assert all(x.fingerprint == "0" * 16 for x in got if x.doc_id in (1, 2, 3))
    assert simhash_anchors.keep_one(odd).columns == odd.columns
    assert simhash_anchors.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("limits", [{}, {"group": 50}, {"group": 20, "fan": 3}])
def test_substring_dedup_matches_brute_force(spark, limits):
    r = random.Random(1)
    base = words(r, 60).split()
    rows = [(i, words(r, 20) + " " + " ".join(base[(i * 3) % 30 : (i * 3) % 30 + 25])) for i in range(40)]
    first: dict[tuple, int] = {}
    split = {i: t.split() for i, t in rows}
    for i, w in split.items():
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for x in suffix_groups.repeated_words_removed(table(spark, rows), 13, **limits).collect():
        w = split[x.doc_id]
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < x.doc_id:
                gone |= set(range(k, k + 13))
        kept = " ".join(v for j, v in enumerate(w) if j not in gone)
        assert (x.n_words, x.n_removed, x.kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_substring_dedup_odd_rows(spark, odd):
    got = suffix_groups.repeated_words_removed(odd).collect()
    assert len(got) == 9 and sum(x.n_removed for x in got) == 0
    assert {x.n_words for x in got if x.doc_id in (1, 2, 3)} == {0}
    assert suffix_groups.repeated_words_removed(odd.limit(0)).count() == 0


def test_rows_that_share_an_id_are_judged_apart(spark):
    """Ids null, repeated and shared: the stages keep rows, not ids."""
    near = "one two three four five six seven eight nine ten"
    other = "quite another text about rivers and the old mill by the bridge"
    rows = [(5, near), (6, near), (None, near), (7, near), (7, other), (7, other), (None, other + " in the rain"), (None, None), (8, "")]
    kept = simhash_anchors.keep_one(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("5", near), ("7", other), ("8", ""), ("None", other + " in the rain")]
    bench = spark.createDataFrame([(None, "the old mill by the bridge stood empty"), (1, None), (None, "entirely different words in this item here")], "item_id long, text string")
    hit = "they said the old mill by the bridge stood empty for years"
    rows = [(None, hit), (None, near), (7, near), (7, hit), (7, near)]
    docs = table(spark, rows)
    clean = seed_alignment.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in clean.collect()) == [("7", near), ("7", near), ("None", near)]
    found = seed_alignment.contaminated(docs, bench).collect()
    assert sorted(((r.doc_id is None, r.item_id), r.score) for r in found) == [((False, None), 1.0), ((True, None), 1.0)]
    for stage in (simhash_anchors.keep_one, lambda d: seed_alignment.keep_clean(d, bench)):
        assert stage(docs.limit(0)).count() == 0


def test_packing_with_a_vocabulary_that_splits_otherwise(monkeypatch):
    """A wrong rule for the pieces is found out, and the vocabulary's own splitter is used."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Don't a1b2 x--y", "plain words (here)", "été 9 'tis", ""]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]

    def ids(encoder):
        return [x.tolist() for x in packing._encoded(encoder, [t.encode() for t in texts])]

    right = packing._Encoder(path)
    assert right.known_split and ids(right) == want
    monkeypatch.setattr(packing, "_ASCII_PIECES", re.compile("[a-z]+|[^a-z]+"))
    wrong = packing._Encoder(path)
    assert not wrong.known_split and ids(wrong) == want


def test_packing_forgets_and_learns_again(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    encoder = packing._Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [b"alpha beta gamma delta", b"beta gamma alpha", b"delta delta omega"] * 3
    got = [packing._encoded(encoder, [t])[0].tolist() for t in texts]
    assert got == [encoder.tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts]


def test_packing_splits_any_characters_like_the_library(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "HELD_WORDS", 200)
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder, r = Tokenizer.from_file(path), packing._Encoder(path), random.Random(4)
    assert encoder.kind[ord("é")] == packing._LETTER and encoder.kind[ord("²")] == packing._ODD  # not one by one in Python
    chars = [chr(c) for c in range(1, 0x260)] + list("éÉßñ '|<>019azAZ.,!ΣςİÅ\u0301\u3000漢字😀") * 8
    texts = ["".join(r.choice(chars) for _ in range(r.randrange(60))) for _ in range(1500)]
    for a in range(0, len(texts), 100):
        part = texts[a : a + 100]
        got = [x.tolist() for x in packing._encoded(encoder, [t.encode() for t in part])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in part]


def test_packing_remembers_many_words_in_arrays(monkeypatch):
    import public_tokenizers

    encoder = packing._Encoder(public_tokenizers.path("word_bpe_49k.json"))
    parts = [[b" ".join(b"%dx" % n for n in range(a, a + 120_000))] for a in (0, 120_000, 240_000)]
    first = [packing._encoded(encoder, p)[0] for p in parts]

    def never(words):
        raise AssertionError("forgotten")

    monkeypatch.setattr(encoder, "encode", never)
    assert all((packing._encoded(encoder, p)[0] == ids).all() for p, ids in zip(parts, first))
    held = encoder.held
    assert held.words.nbytes + sum(x.nbytes for x in (held.hashes, held.begins, held.sizes, held.met, held.flat)) < 100 * len(held.hashes)


def test_packing_leaves_no_words_in_its_worker():
    """The next stage runs in the same worker."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"w{n}q" for n in range(a, a + 3000)) for a in (0, 2000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([k]), pa.array([t])], names=["doc_id", "text"]) for k, t in enumerate(texts)]
    out = list(packing._pieces(lambda: path, 2048, True)(iter(batches)))
    encoder = packing._encoder(path)
    assert not len(encoder.held.hashes) and not len(encoder.held_pieces.hashes) and not encoder.pieces
    for got, text in zip(out, texts):
        assert sum(got.column("ids").to_pylist(), [])[:-1] == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_grams_are_counted_in_bounded_stretches(monkeypatch):
    texts = ["abcd efgh ijkl " * 4000] * 60
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 60)], names=["text", "lang"])
    most, real = [0], np.unique
    monkeypatch.setattr(np, "unique", lambda x, **k: (most.append(len(x)), real(x, **k))[1])
    monkeypatch.setattr(language_filters, "chunks", lambda batches, at: ((b.slice(k, 1), [texts[k].encode()]) for b in batches for k in range(60)))
    counted = pa.Table.from_batches(list(language_filters._gram_counts(iter([batch]))))
    whole = language_filters.grams([language_filters.letters(t) for t in texts])[0]
    values, n = real(whole, return_counts=True)
    assert dict(zip(counted["gram"].to_pylist(), counted["n"].to_pylist())) == dict(zip(values.tolist(), n.tolist()))
    assert max(most) < 1_100_000 < len(whole)


def test_packing_is_an_exact_cut(spark, odd):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    encode = Tokenizer.from_file(path).encode
    texts = ["don't STOP, Ünïcode é \x1c!\x1f", "<|endoftext|> a b", "日本 テキスト 😀", words(random.Random(4), 3000), "x" * 4000]
    docs = odd.union(table(spark, list(enumerate(texts, 100))))
    assert packing.packed(docs.limit(0), lambda: path).count() == 0
    got = packing.packed(docs.filter("doc_id >= 100 OR doc_id < 4"), lambda: path, with_ids=True).collect()
    for i, t in [*enumerate(texts, 100), (1, ""), (3, "")]:
        ids = [*encode(t, add_special_tokens=False).ids, 1]
        mine = sorted((x for x in got if x.doc_id == i), key=lambda x: x.start)
        assert [v for x in mine for v in x.ids] == ids
        assert all(x.doc_tokens == len(ids) and x.length & (x.length - 1) == 0 and x.length <= 2048 for x in mine)
        assert all(x.ids_crc32 == zlib.crc32(np.array(x.ids, dtype="<u4").tobytes()) for x in mine)
    assert len({x.sequence_id for x in got}) == len(got)
    assert packing.packed(odd, lambda: path).groupBy("doc_id", "start").count().filter("doc_id = 5").first()["count"] == 3


def test_language_filters(spark, odd):
    r = random.Random(5)
    kinds = {"aa": "abcdefg", "bb": "hijklmn", "cc": "opqrstu"}
    rows = [(i, words(r, 30, kinds[k]), k) for i, k in enumerate(list(kinds) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language_filters.learn(language_filters.learning_part(docs, 4, 2))
    got = language_filters.with_fold(language_filters.identified(docs, filters), 4, 2).collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got)
    assert all(x.lang_pred == rows[x.doc_id][2] and 0 <= x.score <= 1 for x in got)
    edge = {(x.doc_id, x.lang_pred) for x in language_filters.identified(odd, filters).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (6, "und")} <= edge and len(edge) == 7
    assert {x.lang_pred for x in language_filters.identified(odd, None).collect()} == {"und"}
    kept = language_filters.keep_identified(docs.union(spark.createDataFrame([(900, "123", "aa"), (901, None, None)], docs.schema)))
    assert kept.count() == len(rows)


def test_toxic_lexicon(spark, odd):
    r = random.Random(6)
    rows, marks = [], []
    for i in range(400):
        w = words(r, 30).split()
        if i % 4 == 0:
            w[3] = w[9] = r.choice(["vile", "v1le", "VILEST", "viⅼe".replace("ⅼ", "l"), "vіle"])
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 4 == 0)))
    docs, labels = table(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    lexicon = toxic_lexicon.learn(docs, labels)
    assert any("vile".startswith(t) for t in lexicon.weights)
    got = {x.doc_id: x for x in toxic_lexicon.scored(docs, lexicon).collect()}
    assert all(got[i].predicted == t for i, t in marks)
    lexicon.exceptions = {"vile jelly"}
    automaton = lexicon.automaton()
    assert not lexicon.matches(automaton, toxic_lexicon.fold("a vile jelly")) and lexicon.matches(automaton, toxic_lexicon.fold("a vile man"))
    assert all(0 <= x.score <= 1 for x in toxic_lexicon.scored(odd, lexicon).collect())
    none = toxic_lexicon.learn(docs, labels.limit(0))
    assert {x.score for x in toxic_lexicon.scored(odd, none).collect()} == {0.0}


def test_url_rules(spark):
    given = [url_rules.Given("block", "net", "/"), url_rules.Given("allow", "example.net", "/en/")]
    urls = [f"http://bad{i % 3}.x.net/spam/{i}" for i in range(60)] + [f"https://www.example.net/en/good/{i}" for i in range(60)]
    urls += ["ftp://Q.com/spam/1?a=1#f", "nothing", None, "http://a.NET", "http://notnet/x", "http://www.example.net/en/x", "http://q.org/good/"]
    pages = spark.createDataFrame([(i, u, "html", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {x.page_id: x for x in url_rules.judged(pages, given).collect()}
    assert (got[120].host, got[120].path, got[120].rule, got[120].verdict) == ("q.com", "/spam/1", None, "block")
    assert [(got[i].host, got[i].path, got[i].verdict) for i in (121, 122)] == [("", "", "allow")] * 2
    assert (got[123].host, got[123].path, got[123].rule) == ("a.net", "", None)
    assert got[124].rule is None and got[125].rule == "example.net/en/" and got[126].verdict == "allow"
    assert url_rules.judged(pages.limit(0), given).count() == 0


def test_alignment_finds_edited_copies(spark, odd):
    r = random.Random(7)
    items = [(i, words(r, 30)) for i in range(5)] + [(9, None), (10, "too short")]
    edited = items[1][1].split()
    edited[10:12] = ["new", "words", "here"]
    edited[20] = "other"
    rows = [(0, words(r, 50)), (1, words(r, 40) + " " + items[0][1].upper() + ". " + words(r, 9)), (2, " ".join(edited))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for slice_bytes in (1 << 20, 60):
        got = {(x.doc_id, x.item_id): x.score for x in seed_alignment.contaminated(table(spark, rows), bench, slice_bytes=slice_bytes).collect()}
        assert set(got) == {(1, 0), (2, 1)} and got[1, 0] == 1.0 and 0.6 < got[2, 1] < 1
    assert seed_alignment.keep_clean(odd, bench).count() == 9
    assert seed_alignment.contaminated(odd, bench.limit(0)).count() == 0


@pytest.mark.parametrize("common", [1000, 0])
def test_alignment_finds_copies_with_every_nth_word_replaced(spark, common, monkeypatch):
    monkeypatch.setattr(seed_alignment, "COMMON", common, raising=False)
    r = random.Random(11)
    items = [(i, words(r, r.randint(16, 59))) for i in range(12)]
    texts = []
    for _, text in items:
        for every in range(4, 9):
            w = text.split()
            for k in range(r.randrange(every), len(w), every):
                w[k] = f"new{k}"
            texts.append(words(r, 20) + " " + " ".join(w) + " " + words(r, 20))
    texts += [text for _, text in items[:3]]  # verbatim besides
    want = set()
    for d, text in enumerate(texts):
        passage = seed_alignment.Words([text.encode()]).hashes
        for i, item in items:
            own = seed_alignment.Words([item.encode()]).hashes
            if seed_alignment.align(own, passage)[0] >= seed_alignment.LEAST * seed_alignment.MATCH * len(own):
                want.add((d, i))
    assert len(want) > 55
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = seed_alignment.contaminated(table(spark, list(enumerate(texts))), bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want


def test_smith_waterman_matches_the_plain_recurrence():
    rng = np.random.default_rng(8)
    for _ in range(30):
        a, b = rng.integers(0, 4, 12).astype(np.uint64), rng.integers(0, 4, 17).astype(np.uint64)
        h = np.zeros((13, 18), dtype=int)
        for i in range(1, 13):
            for j in range(1, 18):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert seed_alignment.align(a, b)[0] == h.max()


def test_pseudo_likelihood_prefers_the_language_it_learned(spark, odd):
    r = random.Random(9)
    rows = [(i, "the cat sat on the mat and the dog lay by the door " * 8) for i in range(200)]
    docs = table(spark, rows)
    net = pseudo_likelihood.learn(docs)
    shuffled = rows[0][1].split()
    r.shuffle(shuffled)
    test = table(spark, [(0, rows[0][1]), (1, " ".join(shuffled)), (2, words(r, 96))])
    got = {x.doc_id: x for x in pseudo_likelihood.scored(test, net).collect()}
    assert got[0].mean_log_likelihood > got[1].mean_log_likelihood > got[2].mean_log_likelihood
    assert got[0].log_likelihood == pytest.approx(got[0].mean_log_likelihood * got[0].n_words)
    edge = {(x.doc_id, x.n_words, x.mean_log_likelihood is None) for x in pseudo_likelihood.scored(odd, net).collect()}
    assert {(1, 0, True), (2, 0, True), (3, 0, True)} <= edge
    assert pseudo_likelihood.learn(odd.limit(0)).flat.size == net.flat.size


def test_every_word_is_a_target_of_training_once(monkeypatch):
    seen: list[int] = []
    monkeypatch.setattr(pseudo_likelihood, "train", lambda net, flat, squares, around, target: seen.extend(target.tolist()))
    texts = [words(random.Random(i), 50) for i in range(7)]
    net = pseudo_likelihood.start(np.zeros(pseudo_likelihood.BUCKETS, dtype=np.int64))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    copies = list(pseudo_likelihood._trained(net, 1)(iter([batch])))
    assert sorted(seen) == sorted(pseudo_likelihood.buckets(pseudo_likelihood.Words([t.encode() for t in texts])).tolist())
    assert {w for c in copies for w in c.column("weight").to_pylist()} == {350.0}


def test_surrogates_keep_format_identity_and_distinctness(spark, odd):
    texts = [
        "Mr. John Smith wrote a.b@mail5.example.com and A.B@MAIL5.EXAMPLE.COM from 10.0.0.1, call +1 (743) 555-3824.",
        "Ms. Smith paid with 4539578763621486 or 4539 5787 6362 1486; 743 555-3824; token = \"24be64439e3e49cf\".",
        "Госпожа Анна Петрова, Herr Müller, 123-45-6789 and nobody",
    ]
    docs = table(spark, list(enumerate(texts)))
    got = {x.doc_id: x for x in surrogates.pseudonymised(docs, "k").collect()}
    again = {x.doc_id: x.text for x in surrogates.pseudonymised(docs, "k").collect()}
    assert {i: x.text for i, x in got.items()} == again
    for old in ("Smith", "John", "a.b@", "10.0.0.1", "555-3824", "4539578763621486", "24be64439e3e49cf", "Петрова", "Müller", "123-45-6789"):
        assert not any(old in x.text for x in got.values()), old
    mails = re.findall(r"\S+@\S+", got[0].text)
    assert mails[0].upper() == mails[1] and re.fullmatch(r"[a-z]\.[a-z]@[a-z]{4}\d\.[a-z]{7}\.com", mails[0])
    family = re.search(r"Mr\. (\w+) (\w+) wrote", got[0].text)[2]
    assert f"Ms. {family} paid" in got[1].text
    phones = re.findall(r"(\d{3})\)? (\d{3})-(\d{4})", got[0].text + got[1].text)
    assert phones[0] == phones[-1] and "+1 (" in got[0].text
    cards = re.findall(r"\d{4} ?\d{4} ?\d{4} ?\d{4}", got[1].text)
    assert cards[0] == cards[1].replace(" ", "") and sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(cards[0][::-1])) % 10 == 0
    assert re.search(r"Госпожа [А-Я][а-я]+ [А-Я][а-я]+", got[2].text)
    edge = {x.doc_id: (x.text, x.n_replaced) for x in surrogates.pseudonymised(odd, "k").collect()}
    assert edge[1] == (None, 0) and edge[6] == ("7 + 8 = 15", 0) and surrogates.pseudonymised(odd.limit(0), "k").count() == 0


def test_surrogates_take_long_values_to_their_end(spark):
    r = random.Random(12)
    draw = lambda n: "".join(r.choice("abcdefghijkmnpqrstuvwxyz23456789") for _ in range(n))
    token, local, jwt = "Z" + draw(499), draw(80), f"eyJ{draw(30)}.eyJ{draw(200)}.{draw(40)}~{draw(9)}=="
    name = "M" + "abcdefgh" * 5
    texts = [f"token={token}.", f"mail {local}@example.com now", f"secret: {jwt}", f"Mr. {name} came", f"token={token}", f"password={local}@example.com"]
    got = {x.doc_id: x for x in surrogates.pseudonymised(table(spark, list(enumerate(texts))), "k").collect()}
    assert all(x.n_replaced == 1 for x in got.values())
    for i, old in enumerate((token, local, jwt, name)):
        assert not any(old[k : k + 8] in got[i].text for k in range(len(old) - 7)), i
    assert got[0].text == got[4].text + "." and len(got[0].text) == len(texts[0])
    assert re.fullmatch(r"mail \w{80}@[a-z]{7}\.com now", got[1].text)
    assert re.fullmatch(r"secret: \w{33}\.\w{203}\.\w{40}~\w{9}==", got[2].text)
    assert got[5].text == "password=" + got[1].text.split()[1]


def test_surrogates_stay_distinct_when_a_format_is_crowded(spark):
    nets = spark.range(3000).select(F.lit("ip").alias("kind"), F.concat_ws(".", F.lit("10"), F.lit("0"), F.floor(F.col("id") / 250), F.col("id") % 250).alias("entity"))
    names = spark.range(3000).select(F.lit("name").alias("kind"), F.concat(F.lit("n"), "id").alias("entity"))
    got = surrogates.surrogates(nets.union(names), "k")
    assert got.count() == got.select("kind", "surrogate").distinct().count() == 6000
    assert got.join(nets.select(F.col("entity").alias("surrogate")), "surrogate").count() == 0


def test_persons_of_one_family_stay_distinct(spark):
    syllables = ["an", "be", "co", "du", "el", "fi", "go", "hu", "il", "jo"]
    given = [(a + b + c).capitalize() for a in syllables for b in syllables for c in syllables]
    texts = [f"{t} {g} Smith came" for g in given for t in ("Mr.", "Mrs.")] + ["Dr. Ada Smith", "Ms. Ada Smith", "Mr. Smith", "Dr. Bo Smith"]
    got = {x.doc_id: x.text.removesuffix(" came").split() for x in surrogates.pseudonymised(table(spark, list(enumerate(texts))), "k").collect()}
    n = 2 * len(given)
    assert len({g[-1] for g in got.values()}) == 1 and got[0][-1] != "Smith"  # the family keeps one name
    assert len({got[i][1] for i in range(n)}) == n  # as many persons as before
    assert got[n][1] == got[n + 1][1] and got[n + 2] == ["Mr.", got[0][-1]]  # a doctor is the only Ada
    assert all(got[i][0] == texts[i].split()[0] for i in got) and not {got[n][1], got[n + 3][1]} & {"Ada", "Bo"}


def test_crowded_and_fixed_formats_are_still_replaced(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.co" for a in letters for b in letters]
    texts = [*mails, "_@-.-", "token=========", "1²@٣.x"]
    got = {x.doc_id: x for x in surrogates.pseudonymised(table(spark, list(enumerate(texts))), "k").collect()}
    assert all(x.n_replaced == 1 for x in got.values())
    new = [got[i].text for i in range(len(texts))]
    assert len(set(new)) == len(texts) and not set(new) & set(texts)
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.co", x) for x in new[: len(mails)]) and new[len(mails) + 1].startswith("token=")


def test_numbers_grow_at_their_end(spark):
    rows = [("national", "123-45-6789", "9876543210"), ("phone", "+1 743 555-3824", "2223334444"), ("ip", "10.0.0.1", "4.5.6.7:81")]
    made = spark.createDataFrame(rows, "kind string, mention string, surrogate string")
    new = [x[0] for x in made.select(surrogates._rendered(F.lit(""))).collect()]
    assert new == ["987-65-43210", "+1 222 333-4444", "4.5.6.7:81"]


def test_lm_gradients_of_repeated_words_are_summed_and_wide_logits_stay_finite():
    from marketlens.llm import pseudo_likelihood as lm

    rng = np.random.default_rng(3)
    keys = np.concatenate((np.repeat(7, 40), np.repeat(9, lm._SHORT), rng.integers(10, 300, 500)))
    rows = rng.normal(size=(len(keys), 5)).astype(np.float32)
    order = np.argsort(keys, kind="stable")
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys[order])) + 1))
    want = [rows[keys == k].sum(axis=0, dtype=np.float64) for k in np.unique(keys)]
    assert np.allclose(lm._sums(rows, order, cuts), want, atol=1e-4)
    embed, place = np.zeros((3, lm.WIDTH), np.float32), np.ones((2, lm.WIDTH), np.float32)
    out = np.zeros((lm.WIDTH, lm.CLASSES), np.float32)
    for top in (5, 500):  # plain exponentials of 500 overflow
        shift = np.linspace(-top, top, lm.CLASSES).astype(np.float32)
        _, _, logits = lm._forward((embed, place, np.zeros(lm.WIDTH, np.float32), out, shift), np.array([[0, 1]]))
        p = np.exp(logits) / np.exp(logits).sum()
        wide = shift.astype(np.float64) - top
        assert np.allclose(p, np.exp(wide) / np.exp(wide).sum(), atol=1e-6)


def test_packing_remembers_a_bounded_number_of_words():
    assert 2 * packing.CACHED_WORDS <= 200_000  # two generations of some 200 bytes a word, in every worker
