import random
from itertools import combinations

import numpy as np
from llm_data import SCHEMA, documents, frame, lower, prose, space_words

from tabrix.llm import setsketch
from tabrix.llm.graph import components


def shingle_set(s):
    w = space_words(lower(s))
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, percent=85):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingle_set(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def near_copies(seed):
    rng = random.Random(seed)
    rows, n = [], 1000
    for _ in range(6):
        words = prose(rng, rng.choice([30, 80, 300])).split()
        for _ in range(12):
            w = list(words)
            for _ in range(rng.choice([0, 1, 2, len(w) // 40])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
            rows.append((n, " ".join(w)))
            n += 1
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = [r[:2] for r in documents()] + near_copies(3)
    rows += [rows[0], rows[1]]  # repeated rows
    full = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    want = brute([r for r in rows if r[0] is not None])
    for block in (1500, 4):  # whole clusters, and clusters compared block by block
        out = setsketch.near_duplicates(full, "doc_id", block=block).collect()
        assert len(out) == len(rows)
        got = [r for r in out if r.doc_id is not None]
        assert {r.doc_id: r.component_id for r in got} == want
        assert sorted((r.doc_id, r.n_shingles) for r in got) == sorted((i, len(shingle_set(t))) for i, t in rows if i is not None)
        assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert setsketch.near_duplicates(frame(spark, []), "doc_id").count() == 0


def test_sketches_are_mergeable_and_estimates_are_close():
    rng = np.random.default_rng(1)
    for like in (0.3, 0.6, 0.85, 0.95):
        both = rng.integers(0, 2**63, 2000).astype(np.uint64)
        k = int(2000 * like)
        a, b = both[: k + (2000 - k) // 2], np.concatenate([both[:k], both[k + (2000 - k) // 2:]])
        m = 1024
        s = [setsketch.sketch(np.zeros(len(x), np.int64), x, 1, m)[0] for x in (a, b, both)]
        assert (np.maximum(s[0], s[1]) == s[2]).all()
        guess = setsketch.estimate(np.array([(s[0] > s[1]).sum()]), np.array([(s[0] < s[1]).sum()]),
                                   np.array([float(len(a))]), np.array([float(len(b))]), m)[0]
        assert abs(guess - like) < 0.06


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3), (7, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 260)]}}


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_that_polynomial_hashes_confuse(spark):
    word = thue_morse(2048)
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"a b c d {word}"), (4, f"a b c d {other}"), (5, word.upper())]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in setsketch.near_duplicates(df, "doc_id").collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1} == brute(rows)


def test_percent_is_a_parameter(spark):
    rng = random.Random(9)
    base = prose(rng, 300).split()
    changed = list(base)
    for i in (20, 80, 140, 200, 260, 290):  # similarity 0.81
        changed[i] = "other"
    df = spark.createDataFrame([(1, " ".join(base), "en", "s", 0), (2, " ".join(changed), "en", "s", 0)], SCHEMA)
    a, b = shingle_set(" ".join(base)), shingle_set(" ".join(changed))
    assert 0.8 <= len(a & b) / len(a | b) < 0.85
    for percent, parts in ((85, 2), (80, 1)):
        assert len({r.component_id for r in setsketch.near_duplicates(df, "doc_id", percent=percent).collect()}) == parts


def test_words_of_all_lengths_have_hashes_of_their_own():
    rng = random.Random(3)
    texts = [b"", b" a\x1c b\t", b"A a\x00 a a\x00\x00", " ".join(f"W{i % 700}" for i in range(3000)).encode()]
    texts += [b" ".join(bytes(rng.choices(b"xyzXYZ\xc3\xa9\x00", k=n)) for _ in range(5)) for n in range(1, 70)]
    texts += [thue_morse(2 ** k).encode() for k in range(11)] + [thue_morse(2 ** k).encode().translate(bytes.maketrans(b"ab", b"ba")) for k in range(11)]
    word, count = setsketch.word_hashes(texts)
    plain = [w for t in texts for w in bytes(t).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()]
    assert count.tolist() == [len(t.split()) for t in texts] and len(word) == len(plain)
    assert len(set(word.tolist())) == len(set(plain)) == len(set(zip(word.tolist(), plain, strict=True)))
    alone = [setsketch.word_hashes([w])[0][0] for w in plain[:400]]
    assert alone == word[:400].tolist()


def test_a_hub_of_many_edges(spark):
    edges = [(i, 10_000) for i in range(3000)] + [(i, i + 1) for i in range(20_000, 20_040)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert {got[i] for i in [*range(3000), 10_000]} == {0} and {got[i] for i in range(20_000, 20_041)} == {20_000}


def test_bands_in_blocks_and_large_bands(spark, monkeypatch):
    rows = [(i, t, "en", "s", 0) for i, t in near_copies(5)]
    base = prose(random.Random(4), 60).split()
    rows += [(5000 + i, " ".join([*base, f"end{i % 50}"]), "en", "s", 0) for i in range(150)]  # one band of 50 classes
    want = brute([r[:2] for r in rows])
    df = spark.createDataFrame(rows, SCHEMA)
    for few, band_block in ((32, 20_000), (2, 7), (32, 7)):
        monkeypatch.setattr(setsketch, "FEW", few)
        out = setsketch.near_duplicates(df, "doc_id", band_block=band_block).collect()
        assert {r.doc_id: r.component_id for r in out} == want


def test_boilerplate_makes_no_clusters(spark, monkeypatch):
    """A chain whose neighbours are half alike: bands are shared, but nothing is sent to be verified."""
    rng = random.Random(11)
    parts = [prose(rng, 60) for _ in range(120)]
    rows = [(i, parts[i] + " " + parts[i + 1], "en", "s", 0) for i in range(119)]
    seen = []
    real = setsketch.components

    def watch(edges, a, b):
        seen.append(edges.count())
        return real(edges, a, b)

    monkeypatch.setattr(setsketch, "components", watch)
    out = setsketch.near_duplicates(spark.createDataFrame(rows, SCHEMA), "doc_id").collect()
    assert all(r.kept for r in out) and seen[0] < 10
