"""Phrase collocations against a plain count of every phrase; tries, runs and dictionaries that overflow."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import frame, lower, prose

from tabrix.llm import collocations as C

SCHEMA = "text string, lang string"


def brute(docs, least, longest=5, cover=100, top=2000):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, *words[i:i + m]] += 1
    candidates = [p for p, a in f.items() if a >= least and len(p) > 2]
    out = {}
    for p in candidates:
        lang, words = p[0], p[1:]
        if any(q[0] == lang and len(q) > len(p) and 100 * f[q] >= cover * f[p]
               and any(q[1 + s:1 + s + len(words)] == words for s in range(len(q) - len(p) + 1)) for q in candidates):
            continue
        cuts = [(1000 * f[p] * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -f[p], " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]]))
    return sorted((lang, i + 1, w.decode(), -a, left, right, n[lang], -s)
                  for lang, rows in out.items() for i, (s, a, w, left, right) in enumerate(sorted(rows)[:top]))


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, docs=60, words=300):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "ünï", "\x00", "x y", *(f"w{i}" for i in range(40))]
    passage = [rng.choice(vocabulary) for _ in range(12)]
    rows = []
    for d in range(docs):
        body = []
        while len(body) < words:
            body += passage if rng.random() < 0.05 else ["of", "the"] if rng.random() < 0.4 else [rng.choice(vocabulary)]
        text = "".join(w + rng.choice([" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "? "]) for w in body)
        rows.append((text, [None, "en", "und", "de"][d % 4]))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"budget": 300, "burst": 20, "part": 500}, {"most": 5, "budget": 200, "burst": 8}, {"most": 5, "budget": 10}])
def test_against_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(C, "BLOCK", 1000 if sizes else C.BLOCK)
    docs = corpus(2)
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    want = brute(docs, 12)
    assert len(want) > 100 and max(len(r[2].split()) for r in want) == 5
    assert got(C.collocations(df, least=12, **sizes)) == want


def test_small_tops_covers_and_lengths(spark):
    docs = corpus(3, docs=30)
    df = spark.createDataFrame(docs, SCHEMA)
    assert got(C.collocations(df, least=10, longest=3, cover=60, top=7)) == brute(docs, 10, 3, 60, 7)


def test_edge_cases(spark):
    rows = [(None, "en"), ("", None), (" \t.\n", "en"), ("a b", "en"), ("a b", "en"), ("a b", None), ("a" * 300 + " b " + "a" * 300 + " b", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(C.collocations(df, least=2)) == brute(rows, 2)
    assert got(C.collocations(df, least=50)) == []
    assert got(C.collocations(df.limit(0))) == []
    clash = df.selectExpr("*", "1 AS f", "2 AS n", "3 AS ids", "4 AS `a.b`")
    assert got(C.collocations(clash, least=2)) == brute(rows, 2)


def test_long_texts_are_read_in_slices(spark, monkeypatch):
    monkeypatch.setattr(C, "SLICE", 64)
    rng = random.Random(1)
    text = prose(rng, 4000) + "\t" + "z" * 500 + " " + prose(rng, 200)
    assert [w for part in C.words_of(text.encode()) for w in part if w != b"\xff"] == \
        [w.encode() for p in re.split("[.,;:!?\x0a-\x0d]", lower(text)) for w in re.findall("[^\x20\x09]+", p)]


def test_trie_counts_and_spills_whole_subtrees():
    rng = np.random.default_rng(4)
    rows = (rng.zipf(1.5, (5000, 4)) % 30 + 1).astype(np.uint32)
    trie = C.HatTrie(4, burst=50)
    for a in range(0, 5000, 700):
        trie.add(rows[a:a + 700])
    assert any(isinstance(c, C.HatTrie) for c in trie.children.values())
    want = Counter(map(tuple, rows.tolist()))
    assert len(trie) == len(want)
    taken, counts = trie.take([1, 2])
    assert {r[0] for r in taken.tolist()} == {1, 2} and not {1, 2} & set(trie.children)
    rest, more = trie.take(list(trie.children))
    assert dict(zip(map(tuple, [*taken.tolist(), *rest.tolist()]), [*counts.tolist(), *more.tolist()], strict=True)) == want
    for kind in (np.uint32, np.uint64):
        back = C.decode_run(C.encode_run(taken.astype(kind), counts))
        assert (back[0] == taken).all() and (back[1] == counts).all()


def test_a_hot_prefix_is_dealt_over_partitions():
    rows = np.array([[1, 2, x, 4, 5] for x in range(10, 400)] + [[9, 2, x, 4, 5] for x in range(10, 400)], np.uint32)
    part = C.partition_of(rows, 2, 16)
    assert len(set(part[:390])) == 16 and len(set(part[390:])) == 1


def test_whole_rows_of_the_hard_cases(spark):
    df = frame(spark)
    rows = [(r["text"], r["lang"]) for r in df.collect()]
    assert got(C.collocations(df, least=3)) == brute(rows, 3)
