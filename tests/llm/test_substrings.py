import random
from collections import Counter

import numpy as np
import pytest
from llm_data import SCHEMA, frame

from tabrix.llm import substrings


def expected(texts, width):
    seen = Counter(t[i: i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        flag = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i: i + width]] > 1:
                flag[i: i + width] = b"\1" * width
        edges = [i for i in range(len(t) + 1) if (flag[i] if i < len(t) else 0) != (flag[i - 1] if i else 0)]
        out.append((list(zip(edges[::2], edges[1::2], strict=True)), bytes(b for b, f in zip(t, flag, strict=True) if not f)))
    return out


@pytest.mark.parametrize("hot", [4000, 1])
def test_removal_equals_brute_force(spark, hot):
    docs = frame(spark)
    docs = docs.unionByName(docs.where("doc_id = 36"))  # a row that is repeated whole
    out = substrings.remove_repeats(docs, "doc_id", hot=hot, shard_bytes=5000).collect()
    assert out[0].__fields__ == [*docs.columns, "n_bytes", "spans", "kept"]
    rows = docs.collect()
    want = expected([(r.text or "").encode() for r in rows], 200)
    key = lambda x: str(x)
    assert sorted(((*r[:5], r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in out), key=key) == sorted(
        ((*r, len((r.text or "").encode()), s, k) for r, (s, k) in zip(rows, want, strict=True)), key=key)


def test_whole_characters_and_empty_table(spark):
    shared = "".join(random.Random(1).choices("abcdefgh", k=199))  # and the first byte of é and è
    rows = [(1, "1" + shared + "é", "en", "s", 1), (2, "2" + shared + "è2", "en", "s", 1)]
    out = substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA), "doc_id", whole_characters=True, carry=["doc_id"]).collect()
    assert sorted((r.doc_id, bytes(r.kept).decode()) for r in out) == [(1, "1é"), (2, "2è2")]
    assert substrings.remove_repeats(frame(spark, []), "doc_id").count() == 0


def test_interval_expansion_on_small_alphabets():
    rng = random.Random(3)
    for _ in range(20):
        width = rng.choice([8, 12, 20])
        texts = [bytes(rng.choices(rng.choice([b"ab", b"abcdefgh \xc3\xa9\0"]), k=rng.randint(width, 120))) for _ in range(12)] + [b"ab" * 30]
        texts += [texts[i][3: 3 + width + 9] for i in range(6) if len(texts[i]) >= 2 * width]
        flags = substrings.common_prefixes(texts, np.ones(len(texts), np.int64), width)
        seen, at = Counter(t[i: i + width] for t in texts for i in range(len(t) - width + 1)), 0
        for t in texts:
            n = max(0, len(t) - width + 1)
            assert flags[at: at + n].tolist() == [seen[t[i: i + width]] > 1 for i in range(n)]
            at += len(t) + 1


def test_runs_cover_each_window_once_also_in_long_texts(monkeypatch):
    monkeypatch.setattr(substrings, "_BLOCK", 1500)
    rng = random.Random(4)
    text = bytes(rng.choices(b"abc ", k=9000)) + b"z" * 9000
    number, start, n, *_ = substrings.text_runs([b"", text, b"x" * 199, b"y" * 200], 200, 48)
    for i, size in ((1, len(text)), (3, 200)):
        mine = sorted(zip(start[number == i].tolist(), n[number == i].tolist(), strict=True))
        assert mine[0][0] == 0 and sum(k for _, k in mine) == size - 199
        assert all(a + k == b for (a, k), (b, _) in zip(mine, mine[1:], strict=False))
    assert set(number.tolist()) == {1, 3}


def test_copies_and_dropped_intervals_on_weighted_segments():
    rng = random.Random(6)
    for _ in range(30):
        width = rng.choice([6, 9, 16])
        texts = [bytes(rng.choices(b"ab" if rng.random() < 0.5 else b"abcdef", k=rng.randint(width, 90))) for _ in range(8)]
        texts = list(dict.fromkeys(texts))
        copies = np.array([rng.choice([1, 1, 3]) for _ in texts])
        flags, at = substrings.common_prefixes(texts, copies, width), 0
        seen = Counter()
        for t, c in zip(texts, copies.tolist(), strict=True):
            for i in range(len(t) - width + 1):
                seen[t[i: i + width]] += c
        for t in texts:
            n = len(t) - width + 1
            assert flags[at: at + n].tolist() == [seen[t[i: i + width]] > 1 for i in range(n)]
            at += len(t) + 1


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("hot", [4000, 0])
def test_strings_that_polynomial_hashes_confuse(spark, hot):
    tm = thue_morse(2048)
    other = tm.translate(str.maketrans("ab", "ba"))
    rows = [(1, "1" + tm + "1", "en", "s", 1), (2, "2" + other + "2", "en", "s", 1), (3, other[:1500], "en", "s", 1)]
    out = substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA), "doc_id", hot=hot, carry=["doc_id"]).collect()
    want = expected([r[1].encode() for r in rows], 200)
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in out} == {r[0]: s for r, (s, _) in zip(rows, want, strict=True)}


def test_thousands_of_equal_rows(spark):
    import time

    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(10_000)}" for _ in range(900))
    times = []
    for rows in ([(i, text, "en", "s", 1) for i in range(5000)], [(None, text, "en", "s", 1)] * 5000):
        t = time.perf_counter()
        out = substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(8), "doc_id", carry=["doc_id"]).collect()
        times.append(time.perf_counter() - t)
        assert len(out) == 5000 and all(r.kept == b"" and len(r.spans) == 1 for r in out)
    assert times[1] < 5 * times[0] + 20
