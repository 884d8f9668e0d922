"""Whole queries at sf0.001 against brute force, where SQL cannot say what they give."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm_data import lower, space_words

import __spark_entry__ as entry
from tabrix.llm.q_sharding import TREE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    return entry.queries()[name](spark, SF).collect()


def draw(salt, path, j, key):
    """64 bits of (salt, path, child, key), each value hashed with the hash before it as seed."""
    h = xxhash.xxh64_intdigest(salt.encode(), 42)
    for v in (path, j, key):
        h = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), h)
    return h


def pick(key, salt, weights, path):
    if len(weights) == 1:
        return 0
    u = lambda j: ((draw(salt, path, j, key) >> 11) + 0.5) / 2**53
    return min((-math.log(u(j)) / w, j) for j, w in enumerate(weights) if w > 0)[1]


def shard(key, regions):
    racks = max(map(len, regions))
    r = pick(key, "tree/region", [sum(map(sum, x)) for x in regions], 0)
    # all racks draw, those that are not there never win
    k = pick(key, "tree/rack", [sum(x) for x in regions[r]] + [0] * (racks - len(regions[r])), r)
    width = max(len(k) for x in regions for k in x)
    mine = list(regions[r][k])
    s = pick(key, "tree/shard", mine + [0] * (width - len(mine)), r * racks + k)
    return sum(len(k) for x in regions[:r] for k in x) + sum(len(x) for x in regions[r][:k]) + s


def test_sharding(spark, documents):
    rows = run(spark, "op7_hash_tree_sharding")
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    slots = defaultdict(list)
    for r in rows:
        text = (documents[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 16, zlib.crc32(text), "key")
        assert r.shard == shard(r.doc_id, TREE.regions) and r.grown_shard == shard(r.doc_id, TREE.grown().regions)
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))


def test_packing(spark, documents):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from tabrix.llm.q_packing import vocabulary

    tok, want = Tokenizer.from_file(vocabulary()), []
    for i, d in documents.items():
        ids = [*tok.encode(d.text or "", add_special_tokens=False).ids, 1]
        for a in range(0, len(ids), 4096):
            want.append((i, a // 4096, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes())))
    rows = run(spark, "op1_best_fit_packing")
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(w[3] for w in want)
    fit = []  # best-fit decreasing
    for n in sorted((w[3] for w in want), reverse=True):
        room = [i for i, x in enumerate(fit) if x + n <= 4096]
        if room:
            fit[max(room, key=lambda i: fit[i])] += n
        else:
            fit.append(n)
    assert -(-total // 4096) <= len(by) <= len(fit)


def test_repeated_substrings(spark, documents):
    from test_substrings import expected

    ids = sorted(documents)
    texts = [(documents[i].text or "").encode() for i in ids]
    want = [(i, len(t), len(t) - len(k), len(s), hashlib.sha256(k).hexdigest()) for i, t, (s, k) in zip(ids, texts, expected(texts, 200), strict=True)]
    assert sorted(tuple(r) for r in run(spark, "op3_suffix_array_dedup")) == want


class Independent:
    """Katz backoff of order two, written from the formulas."""

    def __init__(self, texts, k=5):
        self.k = k
        self.uni = Counter(w for t in texts for w in t)
        self.bi = Counter((h, w) for t in texts for h, w in zip(["<s>", *t[:-1]], t, strict=True))
        self.n = sum(self.uni.values())
        self.after = defaultdict(dict)
        for (h, w), c in self.bi.items():
            self.after[h][w] = c
        self.du, self.db = self.factors(self.uni), self.factors(self.bi)
        left = sum((1 - self.du(c)) * c for c in self.uni.values()) / self.n
        self.unknown, self.rest = (left, 1.0) if left >= 1 / (self.n + 1) else (1 / (self.n + 1), (self.n / (self.n + 1)) / (1 - left))

    def factors(self, counts):
        of = Counter(counts.values())
        k, table = self.k, {}
        common = (k + 1) * of[k + 1] / of[1] if of[1] else 1.0
        for r in range(1, k + 1):
            good_turing = (r + 1) * of[r + 1] / of[r] if of[r] else 0.0
            d = (good_turing / r - common) / (1 - common) if of[r] and common < 1 else 0.0
            table[r] = d if 0 < d < 1 else (r - 0.5) / r
        return lambda c: table.get(c, 1.0)

    def p(self, w):
        c = self.uni.get(w, 0)
        return self.rest * self.du(c) * c / self.n if c else self.unknown

    def after_p(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.p(w)
        total = sum(seen.values())
        given = {x: self.db(c) * c / total for x, c in seen.items()}
        left = 1 - sum(given.values())
        if left <= 1e-15:
            given, left = {x: v * total / (total + 1) for x, v in given.items()}, 1 / (total + 1)
        return given[w] if w in given else left * self.p(w) / (1 - sum(map(self.p, seen)))


def test_scores(spark, documents):
    toks = {i: [*space_words(lower(d.text)), "</s>"] for i, d in documents.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in documents}
    model = Independent([t for i, t in toks.items() if not held[i]])
    n, v = model.n, len(model.uni)
    rows = run(spark, "op8_katz_backoff_scores")
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        t = toks[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(w in model.uni for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((model.uni.get(w, 0) + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert r.score == pytest.approx(sum(math.log10(model.after_p(h, w)) for h, w in zip(["<s>", *t[:-1]], t, strict=True)), rel=1e-6)
