import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import documents, frame, lower, space_words
from pyspark.sql import functions as F

from tabrix.llm import katz

END, BEGIN = "</s>", "<s>"


def stats(c):
    return np.array([sum(c.values()), len(c), *(sum(x == r for x in c.values()) for r in range(1, katz.K + 2))], float)


class Plain:
    """The same model over plain dictionaries."""

    def __init__(self, texts):
        self.words = Counter(w for t in texts for w in t)
        self.pairs = Counter(p for t in texts for p in zip([BEGIN, *t[:-1]], t, strict=True))
        self.uni, self.d = katz.Unigram(stats(self.words)), katz.discounts(stats(self.pairs))
        self.after = defaultdict(dict)
        for (h, w), c in self.pairs.items():
            self.after[h][w] = c

    def p1(self, w):
        return float(self.uni(np.array([self.words[w]]))[0])

    def p2(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.p1(w)
        total = sum(seen.values())
        cut = lambda c: self.d[c] if c <= katz.K else 1.0
        left = sum((1 - cut(c)) * c for c in seen.values()) / total
        scale = 1.0 if left > 0 else total / (total + 1)
        left = left if left > 0 else 1 / (total + 1)
        if w in seen:
            return scale * cut(seen[w]) * seen[w] / total
        return left / (1 - sum(map(self.p1, seen))) * self.p1(w)


@pytest.mark.parametrize("split", [2_000_000, 20])
def test_scores_equal_plain_model(spark, split):
    docs = frame(spark)
    docs = docs.unionByName(docs.where("doc_id = 6"))
    rem = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = katz.katz_scores(docs, "doc_id", "text", rem, slice_bytes=9000, split=split).collect()
    rows = [(r.doc_id, [*space_words(lower(r.text)), END]) for r in docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    model = Plain([t for i, t in rows if not held(i)])
    n, v = sum(model.words.values()), len(model.words)
    want = [(i, held(i), len(t), sum(model.words[w] > 0 for w in t), n,
             sum(math.log10((model.words[w] + 1) / (n + v + 1)) for w in t),
             sum(math.log10(model.p2(h, w)) for h, w in zip([BEGIN, *t[:-1]], t, strict=True))) for i, t in rows]
    key = lambda x: str(x[:5])
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=1e-6)


def test_probabilities_sum_to_one():
    model = Plain([[*space_words(lower(r[1])), END] for r in documents()])
    unknown = "nowhere seen"
    assert sum(map(model.p1, model.words)) + model.p1(unknown) == pytest.approx(1)
    for h in [BEGIN, "thor", "the0", unknown, *list(model.after)[:20]]:
        assert sum(model.p2(h, w) for w in [*model.words, unknown]) == pytest.approx(1)


def test_no_training_text_and_empty_table(spark):
    rows = katz.katz_scores(frame(spark), "doc_id", "text", F.lit(True)).collect()
    assert {r.train_tokens for r in rows} == {0} and {r.n_known for r in rows} == {0} and {r.score for r in rows} == {0.0}
    assert katz.katz_scores(frame(spark, []), "doc_id", "text", F.lit(False)).count() == 0


def test_discounts_without_rare_counts_stay_valid():
    for s in ([10, 2, 0, 0, 0, 0, 2, 0], [6, 6, 6, 0, 0, 0, 0, 0], [0] * 8, [9, 3, 1, 0, 0, 0, 0, 9]):
        d = katz.discounts(np.array(s, float))
        assert ((d > 0) & (d <= 1)).all()
        u = katz.Unigram(np.array(s, float))
        assert u.unknown > 0
