import random
import re

import numpy as np
from llm_data import frame, lower, prose
from pyspark.sql import functions as F

from tabrix.llm.bwt import FMIndex, WaveletMatrix
from tabrix.llm.decontaminate import decontaminate, remove_spans


def words(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s))


def items(docs):
    long = next(r.text for r in docs if r.doc_id == 42)
    rng = random.Random(9)
    return [(1, long[200:500]), (2, "one, TWO!"), (2, "one, TWO!"), (3, None), (4, ""), (5, "..."), (None, "x y x"),
            (10, prose(rng, 30)), (6, "Thor " * 12)]


def brute(docs, bench):
    windows = {}
    for i, t in bench:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k: k + 10]), set()).update([] if i is None else [str(i)])
    out = []
    for d in docs:
        w, hit, found = words(d.text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[k: k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= own
        out.append((d.doc_id, d.text, len(w), len(hit), sorted(found)))
    return out


def test_hits_equal_brute_force_in_one_block_and_in_many(spark):
    docs = frame(spark).withColumn("SPANS", F.lit(1))
    rows = docs.collect()
    bench = items(rows)
    table = spark.createDataFrame(bench, "item_id int, text string")
    want = sorted(brute(rows, bench), key=str)
    for block in (8 << 20, 100):
        out = decontaminate(docs, "text", table, block_bytes=block)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "n_hit", "spans", "items"]
        got = out.collect()
        assert sorted([(r.doc_id, r.text, r.n_words, r.n_hit, r["items"]) for r in got], key=str) == want
        for r in got:
            inside = sum(len(words((r.text or "").encode()[s.start: s.end].decode())) for s in r.spans)
            assert inside == r.n_hit
    cleaned = {r.doc_id: r for r in remove_spans(out).collect()}
    for r in got:
        raw, at, left = (r.text or "").encode(), 0, b""
        for s in r.spans:
            left, at = left + raw[at: s.start], s.end
        if r.doc_id is not None:
            assert (cleaned[r.doc_id].text or "") == (left + raw[at:]).decode()


def test_empty_tables(spark):
    docs = frame(spark)
    none = spark.createDataFrame([], "item_id int, text string")
    assert {r.n_hit for r in decontaminate(docs, "text", none).collect()} == {0}
    some = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert decontaminate(docs.limit(0), "text", some, carry=["doc_id"]).count() == 0


def test_index_ranks_and_places():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 11, 300)
    m = WaveletMatrix(v, 4)
    for s in range(11):
        at = np.arange(301)
        assert m.rank(np.full(301, s), at).tolist() == [int((v[:i] == s).sum()) for i in at]
    text = np.append(np.tile(rng.integers(1, 4, 50), 6), 0)
    index = FMIndex(text)
    patterns = [text[i: i + k] for i in range(0, 200, 7) for k in (1, 3, 9)] + [np.array([3, 3, 3, 3, 3, 3, 3, 3]), np.array([99])]
    lo, hi = index.search(patterns)
    for p, a, b in zip(patterns, lo, hi, strict=True):
        found = sorted(index.locate(np.arange(a, b)).tolist())
        assert found == [i for i in range(len(text)) if text[i: i + len(p)].tolist() == p.tolist()]


def test_names_with_dots_pass_in_one_block_and_in_many(spark):
    docs = frame(spark).withColumn("a.b", F.lit(3))
    rows = docs.collect()
    table = spark.createDataFrame(items(rows), "item_id int, text string")
    for block in (8 << 20, 100):
        out = decontaminate(docs, "text", table, block_bytes=block).collect()
        assert len(out) == len(rows) and {r["a.b"] for r in out} == {3}


def test_memory_of_a_pass_is_bounded_by_shards():
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    from tabrix.llm import decontaminate as D

    words = [f"w{i}" for i in range(500)]
    text = " ".join(words[i * i % 500] for i in range(1000))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 2500 + [None])], names=["text"])
    run = D._pass(SimpleNamespace(value=[("a", " ".join(words[:40])), ("b", text[:200])]), "text", 10, [], False)
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    print(batch.nbytes, peak)
    assert rows == 2501 and peak < 30 * (4 << 20) + 2 * batch.nbytes


def test_memory_goes_back_when_a_task_ends(monkeypatch):
    from tabrix.llm import common

    gone = []
    monkeypatch.setattr(common, "give_back", lambda: gone.append(1))
    assert list(common.lean(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and gone == [1]
