import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_data import frame
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from tabrix.llm import packing  # noqa: E402
from tabrix.llm.q_packing import vocabulary  # noqa: E402
from tabrix.llm.tokens import UnitEncoder  # noqa: E402


def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_units_give_the_ids_of_whole_texts():
    rng = random.Random(2)
    signs = [*"aAbBT zZ'sStTrev,!?#123\n\t\x0b\x00\x1céÉß×÷ÿ́̈İ…😀漢ſΣ -|<>", "'s", "'LL", "<|endoftext|>"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(3000)] + ["", " ", "'", "a" * 5000]
    got = UnitEncoder.of(vocabulary()).encode([t.encode() for t in texts])
    tok = whole()
    assert [g.tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_and_places(spark):
    docs = frame(spark)
    cut = packing.pieces(docs, "doc_id", "text", vocabulary(), capacity=64)
    rows = packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("c")), ["doc_id", "piece"],
                        capacity=64, group_rows=1000).collect()
    tok, expected = whole(), []
    for d in docs.collect():
        ids = [*tok.encode(d.text or "", add_special_tokens=False).ids, 1]
        expected += [(d.doc_id, a // 64, a, len(ids[a: a + 64]), zlib.crc32(np.array(ids[a: a + 64], "<u4").tobytes()))
                     for a in range(0, len(ids), 64)]
    key = lambda r: str(r)
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(expected, key=key)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= math.ceil(sum(r.length for r in rows) / 64) + 1


def test_empty_table_and_extra_columns(spark):
    assert packing.pieces(frame(spark, []), "doc_id", "text", vocabulary()).count() == 0
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "a"), (None, 3, "b")], "k int, length bigint, offset string")
    out = packing.pack(rows, ["k"], capacity=10).collect()
    assert sorted(r.length for r in out) == [3, 5, 5] and len({r.sequence_id for r in out}) == 2
    assert packing.pack(rows.limit(0), ["k"]).count() == 0


def test_local_search_empties_bins_that_best_fit_leaves():
    rng = random.Random(5)
    better = 0
    for _ in range(60):
        lengths = [rng.randint(20, 60) for _ in range(40)]
        first = packing.best_fit(lengths, 100)
        last = packing.local_search(lengths, first, 100)
        assert sorted(i for b in last for i in b) == list(range(40))
        assert all(sum(lengths[i] for i in b) <= 100 for b in last)
        assert len(last) <= len(first)
        better += len(last) < len(first)
    assert better > 0


def steps_left(lengths, bins, capacity):
    """Pairs of bins between which a piece, or one or two for one, can still go to the fuller."""
    bins = [[lengths[i] for i in b] for b in bins if sum(lengths[i] for i in b) < capacity]
    gives = [{*b, *(x + y for i, x in enumerate(b) for y in b[:i])} for b in bins]
    return sum(0 < x - y <= capacity - sum(high)
               for n, high in enumerate(bins) for m, low in enumerate(bins) if n != m and sum(low) <= sum(high)
               for y in {0, *high} for x in gives[m])


def test_local_search_of_many_bins_ends_when_no_step_is_left():
    rng = random.Random(7)
    for lengths, capacity in (([rng.randint(820, 2460) for _ in range(8000)], 4096),
                              ([3 * rng.randint(20, 60) for _ in range(600)], 301)):
        first = packing.best_fit(lengths, capacity)
        last = packing.local_search(lengths, first, capacity)
        assert sorted(i for b in last for i in b) == list(range(len(lengths)))
        assert all(0 < sum(lengths[i] for i in b) <= capacity for b in last)
        assert len(last) < len(first)
        assert steps_left(lengths, last, capacity) == 0
