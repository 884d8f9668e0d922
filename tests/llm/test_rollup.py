import pytest

from tabrix.llm.common import scratch_path
from tabrix.llm.rollup import Rollup, signed

CHANGE = "op string, source string, lang string, version string, tokens bigint, old_tokens bigint, extra int"


def changes(spark, *rows):
    return signed(spark.createDataFrame([(*r, 0) for r in rows], CHANGE))


def test_deltas_and_idempotent_commits(spark):
    store = Rollup(spark, scratch_path(spark, "rollup"))
    assert store.totals().count() == 0 and not store.committed("a")
    first = changes(spark, ("insert", "s", "en", "v1", 10, None), ("insert", "s", "en", "v1", 10, None),
                    ("insert", None, None, None, None, None), ("insert", "t", "fr", "v1", 3, None))
    assert store.commit("a", first) and not store.commit("a", first) and store.committed("a")
    assert Rollup(spark, store.path).commit("b", changes(spark, ("revise", "s", "en", "v1", 7, 10), ("delete", "t", "fr", "v1", 3, None)))
    assert set(map(tuple, store.totals().collect())) == {("s", "en", "v1", 2, 17), (None, None, None, 1, 0)}
    assert store.commit("empty", first.limit(0)) and store.committed("empty")
    assert store.totals().count() == 2


def test_a_batch_that_died_before_its_record_does_not_count_and_can_be_retried(spark):
    store = Rollup(spark, scratch_path(spark, "rollup"))
    one = changes(spark, ("insert", "s", "en", "v", 5, None))
    store.commit("a", one)
    import uuid

    left = uuid.uuid5(uuid.NAMESPACE_URL, "b").hex  # deltas of b without a commit record
    one.selectExpr("source", "lang", "version", "documents", "tokens", f"'{left}' AS folder").write.parquet(f"{store.path}/deltas/{left}")
    assert [r.tokens for r in store.totals().collect()] == [5]
    assert store.commit("b", one)
    assert [r.tokens for r in store.totals().collect()] == [10]


def test_unknown_changes_are_errors(spark):
    with pytest.raises(Exception, match="unknown change"):
        changes(spark, ("upsert", "s", "en", "v", 5, None)).collect()


def test_query_equals_brute_force(spark):
    pytest.importorskip("public_tokenizers")
    from collections import Counter

    from tokenizers import Tokenizer

    from tabrix.llm.q_packing import vocabulary
    from tabrix.llm.q_rollup import BPE, WORDS, op6_token_rollup

    where = "/root/testdata/sf0.001"
    got = sorted(map(tuple, op6_token_rollup(spark, where).collect()))
    tok, seen, docs, tokens = Tokenizer.from_file(vocabulary()), set(), Counter(), Counter()
    for r in sorted(spark.read.parquet(f"{where}/documents.parquet").collect(), key=lambda r: r.doc_id):
        if r.text not in seen:
            seen.add(r.text)
            for v, n in ((WORDS, len((r.text or "").encode().split())), (BPE, len(tok.encode(r.text or "", add_special_tokens=False).ids))):
                docs[r.source, r.lang, v] += 1
                tokens[r.source, r.lang, v] += n
    assert got == sorted((*k, docs[k], tokens[k]) for k in docs)


def test_two_writers_of_one_batch_count_once(spark):
    path = scratch_path(spark, "rollup")
    one = changes(spark, ("insert", "s", "en", "v", 5, None))

    class Late(Rollup):
        """Looks for the record before the other writer's is there."""

        def committed(self, batch):
            seen = super().committed(batch)
            if not seen:
                assert Rollup(self.spark, self.path).commit(batch, one)
            return seen

    assert not Late(spark, path).commit("a", one)
    assert [tuple(r) for r in Rollup(spark, path).totals().collect()] == [("s", "en", "v", 1, 5)]
    # records of both, as if both had found none: the smaller folder counts
    other = "0" * 32
    one.selectExpr("source", "lang", "version", "documents", "tokens", f"'{other}' AS folder").write.parquet(f"{path}/deltas/{other}")
    spark.sql(f"SELECT 'a' AS batch, '{other}' AS folder").write.parquet(f"{path}/commits/second")
    assert [tuple(r) for r in Rollup(spark, path).totals().collect()] == [("s", "en", "v", 1, 5)]


def test_totals_are_kept_as_bases(spark):
    store = Rollup(spark, scratch_path(spark, "rollup"), fold=3)
    for i in range(8):
        assert store.commit(f"b{i}", changes(spark, ("insert", f"s{i % 2}", "en", "v", 10 + i, None)))
    assert store._base()[0] == 2 and store._open().count() == 2
    want = {("s0", "en", "v", 4, 10 + 12 + 14 + 16), ("s1", "en", "v", 4, 11 + 13 + 15 + 17)}
    assert set(map(tuple, store.totals().collect())) == want
    store.compact()
    assert store._open().count() == 0 and set(map(tuple, store.totals().collect())) == want
    # a base whose writer died before the record is not read
    spark.sql("SELECT 's0' AS source, 'en' AS lang, 'v' AS version, 99L AS documents, 99L AS tokens").write.parquet(f"{store.path}/totals/dead")
    assert set(map(tuple, store.totals().collect())) == want
    assert not store.commit("b3", changes(spark, ("insert", "s0", "en", "v", 1, None)))
    assert store.commit("gone", changes(spark, *[("delete", "s0", "en", "v", 13, None)] * 4))
    assert set(map(tuple, store.totals().collect())) == {("s1", "en", "v", 4, 56)}


def test_a_batch_committed_while_a_base_is_written_is_counted(spark):
    store = Rollup(spark, scratch_path(spark, "rollup"), fold=100)
    store.commit("a", changes(spark, ("insert", "s", "en", "v", 1, None)))

    class Slow(Rollup):
        def _sum(self, base, folders):
            out = super()._sum(base, folders)
            Rollup(self.spark, self.path, 100).commit("b", changes(self.spark, ("insert", "s", "en", "v", 2, None)))
            return out

    Slow(spark, store.path).compact()
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "v", 2, 3)]
