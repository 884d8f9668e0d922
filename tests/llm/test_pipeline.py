import zlib

import pytest
from llm_data import documents, frame
from test_decontaminate import brute as brute_hits
from test_risk_rules import plain
from test_setsketch import brute as brute_components
from test_setsketch import near_copies
from test_substrings import expected

pytest.importorskip("public_tokenizers")

import corpus_pipeline as P  # noqa: E402


def on_characters(raw, spans):
    """Byte ranges without the characters that they cover in part."""
    starts = [i for i in range(len(raw)) if raw[i] & 0xC0 != 0x80]
    gone = {i for a, b in spans for i in range(a, b)}
    out = b""
    for a, b in zip(starts, [*starts[1:], len(raw)], strict=True):
        if not all(i in gone for i in range(a, b)):
            out += raw[a:b]
    return out.decode()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    rows = documents() + [(i, t, "en", "s", len(t)) for i, t in near_copies(3)]
    rows += [rows[9]]
    docs = frame(spark, rows)
    long = next(t for i, t, *_ in rows if i == 42)
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, long[3000:3400]), (2, None)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in rows[:30]], "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_every_stage_against_brute_force(spark, folder):
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in P.STAGES:
        path = P.scratch_path(spark, "test-stage")
        stage(spark, docs, folder).write.parquet(path)
        seen.append((docs.collect(), out := spark.read.parquet(path).collect()))
        docs = spark.read.parquet(path)
        if len(seen) < 5:
            assert tuple(docs.columns) == P.COLUMNS
            assert all(r.n_chars is None or len(seen) < 3 or r.n_chars == len(r.text) for r in out)
    key = lambda x: str(x)
    before, after = seen[0]
    assert sorted([tuple(r) for r in after], key=key) == sorted([tuple(r) for r in before if not plain(r.text)[-1]], key=key)
    before, after = seen[1]
    root = brute_components([(r.doc_id, r.text) for r in before if r.doc_id is not None], P.NEAR_PERCENT)
    kept = {tuple(r) for r in before if r.doc_id is None or root[r.doc_id] == r.doc_id}
    assert sorted([tuple(r) for r in after], key=key) == sorted(kept, key=key)
    before, after = seen[2]
    raw = [r.text.encode() for r in before]
    want = [(r.doc_id, on_characters(t, s)) for r, t, (s, _) in zip(before, raw, expected(raw, 200), strict=True)]
    assert sorted([(r.doc_id, r.text) for r in after], key=key) == sorted(want, key=key)
    before, after = seen[3]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = {(i, t): (w, h) for i, t, w, h, _ in brute_hits(before, bench)}
    left = {(i, t): (w, h) for i, t, w, h, _ in brute_hits(after, [])}
    assert sum(h for _, h in hits.values()) > 20
    assert sum(w for w, _ in left.values()) == sum(w - h for w, h in hits.values())
    before, after = seen[4]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.vocabulary())
    pieces = []
    for r in before:
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        for a in range(0, len(ids), 4096):
            part = b"".join(x.to_bytes(4, "little") for x in ids[a: a + 4096])
            pieces.append((r.doc_id, a // 4096, a, len(part) // 4, zlib.crc32(part)))
    assert sorted([tuple(r)[:5] for r in after], key=key) == sorted(pieces, key=key)


def test_run_equals_the_stages_and_empty_tables_pass(spark, folder, tmp_path):
    assert P.run(spark, folder).count() > 20
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
