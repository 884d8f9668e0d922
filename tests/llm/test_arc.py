import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tabrix.llm import arc
from tabrix.llm.common import scratch_path

BIG = "<p>é\r\n\r\nWARC/1.1\r\nfiledesc://x</p>" * 10
ROWS = [(3, "http://a/b c\n", BIG, "x"), (1, "https://b", BIG, "x"), (7, None, BIG, "x"), (7, None, BIG, "x"), (4, "u", "short", "x"),
        (5, "u", "short", "x"), (6, "u", None, "x"), (None, "u", "", "x"), (8, "u", "y" * 100_000, "x"), (9, "u", "z" * 99, "x"),
        (2, "u", "z" * 99, "x"), (None, "n", BIG, "x"), (11, "u", "a\x00b\n\n" * 30, "x")]


def convert(spark, pages):
    legacy, archive = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    for v in (1, 2):
        arc.write_arc(pages.where(F.coalesce(F.col("page_id"), F.lit(0)) % 2 == v - 1), f"{legacy}/v{v}", v)
    records = arc.read_arc(spark, legacy)
    arc.write_warc(arc.mark_revisits(records), archive)
    return records, arc.read_warc(spark, archive)


def test_pages_survive_both_conversions(spark):
    pages = spark.createDataFrame(ROWS, "page_id int, url string, html string, payload string")
    records, back = convert(spark, pages)
    key = lambda x: str(x)
    body = lambda h: (h or "").encode()
    assert sorted([(r.page_id, r.payload, r.date, r.media) for r in records.collect()], key=key) == sorted(
        [(p, h or "", "2000-01-01T00:00:00Z", "text/html") for p, _, h, _ in ROWS], key=key)
    rows = back.collect()
    ids = {r.record_id: r for r in rows}
    assert len(ids) == len(ROWS)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest) for r in rows], key=key) == sorted(
        [(p, len(body(h)), hashlib.sha256(body(h)).hexdigest()) for p, _, h, _ in ROWS], key=key)
    big = [r for r in rows if r.payload_bytes == len(body(BIG))]
    assert [r.page_id for r in big if r.record_type == "response"] == [1]
    assert {ids[r.refers_to].page_id for r in big if r.record_type == "revisit"} == {1}
    assert {r.record_type for r in rows if r not in big} == {"response"}


def test_field_lines_of_the_versions_and_broken_files():
    v2 = f"filedesc://f 0.0.0.0 20000101000000 text/plain 200 - - 0 f {len(arc.FIELDS[2]) + 6}\n2 0 o\n{arc.FIELDS[2]}\n\n"
    raw = (v2 + "http://x/a b 1.2.3.4 19990203040506 text/html 200 abc - 12 f 5\nhello\n\nhttp://y 1.2.3.4 19990203040506 text/html 404 - - 12 f 0\n\n").encode()
    got = [(f["URL"], f["Result-code"] if "Result-code" in f else None, b) for f, _, b in arc._arc_records(raw)]
    assert got[1:] == [("http://x/a b", "200", b"hello"), ("http://y", "404", b"")]
    with pytest.raises(ValueError, match="declares"):
        list(arc._arc_records(b"http://x 1.2.3.4 19990203040506 text/html 50\nshort"))
    with pytest.raises(ValueError, match="fields"):
        list(arc._arc_records(b"http://x 50\nshort"))
    assert zlib.decompress(zlib.compress(raw)) == raw


def test_empty_table(spark):
    pages = spark.createDataFrame(ROWS[:1], "page_id int, url string, html string, payload string").limit(0)
    records, back = convert(spark, pages)
    assert records.count() == 0 and back.count() == 0


def gz(*records):
    return b"".join(zlib.compress(r, wbits=31) for r in records)


def arc_file(tmp_path, spark, content, name="a.arc.gz"):
    d = tmp_path / name.split(".")[0]
    d.mkdir(exist_ok=True)
    (d / name).write_bytes(content)
    return str(d)


LINE = "{} 1.2.3.4 1999020304 {} {}\n"


def records(*items):
    block = f"1 0 org\n{arc.FIELDS[1]}\n"
    out = [f"filedesc://f.arc 0.0.0.0 19990101000000 text/plain {len(block)}\n{block}\n".encode()]
    for url, media, block in items:
        out.append(LINE.format(url, media, len(block)).encode() + block + b"\n")
    return out


LATIN = b"HTTP/1.0 200 OK\nContent-Type: text/html\n\n<p>caf\xe9 " + b"x" * 200
ITEMS = [("http://a/", "text/html", LATIN), ("dns:a", "text/dns", b"19990203040506\na. 1 IN A 1.2.3.4"),
         ("http://b/", "text/html", LATIN), ("filedesc://page", "text/html", b"HTTP/1.0 200 OK\r\nX-Page-Id: 5\r\n\r\nWARC/1.1\r\n\r\nhello"),
         ("ftp://c/i.png", "image/png", bytes(range(256)))]


@pytest.mark.parametrize("form", ["members", "one member", "plain", "odd members"])
def test_archives_of_all_forms_keep_every_record(spark, tmp_path, form):
    raw = records(*ITEMS)
    whole = b"".join(raw)
    content = {"members": gz(*raw), "one member": gz(whole), "plain": whole, "odd members": gz(whole[:77], b"", whole[77:300], whole[300:])}[form]
    got = arc.read_arc(spark, arc_file(tmp_path, spark, content, f"{form.replace(' ', '')}.arc.gz"), info=True).collect()
    assert [(r.kind, r.uri) for r in got] == [("warcinfo", "filedesc://f.arc"), ("response", "http://a/"), ("resource", "dns:a"),
                                              ("response", "http://b/"), ("response", "filedesc://page"), ("resource", "ftp://c/i.png")]
    assert [bytes(r.payload_raw) if r.payload is None else r.payload.encode() for r in got[1:]] == [
        LATIN.split(b"\n\n", 1)[1], ITEMS[1][2], LATIN.split(b"\n\n", 1)[1], b"WARC/1.1\r\n\r\nhello", ITEMS[4][2]]
    assert {r.date for r in got[1:]} == {"1999-02-03T04:00:00Z"} and got[4].page_id == 5
    assert len({r.record_id for r in got}) == 6


def test_bytes_types_and_members_through_warc(spark, tmp_path):
    path = arc_file(tmp_path, spark, gz(*records(*ITEMS)))
    archive = scratch_path(spark, "warc")
    arc.write_warc(arc.mark_revisits(arc.read_arc(spark, path, info=True)), archive)
    files = [r.content for r in spark.read.format("binaryFile").load(archive).collect()]
    parts = [m for f in files for m in arc.members(bytes(f))]
    assert len(parts) == 6 and all(p.startswith(b"WARC/1.1\r\n") and p.endswith(b"\r\n\r\n") for p in parts)
    assert sum(LATIN in p for p in parts) == 1 and any(ITEMS[4][2] in p for p in parts)
    back = {r.record_id: r for r in arc.read_warc(spark, archive).collect()}
    kinds = sorted(r.record_type for r in back.values())
    assert kinds == ["resource", "resource", "response", "response", "revisit", "warcinfo"]
    revisit = next(r for r in back.values() if r.record_type == "revisit")
    assert back[revisit.refers_to].record_type == "response" and revisit.payload_digest == back[revisit.refers_to].payload_digest
    assert revisit.payload_digest == hashlib.sha256(LATIN.split(b"\n\n", 1)[1]).hexdigest()


def test_cut_off_files_are_errors():
    raw = b"".join(records(*ITEMS))
    with pytest.raises(ValueError, match="member"):
        list(arc._arc_records(arc.members(gz(raw)[:-20])))
    with pytest.raises(ValueError, match="declares"):
        list(arc._arc_records(arc.members(gz(raw[:-40]))))
    with pytest.raises(ValueError, match="none"):
        list(arc.members(gz(raw) + b"junk"))


def test_records_of_any_size_end_in_a_zero_byte():
    for n in (0, 1, 300, (1 << 24) - 1, 1 << 24, (1 << 24) + 5):
        packed = arc.member(b"a" * n)
        assert packed[-1] == 0 and b"".join(arc.members(packed)) == b"a" * n


def test_pages_as_bytes_by_record(spark):
    pages = spark.createDataFrame([(1, "u", bytearray(b"\xff\xfe" * 80)), (2, "filedesc://u", bytearray(b"\xff\xfe" * 80)), (3, "v", None)],
                                  "page_id int, url string, html binary")
    legacy, archive = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    arc.write_arc(pages.coalesce(1), legacy, 2, by_record=True)
    arc.write_warc(arc.mark_revisits(arc.read_arc(spark, legacy)), archive)
    got = sorted((r.page_id, r.record_type, r.payload_bytes) for r in arc.read_warc(spark, archive).collect())
    assert got == [(1, "response", 160), (2, "revisit", 160), (3, "response", 0)]
