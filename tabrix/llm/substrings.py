"""Exact removal of long repeated substrings (suffix-array dedup).

A byte goes if a ``width``-byte string covering it starts anywhere else too, in
the same document or another. One suffix array over the whole corpus would be
one task, so equal strings are first brought together:

1. ``runs``: every ``width``-byte window has a content-defined anchor, the
   smallest hash of its ``gram``-byte strings. Consecutive windows with the same
   anchor form a run (at most ``RUN`` windows). Equal windows have equal anchors.
   A run row is narrow: document, place, anchor and a fingerprint of its bytes.
2. Anchors seen once in the corpus are dropped (counts with map-side combine).
   Equal runs (same anchor and BLAKE2 digest of the bytes) are counted and stand
   for one *segment*, so a text copied a thousand times is handled once; if an
   anchor's runs are all equal, all their windows are repeated.
3. ``common_prefixes``: the segments of an anchor meet in one shard. Their
   Burrows-Wheeler transform is expanded backwards, breadth-first, from the empty
   string: the intervals of level ``l`` give the borders between suffixes whose
   common prefix has length ``l``, by increasing ``l``. At ``width`` it stops:
   what no border separates by then shares ``width`` bytes or more. An interval
   that holds one suffix of one copy is dropped as it appears: every window around
   that string is unique.
4. The repeated windows of a segment go back to all its runs and become merged
   byte spans per document.

Hot anchors: an anchor with more than ``HOT`` distinct segments (say the edge of
a passage that very many documents share) is cut anew: each of its windows
becomes a run of its own, known by a 128-bit digest of the whole window. So
such windows spread over all shards and are counted with map-side combine.

Edge cases: NULL counts as empty; texts shorter than ``width`` bytes lose
nothing; repeated rows are copies of each other like any two rows; NULL and
repeated keys are fine (rows are told apart by key and text); an empty table
gives an empty result; extra columns pass through ``remove_repeats``, an added
name replaces an equal one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.llm.bwt import WaveletMatrix, suffix_order
from tabrix.llm.common import lean, staged, texts_of

WIDTH = 200
GRAM = 48
RUN = 4096
HOT = 4000
#: Bytes of segments in a shard, about.
SHARD = 1 << 20
_BLOCK = 1 << 18
_U = np.uint64


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64.

    The hashes place anchors; equal strings have equal ones, and nothing rests on
    different strings having different ones.
    """

    def __init__(self, base: int, n: int):
        self.up = self._powers(base, n)
        self.down = self._powers(pow(base, -1, 1 << 64), n)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sums(self, raw: np.ndarray) -> np.ndarray:
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + _U(1)) * self.up[: len(raw)], out=out[1:])
        return out

    def grams(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = len(sums) - size
        return _mix((sums[size:] - sums[:n]) * self.down[:n])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


_MADE: list[_Powers] = []


def _powers() -> _Powers:
    if not _MADE:
        _MADE.append(_Powers(0x5851F42D4C957F2D, 2 * _BLOCK + WIDTH + 8))
    return _MADE[0]


def digests(raw: bytes, start: np.ndarray, end: np.ndarray, size: int = 8) -> np.ndarray:
    """Digests of pieces of ``raw``, as rows of 64-bit numbers."""
    found = b"".join([blake2b(raw[a:b], digest_size=size).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    return np.frombuffer(found, np.int64).reshape(-1, size // 8)


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) over every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        x = best(x[:-span], x[span:])
        span *= 2
    return best(x[: len(x) - (width - span)], x[width - span:]) if span < width else x


def block_runs(raw: np.ndarray, valid: np.ndarray, width: int, gram: int):
    """Runs of a block: first window, windows, anchor, digest, weight.

    ``valid``: the windows that lie inside one document. Weight 2: the run holds
    its anchor twice, so two of its own windows may be equal.
    """
    a = _powers()
    g = a.grams(a.sums(raw), gram)
    w = width - gram + 1
    m = _sliding(g, w, np.minimum)
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (m[1:] != m[:-1])
    start = np.flatnonzero(first)
    # a run ends before the next one or before the next window that is not valid
    stop = np.flatnonzero(valid & np.append(first[1:] | ~valid[1:], True)) + 1
    long = np.flatnonzero(stop - start > RUN)
    if len(long):
        parts = -(-(stop - start) // RUN)
        at = np.repeat(np.arange(len(start)), parts)
        k = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
        start, stop = start[at] + k * RUN, np.minimum(start[at] + (k + 1) * RUN, stop[at])
    key = m[start]
    # anchors: places whose hash is the smallest of some window
    padded = np.concatenate([np.zeros(w - 1, np.uint64), m, np.zeros(w - 1, np.uint64)])
    anchors = np.flatnonzero(_sliding(padded, w, np.maximum) == g)
    lo, hi = np.searchsorted(anchors, start), np.searchsorted(anchors, stop + w - 1)
    count = np.zeros(len(start), np.int64)
    live = np.flatnonzero(lo < hi)
    while len(live):
        count[live] += g[anchors[lo[live]]] == key[live]
        lo[live] += 1
        live = live[(lo[live] < hi[live]) & (count[live] < 2)]
    mark = digests(raw.tobytes(), start, stop + width - 1)[:, 0]
    return start, stop - start, key.view(np.int64), mark, np.maximum(count, 1)


def _blocks(texts: list[bytes], width: int):
    """(texts' numbers, their offsets in the text, joined bytes, begins) of about ``_BLOCK`` bytes."""
    part, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < width:
            continue
        at = 0
        while at + width <= len(t):  # long texts: blocks that overlap by width - 1 bytes
            piece = t[at: at + _BLOCK + width - 1]
            part.append((i, at, piece))
            size += len(piece)
            at += _BLOCK
            if size >= _BLOCK:
                yield part
                part, size = [], 0
    if part:
        yield part


def text_runs(texts: list[bytes], width: int, gram: int):
    """Columns (text number, first window, windows, anchor, digest, weight) of all runs."""
    out = []
    for part in _blocks(texts, width):
        raw = np.frombuffer(b"".join(p for *_, p in part), np.uint8)
        size = np.array([len(p) for *_, p in part])
        begin = np.cumsum(size) - size
        valid = np.ones(len(raw) - width + 1, bool)
        for e in (begin + size)[:-1]:
            valid[e - width + 1: e] = False
        start, n, key, mark, weight = block_runs(raw, valid, width, gram)
        at = np.searchsorted(begin, start, "right") - 1
        number = np.array([i for i, *_ in part])[at]
        offset = np.array([o for _, o, _ in part])[at] + start - begin[at]
        out.append((number, offset, n, key, mark, weight))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def common_prefixes(segments: list[bytes], copies: np.ndarray, width: int) -> np.ndarray:
    """Which windows of the joined segments (a separator after each) occur twice or more.

    Returns a flag per place of the joined sequence.
    """
    raw = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    size = np.array([len(s) for s in segments])
    ends = np.cumsum(size + 1)
    separator = np.zeros(len(raw), bool)
    separator[ends - 1] = True
    used = np.flatnonzero(np.bincount(raw[~separator], minlength=256))
    dense = np.zeros(256, np.int16)
    dense[used] = np.arange(1, len(used) + 1)
    symbols = dense[raw]
    symbols[separator] = 0
    n = len(symbols)
    order = suffix_order(symbols, width)
    last = symbols[order - 1]
    bits = max(1, int(len(used)).bit_length())
    wavelet = WaveletMatrix(last, bits)
    count = np.bincount(symbols, minlength=1 << bits)
    first = np.cumsum(count) - count
    # border[i]: the suffixes at places i - 1 and i share fewer than width bytes
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    lo, hi = np.zeros(1, np.int64), np.full(1, n, np.int64)
    owner = np.repeat(np.arange(len(segments)), size + 1)
    once = copies[owner[order]] == 1
    # change of the number of unique strings that a window holds, from the window width places before
    steps = np.zeros(n + width + 2, np.int32)
    for level in range(1, width + 1):
        _, symbol, lo, hi = wavelet.branch(lo, hi, lo)
        text = symbol > 0  # strings never run over a segment's end
        symbol, lo, hi = symbol[text], lo[text], hi[text]
        lo, hi = first[symbol] + lo, first[symbol] + hi
        new = ~border[hi]
        # the last suffix starting with a symbol ends at a border of its own level
        lo, hi = lo[new], hi[new]
        border[hi] = True
        # a string that is found once makes every window around it unique, so it is not expanded;
        # a border that only its expansion would have set lies next to such a window
        alone = (hi - lo == 1) & once[lo]
        at = order[lo[alone]]
        steps[at + level] += 1
        steps[at + width + 1] -= 1
        lo, hi = lo[~alone], hi[~alone]
        if not len(lo):
            break
    # the whole windows among the suffixes that may be repeated, and their groups between borders
    room = np.repeat(ends - 1, size + 1) - np.arange(n)
    whole = (room >= width) & (np.cumsum(steps)[width: width + n] == 0)
    group = np.cumsum(border[:-1])
    sorted_whole = whole[order]
    weight = np.where(sorted_whole, copies[owner[order]], 0)
    total = np.bincount(group, weights=weight, minlength=int(group[-1]) + 1)
    flags = np.zeros(n, bool)
    flags[order] = sorted_whole & (total[group] >= 2)
    return flags


def _row_id(df: DataFrame, key: str, text: str) -> list:
    """96 bits that tell rows with different key or text apart."""
    t = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(F.col(key), t).alias("h1"), F.hash(t, F.col(key)).alias("h2")]


def _find_runs(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, start, n, key, mark, weight = text_runs(texts_of(batch.column(2)), width, gram)
            rows = pa.array(number, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start.astype(np.int64)),
                 pa.array(n.astype(np.int32)), pa.array(key), pa.array(mark), pa.array(weight.astype(np.int32))],
                names=["h1", "h2", "start", "n", "anchor", "mark", "weight"])

    return run


def _cut_segments(width: int):
    """The bytes of the wanted segments of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, want = texts_of(batch.column(0).field("t")), batch.column(1)
            row = np.repeat(np.arange(len(texts)), np.diff(want.offsets.to_numpy()))
            flat = want.flatten()
            start, n = (flat.field(f).to_numpy() for f in ("start", "n"))
            cut = [texts[r][a: a + k + width - 1] for r, a, k in zip(row.tolist(), start.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([flat.field("anchor"), flat.field("mark"), flat.field("copies"),
                                              pa.array(cut, pa.binary())], names=["anchor", "mark", "copies", "segment"])

    return run


def _cut_windows(width: int):
    """The digest of every window of the wanted runs of each text, in two halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, want = texts_of(batch.column(2).field("t")), batch.column(3)
            row = np.repeat(np.arange(len(texts)), np.diff(want.offsets.to_numpy()))
            flat = want.flatten()
            for r, start, n in zip(row.tolist(), flat.field("start").to_pylist(), flat.field("n").to_pylist(), strict=True):
                at = np.arange(start, start + n)
                halves = digests(texts[r], at, at + width, 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column(0)[r], n), pa.repeat(batch.column(1)[r], n), pa.array(at),
                     *(pa.array(np.ascontiguousarray(h)) for h in halves.T)], names=["h1", "h2", "start", "anchor", "mark"])

    return run


def _expand_shard(width: int):
    def run(table):
        anchor, mark = (table.column(c).to_numpy() for c in ("anchor", "mark"))
        order = np.lexsort((mark, anchor))
        # a row that is repeated with its key has sent its segments more than once
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(anchor[order]) != 0) | (np.diff(mark[order]) != 0)
        table = table.take(pa.array(order[new]))
        segments = table.column("segment").to_pylist()
        # an anchor with one segment of several copies: every window of it is repeated
        anchor, copies = table.column("anchor").to_numpy(), table.column("copies").to_numpy()
        _, group, count = np.unique(anchor, return_inverse=True, return_counts=True)
        equal = (count[group] == 1) & (copies > 1)
        asked = np.flatnonzero(~equal)
        size = np.array([len(s) + 1 for s in segments])
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        flags = np.repeat(equal, size) & (place <= np.repeat(size - 1 - width, size))
        if len(asked):
            flags[np.repeat(~equal, size)] = common_prefixes([segments[i] for i in asked], copies[asked], width)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
        begin = np.cumsum(size) - size
        owner = np.searchsorted(begin, edges[::2], "right") - 1
        counts = np.bincount(owner, minlength=len(segments))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        ranges = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
            [pa.array(edges[::2] - begin[owner]), pa.array(edges[1::2] - begin[owner])], names=["a", "b"]))
        out = pa.table([table.column("anchor"), table.column("mark"), ranges], names=["anchor", "mark", "ranges"])
        return out.filter(pa.array(counts > 0))

    return run


def _merge(starts: list[int], ends: list[int]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _on_characters(raw: bytes, spans: list[list[int]]) -> list[list[int]]:
    """Spans shrunk to whole UTF-8 characters; a partly covered character stays."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append([a, b])
    return out


def _take_out(kept: list[str], with_text: bool, width: int, whole_characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, spans, sizes = [], [], []
            row = batch.column(0)
            for raw, hits in zip(texts_of(row.field("t")), batch.column(1).to_pylist(), strict=True):
                first = [h["start"] + r["a"] for h in hits or () for r in h["ranges"]]
                last = [h["start"] + r["b"] - 1 + width for h in hits or () for r in h["ranges"]]
                found = _merge(first, last)
                if whole_characters:
                    found = _on_characters(raw, found)
                left, at = [], 0
                for a, b in found:
                    left.append(raw[at:a])
                    at = b
                rest.append(b"".join([*left, raw[at:]]))
                spans.append([{"start": a, "end": b} for a, b in found])
                sizes.append(len(raw))
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            whole = [pc.if_else(row.field("gone"), None, row.field("t"))] if with_text else []
            cols = [*(row.field(f"c_{i}") for i in range(len(kept))), *whole, pa.array(sizes, pa.int64()),
                    pa.array(spans, spans_type), pa.array(rest, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, *["text"] * with_text, "n_bytes", "spans", "kept"])

    return run


_RANGES = "array<struct<a:bigint,b:bigint>>"


def remove_repeats(docs: DataFrame, key: str, text: str = "text", carry: list[str] | None = None, width: int = WIDTH,
                   gram: int = GRAM, hot: int = HOT, shard_bytes: int = SHARD, whole_characters: bool = False) -> DataFrame:
    """The columns ``carry`` of ``docs`` with n_bytes, spans (removed byte ranges) and kept (the remaining bytes).

    ``whole_characters``: leave a character in that is covered in part, so that ``kept`` is valid UTF-8.
    """
    names = [c for c in docs.columns if c.lower() not in ("n_bytes", "spans", "kept")]
    carry = names if carry is None else [c for c in names if c in carry]
    t = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in carry if c != text]
    # one relation for both joins with the texts below, so that the texts are dealt by row id once;
    # Python takes it whole, or pruning would make two of it
    row = F.struct(t.alias("t"), *[F.col(c).alias(f"c_{i}") for i, c in enumerate(kept)],
                   *[F.col(text).isNull().alias("gone")] * (text in carry)).alias("row")
    keyed = docs.select(*_row_id(docs, key, text), row)
    runs = staged(keyed.select("h1", "h2", "row.t").mapInArrow(
        lean(_find_runs(width, gram)), "h1 bigint, h2 int, start bigint, n int, anchor bigint, mark bigint, weight int"), "repeat-runs")
    again = runs.groupBy("anchor").agg(F.sum("weight").alias("w")).where("w >= 2").select("anchor")
    found = staged(runs.drop("weight").join(again, "anchor", "left_semi"), "repeat-candidates")
    place = F.min(F.struct("h1", "h2", "start")).alias("at")
    segments = staged(found.groupBy("anchor", "mark").agg(F.count(F.lit(1)).alias("copies"), place, F.max("n").alias("n")),
                      "repeat-segments")
    crowded = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot).select("anchor")
    crowded = staged(crowded, "repeat-hot")
    calm = segments.join(crowded, "anchor", "left_anti")
    total = calm.agg(F.coalesce(F.sum(F.col("n") + (width - 1)), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))

    want = calm.groupBy("at.h1", "at.h2").agg(F.collect_list(F.struct(
        F.col("at.start").alias("start"), "n", "anchor", "mark", "copies")).alias("want"))
    bytes_of = keyed.join(want, ["h1", "h2"]).select("row", "want").mapInArrow(
        lean(_cut_segments(width)), "anchor bigint, mark bigint, copies bigint, segment binary")
    ranges = bytes_of.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(shards))).applyInArrow(
        _expand_shard(width), f"anchor bigint, mark bigint, ranges {_RANGES}")
    hits = found.join(ranges, ["anchor", "mark"]).select("h1", "h2", "start", "ranges")

    if not crowded.isEmpty():
        lots = found.join(crowded, "anchor", "left_semi").select("h1", "h2", "start", "n").distinct()
        lots = lots.groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "n")).alias("want"))
        windows = keyed.join(lots, ["h1", "h2"]).select("h1", "h2", "row", "want").mapInArrow(
            lean(_cut_windows(width)), "h1 bigint, h2 int, start bigint, anchor bigint, mark bigint")
        windows = staged(windows, "repeat-windows")
        twice = windows.groupBy("anchor", "mark").agg(F.count(F.lit(1)).alias("c")).where("c >= 2").drop("c")
        one = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(1).cast("long").alias("b")))
        more = windows.join(twice, ["anchor", "mark"], "left_semi").select("h1", "h2", "start", one.alias("ranges"))
        hits = hits.unionByName(more)

    # rows that repeat a document whole have the same hits: theirs are a set
    repeated = runs.where("start = 0").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    repeated = staged(repeated.select("h1", "h2", F.lit(True).alias("twin")), "repeat-rows")
    entry = F.struct("start", "ranges")
    if repeated.isEmpty():
        entries = F.collect_list(entry)
    else:
        hits = hits.join(repeated, ["h1", "h2"], "left")
        entries = F.concat(F.collect_list(F.when(F.col("twin").isNull(), entry)), F.collect_set(F.when(F.col("twin"), entry)))
    by_row = hits.groupBy("h1", "h2").agg(entries.alias("hits"))
    rows = keyed.join(by_row, ["h1", "h2"], "left").select("row", "hits")
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    added = ["n_bytes bigint", "spans array<struct<start:bigint,end:bigint>>", "kept binary"]
    if text in carry:
        fields += [f"`{text}` string"]
    return rows.mapInArrow(lean(_take_out(kept, text in carry, width, whole_characters)), ", ".join(fields + added)).select(
        *carry, "n_bytes", "spans", "kept")
