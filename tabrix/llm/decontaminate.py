"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of a partition's documents (``SHARD_BYTES`` of text). Its
words become symbols of the benchmark's vocabulary; any other word cannot be
part of a test phrase and so ends a run, like a document's end. Runs shorter
than the shortest phrase hold none and are left out. An FM-index over the runs
(Burrows-Wheeler transform with wavelet ranks) is searched backwards for all
phrases at once; occurrences are located through sampled suffix positions and
merged into removal spans per document. The documents are never shuffled.

The benchmark is the stated query set. It is dealt into blocks of about
``block_bytes``; a block is read to the driver and broadcast, one pass over the
documents per block. A pass is written out and its block let go before the next
begins, so neither the driver nor a worker holds more than one block.

Phrases: ``width`` consecutive words of an item; an item of fewer words, but not
none, is one phrase. Words are maximal runs of ASCII letters and digits and of
characters outside ASCII, A-Z in lower case.

Edge cases: NULL and empty texts have no words; items without words have no
phrase; repeated items count once by id, NULL ids under no id but their phrases
still hit; repeated documents are judged alike; an empty benchmark hits nothing;
extra columns pass through, an added name replaces an equal one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.llm.bwt import FMIndex
from tabrix.functions.nulls import quoted
from tabrix.llm.common import lean, slices, staged, texts_of

WIDTH = 10
SHARD_BYTES = 4 << 20
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ADDED = ("n_words", "n_hit", "spans", "items")


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts with first byte, length (in the joined texts) and text number."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=begins[1:])
    inside = _WORD[buf]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edge = begins[:-1][begins[:-1] < len(buf)]
    start[edge] = inside[edge]
    at = np.flatnonzero(start)
    dense = _LOWER[buf[inside]]
    offsets = np.zeros(len(at) + 1, np.int32)
    place = np.cumsum(inside, dtype=np.int32)
    if len(at):
        offsets[:-1] = place[at] - 1
    offsets[-1] = len(dense)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(dense)])
    return words, at, np.diff(offsets).astype(np.int64), begins


class Phrases:
    """The distinct phrases of a block of items, over the block's own vocabulary."""

    _last: tuple[str, Phrases] | None = None

    @classmethod
    def of(cls, name: str, block, width: int) -> Phrases:
        """The phrases of a block, made once per worker; a worker remembers one block."""
        if cls._last is None or cls._last[0] != name:
            cls._last = (name, cls(block.value, width))
        return cls._last[1]

    def __init__(self, items: Sequence[tuple[str | None, str | None]], width: int):
        texts = [(t or "").encode() for _, t in items]
        words, at, _, begins = words_of(texts)
        self.vocabulary = words.unique()
        symbol = pc.index_in(words, value_set=self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        bound = np.searchsorted(at, begins)
        owners: dict[tuple[int, ...], set[str]] = {}
        for i, (item, _) in enumerate(items):
            own = symbol[bound[i]: bound[i + 1]].tolist()
            for k in range(max(1, len(own) - width + 1) if own else 0):
                found = owners.setdefault(tuple(own[k: k + width]), set())
                if item is not None:
                    found.add(item)
        self.symbols = [np.asarray(p, np.int64) for p in owners]
        self.owners = list(owners.values())
        self.sizes = np.fromiter(map(len, owners), np.int64, len(owners))
        self.shortest = int(self.sizes.min(initial=1 << 30))


def _occurrences(symbol: np.ndarray, bound: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first word) of every occurrence among the shard's words."""
    n = len(symbol)
    # runs of known words inside a text
    cut = np.zeros(n + 1, bool)
    cut[bound] = True
    known = symbol > 0
    begin = known.copy()
    begin[1:] &= ~known[:-1] | cut[1:n]
    first = np.flatnonzero(begin)
    number = np.cumsum(begin) - 1
    size = np.bincount(number[known], minlength=len(first)) if len(first) else np.zeros(0, np.int64)
    keep = size >= phrases.shortest
    first, size = first[keep], size[keep]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # the runs one after another, a separator after each
    ends = np.cumsum(size + 1)
    word = np.arange(ends[-1]) + np.repeat(first - (ends - size - 1), size + 1)
    sequence = np.append(symbol, 0)[word]
    sequence[ends - 1] = 0
    index = FMIndex(sequence)
    lo, hi = index.search(phrases.symbols)
    found = np.repeat(np.arange(len(lo)), hi - lo)
    many = np.cumsum(hi - lo)
    places = np.arange(len(found)) + np.repeat(lo - (many - (hi - lo)), hi - lo)
    return found, word[index.locate(places)]


def search_shard(texts: list[bytes], phrases: Phrases, before: list[list[dict]]) -> list[tuple[int, int, list, set]]:
    """Per text: words, hit words, removal spans (bytes) and items; ``before`` are spans of earlier blocks."""
    words, at, size, begins = words_of(texts)
    bound = np.searchsorted(at, begins)
    code = pc.index_in(words, value_set=phrases.vocabulary)
    symbol = pc.fill_null(code, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    step = np.zeros(len(symbol) + 1, np.int64)
    items: list[set] = [set() for _ in texts]
    if len(symbol) and len(phrases.symbols):
        found, word = _occurrences(symbol, bound, phrases)
        np.add.at(step, word, 1)
        np.add.at(step, word + phrases.sizes[found], -1)
        text = np.searchsorted(bound, word, "right") - 1
        for p, t in set(zip(found.tolist(), text.tolist(), strict=True)):
            items[t] |= phrases.owners[p]
    hit = np.cumsum(step[:-1]) > 0
    for t, spans in enumerate(before):
        for s in spans or ():
            a, b = np.searchsorted(at, [begins[t] + s["start"], begins[t] + s["end"]])
            hit[a:b] = True
    edge = np.zeros(len(hit) + 1, bool)
    edge[bound] = True
    opens = np.flatnonzero(hit & (~np.append(False, hit[:-1]) | edge[:-1])) if len(hit) else np.zeros(0, np.int64)
    closes = np.flatnonzero(hit & (~np.append(hit[1:], False) | edge[1:])) if len(hit) else opens
    spans_of: list[list] = [[] for _ in texts]
    for a, b, t in zip(opens, closes, np.searchsorted(bound, opens, "right") - 1, strict=True):
        spans_of[t].append({"start": int(at[a] - begins[t]), "end": int(at[b] + size[b] - begins[t])})
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = np.diff(total[bound])
    return [(int(w), int(h), s, i) for w, h, s, i in zip(np.diff(bound), n_hit, spans_of, items, strict=True)]


def decontaminate(docs: DataFrame, text: str, benchmark: DataFrame, item: str = "item_id", item_text: str = "text",
                  carry: Sequence[str] | None = None, width: int = WIDTH, block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` (or its columns ``carry``) with n_words, n_hit, spans and items.

    ``spans``: merged byte ranges of hit words; ``items``: ids (strings, sorted) of
    items with an occurring phrase.
    """
    spark = docs.sparkSession
    lines = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text"))
    total = lines.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("text", "item"), F.lit(blocks))
    names = [c for c in docs.columns if c.lower() not in ADDED]
    # plain names on the way: Arrow functions take no names with dots
    plain = {c: f"c{i}" for i, c in enumerate(names)}
    out = docs.select(*[quoted(c).alias(p) for c, p in plain.items()])
    if blocks > 1:
        lines = staged(lines.withColumn("part", part), "benchmark-blocks")
    for b in range(blocks):
        # one block of about ``block_bytes`` at a time is on the driver and in the workers
        mine = lines.where(F.col("part") == b) if blocks > 1 else lines
        block = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in mine.toLocalIterator()])
        last = b == blocks - 1
        kept = [p for c, p in plain.items() if not last or carry is None or c in carry]
        schema = T.StructType([out.schema[c] for c in kept] + [
            T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
            T.StructField("spans", _SPANS), T.StructField("items", T.ArrayType(T.StringType()))])
        out = out.mapInArrow(lean(_pass(block, plain[text], width, kept, b > 0)), schema)
        if not last:
            # the pass ends here, and its block is let go
            out = staged(out, "decontamination-pass")
            block.destroy()
    return out.select(*[F.col(p).alias(c) for c, p in plain.items() if p in kept], *ADDED)


def _pass(block, text: str, width: int, kept: list[str], again: bool):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases.of(name, block, width)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
            for a, b in slices(sizes, SHARD_BYTES):
                old = batch.slice(a, b - a)
                texts = texts_of(old.column(text))
                before = old.column("spans").to_pylist() if again else [[]] * (b - a)
                found = search_shard(texts, phrases, before)
                items = [i | set(o) for (*_, i), o in zip(found, old.column("items").to_pylist(), strict=True)] if again else [
                    f[3] for f in found]
                cols = [old.column(c) for c in kept] + [
                    pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], _ARROW_SPANS),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=[*kept, *ADDED])

    return run


def remove_spans(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with the byte ranges ``spans`` (sorted, disjoint, on character borders) taken out of ``text``."""
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    n, s = F.octet_length(raw), F.col(spans)

    def part(i):
        start = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(s, i - 1)["end"])
        end = F.when(i == F.size(s), n.cast("long")).otherwise(F.get(s, i)["start"])
        return F.decode(F.substring(raw, (start + 1).cast("int"), (end - start).cast("int")), "utf-8")

    rest = F.array_join(F.transform(F.sequence(F.lit(0), F.size(s)), part), "")
    return df.withColumn(text, F.when(F.size(s) > 0, rest).otherwise(F.col(text)))
