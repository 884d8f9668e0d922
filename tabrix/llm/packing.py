"""Best-fit packing of token sequences with swap-based local search.

``pieces`` turns documents into token pieces of at most ``capacity`` ids.
``pack`` puts pieces into as few sequences as it can. The rows to pack are
narrow (a length and what the caller carries along); they are dealt at random
into groups of about ``group_rows`` and every group is packed on its own, so the
work is spread over tasks and no task grows with the input. A group leaves less
than one sequence's worth of unused room beyond what its packing wastes.

Within a group: best-fit decreasing first (a piece goes where it leaves the
least room), then local search over the underfull sequences. It takes them from
the fullest to the emptiest and lets each get a piece, or one piece for a smaller
one of its own, or two for one, from another that is no fuller: whatever fills it
most, from the emptiest that has it. Each such step shifts tokens from an emptier
to a fuller sequence and so increases the sum of squared fills; a sequence that
runs empty is dropped. An index by size (a length, or the sum of two of one
sequence) names the emptiest giver, so sequences that have nothing to give are
not looked at. The search ends when no step is left or when the lower bound
``ceil(tokens / capacity)`` is reached, and at nothing else.

Edge cases: NULL text counts as empty and gives one piece with the end id alone;
repeated rows and NULL keys are packed like any other; an empty table gives an
empty result. Extra columns of ``pack``'s input pass through.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.llm.common import fresh, lean, slices, texts_of

CAPACITY = 4096
END = 1


def pieces(docs: DataFrame, key: str, text: str, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(key, piece, start, length, ids) with ``ids`` as little-endian unsigned 32-bit ids.

    A document's ids end with ``end``. Only documents longer than ``capacity``
    are cut, into pieces of ``capacity`` ids; the last may be shorter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tabrix.llm.tokens import UnitEncoder

        encoder = UnitEncoder.of(vocabulary)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices([len(t) for t in texts], 8 << 20):
                doc, piece, length, ids = [], [], [], []
                for i, x in enumerate(encoder.encode(texts[a:b]), a):
                    x = np.append(x, np.uint32(end))
                    for j, at in enumerate(range(0, len(x), capacity)):
                        part = x[at: at + capacity]
                        doc.append(i)
                        piece.append(j)
                        length.append(len(part))
                        ids.append(part.astype("<u4").tobytes())
                keys = batch.column(0).take(pa.array(doc, pa.int32()))
                start = pa.array(np.asarray(piece, np.int64) * capacity)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(piece, pa.int32()), start, pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=[key, "piece", "start", "length", "ids"])

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    return docs.select(key, text).mapInArrow(lean(cut), schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: item numbers by bin."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin with room r is open
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        left = room - n
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins


def _give(items: list[tuple[int, int]], size: int) -> tuple[tuple[int, int], ...]:
    """One piece, or else two, of ``items`` (length, item) whose lengths sum to ``size``."""
    seen: dict[int, tuple[int, int]] = {}
    for x in items:
        if x[0] == size:
            return (x,)
        seen.setdefault(x[0], x)
    return next((x, y) for x in items if (y := seen.get(size - x[0])) is not None and y != x)


class _Offers:
    """Which underfull bin gives a size (one piece, or two together), the emptiest first."""

    def __init__(self, bins: dict[int, list[tuple[int, int]]], fill: list[int], capacity: int):
        self.fill, self.version = fill, dict.fromkeys(bins, 0)
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
        #: fill of the first bin of every size; outdated entries make it too low, never too high
        self.first = np.full(capacity + 1, capacity + 1, np.int64)
        for b, items in bins.items():
            for size in self.sizes(items):
                self.heaps[size].append((fill[b], b, 0))
        for size, heap in enumerate(self.heaps):
            if heap:
                heapq.heapify(heap)
                self.first[size] = heap[0][0]

    @staticmethod
    def sizes(items: list[tuple[int, int]]) -> set[int]:
        count = Counter(x for x, _ in items)
        one = sorted(count)
        two = {x + y for i, x in enumerate(one) for y in one[i + 1:]} | {2 * x for x, c in count.items() if c > 1}
        return two.union(one)

    def changed(self, b: int, items: list[tuple[int, int]]) -> None:
        self.version[b] += 1
        for size in self.sizes(items):
            heapq.heappush(self.heaps[size], (self.fill[b], b, self.version[b]))
            self.first[size] = self.heaps[size][0][0]

    def emptiest(self, size: int, but: int) -> int | None:
        """The emptiest bin other than ``but`` that gives ``size``."""
        heap, own, found = self.heaps[size], None, None
        while heap:
            _, b, version = heap[0]
            if version == self.version[b] and b != but:
                found = b
                break
            entry = heapq.heappop(heap)
            if b == but and version == self.version[b]:
                own = entry
        if own is not None:
            heapq.heappush(heap, own)
        self.first[size] = heap[0][0] if heap else len(self.first)
        return found

    def best(self, b: int, items: list[tuple[int, int]]) -> tuple[int, int, int] | None:
        """(giver, size, length taken back) of the step that fills ``b`` most, from the emptiest giver."""
        mine, room = self.fill[b], len(self.first) - 1 - self.fill[b]
        gain, step = 0, None
        for back in sorted({0, *(x for x, _ in items)}):
            least = max(gain, 1)  # as much again may come from an emptier bin
            for at in np.flatnonzero(self.first[back + least: back + room + 1] <= mine)[::-1].tolist():
                size = back + least + at
                giver = self.emptiest(size, b)
                if giver is None or self.fill[giver] > mine:
                    continue
                if size - back > gain or step is None or self.fill[giver] < self.fill[step[0]]:
                    gain, step = size - back, (giver, size, back)
                break
        return step


def local_search(lengths: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Swap pieces between underfull bins until no step is left."""
    least = math.ceil(sum(lengths) / capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    done = [b for b, f in zip(bins, fill, strict=True) if f >= capacity]
    live = {n: [(lengths[i], i) for i in b] for n, b in enumerate(bins) if fill[n] < capacity}
    moved = True
    while moved and len(done) + len(live) > least:
        moved = False
        offers = _Offers(live, fill, capacity)
        # the fullest first: what little room they have is filled before the emptier ones change
        for high in sorted(live, key=lambda b: -fill[b]):
            while high in live and (step := offers.best(high, live[high])):
                low, size, back = step
                give = _give(live[low], size)
                take = [x for x in live[high] if x[0] == back][:1] if back else []
                for x in give:
                    live[low].remove(x)
                for x in take:
                    live[high].remove(x)
                live[high] += give
                live[low] += take
                fill[high] += size - back
                fill[low] -= size - back
                moved = True
                offers.changed(low, live[low])
                if not live[low]:
                    del live[low]
                if fill[high] == capacity:
                    offers.changed(high, [])
                    done.append([i for _, i in live.pop(high)])
                else:
                    offers.changed(high, live[high])
            if len(done) + len(live) <= least:
                break
    return done + [[i for _, i in live[b]] for b in sorted(live)]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers by sequence."""
    return local_search(lengths, best_fit(lengths, capacity), capacity)


def pack(rows: DataFrame, by: list[str], length: str = "length", capacity: int = CAPACITY,
         group_rows: int = 200_000) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence).

    ``by``: columns that spread the rows over groups. ``rows`` is read twice
    (count, then packing): pass a written table of narrow rows.
    """
    group = fresh(rows, "pack_group")
    # a share over groups of about group_rows rows each
    groups = max(1, math.ceil(rows.count() / group_rows))
    schema = T.StructType([f for f in rows.schema if f.name not in ("sequence_id", "offset")]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in schema][:-2]

    def one(key, table):
        lengths = table.column(length).to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for s, items in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = (key[0].as_py() << 40) + s, at
                at += lengths[i]
        return pa.table([*(table.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                        names=[*names, "sequence_id", "offset"])

    # the length is part of the draw only to spread repeated keys
    dealt = rows.select(*names).withColumn(group, F.pmod(F.xxhash64(*by, length), F.lit(groups)).cast("long"))
    return dealt.groupBy(group).applyInArrow(one, schema)


def token_pieces_with_places(packed: DataFrame, token_pieces: DataFrame, key: str) -> DataFrame:
    """The ids of every piece beside its place: the packed sequences themselves."""
    return token_pieces.join(packed.select(key, "piece", "sequence_id", "offset"), [key, "piece"])
