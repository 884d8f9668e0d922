"""Near-duplicate documents by SetSketch registers.

``sketch`` gives every shingle set ``M`` registers. A shingle throws a Poisson
process of points, each at a random register; a register keeps the earliest
point of all shingles, so registers are independent exponential minima, and are
mergeable (the minimum of two sketches is the sketch of the union). A minimum
``h`` is stored as the truncated integer ``floor(1 - log_B h)``: exponentially
spaced values. Equal registers are as likely as sets are alike, so

1. equal sets become one class (label: smallest key), by a 128-bit fingerprint;
2. ``BANDS`` bands of ``ROWS`` registers are hashed; of classes that share a band,
   pairs are estimated jointly from how many registers are larger, smaller and
   equal (maximum likelihood), and pairs well below the threshold are dropped;
3. the components of the pairs that are left are the candidate clusters, whose
   sets are verified in full;
4. verified links give the components.

Sharing a band alone joins nothing: documents with the same boilerplate meet in a
band, but only those whose sketches say that they may be near copies are clustered.
Bands take sketches; each set goes to one cluster only. Of a large band and of a
cluster only links that join parts leave a task; pairs inside a joined part are not
looked at. Bands and clusters above a bound are cut into blocks, and a
task compares two blocks, so a group of any size is compared whole, with bounded
memory. The chance that two sets share no band is ``(1 - 0.85**5)**25`` =
4e-7 at the similarity 0.85, and 5e-5 at 0.80.

Edge cases: NULL and empty texts, and texts without words, have an empty set and
are linked with nothing; a text of fewer than five words is one shingle; equal
texts are linked; rows that repeat a key count as one document, with all their
texts; a NULL key joins the component of equal texts, and stands alone
otherwise; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.llm.common import lean, slices, staged, texts_of
from tabrix.llm.graph import components
from tabrix.operators.keyed import join_unique

SHINGLE = 5
PERCENT = 85
ROWS, BANDS = 5, 25
M = ROWS * BANDS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
#: A pair is verified unless its estimate is this far below the threshold (six standard errors).
MARGIN = 0.2
#: Sets of a cluster, and sketches of a band, that are compared in one task.
BLOCK, BAND_BLOCK = 1500, 20_000
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Bytes of a word that are hashed eight at a time for all words together; longer words go one by one.
LONG = 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, words of each text); words are lower-cased (A-Z).

    Eight bytes at a time go through a mixer that maps 64 bits one to one, so words
    of up to eight bytes and equal length never share a hash; words beyond ``LONG``
    bytes are hashed by XXH3.
    """
    raw = b" ".join(texts) + b" " * (LONG + 8)
    buf = _LOWER[np.frombuffer(raw, np.uint8)]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    inside = ~_SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    start, size = edge[::2], edge[1::2] - edge[::2]
    # the eight bytes from any place on
    eight = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
    word = mix(size.astype(np.uint64) + _U(0x9E3779B97F4A7C15))
    on = np.arange(len(start))
    for k in range(0, LONG, 8):
        on = on[size[on] > k]
        part = eight[start[on] + k] & _MASK[np.minimum(size[on] - k, 8)]
        word[on] = mix(word[on] ^ mix(part + _U(0xD1342543DE82EF95)))
    for i in np.flatnonzero(size > LONG).tolist():
        word[i] = xxhash.xxh3_64_intdigest(buf[start[i]: start[i] + size[i]].data)
    return word, np.diff(np.searchsorted(start, begins))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash) of the distinct shingles, by text and hash."""
    word, count = word_hashes(texts)
    upto = np.concatenate([[0], np.cumsum(count)])
    number = np.repeat(np.arange(len(texts)), count)
    # windows of five words; a shorter text is one shingle of the words it has
    h = np.zeros(len(word), np.uint64)
    left = np.repeat(upto[1:], count) - np.arange(len(word))  # words from here to the text's end
    for k in range(SHINGLE):
        on = np.flatnonzero(left > k)
        h[on] = mix(h[on] * _U(0x9E3779B97F4A7C15) + word[on + k])
    first = np.zeros(len(word), bool)
    first[upto[:-1][count > 0]] = True
    ok = (left >= SHINGLE) | first
    number, h = number[ok], h[ok]
    order = np.lexsort((h, number))
    number, h = number[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (number[1:] != number[:-1]) | (h[1:] != h[:-1])
    return number[new], h[new]


def sketch(number: np.ndarray, shingle: np.ndarray, texts: int, m: int = M) -> np.ndarray:
    """Registers (texts x m, uint16) of the sets of shingles."""
    least = np.full(texts * m, np.inf)
    time = np.zeros(len(shingle))
    j = 0
    while len(shingle):
        r = mix(shingle + _U((2 * j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        time -= np.log(((r >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
        at = ((mix(r) >> _U(32)) * _U(m)) >> _U(32)
        np.minimum.at(least, number * m + at.astype(np.int64), time)
        # a shingle is done when its next point comes after every register's
        latest = least.reshape(texts, m).max(axis=1)
        live = time < latest[number]
        number, shingle, time = number[live], shingle[live], time[live]
        j += 1
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(value, 0, TOP).astype(np.uint16).reshape(texts, m)


def estimate(larger: np.ndarray, smaller: np.ndarray, a: np.ndarray, b: np.ndarray, m: int = M) -> np.ndarray:
    """Jaccard similarity by maximum likelihood, jointly from both registers.

    ``larger``/``smaller``: registers where the first set's value is larger or
    smaller; ``a``, ``b``: the sets' sizes.
    """
    u, v = a / (a + b), b / (a + b)
    equal = m - larger - smaller

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(20):  # the likelihood has one peak
        x, y = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        left = likelihood(x) > likelihood(y)
        lo, hi = np.where(left, lo, x), np.where(left, y, hi)
    return (lo + hi) / 2


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for a, b in slices([len(t) for t in texts], 4 << 20):
            number, h = shingles(texts[a:b])
            size = np.bincount(number, minlength=b - a)
            registers = sketch(number, h, b - a)
            marks = [np.zeros(b - a, np.uint64) for _ in range(2)]
            for mark, odd in zip(marks, (0xA24BAED4963EE407, 0x9FB21C651E98DF25), strict=True):
                np.add.at(mark, number, mix(h * _U(odd)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(size), *(pa.array(x.view(np.int64)) for x in marks),
                 pa.array([x.tobytes() for x in registers], pa.binary())], names=["key", "n", "f1", "f2", "sketch"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        s = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
        h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), s.shape[:2])
        for k in range(ROWS):
            h = mix(h * _U(0x9E3779B97F4A7C15) + s[:, :, k])
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.ravel().view(np.int64)), batch.column(0).take(pa.array(np.repeat(np.arange(len(s)), BANDS)))],
            names=["band", "label"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(2))
        for a, b in slices([len(t) for t in texts], 4 << 20):
            number, h = shingles(texts[a:b])
            parts = np.split(h, np.cumsum(np.bincount(number, minlength=b - a))[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), batch.column(3).slice(a, b - a),
                 pa.array([x.tobytes() for x in parts], pa.binary())], names=["label", "root", "sketch", "shingles"])


class _Parts:
    """Which members are joined already."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> np.ndarray:
        """Join ``i`` with ``others``; one of each part that was new to it."""
        _, first = np.unique(self.of[others], return_index=True)
        linked = others[first]
        self.of[np.isin(self.of, self.of[linked])] = self.of[i]
        return linked


def link_block(sketches: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None,
               percent: int = PERCENT) -> list[tuple[int, int]]:
    """Verified links that join the members' parts.

    ``side``: compare only members of different sides (None: all).
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    begin = np.cumsum(size) - size
    # the members closest to the most frequent register values come first: they join the most
    centre = np.array([np.bincount(col).argmax() for col in sketches.T])
    parts, links = _Parts(n), []
    done = np.zeros(n, bool)
    for i in np.argsort(-(sketches == centre).sum(axis=1), kind="stable"):
        done[i] = True
        small, large = np.minimum(size, size[i]), np.maximum(size, size[i])
        ask = ~done & (parts.of != parts.of[i]) & (100 * small >= percent * large)
        if side is not None:
            ask &= side != side[i]
        j = np.flatnonzero(ask)
        if not len(j):
            continue
        larger, smaller = (sketches[i] > sketches[j]).sum(axis=1), (sketches[i] < sketches[j]).sum(axis=1)
        guess = estimate(larger, smaller, np.full(len(j), float(size[i])), size[j].astype(float), sketches.shape[1])
        j = j[guess >= percent / 100 - MARGIN]
        if not len(j):
            continue
        own = sets[i]
        place = np.repeat(begin[j] - (np.cumsum(size[j]) - size[j]), size[j]) + np.arange(size[j].sum())
        other = flat[place]
        at = np.minimum(np.searchsorted(own, other), len(own) - 1)
        common = np.add.reduceat((own[at] == other).astype(np.int64), np.cumsum(size[j]) - size[j])
        good = j[100 * common >= percent * (size[i] + size[j] - common)]
        if len(good):
            links += [(int(i), int(k)) for k in parts.join(i, good)]
    return links


#: Members of a band up to which its pairs are estimated together with those of other bands.
FEW = 32
#: Members of bands in a task, pairs estimated at a time.
MEMBERS, PAIRS = 20_000, 100_000


def _alike(sketches: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sets ``i`` and ``j`` may be as alike as ``percent``, by their sketches."""
    larger, smaller = (sketches[i] > sketches[j]).sum(axis=1), (sketches[i] < sketches[j]).sum(axis=1)
    guess = estimate(larger, smaller, size[i].astype(float), size[j].astype(float), sketches.shape[1])
    return guess >= percent / 100 - MARGIN


def guess_small(start: np.ndarray, count: np.ndarray, sketches: np.ndarray, size: np.ndarray, side: np.ndarray, percent: int):
    """Pairs (i, j) of members of one group that may be alike; group ``g`` has ``count[g]`` members from ``start[g]``.

    ``side``: members of equal sides are not compared (-1: no side).
    """
    member = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    after = np.repeat(start + count, count) - member - 1
    for a in range(0, len(member), PAIRS // FEW):
        m, n = member[a: a + PAIRS // FEW], after[a: a + PAIRS // FEW]
        i = np.repeat(m, n)
        j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ok = (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])) & ((side[i] < 0) | (side[i] != side[j]))
        i, j = i[ok], j[ok]
        ok = _alike(sketches, size, i, j, percent)
        yield i[ok], j[ok]


def guess_large(sketches: np.ndarray, size: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs that may be alike and join the parts of one group."""
    parts, out, done = _Parts(len(size)), [], np.zeros(len(size), bool)
    centre = np.array([np.bincount(col).argmax() for col in sketches.T])
    for i in np.argsort(-(sketches == centre).sum(axis=1), kind="stable"):
        done[i] = True
        ask = ~done & (parts.of != parts.of[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
        j = np.flatnonzero(ask & ((side[i] < 0) | (side != side[i])))
        j = j[_alike(sketches, size, np.full(len(j), i), j, percent)] if len(j) else j
        if len(j):
            out += [(int(i), int(k)) for k in parts.join(i, j)]
    return out


def _guess(percent: int):
    """Pairs of band members that may be near copies; ``spot`` is a band, or two blocks of one."""

    def run(key, table):
        table = table.sort_by("spot")
        spot, label, size, side = (table.column(c).to_numpy() for c in ("spot", "label", "n", "side"))
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(len(label), -1)
        start = np.flatnonzero(np.concatenate([[True], spot[1:] != spot[:-1]]))
        count = np.diff(np.append(start, len(spot)))
        few = (count > 1) & (count <= FEW)
        pairs = list(guess_small(start[few], count[few], sketches, size, side, percent))
        for a, n in zip(start[count > FEW].tolist(), count[count > FEW].tolist(), strict=True):
            own = guess_large(sketches[a: a + n], size[a: a + n], side[a: a + n], percent)
            pairs.append((a + np.array([i for i, _ in own], np.int64), a + np.array([j for _, j in own], np.int64)))
        i, j = (np.concatenate([p[k] for p in pairs] or [np.zeros(0, np.int64)]).astype(np.int64) for k in (0, 1))
        return pa.table([pa.array(label[i]), pa.array(label[j])], names=["a", "b"])

    return run


def _block_pairs(df: DataFrame, members: str, block: int) -> DataFrame:
    """``df`` with its row's ``block`` of a group of so many members, and a row per pair of blocks that compares it."""
    df = df.withColumn("blocks", F.ceil(F.col(members) / F.lit(block)).cast("int"))
    df = df.withColumn("block", F.pmod(F.xxhash64("label"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda x: F.struct(F.least(x, F.col("block")).alias("x"), F.greatest(x, F.col("block")).alias("y")))
    return df.withColumn("p", F.explode(pairs))


def _link(percent: int):
    def run(key, table):
        two = key[1].as_py() != key[2].as_py()
        label = table.column("label").to_numpy()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(len(label), -1)
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        links = link_block(sketches, sets, table.column("block").to_numpy() if two else None, percent)
        return pa.table([pa.array([int(label[i]) for i, _ in links], pa.int64()),
                         pa.array([int(label[j]) for _, j in links], pa.int64())], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, key: str, text: str = "text", block: int = BLOCK, percent: int = PERCENT,
                    band_block: int = BAND_BLOCK) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of ``docs``; ``key`` is an integer.

    Documents are linked at a Jaccard similarity of ``percent`` / 100 or more.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    told = staged(rows.mapInArrow(lean(_describe), "key bigint, n bigint, f1 bigint, f2 bigint, sketch binary"), "near-sketches")
    # sketches of equal sets are equal: any of them will do
    classes = told.where("n > 0").groupBy("f1", "f2").agg(F.min("key").alias("label"), F.min_by("sketch", "key").alias("sketch"),
                                                          F.max("n").alias("n"))
    classes = staged(classes.where("label is not null"), "near-classes")

    bands = staged(classes.select("label", "sketch").mapInArrow(
        _bands, "band bigint, label bigint"), "near-bands")
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = join_unique(bands, shared, ["band"]).join(classes.select("label", "n", "sketch"), "label")
    met = _block_pairs(met, "members", band_block)
    side = F.when(F.col("p.x") == F.col("p.y"), -1).otherwise(F.col("block"))
    met = met.select(F.xxhash64("band", "p.x", "p.y").alias("spot"), "label", "n", side.alias("side"), "sketch")
    total = shared.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    shard = F.pmod(F.xxhash64("spot"), F.lit(max(1, total // MEMBERS)))
    guessed = staged(met.groupBy(shard.alias("shard")).applyInArrow(_guess(percent), "a bigint, b bigint"), "near-guesses")
    clusters = staged(components(guessed, "a", "b"), "near-clusters")

    # the sets of clustered classes, each sent to its cluster's blocks
    size = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    place = clusters.join(size, "root").join(classes, F.col("node") == F.col("label")).select(
        "label", "root", "members", "sketch")
    # written, so that its size is known: where it is small Spark sends it to the texts, and does not shuffle those
    place = staged(place, "near-places")
    full = rows.join(place, F.col("key") == F.col("label")).select(
        "label", F.struct("root", "members").alias("root"), "text", "sketch").mapInArrow(
        lean(_sets), "label bigint, root struct<root:bigint,members:bigint>, sketch binary, shingles binary")
    full = _block_pairs(full.select(F.col("root.root").alias("root"), F.col("root.members").alias("members"), "label", "sketch", "shingles"),
                        "members", block)
    links = full.select("root", "p.x", "p.y", "label", "block", "sketch", "shingles").groupBy("root", "x", "y").applyInArrow(
        _link(percent), "a bigint, b bigint")
    joined = staged(components(staged(links, "near-links"), "a", "b"), "near-components")

    named = classes.join(joined, F.col("label") == F.col("node"), "left").select(
        "f1", "f2", F.coalesce("root", "label").alias("component"))
    out = told.drop("sketch").join(named, ["f1", "f2"], "left")
    component = F.when(F.col("n") == 0, F.col("key")).otherwise(F.coalesce("component", "key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("key").eqNullSafe(component).alias("kept"))
