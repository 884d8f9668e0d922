"""Katz backoff language model: Good-Turing discounts, exactly normalised backoff.

P(w | h) is ``d * c(h, w) / c(h)`` for pairs seen in training, else
``alpha(h) * P(w)``; P(w) is ``d * c(w) / N`` for known words, else the mass that
the discounts left (one class of unknown words). ``d`` is Katz' discount from the
Good-Turing estimate for counts up to ``K``, and 1 above; where the counts of
counts are too thin for a valid value it is ``(r - 0.5) / r``. ``alpha(h)`` makes
the probabilities of all known words and the unknown class sum to 1; a context
whose counts leave no mass gives up ``1 / (c(h) + 1)``.

The count tables are hash-partitioned by word (unigrams) and by context (pairs).
Neither a vocabulary nor a pair table is ever in one place:

1. each task cuts its documents into slices of about ``SLICE`` bytes, packed;
2. each slice sends its distinct words with their training counts to the word
   partitions and gets the corpus totals of just those words back;
3. each slice sends its distinct pairs, grouped by context, to the context
   partitions and gets back the totals of those pairs and the sums that
   ``alpha`` needs per context. The shares of a context that is spread are added
   up in a round of their own, and each slice that has the context gets one row;
4. each slice scores its documents, token by token, from pair to word to unknown.

Slices pre-aggregate, so a frequent word or pair costs a partition one entry per
slice; a context of more than ``SPLIT`` training tokens is spread over several
partitions by its next word, and a slice asks only the shares that it has a pair
in: what it sends does not grow with the corpus. Entries travel as packed arrays. Words are 64-bit
hashes. Counts of counts of words are summed to one row of eight numbers, a scalar
of the plan, which travels with the answers; those of pairs go the way of the
spread contexts. A slice writes to a partition only what it has for it.

Edge cases: a NULL or empty text has one token, the end; NULL keys are hashed as
the text ``NULL`` would not be: they count as held in (remainder of crc32 of an
empty string); repeated rows count and score like any row; an empty table gives
an empty result; if nothing is training text every token is unknown.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.llm.common import slices, staged, texts_of
from tabrix.llm.setsketch import mix, word_hashes

K = 5
SLICE = 8 << 20
SPLIT = 2_000_000
#: Groups of slices that get a context's sums apart.
SALTS = 16
END, BEGIN = np.uint64(1), np.uint64(2)
_U = np.uint64
_STATS = 2 + K + 1  # tokens, types, types with counts 1 .. K + 1


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word hash of each token, its text), an end after each text's words."""
    word, count = word_hashes(texts)
    ends = np.cumsum(count + 1)
    out = np.empty(len(word) + len(texts), np.uint64)
    last = np.zeros(len(out), bool)
    last[ends - 1] = True
    out[last], out[~last] = END, word
    return out, np.repeat(np.arange(len(texts)), count + 1)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after another, the bytes of their values plane by plane: high bytes of sorted
    hashes and of counts repeat, and compress well."""
    press, out = zstandard.ZstdCompressor(level=1), [struct.pack("<q", len(arrays))]
    for a in arrays:
        planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T)
        z = press.compress(planes.tobytes())
        out.append(struct.pack("<cq", a.dtype.char.encode(), len(z)) + z)
    return b"".join(out)


def _unpack(raw: bytes) -> list[np.ndarray]:
    (n,) = struct.unpack_from("<q", raw)
    at, out, press = 8, [], zstandard.ZstdDecompressor()
    for _ in range(n):
        char, size = struct.unpack_from("<cq", raw, at)
        at += 9
        kind = np.dtype(char.decode())
        planes = np.frombuffer(press.decompress(raw[at: at + size]), np.uint8).reshape(kind.itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size
    return out


def _stats(counts: np.ndarray) -> np.ndarray:
    seen = counts[counts > 0]
    by_count = np.bincount(np.minimum(seen, K + 2).astype(np.int64), minlength=K + 3)
    return np.concatenate([[seen.sum(), len(seen)], by_count[1: K + 2]]).astype(np.float64)


def discounts(stats: np.ndarray) -> np.ndarray:
    """d by count 0 .. K (0: unused)."""
    n = stats[2:]
    out = np.ones(K + 1)
    top = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for r in range(1, K + 1):
        d = ((r + 1) * n[r] / n[r - 1] / r - top) / (1 - top) if n[r - 1] and top < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Unigram:
    """P(w) from counts, with the mass of the unknown class."""

    def __init__(self, stats: np.ndarray):
        self.total, self.types = stats[0], stats[1]
        self.d = discounts(stats)
        r = np.arange(1, K + 1)
        left = float(((1 - self.d[1:]) * r * stats[2: 2 + K]).sum()) / self.total if self.total else 1.0
        self.scale, self.unknown = 1.0, left
        if self.total and left < 1 / (self.total + 1):  # no mass left: the counts give some up
            self.scale, self.unknown = self.total / (self.total + 1) / (1 - left), 1 / (self.total + 1)

    def __call__(self, c: np.ndarray) -> np.ndarray:
        """Probability by count; 0 counts are the unknown class."""
        d = np.where(c <= K, self.d[np.minimum(c, K)], 1.0)
        return np.where(c > 0, self.scale * d * c / max(self.total, 1.0), self.unknown)


def _cut_slices(size: int):
    """(slice, block): the documents of a task, packed whole, ``size`` bytes or more to a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        part, held = [], 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for a, b in slices(lengths, size):
                part.append(batch.slice(a, b - a))
                held += sum(lengths[a:b])
                if held >= size:
                    yield _block((task << 32) + number, part)
                    part, held, number = [], 0, number + 1
        if any(x.num_rows for x in part):
            yield _block((task << 32) + number, part)

    return run


def _block(slice_: int, part: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_batches(part).combine_chunks()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return pa.RecordBatch.from_arrays([pa.array([slice_], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                      names=["slice", "block"])


def _documents(blocks: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in blocks.column("block")]).combine_chunks()


def _slice_words(table: pa.Table):
    word, text = tokens(texts_of(table.column("text")))
    held = np.asarray(table.column("held_out").to_pylist(), bool)
    types, code = np.unique(word, return_inverse=True)
    return word, text, held, types, code


def _home(h: np.ndarray, parts: int) -> np.ndarray:
    return ((mix(h ^ _U(0x9E3779B97F4A7C15)) >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)


def _loads(part: np.ndarray, slice_: int, payload: list[bytes]) -> pa.Table:
    return pa.table([pa.array(part, pa.int32()), pa.array(np.full(len(part), slice_, np.int64)),
                     pa.array(payload, pa.binary())], names=["part", "slice", "load"])


def _replies(table: pa.Table, payload: list[bytes], stats: np.ndarray, round_: int) -> pa.Table:
    """Answers to the slices, and a row (slice -1) with this partition's counts of counts."""
    n = len(payload)
    return pa.table([pa.concat_arrays([table.column("slice").combine_chunks(), pa.array([-1], pa.int64())]),
                     pa.concat_arrays([table.column("part").combine_chunks(), pa.array([-1], pa.int32())]),
                     pa.array([round_] * (n + 1), pa.int32()), pa.array([*payload, None], pa.binary()),
                     pa.array([None] * n + [stats.tolist()], pa.list_(pa.float64()))],
                    names=["slice", "part", "round", "load", "stats"])


def _with_totals(answers: DataFrame) -> DataFrame:
    """Every answer with the corpus' counts of counts, summed over the partitions: one value."""
    own = answers.where("slice = -1").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(_STATS)])
    total = own.select(F.array(*[F.col(f"s{i}") for i in range(_STATS)])).scalar()
    return answers.where("slice >= 0").withColumn("stats", total)


def _ask_words(parts: int):
    def run(key, blocks):
        _, text, held, types, code = _slice_words(_documents(blocks))
        count = np.bincount(code[~held[text]], minlength=len(types)).astype(np.uint32)
        home = _home(types, parts)
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(parts + 1))
        filled = np.flatnonzero(np.diff(cuts))
        payload = [_pack(types[o], count[o]) for o in (order[cuts[p]: cuts[p + 1]] for p in filled)]
        return _loads(filled, key[0].as_py(), payload)

    return run


def _sum_words(key, table):
    loads = [_unpack(x) for x in table.column("load").to_pylist()]
    types, code = np.unique(np.concatenate([x[0] for x in loads]), return_inverse=True)
    total = np.bincount(code, weights=np.concatenate([x[1] for x in loads]).astype(np.float64), minlength=len(types))
    stats, at, out = _stats(total), 0, []
    for words, _ in loads:
        out.append(_pack(total[code[at: at + len(words)]].astype(np.int64)))
        at += len(words)
    return _replies(table, out, stats, 1)


def _totals(table: pa.Table, which: int) -> np.ndarray:
    rows = table.column("round").to_pylist()
    return np.array(table.column("stats")[rows.index(which)].as_py())


def _answers(table: pa.Table, which: int) -> list[list[np.ndarray]]:
    rows = [(p, x) for p, r, x in zip(*(table.column(c).to_pylist() for c in ("part", "round", "load")), strict=True) if r == which]
    return [_unpack(x) for _, x in sorted(rows)]


def _known_words(answers: pa.Table, types: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Training count of each of the slice's words; the corpus statistics."""
    got = _answers(answers, 1)
    count = np.zeros(len(types), np.int64)
    count[np.argsort(_home(types, parts), kind="stable")] = np.concatenate([x[0] for x in got])
    return count, _totals(answers, 1)


class _Pairs:
    """The distinct pairs of a slice in the order in which they are sent.

    An entry belongs to (context, share); a context of many tokens has several
    shares, by next word, of which a slice asks those that it has a pair in.
    """

    def __init__(self, code: np.ndarray, text: np.ndarray, types: np.ndarray, count: np.ndarray, parts: int, split: int):
        first = np.ones(len(code), bool)
        first[1:] = text[1:] != text[:-1]
        begin = len(types)  # the context before the first token
        context = np.where(first, begin, np.append(begin, code[:-1]))
        self.pair, self.of = np.unique(context * (len(types) + 1) + code, return_inverse=True)
        self.context, self.next = np.divmod(self.pair, len(types) + 1)
        name = np.append(types, BEGIN)
        # the begin of a text is as frequent as its end
        ends = count[np.searchsorted(types, END)] if len(types) else 0
        shares = 1 + np.append(count, ends) // split
        # a share of each pair, and the entries that are left: a context and a share with a pair in it
        share = (mix(types[self.next]) % shares[self.context].astype(np.uint64)).astype(np.int64)
        most = int(shares.max(initial=1))
        entries, self.entry = np.unique(self.context * most + share, return_inverse=True)
        self.used, share = np.divmod(entries, most)
        self.split = shares[self.used] > 1
        self.whole = name[self.used]  # the context's own name
        self.home = _home(self.whole + share.astype(np.uint64) * _U(0xD1342543DE82EF95), parts)
        self.name = self.whole + share.astype(np.uint64) * _U(0x2545F4914F6CDD1D)  # in order of the hashes
        # send by home, then entry, then pair
        self.entry_order = np.argsort(self.home, kind="stable")
        rank = np.empty(len(self.used), np.int64)
        rank[self.entry_order] = np.arange(len(self.used))
        self.pair_order = np.argsort(rank[self.entry], kind="stable")
        self.entry_cuts = np.searchsorted(self.home[self.entry_order], np.arange(parts + 1))
        self.pair_cuts = np.searchsorted(rank[self.entry][self.pair_order], self.entry_cuts)
        self.size = np.bincount(self.entry, minlength=len(self.used))


def _ask_pairs(parts: int, split: int):
    def run(key, blocks, answers):
        _, text, held, types, code = _slice_words(_documents(blocks))
        count, stats = _known_words(answers, types, parts)
        pairs = _Pairs(code, text, types, count, parts, split)
        train = np.bincount(pairs.of[~held[text]], minlength=len(pairs.pair)).astype(np.uint32)
        filled, out = np.flatnonzero(np.diff(pairs.entry_cuts)), []
        for p in filled:
            e = pairs.entry_order[pairs.entry_cuts[p]: pairs.entry_cuts[p + 1]]
            w = pairs.pair_order[pairs.pair_cuts[p]: pairs.pair_cuts[p + 1]]
            # each distinct next word once, with its training count
            words, index = np.unique(pairs.next[w], return_inverse=True)
            out.append(_pack(pairs.name[e], pairs.size[e].astype(np.uint32), types[words], count[words],
                             index.astype(np.uint16 if len(words) < 1 << 16 else np.uint32), train[w], stats,
                             np.flatnonzero(pairs.split[e]).astype(np.uint32), pairs.whole[e][pairs.split[e]]))
        return _loads(filled, key[0].as_py(), out)

    return run


class _Sums:
    """What a partition adds up from the loads of all slices, per (context, share) and per pair."""

    def __init__(self, table: pa.Table):
        self.loads = loads = [_unpack(x) for x in table.column("load").to_pylist()]
        unigram = Unigram(loads[0][6])
        names, self.name = np.unique(np.concatenate([x[0] for x in loads]), return_inverse=True)
        owner = np.repeat(self.name, np.concatenate([x[1] for x in loads]))
        word = np.concatenate([x[2][x[4]] for x in loads])
        # distinct (context, word): sort by context, then word
        order = np.lexsort((word, owner))
        o, w = owner[order], word[order]
        new = np.ones(len(o), bool)
        new[1:] = (o[1:] != o[:-1]) | (w[1:] != w[:-1])
        self.code = code = np.empty(len(o), np.int64)
        code[order] = np.cumsum(new) - 1
        self.total = total = np.bincount(code, weights=np.concatenate([x[5] for x in loads]).astype(np.float64)).astype(np.int64)
        context = o[new]
        known = np.zeros(len(total), np.int64)
        known[code] = np.concatenate([x[3][x[4]] for x in loads])
        seen = total > 0
        n = len(names)
        self.after = np.bincount(context, weights=total, minlength=n).astype(np.uint32)
        # the mass of P(w) after a context: of one word its training count says it, and is a small number
        self.several = np.bincount(context[seen], minlength=n) > 1
        self.mass = np.bincount(context[seen], weights=unigram(known[seen]), minlength=n)
        single = np.bincount(context[seen], weights=known[seen], minlength=n)
        self.single = np.where(self.several, 0, single).astype(np.uint32)
        self.low = [np.bincount(context[total == r], minlength=n).astype(np.uint32) for r in range(1, K + 1)]

    def sums(self) -> np.ndarray:
        """Tokens, mass of P(w) and pairs by count, per name: what shares of a context add up."""
        return np.stack([self.after, self.mass, *self.low], axis=1).astype(np.float64)


def _tell_pairs(key, table):
    """Partial sums by context, and which slices ask for them, in ``SALTS`` groups a context.

    Context 0 stands for the counts of counts, which every slice asks for; the others
    are the split contexts, whose shares are added up.
    """
    sums = _Sums(table)
    at, asked, own = 0, [], {}
    each = sums.sums()
    for slice_, x in zip(table.column("slice").to_pylist(), sums.loads, strict=True):
        names = x[8].view(np.int64).tolist()
        asked += [(c, slice_ % SALTS, slice_, None) for c in (0, *names)]
        own.update(zip(sums.name[at:][x[7]].tolist(), names, strict=True))  # a context may have several shares here
        at += len(x[0])
    parts = [(0, _stats(sums.total).tolist()), *((c, each[i].tolist()) for i, c in own.items())]
    rows = [*asked, *((c, salt, None, v) for c, v in parts for salt in range(SALTS))]
    kinds = {"context": pa.int64(), "salt": pa.int32(), "slice": pa.int64(), "sums": pa.list_(pa.float64())}
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def _add_up(key, table):
    """A context's sums for each slice that asks."""
    slices_ = sorted({x for x in table.column("slice").to_pylist() if x is not None})
    total = np.sum([x for x in table.column("sums").to_pylist() if x is not None], axis=0).tolist()
    n = len(slices_)
    return pa.table([pa.array(slices_, pa.int64()), pa.array([-1] * n, pa.int32()), pa.array([3] * n, pa.int32()),
                     pa.array([key[0].as_py().to_bytes(8, "big", signed=True)] * n, pa.binary()), pa.array([total] * n, pa.list_(pa.float64()))],
                    names=["slice", "part", "round", "load", "stats"])


def _sum_pairs(key, table):
    sums = _Sums(table)
    at, entry, out = 0, 0, []
    for x in sums.loads:
        mine = sums.name[entry: entry + len(x[0])]
        several = sums.several[mine]
        out.append(_pack(sums.total[sums.code[at: at + len(x[4])]].astype(np.uint32), sums.after[mine], several.view(np.uint8),
                         sums.mass[mine[several]], sums.single[mine], *(m[mine] for m in sums.low)))
        at += len(x[4])
        entry += len(x[0])
    n = len(out)
    return pa.table([table.column("slice"), table.column("part"), pa.array([2] * n, pa.int32()), pa.array(out, pa.binary())],
                    names=["slice", "part", "round", "load"])


def _whole_sums(answers: pa.Table) -> dict[int, list[float]]:
    """Corpus sums that a slice asked for, by context; 0: the counts of counts."""
    rows = zip(*(answers.column(c).to_pylist() for c in ("round", "load", "stats")), strict=True)
    return {int.from_bytes(load, "big"): sums for r, load, sums in rows if r == 3}


def _score(parts: int, split: int):
    def run(key, blocks, answers):
        docs = _documents(blocks)
        _, text, held, types, code = _slice_words(docs)
        count, stats = _known_words(answers, types, parts)
        pairs = _Pairs(code, text, types, count, parts, split)
        got = _answers(answers, 2)
        total = np.zeros(len(pairs.pair), np.int64)
        total[pairs.pair_order] = np.concatenate([x[0] for x in got])
        unigram = Unigram(stats)
        after, several, mass, single, *low = (np.concatenate([x[i] for x in got]) for i in range(1, 5 + K))
        own = np.where(single > 0, unigram(single.astype(np.int64)), 0.0)
        own[several.astype(bool)] = mass
        sums = np.zeros((K + 2, len(pairs.used)))
        sums[:, pairs.entry_order] = np.stack([after, own, *low])
        # the shares of a split context are summed over the corpus
        contexts, at = np.unique(pairs.used, return_index=True)
        sums = sums[:, at]
        whole = _whole_sums(answers)
        for i in np.flatnonzero(pairs.split[at]):
            sums[:, i] = whole[int(pairs.whole[at[i]])]
        after, mass, low = sums[0], sums[1], sums[2:]
        d = discounts(np.array(whole[0]))
        left = ((1 - d[1:, None]) * np.arange(1, K + 1)[:, None] * low).sum(axis=0) / np.maximum(after, 1)
        scale = np.where(left > 0, 1.0, after / (after + 1))
        left = np.where(left > 0, left, 1 / (after + 1))
        alpha = np.where(after > 0, left / np.maximum(1 - mass, 1e-300), 1.0)
        c = np.searchsorted(contexts, pairs.context)
        lower = unigram(count)
        seen = scale[c] * np.where(total <= K, d[np.minimum(total, K)], 1.0) * total / np.maximum(after[c], 1)
        p = np.where(total > 0, seen, alpha[c] * lower[pairs.next])
        n = docs.num_rows
        base = np.log10((count + 1) / (stats[0] + stats[1] + 1))
        per = lambda x: np.bincount(text, weights=x, minlength=n)
        return pa.table([docs.column("key"), pa.array(held), pa.array(np.bincount(text, minlength=n)),
                         pa.array(per((count > 0)[code]).astype(np.int64)), pa.array(np.full(n, int(stats[0]))),
                         pa.array(per(base[code])), pa.array(per(np.log10(p)[pairs.of]))], names=_COLUMNS)

    return run


_COLUMNS = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def katz_scores(docs: DataFrame, key: str, text: str, held_out, slice_bytes: int = SLICE,
                split: int = SPLIT, stored: bool = True) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``held_out``: a boolean column; the other rows are the training text. ``stored``:
    ``docs`` is read from files, so that a task that runs again cuts the same slices;
    anything else is written first.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    # a partition holds what about two slices send
    parts = max(1, -(-size // (2 * slice_bytes)))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    rows = rows if stored else staged(rows, "katz-documents")
    cut = rows.mapInArrow(_cut_slices(slice_bytes), "slice bigint, block binary")
    load, answer = "part int, slice bigint, load binary", "slice bigint, part int, round int, load binary, stats array<double>"
    words = _with_totals(cut.groupBy("slice").applyInArrow(_ask_words(parts), load).groupBy("part").applyInArrow(_sum_words, answer))
    asked = cut.groupBy("slice").cogroup(words.groupBy("slice")).applyInArrow(_ask_pairs(parts, split), load)
    # counts of counts, and what only all shares of a context together know
    told = asked.groupBy("part").applyInArrow(_tell_pairs, "context bigint, salt int, slice bigint, sums array<double>")
    whole = told.groupBy("context", "salt").applyInArrow(_add_up, answer)
    pairs = asked.groupBy("part").applyInArrow(_sum_pairs, "slice bigint, part int, round int, load binary").withColumn("stats", F.lit(None).cast("array<double>"))
    both = words.unionByName(pairs).unionByName(whole)
    out = cut.groupBy("slice").cogroup(both.groupBy("slice")).applyInArrow(
        _score(parts, split), f"key {docs.schema[key].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
                              "train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("key", key)
