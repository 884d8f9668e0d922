"""Phrase collocations, counted in HAT-tries whose subtrees are spilled as sorted runs.

Texts are cut into pieces at punctuation and line ends, pieces into words. The
phrases that start at a word are the prefixes of its *window*, the next few words
of the piece. Counting windows therefore counts all phrases:

1. ``count_words`` counts (language, word). Words seen less than ``least`` times
   cannot be part of a frequent phrase: they end windows. Up to ``DICTIONARY``
   frequent words get ids by falling count and are broadcast (a fixed bound); any
   further ones get an id from SHA-256 (words that share one get listed ids).
2. Each task counts its windows in a ``HatTrie``: a shallow trie over word ids with
   hash containers at its leaves; a container that grows beyond ``BURST`` entries
   bursts into a node with one container per next word. At ``BUDGET`` entries the
   largest subtrees are spilled whole, as sorted runs, one per prefix partition.
3. A prefix partition merges its runs: equal windows are added, and the sums over
   each prefix length are the phrase counts. There is one partition for about
   ``PART`` windows, so a merge is bounded whatever the input.
4. Candidates, the parts they are cut into, language totals and words meet in joins
   of narrow tables. Counts are exact; products are taken as 38-digit decimals.

Hot prefixes: a word with more than one partition's share of all windows is *hot*.
Windows that begin with hot words go by their prefix up to the first other word, so
no prefix fills a partition. Phrases of hot words alone are then spread over
partitions and added at the end. Equal windows are one entry of a task's trie, so a
passage repeated a billion times is not a hot key either. Joins on phrases, words
and languages go through ``operators.keyed.join_unique``.

Edge cases: NULL text is empty, NULL language is ``und``; a text of any length is
read in slices; repeated rows count as often as they occur; ties in score and count
are ordered by the phrase's bytes; an empty table, or one without a frequent
phrase, gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.llm.common import staged, texts_of
from tabrix.operators.keyed import join_unique
from tabrix.session import shuffle_partitions

#: Most words that are broadcast, and the longest such word (with its language) in bytes.
DICTIONARY, LISTED = 1 << 18, 128
#: Entries at which a container bursts, and at which a trie spills.
BURST, BUDGET = 16_384, 600_000
#: Windows per prefix partition, word occurrences counted at a time, bytes of text split at a time.
PART, BLOCK, SLICE = 2_000_000, 400_000, 1 << 22
#: Ids from SHA-256 lie above this.
HASHED = 1 << 60

_END = b"\xff"  # no byte of UTF-8: marks the end of a piece
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _END * 10)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text with ``_END`` between pieces, slice by slice."""
    text = text.translate(_FOLD).replace(_END, b" " + _END + b" ")
    a = 0
    while a < len(text):
        b = len(text)
        if b - a > SLICE:
            b = text.rfind(b" ", a, a + SLICE)
            if b <= a:
                b = text.find(b" ", a + SLICE)
                b = len(text) if b < 0 else b
        yield text[a:b].split()
        a = max(b, a + 1)


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, f): occurrences of each word in ``docs`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, words in seen.items():
                words.pop(_END, None)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(words), pa.string()), "word": pa.array(list(words), pa.binary()).cast(pa.string()),
                    "f": pa.array(list(words.values()), pa.int64())})
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                counter = seen.setdefault(lang, Counter())
                for words in words_of(text):
                    held -= len(counter)
                    counter.update(words)
                    held += len(counter)
                    if held > BUDGET:
                        yield from out()
                        counter, held = seen.setdefault(lang, Counter()), 0
        yield from out()

    return docs.mapInArrow(count, "lang string, word string, f bigint").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _sha_id(lang: Column, word: Column) -> Column:
    """60 bits of SHA-256, above ``HASHED``; the same as ``_sha_of``."""
    digits = F.substring(F.sha2(F.concat(lang, F.lit("\t"), word).cast("binary"), 256), 1, 15)
    return F.conv(digits, 16, 10).cast("long") + F.lit(HASHED)


def _sha_of(lang: str, word: bytes) -> int:
    return int(hashlib.sha256(lang.encode() + b"\t" + word).hexdigest()[:15], 16) + HASHED


def number_words(words: DataFrame, least: int, most: int = DICTIONARY) -> tuple[DataFrame, dict[str, dict[bytes, int]], bool]:
    """(frequent words with ids, the listed ones as {lang: {word: id}}, whether all frequent words are listed)."""
    spark = words.sparkSession
    frequent = words.where(F.col("f") >= least)
    fits = (F.octet_length("lang") + F.octet_length("word")) <= LISTED
    top = frequent.where(fits).orderBy(F.desc("f"), "lang", "word").limit(most).collect()  # a fixed bound
    listed = [(r["lang"], r["word"], r["f"], i + 1) for i, r in enumerate(top)]

    def frame(rows: list[tuple]) -> DataFrame:
        kinds = {"lang": pa.string(), "word": pa.string(), "f": pa.int64(), "id": pa.int64()}
        return spark.createDataFrame(pa.table({c: pa.array([r[j] for r in rows], t) for j, (c, t) in enumerate(kinds.items())}))

    table = frame(listed)
    complete = frequent.count() == len(listed)
    if not complete:
        # every word that the tasks will hash, frequent or not
        rest = staged(words.join(table.select("lang", "word"), ["lang", "word"], "left_anti")
                      .withColumn("id", _sha_id(F.col("lang"), F.col("word"))), "hashed-words")
        shared = rest.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id")
        # about words ** 2 / 2 ** 61 of them: none in practice, a handful in the largest corpora
        extra = [(r["lang"], r["word"], r["f"], len(listed) + i + 1)
                 for i, r in enumerate(rest.join(shared, "id", "left_semi").orderBy("lang", "word").collect())]
        listed += extra
        table = frame(listed).where(F.col("f") >= least)
        table = table.unionByName(rest.where(F.col("f") >= least).join(shared, "id", "left_anti"))
    known: dict[str, dict[bytes, int]] = {}
    for lang, word, _, i in listed:
        known.setdefault(lang, {})[word.encode()] = i
    return staged(table, "numbered-words"), known, complete


class _Ids(dict):
    """Task-local ids of one language's words: listed ids, then numbers handed out as words appear."""

    def __init__(self, known: dict[bytes, int], lang: str, local: list[int] | None):
        super().__init__(known)
        self[_END] = 0
        self.lang, self.local = lang, local

    def __missing__(self, word: bytes) -> int:
        if self.local is None:
            return 0  # all frequent words are listed
        self.local.append(_sha_of(self.lang, word))
        self[word] = len(self.local) - 1
        return self[word]


def windows_of(ids: np.ndarray, width: int) -> np.ndarray:
    """The windows that start before the last ``width - 1`` ids and hold two words or more; zeros from a border (0) on."""
    n = max(len(ids) - width + 1, 0)
    w = np.zeros((n, width), np.uint32)
    for k in range(width):
        w[:, k] = ids[k:k + n]
        if k:
            w[w[:, k - 1] == 0, k] = 0
    return w[(w[:, 0] != 0) & (w[:, 1] != 0)]


def _groups(column: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the end."""
    return np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1, [len(column)]])


class HatTrie:
    """Counts windows: nodes map the next word id to a subtree; leaves are hash containers of the words after it.

    ``words`` is the number of words below this node. A container (a dict from the
    packed words to their count) of one word's tail that exceeds ``burst`` entries
    becomes a node of its own.
    """

    def __init__(self, words: int, burst: int = BURST):
        self.words, self.burst = words, burst
        self.children: dict[int, dict[bytes, int] | HatTrie] = {}
        self.sizes: dict[int, int] = {}

    def __len__(self) -> int:
        return sum(self.sizes.values())

    def add(self, windows: np.ndarray, counts: np.ndarray | None = None) -> None:
        """Add rows of ``words`` ids, each once or ``counts`` times."""
        if not len(windows):
            return
        order = np.argsort(windows[:, 0], kind="stable")
        windows = windows[order]
        starts = _groups(windows[:, 0])
        tails = np.ascontiguousarray(windows[:, 1:]).view(f"S{4 * (self.words - 1)}").ravel().tolist()
        times = None if counts is None else counts[order].tolist()
        for word, a, b in zip(windows[starts[:-1], 0].tolist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            child = self.children.get(word)
            if child is None:
                child = self.children[word] = {}
            if isinstance(child, HatTrie):
                child.add(windows[a:b, 1:], None if counts is None else counts[order[a:b]])
            elif times is None:
                for t in tails[a:b]:
                    child[t] = child.get(t, 0) + 1
            else:
                for t, c in zip(tails[a:b], times[a:b], strict=True):
                    child[t] = child.get(t, 0) + c
            if not isinstance(child, HatTrie) and len(child) > self.burst and self.words > 2:
                node = HatTrie(self.words - 1, self.burst)
                node.add(*_unpacked(child, self.words - 1))
                child = self.children[word] = node
            self.sizes[word] = len(child)

    def take(self, words: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Remove the subtrees of ``words``; their windows and counts."""
        rows, counts = [], []
        for word in words:
            child = self.children.pop(word)
            del self.sizes[word]
            tails, times = child.take(list(child.children)) if isinstance(child, HatTrie) else _unpacked(child, self.words - 1)
            rows.append(np.concatenate([np.full((len(tails), 1), word, np.uint32), tails], axis=1))
            counts.append(times)
        if not rows:
            return np.zeros((0, self.words), np.uint32), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(counts)


def _unpacked(container: dict[bytes, int], words: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.array(list(container), f"S{4 * words}").view(np.uint32).reshape(-1, words)
    return keys, np.fromiter(container.values(), np.int64, len(container))


def sort_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their columns; three small ids are compared as one number."""
    if all(int(c.max(initial=0)) < 1 << 21 for c in columns):
        keys = []
        for i in range(0, len(columns), 3):
            key = np.zeros(len(columns[0]), np.uint64)
            for c in columns[i:i + 3]:
                key = (key << np.uint64(21)) | c.astype(np.uint64)
            keys.append(key)
        columns = keys
    return np.lexsort(columns[::-1])


def leading_hot(rows: np.ndarray, hot: int) -> np.ndarray:
    """Number of words before the first that is not hot (ids 1 to ``hot`` are)."""
    return np.cumprod((rows > 0) & (rows <= hot), axis=1).sum(axis=1)


def partition_of(rows: np.ndarray, hot: int, parts: int) -> np.ndarray:
    """Prefix partition of each window: a hash of its words up to the first that is not hot."""
    depth = leading_hot(rows, hot) + 1
    h = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        mixed = (h ^ rows[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h = np.where(depth > k, mixed ^ (mixed >> np.uint64(29)), h)
    return (h % np.uint64(parts)).astype(np.int64)


def encode_run(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted rows column by column and byte plane by byte plane, compressed."""
    body = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in (*rows.T, counts))
    head = np.array([len(rows), rows.shape[1], rows.itemsize, len(body)], np.int64).tobytes()
    return head + pa.compress(body, codec="zstd", asbytes=True)


def decode_run(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, item, size = np.frombuffer(run, np.int64, 4).tolist()
    body = np.frombuffer(pa.decompress(run[32:], size, codec="zstd", asbytes=True), np.uint8)
    kind = np.dtype(f"u{item}")
    ids = body[:n * width * item].reshape(width, item, n)
    rows = np.stack([np.ascontiguousarray(c.T).view(kind).ravel() for c in ids], axis=1)
    return rows, np.ascontiguousarray(body[n * width * item:].reshape(8, n).T).view(np.int64).ravel()


def window_runs(docs: DataFrame, known, complete: bool, hot: int, parts: int, width: int,
                budget: int = BUDGET, burst: int = BURST) -> DataFrame:
    """(part, run): the sorted runs that the tries of all tasks spill; ``known`` is a broadcast."""

    def spill(trie: HatTrie, words: list[int], local: list[int] | None) -> pa.RecordBatch:
        rows, counts = trie.take(words)
        if local is not None:
            rows = np.array(local, np.int64).astype(np.uint64)[rows]
        part = partition_of(rows, hot, parts)
        order = sort_order([part, *rows.T]) if local is None else np.lexsort([*rows.T[::-1], part])
        rows, counts, part = rows[order], counts[order], part[order]
        cuts = _groups(part) if len(part) else np.zeros(1, np.int64)
        return pa.RecordBatch.from_pydict({
            "part": pa.array(part[cuts[:-1]], pa.int64()),
            "run": pa.array([encode_run(rows[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = known.value
        size = sum(map(len, listed.values()))
        trie, vocabularies, waiting, n = HatTrie(width, burst), {}, [], 0
        local = None if complete else list(range(size + 1))

        def block(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal trie, local, waiting, n
            ids = np.concatenate([*waiting, np.zeros(width - 1 if last else 0, np.uint32)])
            trie.add(windows_of(ids, width))
            # windows that start in the last words wait for the words that follow
            waiting, n = [ids[max(len(ids) - width + 1, 0):]], 0
            crowded = local is not None and len(local) > size + 2 * budget
            if last or crowded:
                yield spill(trie, list(trie.children), local)
            elif len(trie) > budget:
                largest, out, free = sorted(trie.sizes, key=trie.sizes.get, reverse=True), [], 0
                for word in largest:
                    out.append(word)
                    free += trie.sizes[word]
                    if 2 * free > budget:
                        break
                yield spill(trie, out, local)
            if crowded and not last:
                # the words that wait would lose their numbers: they begin the new list
                numbers = [local[i] for i in waiting[0].tolist()]
                local = [*range(size + 1), *numbers]
                waiting = [np.array([x if x <= size else size + 1 + i for i, x in enumerate(numbers)], np.uint32)]
                vocabularies.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                for words in words_of(text):
                    ids = vocabularies.get(lang)
                    if ids is None:
                        ids = vocabularies[lang] = _Ids(listed.get(lang, {}), lang, local)
                    waiting.append(np.fromiter(map(ids.__getitem__, words), np.uint32, len(words)))
                    n += len(words)
                    if n >= BLOCK:
                        yield from block(False)
                waiting.append(np.zeros(1, np.uint32))
        yield from block(True)

    return docs.mapInArrow(count, "part bigint, run binary")


def merge_runs(runs: DataFrame, least: int, hot: int) -> DataFrame:
    """(ids, f): counts of phrases, whole ones of ``least`` or more, and partial ones of hot words alone."""

    def merge(group: pa.Table) -> pa.Table:
        parts = [decode_run(r) for r in group.column("run").to_pylist()]
        kind = max((p[0].dtype for p in parts), key=lambda d: d.itemsize)
        rows = np.concatenate([p[0].astype(kind, copy=False) for p in parts])
        counts = np.concatenate([p[1] for p in parts])
        del parts
        order = sort_order(list(rows.T))
        rows, counts = rows[order], counts[order]
        lead = leading_hot(rows, hot)
        n, width = rows.shape
        new = np.zeros(n, bool)
        new[0] = True
        lists, sums = [], []
        for k in range(width):
            new[1:] |= rows[1:, k] != rows[:-1, k]
            if k == 0:
                continue
            at = np.flatnonzero(new)
            f = np.add.reduceat(counts, at)
            # a phrase of hot words alone is counted in several partitions, unless it is a whole window
            spread = (lead[at] > k) & (k + 1 < width)
            ok = (rows[at, k] != 0) & (spread | (f >= least))
            flat = rows[at[ok], :k + 1].astype(np.int64)
            lists.append(pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * (k + 1)), pa.array(flat.ravel())))
            sums.append(f[ok])
        return pa.table({"ids": pa.chunked_array(lists, pa.list_(pa.int64())), "f": pa.array(np.concatenate(sums), pa.int64())})

    found = runs.groupBy("part").applyInArrow(merge, "ids array<bigint>, f bigint")
    return found.groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def count_phrases(docs: DataFrame, least: int, longest: int, budget: int = BUDGET, burst: int = BURST,
                  part: int = PART, most: int = DICTIONARY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases (ids, f) of one to ``longest`` words, words (lang, word, f, id), totals (lang, n)) of ``docs`` (lang, text)."""
    spark = docs.sparkSession
    everything = staged(count_words(docs), "word-counts")
    totals = staged(everything.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
    words, known, complete = number_words(everything, least, most)
    n = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    parts = max(shuffle_partitions(spark), n // part)
    # listed ids fall by count, so the hot words are the first ones; fewer than ``parts`` of them
    hot = words.where((F.col("id") < HASHED) & (F.col("f") * parts > n)).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    runs = window_runs(docs, spark.sparkContext.broadcast(known), complete, hot, parts, longest, budget, burst)
    phrases = merge_runs(runs, least, hot).unionByName(words.select(F.array("id").alias("ids"), "f"))
    return staged(phrases, "phrases"), words, totals


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5,
                 cover: int = 100, top: int = 2000, **sizes: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the ``top`` phrases by their weakest cut.

    A phrase of two to ``longest`` words with ``a >= least`` occurrences is a
    candidate; one that lies inside a longer candidate with ``cover`` percent of
    its count goes. Cut after its first ``k`` words it scores
    ``floor(1000 a n / (l r))``; the lowest score counts, then the smallest ``k``.
    """
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    phrases, words, totals = count_phrases(docs, least, longest, **sizes)
    size = F.size("ids")
    # whatever lies in a longer candidate lies in one that is one word longer and at least as frequent
    inside = F.explode(F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1)))
    longer = phrases.where(size > 2).select(inside.alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer"))
    kept = phrases.where(size > 1).join(longer, "ids", "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * cover)).select("ids", F.col("f").alias("a"))
    kept = staged(kept, "candidates")

    spelled = staged(kept.select("ids", "a", F.posexplode("ids").alias("at", "id")), "candidate-words")
    spelled = join_unique(spelled, words.select("id", "lang", "word"), ["id"])
    text_of = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    spelled = staged(spelled.groupBy("ids", "a").agg(F.min("lang").alias("lang"), text_of.alias("phrase")), "candidate-phrases")
    spelled = join_unique(spelled, totals, ["lang"])

    k = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = spelled.select("*", k).select("*", F.slice("ids", F.lit(1), F.col("k")).alias("first"),
                                         F.slice("ids", F.col("k") + 1, size).alias("rest"))
    cuts = staged(cuts, "candidate-cuts")
    cuts = staged(join_unique(cuts, phrases.select(F.col("ids").alias("first"), F.col("f").alias("l")), ["first"]).drop("first"), "candidate-firsts")
    cuts = join_unique(cuts, phrases.select(F.col("ids").alias("rest"), F.col("f").alias("r")), ["rest"])
    # 38 digits hold the products, and the quotient of whole numbers is a long
    score = F.expr("(CAST(1000 * CAST(a AS DECIMAL(20,0)) * n AS DECIMAL(38,0)) DIV CAST(CAST(l AS DECIMAL(19,0)) * r AS DECIMAL(38,0)))")
    worst = cuts.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    worst = worst.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut")).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = worst.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
