"""Quality rules with risk-controlled thresholds (native Spark expressions).

``text_measures`` computes word, symbol, line and repetition counts of whole
texts inside one row, without explode or shuffle. ``severity_step`` turns them
into the first step of a fixed path of ever stricter rules at which a document
would go. ``certified_steps`` decides per stratum how far along that path the
rules may go: on labelled good documents the number ``k`` of ``n`` rejected by
a step is compared with an exact binomial tail. Step ``t`` is certified if

    P(Binomial(n, alpha) <= k_t) <= delta / strata

holds for it and for every step before it. Testing along a fixed sequence keeps
the error over all steps at ``delta / strata``, and the division (Bonferroni)
keeps the error over all strata at ``delta``: with probability ``1 - delta``, no
stratum loses more than the share ``alpha`` of its good documents to the path.
Labels enter as counts by (stratum, step): all labelled rows are used, and a hot
stratum is summed map-side.

Edge cases: NULL and empty texts have zero counts and fail the base rule;
a NULL stratum is a stratum of its own; a stratum without enough good labels
gets no certified step, so only the base rule rejects there; any number of strata
is judged (cutoffs of more than ``MAX_STRATA`` are joined); a document labelled
both good and bad counts as good; repeated rows are judged alike; an empty table
gives an empty result. Columns of the input pass through; an added name replaces
an equal one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.llm.common import SPACE, bind, fresh, staged

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
WORD_CHAR = "[^\\x20\\x09-\\x0D]"

#: Cutoffs of each rule from lenient to strict; a value above a cutoff goes.
RULES: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1),
    "shouts_per_word": (1.5, 1.0, 0.8, 0.6, 0.45, 0.3, 0.2, 0.15),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5),
}


#: Cutoffs of up to so many strata travel as one map; more are joined.
MAX_STRATA = 10_000


@dataclass(frozen=True)
class Risk:
    """At most the share ``alpha`` of a stratum's good documents may go, with confidence ``1 - delta``."""

    alpha: float = 0.02
    delta: float = 0.05


def _covered(hashes: Column) -> Column:
    """Positions covered by windows whose hash occurs twice or more."""
    tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get(s, j + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def total(idx: Column) -> Column:
        part = F.transform(idx, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(idx, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    return bind(bind(tagged, repeated), total)


def _pairs(hashes: Column, apart: int) -> Column:
    """Hash of every element with the one ``apart`` places on (junk at the end)."""
    return bind(hashes, lambda h: F.zip_with(h, F.slice(h, F.lit(apart + 1), F.size(h)), lambda a, b: F.xxhash64(a, b)))


def _window_hashes(words: Column) -> Column:
    """One hash per window of eight words, by doubling: 1, 2, 4, 8 words."""
    ones = F.transform(words, lambda w: F.xxhash64(w))
    eights = _pairs(_pairs(_pairs(ones, 1), 2), 4)
    return bind(eights, lambda h: F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))))


def _repeat_words(words: Column) -> Column:
    few = lambda h: F.size(F.array_distinct(h)) == F.size(h)
    return bind(_window_hashes(words), lambda h: F.when(few(h), F.lit(0).cast("long")).otherwise(_covered(h)))


def text_measures(text: Column) -> dict[str, Column]:
    """Counts of one whole text; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    by_words = bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                              F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                                              _repeat_words(w).alias("n_repeat_words")))
    by_lines = bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                              (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return {
        "by_words": by_words,
        "by_lines": by_lines,
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_shouts": F.regexp_count(text, F.lit("!")).cast("long"),
    }


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of ``text_measures`` and ``base_failed``."""
    t = fresh(df, "measures")
    m = text_measures(F.col(text))
    out = df.withColumn(t, F.struct(*[c.alias(k) for k, c in m.items()]))
    cols = {"n_words": F.col(f"{t}.by_words.n_words"), "word_chars": F.col(f"{t}.by_words.word_chars"),
            "n_repeat_words": F.col(f"{t}.by_words.n_repeat_words"),
            "n_lines": F.col(f"{t}.by_lines.n_lines"), "n_dup_lines": F.col(f"{t}.by_lines.n_dup_lines"),
            **{k: F.col(f"{t}.{k}") for k in ("n_symbols", "n_shouts")}}
    out = out.withColumns(cols).drop(t)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def severity_step(rules: dict[str, Sequence[float]] = RULES) -> Column:
    """First step of the path at which a measured document goes; NULL: never.

    The path tightens one rule at a time, in turn: step ``level * rules + rule``.
    """
    words = F.greatest(F.col("n_words"), F.lit(1))
    value = {
        "symbols_per_word": F.col("n_symbols") / words,
        "shouts_per_word": F.col("n_shouts") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    }
    steps = []
    for r, (name, cutoffs) in enumerate(rules.items()):
        step = F.lit(None).cast("int")
        for level, cut in reversed(list(enumerate(cutoffs))):
            step = F.when(value[name] > cut, F.lit(level * len(rules) + r)).otherwise(step)
        steps.append(step)
    return F.least(*steps) if len(steps) > 1 else steps[0]


def _binomial_tail(n: Column, k: Column, alpha: float) -> Column:
    """P(Binomial(n, alpha) <= k), summed term by term in log space."""
    first = n * F.lit(math.log1p(-alpha))
    odds = F.lit(math.log(alpha) - math.log1p(-alpha))
    start = F.struct(first.alias("term"), F.exp(first).alias("total"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (acc["total"] + F.exp(term)).alias("total"))

    i = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    # from the mean upwards the tail is about a half or more: it never passes, and is not summed
    return F.when(k >= n * alpha, F.lit(1.0)).otherwise(F.aggregate(i, start, add, lambda acc: acc["total"]))


def certified_steps(labelled: DataFrame, stratum: str, step: str, risk: Risk = Risk()) -> DataFrame:
    """Per stratum the last certified step (``last_step``, -1: none) and the number of good labels.

    ``labelled``: one row per good labelled document with its stratum and the
    step at which it would go (NULL: never).
    """
    s = F.col(stratum)
    seen = labelled.groupBy(s.alias("stratum"), F.coalesce(F.col(step), F.lit(1 << 20)).alias("step")).agg(
        F.count(F.lit(1)).alias("c"))
    # from here on there are strata x steps rows at most
    strata = seen.groupBy("stratum").agg(F.sum("c").alias("n"))
    zero = strata.select("stratum", F.lit(-1).alias("step"), F.lit(0).cast("long").alias("c"))
    n = F.sum("c").over(Window.partitionBy("stratum"))
    k = F.sum("c").over(Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    runs = seen.unionByName(zero).select("stratum", "step", n.alias("n"), k.alias("k"))
    total = strata.agg(F.count(F.lit(1))).scalar()
    tested = runs.withColumn("failed", _binomial_tail(F.col("n"), F.col("k"), risk.alpha) > F.lit(risk.delta) / total)
    first_bad = F.min(F.when(F.col("failed"), F.col("step")))
    return tested.groupBy("stratum").agg(
        F.max("n").alias("n_good"), F.coalesce(first_bad - 1, F.lit((1 << 20) - 1)).alias("last_step"))


def _named(stratum: Column) -> Column:
    """A map key for a stratum, NULL included."""
    return F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit(""))


def judge(measured: DataFrame, labels: DataFrame, key: str, stratum: str, risk: Risk = Risk(),
          rules: dict[str, Sequence[float]] = RULES) -> DataFrame:
    """``measured`` with ``kept``: false if the base rule or a certified step rejects.

    ``labels`` has (``key``, ``quality``); ``quality`` 1 marks a good document.
    ``measured`` is read twice (labels, then verdicts): pass a written table.
    """
    step = fresh(measured, "step")
    # base rejections are the contract's own; the path answers for what it takes beyond them
    own = measured.withColumn(step, F.when(~F.col("base_failed"), severity_step(rules)))
    good = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max("quality").alias("q")).where("q = 1")
    seen = own.select(F.col(key).alias("k"), F.col(stratum).alias("stratum"), F.col(step).alias("step"))
    steps = certified_steps(seen.join(good, "k", "left_semi"), "stratum", "step", risk)
    # a stratum without a certified step rejects nothing: only the others' cutoffs are needed
    name, cut = fresh(own, "stratum_name"), fresh(own, "cut")
    cuts = staged(steps.where("last_step >= 0").select(_named(F.col("stratum")).alias(name), F.col("last_step").alias(cut)),
                  "quality-cutoffs")
    if cuts.count() <= MAX_STRATA:
        # one value of the plan: documents are not shuffled
        table = cuts.agg(F.map_from_entries(F.collect_list(F.struct(name, cut)))).scalar()
        own = own.withColumn(cut, F.element_at(table, _named(F.col(stratum))))
    else:
        # adaptive execution cuts hot strata
        own = own.withColumn(name, _named(F.col(stratum))).join(cuts, name, "left").drop(name)
    gone = F.coalesce(F.col(step) <= F.col(cut), F.lit(False))
    return own.withColumn("kept", ~(F.col("base_failed") | gone)).drop(step, cut)
