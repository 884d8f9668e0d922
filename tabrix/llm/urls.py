"""URL filters: host and path rules, and trust propagated over the link graph (native Spark expressions).

``rule_of`` applies hand-written rules to each URL. Where no rule fits, the
host's standing in the link graph decides:

1. Host edges are the links of the pages' HTML that name another host, counted
   per (host, host) with map-side combine.
2. Seeds are hosts most of whose pages a rule allows (trusted) or blocks
   (blocked), and any given ones. Each seed weighs one, so scores and threshold
   mean the same at every size of the corpus.
3. Personalised PageRank carries trust along the links from trusted seeds, and
   distrust against them from blocked seeds: who links to blocked hosts is
   distrusted. Both walk in one loop, as a frontier of masses: a round is one join
   of the moves with the frontier and one sum by target, written to the shared
   folder. Walks end after ``ROUNDS`` links (longer ones hold less than
   ``DAMPING ** ROUNDS`` of the mass) or when no mass is left.
4. A host is blocked if its distrust exceeds its trust by ``MARGIN``.

Hot hosts: a host with a third of all pages or links is summed map-side, and the
joins go through ``operators.keyed.join_unique``, which broadcasts the few hot rows.

Edge cases: a URL that is NULL or has no ``://`` has an empty host and path, fits
no rule and is allowed; NULL HTML has no links; links of a host to itself and
links without a host count for nothing; repeated rows are judged alike (each
counts as a page); hosts that are linked to but have no page pass mass on; an
empty table gives an empty result; extra columns pass through, an added name
replaces an equal one.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.llm.common import ascii_lower, fresh, scratch_path, staged
from tabrix.operators.keyed import hot_keys, join_unique

DAMPING = 0.85
ROUNDS = 40
MARGIN = 0.1

#: Links that name a host: with a scheme or beginning with two slashes.
LINK = "(?i)href\\s*=\\s*[\"']?\\s*(?:[a-z][a-z0-9+.\\-]*:)?//([^/?#\"'\\s<>]+)"
URL = "://([^/?#]*)([^?#]*)"


class Rule(NamedTuple):
    """``verdict`` for URLs whose host is ``host`` or below it and whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, or NULLs. Of two equally long rules the longer host, then a block wins.

    The rules are part of the expression: a list written by hand. Long lists of
    whole hosts belong into the seed tables of ``judge_urls``.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.verdict == "block")):
        if r.verdict not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks, not {r.verdict!r}")
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return F.struct(name.alias("rule"), verdict.alias("verdict"))


def host_links(html: Column) -> Column:
    """The distinct hosts to which a page links."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), F.lit(1)), ascii_lower))


def host_edges(pages: DataFrame, host: str, links: str) -> DataFrame:
    """(src, dst, pages): links between different hosts, from one row per page with its host and link hosts."""
    pairs = pages.select(F.col(host).alias("src"), F.explode(links).alias("dst")).where("src != '' AND dst != '' AND src != dst")
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("pages"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, score) for every host that mass reaches.

    ``edges`` has (src, dst, pages), ``seeds`` (kind, host, weight): kind
    ``trust`` walks along the edges, ``distrust`` against them.
    """
    spark = edges.sparkSession
    edges = staged(edges, "host-edges")
    ways = []
    for kind, a, b in (("trust", "src", "dst"), ("distrust", "dst", "src")):
        out = edges.groupBy(a).agg(F.sum("pages").alias("all_pages"))
        share = join_unique(edges, out, [a]).select(
            F.lit(kind).alias("kind"), F.col(a).alias("host"), F.col(b).alias("target"), (F.col("pages") / F.col("all_pages")).alias("share"))
        ways.append(share)
    moves = staged(ways[0].unionByName(ways[1]), "host-moves")
    hot = hot_keys(moves, ["kind", "host"])
    start = seeds.groupBy("kind", "host").agg((F.sum("weight") * (1 - damping)).alias("mass"))
    base = scratch_path(spark, "host-mass")
    paths = [f"{base}/0"]
    start.write.parquet(paths[0])
    schema = spark.read.parquet(paths[0]).schema
    for i in range(1, rounds + 1):
        frontier = spark.read.schema(schema).parquet(paths[-1])
        if frontier.isEmpty():
            break
        sent = join_unique(moves, frontier, ["kind", "host"], hot=hot)
        after = sent.groupBy("kind", F.col("target").alias("host")).agg(F.sum(F.col("mass") * F.col("share") * damping).alias("mass"))
        paths.append(f"{base}/{i}")
        after.write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths).groupBy("kind", "host").agg(F.sum("mass").alias("score"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", html: str = "html",
               trusted: DataFrame | None = None, blocked: DataFrame | None = None,
               margin: float = MARGIN, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``pages`` without ``html``, with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    ``trusted`` and ``blocked`` may add seeds: tables of any size with a column ``host``.
    """
    links, gone, read = (fresh(pages, x) for x in ("links", "is_blocked", "read"))
    # both parts of the URL and the links in one struct: a page's text is matched once
    made = pages.withColumn(read, F.struct(url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
                                           host_links(F.col(html)).alias("links")))
    made = made.drop(html).withColumns({"host": F.col(f"{read}.host"), "path": F.col(f"{read}.path"), links: F.col(f"{read}.links")})
    made = made.withColumn(read, rule_of(F.col("host"), F.col("path"), rules))
    made = staged(made.withColumns({"rule": F.col(f"{read}.rule"), "verdict": F.col(f"{read}.verdict")}).drop(read), "url-pages")

    by_host = made.where("host != ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "allow").alias("allowed"),
        F.count_if(F.col("verdict") == "block").alias("blocked"))
    kind = F.when(F.col("allowed") * 2 > F.col("n"), "trust").when(F.col("blocked") * 2 > F.col("n"), "distrust")
    seeds = by_host.select(kind.alias("kind"), "host").where("kind IS NOT NULL")
    for extra, name in ((trusted, "trust"), (blocked, "distrust")):
        if extra is not None:
            seeds = seeds.unionByName(extra.where("host IS NOT NULL").select(F.lit(name).alias("kind"), ascii_lower(F.col("host")).alias("host")))
    seeds = seeds.distinct().withColumn("weight", F.lit(1.0))

    scores = propagate(host_edges(made, "host", links), seeds, damping, rounds)
    sign = F.when(F.col("kind") == "trust", -F.col("score")).otherwise(F.col("score"))
    # rounded: the order in which masses are summed must not decide
    standing = scores.groupBy("host").agg(F.round(F.sum(sign), 9).alias("standing"))
    bad = staged(standing.where(F.col("standing") > margin).select("host", F.lit(True).alias(gone)), "blocked-hosts")
    out = join_unique(made.drop(links), bad, ["host"], "left")
    verdict = F.coalesce(F.col("verdict"), F.when(F.col(gone), "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).drop(gone)
