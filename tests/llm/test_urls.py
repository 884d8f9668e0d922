"""URL filters: rules against brute force, propagation against plain Python, edge cases."""

import random

from llm_data import lower

from tabrix.llm.q_urls import RULES
from tabrix.llm.urls import DAMPING, MARGIN, ROUNDS, Rule, judge_urls

SCHEMA = "page_id bigint, url string, html string"


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    rest = rest.split("#")[0].split("?")[0]
    host, slash, path = rest.partition("/")
    return lower(host), slash + path


def brute_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.name), len(r.host), r.verdict == "block"), default=None)


def brute(pages, rules):
    """pages: (page_id, url, hosts linked to); the whole method with plain dictionaries."""
    judged = [(i, *parts(u), brute_rule(*parts(u), rules), links) for i, u, links in pages]
    edges = {}
    for _, host, _, _, links in judged:
        for to in set(links):
            if host and to and to != host:
                edges[host, to] = edges.get((host, to), 0) + 1
    standing = {}
    for word, sign, flip in (("allow", -1, False), ("block", 1, True)):
        mass = {}
        for h in {h for _, h, *_ in judged if h}:
            verdicts = [r.verdict if r else None for _, x, _, r, _ in judged if x == h]
            if 2 * verdicts.count(word) > len(verdicts):
                mass[h] = 1 - DAMPING
        ways = {((b, a) if flip else (a, b)): n for (a, b), n in edges.items()}
        out = {}
        for (a, _), n in ways.items():
            out[a] = out.get(a, 0) + n
        for _ in range(ROUNDS + 1):
            after = {}
            for h, m in mass.items():
                standing[h] = standing.get(h, 0) + sign * m
            for (a, b), n in ways.items():
                if a in mass:
                    after[b] = after.get(b, 0) + mass[a] * n / out[a] * DAMPING
            mass = after
    return sorted((i, h, p, r.name if r else None,
                   r.verdict if r else "block" if standing.get(h, 0) > MARGIN else "allow") for i, h, p, r, _ in judged)


def html(hosts):
    return "<p><a href='/own'>own</a>" + "".join(f'<A HREF="https://{h.upper()}/x?y">t</A><a href=//{h}>again</a>' for h in hosts)


def rows(df):
    return sorted(tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect())


def test_random_link_graph_against_plain_propagation(spark):
    rng = random.Random(5)
    hosts = [f"h{i}.{rng.choice(['com', 'net', 'org', 'example.net', 'example.com'])}" for i in range(25)]
    rules = [*RULES, Rule("allow", "h3.com"), Rule("block", "org", "/fr/x")]
    pages = [(i, f"https://{rng.choice(hosts)}{rng.choice(['/en/1', '/de/2#a', '/fr/x?q=/', '', '?x', '/'])}",
              [rng.choice(hosts) for _ in range(rng.randint(0, 4))]) for i in range(120)]
    # one host with a third of all pages, all linking to one more
    pages += [(200 + i, "http://hub.info/p", ["h0.spam.net", hosts[i % 25]]) for i in range(60)]
    df = spark.createDataFrame([(i, u, html(hs)) for i, u, hs in pages], SCHEMA)
    got = rows(judge_urls(df, rules))
    assert got == brute(pages, rules)
    assert len({r[4] for r in got if r[3] is None}) == 2  # propagation blocks some, not all


def test_distrust_runs_against_the_links_and_trust_along_them(spark):
    pages = [(1, "http://bad.net/x", []), (2, "http://friend.com/", ["bad.net"]), (3, "http://far.com/", ["friend.com"]),
             (4, "http://good.org/fr/", ["friend2.com"]), (5, "http://friend2.com/", ["bad.net"]), (6, "http://other.com/", [])]
    df = spark.createDataFrame([(i, u, html(hs)) for i, u, hs in pages], SCHEMA)
    got = {r[0]: r[4] for r in rows(judge_urls(df, RULES))}
    assert got == {i: v for i, *_, v in brute(pages, RULES)}
    assert got[6] == "allow" and got[1] == "block" and got[4] == "allow"


def test_given_seed_tables(spark):
    df = spark.createDataFrame([(1, "http://a.com/", html([])), (2, "http://b.com/", html(["a.com"])), (3, "http://c.com/", "")], SCHEMA)
    bad = spark.createDataFrame([("A.com",), (None,)], "host string")
    assert [r[4] for r in rows(judge_urls(df, RULES, blocked=bad))] == ["block", "block", "allow"]


def test_edge_cases(spark):
    odd = [(1, None, None), (2, "", ""), (3, "no scheme/", "x"), (4, "a://", None), (5, "http://EX.example.NET/en/a?b://c", None),
           (6, "http://x.com#/de/", None), (6, "http://x.com#/de/", None), (None, "http://Ünï.com/ä", None),
           (8, "://example.com/de/", "href=//" + "y" * 100_000), (9, "x://y://z/w", "<a href='mailto://'>")]
    df = spark.createDataFrame(odd, SCHEMA)
    got = judge_urls(df, RULES)
    want = [(i, *parts(u), (r := brute_rule(*parts(u), RULES)) and r.name, r.verdict if r else "allow") for i, u, _ in odd]
    assert sorted(map(repr, (tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()))) == sorted(map(repr, want))
    assert judge_urls(df.limit(0), RULES).count() == 0
    clash = df.selectExpr("*", "'mine' AS host", "1 AS links", "2 AS is_blocked", "3 AS `a.b`")
    out = judge_urls(clash, RULES)
    assert set(out.columns) == {"page_id", "url", "host", "path", "rule", "verdict", "links", "is_blocked", "a.b"}
    assert out.where("links = 1 AND is_blocked = 2").count() == len(odd) and out.where("host = 'mine'").count() == 0
