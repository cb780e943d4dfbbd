from __future__ import annotations

import random

import pytest

from fleetlake.llm import url_rules as U


def judged(url, rules):
    """Every rule against one url."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [i for i, c in enumerate(rest) if c in "/?#"]
        cut = min(ends, default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min((i for i, c in enumerate(path) if c in "?#"), default=len(path))]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("a.example.net", "/en/x", "block"),
    ("org", "/fr/", "allow"),
    ("example.org", "", "block"),
    ("b.c", "/é/", "block"),
]


def test_against_every_rule(spark):
    rng = random.Random(3)
    hosts = ["net", "a.net", "example.net", "a.example.net", "q.a.example.net", "xexample.net", "ORG", "example.org", "b.c", "..", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/en/xy/1", "/fr/2", "/é/1", "/fr"]
    tails = ["", "?a=://net/en/", "#x/en/"]
    urls = [None, "", "no scheme", "://", "http://net", "x\n://a.net/\n/b", "HTTP://A.Net/En/"]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}" for _ in range(400)]
    urls += ["http://example.net/en/hot"] * 300 + ["http://" + "a." * 500 + "net/" + "p" * 50_000]
    rows = [(i, u, "kept") for i, u in enumerate(urls)] + [(1, "http://net/", "again")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULES + [(None, "/", "block"), ("net", None, "allow")], "host string, path string, verdict string")
    got = sorted((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(df, rules).collect() if r.url)
    want = sorted((i, u, *judged(u, RULES)) for i, u, _ in rows if u)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r.rule_ for r in U.judge_urls(df, rules).collect()} == {"kept", "again"}


@pytest.mark.parametrize("empty", ["urls", "rules"])
def test_empty(spark, empty):
    urls = spark.createDataFrame([] if empty == "urls" else [(1, "http://net/a")], "page_id long, url string")
    rules = spark.createDataFrame([] if empty == "rules" else RULES, "host string, path string, verdict string")
    rows = U.judge_urls(urls, rules).collect()
    assert [(r.rule, r.verdict) for r in rows] == ([] if empty == "urls" else [(None, "allow")])


def test_conflicting_rules_block(spark):
    urls = spark.createDataFrame([(1, "http://net/a")], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "allow"), ("net", "/", "block")], "host string, path string, verdict string")
    assert U.judge_urls(urls, rules).first().verdict == "block"


def test_hosts_with_one_key_are_spread(spark, monkeypatch):
    """Thousands of hosts below one rule with one path, and urls without a host."""
    placed = []
    place = U._place

    def counted(splitters):
        placed.append(splitters)
        return place(splitters)

    monkeypatch.setattr(U, "_place", counted)
    urls = [f"http://h{i}.net/" for i in range(4000)] + [None, "nothing"] * 500 + ["http://q.org/fr/x"] * 20
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = U.judge_urls(df, rules).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *judged(u, RULES)) for i, u in enumerate(urls)), key=str)
    assert sum(key == "net/" for key, _ in placed[0]) > 5


def test_rules_reach_all_parts_of_a_key():
    splitters = [("net/", -5), ("net/", 0), ("net/", 7), ("net/a", 3), ("org/", 1)]
    rows = [("net/", None, None, "net/", "block", 0), ("net/", "h", "/", None, None, 3), ("net/", "h", "/", None, None, 9)]
    names = ["key", "host", "path", "rule", "verdict", "spread"]
    batch = U.pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], U.pa.schema(
        [(n, U.pa.int64() if n == "spread" else U.pa.string()) for n in names]
    ))
    out = next(U._place(splitters)(iter([batch])))
    got = list(zip(out.column(0).to_pylist(), out.column(4).to_pylist()))
    assert got == [(b, "net/") for b in range(5)] + [(2, None), (3, None)]
