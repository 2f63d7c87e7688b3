import random
import re

import pytest

from cartspark.llm import url_filter
from cartspark.llm.url_filter import RULES, Rule, Trie, filter_urls


def plain(url, rules=RULES, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m.group().lower(), re.match("[^/?#]*", rest).group())
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    fits = [
        r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.host), len(r.path), r.verdict == "block"), default=None)
    return host, path, best and best.name, best.verdict if best else default


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.Net/x?y#z", "https://www.example.net/en/1",
    "https://example.net/en", "https://example.net/EN/1", "ftp://notexample.net/en/", "http://example.com/de/x://y",
    "http://a.example.com/de/", "http://org/fr/a", "http://x.org/fra/", "http://example.net:80/en/", "x://ÄB.net/a b",
    "http://example.net?/en/", "http://example.net#/en/", "http://.net/", "http://net./", "://net/a", "http://a@net/\nq",
]


@pytest.mark.parametrize("join", [False, True])
def test_given_rules(spark, monkeypatch, join):
    if join:
        monkeypatch.setattr(url_filter, "BROADCAST_CHARACTERS", 0)
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(rows).collect()}
    assert got == {i: plain(u) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("join", [False, True])
def test_random_rules(spark, monkeypatch, join):
    if join:
        monkeypatch.setattr(url_filter, "BROADCAST_CHARACTERS", 0)
    rng = random.Random(3)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 3)))
    path = lambda: rng.choice(["", "/"]) + "/".join(rng.choice(["x", "xy", "y", ""]) for _ in range(rng.randint(0, 3)))
    fixed = {(r.host, r.path): r for r in (Rule(rng.choice(["allow", "block"]), host(), p if p.startswith("/") else "") for p in (path() for _ in range(40)))}
    rules = list(fixed.values())
    urls = [f"http://{host()}/{path()}" for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(rows, rules, "block").collect()}
    assert got == {i: plain(u, rules, "block") for i, u in enumerate(urls)}


def test_block_wins_a_tie_and_tails_need_no_segment_end():
    trie = Trie([Rule("allow", "a.b", "/x"), Rule("block", "a.b", "/x"), Rule("allow", "a.b", "/xy")])
    assert trie.find("a.b", "/x1").verdict == "block"
    assert trie.find("q.a.b", "/xyz").verdict == "allow"
    assert trie.find("b", "/x") is None


def test_other_columns_repeated_rows_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "http://net/", "mine", 5)] * 2, "page_id long, url string, rule string, n int")
    assert [(r.rule, r.n) for r in filter_urls(rows).collect()] == [("net/", 5)] * 2
    assert filter_urls(rows.limit(0)).count() == 0
