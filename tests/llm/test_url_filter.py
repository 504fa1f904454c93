"""URL rules against a brute-force version."""

import random

import pytest
from pyspark.sql import functions as F

from chirplens.llm import url_filter
from chirplens.llm.url_filter import Rule, RuleTrie, drop_blocked, judge_urls, parse_rule


def brute(rules, url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end], rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        r
        for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"), default=None)
    return host, path, best and best.name, best.verdict if best else "allow"


def some(rng):
    labels, parts = ["a", "b", "net", ""], ["x", "xy", "", "y"]
    host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    path = "".join("/" + rng.choice(parts) for _ in range(rng.randint(0, 4)))
    return host, path


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(12)
    rules = []
    for _ in range(60):
        host, path = some(rng)
        rules.append(Rule(rng.choice(["allow", "block"]), host or "net", path))
    urls = []
    for _ in range(600):
        host, path = some(rng)
        urls.append(f"{rng.choice(['http', 'HTTPS', ''])}://{host.upper()}{path}{rng.choice(['', '?q=/x', '#/x', '?://'])}")
    urls += [None, "", "no scheme/x", "http://", "://", "http://net", "http://İ.Net/x", "http://a.net\n/x/\ny"]
    urls += ["http://" + "a." * 20_000 + "net/" + "x/" * 50_000] + urls[:20]
    return rules, urls


def test_trie_equals_trying_every_rule(cases):
    rules, urls = cases
    trie = RuleTrie(rules)
    for url in urls:
        host, path, name, verdict = brute(rules, url)
        found = trie.find(host, path)
        assert (found and found.name, found.verdict if found else "allow") == (name, verdict), url


@pytest.mark.parametrize("most", [url_filter.TRIE_BYTES, 700])
def test_judge_urls(spark, monkeypatch, cases, most):
    monkeypatch.setattr(url_filter, "TRIE_BYTES", most)
    rules, urls = cases
    frame = spark.createDataFrame(list(enumerate(urls)), "id long, url string").repartition(3)
    frame = frame.withColumns({"host": F.lit("own"), "labels": F.lit("own")})
    got = judge_urls(frame, rules).select("id", "host", "path", "rule", "verdict", "labels").collect()
    assert {(r[0], *r[1:5]) for r in got} == {(i, *brute(rules, u)) for i, u in enumerate(urls)}
    assert len(got) == len(urls) and {r["labels"] for r in got} == {"own"}
    left = drop_blocked(frame, rules)
    assert left.columns == frame.columns
    kept = sorted(r["id"] for r in left.collect())
    assert kept == [i for i, u in enumerate(urls) if brute(rules, u)[3] == "allow"]


def test_empty_tables_and_lists(spark):
    frame = spark.createDataFrame([(1, "http://a.net/"), (2, None)], "id long, url string")
    rules = [parse_rule("block", "Net/")]
    assert judge_urls(frame.where("false"), rules).count() == 0
    assert {r["verdict"] for r in judge_urls(frame, []).collect()} == {"allow"}
    assert {r["verdict"] for r in judge_urls(frame, [], default="block").collect()} == {"block"}
    assert [r["id"] for r in drop_blocked(frame, rules).collect()] == [2]


def test_equal_rules_block():
    both = [parse_rule("allow", "net/x"), parse_rule("block", "net/x")]
    for rules in (both, both[::-1]):
        assert RuleTrie(rules).find("a.net", "/xy").verdict == "block"


@pytest.mark.parametrize("verdict, text", [("deny", "net/"), ("block", "/x")])
def test_rules_that_are_none(verdict, text):
    with pytest.raises(ValueError):
        parse_rule(verdict, text)
