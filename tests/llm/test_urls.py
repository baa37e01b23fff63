"""The url filter against plain Python."""

import re
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import queries, urls

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, host string, verdict string, tokens string, token string"
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("(?s)[^/?#]*", rest)[0]
    path = re.match("(?s)[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path):
    fits = [
        (len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


ODD = [
    None, "", "no scheme", "http://", "://", "http://EXAMPLE.com/en/x", "http://www.Example.com/en/", "http://a.example.com/en/?q",
    "http://example.com/EN/", "http://xexample.com/en/1", "ftp://b.net/es/2#f", "http://net/fr/", "http://b.net", "http://b.net/es",
    "http://u://v.com/w", "https://com/", "http://é.org/\u00fc/a b?c", "http://a.com\n/x\ny", "http://x.org/" + "p/" * 5000, "http://.com/",
]


def test_frames(spark):
    rows = [(i, u, "h", "v", "t", "t") for i, u in enumerate([*ODD, ODD[5], ODD[5]])] + [(None, ODD[5], None, None, None, None)]
    out = urls.judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path = plain_parts(r.url)
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
        assert r.tokens == ("t" if r.page_id is not None else None)
    assert urls.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_mined(baskets, min_support, min_confidence):
    n = len(baskets)
    counts, blocked = {}, {}
    for tokens, bad in baskets:
        for k in range(1, len(tokens) + 1):
            for some in combinations(sorted(tokens), k):
                counts[some] = counts.get(some, 0) + 1
                blocked[some] = blocked.get(some, 0) + bad
    least = -(-min_support * n // 1)
    rules = {s: blocked[s] / counts[s] for s in counts if blocked[s] >= least and blocked[s] / counts[s] >= min_confidence}
    kept = {}
    for s, c in rules.items():
        if not any(rules.get(tuple(x for x in s if x != t), -1) >= c for t in s):
            kept[s] = c
    return kept


def test_mined_rules(spark):
    import random

    rng = random.Random(2)
    baskets = []
    for _ in range(300):
        tokens = rng.sample(["h:a", "h:b", "p:x", "p:y", "p:z", "p:w"], rng.randrange(0, 5))
        bad = ("p:x" in tokens and "h:a" in tokens and rng.random() < 0.97) or ("p:w" in tokens and rng.random() < 0.6)
        baskets.append((tokens, bad))
    df = spark.createDataFrame(baskets, "tokens array<string>, blocked boolean")
    mined = urls.mine_rules(df, 0.03, 0.8)
    filled = [(t, b) for t, b in baskets if t or b]
    expected = plain_mined(filled, 0.03, 0.8)
    got = {tuple(r.needs): r.confidence for r in mined.collect()}
    assert got.keys() == expected.keys() and len(got) > 1
    assert all(abs(got[k] - expected[k]) < 1e-12 for k in got)
    # Matching: a url is hit exactly if some rule's tokens are all among its own.
    asked = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(baskets)], "url string, tokens array<string>")
    hits = {r.url: (tuple(r.needs), r.confidence) for r in urls.matched(asked.where(F.size("tokens") > 0), mined).collect()}
    for i, (tokens, _) in enumerate(baskets):
        fits = [c for s, c in expected.items() if set(s) <= set(tokens)]
        assert (str(i) in hits) == bool(fits)
        if fits:
            assert hits[str(i)][1] == pytest.approx(max(fits)) and set(hits[str(i)][0]) <= set(tokens)


def test_mined_rules_decide_what_no_rule_names(spark):
    rows = [(i, f"http://s{i}.spam.net/es/cheap/{i}") for i in range(100)]
    rows += [(1000 + i, f"http://s{i}.blog.net/de/{i}") for i in range(100)]
    rows += [(2000, "http://new.spam.org/es/cheap/7"), (2001, "http://new.fine.org/de/7"), (2002, "http://new.spam.org/de/cheap")]
    out = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert out[2000].rule is None and out[2000].verdict == "block" and out[2000].mined
    assert out[2001].verdict == "allow" and out[1005].verdict == "allow" and out[1005].rule is None


def test_open_urls_neither_dilute_nor_feed_the_rules(spark):
    """A blocked pattern that far more open urls share is mined from the labelled rows all the same."""
    rows = [(i, f"http://s{i}.spam.net/es/cheap/{i}") for i in range(20)]
    rows += [(100 + i, f"http://s{i}.shop.com/es/fair/{i}") for i in range(20)]
    rows += [(1000 + i, f"http://t{i}.spam.org/es/cheap/{i}") for i in range(5000)]
    rows += [(9000 + i, f"http://t{i}.fine.org/es/fair/{i}") for i in range(100)]
    out = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert {r.verdict for i, r in out.items() if 1000 <= i < 9000} == {"block"}
    assert {r.verdict for i, r in out.items() if i >= 9000 or 100 <= i < 1000} == {"allow"}
    assert all(any(t.startswith("h:") for t in r.mined) and r.rule is None for r in out.values() if r.mined)


def test_the_main_path_is_native(spark, executed):
    plan = executed(queries.QUERIES["op1_url_filter"](spark, FOLDER))
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, url FROM '{FOLDER}/pages.parquet'").fetchall())
    rows = queries.QUERIES["op1_url_filter"](spark, FOLDER).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        host, path = plain_parts(pages[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
