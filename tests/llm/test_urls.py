import random
from collections import Counter
from itertools import combinations

import pytest

from beaconflow.llm import urls
from beaconflow.llm.queries import URL_RULES
from beaconflow.llm.urls import filter_urls, mine_rules

AZ = str.maketrans(urls.UPPER, urls.LOWER)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return rest[:cut].translate(AZ), path[:end]


def listed(host, path, rules):
    best = None
    for verdict, rule in rules:
        own, rest = rule[: rule.find("/")], rule[rule.find("/") :]
        if (host == own or host.endswith("." + own)) and path.startswith(rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def mined(baskets):
    """Brute force: every token combination of every basket."""
    n, both, alone = len(baskets), Counter(), Counter()
    for tokens, verdict in baskets:
        for k in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), k):
                alone[c] += 1
                both[c, verdict] += 1
    rules = {(c, v): k / alone[c] for (c, v), k in both.items() if k >= urls.SUPPORT * n and k >= urls.CONFIDENCE * alone[c]}
    keep = lambda c, v, conf: all(rules.get((tuple(t for t in c if t != out), v), -1) < conf for out in c)
    return {(c, v): (conf, both[c, v] / n, conf) for (c, v), conf in rules.items() if keep(c, v, conf)}


def test_whole_table_matches_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    out = filter_urls(pages, URL_RULES).collect()
    url = {r.page_id: r.url for r in pages.select("page_id", "url").collect()}
    assert len(out) == len(url)
    tokens = {
        r.url: r.t
        for r in pages.select("url", urls.url_tokens(urls.host_of(pages.url), urls.path_of(pages.url), pages.url).alias("t")).distinct().collect()
    }
    decided = {u: listed(*parts(u), URL_RULES) for u in tokens}
    labelled = [(tokens[u], d[0]) for u, d in decided.items() if d]
    frequent = {t for t, k in Counter(t for ts, _ in labelled for t in ts).items() if k >= urls.SUPPORT * len(labelled)}
    rules = mined([([t for t in ts if t in frequent], v) for ts, v in labelled])
    assert rules
    for r in out:
        u = url[r.page_id]
        assert (r.host, r.path) == parts(u)
        if decided[u]:
            assert (r.verdict, r.rule) == decided[u]
        else:
            fits = [(conf, sup, len(c), v, " ".join(c)) for (c, v), (conf, sup, _) in rules.items() if set(c) <= set(tokens[u])]
            assert r.rule is None and r.verdict == (max(fits)[3] if fits else "allow")
    assert {r.verdict for r in out if r.rule is None} == {"allow", "block"}


def test_mined_rules_are_those_of_brute_force(spark):
    baskets = [(["a", "b"], "block")] * 30 + [(["a", "c"], "allow")] * 40 + [(["b"], "allow")] * 10 + [(["a", "b", "d"], "block")] * 5
    got = mine_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string")).collect()
    want = {k: (round(v[0], 9), round(v[1], 9)) for k, v in mined(baskets).items()}
    assert {(tuple(r.tokens), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in got} == want


def test_mined_rules_of_long_baskets_with_tokens_that_come_together(spark):
    """Whole baskets of up to eleven tokens; twins share their URLs, pure tokens decide alone."""
    rng, baskets = random.Random(5), []
    for _ in range(400):
        tokens = [t for t in "abcdefg" if rng.random() < 0.45]
        verdict = "block" if {"a", "b"} <= set(tokens) or rng.random() < 0.1 else "allow"
        tokens += ["twin-a"] * ("a" in tokens) + ["twin-b", "third-b"] * ("b" in tokens) + ["always"]
        tokens += ["pure"] * (verdict == "block" and rng.random() < 0.4) + ["pure2"] * (verdict == "allow" and "c" in tokens)
        baskets.append((tokens, verdict))
    got = mine_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string")).collect()
    want = {k: (round(v[0], 9), round(v[1], 9)) for k, v in mined(baskets).items()}
    assert {(tuple(r.tokens), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in got} == want
    assert (("pure",), "block") in want and (("third-b", "twin-a"), "block") in want and len(got) == len(want)


@pytest.mark.parametrize(
    "url",
    ["http://EXAMPLE.org/es/x", "https://a.b.example.org/en/12?q#f", "x://org", "x://org/", "http://notexample.org/es/", "http://exampleXorg/es/", "http://a.com/fr/", "http://a.com/de", "http://a.com/de/?/fr/", "a://b://c/d", "://", "no scheme", "", None, "http://É.COM/De/", "http://a?b/c", "http://a#b://c/d", "http://com/de/\nx", "HTTP://Example.Org:80/es/"],
)
def test_hosts_paths_and_listed_rules(spark, url):
    r = filter_urls(spark.createDataFrame([(1, url)], "page_id long, url string"), URL_RULES).first()
    assert (r.host, r.path) == parts(url)
    assert (r.verdict, r.rule) == (listed(*parts(url), URL_RULES) or ("allow", None))


def test_edge_cases(spark):
    schema = "page_id long, url string, host string, verdict string, token string"
    long = "http://a.net/" + "/".join(f"seg{chr(97 + i % 26) * (i % 9 + 1)}" for i in range(3000))
    rows = [(1, None), (None, "http://x.org/a"), (2, "http://x.org/a"), (2, "http://x.org/a"), (3, long), (4, "http://y.com/de/1")]
    df = spark.createDataFrame([(*r, "h", "v", "t") for r in rows], schema)
    out = filter_urls(df, URL_RULES)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "matched"] and out.count() == len(rows)
    assert filter_urls(df.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in filter_urls(df, []).collect()} == {"allow"}
    assert [r.verdict for r in filter_urls(df, [("allow", "org/a"), ("block", "org/a")]).where("page_id = 2").collect()] == ["block"] * 2


def test_the_main_path_has_no_python(spark):
    plan = filter_urls(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "html"))
