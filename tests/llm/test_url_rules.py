"""Given and mined url rules against plain Python."""

import math
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cambio.llm.queries import URL_RULES
from cambio.llm.url_rules import ALLOW, BLOCK, LEAST_CONFIDENCE, LEAST_SUPPORT, UrlRule, judge_urls, url_tokens

ODD_URLS = [
    (1, None),
    (2, ""),
    (3, "no scheme"),
    (4, "http://"),
    (5, "http:///en/x"),
    (6, "HTTP://Www.Example.COM/en/a?x://y"),
    (6, "HTTP://Www.Example.COM/en/a?x://y"),
    (7, "http://example.com"),
    (8, "http://example.com?q=/en/"),
    (9, "http://badexample.com/en/1"),
    (10, "http://a.net/es/1#x?y"),
    (11, "http://net/fr/"),
    (12, "http://xnet/fr/"),
    (13, "http://a.b.c.d.org/p1/q22/r.tar.gz?b=1&a=2&b=3&&c#f"),
    (14, "http://é.org/ü.html"),
    (15, "http://x.org/" + "a/" * 20_000),
    (16, "http://x.org/?" + "&".join(f"k{i}=1" for i in range(2_000))),
    (None, "http://x.org/en/1"),
    (None, None),
]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    made = spark.createDataFrame(rows, "page_id bigint, url string")
    return made.selectExpr("*", "'h' AS html", "1 AS host", "2 AS tokens", "3 AS verdict", "4 AS rule", "5 AS anchor")


def parts(url):
    rest = url.partition("://")[2] if url else ""
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match("[^?#]*", rest[len(host) :])[0]


def tokens(url):
    host, path = parts(url)
    if not host:
        return []
    shape = lambda s: re.sub("[0-9]+", "#", s)
    labels, segments = host.split("."), [s for s in path.translate(LOWER).split("/") if s]
    rest = url.partition("://")[2].translate(LOWER)
    out = ["scheme=" + url.partition("://")[0].translate(LOWER)]
    if len(labels) > 1:
        out += [f"tld={labels[-1]}", f"site={'.'.join(labels[-2:])}"]
    if len(labels) > 2:
        out.append(f"sub={shape(labels[0])}")
    if segments:
        out.append(f"dir={shape(segments[0])}")
        if len(segments) > 1:
            out.append("page=" + shape(re.sub(r"\.[^.]*$", "", segments[-1])))
        ext = re.search(r"[^.]\.([a-z0-9]+)$", segments[-1])
        if ext:
            out.append("ext=" + shape(ext[1]))
    query = rest.partition("#")[0].partition("?")[2]
    keys = sorted({shape(p.partition("=")[0]) for p in query.split("&") if p})
    if keys:
        out.append("query=" + "&".join(keys))
    return [*out, "fragment=yes"] if "#" in rest else out


def given(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), r.verdict == BLOCK), default=None)


def brute(rows, rules, support=LEAST_SUPPORT, confidence=LEAST_CONFIDENCE):
    judged = [(i, url, given(url, rules)) for i, url in rows]
    decided = [(tokens(url), r.verdict) for _, url, r in judged if r]
    least = math.ceil(support * len(decided))
    held, implied = Counter(), Counter()
    for t, verdict in decided:
        for size in range(1, len(t) + 1):
            for needed in combinations(sorted(t), size):
                held[needed] += 1
                implied[needed, verdict] += 1
    mined = {
        (needed, v): (n / held[needed], n) for (needed, v), n in implied.items() if n >= least and n / held[needed] >= confidence
    }
    out = []
    for i, url, rule in judged:
        host, path = parts(url)
        if rule:
            out.append((i, host, path, rule.text, rule.verdict, None))
            continue
        own = set(tokens(url))
        fits = [
            (-c, -n, len(needed), " ".join(needed), v != BLOCK, v)
            for (needed, v), (c, n) in mined.items()
            if own.issuperset(needed)
        ]
        best = min(fits, default=None)
        out.append((i, host, path, None, best[5] if best else ALLOW, best[3] if best else None))
    return Counter(out)


def answers(made):
    return Counter(tuple(r) for r in made.select("page_id", "host", "path", "rule", "verdict", "mined").collect())


def test_odd_urls(spark):
    made = frame(spark, ODD_URLS)
    found = judge_urls(made, URL_RULES)
    assert answers(found) == brute(ODD_URLS, URL_RULES)
    by_id = {r.page_id: r for r in found.collect()}
    assert by_id[1].host == "" and by_id[1].path == "" and by_id[1].verdict == ALLOW
    assert by_id[6].rule == "www.example.com/en/" and by_id[7].rule is None and by_id[9].rule == "com/"
    assert by_id[10].rule == "net/es/" and by_id[11].rule == "net/fr/" and by_id[12].rule is None
    assert judge_urls(made.where("false"), URL_RULES).count() == 0
    assert answers(judge_urls(made, [])) == brute(ODD_URLS, [])


def test_tokens(spark):
    from cambio.llm.url_rules import host_of, path_of

    url = F.col("url")
    made = frame(spark, ODD_URLS).select("url", url_tokens(url, host_of(url), path_of(url)).alias("t"))
    for r in made.collect():
        assert r.t == tokens(r.url) and len(r.t) <= 9


def test_mined_rules(spark):
    """Spam pages of decided hosts give undecided ones away; ties, rare combinations and mixed ones do not."""
    rules = [UrlRule(BLOCK, "bad.com", "/"), UrlRule(ALLOW, "good.com", "/"), UrlRule(ALLOW, "bad.com", "/about/")]
    rows = [(i, f"http://s{i}.bad.com/spam/{i}?ref=x") for i in range(300)]
    rows += [(1000 + i, f"https://s{i}.good.com/news/{i}") for i in range(300)]
    rows += [(2000 + i, f"https://s{i}.good.com/spam/{i}#top") for i in range(30)]
    rows += [(2500 + i, f"https://bad.com/about/{i}") for i in range(3)]  # too rare to teach anything
    rows += [(3000, "http://elsewhere.org/spam/1?ref=x"), (3001, "https://elsewhere.org/news/9"), (3002, "ftp://elsewhere.org")]
    rows += [(3003, "https://elsewhere.org/about/1.php"), (None, "http://elsewhere.org/spam/1?ref=x"), (3004, None)]
    rows += [(4000 + i, "http://hot.org/spam/1?ref=x") for i in range(200)]
    found = judge_urls(frame(spark, rows), rules)
    assert answers(found) == brute(rows, rules)
    verdicts = {r.page_id: r.verdict for r in found.collect()}
    assert verdicts[3000] == verdicts[None] == verdicts[4007] == BLOCK and verdicts[3001] == ALLOW == verdicts[3004]


def test_longest_rule_wins_and_blocking_goes_first(spark):
    rules = [UrlRule(ALLOW, "a.com", "/x"), UrlRule(BLOCK, "com", "/x/yz"), UrlRule(BLOCK, "com", "/xyz"), UrlRule(ALLOW, "com", "/")]
    rows = [(1, "http://a.com/xyz"), (2, "http://a.com/x/yz"), (3, "http://b.com/x"), (4, "http://a.com/x")]
    assert answers(judge_urls(frame(spark, rows), rules)) == brute(rows, rules)


def test_native(spark, tmp_path):
    """No Python in the plan of the answer, nor in what is mined and looked up on the way."""
    from cambio.llm import url_rules

    plans = []
    real = url_rules.written

    def watched(made, purpose):
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return real(made, purpose)

    url_rules.written = watched
    try:
        answer = judge_urls(frame(spark, ODD_URLS), URL_RULES)
    finally:
        url_rules.written = real
    plans.append(answer._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 5 and not any(re.search("Python|Arrow|Pandas", plan) for plan in plans)


@pytest.mark.parametrize("verdict", [BLOCK, ALLOW])
def test_one_verdict_only(spark, verdict):
    rows = [(i, f"http://a{i}.com/en/{i}") for i in range(20)] + [(99, "http://x.org/en/4")]
    rules = [UrlRule(verdict, "com", "/")]
    assert answers(judge_urls(frame(spark, rows), rules)) == brute(rows, rules)
