"""Url rules against plain Python: nested rules, odd urls, random rules and forced buckets."""

import random
import re

from cordon.llm import url_rules
from cordon.llm.queries import URL_RULES
from helpers import rows_of


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), h, p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda f: (f[0], len(f[1])))
    return host, path, best[1] + best[2], best[3]


def run(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "<html>", "mine") for i, u in urls], "page_id long, url string, html string, key string")
    got = url_rules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    want = sorted(((i, *brute(u, rules)) for i, u in urls), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows_of(got) == want


ODD = [None, "", "no scheme/en/", "http://", "http:///en/", "http://net", "http://net/", "https://a.NET/x?y#z", "https://net.a.org/fr/",
       "https://org/fr/x", "https://x.org/fr", "https://example.net/en/", "https://EXAMPLE.net/EN/", "https://b.example.net/en/x",
       "https://badexample.net/en/", "https://example.com/de/", "https://a.b.example.com/de/q", "http://a://net/en", "http://É.net/",
       "https://x.net?en/", "https://x.net#/", "http://a\nb.net/\n/x", "http://..net/", "http://net./", "x://y.net:80/"]


def test_contract_rules_on_odd_urls(spark):
    run(spark, [(i, u) for i, u in enumerate(ODD)] + [(None, ODD[7]), (None, ODD[7]), (3, ODD[8]), (3, ODD[8]), (None, None)],
        URL_RULES)


def test_random_nested_rules(spark):
    rng = random.Random(2)
    labels = ["a", "b", "ab", "net"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))

    def path():
        return "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 4)))

    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(60))}.values())
    hot = "http://a.b.net/xy/x"
    urls = [(i, hot if i % 3 == 0 else f"https://{host()}{path()}") for i in range(1500)]
    run(spark, urls, rules)


def test_empty_tables(spark):
    run(spark, [], URL_RULES)
    run(spark, [(1, "http://a.net/")], [])
