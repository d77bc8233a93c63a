import hashlib
import math
import re
from collections import Counter
from urllib.parse import urlsplit

import pytest

from posttags.llm import url_filter
from posttags.llm.queries import URL_RULES
from tests.llm.conftest import as_dict

ODD = [
    None, "", "no scheme", "http://", "HTTP://A.Org", "http://A.ORG/", "https://example.org/es/x?y=/z",
    "https://sub.example.org/en/1", "https://sub.example.org/en/12#top", "ftp://notexample.org/en/1",
    "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/fr", "http://x.com?/fr/", "http://é.net/ü",
    "http://x.community/fr/1", "a://b://c.org/d", "http://user@h.net:80/p", "x" * 5000,
]


def pages(spark, urls):
    rows = [(i, url, "<p>", "x", "y") for i, url in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, code string")


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = rest[len(host) :]
    path = re.match(r"[^?#]*", path)[0] if path.startswith("/") else ""
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


def folded(url):
    url = re.sub(r"^[a-z]*://", "", "".join(c.lower() if c.isascii() else c for c in url or ""))
    sign = lambda c: c if c in "abcdefghijklmnopqrstuvwxyz/.-" else "0" if c in "0123456789" else "?" if c in "?=&_#" else "~"
    return "^^^" + "".join(map(sign, url))


def model(urls):
    counts = Counter()
    for url in urls:
        text = folded(url)
        for at in range(3, len(text)):
            for size in range(4):
                counts[text[at - size : at], text[at]] += 1
                counts[text[at - size : at]] += 1

    def chance(context, symbol):
        p = 1 / 33
        for size in range(4):
            c = context[len(context) - size :]
            p = (counts[c, symbol] + 4 * p) / (counts[c] + 4)
        return p

    return chance


@pytest.fixture(scope="module")
def judged(spark):
    urls = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url")
    urls = [r.url for r in urls.collect()] + ODD + ODD[:6]
    return urls, as_dict(url_filter.judge(pages(spark, urls), URL_RULES), "page_id")


def test_hosts_paths_and_rules(judged):
    urls, got = judged
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = split(url)
        rule = rule_of(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule.text)
        if rule:
            assert got[i].verdict == ("allow" if rule.allow else "block")


def test_scores_equal_a_plain_model(judged):
    urls, got = judged
    held = {i for i, u in enumerate(urls) if u is not None and int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % 5 == 0}
    labels = {i: r.allow for i, u in enumerate(urls) if (r := rule_of(*split(u)))}
    good = model([urls[i] for i, a in labels.items() if a and i not in held])
    bad = model([urls[i] for i, a in labels.items() if not a and i not in held])
    for i, url in enumerate(urls):
        text = folded(url)
        steps = [math.log(good(text[at - 3 : at], text[at]) / bad(text[at - 3 : at], text[at])) for at in range(3, len(text))]
        assert got[i].score == pytest.approx(sum(steps) / len(steps) if steps else 0, abs=1e-7)
        if got[i].rule is None:
            assert got[i].verdict == ("allow" if got[i].score >= got[i].threshold else "block")


def test_models_tell_held_out_urls_apart(spark):
    """Block news hosts, allow shops: unseen URLs of either kind follow."""
    urls = [f"http://shop{i % 40}.net/buy/item-{i}" for i in range(300)]
    urls += [f"http://casino{i % 40}.info/win?bonus={i}" for i in range(300)]
    rules = [url_filter.Rule(f"shop{i}.net", "/", True) for i in range(30)]
    rules += [url_filter.Rule(f"casino{i}.info", "/", False) for i in range(30)]
    got = url_filter.judge(pages(spark, urls), rules).collect()
    free = [r for r in got if r.rule is None]
    assert len(free) > 100
    assert all((r.verdict == "allow") == r.host.startswith("shop") for r in free)


def test_without_labels_and_without_rows(spark):
    got = url_filter.judge(pages(spark, ["http://a.net/b", None]), URL_RULES).collect()
    assert [(r.verdict, r.score) for r in got] == [("allow", 0.0)] * 2
    assert url_filter.judge(pages(spark, []), URL_RULES).collect() == []


def test_longest_rule_wins(spark):
    rules = [url_filter.Rule("net", "/a", True), url_filter.Rule("x.net", "/", False), url_filter.Rule("net", "/a/bcd", False)]
    got = url_filter.judge(pages(spark, ["h://x.net/a", "h://y.net/a/bcde", "h://y.net/ab"]), rules)
    assert {r.page_id: r.rule for r in got.collect()} == {0: "x.net/", 1: "net/a/bcd", 2: "net/a"}
    assert urlsplit("h://x.net/a").path == "/a"
