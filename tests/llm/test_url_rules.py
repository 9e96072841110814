"""URL rules against plain Python, on awkward urls."""

import random
import re

import pytest

from docloom.llm import url_rules
from docloom.llm.common import LOWER, UPPER

LOW = str.maketrans(UPPER, LOWER)
RULES = url_rules.production_rules() + [("block", 1, "||a.b^"), ("allow", 1, "||a.b^"), ("block", 1, "||a.b/x*/y|"), ("block", 2, "*"), ("block", 1, "||[odd](x)\\.net/")]


def cut(url):
    if url is None or "://" not in url:
        return "", "", ""
    after = url.split("://", 1)[1]
    host = re.match("[^/?#]*", after)[0]
    rest = after[len(host):]
    return host.translate(LOW), re.match("[^?#]*", rest)[0], host.translate(LOW) + rest


def fits(pattern, line):
    host = re.match("[^/?#]*", line)[0]
    body = pattern.removeprefix("||")
    end = body.endswith("|")
    out = "".join({"*": "(?s:.*)", "^": r"(?:[^A-Za-z0-9_.%-]|\Z)"}.get(c) or re.escape(c) for c in body.removesuffix("|")) + (r"\Z" if end else "")
    if pattern.startswith("||"):
        labels = [0] + [i + 1 for i, c in enumerate(host) if c == "."]
        return any(re.match(out, line[i:]) for i in labels)
    return re.search(out, line) is not None


def plain(url, rules):
    host, path, line = cut(url)
    if url is None or "://" not in url:
        return host, path, None, None, None
    found = sorted((t, -len(p), a != "block", p, a) for a, t, p in rules if fits(p, line))
    return (host, path) + ((found[0][0], found[0][3], found[0][4]) if found else (None, None, None))


def urls():
    rng = random.Random(5)
    hosts = ["org", "Example.ORG", "www.example.org", "notexample.org", "x.com", "a.b", "A.a.B", "ads-track.example.com", "docs.my.net",
             "example.org:80", "[odd](x)\\.net", "", "ünï.org", "com", "tracker.com"]
    paths = ["", "/", "/es/1", "/ES/1", "/en/1", "/en/2", "/en/12", "/fr/", "/fr", "/de/x?y=/fr/", "?es/", "#/es/", "/login", "/loginx", "/login/", "/a.zip", "/a.zip?x",
             "/x1/y", "/x/\n/y", "/y", "/tag/a/page/2", "/en?sessionid=3", "/VIAGRA", "/viagra", "/x" * 4000]
    out = [f"{s}://{h}{p}" for h in hosts for p in paths for s in ("http",)] + [None, "", "no scheme", "http:/x.org/", "://", "://org/", "a://b://com/de/"]
    rng.shuffle(out)
    return out + ["http://example.org/es/1"] * 300


def test_judge_against_plain_python(spark):
    rows = [(i if i % 7 else None, u, "x", "y", "z") for i, u in enumerate(urls())]
    table = spark.createDataFrame(rows, "page_id long, url string, rule_host string, token string, line string").repartition(3)
    rules = url_rules.rule_table(spark, RULES)
    out = url_rules.judge(table, rules)
    assert out.columns == ["page_id", "url", "token", "line", *url_rules.ADDED]
    got = out.collect()
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted([(r[0], r[1], *r[4:]) for r in got], key=key) == sorted([(r[0], r[1], *plain(r[1], RULES)) for r in rows], key=key)
    assert url_rules.judge(table.limit(0), rules).count() == 0
    assert [r.rule_action for r in url_rules.judge(table, rules.limit(0)).select("rule_action").distinct().collect()] == [None]


def test_rules_are_indexed_by_their_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://h{i}.example.org/en/{i}",) for i in range(20)] + [("http://x.example.org/es/1",)], "url string")
    lines = urls.select("url", url_rules.parts(urls["url"])[2].alias("line"))
    rules = url_rules.rule_table(spark, [("block", 0, "||example.org/es/"), ("block", 0, "||example.org/en/1"), ("allow", 0, "||org/"), ("block", 1, "spam")])
    index = {r.pattern: (r.token, r.n_urls) for r in url_rules.rarest_tokens(lines, rules).collect()}
    assert index == {"||example.org/es/": ("es", 1), "||example.org/en/1": ("en", 20), "||org/": ("org", 21)}
    assert url_rules.tokens("||example.org/en/1") == ["en", "example", "org"] and url_rules.tokens("spam") == []
    assert url_rules.tokens("/a*b.zip|") == ["zip"] and url_rules.tokens("*ab/cd^ef*") == ["cd"]


def test_too_many_rules_without_a_token(spark):
    urls = spark.createDataFrame([("http://a.b/",)], "url string")
    loose = [("block", 1, f"x{i}y") for i in range(url_rules.LOOSE + 1)]
    with pytest.raises(ValueError):
        url_rules.judge(urls, url_rules.rule_table(spark, loose))
