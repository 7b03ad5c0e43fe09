import random
import re

import pytest

from reelmeter.llm import url_rules
from reelmeter.llm.queries import URL_RULES
from reelmeter.llm.url_rules import Rule, filter_urls, rule_table

URLS = [
    "http://example.org/en/1", "https://EXAMPLE.org/en/12?x=1", "http://a.b.example.org/es/", "http://badexample.org/es/",
    "http://example.org", "http://example.org/", "http://example.org?x=/es/", "http://example.org#/es/", "http://example.com/de/1",
    "http://example.com/fr/1", "http://com/de/", "ftp://x.COM/fr/a://b.org/", "no scheme.org/x", "://org/", "", None,
    "http://example.org:80/en/1", "http://user@example.org/en/1", "http://example.org./en/1", "http://.org/x", "http:///org/",
    "http://EXÄMPLE.org/É", "http://a\nb.org/c\nd?e", "http://org/" + "x" * 100_000, "http://" + "a." * 20_000 + "org/",
]


def plain(url, rules, default="allow"):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[2], m[3]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for r in rules:
        want = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.host)
        if (host == want or host.endswith("." + want)) and path.startswith(r.path):
            fits.append((len(want + r.path), want.count("."), r.verdict, want + r.path))
    best = max(fits, default=None)
    return (host, path, best[3], best[2]) if best else (host, path, None, default)


def asked(spark, urls, rules, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = filter_urls(pages, rule_table(spark, list(rules)), **options).collect()
    assert sorted(r["page_id"] for r in found) == list(range(len(urls)))
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}


def test_against_plain(spark):
    got = asked(spark, URLS, URL_RULES)
    assert got == {i: plain(u, URL_RULES) for i, u in enumerate(URLS)}
    assert got[0][2:] == got[1][2:] == ("example.org/en/1", "block")


def test_precedence_and_default(spark):
    rules = [
        Rule("a.b", "/cc", "allow"), Rule("b", "/cccc", "block"),  # equal lengths: more labels win
        Rule("C.d", "/", "block"), Rule("c.D", "/", "allow"),  # equal rules: block
        Rule("e", "", "allow"), Rule("x.e", "/p/", "block"), Rule("x.e", "/p/q", "allow"),
    ]
    urls = ["s://a.b/cccc", "s://c.d/x", "s://x.e/p/q/r", "s://x.e/p/r", "s://e", "s://nothing/"]
    got = asked(spark, urls, rules, default="block")
    assert got == {i: plain(u, rules, "block") for i, u in enumerate(urls)}
    assert [got[i][3] for i in range(6)] == ["allow", "block", "allow", "block", "allow", "block"]


@pytest.mark.parametrize("dealt", [False, True])
def test_random_rules(spark, monkeypatch, dealt):
    """Both ways of the join; short digests of one digit, so that most meet others' rules."""
    rng = random.Random(1)
    monkeypatch.setattr(url_rules, "SHORT", 1)
    if dealt:
        asked_at = iter([True, False, True])  # shapes, then the rules, then those of hot prefixes
        monkeypatch.setattr(url_rules, "at_most", lambda *a: next(asked_at))
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice("/xy") for _ in range(rng.randint(0, 4)))
    rules = [Rule(host(), "/" + path(), rng.choice(["allow", "block"])) for _ in range(60)]
    urls = [f"http://{host()}/{path()}" for _ in range(300)] + ["http://a.b/x/"] * 100
    verdicts = {}
    for r in rules:
        verdicts[r.host, r.path] = max(r.verdict, verdicts.get((r.host, r.path), ""))
    rules = [Rule(h, p, v) for (h, p), v in verdicts.items()]
    assert asked(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_odd_tables(spark):
    rows = [(1, "http://a.org/", "x"), (1, "http://a.org/", "x"), (None, "http://a.org/", None), (1, "http://a.com/fr/", "y"), (2, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").selectExpr("*", "'z' AS path", "'z' AS rule", "'z' AS copies", "'z' AS short")
    rules = rule_table(spark, list(URL_RULES))
    found = sorted(str(tuple(r)) for r in filter_urls(pages, rules).collect())
    want = [(1, "a.org", "/", "org/", "allow")] * 2 + [(None, "a.org", "/", "org/", "allow"), (1, "a.com", "/fr/", "com/fr/", "allow"), (2, "", "", None, "allow")]
    assert found == sorted(map(str, want))
    assert filter_urls(pages.where("false"), rules).count() == 0
    assert {r["verdict"] for r in filter_urls(pages, rules.where("false")).collect()} == {"allow"}
    kept = filter_urls(pages, rules, keep=("page_id", "rule")).columns  # a kept column may be called as a result
    assert kept == ["page_id", "rule", "host", "path", "rule", "verdict"]


@pytest.mark.parametrize("bad", [("", "/", "allow"), (None, "/", "allow"), ("a/b", "/", "allow"), ("a", "/", "maybe"), ("a", "/", None)])
def test_bad_rules(spark, bad):
    with pytest.raises(Exception, match="a rule needs"):
        filter_urls(spark.createDataFrame([(1, "u")], "page_id long, url string"), spark.createDataFrame([bad], "host string, path string, verdict string"))
