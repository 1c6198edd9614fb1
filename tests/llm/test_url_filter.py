import re

from tierworks.llm import url_filter as U
from tierworks.llm.queries import DOMAIN_RULES, inline_rows

URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://Shop.EXAMPLE.net/en/x", "http://example.net/fr/", "http://badexample.net?x",
    "https://m.example.com/de/1", "https://example.com/den", "http://x.org/fr/2", "http://x.org/wp-login.php", "http://x.org/wp-login.phpx", "http://x.org/a?sessionid=3",
    "http://casino.x.org/", "http://x.org/casino/history/", "http://x.org/casinos/", "http://x.org/adserver/7/click", "http://x.org/adserverclick", "http://x.org/calendar?date=1",
    "http://x.org/\nporn", "http://a:8080/cart/checkout", "x://y/z://net/", "http://ünet.net/é",
]


def brute(url, rules, patterns):
    found = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    verdicts = {v for v, p in patterns if url is not None and re.search(as_regex(p), url.lower())}
    other = "block" if "block" in verdicts and "allow" not in verdicts else "allow"
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else other


def as_regex(pattern):
    body = "".join({"*": ".*", "^": "(?:[^a-z0-9]|^|$)"}.get(c, re.escape(c)) for c in pattern.strip("|").lower())
    return "(?s)" + "^" * pattern.startswith("|") + body + "$" * pattern.endswith("|")


def test_against_brute_force(spark):
    patterns = [*U.PATTERN_RULES, ("block", "|x://"), ("block", "*zz*"), ("block", ".net|"), ("allow", "a+b(c)")]
    urls = URLS * 2 + ["http://q.org/azzb", "http://h.org/.net", "http://p.org/a+b(c)casino/"]
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    domains = inline_rows(spark, DOMAIN_RULES, ("host", "path", "verdict"))
    rules = inline_rows(spark, [(k, *p) for k, p in enumerate(patterns)], ("rule_id", "verdict", "pattern"))
    rows = U.filter_urls(pages, domains, rules).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], DOMAIN_RULES, patterns)


def test_index_takes_the_rarest_usable_token(spark):
    urls = spark.createDataFrame([("http://a/b/c",), ("http://b/c",), ("http://c",)], "url string")
    rules = spark.createDataFrame([(1, "block", "/a/b/c"), (2, "block", "^b^c^"), (3, "block", "*c*"), (4, "block", "^new^c^")], "rule_id long, verdict string, pattern string")
    assert {r.rule_id: r.token for r in U.rule_index(urls, rules).collect()} == {1: "a", 2: "b", 3: None, 4: "new"}


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    domains = spark.createDataFrame([], "host string, path string, verdict string")
    rules = spark.createDataFrame([], "rule_id long, verdict string, pattern string")
    assert [(r.rule, r.verdict) for r in U.filter_urls(pages, domains, rules).collect()] == [(None, "allow")]
    assert U.filter_urls(pages.limit(0), domains, rules).count() == 0


def test_runs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    domains = inline_rows(spark, DOMAIN_RULES, ("host", "path", "verdict"))
    rules = inline_rows(spark, [(k, *p) for k, p in enumerate(U.PATTERN_RULES)], ("rule_id", "verdict", "pattern"))
    plan = U.filter_urls(pages, domains, rules)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
