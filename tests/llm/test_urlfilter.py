import re

import pytest

from strandweave.llm import queries, urlfilter
from tests.oracle import assert_same

URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.ORG/en/1", "http://example.org/en/12", "http://example.org/en/2", "http://a.b.example.org/es/x?y#z",
    "http://notexample.org/es/x", "https://shop.com/de/1", "https://shop.com/fr/", "https://shop.com/fr", "https://SHOP.COM/FR/1", "http://x.org", "http://x.org?a=://b/c",
    "http://x.org:80/es/", "http://user@example.org/es/", "http://a.net/Casino/", "http://a.net/casinos", "http://a.net/f.exe?x", "http://a.net/x?PHPSESSID=1",
    "http://a.com/de/casino", "http://a.net/cart/checkout/", "ftp://x.net/wp-login.php", "see casino ", "/casino/", "http://é.org/fr/\n/es/", "http://a.net/#/casino/",
]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for v, h, p in urlfilter.SITE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    low = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    blocked = any(re.search(p, low) for _, p in urlfilter.GENERAL_RULES)
    rule, verdict = max(fits, key=lambda f: len(f[0])) if fits else (None, "block" if blocked else "allow")
    return host, path, rule, verdict


def test_query(spark, small):
    assert_same(queries.op5_url_filter(spark, small), urlfilter.ORACLE_SQL, small)


def test_odd_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string, verdict string")
    # By the constant index, and by the join.
    for how in ({}, {"most_rows": 3}):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, ["page_id"], **how).collect()}
        assert got == {i: brute(u) for i, u in enumerate(URLS + URLS)}
    assert urlfilter.judge(pages.limit(0), ["page_id"]).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, ["page_id"], rules=urlfilter.rules_frame(spark, [])).collect()} == {"allow"}


def test_plan_is_native_and_has_no_exchange(spark, small):
    plan = urlfilter.judge(spark.read.parquet(f"{small}/pages.parquet"), ["page_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange|Join", plan)


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = [urlfilter.Rule(("common", "rare"), "x", "block", "a", False), urlfilter.Rule(("common", "never"), "x", "block", "b", False), urlfilter.Rule(("rare", "alike"), "x", "block", "c", False)]
    pages = spark.createDataFrame([(f"http://common.net/{'rare' if i == 0 else 'x'}/alike" if i < 5 else "http://common.net/",) for i in range(9)], "url string")
    filed = {r.label: r.token for r in urlfilter.file_rules(pages, urlfilter.rules_frame(spark, rules)).collect()}
    assert filed == {"a": "rare", "b": "never", "c": "rare"}
    with pytest.raises(ValueError, match="literal"):
        urlfilter.judge(pages, ["url"], rules=urlfilter.rules_frame(spark, [urlfilter.Rule((), "x", "block", "x", False)]))


def test_ten_thousand_rules(spark, tmp_path):
    words = [f"w{i:05d}" for i in range(10_000)]
    (tmp_path / "rules.txt").write_text("".join(f"block\tNet,{w}\t[./]{w}([/?]|$)\n" for w in words) + "no rule\n")
    rules = urlfilter.read_rules(spark, str(tmp_path / "rules.txt")).unionByName(urlfilter.rules_frame(spark, [urlfilter.site_rule(*r) for r in urlfilter.SITE_RULES]))
    assert rules.count() == 10_005
    urls = [f"http://a.net/{words[i * 37 % 10_000]}{'/x' if i % 2 else 'x'}" for i in range(400)] + ["http://b.org/w00001/", "http://w00007.com/de/", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    want = {i: "block" if i < 400 and i % 2 else "allow" for i in range(403)} | {401: "block"}
    for how in ({}, {"most_bytes": 1000}):
        assert {r.page_id: r.verdict for r in urlfilter.judge(pages, ["page_id"], rules=rules, **how).collect()} == want
