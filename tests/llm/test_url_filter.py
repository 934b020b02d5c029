import re

import pytest
from conftest import SMALL

from tallyfold.llm import queries
from tallyfold.llm import url_filter as u

LOWER = {c: c + 32 for c in range(65, 91)}
DATA = "/root/testdata/sf0.1"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in u.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


@pytest.mark.parametrize("folder", [SMALL, DATA])
def test_query_against_brute_force(spark, folder):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = queries.op9(spark, folder).collect()
    assert sorted(r["page_id"] for r in found) == sorted(urls)
    for r in found:
        host, path = parts(urls[r["page_id"]])
        name, verdict = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert r["verdict"] == (verdict or ("block" if r["bad_probability"] >= 0.5 else "allow"))


def test_trees_reach_hosts_that_the_list_does_not_name(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    known = u.seed_labels(pages.filter("url not like '%casino%' and url not like '%farm%'"))
    judged = u.judged(pages, u.train(known)).select("url", "bad").collect()
    bad = [r["bad"] >= 0.5 for r in judged if "casino" in r["url"] or "farm" in r["url"]]
    good = [r["bad"] >= 0.5 for r in judged if "-" not in parts(r["url"])[0]]
    assert len(bad) > 20 and sum(bad) >= 0.9 * len(bad) and sum(good) <= 0.02 * len(good)


def test_odd_rows(rows):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.Org/ES/x?y#z", "http://x://y/z", "x://ÄB.example.ORG/es/",
            "http://example.org/en/1", "http://notexample.org/es/", "http://a.com#/de/", "http://a.com/de/", "u://h/" + "a/%20" * 20000]
    df = rows("page_id long, url string, host int, path int, rule int, bad int, suffix int, numbers int",
              *[(i, url, 1, 1, 1, 1, 1, 1) for i, url in enumerate(urls)], (None, urls[5], 1, 1, 1, 1, 1, 1))
    model = u.train(rows("url string, bad int", ("http://a-b.org/1", 1), ("http://c.org/2", 0), (None, 1), ("x", None)))
    for trained in (model, u.train(rows("url string, bad int", ("http://c.org/2", 0))), u.Model(None, {}, 0.0)):
        found = u.judged(df.select("page_id", "url"), trained).collect()
        assert len(found) == len(urls) + 1
        for r in found:
            assert (r["host"], r["path"]) == parts(r["url"]) and r["rule"] == rule(*parts(r["url"]))[0]
            assert r["verdict"] in ("allow", "block")
    assert u.judged(df.select("page_id", "url").limit(0), model).count() == 0
