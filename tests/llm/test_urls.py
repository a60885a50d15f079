import math
import re

from pitchhouse.llm import urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def ruled(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://A.example.ORG/en/12?q#f", "https://example.org/es/x", "http://notexample.org/es/", "http://x.com/fr/a",
        "http://x.com/de/a", "http://x.com/", "http://x.com/en", None, "", "no scheme", "http://", "http://y.co.uk/a#b",
        "http://z.y.co.uk?x=http://org/", "http://org/", "http://org", "http://com/fr/", "ftp://[::1]/x", "http://z.net/a b"]


def judge(spark, pages, labels):
    p = spark.createDataFrame(pages, "page_id long, url string, html string, y int")
    q = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return urls.judged(p, q).collect()


def test_host_path_and_rules_against_brute_force(spark):
    got = judge(spark, [(i, u, None, 0) for i, u in enumerate(URLS)], [(0, 1, 0), (5, 0, 0), (6, 1, 1), (11, 1, None)])
    assert len(got) == len(URLS)
    for r in got:
        host, path = cut(URLS[r.page_id])
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_hosts_shrink_to_their_domain_and_the_bound_decides(spark):
    pages, labels = [], []
    for host, good, bad in (("a.good.net", 40, 0), ("b.good.net", 38, 2), ("new.good.net", 1, 0),
                            ("a.bad.net", 0, 40), ("b.bad.net", 1, 39), ("new.bad.net", 1, 0)):
        for y in [1] * good + [0] * bad:
            labels.append((len(pages), y, 0))
            pages.append((len(pages), f"http://{host}/{len(pages)}", "", 0))
    found = {r.host: r for r in judge(spark, pages, labels)}
    assert found["a.good.net"].verdict == "allow" and found["a.bad.net"].verdict == "block"
    # one good page each: the domain's history tells them apart
    assert found["new.good.net"].host_mean > found["new.bad.net"].host_mean
    assert all(r.host_bound < r.host_mean and not math.isnan(r.host_mean) for r in found.values())


def test_empty_tables_and_no_labels(spark):
    assert judge(spark, [], []) == []
    rows = judge(spark, [(1, "http://a.net/", None, 1), (1, "http://a.net/", None, 1), (None, None, None, None)], [(None, None, None)])
    assert len(rows) == 3 and {r.host_mean for r in rows} == {0.5}


def test_no_python_in_the_plan(spark):
    p = spark.createDataFrame([(1, "http://a.net/", "")], "page_id long, url string, html string")
    q = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = urls.judged(p, q)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
