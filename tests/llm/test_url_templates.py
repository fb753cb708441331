import re

from tillflow.llm import url_templates as op

FOLDER = "/root/testdata/sf0.001"


def brute(url):
    """host, path, rule and its verdict."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in op.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def test_all_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    urls = {r.page_id: r.url for r in pages.collect()}
    found = op.judge(pages, op.page_labels(pages, labels)).collect()
    assert len(found) == len(urls)
    for r in found:
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def make_pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_numbers_become_wildcards_and_bad_templates_are_blocked(spark):
    urls = [f"https://x.net/{kind}/{i}" for kind in ("news", "spam") for i in range(40)]
    urls += [f"https://x.net/about/{name}" for name in ("us", "team")]
    pages = make_pages(spark, urls)
    labels = spark.createDataFrame([(i, i >= 40) for i in range(0, 80, 2)], "page_id long, bad boolean")
    found = {r.page_id: r for r in op.judge(pages, labels).collect()}
    assert found[0].template == "/news/*" and found[41].template == "/spam/*"
    assert found[80].template == "/about/us"
    assert all(found[i].verdict == "allow" for i in range(40))
    assert all(found[i].verdict == "block" for i in range(40, 80))


def test_like_branches_are_merged(spark):
    urls = [f"https://x.net/{kind}/{i}" for kind in ("a", "b") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 4 == 0) for i in range(80)], "page_id long, bad boolean")
    found = op.judge(make_pages(spark, urls), labels).collect()
    assert len({round(r.purity, 9) for r in found}) == 1 and all(r.verdict == "allow" for r in found)


def test_odd_rows(spark, clash):
    urls = [None, "", "no scheme", "http://", "a://b://c/d", "HTTP://ExAmple.ORG/EN/1", "https://example.org/en/1?x#y",
            "https://notexample.org", "https://É.com/de/", "x://com/de/x", "https://a.com?q=/de/",
            "https://x.org/" + "a/" * 3000, "https://x.net/" + "z" * 50_000, "https://x.net//a///b"]
    pages = make_pages(spark, urls).unionByName(make_pages(spark, urls))
    found = op.judge(clash(pages), spark.createDataFrame([(None, True), (1, None)], "page_id long, bad boolean")).collect()
    assert len(found) == 2 * len(urls)
    for r in found:
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
    assert op.judge(pages.limit(0), spark.createDataFrame([], "page_id long, bad boolean")).collect() == []
