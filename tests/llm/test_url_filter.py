import numpy as np
import pytest
from tokenloom.llm import url_filter as U

URLS = [(1, "http://a.example.net/en/x?q"), (2, "https://EXAMPLE.net/en"), (3, "http://b.net/"), (4, "ftp://net"),
        (5, None), (6, "no scheme/de/"), (7, "http://x.org/fr/1#t"), (8, "http://xorg/fr/1"),
        (9, "x://example.com/de/9"), (10, "http://notexample.com/de/9"), (10, "http://notexample.com/de/9"),
        (None, "http://www.example.com/de/"), (11, ""), (12, "http://Ä.B.org?/fr/"), (13, "http://h\n.net/a\nb")]


def expected(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [h + p for h, p, _ in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "mine", 1.0) for i, u in URLS],
                                 "page_id long, url string, verdict string, block_score double")


def test_parts_and_rules(pages):
    for r in U.with_rules(pages).collect():
        assert (r.host, r.path, r.rule) == expected(r.url)


def test_rules_come_before_the_model(pages):
    verdict = dict((h + p, v) for h, p, v in U.RULES)
    for bias, other in ((5.0, "block"), (-5.0, "allow")):
        model = U.UrlModel(np.zeros(U.BUCKETS), bias)
        got = U.filter_urls(pages, model).collect()
        assert len(got) == len(URLS)
        for r in got:
            assert r.verdict == (verdict[r.rule] if r.rule else other)


def test_model_learns_host_and_path(spark):
    hosts = [f"{w}.good.org" for w in "abcdefghij"] * 8 + [f"{w}.casino.biz" for w in "abcdefghij"] * 8
    paths = [f"/news/{i}" for i in range(80)] + [f"/win-cash/{i}" for i in range(80)]
    model = U.fit_urls(hosts, paths, np.repeat([0, 1], 80))
    p = model.block_probability(["z.good.org", "z.casino.biz", ""], ["/news/999", "/win-cash/999", ""])
    assert p[0] < 0.5 < p[1]
    assert p[2] == pytest.approx(1 / (1 + np.exp(-model.bias)))


def test_tables_without_labels(spark, pages):
    none = pages.limit(0)
    assert U.filter_urls(none, U.fit_url_model(U.with_rules(none).withColumn("verdict", U.F.col("rule_verdict")))).count() == 0
    assert U.fit_urls([], [], np.zeros(0)).block_probability(["a"], ["/"])[0] == 0.5
    one = U.fit_urls(["a"], ["/"], np.ones(1)).block_probability(["b"], ["/"])[0]
    assert one > 0.9
