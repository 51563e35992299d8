import random
import re

from pyspark.sql import functions as F

from loadkit.llm import url_filter
from loadkit.llm.queries import RULES


def plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m.group(1)) if m else ""
    path = m.group(2) if m else ""
    fits = []
    for verdict, rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    None, "", "no scheme", "http://", "http:///p", "HTTP://Example.ORG/es/x", "https://a.example.org/en/123?x#y", "https://example.org/en/2", "x://y://z/q", "http://com/fr/", "http://a.com/de/b",
    "http://a.com/DE/b", "http://ÀB.com/fr/é", "http://notexample.org.net/es/", "http://a.net#f", "http://a.net?q=1", "http://casino-win.example.net/a/?utm_source=x&b=2&a=1&ref=z#t", "http://www.casino-win.example.net/a?a=1&b=2",
    "http://m.casino-win.example.net/other", "http://x.org", "http://x.org/", "a://org/\nb", "http://" + "a" * 50_000 + "/b",
]


def frame_of(spark, urls):
    return spark.createDataFrame([(i, u, "h", 3) for i, u in enumerate(urls)], "page_id long, url string, host string, block int")


def test_like_plain_rules(spark):
    listed = spark.createDataFrame([("casino-win.example.net/a?a=1&b=2",), (None,), ("casino-win.example.net/a?a=1&b=2",)], "u string")
    rows = {r.page_id: r for r in url_filter.judge(frame_of(spark, URLS), listed, RULES).collect()}
    assert len(rows) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain(u)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), u
        assert rows[i].listed == (i in (16, 17))
        assert rows[i].verdict == (verdict or ("block" if i in (16, 17) else "allow"))


def test_list_is_exact(spark):
    """A filter far too small lets many through; the join removes them all."""
    source = random.Random(3)
    urls = [f"http://h{source.randint(0, 99)}.net/{source.randint(0, 99)}" for _ in range(2000)]
    frame = frame_of(spark, urls)
    some = frame.filter("page_id % 3 = 0").select(url_filter.canonical(F.col("url")))
    known = {r[0] for r in some.collect()}
    assert {r.page_id for r in url_filter.judge(frame, some, []).collect() if r.listed} == {i for i, u in enumerate(urls) if u[7:] in known}


def test_false_positives_are_removed(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)
    frame = frame_of(spark, [f"http://a.net/{i}" for i in range(3000)])
    listed = frame.filter("page_id < 1000").select(url_filter.canonical(F.col("url")))
    assert {r.page_id for r in url_filter.judge(frame, listed, []).collect() if r.verdict == "block"} == set(range(1000))


def test_odd_rows(spark):
    frame = spark.createDataFrame([(None, "http://a.net/x", 1), (None, "http://a.net/x", 1), (4, None, 1)], "page_id long, url string, listed int")
    nothing = spark.createDataFrame([], "u string")
    assert sorted((r.page_id or 0, r.verdict) for r in url_filter.judge(frame, nothing, RULES).collect()) == [(0, "allow"), (0, "allow"), (4, "allow")]
    assert url_filter.judge(frame.limit(0), nothing, RULES).count() == 0


def test_canonical(spark):
    want = {"http://www.A.net/x/?b=2&utm_source=q&a=1#f": "a.net/x?a=1&b=2", "http://a.net": "a.net", "http://a.net/": "a.net", "http://m.a.net//?ref=1": "a.net", "none": None}
    frame = spark.createDataFrame([(u,) for u in want], "url string")
    assert {r.url: r.c for r in frame.select("url", url_filter.canonical(F.col("url")).alias("c")).collect()} == want
