import pytest
from pyspark.sql import functions as F

from covstar.llm import url_filter as U
from covstar.llm.queries import URL_RULES

URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=1", "http://example.org/en/2#t", "ftp://x.com/fr/", "http://x.com/de/9",
        "http://com/de/", "http://xcom/de/", "http://x.com", "http://org", "nonsense", "", None, "://", "http://a.org?q=/es/", "http://A.B.Example.ORG/es/",
        "http://notexample.org/es/", "http://x.com/de", "http://" + "a." * 3000 + "com/fr/x", "http://ÄÖ.org/é", "http://x.org/" + "y" * 20000, "a://b://c.org/"]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


@pytest.mark.parametrize("rules", [URL_RULES, URL_RULES + [("x.com", "/", "block"), ("com", "/de/9", "allow"), ("com", "/de/", "block")], []])
@pytest.mark.parametrize("broadcast", [U.BROADCAST_BYTES, 0])
def test_against_plain(spark, monkeypatch, rules, broadcast):
    monkeypatch.setattr(U, "BROADCAST_BYTES", broadcast)
    pages = [(i, u, "clash") for i, u in enumerate(URLS)] + [(None, URLS[0], None), (3, URLS[3], "clash")]
    df = spark.createDataFrame(pages, "page_id long, url string, host string")
    got = U.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    key = lambda t: tuple(str(x) for x in t)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(((i, *plain(u, rules)) for i, u, _ in pages), key=key)


def test_filter_passes_all_listed_and_few_others(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom, n = U.build_filter(keys, "key", 2000)
    others = spark.range(2000, 22000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert U.probe(keys, "key", bloom, n).count() == 2000
    assert U.probe(others, "key", bloom, n).count() < 400


def test_empty_pages(spark):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
