import re

import duckdb
import pytest
from pyspark.sql import functions as F

from climora.llm import url_filter as U
from climora.llm.queries import QUERIES
from compare import connect, difference

URLS = [
    "http://Www.Example.NET/en/x?q#f", "https://example.net/de/1", "http://net", "http://net/", "http://notexample.net.org/fr/1", "http://a.org/fr/",
    "http://a.org/fr", "http://EXAMPLE.com/de/?x", "http://b.example.com/de/page#y", "no scheme", "", None, "ftp://x://y/z", "http://", "://h/p",
    "http://h?x/y", "http://h#x/y", "HTTP://ÀB.Net/", "http://example.net/en", "http://a.b.c.d/e\nf?g", "http://fr.org/fr/fr/",
]
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def plain(url):
    """Host, path, rule by walking the url."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in RULES:
        name, slash, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(0, URLS[0]), (None, URLS[1])], "page_id long, url string").withColumn("unit", F.lit("own"))
    outcomes = spark.createDataFrame([("h", True)] * 30 + [("a.b.c.d", False)] * 30 + [("h", None)], "host string, bad boolean")
    rows = U.judge_urls(pages, outcomes).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[1] if r.page_id is None else URLS[r.page_id]
        host, path, rule = plain(url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (RULES[rule] if rule else "block" if host == "h" else "allow")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    query, sql = QUERIES["op4_url_filter"]
    rows, off = difference(query(spark, f"/root/testdata/{sf}"), connect(f"/root/testdata/{sf}"), sql)
    assert rows and not off


def test_few_pages_are_drawn_to_the_levels_above(spark):
    rows = [("one.bad.com", True)] * 2
    for k in range(40):
        rows += [(f"h{k}.bad.com", True)] * 9 + [(f"h{k}.bad.com", False)] + [(f"h{k}.good.com", False)] * 10
    rows += [("one.good.com", True)] * 2
    found = {r.unit: r for r in U.reputations(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    assert found["one.bad.com"].mean > 0.8 > 0.5 > found["one.good.com"].mean
    assert found["h1.bad.com"].low > 0.25 > found["h1.good.com"].low
    assert all(r.low <= r.mean for r in found.values())


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, bad boolean")
    assert [r.verdict for r in U.judge_urls(pages, none).collect()] == ["allow"]
    assert U.judge_urls(pages.limit(0), none).count() == 0


def test_hosts_without_labels_are_judged_by_the_level_above(spark):
    rows = []
    for k in range(40):
        rows += [(f"h{k}.bad.com", True)] * 10 + [(f"h{k}.good.com", False)] * 10 + [(f"h{k}.ill{k}.biz", True)] * 10 + [(f"h{k}.fine{k}.org", False)] * 10
    outcomes = spark.createDataFrame(rows + [("null.bad.com", None)], "host string, bad boolean")
    want = {"new.bad.com": "block", "null.bad.com": "block", "new.good.com": "allow", "h1.bad.com": "block", "new.other.biz": "block", "new.other.org": "allow"}
    pages = spark.createDataFrame([(h, f"http://{h}/") for h in want], "page_id string, url string")
    assert {r.page_id: r.verdict for r in U.judge_urls(pages, outcomes, rules=()).collect()} == want


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_reputation_blocks_some_hosts_and_spares_others(spark, sf):
    rows = QUERIES["op4_url_filter"][0](spark, f"/root/testdata/{sf}").where("rule IS NULL").select("host", "verdict").distinct().collect()
    blocked, spared = ({r.host for r in rows if r.verdict == v} for v in ("block", "allow"))
    assert blocked and all(re.search("casino|bets|pills|ads", h) for h in blocked)
    assert len(spared) > 2 * len(blocked) and not blocked & spared


def test_query_equals_its_sql_on_planted_hosts(spark, tmp_path):
    noisy = "word### " * 12
    rows = [(f"http://h{k % 7}.bad.org/{k}", noisy if k % 5 else "x") for k in range(200)]
    rows += [(f"http://h{k % 9}.good.org/{k}", noisy if k % 40 == 0 else "x") for k in range(200)]
    rows += [(f"http://w{k}.casino-{k % 3}.biz/", "x") for k in range(40)] + [(f"http://one{k}.fine{k}.info/", "x") for k in range(40)]
    # Hosts whose pages have no text: known by their domain, their suffix, or by nothing.
    rows += [("http://new.bad.org/", None), ("http://new.good.org/", None), ("http://new.other.biz/", None), ("http://new.other.info/", None), ("http://no.label.xyz/", None), ("", None), (None, "x")]
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    pages = spark.read.parquet(path)
    frame = U.judge_urls(pages, U.outcomes_of_pages(pages))
    found, off = difference(frame, con, U.judge_sql())
    assert found == len(rows) and not off
    verdicts = {r.host: r.verdict for r in frame.collect()}
    assert verdicts["new.bad.org"] == verdicts["h1.bad.org"] == "block" and verdicts["new.good.org"] == verdicts["h1.good.org"] == "allow"
