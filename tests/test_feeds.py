"""Feeds over HTTP as data sources, against a small server, and replays of their pages through Spark's readers."""

import hashlib
import json
import threading
from datetime import date, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from lakeloom.sources import connectors, feeds


class Feed:
    """Answers from a dictionary, with ETags; the first `failures` requests for a place fail."""

    def __init__(self):
        self.asked, self.failures = [], {}
        feed = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                at = urlsplit(self.path)
                query = {k: v[0] for k, v in parse_qs(at.query).items()}
                feed.asked.append((at.path, query, self.headers.get("If-None-Match")))
                if feed.failures.get(at.path, 0) > 0:
                    feed.failures[at.path] -= 1
                    return self.send_error(503)
                body = json.dumps(feed.answer(at.path, query)).encode()
                tag = hashlib.md5(body).hexdigest()
                if self.headers.get("If-None-Match") == tag:
                    self.send_response(304)
                    return self.end_headers()
                self.send_response(200)
                self.send_header("ETag", tag)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def cursors(self):
        return [q.get("cursor", "first") for p, q, _ in self.asked if p == "/catalog"]


@pytest.fixture
def feed(spark):
    feeds.register(spark)
    made = Feed()
    yield made
    made.server.shutdown()


def catalog(feed, pages):
    """pages: cursor -> (skus, next cursor); every other one in the answer's second form."""
    forms = [lambda s, n: {"products": [*s, {"name": "no sku"}], "next_cursor": n}, lambda s, n: {"data": s, "pagination": {"next_cursor": n}}]

    def answer(path, query):
        skus, following = pages[query.get("cursor", "first")]
        return forms[len(query) % 2]([{"sku": s, "price_usd": p, "stock": 1} for s, p in skus], following)

    feed.answer = answer


def poll(spark, feed, known="{}"):
    feed.asked.clear()
    read = spark.read.format("catalog_feed").option("url", f"{feed.url}/catalog").option("known", known).option("pause", 0).load()
    pages = read.collect()
    return read.rdd.getNumPartitions(), {p.cursor: p for p in pages}, feeds.known(spark.createDataFrame(pages, read.schema))


def test_catalogue_by_cursors_and_tags(spark, feed):
    pages = {"first": ([("a", 1), ("b", 2.5)], "2"), "2": ([("c", 3)], "3"), "3": ([], None)}
    catalog(feed, pages)
    parts, got, known = poll(spark, feed)
    assert parts == 1 and feed.cursors() == ["first", "2", "3"]
    assert {c: [(p.sku, p.price_usd) for p in r.products] for c, r in got.items()} == {"first": [("a", 1.0), ("b", 2.5)], "2": [("c", 3.0)], "3": []}
    parts, got, again = poll(spark, feed, known)  # nothing new: every page is asked for, none is sent
    assert parts == 3 and sorted(feed.cursors()) == ["2", "3", "first"] and again == known
    assert not any(r.changed or r.products for r in got.values()) and all(t for _, _, t in feed.asked)
    pages["2"] = ([("c", 9)], "3")  # behind a page that is as it was
    pages["3"] = ([("d", 4)], "4")  # the feed has grown
    pages["4"] = ([("e", 5)], None)
    parts, got, known = poll(spark, feed, known)
    assert {c for c, r in got.items() if r.changed} == {"2", "3", "4"} and set(json.loads(known)) == {"first", "2", "3", "4"}
    assert poll(spark, feed, known)[0] == 4


def test_catalogue_with_another_way(spark, feed):
    """A known page that leads elsewhere now is followed; a page that two ways lead to counts once."""
    pages = {"first": ([("a", 1)], "2"), "2": ([("b", 2)], None)}
    catalog(feed, pages)
    _, _, known = poll(spark, feed)
    pages["first"] = ([("a", 1)], "x")
    pages["x"] = ([("n", 7)], "2")
    pages["2"] = ([("b", 3)], None)
    read = spark.read.format("catalog_feed").option("url", f"{feed.url}/catalog").option("known", known).load()
    assert sorted((r.sku, r.price_usd) for r in feeds.products(read).collect()) == [("a", 1.0), ("b", 3.0), ("n", 7.0)]


def test_failures_are_tried_again(spark, feed):
    catalog(feed, {"first": ([("a", 1)], None)})
    feed.failures["/catalog"] = 2
    assert poll(spark, feed)[1]["first"].products[0].sku == "a" and len(feed.asked) == 3
    feed.failures["/catalog"] = 99
    with pytest.raises(Exception, match="503"):
        poll(spark, feed)


def test_ads_by_dates(spark, feed):
    days = [date(2024, 1, 1) + timedelta(days=k) for k in range(7)]
    rows = [{"ad_id": f"{d}-{k}", "impressions": 5, "clicks": "2", "spend": "1.5", "date_start": d.isoformat(), "country": "US", "device": "Mobile", "actions": [{"action_type": "purchase", "value": "2"}, {"action_type": "view", "value": 9}]} for d in days for k in range(3)]

    def answer(path, query):
        own = [r for r in rows if query["since"] <= r["date_start"] <= query["until"]]
        at = int(query.get("after", 0))
        more = {"next": f"{feed.url}{path}?since={query['since']}&until={query['until']}&after={at + 4}"} if at + 4 < len(own) else {}
        return {"data": own[at : at + 4], "paging": more}

    feed.answer = answer
    read = lambda per: spark.read.format("ads_feed").options(url=f"{feed.url}/insights", network="facebook", since="2024-01-02", until="2024-01-06", daysPerTask=per).load()
    assert [read(k).rdd.getNumPartitions() for k in (1, 2, 9)] == [5, 3, 1]
    feed.asked.clear()
    got = connectors.ads_facebook(read(2)).collect()
    assert sorted(r.ad_id for r in got) == sorted(r["ad_id"] for r in rows if "2024-01-02" <= r["date_start"] <= "2024-01-06")
    assert {(r.source, r.clicks, r.spend_usd, r.conversions, r.device_type) for r in got} == {("facebook", 2, 1.5, 2.0, "mobile")}
    assert {(q["since"], q["until"]) for _, q, _ in feed.asked} == {("2024-01-02", "2024-01-03"), ("2024-01-04", "2024-01-05"), ("2024-01-06", "2024-01-06")}
    assert sum("after" in q for _, q, _ in feed.asked) == 2  # the two ranges of six rows have a second page
    with pytest.raises(Exception, match="since"):
        spark.read.format("ads_feed").options(url=feed.url, network="google", since="2024-02-02", until="2024-01-01").load().collect()


def test_google_ads(spark, feed):
    feed.answer = lambda path, query: {"data": [{"ad_id": 7, "cost_micros": "2500000", "conversions": 1, "date": query["since"], "device": "TABLET"}, {"ad_id": None}]}
    read = spark.read.format("ads_feed").options(url=f"{feed.url}/search?v=1", network="google", since="2024-01-02", until="2024-01-02").load()
    got = sorted(map(tuple, connectors.ads_google(read).select("ad_id", "spend_usd", "report_date", "device_type").collect()), key=str)
    assert got == [("7", 2.5, date(2024, 1, 2), "tablet"), (None, None, None, "unknown")]


def test_stored_pages(spark, tmp_path):
    text = lambda skus, after: json.dumps({"products": [{"sku": s, "price_usd": 1} for s in skus] + [{"name": "none"}], "next_cursor": after}, indent=1)
    for poll_no, second in ((1, ["c"]), (2, ["c", "d"])):
        for cursor, body in (("first", text(["a", "b"], "2")), ("2", text(second, None))):
            (tmp_path / str(poll_no) / f"cursor={cursor}").mkdir(parents=True)
            (tmp_path / str(poll_no) / f"cursor={cursor}" / "page.txt").write_text(body)
    first = feeds.stored_pages(spark, str(tmp_path / "1"))
    assert sorted(r.sku for r in feeds.products(first).collect()) == ["a", "b", "c"]
    again = {r.cursor: r for r in feeds.stored_pages(spark, str(tmp_path / "2"), first).collect()}
    assert not again["first"].changed and again["first"].products == [] and again["first"].next_cursor == "2"
    assert again["2"].changed and [p.sku for p in again["2"].products] == ["c", "d"]
    assert feeds.stored_pages(spark, str(tmp_path / "2")).where(F.col("cursor") == "2").count() == 1
