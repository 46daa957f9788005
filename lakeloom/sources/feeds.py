"""Feeds over HTTP as Spark data sources, and replays of stored pages through Spark's own readers.

`spark.read.format("ads_feed")` plans a partition for each range of report dates; `spark.read.format("catalog_feed")` one for each
page whose cursor is known from the poll before, the last of which goes on along the cursors that are new. Pages that are
as they were (by ETag) come without products. Register both with `register(spark)`; executors do the requests.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FB = "ad_id STRING, campaign_name STRING, adset_name STRING, impressions BIGINT, clicks BIGINT, spend DOUBLE, date_start DATE, country STRING, device STRING, actions ARRAY<STRUCT<action_type: STRING, value: DOUBLE>>"
GOOGLE = "ad_id STRING, campaign STRING, ad_group STRING, impressions BIGINT, clicks BIGINT, cost_micros BIGINT, conversions DOUBLE, date DATE, country STRING, device STRING"
PRODUCT = "sku STRING, price_usd DOUBLE, name STRING, stock INT, is_active BOOLEAN"
PAGE = f"cursor STRING, etag STRING, next_cursor STRING, changed BOOLEAN, products ARRAY<STRUCT<{PRODUCT.replace(' ', ': ').replace(',: ', ', ')}>>"
FIRST = "first"


def get(url: str, tag: str | None = None, timeout: float = 20, tries: int = 3, pause: float = 2) -> tuple[str | None, dict | None]:
    """A JSON answer with its ETag, or no answer if it is as it was; further tries after failures, with growing pauses."""
    for k in range(tries):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"} | ({"If-None-Match": tag} if tag else {})), timeout=timeout) as answer:
                return answer.headers.get("ETag"), json.load(answer)
        except urllib.error.HTTPError as e:
            if e.code == 304:
                return tag, None
            if e.code < 500 and e.code != 429 or k == tries - 1:
                raise
        except urllib.error.URLError:
            if k == tries - 1:
                raise
        time.sleep(pause * 2**k)
    raise AssertionError


def _with(url: str, **query: object) -> str:
    return f"{url}{'&' if '?' in url else '?'}{urllib.parse.urlencode(query)}"


# ---- ads: a partition for each range of dates


@dataclass
class Dates(InputPartition):
    since: date
    until: date


class AdsReader(DataSourceReader):
    def __init__(self, options: dict, fields: list[str], kinds: dict[str, str]) -> None:
        self.url, self.fields, self.kinds = options["url"], fields, kinds
        self.since, self.until = date.fromisoformat(options["since"]), date.fromisoformat(options["until"])
        self.days, self.pause = int(options.get("dayspertask", 1)), float(options.get("pause", 2))
        if self.since > self.until or self.days < 1:
            raise ValueError("since must not be after until, and a task has one day at least")

    def partitions(self) -> Sequence[InputPartition]:
        out, at = [], self.since
        while at <= self.until:
            last = min(at + timedelta(days=self.days - 1), self.until)
            out.append(Dates(at, last))
            at = last + timedelta(days=1)
        return out

    def read(self, partition: Dates) -> Iterator[tuple]:
        url: str | None = _with(self.url, since=partition.since.isoformat(), until=partition.until.isoformat())
        while url:
            _, page = get(url, pause=self.pause)
            for row in (page or {}).get("data") or []:
                yield tuple(self._value(c, row.get(c)) for c in self.fields)
            url = ((page or {}).get("paging") or {}).get("next")  # has all parameters already

    def _value(self, column: str, value: object) -> object:
        kind = self.kinds[column]
        if value is None:
            return None
        if kind == "date":
            return date.fromisoformat(str(value))
        if kind == "bigint":
            return int(value)
        if kind == "double":
            return float(value)
        if kind.startswith("array"):
            return [Row(action_type=a.get("action_type"), value=None if a.get("value") is None else float(a["value"])) for a in value]
        return str(value)


class AdsFeed(DataSource):
    """Options: url, network (facebook or google), since and until (report dates, both included), daysPerTask."""

    @classmethod
    def name(cls) -> str:
        return "ads_feed"

    def schema(self) -> str:
        return {"facebook": FB, "google": GOOGLE}[self.options["network"]]

    def reader(self, schema: object) -> DataSourceReader:
        return AdsReader(dict(self.options), schema.fieldNames(), {f.name: f.dataType.simpleString() for f in schema.fields})


# ---- catalogue: a partition for each known page


@dataclass
class Page(InputPartition):
    cursor: str
    etag: str | None
    follow: bool
    next_cursor: str | None = None


class CatalogReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.url, self.limit, self.pause = options["url"], int(options.get("limit", 500)), float(options.get("pause", 2))
        self.known = json.loads(options.get("known", "{}"))  # cursor -> [etag, next cursor]

    def partitions(self) -> Sequence[InputPartition]:
        chain, at = [], FIRST
        while at in self.known and at not in {p.cursor for p in chain}:
            etag, following = self.known[at]
            chain.append(Page(at, etag, False, following))
            if not following:
                break
            at = following
        else:
            if at not in {p.cursor for p in chain}:
                chain.append(Page(at, None, True))  # where the known cursors end
        chain[-1].follow = True
        return chain

    def read(self, partition: Page) -> Iterator[tuple]:
        cursor, tag, known_next = partition.cursor, partition.etag, partition.next_cursor
        while cursor:
            found, page = get(_with(self.url, limit=self.limit, **({} if cursor == FIRST else {"cursor": cursor})), tag, pause=self.pause)
            if page is None:
                yield cursor, found, known_next, False, []
                return
            following = page.get("next_cursor") or (page.get("pagination") or {}).get("next_cursor")
            listed = [p for p in page.get("products") or page.get("data") or [] if p.get("sku")]
            yield cursor, found, following, True, [Row(sku=str(p["sku"]), price_usd=None if p.get("price_usd") is None else float(p["price_usd"]), name=p.get("name"), stock=p.get("stock"), is_active=p.get("is_active")) for p in listed]
            # a known page that leads elsewhere now is followed too: its new way isn't planned
            if not (partition.follow or following != known_next):
                return
            cursor, tag, known_next = following, None, None


class CatalogFeed(DataSource):
    """A row for each page. Options: url, limit, known (as `known` gives it; nothing at first)."""

    @classmethod
    def name(cls) -> str:
        return "catalog_feed"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema: object) -> DataSourceReader:
        return CatalogReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(AdsFeed)
    spark.dataSource.register(CatalogFeed)


def known(pages: DataFrame) -> str:
    """What the next poll needs to know: each page's tag and the cursor after it. As many entries as the feed has pages."""
    return json.dumps({r.cursor: [r.etag, r.next_cursor] for r in pages.select("cursor", "etag", "next_cursor").distinct().collect()})


def products(pages: DataFrame) -> DataFrame:
    """The products of pages that have changed, each once though several ways lead to a page (schema PRODUCT)."""
    return pages.where("changed").dropDuplicates(["cursor"]).select(F.explode("products").alias("p")).select("p.*")


# ---- replays


def stored_pages(spark: SparkSession, path: str, tags: DataFrame | None = None) -> DataFrame:
    """Pages (schema PAGE) of text files under path/cursor=<cursor>/, whole files, by Spark's reader; tags: cursor, etag of the poll before.

    A page's tag is its digest. All pages are read at once, in as many tasks as Spark's reader makes of the files.
    """
    body = "STRUCT<products: ARRAY<STRUCT<{0}>>, data: ARRAY<STRUCT<{0}>>, next_cursor: STRING, pagination: STRUCT<next_cursor: STRING>>".format(PRODUCT.replace(" ", ": ").replace(",: ", ", "))
    raw = spark.read.schema("value STRING, cursor STRING").text(path, wholetext=True)
    made = raw.select("cursor", F.sha2("value", 256).alias("etag"), F.from_json("value", body).alias("b"))
    made = made.select("cursor", "etag", F.coalesce("b.next_cursor", "b.pagination.next_cursor").alias("next_cursor"), F.filter(F.coalesce("b.products", "b.data", F.array()), lambda p: F.coalesce(p["sku"], F.lit("")) != "").alias("products"))
    if tags is None:
        return made.select("cursor", "etag", "next_cursor", F.lit(True).alias("changed"), "products")
    before = tags.select(F.col("cursor").alias("_cursor"), F.col("etag").alias("_etag"))
    new = ~F.coalesce(F.col("etag") == F.col("_etag"), F.lit(False))
    joined = made.join(before, F.col("cursor") == F.col("_cursor"), "left")
    return joined.select("cursor", "etag", "next_cursor", new.alias("changed"), F.when(new, F.col("products")).otherwise(F.array().cast(made.schema["products"].dataType)).alias("products"))
