"""Connectors over small landed payloads; their SQL is the list of rows to expect, written by hand."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from feedloom.schema import REGISTRY
from feedloom.sources import connectors, pages
from feedloom.operators.select import primary_endpoint

QUERIES: dict = {}
SQL: dict = {}

NOW = "2026-03-10 12:00:00"

_RSS = """<?xml version="1.0"?><rss xmlns:media="http://search.yahoo.com/mrss/"><channel><title>c</title>
<item><title> First &amp; best </title><link>/news/1?utm_source=x&amp;id=7</link><description>&lt;p&gt;Body &lt;b&gt;one&lt;/b&gt;&lt;/p&gt;</description><pubDate>Tue, 10 Mar 2026 09:30:00 GMT</pubDate><category>Latest</category><category>Cricket</category><media:content url="https://img.example/1.jpg"/></item>
<item><title>No date</title><link>https://rss.example/2</link></item>
<item><title>Old zone</title><link>http://www.rss.example/3/#top</link><pubDate>Mon, 9 Mar 2026 23:00:00 +0530</pubDate><enclosure url="https://img.example/3.png" type="image/png"/></item>
<item><title>Bad link</title><link>javascript:void(0)</link><pubDate>Tue, 10 Mar 2026 09:30:00 GMT</pubDate></item></channel></rss>"""
_ATOM = """<feed><entry><title>Atom entry</title><link href="https://atom.example/e"/><updated>2026-03-10T01:00:00Z</updated><summary>Short</summary><category term="technology"/></entry></feed>"""
_WORDPRESS = json.dumps([
    {"link": "https://wp.example/a/", "title": {"rendered": "A &#8211; title"}, "excerpt": {"rendered": "<p>Ex</p>"}, "date_gmt": "2026-03-10T08:00:00", "date": "2026-03-10T13:30:00",
     "_embedded": {"wp:featuredmedia": [{"source_url": "https://wp.example/i.jpg"}], "wp:term": [[{"taxonomy": "category", "name": "Election"}], [{"taxonomy": "post_tag", "name": "Sports"}]]}},
    {"link": "https://wp.example/b", "title": {"rendered": "B"}, "date": "2026-03-10T13:30:00"}, {"link": "https://wp.example/c", "title": {"rendered": ""}, "date_gmt": "2026-03-10T08:00:00"}])
_post = lambda n, **more: {"id": n, "status": "publish", "date_gmt": "2026-03-10 0%d:00:00" % n, "title": {"rendered": "P%d" % n}, "post_url": "/p/%d" % n, **more}
_BUCKETS = json.dumps({"sportPost": {"postResponseDto": [_post(1, images={"news_detail_image": "https://x.example/a b (1).jpg"}), {"rowCount": 2, "postResponseDto": [_post(2), _post(3, status="draft")]}, {"rowCount": 0, "postResponseDto": None}]}, "latest": [_post(1), _post(4)]})
_MAP = """<urlset xmlns:news="n"><url><loc>https://map.example/%s</loc><news:news><news:title>%s</news:title><news:publication_date>%s</news:publication_date></news:news></url><url><loc>https://map.example/x</loc><lastmod>2026-03-10</lastmod></url></urlset>"""
_INDEX = "<sitemapindex><sitemap><loc>https://map.example/a.xml</loc></sitemap><sitemap><loc>https://map.example/b.xml</loc></sitemap><sitemap><loc>https://map.example/c.xml</loc></sitemap></sitemapindex>"
_LISTING = """<html><body><article class="card"><h2 class="t">One &amp; only</h2><a href="/l/1">more</a><img data-src="/i/1.jpg"><time datetime="2026-03-10T06:00:00Z"></time></article>
<article class="card"><a href="/l/1">again</a></article><article class="card"><a href="javascript:x()">bad</a></article>
<article class="card"><h2 class="t">Two</h2><a href="/l/2">more</a><time>3 hours ago</time></article><article class="card"><a href="/l/3">Three</a></article></body></html>"""
_SEARCH = """<rss><channel>%s</channel></rss>"""
_hit = lambda n, day: f"<item><title>Hit {n} - The Paper</title><link>https://news.google.com/rss/articles/{n}</link><pubDate>{day} Mar 2026 10:00:00 GMT</pubDate></item>"


def _registry(spark):
    blank = dict.fromkeys(("adapter", "feeds", "listings", "api", "sitemap", "google_query", "category", "max_age_hours", "selectors", "url_categories"))
    base = lambda sid, adapter, lang="en", **more: blank | {"id": sid, "name": sid, "lang": lang, "site": f"https://{sid}.example", "adapter": adapter, "enabled": True, "fallback": True} | more
    rows = [
        base("rss", "rss", feeds=["https://rss.example/f1", "https://rss.example/f2"]), base("wp", "wordpress"), base("nf", "newsfirst", api="https://api.example/"), base("map", "sitemap"),
        base("list", "html", listings=["https://list.example/all"], selectors={"item": "article.card", "link": "a[href]", "title": "h2.t", "image": "img", "date": "time", "article_date": None}), base("ta.paper", "google", "ta"),
    ]
    names = [f.split(":")[0].strip() for f in ("id, name, lang, site, adapter, enabled, fallback, feeds, listings, api, sitemap, google_query, category, max_age_hours, selectors, url_categories").split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], REGISTRY)


def _payloads(spark):
    rows = [
        ("rss", "rss", 0, 200, _RSS), ("rss", "rss", 1, 200, _ATOM), ("rss", "rss", 2, 503, _RSS), ("wp", "wordpress", 0, 200, _WORDPRESS), ("wp", "wordpress", 1, 200, "<html>no json"),
        ("nf", "newsfirst", 0, 200, _BUCKETS), ("map", "sitemap", 0, 200, _MAP % ("old", "Old", "2026-02-01T00:00:00Z")), ("map", "sitemap", 1, 200, _MAP % ("new", "New", "2026-03-10T03:00:00Z")), ("map", "sitemap", 2, 200, _INDEX),
        ("list", "html", 0, 200, _LISTING), ("ta.paper", "google", 0, 200, _SEARCH % (_hit(1, "1") + _hit(2, "2"))), ("ta.paper", "google", 1, 200, _SEARCH % (_hit(3, "10") + _hit(4, "3"))),
    ]
    return spark.createDataFrame(rows, "source_id string, adapter string, seq int, status int, body string")


def query(columns: str, rows: list[tuple] | None = None):
    """Registers a query; rows are what to expect, as literals."""
    def add(f):
        QUERIES[f.__name__] = f
        if rows is not None:
            show = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'%s'" % v.replace("'", "''")
            SQL[f.__name__] = f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(show, r)) + ')' for r in rows)}) t({columns})"
        return f

    return add


def _now():
    return F.to_timestamp(F.lit(NOW))


_COLUMNS = "url, title, published_iso, excerpt, image, category, date_estimated"


def _of(rows):
    return rows.select(*_COLUMNS.split(", "))


@query(_COLUMNS, [
    ("https://rss.example/news/1?id=7", "First & best", "2026-03-10T09:30:00Z", "Body one", "https://img.example/1.jpg", "sports", False),
    ("https://www.rss.example/3", "Old zone", "2026-03-09T17:30:00Z", None, "https://img.example/3.png", None, False),
    ("https://atom.example/e", "Atom entry", "2026-03-10T01:00:00Z", "Short", None, "tech", False),
])
def sc1_rss(spark, sf_dir):
    return _of(connectors.rss(_payloads(spark), _registry(spark), _now()))


@query(_COLUMNS, [
    ("https://wp.example/a", "A – title", "2026-03-10T08:00:00Z", "Ex", "https://wp.example/i.jpg", "politics", False),
    ("https://wp.example/b", "B", "2026-03-10T08:00:00Z", None, None, None, False),
])
def sc2_wordpress(spark, sf_dir):
    return _of(connectors.wordpress(_payloads(spark), _registry(spark), _now()))


@query("url, title, published_iso, image, category", [
    ("https://nf.example/p/1", "P1", "2026-03-10T01:00:00Z", "https://x.example/a%20b%20%281%29.jpg", "sports"), ("https://nf.example/p/2", "P2", "2026-03-10T02:00:00Z", None, "sports"), ("https://nf.example/p/4", "P4", "2026-03-10T04:00:00Z", None, None),
])
def sc3_bucketed(spark, sf_dir):
    return connectors.bucketed(_payloads(spark), _registry(spark), _now()).select("url", "title", "published_iso", "image", "category")


@query("url, title, published_iso", [("https://map.example/new", "New", "2026-03-10T03:00:00Z")])
def sc5_sitemap(spark, sf_dir):
    return connectors.sitemap(_payloads(spark), _registry(spark), _now()).select("url", "title", "published_iso")


@query("source_id, url", [("map", "https://map.example/a.xml"), ("map", "https://map.example/c.xml")])
def sc6_sitemap_children(spark, sf_dir):
    return connectors.sitemap_children(_payloads(spark).filter("adapter = 'sitemap'"))


@query("url, title, published_iso, image, date_estimated", [
    ("https://list.example/l/1", "One & only", "2026-03-10T06:00:00Z", "https://list.example/i/1.jpg", False), ("https://list.example/l/2", "Two", "2026-03-10T09:00:00Z", None, False), ("https://list.example/l/3", "Three", "2026-03-10T12:00:00Z", None, True),
])
def sc7_html(spark, sf_dir):
    return connectors.html(_payloads(spark), _registry(spark), _now()).select("url", "title", "published_iso", "image", "date_estimated")


@query("url, title", [("https://news.google.com/rss/articles/3", "Hit 3"), ("https://news.google.com/rss/articles/4", "Hit 4")])
def sc8_search(spark, sf_dir):
    return connectors.search(_payloads(spark), _registry(spark), _now()).select("url", "title")


@query("variant, url", [
    (0, "https://news.google.com/rss/search?q=site%3Ata.paper.example+when%3A7d&hl=ta&gl=LK&ceid=LK:ta"), (1, "https://news.google.com/rss/search?q=site%3Ata.paper.example&hl=ta&gl=LK&ceid=LK:ta"),
    (2, "https://news.google.com/rss/search?q=site%3Ata.paper.example&hl=ta&gl=IN&ceid=IN:ta"), (3, "https://news.google.com/rss/search?q=site%3Ata.paper.example&hl=en-US&gl=US&ceid=US:en"),
    (4, "https://news.google.com/rss/search?q=site%3Apaper.example+ta&hl=ta&gl=LK&ceid=LK:ta"),
])
def sc10_search_variants(spark, sf_dir):
    return connectors.search_variants(_registry(spark).filter("id = 'ta.paper'")).select("variant", "url")


@query("k, resolved", [(1, "https://a.example/story"), (2, None)])
def sc15_resolved_link(spark, sf_dir):
    inner = json.dumps(["garturlres", "https://a.example/story", 1])
    body = ")]}'\n\n" + json.dumps([["wrb.fr", "x", inner, None]])
    rows = spark.createDataFrame([(1, body), (2, ")]}'\n[garturlres")], "k int, body string")
    return rows.select("k", connectors.resolved_link(F.col("body")).alias("resolved"))


@query("id, endpoint", [
    ("rss", "https://rss.example/f1"), ("wp", "https://wp.example/wp-json/wp/v2/posts?per_page=1"), ("nf", "https://api.example/post/sticky"), ("map", "https://map.example/news-sitemap.xml"), ("list", "https://list.example/all"),
    ("ta.paper", "https://news.google.com/rss/search?q=site%3Ata.paper.example&hl=ta&gl=LK&ceid=LK:ta"),
])
def sc18_primary_endpoint(spark, sf_dir):
    registry = _registry(spark)
    return registry.select("id", primary_endpoint(registry).alias("endpoint"))


_PAGE = """<html lang="en"><head><title>T</title><meta property="og:image" content="/i.png"><meta name="description" content="Words"><meta name="pubdate" content="no date">
<script type="application/ld+json">{"datePublished": "2026-03-09T10:00:00Z"}</script></head><body><time datetime="2026-03-01">1 March</time><p class="by line">Posted 2026-03-02 10:00</p></body></html>"""


@query("k, image, excerpt, published_iso", [(1, "/i.png", "Words", "2026-03-09T10:00:00Z"), (2, None, None, None)])
def e1_page_evidence(spark, sf_dir):
    from feedloom.functions.dates import iso

    rows = spark.createDataFrame([(1, _PAGE), (2, None)], "k int, html string")
    return pages.page_facts(rows, ["k"]).select("k", "image", "excerpt", iso(pages.best_date(F.col("dates"), _now())).alias("published_iso"))


@query("k, kind, path, raw", [(1, "meta", "pubdate", "no date"), (1, "time", "body > time", "2026-03-01"), (1, "json", "datePublished", "2026-03-09T10:00:00Z"), (1, "text", "body > p.by.line", "Posted 2026-03-02 10:00")])
def e4_date_evidence(spark, sf_dir):
    return pages.date_evidence(spark.createDataFrame([(1, _PAGE), (2, None)], "k int, html string"), "k")
