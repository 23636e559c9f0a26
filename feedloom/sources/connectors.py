"""Landed payloads to article rows. A payload table holds what was fetched; no connector touches the network.

Every connector takes (payloads, registry, now) and gives source_id, seq, url, title, published, published_iso, excerpt, image, category,
date_estimated; rows without link, title, date or valid URL are left out. seq is the payload's number times ENTRIES plus
the entry's place in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions import dates, text
from feedloom.functions import url as U
from feedloom.functions.terms import BUCKET_CATEGORIES, SITEMAP_GUESSES, literal_map
from feedloom.sources import pages

_RSS = """channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING, description: STRING, pubDate: STRING, `dc:date`: STRING, category: ARRAY<STRING>,
`media:content`: ARRAY<STRUCT<_url: STRING>>, enclosure: ARRAY<STRUCT<_url: STRING, _type: STRING>>>>>"""
_ATOM = """entry ARRAY<STRUCT<title: STRING, summary: STRING, published: STRING, updated: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, category: ARRAY<STRUCT<_term: STRING>>>>"""
_SITEMAP = "url ARRAY<STRUCT<loc: STRING, lastmod: STRING, `news:news`: STRUCT<`news:title`: STRING, `news:publication_date`: STRING>>>"
_INDEX = "sitemap ARRAY<STRUCT<loc: STRING>>"
_POST = "STRUCT<id: BIGINT, status: STRING, date: STRING, date_gmt: STRING, title: STRUCT<rendered: STRING>, excerpt: STRUCT<rendered: STRING>, post_url: STRING, images: STRUCT<news_detail_image: STRING>"
_WORDPRESS = """ARRAY<STRUCT<link: STRING, title: STRUCT<rendered: STRING>, excerpt: STRUCT<rendered: STRING>, date_gmt: STRING, date: STRING,
_embedded: STRUCT<`wp:featuredmedia`: ARRAY<STRUCT<source_url: STRING>>, `wp:term`: ARRAY<ARRAY<STRUCT<taxonomy: STRING, name: STRING>>>>>>"""


#: Entries that a payload may have.
ENTRIES = 1 << 32


def _sourced(payloads: DataFrame, registry: DataFrame, adapter: str) -> DataFrame:
    landed = payloads.filter((F.col("adapter") == adapter) & (F.col("status") == 200))
    return landed.join(registry.withColumnRenamed("id", "source_id").select("source_id", "site", "lang", "selectors"), "source_id")


def _articles(rows: DataFrame, url: Column, published: Column, estimated: Column | None = None) -> DataFrame:
    out = rows.withColumns({"url": url, "published": published, "date_estimated": F.lit(False) if estimated is None else estimated})
    out = out.filter("url IS NOT NULL AND coalesce(title, '') <> '' AND published IS NOT NULL").withColumn("published_iso", dates.iso(F.col("published")))
    return out.select("source_id", "seq", "url", "title", "published", "published_iso", "excerpt", "image", "category", "date_estimated")


def _limit(rows: DataFrame, n: Column | int) -> DataFrame:
    """The first n entries of a source in order of arrival."""
    return rows.withColumn("_pos", F.row_number().over(Window.partitionBy("source_id").orderBy("seq"))).filter(F.col("_pos") <= n).drop("_pos")


def _number(pos: str = "pos") -> Column:
    return F.col("seq").cast("bigint") * ENTRIES + F.col(pos)


def _payload(seq: str = "seq") -> Column:
    """The payload's number in an entry's."""
    return F.shiftright(seq, 32)


def _absolute(link: Column) -> Column:
    return U.canonical(U.join(F.col("site"), F.trim(link)))


def rss(payloads: DataFrame, registry: DataFrame, now: Column, limit: int = 40) -> DataFrame:
    """RSS items and Atom entries; a source's feeds are one list, cut after limit entries per feed."""
    rows = _sourced(payloads, registry, "rss")
    items = rows.select("source_id", "site", "seq", F.posexplode(F.from_xml("body", _RSS)["channel"]["item"]).alias("pos", "e")).select(
        "source_id", "site", "seq", "pos", F.trim("e.link").alias("link"), F.trim("e.title").alias("title"), F.coalesce("e.pubDate", F.col("e.`dc:date`")).alias("date"), F.col("e.description").alias("body"), F.col("e.category").alias("terms"),
        F.coalesce(F.get(F.filter(F.col("e.`media:content`._url"), lambda u: u != ""), F.lit(0)), F.get(F.filter("e.enclosure", lambda x: x["_type"].startswith("image/")), F.lit(0))["_url"]).alias("image"))
    entries = rows.select("source_id", "site", "seq", F.posexplode(F.from_xml("body", _ATOM)["entry"]).alias("pos", "e")).select(
        "source_id", "site", "seq", "pos", F.get(F.filter("e.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), F.lit(0))["_href"].alias("link"), F.trim("e.title").alias("title"), F.coalesce("e.published", "e.updated").alias("date"), F.col("e.summary").alias("body"), F.col("e.category._term").alias("terms"), F.lit(None).cast("string").alias("image"))
    both = items.unionByName(entries).withColumn("seq", _number())
    feeds = rows.groupBy("source_id").agg((F.count("*") * limit).alias("most"))
    both = _limit(both.join(feeds, "source_id"), F.col("most"))
    both = both.withColumns({"excerpt": text.clean(F.col("body")), "category": text.category_of(F.coalesce("terms", F.array().cast("array<string>")))})
    return _articles(both, _absolute(F.col("link")), dates.to_instant(F.col("date"), now))


def wordpress(payloads: DataFrame, registry: DataFrame, now: Column, limit: int = 40) -> DataFrame:
    """Posts of a REST listing: the image is the first embedded one, terms are those of the category taxonomy."""
    rows = _sourced(payloads, registry, "wordpress").select("source_id", "site", "seq", F.posexplode(F.slice(F.from_json("body", _WORDPRESS), 1, min(limit, 50))).alias("pos", "p"))
    terms = F.transform(F.filter(F.flatten(F.filter("p._embedded.`wp:term`", lambda g: g.isNotNull())), lambda t: t["taxonomy"] == "category"), lambda t: t["name"])
    rows = rows.withColumns({"seq": _number(), "title": text.clean(F.col("p.title.rendered"), 300), "excerpt": text.clean(F.col("p.excerpt.rendered")), "image": F.get(F.col("p._embedded.`wp:featuredmedia`.source_url"), F.lit(0)), "category": text.category_of(F.coalesce(terms, F.array().cast("array<string>")))})
    return _articles(rows, _absolute(F.col("p.link")), F.coalesce(dates.to_instant(F.col("p.date_gmt"), now, "UTC"), dates.to_instant(F.col("p.date"), now)))


def bucketed(payloads: DataFrame, registry: DataFrame, now: Column, limit: int = 40) -> DataFrame:
    """The JSON API of buckets, each a list of posts or of wrappers of posts; the first row of a URL wins."""
    wrapped = f"{_POST}, rowCount: BIGINT, postResponseDto: ARRAY<{_POST}>>>"
    rows = _sourced(payloads, registry, "newsfirst").select("source_id", "site", "seq", F.posexplode(F.from_json("body", "MAP<STRING, STRING>")).alias("at", "bucket", "value"))
    flat = F.coalesce(F.from_json("value", "STRUCT<postResponseDto: ARRAY<STRING>>")["postResponseDto"], F.from_json("value", "ARRAY<STRING>"))
    entries = rows.select("source_id", "site", "seq", "at", "bucket", F.posexplode(flat).alias("k", "entry"))
    # A wrapper with a null list holds no post: the key's presence tells wrappers from posts.
    is_wrapper = F.array_contains(F.json_object_keys("entry"), "postResponseDto")
    posts = F.when(is_wrapper, F.coalesce(F.from_json("entry", wrapped)["postResponseDto"], F.array().cast(f"ARRAY<{_POST}>>"))).otherwise(F.array(F.from_json("entry", f"{_POST}>")))
    rows = entries.select("source_id", "site", "seq", "at", "k", "bucket", F.posexplode(posts).alias("j", "p")).filter("p IS NOT NULL AND coalesce(p.status, 'publish') = 'publish'")
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("source_id", "seq").orderBy("at", "k", "j")))
    image = U.encode_path(F.col("p.images.news_detail_image"))
    rows = rows.withColumns({"seq": _number(), "title": text.clean(F.col("p.title.rendered"), 300), "excerpt": text.clean(F.col("p.excerpt.rendered")), "image": F.when(U.valid(image), image), "category": F.try_element_at(literal_map(list(BUCKET_CATEGORIES.items())), F.col("bucket"))})
    found = _articles(rows, U.canonical(U.encode_path(U.join(F.col("site"), F.col("p.post_url")))), dates.to_instant(F.col("p.date_gmt"), now, "UTC"))
    first = found.withColumn("_k", F.row_number().over(Window.partitionBy("source_id", "url").orderBy("seq"))).filter("_k = 1").drop("_k")
    return _limit(first, limit)


def sitemap(payloads: DataFrame, registry: DataFrame, now: Column, limit: int = 40, window_hours: float = 48) -> DataFrame:
    """News sitemaps: the first document with a date within the window serves a source, else the one with the newest date."""
    rows = _sourced(payloads, registry, "sitemap").select("source_id", "site", "seq", F.col("seq").alias("batch"), F.posexplode(F.slice(F.from_xml("body", _SITEMAP)["url"], 1, limit)).alias("pos", "e"))
    news = F.col("e.`news:news`")
    rows = rows.withColumns({"seq": _number(), "title": F.trim(news["news:title"]), "excerpt": F.lit(None).cast("string"), "image": F.lit(None).cast("string"), "category": F.lit(None).cast("string")})
    when = F.coalesce(dates.to_instant(news["news:publication_date"], now), dates.to_instant(F.col("e.lastmod"), now))
    found = _articles(rows.withColumn("title", F.when(F.col("title") != "", F.col("title"))), _absolute(F.col("e.loc")), when).withColumn("batch", _payload())
    ages = found.groupBy("source_id", "batch").agg(F.min(F.unix_micros(now) - F.unix_micros("published")).alias("age"))
    fresh = F.col("age") <= int(window_hours * 3.6e9)
    chosen = ages.groupBy("source_id").agg(F.min_by("batch", F.struct((~fresh).cast("int"), F.when(fresh, F.col("batch")).otherwise(F.col("age")), F.col("batch"))).alias("batch"))
    return found.join(chosen, ["source_id", "batch"], "left_semi").drop("batch")


def sitemap_children(payloads: DataFrame) -> DataFrame:
    """Sitemap URLs that an index leads to: its first two with 'news' in them, else its first and last."""
    locs = F.transform(F.from_xml("body", _INDEX)["sitemap"], lambda s: F.trim(s["loc"]))
    news = F.slice(F.filter("locs", lambda u: F.lower(u).contains("news")), 1, 2)
    ends = F.array_distinct(F.array(F.get("locs", F.lit(0)), F.element_at("locs", -1)))
    return payloads.withColumn("locs", locs).filter("size(locs) > 0").select("source_id", F.explode(F.when(F.size(news) > 0, news).otherwise(ends)).alias("url"))


def sitemap_candidates(robots: DataFrame) -> DataFrame:
    """Sitemap URLs to try per source (source_id, site, body of robots.txt or null): named ones, then guesses; those with 'news' first."""
    lines = F.filter(F.split(F.coalesce("body", F.lit("")), r"\r?\n"), lambda x: F.lower(x).startswith("sitemap:"))
    named = F.transform(lines, lambda x: F.trim(F.regexp_replace(x, "^[^:]*:", "")))
    guesses = F.array(*[F.concat(F.regexp_replace("site", "/+$", ""), F.lit("/" + g)) for g in SITEMAP_GUESSES])
    rows = robots.select("source_id", F.posexplode(F.array_union(named, guesses)).alias("pos", "url"))
    order = Window.partitionBy("source_id").orderBy(F.when(F.lower("url").contains("news"), 0).otherwise(1), "pos")
    return rows.select("source_id", "url", F.row_number().over(order).alias("rank"))


def html(payloads: DataFrame, registry: DataFrame, now: Column, limit: int = 40) -> DataFrame:
    """Listing pages by CSS selectors: the first limit * 3 items, the first of a URL wins, a missing date is now and estimated."""
    rows = _sourced(payloads, registry, "html")
    items = pages.listing_items(rows).withColumn("seq", F.col("page_seq").cast("bigint") * ENTRIES + F.col("pos"))
    items = _limit(items, limit * 3).join(rows.select("source_id", "site").distinct(), "source_id")
    read = dates.to_instant(F.col("date_text"), now)
    items = items.withColumns({"title": text.clean(F.col("title"), 300), "image": F.when(F.col("image") != "", U.join(F.col("site"), F.col("image"))), "excerpt": F.lit(None).cast("string"), "category": F.lit(None).cast("string"), "_url": _absolute(F.col("href")), "_read": read}).filter("_url IS NOT NULL")
    first = items.withColumn("_k", F.row_number().over(Window.partitionBy("source_id", "_url").orderBy("seq"))).filter("_k = 1")
    return _limit(_articles(first, F.col("_url"), F.coalesce("_read", now), F.col("_read").isNull()), limit)


def search(payloads: DataFrame, registry: DataFrame, now: Column, limit: int = 40, window_hours: float = 48) -> DataFrame:
    """Search feeds, one payload per query variant in order: the variant with most fresh rows, then most rows, serves; variants after a good enough one don't count."""
    rows = _sourced(payloads, registry, "google").select("source_id", "site", "seq", F.posexplode(F.slice(F.from_xml("body", _RSS)["channel"]["item"], 1, limit)).alias("pos", "e"))
    rows = rows.withColumns({"seq": _number(), "title": text.without_publisher(F.trim("e.title")), "excerpt": F.lit(None).cast("string"), "image": F.lit(None).cast("string"), "category": F.lit(None).cast("string")}).filter(U.is_search_link(F.trim("e.link")))
    found = _articles(rows, F.trim("e.link"), dates.to_instant(F.col("e.pubDate"), now)).withColumn("variant", _payload())
    fresh = F.unix_micros(now) - F.unix_micros("published") <= int(window_hours * 3.6e9)
    scores = found.groupBy("source_id", "variant").agg(F.count_if(fresh).alias("fresh"), F.count("*").alias("n"))
    good = F.col("fresh") >= min(limit, 10)
    scores = scores.withColumn("stop", F.min(F.when(good, F.col("variant"))).over(Window.partitionBy("source_id"))).filter("stop IS NULL OR variant <= stop")
    chosen = scores.groupBy("source_id").agg(F.max_by("variant", F.struct("fresh", "n", -F.col("variant"))).alias("variant"))
    return found.join(chosen, ["source_id", "variant"], "left_semi").drop("variant")


def search_variants(registry: DataFrame) -> DataFrame:
    """The query forms of a source, best first: recent, all, the US edition, the Indian one for Tamil, the parent domain."""
    lang, site_domain, parent = F.col("lang"), U.domain(F.col("site")), U.parent_domain(F.col("site"))
    hl = F.when(lang.isin("si", "ta"), lang).otherwise("en-LK")
    base = F.coalesce("google_query", F.concat(F.lit("site:"), site_domain))
    local = F.concat(F.lit("LK:"), lang)
    form = lambda q, h, g, c: F.concat(F.lit("https://news.google.com/rss/search?q="), F.url_encode(q), F.lit("&hl="), h, F.lit("&gl="), F.lit(g), F.lit("&ceid="), c)
    urls = F.array_compact(F.array(
        form(F.concat(base, F.lit(" when:7d")), hl, "LK", local), form(base, hl, "LK", local), F.when(lang == "ta", form(base, F.lit("ta"), "IN", F.lit("IN:ta"))), form(base, F.lit("en-US"), "US", F.lit("US:en")),
        F.when((parent != site_domain) & F.col("google_query").isNull(), form(F.concat(F.lit("site:"), parent, F.lit(" "), lang), hl, "LK", local))))
    return registry.select(F.col("id").alias("source_id"), F.posexplode(urls).alias("variant", "url"))


def resolved_link(body: Column) -> Column:
    """The publisher URL in a link-resolution answer: a JSON line whose parts hold a JSON list as text; null without one."""
    lines = F.filter(F.split(body, r"\r?\n"), lambda x: x.contains("garturlres"))
    parts = F.flatten(F.transform(lines, lambda x: F.coalesce(F.from_json(x, "ARRAY<ARRAY<STRING>>"), F.array().cast("array<array<string>>"))))
    links = F.transform(parts, lambda p: F.get(F.from_json(F.get(p, F.lit(2)), "ARRAY<STRING>"), F.lit(1)))
    return F.get(F.filter(links, lambda u: u.startswith("http")), F.lit(0))


def resolve_links(articles: DataFrame, resolved: DataFrame) -> DataFrame:
    """Search links replaced by what they were resolved to (url, resolved), if that is on the source's own domain."""
    rows = articles.join(resolved.select("url", F.col("resolved").alias("_to")), "url", "left")
    good = U.is_search_link(F.col("url")) & U.valid(F.col("_to"), F.array("source_domain"))
    return rows.withColumn("url", F.when(good, F.col("_to")).otherwise(F.col("url"))).drop("_to")
