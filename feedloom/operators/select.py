"""Trust, categories, retention, enrichment and the choice of connectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions import url as U
from feedloom.functions.terms import ADAPTERS, PROBE_PATHS, literal_map
from feedloom.functions.text import clean


def enabled(registry: DataFrame) -> DataFrame:
    return registry.filter(F.coalesce("enabled", F.lit(True)))


def can_try(adapter: Column, registry_has: dict[str, Column]) -> Column:
    """Whether a source has what a connector needs: feeds, selectors, api; the others need nothing."""
    return F.when(adapter == "rss", registry_has["feeds"]).when(adapter == "html", registry_has["selectors"]).when(adapter == "newsfirst", registry_has["api"]).otherwise(True)


def valid_categories(registry: DataFrame, categories) -> DataFrame:
    """Pinned and mapped categories that are none are taken out."""
    ok = lambda c: c.isin(*categories)
    return registry.withColumn("category", F.when(ok(F.col("category")), F.col("category"))).withColumn("url_categories", F.map_filter("url_categories", lambda _, v: ok(v)))


def trusted(articles: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows whose URL is on its source's host or is a search link, with source_domain; images that are no valid URL become null.

    The registry is a configured dimension; Spark broadcasts it by its size.
    """
    sites = registry.select(F.col("id").alias("source_id"), U.host(F.col("site")).alias("_host"))
    rows = articles.join(sites, "source_id").filter(U.valid(F.col("url"), F.array("_host")) | U.is_search_link(F.col("url")))
    return rows.withColumn("source_domain", U.without_www(F.col("_host"))).withColumn("image", F.when(U.valid(F.col("image")), F.col("image"))).drop("_host")


def section(url: Column, mapping: Column) -> Column:
    """The category of the first path segment, raw or decoded, that the mapping has."""
    parts = F.filter(F.split(U.path(url), "/"), lambda s: s != "")
    decode = lambda s: F.coalesce(F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B"))), s)
    found = F.filter(F.transform(parts, lambda s: F.coalesce(F.try_element_at(mapping, s), F.try_element_at(mapping, decode(s)))), lambda c: c.isNotNull())
    return F.get(found, F.lit(0))


def categorise(articles: DataFrame, registry: DataFrame) -> DataFrame:
    """Category of the row, else of its URL's section (not of search links), else the source's."""
    pins = registry.select(F.col("id").alias("source_id"), F.col("category").alias("_pin"), F.col("url_categories").alias("_map"))
    by_url = F.when(~U.is_search_link(F.col("url")), section(F.col("url"), F.col("_map")))
    rows = articles.join(pins, "source_id", "left")
    return rows.withColumn("category", F.coalesce(F.nullif("category", F.lit("")), by_url, F.nullif("_pin", F.lit("")))).drop("_pin", "_map")


def retained(articles: DataFrame, run_ts: Column, days: int) -> DataFrame:
    return articles.filter(F.unix_micros("published") >= F.unix_micros(run_ts) - days * 86_400_000_000)


def valid_previous(previous: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of the last snapshot whose source is still configured and whose host is still its own."""
    return trusted(previous, enabled(registry)).select(*previous.columns)


def enrich(articles: DataFrame, pages: DataFrame) -> DataFrame:
    """articles with the facts of their pages (url, image, excerpt, published): image and excerpt where missing, a page's date always.

    pages has one row per url.
    """
    facts = pages.select(F.col("url"), F.col("image").alias("_image"), F.col("excerpt").alias("_excerpt"), F.col("published").alias("_published"))
    rows = articles.join(facts, "url", "left")
    have = lambda c: F.nullif(F.col(c), F.lit(""))
    return rows.withColumns({
        "image": F.coalesce(have("image"), F.when(U.valid(F.col("_image")), F.col("_image"))), "excerpt": F.coalesce(have("excerpt"), clean(F.col("_excerpt"))),
        "date_estimated": F.when(F.col("_published").isNotNull(), False).otherwise(F.col("date_estimated")), "published": F.coalesce("_published", "published"),
    }).drop("_image", "_excerpt", "_published")


def worklist(articles: DataFrame, n: int) -> DataFrame:
    """What to enrich: search links, rows with estimated dates, and the n newest others without an image (column reason: 0, 1, 2)."""
    reason = F.when(U.is_search_link(F.col("url")), 0).when(F.col("date_estimated"), 1).when(F.coalesce("image", F.lit("")) == "", 2)
    rows = articles.withColumn("reason", reason).filter("reason IS NOT NULL")
    newest = rows.filter("reason = 2").orderBy(F.desc("published_iso"), F.asc("seq")).limit(n)
    return rows.filter("reason < 2").unionByName(newest)


def rank(adapter: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map([(a, i) for i, a in enumerate(ADAPTERS)]), adapter), F.lit(len(ADAPTERS)))


def ladder(candidates: DataFrame, window_hours: Column, min_useful: int = 3) -> DataFrame:
    """The connector that serves each source, and how it went.

    candidates: source_id, adapter, is_primary, fallback, n, freshest_hours (least verified age, null if none), rank. A usable primary serves; else the first
    usable alternative in rank order; else the largest of primary and alternatives, the primary winning ties, then rank. A source has one row per connector. An alternative that serves is named, also where it gave
    too few rows to be ok.
    """
    usable = F.coalesce(F.col("freshest_hours") <= window_hours, F.lit(False)) & (F.col("n") > 0)
    rows = candidates.withColumn("usable", usable).filter(F.col("is_primary") | (F.coalesce("fallback", F.lit(True)) & (F.col("n") > 0)))
    place = F.when(F.col("is_primary"), -1).otherwise(F.col("rank"))
    # Alternatives after a usable one are never tried; larger ones before it don't matter as it is taken.
    order = F.struct(F.col("usable").cast("int").alias("u"), F.when(F.col("usable"), 0).otherwise(F.col("n")).alias("n"), (-place).alias("p"))
    best = rows.groupBy("source_id").agg(F.max_by(F.struct("adapter", "n", "usable", "is_primary"), order).alias("b"), F.max(F.when(F.col("is_primary"), F.col("adapter"))).alias("primary_adapter"))
    ok = F.when(F.col("b.n") == 0, False).when(F.col("b.is_primary"), F.col("b.usable")).otherwise(F.col("b.n") >= min_useful)
    few = F.concat(F.lit("primary blocked/stale; "), F.col("b.adapter"), F.lit(" returned only "), F.col("b.n").cast("string"), F.lit(" article(s)"))
    error = F.when(F.col("b.n") == 0, "0 articles").when(F.col("b.is_primary") & ~F.col("b.usable"), "stale/unverified only").when(~F.col("b.is_primary") & (F.col("b.n") < min_useful), few)
    return best.select("source_id", "primary_adapter", F.col("b.adapter").alias("adapter"), F.col("b.n").alias("n"), ok.alias("ok"), error.alias("error"), F.when(~F.col("b.is_primary"), F.col("b.adapter")).alias("used_fallback"))


def best_adapter(results: DataFrame) -> DataFrame:
    """The connector of best rank that returned rows, per source."""
    return results.filter("n > 0").groupBy("source_id").agg(F.min_by("adapter", rank(F.col("adapter"))).alias("adapter"))


def endpoint_hint(status: Column, server: Column, size: Column, challenge: Column, loops: Column) -> Column:
    """What a probe's answer says about a source that gave nothing."""
    cloud = status.isin(403, 503) & F.lower(server).contains("cloudflare")
    return (
        F.when(cloud & challenge, "script challenge: a browser is needed").when(cloud, "this address is blocked").when(status == 404, "endpoint moved")
        .when((status == 200) & (size < 500), "almost empty: likely a challenge page").when((status == 200) & loops, "redirects to itself").when(status == 200, "content that the parser does not read")
    )


def primary_endpoint(registry: DataFrame) -> Column:
    """The URL that a source depends on, by its connector."""
    base, site = F.regexp_replace("site", "/+$", ""), F.col("site")
    search = F.concat(F.lit("https://news.google.com/rss/search?q="), F.url_encode(F.concat(F.lit("site:"), U.domain(site))), F.lit("&hl="), F.when(F.col("lang").isin("si", "ta"), F.col("lang")).otherwise("en-LK"), F.lit("&gl=LK&ceid=LK:"), F.col("lang"))
    return (
        F.when(F.col("adapter") == "newsfirst", F.concat(F.regexp_replace(F.coalesce("api", "site"), "/+$", ""), F.lit("/post/sticky"))).when(F.col("adapter") == "rss", F.coalesce(F.get("feeds", F.lit(0)), site))
        .when(F.col("adapter") == "wordpress", F.concat(base, F.lit("/wp-json/wp/v2/posts?per_page=1"))).when(F.col("adapter") == "sitemap", F.coalesce(F.col("sitemap"), F.concat(base, F.lit("/news-sitemap.xml"))))
        .when(F.col("adapter") == "html", F.coalesce(F.get("listings", F.lit(0)), site)).otherwise(search)
    )


def numbered(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Positions of rows per key from 1."""
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy(key).orderBy(seq)))


def probe_paths(registry: DataFrame) -> DataFrame:
    """Every place at which a source is probed: source_id, label, url."""
    places = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(path).alias("path")) for label, path in PROBE_PATHS])
    rows = registry.select(F.col("id").alias("source_id"), F.regexp_replace("site", "/+$", "").alias("base"), F.explode(places).alias("p"))
    return rows.select("source_id", "p.label", F.concat("base", "p.path").alias("url"))


def first_seen(history: DataFrame, current: DataFrame) -> DataFrame:
    """current with collected_iso: the least first sight of its id in history and in itself."""
    seen = history.select("id", "collected_iso").unionByName(current.select("id", "collected_iso")).groupBy("id").agg(F.min("collected_iso").alias("collected_iso"))
    return current.drop("collected_iso").join(seen, "id")
