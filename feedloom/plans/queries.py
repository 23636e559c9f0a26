"""The registered queries over the test tables, each with its SQL for DuckDB where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import dates, text
from feedloom.functions import url as U
from feedloom.functions.terms import ADAPTERS, JUNK_PARAMS, RELATIVE_UNITS
from feedloom.operators import dedupe, report, select
from feedloom.plans.fixtures import ARTICLES_SQL, MERGE_SQL, articles, iso_sql, read, run_ts

QUERIES: dict = {}
SQL: dict = {}
CATEGORIES = ["politics", "business", "sports", "tech", "international", "entertainment", "society"]


def query(sql: str | None = None):
    """Registers a query under its function's name."""
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def with_articles(sql: str) -> str:
    return f"WITH {ARTICLES_SQL}, {sql}" if not sql.lstrip().startswith("SELECT") else f"WITH {ARTICLES_SQL} {sql}"


def with_merged(sql: str, source: str = "SELECT *, NULL AS collected FROM a") -> str:
    return f"WITH {ARTICLES_SQL}, x AS ({source}), {MERGE_SQL} {sql}"


# -- URLs ------------------------------------------------------------------------------------------------------------------------

_KEPT = "list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda p: contains(p, '=') AND split_part(p, '=', 2) <> '' AND NOT list_contains([%s], lower(split_part(p, '=', 1))))" % ", ".join(f"'{p}'" for p in JUNK_PARAMS)
_PATH = "regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '')"
_CANONICAL = f"""'https://' || lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END
  || CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END"""


@query(f"SELECT page_id, {_CANONICAL} AS canonical FROM pages")
def u3_canonical_url(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical"))


@query(f"SELECT page_id, regexp_replace({_CANONICAL}, '^https://www\\.', 'https://') AS key FROM pages")
def u4_dedupe_key(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.dedupe_key(F.col("url")).alias("key"))


@query(f"SELECT page_id, substr(sha1(regexp_replace({_CANONICAL}, '^https://www\\.', 'https://')), 1, 16) AS id FROM pages")
def u5_article_id(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.article_id(F.col("url")).alias("id"))


_BAD_URLS = ["javascript:alert(1)", "ftp://a.example/x", "https://user:pw@a.example/", "https://@a.example/", "https://127.0.0.1/", "https://10.1.2.3/x", "https://a.example:8080/", "https://localhost/", "https://a.local/", "https://a.example/x y", "https://a.example\\@b.example/", "//a.example/x", "https://[::1]/", "https:///x"]


@query("SELECT page_id, regexp_matches(url, '^https?://[a-z0-9.-]+\\.[a-z]+(/[^\\s]*)?$') AS valid, false AS bad_valid, true AS own_host FROM pages")
def u1_valid_url(spark, sf_dir):
    """Pages' URLs are valid, none of the bad ones is, and a URL is on its own host."""
    bad = F.exists(F.array(*map(F.lit, _BAD_URLS)), lambda u: U.valid(u))
    return read(spark, sf_dir, "pages").select("page_id", U.valid(F.col("url")).alias("valid"), bad.alias("bad_valid"), U.valid(F.col("url"), F.array(F.concat(F.lit("www."), U.without_www(U.host(F.col("url")))))).alias("own_host"))


@query("SELECT page_id, regexp_replace(url, '#.*$', '') AS plain, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/p%20(1)' AS spaced FROM pages".replace("p%20(1)", "p%20%281%29"))
def u6_encode_path(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", U.encode_path(url).alias("plain"), U.encode_path(F.concat(F.regexp_extract(url, "^(https?://[^/?#]*)", 1), F.lit("/p (1)#x"))).alias("spaced"))


@query("SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/a/c' AS rooted, regexp_replace(regexp_extract(url, '^(https?://[^?#]*)', 1), '[^/]*$', '') || 'img/x.png' AS relative, regexp_extract(url, '^(https?:)', 1) || '//cdn.example/y' AS other FROM pages")
def u7_join(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", U.join(url, F.lit("/a/./b/../c")).alias("rooted"), U.join(url, F.lit("img/x.png")).alias("relative"), U.join(url, F.lit("//cdn.example/y")).alias("other"))


@query("""WITH h AS (SELECT regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '^www\\.', '') AS domain FROM pages)
SELECT domain, array_to_string(list_slice(string_split(domain, '.'), -2, -1), '.') AS parent, count(*) AS n FROM h GROUP BY 1, 2""")
def u8_host_rollup(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(U.domain(F.col("url")).alias("domain"), U.parent_domain(F.col("url")).alias("parent")).agg(F.count("*").alias("n"))


# -- Text ------------------------------------------------------------------------------------------------------------------------

_COLLAPSED = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


_BARE = "regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', ' ', 'g'), '<[A-Za-z/!][^>]*>', ' ', 'g')"
for _name, _sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
    _BARE = f"replace({_BARE}, '&{_name};', '{_sign}')"


@query(f"""WITH c AS (SELECT doc_id, nullif(trim(regexp_replace({_BARE}, '\\s+', ' ', 'g')), '') AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) <= 220 THEN t ELSE rtrim(regexp_replace(substr(t, 1, 220), ' [^ ]*$', ''), '.,;:') || chr(8230) END AS excerpt FROM c""")
def t1_excerpt_220(spark, sf_dir):
    """Every document; the tables' texts hold stray signs but no menus or scripts, which the SQL would not take off."""
    return read(spark, sf_dir, "documents").select("doc_id", text.clean(F.col("text")).alias("excerpt"))


@query("SELECT doc_id, lower(source) || ' & more' AS term FROM documents")
def t3_normalise_term(spark, sf_dir):
    dressed = F.concat(F.lit(" ​"), F.upper("source"), F.lit("  &amp;\t more﻿"))
    return read(spark, sf_dir, "documents").select("doc_id", text.normalise_term(dressed).alias("term"))


@query(with_articles("SELECT seq, CASE WHEN seq % 2 = 0 THEN category WHEN seq % 3 = 0 THEN 'tech' ELSE NULL END AS category FROM a"))
def t4_first_mapped_term(spark, sf_dir):
    terms = F.array(F.lit("Latest"), F.when(F.col("seq") % 2 == 0, F.initcap("category")), F.when((F.col("seq") % 2 == 1) & (F.col("seq") % 3 == 0), F.lit(" TECHNOLOGY ")))
    return articles(spark, sf_dir).select("seq", text.category_of(terms).alias("category"))


@query("SELECT doc_id, substr(regexp_replace(lower(text), '[^\\p{L}\\p{N}_]+', '', 'g'), 1, 60) AS key FROM documents")
def t5_title_key(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.title_key(F.col("text")).alias("key"))


@query("SELECT doc_id, 'Head ' || doc_id AS title FROM documents")
def t6_without_publisher(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.without_publisher(F.concat(F.lit("Head "), F.col("doc_id").cast("string"), F.lit(" - Daily "), F.col("source"))).alias("title"))


@query("SELECT event_id, props IS NOT NULL AS has_props, json_valid(props) AS parsed, CAST(len(json_keys(props)) AS BIGINT) AS n_keys FROM events")
def t7_json_props(spark, sf_dir):
    """Tolerant JSON: what does not parse is null."""
    keys = F.json_object_keys("props")
    return read(spark, sf_dir, "events").select("event_id", F.col("props").isNotNull().alias("has_props"), keys.isNotNull().alias("parsed"), F.size(keys).cast("long").alias("n_keys"))


@query("SELECT event_id, true AS iso, event_id % 2 = 0 AS month, false AS word FROM events")
def t8_looks_like_date(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd")
    month = F.when(F.col("event_id") % 2 == 0, F.lit("Jan 5 2024")).otherwise(F.lit("no such text"))
    return read(spark, sf_dir, "events").select("event_id", text.looks_like_date(day).alias("iso"), text.looks_like_date(month).alias("month"), text.looks_like_date(F.lit("2024x")).alias("word"))


@query("SELECT page_id, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang, length(regexp_extract(html, '<title>([^<]*)</title>', 1)) > 0 AS has_title FROM pages")
def e2_page_facts(spark, sf_dir):
    from feedloom.sources.pages import page_facts

    return page_facts(read(spark, sf_dir, "pages"), ["page_id"]).select("page_id", "lang", (F.length("title") > 0).alias("has_title"))


# -- Dates -----------------------------------------------------------------------------------------------------------------------


@query(f"WITH clock AS (SELECT max(ts) AS now FROM events) SELECT event_id, CASE WHEN ts - INTERVAL 399 DAY >= now - INTERVAL 400 DAY THEN {iso_sql('(ts - INTERVAL 399 DAY)')} END AS iso FROM events, clock")
def dt1_iso_window(spark, sf_dir):
    """ISO text of dates moved back by 399 days, so that the bound of 400 days cuts some."""
    moved = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - 399 * 86_400_000_000)
    return read(spark, sf_dir, "events").select("event_id", dates.iso(dates.in_bounds(moved, run_ts(spark, sf_dir))).alias("iso"))


_HOUR = "CAST(extract(hour FROM ts) AS INT)"


@query(f"SELECT event_id, {iso_sql("(date_trunc('minute', ts) - INTERVAL 330 MINUTE)")} AS si, {iso_sql("(date_trunc('day', ts) - INTERVAL 330 MINUTE)")} AS ta FROM events")
def dt2_local_date(spark, sf_dir):
    """Sinhala dates with a clock of twelve hours and Tamil dates without, both for January."""
    ts = F.col("ts")
    half = F.when(F.hour(ts) < 12, "පෙ.ව.").otherwise("ප.ව.")
    si = F.concat(F.date_format(ts, "yyyy"), F.lit(" ජනවාරි "), F.date_format(ts, "d"), F.lit(" | "), half, F.lit(" "), F.date_format(ts, "hh:mm"))
    ta = F.concat(F.date_format(ts, "d"), F.lit(" ஜனவரி "), F.date_format(ts, "yyyy"))
    return read(spark, sf_dir, "events").select("event_id", dates.iso(dates.local_date(si)).alias("si"), dates.iso(dates.local_date(ta)).alias("ta"))


_UNITS = list(RELATIVE_UNITS)


@query(f"WITH clock AS (SELECT max(ts) AS now FROM events) SELECT event_id, epoch_us(now) - (event_id % 90 + 1) * [{', '.join(str(RELATIVE_UNITS[u]) for u in _UNITS)}][event_id % {len(_UNITS)} + 1] * 1000000 AS micros, epoch_us(now) - 86400000000 AS yesterday, NULL::BIGINT AS other FROM events, clock")
def dt3_relative_age(spark, sf_dir):
    now = run_ts(spark, sf_dir)
    unit = F.get(F.array(*map(F.lit, _UNITS)), (F.col("event_id") % len(_UNITS)).cast("int"))
    t = F.concat((F.col("event_id") % 90 + 1).cast("string"), F.lit(" "), unit, F.lit("s AGO"))
    micros = lambda c: F.unix_micros(dates.relative_date(c, now))
    return read(spark, sf_dir, "events").select("event_id", micros(t).alias("micros"), micros(F.lit(" Yesterday")).alias("yesterday"), micros(F.lit("5 chicagos")).alias("other"))


@query("SELECT event_id, epoch_us(date_trunc('second', ts)) AS rfc, epoch_us(date_trunc('second', ts)) - 19800000000 AS naive, epoch_us(date_trunc('second', ts)) - 7200000000 AS zoned FROM events")
def dt6_general_date(spark, sf_dir):
    """RFC 822 with GMT, ISO without a zone (local time) and ISO with an offset."""
    read_ = lambda pattern, end="": F.unix_micros(dates.general_date(F.concat(F.date_format("ts", pattern), F.lit(end))))
    return read(spark, sf_dir, "events").select("event_id", read_("'Mon, 'dd MMM yyyy HH:mm:ss", " GMT").alias("rfc"), read_("yyyy-MM-dd HH:mm:ss").alias("naive"), read_("yyyy-MM-dd'T'HH:mm:ss", "+02:00").alias("zoned"))


# -- Filters and aggregates --------------------------------------------------------------------------------------------------------


@query("SELECT event_id FROM events, (SELECT max(ts) AS now FROM events) WHERE ts >= now - INTERVAL 14 DAY")
def f5_retention_14d(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("published"))
    return select.retained(rows, run_ts(spark, sf_dir), 14).select("event_id")


def _events_as_articles(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("published"), (F.col("value") < 20).alias("date_estimated"))


@query("""SELECT user_id, count(*) AS n, count(*) FILTER (WHERE value >= 20 AND epoch_us(now) - epoch_us(ts) <= 172800000000) AS fresh,
  min(epoch_us(now) - epoch_us(ts)) FILTER (WHERE value >= 20) AS freshest_micros FROM events, (SELECT max(ts) AS now FROM events) GROUP BY user_id""")
def g1_freshest_age(spark, sf_dir):
    """Also the count of fresh rows (F7)."""
    return report.freshness(_events_as_articles(spark, sf_dir), "user_id", run_ts(spark, sf_dir), 48)


@query(with_articles("SELECT seq, to_json(struct_pack(id := id, lang := lang)) AS head, image IS NOT NULL AS has_image FROM a"))
def f8_null_drop(spark, sf_dir):
    """Public JSON without null fields: the head is compared, and that an image is there exactly if it is not null."""
    rows = articles(spark, sf_dir)
    return rows.select("seq", F.to_json(F.struct("id", "lang")).alias("head"), report.article_json(rows).contains('"image"').alias("has_image"))


@query("""WITH t AS (SELECT lang, count(*) AS total FROM documents GROUP BY lang) SELECT lang, total, max(total) OVER () AS largest, total < 0.35 * max(total) OVER () AS thin FROM t""")
def f13_thin_languages(spark, sf_dir):
    return report.thin(read(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("total")))


@query(with_merged("""SELECT s.source_id, n, coalesce(new_articles, 0) AS new_articles, coalesce(est, 0) AS estimated_dates, epoch_us(now) - epoch_us(newest) AS age_micros, coalesce(epoch_us(now) - epoch_us(newest) > 172800000000, true) AS stale_content
FROM (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE date_estimated) AS est FROM a WHERE seq % 2 = 1 GROUP BY source_id) s
LEFT JOIN (SELECT source_id, count(DISTINCT id) AS new_articles FROM a o WHERE seq % 2 = 1 AND NOT EXISTS (SELECT 1 FROM a p WHERE p.seq % 2 = 0 AND p.source_id = o.source_id AND p.id = o.id) GROUP BY source_id) w USING (source_id)
LEFT JOIN (SELECT source_id, max(published) AS newest FROM m, clock WHERE NOT date_estimated AND published <= now GROUP BY source_id) f USING (source_id), clock"""))
def g3_source_freshness(spark, sf_dir):
    rows = articles(spark, sf_dir)
    odd, even = rows.filter("seq % 2 = 1"), rows.filter("seq % 2 = 0")
    return report.source_freshness(odd, even, dedupe.merge_by_id(rows), run_ts(spark, sf_dir), 48).drop("newest")


@query(with_articles("""SELECT lang, count(*) AS total_candidates, count(*) FILTER (WHERE f) AS fresh_candidates, count(DISTINCT source_id) FILTER (WHERE f) AS fresh_sources,
  count(*) FILTER (WHERE f) >= 3 AND count(DISTINCT source_id) FILTER (WHERE f) >= 1 AS passes
FROM (SELECT *, epoch_us(now) - epoch_us(published) <= 2505600000000 AS f FROM a, clock) GROUP BY lang"""))
def g5_lang_gate(spark, sf_dir):
    """First seen within 696 hours of the newest event."""
    rows = articles(spark, sf_dir).withColumn("collected_at", F.lit(None).cast("timestamp"))
    return report.gate(rows, run_ts(spark, sf_dir), 696, 3, 1)


@query(with_articles("""SELECT lang, c >= 200 AS passes, CASE WHEN c >= 200 THEN 'updated' WHEN lang = 'es' THEN 'unavailable' ELSE 'preserved' END AS state FROM (SELECT lang, count(*) AS c FROM a GROUP BY lang)"""))
def st4_language_state(spark, sf_dir):
    """A bar of 200 rows, and a previous snapshot for all languages but Spanish."""
    rows = articles(spark, sf_dir).withColumn("collected_at", F.lit(None).cast("timestamp"))
    previous = rows.select("lang").distinct().filter("lang <> 'es'").withColumn("generated", F.lit("2024-01-01T00:00:00Z"))
    return report.states(report.gate(rows, run_ts(spark, sf_dir), 1e5, 200, 1), previous).select("lang", "passes", "state")


@query(with_articles(f"SELECT l.lang, c.category, count(a.seq) AS n FROM (SELECT DISTINCT lang FROM a) l CROSS JOIN (SELECT unnest([{', '.join(f"'{c}'" for c in CATEGORIES)}]) AS category) c LEFT JOIN a ON a.lang = l.lang AND a.category = c.category GROUP BY 1, 2"))
def g6_category_counts_zero_filled(spark, sf_dir):
    return report.category_counts(articles(spark, sf_dir), CATEGORIES)


@query("SELECT source AS source_id, count(*) AS n, count(*) > 40 AS ok FROM documents GROUP BY source")
def g7_sources_ok(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("n"), (F.count("*") > 40).alias("ok"))


@query(with_articles("SELECT source_id, count(*) AS n, min(epoch_us(now) - epoch_us(published)) AS age_micros, count(*) FILTER (WHERE image IS NOT NULL) AS with_image, min_by(title, seq) AS sample FROM a, clock GROUP BY source_id"))
def g10_probe_stats(spark, sf_dir):
    age = F.unix_micros(run_ts(spark, sf_dir)) - F.unix_micros("published")
    return articles(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("n"), F.min(age).alias("age_micros"), F.count_if(F.col("image").isNotNull()).alias("with_image"), F.min_by("title", "seq").alias("sample"))


@query(with_articles("SELECT count(*) > 0 AS any_fresh, count(DISTINCT lang) AS languages, count(*) > 0 AND count(DISTINCT lang) >= 1 AS accepted FROM a"))
def g12_run_verdict(spark, sf_dir):
    got = articles(spark, sf_dir).agg(F.count("*").alias("n"), F.count_distinct("lang").alias("languages"))
    return got.select((F.col("n") > 0).alias("any_fresh"), "languages", ((F.col("n") > 0) & (F.col("languages") >= 1)).alias("accepted"))


# -- Dedupe, order, feeds ------------------------------------------------------------------------------------------------------------

_MERGED_COLUMNS = "id, seq, source_id, lang, title, published_iso, collected_iso, image, excerpt, date_estimated, stale, first_seq"


@query(with_merged(f"SELECT {_MERGED_COLUMNS} FROM m"))
def w1_dedupe_by_id(spark, sf_dir):
    return dedupe.merge_by_id(articles(spark, sf_dir)).select(*_MERGED_COLUMNS.split(", "))


@query(with_merged("SELECT id, category FROM m"))
def w2_category_carry(spark, sf_dir):
    return dedupe.merge_by_id(articles(spark, sf_dir)).select("id", "category")


@query("""WITH RECURSIVE r AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS k FROM events),
w AS (SELECT event_id, user_id, event_type, k, t AS last, true AS kept FROM r WHERE k = 1
  UNION ALL SELECT r.event_id, r.user_id, r.event_type, r.k, CASE WHEN abs(w.last - r.t) >= 86400000000 THEN r.t ELSE w.last END, abs(w.last - r.t) >= 86400000000
  FROM w JOIN r ON r.user_id = w.user_id AND r.event_type = w.event_type AND r.k = w.k + 1)
SELECT event_id FROM w WHERE kept""")
def w3_near_dup_greedy(spark, sf_dir):
    rows = _events_as_articles(spark, sf_dir).select("event_id", "user_id", "event_type", F.unix_micros("published").alias("at"))
    return dedupe.drop_near(rows, ["user_id", "event_type"], "at", [F.desc("at"), F.asc("event_id")], 86400).select("event_id")


@query(f"SELECT canonical, min(page_id) AS page_id FROM (SELECT page_id, {_CANONICAL} AS canonical FROM pages) GROUP BY canonical")
def w4_first_wins(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select(U.canonical(F.col("url")).alias("canonical"), "page_id")
    return rows.groupBy("canonical").agg(F.min("page_id").alias("page_id"))


def _candidates(spark, sf_dir):
    """conversations as probes: a conversation is a source, a role a connector; the system turn is the primary."""
    c = read(spark, sf_dir, "conversations")
    adapter = F.when(F.col("role") == "system", "rss").when(F.col("role") == "user", "sitemap").otherwise("html")
    got = c.select(F.col("conv_id").alias("source_id"), adapter.alias("adapter"), F.length("text").alias("len")).groupBy("source_id", "adapter").agg(F.count("*").alias("n"), F.min("len").cast("double").alias("freshest_hours"))
    return got.withColumns({"is_primary": F.col("adapter") == "rss", "fallback": F.lit(True), "rank": select.rank(F.col("adapter"))})


_CANDIDATES = """c AS (SELECT conv_id AS source_id, CASE role WHEN 'system' THEN 'rss' WHEN 'user' THEN 'sitemap' ELSE 'html' END AS adapter, count(*) AS n, min(length(text)) AS age FROM conversations GROUP BY 1, 2),
k AS (SELECT *, age <= 100 AS usable, adapter = 'rss' AS is_primary, CASE adapter WHEN 'rss' THEN -1 WHEN 'sitemap' THEN 3 ELSE 4 END AS place FROM c)"""


@query(f"""WITH {_CANDIDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY usable DESC, CASE WHEN usable THEN 0 ELSE n END DESC, place) AS rk FROM k)
SELECT source_id, adapter, n, CASE WHEN is_primary THEN usable ELSE n >= 3 END AS ok FROM r WHERE rk = 1""")
def w5_adapter_ladder(spark, sf_dir):
    return select.ladder(_candidates(spark, sf_dir), F.lit(100.0)).select("source_id", "adapter", "n", "ok")


@query(f"WITH {_CANDIDATES} SELECT source_id, min_by(adapter, place) AS adapter FROM k GROUP BY source_id")
def w6_best_adapter(spark, sf_dir):
    return select.best_adapter(_candidates(spark, sf_dir))


_TOP = "row_number() OVER (PARTITION BY lang ORDER BY published_iso DESC, first_seq)"


@query(with_merged(f"SELECT lang, rank, id FROM (SELECT lang, id, {_TOP} AS rank FROM m) WHERE rank <= 150"))
def o2_top150_per_lang(spark, sf_dir):
    return report.feed(dedupe.merge_by_id(articles(spark, sf_dir)), 150).select("lang", F.col("rank").cast("long").alias("rank"), "id")


@query(with_merged("SELECT lang, category, rank, id FROM (SELECT lang, category, id, row_number() OVER (PARTITION BY lang, category ORDER BY published_iso DESC, first_seq) AS rank FROM m WHERE category IS NOT NULL) WHERE rank <= 150"))
def sk4_category_feeds(spark, sf_dir):
    return report.category_feeds(dedupe.merge_by_id(articles(spark, sf_dir)), CATEGORIES, 150).select("lang", "category", F.col("rank").cast("long").alias("rank"), "id")


@query(with_merged(f"""SELECT lang, count(*) AS count, '{{"version":"v1","lang":"' || lang || '","generated":"now","count":' || count(*) || ',"ids":"' || string_agg(id, ',' ORDER BY rank) || '"}}' AS document
FROM (SELECT lang, id, {_TOP} AS rank FROM m) WHERE rank <= 150 GROUP BY lang"""))
def sk3_main_feed(spark, sf_dir):
    """Feed documents; their articles are compared by id, in order."""
    rows = report.feed(dedupe.merge_by_id(articles(spark, sf_dir)), 150).select("lang", "rank", "id")
    docs = report.envelopes(rows, ["lang"], "now", "v1")
    ids = F.array_join(F.transform(F.from_json("document", "articles ARRAY<STRUCT<id: STRING>>")["articles"], lambda a: a["id"]), ",")
    return docs.select("lang", "count", F.concat(F.regexp_replace("document", r'"articles":.*$', '"ids":"'), ids, F.lit('"}')).alias("document"))


@query(with_articles("""SELECT seq, reason FROM (SELECT seq, CASE WHEN date_estimated THEN 1 WHEN image IS NULL THEN 2 END AS reason,
  row_number() OVER (PARTITION BY CASE WHEN date_estimated THEN 1 WHEN image IS NULL THEN 2 END ORDER BY published_iso DESC, seq) AS rk FROM a) WHERE reason = 1 OR (reason = 2 AND rk <= 250)"""))
def o3_enrich_worklist(spark, sf_dir):
    return select.worklist(articles(spark, sf_dir).withColumn("url", F.lit("https://a.example/x")), 250).select("seq", "reason")


@query("SELECT source AS source_id, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 40")
def o4_adapter_limits(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), "doc_id")
    return dedupe.top(rows, ["source_id"], ["doc_id"], 40).drop("rank")


@query("SELECT source_id, url, CAST(rank AS INT) AS rank FROM (SELECT 's' AS source_id, unnest(['https://a.example/x-news.xml', 'https://a.example/news-sitemap.xml', 'https://a.example/sitemap-news.xml', 'https://a.example/sitemap_news.xml', 'https://a.example/news.xml', 'https://a.example/map.xml', 'https://a.example/sitemap.xml']) AS url, unnest([1, 2, 3, 4, 5, 6, 7]) AS rank)")
def o6_sitemap_order(spark, sf_dir):
    from feedloom.sources.connectors import sitemap_candidates

    robots = "User-agent: *\nSitemap: https://a.example/map.xml\nsitemap: https://a.example/x-news.xml"
    return sitemap_candidates(spark.createDataFrame([("s", "https://a.example/", robots)], "source_id string, site string, body string"))


# -- Joins and state -----------------------------------------------------------------------------------------------------------------


@query(with_articles("SELECT DISTINCT id FROM a o WHERE seq % 2 = 1 AND NOT EXISTS (SELECT 1 FROM a p WHERE p.seq % 2 = 0 AND p.id = o.id)"))
def j4_new_articles(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return rows.filter("seq % 2 = 1").select("id").distinct().join(rows.filter("seq % 2 = 0").select("id"), "id", "left_anti")


def _registry(spark):
    rows = [(f"src{k}", f"https://src{k}.example/", "business" if k % 5 == 0 else "oops" if k % 7 == 0 else None, {"sport": "sports", "en": "international", "x": "none"}, k % 4 != 0) for k in range(20)]
    return spark.createDataFrame(rows, "id string, site string, category string, url_categories map<string,string>, enabled boolean")


@query(with_articles("SELECT seq FROM a WHERE CAST(substr(source_id, 4) AS INT) % 4 <> 0 AND seq % 5 <> 0"))
def j3_valid_previous(spark, sf_dir):
    """Rows of switched-off sources (every fourth) and of foreign hosts (every fifth row) go."""
    host = F.when(F.col("seq") % 5 == 0, F.concat("source_id", F.lit(".example.evil.example"))).otherwise(F.concat(F.lit("www."), "source_id", F.lit(".example")))
    rows = articles(spark, sf_dir).withColumn("url", F.concat(F.lit("https://"), host, F.lit("/a")))
    return select.valid_previous(rows, _registry(spark)).select("seq")


@query("SELECT page_id, CASE regexp_extract(url, '^https?://[^/]*/([a-z]+)', 1) WHEN 'en' THEN 'international' WHEN 'fr' THEN 'society' END AS section FROM pages")
def j2_url_section(spark, sf_dir):
    mapping = F.create_map(F.lit("en"), F.lit("international"), F.lit("fr"), F.lit("society"))
    return read(spark, sf_dir, "pages").select("page_id", select.section(F.col("url"), mapping).alias("section"))


@query(with_articles("""SELECT seq, coalesce(category, CASE WHEN seq % 3 = 0 THEN 'sports' END, CASE WHEN CAST(substr(source_id, 4) AS INT) % 5 = 0 THEN 'business' END) AS category FROM a"""))
def e3_category_precedence(spark, sf_dir):
    """Own category, then the URL's section, then the source's pin; unknown pins and mappings were taken out (F10)."""
    registry = select.valid_categories(_registry(spark), CATEGORIES)
    rows = articles(spark, sf_dir).withColumn("url", F.concat(F.lit("https://a.example/"), F.when(F.col("seq") % 3 == 0, "x/%73port").otherwise("y"), F.lit("/1")))
    return select.categorise(rows, registry).select("seq", "category")


_STATUS = "s AS (SELECT 'u' || (user_id % 50) AS source_id, count(*) FILTER (WHERE value > 95) AS n FROM events GROUP BY 1), p AS (SELECT 'u' || k AS source_id, '2024-01-0' || (k % 9 + 1) || 'T00:00:00Z' AS before FROM range(0, 50, 2) t(k)), f AS (SELECT source_id, n, CASE WHEN n > 10 THEN '2024-01-08T00:00:00Z' ELSE before END AS last_ok FROM s LEFT JOIN p USING (source_id))"


def _status(spark, sf_dir):
    status = read(spark, sf_dir, "events").groupBy(F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string")).alias("source_id")).agg(F.count_if(F.col("value") > 95).alias("n")).withColumn("ok", F.col("n") > 10)
    before = spark.range(0, 50, 2).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("source_id"), F.concat(F.lit("2024-01-0"), (F.col("id") % 9 + 1).cast("string"), F.lit("T00:00:00Z")).alias("last_ok"))
    return report.last_ok(status, before, "2024-01-08T00:00:00Z")


@query(f"WITH {_STATUS} SELECT source_id, n, last_ok FROM f")
def j5_last_ok_carry(spark, sf_dir):
    return _status(spark, sf_dir).select("source_id", "n", "last_ok")


@query(f"WITH {_STATUS} SELECT source_id FROM f WHERE last_ok IS NULL OR last_ok < '2024-01-06T00:00:00Z'")
def f12_dead_sources(spark, sf_dir):
    now = F.to_timestamp(F.lit("2024-01-08T00:00:00Z"))
    return report.dead(_status(spark, sf_dir), now).select("source_id")


@query(with_articles(f"""SELECT seq, coalesce(image, CASE WHEN seq % 4 = 0 THEN 'https://a.example/i.png' END) AS image, coalesce(excerpt, CASE WHEN seq % 4 = 0 THEN 'Page text' END) AS excerpt,
  CASE WHEN seq % 4 = 0 THEN '2024-01-05T00:00:00Z' ELSE published_iso END AS published_iso, seq % 4 <> 0 AND date_estimated AS date_estimated FROM a"""))
def j7_enrich_coalesce(spark, sf_dir):
    """Every fourth page has an image, a text and a date."""
    rows = articles(spark, sf_dir).withColumn("url", F.concat(F.lit("https://a.example/"), F.col("seq").cast("string")))
    facts = rows.filter("seq % 4 = 0").select("url", F.lit("https://a.example/i.png").alias("image"), F.lit("<p>Page  text</p>").alias("excerpt"), F.to_timestamp(F.lit("2024-01-05T00:00:00Z")).alias("published"))
    return select.enrich(rows, facts).select("seq", "image", "excerpt", dates.iso(F.col("published")).alias("published_iso"), "date_estimated")


_HALVES = "SELECT CASE WHEN seq % 2 = 1 THEN seq ELSE seq + 1000000000 END AS seq, id, source_id, lang, title, published, published_iso, image, excerpt, category, date_estimated, seq % 2 = 0 AS stale, NULL AS collected FROM a"


def _halves(spark, sf_dir):
    """Odd rows as this run's, even rows as the last snapshot's, which come after them and are stale."""
    rows = articles(spark, sf_dir)
    fresh = rows.filter("seq % 2 = 1").withColumn("stale", F.lit(False))
    return fresh.unionByName(rows.filter("seq % 2 = 0").withColumns({"stale": F.lit(True), "seq": F.col("seq") + 1_000_000_000}))


@query(with_merged("SELECT id, seq, published_iso, category, stale, first_seq FROM m, clock WHERE published >= now - INTERVAL 28 DAY - INTERVAL 12 HOUR", _HALVES))
def x1_merge_previous(spark, sf_dir):
    """Union with the last snapshot, dedupe, then retention."""
    merged = dedupe.merge_by_id(_halves(spark, sf_dir))
    now = F.timestamp_micros(F.unix_micros(run_ts(spark, sf_dir)) - 12 * 3_600_000_000)
    return select.retained(merged, now, 28).select("id", "seq", "published_iso", "category", "stale", "first_seq")


@query(with_merged("SELECT lang, id, n FROM (SELECT lang, id, row_number() OVER (PARTITION BY lang ORDER BY published_iso DESC, first_seq) AS n FROM m) WHERE n <= 150", _HALVES))
def run_language_feeds(spark, sf_dir):
    """A run in short: merge with the last snapshot, one of near-duplicate titles of a source within an hour, newest 150. The SQL has no step for titles."""
    merged = dedupe.drop_near_titles(dedupe.merge_by_id(_halves(spark, sf_dir)))
    return report.feed(merged, 150).select("lang", "id", F.col("rank").cast("long").alias("n"))


@query("SELECT lang, count(DISTINCT source) AS sources FROM documents GROUP BY lang")
def x3_distinct_sources(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.count_distinct("source").alias("sources"))


@query(with_merged("SELECT id, seq, published_iso, category, first_seq FROM m"))
def st3_stream_merge(spark, sf_dir):
    """Four micro-batches merged through the streaming state give what one batch gives."""
    import uuid

    from feedloom.streaming import merge

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="feedloom-")
    root = f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"
    rows = articles(spark, sf_dir)
    rows.repartition(4, "seq").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    running = merge.run(stream, f"{root}/state", f"{root}/offsets")
    running.processAllAvailable()
    running.stop()
    return merge.snapshot(spark, f"{root}/state").select("id", "seq", "published_iso", "category", "first_seq")


@query("SELECT k AS status, hint FROM (VALUES (403, 'this address is blocked'), (404, 'endpoint moved'), (200, 'almost empty: likely a challenge page')) t(k, hint)")
def sc19_endpoint_hint(spark, sf_dir):
    rows = spark.createDataFrame([(403, "Cloudflare", 900), (404, "nginx", 10), (200, "nginx", 10)], "status int, server string, size int")
    return rows.select("status", select.endpoint_hint(F.col("status"), F.col("server"), F.col("size"), F.lit(False), F.lit(False)).alias("hint"))


@query(f"SELECT adapter, CAST(rank AS INT) AS rank FROM (SELECT unnest([{', '.join(f"'{a}'" for a in ADAPTERS)}]) AS adapter, unnest([0, 1, 2, 3, 4, 5]) AS rank)")
def ud1_adapter_rank(spark, sf_dir):
    return spark.createDataFrame([(a,) for a in ADAPTERS], "adapter string").select("adapter", select.rank(F.col("adapter")).alias("rank"))


# -- Registry, reports, snapshots ------------------------------------------------------------------------------------------------------

_SOURCES = "src AS (SELECT 'src' || k AS id, 'https://src' || k || '.example' AS base, k FROM range(0, 20) t(k))"


@query(f"WITH {_SOURCES} SELECT id FROM src WHERE k % 4 <> 0")
def f1_enabled_sources(spark, sf_dir):
    return select.enabled(_registry(spark)).select("id")


@query("SELECT adapter, has, adapter NOT IN ('rss', 'html', 'newsfirst') OR has AS can FROM (SELECT unnest([%s]) AS adapter) a, (SELECT unnest([true, false]) AS has) b" % ", ".join(f"'{a}'" for a in ADAPTERS))
def f2_can_try(spark, sf_dir):
    rows = spark.createDataFrame([(a, h) for a in ADAPTERS for h in (True, False)], "adapter string, has boolean")
    return rows.withColumn("can", select.can_try(F.col("adapter"), dict.fromkeys(("feeds", "selectors", "api"), F.col("has"))))


@query(with_articles("SELECT seq, CASE WHEN seq % 6 = 0 THEN 'https://cdn.example/' || seq END AS image, source_id || '.example' AS source_domain FROM a WHERE seq % 5 <> 0"))
def f3_trusted(spark, sf_dir):
    """Every fifth row is on a foreign host; every second image is no valid URL."""
    host = F.when(F.col("seq") % 5 == 0, F.lit("evil.example")).otherwise(F.concat("source_id", F.lit(".example")))
    image = F.when(F.col("seq") % 6 == 0, F.concat(F.lit("https://cdn.example/"), F.col("seq").cast("string"))).otherwise(F.lit("file:///x"))
    rows = articles(spark, sf_dir).withColumns({"url": F.concat(F.lit("https://"), host, F.lit("/a")), "image": image})
    return select.trusted(rows, _registry(spark)).select("seq", "image", "source_domain")


@query(with_articles("SELECT seq FROM a, clock WHERE epoch_us(now) - epoch_us(published) <= 2502000000000"))
def f6_first_seen_fresh(spark, sf_dir):
    age = F.unix_micros(run_ts(spark, sf_dir)) - F.unix_micros("published")
    return articles(spark, sf_dir).filter(age <= 695 * 3_600_000_000).select("seq")


@query(f"WITH {_SOURCES} SELECT id, CASE WHEN k % 5 = 0 THEN 'business' END AS category, 2::BIGINT AS mapped FROM src")
def f10_valid_categories(spark, sf_dir):
    return select.valid_categories(_registry(spark), CATEGORIES).select("id", "category", F.size("url_categories").cast("long").alias("mapped"))


_PROBES = [("homepage", ""), ("wp-json", "/wp-json/wp/v2/posts?per_page=1"), ("feed", "/feed"), ("rss.xml", "/rss.xml"), ("rss.php", "/rss.php"), ("robots", "/robots.txt"), ("sitemap", "/sitemap.xml"), ("news-sm", "/news-sitemap.xml")]


@query(f"WITH {_SOURCES} SELECT id AS source_id, label, base || path AS url FROM src, (VALUES {', '.join(f"('{a}', '{b}')" for a, b in _PROBES)}) p(label, path)")
def sc20_probe_paths(spark, sf_dir):
    return select.probe_paths(_registry(spark))


@query(with_articles("SELECT lang, count(*) AS total FROM a GROUP BY lang"))
def g4_lang_totals(spark, sf_dir):
    return report.lang_totals(articles(spark, sf_dir))


@query(with_articles("SELECT count(*) AS n, count(*) FILTER (WHERE seq % 4 = 0 AND image IS NULL) AS images, count(*) FILTER (WHERE seq % 4 = 0 AND excerpt IS NULL) AS excerpts, count(*) FILTER (WHERE seq % 4 = 0 AND date_estimated) AS dates FROM a"))
def g8_enrich_tallies(spark, sf_dir):
    rows = articles(spark, sf_dir).withColumn("url", F.concat(F.lit("https://a.example/"), F.col("seq").cast("string")))
    facts = rows.filter("seq % 4 = 0").select("url", F.lit("https://a.example/i.png").alias("image"), F.lit("Page text").alias("excerpt"), F.to_timestamp(F.lit("2024-01-05T00:00:00Z")).alias("published"))
    return report.enrich_tallies(rows, select.enrich(rows, facts))


@query("SELECT count(*) FILTER (WHERE page_id % 3 = 0) AS unresolved FROM pages")
def g11_unresolved_links(spark, sf_dir):
    link = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://news.google.com/rss/articles/"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    return read(spark, sf_dir, "pages").agg(F.count_if(U.is_search_link(link)).alias("unresolved"))


@query(with_articles("SELECT seq, row_number() OVER (ORDER BY published_iso DESC, seq) AS place FROM a"))
def o1_feed_order(spark, sf_dir):
    """Text order of ISO times, newest first, ties by arrival: the whole order, by places within a minute and counts of the minutes before it."""
    from pyspark.sql import Window

    rows = articles(spark, sf_dir).select("seq", "published_iso", F.substring("published_iso", 1, 16).alias("minute"))
    newer = Window.orderBy(F.desc("minute")).rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("minute").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(newer), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("minute").orderBy(F.desc("published_iso"), F.asc("seq")))
    return rows.withColumn("k", inside).join(before, "minute").select("seq", (F.col("before") + F.col("k")).alias("place"))


@query(with_articles("SELECT o.seq, least(o.published_iso, coalesce(min(p.published_iso), o.published_iso), min(q.published_iso)) AS collected_iso FROM a o LEFT JOIN a p ON p.id = o.id AND p.seq % 2 = 0 JOIN a q ON q.id = o.id AND q.seq % 2 = 1 WHERE o.seq % 2 = 1 GROUP BY o.seq, o.published_iso"))
def st1_first_seen(spark, sf_dir):
    rows = articles(spark, sf_dir).withColumn("collected_iso", F.col("published_iso"))
    return select.first_seen(rows.filter("seq % 2 = 0"), rows.filter("seq % 2 = 1")).select("seq", "collected_iso")


@query(f"WITH {_SOURCES} SELECT count(*) AS n, string_agg(id || ' ' || base, ',' ORDER BY id) AS listed FROM src")
def sk5_sources_document(spark, sf_dir):
    """The public list of sources, read back from its JSON."""
    doc = F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("id", F.regexp_replace("site", "/$", "").alias("site")))).alias("sources")))
    back = F.from_json("document", "sources ARRAY<STRUCT<id: STRING, site: STRING>>")["sources"]
    got = _registry(spark).agg(doc.alias("document")).withColumn("s", back)
    return got.select(F.size("s").cast("long").alias("n"), F.array_join(F.transform("s", lambda x: F.concat(x["id"], F.lit(" "), x["site"])), ",").alias("listed"))


@query(f"WITH {_STATUS} SELECT count(*) FILTER (WHERE n > 10) AS sources_ok, count(*) AS sources_total, coalesce(string_agg(source_id, ',' ORDER BY source_id) FILTER (WHERE n > 30), '') AS stale_sources FROM f")
def sk6_run_report(spark, sf_dir):
    """The run's report, read back from its JSON."""
    status = _status(spark, sf_dir).withColumns({"used_fallback": F.lit(None).cast("string"), "stale_content": F.col("n") > 30})
    back = F.from_json("document", "sources_ok BIGINT, sources_total BIGINT, stale_sources ARRAY<STRING>")
    return report.run_report(status, "now").select(back.alias("r")).select("r.sources_ok", "r.sources_total", F.array_join("r.stale_sources", ",").alias("stale_sources"))


@query("""SELECT * FROM (VALUES ('en', NULL, 'new'), ('fr', NULL, 'old'), ('fr', 'sports', 'old sports'), ('fr', 'tech', '{"version":"v1","lang":"fr","category":"tech","generated":"then","count":0,"articles":[]}')) t(lang, category, document)""")
def sk7_preserved_documents(spark, sf_dir):
    """English is new; French is kept from the last snapshot, which has no document for tech; nothing is kept for German."""
    new = spark.createDataFrame([("en", None, "new")], "lang string, category string, document string")
    old = spark.createDataFrame([("fr", None, "then", "old"), ("fr", "sports", "then", "old sports"), ("en", None, "then", "older")], "lang string, category string, generated string, document string")
    kept = spark.createDataFrame([("fr",), ("de",)], "lang string")
    return report.preserved(new, old, kept, ["sports", "tech"], "v1")


_ALL_CATEGORIES = ", ".join(f"'{c}'" for c in CATEGORIES)


@query(with_merged(f"""SELECT l.lang, c.category, count(f.id) AS count, coalesce(string_agg(f.id, ',' ORDER BY f.rank), '') AS ids
FROM (SELECT DISTINCT lang FROM m UNION SELECT 'xx') l CROSS JOIN (SELECT unnest([{_ALL_CATEGORIES}]) AS category) c
LEFT JOIN (SELECT lang, category, id, row_number() OVER (PARTITION BY lang, category ORDER BY published_iso DESC, first_seq) AS rank FROM m) f ON f.lang = l.lang AND f.category = c.category AND f.rank <= 150
GROUP BY 1, 2"""))
def sk4_category_documents(spark, sf_dir):
    """The documents of all categories, empty ones included, read back; a language without any article has them too."""
    merged = dedupe.merge_by_id(articles(spark, sf_dir))
    langs = merged.select("lang").distinct().union(spark.createDataFrame([("xx",)], "lang string"))
    docs = report.category_documents(merged, langs, CATEGORIES, 150, "now", "v1")
    back = F.from_json("document", "lang STRING, category STRING, count BIGINT, articles ARRAY<STRUCT<id: STRING>>")
    return docs.select(back.alias("d")).select("d.lang", "d.category", "d.count", F.array_join(F.transform("d.articles", lambda a: a["id"]), ",").alias("ids"))


_VERDICTS = """SELECT k.case, n > 0 AND shown > 0 AS accepted, array_to_string(list_filter([CASE WHEN n = 0 THEN 'No articles were fetched from any source this run' END, CASE WHEN shown = 0 THEN 'No language has publishable or preserved content' END], lambda x: x IS NOT NULL), ';') AS errors
FROM (SELECT 'day' AS case, (SELECT count(*) FROM a) AS n, (SELECT count(DISTINCT lang) FROM a) AS shown UNION ALL SELECT 'outage', 0, (SELECT count(DISTINCT lang) FROM a)
UNION ALL SELECT 'weak', (SELECT count(*) FROM a), 0 UNION ALL SELECT 'nothing', 0, 0) k"""


@query(with_articles(_VERDICTS))
def g12_run_acceptance(spark, sf_dir):
    """A day with rows, one without any fetched row, one with all languages below the bar and no snapshot, and one with both."""
    rows = articles(spark, sf_dir).withColumn("collected_at", F.lit(None).cast("timestamp"))
    previous, none = rows.select("lang").distinct().withColumn("generated", F.lit("2024-01-01T00:00:00Z")), rows.limit(0)
    kept = report.states(report.gate(rows, run_ts(spark, sf_dir), 1e5, 200, 1), previous)
    weak = report.states(report.gate(rows, run_ts(spark, sf_dir), 1e5, 1 << 30, 1), previous.limit(0))
    cases = {"day": (rows, kept), "outage": (none, kept), "weak": (rows, weak), "nothing": (none, weak)}
    parts = [report.verdict(fetched, states).select(F.lit(name).alias("case"), "accepted", F.array_join("errors", ";").alias("errors")) for name, (fetched, states) in cases.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(with_articles("""SELECT lang, state, CASE WHEN state = 'updated' THEN 'now' WHEN state = 'preserved' THEN made END AS snapshot_generated,
  CASE WHEN state = 'preserved' THEN floor((epoch_us(now) - epoch_us(CAST(made AS TIMESTAMP))) / 360000000.0 + 0.5) / 10 END AS snapshot_age_hours
FROM (SELECT lang, CASE WHEN lang <> 'es' THEN '2023-12-3' || (length(lang) - 2) || 'T07:11:00' END AS made, CASE WHEN count(*) >= 200 THEN 'updated' WHEN lang = 'es' THEN 'unavailable' ELSE 'preserved' END AS state FROM a GROUP BY lang), clock"""))
def st5_snapshot_age(spark, sf_dir):
    """When each language's snapshot was made, and the age of kept ones."""
    rows = articles(spark, sf_dir).withColumn("collected_at", F.lit(None).cast("timestamp"))
    made = F.concat(F.lit("2023-12-3"), (F.length("lang") - 2).cast("string"), F.lit("T07:11:00"))
    previous = rows.select("lang").distinct().filter("lang <> 'es'").withColumn("generated", made)
    states = report.states(report.gate(rows, run_ts(spark, sf_dir), 1e5, 200, 1), previous)
    return report.snapshot_ages(states, run_ts(spark, sf_dir), "now").select("lang", "state", "snapshot_generated", "snapshot_age_hours")


@query(f"WITH {_STATUS} SELECT source_id, floor((epoch_us(TIMESTAMP '2024-01-08 05:20:00') - epoch_us(CAST(replace(last_ok, 'Z', '') AS TIMESTAMP))) / 360000000.0 + 0.5) / 10 AS hours_since_ok FROM f")
def st5_hours_since_ok(spark, sf_dir):
    return report.hours_since_ok(_status(spark, sf_dir), F.to_timestamp(F.lit("2024-01-08T05:20:00Z"))).select("source_id", "hours_since_ok")


@query(f"""WITH {_CANDIDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY usable DESC, CASE WHEN usable THEN 0 ELSE n END DESC, place) AS rk FROM k)
SELECT source_id, (SELECT max(adapter) FROM k p WHERE p.is_primary AND p.source_id = r.source_id) AS primary_adapter, CASE WHEN is_primary THEN usable ELSE n >= 3 END AS ok,
  CASE WHEN is_primary AND NOT usable THEN 'stale/unverified only' WHEN NOT is_primary AND n < 3 THEN 'primary blocked/stale; ' || adapter || ' returned only ' || n || ' article(s)' END AS error,
  CASE WHEN NOT is_primary THEN adapter END AS used_fallback FROM r WHERE rk = 1""")
def e5_ladder_result(spark, sf_dir):
    """What the ladder reports of each source: whether it is ok, why not, and the alternative that served."""
    return select.ladder(_candidates(spark, sf_dir), F.lit(100.0)).select("source_id", "primary_adapter", "ok", "error", "used_fallback")


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url ELSE 'https://news.google.com/rss/articles/' || page_id END AS url FROM pages""")
def sc15_resolved_links(spark, sf_dir):
    """Search links of all pages; every fourth is resolved to its page, every fourth after that to a foreign host, which does not count."""
    pages = read(spark, sf_dir, "pages")
    link = F.concat(F.lit("https://news.google.com/rss/articles/"), F.col("page_id").cast("string"))
    resolved = pages.filter("page_id % 4 < 2").select(link.alias("url"), F.when(F.col("page_id") % 4 == 0, F.col("url")).otherwise(F.lit("https://evil.example/x")).alias("resolved"))
    from feedloom.sources.connectors import resolve_links

    return resolve_links(pages.select("page_id", link.alias("url"), U.domain(F.col("url")).alias("source_domain")), resolved).select("page_id", "url")


@query(with_articles("""SELECT s.lang, count(*) FILTER (WHERE n > 5) AS ok, count(*) AS sources, t.total FROM (SELECT lang, source_id, count(*) AS n FROM a GROUP BY ALL) s
JOIN (SELECT lang, count(*) AS total FROM a GROUP BY lang) t USING (lang) GROUP BY s.lang, t.total"""))
def g7_languages_ok(spark, sf_dir):
    rows = articles(spark, sf_dir)
    status = rows.groupBy("lang", "source_id").agg((F.count("*") > 5).alias("ok"))
    return report.languages_ok(status, report.lang_totals(rows))
