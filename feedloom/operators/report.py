"""Aggregates over articles and sources, the language gate, and feed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.dedupe import top


def verified_age(now: Column) -> Column:
    """Age in microseconds of a verified date, null for an estimated one."""
    return F.when(~F.col("date_estimated"), F.unix_micros(now) - F.unix_micros("published"))


def freshness(rows: DataFrame, key: str, now: Column, window_hours: float) -> DataFrame:
    """Per key: rows, verified rows within the window, the least verified age in microseconds (null if none)."""
    age = verified_age(now)
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.coalesce(age <= int(window_hours * 3.6e9), F.lit(False))).alias("fresh"), F.min(age).alias("freshest_micros"))


def source_freshness(items: DataFrame, previous: DataFrame, merged: DataFrame, now: Column, max_age_hours: float) -> DataFrame:
    """Per source: new ids, the newest verified date not ahead of now in merged rows, its age, staleness, estimated dates among the items."""
    new = items.select("source_id", "id").distinct().join(previous.select("source_id", "id").distinct(), ["source_id", "id"], "left_anti").groupBy("source_id").agg(F.count("*").alias("new_articles"))
    newest = merged.filter(~F.col("date_estimated") & (F.col("published") <= now)).groupBy("source_id").agg(F.max("published").alias("newest"))
    counts = items.groupBy("source_id").agg(F.count("*").alias("n"), F.count_if("date_estimated").alias("estimated_dates"))
    age = F.unix_micros(now) - F.unix_micros("newest")
    return counts.join(new, "source_id", "left").join(newest, "source_id", "left").select(
        "source_id", "n", F.coalesce("new_articles", F.lit(0)).alias("new_articles"), F.col("newest"), age.alias("age_micros"),
        F.coalesce(age > int(max_age_hours * 3.6e9), F.lit(True)).alias("stale_content"), "estimated_dates")


def gate(rows: DataFrame, now: Column, hours: float, min_fresh: int, min_sources: int) -> DataFrame:
    """Per language: candidates, first-seen-fresh candidates and their sources, and whether they reach the bar."""
    fresh = F.unix_micros(now) - F.unix_micros(F.coalesce("collected_at", "published")) <= int(hours * 3.6e9)
    got = rows.groupBy("lang").agg(F.count("*").alias("total_candidates"), F.count_if(fresh).alias("fresh_candidates"), F.count_distinct(F.when(fresh, F.col("source_id"))).alias("fresh_sources"))
    return got.withColumn("passes", (F.col("fresh_candidates") >= min_fresh) & (F.col("fresh_sources") >= min_sources))


def states(gated: DataFrame, previous: DataFrame) -> DataFrame:
    """updated, preserved or unavailable: previous has lang and generated of the last snapshot."""
    state = F.when(F.col("passes"), "updated").when(F.col("generated").isNotNull(), "preserved").otherwise("unavailable")
    return gated.join(previous.select("lang", "generated"), "lang", "left").withColumn("state", state)


def scaffold(langs: DataFrame, categories) -> DataFrame:
    """A row per language and category, also for those without articles."""
    return langs.select("lang", F.explode(F.array(*map(F.lit, categories))).alias("category"))


def category_counts(rows: DataFrame, categories) -> DataFrame:
    """Articles per language and category, zeros included."""
    counts = rows.filter(F.col("category").isin(*categories)).groupBy("lang", "category").agg(F.count("*").alias("n"))
    return scaffold(rows.select("lang").distinct(), categories).join(counts, ["lang", "category"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def newest_first():
    return [F.desc("published_iso"), F.asc("first_seq")]


def feed(rows: DataFrame, n: int) -> DataFrame:
    """The n newest rows per language."""
    return top(rows, ["lang"], newest_first(), n)


def category_feeds(rows: DataFrame, categories, n: int) -> DataFrame:
    """The n newest rows per language and category, from all merged rows."""
    return top(rows.filter(F.col("category").isin(*categories)), ["lang", "category"], newest_first(), n)


PUBLIC = ["id", "source_id", "source_name", "lang", "title", "url", "published_iso", "excerpt", "image", "category", "date_estimated", "collected_iso"]


def article_json(rows: DataFrame) -> Column:
    """A row as its public JSON object: null fields and internal ones are left out."""
    names = {"published_iso": "published", "collected_iso": "collected_at"}
    return F.to_json(F.struct(*[F.col(c).alias(names.get(c, c)) for c in PUBLIC if c in rows.columns]))


def envelopes(rows: DataFrame, keys: list[str], generated: str, version: str) -> DataFrame:
    """A feed document per key from ranked rows: version, keys, generated, count, articles in order of rank (bounded by the feed's size)."""
    packed = rows.withColumn("_json", article_json(rows)).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "_json"))).alias("xs"), F.count("*").alias("count"))
    head = F.to_json(F.struct(F.lit(version).alias("version"), *keys, F.lit(generated).alias("generated"), "count"))
    body = F.array_join(F.transform("xs", lambda x: x["_json"]), ",")
    return packed.select(*keys, "count", F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"articles":['), body, F.lit("]}")).alias("document"))


def category_documents(rows: DataFrame, langs: DataFrame, categories, n: int, generated: str, version: str) -> DataFrame:
    """A document for every language and category (lang, category, count, document): the n newest rows, and an empty list where there are none."""
    full = envelopes(category_feeds(rows, categories, n), ["lang", "category"], generated, version)
    blank = F.to_json(F.struct(F.lit(version).alias("version"), "lang", "category", F.lit(generated).alias("generated"), F.lit(0).alias("count"), F.array().cast("array<string>").alias("articles")))
    got = scaffold(langs, categories).join(full, ["lang", "category"], "left")
    return got.select("lang", "category", F.coalesce("count", F.lit(0)).cast("long").alias("count"), F.coalesce("document", blank).alias("document"))


def hours(micros: Column) -> Column:
    """Hours to one decimal."""
    return F.floor(micros / 3.6e8 + 0.5) / 10


def snapshot_ages(states: DataFrame, now: Column, generated: str) -> DataFrame:
    """Adds when a language's shown snapshot was made (this run's time if updated) and, for preserved ones, its age in hours; a time that can't be read has none."""
    made = F.try_to_timestamp("generated")
    age = F.when(F.col("state") == "preserved", hours(F.unix_micros(now) - F.unix_micros(made)))
    return states.withColumns({"snapshot_generated": F.when(F.col("state") == "updated", F.lit(generated)).otherwise(F.col("generated")), "snapshot_age_hours": age})


def hours_since_ok(status: DataFrame, now: Column) -> DataFrame:
    """Adds the hours since a source last gave rows, null for never."""
    return status.withColumn("hours_since_ok", hours(F.unix_micros(now) - F.unix_micros(F.try_to_timestamp("last_ok"))))


def verdict(fetched: DataFrame, states: DataFrame) -> DataFrame:
    """One row: whether the run is accepted, and the errors if not. A run without any fetched row, or without a language to show, is none."""
    some = fetched.limit(1).agg((F.count("*") > 0).alias("some"))
    shown = states.agg(F.count_if(F.col("state") != "unavailable").alias("shown"))
    errors = F.array_compact(F.array(
        F.when(~F.col("some"), F.lit("No articles were fetched from any source this run")),
        F.when(F.col("shown") == 0, F.lit("No language has publishable or preserved content"))))
    return some.join(F.broadcast(shown)).select((F.size(errors) == 0).alias("accepted"), errors.alias("errors"))


def languages_ok(status: DataFrame, totals: DataFrame) -> DataFrame:
    """Per language: sources that are ok, sources in all, rows."""
    got = status.groupBy("lang").agg(F.count_if("ok").alias("ok"), F.count("*").alias("sources"))
    return got.join(totals, "lang", "left").select("lang", "ok", "sources", F.coalesce("total", F.lit(0)).alias("total"))


def thin(totals: DataFrame, share: float = 0.35) -> DataFrame:
    """Languages with less than a share of the largest total."""
    return totals.withColumn("largest", F.max("total").over(Window.partitionBy())).withColumn("thin", F.col("total") < share * F.col("largest"))


def last_ok(status: DataFrame, previous: DataFrame, now_iso: str) -> DataFrame:
    """When a source last gave rows: now if it did, else what the last report said."""
    return status.join(previous.select("source_id", F.col("last_ok").alias("_before")), "source_id", "left").withColumn("last_ok", F.when(F.col("ok") & (F.col("n") > 0), F.lit(now_iso)).otherwise(F.col("_before"))).drop("_before")


def dead(status: DataFrame, now: Column, hours: int = 48) -> DataFrame:
    """Sources without rows for over so many hours, or ever."""
    age = F.unix_micros(now) - F.unix_micros(F.try_to_timestamp("last_ok"))
    return status.filter(age.isNull() | (age > hours * 3_600_000_000))


def lang_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang").agg(F.count("*").alias("total"))


def enrich_tallies(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many rows gained an image, an excerpt and a verified date; rows are matched by seq."""
    lacks = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    old = before.select("seq", lacks("image").alias("_i"), lacks("excerpt").alias("_e"), F.col("date_estimated").alias("_d"))
    return after.join(old, "seq").agg(F.count("*").alias("n"), F.count_if(F.col("_i") & ~lacks("image")).alias("images"), F.count_if(F.col("_e") & ~lacks("excerpt")).alias("excerpts"), F.count_if(F.col("_d") & ~F.col("date_estimated")).alias("dates"))


def preserved(documents: DataFrame, previous: DataFrame, langs_kept: DataFrame, categories, version: str) -> DataFrame:
    """The documents to publish (lang, category or null, document): new ones, and for kept languages those of the last snapshot.

    previous has lang, category, generated and document. A kept language lists every category: one without a document gets an empty one of the snapshot's own time.
    """
    feeds = previous.filter("category IS NULL").join(langs_kept, "lang", "left_semi")
    wanted = feeds.select("lang", "generated", F.explode(F.array(*map(F.lit, categories))).alias("category"))
    old = previous.filter("category IS NOT NULL").select("lang", "category", F.col("document").alias("_old"))
    blank = F.to_json(F.struct(F.lit(version).alias("version"), "lang", "category", "generated", F.lit(0).alias("count"), F.array().cast("array<string>").alias("articles")))
    filled = wanted.join(old, ["lang", "category"], "left").select("lang", "category", F.coalesce("_old", blank).alias("document"))
    return documents.select("lang", "category", "document").unionByName(feeds.select("lang", F.lit(None).cast("string").alias("category"), "document")).unionByName(filled)


def run_report(status: DataFrame, generated: str) -> DataFrame:
    """One JSON document: sources ok and in all, ids of sources on fallback and stale ones (sorted), and a detail per source."""
    ids = lambda cond: F.array_sort(F.array_compact(F.collect_list(F.when(cond, F.col("source_id")))))
    detail = F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_id", F.struct("ok", "n")))))
    got = status.agg(F.count_if(F.col("ok")).alias("sources_ok"), F.count("*").alias("sources_total"), ids(F.col("used_fallback").isNotNull()).alias("on_fallback"), ids(F.col("stale_content")).alias("stale_sources"), detail.alias("detail"))
    return got.select(F.to_json(F.struct(F.lit(generated).alias("generated"), "*")).alias("document"))
