"""Edge cases of the column functions, and the operators against plain folds."""

import hashlib
import random
import re
from datetime import datetime, timedelta, timezone
from urllib.parse import parse_qsl, urlencode, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from feedloom.functions import dates, text
from feedloom.functions import url as U
from feedloom.functions.terms import JUNK_PARAMS
from feedloom.operators import dedupe, report, select
from feedloom.sources import dom
from feedloom.streaming.merge import publish

NOW = datetime(2026, 3, 10, 12, tzinfo=timezone.utc)


def values(spark, column, items):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(items)], "k int, x string")
    return [r[0] for r in df.select("k", column(F.col("x")).alias("y")).orderBy("k").select("y").collect()]


def now():
    return F.to_timestamp(F.lit("2026-03-10 12:00:00"))


def test_valid_urls(spark):
    good = ["https://a.example/x", "http://A.Example:80/", "https://a.example:443", "https://93.184.216.34/x", "https://127.1/x", "https://[2606:2800:220:1::1]/"]
    bad = ["ftp://a.example", "https://u@a.example", "https://@a.example", "https://a.example:81/", "https://localhost/", "https://x.internal/", "https://10.0.0.1/", "https://192.168.1.1/", "https://[::1]/", "https://a b.example/", "https://a.example/ ", "https://a.example\\x", "https://a.example/\n", "", "/x", None]
    assert values(spark, U.valid, good) == [True] * len(good)
    assert values(spark, U.valid, bad) == [False] * len(bad)
    own = lambda u: U.valid(u, F.array(F.lit("www.A.example.")))
    assert values(spark, own, ["https://a.example/", "https://www.a.example/", "https://a.example.evil.example/", "https://xa.example/"]) == [True, True, False, False]
    assert values(spark, lambda u: U.valid(u, F.array().cast("array<string>")), ["https://a.example/"]) == [False]


def canonical(url):
    p = urlparse(url)
    kept = [(k, v) for k, v in parse_qsl(p.query) if k.lower() not in JUNK_PARAMS]
    return f"https://{p.netloc.lower()}{p.path.rstrip('/') or '/'}" + (f"?{urlencode(kept)}" if kept else "")


def test_canonical_urls(spark):
    urls = ["http://A.lk:80/a//", "https://www.a.lk/a;v=1?b=2&UTM_Source=x&b=1&c=#f", "https://a.lk/?q=a+b%20c&t=~*", "https://a.lk", "https://a.lk/?ref=1&s=2&amp=3", "https://a.lk/x?y"]
    found = values(spark, U.canonical, urls)
    assert found == [canonical(u) for u in urls]
    assert values(spark, U.canonical, ["https://localhost/", None]) == [None, None]
    keys = [u.replace("https://www.", "https://") for u in found]
    assert values(spark, U.dedupe_key, urls) == keys
    assert values(spark, U.article_id, urls) == [hashlib.sha1(k.encode()).hexdigest()[:16] for k in keys]


@pytest.mark.parametrize("base", ["https://a.example/b/c/d?x=1", "https://a.example"])
def test_join(spark, base):
    refs = ["https://z.example/q", "//cdn.example/y", "/r/s", "e", "../e", "./e?f=1", "../../../g", "h/", ".."]
    assert values(spark, lambda r: U.join(F.lit(base), r), refs) == [urljoin(base, r) for r in refs]


def test_encode_path(spark):
    urls = ["https://a.example/New Project (2).jpg", "https://a.example/%E0%B6%9A b", "https://a.example/ක?q=a b#f"]
    first = values(spark, U.encode_path, urls)
    assert first == ["https://a.example/New%20Project%20%282%29.jpg", "https://a.example/%E0%B6%9A%20b", "https://a.example/%E0%B6%9A?q=a%20b"]
    assert values(spark, U.encode_path, first) == first


def test_clean_text(spark):
    items = ["<p>One <b>two</b></p><nav>menu</nav><div class='x share'>s</div>", "a &amp;lt; b &#8211; &#x41;", "  ", None, "w" * 50 + " " + "v" * 300, "a, b, " * 60]
    found = values(spark, text.clean, items)
    assert found[:4] == ["One two", "a &lt; b – A", None, None]
    assert found[4] == "w" * 50 + "…"
    assert found[5] == ("a, b, " * 60)[:220].rsplit(" ", 1)[0].rstrip(",") + "…"


def test_terms(spark):
    assert values(spark, text.normalise_term, [" Sci​-Tech ", "ක්‍රී​ඩා", "A &amp;  B", "", None]) == ["sci-tech", "ක්‍රීඩා", "a & b", None, None]
    df = spark.createDataFrame([(["Latest", None, "World", "Sports"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(text.category_of(F.col("t"))).collect()] == ["international", None]
    assert values(spark, text.title_key, ["Ab-C d_1!", "!!!", "தமிழ் x"]) == ["abcd_1", "", re.sub(r"\W+", "", "தமிழ் x")]


def test_local_dates(spark):
    found = values(spark, lambda t: dates.iso(dates.local_date(t)), ["2026 සැප්තැම්බර් 12 | ප.ව. 06:34", "12 செப்டம்பர் 2026", "2026 මැයි 3 පෙ.ව. 12.05", "2026 September 12", "2026 මැයි 45", "මැයි 3"])
    assert found == ["2026-09-12T13:04:00Z", "2026-09-11T18:30:00Z", "2026-05-02T18:35:00Z", None, None, None]


def test_relative_and_bounds(spark):
    iso = lambda t: dates.iso(dates.to_instant(t, now()))
    found = values(spark, iso, ["5 hours ago", "an hour ago", "Chicago", "yesterday", "just now", "2026-03-12T12:00:00Z", "2026-03-12T12:00:01Z", "2025-02-03T12:00:00Z", "2025-02-03T11:59:59Z", "2026-03-10 09:00:00.25", "Tue, 10 Mar 2026 09:00:00 +0530", "nonsense", None])
    assert found == ["2026-03-10T07:00:00Z", "2026-03-10T11:00:00Z", None, "2026-03-09T12:00:00Z", "2026-03-10T12:00:00Z", "2026-03-12T12:00:00Z", None, "2025-02-03T12:00:00Z", None, "2026-03-10T03:30:00.250000Z", "2026-03-10T03:30:00Z", None, None]


SCHEMA = "seq long, id string, source_id string, lang string, title string, published timestamp, published_iso string, collected_iso string, image string, excerpt string, category string, date_estimated boolean, stale boolean"


def random_articles(seed, n=400):
    rng, out = random.Random(seed), []
    for k in range(n):
        at = NOW - timedelta(minutes=rng.randrange(600))
        iso = at.strftime("%Y-%m-%dT%H:%M:%SZ")
        out.append((k, f"i{rng.randrange(90)}", f"s{rng.randrange(3)}", "en", f"Title {rng.randrange(6)}", at.replace(tzinfo=None), iso, rng.choice([None, "", iso]), rng.choice([None, "", "i"]), rng.choice([None, "e"]), rng.choice([None, "", "a", "b"]), rng.random() < 0.5, rng.random() < 0.5))
    return out


def merged(rows):
    """Id-dedupe by groups: the best row, the least dates where several rows or estimates ask for them, the category of the last best row that has one."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    groups = {}
    for r in sorted(rows):
        a = dict(zip(names, r, strict=True))
        groups.setdefault(a["id"], []).append(a)
    out = {}
    for i, group in groups.items():
        worth = [8 * (not a["date_estimated"]) + 4 * (not a["stale"]) + bool(a["image"]) + bool(a["excerpt"]) for a in group]
        at = worth.index(max(worth))
        leads = [k for k in range(len(group)) if all(worth[j] < worth[k] for j in range(k))]
        own = [group[k]["category"] for k in leads if group[k]["category"]]
        any_ = [a["category"] for a in group if a["category"]]
        several, best = len(group) > 1, group[at]
        published = min(a["published_iso"] for a in group) if several and best["date_estimated"] else best["published_iso"]
        sight = min(a["collected_iso"] or a["published_iso"] for a in group) if several else best["collected_iso"]
        out[i] = (best["seq"], own[-1] if own else any_[0] if any_ else None, published, sight, group[0]["seq"])
    return out


def test_merge_by_id_is_the_fold(spark):
    for seed in (1, 2, 3):
        rows = random_articles(seed)
        out = dedupe.merge_by_id(spark.createDataFrame(rows, SCHEMA)).collect()
        assert {r.id: (r.seq, r.category, r.published_iso, r.collected_iso, r.first_seq) for r in out} == merged(rows)


def test_near_titles_is_the_walk(spark):
    merged = dedupe.merge_by_id(spark.createDataFrame(random_articles(4), SCHEMA))
    rows = sorted(merged.collect(), key=lambda r: r.first_seq)
    kept, last = set(), {}
    for r in sorted(rows, key=lambda r: r.published_iso, reverse=True):
        key = (r.source_id, re.sub(r"\W+", "", r.title.lower())[:60])
        if key in last and abs((last[key] - r.published).total_seconds()) < 3600:
            continue
        last[key] = r.published
        kept.add(r.id)
    assert {r.id for r in dedupe.drop_near_titles(merged).collect()} == kept


def test_exact_distance_is_kept(spark):
    rows = [(1, "k", 0), (2, "k", 3_599_000_000), (3, "k", 3_600_000_000), (4, "j", 5)]
    out = dedupe.drop_near(spark.createDataFrame(rows, "n int, key string, at long"), ["key"], "at", [F.asc("at")], 3600).collect()
    assert {r.n for r in out} == {1, 3, 4}


def test_ladder(spark):
    rows = [
        ("a", "rss", True, 9, 10.0), ("a", "html", False, 50, 1.0), ("b", "rss", True, 9, 90.0), ("b", "sitemap", False, 1, 5.0), ("b", "html", False, 40, 2.0), ("c", "rss", True, 9, None), ("c", "sitemap", False, 9, None), ("d", "rss", True, 0, None), ("d", "html", False, 2, 60.0),
        ("e", "rss", True, 0, None), ("f", "rss", True, 1, 99.0), ("f", "html", False, 5, 99.0),
    ]
    df = spark.createDataFrame([(*r[:3], True, *r[3:]) for r in rows], "source_id string, adapter string, is_primary boolean, fallback boolean, n long, freshest_hours double").withColumn("rank", select.rank(F.col("adapter")))
    got = {r.source_id: (r.adapter, r.ok, r.error, r.used_fallback) for r in select.ladder(df, F.lit(48.0)).collect()}
    assert got == {"a": ("rss", True, None, None), "b": ("sitemap", False, "primary blocked/stale; sitemap returned only 1 article(s)", "sitemap"), "c": ("rss", False, "stale/unverified only", None), "d": ("html", False, "primary blocked/stale; html returned only 2 article(s)", "html"), "e": ("rss", False, "0 articles", None), "f": ("html", True, None, "html")}


def test_envelope_and_publish(spark, tmp_path):
    rows = spark.createDataFrame([("en", 1, "i1", 'A "q"', None), ("en", 2, "i2", "B", "x")], "lang string, rank int, id string, title string, image string")
    doc = report.envelopes(rows, ["lang"], "2026-03-10T12:00:00Z", "v1").first().document
    assert doc == '{"version":"v1","lang":"en","generated":"2026-03-10T12:00:00Z","count":2,"articles":[{"id":"i1","lang":"en","title":"A \\"q\\""},{"id":"i2","lang":"en","title":"B","image":"x"}]}'
    target = str(tmp_path / "out")
    publish({"a.json": "1", "b.json": "2"}, target)
    publish({"a.json": "3"}, target)
    assert (tmp_path / "out" / "a.json").read_text() == "3" and not (tmp_path / "out" / "b.json").exists()


def test_selectors():
    root = dom.parse("<div id=m><ul class='a b'><li><a href='/x'>1</a><li data-k=v>2</ul><p>t<p>u</div>")
    assert [e.text() for e in root.select("#m > ul.a.b li")] == ["1", "2"]
    assert root.first("li[data-k=v]").text() == "2" and root.first("a[href^='/']").get("href") == "/x"
    assert [e.text() for e in root.select("p, a")] == ["1", "t", "u"] and root.first("div > a") is None


def test_run_drops_near_titles(spark, tmp_path):
    from feedloom.plans.queries import run_language_feeds

    title = "The same headline " * 5
    # (text, source, minute): all of one source and title within an hour of the newest kept one go.
    rows = [(title + "one", "a", 0), (title + "two", "a", 50), (title + "three", "a", 100), (title + "four", "a", 110), (title + "five", "b", 105), ("Another headline", "a", 108)]
    docs = [(k, text, "en", source, len(text)) for k, (text, source, _) in enumerate(rows)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    events = [(k, datetime(2024, 1, 1) + timedelta(minutes=minute), "click", 50.0) for k, (_, _, minute) in enumerate(rows)]
    spark.createDataFrame(events, "event_id long, ts timestamp, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want, last = [], {}
    for text, source, minute in sorted(rows, key=lambda r: -r[2]):
        key = (source, text[:80])
        if key not in last or last[key] - minute >= 60:
            last[key] = minute
            want.append(hashlib.sha1(text.encode()).hexdigest()[:16])
    assert len(want) == 4
    found = run_language_feeds(spark, str(tmp_path)).collect()
    assert [r.id for r in sorted(found, key=lambda r: r.n)] == want and {r.lang for r in found} == {"en"}


def test_stream_state_by_parts(spark, tmp_path):
    """Micro-batches, one of them twice, late rows and an empty batch: the state merges to what one batch gives, and old folders go."""
    from feedloom.streaming import merge

    rows = random_articles(7)
    root = str(tmp_path / "state")
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    for epoch, part in enumerate((rows[::3], rows[1::3], rows[1::3], [], rows[2::3][:1], rows[2::3])):
        merge.upsert(frame(part), epoch, root)
    got = {r.id: (r.seq, r.category, r.published_iso, r.collected_iso, r.first_seq) for r in merge.snapshot(spark, root).collect()}
    assert got == merged(rows)
    named = {p.split("/")[0] for p in merge._current(spark, root).values()}
    assert len([d for d in (tmp_path / "state").iterdir() if d.name.startswith("state-")]) <= len(named) + 1
    merge.upsert(frame(rows), 9, root, F.lit(NOW + timedelta(days=30)), 1)
    assert set(merge._current(spark, root)) == set()
