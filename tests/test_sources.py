"""The registry, the last snapshot, and the fetching source without a network."""

import json

from feedloom.sources import fetch, registry


def test_registry(spark, tmp_path):
    path = tmp_path / "sources.yaml"
    path.write_text("defaults: {max_items: 40}\nsources:\n- {id: a, name: A, lang: en, site: 'https://a.example', feed: 'https://a.example/f', url_categories: {x: sports}, selectors: {item: article}}\n- {id: b, site: 'https://b.example', enabled: false, max_age_hours: 5}\n")
    rows, defaults = registry.load(spark, str(path))
    a, b = rows.orderBy("id").collect()
    assert defaults == {"max_items": 40} and a.feeds == ["https://a.example/f"] and a.url_categories == {"x": "sports"} and a.selectors.item == "article" and a.enabled is None
    assert b.enabled is False and b.max_age_hours == 5.0 and b.feeds is None


def test_previous_snapshot(spark, tmp_path):
    assert registry.load_previous(spark, str(tmp_path), "en").count() == 0
    (tmp_path / "feed_si.json").write_text("{broken")
    assert registry.load_previous(spark, str(tmp_path), "si").count() == 0
    registry.write_document(str(tmp_path / "feed_en.json"), {"articles": [{"id": "1", "published": "2026-03-10T01:00:00.5Z", "title": "é", "odd": 1}, {"title": "no id"}]})
    row = registry.load_previous(spark, str(tmp_path), "en").first()
    assert (row.id, row.title, row.stale, row.published_iso) == ("1", "é", True, "2026-03-10T01:00:00.5Z") and row.published.microsecond == 500000


def served(answers):
    calls = []

    def opener(url):
        calls.append(url)
        got = answers[url]
        got = got.pop(0) if isinstance(got, list) else got
        if isinstance(got, Exception):
            raise got
        return got

    return opener, calls


def test_retries_and_redirects():
    waits = []
    opener, calls = served({"https://a.example/": [(503, "", None), TimeoutError(), (200, "ok", None)]})
    assert fetch.fetch("https://a.example/", opener, sleep=waits.append) == (200, "ok") and waits == [1.5, 3.0] and len(calls) == 3
    opener, _ = served({"https://a.example/": (404, "", None)})
    assert fetch.fetch("https://a.example/", opener, sleep=waits.append) == (404, None)
    opener, _ = served({"https://a.example/": (429, "", None)})
    assert fetch.fetch("https://a.example/", opener, sleep=waits.append) == (429, None)
    opener, calls = served({"https://a.example/": (302, "", "/b"), "https://a.example/b": (301, "", "https://127.0.0.1/secret")})
    assert fetch.fetch("https://a.example/", opener) == (0, None) and len(calls) == 2
    opener, calls = served({"https://a.example/": (302, "", "/")})
    assert fetch.fetch("https://a.example/", opener) == (0, None) and len(calls) == 7
    assert fetch.fetch("https://b.example/", opener, hosts=["a.example"]) == (0, None) and fetch.allowed("https://www.a.example/", ["a.example"])


def test_one_partition_per_host():
    ends = [{"source_id": s, "adapter": "rss", "url": f"https://{h}.example/{s}"} for s, h in (("1", "a"), ("2", "b"), ("3", "a"))]
    parts = fetch._Reader({"endpoints": json.dumps(ends)}).partitions()
    assert sorted(len(p.rows) for p in parts) == [1, 2]


def test_posts_of_a_long_wrapper_keep_numbers_of_their_own(spark):
    from pyspark.sql import functions as F

    from feedloom.sources import connectors

    post = lambda k: {"id": k, "status": "publish", "date_gmt": "2024-01-01T00:00:00", "title": {"rendered": f"Title {k}"}, "post_url": f"/p/{k}"}
    body = json.dumps({"a": {"postResponseDto": [{"rowCount": 150, "postResponseDto": [post(k) for k in range(150)]}]}, "b": {"postResponseDto": [post(1000 + k) for k in range(150)]}})
    rows = spark.createDataFrame([("s", "newsfirst", 1, 200, body), ("s", "newsfirst", 2, 200, json.dumps({"a": [post(5000)]}))], "source_id string, adapter string, seq int, status int, body string")
    registry = spark.createDataFrame([("s", "https://a.example/", "en", None)], "id string, site string, lang string, selectors string")
    out = connectors.bucketed(rows, registry, F.to_timestamp(F.lit("2024-01-02T00:00:00Z")), limit=400).orderBy("seq").collect()
    assert len(out) == 301 and len({r.seq for r in out}) == 301
    assert [r.url.rsplit("/", 1)[1] for r in out] == [str(k) for k in [*range(150), *range(1000, 1150), 5000]]
