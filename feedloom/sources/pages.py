"""HTML pages as rows: listing items, page facts and date evidence, parsed batch by batch by Arrow."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import dates, text
from feedloom.sources import dom

#: The names under which pages state image, excerpt and date, best first.
IMAGE_NAMES = ["og:image", "twitter:image", "twitter:image:src"]
EXCERPT_NAMES = ["og:description", "description"]
DATE_NAMES = ["article:published_time", "og:article:published_time", "publishdate", "pubdate", "date", "DC.date.issued"]


def _meta(root, names):
    tags = [e for e in root.all() if e.name == "meta"]
    for name in names:
        for key in ("property", "name"):
            tag = next((t for t in tags if t.get(key) == name), None)
            if tag is not None and tag.get("content"):
                return tag.get("content").strip()
    return None


def _json_dates(root):
    for e in root.all():
        if e.name == "script" and e.get("type") == "application/ld+json":
            try:
                data = json.loads(e.text() or "{}")
            except ValueError:
                continue
            for item in data if isinstance(data, list) else [data]:
                if isinstance(item, dict) and item.get("datePublished"):
                    yield str(item["datePublished"])
                    break


def _node_date(e):
    return e.get("datetime") or e.get("content") or e.text().strip()


def facts(html: str, date_selector: str | None = None) -> dict:
    """title, lang, image, excerpt and the date texts of a page, best evidence first."""
    root = dom.parse(html)
    title, page = root.first("title"), root.first("html")
    found = [_meta(root, [n]) for n in DATE_NAMES] + list(_json_dates(root))
    times = root.first("time")
    found += [times.get("datetime") or times.text().strip()] if times else []
    node = root.first(date_selector) if date_selector else None
    found += [_node_date(node)] if node else []
    return {"title": " ".join(title.text().split()) if title else None, "lang": page.get("lang") if page else None, "image": _meta(root, IMAGE_NAMES), "excerpt": _meta(root, EXCERPT_NAMES), "dates": [d for d in found if d]}


def page_facts(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, title, lang, image, excerpt, dates of rows with html (and date_selector, if there is such a column)."""
    kinds = {k: pages.schema[k].dataType.simpleString() for k in keys}
    selector = F.col("date_selector") if "date_selector" in pages.columns else F.lit(None).cast("string")
    fields = {"title": pa.string(), "lang": pa.string(), "image": pa.string(), "excerpt": pa.string(), "dates": pa.list_(pa.string())}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                n = len(keys)
                rows = [facts(h or "", s) for h, s in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *(pa.array([r[k] for r in rows], t) for k, t in fields.items())], names=[*keys, *fields])

    schema = ", ".join([*(f"`{k}` {v}" for k, v in kinds.items()), "title string, lang string, image string, excerpt string, dates array<string>"])
    return pages.select(*keys, "html", selector.alias("date_selector")).mapInArrow(run, schema)


def evidence(html: str) -> list[tuple[str, str, str]]:
    """(kind, path, text) of everything in a page that may be its date: meta tags, <time>, JSON-LD, and up to ten text nodes."""
    root, out = dom.parse(html), []
    for e in root.all():
        if e.name == "meta" and e.get("content") and any(w in f"{e.get('property')} {e.get('name')}".lower() for w in ("date", "time", "publish")):
            out.append(("meta", e.get("property") or e.get("name"), e.get("content")))
        elif e.name == "time":
            out.append(("time", dom.css_path(e), e.get("datetime") or e.text().strip()))
    out += [("json", "datePublished", d) for d in _json_dates(root)]
    seen = set()
    for e in root.all():
        if e.name in ("script", "style", "time", "title"):
            continue
        for k in e.kids:
            if isinstance(k, str) and 6 <= len(k.strip()) <= 60 and dom.css_path(e) not in seen and len(seen) < 10 and any(c.isdigit() for c in k):
                seen.add(dom.css_path(e))
                out.append(("text", dom.css_path(e), k.strip()))
    return out


def date_evidence(pages: DataFrame, key: str) -> DataFrame:
    """key, kind, path, raw: a row per piece of evidence; text nodes are kept where they look like dates."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(ids[i], *e) for i, h in enumerate(batch.column(1).to_pylist()) for e in evidence(h or "")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], batch.schema.types[0] if k == 0 else pa.string()) for k in range(4)], names=[key, "kind", "path", "raw"])

    found = pages.select(key, "html").mapInArrow(run, f"`{key}` {kind}, kind string, path string, raw string")
    return found.filter((F.col("kind") != "text") | text.looks_like_date(F.col("raw")))


def listing_items(payloads: DataFrame) -> DataFrame:
    """Items of listing pages: source_id, page_seq, pos, href, title, image, date_text by the source's selectors (struct column selectors)."""
    def run(batches):
        names = ["source_id", "page_seq", "pos", "href", "title", "image", "date_text"]
        for batch in batches:
            rows = []
            for sid, seq, body, sel in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sel = {k: v for k, v in (sel or {}).items() if v}
                for pos, node in enumerate(dom.parse(body or "").select(sel.get("item", "article"))):
                    link = node.first(sel.get("link", "a"))
                    title = node.first(sel["title"]) if sel.get("title") else None
                    image, when = node.first(sel.get("image", "img")), node.first(sel["date"]) if sel.get("date") else None
                    src = next((image.get(k) for k in ("src", "data-src", "data-lazy-src") if image.get(k)), None) if image else None
                    rows.append((sid, seq, pos, link.get("href") if link else None, (title or link).text() if title or link else None, src, _node_date(when) if when else None))
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    return payloads.select("source_id", F.col("seq").cast("int").alias("seq"), "body", "selectors").mapInArrow(run, "source_id string, page_seq int, pos int, href string, title string, image string, date_text string")


def best_date(page_dates, now):
    """The first of a page's date texts that is a date within bounds."""
    read = F.filter(F.transform(page_dates, lambda t: dates.to_instant(t, now)), lambda d: d.isNotNull())
    return F.get(read, F.lit(0))
