"""Row types and parameters of the feed engine."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

ARTICLE = """seq BIGINT, id STRING, source_id STRING, source_name STRING, lang STRING, title STRING, url STRING, published TIMESTAMP,
published_iso STRING, excerpt STRING, image STRING, category STRING, source_domain STRING, date_estimated BOOLEAN, collected_at TIMESTAMP,
date_selector STRING, stale BOOLEAN"""

REGISTRY = """id STRING, name STRING, lang STRING, site STRING, adapter STRING, enabled BOOLEAN, fallback BOOLEAN, feeds ARRAY<STRING>,
listings ARRAY<STRING>, api STRING, sitemap STRING, google_query STRING, category STRING, max_age_hours DOUBLE,
selectors STRUCT<item: STRING, link: STRING, title: STRING, image: STRING, date: STRING, article_date: STRING>, url_categories MAP<STRING, STRING>"""

PAYLOAD = "source_id STRING, adapter STRING, seq INT, url STRING, status INT, fetched_at TIMESTAMP, body STRING"


@dataclass(frozen=True)
class Params:
    """Everything that a run depends on; run_ts takes the place of the clock."""

    run_ts: datetime
    per_feed: int = 150
    retention_days: int = 14
    fresh_hours: float = 48.0
    lang_fresh_hours: float = 24.0
    lang_min_fresh: int = 3
    lang_min_sources: int = 1
    lang_warn_sources: int = 2
    near_seconds: int = 3600
    enrich_images: int = 250
    version: str = "v1"
    langs: tuple = ("en", "si", "ta")
    categories: tuple = field(default=("politics", "business", "sports", "tech", "international", "entertainment", "society"))
