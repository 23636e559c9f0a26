"""An optional outer layer: a Python data source that fetches endpoints into payload rows, one partition per host.

spark.dataSource.register(FetchSource); spark.read.format("feed_fetch").option("endpoints", json).load()
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from datetime import datetime, timezone
from urllib.parse import urljoin, urlparse

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from feedloom.schema import PAYLOAD

#: Answers that are worth another try, tries, wait per try in seconds, redirects, seconds between calls to one search host.
RETRY = {202, 429, 500, 502, 503, 504}
ATTEMPTS, BACKOFF, HOPS, SEARCH_GAP = 3, 1.5, 6, 0.2


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args):
        return None


def open_url(url: str, agent: str, timeout: float) -> tuple[int, str, str | None]:
    """(status, body, redirect target) of one request."""
    opener = urllib.request.build_opener(_NoRedirect)
    try:
        with opener.open(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:
            return r.status, r.read().decode("utf-8", "replace"), None
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace"), e.headers.get("Location")


def allowed(url: str, hosts=None) -> bool:
    """A first guard before a request: http(s), no credentials, a dotted name, and one of the hosts if there are any (www aside)."""
    p = urlparse(url)
    host = (p.hostname or "").rstrip(".")
    named = p.scheme in ("http", "https") and "@" not in p.netloc and "." in host and not host.endswith((".localhost", ".local", ".internal")) and not host.replace(".", "").isdigit() and ":" not in host
    return named and (hosts is None or host.removeprefix("www.") in {h.removeprefix("www.") for h in hosts})


def checked(url: str, opener, guard, hosts=None):
    """Follows at most HOPS redirects and asks guard before each request; (status, body), or None for a refused or endless way."""
    for _ in range(HOPS + 1):
        if not guard(url, hosts):
            return None
        status, body, target = opener(url)
        if status not in (301, 302, 303, 307, 308) or not target:
            return status, body
        url = urljoin(url, target)
    return None


def fetch(url: str, opener, guard=allowed, hosts=None, sleep=time.sleep, attempts: int = ATTEMPTS):
    """The answer after retries of passing failures; (0, None) if there is none. Never raises for HTTP or network errors."""
    for k in range(1, attempts + 1):
        try:
            got = checked(url, opener, guard, hosts)
        except (TimeoutError, ConnectionError):
            got = (-1, None)
        except (OSError, ValueError):
            return 0, None
        if got is None:
            return 0, None
        if got[0] not in RETRY and got[0] != -1:
            return got if got[0] < 400 else (got[0], None)
        if k < attempts:
            sleep(BACKOFF * k)
    return max(got[0], 0), None


class _HostPart(InputPartition):
    def __init__(self, rows):
        self.rows = rows


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.endpoints = json.loads(options.get("endpoints", "[]"))
        self.agent, self.timeout = options.get("agent", "feedloom"), float(options.get("timeout", "20"))

    def partitions(self):
        """One partition per host, so that a host is called by one task at a time."""
        by: dict[str, list] = {}
        for e in self.endpoints:
            by.setdefault(urlparse(e["url"]).hostname or "", []).append(e)
        return [_HostPart(rows) for rows in by.values()]

    def read(self, partition):
        for k, e in enumerate(partition.rows):
            if k and urlparse(e["url"]).hostname == "news.google.com":
                time.sleep(SEARCH_GAP)
            status, body = fetch(e["url"], lambda u: open_url(u, self.agent, self.timeout), hosts=e.get("hosts"))
            yield e["source_id"], e["adapter"], int(e.get("seq", 0)), e["url"], status, datetime.now(timezone.utc), body


class FetchSource(DataSource):
    @classmethod
    def name(cls):
        return "feed_fetch"

    def schema(self):
        return PAYLOAD

    def reader(self, schema):
        return _Reader(self.options)
