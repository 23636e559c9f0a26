"""The registered queries of the feed operators and their SQL."""

from __future__ import annotations

from feedloom.plans.connector_queries import QUERIES as _CONNECTORS
from feedloom.plans.connector_queries import SQL as _CONNECTOR_SQL
from feedloom.plans.queries import QUERIES as _TABLES
from feedloom.plans.queries import SQL as _TABLE_SQL

QUERIES = _TABLES | _CONNECTORS
SQL = _TABLE_SQL | _CONNECTOR_SQL
