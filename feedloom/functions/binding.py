"""Naming an intermediate value inside of a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value) with the value computed once per row, however often body uses it; the expression stays small to analyse."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
