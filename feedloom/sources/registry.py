"""The source registry and the last snapshot as DataFrames."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.schema import ARTICLE, REGISTRY


def _typed(kind: T.DataType, value):
    """A configured value in the column's type; what does not fit is null."""
    if value is None:
        return None
    if isinstance(kind, T.ArrayType):
        return [str(x) for x in (value if isinstance(value, list) else [value])]
    if isinstance(kind, T.MapType):
        return {str(k): str(v) for k, v in value.items()} if isinstance(value, dict) else None
    if isinstance(kind, T.StructType):
        return tuple(value.get(f.name) for f in kind.fields) if isinstance(value, dict) else None
    if isinstance(kind, T.BooleanType):
        return bool(value)
    if isinstance(kind, T.DoubleType):
        return float(value)
    return str(value)


def load(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(registry, defaults) of a YAML configuration with keys sources and defaults; a single feed or listing becomes a list of one."""
    import yaml

    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    config = yaml.safe_load(text) or {}
    schema = T.StructType.fromDDL(REGISTRY) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(REGISTRY)
    rows = []
    for source in config.get("sources") or []:
        source = source | {"feeds": source.get("feeds") or source.get("feed"), "listings": source.get("listings") or source.get("listing")}
        rows.append(tuple(_typed(f.dataType, source.get(f.name)) for f in schema.fields))
    return spark.createDataFrame(rows, schema), config.get("defaults") or {}


def load_previous(spark: SparkSession, folder: str, lang: str) -> DataFrame:
    """The articles of the last snapshot's feed of a language, stale; none if there is no readable one. Unknown keys are passed over."""
    empty = spark.createDataFrame([], ARTICLE)
    document = load_document(folder, f"feed_{lang}.json")
    if document is None:
        return empty
    found = spark.createDataFrame([(json.dumps(a), k) for k, a in enumerate(document.get("articles") or [])], "j string, seq long")
    fields = "id STRING, source_id STRING, source_name STRING, lang STRING, title STRING, url STRING, published STRING, excerpt STRING, image STRING, category STRING, date_estimated BOOLEAN, collected_at STRING"
    rows = found.select("seq", F.from_json("j", fields).alias("a")).select("seq", "a.*").filter("id IS NOT NULL AND published IS NOT NULL")
    rows = rows.withColumns({"published_iso": F.col("published"), "published": F.try_to_timestamp("published"), "collected_at": F.try_to_timestamp("collected_at"), "stale": F.lit(True), "date_estimated": F.coalesce("date_estimated", F.lit(False))})
    return empty.unionByName(rows, allowMissingColumns=True)


def load_document(folder: str, name: str) -> dict | None:
    """A published document, or None if it is missing or broken."""
    path = os.path.join(folder, name)
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    except (OSError, ValueError):
        return None
    return found if isinstance(found, dict) else None


def write_document(path: str, document: dict) -> None:
    """Compact UTF-8 JSON, in place by rename."""
    part = f"{path}.part"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(document, f, ensure_ascii=False, separators=(",", ":"))
    os.replace(part, path)
