"""JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_path_or_default(doc: Column | str, path: str,
                         default: str = "unknown") -> Column:
    """Value at a JSON path as text, ``default`` when the path is missing or
    the document is malformed (``$.connector.state`` -> ``unknown``)."""
    d = F.col(doc) if isinstance(doc, str) else doc
    return F.coalesce(F.get_json_object(d, path), F.lit(default))


def json_list_length(doc: Column | str) -> Column:
    """Length of a JSON array, 0 when the text is not a JSON array (a
    registry subject listing that failed to parse counts as none)."""
    d = F.col(doc) if isinstance(doc, str) else doc
    return F.coalesce(F.json_array_length(d), F.lit(0))
