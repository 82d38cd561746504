"""String rules: topic parts, table names from paths, header clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_part(topic: Column | str, index: int = 2) -> Column:
    """Dot-separated part of a topic name (0-based); NULL when missing.

    ``pg.public.data1`` -> ``data1``; ``a.b`` -> NULL (no exception, also
    with ANSI mode on); ``pg.public.a.b`` -> ``a`` (dotted names are cut).
    """
    return F.get(F.split(_col(topic), r"\."), index)


def table_name_from_path(path: Column | str) -> Column:
    """Base name without its last extension, every non letter/digit
    character replaced by ``_``, lower case.  ``/d/My File-1.csv`` ->
    ``my_file_1``.  Leading dots are not an extension (``.env`` stays)."""
    base = F.regexp_extract(_col(path), r"([^/]*)$", 1)
    stem = F.regexp_replace(base, r"^(\.*[^.].*)\.[^.]*$", "$1")
    return F.lower(F.regexp_replace(stem, r"[^\p{L}\p{N}]", "_"))


def clean_column_name(name: str) -> str:
    """Header rule: strip, then spaces to underscores (case kept).  Plain
    Python: it runs once per column on the driver, never per row."""
    return name.strip().replace(" ", "_")


def ends_with_ci(c: Column | str, suffix: str) -> Column:
    return F.lower(_col(c)).endswith(suffix.lower())


def delimited_int(line: Column | str, sep: str = ":", index: int = 2) -> Column:
    """Field ``index`` of a delimited line as BIGINT; NULL when the line is
    short or the field is not an integer (``topic:partition:offset``)."""
    field = F.get(F.split(_col(line), _regex_quote(sep)), index)
    return F.when(F.trim(field).rlike(r"^[+-]?[0-9]+$"),
                  F.trim(field).try_cast("bigint"))


def text_prefix(c: Column | str, n: int = 100) -> Column:
    return F.substring(_col(c), 1, n)


def _regex_quote(s: str) -> str:
    import re
    return re.escape(s)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
