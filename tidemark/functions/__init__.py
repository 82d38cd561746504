"""Column-level helpers: each takes and returns a ``Column`` and stays a
built-in expression (codegen, no Python in the hot path)."""

from .text import (  # noqa: F401
    clean_column_name, delimited_int, ends_with_ci, table_name_from_path,
    text_prefix, topic_part,
)
from .binary import (  # noqa: F401
    as_text, is_valid_utf8, wire_magic, wire_payload, wire_schema_id,
)
from .json import json_list_length, json_path_or_default  # noqa: F401
from .time import age_ms_exact, age_ms_seconds  # noqa: F401
