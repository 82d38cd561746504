"""tidemark: Spark-native change-data pipeline operators.

Pure ``DataFrame -> DataFrame`` functions for loading files into typed
tables, turning table snapshots into change events, decoding and enriching
topic-shaped change records (batch and Structured Streaming share the same
functions), writing replay-safe versioned lake tables and reporting on them.
"""

from .operators.cdc import (current_state, op_counts, route_topic,  # noqa: F401
                            snapshot_diff, snapshot_events)
from .operators.enrich import enrich, message_sequence, metadata_projection  # noqa: F401
from .operators.envelope import (decode_by_schema_id, decode_envelopes,  # noqa: F401
                                 decode_json, flatten_envelope, split_decoded,
                                 wire_header)
from .operators.inference import apply_types, infer_types, null_na_tokens  # noqa: F401
from .operators.ingest import load_csv_tables, typed_table, with_seed_rows  # noqa: F401
from .operators.quality import missing, non_empty, require, unexpected  # noqa: F401
from .operators.reports import (count_by, table_counts, topic_end_offsets,  # noqa: F401
                                topic_replay, total_count)
from .operators.sequence import number_within  # noqa: F401
from .sources.lake import (as_of_timestamp, as_of_version, read_lake,  # noqa: F401
                           read_version, table_history)
from .streaming.jobs import (await_drained, start_current_state_stream,  # noqa: F401
                             start_enrich_stream, start_lake_stream,
                             start_report_stream)

__version__ = "0.1.0"
