"""Operators on progress tables and logs: DataFrame in, DataFrame out.

All are lazy, work on all keys at once and take the time from the caller.
"""

from tidemark.operators.changes import (
    clear,
    compact_log,
    delete_history,
    delete_keys,
    delete_report,
    merge_columns,
    replace_all,
    update_offset,
    upsert,
)
from tidemark.operators.codec import (
    decode_payloads,
    encode_payloads,
    normalise_metadata,
    normalise_offsets,
    normalise_times,
    stamp_updated_at,
    strip_system_fields,
    with_copied_column,
    with_payload_column,
)
from tidemark.operators.expiry import (
    list_live,
    live,
    mark_expired,
    purge_expired,
    stamp_expiry,
    write_purged,
)
from tidemark.operators.filters import (
    by_group,
    by_key,
    by_key_range,
    by_pattern,
    by_payload_field,
    by_prefix,
)
from tidemark.operators.keys import rekey_report, split_key, with_key, with_stable_id
from tidemark.operators.listing import limited_list, list_all, ordered_list
from tidemark.operators.lookups import existing, load_many, missing, resume
from tidemark.operators.state import (
    count_checkpoints,
    duplicate_keys,
    keep_last_n,
    latest_by_arrival,
    latest_by_version,
    list_streams,
    list_subkeys,
)

__all__ = [
    "by_group",
    "by_key",
    "by_key_range",
    "by_pattern",
    "by_payload_field",
    "by_prefix",
    "clear",
    "compact_log",
    "count_checkpoints",
    "decode_payloads",
    "delete_history",
    "delete_keys",
    "delete_report",
    "duplicate_keys",
    "encode_payloads",
    "existing",
    "keep_last_n",
    "latest_by_arrival",
    "latest_by_version",
    "limited_list",
    "list_all",
    "list_live",
    "list_streams",
    "list_subkeys",
    "live",
    "load_many",
    "merge_columns",
    "missing",
    "normalise_metadata",
    "normalise_offsets",
    "normalise_times",
    "ordered_list",
    "mark_expired",
    "purge_expired",
    "rekey_report",
    "replace_all",
    "resume",
    "split_key",
    "stamp_expiry",
    "stamp_updated_at",
    "strip_system_fields",
    "update_offset",
    "upsert",
    "with_copied_column",
    "with_key",
    "with_payload_column",
    "with_stable_id",
    "write_purged",
]
