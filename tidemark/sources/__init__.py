"""Reading and writing progress tables and logs."""

from tidemark.sources.files import (
    many_files,
    read_checkpoint_files,
    stream_checkpoint_files,
    write_checkpoint_files,
    write_checkpoint_objects,
)
from tidemark.sources.jdbc import jdbc_options, read_jdbc, write_jdbc
from tidemark.sources.objects import list_new_objects
from tidemark.sources.rewrites import delete_history_files, finish_rewrites
from tidemark.sources.tables import (
    append_log,
    ensure_table,
    read_log,
    read_payload_table,
    write_sorted,
)

__all__ = [
    "append_log",
    "delete_history_files",
    "ensure_table",
    "finish_rewrites",
    "jdbc_options",
    "list_new_objects",
    "many_files",
    "read_checkpoint_files",
    "read_jdbc",
    "read_log",
    "read_payload_table",
    "stream_checkpoint_files",
    "write_checkpoint_files",
    "write_checkpoint_objects",
    "write_jdbc",
    "write_sorted",
]
