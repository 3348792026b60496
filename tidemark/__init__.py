"""Reading-progress tables for pipelines on Spark.

Logs of saves and deletes, the current-state tables derived from them, and bulk
operators on both, for DataFrames and for Structured Streaming.
"""

from tidemark.schema import DELETE, KEY_COLS, PROGRESS, PROGRESS_LOG, SAVE
from tidemark.table import ProgressTable

__all__ = ["DELETE", "KEY_COLS", "PROGRESS", "PROGRESS_LOG", "SAVE", "ProgressTable"]
