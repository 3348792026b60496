"""Plan-level helpers: size checks, joins on keys, ordered positions, scratch storage."""

from tidemark.plans.joins import join_on_keys, own_stage
from tidemark.plans.latest import latest_rows, newest_rows
from tidemark.plans.positions import with_position
from tidemark.plans.scratch import scratch_path, shared_dir
from tidemark.plans.session import configure, local_session, path_exists
from tidemark.plans.sizes import fits_broadcast, narrow_to_keys

__all__ = [
    "configure",
    "fits_broadcast",
    "join_on_keys",
    "latest_rows",
    "local_session",
    "narrow_to_keys",
    "newest_rows",
    "own_stage",
    "path_exists",
    "scratch_path",
    "shared_dir",
    "with_position",
]
