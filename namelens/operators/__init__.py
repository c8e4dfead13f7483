from namelens.operators.joins import keyed_join, salted_join
from namelens.operators.ranking import ranked, with_new_ids
from namelens.operators.snapshot import (
    measured_bytes,
    scratch_dir,
    scratch_path,
    snapshot,
    temporary_snapshots,
)
from namelens.operators.upsert import add_absent, delete_matching, insert_absent, update_matching, upsert

__all__ = [
    "add_absent",
    "delete_matching",
    "insert_absent",
    "keyed_join",
    "measured_bytes",
    "ranked",
    "salted_join",
    "scratch_dir",
    "scratch_path",
    "snapshot",
    "temporary_snapshots",
    "update_matching",
    "upsert",
    "with_new_ids",
]
