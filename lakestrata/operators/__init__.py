from lakestrata.operators.changelog import append_changes
from lakestrata.operators.conform import conform, conform_with_rejects
from lakestrata.operators.keyed import keyed_table, upkeep
from lakestrata.operators.maintain import (
    backfill,
    compact_in_place,
    compact_partitions,
    drop_expired_partitions,
    expire_folder,
    expire_partitions,
    file_stats,
    unparsable_partitions,
)
from lakestrata.operators.ranges import finished_ranges, run_backfill
from lakestrata.operators.reshape import no_bet_rows, unpivot_pairs
from lakestrata.operators.upsert import UpsertTarget, merge_into, purge_deletes, upsert
from lakestrata.operators.versions import apply_changes, latest_by_key, read_current

__all__ = [
    "UpsertTarget",
    "append_changes",
    "apply_changes",
    "backfill",
    "compact_in_place",
    "compact_partitions",
    "conform",
    "conform_with_rejects",
    "drop_expired_partitions",
    "expire_folder",
    "expire_partitions",
    "file_stats",
    "finished_ranges",
    "keyed_table",
    "latest_by_key",
    "merge_into",
    "no_bet_rows",
    "purge_deletes",
    "read_current",
    "run_backfill",
    "unparsable_partitions",
    "unpivot_pairs",
    "upkeep",
    "upsert",
]
