from lakestrata.streaming.follow import Follower, follow, given_out
from lakestrata.streaming.loads import Load, run_loads, start_load
from lakestrata.streaming.positions import clean_source, expire_readers, positions_kept, reader_positions
from lakestrata.streaming.shared import SharedLoad, Sink, read_sink, run_shared, start_shared

__all__ = [
    "Follower",
    "Load",
    "SharedLoad",
    "Sink",
    "clean_source",
    "expire_readers",
    "follow",
    "given_out",
    "positions_kept",
    "read_sink",
    "reader_positions",
    "run_loads",
    "run_shared",
    "start_load",
    "start_shared",
]
