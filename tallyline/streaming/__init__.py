from tallyline.streaming.compaction import compact_archive, read_archive_lines
from tallyline.streaming.control import emit_restart, encode_restart, on_restart, restart_signals
from tallyline.streaming.epochs import (
    activate_epoch, active_epoch, covered_units, newest_epoch, publish_cut, publish_run,
    reset_counts, restart_behind_run, rotate_epoch, uncovered,
)
from tallyline.streaming.history import (
    appended_once, compact_history, current_snapshot, drop_compacted, known_epochs, newest_batch, point_to, read_history,
    unit_delays,
)
from tallyline.streaming.queries import (
    append_raw_view, archive, batch_sizes, publish, replay, run_until_ok, snapshot_stream,
    write_snapshot,
)
from tallyline.streaming.watch import BatchWatch, observed

__all__ = [
    "BatchWatch", "activate_epoch", "active_epoch", "append_raw_view", "appended_once", "archive", "batch_sizes",
    "compact_archive", "compact_history",
    "covered_units", "current_snapshot", "drop_compacted", "emit_restart", "encode_restart", "known_epochs",
    "newest_batch", "newest_epoch", "observed", "on_restart", "point_to", "publish", "publish_cut", "publish_run",
    "read_archive_lines", "read_history",
    "replay", "reset_counts", "restart_behind_run", "restart_signals", "rotate_epoch",
    "run_until_ok", "snapshot_stream", "uncovered", "unit_delays", "write_snapshot",
]
