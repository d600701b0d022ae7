from tallyline.operators.counts import count_by, count_items
from tallyline.operators.merge import latest_by_time, latest_snapshot, reconcile, serving_view
from tallyline.operators.ordered import (
    following, last_known, ordered_scan, position, previous, running_sum,
)
from tallyline.operators.questions import (
    gap_profile, healthy_share, silence_alarms, silent_machines, standing_alarms, stockout_risk, top_machines,
    unprofitable_machines,
)
from tallyline.operators.timeline import (
    delay_series, gap, in_tie, interval_sum, intervals, positional_slice, row_position,
    running_total, spread_ties, tie_rank, timeline,
)

__all__ = [
    "count_by", "count_items", "delay_series", "following", "gap", "gap_profile", "healthy_share", "in_tie",
    "interval_sum", "intervals", "last_known", "latest_by_time", "latest_snapshot", "ordered_scan",
    "position", "positional_slice", "previous", "reconcile", "row_position", "running_sum",
    "running_total", "serving_view", "silence_alarms", "silent_machines", "spread_ties",
    "standing_alarms", "stockout_risk", "tie_rank",
    "timeline", "top_machines", "unprofitable_machines",
]
