"""DataFrame operators: windows, top-N, distinct counts, event patterns,
quotas and stream matching."""

from .windows import tumbling_count, sliding_count, sliding_peak, sliding_runs, drop_static_urls
from .topn import top_n, top_n_report
from .uniques import unique_count, running_unique, merge_unique_state
from .patterns import strict_sequence, followed_by, deadline, bursts, runs
from .quota import quota
from .matching import interval_join, reconcile

__all__ = ["tumbling_count", "sliding_count", "sliding_peak", "sliding_runs", "drop_static_urls", "top_n", "top_n_report",
           "unique_count", "running_unique", "merge_unique_state", "strict_sequence",
           "followed_by", "deadline", "bursts", "runs", "quota", "interval_join", "reconcile"]
