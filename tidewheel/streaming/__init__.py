"""Running transforms as streams, and the operators that need state of their own."""

from tidewheel.streaming.batches import (  # noqa: F401
    forget,
    running_total_by_batch,
    running_total_rows,
    split_late_by_batch,
    start_running_total,
    start_split_late,
    start_windows,
    window_rows,
    windows_by_batch,
    windows_until_by_batch,
)
from tidewheel.streaming.counts import running_count_stream  # noqa: F401
from tidewheel.streaming.latest import latest_by_key_stream  # noqa: F401
from tidewheel.streaming.runner import (  # noqa: F401
    append_and_close,
    append_to_table,
    latest_to_table,
    stateful_settings,
    to_end,
)
from tidewheel.streaming.until import windows_until_stream  # noqa: F401
