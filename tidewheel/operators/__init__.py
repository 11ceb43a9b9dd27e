"""DataFrame-to-DataFrame operators."""

from tidewheel.operators.chains import chain_starts  # noqa: F401
from tidewheel.operators.contracts import RowContract, RowContractBroken, with_row_contract  # noqa: F401
from tidewheel.operators.fields import quoted_fields, split_quoted  # noqa: F401
from tidewheel.operators.interval import interval_join, stream_interval_join  # noqa: F401
from tidewheel.operators.keyed import (  # noqa: F401
    count_by,
    latest_by_key,
    partition_by_key,
    rebalance,
)
from tidewheel.operators.records import (  # noqa: F401
    flatten_valid,
    locations_flagged,
    parse_flagged,
    parse_json,
    parse_locations,
)
from tidewheel.operators.reduce import reduce_by_key  # noqa: F401
from tidewheel.operators.running import Fold, find_hot_keys, running_count, running_fold  # noqa: F401
from tidewheel.operators.text import lines_starting_with, split_words, tokenize, upper_lines  # noqa: F401
from tidewheel.operators.timewin import tumbling, tumbling_last, with_event_time  # noqa: F401
from tidewheel.operators.until import (  # noqa: F401
    gather_windows,
    numbered_until,
    windows_until,
    windows_until_capped,
    windows_until_timeout,
)
from tidewheel.operators.wordruns import running_words  # noqa: F401
