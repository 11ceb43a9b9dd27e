"""Ways in: memory, files, watched folders, keyed lines, topics, sockets, generators."""

from tidewheel.sources.files import (  # noqa: F401
    keyed_lines,
    read_csv,
    read_lines,
    read_table,
    split_corrupt,
    stream_table,
    watch_csv,
    watch_lines,
)
from tidewheel.sources.generated import (  # noqa: F401
    SequenceSource,
    rate_stream,
    register_sequence_source,
    rows_of,
    sequence,
)
from tidewheel.sources.tables import TableSource, stream_row_groups  # noqa: F401
from tidewheel.sources.topics import (  # noqa: F401
    TOPIC_ROW,
    read_topic,
    socket_lines,
    topic_options,
    topic_values,
    watch_topic,
)
