"""Column expressions; all of them are built-in Spark functions and stay in the JVM."""

from tidewheel.functions.records import (  # noqa: F401
    location_sentence,
    records_to_json,
)
from tidewheel.functions.text import (  # noqa: F401
    fold_sequence,
    has_letters,
    only_letters,
    plain_words,
    raw_words,
    show_upper,
    with_prefix,
)
