from learnstream.functions.scalar import (  # noqa: F401
    channel_of, drop_trailing_tabs, epoch_millis, epoch_seconds_of_text, field, parse_time_text,
    half_even_percent, idiv, ip_to_long, tsv_width, two_decimals, watched_seconds,
)
