from tallyhouse.streaming.jobs import (  # noqa: F401
    cart_sessions,
    deduplicated,
    read_stream,
    stream_daily_activity,
    write_stream,
)
