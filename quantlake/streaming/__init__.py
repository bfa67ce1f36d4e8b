from quantlake.streaming.ticks import (
    bad_tick_records,
    decode_ticks,
    landed_columns,
    read_landed_ticks,
    start_reject_sink,
    start_tick_sink,
)

__all__ = [
    "bad_tick_records",
    "decode_ticks",
    "landed_columns",
    "read_landed_ticks",
    "start_reject_sink",
    "start_tick_sink",
]
