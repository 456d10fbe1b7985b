from riskflow.streaming.velocity_stream import (
    StreamHandles,
    make_upsert,
    read_velocity_table,
    run_stream,
    stream_features,
)

__all__ = ["StreamHandles", "make_upsert", "read_velocity_table", "run_stream", "stream_features"]
