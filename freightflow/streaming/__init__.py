from .dimension_job import DimensionJob, enrich_latest, lookup_latest, upsert_sink
from .pairing import attach_sink, join_sink, pair_sink, read_open
from .replay import land, replay
from .runner import Progress, run_sql_stream, run_stream, run_supervised
from .sinks import (
    batch_folders,
    enrich_once,
    fan_out,
    file_sink,
    kafka_rows,
    kafka_sink,
    read_batches,
    upsert_rows,
)
from .windows import read_windows, window_sink, windows_to

__all__ = [
    "DimensionJob",
    "Progress",
    "attach_sink",
    "batch_folders",
    "enrich_latest",
    "enrich_once",
    "fan_out",
    "file_sink",
    "join_sink",
    "kafka_rows",
    "kafka_sink",
    "land",
    "lookup_latest",
    "pair_sink",
    "read_batches",
    "read_open",
    "read_windows",
    "replay",
    "run_sql_stream",
    "run_stream",
    "run_supervised",
    "upsert_rows",
    "upsert_sink",
    "window_sink",
    "windows_to",
]
