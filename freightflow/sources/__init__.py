from .changelog import (
    POSITION,
    ods_table,
    parse_changes,
    parse_facts,
    read_files,
    read_kafka,
    read_once,
    reject_reason,
)
from .config import (
    config_epochs,
    config_feed,
    config_snapshot,
    read_jdbc_config,
    snapshot_events,
)
from .dimensions import DimensionStore, dic_lookup

__all__ = [
    "POSITION",
    "DimensionStore",
    "config_epochs",
    "config_feed",
    "config_snapshot",
    "dic_lookup",
    "ods_table",
    "parse_changes",
    "parse_facts",
    "read_files",
    "read_jdbc_config",
    "read_kafka",
    "read_once",
    "reject_reason",
    "snapshot_events",
]
