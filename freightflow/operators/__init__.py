from .clean import clean, count_types, normalise_type
from .dedupe import first_per_key, latest_per_key
from .dimension import apply_changes, keep_current_epoch, key_changes, versions
from .lookup import flatten_regions, join_region, lookup_as_of, lookup_join
from .rollup import window_rollup
from .routing import project_columns, route

__all__ = [
    "apply_changes",
    "clean",
    "count_types",
    "first_per_key",
    "flatten_regions",
    "join_region",
    "keep_current_epoch",
    "key_changes",
    "latest_per_key",
    "lookup_as_of",
    "lookup_join",
    "normalise_type",
    "project_columns",
    "route",
    "versions",
    "window_rollup",
]
