"""One row per key. Each is an aggregate, so copies of a key collapse before the shuffle."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per_key(df, keys, order):
    """The row of each key that comes first by `order`; ties fall to the other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("first"))
    return picked.select(*keys, "first.*").select(*df.columns)


def _orderable(df, name):
    """A column in a form that can be compared; maps as their sorted entries."""
    kind = df.schema[name].dataType
    return F.array_sort(F.map_entries(name)) if isinstance(kind, T.MapType) else F.col(name)


def latest_per_key(df, keys, order):
    """The row of each key that comes last by `order`; ties fall to the other columns, so that the
    result does not depend on the partitioning. Columns may hold maps."""
    rest = [c for c in df.columns if c not in keys]
    ties = [_orderable(df, c) for c in rest if c not in order]
    last = F.max_by(F.struct(*rest), F.struct(*order, *ties)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*").select(*df.columns)
