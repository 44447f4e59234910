"""Sparse rows over a vocabulary that no single task could hold.

Rows are cut into shards of bounded size. A shard numbers its own terms, and its rows refer to these
numbers: `terms` and `counts`, the values of a compressed sparse row matrix whose row limits are those
of the lists. What a term stands for in the whole corpus comes back per shard, from a join over the
distinct terms of each shard instead of over all occurrences.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import send_package


def cut(batches, column, size):
    """The rows of Arrow batches as tables of about `size` bytes of `column`; a larger row stands alone."""
    held, total = [], 0
    for batch in batches:
        start = 0
        for i, value in enumerate(batch[column]):
            total += len(value.as_buffer()) if value.is_valid else 0
            if total >= size:
                whole = pa.Table.from_batches([*held, batch.slice(start, i + 1 - start)]).combine_chunks()
                held, total, start = [], 0, i + 1
                yield whole
        if start < len(batch):
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def sparse(owner, term, rows, size):
    """Lists (terms, counts) of `rows` rows from occurrences: occurrence i is `term[i]`, below `size`,
    in row `owner[i]`."""
    cells, counts = np.unique(owner * np.int64(size) + term, return_counts=True)
    limits = np.searchsorted(cells, np.arange(rows + 1, dtype=np.int64) * size).astype(np.int32)
    return [
        pa.ListArray.from_arrays(pa.array(limits), pa.array(values.astype(np.int32)))
        for values in (cells % max(size, 1), counts)
    ]


def names(local):
    """(shard, place, name): the vocabulary rows of the stored shards `local`, one per term."""
    listed = local.where("names IS NOT NULL").select("shard", "names")
    return listed.select("shard", F.posexplode("names").alias("place", "name"))


def _replaced(kind):
    def run(rows, values):
        table = np.zeros(values.num_rows, kind)
        table[values["place"].to_numpy()] = values["value"].to_numpy()
        terms = rows["terms"].combine_chunks()
        found = pa.ListArray.from_arrays(terms.offsets, pa.array(table[terms.values.to_numpy()]))
        return rows.set_column(rows.schema.get_field_index("terms"), "terms", found)

    return run


def with_values(local, values, kind):
    """The rows of the stored shards `local` with the `value` (long or double) of every term in place
    of its number; `values` has (shard, place, value) for each."""
    send_package(local.sparkSession)
    rows = local.where("names IS NULL").drop("names")
    fields = [f if f.name != "terms" else None for f in rows.schema]
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" if f else f"terms array<{kind}>" for f in fields
    )
    number = np.int64 if kind in ("long", "bigint") else np.float64
    pairs = values.select(F.col("shard").alias("_shard"), "place", "value")
    return rows.groupBy("shard").cogroup(pairs.groupBy("_shard")).applyInArrow(_replaced(number), schema)
