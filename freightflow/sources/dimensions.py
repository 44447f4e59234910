"""Dimension tables kept as appended changes in Parquet, read as the latest row of every key."""

import time

from pyspark.sql import functions as F

_STAMPS = "_ts long, _offset long, _gone boolean, _key string, _at long"


class DimensionStore:
    """Dimension tables in plain Parquet folders.

    A micro-batch appends its changes, one folder and no more, and a reader takes the latest row of each
    key with one aggregate. So a change costs what it is large, and the order in which batches bring
    changes does not matter. After `compact` folders the next change first writes the latest rows
    together, as the base of a new generation; a snapshot, and a dimension that is emptied, begin one
    too. A folder counts once its write is complete, a generation once it has such a folder, and the
    newest is the table. Readers keep the folders they have opened; older generations are removed after
    `keep_seconds`. Deleted keys stay as marked rows, so that an older change that comes later cannot
    revive them.
    """

    def __init__(self, spark, root, compact=32, keep_seconds=86_400):
        self.spark, self.root = spark, root
        self.compact, self.keep_seconds = compact, keep_seconds

    def _found(self, pattern):
        """(path, time of modification in ms) of what a pattern matches, on whatever file system."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        files = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(target)
        return [(f.getPath().toString(), f.getModificationTime()) for f in files or ()]

    def _generations(self, table="*"):
        """{table: {generation: its pointer}} of all complete folders; few, as they are compacted."""
        out = {}
        for path, at in self._found(f"{table}/*/*/_SUCCESS"):
            _, name, generation, _, _ = path.rsplit("/", 4)
            number, reset = map(int, generation.split("_"))
            pointer = out.setdefault(name, {}).setdefault(
                number, {"generation": number, "reset": reset, "paths": [], "written": 0}
            )
            pointer["paths"].append(path.rsplit("/", 1)[0])
            pointer["written"] = max(pointer["written"], at)
        for generations in out.values():
            for pointer in generations.values():
                pointer["paths"].sort()
                pointer["version"] = (pointer["generation"], pointer["written"], tuple(pointer["paths"]))
        return out

    def pointers(self):
        """{table: its newest generation}: `reset`, the folders `paths`, and `version`, which is equal as
        long as the table has not changed."""
        return {t: g[max(g)] for t, g in self._generations().items()}

    def _latest(self, pointer, schema):
        """The latest row of every key, deleted ones included. Of equal times the later write wins."""
        rows = self.spark.read.schema(f"{schema}, {_STAMPS}").parquet(*pointer["paths"])
        last = F.max_by(F.struct(*rows.columns), F.struct("_ts", "_offset", "_at")).alias("last")
        return rows.groupBy(F.col("_key").alias("_by")).agg(last).select("last.*")

    def open(self, pointer, schema):
        """The rows of a pointer; none without one."""
        if not pointer:
            return self.spark.createDataFrame([], schema)
        return self._latest(pointer, schema).where("NOT _gone").drop("_ts", "_offset", "_gone", "_key", "_at")

    def read(self, table, schema):
        """The current rows; none when the dimension does not exist."""
        return self.open(self.pointers().get(table), schema)

    def merge(self, table, schema, key, changes, batch=0, run="", reset=-1):
        """Append the last change of every key.

        `changes` have the columns of `schema` and `_ts`, `_offset`, `_gone`. The later of a key's row and
        its change by (_ts, _offset) stays, the change when they are equal. The run (the query of a
        checkpoint) and batch name the folder, so a repeat replaces what it wrote before. When `reset` is
        not that of the table, the table starts anew. Keys must not be null. Empty changes to a table
        that exists with this `reset` write nothing.
        """
        generations = self._generations(table).get(table, {})
        last = generations[max(generations)] if generations else None
        anew = last is None or last["reset"] != reset
        if not anew and changes.isEmpty():
            return
        number = max(generations, default=-1)
        if anew or len(last["paths"]) >= self.compact:
            number += 1
        folder = f"{self.root}/{table}/{number}_{reset}"
        if not anew and number > last["generation"]:
            self._latest(last, schema).write.mode("overwrite").parquet(f"{folder}/base")
        self._put(changes, key, f"{folder}/{run or 'none'}-{batch}")
        self._expire(generations, number)

    def write(self, table, snapshot, batch=0, run="", reset=-1, key=None):
        """Make `snapshot` all of the table. `key` is its first column unless given."""
        generations = self._generations(table).get(table, {})
        number = max(generations, default=-1) + 1
        nothing = F.lit(None).cast("long")
        rows = snapshot.select(
            "*", nothing.alias("_ts"), nothing.alias("_offset"), F.lit(False).alias("_gone")
        )
        self._put(rows, key or snapshot.columns[0], f"{self.root}/{table}/{number}_{reset}/base")
        self._expire(generations, number)

    def _put(self, rows, key, folder):
        named = rows.select(
            "*", F.col(key).cast("string").alias("_key"), F.lit(time.time_ns() // 1000).alias("_at")
        )
        named.write.mode("overwrite").parquet(folder)

    def _expire(self, generations, current):
        """Remove the generations before the current one that are past their age."""
        limit = (time.time() - self.keep_seconds) * 1000
        for number, pointer in generations.items():
            if number < current and pointer["written"] <= limit:
                remove(self.spark, pointer["paths"][0].rsplit("/", 1)[0])


def remove(spark, path):
    """Delete a folder on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def dic_lookup(dic, view=None):
    """The dictionary as (id, info struct<dic_name>), also registered as `view` for SQL jobs."""
    df = dic.select("id", F.struct(F.col("name").alias("dic_name")).alias("info"))
    if view:
        df.createOrReplaceTempView(view)
    return df
