"""Helpers shared by the corpus operators."""

import atexit
import shutil
import tempfile
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyspark.sql import functions as F

from ..session import work_folder

#: Rows of (long, digest) that are broadcast at most: about 12 MB in an executor.
BROADCAST_ROWS = 100_000
#: Rows of whole texts that a Python worker is given at once; Spark's 10,000 may be a task's whole input.
TEXT_ROWS = 512


@cache
def _package_archive():
    """A zip of this package on the driver, from where Spark serves it, for as long as it runs."""
    package, folder = Path(__file__).parents[1], tempfile.mkdtemp(prefix="freightflow-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)


def send_package(spark):
    """Send this package to the executors, as --py-files does; once for each context."""
    context = spark.sparkContext
    if not getattr(context, "_freightflow_sent", False):
        context.addPyFile(_package_archive())
        context._freightflow_sent = True


def map_arrow(df, function, schema):
    """`df.mapInArrow` with this package on the executors."""
    send_package(df.sparkSession)
    return df.mapInArrow(function, schema)


@contextmanager
def text_batches(spark):
    """What is written meanwhile gives Python workers batches of at most TEXT_ROWS rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows = int(before)
    spark.conf.set(key, str(min(rows, TEXT_ROWS) if rows > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df, name):
    """`df` written to the shared work folder and read again.

    Cuts the lineage, so a lost executor costs no more than a reread, and lets a join put its
    exchange directly on the scan, where adaptive execution can split hot keys.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def whole_text(name="text"):
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def small_side(df, rows=BROADCAST_ROWS):
    """`df`, a stored table of narrow rows, with a broadcast hint if it is counted as small.

    Beyond `rows` the join shuffles, and adaptive execution splits skewed keys.
    """
    return F.broadcast(df) if df.count() <= rows else df


def sampled(df, key, rows, total):
    """About `rows` of the `total` rows of `df`, chosen by a hash of `key`: the same on every
    run and for every partitioning."""
    share = min(1.0, rows / max(total, 1))
    if share >= 1.0:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) < int(share * (1 << 30)))


def crc_mod(key, modulus):
    """crc32 of the decimal text of `key`, modulo `modulus`; null stays null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus
