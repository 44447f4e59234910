"""Left-outer lookups of dimension attributes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..schemas import REGION_ATTRIBUTES, REGION_ROOT
from ..session import work_folder

def lookup_join(df, dim, key, columns, dim_key="id"):
    """Add attributes of the dimension row whose `dim_key` equals `key`; null without one.

    `columns` maps new names to dimension columns. `dim_key` is unique in `dim`. There is no
    hint here: Catalyst broadcasts `dim` while its file size stays below
    `spark.sql.autoBroadcastJoinThreshold`.
    """
    picked = dim.select(
        F.col(dim_key).alias("_lookup"), *[F.col(src).alias(new) for new, src in columns.items()]
    )
    return df.join(picked, F.col(key) == F.col("_lookup"), "left").drop("_lookup")


def lookup_as_of(df, history, key, columns, time="ts"):
    """Add attributes of the version of the dimension row that was in force at `time`; null without one.

    `history` has the versions of every `id` (see `dimension.versions`): `since` in milliseconds, `seq`
    to order those of one moment, `gone` for deletes. The first version also holds before its time,
    because an initial load tells when a row was read and not since when it was so, unless it is a
    delete. Every row meets one version at most, so the join neither repeats rows nor needs a sort of
    them; adaptive execution splits hot keys. Null keys and null times find nothing.
    """
    order = Window.partitionBy("id").orderBy("since", "seq")
    spans = history.where("id IS NOT NULL").select(
        F.col("id").alias("_lookup"), "gone", F.lead("since").over(order).alias("_until"),
        F.when(F.lag("since").over(order).isNotNull(), F.col("since")).alias("_since"),
        *[F.col(src).alias(new) for new, src in columns.items()],
    ).where("NOT gone")
    at = F.col(time)
    found = (F.col(key) == F.col("_lookup")) & at.isNotNull()
    found &= F.coalesce(F.col("_since") <= at, F.lit(True)) & F.coalesce(at < F.col("_until"), F.lit(True))
    return df.join(spans, found, "left").drop("_lookup", "gone", "_since", "_until")


def flatten_regions(regions):
    """City and province of every region: (region_id, city_id, city_name, province_id, ...).

    Every region is walked up to the country root or to a missing parent, however deep. Each round
    joins the tables with itself and doubles the steps walked; a round is written to the work
    folder, so the plan stays small. A cycle raises an error.
    """

    def own(code, c):
        return F.when(F.col("dict_code") == code, F.col(c))

    spark = regions.sparkSession

    def written(df):
        path = work_folder(spark, "regions")
        df.write.parquet(path)
        return spark.read.parquet(path)

    parent = F.when(F.col("parent_id") != REGION_ROOT, F.col("parent_id"))
    found = written(regions.where(F.col("id") != REGION_ROOT).select(
        "id",
        parent.alias("up"),
        own("City", "id").alias("city_id"),
        own("City", "name").alias("city_name"),
        own("Province", "id").alias("province_id"),
        own("Province", "name").alias("province_name"),
    ))
    steps, size = 1, found.count()
    while not found.where("up IS NOT NULL").isEmpty():
        if steps > 2 * size:
            raise ValueError("the region tree has a cycle")
        above = found.select([F.col(c).alias(f"up_{c}") for c in found.columns])
        joined = found.join(above, F.col("up") == F.col("up_id"), "left")
        found = written(joined.select(
            "id", F.col("up_up").alias("up"),
            *[F.coalesce(f"up_{c}", c).alias(c) for c in REGION_ATTRIBUTES],
        ))
        steps *= 2
    return found.select(F.col("id").alias("region_id"), *REGION_ATTRIBUTES)


def join_region(df, regions, key="region_id"):
    """Add the city and the province of `key`; null where the tree does not have them. `regions` is the
    tree, or the table that `flatten_regions` made of it."""
    flat = regions if "region_id" in regions.columns else flatten_regions(regions)
    flat = flat.withColumnRenamed("region_id", "_region")
    return df.join(flat, F.col(key) == F.col("_region"), "left").drop("_region")
