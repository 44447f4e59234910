"""Connected components of a graph by repeated contraction, in tables."""

from pyspark.sql import functions as F

from .common import stored


def components(edges):
    """(vertex, root) for every vertex of `edges` (a, b: long), the root being one vertex of its
    component. Null ends are ignored. `edges` is evaluated once, so it need not give the same edges
    again when it is.

    Each round maps every vertex to its least neighbour and replaces the edges by those between
    the images, until none is left; the number of rounds grows with the logarithm of the longest
    chain. Vertices are compared by a hash, so that a chain in numeric order is no bad case. A
    vertex with very many edges meets one row per vertex in each join.
    """
    once = stored(edges.where("a <> b").select("a", "b"), "link-edges")
    both = stored(once.union(once.select(F.col("b"), F.col("a"))).distinct(), "links")
    members = None
    while not both.isEmpty():
        least = F.min(F.struct(F.xxhash64("b").alias("k"), F.col("b").alias("v"))).alias("least")
        own = F.struct(F.xxhash64("a").alias("k"), F.col("a").alias("v"))
        image = stored(
            both.groupBy("a").agg(least)
            .select(F.col("a").alias("x"), F.least("least", own)["v"].alias("y")),
            "link-images",
        )
        if members is None:
            members = image.select(F.col("x").alias("vertex"), F.col("y").alias("root"))
        else:
            moved = members.join(image, F.col("root") == F.col("x"), "left")
            members = moved.select("vertex", F.coalesce("y", "root").alias("root"))
            members = stored(members, "link-members")
        half = both.join(image, F.col("a") == F.col("x")).select(F.col("y").alias("a"), "b")
        other = image.select("x", F.col("y").alias("z"))
        moved = half.join(other, F.col("b") == F.col("x")).select("a", F.col("z").alias("b"))
        both = stored(moved.where("a <> b").distinct(), "links")
    if members is None:
        return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).limit(0)
    return members
