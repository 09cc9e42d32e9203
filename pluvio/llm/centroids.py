"""Clustering around centroids in exact integer arithmetic, by JVM expressions only.

Vectors are turned into integers, so that distances, sums and means have one
right value in whatever order Spark adds them. A distance is v.v - 2 v.c + c.c:
v.v is computed once, and v.c is ``aggregate`` over ``zip_with`` of the vector
and a literal centroid array. ``array_min`` over the structs (distance, number)
picks the cluster, ties to the smaller number. A round adds up each component
in a column of its own, so the vectors are aggregated where they are read:
one row for each cluster and task is shuffled, and one for each cluster comes
to the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import staged

CLUSTERS, ROUNDS, COMPONENTS, SCALE = 16, 3, 64, 64
LONGEST = (1 << 63) - 1
#: Larger components are taken as this one, with its sign: their distances are past 64 bits anyway.
CLAMP = 1 << 59
WIDE = "decimal(38,0)"


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, e): ``floor(scale * x)`` of every component, of the vectors
    that have exactly ``components`` of them, none null or non-finite."""
    v = F.col(f"`{vector_col}`")
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    whole = lambda x: F.greatest(F.lit(-CLAMP), F.least(
        F.lit(CLAMP), F.floor(F.lit(float(scale)) * x.cast("double"))))
    return (vectors.where((F.size(v) == components) & F.forall(v, sound))
            .select(F.col(f"`{id_col}`").alias("vec_id"), F.transform(v, whole).alias("e")))


def _dot(left: Column, right: Column, number: str) -> Column:
    """The inner product of two arrays of ``number``."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: (a * b).cast(number)),
                       F.lit(0).cast(number), lambda total, x: (total + x).cast(number))


def _nearest(centroids: list[list[int]], number: str) -> Column:
    """(distance, cluster) of the nearest centroid to the vector ``e``, whose inner product with itself is ``own``."""
    def distance(centroid: list[int]) -> Column:
        literal = F.expr(f"array({','.join(str(-2 * c) for c in centroid)})").cast(f"array<{number}>")
        square = F.lit(sum(c * c for c in centroid)).cast(number)
        return (F.col("own") + square + _dot(F.col("e").cast(f"array<{number}>"), literal, number)).cast(number)

    return F.array_min(F.array(*[
        F.struct(distance(c).alias("distance"), F.lit(n).alias("cluster")) for n, c in enumerate(centroids)]))


def _moved(vectors: DataFrame, centroids: list[list[int]], number: str) -> list[list[int]]:
    """Every centroid at the floor of its vectors' mean; empty ones stay."""
    size = len(centroids[0])
    sums = (vectors.select(_nearest(centroids, number)["cluster"].alias("cluster"), "e")
            .groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[
                F.expr(f"sum(cast(get(e, {i}) as {number})) as s{i}") for i in range(size)]))
    new = list(centroids)
    for row in sums.collect():  # one row a cluster
        new[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(size)]
    return new


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS,
            rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE, seed: int = 1) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared),
    cluster_inertia, inertia (distances summed over the cluster and over
    all) and centroid_sha256 (of the final centroid's components, joined by
    commas).

    The first centroids are the ``k`` vectors with the smallest SHA-256 of
    ``seed:vec_id`` (ties by the vector itself; rows without an id come last).
    Null vectors, and those with another number of components or with a
    null, NaN or infinite one, are left out. Rows that repeat an id or a
    vector are vectors of their own. With fewer than ``k`` vectors each one
    is a centroid; an empty table gives an empty result. Columns beside the
    two are not read. Values whose sums could pass 64 bits are computed as
    decimals; a distance or inertia above 2^63 - 1 is returned as that, and
    components beyond 2^59 count as 2^59.
    """
    whole = staged(whole_vectors(vectors, id_col, vector_col, components, scale), "vectors")
    n, largest = whole.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("e", F.abs)))).first()
    largest = largest or 0
    number = "long" if max(components * (2 * largest) ** 2, n * largest) <= LONGEST else WIDE
    itself = F.col("e").cast(f"array<{number}>")
    whole = staged(whole.withColumn("own", _dot(itself, itself, number)), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = whole.orderBy(order.asc_nulls_last(), "e").limit(k).collect()  # k rows
    centroids = [list(row["e"]) for row in first]
    for _ in range(rounds if centroids else 0):
        centroids = _moved(whole, centroids, number)

    near = _nearest(centroids, number) if centroids else F.struct(
        F.lit(0).cast(number).alias("distance"), F.lit(0).alias("cluster"))
    assigned = staged(whole.select("vec_id", near.alias("near")).select(
        "vec_id", F.col("near.cluster").cast("int").alias("cluster"),
        F.least(F.col("near.distance"), F.lit(LONGEST)).cast("long").alias("distance")), "assigned")
    sums = {row["cluster"]: int(row["total"]) for row in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast(WIDE)).alias("total")).collect()}  # one row a cluster
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of_cluster = lambda values: F.get(F.array(*map(F.lit, values or [None])), F.col("cluster"))
    return assigned.select(
        "vec_id", "cluster", "distance",
        of_cluster([min(sums.get(c, 0), LONGEST) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(min(sum(sums.values()), LONGEST)).cast("long").alias("inertia"),
        of_cluster(digests).cast("string").alias("centroid_sha256"))
