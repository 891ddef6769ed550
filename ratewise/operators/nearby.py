"""Neighbourhood by distance: statistics of the businesses within a radius.

Places are points on the sphere in three coordinates, cut into cubes as wide as the radius, so a place's neighbours lie in
its cube or one of the 26 around it, at the poles and the date line too. Businesses at one place are summed up first.
Places join the cubes around them by cube, an equi-join, and the great-circle distance decides.

A dense cube is dealt into parts of about ``PART`` places, those that look and those that are looked at, and each part of the one
meets each part of the other: a task sees two parts, however full the cube is.

Defined cases: businesses without a position have no neighbours and are none (null counts as position); one without stars
counts as neighbour but not for the mean; copies of a row are neighbours of each other.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions import columns as X

EARTH_KM = 6371.0
PART = 2000


def radius_stats(business: DataFrame, radius_km: float, part: int = PART) -> DataFrame:
    """business_id, n_near (other businesses within ``radius_km``), near_avg_stars (null without any) and diff (own stars minus it)."""
    stars = F.col("stars").cast("double")
    rows = business.select("business_id", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"), stars.alias("stars"))
    located = rows.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    places = located.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"), F.count("stars").alias("rated"), F.sum("stars").alias("s"))

    wide = 2 * math.sin(min(radius_km / EARTH_KM, math.pi) / 2) * (1 + 1e-9) + 1e-12  # chord of the radius on the unit sphere
    lat, lon = F.radians("lat"), F.radians("lon")
    cube = [F.floor(c / wide).cast("bigint") for c in (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))]
    placed = places.select("lat", "lon", "n", "rated", "s", *[c.alias(x) for c, x in zip(cube, "xyz")])
    sizes = placed.groupBy("x", "y", "z").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts"))

    steps = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    looking = placed.select("lat", "lon", *"xyz")
    for c in "xyz":
        looking = looking.withColumn("_d", F.explode(steps)).withColumn(c, F.col(c) + F.col("_d")).drop("_d")
    # a place looks into cubes that hold something; its part there is by its hash
    looks = looking.join(sizes, list("xyz"))
    asked = looks.groupBy("x", "y", "z").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("askers"))
    looks = looks.join(asked, list("xyz")).select(
        *"xyz", F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"),
        F.pmod(F.xxhash64("lat", "lon"), F.col("askers")).cast("int").alias("asker"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    held = placed.join(sizes, list("xyz")).join(asked, list("xyz")).select(
        *"xyz", "lat", "lon", "n", "rated", "s", F.pmod(F.xxhash64("lat", "lon"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("askers") - 1)).alias("asker"))
    near = looks.join(held, [*"xyz", "asker", "part"]).filter(X.haversine_km("a_lat", "a_lon", "lat", "lon") <= radius_km)
    around = near.groupBy(F.col("a_lat").alias("lat"), F.col("a_lon").alias("lon")).agg(
        F.sum("n").alias("n"), F.sum("rated").alias("rated"), F.sum("s").alias("s"))

    own = F.when(F.col("stars").isNull(), 0).otherwise(1)
    joined = rows.join(around, ["lat", "lon"], "left")
    n = F.coalesce(F.col("n") - 1, F.lit(0))
    mean = F.try_divide(F.col("s") - F.coalesce("stars", F.lit(0.0)), F.col("rated") - own)
    return joined.select("business_id", n.cast("bigint").alias("n_near"), mean.alias("near_avg_stars"), (F.col("stars") - mean).alias("diff"))
