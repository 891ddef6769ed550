"""Point-in-time history: what was known of a user or a business before each review.

Every review gets the statistics of the strictly earlier reviews of its key. The review itself and all others of the
same instant are left out, so a label never reaches its own feature.

A key's reviews are cut into slices of time. Slices are summed up (a decomposable aggregate), a window over the slices of
a key gives the state before each, and a window inside a slice adds the earlier reviews of that slice. So a key
with a third of all reviews is spread over as many tasks as it has slices, and no window sees it whole.

Defined cases: a review without a time has no history and is in none; one without stars counts as a visit (``recency``), not
as a rating (``rating_history``); equal reviews each have a row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Time of a slice: a key has at most one row per slice in the window over slices.
SLICE = "day"
EARLIER = "ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '0.000001' SECOND PRECEDING"

#: name, what a row gives, how rows and slices are put together
State = list[tuple[str, str, str]]


def with_state(reviews: DataFrame, key: str, state: State, slice_: str = SLICE) -> DataFrame:
    """``reviews`` (key, ts, ..) with each of ``state`` over the strictly earlier reviews of the key; null without any."""
    rows = reviews.withColumn("_slice", F.date_trunc(slice_, F.col("ts")))
    for name, value, _ in state:
        rows = rows.withColumn(f"_{name}", F.when(F.col("ts").isNotNull(), F.expr(value)))
    timed = rows.filter(F.col("_slice").isNotNull() & F.col(key).isNotNull())
    slices = timed.groupBy(key, "_slice").agg(*[F.expr(f"{how}(_{name})").alias(f"_{name}") for name, _, how in state])
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    prior = slices.select(key, "_slice", *[F.expr(f"{how}(_{name})").over(before).alias(f"_before_{name}") for name, _, how in state])
    inside = rows.join(prior, [key, "_slice"], "left").select("*", *[
        F.expr(f"{how}(_{name}) OVER (PARTITION BY {key}, _slice {EARLIER})").alias(f"_in_{name}") for name, _, how in state])
    whole = [together(how, F.col(f"_before_{name}"), F.col(f"_in_{name}")).alias(name) for name, _, how in state]
    return inside.select(*reviews.columns, *whole)


def together(how: str, a: Column, b: Column) -> Column:
    if how == "sum":
        return F.coalesce(a + b, a, b)
    return (F.least if how == "min" else F.greatest)(a, b)  # both skip nulls


# Sums of whole or half stars are exact, so the variance does not depend on the order.
RATINGS: State = [("n", "CASE WHEN stars IS NOT NULL THEN 1L ELSE 0L END", "sum"), ("s", "CAST(stars AS DOUBLE)", "sum"),
                  ("ss", "CAST(stars AS DOUBLE) * CAST(stars AS DOUBLE)", "sum"),
                  ("lo", "CAST(stars AS DOUBLE)", "min"), ("hi", "CAST(stars AS DOUBLE)", "max")]
VISITS: State = [("n", "1L", "sum"), ("first", "CAST(ts AS DATE)", "min"), ("last", "CAST(ts AS DATE)", "max")]
ROW = ["user_id", "business_id", "pair_key", "ts"]


def rating_history(reviews: DataFrame, key: str, slice_: str = SLICE) -> DataFrame:
    """K1 / K9 as of each review: n, mean, sample variance (0 for one), min and max of the key's earlier ratings; n is 0 and
    the others null for its first."""
    got = with_state(reviews.select(*ROW, "stars"), key, RATINGS, slice_)
    n, s, ss = F.coalesce("n", F.lit(0)), F.col("s"), F.col("ss")
    variance = F.when(n > 1, F.greatest(F.lit(0.0), (ss - s * s / n) / (n - 1))).when(n == 1, 0.0)
    return got.select(*ROW, n.cast("bigint").alias("n"), F.try_divide(s, n).alias("avg_rating"), variance.alias("var_rating"),
                      F.col("lo").alias("min_rating"), F.col("hi").alias("max_rating"))


def recency(reviews: DataFrame, key: str = "user_id", slice_: str = SLICE) -> DataFrame:
    """K2 as of each review: earlier reviews n, days from the first to the last of them (inclusive), days since the last,
    earlier reviews per active day; n is 0 and the others null for the first."""
    got = with_state(reviews.select(*ROW), key, VISITS, slice_)
    span = (F.datediff("last", "first") + 1).cast("bigint")
    return got.select(*ROW, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), span.alias("active_days"),
                      F.datediff(F.col("ts").cast("date"), "last").cast("bigint").alias("days_since_last"),
                      (F.col("n") / span).alias("reviews_per_day"))
