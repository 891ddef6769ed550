"""Global statistics.

Each statistic is one aggregate without grouping keys: partial aggregates per
task, one tiny final merge. Consumers attach them as uncorrelated scalar
subqueries (``DataFrame.scalar()``) - Catalyst runs the subquery once and
inlines its one value, so no cross join or driver loop is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def user_global_stats(users: DataFrame) -> DataFrame:
    """A1: sum(review_count), avg(average_stars), max(review_count) in one pass."""
    rc = F.coalesce(F.col("review_count"), F.lit(0)).cast("double")
    return users.agg(
        F.coalesce(F.sum(rc), F.lit(0.0)).alias("total_reviews"),
        F.coalesce(F.avg(F.col("average_stars").cast("double")), F.lit(0.0)).alias("avg_user_stars"),
        F.coalesce(F.max(rc), F.lit(0.0)).alias("max_user_reviews"),
    )


def business_global_stats(business: DataFrame) -> DataFrame:
    """A2: avg(stars), max(review_count)."""
    return business.agg(
        F.coalesce(F.avg(F.col("stars").cast("double")), F.lit(0.0)).alias("avg_business_stars"),
        F.coalesce(F.max(F.coalesce(F.col("review_count"), F.lit(0)).cast("double")),
                   F.lit(0.0)).alias("max_business_reviews"),
    )


def global_stats(users: DataFrame, business: DataFrame) -> DataFrame:
    """A3: the five statistics as one row; 0 for empty tables.

    Both sides are single-row aggregates; the business row is attached as a
    scalar subquery instead of a join.
    """
    b = business_global_stats(business)
    return user_global_stats(users).select(
        "total_reviews", "avg_user_stars", "max_user_reviews",
        b.select("avg_business_stars").scalar().alias("avg_business_stars"),
        b.select("max_business_reviews").scalar().alias("max_business_reviews"),
    )


def scalars(stats: DataFrame) -> Column:
    """All statistics of a one-row aggregate as one struct-valued scalar subquery;
    fields are read with ``col[name]`` and the subquery runs once per query."""
    return stats.select(F.struct(*stats.columns).alias("s")).scalar()


def feature_minmax(wide: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, min_value, max_value) from a one-row table of mn__<c>, mx__<c>."""
    stack = "stack({n}, {items}) AS (feature, min_value, max_value)".format(
        n=len(columns),
        items=", ".join(f"'{c}', `mn__{c}`, `mx__{c}`" for c in columns))
    return wide.selectExpr(stack)
