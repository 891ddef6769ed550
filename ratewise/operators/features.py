"""Entity, tip and interaction features.

Column order inside each group follows the 36-slot contract of the model
input: 17 user slots, 9 business slots, 6 tip slots, 4 interaction slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.functions import columns as X
from ratewise.operators import stats as S

# Slot names of the 36-feature vector, in slot order.
USER_SLOTS = [
    "u_average_stars", "u_review_count", "u_useful", "u_funny", "u_cool", "u_fans",
    "u_elite_years", "u_review_ratio", "u_star_diff", "u_engagement_score", "u_years_active",
    "u_normalized_reviews", "u_total_feedback", "u_reviews_per_year", "u_fans_per_review",
    "u_elite_years_ratio", "u_feedback_per_review",
]
BUSINESS_SLOTS = [
    "b_stars", "b_review_count", "b_is_open", "b_star_diff", "b_normalized_stars",
    "b_normalized_reviews", "b_review_density", "b_is_restaurant", "b_category_count",
]
TIP_SLOTS = ["ut_count", "ut_likes", "ut_avg_length", "bt_count", "bt_likes", "bt_avg_length"]
INTERACTION_SLOTS = ["x_stars", "x_reviews", "x_engagement", "x_star_diff"]
FEATURES = USER_SLOTS + BUSINESS_SLOTS + TIP_SLOTS + INTERACTION_SLOTS

# Category names that mark a restaurant for feature slot 24.
RESTAURANT_WORDS = ("restaurant", "food")
# Fixed value: the year that review density counts from.
FIRST_YEAR = 2004


def dedupe(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, keeping the row with the largest ``order`` tuple (Q1).

    A ``max(struct(..))`` aggregate instead of a window: it combines map-side,
    so a key repeated on a third of the rows never lands whole in one task.
    The output is hash-partitioned by ``key``, which the following join reuses.
    The struct makes it a sort-based aggregate; callers whose ids are unique
    skip it (``unique_ids``).
    """
    rest = [c for c in df.columns if c != key and c not in order]
    orderable = [c for c in order + rest
                 if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (df.groupBy(key).agg(F.max_by(packed, F.struct(*orderable)).alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in order + rest]))


def user_features(users: DataFrame, as_of_year: int, unique_ids: bool = False) -> DataFrame:
    """2.3: user_id + 17 double features.

    The three global statistics are computed over all user rows (as the
    reference does) and attached as scalar subqueries.
    """
    u = users.select("user_id", "review_count", "average_stars", "useful", "funny", "cool", "fans",
                     "elite", "yelping_since")
    u = u if unique_ids else dedupe(u, "user_id", ["review_count"])
    # the statistics struct is projected once, so its subquery runs once
    u = u.withColumn("_st", S.scalars(S.user_global_stats(users)))
    total, avg_stars, max_reviews = (F.col("_st.total_reviews"), F.col("_st.avg_user_stars"),
                                     F.col("_st.max_user_reviews"))
    d = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    rc, stars = d("review_count"), d("average_stars")
    useful, funny, cool, fans = d("useful"), d("funny"), d("cool"), d("fans")
    feedback = useful + funny + cool
    elite = X.count_parts("elite").cast("double")
    years = F.coalesce(F.lit(as_of_year) - X.year_prefix("yelping_since"), F.lit(1)).cast("double")
    guard = X.at_least_one(years)
    return u.select(
        F.col("user_id"),
        stars.alias("u_average_stars"),
        rc.alias("u_review_count"),
        useful.alias("u_useful"),
        funny.alias("u_funny"),
        cool.alias("u_cool"),
        fans.alias("u_fans"),
        elite.alias("u_elite_years"),
        X.safe_ratio(rc, total).alias("u_review_ratio"),
        (stars - avg_stars).alias("u_star_diff"),
        X.safe_ratio(feedback, rc + 1).alias("u_engagement_score"),
        years.alias("u_years_active"),
        X.safe_ratio(rc, max_reviews).alias("u_normalized_reviews"),
        feedback.alias("u_total_feedback"),
        (rc / guard).alias("u_reviews_per_year"),
        X.safe_ratio(fans, rc + 1).alias("u_fans_per_review"),
        (elite / guard).alias("u_elite_years_ratio"),
        X.safe_ratio(feedback, rc + 1).alias("u_feedback_per_review"),
    )


def business_features(business: DataFrame, as_of_year: int, unique_ids: bool = False) -> DataFrame:
    """2.4: business_id + 9 double features."""
    b = business.select("business_id", "stars", "review_count", "is_open", "categories")
    b = b if unique_ids else dedupe(b, "business_id", ["review_count"])
    b = b.withColumn("_st", S.scalars(S.business_global_stats(business)))
    avg_stars, max_reviews = F.col("_st.avg_business_stars"), F.col("_st.max_business_reviews")
    d = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    stars, rc = d("stars"), d("review_count")
    return b.select(
        F.col("business_id"),
        stars.alias("b_stars"),
        rc.alias("b_review_count"),
        d("is_open").alias("b_is_open"),
        (stars - avg_stars).alias("b_star_diff"),
        (stars / 5.0).alias("b_normalized_stars"),
        X.safe_ratio(rc, max_reviews).alias("b_normalized_reviews"),
        (rc / F.lit(float(max(1, as_of_year - FIRST_YEAR)))).alias("b_review_density"),
        F.when(X.any_part_in("categories", RESTAURANT_WORDS), F.lit(1.0)).otherwise(F.lit(0.0))
        .alias("b_is_restaurant"),
        X.count_parts("categories").cast("double").alias("b_category_count"),
    )


def _tip_stats(tips: DataFrame, key: str) -> DataFrame:
    """count, sum(likes), sum(len(text))/count per key: a partial + final hash aggregate."""
    return tips.groupBy(key).agg(
        F.count(F.lit(1)).alias("tip_count"),
        F.coalesce(F.sum(F.coalesce(F.col("likes"), F.lit(0))), F.lit(0)).cast("bigint").alias("tip_likes"),
        (F.sum(X.text_length("text")).cast("double") / F.count(F.lit(1))).alias("tip_avg_length"),
    )


def user_tip_stats(tips: DataFrame) -> DataFrame:
    """2.5 slots 26-28."""
    return _tip_stats(tips, "user_id")


def business_tip_stats(tips: DataFrame) -> DataFrame:
    """2.5 slots 29-31."""
    return _tip_stats(tips, "business_id")


def _interactions():
    return [
        (F.col("u_average_stars") * F.col("b_stars")).alias("x_stars"),
        (F.col("u_review_count") * F.col("b_review_count")).alias("x_reviews"),
        (F.col("u_engagement_score") * F.col("b_review_density")).alias("x_engagement"),
        (F.col("u_star_diff") * F.col("b_star_diff")).alias("x_star_diff"),
    ]


def user_side(users: DataFrame, tips: DataFrame, as_of_year: int, unique_ids: bool = False) -> DataFrame:
    """User features joined with the user's tip stats: one table keyed by user_id."""
    uf = user_features(users, as_of_year, unique_ids)
    ut = user_tip_stats(tips).select(
        "user_id", F.col("tip_count").alias("ut_count"), F.col("tip_likes").alias("ut_likes"),
        F.col("tip_avg_length").alias("ut_avg_length"))
    # Full outer: a user id that only has tips still gets its tip slots.
    return uf.join(ut, "user_id", "full_outer")


def business_side(business: DataFrame, tips: DataFrame, as_of_year: int, unique_ids: bool = False) -> DataFrame:
    bf = business_features(business, as_of_year, unique_ids)
    bt = business_tip_stats(tips).select(
        "business_id", F.col("tip_count").alias("bt_count"), F.col("tip_likes").alias("bt_likes"),
        F.col("tip_avg_length").alias("bt_avg_length"))
    return bf.join(bt, "business_id", "full_outer")


def attach_features(pairs: DataFrame, users: DataFrame, business: DataFrame, tips: DataFrame,
                    as_of_year: int, unique_ids: bool = False) -> DataFrame:
    """Left-join the per-key feature tables onto pairs and fill the 36 slots.

    Two joins in total (one per key): each side is pre-joined with its tip
    stats. Nothing runs here; AQE broadcasts a side whose measured size is
    under the threshold, else it is a sort-merge join in which AQE splits a
    skewed pairs partition (a hot user or business) across tasks.
    """
    return attach_sides(pairs, user_side(users, tips, as_of_year, unique_ids),
                        business_side(business, tips, as_of_year, unique_ids))


def attach_sides(pairs: DataFrame, us: DataFrame, bs: DataFrame) -> DataFrame:
    """Pairs left-joined with user and business sides; missing slots are 0.

    Also used with a streaming ``pairs`` (stream-static left joins)."""
    # the side with fewer columns first: its columns are shuffled on to the second join
    j = pairs.join(bs, "business_id", "left").join(us, "user_id", "left")
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    keep = [c for c in pairs.columns]
    filled = j.select(*keep, *[zero(c) for c in USER_SLOTS + BUSINESS_SLOTS + TIP_SLOTS])
    return filled.select(*keep, *[F.col(c) for c in USER_SLOTS + BUSINESS_SLOTS + TIP_SLOTS],
                         *_interactions())


def pair_features(reviews: DataFrame, users: DataFrame, business: DataFrame, tips: DataFrame,
                  as_of_year: int, unique_ids: bool = False) -> DataFrame:
    """user_id, business_id, rating and the 36 features, one row per review.

    ``unique_ids`` tells that users and business have one row per id."""
    pairs = reviews.select("user_id", "business_id", F.col("stars").cast("double").alias("rating"))
    return attach_features(pairs, users, business, tips, as_of_year, unique_ids)


def pair_features_unlabelled(pairs: DataFrame, users: DataFrame, business: DataFrame,
                             tips: DataFrame, as_of_year: int, unique_ids: bool = False) -> DataFrame:
    """The same job on test pairs without a label."""
    return attach_features(pairs.select("user_id", "business_id"), users, business, tips, as_of_year, unique_ids)


# The entity columns that the four products of 2.6 are made of.
PRODUCT_USER = ["u_average_stars", "u_review_count", "u_engagement_score", "u_star_diff"]
PRODUCT_BUSINESS = ["b_stars", "b_review_count", "b_review_density", "b_star_diff"]


def products(pairs: DataFrame, uf: DataFrame, bf: DataFrame) -> DataFrame:
    """Columns of ``pairs`` + the four products from the feature sides; a missing side counts as 0."""
    j = (pairs.join(uf.select("user_id", *PRODUCT_USER), "user_id", "left")
         .join(bf.select("business_id", *PRODUCT_BUSINESS), "business_id", "left"))
    j = j.select(*pairs.columns, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in PRODUCT_USER + PRODUCT_BUSINESS])
    return j.select(*pairs.columns, *_interactions())


def interaction_features(pairs: DataFrame, users: DataFrame, business: DataFrame,
                         as_of_year: int, unique_ids: bool = False) -> DataFrame:
    """2.6: ids + the four products; a missing side counts as 0."""
    return products(pairs.select("user_id", "business_id"), user_features(users, as_of_year, unique_ids),
                    business_features(business, as_of_year, unique_ids))


def pair_minmax(pairs: DataFrame, us: DataFrame, bs: DataFrame) -> DataFrame:
    """One row mn__<slot>, mx__<slot> over the 36 features of ``pairs``, without building them.

    A per-entity slot takes the values of the entities that occur in ``pairs`` (0 for an
    unknown one), so its extremes come from the distinct ids; only the four products
    need a pass over the pairs.
    """
    def of(side: DataFrame, key: str, slots: list[str]) -> DataFrame:
        seen = pairs.select(key).distinct().join(side.select(key, *slots), key, "left")
        return minmax(seen.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in slots]), slots)

    parts = [of(us, "user_id", USER_SLOTS + TIP_SLOTS[:3]), of(bs, "business_id", BUSINESS_SLOTS + TIP_SLOTS[3:]),
             minmax(products(pairs.select("user_id", "business_id"), us, bs), INTERACTION_SLOTS)]
    one = parts[0]
    for k, p in enumerate(parts[1:]):  # one-row tables: attached as scalar subqueries
        one = one.withColumn(f"_p{k}", S.scalars(p))
    wide = {c: F.col(c) for c in parts[0].columns}
    for k, p in enumerate(parts[1:]):
        wide |= {c: F.col(f"_p{k}")[c] for c in p.columns}
    return one.select(*[wide[f"{m}__{c}"].alias(f"{m}__{c}") for c in FEATURES for m in ("mn", "mx")])


def minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mn__<c>, mx__<c> for each column."""
    return df.agg(*[f(F.col(c).cast("double")).alias(f"{m}__{c}") for c in columns for m, f in (("mn", F.min), ("mx", F.max))])
