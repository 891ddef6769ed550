"""Serving-side feature vector and attribute coding.

The serving layout differs from the training layout (Q19); it is kept as its
own operator and computed for a whole set of strict pairs at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.functions import columns as X
from ratewise.operators import features as FE

# Attribute names of serving slots 9-22, in slot order.
SERVING_ATTRIBUTES = (
    "BusinessAcceptsCreditCards", "RestaurantsPriceRange2", "WiFi", "OutdoorSeating",
    "BikeParking", "HasTV", "RestaurantsDelivery", "RestaurantsTakeOut", "GoodForKids",
    "Alcohol", "NoiseLevel", "RestaurantsAttire", "Ambience", "Parking",
)
N_SLOTS = 36
DEFAULT_STARS = 3.0


def attribute_codes(business: DataFrame) -> DataFrame:
    """business_id + one numeric code per serving attribute (a_<name>).

    ``attributes`` is a variant (JSON types kept apart: a number keeps its value) or a
    ``map<string,string>`` (a number is text there and codes as text does)."""
    code = X.attribute_coder(business)
    return business.select("business_id", *[code(a).alias(f"a_{a}") for a in SERVING_ATTRIBUTES])


def true_attributes(business: DataFrame, n: int = 5) -> DataFrame:
    """business_id + the first n true attribute names as text."""
    names = (X.true_attributes_variant if isinstance(business.schema["attributes"].dataType, T.VariantType)
             else X.true_attributes)
    return business.select("business_id", names("attributes", n).alias("features_text"))


def tenure_years(users: DataFrame, as_of_date: str) -> DataFrame:
    """user_id + years since yelping_since."""
    return users.select("user_id", X.tenure_years("yelping_since", as_of_date).alias("tenure_years"))


def serving_features(pairs: DataFrame, users: DataFrame, business: DataFrame, tips: DataFrame,
                     as_of_date: str, unique_ids: bool = False) -> DataFrame:
    """V1: ids + f0..f35 for strict pairs (both ids known, as in the page flow)."""
    u = users.select("user_id", "review_count", "average_stars", "useful", "funny", "cool", "fans", "yelping_since")
    b = business.select("business_id", "review_count", "stars", "attributes")
    if not unique_ids:
        u, b = FE.dedupe(u, "user_id", ["review_count"]), FE.dedupe(b, "business_id", ["review_count"])
    code = X.attribute_coder(b)
    ut = tips.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_user_tips"))
    bt = tips.groupBy("business_id").agg(F.count(F.lit(1)).alias("n_business_tips"))
    us = u.join(ut, "user_id", "left").select(
        "user_id",
        F.coalesce(F.col("review_count").cast("double"), F.lit(0.0)).alias("f0"),
        F.coalesce(F.col("average_stars").cast("double"), F.lit(DEFAULT_STARS)).alias("f1"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"f{i}")
          for i, c in enumerate(("useful", "funny", "cool", "fans"), start=2)],
        X.tenure_years("yelping_since", as_of_date).alias("f6"),
        F.coalesce(F.col("n_user_tips").cast("double"), F.lit(0.0)).alias("f23"))
    bs = b.join(bt, "business_id", "left").select(
        "business_id",
        F.coalesce(F.col("review_count").cast("double"), F.lit(0.0)).alias("f7"),
        F.coalesce(F.col("stars").cast("double"), F.lit(DEFAULT_STARS)).alias("f8"),
        *[code(a).alias(f"f{9 + i}") for i, a in enumerate(SERVING_ATTRIBUTES)],
        F.coalesce(F.col("n_business_tips").cast("double"), F.lit(0.0)).alias("f24"))
    j = pairs.select("user_id", "business_id").join(us, "user_id", "inner").join(bs, "business_id", "inner")
    slots = {f"f{i}": F.col(f"f{i}") for i in list(range(0, 25))}
    slots["f25"] = F.col("f1") * F.col("f8")
    slots["f26"] = F.col("f0") * F.col("f7")
    for i in range(27, N_SLOTS):
        slots[f"f{i}"] = F.lit(0.0)
    return j.select("user_id", "business_id", *[slots[f"f{i}"].alias(f"f{i}") for i in range(N_SLOTS)])
