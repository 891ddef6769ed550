"""Fixed schemas of the four domain tables (no inference, see SURVEY 1.2/1.3)."""

from pyspark.sql import types as T

REVIEWS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
])

# Test pairs: the third column is ignored by the reference, may be absent.
PAIRS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("extra", T.StringType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("average_stars", T.DoubleType()),
    T.StructField("useful", T.LongType()),
    T.StructField("funny", T.LongType()),
    T.StructField("cool", T.LongType()),
    T.StructField("fans", T.LongType()),
    T.StructField("elite", T.StringType()),
    T.StructField("yelping_since", T.StringType()),
    T.StructField("friends", T.StringType()),
])

BUSINESS = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("is_open", T.LongType()),
    T.StructField("categories", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("hours", T.MapType(T.StringType(), T.StringType())),
])

# The same business table with ``attributes`` kept as a variant: JSON numbers,
# booleans, text and nested objects stay distinguishable.
BUSINESS_VARIANT = T.StructType([
    f if f.name != "attributes" else T.StructField("attributes", T.VariantType())
    for f in BUSINESS.fields
])

TIPS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("likes", T.LongType()),
    T.StructField("text", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("weight", T.DoubleType()),
])

PREDICTIONS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
])

STATS = T.StructType([
    T.StructField("total_reviews", T.DoubleType()),
    T.StructField("avg_user_stars", T.DoubleType()),
    T.StructField("max_user_reviews", T.DoubleType()),
    T.StructField("avg_business_stars", T.DoubleType()),
    T.StructField("max_business_reviews", T.DoubleType()),
])
