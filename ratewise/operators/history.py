"""Features the reference promises without code.

The definitions are ours. Aggregates over reviews take the training part only
(the caller passes it), so a label never feeds its own feature.

Scale notes: every grouping is a decomposable aggregate (count / sum / min /
max / max_by), so map-side partial aggregation keeps a hot user, business,
city or category from landing whole in one task. Where a second pass is
needed (centroids, affinities) the rows are pre-aggregated per key first and
the join runs on the small aggregated tables; AQE broadcasts those when they
measure small and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.functions import columns as X

TOKEN_SPLIT = "[^a-z]+"


def _rating_history(reviews: DataFrame, key: str) -> DataFrame:
    r = F.col("stars").cast("double")
    return reviews.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(r).alias("avg_rating"),
        F.coalesce(F.var_samp(r), F.lit(0.0)).alias("var_rating"),
        F.min(r).alias("min_rating"),
        F.max(r).alias("max_rating"),
    )


def user_rating_history(reviews: DataFrame) -> DataFrame:
    """K1: per user n, mean, sample variance (0 for one review), min, max."""
    return _rating_history(reviews, "user_id")


def business_rating_history(reviews: DataFrame) -> DataFrame:
    """K9: the same per business."""
    return _rating_history(reviews, "business_id")


def user_recency(reviews: DataFrame, as_of_date: str) -> DataFrame:
    """K2: n, active span in days (first to last review, inclusive), days since the
    last review, reviews per active day."""
    d = F.to_date(F.col("ts"))
    agg = reviews.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min(d).alias("first"),
                                         F.max(d).alias("last"))
    span = (F.datediff(F.col("last"), F.col("first")) + 1).cast("bigint")
    return agg.select(
        "user_id", "n", span.alias("active_days"),
        F.datediff(F.to_date(F.lit(as_of_date)), F.col("last")).cast("bigint").alias("days_since_last"),
        (F.col("n") / span).alias("reviews_per_day"))


def _located_reviews(reviews: DataFrame, business: DataFrame) -> DataFrame:
    """One row per (user, place) with its number of reviews w; grouped before the join."""
    per = reviews.groupBy("user_id", "business_id").agg(F.count(F.lit(1)).alias("w"))
    return per.join(business.select("business_id", "city", "latitude", "longitude"), "business_id", "inner")


def _centroids(located: DataFrame) -> DataFrame:
    return located.groupBy("user_id").agg(
        (F.sum(F.col("w") * F.col("latitude")) / F.sum("w")).alias("c_lat"),
        (F.sum(F.col("w") * F.col("longitude")) / F.sum("w")).alias("c_lon"))


def user_geo_mobility(reviews: DataFrame, business: DataFrame) -> DataFrame:
    """K3: distinct cities, most reviewed city (ties: smaller name), mean km to the
    user's review centroid.

    The places of a user meet their centroid in a plain join on the user, so AQE can
    split a user with very many places.
    """
    loc = _located_reviews(reviews, business)
    per_city = loc.groupBy("user_id", "city").agg(F.sum("w").alias("n"))
    cities = per_city.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("cities"),
        # max count first, then the smallest city name
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("city").alias("city"))).alias("top"))
    dist = (loc.join(_centroids(loc), "user_id", "inner")
            .groupBy("user_id")
            .agg((F.sum(F.col("w") * X.haversine_km("latitude", "longitude", "c_lat", "c_lon"))
                  / F.sum("w")).alias("avg_km")))
    return cities.join(dist, "user_id", "inner").select(
        "user_id", F.col("cities").cast("bigint").alias("cities"), F.col("top.city").alias("top_city"),
        X.round_half_up(F.col("avg_km"), 4).alias("avg_km"))


def category_list(categories="categories"):
    """Trimmed, distinct, non-empty category names of a comma list."""
    c = F.col(categories) if isinstance(categories, str) else categories
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda p: F.btrim(p, F.lit(X.WHITESPACE)))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def category_vocabulary(business: DataFrame) -> DataFrame:
    """K4, fitted: category, slot (0-based, ordered by two md5 digits, then name).

    Numbered in two levels (counts of the 256 leading digits, then within one of them),
    so that a large vocabulary is not sorted in one task.
    """
    cats = (business.select(F.explode(category_list()).alias("category")).distinct()
            .withColumn("_b", F.substring(F.md5("category"), 1, 2)))
    counts = cats.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))  # 256 rows
    offsets = counts.select("_b", F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = cats.withColumn("_k", F.row_number().over(Window.partitionBy("_b").orderBy("category")))
    return ranked.join(offsets, "_b").select("category", (F.col("_before") + F.col("_k") - 1).alias("slot"))


def category_onehot(business: DataFrame) -> DataFrame:
    """K4: business_id, category, slot: the slots that are 1 in the one-hot vector of each
    business over the whole fitted vocabulary (a business without categories has slot null)."""
    listed = business.select("business_id", F.explode_outer(category_list()).alias("category"))
    return listed.join(category_vocabulary(business), "category", "left").select("business_id", "category", "slot")


def business_attributes(business: DataFrame) -> DataFrame:
    """K6: price level, ambience, parking and wifi codes from the attributes."""
    code = X.attribute_coder(business)
    price = (F.try_variant_get("attributes", F.lit("$.RestaurantsPriceRange2"), "double")
             if isinstance(business.schema["attributes"].dataType, T.VariantType)
             else F.element_at(F.col("attributes"), F.lit("RestaurantsPriceRange2")).try_cast("double"))
    return business.select(
        "business_id", F.coalesce(price, F.lit(0.0)).alias("price"), code("Ambience").alias("ambience"),
        code("Parking").alias("parking"), code("WiFi").alias("wifi"))


def _span_hours(v):
    """'H:M-H:M' -> hours open; a closing time at or before the opening time adds 24."""
    part = lambda arr, i: F.try_element_at(arr, F.lit(i))
    ends = F.split(v, "-")
    to_h = lambda t: (part(F.split(t, ":"), 1).try_cast("double")
                      + F.coalesce(part(F.split(t, ":"), 2).try_cast("double"), F.lit(0.0)) / 60.0)
    start, end = to_h(part(ends, 1)), to_h(part(ends, 2))
    return F.when(end <= start, end + 24.0 - start).otherwise(end - start)


def operational_features(business: DataFrame) -> DataFrame:
    """K7: open days, weekly hours (past-midnight spans add 24), delivery flag."""
    days = F.map_values(F.coalesce(F.col("hours"), F.create_map().cast("map<string,string>")))
    weekly = F.aggregate(days, F.lit(0.0), lambda acc, v: acc + F.coalesce(_span_hours(v), F.lit(0.0)))
    return business.select(
        "business_id", F.size(days).cast("bigint").alias("open_days"), weekly.alias("weekly_hours"),
        X.attribute_coder(business)("RestaurantsDelivery").alias("delivers"))


def neighborhood_stats(business: DataFrame) -> DataFrame:
    """K8: businesses per city, city mean stars, own stars minus the city mean.

    A grouped aggregate joined back on city (not a window: a city holding a
    third of all businesses would otherwise be one task's whole input).
    """
    b = business.select("business_id", "city", F.col("stars").cast("double").alias("stars"))
    city = (b.groupBy("city").agg(F.count(F.lit(1)).alias("city_count"),
                                  F.avg("stars").alias("city_avg_stars"))
            .withColumnRenamed("city", "c_city"))
    return b.join(city, F.col("city").eqNullSafe(F.col("c_city")), "inner").select(
        "business_id", "city", "city_count", "city_avg_stars",
        (F.col("stars") - F.col("city_avg_stars")).alias("diff"))


def category_affinity(reviews: DataFrame, business: DataFrame, parts: int | None = None) -> DataFrame:
    """Per (user, category): reviews, mean rating, mean minus the user's mean.

    One pass over the reviews: every business also has a null category, whose row of a
    user is the user's total. The window sees one row per category of a user.

    ``parts``: tasks that the reviews are dealt to, by user and place, before they are first
    added up. Few reviews of one user meet there, so a task's table of sums is nearly as long
    as its reviews, and a scan or a join would give it as many as fit into a file or a shuffle block.
    """
    cats = business.select("business_id", category_list().alias("cats"))
    total = F.array(F.lit(None).cast("string"))
    listed = (reviews.select("user_id", "business_id", F.col("stars").cast("double").alias("s")).join(cats, "business_id", "left"))
    if parts and parts > 1:
        listed = listed.repartition(parts, "user_id", "business_id")
    uc = (listed.select("user_id", "s", F.explode(F.concat(F.coalesce("cats", F.array().cast("array<string>")), total)).alias("category"))
          .groupBy("user_id", "category").agg(F.count(F.lit(1)).alias("n"), (F.sum("s") / F.count(F.lit(1))).alias("avg_rating")))
    user_avg = F.max(F.when(F.col("category").isNull(), F.col("avg_rating"))).over(Window.partitionBy("user_id"))
    return (uc.withColumn("user_avg", user_avg).filter(F.col("category").isNotNull())
            .select("user_id", "category", "n", "avg_rating", (F.col("avg_rating") - F.col("user_avg")).alias("affinity")))


def user_price_means(reviews: DataFrame, business: DataFrame) -> DataFrame:
    per = reviews.groupBy("user_id", "business_id").agg(F.count(F.lit(1)).alias("w"))
    b = business.select("business_id", F.col("price").cast("double").alias("price"))
    priced = per.join(b, "business_id", "inner").filter(F.col("price").isNotNull())
    return priced.groupBy("user_id").agg((F.sum(F.col("w") * F.col("price")) / F.sum("w")).alias("user_price"))


def price_alignment(pairs: DataFrame, reviews: DataFrame, business: DataFrame) -> DataFrame:
    """|business price - mean price of the user's reviewed businesses|."""
    b = business.select("business_id", F.col("price").cast("double").alias("price"))
    return (pairs.select("user_id", "business_id").join(b, "business_id", "inner")
            .join(user_price_means(reviews, business), "user_id", "inner")
            .select("user_id", "business_id", F.abs(F.col("price") - F.col("user_price")).alias("price_gap")))


def centroid_distance(pairs: DataFrame, reviews: DataFrame, business: DataFrame) -> DataFrame:
    """Km from the business to the centroid of the user's reviewed businesses."""
    cent = _centroids(_located_reviews(reviews, business))
    b = business.select("business_id", "latitude", "longitude")
    return (pairs.select("user_id", "business_id").join(b, "business_id", "inner")
            .join(cent, "user_id", "inner")
            .select("user_id", "business_id",
                    X.round_half_up(X.haversine_km("latitude", "longitude", "c_lat", "c_lon"), 4).alias("km")))


# First hour of each part of the day.
DAY_PARTS = (("night", 0), ("morning", 6), ("afternoon", 12), ("evening", 18))


def temporal_patterns(reviews: DataFrame) -> DataFrame:
    """Reviews per weekday (dow_1 = Sunday .. dow_7 = Saturday), weekend share and
    reviews per six-hour part of the day (time of day of ``ts``)."""
    dow, hour = F.dayofweek(F.col("ts")), F.hour(F.col("ts"))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(dow == d).alias(f"dow_{d}") for d in range(1, 8)]
    aggs += [F.count_if((hour >= h) & (hour < h + 6)).alias(f"n_{part}") for part, h in DAY_PARTS]
    agg = reviews.groupBy("user_id").agg(*aggs)
    return agg.select("user_id", "n",
                      ((F.col("dow_1") + F.col("dow_7")) / F.col("n")).alias("weekend_share"),
                      *[F.col(f"dow_{d}") for d in range(1, 8)], *[F.col(f"n_{part}") for part, _ in DAY_PARTS])


def friend_edges(users: DataFrame) -> DataFrame:
    """(user_id, friend_id) from the comma list, trimmed, distinct, without self."""
    lst = category_list("friends")
    return (users.select("user_id", F.explode(lst).alias("friend_id"))
            .filter(F.col("friend_id") != F.col("user_id")))


def friend_ratings(pairs: DataFrame, users: DataFrame, reviews: DataFrame) -> DataFrame:
    """For each distinct pair to be scored: number of the user's friends' reviews of the
    business and their mean (null without any), and the friends' mean over all businesses.

    Only the given pairs meet the friend edges, so the work follows pairs x friends, not
    everything that friends ever reviewed. Reviews are reduced to sums before each join.
    """
    stars = F.col("stars").cast("double")
    per = (reviews.groupBy(F.col("user_id").alias("friend_id"), "business_id")
           .agg(F.count(F.lit(1)).alias("c"), F.sum(stars).alias("s")))
    totals = reviews.groupBy(F.col("user_id").alias("friend_id")).agg(F.count(F.lit(1)).alias("tc"), F.sum(stars).alias("ts"))
    edges = friend_edges(users)
    wanted = pairs.select("user_id", "business_id").distinct()
    by_pair = (wanted.join(edges, "user_id").join(per, ["friend_id", "business_id"])
               .groupBy("user_id", "business_id").agg(F.sum("c").alias("n"), (F.sum("s") / F.sum("c")).alias("friend_avg")))
    by_user = (edges.join(totals, "friend_id").groupBy("user_id")
               .agg((F.sum("ts") / F.sum("tc")).alias("friends_overall_avg")))
    return (wanted.join(by_pair, ["user_id", "business_id"], "left").join(by_user, "user_id", "left")
            .select("user_id", "business_id", F.coalesce("n", F.lit(0)).alias("n"), "friend_avg", "friends_overall_avg"))


def tip_sentiment(tips: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Per business: tokens in its tips, summed lexicon weight, weight per token.

    One pass: each tip's whole text is split into words and exploded (a split
    always yields at least one element, so every business keeps a row; the
    empty strings at the text's ends count as no token), left-joined with the
    lexicon on the word and summed per business with a partial aggregate. The
    planner broadcasts a lexicon whose size it knows to be small (no shuffle of
    the words); above that it is a shuffle join whose hot words AQE splits.
    """
    words = tips.select("business_id", F.explode(
        F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), TOKEN_SPLIT)).alias("word"))
    lex = lexicon.select("word", F.col("weight").cast("double").alias("weight"))
    agg = (words.join(lex, "word", "left").groupBy("business_id")
           .agg(F.count_if(F.col("word") != "").alias("tokens"),
                F.coalesce(F.sum("weight"), F.lit(0.0)).alias("score_sum")))
    return agg.select("business_id", "tokens", "score_sum",
                      X.safe_ratio(F.col("score_sum"), F.col("tokens")).alias("score_avg"))
