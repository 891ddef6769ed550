"""Domain tables derived from the driver's parquet tables (FIXTURES.md section 2).

The reference reads reviews / users / businesses / tips files that are not
shipped. The registered queries derive them from the driver tables with the
formulas below, so every query's work grows with the input tables. The same
formulas are written in SQL for the DuckDB oracle (``ratewise.plans.oracle``).

Everything is a lazy projection / aggregate / join over ``spark.read.parquet``;
column pruning and filters reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The weekday keys of the opening-hours map.
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


_READS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; the reader is built once per session and path, so a query
    that uses a table in several places infers its schema once."""
    key = (id(spark), f"{sf_dir}/{name}.parquet")
    hit = _READS.get(key)
    if hit is None or hit[0] is not spark:  # the session is kept, so its id is never reused
        hit = _READS[key] = (spark, spark.read.parquet(key[1]))
    return hit[1]


def n_rows(spark: SparkSession, sf_dir: str, name: str):
    """Row count of a driver table as a scalar subquery."""
    return table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n")).scalar()


def pair_key(orderkey, linenumber, partkey):
    return F.concat_ws("-", orderkey.cast("string"), linenumber.cast("string"),
                       partkey.cast("string"))


def rating(user, business, noise):
    """1..5 in whole stars: the user's habit, how users of a kind take to places of a kind
    (both shown by the features), plus noise. All in tenths of a star, as integers."""
    habit = (user * 7) % 41 * 6
    elite = (user % 5).isin(2, 4)
    tenths = (F.lit(13) + (habit - habit % 10) / 10
              + F.when((business % 6).isin(3, 4), F.when(elite, 9).otherwise(-6)).otherwise(0)
              + F.when(business % 4 != 0, F.when((user * 7) % 41 >= 20, 8).otherwise(1)).otherwise(0)
              + noise % 10 - 4)
    return F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.floor(tenths / 10).cast("double")))


def reviews(spark: SparkSession, sf_dir: str, only_user: int | None = None, dealt: bool = False) -> DataFrame:
    """lineitem join orders: user_id, business_id, stars, ts, pair_key; ``only_user`` one customer key, filtered in the scan.

    ``dealt``: joined by a shuffle of the order keys at any size, so that the rows lie evenly in partitions; the five short columns
    of lineitem are shuffled for it, not the longer rows of the result."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    if only_user is not None:
        od = od.filter(F.col("o_custkey") == only_user)
    j = li.join(od.hint("merge") if dealt else od, li.l_orderkey == od.o_orderkey, "inner")
    part = F.col("l_partkey").cast("string")
    minutes = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101) % 1440
    return j.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("x"), part)).otherwise(part)
        .alias("business_id"),
        rating(F.col("o_custkey"), F.col("l_partkey"), F.col("l_quantity").cast("bigint")).alias("stars"),
        (F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"))).alias("ts"),
        pair_key(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")).alias("pair_key"),
    )


def users(spark: SparkSession, sf_dir: str, since_with_time: bool = False, only: int | None = None) -> DataFrame:
    """customer left join order counts left join event counts; ``only`` one customer key,
    filtered in every scan."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    if only is not None:
        c, orders, events = (c.filter(F.col("c_custkey") == only), orders.filter(F.col("o_custkey") == only),
                             events.filter(F.col("user_id") == only))
    oc = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    ev = (events.groupBy("user_id")
          .agg(F.count_if(F.col("event_type") == "click").alias("n_click"),
               F.count_if(F.col("event_type") == "view").alias("n_view"),
               F.count_if(F.col("event_type") == "purchase").alias("n_purchase"),
               F.count_if(F.col("event_type") == "signup").alias("n_signup")))
    j = (c.join(oc, c.c_custkey == oc.o_custkey, "left")
         .join(ev, c.c_custkey == ev.user_id, "left"))
    k = F.col("c_custkey")
    elite = (F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit("2019"))
             .when(k % 5 == 2, F.lit("2018,2019,2020")).when(k % 5 == 3, F.lit(None))
             .otherwise(F.lit("2020,20,20")))
    since_date = F.concat((F.lit(2005) + k % 16).cast("string"), F.lit("-03-15"))
    if since_with_time:
        since_date = F.when(k % 11 == 2, F.concat(since_date, F.lit(" 10:00:00"))).otherwise(since_date)
    since = (F.when(k % 11 == 0, F.lit(None).cast("string"))
             .when(k % 11 == 1, F.lit("n/a")).otherwise(since_date))
    j = j.withColumn("_n", n_rows(spark, sf_dir, "customer"))
    friends = F.when(k % 7 == 0, F.lit("")).otherwise(
        F.concat(((k + 1) % F.col("_n")).cast("string"), F.lit(", "), ((k * 3) % F.col("_n")).cast("string")))
    return j.select(
        k.cast("string").alias("user_id"),
        F.col("c_name").alias("name"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("review_count"),
        (F.lit(1.0) + ((k * 7) % 41) / F.lit(10.0)).alias("average_stars"),
        F.coalesce(F.col("n_click"), F.lit(0)).cast("bigint").alias("useful"),
        F.coalesce(F.col("n_view"), F.lit(0)).cast("bigint").alias("funny"),
        F.coalesce(F.col("n_purchase"), F.lit(0)).cast("bigint").alias("cool"),
        F.coalesce(F.col("n_signup"), F.lit(0)).cast("bigint").alias("fans"),
        elite.alias("elite"),
        since.alias("yelping_since"),
        friends.alias("friends"),
    )


def attributes_json(p, size, price):
    """JSON object of a business's attributes: booleans, text, numbers and nested objects; a
    missing attribute is left out."""
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    pick = lambda cond, yes, no: F.when(cond, F.lit(yes)).otherwise(F.lit(no))
    values = {
        "BusinessAcceptsCreditCards": pick(p % 5 == 0, "false", "true"),
        "RestaurantsPriceRange2": F.when(p % 3 != 0, price.cast("string")).otherwise(text(price.cast("string"))),
        "WiFi": F.when(p % 3 == 1, '"free"').when(p % 3 == 2, '"no"').otherwise('"Paid"'),
        "OutdoorSeating": F.when(p % 4 == 0, "true").when(p % 4 == 1, '"True"').when(p % 4 == 2, "false"),
        "BikeParking": pick(p % 3 == 0, "true", "false"),
        "HasTV": pick(p % 2 == 0, "true", "false"),
        "RestaurantsDelivery": pick(p % 4 == 1, '"yes"', '"no"'),
        "RestaurantsTakeOut": F.when(p % 7 < 3, "true").when(p % 7 == 3, '"FREE"').otherwise("false"),
        "GoodForKids": F.when(p % 2 == 1, "true").when(p % 6 != 0, "false"),
        "Alcohol": F.when(p % 5 == 1, '"full_bar"').when(p % 5 == 2, "true").otherwise('"none"'),
        "NoiseLevel": F.concat((p % 8).cast("string"), F.lit(".5")),
        "RestaurantsAttire": pick(p % 9 == 0, '" Yes "', '"casual"'),
        "Ambience": pick(p % 2 == 1, '{"romantic": false, "casual": true}', '{"romantic": false, "casual": "true"}'),
        "Parking": pick(size % 5 == 2, '{"garage": true, "street": false}', '{"garage": false, "street": false}'),
        "Dogs_Allowed": pick(p % 10 == 3, "true", "false"),
    }
    members = [F.concat(F.lit(f'"{name}": '), value) for name, value in values.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def business(spark: SparkSession, sf_dir: str, only: int | None = None) -> DataFrame:
    """part left join lineitem counts; ``only`` one part key, filtered in both scans."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    lines = table(spark, sf_dir, "lineitem")
    if only is not None:
        p, lines = p.filter(F.col("p_partkey") == only), lines.filter(F.col("l_partkey") == only)
    lc = lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_lines"))
    j = p.join(lc, p.p_partkey == lc.l_partkey, "left")
    k = F.col("p_partkey")
    size = F.col("p_size")
    price = (F.lit(1) + size % 4).cast("bigint")
    categories = (F.when(k % 6 == 0, F.lit(None).cast("string")).when(k % 6 == 1, F.lit(""))
                  .when(k % 6 == 2, F.concat(F.lit("Restaurants, "), F.col("p_type")))
                  .when(k % 6 == 3, F.lit("Food, Bars"))
                  .when(k % 6 == 4, F.concat(F.lit(" restaurant ,"), F.col("p_name")))
                  .otherwise(F.concat(F.col("p_type"), F.lit(", Fast Food"))))
    span = F.concat((F.lit(8) + k % 4).cast("string"), F.lit(":30-"),
                    ((F.lit(17) + k % 9) % 24).cast("string"), F.lit(":0"))
    hours = F.create_map(*[x for d in DAYS for x in (F.lit(d), span)])
    return j.select(
        k.cast("string").alias("business_id"),
        F.col("p_name").alias("name"),
        (F.lit(1.0) + (size % 9) / F.lit(2.0)).alias("stars"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint").alias("review_count"),
        F.when(k % 4 == 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("is_open"),
        categories.alias("categories"),
        F.col("p_brand").alias("city"),
        F.substring(F.col("p_type"), 1, 2).alias("state"),
        (F.lit(33.0) + (k % 50) / F.lit(10.0)).alias("latitude"),
        (F.lit(-112.0) + (k % 70) / F.lit(10.0)).alias("longitude"),
        F.parse_json(attributes_json(k, size, price)).alias("attributes"),
        hours.alias("hours"),
        price.alias("price"),
    )


def tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as tips, spread over as many users and businesses as there are."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    d = d.withColumn("_u", n_rows(spark, sf_dir, "customer")).withColumn("_b", n_rows(spark, sf_dir, "part"))
    k = F.col("doc_id")
    return d.select(
        ((k * 13) % F.col("_u")).cast("string").alias("user_id"),
        ((k * 7) % F.col("_b")).cast("string").alias("business_id"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(F.col("n_chars") % 7).cast("bigint").alias("likes"),
        F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("text"),
    )


# The sentiment lexicon of the fixture (word, weight).
LEXICON_ROWS = [("the", 1.0), ("on", -1.0), ("of", 2.0), ("le", -2.0)]


def lexicon(spark: SparkSession) -> DataFrame:
    """The rows as SQL VALUES, whose size the planner knows."""
    rows = ", ".join(f"('{w}', {x}D)" for w, x in LEXICON_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(word, weight)")


def split_flag(key_col):
    """Holdout flag from the md5 of the pair key (~10.2%), stable under repartitioning."""
    return F.substring(F.md5(key_col), 1, 2) < F.lit("1a")


def train_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reviews(spark, sf_dir)
    return r.filter(~split_flag(F.col("pair_key")))


def test_pairs(spark: SparkSession, sf_dir: str, only_user: int | None = None) -> DataFrame:
    """Holdout pairs without the label."""
    r = reviews(spark, sf_dir, only_user)
    return r.filter(split_flag(F.col("pair_key"))).select("user_id", "business_id", "pair_key")
