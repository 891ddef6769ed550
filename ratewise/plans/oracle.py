"""DuckDB oracle SQL for the registered queries.

Only the driver's raw tables exist as views in the oracle, so every statement
starts with the fixture mapping of FIXTURES.md as common table expressions.
Numbers follow the engine rules of SURVEY 5: doubles written as ``1.0e0``,
counts cast to BIGINT, computed doubles rounded to 6 decimals on both sides.
"""

from __future__ import annotations

AS_OF_YEAR = 2024
AS_OF_DATE = "2024-12-31"

REVIEWS = """
reviews AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id,
         CASE WHEN l.l_linenumber = 7 THEN 'x' || CAST(l.l_partkey AS VARCHAR)
              ELSE CAST(l.l_partkey AS VARCHAR) END AS business_id,
         least(5.0e0, greatest(1.0e0, floor((13 + ((o.o_custkey * 7) % 41 * 6) // 10
           + CASE WHEN l.l_partkey % 6 IN (3, 4) THEN CASE WHEN o.o_custkey % 5 IN (2, 4) THEN 9 ELSE -6 END ELSE 0 END
           + CASE WHEN l.l_partkey % 4 <> 0 THEN CASE WHEN (o.o_custkey * 7) % 41 >= 20 THEN 8 ELSE 1 END ELSE 0 END
           + CAST(l.l_quantity AS BIGINT) % 10 - 4) / 10.0e0))) AS stars,
         CAST(l.l_shipdate AS TIMESTAMP) + to_minutes(CAST((l.l_orderkey * 37 + l.l_linenumber * 101) % 1440 AS BIGINT)) AS ts,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-'
           || CAST(l.l_partkey AS VARCHAR) AS pair_key,
         substr(md5(CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-'
           || CAST(l.l_partkey AS VARCHAR)), 1, 2) < '1a' AS is_holdout
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

USERS_TMPL = """
users AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS user_id, c.c_name AS name,
         CAST(coalesce(oc.n_orders, 0) AS BIGINT) AS review_count,
         1.0e0 + ((c.c_custkey * 7) % 41) / 1.0e1 AS average_stars,
         CAST(coalesce(ev.n_click, 0) AS BIGINT) AS useful,
         CAST(coalesce(ev.n_view, 0) AS BIGINT) AS funny,
         CAST(coalesce(ev.n_purchase, 0) AS BIGINT) AS cool,
         CAST(coalesce(ev.n_signup, 0) AS BIGINT) AS fans,
         CASE c.c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '2019' WHEN 2 THEN '2018,2019,2020'
              WHEN 3 THEN NULL ELSE '2020,20,20' END AS elite,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL WHEN c.c_custkey % 11 = 1 THEN 'n/a'
              ELSE CAST(2005 + c.c_custkey % 16 AS VARCHAR) || '-03-15'{time_part} END AS yelping_since,
         CASE WHEN c.c_custkey % 7 = 0 THEN ''
              ELSE CAST((c.c_custkey + 1) % (SELECT count(*) FROM customer) AS VARCHAR) || ', '
                   || CAST((c.c_custkey * 3) % (SELECT count(*) FROM customer) AS VARCHAR) END AS friends
  FROM customer c
  LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) oc
    ON c.c_custkey = oc.o_custkey
  LEFT JOIN (SELECT user_id,
                    count(*) FILTER (WHERE event_type = 'click') AS n_click,
                    count(*) FILTER (WHERE event_type = 'view') AS n_view,
                    count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
                    count(*) FILTER (WHERE event_type = 'signup') AS n_signup
             FROM events GROUP BY user_id) ev
    ON c.c_custkey = ev.user_id)"""

USERS = USERS_TMPL.format(time_part="")
USERS_WITH_TIME = USERS_TMPL.format(
    time_part=" || CASE WHEN c.c_custkey % 11 = 2 THEN ' 10:00:00' ELSE '' END")

# Attribute values are exposed as one column of JSON text each in the oracle (a_<key>,
# null when missing), which is what the variant lookups of the Spark side see.
BUSINESS = """
business AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS business_id, p.p_name AS name,
         1.0e0 + (p.p_size % 9) / 2.0e0 AS stars,
         CAST(coalesce(lc.n_lines, 0) AS BIGINT) AS review_count,
         CAST(CASE WHEN p.p_partkey % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS is_open,
         CASE p.p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Restaurants, ' || p.p_type
              WHEN 3 THEN 'Food, Bars' WHEN 4 THEN ' restaurant ,' || p.p_name
              ELSE p.p_type || ', Fast Food' END AS categories,
         p.p_brand AS city, substr(p.p_type, 1, 2) AS state,
         33.0e0 + (p.p_partkey % 50) / 1.0e1 AS latitude,
         -112.0e0 + (p.p_partkey % 70) / 1.0e1 AS longitude,
         CAST(1 + p.p_size % 4 AS BIGINT) AS price,
         CAST(8 + p.p_partkey % 4 AS VARCHAR) || ':30-' || CAST((17 + p.p_partkey % 9) % 24 AS VARCHAR)
           || ':0' AS day_hours,
         CASE WHEN p.p_partkey % 5 = 0 THEN 'false' ELSE 'true' END AS a_BusinessAcceptsCreditCards,
         CASE WHEN p.p_partkey % 3 <> 0 THEN CAST(1 + p.p_size % 4 AS VARCHAR)
              ELSE '"' || CAST(1 + p.p_size % 4 AS VARCHAR) || '"' END AS a_RestaurantsPriceRange2,
         CASE p.p_partkey % 3 WHEN 1 THEN '"free"' WHEN 2 THEN '"no"' ELSE '"Paid"' END AS a_WiFi,
         CASE p.p_partkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN '"True"' WHEN 2 THEN 'false' END AS a_OutdoorSeating,
         CASE WHEN p.p_partkey % 3 = 0 THEN 'true' ELSE 'false' END AS a_BikeParking,
         CASE WHEN p.p_partkey % 2 = 0 THEN 'true' ELSE 'false' END AS a_HasTV,
         CASE WHEN p.p_partkey % 4 = 1 THEN '"yes"' ELSE '"no"' END AS a_RestaurantsDelivery,
         CASE WHEN p.p_partkey % 7 < 3 THEN 'true' WHEN p.p_partkey % 7 = 3 THEN '"FREE"' ELSE 'false' END AS a_RestaurantsTakeOut,
         CASE WHEN p.p_partkey % 2 = 1 THEN 'true' WHEN p.p_partkey % 6 <> 0 THEN 'false' END AS a_GoodForKids,
         CASE p.p_partkey % 5 WHEN 1 THEN '"full_bar"' WHEN 2 THEN 'true' ELSE '"none"' END AS a_Alcohol,
         CAST(p.p_partkey % 8 AS VARCHAR) || '.5' AS a_NoiseLevel,
         CASE WHEN p.p_partkey % 9 = 0 THEN '" Yes "' ELSE '"casual"' END AS a_RestaurantsAttire,
         CASE WHEN p.p_partkey % 2 = 1 THEN '{"romantic": false, "casual": true}'
              ELSE '{"romantic": false, "casual": "true"}' END AS a_Ambience,
         CASE WHEN p.p_size % 5 = 2 THEN '{"garage": true, "street": false}'
              ELSE '{"garage": false, "street": false}' END AS a_Parking,
         CASE WHEN p.p_partkey % 10 = 3 THEN 'true' ELSE 'false' END AS a_Dogs_Allowed
  FROM part p
  LEFT JOIN (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY l_partkey) lc
    ON p.p_partkey = lc.l_partkey)"""

TIPS = """
tips AS (
  SELECT CAST((doc_id * 13) % (SELECT count(*) FROM customer) AS VARCHAR) AS user_id,
         CAST((doc_id * 7) % (SELECT count(*) FROM part) AS VARCHAR) AS business_id,
         CAST(CASE WHEN doc_id % 10 = 0 THEN NULL ELSE n_chars % 7 END AS BIGINT) AS likes,
         CASE WHEN doc_id % 9 = 0 THEN NULL ELSE text END AS text
  FROM documents)"""

LEXICON = """
lexicon AS (SELECT * FROM (VALUES ('the', 1.0e0), ('on', -1.0e0), ('of', 2.0e0), ('le', -2.0e0))
            AS t(word, weight))"""

TRAIN = """
train AS (SELECT * FROM reviews WHERE NOT is_holdout)"""

TEST_PAIRS = """
test_pairs AS (SELECT user_id, business_id, pair_key FROM reviews WHERE is_holdout)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


# Feature definitions shared by several statements.
UST = """
ust AS (SELECT coalesce(sum(CAST(coalesce(review_count, 0) AS DOUBLE)), 0.0e0) AS total_reviews,
               coalesce(avg(CAST(average_stars AS DOUBLE)), 0.0e0) AS avg_user_stars,
               coalesce(max(CAST(coalesce(review_count, 0) AS DOUBLE)), 0.0e0) AS max_user_reviews
        FROM users)"""

BST = """
bst AS (SELECT coalesce(avg(CAST(stars AS DOUBLE)), 0.0e0) AS avg_business_stars,
               coalesce(max(CAST(coalesce(review_count, 0) AS DOUBLE)), 0.0e0) AS max_business_reviews
        FROM business)"""

UF = """
uf0 AS (
  SELECT user_id,
         coalesce(CAST(average_stars AS DOUBLE), 0.0e0) AS s,
         coalesce(CAST(review_count AS DOUBLE), 0.0e0) AS rc,
         coalesce(CAST(useful AS DOUBLE), 0.0e0) AS useful,
         coalesce(CAST(funny AS DOUBLE), 0.0e0) AS funny,
         coalesce(CAST(cool AS DOUBLE), 0.0e0) AS cool,
         coalesce(CAST(fans AS DOUBLE), 0.0e0) AS fans,
         CAST(CASE WHEN elite IS NULL OR elite = '' THEN 0 ELSE len(string_split(elite, ',')) END AS DOUBLE) AS elite_n,
         CAST(coalesce({y} - TRY_CAST(substr(yelping_since, 1, 4) AS INTEGER), 1) AS DOUBLE) AS years
  FROM users),
uf AS (
  SELECT user_id,
         s AS u_average_stars, rc AS u_review_count, useful AS u_useful, funny AS u_funny,
         cool AS u_cool, fans AS u_fans, elite_n AS u_elite_years,
         coalesce(rc / nullif(ust.total_reviews, 0), 0.0e0) AS u_review_ratio,
         s - ust.avg_user_stars AS u_star_diff,
         coalesce((useful + funny + cool) / nullif(rc + 1, 0), 0.0e0) AS u_engagement_score,
         years AS u_years_active,
         coalesce(rc / nullif(ust.max_user_reviews, 0), 0.0e0) AS u_normalized_reviews,
         useful + funny + cool AS u_total_feedback,
         rc / greatest(1, years) AS u_reviews_per_year,
         coalesce(fans / nullif(rc + 1, 0), 0.0e0) AS u_fans_per_review,
         elite_n / greatest(1, years) AS u_elite_years_ratio,
         coalesce((useful + funny + cool) / nullif(rc + 1, 0), 0.0e0) AS u_feedback_per_review
  FROM uf0, ust)""".format(y=AS_OF_YEAR)

BF = """
bf AS (
  SELECT business_id,
         coalesce(CAST(stars AS DOUBLE), 0.0e0) AS b_stars,
         coalesce(CAST(review_count AS DOUBLE), 0.0e0) AS b_review_count,
         coalesce(CAST(is_open AS DOUBLE), 0.0e0) AS b_is_open,
         coalesce(CAST(stars AS DOUBLE), 0.0e0) - bst.avg_business_stars AS b_star_diff,
         coalesce(CAST(stars AS DOUBLE), 0.0e0) / 5.0e0 AS b_normalized_stars,
         coalesce(coalesce(CAST(review_count AS DOUBLE), 0.0e0) / nullif(bst.max_business_reviews, 0), 0.0e0)
           AS b_normalized_reviews,
         coalesce(CAST(review_count AS DOUBLE), 0.0e0) / {dens}e0 AS b_review_density,
         CASE WHEN len(list_filter(string_split(coalesce(categories, ''), ','),
                   lambda x: lower(trim(x, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)))
                             IN ('restaurant', 'food'))) > 0 THEN 1.0e0 ELSE 0.0e0 END AS b_is_restaurant,
         CAST(CASE WHEN categories IS NULL OR categories = '' THEN 0
                   ELSE len(string_split(categories, ',')) END AS DOUBLE) AS b_category_count
  FROM business, bst)""".format(dens=float(max(1, AS_OF_YEAR - 2004)))

UTS = """
uts AS (SELECT user_id, count(*) AS tip_count, CAST(coalesce(sum(coalesce(likes, 0)), 0) AS BIGINT) AS tip_likes,
               CAST(sum(length(coalesce(text, ''))) AS DOUBLE) / count(*) AS tip_avg_length
        FROM tips GROUP BY user_id)"""

BTS = """
bts AS (SELECT business_id, count(*) AS tip_count, CAST(coalesce(sum(coalesce(likes, 0)), 0) AS BIGINT) AS tip_likes,
               CAST(sum(length(coalesce(text, ''))) AS DOUBLE) / count(*) AS tip_avg_length
        FROM tips GROUP BY business_id)"""

USER_SLOTS = ["u_average_stars", "u_review_count", "u_useful", "u_funny", "u_cool", "u_fans",
              "u_elite_years", "u_review_ratio", "u_star_diff", "u_engagement_score", "u_years_active",
              "u_normalized_reviews", "u_total_feedback", "u_reviews_per_year", "u_fans_per_review",
              "u_elite_years_ratio", "u_feedback_per_review"]
BUSINESS_SLOTS = ["b_stars", "b_review_count", "b_is_open", "b_star_diff", "b_normalized_stars",
                  "b_normalized_reviews", "b_review_density", "b_is_restaurant", "b_category_count"]


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


def pair_feature_select(label: str | None, rnd: bool = True) -> str:
    """SELECT list + FROM for the 36-slot pair features over a CTE named ``p``."""
    z = lambda e: f"coalesce(CAST({e} AS DOUBLE), 0.0e0)"
    r6 = globals()["r6"] if rnd else (lambda e, a: f"{e} AS {a}")
    cols = ["p.user_id", "p.business_id"]
    if label:
        cols.append(f"{label} AS rating")
    cols += [r6(z(f"uf.{c}"), c) for c in USER_SLOTS]
    cols += [r6(z(f"bf.{c}"), c) for c in BUSINESS_SLOTS]
    cols += [r6(z("ut.tip_count"), "ut_count"), r6(z("ut.tip_likes"), "ut_likes"),
             r6(z("ut.tip_avg_length"), "ut_avg_length"), r6(z("bt.tip_count"), "bt_count"),
             r6(z("bt.tip_likes"), "bt_likes"), r6(z("bt.tip_avg_length"), "bt_avg_length")]
    cols += [r6(f"{z('uf.u_average_stars')} * {z('bf.b_stars')}", "x_stars"),
             r6(f"{z('uf.u_review_count')} * {z('bf.b_review_count')}", "x_reviews"),
             r6(f"{z('uf.u_engagement_score')} * {z('bf.b_review_density')}", "x_engagement"),
             r6(f"{z('uf.u_star_diff')} * {z('bf.b_star_diff')}", "x_star_diff")]
    return ("SELECT " + ",\n       ".join(cols) + """
FROM p
LEFT JOIN uf ON p.user_id = uf.user_id
LEFT JOIN bf ON p.business_id = bf.business_id
LEFT JOIN uts ut ON p.user_id = ut.user_id
LEFT JOIN bts bt ON p.business_id = bt.business_id""")


FEATURE_CTES = (USERS, BUSINESS, TIPS, UST, BST, UF, BF, UTS, BTS)


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["user_features"] = with_ctes(USERS, UST, UF) + "\nSELECT user_id, " + ", ".join(
        r6(c, c) for c in USER_SLOTS) + " FROM uf"
    q["business_features"] = with_ctes(BUSINESS, BST, BF) + "\nSELECT business_id, " + ", ".join(
        r6(c, c) for c in BUSINESS_SLOTS) + " FROM bf"
    q["user_tip_stats"] = with_ctes(TIPS, UTS) + \
        "\nSELECT user_id, tip_count, tip_likes, round(tip_avg_length, 6) AS tip_avg_length FROM uts"
    q["business_tip_stats"] = with_ctes(TIPS, BTS) + \
        "\nSELECT business_id, tip_count, tip_likes, round(tip_avg_length, 6) AS tip_avg_length FROM bts"
    q["user_global_stats"] = with_ctes(USERS, UST) + """
SELECT round(total_reviews, 6) AS total_reviews, round(avg_user_stars, 6) AS avg_user_stars,
       round(max_user_reviews, 6) AS max_user_reviews FROM ust"""
    q["business_global_stats"] = with_ctes(BUSINESS, BST) + """
SELECT round(avg_business_stars, 6) AS avg_business_stars,
       round(max_business_reviews, 6) AS max_business_reviews FROM bst"""
    q["global_stats"] = with_ctes(USERS, BUSINESS, UST, BST) + """
SELECT round(total_reviews, 6) AS total_reviews, round(avg_user_stars, 6) AS avg_user_stars,
       round(max_user_reviews, 6) AS max_user_reviews, round(avg_business_stars, 6) AS avg_business_stars,
       round(max_business_reviews, 6) AS max_business_reviews FROM ust, bst"""
    q["pair_features"] = with_ctes(REVIEWS, *FEATURE_CTES,
                                   "p AS (SELECT user_id, business_id, stars FROM reviews)") + \
        "\n" + pair_feature_select("p.stars")
    q["pair_features_unlabelled"] = with_ctes(REVIEWS, *FEATURE_CTES, TEST_PAIRS,
                                              "p AS (SELECT user_id, business_id FROM test_pairs)") + \
        "\n" + pair_feature_select(None)
    z = lambda e: f"coalesce({e}, 0.0e0)"
    q["interaction_features"] = with_ctes(REVIEWS, USERS, BUSINESS, UST, BST, UF, BF, TEST_PAIRS) + f"""
SELECT p.user_id, p.business_id,
       {r6(z('uf.u_average_stars') + ' * ' + z('bf.b_stars'), 'x_stars')},
       {r6(z('uf.u_review_count') + ' * ' + z('bf.b_review_count'), 'x_reviews')},
       {r6(z('uf.u_engagement_score') + ' * ' + z('bf.b_review_density'), 'x_engagement')},
       {r6(z('uf.u_star_diff') + ' * ' + z('bf.b_star_diff'), 'x_star_diff')}
FROM test_pairs p LEFT JOIN uf ON p.user_id = uf.user_id LEFT JOIN bf ON p.business_id = bf.business_id"""
    return q


FEATURES = USER_SLOTS + BUSINESS_SLOTS + ["ut_count", "ut_likes", "ut_avg_length", "bt_count",
                                         "bt_likes", "bt_avg_length", "x_stars", "x_reviews",
                                         "x_engagement", "x_star_diff"]

LISTED = ("categories IS NOT NULL AND categories <> '' AND "
          "(contains(categories, 'Restaurant') OR contains(categories, 'Food'))")

USER_CARD = """user_id, coalesce(name, 'Anonymous User') AS name,
       CAST(coalesce(review_count, 0) AS BIGINT) AS review_count,
       round(coalesce(CAST(average_stars AS DOUBLE), 0.0e0), 6) AS average_stars,
       CAST(coalesce(useful, 0) AS BIGINT) AS useful, CAST(coalesce(funny, 0) AS BIGINT) AS funny,
       CAST(coalesce(cool, 0) AS BIGINT) AS cool, CAST(coalesce(fans, 0) AS BIGINT) AS fans,
       coalesce(elite, '') AS elite, coalesce(yelping_since, '2020-01-01') AS yelping_since"""

BUSINESS_CARD = """business_id, coalesce(name, 'Unknown Restaurant') AS name,
       round(coalesce(CAST(stars AS DOUBLE), 0.0e0), 6) AS stars,
       CAST(coalesce(review_count, 0) AS BIGINT) AS review_count,
       coalesce(city, 'Unknown') AS city, coalesce(state, 'XX') AS state,
       coalesce(categories, 'Restaurant') AS categories, CAST(coalesce(is_open, 0) AS BIGINT) AS is_open"""

CANDIDATES = f"""
cand AS (SELECT {BUSINESS_CARD} FROM business WHERE {LISTED}
         ORDER BY review_count DESC, business_id LIMIT 20)"""

BLEND = "least(5.0e0, greatest(1.0e0, coalesce({u}, 3.5e0) * 0.4e0 + coalesce({b}, 3.5e0) * 0.6e0))"

STRICT_TEST = """
sp AS (SELECT p.user_id, p.business_id, CAST(u.average_stars AS DOUBLE) AS average_stars,
              CAST(b.stars AS DOUBLE) AS stars
       FROM test_pairs p JOIN users u ON p.user_id = u.user_id
       JOIN business b ON p.business_id = b.business_id)"""

BLEND_TEST = STRICT_TEST + """,
bl AS (SELECT user_id, business_id, """ + BLEND.format(u="average_stars", b="stars") + """ AS x FROM sp)"""

def scored_reviews(holdout_only: bool) -> str:
    where = "WHERE r.is_holdout" if holdout_only else ""
    return f"""
sc AS (SELECT r.pair_key, r.stars AS rating,
              {BLEND.format(u="CAST(u.average_stars AS DOUBLE)", b="CAST(b.stars AS DOUBLE)")} AS prediction
       FROM reviews r JOIN users u ON r.user_id = u.user_id
       JOIN business b ON r.business_id = b.business_id {where})"""


SERVING_ATTRIBUTES = ["BusinessAcceptsCreditCards", "RestaurantsPriceRange2", "WiFi", "OutdoorSeating",
                      "BikeParking", "HasTV", "RestaurantsDelivery", "RestaurantsTakeOut", "GoodForKids",
                      "Alcohol", "NoiseLevel", "RestaurantsAttire", "Ambience", "Parking"]
ATTR_KEYS = SERVING_ATTRIBUTES + ["Dogs_Allowed"]


def attr_code(v: str) -> str:
    """Code of a JSON value given as text: boolean, string, object, number or missing."""
    return (f"CASE WHEN {v} IS NULL OR {v} = 'false' THEN 0.0e0 WHEN {v} = 'true' THEN 1.0e0 "
            f"WHEN starts_with({v}, '\"') THEN CASE WHEN lower(trim(trim({v}, '\"'))) IN ('true', 'yes', 'free') "
            f"THEN 1.0e0 ELSE 0.0e0 END "
            f"WHEN starts_with({v}, '{{') THEN CASE WHEN contains({v}, ': true') THEN 1.0e0 ELSE 0.0e0 END "
            f"ELSE TRY_CAST({v} AS DOUBLE) END")


def _queries_2() -> dict[str, str]:
    q: dict[str, str] = {}
    q["restaurant_subset"] = with_ctes(REVIEWS, BUSINESS) + f"""
SELECT user_id, business_id, stars, pair_key FROM reviews
WHERE business_id IN (SELECT business_id FROM business WHERE {LISTED})"""
    q["user_lookup"] = with_ctes(USERS) + """
SELECT user_id, name, review_count, round(average_stars, 6) AS average_stars, useful, funny, cool, fans,
       elite, yelping_since, friends FROM users WHERE user_id = '42'"""
    q["business_lookup"] = with_ctes(BUSINESS) + """
SELECT business_id, name, round(stars, 6) AS stars, review_count, is_open, categories, city, state,
       round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, price
FROM business WHERE business_id = '42'"""
    q["tips_for_pair"] = with_ctes(TIPS) + """
SELECT 'user' AS side, user_id, business_id, likes, text FROM tips WHERE user_id = '7'
UNION ALL
SELECT 'business' AS side, user_id, business_id, likes, text FROM tips WHERE business_id = '14'"""
    q["user_cards"] = with_ctes(USERS) + f"\nSELECT {USER_CARD} FROM users"
    q["business_cards"] = with_ctes(BUSINESS) + f"\nSELECT {BUSINESS_CARD} FROM business"
    q["restaurant_filter"] = with_ctes(BUSINESS) + f"""
SELECT business_id, name, categories FROM business WHERE {LISTED}"""
    q["top_users"] = with_ctes(USERS) + f"""
SELECT * FROM (SELECT {USER_CARD} FROM users) ORDER BY review_count DESC, user_id LIMIT 10"""
    q["top_restaurants"] = with_ctes(BUSINESS, CANDIDATES) + "\nSELECT * FROM cand"
    q["top_recommendations"] = with_ctes(USERS, BUSINESS, CANDIDATES) + """
, sc AS (SELECT u.user_id, c.business_id, c.name, c.review_count,
                round(""" + BLEND.format(u="CAST(u.average_stars AS DOUBLE)", b="c.stars") + """, 1) AS predicted_rating
         FROM users u CROSS JOIN cand c),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id
                                    ORDER BY predicted_rating DESC, review_count DESC, business_id) AS rank
       FROM sc)
SELECT user_id, CAST(rank AS BIGINT) AS rank, business_id, name, round(predicted_rating, 6) AS predicted_rating
FROM rk WHERE rank <= 6"""
    q["candidate_pairs"] = with_ctes(USERS, BUSINESS, CANDIDATES) + """
SELECT u.user_id, c.business_id FROM users u CROSS JOIN cand c"""
    example = with_ctes(USERS, BUSINESS) + """
, ut AS (SELECT user_id, name, row_number() OVER (ORDER BY review_count DESC, user_id) AS pair_no
         FROM users QUALIFY pair_no <= 3),
bt AS (SELECT business_id, name, row_number() OVER (ORDER BY review_count DESC, business_id) AS pair_no
       FROM business QUALIFY pair_no <= 3),
ex AS (SELECT CAST(ut.pair_no AS BIGINT) AS pair_no, ut.user_id,
              coalesce(ut.name, 'User ' || CAST(ut.pair_no AS VARCHAR)) AS user_name,
              substr(ut.user_id, 1, 8) AS user_short, bt.business_id,
              coalesce(bt.name, 'Business ' || CAST(bt.pair_no AS VARCHAR)) AS business_name,
              substr(bt.business_id, 1, 8) AS business_short
       FROM ut JOIN bt ON ut.pair_no = bt.pair_no)"""
    q["example_pairs"] = example + "\nSELECT * FROM ex"
    q["sample_pair"] = example + """
SELECT * FROM ex ORDER BY md5('42' || '|' || user_id || '|' || business_id), user_id, business_id LIMIT 1"""
    q["strict_pairs"] = with_ctes(REVIEWS, USERS, BUSINESS, TEST_PAIRS, STRICT_TEST) + """
SELECT user_id, business_id, round(average_stars, 6) AS average_stars, round(stars, 6) AS stars FROM sp"""
    q["blend_predictions"] = with_ctes(REVIEWS, USERS, BUSINESS, TEST_PAIRS, BLEND_TEST) + """
SELECT user_id, business_id, round(x, 6) AS predicted_rating FROM bl"""
    q["rating_bands"] = with_ctes(REVIEWS, USERS, BUSINESS, TEST_PAIRS, BLEND_TEST) + """
SELECT user_id, business_id, round(x, 6) AS rating,
       CASE WHEN x < 2.5 THEN 'poor' WHEN x < 3.5 THEN 'acceptable' ELSE 'great' END AS band FROM bl"""
    q["star_glyphs"] = with_ctes(REVIEWS, USERS, BUSINESS, TEST_PAIRS, BLEND_TEST) + """
SELECT user_id, business_id, round(x, 6) AS rating,
       repeat('★', CAST(floor(x) AS BIGINT))
       || CASE WHEN x - floor(x) >= 0.5 THEN '½' ELSE '' END
       || repeat('☆', CAST(greatest(0, 5 - floor(x) - CASE WHEN x - floor(x) >= 0.5 THEN 1 ELSE 0 END) AS BIGINT))
       AS glyphs FROM bl"""
    q["holdout_split"] = with_ctes(REVIEWS) + """
SELECT user_id, business_id, pair_key, stars AS rating,
       CAST(CASE WHEN is_holdout THEN 1 ELSE 0 END AS BIGINT) AS is_holdout FROM reviews"""
    q["balanced_sample"] = with_ctes(REVIEWS) + """
SELECT user_id, business_id, pair_key, stars AS rating FROM (
  SELECT *, row_number() OVER (PARTITION BY stars ORDER BY md5(pair_key), pair_key, user_id, business_id) AS rn
  FROM reviews) WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM reviews GROUP BY stars))"""
    q["regression_metrics"] = with_ctes(REVIEWS, USERS, BUSINESS, scored_reviews(True)) + """
SELECT count(*) AS n, round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse,
       round(avg(abs(prediction - rating)), 6) AS mae,
       round(coalesce(1.0e0 - sum((prediction - rating) * (prediction - rating))
                      / nullif(var_pop(rating) * count(*), 0), 0.0e0), 6) AS r2
FROM sc"""
    q["kfold_metrics"] = with_ctes(REVIEWS, USERS, BUSINESS, scored_reviews(False)) + """
SELECT CAST(CAST('0x' || substr(md5(pair_key), 9, 8) AS BIGINT) % 5 AS BIGINT) AS fold,
       count(*) AS n, round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse,
       round(avg(abs(prediction - rating)), 6) AS mae
FROM sc GROUP BY 1"""
    train_pf = with_ctes(REVIEWS, *FEATURE_CTES, TRAIN, "p AS (SELECT user_id, business_id, stars FROM train)") + \
        ", pf AS (" + pair_feature_select("p.stars", rnd=False) + ")"
    mm = ", mm AS (SELECT " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in FEATURES) + \
        " FROM pf)"
    q["feature_minmax"] = train_pf + mm + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(mn_{c}, 6) AS min_value, round(mx_{c}, 6) AS max_value FROM mm"
        for c in FEATURES)
    test_pf = ", tp AS (SELECT user_id, business_id FROM reviews WHERE is_holdout)" + \
        ", tf AS (" + pair_feature_select(None, rnd=False).replace("FROM p\n", "FROM tp p\n") + ")"
    q["scaled_features"] = train_pf + mm + test_pf + "\nSELECT tf.user_id, tf.business_id, " + ", ".join(
        f"round(CASE WHEN mx_{c} = mn_{c} THEN tf.{c} - mn_{c} "
        f"ELSE (tf.{c} - mn_{c}) / (mx_{c} - mn_{c}) END, 6) AS {c}" for c in FEATURES) + " FROM tf, mm"
    pairs = ", ".join(f"{{'k': '{k}', 'v': a_{k}}}" for k in ATTR_KEYS)
    q["true_attributes"] = with_ctes(BUSINESS) + f"""
SELECT business_id, array_to_string(list_sort(list_transform(
         list_filter([{pairs}], lambda x: x.v = 'true' OR x.v = '"True"'),
         lambda x: array_to_string(list_transform(string_split(replace(x.k, '_', ' '), ' '),
                   lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')))[1:5], ', ')
       AS features_text FROM business"""
    q["tenure_years"] = with_ctes(USERS_WITH_TIME) + f"""
SELECT user_id, round(CASE WHEN yelping_since IS NULL THEN date_diff('day', DATE '2020-01-01', DATE '{AS_OF_DATE}') / 365.0e0
                       WHEN regexp_full_match(yelping_since, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')
                            AND try_strptime(yelping_since, '%Y-%m-%d') IS NOT NULL
                       THEN date_diff('day', CAST(try_strptime(yelping_since, '%Y-%m-%d') AS DATE),
                                      DATE '{AS_OF_DATE}') / 365.0e0
                       ELSE 0.0e0 END, 6) AS tenure_years FROM users"""
    q["attribute_codes"] = with_ctes(BUSINESS) + "\nSELECT business_id, " + ", ".join(
        f"round({attr_code('a_' + a)}, 6) AS a_{a}" for a in SERVING_ATTRIBUTES) + " FROM business"
    tenure = (f"CASE WHEN u.yelping_since IS NULL THEN date_diff('day', DATE '2020-01-01', DATE '{AS_OF_DATE}') / 365.0e0 "
              f"WHEN regexp_full_match(u.yelping_since, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') "
              f"AND try_strptime(u.yelping_since, '%Y-%m-%d') IS NOT NULL "
              f"THEN date_diff('day', CAST(try_strptime(u.yelping_since, '%Y-%m-%d') AS DATE), "
              f"DATE '{AS_OF_DATE}') / 365.0e0 ELSE 0.0e0 END")
    sv = ["coalesce(CAST(u.review_count AS DOUBLE), 0.0e0)", "coalesce(CAST(u.average_stars AS DOUBLE), 3.0e0)",
          "coalesce(CAST(u.useful AS DOUBLE), 0.0e0)", "coalesce(CAST(u.funny AS DOUBLE), 0.0e0)",
          "coalesce(CAST(u.cool AS DOUBLE), 0.0e0)", "coalesce(CAST(u.fans AS DOUBLE), 0.0e0)", tenure,
          "coalesce(CAST(b.review_count AS DOUBLE), 0.0e0)", "coalesce(CAST(b.stars AS DOUBLE), 3.0e0)"]
    sv += [attr_code("b.a_" + a) for a in SERVING_ATTRIBUTES]
    sv += ["CAST(coalesce(ut.n, 0) AS DOUBLE)", "CAST(coalesce(bt.n, 0) AS DOUBLE)"]
    sv += [f"({sv[1]}) * ({sv[8]})", f"({sv[0]}) * ({sv[7]})"] + ["0.0e0"] * 9
    q["serving_features"] = with_ctes(REVIEWS, USERS, BUSINESS, TIPS, TEST_PAIRS) + """
, ut AS (SELECT user_id, count(*) AS n FROM tips GROUP BY user_id),
bt AS (SELECT business_id, count(*) AS n FROM tips GROUP BY business_id)
SELECT p.user_id, p.business_id, """ + ", ".join(f"round({e}, 6) AS f{i}" for i, e in enumerate(sv)) + """
FROM test_pairs p JOIN users u ON p.user_id = u.user_id JOIN business b ON p.business_id = b.business_id
LEFT JOIN ut ON p.user_id = ut.user_id LEFT JOIN bt ON p.business_id = bt.business_id"""
    return q


WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"2 * 6371.0e0 * asin(least(1.0e0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) "
            f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


def comma_list(col: str) -> str:
    return (f"list_filter(list_transform(string_split(coalesce({col}, ''), ','), lambda p: trim(p, {WS})), "
            f"lambda p: p <> '')")


def span_hours(v: str) -> str:
    def to_h(t):
        return (f"(TRY_CAST(split_part({t}, ':', 1) AS DOUBLE) "
                f"+ coalesce(TRY_CAST(split_part({t}, ':', 2) AS DOUBLE), 0.0e0) / 60.0e0)")
    s, e = to_h(f"split_part({v}, '-', 1)"), to_h(f"split_part({v}, '-', 2)")
    return f"(CASE WHEN {e} <= {s} THEN {e} + 24.0e0 - {s} ELSE {e} - {s} END)"


def _queries_3() -> dict[str, str]:
    q: dict[str, str] = {}
    for key, col in (("user_rating_history", "user_id"), ("business_rating_history", "business_id")):
        q[key] = with_ctes(REVIEWS, TRAIN) + f"""
SELECT {col}, count(*) AS n, round(avg(stars), 6) AS avg_rating,
       round(coalesce(var_samp(stars), 0.0e0), 6) AS var_rating,
       round(min(stars), 6) AS min_rating, round(max(stars), 6) AS max_rating
FROM train GROUP BY {col}"""
    span = "(date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1)"
    q["user_recency"] = with_ctes(REVIEWS, TRAIN) + f"""
SELECT user_id, count(*) AS n, CAST({span} AS BIGINT) AS active_days,
       CAST(date_diff('day', max(CAST(ts AS DATE)), DATE '{AS_OF_DATE}') AS BIGINT) AS days_since_last,
       round(count(*) / {span}, 6) AS reviews_per_day
FROM train GROUP BY user_id"""
    lr = """
lr AS (SELECT t.user_id, b.city, b.latitude, b.longitude
       FROM train t JOIN business b ON t.business_id = b.business_id),
cen AS (SELECT user_id, avg(latitude) AS c_lat, avg(longitude) AS c_lon FROM lr GROUP BY user_id)"""
    q["user_geo_mobility"] = with_ctes(REVIEWS, BUSINESS, TRAIN, lr) + f"""
, pc AS (SELECT user_id, city, count(*) AS n FROM lr GROUP BY user_id, city),
tc AS (SELECT user_id, city AS top_city FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, city) AS rn FROM pc) WHERE rn = 1),
nc AS (SELECT user_id, count(*) AS cities FROM pc GROUP BY user_id),
dk AS (SELECT lr.user_id, avg({hav('lr.latitude', 'lr.longitude', 'cen.c_lat', 'cen.c_lon')}) AS avg_km
       FROM lr JOIN cen ON lr.user_id = cen.user_id GROUP BY lr.user_id)
SELECT nc.user_id, CAST(nc.cities AS BIGINT) AS cities, tc.top_city, round(dk.avg_km, 4) AS avg_km
FROM nc JOIN tc ON nc.user_id = tc.user_id JOIN dk ON nc.user_id = dk.user_id"""
    q["category_onehot"] = with_ctes(BUSINESS) + f"""
, c AS (SELECT business_id, unnest(CASE WHEN len(cl) = 0 THEN [NULL] ELSE cl END) AS category
        FROM (SELECT business_id, list_distinct({comma_list('categories')}) AS cl FROM business)),
v AS (SELECT category, row_number() OVER (ORDER BY substr(md5(category), 1, 2), category) - 1 AS slot
      FROM (SELECT DISTINCT category FROM c WHERE category IS NOT NULL))
SELECT c.business_id, c.category, v.slot FROM c LEFT JOIN v ON c.category = v.category"""
    q["business_attributes"] = with_ctes(BUSINESS) + f"""
SELECT business_id, round(coalesce(TRY_CAST(trim(a_RestaurantsPriceRange2, '"') AS DOUBLE), 0.0e0), 6) AS price,
       round({attr_code('a_Ambience')}, 6) AS ambience, round({attr_code('a_Parking')}, 6) AS parking,
       round({attr_code('a_WiFi')}, 6) AS wifi FROM business"""
    q["operational_features"] = with_ctes(BUSINESS) + f"""
SELECT business_id, CAST(7 AS BIGINT) AS open_days, round(7 * {span_hours('day_hours')}, 6) AS weekly_hours,
       round({attr_code('a_RestaurantsDelivery')}, 6) AS delivers FROM business"""
    q["neighborhood_stats"] = with_ctes(BUSINESS) + """
, c AS (SELECT city, count(*) AS city_count, avg(stars) AS city_avg_stars FROM business GROUP BY city)
SELECT b.business_id, b.city, c.city_count, round(c.city_avg_stars, 6) AS city_avg_stars,
       round(b.stars - c.city_avg_stars, 6) AS diff
FROM business b JOIN c ON b.city IS NOT DISTINCT FROM c.city"""
    q["category_affinity"] = with_ctes(REVIEWS, BUSINESS, TRAIN) + f"""
, cats AS (SELECT business_id, unnest(list_distinct({comma_list('categories')})) AS category FROM business),
uc AS (SELECT t.user_id, c.category, count(*) AS n, avg(t.stars) AS avg_rating
       FROM train t JOIN cats c ON t.business_id = c.business_id GROUP BY t.user_id, c.category),
ua AS (SELECT user_id, avg(stars) AS user_avg FROM train GROUP BY user_id)
SELECT uc.user_id, uc.category, uc.n, round(uc.avg_rating, 6) AS avg_rating,
       round(uc.avg_rating - ua.user_avg, 6) AS affinity
FROM uc JOIN ua ON uc.user_id = ua.user_id"""
    q["price_alignment"] = with_ctes(REVIEWS, BUSINESS, TRAIN, TEST_PAIRS) + """
, up AS (SELECT t.user_id, avg(CAST(b.price AS DOUBLE)) AS user_price
         FROM train t JOIN business b ON t.business_id = b.business_id GROUP BY t.user_id)
SELECT p.user_id, p.business_id, round(abs(CAST(b.price AS DOUBLE) - up.user_price), 6) AS price_gap
FROM test_pairs p JOIN business b ON p.business_id = b.business_id JOIN up ON p.user_id = up.user_id"""
    q["centroid_distance"] = with_ctes(REVIEWS, BUSINESS, TRAIN, TEST_PAIRS, lr) + f"""
SELECT p.user_id, p.business_id, round({hav('b.latitude', 'b.longitude', 'cen.c_lat', 'cen.c_lon')}, 4) AS km
FROM test_pairs p JOIN business b ON p.business_id = b.business_id JOIN cen ON p.user_id = cen.user_id"""
    dows = ", ".join(f"count(*) FILTER (WHERE dayofweek(ts) = {d - 1}) AS dow_{d}" for d in range(1, 8))
    parts = ", ".join(f"count(*) FILTER (WHERE hour(ts) >= {h} AND hour(ts) < {h + 6}) AS n_{part}" for part, h in
                      (("night", 0), ("morning", 6), ("afternoon", 12), ("evening", 18)))
    q["temporal_patterns"] = with_ctes(REVIEWS, TRAIN) + f"""
SELECT user_id, count(*) AS n,
       round((count(*) FILTER (WHERE dayofweek(ts) IN (0, 6))) / count(*), 6) AS weekend_share, {dows}, {parts}
FROM train GROUP BY user_id"""
    q["friend_ratings"] = with_ctes(REVIEWS, USERS, TRAIN, TEST_PAIRS) + f"""
, e AS (SELECT DISTINCT user_id, f AS friend_id
        FROM (SELECT user_id, unnest({comma_list('friends')}) AS f FROM users) WHERE f <> user_id),
p AS (SELECT DISTINCT user_id, business_id FROM test_pairs),
bp AS (SELECT p.user_id, p.business_id, count(*) AS n, avg(t.stars) AS friend_avg
       FROM p JOIN e ON p.user_id = e.user_id
       JOIN train t ON t.user_id = e.friend_id AND t.business_id = p.business_id GROUP BY p.user_id, p.business_id),
bu AS (SELECT e.user_id, avg(t.stars) AS overall FROM e JOIN train t ON t.user_id = e.friend_id GROUP BY e.user_id)
SELECT p.user_id, p.business_id, CAST(coalesce(bp.n, 0) AS BIGINT) AS n, round(bp.friend_avg, 6) AS friend_avg,
       round(bu.overall, 6) AS friends_overall_avg
FROM p LEFT JOIN bp ON p.user_id = bp.user_id AND p.business_id = bp.business_id LEFT JOIN bu ON p.user_id = bu.user_id"""
    q["tip_sentiment"] = with_ctes(TIPS, LEXICON) + """
, tk AS (SELECT business_id,
                list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z]+'), lambda w: w <> '') AS toks
         FROM tips),
cnt AS (SELECT business_id, CAST(sum(len(toks)) AS BIGINT) AS tokens FROM tk GROUP BY business_id),
sc AS (SELECT w.business_id, sum(l.weight) AS score_sum
       FROM (SELECT business_id, unnest(toks) AS word FROM tk) w JOIN lexicon l ON w.word = l.word
       GROUP BY w.business_id)
SELECT cnt.business_id, cnt.tokens, round(coalesce(sc.score_sum, 0.0e0), 6) AS score_sum,
       round(coalesce(coalesce(sc.score_sum, 0.0e0) / nullif(cnt.tokens, 0), 0.0e0), 6) AS score_avg
FROM cnt LEFT JOIN sc ON cnt.business_id = sc.business_id"""
    return q


# The negations and their window, as in ``operators.sentiment``.
NEGATIONS = "['no', 'nor', 'not', 'never', 'cannot', 'without', 'ne', 'pas', 'nicht', 'kein', 'nunca']"
NEAR_KM = "25.0e0"

WORDS = f"""
tip_words AS (
  SELECT business_id, i, k, len(words) AS n, words[k] AS word, words FROM (
    SELECT business_id, i, words, unnest(range(1, len(words) + 1)) AS k FROM (
      SELECT business_id, row_number() OVER () AS i,
             list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
               regexp_replace(lower(coalesce(text, '')), 'n[''’]t', ' not', 'g'), '[.,;:!?\n]+')), '[^a-z]+'), lambda w: w <> '') AS words
      FROM tips))),
marked AS (
  SELECT business_id, CASE WHEN list_has_any(words[greatest(1, k - 3):k - 1], {NEGATIONS}) THEN 'not_' || word ELSE word END AS word
  FROM tip_words),
means AS (SELECT business_id, avg(stars) AS mean FROM train GROUP BY business_id),
business_label AS (SELECT business_id, mean >= (SELECT avg(stars) FROM train) AS positive FROM means)"""


def fitted_lexicon(name: str, where: str = "TRUE") -> str:
    return f"""
{name}_counts AS (
  SELECT word, count(*) FILTER (positive) AS n_pos, count(*) FILTER (NOT positive) AS n_neg
  FROM marked JOIN business_label USING (business_id) WHERE {where} GROUP BY word),
{name}_all AS (
  SELECT c.*, ln((n_pos + 1.0e0) / (t.pos + t.words)) - ln((n_neg + 1.0e0) / (t.neg + t.words)) AS weight
  FROM {name}_counts c, (SELECT sum(n_pos) AS pos, sum(n_neg) AS neg, count(*) AS words FROM {name}_counts) t),
{name} AS (
  SELECT *, weight / sqrt(1 / (n_pos + 1.0e0) + 1 / (n_neg + 1.0e0)) AS z FROM {name}_all
  WHERE n_pos + n_neg >= 5 AND abs(weight / sqrt(1 / (n_pos + 1.0e0) + 1 / (n_neg + 1.0e0))) >= 1.96e0)"""


def _queries_4() -> dict[str, str]:
    """Point-in-time history, statistics within a radius, the fitted lexicon."""
    q: dict[str, str] = {}
    for key, col in (("user_rating_history_as_of", "user_id"), ("business_rating_history_as_of", "business_id")):
        q[key] = with_ctes(REVIEWS) + f"""
, w AS (
  SELECT user_id, business_id, pair_key, ts, count(stars) OVER e AS n, sum(stars) OVER e AS s, sum(stars * stars) OVER e AS ss,
         min(stars) OVER e AS lo, max(stars) OVER e AS hi
  FROM reviews WINDOW e AS (PARTITION BY {col} ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP))
SELECT user_id, business_id, pair_key, ts, n, round(s / nullif(n, 0), 6) AS avg_rating,
       round(CASE WHEN n > 1 THEN greatest(0.0e0, (ss - s * s / n) / (n - 1)) WHEN n = 1 THEN 0.0e0 END, 6) AS var_rating,
       round(lo, 6) AS min_rating, round(hi, 6) AS max_rating FROM w"""
    q["user_recency_as_of"] = with_ctes(REVIEWS) + """
, w AS (
  SELECT user_id, business_id, pair_key, ts, count(*) OVER e AS n, min(CAST(ts AS DATE)) OVER e AS a, max(CAST(ts AS DATE)) OVER e AS z
  FROM reviews WINDOW e AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP))
SELECT user_id, business_id, pair_key, ts, n, CAST(date_diff('day', a, z) + 1 AS BIGINT) AS active_days,
       CAST(date_diff('day', z, CAST(ts AS DATE)) AS BIGINT) AS days_since_last,
       round(CASE WHEN n > 0 THEN n / (date_diff('day', a, z) + 1) END, 6) AS reviews_per_day FROM w"""
    q["neighborhood_radius"] = with_ctes(BUSINESS) + f"""
, near AS (
  SELECT a.business_id, count(*) AS n_near, avg(b.stars) AS near_avg
  FROM business a JOIN business b ON a.business_id <> b.business_id
    AND {hav('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= {NEAR_KM}
  GROUP BY a.business_id)
SELECT a.business_id, coalesce(n_near, 0) AS n_near, round(near_avg, 6) AS near_avg_stars, round(a.stars - near_avg, 6) AS diff
FROM business a LEFT JOIN near USING (business_id)"""
    q["category_pmi"] = with_ctes(BUSINESS) + f"""
, l AS (SELECT DISTINCT business_id, unnest({comma_list('categories')}) AS c FROM business),
one AS (SELECT c, count(*) AS n FROM l GROUP BY c),
two AS (SELECT x.c AS a, y.c AS b, count(*) AS n FROM l x JOIN l y ON x.business_id = y.business_id AND x.c <> y.c GROUP BY x.c, y.c)
SELECT a, b, two.n, round(ln(two.n * (SELECT count(DISTINCT business_id) FROM l) / (p.n * q.n)), 6) AS ppmi
FROM two JOIN one p ON p.c = a JOIN one q ON q.c = b
WHERE ln(two.n * (SELECT count(DISTINCT business_id) FROM l) / (p.n * q.n)) > 0"""
    q["sentiment_lexicon"] = with_ctes(REVIEWS, TRAIN, TIPS, WORDS, fitted_lexicon("lexicon")) + """
SELECT word, n_pos, n_neg, round(weight, 6) AS weight, round(z, 6) AS z FROM lexicon"""
    q["tip_sentiment_fitted"] = with_ctes(REVIEWS, TRAIN, TIPS, WORDS, fitted_lexicon("lexicon")) + """
, s AS (SELECT business_id, count(*) AS tokens, coalesce(sum(weight), 0.0e0) AS score_sum
        FROM marked LEFT JOIN lexicon USING (word) GROUP BY business_id)
SELECT b.business_id, coalesce(tokens, 0) AS tokens, round(coalesce(score_sum, 0.0e0), 6) AS score_sum,
       round(coalesce(score_sum / tokens, 0.0e0), 6) AS score_avg
FROM (SELECT DISTINCT business_id FROM tips) b LEFT JOIN s USING (business_id)"""
    q["sentiment_sign_test"] = with_ctes(REVIEWS, TRAIN, TIPS, WORDS, fitted_lexicon("fit", "substr(md5(business_id), 1, 2) >= '33'")) + """
, s AS (SELECT business_id, coalesce(sum(weight), 0.0e0) AS score FROM marked LEFT JOIN fit USING (word)
        WHERE substr(md5(business_id), 1, 2) < '33' GROUP BY business_id)
SELECT count(*) AS n, count(*) FILTER ((score > 0) = positive) AS agree,
       round(count(*) FILTER ((score > 0) = positive) / nullif(count(*), 0), 6) AS share
FROM s JOIN business_label USING (business_id) WHERE score <> 0"""
    return q


def _half_up(sql: str, digits=("6", "4")) -> str:
    """Rewrite ``round(e, d)`` (d in ``digits``) as ``floor(e * 1e<d> + 0.5) / 1e<d>``: the
    same double arithmetic the Spark side uses for compared outputs."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                last_comma = k
            elif ch == "'":
                k = sql.index("'", k + 1)
            k += 1
        inner, arg = sql[j + 6:last_comma], sql[last_comma + 1:k - 1].strip()
        inner = _half_up(inner, digits)
        if last_comma > 0 and arg in digits:
            out.append(sql[i:j] + f"(floor(({inner}) * 1e{arg} + 0.5) / 1e{arg})")
        else:
            out.append(sql[i:j] + "round(" + inner + "," + sql[last_comma + 1:k])
        i = k


def oracle_sql() -> dict[str, str]:
    q = _queries()
    q.update(_queries_2())
    q.update(_queries_3())
    q.update(_queries_4())
    return {k: _half_up(v) for k, v in q.items()}
