"""A hot key holding a third of all rows: results stay whole and equal when AQE
splits the skewed join partition (forced here with tiny thresholds)."""

from pyspark.sql import functions as F

from ratewise.operators import features as FE
from ratewise.operators import history as H
from ratewise.plans.catalog import AS_OF_YEAR, Tables

from conftest import SF_SMALL

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def skewed_reviews(t):
    r = t.reviews
    # half of the reviews (chosen by key hash, deterministic) copied onto user '1':
    # that user then holds about a third of all rows
    hot = r.filter(F.substring(F.md5("pair_key"), 1, 1) < "8").withColumn("user_id", F.lit("1"))
    return r.unionByName(hot)


def collect_rounded(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(cols).collect())


def with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_pair_features_hot_user(spark):
    t = Tables(spark, SF_SMALL)
    cols = ["user_id", "business_id", "rating"] + FE.FEATURES

    def run():
        return FE.pair_features(skewed_reviews(t), t.users, t.business, t.tips, AS_OF_YEAR)

    base = collect_rounded(run(), cols)
    df = with_conf(spark, SKEW_CONF, lambda: run())
    split = with_conf(spark, SKEW_CONF, lambda: collect_rounded(df, cols))
    assert len(base) == skewed_reviews(t).count()
    assert split == base
    with_conf(spark, SKEW_CONF, lambda: df.collect())  # runs the DataFrame's own adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "skew=true" in plan


def test_friend_ratings_hot_user(spark):
    t = Tables(spark, SF_SMALL)
    cols = ["user_id", "business_id", "n"]

    def run():
        return collect_rounded(H.friend_ratings(t.test_pairs, t.users, skewed_reviews(t)), cols)

    base = run()
    split = with_conf(spark, SKEW_CONF, run)
    assert split == base and len(base) > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def test_balanced_sample_shuffles_no_rating_whole(spark):
    """Joined by a shuffle, all rows of a rating met in one task."""
    from ratewise.operators import ranking as R
    r = spark.createDataFrame([("u", "b", 1.0, "k")], "user_id string, business_id string, stars double, pair_key string")
    p = with_conf(spark, NO_BROADCAST, lambda: plan(R.balanced_sample(r)))
    assert "SortMergeJoin" not in p and p.count("BroadcastHashJoin") == 2


def test_stored_reviews_are_shuffled_once(spark):
    from ratewise.sources import fixtures as FX
    p = plan(FX.reviews(spark, SF_SMALL, dealt=True))
    assert p.count("Exchange hashpartitioning(") == 2 and "hashpartitioning(l_orderkey" in p and "hashpartitioning(o_orderkey" in p


def test_the_narrower_side_is_shuffled_on(spark):
    t = Tables(spark, SF_SMALL)
    us, bs = (spark.createDataFrame([], ", ".join([f"{k} string", *[f"{c} double" for c in cols]]))
              for k, cols in (("user_id", FE.USER_SLOTS + FE.TIP_SLOTS[:3]), ("business_id", FE.BUSINESS_SLOTS + FE.TIP_SLOTS[3:])))
    p = with_conf(spark, NO_BROADCAST, lambda: plan(FE.attach_sides(t.test_pairs.select("user_id", "business_id"), us, bs)))
    joins = [x for x in p.split("\n") if "SortMergeJoin" in x]
    assert len(joins) == 2 and "[user_id" in joins[0] and "[business_id" in joins[1]  # the plan's first line is its last join
