"""Properties of the flagship feature table."""

from pyspark.sql import functions as F

from ratewise.operators import features as FE
from ratewise.plans.catalog import AS_OF_YEAR, Tables

from conftest import SF_SMALL


def _pf(spark):
    t = Tables(spark, SF_SMALL)
    return t, FE.pair_features(t.reviews, t.users, t.business, t.tips, AS_OF_YEAR)


def test_one_row_per_review_and_36_slots(spark):
    t, pf = _pf(spark)
    assert pf.count() == t.reviews.count()
    assert len(FE.FEATURES) == 36
    assert pf.columns == ["user_id", "business_id", "rating", *FE.FEATURES]


def test_no_nulls_and_duplicate_slots_equal(spark):
    _, pf = _pf(spark)
    nulls = pf.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in FE.FEATURES]).first()
    assert all(v == 0 for v in nulls)
    assert pf.filter(F.col("u_engagement_score") != F.col("u_feedback_per_review")).count() == 0


def test_same_result_after_repartition(spark):
    t, pf = _pf(spark)
    again = FE.pair_features(t.reviews.repartition(7), t.users.repartition(3), t.business, t.tips, AS_OF_YEAR)
    # global means are sums of doubles whose order follows the partitioning: compare at 1e-9
    cols = [F.col("user_id"), F.col("business_id"), F.col("rating")] + [F.round(c, 9).alias(c) for c in FE.FEATURES]
    assert pf.select(cols).exceptAll(again.select(cols)).count() == 0
    assert again.select(cols).exceptAll(pf.select(cols)).count() == 0


def test_unknown_ids_get_zero_features(spark):
    _, pf = _pf(spark)
    unknown = pf.filter(F.col("business_id").startswith("x"))
    assert unknown.count() > 0
    row = unknown.agg(*[F.max(F.abs(c)).alias(c) for c in FE.BUSINESS_SLOTS]).first()
    assert all(v == 0.0 for v in row)


def test_holdout_split_is_stable_under_repartition(spark):
    from ratewise.operators import ranking as R
    t = Tables(spark, SF_SMALL)
    a = R.holdout_split(t.reviews)
    b = R.holdout_split(t.reviews.repartition(5, "business_id"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    share = a.agg(F.avg("is_holdout")).first()[0]
    assert 0.07 < share < 0.14  # 26/256 expected


def test_batch_predictions_cover_test_pairs_within_range(spark):
    import __spark_entry__ as E
    preds = E.queries()["batch_predictions"](spark, SF_SMALL)
    t = Tables(spark, SF_SMALL)
    assert preds.count() == t.test_pairs.count()
    assert preds.filter((F.col("prediction") < 1) | (F.col("prediction") > 5) | F.col("prediction").isNull()).count() == 0
