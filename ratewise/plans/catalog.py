"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the domain tables from the driver tables in ``sf_dir``
(``ratewise.sources.fixtures``) and runs one operator over the whole tables.
Computed doubles are rounded to 6 decimals at the very end, only so that the
comparison with the DuckDB oracle does not depend on the summation order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.operators import features as FE
from ratewise.operators import lookups as L
from ratewise.operators import metrics as M
from ratewise.operators import pairs as P
from ratewise.operators import ranking as R
from ratewise.operators import serving as V
from ratewise.operators import stats as S
from ratewise.plans.memo import kept, stored
from ratewise.sources import fixtures as FX

AS_OF_YEAR = 2024
AS_OF_DATE = "2024-12-31"
# The derived users and businesses have one row per id (their ids are primary keys).
UNIQUE = True
#: Reviews that a task of category_affinity adds up by user and category.
AFFINITY_ROWS = 250_000
#: The most such tasks; above 5 billion reviews a task gets more of them.
AFFINITY_TASKS = 20_000

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; integer columns widened to bigint."""
    from ratewise.functions.columns import round_half_up
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_half_up(F.col(f.name).cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


class Tables:
    """Domain tables of one scale-factor folder. The reviews, a join of the two large tables, are stored when first asked for
    and shared by the queries of a session; the others are derived lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def reviews(self) -> DataFrame:
        # dealt by the join, as the scans of the stored table take their parallelism from its files
        return kept(self.spark, self.sf_dir, "reviews", lambda: stored(FX.reviews(self.spark, self.sf_dir, dealt=True), "reviews"))

    @property
    def n_reviews(self) -> int:
        return kept(self.spark, self.sf_dir, "n_reviews", lambda: self.reviews.count())

    @property
    def train(self) -> DataFrame:
        return self.reviews.filter(~FX.split_flag(F.col("pair_key")))

    @property
    def test_pairs(self) -> DataFrame:
        return self.reviews.filter(FX.split_flag(F.col("pair_key"))).select("user_id", "business_id", "pair_key")

    @property
    def users(self) -> DataFrame:
        return FX.users(self.spark, self.sf_dir)

    @property
    def business(self) -> DataFrame:
        return FX.business(self.spark, self.sf_dir)

    @property
    def tips(self) -> DataFrame:
        return FX.tips(self.spark, self.sf_dir)


# --- 2.3 - 2.8: features and statistics -----------------------------------------------

@register("user_features")
def q_user_features(spark, sf_dir):
    return rounded(FE.user_features(Tables(spark, sf_dir).users, AS_OF_YEAR, UNIQUE))


@register("business_features")
def q_business_features(spark, sf_dir):
    return rounded(FE.business_features(Tables(spark, sf_dir).business, AS_OF_YEAR, UNIQUE))


@register("user_tip_stats")
def q_user_tip_stats(spark, sf_dir):
    return rounded(FE.user_tip_stats(Tables(spark, sf_dir).tips))


@register("business_tip_stats")
def q_business_tip_stats(spark, sf_dir):
    return rounded(FE.business_tip_stats(Tables(spark, sf_dir).tips))


@register("user_global_stats")
def q_user_global_stats(spark, sf_dir):
    return rounded(S.user_global_stats(Tables(spark, sf_dir).users))


@register("business_global_stats")
def q_business_global_stats(spark, sf_dir):
    return rounded(S.business_global_stats(Tables(spark, sf_dir).business))


@register("global_stats")
def q_global_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(S.global_stats(t.users, t.business))


def sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The user and the business feature side, stored when first asked for and shared by the queries of a session."""
    return (kept(t.spark, t.sf_dir, "user side", lambda: stored(FE.user_side(t.users, t.tips, AS_OF_YEAR, UNIQUE), "user-side")),
            kept(t.spark, t.sf_dir, "business side", lambda: stored(FE.business_side(t.business, t.tips, AS_OF_YEAR, UNIQUE), "business-side")))


def labelled_features(t: Tables, reviews: DataFrame) -> DataFrame:
    """J1 from the stored sides."""
    return FE.attach_sides(reviews.select("user_id", "business_id", F.col("stars").cast("double").alias("rating")), *sides(t))


def unlabelled_features(t: Tables) -> DataFrame:
    """J2 from the stored sides."""
    return FE.attach_sides(t.test_pairs.select("user_id", "business_id"), *sides(t))


@register("pair_features")
def q_pair_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(labelled_features(t, t.reviews))


@register("pair_features_unlabelled")
def q_pair_features_unlabelled(spark, sf_dir):
    return rounded(unlabelled_features(Tables(spark, sf_dir)))


@register("interaction_features")
def q_interaction_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(FE.interaction_features(t.test_pairs, t.users, t.business, AS_OF_YEAR, UNIQUE))


# --- 2.1 / 2.2: lookups, cards, predicates ---------------------------------------------

LOOKUP_USER = 42
LOOKUP_BUSINESS = 42
PAIR_USER = "7"
PAIR_BUSINESS = "14"
BUSINESS_FLAT = ["business_id", "name", "stars", "review_count", "is_open", "categories", "city",
                 "state", "latitude", "longitude", "price"]


@register("restaurant_subset")
def q_restaurant_subset(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return L.restaurant_subset(t.reviews.select("user_id", "business_id", "stars", "pair_key"), t.business)


@register("user_lookup")
def q_user_lookup(spark, sf_dir):
    return rounded(L.user_lookup(FX.users(spark, sf_dir, only=LOOKUP_USER), str(LOOKUP_USER)))


@register("business_lookup")
def q_business_lookup(spark, sf_dir):
    return rounded(L.business_lookup(FX.business(spark, sf_dir, only=LOOKUP_BUSINESS), str(LOOKUP_BUSINESS)).select(*BUSINESS_FLAT))


@register("tips_for_pair")
def q_tips_for_pair(spark, sf_dir):
    return L.tips_for_pair(Tables(spark, sf_dir).tips, PAIR_USER, PAIR_BUSINESS)


@register("user_cards")
def q_user_cards(spark, sf_dir):
    return rounded(L.user_cards(Tables(spark, sf_dir).users))


@register("business_cards")
def q_business_cards(spark, sf_dir):
    return rounded(L.business_cards(Tables(spark, sf_dir).business))


@register("restaurant_filter")
def q_restaurant_filter(spark, sf_dir):
    return L.restaurant_filter(Tables(spark, sf_dir).business)


# --- 2.7 / 2.9: pairs, top-k, splits -----------------------------------------------------

N_TOP_USERS = 10
N_CANDIDATES = 20
N_RECOMMENDED = 6
N_EXAMPLE_PAIRS = 3
SEED = 42
N_FOLDS = 5


@register("top_users")
def q_top_users(spark, sf_dir):
    return rounded(R.top_users(Tables(spark, sf_dir).users, N_TOP_USERS))


@register("top_restaurants")
def q_top_restaurants(spark, sf_dir):
    return rounded(P.top_restaurants(Tables(spark, sf_dir).business, N_CANDIDATES))


@register("top_recommendations")
def q_top_recommendations(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(P.top_recommendations(t.users, t.business, N_CANDIDATES, N_RECOMMENDED, UNIQUE))


@register("candidate_pairs")
def q_candidate_pairs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return P.candidate_pairs(t.users, t.business, N_CANDIDATES)


@register("example_pairs")
def q_example_pairs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return P.example_pairs(t.users, t.business, N_EXAMPLE_PAIRS)


@register("sample_pair")
def q_sample_pair(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return P.sample_pair(P.example_pairs(t.users, t.business, N_EXAMPLE_PAIRS), SEED)


@register("strict_pairs")
def q_strict_pairs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(P.strict_pairs(t.test_pairs.select("user_id", "business_id"), t.users, t.business, UNIQUE))


@register("blend_predictions")
def q_blend_predictions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(P.blend_predictions(t.test_pairs, t.users, t.business, UNIQUE))


@register("holdout_split")
def q_holdout_split(spark, sf_dir):
    return R.holdout_split(Tables(spark, sf_dir).reviews)


@register("balanced_sample")
def q_balanced_sample(spark, sf_dir):
    return R.balanced_sample(Tables(spark, sf_dir).reviews)


def _scored_reviews(t: Tables, holdout_only: bool) -> DataFrame:
    r = t.reviews
    if holdout_only:
        r = r.filter(R.holdout_flag("pair_key"))
    sp = P.strict_pairs(r.select("user_id", "business_id", "pair_key", F.col("stars").alias("rating")),
                        t.users, t.business, UNIQUE)
    return sp.select("user_id", "business_id", "pair_key", "rating",
                     P.blend_score().alias("prediction"))


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    return rounded(M.regression_metrics(_scored_reviews(Tables(spark, sf_dir), True)))


@register("kfold_metrics")
def q_kfold_metrics(spark, sf_dir):
    return rounded(M.kfold_metrics(_scored_reviews(Tables(spark, sf_dir), False), N_FOLDS))


@register("rating_bands")
def q_rating_bands(spark, sf_dir):
    from ratewise.functions import columns as X
    t = Tables(spark, sf_dir)
    b = P.blend_predictions(t.test_pairs, t.users, t.business, UNIQUE)
    return rounded(b.select("user_id", "business_id", F.col("predicted_rating").alias("rating"),
                            X.rating_band("predicted_rating").alias("band")))


@register("star_glyphs")
def q_star_glyphs(spark, sf_dir):
    from ratewise.functions import columns as X
    t = Tables(spark, sf_dir)
    b = P.blend_predictions(t.test_pairs, t.users, t.business, UNIQUE)
    return rounded(b.select("user_id", "business_id", F.col("predicted_rating").alias("rating"),
                            X.star_glyphs("predicted_rating").alias("glyphs")))


# --- A6 / M2: scaling --------------------------------------------------------------------

@register("feature_minmax")
def q_feature_minmax(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(S.feature_minmax(FE.pair_minmax(t.train, *sides(t)), FE.FEATURES))


@register("scaled_features")
def q_scaled_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    us, bs = sides(t)
    test = FE.attach_sides(t.test_pairs.select("user_id", "business_id"), us, bs)
    return rounded(M.scaled_features(test, FE.pair_minmax(t.train, us, bs), FE.FEATURES, ["user_id", "business_id"]))


# --- V1 / X12-X14: serving ---------------------------------------------------------------

@register("true_attributes")
def q_true_attributes(spark, sf_dir):
    return V.true_attributes(Tables(spark, sf_dir).business)


@register("tenure_years")
def q_tenure_years(spark, sf_dir):
    return rounded(V.tenure_years(FX.users(spark, sf_dir, since_with_time=True), AS_OF_DATE))


@register("attribute_codes")
def q_attribute_codes(spark, sf_dir):
    return rounded(V.attribute_codes(Tables(spark, sf_dir).business))


@register("serving_features")
def q_serving_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(V.serving_features(t.test_pairs, t.users, t.business, t.tips, AS_OF_DATE, UNIQUE))


# --- 2.13: readme-promised features (training part of the reviews) --------------------

from ratewise.operators import history as H  # noqa: E402


@register("user_rating_history")
def q_user_rating_history(spark, sf_dir):
    return rounded(H.user_rating_history(Tables(spark, sf_dir).train))


@register("business_rating_history")
def q_business_rating_history(spark, sf_dir):
    return rounded(H.business_rating_history(Tables(spark, sf_dir).train))


@register("user_recency")
def q_user_recency(spark, sf_dir):
    return rounded(H.user_recency(Tables(spark, sf_dir).train, AS_OF_DATE))


@register("user_geo_mobility")
def q_user_geo_mobility(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(H.user_geo_mobility(t.train, t.business))


@register("category_onehot")
def q_category_onehot(spark, sf_dir):
    return H.category_onehot(Tables(spark, sf_dir).business)


@register("business_attributes")
def q_business_attributes(spark, sf_dir):
    return rounded(H.business_attributes(Tables(spark, sf_dir).business))


@register("operational_features")
def q_operational_features(spark, sf_dir):
    return rounded(H.operational_features(Tables(spark, sf_dir).business))


@register("neighborhood_stats")
def q_neighborhood_stats(spark, sf_dir):
    return rounded(H.neighborhood_stats(Tables(spark, sf_dir).business))


@register("category_affinity")
def q_category_affinity(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(H.category_affinity(t.train, t.business, min(-(-t.n_reviews // AFFINITY_ROWS), AFFINITY_TASKS)))


@register("price_alignment")
def q_price_alignment(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(H.price_alignment(t.test_pairs, t.train, t.business))


@register("centroid_distance")
def q_centroid_distance(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(H.centroid_distance(t.test_pairs, t.train, t.business))


@register("temporal_patterns")
def q_temporal_patterns(spark, sf_dir):
    return rounded(H.temporal_patterns(Tables(spark, sf_dir).train))


@register("friend_ratings")
def q_friend_ratings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(H.friend_ratings(t.test_pairs, t.users, t.train))


@register("tip_sentiment")
def q_tip_sentiment(spark, sf_dir):
    return rounded(H.tip_sentiment(Tables(spark, sf_dir).tips, FX.lexicon(spark)))


# --- 2.13 in depth: point in time, distance, fitted sentiment -----------------------------

from ratewise.operators import as_of as AO  # noqa: E402
from ratewise.operators import nearby as NB  # noqa: E402
from ratewise.operators import sentiment as SE  # noqa: E402

NEAR_KM = 25.0


@register("user_rating_history_as_of")
def q_user_rating_history_as_of(spark, sf_dir):
    return rounded(AO.rating_history(Tables(spark, sf_dir).reviews, "user_id"))


@register("business_rating_history_as_of")
def q_business_rating_history_as_of(spark, sf_dir):
    return rounded(AO.rating_history(Tables(spark, sf_dir).reviews, "business_id"))


@register("user_recency_as_of")
def q_user_recency_as_of(spark, sf_dir):
    return rounded(AO.recency(Tables(spark, sf_dir).reviews))


@register("neighborhood_radius")
def q_neighborhood_radius(spark, sf_dir):
    return rounded(NB.radius_stats(Tables(spark, sf_dir).business, NEAR_KM))


@register("sentiment_lexicon")
def q_sentiment_lexicon(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(SE.fit_lexicon(t.tips, t.train))


@register("tip_sentiment_fitted")
def q_tip_sentiment_fitted(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tips = kept(spark, sf_dir, "tip words", lambda: stored(SE.with_words(t.tips.select("business_id", "text")), "tip-words"))
    return rounded(SE.score_tips(tips, SE.fit_lexicon(tips, t.train), ["business_id"]))


@register("sentiment_sign_test")
def q_sentiment_sign_test(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rounded(SE.sign_test(t.tips, t.train))


# --- 2.12: model training and scoring (rows-only checks) ----------------------------------

# A larger step and shallower trees than the job's settings, so that early stopping (which
# ends the run, far below the job's 2000 rounds) comes after tens of trees.
QUERY_GBT = dict(step_size=0.2, max_depth=5, patience=10, first_stage=20)
N_MODEL_FOLDS = 3
GRID = dict(depths=(3, 5), steps=(0.1, 0.3), k=2, rung=10)


def trained(spark, sf_dir):
    """The scoring model; trained when first asked for, as several queries score with it."""
    from ratewise.plans import model as MD
    return kept(spark, sf_dir, "model", lambda: MD.train(train_features(Tables(spark, sf_dir)), MD.GBTParams(**QUERY_GBT)))


def train_features(t: Tables) -> DataFrame:
    return labelled_features(t, t.train)


@register("gbt_train_score")
def q_gbt_train_score(spark, sf_dir):
    """Train on the training part; score the labelled holdout reviews."""
    from ratewise.plans import model as MD
    t = Tables(spark, sf_dir)
    pf = labelled_features(t, t.reviews.filter(R.holdout_flag("pair_key")))
    return MD.predict(trained(spark, sf_dir).model, pf, ["user_id", "business_id", "rating"])


@register("batch_predictions")
def q_batch_predictions(spark, sf_dir):
    """M5: score the unlabelled test pairs."""
    from ratewise.plans import model as MD
    return MD.predict(trained(spark, sf_dir).model, unlabelled_features(Tables(spark, sf_dir)))


def pair_store(spark, sf_dir):
    """Model and feature tables stored, opened again."""
    from ratewise.plans import store as ST
    from ratewise.session import scratch_path

    def made():
        path = scratch_path(spark, f"pair-store-{uuid.uuid4().hex}")
        ST.write_store(path, trained(spark, sf_dir).model, *sides(Tables(spark, sf_dir)))
        return ST.open_store(spark, path)

    return kept(spark, sf_dir, "pair store", made)


@register("pair_prediction")
def q_pair_prediction(spark, sf_dir):
    """M6: from the stored model and feature tables, score the known test pairs of one user."""
    from ratewise.plans import store as ST
    return ST.predict_pairs(pair_store(spark, sf_dir), FX.test_pairs(spark, sf_dir, only_user=int(PAIR_USER)))


def personal(spark, sf_dir):
    """The personal candidates from factors of the training part."""
    from ratewise.plans import candidates as CA
    t = Tables(spark, sf_dir)
    return kept(spark, sf_dir, "candidates", lambda: stored(
        CA.personal_candidates(CA.fit_factors(t.train), t.users, t.business, N_CANDIDATES), "personal-candidates"))


@register("personal_candidates")
def q_personal_candidates(spark, sf_dir):
    """J5, personal: each user's best new restaurants by the factors of its reviews."""
    return personal(spark, sf_dir)


@register("candidate_recall")
def q_candidate_recall(spark, sf_dir):
    """Recall of the personal candidates, and of the most reviewed places, on the liked holdout reviews."""
    from ratewise.plans import candidates as CA
    t = Tables(spark, sf_dir)
    return CA.candidate_recall(personal(spark, sf_dir), t.train, t.reviews.filter(R.holdout_flag("pair_key")), t.business, N_CANDIDATES)


@register("top_recommendations_model")
def q_top_recommendations_model(spark, sf_dir):
    """Every user's personal candidates, ranked by the trained model."""
    from ratewise.plans import model as MD
    store = pair_store(spark, sf_dir)
    return MD.recommend(store.model, personal(spark, sf_dir).select("user_id", "business_id"), store.users, store.business, N_RECOMMENDED)


def paired_features(t: Tables) -> DataFrame:
    return train_features(t).withColumn("_pair", F.concat_ws("|", "user_id", "business_id"))


@register("kfold_model_metrics")
def q_kfold_model_metrics(spark, sf_dir):
    """Cross-validation with a model trained for each fold as the scoring model is."""
    from ratewise.plans import model as MD
    return MD.kfold_model_metrics(paired_features(Tables(spark, sf_dir)), "_pair", MD.GBTParams(**QUERY_GBT), N_MODEL_FOLDS)


@register("grid_search_metrics")
def q_grid_search_metrics(spark, sf_dir):
    """Every point of a parameter grid, by successive halving; the winner is grown to its end."""
    from ratewise.plans import model as MD
    return MD.grid_table(spark, MD.grid_search(paired_features(Tables(spark, sf_dir)), "_pair", MD.GBTParams(**QUERY_GBT), **GRID))


@register("category_pmi")
def q_category_pmi(spark, sf_dir):
    """K5: positive pointwise mutual information of categories that are listed together."""
    from ratewise.plans import embedding as EM
    return rounded(EM.category_pmi(Tables(spark, sf_dir).business))


@register("category_embedding")
def q_category_embedding(spark, sf_dir):
    """K5: category vectors, factorised from the PMI table, per business."""
    from ratewise.plans import embedding as EM
    return EM.category_embedding(Tables(spark, sf_dir).business)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
