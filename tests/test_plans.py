"""Physical-plan properties that matter at scale, checked on every registered query."""

import re

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

MODEL_QUERIES = {"gbt_train_score", "batch_predictions", "pair_prediction", "category_embedding",
                 "top_recommendations_model", "kfold_model_metrics", "grid_search_metrics"}
# the training-data operators write intermediate tables; they have tests of their own
NAMES = sorted(n for n in set(E.queries()) - MODEL_QUERIES if n != "pipeline" and not re.match(r"op\d+_", n))


def plan_of(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_pair_products_and_no_python(spark, name):
    p = plan_of(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


@pytest.mark.parametrize("name", NAMES)
def test_building_a_query_runs_no_job(spark, name):
    sc, group = spark.sparkContext, f"build-{name}"
    E.queries()[name](spark, SF_SMALL)  # the first use reads the tables' schemas
    sc.setJobGroup(group, "")
    try:
        E.queries()[name](spark, SF_SMALL)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert not sc.statusTracker().getJobIdsForGroup(group)


@pytest.mark.parametrize("name", ["pair_features", "scaled_features", "serving_features", "strict_pairs", "category_affinity"])
def test_no_rows_are_gathered_in_one_task(spark, name):
    p = plan_of(spark, name)
    # single-partition exchanges only carry one partial-aggregate row per task
    for part in p.split("Exchange SinglePartition")[1:]:
        assert "partial_" in part.split("\n")[1], name
    assert "GlobalLimit" not in p


def test_lookup_filters_reach_the_scans(spark):
    p = plan_of(spark, "user_lookup")
    for c in ("c_custkey", "o_custkey", "user_id"):
        assert f"EqualTo({c},42)" in p


def test_affinity_reads_the_reviews_once(spark):
    p = plan_of(spark, "category_affinity")
    assert p.count("ReadSchema: struct<user_id:string,business_id:string,stars:double") == 1
    assert p.count("Scan parquet") == 2  # the stored reviews, and part for the categories


def test_scaling_reads_stored_tables_only(spark):
    p = plan_of(spark, "scaled_features")
    assert "l_partkey" not in p and "o_custkey" not in p and p.count("Scan parquet") < 20


def test_changed_tables_are_read_again(spark, tmp_dir):
    import shutil
    from ratewise.plans import memo
    for t in memo.TABLES:
        if t != "documents":  # a table that no query here needs may be missing
            shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    assert ("documents",) in memo.folder_state(spark, tmp_dir)
    made = []
    make = lambda: made.append(1) or len(made)
    assert memo.kept(spark, tmp_dir, "x", make) == memo.kept(spark, tmp_dir, "x", make) == 1
    rows = E.queries()["user_rating_history"](spark, tmp_dir).count()
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter("o_custkey < 40").toPandas().to_parquet(f"{tmp_dir}/orders.parquet")
    assert memo.kept(spark, tmp_dir, "x", make) == 2
    assert E.queries()["user_rating_history"](spark, tmp_dir).count() < rows


def test_top_recommendations_ranks_in_row(spark):
    p = plan_of(spark, "top_recommendations")
    assert "Window" not in p and "array_sort" in p


def test_lexicon_is_broadcast(spark):
    p = plan_of(spark, "tip_sentiment")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_scans_read_only_needed_columns(spark):
    p = plan_of(spark, "pair_features")
    assert "l_extendedprice" not in p and "l_comment" not in p and "c_acctbal" not in p
