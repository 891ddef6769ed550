"""Model, sinks, the batch job and the streaming path (check U rows of SURVEY 2.1 / 2.12)."""

import os

import numpy as np
from pyspark.sql import functions as F

from ratewise.operators import features as FE
from ratewise.plans import model as MD
from ratewise.plans.catalog import Tables
from ratewise.sources import writers

from conftest import SF_SMALL


def planted(spark, n=2000, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(FE.FEATURES)))
    y = np.clip(1.0 + 4.0 * (0.7 * x[:, 0] + 0.3 * x[:, 17]), 1.0, 5.0)
    rows = [(f"u{i % 97}", f"b{i}", float(y[i]), *map(float, x[i])) for i in range(n)]
    schema = "user_id string, business_id string, rating double, " + ", ".join(f"{c} double" for c in FE.FEATURES)
    return spark.createDataFrame(rows, schema)


def test_planted_signal_beats_the_mean(spark):
    df = planted(spark)
    res = MD.train(df, MD.GBTParams(max_iter=8, step_size=0.3, max_depth=4, patience=3))
    pred = MD.predict(res.model, df, ["rating"])
    rmse = pred.select(F.sqrt(F.avg((F.col("prediction") - F.col("rating")) ** 2))).first()[0]
    base = df.select(F.stddev_pop("rating")).first()[0]
    assert rmse < 0.5 * base
    assert pred.filter((F.col("prediction") < 1) | (F.col("prediction") > 5)).count() == 0


def test_early_stopping_ends_the_run_and_cuts_the_trees(spark):
    res = MD.train(planted(spark), MD.GBTParams(step_size=0.5, max_depth=4, patience=4, first_stage=8, partitions=4))
    assert res.stopped_early and 1 < res.n_trees < len(res.validation_errors) < 2000
    assert len(res.model.stages[-1].trees) == res.n_trees
    assert res.validation_errors[res.n_trees - 1] == min(res.validation_errors)


def test_training_does_not_depend_on_the_inputs_partitioning(spark):
    df = planted(spark, n=600)
    params = MD.GBTParams(max_iter=4, step_size=0.3, max_depth=3, patience=0, partitions=4)
    a, b = (MD.predict(MD.train(x, params).model, df).orderBy("business_id").collect()
            for x in (df.repartition(3), df.repartition(7, "rating")))
    assert all(abs(x.prediction - y.prediction) < 1e-9 for x, y in zip(a, b))


def test_model_recommendations_are_personal(spark):
    import __spark_entry__ as E
    rows = E.queries()["top_recommendations_model"](spark, SF_SMALL).collect()
    sets = {}
    for r in rows:
        sets.setdefault(r.user_id, set()).add(r.business_id)
    assert len({frozenset(s) for s in sets.values()}) > 1 and all(len(s) == 6 for s in sets.values())


def test_registered_model_beats_the_mean_and_the_blend(spark):
    import __spark_entry__ as E
    from ratewise.operators import metrics as M
    from ratewise.plans import catalog as C
    q = E.queries()
    got = M.regression_metrics(q["gbt_train_score"](spark, SF_SMALL)).first()
    assert got.r2 > 0.3 and got.rmse < q["regression_metrics"](spark, SF_SMALL).first().rmse
    assert C.trained(spark, SF_SMALL).stopped_early and C.trained(spark, SF_SMALL).n_trees > 1


def test_a_fold_does_not_see_its_own_extremes(spark):
    df = planted(spark, n=600).withColumn("_k", F.col("business_id"))
    params = MD.GBTParams(max_iter=4, step_size=0.3, max_depth=2, patience=2, first_stage=2, partitions=4)
    base = {r.fold: r.rmse for r in MD.kfold_model_metrics(df, "_k", params, 2).collect()}
    from ratewise.operators import metrics as M
    fold_1 = M.fold_id("_k", 2) == 1
    huge = df.withColumn("u_fans", F.when(fold_1, F.col("u_fans") * 1e6).otherwise(F.col("u_fans")))
    moved = {r.fold: r.rmse for r in MD.kfold_model_metrics(huge, "_k", params, 2).collect()}
    # fold 1 is scored by a model of fold 0 alone, which the extremes in fold 1 do not touch
    assert abs(base[1] - moved[1]) < 0.05


def test_model_save_load_same_predictions(spark, tmp_dir):
    df = planted(spark, n=400)
    res = MD.train(df, MD.GBTParams(max_iter=3, step_size=0.3, max_depth=3, patience=0))
    path = os.path.join(tmp_dir, "model")
    MD.save(res.model, path)
    a = MD.predict(res.model, df).orderBy("business_id").collect()
    b = MD.predict(MD.load(path), df).orderBy("business_id").collect()
    assert a == b


def test_prediction_sink_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("u1", "b1", 3.25), ("u,2", "b2", 4.0)], "user_id string, business_id string, prediction double")
    out = os.path.join(tmp_dir, "pred")
    writers.write_predictions(df, out)
    back = spark.read.option("header", True).schema("user_id string, business_id string, prediction double").csv(out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_stats_cache(spark, tmp_dir):
    t = Tables(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "stats")
    first = writers.global_stats_cached(spark, t.users, t.business, path).first()
    again = writers.global_stats_cached(spark, t.users, t.business, path).first()
    assert first == again and first.n_users == t.users.count()
    # stored statistics of other tables are not used
    stale = writers.global_stats_cached(spark, t.users.limit(0), t.business.limit(0), path).first()
    assert stale.n_users == 0 and stale.total_reviews == 0.0


def export_inputs(spark, folder):
    """The reference's file layout, written from the smallest driver tables."""
    t = Tables(spark, SF_SMALL)
    train, test = t.train, t.test_pairs
    train.select("user_id", "business_id", "stars").coalesce(1).write.option("header", True).csv(f"{folder}/train.csv")
    test.select("user_id", "business_id", F.lit("").alias("stars")).coalesce(1).write.option("header", True).csv(f"{folder}/test.csv")
    t.users.write.json(f"{folder}/user.json")
    t.business.drop("price").write.json(f"{folder}/business.json")
    t.tips.write.json(f"{folder}/tip.json")
    return test.count()


def test_batch_job_end_to_end(spark, tmp_dir):
    from ratewise.plans import job
    n = export_inputs(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    info = job.run(spark, tmp_dir, f"{tmp_dir}/test.csv", out, model_path=os.path.join(tmp_dir, "m"),
                   as_of_year=2024, params=MD.GBTParams(max_iter=4, patience=2, step_size=0.2, max_depth=4))
    pred = spark.read.option("header", True).schema("user_id string, business_id string, prediction double").csv(out)
    assert pred.count() == n and info["trees"] >= 1
    assert pred.filter((F.col("prediction") < 1) | (F.col("prediction") > 5)).count() == 0
    assert os.path.isdir(os.path.join(tmp_dir, "m"))


def test_streaming_scoring(spark, tmp_dir):
    from ratewise.streaming import scoring
    t = Tables(spark, SF_SMALL)
    pf = FE.pair_features(t.train, t.users, t.business, t.tips, 2024)
    res = MD.train(pf, MD.GBTParams(max_iter=2, patience=0, step_size=0.3, max_depth=3))
    us, bs = scoring.prepare_sides(spark, t.users, t.business, t.tips, 2024, os.path.join(tmp_dir, "sides"))
    src = os.path.join(tmp_dir, "requests")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("user_id,business_id\n1,2\n5,x9\n")
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("user_id,business_id\n99999,3\n")
    sink = os.path.join(tmp_dir, "sink")
    ckpt = os.path.join(tmp_dir, "ckpt")
    q = scoring.start_scoring(spark, src, res.model, us, bs, sink, ckpt)
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == 3
    assert out.filter((F.col("prediction") < 1) | (F.col("prediction") > 5)).count() == 0
    # a restart on the same checkpoint only scores files that arrived since
    with open(os.path.join(src, "c.csv"), "w") as f:
        f.write("user_id,business_id\n2,7\n")
    q = scoring.start_scoring(spark, src, res.model, us, bs, sink, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == 4


def test_grid_search_by_halving(spark):
    df = planted(spark, n=600).withColumn("_k", F.col("business_id"))
    params = MD.GBTParams(step_size=0.3, patience=3, first_stage=4, partitions=4)
    rows = MD.grid_table(spark, MD.grid_search(df, "_k", params, depths=(1, 4), steps=(0.05, 0.3), k=2, rung=3)).collect()
    assert len(rows) == 4 and sum(r.winner for r in rows) == 1
    best = min(rows, key=lambda r: r.rmse)
    assert best.winner and (best.depth, best.step) == (4, 0.3)
    assert best.rounds > best.trees and sorted(r.rounds for r in rows)[:3] == [3, 3, 6]  # patience ended the winner alone


def test_halving_order():
    calls = []

    def grow(name, rounds):
        calls.append((name, rounds))
        return {"a": 3.0, "b": 1.0, "c": 2.0, "d": 4.0, "e": 1.0}[name]

    assert MD.successive_halving(dict.fromkeys("abcde"), grow, 5) == ["d", "a", "c", "e", "b"]
    assert calls == [(n, 5) for n in "abcde"] + [("b", 5), ("e", 5)]
    assert MD.successive_halving({"only": None}, grow, 5) == ["only"]


def test_stages_grow_one_sequence(spark):
    """Each round is grown once, the trees of the stages add up, and the errors are those of the joined model."""
    df = planted(spark, n=800)
    p = MD.GBTParams(step_size=0.3, max_depth=3, patience=4, first_stage=5, max_iter=12, partitions=4)
    prepared = MD.Prepared(MD.training_table(df, FE.FEATURES, p), p, FE.FEATURES)
    b = prepared.boosting(p)
    b.grow_to_the_end()
    assert b.grown == len(b.errors) <= 12 and len(b.models) > 1
    whole = MD.joined_trees(b.models, b.grown)
    errors = whole.evaluateEachIteration(prepared.validation.withColumnRenamed("rating", "label"), "squared")
    assert np.allclose(errors, b.errors, rtol=1e-6)
    assert len(b.model().trees) == b.best


def test_category_embedding_vectors(spark):
    from ratewise.plans import embedding as EM
    t = Tables(spark, SF_SMALL)
    rows = EM.category_embedding(t.business, size=4).collect()
    assert len(rows) == t.business.count()
    assert all(len(r.embedding) == 4 for r in rows)


def test_synonyms_are_neighbours(spark):
    """'Pub' and 'Bar' are never listed together, but go with the same categories."""
    from ratewise.plans import embedding as EM
    rng = np.random.default_rng(5)
    worlds = [["Beer", "Nightlife", "Darts"], ["Pasta", "Wine", "Pizza"], ["Yoga", "Pilates", "Spa"]]
    heads = [("Pub", "Bar"), ("Trattoria", "Osteria"), ("Studio", "Gym")]
    rows = []
    for k in range(600):
        w = int(rng.integers(3))
        cats = [heads[w][int(rng.integers(2))], *rng.choice(worlds[w], 2, replace=False)]
        rows.append((f"b{k}", ", ".join(cats)))
    rows += [("none", None), ("lone", "Alone")]
    df = spark.createDataFrame(rows, "business_id string, categories string")
    v = {r.category: np.array(r.vector) for r in EM.category_vectors(df, 6).collect()}
    near = lambda a: max((c for c in v if c != a and any(v[c])), key=lambda c: v[a] @ v[c] / np.linalg.norm(v[a]) / np.linalg.norm(v[c]))
    assert all(near(a) == b and near(b) == a for a, b in heads)
    emb = {r.business_id: r.embedding for r in EM.category_embedding(df, 6).collect()}
    assert len(emb) == 602 and not any(emb["none"]) and any(emb["lone"])
    assert EM.category_embedding(spark.createDataFrame([], df.schema), 6).collect() == []


def test_many_training_rows_get_partitions_by_the_root():
    p = MD.GBTParams()
    assert [MD.n_partitions(k << 16, p) for k in (0, 1, 8, 64, 256, 6400)] == [1, 1, 8, 64, 128, 640]
    assert MD.n_partitions(1 << 40, MD.GBTParams(partitions=3)) == 3


def test_vectors_do_not_take_the_memory_of_the_trees(spark):
    p = MD.GBTParams()
    prepared = MD.Prepared(MD.training_table(planted(spark, n=50), FE.FEATURES, p), p, FE.FEATURES)
    try:
        assert all(df.storageLevel.useDisk and not df.storageLevel.useMemory for df in (prepared.fit, prepared.validation))
    finally:
        prepared.close()
