"""The batch train-and-predict job, as one spark-submit entry.

    spark-submit ratewise/plans/job.py FOLDER TEST_CSV OUTPUT [--save_model PATH]
                 [--train_file NAME]

FOLDER holds the training reviews CSV (``--train_file``, default ``train.csv``),
``user.json``, ``business.json`` and optionally ``tip.json``. Everything from the scans to the written predictions runs on
executors; only the one-row statistics, the fitted min/max row and the
validation error per tree reach the driver.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

if __name__ == "__main__":  # launched as a file by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ratewise.operators import features as FE
from ratewise.plans import model as MD
from ratewise.plans.memo import stored
from ratewise.sources import readers, writers


def run(spark: SparkSession, folder: str, test_path: str, output_path: str,
        model_path: str | None = None, as_of_year: int | None = None,
        params: MD.GBTParams | None = None, train_file: str = "train.csv") -> dict:
    t0 = time.time()
    year = as_of_year or time.gmtime().tm_year
    train_rows = readers.read_reviews_csv(spark, f"{folder}/{train_file}")
    users = readers.read_users(spark, f"{folder}/user.json")
    business = readers.read_business(spark, f"{folder}/business.json")
    tips = readers.read_tips(spark, f"{folder}/tip.json")
    pairs = readers.read_pairs_csv(spark, test_path)

    # the per-user and per-business feature sides are written once into the shared
    # checkpoint folder and read for training and for scoring
    us, bs = (stored(df, "side") for df in (FE.user_side(users, tips, year), FE.business_side(business, tips, year)))
    labelled = train_rows.select("user_id", "business_id", F.col("stars").cast("double").alias("rating"))
    feats = FE.attach_sides(labelled, us, bs)
    result = MD.train(feats, params or MD.GBTParams())
    if model_path:
        MD.save(result.model, model_path)
    test_feats = FE.attach_sides(pairs.select("user_id", "business_id"), us, bs)
    writers.write_predictions(MD.predict(result.model, test_feats), output_path)
    return {"trees": result.n_trees, "seconds": round(time.time() - t0, 2)}


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(description="Train the rating model and score test pairs")
    ap.add_argument("folder_path")
    ap.add_argument("test_path")
    ap.add_argument("output_path")
    ap.add_argument("--save_model", default=None)
    ap.add_argument("--as_of_year", type=int, default=None)
    ap.add_argument("--max_iter", type=int, default=2000)
    ap.add_argument("--patience", type=int, default=50)
    ap.add_argument("--train_file", default="train.csv")
    a = ap.parse_args(argv)
    from ratewise.session import build_session
    spark = build_session(app_name="ratewise-job")
    try:
        info = run(spark, a.folder_path, a.test_path, a.output_path, a.save_model, a.as_of_year,
                   MD.GBTParams(max_iter=a.max_iter, patience=a.patience), a.train_file)
        print(json.dumps(info))
        return info
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
