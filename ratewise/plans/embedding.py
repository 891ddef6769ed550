"""Category embeddings: co-occurrence counts, positive PMI and a distributed factorisation.

Categories that businesses list together are counted, a pair's weight is its positive pointwise mutual information, and ALS
factorises the weights as confidences, so categories that go with the same others lie close even if no business lists
both. The vocabulary stays a table: categories are numbered and joined, and none passes the driver.

Defined cases: a business without categories has the zero vector; a category that is never listed with another one goes with
itself, so it has a vector of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.history import category_list
from ratewise.plans.candidates import numbered
from ratewise.plans.memo import stored
from ratewise.session import checkpoint_dir


def category_pmi(business: DataFrame) -> DataFrame:
    """a, b, n (businesses that list both), ppmi: ln(n * N / (n_a * n_b)) where that is positive, N being the businesses with
    categories. Each pair is given in both directions; pairs come from one business's own list."""
    listed = business.select(category_list().alias("cats")).filter(F.size("cats") > 0)
    single = listed.select(F.explode("cats").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    pairs = (listed.select("cats", F.explode("cats").alias("a")).select("a", F.explode("cats").alias("b")).filter("a <> b")
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    total = listed.agg(F.count(F.lit(1))).scalar()
    met = (pairs.join(single.select(F.col("c").alias("a"), F.col("n").alias("n_a")), "a")
           .join(single.select(F.col("c").alias("b"), F.col("n").alias("n_b")), "b").withColumn("_all", total))
    pmi = F.ln(F.col("n") * F.col("_all") / (F.col("n_a") * F.col("n_b")))
    return met.select("a", "b", "n", pmi.alias("ppmi")).filter(F.col("ppmi") > 0)


def category_vectors(business: DataFrame, size: int = 8, seed: int = 42, iterations: int = 10, alpha: float = 10.0,
                     blocks: int = 4) -> DataFrame:
    """category, vector: the factors of the PPMI table. ``blocks`` is fixed, so that the vectors do not depend on the cluster."""
    checkpoint_dir(business.sparkSession)  # ALS cuts its lineage there
    names = stored(numbered(business.select(F.explode(category_list()).alias("category")), "category"), "categories")
    paired = category_pmi(business).select("a", "b", "ppmi")
    alone = names.join(paired.select(F.col("a").alias("category")), "category", "left_anti").select(
        F.col("category").alias("a"), F.col("category").alias("b"), F.lit(1.0).alias("ppmi"))
    rows = stored(paired.unionByName(alone)
                  .join(names.select(F.col("category").alias("a"), F.col("no").alias("row")), "a")
                  .join(names.select(F.col("category").alias("b"), F.col("no").alias("column")), "b")
                  .select("row", "column", F.col("ppmi").cast("float").alias("ppmi")), "category-pmi")
    if rows.isEmpty():
        return names.select("category", F.array().cast("array<float>").alias("vector"))
    model = ALS(rank=size, maxIter=iterations, regParam=0.05, alpha=alpha, implicitPrefs=True, seed=seed, userCol="row", itemCol="column",
                ratingCol="ppmi", numUserBlocks=blocks, numItemBlocks=blocks).fit(rows)
    return names.join(model.userFactors.select(F.col("id").alias("no"), F.col("features").alias("vector")), "no").select("category", "vector")


def category_embedding(business: DataFrame, size: int = 8, seed: int = 42, **options) -> DataFrame:
    """K5: business_id, embedding: the mean of the vectors of a business's categories."""
    vectors = category_vectors(business, size, seed, **options)
    listed = business.select("business_id", F.explode_outer(category_list()).alias("category"))
    mean = F.array(*[F.coalesce(F.avg(F.get("vector", F.lit(k)).cast("double")), F.lit(0.0)) for k in range(size)])
    return listed.join(vectors, "category", "left").groupBy("business_id").agg(mean.alias("embedding"))
