"""Exact top-k search by pivot-table elimination (operator 11).

Components become integers; the score of two vectors is their inner product. Every vector's distances to ``PIVOTS`` pivots are
stored. By the triangle inequality the distance of a query and a candidate is at least the largest difference of their
distances to a pivot, and a distance of at least ``d`` bounds the score by ``(|q|^2 + |x|^2 - d^2) / 2``. Candidates are
evaluated from the highest bound down, until the next bound is under the k-th score found, so the result is exact.

The vectors are dealt into cells by their nearest pivot. A table of cell sizes, largest norms and distance ranges, whose size
depends on the number of pivots only, tells which cells a query must see. A query first sees the cell of its highest bound;
the k-th score found there closes most other cells where the data have structure. A cell is cut into blocks of about
``BLOCK`` vectors and its queries into groups of about ``GROUP``, so a task holds one block and one group, however large a
cell is. Pivots are chosen in a sample of ``SAMPLE`` vectors, each the farthest from those before; any pivots give the same
result.

Defined cases: vectors that are null or hold a null or non-finite component take no part; a shorter vector counts as ended by
zeros; rows are told apart even if their ids are equal, so a repeated query row gives its own result and its copies are
candidates; candidates without an id come last among ties; rows without an id are no queries; an empty table gives an empty
result; extra columns are ignored. Scores are computed exactly; a component of 2^31 or more after scaling is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.llm.scratch import written

# The scale of the components, how many results a query has, and which ids are queries.
SCALE, K, QUERY_STEP = 256, 5, 50
#: Pivots, and the vectors among which they are chosen.
PIVOTS, SAMPLE = 32, 1024
#: Vectors of a block, queries of a group, and candidates first evaluated.
BLOCK, GROUP, FIRST = 8192, 1024, 256
#: Distances are stored in single precision: their rounding, twice over, and that of the bound.
ROUNDING, SLACK = 4e-7, 1e-6
#: The reach of a query without a k-th score.
NO_REACH = -(1 << 62)


def matrix(vectors: pa.ListArray, dim: int) -> np.ndarray:
    """The integer vectors as rows of a float64 matrix, ended by zeros."""
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(values) and np.abs(values).max() >= 2.0 ** 31:
        raise ValueError("a component of 2^31 or more after scaling")
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dim).all():
        return values.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def list_rows(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as int64: in float64 while that is exact, else in whole numbers."""
    largest = (np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0)) * max(1, queries.shape[-1])
    if largest < 2.0 ** 53:
        return (candidates @ queries).astype(np.int64)
    return (candidates.astype(np.int64).astype(object) @ queries.astype(np.int64).astype(object)).astype(np.int64)


def farthest(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``sample``, or all distinct ones if fewer, each the farthest from those before it."""
    chosen = [0]
    d = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < n and d.max() > 0:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def score_bound(lower: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """The highest score at a distance of ``lower`` or more, ``norms`` being the sum of the two squared norms."""
    return (norms - lower * lower) / 2 + SLACK * (norms + 1)


def best_of(score: np.ndarray, vec_id: np.ndarray, no_id: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: highest score, then smallest id (none last), then row."""
    return np.lexsort((row, vec_id, no_id, -score))[:k]


@dataclass
class Cells:
    """What is known of each cell: vectors, largest squared norm, least and largest distance to each pivot."""
    size: np.ndarray
    norm: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    def bounds(self, distances: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """The highest score that each query (row) may have in each cell; -inf in an empty one."""
        out = np.full((len(norm), len(self.size)), -np.inf)
        for c in np.flatnonzero(self.size):
            gap = np.maximum(self.lo[c] - distances, distances - self.hi[c]) - ROUNDING * (distances + self.hi[c])
            out[:, c] = score_bound(np.maximum(gap, 0).max(axis=1), norm + self.norm[c])
        return out


class PivotIndex:
    """Vectors with their pivot distances, written, and the table of their cells."""

    def __init__(self, vectors: DataFrame, id_col: str, vector_col: str, pivots: int = PIVOTS, sample: int = SAMPLE,
                 block: int = BLOCK, group: int = GROUP):
        self.block, self.group = block, group
        v = F.col(vector_col)
        rows = written(vectors.where(v.isNotNull() & F.forall(v, usable)).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"), v.alias("vector")), "vectors")
        self.dim = rows.agg(F.max(F.size("vector"))).first()[0]
        self.empty = self.dim is None
        if self.empty:
            return
        taken = rows.orderBy(F.xxhash64("vector")).limit(sample).select("vector").toArrow()["vector"]
        chosen = farthest(matrix(pa.concat_arrays(taken.chunks), self.dim), pivots)
        self.rows = written(with_distances(rows, chosen, self.dim), "pivot-table")
        n = len(chosen)
        self.cells = Cells(np.zeros(n, np.int64), np.zeros(n), np.zeros((n, n)), np.zeros((n, n)))
        of = self.rows.groupBy("cell").agg(
            F.count("*").alias("size"), F.max("norm").alias("norm"),
            F.array(*[F.min(F.col("distances")[p]) for p in range(n)]).alias("lo"),
            F.array(*[F.max(F.col("distances")[p]) for p in range(n)]).alias("hi"))
        for c in of.collect():  # at most a row for each pivot
            for part in ("size", "norm", "lo", "hi"):
                getattr(self.cells, part)[c.cell] = c[part]

    def probes(self, queries: DataFrame, first: bool) -> DataFrame:
        """cell and the columns of each query: its first cell, or all others whose bound reaches ``reach``, its k-th score so far."""
        cells, width = self.cells, len(self.cells.size)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bounds = cells.bounds(list_rows(batch.column("distances"), width).astype(np.float64),
                                   batch.column("norm").to_numpy(zero_copy_only=False))
                home = np.zeros(bounds.shape, bool)
                home[np.arange(len(bounds)), bounds.argmax(axis=1)] = True
                reach = batch.column("reach").fill_null(NO_REACH).to_numpy(zero_copy_only=False)
                q, cell = np.nonzero(home if first else ~home & (bounds >= reach[:, None]) & np.isfinite(bounds))
                out = batch.take(pa.array(q))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *out.columns], ["cell", *out.schema.names])

        rows = queries.select("row", "vec_id", "vector", "norm", "distances", "reach")
        return rows.mapInArrow(run, T.StructType([T.StructField("cell", T.IntegerType()), *rows.schema.fields]))

    def search(self, probes: DataFrame, k: int) -> DataFrame:
        """q_row, query_id, vec_id, row, score: of each block and group of queries, the ``k`` best of each query."""
        probes = written(probes, "probes")
        asked = np.zeros(len(self.cells.size), np.int64)
        for r in probes.groupBy("cell").count().collect():  # at most a row for each pivot
            asked[r["cell"]] = r["count"]
        blocks, groups = -(-self.cells.size // self.block), -(-asked // self.group)

        def of_cell(counts: np.ndarray) -> Column:
            return F.element_at(F.array(*[F.lit(int(max(1, n))) for n in counts]), F.col("cell") + 1)

        def dealt(n: Column) -> Column:
            return F.pmod(F.xxhash64("row"), n).cast("int")

        def each(n: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), n - 1))

        seen = self.rows.where(F.array_contains(F.array(*[F.lit(int(c)) for c in np.flatnonzero(asked)] or [F.lit(-1)]), F.col("cell")))
        left = seen.select("cell", dealt(of_cell(blocks)).alias("block"), each(of_cell(groups)).alias("part"), "row", "vec_id",
                           "vector", "norm", "distances")
        right = probes.select("cell", each(of_cell(blocks)).alias("block"), dealt(of_cell(groups)).alias("part"), "row", "vec_id",
                              "vector", "norm", "distances", "reach")
        dim, width = self.dim, len(self.cells.size)

        def run(block: pa.Table, asking: pa.Table) -> pa.Table:
            return search_block(block, asking, dim, width, k)

        keys = ("cell", "block", "part")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            run, "q_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint")


def usable(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def with_distances(rows: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """``rows`` with squared norm, distances to the pivots, and the nearest pivot as cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), dim)
            d = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(x) else np.empty((0, len(pivots)))
            flat = pa.array(d.astype(np.float32).ravel(), pa.float32())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pivots)), flat)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array((x * x).sum(axis=1)), lists, pa.array(d.argmin(axis=1).astype(np.int32))],
                [*batch.schema.names, "norm", "distances", "cell"])

    added = [T.StructField("norm", T.DoubleType()), T.StructField("distances", T.ArrayType(T.FloatType())), T.StructField("cell", T.IntegerType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))


def search_block(block: pa.Table, asking: pa.Table, dim: int, width: int, k: int) -> pa.Table:
    """The ``k`` best of one block for each of a group of queries, none under the query's reach."""
    found: list[tuple[np.ndarray, ...]] = []
    if block.num_rows and asking.num_rows:
        def column(t: pa.Table, name: str) -> pa.Array:
            return pa.concat_arrays(t[name].chunks)

        x, q = matrix(column(block, "vector"), dim), matrix(column(asking, "vector"), dim)
        dx = np.ascontiguousarray(list_rows(column(block, "distances"), width).T)
        dq = list_rows(column(asking, "distances"), width)
        xn, qn = block["norm"].to_numpy(), asking["norm"].to_numpy()
        no_id = column(block, "vec_id").is_null().to_numpy(zero_copy_only=False)
        vec_id, row = column(block, "vec_id").fill_null(0).to_numpy(zero_copy_only=False), block["row"].to_numpy()
        q_id, q_row = asking["vec_id"].to_numpy(), asking["row"].to_numpy()
        reach = column(asking, "reach").fill_null(NO_REACH).to_numpy(zero_copy_only=False)
        for j in range(len(q)):
            lower = np.zeros(len(x), np.float32)
            for p in range(width):
                np.maximum(lower, np.abs(dx[p] - dq[j, p]) - np.float32(ROUNDING) * (dx[p] + dq[j, p]), out=lower)
            bound = score_bound(lower.astype(np.float64), xn + qn[j])
            open_ = np.flatnonzero((bound >= reach[j]) & (row != q_row[j]))
            open_ = open_[np.argsort(-bound[open_], kind="stable")]
            best, score, at, step = np.empty(0, np.int64), np.empty(0, np.int64), 0, FIRST
            least = reach[j]
            while at < len(open_) and bound[open_[at]] >= least:
                here = open_[at:at + step]
                best = np.r_[best, here]
                score = np.r_[score, scores(q[j], x[here])]
                keep = best_of(score, vec_id[best], no_id[best], row[best], k)
                best, score = best[keep], score[keep]
                if len(score) == k:
                    least = max(least, score[-1])
                at, step = at + step, step * 2
            keep = score >= reach[j]
            best, score = best[keep], score[keep]
            found.append((np.full(len(best), q_row[j]), np.full(len(best), q_id[j]), best, row[best], score))
    names = ["q_row", "query_id", "vec_id", "row", "score"]
    if not found:
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    q_rows, q_ids, places, rows, values = (np.concatenate(c) for c in zip(*found))
    return pa.table([pa.array(q_rows, pa.int64()), pa.array(q_ids, pa.int64()), block["vec_id"].take(pa.array(places, pa.int64())),
                     pa.array(rows, pa.int64()), pa.array(values, pa.int64())], names)


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, step: int = QUERY_STEP,
          **options) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of every row whose id ``step`` divides, the ``k`` other rows of the highest score."""
    spark = vectors.sparkSession
    index = PivotIndex(vectors, id_col, vector_col, **options)
    if index.empty:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    queries = index.rows.where(F.col("vec_id") % step == 0).withColumn("reach", F.lit(None).cast("bigint"))
    near = written(index.search(index.probes(queries, first=True), k), "near-results")
    reach = near.groupBy("q_row").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    known = queries.drop("reach").join(reach, F.col("row") == F.col("q_row"), "left").withColumn(
        "reach", F.when(F.col("n") >= k, F.get("s", F.lit(k - 1))))
    rest = index.search(index.probes(known, first=False), k)
    order = Window.partitionBy("q_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return (near.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


#: DuckDB SQL of the registered query, from the contract.
ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.i, q.vec_id AS query_id, c.vec_id, c.i AS j, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.i <> c.i WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id NULLS LAST, j) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
