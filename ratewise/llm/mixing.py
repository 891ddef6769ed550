"""Mixing sources to target weights by a low-discrepancy schedule (operator 3).

Slots of equal word counts are numbered 0, 1, 2, ...; the golden-ratio point of a slot's number, looked up in the
cumulative target weights, names its source. The slots of a source are ranked, and rank r takes block r of that
source's shuffled stream of words, beginning anew when the stream ends. A source's last slot is cut at its target, and
ranks that the schedule has not reached are appended, so each source gives its target to the word.

Only per-source totals (one row per source) are gathered on the way; the slots come from a distributed range, a
source's running word count is taken in two levels (hash slices, then within a slice), and slots meet document pieces
by (source, block). The number of repeats per block is bounded by ``max_repeats``.

Defined cases: null text has size 0; a null source is a source, last in order; repeated rows are separate documents;
empty tables and sources without words give an empty schedule with taken 0; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratewise.llm.scratch import written
from ratewise.llm.text import n_words, row_key

BLOCK_WORDS = 64
MAX_REPEATS = 3
SEED = 17
SLICES = 1024
#: Fractional part of the golden ratio in units of 2**-40, so that its multiples stay exact integers.
BITS = 40
GOLDEN = round((math.sqrt(5) - 1) / 2 * 2**BITS)


def targets(sizes: list[int], weights: list[float], max_repeats: int = MAX_REPEATS) -> list[float]:
    """Words per source: weights share the total; a source stops at ``max_repeats`` times its size, the excess is
    shared again by weight among the others until none is above."""
    total, out, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        share = sum(weights[i] for i in open_)
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        over = {i for i in open_ if left * weights[i] / share > max_repeats * sizes[i]}
        for i in over or open_:
            out[i] = float(max_repeats * sizes[i]) if over else left * weights[i] / share
        open_ -= over or open_
    return out


def source_plan(rows: DataFrame, max_repeats: int) -> list[tuple]:
    """(source, size, target, quota) per source by code point, null last; weights 1, 2, 3 repeat. One row per source."""
    got = rows.groupBy("source").agg(F.sum("size").alias("n")).collect()
    got.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    goal = targets([r[1] for r in got], [k % 3 + 1 for k in range(len(got))], max_repeats)
    return [(r[0], r[1], t, min(round(t), max_repeats * r[1])) for r, t in zip(got, goal)]


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                block_words: int = BLOCK_WORDS, max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as (documents, sources, schedule).

    documents: _row, _key (of id, text and source), doc_id, source, size, _start (place in its source's shuffled stream).
    sources: source, source_size, target, quota. schedule: slot, source, epoch, _row, from_word, words - the pieces
    in the order of the mix; a slot is made of the pieces of one block.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       n_words(F.coalesce(F.col(text_col), F.lit(""))).alias("size"),
                       F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col)).alias("_order"),
                       row_key(id_col, text_col, source_col).alias("_key"), F.monotonically_increasing_id().alias("_row"))
    rows = written(rows, "mix-rows")
    plan = source_plan(rows, max_repeats)
    sources = spark.createDataFrame(plan, "source string, source_size bigint, target double, quota bigint")
    # Place of each document in its source's shuffled stream, in two levels.
    sliced = rows.withColumn("_slice", F.pmod(F.shiftright("_order", 20), F.lit(SLICES)).cast("int"))
    sums = sliced.groupBy("source", "_slice").agg(F.sum("size").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("source").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("_s"), F.col("_slice").alias("_sl"), F.coalesce(before, F.lit(0)).alias("_before"))
    inner = F.sum("size").over(W.partitionBy("source", "_slice").orderBy("_order", "doc_id", "_row")
                               .rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    placed = (sliced.withColumn("_in", inner)
              .join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_sl")))
              .withColumn("_start", F.col("_before") + F.col("_in"))
              .drop("_s", "_sl", "_slice", "_before", "_in", "_order"))
    placed = written(placed, "mix-placed")
    # Pieces of documents by the blocks of their source's stream.
    pieces = (placed.where("size > 0").select("source", "_row", "size", "_start", F.explode(F.sequence(
        F.floor(F.col("_start") / block_words), F.floor((F.col("_start") + F.col("size") - 1) / block_words))).alias("block"))
        .select("source", "block", "_row", (F.greatest(F.col("_start"), F.col("block") * block_words) - F.col("_start")).alias("from_word"),
                (F.least(F.col("_start") + F.col("size"), (F.col("block") + 1) * block_words)
                 - F.greatest(F.col("_start"), F.col("block") * block_words)).alias("words"),
                (F.greatest(F.col("_start"), F.col("block") * block_words) - F.col("block") * block_words).alias("in_block")))
    slots = schedule(spark, plan, block_words)
    s, p = slots.alias("s"), pieces.alias("p")
    mixed = (s.join(p, F.col("s.source").eqNullSafe(F.col("p.source")) & (F.col("s.block") == F.col("p.block")))
             .where(F.col("p.in_block") < F.col("s.words"))
             .select("s.slot", "s.source", "s.epoch", "p._row", "p.from_word",
                     F.least(F.col("p.words"), F.col("s.words") - F.col("p.in_block")).alias("words")))
    return placed, sources, mixed


def schedule(spark, plan: list[tuple], block_words: int) -> DataFrame:
    """slot, source, epoch, block and words (the cut of the block at the target) of every slot."""
    live = [(s, n, q) for s, n, _, q in plan if q > 0]
    if not live:
        return spark.createDataFrame([], "slot bigint, source string, epoch bigint, block bigint, words bigint")
    total = sum(q for _, _, q in live)
    per_epoch = [math.ceil(n / block_words) for _, n, _ in live]
    # A source needs all blocks of each full pass, then those up to the rest.
    need = [(q // n) * b + math.ceil(q % n / block_words) for (_, n, q), b in zip(live, per_epoch)]
    ends, run = [], 0
    for k in need:
        run += k
        ends.append(run)
    bounds = [(e << BITS) // run for e in ends]
    half = 2 ** (BITS // 2)  # the number of the slot in two halves, as a product of 80 bits would overflow
    point = F.expr(f"((id div {half}) % {half} * {GOLDEN}L % {half} * {half} + id % {half} * {GOLDEN}L) % {2**BITS}L")
    which = F.array_position(F.transform(F.array(*[F.lit(b) for b in bounds]), lambda b: F.col("_u") < b), True) - 1
    drawn = spark.range(run).select(F.col("id").alias("slot"), point.alias("_u")).select("slot", which.cast("int").alias("_k"))
    info = spark.createDataFrame([(i, s, n, q, b, m) for i, ((s, n, q), b, m) in enumerate(zip(live, per_epoch, need))],
                                 "_k int, source string, _n bigint, _q bigint, _b bigint, _need bigint")
    # Rank of a slot in its source, in two levels over runs of slots.
    run_len = max(1 << 10, math.isqrt(run))
    drawn = drawn.withColumn("_run", F.floor(F.col("slot") / run_len))
    counts = drawn.groupBy("_k", "_run").agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(W.partitionBy("_k").orderBy("_run").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select("_k", "_run", F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = (drawn.withColumn("_in", F.row_number().over(W.partitionBy("_k", "_run").orderBy("slot")))
              .join(counts, ["_k", "_run"]).select("slot", "_k", (F.col("_before") + F.col("_in") - 1).alias("rank")))
    total_drawn = drawn.groupBy("_k").agg(F.count("*").alias("_c"))
    tail = (info.join(total_drawn, "_k", "left").where("coalesce(_c, 0) < _need")
            .select("_k", F.explode(F.sequence(F.coalesce("_c", F.lit(0)), F.col("_need") - 1)).alias("rank"))
            .select((F.lit(run) + F.col("rank") * len(live) + F.col("_k")).alias("slot"), "_k", "rank"))
    full = F.floor(F.col("rank") / F.col("_b"))
    out = (ranked.unionByName(tail).join(F.broadcast(info), "_k").where("rank < _need")
           .select("slot", "source", full.alias("epoch"), (F.col("rank") - full * F.col("_b")).alias("block"), "_n", "_q"))
    left = F.when(F.col("epoch") < F.floor(F.col("_q") / F.col("_n")), F.col("_n")).otherwise(F.col("_q") % F.col("_n"))
    return out.select("slot", "source", "epoch", "block",
                      F.least(F.lit(block_words), left - F.col("block") * block_words).cast("bigint").alias("words"))


def mix_digest(docs: DataFrame, **columns) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document, from the schedule."""
    placed, sources, mixed = mix_sources(docs, **columns)
    taken = mixed.groupBy("_row").agg(F.sum("words").alias("taken"))
    s = sources.withColumnRenamed("source", "_s")
    return (placed.join(taken, "_row", "left").join(F.broadcast(s), F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix with the columns of ``docs``, each as often as the mix passes over it. Rows equal in id, text and
    source are alike: one of them stands for all, as often as the mix passes over all of them.

    A pass counts if the mix takes at least half of the document's words in it; only at a source's target is a document
    cut, so that this rounds one document per source. Documents without words are not in the mix.
    """
    placed, _, mixed = mix_sources(docs, id_col, text_col, source_col, **options)
    passes = mixed.groupBy("_row", "epoch").agg(F.sum("words").alias("taken"))
    times = (passes.join(placed.select("_row", "_key", "size"), "_row").where("taken * 2 >= size")
             .groupBy("_key").agg(F.count("*").cast("int").alias("_times")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_key(id_col, text_col, source_col).alias("_key"))
    return (rows.join(times, "_key").dropDuplicates(["_key"])
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*"))
