"""SimHash near-duplicates found with BK-trees (operator 5).

A document's fingerprint has a bit set where more than half of its word shingles' hashes have it. Distinct fingerprints
are dealt into shards so that two within the radius meet in one: the 64 bits are cut into ``radius + 1`` blocks, and two
fingerprints that differ in at most ``radius`` bits agree in a whole block. Each shard holds a BK-tree: a node's
children are keyed by their Hamming distance to it, and a search follows only edges within the radius of its own
distance. A shard's tree is built and searched where the shard lies, so no tree is sent around; all trees of a task
grow and are searched level by level together. A shard above ``max_shard`` is cut again by blocks of its other bits.

A shard gives a spanning forest of its links, not all pairs; components come from joining the forests.

Defined cases: null text counts as empty; texts without words have fingerprint zero and link like any other; shorter
texts than a shingle are one shingle; copies share a fingerprint and are searched once; rows with a null id count for
links, not for the smallest id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.components import connected_components
from ratewise.llm.scratch import written
from ratewise.llm.text import row_key

SHINGLE = 4
RADIUS = 4
SEED = 42
#: A shard with more fingerprints is cut again by its other bits, LEVELS times at most.
MAX_SHARD = 20_000
LEVELS = 3
#: Fingerprints whose trees are built together, and (query, node) pairs that a search looks at together.
CHUNK, FRONTIER = 1 << 17, 1 << 19


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles of ``text``, A-Z lower-cased."""
    import xxhash
    hash64 = xxhash.xxh64_intdigest
    ws = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(ws)
    if not n:
        return 0
    flat = b" ".join(ws)
    if n <= shingle:
        return hash64(flat, SEED)
    starts = list(accumulate((len(w) + 1 for w in ws), initial=0))
    total, counts = n - shingle + 1, np.zeros(64, np.int64)
    for at in range(0, total, 1 << 16):
        to = min(total, at + (1 << 16))
        h = np.array([hash64(flat[s:e - 1], SEED) for s, e in zip(starts[at:to], starts[at + shingle:to + shingle])], np.uint64)
        counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed bigint), one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py() or "", shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


def cut(mask: int, parts: int) -> list[int]:
    """The set bits of ``mask`` in ``parts`` disjoint masks of nearly equal size."""
    bits = [b for b in range(64) if mask >> b & 1]
    return [sum(1 << b for b in bits[len(bits) * k // parts:len(bits) * (k + 1) // parts]) for k in range(parts)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shards(fps: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """key, fp: every two fingerprints of ``fps`` within ``radius`` bits share a key. ``fps`` are distinct."""
    def dealt(df: DataFrame, free: list[int], key: Column) -> DataFrame:
        """Each row once per block of its free bits; ``_free`` is what the block leaves."""
        blocks = F.when(F.lit(False), F.array().cast("array<struct<m:bigint,free:bigint>>"))
        for f in free:
            blocks = blocks.when(F.col("_free") == signed(f), F.array(*[
                F.struct(F.lit(signed(m)).alias("m"), F.lit(signed(f & ~m)).alias("free")) for m in cut(f, radius + 1)]))
        return df.select("fp", key.alias("_key"), F.explode(blocks).alias("b")).select(
            F.xxhash64("_key", "b.m", F.col("fp").bitwiseAND(F.col("b.m"))).alias("key"), "fp", F.col("b.free").alias("_free"))

    free = [(1 << 64) - 1]
    level = dealt(fps.withColumn("_free", F.lit(signed(free[0]))), free, F.lit(0))
    done = []
    for _ in range(LEVELS - 1):
        free = sorted({f & ~m for f in free for m in cut(f, radius + 1)})
        counts = written(level.groupBy("key").count().where(F.col("count") > max_shard).select("key"), "hot-shards")
        if counts.isEmpty():
            break
        done.append(level.join(counts, "key", "left_anti").select("key", "fp"))
        level = dealt(level.join(counts, "key", "left_semi"), free, F.col("key"))
    out = level.select("key", "fp")
    for d in done:
        out = out.unionByName(d)
    return out


class Forest:
    """BK-trees over ``fp``; ``tree`` says which tree an entry belongs to and is sorted."""

    def __init__(self, fp: np.ndarray, tree: np.ndarray):
        self.fp = fp
        first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
        self.root = np.repeat(first, np.diff(np.r_[first, len(fp)]))
        rest = np.flatnonzero(self.root != np.arange(len(fp)))
        at = self.root[rest]
        keys, children = [], []
        while len(rest):
            key = at * 65 + np.bitwise_count(fp[rest] ^ fp[at])
            order = np.argsort(key, kind="stable")
            rest, key = rest[order], key[order]
            new = np.r_[True, key[1:] != key[:-1]]
            keys.append(key[new])
            children.append(rest[new])
            at = np.repeat(rest[new], np.diff(np.r_[np.flatnonzero(new), len(rest)]))[~new]
            rest = rest[~new]
        key = np.concatenate(keys) if keys else np.empty(0, np.int64)
        order = np.argsort(key)
        self.key, self.child = key[order], (np.concatenate(children) if children else np.empty(0, np.int64))[order]

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) arrays of entries within ``radius`` of each other."""
        stack = [(queries[k:k + FRONTIER], self.root[queries[k:k + FRONTIER]]) for k in range(0, len(queries), FRONTIER)]
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                stack += [(q[:len(q) // 2], node[:len(q) // 2]), (q[len(q) // 2:], node[len(q) // 2:])]
                continue
            d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
            hit = (d <= radius) & (q != node)
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
            n = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), "right") - lo
            if total := int(n.sum()):
                step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                stack.append((np.repeat(q, n), self.child[np.repeat(lo, n) + step]))


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the sets of a and b in ``root`` (each entry points at the smallest of its set)."""
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def spanning_links(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    forest, root = Forest(fp.view(np.uint64), key), np.arange(len(fp))
    for q, node in forest.search(np.arange(len(fp)), radius):
        join_roots(root, q, node)
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[linked], fp[root[linked]]


def links(sharded: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: spanning forests of the links inside each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(key, fp):
            a, b = spanning_links(key, fp, radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        key, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            key = np.r_[key, batch.column(0).to_numpy(zero_copy_only=False)]
            fp = np.r_[fp, batch.column(1).to_numpy(zero_copy_only=False)]
            if len(key) >= CHUNK:
                whole = np.searchsorted(key, key[-1])  # the last shard may go on in the next batch
                if whole:
                    yield found(key[:whole], fp[:whole])
                    key, fp = key[whole:], fp[whole:]
        if len(key):
            yield found(key, fp)

    n = int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sharded.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable), one row per document."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = connected_components(links(shards(nodes.select("fp"), radius, max_shard), radius), "a", "b")
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = placed.where("root <> fp").select("fp", "root").join(ids, "root").select("fp", "component_id").unionByName(
        ids.select(F.col("root").alias("fp"), "component_id"))
    return rows.join(label, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` of each component: the one with the smallest id (null first), and of copies under one id one.

    Every row belongs to a component, so documents without near-duplicates stay.
    """
    key = row_key(id_col, text_col)
    ids = docs.select(F.struct(F.col(id_col).alias("id"), key.alias("key")).alias("doc_id"), F.col(text_col).alias("text"))
    kept = near_duplicates(ids, **options).where("doc_id = component_id").select(F.col("doc_id.key").alias("_key")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_key"))
    return rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
