"""Removal of long repeated byte strings by blockwise suffix sorting with a difference cover (operator 4).

A string of ``length`` bytes that starts at two places is removed wherever it stands, within one text or across texts.
A difference cover D of v residues has, for any two positions, one shift below v that brings both onto residues of D. So
if two suffixes agree for ``sample + v - 1`` bytes, some pair of sampled positions (residue in D, at the same shift) agrees
for ``sample`` bytes. The sampled positions are named by those bytes first, and names that
occur twice are the ranks by which a suffix can tie at all: only suffixes with such a sample within their next v bytes
are sorted. They are dealt into buckets by their first ``length`` bytes' fingerprint, and one bucket at a time is
sorted; neighbours that are equal are repeats. The text cannot be looked up from inside a bucket of a distributed sort,
so a long tie is settled by the 64-bit fingerprint of the ``length`` bytes instead of by comparing on at the samples.
The samples also tell of shorter repeats: every string of ``sample + v - 1`` bytes that stands twice holds a tied sample.

Texts are packed into units of ``unit_bytes`` and written once, bucketed by unit, so that no later step shuffles text.
Per step and unit only sorted distinct keys travel (8 bytes a sample and a suffix that can tie) and one bit per
key comes back. Units and buckets grow with the root of the input, so that their pairs grow with the input, not its
square. Copies of a whole text are taken out first by their digest, so the largest group of copies costs one text.

Defined cases: null text is the empty text; matches never cross texts; results depend on the text alone, so repeated
rows, null or repeated ids each give one row; an empty table gives an empty result; extra columns are ignored. Memory
in a task follows the unit, or the longest single text if that is larger.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.scratch import new_path, written

LENGTH = 400
#: Prime whose perfect difference cover is used: q + 1 of q * q + q + 1 residues. With samples of 94 bytes, every
#: repeat of 276 bytes (some 50 words) has a tied sample.
COVER = 13
SAMPLE = 94
#: Bytes of text that one task works on at a time, and bytes of text per bucket of the sort, at least; see :func:`grown`.
UNIT_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
ROW_BYTES = 1 << 20
#: Up to so many units or buckets are numbered by their hash.
SPREAD = 20_000
SEGMENT = 1 << 19
BASE = 0x9E3779B97F4A7C15
EMPTY_SHA256 = hashlib.sha256().hexdigest()
SKIP, NAMES, SUFFIXES = 0, 1, 2
REPLY = "unit bigint, kind int, bucket bigint, bits binary"


@lru_cache
def difference_cover(q: int = COVER) -> tuple[int, tuple[int, ...]]:
    """v and residues D such that every difference modulo v = q*q + q + 1 occurs in D (q prime): zeros of a linear
    recurrence of order three modulo q, taken when they form a cover."""
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, y, z, zeros = 0, 0, 1, []
                for n in range(v):
                    if not x:
                        zeros.append(n)
                    x, y, z = y, z, (a * z + b * y + c * x) % q
                if len(zeros) == q + 1 and len({(s - t) % v for s in zeros for t in zeros}) == v:
                    return v, tuple(zeros)
    raise ValueError(f"{q} is not a prime")


@lru_cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** k and its inverse modulo 2 ** 64, for k below n."""
    with np.errstate(over="ignore"):
        return tuple(np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)])
                     for b in (BASE, pow(BASE, -1, 1 << 64)))


class Texts:
    """Concatenated texts with, for every byte, its offset in its text and the bytes left in it."""

    def __init__(self, data: bytes, lens: np.ndarray):
        self.buf, self.lens = np.frombuffer(data, np.uint8), lens
        self.starts = np.cumsum(lens) - lens
        self.offset = np.arange(len(self.buf), dtype=np.int32) - np.repeat(self.starts.astype(np.int32), lens)
        self.room = np.repeat(lens.astype(np.int32), lens) - self.offset

    def fingerprints(self, at: np.ndarray, length: int) -> np.ndarray:
        """64-bit fingerprints of the ``length`` bytes from each of the ascending positions ``at``."""
        out, power, inverse = np.empty(len(at), np.uint64), *powers(SEGMENT + length)
        cuts = np.searchsorted(at, np.arange(0, len(self.buf) + SEGMENT, SEGMENT))
        for k in range(len(cuts) - 1):
            lo, hi = cuts[k], cuts[k + 1]
            if lo == hi:
                continue
            piece = self.buf[k * SEGMENT:(k + 1) * SEGMENT + length].astype(np.uint64) + np.uint64(1)
            total = np.r_[np.uint64(0), np.cumsum(piece * power[:len(piece)], dtype=np.uint64)]
            i = at[lo:hi] - k * SEGMENT
            out[lo:hi] = (total[i + length] - total[i]) * inverse[i]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0x94D049BB133111EB)
        return out ^ (out >> np.uint64(32))


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Range of the key's upper half: ascending with the key."""
    return (key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def grown(least: int, total_bytes: int) -> int:
    """Bytes of a unit or bucket: ``least``, or for inputs above 64 GB the root of 1 KB times the input (320 MB at 100 TB)."""
    return max(least, int((total_bytes << 10) ** 0.5) * least // UNIT_BYTES)


class Unit:
    """The rows of one unit with the copies of texts in other units left out, and what the buckets replied."""

    def __init__(self, rows: pa.Table, replies: pa.Table, length: int, sample: int, bucket_keys: np.ndarray, q: int):
        self.length, self.sample, self.bucket_keys, self.buckets = length, sample, bucket_keys, len(bucket_keys)
        self.v, self.cover = difference_cover(q)
        self.replies, out = {NAMES: {}, SUFFIXES: {}}, set()
        for kind, bucket, bits in zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "bits"))):
            if kind == SKIP:
                out.add(bits)
            else:
                self.replies[kind][bucket] = bits
        self.rows = []  # each text once
        for data, lens, digests in zip(*(rows.column(c) for c in ("data", "lens", "digests"))):
            data, lens, digests = data.as_buffer(), np.frombuffer(lens.as_buffer(), np.int64), digests.as_py()
            digests = [digests[k:k + 32] for k in range(0, len(digests), 32)]
            keep = np.array([not (d in out or out.add(d)) for d in digests])
            if not keep.all():
                view, starts = memoryview(data), np.cumsum(lens) - lens
                data = b"".join(view[s:s + n] for s, n, k in zip(starts, lens, keep) if k)
                lens, digests = lens[keep], [d for d, k in zip(digests, keep) if k]
            self.rows.append((data, lens, digests))

    def texts(self) -> Iterator[tuple[Texts, list[bytes]]]:
        for data, lens, digests in self.rows:
            yield Texts(data, lens), digests

    def samples(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the cover sample and their names, the fingerprints of ``sample`` bytes."""
        residue = np.zeros(self.v, bool)
        residue[list(self.cover)] = True
        at = np.flatnonzero(residue[t.offset % self.v] & (t.room >= self.sample))
        return at, t.fingerprints(at, self.sample)

    def known(self, keys: list[np.ndarray], kind: int) -> np.ndarray:
        """Sorted keys that occur twice in the unit or in another unit as well."""
        distinct, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.empty(0, np.uint64), np.empty(0, int))
        twice = n > 1
        for bucket, lo, hi in self.ranges(distinct):
            if bits := self.replies[kind].get(bucket):
                twice[lo:hi] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
        return distinct[twice]

    def ranges(self, distinct: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """bucket, first and end of its keys, of the buckets that ``distinct``, in ascending order, has keys of."""
        of = bucket_of(distinct, self.buckets)
        first = np.flatnonzero(np.r_[len(of) > 0, of[1:] != of[:-1]])
        yield from zip(of[first].tolist(), first.tolist(), [*first[1:].tolist(), len(of)])

    def packed(self, keys: list[np.ndarray], unit: int) -> pa.Table:
        """One row per bucket with the distinct keys in ascending order."""
        distinct = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.uint64)
        used = list(self.ranges(distinct))
        at = [b for b, _, _ in used]
        return pa.table({"key": pa.array(self.bucket_keys[at] if at else [], pa.int64()), "bucket": pa.array(at, pa.int64()), "unit": pa.array([unit] * len(used), pa.int64()),
                         "keys": pa.array([distinct[lo:hi].tobytes() for _, lo, hi in used], pa.binary())})

    def tying(self) -> Iterator[tuple[Texts, list[bytes], np.ndarray, np.ndarray]]:
        """Texts, their digests, their tied samples (with a repeated name) and the positions that can tie: a tied sample stands
        within their next v bytes, and ``length`` bytes are left."""
        samples = [self.samples(t) for t, _ in self.texts()]
        names = self.known([name for _, name in samples], NAMES)
        for (t, digests), (at, name) in zip(self.texts(), samples):
            tied = at[isin_sorted(name, names)]
            yield t, digests, tied, self.near(t, tied)

    def near(self, t: Texts, at: np.ndarray) -> np.ndarray:
        """Positions with one of the samples ``at`` within their next v bytes and ``length`` bytes left."""
        if not len(at):
            return at
        change = np.zeros(len(t.buf) + 1, np.int32)
        np.add.at(change, at - np.minimum(t.offset[at], self.v - 1), 1)
        change[at + 1] -= 1
        return np.flatnonzero((np.cumsum(change[:-1]) > 0) & (t.room >= self.length))

    def longest_ties(self, t: Texts, tied: np.ndarray) -> np.ndarray:
        """For each text the longest stretch from a tied sample to the end of another, next ones being v bytes apart at most."""
        longest = np.zeros(len(t.lens), np.int64)
        if len(tied):
            text = np.searchsorted(t.starts, tied, "right") - 1
            new = np.r_[True, (text[1:] != text[:-1]) | (np.diff(tied) > self.v)]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(tied)] - 1
            np.maximum.at(longest, text[first], tied[last] - tied[first] + self.sample)
        return longest


def isin_sorted(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def repeated_keys(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of one bucket: the sorted keys that more than one unit sent, and each unit's keys."""
    sent = [np.frombuffer(k.as_buffer(), np.uint64) for k in table.column("keys")]
    everything = np.sort(np.concatenate(sent))
    return np.unique(everything[1:][everything[1:] == everything[:-1]]), sent


def sort_bucket(keys: DataFrame, kind: int) -> DataFrame:
    """Sort one bucket at a time; for every unit a bit per key that it sent: does another unit have it?"""
    def run(table: pa.Table) -> pa.Table:
        repeated, sent = repeated_keys(table)
        bits = [np.packbits(isin_sorted(k, repeated)).tobytes() for k in sent]
        return pa.table({"unit": table.column("unit"), "kind": pa.array([kind] * len(bits), pa.int32()),
                         "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})

    return keys.groupBy("key").applyInArrow(run, REPLY)


def spread_keys(spark, n: int) -> np.ndarray:
    """n numbers that fill n partitions (or a divisor of n) evenly: up to ``SPREAD`` ones whose hashes differ modulo n, above that,
    where chance deals evenly enough, just 0 to n - 1."""
    if n > SPREAD:
        return np.arange(n)
    ids = spark.range(64 * n + 64).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("b"))
    return np.array([r[0] for r in ids.groupBy("b").agg(F.min("id").alias("id")).select("id").orderBy("id").collect()], np.int64)


def pack(docs: DataFrame, text_col: str, numbers: np.ndarray, unit_bytes: int) -> DataFrame:
    """unit, data, lens, digests: texts joined into rows of about ROW_BYTES, without copies within a unit."""
    row_bytes = min(ROW_BYTES, unit_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, unit, filled, seen, texts, digests = TaskContext.get().partitionId(), 0, 0, set(), [], []

        def row():
            return pa.RecordBatch.from_arrays([
                pa.array([numbers[(first + unit) % len(numbers)]], pa.int64()), pa.array([b"".join(texts)], pa.binary()),
                pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()),
                pa.array([b"".join(digests)], pa.binary())], ["unit", "data", "lens", "digests"])

        # Tasks begin evenly spread (multiples of the golden ratio) and go on from there.
        first, size = int(task * 0.6180339887498949 % 1 * len(numbers)), 0
        for batch in batches:
            for text in batch.column(0):
                text = (text.as_py() or "").encode("utf-8", "surrogatepass")
                digest = hashlib.sha256(text).digest()
                if digest in seen:
                    continue
                if texts and size + len(text) > row_bytes:
                    yield row()
                    filled, size, texts, digests = filled + size, 0, [], []
                if filled and filled + len(text) > unit_bytes:
                    unit, filled, seen = unit + 1, 0, set()
                seen.add(digest)
                texts.append(text)
                digests.append(digest)
                size += len(text)
        if texts:
            yield row()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "unit bigint, data binary, lens binary, digests binary")


@contextmanager
def bucketed(packed: DataFrame, units: int) -> Iterator[DataFrame]:
    """``packed`` as a table bucketed by unit, in the shared folder; its name is taken out of the catalog again, come what may."""
    spark, limit = packed.sparkSession, "spark.sql.sources.bucketing.maxBuckets"
    name, before = f"packed_{uuid.uuid4().hex}", spark.conf.get(limit)
    if units > int(before):
        spark.conf.set(limit, units)
    try:
        (packed.write.bucketBy(units, "unit").option("path", new_path(spark, "packed")).option("compression", "zstd").saveAsTable(name))
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.conf.set(limit, before)


def repeats_of_texts(docs: DataFrame, text_col: str, length: int, sample: int, q: int, unit_bytes: int, bucket_bytes: int,
                     total_bytes: int) -> DataFrame:
    """digest, n_removed, n_spans, kept_sha256, tied_bytes, longest_tie of every distinct text, as far as other texts and itself
    repeat it."""
    unit_bytes, bucket_bytes = grown(unit_bytes, total_bytes), grown(bucket_bytes, total_bytes)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = max(partitions, -(-total_bytes // unit_bytes))
    buckets = partitions * max(1, -(-total_bytes // (bucket_bytes * partitions)))  # each partition of a shuffle gets as many
    spark = docs.sparkSession
    with bucketed(pack(docs, text_col, spread_keys(spark, units), unit_bytes), units) as packed:
        return repeats_of_units(packed, length, sample, q, spread_keys(spark, buckets))


def repeats_of_units(packed: DataFrame, length: int, sample: int, q: int, bucket_keys: np.ndarray) -> DataFrame:
    """The three passes over the units: names of the samples, suffixes that can tie, results."""
    # Copies in several units: all but the one in the first unit are left out.
    places = packed.select("unit", F.explode(F.transform(
        F.sequence(F.lit(0), (F.length("digests") / 32).cast("int") - 1),
        lambda k: F.substring(F.col("digests"), k * 32 + 1, F.lit(32)))).alias("digest"))
    many = places.groupBy("digest").agg(F.min("unit").alias("first"), F.count("*").alias("n")).where("n > 1")
    skip = places.join(many, "digest").where("unit <> first").select(
        "unit", F.lit(SKIP).alias("kind"), F.lit(0).cast("bigint").alias("bucket"), F.col("digest").alias("bits"))
    replies = written(skip, "skip")

    def per_unit(run, schema: str) -> DataFrame:
        def whole(key, rows: pa.Table, answers: pa.Table) -> pa.Table:
            return run(Unit(rows, answers, length, sample, bucket_keys, q), key[0].as_py())
        return packed.groupBy("unit").cogroup(replies.groupBy("unit")).applyInArrow(whole, schema)

    keys_schema = "key bigint, bucket bigint, unit bigint, keys binary"

    def names(u: Unit, unit: int) -> pa.Table:
        return u.packed([u.samples(t)[1] for t, _ in u.texts()], unit)

    replies = replies.unionByName(written(sort_bucket(per_unit(names, keys_schema), NAMES), "name-replies"))

    def suffixes(u: Unit, unit: int) -> pa.Table:
        return u.packed([t.fingerprints(at, length) for t, _, _, at in u.tying()], unit)

    replies = replies.unionByName(written(sort_bucket(per_unit(suffixes, keys_schema), SUFFIXES), "suffix-replies"))

    schema = pa.schema([("digest", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("tied_bytes", pa.int64()), ("longest_tie", pa.int64())])

    def results(u: Unit, unit: int) -> pa.Table:
        places, keys = [], []
        for t, _, tied, at in u.tying():
            places.append((tied, at))
            keys.append(t.fingerprints(at, length))
        repeated = u.known(keys, SUFFIXES)
        out = []
        for (t, digests), (tied, at), k in zip(u.texts(), places, keys):
            gone, held, longest = covered(at[isin_sorted(k, repeated)], len(t.buf), length), covered(tied, len(t.buf), sample), u.longest_ties(t, tied)
            for d, s, n, tie in zip(digests, t.starts, t.lens, longest):
                part = gone[s:s + n]
                removed = int(part.sum())
                out.append((d, removed, int(np.count_nonzero(part[1:] & ~part[:-1]) + part[0]) if removed else 0,
                            hashlib.sha256(t.buf[s:s + n][~part].tobytes()).hexdigest() if removed else d.hex(),
                            int(held[s:s + n].sum()), int(tie)))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema)

    return written(per_unit(results, "digest binary, n_removed bigint, n_spans bigint, kept_sha256 string, tied_bytes bigint, "
                                     "longest_tie bigint"), "repeats")


def covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of n bytes lie in a string of ``length`` bytes from one of ``starts``."""
    change = np.zeros(n + 1, np.int8)
    change[starts] += 1
    total = np.cumsum(change[:-1], dtype=np.int32)
    total[length:] -= total[:-length].copy() if n > length else 0
    return total > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, q: int = COVER,
                   sample: int = SAMPLE, unit_bytes: int = UNIT_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes left), tied_bytes (bytes in cover samples that occur
    elsewhere too) and longest_tie (the longest stretch between such samples), one row per document.

    The last two also tell of repeats below ``length``: one of ``sample + v - 1`` bytes or more is never without a tied sample,
    and no sample is tied without a repeat of ``sample`` bytes. A copy of a whole text ties all of it."""
    if length < difference_cover(q)[0] + sample - 1:
        raise ValueError("length must be at least the cover's modulus and a sample")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                               F.unhex(F.sha2(text, 256)).alias("digest")), "digests")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    found = repeats_of_texts(docs, text_col, length, sample, q, unit_bytes, bucket_bytes, total)
    copies = rows.groupBy("digest").agg(F.count("*").alias("n_copies"))
    # Written, so that AQE can split the rows of a text with very many copies in the join below.
    found = written(found.join(copies, "digest"), "repeats-of-texts")
    many = F.col("n_copies") > 1
    whole = many & (F.col("n_bytes") >= length)

    def tie(c: str):
        return F.when(many & (F.col("n_bytes") >= sample), F.col("n_bytes")).otherwise(F.col(c)).alias(c)

    return rows.join(found, "digest").select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.col("n_spans")).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(EMPTY_SHA256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"), tie("tied_bytes"), tie("longest_tie"))
