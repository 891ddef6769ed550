"""Operators 2 and 3 against plain versions of their methods, and rows that differ in their source only."""

import random
from collections import Counter

import pytest

from ratewise.llm import mixing, sharding

DOCS = "doc_id bigint, text string, source string"


def plain_differencing(sizes, ways):
    """Sorted shard sums of Karmarkar-Karp differencing with whole vectors: the two of largest spread are combined, the
    fullest of one with the emptiest of the other."""
    parts = [(n, k, [0] * (ways - 1) + [n]) for k, n in enumerate(sorted(sizes, reverse=True))]
    order = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-p[0], p[1]))
        (_, _, a), (_, _, b) = parts.pop(0), parts.pop(0)
        c = sorted(x + y for x, y in zip(a, reversed(b)))
        parts.append((c[-1] - c[0], order, c))
        order += 1
    return parts[0][2] if parts else [0] * ways


@pytest.mark.parametrize("seed", range(12))
def test_differencing_equals_the_plain_method(seed):
    rng = random.Random(seed)
    ways = rng.choice([2, 3, 5, 40])
    sizes = {k: rng.choice([rng.randint(1, 9), rng.randint(1, 1000), 500]) for k in range(rng.randint(1, 90))}
    got = Counter()
    for k, s in sharding.difference(sizes, ways).items():
        got[s] += sizes[k]
    assert sorted(got.values()) == [n for n in plain_differencing(list(sizes.values()), ways) if n]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shards_equal_the_plain_method(spark, seed):
    """With more lumps than documents, the shards have the sums of differencing all groups."""
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    docs = [(k, rng.choice(texts + [None]), "s") for k in range(120)]
    groups = Counter()
    for _, t, _ in docs:
        groups[t or ""] += len((t or "").encode()) + 16
    out = sharding.assign_shards(spark.createDataFrame(docs, DOCS), shards=6, lumps_per_shard=10 ** 6).collect()
    sums = Counter()
    for r in out:
        sums[r.shard] += r["size"]
    assert sorted(sums.values()) == [n for n in plain_differencing(list(groups.values()), 6) if n]


def plain_schedule(plan, block):
    """(slot, source, epoch, block, words) slot by slot: the golden-ratio point of a slot's number names its source."""
    live = [(s, n, q) for s, n, _, q in plan if q > 0]
    blocks = [-(-n // block) for _, n, _ in live]
    need = [q // n * b + -(-(q % n) // block) for (_, n, q), b in zip(live, blocks)]
    run, out, taken = sum(need), [], [0] * len(live)
    ends = [sum(need[:k + 1]) for k in range(len(need))]

    def add(slot, k):
        s, n, q = live[k]
        epoch, b = divmod(taken[k], blocks[k])
        left = n if epoch < q // n else q % n
        out.append((slot, s, epoch, b, min(block, left - b * block)))
        taken[k] += 1

    for slot in range(run):
        point = slot * mixing.GOLDEN % 2 ** mixing.BITS
        k = next(k for k, e in enumerate(ends) if point < (e << mixing.BITS) // run)
        if taken[k] < need[k]:
            add(slot, k)
    for k in range(len(live)):  # what the points have not reached comes after them
        while taken[k] < need[k]:
            add(run + taken[k] * len(live) + k, k)
    return sorted(out)


@pytest.mark.parametrize("seed", range(5))
def test_schedule_equals_the_plain_one(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 63, 64, 65, rng.randint(1, 4000)]) for _ in range(rng.randint(1, 6))]
    goals = mixing.targets(sizes, [k % 3 + 1 for k in range(len(sizes))])
    plan = [(f"s{k}", n, t, min(round(t), 3 * n)) for k, (n, t) in enumerate(zip(sizes, goals))]
    got = sorted(tuple(r) for r in mixing.schedule(spark, plan, 64).select("slot", "source", "epoch", "block", "words").collect())
    assert got == plain_schedule(plan, 64)


@pytest.mark.parametrize("seed", [1, 2])
def test_taken_words_equal_the_plain_mix(spark, seed):
    """Words of each document, from the plain schedule over the stream of its source."""
    rng = random.Random(seed)
    docs = [(k, " ".join(["w"] * rng.choice([0, 1, 7, 30, 200])), rng.choice(["a", "b", None])) for k in range(60)]
    docs += [(7, docs[7][1], docs[7][2]), (None, "w w w", "b"), (61, None, "a")]
    placed, sources, _ = mixing.mix_sources(spark.createDataFrame(docs, DOCS), block_words=16)
    stream = {}
    for r in placed.collect():
        for w in range(r["size"]):
            stream[r.source, r._start + w] = r._row
    per_source = Counter(s for s, _ in stream)
    assert all((s, w) in stream for s, n in per_source.items() for w in range(n))  # the starts leave no gap
    plan = sorted(((r.source, r.source_size, r.target, r.quota) for r in sources.collect()), key=lambda r: (r[0] is None, r[0] or ""))
    want = Counter()
    for _, s, _, b, n in sorted(plain_schedule([(x or "~", *y) for x, *y in plan], 16), key=str):
        want.update(stream[None if s == "~" else s, b * 16 + w] for w in range(n))
    out = mixing.mix_digest(spark.createDataFrame(docs, DOCS), block_words=16).collect()
    assert Counter(r.taken for r in out) == Counter([want[r._row] for r in placed.collect()])
    assert sum(r.taken for r in out) == sum(want.values())


def test_rows_that_differ_in_their_source_stay_apart(spark):
    docs = [(1, "one two three", "a"), (1, "one two three", "b")]  # targets of 2 and 4 words, so each once
    out = mixing.mixed_documents(spark.createDataFrame(docs, DOCS), block_words=2).collect()
    assert sorted((r.doc_id, r.source) for r in out) == [(1, "a"), (1, "b")]
