"""The corpus pipeline, stage by stage, against brute-force versions."""

import re
import unicodedata
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ratewise.llm import catalog, mixing, quality
from ratewise.llm.scratch import written
from test_llm_operators import base_counts, brute_components, brute_contamination, brute_fingerprint, ws

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), "test-stage"))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert {"doc_id", "text", "shard", "slot"} <= set(stages[-1].columns)


def test_quality_stage(stages):
    kept = {r.doc_id: r.clean_text for r in quality.line_quality(stages[0]).where("kept").collect()}
    assert dict(pairs(stages[1])) == kept and 0 < len(kept) < stages[0].count()


MENU = (r"[^a-z]*(home|menu|log ?in|log ?out|sign ?in|sign ?up|next|previous|read more|show more|share|subscribe|search|contact us|"
        r"about us|skip to content|back to top)[^a-z]*")
PHRASES = ("javascript|cookie policy|privacy policy|terms of use|terms of service|all rights reserved|lorem ipsum|click here|"
           "enable cookies")


def brute_fails(line):
    """The rules of the quality stage in plain Python."""
    t = line.strip(" \t\n\x0b\x0c\r")
    n, low = len(ws(t)), t.lower()
    if not n:
        return False
    phrase_words = sum(len(m.split()) for m in re.findall(PHRASES, low))
    return (5 * (sum(c in "#*$%&|<>" for c in t) + t.count("!!")) > n
            or 2 * sum(unicodedata.category(c) == "Lu" for c in t) > len(t) - n + 1
            or n < 5 and t[-1] not in ".!?:;…\"'”’»)]"
            or n <= 12 and (len(re.findall(" [|>»•·] ", t)) >= 2 or re.fullmatch(MENU, low) is not None)
            or phrase_words > 0 and (n <= 12 or 100 * phrase_words >= 25 * n))


def brute_clean(text):
    """The cleaned text, None if the document goes."""
    counts, lines = base_counts(text), (text or "").split("\n")
    lost = sum(len(ws(x)) for x in lines if brute_fails(x))
    if counts[0] < 50 or 100 * counts[4] > 50 * counts[0] or 100 * lost > 50 * counts[0]:
        return None
    return "\n".join(x for x in lines if not brute_fails(x))


def test_quality_stage_against_plain_rules(stages):
    want = Counter((i, c) for i, t in pairs(stages[0]) if (c := brute_clean(t)) is not None)
    assert Counter(pairs(stages[1])) == want


def test_near_duplicate_stage(stages):
    before = pairs(stages[1])
    root = brute_components([brute_fingerprint(t) for _, t in before])
    first = {}
    for (i, _), r in zip(before, root):
        first[r] = min(first.get(r, i), i)
    assert sorted(i for i, _ in pairs(stages[2])) == sorted(first.values())


def test_benchmark_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [r[0] for r in brute_contamination(pairs(stages[2]), items) if not r[5]]
    assert sorted(i for i, _ in pairs(stages[3])) == sorted(want)


def test_mix_stage(stages):
    before, after = dict(pairs(stages[3])), pairs(stages[4])
    times = Counter(i for i, _ in after)
    assert all(before[i] == t for i, t in after) and max(times.values()) <= 3
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total = sum(map(words, before.values()))
    longest = max(map(words, before.values()))
    assert abs(sum(words(t) for _, t in after) - total) <= 20 * longest


def brute_mix(docs):
    """Times that each (doc_id, text) is in the mix, and the target of each source; docs of (doc_id, text, source, hash)."""
    size = Counter()
    for _, t, source, _ in docs:
        size[source] += len(ws(t))
    names = sorted(size, key=lambda x: (x is None, (x or "").encode()))
    weight = {x: k % 3 + 1 for k, x in enumerate(names)}
    low, high = 0.0, 3.0 * sum(size.values())
    for _ in range(200):  # the level at which the capped shares add up to all words
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(3 * size[x], mid * weight[x]) for x in names) < sum(size.values()) else (low, mid)
    target = {x: min(3 * size[x], high * weight[x]) for x in names}
    exact = dict(zip(names, mixing.targets([size[x] for x in names], [weight[x] for x in names])))
    assert exact == pytest.approx(target)
    times = Counter()
    for x in names:
        quota, start = min(round(exact[x]), 3 * size[x]), 0
        for i, t, _, _ in sorted((d for d in docs if d[2] == x), key=lambda d: ((d[3] >> 20) % mixing.SLICES, d[3], d[0])):
            n = len(ws(t))
            if n:
                times[i, t] = quota // size[x] + (2 * max(0, min(n, quota % size[x] - start)) >= n)
            start += n
    return +times, target


def test_mix_stage_per_source(stages):
    order = F.xxhash64(F.lit(mixing.SEED), "doc_id", "text")
    docs = [tuple(r) for r in stages[3].select("doc_id", "text", "source", order).collect()]
    times, target = brute_mix(docs)
    after = [(r.doc_id, r.text, r.source) for r in stages[4].collect()]
    assert Counter((i, t) for i, t, _ in after) == times
    for x in target:
        longest = max(len(ws(t)) for _, t, s, _ in docs if s == x)
        assert abs(sum(len(ws(t)) for _, t, s in after if s == x) - target[x]) <= longest


def test_shard_stage(stages):
    out = stages[5]
    assert Counter(pairs(out)) == Counter(pairs(stages[4]))
    for r in out.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.count_distinct("slot").alias("k")).collect():
        assert r.lo == 0 and r.hi == r.n - 1 and r.k == r.n
    assert out.groupBy("text").agg(F.count_distinct("shard").alias("k")).where("k > 1").count() == 0


def test_run_gives_the_stages_result(spark, stages):
    assert Counter(pairs(catalog.pipeline(spark, SF))) == Counter(pairs(stages[5]))


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-stage")
    assert docs.count() == 0
