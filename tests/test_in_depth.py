"""Point-in-time history, statistics within a radius and the fitted lexicon against plain Python."""

import datetime as dt
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratewise.operators import as_of as AO
from ratewise.operators import nearby as NB
from ratewise.operators import sentiment as SE

REVIEWS = "user_id string, business_id string, stars double, ts timestamp_ntz, pair_key string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# point in time

def visits(seed=3, n=400):
    rng = random.Random(seed)
    start = dt.datetime(2023, 12, 30)
    rows = []
    for k in range(n):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(25)}"
        ts = start + dt.timedelta(minutes=rng.choice([0, 1, 30, 60, 1440, 1441]) * rng.randrange(60))
        rows.append((user, f"b{rng.randrange(9)}", rng.choice([1.0, 2.5, 4.0, 5.0]), ts, f"p{k}"))
    rows += [rows[0], rows[0], ("u1", "b1", None, start + dt.timedelta(days=3), "nostars"), ("u1", "b1", 5.0, None, "notime"),
             (None, "b1", 5.0, start, "nouser"), ("lone", "b1", 3.0, start, "lone")]
    return rows


def brute_history(rows, key):
    out = []
    for u, b, s, ts, p in rows:
        own = (u, b)[key]
        r = [x[2] for x in rows if own is not None and ts is not None and x[key] == own and x[3] is not None and x[3] < ts and x[2] is not None]
        mean = sum(r) / len(r) if r else None
        var = None if not r else 0.0 if len(r) == 1 else sum((x - mean) ** 2 for x in r) / (len(r) - 1)
        out.append((p, len(r), mean, var, min(r, default=None), max(r, default=None)))
    return out


def close(a, b):
    return all(x == y or (x is not None and y is not None and abs(x - y) < 1e-9) if not isinstance(x, str) else x == y for x, y in zip(a, b))


def same(got, want):
    got, want = sorted(got, key=repr), sorted(want, key=repr)
    by = lambda rows: sorted(rows, key=lambda r: (r[0], r[1]))
    return len(got) == len(want) and all(close(g, w) for g, w in zip(by(got), by(want)))


@pytest.mark.parametrize("slice_", ["hour", "day", "month", "year"])
@pytest.mark.parametrize("key", ["user_id", "business_id"])
def test_history_as_of(spark, slice_, key):
    rows = visits()
    df = spark.createDataFrame(rows, REVIEWS)
    got = [tuple(r) for r in AO.rating_history(df, key, slice_).drop("user_id", "business_id", "ts").collect()]
    assert same(got, brute_history(rows, 0 if key == "user_id" else 1))


@pytest.mark.parametrize("slice_", ["day", "month"])
def test_recency_as_of(spark, slice_):
    rows = visits(5)
    want = []
    for u, b, s, ts, p in rows:
        days = sorted(x[3].date() for x in rows if u is not None and ts is not None and x[0] == u and x[3] is not None and x[3] < ts)
        span = (days[-1] - days[0]).days + 1 if days else None
        want.append((p, len(days), span, (ts.date() - days[-1]).days if days else None, len(days) / span if days else None))
    got = AO.recency(spark.createDataFrame(rows, REVIEWS), slice_=slice_).drop("user_id", "business_id", "ts")
    assert same([tuple(r) for r in got.collect()], want)


def test_a_label_never_reaches_its_own_feature(spark):
    rows = visits(7)
    base = {(r.pair_key, r.ts): tuple(r) for r in AO.rating_history(spark.createDataFrame(rows, REVIEWS), "user_id").collect()}
    for k in (0, 50, 120):  # one rating changed: its row, the rows before it and those at its instant stay as they are
        u, b, s, ts, p = rows[k]
        moved = [(x[0], x[1], 1.5, *x[3:]) if i == k else x for i, x in enumerate(rows)]
        now = {(r.pair_key, r.ts): tuple(r) for r in AO.rating_history(spark.createDataFrame(moved, REVIEWS), "user_id").collect()}
        changed = {x for x in base if base[x] != now[x]}
        assert all(t > ts for _, t in changed)
        later = [x for x in rows if x[0] == u and x[3] is not None and x[3] > ts]
        assert not later or changed


def test_no_window_sees_a_whole_key(spark):
    text = plan(AO.rating_history(spark.createDataFrame(visits(), REVIEWS), "user_id"))
    over = set(re.findall(r"windowspecdefinition\((.*?) ASC", text))  # partition columns, then the order
    assert len(over) == 2 and all("_slice" in w for w in over), over  # slices of a key, and rows of a slice
    assert "CartesianProduct" not in text
    none = AO.rating_history(spark.createDataFrame([], REVIEWS), "user_id")
    assert none.collect() == [] and AO.recency(spark.createDataFrame([], REVIEWS)).collect() == []


# within a radius

PLACES = "business_id string, latitude double, longitude double, stars double, city string"


def km(a, b):
    p, q = math.radians(b[0] - a[0]), math.radians(b[1] - a[1])
    h = math.sin(p / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(q / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def places(seed=4):
    rng = random.Random(seed)
    rows = [(f"d{k}", 40 + rng.random() / 20, -75 + rng.random() / 20, rng.choice([1.0, 3.5, 5.0])) for k in range(120)]  # a dense cube
    rows += [(f"s{k}", 51.5, 0.12, 2.0) for k in range(30)]  # all at one place
    rows += [(f"w{k}", 89.9 - rng.random() / 5, rng.uniform(-180, 180), 4.0) for k in range(20)]  # around the pole
    rows += [(f"e{k}", rng.uniform(-0.2, 0.2), rng.choice([-1, 1]) * (180 - rng.random() / 5), 4.5) for k in range(20)]  # date line
    rows += [(f"r{k}", rng.uniform(-80, 80), rng.uniform(-180, 180), 3.0) for k in range(60)]
    rows += [("nopos", None, 1.0, 3.0), ("nolon", 1.0, None, 3.0), ("nostars", 40.02, -74.98, None), ("twin", 51.5, 0.12, 5.0), ("twin", 51.5, 0.12, 5.0)]
    return [(*r, "c") for r in rows]


def brute_near(rows, radius):
    out = []
    for i, (b, lat, lon, s, _) in enumerate(rows):
        near = [] if lat is None or lon is None else [x[3] for j, x in enumerate(rows) if j != i and x[1] is not None and x[2] is not None
                                                      and km((lat, lon), (x[1], x[2])) <= radius]
        rated = [x for x in near if x is not None]
        mean = sum(rated) / len(rated) if rated else None
        out.append((b, len(near), mean, s - mean if mean is not None and s is not None else None))
    return out


@pytest.mark.parametrize("radius, part", [(25.0, 2000), (25.0, 7), (1.5, 3), (900.0, 50), (21000.0, 40)])
def test_radius_stats(spark, radius, part):
    rows = places()
    got = [tuple(r) for r in NB.radius_stats(spark.createDataFrame(rows, PLACES), radius, part).collect()]
    assert same(got, brute_near(rows, radius))


def test_radius_join_is_an_equi_join(spark):
    text = plan(NB.radius_stats(spark.createDataFrame(places(), PLACES), 25.0))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert NB.radius_stats(spark.createDataFrame([], PLACES), 25.0).collect() == []


# fitted sentiment

TIPS = "business_id string, text string, user_id string, word string, weight double"


def brute_words(text):
    out = []
    for clause in re.split(r"[.,;:!?\n]+", re.sub("n['’]t", " not", (text or "").lower())):
        words = [w for w in re.split("[^a-z]+", clause) if w]
        out += ["not_" + w if set(words[max(0, k - 3):k]) & set(SE.NEGATIONS) else w for k, w in enumerate(words)]
    return out


@pytest.mark.parametrize("text", [None, "", "  ", "not good", "It isn't very good at all. Good!", "never, good", "don’t go there now please",
                                  "a no b c d e", "NOT\nGOOD", "x" * 5000 + " not " + "y " * 5000])
def test_marked_words(spark, text):
    df = spark.createDataFrame([(text,)], "text string").select(SE.marked_words("text").alias("w"))
    assert df.first().w == brute_words(text)


def planted(spark, n=400, seed=8):
    rng = random.Random(seed)
    tips, reviews = [], []
    for k in range(n):
        good = k % 2 == 0
        reviews += [(f"u{j}", f"b{k}", float(rng.choice([4, 5] if good else [1, 2])), dt.datetime(2024, 1, 1), "p") for j in range(3)]
        praise, blame = rng.choice(["great", "tasty", "not bad"]), rng.choice(["awful", "bland", "not great", "bad"])
        text = " ".join(["the place", praise if good ^ (rng.random() < 0.1) else blame, "and the food", rng.choice(["here", "there"])])
        tips.append((f"b{k}", text, "u", "w", 9.0))
    tips += [("b0", None, "u", "w", 9.0), ("unrated", "great great great", "u", "w", 9.0)]
    return spark.createDataFrame(tips, TIPS), spark.createDataFrame(reviews, REVIEWS), tips, reviews


def test_lexicon_of_planted_words(spark):
    tips, reviews, rows, rated = planted(spark)
    got = {r.word: r for r in SE.fit_lexicon(tips, reviews).collect()}
    assert {"great", "tasty", "not_bad"} <= {w for w, r in got.items() if r.weight > 0}
    assert {"awful", "bland", "not_great", "bad"} <= {w for w, r in got.items() if r.weight < 0}
    assert not {"the", "and", "here", "there"} & set(got)
    overall = sum(r[2] for r in rated) / len(rated)
    mean = {b: sum(x) / len(x) for b in {r[1] for r in rated} for x in [[r[2] for r in rated if r[1] == b]]}
    counts = {True: Counter(), False: Counter()}
    for b, text, *_ in rows:
        if b in mean:
            counts[mean[b] >= overall].update(brute_words(text))
    vocabulary, total = set(counts[True]) | set(counts[False]), {k: sum(c.values()) for k, c in counts.items()}
    for w, r in got.items():
        p, q = counts[True][w] + 1, counts[False][w] + 1
        weight = math.log(p / (total[True] + len(vocabulary))) - math.log(q / (total[False] + len(vocabulary)))
        assert (r.n_pos, r.n_neg) == (p - 1, q - 1) and abs(r.weight - weight) < 1e-9 and abs(r.z - weight / math.sqrt(1 / p + 1 / q)) < 1e-9


def test_signs_of_held_out_tips(spark):
    tips, reviews, *_ = planted(spark)
    row = SE.sign_test(tips, reviews).first()
    assert row.n > 40 and row.share > 0.85


def test_scores_without_words_or_ratings(spark):
    tips, reviews, *_ = planted(spark, 40)
    scores = {r.business_id: r for r in SE.score_tips(tips, SE.fit_lexicon(tips, reviews, min_count=1, z=0.0), ["business_id"]).collect()}
    assert len(scores) == 41 and scores["unrated"].tokens == 3 and scores["unrated"].score_sum > 0
    none = spark.createDataFrame([], REVIEWS)
    assert SE.fit_lexicon(tips, none).collect() == [] and SE.sign_test(tips, none).first().n == 0
    assert {r.score_sum for r in SE.score_tips(tips, SE.fit_lexicon(tips, none), ["business_id"]).collect()} == {0.0}
    assert SE.score_tips(spark.createDataFrame([], TIPS), SE.fit_lexicon(tips, reviews), ["business_id"]).collect() == []


def test_tips_are_marked_once(spark):
    """Fitting and scoring each split every text before; texts without words and null texts keep their rows."""
    tips = spark.createDataFrame([("b1", "not good, fine"), ("b1", "fine fine"), ("b2", ""), ("b3", None)], "business_id string, text string")
    reviews = spark.createDataFrame([("b1", 5.0), ("b2", 1.0), ("b3", 1.0)], "business_id string, stars double")
    marked = SE.with_words(tips)
    run = lambda t: sorted(map(tuple, SE.score_tips(t, SE.fit_lexicon(t, reviews, min_count=1, z=0.0), ["business_id"]).collect()))
    assert run(marked) == run(tips) and [r[1] for r in run(marked)] == [5, 0, 0]
    import __spark_entry__ as E
    from conftest import SF_SMALL
    plan = E.queries()["tip_sentiment_fitted"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "n['’]t" not in plan and "words" in plan
