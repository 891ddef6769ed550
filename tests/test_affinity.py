"""category_affinity: the reviews dealt to more tasks, against a plain version."""

import __spark_entry__ as E
import pytest

from conftest import SF_SMALL
from ratewise.operators import history as H
from ratewise.plans import catalog

REVIEWS = ([(f"u{i % 7}", f"b{i % 11}", float(i % 5 + 1)) for i in range(300)] + [("u1", "b1", 5.0)] * 3 + [("hot", f"b{i % 13}", 2.0) for i in range(200)]
           + [(None, "b2", 3.0), ("u1", None, 1.0), ("u2", "b3", None), ("u9", "b3", None), ("u8", "unknown", 4.0)])
PLACES = [(f"b{i}", ["Food, Bars", " Bars ,Bars,Tea", "", None][i % 4]) for i in range(12)] + [("b1", "Twice")]


def plain():
    lists = {}
    for b, c in PLACES:
        lists.setdefault(b, []).append([*dict.fromkeys(x.strip() for x in (c or "").split(",") if x.strip())])
    sums = {}
    for u, b, s in REVIEWS:
        for names in lists.get(b, [[]]):
            for c in [*names, None]:
                sums.setdefault((u, c), []).append(s)
    mean = lambda v: sum(x for x in v if x is not None) / len(v) if any(x is not None for x in v) else None
    out = []
    for (u, c), v in sums.items():
        if c is not None:
            a, b = mean(v), mean(sums[u, None])
            out.append((u, c, len(v), a, None if a is None or b is None else a - b))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [None, 1, 5])
def test_dealt_reviews_give_the_same_affinities(spark, parts):
    reviews = spark.createDataFrame(REVIEWS, "user_id string, business_id string, stars double")
    places = spark.createDataFrame(PLACES, "business_id string, categories string")
    got = sorted(map(tuple, H.category_affinity(reviews, places, parts).collect()), key=repr)
    assert [r[:3] for r in got] == [r[:3] for r in plain()]
    for g, w in zip(got, plain(), strict=True):
        assert [x if x is None else round(x, 9) for x in g[3:]] == [x if x is None else round(x, 9) for x in w[3:]]


def test_tasks_grow_with_the_reviews(spark, monkeypatch):
    n = catalog.Tables(spark, SF_SMALL).n_reviews
    monkeypatch.setattr(catalog, "AFFINITY_ROWS", 1000)
    plan = E.queries()["category_affinity"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-n // 1000)}), REPARTITION_BY_NUM" in plan
    assert plan.count("partial_count(1)") == 1  # one table of sums in a task, not two
