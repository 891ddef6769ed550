"""The positional index of operator 6 against a plain version, and the search when its hashes clash."""

from pyspark.sql import functions as F

from ratewise.llm import decontaminate

from test_llm_proximity import ITEM, brute_near, corpus, index_words, near

TEXTS = ["A b C d, a B", None, "", " ,b", "É a é b É", "c " * 25, "A b C d, a B", "b\u00c0 a" * 9]


def test_index_against_a_plain_version(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS * 3], "text string")
    words = ["a", "b", "é", "c"]
    terms = spark.createDataFrame([(w,) for w in words], "w string").select(decontaminate.term_of(F.col("w")).alias("term"))
    number = dict(zip([r.term for r in terms.collect()], words, strict=True))
    keys = {r.key: r.text for r in docs.select(decontaminate.text_key(F.col("text")).alias("key"), "text").where("text <> ''").collect()}
    index = decontaminate.positional_index(docs, "text", terms, 4)
    plan = index._jdf.queryExecution().executedPlan().toString()
    want = []
    for text in {t for t in TEXTS if t}:
        ws = index_words(text)
        for b in range(0, len(ws), 4):
            at = [w if w in words else None for w in (ws + [None] * 8)[b:b + 8]]
            want += [(text, b // 4, at)] * any(at)
    assert sorted(((keys[r.key], r.block, [number.get(t) for t in r.terms]) for r in index.collect()), key=repr) == sorted(want, key=repr)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert plan.count("split(") == 1  # texts are cut into words once
    assert "xxhash64(coalesce" not in plan.split("Generate posexplode")[0]  # and hashed once a text, not once a word


def test_clashing_terms_lose_nothing(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(decontaminate, "term_of", lambda word: F.pmod(F.xxhash64(word), F.lit(7)))
    assert near(spark, docs, items) == brute_near(docs, items)


def test_clashing_texts_lose_no_phrase(spark, monkeypatch):
    rows = [(1, "x " + ITEM + " y"), (2, "one two " + ITEM), (3, "alpha bravo golf"), (4, None), (2, "one two " + ITEM)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "text_key", lambda text: F.lit(1).cast("bigint"))
    out = decontaminate.contamination(docs, bench).select("doc_id", "n_hit").collect()
    assert sorted(map(tuple, out)) == [(1, 10), (2, 10), (2, 10), (3, 0), (4, 0)]
