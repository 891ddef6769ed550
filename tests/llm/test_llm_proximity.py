"""Proximity matches of operator 6 against a plain version of their definition, and against its SQL."""

import random
import re

import duckdb
import pytest

from ratewise.llm import decontaminate, scratch

BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "alpha bravo charlie delta echo foxtrot golf hotel india juliet"


def index_words(text):
    return [w for w in BETWEEN.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def brute_near(docs, items, window=10, slop=3):
    windows = set()
    for text in items:
        words = index_words(text)
        windows |= {tuple(words[i:i + window]) for i in range(max(1, len(words) - window + 1)) if words}
    out = []
    for doc_id, text in docs:
        words, n = index_words(text), 0
        for w in windows:
            width = len(w) + 2 * slop
            phrase = any(tuple(words[i:i + len(w)]) == w for i in range(len(words)))
            n += not phrase and any(5 * len(set(w) & set(words[i:i + width])) >= 4 * len(set(w)) for i in range(len(words)))
        out.append((doc_id, n))
    return sorted(out)


def corpus():
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(60)]
    draw = lambda n: [vocabulary[min(int(rng.expovariate(0.08)), 59)] for _ in range(n)]
    items = [draw(n) for n in (1, 2, 3, 4, 5, 6, 9, 10, 11, 14, 25)] + [["w1"] * 12, ["unknown"], ["unknown", "w3", "w4", "w5", "w6"]]
    docs = []
    for i in range(80):
        words = draw(rng.choice([0, 1, 3, 9, 40, 200]))
        part = list(rng.choice(items))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(part) + 1)
            part[at:at + rng.randrange(2)] = [rng.choice(vocabulary)] * rng.randrange(2)
        if rng.random() < 0.3:
            rng.shuffle(part)
        docs.append((i, " ".join(words + part + draw(rng.randrange(30)))))
    return docs + [(80, None), (81, ""), (82, docs[5][1]), (82, docs[5][1])], [" ".join(i) for i in items] + [None, " ... "]


def near(spark, docs, items, **more):
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, key string, wid int")
    bench = spark.createDataFrame([(i, t, "y") for i, t in enumerate(items)], "item_id bigint, text string, term string")
    return sorted((r.doc_id, r.n_near) for r in decontaminate.contamination(table, bench, **more).collect())


def test_nine_of_ten_words_are_near(spark):
    missing = [ITEM.replace(w, "other") for w in ("alpha", "delta", "juliet")]
    two = ITEM.replace("alpha", "x").replace("juliet", "y")
    three = two.replace("echo", "z")
    loose = ITEM.replace("delta", "delta one two three").replace("golf", "golf four five six")
    docs = list(enumerate([*missing, two, three, loose, ITEM, ITEM.replace("golf", "golf" + 14 * " seven"), " ".join(reversed(ITEM.split()))]))
    docs += [(20 + i, "alpha juliet") for i in range(5)]
    got = dict(near(spark, docs, [ITEM]))
    assert [got[i] for i in range(9)] == [1, 1, 1, 1, 0, 1, 0, 0, 1]
    assert all(got[20 + i] == 0 for i in range(5))


@pytest.mark.parametrize("more", [{}, {"slop": 0}, {"window": 4, "slop": 1}, {"window": 25, "slop": 2}])
def test_proximity_against_the_definition(spark, more):
    docs, items = corpus()
    assert near(spark, docs, items, **more) == brute_near(docs, items, **more)


def test_proximity_in_small_blocks_without_broadcasts(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 9)
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", 0)
    assert near(spark, docs, items) == brute_near(docs, items)


def test_proximity_sql_against_the_definition(spark):
    docs, items = corpus()
    docs = docs[:-1]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", list(enumerate(items)))
    want = brute_near(docs, items)
    assert sorted(con.execute(f"SELECT doc_id, n_near FROM ({decontaminate.ORACLE})").fetchall()) == want
    assert sum(n for _, n in want) > 50


def test_place_of_a_near_window(spark):
    docs = spark.createDataFrame([(1, "a b c d " * 10 + ITEM.replace("echo", "other"))], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    row = decontaminate.search(docs, bench).first()
    # Juliet at 49: the first stretch of 16 words with 8 of the 10 ends at india, 48.
    assert [r.start for r in row.near] == [33] and row.hits == []


def test_proximity_of_empty_tables(spark):
    docs, items = corpus()
    assert near(spark, [], items) == []
    assert all(n == 0 for _, n in near(spark, docs, []))
