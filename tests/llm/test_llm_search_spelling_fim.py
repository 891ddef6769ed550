"""Operators 11 to 13 against brute-force versions, with odd rows: nulls, ties, copies, clashing columns, long texts."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import catalog, fim, pivots, spelling

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, n int, form string, word string, n_near int, root string, key string, output string, row int"


def documents(spark, rows):
    """rows of (doc_id, text), with columns that clash with names inside the operators."""
    return spark.createDataFrame([(i, t, 1, "f", "w", 2, "r", "k", "o", 3) for i, t in rows], DOCS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# 11 exact top-k search

VECTORS = "vec_id bigint, embedding array<float>, label int, row bigint, cell int, norm double, score bigint, reach int"


def vectors(spark, data):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4.0, 5, 6) for i, v in data], VECTORS)


def floats(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def brute_top(data, k=5, step=50):
    """Plain search over every pair, in Python integers."""
    part = [(i, [math.floor(256 * x) for x in floats(v)]) for i, v in data
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(part):
        if q is None or q % step:
            continue
        found = sorted((-sum(s * t for s, t in zip(x, y)), c is None, c or 0, b) for b, (c, y) in enumerate(part) if b != a)
        out += [(q, r + 1, None if none else c, -s) for r, (s, none, c, _) in enumerate(found[:k])]
    return sorted(out, key=repr)


def top(df, **options):
    return rows(pivots.top_k(df, **options), "query_id", "rank", "vec_id", "score")


RNG = np.random.default_rng(3)
CENTRES = RNG.normal(size=(12, 8))
CLUSTERED = [(i, [float(x) for x in CENTRES[i % 12] + 0.05 * RNG.normal(size=8)]) for i in range(700)]
ODD = [
    (0, [1.0, 2.0, 0.5]), (0, [1.0, 2.0, 0.5]), (50, [1.0, 2.0, 0.5]), (51, [1.0, 2.0, 0.5]), (52, [1.0, 2.0, 0.5]), (7, [1.0, 2.0, 0.5]),
    (100, None), (150, [1.0, None, 2.0]), (200, [float("nan"), 1.0, 1.0]), (250, [float("inf"), 1.0, 1.0]), (300, [1.0]), (350, []),
    (None, [1.0, 2.0, 0.5]), (None, [9.0, 9.0, 9.0]), (400, [-1.0, -2.0, -0.25]), (450, [0.001, -0.001, 0.0]), (3, [3.0, 2.0, 1.0, 7.0]),
]


@pytest.mark.parametrize("options", [{}, {"pivots": 1}, {"pivots": 6, "sample": 40, "block": 16, "group": 3}, {"block": 1, "pivots": 2}])
def test_top_k_of_odd_vectors(spark, options):
    assert top(vectors(spark, ODD), **options) == brute_top(ODD)


@pytest.mark.parametrize("options", [{}, {"pivots": 5, "sample": 30, "block": 50, "group": 4}, {"k": 1}, {"k": 40, "step": 100}])
def test_top_k_of_clusters(spark, options):
    want = brute_top(CLUSTERED, options.get("k", 5), options.get("step", 50))
    assert top(vectors(spark, CLUSTERED), **options) == want


def test_top_k_fewer_than_k_empty_and_large_components(spark):
    assert top(vectors(spark, [])) == [] and top(vectors(spark, [(1, [1.0])])) == [] and top(vectors(spark, [(50, [1.0])])) == []
    few = [(50, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.25, 1.0])]
    assert top(vectors(spark, few)) == brute_top(few)
    large = [(50 * i, [float(2.0 ** 22 + 257 * i), 3.0 * i, -1e6 + i]) for i in range(8)]
    assert top(vectors(spark, large)) == brute_top(large)
    with pytest.raises(Exception, match="2\\^31"):
        pivots.top_k(vectors(spark, [(50, [1e12])])).collect()


def test_bounds_hold_and_close_cells(spark):
    """No score is above its bound, and on clustered vectors most cells stay closed."""
    data = vectors(spark, CLUSTERED)
    index = pivots.PivotIndex(data, "vec_id", "embedding", pivots=12, sample=200)
    stored = index.rows.collect()
    x = np.floor(256 * np.array([r.vector for r in stored]))
    d, norm, cell = np.array([r.distances for r in stored]), np.array([r.norm for r in stored]), np.array([r.cell for r in stored])
    s, bounds = x @ x.T, index.cells.bounds(d, norm)
    assert (s <= bounds[:, cell]).all()
    lower = np.abs(d[:, None, :] - d[None, :, :]).max(axis=2) - pivots.ROUNDING * 2 * d.max()
    assert (s <= pivots.score_bound(np.maximum(lower, 0), norm[:, None] + norm[None, :])).all()
    kth = -np.sort(-s, axis=1)[:, 5]
    assert (bounds >= kth[:, None]).mean() < 0.5


def test_top_k_of_the_table(spark):
    data = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = rows(catalog.op11_topk_search(spark, SF), "query_id", "rank", "vec_id", "score")
    assert got == brute_top(data)


# 12 spelling variants

def brute_words(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(docs):
    n = brute_words(docs)
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def groups(df):
    return rows(spelling.spelling_groups(df), "word", "form", "root", "n", "n_near", "form_n")


def edits(rng, word, letters):
    k, c = rng.randrange(len(word)), rng.choice(letters)
    return rng.choice([word[:k] + c + word[k:], word[:k] + word[k + 1:], word[:k] + c + word[k + 1:]])


def spelling_docs(seed):
    """Words, their edits, edits of edits and anagrams, so frequent that forms chain: 2, 20, 200, 2000 times."""
    rng = random.Random(seed)
    letters = "abcdeé"
    docs, doc = [], 0
    for _ in range(12):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(7, 11)))
        for times in (2000, 200, 20, 2, 2):
            shown = word.upper() if rng.random() < 0.3 and "é" not in word else word
            for part in range(0, times, 50):  # one run of a document is always spelled alike
                docs.append((doc, " ".join([shown] * min(50, times - part)) + ". " + "".join(rng.sample(word, len(word)))))
                doc += 1
            word = edits(rng, word, letters)
    return docs


SPELLED = [(1, None), (2, ""), (3, "abcdefg abcdefg"), (3, "abcdefg abcdefg"), (None, "abcdefh, abcdefh; abcdef abcdef"),
           (4, "x" * 5000 + " " + "x" * 5001 + " " + "x" * 5000 + " " + "x" * 5001), (5, "ÀÉÎõüßÿ ÀÉÎõüßÿ aéîõüßÿ naïveté naïveté"),
           (6, "word_1234567 ABCDEFG " * 30), (7, "tie" + "a" * 6 + " " + "tie" + "a" * 6), (8, "1234567 abcdefgé Abcdefgé")]


def test_spelling_groups_of_odd_texts(spark):
    assert groups(documents(spark, SPELLED)) == brute_groups(SPELLED)
    assert groups(documents(spark, [])) == [] and groups(documents(spark, SPELLED[:2])) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_groups_chain(spark, seed):
    docs = spelling_docs(seed)
    want = brute_groups(docs)
    assert groups(documents(spark, docs)) == want
    assert any(form and form != root for _, form, root, *_ in want)


def test_spelling_groups_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows(catalog.op12_spelling_groups(spark, SF), "word", "form", "root", "n", "n_near", "form_n") == brute_groups(docs)


def test_batches_pass_counts_on(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MEMORY", 2)
    assert groups(documents(spark, SPELLED)) == brute_groups(SPELLED)


@pytest.mark.parametrize("k, n1, n2", [(2, 1, 3), (2, 1, 4), (2, 1, 5), (2, 3, 1), (2, 2, 2), (2, 2, 3), (1, 1, 2), (1, 1, 3), (1, 2, 1)])
def test_partenum_loses_no_vector(k, n1, n2):
    rng = random.Random(k * 100 + n1 * 10 + n2)
    for _ in range(300):
        a = [(rng.choice("abcdefgh"), 0) for _ in range(9)]
        bits = set(a)
        for _ in range(rng.randint(0, k)):
            bits ^= {(rng.choice("abcdefgh"), rng.randrange(2))}
        assert set(spelling.partenum(sorted(set(a)), k, n1, n2)) & set(spelling.partenum(sorted(bits), k, n1, n2))


def test_partenum_refuses_too_few_pieces():
    with pytest.raises(ValueError):
        list(spelling.partenum([("a", 0)], 2, 1, 2))


def test_every_edit_shares_a_signature():
    rng = random.Random(9)
    for _ in range(400):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(7, 12)))
        b = edits(rng, a, "abcdé")
        if a == b or not one_edit(a, b):
            continue
        a, b = sorted((a, b), key=len)
        left = {s for role, s in spelling.signatures(a) if role != spelling.LONG}
        assert left & {s for role, s in spelling.signatures(b) if role != (spelling.SHORT)}


def test_anagrams_do_not_all_meet(spark):
    """720 words of the same letters: the keys keep most of them apart, and no near pair is lost."""
    words = ["zz" + "".join(p) + "q" for p in itertools.permutations("abcdef")] + ["zzabcdefqq"]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    got = {(r.a, r.b) for r in spelling.near_words(df).collect()}
    assert got == {("zzabcdefq", "zzabcdefqq")}
    met = Counter(s for w in words[:-1] for role, s in spelling.signatures(w) if role == spelling.SAME)
    assert max(met.values()) < 30


# 13 fill-in-middle

def brute_fim(i, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [None, "", "a", " ", "abc", "abc def", "<P>", "x <S> y", "a<M", "<", "<P", ">", "P>x", "<S<P<M", "é ü😀 ñ", "\r\n\t\n", "one1two2three",
         "Été été ETE", "\u0000 zero", "日本語 text 日本語"]
FILL = [(k * 31 + j, t) for j, t in enumerate(TEXTS) for k in range(8)] + [
    (None, "no id at all here"), (3, "repeated row"), (3, "repeated row"), (17, ("Long text, " * 50 + "\n") * 4000)]


def test_fill_in_middle(spark):
    df = documents(spark, FILL)
    got = rows(fim.fill_in_middle(df), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256")
    want = [(i, *(w := brute_fim(i, t)), sha(w[-1]), sha(t or "")) for i, t in FILL]
    assert got == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    slim = fim.fill_in_middle(df, outputs=False)
    assert "output" not in slim.columns and rows(slim, "doc_id", "output_sha256") == sorted(((w[0], w[6]) for w in want), key=repr)


def test_restore_needs_output_and_form_only(spark):
    made = fim.fill_in_middle(documents(spark, FILL)).select("doc_id", "output", "form")
    back = rows(fim.restore(made), "doc_id", "restored")
    assert back == sorted(((i, t or "") for i, t in FILL), key=repr)
    odd = spark.createDataFrame([("x", None), (None, "psm"), ("x", "plain")], "output string, form string")
    assert rows(fim.restore(odd), "restored") == sorted([(None,), (None,), ("x",)], key=repr)


def test_fill_in_middle_of_an_empty_table(spark):
    none = documents(spark, [])
    assert fim.fill_in_middle(none).count() == 0 and fim.fill_in_middle(none, outputs=False).count() == 0


def test_fill_in_middle_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows(catalog.op13_fill_in_middle(spark, SF), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    assert got == sorted(((i, *(w := brute_fim(i, t))[:4], sha(w[4]), sha(t or "")) for i, t in docs), key=repr)


def test_piece_table_cuts_and_joins():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("abé 😀\n") for _ in range(rng.randint(0, 30)))
        table = fim.PieceTable.of(text)
        at = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(0, 4)))
        parts = table.cut(*at)
        assert [p.text() for p in parts] == [text[a:b] for a, b in zip([0, *at], [*at, len(text)])]
        order = list(range(len(parts)))
        rng.shuffle(order)
        mixed = table.joined([parts[k] for k in order])
        assert mixed.text() == "".join(parts[k].text() for k in order) and len(mixed) == len(text) and mixed.sha256() == sha(mixed.text())
        again = mixed.cut(*sorted(rng.randint(0, len(text)) for _ in range(2)))  # descriptors are split where cuts fall into them
        assert "".join(p.text() for p in again) == mixed.text()
        assert len(mixed.buffers) == 2 and mixed.buffers[0] is text


def test_digest_reads_in_steps(monkeypatch):
    monkeypatch.setattr(fim, "STEP", 3)
    text = "añ😀b" * 50
    assert fim.PieceTable.of(text).sha256() == sha(text)
