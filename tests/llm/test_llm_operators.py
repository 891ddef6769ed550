"""The training-data operators against brute-force versions, with odd rows: nulls, blanks, ties, copies, long texts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import catalog, chat, components, decontaminate, licenses, mixing, pii, quality, scratch, sharding, simhash
from ratewise.llm import suffix_dedup, token_counts

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, words string, key bigint, shard string, "
          "_row string, _key string, slot int, fp string, size string")


def documents(spark, rows):
    """rows of (doc_id, text, source), with columns that clash with names inside the operators."""
    return spark.createDataFrame([(i, t, None, s, len(t or ""), "x", 1, "y", "r", "k", 3, "f", "z") for i, t, s in rows], SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefghijklmnopqrst") for _ in range(RNG.randint(2, 7))) for _ in range(300)]
LONG = "\n".join(sentence(RNG, 30) for _ in range(400))
PASSAGE = sentence(RNG, 120)
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", "b"), (4, "word", None), (5, PASSAGE, "a"), (5, PASSAGE, "a"),
    (None, PASSAGE + " tail", "b"), (None, None, None), (6, LONG, "c"), (7, LONG[:9000] + " x", "c"), (8, "é ü ñ " * 60, "b"),
    (9, "the " * 200, "a"), (10, sentence(RNG, 80) + " " + PASSAGE + "\n" + sentence(RNG, 60), "c"),
    (11, "😀 " + sentence(RNG, 70), "a"), (12, sentence(RNG, 70) * 2, "b"), (13, "\n".join([sentence(RNG, 12)] * 9), None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def table(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def ws(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# 1 quality rules

def base_counts(text):
    text, w = text or "", ws(text)
    lines = [x for x in text.split("\n") if ws(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_base_counts(odd):
    got = rows(quality.line_quality(odd), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = [(i, *(c := base_counts(t)), c[0] < 50 or 100 * c[4] > 50 * c[0]) for i, t, _ in ODD]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("line, fails", [
    ("A plain sentence that ends well.", False), ("", False), ("one two", True), ("Home", True), ("HOME.", True),
    ("News | Sport | Weather", True), ("Please accept our cookie policy today, dear reader.", True),
    ("we have a long line without an end mark that is still prose", False), ("a# b% c& d", True), ("THIS IS SHOUTED LOUD!!", True)])
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "l string").select(quality.line_fails(
        F.col("l"), F.lit(len(ws(line))), F.lit(sum(c in quality.SYMBOLS for c in line))).alias("f"))
    assert df.first().f is fails


def test_cleaning_removes_lines_and_rejects(spark, odd, none):
    good = "\n".join(sentence(RNG, 20) for _ in range(5))
    docs = documents(spark, [(1, good + "\nHome", "a"), (2, good[:200] + "\n" + "BUY!! NOW!! " * 60, "a"), (3, good, None)])
    out = {r.doc_id: r for r in quality.clean_documents(docs).collect()}
    assert set(out) == {1, 3} and out[1].text == good == out[3].text and out[1].n_chars == len(good)
    assert quality.clean_documents(odd).columns == odd.columns
    assert quality.line_quality(none).count() == quality.clean_documents(none).count() == 0


def test_phrase_in_a_long_line_keeps_it(spark):
    rng = random.Random(11)
    clean = sentence(rng, 40)[:-1] + " and they changed the privacy policy in May " + sentence(rng, 40)
    longer = "\n".join([sentence(rng, 60), clean, "Please read our privacy policy today, dear reader."])
    heavy = sentence(rng, 60) + "\nClick here for our terms of use, or click here for the Cookie Policy and the privacy policy of us."
    out = {r.doc_id: r.text for r in quality.clean_documents(documents(spark, [(1, clean, "a"), (2, longer, "a"), (3, heavy, "a")])).collect()}
    assert out == {1: clean, 2: longer.rsplit("\n", 1)[0], 3: heavy.split("\n")[0]}


@pytest.mark.parametrize("n, fails", [(12, True), (13, False)])
def test_short_lines_fail_by_one_phrase(spark, n, fails):
    line = "click here " + " ".join(["word"] * (n - 2)) + "."
    f = quality.line_fails(F.col("l"), F.lit(n), F.lit(0))
    assert spark.createDataFrame([(line,)], "l string").select(f.alias("f")).first().f is fails


# 2 sharding

def test_differencing():
    got = sharding.difference({k: n for k, n in enumerate([8, 7, 6, 5, 4])}, 2)
    sums = Counter()
    for k, s in got.items():
        sums[s] += [8, 7, 6, 5, 4][k]
    assert sorted(sums.values()) == [14, 16]
    sizes = {k: 100 + k % 7 for k in range(400)}
    got = sharding.difference(sizes, 40)
    sums = Counter()
    for k, s in got.items():
        sums[s] += sizes[k]
    assert set(got) == set(sizes) and len(sums) == 40 and max(sums.values()) - min(sums.values()) <= 2
    assert sharding.difference({}, 40) == {} and set(sharding.difference({"a": 5}, 3)) == {"a"}


def test_hot_group_fills_one_shard_alone():
    got = sharding.difference({"hot": 1000} | {k: 10 for k in range(78)}, 40)
    assert sum(s == got["hot"] for s in got.values()) == 1
    assert Counter(got.values()).most_common(1)[0][1] == 2


@pytest.mark.parametrize("lumps", [1, 100])
def test_shards(odd, none, lumps):
    out = sharding.assign_shards(odd, shards=4, lumps_per_shard=lumps, keep=odd.columns).collect()
    assert len(out) == len(ODD)
    shard_of = {}
    for r in out:
        assert shard_of.setdefault(r.text or "", r.shard) == r.shard and 0 <= r.shard < 4
        assert r["size"] == len((r.text or "").encode()) + 16 and r.law == "bytes" and r.grown_shard is None
    for s in range(4):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.assign_shards(none).count() == 0


def test_shards_are_balanced(spark):
    out = catalog.op2_shard_balance(spark, SF)
    sums = [r[0] for r in out.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    largest = max(r[0] for r in out.groupBy("text_crc32").agg(F.sum("size")).select("sum(size)").collect())
    assert len(sums) == 40 and max(sums) <= max(largest, 1.05 * sum(sums) / 40)


# 3 mixing

def test_targets_fill_up():
    assert mixing.targets([10, 10], [1, 1]) == [10, 10]
    assert mixing.targets([1, 99], [1, 1]) == [3, 97]
    got = mixing.targets([1, 2, 97, 300], [1, 2, 3, 1])
    assert got[0] == 3 and got[1] == 6 and got[2] == pytest.approx(291) and sum(got) == pytest.approx(400)
    assert mixing.targets([], []) == [] and mixing.targets([0, 5], [1, 2]) == [0, 5]


def test_mix(odd, none):
    placed, sources, mixed = mixing.mix_sources(odd, block_words=8)
    out = rows(mixing.mix_digest(odd, block_words=8), "doc_id", "size", "source_size", "target", "taken")
    assert len(out) == len(ODD) and out == rows(mixing.mix_digest(odd, block_words=8), "doc_id", "size", "source_size", "target", "taken")
    assert Counter((i, len(ws(t))) for i, t, _ in ODD) == Counter((r[0], r[1]) for r in out)
    assert all(0 <= r[4] <= 3 * r[1] for r in out)
    quota = {r.source: (r.target, r.quota) for r in sources.collect()}
    taken = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum("words").alias("n")).collect()}
    for s, (target, q) in quota.items():
        assert abs(target - q) <= 1 and taken.get(s, 0) == q
    # a document's pieces in an epoch are disjoint and inside it
    size = {r._row: r["size"] for r in placed.collect()}
    seen = Counter()
    for r in mixed.collect():
        for w in range(r.from_word, r.from_word + r.words):
            seen[r._row, r.epoch, w] += 1
            assert w < size[r._row]
    assert max(seen.values()) == 1
    assert mixing.mix_digest(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_schedule_is_spread(spark):
    plan = [("a", 64000, 64000.0, 64000), ("b", 64000, 128000.0, 128000), (None, 64000, 192000.0, 192000)]
    s = mixing.schedule(spark, plan, 64).orderBy("slot").collect()
    assert len(s) == 6000 and all(r.words == 64 for r in s)
    for n in (10, 100, 1000, 3000):
        got = Counter(r.source for r in s[:n])
        assert all(abs(got[k] - n * w / 6) <= 5 for k, w in (("a", 1), ("b", 2), (None, 3)))
    assert {r.epoch for r in s if r.source is None} == {0, 1, 2}


def test_mixed_documents_repeat_and_keep_columns(odd):
    out = mixing.mixed_documents(odd, block_words=8)
    assert out.columns == odd.columns
    n = Counter((r.doc_id, r.text) for r in out.collect())
    assert max(n.values()) <= 6 and all(ws(t) for _, t in n)  # two equal rows, three times each


# 4 repeated strings

def brute_repeats(docs, length):
    data = [(i, (t or "").encode()) for i, t in docs]
    n = Counter(t[k:k + length] for _, t in data for k in range(len(t) - length + 1))
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if n[t[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


COLUMNS4 = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_difference_covers():
    for q in (2, 3, 5, 7, 17):
        v, d = suffix_dedup.difference_cover(q)
        assert v == q * q + q + 1 and len(d) == q + 1 and {(a - b) % v for a in d for b in d} == set(range(v))


@pytest.mark.parametrize("unit_bytes", [1 << 20, 3000])
def test_repeats(spark, odd, none, unit_bytes):
    got = rows(suffix_dedup.remove_repeats(odd, unit_bytes=unit_bytes, bucket_bytes=unit_bytes), *COLUMNS4)
    assert got == brute_repeats([(i, t) for i, t, _ in ODD], 400)
    assert suffix_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_of_random_texts(spark, seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(20, 90))) for _ in range(12)]
    docs = [(k, "".join(rng.choice(parts) + rng.choice("abé") for _ in range(rng.randint(0, 5)))) for k in range(60)]
    got = rows(suffix_dedup.remove_repeats(documents(spark, [(i, t, "s") for i, t in docs]).repartition(5), length=40, q=5, sample=10,
                                           unit_bytes=600, bucket_bytes=600), *COLUMNS4)
    assert got == brute_repeats(docs, 40)


def longest_repeat(docs):
    """For each text the longest string that also starts elsewhere, and whether bytes outside strings of ``n`` repeat."""
    data = [(t or "").encode() for _, t in docs]
    out = []
    for a, t in enumerate(data):
        best = 0
        while any(t[k:k + best + 1] in u if b != a else t.find(t[k:k + best + 1], k + 1) >= 0 or t.find(t[k:k + best + 1]) < k
                  for k in range(len(t) - best) for b, u in enumerate(data)):
            best += 1
        out.append(best)
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_ties_tell_of_shorter_repeats(spark, seed):
    """Every repeat of sample + v - 1 bytes leaves a tie, and there is no tie without a repeat of a sample."""
    rng = random.Random(seed)
    part = "".join(rng.choice("abcdefgh") for _ in range(45))
    docs = []
    for k in range(40):
        text = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60)))
        cut = rng.randint(0, 44)
        docs.append((k, text + part[cut:cut + rng.randint(0, 45)] + "".join(rng.choice("abcdefgh") for _ in range(9))))
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(documents(spark, [(i, t, "s") for i, t in docs]).repartition(4), length=60, q=3,
                                                            sample=8, unit_bytes=500, bucket_bytes=500).collect()}
    longest = longest_repeat(docs)
    assert max(longest) >= 20 and min(longest) < 8
    for (k, t), n in zip(docs, longest):
        r = got[k]
        assert (r.tied_bytes > 0) == (r.longest_tie > 0) and 0 <= r.tied_bytes <= len(t) and r.longest_tie <= len(t)
        assert r.tied_bytes >= 8 if n >= 8 + 13 - 1 else True
        assert r.tied_bytes == 0 if n < 8 else True


def test_units_beyond_the_bucket_limit(spark):
    """More units than Spark's limit of buckets: the limit is raised for the table and set back, and no table is left."""
    limit, before = "spark.sql.sources.bucketing.maxBuckets", spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    tables = {t.name for t in spark.catalog.listTables()}
    spark.conf.set(limit, 20)
    try:
        got = rows(suffix_dedup.remove_repeats(documents(spark, ODD), unit_bytes=2000, bucket_bytes=2000), *COLUMNS4)
        assert spark.conf.get(limit) == "20"
    finally:
        spark.conf.set(limit, before)
    assert got == brute_repeats([(i, t) for i, t, _ in ODD], 400)
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_many_units_are_numbered_without_a_list(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SPREAD", 3)
    assert list(suffix_dedup.spread_keys(spark, 200_000)[-2:]) == [199_998, 199_999]
    got = rows(suffix_dedup.remove_repeats(documents(spark, ODD), unit_bytes=3000, bucket_bytes=3000), *COLUMNS4)
    assert got == brute_repeats([(i, t) for i, t, _ in ODD], 400)
    assert suffix_dedup.grown(8 << 20, 10 ** 9) == 8 << 20 and suffix_dedup.grown(8 << 20, 10 ** 14) > 300 << 20


def test_a_failing_run_leaves_no_table(spark, monkeypatch):
    tables = {t.name for t in spark.catalog.listTables()}

    def fails(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(suffix_dedup, "repeats_of_units", fails)
    with pytest.raises(RuntimeError):
        suffix_dedup.remove_repeats(documents(spark, ODD[:5]))
    assert {t.name for t in spark.catalog.listTables()} == tables


# 5 near-duplicates

def brute_fingerprint(text, shingle=4):
    import xxhash
    w = ws("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i:i + shingle]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=4):
    f, root = np.array(fps, np.uint64), np.arange(len(fps))
    for i in range(len(f)):
        j = np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius)
        simhash.join_roots(root, np.full(len(j), i), j)
    return root


def test_near_duplicates(odd, none):
    fps = [brute_fingerprint(t) for _, t, _ in ODD]
    root = brute_components(fps)
    least = {r: min((i for (i, _, _), x in zip(ODD, root) if x == r and i is not None), default=None) for r in set(root)}
    want = sorted(((i, f"{f:016x}", least[r]) for (i, _, _), f, r in zip(ODD, fps, root)), key=repr)
    assert rows(simhash.near_duplicates(odd), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.distinct_documents(odd)
    assert kept.count() == len(set(root)) and kept.columns == odd.columns


@pytest.mark.parametrize("max_shard", [20_000, 100, 10])
def test_links_of_dense_fingerprints(spark, max_shard):
    rng, fps = random.Random(3), set()
    for _ in range(15):
        base = rng.getrandbits(64)
        for _ in range(100):
            x = base
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(map(simhash.signed, fps))
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    sharded = simhash.shards(df, 4, max_shard)
    roots = {r.node: r.root for r in components.connected_components(simhash.links(sharded), "a", "b").collect()}
    want = brute_components([x % 2**64 for x in fps])
    assert [roots.get(x, x) for x in fps] == [fps[r] for r in want]


def test_components_of_a_long_chain(spark):
    n = 300
    df = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(1000, 1001), (1001, 1001)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.connected_components(df, "a", "b").collect()}
    assert got == {k: 0 for k in range(1, n + 1)} | {1001: 1000}


# 6 benchmark windows

def windows_of(items, n=10):
    out = {}
    for item, text in items:
        w = index_words(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            out.setdefault(tuple(w[i:i + n]), set()).add(item)
    return out


def index_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_contamination(docs, items):
    win = windows_of(items)
    out = []
    for i, t in docs:
        w, hit, found = index_words(t), set(), set()
        for n in {len(x) for x in win}:
            for k in range(len(w) - n + 1):
                if (x := win.get(tuple(w[k:k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= {str(y) for y in x if y is not None}
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, PASSAGE[:200]), (2, "word"), (3, None), (10, " ".join(LONG.split()[50:75])), (None, "the the the"), (2, "Word"), (21, "... !"),
         (22, "never seen words here"), (30, PASSAGE.upper())]


def test_contamination(spark, odd, none):
    bench = spark.createDataFrame([(i, t, "c") for i, t in ITEMS], "item_id bigint, text string, key string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute_contamination([(i, t) for i, t, _ in ODD], ITEMS)
    assert rows(decontaminate.contamination(odd, bench), *columns) == want
    assert rows(decontaminate.contamination(odd, bench, slop=0), *columns) == want
    clean = decontaminate.clean_documents(odd, bench)
    assert clean.columns == odd.columns and clean.count() == sum(not r[5] for r in want)
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(odd, bench.limit(0)).where("contaminated").count() == 0


def test_blocks_of_windows_find_the_same(spark, odd, monkeypatch):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = rows(decontaminate.contamination(odd, bench), "doc_id", "n_hit", "items_sha256")
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 20)
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", 0)
    assert rows(decontaminate.contamination(odd, bench), "doc_id", "n_hit", "items_sha256") == want


def test_proximity(spark):
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliet"
    near = item.replace("delta", "delta extra")
    far = "alpha bravo one two three four five six seven eight nine charlie delta"
    docs = documents(spark, [(1, "x y " + item, "a"), (2, "x y " + near, "a"), (3, far, "a"), (4, "unlike", "a")])
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    out = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert out[1].contaminated and not out[2].contaminated and out[2].n_near > 0
    assert out[3].n_near == out[4].n_near == 0


# 7 token counts

def greedy(word, pieces):
    n, k = 0, 0
    longest = max(map(len, pieces))
    while k < len(word):
        for e in range(min(len(word), k + longest), k, -1):
            if word[k:e] in pieces:
                n, k = n + 1, e
                break
        else:
            n, k = n + len(word[k].encode()), k + 1
    return n


def test_token_counts(spark, odd, none):
    pieces = token_counts.load_pieces()
    known = set(pieces)
    want = sorted(((i, len(ws(t)), sum(greedy("▁" + w, known) for w in ws(t))) for i, t, _ in ODD), key=repr)
    assert rows(token_counts.count_tokens(odd, pieces), "doc_id", "n_words", "n_tokens") == want
    assert token_counts.count_tokens(none, pieces).count() == 0


def test_automaton_against_greedy():
    rng = random.Random(2)
    for _ in range(60):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 14))}
        of = token_counts.Automaton(pieces)
        for _ in range(60):
            word = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 14)))
            # a character that no piece has alone counts its bytes, as an unknown one does
            assert of.count(word) == greedy(word, pieces)


# 8 chat formatting

CHATS = [(1, 0, "user", "a <|im_end|> \\ <\\| <|"), (1, 1, "assistant", "<|im_start|>assistant\nok\\\\"), (2, 1, "assistant", "no start"),
         (2, 1, "assistant", "no start"), (3, None, None, None), (3, 0, "sys\ntem<\\n>", "x"), (None, 0, "user", "<\\n>"), (4, 0, "system", "s"),
         (4, 1, "user", ""), (4, 2, "assistant", "yes\n"), (4, 3, "tool", "{}"), (4, 4, "assistant", "done 😀")]


def test_chats(spark):
    df = spark.createDataFrame([(*r, "z") for r in CHATS], "conv_id bigint, turn int, role string, text string, turns string")
    out = {r.conv_id: r for r in chat.chat_digest(chat.format_chats(df)).collect()}
    for conv in {r[0] for r in CHATS}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in CHATS if c == conv))
        text = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        got = out[conv]
        assert (got.n_turns, got.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c: r.valid for c, r in out.items()} == {1: True, 2: False, 3: False, None: False, 4: True}
    texts = [r.formatted for r in chat.format_chats(df).collect()]
    assert all(t.count("<|") == 2 * t.count("<|im_start|>") for t in texts)
    assert chat.chat_digest(chat.format_chats(df.limit(0))).count() == 0


def test_chats_with_very_long_and_odd_texts(spark):
    rng = random.Random(12)
    long = "".join(rng.choice(["<|im_end|>", "\\\\", "<", "|", "ab ", "é😀", "\n"]) for _ in range(120_000))
    data = [(1, 0, "user", long), (1, 1, "assistant", long[::-1]), (2, 0, "user", ""), (2, 1, "assistant", None), (2, 1, "assistant", "x"),
            (3, None, "user", "first"), (3, 0, "assistant", "<|")]
    schema = "conv_id bigint, turn int, role string, text string"
    plain = spark.createDataFrame(data, schema)
    clashing = spark.createDataFrame([(*r, 1, "f", True, [1], 2, "s") for r in data],
                                     schema + ", n_turns int, formatted string, valid boolean, turns array<int>, loss_chars int, state string")
    want = {}
    for c in (1, 2, 3):
        turns = sorted((t is not None, t or 0, r, x or "") for i, t, r, x in data if i == c)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        want[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest(), len(loss),
                   hashlib.sha256(loss.encode()).hexdigest())
    for df in (plain, clashing):
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.chat_digest(chat.format_chats(df)).collect()}
        assert got == want


def test_components_of_odd_links(spark):
    links = spark.createDataFrame([(1, 2), (2, 1), (2, 2), (3, 2), (None, 4), (5, None), (7, 6), (7, 6)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.connected_components(links, "a", "b").collect()}
    assert got == {2: 1, 3: 1, 7: 6}
    assert components.connected_components(links.limit(0), "a", "b").count() == 0


# 9 licences

def test_licenses(spark, odd, none):
    shouted = "Copyright (c) 2020 Someone\n\n" + licenses.MIT.upper().replace(",", " ;").replace("LICENSE", "LICENCE")
    docs = documents(spark, [(1, shouted, "a"), (2, "Some text.\nReleased under the MIT Licence\nmore", "a"), (3, licenses.ISC + "\n\nand more", "a"),
                             (4, "Released under the MIT License and so on.", "a"), (5, None, None), (5, None, None), (6, licenses.APACHE_NOTICE, "b")])
    out = {r.doc_id: (r.licenses, r.text_license) for r in licenses.scan_licenses(docs).collect()}
    assert out == {1: ("MIT", "MIT"), 2: ("MIT", None), 3: ("", None), 4: ("", None), 5: ("", None), 6: ("Apache-2.0", "Apache-2.0")}
    assert licenses.scan_licenses(docs).count() == 7 and licenses.scan_licenses(odd).count() == len(ODD)
    assert licenses.scan_licenses(none).count() == 0


def test_license_runs_of_paragraphs(spark, odd, none):
    mark = "Copyright (c) 2020 Someone\n\n"
    docs = documents(spark, [
        (1, "MIT License\n\n" + mark + licenses.MIT, "a"), (2, "The MIT License (MIT)\n" + licenses.MIT, "a"),
        (3, licenses.ISC + "\n\nand more", "a"), (4, "Some code.\n\n" + mark + licenses.APACHE_NOTICE + "\n\nimport os\n\nimport re", "b"),
        (5, licenses.MIT.replace("\n\n", "\n\nA word.\n\n"), "b"), (6, None, None), (7, "MIT License", "a"), (8, licenses.MIT.split("\n\n")[0], "a"),
        (9, licenses.ISC + "\n\n" + licenses.MIT, "a")])
    out = {r.doc_id: (r.licenses, r.text_license) for r in licenses.scan_licenses(docs, runs=True).collect()}
    assert out == {1: ("MIT", "MIT"), 2: ("MIT", "MIT"), 3: ("ISC", None), 4: ("Apache-2.0", None), 5: ("", None), 6: ("", None),
                   7: ("", None), 8: ("", None), 9: ("ISC,MIT", None)}
    assert licenses.scan_licenses(odd, runs=True).count() == len(ODD) and licenses.scan_licenses(none, runs=True).count() == 0


# 10 personal data

def brute_base(text):
    """The contract's patterns as they stand."""
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(sum(divmod(x * (1 + k % 2), 10)) for k, x in enumerate(reversed(d))) % 10 == 0:
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found, key=lambda x: (x[1], pii.BASE.index(x[0])))


def test_personal_data(spark, odd, none, table):
    rng = random.Random(4)
    noise = ["".join(rng.choice("a@.+1 2-9(5)_%é") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts = noise + [t for _, t in table] + ["a@b.c_d@e.f", "x@@y.z", "1.2.3.4.5.6.7.8", "0001.2.3.4 999.1.1.1", "4111 1111-1111 1111", "1" * 5000,
                                             "+1 (988) 555-2485 +1", "4111111111111111-", "@a.b", "a@b.c.d@e.f.g"]
    for t in texts:
        assert [s[:3] for s in pii.spans(t) if s[0] in pii.BASE] == brute_base(t), t
    out = pii.personal_data_digest(pii.find_personal_data(documents(spark, [(k, t, "s") for k, t in enumerate(texts)])))
    for r in out.collect():
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in brute_base(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert pii.find_personal_data(odd).count() == len(ODD) and pii.find_personal_data(none).count() == 0


def test_checksums_and_scores():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    assert pii.spans("IBAN GB82 WEST 1234 5698 7654 32.") == [("iban", 5, 32, 1.0)]
    text = "my e-mail a@b.cd and a version 1.2.3.4"
    (*_, near), (*_, far) = pii.spans(text)
    assert near == 1.0 and far < 0.6


@pytest.mark.parametrize("text, found", [
    ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", ["DE89 3704 0044 0532 0130 00"]),
    ("DE89370400440532013000 BIC: COBADEFFXXX", ["DE89370400440532013000"]),
    ("GB82 WEST 1234 5698 7654 32 I paid", ["GB82 WEST 1234 5698 7654 32"]),
    ("DE89 3704 0044 0532 0130 00 2024 was", ["DE89 3704 0044 0532 0130 00"]),
    ("AB12 DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32", ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"]),
    ("NO93 8601 1117 947 NO 4", ["NO93 8601 1117 947"]), ("MT84MALT011000012345MTLCAST001S X", ["MT84MALT011000012345MTLCAST001S"]),
    ("DE89 3704 0044 0532 0130 01 BIC", []), ("DE89370400440532013000BIC", []), ("DE89 3704 0044 0532 0130 00", ["DE89 3704 0044 0532 0130 00"])])
def test_ibans_before_capitals_and_digits(text, found):
    assert [text[s:e] for k, s, e, _ in pii.spans(text) if k == "iban"] == found


def test_iban_of_an_unregistered_code():
    body = "XX", "12345678901234"
    check = next(f"{k:02}" for k in range(100) if pii.mod97(f"{body[0]}{k:02}{body[1]}"))
    iban = body[0] + check + body[1]
    assert pii.spans(f"account {iban} AB, paid")[-1][:3] == ("iban", 8, 8 + len(iban)) and "XX" not in pii.IBAN_LENGTH


# plans of the operators that use built-in functions only

@pytest.mark.parametrize("name", ["op1_line_quality", "op6_decontaminate", "op8_chat_format", "op9_license_scan"])
def test_native_operators_run_no_python(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in plan


# one very long text

def test_very_long_text(spark):
    rng = random.Random(9)
    lines = [sentence(rng, 25) for _ in range(6000)]
    text = "\n".join(lines + lines[100:140]) + "\nmail a.b@c.de from 10.0.0.1"
    docs = documents(spark, [(1, text, "a"), (2, lines[7], "a"), (3, None, None)])
    q = {r.doc_id: r for r in quality.line_quality(docs).collect()}[1]
    assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == base_counts(text)
    got = rows(suffix_dedup.remove_repeats(docs), *COLUMNS4)
    assert got == brute_repeats([(1, text), (2, lines[7]), (3, None)], 400) and got[0][2] > 0
    assert simhash.near_duplicates(docs).where("doc_id = 1").first().fingerprint == f"{brute_fingerprint(text):016x}"
    bench = spark.createDataFrame([(1, lines[5999]), (2, lines[3])], "item_id bigint, text string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute_contamination([(1, text), (2, lines[7]), (3, None)], [(1, lines[5999]), (2, lines[3])])
    assert rows(decontaminate.contamination(docs, bench), *columns) == want
    known = set(token_counts.load_pieces())
    counts = {w: greedy("▁" + w, known) for w in set(ws(text))}
    assert token_counts.count_tokens(docs, sorted(known)).where("doc_id = 1").first().n_tokens == sum(counts[w] for w in ws(text))
    found = pii.personal_data_digest(pii.find_personal_data(docs)).where("doc_id = 1").first()
    assert (found.n_email, found.n_ip) == (1, 1)
    assert licenses.scan_licenses(docs).where("doc_id = 1").first().n_units == len(set(lines)) + 2
    assert sum(r["size"] for r in sharding.assign_shards(docs, shards=2).collect()) == len(text) + len(lines[7]) + 48
    assert {r.doc_id: r.taken for r in mixing.mix_digest(docs).collect()}.keys() == {1, 2, 3}
