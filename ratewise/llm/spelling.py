"""Spelling variants grouped by PartEnum signatures (operator 12).

Words are near if they differ by one inserted, deleted or replaced code point. As a vector with a bit for each (letter,
how often so far), a word's letters then change in at most two bits: two for a replaced, one for an inserted letter. PartEnum
finds such vectors exactly: the bits are dealt into ``n1`` first-level parts, so that in one of them at most
``k2 = ceil((k + 1) / n1) - 1`` bits differ; this part is cut into ``n2`` pieces, and for one choice of ``n2 - k2`` pieces nothing
differs. A signature is such a choice with the bits in it. Words that share a signature meet in an equi-join and are
verified by their edit distance.

Two keys join a signature, so that words of the same letters do not all meet: the shorter word's length, and the first or the
second half of the word, as one edit leaves one of the halves as it is. Both are exact: no near pair is lost. Words
of one length need ``k = 2``, words whose lengths differ by one ``k = 1``.

Defined cases: null text has no words; a null id is hashed as no digits; repeated rows count again (their words' ``n`` grows);
ties of ``n`` go to the smaller word in code-point order; an empty table gives an empty result; extra columns are ignored; a
text of any length is read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.scratch import written

# What a run of letters is, the shortest word, the fewest occurrences, one run in so many loses a letter, and how
# many times as frequent a form must be.
RUN = "A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT, LOSES, TIMES = 7, 2, 31, 10
#: (n1, n2) of PartEnum for words of one length (two bits differ) and of lengths one apart (one bit differs).
REPLACED, INSERTED = (1, 4), (1, 3)
#: Distinct words that a task counts before it passes the counts on.
MEMORY = 1 << 17

SAME, SHORT, LONG = 0, 1, 2


def spelled(doc_id, run: str) -> str:
    """The result of a run in a document: A-Z lower-cased, and in one case of ``LOSES`` a code point deleted."""
    word = run.encode("utf-8", "surrogatepass").lower()
    h = crc32(f"{'' if doc_id is None else doc_id}:".encode() + word)
    word = word.decode("utf-8", "surrogatepass")
    if h % LOSES:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words of at least ``min_chars`` code points that occur ``min_count`` times or more."""
    runs = re.compile(f"[{RUN}]{{{min_chars},}}")  # a shorter run gives no word, as none gets longer

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for run, n in Counter(runs.findall(text.as_py() or "")).items():
                    word = spelled(doc_id, run)
                    if len(word) >= min_chars:
                        counts[word] += n
                if len(counts) >= MEMORY:
                    yield batch_of(counts)
                    counts.clear()
        if counts:
            yield batch_of(counts)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_bits(word: str) -> list[tuple[str, int]]:
    """The set bits of the letter multiset of ``word``: each letter with the number of its kind before it."""
    seen: Counter = Counter()
    bits = []
    for c in word:
        bits.append((c, seen[c]))
        seen[c] += 1
    return bits


def partenum(bits: list[tuple[str, int]], k: int, n1: int, n2: int) -> Iterator[str]:
    """PartEnum signatures of a bit vector: vectors that differ in at most ``k`` bits share one at least."""
    k2 = -(-(k + 1) // n1) - 1
    if n2 <= k2:
        raise ValueError("n2 must be above the number of bits that may differ in a part")
    pieces: list[list[str]] = [[] for _ in range(n1 * n2)]
    for c, nth in sorted(bits):
        pieces[(ord(c) + 7 * nth) % (n1 * n2)].append(f"{c}{nth}")
    for part in range(n1):
        for chosen in combinations(range(part, n1 * n2, n1), n2 - k2):
            yield f"{chosen}" + "|".join(",".join(pieces[p]) for p in chosen)


def signatures(word: str) -> Iterator[tuple[int, str]]:
    """(role, signature) of a word: as one of two of the same length, as the shorter and as the longer of two."""
    bits = letter_bits(word)
    h = len(word) // 2
    for s in partenum(bits, 2, *REPLACED):
        yield SAME, f"r{len(word)}<{word[:h]}{s}"
        yield SAME, f"r{len(word)}>{word[h:]}{s}"
    for s in partenum(bits, 1, *INSERTED):
        yield SHORT, f"i{len(word)}<{word[:h]}{s}"
        yield SHORT, f"i{len(word)}>{word[h:]}{s}"
        g = (len(word) - 1) // 2
        yield LONG, f"i{len(word) - 1}<{word[:g]}{s}"
        yield LONG, f"i{len(word) - 1}>{word[g + 1:]}{s}"


def near_words(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every two of the distinct ``words`` (word, n) that are near, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, roles, found = [], [], []
            for k, word in enumerate(batch.column(0).to_pylist()):
                for role, s in signatures(word):
                    at.append(k)
                    roles.append(role)
                    found.append(s)
            of = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(roles, pa.int32()), batch.column(0).take(of),
                                              batch.column(1).take(of)], ["signature", "role", "word", "n"])

    signed = words.select("word", "n").mapInArrow(run, "signature string, role int, word string, n bigint")
    signed = written(signed.select(F.xxhash64("signature").alias("key"), "role", "word", "n"), "signatures")
    left = signed.where(F.col("role") != LONG).select("key", F.col("role").alias("a_role"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = signed.where(F.col("role") != SHORT).select("key", F.col("role").alias("b_role"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = left.join(right, "key").where(((F.col("a_role") == SHORT) & (F.col("b_role") == LONG)) |
                                        ((F.col("a_role") == SAME) & (F.col("b_role") == SAME) & (F.col("a") < F.col("b"))))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """word, root of ``forms`` (word, form): the last word reached. Every round doubles the way; a form is ``TIMES`` times as
    frequent as its word, so ways are short and have no circle."""
    edges = written(forms.select(F.col("word").alias("_at"), F.col("form").alias("_to")), "forms")
    state = edges.select(F.col("_at").alias("word"), F.col("_to").alias("root"))
    while True:
        onward = state.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        step = written(state.join(onward, state.root == F.col("_at"), "left").select(
            "word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), "roots")
        state = step.select("word", "root")
        if step.where("moved").isEmpty():
            return state


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES) -> DataFrame:
    """word, n, n_near (its near words), form (the most frequent of them, if ``times`` as frequent, else null), form_n and
    root (the last of the forms followed from the word; the word itself if it has none), one row per word."""
    words = written(word_counts(docs, id_col, text_col), "words")
    pairs = written(near_words(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= times * F.col("n")
    rows = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n")), "word-forms")
    roots = last_forms(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: DuckDB SQL of the registered query, from the contract: CRC-32 bit by bit, near words by what is left and right of the edit.
ORACLE = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY k) AS t FROM (
    SELECT k, list_reduce(list_prepend(k::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(k))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(key)), lambda i: ('0x' || hex(key)[2 * i + 1:2 * i + 2])::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS key, run, n FROM runs), crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gaps AS (SELECT word, n, i, word[1:i] AS l, word[i + 2:] AS r FROM (SELECT *, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.l || a.r = b.word
  UNION
  SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.l || a.r = b.word),
best AS (SELECT word, count(*) AS n_near, min(row(-near_n, near)) AS b FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b[1] >= 10 * w.n THEN b[2] END AS form,
         CASE WHEN -b[1] >= 10 * w.n THEN -b[1] END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
ways AS (
  SELECT word, word AS at, form AS onward FROM forms
  UNION ALL
  SELECT ways.word, f.word, f.form FROM ways JOIN forms f ON ways.onward = f.word)
SELECT f.word, f.form, ways.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN ways USING (word) WHERE ways.onward IS NULL
"""
