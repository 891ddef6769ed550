"""Quality rules: line-first cleaning (operator 1, built-in functions only).

Every line of a document is judged by itself by punctuation, navigation and boilerplate rules. Failing lines are
removed; a document that loses too large a part of its words that way is rejected. Before that, document-level base
rules look at length and at repeated word triples. All work is done inside one row, so there is no shuffle.

Defined cases: null text counts as empty text (no words, rejected as too short); repeated rows and ids each give one
row, and equal texts the same verdict (nothing is ranked, so there are no ties); a text of any length is judged whole, in its
own row; an empty table gives an empty result; extra columns are ignored by :func:`line_quality` and kept by
:func:`clean_documents`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.text import SPACE_RUN, SPACES, let, n_chars_of, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A document is rejected when more than this percentage of its words stands in failing lines.
MAX_LOST_PERCENT = 50

NAVIGATION_LINE = (r"^[^a-z]*(home|menu|log ?in|log ?out|sign ?in|sign ?up|next|previous|read more|show more|share|"
                   r"subscribe|search|contact us|about us|skip to content|back to top)[^a-z]*$")
SEPARATOR = r" [|>»•·] "
BOILERPLATE = ("javascript", "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
               "lorem ipsum", "click here", "enable cookies")
#: Lines of up to so many words are short. In a longer one, phrases must make up this percentage of the words at least.
SHORT_WORDS = 12
PHRASE_PERCENT = 25
TERMINAL = r"[.!?:;…\"'”’»)\]]$"


def line_fails(line: Column, n_words: Column, n_symbols: Column) -> Column:
    """True when ``line`` (trimmed, with that many words and symbols) fails a punctuation, navigation or boilerplate rule.

    Punctuation: more than one symbol or doubled exclamation mark per five words, upper-case letters beyond half of the
    characters, or fewer than five words without an end mark. Navigation: at most twelve words with two separators, or
    only a menu word. Boilerplate: a fixed phrase, if the line has at most SHORT_WORDS words or the phrases make up
    PHRASE_PERCENT of them. A line without words never fails.
    """
    low = F.lower(line)
    marks = n_symbols + F.regexp_count(line, F.lit("!!"))
    upper = F.regexp_count(line, F.lit(r"\p{Lu}"))
    punctuation = ((marks * 5 > n_words) | (upper * 2 > F.char_length(line) - n_words + 1)
                   | ((n_words < 5) & ~F.rlike(line, F.lit(TERMINAL))))
    navigation = ((n_words <= 12) & (F.regexp_count(line, F.lit(SEPARATOR)) >= 2)) | (
        (n_words <= 12) & F.rlike(low, F.lit(NAVIGATION_LINE)))
    mentioned = F.contains(low, F.lit(BOILERPLATE[0]))
    for phrase in BOILERPLATE[1:]:
        mentioned = mentioned | F.contains(low, F.lit(phrase))
    in_phrases = sum((F.regexp_count(low, F.lit(p)) * (p.count(" ") + 1) for p in BOILERPLATE), F.lit(0))
    boilerplate = F.when(mentioned, (n_words <= SHORT_WORDS) | (in_phrases * 100 >= n_words * PHRASE_PERCENT)).otherwise(False)
    return (n_words > 0) & (punctuation | navigation | boilerplate)


def repeated_words(ws: Column) -> Column:
    """Words covered by three-word windows that occur twice or more in the array ``ws`` (the first one included).

    If all windows have different hashes, none occurs twice. Else they are sorted by hash, words and position, so that
    equal ones are neighbours: n log n in the words of the document, words being compared only under equal hashes.
    """
    zero = F.lit(0).cast("bigint")

    def hashed(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        return let(F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
                   lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(count(w, h)))

    def count(w: Column, h: Column) -> Column:
        windows = F.transform(h, lambda x, i: F.struct(x.alias("h"), F.get(w, i).alias("col1"), F.get(w, i + 1).alias("col2"),
                                                       F.get(w, i + 2).alias("col3"), i.alias("i")))
        return let(F.sort_array(windows), covered)

    def covered(s: Column) -> Column:
        def same(j: Column, k: Column) -> Column:
            a, b = F.get(s, j), F.get(s, k)
            return F.coalesce((a["h"] == b["h"]) & (a["col1"] == b["col1"]) & (a["col2"] == b["col2"]) & (a["col3"] == b["col3"]), F.lit(False))
        repeated = F.filter(F.transform(s, lambda x, k: F.when(same(k, k - 1) | same(k, k + 1), x["i"])),
                            lambda i: i.isNotNull())
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(F.sort_array(repeated), start,
                           lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
                           lambda a: a["n"])

    return F.when(F.size(ws) < 3, zero).otherwise(let(ws, hashed))


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """One row per document: base counts, lines and words lost, cleaned text, ``base_failed`` and ``kept``."""
    return _judged(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")),
                   max_lost_percent).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_failed_lines", "words_lost", "clean_text")


def _judged(df: DataFrame, max_lost_percent: int) -> DataFrame:
    lines = F.split("_text", "\n")
    wordy = F.filter(lines, lambda l: F.btrim(l, F.lit(SPACES)) != "")
    info = F.transform(lines, lambda l: let(
        F.btrim(l, F.lit(SPACES)),
        lambda t: let(F.struct(F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE_RUN))).alias("n"),
                               n_chars_of(t, SYMBOLS).alias("s")),
                      lambda k: F.struct(l.alias("line"), k["n"].alias("n"), k["s"].alias("s"),
                                         line_fails(t, k["n"], k["s"]).alias("fails")))))
    df = df.select("*", words(F.col("_text")).alias("_words"), info.alias("_info"),
                   let(wordy, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))
    df = df.select(
        "*", F.size("_words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.aggregate("_info", F.lit(0).cast("bigint"), lambda a, x: a + x["s"]).alias("n_symbols"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.aggregate("_info", F.lit(0).cast("bigint"), lambda a, x: a + x["fails"].cast("bigint")).alias("n_failed_lines"),
        F.aggregate("_info", F.lit(0).cast("bigint"),
                    lambda a, x: a + F.when(x["fails"], x["n"]).otherwise(0)).alias("words_lost"),
        F.array_join(F.transform(F.filter("_info", lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("clean_text"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    df = df.select("*", base_failed.alias("base_failed"))
    return df.select("*", (~F.col("base_failed") & (F.col("words_lost") * 100 <= F.col("n_words") * max_lost_percent))
                     .alias("kept"))


def clean_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
                    max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """The kept documents with failing lines removed from their text; same columns as ``docs``.

    ``chars_col``, if present, is set to the code points of the cleaned text.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    out = _judged(docs.select(row, F.coalesce(F.col(text_col), F.lit("")).alias("_text")), max_lost_percent)
    fixed = {text_col: F.col("clean_text"),
             chars_col: F.char_length("clean_text").cast(docs.schema[chars_col].dataType) if chars_col in docs.columns else None}
    clean = F.struct(*[(fixed[c] if c in fixed else F.col("_row")[c]).alias(c) for c in docs.columns])
    # As a generator, not a filter: a filter is pushed below the columns it needs, which are then worked out twice.
    return out.select(F.inline(F.when(F.col("kept"), F.array(clean))))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS (SELECT row_number() OVER () AS rid, doc_id, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM r)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c >= 2),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, range(3) AS o(k) GROUP BY rid),
ln AS (SELECT rid, l, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS b
       FROM (SELECT rid, unnest(ls) AS l FROM r)),
lw AS (SELECT rid, l, b, len(regexp_split_to_array(b, '[\x20\x09-\x0D]+')) AS n,
              lower(b) AS low
       FROM ln WHERE b <> ''),
lf AS (SELECT rid, l, n,
         5 * (len(regexp_extract_all(b, '[#*$%&|<>]')) + len(regexp_extract_all(b, '!!'))) > n
         OR 2 * len(regexp_extract_all(b, '\p{Lu}')) > length(b) - n + 1
         OR (n < 5 AND NOT regexp_matches(b, '[.!?:;…"''”’»)\]]$'))
         OR (n <= 12 AND len(regexp_extract_all(b, ' [|>»•·] ')) >= 2)
         OR (n <= 12 AND regexp_matches(low, '^[^a-z]*(home|menu|log ?in|log ?out|sign ?in|sign ?up|next|previous|read more|show more|share|subscribe|search|contact us|about us|skip to content|back to top)[^a-z]*$'))
         OR (regexp_matches(low, 'javascript|cookie policy|privacy policy|terms of use|terms of service|all rights reserved|lorem ipsum|click here|enable cookies')
             AND (n <= 12 OR 25 * n <= 100 * (
               len(regexp_extract_all(low, 'javascript')) + 2 * len(regexp_extract_all(low, 'cookie policy|privacy policy|lorem ipsum|click here|enable cookies'))
               + 3 * len(regexp_extract_all(low, 'terms of use|terms of service|all rights reserved')))))
         AS fails FROM lw),
la AS (SELECT rid, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) FILTER (WHERE fails) AS n_failed_lines,
              coalesce(sum(n) FILTER (WHERE fails), 0) AS words_lost FROM lf GROUP BY rid),
c AS (SELECT r.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(n_failed_lines, 0) AS BIGINT) AS n_failed_lines, CAST(coalesce(words_lost, 0) AS BIGINT) AS words_lost
      FROM r LEFT JOIN cov USING (rid) LEFT JOIN la USING (rid)),
b AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM c)
SELECT *, NOT base_failed AND words_lost * 100 <= n_words * 50 AS kept FROM b
"""
