"""Benchmark decontamination with a positional inverted index (operator 6, built-in functions only).

Benchmark items are cut into windows of consecutive words. The index holds the postings (term, text, position) of the
corpus for the terms that a search starts from: the rarest of each window, by their counts in the whole corpus.

Phrases: postings of a window's two rarest places are aligned to where the window would begin and must meet there; what is
left is compared with all words of the window, in the text's own row.

Proximity: a window is near in a text if at least ``NEAR_SHARE`` of its distinct words stand in some stretch of
``slop`` words more on either side than the window has (a shorter text is one stretch), and the text does not hold it as
a phrase. If m of its d distinct words may be missing, any m + 2 of them leave two in such a stretch, so pairs of
the window's m + 2 rarest words (one word, if one is enough) that stand as near as in a stretch miss no match. The text is cut
into blocks, and only those where such a stretch can begin are cut from the texts and compared.

The postings lie by text and block of places, and terms are looked up by a hash. The index is keyed by a hash of the text, so copies of a
text are looked up once; a clash of two texts adds candidates that the comparison turns down and loses none; near windows
(``n_near``) are counted by that hash. Benchmark windows are searched in blocks of a fixed size, written one by one, and only
such a block, or a vocabulary, whose measured size is under a bound, is broadcast.

Defined cases: null text has no words; an item without words has no window, a shorter one than a window is one window;
a null item_id counts for hits but not among the items; repeated rows of either table change nothing but repeat their
own output; a text of any length is searched whole; words of equal count rank in order of their place (phrases) or the
word (proximity), which changes no result; empty tables give no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ratewise.llm.scratch import broadcast_if_small, new_path, written
from ratewise.llm.text import ascii_lower, let

WINDOW = 10
SLOP = 3
#: A proximity match has at least this share of the window's distinct words.
NEAR_SHARE = 0.8
BLOCK_WINDOWS = 50_000
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same between words that still have their A-Z.
BETWEEN_GIVEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """``ascii_lower``, by the faster ``lower`` where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text))


def index_words(text: Column) -> Column:
    """Words of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


def given_words(text: Column) -> Column:
    """The words of ``index_words``, as many and in the same places, before they are lower-cased."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_GIVEN_WORDS), "")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """wid, words, items: the distinct windows and the items (as strings) that have them."""
    ws = benchmark.select(F.col(item_col).cast("string").alias("item"), index_words(F.col(text_col)).alias("ws")).where("size(ws) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("ws") - (window - 1)))
    cut = ws.select("item", "ws", F.explode(starts).alias("i")).select("item", F.slice("ws", F.col("i"), window).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item").alias("items")).select(F.xxhash64("words").alias("wid"), "words", "items")


def term_of(word: Column) -> Column:
    """The number that a word is looked up by, a hash; a clash of two words adds candidates and loses none."""
    return F.xxhash64(word)


def term_counts(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """term, n: occurrences in the whole corpus of each of ``terms`` that occurs."""
    found = docs.select(F.explode(given_words(F.col(text_col))).alias("word")).select(term_of(lowered(F.col("word"))).alias("term"))
    return found.join(broadcast_if_small(terms, "term"), "term").groupBy("term").agg(F.count("*").alias("n"))


def positional_index(docs: DataFrame, text_col: str, terms: DataFrame, width: int) -> DataFrame:
    """key, block, terms: the postings of ``terms`` by text and block of two ``width`` places; blocks begin every ``width`` places.
    The array has the term of each place of the block, null where it is none of ``terms``; copies of a text share theirs."""
    # The hashes in a step of their own: beside posexplode, the whole text would be hashed once a word.
    texts = docs.select(text_key(F.col(text_col)).alias("key"), F.hash(text_col).alias("other"), F.col(text_col).alias("text"))
    found = texts.select("key", "other", F.posexplode(given_words(F.col("text"))).alias("pos", "word"))
    found = found.select("key", "other", "pos", term_of(lowered(F.col("word"))).alias("term")).join(broadcast_if_small(terms, "term"), "term")
    block = F.floor(F.col("pos") / width).cast("int")
    found = found.select("key", "other", "pos", "term", F.explode(F.array(block - 1, block)).alias("block")).where("block >= 0")
    found = found.select("key", "other", "block", "term", (F.col("pos") - F.col("block") * width).alias("at"))
    # A column a place, so that partial sums of a fixed size take in the copies of a text; the second hash keeps texts apart that
    # clash in the first.
    places = [F.max(F.when(F.col("at") == i, F.col("term"))).alias(f"t{i}") for i in range(2 * width)]
    return found.groupBy("key", "other", "block").agg(*places).select("key", "block", F.array(*[f"t{i}" for i in range(2 * width)]).alias("terms"))


def rarest_places(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """wid, places, rank (1: rarest), term, off: the two rarest places of each window whose words all occur in the corpus."""
    places = windows.select("wid", F.size("words").alias("places"), F.posexplode("words").alias("off", "word"))
    of = W.partitionBy("wid")
    ranked = places.withColumn("term", term_of(F.col("word"))).join(counts, "term").select(
        "wid", "places", "term", "off", F.row_number().over(of.orderBy("n", "off")).alias("rank"), F.count("*").over(of).alias("known"))
    return ranked.where("rank <= 2 AND known = places").drop("known")


def needed(words: Column) -> Column:
    """Distinct words that a proximity match must have."""
    return F.ceil(F.size(F.array_distinct(words)) * F.lit(NEAR_SHARE)).cast("int")


def rare_pairs(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """wid, a, b: pairs (a <= b) of the terms of the rarest distinct words of each window, of as many as leave two of them in any
    match; words that the corpus lacks are the rarest. Where one word makes a match, the word with itself."""
    terms = windows.select("wid", needed(F.col("words")).alias("need"), F.array_distinct("words").alias("terms"))
    terms = terms.select("wid", F.least("need", F.lit(2)).alias("least"), (F.size("terms") - F.col("need")).alias("missing"),
                         F.explode("terms").alias("word"))
    rank = F.row_number().over(W.partitionBy("wid").orderBy(F.coalesce("n", F.lit(0)), "word"))
    rare = (terms.withColumn("term", term_of(F.col("word"))).join(counts, "term", "left").withColumn("rank", rank)
            .where("n IS NOT NULL AND rank <= missing + least"))
    rare = rare.groupBy("wid", "least").agg(F.sort_array(F.collect_list("term")).alias("terms"))  # two words with one hash stay two
    first = rare.select("wid", "least", "terms", F.posexplode("terms").alias("i", "a"))
    return (first.select("wid", "a", "least", "i", F.posexplode(F.slice("terms", F.col("i") + 1, F.size("terms"))).alias("j", "b"))
            .where("least < 2 OR j > 0").select("wid", "a", "b").distinct())


def pair_of(a: Column, b: Column) -> Column:
    """The number of a pair of terms, in either order; a clash adds candidates and loses none."""
    return F.xxhash64(F.least(a, b), F.greatest(a, b))


def phrase_candidates(index: DataFrame, rarest: DataFrame, width: int) -> DataFrame:
    """key, wid, start: where the lists of a window's two rarest places (of its only one) have one beginning."""
    # Each place is in the first half of one block.
    met = index.select("key", "block", F.posexplode(F.slice("terms", 1, width)).alias("at", "term")).where("term IS NOT NULL")
    met = met.join(broadcast_if_small(rarest, "term"), "term").select(
        "key", "wid", (F.col("block") * width + F.col("at") - F.col("off")).alias("start"), "places")
    both = met.where("start >= 0").groupBy("key", "wid", "start").agg(F.count("*").alias("n"), F.min("places").alias("places"))
    return both.where("n >= 2 OR places = 1").select("key", "wid", "start")


def near_blocks(index: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """key, block, wid: blocks with a pair of a window's rarest words within ``width`` places, so that a near stretch may begin in
    their first half."""
    first = index.select("key", "block", "terms", F.posexplode("terms").alias("i", "a")).where("a IS NOT NULL")
    both = first.select("key", "block", "a", F.explode(F.slice("terms", F.col("i") + 1, width)).alias("b")).where("b IS NOT NULL")
    wanted = pairs.select(pair_of(F.col("a"), F.col("b")).alias("pair"), "wid")
    met = both.select("key", "block", pair_of(F.col("a"), F.col("b")).alias("pair")).join(broadcast_if_small(wanted, "pair"), "pair")
    return met.select("key", "block", "wid").distinct()


def near_windows(docs: DataFrame, text_col: str, blocks: DataFrame, windows: DataFrame, slop: int, width: int) -> DataFrame:
    """key, wid, start: the windows near in a text, phrases included, and where the first stretch that shows it begins."""
    wanted = written(blocks.groupBy("key").agg(F.collect_set(F.struct("block", "wid")).alias("wanted")), "wanted")
    texts = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text")).join(wanted, "key")
    pieces = texts.select("key", index_words(F.col("text")).alias("ws"), "wanted").select("key", "ws", F.explode("wanted").alias("at"))
    pieces = pieces.select("key", "at.block", "at.wid", F.slice("ws", F.col("at.block") * width + 1, 2 * width).alias("piece"))
    terms = windows.select("wid", F.array_distinct("words").alias("terms"), needed(F.col("words")).alias("need"),
                           (F.size("words") + 2 * slop).alias("size"))
    met = pieces.join(broadcast_if_small(terms, F.array_join("terms", " ")), "wid")

    def enough(words: Column) -> Column:
        return F.size(F.array_intersect("terms", words)) >= F.col("need")

    met = met.where(enough(F.col("piece")))
    firsts = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: enough(F.slice("piece", i + 1, F.col("size"))))
    # Written, so that AQE can split a text with very many copies in the join; grouping by the text's key there would not let it.
    met = written(met.select("key", "wid", (F.col("block") * width + F.get(firsts, F.lit(0))).alias("start")), "near-found")
    return met.where("start IS NOT NULL").groupBy("key", "wid").agg(F.min("start").alias("start"))


def candidates(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", window: int = WINDOW, slop: int = SLOP, proximity: bool = True) -> DataFrame:
    """``docs`` (columns as given, in struct ``_row``) with met (start, words, items of each place where a phrase may begin) and,
    with ``proximity``, near as in ``search``."""
    windows = written(benchmark_windows(benchmark, item_col, item_text_col, window), "windows")
    terms = written(windows.select(F.explode("words").alias("word")).select(term_of(F.col("word")).alias("term")).distinct(), "terms")
    counts = written(term_counts(docs, text_col, terms), "term-counts")
    places = written(rarest_places(windows, counts), "places")
    starts = places.select("term")
    if proximity:
        pairs = written(rare_pairs(windows, counts), "pairs")
        starts = starts.union(pairs.select(F.explode(F.array("a", "b"))))
    width = window + 2 * slop
    index = written(positional_index(docs, text_col, starts.distinct(), width), "postings")
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    phrases, nears = [], []
    for k in range(blocks):
        of = F.pmod("wid", F.lit(blocks)) == k
        phrases.append(new_path(docs.sparkSession, "phrases"))
        phrase_candidates(index, places.where(of), width).write.parquet(phrases[-1])
        if proximity:
            nears.append(new_path(docs.sparkSession, "near"))
            near_blocks(index, pairs.where(of), width).write.parquet(nears[-1])
    met = docs.sparkSession.read.parquet(*phrases).join(windows, "wid")
    # Written, so that the join below has a plain shuffle on both sides and AQE can split a text with very many copies.
    by_text = met.groupBy("key").agg(F.collect_list(F.struct("start", "words", "items")).alias("met"))
    if proximity:
        near = near_windows(docs, text_col, docs.sparkSession.read.parquet(*nears), windows, slop, width)
        near = written(near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "wid"))).alias("near")), "near-by-text")
        by_text = by_text.join(near, "key", "full")
    by_text = written(by_text, "met")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_key(F.col(text_col)).alias("key"))
    more = [empty_if_null(by_text, "near")] if proximity else []
    return rows.join(by_text, "key", "left").select("_row", empty_if_null(by_text, "met"), *more)


def phrase_hits(text: Column) -> Column:
    """Those of ``met`` whose words all stand in ``text``; a text without any is not cut into words."""
    def exact(words: Column) -> Column:
        return F.filter("met", lambda c: F.slice(words, c["start"] + 1, F.size(c["words"])) == c["words"])

    return F.when(F.size("met") > 0, let(index_words(text), exact)).otherwise(F.col("met"))


def search(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", proximity: bool = True, **columns) -> DataFrame:
    """``docs`` (columns as given, in struct ``_row``) with words, hits (start, words, items of each phrase match) and, with
    ``proximity``, near: (start, wid) of each window near in the text, those that are phrases too."""
    text = F.col("_row")[text_col]
    found = candidates(docs, benchmark, text_col=text_col, proximity=proximity, **columns)
    return found.select("_row", index_words(text).alias("words"), phrase_hits(text).alias("hits"), *(["near"] if proximity else []))


def empty_if_null(table: DataFrame, column: str) -> Column:
    return F.coalesce(column, F.array().cast(table.schema[column].dataType)).alias(column)


def covered(hits: Column) -> Column:
    """Words inside any of ``hits``."""
    spans = F.sort_array(F.transform(hits, lambda h: F.struct(h["start"].alias("s"), F.size(h["words"]).alias("n"))))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("int").alias("end"))

    def add(a: Column, h: Column) -> Column:
        end = F.greatest(a["end"], (h["s"] + h["n"]).cast("int"))
        return F.struct((a["n"] + end - F.greatest(a["end"], h["s"].cast("int"))).cast("bigint").alias("n"), end.alias("end"))

    return F.aggregate(spans, zero, lambda a, h: let(add(a, h), lambda x: x), lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and n_near (windows near in the text, but no phrase of it)."""
    text = F.col("_row")[text_col]
    out = candidates(docs, benchmark, text_col=text_col, **columns)
    out = out.select("_row", F.size(given_words(text)).cast("bigint").alias("n_words"), phrase_hits(text).alias("hits"), "near")
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    # Every phrase is also near, so the phrases are the part of the near windows to leave out.
    phrases = F.size(F.array_distinct(F.transform("hits", lambda h: h["words"])))
    out = out.select(F.col("_row")[id_col].alias("doc_id"), "n_words",
                     covered(F.col("hits")).alias("n_hit"), items.alias("items"), (F.size("near") - phrases).cast("bigint").alias("n_near"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """The documents without any window of the benchmark, with the columns of ``docs``."""
    return search(docs, benchmark, proximity=False, **columns).where("size(hits) = 0").select("_row.*")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark) WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM b)),
p AS (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM w)),
h AS (SELECT rid, i, n, g, item_id FROM (SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM p) JOIN w USING (n, g)),
hg AS (SELECT DISTINCT rid, g FROM h),
c AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM h, range(10) AS o(k) WHERE k < n GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY rid),
tok AS (SELECT rid, unnest(ws) AS term, unnest(range(len(ws))) AS pos FROM d),
v AS (SELECT g, list_distinct(string_split(g, ' ')) AS wd, len(string_split(g, ' ')) + 6 AS width FROM (SELECT DISTINCT g FROM w)),
vt AS (SELECT g, unnest(wd) AS term FROM v),
able AS (SELECT rid, g FROM (SELECT DISTINCT rid, term FROM tok) JOIN vt USING (term) JOIN v USING (g) GROUP BY ALL
         HAVING count(*) >= 0.8 * any_value(len(wd))),
nr AS (SELECT rid, count(DISTINCT g) AS n_near FROM able JOIN v USING (g) JOIN vt USING (g) JOIN tok USING (rid, term) JOIN d USING (rid)
       WHERE len(list_intersect(wd, ws[pos + 1:pos + width])) >= 0.8 * len(wd)
         AND (rid, g) NOT IN (SELECT rid, g FROM hg) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid) LEFT JOIN nr USING (rid)
"""
