"""Sentiment from a fitted lexicon.

Word weights come from the ratings: a tip is positive if its business is rated above the mean of all training reviews, else
negative, and a word's weight is the smoothed log-odds of its occurrences in positive and negative tips. Up to
:data:`WINDOW` words after a negation in the same clause count as other words, marked ``not_``. The fitted
lexicon holds the words that are frequent and whose log-odds differ from zero by ``z`` standard errors.

Words are counted in one distributed aggregate with partial sums, so a word in every tip is no hot key. The lexicon joins the
words of the tips by word; the planner broadcasts it where it measures small.

Defined cases: null text has no words; tips of businesses without ratings fit nothing but are scored; ties of the mean are
positive; without tips or ratings the lexicon is empty and every score 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions import columns as X

# Words that negate, and how many words after them they reach.
NEGATIONS = ("no", "nor", "not", "never", "cannot", "without", "ne", "pas", "nicht", "kein", "nunca")
WINDOW = 3
CLAUSE = r"[.,;:!?\n]+"
WORD_SPLIT = "[^a-z]+"
#: Smoothing (added to each count), fewest occurrences of a word, standard errors from zero.
ALPHA, MIN_COUNT, Z = 1.0, 5, 1.96


def marked_words(text) -> Column:
    """The words of a text in order, those in a negation's window marked with ``not_``."""
    text = F.col(text) if isinstance(text, str) else text
    clean = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "n['’]t", " not")
    clauses = F.transform(F.split(clean, CLAUSE), lambda c: F.filter(F.split(c, WORD_SPLIT), lambda w: w != ""))
    negating = F.array(*[F.lit(w) for w in NEGATIONS])

    def marked(words: Column) -> Column:
        def mark(word: Column, i: Column) -> Column:
            before = F.slice(words, F.greatest(F.lit(1), i - WINDOW + 1), F.least(i, F.lit(WINDOW)))
            return F.when(F.arrays_overlap(before, negating), F.concat(F.lit("not_"), word)).otherwise(word)
        return F.transform(words, mark)

    return F.flatten(F.transform(clauses, marked))


def with_words(tips: DataFrame) -> DataFrame:
    """``tips`` with their :func:`marked_words` as ``words`` instead of the text. Stored, they are marked once for fitting and scoring."""
    return tips.withColumn("words", marked_words("text")).drop("text")


def words_of(tips: DataFrame) -> Column:
    return F.col("words") if "words" in tips.columns else marked_words("text")


def business_labels(reviews: DataFrame) -> DataFrame:
    """business_id, positive: whether the mean rating of the business reaches the mean of all reviews."""
    stars = F.col("stars").cast("double")
    overall = reviews.agg(F.avg(stars)).scalar()
    means = reviews.groupBy("business_id").agg(F.avg(stars).alias("mean")).filter(F.col("mean").isNotNull())
    return means.withColumn("_all", overall).select("business_id", (F.col("mean") >= F.col("_all")).alias("positive"))


def fit_lexicon(tips: DataFrame, reviews: DataFrame, alpha: float = ALPHA, min_count: int = MIN_COUNT, z: float = Z) -> DataFrame:
    """word, n_pos, n_neg, weight (smoothed log-odds), z, of the words that pass ``min_count`` and ``z``."""
    labelled = tips.select("business_id", "words" if "words" in tips.columns else "text").join(business_labels(reviews), "business_id")
    words = labelled.select("positive", F.explode(words_of(tips)).alias("word"))
    counts = words.groupBy("word").agg(F.count_if("positive").alias("n_pos"), F.count_if(~F.col("positive")).alias("n_neg"))
    totals = counts.agg(F.struct(F.sum("n_pos").alias("pos"), F.sum("n_neg").alias("neg"), F.count(F.lit(1)).alias("words"))).scalar()
    pos, neg, mass = F.col("n_pos") + alpha, F.col("n_neg") + alpha, alpha * F.col("_t.words")
    weight = F.ln(pos / (F.col("_t.pos") + mass)) - F.ln(neg / (F.col("_t.neg") + mass))
    scored = counts.withColumn("_t", totals).select("word", "n_pos", "n_neg", weight.alias("weight"),
                                                    (weight / F.sqrt(1 / pos + 1 / neg)).alias("z"))
    return scored.filter((F.col("n_pos") + F.col("n_neg") >= min_count) & (F.abs("z") >= z))


def score_tips(tips: DataFrame, lexicon: DataFrame, key: list[str]) -> DataFrame:
    """``key``, tokens, score_sum, score_avg per ``key`` of the tips, by the weights of ``lexicon``."""
    words = tips.select(*key, F.explode_outer(words_of(tips)).alias("word"))
    return (words.join(lexicon.select("word", F.col("weight").cast("double").alias("weight")), "word", "left").groupBy(*key)
            .agg(F.count("word").alias("tokens"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("score_sum"))
            .select(*key, "tokens", "score_sum", X.safe_ratio(F.col("score_sum"), F.col("tokens")).alias("score_avg")))


def held_out(key) -> Column:
    """A hash of the key sets about a fifth of the tips aside."""
    return F.substring(F.md5(F.col(key) if isinstance(key, str) else key), 1, 2) < F.lit("33")


def sign_test(tips: DataFrame, reviews: DataFrame, **options) -> DataFrame:
    """n, agree, share: of the held-out tips (by business) whose score is not 0, those whose sign is that of their business; the
    lexicon is fitted on the other tips."""
    fitted = fit_lexicon(tips.filter(~held_out("business_id")), reviews, **options)
    scores = score_tips(tips.filter(held_out("business_id")), fitted, ["business_id"]).filter("score_sum <> 0")
    met = scores.join(business_labels(reviews), "business_id")
    agree = F.count_if((F.col("score_sum") > 0) == F.col("positive"))
    return met.agg(F.count(F.lit(1)).alias("n"), agree.alias("agree")).select("n", "agree", F.try_divide("agree", "n").alias("share"))
