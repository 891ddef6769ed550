"""Column functions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` only,
so it stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace removed by Python's str.strip() for the characters that occur in
# category lists (Q24); Spark's plain trim only removes spaces.
WHITESPACE = " \t\n\r\x0b\x0c"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_parts(x) -> Column:
    """Number of comma-separated parts, 0 for null or '' (Q7)."""
    x = _c(x)
    return F.when(x.isNull() | (x == ""), F.lit(0)).otherwise(F.size(F.split(x, ",")))


def year_prefix(x) -> Column:
    """First four characters as an int, null when not a number."""
    return F.substring(_c(x), 1, 4).try_cast("int")


def default(x, value) -> Column:
    """Value or a constant when missing."""
    return F.coalesce(_c(x), F.lit(value))


def any_part_in(x, words: tuple[str, ...]) -> Column:
    """True when any trimmed, lower-cased comma part equals one of ``words``."""
    x = _c(x)
    parts = F.split(F.coalesce(x, F.lit("")), ",")
    return F.exists(parts, lambda p: F.lower(F.btrim(p, F.lit(WHITESPACE))).isin(*words))


def text_length(x) -> Column:
    """Length in code points of text, '' when null."""
    return F.length(F.coalesce(_c(x), F.lit("")))


def at_least_one(x) -> Column:
    """Guarded denominator max(1, x)."""
    return F.greatest(F.lit(1), _c(x))


def safe_ratio(num, den) -> Column:
    """Division that yields 0 instead of failing or null on a zero/null denominator (Q13)."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))


def clip_rating(x, lo: float = 1.0, hi: float = 5.0) -> Column:
    """Bound to the rating range."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), _c(x)))


def round_half_up(x, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d with plain double arithmetic.

    Values of 2^53 / 10^d and above, where doubles have no such digits left, stay as
    they are (``floor`` would send them through a bigint). Cheaper than ``round`` on
    doubles, which makes a BigDecimal per value."""
    x, m = _c(x), float(10 ** digits)
    return F.when(F.abs(x) < 2.0 ** 53 / m, F.floor(x * m + 0.5) / m).otherwise(x)


def round1(x) -> Column:
    """Round to one decimal (half-up)."""
    return F.round(_c(x), 1)


def rating_band(x) -> Column:
    """< 2.5 poor, < 3.5 acceptable, else great."""
    x = _c(x)
    return (F.when(x < 2.5, F.lit("poor"))
            .when(x < 3.5, F.lit("acceptable"))
            .otherwise(F.lit("great")))


# The glyphs of the star display.
FULL_STAR = "★"
HALF_STAR = "½"
EMPTY_STAR = "☆"


def star_glyphs(x) -> Column:
    """X11: integer part as full stars, a half star when the fraction is >= .5,
    empty stars up to five."""
    x = _c(x)
    full = F.floor(x).cast("int")
    half = (x - F.floor(x)) >= 0.5
    n_half = F.when(half, F.lit(1)).otherwise(F.lit(0))
    empty = F.greatest(F.lit(0), F.lit(5) - full - n_half)
    return F.concat(F.repeat(F.lit(FULL_STAR), F.greatest(full, F.lit(0))),
                    F.repeat(F.lit(HALF_STAR), n_half),
                    F.repeat(F.lit(EMPTY_STAR), empty))


def title_words(x) -> Column:
    """'_' -> ' ' then upper-case the first letter of each word (Python title())."""
    return F.initcap(F.regexp_replace(_c(x), "_", " "))


def true_attributes(attrs, n: int = 5) -> Column:
    """Names of attributes whose value is true, titled, sorted, first n, joined by ', '."""
    trues = F.map_keys(F.map_filter(_c(attrs), lambda k, v: F.lower(v) == "true"))
    names = F.array_sort(F.transform(trues, title_words))
    return F.array_join(F.slice(names, 1, n), ", ")


def true_attributes_variant(attrs, n: int = 5) -> Column:
    """X12 over a ``variant``: the boolean true and the text 'True' count, text 'true' does not."""
    members = F.try_variant_get(_c(attrs), F.lit("$"), "map<string,variant>")

    def true(k, v):
        t = F.schema_of_variant(v)
        return (((t == "BOOLEAN") & F.try_variant_get(v, F.lit("$"), "boolean"))
                | ((t == "STRING") & (F.try_variant_get(v, F.lit("$"), "string") == "True")))
    trues = F.map_keys(F.map_filter(members, true))
    return F.array_join(F.slice(F.array_sort(F.transform(trues, title_words)), 1, n), ", ")


# Fixed value: the date that stands in for a missing one.
MISSING_SINCE = "2020-01-01"


def tenure_years(since, as_of_date: str) -> Column:
    """Days from a 'yyyy-MM-dd' date to ``as_of_date`` / 365, 0 when it does not parse
    (a value with a time part does not parse, as in the reference). A missing date
    counts as MISSING_SINCE."""
    since = F.coalesce(_c(since), F.lit(MISSING_SINCE))
    parsed = F.try_to_timestamp(since, F.lit("yyyy-M-d"))
    days = F.datediff(F.to_date(F.lit(as_of_date)), F.to_date(parsed))
    ok = F.regexp_like(since, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$"))
    return F.when(ok & parsed.isNotNull(), days / F.lit(365.0)).otherwise(F.lit(0.0))


def attribute_code(value) -> Column:
    """X14 over a string-valued attribute: true/yes/free (any case) -> 1; a JSON object
    -> 1 if any member is true; other text -> 0; missing -> 0."""
    v = _c(value)
    lowered = F.lower(F.btrim(v, F.lit(WHITESPACE)))
    nested_true = F.exists(
        F.map_values(F.from_json(v, "map<string,string>")), lambda e: F.lower(e) == "true")
    return (F.when(v.isNull(), F.lit(0.0))
            .when(lowered.isin("true", "yes", "free"), F.lit(1.0))
            .when(F.startswith(F.btrim(v, F.lit(WHITESPACE)), F.lit("{")),
                  F.when(F.coalesce(nested_true, F.lit(False)), F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(0.0)))


def attribute_code_variant(attrs, key: str) -> Column:
    """X14 over a ``variant`` attribute object, keeping JSON types apart:
    boolean -> 1/0; text true/yes/free (any case) -> 1, other text -> 0; an object
    -> 1 when a member is the boolean true; a number -> its value; else 0."""
    v = F.try_variant_get(_c(attrs), F.lit(f"$.{key}"), "variant")
    t = F.schema_of_variant(v)
    text = F.lower(F.btrim(F.try_variant_get(v, F.lit("$"), "string"), F.lit(WHITESPACE)))
    members = F.map_values(F.try_variant_get(v, F.lit("$"), "map<string,variant>"))
    any_true = F.exists(members, lambda m: (F.schema_of_variant(m) == "BOOLEAN")
                        & F.try_variant_get(m, F.lit("$"), "boolean"))
    numeric = t.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE") | t.startswith("DECIMAL")
    return (F.when(v.isNull(), F.lit(0.0))
            .when(t == "BOOLEAN", F.try_variant_get(v, F.lit("$"), "boolean").cast("double"))
            .when(t == "STRING", F.when(text.isin("true", "yes", "free"), F.lit(1.0)).otherwise(F.lit(0.0)))
            .when(t.startswith("OBJECT"), F.when(F.coalesce(any_true, F.lit(False)), F.lit(1.0))
                  .otherwise(F.lit(0.0)))
            .when(numeric, F.try_variant_get(v, F.lit("$"), "double"))
            .otherwise(F.lit(0.0)))


def attribute_coder(df):
    """Function from an attribute name to its X14 code, for the type of ``df.attributes``."""
    if isinstance(df.schema["attributes"].dataType, T.VariantType):
        return lambda key: attribute_code_variant("attributes", key)
    return lambda key: attribute_code(F.element_at(F.col("attributes"), F.lit(key)))


def short_id(x, n: int = 8) -> Column:
    """First n characters of an id."""
    return F.substring(_c(x), 1, n)


def numbered_name(name, prefix: str, number) -> Column:
    """A name or ``prefix + number`` when missing."""
    return F.coalesce(_c(name), F.concat(F.lit(prefix), _c(number).cast("string")))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km (earth radius 6371 km)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(2 * 6371.0) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
