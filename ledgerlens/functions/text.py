"""Text column expressions.

All are built-in Spark expressions: they stay in whole-stage codegen and
never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def lowered(c) -> Column:
    """Lower-case text; null -> ''."""
    return F.lower(F.coalesce(as_col(c).cast("string"), F.lit("")))


def clean_text(c) -> Column:
    """B1: null -> ''; lower; all but [a-z0-9] to spaces; whitespace collapsed; trimmed.

    White space and other characters end up as the same single space, so one pass
    over runs of both does it (a class negating a shorthand like \\s is many times slower).
    """
    return F.trim(F.regexp_replace(lowered(c), r"[^a-z0-9]+", " "))


# Fixed value: Unicode's White_Space characters, as the pattern (?U)\s has them.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_ws(c) -> Column:
    """Strip leading/trailing Unicode whitespace (``trim`` strips spaces unless told more; a pattern would visit every character)."""
    return F.trim(as_col(c), F.lit(WHITE_SPACE))


def text_length(c) -> Column:
    """Number of characters; null stays null."""
    return F.length(as_col(c))


def word_count(c) -> Column:
    """Number of words separated by Unicode whitespace; null stays null."""
    c = as_col(c)
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(F.size(words))


# Keyword groups of the general category (B10), in rule order; first hit wins.
GENERAL_CATEGORY_RULES = (
    ("Transport/Fahrzeuge", ("auto", "leasing", "car", "vehicle", "transportation", "ground transportation")),
    ("Immobilien/Miete", ("lease", "rent", "real estate", "base rent", "store management")),
    ("Bau/Handwerk", ("construction", "contractor", "site clean", "building")),
    ("Personal/HR", ("labor", "contingent", "human resources", "employee", "staffing")),
    ("Reisen/Bewirtung", ("travel", "entertainment", "hotel", "flight", "meal")),
    ("Marketing/Design", ("artworking", "typesetting", "production", "packaging design", "smap", "prototype")),
    ("Events/Promotion", ("event", "promotion", "trade show", "talent", "artists")),
    ("Sonstige Dienstleistungen", ("services", "corporate services")),
)
GENERAL_CATEGORY_DEFAULT = "Sonstiges"


def general_category(c, rules=GENERAL_CATEGORY_RULES, default: str = GENERAL_CATEGORY_DEFAULT) -> Column:
    """First rule whose keyword is a substring of the lowered text; null -> default."""
    low = F.lower(F.coalesce(as_col(c), F.lit("")))
    expr = None
    for category, words in rules:
        hit = None
        for w in words:
            cond = low.contains(w)
            hit = cond if hit is None else (hit | cond)
        expr = F.when(hit, F.lit(category)) if expr is None else expr.when(hit, F.lit(category))
    return expr.otherwise(F.lit(default))


def preview(c, n: int = 100) -> Column:
    """First n characters followed by '...'."""
    return F.concat(F.substring(as_col(c), 1, n), F.lit("..."))


def combined_text(seller, client, items) -> Column:
    """Seller + ' ' + client + ' ' + items; blanks keep their separators."""
    e = F.lit("")
    return F.concat(
        F.coalesce(as_col(seller), e), F.lit(" "), F.coalesce(as_col(client), e), F.lit(" "),
        F.coalesce(as_col(items), e),
    )


def tokens(cleaned) -> Column:
    """Words of two or more characters of a cleaned text (only [a-z0-9] and single spaces remain)."""
    return F.filter(F.split(as_col(cleaned), " "), lambda t: F.length(t) >= 2)


def ngrams(toks, n_max: int = 2) -> Column:
    """Unigrams then bigrams (space joined) of a token array, in text order."""
    toks = as_col(toks)
    out = toks
    if n_max >= 2:
        k = F.greatest(F.size(toks) - 1, F.lit(0))
        bigrams = F.zip_with(F.slice(toks, 1, k), F.slice(toks, 2, k), lambda a, b: F.concat(a, F.lit(" "), b))
        out = F.concat(out, bigrams)
    return out


def add_terms(df, text_col: str, out: str = "terms", n_max: int = 2):
    """B1 + G4 + G5 on a DataFrame: tokens are a column of their own, so cleaning and splitting run once per row
    (the n-gram expression refers to the token array five times)."""
    x = df.withColumn("_tok", tokens(clean_text(F.col(text_col))))
    return x.withColumn(out, ngrams(F.col("_tok"), n_max)).drop("_tok")
