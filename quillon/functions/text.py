"""Text normalisation, tokenizers and token-set similarities as Column expressions.

Three tokenizers exist on purpose: features fold accents, retrieval keeps them,
and query intent also trims punctuation and joins hyphens first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that a token may hold.
TOKEN = "[a-zA-ZçğıöşüÇĞİÖŞÜ0-9]+"
#: Accented letters and what they fold to; the combining dot (U+0307) is deleted.
ACCENTED = "çğıöşüâîûàáäãåèéêëìíïòóôõùúñÿýœæßø"
FOLDED = "cgiosuaiuaaaaaeeeeiiioooouunyyoaso"
UNKNOWN = ("", "unknown", "nan", "none", "null", "-")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def normalize_text(c: Column) -> Column:
    """Lower case, white space collapsed and trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.lower(text_or_empty(c)), r"\s+", " "))


def ascii_fold(c: Column) -> Column:
    return F.translate(normalize_text(c), ACCENTED + "̇", FOLDED)


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def tokens(c: Column) -> Column:
    """Folded tokens, in order."""
    return _all(ascii_fold(c), TOKEN)


def token_set(c: Column) -> Column:
    return F.array_distinct(tokens(c))


def retrieval_tokens(c: Column) -> Column:
    """Tokens with their accents."""
    return _all(normalize_text(c), TOKEN)


def normalize_token(c: Column, fold: bool = False) -> Column:
    """Strip, lower-case, turn _ and - into spaces and trim punctuation."""
    spaced = F.regexp_replace(F.lower(F.trim(text_or_empty(c))), r"[_\-\s]+", " ")
    bare = F.regexp_replace(spaced, r"""^[ ,.;:()\[\]{}"']+|[ ,.;:()\[\]{}"']+$""", "")
    return F.trim(F.translate(bare, ACCENTED + "̇", FOLDED)) if fold else bare


def intent_tokens(c: Column) -> Column:
    return _all(normalize_token(c, fold=True), TOKEN)


def slug(c: Column) -> Column:
    """Runs of other than a-z and 0-9 become _; nothing left becomes 'unknown'."""
    bare = F.regexp_replace(F.regexp_replace(ascii_fold(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(bare == "", "unknown").otherwise(bare)


def turkish_lower(c: Column) -> Column:
    """Lower case with dotted and dotless i told apart."""
    return F.lower(F.translate(text_or_empty(c), "İI", "iı"))


def clean_turkish(c: Column) -> Column:
    """Turkish lower case, punctuation to spaces, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(turkish_lower(c), r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))


def numeric_tokens(c: Column) -> Column:
    return F.array_distinct(_all(normalize_text(c), "[0-9]+"))


def is_unknown(c: Column) -> Column:
    return normalize_text(c).isin(*UNKNOWN)


def safe_div(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    return safe_div(shared(a, b), F.size(F.array_union(a, b)))


def coverage(a: Column, b: Column) -> Column:
    """Share of ``a`` that ``b`` holds."""
    return safe_div(shared(a, b), F.size(a))


def token_set_ratio(a: Column, b: Column) -> Column:
    """1 if both are empty, 0 without overlap, else the best of the three overlap shares."""
    both = shared(a, b)
    best = F.greatest(safe_div(both, F.size(a)), safe_div(both, F.size(b)), safe_div(2 * both, F.size(a) + F.size(b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(both == 0, 0.0).otherwise(best)


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Distinct character n-grams of the folded text with _ for spaces; a shorter text is one n-gram."""
    s = F.replace(ascii_fold(c), F.lit(" "), F.lit("_"))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substr(s, i, F.lit(n)))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def longest_token_span(a: Column, b: Column) -> Column:
    """Length of the longest run of tokens that both arrays hold.

    ``aggregate`` carries one row of the dynamic programme: how long a common
    run ends at each place of ``b``.
    """
    start = F.struct(F.transform(b, lambda _: F.lit(0)).alias("row"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        row = F.transform(b, lambda y, j: F.when(y == x, F.when(j == 0, F.lit(0)).otherwise(F.get(acc["row"], j - 1)) + 1).otherwise(0))
        return F.struct(row.alias("row"), F.greatest(acc["best"], F.coalesce(F.array_max(row), F.lit(0))).alias("best"))

    return F.aggregate(a, start, step, lambda acc: acc["best"])


def symbol_density(c: Column) -> Column:
    """Share of characters that are neither letters, digits nor white space."""
    s = text_or_empty(c)
    return safe_div(F.length(F.regexp_replace(s, r"[\p{L}\p{N}\s]", "")), F.length(s))


def group_key(c: Column) -> Column:
    """Eight hexadecimal digits that stand for a text."""
    return F.substring(F.md5(text_or_empty(c)), 1, 8)


def config_hash(c: Column) -> Column:
    """The first twelve hexadecimal digits of a serialised configuration's SHA-1."""
    return F.substring(F.sha1(c), 1, 12)
