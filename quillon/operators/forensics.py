"""Group-by forensics of pair tables: dominance, ranges, distinct counts, top words."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import quantiles

from quillon.functions.text import tokens


def group_range(rows: DataFrame, group: str, value: str) -> DataFrame:
    return rows.groupBy(group).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n")).withColumn("span", F.col("high") - F.col("low"))


def distinct_per_group(rows: DataFrame, group: str, value: str, approximate: bool = False) -> DataFrame:
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return rows.groupBy(group).agg(counter(value).alias("n_distinct"), F.count("*").alias("n"))


def value_counts(rows: DataFrame, column: str, n: int = 20) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column)).limit(n)


def top_words(rows: DataFrame, group: str, text: str, k: int) -> DataFrame:
    """The most frequent tokens per group, ties in alphabetical order."""
    counts = rows.select(group, F.explode(tokens(F.col(text))).alias("word")).groupBy(group, "word").agg(F.count("*").alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), F.asc("word")))).where(F.col("place") <= k)


def null_rates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: share of nulls and whether it holds one value only."""
    wide = rows.agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"{c}|0") for c in columns), *((F.min(c).eqNullSafe(F.max(c))).alias(f"{c}|1") for c in columns))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.round(F.coalesce(F.try_divide(F.col(f"`{c}|0`").cast("double"), F.col("n").cast("double")), F.lit(0.0)), 6).alias("null_rate"), F.col(f"`{c}|1`").cast("int").alias("constant")) for c in columns)))
    return wide.select(each.alias("x")).select("x.*")


def above_quantile(rows: DataFrame, column: str, p: float) -> DataFrame:
    """Rows at or above the exact quantile of the column; none of a column of nulls."""
    found = quantiles(rows, column, {"cut": p}).first()
    cut = found.cut if found else None
    return rows.where(F.col(column) >= F.lit(cut)).withColumn("cut", F.round(F.lit(cut).cast("double"), 6))


def _shortened(word: Column, distance: int, prefix: int) -> Column:
    """The first ``prefix`` letters of a word, and all that is left of them without up to ``distance`` letters."""
    without_one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
    found = level = F.array(F.substring(word, 1, prefix))
    for _ in range(distance):
        level = F.array_distinct(F.flatten(F.transform(F.filter(level, lambda w: F.length(w) > 0), without_one)))
        found = F.concat(found, level)
    return F.array_distinct(found)


def spelling_index(dictionary: DataFrame, word: str = "word", count: str = "n", distance: int = 2, prefix: int = 10) -> DataFrame:
    """(left, entry, count): every dictionary word under all that is left of its prefix without up to ``distance`` letters.

    Write it where it is asked more than once.  Two words within ``distance``
    edits share what is left of their first ``prefix`` letters after as many
    deletions, so a word has at most 1 + p + p (p - 1) / 2 rows for two edits.
    """
    return dictionary.where(F.col(word).isNotNull()).select(F.explode(_shortened(F.col(word), distance, prefix)).alias("left"), F.col(word).alias("entry"), F.col(count).alias("count"))


def nearest_spelling(words: DataFrame, word: str, dictionary: DataFrame, distance: int = 2, prefix: int = 10) -> DataFrame:
    """(word, corrected, edits): the dictionary word within ``distance`` edits: the nearest, then the most frequent, then the first; else the word itself and -1.

    ``dictionary`` is a table of (word, n) of any size.  Words meet its entries
    by what both leave after deletions, and only those that meet are compared
    letter by letter.  One row per distinct word; a null stays null.
    """
    asked = words.select(word).distinct()
    left = asked.where(F.col(word).isNotNull()).select(F.col(word).alias("_word"), F.explode(_shortened(F.col(word), distance, prefix)).alias("left"))
    met = left.join(spelling_index(dictionary, distance=distance, prefix=prefix), "left").select("_word", "entry", "count").distinct()
    near = met.withColumn("edits", F.levenshtein("_word", "entry", distance)).where("edits >= 0")
    best = near.groupBy("_word").agg(F.min(F.struct("edits", (-F.col("count")).alias("rank"), "entry")).alias("best"))
    found = asked.join(best, F.col(word) == F.col("_word"), "left")
    return found.select(word, F.coalesce("best.entry", word).alias("corrected"), F.coalesce("best.edits", F.lit(-1)).alias("edits"))


class _Variants:
    """Variants of one text: words replaced by a synonym half of the time, then left out at a given rate.

    Draws depend on the seed, the key and the number of the try alone.
    """

    def eval(self, key: str, text: str, synonyms: dict, wanted: int, dropout: float, seed: str):
        words, seen = (text or "").split(), set()
        for attempt in range(3 * wanted):
            if len(seen) == wanted or not words:
                return
            draw = random.Random(f"{seed}:{key}:{attempt}")
            said = [draw.choice(synonyms[w]) if synonyms and w in synonyms and draw.random() < 0.5 else w for w in words]
            if len(said) > 1:
                said = [w for w in said if draw.random() > dropout] or [draw.choice(said)]
            variant = " ".join(said)
            if variant != text and variant not in seen:
                seen.add(variant)
                yield len(seen), variant


def augmented_texts(rows: DataFrame, key: str, text: str, synonyms: DataFrame, copies: int = 1, dropout: float = 0.1, seed: str = "0") -> DataFrame:
    """The rows' columns, ``copy`` and ``augmented``: up to ``copies`` distinct variants of each text, from a table function.

    ``synonyms`` is a table of (word, synonym); a text takes the synonyms of its
    own words along.  A text without a variant other than itself in three tries
    per copy gives fewer rows, an empty or null one none.  Rows depend on key and
    text, not on partitions; rows of one key draw alike.
    """
    spark = rows.sparkSession
    lists = synonyms.groupBy("word").agg(F.array_sort(F.collect_set("synonym")).alias("synonyms"))
    said = rows.select(F.col(key).alias("_key"), F.explode(F.array_distinct(F.split(F.col(text), r"\s+"))).alias("word")).distinct()
    own = said.join(lists, "word").groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("word", "synonyms"))).alias("_synonyms"))
    with_own = rows.join(own, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    spark.udtf.register("text_variants", F.udtf(_Variants, returnType="copy int, augmented string"))
    call = f"text_variants(CAST(r.`{key}` AS string), r.`{text}`, r._synonyms, {int(copies)}, CAST({float(dropout)} AS double), '{seed}')"
    return spark.sql(f"SELECT r.*, v.* FROM {{rows}} r, LATERAL {call} v", rows=with_own).drop("_synonyms")
