"""The queries over the driver's tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, language_model, toxicity
from .best_fit import pack_best_fit
from .common import crc32_of_id, table
from .decontamination import decontaminate
from .html_extraction import extract_main_text
from .jaccard_join import join_components
from .lexical_search import top_documents
from .licenses import TEMPLATES, scan_licenses
from .packing import pack_documents
from .periodic_runs import find_runs
from .token_counts import count_tokens
from .topk_search import top_k

Query = Callable[[SparkSession, str], DataFrame]


def op1_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed whole into sequences of at most 2048 tokens; a null text is its end alone."""
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a null id is not held out and not learned from."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held = F.coalesce(crc32_of_id() % 4 == 2, F.lit(False))
    trees = language.train(docs, F.crc32(F.col("id").cast("string").cast("binary")) % 4 != 2)
    return language.identify(docs, trees).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under a similarity of 0.8 of five-word shingles."""
    return join_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a null id is not held out and not learned from."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.train(docs, labels, crc32_of_id() % 5 != 0)
    return toxicity.score(docs, model).select("doc_id", F.coalesce(crc32_of_id() % 5 == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["last"] - h["first"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op7_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    found = scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select(
        "doc_id",
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0)).alias("best_dice"),
    )


def op8_topk_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op9_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; a null id is not held out and not learned from."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    crc = lambda c: F.crc32(c.cast("string").cast("binary"))
    scored = language_model.score_texts(docs, lambda c: crc(c) % 10 != 0)
    held = F.coalesce(crc(F.col("doc_id")) % 10 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words of every text, in one tenth of the texts with one stretch of them repeated to the end.

    A null id plants nothing.
    """
    h = crc32_of_id()
    g, n, p = F.floor(h / 10), F.col("n"), F.col("p")
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    sized = words.select("*", F.size("words").alias("n")).select("*", F.when(n > 0, g % n).cast("int").alias("a"))
    cycled = sized.select("*", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int").alias("p"))
    rest = n - F.col("a")
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, p), F.ceil(rest / p).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), rest)), " ")
    return cycled.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, with digests of all runs and of the text without repeats; null texts have no words."""
    found = find_runs(planted_runs(table(spark, sf_dir, "documents", "doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    named = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return named.select(
        "doc_id",
        "n_runs",
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"),
        F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens, only longer ones cut; a null text is its end alone."""
    return pack_best_fit(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_ranked_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item; a null or empty text, of either, takes no part."""
    return top_documents(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


QUERIES: dict[str, Query] = {
    "op1_host_paths": op1_host_paths,
    "op2_vector_packing": op2_vector_packing,
    "op3_ppm_language": op3_ppm_language,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_toxicity_trees": op5_toxicity_trees,
    "op6_benchmark_windows": op6_benchmark_windows,
    "op7_license_dice": op7_license_dice,
    "op8_topk_lists": op8_topk_lists,
    "op9_maxent_lm": op9_maxent_lm,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sum_of_squares": op12_sum_of_squares,
    "op13_ranked_lexical": op13_ranked_lexical,
}

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32 of a decimal id, byte by byte and bit by bit.
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS bigint), list_transform(string_split(CAST({} AS varchar), ''), lambda x: CAST(ascii(x) AS bigint))), lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 1, 2, 3, 4, 5, 6, 7] AS bigint[])), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"

ORACLE_SQL: dict[str, str] = {
    "op11_periodic_runs": rf"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o, {_CRC.format("doc_id")} AS h FROM documents),
placed AS (SELECT *, len(o) AS n, CASE WHEN h % 10 = 0 AND len(o) > 0 THEN (h // 10) % len(o) END AS a FROM split),
cycled AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
docs AS (
  SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN o ELSE list_transform(range(n), lambda i: o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM cycled),
words AS (SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS word FROM docs),
equal AS (
  SELECT x.rid, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS g FROM equal) GROUP BY rid, q, g),
runs AS (SELECT rid, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY rid, start, length),
best AS (
  SELECT rid, start, length, period FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY length DESC, start, period) AS r FROM runs) WHERE r = 1),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY rid),
dropped AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS line FROM (SELECT * FROM words ANTI JOIN dropped USING (rid, i)) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(line, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)""",
    "op13_ranked_lexical": rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS bigint) AS n_terms FROM docs WHERE len(w) > 0),
items AS (
  SELECT DISTINCT item_id, list_sort(list_distinct(regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS w FROM benchmark),
numbered AS (SELECT row_number() OVER () AS iid, item_id, w FROM items),
asked AS (SELECT iid, item_id, unnest(w) AS term FROM numbered),
tfs AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM docs) GROUP BY rid, doc_id, n, term),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
parts AS (
  SELECT iid, item_id, rid, doc_id, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS bigint) * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS s
  FROM asked JOIN tfs USING (term) JOIN dfs USING (term), total),
scored AS (SELECT iid, item_id, rid, doc_id, CAST(sum(s) AS bigint) AS score FROM parts GROUP BY iid, item_id, rid, doc_id)
SELECT item_id, CAST(rank AS integer) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10""",
    "op6_benchmark_windows": rf"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS varchar) AS item_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, sizes WHERE len(w) >= k)),
found AS (SELECT g.rid, g.k, g.i, x.item_id FROM grams g JOIN windows x ON g.k = x.k AND g.s = x.s),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM found) GROUP BY rid),
seen AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS joined FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (rid) LEFT JOIN seen USING (rid)""",
    "op8_topk_lists": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS double)) AS bigint)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS bigint) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS integer) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 20""",
    "op7_license_dice": rf"""
WITH clean AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_replace(coalesce(text, ''), '(^|\n)[ \t]*(?:[Cc][Oo][Pp][Yy][Rr][Ii][Gg][Hh][Tt]|\([Cc]\)|©)(?:[^.!?\n]|[.!?][^ \t\r\n.!?])*[.!?]*', '\1', 'g') AS t FROM documents),
parts AS (
  SELECT DISTINCT rid, unnest(list_concat(list_concat(regexp_extract_all(t, '(?:[^.!?\n]|[.!?][^ \t\r\n.!?])+[.!?]*'), string_split(t, chr(10))), list_concat(string_split_regex(t, '\n[ \t\r]*\n'), [t]))) AS p FROM clean),
words AS (SELECT rid, p, regexp_extract_all({_FOLD.format("p")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM parts),
sized AS (SELECT rid, row_number() OVER () AS pid, w FROM words WHERE len(w) > 1 AND len(w) <= 1000),
own AS (SELECT pid, b, count(*) AS c FROM (SELECT pid, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM sized) GROUP BY pid, b),
templates AS (SELECT row_number() OVER () AS tid, name, regexp_extract_all({_FOLD.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (VALUES {", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in TEMPLATES)}) AS v(name, text)),
theirs AS (SELECT tid, b, count(*) AS c FROM (SELECT tid, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM templates) GROUP BY tid, b),
shared AS (SELECT pid, tid, sum(least(o.c, t.c)) AS s FROM own o JOIN theirs t USING (b) GROUP BY pid, tid),
scored AS (SELECT rid, pid, name, 2 * s / (len(z.w) - 1 + len(t.w) - 1) AS dice FROM shared JOIN sized z USING (pid) JOIN templates t USING (tid)),
best AS (SELECT rid, name, dice FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY dice DESC, name) AS r FROM scored WHERE dice >= 0.8) WHERE r = 1),
per AS (SELECT rid, count(*) AS n, max(dice) AS best, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM best GROUP BY rid)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(names, '') AS licenses, CAST(coalesce(best, 0) AS double) AS best_dice FROM clean LEFT JOIN per USING (rid)""",
}
