"""Queries: contracts, joins, texts, attributes, intent and pair features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import text as X
from quillon.functions.attributes import attribute_maps, category_parts, key_values, leaf_category, with_attributes
from quillon.functions.intent import add_query_intent, dictionaries_of, query_intent, segment
from quillon.operators import features, forensics, item_text, joins, negatives
from quillon.operators import retrieval as R
from quillon.operators.joins import cut
from quillon.sources.contracts import CONTRACTS, violations

from .catalog import Registry, cte, source, view

query = Registry()

ACCENTS = f"{X.ACCENTED}̇"
#: SQL of the text functions.
NORM = r"trim(regexp_replace(lower(coalesce({0}, '')), '\s+', ' ', 'g'))"
FOLD = f"translate({NORM}, '{ACCENTS}', '{X.FOLDED}')"
TOKENS = f"regexp_extract_all({FOLD}, '{X.TOKEN}')"
DIV = "CASE WHEN coalesce({1}, 0) = 0 THEN 0.0 ELSE CAST({0} AS double) / {1} END"


def _tok(c: str) -> str:
    return TOKENS.format(c)


def _div(a: str, b: str) -> str:
    return DIV.format(a, b)


def _both(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b}))"


def _wide(spark: SparkSession, d: str) -> DataFrame:
    return joins.star_join(view(spark, d, "pairs"), view(spark, d, "terms"), view(spark, d, "items"), check=False)


WIDE = cte("pairs", "terms", "items") + ",\nwide AS (SELECT * FROM pairs LEFT JOIN terms USING (term_id) LEFT JOIN items USING (item_id))"


@query(WIDE + " SELECT category, gender, CAST(sum(label) AS bigint) AS positives, count(*) AS n, round(avg(price), 6) AS mean_price FROM wide GROUP BY ALL")
def star_join_segments(spark, d):
    return _wide(spark, d).groupBy("category", "gender").agg(F.sum("label").alias("positives"), F.count("*").alias("n"), F.round(F.avg("price"), 6).alias("mean_price"))


@query(
    WIDE
    + """, repeats AS (SELECT term_id, item_id, count(*) AS n FROM pairs GROUP BY ALL), ids AS (SELECT id, count(*) AS n FROM pairs GROUP BY ALL)
SELECT count(*) AS n_rows, count_if(query IS NULL) AS missing_query, count_if(title IS NULL) AS missing_title, count_if(age_group IS NULL) AS missing_age_group,
  count_if(trim(coalesce(query, '')) = '') AS blank_query, count_if(trim(coalesce(title, '')) = '') AS blank_title, count_if(trim(coalesce(age_group, '')) = '') AS blank_age_group,
  count(DISTINCT term_id) AS unique_term_id, count(DISTINCT item_id) AS unique_item_id,
  (SELECT CAST(coalesce(sum(n), 0) AS bigint) FROM repeats WHERE n > 1) AS repeated_pair_rows, (SELECT CAST(coalesce(sum(n), 0) AS bigint) FROM ids WHERE n > 1) AS repeated_id_rows FROM wide"""
)
def star_join_quality(spark, d):
    return joins.join_quality(view(spark, d, "pairs"), _wide(spark, d), ["query", "title", "age_group"], ["term_id", "item_id"])


@query(
    cte("pairs")
    + """ SELECT 'repeated' AS "check", 'id' AS "column", CAST(sum(n) AS bigint) AS n FROM (SELECT id, count(*) AS n FROM pairs GROUP BY 1) WHERE n > 1 HAVING sum(n) > 0
UNION ALL SELECT 'repeated', 'term_id+item_id', CAST(sum(n) AS bigint) FROM (SELECT term_id, item_id, count(*) AS n FROM pairs GROUP BY ALL) WHERE n > 1 HAVING sum(n) > 0
UNION ALL SELECT 'not_positive', 'label', count_if(label <> 1) FROM pairs HAVING count_if(label <> 1) > 0"""
)
def contract_violations(spark, d):
    return violations(view(spark, d, "pairs"), CONTRACTS["training_pairs"], positive_only=True)


@query(cte("pairs") + " SELECT term_id, item_id, count(*) AS n FROM pairs GROUP BY ALL HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 10")
def duplicate_pairs(spark, d):
    return joins.repeated_keys(view(spark, d, "pairs"), ["term_id", "item_id"])


@query(cte("items") + r" SELECT item_id, trim(regexp_replace(concat_ws(' ', title, category, brand, gender, age_group, attributes), '\s+', ' ', 'g')) AS full_text FROM items")
def full_item_text(spark, d):
    return view(spark, d, "items").select("item_id", item_text.full_item_text().alias("full_text"))


@query(
    WIDE
    + """ SELECT id, concat_ws(' [SEP] ', '[QUERY] ' || query, '[TITLE] ' || title, '[BRAND] ' || brand, '[CATEGORY] ' || category) AS pair_text,
  concat_ws(' | ', title, brand, category, CASE WHEN age_group <> '' THEN age_group END) AS product_text FROM wide"""
)
def pair_text(spark, d):
    return _wide(spark, d).select("id", item_text.pair_text("title_brand_category").alias("pair_text"), item_text.product_text("title", "brand", "category", "age_group").alias("product_text"))


@query(
    cte("terms", "items")
    + f""", t AS (SELECT DISTINCT query, {_tok("query")} AS q FROM terms)
SELECT query, array_to_string(q, ' ') AS folded, len(q) AS n_tokens, len(list_distinct(q)) AS n_distinct, substr(md5(query), 1, 8) AS key,
  trim(regexp_replace(regexp_replace({FOLD.format("query")}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug FROM t"""
)
def query_tokens(spark, d):
    q = F.col("query")
    return view(spark, d, "terms").select("query").distinct().select("query", F.array_join(X.tokens(q), " ").alias("folded"), F.size(X.tokens(q)).alias("n_tokens"), F.size(X.token_set(q)).alias("n_distinct"), X.group_key(q).alias("key"), X.slug(q).alias("slug"))


_Q, _T = _tok("query"), _tok("title")


@query(
    WIDE
    + f""", s AS (SELECT id, list_distinct({_Q}) AS qs, list_distinct({_T}) AS ts, {_Q} AS q, {_T} AS t, {NORM.format("query")} AS qn, {NORM.format("title")} AS tn FROM wide)
SELECT id, {_both("qs", "ts")} AS overlap, round({_div(_both("qs", "ts"), "len(list_distinct(list_concat(qs, ts)))")}, 6) AS jaccard, round({_div(_both("qs", "ts"), "len(qs)")}, 6) AS query_coverage,
  round({_div(_both("qs", "ts"), "len(ts)")}, 6) AS title_coverage, CAST(qn <> '' AND contains(tn, qn) AS int) AS phrase, CAST(len(list_filter(q, lambda x: len(x) >= 4 AND contains(tn, x))) > 0 AS int) AS partial,
  CAST(list_contains(t[1:2], q[1]) AS int) AS early, round(CASE WHEN len(qs) = 0 AND len(ts) = 0 THEN 1.0 WHEN {_both("qs", "ts")} = 0 THEN 0.0
    ELSE greatest({_div(_both("qs", "ts"), "len(qs)")}, {_div(_both("qs", "ts"), "len(ts)")}, {_div("2 * " + _both("qs", "ts"), "(len(qs) + len(ts))")}) END, 6) AS token_set FROM s"""
)
def lexical_overlap_features(spark, d):
    f = features.lexical(split=True)
    names = {"overlap": "lex_token_overlap_count", "jaccard": "lex_token_overlap_ratio", "query_coverage": "lex_query_coverage_ratio", "title_coverage": "lex_title_coverage_ratio", "phrase": "lex_exact_phrase_match_flag", "partial": "lex_partial_substring_match_flag", "early": "lex_first_token_early_match_flag", "token_set": "lex_token_set_ratio"}
    ratios = {"jaccard", "query_coverage", "title_coverage", "token_set"}
    terms, items = features.split_text(view(spark, d, "terms"), "query"), features.split_text(view(spark, d, "items"), "title")
    return joins.star_join(view(spark, d, "pairs"), terms, items, check=False).select("id", *((F.round(f[c], 6) if n in ratios else f[c]).alias(n) for n, c in names.items()))


def _grams(c: str) -> str:
    s = f"replace({FOLD.format(c)}, ' ', '_')"
    return f"CASE WHEN {s} = '' THEN [] ELSE list_distinct(list_transform(range(1, greatest(len({s}) - 2, 1) + 1), lambda i: substr({s}, i, 3))) END"


@query(
    WIDE
    + f""", p AS (SELECT DISTINCT query, title FROM wide), g AS (SELECT query, title, {_grams("query")} AS a, {_grams("title")} AS b FROM p)
SELECT query, title, round({_div(_both("a", "b"), "len(list_distinct(list_concat(a, b)))")}, 6) AS char3_jaccard FROM g"""
)
def char3_jaccard(spark, d):
    return _wide(spark, d).select("query", "title").distinct().select("query", "title", F.round(X.jaccard(X.char_ngrams(F.col("query")), X.char_ngrams(F.col("title"))), 6).alias("char3_jaccard"))


@query(
    WIDE
    + f""", p AS (SELECT DISTINCT query, title FROM wide), t AS (SELECT query, title, {_Q} AS a, {_T} AS b FROM p),
starts AS (SELECT query, title, a, b, i, j FROM (SELECT *, unnest(range(1, len(b) + 1)) AS j FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM t))),
runs AS (SELECT query, title, n FROM (SELECT *, unnest(range(1, least(len(a) - i, len(b) - j) + 2)) AS n FROM starts) WHERE a[i:i + n - 1] = b[j:j + n - 1])
SELECT query, title, coalesce(max(n), 0) AS span FROM t LEFT JOIN runs USING (query, title) GROUP BY ALL"""
)
def common_token_span(spark, d):
    return _wide(spark, d).select("query", "title").distinct().select("query", "title", F.col("query").isNull().cast("int").alias("_"), X.longest_token_span(X.tokens(F.col("query")), X.tokens(F.col("title"))).cast("bigint").alias("span")).drop("_")


@query(
    cte("items")
    + f""", c AS (SELECT DISTINCT category FROM items), p AS (SELECT category, list_filter(regexp_split_to_array({NORM.format("category")}, '\\s*(?:>|/|\\\\|\\||;|,|-)\\s*'), lambda x: x <> '') AS p FROM c)
SELECT category, len(p) AS depth, p[1] AS parent, p[len(p)] AS leaf, trim(string_split(category, '>')[-1]) AS raw_leaf FROM p"""
)
def category_path_features(spark, d):
    p = category_parts(F.col("category"))
    return view(spark, d, "items").select("category").distinct().select("category", F.size(p).alias("depth"), F.get(p, 0).alias("parent"), F.get(p, F.size(p) - 1).alias("leaf"), leaf_category(F.col("category")).alias("raw_leaf"))


@query(cte("items") + " SELECT item_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(concat(title, ' ', attributes, ' ', brand)), '[0-9]+'))), ',') AS numbers FROM items")
def numeric_tokens(spark, d):
    return view(spark, d, "items").select("item_id", F.array_join(F.array_sort(X.numeric_tokens(F.concat_ws(" ", "title", "attributes", "brand"))), ",").alias("numbers"))


@query(
    cte("items")
    + """ SELECT item_id, CAST((title = '') AS int) + CAST((age_group = '') AS int) + CAST((attributes = '') AS int) + CAST((brand = '') AS int) + CAST((category = '') AS int) + CAST((gender = '') AS int) AS missing,
  CAST(gender IN ('', 'unknown') AS int) + CAST(age_group IN ('', 'unknown') AS int) AS unknown, round(CAST(len(regexp_replace(brand, '[A-Za-z0-9\\s]', '', 'g')) AS double) / len(brand), 6) AS symbol_density FROM items"""
)
def metadata_density(spark, d):
    f = features.metadata()
    rows = view(spark, d, "items").withColumns({"query": F.lit("x"), "attribute_dict": F.lit("{}")})
    return rows.select("item_id", f["meta_missing_field_count"].alias("missing"), f["meta_unknown_field_count"].alias("unknown"), F.round(X.symbol_density(F.col("brand")), 6).alias("symbol_density"))


COLORS_SQL = "CASE size % 6 WHEN 0 THEN 'red' WHEN 1 THEN 'black|white' WHEN 2 THEN 'navy' WHEN 3 THEN 'blue' WHEN 4 THEN 'fusya' ELSE 'gray' END"
MATERIALS_SQL = "CASE size % 5 WHEN 0 THEN 'genuine_leather' WHEN 1 THEN 'cotton' WHEN 2 THEN 'linen|wool' WHEN 3 THEN 'metal' ELSE 'leather' END"
TEXT_SQL = f"concat('color: ', replace({COLORS_SQL}, '|', ' '), ' ; material: ', replace({MATERIALS_SQL}, '|', ' '), ' ; size: ', size, ' ; style: classic ; unknown: el_isi')"


@query(
    cte("items")
    + f""" SELECT item_id, 'color|material|size|style|unknown' AS keys, concat({COLORS_SQL}, '|', {MATERIALS_SQL}, '|', size, '|classic|el_isi') AS vals, {TEXT_SQL} AS normalized_text,
  {COLORS_SQL} AS color, {MATERIALS_SQL} AS material, 'classic' AS style FROM items"""
)
def attribute_parse(spark, d):
    rows = with_attributes(view(spark, d, "items"))
    return rows.select("item_id", F.col("attribute_keys").alias("keys"), F.col("attribute_values").alias("vals"), F.col("normalized_attribute_text").alias("normalized_text"), F.col("color_value").alias("color"), F.col("material_value").alias("material"), F.col("style_value").alias("style"))


@query(
    cte("items")
    + f""" SELECT key, value, count(*) AS n FROM (SELECT 'color' AS key, unnest(string_split({COLORS_SQL}, '|')) AS value FROM items UNION ALL SELECT 'material', unnest(string_split({MATERIALS_SQL}, '|')) FROM items
  UNION ALL SELECT 'size', CAST(size AS varchar) FROM items UNION ALL SELECT 'style', 'classic' FROM items UNION ALL SELECT 'unknown', 'el_isi' FROM items) GROUP BY ALL"""
)
def attribute_value_counts(spark, d):
    # items of one text are counted before it is parsed
    texts = view(spark, d, "items").groupBy("attributes").agg(F.count("*").alias("n"))
    entries = attribute_maps(texts, "attributes", "m").select("n", F.explode("m").alias("key", "vals"))
    return entries.select("key", F.explode("vals").alias("value"), "n").groupBy("key", "value").agg(F.sum("n").alias("n"))


@query("SELECT event_type, CAST(props->>'k' AS int) % 10 AS k, count(*) AS n FROM events GROUP BY ALL")
def json_props_map(spark, d):
    props = F.from_json("props", "map<string,string>")
    return source(spark, d, "events").groupBy("event_type", (F.element_at(props, "k").cast("int") % 10).alias("k")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, concat('v', c_nationkey) AS a, CAST(c_custkey % 3 AS varchar) AS b, 2 AS n FROM customer")
def key_value_strings(spark, d):
    raw = F.concat(F.lit("a: x, b :"), (F.col("c_custkey") % 3).cast("string"), F.lit(", a: v"), F.col("c_nationkey").cast("string"))
    return source(spark, d, "customer").withColumn("m", key_values(raw)).select("c_custkey", F.element_at("m", "a").alias("a"), F.element_at("m", "b").alias("b"), F.size("m").alias("n"))


@query(
    cte("terms")
    + """, q AS (SELECT DISTINCT query FROM terms), t AS (SELECT query, regexp_extract_all(translate(lower(query), 'çğıöşü', 'cgiosu'), '[a-z0-9]+') AS t FROM q),
f AS (SELECT query, t, list_has_any(t, ['kadin', 'erkek', 'cocuk']) AS x, CAST(list_has_any(t, ['red', 'blue', 'siyah']) AS int) AS color, CAST(list_has_any(t, ['deri']) AS int) AS material,
  CAST(list_has_any(t, ['oversize', 'klasik']) AS int) AS style, (CASE WHEN list_contains(t, 'klasik') THEN 2 WHEN list_contains(t, 'oversize') THEN 1 ELSE 0 END) AS styles FROM t)
SELECT query, len(t) AS n_tokens, color, material, style, CAST(list_has_any(t, ['kadin', 'erkek']) AS int) AS gender, CAST(list_contains(t, 'cocuk') AS int) AS age, CAST(list_contains(t, 'ayakkabi') AS int) AS category,
  CAST(list_has_any(t, ['42', 'numara']) OR list_contains(t, 'small') OR list_contains(t, 'large') AS int) AS size, CAST(len(t) <= 2 AS int) AS short, CAST(len(t) >= 5 AS int) AS long,
  CAST(color + material + styles >= 2 OR CAST(color + material + styles AS double) / len(t) >= 0.5 AS int) AS attribute_heavy,
  CASE WHEN list_contains(t, 'kadin') THEN 'female' WHEN list_contains(t, 'erkek') THEN 'male' ELSE '' END AS genders FROM f"""
)
def intent_flags(spark, d):
    found = query_intent(view(spark, d, "terms").select("query").distinct())
    names = {"n_tokens": "query_length_tokens", **{k: f"has_{k}_token" for k in ("color", "material", "style", "gender", "age", "category", "size")}, "short": "is_short_query", "long": "is_long_query", "attribute_heavy": "is_attribute_heavy", "genders": "detected_gender_candidates"}
    return found.select("query", *(F.col(c).alias(n) for n, c in names.items()))


@query()
def intent_segments(spark, d):
    """Segments with the items' own brands and categories as dictionaries."""
    rows = add_query_intent(view(spark, d, "terms"), dictionaries_of(view(spark, d, "items")))
    return rows.groupBy(segment().alias("segment")).agg(F.count("*").alias("n"), F.sum("possible_typo_or_ambiguous").alias("ambiguous"))


def _intent_pairs(spark: SparkSession, d: str) -> DataFrame:
    terms, items = query_intent(view(spark, d, "terms")), with_attributes(view(spark, d, "items"))
    return joins.star_join(view(spark, d, "pairs"), terms, items, check=False)


@query(
    WIDE
    + """, q AS (SELECT *, CASE WHEN contains(query, 'kadın') THEN 'female' WHEN contains(query, 'erkek') THEN 'male' ELSE '' END AS g, contains(query, 'çocuk') AS child FROM wide)
SELECT id, CAST((g = 'female' AND gender = 'erkek') OR (g = 'male' AND gender = 'kadın') AS int) AS gender_conflict, CAST((g = 'female' AND gender = 'kadın') OR (g = 'male' AND gender = 'erkek') AS int) AS gender_match,
  CAST(child AND age_group NOT IN ('çocuk', 'bebek') AS int) AS age_conflict, CAST(child AND age_group IN ('çocuk', 'bebek') AS int) AS age_match FROM q"""
)
def gender_age_conflict(spark, d):
    f = features.gender_age()
    return _intent_pairs(spark, d).select("id", f["gender_conflict_flag"].alias("gender_conflict"), f["gender_exact_match_flag"].alias("gender_match"), f["age_conflict_flag"].alias("age_conflict"), f["age_exact_match_flag"].alias("age_match"))


@query(
    WIDE
    + f""", q AS (SELECT id, CASE WHEN regexp_matches(query, '(^| )red( |$)') THEN 'red' WHEN regexp_matches(query, '(^| )blue( |$)') THEN 'blue' WHEN contains(query, 'siyah') THEN 'siyah' ELSE '' END AS c,
  CASE WHEN contains(query, 'deri') THEN 'deri' ELSE '' END AS m, {COLORS_SQL} AS ic, {MATERIALS_SQL} AS im FROM wide)
SELECT id, CAST(c <> '' AND NOT list_contains(string_split(ic, '|'), c) AS int) AS color_conflict, CAST(c <> '' AND list_contains(string_split(ic, '|'), c) AS int) AS color_match,
  CAST(m <> '' AND NOT list_contains(string_split(im, '|'), m) AS int) AS material_conflict FROM q"""
)
def attribute_conflicts(spark, d):
    f = features.attribute()
    return _intent_pairs(spark, d).select("id", f["attr_color_conflict_flag"].alias("color_conflict"), f["attr_color_exact_match"].alias("color_match"), f["attr_material_conflict_flag"].alias("material_conflict"))


def _searched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items with their retrieval text, the distinct queries as (asked, query), and (term_id, asked); a null query is one too."""
    items = with_attributes(view(spark, d, "items")).withColumn("text", item_text.item_retrieval_text())
    terms = view(spark, d, "terms")
    asked = terms.groupBy("query").agg(F.min("term_id").alias("asked"))
    same = F.col("t.query").eqNullSafe(F.col("a.query"))
    return items, asked, terms.alias("t").join(asked.alias("a"), same).select("term_id", "asked")


def _hits(items: DataFrame, asked: DataFrame, top: int = 100) -> DataFrame:
    """(asked, item_id) of the query's ``top`` BM25 and dense hits of all items, with their scores and ranks."""
    asked = asked.where("query IS NOT NULL")
    bm = R.bm25_search(items, asked, "item_id", "text", "asked", "query", top).select("asked", "item_id", F.col("bm25").alias("bm25_score"), F.col("rank").alias("bm25_rank"))
    dense = R.latent_search(items, asked, "item_id", "text", "asked", "query", top).select("asked", "item_id", F.col("score").alias("dense_score"), F.col("rank").alias("dense_rank"))
    return bm.join(dense, ["asked", "item_id"], "full")


def _retrieval_flags() -> dict[str, Column]:
    match = {"category_match_flag": features.category()["cat_token_overlap_count"] > 0, "brand_match_flag": features.brand()["brand_exact_match"] > 0}
    return {**{n: c.cast("int") for n, c in match.items()}, **negatives.conflict_flags(), "source_pool": F.lit("official_training_pairs")}


def _retrieved_pairs(spark: SparkSession, d: str, top: int = 100) -> DataFrame:
    """All pairs with the scores and ranks of the query's ``top`` BM25 and dense hits of all items, and their flags."""
    items, asked, terms = _searched(spark, d)
    hits = _hits(items, asked, top).join(terms, "asked").drop("asked")
    return _intent_pairs(spark, d).join(hits, ["term_id", "item_id"], "left").withColumns(_retrieval_flags())


@query()
def pair_features_all(spark, d):
    """All feature groups over all pairs, summed up per feature."""
    items, asked, terms = _searched(spark, d)
    return features.feature_means(view(spark, d, "pairs"), terms, query_intent(asked), items, _hits(items, asked), _retrieval_flags())


@query()
def fuzzy_similarity(spark, d):
    """Ratcliff-Obershelp, token-sort, partial and substring similarities of distinct (query, title) pairs."""
    from quillon.functions import similarity as S

    pairs = _wide(spark, d).select("query", "title").distinct()
    q, t = F.col("query"), F.col("title")
    return pairs.select("query", "title", F.round(S.seq_ratio(q, t), 6).alias("ratio"), F.round(S.token_sort_ratio(q, t), 6).alias("token_sort"), F.round(S.partial_ratio(q, t), 4).alias("partial"), S.longest_common_substring(q, t).alias("substring"))


@query(cte("terms") + """ SELECT DISTINCT word AS word, CASE WHEN levenshtein(word, 'widget') <= 2 THEN 'widget' WHEN levenshtein(word, 'gear') <= 2 THEN 'gear' ELSE word END AS corrected FROM (SELECT unnest(regexp_extract_all(query, '[a-z]+')) AS word FROM terms)""")
def symspell_nearest(spark, d):
    words = view(spark, d, "terms").select(F.explode(F.regexp_extract_all("query", F.lit("[a-z]+"), F.lit(0))).alias("word"))
    dictionary = spark.createDataFrame([("widget", 9), ("gear", 5)], "word string, n int")
    return forensics.nearest_spelling(words, "word", dictionary).select("word", "corrected")


_SPELLED = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z]+')"


@query(
    cte("docs", "questions")
    + f""", said AS (SELECT word, count(*) AS n FROM (SELECT unnest({_SPELLED.format("text")}) AS word FROM docs) GROUP BY 1), dictionary AS (SELECT * FROM said WHERE n >= 20), asked AS (SELECT DISTINCT unnest({_SPELLED.format("question")}) AS word FROM questions),
near AS (SELECT a.word, x.word AS entry, n, levenshtein(a.word, x.word) AS edits FROM asked a JOIN dictionary x ON levenshtein(a.word, x.word) <= 2), best AS (SELECT word, entry, edits FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY edits, n DESC, entry) AS r FROM near) WHERE r = 1)
SELECT word, coalesce(entry, word) AS corrected, CAST(coalesce(edits, -1) AS int) AS edits FROM asked LEFT JOIN best USING (word)"""
)
def spelling_corrections(spark, d):
    """The words of the questions, corrected by a dictionary of the words that the documents hold 20 times or more."""
    words_of = lambda df, c: df.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    dictionary = words_of(view(spark, d, "docs"), "text").groupBy("word").agg(F.count("*").alias("n")).where("n >= 20")
    return forensics.nearest_spelling(words_of(view(spark, d, "questions"), "question"), "word", dictionary)


@query()
def augmented_questions(spark, d):
    """Two variants of every question by synonyms and dropped words; words with the same first three letters stand for synonyms."""
    words = view(spark, d, "questions").select(F.explode(F.split("question", r"\s+")).alias("word")).where("length(word) > 2").distinct()
    pairs = words.join(words.select(F.col("word").alias("synonym"), F.substring("word", 1, 3).alias("head")), F.substring("word", 1, 3) == F.col("head")).where("word <> synonym").select("word", "synonym")
    return forensics.augmented_texts(view(spark, d, "questions"), "question_id", "question", pairs, copies=2).select("question_id", "copy", "augmented")


@query(cte("pairs") + " SELECT term_id, min(id) AS low, max(id) AS high, count(*) AS n, max(id) - min(id) AS span FROM pairs GROUP BY 1")
def term_row_range(spark, d):
    return forensics.group_range(view(spark, d, "pairs"), "term_id", "id")


@query(
    WIDE
    + """, c AS (SELECT term_id, brand, count(*) AS n FROM wide GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY term_id) AS t, row_number() OVER (PARTITION BY term_id ORDER BY n DESC, brand) AS r FROM c)
SELECT term_id, brand AS mode, n, round(CAST(n AS double) / t, 6) AS share FROM r WHERE r = 1"""
)
def brand_dominance(spark, d):
    return joins.mode_per_group(_wide(spark, d), "term_id", "brand")


@query(WIDE + """, c AS (SELECT term_id, category, count(*) AS n FROM wide GROUP BY ALL), m AS (SELECT term_id, category AS mode FROM (SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY n DESC, category) AS r FROM c) WHERE r = 1)
SELECT term_id, count(*) AS n, count_if(category = mode) AS matches FROM wide JOIN m USING (term_id) GROUP BY 1""")
def group_mode_match(spark, d):
    wide = _wide(spark, d)
    mode = joins.mode_per_group(wide, "term_id", "category").select("term_id", "mode")
    return wide.join(mode, "term_id").groupBy("term_id").agg(F.count("*").alias("n"), F.count_if(F.col("category") == F.col("mode")).alias("matches"))


@query(WIDE + " SELECT brand, count(DISTINCT term_id) AS n_distinct, count(*) AS n FROM wide GROUP BY 1")
def terms_per_brand(spark, d):
    return forensics.distinct_per_group(_wide(spark, d), "brand", "term_id")


@query(cte("docs") + r""", w AS (SELECT lang, unnest(regexp_extract_all(translate(lower(coalesce(text, '')), 'çğıöşüâîûàáäãåèéêëìíïòóôõùúñÿýœæßø', 'cgiosuaiuaaaaaeeeeiiioooouunyyoaso'), '[a-z0-9]+')) AS word FROM docs),
c AS (SELECT lang, word, count(*) AS n FROM w GROUP BY ALL) SELECT lang, word, n, CAST(place AS int) AS place FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM c) WHERE place <= 10""")
def top_words_per_language(spark, d):
    return forensics.top_words(view(spark, d, "docs"), "lang", "text", 10)


@query("SELECT 'lang' AS \"column\", round(CAST(count_if(lang IS NULL) AS double) / count(*), 6) AS null_rate, CAST(min(lang) IS NOT DISTINCT FROM max(lang) AS int) AS constant FROM documents UNION ALL SELECT 'n_chars', round(CAST(count_if(n_chars IS NULL) AS double) / count(*), 6), CAST(min(n_chars) IS NOT DISTINCT FROM max(n_chars) AS int) FROM documents")
def null_rates(spark, d):
    return forensics.null_rates(source(spark, d, "documents"), ["lang", "n_chars"])


@query(cte("docs") + ", c AS (SELECT quantile_cont(n_chars, 0.9) AS cut FROM docs) SELECT doc_id, n_chars, round(CAST(cut AS double), 6) AS cut FROM docs, c WHERE n_chars >= cut")
def quantile_cut(spark, d):
    return forensics.above_quantile(view(spark, d, "docs"), "n_chars", 0.9).select("doc_id", "n_chars", "cut")


@query(cte("docs") + " SELECT source, count(*) AS n FROM docs GROUP BY 1 ORDER BY n DESC, source LIMIT 20")
def source_value_counts(spark, d):
    return forensics.value_counts(view(spark, d, "docs"), "source")


@query(
    cte("pairs")
    + """, train AS (SELECT * FROM pairs WHERE id % 2 = 0), test AS (SELECT * FROM pairs WHERE id % 2 = 1), a AS (SELECT DISTINCT session_id, 1 AS s FROM train), b AS (SELECT DISTINCT item_id, 1 AS i FROM train)
SELECT leak, count(*) AS n FROM (SELECT CASE WHEN s = 1 THEN 'seen_session_id' WHEN i = 1 THEN 'seen_item_id' ELSE 'clean' END AS leak FROM test LEFT JOIN a USING (session_id) LEFT JOIN b USING (item_id)) GROUP BY 1"""
)
def leakage_flags(spark, d):
    from quillon.operators.decisions import leakage_flags as flags

    pairs = view(spark, d, "pairs")
    return flags(pairs.where("id % 2 = 1"), pairs.where("id % 2 = 0"), ["session_id", "item_id"]).groupBy("leak").agg(F.count("*").alias("n"))


@query(cte("registry") + " SELECT family, experiment_id, name, oof_macro_f1 FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY experiment_id DESC) AS r FROM registry) WHERE r = 1")
def latest_registry_row(spark, d):
    return joins.latest_per_key(view(spark, d, "registry"), "family", F.desc("experiment_id")).select("family", "experiment_id", "name", "oof_macro_f1")


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(concat('0:', CAST(o_orderkey AS varchar))), o_orderkey) AS r FROM orders) WHERE r <= 2")
def hash_sample_per_group(spark, d):
    return joins.hash_sample(source(spark, d, "orders"), "o_orderkey", 2, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    WIDE
    + """, p AS (SELECT DISTINCT term_id, item_id FROM pairs WHERE label = 1), s AS (SELECT id, label, CAST((id * 31) % 100 AS double) / 100 AS lex, CAST((id * 17) % 100 AS double) / 100 AS dense, (id % 3 = 0) AS cat, (id % 4 = 0) AS brand, CAST(id % 5 % 3 AS int) AS c, CAST(p.term_id IS NOT NULL AS boolean) AS known
  FROM pairs LEFT JOIN p USING (term_id, item_id)),
f AS (SELECT *, c = 0 AS calm, (CASE WHEN lex >= 0.92 AND cat AND c = 0 THEN 1 ELSE 0 END) + (CASE WHEN dense >= 0.94 AND c = 0 THEN 1 ELSE 0 END) + (CASE WHEN dense >= 0.88 AND lex >= 0.35 AND c = 0 THEN 1 ELSE 0 END) + (CASE WHEN cat AND brand AND (lex >= 0.82 OR dense >= 0.90) AND c = 0 THEN 1 ELSE 0 END) AS r FROM s),
x AS (SELECT id, CASE WHEN known THEN 'uncertain_candidate' WHEN r >= 2 THEN 'skipped_due_to_false_negative_risk' WHEN r = 1 THEN 'uncertain_candidate' WHEN dense >= 0.35 OR lex >= 0.35 OR cat OR brand THEN 'hard_negative' ELSE 'safe_negative' END AS status,
  CASE WHEN known THEN 0.0 WHEN r >= 2 THEN 0.1 WHEN r = 1 THEN 0.25 WHEN dense >= 0.35 THEN round(least(0.70 + 0.07 * least(c, 3), 0.96), 6) WHEN lex >= 0.35 OR cat OR brand THEN round(least(0.65 + 0.08 * least(c, 3), 0.95), 6) ELSE 0.9 END AS score,
  round(least(1.0, 0.35 * lex + 0.35 * dense + 0.13 * CAST(cat AS int) + 0.10 * CAST(brand AS int) + 0.07 * CAST(c > 0 AS int)), 4) AS hardness FROM f)
SELECT status, CAST(score AS double) AS score, count(*) AS n, round(sum(CAST(hardness AS double)), 2) AS hardness FROM x GROUP BY ALL"""
)
def safety_decision(spark, d):
    pairs = view(spark, d, "pairs")
    known = pairs.where("label = 1").select("term_id", "item_id").distinct().withColumn("known", F.lit(True))
    s = pairs.join(known, ["term_id", "item_id"], "left").selectExpr("id", "CAST((id * 31) % 100 AS double) / 100 AS lex", "CAST((id * 17) % 100 AS double) / 100 AS dense", "id % 3 = 0 AS cat", "id % 4 = 0 AS brand", "CAST(id % 5 % 3 AS int) AS c", "coalesce(known, false) AS known")
    cols = [F.col(x) for x in ("lex", "dense", "cat", "brand", "c")]
    made = s.select(negatives.safety(*cols, F.col("known")).alias("s"), F.round(negatives.hardness(*cols), 4).alias("h"))
    return made.groupBy(F.col("s.status").alias("status"), F.col("s.safety_score").alias("score")).agg(F.count("*").alias("n"), F.round(F.sum("h"), 2).alias("hardness"))


@query(
    cte("pairs")
    + """, c AS (SELECT *, id % 3 <> 0 AS ok FROM pairs), r AS (SELECT *, coalesce(sum(CAST(ok AS int)) OVER (PARTITION BY term_id ORDER BY md5(CAST(id AS varchar)), id, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
SELECT term_id, count(*) AS seen, count_if(ok) AS taken FROM r WHERE before < 5 GROUP BY 1"""
)
def quota_selection(spark, d):
    rows = negatives.take_quota(view(spark, d, "pairs"), "term_id", [F.md5(F.col("id").cast("string")), F.col("id"), F.col("item_id")], F.col("id") % 3 != 0, 5)
    return rows.groupBy("term_id").agg(F.count("*").alias("seen"), F.count_if(F.col("id") % 3 != 0).alias("taken"))


def mined(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of all pools that were looked at, with their decisions, and which of them the quotas took.

    A term wants as many negatives of each pool as it has positives, and each
    pool offers it twelve times as many.
    """
    items, asked, terms = _searched(spark, d)
    # what all pools read is computed once
    items, intents = cut(items), cut(query_intent(view(spark, d, "terms")))
    positives = view(spark, d, "pairs").where("label = 1")
    size = cut(positives.groupBy("term_id").agg(F.count("*").alias("n_pos")).withColumn("depth", negatives.request_depth(F.col("n_pos"))))
    most = size.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("depth")).first().depth
    # hits of queries are few bytes and those of their terms many, so they are dealt over the cores before they meet
    tasks = 3 * spark.sparkContext.defaultParallelism
    of_terms = lambda hits: cut(hits.repartition(tasks).join(terms, "asked").select("term_id", "item_id", "score"))
    cosine = R.tfidf_cosine(items, asked, "item_id", "text", "asked", "query").select("asked", "item_id", F.round("cosine", 6).alias("score"))
    dense = R.latent_search(items, asked, "item_id", "text", "asked", "query", most)
    found = negatives.pool_candidates(intents, items, positives, of_terms(cosine), of_terms(dense), size)
    decided = cut(negatives.decided(found).join(size, "term_id"))
    quotas = {pool: F.col("n_pos") for _, pool in negatives.POOLS}
    place = F.md5(F.concat_ws(":", "pool", "item_id"))
    return negatives.mine_by_pools(decided, quotas, "term_id", "item_id", "pool", [place, F.col("item_id")], F.col("accepted"), F.conv(F.substring(place, 1, 2), 16, 10).cast("int"))


@query()
def mined_negatives(spark, d):
    """Negatives of the six pools under quotas: per pool and status how many were looked at and taken."""
    return mined(spark, d).groupBy("pool", "status").agg(F.count("*").alias("seen"), F.sum("selected").alias("taken"), F.round(F.avg("hardness"), 4).alias("hardness"))


@query()
def semantic_confusers(spark, d):
    """The first thirty dense candidates of the miner, selected or not, with their subtype."""
    return negatives.confuser_report(mined(spark, d)).select("bucket", "term_id", "item_id", "subtype", "status", F.round("dense_score", 4).alias("dense_score"), "lexical_score", F.array_join("reasons", "|").alias("reasons"))


_SIGNALS = "CAST((id * 17) % 100 AS double) / 100 AS dense, CASE WHEN id % 7 = 0 THEN NULL ELSE CAST((id * 31) % 100 AS double) / 100 END AS lex, id % 3 = 0 AS cat, id % 4 = 0 AS brand, CAST(id % 5 % 2 AS int) AS c"


@query(cte("pairs") + f""", s AS (SELECT {_SIGNALS} FROM pairs) SELECT CASE WHEN cat THEN CASE WHEN c > 0 THEN 'dense_attribute_near_miss' ELSE 'dense_same_category_hard' END WHEN brand THEN 'dense_same_brand_hard'
WHEN dense >= 0.5 AND coalesce(lex, 0) < 0.2 THEN 'dense_semantic_confuser' ELSE 'dense_hard' END AS subtype, count(*) AS n FROM s GROUP BY 1""")
def dense_subtypes(spark, d):
    s = view(spark, d, "pairs").selectExpr("CAST((id * 17) % 100 AS double) / 100 AS dense", "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST((id * 31) % 100 AS double) / 100 END AS lex", "id % 3 = 0 AS cat", "id % 4 = 0 AS brand", "CAST(id % 5 % 2 AS int) AS c")
    return s.groupBy(negatives.dense_subtype(F.col("dense"), F.col("lex"), F.col("cat"), F.col("brand"), F.col("c")).alias("subtype")).agg(F.count("*").alias("n"))


@query(WIDE + """, p AS (SELECT term_id, query, min(id) AS first_id, count(*) AS n FROM wide GROUP BY 1, 2), x AS (SELECT id, query, label FROM wide WHERE label = 1)
SELECT p.term_id, count(*) AS n_rows, count(x.id) AS matched FROM p LEFT JOIN x ON x.query = p.query GROUP BY 1""")
def predictions_by_query(spark, d):
    """Predictions joined to the truth by query text, many to many: terms of one query meet each other's rows."""
    wide = _wide(spark, d)
    predictions = wide.groupBy("term_id", "query").agg(F.min("id").alias("first_id"))
    truth = wide.where("label = 1").select("id", F.col("query").alias("asked"))
    # summed per query before the join, so that a hot query is one row of the truth
    sizes = truth.groupBy("asked").agg(F.count("*").alias("hits"))
    both = predictions.join(sizes, F.col("query") == F.col("asked"), "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    return both.groupBy("term_id").agg(F.sum(F.greatest("hits", F.lit(1))).alias("n_rows"), F.sum("hits").alias("matched"))


@query(WIDE + """, train AS (SELECT * FROM wide WHERE id % 3 <> 0), test AS (SELECT * FROM wide WHERE id % 3 = 0), u AS (SELECT DISTINCT item_id, brand, category FROM test ANTI JOIN train USING (item_id))
SELECT count(*) AS unknown_items, count(k.seen) AS of_known_kind FROM u LEFT JOIN (SELECT DISTINCT brand, category, 1 AS seen FROM train) k USING (brand, category)""")
def unknown_items_by_kind(spark, d):
    """Items that only the test side has, and how many share brand and category with an item of the training side."""
    wide = _wide(spark, d)
    train, test = wide.where("id % 3 <> 0"), wide.where("id % 3 = 0")
    unknown = test.select("item_id", "brand", "category").distinct().join(train.select("item_id").distinct(), "item_id", "left_anti")
    kinds = train.select("brand", "category").distinct().withColumn("seen", F.lit(1))
    return unknown.join(kinds, ["brand", "category"], "left").agg(F.count("*").alias("unknown_items"), F.count("seen").alias("of_known_kind"))


@query(WIDE + ", p AS (SELECT * FROM wide WHERE label = 1) SELECT term_id, min_by(query, id) AS query, count(DISTINCT category) AS n_categories, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(brand))), '|') AS brands FROM p GROUP BY 1")
def term_profiles(spark, d):
    """The first query of each term and the sets of its positives."""
    p = _wide(spark, d).where("label = 1")
    return p.groupBy("term_id").agg(F.min_by("query", "id").alias("query"), F.count_distinct("category").alias("n_categories"), F.count_distinct("item_id").alias("n_items"), F.array_join(F.array_sort(F.collect_set("brand")), "|").alias("brands"))


@query(WIDE + """, n AS (SELECT len(regexp_extract_all(concat_ws(' ', query, title, brand, category), '[^ ]+')) AS k FROM wide)
SELECT count(*) AS n_rows, round(avg(k), 6) AS mean, max(k) AS longest, round(avg(CAST(k > 9 AS int)), 6) AS truncation_rate, round(quantile_cont(k, 0.95), 6) AS p95 FROM n""")
def pair_text_lengths(spark, d):
    from quillon.operators.metrics import length_stats

    words = F.size(F.regexp_extract_all(F.concat_ws(" ", "query", "title", "brand", "category"), F.lit("[^ ]+"), F.lit(0)))
    return length_stats(_wide(spark, d).select(words.alias("k")), "k", 9)


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'P0' WHEN 1 THEN 'P1' WHEN 2 THEN 'P2' ELSE 'P3' END AS priority, CASE c_nationkey % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'yellow' ELSE 'green' END AS status FROM customer ORDER BY c_custkey % 4, c_nationkey % 3, c_custkey LIMIT 10")
def top_risks(spark, d):
    rows = source(spark, d, "customer").selectExpr("c_custkey", "CASE c_custkey % 4 WHEN 0 THEN 'P0' WHEN 1 THEN 'P1' WHEN 2 THEN 'P2' ELSE 'P3' END AS priority", "CASE c_nationkey % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'yellow' ELSE 'green' END AS status")
    return joins.first_by_names(rows, {"priority": ["P0", "P1", "P2", "P3"], "status": ["red", "yellow", "green"]}, ["c_custkey"], 10)


@query()
def uniform_negatives(spark, d):
    """Two negatives per positive pair, none of them a known positive."""
    positives = view(spark, d, "pairs").where("label = 1")
    found = negatives.uniform_negatives(positives, view(spark, d, "items"), "term_id", "item_id", 2)
    wrong = found.join(positives.select("term_id", "item_id").distinct(), ["term_id", "item_id"], "left_semi").agg(F.count("*").alias("known_positives"))
    return found.agg(F.count("*").alias("negatives"), F.count_distinct("term_id").alias("terms"), F.max("place").alias("most")).join(wrong)


@query(cte("pairs") + """ SELECT label, negative_type, count(*) AS n, count(ts) AS with_ts FROM (SELECT 1 AS label, 'positive' AS negative_type, ts FROM pairs WHERE label = 1 UNION ALL SELECT 0, 'easy', NULL FROM pairs WHERE label = 0) GROUP BY ALL""")
def augmented_union(spark, d):
    pairs = view(spark, d, "pairs")
    mined = pairs.where("label = 0").select("id", "term_id", "item_id").withColumn("negative_type", F.lit("easy"))
    return negatives.augmented(pairs.where("label = 1"), mined).groupBy("label", "negative_type").agg(F.count("*").alias("n"), F.count("ts").alias("with_ts"))
