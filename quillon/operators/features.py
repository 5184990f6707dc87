"""Pair features in groups, each group a projection of a wide pair table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions import similarity
from quillon.functions.attributes import attribute_map_of_json, category_parts
from quillon.functions.text import char_ngrams, coverage, is_unknown, jaccard, longest_token_span, normalize_text, numeric_tokens, safe_div, shared, symbol_density, text_or_empty, token_set, token_set_ratio, tokens

from quillon.sources.work import Work

from .item_text import ITEM_FIELDS, full_item_text
from .joins import cut
from .retrieval import spread
from .term_weights import TermWeights, TermWeightsModel, sparse_dot


def _c(name: str) -> Column:
    return F.col(name)


def _flag(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0))


def _piped(name: str) -> Column:
    return F.filter(F.split(text_or_empty(_c(name)), r"\|"), lambda v: v != "")


#: What the lexical features take of a text.
_SPLITS = {"tokens": tokens, "set": token_set, "norm": normalize_text, "grams": char_ngrams}


def split_text(rows: DataFrame, column: str) -> DataFrame:
    """Adds what the lexical features take of a text, so that a table of queries or items is split once and not each of its pairs."""
    return rows.withColumns({f"_{column}_{name}": split(_c(column)) for name, split in _SPLITS.items()})


def lexical(split: bool = False) -> dict[str, Column]:
    """Features of a query and a title; ``split`` says that both sides went through ``split_text`` before they met."""
    (q, qs, qn, q3), (t, ts, tn, t3) = ([_c(f"_{c}_{name}") if split else take(_c(c)) for name, take in _SPLITS.items()] for c in ("query", "title"))
    span = longest_token_span(q, t)
    return {
        "lex_token_overlap_count": shared(qs, ts),
        "lex_token_overlap_ratio": jaccard(qs, ts),
        "lex_query_coverage_ratio": coverage(qs, ts),
        "lex_title_coverage_ratio": coverage(ts, qs),
        "lex_unique_query_tokens": F.size(qs),
        "lex_unique_title_tokens": F.size(ts),
        "lex_char3_jaccard": jaccard(q3, t3),
        "lex_longest_common_token_span": span,
        "lex_longest_common_token_span_ratio": safe_div(span, F.size(q)),
        "lex_exact_phrase_match_flag": _flag((qn != "") & tn.contains(qn)),
        "lex_partial_substring_match_flag": _flag(F.exists(q, lambda x: (F.length(x) >= 4) & tn.contains(x))),
        "lex_first_token_early_match_flag": _flag(F.array_contains(F.slice(t, 1, 2), F.get(q, 0))),
        "lex_token_set_ratio": token_set_ratio(qs, ts),
    }


def category() -> dict[str, Column]:
    parts, cs, qs = category_parts(_c("category")), token_set(_c("category")), token_set(_c("query"))
    parent, leaf = token_set(F.get(parts, 0)), token_set(F.get(parts, F.size(parts) - 1))
    cn = normalize_text(_c("category"))
    return {
        "cat_depth": F.size(parts),
        "cat_exact_full_match_flag": _flag((cn != "") & normalize_text(_c("query")).contains(cn)),
        "cat_parent_overlap_flag": _flag(F.arrays_overlap(qs, parent)),
        "cat_leaf_overlap_flag": _flag(F.arrays_overlap(qs, leaf)),
        "cat_token_overlap_count": shared(qs, cs),
        "cat_token_overlap_ratio": jaccard(qs, cs),
        "cat_query_coverage_ratio": coverage(qs, cs),
        "cat_category_coverage_ratio": coverage(cs, qs),
        "cat_leaf_query_coverage_ratio": coverage(leaf, qs),
    }


def brand() -> dict[str, Column]:
    qs, bs, found = token_set(_c("query")), token_set(_c("brand")), F.array_distinct(_piped("detected_brand_candidates"))
    qn, bn = normalize_text(_c("query")), normalize_text(_c("brand"))
    inside = (bn != "") & (qn.contains(bn) | F.arrays_overlap(qs, bs))
    intent = (F.size(found) > 0) | inside
    return {
        "brand_present_flag": _flag(bn != ""),
        "brand_query_has_brand_flag": _flag(intent),
        "brand_exact_match": _flag((bn != "") & qn.contains(bn)),
        "brand_token_overlap_count": shared(qs, bs),
        "brand_token_overlap_ratio": coverage(bs, qs),
        "brand_contradiction_flag": _flag(intent & ~inside),
        "brand_token_length": F.size(tokens(_c("brand"))),
        "brand_only_query_flag": _flag((F.size(qs) > 0) & (F.size(bs) > 0) & (F.size(F.array_except(qs, F.array_union(bs, found))) == 0)),
        "brand_detected_candidate_count": F.size(found),
    }


def attribute() -> dict[str, Column]:
    m = attribute_map_of_json(_c("attribute_dict"))
    keys, values, qs = F.map_keys(m), F.array_distinct(F.flatten(F.map_values(m))), token_set(_c("query"))
    text = token_set(_c("normalized_attribute_text"))
    numbers, own = numeric_tokens(_c("query")), F.array_union(numeric_tokens(_c("attributes")), numeric_tokens(_c("title")))
    out = {
        "attr_key_count": F.size(keys),
        "attr_value_count": F.size(values),
        "attr_key_overlap_count": shared(qs, keys),
        "attr_value_overlap_count": shared(qs, values),
        "attr_text_token_overlap_count": shared(qs, text),
        "attr_coverage_ratio": coverage(qs, text),
        "attr_size_numeric_match": _flag(F.arrays_overlap(numbers, own)),
        "attr_query_has_numeric_no_item_numeric": _flag((F.size(numbers) > 0) & (F.size(own) == 0)),
    }
    conflicts = F.lit(0)
    for kind in ("color", "material", "style"):
        asked, has = _piped(f"detected_{kind}_candidates"), F.coalesce(F.element_at(m, kind), F.array().cast("array<string>"))
        both = (F.size(asked) > 0) & (F.size(has) > 0)
        match, conflict = _flag(both & F.arrays_overlap(asked, has)), _flag(both & ~F.arrays_overlap(asked, has))
        conflicts = conflicts + conflict
        if kind == "style":
            out["attr_style_overlap"] = match
        else:
            out |= {f"attr_{kind}_exact_match": match, f"attr_{kind}_conflict_flag": conflict, f"attr_{kind}_missing_when_query_has_{kind}": _flag((F.size(asked) > 0) & (F.size(has) == 0))}
    return out | {"attr_conflict_count": conflicts}


#: Per cue of a query the parts of an item's text that answer it, and whole texts that do.
_GENDER_ANSWERS = {"female": (("kad", "female"), ()), "male": (("erkek",), ("male",)), "unisex": (("unisex",), ())}
_AGE_ANSWERS = {"baby": (("bebek", "baby"), ()), "child": (("çocuk", "cocuk", "child", "bebek"), ()), "school_age": (("çocuk", "cocuk", "child", "bebek"), ())}


def _answers(column: str, table: dict[str, tuple[tuple[str, ...], tuple[str, ...]]]) -> dict[str, Column]:
    """For each cue whether the item's column answers it."""
    said = normalize_text(_c(column))
    return {cue: reduce(or_, [*(said.contains(p) for p in parts), *(said == w for w in wholes)]) for cue, (parts, wholes) in table.items()}


def gender_age() -> dict[str, Column]:
    """Cues of the query against what the item says, from two tables of answers."""
    out: dict[str, Column] = {}
    wanted: dict[str, Column] = {}
    for name, source, table in (("gender", "gender", _GENDER_ANSWERS), ("age", "age_group", _AGE_ANSWERS)):
        cues = _piped(f"detected_{name}_candidates")
        wanted |= {cue: F.array_contains(cues, cue) for cue in table}
        met = [wanted[cue] & answer for cue, answer in _answers(source, table).items()]
        out |= {f"{name}_query_has_cue": _flag(F.size(cues) > 0), f"{name}_item_unknown_flag": _flag(is_unknown(_c(source))), f"{name}_exact_match_flag": _flag(reduce(or_, met))}
    item = _answers("gender", _GENDER_ANSWERS) | _answers("age_group", _AGE_ANSWERS)
    opposed = (wanted["female"] & item["male"]) | (wanted["male"] & item["female"])
    return out | {
        "gender_conflict_flag": _flag(opposed & ~item["unisex"]),
        "age_conflict_flag": _flag(reduce(or_, [wanted[cue] & ~item[cue] for cue in ("baby", "child")])),
        "gender_item_unisex_flag": _flag(item["unisex"]),
    }


INTENT = ("query_length_tokens", "query_char_length", *(f"has_{k}_token" for k in ("brand", "category", "color", "material", "style", "gender", "age", "size")), "is_short_query", "is_long_query", "is_attribute_heavy", "is_brand_heavy", "is_category_heavy", "possible_typo_or_ambiguous")


def query() -> dict[str, Column]:
    q, numbers = tokens(_c("query")), numeric_tokens(_c("query"))
    return {
        **{f"query_{c}": F.coalesce(_c(c), F.lit(0)) for c in INTENT},
        "query_numeric_token_count": F.size(numbers),
        "query_unique_token_count": F.size(token_set(_c("query"))),
        "query_numeric_density": safe_div(F.size(numbers), F.size(q)),
        "query_symbol_density": symbol_density(_c("query")),
    }


def retrieval(top: int = 100) -> dict[str, Column]:
    """From bm25_score, bm25_rank, dense_score and dense_rank (rank 0 or null: not retrieved) and match flags."""
    z = lambda c: F.coalesce(_c(c).cast("double"), F.lit(0.0))
    bs, ds, br, dr = z("bm25_score"), z("dense_score"), z("bm25_rank"), z("dense_rank")
    bh, dh = br > 0, dr > 0
    gap = F.when(bh, br).otherwise(top + 1) - F.when(dh, dr).otherwise(top + 1)
    same_category, same_brand = z("category_match_flag") > 0, z("brand_match_flag") > 0
    conflict = (z("color_conflict_flag") + z("material_conflict_flag") + z("gender_conflict_flag") + z("age_conflict_flag")) > 0
    return {
        "retrieval_bm25_score": bs, "retrieval_dense_score": ds, "retrieval_dense_score_real": ds, "retrieval_bm25_rank": br, "retrieval_dense_rank": dr, "retrieval_dense_rank_real": dr,
        "retrieval_dense_rank_percentile": dr / top,
        "retrieval_in_bm25_topk_flag": _flag(bh), "retrieval_in_dense_topk_flag": _flag(dh), "retrieval_dense_only_hit_flag": _flag(dh & ~bh), "retrieval_bm25_dense_overlap_flag": _flag(bh & dh),
        "retrieval_dense_bm25_rank_gap": gap.cast("double"),
        "retrieval_hybrid_consensus_flag": _flag(bh & dh & (F.abs(gap) <= max(3, top * 0.1))), "retrieval_rank_agreement_flag": _flag(bh & dh),
        "retrieval_lexical_dense_gap": bs - ds,
        "retrieval_low_lexical_high_dense_flag": _flag((bs < 0.15) & (ds >= 0.35)), "retrieval_high_lexical_low_dense_flag": _flag((bs >= 0.35) & (ds < 0.15)),
        "retrieval_category_match_dense_high_flag": _flag(same_category & (ds >= 0.35)), "retrieval_attribute_conflict_dense_high_flag": _flag(conflict & (ds >= 0.35)),
        "retrieval_same_category_pool_flag": _flag(same_category | (text_or_empty(_c("source_pool")) == "category_filtered_pool")), "retrieval_same_brand_pool_flag": _flag(same_brand | (text_or_empty(_c("source_pool")) == "brand_aware_pool")),
    }


def metadata() -> dict[str, Column]:
    t, q = tokens(_c("title")), tokens(_c("query"))
    fields = [_c(f) for f in ("query", "title", "category", "brand", "gender", "age_group", "attributes")]
    count = lambda cs: sum((c.cast("int") for c in cs), F.lit(0))
    return {
        "meta_title_token_count": F.size(t),
        "meta_query_title_len_ratio": safe_div(F.size(q), F.size(t)),
        "meta_brand_present_flag": _flag(~is_unknown(_c("brand"))),
        "meta_attribute_count": F.size(F.flatten(F.map_values(attribute_map_of_json(_c("attribute_dict"))))),
        "meta_missing_field_count": count(normalize_text(f) == "" for f in fields),
        "meta_unknown_field_count": count(is_unknown(_c(f)) for f in ("gender", "age_group")),
        "meta_title_numeric_density": safe_div(F.size(numeric_tokens(_c("title"))), F.size(t)),
        "meta_title_symbol_density": symbol_density(_c("title")),
    }


GROUPS = {"lexical": lexical, "category": category, "brand": brand, "attribute": attribute, "gender_age": gender_age, "query": query, "retrieval": retrieval, "metadata": metadata}
OPTIONAL = {"bm25_score", "bm25_rank", "dense_score", "dense_rank", "category_match_flag", "brand_match_flag", "color_conflict_flag", "material_conflict_flag", "gender_conflict_flag", "age_conflict_flag", "source_pool"}


#: What the semantic features compare a query with.
_SIDES = {"sem_query_title_cosine": "_title", "sem_query_item_full_text_cosine": "_full", "sem_query_category_cosine": "_category"}


def _semantic_texts(pairs: DataFrame, *others: str) -> DataFrame:
    return pairs.select(*others, text_or_empty(_c("query")).alias("_query"), text_or_empty(_c("title")).alias("_title"), text_or_empty(full_item_text()).alias("_full"), text_or_empty(_c("category")).alias("_category"))


def fit_semantic(pairs: DataFrame) -> dict[str, TermWeightsModel]:
    """Term statistics of the pairs' queries with their titles, full texts and categories, for ``semantic_features``."""
    texts = _semantic_texts(pairs)
    return {name: TermWeights(["_query", side]).fit(texts) for name, side in _SIDES.items()}


def semantic_features(pairs: DataFrame, key: str, models: dict[str, TermWeightsModel] | None = None) -> DataFrame:
    """TF-IDF cosines of the query with title, full text and category, by the given statistics or by those of the pairs at hand.

    A row per pair; weights are worked out once per distinct text.
    """
    return _with_cosines(_semantic_texts(pairs, key), models or fit_semantic(pairs)).select(key, *_SIDES)


def _with_cosines(rows: DataFrame, models: dict[str, TermWeightsModel]) -> DataFrame:
    """The rows of ``_semantic_texts`` with their cosines; no key takes part, so rows may share one."""
    for name, model in models.items():
        weighed = model.weights(model.weights(rows, "_query", "_q"), _SIDES[name], "_i")
        rows = weighed.transform(sparse_dot("_q", "_i", name)).drop("_q", "_i")
    return rows


def out_of_fold_semantic(pairs: DataFrame, key: str, fold: str = "fold") -> DataFrame:
    """The semantic features of every fold, by statistics of the other folds alone."""
    folds = [r[0] for r in pairs.select(fold).distinct().collect()]
    parts = [semantic_features(pairs.where(_c(fold) == f), key, fit_semantic(pairs.where(_c(fold) != f))) for f in folds]
    return reduce(DataFrame.unionByName, parts)


def pair_features(pairs: DataFrame, key: str = "id", groups: tuple[str, ...] = (*GROUPS, "fuzzy", "semantic")) -> DataFrame:
    """The key and the features of the chosen groups, all numeric and never null.

    Plain groups are one projection.  'fuzzy' runs a vectorised UDF over distinct
    (query, title) pairs, 'semantic' needs corpus counts; both join by the texts,
    so rows that share a key keep features of their own.  Where means are wanted
    and not rows, ``feature_means`` makes no row per pair.
    """
    have = pairs.withColumns({c: F.lit(None).cast("string" if c == "source_pool" else "double") for c in OPTIONAL if c not in pairs.columns})
    columns: dict[str, Column] = {}
    for g in groups:
        if g in GROUPS:
            columns |= GROUPS[g]()
    made = [F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in columns.items()]
    out = _semantic_texts(have, key, "query", "title", *made) if "semantic" in groups else have.select(key, "query", "title", *made)
    if "fuzzy" in groups:
        out = similarity.on_distinct_pairs(out, "query", "title", lex_fuzzy_ratio=similarity.seq_ratio, lex_token_sort_ratio=similarity.token_sort_ratio)
    if "semantic" in groups:
        out = _with_cosines(out, fit_semantic(pairs)).drop("_query", *_SIDES.values())
    return out.drop("query", "title")


#: The side of an item that a group's features read with the query, and the features that read another one.
_GROUP_SIDES = {"lexical": "title", "category": "category", "brand": "brand", "attribute": "attributes", "gender_age": "wearer", "query": "none", "retrieval": "place", "metadata": "title"}
_OWN_SIDES = {"meta_brand_present_flag": "brand", "meta_attribute_count": "attributes", "meta_unknown_field_count": "wearer", "meta_missing_field_count": "blank"}
#: Queries up to which their vectors are broadcast to the pairs that met their items; more are joined before.
BROADCAST_QUERIES = 50_000


def _item_sides(item_id: str) -> dict[str, dict[str, Column]]:
    """Per side the columns that its features read, cut down to what tells items apart there.

    Numbers stand for texts that only their numbers are read of, and any letter
    for a text that is only asked whether it is blank.  What a hit is judged by
    is kept of items that are hits (``_hit``), as conflicts count for those alone.
    """
    same = lambda *names: {c: _c(c) for c in names}
    numbers = lambda c: F.array_join(numeric_tokens(_c(c)), " ")
    hit = {n: F.when(_c("_hit"), _c(c)) for n, c in ((item_id, item_id), *((c, c) for c in ("gender", "age_group", "color_value", "material_value")))}
    return {
        "title": same("title"),
        "category": same("category"),
        "brand": same("brand"),
        "attributes": same("attribute_dict", "normalized_attribute_text") | {c: numbers(c) for c in ("attributes", "title")},
        "wearer": same("gender", "age_group"),
        "blank": {c: F.when(normalize_text(_c(c)) == "", "").otherwise("x") for c in ITEM_FIELDS},
        "place": same("category", "brand") | hit,
    }


def feature_means(pairs: DataFrame, asks: DataFrame, queries: DataFrame, items: DataFrame, hits: DataFrame, flags: dict[str, Column], term_id: str = "term_id", item_id: str = "item_id") -> DataFrame:
    """(feature, n, mean): all groups of ``pair_features`` over all pairs of a term and an item, without a row of features per pair.

    ``asks`` (term, asked) gives a term its row of ``queries`` (asked, query,
    intent columns), whose texts differ; ``items`` have their attribute columns,
    ``hits`` (asked, item, scores and ranks) are at most one per query and item,
    and ``flags`` are the columns of the retrieval group besides.

    A feature reads the query and one side of the item, so pairs are counted by
    query and side, and each such pair of texts has its features made once.
    Pairs are moved once, as two numbers, to their items; there they meet the
    hashes of the items' sides and, for the cosine with the full text, the
    weights of those terms that some query holds.
    """
    spark = pairs.sparkSession
    sides = _item_sides(item_id)
    with Work(spark) as work:
        asks, queries, hits = work.written(asks.select(term_id, "asked"), "asks"), work.written(queries, "queries"), work.written(hits, "hits")
        narrow = pairs.select(term_id, item_id).join(asks, term_id, "left").select("asked", item_id)
        marked = items.join(hits.select(item_id, F.lit(True).alias("_hit")).distinct(), item_id, "left")
        split = marked.select(item_id, text_or_empty(full_item_text()).alias("_full"), *(F.struct(*(c.alias(n) for n, c in columns.items())).alias(side) for side, columns in sides.items()))
        split = work.written(split.select("*", *(F.unhex(F.md5(F.to_json(side))).alias(f"_{side}") for side in sides)), "sides")

        per_query = narrow.groupBy("asked").agg(F.count("*").alias("n")).join(queries, "asked", "left").select("asked", text_or_empty(_c("query")).alias("text"), "n")
        per_query = work.written(per_query, "per-query")
        per_full = narrow.groupBy(item_id).agg(F.count("*").alias("n")).join(split, item_id, "left").select(text_or_empty(_c("_full")).alias("text"), "n")
        full = TermWeights(["text"], "n").fit(per_query.select("text", "n").unionByName(per_full))
        asked_full = work.written(full.weights(per_query.select("asked", "text"), "text", "_q").select("asked", "_q"), "asked-full")
        met_terms = asked_full.select(F.explode("_q.ids").alias("id")).distinct()
        weighed = full.weights(split.select(item_id, "_full", *(f"_{side}" for side in sides)), "_full", "_i", met_terms).drop("_full")
        if asked_full.count() > BROADCAST_QUERIES:
            met = narrow.join(asked_full, "asked", "left").join(weighed, item_id, "left")
        else:
            met = narrow.join(weighed, item_id, "left").join(F.broadcast(asked_full), "asked", "left")
        keys = ["asked", *(f"_{side}" for side in sides)]
        sets = {"none": keys[:1]} | {side: ["asked", f"_{side}"] for side in sides}
        mask = {side: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in held) for side, held in sets.items()}
        met = met.transform(sparse_dot("_q", "_i", "_cosine"))
        counts = work.written(met.groupingSets([[_c(k) for k in held] for held in sets.values()], *keys).agg(F.grouping_id().cast("int").alias("_set"), F.count("*").alias("n"), F.coalesce(F.sum("_cosine"), F.lit(0.0)).alias("_cosines")), "counts", "_set")

        made: dict[str, dict[str, Column]] = {side: {} for side in sets}
        for group, features in GROUPS.items():
            for name, c in features().items():
                made[_OWN_SIDES.get(name, _GROUP_SIDES[group])][name] = c
        made["title"] |= {"lex_fuzzy_ratio": similarity.seq_ratio(_c("query"), _c("title")), "lex_token_sort_ratio": similarity.token_sort_ratio(_c("query"), _c("title"))}
        made["none"]["sem_query_item_full_text_cosine"] = _c("_cosines") / _c("n")
        parts = []
        for side, columns in made.items():
            rows = spread(counts.where(_c("_set") == mask[side]).select(*sets[side], "n", "_cosines"))
            if side in sides:
                texts = split.select(f"_{side}", f"{side}.*").dropDuplicates([f"_{side}"])
                rows = rows.join(texts, f"_{side}", "left")
            if side in ("title", "category"):
                name, text = f"sem_query_{side}_cosine", text_or_empty(_c(side))
                rows = spread(work.written(rows, f"with-{side}"))
                model = TermWeights(["text"], "n").fit(per_query.select("text", "n").unionByName(rows.select(text.alias("text"), "n")))
                rows = rows.join(model.weights(per_query.select("asked", "text"), "text", "_q").select(_c("asked").alias("_asked"), "_q"), _c("asked").eqNullSafe(_c("_asked")), "left")
                rows = model.weights(rows, side, "_i").transform(sparse_dot("_q", "_i", name)).drop("_q", "_i", "_asked")
                columns[name] = _c(name)
            rows = rows.join(queries, "asked", "left")
            if side == "place":
                rows = rows.join(hits, ["asked", item_id], "left").withColumns(flags)
            values = rows.select("n", *(F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in columns.items()))
            summed = values.agg(F.sum("n").alias("n"), *(F.sum(_c("n") * _c(c)).alias(c) for c in columns))
            each = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.round(_c(c) / _c("n"), 6).alias("mean")) for c in columns)))
            parts.append(summed.where("n > 0").select("n", each.alias("x")).select("x.feature", "n", "x.mean"))
        return cut(reduce(DataFrame.unionByName, parts))


def explained(features: DataFrame, key: str = "id") -> DataFrame:
    """One struct per group of features instead of one column per feature."""
    prefix = {"lexical": "lex_", "category": "cat_", "brand": "brand_", "attribute": "attr_", "query": "query_", "retrieval": "retrieval_", "semantic": "sem_", "metadata": "meta_"}
    structs = [F.struct(*(c for c in features.columns if c.startswith(p))).alias(g) for g, p in prefix.items() if any(c.startswith(p) for c in features.columns)]
    return features.select(key, *structs)
