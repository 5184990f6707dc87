"""The pipeline's stages against plain Python."""

import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pipeline = pytest.importorskip("corpus_pipeline")
STAGES = dict(pipeline.STAGES)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, id string, predicted int"


def words_of(text, pattern):
    return re.findall(pattern, (text or "").translate({i: i + 32 for i in range(65, 91)}))


def shingled(text):
    words = words_of(text, r"[^\x20\x09-\x0D]+")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def prose(rng, lang, n):
    parts = {"en": ["the", "tion", "ing", "and", "er", "ou"], "de": ["sch", "und", "ich", "ung", "ei", "zw"]}[lang]
    return " ".join("".join(rng.choice(parts, rng.integers(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(12)
    folder = str(tmp_path_factory.mktemp("corpus"))
    item = prose(rng, "en", 14)
    docs, labels = [], []
    for i in range(240):
        lang = "en" if i % 2 else "de"
        text = prose(rng, lang, int(rng.integers(20, 60)))
        if i % 5 == 0:
            text += " you idiot, what scum and moron trash"
        labels.append((i, int(i % 5 == 0)))
        if i % 16 == 1:
            text += f" {item} {prose(rng, lang, 5)}"
        docs.append((i, text, lang))
    for i in range(40):  # near copies and exact ones
        text = docs[3 * i + 1][1]
        docs.append((300 + i, text if i % 2 else text + " tail", docs[3 * i + 1][2]))
    docs += [(400, None, "en"), (401, "", "en"), (402, "123 456 !!", None), (403, prose(rng, "de", 9000), "de"), (None, prose(rng, "en", 30), "en"), (1, docs[1][1], "en"), (1, prose(rng, "en", 40), "en")]
    spark.createDataFrame([(i, t, lang, "s", len(t or ""), 0.5, "x", 1) for i, t, lang in docs], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(7, item), (8, None), (9, "absent words of some length that no document has at all in it")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def rows_of(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_toxic_documents_go_and_clean_ones_stay(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    out = STAGES["toxicity"](spark, docs, corpus)
    assert out.columns == docs.columns
    toxic = {i for i in range(0, 240, 5)}
    kept = rows_of(out)
    assert not [i for i, _ in kept if i in toxic]
    assert kept == Counter({k: n for k, n in rows_of(docs).items() if " scum " not in (k[1] or "")})


def test_documents_of_unknown_language_go(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    out = STAGES["language_id"](spark, docs, corpus)
    assert out.columns == docs.columns
    assert rows_of(out) == Counter({k: n for k, n in rows_of(docs).items() if re.search(r"[^\W\d_]", k[1] or "")})


def test_one_of_each_group_stays(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    rows = rows_of(docs)
    ids = sorted({i for i, _ in rows if i is not None})
    sets = {i: [s for k, t in rows if k == i and (s := shingled(t))] for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if b < a and any(100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    expected = Counter({k: 1 if k[0] is not None else n for k, n in rows.items() if k[0] is None or find(k[0]) == k[0]})
    out = STAGES["ngram_jaccard_join"](spark, docs, corpus)
    assert out.columns == docs.columns
    assert rows_of(out) == expected


def test_contaminated_documents_go(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    pattern = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect():
        w = words_of(r.text, pattern)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()

    def clean(text):
        w = words_of(text, pattern)
        return not any(tuple(w[i : i + len(x)]) == x for x in windows for i in range(len(w) - len(x) + 1))

    out = STAGES["benchmark_decontamination"](spark, docs, corpus)
    assert out.columns == docs.columns
    kept = rows_of(out)
    assert kept == Counter({k: n for k, n in rows_of(docs).items() if clean(k[1])})
    assert not [i for i, _ in kept if i is not None and i % 16 == 1 and i < 240 and i != 1]


def test_packing_and_the_whole(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = pipeline.run(spark, corpus).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{corpus}/documents.parquet").collect() if r.doc_id is not None and r.doc_id != 1}
    by: dict = {}
    for r in out:
        if r.doc_id in docs:
            by.setdefault(r.doc_id, []).append(r)
    assert by and not [i for i in by if i % 5 == 0 and i < 240]
    for i, pieces in by.items():
        ids = np.array([*tokenizer.encode(docs[i] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_empty_table(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    assert os.path.isdir(tmp_path)


def test_columns_of_documents_survive_the_join_whatever_their_names(spark, corpus):
    rows = [(1, "a b c d e f", "x", 7, "y"), (1, "a b c d e f", "x", 7, "y"), (2, "a b c d e f", "x", 7, "y"), (3, "g h i j k", "z", 8, "w"), (None, None, "v", 9, "u")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _text string, _place int, doc string")
    out = STAGES["ngram_jaccard_join"](spark, docs, corpus)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[3], rows[4]], key=str)
