"""The text operators against brute force, exact round trips and edge cases."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.llm import language, language_model, packing, toxicity
from quillon.llm.decontamination import decontaminate
from quillon.llm.html_extraction import Page, extract_main_text
from quillon.llm.jaccard_join import join_components
from quillon.llm.licenses import scan_licenses
from quillon.llm.token_counts import count_tokens
from quillon.llm.topk_search import search, top_k

SCHEMA = "doc_id bigint, text string, extra string"
ODD = [(1, None, "x"), (2, "", "x"), (3, "  \n\t ", "x"), (4, "word", "x"), (4, "word", "x"), (5, "çğ 😀 ▁ \x00 a", "x"), (None, "no id here at all", "x"), (7, "a long one " * 5000, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


ARTICLE = "<h1>Title &amp; more</h1><p>First  paragraph,\n with a <b>bold</b> word.</p><p>Second&nbsp;one.<br>Next</p><ul><li>Item one.</li><li>Item two.</li></ul>"
WANTED = "Title & more\nFirst paragraph, with a bold word.\nSecond one. Next\nItem one.\nItem two."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav><a href='/'>Home</a></nav><article>{ARTICLE}</article><footer>&copy; x</footer></body></html>",
        f"<body><header><h1>Site</h1></header><div id='sidebar'><p>Side text here.</p></div><div class='content'>{ARTICLE}</div><div class='cookie-notice'>We use cookies.</div></body>",
        f"<main>{ARTICLE}<form><input><label>Mail</label></form><div class='ad-slot'>Buy this now.</div></main><section id='comments'><div class='comment'><p>Great article, really.</p></div></section>",
        f"<article><script>var t = '</p><p>no';</script><style>p{{}}</style><!-- <p>no</p> -->{ARTICLE}",
        f"<article>{ARTICLE}<aside>Related things.</aside></article><noscript>Enable it.</noscript><a hr",
    ],
)
def test_main_text(page):
    read = Page(page)
    assert read.text(read.best(None)) == WANTED


def test_page_inside_one_form_and_title_before_the_content():
    wrapped = f"<body><form id='aspnetForm'><div class='top'><label>Find</label><input></div><div class='content'>{ARTICLE}</div></form><form><p>Get our letter.</p></form></body>"
    read = Page(wrapped)
    assert read.text(read.best(None)) == WANTED
    title, rest = ARTICLE.split("</h1>")
    read = Page(f"<body><div class='w'>{title}</h1><div class='content'>{rest}</div><div class='share'>Tell others.</div></div></body>")
    assert read.text(read.best(None)) == WANTED


def test_long_classes_stay_apart():
    classes = " ".join(f"utility-class-x{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(5))
    read = Page(f"<div class='{classes} one'><p>{'A sentence of prose. ' * 9}</p></div><div class='{classes} two'><p>{'Links and bits. ' * 9}</p></div>")
    assert len({p for _, p, _ in read.containers}) == 3


def test_extraction_keeps_odd_pages(spark):
    rows = [(1, None, None), (2, "http://a.example/x", ""), (3, "http://a.example/y", "<p>One sentence.</p>"), (3, "http://a.example/y", "<p>One sentence.</p>"), (None, "bad", "<"), (5, "//h", "<div>" * 3000 + "deep text.")]
    out = extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert Counter((r.page_id, r.text) for r in out) == Counter({(1, ""): 1, (2, ""): 1, (3, "One sentence."): 2, (None, ""): 1, (5, "deep text."): 1})
    assert all(r.n_chars == len(r.text) for r in out)


def test_host_consensus_beats_a_page_of_its_own(spark):
    usual = [(i, f"http://h.example/{i}", f"<body><div class='x9'><p>{'An honest sentence. ' * 20}</p></div><div class='y'><p>{'Short tail.'}</p></div></body>") for i in range(20)]
    out = extract_main_text(spark.createDataFrame(usual, "page_id bigint, url string, html string")).select("path").distinct().collect()
    assert len(out) == 1


def test_token_counts_match_the_library(spark, odd, empty):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["Hello  world", " lead", "trail ", "naïve café ☃ 日本語", "<s> </s> <unk>", "a" * 300, "x▁y", "ba" * 50]
    docs = odd.union(spark.createDataFrame([(10 + i, t, "") for i, t in enumerate(texts)], SCHEMA))
    out = count_tokens(docs).collect()
    expected = Counter((i, len(t.encode()), len(model.encode(t))) for i, t in [(r[0], r[1] or "") for r in ODD] + [(10 + i, t) for i, t in enumerate(texts)])
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == expected
    assert count_tokens(empty).count() == 0


def test_packing_holds_every_id_once(spark, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    out = packing.pack_documents(docs).collect()
    for doc_id, text in {(r[0], r[1]) for r in ODD if r[0] is not None}:
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r for r in out if r.doc_id == doc_id), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(ids)
        at = 0
        for r in pieces:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
    ends = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(n <= 2048 for n in ends.values())
    assert packing.pack_documents(empty).count() == 0


def test_packing_of_examples_respects_all_limits(spark):
    turns = [(i, [("question " * (i % 7 + 1), False), ("answer " * (i % 5 + 1), True)]) for i in range(200)]
    limits = packing.Limits(64, 4, 20)
    out = packing.pack_examples(spark.createDataFrame(turns, "example_id bigint, turns array<struct<text:string,loss:boolean>>"), limits).collect()
    by: dict[int, list] = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append(r)
    assert len(out) == 200
    for rows in by.values():
        assert sum(r.length for r in rows) <= 64
        assert len(rows) <= 4
        assert sum(r.loss_tokens for r in rows) <= 20


def test_benchmark_windows(spark, odd, empty):
    item = "One two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item), (2, "short item"), (3, None), (4, "...")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "Before, ONE two-three four five six seven eight nine ten ELEVEN after", ""), (2, "a short, item here", ""), (3, "one two three four", "")], SCHEMA)
    out = {r.doc_id: r for r in decontaminate(docs, bench).collect()}
    assert [(h["first"], h["last"]) for h in out[1].hits] == [(1, 11)]
    text = docs.where("doc_id = 1").first().text
    assert text[out[1].hits[0]["start"] : out[1].hits[0]["end"]].lower().startswith("one two-three")
    assert (out[2].items, out[3].items) == (["2"], [])
    assert decontaminate(odd, bench).count() == len(ODD)
    assert decontaminate(empty, bench).count() == 0
    assert decontaminate(odd, bench.limit(0)).where(F.size("hits") > 0).count() == 0


def shingled(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_jaccard_components_match_brute_force(spark, empty):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 120))) for _ in range(60)]
    common = " ".join(rng.choice(vocabulary, 40))
    for i in range(120):  # near copies, some of them of copies, and a passage that many share
        words = texts[rng.integers(0, len(texts))].split()
        for _ in range(rng.integers(0, 3)):
            words[rng.integers(0, len(words))] = f"n{rng.integers(0, 50)}"
        texts.append(" ".join(words) + (" " + common if i % 4 == 0 else ""))
    rows = [(i, t, "") for i, t in enumerate(texts)] + [(500, None, ""), (501, "", ""), (502, texts[3], ""), (503, texts[3].upper(), ""), (None, texts[3], "")]
    sets = {i: shingled(t) for i, t, _ in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i in keys:
        for j in keys:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in join_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: out[i] for i in sets} == {i: (len(sets[i]), find(i)) for i in sets}
    assert out[None][1] is None
    assert join_components(empty).count() == 0


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 12)) / 3
    x[100:400] = x[7]  # a third of the rows is one vector
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(2000, None), (2020, [1.0, float("nan")]), (2040, []), (2060, [1.0, 2.0]), (2061, [0.5, -1.0])]
    out = top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    whole = np.floor(64 * x).astype(int)
    expected = {}
    for q in range(0, 900, 20):
        s = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        expected[q] = [(int(i), int(s[i])) for i in order]
    expected[2060] = [(2061, 64 * 32 + 128 * -64)]
    found: dict[int, list] = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == expected


def test_top_k_of_huge_components_and_many_lengths(spark):
    rows = [(0, [1e30, 1.0]), (20, [1.0, 2.0]), (21, [-1e30, 3.0]), (22, [3.0, -1.0]), (23, [2.0**40, 1.0])] + [(1000 + i, [0.5] * (i // 2 + 3)) for i in range(3000)]
    docs = spark.createDataFrame([(i, v, 7, 1) for i, v in rows], "vec_id bigint, embedding array<double>, size int, rank int")
    out = top_k(docs, F.col("vec_id") % 20 == 0).collect()
    limit = lambda v: min(2**63 - 1, max(-(2**63), v))
    found: dict[int, list] = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    whole = {i: [int(np.floor(64 * c)) for c in v] for i, v in rows}
    for q in [0, 20, 1000, 1020, 3980]:
        scores = [(i, limit(sum(a * b for a, b in zip(whole[q], v, strict=True)))) for i, v in whole.items() if i != q and len(v) == len(whole[q])]
        assert found.get(q, []) == sorted(scores, key=lambda s: (-s[1], s[0]))[:20]
    assert top_k(docs.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_reading_stops_before_the_ends_of_the_lists(spark):
    rng = np.random.default_rng(4)
    x = rng.exponential(size=(3000, 8)) ** 3
    took = search(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>"), F.col("vec_id") % 20 == 0).agg(F.avg(F.col("parts") / (16 * F.col("met"))).alias("read"), F.avg(F.col("resolved") / F.col("met")).alias("resolved")).first()
    assert took.read < 0.4 and took.resolved < 0.2


def test_licences(spark, odd):
    mit = "Copyright (c) 2020 Someone\nReleased under the MIT License."
    docs = odd.union(spark.createDataFrame([(20, "Text before.\n" + mit + "\nText after.", ""), (21, "Licensed under CC BY-SA 4.0.", ""), (22, "The licence of this is unknown to me.", "")], SCHEMA))
    out = {r.doc_id: sorted({m["license"] for m in r.matches}) for r in scan_licenses(docs).collect()}
    assert (out[20], out[21], out[22], out[1]) == (["MIT"], ["CC-BY-SA-4.0"], [], [])


def test_language(spark, odd, empty):
    words = {"aa": "bado kulu mira", "bb": "xyst wprt zqrk"}
    docs = spark.createDataFrame([(i, " ".join([words[k]] * 5), k) for i, k in enumerate(["aa", "bb"] * 10)] + [(99, None, "aa"), (98, "text", None)], "doc_id bigint, text string, lang string")
    trees = language.train(docs, F.lit(True))
    out = {r.doc_id: r for r in language.identify(docs, trees).collect()}
    assert [out[i].lang_pred for i in (0, 1, 99)] == ["aa", "bb", "und"]
    assert all(0 <= r.score <= 1 for r in out.values())
    assert language.identify(odd, trees).count() == len(ODD)
    assert language.identify(odd, language.train(docs.limit(0), F.lit(True))).where("lang_pred <> 'und'").count() == 0
    assert language.identify(empty, trees).count() == 0


def test_code_lengths_match_a_direct_model():
    rng = np.random.default_rng(6)
    letters = {"aa": "abcdeé", "bb": "abcxyzß"}
    texts = {k: [" ".join("".join(rng.choice(list(v), rng.integers(1, 7))) for _ in range(40)) for _ in range(6)] for k, v in letters.items()}
    stream = lambda t: "".join(" " + w for w in t.lower().split()).encode()
    batch = pa.RecordBatch.from_arrays([pa.array([k for k in texts for _ in texts[k]]), pa.array([t for k in texts for t in texts[k]])], names=["lang", "text"])
    found = pa.Table.from_batches(list(language.counted(iter([batch])))).to_pandas().groupby(["lang", "k", "key"], as_index=False).n.sum()
    scorer = language.Scorer({k: language.Tree.of(*(own[c].to_numpy() for c in ("k", "key", "n"))) for k, own in found.groupby("lang")})

    def direct(lang, text):
        follow: dict[bytes, Counter] = {}
        for t in texts[lang]:
            s = stream(t)
            for i in range(len(s)):
                for k in range(min(i, language.DEPTH) + 1):
                    follow.setdefault(s[i - k : i], Counter())[s[i]] += 1
        bits, s = 0.0, stream(text)
        for i in range(len(s)):
            for k in range(min(i, language.DEPTH), -1, -1):
                seen = follow.get(s[i - k : i])
                if not seen:
                    continue
                total = sum(seen.values()) + len(seen)
                if s[i] in seen:
                    bits += np.log2(total / seen[s[i]])
                    break
                bits += np.log2(total / len(seen))
            else:
                bits += 8
        return bits

    asked = [texts["aa"][0], "a", "abc x\n\nyz", "Éa ß 中文 " * 3, "", "x" * 300 + " ab", texts["bb"][1] + texts["aa"][2]]
    for _ in range(2):  # the second time from the memos
        got = scorer.bits(asked)
        assert np.allclose(got, [[direct(k, t) for k in scorer.langs] for t in asked], rtol=1e-12)


def test_toxicity_without_labels_is_the_share(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(odd.select("doc_id", "text"), labels.limit(0), F.lit(True))
    out = toxicity.score(odd, model).collect()
    assert {(r.score, r.predicted) for r in out} == {(0.0, 0)}
    assert toxicity.score(empty, model).count() == 0


def test_language_model_counts_match_brute_force(spark, odd, empty):
    docs = odd.union(spark.createDataFrame([(20 + i, "the cat sat on the mat Cat", "") for i in range(30)], SCHEMA))
    learn = lambda c: c % 3 != 0
    out = language_model.score_texts(docs, learn).collect()
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)})), None]
    rows = docs.collect()
    counts = Counter(w for r in rows if r.doc_id is not None and r.doc_id % 3 != 0 for w in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    expected = Counter((r.doc_id, len(t), sum(counts[w] > 0 for w in t), n, round(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for r in rows for t in [tokens(r.text)])
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == expected
    assert all(np.isfinite(r.score) and r.score < 0 for r in out)
    assert language_model.score_texts(empty, learn).count() == 0


def test_language_model_is_a_distribution():
    rng = np.random.default_rng(0)
    w, b = rng.normal(size=(4, language_model.LEAST_BUCKETS, language_model.CLASSES)).astype(np.float32), np.zeros(language_model.CLASSES, np.float32)
    features = [rng.integers(0, language_model.LEAST_BUCKETS, 50) for _ in range(4)]
    p = language_model.probabilities(w, b, features)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    y = rng.integers(0, language_model.CLASSES, 50)
    assert np.allclose(language_model.log_probabilities(w, b, features, y), np.log10(p[np.arange(50), y]), atol=1e-4)
