"""Sum-of-squares packing: the rule step by step, ids against the library, and sequences that hold every token once."""

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from quillon.llm import best_fit, queries  # noqa: E402

VOCABULARY = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


TRICKY = [
    "", " ", "Hello, World!", "don't we'll I'VE 'slow 's' dogs' rock'n'roll", "a,b;c... (x) [y] -- end.", "Straße ÉCOLE İstanbul ΣΑΣ ﬁne", "étude, ñ. ́x", " x y\x1cz\x85w", "12.5% 3,000 ²³ ½!",
    "<|endoftext|> and <|ENDOFTEXT|> <|startoftext|>x <| endoftext|>", "日本語、テスト。", "emoji 👍🏽! 👍,", "a‍b​.", "x" * 3000 + "!!", "KK Ωm.", "≠ ≠ ≮. a≮,", "_under_score_ __", "tab\tnew\nline\r\x0b\x0c.",
]


def test_ids_are_the_librarys(library):
    draw = random.Random(3)
    letters = "abcXYZ '’.,!é́ßñ中0９_-<|>\n\t "
    texts = TRICKY + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    texts += [chr(c) * n + end for c in range(0xA0, 0x250) for n, end in ((1, ""), (2, "x."))]
    enc = best_fit.WordEncoder(VOCABULARY, memo=500)
    for i in range(0, len(texts), 100):
        some = texts[i : i + 100]
        expected = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
        assert [x.tolist() for x in enc.encode(some)] == expected


def squares(gaps):
    return sum(n * n for g, n in Counter(gaps).items() if g)


def test_each_size_goes_where_the_squares_become_smallest():
    draw = random.Random(5)
    for _ in range(60):
        capacity = draw.randint(4, 40)
        sizes = np.array([draw.randint(1, capacity) for _ in range(draw.randint(1, 60))])
        bins, offsets = best_fit.sum_of_squares(sizes, capacity)
        gaps = [capacity] * -(-int(sizes.sum()) // capacity)
        for i in np.argsort(-sizes, kind="stable").tolist():
            fitting = [b for b, g in enumerate(gaps) if g >= sizes[i]]
            if not fitting:
                assert bins[i] == len(gaps)
                gaps.append(capacity)
            else:
                after = {b: squares([*gaps[:b], gaps[b] - sizes[i], *gaps[b + 1 :]]) for b in fitting}
                assert after[int(bins[i])] == min(after.values())
            assert offsets[i] == capacity - gaps[bins[i]]
            gaps[bins[i]] -= sizes[i]
        assert min(gaps) >= 0


def test_few_sequences_are_left_open():
    draw = np.random.default_rng(7)
    for n in (200, 2000, 8000):
        sizes = np.minimum(1 + (draw.pareto(1.2, n) * 200).astype(np.int64), 4096)
        bins, _ = best_fit.sum_of_squares(sizes, 4096)
        assert len(set(bins.tolist())) <= -(-int(sizes.sum()) // 4096) + 2
    assert [x.tolist() for x in best_fit.sum_of_squares(np.zeros(0, np.int64), 8)] == [[], []]
    assert sorted(best_fit.sum_of_squares(np.array([8, 8, 8]), 8)[0].tolist()) == [0, 1, 2]


def check(rows, texts, library, capacity, ids=False):
    """Every id of every text lies in one piece, pieces are cut at the capacity alone, sequences have no gap."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(of_doc) == set(texts)
    for key, parts in of_doc.items():
        whole = np.array([*library.encode(texts[key] or "", add_special_tokens=False).ids, 1], "<u4")
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start for r in parts] == list(range(0, len(whole), capacity))
        for r in parts:
            part = whole[r.start : r.start + capacity]
            assert (r.length, r.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
            assert not ids or r.ids == part.tolist()
    for held in of_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(of_sequence)


def test_packs_nulls_long_texts_and_repeated_rows(spark, library):
    texts = {1: "short text", 2: None, 3: "", 4: "many words " * 500, 5: TRICKY[9], 6: "x" * 4000}
    docs = spark.createDataFrame([(k, t, "s", 7) for k, t in texts.items()], "doc_id bigint, text string, piece string, length int")
    for group in (2, 100):
        check(best_fit.pack_best_fit(docs, capacity=64, group_pieces=group, with_ids=True).collect(), texts, library, 64, ids=True)
    again = spark.createDataFrame([(1, "short text"), (1, "short text"), (None, "short text")], "doc_id bigint, text string")
    rows = best_fit.pack_best_fit(again).collect()
    assert sorted((r.doc_id or 0, r.start, r.length) for r in rows) == [(0, 0, 3), (1, 0, 3), (1, 0, 3)]
    assert sorted(r.offset for r in rows) == [0, 3, 6]
    assert best_fit.pack_best_fit(docs.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are absent")
def test_query_packs_the_table(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op12_sum_of_squares(spark, sf).collect()
    n = check(rows, texts, library, 4096)
    assert n <= -(-sum(r.length for r in rows) // 4096) + 1
