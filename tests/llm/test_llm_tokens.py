"""Byte-level encoding, token counts and packing."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weftline.functions.checkpoints import checkpoint
from weftline.llm.bpe import encoder, independent_chunks, load_ranks, merge_bytes, vocabulary_path
from weftline.llm.budget import token_budget, token_counts
from weftline.llm.encode import encode_texts
from weftline.llm.packing import pack_documents, pack_histogram, pack_sizes
from weftline.functions.ranks import exact_ranks

ENCODER = encoder(vocabulary_path())
REFERENCE = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=load_ranks(vocabulary_path()), special_tokens={})
TEXTS = st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r\x0b\x85\xa0　'sdlmtrev09aé\x1c​")), max_size=80)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_encoding_is_that_of_the_reference_libraries(text):
    assert ENCODER.encode(text) == REFERENCE.encode_ordinary(text)


def test_second_library_agrees():
    other = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for text in ["Hello  world", "<|endoftext|>", "नमस्ते दुनिया", "a  b", "tabs\t\tand\r\nlines ", "x" * 500, "naïve ﬁn 👩‍👩‍👧"]:
        assert ENCODER.encode(text) == other.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 12))
def test_chunks_are_independent(text, limit):
    chunks = independent_chunks(text, limit)
    assert "".join(chunks) == text
    assert sum(map(ENCODER.count, chunks)) == len(REFERENCE.encode_ordinary(text))


def test_segment_tree_takes_the_leftmost_lowest_pair():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abab": 258, b"aa": 259}
    assert merge_bytes(b"ababc", ranks) == [258, 99]
    assert merge_bytes(b"aaaa", ranks) == [259, 259]
    assert merge_bytes(b"aaa", ranks) == [259, 97]
    assert merge_bytes(b"", ranks) == []


ROWS = [(1, "one two three", "x"), (2, None, None), (3, "", "y"), (4, "   ", "y"), (5, "word " * 40_000, "y"), (6, "one two three", "x"), (None, "no key", None)]


def test_encoding_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, _text string")
    got = {r.doc_id: r.ids for r in encode_texts(df, "doc_id", "text").collect()}
    assert got == {k: REFERENCE.encode_ordinary(t or "") for k, t, _ in ROWS}
    assert encode_texts(df.limit(0), "doc_id", "text").collect() == []


def test_counts_of_small_and_oversized_texts(spark):
    df = spark.createDataFrame(ROWS + ROWS[:1], "id bigint, text string, tokens string")
    for limit in (1 << 16, 1000, 5):
        got = {r.id: r.tokens for r in token_counts(df, "id", "text", chunk_chars=limit).collect()}
        assert got == {k: len(REFERENCE.encode_ordinary(t or "")) for k, t, _ in ROWS}
    assert token_counts(df.limit(0), "id", "text").collect() == []


def test_budget_takes_spelling_variants_as_one(spark):
    rows = [("a", "x y", " News", "pt-BR", "www.site.org"), ("a", "x y", " News", "pt-BR", "www.site.org"), ("b", "x", "NEWS ", "Portuguese", "SITE.org"), ("c", None, None, "und", "  "), ("d", "z", None, None, None)]
    df = spark.createDataFrame(rows, "id string, text string, source string, language string, domain string")
    got = {(r.slice, r.value): (r.documents, r.tokens) for r in token_budget(df, "id", "text").collect()}
    assert got[("source", "news")] == (2, 3) and got[("source", None)] == (2, 1)
    assert got[("language", "pt")] == (2, 3) and got[("language", None)] == (2, 1)
    assert got[("domain", "site.org")] == (2, 3) and got[("domain", None)] == (2, 1)
    assert got[("all", None)] == (4, 4)


def best_fit_decreasing(sizes, capacity):
    rooms = []
    for size in sorted(sizes, reverse=True):
        fitting = [r for r in rooms if r >= size]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - size)
        else:
            rooms.append(capacity - size)
    return len(rooms)


def test_packing_uses_up_the_items_and_no_more_containers_than_best_fit():
    rng = random.Random(7)
    for _ in range(200):
        capacity = rng.choice([5, 10, 20, 37, 100])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 60)))
        patterns = pack_histogram(dict(counts), capacity)
        used = Counter()
        for content, times in patterns:
            assert sum(content) <= capacity and times > 0
            for size in content:
                used[size] += times
        assert used == counts
        assert sum(t for _, t in patterns) <= best_fit_decreasing(counts.elements(), capacity) + 1


def optimum(sizes, capacity):
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1 :])
        place(i + 1, rooms + [capacity - sizes[i]])

    place(0, [])
    return best


def test_packing_is_near_the_optimum():
    rng = random.Random(3)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
        made = sum(t for _, t in pack_histogram(dict(Counter(sizes)), 20))
        assert made <= optimum(sizes, 20) + (1 if len(sizes) > 6 else 0)


def test_containers_of_rows(spark):
    rows = [(i, s) for i, s in enumerate([7, 7, 7, 3, 3, 3, 25, 10, 0, None, 1, 1, 9, 9])]
    got = pack_sizes(spark.createDataFrame(rows, "k int, size int"), "k", "size", 10).collect()
    load = Counter()
    for r in got:
        load[r.container] += r.size
    assert load.pop(0) == 0 and all(0 < v <= 10 for v in load.values())
    assert sorted(r.size for r in got if r.k == 6) == [5, 10, 10]
    whole = Counter(r.k for r in got)
    assert all(n == 1 for k, n in whole.items() if k != 6) and set(whole) == set(range(14))
    assert len(load) == 9
    assert pack_sizes(spark.createDataFrame([], "k int, size int"), "k", "size", 10).collect() == []
    with pytest.raises(ValueError):
        pack_sizes(spark.createDataFrame(rows, "k int, size int"), "k", "size", 0)


def test_packing_texts_keeps_every_row(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, size string")
    got = pack_documents(df, "doc_id", "text", 64).collect()
    load = Counter()
    for r in got:
        load[r.container] += r.size
    assert max(v for k, v in load.items() if k) <= 64
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}


def test_exact_ranks_are_those_of_a_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice("aaaab") if i % 9 else None, i % 7, i) for i in range(500)]
    df = checkpoint(spark.createDataFrame(rows, "g string, v int, k int").repartition(7))
    got = {r.k: r.before for r in exact_ranks(df, ["g"], ["v", "k"]).collect()}
    for g in {r[0] for r in rows}:
        own = sorted((v, k) for h, v, k in rows if h == g)
        assert [got[k] for _, k in own] == list(range(len(own)))


def test_large_and_small_texts_of_a_key_in_one_pass(spark):
    from weftline.llm import budget

    small, large = "one two three", "word and another, " * 900
    rows = [("a", small, "x"), ("a", large, "y"), ("a", large, "z"), ("b", large, None), ("b", small, "y"), ("c", None, "y"), (None, large, "y"), (None, large, "y"), ("d", "", None)]
    df = spark.createDataFrame(rows, "id string, text string, s string")
    plain = {r.id: (r.tokens, r.s) for r in budget.token_counts(df, "id", "text", carry={"s": F.col("s")}).collect()}
    cut = {r.id: (r.tokens, r.s) for r in budget.token_counts(df, "id", "text", chunk_chars=1000, carry={"s": F.col("s")}).collect()}
    assert plain == cut and plain["a"][1] == "x" and plain["b"][1] == "y" and plain["a"][0] == plain["b"][0] == plain[None][0] > 2000 and plain["c"][0] == plain["d"][0] == 0
    scans = budget.token_counts(df, "id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert scans.count("LogicalRDD") + scans.count("LocalRelation") == 1
