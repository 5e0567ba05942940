"""Tokens, packing, decontamination, duplicates, splits, by goldens and brute force."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions.checkpoints import checkpoint
from weftline.functions.ranks import exact_ranks
from weftline.operators import decontaminate, dedup, packing, splits, tokens

IDS = "id string, input_ids array<int>"


def test_exact_ranks(spark):
    rng = random.Random(5)
    rows = [(rng.choice("aaaab") if i % 9 else None, i % 7, i) for i in range(400)]
    df = checkpoint(spark.createDataFrame(rows, "g string, v int, k int").repartition(7))
    for weight in (None, "v"):
        got = {r.k: r.before for r in exact_ranks(df, ["g"], ["v", "k"], weight).collect()}
        for g in {r[0] for r in rows}:
            total = 0
            for v, k in sorted((v, k) for h, v, k in rows if h == g):
                assert got[k] == total
                total += v if weight else 1
    assert exact_ranks(df.limit(0), ["g"], ["k"]).collect() == []


def test_concatenation_golden(spark):
    rows = [(0, [1, 2], [1, 1]), (1, [3, 4, 5], [1, 1, 1]), (2, [6, 7, 8, 9], [1] * 4)]
    df = spark.createDataFrame(rows, "k int, input_ids array<int>, attention_mask array<int>")
    got = packing.concatenated(df, "k", 4).orderBy("block").collect()
    assert [r.input_ids for r in got] == [[1, 2, 3, 4], [5, 6, 7, 8]] and [r.attention_mask for r in got] == [[1] * 4] * 2 and {r.seq_lengths for r in got} == {4}
    assert packing.concatenated(df.limit(1), "k", 10).collect() == []
    assert packing.concatenated(df.limit(0), "k", 4).collect() == []


def test_concatenation_of_long_and_empty_rows(spark):
    rng = random.Random(1)
    rows, stream = [], []
    for k in range(60):
        own = [rng.randint(0, 99) for _ in range(rng.choice([0, 1, 3, 50]))]
        rows.append((k, own))
        stream += own
    got = packing.concatenated(spark.createDataFrame(rows, "k int, input_ids array<int>").repartition(5), "k", 8).orderBy("block").collect()
    assert [t for r in got for t in r.input_ids] == stream[: len(stream) // 8 * 8]


def packed(spark, rows, schema, block, pads=None):
    df = spark.createDataFrame(rows, schema).withColumn("pack_group", F.lit(0))
    return packing.best_fit_packed(df, "k", block, pads=pads).orderBy("block").collect()


def test_best_fit_goldens(spark):
    rows = [(0, [1, 2, 3], [1, 2, 3], [1, 1, 1]), (1, [4], [4], [1])]
    got = packed(spark, rows, "k int, input_ids array<int>, labels array<int>, attention_mask array<int>", 5)
    assert [(r.input_ids, r.labels, r.attention_mask) for r in got] == [([1, 2, 3, 4, 0], [1, 2, 3, 4, -100], [1, 1, 1, 1, 0])]
    assert [r.input_ids for r in packed(spark, [(0, []), (1, [1, 2, 3, 4, 5]), (2, [6, 7])], "k int, input_ids array<int>", 4)] == [[6, 7, 0, 0]]
    assert [r.input_ids for r in packed(spark, [(0, [1, 2, 99], 2), (1, [3, 4], 2)], "k int, input_ids array<int>, seq_lengths int", 4)] == [[1, 2, 3, 4]]
    with pytest.raises(Exception, match="shorter than"):
        packed(spark, [(0, [1], 2)], "k int, input_ids array<int>, seq_lengths int", 4)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=40), st.integers(1, 10))
def test_best_fit_never_overfills_and_loses_nothing(lengths, block):
    made = packing.best_fit(lengths, block)
    assert all(0 < sum(lengths[i] for i in c) <= block for c in made)
    assert sorted(i for c in made for i in c) == [i for i, n in enumerate(lengths) if 0 < n <= block]
    rooms = []
    for i in sorted((i for i, n in enumerate(lengths) if 0 < n <= block), key=lambda i: -lengths[i]):
        fitting = [r for r in rooms if r >= lengths[i]]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - lengths[i])
        else:
            rooms.append(block - lengths[i])
    assert len(made) == len(rooms)


def test_packing_groups_do_not_depend_on_partitions(spark):
    rows = [(k, list(range(k % 5 + 1))) for k in range(25)]
    df = spark.createDataFrame(rows, "k int, input_ids array<int>")
    one = packing.packed_in_groups(df.repartition(1), "k", 6, rows=10)
    many = packing.packed_in_groups(df.repartition(8), "k", 6, rows=10)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())) and {r.pack_group for r in one.collect()} == {0, 1, 2}
    assert packing.packed_in_groups(df, "k", 6, "concatenate", 10).count() > 0
    with pytest.raises(ValueError):
        packing.packed_in_groups(df, "k", 6, "other")


def brute_contaminated(ids, references, least, exchange):
    refs = [r[1:-1] for r in references if len(r) > least + 1]
    for ref in refs:
        for i in range(len(ref) - least + 1):
            for j in range(len(ids) - least + 1):
                if sum(a != b for a, b in zip(ref[i : i + least], ids[j : j + least])) <= int(exchange):
                    return True
    return False


@pytest.mark.parametrize("exchange, rows, reference, bad", [
    (False, [("a", [9, 1, 2, 3, 8]), ("b", [7, 7, 7, 7])], [101, 1, 2, 3, 102], ["a"]),
    (True, [("a", [1, 2, 99]), ("b", [8, 8, 8])], [101, 1, 2, 3, 102], ["a"]),
    (False, [("a", [1, 2, 3])], [101, 1, 102], []),
])
def test_decontamination_goldens(spark, exchange, rows, reference, bad):
    df = spark.createDataFrame(rows, IDS)
    refs = spark.createDataFrame([(reference,)], "input_ids array<int>")
    assert [r.id for r in decontaminate.decontaminated(df, "id", "input_ids", refs, "input_ids", 3, exchange, removed=True).collect()] == bad
    assert decontaminate.decontaminated(df, "id", "input_ids", refs, "input_ids", 3, exchange).count() == len(rows) - len(bad)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(str(i), [rng.randint(0, 4) for _ in range(rng.randint(0, 9))]) for i in range(120)] + [("null", None)]
    refs = [[rng.randint(0, 4) for _ in range(rng.randint(0, 9))] for _ in range(4)]
    df, ref = spark.createDataFrame(rows, IDS), spark.createDataFrame([(r,) for r in refs], "input_ids array<int>")
    for least in (1, 3, 4):
        for exchange in (False, True):
            got = {r.id for r in decontaminate.contaminated_keys(df, "id", "input_ids", ref, "input_ids", least, exchange).collect()}
            assert got == {i for i, ids in rows if ids and brute_contaminated(ids, refs, least, exchange)}
    with pytest.raises(ValueError):
        decontaminate.check_lengths(5, 4, 5)


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "id int, text string")
    assert {r.id: r.representative for r in dedup.exact_duplicates(df, "id", "text").collect()} == {3: 1, 1: 1, 2: 2, 4: 4, 5: 5}
    assert sorted(r.id for r in dedup.without_exact_duplicates(df, "id", "text").collect()) == [1, 2, 4, 5]


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


def test_components_are_those_of_union_find(spark):
    rng = random.Random(6)
    for edges in ([(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 20)], [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(50)], [(1, 1)], []):
        got = {r.node: r.component for r in dedup.components(spark.createDataFrame(edges, "src int, dst int")).collect()}
        want = {k: v for k, v in union_find([e for e in edges if e[0] != e[1]]).items()}
        assert got == want


def test_near_duplicates(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choices(vocabulary, k=200)) for _ in range(6)]
    rows = [(i, b) for i, b in enumerate(base)] + [(100 + i, b.replace(b.split()[0], "changed", 1)) for i, b in enumerate(base)] + [(200, base[0]), (201, ""), (202, None), (203, "")]
    got = {r.id: r.component for r in dedup.near_duplicates(spark.createDataFrame(rows, "id int, text string"), "id", "text").collect()}
    assert all(got[100 + i] == got[i] == i for i in range(6)) and got[200] == 0 and got[202] == 202 and got[201] == got[203] == 201
    kept, removed = dedup.without_near_duplicates(spark.createDataFrame(rows, "id int, text string"), "id", "text")
    assert kept.count() == 8 and removed.count() == len(rows) - 8
    assert dedup.detection_probability(0.8) == pytest.approx(0.924, abs=1e-3) and dedup.detection_probability(0.72) == pytest.approx(0.650, abs=1e-3)


def test_tokenizing(spark):
    path = tokens.tokenizer_path()
    rows = [(1, "ab cd"), (2, ""), (3, None)]
    got = {r.k: r for r in tokens.tokenized(spark.createDataFrame(rows, "k int, text string"), "text", path, 50256, 50256).collect()}
    assert got[1].input_ids[0] == got[1].input_ids[-1] == 50256 and got[1].labels == got[1].input_ids and got[1].attention_mask == [1] * got[1].seq_lengths
    assert got[2].input_ids == got[3].input_ids == [50256, 50256]
    assert tokens.tokenized(spark.createDataFrame(rows, "k int, text string"), "text", path, most_length=0).count() == 2
    other = spark.createDataFrame(rows, "k int, text string").select(tokens.token_count(tokens.tokenizer_path("piece_bpe_32k.model"))("text").alias("n")).collect()
    assert other[0].n > 0 and other[2].n == 0


def test_chats(spark):
    chats = [(1, [("user", "hi"), ("assistant", "\nyes")]), (2, []), (3, None)]
    df = spark.createDataFrame(chats, "k int, messages array<struct<role:string,content:string>>")
    got = {r.k: r for r in tokens.tokenized_chats(df, "messages", tokens.tokenizer_path()).collect()}
    one = got[1]
    assert len(one.input_ids) == len(one.assistant_masks) == len(one.labels) and set(one.assistant_masks) == {0, 1}
    assert all((label == -100) == (mask == 0) for label, mask in zip(one.labels, one.assistant_masks)) and got[2].input_ids == [] == got[3].input_ids


def test_masks_and_chunks(spark):
    df = spark.createDataFrame([([0, 1, 2, 3, 0], None), ([0, 1], [5, 5])], "ids array<int>, given array<int>")
    assert [r.y for r in df.select(tokens.masked_labels(F.col("ids"), [0, 2], F.col("given")).alias("y")).collect()] == [[-100, 1, -100, 3, -100], [5, 5]]
    assert tokens.mask_ids(3, 1, None, (7,)) == [1, 3, 7]
    text = spark.createDataFrame([(" ".join(["word"] * 11),), ("word",), (None,)], "text string")
    path = tokens.tokenizer_path()
    got = tokens.exploded_chunks(text, "text", path, 10).collect()
    assert [(r.chunk, r.chunk_text.count("word")) for r in got] == [(0, 10), (1, 1), (None, 1)]
    assert [r.chunk_text.count("word") for r in tokens.exploded_chunks(text, "text", path, 5, once=True).collect()] == [5, 1]
    m = tokens.tokenizer_metrics(text, "text", {"a": path, "b": tokens.tokenizer_path("piece_bpe_32k.model")}).collect()
    assert [r.fertility for r in m] == sorted(r.fertility for r in m) and len(m) == 2 and m[0].chars_per_token > 1
    assert tokens.training_sample(text, "text", 1).count() == 1


def test_prefix_and_chunks(spark):
    df = spark.createDataFrame([(k, n) for k, n in enumerate([4, 3, None, 5, 1])], "k int, n int")
    assert sorted(r.k for r in splits.token_prefix(df, "k", "n", 8).collect()) == [0, 1, 2]
    ten = spark.range(10).withColumnRenamed("id", "k")
    assert [r["count"] for r in splits.array_split(ten, "k", 3).groupBy("chunk").count().orderBy("chunk").collect()] == [4, 3, 3]
    assert [r["count"] for r in splits.mirrored_split(ten, "k", 3).groupBy("chunk").count().orderBy("chunk").collect()] == [3, 3, 4]
    assert splits.chunk_count(9_000_000, 3_000_000) == 3 and splits.chunk_count(0, 5) == 1
    greedy = spark.createDataFrame([("f", k, n) for k, n in enumerate([5, 5, 1, 20, 1, 9])] + [("g", 0, 3)], "file string, k int, n int")
    assert {(r.file, r.k): r.chunk for r in splits.greedy_chunks(greedy, "file", "k", "n", 10).collect()} == {("f", 0): 0, ("f", 1): 0, ("f", 2): 1, ("f", 3): 2, ("f", 4): 3, ("f", 5): 3, ("g", 0): 0}


def test_splits(spark):
    assert splits.quotas([3, 3], 4) == [2, 2] and splits.quotas([10, 1], 8) == [7, 1] and splits.quotas([5, 5, 1], 10) == [4, 4, 1] and splits.quotas([5, 5, 1], 10, True) == [5, 4, 1]
    df = spark.createDataFrame([(f"{f}{i}", f, i) for f in "ab" for i in range(3)], "id string, file string, k int")
    train, validation = splits.validation_split(df, "file", "k", 4)
    assert sorted(r.id for r in validation.collect()) == ["a0", "a1", "b0", "b1"] and train.count() == 2
    many = spark.range(1000).withColumn("s", F.when(F.col("id") < 900, "x").when(F.col("id") < 999, "y"))
    train, test = splits.stratified_split(many, "id", "s", 0.1)
    assert {r.s: r["count"] for r in test.groupBy("s").count().collect()} == {"x": 90, "y": 9} and train.count() == 901
    train, test = splits.split_by_hash(many, "id", 0.2)
    assert train.count() + test.count() == 1000 and 120 < test.count() < 280
    picked = {r.id for r in splits.hash_sample(many, "id", 5).collect()}
    assert len(picked) == 5 and picked == {r.id for r in splits.hash_sample(many.repartition(7), "id", 5).collect()}
    assert splits.picked_files(["a", "b", "c"], 2) == splits.picked_files(["c", "a", "b"], 2)
    assert splits.remaining(many, many.where("id < 10"), "id").count() == 990
    assert splits.first_per_key(spark.createDataFrame([(1, 2), (1, 1)], "k int, o int"), "k", "o").collect()[0].o == 1
