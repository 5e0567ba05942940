"""Web archives that break off, files on any file system, chains, numbers and templates with tools."""

from __future__ import annotations

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from weftline.functions import files
from weftline.operators import dialogue, prompts, quality, splits, templates, verify
from weftline.sources import loaders, sinks


def _record(i: int, kind: str = "response", page: str = "<p>page {}</p>") -> bytes:
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + page.format(i).encode()
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{i}>\r\nWARC-Target-URI: https://a.example/{i}\r\nWARC-Date: 2024-01-01\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def test_archives_give_their_records_up_to_where_they_break_off(spark, tmp_path):
    whole = b"".join(gzip.compress(_record(i)) for i in range(50))
    cases = {
        "whole.warc.gz": (whole, 50, 0), "cut.warc.gz": (whole[:-20], 49, 1), "plain.warc": (b"".join(map(_record, range(50)))[:-20], 49, 1), "one.warc.gz": (gzip.compress(b"".join(map(_record, range(50)))), 50, 0),
        "broken.warc.gz": (whole[:3000] + b"\x00" * 40 + whole[3040:], None, 1), "empty.warc.gz": (b"", 0, 0), "other.warc.gz": (gzip.compress(_record(1, "request")), 0, 0),
    }
    for name, (data, records, broken) in cases.items():
        (tmp_path / name).write_bytes(data)
        made = loaders.web_archive_records(spark, str(tmp_path / name), source="dump")
        assert loaders.broken_archives(made).count() == broken, name
        pages = loaders.web_archive(spark, str(tmp_path / name), source="dump").collect()
        assert records is None and 0 < len(pages) < 50 or len(pages) == records, name
        if pages:
            assert pages[0].url == "https://a.example/0" and pages[0].html == "<p>page 0</p>" and pages[0].source == "dump"
    both = tmp_path / "both"
    both.mkdir()
    for name in ("whole.warc.gz", "cut.warc.gz"):
        (both / name).write_bytes(cases[name][0])
    assert loaders.web_archive(spark, str(both)).count() == 99
    assert loaders.web_archive(spark, str(tmp_path / "none")).count() == 0


def test_long_records_pass_in_bounded_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loaders, "_READ_BYTES", 64)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(_record(i, page="<p>{}" + "x" * 5000 + "</p>")) for i in range(8)))
    with open(tmp_path / "a.warc.gz", "rb") as stream:
        found = [body for _, body in loaders._records(stream)]
    assert len(found) == 8 and all(len(b) > 5000 for b in found)


def test_files_by_path_and_by_address(tmp_path):
    for root in (str(tmp_path / "p"), f"file://{tmp_path}/a"):
        files.write_text(files.join(root, "x", "one.txt"), "á")
        files.write_text(files.join(root, ".hidden"), "")
        assert files.read_text(files.join(root, "x", "one.txt")) == "á" and files.is_file(files.join(root, "x", "one.txt"))
        assert [os.path.basename(f) for f in files.listing(root, "*.txt", recursive=True)] == ["one.txt"] and files.listing(root, "*") == []
        files.move(files.join(root, "x", "one.txt"), files.join(root, "x", "two.txt"))
        assert files.size_of(files.join(root, "x", "two.txt")) == 2 and not files.exists(files.join(root, "x", "one.txt"))
        files.remove(root)
        assert files.listing(root) == []


def test_rows_are_worked_out_once(spark, tmp_path):
    rows = spark.range(50).select("id", F.uuid().alias("u"), (F.col("id") % 2).cast("string").alias("subset"), F.lit(1).alias("token_count"))
    sinks.write_kept_and_rejected(rows.withColumn("keep", F.rand() < 0.5), "keep", str(tmp_path / "k"), str(tmp_path / "r"))
    assert sorted(r.id for f in "kr" for r in spark.read.parquet(str(tmp_path / f)).collect()) == list(range(50))
    sinks.write_kept_and_rejected(rows.limit(0).withColumn("keep", F.lit(True)), "keep", str(tmp_path / "k"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == 0
    totals = sinks.write_routed(rows, str(tmp_path / "routed"), "json").collect()
    assert {(r.subset, r.documents) for r in totals} == {("0", 25), ("1", 25)} and len(os.listdir(tmp_path / "routed" / "0")) >= 2
    assert not [f for f in os.listdir(tmp_path / "routed") if f.startswith("_")]


@pytest.mark.parametrize(
    "wanted, text, strict, soft",
    [
        ("380438", "380\\,438.", True, True), ("1234.56", "R$ 1.234,56", False, True), ("1234.56", "1,234.56", False, True), ("-1.5", "é -1 1/2", False, True), ("0.6667", "2/3 deles", False, True),
        ("1.33", "1.\\overline{3}", False, True), ("2", "6/3", False, True), ("0.5", "\\dfrac{1}{2}", False, True), ("7", "oito", False, False), ("3.25", "1/0", False, False), ("x", "y", False, False), ("12", "12", True, True),
        ("1 000", "1000", True, True), ("3.5", "3", False, True), ("9", "1.2.3", False, False),
    ],
)
def test_numbers(wanted, text, strict, soft):
    assert (verify._math(text, {"expected_answer": wanted}, False), verify._math(text, {"expected_answer": wanted}, True)) == (strict, soft)


@pytest.mark.parametrize("text, made", [('```json\n{"a": 1}\n```', {"a": 1}), ('x ``Json {"a": 1}` y', {"a": 1}), ('{"a": 1}', {"a": 1}), ('`[1]`', None), ("`{`", None), ("", None), ('`x` {"a": 1}', None)])
def test_objects(text, made):
    assert verify._json_object(text) == made


def test_conflicts_are_symmetric_and_as_stated():
    pairs = set(verify.conflict_pairs())
    names = verify.INSTRUCTION_CHECKS
    assert len(names) == 25 and all((b, a) in pairs for a, b in pairs) and all((n, n) in pairs for n in names)
    alone = "detectable_format:constrained_response"
    assert {b for a, b in pairs if a == alone} == set(names) and verify.addable([alone]) == []
    assert "keywords:existence" in verify.addable(["detectable_format:json_format"]) and "punctuation:no_comma" not in verify.addable(["detectable_format:json_format"])


def test_calls_and_thoughts_in_turns(spark):
    kind = "array<struct<role:string,content:string,reasoning_content:string,tool_calls:array<struct<name:string,arguments:string>>>>"
    talk = [("system", "S", None, None), ("user", "q", None, None), ("assistant", "", "\nwhy\n", [("f", '{"x": 1}'), ("g", None)]), ("tool", "r1", None, None), ("tool", "r2", None, None), ("assistant", "<think>t</think>\ndone", None, None)]
    df = spark.createDataFrame([(1, talk, ['{"name": "f"}']), (2, talk[1:2], []), (3, [], ["{}"])], f"id int, m {kind}, tools array<string>")
    made = templates.rendered_with_reasoning(F.col("m"), tools=F.col("tools"), thoughts_field="reasoning_content", calls_field="tool_calls")
    got = {r.id: r.t for r in df.select("id", made.alias("t")).collect()}
    head = f'<|im_start|>system\nS\n\n{templates.TOOLS_HEAD}\n{{"name": "f"}}{templates.TOOLS_TAIL}<|im_end|>\n'
    calls = '<tool_call>\n{"name": "f", "arguments": {"x": 1}}\n</tool_call>\n<tool_call>\n{"name": "g", "arguments": {}}\n</tool_call>'
    assert got[1] == (
        head + "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<think>\nwhy\n</think>\n\n" + calls + "<|im_end|>\n"
        "<|im_start|>user\n<tool_response>\nr1\n</tool_response>\n<tool_response>\nr2\n</tool_response><|im_end|>\n<|im_start|>assistant\n<think>\nt\n</think>\n\ndone<|im_end|>\n"
    )
    assert got[2] == "<|im_start|>user\nq<|im_end|>\n" and got[3].startswith("<|im_start|>system\n# Tools")


def test_chain_of_pages(spark):
    good = "O museu antigo guarda uma longa lista de nomes e ninguém sabe se o guia ainda lê essa lista para as pessoas. Mais de uma pessoa escreve para a@b.com.br sobre isso.\n|\nNo verão passado chegaram cartas de uma cidade distante, com selos azuis e papel muito fino. Quem abriu os envelopes não contou nada aos vizinhos, mas guardou todas as fotografias numa gaveta da cozinha. Depois das chuvas, a ponte de pedra foi fechada e os barcos voltaram a cruzar o rio com as crianças da escola."
    rows = [("a", good, 0.9), ("b", good, 0.2), ("c", good, None), ("d", "Привет мир", 0.9), ("e", None, 0.9), ("f", "o que não", 0.9), ("g", "", 0.9)]
    df = spark.createDataFrame(rows, "id string, text string, language_score double")
    made = {r.id: r for r in quality.quality_chain(df, "text", ["portuguese"], stop_words=("o", "de", "não")).collect()}
    assert made["a"].reason is None and "email@example.com" in made["a"].text and "\n|\n" not in made["a"].text and made["a"].token_count > 70 and made["a"].language_scores["pt"] > 0.5
    assert {i: made[i].reason for i in "bcdefg"} == {"b": "language_score", "c": "language_score", "d": "language", "e": "language", "f": "unended_lines", "g": "language"} or made["f"].reason is not None
    assert made["b"].text == good and made["b"].token_count is None


def test_rows_for_training(spark):
    kind = "array<struct<role:string,content:string>>"
    rows = [(1, [("user", "a"), ("assistant", "b")]), (2, [("user", "a")]), (3, None), (4, []), (5, [("user", "a" * 900), ("assistant", "b")])]
    df = spark.createDataFrame(rows, f"id int, messages {kind}")
    assert [r.id for r in dialogue.valid_rows(df, "messages", 500, F.length).collect()] == [1]
    assert dialogue.is_conversational(df.withColumnRenamed("messages", "chosen")) and not dialogue.is_conversational(df)
    assert [r.id for r in prompts.within_chunk(spark.createDataFrame([(1, "ab"), (2, "abc"), (3, None)], "id int, t string"), "t", 2, F.length).collect()] == [1]


def test_first_rows_by_borders(spark):
    df = spark.range(1000).withColumn("g", (F.col("id") % 3).cast("string"))
    assert {r.id for r in splits.first_in_order(df, ["g", "id"], 10).collect()} == {3 * i for i in range(10)}
    assert splits.first_in_order(df, ["id"], 5000).count() == 1000 and splits.first_in_order(df, ["id"], 0).count() == 0
    assert {r.g: r["count"] for r in loaders.limited(df, "id", 7, per="g").groupBy("g").count().collect()} == {"0": 7, "1": 7, "2": 7}
    assert splits.array_split(df.limit(0), "id", 3).count() == 0 and splits.token_prefix(df, "id", "id", -1).count() == 0


def test_lines_to_parquet(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"i": i, "f": name}) + "\n" for i in range(40)) + "{broken\n")
    out = str(tmp_path / "out")
    assert sinks.convert_to_parquet(spark, [str(tmp_path / "b.jsonl"), str(tmp_path / "a.jsonl")], out, 100) > 1
    assert sorted(os.listdir(out))[0].startswith("train-00000-of-") and spark.read.parquet(out).count() == 80
    df, n = loaders.with_file_count(spark, out, "parquet")
    assert n > 1 and loaders.with_default_ids(df, "f").select("id").distinct().count() == 80
    with pytest.raises(FileNotFoundError):
        loaders.with_file_count(spark, str(tmp_path / "none"))


def test_cards_paragraphs_and_addresses(spark):
    from weftline.operators import decontaminate, reports

    card = reports.card_text([{"name": "pt", "files": 2, "rows": 1200, "bytes": 3 << 30, "tokens": 5000, "columns": [("text", "value", "string"), ("ids", "sequence", "int32"), ("messages", "list_of_dicts", [("role", "string")])]}, {"name": "en", "files": 1, "rows": 1, "bytes": 10, "tokens": 0, "columns": []}], default="pt")
    assert card.startswith("---\ndataset_info:\n- config_name: pt\n  features:\n  - name: text\n    dtype: string\n  - name: ids\n    sequence: int32\n  - name: messages\n    list:\n      - name: role\n        dtype: string\n")
    assert "  default: true\n  data_files:\n  - split: train\n    path: pt/train-*\n- config_name: en\n  data_files:" in card and "| pt | 2 | 1,200 | 3.00 GB |\n" in card and "**Total tokens across all subsets**: 5,000 tokens" in card
    rows = [(1, "a b\n\na b\n\nc d e"), (2, "x\n\ny"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    s = quality.paragraph_statistics(F.col("text"))
    made = {r.id: (r.p, r.c) for r in df.select("id", s["duplicate_paragraphs"].alias("p"), s["duplicate_paragraph_chars"].alias("c")).collect()}
    assert made[1] == (pytest.approx(1 / 3), pytest.approx(3 / 11)) and made[2] == made[3] == made[4] == (0.0, 0.0)
    reasons = {r.id: (r.a, r.b) for r in df.select("id", quality.paragraph_reason(F.col("text"), 0.3).alias("a"), quality.paragraph_reason(F.col("text")).alias("b")).collect()}
    assert reasons[1] == ("duplicate_paragraphs", None) and reasons[2] == (None, None)
    urls = spark.createDataFrame([(1, "https://www.a.spam.example/x"), (2, "https://spam.example.org"), (3, None), (4, "http://fine.example/casinonight")], "id int, url string")
    blocked = spark.createDataFrame([("Spam.Example",), ("other",)], "domain string")
    assert {r.id for r in quality.with_blocked_domains(urls, "id", "url", blocked).where("blocked").collect()} == {1}
    assert {r.id: r.r for r in urls.select("id", quality.url_reason(F.col("url"), subwords=["casino"]).alias("r")).collect()} == {1: None, 2: None, 3: None, 4: "subword"}
    totals = decontaminate.decontamination_totals(df.withColumn("n", F.col("id")), df.where("id < 3").withColumn("n", F.col("id")), "n").first()
    assert tuple(totals) == (4, 2, 3)


def test_parameters_as_decimals(spark):
    df = spark.createDataFrame([(1, '{"n": 3, "b": true, "s": "x", "f": 0.5, "l": [1]}'), (2, None), (3, "[1]"), (4, "{bad")], "id int, k string")
    got = {r.id: r.k for r in df.select("id", verify.with_float_parameters("k").alias("k")).collect()}
    assert json.loads(got[1]) == {"n": 3.0, "b": 1.0, "s": "x", "f": 0.5, "l": [1]} and got[2] is None and got[3] == "[1]" and got[4] == "{bad"
    assert isinstance(json.loads(got[1])["b"], float)


def test_chunks_are_filled_as_row_by_row(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "b", None]), i, rng.choice([None, 0, 1, 3, 8, 30])) for i in range(3000)]
    df = spark.createDataFrame(rows, "file string, i int, n int").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.i: r.chunk for r in splits.greedy_chunks(df, "file", "i", "n", 20).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    state = {}
    for file, i, n in rows:
        number, total = state.get(file, (0, None))
        if total is not None and total + (n or 0) > 20:
            number, total = number + 1, None
        state[file] = number, (total or 0) + (n or 0)
        assert got[i] == number
    assert len(got) == len(rows) and splits.greedy_chunks(df.limit(0), "file", "i", "n", 20).count() == 0


def test_runs_against_brute_force(spark):
    """Sequences of numbers, of texts, with nulls, across rows and batches; a part of a run alone is no run."""
    import random

    from weftline.operators import decontaminate

    rng = random.Random(11)
    refs = [[rng.randrange(60) for _ in range(20)] for _ in range(12)]
    rows = []
    for n in range(400):
        own = [rng.randrange(60) if rng.random() > 0.02 else None for _ in range(rng.choice([0, 3, 5, 6, 12, 40]))]
        if n % 3 == 0:
            start = rng.randint(1, 12)
            piece = refs[n % 12][start : start + 6]
            if n % 2:
                piece[rng.randrange(6)] = 99
            own[len(own) // 2 : len(own) // 2] = piece if n % 5 else piece[:3]
        rows.append((n, own))
    rows += [(900, None), (900, refs[0][1:8]), (None, refs[1][1:8])]

    def truth(exchange):
        runs = [r[1:-1][i : i + 6] for r in refs for i in range(13)]
        return {k for k, own in rows for i in range(len(own or ()) - 5) if any(sum(a != b for a, b in zip(own[i : i + 6], r)) <= exchange for r in runs)}

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        for kind, made in (("int", lambda x: x), ("string", lambda x: None if x is None else f"w{x}")):
            df = spark.createDataFrame([(k, None if own is None else [made(x) for x in own]) for k, own in rows], f"k int, ids array<{kind}>").repartition(3)
            bench = spark.createDataFrame([([made(x) for x in r],) for r in refs], f"ids array<{kind}>")
            for exchange in (False, True):
                assert {r.k for r in decontaminate.contaminated_keys(df, "k", "ids", bench, "ids", 6, exchange).collect()} == truth(int(exchange))
            assert decontaminate.contaminated_keys(df, "k", "ids", bench.limit(0), "ids", 6).count() == 0 and decontaminate.contaminated_keys(df.limit(0), "k", "ids", bench, "ids", 6, True).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_filter_keeps_what_was_added():
    import numpy as np

    from weftline.functions import bloom

    own, others = bloom.mixed(np.arange(50_000)), bloom.mixed(np.arange(10**9, 10**9 + 50_000))
    made = bloom.Bloom()
    made.add(own)
    again = bloom.Bloom(made.packed())
    assert again.contains(own).all() and again.contains(others).mean() < 0.001
    assert len(bloom.run_hashes(own[:3], 4)) == 0 and len(set(bloom.run_hashes(own, 4).tolist())) == len(own) - 3
