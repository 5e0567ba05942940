"""Checks of responses, templates, prompts, reports, sources, sinks, streams and generated tasks."""

from __future__ import annotations

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import prompts, reports, samples, templates, verify
from weftline.sources import loaders, sinks
from weftline.streaming import shards

#: name, parameters, text, strict result, soft result
CASES = [
    ("keywords:existence", {"keywords": ["casa", "rio"]}, "A CASA do rio", True, True),
    ("keywords:existence", {"keywords": ["casa", "mar"]}, "A casa do rio", False, False),
    ("keywords:frequency", {"keyword": "a", "frequency": 2, "relation": "at least"}, "a", False, True),
    ("keywords:frequency", {"keyword": "a", "frequency": 2, "relation": "less than"}, "a b", True, True),
    ("keywords:frequency", {"keyword": "a", "frequency": 2, "relation": "less than"}, "a a", False, True),
    ("keywords:forbidden_words", {"forbidden_words": ["rio"]}, "O Rio.", False, False),
    ("keywords:forbidden_words", {"forbidden_words": ["rio"]}, "riomar", True, True),
    ("keywords:letter_frequency", {"letter": "a", "let_frequency": 3, "let_relation": "at least"}, "Banana", True, True),
    ("keywords:letter_frequency", {"letter": "a", "let_frequency": 6, "let_relation": "at least"}, "Banana", False, True),
    ("length_constraints:number_sentences", {"num_sentences": 3, "relation": "at least"}, "Um. Dois.", False, True),
    ("length_constraints:number_paragraphs", {"num_paragraphs": 2}, "a *** b", True, True),
    ("length_constraints:number_paragraphs", {"num_paragraphs": 2}, "*** a *** b ***", True, True),
    ("length_constraints:number_paragraphs", {"num_paragraphs": 2}, "a *** *** b", False, False),
    ("length_constraints:number_words", {"num_words": 3, "relation": "at least"}, "função é água", True, True),
    ("length_constraints:number_words", {"num_words": 3, "relation": "at least"}, "um dois", False, True),
    ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": 2, "nth_paragraph": 2, "first_word": "segundo"}, "Um.\n\n\"Segundo, sim", True, True),
    ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": 2, "nth_paragraph": 2, "first_word": "segundo"}, "Um.\nSegundo, sim", False, True),
    ("detectable_content:number_placeholders", {"num_placeholders": 2}, "[a] e [b]", True, True),
    ("detectable_content:postscript", {"postscript_marker": "P.P.S"}, "fim\nP. P. S outro", True, True),
    ("detectable_content:postscript", {"postscript_marker": "P.S."}, "fim", False, False),
    ("detectable_format:number_bullet_lists", {"num_bullets": 2}, "* a\n- b", True, True),
    ("detectable_format:number_bullet_lists", {"num_bullets": 3}, "* a\n- b", False, False),
    ("detectable_format:constrained_response", {}, "Minha resposta é sim.", True, True),
    ("detectable_format:number_highlighted_sections", {"num_highlights": 2}, "*a* e **b**", True, True),
    ("detectable_format:multiple_sections", {"section_spliter": "Seção", "num_sections": 2}, "Seção 1 a Seção 2 b", True, True),
    ("detectable_format:json_format", {}, '```json\n{"a": 1}\n```', True, True),
    ("detectable_format:json_format", {}, "{a: 1}", False, False),
    ("detectable_format:title", {}, "<<Título>>", True, True),
    ("detectable_format:title", {}, "<< >>", False, False),
    ("combination:two_responses", {}, "um ****** dois", True, True),
    ("combination:two_responses", {}, "um ****** um", False, False),
    ("combination:two_responses", {}, "um ****** ****** dois", False, False),
    ("combination:repeat_prompt", {"prompt_to_repeat": "Diga olá"}, " diga OLÁ: olá", True, True),
    ("startend:end_checker", {"end_phrase": "Isso faz sentido?"}, 'x isso faz sentido?"', True, True),
    ("startend:quotation", {}, ' "olá\nmundo" ', True, True),
    ("startend:quotation", {}, '"', False, False),
    ("change_case:capital_word_frequency", {"capital_frequency": 2, "capital_relation": "at least"}, "OI A todos", True, True),
    ("change_case:portuguese_capital", {}, "O GATO NÃO ESTÁ EM CASA", True, True),
    ("change_case:portuguese_lowercase", {}, "o gato não está em Casa", False, False),
    ("punctuation:no_comma", {}, "sem", True, True),
    ("punctuation:no_comma", {}, "com, vírgula", False, False),
    ("language:response_language", {"language": "pt"}, "o gato não está em casa", True, True),
    ("language:response_language", {"language": "en"}, "o gato não está em casa", False, False),
    ("long_context:common_words", {"expected_words": ["a1", "b1", "c1"]}, "a1 b1", True, True),
    ("long_context:count_word", {"target_word": "x", "expected_count": 3}, "36 vezes", False, False),
    ("long_context:count_word", {"target_word": "x", "expected_count": 3}, "são três", True, True),
    ("long_context:word_at_position", {"expected_word": "Rio"}, "é rio", True, True),
    ("haystack:needle_single_number", {"expected_values": {"k": ["1", "2"]}}, "1", False, False),
    ("haystack:needle_multi_number_same_key", {"expected_values": {"k": ["1"], "l": ["2"]}}, "1", True, True),
    ("haystack:needle_uuid", {"expected_values": {"k": ["AB"]}}, "x ab", True, True),
    ("haystack:needle_uuid", {"expected_values": {}}, "x", True, True),
    ("math:answer_check", {"expected_answer": "380438"}, "São 380.438 no total", True, True),
    ("math:answer_check", {"expected_answer": "0.5"}, r"\frac{1}{2}", False, True),
    ("math:answer_check", {"expected_answer": "1.5"}, "1 1/2", False, True),
    ("math:answer_check", {"expected_answer": "3.14"}, "3,14", False, True),
    ("math:answer_check", {"expected_answer": "3.14"}, "3,29", False, True),
    ("math:answer_check", {"expected_answer": "4.14"}, "3,29", False, False),
    ("math:answer_check", {}, "1", False, False),
    ("email:json_format", {}, '`{"a": 1}`', True, True),
    ("email:json_format", {}, '{"a": 1}', False, False),
    ("email:schema_keys", {"required_keys": ["a", "b"]}, '```json\n{"b": 1, "a": 2}\n```', True, True),
    ("email:field_value", {"field_name": "a", "expected_value": True}, '```{"a": "sim"}```', True, True),
    ("email:field_value", {"field_name": "a", "expected_value": 5}, '```{"a": "5"}```', True, True),
    ("tool_call:format", {"expect_call": True}, '<tool_call>{"name": "f"}</tool_call>', True, True),
    ("tool_call:format", {"expect_call": False}, "não", True, True),
    ("tool_call:name", {"expected_name": "f"}, '<tool_call>{"name": "f"}</tool_call>', True, True),
    ("tool_call:args_keys", {"required_arg_keys": ["x"]}, '<tool_call>{"name": "f", "arguments": {"x": 1, "y": 2}}</tool_call>', True, True),
    ("tool_call:args_types", {"expected_arg_types": {"x": "integer"}}, '<tool_call>{"arguments": {"x": true}}</tool_call>', True, True),
    ("tool_call:args_types", {"expected_arg_types": {"x": "string"}}, '<tool_call>{"arguments": {"x": 1}}</tool_call>', False, False),
    ("tool_call:refusal", {"min_refusal_words": 3}, "não posso fazer", True, True),
    ("reasoning:thinking_format", {}, "<think>a\nb</think>c", True, True),
    ("reasoning:thinking_format", {}, "<think> </think>c", False, False),
]


def test_every_check(spark):
    df = spark.createDataFrame([(i, n, t, json.dumps(p)) for i, (n, p, t, _, _) in enumerate(CASES)], "i int, n string, t string, p string")
    for place, soft in ((3, False), (4, True)):
        got = {r.i: r.y for r in df.select("i", verify.check(F.col("n"), F.col("t"), F.col("p"), soft).alias("y")).collect()}
        wrong = [(CASES[i][:3], got[i]) for i in got if got[i] is not CASES[i][place]]
        assert not wrong
    assert {c for c, *_ in CASES} >= set(verify.CHECKS) - {"long_context:rare_words", "long_context:frequency_comparison", "haystack:needle_multi_number_diff_keys"}


def test_rewards(spark):
    rows = [
        (1, "<think>x</think>\nsem", ["punctuation:no_comma", "detectable_format:title"], ["{}", "{}"]), (2, "a, b", ["punctuation:no_comma"], [None]), (3, "x", [], []), (4, None, ["punctuation:no_comma"], ["{}"]),
        (5, "x", ["no:such"], ["{}"]),
    ]
    df = spark.createDataFrame(rows, "id int, t string, n array<string>, p array<string>")
    assert {r.id: (r.results, r.reward) for r in verify.verified(df, "id", "t", "n", "p").collect()} == {1: ([True, False], 0.5), 2: ([False], 0.0), 3: ([], 0.0), 4: ([False], 0.0), 5: ([False], 0.0)}
    thinking = {r.id: r.results for r in verify.verified(df, "id", "t", "n", "p", thinking=True).collect()}
    assert thinking[1] == [True, True, False] and thinking[3] == [False]


def test_conflicts(spark):
    pairs = set(verify.conflict_pairs())
    assert all((b, a) in pairs for a, b in pairs) and all((c, c) in pairs for c in verify.INSTRUCTION_CHECKS)
    assert verify.addable(["detectable_format:constrained_response"]) == []
    assert set(verify.addable(["combination:repeat_prompt"])) == {"keywords:existence", "detectable_format:title"}
    df = spark.createDataFrame([(1, ["startend:quotation", "detectable_format:title"]), (2, ["punctuation:no_comma", "startend:quotation"])], "id int, n array<string>")
    assert [(r.id, r.first, r.second) for r in verify.conflicting_samples(df, "id", "n").collect()] == [(1, "detectable_format:title", "startend:quotation")]


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).collect()[0].y


M = "array<struct<role:string,content:string>>"


def test_templates(spark):
    chat = [("system", "S"), ("user", "hi"), ("assistant", "\nyes\n")]
    assert one(spark, chat, M, templates.rendered) == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n"
    assert one(spark, [], M, lambda c: templates.rendered(c, True)) == "<|im_start|>assistant\n"
    assert one(spark, None, M, templates.rendered) == "" and one(spark, chat, M, templates.plain) == "S\n\nhi\n\n\nyes\n"
    chat = [("user", "q"), ("assistant", "<think>\nold\n</think>\n\na"), ("user", "q2"), ("assistant", "<think>\nnew\n</think>\n\nb"), ("tool", "t1"), ("tool", "t2"), ("assistant", "c")]
    made = one(spark, chat, M, templates.rendered_with_reasoning)
    assert "old" not in made and "<think>\nnew\n</think>\n\nb" in made and made.count("<|im_start|>user") == 3
    assert "<|im_start|>user\n<tool_response>\nt1\n</tool_response>\n<tool_response>\nt2\n</tool_response><|im_end|>\n" in made
    assert one(spark, chat, M, lambda c: templates.rendered_with_reasoning(c, keep_thoughts=False)).count("<think>") == 2
    assert one(spark, chat[:1], M, lambda c: templates.rendered_with_reasoning(c, True, False)).endswith("<|im_start|>assistant\n<think>\n\n</think>\n\n")
    assert one(spark, chat, M, templates.last_real_turn) == 2
    assert one(spark, ['{"name": "f"}'], "array<string>", lambda c: templates.tools_block(c, F.lit("S"))).startswith("<|im_start|>system\nS\n\n# Tools / Ferramentas")
    assert one(spark, ["{}"], "array<string>", templates.tool_calls) == "<tool_call>\n{}\n</tool_call>"


def test_prompts(spark):
    assert one(spark, "x", "string", lambda c: prompts.assembled(c, "a ", " b")) == "a x b"
    assert one(spark, "x.*", "string", lambda c: prompts.filled_template("<[[DOCUMENT]]>", c)) == "<x.*>"
    with pytest.raises(ValueError):
        prompts.filled_template("none", F.lit("x"))
    oom, late = "torch.OutOfMemoryError: CUDA out of memory", "CANCELLED DUE TO TIME LIMIT"
    logs = [oom, late, "server encountered unrecoverable error", "fine", None, oom + "x" * 150_000 + late, oom + "x" * 200_000]
    assert [one(spark, log, "string", prompts.failure) for log in logs] == ["OOM", "timeout", "server_fail", None, None, "timeout", "OOM"]
    assert one(spark, "x" * 30, "string", lambda c: prompts.within_budget(c, 1000, 478)) is True and one(spark, "x" * 31, "string", lambda c: prompts.within_budget(c, 1000, 478)) is False
    rows = spark.createDataFrame([(r,) for r in (0, 5, 3, 10, 7)], "row int")
    assert prompts.next_row(rows) == 11 and prompts.next_row(rows.limit(0)) == 0 and prompts.next_row(rows, start=2) == 2
    pair = spark.createDataFrame([([("u", "a"), ("x", "b")], [("u", "a"), ("x", "c")])], f"a {M}, b {M}").select(prompts.shared_prompt(F.col("a"), F.col("b")).alias("y")).collect()[0].y
    assert [m.content for m in pair] == ["a"]
    made = prompts.rollouts(spark.createDataFrame([(1, "p"), (2, None)], "k int, prompt string"), "prompt", lambda ps: [[p + "!", p + "?"] for p in ps], ["k"], 1)
    assert {r.k: r.rollouts for r in made.collect()} == {1: ["p!", "p?"], 2: ["!", "?"]}
    mixed = spark.createDataFrame([("s", [("a", "first"), ("b", "second")], 5), (None, [], None)], f"s string, m {M}, n int")
    assert [[r[0] for r in mixed.select(prompts.completion_text(mixed, c)).collect()] for c in ("s", "m", "n")] == [["s", ""], ["first", ""], ["5", ""]]
    assert prompts.one_row_each(made, "rollouts", "r").count() == 4
    assert "request: q1" in one(spark, "q1", "string", lambda c: prompts.critique_prompt(c, c)) and one(spark, "q1", "string", lambda c: prompts.revision_prompt(c, c, c)).count("q1") == 3


def test_reports(spark):
    df = spark.createDataFrame([("pt", "a", 5), ("pt", "b", 7), ("bn", "a", None)], "lang string, src string, n int")
    assert reports.totals(df, "n").collect()[0].asDict() == {"documents": 3, "tokens": 12, "mean": 4.0}
    assert {(r.lang, r.src, r.level): r.tokens for r in reports.grouped_totals(df, ["lang", "src"], "n").collect()}[(None, None, 2)] == 12
    old = spark.createDataFrame([("pt", 3, 60)], "lang string, documents int, tokens int")
    new = spark.createDataFrame([("pt", 4, 40), ("bn", 1, 1)], "lang string, documents int, tokens int")
    got = {r.lang: (r.old_tokens, r.new_tokens, r.documents, r.tokens) for r in reports.old_and_new(old, new, "lang").collect()}
    assert got == {"pt": (60, 40, 7, 100), "bn": (0, 1, 1, 1), None: (60, 41, 8, 101)}
    hist = reports.token_histogram(spark.range(101).withColumnRenamed("id", "n"), "n").collect()
    assert len(hist) == 50 and sum(h.rows for h in hist) == 101 and max(hist, key=lambda h: h.bin).rows == 3
    assert reports.token_histogram(df.limit(0), "n").collect() == []
    assert reports.token_summary(df, "n").collect()[0].median == 6.0
    assert reports.filter_report(spark.createDataFrame([("a",), (None,)], "reason string")).collect()[0].percent == 50.0
    words = spark.createDataFrame([(["b", "a", "a"],), (["c", "b"],)], "w array<string>")
    assert [(r.word, r.n) for r in reports.word_frequencies(words, "w", 2).collect()] == [("a", 2), ("b", 2)] and reports.word_frequencies(words, "w", 1, rare=True).collect()[0].word == "c"
    scores = spark.createDataFrame([(2.5,), (-1.0,), (9.0,)], "x double").select(*(c.alias(n) for c, n in zip(reports.score_from_logit(F.col("x")), "fi"))).collect()
    assert [(r.f, r.i) for r in scores] == [(3.5, 3), (0.0, 1), (10.0, 5)]
    counts = reports.confusion(spark.createDataFrame([(1, 1.2), (1, 2.0), (2, 2.4)], "l int, p double"), "l", "p")
    made = reports.classifier_report(counts).collect()[0]
    assert made.accuracy == pytest.approx(2 / 3) and made.precision == pytest.approx(0.75) and made.recall == pytest.approx(0.75)
    lines = ["[metadata]", "a: 1", "---", "[stats]", "", "b: 2", "c: x: y", "---", "d: 3"]
    entries = reports.log_entries(spark.createDataFrame(list(enumerate(lines)), "number int, line string"), "number", "line").collect()
    assert sorted((r.block, r.section, r.name, r.value) for r in entries if r.section) == [(0, "metadata", "a", "1"), (1, "stats", "b", "2"), (1, "stats", "c", "x: y")]
    log = spark.createDataFrame([(1, "training"), (2, "validation"), (3, "training")], "step int, status string")
    assert reports.until_last(log, "step", "status").count() == 2 and reports.validated_steps(log, log, "step", "status").count() == 1
    runs = spark.createDataFrame([("a", 1, 1.0, 2.0, 3600.0), ("a", 2, 2.0, 3.0, 7200.0), ("b", 1, 1.0, 1.0, 3600.0)], "run_id string, timestamp int, energy_consumed double, emissions double, duration double")
    assert reports.emissions(runs, 2).collect()[0].asDict() == {"runs": 2, "energy": 6.0, "emissions": 8.0, "hours": 6.0}
    results = spark.createDataFrame([("m", '{"task": {"acc,none": 0.5, "alias": "t"}, "other": {}}')], "m string, j string")
    assert [(r.model, r.metric, r.value) for r in reports.evaluation_results(results, "m", "j").collect()] == [("m", "task_acc", 0.5)]
    assert one(spark, "/x/results_m1.json", "string", lambda c: reports.model_name(F.lit(None).cast("string"), c)) == "m1" and one(spark, "org/name/", "string", lambda c: reports.model_name(c, F.lit("f"))) == "name"
    plan = reports.schedule(spark, 100, 10, 1.0, 0.1, 0.2).orderBy("step").collect()
    assert plan[0].cosine == pytest.approx(0.1) and plan[9].cosine == 1 == plan[10].cosine and plan[50].stable == 1 and plan[80].stable_stage == "stable" and plan[99].stable_stage == "linear_decay"
    assert plan[90].stable == pytest.approx(0.55) and plan[55].cosine == pytest.approx(0.55)
    assert reports.training_plan(1000, 64, 2, 8, 2, 3) == {"accumulation": 2, "steps_per_epoch": 500, "steps": 1500, "epochs": 3}
    assert reports.training_plan(1000, 64, 2, 8, 2, 3, 1100)["epochs"] == 2
    with pytest.raises(ValueError):
        reports.training_plan(10, 7, 2, 2, 2, 1)
    rate = reports.with_rates(spark.createDataFrame([(128, 4096, 1.451, 1, 5e7, 10, 8, 64)], "batch int, length int, seconds double, devices int, params double, layers int, heads int, head_size int"), 300e12).collect()[0]
    assert rate.tokens_per_second == pytest.approx(361_328, rel=1e-4) and 0 < rate.mfu < 1
    rows = {r.row: r.input_ids for r in reports.synthetic_rows(spark, 6, 20, 50).collect()}
    for row, ids in rows.items():
        steps = [(b - a) % 50 == 1 if row % 2 == 0 else i < 18 and ids[i] == ids[i + 2] for i, (a, b) in enumerate(zip(ids, ids[1:]))]
        assert len(ids) == 20 and any(all(steps[k : k + (5 if row % 2 == 0 else 4)]) for k in range(len(steps) - 3))
    stage = reports.stage_counts(spark.createDataFrame([("s", "start", 1), ("s", "end", 2), ("s", "start", 3)], "stage string, event string, t int"), "stage", "event", "t").collect()[0]
    assert stage.resumes == 1 and stage.events == ["start", "end", "start"]
    assert reports.schema_card(spark.createDataFrame([], f"a int, b array<int>, m {M}")) == [("a", "value"), ("b", "sequence"), ("m", "list_of_dicts")] and reports.sanity_rows(5) == 1
    assert reports.dataset_card(df.withColumn("size", F.lit(1)), "lang", "n", "size").count() == 3


def test_sources(spark, tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    (folder / "b.jsonl").write_text('{"token_count": 5}\n\n{ not json\n{"token_count": 8}\n[1]\n')
    (folder / "a.jsonl").write_text('{"token_count": 3}\n')
    spark.range(3).write.parquet(str(folder / "x.parquet"))
    kind, files = loaders.discover(str(folder))
    assert kind == "json" and [os.path.basename(f) for f in files] == ["a.jsonl", "b.jsonl"]
    got = loaders.line_totals(loaders.json_lines(spark, files, "token_count int")).collect()[0]
    assert (got.lines, got.tokens, got.broken) == (3, 16, 2)
    assert loaders.load(spark, str(folder / "a.jsonl")).count() == 1
    with pytest.raises(FileNotFoundError):
        loaders.discover(str(tmp_path))
    with pytest.raises(ValueError):
        loaders.discover(__file__)
    parquet = loaders.with_file_order(spark.read.parquet(str(folder / "x.parquet")))
    assert sorted(parquet.columns) == ["file", "id", "row_index"]
    texts = tmp_path / "texts"
    texts.mkdir()
    (texts / "1.txt").write_text(" one \n")
    (texts / "2.txt").write_text("  ")
    assert [(r.file, r.text) for r in loaders.documents_folder(spark, str(texts)).collect()] == [("1.txt", "one")]
    assert [(r.number, r.line) for r in loaders.numbered_lines(spark, str(texts / "1.txt")).collect()] == [(0, " one "), (1, "")]
    tools = spark.createDataFrame([("f", "x"), ("g", "x"), ("f", "y")], "name string, sig string")
    assert {(r.kind, r.value, r.n) for r in loaders.ambiguous(tools, name=F.col("name"), signature=F.col("sig")).collect()} == {("name", "f", 2), ("signature", "x", 2)}
    assert loaders.question_answers(spark.createDataFrame([("q", "1"), ("", "1"), ("q", None)], "q string, a string"), "q", "a").count() == 1
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n<p>ol\xc3\xa1</p>"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a.example/\r\nWARC-Record-ID: <1>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    archive = tmp_path / "warc"
    archive.mkdir()
    (archive / "a.warc.gz").write_bytes(gzip.compress(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n") + gzip.compress(record))
    assert [(r.url, r.html, r.source) for r in loaders.web_archive(spark, str(archive), source="S").collect()] == [("http://a.example/", "<p>olá</p>", "S")]
    evals = tmp_path / "evals" / "sub"
    evals.mkdir(parents=True)
    (evals / "a.json").write_text('{"x": 1}')
    (evals / "b.json").write_text("{bad")
    assert loaders.json_documents(spark, str(tmp_path / "evals")).count() == 1


def test_sidecars_and_sinks(spark, tmp_path):
    path = str(tmp_path / "s" / "pt" / ".metadata")
    loaders.write_sidecar(path, {"documents": 3, "rate": 0.5, "name": "x: y"})
    assert loaders.read_sidecar(path) == {"documents": 3, "rate": 0.5, "name": "x: y"} and loaders.read_sidecar(path, typed=False)["documents"] == "3"
    assert loaders.read_sidecar("/none") is None and loaders.read_sidecar("/none", typed=False) == {}
    loaders.write_sidecar(str(tmp_path / "s" / "bn" / "x" / ".metadata"), {"Docs": 2, "tokens": 7})
    report = {(r.folder, r.subfolder, r.level): (r.documents, r.tokens) for r in loaders.token_report(spark, str(tmp_path / "s"), {"Docs": "documents"}).collect()}
    assert report[(None, None, 2)] == (5, 7) and report[("bn", "x", 0)] == (2, 7)
    rows = spark.range(100).withColumn("text", F.col("id").cast("string"))
    out = str(tmp_path / "chunks")
    assert sinks.save_chunks(rows, out, "json", "id", 9_000_000, 3_000_000) == 3
    assert sorted(os.listdir(out)) == [f"train-0000{i}-of-00003.jsonl" for i in range(3)]
    first = [json.loads(x)["id"] for x in open(os.path.join(out, "train-00000-of-00003.jsonl"))]
    assert first == list(range(34))
    assert sinks.save_chunks(rows, str(tmp_path / "one"), "parquet", "id", 1, 10, single="train") == 1 and os.listdir(tmp_path / "one") == ["train.parquet"]
    assert sinks.save_chunks(rows.limit(0), str(tmp_path / "none"), "json", "id", 0, 10) == 0
    docs = spark.createDataFrame([("1", "pt", 5), ("2", "bn", 7)], "id string, subset string, token_count int")
    sinks.write_routed(docs, str(tmp_path / "routed"), dropped=1)
    assert loaders.read_sidecar(str(tmp_path / "routed" / "pt" / ".metadata")) == {"documents": 1, "tokens": 5, "filtered": 1}
    for _ in range(2):
        sinks.append_with_totals(docs.withColumnRenamed("subset", "language"), str(tmp_path / "appended"), "language")
    assert loaders.read_sidecar(str(tmp_path / "appended" / "language=bn" / ".metadata")) == {"documents": 2, "tokens": 14}
    sinks.write_kept_and_rejected(docs.withColumn("keep", F.col("token_count") > 5), "keep", str(tmp_path / "k"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == spark.read.parquet(str(tmp_path / "r")).count() == 1
    assert sinks.known_keys(docs).columns == ["id", "token_count"] and sinks.size_chunks(100, 30, 0.25) == 1
    sinks.append_rows(spark.createDataFrame([(1, None)], "row int, chunk int"), str(tmp_path / "rollouts"))
    assert spark.read.text(str(tmp_path / "rollouts")).collect()[0].value == '{"row":1,"chunk":null}'


def test_splitting_a_file(spark, tmp_path):
    path = tmp_path / "pt.jsonl"
    path.write_text("".join(json.dumps({"i": i, "token_count": n}) + "\n" for i, n in enumerate([5, 5, 1, 20, 1, 9])))
    assert not sinks.split_file(spark, str(path), 10, 10_000) and path.exists()
    assert sinks.split_file(spark, str(path), 10, 10) and not path.exists()
    made = {f.name: [json.loads(x)["i"] for x in f.read_text().splitlines()] for f in tmp_path.iterdir() if f.suffix == ".jsonl"}
    assert made == {"pt-chunk-00000.jsonl": [0, 1], "pt-chunk-00001.jsonl": [2], "pt-chunk-00002.jsonl": [3], "pt-chunk-00003.jsonl": [4, 5]}
    assert not sinks.split_file(spark, str(tmp_path / "pt-chunk-00000.jsonl"), 1, 1)


def test_streams(spark, tmp_path, data):
    docs = spark.createDataFrame([("pt", 5), ("bn", 7), ("pt", 1)], "language string, token_count int")
    docs.write.parquet(str(tmp_path / "shards"))
    stream = shards.shard_stream(spark, str(tmp_path / "shards"), "language string, token_count int")
    query = shards.running_totals(stream, "language", "token_count").writeStream.outputMode("complete").format("memory").queryName("totals").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r.language: (r.documents, r.tokens) for r in spark.table("totals").collect()} == {"pt": (2, 6), "bn": (1, 7)}
    events = spark.read.parquet(f"{data}/events.parquet")
    assert shards.windowed_counts(events, "ts", "event_type").agg(F.sum("events")).collect()[0][0] == events.count()
    assert shards.sessions(events, "ts", "user_id").agg(F.sum("events")).collect()[0][0] == events.count()


@pytest.mark.parametrize("name", sorted(samples.GENERATORS))
def test_generated_tasks(spark, name):
    made = samples.generated(spark, 30, samples.GENERATORS[name])
    rows = made.collect()
    assert len(rows) >= 10 and len({r.id for r in rows}) == len(rows) and all(len(r.kwargs) == len(r.verifier_id_list) > 0 for r in rows)
    assert sorted(r.id for r in samples.generated(spark, 30, samples.GENERATORS[name]).repartition(3).collect()) == sorted(r.id for r in rows)
    report = samples.sample_report(made).collect()[0]
    assert report.with_conflicts == 0 and report.samples == report.unique_ids == len(rows)


def test_answers_of_generated_tasks_pass(spark):
    for make, answer in ((samples.arithmetic, lambda p: p[0]["expected_answer"]), (samples.word_list, lambda p: " ".join(" ".join(v) if isinstance(v, list) else str(v) for k, v in p[0].items() if k.startswith("expected")))):
        rows = [s for i in range(20) if (s := samples._attempt(make, 1, i))]
        df = spark.createDataFrame([(i, answer([json.loads(k) for k in s[3]]), s[2], s[3]) for i, s in enumerate(rows)], "i int, t string, n array<string>, p array<string>")
        assert all(r.reward == 1 for r in verify.verified(df, "i", "t", "n", "p").collect())


def test_haystacks(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, ". ".join(" ".join(rng.choices(samples.WORDS, k=6)) for _ in range(9))) for i in range(8)] + [(9, " "), (10, None)], "k int, text string")
    rows = samples.haystacks(df, "k", "text").collect()
    assert len(rows) == 8 and all(v in r.prompt for r in rows for own in json.loads(r.kwargs[0])["expected_values"].values() for v in own)
