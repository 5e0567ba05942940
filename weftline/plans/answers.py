"""Queries of the checks of answers, templates and prompts, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dialogue, prompts, templates, verify
from . import sql
from .tables import answers, conversations, read

_NW = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}]"
_SENTENCES = f"len(list_filter(string_split(regexp_replace({sql.strip('text')}, '([.!?…])[\"''”»)]*[\\s\\x0b]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')))"
_WORD_COUNT = r"len(regexp_extract_all(text, '[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}]+'))"
_FIRST = f"lower(regexp_extract(regexp_replace({sql.word_list('p[1]')}[1], '^''*\"*', ''), '^([^.,?!''\"]*)', 1))"
_OUT_OF = "list_filter([{0}], lambda w: contains({1}, w))"


def _filled(pattern: str) -> str:
    return f"len(list_filter(regexp_extract_all(text, '{pattern}'), lambda x: length({sql.strip("regexp_replace(x, '^[*]+|[*]+$', '', 'g')")}) > 0))"


_MARKED = _filled(r"[*][^*\n]*[*]") + " + " + _filled(r"[*][*][^*\n]*[*][*]")
#: Checks with fixed parameters over all answers of assistants: column -> (check, parameters, soft, SQL over ``text`` and ``guess``).
INSTRUCTIONS = {
    "existence": ("keywords:existence", '{"keywords": ["de", "la"]}', False, "regexp_matches(text, '(?i)de') AND regexp_matches(text, '(?i)la')"),
    "frequency": ("keywords:frequency", '{"keyword": "de", "frequency": 6, "relation": "at least"}', False, "len(regexp_extract_all(text, '(?i)de')) >= 6"),
    "frequency_soft": ("keywords:frequency", '{"keyword": "de", "frequency": 6, "relation": "less than"}', True, "len(regexp_extract_all(text, '(?i)de')) < 7"),
    "forbidden": ("keywords:forbidden_words", '{"forbidden_words": ["the", "und"]}', False, f"NOT regexp_matches(text, '(?i)(^|{_NW})(the|und)($|{_NW})')"),
    "letters_soft": ("keywords:letter_frequency", '{"letter": "e", "let_frequency": 40, "let_relation": "at least"}', True, "length(lower(text)) - length(replace(lower(text), 'e', '')) >= 37"),
    "language": ("language:response_language", '{"language": "pt"}', False, "coalesce(guess = 'pt', true)"),
    "sentences": ("length_constraints:number_sentences", '{"num_sentences": 4, "relation": "at least"}', False, f"{_SENTENCES} >= 4"),
    "sentences_soft": ("length_constraints:number_sentences", '{"num_sentences": 4, "relation": "less than"}', True, f"{_SENTENCES} < 5"),
    "words_soft": ("length_constraints:number_words", '{"num_words": 40, "relation": "at least"}', True, f"{_WORD_COUNT} >= 36"),
    "first_word": (
        "length_constraints:nth_paragraph_first_word", '{"num_paragraphs": 1, "nth_paragraph": 1, "first_word": "O"}', False,
        f"(WITH q AS (SELECT string_split(text, chr(10) || chr(10)) AS p) SELECT len(list_filter(p, lambda x: length({sql.strip('x')}) > 0)) = 1 AND length({sql.strip('p[1]')}) > 0 AND coalesce({_FIRST} = 'o', false) FROM q)",
    ),
    "constrained": ("detectable_format:constrained_response", "{}", False, "contains(text, 'Minha resposta é sim.') OR contains(text, 'Minha resposta é não.') OR contains(text, 'Minha resposta é talvez.')"),
    "highlights": ("detectable_format:number_highlighted_sections", '{"num_highlights": 1}', False, _MARKED + " >= 1"),
    "sections": ("detectable_format:multiple_sections", '{"section_spliter": "a", "num_sections": 1}', False, r"len(regexp_extract_all(text, '\s?a\s?\d+\s?')) >= 1"),
    "repeated": ("combination:repeat_prompt", '{"prompt_to_repeat": " O "}', False, f"starts_with(lower({sql.strip('text')}), 'o')"),
    "capitals": ("change_case:capital_word_frequency", '{"capital_frequency": 1, "capital_relation": "at least"}', False, r"len(list_filter(regexp_extract_all(text, '[\p{L}\p{N}-]+'), lambda x: regexp_full_match(x, '[\p{Lu}\p{N}-]*\p{Lu}[\p{Lu}\p{N}-]*'))) >= 1"),
    "upper": ("change_case:portuguese_capital", "{}", False, r"upper(text) = text AND regexp_matches(text, '\p{L}') AND coalesce(guess = 'pt', true)"),
    "lower": ("change_case:portuguese_lowercase", "{}", False, r"lower(text) = text AND regexp_matches(text, '\p{L}') AND coalesce(guess = 'pt', true)"),
    "common": ("long_context:common_words", '{"expected_words": ["de", "museu", "guia", "xyz"]}', False, f"len({_OUT_OF.format("'de', 'museu', 'guia', 'xyz'", 'lower(text)')}) >= 2"),
    "rare": ("long_context:rare_words", '{"expected_words": ["Rio", "LA", "qqq"]}', False, f"len({_OUT_OF.format("'rio', 'la', 'qqq'", 'lower(text)')}) >= 1.5"),
    "counted": ("long_context:count_word", '{"target_word": "x", "expected_count": 3}', False, rf"regexp_matches(text, '(^|\D)3(\D|$)') OR regexp_matches(text, '(?i)(^|{_NW})(três|tres)($|{_NW})')"),
    "at_position": ("long_context:word_at_position", '{"expected_word": "Rio"}', False, "contains(lower(text), 'rio')"),
    "winner": ("long_context:frequency_comparison", '{"expected_winner": "GUIA"}', False, "contains(lower(text), 'guia')"),
    "needle": ("haystack:needle_single_number", '{"expected_values": {"k": ["1", "2"]}}', False, "contains(text, '1') AND contains(text, '2')"),
    "needles": ("haystack:needle_multi_number_same_key", '{"expected_values": {"k": ["1", "2", "3"]}}', False, f"len({_OUT_OF.format("'1', '2', '3'", 'text')}) >= 1.5"),
    "needles_apart": ("haystack:needle_multi_number_diff_keys", '{"expected_values": {"k": ["7"], "l": ["8"], "m": ["9"]}}', False, f"len({_OUT_OF.format("'7', '8', '9'", 'text')}) >= 1.5"),
    "uuid": ("haystack:needle_uuid", '{"expected_values": {"k": ["DE", "QQ"]}}', False, "contains(lower(text), 'de') OR contains(lower(text), 'qq')"),
}


def instruction_checks(spark: SparkSession, root: str) -> DataFrame:
    rows = answers(spark, root).select("conv_id", "turn", *(verify.check(n, F.col("text"), F.lit(p), soft).alias(k) for k, (n, p, soft, _) in INSTRUCTIONS.items()))
    return rows.dropDuplicates(["conv_id", "turn"])


_JSON_KINDS = {0: "```json\n{0}\n```", 1: "{0}", 2: "`{0}`", 3: "{0"}


def _json_texts(spark: SparkSession, root: str) -> DataFrame:
    """Objects made of the fields of a row, fenced, bare, between single marks, or broken, by turns."""
    n, language = F.coalesce("token_count", F.lit(0)), F.regexp_replace(F.coalesce("language", F.lit("")), "[^A-Za-z]", "")
    made = F.concat(F.lit('{"language": "'), language, F.lit('", "n": '), n.cast("string"), F.lit("}"))
    kind = n % 4
    text = F.when(kind == 0, F.concat(F.lit("```json\n"), made, F.lit("\n```"))).when(kind == 1, made).when(kind == 2, F.concat(F.lit("Here: `"), made, F.lit("`"))).otherwise(F.concat(F.lit("`{"), made))
    return read(spark, root, "dataset").select("id", text.alias("text"))


def json_checks(spark: SparkSession, root: str) -> DataFrame:
    checks = {
        "is_json": ("detectable_format:json_format", "{}"), "object": ("email:json_format", "{}"), "keys": ("email:schema_keys", '{"required_keys": ["n", "language"]}'),
        "value": ("email:field_value", '{"field_name": "n", "expected_value": 120}'), "named": ("email:field_value", '{"field_name": "language", "expected_value": "pt"}'),
    }
    return _json_texts(spark, root).select("id", *(verify.check(n, F.col("text"), F.lit(p)).alias(k) for k, (n, p) in checks.items())).dropDuplicates(["id"])


def tool_checks(spark: SparkSession, root: str) -> DataFrame:
    """Calls made of orders: sound, without one argument, refused in words, and broken, by turns."""
    o = read(spark, root, "orders")
    kind = F.col("o_orderkey") % 4
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    text = (
        F.when(kind == 0, F.concat(F.lit('<tool_call>\n{"name": "lookup", "arguments": {"key": '), key, F.lit(', "status": "'), status, F.lit('"}}\n</tool_call>')))
        .when(kind == 1, F.concat(F.lit('<tool_call>{"name": "other", "arguments": {"key": '), key, F.lit("}}</tool_call>")))
        .when(kind == 2, F.lit("There is no tool for this order."))
        .otherwise(F.lit("<tool_call>{broken</tool_call>"))
    )
    checks = {
        "called": ("tool_call:format", '{"expect_call": true}'), "uncalled": ("tool_call:format", '{"expect_call": false}'), "name": ("tool_call:name", '{"expected_name": "lookup"}'),
        "keys": ("tool_call:args_keys", '{"required_arg_keys": ["key", "status"]}'), "kinds": ("tool_call:args_types", '{"expected_arg_types": {"key": "integer", "status": "string"}}'),
        "refused": ("tool_call:refusal", '{"min_refusal_words": 5}'),
    }
    return o.select("o_orderkey", text.alias("text")).select("o_orderkey", *(verify.check(n, F.col("text"), F.lit(p)).alias(k) for k, (n, p) in checks.items()))


def math_checks(spark: SparkSession, root: str) -> DataFrame:
    """Prices as answers: in English and Portuguese notation, plain, with one place less, and another number, by turns."""
    price = F.format_number("o_totalprice", 2)
    plain = F.replace(price, F.lit(","), F.lit(""))
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, price)
        .when(kind == 1, F.translate(price, ".,", ",."))
        .when(kind == 2, F.concat(F.lit("x = "), plain))
        .when(kind == 3, F.expr("substring(replace(format_number(o_totalprice, 2), ',', ''), 1, length(replace(format_number(o_totalprice, 2), ',', '')) - 1)"))
        .otherwise(F.lit("7"))
    )
    rows = read(spark, root, "orders").select("o_orderkey", text.alias("text"), F.to_json(F.struct(plain.alias("expected_answer"))).alias("p"))
    return rows.select("o_orderkey", *(verify.check("math:answer_check", F.col("text"), F.col("p"), soft).alias(name) for name, soft in (("strict", False), ("soft", True))))


def answer_rewards(spark: SparkSession, root: str) -> DataFrame:
    checks = [(n, p) for n, p, soft, _ in INSTRUCTIONS.values() if not soft] + [("tool_call:refusal", "{}"), ("no:such", "{}")]
    rows = answers(spark, root).withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    rows = rows.withColumn("ids", F.array(*(F.lit(n) for n, _ in checks))).withColumn("kwargs", F.array(*(F.lit(p) for _, p in checks)))
    made = verify.verified(rows, "key", "text", "ids", "kwargs").select("key", F.round("reward", 6).alias("reward"))
    return made.dropDuplicates(["key"])


def soft_rewards(spark: SparkSession, root: str) -> DataFrame:
    """Rewards in thinking mode, thoughts put before every second answer."""
    checks = [(n, p) for n, p, soft, _ in INSTRUCTIONS.values() if soft]
    thought = F.when(F.col("turn") % 4 == 1, F.concat(F.lit("<think>Let me see.</think>\n"), F.col("text"))).otherwise(F.col("text"))
    rows = answers(spark, root).select(F.concat_ws("-", "conv_id", "turn").alias("key"), thought.alias("text"))
    rows = rows.withColumn("ids", F.array(*(F.lit(n) for n, _ in checks))).withColumn("kwargs", F.array(*(F.lit(p) for _, p in checks)))
    made = verify.verified(rows, "key", "text", "ids", "kwargs", soft=True, thinking=True)
    return made.select("key", F.round("reward", 6).alias("reward"), F.size("results").alias("checks")).dropDuplicates(["key"])


def _with_ids(df: DataFrame, key: str) -> DataFrame:
    names = F.array(*map(F.lit, verify.INSTRUCTION_CHECKS))
    n = len(verify.INSTRUCTION_CHECKS)
    return df.select(key, F.array(F.get(names, (F.col(key) % n).cast("int")), F.get(names, F.floor(F.col(key) / n).cast("int") % n)).alias("ids"))


def conflicting_checks(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of checks, two for each order by its key, that can't go together."""
    rows = _with_ids(read(spark, root, "orders"), "o_orderkey")
    return verify.conflicting_samples(rows, "o_orderkey", "ids")


def conflict_table(spark: SparkSession, root: str) -> DataFrame:
    """How many checks each check of instructions can't go with."""
    pairs = spark.createDataFrame(verify.conflict_pairs(), "first string, second string")
    return pairs.groupBy("first").agg(F.count("*").alias("n"))


def _talks(spark: SparkSession, root: str) -> DataFrame:
    """Conversations with plain role names, thoughts in some answers, apart in others, and tools that were called."""

    # Every fifth user message comes from a tool.
    def message(m: Column, i: Column) -> Column:
        own = F.lower(F.trim(m["role"]))
        plain = F.when(own == "human", F.lit("user")).when(own == "gpt", F.lit("assistant")).otherwise(own)
        named = F.when((plain == "user") & (i % 5 == 4), F.lit("tool")).otherwise(plain)
        thought = F.when((named == "assistant") & (i % 3 == 1), F.concat(F.lit("<think>\nstep "), i.cast("string"), F.lit("\n</think>\n\n"))).otherwise(F.lit(""))
        apart = F.when((named == "assistant") & (i % 4 == 2), F.concat(F.lit("\napart "), i.cast("string"), F.lit("\n")))
        call = F.struct(F.lit("lookup").alias("name"), F.concat(F.lit('{"turn": '), i.cast("string"), F.lit("}")).alias("arguments"))
        calls = F.when((named == "assistant") & (i % 4 == 3), F.array(call, call))
        return F.struct(named.alias("role"), F.concat(thought, m["content"]).alias("content"), apart.alias("reasoning_content"), calls.alias("tool_calls"))

    return conversations(spark, root).where("messages IS NOT NULL").select("conv_id", F.transform("messages", message).alias("messages"))


def chat_template_reasoning(spark: SparkSession, root: str) -> DataFrame:
    talks = _talks(spark, root)
    return talks.select("conv_id", templates.rendered_with_reasoning(F.col("messages"), True, False, thoughts_field="reasoning_content", calls_field="tool_calls").alias("text"))


def chat_template_tools(spark: SparkSession, root: str) -> DataFrame:
    """Contents as they are, with tools in the system's turn of every third conversation."""
    tools = F.when(F.col("conv_id") % 3 == 0, F.array(F.lit('{"name": "lookup"}'), F.lit('{"name": "other"}'))).otherwise(F.array().cast("array<string>"))
    return _talks(spark, root).select("conv_id", templates.rendered_with_reasoning(F.col("messages"), keep_thoughts=False, tools=tools).alias("text"))


_NL = "chr(10)"
_TALKS = f"""talks AS (SELECT conv_id, list_transform(messages, lambda m, k: {{'role': CASE WHEN r[k] = 'user' AND (k - 1) % 5 = 4 THEN 'tool' ELSE r[k] END, 'content': m.content, 'k': k - 1}}) AS ms
    FROM (SELECT conv_id, messages, list_transform(messages, lambda m: CASE lower(trim(m.role)) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE lower(trim(m.role)) END) AS r FROM {sql.CONVERSATIONS} WHERE messages IS NOT NULL)),
    kept AS (SELECT conv_id, list_filter(ms, lambda m: coalesce(m.role IN ('system', 'user', 'assistant', 'tool'), false)) AS f FROM talks),
    placed AS (SELECT *, coalesce(list_max(list_filter(list_transform(f, lambda m, i: CASE WHEN m.role = 'user' AND m.content IS NOT NULL AND NOT (starts_with(m.content, '<tool_response>') AND ends_with(m.content, '</tool_response>')) THEN i - 1 END), lambda x: x IS NOT NULL)), len(f) - 1) AS last FROM kept)"""


def _turns(assistant: str) -> str:
    return f"""coalesce(array_to_string(list_transform(f, lambda m, i: CASE m.role WHEN 'tool' THEN CASE WHEN i = 1 OR coalesce(f[i - 1].role, '') <> 'tool' THEN '<|im_start|>user' ELSE '' END || {_NL} || '<tool_response>' || {_NL} || coalesce(m.content, '') || {_NL} || '</tool_response>'
        || CASE WHEN coalesce(f[i + 1].role, '') <> 'tool' THEN '<|im_end|>' || {_NL} ELSE '' END
        WHEN 'assistant' THEN '<|im_start|>assistant' || {_NL} || {assistant} || '<|im_end|>' || {_NL} ELSE '<|im_start|>' || m.role || {_NL} || coalesce(m.content, '') || '<|im_end|>' || {_NL} END), ''), '')"""


_THOUGHT = f"CASE WHEN m.k % 4 = 2 THEN 'apart ' || m.k WHEN m.k % 3 = 1 AND m.content IS NOT NULL THEN 'step ' || m.k ELSE '' END"
_ANSWER = f"CASE WHEN m.k % 4 = 2 AND m.k % 3 = 1 AND m.content IS NOT NULL THEN '<think>' || {_NL} || 'step ' || m.k || {_NL} || '</think>' || {_NL} || {_NL} || m.content WHEN m.k % 3 = 1 AND m.k % 4 <> 2 THEN regexp_replace(coalesce(m.content, ''), '^\\n+', '') ELSE coalesce(m.content, '') END"
_CALL = f"'<tool_call>' || {_NL} || '{{\"name\": \"lookup\", \"arguments\": {{\"turn\": ' || m.k || '}}}}' || {_NL} || '</tool_call>'"
_REASONED = f"""CASE WHEN i - 1 > last AND (i = len(f) OR {_THOUGHT} <> '') THEN '<think>' || {_NL} || {_THOUGHT} || {_NL} || '</think>' || {_NL} || {_NL} || regexp_replace({_ANSWER}, '^\\n+', '') ELSE {_ANSWER} END
    || CASE WHEN m.k % 4 = 3 THEN CASE WHEN {_ANSWER} <> '' THEN {_NL} ELSE '' END || {_CALL} || {_NL} || {_CALL} ELSE '' END"""
_WHOLE = f"CASE WHEN m.k % 3 = 1 AND m.content IS NOT NULL THEN '<think>' || {_NL} || 'step ' || m.k || {_NL} || '</think>' || {_NL} || {_NL} || m.content ELSE coalesce(m.content, '') END"
_HEAD = "'<|im_start|>system' || chr(10) || CASE WHEN f[1].role = 'system' AND coalesce(f[1].content, '') <> '' THEN f[1].content || chr(10) || chr(10) ELSE '' END || '" + templates.TOOLS_HEAD.replace("'", "''") + "' || chr(10) || '{\"name\": \"lookup\"}' || chr(10) || '{\"name\": \"other\"}' || '" + templates.TOOLS_TAIL.replace("'", "''") + "<|im_end|>' || chr(10)"


def preference_prompts(spark: SparkSession, root: str) -> DataFrame:
    """The prompt of pairs whose last message differs, and of pairs that are the same."""
    other = F.when(F.col("conv_id") % 2 == 0, F.concat(F.slice("messages", 1, F.greatest(F.size("messages") - 1, F.lit(0))), F.array(F.struct(F.lit("assistant").alias("role"), F.lit("No.").alias("content"))))).otherwise(F.col("messages"))
    rows = conversations(spark, root).where("size(messages) > 0").select("conv_id", "messages", other.alias("rejected"))
    return rows.select("conv_id", F.size(prompts.shared_prompt(F.col("messages"), F.col("rejected"))).cast("bigint").alias("n"))


def revision_prompts(spark: SparkSession, root: str) -> DataFrame:
    """Lengths of the prompts for a critique and a revision of each first message."""
    first, second = F.get("messages", 0)["content"], F.get("messages", 1)["content"]
    return conversations(spark, root).select(
        "conv_id", F.length(prompts.critique_prompt(first, second)).cast("bigint").alias("critique"), F.length(prompts.revision_prompt(first, second, F.lit("Too short."))).cast("bigint").alias("revision")
    )


def sft_rows(spark: SparkSession, root: str) -> DataFrame:
    """Conversations that end with the assistant and have at most 3,000 characters in the template."""
    return dialogue.valid_rows(conversations(spark, root), "messages", 3_000, F.length).select("conv_id")


def chunk_skips(spark: SparkSession, root: str) -> DataFrame:
    """Documents of at most 200 words, the others being passed over."""
    return prompts.within_chunk(read(spark, root, "documents"), "text", 200, lambda c: F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != ""))).select("doc_id")


def rollout_rows(spark: SparkSession, root: str) -> DataFrame:
    """Two rollouts of each document's domain by a stand-in for a model, a row for each."""
    made = prompts.rollouts(read(spark, root, "documents"), "domain", lambda batch: [[p.upper(), p[::-1]] for p in batch], ["doc_id"])
    return prompts.one_row_each(made, "rollouts", "answer").select("doc_id", "position", "answer")


def failure_reasons(spark: SparkSession, root: str) -> DataFrame:
    """Logs of runs made of documents, with and without a failure in them, in upper and lower case."""
    lines = ["torch.OutOfMemoryError: tried; CUDA out of memory", "slurm: job cancelled DUE TO TIME LIMIT", "failed to start vllmserver server", "Server encountered unrecoverable error", "all went well", "CUDA out of memory, then DUE TO TIME LIMIT"]
    line = F.get(F.array(*map(F.lit, lines)), (F.col("doc_id") % len(lines)).cast("int"))
    log = F.concat(F.lit("start\n"), line, F.lit("\n"), F.coalesce("text", F.lit("")))
    return read(spark, root, "documents").select("doc_id", prompts.failure(log).alias("reason"))


_ANSWERS = f"""a AS (SELECT conv_id, unnest(messages) AS m, unnest(range(len(messages))) AS turn FROM {sql.CONVERSATIONS}),
    b AS (SELECT conv_id, turn::INT AS turn, m.content AS text, {sql.token_list("lower(m.content)")} AS t FROM a WHERE lower(trim(m.role)) IN ('assistant', 'gpt') AND m.content IS NOT NULL),
    c AS (SELECT *, {sql.guess("text", "t")} AS guess FROM b)"""


def _reward(soft: bool, extra: str, n: int) -> str:
    own = [q for _, _, s, q in INSTRUCTIONS.values() if s is soft]
    return f"round(({' + '.join(f'coalesce(({q}), false)::INT' for q in own)}{extra})::DOUBLE / {n}, 6)"


_REFUSED = " + (NOT contains(text, '<tool_call>') AND len(" + sql.word_list("text") + ") >= 5)::INT"
_STRICT = [k for k, v in INSTRUCTIONS.items() if not v[2]]
_SOFT = [k for k, v in INSTRUCTIONS.items() if v[2]]
_INNER = "coalesce(nullif(regexp_extract(text, '(?s)`{1,3}(?:json|JSON|Json)?\\s*(.*?)\\s*`{1,3}', 1), ''), text)"
_JSON_TEXTS = f"""WITH d AS (SELECT id, coalesce(token_count, 0) AS n, '{{"language": "' || regexp_replace(coalesce(language, ''), '[^A-Za-z]', '', 'g') || '", "n": ' || coalesce(token_count, 0) || '}}' AS o FROM {sql.DATASET}),
    e AS (SELECT id, CASE n % 4 WHEN 0 THEN '```json' || chr(10) || o || chr(10) || '```' WHEN 1 THEN o WHEN 2 THEN 'Here: `' || o || '`' ELSE '`{{' || o END AS text FROM d),
    f AS (SELECT id, text, {_INNER} AS inner_text FROM e), g AS (SELECT *, CASE WHEN json_valid(inner_text) THEN inner_text WHEN json_valid(text) THEN text END AS j FROM f)"""
_PLAIN = "regexp_replace(regexp_replace(trim(text), '^(```json|```JSON|```Json|```)', ''), '```$', '')"
_PAIRS = ", ".join(f"('{a}', '{b}')" for a, b in verify.conflict_pairs() if a < b)
_NAMES = sql.quoted(verify.INSTRUCTION_CHECKS)
_N_NAMES = len(verify.INSTRUCTION_CHECKS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        instruction_checks, json_checks, tool_checks, math_checks, answer_rewards, soft_rewards, conflicting_checks, conflict_table, chat_template_reasoning, chat_template_tools, preference_prompts,
        revision_prompts, sft_rows, chunk_skips, rollout_rows, failure_reasons,
    )
}
ORACLE: dict[str, str] = {
    "instruction_checks": f"WITH {_ANSWERS} SELECT conv_id, turn, {', '.join(f'({q}) AS {k}' for k, (_, _, _, q) in INSTRUCTIONS.items())} FROM c",
    "json_checks": f"""{_JSON_TEXTS} SELECT id, json_valid({_PLAIN}) AS is_json, contains(text, '`') AND j IS NOT NULL AS object, coalesce(list_sort(json_keys(j)) = ['language', 'n'], false) AS keys,
        coalesce(json_extract_string(j, '$.n') = '120', false) AS value, coalesce(json_extract_string(j, '$.language') = 'pt', false) AS named FROM g""",
    "tool_checks": """SELECT o_orderkey, o_orderkey % 4 IN (0, 1) AS called, o_orderkey % 4 = 2 AS uncalled, o_orderkey % 4 = 0 AS name, o_orderkey % 4 = 0 AS keys, o_orderkey % 4 = 0 AS kinds, o_orderkey % 4 = 2 AS refused FROM orders""",
    "math_checks": "SELECT o_orderkey, o_orderkey % 5 = 2 OR (o_orderkey % 5 = 0 AND o_totalprice < 1000) AS strict, o_orderkey % 5 <> 4 AS soft FROM orders",
    "answer_rewards": f"WITH {_ANSWERS} SELECT conv_id || '-' || turn AS key, {_reward(False, _REFUSED, len(_STRICT) + 2)} AS reward FROM c",
    "soft_rewards": f"WITH {_ANSWERS} SELECT conv_id || '-' || turn AS key, {_reward(True, ' + (turn % 4 = 1)::INT', len(_SOFT) + 1)} AS reward, {len(_SOFT) + 1} AS checks FROM c",
    "conflicting_checks": f"""WITH p(first, second) AS (VALUES {_PAIRS}), o AS (SELECT o_orderkey, [{_NAMES}][(o_orderkey % {_N_NAMES})::INT + 1] AS x, [{_NAMES}][(o_orderkey // {_N_NAMES} % {_N_NAMES})::INT + 1] AS y FROM orders)
        SELECT o_orderkey, first, second FROM o JOIN p ON first = least(x, y) AND second = greatest(x, y)""",
    "chat_template_reasoning": f"WITH {_TALKS} SELECT conv_id, {_turns(_REASONED)} || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) AS text FROM placed",
    "chat_template_tools": f"""WITH {_TALKS}, h AS (SELECT conv_id, last, f AS g, CASE WHEN conv_id % 3 = 0 THEN {_HEAD} ELSE '' END AS head, f[1].role = 'system' AND conv_id % 3 = 0 AS skip FROM placed),
        i AS (SELECT conv_id, last, head, CASE WHEN coalesce(skip, false) THEN g[2:] ELSE g END AS f FROM h) SELECT conv_id, head || {_turns(_WHOLE)} AS text FROM i""",
    "preference_prompts": f"""SELECT conv_id, (CASE WHEN conv_id % 2 = 0 AND NOT (coalesce(messages[len(messages)].role, '') = 'assistant' AND coalesce(messages[len(messages)].content, '') = 'No.') THEN len(messages) - 1 ELSE len(messages) END)::BIGINT AS n
        FROM {sql.CONVERSATIONS} WHERE len(messages) > 0""",
    "revision_prompts": f"""SELECT conv_id, {len(prompts.CRITIQUE) - len("{request}{response}")} + length(coalesce(messages[1].content, '')) + length(coalesce(messages[2].content, '')) AS critique,
        {len(prompts.REVISION) - len("{request}{response}{critique}") + len("Too short.")} + length(coalesce(messages[1].content, '')) + length(coalesce(messages[2].content, '')) AS revision FROM {sql.CONVERSATIONS}""",
    "sft_rows": f"""SELECT conv_id FROM {sql.CONVERSATIONS} WHERE coalesce(messages[len(messages)].role = 'assistant', false) AND list_sum(list_transform(list_filter(messages, lambda m: coalesce(m.role IN ('system', 'user', 'assistant'), false)),
        lambda m: length(m.role) + 24 + length(CASE WHEN m.role = 'assistant' THEN regexp_replace(coalesce(m.content, ''), '^\\n+|\\n+$', '', 'g') ELSE coalesce(m.content, '') END))) <= 3000""",
    "chunk_skips": f"SELECT doc_id FROM documents WHERE len({sql.word_list("coalesce(text, '')")}) <= 200",
    "rollout_rows": "SELECT doc_id, unnest([0, 1])::INT AS position, unnest([upper(coalesce(domain, '')), reverse(coalesce(domain, ''))]) AS answer FROM documents",
    "failure_reasons": "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'OOM' WHEN 1 THEN 'timeout' WHEN 2 THEN 'server_fail' WHEN 3 THEN 'server_fail' WHEN 5 THEN 'OOM' END AS reason FROM documents",
}
