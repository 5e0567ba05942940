"""SQL of the queries, for an independent engine; queries that SQL can't say are tested against brute force instead."""

from __future__ import annotations

from ..operators import dialogue, language
from ..operators.quality import LINE_ENDS
from . import answers, folders
from .sql import CONVERSATIONS as _CONVERSATIONS
from .sql import DATASET as _DATASET
from .sql import WS as _WS
from .sql import guess, hash_order, line_list, quoted, strip, token_list, word_list
from .queries import ANSWER_CHECKS, BLOCK, LANGUAGES_KEPT, LEAST_WORDS_IN_COMMON

_ALLOWED = language.allowed_class(LANGUAGES_KEPT)
_N = "coalesce(token_count, 0)"


def share(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) = 0 THEN 0.0 ELSE ({part})::DOUBLE / ({whole}) END"


def total(items: str, value: str) -> str:
    return f"coalesce(list_sum(list_transform({items}, lambda x: {value})), 0)"


_STATS = "length(regexp_replace(text, '" + _ALLOWED + "', '', 'g'))"
_SHARE = f"CASE WHEN length(text) > 0 THEN (length(text) - {_STATS})::DOUBLE / length(text) END"
_IN_RANGES = f"coalesce({_SHARE} >= 0.85, false)"
_W = word_list("coalesce(text, '')")
_DOC_WORDS = f"(SELECT *, {_W} AS w FROM documents)"
_MEAN = share(total("w", "length(x)"), "len(w)")
_ALPHA = share(r"len(list_filter(w, lambda x: regexp_matches(x, '\p{L}')))", "len(w)")
_FLAT = "coalesce(array_to_string(list_filter(list_transform(messages, lambda m: coalesce(m.content, '')), lambda c: c <> ''), chr(10)), '')"
_LAST = strip("messages[len(messages)].content")


def _guess() -> str:
    return f"""WITH a AS (SELECT doc_id, text, {token_list("lower(coalesce(text, ''))")} AS t FROM documents) SELECT doc_id, {guess("text", "t")} AS guess FROM a"""


def _answer_checks() -> str:
    sql = {
        "no_comma": "NOT contains(text, ',')",
        "title": f"len(list_filter(regexp_extract_all(text, '<<[^\\n]+>>'), lambda x: length({strip("regexp_replace(x, '^<+|>+$', '', 'g')")}) > 0)) > 0",
        "two_bullets": "len(regexp_extract_all(text, '(?m)^\\s*\\*\\s+\\S.*$')) + len(regexp_extract_all(text, '(?m)^\\s*-\\s+\\S.*$')) = 2",
        "letter": "length(lower(text)) - length(replace(lower(text), 'a', '')) >= 20",
        "placeholders": "len(regexp_extract_all(text, '\\[.*?\\]')) >= 1",
        "postscript": "regexp_matches(lower(text), 'p\\.\\s?s\\.')",
        "two_responses": f"""(WITH p AS (SELECT string_split(text, '******') AS s), q AS (SELECT list_filter(list_transform(s, lambda x: {strip("x")}), lambda x: x <> '') AS f,
            len(list_filter(s[2:len(s) - 1], lambda x: length({strip("x")}) = 0)) AS gaps FROM p) SELECT gaps = 0 AND len(f) = 2 AND coalesce(f[1] <> f[2], false) FROM q)""",
        "quotation": f"regexp_matches({strip('text')}, '(?s)^\".*\"$') AND length({strip('text')}) > 1",
        "end": f"ends_with(lower(regexp_replace({strip('text')}, '^\"+|\"+$', '', 'g')), 'simples.')",
        "words": "len(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}\\x{200c}\\x{200d}]+')) >= 40",
        "paragraphs": f"""(WITH p AS (SELECT list_transform(regexp_split_to_array(text, '\\s?\\*\\*\\*\\s?'), lambda x: length({strip("x")}) = 0) AS e)
            SELECT len(list_filter(e[2:len(e) - 1], lambda x: x)) = 0 AND len(e) - e[1]::INT - CASE WHEN len(e) > 1 THEN e[len(e)]::INT ELSE 0 END = 1 FROM p)""",
        "thinking": f"length({strip("regexp_extract(text, '(?s)<think>(.*?)</think>', 1)")}) > 0",
    }
    assert set(sql) == set(ANSWER_CHECKS)
    return f"""WITH a AS (SELECT conv_id, unnest(messages) AS m, unnest(range(len(messages))) AS turn FROM {_CONVERSATIONS}),
    b AS (SELECT conv_id, turn::INT AS turn, m.content AS text FROM a WHERE lower(trim(m.role)) IN ('assistant', 'gpt') AND m.content IS NOT NULL)
    SELECT conv_id, turn, {", ".join(f"{q} AS {k}" for k, q in sql.items())} FROM b"""


def _windows(table: str, key: str, text: str) -> str:
    words = word_list(f"lower(coalesce({text}, ''))")
    return f"SELECT {key}, {words} AS w FROM {table}"


_K = LEAST_WORDS_IN_COMMON
_GRAMS = f"""WITH d AS ({_windows(_DATASET, "id", "text")}), b AS ({_windows("benchmark", "item_id", "text")}),
    own AS (SELECT id, w[i:i + {_K - 1}] AS g FROM (SELECT id, w, unnest(range(1, len(w) - {_K - 2})) AS i FROM d WHERE len(w) >= {_K})),
    inside AS (SELECT w[2:len(w) - 1] AS w FROM b WHERE len(w) > {_K + 1}),
    refs AS (SELECT DISTINCT w[i:i + {_K - 1}] AS g FROM (SELECT w, unnest(range(1, len(w) - {_K - 2})) AS i FROM inside WHERE len(w) >= {_K}))"""
_H = _K // 2
_OFF = f"len(list_filter(range(1, {_K + 1}), lambda i: o.g[i] <> r.g[i])) <= 1"


def _numbered(columns: str, name: str = "r") -> str:
    return f"SELECT {columns}, row_number() OVER (ORDER BY doc_id) - 1 AS {name}, count(*) OVER () AS n FROM documents"


_ENDED = f"len(list_filter(ls, lambda x: regexp_replace(x, '{_WS}+$', '')[-1] IN ({quoted(LINE_ENDS)})))"
_CODE_OK = ", ".join(f"'{t}'" for t in dialogue.CODE_TAGS)

ORACLE: dict[str, str] = {
    "corpus_quality": f"""WITH a AS (SELECT lang, text, CASE WHEN NOT {_IN_RANGES} OR len(w) < 20 OR {_MEAN} < 3 OR {_MEAN} > 10 OR {_ALPHA} < 0.8 THEN 1 ELSE 0 END AS bad FROM {_DOC_WORDS})
        SELECT lang, count(*) AS documents, sum(bad)::BIGINT AS removed, coalesce(sum(CASE WHEN bad = 0 THEN length(text) END), 0)::BIGINT AS characters FROM a GROUP BY lang""",
    "unicode_language_filter": f"SELECT doc_id, round({_SHARE}, 6) AS share FROM documents WHERE {_IN_RANGES}",
    "unicode_language_filter_excluded": f"SELECT doc_id FROM documents WHERE NOT {_IN_RANGES}",
    "guessed_languages": _guess(),
    "language_score_filter": f"SELECT id, language_score FROM {_DATASET} WHERE language_score >= 0.65",
    "corpus_totals": f"SELECT count(*) AS documents, sum({_N})::BIGINT AS tokens, round(avg({_N}), 6) AS mean FROM {_DATASET}",
    "token_report_rollup": f"SELECT source, language, count(*) AS documents, sum({_N})::BIGINT AS tokens, (grouping(source) + grouping(language))::INT AS level FROM {_DATASET} GROUP BY ROLLUP (source, language)",
    "token_histogram": f"""WITH a AS (SELECT token_count::DOUBLE AS v, min(token_count) OVER () AS lo, (max(token_count) OVER () - min(token_count) OVER ())::DOUBLE / 50 AS width FROM {_DATASET} WHERE token_count IS NOT NULL),
        b AS (SELECT least(floor((v - lo) / width), 49)::INT AS bin, lo, width FROM a)
        SELECT bin, round(bin * width + lo, 6) AS low, round((bin + 1) * width + lo, 6) AS high, count(*) AS rows FROM b GROUP BY bin, lo, width""",
    "token_summary": f"SELECT count(token_count) AS rows, round(avg(token_count), 6) AS mean, round(median(token_count), 6) AS median, min(token_count) AS least, max(token_count) AS largest FROM {_DATASET}",
    "old_and_new_totals": f"""WITH a AS (SELECT language, {_N} AS n, coalesce(datediff('day', fetched_at, ingested_at) > 1, false) AS late FROM {_DATASET})
        SELECT language, sum((NOT late)::INT)::BIGINT AS old_documents, sum(CASE WHEN late THEN 0 ELSE n END)::BIGINT AS old_tokens, sum(late::INT)::BIGINT AS new_documents,
        sum(CASE WHEN late THEN n ELSE 0 END)::BIGINT AS new_tokens, count(*) AS documents, sum(n)::BIGINT AS tokens FROM a GROUP BY ROLLUP (language)""",
    "quality_words": f"""WITH a AS (SELECT doc_id, w, {line_list("text")} AS ls FROM {_DOC_WORDS} WHERE text IS NOT NULL)
        SELECT doc_id, len(w)::BIGINT AS n_words, round({_MEAN}, 6) AS mean_word_length, round({share(r"len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[•\-*]')))", "len(ls)")}, 6) AS bullet_lines,
        round({share(r"len(list_filter(ls, lambda x: regexp_matches(x, '(?:\.\.\.|…)\s*$')))", "len(ls)")}, 6) AS ellipsis_lines,
        round({_ALPHA}, 6) AS alpha_words, len(list_intersect(list_distinct(list_transform(w, lambda x: lower(x))), [{quoted(language.STOP_WORDS["en"])}]))::BIGINT AS stop_words FROM a""",
    "quality_lines": f"""WITH a AS (SELECT doc_id, {line_list("text")} AS ls FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, round({share(_ENDED, "len(ls)")}, 6) AS ended_lines, round({share("len(list_filter(ls, lambda x: length(x) <= 30))", "len(ls)")}, 6) AS short_lines,
        round({share("len(ls) - len(list_distinct(ls))", "len(ls)")}, 6) AS duplicate_lines,
        round({share(total("ls", "length(x)") + " - " + total("list_distinct(ls)", "length(x)"), total("ls", "length(x)"))}, 6) AS duplicate_line_chars FROM a""",
    "url_filter": r"""WITH a AS (SELECT doc_id, regexp_split_to_array(lower(url), '[^a-z0-9]+') AS t, regexp_replace(regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.\-]*://)?([^/?#:]+)', 1), '^www\.', '') AS host FROM documents WHERE url IS NOT NULL)
        SELECT doc_id, CASE WHEN host = 'example' OR ends_with(host, '.example') THEN 'domain' WHEN list_contains(t, 'casino') THEN 'banned_word' WHEN len(list_intersect(list_distinct(t), ['shop', 'online', 'id'])) >= 2 THEN 'soft_words' END AS reason FROM a""",
    "symbol_lines": r"SELECT doc_id, length(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^\s*\|[\|\s]*$')), chr(10)))::BIGINT AS characters FROM documents WHERE text IS NOT NULL",
    "page_text": f"""WITH a AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '({_WS}|[\\x1c-\\x1f])+', ' ', 'g') AS t FROM documents) SELECT doc_id, nullif(trim(t), '') AS text FROM a""",
    "exact_dedup": "SELECT doc_id, CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS representative FROM documents",
    "decontam_exact": f"{_GRAMS} SELECT DISTINCT id FROM own o JOIN refs r ON o.g = r.g",
    "decontam_one_exchange": f"""{_GRAMS} SELECT DISTINCT id FROM (SELECT o.id FROM own o JOIN refs r ON o.g[1:{_H}] = r.g[1:{_H}] WHERE {_OFF}
        UNION ALL SELECT o.id FROM own o JOIN refs r ON o.g[{_H + 1}:{_K}] = r.g[{_H + 1}:{_K}] WHERE {_OFF})""",
    "score_threshold": f"""SELECT coalesce(nullif(replace({strip("language")}, '/', '_'), ''), 'unknown') AS subset, count(*) AS documents, sum({_N})::BIGINT AS tokens FROM {_DATASET} WHERE edu_int_score >= 3 GROUP BY 1""",
    "stratified_routes": f"""SELECT coalesce(nullif(replace({strip("source")}, '/', '_'), ''), 'default') AS subset, count(*) AS documents, sum({_N})::BIGINT AS tokens FROM {_DATASET} GROUP BY 1""",
    "distinct_sources": "SELECT DISTINCT source FROM dataset WHERE source IS NOT NULL",
    "classifier_confusion": f"""SELECT greatest(least(edu_int_score - 1, 4), 0)::INT AS label, greatest(least(round_even(round(language_score * 4, 3), 0), 4), 0)::INT AS predicted, count(*) AS n
        FROM {_DATASET} WHERE edu_int_score IS NOT NULL AND language_score IS NOT NULL GROUP BY 1, 2""",
    "messages_flattened": f"SELECT conv_id, {_FLAT} AS text FROM {_CONVERSATIONS}",
    "messages_without_system": f"SELECT conv_id, coalesce(len(list_filter(messages, lambda m: coalesce(lower(m.role), '') <> 'system')), 0)::BIGINT AS n FROM {_CONVERSATIONS}",
    "messages_stripped": f"""SELECT conv_id, array_to_string(list_transform(messages, lambda m: {strip("coalesce(m.content, '')")}), '|') AS contents FROM {_CONVERSATIONS} WHERE messages IS NOT NULL""",
    "conversation_rules": rf"""SELECT conv_id, coalesce({_LAST} <> '' AND regexp_matches({_LAST}, '[.!?…$]["''»]*$'), false) AS ends,
        NOT regexp_matches({_FLAT}, '\\u[0-9a-fA-F]{{4}}|\\x[0-9a-fA-F]{{2}}') AS no_escapes, NOT regexp_matches({_FLAT}, '(?m)^#{{3,5}}\s*\d+') AS headings,
        coalesce(messages[len(messages)].role = 'assistant', false) AS assistant_last, coalesce(try_cast(quality_score AS DOUBLE) >= 5, false) AS scored FROM {_CONVERSATIONS}""",
    "conversation_code": rf"""WITH a AS (SELECT conv_id, {_FLAT} AS text FROM {_CONVERSATIONS}),
        b AS (SELECT *, list_transform(regexp_extract_all(text, '(?s)```([^\n`]*)\n(.*?)```', 1), lambda t: regexp_replace(regexp_extract({strip("lower(t)")}, '^(\S*)', 1), '[^a-z0-9#+]', '', 'g')) AS tags,
            regexp_extract_all(text, '(?s)```([^\n`]*)\n(.*?)```', 1) AS raw, regexp_extract_all(text, '(?s)```([^\n`]*)\n(.*?)```', 2) AS code FROM a)
        SELECT conv_id, NOT regexp_matches(text, '```\s*([a-zA-Z]+)\s*[\r\n]+\s*([a-zA-Z]+)\s*[\r\n]') AND len(list_filter(tags, lambda t: t <> '' AND t NOT IN ({_CODE_OK}))) = 0 AS tags,
            len(list_filter(range(1, len(raw) + 1), lambda i: {strip("lower(raw[i])")} NOT IN ('', {quoted(dialogue.TEXT_TAGS)})
                AND regexp_matches(code[i], '(?i)(^|[^\p{{L}}\p{{N}}_])({dialogue.TRANSLATED_KEYWORDS})($|[^\p{{L}}\p{{N}}_])'))) = 0 AS code FROM b""",
    "chat_template": rf"""SELECT conv_id, coalesce(array_to_string(list_transform(list_filter(messages, lambda m: coalesce(m.role IN ('system', 'user', 'assistant'), false)), lambda m: CASE WHEN m.role = 'assistant'
        THEN '<|im_start|>assistant' || chr(10) || regexp_replace(coalesce(m.content, ''), '^\n+|\n+$', '', 'g') || '<|im_end|>' || chr(10)
        ELSE '<|im_start|>' || coalesce(m.role, '') || chr(10) || coalesce(m.content, '') || '<|im_end|>' || chr(10) END), ''), '') || '<|im_start|>assistant' || chr(10) AS text FROM {_CONVERSATIONS}""",
    "chat_plain": f"SELECT conv_id, coalesce(array_to_string(list_filter(list_transform(messages, lambda m: m.content), lambda c: c IS NOT NULL), chr(10) || chr(10)), '') AS text FROM {_CONVERSATIONS}",
    "label_mask": f"SELECT doc_id, len(w)::BIGINT AS n, len(list_filter(w, lambda x: length(x) IN (1, 2, 3)))::BIGINT AS masked FROM {_DOC_WORDS}",
    "token_prefix": "SELECT doc_id, coalesce(n_chars, 0) AS n_chars FROM (SELECT doc_id, n_chars, sum(coalesce(n_chars, 0)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS s FROM documents) WHERE s <= 1000000",
    "array_split_chunks": f"""SELECT doc_id, (CASE WHEN r < (n % 7) * (n // 7 + 1) THEN r // (n // 7 + 1) ELSE n % 7 + (r - (n % 7) * (n // 7 + 1)) // greatest(n // 7, 1) END)::INT AS chunk FROM ({_numbered("doc_id")})""",
    "mirrored_split_chunks": f"SELECT doc_id, least(r // greatest(n // 7, 1), 6)::INT AS chunk FROM ({_numbered('doc_id')})",
    "greedy_chunks": """WITH RECURSIVE a AS (SELECT coalesce(source, 'none') AS file, doc_id, coalesce(n_chars, 0) AS n, row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY doc_id) AS i FROM documents),
        b AS (SELECT file, doc_id, i, 0::BIGINT AS chunk, n AS total FROM a WHERE i = 1
            UNION ALL SELECT a.file, a.doc_id, a.i, CASE WHEN b.total + a.n > 50000 THEN b.chunk + 1 ELSE b.chunk END, CASE WHEN b.total + a.n > 50000 THEN a.n ELSE b.total + a.n END
            FROM b JOIN a ON a.file = b.file AND a.i = b.i + 1)
        SELECT file, doc_id, chunk FROM b""",
    "validation_split": """WITH c AS (SELECT coalesce(source, 'none') AS file, count(*) AS l FROM documents GROUP BY 1),
        q AS (SELECT file, l, floor(100 * l / sum(l) OVER ())::BIGINT AS f, row_number() OVER (ORDER BY file DESC) = 1 AS final FROM c),
        t AS (SELECT file, CASE WHEN final THEN least(l, greatest(0, 100 - (SELECT sum(f) FROM q WHERE NOT final))) ELSE f END AS quota FROM q),
        r AS (SELECT doc_id, coalesce(source, 'none') AS file, row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY doc_id) AS i FROM documents)
        SELECT r.doc_id, r.file FROM r JOIN t USING (file) WHERE i <= quota""",
    "stratified_split": f"""WITH a AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {hash_order('doc_id')}, doc_id) AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
        SELECT doc_id, lang FROM a WHERE i <= floor(n * 0.1)""",
    "remaining_rows": "SELECT doc_id, lang FROM documents WHERE coalesce(lang, '') <> 'pt'",
    "pack_concat": f"""WITH a AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS p FROM {_DOC_WORDS}),
        b AS (SELECT length(x)::BIGINT AS v, row_number() OVER (ORDER BY doc_id, p) - 1 AS i FROM a)
        SELECT i // {BLOCK} AS block, min_by(v, i) AS first_id, max_by(v, i) AS last_id, sum(v)::BIGINT AS total FROM b GROUP BY 1 HAVING count(*) = {BLOCK}""",
    "prompt_budget": "SELECT doc_id, (length(coalesce(text, '')) + 20)::BIGINT AS n FROM documents WHERE length(coalesce(text, '')) + 20 <= (2048 - 1024 - 512) * 3",
    "word_frequencies": f"SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM {_DOC_WORDS}) GROUP BY word ORDER BY n DESC, word LIMIT 50",
    "rare_words": f"SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM {_DOC_WORDS}) GROUP BY word ORDER BY n, word LIMIT 50",
    "last_deliveries": "SELECT id, strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S.%f') AS ingested_at, coalesce(arg_max(token_count, ingested_at), 0) AS token_count FROM dataset GROUP BY id",
    "answer_checks": _answer_checks(),
    "first_contents": f"SELECT conv_id, coalesce(messages[1].content, '') AS text FROM {_CONVERSATIONS}",
    "evaluation_results": f"SELECT id AS model, 'task_acc' AS metric, language_score AS value FROM {_DATASET} WHERE language_score IS NOT NULL",
    "classifier_scores": f"""WITH c AS (SELECT greatest(least(edu_int_score - 1, 4), 0)::INT AS l, greatest(least(round_even(round(language_score * 4, 3), 0), 4), 0)::INT AS p FROM {_DATASET} WHERE edu_int_score IS NOT NULL AND language_score IS NOT NULL),
        k AS (SELECT l AS k FROM c UNION SELECT p FROM c), m AS (SELECT k, (SELECT count(*) FROM c WHERE l = k AND p = k) AS h, (SELECT count(*) FROM c WHERE l = k) AS n, (SELECT count(*) FROM c WHERE p = k) AS f FROM k),
        s AS (SELECT h, n, CASE WHEN f > 0 THEN h / f ELSE 0 END AS p, CASE WHEN n > 0 THEN h / n ELSE 0 END AS r FROM m)
        SELECT round(sum(h) / sum(n), 6) AS accuracy, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) AS f1 FROM s""",
    "filter_report": f"SELECT sum((NOT {_IN_RANGES})::INT)::BIGINT AS removed, sum({_IN_RANGES}::INT)::BIGINT AS remaining, round(sum((NOT {_IN_RANGES})::INT) * 100.0 / count(*), 2)::DOUBLE AS percent FROM documents",
    "repeated_texts": """SELECT 'text' AS kind, md5(text) || ':' || length(text) AS value, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1
        UNION ALL SELECT 'url', url, count(*) FROM documents WHERE text IS NOT NULL AND url IS NOT NULL GROUP BY url HAVING count(*) > 1""",
    "model_rates": """SELECT o_orderkey, round(128 * 4096 / (1.0 + o_orderkey % 7), 4)::DOUBLE AS tokens_per_second,
        round(128 * 4096 / (1.0 + o_orderkey % 7)::DOUBLE * (6 * 5e7 + 12.0 * 10 * 8 * 64 * 4096) / 300e12, 8) AS mfu FROM orders""",
    "rate_schedule": """SELECT step, round(CASE WHEN step < 50 THEN (step + 1) / 50.0 ELSE 0.1 + 0.9 * 0.5 * (1 + cos(pi() * (step - 50) / 950.0)) END, 6)::DOUBLE AS cosine,
        round(CASE WHEN step < 50 THEN (step + 1) / 50.0 WHEN step <= 800 THEN 1 ELSE 0.1 + 0.9 * (1 - sqrt((step - 800) / 200.0)) END, 6)::DOUBLE AS stable,
        CASE WHEN step < 50 THEN 'warmup' ELSE 'cosine_decay' END AS cosine_stage, CASE WHEN step < 50 THEN 'warmup' WHEN step <= 800 THEN 'stable' ELSE '1-sqrt' END AS stable_stage FROM range(1000) t(step)""",
    "event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS events FROM events GROUP BY 1, 2",
    "event_sessions": """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)
        SELECT user_id, sum(new)::BIGINT AS sessions, count(*) AS events FROM a GROUP BY user_id""",
}
ORACLE |= answers.ORACLE | folders.ORACLE
