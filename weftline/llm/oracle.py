"""SQL of the queries that SQL can express: plain statistics and the documents of slices."""

from __future__ import annotations

from .lang import LANGUAGE_NAMES, NO_LANGUAGE

#: White space as Python sees it, in the engine's patterns.
_WS = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BLANK = r"[\s\x0b\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ROWS = "(SELECT * FROM dataset QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at) = 1)"


def _clean(x: str) -> str:
    return f"lower(regexp_replace(regexp_replace({x}, '^{_BLANK}+', ''), '{_BLANK}+$', ''))"


def _quoted(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


_NAMES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in LANGUAGE_NAMES.items()) + "}"
_FIRST = "regexp_split_to_array(l, '[-_. (;,/]')[1]"
_CODE = f"CASE WHEN l IN ({_quoted(NO_LANGUAGE)}) OR {_FIRST} IN ({_quoted(NO_LANGUAGE)}) THEN NULL ELSE coalesce({_NAMES}[l], {_NAMES}[{_FIRST}], {_FIRST}) END"

ORACLE: dict[str, str] = {
    "p1_counts": f"""WITH a AS (SELECT id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda w: w <> '') AS w,
            len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '{_WS}', '', 'g') <> '')) AS n_lines FROM {_ROWS}),
        b AS (SELECT *, len(w) AS n, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::DOUBLE AS seen FROM a)
        SELECT id, n AS words, CASE WHEN n > 0 THEN round(seen / n, 6) ELSE 0 END AS word_length, CASE WHEN n > 0 THEN round(n::DOUBLE / n_lines, 6) ELSE 0 END AS line_words,
            CASE WHEN n > 0 THEN round((length(t) - length(replace(t, ',', '')))::DOUBLE / n, 6) ELSE 0 END AS comma_ratio, CASE WHEN n > 0 THEN round(length(regexp_replace(t, '[^0-9]', '', 'g')) / seen, 6) ELSE 0 END AS digit_ratio FROM b""",
    "p3_documents": f"""WITH a AS (SELECT id, min(nullif({_clean('source')}, '')) AS source, min({_clean('language')}) AS l, min(nullif(regexp_replace({_clean('domain')}, '^www[.]', ''), '')) AS domain FROM dataset GROUP BY id),
        b AS (SELECT 'source' AS slice, source AS value FROM a UNION ALL SELECT 'language', {_CODE} FROM a UNION ALL SELECT 'domain', domain FROM a UNION ALL SELECT 'all', NULL FROM a)
        SELECT slice, value, count(*) AS documents FROM b GROUP BY slice, value""",
}
