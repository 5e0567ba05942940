"""Pieces of the queries' SQL, as the independent engine says them."""

from __future__ import annotations

from ..operators import language

#: White space as the first engine sees it, in the second one's patterns.
WS = r"[\s\x0b\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def word_list(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def line_list(x: str) -> str:
    return f"list_filter(string_split({x}, chr(10)), lambda l: length({strip('l')}) > 0)"


def token_list(x: str) -> str:
    return f"regexp_extract_all({x}, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')"


ONCE = "(SELECT * FROM {0} QUALIFY row_number() OVER (PARTITION BY {1} ORDER BY ingested_at) = 1)"
DATASET, CONVERSATIONS = ONCE.format("dataset", "id"), ONCE.format("conversations", "conv_id")


def quoted(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def guess(text: str, tokens: str) -> str:
    """The language most of whose stop words are among ``tokens``, null for none."""
    scores = ", ".join(f"{{'hits': len(list_filter({tokens}, lambda w: w IN ({quoted(ws)}))), 'place': {-i}, 'code': '{code}'}}" for i, (code, ws) in enumerate(sorted(language.STOP_WORDS.items())))
    return f"CASE WHEN length({strip(text)}) >= 10 AND list_max([{scores}]).hits > 0 THEN list_max([{scores}]).code END"


def hash_order(key: str, seed: int = 42) -> str:
    """The sort key of a seeded order."""
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 15))::BIGINT"
