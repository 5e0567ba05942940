"""Cleaning of conversations, an array of (role, content): projections, and filters with the first failing one as the reason."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions.text import strip
from .templates import rendered

#: Tags that a fenced block of code may have, by kind.
CODE_TAGS = """
python py python3 py3 javascript js node nodejs typescript ts java c cpp c++ cxx cc csharp cs c# ruby rb go golang rust rs php swift kotlin kt scala r perl pl lua
julia jl haskell hs clojure clj elixir ex exs erlang erl fsharp fs f# ocaml ml lisp elisp commonlisp cl scheme scm racket rkt prolog cobol cob fortran f90 f95 f03
f08 pascal pas delphi ada assembly asm nasm masm vb vbnet visualbasic vba powershell ps1 pwsh matlab m objectivec objc objective-c d dlang nim crystal cr zig v vlang
dart groovy html htm xhtml css scss sass less stylus xml xsl xslt svg json jsonc json5 yaml yml toml ini cfg conf markdown md mdown restructuredtext rst latex tex
graphql gql bash sh shell zsh fish ksh csh tcsh bat batch cmd awk sed sql mysql postgresql postgres sqlite plsql tsql mongodb cql cassandra dockerfile docker makefile
make cmake terraform tf hcl ansible puppet chef nginx apache diff patch plaintext text txt console terminal output log csv tsv protobuf proto thrift avro wasm wat
webassembly solidity sol vyper move cairo regex regexp ebnf bnf mermaid plantuml dot graphviz code source snippet
""".split()
#: Tags of blocks that hold text rather than code.
TEXT_TAGS = ("markdown", "md", "text", "txt", "plaintext")
#: Keywords that a translation leaves in Portuguese inside code.
TRANSLATED_KEYWORDS = (
    r"classe\s+pública|função|método|variável|retornar|enquanto|senão|verdadeiro|falso|público|privado|protegido|estático|abstrato|interface|herança|exceção|importar"
    r"|definição|declaração|parâmetro|argumento|atributo|propriedade|instância|objeto|construtor|destrutor|sobrescrever|implementar|estender|módulo|pacote|biblioteca"
)
#: Portuguese words that repeat in any text.
LOOP_STOP_WORDS = frozenset(
    """a o e de da do das dos em na no nas nos um uma uns umas para por com como que se ou mais mas ao aos à às ser ter estar foi são é esse essa este esta isso
    isto aquele aquela seu sua seus suas ele ela eles elas nós você entre sobre até já também muito bem só ainda quando onde qual quais quem porque pode podem
    deve devem há sem pela pelo pelas pelos após""".split()
)
#: Endings whose long runs show a loop, and the letters of words.
LOOP_SUFFIXES = ("mente", "ando", "endo", "indo")
_LOOP_WORD = re.compile(r"\b[a-záàâãéèêíìîóòôõúùûüçñ]+\b")

END_OF_SENTENCE = r"""[.!?…$]["''»]*$"""
SPLIT_TAG = r"```\s*([a-zA-Z]+)\s*[\r\n]+\s*([a-zA-Z]+)\s*[\r\n]"
CODE_BLOCK = r"(?s)```([^\n`]*)\n(.*?)```"
ESCAPES = r"\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}"
NUMBERED_HEADING = r"(?md)^#{3,5}\s*\d+"


def is_messages(df: DataFrame, column: str) -> bool:
    """Whether a column holds conversations, by its schema: an array of structs with a field ``content``."""
    kind = df.schema[column].dataType
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and "content" in kind.elementType.fieldNames()


def flattened(messages: Column) -> Column:
    """The non-empty contents, a line break between them; '' for null and empty conversations."""
    contents = F.filter(F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))), lambda c: c != "")
    return F.coalesce(F.array_join(contents, "\n"), F.lit(""))


def stripped(messages: Column) -> Column:
    """Every content without white space at its ends; null contents become ''."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), strip(F.coalesce(m["content"], F.lit(""))).alias("content")))


def without_system(messages: Column) -> Column:
    """The messages of other roles than system, in any case."""
    return F.filter(messages, lambda m: F.coalesce(F.lower(m["role"]), F.lit("")) != "system")


def ends_sentence(messages: Column) -> Column:
    """Whether the last message ends a sentence; false for null and empty conversations and contents."""
    last = strip(F.try_element_at(messages, F.lit(-1))["content"])
    return F.coalesce((last != "") & last.rlike(END_OF_SENTENCE), F.lit(False))


def _blocks(text: Column, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(CODE_BLOCK), group)


def has_valid_code_tags(text: Column) -> Column:
    """False if a fence's tag is broken over two lines, or is a word outside ``CODE_TAGS``; empty texts are valid.

    A tag is the first word after the fence, in lower case, of letters, digits, # and + alone.
    """
    tags = F.transform(_blocks(text, 1), lambda t: F.regexp_replace(F.element_at(F.split(F.concat(strip(F.lower(t)), F.lit(" ")), r"\s+"), 1), r"[^a-z0-9#+]", ""))
    unknown = F.exists(tags, lambda t: (t != "") & ~F.array_contains(F.array(*map(F.lit, CODE_TAGS)), t))
    return F.coalesce(~text.rlike(SPLIT_TAG) & ~unknown, F.lit(True))


def has_sound_code(text: Column) -> Column:
    """False if a block of code, by its tag, has keywords in Portuguese; empty texts are sound."""
    pairs = F.arrays_zip(_blocks(text, 1).alias("tag"), _blocks(text, 2).alias("code"))
    broken = F.exists(
        pairs, lambda p: (strip(F.lower(p["tag"])) != "") & ~strip(F.lower(p["tag"])).isin(*TEXT_TAGS) & F.regexp_like(p["code"], F.lit(rf"(?iuU)\b({TRANSLATED_KEYWORDS})\b"))
    )
    return F.coalesce(~broken, F.lit(True))


def has_no_escapes(text: Column) -> Column:
    """False if a Unicode or hexadecimal escape stands in the text."""
    return F.coalesce(~text.rlike(ESCAPES), F.lit(True))


def has_sound_headings(text: Column) -> Column:
    """False if a line starts with three to five # and a number."""
    return F.coalesce(~text.rlike(NUMBERED_HEADING), F.lit(True))


def _longest_run(same: np.ndarray) -> int:
    """Length of the longest run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
    return int((edges[1::2] - edges[::2]).max()) if len(edges) else 0


def narrow_windows(codes: np.ndarray, window: int, unique: float) -> int:
    """How many windows of ``window`` words have a share of different words below ``unique``.

    A word counts in the windows that hold it but not its last occurrence before, which are a range of windows.
    """
    n = len(codes)
    if n < window:
        return 0
    order = np.argsort(codes, kind="stable")
    before = np.full(n, -1)
    again = codes[order[1:]] == codes[order[:-1]]
    before[order[1:][again]] = order[:-1][again]
    at = np.arange(n)
    steps = np.bincount(np.maximum(before, at - window) + 1, minlength=n + 1) - np.bincount(at + 1, minlength=n + 1)
    different = np.cumsum(steps)[: n - window + 1]
    return int((different / window < unique).sum())


def ending_run(found: list[str], endings: tuple[str, ...]) -> int:
    """The longest run of words of one ending with more than three letters before it."""
    return max((_longest_run(np.array([w.endswith(e) and len(w) > len(e) + 3 for w in found], dtype=bool)) for e in endings), default=0)


def phrase_count(codes: np.ndarray, binding: np.ndarray, sizes: tuple[int, ...] = (4, 5, 6)) -> int:
    """How often the most frequent phrase of one of ``sizes`` words occurs, of those at least half of whose words bind nothing."""
    most = 0
    for size in sizes:
        if len(codes) < size:
            continue
        places = len(codes) - size + 1
        total = np.concatenate([[0], np.cumsum(binding)])
        keys = np.zeros(places, dtype=np.uint64)
        for k in range(size):
            # Phrases as 64-bit numbers, of which two of a text are the same by chance only once in a million million texts.
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + places].astype(np.uint64) + np.uint64(1)
        keys = np.sort(keys[size - (total[size:] - total[:places]) >= size // 2])
        if len(keys):
            most = max(most, int(np.diff(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))).max()))
    return most


def loops(text: str | None, same: int = 8, unique: float = 0.15, window: int = 30, windows: int = 5, suffix_run: int = 12, repeats: int = 10) -> bool:
    """Whether a text is caught in a loop: windows of few distinct words, runs of one ending, repeated phrases, or one word over and over.

    Texts of fewer than ``window`` words are in none, and phrases count from 50 words on. A run of the same word that is
    the very end of the text isn't seen, as in the rule's first definition.
    """
    found = _LOOP_WORD.findall(text.lower()) if text else []
    n = len(found)
    if n < window:
        return False
    numbers: dict[str, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in found])
    binding = np.array([w in LOOP_STOP_WORDS for w in found], dtype=int)
    content = (binding == 0) & np.array([len(w) > 2 for w in found])
    if _longest_run(codes[1 : n - 1] == codes[: n - 2]) + 1 >= same or narrow_windows(codes[content], window, unique) >= windows:
        return True
    if ending_run(found, LOOP_SUFFIXES) >= suffix_run:
        return True
    return n >= 50 and phrase_count(codes, binding) >= int(repeats * (0.7 + 0.3 * max(1, n / 500)))


@pandas_udf(T.BooleanType())
def has_loops(texts: pd.Series) -> pd.Series:
    """``loops`` for a column; null and empty texts have none."""
    return texts.map(loops).astype(bool)


def score_at_least(score: Column, least: float) -> Column:
    """Whether a score, a number or its text, is at least ``least``; false if it is null or no number."""
    return F.coalesce(score.try_cast("double") >= least, F.lit(False))


def conversation_reasons(
    df: DataFrame, messages: str = "messages", score: str | None = None, least_score: float = 0.0, tokens: str | None = None, least_tokens: int = 0, most_tokens: int | None = None,
    drop_system: bool = False,
) -> DataFrame:
    """``df`` with cleaned ``messages`` and ``reason``, the first filter that a conversation fails, or null; one pass for all filters."""
    cleaned = stripped(F.col(messages))
    if drop_system:
        cleaned = without_system(cleaned)
    rows = df.withColumn(messages, cleaned).withColumn("_text", flattened(F.col(messages)))
    text = F.col("_text")
    rules = [
        ("incomplete", ~ends_sentence(F.col(messages))), ("malformed_code", ~has_valid_code_tags(text)), ("corrupted_code", ~has_sound_code(text)),
        ("escapes", ~has_no_escapes(text)), ("markers", ~has_sound_headings(text)), ("loops", has_loops(text)),
    ]
    if score:
        rules.append(("score", ~score_at_least(F.col(score), least_score)))
    if tokens:
        count = F.coalesce(F.col(tokens), F.lit(0))
        rules.append(("few_tokens", count < least_tokens))
        if most_tokens is not None:
            rules.append(("many_tokens", count > most_tokens))
    reason = F.coalesce(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules))
    return rows.withColumn("reason", reason).drop("_text")


def ends_with_assistant(messages: Column) -> Column:
    """Whether there are messages and the last one is the assistant's."""
    return F.coalesce(F.try_element_at(messages, F.lit(-1))["role"] == "assistant", F.lit(False))


def valid_rows(df: DataFrame, messages: str, most_tokens: int, tokens: Callable[[Column], Column], template: Callable[[Column], Column] = rendered) -> DataFrame:
    """Conversations that end with the assistant and, in their template, have at most ``most_tokens`` tokens; what can't be rendered is dropped."""
    return df.where(ends_with_assistant(F.col(messages)) & F.coalesce(tokens(template(F.col(messages))) <= most_tokens, F.lit(False)))


def is_conversational(df: DataFrame, fields: tuple[str, ...] = ("prompt", "chosen", "rejected")) -> bool:
    """Whether any of ``fields`` holds messages with a role and a content, by the table's schema."""
    kinds = {f.name: f.dataType for f in df.schema.fields if f.name in fields}
    return any(k.typeName() == "array" and k.elementType.typeName() == "struct" and {"role", "content"} <= set(k.elementType.fieldNames()) for k in kinds.values())
