"""Web quality rules: lines, words, repetition and addresses, with the first failing rule as the reason."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions.text import bound, lines, ratio, strip, sum_of, words
from .formatting import masked, repair_text, without_symbol_lines
from .language import STOP_WORDS, in_guessed_language, with_language_scores

#: Published default limits of the rules, each of them an argument below.
WORD_COUNT = (50, 100_000)
WORD_LENGTH = (3.0, 10.0)
TOP_NGRAMS = ((2, 0.20), (3, 0.18), (4, 0.16))
DUPLICATE_NGRAMS = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))
LINE_ENDS = (".", "?", "!", '"', "'", "…", "।")


def word_statistics(text: Column, stop_words: Iterable[str] = STOP_WORDS["en"], w: Column | None = None, ls: Column | None = None) -> dict[str, Column]:
    """Columns of the word rules of a text; ``w`` and ``ls`` are its words and lines, where they are at hand."""
    w, ls = words(text) if w is None else w, lines(text) if ls is None else ls
    n = F.size(w)
    return {
        "n_words": n.cast("bigint"),
        "mean_word_length": ratio(sum_of(w, F.length), n),
        "symbol_ratio": ratio(F.regexp_count(text, F.lit(r"#|\.\.\.|…")), n),
        "bullet_lines": ratio(F.size(F.filter(ls, lambda x: x.rlike(r"^\s*[•\-*]"))), F.size(ls)),
        "ellipsis_lines": ratio(F.size(F.filter(ls, lambda x: x.rlike(r"(?:\.\.\.|…)\s*$"))), F.size(ls)),
        "alpha_words": ratio(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))), n),
        "stop_words": F.size(F.array_intersect(F.transform(w, F.lower), F.array(*map(F.lit, sorted(stop_words))))).cast("bigint"),
    }


def word_reason(
    text: Column, count: tuple[int, int] = WORD_COUNT, length: tuple[float, float] = WORD_LENGTH, symbols: float = 0.1, bullets: float = 0.9, ellipses: float = 0.3,
    alpha: float = 0.8, least_stop_words: int = 2, stop_words: Iterable[str] = STOP_WORDS["en"], w: Column | None = None, ls: Column | None = None,
) -> Column:
    """The first word rule that a text breaks, or null."""
    s = word_statistics(text, stop_words, w, ls)
    rules = [
        ("few_words", s["n_words"] < count[0]), ("many_words", s["n_words"] > count[1]), ("short_words", s["mean_word_length"] < length[0]), ("long_words", s["mean_word_length"] > length[1]),
        ("symbols", s["symbol_ratio"] > symbols), ("bullets", s["bullet_lines"] > bullets), ("ellipses", s["ellipsis_lines"] > ellipses), ("few_letters", s["alpha_words"] < alpha),
        ("few_stop_words", s["stop_words"] < least_stop_words),
    ]
    return first_reason(rules)


def line_statistics(text: Column, short_line: int = 30, w: Column | None = None, ls: Column | None = None) -> dict[str, Column]:
    """Columns of the line rules of a text; ``w`` and ``ls`` as above."""
    ls = lines(text) if ls is None else ls
    n = F.size(ls)
    trimmed = F.transform(ls, lambda x: F.regexp_replace(x, r"(?U)\s+$", ""))
    size = sum_of(ls, F.length)
    return {
        "ended_lines": ratio(F.size(F.filter(trimmed, lambda x: F.substring(x, -1, 1).isin(*LINE_ENDS))), n),
        "short_lines": ratio(F.size(F.filter(ls, lambda x: F.length(x) <= short_line)), n),
        "duplicate_lines": ratio(n - F.size(F.array_distinct(ls)), n),
        "duplicate_line_chars": ratio(size - sum_of(F.array_distinct(ls), F.length), size),
        "newline_ratio": ratio(F.regexp_count(text, F.lit("\n")), F.size(words(text) if w is None else w)),
    }


def line_reason(
    text: Column, ended: float = 0.12, short: float = 999, duplicate_chars: float = 0.1, newlines: float = 0.3, w: Column | None = None, ls: Column | None = None
) -> Column:
    """The first line rule that a text breaks, or null; a limit on a share of 1 or more switches its rule off."""
    s = line_statistics(text, w=w, ls=ls)
    return first_reason(
        [("no_lines", F.size(lines(text) if ls is None else ls) == 0), ("unended_lines", s["ended_lines"] < ended), ("short_lines", s["short_lines"] > short), ("duplicate_characters", s["duplicate_line_chars"] > duplicate_chars), ("newlines", s["newline_ratio"] > newlines)]
    )


def _top_share(found: list[str], n: int, size: int) -> float:
    """Share of the characters that the most frequent n-gram, in all its places, makes up; 0 if none occurs twice."""
    counts = Counter(zip(*(found[i:] for i in range(n))))
    if not counts:
        return 0.0
    most = max(counts.values())
    if most < 2:
        return 0.0
    longest = max(sum(map(len, g)) + n - 1 for g, c in counts.items() if c == most)
    return most * longest / size


def _duplicate_share(found: list[str], n: int, size: int) -> float:
    """Share of the characters in n-grams seen before, from left to right, without counting a word twice."""
    seen, repeated, i = set(), 0, 0
    while i <= len(found) - n:
        gram = tuple(found[i : i + n])
        if gram in seen:
            repeated += sum(map(len, gram))
            i += n
        else:
            seen.add(gram)
            i += 1
    return repeated / size


def repetition_shares(top: tuple[tuple[int, float], ...] = TOP_NGRAMS, duplicate: tuple[tuple[int, float], ...] = DUPLICATE_NGRAMS):
    """An Arrow function from a text to the shares of its most frequent and of its repeated n-grams."""
    fields = [*(f"top_{n} double" for n, _ in top), *(f"duplicate_{n} double" for n, _ in duplicate)]

    @pandas_udf(", ".join(fields))
    def shares(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = text.split() if text else []
            size = max(1, len(text) if text else 0)
            rows.append([*(_top_share(found, n, size) for n, _ in top), *(_duplicate_share(found, n, size) for n, _ in duplicate)])
        return pd.DataFrame(rows, columns=[f.split()[0] for f in fields])

    return shares


def repetition_reason(
    text: Column, duplicate_lines: float = 0.3, top=TOP_NGRAMS, duplicate=DUPLICATE_NGRAMS, ls: Column | None = None, shares: Column | None = None
) -> Column:
    """The first repetition rule that a text breaks, or null; null texts break none. ``shares`` are those of its n-grams, where they are at hand."""
    shares = repetition_shares(top, duplicate)(text) if shares is None else shares
    rules = [("duplicate_lines", line_statistics(text, ls=ls)["duplicate_lines"] > duplicate_lines)]
    rules += [(f"top_{n}_gram", shares[f"top_{n}"] > limit) for n, limit in top]
    rules += [(f"duplicate_{n}_grams", shares[f"duplicate_{n}"] > limit) for n, limit in duplicate]
    return first_reason(rules)


def paragraph_statistics(text: Column) -> dict[str, Column]:
    """Shares of paragraphs, and of their characters, that are copies of another one in the text; paragraphs stand between blank lines."""
    found = F.filter(F.split(F.coalesce(text, F.lit("")), r"\n{2,}"), lambda x: F.length(strip(x)) > 0)
    return {
        "duplicate_paragraphs": bound(found, lambda ps: ratio(F.size(ps) - F.size(F.array_distinct(ps)), F.size(ps))),
        "duplicate_paragraph_chars": bound(found, lambda ps: ratio(sum_of(ps, F.length) - sum_of(F.array_distinct(ps), F.length), sum_of(ps, F.length))),
    }


def paragraph_reason(text: Column, paragraphs: float = 0.0, characters: float = 0.0) -> Column:
    """The first paragraph rule that a text breaks, or null; a limit of 0 switches its rule off."""
    s = paragraph_statistics(text)
    rules = [(name, s[name] > limit) for name, limit in (("duplicate_paragraphs", paragraphs), ("duplicate_paragraph_chars", characters)) if limit]
    return first_reason(rules) if rules else F.lit(None).cast("string")


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, or null; a null condition doesn't hold."""
    return F.coalesce(*(F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules))


def quality_reasons(df: DataFrame, text: str, repetition: bool = True, **limits) -> DataFrame:
    """``df`` with ``reason``, the first broken rule in the order repetition, lines, words; null for rows to keep.

    The statistics of removed rows need no other pass: they are counts of the reasons.
    """
    column = F.col(text)
    # Words, lines and shares are columns of a step of their own, so that no rule works them out again.
    rows = df.withColumn("_w", words(column)).withColumn("_l", lines(column))
    if repetition:
        rows = rows.withColumn("_shares", repetition_shares()(column))
    w, ls = F.col("_w"), F.col("_l")
    rules = [repetition_reason(column, ls=ls, shares=F.col("_shares"))] if repetition else []
    rules += [line_reason(column, w=w, ls=ls), word_reason(column, w=w, ls=ls, **limits)]
    return rows.withColumn("reason", F.coalesce(*rules)).drop("_w", "_l", "_shares")


def quality_chain(
    df: DataFrame, text: str, languages: Iterable[str], score: str = "language_score", least_score: float = 0.65, detect: Callable[[Column, Iterable[str]], Column] = in_guessed_language,
    tokens: Callable[[Column], Column] | None = None, symbols: tuple[str, ...] = ("|",), **limits,
) -> DataFrame:
    """``df`` with ``language_scores``, ``reason``, the cleaned text and ``token_count``: the whole chain of web pages in one pass.

    In this order: language by ``detect``, labels with their scores, least score, repetition, lines, words; then, for the
    rows that broke no rule, repair, masking, lines of symbols, and the number of tokens by ``tokens``. ``reason`` is the
    first rule that a row breaks, null for rows to keep; these are ``where("reason IS NULL")``, the others are rejected
    as they came. What a row breaks early spares it the dearer steps.
    """
    column = F.col(text)
    early = first_reason([("language", ~detect(column, languages)), ("language_score", ~F.coalesce(F.col(score) >= least_score, F.lit(False)))])
    labelled = with_language_scores(df, text).withColumn("_early", early).withColumn("_text", F.when(early.isNull(), column))
    judged = quality_reasons(labelled, "_text", **limits)
    reason = F.coalesce(F.col("_early"), F.col("reason"))
    cleaned = without_symbol_lines(masked(repair_text(F.when(reason.isNull(), column))), symbols)
    made = judged.withColumn("reason", reason).withColumn("_text", cleaned)
    count = tokens(F.col("_text")) if tokens else F.size(words(F.col("_text"))).cast("bigint")
    made = made.withColumn("token_count", F.when(F.col("reason").isNull(), count))
    return made.withColumn(text, F.coalesce(F.col("_text"), column)).drop("_early", "_text")


def reason_counts(df: DataFrame, *by: str, reason: str = "reason") -> DataFrame:
    """Rows and share of each reason, of the kept too, in each group."""
    return df.groupBy(*by, reason).agg(F.count("*").alias("rows"))


def _host_and_parents(url: Column) -> Column:
    """The host of an address and the domains above it."""
    host = F.regexp_replace(F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.\-]*://)?([^/?#:]+)", 1), r"^www\.", "")
    return bound(F.split(host, r"\."), lambda parts: F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))


def url_reason(
    url: Column, domains: Iterable[str] = (), words_: Iterable[str] = (), soft_words: Iterable[str] = (), least_soft: int = 2, subwords: Iterable[str] = ()
) -> Column:
    """Why an address is blocked: its domain or a parent of it, a banned word in it, at least ``least_soft`` soft words, or a banned part of a word; null if not.

    The lists stand in the plan; long ones of domains are tables, for ``with_blocked_domains``.
    """
    low = F.lower(url)
    tokens = F.split(low, r"[^a-z0-9]+")
    blocked = F.arrays_overlap(_host_and_parents(url), F.array(*map(F.lit, sorted(domains)))) if domains else F.lit(False)
    banned = F.arrays_overlap(tokens, F.array(*map(F.lit, sorted(words_)))) if words_ else F.lit(False)
    soft = F.size(F.array_intersect(tokens, F.array(*map(F.lit, sorted(soft_words))))) >= least_soft if soft_words else F.lit(False)
    part = F.regexp_like(low, F.lit("|".join(rf"\Q{w}\E" for w in sorted(subwords)))) if subwords else F.lit(False)
    return first_reason([("domain", blocked), ("banned_word", banned), ("soft_words", soft), ("subword", part)])


def with_blocked_domains(df: DataFrame, key: str, url: str, blocked: DataFrame, domain: str = "domain", name: str = "blocked") -> DataFrame:
    """``df`` with whether the host of its address, or a domain above it, is in the table ``blocked``, of any size; null addresses aren't.

    Keys and domains alone are joined; Spark leaves the table where it is or broadcasts it, by its measured size.
    """
    hosts = df.where(F.col(url).isNotNull()).select(F.col(key).alias("_key"), F.explode(_host_and_parents(F.col(url))).alias("_domain"))
    found = hosts.join(blocked.select(F.lower(F.col(domain)).alias("_domain")).distinct(), "_domain", "left_semi").select("_key").distinct()
    marked = found.withColumn("_found", F.lit(True))
    return df.join(marked, F.col(key) == F.col("_key"), "left").withColumn(name, F.coalesce("_found", F.lit(False))).drop("_key", "_found")


def with_domain_config(df: DataFrame, config: DataFrame, key: str) -> DataFrame:
    """``df`` with its limits from a table of one row for each value of ``key``, so that all languages run in one job.

    The table is small; whether it is broadcast is left to its measured size.
    """
    return df.join(config, key, "left")
