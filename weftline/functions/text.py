"""Column expressions on text: white space, words, lines, sentences and n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word character in any script, as the reference engines of other languages define it.
WORD = r"[\p{L}\p{M}\p{N}_]"


def strip(text: Column) -> Column:
    """``text`` without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    """True for null, empty and all-space texts."""
    return F.coalesce(F.length(strip(text)) == 0, F.lit(True))


def words(text: Column) -> Column:
    """Runs of characters that are no white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def word_tokens(text: Column) -> Column:
    """Runs of word characters."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD}+)"), 1)


def lines(text: Column) -> Column:
    """Lines that aren't blank."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(strip(x)) > 0)


def sentences(text: Column) -> Column:
    """Parts that end in sentence punctuation before white space, and the rest."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)(?<=[.!?।…])\s+"), lambda x: F.length(strip(x)) > 0)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often and in whatever lambda ``use`` has it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ngrams(items: Column, n: int, separator: str = " ") -> Column:
    """All runs of ``n`` items, joined; none if there are fewer."""
    return bound(
        items,
        lambda w: F.when(
            F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, F.lit(n)), separator))
        ).otherwise(F.array().cast("array<string>")),
    )


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0 where ``whole`` is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def sum_of(items: Column, value) -> Column:
    """Sum of ``value(item)`` over an array, as a bigint."""
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + value(x).cast("bigint"))
