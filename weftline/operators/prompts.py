"""Prompts, resuming, and rows of generated text; the model itself is a function that is passed in."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reasons of failed runs and the patterns in their logs, in the order in which they are tried, in any case.
FAILURES = (
    ("OOM", r"torch\.OutOfMemoryError.*CUDA out of memory"),
    ("OOM", r"ValueError.*No available memory for the cache blocks"),
    ("OOM", r"OutOfMemoryError"),
    ("OOM", r"CUDA out of memory"),
    ("OOM", r"Failed to load model - not enough GPU memory"),
    ("timeout", r"DUE TO TIME LIMIT"),
    ("server_fail", r"Failed to start VLLMServer server"),
    ("server_fail", r"Server encountered unrecoverable error"),
)
#: The texts that ask for a critique and for a revision.
CRITIQUE = """Review the following response and identify any ways it could be improved to better align with the constitutional principles.

Original user request: {request}

Response to critique:
{response}

Provide specific suggestions for improvement based on the constitution's guidelines for clarity, helpfulness, safety, and honesty. Be concise."""
REVISION = """Based on the following critique, provide an improved response to the original user request.

Original user request: {request}

Original response:
{response}

Critique:
{critique}

Provide the revised response that addresses the critique while following all constitutional principles:"""
TAIL_CHARS = 100_000


def assembled(text: Column, prefix: str = "", suffix: str = "") -> Column:
    """Prefix, text and suffix; null texts count as empty."""
    return F.concat(F.lit(prefix), F.coalesce(text, F.lit("")), F.lit(suffix))


def filled_template(template: str, text: Column, slot: str = "[[DOCUMENT]]") -> Column:
    """``template`` with the text in its slot; an error if it has none."""
    if slot not in template:
        raise ValueError(f"the template has no {slot}")
    return F.replace(F.lit(template), F.lit(slot), F.coalesce(text, F.lit("")))


def completion_text(df: DataFrame, column: str) -> Column:
    """A completion as text, by its schema: a string itself, the first content of messages, else the value as a string; '' for null."""
    kind = df.schema[column].dataType
    if kind.typeName() == "array" and kind.elementType.typeName() == "struct" and "content" in kind.elementType.fieldNames():
        return F.coalesce(F.try_element_at(F.col(column), F.lit(1))["content"], F.lit(""))
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def within_budget(text: Column, context: int, most_tokens: int, margin: int = 512, chars_per_token: int = 3) -> Column:
    """Whether a prompt fits into what the answer leaves of the context, at so many characters a token."""
    return F.length(text) <= (context - most_tokens - margin) * chars_per_token


def within_chunk(df: DataFrame, prompt: str, most_tokens: int, tokens: Callable[[Column], Column]) -> DataFrame:
    """Rows whose prompt, by itself, has at most ``most_tokens`` tokens; longer ones are passed over."""
    return df.where(tokens(F.col(prompt)) <= most_tokens)


def _filled(text: str, **values: Column) -> Column:
    """``text`` with each ``{name}`` replaced by a column, null ones by ''."""
    parts = re.split(r"\{(\w+)\}", text)
    return F.concat(*(F.coalesce(values[p], F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)))


def critique_prompt(request: Column, response: Column) -> Column:
    """The prompt for a critique of a response."""
    return _filled(CRITIQUE, request=request, response=response)


def revision_prompt(request: Column, response: Column, critique: Column) -> Column:
    """The prompt for a revision of a response after its critique."""
    return _filled(REVISION, request=request, response=response, critique=critique)


def shared_prompt(chosen: Column, rejected: Column) -> Column:
    """The longest common run of first messages of two conversations; the prompt of a pair of preferences."""
    n = F.least(F.size(chosen), F.size(rejected))
    differ = F.array_min(
        F.filter(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.when(F.try_element_at(chosen, i) != F.try_element_at(rejected, i), i)), lambda i: i.isNotNull())
    )
    return F.slice(chosen, 1, F.when(n < 1, F.lit(0)).otherwise(F.coalesce(differ - 1, n)))


def failure(log: Column) -> Column:
    """Why a run failed, by its log: the last characters are tried before the first, the first reason that matches wins; null for none."""
    tail, head = F.substring(log, -TAIL_CHARS, TAIL_CHARS), F.substring(log, 1, TAIL_CHARS)
    return F.coalesce(*(F.when(part.rlike(f"(?i){pattern}"), F.lit(name)) for part in (tail, head) for name, pattern in FAILURES))


def next_row(df: DataFrame, row: str = "row", start: int | None = None) -> int:
    """The row to go on with: the one after the largest there is, 0 without rows; ``start`` wins."""
    if start is not None:
        return start
    largest = df.agg(F.max(F.col(row).cast("bigint"))).first()[0]
    return 0 if largest is None else largest + 1


def rollouts(df: DataFrame, prompt: str, generate: Callable[[list[str]], list[list[str]]], keep: list[str], batch: int = 64) -> DataFrame:
    """``keep, prompt, rollouts``: what ``generate`` gives for batches of prompts, in the workers, one batch at a time."""
    fields = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in [*keep, prompt]), "rollouts array<string>"])

    def run(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, batch):
                part = whole.slice(first, batch)
                made = generate([p or "" for p in part.column(prompt).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.list_(pa.string()))], names=[*part.schema.names, "rollouts"])

    return df.select(*keep, prompt).mapInArrow(run, fields)


def one_row_each(df: DataFrame, items: str, name: str) -> DataFrame:
    """A row for each item of an array, with its position."""
    others = [c for c in df.columns if c != items]
    return df.select(*others, F.posexplode(items).alias("position", name))
