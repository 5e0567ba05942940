"""Tokens of each document and of each slice of a corpus."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import DEFAULT_VOCABULARY, encoder, independent_chunks, vocabulary_path
from .common import column, map_batches, raw, string_column
from .lang import language_code

#: Texts of more characters are cut at independent boundaries and their chunks spread over the workers.
CHUNK_CHARS = 1 << 16
#: Characters of pieces that a batch holds.
HELD_CHARS = 1 << 24


def token_counts(
    df: DataFrame, key: str, text: str, vocabulary: str | None = None, chunk_chars: int = CHUNK_CHARS, carry: dict[str, F.Column] | None = None
) -> DataFrame:
    """``key, tokens`` with one row for each key: the exact number of tokens of its text.

    Texts of up to ``chunk_chars`` characters are counted where they lie. Larger ones are cut, in the same pass, where
    the tokenizer provably starts anew; the pieces are salted over the workers, counted and added up. Null and empty
    texts have 0 tokens. Rows that share a key are taken as one row delivered again; of differing texts the one with
    most tokens counts, whatever its length. A null key is a key. ``carry`` names string columns to add, the least value
    of a key's rows.
    """
    path = vocabulary or vocabulary_path(DEFAULT_VOCABULARY)
    carry = carry or {}
    kind = df.schema[key].dataType.simpleString()
    kept = [key, *carry, "_hash"]
    fields = ", ".join([f"`{key}` {kind}", *(f"`{c}` string" for c in carry), "_hash bigint", "_salt int"])
    source = df.select(F.col(f"`{key}`").alias(key), *(c.cast("string").alias(n) for n, c in carry.items()), F.xxhash64(string_column(text)).alias("_hash"), string_column(text).alias("_text"))

    def made(batch, at, salts, texts, tokens):
        rows = pa.array(at, pa.int32())
        return pa.RecordBatch.from_arrays([*(raw(batch, c).take(rows) for c in kept), pa.array(salts, pa.int32()), pa.array(texts, pa.string()), pa.array(tokens, pa.int64())], names=[*kept, "_salt", "_text", "tokens"])

    def count(batch):
        tokens = encoder(path).count
        at, salts, texts, counted, held = [], [], [], [], 0
        for row, value in enumerate(column(batch, "_text")):
            if value is None or len(value) <= chunk_chars:
                at.append(row), salts.append(0), texts.append(None), counted.append(tokens(value) if value else 0)
                continue
            for salt, chunk in enumerate(independent_chunks(value, chunk_chars)):
                at.append(row), salts.append(salt), texts.append(chunk), counted.append(None)
                held += len(chunk)
                if held > HELD_CHARS:
                    yield made(batch, at, salts, texts, counted)
                    at, salts, texts, counted, held = [], [], [], [], 0
        yield made(batch, at, salts, texts, counted)

    def count_pieces(batch):
        tokens = encoder(path).count
        counted = [n if t is None else tokens(t) for t, n in zip(column(batch, "_text"), column(batch, "tokens"))]
        return pa.RecordBatch.from_arrays([*(raw(batch, c) for c in kept), raw(batch, "_salt"), pa.array(counted, pa.int64())], names=[*kept, "_salt", "tokens"])

    least = [F.min(c).alias(c) for c in carry]
    spread = map_batches(source, count, f"{fields}, _text string, tokens bigint").repartition(F.col(key), F.col("_salt"))
    pieces = map_batches(spread, count_pieces, f"{fields}, tokens bigint").groupBy(key, "_hash", "_salt").agg(F.max("tokens").alias("tokens"), *least)
    whole = pieces.repartition(F.col(key)).groupBy(key, "_hash").agg(F.sum("tokens").alias("tokens"), *least)
    return whole.groupBy(key).agg(F.max("tokens").alias("tokens"), *least)


def slice_value(name: str, domain: bool = False) -> F.Column:
    """A slice's value with its spelling variants taken as one: trimmed, lower case, domains without ``www.``; null if blank."""
    value = F.lower(F.regexp_replace(string_column(name), r"(?U)^\s+|\s+$", ""))
    if domain:
        value = F.regexp_replace(value, r"^www\.", "")
    return F.nullif(value, F.lit(""))


def token_budget(df: DataFrame, key: str, text: str, vocabulary: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``slice, value, documents, tokens``: totals by source, language and domain and of all, each key counted once.

    A null or blank value is a slice of its own, with null as its value; languages that name none are null too. The
    counts are added up before they are shuffled, so that a slice with most rows is no burden.
    """
    labels = {
        "source": slice_value("source"),
        "language": language_code(string_column("language")),
        "domain": slice_value("domain", domain=True),
    }
    rows = token_counts(df, key, text, vocabulary, chunk_chars, labels).select(
        F.explode(
            F.array(
                *(F.struct(F.lit(s).alias("slice"), F.col(s).alias("value")) for s in labels),
                F.struct(F.lit("all").alias("slice"), F.lit(None).cast("string").alias("value")),
            )
        ).alias("at"),
        "tokens",
    )
    return rows.groupBy(F.col("at.slice").alias("slice"), F.col("at.value").alias("value")).agg(
        F.count("*").alias("documents"), F.sum("tokens").alias("tokens")
    )
