"""Routing of documents into subsets: parsers, stratification, names, counts."""

from __future__ import annotations

import importlib.util
import json
import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

Parser = Callable[[DataFrame], DataFrame]


def document_row(df: DataFrame, metadata: str = "metadata") -> DataFrame:
    """``text``, ``id`` and the fields of a struct of metadata, which win over them where names clash."""
    fields = df.schema[metadata].dataType.fieldNames()
    return df.select(*(c for c in ("text", "id") if c in df.columns and c not in fields), f"{metadata}.*")


def subset_name(value: Column, fallback: str) -> Column:
    """A value as a folder's name: trimmed, with _ for /; ``fallback`` for null and blank values."""
    clean = strip(value.cast("string"))
    return F.coalesce(F.when(clean != "", F.replace(clean, F.lit("/"), F.lit("_"))), F.lit(fallback))


def stratified(df: DataFrame, column: str, fallback: str = "unknown") -> DataFrame:
    """``df`` with ``subset`` from the values of a column."""
    return df.withColumn("subset", subset_name(F.col(column), fallback))


def least_score(df: DataFrame, column: str, least: float) -> DataFrame:
    """Rows with a score of at least ``least``; null scores are dropped."""
    return df.where(F.col(column) >= least)


def with_uuid(df: DataFrame, name: str = "uuid") -> DataFrame:
    """``df`` with a random identifier."""
    return df.withColumn(name, F.uuid())


def row_parser(parse: Callable[[dict], object], schema: str, default: str) -> Parser:
    """A parser from a function on rows: null drops a row, a name routes it, (name, row) replaces it, a dict updates or, with ``row``, replaces it."""

    def run(batches):
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                result = parse(row)
                if result is None:
                    continue
                if isinstance(result, str):
                    made.append({**row, "subset": result})
                elif isinstance(result, tuple) and len(result) == 2:
                    made.append({**result[1], "subset": result[0]})
                elif isinstance(result, dict):
                    base = result["row"] if "row" in result else {**row, **{k: result[k] for k in ("text", "id") if k in result}, **(result.get("metadata") or {})}
                    made.append({**base, "subset": result.get("subset", default)})
                else:
                    raise TypeError(f"a parser can't give {type(result).__name__}")
            if made:
                yield pa.RecordBatch.from_pylist(made)

    return lambda df: df.mapInArrow(run, schema)


def load_config(value: str | None) -> dict:
    """Options of a parser, from a JSON string or a file of one."""
    if not value:
        return {}
    if os.path.exists(value):
        with open(value, encoding="utf-8") as f:
            value = f.read()
    made = json.loads(value)
    if not isinstance(made, dict):
        raise ValueError("the options must be a JSON object")
    return made


def load_parser(path: str, config: dict) -> Parser:
    """The parser that a plug-in file makes: its ``make_parser(config)``."""
    spec = importlib.util.spec_from_file_location("weftline_parser", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.make_parser(config)


def routed(df: DataFrame, parser: Parser | None = None, stratify: str | None = None, default: str = "default") -> DataFrame:
    """Rows with ``subset``: first the parser's, then, for rows that it kept, the value of ``stratify``, which wins."""
    rows = parser(df) if parser else df
    if stratify:
        return stratified(rows, stratify, default)
    return rows if "subset" in rows.columns else rows.withColumn("subset", F.lit(default))


def subset_totals(df: DataFrame, tokens: str | None = "token_count") -> DataFrame:
    """``subset, documents, tokens``; null counts are 0."""
    count = F.sum(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint"))) if tokens else F.lit(0).cast("bigint")
    return df.groupBy("subset").agg(F.count("*").alias("documents"), count.alias("tokens"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column that aren't null, in the order of their text."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(F.col(column).cast("string"))


def require_columns(df: DataFrame, *names: str) -> None:
    """An error that names the columns there are, unless all of ``names`` are among them."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {df.columns}")
