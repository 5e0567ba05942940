"""Removal of sequences that share a run of ids, or a run with one exchange, with reference sequences."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bloom import Bloom, bloom_of, mixed, run_hashes
from ..functions.checkpoints import checkpoint
from ..functions.text import bound


def check_lengths(least: int, most: int, most_exchanged: int) -> None:
    """An error unless 1 <= least <= most and least <= most_exchanged."""
    if not 1 <= least <= most or most_exchanged < least:
        raise ValueError("lengths must satisfy 1 <= least <= most and least <= most_exchanged")


def inner(ids: Column) -> Column:
    """A sequence without its first and last id."""
    return F.slice(ids, 2, F.greatest(F.size(ids) - 2, F.lit(0)))


def reference_sequences(references: DataFrame, ids: str, least: int) -> DataFrame:
    """Distinct sequences of more than ``least + 1`` ids, without their ends."""
    return references.where(F.size(ids) > least + 1).select(inner(F.col(ids)).alias("ids")).distinct()


def windows(ids: Column, least: int) -> Column:
    """All runs of ``least`` ids; null if there are fewer."""
    return _at_each(ids, least, lambda w, i: F.slice(w, i, F.lit(least)))


def _at_each(ids: Column, least: int, made) -> Column:
    """``made(ids, i)`` for the place ``i``, from 1, of every run of ``least`` ids; null if there are fewer."""
    return bound(ids, lambda w: F.when(F.size(w) >= least, F.transform(F.sequence(F.lit(1), F.size(w) - (least - 1)), lambda i: made(w, i))))


def _numbers(df: DataFrame, ids: str) -> Column:
    """The sequence as 64-bit numbers: whole numbers as they are, other values by their hash; nulls are a number too."""
    kind = df.schema[ids].dataType.elementType.typeName()
    number = (lambda x: x.cast("bigint")) if kind in ("byte", "short", "integer", "long") else F.xxhash64
    return F.transform(F.col(ids), lambda x: F.when(x.isNull(), F.lit(-(2**63))).otherwise(number(x)))


def _halves(least: int, exchange: bool) -> list[tuple[int, int]]:
    """First id and size of the parts of a run of which one must be unchanged."""
    return [(0, least // 2), (least // 2, least - least // 2)] if exchange else [(0, least)]


_FILTERS: dict[int, Bloom] = {}


def suspect_runs(df: DataFrame, key: str, numbers: str, packed: bytes, parts: list[tuple[int, int]], least: int) -> DataFrame:
    """``key, w``: the runs of ``least`` numbers of which a part may be a reference's, by the filter ``packed``; one pass, no shuffle."""
    kind = df.schema[key].dataType.simpleString()
    token = zlib.crc32(packed)

    def find(batches):
        if token not in _FILTERS:
            _FILTERS.clear()
            _FILTERS[token] = Bloom(packed)
        known = _FILTERS[token]
        for batch in batches:
            lists = batch.column(1)
            # A null list has the offsets of an empty one.
            ends, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
            n = len(values) - least + 1
            if n <= 0:
                continue
            spread = mixed(values)
            hit = np.zeros(n, dtype=bool)
            for seed, (first, size) in enumerate(parts):
                hit |= known.contains(run_hashes(spread, size, seed)[first : first + n])
            at = np.flatnonzero(hit)
            row = np.searchsorted(ends, at, side="right") - 1
            inside = (row >= 0) & (row < len(lists))
            at, row = at[inside], row[inside]
            whole = at + least <= ends[row + 1]
            at, row = at[whole], row[whole]
            if len(at):
                runs = np.lib.stride_tricks.sliding_window_view(values, least)[at]
                made = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * least), pa.array(runs.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), made], names=[key, "w"])

    return df.select(key, numbers).mapInArrow(find, f"`{key}` {kind}, w array<bigint>")


def contaminated_keys(df: DataFrame, key: str, ids: str, references: DataFrame, reference_ids: str, least: int, exchange: bool = False) -> DataFrame:
    """``key`` of the sequences that have a run of ``least`` ids in common with a reference, with ``exchange`` also with one id exchanged.

    Longer runs need no look: a sequence with a longer run in common has one of ``least`` ids in common. Two runs with
    one exchange agree in their left or in their right half. A filter of fixed size over the references' runs, or their
    halves, leaves few runs of the sequences, found in one pass over them; these are joined by the parts' hashes and compared whole.
    Sequences of fewer ids are clean, and without references all are. Whether the references' runs are broadcast is
    left to their measured size.
    """
    refs = reference_sequences(references.select(_numbers(references, reference_ids).alias(reference_ids)), reference_ids, least)
    if exchange and least == 1:
        return df.where(F.size(ids) > 0).select(key).distinct() if not refs.isEmpty() else df.select(key).limit(0)
    refs = checkpoint(refs)
    parts = _halves(least, exchange)

    def of_parts(spread):
        whole = len(spread) - least + 1
        return [run_hashes(spread, size, seed)[first : first + max(0, whole)] for seed, (first, size) in enumerate(parts)]

    packed = bloom_of(refs, "ids", of_parts)
    own = suspect_runs(df.select(key, _numbers(df, ids).alias("_numbers")), key, "_numbers", packed, parts, least).distinct()
    runs = refs.select(F.explode(windows(F.col("ids"), least)).alias("r")).distinct()

    def by_part(w: str) -> Column:
        return F.explode(F.array(*(F.xxhash64(F.lit(seed), F.slice(w, first + 1, size)) for seed, (first, size) in enumerate(parts)))).alias("h")

    met = own.select(key, "w", by_part("w")).join(runs.select("r", by_part("r")), "h")
    off = F.aggregate(F.zip_with("w", "r", lambda a, b: (a != b).cast("int")), F.lit(0), lambda s, x: s + x)
    return met.where(off <= (1 if exchange else 0)).select(key).distinct()


def decontaminated(df: DataFrame, key: str, ids: str, references: DataFrame, reference_ids: str, least: int, exchange: bool = False, removed: bool = False) -> DataFrame:
    """Rows of ``df`` that aren't contaminated, or with ``removed`` those that are."""
    bad = contaminated_keys(df, key, ids, references, reference_ids, least, exchange)
    return df.join(bad, key, "left_semi" if removed else "left_anti")


def decontamination_totals(df: DataFrame, kept: DataFrame, tokens: str) -> DataFrame:
    """``original, removed, tokens``: rows before, rows taken out, and the tokens of what is left; null counts are 0."""
    sides = df.select(F.lit(True).alias("_before"), F.lit(0).cast("bigint").alias("_n")).unionByName(kept.select(F.lit(False).alias("_before"), F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)).alias("_n")))
    made = sides.agg(F.count_if("_before").alias("original"), F.count_if(~F.col("_before")).alias("_kept"), F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("tokens"))
    return made.select("original", (F.col("original") - F.col("_kept")).alias("removed"), "tokens")
