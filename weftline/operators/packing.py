"""Packing of token rows into blocks: end to end, or best fit in decreasing length."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .splits import first_in_order, ranked_keys
from .tokens import IGNORED

#: Columns that are packed, where present, and what fills up each.
PACKED = {"input_ids": 0, "labels": IGNORED, "attention_mask": 0, "assistant_masks": 0}
GROUP_ROWS = 1000


def packed_columns(df: DataFrame) -> list[str]:
    return [c for c in PACKED if c in df.columns]


def with_groups(df: DataFrame, order: str, rows: int = GROUP_ROWS) -> DataFrame:
    """``df`` with ``pack_group``: which run of ``rows`` rows, in ``order``, a row lies in. ``order`` must tell rows apart."""
    ranked = ranked_keys(df, [order]).select(F.col(order).alias("_key"), F.floor(F.col("_before") / rows).cast("bigint").alias("pack_group"))
    return df.join(ranked, F.col(order).eqNullSafe(F.col("_key"))).drop("_key")


def concatenated(df: DataFrame, order: str, block: int, group: str | None = None) -> DataFrame:
    """``group?, block, columns, seq_lengths``: the tokens of all rows, in ``order``, cut into blocks of exactly ``block``.

    The last, shorter block of each group, or of all rows without ``group``, is dropped. Offsets are prefix sums of the
    lengths over range partitions, so no task sees more than its share of the rows.
    """
    columns = packed_columns(df)
    first = columns[0]
    by = [group] if group else []
    sized = df.select(*by, order, *columns, F.size(first).cast("bigint").alias("_size")).where("_size > 0")
    offsets = ranked_keys(sized, [order], by, F.col("_size")).select(*(F.col(c).alias(f"_{c}") for c in by), F.col(order).alias("_key"), F.col("_before").alias("_offset"))
    same = F.col(order).eqNullSafe(F.col("_key"))
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    placed = sized.join(offsets, same)
    pieces = placed.select(
        *by, "_offset", "_size", *columns, F.explode(F.sequence(F.floor(F.col("_offset") / block), F.floor((F.col("_offset") + F.col("_size") - 1) / block))).alias("block")
    )
    start = F.greatest(F.col("block") * block - F.col("_offset"), F.lit(0).cast("bigint"))
    end = F.least((F.col("block") + 1) * block - F.col("_offset"), F.col("_size"))
    cut = pieces.select(*by, "block", (F.col("_offset") + start).alias("_at"), *(F.slice(c, (start + 1).cast("int"), (end - start).cast("int")).alias(c) for c in columns))
    gathered = cut.groupBy(*by, "block").agg(F.sort_array(F.collect_list(F.struct("_at", *columns))).alias("_parts"))
    whole = gathered.select(*by, "block", *(F.flatten(F.col(f"_parts.{c}")).alias(c) for c in columns))
    return whole.where(F.size(first) == block).withColumn("seq_lengths", F.lit(block))


def best_fit(lengths: list[int], block: int) -> list[list[int]]:
    """Rows of each chunk, in the order in which chunks are completed: longest rows first, stable, each into the fullest chunk that takes it."""
    done: list[list[int]] = []
    spaces: list[tuple[int, int]] = []
    chunks: dict[int, list[int]] = {}
    for row in sorted((i for i, n in enumerate(lengths) if 0 < n <= block), key=lambda i: -lengths[i]):
        n = lengths[row]
        if n == block:
            done.append([row])
            continue
        at = bisect_left(spaces, (n, -1))
        if at == len(spaces):
            number, space = len(chunks), block
            chunks[number] = []
        else:
            space, number = spaces.pop(at)
        chunks[number].append(row)
        if space == n:
            done.append(chunks[number])
        else:
            insort(spaces, (space - n, number))
    open_ = {number for _, number in spaces}
    return done + [rows for number, rows in chunks.items() if number in open_]


def best_fit_packed(df: DataFrame, order: str, block: int, group: str = "pack_group", pads: dict[str, int] | None = None) -> DataFrame:
    """``group, block, columns, seq_lengths``: rows put together into blocks of ``block`` tokens, padded, never cut.

    Each group, of a bounded number of rows, is packed on its own. Rows are cut to ``seq_lengths`` where they have it; a
    column that is shorter is an error. Empty rows and rows longer than a block are dropped.
    """
    columns = packed_columns(df)
    pads = {**PACKED, **(pads or {})}
    has_length = "seq_lengths" in df.columns
    size = F.col("seq_lengths") if has_length else F.size(columns[0])
    rows = df.select(F.col(group).cast("bigint").alias(group), order, *columns, size.cast("int").alias("_size"))
    kind = "array<int>"
    schema = ", ".join([f"{group} bigint, block bigint", *(f"{c} {kind}" for c in columns), "seq_lengths int"])

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, kind="stable").reset_index(drop=True)
        lengths = [int(n) if n == n else 0 for n in frame["_size"]]
        for c in columns:
            if any(len(v) < n for v, n in zip(frame[c], lengths)):
                raise ValueError(f"{c} is shorter than its row's seq_lengths")
        made = []
        for number, members in enumerate(best_fit(lengths, block)):
            row = {group: frame[group].iloc[0], "block": number, "seq_lengths": block}
            for c in columns:
                tokens = [int(t) for m in members for t in frame[c].iloc[m][: lengths[m]]]
                row[c] = tokens + [pads[c]] * (block - len(tokens))
            made.append(row)
        return pd.DataFrame(made, columns=[group, "block", *columns, "seq_lengths"])

    return rows.groupBy(group).applyInPandas(pack, schema)


def capped(df: DataFrame, order: list[str], tokens: int, block: int) -> DataFrame:
    """The first rows, in ``order``, of a budget of ``tokens``: ``tokens // block`` blocks; ``order`` must tell rows apart."""
    return first_in_order(df, order, tokens // block)


def packed_in_groups(df: DataFrame, order: str, block: int, how: str = "best_fit", rows: int = GROUP_ROWS) -> DataFrame:
    """Packing per run of ``rows`` rows: each group stands alone, so the result doesn't depend on the partitions."""
    if how not in ("best_fit", "concatenate"):
        raise ValueError("how must be best_fit or concatenate")
    grouped = with_groups(df, order, rows)
    return best_fit_packed(grouped, order, block) if how == "best_fit" else concatenated(grouped, order, block, "pack_group")
