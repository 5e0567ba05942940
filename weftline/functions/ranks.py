"""Exact ranks of all rows by a range-partitioned sort with partition offsets.

Rows are range-partitioned and sorted on (group, order), so a group, however large, spreads over as many partitions as
its share of the rows needs. Each partition counts along its own rows; what earlier partitions hold of a group is its
offset, from a table of one row per partition and group, at most one row per partition more than there are groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .checkpoints import checkpoint


def _encode(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """True where the group differs from that of the row above; the first row counts as new."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[:1] = True
    for name in names:
        codes = pc.dictionary_encode(batch.column(name), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def exact_ranks(df: DataFrame, group: list[str], order: list[str], weight: str | None = None, name: str = "before") -> DataFrame:
    """``df`` with the number of rows (or the sum of ``weight``) before each row in its group, in ``order``.

    ``group`` and ``order`` together must tell the rows apart, else equal rows are counted in any order. Nulls form a
    group of their own and sort first. An empty table stays empty.
    """
    weighted = df if weight else df.withColumn("_one", F.lit(1).cast("long"))
    amount = weight or "_one"
    columns = weighted.columns
    keys = [*group, *order]
    schema = weighted.withColumn("_part", F.lit(0)).withColumn("_here", F.lit(0).cast("long")).schema

    def count(batches):
        carry_key, carry = None, 0
        part = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if part is None:
                from pyspark import TaskContext

                part = TaskContext.get().partitionId()
            new = _encode(batch, group)
            first = tuple(batch.column(g)[0].as_py() for g in group)
            start = carry if first == carry_key else 0
            amounts = batch.column(amount).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.cumsum(amounts)
            begins = np.flatnonzero(new)
            base = np.zeros(batch.num_rows, dtype=np.int64)
            base[begins[1:]] = np.diff(total[begins] - amounts[begins])
            base = np.cumsum(base)
            here = total - amounts - base
            here[: begins[1] if len(begins) > 1 else None] += start
            last = batch.num_rows - 1
            carry_key = tuple(batch.column(g)[last].as_py() for g in group)
            carry = int(here[last] + amounts[last])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(np.full(batch.num_rows, part, dtype=np.int32)), pa.array(here)],
                names=[*columns, "_part", "_here"],
            )

    local = checkpoint(weighted.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(count, schema))
    sums = local.groupBy("_part", *group).agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    renamed = offsets.select(F.col("_part").alias("_p"), *(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), "_offset")
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = local.join(renamed, same, "left")
    kept = [c for c in columns if c != "_one"]
    return joined.select(*kept, (F.col("_here") + F.col("_offset")).alias(name))
