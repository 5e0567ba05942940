"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.partitions import spread


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Table ``name`` below ``root``, one parquet file or a folder of them; a table of a single small file is spread over all cores."""
    return spread(spark.read.parquet(f"{root}/{name}.parquet"))


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` over ``df``: ``function`` turns one record batch into one record batch or a list of them."""

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            made = function(batch)
            if isinstance(made, pa.RecordBatch):
                yield made
            else:
                yield from made

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> list:
    """A column of the batch as Python values."""
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def raw(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def string_column(name: str) -> F.Column:
    """Column ``name`` as a string, so that the operators accept any type in it."""
    return F.col(f"`{name}`").cast("string")
