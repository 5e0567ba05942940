"""Spreading of small tables over all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df``, just read, over as many partitions as there are cores if it is a single file.

    A file of one row group is read by one task, however dear the work on its rows. Tables of several files are read by
    as many tasks and stay where they are, however many cores there are.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if len(df.inputFiles()) == 1 else df
