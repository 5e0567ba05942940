"""The test tables as the queries read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.partitions import spread


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def texts(spark: SparkSession, root: str, name: str = "documents") -> DataFrame:
    """A table whose texts take more time than their reading."""
    return spread(read(spark, root, name))


def conversations(spark: SparkSession, root: str) -> DataFrame:
    """Each conversation once; a row delivered again differs in its time of delivery alone."""
    return texts(spark, root, "conversations").dropDuplicates(["conv_id"])


def dataset(spark: SparkSession, root: str) -> DataFrame:
    """Each row once. For columns of fixed width alone; what needs the text works on the rows as delivered and puts its results together."""
    return read(spark, root, "dataset").dropDuplicates(["id"])


def answers(spark: SparkSession, root: str) -> DataFrame:
    """``conv_id, turn, text`` of the assistants' contents, as delivered: rows that came twice are there twice."""
    rows = texts(spark, root, "conversations").select("conv_id", F.posexplode("messages").alias("turn", "m"))
    return rows.where(F.lower(F.trim(F.col("m.role"))).isin("assistant", "gpt") & F.col("m.content").isNotNull()).select("conv_id", "turn", F.col("m.content").alias("text"))
