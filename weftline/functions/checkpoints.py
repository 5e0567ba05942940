"""Reliable checkpoints in the shared folder of the session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names in ``spark.checkpoint.dir``; in local mode only, make one where it is unset."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isEmpty():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="weftline-checkpoints-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint, which survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors share, for tables that are written to be read again."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"
