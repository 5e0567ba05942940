"""Writing: chunks of named files, subsets, rejected rows, appending with running totals."""

from __future__ import annotations

import logging
import os
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import files
from ..functions.checkpoints import checkpoint
from ..functions.ranks import exact_ranks
from ..operators.routing import subset_totals
from ..operators.splits import array_split, chunk_count, greedy_chunks
from .loaders import read_sidecar, write_sidecar

_LOG = logging.getLogger(__name__)
KEPT_KEYS = ("text", "id", "url", "date", "language", "language_score", "source", "file_path", "token_count")


def _rename(folder: str, into: str, names: list[str], ending: str) -> None:
    """Move the one file of each chunk's folder to its name."""
    for number, name in enumerate(names):
        parts = files.listing(files.join(folder, f"_chunk={number}"), "part-*")
        if len(parts) != 1:
            raise RuntimeError(f"chunk {number} has {len(parts)} files")
        files.move(parts[0], files.join(into, f"{name}.{ending}"))
    files.remove(folder)


def _staged(df: DataFrame, folder: str, by: str, kind: str) -> str:
    """Write ``df`` once, by the values of ``by``, into a folder of its own beside the others; its path."""
    hidden = files.join(folder, f"_writing-{uuid.uuid4().hex}")
    writer = df.write.mode("error").partitionBy(by)
    (writer.parquet if kind == "parquet" else writer.option("ignoreNullFields", "false").json)(hidden)
    return hidden


def save_chunks(df: DataFrame, folder: str, kind: str, order: str, tokens: int, per_chunk: int, chunks: int | None = None, single: str | None = None) -> int:
    """Write ``df`` in contiguous chunks of nearly equal rows, ``train-00000-of-00003`` and so on; the number of files.

    There are as many chunks as ``tokens`` asks for, or ``chunks``, but no more than rows; an empty table writes nothing.
    ``single`` names the only file of a single chunk.
    """
    rows = df.count()
    if rows == 0:
        return 0
    n = min(rows, chunks or chunk_count(tokens, per_chunk))
    files.make_folder(folder)
    marked = array_split(df, order, n, "_chunk").repartition(n, "_chunk").sortWithinPartitions("_chunk", order)
    hidden = files.join(folder, "_writing")
    writer = marked.write.mode("overwrite").partitionBy("_chunk")
    (writer.parquet if kind == "parquet" else writer.json)(hidden)
    names = [single] if single and n == 1 else [f"train-{i:05d}-of-{n:05d}" for i in range(n)]
    _rename(hidden, folder, names, "parquet" if kind == "parquet" else "jsonl")
    return n


def write_routed(df: DataFrame, folder: str, kind: str = "parquet", tokens: str | None = "token_count", dropped: int | None = None) -> DataFrame:
    """Write each subset into the folder of its name, with a sidecar of its totals; the totals. One schema holds for all subsets.

    The table is worked out once: it is written aside, counted as it was written, and its files are moved into place.
    """
    spark = df.sparkSession
    hidden = _staged(df, folder, "subset", kind)
    written = (spark.read.parquet if kind == "parquet" else spark.read.schema(df.schema).json)(hidden).withColumn("subset", F.col("subset").cast("string"))
    totals = checkpoint(subset_totals(written, tokens))
    for row in totals.toLocalIterator():
        name = row["subset"]
        target = files.join(folder, str(name))
        files.make_folder(target)
        for part in files.listing(files.join(hidden, f"subset={name}"), "part-*"):
            files.move(part, files.join(target, os.path.basename(part)))
        write_sidecar(files.join(target, ".metadata"), {"documents": row["documents"], "tokens": row["tokens"], **({"filtered": dropped} if dropped is not None else {})})
    files.remove(hidden)
    return totals


def write_kept_and_rejected(df: DataFrame, keep: str, kept: str, rejected: str) -> None:
    """Write rows to keep and all others, those of a null mark among them, into two folders; the rows are worked out once."""
    good = F.coalesce(F.col(keep), F.lit(False)).cast("int").alias("_kept")
    parent = os.path.dirname(kept.rstrip("/"))
    hidden = _staged(df.select(*(c for c in df.columns if c != keep), good), parent, "_kept", "parquet")
    for mark, target in ((1, kept), (0, rejected)):
        files.remove(target)
        files.make_folder(target)
        for part in files.listing(files.join(hidden, f"_kept={mark}"), "part-*"):
            files.move(part, files.join(target, os.path.basename(part)))
        if not files.listing(target, "part-*"):
            df.sparkSession.createDataFrame([], df.drop(keep).schema).write.mode("overwrite").parquet(target)
    files.remove(hidden)


def known_keys(df: DataFrame, keys: tuple[str, ...] = KEPT_KEYS) -> DataFrame:
    """The columns of ``keys`` that there are, timestamps as ISO text."""
    return df.select(*(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if dict(df.dtypes)[c].startswith("timestamp") else F.col(c) for c in keys if c in df.columns))


def append_with_totals(df: DataFrame, folder: str, by: str, tokens: str = "token_count") -> None:
    """Append the rows of each value of ``by`` to its folder as JSON, and add them to the totals in its sidecar; values without rows get none.

    The table is worked out once; what was written is what is counted.
    """
    hidden = _staged(df, folder, by, "json")
    count = F.sum(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint")))
    written = df.sparkSession.read.schema(df.schema).json(hidden)
    for row in checkpoint(written.groupBy(F.col(by).cast("string").alias(by)).agg(F.count("*").alias("n"), count.alias("t"))).toLocalIterator():
        target = files.join(folder, f"{by}={row[by]}")
        files.make_folder(target)
        for part in files.listing(files.join(hidden, f"{by}={row[by]}"), "part-*"):
            files.move(part, files.join(target, os.path.basename(part)))
        path = files.join(target, ".metadata")
        old = read_sidecar(path) or {}
        write_sidecar(path, {"documents": old.get("documents", 0) + row["n"], "tokens": old.get("tokens", 0) + row["t"]})
    files.remove(hidden)


def size_chunks(size: int, most: int, ratio: float = 1.0) -> int:
    """Files for so many bytes that shrink by ``ratio``, one at least."""
    return max(1, -(-int(size * ratio) // most))


def convert_to_parquet(spark: SparkSession, paths: list[str], folder: str, most_bytes: int, ratio: float = 0.25) -> int:
    """Write files of JSON lines as Parquet files ``train-00000-of-00003`` and so on, as many as their size asks for; the number of files.

    ``ratio`` is what their bytes shrink to. Rows keep the files' order by name; one broken line is a null row's worth and is left out.
    """
    n = size_chunks(sum(map(files.size_of, paths)), most_bytes, ratio)
    read = spark.read.json(sorted(paths), mode="DROPMALFORMED")
    ordered = read.select("*", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_order"))
    hidden = files.join(folder, "_writing")
    files.make_folder(folder)
    ordered.repartitionByRange(n, "_order").sortWithinPartitions("_order").drop("_order").write.mode("overwrite").parquet(hidden)
    parts = files.listing(hidden, "part-*")
    for i, part in enumerate(parts):
        files.move(part, files.join(folder, f"train-{i:05d}-of-{len(parts):05d}.parquet"))
    files.remove(hidden)
    return len(parts)


def append_rows(df: DataFrame, folder: str) -> None:
    """Append rows as JSON lines, null fields written too."""
    df.write.mode("append").option("ignoreNullFields", "false").json(folder)


def split_file(spark: SparkSession, path: str, most_tokens: int, least_bytes: int, tokens: str = "token_count") -> bool:
    """Split a file of JSON lines larger than ``least_bytes`` into ``<name>-chunk-00000`` and so on of up to ``most_tokens`` tokens; whether it was.

    Chunks are closed greedily in the order of the lines. The file is removed once all chunks are there; if writing
    fails, the chunks are, and the file stays. Lines without a count have 0 tokens; files that are chunks stay whole.
    """
    stem, ending = os.path.splitext(path)
    if files.size_of(path) <= least_bytes or "-chunk-" in os.path.basename(path):
        return False
    hidden = f"{stem}.writing"
    try:
        # The start of a block and the place of a row in its task order the lines of a file, as they are read.
        read = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
        count = F.coalesce(F.try_variant_get(F.try_parse_json("value"), f"$.{tokens}", "bigint"), F.lit(0).cast("bigint"))
        lines = checkpoint(read.select("value", F.struct("_block", "_row").alias("_at"), count.alias("_n"), F.lit("f").alias("_file")))
        numbered = exact_ranks(lines, ["_file"], ["_at"], name="_place")
        chunks = greedy_chunks(numbered, "_file", "_place", "_n", most_tokens, "_chunk").drop("_file")
        marked = numbered.join(chunks, "_place").select("value", "_place", "_chunk")
        n = chunks.agg(F.max("_chunk")).first()[0] + 1
        marked.repartition(n, "_chunk").sortWithinPartitions("_chunk", "_place").select("value", "_chunk").write.mode("overwrite").partitionBy("_chunk").text(hidden)
        _rename(hidden, os.path.dirname(path), [f"{os.path.basename(stem)}-chunk-{i:05d}" for i in range(n)], ending.removeprefix("."))
    except (OSError, RuntimeError, PySparkException) as error:
        _LOG.warning("%s stays whole: %s", path, error)
        files.remove(hidden)
        for part in files.listing(os.path.dirname(path), f"{os.path.basename(stem)}-chunk-*{ending}"):
            files.remove(part)
        return False
    files.remove(path)
    return True
