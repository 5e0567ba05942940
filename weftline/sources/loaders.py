"""Reading of tables, JSON lines, texts, web archives, logs and sidecars, with an order where it matters."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import files as _files
from ..functions.text import strip
from ..operators.splits import first_in_order, ranked_keys, shuffled

FORMATS = {".jsonl": "json", ".json": "json", ".parquet": "parquet", ".csv": "csv", ".txt": "text"}


def matching_files(folder: str, *patterns: str, recursive: bool = False) -> list[str]:
    """The files of a folder that match any pattern, sorted, each once, on any file system."""
    return _files.listing(folder, *patterns, recursive=recursive)


def discover(path: str, recursive: bool = False) -> tuple[str, list[str]]:
    """Format and files of a path: a file by its ending; of a folder all JSON lines if there are any, else all Parquet files."""
    if _files.is_file(path):
        kind = FORMATS.get(os.path.splitext(path.removesuffix(".gz").removesuffix(".zst"))[1])
        if kind is None:
            raise ValueError(f"{path} has an unknown ending; known are {sorted(FORMATS)}")
        return kind, [path]
    for kind, patterns in (("json", ("*.jsonl", "*.jsonl.gz", "*.jsonl.zst")), ("parquet", ("*.parquet",))):
        files = matching_files(path, *patterns, recursive=recursive)
        if files:
            return kind, files
    raise FileNotFoundError(f"no JSON lines and no Parquet files in {path}")


def load(spark: SparkSession, path: str, seed: int | None = None, key: str | None = None, schema: str | None = None, recursive: bool = False) -> DataFrame:
    """The table of a file or folder; with ``seed`` in an order by hash of ``key``, the same on any cluster."""
    kind, files = discover(path, recursive)
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.json(files) if kind == "json" else reader.csv(files, header=True) if kind == "csv" else reader.text(files) if kind == "text" else reader.parquet(*files)
    if seed is None:
        return df
    if key is None:
        raise ValueError("a seeded order needs a key")
    return shuffled(df, key, seed)


def load_many(spark: SparkSession, paths: Iterable[str], kind: str) -> DataFrame:
    """The tables of files and folders of one format put together, columns by name."""
    files = sorted({f for p in paths for f in ([p] if _files.is_file(p) else matching_files(p, f"*.{kind}"))})
    if not files:
        raise FileNotFoundError(f"no .{kind} files")
    return spark.read.parquet(*files) if kind == "parquet" else spark.read.json(files)


def with_file_count(spark: SparkSession, folder: str, kind: str = "json") -> tuple[DataFrame, int]:
    """The table of all files of one format in a folder, and their number; an error if there are none."""
    found = matching_files(folder, "*.parquet" if kind == "parquet" else "*.jsonl")
    if not found:
        raise FileNotFoundError(f"no {kind} files in {folder}")
    return load_many(spark, found, kind), len(found)


def with_default_ids(df: DataFrame, text_key: str = "text", id_key: str = "id") -> DataFrame:
    """``df``, just read from files, with its text under ``text`` and an id: its own, else the file's name and the row's place in it."""
    named = text_column(df, text_key) if text_key != "text" else df
    made = F.concat_ws("/", F.col("_metadata.file_name"), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    own = F.col(id_key).cast("string") if id_key in df.columns else F.lit(None).cast("string")
    return named.select(*(c for c in named.columns if c != "id"), F.coalesce(own, made).alias("id"))


def limited(df: DataFrame, order: str, most: int, per: str | None = None) -> DataFrame:
    """At most ``most`` rows, the first in ``order``; with ``per``, of each of its values. A limit of rows to read, not to work on."""
    if per is None:
        return first_in_order(df, [order], most)
    ranked = ranked_keys(df, [order], [per]).where(F.col("_before") == most).select(F.col(per).alias("_per"), F.col(order).alias("_border"))
    joined = df.join(ranked, F.col(per).eqNullSafe(F.col("_per")), "left")
    return joined.where(F.col("_border").isNull() | (F.col(order) < F.col("_border"))).drop("_per", "_border")


def with_file_order(df: DataFrame) -> DataFrame:
    """``df``, just read from Parquet, with ``file`` and ``row_index``, an order that no shuffle changes."""
    return df.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row_index"))


def text_column(df: DataFrame, name: str) -> DataFrame:
    """``df`` with its text under ``text``."""
    if name not in df.columns:
        raise ValueError(f"there is no column {name}; there are {df.columns}")
    return df.withColumnRenamed(name, "text")


def json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """``raw, row`` of the lines of JSON files: ``row`` is null where a line is no JSON object; blank lines are left out.

    A broken line costs that line alone; bytes that are no UTF-8 are replaced.
    """
    lines = spark.read.text(path).where(F.length(strip(F.col("value"))) > 0)
    good = F.try_parse_json(F.col("value")).isNotNull() & F.startswith(strip(F.col("value")), F.lit("{"))
    return lines.select(F.col("value").alias("raw"), F.when(good, F.from_json("value", schema)).alias("row"))


def line_totals(lines: DataFrame, tokens: str = "token_count") -> DataFrame:
    """``lines, tokens, broken`` of ``json_lines``; missing counts are 0."""
    count = F.coalesce(F.sum(F.coalesce(F.col(f"row.{tokens}").cast("bigint"), F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"))
    return lines.agg(F.count("row").alias("lines"), count.alias("tokens"), F.count_if(F.col("row").isNull()).alias("broken"))


def documents_folder(spark: SparkSession, folder: str) -> DataFrame:
    """``file, text`` of the text files of a folder, stripped, without empty ones."""
    texts = spark.read.text(os.path.join(folder, "*.txt"), wholetext=True).select(F.col("_metadata.file_name").alias("file"), strip(F.col("value")).alias("text"))
    return texts.where("text <> ''")


def strict_json_lines(spark: SparkSession, path: str, schema: str, required: str) -> DataFrame:
    """JSON lines that must all be sound and have ``required``; else reading fails."""
    df = spark.read.schema(schema).json(path, mode="FAILFAST")
    return df.where(F.when(F.col(required).isNull(), F.raise_error(F.lit(f"a row has no {required}"))).otherwise(F.lit(True)))


def question_answers(df: DataFrame, prompt: str, answer: str) -> DataFrame:
    """Rows with a prompt and an answer that aren't blank."""
    return df.where((F.length(strip(F.col(prompt))) > 0) & (F.length(strip(F.col(answer).cast("string"))) > 0))


def ambiguous(df: DataFrame, **keys) -> DataFrame:
    """``kind, value, n`` of the values of any of ``keys`` (columns by kind) that several rows share, e.g. names and signatures of tools."""
    pairs = F.array(*(F.struct(F.lit(kind).alias("kind"), column.cast("string").alias("value")) for kind, column in keys.items()))
    counted = df.select(F.explode(pairs).alias("p")).groupBy(F.col("p.kind").alias("kind"), F.col("p.value").alias("value")).agg(F.count("*").alias("n"))
    return counted.where("n > 1")


def json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``file, text`` of all JSON files below a folder; files that are no JSON are left out."""
    texts = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return texts.where(F.try_parse_json("text").isNotNull())


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, number, line`` of text files; lines keep their place in the file."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.split("value", "\n").alias("_lines"))
    return whole.select("file", F.posexplode("_lines").alias("number", "line"))


_HEADER_END = re.compile(rb"\r?\n\r?\n")
_CHARSET = re.compile(rb"charset=[\"']?([\w\-]+)", re.I)
#: Bytes that are read at once, and characters of pages that a batch holds.
_READ_BYTES, _BATCH_CHARACTERS = 1 << 20, 16 << 20


class _Reader:
    """Lines and runs of bytes of a stream that is plain or compressed member by member; holds one read and one record at most."""

    def __init__(self, stream):
        self.stream = stream
        self.held = bytearray()
        self.raw = stream.read(_READ_BYTES)
        self.packed = self.raw[:2] == b"\x1f\x8b"
        self.member = zlib.decompressobj(31) if self.packed else None

    def _more(self) -> bool:
        """Whether there were more bytes to hold. Raises where a member is broken or cut off."""
        if not self.raw:
            self.raw = self.stream.read(_READ_BYTES)
            if not self.raw:
                if self.packed and self.member.unconsumed_tail == b"" and not self.member.eof and self.begun:
                    raise EOFError("the last member is cut off")
                return False
        if not self.packed:
            self.held += self.raw
            self.raw = b""
            return True
        if self.member.eof:
            self.member = zlib.decompressobj(31)
        self.begun = True
        self.held += self.member.decompress(self.raw)
        self.raw = self.member.unused_data
        if self.member.eof:
            self.begun = False
        return True

    begun = False

    def line(self) -> bytes:
        """The next line with its end; empty after the last."""
        searched = 0
        while (end := self.held.find(b"\n", searched)) < 0:
            searched = len(self.held)
            if not self._more():
                end = len(self.held) - 1
                break
        made = bytes(self.held[: end + 1])
        del self.held[: end + 1]
        return made

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise EOFError("a record is shorter than it says")
        made = bytes(self.held[:n])
        del self.held[:n]
        return made


def _records(stream):
    """(headers, body) of the records of a web archive, one after the other; raises where it breaks off."""
    reader = _Reader(stream)
    while line := reader.line():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := reader.line().strip()) and b":" in line:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        yield headers, reader.take(int(headers.get("content-length") or 0))


def _page(body: bytes) -> str | None:
    """The decoded page of an HTTP response, if it is HTML."""
    parts = _HEADER_END.split(body, maxsplit=1)
    if len(parts) < 2 or b"html" not in parts[0].lower():
        return None
    named = _CHARSET.search(parts[0])
    try:
        return parts[1].decode(named.group(1).decode() if named else "utf-8", "replace")
    except LookupError:
        return parts[1].decode("utf-8", "replace")


def web_archive_records(spark: SparkSession, path: str, pattern: str = "*.warc.gz", source: str | None = None) -> DataFrame:
    """``id, url, fetched, html, source, file, error``: the HTML responses of web archives, and a row with ``error`` for each archive that breaks off.

    A task reads archives as streams, record by record, and gives batches of bounded size; an archive that is cut off or
    broken gives its records up to there.
    """
    found = [path] if _files.is_file(path) else matching_files(path, pattern)
    names = ("id", "url", "fetched", "html", "source", "file", "error")
    schema = ", ".join(f"{n} string" for n in names)
    listed = spark.createDataFrame([(f,) for f in found], "file string")
    spread = listed.repartition(max(1, min(len(found), 10_000)), "file") if found else listed

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=list(names))

    def parse(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, held = [], 0
                try:
                    system, inner = _files.filesystem(file)
                    with system.open_input_stream(inner, compression=None) as stream:
                        for headers, body in _records(stream):
                            page = _page(body) if headers.get("warc-type") == "response" else None
                            if page is None:
                                continue
                            rows.append((headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-date"), page, source, file, None))
                            held += len(page)
                            if held > _BATCH_CHARACTERS:
                                yield batch_of(rows)
                                rows, held = [], 0
                except (EOFError, OSError, ValueError, zlib.error) as error:
                    rows.append((None, None, None, None, source, file, f"{type(error).__name__}: {error}"))
                if rows:
                    yield batch_of(rows)

    return spread.mapInArrow(parse, schema)


def web_archive(spark: SparkSession, path: str, pattern: str = "*.warc.gz", source: str | None = None) -> DataFrame:
    """``id, url, fetched, html, source`` of the HTML responses of web archives; ``broken_archives`` has those that break off."""
    return web_archive_records(spark, path, pattern, source).where("error IS NULL").drop("file", "error")


def broken_archives(records: DataFrame) -> DataFrame:
    """``file, error`` of the archives that break off, from ``web_archive_records``."""
    return records.where("error IS NOT NULL").select("file", "error")


def read_sidecar(path: str, typed: bool = True) -> dict | None:
    """``key: value`` lines of a sidecar; typed ones as int, float or str, null if there is no file; untyped ones as they stand, {} if there is none."""
    if not _files.exists(path):
        return None if typed else {}
    made = {}
    for line in _files.read_text(path).splitlines():
        key, colon, value = line.partition(":")
        if not colon:
            continue
        value = value.strip()
        if typed:
            for kind in (int, float):
                try:
                    value = kind(value)
                    break
                except ValueError:
                    pass
        made[key.strip()] = value
    return made


def write_sidecar(path: str, values: dict) -> None:
    """A sidecar of ``key: value`` lines."""
    _files.write_text(path, "".join(f"{k}: {v}\n" for k, v in values.items()))


def sidecars(root: str, name: str = ".metadata") -> list[tuple[str, dict]]:
    """(folder, values) of all sidecars below a folder, sorted."""
    found = _files.listing(root, name, recursive=True, hidden=True)
    base = _files.filesystem(root)[1]
    return [(os.path.relpath(os.path.dirname(_files.filesystem(f)[1]), base), read_sidecar(f)) for f in found]


def token_report(spark: SparkSession, root: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """``folder, subfolder, documents, tokens`` of the sidecars below a folder, with totals of each folder and of all; ``aliases`` rename keys."""
    aliases = aliases or {}
    rows = []
    for folder, values in sidecars(root):
        named = {aliases.get(k, k).lower(): v for k, v in values.items()}
        top, _, rest = folder.partition(os.sep)
        rows.append((top, rest or None, *(int(named[k]) if isinstance(named.get(k), (int, float)) else 0 for k in ("documents", "tokens"))))
    df = spark.createDataFrame(rows, "folder string, subfolder string, documents bigint, tokens bigint")
    return df.rollup("folder", "subfolder").agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"), (F.grouping("folder") + F.grouping("subfolder")).cast("int").alias("level"))
