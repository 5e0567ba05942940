"""Tokens: encoding with public tokenizers, labels and masks, chunks, metrics and training samples."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .splits import first_in_order

IGNORED = -100
_LOADED: dict[str, object] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json", folder: str | None = None) -> str:
    """Path of a tokenizer file: below ``folder``, else ``$TOKENIZER_DIR``, else the installed package of public tokenizers."""
    folder = folder or os.environ.get("TOKENIZER_DIR")
    if folder is None:
        spec = importlib.util.find_spec("public_tokenizers")
        if spec is None or spec.origin is None:
            raise FileNotFoundError("no folder of tokenizers given")
        folder = os.path.dirname(spec.origin)
    return os.path.join(folder, name)


#: The splitting pattern of the byte-level rank files.
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _loaded(path: str):
    """The tokenizer of a file, once for each Python worker."""
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece

            _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        elif path.endswith(".tiktoken"):
            import base64

            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
            _LOADED[path] = tiktoken.Encoding(os.path.basename(path), pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            # Every task has a core of its own; threads beside it would only get in the way of others.
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            made = Tokenizer.from_file(path)
            made.encode_special_tokens = True
            _LOADED[path] = made
    return _LOADED[path]


def _encode(path: str, texts: list[str]) -> list[list[int]]:
    made = _loaded(path)
    if path.endswith(".model"):
        return made.encode(texts, num_threads=1)
    if path.endswith(".tiktoken"):
        return [made.encode_ordinary(t) for t in texts]
    return [e.ids for e in made.encode_batch(texts, add_special_tokens=False)]


def with_token_ids(df: DataFrame, text: str, path: str, bos: int | None = None, eos: int | None = None, name: str = "input_ids") -> DataFrame:
    """``df`` with the ids of its texts, between ``bos`` and ``eos`` where given; null texts count as empty.

    A step of its own in the plan, so that a filter on the ids can't make the texts be encoded twice.
    """
    head, tail = ([bos] if bos is not None else []), ([eos] if eos is not None else [])

    def run(batches):
        for batch in batches:
            ids = [head + own + tail for own in _encode(path, [t or "" for t in batch.column(text).to_pylist()])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def token_ids(path: str, bos: int | None = None, eos: int | None = None):
    """An Arrow function from texts to their ids, between ``bos`` and ``eos`` where given; null texts count as empty."""

    @pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        head, tail = ([bos] if bos is not None else []), ([eos] if eos is not None else [])
        return pd.Series([np.array(head + own + tail, dtype=np.int32) for own in _encode(path, [t or "" for t in texts])])

    return ids


def token_count(path: str):
    """An Arrow function from texts to their numbers of tokens; null texts have 0."""

    @pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(own) for own in _encode(path, [t or "" for t in texts])], dtype="int64")

    return count


def attention(ids: Column) -> Column:
    """Ones, as many as there are ids."""
    return F.transform(ids, lambda _: F.lit(1))


def labels(ids: Column, assistant: Column | None = None) -> Column:
    """The ids, or -100 where the assistant's mask isn't 1."""
    if assistant is None:
        return ids
    return F.zip_with(ids, assistant, lambda i, m: F.when(m == 1, i).otherwise(F.lit(IGNORED)))


def masked_labels(ids: Column, masked: list[int], given: Column | None = None) -> Column:
    """Labels where none are given: the ids, or -100 for ids in ``masked``."""
    made = F.transform(ids, lambda i: F.when(i.isin(*masked), F.lit(IGNORED)).otherwise(i)) if masked else ids
    return made if given is None else F.coalesce(given, made)


def mask_ids(pad: int | None, eos: int | None, bos: int | None, others: tuple[int, ...] = ()) -> list[int]:
    """Ids that no loss is taken of, sorted."""
    return sorted({i for i in (pad, eos, bos, *others) if i is not None})


def tokenized(df: DataFrame, text: str, path: str, bos: int | None = None, eos: int | None = None, most_length: int | None = None) -> DataFrame:
    """``df`` with ``input_ids, attention_mask, labels, seq_lengths``; rows longer than ``most_length`` are dropped."""
    rows = with_token_ids(df, text, path, bos, eos)
    rows = rows.withColumn("attention_mask", attention(F.col("input_ids"))).withColumn("labels", labels(F.col("input_ids"))).withColumn("seq_lengths", F.size("input_ids"))
    return rows if most_length is None else rows.where(F.col("seq_lengths") <= most_length)


def tokenized_chats(df: DataFrame, messages: str, path: str, start: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """``df`` with ``input_ids, attention_mask, assistant_masks, labels, seq_lengths`` of chats in the ChatML form.

    Segments are encoded one by one, and the assistant's contents and their closing marks carry mask 1, so the mask is
    exact whatever the merges at the seams. Null and empty chats have no ids.
    """

    @pandas_udf("struct<input_ids:array<int>,assistant_masks:array<int>>")
    def encode(rows: pd.Series) -> pd.DataFrame:
        pieces, spans = [], []
        for chat in rows:
            first = len(pieces)
            for m in chat if chat is not None else ():
                role, content = (m["role"] or ""), (m["content"] or "")
                own = role == "assistant"
                pieces += [(f"{start}{role}\n", 0), (content.strip("\n") + end if own else content + end, int(own)), ("\n", 0)]
            spans.append((first, len(pieces)))
        encoded = _encode(path, [p for p, _ in pieces]) if pieces else []
        ids, masks = [], []
        for first, last in spans:
            ids.append(np.array([i for k in range(first, last) for i in encoded[k]], dtype=np.int32))
            masks.append(np.array([pieces[k][1] for k in range(first, last) for _ in encoded[k]], dtype=np.int32))
        return pd.DataFrame({"input_ids": ids, "assistant_masks": masks})

    rows = df.withColumn("_chat", encode(F.col(messages)))
    rows = rows.withColumn("input_ids", F.col("_chat.input_ids")).withColumn("assistant_masks", F.col("_chat.assistant_masks")).drop("_chat")
    rows = rows.withColumn("attention_mask", attention(F.col("input_ids"))).withColumn("labels", labels(F.col("input_ids"), F.col("assistant_masks")))
    return rows.withColumn("seq_lengths", F.size("input_ids"))


def exploded_chunks(df: DataFrame, text: str, path: str, most: int, once: bool = False) -> DataFrame:
    """A row for each decoded chunk of up to ``most`` ids of a text, ``chunk`` its number from 0, null where a text is a single chunk.

    With ``once`` the first chunk alone is kept; null and empty texts have none.
    """

    def run(batches):
        for batch in batches:
            made = _loaded(path)
            at, numbers, parts = [], [], []
            for row, own in enumerate(_encode(path, [t or "" for t in batch.column(text).to_pylist()])):
                starts = range(0, min(len(own), most) if once else len(own), most)
                for n, i in enumerate(starts):
                    at.append(row)
                    numbers.append(n if len(starts) > 1 else None)
                    parts.append(made.decode(own[i : i + most]))
            kept = batch.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(numbers, pa.int32()), pa.array(parts, pa.string())], names=[*kept.schema.names, "chunk", "chunk_text"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("chunk", T.IntegerType()), T.StructField("chunk_text", T.StringType())]))


def tokenizer_metrics(df: DataFrame, text: str, paths: dict[str, str], unknown: dict[str, int] | None = None) -> DataFrame:
    """``tokenizer, fertility, split_words, chars_per_token, unknown``, sorted by fertility, over the words of all texts.

    Fertility is tokens per word, ``split_words`` the share of words of more than one token. Words are counted first,
    so each distinct word is encoded once.
    """
    unknown = unknown or {}
    words = df.select(F.explode(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"(?U)\s+"), lambda w: w != "")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))

    def measure(batches):
        for batch in batches:
            found, n = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), dtype=np.int64)
            for name, path in paths.items():
                made = _encode(path, found) if found else []
                sizes = np.array([len(x) for x in made], dtype=np.int64)
                lost = np.array([x.count(unknown.get(name, -1)) for x in made], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), *(pa.array([int(v)]) for v in ((sizes * n).sum(), n.sum(), (n * (sizes > 1)).sum(), (np.array([len(w) for w in found]) * n).sum(), (lost * n).sum()))],
                    names=["tokenizer", "tokens", "words", "split", "chars", "lost"],
                )

    sums = words.mapInArrow(measure, "tokenizer string, tokens bigint, words bigint, split bigint, chars bigint, lost bigint").groupBy("tokenizer").agg(
        *(F.sum(c).alias(c) for c in ("tokens", "words", "split", "chars", "lost"))
    )
    return sums.select(
        "tokenizer", (F.col("tokens") / F.col("words")).alias("fertility"), (F.col("split") / F.col("words")).alias("split_words"), (F.col("chars") / F.col("tokens")).alias("chars_per_token"), F.col("lost").alias("unknown")
    ).orderBy("fertility")


def training_sample(df: DataFrame, text: str, n: int, seed: int = 42, normalize: Callable[[Column], Column] | None = None) -> DataFrame:
    """``n`` texts in an order by hash, the same on any cluster, optionally normalized: the sample a tokenizer is trained on elsewhere.

    Hashes alone are ranked. Copies of a text that would stand on both sides of the border are left out.
    """
    column = F.col(text) if normalize is None else normalize(F.col(text))
    hashed = df.where(F.col(text).isNotNull()).select(text, F.xxhash64(F.col(text), F.lit(seed)).alias("_hash"))
    return first_in_order(hashed, ["_hash"], n).select(column.alias(text))
