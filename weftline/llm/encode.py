"""Encoding of whole texts with a public byte-level tokenizer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import DEFAULT_VOCABULARY, encoder, vocabulary_path
from .common import column, map_batches, raw, string_column

#: A record batch of ids is closed beyond this many bytes.
BATCH_BYTES = 1 << 24


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """``key, ids``: the ids of every text under a byte-level vocabulary, without special tokens.

    Null and empty texts have the empty list; a text of white space has its tokens. Rows are encoded where they lie,
    in full; equal rows stay as they are. Columns other than the two are ignored.
    """
    path = vocabulary or vocabulary_path(DEFAULT_VOCABULARY)
    source = df.select(F.col(f"`{key}`").alias(key), string_column(text).alias("_text"))

    def encode(batch):
        packed = encoder(path).packed
        parts, lengths, held, first = [], [], 0, 0
        keys = raw(batch, key)

        def close(until):
            values = np.frombuffer(b"".join(parts), dtype="<i4")
            offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
            np.cumsum(lengths, out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            return pa.RecordBatch.from_arrays([keys.slice(first, until - first), ids], names=[key, "ids"])

        for row, value in enumerate(column(batch, "_text")):
            ids = packed(value) if value else b""
            parts.append(ids)
            lengths.append(len(ids) // 4)
            held += len(ids)
            if held >= BATCH_BYTES:
                yield close(row + 1)
                parts, lengths, held, first = [], [], 0, row + 1
        if lengths:
            yield close(batch.num_rows)

    return map_batches(source, encode, f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>")
