"""Exact and near duplicates: MinHash signatures, bands, star edges and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checkpoints import checkpoint
from ..functions.text import bound, ngrams, words

BANDS = 14
ROWS = 8
SHINGLE_WORDS = 5
SEED = 1


def same_text_key(text: Column) -> Column:
    """A key that equal texts share, of 128 bits and the length, so that no two texts of a corpus meet by chance; null for null."""
    return F.concat(F.md5(text), F.lit(":"), F.length(text).cast("string"))


def representatives(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, representative``: the least key of all rows with the same text; rows of null texts represent themselves.

    Keys and digests alone are shuffled, never the texts, and are added up first, so that a text with most copies is no
    burden; rows without copies aren't joined.
    """
    marked = df.select(F.col(key), same_text_key(F.col(text)).alias("_digest"))
    counted = marked.where("_digest IS NOT NULL").groupBy("_digest").agg(F.min(key).alias("_least"), F.count("*").alias("_n"))
    joined = marked.join(counted.where("_n > 1").drop("_n"), "_digest", "left")
    return joined.select(key, F.coalesce("_least", key).alias("representative"))


def exact_duplicates(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with ``representative``; ``key`` must tell the rows apart. Where no other column is wanted, ``representatives`` moves no text."""
    found = representatives(df, key, text).withColumnRenamed(key, "_key")
    return df.join(found, F.col(key) == F.col("_key")).drop("_key")


def without_exact_duplicates(df: DataFrame, key: str, text: str) -> DataFrame:
    """The row of least key of each text; all rows of null texts. Only the keys of the removed rows are joined."""
    removed = representatives(df, key, text).where(F.col(key) != F.col("representative")).select(key)
    return df.join(removed, key, "left_anti")


def shingle_hashes(text: Column, n: int = SHINGLE_WORDS) -> Column:
    """Distinct 64-bit hashes of runs of ``n`` words in lower case; the whole text's where it has fewer, none where it has none."""
    def hashes(w: Column) -> Column:
        grams = F.when(F.size(w) >= n, ngrams(w, n)).when(F.size(w) > 0, F.array(F.array_join(w, " ")))
        return F.array_distinct(F.transform(F.coalesce(grams, F.array().cast("array<string>")), lambda g: F.xxhash64(g)))

    return bound(words(F.lower(text)), hashes)


def _coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 61, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 61, n, dtype=np.uint64)


def _band_values(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, weights: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A value for each band of one text.

    Every shingle is hashed once; the permutations are multiplications and additions modulo 2**64 of that hash.
    """
    base = hashes.astype(np.int64).view(np.uint64)
    signature = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for part in range(0, len(base), 4096):
        mixed = base[part : part + 4096, None] * a + b
        mixed ^= mixed >> np.uint64(29)
        signature = np.minimum(signature, mixed.min(axis=0))
    grid = signature.reshape(bands, rows)
    return ((grid ^ (grid >> np.uint64(31))) * weights).sum(axis=1).view(np.int64)


def signatures(df: DataFrame, key: str, text: str, bands: int = BANDS, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """``src, digest, bands``: a value for each MinHash band of each text, in one pass; null bands for texts without words."""
    source = df.select(F.col(key).alias("src"), same_text_key(F.col(text)).alias("digest"), shingle_hashes(F.col(text)).alias("hashes"))

    def run(batches):
        a, b = _coefficients(bands * rows, seed)
        weights, _ = _coefficients(rows, seed + 1)
        for batch in batches:
            lists = batch.column("hashes")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                made = [_band_values(values[ends[i] : ends[i + 1]], a, b, weights, bands, rows) if ends[i + 1] > ends[i] else None for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([batch.column("src"), batch.column("digest"), pa.array(made, pa.list_(pa.int64()))], names=["src", "digest", "bands"])

    return source.mapInArrow(run, f"src {df.schema[key].dataType.simpleString()}, digest string, bands array<bigint>")


def band_rows(df: DataFrame, key: str, text: str, bands: int = BANDS, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """``src, band, value``: a row for each MinHash band of each text; texts without words have none."""
    return signatures(df, key, text, bands, rows, seed).select("src", F.posexplode("bands").alias("band", "value"))


def detection_probability(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that two texts of this similarity share a band."""
    return 1 - (1 - similarity**rows) ** bands


def star_edges(banded: DataFrame) -> DataFrame:
    """``src, dst`` from ``src, bands``: from each text to the least key with which it shares a band, once.

    A band's texts are linked as a star, so edges grow as the texts do, whatever the size of a band.
    """
    rows = banded.select("src", F.posexplode("bands").alias("band", "value"))
    centers = rows.groupBy("band", "value").agg(F.min("src").alias("dst"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return rows.join(centers, ["band", "value"]).where("src <> dst").select("src", "dst").distinct()


def candidate_edges(df: DataFrame, key: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``star_edges`` of the texts; those without words have none."""
    return star_edges(checkpoint(signatures(df, key, text, bands, rows)))


def _fingerprint(pairs: DataFrame) -> tuple:
    """What equal tables of distinct pairs share: their number and the exclusive or of two hashes."""
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component``: for each node of ``edges`` (src, dst) the least node that it is connected to.

    Rounds of large stars and small stars (each node hooks onto the least of its neighbours) until no edge changes;
    each round is checkpointed, so that the plan doesn't grow and a lost executor costs one round.
    """
    pairs = checkpoint(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    before = _fingerprint(pairs)
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_least")).withColumn("m", F.least("u", "_least")).drop("_least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        center = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(center, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        pairs = checkpoint(small)
        after = _fingerprint(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def near_duplicates(df: DataFrame, key: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, component``: the class of each text, its least key; a text alike to no other is its own class.

    The texts are read once and never shuffled: each gives its digest and a value for each band, and all else is done
    with these. Equal texts are put together by their digest first and share the class of their least key.
    """
    read = checkpoint(signatures(df, key, text, bands, rows))
    single = checkpoint(read.where("digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct("src", "bands")).alias("_first")).select("digest", "_first.*"))
    found = components(star_edges(single.where("bands IS NOT NULL")))
    classes = single.join(found, F.col("src") == F.col("node"), "left").select("digest", F.coalesce("component", "src").alias("_class"))
    return read.join(classes, "digest", "left").select(F.col("src").alias(key), F.coalesce("_class", "src").alias("component"))


def without_near_duplicates(df: DataFrame, key: str, text: str, **options) -> tuple[DataFrame, DataFrame]:
    """Two tables: the row of least key of each class, and the removed rows. Only the removed keys are joined."""
    removed = checkpoint(near_duplicates(df, key, text, **options).where(F.col(key) != F.col("component")).select(key))
    return df.join(removed, key, "left_anti"), df.join(removed, key, "left_semi")

