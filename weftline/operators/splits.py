"""Order, budgets, chunks, samples and splits; every operator takes the order that it works in."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checkpoints import checkpoint
from ..functions.ranks import exact_ranks


def hash_order(key: Column, seed: int = 42) -> Column:
    """A sort key that shuffles rows the same way on any cluster and in any engine: the first 60 bits of an MD5 of seed and key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 15), 16, 10).cast("bigint")


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """``df`` in the order of a hash of its key."""
    return df.orderBy(hash_order(F.col(key), seed), key)


def ranked_keys(df: DataFrame, order: list[str], group: list[str] = (), weight: Column | None = None) -> DataFrame:
    """``group, order, _weight, _before``: the exact ranks of the keys alone, so that numbering rows moves no other column."""
    narrow = df.select(*(group or [F.lit(0).alias("_all")]), *order, (F.lit(1) if weight is None else weight).cast("bigint").alias("_weight"))
    return exact_ranks(narrow, list(group) or ["_all"], list(order), weight="_weight", name="_before")


def _before_border(order: list[str], border) -> Column:
    """Whether a row lies before the row ``border`` in ``order``; null keys come first."""
    here = F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order)))
    there = F.struct(*(F.lit(border[c]).alias(f"_{i}") for i, c in enumerate(order)))
    return here < there


def _chunks_at(df: DataFrame, order: str, starts: list[int], ranked: DataFrame, name: str) -> DataFrame:
    """``df`` with the number of its chunk, the chunks beginning at the ranks ``starts``; rows stay where they lie.

    One key for each chunk goes to the driver and into the plan.
    """
    keys = [r[order] for r in ranked.where(F.col("_before").isin(starts)).orderBy("_before").select(order).collect()] if starts else []
    if not keys:
        return df.withColumn(name, F.lit(0))
    chunk = F.size(F.filter(F.array(*map(F.lit, keys)), lambda k: k <= F.col(order)))
    return df.withColumn(name, F.when(F.col(order).isNull(), 0).otherwise(chunk))


def token_prefix(df: DataFrame, order: str, tokens: str, most: int) -> DataFrame:
    """The longest run of first rows, in ``order``, with at most ``most`` tokens together; ``order`` must tell rows apart and be no null.

    As counts aren't negative, the running sum stays above the budget once it is, so the prefix is all rows up to one
    key. Keys and counts alone are ranked; the rows are filtered where they lie.
    """
    ranked = ranked_keys(df, [order], weight=F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)))
    last = ranked.where(F.col("_before") + F.col("_weight") <= most).agg(F.max(order)).first()[0]
    return df.where(F.lit(False)) if last is None else df.where(F.col(order) <= F.lit(last))


def array_split(df: DataFrame, order: str, chunks: int, name: str = "chunk") -> DataFrame:
    """``df`` with the number of its chunk, from 0: contiguous in ``order``, of nearly equal size, the first ones larger by one.

    ``order`` must tell rows apart; of rows that share a key all come into one chunk.
    """
    ranked = ranked_keys(df, [order])
    size, larger = divmod(ranked.count(), chunks)
    starts = [i * size + min(i, larger) for i in range(1, chunks)]
    return _chunks_at(df, order, starts, ranked, name)


def mirrored_split(df: DataFrame, order: str, files: int, name: str = "chunk") -> DataFrame:
    """``df`` with the number of its chunk: equal sizes rounded down, the last chunk taking what is left."""
    ranked = ranked_keys(df, [order])
    size = max(1, ranked.count() // files)
    return _chunks_at(df, order, [i * size for i in range(1, files)], ranked, name)


def chunk_count(tokens: int, per_chunk: int) -> int:
    """Chunks for so many tokens, one at least."""
    return max(1, -(-tokens // per_chunk))


class _Filling:
    """The chunk that is being filled: its number, what it holds, and whether it holds any row."""

    def __init__(self, most: int):
        self.most, self.number, self.total, self.filled = most, 0, 0, False

    def take(self, sizes: np.ndarray) -> np.ndarray:
        """Numbers of the chunks that the next rows come into; looks up each chunk's end in the running sums."""
        sums = np.cumsum(sizes)
        numbers = np.empty(len(sizes), dtype=np.int64)
        first = before = 0
        while first < len(sizes):
            last = max(first, int(np.searchsorted(sums, self.most - self.total + before, side="right")))
            if last == first and not self.filled:
                # A row that is too large has a chunk of its own.
                last = first + 1
            numbers[first:last] = self.number
            if last == len(sizes):
                self.total, self.filled = self.total + int(sums[-1] - before), True
            else:
                self.number, self.total, self.filled = self.number + 1, 0, False
                before = int(sums[last - 1]) if last else 0
            first = last
        return numbers


def greedy_chunks(df: DataFrame, by: str, order: str, tokens: str, most: int, name: str = "chunk") -> DataFrame:
    """``by, order, chunk``: a new chunk begins where the running sum would pass ``most`` and the chunk has rows.

    The sum starts anew with each chunk, so the lengths of one file, and these alone, are read in order by one task:
    sorted as Spark sorts, on disk where they are many, and streamed batch by batch, with no more than a batch held.
    """

    def chunk(batches):
        current, filling = None, _Filling(most)
        for batch in batches:
            keys, sizes = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False)
            codes = pc.dictionary_encode(keys, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)]])
            numbers = []
            for first, last in zip(edges[:-1], edges[1:]):
                if last == first:
                    continue
                key = (keys[int(first)].as_py(),)
                if key != current:
                    current, filling = key, _Filling(most)
                numbers.append(filling.take(sizes[first:last]))
            if numbers:
                yield pa.RecordBatch.from_arrays([keys, batch.column(1), pa.array(np.concatenate(numbers))], names=[by, order, name])

    rows = df.select(by, order, F.greatest(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint")).alias("_tokens"))
    kinds = {c: df.schema[c].dataType.simpleString() for c in (by, order)}
    return rows.repartition(by).sortWithinPartitions(by, order).mapInArrow(chunk, f"`{by}` {kinds[by]}, `{order}` {kinds[order]}, {name} bigint")


def quotas(counts: list[int], n: int, redistribute: bool = False) -> list[int]:
    """Rows to take from each file, in proportion; the last file takes what is left, at most its length.

    With ``redistribute`` what the last can't give is taken from the first ones that have more.
    """
    total = sum(counts)
    if total == 0:
        return [0] * len(counts)
    taken = [n * c // total for c in counts[:-1]]
    taken.append(min(counts[-1], max(0, n - sum(taken))))
    if redistribute:
        for i, c in enumerate(counts):
            more = min(c - taken[i], min(n, total) - sum(taken))
            taken[i] += max(0, more)
    return taken


def file_quotas(counts: DataFrame, file: str, n: int, redistribute: bool = False) -> DataFrame:
    """``quotas`` of a table of ``file, count``, one row per file, however many there are: ``file, count, _quota``."""
    last, total = counts.agg(F.max(file), F.sum("count")).first()
    if not total:
        return counts.withColumn("_quota", F.lit(0).cast("bigint"))
    share = F.floor(F.col("count") * n / total).cast("bigint")
    others = counts.where(F.col(file) != F.lit(last)).agg(F.coalesce(F.sum(share), F.lit(0))).first()[0]
    taken = counts.withColumn("_quota", F.when(F.col(file) == F.lit(last), F.least(F.col("count"), F.lit(max(0, n - others)))).otherwise(share))
    if not redistribute:
        return taken
    missing = min(n, total) - taken.agg(F.sum("_quota")).first()[0]
    spare = exact_ranks(taken.withColumn("_all", F.lit(0)).withColumn("_spare", F.col("count") - F.col("_quota")), ["_all"], [file], weight="_spare", name="_earlier")
    more = F.least(F.col("_spare"), F.greatest(F.lit(missing) - F.col("_earlier"), F.lit(0)))
    return spare.select(file, "count", (F.col("_quota") + more).alias("_quota"))


def validation_split(df: DataFrame, file: str, order: str, n: int, redistribute: bool = False) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows: the first rows of each file, in ``order``, in proportion to its length.

    ``order`` must tell a file's rows apart. Keys alone are ranked, so a file with most rows is no burden; the rows are
    held against the first key of each file that isn't taken, in a table of one row per file. Rows without a file are training rows.
    """
    named = df.where(F.col(file).isNotNull())
    taken = file_quotas(named.groupBy(file).count(), file, n, redistribute).select(F.col(file).alias("_file"), "_quota")
    ranked = ranked_keys(named, [order], [file]).join(taken, F.col(file) == F.col("_file")).where(F.col("_before") == F.col("_quota"))
    borders = taken.join(checkpoint(ranked.select(F.col(file).alias("_file"), F.col(order).alias("_border"))), "_file", "left")
    marked = df.join(checkpoint(borders), F.col(file) == F.col("_file"), "left")
    chosen = F.coalesce((F.col("_quota") > 0) & (F.col("_border").isNull() | (F.col(order) < F.col("_border"))), F.lit(False))
    drop = ("_file", "_quota", "_border")
    return marked.where(~chosen).drop(*drop), marked.where(chosen).drop(*drop)


def picked_files(files: list[str], n: int, seed: int = 42) -> list[str]:
    """``n`` of ``files``, by a hash of their names, sorted."""
    import hashlib

    return sorted(sorted(files, key=lambda f: hashlib.md5(f"{seed}:{f}".encode()).hexdigest())[:n])


def first_in_order(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The ``n`` first rows in ``order``, which must tell rows apart, in any order; no task sees more than its share, however large ``n`` is."""
    border = ranked_keys(df, order).where(F.col("_before") == n).first()
    return df if border is None else df.where(_before_border(order, border))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by the order of a hash of their key: a sampling operator, the same on any cluster."""
    return first_in_order(df.withColumn("_hash", hash_order(F.col(key), seed)), ["_hash", key], n).drop("_hash")


def split_by_hash(df: DataFrame, key: str, share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, the test rows about ``share`` of all; no shuffle, and stable as rows are added."""
    test = F.pmod(hash_order(F.col(key), seed), F.lit(1_000_000)) < int(share * 1_000_000)
    return df.where(~test), df.where(test)


def stratified_split(df: DataFrame, key: str, stratum: str, share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with exactly ``floor(share * n)`` test rows of each stratum of n rows, by hash order.

    ``key`` must tell rows apart. Hashes and keys alone are ranked; rows are held against the first key of each stratum
    that is no test row.
    """
    ordered = df.withColumn("_hash", hash_order(F.col(key), seed))
    totals = df.groupBy(F.col(stratum).alias("_s")).agg(F.floor(F.count("*") * share).alias("_n"))
    ranked = ranked_keys(ordered, ["_hash", key], [stratum]).join(totals, F.col(stratum).eqNullSafe(F.col("_s")))
    borders = checkpoint(ranked.where(F.col("_before") == F.col("_n")).select("_s", F.struct("_hash", F.col(key).alias("_key")).alias("_border")))
    joined = ordered.join(borders, F.col(stratum).eqNullSafe(F.col("_s")), "left")
    test = F.col("_border").isNull() | (F.struct("_hash", F.col(key).alias("_key")) < F.col("_border"))
    drop = ("_s", "_border", "_hash")
    return joined.where(~test).drop(*drop), joined.where(test).drop(*drop)


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in ``order``."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def remaining(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among those done."""
    return df.join(done.select(key).distinct(), key, "left_anti")
