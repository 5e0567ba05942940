"""Items of a benchmark inside the texts of a corpus.

Texts and items are compared as sequences of folded words. Every text is folded once; a filter of fixed size, made of
all items, leaves the stretches that could hold a piece of any of them. Every item-sized window of such a stretch is
embedded by a random walk that turns edit distance into Hamming distance (CGK), hashed by sampled positions of the walk
in many repetitions, and looked up among the windows of the items; what meets is verified exactly. The items are the
stated query set: they lie in the shared folder in blocks of a bounded number, and tasks read a block at a time against
the stretches, so neither items nor texts go to the driver or through a shuffle.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import files
from ..functions.checkpoints import checkpoint, scratch_folder
from .common import column, map_batches, raw, string_column

#: Of an item's words, the share that a piece must have, and of the piece's words the share that may be exchanged.
LEAST_SHARE = 0.5
EXCHANGED = 1 / 8
#: Items that a task holds at once.
BLOCK_ITEMS = 2_000
#: Bits of the filter of the items' runs of words, whatever their number, and bits set for each run.
FILTER_BITS = 1 << 26
PROBES = 3
MEMO_WORDS = 200_000
#: Steps of a walk per word, sampled positions of a key, repetitions, and walks that these share alike. A walk that
#: loses step loses all its keys, so each has its own bits.
WALK = 2
SAMPLED = 4
REPETITIONS = 48
WALKS = 4
SEED = 20_240_229

#: Tags by their attributes and comments by their marks, however long; else what stands between two signs close by, as
#: signs far apart may have a passage between them.
_MARKUP = re.compile(
    r"""<[a-zA-Z][\w:-]*(?=[^<>]*=)(?:\s+[\w:@.-]++(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]++))?)++\s*/?>|<!--[^<>]*-->|<[a-zA-Z/!][^<>]{0,200}>"""
)
_LINK = re.compile(r"\]\([^()\s]*\)")
_BROKEN = re.compile(r"(?<=\w)[-­‐]\s*\n\s*(?=\w)")
_HIDDEN = re.compile(r"[­​-‏⁠-⁤﻿̀-ͯ]")
_WORDS = re.compile(r"[^\W_]+(?:[ऀ-ॣॱ-ৣৰ-৾਀-ൿ]+[^\W_]*)*|[ऀ-ॣॱ-ৣ]+")


def folded_words(text: str) -> list[str]:
    """Words of a text, whatever its case, punctuation, spacing, line breaks, accents, Unicode form or markup."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _MARKUP.sub("", text)
    if "](" in text:
        text = _LINK.sub(" ", text)
    if "\n" in text and ("-" in text or "­" in text or "‐" in text):
        text = _BROKEN.sub("", text)
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKD", text.casefold()))
    else:
        text = text.lower()
    return _WORDS.findall(text)


_WORD_IDS: dict[str, int] = {}


def word_ids(words: list[str]) -> np.ndarray:
    """64-bit ids of words, the same in every worker; of a billion words two share an id with a chance of one in forty."""
    known = _WORD_IDS
    try:
        return np.array([known[w] for w in words], dtype=np.int64)
    except KeyError:
        if len(known) > MEMO_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w) - (1 << 63)
        return np.array([known[w] for w in words], dtype=np.int64)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit values."""
    x = values.astype(np.int64).view(np.uint64).copy()
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def run_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` ids."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    mixed = _mixed(ids)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + mixed[k : k + n]
    return _mixed(total.view(np.int64))


class RunFilter:
    """A Bloom filter of fixed size over the runs of ``size`` words of all items; it may take a run for one of them, never the reverse."""

    def __init__(self, size: int, bits: bytes | None = None):
        self.size = size
        self.bits = np.frombuffer(bits, dtype=np.uint8) if bits else np.zeros(FILTER_BITS // 8, dtype=np.uint8)

    def _places(self, hashes: np.ndarray):
        for k in range(PROBES):
            yield ((hashes >> np.uint64(1 + k * 19)) ^ (hashes << np.uint64(k))) & np.uint64(FILTER_BITS - 1)

    def add(self, ids: np.ndarray) -> None:
        for at in self._places(run_hashes(ids, self.size)):
            np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """Where runs begin that may be an item's."""
        left = np.arange(max(0, len(ids) - self.size + 1))
        hashes = run_hashes(ids, self.size)
        for at in self._places(hashes):
            at = at[left]
            left = left[(self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
            if len(left) == 0:
                break
        return left

    def stretches(self, ids: np.ndarray, reach: int) -> list[tuple[int, int]]:
        """First and past-the-last word of the parts of a text within ``reach`` words of a hit."""
        found = self.hits(ids)
        if len(found) == 0:
            return []
        cuts = np.flatnonzero(np.diff(found) > 2 * reach + self.size)
        firsts, lasts = found[np.concatenate([[0], cuts + 1])], found[np.concatenate([cuts, [len(found) - 1]])]
        return [(max(0, int(f) - reach), min(len(ids), int(t) + self.size + reach)) for f, t in zip(firsts, lasts)]


def least_words(size: int) -> int:
    """Words of an item of ``size`` words that a piece has at least."""
    return int(np.ceil(size * LEAST_SHARE))


class Items:
    """Index of a block of items, of texts or of the ids of their folded words."""

    def __init__(self, items: list[tuple[object, str | np.ndarray]]):
        sequences = [(key, word_ids(folded_words(own or "")) if own is None or isinstance(own, str) else own) for key, own in items]
        sequences = [(key, ids) for key, ids in sequences if len(ids)]
        self.vocabulary = np.unique(np.concatenate([ids for _, ids in sequences])) if sequences else np.zeros(0, dtype=np.int64)
        vocabulary = self.vocabulary
        self.keys = [key for key, _ in sequences]
        self.words = [self._numbers(ids) for _, ids in sequences]
        self.least = [least_words(len(w)) for w in self.words]
        self.by_width: dict[int, _Windows] = {}
        # Windows of a few widths: an item takes the largest that is no longer than its shortest piece.
        for n, least in enumerate(self.least):
            width = max(1, least if least < 8 else least // 8 * 8)
            self.by_width.setdefault(width, _Windows(width, len(vocabulary))).add(n, self.words[n])
        for windows in self.by_width.values():
            windows.close()
        self.by_run: dict[int, _Runs] = {}
        for n, least in enumerate(self.least):
            run = shared_run(least, len(self.words[n]))
            self.by_run.setdefault(run, _Runs(run)).add(n, self.words[n])
        for runs in self.by_run.values():
            runs.close()

    def _numbers(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of words in the vocabulary, from 1; 0 for others."""
        at = np.minimum(np.searchsorted(self.vocabulary, ids), max(0, len(self.vocabulary) - 1))
        known = self.vocabulary[at] == ids if len(self.vocabulary) else np.zeros(len(ids), dtype=bool)
        return np.where(known, at + 1, 0).astype(np.int32)

    def find(self, text: str | np.ndarray) -> list[int]:
        """Numbers of the items of which the text, or the sequence of its words' ids, contains a piece."""
        words = self._numbers(word_ids(folded_words(text)) if isinstance(text, str) else text)
        known = np.concatenate([[0], np.cumsum(words > 0)])
        found: set[int] = set()
        tried: set[tuple[int, int]] = set()
        for source in (*self.by_width.values(), *self.by_run.values()):
            for item, shift in source.candidates(words, known):
                if item in found:
                    continue
                own, least = self.words[item], self.least[item]
                if on_diagonal(words, own, shift, least):
                    found.add(item)
                    continue
                # Shifts of one stretch share an alignment, whose reach goes beyond the stretch on either side.
                slack = max(2, len(own) // 16)
                stretch = (item, shift // slack)
                if stretch not in tried:
                    tried.add(stretch)
                    if off_diagonal(words, own, stretch[1] * slack, slack, least):
                        found.add(item)
        return sorted(found)


class _Windows:
    """Windows of one width, embedded and hashed."""

    def __init__(self, width: int, vocabulary: int):
        rng = np.random.default_rng(SEED + width)
        self.width = width
        self.steps = WALK * width
        self.bits = rng.integers(0, 2, (WALKS, self.steps, vocabulary + 1), dtype=np.int8)
        sampled = min(SAMPLED, self.steps)
        self.positions = np.stack([rng.choice(self.steps, sampled, replace=False) for _ in range(REPETITIONS)])
        self.factors = rng.integers(1, 1 << 62, (REPETITIONS, sampled), dtype=np.int64) | 1
        self.made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def embed(self, windows: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """A walk of each row: at each step the word under the pointer, which a random bit of step and word moves on."""
        n, width = windows.shape
        padded = np.concatenate([windows, np.zeros((n, 1), dtype=windows.dtype)], axis=1)
        out = np.empty((n, self.steps), dtype=np.int64)
        at = np.zeros(n, dtype=np.int64)
        rows = np.arange(n)
        for step in range(self.steps):
            symbol = padded[rows, at]
            out[:, step] = symbol
            at = np.minimum(at + bits[step][symbol], width)
        return out

    def hashes(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), REPETITIONS), dtype=np.int64)
        for n, bits in enumerate(self.bits):
            walk = self.embed(windows, bits)
            with np.errstate(over="ignore"):
                out[:, n::WALKS] = ((walk[:, self.positions[n::WALKS]] + 1) * self.factors[n::WALKS]).sum(axis=2)
        return out

    def add(self, item: int, words: np.ndarray) -> None:
        windows = np.lib.stride_tricks.sliding_window_view(words, self.width)
        self.made.append((windows, np.full(len(windows), item), np.arange(len(windows))))

    def close(self) -> None:
        windows = np.concatenate([m[0] for m in self.made])
        keys = np.concatenate([self.hashes(windows[i : i + 4096]) for i in range(0, len(windows), 4096)])
        items = np.concatenate([m[1] for m in self.made])
        offsets = np.concatenate([m[2] for m in self.made])
        self.tables = []
        for r in range(REPETITIONS):
            order = np.argsort(keys[:, r], kind="stable")
            self.tables.append((keys[order, r], items[order], offsets[order]))
        self.made = []

    def candidates(self, words: np.ndarray, known: np.ndarray) -> list[tuple[int, int]]:
        """(item, shift) whose windows meet one of the text's in some repetition; shift is text position minus item position.

        A window can hold a piece only if all but one word in eight are words of some item; others are not embedded.
        """
        width = self.width
        if len(words) < width:
            return []
        enough = width - int(width * EXCHANGED)
        starts = np.flatnonzero(known[width:] - known[:-width] >= enough)
        if len(starts) == 0:
            return []
        hashes = self.hashes(np.lib.stride_tricks.sliding_window_view(words, width)[starts])
        met = []
        for r, table in enumerate(self.tables):
            found = _meetings(table, hashes[:, r], starts)
            if found is not None:
                met.append(found)
        if not met:
            return []
        return _by_meetings(np.concatenate(met))


class _Runs:
    """Runs of one number of words, hashed; the text's are looked up whole, so none is missed."""

    def __init__(self, size: int):
        self.size = size
        self.factors = np.random.default_rng(SEED - size).integers(1, 1 << 62, size, dtype=np.int64) | 1
        self.made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def hashes(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return sum(words[starts + k] * factor for k, factor in enumerate(self.factors))

    def add(self, item: int, words: np.ndarray) -> None:
        starts = np.arange(len(words) - self.size + 1)
        self.made.append((self.hashes(words, starts), np.full(len(starts), item), starts))

    def close(self) -> None:
        keys, items, offsets = (np.concatenate(x) for x in zip(*self.made))
        order = np.argsort(keys, kind="stable")
        self.table = (keys[order], items[order], offsets[order])
        self.made = []

    def candidates(self, words: np.ndarray, known: np.ndarray) -> list[tuple[int, int]]:
        """(item, shift) of the runs that the text shares."""
        if len(words) < self.size:
            return []
        starts = np.flatnonzero(known[self.size :] - known[: -self.size] == self.size)
        if len(starts) == 0:
            return []
        met = _meetings(self.table, self.hashes(words, starts), starts)
        return [] if met is None else _by_meetings(met)


def _meetings(table: tuple[np.ndarray, np.ndarray, np.ndarray], hashes: np.ndarray, starts: np.ndarray) -> np.ndarray | None:
    """Item and shift, in one number, of every meeting of a hash with the table."""
    keys, items, offsets = table
    first = np.searchsorted(keys, hashes, side="left")
    times = np.searchsorted(keys, hashes, side="right") - first
    hit = np.flatnonzero(times)
    if len(hit) == 0:
        return None
    times = times[hit]
    at = np.arange(times.sum()) + np.repeat(first[hit] - np.cumsum(times) + times, times)
    return (items[at] << 32) + np.repeat(starts[hit], times) - offsets[at] + (1 << 31)


def _by_meetings(met: np.ndarray) -> list[tuple[int, int]]:
    """(item, shift) by falling number of meetings."""
    pairs, times = np.unique(met, return_counts=True)
    ordered = pairs[np.argsort(-times, kind="stable")]
    return list(zip((ordered >> 32).tolist(), ((ordered & 0xFFFFFFFF) - (1 << 31)).tolist()))


def shared_run(least: int, size: int) -> int:
    """Words in a row that any piece of at least ``least`` of ``size`` words has unchanged, with at most one word in eight exchanged.

    Of the stretches between k exchanged words of n, one has n / (k + 1) words or more, rounded down.
    """
    return min(n // (int(n * EXCHANGED) + 1) for n in range(least, size + 1))


def _longest(match: np.ndarray) -> int:
    """Words from a match to a match with at most one in eight others, at most."""
    hits = np.flatnonzero(match)
    if len(hits) == 0:
        return 0
    # For matches i < j: length hits[j]-hits[i]+1, others = length - (j-i+1).
    length = hits[None, :] - hits[:, None] + 1
    count = np.arange(len(hits))[None, :] - np.arange(len(hits))[:, None] + 1
    good = (length - count) <= length * EXCHANGED
    return int((length * (good & (count > 0))).max())


def on_diagonal(text: np.ndarray, item: np.ndarray, shift: int, least: int) -> bool:
    """Whether at ``shift`` the text has a piece of the item of at least ``least`` words with at most one in eight exchanged."""
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    if high - low < least:
        return False
    match = text[low + shift : high + shift] == item[low:high]
    return match.sum() >= least - int(least * EXCHANGED) and _longest(match) >= least


def off_diagonal(text: np.ndarray, item: np.ndarray, shift: int, slack: int, least: int) -> bool:
    """Whether the text has such a piece at shifts from ``shift`` to ``shift + slack`` and up to ``slack`` beyond, where words cut in two or run together shift the rest."""
    start, end = max(0, shift - slack), min(len(text), shift + len(item) + 2 * slack)
    part = text[start:end]
    if len(part) < least or not _has_run(part, item, start - shift, slack, least // (int(least * EXCHANGED) + 1)):
        return False
    return _aligned(part, item, least)


def _has_run(part: np.ndarray, item: np.ndarray, first: int, slack: int, run: int) -> bool:
    """Whether ``run`` words in a row agree on a diagonal at most ``2 * slack`` words off the expected one.

    Some stretch between two of the allowed edits is that long, so a pair without one can't pass the alignment.
    """
    for move in range(-2 * slack, 2 * slack + 1):
        low, high = max(0, first + move), min(len(item), first + move + len(part))
        if high - low < run:
            continue
        match = part[low - first - move : high - first - move] == item[low:high]
        if match.sum() >= run:
            gaps = np.flatnonzero(~match)
            edges = np.concatenate([[-1], gaps, [len(match)]])
            if np.diff(edges).max() - 1 >= run:
                return True
    return False


def _aligned(part: np.ndarray, item: np.ndarray, least: int) -> bool:
    """Whether some window of ``least`` words of the item is within an edit distance of one word in eight of a part of ``part``."""
    allowed = int(least * EXCHANGED)
    for begin in range(0, len(item) - least + 1):
        window = item[begin : begin + least]
        row = np.zeros(len(part) + 1, dtype=np.int32)
        steps = np.arange(len(part) + 1, dtype=np.int32)
        for i, word in enumerate(window):
            next_row = np.empty_like(row)
            next_row[0] = i + 1
            next_row[1:] = np.minimum(row[:-1] + (part != word), row[1:] + 1)
            row = np.minimum.accumulate(next_row - steps) + steps
            if row.min() > allowed:
                break
        else:
            return True
    return False


_INDEX: dict[str, Items] = {}


def _block(folder: str) -> Items:
    """The index of the items in a folder; a worker holds one."""
    if folder not in _INDEX:
        _INDEX.clear()
        tables = []
        for file in files.listing(folder, "*.parquet"):
            system, inner = files.filesystem(file)
            with system.open_input_file(inner) as opened:
                tables.append(pq.read_table(opened))
        rows = [(k, np.array(w, dtype=np.int64)) for t in tables for k, w in zip(t.column("_key").to_pylist(), t.column("_words").to_pylist())]
        _INDEX[folder] = Items(rows)
    return _INDEX[folder]


def folded_items(items: DataFrame, key: str, text: str) -> DataFrame:
    """``_key, _words, _size, _run``: ids of the folded words of each item that has some, and the words in a row that any piece has unchanged."""
    kind = items.schema[key].dataType.simpleString()

    def fold(batch):
        made = [word_ids(folded_words(t)) if t else np.zeros(0, dtype=np.int64) for t in column(batch, "_text")]
        full = [i for i, ids in enumerate(made) if len(ids)]
        sizes = [len(made[i]) for i in full]
        return pa.RecordBatch.from_arrays(
            [raw(batch, "_key").take(pa.array(full, pa.int32())), pa.array([made[i] for i in full], pa.list_(pa.int64())), pa.array(sizes, pa.int32()), pa.array([shared_run(least_words(n), n) for n in sizes], pa.int32())],
            names=["_key", "_words", "_size", "_run"],
        )

    source = items.select(F.col(f"`{key}`").alias("_key"), string_column(text).alias("_text"))
    return map_batches(source, fold, f"_key {kind}, _words array<bigint>, _size int, _run int")


def run_filter(folded: DataFrame, size: int) -> bytes:
    """The bits of the filter over the runs of all items. Each task gives one of the same fixed size; they come to the driver one by one."""

    def build(batches):
        made = RunFilter(size)
        for batch in batches:
            for words in column(batch, "_words"):
                made.add(np.array(words, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(made.bits.tobytes(), 1)], pa.binary())], names=["bits"])

    total = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in folded.select("_words").mapInArrow(build, "bits binary").toLocalIterator():
        total |= np.frombuffer(zlib.decompress(bytes(row[0])), dtype=np.uint8)
    return total.tobytes()


_FILTERS: dict[int, RunFilter] = {}


def suspect_stretches(df: DataFrame, key: str, text: str, packed: bytes, size: int, reach: int) -> DataFrame:
    """``key, _words``: ids of the words of the parts of texts within ``reach`` words of a run that the filter ``packed`` lets through."""
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias(key), string_column(text).alias("_text"))
    token = zlib.crc32(packed)

    def cut(batch):
        if token not in _FILTERS:
            _FILTERS.clear()
            _FILTERS[token] = RunFilter(size, zlib.decompress(packed))
        own = _FILTERS[token]
        at, parts = [], []
        for i, value in enumerate(column(batch, "_text")):
            if value:
                ids = word_ids(folded_words(value))
                for first, last in own.stretches(ids, reach):
                    at.append(i)
                    parts.append(ids[first:last])
        return pa.RecordBatch.from_arrays([raw(batch, key).take(pa.array(at, pa.int32())), pa.array(parts, pa.list_(pa.int64()))], names=[key, "_words"])

    return map_batches(source, cut, f"`{key}` {kind}, _words array<bigint>")


def leaked_items(df: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``key, item_key``: the texts that contain a piece of an item, at least half of its words in order in one stretch.

    Null and empty texts and items contain and are nothing. Pairs come out once, also for rows delivered twice. Texts are
    read and folded once, whatever the number of items; the blocks of items, of ``block_items`` at most on average, are
    held against the stretches that are left.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    item_kind = items.schema[item_key].dataType.simpleString()
    folded = checkpoint(folded_items(items, item_key, item_text))
    count, run, longest = folded.agg(F.count("*"), F.min("_run"), F.max("_size")).first()
    if not count:
        return spark.createDataFrame([], f"`{key}` {kind}, `{item_key}` {item_kind}")
    blocks = -(-count // block_items)
    folder = scratch_folder(spark)
    folded.select("_key", "_words", F.pmod(F.xxhash64("_words"), F.lit(blocks)).alias("_block")).repartition("_block").write.partitionBy("_block").parquet(folder)
    item_type = to_arrow_type(folded.schema["_key"].dataType)
    parts = checkpoint(suspect_stretches(df, key, text, zlib.compress(run_filter(folded, run), 1), run, longest + longest // 4 + 8))

    def search(number: int) -> DataFrame:
        own = files.join(folder, f"_block={number}")

        def find(batch):
            index = _block(own)
            at, found = [], []
            lists = raw(batch, "_words")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i in range(batch.num_rows):
                for item in index.find(values[ends[i] : ends[i + 1]]):
                    at.append(i)
                    found.append(index.keys[item])
            return pa.RecordBatch.from_arrays([raw(batch, key).take(pa.array(at, pa.int32())), pa.array(found, item_type)], names=[key, item_key])

        return map_batches(parts, find, f"`{key}` {kind}, `{item_key}` {item_kind}")

    return reduce(DataFrame.unionByName, map(search, range(blocks))).distinct()
