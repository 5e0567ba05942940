"""Per-document text statistics, their exact ranks within the language, and outlier scores from the tails.

Every text has plain statistics (words, lines, symbols, common words...) and the shares of its visible characters in
shapes that are no prose. The reference are the different texts of a language that are prose but for less than half. Of
the scored statistics, all of them shares, the values among the reference are added up on ``GRID`` steps, ranked by a
range-partitioned sort with partition offsets, and give the probability of a value as extreme among prose. A text's
score is the sum of the surprises (-ln) of its tails; only the score decides, and the statistics whose tails weigh most
give the kind. As copies count once, and lists, tables and junk not at all, no text becomes natural by being frequent.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checkpoints import checkpoint
from ..functions.ranks import exact_ranks
from .common import column, map_batches, raw, string_column
from .lang import FREQUENT
from .prose import KINDS, SHAPES, ended, shapes

#: Steps of a share; at most languages x scored statistics x (GRID + 1) values are ranked, whatever the corpus.
GRID = 1000
PLAIN = (
    "words", "word_length", "symbol_ratio", "digit_ratio", "punctuated_lines", "common_words", "line_words",
    "sentence_words", "distinct_words", "comma_ratio",
)
#: The tail of a scored statistic in which unnatural texts lie: few ended lines and common words; many symbols and digits, much of any shape.
LOW_TAIL = ("punctuated_lines", "common_words")
HIGH_TAIL = ("symbol_ratio", "digit_ratio", *SHAPES)
SCORED = (*LOW_TAIL, *HIGH_TAIL)
#: The scored statistics that know nothing of the shapes of lines.
PLAIN_SCORED = tuple(s for s in SCORED if s not in SHAPES)
#: Score from which a text is no natural prose: as improbable among prose as e ** -CUT.
CUT = 26.0
#: The tails stand on ``PRIOR_TEXTS`` texts beside the corpus, so that small tables and rare languages have some too. Among
#: these the share of a shape falls exponentially, such that half a text of it reaches the cut; they say nothing on plain statistics.
PRIOR_TEXTS = 20
PRIOR_FALL = 2 * CUT
#: Stands for all languages together, against which texts of no language are ranked.
ANY = "*"
_STOPS = re.compile("[" + re.escape(".,;:!?।॥…\"'()[]{}«»“”„‘’¿¡|/*_~<>=+-–—•·◦") + "]+")
#: The languages of each frequent word.
_LANGUAGES_OF: dict[str, tuple[str, ...]] = {}
for _code, _words in FREQUENT.items():
    for _word in _words:
        _LANGUAGES_OF[_word] = (*_LANGUAGES_OF.get(_word, ()), _code)


def statistics(text: str) -> tuple[str, list[float]]:
    """Language by frequent words (``und`` if no word is one), and the ``PLAIN`` statistics."""
    lowered = text.lower()
    words = lowered.split()
    n = len(words)
    if n == 0:
        return "und", [0.0] * len(PLAIN)
    seen = sum(map(len, words))
    bare = _STOPS.sub(" ", lowered).split()
    hits = dict.fromkeys(FREQUENT, 0)
    for languages, n_found in Counter(map(_LANGUAGES_OF.get, bare)).items():
        for language in languages or ():
            hits[language] += n_found
    common = max(hits.values())
    code = next(c for c, h in hits.items() if h == common) if common else "und"
    lines = [x for x in text.split("\n") if x.strip()]
    ends = sum(map(text.count, ".!?।"))
    digits = sum(map(lowered.count, "0123456789"))
    kept = sum(map(len, bare))
    m = max(1, len(bare))
    return code, [
        n,
        seen / n,
        (seen - kept) / seen,
        digits / seen,
        sum(map(ended, lines)) / len(lines),
        common / m,
        n / len(lines),
        n / (1 + ends),
        len(set(bare)) / m,
        text.count(",") / n,
    ]


def text_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, language, text_hash``, the ``PLAIN`` statistics and the share of each of the ``SHAPES``, one row for each key.

    Of several rows of a key, the one with the greatest hash of its text stands for it. Null, empty and blank texts have
    language ``und`` and zeros. Columns of the table beside the two are ignored.
    """
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias(key), string_column(text).alias("_text"), F.coalesce(F.xxhash64(string_column(text)), F.lit(0)).alias("text_hash"))
    values = (*PLAIN, *SHAPES)
    schema = ", ".join([f"`{key}` {kind}", "text_hash bigint", "language string", *(f"{v} double" for v in values)])

    def measure(batch):
        codes, rows = [], []
        for value in column(batch, "_text"):
            code, own = statistics(value or "")
            total = shapes(value) if value else {}
            seen = max(1, sum(total.values()))
            codes.append(code)
            rows.append(own + [total.get(s, 0) / seen for s in SHAPES])
        columns = np.array(rows, dtype=np.float64).reshape(-1, len(values)).T
        return pa.RecordBatch.from_arrays([raw(batch, key), raw(batch, "text_hash"), pa.array(codes), *map(pa.array, columns)], names=[key, "text_hash", "language", *values])

    rest = F.struct("text_hash", "language", *values)
    return map_batches(source, measure, schema).groupBy(key).agg(F.max(rest).alias("_row")).select(key, "_row.*")


def tail_counts(stats: DataFrame) -> DataFrame:
    """``language, statistic, value, n, left, right, texts``: how many rows of a language have a value, one as low, one as high, and how many rows it has.

    ``stats`` has ``language`` and the ``SCORED`` statistics; values are steps of the grid. Ties count on both sides.
    Language ``*`` has those of all rows.
    """
    pairs = F.array(*(F.struct(F.lit(s).alias("statistic"), F.round(F.col(s) * GRID).cast("int").alias("value")) for s in SCORED))
    at = ("statistic", "value")
    own = (
        stats.select("language", F.explode(pairs).alias("at"))
        .groupBy("language", *(F.col(f"at.{c}").alias(c) for c in at))
        .agg(F.count("*").alias("n"))
    )
    both = own.select(F.explode(F.array("language", F.lit(ANY))).alias("language"), *at, "n")
    counts = both.groupBy("language", *at).agg(F.sum("n").alias("n"))
    ranked = exact_ranks(counts, ["language", "statistic"], ["value"], weight="n", name="below")
    totals = ranked.groupBy("language", "statistic").agg(F.sum("n").alias("texts"))
    return ranked.join(totals, ["language", "statistic"]).select(
        "language", "statistic", "value", "n", (F.col("below") + F.col("n")).alias("left"), (F.col("texts") - F.col("below")).alias("right"), "texts"
    )


def reference(stats: DataFrame) -> DataFrame:
    """The prose that texts are held against: different texts, by their hash, that are prose but for less than half."""
    other = sum((F.col(s) for s in SHAPES), F.lit(0.0))
    return stats.where((F.col("words") > 0) & (other < 0.5)).dropDuplicates(["text_hash"])


def surprises(counts) -> dict[str, np.ndarray]:
    """language -> -ln of the tail of each step (columns) of each scored statistic (rows), from the rows of ``tail_counts``."""
    steps = np.arange(GRID + 1)
    prior = {s: np.exp(-PRIOR_FALL * steps / GRID) if s in SHAPES else np.ones(GRID + 1) for s in SCORED}
    beyond = {ANY: np.zeros((len(SCORED), GRID + 1))}
    texts = {ANY: 0}
    for row in counts:
        table = beyond.setdefault(row["language"], np.zeros((len(SCORED), GRID + 1)))
        low = row["statistic"] in LOW_TAIL
        table[SCORED.index(row["statistic"]), row["value"]] = row["left"] if low else row["right"]
        texts[row["language"]] = row["texts"]
    for code, table in beyond.items():
        for i, s in enumerate(SCORED):
            # A step that no text has is as far out as the next one within.
            table[i] = np.maximum.accumulate(table[i]) if s in LOW_TAIL else np.maximum.accumulate(table[i][::-1])[::-1]
            table[i] = -np.log((table[i] + PRIOR_TEXTS * prior[s]) / (texts[code] + PRIOR_TEXTS))
    return beyond


def outlier_scores(stats: DataFrame, scored: tuple[str, ...] = SCORED) -> DataFrame:
    """``stats`` with ``score``, the sum of the surprises of the ``scored`` tails, and ``kind``, whose tails weigh most.

    ``kind`` is ``list``, ``table`` or ``junk``; a text that is improbable without any of their shapes is ``junk``. Texts
    without any frequent word, and those of languages that no prose has, are ranked among all. The table of tails has at
    most one row for each language, statistic and step of the grid, whatever the corpus.
    """
    tails = surprises(tail_counts(reference(stats)).toLocalIterator())
    used = [SCORED.index(s) for s in scored]
    of_kind = {k: [SCORED.index(s) for s in SHAPES if SHAPES[s] == k and s in scored] for k in KINDS}

    def score(batch):
        values = np.stack([np.rint(raw(batch, s).to_numpy(zero_copy_only=False) * GRID).astype(np.int64) for s in SCORED])
        codes = np.array(column(batch, "language"), dtype=object)
        own = np.zeros(values.shape)
        for code in set(codes):
            rows = np.flatnonzero(codes == code)
            table = tails[ANY if code == "und" or code not in tails else code]
            own[:, rows] = np.take_along_axis(table, values[:, rows], axis=1)
        weights = np.stack([own[of_kind[k]].sum(axis=0) for k in KINDS])
        heaviest = np.where(weights.max(axis=0) > 0, weights.argmax(axis=0), KINDS.index("junk"))
        kinds = np.array(KINDS, dtype=object)[heaviest]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(own[used].sum(axis=0)), pa.array(kinds, pa.string())], names=[*batch.schema.names, "score", "kind"])

    names = stats.columns
    fields = ", ".join(f"`{c}` {stats.schema[c].dataType.simpleString()}" for c in names)
    return map_batches(stats.select(*names), score, f"{fields}, score double, kind string")


def scored_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """Statistics of every row with its outlier score, and the kind of those whose score reaches ``CUT``."""
    return outlier_scores(checkpoint(text_statistics(df, key, text))).withColumn("kind", F.when(F.col("score") >= CUT, F.col("kind")))


def unnatural_texts(df: DataFrame, key: str, text: str, cut: float = CUT, scored: tuple[str, ...] = SCORED) -> DataFrame:
    """``key, kind`` of the texts whose outlier score among the prose of their language reaches ``cut``."""
    return outlier_scores(checkpoint(text_statistics(df, key, text)), scored).where((F.col("score") >= cut) & (F.col("words") > 0)).select(key, "kind")
