"""Languages of texts and of their segments, by rank-order profiles of character n-grams.

A profile ranks a language's n-grams by frequency. A text is compared to a profile by the out-of-place distance: the
sum, over the text's most frequent n-grams, of how far their rank is from that in the profile (Cavnar and Trenkle).
Every word has such a distance to each profile too, its n-grams all being of the first rank in it; the path through the
languages with the least sum of distances, where a change has a price, cuts the text. The nearest profile names each
piece, and ``und`` is the name of one that is far from all.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, raw, string_column
from .lang import LANGUAGES, code_of
from .prose import kind_of, shapes

#: Samples of each language that a profile is made of, at most; ranks kept; n-grams of a text that are compared.
SAMPLES_PER_LANGUAGE = 400
PROFILE_RANKS = 1500
TEXT_RANKS = 300
LONGEST_GRAM = 4
#: Price of a change of language, in n-grams that are missing from a profile.
SWITCH = 13.0
#: Distance from the nearest profile beyond which a piece of at least ``RUN_WORDS`` is in none of the languages; and the
#: distance and lead over the next profile of a piece of ``LONG_RUN`` words that stands between the languages, in none of them.
FARTHEST = 0.37
BETWEEN = (0.29, 0.16)
LONG_RUN = 30
UNKNOWN = "und"
#: Words between two runs of one language that are names or terms in it, at most.
NAME_WORDS = 3
#: Words in a row that make a language part of a text, and words of a text worth a finding.
RUN_WORDS = 8
LEAST_WORDS = 20
MEMO_WORDS = 150_000

_STRIP = re.compile(r"[\s\d!-&(-/:-@\[-`{-~¡-¿×÷‐-‖“-⁯₠-⯿।॥०-९০-৯\U0001f000-\U0001faff]+")


def _plain(word: str) -> str:
    """``word`` without accents of Latin letters."""
    if word.isascii():
        return word
    split = unicodedata.normalize("NFD", word)
    if "a" <= split[0] <= "z":
        return "".join(c for c in split if not "̀" <= c <= "ͯ")
    return word


def grams(word: str) -> list[str]:
    """The n-grams of a word between two blanks, for n up to ``LONGEST_GRAM``."""
    padded = f" {word} "
    size = len(padded)
    return [padded[i : i + n] for n in range(2, LONGEST_GRAM + 1) for i in range(size - n + 1)] + list(word)


def words_of(text: str) -> list[str]:
    """Lower-case words, of letters alone."""
    return _STRIP.sub(" ", text.lower().replace("’", "'")).split()


def make_profiles(samples: list[tuple[str, str]], ranks: int = PROFILE_RANKS) -> dict[str, list[str]]:
    """language -> its n-grams by falling frequency, from (language, text) pairs; texts count with and without accents."""
    counts: dict[str, Counter] = {}
    for language, text in samples:
        own = counts.setdefault(language, Counter())
        for word in words_of(text or ""):
            own.update(grams(word))
            bare = _plain(word)
            if bare != word:
                own.update(grams(bare))
    return {k: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:ranks]] for k, c in sorted(counts.items())}


class Profiles:
    """Profiles in arrays, with a memo of words; one for each Python worker."""

    def __init__(self, ranked: dict[str, list[str]]):
        self.languages = list(ranked)
        known = sorted({g for own in ranked.values() for g in own})
        self.gram_ids = {g: i + 1 for i, g in enumerate(known)}
        self.worst = PROFILE_RANKS
        self.ranks = np.full((len(known) + 1, len(self.languages)), self.worst, dtype=np.int32)
        for j, own in enumerate(ranked.values()):
            for rank, gram in enumerate(own):
                self.ranks[self.gram_ids[gram], j] = rank
        self._clear()

    def _clear(self) -> None:
        self.words: dict[str, int] = {"": 0}
        self.costs = np.zeros((1024, len(self.languages)), dtype=np.float32)
        self.grams: list[np.ndarray] = [np.zeros(0, dtype=np.int32)]

    def word_ids(self, words: list[str]) -> list[int]:
        """Ids of words as they stand in the text; punctuation and digits around them don't matter."""
        known = self.words
        try:
            return [known[w] for w in words]
        except KeyError:
            if len(known) > MEMO_WORDS:
                self._clear()
                known = self.words
            for w in words:
                if w not in known:
                    known[w] = self._learn(w)
            return [known[w] for w in words]

    def _learn(self, word: str) -> int:
        found = [self.gram_ids.get(g, 0) for part in words_of(word) for g in grams(part)]
        if not found:
            return 0
        ids = np.array(found, dtype=np.int32)
        n = len(self.grams)
        if n == len(self.costs):
            self.costs = np.concatenate([self.costs, np.zeros_like(self.costs)])
        # Each occurs once in the word, so all are of its first rank.
        self.costs[n] = self.ranks[ids].sum(axis=0) / self.worst
        self.grams.append(ids[ids > 0])
        return n

    def distances(self, word_ids: list[int]) -> np.ndarray:
        """Out-of-place distance to each profile, from 0 to 1, of the most frequent n-grams of the words."""
        chosen = [self.grams[i] for i in word_ids]
        ids = np.concatenate(chosen) if chosen else np.zeros(0, dtype=np.int32)
        if len(ids) == 0:
            return np.ones(len(self.languages))
        counts = np.bincount(ids)
        present = np.flatnonzero(counts)
        top = present[np.argsort(-counts[present], kind="stable")[:TEXT_RANKS]]
        out = np.abs(self.ranks[top] - np.arange(len(top), dtype=np.int32)[:, None])
        out[self.ranks[top] == self.worst] = self.worst
        return out.mean(axis=0) / self.worst


_PROFILES: dict[int, Profiles] = {}


def profiles(ranked: dict[str, list[str]], key: int) -> Profiles:
    if key not in _PROFILES:
        _PROFILES.clear()
        _PROFILES[key] = Profiles(ranked)
    return _PROFILES[key]


def _may_change(costs: np.ndarray, main: int) -> bool:
    """Whether the cheapest path can have a change at all, ``main`` being the language that is best for all words.

    A stretch between words of ``main``, or at one end, has as many changes as runs at least, so that one of its runs
    gains more than the price of a change on ``main``. A path without ``main`` gains one price in all.
    """
    gains = costs[:, main : main + 1] - costs
    sums = np.cumsum(gains, axis=0, dtype=np.float64)
    lowest = np.minimum(np.minimum.accumulate(sums, axis=0), 0.0)
    if (sums[0] > SWITCH).any() or (sums[1:] - lowest[:-1] > SWITCH).any():
        return True
    gains[:, main] = -np.inf
    return len(costs) > 1 and bool(gains.max(axis=1).sum() > SWITCH)


def _path(costs: np.ndarray) -> list[int]:
    """The cheapest language of each word where a change costs ``SWITCH``."""
    rows = costs.tolist()
    best = rows[0]
    before = [best]
    for row in rows[1:]:
        change = min(best) + SWITCH
        best = [(b if b <= change else change) + c for b, c in zip(best, row)]
        before.append(best)
    at = best.index(min(best))
    path = [at]
    for best in before[-2::-1]:
        least = min(best)
        if best[at] > least + SWITCH:
            at = best.index(least)
        path.append(at)
    return path[::-1]


def _runs(path: list[int]) -> list[list[int]]:
    """[first word, past the last, language] of each run; a name within a language belongs to it."""
    runs: list[list[int]] = []
    first = 0
    for i in range(1, len(path) + 1):
        if i < len(path) and path[i] == path[first]:
            continue
        if len(runs) > 1 and runs[-2][2] == path[first] and runs[-1][1] - runs[-1][0] <= NAME_WORDS:
            runs.pop()
            runs[-1][1] = i
        else:
            runs.append([first, i, path[first]])
        first = i
    return runs


def segment(text: str, model: Profiles) -> list[tuple[int, int, str, float]]:
    """(first word, words, language, confidence) of each run of one language; none for a text without words, or without profiles."""
    words = text.lower().split()
    if not words or not model.languages:
        return []
    ids = model.word_ids(words)
    costs = model.costs[ids]
    main = int(costs.sum(axis=0).argmin())
    runs = _runs(_path(costs)) if _may_change(costs, main) else [[0, len(words), main]]
    found = []
    for a, b, language in runs:
        away = model.distances(ids[a:b])
        nearest = language if b - a < RUN_WORDS else int(away.argmin())
        others = np.delete(away, nearest)
        second = float(others.min()) if len(others) else 1.0
        sure = max(0.0, min(1.0, (second - float(away[nearest])) / second)) if second else 0.0
        name = model.languages[nearest]
        far = float(away[nearest])
        if far > FARTHEST and b - a >= RUN_WORDS or b - a >= LONG_RUN and far > BETWEEN[0] and sure < BETWEEN[1]:
            name, sure = UNKNOWN, min(1.0, far)
        if found and found[-1][2] == name:
            f = found[-1]
            found[-1] = (f[0], f[1] + b - a, name, (f[3] * f[1] + sure * (b - a)) / (f[1] + b - a))
        else:
            found.append((a, b - a, name, sure))
    return found


def profiles_of(samples: DataFrame, language: str = "language", text: str = "text", per_language: int = SAMPLES_PER_LANGUAGE) -> dict[str, list[str]]:
    """Profiles from labelled samples, of up to ``per_language`` texts each; the sample is bounded by this parameter."""
    rows = samples.select(string_column(language).alias("language"), string_column(text).alias("text")).where("language IS NOT NULL AND text IS NOT NULL")
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("language").orderBy(F.xxhash64("text"), "text"))
    rows = rows.withColumn("_place", place).where(F.col("_place") <= per_language).drop("_place")
    return make_profiles([(code, r["text"]) for r in rows.toLocalIterator() if (code := code_of(r["language"])) in LANGUAGES])


def language_segments(df: DataFrame, key: str, text: str, samples: DataFrame) -> DataFrame:
    """``key, segment, first_word, words, language, confidence``: the runs of one language of every text.

    ``confidence`` is how much nearer the text's profile is to this language than to the next one, from 0 to 1. A run
    far from every profile has language ``und``, and this distance as its confidence. A null, empty or wordless text has one row with language ``und``, no words and confidence 0. Rows are handled one by one:
    equal rows give equal segments.
    """
    ranked = profiles_of(samples)
    token = hash(tuple((k, tuple(v)) for k, v in ranked.items()))
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias(key), string_column(text).alias("_text"))

    def find(batch):
        model = profiles(ranked, token)
        at, rows = [], []
        for i, value in enumerate(column(batch, "_text")):
            found = segment(value, model) if value else []
            for n, (first, words, language, sure) in enumerate(found or [(0, 0, "und", 0.0)]):
                at.append(i)
                rows.append((n, first, words, language, sure))
        keys = raw(batch, key).take(pa.array(at, pa.int32()))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64())
        return pa.RecordBatch.from_arrays([keys, *(pa.array(x, k) for x, k in zip(zip(*rows), kinds))], names=[key, "segment", "first_word", "words", "language", "confidence"])

    return map_batches(source, find, f"`{key}` {kind}, segment int, first_word int, words int, language string, confidence double")


def document_languages(df: DataFrame, key: str, text: str, samples: DataFrame) -> DataFrame:
    """``key, language, confidence, languages``: the language with most words of each document, and all with at least ``RUN_WORDS`` in a row."""
    segments = language_segments(df, key, text, samples)
    per = segments.groupBy(key, "language").agg(
        F.sum("words").alias("_words"), F.max("words").alias("_run"), (F.sum(F.col("confidence") * F.col("words")) / F.greatest(F.sum("words"), F.lit(1))).alias("_sure")
    )
    best = F.max_by(F.struct("language", F.col("_sure").alias("confidence")), F.struct("_words", "language"))
    return per.groupBy(key).agg(best.alias("_best"), F.sort_array(F.collect_set(F.when(F.col("_run") >= RUN_WORDS, F.col("language")))).alias("languages")).select(
        key, "_best.language", "_best.confidence", "languages"
    )


def mislabelled(df: DataFrame, key: str, text: str, label: str, samples: DataFrame) -> DataFrame:
    """``key, language``: the true languages of texts whose label is missing or wrong, or which are in several languages.

    One row for each language with at least ``RUN_WORDS`` words in a row; what is in none of the languages has none. Texts of fewer than ``LEAST_WORDS``
    blank-separated words and texts that are no natural prose are left out. Other notations of the right language are
    right. Distinct rows come out once.
    """
    ranked = profiles_of(samples)
    token = hash(tuple((k, tuple(v)) for k, v in ranked.items()))
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias(key), string_column(label).alias("_label"), string_column(text).alias("_text"))

    def find(batch):
        model = profiles(ranked, token)
        at, languages = [], []
        labels: dict[str | None, str | None] = {}
        for i, (value, given) in enumerate(zip(column(batch, "_text"), column(batch, "_label"))):
            if not value or value.count(" ") + value.count("\n") + value.count("\t") < 1 or len(value.split(None, LEAST_WORDS)) < LEAST_WORDS:
                continue
            if given not in labels:
                labels[given] = code_of(given)
            found = segment(value, model)
            present = sorted({language for _, words, language, _ in found if words >= RUN_WORDS and language != UNKNOWN})
            if not present or present == [labels[given]] or kind_of(shapes(value)) is not None:
                continue
            at += [i] * len(present)
            languages += present
        return pa.RecordBatch.from_arrays([raw(batch, key).take(pa.array(at, pa.int32())), pa.array(languages, pa.string())], names=[key, "language"])

    return map_batches(source, find, f"`{key}` {kind}, language string").distinct()
