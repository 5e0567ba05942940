"""Language filters: shares of Unicode ranges, frequent words, labels and scores."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions.text import strip, word_tokens

_LATIN = r"A-Za-z"
_LATIN_1 = _LATIN + r"\x{C0}-\x{FF}"
#: Unicode ranges of the letters of each language, as the inside of a character class.
LETTER_RANGES = {
    "english": _LATIN,
    "portuguese": _LATIN_1,
    "spanish": _LATIN_1,
    "french": _LATIN_1,
    "german": _LATIN_1,
    "italian": _LATIN_1,
    "vietnamese": _LATIN_1 + r"\x{100}-\x{17F}",
    "russian": r"\x{400}-\x{4FF}",
    "ukrainian": r"\x{400}-\x{4FF}",
    "arabic": r"\x{600}-\x{6FF}",
    "greek": r"\x{370}-\x{3FF}",
    "hebrew": r"\x{590}-\x{5FF}",
    "hindi": r"\x{900}-\x{97F}",
    "bengali": r"\x{980}-\x{9FF}",
    "chinese": r"\x{4E00}-\x{9FFF}",
    "japanese": r"\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{4E00}-\x{9FFF}",
    "korean": r"\x{AC00}-\x{D7AF}",
    "thai": r"\x{E00}-\x{E7F}",
}
#: Ranges allowed in any language, first and last code point: controls, digits and ASCII punctuation, general
#: punctuation to number forms, arrows to technical signs, enclosed and drawing signs to dingbats, pictographs.
COMMON_RANGES = (
    (0x09, 0x0D), (0x20, 0x40), (0x5B, 0x60), (0x7B, 0x7E), (0x2000, 0x209F), (0x20A0, 0x20CF), (0x2100, 0x23FF), (0x2460, 0x24FF),
    (0x2500, 0x27BF), (0x2B00, 0x2BFF), (0x1F300, 0x1F64F), (0x1F680, 0x1F8FF), (0x1F900, 0x1FAFF),
)
#: Two-letter codes by language name.
CODES = {"english": "en", "portuguese": "pt", "spanish": "es", "french": "fr", "german": "de", "italian": "it", "hindi": "hi", "bengali": "bn"}
#: The most frequent words of some languages.
STOP_WORDS = {
    "en": "the of and to in is that it was for on are as with be at this have from not".split(),
    "pt": "o a os as de do da dos das em no na e que um uma para com não por se mais como".split(),
    "es": "el la los las de del en y que un una para con no por se más como su al".split(),
    "fr": "le la les de des du en et que un une pour dans est pas par sur au avec ce".split(),
    "de": "der die das den dem des und in von zu mit ist nicht ein eine für auf im auch sich".split(),
    "it": "il lo la gli le di del della in e che un una per con non si più come al".split(),
    "hi": "का के की है में और से को पर ने कि यह एक हैं नहीं तो भी था".split(),
    "bn": "এবং আর ও এই যে করে না থেকে জন্য হয় একটি কিন্তু তার এর যা সে মতে পরে".split(),
}


def known_languages(languages: Iterable[str], table: dict) -> list[str]:
    """Those of ``languages`` that ``table`` has, in lower case; an error if there are none."""
    found = [x.lower() for x in languages if x.lower() in table]
    if not found:
        raise ValueError(f"none of {list(languages)} is known; known are {sorted(table)}")
    return found


def allowed_class(languages: Iterable[str]) -> str:
    """Character class of all characters that texts of ``languages`` may have; unknown names are passed over."""
    common = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in COMMON_RANGES)
    return f"[{common}{''.join(LETTER_RANGES[x] for x in known_languages(languages, LETTER_RANGES))}]"


def allowed_share(text: Column, languages: Iterable[str]) -> Column:
    """Share of a text's characters that its languages allow; null for null and empty texts."""
    size = F.length(text)
    left = F.length(F.regexp_replace(text, allowed_class(languages), ""))
    return F.when(size > 0, (size - left) / size)


def in_unicode_ranges(text: Column, languages: Iterable[str], threshold: float = 0.85) -> Column:
    """Whether at least ``threshold`` of the characters are allowed; false for null and empty texts."""
    return F.coalesce(allowed_share(text, languages) >= threshold, F.lit(False))


def _hits(tokens: Column, stop_words: list[str]) -> Column:
    """How many of ``tokens`` are stop words."""
    return F.size(F.filter(tokens, lambda w: w.isin(*stop_words)))


def guessed_language(text: Column) -> Column:
    """The language most of whose stop words a text has, by code, the first in the alphabet among equals; null if it has none.

    Texts of fewer than ten characters without white space at the ends have none either.
    """
    tokens = word_tokens(F.lower(text))
    scores = F.array(
        *(
            F.struct(_hits(tokens, ws).alias("hits"), F.lit(-i).alias("order"), F.lit(code).alias("code"))
            for i, (code, ws) in enumerate(sorted(STOP_WORDS.items()))
        )
    )
    best = F.array_max(scores)
    return F.when((F.length(strip(text)) >= 10) & (best["hits"] > 0), best["code"])


def in_guessed_language(text: Column, languages: Iterable[str], guess: Callable[[Column], Column] = guessed_language) -> Column:
    """Whether ``guess`` finds one of ``languages``; false where it finds nothing. ``guess`` may be any other detector."""
    codes = [CODES[x] for x in known_languages(languages, CODES)]
    return F.coalesce(guess(text).isin(*codes), F.lit(False))


#: Longest n-grams of the detector, texts of each language that it is fitted on at most, n-grams kept of each, and the n-grams
#: that its scores are those of: the posterior of a stretch of so many, whatever the text's length.
LONGEST_GRAM, SAMPLES_PER_LANGUAGE, GRAMS_KEPT, SCORED_GRAMS = 3, 400, 20_000, 60


def _grams(text: str) -> chain:
    """N-grams of a text in lower case, white space as one blank and digits left out."""
    plain = " " + " ".join("".join(c for c in text.lower() if not c.isdigit()).split()) + " "
    return chain.from_iterable(map("".join, zip(*(plain[i:] for i in range(n)))) for n in range(1, LONGEST_GRAM + 1))


class NgramModel:
    """Naive Bayes over character n-grams, with equal chances of all languages beforehand."""

    def __init__(self, texts: list[tuple[str, str]], kept: int = GRAMS_KEPT):
        counts: dict[str, Counter] = {}
        for language, text in texts:
            counts.setdefault(language, Counter()).update(_grams(text))
        self.languages = sorted(counts)
        known = sorted({g for c in counts.values() for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:kept]})
        self.ids = {g: i for i, g in enumerate(known)}
        table = np.array([[counts[code][g] for code in self.languages] for g in known], dtype=np.float64).reshape(len(known), len(self.languages)) + 0.5
        #: Logarithms of the chance of each n-gram in each language; the last row stands for all others.
        self.logs = np.log(np.concatenate([table, np.full((1, len(self.languages)), 0.5)]) / (table.sum(axis=0) + 0.5))

    def scores(self, text: str | None) -> dict[str, float]:
        """language -> its posterior; none for a text without letters."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return {}
        counts = Counter(map(self.ids.get, _grams(text)))
        unknown = counts.pop(None, 0)
        at, n = np.fromiter(counts, dtype=np.int64, count=len(counts)), np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        total = self.logs[at].T @ n + self.logs[-1] * unknown
        mean = total / (n.sum() + unknown) * min(SCORED_GRAMS, n.sum() + unknown)
        made = np.exp(mean - mean.max())
        return dict(zip(self.languages, (made / made.sum()).tolist()))


def fitted_model(samples: DataFrame, language: str = "language", text: str = "text", per_language: int = SAMPLES_PER_LANGUAGE) -> NgramModel:
    """A model of labelled samples, of up to ``per_language`` texts of each language, by a hash of the text: the sample is bounded."""
    rows = samples.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(F.col(language).alias("l"), F.col(text).cast("string").alias("t"))
    place = F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("t"), "t"))
    return NgramModel([(r["l"], r["t"]) for r in rows.withColumn("n", place).where(F.col("n") <= per_language).toLocalIterator()])


def ngram_label(model: NgramModel, least: float = 0.01):
    """An Arrow function from texts to ``label, score, scores``: the likeliest language, and all of a posterior of at least ``least``; nulls for texts without letters."""

    @pandas_udf("label string, score double, scores map<string,double>")
    def label(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            found = model.scores(value)
            best = max(found, key=found.get) if found else None
            rows.append((best, found.get(best), {k: round(v, 6) for k, v in found.items() if v >= least} if found else None))
        return pd.DataFrame(rows, columns=["label", "score", "scores"])

    return label


def ngram_filter(df: DataFrame, text: str, model: NgramModel, languages: Iterable[str], least_score: float = 0.65, label_only: bool = False) -> DataFrame:
    """``df`` with ``language, language_score, language_scores`` by the model; unless ``label_only``, only rows in ``languages``, by code, with at least ``least_score``."""
    labelled = df.withColumn("_l", ngram_label(model)(F.col(text)))
    made = labelled.select(*(c for c in df.columns if c not in ("language", "language_score", "language_scores")), F.col("_l.label").alias("language"), F.col("_l.score").alias("language_score"), F.col("_l.scores").alias("language_scores"))
    return made if label_only else made.where(F.col("language").isin(*languages) & (F.col("language_score") >= least_score))


#: Detectors by name: (text, languages) -> keep.
BACKENDS: dict[str, Callable[..., Column]] = {"unicode": in_unicode_ranges, "words": in_guessed_language}


def language_filter(df: DataFrame, text: str, languages: Iterable[str], backend: str = "unicode", excluded: bool = False, **options) -> DataFrame:
    """Rows whose text is in ``languages``, or with ``excluded`` all other rows, those of null texts among them."""
    if backend not in BACKENDS:
        raise ValueError(f"unknown backend {backend}; known are {sorted(BACKENDS)}")
    keep = BACKENDS[backend](F.col(text), languages, **options)
    return df.where(~keep if excluded else keep)


def with_language_scores(df: DataFrame, text: str, least: float = 0.01) -> DataFrame:
    """``df`` with ``language_scores``, a map from codes to shares of stop words of at least ``least``; no row is removed."""
    tokens = word_tokens(F.lower(F.col(text)))
    hits = [_hits(tokens, ws) for _, ws in sorted(STOP_WORDS.items())]
    total = sum(hits[1:], hits[0])
    entries = F.array(*(F.struct(F.lit(c).alias("key"), F.round(h / F.greatest(total, F.lit(1)), 6).alias("value")) for (c, _), h in zip(sorted(STOP_WORDS.items()), hits)))
    return df.withColumn("language_scores", F.map_from_entries(F.filter(entries, lambda e: (e["value"] >= least))))


def language_score_filter(df: DataFrame, score: str = "language_score", least: float = 0.65) -> DataFrame:
    """Rows with a score of at least ``least``; null scores are dropped."""
    return df.where(F.col(score) >= least)


def check_codes(codes: Iterable[str], *tables: Iterable[str]) -> None:
    """An error unless all ``codes`` are in one and the same of ``tables``."""
    wanted = set(codes)
    if not any(wanted <= set(t) for t in tables):
        raise ValueError(f"codes {sorted(wanted)} are in none of the code lists")
