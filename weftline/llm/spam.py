"""Keyword-stuffed pages, link lists and tag pages, by rank-frequency curves and divergence from prose.

Every page's tokens (words, links, tags) give a rank-frequency curve, whose slope and residual come from SQL windows, and
its visible characters a distribution over classes of tokens. All three are held against those of prose pages of the
same language and comparable length: slope and residual by their distance from the median in median deviations, the
distribution by its divergence (Kullback and Leibler). Only these decide; copies of a text count once in the reference.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checkpoints import checkpoint
from .common import column, map_batches, raw, string_column
from .lang import FREQUENT
from .prose import LETTERS, ended, visible

#: Classes of visible characters; those of ``SPAM`` are keywords and offers, links, captions of links, tags.
SPAM = ("offer", "link", "caption", "tag")
CLASSES = ("binding", "repeated", "other", "mark", *SPAM)
#: A word that binds no sentence is a repeated one from so many times and such a share of the page's words.
REPEATED_TIMES, REPEATED_SHARE = 3, 0.03
#: The reference stands on ``PRIOR_PAGES`` pages beside those of the corpus, like these in their shares of classes, slope and
#: residual (quartiles), so that small tables and rare languages have one too; no share counts as rarer than ``RAREST``.
PRIOR_PAGES = 20
PRIOR_SHARES = dict(zip(CLASSES, (0.30, 0.04, 0.58, 0.07, 0.0025, 0.0025, 0.0025, 0.0025)))
PRIOR_QUARTILES = {"slope": (-0.6, -0.5, -0.4), "residual": (0.1, 0.15, 0.2)}
RAREST = 0.005
#: Divergence in nats, and median deviations of slope or residual, that are extreme by themselves. A page is flagged where the parts of these add up to one.
DIVERGENCE = 2.0
DEVIATIONS = 120.0
LINK = "://"

_URL = re.compile(r"(?:https?://|ftp://|www\.)[^\s<>\"')\]]+", re.I)
_MARKDOWN_LINK = re.compile(r"\[[^\[\]\n]*\]\(\s*(?:https?://|www\.|/)[^)\s]*\s*\)", re.I)
_ANCHOR = re.compile(r"<a\s[^<>]*>(?:(?!</?a\b).)*</a>", re.I)
_HASHTAG = re.compile(rf"#[{LETTERS}0-9०-९০-৯_\-]+")
_PRICE = re.compile(r"(?:[$€£₹¥]\s?\d[\d.,]*|\d[\d.,]*\s?(?:[$€£₹¥]|usd|eur|reais)|\bsku\s*:?\s*\d+|★+☆*|-\d{1,2}\s?%)", re.I)
_WORD = re.compile(rf"[{LETTERS}]+(?:['’][{LETTERS}]+)*")
_SEPARATED = re.compile(r"\s*[,;/|»•·>]\s*|\s+-\s+")
_SENTENCE = re.compile(r"(?<=[.!?।…])[\"'”’»)]*\s+")
#: Labels before tags, in the seven languages.
_TAG_LABEL = re.compile(
    r"^\W{0,3}(?:tags?|tagged(?: as| in)?|keywords?|key words|labels?|topics|filed under|categories|etiquetas|palavras[- ]chave|marcadores|palabras clave|categor[ií]as|schlagw[oö]rter|schlagworte|stichw[oö]rter|kategorien|mots[- ]cl[eé]s|[eé]tiquettes|cat[eé]gories|टैग|टैग्स|कीवर्ड|श्रेणियाँ|ট্যাগ|ট্যাগসমূহ|কীওয়ার্ড|বিভাগ)\s*[:：»>|\-–]\s*",
    re.I,
)
#: Words of offers, in the seven languages.
OFFER_WORDS = frozenset(
    """buy cheap cheapest sale sales discount discounts discounted store shop shopping online offer offers deal deals coupon promo bargain shipping clearance wholesale
    comprar compre barato barata baratos baratas promoção promocao desconto descontos loja lojas oferta ofertas frete cupom liquidação atacado
    compra barata descuento descuentos tienda tiendas envío rebaja rebajas cupón liquidación mayorista
    kaufen günstig günstige billig rabatt rabatte angebot angebote schnäppchen versandkostenfrei versand gutschein bestellen
    acheter pas-cher promo promotion promotions soldes livraison boutique boutiques remise réduction ligne cher
    खरीदें ख़रीदें सस्ता सस्ती सस्ते छूट दुकान ऑफर ऑफ़र ऑनलाइन डिलीवरी सेल कूपन
    কিনুন সস্তা ছাড় ছাড় দোকান অফার অনলাইনে অনলাইন ডেলিভারি সেল কুপন""".split()
)
#: Words that make an offer in company.
_OFFER_PHRASES = re.compile(
    r"\b(?:best|lowest|top|cheapest)\b[^.\n]{0,30}\b(?:price|prices|20\d\d)\b|\bnear me\b|\bfree shipping\b|\btop [^.\n]{1,30} 20\d\d\b|\bmelhor(?:es)? preços?\b|\bfrete gr[aá]tis\b|\bmejor(?:es)? precios?\b|\benv[ií]o gratis\b"
    r"|\bbeste[rn]? preise?\b|\bmeilleurs? prix\b|\bpas chers?\b|\ben ligne\b|\blivraison gratuite\b|सबसे कम दाम|मुफ़्त डिलीवरी|मुफ्त डिलीवरी|সেরা দাম|ফ্রি ডেলিভারি|সবচেয়ে কম দাম",
    re.I,
)
_FREQUENT = frozenset().union(*FREQUENT.values()) - OFFER_WORDS


def _prose_like(text: str, words: list[str]) -> bool:
    """A sentence: ended, with some length and some frequent words."""
    return len(words) >= 4 and ended(text) and sum(map(_FREQUENT.__contains__, words)) >= 0.12 * len(words)


#: Words of which each offer phrase has one, and marks and words of which each price has one.
_PHRASE_HINTS = frozenset(
    "best lowest top cheapest near shipping melhor melhores grátis gratis mejor mejores bester beste besten meilleur meilleurs pas ligne gratuite दाम डिलीवरी দাম ডেলিভারি".split()
)
_PRICE_MARKS = re.compile(r"[$€£₹¥★%]|\b(?:sku|usd|eur|reais)\b", re.I)


def _is_offer(text: str, words: list[str]) -> bool:
    """Keywords or phrases of offers rather than a sentence."""
    n = len(words)
    priced = _PRICE_MARKS.search(text) is not None
    if n == 0:
        return priced and _PRICE.search(text) is not None and len(_PRICE.sub("", text).split()) <= 2
    hits = sum(map(OFFER_WORDS.__contains__, words))
    if not _PHRASE_HINTS.isdisjoint(words):
        hits += len(_OFFER_PHRASES.findall(text))
    if priced:
        hits += len(_PRICE.findall(text))
    return hits * 7 >= n and hits > 0 and not _prose_like(text, words)


def _is_stuffed(words: list[str]) -> bool:
    """The same few words over and over, with hardly any that bind a sentence."""
    n = len(words)
    return n >= 12 and len(set(words)) <= 0.35 * n and sum(map(_FREQUENT.__contains__, words)) <= 0.12 * n


def _repeated_items(line: str) -> bool:
    """Short items in a row, many of them repeated."""
    items = [i.lower() for i in _SEPARATED.split(line.strip(" .,;|/»")) if i]
    if len(items) < 5 or sum(len(i.split()) for i in items) > 3 * len(items):
        return False
    return len(set(items)) <= 0.75 * len(items) and not any(any(c.isdigit() for c in i) for i in items)


def token_classes(text: str, by_line: bool = True) -> tuple[Counter, dict[str, int]]:
    """The page's tokens with their numbers, and its visible characters by class.

    Words are tokens, each link is one and the same token, and each tag its own. With ``by_line``, what stands in a
    line with links, labels of tags or keywords belongs to these; else only the links, tags and offer words themselves.
    """
    size = dict.fromkeys(CLASSES, 0)
    tokens: Counter = Counter()
    kept: list[str] = []
    kept_size = 0
    lines = [x for x in text.splitlines() if x.strip()]
    #: Short lines that a line of nothing but links may follow, with what they added.
    before: tuple[list[str], int] | None = None
    for line in lines:
        rest = line.strip()
        seen = visible(rest)
        linked = links = 0
        low = rest.lower()
        found = []
        if "](" in rest:
            found = [m.group() for m in _MARKDOWN_LINK.finditer(rest)]
            rest = _MARKDOWN_LINK.sub(" ", rest) if found else rest
        if "<a " in low:
            found += [m.group() for m in _ANCHOR.finditer(rest)]
            rest = _ANCHOR.sub(" ", rest)
        if "http" in low or "www." in low or "ftp:" in low:
            found += _URL.findall(rest)
            rest = _URL.sub(" ", rest)
        if found:
            links, linked = len(found), sum(map(visible, found))
            tokens[LINK] += links
            size["link"] += linked
        left = seen - linked
        tags = _HASHTAG.findall(rest) if "#" in rest else []
        if tags and not links and (not by_line or len(tags) >= 3 or len(_WORD.findall(_HASHTAG.sub(" ", rest))) <= len(tags)):
            tokens.update(t.lower() for t in tags)
            size["tag"] += sum(map(len, tags))
            left -= sum(map(len, tags))
            rest = _HASHTAG.sub(" ", rest)
        words = [w.lower() for w in _WORD.findall(rest)]
        tokens.update(words)
        previous, before = before, None
        if not by_line:
            kept += words
            kept_size += left
            continue
        if links:
            if not words and previous:
                # A short line right before a line of nothing but links is the links' caption.
                size["caption"] += previous[1]
                del kept[len(kept) - len(previous[0]) :]
                kept_size -= previous[1]
            if left and (len(words) <= 8 and not _prose_like(rest.strip(" -–—:|»>•*·"), words) or _is_offer(rest, words)):
                # What stands beside a link and is no sentence is its caption.
                size["caption"] += left
            else:
                kept += words
                kept_size += left
            continue
        if left <= 0 or not words and tags:
            size["tag"] += left
            continue
        label = _TAG_LABEL.match(rest)
        if label and not _prose_like(rest[label.end() :], words):
            size["tag"] += left
            continue
        if _is_stuffed(words) or _repeated_items(rest):
            size["offer"] += left
            continue
        hit = 0
        for sentence in _SENTENCE.split(rest) if len(rest) > 80 else [rest]:
            own = words if sentence is rest else [w.lower() for w in _WORD.findall(sentence)]
            if _is_offer(sentence, own) or _is_stuffed(own):
                hit += visible(sentence)
            else:
                kept += own
        hit = min(hit, left)
        size["offer"] += hit
        kept_size += left - hit
        if not hit and len(words) <= 6 and not ended(rest):
            before = words, left
    n = tokens.total()
    for word, times in Counter(kept).items():
        here = len(word) * times
        kept_size -= here
        if word in _FREQUENT:
            size["binding"] += here
        elif not by_line and word in OFFER_WORDS:
            size["offer"] += here
        elif tokens[word] >= REPEATED_TIMES and tokens[word] >= REPEATED_SHARE * n:
            size["repeated"] += here
        else:
            size["other"] += here
    size["mark"] += max(0, kept_size)
    return tokens, size


def page_profiles(df: DataFrame, key: str, text: str, by_line: bool = True) -> DataFrame:
    """``key, language, words, spectrum``, the visible characters of the ``CLASSES`` and ``text_hash`` of every page.

    ``words`` counts the tokens and ``spectrum`` has the numbers of distinct tokens by their frequency in the page. Null,
    empty and blank pages have language ``und`` and zeros. Of several rows of a key, the one with the greatest hash of
    its text stands for it.
    """
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias(key), string_column(text).alias("_text"), F.coalesce(F.xxhash64(string_column(text)), F.lit(0)).alias("text_hash"))
    pair = pa.struct([("times", pa.int32()), ("n", pa.int32())])

    def profile(batch):
        codes, words, spectra, sizes = [], [], [], []
        for value in column(batch, "_text"):
            tokens, size = token_classes(value or "", by_line)
            code, most = "und", 0
            for language, known in FREQUENT.items():
                hits = sum(map(tokens.__getitem__, known & tokens.keys()))
                if hits > most:
                    code, most = language, hits
            codes.append(code)
            words.append(tokens.total())
            spectra.append([{"times": t, "n": n} for t, n in sorted(Counter(tokens.values()).items(), reverse=True)])
            sizes.append(size)
        return pa.RecordBatch.from_arrays(
            [raw(batch, key), raw(batch, "text_hash"), pa.array(codes), pa.array(words, pa.int32()), *(pa.array([x[c] for x in sizes], pa.int64()) for c in CLASSES), pa.array(spectra, pa.list_(pair))],
            names=[key, "text_hash", "language", "words", *CLASSES, "spectrum"],
        )

    classes = ", ".join(f"{c} bigint" for c in CLASSES)
    made = map_batches(source, profile, f"`{key}` {kind}, text_hash bigint, language string, words int, {classes}, spectrum array<struct<times:int,n:int>>")
    return made.groupBy(key).agg(F.max(F.struct("text_hash", "language", "words", *CLASSES, "spectrum")).alias("_row")).select(key, "_row.*")


def rank_frequency(pages: DataFrame, key: str) -> DataFrame:
    """``pages`` with ``slope`` and ``residual`` of the line through (ln rank, ln frequency) of each page's tokens.

    Words of equal frequency share the mean of their ranks. A page of fewer than two distinct frequencies has slope and
    residual 0. ``key`` must tell pages apart.
    """
    rows = pages.select(key, F.inline("spectrum"))
    earlier = Window.partitionBy(key).orderBy(F.desc("times")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    x, y, w = F.ln(F.col("_before") + (F.col("n") + 1) / 2), F.ln("times"), F.col("n")
    sums = ranked.groupBy(key).agg(
        F.sum(w).alias("_w"), F.sum(w * x).alias("_x"), F.sum(w * y).alias("_y"), F.sum(w * x * x).alias("_xx"), F.sum(w * x * y).alias("_xy"), F.sum(w * y * y).alias("_yy")
    )
    sxx = F.col("_xx") - F.col("_x") * F.col("_x") / F.col("_w")
    sxy = F.col("_xy") - F.col("_x") * F.col("_y") / F.col("_w")
    syy = F.col("_yy") - F.col("_y") * F.col("_y") / F.col("_w")
    slope = F.when(sxx > 1e-9, sxy / sxx).otherwise(0.0)
    fitted = sums.select(
        F.col(key).alias("_key"), slope.alias("slope"), F.sqrt(F.greatest(F.lit(0.0), (syy - slope * sxy) / F.col("_w"))).alias("residual")
    )
    joined = pages.join(fitted, pages[key].eqNullSafe(fitted["_key"]), "left").drop("_key")
    return joined.fillna(0.0, ["slope", "residual"])


def page_deviations(pages: DataFrame, key: str) -> DataFrame:
    """``pages`` with ``slope``, ``residual``, ``divergence``, the deviations of slope and residual, and ``score``.

    The reference are different texts, by their hash, with at least a tenth of their characters in words that bind
    sentences and at most half in the classes of spam: neither copies nor spam become the norm. Shares and quartiles are
    those of the page's language and of lengths up to twice as long, drawn to those of the length in any language, and
    these to the fixed ones of ``PRIOR_PAGES`` pages, each by its number of pages, at every size alike. The divergence
    sums, over the classes of spam and repeated words, the share times the logarithm of how many times that of prose it is.
    """
    length = F.floor(F.log2(F.col("words") + 1)).cast("int")
    curves = checkpoint(rank_frequency(checkpoint(pages), key).drop("spectrum").withColumn("_length", length))
    total = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    spam = sum((F.col(c) for c in SPAM[1:]), F.col(SPAM[0]))
    share = {c: F.col(c) / F.greatest(total, F.lit(1)) for c in CLASSES}
    prose = curves.where((F.col("binding") * 10 >= total) & (spam * 2 <= total) & (total > 0)).dropDuplicates(["text_hash"])
    quarters = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    measures = [F.count("*").alias("n"), *(F.avg(share[c]).alias(c) for c in CLASSES), *(F.percentile_approx(c, quarters, 10_000).alias(c) for c in PRIOR_QUARTILES)]
    # At most one row for each language and power of two, those of all languages beside, from one pass.
    norms = checkpoint(prose.rollup("_length", "language").agg(F.grouping("language").alias("_any"), F.grouping("_length").alias("_every"), *measures).where("_every = 0"))
    by_both, by_length = norms.where("_any = 0"), norms.where("_any = 1")

    def drawn(n, own, to):
        """A mean of ``n`` pages, drawn to ``to`` as by ``PRIOR_PAGES`` pages; ``to`` where there is none."""
        return F.when(F.col(n) > 0, (F.col(n) * own + PRIOR_PAGES * to) / (F.col(n) + PRIOR_PAGES)).otherwise(to)

    def table(df, mark, keys):
        return F.broadcast(df.select(*keys, *(F.col(c).alias(f"{mark}{c}") for c in ("n", *CLASSES, *PRIOR_QUARTILES))))

    joined = curves.join(table(by_both.where("language <> 'und'"), "_a", ["language", "_length"]), ["language", "_length"], "left").join(table(by_length, "_b", ["_length"]), ["_length"], "left")

    def expected(c):
        return F.greatest(drawn("_an", F.col(f"_a{c}"), drawn("_bn", F.col(f"_b{c}"), F.lit(PRIOR_SHARES[c]))), F.lit(RAREST))

    def quartile(c, i):
        return drawn("_an", F.col(f"_a{c}")[i], drawn("_bn", F.col(f"_b{c}")[i], F.lit(PRIOR_QUARTILES[c][i])))

    def deviation(c):
        return (F.col(c) - quartile(c, 1)) / F.greatest((quartile(c, 2) - quartile(c, 0)) / 2, F.lit(0.01))

    divergence = sum((F.when(share[c] > 0, share[c] * F.ln(share[c] / expected(c))).otherwise(0.0) for c in ("repeated", *SPAM)), F.lit(0.0))
    extreme = F.greatest(F.abs(F.col("slope_deviation")), F.col("residual_deviation"))
    return (
        joined.withColumns({"divergence": divergence, "slope_deviation": deviation("slope"), "residual_deviation": deviation("residual")})
        .withColumn("score", F.col("divergence") / DIVERGENCE + extreme / DEVIATIONS)
        .select(*curves.drop("_length", "text_hash").columns, "divergence", "slope_deviation", "residual_deviation", "score")
    )


def spam_pages(df: DataFrame, key: str, text: str, by_line: bool = True) -> DataFrame:
    """``key`` of the pages whose slope, residual and divergence from prose are extreme together."""
    return page_deviations(page_profiles(df, key, text, by_line), key).where((F.col("score") >= 1) & (F.col("words") > 0)).select(key)
