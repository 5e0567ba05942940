"""Text formatters: repair of encodings, masking of personal data, lines of symbols, text of web pages."""

from __future__ import annotations

import html
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Patterns and stand-ins of e-mail addresses and of IPv4 addresses that are no private or local ones.
EMAIL = r"(?<![\w.+\-])[A-Za-z0-9][\w.+\-]*@[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
EMAIL_MASK = "email@example.com"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
PUBLIC_IP = (
    r"(?<![\d.])(?!10\.|127\.|0\.|169\.254\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.|255\.)" + _OCTET + r"(?:\." + _OCTET + r"){3}(?![\d]|\.\d)"
)
IP_MASK = "22.214.171.124"
#: Typographic marks and their plain forms.
QUOTES = {"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"'}
_CONTROLS = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f​﻿￹-￻]")
_BROKEN = re.compile("[ÃÂâàð][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")


_FOREIGN = re.compile(r"[^\x00-\x7f]+")


def _decoded(run: re.Match) -> str:
    """A run of characters beyond ASCII, decoded once more if it is UTF-8 that was read as a one-byte encoding."""
    text = run.group()
    if not _BROKEN.search(text):
        return text
    try:
        return b"".join(bytes([ord(c)]) if ord(c) < 256 else c.encode("cp1252") for c in text).decode("utf-8")
    except UnicodeError:
        return text


def repaired(text: str | None) -> str | None:
    """The text after decoding what was decoded wrongly, entities outside markup, plain quotes, no control characters, NFC."""
    if text is None:
        return None
    if "<" not in text:
        text = html.unescape(text)
    for _ in range(3):
        again = _FOREIGN.sub(_decoded, text)
        if again == text:
            break
        text = again
    text = _CONTROLS.sub("", text).replace("\r\n", "\n").replace("\r", "\n").replace("\x85", "\n").replace(" ", "\n").replace(" ", "\n")
    for mark, plain in QUOTES.items():
        if mark in text:
            text = text.replace(mark, plain)
    return unicodedata.normalize("NFC", text)


@pandas_udf(T.StringType())
def repair_text(texts: pd.Series) -> pd.Series:
    """``repaired`` for a column; null stays null."""
    return texts.map(repaired, na_action="ignore")


@pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode's compatibility composition; null stays null."""
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def masked(text: Column, email: str = EMAIL_MASK, ip: str = IP_MASK) -> Column:
    """``text`` with e-mail addresses and public IP addresses replaced; private ones stay."""
    return F.regexp_replace(F.regexp_replace(text, EMAIL, email), PUBLIC_IP, ip)


def without_symbol_lines(text: Column, symbols: tuple[str, ...] = ("|",)) -> Column:
    """``text`` without lines of nothing but white space and ``symbols``; lines of white space alone stay."""
    marks = "".join("\\" + s for s in symbols)
    only = rf"^\s*[{marks}][{marks}\s]*$"
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(only)), "\n")


class _Page(HTMLParser):
    """Blocks of a page, with their text and the part of it inside links."""

    SKIPPED = {"script", "style", "nav", "header", "footer", "aside", "noscript", "template", "form", "button", "svg", "iframe", "select"}
    BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "pre", "blockquote", "dd", "dt", "figcaption", "div", "section", "article", "main", "br", "tr", "ul", "ol", "table", "body"}
    KEPT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "pre", "blockquote", "dd", "dt"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str, int]] = []
        self.path: list[str] = []
        self.skipped = self.linked = 0
        self.text: list[str] = []
        self.links = 0
        self.title = ""
        self.in_title = False

    def _close(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            kind = next((t for t in reversed(self.path) if t in self.BLOCKS), "div")
            self.blocks.append((kind, text, self.links))
        self.text, self.links = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIPPED:
            self.skipped += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "a":
            self.linked += 1
        elif tag in self.BLOCKS:
            self._close()
            if tag != "br":
                self.path.append(tag)

    def handle_endtag(self, tag):
        if tag in self.SKIPPED:
            self.skipped = max(0, self.skipped - 1)
        elif tag == "title":
            self.in_title = False
        elif tag == "a":
            self.linked = max(0, self.linked - 1)
        elif tag in self.BLOCKS:
            self._close()
            if tag in self.path:
                while self.path.pop() != tag:
                    pass

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.skipped:
            self.text.append(data)
            if self.linked:
                self.links += len(data.strip())


def main_text(page: str | None, link_share: float = 0.5) -> str | None:
    """Paragraphs, headings, items and cells of a page outside navigation, without blocks that are mostly links; null if none is left."""
    if not page:
        return None
    parser = _Page()
    try:
        parser.feed(page)
        parser.close()
    except (AssertionError, ValueError):
        return None
    parser._close()
    kept = [text for kind, text, links in parser.blocks if kind in _Page.KEPT and links <= link_share * len(text)]
    return "\n".join(kept) or None


@pandas_udf(T.StringType())
def page_text(pages: pd.Series) -> pd.Series:
    """``main_text`` for a column."""
    return pages.map(main_text)
