"""Which parts of a text are natural prose, and which are lists, tables or junk.

A text is cut into lines and these into sentences. Each part is judged by its own form; short lines without final
punctuation, which a careless chat and a list have in common, are judged together by their mean length.
"""

from __future__ import annotations

import re

from .lang import FREQUENT

#: Letters and the marks that belong to them, as the inside of a character class.
LETTERS = "A-Za-zªºÀ-ÖØ-öø-\u02af\u0300-\u036f\u0370-\u05c7\u05d0-\u065f\u066e-\u06d3\u06d5-\u0963\u0971-\u09e5\u09f0-\u0a65\u0a70-\u1fff\u200c\u200d\u3040-\ud7ff\U00010300-\U0001034f\U00020000-\U0002ffff"
#: Marks that end a sentence, and what may close after them: quotes, brackets, emphasis, white space.
_ENDS = frozenset(".!?।॥。！？…")
_CLOSERS = frozenset("\"'”’»«“)]*_\u200b \t\n\r\xa0\u3000")
_EMOTICONS = (":)", ";)", ":-)", ";-)", ":D", ";D", ":-D", ";-D", ":(", ";(", ":-(", ";-(")
_LAUGHTER = re.compile(r"lol|haha\w*")
_SENTENCES = re.compile(r"(?<=[.!?।॥…])[\"'”’»)]*\s+(?=\S)")
_CLEAN = re.compile(
    rf"(?<!\S)[\"'“”„«»‘’(\[¿¡*_—–-]*[{LETTERS}]+(?:['’.\-][{LETTERS}]+)*[.,;:!?…।॥)\]\"“”'’»*_]*(?!\S)"
)
_REPEATED = re.compile(r"([^\s\d])\1{4,}")
_MOJIBAKE = re.compile(r"[ÃÂ][\u0080-\u00bf ]|[àâð][\u0080-\u00bf¦¤€]|[\u0080-\u009f\ufffd]")
_CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]{5,}")
_NO_VOWEL = re.compile(r"[bcdfghjklmnpqrstvwxz]{3,}$")
_LOG = re.compile(r"\b0x[0-9a-f]{3,}|\[(?:TRACE|DEBUG|DBG|INFO|WARN|WARNING|ERR|ERROR|FATAL)\]|^\s*\d{1,2}:\d\d:\d\d|^\s*at [\w.$]+\(|Traceback \(most|^\d{4}-\d\d-\d\d[T ]\d\d:\d\d", re.I)
_MARKER = re.compile(r"^\s*(?:[-*•·◦–—▪‣●○➢+]|\(?\d{1,3}[.)\]]|\(?[a-zA-Z][.)]|\d{2}(?=\s)|\[[ xX]\]|[ivx]{1,4}[.)])\s+(?=\S)")
_QUANTITY = re.compile(r"^\s*\d+(?:[.,]\d+)?\s?(?:x|kg|g|mg|ml|cl|dl|l|un|pcs|pc|lb|oz|cm|mm|m|×)\s+\S", re.I)
_RULER = re.compile(r"^[\s=\-_+|*~#.:]{3,}$")
_CELL_TAG = re.compile(r"</?(?:td|th|tr|table|tbody|thead)\b", re.I)
_GAP = re.compile(r"\s{3,}|\t+")
_MENU_BREAK = re.compile(r"\s*[|/»>·•‹›→]\s*")
_COMMA = re.compile(r"[,;،、]\s+")
_CELL = re.compile(rf"[+\-$€£#]?\d[\d.,:/\-]*\s?[%\w]{{0,3}}$|[{LETTERS}][{LETTERS}'’.&\- ]*(?:\d[\d.,]*)?$|[–—\-.?]+$|n/a$|\*+[{LETTERS} ]+\*+$", re.I)
_UNUSUAL = re.compile(r"[|\t;<>=\[\]{}#@^~\\*/»·•§¬¦°\ufffd\x80-\x9fÃÂàâð_\d]|  |([^\s\d])\1{4,}|\S{30,}")
_NUMBERISH = re.compile(r"^[#$€£+\-~(]?(?:ID|v)?\d[\d.,:/\-%]*\)?$")

#: Captions of menus and buttons in the seven languages.
MENU_WORDS = frozenset(
    """home menu login logout register search share print next previous back top cart privacy contact about help settings
    download upload subscribe cookies accept sitemap faq terms account signup faqs news blog
    início entrar sair registrar cadastrar cadastre-se buscar pesquisar compartilhar imprimir próximo anterior voltar topo carrinho privacidade
    contato sobre ajuda baixar assinar aceitar conta
    inicio salir registrarse registro compartir siguiente atrás arriba carrito privacidad contacto ayuda descargar suscribirse cuenta
    startseite menü anmelden abmelden registrieren suche suchen teilen drucken weiter zurück nach oben warenkorb datenschutz kontakt hilfe konto
    accueil connexion déconnexion inscription chercher rechercher partager imprimer suivant précédent retour haut panier confidentialité aide compte
    मुखपृष्ठ होम मेन्यू मेनू लॉगिन पंजीकरण खोजें साझा छापें अगला पिछला वापस ऊपर कार्ट गोपनीयता संपर्क सहायता
    প্রচ্ছদ হোম মেনু লগইন লগ নিবন্ধন খুঁজুন অনুসন্ধান শেয়ার ছাপুন প্রিন্ট পরবর্তী আগের পেছনে উপরে কার্ট গোপনীয়তা যোগাযোগ সাহায্য""".split()
)


def ended(text: str) -> bool:
    """Whether a line ends in sentence punctuation, whatever closes after it (quotes, emoji, laughter), or in an emoji or emoticon.

    Reads from the end as far as closing marks go, however long the line is.
    """
    at = last = len(text.rstrip())
    smiled = False
    while at:
        c = text[at - 1]
        if c in _ENDS:
            return True
        if c in ")D(" and (mark := next((e for e in _EMOTICONS if text.endswith(e, 0, at)), None)):
            smiled |= at == last and c != "("
            at -= len(mark)
        elif c in _CLOSERS:
            at -= 1
        elif "\U0001f000" <= c <= "\U0001faff" or "\u2600" <= c <= "\u27bf" or c in "\ufe0f\u200d":
            smiled |= at == last and (c >= "\U0001f300" or c == "\ufe0f" and text[at - 2 : at - 1] >= "\U0001f300")
            at -= 1
        elif c.isalpha() and (space := text.rfind(" ", max(0, at - 64), at)) >= 0 and _LAUGHTER.fullmatch(text, space + 1, at):
            at = space
        else:
            break
    return smiled


def visible(text: str) -> int:
    """Characters that are not white space."""
    return len(text) - sum(map(text.count, (" ", "\n", "\t", "\r", "\xa0"))) if text else 0


def frequent_share(words: list[str]) -> float:
    """The largest share that one language's frequent words have among ``words``."""
    return max(sum(map(f.__contains__, words)) for f in FREQUENT.values()) / len(words) if words else 0.0


_ANY_FREQUENT = frozenset().union(*FREQUENT.values())


def _random_letters(words: list[str]) -> bool:
    """Most words are strings of letters that no language spells."""
    if sum(map(_ANY_FREQUENT.__contains__, words)) >= 0.1 * len(words):
        return False
    latin = [w for w in words if len(w) >= 3 and "a" <= w[0] <= "z"]
    if len(latin) < 4:
        return False
    return sum(1 for w in latin if _CONSONANTS.search(w) or _NO_VOWEL.match(w)) > 0.3 * len(latin)


def _is_menu(cells: list[str]) -> bool:
    short = [c for c in cells if c]
    if len(short) < 3 or any(len(c.split()) > 4 for c in short):
        return False
    known = sum(1 for c in short if not MENU_WORDS.isdisjoint(c.lower().split()))
    return known >= 0.4 * len(short)


def _are_cells(cells: list[str], most: float) -> bool:
    """Two or more cells of few words each, which are words, numbers, dates or blank."""
    if len(cells) < 2 or sum(len(c.split()) for c in cells) > most * len(cells):
        return False
    good = sum(1 for c in cells if not c.strip() or _CELL.match(c.strip()))
    said = sum(1 for c in cells if any(map(str.isalnum, c)))
    return good >= 0.7 * len(cells) and said >= 0.4 * len(cells)


def line_kind(line: str) -> str:
    """``p`` prose, ``l`` list, ``t`` table, ``j`` junk, ``x`` random letters, ``m`` captions, ``f`` named field, ``h`` heading, ``-`` ruler, ``s`` short and open, ``u`` long and open."""
    text = line.strip()
    if _RULER.match(text):
        return "-"
    words = text.lower().split()
    n = len(words)
    ends = ended(text)
    seen, dirty, clean = 0, 0, []
    if _UNUSUAL.search(text):
        seen = visible(text)
        if len(_MOJIBAKE.findall(text)) * 2 > 0.2 * seen:
            return "j"
        if _CELL_TAG.search(text):
            return "t"
        if _LOG.search(text):
            return "j"
        if text.count("|") >= 2:
            cells = [c.strip() for c in text.strip("|").split("|")]
            if _is_menu(cells):
                return "m"
            if _are_cells(cells, 4):
                return "t"
        if not ends or n < 8:
            if _are_cells([c for c in _GAP.split(text) if c.strip()], 2.5):
                return "t"
            for mark in (";", ","):
                times = text.count(mark)
                if times >= 2 and len(re.findall(mark + r"(?=\S)", text)) + text.endswith(mark) >= 0.8 * times and _are_cells(text.replace(",", ";").split(";"), 2.5):
                    return "t"
        broken = _MENU_BREAK.split(text)
        if len(broken) >= 4 and _is_menu(broken):
            return "m"
        clean = _CLEAN.findall(text)
        dirty = seen - sum(map(len, clean)) + sum(len(m.group()) for m in _REPEATED.finditer(text) if _CLEAN.match(m.group()))
    elif text.count(",") >= 2 and not ends and ", " not in text and _are_cells(text.split(","), 2.5):
        return "t"
    if not ends and not MENU_WORDS.isdisjoint(words):
        if n <= 3 and _is_menu(words * 3) or n >= 4 and sum(map(MENU_WORDS.__contains__, words)) >= 0.5 * n:
            return "m"
    marker = _MARKER.match(line)
    if _QUANTITY.match(text) and n <= 8 and not ends:
        return "l"
    if dirty > 0.45 * seen and not (marker and n <= 3) and not (n <= 6 and len(clean) >= 1 and "http" not in text and any(map(_NUMBERISH.match, words)) and dirty < 0.75 * seen and ends):
        if n >= 2 and n <= 6 and ":" in text and not any(len(w) > 24 for w in words):
            return "f"
        return "j"
    if n >= 4 and _random_letters(words):
        return "x"
    if marker:
        body = text[marker.end() - (len(line) - len(line.lstrip())) :].strip()
        m = len(body.split())
        if ends and m >= 2:
            return "p"
        if m > 9 and not _running_list(body):
            return "p"
        return "l"
    if text.endswith(":") and n <= 6:
        return "h"
    if ":" in text and not ends:
        name, _, value = text.partition(":")
        if 0 < len(name.split()) <= 3 and len(value.split()) <= 3:
            return "f"
    if ends:
        return "p"
    return "s" if n <= 8 else "u"


def _running_list(text: str) -> bool:
    """Items in a row between commas, with no sentence among them."""
    items = _COMMA.split(text)
    if len(items) < 5:
        return False
    sizes = [len(i.split()) for i in items]
    return sum(sizes) <= 5.5 * len(sizes) and sum(1 for s in sizes if s > 8) <= 0.1 * len(sizes)


_SENTENCE_INSIDE = re.compile(r"[.!?।॥…][\"'”’»)]*\s+\S")


def _unwrapped(found: list[list]) -> None:
    """Make short open lines prose where they are wrapped sentences: in a run of lines, some lines have a sentence's end inside.

    A list's items have none, however many there are.
    """
    first = 0
    while first < len(found):
        last = first
        while last < len(found) and found[last][0] in "sup":
            last += 1
        run = found[first:last]
        inside = sum(1 for x in run if x[3])
        if inside and sum(1 for x in run if x[0] == "s") >= 2 and inside >= 0.15 * len(run):
            for x in run:
                if x[0] == "s":
                    x[0] = "p"
        first = last + 1


#: Shapes that are no prose, by the kind of text they make: what ``shapes`` counts beside ``prose``.
SHAPES = {
    "marked": "list", "running": "list", "short": "list",
    "cells": "table", "fields": "table",
    "codes": "junk", "letters": "junk", "captions": "junk",
}
_SHAPE_OF = {"p": "prose", "u": "prose", "l": "marked", "r": "running", "t": "cells", "j": "codes", "x": "letters", "m": "captions"}


def shapes(text: str) -> dict[str, int]:
    """Visible characters of a text in ``prose`` and in each of the ``SHAPES``.

    Headings and rulers belong to the shape with most characters. A text of nothing but a heading or two is prose.
    """
    found: list[list] = []
    for line in text.splitlines():
        if not line.strip():
            continue
        kind = line_kind(line)
        if kind in "pu" and len(line) > 60:
            for sentence in _SENTENCES.split(line):
                own = "r" if _running_list(sentence) else kind
                found.append([own, visible(sentence), len(sentence.split()), False])
        else:
            found.append([kind, visible(line), len(line.split()), kind == "s" and _SENTENCE_INSIDE.search(line) is not None])
    _unwrapped(found)
    kinds = [x[0] for x in found]
    open_ = [x[2] for x in found if x[0] in "su"]
    mean_open = sum(open_) / len(open_) if open_ else 0
    fields = kinds.count("f")
    listed = kinds.count("l") + kinds.count("r")
    tables = kinds.count("t")
    short_open = kinds.count("s")
    total = dict.fromkeys(("prose", *SHAPES), 0)
    heading = 0
    for kind, seen, n, _ in found:
        shape = _SHAPE_OF.get(kind)
        if kind == "f":
            shape = "fields" if fields >= 3 or tables else None
        elif kind == "s":
            if mean_open >= 7.2 and n >= 3:
                shape = "prose"
            elif short_open >= 3:
                shape = "short"
            elif not (listed or tables or n <= 6):
                shape = "prose"
        elif kind == "-" and tables:
            shape = "cells"
        if shape is None:
            heading += seen
        else:
            total[shape] += seen
    total[max(total, key=total.get) if any(total.values()) else "prose"] += heading
    return total


KINDS = ("list", "table", "junk")


def kind_of(total: dict[str, int]) -> str | None:
    """``list``, ``table`` or ``junk`` if more than half of the visible characters is no prose; the largest of the three."""
    kinds = dict.fromkeys(KINDS, 0)
    for shape, kind in SHAPES.items():
        kinds[kind] += total[shape]
    if sum(kinds.values()) <= total["prose"]:
        return None
    return max(kinds, key=kinds.get)
