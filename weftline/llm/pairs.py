"""Defective question and answer pairs of conversations.

Ordered rules look at each pair: emptiness, copied questions, refusal phrases in seven languages, mismatch of script or
language, unclosed delimiters and abrupt endings. Every defect that a rule triggers is reported, with its place in the
order; the first is the pair's defect.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, raw
from .lang import FREQUENT
from .literals import GatedPattern
from .langid import Profiles, profiles, profiles_of
from .leakage import folded_words
from .prose import LETTERS, ended

DEFECTS = ("empty", "copied", "refusal", "other_language", "truncated")
ROLES = {"human": "user", "gpt": "assistant"}

#: Stand-ins for an answer that isn't there.
PLACEHOLDERS = frozenset(
    """none|null|nil|nan|n/a|na|n.a|n.a.|empty|blank|undefined|void|todo|tbd|tba|xxx|test|placeholder|answer|response|output|noanswer
    |no answer|no response|no output|not available|no data|answer here|your answer|your answer here|insert answer|insert answer here|lorem ipsum
    |no content|sem resposta|vazio|resposta|sin respuesta|vacío|respuesta|keine antwort|leer|antwort|pas de réponse|vide|réponse|sans réponse
    |कोई उत्तर नहीं|उत्तर नहीं|उत्तर|खाली|কোনো উত্তর নেই|উত্তর নেই|উত্তর|খালি""".replace("\n    ", "").split("|")
)
_PLACEHOLDER_MARK = re.compile(r"[\s<>\[\](){}\"'`*_#.\-:…​]")
#: Blanks and marks around a placeholder.
_PLACEHOLDER_EDGE = "".join(filter(_PLACEHOLDER_MARK.match, map(chr, range(0x3001))))
_ANY_LETTER = re.compile(rf"[{LETTERS}0-9٠-٩०-९০-৯]")

_REFUSALS = {
    "en": r"""\b(?:can(?:'|no)?t|can not|cannot|could not|couldn't|won't|will not|am not able|unable|not able|not allowed|not permitted|don't feel comfortable|do not feel comfortable|not comfortable|would rather not|i'd rather not|prefer not|must decline|have to decline|decline to|have to refuse|must refuse|refuse to|have to pass|not going to|not in a position|not willing)\b[^.!?]{0,60}\b(?:help|assist|answer|answering|respond|write|discuss|talk|provide|comply|fulfil|fulfill|do|support|share|request|question|topic|pass on|offer|engage|generate|produce|cover)
        |\b(?:outside|beyond) (?:of )?(?:what|the scope|my)|\bgoes? against (?:what|my)|\b(?:guidelines?|polic(?:y|ies)|rules|programming)\b[^.!?]{0,20}\b(?:do(?:es)? not|don't|doesn't|prohibit|forbid|prevent|won't)|\bi (?:must|have to|need to) (?:decline|refuse|pass)|\bi (?:decline|refuse)\b|\b(?:rather|prefer) not (?:to )?(?:discuss|talk|answer|say)|\bnot something i(?:'m| (?:can|am|will|would|do))\b|\bi(?:'ll| will| shall| would)(?: have to)? pass\b(?! (?:the|it|you|them|your|along)\b)|\b(?:find|ask) (?:someone|somebody) else\b|\bi am (?:sorry|afraid),? (?:but )?i (?:can'?no?t|can not)|\bhave to pass on this""",
    "pt": r"""\b(?:n[aã]o|nunca)\b[^.!?]{0,25}\b(?:posso|podemos|poderei|poderia|consigo|vou|irei|sou capaz|estou autorizad\w*|tenho permiss[aã]o|me sinto|me [ée] permitido|farei|atenderei|responderei)\b[^.!?]{0,60}\b(?:ajudar|auxiliar|responder|escrever|falar|discutir|tratar|atender|fornecer|comentar|cumprir|fazer|farei|pedido|assunto|tema|isso|opinar|oferecer|gerar)
        |\b(?:preciso|devo|tenho (?:de|que)|vou|terei (?:de|que)) (?:recusar|declinar|me recusar|negar|passar)|\brecuso(?:-me)?\b|\bprefiro n[aã]o\b|\bfora do que (?:posso|me)|\bvai contra (?:o que|as|minhas)|\bdiretrizes\b[^.!?]{0,15}\bn[aã]o|\b(?:al[ée]m|fora) d[aoe]\b[^.!?]{0,20}\b(?:posso|alcance|permitido)|\bn[aã]o (?:est[aá] ao meu alcance|tenho permiss[aã]o|posso ajudar|vou atender)|\bminhas (?:regras|pol[ií]ticas|normas)[^.!?]{0,15}n[aã]o""",
    "es": r"""\bno\b[^.!?]{0,25}\b(?:puedo|podemos|podr[eé]|podr[ií]a|voy a|soy capaz|estoy autorizad\w*|tengo permiso|tengo permitido|me siento|se me permite|me est[aá] permitido|atender[eé]|responder[eé])\b[^.!?]{0,60}\b(?:ayudar|asistir|responder|escribir|hablar|discutir|tratar|atender|proporcionar|comentar|cumplir|hacer|petici[oó]n|asunto|tema|esto|eso|ofrecer|c[oó]mod\w+|poder)
        |\bno (?:atender[eé]|responder[eé])|\b(?:debo|tengo que|voy a|he de|me veo obligad\w+ a) (?:rechazar|declinar|negar|rehusar)|\brechazo\b|\bprefiero no\b|\bfuera de lo que|\bva en contra de|\b(?:normas|directrices|pol[ií]ticas|reglas)\b[^.!?]{0,15}\bno (?:lo |me )?permiten|\bno tengo permiso""",
    "de": r"""\b(?:kann|k[oö]nnen|darf|werde|m[oö]chte|will)\b[^.!?]{0,70}\b(?:nicht|nichts|keine?|lieber nicht)\b[^.!?]{0,40}\b(?:helfen|beantworten|antworten|schreiben|sprechen|sagen|besprechen|behandeln|erf[uü]llen|nachkommen|bieten|k[oö]nnen|eingehen|reden|nachgehen|d[uü]rfen)
        |\b(?:dabei|damit|daf[uü]r|dar[uü]ber)\b[^.!?]{0,10}\b(?:kann|werde|darf|m[oö]chte|will) ich[^.!?]{0,25}\bnicht|\bnicht in der lage\b|\bmuss ich\b[^.!?]{0,30}\b(?:ablehnen|verweigern|passen)|\bich (?:muss|lehne)\b[^.!?]{0,40}\b(?:ablehnen|ab|passen)\b|\b(?:richtlinien|regeln|vorgaben)\b[^.!?]{0,15}\b(?:erlauben|gestatten|verbieten)|\bau(?:ß|ss)erhalb (?:dessen|von)|\bverst[oö](?:ß|ss)t gegen|\bnicht (?:erlaubt|gestattet)\b|\bf[uü]hle mich\b[^.!?]{0,20}\bnicht wohl|\bnicht wohl\b""",
    "fr": r"""\b(?:ne|n')\s?(?:peux|pourrai|pouvons|pourrais|vais|veux|suis|r[eé]pondrai|donnerai|me sens|souhaite)\b[^.!?]{0,20}\b(?:pas|point)\b[^.!?]{0,60}\b(?:aider|r[eé]pondre|[eé]crire|parler|discuter|traiter|fournir|mesure|autoris[eé]\w*|demande|sujet|suite|[aà] l'aise|capable|offrir|faire|donner)
        |\bje (?:dois|me vois)\b[^.!?]{0,20}\b(?:refuser|d[eé]cliner|passer)|\bje (?:refuse|d[eé]cline)\b|\bpr[eé]f[eè]re ne pas|\bd[eé]passe (?:ce|mes)|\bva [aà] l'encontre|\b(?:consignes|r[eè]gles|directives)\b[^.!?]{0,15}\bne (?:me )?(?:le |l')?(?:permettent|autorisent)|\bpas (?:autoris[eé]|en mesure|la permission|le droit|permis)|\bm'est (?:pas permis|interdit)|\ben dehors de ce que|\bne (?:donnerai|r[eé]pondrai|r[eé]ponds) pas""",
    "hi": r"""(?:नहीं|न)\s*(?:कर|दे|लिख|बता|बोल|कह|ब‍ात)?\s*(?:सकता|सकती|सकते|पाऊँगा|पाऊंगा|पाऊँगी|पाएँगे|करूँगा|करूंगा|दूँगा|दूंगा|लिखूँगा|चाहता|चाहूँगा)|सक(?:ता|ती|ते) नहीं|(?:मदद|सहायता|बात|उत्तर|जवाब|अनुरोध)[^।!?]{0,30}नहीं[^।!?]{0,12}(?:सक|पा|कर|दे)|इनकार|इन्कार|मना करना|अनुमति[^।!?]{0,12}नहीं|नहीं[^।!?]{0,10}अनुमति|दायरे (?:से|के) बाहर|के बाहर है|के ख़?िलाफ़|के विरुद्ध|न करना ही (?:बेहतर|उचित|ठीक)|न देना ही|सहज (?:नहीं|महसूस नहीं)|असमर्थ|बात न कर""",
    "bn": r"""(?:করতে|দিতে|লিখতে|বলতে|পারব|করা|সাহায্য)[^।!?]{0,12}(?:পারব না|পারছি না|পারি না|পারবো না|পারলাম না|চাই না)|পারব না|পারি না|পারছি না|ফিরিয়ে দিতে হচ্ছে|প্রত্যাখ্যান|অস্বীকার|অনুমতি[^।!?]{0,15}(?:নেই|দেয় না|নাই)|বিরুদ্ধে|(?:সীমার|আওতার|ক্ষমতার|এর|তার) বাইরে|না বলাই ভালো|না করাই ভালো|না দেওয়াই|স্বস্তি (?:বোধ করি না|পাই না)|স্বচ্ছন্দ[^।!?]{0,12}না|অক্ষম|অপারগ|রাজি নই|দিচ্ছি না|দেব না|করব না""",
}
#: What goes with a refusal without helping: apologies, offers of something else, referrals, reasons.
_CLOSERS = GatedPattern(
    r"\b(?:sorry|apolog\w+|unfortunately|regret|something else|anything else|another (?:question|topic)|else (?:to|i can)|specialist|professional|expert|as an ai|as a language model|different (?:question|topic)|please (?:ask|try)|contact|understand)\b"
    r"|\b(?:desculp\w+|perd[aã]o|infelizmente|lamento|sinto muito|outra coisa|outro assunto|algo diferente|mais alguma coisa|especialista|profissional|assistente de ia|como uma ia|modelo de linguagem|pergunte)\b"
    r"|\b(?:lo siento|perdon\w*|disculp\w*|lamentablemente|por desgracia|otra cosa|otro tema|algo distinto|algo m[aá]s|especialista|profesional|asistente de ia|modelo de lenguaje|pregunt[ae])\b"
    r"|\b(?:leid|leider|entschuldig\w+|verzeih\w+|bedaure|anderes|andere frage|sonst (?:noch )?etwas|fachmann|fachperson|experten?|fachleute|spezialist\w*|ki-assistent\w*|sprachmodell)\b"
    r"|\b(?:d[eé]sol[eé]e?|excus\w+|pardon|malheureusement|regrette|autre chose|autre question|autre sujet|sp[eé]cialiste|expert|professionnel|assistant ia|mod[eè]le de langue|posez)\b"
    r"|माफ़|माफ|क्षमा|खेद|दुर्भाग्य|अफ़सोस|किसी और|कुछ और|विशेषज्ञ|एआई|सहायक के रूप|भाषा मॉडल"
    r"|দুঃখিত|ক্ষমা|দুর্ভাগ্য|মাফ|অন্য কিছু|অন্য কোনো|বিশেষজ্ঞ|এআই|সহকারী হিসেবে|ভাষা মডেল|ভাষার মডেল হিসেবে",
)
_REFUSAL = GatedPattern("|".join("(?:" + p.replace("\n        ", "") + ")" for p in _REFUSALS.values()))
_SENTENCES = re.compile(r"(?<=[.!?।…])[\"'”’»)]*\s+|\n+")
_SPEAKER = re.compile(r"^\s*(?:>+\s*)*(?:(?:answer|assistant|response|ai|bot|gpt|a|q|question|user|resposta|respuesta|antwort|réponse|pergunta|pregunta|frage|उत्तर|जवाब|প্রশ্ন|উত্তর)\s*[:：]\s*)*", re.I)
_TRANSLATION = re.compile(
    r"\b(?:translat\w+|traduz\w*|tradu[cz]\w+|traduis\w*|traduire|übersetz\w+|in (?:english|german|french|spanish|portuguese|hindi|bengali)|auf (?:deutsch|englisch|französisch|spanisch|portugiesisch)|en (?:español|inglés|francés|alemán|portugués|anglais|espagnol|allemand|portugais|français)|em (?:inglês|espanhol|francês|alemão|português)|au? (?:inglés|francés|alemán|portugués|español))\b",
    re.I,
)
#: The same in Hindi and Bengali: a request by its verb, or "in" a language; a language or a translator
#: that is merely named asks for nothing.
_TRANSLATION_INDIC = re.compile(
    unicodedata.normalize(
        "NFC",
        r"अनुवाद\s*(?:कीजिए|कीजिये|कीजिएगा|करें|करो|करिए|करिये|करना|करके|कर\s*(?:के|दें|दो|दीजिए|दीजिये|सक\w*)|क्या|बता\w*|दें|दीजिए|चाहिए)|में अनुवाद"
        r"|(?:अंग्रेज़ी|अंग्रेजी|हिन्दी|हिंदी|बांग्ला|बंगाली|जर्मन|स्पेनिश|स्पैनिश|पुर्तगाली|फ़्रेंच|फ्रेंच|फ़्रांसीसी|फ्रांसीसी|रूसी|चीनी|अरबी|जापानी|उर्दू|तमिल|यूनानी|कोरियाई)\s*(?:भाषा\s*)?में"
        r"|অনুবাদ\s*(?:করুন|করো|কর(?=\s*[।!?]|\s*$)|করে\s*(?:দিন|দাও|দেবেন|দেবে)|করতে\s*(?:পার\w*|হবে)|কী|দিন|দাও|চাই)"
        r"|(?:ইংরেজি|ইংরেজী|হিন্দি|বাংলা|জার্মান|স্প্যানিশ|পর্তুগিজ|ফরাসি|রুশ|চীনা|আরবি|জাপানি|উর্দু|তামিল|গ্রিক|কোরীয়)(?:তে|য়|ে|\s*ভাষায়|\s*ভাষাতে)",
    )
)
#: Requests for languages of other scripts.
_OTHER_LANGUAGES = re.compile(
    r"\b(?:in|to|into) (?:russian|ukrainian|bulgarian|serbian|greek|hebrew|arabic|persian|farsi|urdu|chinese|mandarin|cantonese|japanese|korean|thai|tamil|telugu|marathi|gujarati|punjabi|nepali|sanskrit|georgian|armenian|bangla|cyrillic|devanagari|kanji)\b"
    r"|\b(?:english|german|french|spanish|portuguese|hindi|bengali|bangla|russian|greek|hebrew|arabic|persian|urdu|chinese|japanese|korean|thai|tamil|sanskrit) (?:word|words|name|term|phrase|translation|spelling|script|alphabet|letters?|version)\b"
    r"|\b(?:em|para o|para) (?:hindi|bengali|russo|grego|hebraico|árabe|chinês|mandarim|japonês|coreano)\b|\b(?:en|al) (?:hindi|bengalí|ruso|griego|hebreo|árabe|chino|mandarín|japonés|coreano)\b"
    r"|\b(?:auf|ins?) (?:hindi|bengalische?|bengali|russische?|griechische?|hebräische?|arabische?|chinesische?|japanische?|koreanische?)\b|\b(?:en|au) (?:hindi|bengali|russe|grec|hébreu|arabe|chinois|mandarin|japonais|coréen)\b",
    re.I,
)
_CODE = re.compile(r"```.*?(?:```|$)|`[^`\n]*`", re.S)
_URL = re.compile(r"(?:https?://|www\.)\S+")
_QUOTED = re.compile(r"[\"“„«][^\"“”„«»\n]{1,80}[\"”“»]")
_LIST_LINE = re.compile(r"^\s*(?:[-*•·◦–▪‣]|\(?\d{1,3}[.)]|[a-zA-Z][.)])\s+\S")
_BARE_MARKER = re.compile(r"^\s*(?:[-*•·◦–▪‣]|\(?\d{1,3}[.)])\s*$")
_FIGURE = re.compile(r"^[\s\d.,:/%°+\-–−~≈<>=€$£₹()^*xX]*(?:[A-Za-zµ²³%€$£₹°/]{1,6}[²³]?)?\s*$")
_EMOJI_END = re.compile(r"(?:[\U0001f000-\U0001faff☀-➿️‍]|[:;]-?[)D(P])\s*$")
_TRAILING = re.compile(r"[,;:\-–—(\[{/\\&+=<>*_#@~^|\"“„«'’‘]$")
_OPENERS = {"(": ")", "[": "]", "{": "}", "“": "”", "«": "»"}
_LINKING = {k: v - {"sim", "não", "no", "non", "nicht", "nicht", "pas", "not", "all", "alle", "todo", "tout", "it", "him", "them", "me", "isso", "eso", "cela", "so"} for k, v in FREQUENT.items() if k not in ("hi", "bn")}


def is_empty(answer: str | None) -> bool:
    """Null, blank, or no more than punctuation or a placeholder."""
    if answer is None:
        return True
    if not _ANY_LETTER.search(answer):
        return not re.search(r"[\U0001f300-\U0001faff]", answer)
    held = answer.strip(_PLACEHOLDER_EDGE)
    return len(held) <= 60 and held.lower() in PLACEHOLDERS


def is_copied(question: str | None, answer: str) -> bool:
    """The answer says nothing but the question, once or more, with small changes, perhaps behind a speaker's name."""
    if not question:
        return False
    plain, near = set(question.lower().split()), answer.lower().split()
    if sum(map(plain.__contains__, near)) < 0.4 * len(near):
        return False
    asked = folded_words(question)
    said = folded_words(_SPEAKER.sub("", answer))
    if len(said) < 3 or len(asked) < 3 or len(said) < 0.5 * len(asked):
        return False
    known = set(asked)
    if sum(w in known for w in said) < 0.85 * len(said):
        return False
    pairs = set(zip(asked, asked[1:]))
    follow = sum(p in pairs for p in zip(said, said[1:]))
    return follow >= 0.5 * (len(said) - 1)


def is_refusal(answer: str) -> bool:
    """Refusing sentences and what goes with them; besides these one remark before the refusal at most."""
    total = len(answer.split())
    refused = helpful = remarks = 0
    last = False
    for sentence in _SENTENCES.split(answer.lower().replace("’", "'")):
        size = len(sentence.split())
        if not size:
            continue
        if _REFUSAL.search(sentence):
            refused += size
            last = True
        elif not _CLOSERS.search(sentence):
            helpful += size
            remarks += 1
            last = False
            if remarks > 1 and helpful > 0.2 * (total - helpful):
                # Were all the rest refusing, it would still be too little.
                return False
    return refused > 0 and (helpful <= 0.2 * refused or last and remarks == 1 and helpful <= 30)


def asks_for_language(question: str) -> bool:
    """The question asks for a translation, or for an answer in some language."""
    if _TRANSLATION.search(question) or _OTHER_LANGUAGES.search(question):
        return True
    return not question.isascii() and _TRANSLATION_INDIC.search(unicodedata.normalize("NFC", question)) is not None


@lru_cache(maxsize=50_000)
def _script_of(character: str) -> str:
    """Script of a letter; empty for what is none."""
    if not character.isalpha():
        return ""
    name = unicodedata.name(character, "").split(" ")[0]
    return "CJK" if name in ("HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA") else name


def script_of(text: str) -> str:
    """Script of more than half of the letters, by the first word of their names; empty if there is none."""
    if text.isascii():
        return "LATIN" if any(map(str.isalpha, text)) else ""
    counts: Counter = Counter()
    for character, times in Counter(unicodedata.normalize("NFKC", text)).items():
        counts[_script_of(character)] += times
    del counts[""]
    script, most = max(counts.items(), key=lambda x: x[1], default=("", 0))
    return script if most * 2 > counts.total() else ""


def _beyond_scripts(answer: str, script: str) -> bool:
    """What is written alike in every language: figures with units, code, names and abbreviations in Latin, formulas in Greek letters."""
    if script == "GREEK":
        return not re.search(r"[Ͱ-Ͽἀ-῿]{3}", answer)
    if script != "LATIN":
        return False
    if _FIGURE.match(answer.strip()) or re.search(r"[=<>{}]|\w\(|\w_\w|[\w-]@\w", answer):
        return True
    words = re.findall(rf"[{LETTERS}0-9'’.+#&-]*[{LETTERS}][{LETTERS}0-9'’.+#&-]*", answer)
    return all(any(map(str.isdigit, w)) or not w[0].islower() for w in words) and not any(w.lower().strip(".'’-") in own for w in words for own in FREQUENT.values())


class Languages:
    """Scripts and languages of questions and answers; words in code, links and quotations don't count."""

    LEAST_WORDS = 4
    #: Lead per n-gram of the answer's language over the question's, and of the question's over the answer's.
    MARGIN = 0.03

    def __init__(self, model: Profiles):
        self.model = model

    @staticmethod
    def own_words(text: str) -> str:
        """``text`` without code, links and quotations."""
        if "`" in text:
            text = _CODE.sub(" ", text)
        if "://" in text or "www." in text:
            text = _URL.sub(" ", text)
        return _QUOTED.sub(" ", text)

    def costs(self, text: str) -> tuple[np.ndarray, int, int]:
        ids = self.model.word_ids(text.lower().split())
        grams = sum(map(len, map(self.model.grams.__getitem__, ids)))
        return self.model.costs[ids].sum(axis=0) if ids else np.zeros(len(self.model.languages)), max(1, grams), len(ids) - ids.count(0)

    def differ(self, question: str, answer: str) -> bool:
        """Whether the scripts differ, of however few words, or the languages by their n-grams."""
        question, answer = self.own_words(question), self.own_words(answer)
        script_asked, script_said = script_of(question), script_of(answer)
        if script_asked and script_said and script_asked != script_said and not _beyond_scripts(answer, script_said):
            return True
        asked, grams_asked, words_asked = self.costs(question)
        said, grams_said, words_said = self.costs(answer)
        if min(words_asked, words_said) < self.LEAST_WORDS or not self.model.languages:
            return False
        of_question, of_answer = int(asked.argmin()), int(said.argmin())
        if of_question == of_answer:
            return False
        return bool((said[of_question] - said[of_answer]) / grams_said > self.MARGIN and (asked[of_answer] - asked[of_question]) / grams_asked > self.MARGIN)


def is_truncated(answer: str) -> bool:
    """The answer stops before its sentence, list, bracket, quotation or block of code is finished."""
    text = answer.rstrip(" \t\r\n​\xa0")
    if text.count("```") % 2:
        return True
    if text.endswith("```"):
        return False
    text = re.sub(r"```.*?```", "", text, flags=re.S).rstrip()
    lines = [x for x in text.split("\n") if x.strip()]
    if not lines:
        return False
    last = lines[-1].strip()
    if _BARE_MARKER.match(last) and len(lines) > 1:
        return True
    if _URL.search(last.split()[-1]) or _FIGURE.match(last) or _EMOJI_END.search(last):
        return False
    for opener, closer in _OPENERS.items():
        if opener == "“" and "„" in last:
            opener, closer = "„", "“"
        if last.count(opener) > last.count(closer) and last.rfind(opener) > last.rfind(closer):
            return True
    if ended(last):
        return False
    if last.count('"') % 2:
        return True
    if _TRAILING.search(last) and not last.endswith(("*", "_", '"', "'", "’", "”", "|")):
        return True
    words = re.findall(rf"[{LETTERS}'’]+", last.lower())
    final = words[-1] if words else ""
    linking = any(final in own for own in _LINKING.values())
    if _LIST_LINE.match(lines[-1]):
        return linking or last.endswith((",", "("))
    if last.endswith(('"', "”", "»", ")", "]", "}", "|", "`", "*", "_")):
        return False
    if re.search(r"[=<>{};]|^\s*(?:SELECT|FROM|return|def|class|import)\b", last):
        return False
    # Prose without its end: other sentences of the answer do end, or it breaks off at a linking word, or is long.
    return linking or bool(re.search(r"[.!?।…](?:\s|$)", text[: -len(last)] + last[:-1])) or len(words) >= 5


def defects(question: str | None, answer: str | None, languages: Languages) -> list[str]:
    """Every defect of a pair, in the order of ``DEFECTS``."""
    if is_empty(answer):
        return ["empty"]
    found = []
    if is_copied(question, answer):
        found.append("copied")
    if is_refusal(answer):
        found.append("refusal")
    if question and languages.differ(question, answer) and not asks_for_language(question):
        found.append("other_language")
    if is_truncated(answer):
        found.append("truncated")
    return found


def role_of(role: str | None) -> str:
    clean = (role or "").strip().lower()
    return ROLES.get(clean, clean)


def defective_pairs(df: DataFrame, key: str, messages: str, samples: DataFrame) -> DataFrame:
    """``key, turn, place, defect``: every triggered defect of every user message directly followed by an assistant's.

    ``turn`` is the answer's position in the messages, from 0, and ``place`` that of the defect in the pair's order,
    from 0. Null or empty messages, and null roles, make no pairs; a null question can't be copied or mismatched.
    Equal rows come out once.
    """
    ranked = profiles_of(samples)
    token = hash(tuple((k, tuple(v)) for k, v in ranked.items()))
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{messages}`").alias("_messages"))

    def find(batch):
        languages = Languages(profiles(ranked, token))
        at, turns, places, names = [], [], [], []
        for i, row in enumerate(raw(batch, "_messages").to_pylist()):
            if not row:
                continue
            roles = [role_of(m["role"]) if m else "" for m in row]
            for turn in range(1, len(row)):
                if roles[turn] == "assistant" and roles[turn - 1] == "user":
                    for place, name in enumerate(defects(row[turn - 1]["content"], row[turn]["content"], languages)):
                        at.append(i)
                        turns.append(turn)
                        places.append(place)
                        names.append(name)
        return pa.RecordBatch.from_arrays(
            [raw(batch, key).take(pa.array(at, pa.int32())), pa.array(turns, pa.int32()), pa.array(places, pa.int32()), pa.array(names, pa.string())],
            names=[key, "turn", "place", "defect"],
        )

    return map_batches(source, find, f"`{key}` {kind}, turn int, place int, defect string").distinct()


def first_defects(df: DataFrame, key: str, messages: str, samples: DataFrame) -> DataFrame:
    """``key, turn, defect``: the first defect of each defective pair."""
    return defective_pairs(df, key, messages, samples).where("place = 0").select(key, "turn", "defect")
