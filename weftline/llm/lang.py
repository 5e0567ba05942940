"""Languages: notations of labels, scripts, frequent words."""

from __future__ import annotations

from pyspark.sql import functions as F

#: The languages that the operators tell apart.
LANGUAGES = ("pt", "en", "hi", "bn", "es", "de", "fr")

#: Names and three-letter codes of languages, with the two-letter code of each.
LANGUAGE_NAMES = {
    "por": "pt", "portuguese": "pt", "português": "pt", "portugues": "pt", "portugais": "pt", "portugiesisch": "pt", "portugués": "pt",
    "eng": "en", "english": "en", "inglês": "en", "ingles": "en", "inglés": "en", "anglais": "en", "englisch": "en",
    "hin": "hi", "hindi": "hi", "हिन्दी": "hi", "हिंदी": "hi",
    "ben": "bn", "bengali": "bn", "bangla": "bn", "বাংলা": "bn",
    "spa": "es", "spanish": "es", "español": "es", "espanol": "es", "castellano": "es", "espanhol": "es", "espagnol": "es", "spanisch": "es",
    "deu": "de", "ger": "de", "german": "de", "deutsch": "de", "alemão": "de", "alemán": "de", "allemand": "de",
    "fra": "fr", "fre": "fr", "french": "fr", "français": "fr", "francais": "fr", "francês": "fr", "francés": "fr", "französisch": "fr",
}

#: Labels that name no language.
NO_LANGUAGE = ("", "und", "unknown", "unk", "none", "null", "nan", "n/a", "na", "xx", "xxx", "zxx", "mul", "mis", "multi", "other", "?", "-")

#: Frequent words of each language (articles, pronouns, prepositions, conjunctions, auxiliaries, adverbs).
FREQUENT_WORDS = {
    "pt": """o a os as um uma uns umas de do da dos das em no na nos nas num numa por pelo pela pelos pelas para com sem sob sobre entre até desde
        e ou mas que se como quando porque embora enquanto então também não nem já ainda muito mais menos bem só tudo todo todos toda todas cada
        isso isto este esta estes estas esse essa aquele aquela ele ela eles elas nós você vocês eu me te lhe seu sua seus suas meu minha nosso nossa
        é são foi era ser está estão estava ter tem têm há havia pode podem vai ao à aos às depois antes durante segundo quem onde qual talvez sempre nunca
        aqui ali lá ao lado mesmo outro outra outros outras ninguém alguém nada fazer faz""",
    "en": """the a an of in on at to from by with without for about into over under between during after before since until and or but that which who
        whom whose what when where why how if then than because although though while as so not no nor is are was were be been being am have has had do
        does did will would can could should may might must shall it its he she they we you i me him her them us my your his their our this that these
        those there here all every each some any many much more most few other another only also very just still even never always perhaps nobody
        someone everyone nothing out up down off again""",
    "es": """el la los las un una unos unas de del en por para con sin sobre entre hasta desde hacia bajo y e o u pero que si como cuando porque aunque
        mientras entonces también no ni ya todavía aún muy más menos bien solo todo todos toda todas cada eso esto este esta estos estas ese esa aquel
        aquella él ella ellos ellas nosotros usted ustedes yo me te le les se lo su sus mi mis nuestro nuestra tu es son fue era ser está están estaba
        tener tiene tienen hay había puede pueden va al después antes durante según quien donde cual quizás quizá siempre nunca aquí allí mismo otro
        otra otros otras nadie alguien nada ha han qué cómo""",
    "de": """der die das den dem des ein eine einen einem einer eines von vom in im an am auf aus bei beim mit ohne für über unter zwischen nach vor seit
        bis zu zum zur durch gegen um und oder aber dass daß wenn weil obwohl während als wie da denn doch nicht kein keine keinen noch schon sehr mehr
        weniger nur auch alle alles jeder jede jedes jeden dies dieser diese dieses er sie es wir ihr ich du mich mir dich dir ihn ihm uns euch sich
        sein seine ihre mein meine unser unsere ist sind war waren sein werden wird wurde haben hat hatte können kann muss soll damit dann dort hier
        vielleicht immer nie niemand jemand nichts was wer wo man so falls solange laut""",
    "fr": """le la les l un une des de du d en dans par pour avec sans sur sous entre jusque depuis vers chez et ou mais que qu si comme quand parce bien
        pendant alors aussi ne n pas ni déjà encore très plus moins tout tous toute toutes chaque cela ce ceci cet cette ces il elle ils elles nous vous
        je j me te lui leur leurs se s son sa ses mon ma mes notre nos votre tu est sont était être été a ont avait avoir y au aux après avant durant
        selon qui où quel quelle peut peuvent fait peut-être toujours jamais ici là même autre autres personne rien on car puisque tant afin d'après c
        lorsque dont""",
    "hi": """का के की को ने से में पर तक और या एवं लेकिन मगर पर कि जो जब तब अगर यदि तो भी ही है हैं था थे थी हो होता होती होते हुआ हुई हुए रहा रही रहे
        गया गई गए कर करता करती करते किया किए नहीं न मत यह वह ये वे इस उस इन उन इसे उसे उन्हें इसके उसके उसका उसकी इसका इसकी अपना अपनी अपने मैं हम तुम
        आप मेरा हमारा हमारी हमारे एक दो कुछ सब सभी हर कई बहुत अधिक सबसे कोई किसी कौन क्या क्यों कैसे कहाँ कहा जाता जाती जाते लिए साथ बाद पहले बारे
        शायद अब अभी फिर यहाँ वहाँ बीच अनुसार दौरान क्योंकि ताकि हालाँकि जबकि""",
    "bn": """এবং আর ও বা অথবা কিন্তু তবে যে যা যারা যদি যখন তখন তাই কারণ যাতে যদিও এর এই সেই এ সে তা তার তাদের তারা আমি আমরা আমাদের আমার তুমি আপনি
        আপনার একটি একজন এক দুই কিছু সব সবাই প্রতি প্রতিটি অনেক বেশি সবচেয়ে খুব কেউ কে কী কি কেন কীভাবে কোথায় না নয় নেই হয় হয়ে হলো হল ছিল ছিলেন আছে
        আছেন করে করেন করেছে করা করতে থেকে দিয়ে নিয়ে জন্য সাথে সঙ্গে পরে আগে মধ্যে মাঝে উপর উপরে নিচে কাছে পাশে পর্যন্ত মতে অনুযায়ী সময় সম্পর্কে
        হয়তো এখন এখনও এখানে সেখানে আবার দেখে থাকে যায় বলা বড় শহরের""",
}
FREQUENT = {code: frozenset(words.split()) for code, words in FREQUENT_WORDS.items()}


def language_code(label: F.Column) -> F.Column:
    """The two-letter code that a label means in whatever notation: ``pt-BR``, ``POR``, ``por_Latn``, ``Portuguese``.

    Null where the label is null, blank or names no language; other labels give their first part in lower case.
    """
    clean = F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+$", ""))
    first = F.element_at(F.split(clean, "[-_. (;,/]"), 1)
    names = F.create_map(*(F.lit(x) for pair in LANGUAGE_NAMES.items() for x in pair))
    code = F.coalesce(names[clean], names[first], first)
    return F.when(clean.isin(*NO_LANGUAGE) | first.isin(*NO_LANGUAGE), F.lit(None).cast("string")).otherwise(code)


def code_of(label: str | None) -> str | None:
    """``language_code`` for one Python value."""
    clean = (label or "").strip().lower()
    first = clean.replace("_", "-").split("-")[0].split(" ")[0].split(".")[0].split("(")[0].strip()
    if clean in NO_LANGUAGE or first in NO_LANGUAGE:
        return None
    return LANGUAGE_NAMES.get(clean) or LANGUAGE_NAMES.get(first) or first


def words_language(words: list[str]) -> tuple[str, float]:
    """The language with the largest share of frequent words among ``words`` (lower case), and that share; ``und`` if there is none."""
    best, most = "und", 0
    for code, frequent in FREQUENT.items():
        hits = sum(map(frequent.__contains__, words))
        if hits > most:
            best, most = code, hits
    return best, most / len(words) if words else 0.0
