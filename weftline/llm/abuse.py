"""Abusive, hateful or sexually explicit messages, by a weighted finite-state grammar.

Three transducers are composed. The lexical one reads the letters behind leet spelling, dots, stretched or starred
letters, elisions and object endings, and gives each word or phrase its classes: listed forms, and stems with any ending
for open classes such as verbs of harm. The pattern one, all patterns in one automaton, reads the classes of a clause
once and gives a weight to each pattern of insult, threat, hate or sexual content that it accepts: an insult needs a
target, a threat its victim, and a possessive is a target of its own noun only. The context one takes weight back where
the clause negates it, reports about words, tells of fiction, or speaks of games, machines or cooking. A clause's score
is the sum, a message's that of its worst clause; isolated words stay below the threshold.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .budget import slice_value
from .common import map_batches, raw

THRESHOLD = 1.0

#: Words and phrases by class, over all languages, between bars; ``*`` at the end stands for any ending.
#: I insult, W weak insult, T addressed person, t theirs, J announcement, h verb of harm, y with its object, b body or home, B fiction, M game, machine or kitchen, V dehumanising, v dehumanising of beasts, H hatred, D death or expulsion,
#: E deserving, Q all of a group, G group of people, P they, C curse, c dismissal, X violence announced, K wish,
#: S explicit, s sexual or naked, A soliciting, U undressing, F crude verb, N negation, R report about words.
LEXICON = {
    "I": """कायर*|घिनौन*|बेशर्म*|शर्म की बात|से भी ज़्यादा बेवकूफ़|कलंक|किसी काम का नहीं|দুশ্চরিত্র*|কাপুরুষ*|জঘন্য লোক|বোকা*|লজ্জা|কলঙ্ক|কোনো কাজের না|নির্বোধ*
        |plus bete que|plus con que|une honte|la honte de|lache|laches|meprisable|meprisables|incapable|bon a rien|bonne a rien|dechet humain|ordure humaine|ne vaux rien|ne vaut rien|me degoutes|me degoute|ridicule|pathetique|monstre|rate|ratee|degenere|degeneree|tocard|tare|taree|minus|cretinerie
        |dummer als|eine schande|die schande|feigling|feiglinge|feige|erbarmlich|erbarmlicher|erbarmliche|menschlicher abfall|menschlicher mull|abschaum|nichts wert|nichtsnutz|taugenichts|spinner|penner|lacherlich|ekelst mich an|kotzt mich an|widerling|vollpfosten|hohlkopf|schwachsinniger|missgestalt|monster|versagerin|ungeheuer
        |mas tonto que|mas tonta que|verguenza para todos|la verguenza de|cobarde|cobardes|despreciable|despreciables|engendro|basura humana|idiotez|retrasado|retrasada|mamarracho|no vales nada|no sirves para nada|das asco|me das asco|ridiculo|patetico|patetica|monstruo|fracasado|fracasada|imbecilidad|baboso|sinverguenza|perdedor|perdedora
        |burra como|mais burro que|mais burra que|vergonha para todos|vergonha para a|covarde|covardes|desprezivel|despreziveis|aberracao|lixo humano|escroto|escrota|retardado|retardada|jumento|anta|besta quadrada|nao vale nada|nao vales nada|nao presta|nao prestam|me da nojo|da nojo|asqueroso|asquerosa|ridiculo|ridicula|patetico|patetica|monstro|verme imundo|fracassado|fracassada|imprestavel
        |nitwit|nitwits|dimwit|halfwit|buffoon|numbskull|airhead|blockhead|simpleton|weirdo|freak|freaks|creep|lowlife|degenerate|degenerates|coward|cowards|spineless|brainless|gutless|worthless piece|waste of space|waste of oxygen|oxygen thief|disgrace|embarrassment|abomination|good for nothing|sack of garbage|sack of shit|human garbage|human trash|bag of shit|lunatic|psycho|repulsive|revolting|despicable|vile|contemptible|dumber than|stupider than|uglier than|disgust me|make me sick
        |idiot|idiots|moron|morons|stupid|dumb|dumbass|imbecile|cretin|loser|losers|worthless|pathetic|asshole|assholes|bastard|bastards|bitch|bitches|whore
        |whores|slut|sluts|retard|retarded|dickhead|scumbag|disgusting|filthy|fool|jerk|motherfucker|motherfuckers|douchebag|cunt|twat|wanker|piece of shit
        |piece of crap|idiota|idiotas|imbecil|imbecis|imbeciles|babaca|babacas|otario|otaria|otarios|inutil|inuteis|desgracado|desgracada|estupido|estupida
        |estupidos|cretino|cretina|nojento|nojenta|imundo|imunda|vagabundo|vagabunda|canalha|arrombado|puta|putas|filho da puta|filha da puta|pedaco de merda
        |corno|cuzao|trouxa|palerma|burro inutil|tonto|tonta|gilipollas|cabron|cabrones|asqueroso|asquerosa|pendejo|pendeja|hijo de puta|hija de puta
        |pedazo de mierda|capullo|subnormal|maricon|zorra|desgraciado|desgraciada|miserable|malnacido|inutiles|idiote|idiotes|cretine|cretins|abruti|abrutie
        |abrutis|connard|connards|connasse|salope|salopes|salaud|pute|putes|ordure|debile|stupide|fils de pute|encule|enculee|batard|minable|pauvre con|gros con
        |sale con|espece de con|sale creature|idioten|vollidiot|dummkopf|arschloch|arschlocher|wichser|hurensohn|hure|schlampe|missgeburt|trottel|versager
        |blodmann|schwachkopf|depp|drecksau|mistkerl|miststuck|stuck scheisse|stuck dreck|widerlich|widerliche|widerliches|widerlicher|dreckig|dreckige
        |dreckiges|dreckiger|dumme sau|blode kuh|बेवकूफ*|मूर्ख*|कमीन*|हरामी*|हरामज*|नालायक*|चूतिय*|मादरचोद*|भोसड*|घटिया|निकम्म*|नीच|कुतिया|रंडी*|বেকুব*|মূর্খ*
        |হারামজাদ*|শয়তান*|অপদার্থ*|খানকি*|বেশ্যা*|মাগি*|শালা|হারামি*|ছোটলোক|নির্লজ্জ|কুলাঙ্গার""",
    "W": """pig|pigs|rat|rats|donkey|ass|dog|swine|cow|ugly|trash|garbage|worm|snake|monkey|ape|clown|crap|shit|useless|dirty|creature|burro|burra|porco|porca|rato
        |ratos|lixo|feio|feia|verme|cobra|macaco|cachorro|palhaco|merda|vaca|animal|criatura|cerdo|cerda|rata|ratas|basura|feo|fea|gusano|perro|perra|mono
        |payaso|mierda|mierdas|bestia|porc|cochon|moche|chien|chienne|singe|dechet|dechets|merde|ane|bouffon|sale|bete|schwein|schweine|ratte|ratten|esel|hund
        |affe|hasslich|hasslicher|dumm|dummer|mull|abfall|dreck|scheisse|scheiss|geschopf|kuh|गधा|गधे|गधी|सुअर*|सूअर*|कुत्ता|कुत्ते|कुत्तों|कचरा|कचरे|बदसूरत
        |बंदर|कीड़ा|जानवर|उल्लू|गंदा|गंदे|गंदी|গাধা|গাধার|শুয়োর*|কুত্তা*|কুকুর|আবর্জনা|কুৎসিত|বাঁদর|বানর|জানোয়ার*|ছাগল|গরু|নোংরা""",
    "T": """como tu|you|you're|youre|yourself|u|yall|thou|thee|ya|voce|voces|te|ti|t|contigo|usted|ustedes|eres|toi
        |vous|vos|tu es|tu n|tu ne|tu me|tu m|tu eres|tu seras|tu sera|du|dich|dir|ihr|euch|bist|तू|तुझ|तुझे|तुझको|तुम
        |तुम्हें|तुमको|तुमसे|तुझसे|তুই|তোকে|তোরা|তুমি|তোমাকে|তোমরা""",
    "t": """your|yours|ur|thy|seu|seus|sua|suas|teu|tua|teus|tuas|tu|tus|ton|ta|tes|votre|dein|deine|deinen|deiner|deinem|euer|eure
        |तेरा|तेरे|तेरी|तुम्हारा|तुम्हारे|तुम्हारी|তোর|তোদের|তোমার|তোমাদের""",
    "J": """i'll|i will|i'm going to|i am going to|i'm gonna|gonna|we'll|we will|we're going to|we are going to|we're gonna|vou|vamos|irei|voy|vamos a|je vais|j' vais|on va
        |nous allons|ich werde|werde ich|wir werden|ich""",
    "h": """kill|murder|stab|shoot|strangle|choke|burn|slash|punch|beat|hurt|crush|smash|destroy|break|cut|slit|hang|gut|bury|skin|hit|slap|kick|drown|poison|torture|slaughter
        |behead|cripple|maim|matar|matarte|esfaquea*|estrangul*|queimar|socar|espanca*|bater|quebrar|machuca*|arrebent*|enforca*|enterrar|afogar|degola*|atropela*|torturar|apedreja*
        |apunala*|golpea*|partir|romper|quemar|ahorca*|enterrarte|degolla*|disparar*|pegarte|ahogar*|envenena*|acuchilla*|reventar*|machacar*|poignarder|tuer|etrangle*|frapper|casser|cogner|bruler
        |egorge*|pendre|enterrer|defoncer|noyer|empoisonner|ecraser|massacrer|tabasser|erstechen|umbringen|toten|erwurgen|verprugeln|verbrennen|abstechen|erschiessen|zerquetschen
        |aufschlitzen|ertranken|vergiften|ermorden|zusammenschlagen|fertigmachen|brechen""",
    "b": """throat|neck|face|teeth|tooth|bones|bone|legs|leg|house|home|head|skull|nose|arms|arm|fingers|ribs|eyes|car|family|cara|pescoco|dentes|ossos|pernas|casa|cabeca|nariz|bracos|dedos|olhos
        |familia|cuello|garganta|dientes|huesos|piernas|cabeza|brazos|ojos|gueule|figure|cou|gorge|dents|os|jambes|maison|tete|nez|bras|doigts|yeux|famille|kehle|hals|gesicht|zahne|knochen|beine|haus
        |kopf|schadel|nase|arme|finger|augen|familie|गला|गले|मुँह|हड्डियाँ|टाँगें|हाथ|सिर|দাঁত|গলা|মুখ|হাড়|পা|মাথা""",
    "B": """novel|novel's|film|movie|story|tale|play|character|villain|hero|scene|script|actor|actress|book|poem|song|lyrics|chorus|quote|fiction|comic|romance|filme|conto|historia|peca|personagem
        |vilao|cena|roteiro|livro|poema|musica|cancao|novela|pelicula|cuento|obra|personaje|villano|escena|guion|libro|cancion|roman|conte|histoire|piece|personnage|mechant du|scene|livre|poeme
        |chanson|geschichte|marchen|stuck|figur|bosewicht|schurke|held|szene|drehbuch|buch|gedicht|lied|उपन्यास|फ़िल्म|फिल्म|कहानी|नाटक|खलनायक|नायक|किताब|कविता|गीत|উপন্যাস*|সিনেমা*|গল্প*|নাটক*
        |খলনায়ক*|নায়ক*|বই*|কবিতা*|গান*""",
    "M": """chess|game|games|match|race|record|score|level|boss|player|team|process|processes|server|thread|queue|task|job|zombie|port|eggs|butter|dough|recipe|photo|photos|drum|drums|virus|cells|tumor
        |deadline|budget|xadrez|jogo|partida|corrida|recorde|processo|servidor|fila|tarefa|ovos|massa|receita|celulas|ajedrez|juego|carrera|marca|proceso|cola|tarea|huevos|masa|receta|echecs|jeu
        |partie|course|processus|serveur|file|tache|oeufs|pate|recette|cellules|schach|spiel|partie|rennen|rekord|prozess|prozesse|aufgabe|eier|teig|rezept|zellen|शतरंज|खेल|रिकॉर्ड|सर्वर|दाबा|দাবা|খেলা|রেকর্ড|সার্ভার""",
    "V": """inferior|inferiors|inferiores|minderwertig*|inferieurs|inferieures|should obey|belong in cages|nao sao gente|no son personas|keine menschen|pas des humains
        |subhuman|subhumans|sub-human|sub-humans|filth|scum|savages|dirty animals|dirty beasts|filthy animals|disgusting animals|inferior race|lesser race|not human
        |less than human|sub-humano|sub-humanos|sub-humanas|subhumano|subhumanos|subumano|subumanos|escoria|imundicie|animais imundos|animais sujos|animais nojentos
        |raca inferior|ralé|infrahumano|infrahumanos|animales asquerosos|animales sucios|bestias inmundas|animales inmundos|raza inferior|inmundicia|inmundos|sous-homme|sous-hommes|sous-humain
        |sous-humains|racaille|animaux repugnants|animaux sales|sales betes|animaux degoutants|race inferieure|sales betes|sales animaux|untermensch|untermenschen|abschaum|dreckige tiere
        |widerliche tiere|schmutzige tiere|gesindel|pack|minderwertig|गंदे जानवर|इंसान नहीं|नीच जाति|घटिया लोग|गंदगी|গন্দগী|নোংরা জানোয়ার|নোংরা পশু|মানুষ নয়
        |অমানুষ|নিকৃষ্ট|ময়লা|জঘন্য""",
    "v": """plague on|a plague|uma praga|una plaga|eine plage|un fleau|fleau|a disease|thieves by birth|filthy thieves|चोर हैं|চোর
        |vermin|parasites|cockroaches|insects|animals|beasts|worms|rats|thieves|criminals|disease|plague|cancer|leeches|pests|vermes|parasitas|baratas|insetos
        |animais|bichos|ladroes|criminosos|praga|parasitos|cucarachas|insectos|animales|bestias|gusanos|ladrones|criminales|plaga|alimanas|sabandijas|vermine
        |cafards|insectes|animaux|betes|voleurs|criminels|nuisibles|ungeziefer|parasiten|kakerlaken|insekten|tiere|bestien|diebe|verbrecher|schadlinge|plage
        |seuche|कीड़े|कीड़े मकोड़े|कीड़े-मकोड़े|परजीवी|जानवर|चोर|दरिंदे|কীটপতঙ্গ|পোকামাকড়|পরজীবী|জানোয়ার|চোর|পশু|কীট""",
    "H": """hate|hates|despise|detest|loathe|odeio|odiamos|detesto|desprezo|odio|desprecio|hais|haissons|deteste|detestons|meprise|hasse|hassen|verabscheue
        |verachte|नफ़रत|नफरत|घृणा|घिन|ঘৃণা|ঘেন্না""",
    "D": """wiped off|wiped from|wipe off|erased|eradicated|purged|cleansed|lynched|drowned|in cages|locked up forever|get cancer|died|rot|varrida do mapa|varridos do mapa|varrida|varridos|apagados|fuzilados|fuzilada|linchados|enjaulados|morresse|sozinho e|borrada del mapa|borrados del mapa|borrada|borrados|fusilados|fusilada|linchados|enjaulados|murieras|mueras solo|rayes de la carte|rayee|raye|fusiller|fusilles|lynches|pendus|enfermes|mourais|crever seul|getilgt|ausradiert|erschiessen|erschossen|aufgehangt|eingesperrt|stirb|ersaufen|मरी|मर जाए|मर जाओ|मरबी|মরবি|মরিস|ফাঁসি
        |to die|must die|should die|you die|they die|just die|all die|death|tod|a morte|la muerte|la mort|dead|killed|exterminated|exterminate|eliminated|wiped out|wipe out|get rid of|driven out|drive out|thrown out|throw out|kicked out|expelled
        |deported|gassed|hanged|shot|burned|beaten|beat up|hurt|a beating|gas them|kill them|shoot them|finish off|morrer|morra|morram|mortos|expulsos|expulsas
        |expulsar|eliminados|exterminados|deportados|acabem com|acabar com|enforcados|apanhar|surra|matem|morir|mueras|mueran|muertos|expulsados|expulsadas
        |acabad con|acaben con|acabar con|paliza|golpes|maten|mourir|creves|creve|crever|morts|expulses|chasses|extermines|elimines|deportes
        |qu'on en finisse avec|coups|dehors|sterben|stirbst|verrecken|verreckst|krepieren|vertrieben|gejagt|ausgerottet|vernichtet|rausgeworfen|abgeschoben
        |prugel|verprugelt|schlage|macht schluss mit|tot|मरने|मर जा*|मर जाए*|मौत|मार डाल*|भगा देना|भगा दो|निकाल देना|निकाल दो|ख़त्म कर*|खत्म कर*|मिटा द*|भगाना|पिटने|पिटाई
        |মরার|মরে গেলে*|মরলে*|মরা উচিত|মরে যা*|মেরে ফেল*|তাড়িয়ে|তাড়াও|তাড়ানো|তাড়িয়ে দাও|শেষ করে দাও|শেষ করে|নির্মূল|বের করে দাও|মার খাওয়া*""",
    "E": """deserve|deserves|should|ought|must|merecem|merece|mereces|merecen|deviam|devem|devia|deberian|deben|merecer|merites|meritez|meritent|devraient|doivent
        |verdienst|verdienen|verdient|gehoren|gehort|sollten|sollen|mussen|लायक|चाहिए|যোগ্য|উচিত|দরকার""",
    "Q": """all|every|each|todos|todas|todo|toda|cada|tous|toutes|tout|chaque|alle|jeder|jeden|jede|allen|samtliche|सारे|सभी|सब|हर|সব|সকল|প্রত্যেক""",
    "G": """immigrants|migrants|refugees|foreigners|muslims|jews|christians|hindus|blacks|whites|asians|gays|lesbians|women|men|gypsies|mexicans|africans
        |homosexuals|trans|imigrantes|refugiados|estrangeiros|muculmanos|judeus|negros|negras|lesbicas|mulheres|ciganos|homossexuais|nordestinos|indios
        |inmigrantes|extranjeros|musulmanes|judios|gitanos|mujeres|homosexuales|sudacas|moros|immigres|etrangers|musulmans|juifs|noirs|arabes|femmes|gitans
        |homosexuels|auslander|fluchtlinge|muslime|juden|schwarze|turken|frauen|zigeuner|schwule|मुसलमान*|हिंदुओं|दलित*|औरतें|औरतों|विदेशी*|शरणार्थी*|মুসলমান*
        |হিন্দুদের|হিন্দুরা|মেয়েরা|মহিলারা|বিদেশি*|শরণার্থী*""",
    "P": """those people|these people|such people|people like that|people like them|their kind|that kind|all of them|essa gente|esse povo|esses caras|gente assim|todos eles|esa gente|esa gentuza|gente asi|todos ellos|ces gens|ces gens-la|cette engeance|tous ces|diese leute|solche leute|dieses pack|die alle|die sollte man|il faudrait tous
        |they|them|their|eles|elas|deles|ellos|ellas|ils|elles|leurs|leur|sie|ihre|they're|वे|उन्हें|उनके|ये लोग|वो लोग|ওরা|ওদের|তারা|এরা|এদের""",
    "C": """go choke|choke on|crawl back|go back to the sewer|back into the sewer|get out of my sight|shut your filthy mouth|shut your mouth|volta para o esgoto|volta pro esgoto|cala essa boca|cale essa boca|vuelve a la cloaca|cierra esa boca|cierra la boca|retourne dans l' egout|retourne a l' egout|ferme ta sale|ferme ta bouche|kriech zuruck|halt dein dreckiges|nobody would care if you|ninguem ia chorar|ninguem choraria|nadie lloraria|personne ne pleurerait|niemand wurde weinen|मुँह बंद कर*|मुंह बंद कर*|গলা টিপে|মুখ বন্ধ কর*
        |go to hell|shut the fuck up|fuck off|fuck you|screw you|drop dead|kill yourself|rot in hell|burn in hell|eat shit|piss off|suck my dick|go die|kys|stfu
        |vai se foder|va se foder|vai te foder|vai tomar no cu|vai para o inferno|va para o inferno|vai pro inferno|vai a merda|va a merda|vai para o caralho
        |foda-se voce|vai morrer|se mata|morre|vete a la mierda|vete al infierno|vete al diablo|que te jodan|que te den|jodete|muerete|chinga tu madre
        |come mierda|callate la boca|cierra el pico|vayase al infierno|va te faire foutre|va te faire voir|nique ta mere|ferme ta gueule|ta gueule|va au diable
        |va en enfer|allez au diable|creve|va mourir|je t'emmerde|fous le camp|verpiss dich|fick dich|fahr zur holle|geh zum teufel|scher dich zum teufel
        |halt die fresse|halt's maul|halt dein maul|halt das maul|leck mich am arsch|verrecke|geh sterben|zur holle mit dir|भाड़ में जा*|जहन्नुम में जा*
        |नरक में जा*|चुल्लू भर पानी|मर जा|जा मर|জাহান্নামে যা*|নরকে যা*|গোল্লায় যা*|মর গিয়ে|চুলোয় যা*|মর তুই""",
    "c": """shut up|get lost|nobody wants you|no one wants you|nobody would miss you|no one would miss you|nobody likes you|laughs at you|laugh at you
        |laughing at you|i know where you live|cala a boca|cale a boca|some daqui|suma daqui|ninguem te quer|ninguem vai sentir falta|ninguem sente falta
        |ninguem gosta de voce|riem de voce|rindo de voce|eu sei onde voce mora|sei onde voce mora|callate|largate|fuera de aqui|nadie te quiere
        |nadie te echaria de menos|nadie te extranara|se rien de ti|se burlan de ti|se donde vives|ferme-la|tais-toi|degage|degagez|casse-toi
        |personne ne te veut|personne ne te regrettera|personne ne te regretterait|personne ne veut de toi|se moque de toi|se moquent de toi
        |je sais ou tu habites|je sais ou tu vis|halt den mund|halt die klappe|hau ab|verschwinde|zieh leine|niemand will dich|niemand wurde dich vermissen
        |keiner mag dich|lachen uber dich|lacht uber dich|ich weiss, wo du wohnst|ich weiss wo du wohnst|चुप कर*|चुप रह*|दफ़ा हो*|दफा हो*|निकल जा*
        |कोई नहीं चाहता|हँसते हैं|हंसते हैं|कहाँ रहता है|कहाँ रहती है|किसी को फ़र्क नहीं|চুপ কর*|চুপ থাক*|দূর হ*|ভাগ এখান|কেউ চায় না|দেখে হাসে|কোথায় থাকিস
        |কোথায় থাকো""",
    "X": """चाकू मारूँगा|गला घोंट|काट डालूँगा|जला दूँगा|ছুরি মারব|গলা কেটে|পুড়িয়ে দেব|schlage dir|steche dich|schneide dir|breche dir
        |will hurt|will kill|will beat|will find|will destroy|will break|will smash|gonna hurt|gonna kill|gonna beat|going to hurt|going to kill|going to beat
        |i'll kill|i'll hurt|i'll beat|beat you up|break your|smash your|vou te bater|vou te matar|vou te machucar|vou te quebrar|vou te pegar|vou te arrebentar
        |vou te destruir|te mato|vou acabar com voce|te voy a matar|te voy a pegar|te voy a hacer dano|voy a matarte|voy a pegarte|te voy a romper
        |te voy a partir|te matare|te pegare|voy a acabar contigo|te faire mal|te tuer|te frapper|te casser|te buter|te demolir|je te tue|je te frapperai
        |te faire la peau|werde dir wehtun|werde dich toten|werde dich schlagen|werde dich umbringen|bringe dich um|schlage dich|mache dich fertig|dir wehtun
        |dich verprugeln|dich umbringen|मारूँगा|मारूंगा|मारूँगी|पीटूँगा|पीटूंगा|पीटूँगी|तोड़ दूँगा|मार दूँगा|मार डालूँगा|छोड़ूँगा नहीं|नहीं छोड़ूँगा|মারব|মারবো
        |পেটাব|পেটাবো|মেরে ফেলব|ভেঙে দেব|খুন করব|দেখে নেব|ছাড়ব না""",
    "K": """hope wish tomara espero que|oxala|ojala|j'espere|puisses-tu|hoffe|hoffentlich|काश|दुआ है|আশা করি|চাই তুই|কামনা করি|আল্লাহ করুক""",
    "S": """fuck live|strip and fuck|ride him|rode him|riding him|lick your|te comer|gostosa|follarte|baiser toute|dich ficken|comerte|lamber|lamer tu
        |porn|porno|pornography|hardcore|xxx|orgy|orgies|horny|fucking|blowjob|handjob|cumshot|milf|dildo|masturbat*|cock|pussy|dick|boobs|tits|deepthroat
        |gangbang|threesome|nudes|cum|creampie|erection|clitoris|orgasm|pornografia|tesao|orgia|orgias|putaria|punheta|boquete|gozar|buceta|xoxota|pau duro|rola
        |foder|transar|trepar|safada|safado|siririca|pornografico|follar|follarte|follando|cachondo|cachonda|polla|verga|mamada|correrse|masturbar*|tetas
        |estoy muy caliente|muy caliente|coger contigo|pornographie|orgie|baiser|te baiser|bite|chatte|sucer|branler|partouze|bander|excite ce soir|tres excite
        |tres excitee|salopes|pornos|pornografie|ficken|gefickt|sexvideos|sexvideo|geil|geile|orgien|schwanz|muschi|titten|blasen|wichsen|bumsen|vogeln|sexcam
        |पोर्न*|अश्लील|कामुक|चुदाई|चोदना|चोद*|लंड|चूत|हस्तमैथुन|सेक्सी वीडियो|পর্ন*|অশ্লীল|কামুক|চোদা*|চুদ*|যৌন মিলন|হস্তমৈথুন|চটি|গরম ভিডিও""",
    "s": """naked body|naked pictures|foto pelada|fotos desnuda|photos de toi nue|hot girls|harder and harder
        |sex|sexy|nude|naked|moaned|moaning|thrust|nipples|aroused|undressed|lingerie|erotic|strip|sexual|intercourse|breasts|sexo|nua|nuas|nu|nus|pelada
        |peladas|pelado|pelados|gemeu|gemia|gemendo|erotico|erotica|mamilos|seios|seio|excitado|excitada|sexuais|desnuda|desnudas|desnudo|desnudos|gimio|pezones
        |senos|sexuales|sexe|nue|nues|gemissait|gemit|seins|excite|excitee|erotique|tetons|sexuelle|nackt|nackte|nackten|nacktbilder|nacktfotos|stohnte|stohnend
        |erregt|brustwarzen|erotisch|brusten|सेक्स|नंगी|नंगा|नंगे|नग्न|कराह*|उत्तेजित|स्तन|যৌন|সেক্স|নগ্ন|উলঙ্গ|ন্যাংটো|গোঙা*|উত্তেজিত|স্তন""",
    "A": """send me|show me|click|watch|free|want to|come here|tonight|all night|cam|pics|videos|me manda|manda|mande|clique|assista|de graca|gratis
        |a noite inteira|toda noite|hoje|quero te|quero|fotos|mandame|enviame|haz clic|mira|toda la noche|quiero|hoy|envoie-moi|cliquez|regarde|gratuit
        |gratuites|gratuits|toute la nuit|ce soir|je veux|photos|schick mir|klick|klicke|kostenlose|kostenlos|die ganze nacht|heute|ich will|bilder|भेजो|भेज
        |मुफ़्त|मुफ्त|देखो|क्लिक|रात भर|चाहता हूँ|चाहती हूँ|आज|तस्वीरें|वीडियो|পাঠাও|বিনামূল্যে|দেখো|ক্লিক|সারারাত|চাই|আজ|ছবি|ভিডিও""",
    "U": """take off your clothes|take your clothes off|get naked|strip for me|tira a roupa|tire a roupa|fica pelada|quitate la ropa|desnudate|deshabille-toi
        |enleve tes vetements|zieh dich aus|कपड़े उतार*|কাপড় খোল*|জামা খোল*""",
    "F": """fuck|fucked|screw|foder|fode|fodido|joder|jodan|foutre|fick""",
    "N": """নও|নন|not|never|isn't|aren't|don't|nao|nunca|no|jamas|ne|pas|jamais|nicht|nie|kein|keine|नहीं|न|মোটেই|নয়|না""",
    "R": """hate speech|discurso de odio|discurso de odio|hassrede|discours de haine|crime|crimen|delito|moderator|moderators|rule|rules|calling|called|call someone|the word|insulting|insult|novel|film|movie|song|lyrics|dictionary|definition|means
        |explained|policy|report|reported|article|forbidden|moderador|moderadora|regra|regras|chamar|chamou|chamaram|palavra|insulto|romance|filme|dicionario
        |significa|explicou|proibido|viola|regla|reglas|llamar|llamo|llamaron|palabra|novela|pelicula|diccionario|explico|prohibido|rompe|moderateur|regle
        |regles|traiter quelqu'un|mot|roman|dictionnaire|signifie|explique|explique pourquoi|interdit|nennen|nannte|wort|regel|regeln|worterbuch|bedeutet
        |erklarte|verboten|beleidigung|संचालक|नियम|नियमों|कहना|शब्द|उपन्यास|शब्दकोश|अर्थ|बताया|পরিচালক|নিয়ম*|নিয়মবিরুদ্ধ|বলা|শব্দ|উপন্যাস|অভিধান|অর্থ|জানালেন""",
}

#: (classes, most words between them, weight): patterns of a clause, each counted once.
PATTERNS = (
    (("T", "I"), 5, 1.1), (("t", "I"), 5, 1.1), (("P", "I"), 4, 1.1), (("G", "I"), 4, 1.1), (("I", "T"), 4, 1.1), (("T", "W"), 5, 0.6), (("t", "W"), 1, 0.6), (("t", "W", "W"), 1, 0.5), (("t", "W", "D"), 4, 0.5), (("W", "T"), 2, 0.6), (("W", "W"), 1, 0.3), (("T", "W", "W"), 5, 0.5),
    (("I", "W"), 0, 1.0), (("W", "I"), 0, 1.0), (("I", "I"), 1, 0.6), (("C",), 0, 1.0), (("c",), 0, 0.6), (("c", "c"), 12, 0.4), (("c", "I"), 6, 0.6),
    (("C", "I"), 6, 0.3), (("c", "X"), 6, 0.6), (("c", "W"), 6, 0.4), (("X",), 0, 0.8), (("T", "X"), 4, 0.4), (("X", "T"), 3, 0.4), (("X", "t"), 3, 0.4), (("t", "X"), 4, 0.4), (("X", "b"), 4, 0.3), (("J", "y"), 2, 1.1), (("J", "X"), 3, 0.3), (("J", "h", "T"), 2, 1.1), (("J", "h", "t", "b"), 2, 1.1), (("J", "T", "h"), 5, 1.1), (("J", "T", "b", "h"), 4, 1.1), (("J", "t", "b", "h"), 3, 1.1), (("X", "I"), 8, 0.4),
    (("Q", "V"), 5, 1.1), (("G", "V"), 5, 1.1), (("E", "D"), 3, 1.0), (("V", "E", "D"), 4, 0.6), (("V",), 0, 0.4), (("V", "E"), 2, 0.6), (("V", "P"), 5, 0.7), (("T", "E", "D"), 4, 0.4),
    (("E", "D", "T"), 4, 0.3), (("D", "E"), 2, 1.0), (("Q", "v"), 4, 0.5), (("P", "v"), 4, 0.6), (("P", "E", "D"), 5, 0.4), (("P", "D"), 4, 0.6), (("G", "E", "D"), 5, 0.4), (("G", "v"), 4, 0.9), (("v", "D"), 6, 0.5), (("D", "Q", "v"), 9, 0.6), (("D", "v"), 12, 0.5), (("T", "W", "D"), 4, 0.5),
    (("v", "E", "D"), 6, 0.4), (("H", "P", "v"), 6, 1.1), (("H", "P", "V"), 6, 1.1), (("H", "G"), 3, 1.1), (("H", "V"), 6, 1.0), (("H", "v"), 6, 0.6), (("H", "T"), 2, 0.8), (("T", "H"), 3, 0.5), (("K", "T", "D"), 4, 1.1), (("K", "D"), 4, 0.5),
    (("T", "D"), 4, 0.4), (("I", "D"), 3, 0.6), (("F", "T"), 1, 1.0), (("S",), 0, 0.7), (("s",), 0, 0.25), (("S", "S"), 8, 0.5), (("S", "s"), 10, 0.4), (("s", "S"), 10, 0.4),
    (("s", "s"), 5, 0.4), (("A", "S"), 7, 0.4), (("S", "A"), 5, 0.4), (("A", "s"), 5, 0.4), (("s", "A"), 3, 0.4), (("U",), 0, 0.7), (("U", "s"), 8, 0.5), (("U", "S"), 8, 0.5), (("S", "U"), 8, 0.5), (("A", "F"), 2, 0.4), (("A", "A", "s"), 6, 0.2), (("E", "T", "D"), 4, 0.4),
)
#: Weight taken back: a report about words, unless someone is cursed or threatened; a piece of fiction told before whatever
#: is said in it; harm in games, machines or kitchens; a negation between target and insult.
REPORT_PENALTY = 1.2
FICTION_PENALTY = 1.6
MILD_PENALTY = 1.2
NEGATION_PENALTY = 1.3
#: Classes that mean nothing by themselves; every other class triggers, and of a pattern of these alone each class.
_CONTEXT = frozenset("TtPQGEKANRJhbBM")
_TRIGGERS = frozenset(c for pattern, _, _ in PATTERNS for c in (set(pattern) - _CONTEXT or pattern))

_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "€": "e", "|": "i"})
_CLAUSES = re.compile(r"(?<=[.!?।…])[\"'”’»)]*\s+|\n+|;\s")
_SPACED = re.compile(r"(?<![^\W_])([^\W\d_])((?:[.\-_·•]+[^\W\d_]){2,})[.\-_·•]?(?![^\W_])")
_TOKEN = re.compile(r"[^\s.,;:?()\[\]{}\"“”„«»…।|/\\<>=+~`]+|,")
_STRETCHED = re.compile(r"(.)\1{2,}")
_EDGES = "'’‘!¡¿*-–—_#&%"
#: An article or pronoun that lost its vowel before the next word.
_ELISION = re.compile(r"(?<![^\W_'])(t|l|d|j|n|s|m|c|qu)'(?=[^\W\d_]{2})")
_DROP = {ord(c): None for c in "​‌‍⁠­़়"}


def _fold(text: str) -> str:
    """Lower case, without accents of Latin letters, nuktas and hidden characters."""
    text = unicodedata.normalize("NFD", text.lower().replace("ß", "ss").replace("’", "'")).translate(_DROP)
    return _ELISION.sub(r"\1' ", re.sub("[̀-ͯ]", "", text))


class Lexicon:
    """The lexical transducer: a trie of folded words whose nodes give classes, and stems that stand for any ending."""

    def __init__(self, lexicon: dict[str, str]):
        self.trie: dict = {}
        self.words: dict[str, str] = {}
        self.stems: dict[str, str] = {}
        self.by_length: dict[int, list[str]] = {}
        #: The longest word of each phrase: a clause without any of them has no phrase.
        self.keys: set[str] = set()
        self.key_stems: list[str] = []
        for symbol, text in lexicon.items():
            for entry in text.split("|"):
                self._add(symbol, _fold(" ".join(entry.split())))
        for word in self.words:
            self.by_length.setdefault(len(word), []).append(word)
        #: Words of phrases, for those of which letters are starred.
        self.phrase_words: dict[int, set[str]] = {}
        nodes = [self.trie]
        while nodes:
            node = nodes.pop()
            for word, below in node.items():
                if word == "*":
                    nodes += below.values()
                elif word:
                    self.phrase_words.setdefault(len(word), set()).add(word)
                    nodes.append(below)

    def _add(self, symbol: str, entry: str) -> None:
        parts = [p.strip(",") for p in entry.split()]
        if not parts:
            return
        if len(parts) == 1:
            word = parts[0]
            if word.endswith("*"):
                self.stems[word[:-1]] = self.stems.get(word[:-1], "") + symbol
            elif symbol not in self.words.get(word, ""):
                self.words[word] = self.words.get(word, "") + symbol
            return
        key = max(parts, key=len)
        if key.endswith("*"):
            self.key_stems.append(key[:-1])
        else:
            self.keys.add(key)
        node = self.trie
        for part in parts:
            node = node.setdefault("*", {}).setdefault(part[:-1], {}) if part.endswith("*") else node.setdefault(part, {})
        node[""] = node.get("", "") + symbol

    def classes(self, word: str) -> str:
        """The classes of a word; an infinitive with the object ``te`` behind it is a threat's verb with its victim."""
        found = self._own(word)
        if word.endswith("rte") and len(word) > 5 and (verb := self._own(word[:-2])) and "h" in verb:
            return found + "".join(c for c in verb if c not in found) + "y"
        return found

    def _own(self, word: str) -> str:
        found = self.words.get(word, "")
        if not found and not word.isascii():
            for size in range(2, len(word) + 1):
                found += self.stems.get(word[:size], "")
        elif not found:
            for size in range(5, len(word) + 1):
                found += self.stems.get(word[:size], "")
        return found

    def starred(self, word: str) -> tuple[bool, str]:
        """Whether a starred word may stand for one of the lists, alone or in a phrase, and the classes of all such words."""
        pattern = _starred_pattern(word)
        known = [k for k in self.by_length.get(len(word), ()) if pattern.fullmatch(k)]
        found = "".join(self.words[k] for k in known)
        if not found:
            for stem, classes in self.stems.items():
                if 5 <= len(stem) <= len(word) and "*" in word[: len(stem)] and _starred_pattern(word[: len(stem)]).fullmatch(stem):
                    found += classes
        return bool(found) or any(map(pattern.fullmatch, self.phrase_words.get(len(word), ()))), found


@lru_cache(maxsize=10_000)
def _starred_pattern(word: str) -> re.Pattern:
    return re.compile("".join("." if c == "*" else re.escape(c) for c in word))


LEXICAL = Lexicon(LEXICON)


@lru_cache(maxsize=100_000)
def _read(token: str) -> tuple[str, str]:
    """A token as a plain word, and its classes."""
    word = token.strip(_EDGES)
    found = LEXICAL.classes(word)
    if found or not word:
        return word, found
    stars = token.strip("'’‘!¡¿-–—_#&%")
    if "*" in stars and any(c.isalpha() for c in stars):
        plain = stars.translate(_LEET)
        known, found = LEXICAL.starred(plain)
        if known:
            # Stars stay, so that a phrase may be read from them.
            return plain, found
    tries = [token.strip("'’‘¡¿*-–—_#&%").rstrip("!").translate(_LEET), word.translate(_LEET).replace("-", "").replace("_", "")]
    for plain in tries:
        found = LEXICAL.classes(plain)
        if found:
            return plain, found
        if _STRETCHED.search(plain):
            for times in (r"\1", r"\1\1"):
                short = _STRETCHED.sub(times, plain)
                found = LEXICAL.classes(short)
                if found:
                    return short, found
    plain = tries[0] if any(c.isalpha() for c in tries[0]) else word
    return (_STRETCHED.sub(r"\1", plain) if plain.isascii() else plain), ""


def classify(clause: str) -> list[str]:
    """The classes of each position of a clause; a phrase's are at its first word, and its other words have none."""
    joined = _SPACED.sub(lambda m: m.group(1) + re.sub(r"[.\-_*·•]+", "", m.group(2)), clause)
    read = [_read(t) if t != "," else ("", "") for t in _TOKEN.findall(joined)]
    out: list[str] = []
    i = 0
    while i < len(read):
        node, best, j = LEXICAL.trie, None, i
        while j < len(read):
            word = read[j][0]
            if not word and j > i:
                j += 1
                continue
            step = node.get(word)
            if step is None and "*" in word:
                pattern = _starred_pattern(word)
                step = next((n for k, n in node.items() if k not in ("", "*") and pattern.fullmatch(k)), None)
            if step is None and word and "*" in node:
                step = next((n for stem, n in node["*"].items() if word.startswith(stem)), None)
            if step is None:
                break
            node = step
            j += 1
            if "" in node:
                best = (j, node[""])
        if best:
            out.append(best[1])
            # The words of a phrase may still be targets.
            out += ["".join(c for c in read[k][1] if c == "T") for k in range(i + 1, best[0])]
            i = best[0]
        else:
            if read[i][0]:
                out.append(read[i][1])
            i += 1
    return out


class Automaton:
    """All patterns in one automaton with loops: state k of a pattern is reached at a word of its k-th class, and left for
    the next one by a word of the next class within the pattern's gap. One pass over a clause's classes gives all that accept.
    """

    def __init__(self, patterns: tuple[tuple[tuple[str, ...], int, float], ...]):
        self.patterns = patterns
        self.weights = [weight for _, _, weight in patterns]
        #: class -> (pattern, place) of every state that a word of this class reaches.
        self.steps: dict[str, list[tuple[int, int]]] = {}
        for n, (classes, _, _) in enumerate(patterns):
            # Later places first, so that one word doesn't take two steps of a pattern.
            for place in reversed(range(len(classes))):
                self.steps.setdefault(classes[place], []).append((n, place))

    def accepted(self, positions: list[str]) -> set[int]:
        reached: dict[tuple[int, int], list[int]] = {}
        done: set[int] = set()
        for i, classes in enumerate(positions):
            here: list[tuple[int, int]] = []
            for symbol in classes:
                for n, place in self.steps.get(symbol, ()):
                    if n in done:
                        continue
                    if place and not any(i - at <= self.patterns[n][1] + 1 for at in reached.get((n, place - 1), ())):
                        continue
                    if place + 1 == len(self.patterns[n][0]):
                        done.add(n)
                    else:
                        here.append((n, place))
            for state in here:
                reached.setdefault(state, []).append(i)
        return done


PATTERN_AUTOMATON = Automaton(PATTERNS)
#: Contexts by name: the patterns of which one must be accepted.
CONTEXTS = {
    "report": Automaton(tuple((pair, 4, 1.0) for c in "IWVvSsF" for pair in (("R", c), (c, "R"), ("B", c), (c, "B")))),
    "fiction": Automaton(tuple((("B", c), 12, 1.0) for c in "CXchIWFD")),
    "negation": Automaton(((("T", "N", "I"), 4, 1.0), (("T", "N", "W"), 4, 1.0), (("N", "T", "I"), 1, 1.0), (("N", "T", "W"), 1, 1.0), (("T", "I", "N"), 1, 1.0), (("T", "W", "N"), 1, 1.0))),
}


def clause_score(positions: list[str]) -> float:
    """Sum of the weights of the patterns that the classes of a clause pass, after the context's penalties."""
    present = set("".join(positions))
    if not present & _TRIGGERS:
        return 0.0
    score = sum(PATTERN_AUTOMATON.weights[n] for n in PATTERN_AUTOMATON.accepted(positions))
    if score <= 0:
        return 0.0
    if present & {"R", "B"} and not present & {"C", "X"} and CONTEXTS["report"].accepted(positions):
        score -= REPORT_PENALTY
    elif "B" in present and CONTEXTS["fiction"].accepted(positions):
        score -= FICTION_PENALTY
    if "M" in present and not present & set("ICSVHGPc"):
        score -= MILD_PENALTY
    if "N" in present and "C" not in present and CONTEXTS["negation"].accepted(positions):
        score -= NEGATION_PENALTY
    if len(positions) <= 3 and "I" in present and not present & {"N", "R", "B"}:
        score += 0.5
    return max(0.0, score)


def message_score(text: str | None) -> float:
    """Score of a message, that of its worst clause; null and blank ones have 0."""
    if not text:
        return 0.0
    return max((_clause(c) for c in _CLAUSES.split(text) if c), default=0.0)


@lru_cache(maxsize=200_000)
def _is_quiet(token: str) -> bool:
    """Whether a token between blanks can't begin to trigger a pattern: neither by its classes nor as the key of a phrase."""
    folded = _fold(token)
    if _SPACED.search(folded):
        return False
    for part in _TOKEN.findall(folded):
        word, found = _read(part)
        if not _TRIGGERS.isdisjoint(found) or "*" in word or word in LEXICAL.keys or any(map(word.startswith, LEXICAL.key_stems)):
            return False
    return True


def _clause(clause: str) -> float:
    """Score of a clause; most have no token that could trigger anything, and are done with that."""
    if all(map(_is_quiet, clause.lower().split())):
        return 0.0
    return clause_score(classify(_fold(clause)))


def scored_messages(df: DataFrame, key: str, messages: str, keep: dict[str, F.Column] | None = None) -> DataFrame:
    """``key, turn, score`` of every message of any role, by its position from 0; null or empty messages have no rows.

    ``keep`` names string columns to add to each row. Equal rows come out once.
    """
    keep = keep or {}
    kept = [key, *keep]
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias(key), *(c.cast("string").alias(n) for n, c in keep.items()), F.col(f"`{messages}`").alias("_messages"))

    def score(batch):
        at, turns, scores = [], [], []
        for i, row in enumerate(raw(batch, "_messages").to_pylist()):
            for turn, message in enumerate(row or ()):
                at.append(i)
                turns.append(turn)
                scores.append(round(message_score(message["content"] if message else None), 3))
        take = pa.array(at, pa.int32())
        return pa.RecordBatch.from_arrays(
            [*(raw(batch, c).take(take) for c in kept), pa.array(turns, pa.int32()), pa.array(scores, pa.float64())], names=[*kept, "turn", "score"]
        )

    fields = ", ".join([f"`{key}` {kind}", *(f"`{c}` string" for c in keep), "turn int", "score double"])
    return map_batches(source, score, fields).distinct()


def offending_messages(df: DataFrame, key: str, messages: str, threshold: float = THRESHOLD) -> DataFrame:
    """``key, turn`` of the messages that score ``threshold`` or more."""
    return scored_messages(df, key, messages).where(F.col("score") >= threshold).select(key, "turn")


def offence_rates(df: DataFrame, key: str, messages: str, source: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """``source, messages, offending, rate``: the share of offending messages of each source, spelling variants as one; null is a source."""
    rows = scored_messages(df, key, messages, {"source": slice_value(source)})
    return rows.groupBy("source").agg(
        F.count("*").alias("messages"), F.count_if(F.col("score") >= threshold).alias("offending"), F.avg((F.col("score") >= threshold).cast("int")).alias("rate")
    )
