"""Messages written apart from the word lists and the test tables, to measure how far the grammar reaches: first those that offend, then those that don't."""

OFFENDING = """You are a complete nitwit and a disgrace to everyone.
I will stab you tonight.
You absolute buffoon, read before you write.
Go choke on it, you freak.
Those people should be wiped off the earth.
You're an oxygen thief.
What a pathetic little worm you are.
I'm going to strangle you when I see you.
We will burn your house down with you inside.
You are dumber than a rock.
Shut your filthy mouth.
Nobody would care if you died.
Immigrants are a plague on this country.
Women are inferior and should obey.
They should all be shot at the border.
You lying sack of garbage.
I hope you get cancer and die.
Crawl back into the sewer you came from.
You're a waste of space.
Get out of my sight, you degenerate.
I'll cut your throat.
Refugees are animals and belong in cages.
You spineless coward, you disgust me.
All of them are filthy thieves by birth.
You brainless fool, go away.
Send me naked pictures of your breasts right now.
I want to lick your naked body all night.
He moaned as she rode him harder and harder.
Watch hot girls strip and fuck live.
You are an embarrassment to your family, you clown.
Você é um completo inútil e uma vergonha para todos.
Vou te esfaquear hoje à noite.
Cala essa boca imunda.
Seu lixo humano, some da minha frente.
Tomara que você morra sozinho.
Essa gente devia ser varrida do mapa.
Imigrantes são uma praga neste país.
Você é mais burro que uma porta.
Vou quebrar a sua cara.
Vou te estrangular quando te encontrar.
Ninguém ia chorar se você morresse.
Mulher não presta, todas são iguais.
Vá para o inferno, seu covarde nojento.
Que pessoa desprezível você é.
Eles deviam ser todos fuzilados.
Manda foto pelada agora, gostosa.
Quero te comer a noite toda.
Seu verme, você não vale nada.
Some daqui, sua aberração.
Volta para o esgoto de onde você saiu.
Eres un completo inútil y una vergüenza para todos.
Te voy a apuñalar esta noche.
Cierra esa boca asquerosa.
Ojalá te mueras solo.
Esa gente debería ser borrada del mapa.
Los inmigrantes son una plaga en este país.
Eres más tonto que una piedra.
Te voy a partir la cara.
Voy a estrangularte cuando te vea.
Nadie lloraría si te murieras.
Vete al infierno, cobarde asqueroso.
Qué persona tan despreciable eres.
Todos ellos deberían ser fusilados.
Mándame fotos desnuda ahora mismo.
Quiero follarte toda la noche.
Gusano, no vales nada.
Lárgate de aquí, engendro.
Vuelve a la cloaca de donde saliste.
Basura humana, das asco.
Eres la vergüenza de tu familia, payaso.
Du bist ein kompletter Versager und eine Schande für alle.
Ich werde dich heute Nacht erstechen.
Halt dein dreckiges Maul.
Hoffentlich stirbst du allein.
Diese Leute gehören vom Erdboden getilgt.
Einwanderer sind eine Plage für dieses Land.
Du bist dümmer als ein Stein.
Ich schlage dir die Zähne aus.
Ich werde dich erwürgen, wenn ich dich sehe.
Niemand würde weinen, wenn du stirbst.
Fahr zur Hölle, du widerlicher Feigling.
Was bist du für ein erbärmlicher Mensch.
Die sollte man alle erschießen.
Schick mir sofort Nacktbilder von dir.
Ich will dich die ganze Nacht ficken.
Du Wurm bist nichts wert.
Verschwinde von hier, du Missgeburt.
Kriech zurück in die Kanalisation.
Du menschlicher Abfall ekelst mich an.
Du bist eine Schande für deine Familie, du Clown.
Tu es un parfait incapable et une honte pour tous.
Je vais te poignarder ce soir.
Ferme ta sale bouche.
J'espère que tu vas crever seul.
Ces gens devraient être rayés de la carte.
Les immigrés sont un fléau pour ce pays.
Tu es plus bête qu'une pierre.
Je vais te casser la figure.
Je vais t'étrangler quand je te verrai.
Personne ne pleurerait si tu mourais.
Va en enfer, espèce de lâche.
Quel être méprisable tu es.
Il faudrait tous les fusiller.
Envoie-moi des photos de toi nue tout de suite.
J'ai envie de te baiser toute la nuit.
Ver de terre, tu ne vaux rien.
Dégage d'ici, sale monstre.
Retourne dans l'égout d'où tu viens.
Déchet humain, tu me dégoûtes.
Tu es la honte de ta famille, bouffon.
तू बिल्कुल निकम्मा है और सबके लिए शर्म की बात है।
मैं आज रात तुझे चाकू मारूँगा।
अपना गंदा मुँह बंद कर।
काश तू अकेला मर जाए।
तू कायर और घटिया इंसान है।
तेरा गला घोंट दूँगा।
सारे विदेशी चोर हैं, इन्हें भगा दो।
तू तो पत्थर से भी ज़्यादा बेवकूफ़ है।
তুই একেবারে অপদার্থ আর সবার লজ্জা।
আজ রাতে তোকে ছুরি মারব।
তোর নোংরা মুখ বন্ধ কর।
আশা করি তুই একা মরবি।
তুই একটা কাপুরুষ আর জঘন্য লোক।
তোর গলা টিপে মেরে ফেলব।
সব বিদেশি চোর, ওদের তাড়িয়ে দাও।
তুই পাথরের চেয়েও বোকা।""".split("\n")

HARMLESS = """The novel's villain says: I will kill you all, and the hero laughs.
The rat in your lab is ugly.
Your dog is a clever animal.
How do I kill a zombie process on your server?
The worms in your garden are useful.
I beat the eggs and then I beat you at chess.
The film was stupid but your review was kind.
She said the word idiot was forbidden at school.
Cancer cells should be destroyed early.
The pigs on your farm look healthy.
We will shoot the photos tonight.
Please shut the door and get some rest.
My stupid printer is broken again.
The painting shows a naked woman by the sea.
Breast feeding is recommended for six months.
The character in the play calls his brother a coward.
Nobody wants you to lose your data.
You are not a loser, you just had a bad day.
The dead branches must be cut and burned.
The hunters will kill the invasive rats on the island.
Can you tell me why the monkey in the zoo is so sad?
Refugees are human beings with rights.
Hate speech against Jews is a crime.
Sex education starts in the fifth year.
This trash can is full, can you empty it?
The virus will hurt your lungs.
I will break your record next year.
The song's chorus goes: burn, baby, burn.
You should get rid of old passwords.
The ugly duckling is a tale for children.
The cow and the donkey slept in your barn.
I was an idiot to forget my keys.
Snakes shed their skin in your region in spring.
Fire the worker thread and kill the queue.
What does the insult mean in this dictionary?
O rato no seu laboratório é feio.
O vilão do romance diz: vou te matar, e todos riem.
As mulheres da cidade abriram uma cooperativa.
Como faço para matar um processo no servidor?
O seu cachorro é um animal inteligente.
Vou bater os ovos e depois te mando a receita.
O filme mostra um homem nu na praia.
Ela explicou por que chamar alguém de burro é proibido.
O burro carregou a lenha até a sua casa.
Você não é inútil, só está cansado.
As baratas devem ser eliminadas da cozinha.
O lixo da sua rua é recolhido hoje.
Os refugiados são bem-vindos na nossa escola.
A educação sexual começa no quinto ano.
Feche a porta e venha jantar.
La rata de tu laboratorio es fea.
El villano de la novela dice: te voy a matar, y todos ríen.
Las mujeres del pueblo abrieron una cooperativa.
¿Cómo puedo matar un proceso en el servidor?
Tu perro es un animal inteligente.
El cuadro muestra a una mujer desnuda junto al mar.
Ella explicó por qué llamar tonto a alguien está prohibido.
El burro llevó la leña hasta tu casa.
No eres inútil, solo estás cansado.
Las cucarachas deben ser eliminadas de la cocina.
La basura de tu calle se recoge hoy.
Los refugiados son bienvenidos en nuestra escuela.
Cierra la puerta y ven a cenar.
Voy a romper tu récord el año que viene.
Die Ratte in deinem Labor ist hässlich.
Der Bösewicht im Roman sagt: Ich werde dich töten, und alle lachen.
Die Frauen des Dorfes gründeten eine Genossenschaft.
Wie beende ich einen Prozess auf deinem Server?
Dein Hund ist ein kluges Tier.
Das Bild zeigt eine nackte Frau am Meer.
Sie erklärte, warum das Wort Idiot verboten ist.
Der Esel trug das Holz bis zu deinem Haus.
Du bist kein Versager, du bist nur müde.
Kakerlaken müssen aus der Küche vertrieben werden.
Der Müll in deiner Straße wird heute abgeholt.
Flüchtlinge sind in unserer Schule willkommen.
Mach die Tür zu und komm zum Essen.
Ich werde dich beim Schach schlagen.
Le rat de ton laboratoire est moche.
Le méchant du roman dit : je vais te tuer, et tout le monde rit.
Les femmes du village ont ouvert une coopérative.
Comment tuer un processus sur ton serveur ?
Ton chien est un animal intelligent.
Le tableau montre une femme nue au bord de la mer.
Elle a expliqué pourquoi traiter quelqu'un d'idiot est interdit.
L'âne a porté le bois jusqu'à ta maison.
Tu n'es pas un incapable, tu es juste fatigué.
Les cafards doivent être éliminés de la cuisine.
Les déchets de ta rue sont ramassés aujourd'hui.
Les réfugiés sont les bienvenus dans notre école.
Ferme la porte et viens dîner.
Je vais casser ton record l'an prochain.
तुम्हारी प्रयोगशाला का चूहा बदसूरत है।
उपन्यास का खलनायक कहता है: मैं तुझे मार डालूँगा।
गाँव की औरतों ने एक दुकान खोली।
तुम्हारा कुत्ता समझदार जानवर है।
गधा लकड़ी लेकर तुम्हारे घर तक गया।
दरवाज़ा बंद कर दो और खाना खाने आओ।
तुम निकम्मे नहीं हो, बस थके हुए हो।
चित्र में समुद्र के किनारे एक नग्न मूर्ति है।
তোমার পরীক্ষাগারের ইঁদুরটা কুৎসিত।
উপন্যাসের খলনায়ক বলে: তোকে মেরে ফেলব।
গ্রামের মহিলারা একটি দোকান খুলেছেন।
তোমার কুকুর বুদ্ধিমান প্রাণী।
গাধাটা কাঠ নিয়ে তোমার বাড়ি গেল।
দরজা বন্ধ করে খেতে এসো।
তুমি অপদার্থ নও, শুধু ক্লান্ত।
ছবিতে সমুদ্রের ধারে একটি নগ্ন মূর্তি আছে।""".split("\n")
