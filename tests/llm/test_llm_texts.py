"""Statistics, languages, leaks, defects, abuse and spam."""

from __future__ import annotations

import math
import random

import pytest

from weftline.llm import abuse, langid, leakage, pairs, prose, spam, textstats

PROSE = "The old museum keeps a long list of names. Nobody knows whether the guide still reads it, but the doors are open every day."


@pytest.fixture(scope="module")
def samples(spark, data):
    return spark.read.parquet(f"{data}/lang_samples.parquet")


@pytest.fixture(scope="module")
def model(samples):
    return langid.Profiles(langid.profiles_of(samples))


@pytest.mark.parametrize(
    "text, kind",
    [
        (PROSE, None),
        ("1. The guide reads the list.\n2. Nobody asked for it.\n3. The doors are open.", None),
        ("- apples\n- pears\n- a bag of beans\n- bread", "list"),
        ("apples, pears, a bag of beans, bread, honey, three jars, salt, two lamps", "list"),
        ("name;date;price\nlamp;2020-01-02;12.50\nsofa;2021-03-04;99.00", "table"),
        ("name\tdate\tprice\nlamp\t2020-01-02\t12.50\nsofa\t\t99.00", "table"),
        ("<tr><td>lamp</td><td>12</td></tr>\n<tr><td>sofa</td><td>13</td></tr>", "table"),
        ("98127 ID7731 +99123 -4412 v123 #998 7741 88123", "junk"),
        ("Home | Menu | Login | Search | Share | Print | Next", "junk"),
        ("qwrtpl zxcvbnm kjhgf qqqwwp dfghjk lkjhg mnbvcx plmnbv", "junk"),
        ("12:01:02.345 [WARN] 0x42aaf57d a/b.so ret=-2\n12:01:03.345 [INFO] 0x42aaf57e a/b.so ret=0", "junk"),
        ("a3f9e0217744bdce90aa1c2d3e4f5a6b7c8d9e0f1a2b3c4d5e6f708192a3b4c5d6e7f8091a2b3c4d5e6f", "junk"),
        ("— Where is the list?\n— In the old museum, as everybody knows.\n— Then let us go.", None),
        ("The caravan left the old town with\nthirty bags of salt and came home\nafter eight nights. Nobody knows who\npaid for it. The letters that came\nlater were not answered, all before\nthe year of the flood.", None),
        ("nobody knows if the old guide still reads the long list of names lol\nwe went there twice and the doors were never open :)", None),
    ],
)
def test_parts_of_texts(text, kind):
    assert prose.kind_of(prose.shapes(text)) == kind


TABLE = [
    ("a", PROSE, "en"), ("a", PROSE, "en"), ("b", None, None), ("c", "", "x"), ("d", " \n ", "x"), ("e", PROSE * 400, "y"), (None, "- one\n- two\n- three\n- four", "z"),
    ("f", "lamp;2020-01-02;12.50\nsofa;2021-03-04;99.00\nchair;2021-03-05;9.00", "z"),
]


def test_statistics_of_odd_rows(spark):
    df = spark.createDataFrame(TABLE, "id string, text string, words string")
    got = {r.id: r for r in textstats.scored_statistics(df, "id", "text").collect()}
    assert len(got) == 7 and got["b"].language == "und" and got["a"].language == "en"
    assert got["a"].words == 24 and got["a"].kind is None and got["f"].kind == "table" and got["a"].punctuated_lines == 1.0 and got["f"].cells == 1.0 and got["e"].words > 9_000
    assert {r.id: r.kind for r in textstats.unnatural_texts(df, "id", "text").collect()} == {None: "list", "f": "table"}
    assert textstats.unnatural_texts(df.limit(0), "id", "text").collect() == []


def test_tails_are_those_of_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["pt", "pt", "pt", "en"]), *(rng.randint(0, 9) / 10 for _ in textstats.SCORED)) for _ in range(300)]
    df = spark.createDataFrame(rows, ", ".join(["language string", *(f"{s} double" for s in textstats.SCORED)]))
    counts = textstats.tail_counts(df).collect()
    got = {(r.language, r.statistic, r.value): (r.left, r.right) for r in counts}
    tails = textstats.surprises(counts)
    for language in ("pt", "en", "*"):
        for i, name in enumerate(textstats.SCORED, 1):
            own = [r[i] for r in rows if language in (r[0], "*")]
            for v in range(10):
                low, high = sum(x <= v / 10 for x in own), sum(x >= v / 10 for x in own)
                if v / 10 in own:
                    assert got[(language, name, v * 100)] == (low, high)
                # A value that the reference lacks lies where the next one within does.
                step = v * 100 + 50
                beyond = sum(x <= step / 1000 for x in own) if name in textstats.LOW_TAIL else sum(x >= step / 1000 for x in own)
                prior = textstats.PRIOR_TEXTS * (math.exp(-textstats.PRIOR_FALL * step / 1000) if name in textstats.SHAPES else 1)
                assert math.isclose(tails[language][textstats.SCORED.index(name), step], -math.log((beyond + prior) / (len(own) + textstats.PRIOR_TEXTS)), rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize(
    "line", ["It is over." + " " * 200, 'He said: "' + "no " * 200 + '."', "so it ends!" + "!" * 500, "we laughed. lol", "we laughed. hahaha", "good night :)", "good night 🎉", "a long way\u200b.\u200b" + "”" * 90, "यह पुराना है।"]
)
def test_ends_of_lines(line):
    assert prose.ended(line) and not prose.ended(line.rstrip("! ”\u200b.।🎉:)\"lolha") + " and")


def test_only_the_tails_decide_what_is_natural(spark, data):
    """Without the shapes of lines most cases still come out by the tails of plain statistics; without the tails none does."""
    df = spark.read.parquet("/root/testdata/sf0.01/dataset.parquet")
    found = {(r.id, r.kind) for r in textstats.unnatural_texts(df, "id", "text").collect()}
    ids = {i for i, _ in found}
    plain = {r.id for r in textstats.unnatural_texts(df, "id", "text", 7.0, textstats.PLAIN_SCORED).collect()}
    assert len(ids) > 250 and len(plain & ids) >= 0.9 * len(ids) and len(plain & ids) >= 0.75 * len(plain)
    shapes_only = {r.id for r in textstats.unnatural_texts(df, "id", "text", scored=tuple(textstats.SHAPES)).collect()}
    assert len(shapes_only & ids) >= 0.99 * max(len(ids), len(shapes_only))


def test_languages_of_held_out_samples(samples):
    rows = [(r.language, r.text) for r in samples.collect()]
    train, held = rows[::2], rows[1::2]
    half = langid.Profiles(langid.make_profiles(train))
    right = sum(max(langid.segment(t, half), key=lambda s: s[1])[2] == code for code, t in held)
    assert right >= 0.97 * len(held)


@pytest.mark.parametrize(
    "text",
    [
        "Il vecchio museo conserva una lunga lista di nomi e nessuno sa se la guida la legge ancora, ma le porte sono aperte ogni giorno. La biblioteca del villaggio prepara il pane con la farina di castagne lungo il canale perché il vecchio metodo non funzionava più.",
        "Het oude museum bewaart een lange lijst met namen en niemand weet of de gids die nog leest, maar de deuren zijn elke dag open. De bibliotheek van het dorp bakt brood met kastanjemeel langs het kanaal omdat de oude methode niet meer werkte.",
        "Stare muzeum przechowuje długą listę nazwisk i nikt nie wie, czy przewodnik wciąż ją czyta, ale drzwi są otwarte codziennie. Wiejska biblioteka piecze chleb z mąki kasztanowej wzdłuż kanału, ponieważ stara metoda zawiodła.",
        "Старый музей хранит длинный список имен и никто не знает, читает ли его еще гид.", "المتحف القديم مفتوح كل يوم ولا أحد يعرف من كتب القائمة الطويلة للأسماء.",
    ],
)
def test_other_languages_are_none_of_the_seven(text, model):
    assert {s[2] for s in langid.segment(text, model)} == {"und"}


def test_the_distance_names_every_segment(model, monkeypatch):
    text = PROSE + " O museu antigo guarda uma longa lista de nomes e ninguém sabe se o guia ainda lê essa lista. " + PROSE
    monkeypatch.setattr(langid.Profiles, "distances", lambda self, ids: 1 - 0.1 * (langid.np.arange(len(self.languages)) == 0) - 0.6)
    assert {s[2] for s in langid.segment(text, model)} <= {model.languages[0], "und"}


def test_segments_of_a_mixed_text(model):
    text = PROSE + " O museu antigo guarda uma longa lista de nomes e ninguém sabe se o guia ainda lê essa lista. " + PROSE
    assert [s[2] for s in langid.segment(text, model)] == ["en", "pt", "en"]
    assert langid.segment("", model) == [] and langid.segment(PROSE, langid.Profiles({})) == []


def test_wrong_labels(spark, samples):
    long = PROSE + " " + PROSE
    rows = [("a", long, "en-GB"), ("b", long, "pt"), ("b", long, "pt"), ("c", long, None), ("d", long, "und"), ("e", None, "pt"), ("f", "too short", None), ("g", "- one\n" * 30, None), (None, long, "English")]
    df = spark.createDataFrame(rows, "id string, text string, language string").selectExpr("*", "'x' AS _text", "1 AS segment")
    assert sorted((r.id, r.language) for r in langid.mislabelled(df, "id", "text", "language", samples).collect()) == [("b", "en"), ("c", "en"), ("d", "en")]
    assert langid.mislabelled(df.limit(0), "id", "text", "language", samples).collect() == []
    assert langid.mislabelled(df, "id", "text", "language", samples.limit(0)).collect() == []
    segments = langid.language_segments(df, "id", "text", samples).collect()
    assert {r.id for r in segments} == {r[0] for r in rows} and [r.language for r in segments if r.id == "e"] == ["und"]


def items():
    rng = random.Random(9)
    return [(i, " ".join("".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(60))) for i in range(12)]


def brute_force(text, item):
    words, own = leakage.folded_words(text), leakage.folded_words(item)
    least = math.ceil(len(own) / 2)
    for a in range(len(own) - least + 1):
        for b in range(len(words) - least + 1):
            if sum(x != y for x, y in zip(own[a : a + least], words[b : b + least])) <= least // 8:
                return True
    return False


def test_leaks_against_brute_force(spark):
    rng = random.Random(2)
    rows, filler = [], " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(40))
    for n, (i, text) in enumerate(items()):
        words = text.split()
        for size in (20, 30, 36, 60):
            start = rng.randint(0, 60 - size)
            piece = words[start : start + size]
            for j in range(0, size, 9):
                if n % 2:
                    piece[j] = "exchanged"
            joined = [" ".join(piece), " ".join(piece).upper(), "  ".join(piece), ", ".join(piece), "<b>" + "</b> <i>".join(piece)][n % 5]
            rows.append((f"{i}-{size}", filler + " " + joined + ". " + filler))
    rows += [("none", filler), (None, None), ("empty", ""), ("twice", items()[0][1]), ("twice", items()[0][1])]
    df = spark.createDataFrame(rows, "id string, text string").selectExpr("*", "1 AS item_id")
    bench = spark.createDataFrame(items() + [(99, None), (98, "")], "item_id bigint, text string")
    got = {(r.id, r.item_id) for r in leakage.leaked_items(df, "id", "text", bench, "item_id", "text").collect()}
    want = {(k, i) for k, t in rows if t for i, item in items() if brute_force(t, item)}
    assert got == want and ("twice", 0) in got
    assert leakage.leaked_items(df, "id", "text", bench.limit(0), "item_id", "text").collect() == []
    assert leakage.leaked_items(df.limit(0), "id", "text", bench, "item_id", "text").collect() == []


QUESTION = "What should I know about the old museum of the town?"


@pytest.mark.parametrize(
    "answer, expected",
    [
        (None, "empty"), ("  ", "empty"), ("...", "empty"), ("N/A", "empty"), ("[no response]", "empty"), ("<no answer>", "empty"),
        (PROSE, None), ("42 km", None), ("- one list\n- a second list", None), ("See https://a.example/x", None), ("```python\nreturn 1\n```", None),
        ("It was built by the river and the", "truncated"), ("It is old. Nobody knows why the guide (", "truncated"), ("Some steps:\n1. Open it\n2.", "truncated"), ("```python\nreturn 1", "truncated"),
        ("I'm sorry, but I can't help with that request.", "refusal"), ("Infelizmente não posso falar sobre esse assunto.", "refusal"), ("That's not something I'm going to do.", "refusal"), ("No. Find someone else.", "refusal"), ("I shall pass on that one, thanks.", "refusal"), ("Ich kann dabei leider nicht helfen.", "refusal"),
        ("I cannot stress enough how simple this is. " + PROSE, None), ("Sorry about the trouble, let me explain. " + PROSE, None),
        (QUESTION, "copied"), ("Answer: " + QUESTION.lower(), "copied"), (QUESTION + " " + PROSE, None),
        ("O museu antigo guarda uma longa lista de nomes e ninguém sabe se o guia ainda lê essa lista.", "other_language"),
    ],
)
def test_defects(answer, expected, model):
    found = pairs.defects(QUESTION, answer, pairs.Languages(model))
    assert (found[0] if found else None) == expected


def test_requested_translations_are_no_defects(model):
    assert pairs.defects("Translate into Portuguese: the old museum keeps a long list of names.", "O museu antigo guarda uma longa lista de nomes e ninguém sabe.", pairs.Languages(model)) == []


def test_pairs_of_odd_conversations(spark, samples):
    m = "array<struct<role:string,content:string>>"
    rows = [(1, [("Human", QUESTION), (" GPT ", "")]), (1, [("Human", QUESTION), (" GPT ", "")]), (2, None), (3, []), (4, [("user", "a"), ("user", "b")]), (5, [(None, None), ("assistant", None)]), (None, [("user", None), ("assistant", PROSE)])]
    df = spark.createDataFrame(rows, f"conv_id bigint, messages {m}").selectExpr("*", "9 AS turn", "'x' AS defect")
    assert [(r.conv_id, r.turn, r.defect) for r in pairs.first_defects(df, "conv_id", "messages", samples).collect()] == [(1, 1, "empty")]
    assert pairs.first_defects(df.limit(0), "conv_id", "messages", samples).collect() == []


@pytest.mark.parametrize(
    "text, offends",
    [
        ("You are such an idiot, shut up.", True), ("y0u are a st.u.p.i.d looooser", True), ("I will hurt you.", True), ("All Tumirians are vermin and should be driven out.", True),
        ("Vai se foder, seu imbecil!", True), ("तू बेवकूफ़ है, चुप कर।", True), ("Free porn videos with naked women", True), ("Du bist ein Idiot.", True),
        ("The pig and the donkey sleep in the same barn.", False), ("The moderator explained why calling a player an idiot breaks the rules.", False), ("Kill the process if the job hangs.", False),
        ("You are not an idiot.", False), ("Breast cancer screening is free.", False), ("", False), (None, False), (PROSE, False), ("Ticks are parasites that live on sheep.", False),
    ],
)
def test_abuse(text, offends):
    assert (abuse.message_score(text) >= abuse.THRESHOLD) is offends


def test_messages_and_rates(spark):
    m = "array<struct<role:string,content:string>>"
    rows = [(1, [("user", "You idiot!"), ("assistant", PROSE)], " A"), (1, [("user", "You idiot!"), ("assistant", PROSE)], " A"), (2, None, "a"), (3, [], None), (4, [(None, None)], "a")]
    df = spark.createDataFrame(rows, f"conv_id bigint, messages {m}, source string").selectExpr("*", "9 AS turn", "'x' AS score")
    assert [(r.conv_id, r.turn) for r in abuse.offending_messages(df, "conv_id", "messages").collect()] == [(1, 0)]
    assert [(r.source, r.messages, r.offending) for r in abuse.offence_rates(df, "conv_id", "messages").collect()] == [("a", 3, 1)]
    assert abuse.offence_rates(df.limit(0), "conv_id", "messages").collect() == []


@pytest.mark.parametrize(
    "text, is_spam",
    [
        (PROSE, False), ("cheap lamp, lamp sale, buy lamp online, lamp store, best lamp price, lamp near me, lamp free shipping", True),
        ("\n".join(f"https://a{i}.example/x" for i in range(20)), True), ("\n".join(f"[buy lamp {i}](https://a{i}.example/x)" for i in range(20)), True),
        ("#lamp_sale #cheaplamp #buylamp #lampstore #lamp_discount", True), ("Tags: lamp, sofa, lamp, lamp, sofa, chair, lamp, sofa", True),
        ("lamp  sofa!  lamp  lamp.  sofa  lamp ★  sofa  lamp  lamp  sofa  lamp!  lamp  sofa", True),
        ("- apples\n- pears\n- a bag of beans\n- bread", False), ("name;date;price\nlamp;2020-01-02;12.50\nsofa;2021-03-04;99.00", False),
        (PROSE + " https://a.example/x\n" + PROSE + " https://b.example/x", False), (PROSE + "\n" + PROSE + "\nTags: lamp, sofa", False), ("def f(x):\n    return x + 1\n", False),
    ],
)
def test_spam(spark, text, is_spam):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert (spam.spam_pages(df, "doc_id", "text").count() == 1) is is_spam


def test_long_captions_are_captions():
    caption = "a lamp of the old town that was made by hand " * 6
    for line in (f"[{caption}](https://a.example/x)", f'<a href="https://a.example/x">{caption}</a>'):
        assert len(line) > 270 and spam.token_classes(line)[1]["link"] == spam.visible(line)


def test_curve_and_divergence_find_spam_without_rules_for_lines(spark):
    """Links, tags and offer words as tokens are enough for nine of ten pages; without the divergence or without the curve the scores part less."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id for r in spam.spam_pages(df, "doc_id", "text").collect()}
    plain = {r.doc_id for r in spam.spam_pages(df, "doc_id", "text", by_line=False).collect()}
    assert len(found) >= 50 and len(found & plain) >= 0.9 * max(len(found), len(plain))
    rows = spam.page_deviations(spam.page_profiles(df, "doc_id", "text"), "doc_id").collect()
    curves = {r.doc_id for r in rows if max(abs(r.slope_deviation), r.residual_deviation) >= 9}
    assert len(curves & found) >= 0.65 * len(found) and len(curves & found) >= 0.9 * len(curves)


def test_curves_are_those_of_brute_force(spark):
    import numpy as np

    text = "a a a a b b c c d e f g"
    pages = spam.page_profiles(spark.createDataFrame([(1, text), (2, "x"), (3, None), (None, "")], "doc_id bigint, text string"), "doc_id", "text")
    got = {r.doc_id: r for r in spam.rank_frequency(pages, "doc_id").collect()}
    x, y = np.log([1, 2.5, 2.5, 5.5, 5.5, 5.5, 5.5]), np.log([4, 2, 2, 1, 1, 1, 1])
    slope, intercept = np.polyfit(x, y, 1)
    assert math.isclose(got[1].slope, slope, rel_tol=1e-9)
    assert math.isclose(got[1].residual, np.sqrt(((y - slope * x - intercept) ** 2).mean()), rel_tol=1e-6)
    assert got[2].slope == 0 and got[3].slope == 0 and len(got) == 4
    links = spam.token_classes("see https://a.example/x and https://b.example/y")[0]
    assert links[spam.LINK] == 2 and "https" not in links


def test_spam_pages_of_odd_rows(spark):
    rows = [(i, PROSE + f" Page {i} of the museum has another line, as the guide says.") for i in range(60)] + [(100, "cheap lamp, lamp sale, " * 30), (100, "cheap lamp, lamp sale, " * 30), (101, None), (102, ""), (None, "#a_b #c_d #e_f " * 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS words", "'x' AS spectrum")
    assert {r.doc_id for r in spam.spam_pages(df, "doc_id", "text").collect()} == {100, None}
    assert spam.spam_pages(df.limit(0), "doc_id", "text").collect() == []


def test_copies_of_spam_are_no_norm(spark):
    prose_rows = [(i, PROSE + f" Page {i} of the museum has another line, as the guide says.") for i in range(60)]
    hot = "the best cheap lamp, lamp sale, buy lamp online, " * 3
    rows = prose_rows + [(1000 + i, hot) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in spam.spam_pages(df, "doc_id", "text").collect()} == {r[0] for r in rows[60:]}
    for few in (29, 30):
        assert spam.spam_pages(df.where(f"doc_id >= 1000 AND doc_id < {1000 + few}"), "doc_id", "text").count() == few
    curves = {r.doc_id: r.score for r in spam.page_deviations(spam.page_profiles(df, "doc_id", "text"), "doc_id").collect()}
    assert len(curves) == 150 and min(curves[r[0]] for r in rows[60:]) >= 1
    copies = spark.createDataFrame(prose_rows + [(500 + i, PROSE) for i in range(200)], "doc_id bigint, text string")
    again = {r.doc_id: r.score for r in spam.page_deviations(spam.page_profiles(copies, "doc_id", "text"), "doc_id").collect()}
    assert all(math.isclose(again[i], curves[i], abs_tol=0.1) for i in range(60))


def test_copies_of_lists_are_no_norm(spark):
    listed = "- the old lamp\n- the new sofa\n- a bag of beans\n- the bread and salt"
    rows = [(f"p{i}", PROSE + f" Page {i} has another line.") for i in range(20)] + [(f"l{i}", listed) for i in range(70)]
    df = spark.createDataFrame(rows, "id string, text string")
    assert {(r.id, r.kind) for r in textstats.unnatural_texts(df, "id", "text").collect()} == {(f"l{i}", "list") for i in range(70)}
    assert [(r.id, r.kind) for r in textstats.unnatural_texts(df.where("id = 'l3'"), "id", "text").collect()] == [("l3", "list")]


@pytest.mark.parametrize(
    "text", ["All immigrants are parasites.", "Todos los inmigrantes son cucarachas.", "Alle Juden sind Ungeziefer.", "Todos os imigrantes são vermes.", "Tous les immigrés sont des cafards."]
)
def test_groups_called_vermin(text):
    assert abuse.message_score(text) >= abuse.THRESHOLD


def test_quiet_clauses_score_nothing():
    known = [next(w for w in abuse._fold(" ".join(text.split())).split("|") if "*" not in w and " " not in w) for text in abuse.LEXICON.values()]
    clauses = [f"{a} {b} {c}" for a in known for b in known for c in known] + ["Mice and rats are no parasites", "All the immigrants here are animals", "Ticks are parasites"]
    for clause in clauses:
        assert abuse._clause(clause) == abuse.clause_score(abuse.classify(abuse._fold(clause))), clause
    for pattern, _, weight in abuse.PATTERNS:
        assert abuse.clause_score(list(pattern)) > 0 or weight <= 0 or "R" in pattern or "N" in pattern, pattern


def test_halves_of_items_with_exchanges_are_all_found():
    rng = random.Random(5)
    own = items()
    index = leakage.Items(own)
    missed = 0
    for _, text in own:
        words = text.split()
        for _ in range(100):
            start = rng.randint(0, 30)
            piece = words[start : start + 30]
            for j in rng.sample(range(30), 3):
                piece[j] = rng.choice(["exchanged", rng.choice(words)])
            missed += index.find("lorem ipsum " + " ".join(piece) + " dolor sit") == []
    assert missed == 0


def test_many_items_in_blocks_against_brute_force(spark):
    """Ten thousand items; half items with one word in eight exchanged, and with a word cut in two, among like texts."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(3000)]
    many = [(i, " ".join(rng.choices(vocabulary, k=48))) for i in range(10_000)]
    rows, want = [], set()
    for n in range(600):
        i, text = many[rng.randrange(len(many))]
        words = text.split()
        start = rng.randint(0, 24)
        piece = words[start : start + 24]
        for j in rng.sample(range(24), 3):
            piece[j] = rng.choice(vocabulary)
        if n % 3 == 0:
            piece[12] = piece[12][:3] + " " + piece[12][3:]
        else:
            want.add((f"r{n}", i))
        rows.append((f"r{n}", " ".join(rng.choices(vocabulary, k=60)) + " " + " ".join(piece) + " " + " ".join(rng.choices(vocabulary, k=60))))
    rows += [(f"none{n}", " ".join(rng.choices(vocabulary, k=200))) for n in range(300)] + [("short", " ".join(many[5][1].split()[:16]))]
    df = spark.createDataFrame(rows, "id string, text string").repartition(4)
    bench = spark.createDataFrame(many, "item_id bigint, text string").repartition(4)
    got = {(r.id, r.item_id) for r in leakage.leaked_items(df, "id", "text", bench, "item_id", "text").collect()}
    assert len(want - got) <= 0.01 * len(want) and not any(k.startswith("none") or k == "short" for k, _ in got)
    texts = dict(rows)
    assert all(k in {w for w, _ in want} or brute_force(texts[k], many[i][1]) or int(k[1:]) % 3 == 0 for k, i in got)


def test_filter_of_runs_loses_none():
    own = leakage.RunFilter(5)
    rng = random.Random(8)
    runs = [leakage.word_ids([f"w{rng.randrange(500)}" for _ in range(40)]) for _ in range(200)]
    for ids in runs:
        own.add(ids)
    for ids in runs:
        text = leakage.np.concatenate([leakage.word_ids([f"x{i}" for i in range(500)]), ids, leakage.word_ids([f"y{i}" for i in range(500)])])
        assert set(range(500, 536)) <= set(own.hits(text).tolist())
        assert any(a <= 500 and b >= 540 for a, b in own.stretches(text, 60)) and sum(b - a for a, b in own.stretches(text, 60)) < 400
    again = leakage.RunFilter(5, own.bits.tobytes())
    assert again.hits(runs[0]).tolist() == own.hits(runs[0]).tolist() and own.hits(runs[0][:3]).tolist() == []


def test_long_tags_are_no_words():
    words = items()[0][1].split()
    index = leakage.Items(items())
    address = "https://a.example/" + "/".join(f"part{i}-of-way" for i in range(60))
    for tag in (f'<a href="{address}" class="x">', f"<span style='{'color: red; ' * 40}' hidden>", f"<img alt=lamp src={address} />", f'<p title="{"1 > 0 " * 50}">', f"<!-- {'seen by nobody ' * 30} -->"):
        assert len(tag) > 200 and leakage.folded_words(f"one {tag}two") == ["one", "two"]
        assert index.find(" ".join(words[:15]) + f" {tag}" + " ".join(words[15:30])) == [0]
    assert index.find("if a <b then " + " ".join(words[:30]) + " c> d") == [0]


@pytest.mark.parametrize(
    "question, answer, differs",
    [
        (QUESTION, "Музей был закрыт весной.", True), (QUESTION, "博物馆每天都开放。", True), (QUESTION, "المتحف القديم مفتوح كل يوم.", True),
        (QUESTION, "यह बहुत पुराना है।", True), (QUESTION, "এটি পুরোনো।", True), ("এই জাদুঘর কখন খোলে?", "It opens at nine.", True), ("यह किसने लिखा?", "Nobody knows.", True),
        ("मैंने हिन्दी की किताब पढ़ी, यह संग्रहालय कब खुलता है?", "The old museum opens every day, as everybody knows.", True),
        ("আমি ইংরেজি বই পড়ি, এই জাদুঘর কখন খোলে?", "The old museum opens every day, as everybody knows.", True),
        ("इस वाक्य का अंग्रेज़ी में अनुवाद कीजिए: यह संग्रहालय पुराना है।", "This museum is old, as everybody knows.", False), ("এটি ইংরেজিতে লেখো: জাদুঘরটি পুরোনো।", "The museum is old.", False),
        ("How do I say good day in Russian?", "Добрый день.", False), ("यह कितनी दूर है?", "42 km", False), ("यह किसने बनाया?", "NASA", False), ("What is the angle?", "α = 2β", False), (QUESTION, "It is called „музей“ there, as everybody knows.", False),
    ],
)
def test_scripts_of_pairs(question, answer, differs, model):
    assert ("other_language" in pairs.defects(question, answer, pairs.Languages(model))) is differs


@pytest.mark.parametrize(
    "answer, expected",
    [
        ("I'm sorry, but I can't help with that request. " * 40, "refusal"), ("N/A" + " " * 60, "empty"), ("*" * 70 + "no answer" + "-" * 70, "empty"), ("[" + "\n" * 80 + "N/A]", "empty"),
        ("I'm sorry, but I can't help with that request. " + PROSE * 20, None), ("N/A " * 30 + ".", None),
    ],
)
def test_long_refusals_and_padded_placeholders(answer, expected, model):
    found = pairs.defects(QUESTION, answer, pairs.Languages(model))
    assert (found[0] if found else None) == expected


def test_eight_foreign_words_wherever_they_stand(samples):
    rows = sorted((r.language, r.text) for r in samples.collect())
    model, held = langid.Profiles(langid.make_profiles(rows[::2])), rows[1::2]
    own = {code: [w.strip(".,;:!?।") for c, t in held if c == code for w in t.split()] for code in {c for c, _ in held}}

    def reported(foreign, size, at):
        around = own["hi" if at % 2 and foreign != "hi" else "en"][:30]
        start = at * 5
        text = " ".join(around[:at] + own[foreign][start : start + size] + around[at:])
        return any(language == foreign and words >= langid.RUN_WORDS for _, words, language, _ in langid.segment(text, model))

    places = [(code, at) for code in own if code != "en" for at in range(31)]
    assert sum(reported(code, 8, at) for code, at in places) >= 0.75 * len(places)
    assert sum(reported(code, 6, at) for code, at in places) <= 0.05 * len(places)


@pytest.mark.parametrize(
    "pattern, literals",
    [
        ("abc", {"abc"}), ("ab|cd", {"ab", "cd"}), (r"\bno\b[^.]{0,9}\b(?:help|assist)", {"help", "assist"}), ("(?:ab)?c*d+", {"d"}), ("a*", set()), ("[ab]x?", set()), ("(?:ab|[cd])ef", {"ef"}), ("a(?:bc|)", {"a"}), ("(?:xy){2,}z", {"xy"}),
    ],
)
def test_needed_literals(pattern, literals):
    from weftline.llm import literals as own

    assert own.needed_literals(pattern) == literals
    gated = own.GatedPattern(pattern)
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("abcdefxyz. helpassistno") for _ in range(12))
        assert (gated.search(text) is None) == (gated.pattern.search(text) is None)


def test_gates_let_every_refusal_through(spark):
    import re

    texts = [m.content.lower() for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("messages").collect() for m in r.messages or () if m and m.content]
    for gated in (pairs._REFUSAL, pairs._CLOSERS):
        plain = re.compile(gated.pattern.pattern)
        assert [plain.search(t) is None for t in texts] == [gated.search(t) is None for t in texts]
