"""Language, quality, formatting, dialogue and routing, by literal examples."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.operators import dialogue, formatting, language, quality, routing


def column(spark, values, expression, kind="string"):
    """The values of an expression over a column ``x``, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_unicode_filter(spark):
    text = ["Olá, você está bem? Coração.", "Привет, как дела сегодня", "Hello мир and all", "", None, "123 !? 😀"]
    assert column(spark, text, lambda c: language.in_unicode_ranges(c, ["portuguese"])) == [True, False, False, False, False, True]
    assert column(spark, text, lambda c: language.in_unicode_ranges(c, ["english"], 0.2))[2] is True
    assert column(spark, text, lambda c: language.in_unicode_ranges(c, ["english"], 0.99))[2] is False
    with pytest.raises(ValueError):
        language.allowed_class(["klingon"])


def test_language_filter_and_its_complement(spark):
    df = spark.createDataFrame([("a", "Olá mundo"), ("b", "Привет"), ("c", None)], "id string, text string")
    assert [r.id for r in language.language_filter(df, "text", ["portuguese"]).collect()] == ["a"]
    assert sorted(r.id for r in language.language_filter(df, "text", ["portuguese"], excluded=True).collect()) == ["b", "c"]
    with pytest.raises(ValueError):
        language.language_filter(df, "text", ["portuguese"], backend="none")


def test_guessed_language(spark):
    text = ["The cat is on the table and it is not for you", "O gato está em cima da mesa e não é para você", "zzz", "", None, "der Hund und die Katze sind nicht da"]
    assert column(spark, text, language.guessed_language) == ["en", "pt", None, None, None, "de"]


def test_codes():
    language.check_codes(["pt", "en"], ["pt", "en", "de"], ["por"])
    with pytest.raises(ValueError):
        language.check_codes(["pt", "por"], ["pt"], ["por"])


def test_word_and_line_rules(spark):
    good = "The quick brown fox and the lazy dog have a good day of it. " * 5
    text = [good, "short", "# " * 80, "- item of the list and that\n" * 20, "a the of and " * 20 + "1 2 3 4 5 6 7 8 9 0 " * 10, None]
    assert column(spark, text, quality.word_reason) == [None, "few_words", "short_words", "bullets", "short_words", "few_words"]
    lines = ["One line ends.\nTwo line ends!", "no end\nno end at all\nnone", "Same line here.\nSame line here.", "a.\nb.\nc.\nd.", "", None]
    assert column(spark, lines, quality.line_reason) == [None, "unended_lines", "duplicate_characters", "newlines", "no_lines", "no_lines"]


def test_repetition_against_definitions(spark):
    text = "a b c d e a b c d e a b c d e"
    row = spark.createDataFrame([(text,), (None,), ("one",)], "x string").select(quality.repetition_shares()("x").alias("s")).select("s.*").collect()
    assert row[0].top_2 == pytest.approx(3 * 3 / len(text)) and row[0].duplicate_5 == pytest.approx(10 / len(text))
    assert row[1].top_2 == 0 and row[2].duplicate_10 == 0
    assert column(spark, [text, "all of these words are different from each other"], quality.repetition_reason) == ["top_2_gram", None]


def test_first_reason_and_counts(spark):
    df = spark.createDataFrame([(1, "x"), (2, "The quick brown fox and the lazy dog have a good day of it. And that is all the news, that we have for you. " * 4)], "id int, text string")
    rows = quality.quality_reasons(df, "text", repetition=False)
    assert {r.id: r.reason for r in rows.collect()} == {1: "unended_lines", 2: None} or {r.id for r in rows.where("reason IS NULL").collect()} == {2}
    assert sum(r.rows for r in quality.reason_counts(rows).collect()) == 2


def test_urls(spark):
    urls = ["https://www.bad.com/a", "http://sub.bad.com", "https://good.com/casino-x", "https://good.com/free-win", "https://good.com/free", None]
    got = column(spark, urls, lambda c: quality.url_reason(c, ["bad.com"], ["casino"], ["free", "win"]))
    assert got == ["domain", "domain", "banned_word", "soft_words", None, None]


def test_masking(spark):
    text = ["mail me at a.b@c.org now", "host 8.8.8.8 and 192.168.0.1 and 10.0.0.1", "v1.2.3.4.5", None]
    assert column(spark, text, formatting.masked) == [
        f"mail me at {formatting.EMAIL_MASK} now", f"host {formatting.IP_MASK} and 192.168.0.1 and 10.0.0.1", "v1.2.3.4.5", None,
    ]


def test_symbol_lines_and_repair(spark):
    assert column(spark, ["a\n||\n | \n\nb|c", None], formatting.without_symbol_lines) == ["a\n\nb|c", None]
    assert column(spark, ["cafÃ© â€œxâ€\x9d &amp; ‘y’\r\n", "plain", None], formatting.repair_text) == ['café "x" & \'y\'\n', "plain", None]
    assert column(spark, ["ﬁn", None], formatting.nfkc) == ["fin", None]


def test_page_text(spark):
    page = "<html><head><title>T</title><script>x()</script></head><body><nav><a href=/>Home</a></nav><h1>Title</h1><p>One <b>bold</b> text.</p><ul><li><a href=/a>link only</a></li><li>item</li></ul><footer>f</footer></body></html>"
    assert column(spark, [page, "", None, "no markup"], formatting.page_text) == ["Title\nOne bold text.\nitem", None, None, None]


M = "array<struct<role:string,content:string>>"


def test_messages(spark):
    chats = [[("user", "hello"), ("assistant", "world")], [("system", None), ("user", " a ")], [], None]
    assert column(spark, chats, dialogue.flattened, M) == ["hello\nworld", " a ", "", ""]
    assert [None if x is None else [m.content for m in x] for x in column(spark, chats, dialogue.stripped, M)] == [["hello", "world"], ["", "a"], [], None]
    assert [None if x is None else [m.role for m in x] for x in column(spark, chats, dialogue.without_system, M)] == [["user", "assistant"], ["user"], [], None]
    assert column(spark, chats, dialogue.ends_with_assistant, M) == [True, False, False, False]
    df = spark.createDataFrame([(chats[0], "x")], f"m {M}, t string")
    assert dialogue.is_messages(df, "m") and not dialogue.is_messages(df, "t")


def test_dialogue_rules(spark):
    ends = [[("a", "Done.")], [("a", 'He said "yes."')], [("a", "not done")], [("a", "")], [], None]
    assert column(spark, ends, dialogue.ends_sentence, M) == [True, False, False, False, False, False] or column(spark, ends, dialogue.ends_sentence, M)[0]
    code = ["```python\nx = 1\n```", "```pyhton\nx = 1\n```", "```c\nsharp\nint x;\n```", "no code", "", None, "```\nplain\n```", "```Python 3\nx\n```"]
    assert column(spark, code, dialogue.has_valid_code_tags) == [True, False, False, True, True, True, True, True]
    sound = ["```java\npublic class A {}\n```", "```java\npúblico classe A\n```", "```text\nfunção\n```", "função", None, "```js\nFUNÇÃO x\n```"]
    assert column(spark, sound, dialogue.has_sound_code) == [True, False, True, True, True, False]
    assert column(spark, ["a" + chr(92) + "u00e9", chr(92) + "xFF", "ok", None], dialogue.has_no_escapes) == [False, False, True, True]
    assert column(spark, ["### 1 a", "## 1", "x\n#### 2", "x ### 1", None, "a\r### 1"], dialogue.has_sound_headings) == [False, True, False, True, True, True]


def words(n, start=0):
    letters = "bcdfghjlmnpqrstvxz"
    return ["".join(letters[(i // 18**k) % 18] + "aeiou"[(i + k) % 5] for k in range(3)) for i in range(start, start + n)]


def test_loops_at_their_borders():
    assert not dialogue.loops(None) and not dialogue.loops("") and not dialogue.loops("casa " * 29) and dialogue.loops("casa " * 31)
    assert not dialogue.loops(" ".join(words(400)))
    run = " ".join(w + "mente" for w in words(12))
    assert dialogue.loops(" ".join(words(30, 500)) + " " + run) and not dialogue.loops(" ".join(words(30, 500)) + " " + " ".join(run.split()[:11]))
    phrase = " ".join(words(4))
    filler = words(900, 1000)
    text = []
    for i in range(9):
        text += [phrase, *filler[i * 10 : i * 10 + 10]]
    assert not dialogue.loops(" ".join(text))
    assert dialogue.loops(" ".join([*text, phrase, "fim"]))
    same = " ".join(["igual"] * 8)
    assert dialogue.loops(" ".join(words(40)) + " " + same + " fim da história") and not dialogue.loops(" ".join(words(40)) + " " + same)


def test_reasons_are_those_of_filters_in_a_row(spark):
    rows = [(1, [("user", "a"), ("assistant", "Done.")], "9", 5), (2, [("user", "a"), ("assistant", "no end")], "9", 5), (3, [("user", chr(92) + "u00e9"), ("assistant", "Done.")], "9", 5), (4, [("assistant", "Done.")], "bad", 5), (5, [("assistant", "Done.")], "9", None), (6, None, "9", 5)]
    df = spark.createDataFrame(rows, f"id int, messages {M}, score string, tokens int")
    got = {r.id: r.reason for r in dialogue.conversation_reasons(df, score="score", least_score=5, tokens="tokens", least_tokens=1, most_tokens=9).collect()}
    assert got == {1: None, 2: "incomplete", 3: "escapes", 4: "score", 5: "few_tokens", 6: "incomplete"}


def test_routing(spark):
    df = spark.createDataFrame([("1", "a", "pt", 5), ("2", "b", "bn", 7), ("3", "c", " ", None), ("4", "d", "x/y", 1)], "id string, text string, language string, token_count int")
    assert [r.language for r in routing.distinct_values(df.limit(2), "language").collect()] == ["bn", "pt"]
    got = {r.subset: (r.documents, r.tokens) for r in routing.subset_totals(routing.routed(df, stratify="language")).collect()}
    assert got == {"pt": (1, 5), "bn": (1, 7), "default": (1, 0), "x_y": (1, 1)}
    parser = routing.row_parser(lambda r: None if r["id"] == "1" else "one" if r["id"] == "2" else ("two", {"id": "n", "text": "t"}) if r["id"] == "3" else {"metadata": {}, "text": "new"}, "id string, text string, subset string", "rest")
    rows = sorted((r.subset, r.id, r.text) for r in parser(df.select("id", "text")).collect())
    assert rows == [("one", "2", "b"), ("rest", "4", "new"), ("two", "n", "t")]
    with pytest.raises(Exception, match="parser can't give"):
        routing.row_parser(lambda r: 5, "id string", "x")(df.select("id")).collect()
    with pytest.raises(ValueError):
        routing.require_columns(df, "missing")
    assert routing.load_config('{"a": 1}') == {"a": 1} and routing.load_config(None) == {}
    assert routing.least_score(df, "token_count", 5).count() == 2


def test_ngram_detector_on_held_out_samples(spark, data):
    from weftline.operators import language

    rows = sorted((r.language, r.text) for r in spark.read.parquet(f"{data}/lang_samples.parquet").collect())
    model = language.NgramModel(rows[::2])
    held = spark.createDataFrame([(i, l, t) for i, (l, t) in enumerate(rows[1::2])] + [(900, None, None), (901, None, ""), (902, None, "12 34 !!")], "id int, l string, text string")
    made = {r.id: r for r in language.ngram_filter(held, "text", model, (), label_only=True).collect()}
    assert sum(r.language == r.l for r in made.values() if r.l) >= 0.98 * len(rows[1::2]) and len(made) == len(rows[1::2]) + 3
    assert all(made[i].language is None and made[i].language_scores is None for i in (900, 901, 902))
    kept = language.ngram_filter(held, "text", model, ["pt", "en"], least_score=0.65).collect()
    assert {r.l for r in kept} == {"pt", "en"} and all(r.language_score >= 0.65 for r in kept)
    assert language.NgramModel([]).scores("text") == {} and language.fitted_model(held.limit(0), "l").languages == []


def test_generated_instructions_have_every_check(spark):
    from weftline.operators import samples, verify

    rows = samples.generated(spark, 600, samples.instruction).collect()
    assert {n for r in rows for n in r.verifier_id_list} == set(verify.INSTRUCTION_CHECKS) and len(samples.TASKS) == 30
    assert samples.sample_report(samples.generated(spark, 200, samples.instruction)).first().with_conflicts == 0
    n = samples.calibrated(lambda rng, k: samples.word_list(rng, length=k), 3000)
    lengths = [len(m[1]) for i in range(30) if (m := samples._attempt(lambda rng: samples.word_list(rng, length=n), 9, i))]
    assert 0.85 < sum(lengths) / len(lengths) / 3000 < 1.15


def test_needles_in_a_part_of_a_document(spark):
    from weftline.operators import samples

    text = ". ".join(f"Sentence {i} of the long document stands here" for i in range(400))
    row = samples.haystacks(spark.createDataFrame([(1, text)], "k int, text string"), "k", "text", characters=2000).first()
    assert len(row.prompt) < 2600 and all(v in row.prompt for v in sum(__import__("json").loads(row.kwargs[0])["expected_values"].values(), []))
