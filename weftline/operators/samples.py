"""Generated tasks with checks: instructions, word lists, needles in documents, arithmetic, e-mails and tool calls.

Every sample is made from its number and a seed, so that any partition of the numbers gives the same samples; its id is
the MD5 of its prompt, and a sample has the names of its checks and their parameters as JSON strings.
"""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter
from collections.abc import Callable
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .verify import INSTRUCTION_CHECKS, conflict_pairs

SCHEMA = "row bigint, id string, prompt string, verifier_id_list array<string>, kwargs array<string>"
ATTEMPTS = 20
#: Plain words for generated texts.
WORDS = "casa livro rio ponte mesa porta janela campo cidade noite tarde vento chuva pedra folha barco estrada jardim escola mercado relógio espelho cadeira caminho montanha praia música carta chave lâmpada".split()
#: Tasks that instructions are attached to, by what they ask for; ``{}`` stands for a word.
TASKS = tuple(
    f"{verb} {what}."
    for verb, objects in (
        ("Escreva", ("um parágrafo sobre {}", "uma história curta em que aparece {}", "um anúncio para {}", "uma carta a um amigo sobre {}", "um diálogo entre duas pessoas sobre {}", "um poema sobre {}")),
        ("Explique", ("a uma criança o que é {}", "por que {} é importante", "como se cuida de {}", "a diferença entre {} e o seu contrário", "em que situações se usa {}")),
        ("Descreva", ("{} em detalhes", "um dia em que {} muda tudo", "o cheiro e o som de {}", "{} como se fosse a primeira vez", "um lugar onde há {}")),
        ("Faça", ("um resumo do que se sabe sobre {}", "uma comparação entre {} e outra coisa", "um roteiro de visita a {}", "um plano de aula sobre {}", "um elogio a {}")),
        ("Dê", ("três razões para gostar de {}", "um conselho a quem procura {}", "exemplos de {} na vida diária", "um nome a um projeto sobre {}", "um título a um livro sobre {}")),
        ("Conte", ("uma lembrança ligada a {}", "o que aconteceu com {}", "a origem de {}", "um sonho com {}")),
    )
    for what in objects
)


class Rejected(Exception):
    """A sample that can't be used; another attempt is made."""


def _sample(prompt: str, checks: list[tuple[str, dict]]) -> tuple[str, str, list[str], list[str]]:
    return hashlib.md5(prompt.encode()).hexdigest(), prompt, [c for c, _ in checks], [json.dumps(p, ensure_ascii=False) for _, p in checks]


def _attempt(make: Callable[[random.Random], tuple], seed: int, row: int):
    """The first usable sample of up to ``ATTEMPTS``, each with its own seed; None if there is none."""
    for attempt in range(ATTEMPTS):
        try:
            return make(random.Random(seed + row * ATTEMPTS + attempt))
        except Rejected:
            continue
    return None


def generated(spark: SparkSession, n: int, make: Callable[[random.Random], tuple], seed: int = 42) -> DataFrame:
    """Samples of rows 0 to n - 1; rows without a usable attempt, and prompts seen in an earlier row, are left out."""

    def run(batches):
        for batch in batches:
            rows = [(r, *s) for r in batch.column(0).to_pylist() if (s := _attempt(make, seed, r))]
            if rows:
                cols = list(zip(*rows))
                lists = pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3], lists), pa.array(cols[4], lists)], names=["row", "id", "prompt", "verifier_id_list", "kwargs"]
                )

    made = spark.range(n).mapInArrow(run, SCHEMA)
    first = made.groupBy("id").agg(F.min_by(F.struct("row", "prompt", "verifier_id_list", "kwargs"), "row").alias("s"))
    return first.select(F.col("s.row").alias("row"), "id", "s.prompt", "s.verifier_id_list", "s.kwargs")


def _parameters(name: str, rng: random.Random) -> tuple[dict, str]:
    """Parameters of a check and the words that ask for it."""
    n = rng.randint(2, 6)
    word = rng.choice(WORDS)
    table = {
        "keywords:existence": ({"keywords": [word]}, f"Use a palavra {word}."),
        "keywords:forbidden_words": ({"forbidden_words": [word]}, f"Não use a palavra {word}."),
        "keywords:frequency": ({"keyword": word, "frequency": n, "relation": "at least"}, f"Use a palavra {word} pelo menos {n} vezes."),
        "keywords:letter_frequency": ({"letter": word[0], "let_frequency": n * 3, "let_relation": "at least"}, f"A letra {word[0]} deve aparecer {n * 3} vezes ou mais."),
        "language:response_language": ({"language": "pt"}, "Responda em português."),
        "length_constraints:number_words": ({"num_words": n * 50, "relation": "at least"}, f"Use pelo menos {n * 50} palavras."),
        "length_constraints:number_sentences": ({"num_sentences": n, "relation": "at least"}, f"Escreva pelo menos {n} frases."),
        "length_constraints:number_paragraphs": ({"num_paragraphs": n}, f"Divida a resposta em {n} partes, com três asteriscos entre elas."),
        "length_constraints:nth_paragraph_first_word": ({"num_paragraphs": n, "nth_paragraph": 1, "first_word": word}, f"Escreva {n} parágrafos com uma linha vazia entre eles; o primeiro começa com {word}."),
        "detectable_content:number_placeholders": ({"num_placeholders": n}, f"Inclua pelo menos {n} campos entre colchetes."),
        "detectable_content:postscript": ({"postscript_marker": "P.S."}, "Termine com uma nota que começa com P.S."),
        "detectable_format:number_bullet_lists": ({"num_bullets": n}, f"Use exatamente {n} itens com asterisco."),
        "detectable_format:constrained_response": ({}, "Responda apenas com sim, não ou talvez, na frase combinada."),
        "detectable_format:number_highlighted_sections": ({"num_highlights": n}, f"Destaque {n} trechos entre asteriscos."),
        "detectable_format:multiple_sections": ({"section_spliter": "Parte", "num_sections": n}, f"Organize o texto em {n} seções, de Parte 1 a Parte {n}."),
        "detectable_format:title": ({}, "Dê um título entre << e >>."),
        "detectable_format:json_format": ({}, "Responda em JSON."),
        "combination:two_responses": ({}, "Dê duas respostas diferentes, com seis asteriscos entre elas."),
        "combination:repeat_prompt": ({"prompt_to_repeat": f"Sobre {word}:"}, f"Comece repetindo exatamente: Sobre {word}:"),
        "punctuation:no_comma": ({}, "Não use vírgulas."),
        "startend:quotation": ({}, "Ponha toda a resposta entre aspas duplas."),
        "startend:end_checker": ({"end_phrase": "É tudo por hoje."}, "Termine com a frase: É tudo por hoje."),
        "change_case:capital_word_frequency": ({"capital_frequency": n, "capital_relation": "at least"}, f"Escreva {n} palavras ou mais em maiúsculas."),
        "change_case:portuguese_capital": ({}, "Escreva só com letras maiúsculas."),
        "change_case:portuguese_lowercase": ({}, "Escreva só com letras minúsculas."),
    }
    if name not in table:
        raise Rejected
    return table[name]


def instruction(rng: random.Random) -> tuple:
    """A task with one to four checks that go together."""
    apart = set(conflict_pairs())
    chosen: list[str] = []
    for name in rng.sample(INSTRUCTION_CHECKS, len(INSTRUCTION_CHECKS)):
        if len(chosen) == rng.randint(1, 4):
            break
        if all((name, c) not in apart for c in chosen):
            chosen.append(name)
    made = []
    asked = [rng.choice(TASKS).format(rng.choice(WORDS))]
    for name in chosen:
        parameters, words = _parameters(name, rng)
        made.append((name, parameters))
        asked.append(words)
    used = [w for _, p in made for w in p.get("keywords", [])]
    if not made or any(w in used for _, p in made for w in p.get("forbidden_words", [])):
        raise Rejected
    return _sample(" ".join(asked), made)


def word_list(rng: random.Random, length: int = 200, top: int = 3) -> tuple:
    """A list of words and a question: the most or least frequent ones, a count, a place, a comparison; without ties that matter."""
    pool = rng.sample(WORDS, min(len(WORDS), max(top + 3, length // 12)))
    weights = [1 / (i + 1) for i in range(len(pool))]
    words = rng.choices(pool, weights, k=length)
    counts = Counter(words)
    ordered = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    kind = rng.choice(("common_words", "rare_words", "count_word", "word_at_position", "frequency_comparison"))
    listed = "Lista de palavras: " + ", ".join(words) + "\n\n"
    if kind in ("common_words", "rare_words"):
        side = ordered if kind == "common_words" else sorted(counts.items(), key=lambda x: (x[1], x[0]))
        if len(side) <= top or side[top - 1][1] == side[top][1]:
            raise Rejected
        which = "mais" if kind == "common_words" else "menos"
        return _sample(f"{listed}Diga as {top} palavras que a lista tem {which} vezes.", [(f"long_context:{kind}", {"expected_words": [w for w, _ in side[:top]]})])
    if kind == "count_word":
        word = rng.choice(pool)
        return _sample(f'{listed}Conte quantas vezes a lista tem "{word}".', [("long_context:count_word", {"target_word": word, "expected_count": counts[word]})])
    if kind == "word_at_position":
        place = rng.randrange(length)
        return _sample(f"{listed}Diga que palavra está no lugar {place + 1}.", [("long_context:word_at_position", {"position": place + 1, "expected_word": words[place]})])
    a, b = rng.sample(sorted(counts), 2)
    if counts[a] == counts[b]:
        raise Rejected
    return _sample(f'{listed}De "{a}" e "{b}", diga a que a lista tem mais vezes.', [("long_context:frequency_comparison", {"word_a": a, "word_b": b, "expected_winner": max((a, b), key=counts.__getitem__)})])


def _tree(rng: random.Random, depth: int):
    if depth == 0 or rng.random() < 0.2:
        return rng.randint(1, 99)
    return rng.choice("+-*/"), _tree(rng, depth - 1), _tree(rng, depth - 1)


def _value(tree) -> Fraction:
    if isinstance(tree, int):
        return Fraction(tree)
    sign, a, b = tree[0], _value(tree[1]), _value(tree[2])
    if sign == "/":
        if b == 0:
            raise Rejected
        return a / b
    return a + b if sign == "+" else a - b if sign == "-" else a * b


def _written(tree) -> str:
    return str(tree) if isinstance(tree, int) else f"({_written(tree[1])} {tree[0]} {_written(tree[2])})"


def arithmetic(rng: random.Random) -> tuple:
    """An expression of depth 1 to 3 and its value, a whole number or a decimal of up to two places."""
    tree = _tree(rng, rng.randint(1, 3))
    if isinstance(tree, int):
        raise Rejected
    value = _value(tree)
    if (value * 100).denominator != 1:
        raise Rejected
    answer = str(value) if value.denominator == 1 else f"{float(value):.2f}".rstrip("0")
    return _sample(f"Calcule: {_written(tree)[1:-1]}", [("math:answer_check", {"expected_answer": answer, "relaxed": True})])


def email(rng: random.Random) -> tuple:
    """An e-mail with five fields and the checks of a JSON object of some of them."""
    fields = {
        "remetente": f"{rng.choice(WORDS)}@{rng.choice(WORDS)}.example", "assunto": f"Sobre {rng.choice(WORDS)}", "data": f"20{rng.randint(10, 25)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
        "prioridade": rng.choice(("alta", "média", "baixa")), "anexo": rng.random() < 0.5,
    }
    asked = sorted(rng.sample(sorted(fields), rng.randint(2, 5)))
    shown = "\n".join(f"{k}: {('sim' if v else 'não') if isinstance(v, bool) else v}" for k, v in fields.items())
    body = " ".join(rng.choices(WORDS, k=40))
    one = rng.choice(asked)
    checks = [("email:json_format", {}), ("email:schema_keys", {"required_keys": asked}), ("email:field_value", {"field_name": one, "expected_value": fields[one]})]
    return _sample(f"{shown}\n\n{body}.\n\nDevolva um JSON com os campos {', '.join(asked)}.", checks)


def tool_call(rng: random.Random) -> tuple:
    """A request for one of some tools, or one that no tool serves."""
    tools = []
    for name in rng.sample(WORDS, 4):
        arguments = {a: rng.choice(("string", "integer", "boolean")) for a in rng.sample(WORDS, 3)}
        tools.append({"name": f"buscar_{name}", "parameters": arguments, "required": sorted(arguments)[:2]})
    shown = "\n".join(json.dumps(t, ensure_ascii=False) for t in tools)
    if rng.random() < 0.2:
        return _sample(f"Ferramentas:\n{shown}\n\nQual é o sentido da vida?", [("tool_call:format", {"expect_call": False}), ("tool_call:refusal", {"min_refusal_words": 5})])
    tool = rng.choice(tools)
    given = [a for a in tool["parameters"] if a in tool["required"] or rng.random() < 0.4]
    values = {a: {"string": rng.choice(WORDS), "integer": rng.randint(1, 99), "boolean": rng.random() < 0.5}[tool["parameters"][a]] for a in given}
    checks = [
        ("tool_call:format", {"expect_call": True}), ("tool_call:name", {"expected_name": tool["name"]}), ("tool_call:args_keys", {"required_arg_keys": tool["required"]}),
        ("tool_call:args_types", {"expected_arg_types": {a: tool["parameters"][a] for a in tool["required"]}}),
    ]
    return _sample(f"Ferramentas:\n{shown}\n\nUse {tool['name']} com " + ", ".join(f"{k} = {v}" for k, v in values.items()), checks)


GENERATORS: dict[str, Callable[[random.Random], tuple]] = {"instructions": instruction, "word_lists": word_list, "math": arithmetic, "emails": email, "tool_calls": tool_call}


def calibrated(make: Callable[[random.Random, int], tuple], characters: int, probes: int = 20, seed: int = 42) -> int:
    """The size with which ``make`` gives prompts of about so many characters, by its prompts of two sizes over a few seeds."""

    def mean(size: int) -> float:
        made = [_attempt(lambda rng: make(rng, size), seed, row) for row in range(probes)]
        lengths = [len(m[1]) for m in made if m]
        if not lengths:
            raise ValueError(f"no sample of size {size}")
        return sum(lengths) / len(lengths)

    low, high = mean(50), mean(200)
    per_item = max(1e-9, (high - low) / 150)
    return max(1, round(50 + (characters - low) / per_item))


def _chunk(sentences: list[str], characters: int, rng: random.Random) -> list[str]:
    """A run of sentences of at most so many characters, from a place by chance; one sentence at least."""
    if sum(map(len, sentences)) + 2 * len(sentences) <= characters:
        return sentences
    first = rng.randrange(len(sentences))
    held, last = 0, first
    while last < len(sentences) and (last == first or held + len(sentences[last]) + 2 <= characters):
        held += len(sentences[last]) + 2
        last += 1
    return sentences[first:last]


def _needles(rng: random.Random, text: str, characters: int | None = None) -> tuple:
    """A document, or a run of its sentences of at most ``characters``, with needles between and a question about them."""
    sentences = [s for s in text.replace("\n", " ").split(". ") if s]
    if characters is not None:
        sentences = _chunk(sentences, characters, rng)
    kind = rng.choice(("needle_single_number", "needle_multi_number_same_key", "needle_multi_number_diff_keys", "needle_uuid"))
    keys = rng.sample(WORDS, 3)
    if kind == "needle_uuid":
        value = str(hashlib.md5(str(rng.random()).encode()).hexdigest())
        facts, values, asked = [f"O código de {keys[0]} é {value}"], {keys[0]: [value]}, f"Qual é o código de {keys[0]}?"
    else:
        numbers = [str(rng.randint(100_000, 999_999)) for _ in range(1 if kind == "needle_single_number" else 3)]
        names = keys if kind.endswith("diff_keys") else [keys[0]] * len(numbers)
        values: dict[str, list[str]] = {}
        for k, v in zip(names, numbers):
            values.setdefault(k, []).append(v)
        facts = [f"O número de {k} é {v}" for k, v in zip(names, numbers)]
        asked = "Quais são os números de " + ", ".join(values) + "?"
    for fact in facts:
        sentences.insert(rng.randint(0, len(sentences)), fact)
    return _sample(". ".join(sentences) + f".\n\n{asked}", [(f"haystack:{kind}", {"expected_values": values})])


def haystacks(df: DataFrame, key: str, text: str, seed: int = 42, characters: int | None = None) -> DataFrame:
    """A sample with needles for each document that isn't blank, by a seed from its key; with ``characters`` in a part of it no longer than that."""

    def run(batches):
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.append((k, *_needles(random.Random(f"{seed}:{k}"), t, characters)))
            if rows:
                cols = list(zip(*rows))
                lists = pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3], lists), pa.array(cols[4], lists)], names=["key", "id", "prompt", "verifier_id_list", "kwargs"])

    kept = df.where(F.length(F.trim(F.col(text))) > 0).select(F.col(key).alias("key"), F.col(text))
    return kept.mapInArrow(run, f"key {df.schema[key].dataType.simpleString()}, id string, prompt string, verifier_id_list array<string>, kwargs array<string>")


def sample_report(df: DataFrame) -> DataFrame:
    """``samples, unique_ids, with_conflicts`` of generated samples."""
    pairs = df.sparkSession.createDataFrame([p for p in conflict_pairs() if p[0] < p[1]], "a string, b string")
    named = df.select("id", F.explode(F.array_distinct("verifier_id_list")).alias("a"), F.col("verifier_id_list").alias("_ids"))
    bad = named.join(F.broadcast(pairs), "a").where(F.array_contains("_ids", F.col("b"))).select(F.col("id").alias("_bad")).distinct()
    return df.join(bad, df["id"] == bad["_bad"], "left").agg(F.count("*").alias("samples"), F.count_distinct("id").alias("unique_ids"), F.count("_bad").alias("with_conflicts"))
