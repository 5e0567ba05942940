"""Queries over the test tables, one or more for each family of operators; every one reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import words
from ..operators import decontaminate, dedup, dialogue, formatting, language, packing, prompts, quality, reports, routing, samples, splits, templates, tokens, verify
from ..sources import loaders
from ..streaming import shards
from . import answers, folders
from .tables import answers as _answers
from .tables import conversations as _conversations
from .tables import dataset as _dataset
from .tables import read as _read
from .tables import texts as _texts

LANGUAGES_KEPT = ("portuguese", "english", "spanish", "german", "french")
LABELS = {"en": "english", "pt": "portuguese"}
LEAST_WORDS_IN_COMMON = 8
BLOCK = 256
SPAM_DOMAINS = ("example",)


def corpus_quality(spark: SparkSession, root: str) -> DataFrame:
    """Documents, characters and removed documents of each language label, after the rules of Unicode ranges, lines and words."""
    d = _texts(spark, root).withColumn("w", words(F.col("text")))
    s = quality.word_statistics(F.col("text"), w=F.col("w"))
    bad = quality.first_reason(
        [("language", ~language.in_unicode_ranges(F.col("text"), LANGUAGES_KEPT)), ("few_words", s["n_words"] < 20), ("short_words", s["mean_word_length"] < 3), ("long_words", s["mean_word_length"] > 10), ("few_letters", s["alpha_words"] < 0.8)]
    )
    marked = d.withColumn("reason", bad)
    return marked.groupBy("lang").agg(
        F.count("*").alias("documents"), F.count_if(F.col("reason").isNotNull()).alias("removed"), F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.length("text"))), F.lit(0)).cast("bigint").alias("characters")
    )


def unicode_language_filter(spark: SparkSession, root: str) -> DataFrame:
    return language.language_filter(_texts(spark, root), "text", LANGUAGES_KEPT).select("doc_id", F.round(language.allowed_share(F.col("text"), LANGUAGES_KEPT), 6).alias("share"))


def unicode_language_filter_excluded(spark: SparkSession, root: str) -> DataFrame:
    return language.language_filter(_texts(spark, root), "text", LANGUAGES_KEPT, excluded=True).select("doc_id")


def guessed_languages(spark: SparkSession, root: str) -> DataFrame:
    return _texts(spark, root).select("doc_id", language.guessed_language(F.col("text")).alias("guess"))


def ngram_languages(spark: SparkSession, root: str) -> DataFrame:
    """Labels and scores of a detector fitted on the labelled samples."""
    model = language.fitted_model(_read(spark, root, "lang_samples"))
    made = language.ngram_filter(_texts(spark, root).select("doc_id", "text"), "text", model, (), label_only=True)
    return made.select("doc_id", "language", F.round("language_score", 4).alias("language_score"))


def language_score_filter(spark: SparkSession, root: str) -> DataFrame:
    return language.language_score_filter(_dataset(spark, root)).select("id", "language_score")


def corpus_totals(spark: SparkSession, root: str) -> DataFrame:
    return reports.totals(_dataset(spark, root), "token_count").select("documents", "tokens", F.round("mean", 6).alias("mean"))


def token_report_rollup(spark: SparkSession, root: str) -> DataFrame:
    return reports.grouped_totals(_dataset(spark, root), ["source", "language"], "token_count")


def token_histogram(spark: SparkSession, root: str) -> DataFrame:
    return reports.token_histogram(_dataset(spark, root), "token_count").select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "rows")


def token_summary(spark: SparkSession, root: str) -> DataFrame:
    made = reports.token_summary(_dataset(spark, root), "token_count")
    return made.select("rows", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "least", "largest")


def old_and_new_totals(spark: SparkSession, root: str) -> DataFrame:
    d = reports.first_rows(_read(spark, root, "dataset").select("id", "language", "token_count", "fetched_at", "ingested_at"), "id", "ingested_at").withColumn("late", F.coalesce(F.datediff("ingested_at", "fetched_at") > 1, F.lit(False)))
    count = F.sum(F.coalesce("token_count", F.lit(0))).alias("tokens")
    sides = [d.where(f"late = {x}").groupBy("language").agg(F.count("*").alias("documents"), count) for x in ("false", "true")]
    return reports.old_and_new(*sides, "language")


def quality_words(spark: SparkSession, root: str) -> DataFrame:
    s = quality.word_statistics(F.col("text"))
    rounded = {k: F.round(v, 6) if k not in ("n_words", "stop_words") else v for k, v in s.items()}
    return _texts(spark, root).where("text IS NOT NULL").select("doc_id", *(v.alias(k) for k, v in rounded.items() if k not in ("symbol_ratio",)))


def quality_lines(spark: SparkSession, root: str) -> DataFrame:
    s = quality.line_statistics(F.col("text"))
    return _texts(spark, root).where("text IS NOT NULL").select("doc_id", *(F.round(v, 6).alias(k) for k, v in s.items() if k != "newline_ratio"))


def quality_reason_counts(spark: SparkSession, root: str) -> DataFrame:
    """The whole chain, repetition with it."""
    return quality.reason_counts(quality.quality_reasons(_texts(spark, root), "text"), "lang")


def repetition_shares(spark: SparkSession, root: str) -> DataFrame:
    return _texts(spark, root).select("doc_id", quality.repetition_shares()(F.col("text")).alias("s")).select("doc_id", "s.*")


def url_filter(spark: SparkSession, root: str) -> DataFrame:
    reason = quality.url_reason(F.col("url"), SPAM_DOMAINS, ("casino",), ("shop", "online", "id"))
    return _read(spark, root, "documents").where("url IS NOT NULL").select("doc_id", reason.alias("reason"))


def pii_masking(spark: SparkSession, root: str) -> DataFrame:
    return _texts(spark, root).select("doc_id", formatting.masked(F.col("text")).alias("text"))


def repaired_text(spark: SparkSession, root: str) -> DataFrame:
    return _texts(spark, root).select("doc_id", formatting.repair_text(F.col("text")).alias("text"))


def symbol_lines(spark: SparkSession, root: str) -> DataFrame:
    return _texts(spark, root).where("text IS NOT NULL").select("doc_id", F.length(formatting.without_symbol_lines(F.col("text"))).cast("bigint").alias("characters"))


def page_text(spark: SparkSession, root: str) -> DataFrame:
    """The main text of pages made around the documents: navigation, a list of links and scripts go."""
    escaped = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    before = '<html><head><title>t</title><script>var x = "<p>no</p>";</script></head><body><nav><a href="/">Home</a></nav><ul><li><a href="/a">One link</a></li></ul><p>'
    page = F.concat(F.lit(before), escaped, F.lit("</p><footer>Imprint</footer></body></html>"))
    return _texts(spark, root).select("doc_id", formatting.page_text(page).alias("text"))


def exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    return dedup.representatives(_texts(spark, root), "doc_id", "text")


def near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return dedup.near_duplicates(_texts(spark, root), "doc_id", "text")


def _word_rows(df: DataFrame, key: str) -> DataFrame:
    """Words as 64-bit ids, which are narrower than the words and as good as them: of a billion words two share an id with a chance of one in forty."""
    return df.select(key, F.transform(words(F.lower("text")), lambda w: F.xxhash64(w)).alias("ids"))


def decontam_exact(spark: SparkSession, root: str) -> DataFrame:
    rows, items = _word_rows(_texts(spark, root, "dataset"), "id"), _word_rows(_read(spark, root, "benchmark"), "item_id")
    return decontaminate.contaminated_keys(rows, "id", "ids", items, "ids", LEAST_WORDS_IN_COMMON)


def decontam_one_exchange(spark: SparkSession, root: str) -> DataFrame:
    rows, items = _word_rows(_texts(spark, root, "dataset"), "id"), _word_rows(_read(spark, root, "benchmark"), "item_id")
    return decontaminate.contaminated_keys(rows, "id", "ids", items, "ids", LEAST_WORDS_IN_COMMON, exchange=True)


def score_threshold(spark: SparkSession, root: str) -> DataFrame:
    return routing.subset_totals(routing.stratified(routing.least_score(_dataset(spark, root), "edu_int_score", 3), "language"))


def stratified_routes(spark: SparkSession, root: str) -> DataFrame:
    return routing.subset_totals(routing.routed(_dataset(spark, root), stratify="source"))


def distinct_sources(spark: SparkSession, root: str) -> DataFrame:
    return routing.distinct_values(_read(spark, root, "dataset"), "source")


def classifier_confusion(spark: SparkSession, root: str) -> DataFrame:
    d = _dataset(spark, root).where("edu_int_score IS NOT NULL AND language_score IS NOT NULL").withColumn("p", F.round(F.col("language_score") * 4, 3))
    return reports.confusion(d.withColumn("label", reports.target_of(F.col("edu_int_score"))), "label", "p")


def messages_flattened(spark: SparkSession, root: str) -> DataFrame:
    return _conversations(spark, root).select("conv_id", dialogue.flattened(F.col("messages")).alias("text"))


def messages_without_system(spark: SparkSession, root: str) -> DataFrame:
    rows = _texts(spark, root, "conversations").select("conv_id", F.coalesce(F.size(dialogue.without_system(F.col("messages"))), F.lit(0)).cast("bigint").alias("n"))
    return rows.dropDuplicates(["conv_id"])


def messages_stripped(spark: SparkSession, root: str) -> DataFrame:
    return _conversations(spark, root).where("messages IS NOT NULL").select("conv_id", F.array_join(F.transform(dialogue.stripped(F.col("messages")), lambda m: m["content"]), "|").alias("contents"))


def conversation_rules(spark: SparkSession, root: str) -> DataFrame:
    text = dialogue.flattened(F.col("messages"))
    return _texts(spark, root, "conversations").select(
        "conv_id", dialogue.ends_sentence(F.col("messages")).alias("ends"), dialogue.has_no_escapes(text).alias("no_escapes"), dialogue.has_sound_headings(text).alias("headings"),
        dialogue.ends_with_assistant(F.col("messages")).alias("assistant_last"), dialogue.score_at_least(F.col("quality_score"), 5.0).alias("scored"),
    ).dropDuplicates(["conv_id"])


def conversation_code(spark: SparkSession, root: str) -> DataFrame:
    text = dialogue.flattened(F.col("messages"))
    rows = _texts(spark, root, "conversations").select("conv_id", dialogue.has_valid_code_tags(text).alias("tags"), dialogue.has_sound_code(text).alias("code"))
    return rows.dropDuplicates(["conv_id"])


def conversation_reasons(spark: SparkSession, root: str) -> DataFrame:
    rows = _texts(spark, root, "conversations")
    made = dialogue.conversation_reasons(rows, score="quality_score", least_score=3.0, tokens="token_count", least_tokens=10, most_tokens=4000)
    return made.select("conv_id", "reason").dropDuplicates(["conv_id"]).groupBy("reason").agg(F.count("*").alias("rows"))


def chat_template(spark: SparkSession, root: str) -> DataFrame:
    return _conversations(spark, root).select("conv_id", templates.rendered(F.col("messages"), generation=True).alias("text"))


def chat_plain(spark: SparkSession, root: str) -> DataFrame:
    return _conversations(spark, root).select("conv_id", templates.plain(F.col("messages")).alias("text"))


def label_mask(spark: SparkSession, root: str) -> DataFrame:
    ids = F.transform(words(F.col("text")), lambda w: F.length(w))
    rows = _texts(spark, root).select("doc_id", tokens.masked_labels(ids, [1, 2, 3]).alias("labels"))
    return rows.select("doc_id", F.size("labels").cast("bigint").alias("n"), F.size(F.filter("labels", lambda x: x == -100)).cast("bigint").alias("masked"))


def token_prefix(spark: SparkSession, root: str) -> DataFrame:
    return splits.token_prefix(_read(spark, root, "documents"), "doc_id", "n_chars", 1_000_000).select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("n_chars"))


def array_split_chunks(spark: SparkSession, root: str) -> DataFrame:
    return splits.array_split(_read(spark, root, "documents").select("doc_id"), "doc_id", 7)


def mirrored_split_chunks(spark: SparkSession, root: str) -> DataFrame:
    return splits.mirrored_split(_read(spark, root, "documents").select("doc_id"), "doc_id", 7)


def greedy_chunks(spark: SparkSession, root: str) -> DataFrame:
    d = _read(spark, root, "documents").withColumn("file", F.coalesce("source", F.lit("none")))
    return splits.greedy_chunks(d, "file", "doc_id", "n_chars", 50_000)


def validation_split(spark: SparkSession, root: str) -> DataFrame:
    d = _read(spark, root, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("file"))
    return splits.validation_split(d, "file", "doc_id", 100)[1]


def stratified_split(spark: SparkSession, root: str) -> DataFrame:
    return splits.stratified_split(_read(spark, root, "documents").select("doc_id", "lang"), "doc_id", "lang", 0.1)[1]


def remaining_rows(spark: SparkSession, root: str) -> DataFrame:
    d = _read(spark, root, "documents").select("doc_id", "lang")
    return splits.remaining(d, d.where("lang = 'pt'"), "doc_id")


def _length_rows(spark: SparkSession, root: str) -> DataFrame:
    """The lengths of a document's words as its ids: rows of integers that SQL can make too."""
    return _texts(spark, root).select("doc_id", F.transform(words(F.col("text")), lambda w: F.length(w)).alias("input_ids"))


def pack_concat(spark: SparkSession, root: str) -> DataFrame:
    made = packing.concatenated(_length_rows(spark, root), "doc_id", BLOCK)
    return made.select("block", F.element_at("input_ids", 1).cast("bigint").alias("first_id"), F.element_at("input_ids", BLOCK).cast("bigint").alias("last_id"), F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


def pack_best_fit(spark: SparkSession, root: str) -> DataFrame:
    return packing.packed_in_groups(_length_rows(spark, root), "doc_id", 1024).select("pack_group", "block", "seq_lengths")


def tokenized_documents(spark: SparkSession, root: str) -> DataFrame:
    return tokens.tokenized(_texts(spark, root).select("doc_id", "text"), "text", tokens.tokenizer_path("byte_bpe_50k.tiktoken"), bos=50256, eos=50256, most_length=4096).select("doc_id", "seq_lengths")


def tokenized_chats(spark: SparkSession, root: str) -> DataFrame:
    made = tokens.tokenized_chats(_conversations(spark, root).select("conv_id", "messages"), "messages", tokens.tokenizer_path())
    return made.select("conv_id", "seq_lengths", F.size(F.filter("assistant_masks", lambda m: m == 1)).alias("assistant"))


def token_chunks(spark: SparkSession, root: str) -> DataFrame:
    return tokens.exploded_chunks(_texts(spark, root).select("doc_id", "text"), "text", tokens.tokenizer_path("byte_bpe_50k.tiktoken"), 512).select("doc_id", "chunk", F.length("chunk_text").alias("n"))


def tokenizer_metrics(spark: SparkSession, root: str) -> DataFrame:
    paths = {n: tokens.tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")}
    return tokens.tokenizer_metrics(_read(spark, root, "documents"), "text", paths, {"piece_bpe_32k.model": 0})


def prompt_budget(spark: SparkSession, root: str) -> DataFrame:
    d = _read(spark, root, "documents").withColumn("prompt", prompts.assembled(F.col("text"), "Summarize: ", "\nSummary:"))
    return d.where(prompts.within_budget(F.col("prompt"), 2048, 1024)).select("doc_id", F.length("prompt").cast("bigint").alias("n"))


def word_frequencies(spark: SparkSession, root: str) -> DataFrame:
    return reports.word_frequencies(_texts(spark, root).select(words(F.col("text")).alias("w")), "w", 50)


def rare_words(spark: SparkSession, root: str) -> DataFrame:
    return reports.word_frequencies(_texts(spark, root).select(words(F.col("text")).alias("w")), "w", 50, rare=True)


def last_deliveries(spark: SparkSession, root: str) -> DataFrame:
    made = reports.last_rows(_read(spark, root, "dataset").select("id", "ingested_at", "token_count"), "id", "ingested_at")
    return made.select("id", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ingested_at"), F.coalesce("token_count", F.lit(0)).alias("token_count"))


#: Checks with fixed parameters over all answers of assistants.
ANSWER_CHECKS = {
    "no_comma": ("punctuation:no_comma", "{}"),
    "title": ("detectable_format:title", "{}"),
    "two_bullets": ("detectable_format:number_bullet_lists", '{"num_bullets": 2}'),
    "letter": ("keywords:letter_frequency", '{"letter": "a", "let_frequency": 20, "let_relation": "at least"}'),
    "placeholders": ("detectable_content:number_placeholders", '{"num_placeholders": 1}'),
    "postscript": ("detectable_content:postscript", '{"postscript_marker": "P.S."}'),
    "two_responses": ("combination:two_responses", "{}"),
    "quotation": ("startend:quotation", "{}"),
    "end": ("startend:end_checker", '{"end_phrase": "simples."}'),
    "words": ("length_constraints:number_words", '{"num_words": 40, "relation": "at least"}'),
    "paragraphs": ("length_constraints:number_paragraphs", '{"num_paragraphs": 1}'),
    "thinking": ("reasoning:thinking_format", "{}"),
}


def answer_checks(spark: SparkSession, root: str) -> DataFrame:
    rows = _answers(spark, root).select("conv_id", "turn", *(verify.check(n, F.col("text"), F.lit(p)).alias(k) for k, (n, p) in ANSWER_CHECKS.items()))
    return rows.dropDuplicates(["conv_id", "turn"])


def needles(spark: SparkSession, root: str) -> DataFrame:
    return samples.haystacks(_texts(spark, root), "doc_id", "text")


def generated_instructions(spark: SparkSession, root: str) -> DataFrame:
    return samples.generated(spark, 500, samples.instruction)


def generated_word_lists(spark: SparkSession, root: str) -> DataFrame:
    return samples.generated(spark, 500, samples.word_list)


def generated_arithmetic(spark: SparkSession, root: str) -> DataFrame:
    return samples.generated(spark, 500, samples.arithmetic)


def generated_emails(spark: SparkSession, root: str) -> DataFrame:
    return samples.generated(spark, 500, samples.email)


def generated_tool_calls(spark: SparkSession, root: str) -> DataFrame:
    return samples.generated(spark, 500, samples.tool_call)


def first_contents(spark: SparkSession, root: str) -> DataFrame:
    """The first message's content of each conversation, whatever its role."""
    rows = _conversations(spark, root)
    return rows.select("conv_id", prompts.completion_text(rows, "messages").alias("text"))


def evaluation_results(spark: SparkSession, root: str) -> DataFrame:
    """Scores of the rows as results of runs, in the nested JSON of an evaluation."""
    d = _dataset(spark, root).where("language_score IS NOT NULL")
    runs = d.select("id", F.to_json(F.create_map(F.lit("task"), F.create_map(F.lit("acc,none"), F.col("language_score").cast("string"), F.lit("alias"), F.lit("t")))).alias("j"))
    return reports.evaluation_results(runs, "id", "j")


def classifier_scores(spark: SparkSession, root: str) -> DataFrame:
    made = reports.classifier_report(classifier_confusion(spark, root))
    return made.select(*(F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")))


def filter_report(spark: SparkSession, root: str) -> DataFrame:
    d = _texts(spark, root)
    return reports.filter_report(d.withColumn("reason", F.when(~language.in_unicode_ranges(F.col("text"), LANGUAGES_KEPT), F.lit("language"))))


def repeated_texts(spark: SparkSession, root: str) -> DataFrame:
    rows = _read(spark, root, "documents").where("text IS NOT NULL")
    return loaders.ambiguous(rows, text=dedup.same_text_key(F.col("text")), url=F.col("url")).where("value IS NOT NULL")


def model_rates(spark: SparkSession, root: str) -> DataFrame:
    """Rates of two training runs of known shape, per order as a stand-in for a run's table."""
    runs = _read(spark, root, "orders").select("o_orderkey", *(F.lit(v).alias(k) for k, v in (("batch", 128), ("length", 4096), ("devices", 1), ("params", 5e7), ("layers", 10), ("heads", 8), ("head_size", 64))))
    made = reports.with_rates(runs.withColumn("seconds", F.lit(1.0) + F.col("o_orderkey") % 7), reports.PEAK_FLOPS["a100"])
    return made.select("o_orderkey", F.round("tokens_per_second", 4).alias("tokens_per_second"), F.round("mfu", 8).alias("mfu"))


def rate_schedule(spark: SparkSession, root: str) -> DataFrame:
    made = reports.schedule(spark, 1000, 50, 1.0, 0.1, 0.2, root=True)
    return made.select("step", F.round("cosine", 6).alias("cosine"), F.round("stable", 6).alias("stable"), "cosine_stage", "stable_stage")


def event_windows(spark: SparkSession, root: str) -> DataFrame:
    return shards.windowed_counts(_read(spark, root, "events"), "ts", "event_type").select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "events")


def event_sessions(spark: SparkSession, root: str) -> DataFrame:
    made = shards.sessions(_read(spark, root, "events"), "ts", "user_id")
    return made.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("events").alias("events"))


FLAGSHIP = corpus_quality
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        corpus_quality, unicode_language_filter, unicode_language_filter_excluded, guessed_languages, ngram_languages, language_score_filter, corpus_totals, token_report_rollup, token_histogram, token_summary,
        old_and_new_totals, quality_words, quality_lines, quality_reason_counts, repetition_shares, url_filter, pii_masking, repaired_text, symbol_lines, page_text, exact_dedup, near_dedup,
        decontam_exact, decontam_one_exchange, score_threshold, stratified_routes, distinct_sources, classifier_confusion, messages_flattened, messages_without_system, messages_stripped,
        conversation_rules, conversation_code, conversation_reasons, chat_template, chat_plain, label_mask, token_prefix, array_split_chunks, mirrored_split_chunks,
        greedy_chunks, validation_split, stratified_split, remaining_rows, pack_concat, pack_best_fit, tokenized_documents, tokenized_chats, token_chunks, tokenizer_metrics, prompt_budget,
        word_frequencies, rare_words, last_deliveries, answer_checks, needles, generated_instructions, generated_word_lists, generated_arithmetic,
        generated_emails, generated_tool_calls, first_contents, evaluation_results, classifier_scores, filter_report, repeated_texts, model_rates, rate_schedule, event_windows, event_sessions,
    )
}
QUERIES |= answers.QUERIES | folders.QUERIES
