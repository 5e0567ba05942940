"""Queries of what is written and read again, of reports on logs and of small projections, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import files
from ..functions.checkpoints import scratch_folder
from ..functions.text import words
from ..operators import decontaminate, dedup, dialogue, formatting, language, quality, reports, routing, splits, tokens, verify
from ..sources import loaders, sinks
from . import sql
from .tables import dataset, read, texts

_SUBSET = f"coalesce(nullif(replace({sql.strip('source')}, '/', '_'), ''), 'default')"


def _lengths(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("source"), F.coalesce("n_chars", F.lit(0)).alias("token_count"))


def saved_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Rows, first and last key of the files that a table is saved as, read again by name."""
    folder = files.join(scratch_folder(spark), "chunks")
    rows = _lengths(spark, root)
    sinks.save_chunks(rows, folder, "parquet", "doc_id", rows.agg(F.sum("token_count")).first()[0], 150_000, chunks=7)
    kind, found = loaders.discover(folder)
    read_again = loaders.with_file_order(loaders.load_many(spark, found, kind))
    return read_again.groupBy("file").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max("row_index").alias("last_index"))


def routed_folders(spark: SparkSession, root: str) -> DataFrame:
    """Documents and tokens by the sidecars of the folders that rows are routed to."""
    folder = files.join(scratch_folder(spark), "routed")
    sinks.write_routed(routing.routed(_lengths(spark, root).withColumn("source", F.nullif("source", F.lit("none"))), stratify="source"), folder)
    return loaders.token_report(spark, folder).where("level < 2").select(F.col("folder").alias("subset"), "documents", "tokens").distinct()


def kept_and_rejected(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_folder(spark)
    kept, rejected = files.join(folder, "kept"), files.join(folder, "rejected")
    sinks.write_kept_and_rejected(read(spark, root, "documents").select("doc_id", "n_chars", (F.col("n_chars") >= 500).alias("keep")), "keep", kept, rejected)
    sides = [spark.read.parquet(f).select(F.lit(name).alias("side"), "doc_id") for f, name in ((kept, "kept"), (rejected, "rejected"))]
    return sides[0].unionByName(sides[1])


def appended_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals by the sidecars after two turns of appending."""
    folder = files.join(scratch_folder(spark), "appended")
    rows = _lengths(spark, root).where("source <> 'none'")
    for side in (rows.where("doc_id % 3 = 0"), rows.where("doc_id % 3 > 0")):
        sinks.append_with_totals(side, folder, "source")
    report = loaders.token_report(spark, folder).where("level < 2")
    return report.select(F.regexp_replace("folder", "^source=", "").alias("source"), "documents", "tokens").distinct()


def tolerant_lines(spark: SparkSession, root: str) -> DataFrame:
    """Totals of JSON lines of which every tenth breaks off."""
    folder = files.join(scratch_folder(spark), "lines")
    line = F.to_json(F.struct("doc_id", "token_count"))
    _lengths(spark, root).select(F.when(F.col("doc_id") % 10 == 0, F.substring(line, 1, 12)).otherwise(line).alias("value")).write.text(folder)
    return loaders.line_totals(loaders.json_lines(spark, folder, "doc_id bigint, token_count bigint"))


def converted_files(spark: SparkSession, root: str) -> DataFrame:
    """Rows and sums of JSON lines that are converted to Parquet files, and read with ids and a file count."""
    folder = scratch_folder(spark)
    source, target = files.join(folder, "json"), files.join(folder, "parquet")
    _lengths(spark, root).write.json(source)
    sinks.convert_to_parquet(spark, files.listing(source, "*.json"), target, 5_000)
    made, n = loaders.with_file_count(spark, target, "parquet")
    named = loaders.with_default_ids(made.withColumnRenamed("source", "text"))
    return named.agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), F.sum("token_count").alias("tokens"), F.max(F.lit(n > 0)).alias("counted"))


def split_lines(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the chunks that a file of JSON lines is split into, by their number."""
    folder = files.join(scratch_folder(spark), "split")
    _lengths(spark, root).select("doc_id", "token_count").coalesce(1).sortWithinPartitions("doc_id").write.json(folder)
    sinks.split_file(spark, files.listing(folder, "part-*")[0], 200_000, 1)
    chunks = spark.read.schema("doc_id bigint, token_count bigint").json(files.listing(folder, "*-chunk-*")).select("*", F.col("_metadata.file_name").alias("file"))
    number = F.regexp_extract("file", r"chunk-(\d+)", 1).cast("int")
    return chunks.groupBy(number.alias("chunk")).agg(F.count("*").alias("rows"), F.sum("token_count").alias("tokens"))


def read_limit(spark: SparkSession, root: str) -> DataFrame:
    """The first 300 documents, and the first 20 of each source."""
    rows = _lengths(spark, root)
    sides = [loaders.limited(rows, "doc_id", 300).withColumn("of", F.lit("all")), loaders.limited(rows, "doc_id", 20, per="source").withColumn("of", F.lit("source"))]
    return sides[0].unionByName(sides[1]).select("of", "doc_id")


def known_columns(spark: SparkSession, root: str) -> DataFrame:
    made = sinks.known_keys(read(spark, root, "documents").withColumnRenamed("doc_id", "id").withColumn("date", F.col("fetched_at")))
    return made.select("id", "date", F.length("text").cast("bigint").alias("n"))


def document_rows(spark: SparkSession, root: str) -> DataFrame:
    """Fields of metadata beside the text, with a fresh identifier that no two rows share."""
    made = routing.document_row(read(spark, root, "documents").select("text", F.col("doc_id").alias("id"), F.struct("doc_id", "domain", F.lit(0).alias("id")).alias("metadata")))
    made = routing.with_uuid(made)
    return made.agg(F.count("*").alias("rows"), F.countDistinct("uuid").alias("uuids"), F.sum("id").alias("ids"), F.count("domain").alias("domains"))


def parsed_routes(spark: SparkSession, root: str) -> DataFrame:
    """A parser that drops, routes, renames and rewrites rows by their key."""

    def parse(row: dict):
        kind = row["doc_id"] % 4
        return None if kind == 0 else "odd" if kind == 1 else ("moved", {"doc_id": row["doc_id"] + 1_000_000, "source": "x"}) if kind == 2 else {"subset": "made", "row": {"doc_id": -row["doc_id"], "source": None}}

    parser = routing.row_parser(parse, "doc_id bigint, source string, subset string", "default")
    made = routing.routed(read(spark, root, "documents").select("doc_id", "source"), parser)
    return made.select("doc_id", "subset", F.coalesce("source", F.lit("-")).alias("source"))


def card_totals(spark: SparkSession, root: str) -> DataFrame:
    return reports.dataset_card(read(spark, root, "documents").withColumn("bytes", F.length("text").cast("bigint")), "source", "n_chars", "bytes")


def domain_limits(spark: SparkSession, root: str) -> DataFrame:
    """Documents whose length is within the limits of their language."""
    config = spark.createDataFrame([("pt", 200, 4000), ("en", 300, 5000), ("de", 100, 900)], "lang string, least int, most int")
    made = quality.with_domain_config(read(spark, root, "documents").select("doc_id", "lang", "n_chars"), config, "lang")
    return made.select("doc_id", F.coalesce(F.col("n_chars").between(F.col("least"), F.col("most")), F.lit(False)).alias("within"))


def run_emissions(spark: SparkSession, root: str) -> DataFrame:
    """Sums of the last row of each run, the users' events standing for the rows of runs' logs."""
    e = read(spark, root, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("timestamp"), F.hour("ts").cast("double").alias("energy_consumed"), F.minute("ts").cast("double").alias("emissions"), F.col("user_id").cast("double").alias("duration"))
    last = e.groupBy("run_id", "timestamp").agg(*(F.max(c).alias(c) for c in ("energy_consumed", "emissions", "duration")))
    return reports.emissions(last, nodes=2)


def log_sections(spark: SparkSession, root: str) -> DataFrame:
    """Entries of a log for each order: two blocks, sections in them, marks and blank lines between."""
    o = read(spark, root, "orders")
    lines = F.array(*map(F.lit, ("[run]", "lr: 0.1", "", "[gpu]", "mem : 40 GB")), F.concat(F.lit("status: "), F.col("o_orderstatus")), *map(F.lit, ("---", "[run]", "lr: 0.2", "no entry", "---")))
    made = o.select("o_orderkey", F.posexplode(lines).alias("number", "line"))
    return reports.log_entries(made, "number", "line", by=("o_orderkey",)).select("o_orderkey", "block", "section", "name", "value")


def validated_prefix(spark: SparkSession, root: str) -> DataFrame:
    """Orders up to the last one of status P, and those whose status had a large order."""
    o = read(spark, root, "orders").select("o_orderkey", "o_orderstatus")
    until = reports.until_last(o.where("o_orderkey % 7 > 0 OR o_orderstatus <> 'P'"), "o_orderkey", "o_orderstatus", "P")
    return until.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last"))


def validated_rows(spark: SparkSession, root: str) -> DataFrame:
    """Lines of orders that have a row of status P."""
    log = read(spark, root, "orders").select(F.col("o_orderkey").alias("step"), F.col("o_orderstatus").alias("status"))
    rows = read(spark, root, "lineitem").select(F.col("l_orderkey").alias("step"), "l_linenumber")
    return reports.validated_steps(rows, log, "step", "status", "P").groupBy("step").agg(F.count("*").alias("n"))


def stage_resumes(spark: SparkSession, root: str) -> DataFrame:
    """How often each customer's orders began anew, an O being a start."""
    o = read(spark, root, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "O", "start").otherwise("end").alias("event"))
    return reports.stage_counts(o, "o_custkey", "event", "o_orderkey").select("o_custkey", "resumes", F.array_join("events", ",").alias("events"))


def score_targets(spark: SparkSession, root: str) -> DataFrame:
    rows = dataset(spark, root).where("language_score IS NOT NULL").select("id", (F.round(F.col("language_score") * 7, 3) - 1).alias("logit"))
    score, whole = reports.score_from_logit(F.col("logit"))
    return rows.select("id", F.round(score, 6).alias("score"), whole.alias("whole"))


def next_rows(spark: SparkSession, root: str) -> DataFrame:
    """The row to go on with after a table, after none, and where it is given."""
    from ..operators import prompts

    rows = read(spark, root, "documents").select(F.col("doc_id").alias("row"))
    found = [("table", prompts.next_row(rows)), ("none", prompts.next_row(rows.limit(0))), ("given", prompts.next_row(rows, start=5))]
    return spark.createDataFrame(found, "of string, n bigint")


def quota_rows(spark: SparkSession, root: str) -> DataFrame:
    """How many rows each source gives to a validation set, what the last can't give being taken from the first."""
    counts = read(spark, root, "documents").select(F.coalesce("source", F.lit("none")).alias("file")).groupBy("file").count()
    return splits.file_quotas(counts, "file", 150, redistribute=True).select("file", F.col("_quota").alias("quota"))


def masked_ids(spark: SparkSession, root: str) -> DataFrame:
    """Positions without loss where word lengths stand for ids."""
    masked = tokens.mask_ids(1, 2, None, (4, 2))
    ids = F.transform(F.split(F.coalesce("domain", F.lit("a")), r"\."), lambda w: F.length(w))
    return read(spark, root, "documents").select("doc_id", F.array_join(tokens.masked_labels(ids, masked), ",").alias("labels"))


def composed_text(spark: SparkSession, root: str) -> DataFrame:
    """Domains between compatibility characters, composed."""
    return read(spark, root, "documents").select("doc_id", formatting.nfkc(F.concat(F.lit("ﬁne ①"), F.coalesce("domain", F.lit("")), F.lit(" ２"))).alias("text"))


def answers_without_thoughts(spark: SparkSession, root: str) -> DataFrame:
    thought = F.concat(F.lit("<think>a</think>b</think>\n\n"), F.coalesce("domain", F.lit("")))
    return read(spark, root, "documents").select("doc_id", verify.without_thinking(F.when(F.col("doc_id") % 2 == 0, thought).otherwise(F.coalesce("domain", F.lit("")))).alias("text"))


def near_filter(spark: SparkSession, root: str) -> DataFrame:
    """Numbers of rows that near-duplicate removal keeps and removes; what equal texts alone remove is the least."""
    rows = texts(spark, root).select("doc_id", "text")
    kept, removed = dedup.without_near_duplicates(rows, "doc_id", "text")
    both = kept.select(F.lit(True).alias("k")).unionByName(removed.select(F.lit(False).alias("k")))
    return both.agg(F.count_if("k").alias("kept"), F.count_if(~F.col("k")).alias("removed"))


def web_quality_chain(spark: SparkSession, root: str) -> DataFrame:
    """Kept and removed rows of the whole chain by its reasons, and the tokens of what is kept."""
    rows = texts(spark, root, "dataset").select("id", "text", "language_score")
    made = quality.quality_chain(rows, "text", ("portuguese", "english", "spanish", "german", "french"), tokens=tokens.token_count(tokens.tokenizer_path("byte_bpe_50k.tiktoken")))
    return made.select("id", "reason", "token_count").dropDuplicates(["id"]).groupBy("reason").agg(F.count("*").alias("rows"), F.sum("token_count").alias("tokens"))


def hash_samples(spark: SparkSession, root: str) -> DataFrame:
    """A hundred documents by hash order, and the test side of a split by hash."""
    rows = read(spark, root, "documents").select("doc_id")
    sides = [splits.hash_sample(rows, "doc_id", 100).withColumn("of", F.lit("sample")), splits.split_by_hash(rows, "doc_id", 0.25)[1].withColumn("of", F.lit("test"))]
    return sides[0].unionByName(sides[1])


def seeded_order(spark: SparkSession, root: str) -> DataFrame:
    """Documents with their places in a seeded order of a table that is loaded."""
    rows = read(spark, root, "documents").select("doc_id", splits.hash_order(F.col("doc_id"), 7).alias("h"))
    return splits.ranked_keys(rows, ["h", "doc_id"]).select("doc_id", F.col("_before").alias("place"))


def chosen_files(spark: SparkSession, root: str) -> DataFrame:
    """Five of the sources' names, as files, by their hashes."""
    names = [r[0] for r in read(spark, root, "sources").select("source").distinct().collect()]
    return spark.createDataFrame([(f,) for f in splits.picked_files(names, 5)], "file string")


def band_probabilities(spark: SparkSession, root: str) -> DataFrame:
    """How likely bands find pairs of each similarity."""
    cases = [(s / 20, b, r) for s in range(21) for b, r in ((14, 8), (20, 5))]
    return spark.createDataFrame([(s, b, r, round(dedup.detection_probability(s, b, r), 6)) for s, b, r in cases], "similarity double, bands int, rows int, probability double")


def training_plans(spark: SparkSession, root: str) -> DataFrame:
    """Plans of runs over as many batches as there are documents, with and without a number of steps."""
    batches = read(spark, root, "documents").count()
    made = [(most or 0, reports.training_plan(batches, 1 << 16, 4, 1024, 2, 2.5, most)) for most in (None, 10, 5_000)]
    return spark.createDataFrame([(m, p["accumulation"], p["steps_per_epoch"], p["steps"], float(p["epochs"])) for m, p in made], "most long, accumulation long, steps_per_epoch long, steps long, epochs double")


def appended_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows with null fields, appended twice and read again."""
    folder = files.join(scratch_folder(spark), "rows")
    rows = read(spark, root, "documents").select("doc_id", "domain")
    for side in (rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")):
        sinks.append_rows(side, folder)
    lines = spark.read.text(folder)
    return lines.agg(F.count("*").alias("lines"), F.count_if(F.contains("value", F.lit('"domain":null'))).alias("nulls"))


def text_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of text files with their places, and the files as documents."""
    folder = files.join(scratch_folder(spark), "texts")
    read(spark, root, "documents").select(F.coalesce("domain", F.lit("none"))).repartition(3).write.text(folder)
    lines = loaders.numbered_lines(spark, folder).where("line <> ''")
    whole = loaders.documents_folder(spark, folder)
    n = whole.agg(F.sum(F.size(F.split("text", "\n")))).first()[0]
    return lines.agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("characters"), F.countDistinct("file", "number").alias("places"), F.lit(n).cast("bigint").alias("lines_of_documents"))


def sound_lines(spark: SparkSession, root: str) -> DataFrame:
    """JSON lines that must all be sound, and questions and answers of them that aren't blank."""
    folder = files.join(scratch_folder(spark), "sound")
    rows = read(spark, root, "conversations").select("conv_id", F.get("messages", 0)["content"].alias("q"), F.get("messages", 1)["content"].alias("a")).dropDuplicates(["conv_id"])
    rows.write.json(folder)
    made = loaders.strict_json_lines(spark, folder, "conv_id bigint, q string, a string", "conv_id")
    return loaders.question_answers(made, "q", "a").select("conv_id")


def json_folder(spark: SparkSession, root: str) -> DataFrame:
    """The JSON files of a folder tree, one for each source; those that are none are left out."""
    folder = scratch_folder(spark)
    for i, r in enumerate(read(spark, root, "sources").orderBy("source").collect()):
        files.write_text(files.join(folder, f"d{i % 3}", f"{i}.json"), f'{{"source": "{r["source"]}"}}' if i % 4 else "{broken")
    return loaders.json_documents(spark, folder).select(F.get_json_object("text", "$.source").alias("source"))


def table_checks(spark: SparkSession, root: str) -> DataFrame:
    """What the schemas of tables say: messages, pairs of preferences, columns that are asked for, known codes."""
    talks = read(spark, root, "conversations")

    def fails(function, *of) -> bool:
        try:
            function(*of)
        except ValueError:
            return True
        return False

    made = [
        ("messages", dialogue.is_messages(talks, "messages")), ("no messages", dialogue.is_messages(talks, "source")), ("pairs", dialogue.is_conversational(talks.withColumnRenamed("messages", "chosen"))),
        ("no pairs", dialogue.is_conversational(talks)), ("columns", not fails(routing.require_columns, talks, "conv_id", "messages")), ("missing column", fails(routing.require_columns, talks, "prompt")),
        ("codes", not fails(language.check_codes, ["pt", "en"], ["pt", "en", "de"])), ("unknown code", fails(language.check_codes, ["pt", "xx"], ["pt"], ["xx"])),
    ]
    return spark.createDataFrame(made, "of string, holds boolean")


def decimal_parameters(spark: SparkSession, root: str) -> DataFrame:
    """Parameters of checks with whole numbers as decimals."""
    raw = F.concat(F.lit('{"n": '), F.col("o_orderkey").cast("string"), F.lit(', "b": '), (F.col("o_orderkey") % 2 == 0).cast("string"), F.lit("}"))
    made = read(spark, root, "orders").select("o_orderkey", verify.with_float_parameters(raw).alias("k"))
    return made.select("o_orderkey", F.get_json_object("k", "$.n").alias("n"), F.get_json_object("k", "$.b").alias("b"))


def paragraph_shares(spark: SparkSession, root: str) -> DataFrame:
    doubled = F.concat_ws("\n\n", F.coalesce("domain", F.lit("a")), F.coalesce("source", F.lit("a")), F.coalesce("domain", F.lit("a")))
    s = quality.paragraph_statistics(doubled)
    return read(spark, root, "documents").select("doc_id", *(F.round(v, 6).alias(k) for k, v in s.items()))


def blocked_domains(spark: SparkSession, root: str) -> DataFrame:
    """Documents whose address lies in a domain that a table blocks: those of late documents."""
    d = read(spark, root, "documents")
    blocked = d.where("doc_id % 17 = 0").select(F.regexp_replace(F.lower("domain"), r"^www\.", "").alias("domain")).where("domain IS NOT NULL")
    return quality.with_blocked_domains(d.select("doc_id", "url"), "doc_id", "url", blocked).select("doc_id", "blocked")


def decontaminated_totals(spark: SparkSession, root: str) -> DataFrame:
    """Rows before, removed rows and tokens left, of the rows whose words share a run with a benchmark's."""
    rows = texts(spark, root, "dataset").select("id", "token_count", F.transform(words(F.lower("text")), lambda w: F.xxhash64(w)).alias("ids"))
    items = read(spark, root, "benchmark").select(F.transform(words(F.lower("text")), lambda w: F.xxhash64(w)).alias("ids"))
    bad = decontaminate.contaminated_keys(rows, "id", "ids", items, "ids", 8)
    once = dataset(spark, root).select("id", "token_count")
    return decontaminate.decontamination_totals(once, once.join(bad, "id", "left_anti"), "token_count")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        saved_chunks, routed_folders, kept_and_rejected, appended_totals, tolerant_lines, converted_files, split_lines, read_limit, known_columns, document_rows, parsed_routes, card_totals, domain_limits,
        run_emissions, log_sections, validated_prefix, validated_rows, stage_resumes, score_targets, next_rows, quota_rows, masked_ids, composed_text, answers_without_thoughts, near_filter, web_quality_chain,
        hash_samples, seeded_order, chosen_files, band_probabilities, training_plans, appended_rows, text_lines, sound_lines, json_folder, table_checks, decimal_parameters, paragraph_shares, blocked_domains,
        decontaminated_totals,
    )
}
_LENGTHS = "(SELECT doc_id, coalesce(source, 'none') AS source, coalesce(n_chars, 0) AS token_count FROM documents)"
ORACLE: dict[str, str] = {
    "saved_chunks": """WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM documents),
        b AS (SELECT doc_id, CASE WHEN r < (n % 7) * (n // 7 + 1) THEN r // (n // 7 + 1) ELSE n % 7 + (r - (n % 7) * (n // 7 + 1)) // greatest(n // 7, 1) END AS c FROM a)
        SELECT printf('train-%05d-of-00007.parquet', c::INT) AS file, count(*) AS rows, min(doc_id) AS first, max(doc_id) AS last, count(*) - 1 AS last_index FROM b GROUP BY c""",
    "routed_folders": f"SELECT {_SUBSET} AS subset, count(*) AS documents, sum(coalesce(n_chars, 0))::BIGINT AS tokens FROM documents GROUP BY 1",
    "kept_and_rejected": "SELECT CASE WHEN n_chars >= 500 THEN 'kept' ELSE 'rejected' END AS side, doc_id FROM documents",
    "appended_totals": "SELECT source, count(*) AS documents, sum(coalesce(n_chars, 0))::BIGINT AS tokens FROM documents WHERE source IS NOT NULL AND source <> 'none' GROUP BY 1",
    "tolerant_lines": f"SELECT count(*) FILTER (doc_id % 10 <> 0) AS lines, coalesce(sum(token_count) FILTER (doc_id % 10 <> 0), 0)::BIGINT AS tokens, count(*) FILTER (doc_id % 10 = 0) AS broken FROM {_LENGTHS}",
    "converted_files": f"SELECT count(*) AS rows, count(*) AS ids, sum(token_count)::BIGINT AS tokens, true AS counted FROM {_LENGTHS}",
    "split_lines": f"""WITH RECURSIVE a AS (SELECT token_count AS n, row_number() OVER (ORDER BY doc_id) AS i FROM {_LENGTHS}),
        b AS (SELECT i, n, 0::BIGINT AS chunk, n AS total FROM a WHERE i = 1
            UNION ALL SELECT a.i, a.n, CASE WHEN b.total + a.n > 200000 THEN b.chunk + 1 ELSE b.chunk END, CASE WHEN b.total + a.n > 200000 THEN a.n ELSE b.total + a.n END FROM b JOIN a ON a.i = b.i + 1)
        SELECT chunk::INT AS chunk, count(*) AS rows, sum(n)::BIGINT AS tokens FROM b GROUP BY 1""",
    "read_limit": f"""(SELECT 'all' AS "of", doc_id FROM documents ORDER BY doc_id LIMIT 300) UNION ALL SELECT 'source', doc_id FROM {_LENGTHS} QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20""",
    "known_columns": "SELECT doc_id AS id, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S') AS date, length(text) AS n FROM documents",
    "document_rows": "SELECT count(*) AS rows, count(*) AS uuids, 0::BIGINT AS ids, count(domain) AS domains FROM documents",
    "parsed_routes": """SELECT CASE doc_id % 4 WHEN 2 THEN doc_id + 1000000 WHEN 3 THEN -doc_id ELSE doc_id END AS doc_id, CASE doc_id % 4 WHEN 1 THEN 'odd' WHEN 2 THEN 'moved' ELSE 'made' END AS subset,
        CASE doc_id % 4 WHEN 2 THEN 'x' WHEN 3 THEN '-' ELSE coalesce(source, '-') END AS source FROM documents WHERE doc_id % 4 > 0""",
    "card_totals": """SELECT source, count(*) AS rows, sum(coalesce(n_chars, 0))::BIGINT AS tokens, sum(length(text))::BIGINT AS bytes FROM documents GROUP BY ROLLUP (source)""",
    "domain_limits": "SELECT doc_id, coalesce(CASE lang WHEN 'pt' THEN n_chars BETWEEN 200 AND 4000 WHEN 'en' THEN n_chars BETWEEN 300 AND 5000 WHEN 'de' THEN n_chars BETWEEN 100 AND 900 END, false) AS within FROM documents",
    "run_emissions": """WITH a AS (SELECT user_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
        SELECT count(*) AS runs, round(sum(hour(ts))::DOUBLE * 2, 6) AS energy, round(sum(minute(ts))::DOUBLE * 2, 6) AS emissions, round(sum(user_id)::DOUBLE * 2 / 3600, 4) AS hours FROM a""",
    "log_sections": """SELECT o_orderkey, unnest([0, 0, 0, 1])::BIGINT AS block, unnest(['run', 'gpu', 'gpu', 'run']) AS section, unnest(['lr', 'mem', 'status', 'lr']) AS name, unnest(['0.1', '40 GB', o_orderstatus, '0.2']) AS value FROM orders""",
    "validated_prefix": """WITH a AS (SELECT * FROM orders WHERE o_orderkey % 7 > 0 OR o_orderstatus <> 'P')
        SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last FROM a WHERE o_orderkey <= (SELECT max(o_orderkey) FROM a WHERE o_orderstatus = 'P') GROUP BY 1""",
    "validated_rows": "SELECT l_orderkey AS step, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1",
    "stage_resumes": """SELECT o_custkey, greatest(count(*) FILTER (o_orderstatus = 'O') - 1, 0) AS resumes, string_agg(CASE WHEN o_orderstatus = 'O' THEN 'start' ELSE 'end' END, ',' ORDER BY o_orderkey) AS events FROM orders GROUP BY 1""",
    "score_targets": f"""WITH a AS (SELECT id, round(language_score * 7, 3) - 1 AS x FROM {sql.DATASET} WHERE language_score IS NOT NULL)
        SELECT id, round(x + 1, 6) AS score, (round_even(least(greatest(x, 0), 4), 0) + 1)::INT AS whole FROM a""",
    "next_rows": """SELECT unnest(['table', 'none', 'given']) AS "of", unnest([(SELECT max(doc_id) + 1 FROM documents), 0, 5]) AS n""",
    "quota_rows": f"""WITH c AS (SELECT source AS file, count(*) AS l FROM {_LENGTHS} GROUP BY 1), q AS (SELECT file, l, floor(150 * l / sum(l) OVER ())::BIGINT AS f, row_number() OVER (ORDER BY file DESC) = 1 AS final FROM c),
        t AS (SELECT file, l, CASE WHEN final THEN least(l, greatest(0, 150 - (SELECT sum(f) FROM q WHERE NOT final))) ELSE f END AS f FROM q),
        m AS (SELECT *, least(150, sum(l) OVER ()) - sum(f) OVER () AS missing, coalesce(sum(l - f) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t)
        SELECT file, (f + least(l - f, greatest(missing - before, 0)))::BIGINT AS quota FROM m""",
    "masked_ids": "SELECT doc_id, array_to_string(list_transform(string_split(coalesce(domain, 'a'), '.'), lambda w: CASE WHEN length(w) IN (1, 2, 4) THEN -100 ELSE length(w) END), ',') AS labels FROM documents",
    "composed_text": "SELECT doc_id, 'fine 1' || coalesce(domain, '') || ' 2' AS text FROM documents",
    "answers_without_thoughts": "SELECT doc_id, coalesce(domain, '') AS text FROM documents",
    "hash_samples": f"""(SELECT doc_id, 'sample' AS "of" FROM documents ORDER BY {sql.hash_order('doc_id')}, doc_id LIMIT 100) UNION ALL SELECT doc_id, 'test' FROM documents WHERE {sql.hash_order('doc_id')} % 1000000 < 250000""",
    "seeded_order": f"SELECT doc_id, row_number() OVER (ORDER BY {sql.hash_order('doc_id', 7)}, doc_id) - 1 AS place FROM documents",
    "chosen_files": "SELECT DISTINCT source AS file FROM (SELECT DISTINCT source FROM sources ORDER BY md5('42:' || source) LIMIT 5)",
    "band_probabilities": "SELECT s / 20.0::DOUBLE AS similarity, bands, rows, round(1 - pow(1 - pow(s / 20.0::DOUBLE, rows), bands), 6) AS probability FROM range(21) t(s), (VALUES (14, 8), (20, 5)) v(bands, rows)",
    "training_plans": """WITH a AS (SELECT count(*) AS n, 65536 // (4 * 1024 * 2) AS acc FROM documents), b AS (SELECT acc, ceil(n / acc)::BIGINT AS per FROM a)
        SELECT most, acc AS accumulation, per AS steps_per_epoch, CASE WHEN most = 0 THEN ceil(2.5 * per)::BIGINT ELSE most END AS steps, CASE WHEN most = 0 THEN 2.5 WHEN most > per THEN most // per ELSE 1 END::DOUBLE AS epochs FROM b, (VALUES (0), (10), (5000)) m(most)""",
    "appended_rows": "SELECT count(*) AS lines, count(*) - count(domain) AS nulls FROM documents",
    "text_lines": "SELECT count(*) AS lines, sum(length(coalesce(domain, 'none')))::BIGINT AS characters, count(*) AS places, count(*) AS lines_of_documents FROM documents",
    "sound_lines": f"SELECT conv_id FROM {sql.CONVERSATIONS} WHERE length({sql.strip("coalesce(messages[1].content, '')")}) > 0 AND length({sql.strip("coalesce(messages[2].content, '')")}) > 0",
    "json_folder": "SELECT source FROM (SELECT source, row_number() OVER (ORDER BY source) - 1 AS i FROM sources) WHERE i % 4 > 0",
    "table_checks": """SELECT unnest(['messages', 'no messages', 'pairs', 'no pairs', 'columns', 'missing column', 'codes', 'unknown code']) AS "of", unnest([true, false, true, false, true, true, true, true]) AS holds""",
    "decimal_parameters": "SELECT o_orderkey, o_orderkey || '.0' AS n, CASE WHEN o_orderkey % 2 = 0 THEN '1.0' ELSE '0.0' END AS b FROM orders",
    "paragraph_shares": """WITH a AS (SELECT doc_id, coalesce(domain, 'a') AS d, coalesce(source, 'a') AS s FROM documents)
        SELECT doc_id, round(CASE WHEN d = s THEN 2 ELSE 1 END / 3.0, 6)::DOUBLE AS duplicate_paragraphs, round(CASE WHEN d = s THEN 2.0 * length(d) ELSE length(d) END::DOUBLE / (2 * length(d) + length(s)), 6) AS duplicate_paragraph_chars FROM a""",
    "blocked_domains": r"""WITH b AS (SELECT DISTINCT regexp_replace(lower(domain), '^www\.', '') AS d FROM documents WHERE doc_id % 17 = 0 AND domain IS NOT NULL),
        h AS (SELECT doc_id, regexp_replace(regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.\-]*://)?([^/?#:]+)', 1), '^www\.', '') AS host FROM documents)
        SELECT doc_id, coalesce(EXISTS (SELECT 1 FROM b WHERE host = d OR ends_with(host, '.' || d)), false) AS blocked FROM h""",
    "decontaminated_totals": f"""WITH d AS (SELECT id, coalesce(token_count, 0) AS n, {sql.word_list("lower(coalesce(text, ''))")} AS w FROM {sql.DATASET}), b AS (SELECT {sql.word_list("lower(coalesce(text, ''))")} AS w FROM benchmark),
        own AS (SELECT id, w[i:i + 7] AS g FROM (SELECT id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)), inside AS (SELECT w[2:len(w) - 1] AS w FROM b WHERE len(w) > 9),
        refs AS (SELECT DISTINCT w[i:i + 7] AS g FROM (SELECT w, unnest(range(1, len(w) - 6)) AS i FROM inside WHERE len(w) >= 8)), bad AS (SELECT DISTINCT id FROM own JOIN refs USING (g))
        SELECT count(*) AS original, count(*) FILTER (id IN (SELECT id FROM bad)) AS removed, sum(n) FILTER (id NOT IN (SELECT id FROM bad))::BIGINT AS tokens FROM d""",
}
