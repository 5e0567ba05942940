"""Reports: totals, histograms, token reports, logs, evaluation results, schedules and rates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Peak operations a second of some accelerators.
PEAK_FLOPS = {"a100": 300e12, "a40": 150e12, "h100": 1671e12}


def totals(df: DataFrame, tokens: str) -> DataFrame:
    """``documents, tokens, mean`` of a table; null counts are 0."""
    n = F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint"))
    return df.agg(F.count("*").alias("documents"), F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias("tokens"), F.coalesce(F.avg(n), F.lit(0.0)).alias("mean"))


def grouped_totals(df: DataFrame, by: list[str], tokens: str) -> DataFrame:
    """Documents and tokens of each group, of each group of groups, and of all: ``level`` counts the columns left out."""
    n = F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint"))
    levels = sum((F.grouping(b).cast("int") for b in by[1:]), F.grouping(by[0]).cast("int"))
    return df.rollup(*by).agg(F.count("*").alias("documents"), F.sum(n).alias("tokens"), levels.alias("level"))


def old_and_new(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """``by, old_documents, old_tokens, new_documents, new_tokens, documents, tokens`` from two tables of ``by, documents, tokens``, with a row of totals under null."""
    def side(df: DataFrame, name: str) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        own = {n: (F.col(c) if n.startswith(name) else zero) for n, c in (("old_documents", "documents"), ("old_tokens", "tokens"), ("new_documents", "documents"), ("new_tokens", "tokens"))}
        return df.select(by, *(c.cast("bigint").alias(n) for n, c in own.items()))

    both = side(old, "old").unionByName(side(new, "new"))
    names = ("old_documents", "old_tokens", "new_documents", "new_tokens")
    summed = both.rollup(by).agg(*(F.sum(n).alias(n) for n in names))
    return summed.withColumn("documents", F.col("old_documents") + F.col("new_documents")).withColumn("tokens", F.col("old_tokens") + F.col("new_tokens"))


def token_histogram(df: DataFrame, tokens: str, bins: int = 50) -> DataFrame:
    """``bin, low, high, rows`` of equal bins between the least and the largest count, the last closed; empty bins are left out."""
    n = df.where(F.col(tokens).isNotNull()).select(F.col(tokens).cast("double").alias("v"))
    ends = n.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    if ends["low"] is None:
        return n.select(F.lit(0).alias("bin"), F.lit(0.0).alias("low"), F.lit(0.0).alias("high"), F.lit(0).cast("bigint").alias("rows")).limit(0)
    low, width = ends["low"], (ends["high"] - ends["low"]) / bins or 1.0
    number = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
    counted = n.groupBy(number.alias("bin")).agg(F.count("*").alias("rows"))
    return counted.select("bin", (F.col("bin") * width + low).alias("low"), ((F.col("bin") + 1) * width + low).alias("high"), "rows")


def token_summary(df: DataFrame, tokens: str) -> DataFrame:
    """``rows, mean, median, least, largest`` of the counts that aren't null; the median is exact, between two middle values."""
    v = F.col(tokens)
    return df.where(v.isNotNull()).agg(F.count("*").alias("rows"), F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("median"), F.min(v).alias("least"), F.max(v).alias("largest"))


def filter_report(df: DataFrame, reason: str = "reason") -> DataFrame:
    """``removed, remaining, percent`` of a table with reasons, null for rows to keep."""
    return df.agg(F.count_if(F.col(reason).isNotNull()).alias("removed"), F.count_if(F.col(reason).isNull()).alias("remaining")).withColumn(
        "percent", F.when(F.col("removed") + F.col("remaining") > 0, F.round(F.col("removed") * 100.0 / (F.col("removed") + F.col("remaining")), 2)).otherwise(F.lit(0.0))
    )


def word_frequencies(df: DataFrame, words: str, n: int, rare: bool = False) -> DataFrame:
    """The ``n`` most frequent words, or with ``rare`` the least frequent, of an array column; ties by the word: a top-n report."""
    counted = df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.orderBy(F.asc("n") if rare else F.desc("n"), "word").limit(n)


def score_from_logit(logit: Column) -> tuple[Column, Column]:
    """Score and whole score of a classifier of 0 to 4: one more than the logit, and than the logit cut to the range and rounded half to even."""
    return logit + 1, (F.bround(F.least(F.greatest(logit, F.lit(0.0)), F.lit(4.0))) + 1).cast("int")


def target_of(score: Column) -> Column:
    """The class of a score of 1 to 5."""
    return F.least(F.greatest(score.cast("int") - 1, F.lit(0)), F.lit(4))


def confusion(df: DataFrame, label: str, predicted: str, classes: int = 5) -> DataFrame:
    """``label, predicted, n``: predictions rounded half to even and cut to the classes."""
    cut = F.least(F.greatest(F.bround(F.col(predicted).cast("double")), F.lit(0.0)), F.lit(float(classes - 1))).cast("int")
    return df.groupBy(F.col(label).cast("int").alias("label"), cut.alias("predicted")).agg(F.count("*").alias("n"))


def classifier_report(counts: DataFrame) -> DataFrame:
    """``accuracy, precision, recall, f1``, the last three as means over all classes that occur, from a table of ``confusion``."""
    hit = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    by_label = counts.groupBy(F.col("label").alias("class")).agg(hit.alias("hits"), F.sum("n").alias("labelled"))
    by_predicted = counts.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("found"))
    joined = by_label.join(by_predicted, "class", "full").na.fill(0, ["hits", "labelled", "found"])
    p = F.when(F.col("found") > 0, F.col("hits") / F.col("found")).otherwise(0.0)
    r = F.when(F.col("labelled") > 0, F.col("hits") / F.col("labelled")).otherwise(0.0)
    scored = joined.withColumn("p", p).withColumn("r", r).withColumn("f", F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0))
    return scored.agg((F.sum("hits") / F.sum("labelled")).alias("accuracy"), F.avg("p").alias("precision"), F.avg("r").alias("recall"), F.avg("f").alias("f1"))


def sections(df: DataFrame, order: str, line: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``block`` and ``section`` of each line of a log: blocks end at ``---``, sections begin with ``[name]`` and end with their block.

    Marks themselves, and blank lines, are left out. The lines of each log, by the columns ``by``, are one stream in
    their order; the log of a run is bounded.
    """
    text = F.trim(F.col(line))
    name = F.nullif(F.regexp_extract(text, r"^\[([^\]]+)\]$", 1), F.lit(""))
    forward = Window.partitionBy(*by).orderBy(order)
    marked = df.withColumn("_break", (text == "---").cast("int")).withColumn("_name", name)
    blocks = marked.withColumn("block", F.sum("_break").over(forward))
    filled = blocks.withColumn("section", F.last("_name", ignorenulls=True).over(Window.partitionBy(*by, "block").orderBy(order)))
    return filled.where((F.col("_break") == 0) & F.col("_name").isNull() & (text != "")).drop("_break", "_name")


def log_entries(df: DataFrame, order: str, line: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``by, block, section, name, value`` of the ``name: value`` lines of logs with sections."""
    parts = F.regexp_extract(F.col(line), r"^\s*([^:]+?)\s*:\s*(.*?)\s*$", 1), F.regexp_extract(F.col(line), r"^\s*([^:]+?)\s*:\s*(.*?)\s*$", 2)
    return sections(df, order, line, by).select(*by, "block", "section", parts[0].alias("name"), parts[1].alias("value")).where("name <> ''")


def until_last(df: DataFrame, order: str, status: str, value: str = "validation") -> DataFrame:
    """Rows up to the last one with this status; none if there is none."""
    last = df.where(F.col(status) == value).agg(F.max(order)).first()[0]
    return df.where(F.lit(False)) if last is None else df.where(F.col(order) <= F.lit(last))


def validated_steps(df: DataFrame, log: DataFrame, step: str, status: str, value: str = "validation") -> DataFrame:
    """Rows whose step has a row of this status in the log."""
    return df.join(log.where(F.col(status) == value).select(step).distinct(), step, "left_semi")


def last_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, by ``order``; equal places fall to any one of them."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_last")).select(key, *(F.col(f"_last.{c}").alias(c) for c in others))


def first_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key, by ``order``; equal places fall to any one of them."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*others), F.col(order)).alias("_first")).select(key, *(F.col(f"_first.{c}").alias(c) for c in others))


def emissions(df: DataFrame, nodes: int = 1, run: str = "run_id", order: str = "timestamp") -> DataFrame:
    """``runs, energy, emissions, hours`` over the last row of each run, times ``nodes``; energy and emissions to 6 places, hours to 4."""
    last = last_rows(df, run, order)
    return last.agg(
        F.count("*").alias("runs"), F.round(F.sum("energy_consumed") * nodes, 6).alias("energy"), F.round(F.sum("emissions") * nodes, 6).alias("emissions"), F.round(F.sum("duration") * nodes / 3600, 4).alias("hours")
    )


def stage_counts(df: DataFrame, stage: str, event: str, order: str) -> DataFrame:
    """``stage, resumes, events``: how often each stage was taken up again, and its events in order."""
    return df.groupBy(stage).agg(
        F.greatest(F.count_if(F.col(event) == "start") - 1, F.lit(0)).alias("resumes"), F.transform(F.array_sort(F.collect_list(F.struct(order, event))), lambda e: e[event]).alias("events")
    )


def evaluation_results(df: DataFrame, model: str, results: str) -> DataFrame:
    """``model, metric, value`` from JSON of {task: {"metric,none": value}}; tasks without metrics and values that are no numbers are left out."""
    tasks = df.select(F.col(model).alias("model"), F.explode(F.from_json(results, "map<string,map<string,string>>")).alias("task", "metrics"))
    metrics = tasks.select("model", "task", F.explode("metrics").alias("name", "text"))
    name = F.concat_ws("_", "task", F.replace(F.col("name"), F.lit(",none"), F.lit("")))
    return metrics.select("model", name.alias("metric"), F.expr("try_cast(text AS double)").alias("value")).where("value IS NOT NULL")


def model_name(pretrained: Column, file: Column) -> Column:
    """The last part of a model's path, else the file's name without its prefix and suffix."""
    base = F.nullif(F.substring_index(F.regexp_replace(pretrained, "/+$", ""), "/", -1), F.lit(""))
    stem = F.regexp_replace(F.regexp_replace(F.substring_index(file, "/", -1), r"\.json$", ""), r"^(results_|result_|eval_)", "")
    return F.coalesce(base, stem)


def _warmed(step: Column, warmup: int, peak: float, after: Column) -> Column:
    """A linear warm-up that reaches ``peak`` at its last step, then ``after``."""
    return F.when(step < warmup, peak * (step + 1) / warmup).otherwise(after) if warmup > 0 else after


def cosine_rate(step: Column, warmup: int, steps: int, peak: float, least: float) -> tuple[Column, Column]:
    """Learning rate and stage of a warm-up and a cosine down to ``least``, which it keeps after the last step."""
    done = (step - warmup) / max(1, steps - warmup)
    falling = least + (peak - least) * 0.5 * (1 + F.cos(F.lit(3.141592653589793) * done))
    rate = _warmed(step, warmup, peak, F.when(step > steps, F.lit(least)).otherwise(falling))
    return rate, F.when(step < warmup, "warmup").when(step > steps, "stable").otherwise("cosine_decay")


def stable_rate(step: Column, warmup: int, steps: int, peak: float, least: float, decay: float, root: bool = False) -> tuple[Column, Column]:
    """Learning rate and stage of a warm-up, a plateau and a decay over the last share ``decay`` of the steps, linear or by the root."""
    falling = steps * decay
    begin = steps - falling
    done = (step - begin) / max(falling, 1e-12)
    done = F.sqrt(F.greatest(done, F.lit(0.0))) if root else done
    in_decay = (step > begin) & F.lit(falling > 0)
    rate = _warmed(step, warmup, peak, F.when(in_decay, least + (peak - least) * (1 - done)).otherwise(F.lit(float(peak))))
    return rate, F.when(step < warmup, "warmup").when(in_decay, "1-sqrt" if root else "linear_decay").otherwise("stable")


def schedule(spark: SparkSession, steps: int, warmup: int, peak: float, least: float, decay: float, root: bool = False) -> DataFrame:
    """``step, cosine, cosine_stage, stable, stable_stage`` of every step of a run."""
    (cosine, cosine_stage), (stable, stable_stage) = cosine_rate(F.col("step"), warmup, steps, peak, least), stable_rate(F.col("step"), warmup, steps, peak, least, decay, root)
    steps_ = spark.range(steps).select(F.col("id").alias("step"))
    return steps_.select("step", cosine.alias("cosine"), cosine_stage.alias("cosine_stage"), stable.alias("stable"), stable_stage.alias("stable_stage"))


def training_plan(batches: int, total_batch: int, micro_batch: int, length: int, devices: int, epochs: float, most_steps: int | None = None) -> dict[str, float]:
    """Steps of gradient accumulation, of an epoch and of the run, and the epochs; an error unless the batch, in tokens, divides.

    ``most_steps`` sets the steps of the run, and the epochs to those they fill, one at least.
    """
    per_step = micro_batch * length * devices
    if total_batch % per_step:
        raise ValueError("the total batch must be a multiple of the micro batch times the length times the devices")
    accumulation = total_batch // per_step
    per_epoch = -(-batches // accumulation)
    if most_steps is None:
        return {"accumulation": accumulation, "steps_per_epoch": per_epoch, "steps": math.ceil(epochs * per_epoch), "epochs": epochs}
    return {"accumulation": accumulation, "steps_per_epoch": per_epoch, "steps": most_steps, "epochs": most_steps // per_epoch if most_steps > per_epoch else 1}


def flops_per_token(params: Column, layers: Column, heads: Column, head_size: Column, length: Column) -> Column:
    """Operations for a token of a dense transformer, forward and backward."""
    return 6 * params + 12 * layers * heads * head_size * length


def hybrid_flops(head: Column, per_layer: Column, length: Column) -> Column:
    """Operations for a sequence where layers differ: twice the head's and the layers', forward and backward."""
    return 2 * (head + F.aggregate(per_layer, F.lit(0.0), lambda a, x: a + x)) * 3 * length


def with_rates(df: DataFrame, peak: float, batch: str = "batch", length: str = "length", seconds: str = "seconds", devices: str = "devices") -> DataFrame:
    """``df`` with ``tokens_per_second`` of a device and ``mfu``, from parameters and shape of its model."""
    rate = F.col(batch) * F.col(length) / F.col(seconds) / F.col(devices)
    work = flops_per_token(F.col("params"), F.col("layers"), F.col("heads"), F.col("head_size"), F.col(length))
    return df.withColumn("tokens_per_second", rate).withColumn("mfu", rate * work / peak)


def synthetic_rows(spark: SparkSession, rows: int, length: int, vocabulary: int, share: float = 0.3, seed: int = 42) -> DataFrame:
    """``row, input_ids``: ids by hash, with a pattern over a run of ``share`` of the row.

    Even rows count up by one from an id, odd rows repeat two ids by turns; each row depends on the seed and its number alone.
    """
    i, run = F.col("id"), max(2, int(length * share))

    def drawn(most: int, *of) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), i, *of), F.lit(most))

    start, first, second = drawn(length - run + 1, F.lit("start")), drawn(vocabulary, F.lit("first")), drawn(vocabulary, F.lit("second"))

    def token(k: Column) -> Column:
        pattern = F.when(i % 2 == 0, F.pmod(first + k - start, F.lit(vocabulary))).when((k - start) % 2 == 0, first).otherwise(second)
        return F.when((k >= start) & (k < start + run), pattern).otherwise(drawn(vocabulary, k)).cast("int")

    return spark.range(rows).select(i.alias("row"), F.transform(F.sequence(F.lit(0), F.lit(length - 1)), token).alias("input_ids"))


def sanity_rows(rows: int) -> int:
    """Validation rows for so many training rows: a tenth, one at least."""
    return max(1, int(0.1 * rows))


def dataset_card(df: DataFrame, by: str, tokens: str, bytes_: str) -> DataFrame:
    """Rows, tokens and bytes of each subset, and of all under null."""
    return df.rollup(by).agg(F.count("*").alias("rows"), F.sum(F.coalesce(F.col(tokens), F.lit(0)).cast("bigint")).alias("tokens"), F.sum(F.col(bytes_).cast("bigint")).alias("bytes"))


def schema_card(df: DataFrame) -> list[tuple[str, str]]:
    """Name and kind of each column: value, sequence, or list_of_dicts."""
    kinds = {"array": lambda t: "list_of_dicts" if t.elementType.typeName() == "struct" else "sequence"}
    return [(f.name, kinds.get(f.dataType.typeName(), lambda t: "value")(f.dataType)) for f in df.schema.fields]


def card_text(stats: list[dict], default: str | None = None) -> str:
    """The text of a dataset's card: its configuration as YAML, and a table of its subsets.

    ``stats`` has for each subset its ``name, files, rows, bytes, tokens`` and ``columns``, as ``(name, kind, type)`` with kind
    ``value``, ``sequence`` or ``list_of_dicts``, whose type is a list of (field, type).
    """
    out = ["---", "dataset_info:"]
    for s in stats:
        out += [f"- config_name: {s['name']}", "  features:"]
        for name, kind, inner in s["columns"]:
            out.append(f"  - name: {name}")
            if kind == "list_of_dicts":
                out += ["    list:", *(line for field, of in inner for line in (f"      - name: {field}", f"        dtype: {of}"))]
            else:
                out.append(f"    {'sequence' if kind == 'sequence' else 'dtype'}: {inner}")
        size = s["bytes"]
        out += ["  splits:", "  - name: train", f"    num_bytes: {size}", f"    num_examples: {s['rows']}", f"  download_size: {size}", f"  dataset_size: {size}"]
    out.append("configs:")
    for s in stats:
        out += [f"- config_name: {s['name']}", *(["  default: true"] if s["name"] == default else []), "  data_files:", "  - split: train", f"    path: {s['name']}/train-*"]
    out += ["---", "", "# Dataset Card", ""]
    counted = [s for s in stats if s["tokens"]]
    if counted:
        out += ["", "## Token Counts per Subset", "", *(f"- **{s['name']}**: {s['tokens']:,} tokens" for s in counted), "", f"**Total tokens across all subsets**: {sum(s['tokens'] for s in counted):,} tokens"]
    out += ["", "## Dataset Statistics", "", "| Subset | Files | Rows | Size |", "|--------|-------|------|------|"]
    out += [f"| {s['name']} | {s['files']} | {s['rows']:,} | {s['bytes'] / 1024**3:.2f} GB |" for s in stats]
    files, rows, size = (sum(s[k] for s in stats) for k in ("files", "rows", "bytes"))
    out.append(f"| **Total** | **{files}** | **{rows:,}** | **{size / 1024**3:.2f} GB** |")
    return "\n".join(out) + "\n"
