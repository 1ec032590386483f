"""The registered queries: name -> (session, folder) -> DataFrame."""

import uuid

from pyspark.sql import functions as F

from colloquy import fixed, schemas
from colloquy.functions import chat, checks, pii as P, quality as Q, text as X
from colloquy.operators import (
    conversation, dedup, generate, pii, preference, quality, retention, runlogs, split,
    taskmetrics, textmetrics,
)
from colloquy.operators.lineage import run_folder
from colloquy.plans import cleaning, evaluation, preparation
from colloquy.registry import inputs as I
from colloquy.sources import files

QUERIES = {}
NEAR = 0.8


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def scratch(spark, name):
    """A new folder of this run, which goes with it."""
    return f"{run_folder(spark)}/files/{name}-{uuid.uuid4().hex}"


# --- personal data ----------------------------------------------------------------


@query
def pii_counts(spark, folder):
    return I.documents(spark, folder).select(
        "doc_id", *[P.pii_count(F.col("text"), t).alias(t) for t in fixed.PII_TYPES]
    )


@query
def pii_mask(spark, folder):
    return pii.mask_fields(I.documents(spark, folder).select("doc_id", "text"), ["text"]).select("doc_id", "text")


@query
def pii_by_source(spark, folder):
    masked = pii.mask_fields(I.documents(spark, folder).select("source", "text"), ["text"])
    return pii.pii_totals(masked, ["text"], ["source"]).select("source", "pii_type", "n")


@query
def pii_totals(spark, folder):
    return pii.pii_totals(pii.mask_fields(I.document_examples(spark, folder)))


@query
def contact_pii(spark, folder):
    notes = I.contacts(spark, folder)
    counts = [P.pii_count(F.col("user"), t).alias(t) for t in fixed.PII_TYPES]
    return pii.mask_fields(notes.select("example_id", "user", *counts), ["user"]).select("example_id", "user", *fixed.PII_TYPES)


@query
def contact_pii_totals(spark, folder):
    return pii.pii_totals(pii.mask_fields(I.contacts(spark, folder)))


# --- quality ----------------------------------------------------------------------


@query
def pair_quality(spark, folder):
    return rounded(quality.score_examples(I.pairs(spark, folder)).select("example_id", "quality"), "quality")


@query
def document_quality(spark, folder):
    docs = I.document_examples(spark, folder)
    return rounded(quality.score_examples(docs).select("example_id", "quality"), "quality")


@query
def quality_filter(spark, folder):
    docs = I.document_examples(spark, folder)
    return quality.filter_quality(docs, 0.9).select("example_id", "category")


@query
def quality_summary(spark, folder):
    return rounded(quality.quality_summary(I.document_examples(spark, folder), 0.9), "mean_quality")


@query
def quality_vs_label(spark, folder):
    flags = I.documents(spark, folder).select(
        "doc_id",
        Q.bad_length(F.col("text")).alias("bad_length"),
        Q.repetitive(F.col("text")).alias("repetitive"),
        Q.looks_english(F.col("text")).alias("english"),
    )
    labels = I.table(spark, folder, "labels").select("doc_id", "quality")
    return flags.join(labels, "doc_id").groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("bad_length").alias("bad_length"),
        F.count_if("repetitive").alias("repetitive"),
        F.count_if("english").alias("english"),
    )


@query
def contact_quality(spark, folder):
    notes = I.contacts(spark, folder)
    user, assistant = F.col("user"), F.col("assistant")
    flags = {
        "bad_length": Q.bad_length(user), "repetitive": Q.repetitive(user), "english": Q.looks_english(user),
        "placeholder": user.contains(fixed.PLACEHOLDER) | assistant.contains(fixed.PLACEHOLDER),
    }
    scored = quality.score_examples(notes.select("*", *[c.alias(n) for n, c in flags.items()]))
    return rounded(scored.select("example_id", *flags, "quality"), "quality")


# --- near-duplicates --------------------------------------------------------------


@query
def shingle_sizes(spark, folder):
    return I.documents(spark, folder).select("doc_id", F.size(X.shingles(F.col("text"))).alias("shingles"))


@query
def pair_jaccard(spark, folder):
    sets = I.pairs(spark, folder).select(
        "example_id",
        X.once(F.struct(X.shingles(F.col("user")).alias("u"), X.shingles(F.col("assistant")).alias("a"))).alias("s"),
    )
    return rounded(sets.select("example_id", X.jaccard(F.col("s.u"), F.col("s.a")).alias("jaccard")), "jaccard")


@query
def near_dup_keep(spark, folder):
    return dedup.kept_keys(I.documents(spark, folder), "doc_id", "text", NEAR)


@query
def near_dup_strict(spark, folder):
    return dedup.kept_keys(I.documents(spark, folder), "doc_id", "text")


@query
def dedup_examples(spark, folder):
    return dedup.deduplicate_examples(I.pairs(spark, folder)).select("example_id")


# --- cleaning ---------------------------------------------------------------------


@query
def clean_funnel(spark, folder):
    return cleaning.clean(I.document_examples(spark, folder), min_quality=0.9).funnel


@query
def clean_examples(spark, folder):
    return cleaning.clean(I.document_examples(spark, folder), min_quality=0.9).examples.select(
        "example_id", "user", "assistant", "category"
    )


@query
def retention_rate(spark, folder):
    funnel = cleaning.clean(I.document_examples(spark, folder), remove_duplicates=False, min_quality=0.9).funnel
    return rounded(cleaning.retention_rate(funnel), "retention_rate")


# --- chat format ------------------------------------------------------------------


@query
def chatml_pairs(spark, folder):
    return I.pairs(spark, folder).select("example_id", chat.chat_text(F.col("user"), F.col("assistant")).alias("text"))


@query
def prompt_only(spark, folder):
    return I.pairs(spark, folder).select("example_id", chat.chat_prompt(F.col("user")).alias("prompt"))


@query
def chatml_multiturn(spark, folder):
    return conversation.conversation_prompts(I.table(spark, folder, "conversations"))


@query
def text_records(spark, folder):
    return files.text_records(I.pairs(spark, folder))


# --- splits and preference pairs ---------------------------------------------------


@query
def exact_split(spark, folder):
    return split.exact_split(I.table(spark, folder, "documents").select("doc_id"), "doc_id")


@query
def split_summary(spark, folder):
    return rounded(split.split_summary(split.exact_split(I.pairs(spark, folder).select("example_id"))), "percent")


@query
def preference_pairs(spark, folder):
    return preference.preference_pairs(I.pairs(spark, folder))


@query
def preference_splits(spark, folder):
    return preference.preference_splits(split.exact_split(I.pairs(spark, folder)))


# --- similarity metrics -------------------------------------------------------------


def _pair_metrics(spark, folder, *metrics):
    texts = I.pairs(spark, folder).select(
        "example_id", F.col("user").alias("prediction"), F.col("assistant").alias("reference")
    )
    scored = textmetrics.add_text_metrics(texts, metrics=list(metrics))
    return rounded(scored.select("example_id", *metrics), *metrics)


@query
def rouge_n(spark, folder):
    return _pair_metrics(spark, folder, "rouge_1", "rouge_2")


@query
def rouge_l(spark, folder):
    return _pair_metrics(spark, folder, "rouge_l")


@query
def bleu(spark, folder):
    answers = I.reference_answers(spark, folder).join(I.predictions(spark, folder, 43), "example_id")
    scored = textmetrics.add_text_metrics(answers.withColumnRenamed("assistant", "reference"), metrics=["bleu"])
    return rounded(scored.select("example_id", "bleu"), "bleu")


@query
def rouge_all(spark, folder):
    answers = I.reference_answers(spark, folder).join(I.predictions(spark, folder, 43), "example_id")
    names = ["rouge_1", "rouge_2", "rouge_l"]
    scored = textmetrics.add_text_metrics(answers.withColumnRenamed("assistant", "reference"), metrics=names)
    return rounded(scored.select("example_id", *names), *names)


# --- task metrics -------------------------------------------------------------------


@query
def keyword_coverage(spark, folder):
    found = checks.keyword_coverage(F.col("assistant"), F.col("category"))
    return I.reference_answers(spark, folder).select("example_id", X.once(found).alias("k")).select(
        "example_id",
        F.col("k.score").alias("score"),
        F.array_join("k.found", ",").alias("found"),
        F.array_join("k.missing", ",").alias("missing"),
        F.col("k.total").alias("total"),
    )


@query
def format_compliance(spark, folder):
    checked = I.reference_answers(spark, folder).select(
        "example_id", X.once(checks.format_compliance(F.col("assistant"))).alias("f")
    )
    return rounded(checked.select("example_id", "f.score", "f.checks.*", "f.passed", "f.total"), "score")


def _scored(spark, folder, seed=43):
    references = I.reference_answers(spark, folder).withColumnRenamed("assistant", "reference")
    return taskmetrics.row_metrics(taskmetrics.align(I.predictions(spark, folder, seed), references))


@query
def task_metrics_overall(spark, folder):
    return rounded(taskmetrics.overall_metrics(_scored(spark, folder)), *taskmetrics.OVERALL)


@query
def task_metrics_by_category(spark, folder):
    return rounded(taskmetrics.category_metrics(_scored(spark, folder)), *taskmetrics.BY_CATEGORY)


@query
def self_eval(spark, folder):
    rows = taskmetrics.self_evaluation(I.reference_answers(spark, folder))
    return rounded(taskmetrics.overall_metrics(rows), *taskmetrics.OVERALL)


@query
def constant_baseline(spark, folder):
    rows = taskmetrics.constant_baseline(I.reference_answers(spark, folder))
    return rounded(taskmetrics.all_metrics(rows), *taskmetrics.OVERALL)


def _compared(spark, folder):
    """The tuned model has not answered every third question."""
    tuned = I.predictions(spark, folder, 44).where(F.col("example_id") % 3 != 0)
    return taskmetrics.before_after_rows(
        I.reference_answers(spark, folder), I.predictions(spark, folder, 43), tuned
    )


@query
def before_after_rows(spark, folder):
    return _compared(spark, folder)


@query
def before_after(spark, folder):
    rows = taskmetrics.before_after_metrics(_compared(spark, folder))
    return rounded(taskmetrics.metric_deltas(rows), "baseline", "finetuned", "delta")


@query
def before_after_by_category(spark, folder):
    rows = taskmetrics.before_after_metrics(_compared(spark, folder))
    return rounded(taskmetrics.category_deltas(rows), "baseline", "finetuned", "delta")


@query
def category_report(spark, folder):
    return taskmetrics.category_report(_scored(spark, folder))


@query
def first_comparisons(spark, folder):
    return taskmetrics.first_comparisons(_compared(spark, folder))


# --- generation ---------------------------------------------------------------------


@query
def template_examples(spark, folder):
    return generate.fill_templates(I.order_candidates(spark, folder))


@query
def unique_openings(spark, folder):
    filled = generate.fill_templates(I.order_candidates(spark, folder))
    return generate.first_of_each_opening(filled).select("candidate", "opening")


@query
def generate_counted(spark, folder):
    """Later categories want more than their orders can give."""
    filled = generate.fill_templates(I.order_candidates(spark, folder), templates=I.SHARED_TEMPLATES)
    return generate.counted(filled, I.wanted_counts(spark, folder, 3))


@query
def generate_balanced(spark, folder):
    filled = generate.fill_templates(I.order_candidates(spark, folder), templates=I.SHARED_TEMPLATES)
    share = I.table(spark, folder, "customer").count() // len(fixed.CATEGORIES)
    return generate.counted(filled, dict.fromkeys(fixed.CATEGORIES, share))


@query
def generate_unbalanced(spark, folder):
    """Only numbers and digests of openings move between the draws; texts are filled again for those taken."""
    taken = generate.taken_attempts(I.order_attempts(spark, folder))
    return I.order_attempts(spark, folder, taken).select("draw", "attempt", "category", "user", "assistant")


@query
def hybrid_mix(spark, folder):
    """Four fifths from the templates, the rest from a model's parsed completions."""
    total = I.table(spark, folder, "customer").count()
    filled = generate.fill_templates(I.order_candidates(spark, folder), templates=I.SHARED_TEMPLATES)
    answered = generate.parsed_completions(I.completions(spark, folder), "model").withColumnRenamed("example_id", "row")
    return generate.hybrid_of(filled, total, fixed.CATEGORIES, second=answered).select("example_id", "user", "assistant", "category", "source")


@query
def generation_stats(spark, folder):
    filled = generate.fill_templates(I.order_candidates(spark, folder))
    first = generate.first_of_each_opening(filled).select("candidate")
    tagged = filled.join(first, "candidate", "left_semi").select(
        "category", F.when(F.col("candidate") % 5 < 4, "template").alias("source")
    )
    return generate.generation_summary(tagged)


@query
def request_prompts(spark, folder):
    return I.table(spark, folder, "customer").select(
        "c_custkey", generate.request_prompt(F.lower("c_mktsegment")).alias("other"),
        generate.request_prompt(I.category_of(F.col("c_custkey"))).alias("prompt"),
    )


@query
def completion_parse(spark, folder):
    return generate.parsed_completions(I.completions(spark, folder), "model")


# --- retention ----------------------------------------------------------------------


@query
def mc_prompts(spark, folder):
    return I.nation_questions(spark, folder).select(
        "question_id", retention.item_prompt(F.col("question"), F.col("choices")).alias("prompt"), "answer"
    )


@query
def mc_predictions(spark, folder):
    return retention.predicted_choice(I.choice_scores(spark, folder))


def _details(spark, folder):
    predicted = retention.predicted_choice(I.choice_scores(spark, folder))
    return retention.graded(predicted, I.choice_items(spark, folder))


@query
def mc_details(spark, folder):
    return _details(spark, folder)


@query
def mc_accuracy(spark, folder):
    return rounded(retention.accuracy_by_category(_details(spark, folder)), "accuracy")


@query
def retention_compare(spark, folder):
    accuracy = retention.accuracy_by_category(_details(spark, folder))
    return rounded(retention.compare_categories(accuracy), "baseline", "finetuned", "drop")


@query
def forgetting(spark, folder):
    report = retention.forgetting(retention.overall_accuracy(_details(spark, folder)))
    return rounded(report, "baseline_accuracy", "finetuned_accuracy", "absolute_drop", "relative_drop")


@query
def forgetting_levels(spark, folder):
    """Four tuned models that lose some of what the base model knew: a result for each."""
    base = _details(spark, folder).where(F.col("model") == "baseline")
    levels = []
    for lost in (0, 3, 8, 30):
        knows = F.col("is_correct") & (F.col("question_id") % 100 >= lost)
        tuned = base.withColumns({"model": F.lit("finetuned"), "is_correct": knows})
        report = retention.forgetting(retention.overall_accuracy(base.unionByName(tuned)))
        levels.append(report.withColumn("lost", F.lit(lost)))
    union = levels[0]
    for level in levels[1:]:
        union = union.unionByName(level)
    return rounded(union, "baseline_accuracy", "finetuned_accuracy", "absolute_drop", "relative_drop")


@query
def forgetting_report(spark, folder):
    path = scratch(spark, "forgetting")
    report = rounded(retention.forgetting_report(_details(spark, folder)), "baseline", "finetuned", "drop", "relative_drop")
    files.write_report(report, path)
    # A flag as text: null for categories.
    return files.read_report(spark, path, report.schema).withColumn("threshold_5pct", F.col("threshold_5pct").cast("string"))


@query
def full_report(spark, folder):
    """The stored reports of a run as one list of numbers before and after."""
    path = scratch(spark, "report")
    evaluation.full_report(_compared(spark, folder), _details(spark, folder), path)
    means = "category string, metric string, baseline double, finetuned double"
    tasks = files.read_report(spark, f"{path}/task_metrics", means).withColumn("section", F.lit("task_metrics"))
    kept = files.read_report(spark, f"{path}/forgetting", "category string, baseline double, finetuned double")
    kept = kept.withColumns({"section": F.lit("forgetting"), "metric": F.lit("accuracy")})
    first = files.read_report(spark, f"{path}/comparisons", "category string, example_id long")
    first = first.select("category", F.lit("comparisons").alias("section"), F.lit("example_id").alias("metric"), F.col("example_id").cast("double").alias("baseline"), F.lit(None).cast("double").alias("finetuned"))
    return rounded(tasks.unionByName(kept).unionByName(first), "baseline", "finetuned")


# --- logs ---------------------------------------------------------------------------


@query
def loss_ema(spark, folder):
    return rounded(runlogs.smoothed_loss(I.run_log(spark, folder)), "smoothed")


@query
def run_throughput(spark, folder):
    progress = rounded(runlogs.throughput(I.run_log(spark, folder)), "elapsed", "steps_per_second")
    return progress.withColumn("remaining", F.round("remaining", 2))


@query
def best_step(spark, folder):
    return runlogs.best_step(I.run_log(spark, folder))


@query
def new_bests(spark, folder):
    return runlogs.new_bests(I.run_log(spark, folder))


@query
def peak_gauge(spark, folder):
    return runlogs.peak_gauge(I.run_log(spark, folder), I.EVERY_STEP)


@query
def request_usage(spark, folder):
    return runlogs.request_usage(I.requests(spark, folder)).drop("ts")


@query
def usage_rollup(spark, folder):
    usage = runlogs.request_usage(I.requests(spark, folder))
    hours = runlogs.usage_rollup(usage, ["model", F.hour("ts").alias("hour")])
    return rounded(hours, "mean_latency", "mean_speed")


# --- files: written, then read back ---------------------------------------------------


def _examples(spark, folder):
    return I.pairs(spark, folder).withColumn("source", F.lit("conversation"))


@query
def csv_round_trip(spark, folder):
    path = scratch(spark, "csv")
    files.write_csv(_examples(spark, folder).select(*schemas.EXAMPLES.names), path)
    return files.read_csv(spark, path, schemas.EXAMPLES)


@query
def json_round_trip(spark, folder):
    path = scratch(spark, "json")
    files.write_json(_examples(spark, folder), path)
    return files.read_json(spark, path, schemas.EXAMPLES, is_jsonl=True)


@query
def json_document(spark, folder):
    path = scratch(spark, "report")
    rows = taskmetrics.all_metrics(taskmetrics.constant_baseline(I.reference_answers(spark, folder)))
    rows = rounded(rows, *taskmetrics.OVERALL)
    files.write_report(rows, path)
    return files.read_report(spark, path, rows.schema)


@query
def json_directory(spark, folder):
    path = scratch(spark, "folder")
    files.write_json(_examples(spark, folder).orderBy("example_id"), path)
    read = files.read_directory(spark, path, schemas.EXAMPLES, "part-*.json", is_jsonl=True)
    return files.in_file_order(read).select(*schemas.EXAMPLES.names, "place")


@query
def split_store(spark, folder):
    path = scratch(spark, "splits")
    files.write_splits(split.exact_split(_examples(spark, folder)), path)
    return files.read_split(spark, path, "train").select("example_id", "user", "text", "category")


@query
def formatted_copy(spark, folder):
    stored, target = scratch(spark, "splits"), scratch(spark, "formatted")
    files.write_splits(split.exact_split(_examples(spark, folder)), stored)
    for name in ("train", "validation", "test"):
        files.write_formatted_copy(spark, stored, name, f"{target}/split={name}")
    # The folder names give the split column.
    return files.read_json(spark, target, schemas.TEXT_RECORDS, is_jsonl=True)


@query
def training_text(spark, folder):
    raw = scratch(spark, "raw")
    files.write_json(_examples(spark, folder), raw)
    return files.read_training_text(spark, scratch(spark, "missing"), raw)


@query
def training_text_columnar(spark, folder):
    stored = scratch(spark, "columnar")
    files.write_parquet(files.text_records(_examples(spark, folder)), stored)
    return files.read_training_text(spark, stored, scratch(spark, "missing"))


@query
def cleaned_store(spark, folder):
    path = scratch(spark, "prepared")
    preparation.prepare(I.document_examples(spark, folder), path, min_quality=0.9)
    return files.read_json(spark, f"{path}/cleaned", schemas.EXAMPLES, is_jsonl=True).select("example_id", "user", "assistant", "category")


@query
def preference_store(spark, folder):
    path = scratch(spark, "preferences")
    files.write_preferences(preference.preference_pairs(I.pairs(spark, folder)), path)
    return files.read_preferences(spark, path)


@query
def prediction_store(spark, folder):
    path = scratch(spark, "predictions")
    files.write_json(_compared(spark, folder), path)
    schema = (
        "example_id long, user string, category string, reference string, "
        "baseline_response string, finetuned_response string"
    )
    return spark.read.schema(schema).json(path)
