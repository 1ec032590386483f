"""Operators over tables: splits, pairs, preference, generation, evaluation, logs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.operators import (
    conversation, cuts, generate, hotkeys, preference, retention, runlogs, split, taskmetrics,
)


@pytest.mark.parametrize("n", [0, 1, 9, 10, 997])
def test_split_sizes_are_exact_and_seeded(spark, n):
    df = spark.range(n).withColumnRenamed("id", "example_id")
    labels = {r.example_id: r.split for r in split.exact_split(df).collect()}
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    train, val = int(n * 0.8), int(n * 0.1)
    for place, i in enumerate(order):
        assert labels[i] == ("train" if place < train else "validation" if place < train + val else "test")


def test_split_by_counting_equals_split_by_sorting(spark, monkeypatch):
    monkeypatch.setattr(cuts, "FEW_ROWS", 5)
    monkeypatch.setattr(cuts, "BUCKETS", 16)
    df = spark.range(3000).withColumnRenamed("id", "example_id")
    counts = {r.split: r["count"] for r in split.exact_split(df, seed=7).groupBy("split").count().collect()}
    assert counts == {"train": 2400, "validation": 300, "test": 300}
    summary = {r.split: r.percent for r in split.split_summary(split.exact_split(df)).collect()}
    assert summary == {"train": 80.0, "validation": 10.0, "test": 10.0}


def test_split_ratios_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        split.exact_split(spark.range(3).withColumnRenamed("id", "example_id"), ratios={"train": 0.8, "test": 0.1})


@pytest.mark.parametrize("k", [1, 2, 250, 499, 500])
def test_kth_smallest(spark, monkeypatch, k):
    monkeypatch.setattr(cuts, "FEW_ROWS", 3)
    monkeypatch.setattr(cuts, "BUCKETS", 4)
    df = spark.range(500).select((F.col("id") * 37 % 101).alias("v"), "id")
    expected = sorted((i * 37 % 101, i) for i in range(500))[k - 1]
    assert cuts.kth_smallest(df, F.col("v"), [F.col("id")], k, 0, 101) == expected
    assert cuts.kth_smallest(df, F.col("v"), [F.col("id")], 501, 0, 101) is None
    wide = df.select((F.col("v") * (1 << 53) + F.col("v") % 2).alias("v"), "id")
    value, i = cuts.kth_smallest(wide, F.col("v"), [F.col("id")], k, 0, 1 << 60)
    assert (value >> 53, i) == expected


def turns(spark):
    rows = []
    for conv, n in ((1, 40), (2, 3), (3, 1)):
        for t in range(n):
            role = "user" if (t * 7 + conv) % 3 else "assistant"
            rows.append((conv, t * 2, role, f"c{conv}t{t}"))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), rows


@pytest.mark.parametrize("chunk_rows", [1_000_000, 8])
def test_adjacent_pairs_with_and_without_a_cut_conversation(spark, chunk_rows):
    df, rows = turns(spark)
    expected = {
        (a[0] * 2**31 + a[1], a[3], b[3])
        for a, b in zip(rows, rows[1:])
        if a[0] == b[0] and a[2] == "user" and b[2] == "assistant"
    }
    got = {(r.example_id, r.user, r.assistant) for r in conversation.adjacent_pairs(df, chunk_rows).collect()}
    assert got == expected and expected


def log(spark):
    rows = []
    for run, n in ((1, 60), (2, 7), (3, 1)):
        for s in range(n):
            loss = None if s % 11 == 5 else ((s * 29 + run) % 17) / 4
            rows.append((run, s + 1, 1000.0 + 2 * s, loss))
    df = spark.createDataFrame(rows, "run_id long, step long, sec double, loss double")
    return df.withColumn("ts", F.timestamp_seconds("sec")).withColumns({"eval_loss": F.col("loss"), "gauge": F.col("loss")}), rows


@pytest.mark.parametrize("chunk_rows", [1_000_000, 10])
def test_run_logs_with_and_without_a_cut_run(spark, chunk_rows):
    df, rows = log(spark)
    ema, best, peak = {}, set(), {}
    state = {}
    for run, step, _, loss in rows:
        s = state.setdefault(run, {"ema": None, "best": None, "peak": None})
        if step % 4 == 0:
            if loss is not None:
                s["peak"] = loss if s["peak"] is None else max(s["peak"], loss)
            peak[run, step] = s["peak"]
        if loss is None:
            continue
        s["ema"] = loss if s["ema"] is None else 0.9 * s["ema"] + (1 - 0.9) * loss
        ema[run, step] = s["ema"]
        if s["best"] is None or loss < s["best"]:
            s["best"] = loss
            best.add((run, step))
    got = {(r.run_id, r.step): r.smoothed for r in runlogs.smoothed_loss(df, chunk_rows=chunk_rows).collect()}
    assert got == pytest.approx(ema, abs=1e-9)
    assert {(r.run_id, r.step) for r in runlogs.new_bests(df, chunk_rows=chunk_rows).collect()} == best
    assert {(r.run_id, r.step): r.peak for r in runlogs.peak_gauge(df, 4, chunk_rows=chunk_rows).collect()} == peak
    placed = hotkeys.add_position(df, "run_id", ["step"], chunk_rows=chunk_rows).collect()
    assert len(placed) == len(rows) and all(r.position == r.step for r in placed)


def test_best_step_first_wins_ties(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 1.0), (1, 3, 1.0), (2, 1, None)], "run_id long, step long, eval_loss double")
    assert [tuple(r) for r in runlogs.best_step(df).collect()] == [(1, 2, 1.0)]


def test_throughput_guards_zero(spark):
    df, _ = log(spark)
    rows = {(r.run_id, r.step): r for r in runlogs.throughput(df, F.lit(100)).collect()}
    cut = {(r.run_id, r.step): r for r in runlogs.throughput(df.repartition(3), F.lit(100)).collect()}
    assert rows == cut
    assert rows[1, 1].steps_per_second == 0.0 and rows[1, 1].remaining == 0.0
    assert rows[1, 11].steps_per_second == pytest.approx(11 / 20) and rows[1, 11].remaining == pytest.approx(89 / (11 / 20))


def test_request_usage(spark):
    df = spark.createDataFrame([(10, 52, 49.934), (3, 5, 0.0)], "prompt_tokens int, completion_tokens int, latency_seconds double")
    rows = runlogs.request_usage(df).collect()
    assert (rows[0].total_tokens, rows[0].latency_seconds, rows[0].tokens_per_second) == (62, 49.93, 1.0)
    assert rows[1].tokens_per_second == 0.0


def test_preference_pairs(spark):
    df = spark.range(200).select(
        F.col("id").alias("example_id"), F.lit("q").alias("user"), F.lit("a").alias("assistant"), F.lit(None).cast("string").alias("category")
    )
    rows = preference.preference_pairs(df).collect()
    assert {r.rejected for r in rows} == {a + "\n<|im_end|>" for a in fixed.REJECTED_ANSWERS.values()}
    assert all(r.chosen == "a\n<|im_end|>" and r.category == "unknown" and r.prompt.endswith("assistant\n") for r in rows)
    again = preference.preference_pairs(df.repartition(7)).collect()
    assert {(r.example_id, r.rejected) for r in rows} == {(r.example_id, r.rejected) for r in again}
    by_split = preference.preference_splits(split.exact_split(df)).collect()
    assert {r.split for r in by_split} == {"train", "validation"} and len(by_split) == 180
    own = preference.preference_pairs(df, rejections={"up": lambda chosen: F.upper(chosen)}).first()
    assert own.rejected == "A\n<|im_end|>"


def test_generate_is_unique_bounded_and_repeatable(spark):
    first = generate.generate(spark, "claim_processing", 60).collect()
    again = generate.generate(spark, "claim_processing", 60).collect()
    assert len(first) == 60 and sorted(first) == sorted(again)
    assert len({r.user[:80] for r in first}) == 60
    assert all("{" not in r.user + r.assistant for r in first)
    assert generate.generate(spark, "no such", 5).count() == 0
    few = {"c": [("always the same", "x")]}
    assert generate.generate(spark, "c", 10, templates=few).count() == 1


def test_generate_all_shares_and_openings(spark):
    rows = generate.generate_all(spark, 103).collect()
    counts = {}
    for r in rows:
        counts[r.category] = counts.get(r.category, 0) + 1
    assert counts == {c: 20 for c in fixed.CATEGORIES}
    shared = {"a": [("{x} one", "1")], "b": [("{x} one", "2")]}
    rows = generate.generate_all(spark, 20, templates=shared, pools={"x": ["p", "q", "r"]}).collect()
    assert len(rows) == 3 and {r.category for r in rows} == {"a"}
    drawn = generate.generate_all(spark, 60, balanced=False).collect()
    assert 50 <= len(drawn) <= 60


def test_hybrid_falls_back_or_takes_second_producer(spark):
    mixed = generate.hybrid(spark, 100).collect()
    sources = [r.source for r in mixed]
    assert sources.count("template") == 80 and sources.count("template_fallback") == 20
    assert len({r.example_id for r in mixed}) == 100 and len({r.user[:80] for r in mixed}) == 100
    second = spark.createDataFrame([(0, "premium_billing", "u", "a", "model")], "row long, category string, user string, assistant string, source string")
    df = generate.hybrid(spark, 50, second=second)
    summary = [(r.kind, r.name, r.n) for r in generate.generation_summary(df).collect()]
    assert ("source", "model", 1) in summary and ("source", "template", 40) in summary
    assert summary == sorted(summary)


def test_alignment_and_self_evaluation(spark):
    refs = spark.createDataFrame([(1, "a b c d"), (2, "b c d e")], "example_id long, reference string")
    predictions = refs.withColumnRenamed("reference", "prediction")
    for some, all_ in ((predictions.where("example_id = 1"), refs), (predictions, refs.where("example_id = 2"))):
        with pytest.raises(Exception, match="a prediction or a reference only"):
            taskmetrics.align(some, all_).collect()
    assert taskmetrics.align(predictions, refs).columns == ["example_id", "reference", "prediction"]
    assert taskmetrics.align(predictions, refs).count() == 2
    examples = refs.withColumnRenamed("reference", "assistant")
    own = taskmetrics.overall_metrics(taskmetrics.self_evaluation(examples)).first()
    assert own.rouge_1 == own.rouge_l == own.bleu == 1.0 and own.num_examples == 2
    levels = {r.level: r.category for r in taskmetrics.all_metrics(taskmetrics.self_evaluation(examples)).collect()}
    assert levels == {"overall": None, "category": "unknown"}


def test_choice_ties_and_absent_categories(spark):
    scores = spark.createDataFrame(
        [("baseline", 1, 0, 0.5), ("baseline", 1, 1, 0.9), ("baseline", 1, 2, 0.9), ("baseline", 2, 0, 0.1), ("finetuned", 1, 3, 1.0)],
        "model string, question_id int, choice_idx int, score double",
    )
    predicted = {(r.model, r.question_id): r.predicted for r in retention.predicted_choice(scores).collect()}
    assert predicted == {("baseline", 1): 1, ("baseline", 2): 0, ("finetuned", 1): 3}
    items = spark.createDataFrame([(1, 1, "x"), (2, 0, "y")], "question_id int, answer int, category string")
    details = retention.graded(retention.predicted_choice(scores), items)
    compared = {r.category: (r.baseline, r.finetuned, r.drop) for r in retention.compare_categories(retention.accuracy_by_category(details)).collect()}
    assert compared == {"x": (1.0, 0.0, 1.0), "y": (1.0, 0.0, 1.0)}


@pytest.mark.parametrize("base,tuned,level,within", [(0.0, 0.5, "none", True), (0.8, 0.8, "none", True), (1.0, 0.97, "minimal", True), (1.0, 0.93, "moderate", False), (1.0, 0.85, "significant", False)])
def test_severity(spark, base, tuned, level, within):
    df = spark.createDataFrame([("baseline", base), ("finetuned", tuned)], "model string, accuracy double")
    row = retention.forgetting(df).first()
    assert (row.severity, row.threshold_5pct) == (level, within)
    assert row.message == fixed.SEVERITY_MESSAGES[level]


def test_builtin_items_and_prompt(spark):
    items = retention.knowledge_items(spark)
    counts = {r.category: r["count"] for r in items.groupBy("category").count().collect()}
    assert counts == {"science": 8, "geography": 5, "technology": 3, "math": 2, "history": 1, "literature": 1}
    prompt = items.orderBy("question_id").select(retention.item_prompt(F.col("question"), F.col("choices")).alias("p")).first().p
    assert prompt == "Question: What is the capital of France?\nA) Berlin\nB) Madrid\nC) Paris\nD) Rome\nAnswer:"


def test_pair_keys_of_hashed_and_negative_conversations(spark):
    from colloquy.operators import conversation

    turns = [(c, t, r, f"{c} {t}") for c in (7, 2**40, -5) for t, r in ((0, "user"), (1, "assistant"))]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: r for r in conversation.adjacent_pairs(table).collect()}
    assert rows[7].example_id == 7 << 31
    assert rows[2**40].example_id < 0 and rows[-5].example_id < 0
    assert len({r.example_id for r in rows.values()}) == 3
    assert rows[2**40].assistant == f"{2**40} 1"


def test_hybrid_takes_no_more_than_the_share_of_the_second_producer(spark):
    from colloquy import templates
    from colloquy.operators import generate

    names = list(templates.TEMPLATES)
    second = spark.range(500).selectExpr(
        "id as row", f"element_at(array({', '.join(repr(n) for n in names)}), cast(id % {len(names)} as int) + 1) as category",
        "concat('q', id) as user", "'a' as assistant", "'other' as source",
    )
    rows = generate.hybrid(spark, 50, second=second).collect()
    other = [r for r in rows if r.source == "other"]
    assert len(rows) <= 50 and len(other) == 10 // len(names) * len(names)
    assert max(-1 - r.example_id for r in other) < 10


def one_after_another(rows, counts):
    """Categories in turn; each tries its first 5 * count candidates and takes those of new openings."""
    seen, taken = set(), set()
    for category, count in counts.items():
        got = 0
        for candidate, _, user, _ in sorted(r for r in rows if r[1] == category)[: 5 * count]:
            if got < count and user[:80] not in seen:
                seen.add(user[:80])
                taken.add((category, candidate))
                got += 1
    return taken


@pytest.mark.parametrize("seed", range(4))
def test_counted_generation_equals_one_category_after_another(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("abcd"), f"q{rng.randrange(25)}" + "x" * 90, "s") for i in range(400)]
    counts = {"b": 9, "d": 0, "a": 12, "c": 30, "none": 4}
    df = spark.createDataFrame(rows, "candidate long, category string, user string, assistant string").repartition(3)
    found = generate.counted(df, counts).collect()
    want = one_after_another(rows, counts)
    assert {(r.category, r.candidate) for r in found} == want and len(found) == len(want)
    assert 0 < sum(r.category == "c" for r in found) < 30
    seen = spark.createDataFrame([(f"q{i}" + "x" * 90,) for i in range(25)], "o string").select(generate.opening("o").alias("opening"))
    assert generate.counted(df, counts, seen=seen).count() == 0


def test_counted_makes_no_text_after_the_last_candidate_tried(spark):
    late = F.when(F.col("id") >= 50, F.raise_error(F.lit("made"))).otherwise(F.lit("s"))
    df = spark.range(200).select(F.col("id").alias("candidate"), F.lit("a").alias("category"), F.concat(F.lit("q"), "id").alias("user"), late.cast("string").alias("assistant"))
    assert sorted(r.candidate for r in generate.counted(df, {"a": 10}).collect()) == list(range(10))


@pytest.mark.parametrize("seed", range(4))
def test_drawn_generation_equals_one_draw_after_another(spark, seed):
    rng = random.Random(seed)
    rows = [(d, a, f"q{rng.randrange(60)}") for d in range(100) for a in range(5)]
    seen, want = {"q7"}, set()
    for d, a, user in rows:
        if user not in seen and d not in {w[0] for w in want}:
            seen.add(user)
            want.add((d, a))
    df = spark.createDataFrame(rows, "draw long, attempt int, user string").repartition(3)
    found = generate.drawn(df, seen=spark.createDataFrame([("q7",)], "opening string")).collect()
    assert {(r.draw, r.attempt) for r in found} == want and 50 < len(found) == len(want) <= 59


def test_draws_move_digests_instead_of_texts(spark, monkeypatch):
    """What is stored between the rounds holds no text, and shrinks to the draws still open."""
    stored = []
    monkeypatch.setattr(generate, "settle", lambda df, name="table": stored.append(df.cache()) or df)
    rows = [(d, a, f"q{(d * 7 + a * 11) % 90}" + "x" * 90) for d in range(120) for a in range(5)]
    df = spark.createDataFrame(rows, "draw long, attempt int, user string").repartition(3)
    found = [tuple(r) for r in generate.taken_attempts(df).collect()]
    want, seen = [], set()
    for d, a, user in rows:
        if user[:80] not in seen and d not in {w[0] for w in want}:
            seen.add(user[:80])
            want.append((d, a))
    assert sorted(found) == want
    assert stored and not any("string" in s.schema.simpleString() for s in stored)
    sizes = [s.count() for s in stored]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]


def test_hybrid_from_a_table_falls_back_on_its_own_candidates(spark):
    rows = [(i, "ab"[i % 2], f"q{i // 2}", "s") for i in range(400)]
    df = spark.createDataFrame(rows, "candidate long, category string, user string, assistant string")
    found = generate.hybrid_of(df, 50, ["a", "b"]).collect()
    assert sum(r.source == "template" for r in found) == 40 and sum(r.source == "template_fallback" for r in found) == 10
    assert len({r.user for r in found}) == 50


def test_ranks_of_several_groups_in_one_search(spark, monkeypatch):
    monkeypatch.setattr(cuts, "FEW_ROWS", 5)
    monkeypatch.setattr(cuts, "BUCKETS", 4)
    rows = [(i % 3, i * 37 % 101 if i % 3 else 7, i) for i in range(600)]
    table = cuts.numbered(spark.createDataFrame(rows, "g int, v long, id long"), F.col("v"), [F.col("id")], F.col("g"))
    order = {g: sorted((v, i) for h, v, i in rows if h == g) for g in range(3)}
    found = cuts.of_ranks(table, {0: [1, 150, 201], 1: [1, 2, 200], 2: [77, 0], 9: [1]})
    assert found == {(0, 1): order[0][0], (0, 150): order[0][149], **{(1, k): order[1][k - 1] for k in (1, 2, 200)}, (2, 77): order[2][76]}


@pytest.mark.parametrize("order", [["ts", "event_id"], ["event_id"]])
def test_positions_of_one_time_stamp_and_many_large_keys(spark, order):
    rows = [(0, 5, (i * 7919) % 3_000) for i in range(3_000)] + [(k, 5, i) for k in range(1, 201) for i in range(12)] + [(None, 5, i) for i in range(15)]
    df = spark.createDataFrame(rows, "user long, ts long, event_id long").repartition(4)
    for chunk_rows in (10, 250):
        placed = hotkeys.add_position(df, "user", order, chunk_rows=chunk_rows).collect()
        assert len(placed) == len(rows) and all(r.position == r.event_id + 1 for r in placed)
    chunked, cut = hotkeys.add_chunks(df, "user", order, 250)
    assert cut and max(r["count"] for r in chunked.groupBy("chunk").count().collect()) < 1_500


@pytest.mark.parametrize("smoothing, block_rows", [(0.9, 512), (0.9, 7), (0.999, 3), (0.01, 50), (1.0, 8), (0.0, 8)])
def test_smoothing_in_blocks_equals_a_loop(spark, smoothing, block_rows):
    rng = random.Random(1)
    rows = [(run, step, rng.uniform(-5, 9) if rng.random() < 0.9 else None) for run in (1, None) for step in range(400)]
    found = {(r.run_id, r.step): r.smoothed for r in runlogs.smoothed_loss(spark.createDataFrame(rows, "run_id long, step long, loss double"), smoothing, block_rows=block_rows).collect()}
    value, last = None, object()
    for run, step, x in rows:
        if run is not last:
            value, last = None, run
        if x is None:
            assert (run, step) not in found
            continue
        value = x if value is None else smoothing * value + (1 - smoothing) * x
        assert abs(found[run, step] - value) < 1e-9


def test_a_conversation_in_chunks_gives_the_same_prompt(spark):
    rows = [(1, t, ("system", "user", None, "assistant")[t % 4], f"t{t}" if t % 5 else None) for t in range(60)]
    rows += [(2, 0, "system", "only")] + [(3, 1, "user", x) for x in "ab"] + [(4, None, "user", "none")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    whole, cut = (sorted(conversation.conversation_prompts(df, "be brief", chunk_rows=n).collect()) for n in (1_000_000, 7))
    assert whole == cut and len(whole) == 4
    spoken = [f"<|im_start|>{r or 'user'}\n{x or ''}\n<|im_end|>" for c, t, r, x in rows if c == 1 and r != "system"]
    assert whole[0].prompt == "\n".join(["<|im_start|>system\nbe brief\n<|im_end|>", *spoken, "<|im_start|>assistant\n"])
    assert whole[1].prompt == "<|im_start|>system\nbe brief\n<|im_end|>\n<|im_start|>assistant\n"


def test_counts_of_cleaning_nothing(spark):
    from colloquy.plans import cleaning

    none = spark.createDataFrame([], "example_id long, user string, assistant string, category string")
    done = cleaning.clean(none)
    assert [r.n for r in done.funnel.collect()] == [0, 0, 0, 0] and done.examples.count() == 0
    assert cleaning.retention_rate(done.funnel).first()[0] is None
    assert [r.n for r in cleaning.clean(none, mask_pii=False, remove_duplicates=False, filter_by_quality=False).funnel.collect()] == [0] * 4
