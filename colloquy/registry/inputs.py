"""Views over the given tables that the registered queries start from."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy import fixed, templates
from colloquy.operators import conversation, generate, hotkeys

EVERY_STEP = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark, folder):
    return table(spark, folder, "documents")


def category_of(number):
    names = F.array(*[F.lit(c) for c in fixed.CATEGORIES])
    return F.get(names, F.pmod(number, F.lit(len(fixed.CATEGORIES))).cast("int"))


def pairs(spark, folder):
    """Conversation pairs with a category picked by conversation."""
    found = conversation.adjacent_pairs(table(spark, folder, "conversations"))
    return found.select("example_id", "user", "assistant", category_of(F.col("conv_id")).alias("category"))


def document_examples(spark, folder):
    """Each document as an example: its first line asked about, its text the answer."""
    return documents(spark, folder).select(
        F.col("doc_id").alias("example_id"),
        F.substring_index("text", "\n", 1).alias("user"),
        F.col("text").alias("assistant"),
        category_of(F.col("doc_id")).alias("category"),
    )


def customers(spark, folder):
    """Customers with the slots of the templates that the tables can fill."""
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation")
    )
    return table(spark, folder, "customer").join(nation, "c_nationkey").select(
        "c_custkey", F.col("c_name").alias("customer"), F.col("c_mktsegment").alias("segment"), "nation"
    )


def contacts(spark, folder):
    """A note per customer in the shapes the rules look for: phone, social security, card and network numbers, a
    placeholder, another script, repeated words, too few characters."""
    k = F.col("c_custkey")
    digits = lambda number, n: F.lpad((number % 10**n).cast("string"), n, "0")
    three, four, name = digits(k * 7, 3), digits(k, 4), F.col("c_name")
    shapes = [
        ("Call me at 555-", three, "-", four, " about the claim of ", name),
        ("Call 555", three, four, " today and ask for ", name),
        ("+1 (743) ", three, "-", four, " has blanks and is no number here"),
        ("Her number is 123-45-", four, ", the name is ", name),
        ("Write to c", four, "@example.org or charge 4111 1111 1111 ", four),
        ("The server 10.0.7.", (k % 256).cast("string"), " belongs to ", name),
        ("[PLACEHOLDER] stands where the text for ", name, " belongs"),
        ("Страховой полис клиента номер ", four, " действует до конца года"),
        ("claim claim claim claim claim ", four),
        ("ok ", four),
    ]
    note = F.lit(None).cast("string")
    for i, parts in enumerate(shapes):
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        note = F.when(k % len(shapes) == i, text).otherwise(note)
    answer = F.concat(F.lit("We have noted this for you: "), F.col("user"))
    return table(spark, folder, "customer").select(k.alias("example_id"), "c_name", note.alias("user")).select(
        "example_id", "user", F.when(F.col("example_id") % 3 != 0, answer).otherwise(F.col("c_name")).alias("assistant"),
        category_of(F.col("example_id")).alias("category"),
    )


def order_candidates(spark, folder):
    """Orders as generator candidates, the customer filling the slots of that kind."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return orders.join(customers(spark, folder), "c_custkey").select(
        F.col("o_orderkey").alias("candidate"),
        category_of(F.col("o_orderkey")).alias("category"),
        "customer", "segment", "nation",
    )


#: The default templates with one question that all categories ask in the same words.
SHARED_QUESTION = ("Are {segment} goods for {nation} one zone?", "Zones follow the tariff: {part} have their own for {nation}.")
SHARED_TEMPLATES = {c: [*pairs, SHARED_QUESTION] for c, pairs in templates.TEMPLATES.items()}


def wanted_counts(spark, folder, factor):
    """Examples wanted of each category: the customers of a market segment times a power of ``factor``."""
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    counts = table(spark, folder, "customer").where(F.col("c_mktsegment").isin(segments)).groupBy("c_mktsegment").count()
    found = dict(tuple(r) for r in counts.collect())
    return {c: found.get(s, 0) * factor**i for i, (c, s) in enumerate(zip(fixed.CATEGORIES, segments))}


def order_attempts(spark, folder, taken=None):
    """A draw per order: a category picked by its customer, and five attempts, or those ``taken`` (``draw, attempt``)."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("draw"), F.col("o_custkey").alias("c_custkey"))
    if taken is None:
        every = F.explode(F.sequence(F.lit(0), F.lit(fixed.ATTEMPTS_PER_EXAMPLE - 1))).alias("attempt")
        slots = orders.join(customers(spark, folder), "c_custkey").select("*", every)
    else:
        slots = orders.join(taken, "draw").join(customers(spark, folder), "c_custkey")
    number = F.col("draw") * fixed.ATTEMPTS_PER_EXAMPLE + F.col("attempt")
    candidates = slots.select("customer", "segment", "nation", category_of(F.col("c_custkey")).alias("category"), number.alias("candidate"))
    filled = generate.fill_templates(candidates, templates=SHARED_TEMPLATES)
    return filled.withColumns({
        "draw": F.expr(f"candidate div {fixed.ATTEMPTS_PER_EXAMPLE}"), "attempt": (F.col("candidate") % fixed.ATTEMPTS_PER_EXAMPLE).cast("int"),
    })


def spread(df: DataFrame, key: str) -> DataFrame:
    """The narrow rows dealt over four tasks a core before long texts are made of them: their file is so small that one
    task would read it, and make and score all texts.  A number of tasks given here is not merged again."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, key)


def answers(spark, folder, seed):
    """One filled example per customer; other seeds give other answers."""
    candidates = spread(customers(spark, folder), "c_custkey").select(
        F.col("c_custkey").alias("candidate"), category_of(F.col("c_custkey")).alias("category"),
        "customer", "segment", "nation",
    )
    return generate.fill_templates(candidates, seed).withColumnRenamed("candidate", "example_id")


def reference_answers(spark, folder):
    return answers(spark, folder, 42)


def predictions(spark, folder, seed):
    return answers(spark, folder, seed).select("example_id", F.col("assistant").alias("prediction"))


def completions(spark, folder):
    """Raw model output around the answers, in the shapes a model leaves it in."""
    made = reference_answers(spark, folder)
    shape = F.pmod("example_id", F.lit(5))
    head, body = F.concat(F.lit("USER: "), "user"), F.concat(F.lit("\nAGENT: "), "assistant")
    text = (
        F.when(shape == 0, F.concat(F.lit("Here it is.\n"), head, body))
        .when(shape == 1, F.concat(head, body, F.lit("\n\n\nUSER: more?")))
        .when(shape == 2, F.concat(head, body, F.lit("\nAGENT: short")))
        .when(shape == 3, F.concat(head, F.lit(" "), "assistant"))
        .otherwise(F.concat(head, body, F.lit("\n"), head, body))
    )
    return made.select("example_id", "category", text.alias("text"))


def choice_scores(spark, folder):
    """The first half of an embedding as one model's scores, the second as the other's: a
    choice scores the largest of its eight elements."""
    vectors = table(spark, folder, "embeddings")
    scores = lambda first: F.array(
        *[F.array_max(F.slice("embedding", first + 8 * i, 8)) for i in range(4)]
    ).alias("scores")
    models = F.explode(
        F.array(
            F.struct(F.lit("baseline").alias("model"), scores(1)),
            F.struct(F.lit("finetuned").alias("model"), scores(33)),
        )
    )
    return vectors.select(F.col("vec_id").alias("question_id"), models.alias("m")).select(
        "question_id", "m.model", F.posexplode("m.scores").alias("choice_idx", "score")
    )


def choice_items(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("question_id"),
        F.concat(F.lit("Which quarter of half a vector holds the largest number of "), F.col("vec_id").cast("string"), F.lit("?")).alias("question"),
        (F.col("label") % 4).alias("answer"),
        F.col("label").cast("string").alias("category"),
    )


def nation_questions(spark, folder):
    """A question per customer: which of four nations is theirs."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    out = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("question_id"), "c_name", "c_nationkey",
        (F.col("c_custkey") % 4).cast("int").alias("answer"),
    )
    for i in range(4):
        wanted = F.pmod(F.col("c_nationkey") + (F.lit(i) - F.col("answer")) * 6, F.lit(25))
        choice = nation.select(
            F.col("n_nationkey").alias(f"_k{i}"), F.col("n_name").alias(f"_c{i}")
        )
        out = out.withColumn(f"_w{i}", wanted)
        out = out.join(choice, F.col(f"_w{i}") == F.col(f"_k{i}"))
    return out.select(
        "question_id",
        F.concat(F.lit("Which nation is "), "c_name", F.lit(" from?")).alias("question"),
        F.array("_c0", "_c1", "_c2", "_c3").alias("choices"),
        "answer",
    )


def run_log(spark, folder):
    """Events as a run log: a user is a run, events in time order are its steps."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    placed = hotkeys.add_position(events, "user_id", ["ts", "event_id"], "step")
    return placed.select(
        F.col("user_id").alias("run_id"), "step", "ts",
        F.col("value").alias("loss"), F.col("value").alias("eval_loss"), F.col("value").alias("gauge"),
    )


def requests(spark, folder):
    return table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"), "ts",
        F.col("event_type").alias("model"),
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("prompt_tokens"),
        F.floor(F.col("value") * 7).cast("int").alias("completion_tokens"),
        F.col("value").alias("latency_seconds"),
    )
