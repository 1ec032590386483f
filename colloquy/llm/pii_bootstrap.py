"""Personal data by bootstrapped contextual extraction.

Fixed formats give the base spans.  Their entities are the seeds: the words around them are lexical
patterns, a pattern is worth the share of its entities that are believed, an entity is believed by
the patterns it stands in, and both are scored on the graph of patterns and entities, in rounds until no pattern is new.  Tokens and
numbers in groups that look like identifiers and stand in a pattern of high worth are found too.
"""

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.batches import map_rows
from colloquy.operators.lineage import settle

#: The kinds in their order.
KINDS = ["email", "ip", "card", "phone"]
#: A pattern needs so much belief (distinct seed entities count one each), such a share of it against
#: the evidence to the contrary, and such a confidence: share of all its entities times log2 of the belief.
SUPPORT, WORTH, CONFIDENCE = 3.0, 0.8, 0.5
#: An entity of no kind counts against a pattern if it stands in so many different contexts without seeds.
PLAIN = 3
#: Characters looked at on each side for context words.
REACH = 80

_RUN = re.compile(r"[A-Za-z0-9._%+-]+(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]+((?:\.[0-9]+){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_TRIM = "\"'`.,;:!?()[]{}<>|*#$%&=“”«»…"
#: Digit groups of one number as people write it, from the start of a token to the end of one.
_GROUPS = re.compile(
    rf"(?<!\S)[{re.escape(_TRIM)}]*?(\+?[(\[]?[0-9]+(?:(?:[\x20\xa0.-]?[(\[]|[)\]][\x20\xa0.-]?|[\x20\xa0.-]|\x20[–-]\x20)[0-9]+)+)"
    rf"(?=[{re.escape(_TRIM)}]*(?:\s|\Z))"
)

SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)
SEEN = T.StructType(
    [
        *SPAN.fields, T.StructField("whole", T.IntegerType()), T.StructField("entity", T.StringType()),
        T.StructField("patterns", T.ArrayType(T.StringType())),
    ]
)


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed formats, by start and kind.  A run of local-part or digit characters is
    taken as a whole whether or not the rest follows, so that the scan is linear."""
    found = []
    if "@" in text:
        found += [("email", *m.span()) for m in _RUN.finditer(text) if m[1]]
    for m in _IP.finditer(text):
        if m[1] and all(len(d := p.lstrip("0")) < 4 and int(d or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() < 40 else ""
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return in_order(found)


def in_order(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _tokens(text: str, taken) -> list[tuple[int, int]]:
    """Tokens with a digit or an at sign, without marks around them, outside the taken spans: at least
    four digits, or an at sign inside."""
    out, end = [], 0
    ends = iter(sorted((a, b) for _, a, b in taken))
    blocked: list[tuple[int, int]] = list(ends)
    k = 0
    for m in _MARK.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        end = m.end()
        while end < len(text) and not text[end].isspace():
            end += 1
        word = text[start:end]
        a = start + len(word) - len(word.lstrip(_TRIM))
        word = word.strip(_TRIM)
        b = a + len(word)
        while k < len(blocked) and blocked[k][1] <= a:
            k += 1
        if any(x < b and a < y for x, y in blocked[k : k + len(KINDS)]):
            continue
        if len(word) <= 64 and (sum(map(str.isdigit, word)) >= 4 or "@" in word[1:-1]):
            out.append((a, b))
    return out


def _numbers(text: str, taken) -> list[tuple[int, int]]:
    """Runs of digit groups, as long as they go, between the taken spans: at least four digits in all."""
    out, at = [], 0
    for start, end in [*sorted((a, b) for _, a, b in taken), (len(text), len(text))]:
        for m in _GROUPS.finditer(text, at, max(at, start)):
            a, b = m.span(1)
            if m[1][0] in "([" and not set(m[1]) & set(")]"):
                a += 1
            if b - a <= 64 and sum(map(str.isdigit, text[a:b])) >= 4:
                out.append((a, b))
        at = max(at, end)
    return out


def _candidates(text: str, taken) -> list[tuple[int, int, int]]:
    """Numbers and tokens, each with the start of the number it is part of, or its own."""
    numbers = _numbers(text, taken)
    out, k = [(a, b, a) for a, b in numbers], 0
    for a, b in _tokens(text, taken):
        while k < len(numbers) and numbers[k][1] <= a:
            k += 1
        if k < len(numbers) and numbers[k][0] < b:
            if (a, b) != numbers[k]:
                out.append((a, b, numbers[k][0]))
        else:
            out.append((a, b, a))
    return out


def _patterns(text: str, start: int, end: int) -> list[str]:
    """The two words before, without marks that touch the entity; the word before and the word after."""
    clean = lambda w: w.lower().strip(_TRIM)
    before = [clean(w) for w in text[max(0, start - REACH) : start].rstrip(_TRIM).split()[-2:]]
    after = [clean(w) for w in text[end : end + REACH].split()[:1]]
    out = []
    if len(before) == 2 and all(before):
        out.append(" ".join(before) + " _")
    if before and before[-1] and after and after[0]:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


def _entity(text: str) -> str:
    """A short name of an entity: its letters and digits."""
    kept = "".join(c for c in text.lower() if c.isalnum())
    return kept if len(kept) <= 40 else hashlib.sha256(kept.encode()).hexdigest()


def seen(text: str) -> list[tuple]:
    """Base spans with kind, identifier-like tokens and grouped numbers without; each with the start of the number
    around it, entity and patterns."""
    if not _MARK.search(text):
        return []
    base = base_spans(text)
    spans = [*((k, a, b, a) for k, a, b in base), *((None, *c) for c in _candidates(text, base))]
    return [(k, a, b, whole, _entity(text[a:b]), _patterns(text, a, b)) for k, a, b, whole in spans]


def scan(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``seen``, one row per row (null text: none seen)."""
    new = T.StructType([T.StructField("seen", T.ArrayType(SEEN))])
    return map_rows(df, text, keep, new, lambda: lambda x: [(seen(x or ""),)])


def _plain(occurrences: DataFrame, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``entity`` of those that stand in ``PLAIN`` or more contexts none of whose patterns has a seed."""
    seeded = edges.join(seeds.select("entity").distinct(), "entity", "left_semi").select("pattern").distinct()
    contexts = occurrences.where("kind is null and size(patterns) > 0").select("entity", "patterns").distinct()
    counted = contexts.groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") >= PLAIN)
    contexts = contexts.join(counted.select("entity"), "entity", "left_semi")
    near = contexts.withColumn("pattern", F.explode("patterns")).join(seeded, "pattern", "left_semi")
    far = contexts.join(near.select("entity", "patterns").distinct(), ["entity", "patterns"], "left_anti")
    far = far.groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") >= PLAIN)
    return far.join(seeds, "entity", "left_anti").select("entity")


def pattern_worth(
    occurrences: DataFrame, rounds: int | None = None, support: float = SUPPORT, worth: float = WORTH,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """``pattern, kind, worth`` of the patterns to trust, from ``kind, entity, patterns``.

    Worth is the belief in the pattern's distinct entities over itself, the evidence to the contrary (belief
    in other kinds, plain entities not believed) and a half; entities of which nothing is known do not count.  They
    lower only the confidence, which a few seeds among very many unknown do not reach.  An
    entity's belief in a kind is one for seeds; for others the chance that one of its patterns
    of the round is right.  Rounds end when one trusts no pattern that was not trusted before, or after
    ``rounds``.  All sums are grouped sums over distinct edges."""
    edges = settle(
        occurrences.select("entity", F.explode("patterns").alias("pattern")).distinct(), "pattern-edges"
    )
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    seeds = occurrences.where("kind is not null").select("entity", "kind", F.lit(1.0).alias("belief")).distinct()
    plain, belief, known, done = None, seeds, None, 0
    while True:
        sums = edges.join(belief, "entity").groupBy("pattern", "kind").agg(F.sum("belief").alias("sum"))
        total = sums.groupBy("pattern").agg(F.sum("sum").alias("total"))
        likely = (
            sums.where(F.col("sum") >= support).join(sizes, "pattern").join(total, "pattern")
            .where(F.col("sum") / F.col("n") * F.log2("sum") >= confidence)
        )
        likely = settle(likely.where(F.col("sum") / (F.col("total") + 0.5) >= worth), "likely")
        if plain is None:
            none = likely.isEmpty()
            plain = edges.select("entity").limit(0) if none else settle(_plain(occurrences, edges, seeds), "plain")
        doubted = plain.join(belief, "entity", "left_anti")
        against = edges.join(doubted, "entity", "left_semi").groupBy("pattern").agg(F.count("*").alias("against"))
        scored = likely.join(against, "pattern", "left").select(
            "pattern", "kind",
            F.round(F.col("sum") / (F.col("total") + F.coalesce("against", F.lit(0)) + 0.5), 9).alias("worth"),
        )
        trusted = settle(scored.where(F.col("worth") >= worth), "patterns")
        names, done = trusted.select("pattern", "kind"), done + 1
        fresh = names if known is None else names.join(known, ["pattern", "kind"], "left_anti")
        if done == rounds or fresh.isEmpty():
            return trusted
        known = settle(names if known is None else known.union(fresh), "known-patterns")
        grown = (
            edges.join(trusted, "pattern").groupBy("entity", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("worth", F.lit(0.99)))))).alias("belief"))
        )
        grown = grown.join(seeds.select("entity").distinct(), "entity", "left_anti")
        belief = settle(seeds.union(grown), "belief")


def _outer(parts: str) -> Column:
    """Of the spans found in one number (64 characters at most) those that lie in no other."""
    inside = lambda s, o: (o["start"] <= s["start"]) & (s["end"] <= o["end"]) & (o["end"] - o["start"] > s["end"] - s["start"])
    return F.filter(parts, lambda s: ~F.exists(parts, lambda o: inside(s, o)))


def marked(df: DataFrame, keep: list[str], text: str = "text", **options) -> DataFrame:
    """``keep`` columns, ``base`` and ``found``: arrays of spans (kind, start, end in code points, end
    exclusive), one row per row.

    Null and empty texts have none.  Rows are numbered in the stored scan, so repeated rows and keys
    stay apart; columns besides ``keep`` are dropped.  Without trusted patterns ``found`` is
    empty everywhere.  Of several trusted patterns of a token the worthiest decides the kind, of equal ones the
    kind that comes first by name."""
    rows = settle(scan(df, keep, text).withColumn("__row", F.monotonically_increasing_id()), "seen")
    each = rows.select("__row", F.explode("seen").alias("s")).select("__row", "s.*")
    trusted = pattern_worth(each.select("kind", "entity", "patterns"), **options)
    tokens = each.where("kind is null").select("__row", "start", "end", "whole", F.explode("patterns").alias("pattern"))
    best = F.max_by("kind", F.struct("worth", F.expr("-ascii(kind)")))
    found = (
        tokens.join(trusted, "pattern").groupBy("__row", "start", "end", "whole").agg(best.alias("kind"))
        .groupBy("__row", "whole").agg(F.collect_list(F.struct("kind", "start", "end")).alias("parts"))
        .groupBy("__row").agg(F.flatten(F.collect_list(_outer("parts"))).alias("found"))
    )
    spans = lambda a: F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.join(found, "__row", "left").select(
        *keep,
        spans(F.filter("seen", lambda s: s["kind"].isNotNull())).alias("base"),
        F.coalesce("found", F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("found"),
    )


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, by start and then kind, comma-joined."""
    place = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    sortable = F.transform(
        spans, lambda s: F.struct(s["start"].alias("a"), F.element_at(place, s["kind"]).alias("k"), s["end"].alias("b"), s["kind"].alias("kind"))
    )
    parts = F.transform(F.sort_array(sortable), lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string")))
    return F.array_join(parts, ",")


def mask(text: str, spans) -> str:
    """The text with each span replaced by its kind; spans that overlap become one, of the first."""
    out, at = [], 0
    for kind, start, end in in_order(spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def masked(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """All columns of ``df``, whatever their names, the text masked (null stays null, empty stays empty); one row per row,
    repeated ones too.  An empty table gives an empty result."""
    stored = settle(df.select(F.struct(*df.columns).alias("row"), F.monotonically_increasing_id().alias("id")), "pii-rows")
    spans = marked(stored, ["id"], f"row.{text}", **options)
    spans = spans.select("id", F.concat("base", "found").alias("spans")).where(F.size("spans") > 0)
    both = stored.join(spans, "id", "left")
    hit = both.where("spans is not null").select("row", F.struct(F.col("row")[text].alias("text"), "spans").alias("both"))
    new = T.StructType([T.StructField("masked", T.StringType())])
    replace = lambda: lambda x: [(mask(x["text"], [(s["kind"], s["start"], s["end"]) for s in x["spans"]]),)]
    done = map_rows(hit, "both", ["row"], new, replace)
    columns = lambda changed: [changed if c == text else F.col("row")[c].alias(c) for c in df.columns]
    plain = both.where("spans is null").select(*columns(F.col("row")[text].alias(text)))
    return plain.union(done.select(*columns(F.col("masked").alias(text))))
