"""Plain SQL for the registered queries, written independently of the operators."""

from colloquy import fixed, templates
from colloquy.registry import inputs

ORACLES = {}


def lit(text) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


CATEGORIES = lits(fixed.CATEGORIES)


def category(number) -> str:
    return f"{CATEGORIES}[1 + ({number}) % {len(fixed.CATEGORIES)}]"


def words(text) -> str:
    return f"list_filter(string_split_regex(lower({text}), '\\s+'), lambda w: w <> '')"


def strip(text) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def pick(n, *parts) -> str:
    joined = ", ".join(parts)
    return f"('0x' || substr(md5(concat_ws(':', {joined})), 1, 8))::BIGINT % {n}"


def most(ws) -> str:
    return f"coalesce(list_max(map_values(list_aggregate({ws}, 'histogram'))), 0)"


PAIRS = f"""
pairs AS (
  SELECT conv_id * 2147483648 + turn AS example_id, text AS "user", assistant,
         {category('conv_id')} AS category
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS assistant
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')
"""

DOCS = f"""
docs AS (
  SELECT doc_id AS example_id, split_part(text, chr(10), 1) AS "user", text AS assistant,
         {category('doc_id')} AS category FROM documents)
"""

# --- personal data ----------------------------------------------------------------


def pii_n(text, t) -> str:
    return f"len(regexp_extract_all({text}, {lit(fixed.PII_PATTERNS[t])}))"


def masked(text) -> str:
    out = text
    for t in fixed.PII_TYPES:
        out = f"CASE WHEN {pii_n(text, t)} > 0 THEN regexp_replace({out}, {lit(fixed.PII_PATTERNS[t])}, {lit(fixed.PII_TOKENS[t])}, 'g') ELSE {out} END"
    return out


def masked_steps(source, text, keep) -> str:
    """The nested form doubles per type, so each type is its own step."""
    sql = f"SELECT {keep}, {text} AS original, {text} AS m FROM {source}"
    for t in fixed.PII_TYPES:
        sql = f"SELECT * EXCLUDE (m), CASE WHEN {pii_n('original', t)} > 0 THEN regexp_replace(m, {lit(fixed.PII_PATTERNS[t])}, {lit(fixed.PII_TOKENS[t])}, 'g') ELSE m END AS m FROM ({sql})"
    return sql


ORACLES["pii_counts"] = "SELECT doc_id, " + ", ".join(
    f"{pii_n('text', t)}::INT AS {t}" for t in fixed.PII_TYPES
) + " FROM documents"
ORACLES["pii_mask"] = f"SELECT doc_id, m AS text FROM ({masked_steps('documents', 'text', 'doc_id')})"
ORACLES["pii_by_source"] = " UNION ALL ".join(
    f"SELECT source, '{t}' AS pii_type, sum({pii_n('text', t)})::BIGINT AS n FROM documents GROUP BY source HAVING sum({pii_n('text', t)}) > 0"
    for t in fixed.PII_TYPES
)
ORACLES["pii_totals"] = f"WITH {DOCS} " + " UNION ALL ".join(
    f"""SELECT '{f}' AS field, '{t}' AS pii_type, sum({pii_n(f'"{f}"', t)})::BIGINT AS n FROM docs HAVING sum({pii_n(f'"{f}"', t)}) > 0"""
    for f in ("user", "assistant") for t in fixed.PII_TYPES
)

CONTACTS = f"""
notes AS (SELECT c_custkey AS example_id, c_name, lpad((c_custkey * 7 % 1000)::VARCHAR, 3, '0') AS three, lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS four FROM customer),
said AS (SELECT *, CASE example_id % 10
  WHEN 0 THEN 'Call me at 555-' || three || '-' || four || ' about the claim of ' || c_name
  WHEN 1 THEN 'Call 555' || three || four || ' today and ask for ' || c_name
  WHEN 2 THEN '+1 (743) ' || three || '-' || four || ' has blanks and is no number here'
  WHEN 3 THEN 'Her number is 123-45-' || four || ', the name is ' || c_name
  WHEN 4 THEN 'Write to c' || four || '@example.org or charge 4111 1111 1111 ' || four
  WHEN 5 THEN 'The server 10.0.7.' || (example_id % 256) || ' belongs to ' || c_name
  WHEN 6 THEN '[PLACEHOLDER] stands where the text for ' || c_name || ' belongs'
  WHEN 7 THEN 'Страховой полис клиента номер ' || four || ' действует до конца года'
  WHEN 8 THEN 'claim claim claim claim claim ' || four
  ELSE 'ok ' || four END AS "user" FROM notes),
contacts AS (SELECT example_id, "user", CASE WHEN example_id % 3 <> 0 THEN 'We have noted this for you: ' || "user" ELSE c_name END AS assistant FROM said)"""
CONTACT_COUNTS = ", ".join(f"{pii_n('original', t)}::INT AS {t}" for t in fixed.PII_TYPES)
ORACLES["contact_pii"] = f"""WITH {CONTACTS}
SELECT example_id, m AS "user", {CONTACT_COUNTS} FROM ({masked_steps('contacts', '"user"', 'example_id')})"""
ORACLES["contact_pii_totals"] = f"WITH {CONTACTS} " + " UNION ALL ".join(
    f"""SELECT '{f}' AS field, '{t}' AS pii_type, sum({pii_n(f'"{f}"', t)})::BIGINT AS n FROM contacts HAVING sum({pii_n(f'"{f}"', t)}) > 0"""
    for f in ("user", "assistant") for t in fixed.PII_TYPES
)

# --- quality ----------------------------------------------------------------------


def bad_length(text) -> str:
    return f"(length({text}) < 20 OR length({text}) > 1000)"


def repetitive(text) -> str:
    ws = words(text)
    return f"(len({ws}) >= 5 AND {most(ws)}::DOUBLE / len({ws}) > 0.3::DOUBLE)"


def english(text) -> str:
    letters = f"length(regexp_replace({text}, '[^\\p{{L}}]', '', 'g'))"
    ascii_letters = f"length(regexp_replace({text}, '[^A-Za-z]', '', 'g'))"
    return f"({text} <> '' AND ({letters} = 0 OR {ascii_letters}::DOUBLE / nullif({letters}, 0) > 0.7::DOUBLE))"


def score(u='"user"', a="assistant") -> str:
    off = lambda rule, points: f" - (CASE WHEN {rule} THEN {points} ELSE 0.0 END)::DOUBLE"
    return (
        "greatest(0.0::DOUBLE, 1.0::DOUBLE"
        + off(bad_length(u), 0.3)
        + off(bad_length(a), 0.3)
        + off(f"{repetitive(u)} OR {repetitive(a)}", 0.2)
        + off(f"NOT {english(u)} OR NOT {english(a)}", 0.1)
        + off(f"contains({u}, '[PLACEHOLDER]') OR contains({a}, '[PLACEHOLDER]')", 0.5)
        + ")"
    )


ORACLES["pair_quality"] = f"WITH {PAIRS} SELECT example_id, round({score()}, 6) AS quality FROM pairs"
ORACLES["document_quality"] = f"WITH {DOCS} SELECT example_id, round({score()}, 6) AS quality FROM docs"
ORACLES["quality_filter"] = f"WITH {DOCS} SELECT example_id, category FROM docs WHERE {score()} >= 0.9::DOUBLE"
ORACLES["quality_summary"] = f"""WITH {DOCS}, s AS (SELECT {score()} AS q FROM docs)
SELECT round(avg(q), 6) AS mean_quality, count(*) FILTER (q >= 0.9::DOUBLE) AS kept,
       count(*) FILTER (q < 0.9::DOUBLE) AS removed FROM s"""
ORACLES["quality_vs_label"] = f"""
SELECT l.quality, count(*) AS n, count(*) FILTER ({bad_length('d.text')}) AS bad_length,
       count(*) FILTER ({repetitive('d.text')}) AS repetitive, count(*) FILTER ({english('d.text')}) AS english
FROM documents d JOIN labels l USING (doc_id) GROUP BY l.quality"""

ORACLES["contact_quality"] = f"""WITH {CONTACTS}
SELECT example_id, {bad_length('"user"')} AS bad_length, {repetitive('"user"')} AS repetitive, {english('"user"')} AS english,
  contains("user", '[PLACEHOLDER]') OR contains(assistant, '[PLACEHOLDER]') AS placeholder, round({score()}, 6) AS quality FROM contacts"""

# --- near-duplicates --------------------------------------------------------------


def shingles(text) -> str:
    ws = words(text)
    return f"""CASE WHEN len({ws}) < 2 THEN [{strip(f'lower({text})')}]
      ELSE list_distinct(list_transform(range(1, len({ws})), lambda i: ({ws})[i] || ' ' || ({ws})[i + 1])) END"""


def shingle_rows(source, key, text) -> str:
    """The words are split once, in their own step."""
    return f"""
tokens AS MATERIALIZED (SELECT {key} AS id, {text} AS t, {words(text)} AS ws FROM {source}),
sets AS MATERIALIZED (
  SELECT id, CASE WHEN len(ws) < 2 THEN [{strip('lower(t)')}]
    ELSE list_distinct(list_transform(list_zip(ws[1:len(ws)-1], ws[2:]), lambda z: z[1] || ' ' || z[2])) END AS s
  FROM tokens)"""


def greedy(threshold) -> str:
    return f"""
grams AS (SELECT id, len(s) AS n, unnest(s) AS g FROM sets),
edges AS MATERIALIZED (
  SELECT a.id AS lo, b.id AS hi FROM grams a JOIN grams b ON a.g = b.g AND a.id < b.id
  WHERE least(a.n, b.n)::DOUBLE / greatest(a.n, b.n) >= {threshold}::DOUBLE
  GROUP BY a.id, b.id, a.n, b.n HAVING count(*)::DOUBLE / (a.n + b.n - count(*)) >= {threshold}::DOUBLE),
steps AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY hi) AS i, hi, los FROM (SELECT hi, list(lo) AS los FROM edges GROUP BY hi)),
walk AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS gone
  UNION ALL
  SELECT s.i, CASE WHEN len(list_filter(s.los, lambda x: NOT list_contains(w.gone, x))) > 0
                   THEN list_append(w.gone, s.hi) ELSE w.gone END
  FROM walk w JOIN steps s ON s.i = w.i + 1),
gone AS (SELECT unnest(gone) AS id FROM (SELECT gone FROM walk ORDER BY i DESC LIMIT 1))"""


ORACLES["shingle_sizes"] = f"WITH {shingle_rows('documents', 'doc_id', 'text')} SELECT id AS doc_id, len(s)::INT AS shingles FROM sets"
ORACLES["pair_jaccard"] = f"""WITH {PAIRS},
u AS (SELECT example_id, {shingles('"user"')} AS s FROM pairs),
a AS (SELECT example_id, {shingles('assistant')} AS s FROM pairs)
SELECT example_id, round(len(list_intersect(u.s, a.s))::DOUBLE / (len(u.s) + len(a.s) - len(list_intersect(u.s, a.s))), 6) AS jaccard
FROM u JOIN a USING (example_id)"""
for name, t in (("near_dup_keep", 0.8), ("near_dup_strict", 0.95)):
    ORACLES[name] = f"""WITH RECURSIVE {shingle_rows('documents', 'doc_id', 'text')}, {greedy(t)}
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM gone)"""
ORACLES["dedup_examples"] = f"""WITH RECURSIVE {PAIRS},
{shingle_rows('pairs', 'example_id', '''"user" || ' ' || assistant''')}, {greedy(0.95)}
SELECT example_id FROM pairs WHERE example_id NOT IN (SELECT id FROM gone)"""

# --- cleaning ---------------------------------------------------------------------

CLEAN = f"""{DOCS},
mu AS MATERIALIZED ({masked_steps('docs', '"user"', 'example_id')}),
ma AS MATERIALIZED ({masked_steps('docs', 'assistant', 'example_id')}),
clean AS MATERIALIZED (
  SELECT d.example_id, mu.m AS "user", ma.m AS assistant, d.category
  FROM docs d JOIN mu USING (example_id) JOIN ma USING (example_id)),
{shingle_rows('clean', 'example_id', '''"user" || ' ' || assistant''')}, {greedy(0.95)},
uniq AS (SELECT * FROM clean WHERE example_id NOT IN (SELECT id FROM gone)),
kept AS MATERIALIZED (SELECT * FROM uniq WHERE {score()} >= 0.9::DOUBLE)"""
ORACLES["clean_funnel"] = f"""WITH RECURSIVE {CLEAN}
SELECT 'original_count' AS stage, count(*) AS n FROM docs
UNION ALL SELECT 'after_pii_masking', count(*) FROM clean
UNION ALL SELECT 'after_deduplication', count(*) FROM uniq
UNION ALL SELECT 'after_quality_filtering', count(*) FROM kept"""
ORACLES["clean_examples"] = f"""WITH RECURSIVE {CLEAN} SELECT example_id, "user", assistant, category FROM kept"""
ORACLES["retention_rate"] = f"""WITH {DOCS},
mu AS MATERIALIZED ({masked_steps('docs', '"user"', 'example_id')}),
ma AS MATERIALIZED ({masked_steps('docs', 'assistant', 'example_id')}),
clean AS (SELECT mu.m AS "user", ma.m AS assistant FROM mu JOIN ma USING (example_id))
SELECT round(100.0::DOUBLE * count(*) FILTER ({score()} >= 0.9::DOUBLE) / count(*), 6) AS retention_rate FROM clean"""

# --- chat format ------------------------------------------------------------------

NL = "chr(10)"


def block(role, content) -> str:
    return f"'<|im_start|>' || {role} || {NL} || {content} || {NL} || '<|im_end|>'"


SYSTEM = block("'system'", lit(fixed.SYSTEM_PROMPT))
OPEN = f"'<|im_start|>assistant' || {NL}"
CHAT = f"""{SYSTEM} || {NL} || {block("'user'", '"user"')} || {NL} || {block("'assistant'", 'assistant')}"""
PROMPT = f"""{SYSTEM} || {NL} || {block("'user'", '"user"')} || {NL} || {OPEN}"""
ORACLES["chatml_pairs"] = f"WITH {PAIRS} SELECT example_id, {CHAT} AS text FROM pairs"
ORACLES["prompt_only"] = f"WITH {PAIRS} SELECT example_id, {PROMPT} AS prompt FROM pairs"
ORACLES["chatml_multiturn"] = f"""
SELECT conv_id, concat_ws({NL}, {SYSTEM},
  string_agg(CASE WHEN role <> 'system' THEN {block('role', 'text')} END, {NL} ORDER BY turn), {OPEN}) AS prompt
FROM conversations GROUP BY conv_id"""
ORACLES["text_records"] = f"WITH {PAIRS} SELECT example_id, {CHAT} AS text, category FROM pairs"

# --- splits and preference pairs ---------------------------------------------------


def split_of(source, key) -> str:
    return f"""(SELECT *, CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train'
    WHEN r <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || {key}), {key}) AS r, count(*) OVER () AS n FROM {source}))"""


REJECTED = lits(fixed.REJECTED_ANSWERS.values())


def preference(source, seed, extra="") -> str:
    return f"""SELECT example_id{extra}, {PROMPT} AS prompt, assistant || {NL} || '<|im_end|>' AS chosen,
  {REJECTED}[1 + {pick(8, seed, 'example_id')}] || {NL} || '<|im_end|>' AS rejected, category FROM {source}"""


ORACLES["exact_split"] = f"SELECT doc_id, split FROM {split_of('documents', 'doc_id')}"
ORACLES["split_summary"] = f"""WITH {PAIRS}, s AS (SELECT * FROM {split_of('pairs', 'example_id')})
SELECT split, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM s), 6) AS percent FROM s GROUP BY split"""
ORACLES["preference_pairs"] = f"WITH {PAIRS} {preference('pairs', '42')}"
ORACLES["preference_splits"] = f"""WITH {PAIRS}, s AS (SELECT * FROM {split_of('pairs', 'example_id')})
{preference("s WHERE split <> 'test'", "CASE WHEN split = 'train' THEN '42' ELSE '43' END", ', split')}"""

# --- filled templates ---------------------------------------------------------------


#: Slots that the candidate tables fill themselves.
GIVEN = ["customer", "nation", "segment"]


def filled(source, seed, key="candidate", options=templates.TEMPLATES) -> str:
    """``key, category, user, assistant`` from ``key, category`` and the given slots."""
    parts = [f"'{seed}'", "category", key]
    given = ", ".join(GIVEN)
    rows = ", ".join(
        f"({lit(c)}, {i}, {len(pairs)}, {lit(u)}, {lit(a)})"
        for c, pairs in options.items()
        for i, (u, a) in enumerate(pairs)
    )
    draw = pick("t.options", f"'{seed}'", "c.category", f"c.{key}", "'template'")
    sql = f"""SELECT c.*, t.u, t.a FROM {source} c
      JOIN (VALUES {rows}) t(category, i, options, u, a) ON t.category = c.category AND t.i = {draw}"""
    for slot, pool in templates.POOLS.items():
        if slot in GIVEN:
            value = slot
        elif isinstance(pool, templates.Numbered):
            value = f"{lit(pool.prefix)} || lpad(({pick(pool.count, *parts, lit(slot))} + {pool.first})::VARCHAR, 6, '0')"
        else:
            value = f"{lits(pool)}[1 + {pick(len(pool), *parts, lit(slot))}]"
        hole = "{" + slot + "}"
        sql = f"SELECT {key}, category, {given}, replace(u, '{hole}', {value}) AS u, replace(a, '{hole}', {value}) AS a FROM ({sql})"
    return f'SELECT {key}, category, u AS "user", a AS assistant FROM ({sql})'


SLOTS = "c_name AS customer, c_mktsegment AS segment, n_name AS nation"
ORDERS = f"""
cand AS (SELECT o_orderkey AS candidate, {category('o_orderkey')} AS category, {SLOTS}
         FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
filled AS MATERIALIZED ({filled('cand', 42)})"""


def answers(name, seed) -> str:
    return f"{name} AS MATERIALIZED ({filled('cust', seed, 'example_id')})"


CUSTOMERS = f"""
cust AS (SELECT c_custkey AS example_id, {category('c_custkey')} AS category, {SLOTS}
         FROM customer JOIN nation ON n_nationkey = c_nationkey),
{answers('ref', 42)}"""

ORACLES["template_examples"] = f"WITH {ORDERS} SELECT * FROM filled"
ORACLES["unique_openings"] = f"""WITH {ORDERS}
SELECT min(candidate) AS candidate, left("user", 80) AS opening FROM filled GROUP BY 2"""
ORACLES["generation_stats"] = f"""WITH {ORDERS},
firsts AS (SELECT category, CASE WHEN candidate % 5 < 4 THEN 'template' ELSE 'unknown' END AS source
  FROM filled WHERE candidate IN (SELECT min(candidate) FROM filled GROUP BY left("user", 80)))
SELECT 'category' AS kind, category AS name, count(*) AS n FROM firsts GROUP BY category
UNION ALL SELECT 'source', source, count(*) FROM firsts GROUP BY source"""


def counted(wanted) -> str:
    """The categories one after another, each without what those before have taken; ``wanted`` is SQL of
    a category's number of examples."""
    sql = ""
    for i, c in enumerate(fixed.CATEGORIES):
        before = " UNION ALL ".join(f"SELECT opening FROM taken{j}" for j in range(i)) or "SELECT NULL::VARCHAR AS opening WHERE false"
        sql += f""",
tried{i} AS (SELECT * FROM (SELECT candidate, left("user", 80) AS opening, row_number() OVER (ORDER BY candidate) AS r
  FROM filled WHERE category = {lit(c)}) WHERE r <= 5 * ({wanted(i)})),
new{i} AS (SELECT opening, min(candidate) AS candidate FROM tried{i}
  WHERE opening NOT IN ({before}) GROUP BY opening),
taken{i} AS MATERIALIZED (SELECT {lit(c)} AS category, * FROM (SELECT *, row_number() OVER (ORDER BY candidate) AS r FROM new{i})
  WHERE r <= ({wanted(i)}))"""
    union = " UNION ALL ".join(f"SELECT category, candidate FROM taken{i}" for i in range(len(fixed.CATEGORIES)))
    return f"{sql},\ncounted AS (SELECT f.* FROM filled f SEMI JOIN ({union}) t ON f.category = t.category AND f.candidate = t.candidate)"


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SHARED_ORDERS = ORDERS[: ORDERS.index("filled AS")] + f"filled AS MATERIALIZED ({filled('cand', 42, options=inputs.SHARED_TEMPLATES)})"
ORACLES["generate_counted"] = f"""WITH {SHARED_ORDERS}{counted(
    lambda i: f"SELECT count(*) * {3**i} FROM customer WHERE c_mktsegment = {lit(SEGMENTS[i])}")}
SELECT * FROM counted"""
ORACLES["generate_balanced"] = f"""WITH {SHARED_ORDERS}{counted(lambda i: "SELECT count(*) // 5 FROM customer")}
SELECT * FROM counted"""
ORACLES["generate_unbalanced"] = f"""WITH RECURSIVE
cand AS (SELECT o_orderkey * 5 + k AS candidate, {category('o_custkey')} AS category, {SLOTS}
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey, unnest(range(5)) u(k)),
filled AS MATERIALIZED ({filled('cand', 42, options=inputs.SHARED_TEMPLATES)}),
tries AS MATERIALIZED (SELECT candidate // 5 AS draw, candidate % 5 AS attempt, left("user", 80) AS opening FROM filled),
rounds AS (
  SELECT 0 AS round, draw, attempt, opening, true AS going FROM tries WHERE attempt = 0
  UNION ALL
  SELECT round, draw, attempt, opening, max(lost::INT) OVER () = 1 FROM (
    SELECT r.round + 1 AS round, r.draw, t.attempt, t.opening, r.lost
    FROM (SELECT *, draw <> min(draw) OVER (PARTITION BY opening) AS lost FROM rounds WHERE going AND attempt IS NOT NULL) r
    LEFT JOIN tries t ON t.draw = r.draw AND t.attempt = r.attempt + r.lost::INT)),
taken AS (SELECT draw, attempt FROM rounds WHERE round = (SELECT max(round) FROM rounds) AND attempt IS NOT NULL)
SELECT draw, attempt::INT AS attempt, category, "user", assistant
FROM taken JOIN filled ON candidate = draw * 5 + attempt"""
SUBJECTS = "CASE c " + " ".join(
    f"WHEN {lit(k)} THEN {lit(v)}" for k, v in fixed.REQUEST_SUBJECTS.items()
) + f" ELSE {lit(fixed.REQUEST_SUBJECTS['policy_inquiry'])} END"
ORACLES["request_prompts"] = f"""
SELECT c_custkey, {lit(fixed.REQUEST_HEAD)} || {SUBJECTS.replace('CASE c ', 'CASE lower(c_mktsegment) ')} || {lit(fixed.REQUEST_TAIL)} AS other,
  {lit(fixed.REQUEST_HEAD)} || {SUBJECTS} || {lit(fixed.REQUEST_TAIL)} AS prompt
FROM (SELECT *, {category('c_custkey')} AS c FROM customer)"""
ORACLES["completion_parse"] = f"""WITH {CUSTOMERS},
raw AS (SELECT example_id, category, CASE example_id % 5
    WHEN 0 THEN 'Here it is.' || {NL} || 'USER: ' || "user" || {NL} || 'AGENT: ' || assistant
    WHEN 1 THEN 'USER: ' || "user" || {NL} || 'AGENT: ' || assistant || {NL} || {NL} || {NL} || 'USER: more?'
    WHEN 2 THEN 'USER: ' || "user" || {NL} || 'AGENT: ' || assistant || {NL} || 'AGENT: short'
    WHEN 3 THEN 'USER: ' || "user" || ' ' || assistant
    ELSE 'USER: ' || "user" || {NL} || 'AGENT: ' || assistant || {NL} || 'USER: ' || "user" || {NL} || 'AGENT: ' || assistant END AS text FROM ref),
parts AS (SELECT example_id, category, {strip("string_split(string_split(text, 'USER:')[2], 'AGENT:')[1]")} AS u,
    {strip("string_split(text, 'AGENT:')[-1]")} AS a0 FROM raw WHERE contains(text, 'USER:') AND contains(text, 'AGENT:')),
cut1 AS (SELECT example_id, category, u, {strip("string_split(a0, 'USER:')[1]")} AS a1 FROM parts),
cut2 AS (SELECT example_id, category, u, {strip("string_split(a1, chr(10) || chr(10) || chr(10))[1]")} AS a FROM cut1)
SELECT example_id, category, u AS "user", a AS assistant, 'model' AS source FROM cut2
WHERE length(u) > 10 AND length(u) < 500 AND length(a) > 10 AND length(a) < 800"""

COMPLETIONS = ORACLES["completion_parse"]
ORACLES["hybrid_mix"] = f"""WITH {SHARED_ORDERS}{counted(lambda i: "SELECT floor(count(*) * 0.8::DOUBLE)::BIGINT // 5 FROM customer")},
answered AS ({COMPLETIONS}),
size AS (SELECT count(*) AS n FROM customer),
placed AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY example_id) AS r FROM answered)
SELECT candidate * 5 + list_position({lits(fixed.CATEGORIES)}, category) - 1 AS example_id, "user", assistant, category, 'template' AS source FROM counted
UNION ALL SELECT -1 - example_id, "user", assistant, category, source FROM placed, size
WHERE r <= (n - floor(n * 0.8::DOUBLE)::BIGINT) // 5"""

# --- similarity metrics -------------------------------------------------------------


def gram_sql(n) -> str:
    return " || ' ' || ".join(f"ws[i + {k}]" for k in range(n))


def text_metrics(source) -> str:
    """CTEs ending in ``tm(id, rouge_1, rouge_2, bleu)`` from ``source(id, p, r)`` of
    token lists."""
    sides = " UNION ALL ".join(
        f"SELECT id, '{side}' AS side, {n} AS n, unnest(list_transform(range(1, len(ws) - {n - 2}), lambda i: {gram_sql(n)})) AS g "
        f"FROM (SELECT id, {side} AS ws FROM {source}) WHERE len(ws) >= {n}"
        for side in ("p", "r") for n in (1, 2, 3, 4)
    )
    f1 = lambda n: f"""CASE WHEN o{n} > 0 THEN 2.0::DOUBLE * (o{n}::DOUBLE / (np - {n - 1})) * (o{n}::DOUBLE / (nr - {n - 1}))
      / (o{n}::DOUBLE / (np - {n - 1}) + o{n}::DOUBLE / (nr - {n - 1})) ELSE 0.0::DOUBLE END"""
    logs = " + ".join(f"ln(o{n}::DOUBLE / (np - {n - 1}))" for n in (1, 2, 3, 4))
    return f"""
gr AS ({sides}),
cnt AS (SELECT id, n, g, count(*) FILTER (side = 'p') AS cp, count(*) FILTER (side = 'r') AS cr FROM gr GROUP BY id, n, g),
ov AS (SELECT id, {', '.join(f"coalesce(sum(least(cp, cr)) FILTER (n = {n}), 0) AS o{n}" for n in (1, 2, 3, 4))} FROM cnt GROUP BY id),
sized AS (SELECT s.id, len(p) AS np, len(r) AS nr, coalesce(o1, 0) AS o1, coalesce(o2, 0) AS o2, coalesce(o3, 0) AS o3, coalesce(o4, 0) AS o4
  FROM {source} s LEFT JOIN ov USING (id)),
tm AS MATERIALIZED (SELECT id, {f1(1)} AS rouge_1, {f1(2)} AS rouge_2,
  CASE WHEN o4 > 0 THEN least(1.0::DOUBLE, exp(1.0::DOUBLE - nr::DOUBLE / np)) * exp(({logs}) / 4) ELSE 0.0::DOUBLE END AS bleu FROM sized)"""


def lcs(source) -> str:
    """CTEs ending in ``lc(id, rouge_l)``: one dynamic-programming row per step, kept
    as a list that starts with zero."""
    return f"""
dp AS (
  SELECT id, p, r, 0 AS i, list_transform(range(0, len(r) + 1), lambda x: 0) AS d FROM {source}
  UNION ALL
  SELECT id, p, r, i + 1,
    list_reduce(list_transform(range(1, len(r) + 1), lambda j: CASE WHEN r[j] = p[i + 1] THEN d[j] + 1 ELSE d[j + 1] END),
      lambda acc, x: list_append(acc, greatest(acc[-1], x)), [0])
  FROM dp WHERE i < len(p) AND len(r) > 0),
lc AS MATERIALIZED (SELECT id, CASE WHEN d[-1] > 0 THEN 2.0::DOUBLE * (d[-1]::DOUBLE / len(p)) * (d[-1]::DOUBLE / len(r))
   / (d[-1]::DOUBLE / len(p) + d[-1]::DOUBLE / len(r)) ELSE 0.0::DOUBLE END AS rouge_l
  FROM dp WHERE i = len(p) OR len(r) = 0)"""


PAIR_TOKENS = f"""{PAIRS}, tok AS MATERIALIZED (SELECT example_id AS id, {words('"user"')} AS p, {words('assistant')} AS r FROM pairs)"""
ANSWER_TOKENS = f"""{CUSTOMERS}, {answers('pred', 43)},
tok AS MATERIALIZED (SELECT ref.example_id AS id, {words('pred.assistant')} AS p, {words('ref.assistant')} AS r FROM ref JOIN pred USING (example_id))"""
ORACLES["rouge_n"] = f"WITH {PAIR_TOKENS}, {text_metrics('tok')} SELECT id AS example_id, round(rouge_1, 6) AS rouge_1, round(rouge_2, 6) AS rouge_2 FROM tm"
ORACLES["rouge_l"] = f"WITH RECURSIVE {PAIR_TOKENS}, {lcs('tok')} SELECT id AS example_id, round(rouge_l, 6) AS rouge_l FROM lc"
ORACLES["bleu"] = f"WITH {ANSWER_TOKENS}, {text_metrics('tok')} SELECT id AS example_id, round(bleu, 6) AS bleu FROM tm"
ORACLES["rouge_all"] = f"""WITH RECURSIVE {ANSWER_TOKENS}, {text_metrics('tok')}, {lcs('tok')}
SELECT id AS example_id, round(rouge_1, 6) AS rouge_1, round(rouge_2, 6) AS rouge_2, round(rouge_l, 6) AS rouge_l FROM tm JOIN lc USING (id)"""

# --- task metrics -------------------------------------------------------------------


def keyword_list(category) -> str:
    return f"CASE {category} " + " ".join(
        f"WHEN {lit(c)} THEN {lits(k)}" for c, k in fixed.KEYWORDS.items()
    ) + " ELSE []::VARCHAR[] END"


def keyword_score(text, category) -> str:
    ks = keyword_list(category)
    return f"CASE WHEN len({ks}) = 0 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, len(list_filter({ks}, lambda k: contains(lower({text}), k)))::DOUBLE / 2) END"


def any_of(text, phrases) -> str:
    return f"(len(list_filter({lits(phrases)}, lambda k: contains(lower({text}), k))) > 0)"


def format_checks(text) -> dict:
    ws = words(text)
    return {
        "adequate_length": f"len({ws}) >= 20",
        "no_excessive_repetition": f"CASE WHEN len({ws}) > 0 THEN {most(ws)}::DOUBLE / len({ws}) < 0.15::DOUBLE END",
        "professional_tone": any_of(text, fixed.TONE_PHRASES),
        "has_closing": any_of(text, fixed.CLOSING_PHRASES),
        "no_placeholders": f"NOT {any_of(text, fixed.PLACEHOLDER_PHRASES)}",
    }


def format_score(text) -> str:
    checks = format_checks(text)
    passed = " + ".join(f"coalesce(({c})::INT, 0)" for c in checks.values())
    return f"({passed})::DOUBLE / (CASE WHEN len({words(text)}) > 0 THEN 5 ELSE 4 END)"


ORACLES["keyword_coverage"] = f"""WITH {CUSTOMERS}
SELECT example_id, {keyword_score('assistant', 'category')} AS score,
  array_to_string(list_filter({keyword_list('category')}, lambda k: contains(lower(assistant), k)), ',') AS found,
  array_to_string(list_filter({keyword_list('category')}, lambda k: NOT contains(lower(assistant), k)), ',') AS missing,
  len({keyword_list('category')})::INT AS total FROM ref"""
CHECKS = format_checks("assistant")
ORACLES["format_compliance"] = f"""WITH {CUSTOMERS}
SELECT example_id, round({format_score('assistant')}, 6) AS score, {', '.join(f'{c} AS {n}' for n, c in CHECKS.items())},
  ({' + '.join(f'coalesce(({c})::INT, 0)' for c in CHECKS.values())})::INT AS passed,
  (CASE WHEN len({words('assistant')}) > 0 THEN 5 ELSE 4 END)::INT AS total FROM ref"""

ALL_SCORES = ["rouge_1", "rouge_2", "rouge_l", "bleu", "keyword_coverage", "format_compliance"]
FEW_SCORES = ["rouge_l", "bleu", "keyword_coverage", "format_compliance"]


def scored(rows) -> str:
    """CTEs ending in ``sc(id, category, six scores)`` from ``ev(id, category, pt, rt)``."""
    return f"""ev AS MATERIALIZED ({rows}),
tok AS MATERIALIZED (SELECT id, {words('pt')} AS p, {words('rt')} AS r FROM ev),
{text_metrics('tok')}, {lcs('tok')},
sc AS MATERIALIZED (SELECT id, category, rouge_1, rouge_2, rouge_l, bleu, {keyword_score('pt', 'category')} AS keyword_coverage,
  {format_score('pt')} AS format_compliance FROM ev JOIN tm USING (id) JOIN lc USING (id))"""


def means(names) -> str:
    return ", ".join(f"round(avg({m}), 6) AS {m}" for m in names)


EVAL = scored("SELECT ref.example_id AS id, ref.category, pred.assistant AS pt, ref.assistant AS rt FROM ref JOIN pred USING (example_id)")
TWO = f"{CUSTOMERS}, {answers('pred', 43)}"
ORACLES["task_metrics_overall"] = f"WITH RECURSIVE {TWO}, {EVAL} SELECT {means(ALL_SCORES)}, count(*) AS num_examples FROM sc"
ORACLES["task_metrics_by_category"] = f"WITH RECURSIVE {TWO}, {EVAL} SELECT category, {means(FEW_SCORES)}, count(*) AS num_examples FROM sc GROUP BY category"
ORACLES["category_report"] = f"""WITH RECURSIVE {TWO}, {EVAL}
SELECT category, {', '.join(f'round(avg({m}), 4) AS {m}' for m in FEW_SCORES)}, count(*) AS num_examples FROM sc GROUP BY category ORDER BY category"""
ORACLES["self_eval"] = f"""WITH RECURSIVE {CUSTOMERS}, {scored("SELECT example_id AS id, category, assistant AS pt, assistant AS rt FROM ref")}
SELECT {means(ALL_SCORES)}, count(*) AS num_examples FROM sc"""
CONSTANT = scored(f"SELECT example_id AS id, category, {lit(fixed.GENERIC_ANSWER)} AS pt, assistant AS rt FROM ref")
ORACLES["constant_baseline"] = f"""WITH RECURSIVE {CUSTOMERS}, {CONSTANT}
SELECT category, CASE WHEN grouping(category) = 1 THEN 'overall' ELSE 'category' END AS level, {means(ALL_SCORES)}, count(*) AS num_examples
FROM sc GROUP BY ROLLUP (category)"""
ORACLES["json_document"] = ORACLES["constant_baseline"]
COMPARED = f"""{TWO}, {answers('tuned', 44)},
cmp AS MATERIALIZED (SELECT ref.example_id, ref."user", ref.category, ref.assistant AS reference,
  coalesce(pred.assistant, 'N/A') AS baseline_response,
  coalesce(CASE WHEN ref.example_id % 3 <> 0 THEN tuned.assistant END, 'N/A') AS finetuned_response
  FROM ref LEFT JOIN pred USING (example_id) LEFT JOIN tuned USING (example_id))"""
ORACLES["before_after_rows"] = f"WITH {COMPARED} SELECT * FROM cmp"
ORACLES["first_comparisons"] = f"WITH {COMPARED} SELECT * FROM cmp ORDER BY example_id LIMIT 5"
ORACLES["prediction_store"] = f"WITH {COMPARED} SELECT * FROM cmp"
BOTH = scored("""SELECT example_id * 2 AS id, category, baseline_response AS pt, reference AS rt FROM cmp
  UNION ALL SELECT example_id * 2 + 1, category, finetuned_response, reference FROM cmp""")
ORACLES["before_after"] = f"WITH RECURSIVE {COMPARED}, {BOTH}, " + f"""
mm AS (SELECT id % 2 AS m, {', '.join(f'avg({m}) AS {m}' for m in ALL_SCORES)} FROM sc GROUP BY 1),
b AS (SELECT * FROM mm WHERE m = 0), t AS (SELECT * FROM mm WHERE m = 1)
""" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(b.{m}, 6) AS baseline, round(t.{m}, 6) AS finetuned, round(t.{m} - b.{m}, 6) AS delta FROM b, t"
    for m in ALL_SCORES
)

ORACLES["before_after_by_category"] = f"WITH RECURSIVE {COMPARED}, {BOTH}, " + f"""
mm AS (SELECT id % 2 AS m, category, {', '.join(f'avg({m}) AS {m}' for m in FEW_SCORES)} FROM sc GROUP BY 1, 2),
b AS (SELECT * FROM mm WHERE m = 0), t AS (SELECT * FROM mm WHERE m = 1)
""" + " UNION ALL ".join(
    f"SELECT category, '{m}' AS metric, round(b.{m}, 6) AS baseline, round(t.{m}, 6) AS finetuned, round(t.{m} - b.{m}, 6) AS delta FROM b JOIN t USING (category)"
    for m in FEW_SCORES
)

# --- retention ----------------------------------------------------------------------

ORACLES["mc_prompts"] = f"""
SELECT c_custkey AS question_id, 'Question: Which nation is ' || c_name || ' from?' || {NL} ||
  'A) ' || n0.n_name || {NL} || 'B) ' || n1.n_name || {NL} || 'C) ' || n2.n_name || {NL} || 'D) ' || n3.n_name || {NL} || 'Answer:' AS prompt,
  (c_custkey % 4)::INT AS answer
FROM customer """ + " ".join(
    f"JOIN nation n{i} ON n{i}.n_nationkey = ((c_nationkey + ({i} - c_custkey % 4) * 6) % 25 + 25) % 25" for i in range(4)
)
def choice_list(first) -> str:
    starts = range(first, first + 32, 8)
    return "[" + ", ".join(f"list_max(embedding[{s}:{s + 7}])" for s in starts) + "]"


SCORES = f"""
sc AS (SELECT 'baseline' AS model, vec_id AS question_id, label, {choice_list(1)} AS s FROM embeddings
       UNION ALL SELECT 'finetuned', vec_id, label, {choice_list(33)} FROM embeddings),
pr AS (SELECT model, question_id, label, (list_position(s, list_max(s)) - 1)::INT AS predicted FROM sc),
de AS (SELECT model, question_id, ['A','B','C','D'][predicted + 1] AS predicted, ['A','B','C','D'][label % 4 + 1] AS correct_answer,
       predicted = label % 4 AS is_correct, label::VARCHAR AS category FROM pr),
ac AS (SELECT model, category, count(*) FILTER (is_correct) AS correct, count(*) AS total,
       count(*) FILTER (is_correct)::DOUBLE / count(*) AS accuracy FROM de GROUP BY model, category)"""
ORACLES["mc_predictions"] = f"WITH {SCORES} SELECT model, question_id, predicted FROM pr"
ORACLES["mc_details"] = f"""WITH {SCORES}
SELECT *, 'Which quarter of half a vector holds the largest number of ' || question_id || '?' AS question FROM de"""
ORACLES["mc_accuracy"] = f"WITH {SCORES} SELECT model, category, correct, total, round(accuracy, 6) AS accuracy FROM ac"
ORACLES["retention_compare"] = f"""WITH {SCORES}
SELECT category, round(coalesce(b.accuracy, 0), 6) AS baseline, round(coalesce(f.accuracy, 0), 6) AS finetuned,
  round(coalesce(b.accuracy, 0) - coalesce(f.accuracy, 0), 6) AS "drop"
FROM (SELECT * FROM ac WHERE model = 'baseline') b FULL JOIN (SELECT * FROM ac WHERE model = 'finetuned') f USING (category)"""
MESSAGES = "CASE severity " + " ".join(f"WHEN '{k}' THEN {lit(v)}" for k, v in fixed.SEVERITY_MESSAGES.items()) + " END"
ORACLES["forgetting"] = f"""WITH {SCORES},
o AS (SELECT count(*) FILTER (is_correct AND model = 'baseline')::DOUBLE / count(*) FILTER (model = 'baseline') AS b,
             count(*) FILTER (is_correct AND model = 'finetuned')::DOUBLE / count(*) FILTER (model = 'finetuned') AS f FROM de),
d AS (SELECT b, f, b - f AS a, CASE WHEN b > 0 THEN (b - f) / b ELSE 0 END AS r FROM o),
e AS (SELECT *, CASE WHEN r <= 0 THEN 'none' WHEN r < 0.05 THEN 'minimal' WHEN r < 0.10 THEN 'moderate' ELSE 'significant' END AS severity FROM d)
SELECT round(b, 6) AS baseline_accuracy, round(f, 6) AS finetuned_accuracy, round(a, 6) AS absolute_drop, round(r, 6) AS relative_drop,
  severity, {MESSAGES} AS message, r < 0.05 AS threshold_5pct FROM e"""

ORACLES["forgetting_levels"] = f"""WITH {SCORES},
o AS (SELECT lost, count(*) FILTER (is_correct)::DOUBLE / count(*) AS b, count(*) FILTER (is_correct AND question_id % 100 >= lost)::DOUBLE / count(*) AS f
  FROM de, (VALUES (0), (3), (8), (30)) l(lost) WHERE model = 'baseline' GROUP BY lost),
d AS (SELECT lost, b, f, b - f AS a, CASE WHEN b > 0 THEN (b - f) / b ELSE 0 END AS r FROM o),
e AS (SELECT *, CASE WHEN r <= 0 THEN 'none' WHEN r < 0.05 THEN 'minimal' WHEN r < 0.10 THEN 'moderate' ELSE 'significant' END AS severity FROM d)
SELECT lost, round(b, 6) AS baseline_accuracy, round(f, 6) AS finetuned_accuracy, round(a, 6) AS absolute_drop, round(r, 6) AS relative_drop,
  severity, {MESSAGES} AS message, r < 0.05 AS threshold_5pct FROM e"""
ORACLES["forgetting_report"] = f"""
SELECT NULL AS category, baseline_accuracy AS baseline, finetuned_accuracy AS finetuned, absolute_drop AS "drop", relative_drop, severity, message, threshold_5pct::VARCHAR AS threshold_5pct
FROM ({ORACLES['forgetting']})
UNION ALL SELECT category, baseline, finetuned, "drop", NULL, NULL, NULL, NULL FROM ({ORACLES['retention_compare']})"""
ORACLES["full_report"] = f"""
SELECT 'task_metrics' AS section, NULL AS category, metric, baseline, finetuned FROM ({ORACLES['before_after']})
UNION ALL SELECT 'task_metrics', category, metric, baseline, finetuned FROM ({ORACLES['before_after_by_category']})
UNION ALL SELECT 'forgetting', category, 'accuracy', baseline, finetuned FROM ({ORACLES['forgetting_report']})
UNION ALL SELECT 'comparisons', category, 'example_id', example_id::DOUBLE, NULL FROM ({ORACLES['first_comparisons']})"""

# --- logs ---------------------------------------------------------------------------

LOG = """
log AS MATERIALIZED (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step, ts, value FROM events)"""
ORACLES["loss_ema"] = f"""WITH RECURSIVE {LOG},
have AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS k FROM log WHERE value IS NOT NULL),
ema AS (SELECT run_id, step, k, value AS loss, value AS smoothed FROM have WHERE k = 1
  UNION ALL SELECT h.run_id, h.step, h.k, h.value, 0.9::DOUBLE * e.smoothed + (1 - 0.9::DOUBLE) * h.value
  FROM ema e JOIN have h ON h.run_id = e.run_id AND h.k = e.k + 1)
SELECT run_id, step, loss, round(smoothed, 6) AS smoothed FROM ema"""
ORACLES["run_throughput"] = f"""WITH {LOG},
t AS (SELECT run_id, step, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY run_id)))::DOUBLE / 1e6 AS elapsed,
      max(step) OVER (PARTITION BY run_id) AS goal FROM log),
r AS (SELECT *, CASE WHEN elapsed > 0 THEN step / elapsed ELSE 0.0::DOUBLE END AS rate FROM t)
SELECT run_id, step, round(elapsed, 6) AS elapsed, round(rate, 6) AS steps_per_second,
  round(CASE WHEN rate > 0 THEN (goal - step) / rate ELSE 0.0::DOUBLE END, 2) AS remaining FROM r"""
ORACLES["best_step"] = f"""WITH {LOG}
SELECT run_id, step AS best_step, value AS best_loss FROM log WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY value, step) = 1"""
ORACLES["new_bests"] = f"""WITH {LOG},
b AS (SELECT *, min(value) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM log WHERE value IS NOT NULL)
SELECT run_id, step, value AS eval_loss FROM b WHERE before IS NULL OR value < before"""
ORACLES["peak_gauge"] = f"""WITH {LOG}
SELECT run_id, step, value AS gauge, max(value) OVER (PARTITION BY run_id ORDER BY step) AS peak FROM log WHERE step % 5 = 0"""
REQUESTS = """
rq AS (SELECT event_id AS request_id, ts, event_type AS model, regexp_extract(props, '(\\d+)', 1)::INT AS prompt_tokens,
       floor(value * 7)::INT AS completion_tokens, value AS raw FROM events),
us AS (SELECT *, prompt_tokens + completion_tokens AS total_tokens, round(raw, 2) AS latency_seconds,
       CASE WHEN raw > 0 THEN round(completion_tokens / raw, 1) ELSE 0.0::DOUBLE END AS tokens_per_second FROM rq)"""
ORACLES["request_usage"] = f"""WITH {REQUESTS}
SELECT request_id, model, prompt_tokens, completion_tokens, latency_seconds, total_tokens, tokens_per_second FROM us"""
ORACLES["usage_rollup"] = f"""WITH {REQUESTS}
SELECT model, hour(ts)::INT AS hour, count(*) AS requests, sum(prompt_tokens)::BIGINT AS prompt_tokens,
  sum(completion_tokens)::BIGINT AS completion_tokens, sum(total_tokens)::BIGINT AS total_tokens,
  round(avg(latency_seconds), 6) AS mean_latency, round(avg(tokens_per_second), 6) AS mean_speed FROM us GROUP BY 1, 2"""

# --- files --------------------------------------------------------------------------

EXAMPLES = """SELECT example_id, "user", assistant, category, 'conversation' AS source FROM pairs"""
ORACLES["csv_round_trip"] = f"WITH {PAIRS} {EXAMPLES}"
ORACLES["json_round_trip"] = f"WITH {PAIRS} {EXAMPLES}"
ORACLES["json_directory"] = f"""WITH {PAIRS} SELECT example_id, "user", assistant, category, 'conversation' AS source,
  row_number() OVER (ORDER BY example_id) AS place FROM pairs"""
SPLIT = f"{PAIRS}, s AS (SELECT * FROM {split_of('pairs', 'example_id')})"
ORACLES["split_store"] = f"""WITH {SPLIT} SELECT example_id, "user", {CHAT} AS text, category FROM s WHERE split = 'train'"""
ORACLES["formatted_copy"] = f"""WITH {SPLIT} SELECT split, example_id, {CHAT} AS text, category FROM s"""
ORACLES["training_text"] = ORACLES["text_records"]
ORACLES["training_text_columnar"] = ORACLES["text_records"]
ORACLES["cleaned_store"] = ORACLES["clean_examples"]
ORACLES["preference_store"] = f"SELECT prompt, chosen, rejected FROM ({ORACLES['preference_pairs']})"
