"""Inputs of the checks: battles, answers and predictions derived from the given tables.

The given texts hold no markdown, names or refusals, so every document is dressed with one writing
habit chosen by its source.  Nothing is left out: each view covers its whole table.  The SQL text
of every view stands next to the DataFrame that builds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stylograph.functions import patterns as P
from stylograph.functions import text as X
from stylograph.functions.hashing import bucket, content_key
from stylograph.operators import clean
from stylograph.operators.skew import by_row

MODELS = [
    "gpt-4.1", "claude-opus-4-thinking-16k", "gemini-2.5-pro", "Llama-4-scout", "qwen3-235b-a22b",
    "deepseek-r1-0528", "mistral-medium", "grok-3", "chatgpt-4o-latest", "claude-sonnet-4",
    "gemini-2.0-flash", "llama-3.3-70b", "qwen3-235b-a22b-no-thinking", "deepseek-v3-0324",
    "magistral-medium-2506", "Grok-3-mini-beta", "gpt-oss-120b", "o3-2025-04-16", "gemma-3",
    "mixtral-8x7b",
]
# answers have a family, each of them
KNOWN = [m for m in MODELS if m not in ("gpt-oss-120b", "gemma-3")]
DOMAINS = ["code", "math", "creative_writing", "general"]

# (before, after) the text of a document
HABITS = [
    ("Great question! ", "\n\n---\n\nLet me know if you want more! 🚀"),
    ("<think>plan\nfirst</think>\n### Answer\n\n", ""),
    ("", "\n\n* item one\n* item two\n"),
    ("1. **First**: ", "\n2. **Second**: done"),
    ("```c\n#include <stdio.h>\n```\n", "\n## Notes\n"),
    ("| a | b |\n|---|---|\n| 1 | 2 |\n", ""),
    ("The sum is $x^2$ and \\(y\\). ", " — as shown – here…"),
    ("“Quoted” and ‘single’ isn’t it? ", ""),
    ("I'm sorry, but ", ""),
    ("I can’t do that; ", " Would you like another way?"),
    ("As Grok I think so, says x.ai and le chat. ", " Not gpt-4o nor Claude."),
    ("Écrit à côté ½ fois: ", "\n"),
    ("Certainly! You and I, me and my friend: ", "\n\nHope this helps your work"),
    ("  \n\tThinking about it, ", "  \n\n   "),
    ("• dot bullet\n+ plus\n__under__ ~~gone~~ `code`\n***\n", ""),
    ("Okay, ", "\n#nospace\n####### seven"),
]
NAMING = "Ask ChatGPT or Claude: "


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _source_no(source: str = "source") -> Column:
    return F.substring(source, 4, 9).cast("int")


def dressed(text: Column, doc_id: str = "doc_id", source: str = "source") -> Column:
    """The text with the habit of its source; every fourth round of sources stays plain."""
    habit = _source_no(source) % len(HABITS)
    plain = F.expr(f"({doc_id} div 20) % 4 = 3")
    around = F.concat(
        _pick([h[0] for h in HABITS], habit), text, _pick([h[1] for h in HABITS], habit)
    )
    return F.when(plain, text).otherwise(around)


def sql_dressed(text: str, doc_id: str = "doc_id", source: str = "source") -> str:
    habit = f"CAST(substr({source}, 4) AS INT) % {len(HABITS)} + 1"
    before, after = sql_list([h[0] for h in HABITS]), sql_list([h[1] for h in HABITS])
    return (
        f"CASE WHEN ({doc_id} // 20) % 4 = 3 THEN {text} "
        f"ELSE {before}[{habit}] || {text} || {after}[{habit}] END"
    )


def prompt(text: Column, doc_id: str = "doc_id") -> Column:
    naming = F.when(F.expr(f"({doc_id} div 20) % 7 = 0"), F.lit(NAMING)).otherwise(F.lit(""))
    return F.concat(naming, F.left(text, F.lit(60)))


def sql_prompt(text: str, doc_id: str = "doc_id") -> str:
    return f"CASE WHEN ({doc_id} // 20) % 7 = 0 THEN {quote(NAMING)} ELSE '' END || left({text}, 60)"


def sql_model(source: str = "source", models: list[str] = MODELS) -> str:
    return f"{sql_list(models)}[CAST(substr({source}, 4) AS INT) % {len(models)} + 1]"


def sql_family(model: str) -> str:
    m = f"lower(coalesce({model}, ''))"
    return f"""CASE
      WHEN (starts_with({m}, 'gpt-') AND NOT starts_with({m}, 'gpt-oss'))
        OR regexp_matches({m}, '^(chatgpt|o1|o3|o4)') THEN 'GPT'
      WHEN contains({m}, 'claude') THEN 'Claude' WHEN contains({m}, 'gemini') THEN 'Gemini'
      WHEN contains({m}, 'llama') THEN 'Llama' WHEN regexp_matches({m}, 'qwen|qwq') THEN 'Qwen'
      WHEN contains({m}, 'deepseek') THEN 'DeepSeek'
      WHEN regexp_matches({m}, 'mistral|mixtral|magistral') THEN 'Mistral'
      WHEN contains({m}, 'grok') THEN 'Grok' END"""


def sql_reasoning(model: str) -> str:
    # no look-behind there: 'no-thinking' is taken out first
    m = f"replace(lower(coalesce({model}, '')), 'no-thinking', '')"
    whole = f"lower(coalesce({model}, ''))"
    return (
        f"(contains({m}, 'thinking') OR regexp_matches({whole}, "
        r"'deepseek-r1|qwq|magistral|^o\d|grok-3-mini|qwen3-(235b-a22b|30b-a3b)$'))"
    )


def sql_strip(text: str) -> str:
    return f"trim({text}, {quote(P.STRIP_SET)})"


def sql_bucket(seed: int, *key: str, n: int = 10_000) -> str:
    joined = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in key)
    return f"(('0x' || substr(md5('{seed}|' || {joined}), 1, 8))::BIGINT % {n})"


def sql_digest(seed: int, *key: str) -> str:
    joined = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in key)
    return f"md5('{seed}|' || {joined})"


def sql_row_digest(*cols: str) -> str:
    parts = []
    for c in cols:
        parts.append(f"CAST(coalesce(length(CAST({c} AS VARCHAR)), -1) AS VARCHAR)")
        parts.append(f"coalesce(CAST({c} AS VARCHAR), '')")
    return "md5(" + " || chr(31) || ".join(parts) + ")"


# ---- answers: one row per document ------------------------------------------------------------


def answers(spark: SparkSession, sf: str) -> DataFrame:
    docs = by_row(table(spark, sf, "documents").select("doc_id", "text", "source"), "doc_id")
    events = table(spark, sf, "events").select("event_id", "ts")
    rows = docs.join(events, docs.doc_id == events.event_id)
    model = _pick(KNOWN, _source_no() % len(KNOWN))
    rows = rows.select(
        F.col("doc_id").alias("row_id"),
        model.alias("model"),
        _pick(DOMAINS, F.expr("(doc_id div 80) % 4")).alias("domain"),
        F.col("ts").alias("timestamp"),
        prompt(F.col("text")).alias("input"),
        dressed(F.expr("substring(text, 61)")).alias("output"),
    )
    return rows.withColumns(
        {"family": X.label_by_pattern("model"), "prompt_id": content_key("input"), "is_reasoning": X.is_reasoning("model")}
    )


ANSWERS = f"""answers AS (
  SELECT *, substr(md5(input), 1, 16) AS prompt_id, {sql_reasoning('model')} AS is_reasoning
  FROM (
    SELECT doc_id AS row_id, {sql_model(models=KNOWN)} AS model, {sql_family(sql_model(models=KNOWN))} AS family,
      {sql_list(DOMAINS)}[(doc_id // 80) % 4 + 1] AS domain, ts AS timestamp,
      {sql_prompt('text')} AS input, {sql_dressed('substr(text, 61)')} AS output
    FROM documents JOIN events ON event_id = doc_id
  )
)"""


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_texts(answers(spark, sf))


def _re(pattern: str, flags: str = "") -> str:
    return quote(P.re2(pattern, flags))


def sql_strip_traces(text: str) -> str:
    return sql_strip(f"regexp_replace({text}, {_re(P.THINK_BLOCK, 'is')}, '', 'g')")


def sql_mask(text: str) -> str:
    return f"regexp_replace({text}, {_re(P.ANY_NAME, 'i')}, {quote(P.MASK)}, 'g')"


def sql_self_id(text: str, label: str) -> str:
    branches = " ".join(
        f"WHEN {quote(k)} THEN regexp_matches({text}, {_re(p, 'i')})" for k, p in P.NAME_PATTERNS.items()
    )
    return f"CASE {label} {branches} ELSE false END"


CLEANED = f"""{ANSWERS}, cleaned AS (
  SELECT row_id, prompt_id, model, family, domain, timestamp, is_reasoning, output_raw, input_raw,
    regexp_matches(output_raw, {_re(P.REFUSAL, 'i')}) AS refusal,
    {sql_self_id('output_raw', 'family')} AS self_id,
    regexp_matches(input_raw, {_re(P.ANY_NAME, 'i')}) AS prompt_names_model,
    {sql_mask('input_raw')} AS input, {sql_mask('output_raw')} AS output
  FROM (SELECT *, {sql_strip_traces('output')} AS output_raw, {sql_strip('input')} AS input_raw FROM answers)
  WHERE length(output_raw) >= 20
)"""

SPLIT_CASE = (
    f"CASE WHEN {sql_bucket(448, 'prompt_id')} < 7000 THEN 'train' "
    f"WHEN {sql_bucket(448, 'prompt_id')} < 8500 THEN 'val' ELSE 'test' END"
)

# ---- battles: each document and the next answer the same prompt ----------------------------------


def battles(spark: SparkSession, sf: str) -> DataFrame:
    docs = by_row(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    events = table(spark, sf, "events").select(F.col("event_id").alias("k"), "ts")
    side_b = docs.select(
        (F.col("doc_id") - 1).alias("k"), F.col("source").alias("source_b"),
        dressed(F.col("text")).alias("response_b"),
    )
    side_a = docs.select(
        F.col("doc_id").alias("k"), "lang", "source", prompt(F.col("text")).alias("prompt"),
        dressed(F.col("text")).alias("response_a"),
    )
    pairs = side_a.join(side_b, "k").join(events, "k")
    k = F.col("k")

    def message(role: Column, text: Column, as_parts: Column) -> Column:
        parts = F.array(
            F.struct(F.lit("text").alias("type"), text.alias("text")),
            F.struct(F.lit("image").alias("type"), F.lit("pixels").alias("text")),
            F.struct(F.lit(None).cast("string").alias("type"), F.lit(" end").alias("text")),
        )
        return F.struct(
            role.alias("role"),
            F.when(~as_parts, text).alias("content_text"),
            F.when(as_parts, parts).alias("content_parts"),
        )

    def conversation(response: str) -> Column:
        plain = F.lit(False)
        first = F.when(k % 13 == 0, "system").otherwise("user")
        two = F.array(
            message(first, F.col("prompt"), plain),
            message(F.lit("assistant"), F.col(response), k % 5 == 0),
        )
        three = F.concat(two, F.array(message(F.lit("user"), F.lit("thanks"), plain)))
        return F.when(k % 17 == 0, None).when(k % 11 == 0, three).otherwise(two)

    language = F.when(F.col("lang") == "en", "English").when(F.col("lang") == "fr", "en").when(
        F.col("lang") == "de", "German"
    )
    tags = F.create_map(
        F.lit("criteria_v0.1"), F.create_map(F.lit("complexity"), k % 2 == 0),
        F.lit("creative_writing_v0.1"), F.create_map(F.lit("creative_writing"), k % 6 == 1),
        F.lit("math_v0.1"), F.create_map(F.lit("math"), F.when(k % 9 != 0, k % 4 == 1)),
    )
    model = lambda c: _pick(MODELS, _source_no(c) % len(MODELS))
    return pairs.select(
        F.when(k % 7 != 0, F.concat(F.lit("b"), k)).alias("id"),
        language.alias("language"),
        F.when(k % 23 != 0, model("source")).alias("model_a"),
        model("source_b").alias("model_b"),
        conversation("response_a").alias("conversation_a"),
        conversation("response_b").alias("conversation_b"),
        tags.alias("category_tag"),
        F.when(k % 3 != 0, k % 3 == 1).alias("is_code"),
        F.col("ts").alias("timestamp"),
    )


def _sql_message(role: str, text: str, as_parts: str) -> str:
    return (
        f"{{'role': {role}, 'content_text': CASE WHEN {as_parts} THEN NULL ELSE {text} END, "
        f"'content_parts': CASE WHEN {as_parts} THEN [{{'type': 'text', 'text': {text}}}, "
        f"{{'type': 'image', 'text': 'pixels'}}, {{'type': NULL, 'text': ' end'}}] ELSE NULL END}}"
    )


def _sql_conversation(response: str) -> str:
    first = _sql_message("CASE WHEN k % 13 = 0 THEN 'system' ELSE 'user' END", "prompt", "false")
    second = _sql_message("'assistant'", response, "k % 5 = 0")
    third = _sql_message("'user'", "'thanks'", "false")
    return (
        f"CASE WHEN k % 17 = 0 THEN NULL WHEN k % 11 = 0 THEN [{first}, {second}, {third}] "
        f"ELSE [{first}, {second}] END"
    )


BATTLES = f"""pairs AS (
  SELECT a.doc_id AS k, a.lang, a.source, b.source AS source_b, e.ts, {sql_prompt('a.text', 'a.doc_id')} AS prompt,
    {sql_dressed('a.text', 'a.doc_id', 'a.source')} AS response_a,
    {sql_dressed('b.text', 'b.doc_id', 'b.source')} AS response_b
  FROM documents a JOIN documents b ON b.doc_id - 1 = a.doc_id JOIN events e ON e.event_id = a.doc_id
), battles AS (
  SELECT CASE WHEN k % 7 <> 0 THEN 'b' || k END AS id,
    CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'en' WHEN 'de' THEN 'German' END AS language,
    CASE WHEN k % 23 <> 0 THEN {sql_model()} END AS model_a, {sql_model('source_b')} AS model_b,
    {_sql_conversation('response_a')} AS conversation_a, {_sql_conversation('response_b')} AS conversation_b,
    MAP {{'criteria_v0.1': MAP {{'complexity': k % 2 = 0}},
      'creative_writing_v0.1': MAP {{'creative_writing': k % 6 = 1}},
      'math_v0.1': MAP {{'math': CASE WHEN k % 9 <> 0 THEN k % 4 = 1 END}}}} AS category_tag,
    CASE WHEN k % 3 <> 0 THEN k % 3 = 1 END AS is_code, ts AS timestamp
  FROM pairs
)"""


def sql_message_text(m: str) -> str:
    return (
        f"coalesce({m}.content_text, array_to_string([coalesce(p.text, '') FOR p IN {m}.content_parts "
        f"IF coalesce(p.type, 'text') = 'text'], ''), '')"
    )


def sql_flag(key: str) -> str:
    inner = "flatten([[v.value for v in map_entries(e.value) if v.key = " + quote(key) + "] for e in map_entries(category_tag)])"
    return f"([x for x in {inner} if x is not null])[1]"


def _sql_talk(c: str) -> str:
    # an empty list joins to '' in Spark and to NULL here, and no conversation is empty
    return f"array_to_string([{sql_message_text('m')} FOR m IN {c}], chr(30))"


SQL_BATTLE_KEY = "coalesce(id, " + sql_row_digest(
    "language", "model_a", "model_b", "epoch_us(timestamp)",
    _sql_talk("conversation_a"), _sql_talk("conversation_b"),
) + ")"

SIDES = f"""{BATTLES}, sides AS (
  SELECT {SQL_BATTLE_KEY} AS battle_id, language, is_code, timestamp, {sql_flag('math')} AS math,
    {sql_flag('creative_writing')} AS creative, side, model, conversation
  FROM (
    SELECT *, 'a' AS side, model_a AS model, conversation_a AS conversation FROM battles
    UNION ALL SELECT *, 'b', model_b, conversation_b FROM battles
  )
)"""

PAIR_OK = (
    "coalesce(len(conversation) = 2 AND conversation[1].role = 'user' "
    "AND conversation[2].role = 'assistant', false)"
)

ELIGIBLE = f"""{SIDES}, turns AS (
  SELECT battle_id, side, is_code, timestamp, math, creative, model, {sql_family('model')} AS family,
    {sql_strip(sql_message_text('conversation[1]'))} AS input,
    {sql_strip(sql_message_text('conversation[2]'))} AS output
  FROM sides WHERE (language IS NULL OR language IN ('English', 'en')) AND {PAIR_OK}
), described AS (
  SELECT substr(md5(input), 1, 16) AS prompt_id, battle_id, side, model, {sql_reasoning('model')} AS is_reasoning,
    family, CASE WHEN coalesce(is_code, regexp_matches(input, {_re(P.CODE_HINT, 'i')})) THEN 'code'
      WHEN coalesce(math, false) THEN 'math' WHEN coalesce(creative, false) THEN 'creative_writing'
      ELSE 'general' END AS domain, timestamp, input, output
  FROM turns WHERE family IS NOT NULL AND length(input) BETWEEN 10 AND 4000 AND length(output) BETWEEN 50 AND 8000
), eligible AS (
  SELECT * FROM described
  QUALIFY row_number() OVER (PARTITION BY model, input, output ORDER BY battle_id, side) = 1
)"""

# ---- predictions: rule-based, for several runs ---------------------------------------------------

RUNS = [("linear", 0, 7500), ("linear", 1, 7300), ("linear", 2, 7400), ("trees", 0, 6100), ("trees", 1, 6000), ("trees", 2, 6200)]


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Every answer once per run: the true family for a share of the rows, else a hashed one."""
    rows = answers(spark, sf).select(
        "row_id", "prompt_id", "model", "domain", "is_reasoning", F.col("family").alias("true"),
        F.length("output").alias("length"), X.is_refusal("output").alias("refusal"),
    )
    runs = F.array(
        *[
            F.struct(F.lit(m).alias("kind"), F.lit(s).alias("seed"), F.lit(t).alias("_share"))
            for m, s, t in RUNS
        ]
    )
    rows = rows.select("*", F.explode(runs).alias("r")).select(*rows.columns, "r.*")
    draw = bucket(7, "kind", F.col("seed").cast("string"), F.col("row_id").cast("string"))
    rows = rows.withColumn("_draw", draw)
    pred = F.when(F.col("_draw") < F.col("_share"), F.col("true")).otherwise(
        _pick(P.FAMILIES, F.col("_draw") % 7)
    )
    return rows.withColumn("pred", pred).drop("_draw", "_share")


PREDICTIONS = f"""{ANSWERS}, predictions AS (
  SELECT * EXCLUDE (draw, share),
    CASE WHEN draw < share THEN "true" ELSE {sql_list(P.FAMILIES)}[draw % 7 + 1] END AS pred
  FROM (
    SELECT row_id, prompt_id, model, domain, is_reasoning, family AS "true", length(output) AS length,
      regexp_matches(output, {_re(P.REFUSAL, 'i')}) AS refusal, kind, seed, share,
      {sql_bucket(7, 'kind', 'seed', 'row_id')} AS draw
    FROM answers CROSS JOIN (VALUES {', '.join(f"('{m}', {s}, {t})" for m, s, t in RUNS)}) r(kind, seed, share)
  )
)"""
SQL_LABELS = "labels8 AS (SELECT unnest(" + sql_list(P.FAMILIES) + ") AS label)"
