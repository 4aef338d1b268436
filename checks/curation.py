"""Sources, sinks and curation."""

from __future__ import annotations

from pyspark.sql import functions as F

from stylograph.functions import patterns as P
from stylograph.functions import text as X
from stylograph.functions.hashing import content_key
from stylograph.operators import curate
from stylograph.plans import prepare
from stylograph.session import new_path
from stylograph.sources import tables

from . import views as V
from .registry import query


# ---- sources and sinks ------------------------------------------------------------------------


@query(
    "scan_parquet",
    f"""WITH {V.ANSWERS}, known AS (
      SELECT unnest({V.sql_list(P.FAMILIES)}) AS family, unnest(range({len(P.FAMILIES)})) AS position)
    SELECT family, CAST(position AS INT) AS position FROM known WHERE family IN (SELECT family FROM answers)""",
)
def scan_parquet(spark, sf):
    return tables.known_labels(V.answers(spark, sf), P.FAMILIES)


@query(
    "scan_battles",
    f"""WITH {V.BATTLES} SELECT id, language, model_a, model_b, is_code,
      CAST(coalesce(len(conversation_a), -1) AS INT) AS turns_a,
      CAST(coalesce(len(conversation_b), -1) AS INT) AS turns_b,
      CAST(len(map_entries(category_tag)) AS INT) AS tags, epoch_us(timestamp) AS micros FROM battles""",
)
def scan_battles(spark, sf):
    path = new_path(spark, "battles")
    tables.sink_parquet(V.battles(spark, sf), path)
    battles = tables.scan_battles(spark, path)
    return battles.select(
        "id", "language", "model_a", "model_b", "is_code",
        F.coalesce(F.size("conversation_a"), F.lit(-1)).alias("turns_a"),
        F.coalesce(F.size("conversation_b"), F.lit(-1)).alias("turns_b"),
        F.size(F.map_entries("category_tag")).alias("tags"),
        X.wall_micros("timestamp").alias("micros"),
    )


LISTED = '[{"name": "x", "age": 3}]'  # a prompt that is a JSON list, as plain text


def _sql_said(place: int) -> str:
    said = V.sql_message_text(f"conversation_a[{place}]")
    return f"CASE WHEN conversation_a IS NOT NULL THEN {said} END"


@query(
    "scan_battles_raw",
    f"""WITH {V.BATTLES} SELECT id, model_a, CAST(coalesce(len(conversation_a), -1) AS INT) AS turns,
      conversation_a[1].role AS role, CASE WHEN id LIKE '%0' AND conversation_a IS NOT NULL THEN '{LISTED}' ELSE {_sql_said(1)} END AS asked,
      {_sql_said(2)} AS answered, is_code, {V.sql_flag('math')} AS math FROM battles""",
)
def scan_battles_raw(spark, sf):
    """Battles written as JSON lines, message content as a string or a list, and read back."""
    battles = V.battles(spark, sf)

    def plain(text):
        return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")

    def message(m, i):
        listed = F.coalesce(F.col("id").endswith("0"), F.lit(False)) & (i == 0)
        text = F.when(listed, F.lit(LISTED)).otherwise(m["content_text"])
        content = F.when(m["content_parts"].isNotNull(), F.to_json(m["content_parts"])).otherwise(plain(text))
        return F.concat(F.lit('{"role":'), plain(m["role"]), F.lit(',"content":'), content, F.lit("}"))

    talk = F.concat(F.lit("["), F.array_join(F.transform("conversation_a", message), ","), F.lit("]"))
    rest = F.to_json(F.struct("id", "model_a", "category_tag", "is_code"))
    line = F.concat(F.lit('{"conversation_a":'), F.coalesce(talk, F.lit("null")), F.lit(","), F.substr(rest, F.lit(2)))
    path = new_path(spark, "battles-raw")
    battles.select(line.alias("value")).write.text(path)
    read = tables.battles_from_raw_json(spark.read.text(path))
    first, second = F.get("conversation_a", F.lit(0)), F.get("conversation_a", F.lit(1))

    def said(m):
        text = X.message_text(m["content_text"], m["content_parts"])
        return F.when(F.col("conversation_a").isNotNull(), text)

    kind = read.schema["category_tag"].dataType
    return read.select(
        "id", "model_a", F.coalesce(F.size("conversation_a"), F.lit(-1)).alias("turns"), first["role"].alias("role"),
        said(first).alias("asked"), said(second).alias("answered"), "is_code",
        X.nested_flag("category_tag", kind, "math").alias("math"),
    )


@query(
    "inspect_source",
    f"""WITH {V.BATTLES}, both_sides AS (SELECT model_a AS model FROM battles UNION ALL SELECT model_b FROM battles)
    SELECT model, count(*) AS n FROM both_sides WHERE model IS NOT NULL GROUP BY model
    ORDER BY n DESC, model LIMIT 60""",
)
def inspect_source(spark, sf):
    return tables.inspect_source(V.battles(spark, sf))["models"]


@query("inspect_rows", f"WITH {V.BATTLES} SELECT count(*) AS rows FROM battles")
def inspect_rows(spark, sf):
    return tables.inspect_source(V.battles(spark, sf))["rows"]


@query("inspect_battles")
def inspect_battles(spark, sf):
    return tables.inspect_source(V.battles(spark, sf))["columns"]


DOCUMENT_COLUMNS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]


@query(
    "inspect_columns",
    "WITH f AS (SELECT * FROM documents ORDER BY doc_id LIMIT 1) "
    + " UNION ALL ".join(
        f"""SELECT {i}::INT AS position, '{c}' AS "column", '{t}' AS type, left(CAST({c} AS VARCHAR), 300) AS first_value FROM f"""
        for i, (c, t) in enumerate(DOCUMENT_COLUMNS)
    ),
)
def inspect_columns(spark, sf):
    return tables.inspect_columns(V.table(spark, sf, "documents"), first_by="doc_id")


@query("sink_parquet", f"WITH {V.ANSWERS} SELECT row_id, family, domain, input, output FROM answers")
def sink_parquet(spark, sf):
    path = new_path(spark, "rows")
    rows = V.answers(spark, sf).select("row_id", "family", "domain", "input", "output")
    tables.sink_parquet(rows, path)
    return tables.scan_parquet(spark, path, rows.columns)


@query(
    "sink_results",
    f"""WITH {V.ANSWERS} SELECT family, count(*) AS n, 'classes' AS experiment, 'small' AS tag
    FROM answers GROUP BY family""",
)
def sink_results(spark, sf):
    path = new_path(spark, "results")
    rows = V.answers(spark, sf)
    tables.sink_results(curate.class_counts(rows), path, "classes", "small")
    other = curate.class_counts(rows, "domain").withColumnRenamed("domain", "family")
    tables.sink_results(other, path, "classes")
    return tables.read_results(spark, path, "classes", "small").select("family", "n", "experiment", "tag")


# ---- filters, labels and keys -----------------------------------------------------------------


@query(
    "filter_language",
    f"""WITH {V.BATTLES} SELECT language, count(*) AS n FROM battles
    WHERE language IS NULL OR language IN ('English', 'en') GROUP BY language""",
)
def filter_language(spark, sf):
    kept = curate.filter_language(V.battles(spark, sf))
    return kept.groupBy("language").agg(F.count("*").alias("n"))


@query(
    "unpivot_sides",
    f"""WITH {V.SIDES} SELECT battle_id, side, model, CAST(coalesce(len(conversation), -1) AS INT) AS turns
    FROM sides""",
)
def unpivot_sides(spark, sf):
    sides = curate.unpivot_sides(V.battles(spark, sf))
    turns = F.coalesce(F.size("conversation"), F.lit(-1))
    return sides.select("battle_id", "side", "model", turns.alias("turns"))


@query(
    "label_by_pattern",
    f"""WITH {V.SIDES} SELECT model, {V.sql_family('model')} AS family, count(*) AS n FROM sides
    WHERE {V.sql_family('model')} IS NOT NULL GROUP BY ALL""",
)
def label_by_pattern(spark, sf):
    labelled = curate.label_families(curate.unpivot_sides(V.battles(spark, sf)))
    return labelled.groupBy("model", "family").agg(F.count("*").alias("n"))


@query(
    "flag_reasoning",
    f"""WITH {V.SIDES} SELECT model, {V.sql_reasoning('model')} AS is_reasoning, count(*) AS n
    FROM sides GROUP BY ALL""",
)
def flag_reasoning(spark, sf):
    sides = curate.unpivot_sides(V.battles(spark, sf))
    flagged = sides.select("model", X.is_reasoning("model").alias("is_reasoning"))
    return flagged.groupBy("model", "is_reasoning").agg(F.count("*").alias("n"))


@query(
    "message_text",
    f"""WITH {V.SIDES}, messages AS (SELECT battle_id, side, unnest(conversation) AS m FROM sides)
    SELECT battle_id, side, m.role AS role, {V.sql_message_text('m')} AS text FROM messages""",
)
def message_text(spark, sf):
    sides = curate.unpivot_sides(V.battles(spark, sf))
    messages = sides.select("battle_id", "side", F.explode("conversation").alias("m"))
    text = X.message_text("m.content_text", "m.content_parts")
    return messages.select("battle_id", "side", F.col("m.role").alias("role"), text.alias("text"))


@query(
    "single_turn_pair",
    f"""WITH {V.SIDES} SELECT battle_id, side, {V.sql_strip(V.sql_message_text('conversation[1]'))} AS input,
      {V.sql_strip(V.sql_message_text('conversation[2]'))} AS output FROM sides WHERE {V.PAIR_OK}""",
)
def single_turn_pair(spark, sf):
    pairs = curate.single_turn_pair(curate.unpivot_sides(V.battles(spark, sf)))
    return pairs.select("battle_id", "side", "input", "output")


@query(
    "single_turn_rows",
    f"""WITH c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn) AS t
      FROM conversations GROUP BY conv_id)
    SELECT conv_id, {V.sql_strip('t[1].text')} AS input, {V.sql_strip('t[2].text')} AS output FROM c
    WHERE len(t) = 2 AND t[1].role = 'user' AND t[2].role = 'assistant'""",
)
def single_turn_rows(spark, sf):
    turns = V.table(spark, sf, "conversations")
    return curate.turns_to_conversations(turns, "conv_id", "turn")


@query(
    "nested_flag",
    f"""WITH {V.BATTLES} SELECT {V.sql_flag('math')} AS math, {V.sql_flag('creative_writing')} AS creative,
      {V.sql_flag('complexity')} AS complexity, {V.sql_flag('absent')} AS absent, count(*) AS n
    FROM battles GROUP BY ALL""",
)
def nested_flag(spark, sf):
    battles = V.battles(spark, sf)
    tags = battles.schema["category_tag"].dataType
    names = {"math": "math", "creative": "creative_writing", "complexity": "complexity", "absent": "absent"}
    flags = battles.select(*[X.nested_flag("category_tag", tags, k).alias(n) for n, k in names.items()])
    return flags.groupBy(*names).agg(F.count("*").alias("n"))


@query(
    "derive_domain",
    f"WITH {V.ELIGIBLE} SELECT battle_id, side, domain FROM described",
)
def derive_domain(spark, sf):
    sides = curate.label_families(curate.unpivot_sides(curate.filter_language(V.battles(spark, sf))))
    rows = curate.describe_rows(curate.filter_lengths(curate.single_turn_pair(sides)))
    return rows.select("battle_id", "side", "domain")


@query(
    "filter_lengths",
    f"""WITH {V.ANSWERS} SELECT row_id, CAST(length(input) AS INT) AS input_chars,
      CAST(length(output) AS INT) AS output_chars
    FROM answers WHERE length(input) BETWEEN 10 AND 4000 AND length(output) BETWEEN 50 AND 8000""",
)
def filter_lengths(spark, sf):
    rows = curate.filter_lengths(V.answers(spark, sf))
    return rows.select(
        "row_id", F.length("input").alias("input_chars"), F.length("output").alias("output_chars")
    )


@query("content_key", "SELECT doc_id, substr(md5(text), 1, 16) AS prompt_id FROM documents")
def content_key_query(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", content_key("text").alias("prompt_id"))


@query(
    "row_id_fallback",
    f"""WITH {V.BATTLES} SELECT {V.SQL_BATTLE_KEY} AS battle_id, id IS NULL AS made FROM battles""",
)
def row_id_fallback(spark, sf):
    battles = V.battles(spark, sf)
    return battles.select(curate.battle_key(battles).alias("battle_id"), F.col("id").isNull().alias("made"))


@query(
    "dedup_exact",
    """SELECT doc_id, lang, text FROM documents
    QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1""",
)
def dedup_exact(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "lang", "text")
    return curate.dedup_exact(docs, ["lang", "text"], ["doc_id"])


# ---- balance and audit ------------------------------------------------------------------------


@query("class_counts", f"WITH {V.ANSWERS} SELECT family, count(*) AS n FROM answers GROUP BY family")
def class_counts(spark, sf):
    return curate.class_counts(V.answers(spark, sf))


@query(
    "min_class_filter",
    f"WITH {V.ANSWERS} SELECT lang, doc_id FROM documents WHERE lang IN (SELECT lang FROM documents GROUP BY lang HAVING count(*) >= 140)",
)
def min_class_filter(spark, sf):
    docs = V.table(spark, sf, "documents").select("lang", "doc_id")
    return curate.min_class_filter(docs, 140, "lang")


@query(
    "balanced_sample",
    f"""WITH counts AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang HAVING count(*) >= 20)
    SELECT doc_id, lang FROM documents SEMI JOIN counts USING (lang)
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {V.sql_digest(448, 'doc_id')}, CAST(doc_id AS VARCHAR))
      <= least(2000, (SELECT min(n) FROM counts))""",
)
def balanced_sample(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "lang")
    return curate.balanced_sample(docs, 2000, 448, "lang", ["doc_id"], minimum=20)


@query(
    "crosstab",
    f"""WITH {V.ANSWERS} SELECT family, {', '.join(f"count(*) FILTER (domain = '{d}') AS {d}" for d in V.DOMAINS)}
    FROM answers GROUP BY family""",
)
def crosstab(spark, sf):
    return curate.crosstab(V.answers(spark, sf), "family", "domain", V.DOMAINS)


@query(
    "distinct_per_group",
    f"WITH {V.ANSWERS} SELECT family, count(DISTINCT model) AS n FROM answers GROUP BY family",
)
def distinct_per_group(spark, sf):
    return curate.distinct_per_group(V.answers(spark, sf), "family", "model")


@query(
    "flag_share",
    f"""WITH {V.CLEANED} SELECT family, {', '.join(
        f"round_even(avg(CAST({c} AS INT)) * 1000, 0) / 1000 AS {c}"
        for c in ('is_reasoning', 'refusal', 'self_id', 'prompt_names_model'))}
    FROM cleaned GROUP BY family""",
)
def flag_share(spark, sf):
    flags = ["is_reasoning", "refusal", "self_id", "prompt_names_model"]
    return curate.flag_share(V.cleaned(spark, sf), flags, 3)


@query(
    "leak_audit",
    f"""WITH {V.ANSWERS} SELECT family, count(*) FILTER (regexp_matches(output,
      {V.quote(P.re2(P.VISIBLE_REASONING, 'i'))})) AS n FROM answers GROUP BY family""",
)
def leak_audit(spark, sf):
    return curate.leak_audit(V.answers(spark, sf))


@query(
    "pair_count",
    f"""WITH {V.ANSWERS} SELECT count(*) AS pairs FROM
      (SELECT prompt_id FROM answers GROUP BY prompt_id HAVING count(*) = 2)""",
)
def pair_count(spark, sf):
    return curate.pair_count(V.answers(spark, sf))


@query(
    "curate_eligible",
    f"""WITH {V.ELIGIBLE} SELECT prompt_id, battle_id, side, model, is_reasoning, family, domain,
      epoch_us(timestamp) AS micros, input, output FROM eligible""",
)
def curate_eligible(spark, sf):
    rows = prepare.eligible_rows(V.battles(spark, sf))
    return rows.withColumn("micros", X.wall_micros("timestamp")).drop("timestamp")


@query(
    "curate",
    f"""WITH {V.ELIGIBLE}, counts AS (SELECT family, count(*) AS n FROM eligible GROUP BY family HAVING count(*) >= 10)
    SELECT prompt_id, battle_id, model, is_reasoning, family, domain, epoch_us(timestamp) AS micros, input, output
    FROM eligible SEMI JOIN counts USING (family)
    QUALIFY row_number() OVER (PARTITION BY family ORDER BY {V.sql_digest(448, 'battle_id', 'side')},
      battle_id || '|' || side) <= least(2000, (SELECT min(n) FROM counts))""",
)
def curate_query(spark, sf):
    rows = prepare.curated_rows(V.battles(spark, sf), 2000, 10)
    return rows.withColumn("micros", X.wall_micros("timestamp")).drop("timestamp")
