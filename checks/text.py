"""Tokens, vocabularies, TF-IDF, ablations and style features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from stylograph.functions import patterns as P
from stylograph.functions import text as X
from stylograph.functions.style import FEATURES, style_features
from stylograph.operators import tfidf, tokens
from stylograph.session import materialize

from . import views as V
from .registry import query

re2, quote = P.re2, V.quote


def _re(pattern: str, flags: str = "") -> str:
    return quote(re2(pattern, flags))


# ---- tokens -----------------------------------------------------------------------------------


def sql_word_tokens(text: str) -> str:
    return f"[CASE WHEN t = chr(10) THEN '<nl>' ELSE lower(t) END FOR t IN regexp_extract_all({text}, {_re(P.WORD_TOKEN)})]"


def sql_char_tokens(text: str) -> str:
    return f"[c FOR c IN string_split({text}, '') IF c <> '']"


SQL_TOKENS = {"word": sql_word_tokens, "char": sql_char_tokens}


@query(
    "word_tokens",
    f"""WITH {V.ANSWERS}, t AS (SELECT row_id, {sql_word_tokens('output')} AS tokens FROM answers)
    SELECT row_id, CAST(len(tokens) AS INT) AS n, coalesce(array_to_string(tokens, ' '), '') AS joined FROM t""",
)
def word_tokens(spark, sf):
    rows = V.answers(spark, sf).select("row_id", X.word_tokens("output").alias("tokens"))
    return rows.select("row_id", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("joined"))


@query(
    "char_tokens",
    f"""WITH {V.ANSWERS}, t AS (SELECT row_id, {sql_char_tokens('output')} AS tokens FROM answers)
    SELECT row_id, CAST(len(tokens) AS INT) AS n, coalesce(array_to_string(tokens, '|'), '') AS joined FROM t""",
)
def char_tokens(spark, sf):
    rows = V.answers(spark, sf).select("row_id", X.char_tokens("output").alias("tokens"))
    return rows.select("row_id", F.size("tokens").alias("n"), F.array_join("tokens", "|").alias("joined"))


def sql_vocab(name: str, source: str, text: str, level: str, size: int, freq: int) -> str:
    return f"""{name} AS (
      SELECT token, CAST(row_number() OVER (ORDER BY freq DESC, token) + {P.FIRST_FREE_ID - 1} AS INT) AS id, freq
      FROM (SELECT token, count(*) AS freq FROM (SELECT unnest({SQL_TOKENS[level](text)}) AS token FROM {source})
        GROUP BY token ORDER BY freq DESC, token LIMIT {size}) WHERE freq >= {freq})"""


@query(
    "build_vocab",
    f"""WITH {V.ANSWERS}, {sql_vocab('words', 'answers', 'output', 'word', 30000, 3)},
      {sql_vocab('chars', 'answers', 'output', 'char', 300, 5)}
    SELECT 'word' AS level, * FROM words UNION ALL SELECT 'char', * FROM chars""",
)
def build_vocab(spark, sf):
    rows = V.answers(spark, sf)
    both = [
        tokens.build_vocab(rows, "output", level, *tokens.LEVELS[level][:2]).select(
            F.lit(level).alias("level"), "token", "id", "freq"
        )
        for level in ("word", "char")
    ]
    return both[0].unionByName(both[1])


@query(
    "encode_tokens",
    f"""WITH {V.ANSWERS}, {sql_vocab('words', 'answers', 'output', 'word', 30000, 3)},
      t AS (SELECT row_id, {sql_word_tokens('output')}[1:400] AS tokens FROM answers),
      flat AS (SELECT row_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS place FROM t)
    SELECT t.row_id, coalesce(string_agg(CAST(coalesce(id, 1) AS VARCHAR), ',' ORDER BY place) FILTER (place IS NOT NULL), '') AS ids
    FROM t LEFT JOIN flat USING (row_id) LEFT JOIN words USING (token) GROUP BY t.row_id""",
)
def encode_tokens(spark, sf):
    rows = V.answers(spark, sf)
    vocab = tokens.build_vocab(rows, "output", "word", 30_000, 3)
    ids = tokens.encode_tokens(rows, "row_id", X.word_tokens("output"), vocab, 400)
    return ids.select("row_id", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))


def _sql_fields(mode: str) -> str:
    head = f"{sql_word_tokens('input')}[1:100]"
    if mode == "both":
        return f"{head} || [NULL] || {sql_word_tokens('output')}[1:(399 - len({head}))]"
    return f"{sql_word_tokens(mode)}[1:400]"


@query(
    "encode_fields",
    f"""WITH {V.ANSWERS}, fields AS (SELECT input || ' <sep> ' || output AS txt FROM answers),
      {sql_vocab('words', 'fields', 'txt', 'word', 30000, 3)},
      t AS ({' UNION ALL '.join(f"SELECT row_id, '{m}' AS mode, {_sql_fields(m)} AS tokens FROM answers" for m in ('input', 'output', 'both'))}),
      flat AS (SELECT row_id, mode, unnest(tokens) AS token, unnest(range(len(tokens))) AS place FROM t)
    SELECT t.row_id, t.mode, coalesce(string_agg(CAST(CASE WHEN token IS NULL THEN 2 ELSE coalesce(id, 1) END AS VARCHAR), ','
      ORDER BY place) FILTER (place IS NOT NULL), '1') AS ids
    FROM t LEFT JOIN flat USING (row_id, mode) LEFT JOIN words USING (token) GROUP BY t.row_id, t.mode""",
)
def encode_fields(spark, sf):
    # read by the vocabulary and by every field
    rows = materialize(V.answers(spark, sf).select("row_id", "input", "output"), "answers")
    fields = rows.select(X.field_view("both").alias("txt"))
    vocab = tokens.fixed_vocab(tokens.build_vocab(fields, "txt", "word", 30_000, 3))
    parts = [
        tokens.encode_fields(rows, "row_id", vocab, "word", m, 400).withColumn("mode", F.lit(m))
        for m in ("input", "output", "both")
    ]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select("row_id", "mode", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))


@query(
    "field_view",
    f"""WITH {V.ANSWERS} SELECT row_id, input AS input_view, output AS output_view,
      input || ' <sep> ' || output AS both_view FROM answers""",
)
def field_view(spark, sf):
    views = [X.field_view(m).alias(f"{m}_view") for m in ("input", "output", "both")]
    return V.answers(spark, sf).select("row_id", *views)


# ---- TF-IDF -----------------------------------------------------------------------------------

SQL_TERMS = {
    "word": f"""(SELECT row_id, fit, unnest(toks || [toks[i] || ' ' || toks[i + 1] FOR i IN range(1, len(toks))]) AS term
      FROM (SELECT row_id, fit, regexp_extract_all(lower(txt), {_re(P.TERM_TOKEN)}) AS toks FROM source))""",
    # n-grams by looking ahead from each character
    "char": f"""(SELECT row_id, fit, term FROM (
      SELECT row_id, fit, unnest([g || b, g || b || c, g || b || c || d, g || b || c || d || e]) AS term FROM (
        SELECT row_id, fit, g, lead(g, 1) OVER w AS b, lead(g, 2) OVER w AS c, lead(g, 3) OVER w AS d, lead(g, 4) OVER w AS e
        FROM (SELECT row_id, fit, unnest(gs) AS g, unnest(range(len(gs))) AS i FROM (
          SELECT row_id, fit, string_split(regexp_replace(txt, {_re(r"\s\s+")}, ' ', 'g'), '') AS gs FROM source))
        WINDOW w AS (PARTITION BY row_id ORDER BY i))) WHERE term IS NOT NULL)""",
}


def sql_tfidf(source: str, name: str, block: tfidf.Block) -> str:
    """CTEs name_counts, name_fitted and name (row_id, term, weight) over source(row_id, fit, txt)."""
    return f"""{name}_counts AS (SELECT row_id, fit, term, count(*) AS tf
        FROM {SQL_TERMS[block.name].replace('source', source)} GROUP BY ALL),
      {name}_fitted AS (
        SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
          SELECT term, count(*) AS df, sum(tf) AS total FROM {name}_counts WHERE fit GROUP BY term
          HAVING count(*) >= {block.min_df} ORDER BY total DESC, term LIMIT {block.max_terms}),
          (SELECT count(*) AS n FROM {source} WHERE fit)),
      {name} AS (
        SELECT row_id, '{block.name}' AS block, term, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS weight
        FROM (SELECT row_id, term, (1.0 + ln(tf)) * idf AS w FROM {name}_counts JOIN {name}_fitted USING (term)))"""


SOURCE = f"source AS (SELECT row_id, {V.sql_bucket(448, 'prompt_id')} < 7000 AS fit, output AS txt FROM answers)"
PER_TERM = "SELECT block, term, count(*) AS n, round(sum(weight), 4) AS total FROM {} GROUP BY ALL"


def _split_rows(spark, sf):
    from stylograph.operators.clean import assign_split

    rows = assign_split(V.answers(spark, sf)).select("row_id", "split", "output")
    # read by the fit, by the row count and by the weighing
    return materialize(rows, "texts"), F.col("split") == "train"


def _per_term(weights):
    return weights.groupBy("block", "term").agg(
        F.count("*").alias("n"), F.round(F.sum("weight"), 4).alias("total")
    )


def _sql_one(block: tfidf.Block) -> str:
    return f"WITH {V.ANSWERS}, {SOURCE}, {sql_tfidf('source', 'w', block)} {PER_TERM.format('w')}"


@query("tfidf_word", _sql_one(tfidf.WORDS))
def tfidf_word(spark, sf):
    rows, fit = _split_rows(spark, sf)
    return _per_term(tfidf.tfidf(rows, "row_id", "output", (tfidf.WORDS,), fit))


@query("tfidf_char", _sql_one(tfidf.CHARS))
def tfidf_char(spark, sf):
    rows, fit = _split_rows(spark, sf)
    return _per_term(tfidf.tfidf(rows, "row_id", "output", (tfidf.CHARS,), fit))


@query(
    "stack_blocks",
    f"""WITH {V.ANSWERS}, {SOURCE}, {sql_tfidf('source', 'w', tfidf.WORDS)}, {sql_tfidf('source', 'c', tfidf.CHARS)},
      stacked AS (SELECT * FROM w UNION ALL SELECT * FROM c)
    SELECT row_id, block, count(*) AS n, round(sum(weight), 4) AS total, round(sum(weight * weight), 4) AS squares
    FROM stacked GROUP BY ALL""",
)
def stack_blocks(spark, sf):
    rows, fit = _split_rows(spark, sf)
    stacked = tfidf.stack_blocks(rows, "row_id", "output", fit)
    w = F.col("weight")
    return stacked.groupBy("row_id", "block").agg(
        F.count("*").alias("n"), F.round(F.sum(w), 4).alias("total"), F.round(F.sum(w * w), 4).alias("squares")
    )


# ---- ablations --------------------------------------------------------------------------------


def sql_strip_markdown(t: str) -> str:
    for p in (P.MD_FENCE, P.MD_RULE, P.MD_TABLE_RULE, P.MD_HEADER, P.MD_BULLET, P.MD_EMPHASIS):
        t = f"regexp_replace({t}, {_re(p, 'm')}, '', 'g')"
    return f"replace({t}, '|', ' ')"


def sql_normalize_punct(t: str) -> str:
    for a, b in P.PLAIN_PUNCTUATION:
        t = f"replace({t}, {quote(a)}, {quote(b)})"
    return f"regexp_replace({t}, {_re(P.EMOJI)}, '', 'g')"


def sql_flatten(t: str) -> str:
    return V.sql_strip(f"regexp_replace({t}, {_re(r'\s+')}, ' ', 'g')")


SQL_ABLATIONS = {
    "none": lambda t: t,
    "strip_markdown": sql_strip_markdown,
    "normalize_punct": sql_normalize_punct,
    "flatten_whitespace": sql_flatten,
    "fixed_length_600": lambda t: f"left({t}, 600)",
    "lowercase": lambda t: f"lower({t})",
    "all_structure_removed": lambda t: f"lower(left({sql_flatten(sql_normalize_punct(sql_strip_markdown(t)))}, 600))",
}


def _variant(name: str):
    if name == "no_masking":
        sql = f"WITH {V.CLEANED} SELECT row_id, output_raw AS output, input_raw AS input FROM cleaned"
    else:
        sql = f"WITH {V.CLEANED} SELECT row_id, {SQL_ABLATIONS[name]('output')} AS output, input FROM cleaned"

    @query(name, sql)
    def run(spark, sf):
        return X.ablate(V.cleaned(spark, sf), name).select("row_id", "output", "input")


for _name in X.VARIANTS:
    _variant(_name)


@query(
    "ablate",
    f"WITH {V.CLEANED} "
    + " UNION ALL ".join(
        f"SELECT row_id, family, '{v}' AS variant, {SQL_ABLATIONS[v]('output')} AS output, input FROM cleaned"
        for v in X.ABLATIONS
    )
    + " UNION ALL SELECT row_id, family, 'no_masking', output_raw, input_raw FROM cleaned",
)
def ablate(spark, sf):
    rows = V.cleaned(spark, sf).select("row_id", "family", "input", "output", "input_raw", "output_raw")
    return X.ablate_all(rows)


# ---- style ------------------------------------------------------------------------------------


def sql_style(source: str, text: str, keep: str) -> str:
    """CTE style(keep, 27 features) over source."""

    def lit(s: str) -> str:
        return f"((length(t) - length(replace(t, {quote(s)}, ''))) // {len(s)})"

    def hits(p: str, flags: str = "") -> str:
        return f"len(regexp_extract_all(t, {_re(p, flags)}))"

    def among(values: list[str]) -> str:
        return f"len([x FOR x IN words IF x IN ({', '.join(quote(v) for v in values)})])"

    blank = f"NOT regexp_matches(x, {_re(r'[^\s]')})"
    f = {
        "log_chars": "ln(1.0 + length(t))",
        "log_words": "ln(1.0 + len(words))",
        "avg_word_len": "coalesce(list_sum([length(x) FOR x IN raw]), 0) / nw",
        "avg_sent_words": f"nw / greatest(len([x FOR x IN string_split_regex(t, {_re(P.SENTENCE_END)}) IF NOT ({blank})]), 1)",
        "ttr_first200": "len(list_distinct(words[1:200])) / greatest(len(words[1:200]), 1)",
        "newlines_per_100w": "100.0 * (len(lines) - 1) / nw",
        "blank_lines_per_100w": f"100.0 * len([x FOR x IN lines IF {blank}]) / nw",
        "headers_per_100w": f"100.0 * {hits(P.MD_HEADER, 'm')} / nw",
        "bullets_per_100w": f"100.0 * {hits(P.MD_BULLET, 'm')} / nw",
        "bold_per_100w": f"100.0 * {lit('**')} / 2 / nw",
        "code_fences": f"{lit('```')} / 2.0",
        "table_rows_per_100w": f"100.0 * len([x FOR x IN lines IF starts_with({V.sql_strip('x')}, '|')]) / nw",
        "hr_count": f"CAST({hits(P.MD_RULE, 'm')} AS DOUBLE)",
        "latex": f"CAST(CAST(regexp_matches(t, {_re(P.LATEX)}) AS INT) AS DOUBLE)",
        "emoji_per_1kc": f"1000.0 * {hits(P.EMOJI)} / nc",
        **{
            f"{n}_per_1kc": f"1000.0 * {lit(s)} / nc"
            for n, s in [("emdash", "—"), ("endash", "–"), ("colon", ":"), ("semicolon", ";"),
                         ("exclam", "!"), ("question", "?"), ("paren", "(")]
        },
        "curly_quote_per_1kc": f"1000.0 * ({lit('“')} + {lit('”')} + {lit('’')}) / nc",
        "opener_affirmation": f"CAST(CAST(regexp_matches(t, {_re(P.OPENING_PRAISE, 'i')}) AS INT) AS DOUBLE)",
        "ends_with_offer": f"CAST(CAST(regexp_matches(right({V.sql_strip('t')}, 300), {_re(P.CLOSING_OFFER, 'i')}) AS INT) AS DOUBLE)",
        "first_person_per_100w": f"100.0 * {among(P.FIRST_PERSON)} / nw",
        "you_per_100w": f"100.0 * {among(P.SECOND_PERSON)} / nw",
    }
    columns = ", ".join(f"CAST({f[name]} AS DOUBLE) AS {name}" for name in FEATURES)
    return f"""style AS (
      SELECT {keep}, {columns} FROM (
        SELECT *, CAST(greatest(len(words), 1) AS DOUBLE) AS nw, CAST(greatest(length(t), 1) AS DOUBLE) AS nc FROM (
          SELECT {keep}, {text} AS t, [lower(x) FOR x IN regexp_extract_all({text}, {_re(P.WORD)})] AS words,
            regexp_extract_all({text}, {_re(P.WORD)}) AS raw, string_split({text}, chr(10)) AS lines FROM {source})))"""


@query(
    "style_features",
    f"WITH {V.ANSWERS}, {sql_style('answers', 'output', 'row_id')} SELECT row_id, "
    + ", ".join(f"round({n}, 4) AS {n}" for n in FEATURES)
    + " FROM style",
)
def style_features_query(spark, sf):
    rows = style_features(V.answers(spark, sf).select("row_id", "output"))
    return rows.select("row_id", *[F.round(n, 4).alias(n) for n in FEATURES])
