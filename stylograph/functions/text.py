"""Text expressions: strip, tokens, message content, masking and ablations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import patterns as P

Text = Column | str


def _c(x: Text) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(text: Text) -> Column:
    """Both ends freed of every Unicode blank (``trim`` alone only removes spaces)."""
    return F.btrim(_c(text), F.lit(P.STRIP_SET))


def matches(text: Text, pattern: str, flags: str = "") -> Column:
    return _c(text).rlike(P.java(pattern, flags))


def replace_all(text: Text, pattern: str, by: str, flags: str = "") -> Column:
    return F.regexp_replace(_c(text), P.java(pattern, flags), by)


def count_matches(text: Text, pattern: str, flags: str = "") -> Column:
    return F.regexp_count(_c(text), F.lit(P.java(pattern, flags)))


def find_all(text: Text, pattern: str, flags: str = "") -> Column:
    return F.regexp_extract_all(_c(text), F.lit(P.java(pattern, flags)), F.lit(0))


def count_literal(text: Text, piece: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    t = _c(text)
    removed = F.length(t) - F.length(F.replace(t, F.lit(piece), F.lit("")))
    return (removed / F.lit(len(piece))).cast("int")


def wall_micros(ts: Text) -> Column:
    """Microseconds since 1970 as the clock on the wall shows them, with or without a time zone."""
    t = _c(ts).cast("timestamp_ntz")
    seconds = F.hour(t) * 3600 + F.minute(t) * 60
    part = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    return (days * 86_400 + seconds) * 1_000_000 + part


def from_wall_micros(micros: Text) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=(_c(micros) / F.lit(1_000_000)).cast("decimal(18,6)"))


# ---- conversations ----------------------------------------------------------------------------


def message_text(content_text: Text, content_parts: Text) -> Column:
    """Text of one message: the plain string, else its text parts joined, else ''.

    A part counts when its type is 'text' or missing; a part without text adds nothing.
    """
    kept = F.filter(_c(content_parts), lambda p: F.coalesce(p["type"], F.lit("text")) == "text")
    joined = F.array_join(F.transform(kept, lambda p: F.coalesce(p["text"], F.lit(""))), "")
    return F.coalesce(_c(content_text), joined, F.lit(""))


def is_single_turn(conversation: Text) -> Column:
    """True for exactly one user message followed by one assistant message."""
    c = _c(conversation)
    ok = (
        (F.size(c) == 2)
        & (F.get(c, F.lit(0))["role"] == "user")
        & (F.get(c, F.lit(1))["role"] == "assistant")
    )
    return F.coalesce(ok, F.lit(False))


def turn_text(conversation: Text, position: int) -> Column:
    m = F.get(_c(conversation), F.lit(position))
    return strip(message_text(m["content_text"], m["content_parts"]))


def nested_flag(tags: Text, data_type: T.DataType, key: str) -> Column:
    """First non-null boolean stored under ``key`` anywhere in a nested struct or map, depth first.

    The search is laid out from the column's type, so it runs as one expression without parsing.
    """
    hits = _flag_hits(_c(tags), data_type, key)
    if hits is None:
        return F.lit(None).cast("boolean")
    return F.get(F.filter(hits, lambda x: x.isNotNull()), F.lit(0))


def _flag_hits(value: Column, data_type: T.DataType, key: str) -> Column | None:
    none = F.array().cast("array<boolean>")
    if isinstance(data_type, T.StructType):
        found = []
        for f in data_type.fields:
            if f.name == key and isinstance(f.dataType, T.BooleanType):
                found.append(F.array(value[f.name]))
            else:
                inner = _flag_hits(value[f.name], f.dataType, key)
                if inner is not None:
                    found.append(inner)
        return F.coalesce(F.concat(*found), none) if found else None
    if isinstance(data_type, T.MapType):
        entries = F.map_entries(value)
        if isinstance(data_type.valueType, T.BooleanType):
            own = F.filter(entries, lambda e: e["key"] == key)
            return F.coalesce(F.transform(own, lambda e: e["value"]), none)
        if _flag_hits(F.lit(None), data_type.valueType, key) is None:
            return None
        inner = F.transform(entries, lambda e: _flag_hits(e["value"], data_type.valueType, key))
        return F.coalesce(F.flatten(inner), none)
    return None


# ---- labels -----------------------------------------------------------------------------------


def label_by_pattern(name: Text, rules: list[tuple[str, str]] = P.FAMILY_RULES) -> Column:
    """Label of the first rule whose pattern is found in the lower-cased name, else null."""
    lowered = F.lower(F.coalesce(_c(name), F.lit("")))
    out = None
    for label, pattern in rules:
        test = lowered.rlike(P.java(pattern))
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def is_reasoning(model: Text) -> Column:
    return matches(F.coalesce(_c(model), F.lit("")), P.REASONING_MODEL, "i")


def derive_domain(is_code: Text, math: Column, creative: Column, prompt: Text) -> Column:
    """code, math, creative_writing or general; an unknown code flag falls back on the prompt's words."""
    code = F.coalesce(_c(is_code), matches(prompt, P.CODE_HINT, "i"))
    return (
        F.when(code, "code")
        .when(F.coalesce(math, F.lit(False)), "math")
        .when(F.coalesce(creative, F.lit(False)), "creative_writing")
        .otherwise("general")
    )


# ---- cleaning ---------------------------------------------------------------------------------


def has_trace(text: Text) -> Column:
    return matches(text, P.THINK_BLOCK, "is")


def strip_traces(text: Text) -> Column:
    return strip(replace_all(text, P.THINK_BLOCK, "", "is"))


def is_refusal(text: Text) -> Column:
    return matches(text, P.REFUSAL, "i")


def may_hold_name(text: Text) -> Column:
    """False only where no name pattern can match: the cheap test in front of the costly patterns."""
    t = _c(text)
    low = F.lower(t)
    found = F.lit(False)
    for stem, confirm in P.NAME_STEMS.items():
        hit = low.contains(stem)
        found = found | (hit if confirm is None else hit & low.rlike(P.java(confirm)))
    for letter in P.ODD_CASE_LETTERS:
        found = found | t.contains(letter)
    return found


def names_own_label(text: Text, label: Text, maybe: Column | None = None) -> Column:
    """Does the text match the name pattern of its own label?

    ``maybe`` is a column already holding :func:`may_hold_name` of the text, here and below.
    """
    own = None
    for key, pattern in P.NAME_PATTERNS.items():
        test, hit = _c(label) == key, matches(text, pattern, "i")
        own = F.when(test, hit) if own is None else own.when(test, hit)
    return F.when(_maybe(text, maybe), F.coalesce(own, F.lit(False))).otherwise(F.lit(False))


def names_any(text: Text, maybe: Column | None = None) -> Column:
    """Does the text match the name pattern of any label?"""
    return F.when(_maybe(text, maybe), matches(text, P.ANY_NAME, "i")).otherwise(F.lit(False))


def mask_terms(text: Text, mask: str = P.MASK, maybe: Column | None = None) -> Column:
    """Every name replaced by the mask."""
    masked = replace_all(text, P.ANY_NAME, mask, "i")
    return F.when(_maybe(text, maybe), masked).otherwise(_c(text))


def _maybe(text: Text, known: Column | None) -> Column:
    return may_hold_name(text) if known is None else known


def shows_reasoning(text: Text) -> Column:
    return matches(text, P.VISIBLE_REASONING, "i")


# ---- tokens -----------------------------------------------------------------------------------


def word_tokens(text: Text) -> Column:
    """Words lower-cased, punctuation marks singly, each newline as ``<nl>``."""
    return F.transform(
        find_all(text, P.WORD_TOKEN), lambda t: F.when(t == "\n", F.lit("<nl>")).otherwise(F.lower(t))
    )


def char_tokens(text: Text) -> Column:
    # split('') would hand back one empty string for an empty text
    t = _c(text)
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, ""))


TOKENS = {"word": word_tokens, "char": char_tokens}


def field_view(mode: str, inp: Text = "input", out: Text = "output") -> Column:
    """Plain text of the chosen field: 'output', 'input' or both with a separator between."""
    if mode == "output":
        return _c(out)
    if mode == "input":
        return _c(inp)
    if mode == "both":
        return F.concat(_c(inp), F.lit(P.FIELD_SEPARATOR), _c(out))
    raise ValueError(f"unknown field {mode!r}")


# ---- ablations --------------------------------------------------------------------------------


def strip_markdown(text: Text) -> Column:
    """Fences, rules and table rules first, then headers, bullets and emphasis marks; pipes become blanks."""
    steps = [P.MD_FENCE, P.MD_RULE, P.MD_TABLE_RULE, P.MD_HEADER, P.MD_BULLET, P.MD_EMPHASIS]
    cleaned = reduce(lambda t, p: replace_all(t, p, "", "m"), steps, _c(text))
    return F.translate(cleaned, "|", " ")


def normalize_punct(text: Text) -> Column:
    plain = reduce(
        lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), P.PLAIN_PUNCTUATION, _c(text)
    )
    return replace_all(plain, P.EMOJI, "")


def flatten_whitespace(text: Text) -> Column:
    return strip(replace_all(text, r"\s+", " "))


def fixed_length(text: Text, n: int = 600) -> Column:
    return F.left(_c(text), F.lit(n))


def _all_structure_removed(text: Text) -> Column:
    return F.lower(fixed_length(flatten_whitespace(normalize_punct(strip_markdown(text)))))


ABLATIONS = {
    "none": _c,
    "strip_markdown": strip_markdown,
    "normalize_punct": normalize_punct,
    "flatten_whitespace": flatten_whitespace,
    "fixed_length_600": fixed_length,
    "lowercase": lambda t: F.lower(_c(t)),
    "all_structure_removed": _all_structure_removed,
}
VARIANTS = [*ABLATIONS, "no_masking"]


def ablate(df: DataFrame, variant: str) -> DataFrame:
    """One variant applied to the output; ``no_masking`` swaps in the raw input and output instead."""
    if variant == "no_masking":
        return df.withColumns({"output": F.col("output_raw"), "input": F.col("input_raw")})
    return df.withColumn("output", ABLATIONS[variant]("output"))


def ablate_all(df: DataFrame, variants: list[str] = VARIANTS) -> DataFrame:
    """Every row once per variant, in a single pass over the rows; adds the column ``variant``."""
    versions = []
    for v in variants:
        raw = v == "no_masking"
        versions.append(
            F.struct(
                F.lit(v).alias("variant"),
                F.col("input_raw" if raw else "input").alias("input"),
                F.col("output_raw") if raw else ABLATIONS[v]("output").alias("output"),
            )
        )
    versions = [s.cast("struct<variant:string,input:string,output:string>") for s in versions]
    rest = [c for c in df.columns if c not in ("input", "output", "input_raw", "output_raw")]
    return df.select(*rest, F.explode(F.array(*versions)).alias("v")).select(*rest, "v.*")
