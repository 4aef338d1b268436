"""Patterns, cleaning, ablations and style features on inline rows."""

import math
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stylograph.functions import patterns as P
from stylograph.functions import text as X
from stylograph.functions.style import FEATURES, style_features
from stylograph.operators import tfidf

TEXTS = [
    "",
    "x",
    "Great question! Let's see.\n\n---\n\nLet me know if you want more! 🚀\n",
    "<think>plan\nmore</think>### Answer\n\n**bold** and __under__ ~~gone~~ `code`",
    "* one\n* two\n\n1. **First**: a\n2) second\n• dot",
    "```c\n#include <stdio.h>\n```\n####### seven\n   ## three blanks",
    "| a | b |\n|---|---|\n| 1 | 2 |\n\n***\n___\n - - -",
    "The sum is $x^2$ and \\(y\\). Ok? Yes!  No.",
    "“Quoted” ‘single’ isn’t — long – short… done",
    "I'm sorry, but no.",
    "I can’t do that; Would you like another way?",
    "As Grok: gpt-4o, GPT 4, ChatGPT, chat gpt, OpenAI, open ai, o1-mini, xo1, x.ai, xAI, le  chat, éclaude",
    "deep seek DeepMind meta\u00a0ai Llama-3.3-70b qwen2.5-72B QwQ tongyi mistral gemınıs bard bombardment groK",
    "Écrit ½ à côté\u00a0fois\u2003deux\x1ctrois\x85quatre İstanbul ſtraße K",
    "a\r\nb\u2028c\n \n\t\nd",
    "Certainly! You and I, me and my friend. your You",
    "日本語のテキスト 123 ٣ x_y 🚀🚀 ☃",
]


def one(spark, column, texts=TEXTS, schema="t string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, " + schema)
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "pattern, flags",
    [
        (P.WORD, ""), (P.WORD_TOKEN, ""), (P.TERM_TOKEN, ""), (P.MD_FENCE, "m"), (P.MD_RULE, "m"),
        (P.MD_TABLE_RULE, "m"), (P.MD_HEADER, "m"), (P.MD_BULLET, "m"), (P.SENTENCE_END, ""),
        (P.ANY_NAME, "i"), (P.REFUSAL, "i"), (P.THINK_BLOCK, "is"), (P.VISIBLE_REASONING, "i"),
        (P.CODE_HINT, "i"), (P.OPENING_PRAISE, "i"), (P.CLOSING_OFFER, "i"), (P.LATEX, ""), (r"\s+", ""),
    ],
)
def test_patterns_mean_the_same_as_in_python(spark, pattern, flags):
    options = sum({"i": re.I, "m": re.M, "s": re.S}[f] for f in flags)
    want = [[m.group(0) for m in re.finditer(pattern, t, options)] for t in TEXTS]
    assert one(spark, X.find_all("t", pattern, flags)) == want


def test_strip_removes_every_unicode_blank(spark):
    texts = [b + t + b for t in ("a b", "", "é") for b in ("\u00a0 \n", "\x1c\x85", "\u2003\u3000\u1680")]
    assert one(spark, X.strip("t"), texts) == [t.strip() for t in texts]


def test_every_name_passes_the_cheap_test_first(spark):
    named = [bool(re.search(P.ANY_NAME, t, re.I)) for t in TEXTS]
    maybe = one(spark, X.may_hold_name("t"))
    assert all(m for m, n in zip(maybe, named) if n)
    assert one(spark, X.names_any("t")) == named
    assert one(spark, X.mask_terms("t")) == [re.sub(P.ANY_NAME, "[MODEL]", t, flags=re.I) for t in TEXTS]


def test_mask_examples(spark):
    texts = ["I am ChatGPT by OpenAI.", "Claude and gpt-4.1-mini", "a bombardment of bards", "Google and Meta stay"]
    assert one(spark, X.mask_terms("t"), texts) == [
        "I am [MODEL] by [MODEL].", "[MODEL] and [MODEL]", "a bombardment of bards", "Google and Meta stay",
    ]


def test_own_name_depends_on_the_label(spark):
    df = spark.createDataFrame(
        [("GPT", "as gpt-4o"), ("Claude", "as gpt-4o"), ("Claude", "Claude here"), ("Other", "Claude here")],
        "family string, t string",
    )
    got = [r[0] for r in df.select(X.names_own_label("t", "family")).collect()]
    assert got == [True, False, True, False]


def test_label_rules_in_order(spark):
    names = {
        "gpt-4.1": "GPT", "gpt-oss-120b": None, "chatgpt-4o-latest": "GPT", "o3-2025": "GPT",
        "claude-opus-4-thinking-16k": "Claude", "qwen3-235b-a22b": "Qwen", "QwQ-32B": "Qwen",
        "deepseek-r1-0528": "DeepSeek", "magistral-medium-2506": "Mistral", "mixtral-8x7b": "Mistral",
        "grok-3-mini-beta": "Grok", "gemma-3": None, "nemotron-llama": "Llama", "": None, None: None,
    }
    assert one(spark, X.label_by_pattern("t"), list(names)) == list(names.values())


def test_reasoning_models(spark):
    names = {
        "claude-opus-4-thinking-16k": True, "qwen3-235b-a22b-no-thinking": False, "qwen3-235b-a22b": True,
        "qwen3-235b-a22b-instruct": False, "o3-mini": True, "gpt-o3": False, "Magistral-medium": True, None: False,
    }
    assert one(spark, X.is_reasoning("t"), list(names)) == list(names.values())


def test_tokens(spark):
    assert one(spark, X.word_tokens("t"), ["Hi, you\n2 x_y!"]) == [["hi", ",", "you", "<nl>", "2", "x_y", "!"]]
    assert one(spark, X.char_tokens("t")) == [list(t) for t in TEXTS]


@pytest.mark.parametrize("variant", ["flatten_whitespace", "fixed_length_600", "lowercase", "normalize_punct", "none"])
def test_ablations_that_change_nothing_twice(spark, variant):
    ablate = X.ABLATIONS[variant]
    once = one(spark, ablate("t"))
    assert one(spark, ablate("t"), once) == once


def test_markdown_is_taken_out(spark):
    texts = ["# Title\n- **bold** a\n1. x_y", "```py\ncode\n```\nend", "| a |\n|---|\n| b |", "a\n\n---\n\nb"]
    assert one(spark, X.strip_markdown("t"), texts) == ["Title\nbold a\nxy", "\ncode\n\nend", "  a  \n\n  b  ", "a\n\nb"]


def test_punctuation_becomes_plain(spark):
    assert one(spark, X.normalize_punct("t"), ["“a” ‘b’ — – … 🚀☃"]) == ["\"a\" 'b' - - ... "]


def test_message_text_and_turns(spark):
    conv = "array<struct<role:string,content_text:string,content_parts:array<struct<type:string,text:string>>>>"
    user, parts = ("user", " hi ", None), ("assistant", None, [("text", "a"), ("image", "no"), (None, "b"), ("text", None)])
    talks = [[user, parts], [user], [parts, user], [user, parts, user], None, [user, ("assistant", None, None)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(talks)], f"i int, c {conv}").orderBy("i")
    got = df.select(X.is_single_turn("c"), X.turn_text("c", 0), X.turn_text("c", 1)).collect()
    assert [r[0] for r in got] == [True, False, False, False, False, True]
    assert (got[0][1], got[0][2], got[5][2]) == ("hi", "ab", "")


def test_nested_flag_finds_the_first_in_depth(spark):
    schema = T._parse_datatype_string(
        "struct<x:struct<score:string,math:boolean>,y:map<string,map<string,boolean>>,math:boolean>"
    )
    rows = [((("s", None), {"a": {"math": False}}, True),), ((("s", True), None, False),), (None,), ((("s", None), {}, None),)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("tags", schema)]))
    got = [r[0] for r in df.select(X.nested_flag("tags", schema, "math")).collect()]
    assert got == [False, True, None, None]
    assert X.nested_flag("tags", schema, "score") is not None


def test_style_features_by_hand(spark):
    text = "Great! **You** and I:\n\n- my “x” — (y)\n\n---\n| a |\nHappy to help."
    df = spark.createDataFrame([(text,)], "output string")
    f = style_features(df).first().asDict()
    nw, nc = 11, len(text)
    want = {
        "log_chars": math.log1p(nc), "log_words": math.log1p(nw), "avg_word_len": 28 / nw,
        "avg_sent_words": nw / 2, "ttr_first200": 1.0, "newlines_per_100w": 600 / nw, "blank_lines_per_100w": 200 / nw,
        "headers_per_100w": 0, "bullets_per_100w": 100 / nw, "bold_per_100w": 100 / nw, "code_fences": 0,
        "table_rows_per_100w": 100 / nw, "hr_count": 1, "latex": 0, "emoji_per_1kc": 0, "emdash_per_1kc": 1000 / nc,
        "endash_per_1kc": 0, "colon_per_1kc": 1000 / nc, "semicolon_per_1kc": 0, "exclam_per_1kc": 1000 / nc,
        "question_per_1kc": 0, "paren_per_1kc": 1000 / nc, "curly_quote_per_1kc": 2000 / nc, "opener_affirmation": 1,
        "ends_with_offer": 1, "first_person_per_100w": 200 / nw, "you_per_100w": 100 / nw,
    }
    assert list(want) == FEATURES
    assert {k: f[k] for k in want} == pytest.approx(want)


def test_style_of_empty_text(spark):
    f = style_features(spark.createDataFrame([("",)], "output string")).first().asDict()
    nonzero = {k for k in FEATURES if f[k]}
    assert nonzero == {"avg_sent_words", "blank_lines_per_100w"}


def test_ngrams(spark):
    texts = ["a  bc", "🚀x🚀", "", "z", "Hi you, hi"]
    flat = [re.sub(r"\s\s+", " ", t) for t in texts]
    want = [sorted(t[i : i + n] for n in range(2, 6) for i in range(len(t) - n + 1)) for t in flat]

    def grams(block, rows):
        df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
        return [sorted(r.g) for r in tfidf.with_terms(df, "t", block, "g").orderBy("i").collect()]

    assert grams(tfidf.CHARS, texts) == want
    words = grams(tfidf.WORDS, ["Hi you, hi", "", "x"])
    assert words == [sorted(["hi", "you", ",", "hi", "hi you", "you ,", ", hi"]), [], ["x"]]


def test_wall_clock_micros_ignore_the_zone(spark):
    df = spark.sql("select timestamp_ntz'2025-03-01 13:00:05.25' as t")
    micros = X.wall_micros("t")
    assert df.select(micros).first()[0] == 1740834005250000
    assert str(df.select(X.from_wall_micros(micros)).first()[0]) == "2025-03-01 13:00:05.250000"


def test_encoding_reads_its_texts_once(spark, tmp_path):
    """Every field and the vocabulary read one written table; each of them read and joined the documents before."""
    from checks import text as checks_text

    rows = [(i, f"some words of document {i}, again and again " * 4, f"src{i % 5}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(40).selectExpr("id AS event_id", "timestamp_ntz'2025-01-01 00:00:00' AS ts").write.parquet(f"{tmp_path}/events.parquet")
    out = checks_text.encode_fields(spark, str(tmp_path))
    assert not [f for f in out.inputFiles() if "documents.parquet" in f]
    assert out.count() == 120 and not out.filter("ids = '1'").count()
