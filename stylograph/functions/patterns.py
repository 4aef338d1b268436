r"""Patterns and word lists, and their translation to the JVM regex dialect.

The patterns are written with Unicode meaning in mind: ``\w`` is any letter, number or underscore,
``\s`` any Unicode blank, ``\d`` any decimal digit and ``\b`` the edge of a ``\w`` run.  Plain Java
regexes read these as ASCII, so :func:`java` spells them out.
"""

from __future__ import annotations

# ---- fixed values: labels, patterns and phrases that results depend on ----------------------------

FAMILIES = ["Claude", "DeepSeek", "GPT", "Gemini", "Grok", "Llama", "Mistral", "Qwen"]

# Model name -> family; the first match wins.  Names are lower-cased first.
FAMILY_RULES = [
    ("GPT", r"^(gpt-(?!oss)|chatgpt|o1|o3|o4)"),
    ("Claude", r"claude"),
    ("Gemini", r"gemini"),
    ("Llama", r"llama"),
    ("Qwen", r"qwen|qwq"),
    ("DeepSeek", r"deepseek"),
    ("Mistral", r"mistral|mixtral|magistral"),
    ("Grok", r"grok"),
]

REASONING_MODEL = r"(?<!no-)thinking|deepseek-r1|qwq|magistral|^o\d|grok-3-mini|qwen3-(235b-a22b|30b-a3b)$"

# Names that would give the answer away, by family.
NAME_PATTERNS = {
    "GPT": r"chat\s?gpt|gpt-?\d[\w.\-]*|\bgpt\b|open\s?ai|\bo[134](?:-mini)?\b",
    "Claude": r"\bclaude\b|anthropic",
    "Gemini": r"\bgemini\b|\bbard\b|deepmind",
    "Llama": r"\bllama[\w.\-]*|meta\s+ai",
    "Qwen": r"\bqwen[\w.\-]*|\bqwq\b|tongyi|alibaba\s+cloud",
    "DeepSeek": r"deep\s?seek",
    "Mistral": r"\bmistral\b|\bmagistral\b|le\s+chat",
    "Grok": r"\bgrok\b|\bxai\b|\bx\.ai\b",
}
MASK = "[MODEL]"

# Plain pieces of which every name above holds at least one, when lower-cased.  Searching for them
# is many times cheaper than the patterns; frequent pieces carry a pattern that confirms the find.
NAME_STEMS = {
    "gpt": None,
    "open": r"open\s?ai",
    "o1": r"\bo1", "o3": r"\bo3", "o4": r"\bo4",
    "claude": None, "anthropic": None,
    "gemini": None, "bard": r"\bbard\b", "deep": r"deepmind|deep\s?seek",
    "llama": None, "meta": r"meta\s+ai",
    "qwen": None, "qwq": None, "tongyi": None, "alibaba": None,
    "mistral": None, "magistral": None, "chat": r"le\s+chat",
    "grok": None, "xai": None, "x.ai": None,
}
# Letters outside ASCII that case-blind matching takes for i, s or k.
ODD_CASE_LETTERS = ["İ", "ı", "ſ", "\u212a"]

REFUSAL = (
    r"^\s*(?:I'm sorry|I am sorry|Sorry,|I can't|I cannot|I can’t|I won't"
    r"|I'm not able|I am not able|I'm unable)"
)
THINK_BLOCK = r"<think>.*?</think>"
VISIBLE_REASONING = r"<think>|</think>|^\s*(Thinking|Reasoning)\b"
CODE_HINT = (
    r"```|\bdef |\bclass |\bfunction\b|#include|\bSELECT\b|\bpython\b|\bjavascript\b|\bcode\b"
)

WORD = r"\w+"
WORD_TOKEN = r"\n|\w+|[^\w\s]"
TERM_TOKEN = r"\w+|[^\w\s]"

MD_FENCE = r"^```.*$"
MD_RULE = r"^\s*(?:-{3,}|\*{3,}|_{3,})\s*$"
MD_TABLE_RULE = r"^\s*\|?\s*:?-{2,}.*$"
MD_HEADER = r"^\s{0,3}#{1,6}\s*"
MD_BULLET = r"^\s*(?:[-*+•]|\d+[.)])\s+"
MD_EMPHASIS = r"(\*\*|__|\*|_|~~|`)"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F000}-\x{1F2FF}]"

SENTENCE_END = r"[.!?]+\s"
LATEX = r"\$[^$]+\$|\\\(|\\\["
OPENING_PRAISE = (
    r"^\s*(excellent|great|certainly|of course|sure|absolutely|okay|ok|alright|hello|hi|what a)\b"
)
CLOSING_OFFER = (
    r"(let me know|would you like|do you want|want me to|feel free|hope this helps|happy to help)[^\n]*$"
)
FIRST_PERSON = ["i", "i'm", "me", "my"]
SECOND_PERSON = ["you", "your"]

# Typographic sign -> plain sign.
PLAIN_PUNCTUATION = [
    ("—", "-"), ("–", "-"), ("…", "..."), ("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'"),
]

ENGLISH = ["English", "en"]
SPECIAL_TOKENS = ["<pad>", "<unk>", "<sep>"]
UNKNOWN_ID, SEPARATOR_ID, FIRST_FREE_ID = 1, 2, 3
FIELD_SEPARATOR = " <sep> "

# ---- translation ------------------------------------------------------------------------------

WORD_CHARS = r"\p{L}\p{N}_"
BLANK_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"
BLANK = f"[{BLANK_CHARS}]"

# Every character a Unicode-aware strip removes, for btrim.
STRIP_SET = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

_EDGE = f"(?:(?<![{WORD_CHARS}])(?=[{WORD_CHARS}])|(?<=[{WORD_CHARS}])(?![{WORD_CHARS}]))"


def _spell_out(pattern: str, edge: str) -> str:
    classes = {"w": WORD_CHARS, "s": BLANK_CHARS, "d": r"\p{Nd}"}
    out, in_class, chars = [], False, iter(pattern)
    for ch in chars:
        if ch == "\\":
            nxt = next(chars)
            if nxt in classes:
                body = classes[nxt]
                out.append(body if in_class else f"[{body}]")
            elif nxt == "b" and not in_class:
                out.append(edge)
            else:
                out.append(ch + nxt)
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
    return "".join(out)


def java(pattern: str, flags: str = "") -> str:
    r"""The pattern for Spark's regex functions; ``flags`` out of ``i`` (case), ``m`` (lines), ``s`` (dot-all).

    ``d`` is always on, so that only ``\n`` ends a line.
    """
    flags = flags.replace("i", "iu")
    return f"(?d{flags})" + _spell_out(pattern, _EDGE)


def re2(pattern: str, flags: str = "") -> str:
    """The same pattern for engines with RE2 syntax (no look-around), used by the SQL checks."""
    prefix = f"(?{flags})" if flags else ""
    return prefix + _spell_out(pattern, r"\b")


ANY_NAME = "|".join(f"(?:{p})" for p in NAME_PATTERNS.values())
