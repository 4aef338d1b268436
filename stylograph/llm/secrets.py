"""Secret scans with multipart credential linking.

Strong patterns are reported wherever they stand.  Parts of a credential that mean little by
themselves (an account name, a short password, a random-looking string, an address of a service) are
reported only if a complementary part stands within ``SCOPE`` code points of the same text: a
secret beside an identifier or an endpoint, an identifier or an endpoint beside a secret.  The parts meet in an interval join on
(text, stretch of text), so a text with many parts costs its neighbours only.

A keyword also counts behind a prefix (``db_password``, ``MYSQL_PWD``), and a value is read whole, however long.

Nulls and empty texts have no spans; a null doc_id is kept.  Long texts are read whole.  Equal rows
are scanned and returned each.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import common as C
from .spans import Kind, digest, find, placed

SCOPE = 200  # code points between two parts of one credential

_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
_VALUE = r"[A-Za-z0-9+/_.=-]"

BASE = [
    Kind(
        "assign", _ASSIGN + _VALUE + "+", lambda t: t.rlike(r"(?i)passw|secret|token|api_?key"),
        lambda m: F.length(F.regexp_extract(m, f"^{_ASSIGN}({_VALUE}+)$", 1)) >= 12,
    ),
    Kind("access", r"AKIA[A-Z0-9]{14,}", lambda t: t.contains("AKIA")),
    Kind("hex", r"[0-9a-f]{16,}", lambda t: t.rlike(r"[0-9a-f]{16}")),
]
WEAK = [
    Kind(
        "account", r"(?i:(?:user|account)(?:_?name)?|login|client_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]{3,}+",
        lambda t: t.rlike(r"(?i)user|login|account|client"),
    ),
    Kind(
        "phrase", r"(?i:password|passwd|pass|pwd|secret|token|api_?key|key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=!-]{4,}+",
        lambda t: t.rlike(r"(?i)pass|pwd|secret|token|key"),
    ),
    Kind(
        "blob", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+={0,2}", lambda t: t.rlike(r"[A-Za-z0-9+/]{32}"),
        lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]"),
    ),
    Kind("endpoint", r"\b[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%:@/?&=-]{4,}+", lambda t: t.contains("://")),
]
KINDS = BASE + WEAK
NAMES = [k.name for k in KINDS]
# what a part is in a credential
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "account": "identifier", "phrase": "secret",
         "blob": "secret", "endpoint": "endpoint"}


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans (_row, kind, start, end) with a complementary part in scope that lies beside them."""
    secret = F.col("kind").isin([i for i, n in enumerate(NAMES) if ROLES[n] == "secret"])
    parts = spans.select("_row", "kind", "start", "end", secret.alias("secret"))
    # a long part lies in several stretches
    touched = F.sequence(F.expr(f"start div {scope}"), F.expr(f"end div {scope}"))
    weak = parts.filter(F.col("kind") >= len(BASE)).withColumn("stretch", F.explode(touched))
    reach = F.sequence(F.expr(f"greatest(start - {scope}, 0) div {scope}"), F.expr(f"(end + {scope}) div {scope}"))
    other = parts.select(
        F.col("_row").alias("o_row"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
        F.col("secret").alias("o_secret"), F.explode(reach).alias("o_stretch"),
    )
    gap = F.greatest("start", "o_start") - F.least("end", "o_end")
    # an overlap is the same text seen twice, not another part
    beside = (F.col("secret") != F.col("o_secret")) & (gap >= 0) & (gap <= scope)
    return weak.join(
        other, (F.col("_row") == F.col("o_row")) & (F.col("stretch") == F.col("o_stretch")) & beside, "left_semi"
    ).select("_row", "kind", "start", "end").distinct()


def not_told_twice(spans: DataFrame) -> DataFrame:
    """The spans without phrases that coincide with an assignment, which says the same."""
    assign, phrase = NAMES.index("assign"), NAMES.index("phrase")
    same = spans.filter(F.col("kind") == assign).select("_row", "start", "end", F.lit(phrase).alias("kind"))
    return spans.join(same, ["_row", "start", "end", "kind"], "left_anti")


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): every row of ``docs`` by number, and its strong and linked weak spans."""
    found = find(docs, text, list(keep), KINDS, "secret-pieces")
    spans = materialize(not_told_twice(placed(found, [], KINDS).drop("match")), "secret-parts")
    return found, spans.filter(F.col("kind") < len(BASE)).unionByName(linked(spans, scope))


def op6_secrets(spark, sf_dir):
    found, spans = scan(C.documents(spark, sf_dir).select("doc_id", "text"))
    return digest(found, spans, ["doc_id"], NAMES, len(BASE), ["start", "kind"])
