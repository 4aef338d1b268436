"""From raw paired conversations to labelled (prompt, response) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import patterns as P
from ..functions import text as X
from ..functions.hashing import content_key, row_digest, seeded_digest
from ..functions.stats import round_even
from .skew import flag_held, lookup_by_key, lowest_per_group

SEED = 448
ROW_KEY = ["battle_id", "side"]


def filter_language(battles: DataFrame, language: str = "language") -> DataFrame:
    """Keep English and unknown languages."""
    return battles.filter(F.col(language).isNull() | F.col(language).isin(P.ENGLISH))


def battle_key(battles: DataFrame) -> Column:
    """The battle's id; without one, a digest of its content (a running number would need one task)."""

    def talk(c: str) -> Column:
        said = F.transform(c, lambda m: X.message_text(m["content_text"], m["content_parts"]))
        return F.array_join(said, "\x1e")

    content = [F.col("language"), F.col("model_a"), F.col("model_b"), X.wall_micros("timestamp")]
    digest = row_digest(*content, talk("conversation_a"), talk("conversation_b"))
    return F.coalesce(F.col("id"), digest)


def unpivot_sides(battles: DataFrame) -> DataFrame:
    """One battle becomes two rows, side a and side b."""
    sides = [
        F.struct(
            F.lit(s).alias("side"),
            F.col(f"model_{s}").alias("model"),
            F.col(f"conversation_{s}").alias("conversation"),
        )
        for s in ("a", "b")
    ]
    tags = battles.schema["category_tag"].dataType
    battles = battles.select(
        battle_key(battles).alias("battle_id"),
        "language",
        "is_code",
        "timestamp",
        X.nested_flag("category_tag", tags, "math").alias("math"),
        X.nested_flag("category_tag", tags, "creative_writing").alias("creative"),
        F.explode(F.array(*sides)).alias("s"),
    )
    return battles.select(*[c for c in battles.columns if c != "s"], "s.*")


def label_families(sides: DataFrame) -> DataFrame:
    """Family by model name; rows of unknown families are dropped."""
    return sides.withColumn("family", X.label_by_pattern("model")).filter(F.col("family").isNotNull())


def single_turn_pair(sides: DataFrame) -> DataFrame:
    """Prompt and response of single-turn conversations; all others are dropped."""
    return sides.filter(X.is_single_turn("conversation")).withColumns(
        {"input": X.turn_text("conversation", 0), "output": X.turn_text("conversation", 1)}
    ).drop("conversation")


def turns_to_conversations(
    turns: DataFrame, key: str, position: str, role: str = "role", text: str = "text"
) -> DataFrame:
    """Single-turn pairs out of a table with one row per turn.

    Of two turns the first is the least and the second the greatest, so count, least and greatest of
    position and role are all that is aggregated; texts of the conversations that qualify are joined.
    """
    turn = F.struct(F.col(position).alias("at"), F.col(role).alias("role"))
    ends = turns.groupBy(key).agg(F.count("*").alias("_n"), F.min(turn).alias("_u"), F.max(turn).alias("_a"))
    ok = (F.col("_n") == 2) & (F.col("_u.role") == "user") & (F.col("_a.role") == "assistant")
    found = ends.filter(ok & (F.col("_u.at") < F.col("_a.at"))).select(
        F.col(key).alias("_key"), F.col("_u.at").alias("_first"), F.col("_a.at").alias("_last")
    )
    theirs = turns.select(F.col(key), F.col(position).alias("_at"), X.strip(text).alias("_text"))
    theirs = theirs.join(found, F.col(key) == F.col("_key"))
    asked = theirs.filter(F.col("_at") == F.col("_first")).select(key, F.col("_text").alias("input"))
    answered = theirs.filter(F.col("_at") == F.col("_last")).select(key, F.col("_text").alias("output"))
    return asked.join(answered, key)


def filter_lengths(
    rows: DataFrame, prompt: tuple[int, int] = (10, 4000), response: tuple[int, int] = (50, 8000)
) -> DataFrame:
    return rows.filter(F.length("input").between(*prompt) & F.length("output").between(*response))


def describe_rows(rows: DataFrame) -> DataFrame:
    """Adds prompt key, reasoning flag and domain, and lays out the curated columns."""
    return rows.select(
        content_key("input").alias("prompt_id"),
        "battle_id",
        "side",
        "model",
        X.is_reasoning("model").alias("is_reasoning"),
        "family",
        X.derive_domain("is_code", F.col("math"), F.col("creative"), "input").alias("domain"),
        "timestamp",
        "input",
        "output",
    )


def dedup_exact(rows: DataFrame, same: list[str], order: list[str]) -> DataFrame:
    """The first row, by ``order``, of every set of rows equal in ``same``.

    Only digests and order keys are aggregated, never texts.  Rows whose digest is not in the bitmap of repeated ones stay
    where they are; the others look theirs up, a digest with very many copies by broadcast.  Among rows equal in
    ``order`` too, one stays.
    """
    keyed = rows.select("*", row_digest(*same).alias("_digest"), row_digest(*order).alias("_order"))
    first = F.struct(*[F.col(c) for c in order], "_order")
    copies = keyed.groupBy("_digest").agg(F.count("*").alias("_copies"), F.min(first)["_order"].alias("_least"))
    repeated = copies.filter("_copies > 1")
    marked = flag_held(keyed, "_digest", repeated, "_met")
    once = marked.filter("not _met").select(*rows.columns)
    told = lookup_by_key(marked.filter("_met").drop("_met"), repeated, "_digest", "_copies", "_order")
    # of a set of copies only the least ones get here, so a set is one or a few rows
    least = told.filter(F.col("_copies").isNull() | (F.col("_order") == F.col("_least")))
    place = F.row_number().over(Window.partitionBy("_digest").orderBy("_order"))
    chosen = least.withColumn("_place", place).filter("_place = 1").select(*rows.columns)
    return once.unionByName(chosen)


def class_counts(rows: DataFrame, label: str = "family") -> DataFrame:
    return rows.groupBy(label).agg(F.count("*").alias("n"))


def min_class_filter(rows: DataFrame, minimum: int = 800, label: str = "family") -> DataFrame:
    """Rows of labels with at least ``minimum`` rows."""
    kept = class_counts(rows, label).filter(F.col("n") >= minimum)
    # one row per label
    return rows.join(F.broadcast(kept.select(label)), label, "left_semi")


def balanced_sample(
    rows: DataFrame, cap: int = 2000, seed: int = SEED, label: str = "family", key: list[str] = ROW_KEY,
    minimum: int = 0,
) -> DataFrame:
    """min(cap, smallest class) rows of every class, the same rows on every run.

    With ``minimum``, classes with fewer rows are left out first (as :func:`min_class_filter`, but
    sharing the one class count).
    """

    def wanted(totals: DataFrame) -> DataFrame:
        kept = totals.filter(F.col("total") >= minimum)
        smallest = kept.agg(F.least(F.min("total"), F.lit(cap)).alias("n"))
        return kept.select(label).crossJoin(F.broadcast(smallest))

    keyed = rows.withColumns({"_digest": seeded_digest(seed, *key), "_tie": F.concat_ws("|", *key)})
    return lowest_per_group(keyed, label, "_digest", "_tie", wanted).drop("_digest", "_tie")


def crosstab(rows: DataFrame, by: str, across: str, values: list[str]) -> DataFrame:
    """Counts of ``by`` x ``across``; absent cells are 0.  Known values save a pass over the data."""
    table = rows.groupBy(by).pivot(across, values).agg(F.count(F.lit(1)))
    return table.fillna(0, subset=values)


def distinct_per_group(rows: DataFrame, by: str, value: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count_distinct(value).alias("n"))


def flag_share(rows: DataFrame, flags: list[str], places: int, by: str = "family") -> DataFrame:
    """Share of rows with each flag set, by group."""
    shares = [round_even(F.avg(F.col(f).cast("int")), places).alias(f) for f in flags]
    return rows.groupBy(by).agg(*shares)


def leak_audit(rows: DataFrame, text: str = "output", by: str = "family") -> DataFrame:
    """Texts with visible reasoning, by group."""
    return rows.groupBy(by).agg(F.count_if(X.shows_reasoning(text)).alias("n"))


def pair_count(rows: DataFrame, key: str = "prompt_id") -> DataFrame:
    """Keys that occur in exactly two rows."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("n"))
    return sizes.filter(F.col("n") == 2).agg(F.count("*").alias("pairs"))
