"""Screening the text of edits with a rule set, and the records that come out of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editstream.functions import rulebook
from editstream.functions.columns import compute_once, present_only
from editstream.functions.rules import condition

# --- Fixed values: the scanned columns in order, and the length of the comment sample ---
TEXT_COLUMNS = ["comment", "parsed_comment", "title"]
SAMPLE_LENGTH = 500

Rules = list[dict]


def full_text(columns: list[str] = TEXT_COLUMNS) -> Column:
    return F.concat_ws(" ", *[F.nullif(F.col(name), F.lit("")) for name in columns])


def with_text(edits: DataFrame, columns: list[str] = TEXT_COLUMNS) -> DataFrame:
    """Add ``full_text`` and ``folded_text``, each built once per row for all rules."""
    edits = compute_once(edits, full_text=full_text(columns))
    return compute_once(edits, folded_text=F.lower("full_text"))


def _conditions(rules: Rules) -> dict[str, Column]:
    text, folded = F.col("full_text"), F.col("folded_text")
    return {rule["flag"]: condition(rule, text, folded) for rule in rules}


def flag_names(rules: Rules) -> Column:
    """The flags a text raises, in rule order; needs the columns of :func:`with_text`."""
    if not rules:
        return F.array().cast("array<string>")
    return present_only([F.when(c, F.lit(flag)) for flag, c in _conditions(rules).items()])


def flag_map(names: Column) -> Column:
    return F.map_from_arrays(names, F.array_repeat(F.lit(True), F.size(names)))


def with_flags(edits: DataFrame, rules: Rules, columns: list[str] = TEXT_COLUMNS) -> DataFrame:
    """Add ``flag_types`` and ``text_length`` to every row; a filter on them is not repeated."""
    if not rules:  # no text to fold for anyone
        length = F.char_length(full_text(columns)).cast("long")
        return edits.withColumns({"flag_types": flag_names(rules), "text_length": length})
    return (
        compute_once(with_text(edits, columns), flag_types=flag_names(rules))
        .withColumn("text_length", F.char_length("full_text").cast("long"))
        .drop("full_text", "folded_text")
    )


def flagged_only(edits: DataFrame, rules: Rules, columns: list[str] = TEXT_COLUMNS) -> DataFrame:
    """The rows that raise a flag, as :func:`with_flags` gives them."""
    return with_flags(edits, rules, columns).where(F.size("flag_types") > 0)


def rule_hits(edits: DataFrame, rule: dict, columns: list[str] = TEXT_COLUMNS) -> DataFrame:
    """The rows on which one rule fires."""
    hit = condition(rule, F.col("full_text"), F.col("folded_text"))
    return with_text(edits, columns).where(hit).drop("full_text", "folded_text")


def flagged_records(flagged: DataFrame, version: str, as_of: Column | None = None) -> DataFrame:
    """Rows with ``flag_types`` as records of the flagged table."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    names = F.col("flag_types")
    now = F.current_timestamp() if as_of is None else as_of
    return flagged.where(F.size(names) > 0).select(
        text("evt_id").alias("event_id"),
        F.lit(version).alias("rule_version"),
        now.alias("detection_timestamp"),
        text("dt_user").alias("timestamp"),
        text("user").alias("user"),
        text("title").alias("title"),
        text("domain").alias("domain"),
        F.coalesce(F.col("ns"), F.lit(0).cast("long")).alias("namespace"),
        text("type").alias("edit_type"),
        flag_map(names).alias("ai_flags"),
        F.struct(
            F.substring(text("comment"), 1, SAMPLE_LENGTH).alias("comment"),
            text("title").alias("title"),
            F.col("text_length").alias("text_length"),
        ).alias("content_sample"),
        F.struct(
            F.size(names).alias("total_flags"),
            names.alias("flag_types"),
            F.col("dt_server").alias("detected_at"),
            F.lit(version).alias("rule_version"),
        ).alias("detection_metadata"),
    )


def detect(
    edits: DataFrame, version: str = rulebook.LATEST_VERSION, as_of: Column | None = None
) -> DataFrame:
    """The flagged table of typed edits under a published rule version."""
    return flagged_records(flagged_only(edits, rulebook.RULE_SETS[version]), version, as_of)


def with_version_flags(edits: DataFrame, versions: dict[str, Rules]) -> DataFrame:
    """Add ``flags_by_version``: per version the flags it raises, from one pass over the text."""
    arrays = [
        F.struct(F.lit(version).alias("rule_version"), flag_names(rules).alias("flag_types"))
        for version, rules in versions.items()
    ]
    return (
        with_text(edits)
        .withColumn("flags_by_version", F.array(*arrays))
        .drop("full_text", "folded_text")
    )


def version_changes(edits: DataFrame, versions: dict[str, Rules]) -> DataFrame:
    """How often each flag is gained or lost from one version to the next.

    The events are counted by their combination of flag lists before anything is exploded, so
    what is shuffled is bounded by the combinations that occur, not by the events.
    """
    order = list(versions)
    steps = [
        F.struct(
            F.lit(old).alias("from_version"),
            F.lit(new).alias("to_version"),
            F.col("flags_by_version")[i]["flag_types"].alias("old_flags"),
            F.col("flags_by_version")[i + 1]["flag_types"].alias("new_flags"),
        )
        for i, (old, new) in enumerate(zip(order, order[1:]))
    ]
    combinations = (
        with_version_flags(edits, versions)
        .groupBy("flags_by_version")
        .agg(F.count("*").alias("events"))
        .select("events", F.inline(F.array(*steps)))
    )
    changes = combinations.select(
        "from_version",
        "to_version",
        "events",
        F.explode(
            F.concat(
                F.transform(
                    F.array_except("new_flags", "old_flags"),
                    lambda flag: F.struct(flag.alias("flag"), F.lit("gained").alias("change")),
                ),
                F.transform(
                    F.array_except("old_flags", "new_flags"),
                    lambda flag: F.struct(flag.alias("flag"), F.lit("lost").alias("change")),
                ),
            )
        ).alias("c"),
    )
    return changes.groupBy("from_version", "to_version", "c.flag", "c.change").agg(
        F.sum("events").alias("events")
    )
