"""The whole path of raw lines to the edit, dead-letter and flagged tables."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from editstream.functions import rulebook
from editstream.functions import variants as V
from editstream.operators.detect import flagged_records, with_flags
from editstream.operators.flatten import clean_booleans, flat_records, flatten
from editstream.operators.ingest import accepted_events, lighten, parse_events
from editstream.operators.validate import dead_letters, valid_rows, validate
from editstream.schemas import EDIT_FIELDS, PROGRESS_SCHEMA
from editstream.session import sized_shuffles, staged
from editstream.sources.tables import write_table


def flat_validated(
    lines: DataFrame, observation: Observation | None = None, strip: bool = False
) -> DataFrame:
    """Raw event lines to validated rows, without screening.

    ``observation`` counts the lines and why some are dropped; with ``strip`` dead letters do not carry
    the heavy payload of media events.
    """
    events = accepted_events(lines, observation)
    events = lighten(events) if strip else events
    return validate(clean_booleans(flatten(events), "minor", "patrolled"))


def screened(
    lines: DataFrame,
    rules: list[dict] | None = None,
    observation: Observation | None = None,
    strip: bool = False,
) -> DataFrame:
    """Raw event lines to validated rows with ``flag_types`` and ``text_length``.

    A malformed event has no text columns, so it raises no flag.
    """
    rules = rulebook.RULE_SETS[rulebook.LATEST_VERSION] if rules is None else rules
    rows = with_flags(flat_validated(lines, observation, strip), rules)
    no_flags = F.array().cast("array<string>")
    return rows.withColumn(
        "flag_types", F.when(F.col("malformed"), no_flags).otherwise(F.col("flag_types"))
    )


def validated_records(lines: DataFrame) -> DataFrame:
    """Flat JSON records (one per line) to validated rows."""
    records = flat_records(parse_events(lines))
    is_record = F.coalesce(
        V.is_object(F.col("record_kind")) & (F.col("record_kind") != "OBJECT<>"), F.lit(False)
    )
    records = records.withColumn("malformed", ~is_record).drop("event", "record_kind")
    return validate(records, payload=F.col("value"))


def flat_lines(lines: DataFrame) -> DataFrame:
    """The plain form of the job: accepted, flattened, booleans cleaned, as JSON text in ``value``.

    Nothing is validated: a value of the wrong type is written as it is, and so is a JSON null.
    """
    records = clean_booleans(flatten(accepted_events(lines)), "minor", "patrolled")
    return records.where("not malformed").select(F.to_json(F.struct(*EDIT_FIELDS)).alias("value"))


class RuleSet(NamedTuple):
    """Rules and the version under which their hits are stored; without rules detection is off."""

    version: str
    rules: list[dict]


def rule_set(rules: str | RuleSet) -> RuleSet:
    """A published version by its name, or a rule set as it is, such as ``load_rules`` gives."""
    return RuleSet(*rules) if isinstance(rules, tuple) else RuleSet(rules, rulebook.RULE_SETS[rules])


def routed(screened_rows: DataFrame, version: str, as_of) -> dict[str, DataFrame]:
    """The three outputs of screened rows. A flagged row also goes to one of the other two."""
    return {
        "edits": valid_rows(screened_rows),
        "dead_letter": dead_letters(screened_rows, as_of),
        "flagged": flagged_records(screened_rows, version, as_of),
    }


def write_routes(
    screened_rows: DataFrame, root: str, batch_id: str | int, version: str
) -> None:
    as_of = F.lit(datetime.now(timezone.utc))
    for table, rows in routed(screened_rows, version, as_of).items():
        write_table(rows, root, table, batch_id)


def write_progress(
    spark: SparkSession, root: str, batch_id: str | int, counts: dict[str, int], rows: DataFrame
) -> None:
    """Append what became of a batch: lines by fate, as counted on the way, and rows by table."""
    routes = rows.agg(
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("dead_letters"),
        F.count_if(F.size("flag_types") > 0).alias("flagged"),
    ).first()
    told = {"at": datetime.now(timezone.utc), **counts, **routes.asDict()}
    line = spark.createDataFrame([tuple(told[n] for n in PROGRESS_SCHEMA.names)], PROGRESS_SCHEMA)
    write_table(line, root, "progress", batch_id)


def route_batch(
    lines: DataFrame,
    root: str,
    batch_id: str | int,
    rules: str | RuleSet = rulebook.LATEST_VERSION,
    strip: bool = False,
) -> None:
    """Route a bounded input of any size, under a published version or own rules.

    The screened rows are staged and each of the three sinks reads its columns of them, so
    parsing and screening happen once. Counts of the run go to the table ``progress``.
    """
    chosen, seen = rule_set(rules), Observation()
    found = screened(lines, chosen.rules, seen, strip)
    with sized_shuffles(lines), staged(found, "screened") as rows:
        write_routes(rows, root, batch_id, chosen.version)
        write_progress(lines.sparkSession, root, batch_id, seen.get, rows)


def route_micro_batch(
    lines: DataFrame,
    root: str,
    batch_id: int | str,
    rules: str | RuleSet = rulebook.LATEST_VERSION,
    strip: bool = False,
) -> None:
    """Route one micro-batch. Its rows are staged for four reads like those of a bounded input, as a
    trigger may bound files, but not their size: kept rows would fill the executors' memory."""
    chosen, seen = rule_set(rules), Observation()
    with staged(screened(lines, chosen.rules, seen, strip), "screened") as rows:
        write_routes(rows, root, batch_id, chosen.version)
        write_progress(lines.sparkSession, root, batch_id, seen.get, rows)
