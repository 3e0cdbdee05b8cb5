"""Every operator as a named query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import json
import tempfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from editstream.functions import rulebook
from editstream.functions import variants as V
from editstream.functions.columns import sanitize_text
from editstream.operators import audit, detect, evolution, flatten, ingest, phrases, quality, validate
from editstream.plans import analytics, by_rule, finished, rescan, routing, sketches
from editstream.registry.plain import plain
from editstream.schemas import EDIT_FIELDS, EDIT_SCHEMA, ERROR_TYPE
from editstream.session import COMPRESSION, GZIP, configure, freed_shuffles, scratch_dir
from editstream.sources import event_lines, rule_files, snapshots, tables, views
from editstream.sources.snapshots import make_folder
from editstream.streaming import ingest as stream_ingest
from editstream.streaming import dedup, rates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUSTOM_CATEGORIES = {
    "spam_indicators": {"type": "phrase", "patterns": ["Buy Now", "joined", "guaranteed results"]},
    "self_promotion": {"type": "phrase", "patterns": ["visit my website", "Plan "]},
    "markdown_syntax": {"pattern": rulebook.MARKDOWN_PATTERN},
    "prompt_refusal": ["as an ai language model"],
}


def query(function: Query) -> Query:
    """Register the function's result, in scalar columns, under its name."""
    QUERIES[function.__name__] = lambda spark, sf_dir: plain(function(spark, sf_dir))
    return function


def _flagged(spark: SparkSession, sf_dir: str, version: str = rulebook.LATEST_VERSION) -> DataFrame:
    """The flagged table; the server time stands for the time of detection."""
    return detect.detect(views.edits(spark, sf_dir), version, as_of=F.col("dt_server"))


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.accepted_events(views.raw_lines(spark, sf_dir))


def _dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated = routing.flat_validated(views.raw_lines(spark, sf_dir))
    return validate.dead_letters(validated, as_of=F.col("dt_server"))


def _typed(records: DataFrame, names: list[str]) -> DataFrame:
    return records.select(
        [V.typed(F.col(n), V.kind(F.col(n)), flatten.DECLARED[n]).alias(n) for n in names]
    )


def _text_table(spark: SparkSession, sf_dir: str, name: str, text: str) -> DataFrame:
    configure(spark)
    return views.table(spark, sf_dir, name).withColumnRenamed(text, "comment")


# --- Sources, ingest, projections ------------------------------------------------------------


@query
def ingest_reject_counts(spark, sf_dir):
    return ingest.reject_counts(views.raw_lines(spark, sf_dir))


@query
def event_stream_payloads(spark, sf_dir):
    """The raw lines wrapped as event-stream text, and read back from it."""
    lines = views.raw_lines(spark, sf_dir)
    frames = F.array(
        F.lit("event: message"),
        F.concat(F.lit(event_lines.DATA_PREFIX), F.col("value")),
        F.lit("data: "),
        F.lit(""),
    )
    text = lines.select(F.explode(frames).alias("value"))
    return ingest.reject_counts(event_lines.payload_lines(text))


@query
def decoded_bytes(spark, sf_dir):
    """Payload bytes, broken for one type of event, by what decoding makes of them."""
    rows = views.numbered_raw_lines(spark, sf_dir)
    is_log = rows["value"].contains('"type":"log"')
    broken = F.concat(F.lit(b"\xff\xfe"), rows["value"].cast("binary"))
    payloads = rows.select(
        F.when(is_log, broken).otherwise(rows["value"].cast("binary")).alias("value")
    )
    return ingest.reject_counts(payloads)


@query
def media_strip(spark, sf_dir):
    stripped = ingest.strip_media(_accepted(spark, sf_dir))
    again = stripped.select("event", F.try_parse_json("value").alias("after"))
    keys = F.map_keys(F.col("after").cast("map<string,variant>"))
    return again.select(
        V.as_text(V.child(F.col("event"), "$.meta.id")).alias("evt_id"),
        F.array_contains(keys, ingest.MEDIA_PAYLOAD_KEY).alias("keeps_payload"),
        F.size(keys).alias("keys"),
    )


@query
def core_projection(spark, sf_dir):
    return _typed(flatten.project(_accepted(spark, sf_dir), flatten.CORE), list(flatten.CORE))


@query
def edit_projection(spark, sf_dir):
    events = _accepted(spark, sf_dir)
    sources = {"evt_id": flatten.CORE["evt_id"], **flatten.EDIT}
    return _typed(flatten.project(events, sources), list(sources))


@query
def log_projection(spark, sf_dir):
    events = _accepted(spark, sf_dir)
    sources = {"evt_id": flatten.CORE["evt_id"], **flatten.LOG}
    return _typed(flatten.project(events, sources), list(sources))


@query
def content_projection(spark, sf_dir):
    events = _accepted(spark, sf_dir)
    sources = {"evt_id": flatten.CORE["evt_id"], **flatten.CONTENT}
    return _typed(flatten.project(events, sources), list(sources))


@query
def boolean_cleaning(spark, sf_dir):
    records = flatten.clean_booleans(
        flatten.flatten(_accepted(spark, sf_dir)), "minor", "patrolled", "bot"
    )
    return (
        _typed(records, ["type", "minor", "patrolled", "bot"])
        .groupBy("type", "minor", "patrolled", "bot")
        .agg(F.count("*").alias("events"))
    )


@query
def flat_edits(spark, sf_dir):
    return validate.valid_rows(routing.flat_validated(views.raw_lines(spark, sf_dir)))


@query
def route_counts(spark, sf_dir):
    """One pass over the raw lines: how many go to which table."""
    routes = F.array(
        F.when(F.col("is_valid"), "edits").otherwise("dead_letter"),
        F.when(F.size("flag_types") > 0, "flagged"),
    )
    return (
        routing.screened(views.raw_lines(spark, sf_dir))
        .select(F.explode(routes).alias("route"))
        .where("route is not null")
        .groupBy("route")
        .agg(F.count("*").alias("rows"))
    )


@query
def json_lines_round_trip(spark, sf_dir):
    """The plain job of flattening: JSON lines written, and every value's text read back."""
    path = scratch_dir(spark, "flat-json")
    tables.write_json_lines(routing.flat_lines(views.raw_lines(spark, sf_dir)), path, compressed=True)
    record = F.try_parse_json("value")
    return spark.read.text(path).select(
        [V.as_text(V.child(record, f"$.{name}")).alias(name) for name in EDIT_FIELDS]
    )


@query
def published_messages(spark, sf_dir):
    edits = views.edits(spark, sf_dir).select("evt_id", "type", "comment", "log_id")
    message = F.try_parse_json("value")
    return event_lines.as_message(edits).select(
        V.as_text(V.child(message, "$.evt_id")).alias("evt_id"),
        F.md5(V.as_text(V.child(message, "$.comment"))).alias("comment_md5"),
        (V.kind(V.child(message, "$.log_id")) == "VOID").alias("log_id_is_null"),
    )


# --- Rules -----------------------------------------------------------------------------------


def _rule_query(version: str, rule: dict, name: str) -> None:
    def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
        return detect.rule_hits(views.edits(spark, sf_dir), rule).select("evt_id", "domain")

    hits.__name__ = name
    query(hits)


for _rule in rulebook.RULE_SETS[rulebook.LATEST_VERSION]:
    _rule_query(rulebook.LATEST_VERSION, _rule, f"rule_{_rule['flag']}")
_rule_query("1.0.2", rulebook.EMOJI_RULE_1_0_2, "rule_emoji_fixed_class")


def _version_query(version: str) -> None:
    def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
        edits = views.edits(spark, sf_dir)
        return detect.flagged_only(edits, rulebook.RULE_SETS[version]).select(
            "evt_id", "flag_types"
        )

    flags.__name__ = "flags_" + version.replace(".", "_")
    query(flags)


for _version in rulebook.RULE_SETS:
    _version_query(_version)


@query
def custom_rule_flags(spark, sf_dir):
    rules = rule_files.from_categories(CUSTOM_CATEGORIES)
    return detect.flagged_only(views.edits(spark, sf_dir), rules).select("evt_id", "flag_types")


@query
def phrase_book_hits(spark, sf_dir):
    """A book of a phrase per benchmark item, its first thirty characters, and some short ones."""
    items = views.table(spark, sf_dir, "benchmark")
    start = F.lower(F.substring("text", 1, 30))
    book = items.select(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("category"), start.alias("phrase"))
    short = spark.createDataFrame([("short", p) for p in ("**", "ü", "vital", "☺")], "category string, phrase string")
    rows = detect.with_text(views.edits(spark, sf_dir))
    return phrases.phrase_hits(rows, book.union(short))


@query
def rule_version_changes(spark, sf_dir):
    return detect.version_changes(views.edits(spark, sf_dir), rulebook.RULE_SETS)


@query
def flagged_events(spark, sf_dir):
    return _flagged(spark, sf_dir)


@query
def flagged_raw_events(spark, sf_dir):
    rows = routing.screened(views.raw_lines(spark, sf_dir))
    records = detect.flagged_records(rows, rulebook.LATEST_VERSION, F.col("dt_server"))
    return records.select("event_id", "title", "namespace", "ai_flags", "content_sample")


@query
def flagged_json_columns(spark, sf_dir):
    return tables.json_columns(_flagged(spark, sf_dir)).select("event_id", "ai_flags")


@query
def flagged_json_members(spark, sf_dir):
    """All nested columns of flagged records as JSON text, and every member read back from it."""
    rows = tables.json_columns(_flagged(spark, sf_dir))
    sample, told = F.try_parse_json("content_sample"), F.try_parse_json("detection_metadata")
    flags = F.map_keys(F.try_parse_json("ai_flags").cast("map<string,variant>"))
    return rows.select(
        "event_id",
        F.array_sort(flags).alias("ai_flags"),
        V.as_text(V.child(sample, "$.comment")).alias("comment"),
        V.as_text(V.child(sample, "$.title")).alias("title"),
        V.as_long(V.child(sample, "$.text_length")).alias("text_length"),
        V.as_long(V.child(told, "$.total_flags")).alias("total_flags"),
        F.size(F.map_keys(told.cast("map<string,variant>"))).alias("members"),
        F.from_json(F.get_json_object("detection_metadata", "$.flag_types"), "array<string>").alias("flag_types"),
        F.try_to_timestamp(V.as_text(V.child(told, "$.detected_at"))).alias("detected_at"),
        V.as_text(V.child(told, "$.rule_version")).alias("rule_version"),
    )


@query
def custom_rules_routed(spark, sf_dir):
    """Own rules from a file, through the whole job: which rows are flagged with what."""
    folder = Path(tempfile.mkdtemp(prefix="rules-"))  # read by the driver alone
    (folder / "rules.json").write_text(json.dumps({"version": "own-1", "patterns": CUSTOM_CATEGORIES}))
    own = routing.RuleSet(*rule_files.load_rules(str(folder / "rules.json")))
    root = scratch_dir(spark, "own-rules")
    configure(spark)
    routing.route_batch(views.raw_lines(spark, sf_dir), root, "load", own)
    rows = tables.read_table(spark, root, "flagged")
    return rows.select("event_id", "rule_version", "detection_metadata.flag_types")


@query
def routed_without_detection(spark, sf_dir):
    """A rule file that is not there turns detection off; rows are routed all the same."""
    own = routing.RuleSet(*rule_files.load_rules("/no/such/rules.json"))
    root = scratch_dir(spark, "no-rules")
    configure(spark)
    tables.ensure_tables(spark, root)
    routing.route_batch(views.raw_lines(spark, sf_dir), root, "load", own)
    rows = [
        tables.read_table(spark, root, name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("route"), "rows")
        for name in ("edits", "dead_letter", "flagged")
    ]
    return reduce(DataFrame.unionAll, rows)


@query
def document_flags(spark, sf_dir):
    rows = _text_table(spark, sf_dir, "documents", "text")
    rules = rulebook.RULE_SETS[rulebook.LATEST_VERSION]
    return detect.flagged_only(rows, rules, ["comment"]).select(
        "doc_id", "flag_types", "text_length"
    )


@query
def conversation_flags(spark, sf_dir):
    rows = _text_table(spark, sf_dir, "conversations", "text")
    rules = rulebook.RULE_SETS[rulebook.LATEST_VERSION]
    return detect.flagged_only(rows, rules, ["comment"]).select(
        "conv_id", "turn", "flag_types", "text_length"
    )


@query
def page_flags(spark, sf_dir):
    rows = _text_table(spark, sf_dir, "pages", "html")
    rules = rulebook.RULE_SETS[rulebook.LATEST_VERSION]
    return detect.flagged_only(rows, rules, ["comment"]).select(
        "page_id", "flag_types", "text_length"
    )


# --- Validation and dead letters ---------------------------------------------------------------


@query
def validation_errors(spark, sf_dir):
    validated = routing.flat_validated(views.raw_lines(spark, sf_dir))
    errors = validate.exploded_errors(validated).where(F.col("field") != "_root")
    return errors.groupBy("category", "field", "expected_type", "actual_value", "message").agg(
        F.count("*").alias("errors")
    )


@query
def dead_letters(spark, sf_dir):
    return _dead(spark, sf_dir).select(
        *EDIT_FIELDS, "_error_category", "_schema_version"
    )


@query
def dead_letter_details(spark, sf_dir):
    """The error lists of dead letters, read back from their JSON, with what goes with each letter."""
    rows = _dead(spark, sf_dir).where(F.get_json_object("_original_payload", "$.meta").isNull())
    errors = rows.select(
        "_error_category",
        F.inline(F.from_json("_error_details", T.ArrayType(ERROR_TYPE))),
    )
    return errors.groupBy(errors.columns).agg(F.count("*").alias("errors"))


@query
def dead_letter_payloads(spark, sf_dir):
    """The records of dead letters, read back from their payload: values keep their JSON type there."""
    payload = F.try_parse_json("_original_payload")
    rows = _dead(spark, sf_dir).select(payload.alias("record"))
    flat = rows.where(V.child(F.col("record"), "$.meta").isNull())
    return flat.select([V.as_text(V.child(F.col("record"), f"$.{n}")).alias(n) for n in EDIT_FIELDS])


@query
def malformed_payloads(spark, sf_dir):
    """Dead letters of malformed events carry the raw line, and name it in their details."""
    record = F.try_parse_json("_original_payload")
    rows = _dead(spark, sf_dir).where(V.child(record, "$.meta").isNotNull())
    return rows.select(
        V.as_text(V.child(record, "$.meta.id")).alias("evt_id"),
        V.as_text(V.child(record, "$.title")).alias("title"),
        "_error_category",
        F.get_json_object("_error_details", "$[0].field").alias("field"),
        (F.get_json_object("_error_details", "$[0].actual_value") == F.col("_original_payload")).alias("whole"),
    )


@query
def flat_record_errors(spark, sf_dir):
    validated = routing.validated_records(views.flat_lines(spark, sf_dir))
    return (
        validate.exploded_errors(validated)
        .groupBy("category", "field", "expected_type", "actual_value", "message")
        .agg(F.count("*").alias("errors"))
    )


@query
def flat_record_categories(spark, sf_dir):
    validated = routing.validated_records(views.flat_lines(spark, sf_dir))
    category = validate.error_category(F.col("errors"))
    return validated.groupBy(category.alias("category"), "is_valid").agg(
        F.count("*").alias("records")
    )


@query
def required_fields(spark, sf_dir):
    return validate.required_report(
        views.edits(spark, sf_dir), ["evt_id", "type", "domain", "comment", "log_id", "absent"]
    )


@query
def field_type_violations(spark, sf_dir):
    return validate.type_violations(
        _accepted(spark, sf_dir),
        {
            "title": ["STRING"],
            "namespace": ["BIGINT"],
            "bot": ["BOOLEAN"],
            "minor": ["BOOLEAN"],
            "timestamp": ["BIGINT"],
        },
    )


# --- Clean-up and quality ------------------------------------------------------------------------


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.numbered_flat_lines(spark, sf_dir)
    return quality.clean_records(flatten.flat_records(ingest.parse_events(lines)))


@query
def cleaned_records(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    return cleaned.select("i", *EDIT_FIELDS, "is_valid")


@query
def quality_scores(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("i", "is_valid", "errors", "warnings", "quality_score")


@query
def quality_summary(spark, sf_dir):
    return quality.quality_summary(_cleaned(spark, sf_dir), "domain")


@query
def schema_drift(spark, sf_dir):
    return quality.drift_warnings(_cleaned(spark, sf_dir))


@query
def sanitized_documents(spark, sf_dir):
    rows = _text_table(spark, sf_dir, "documents", "text")
    clean = sanitize_text(F.concat(F.lit("\t "), F.col("comment"), F.lit(" \n")), 1000)
    return rows.select("doc_id", F.char_length(clean).alias("chars"), F.md5(clean).alias("md5"))


@query
def safe_casts(spark, sf_dir):
    rows = views.events_and_documents(spark, sf_dir)[0]
    i = F.col("event_id")
    number = i.cast("string")
    text = (
        F.when(F.col("event_type") == "click", number)
        .when(F.col("event_type") == "view", F.concat(F.lit(" -"), number, F.lit(".75 ")))
        .when(F.col("event_type") == "signup", F.concat(number, F.lit("d")))
        .when(F.col("event_type") == "purchase", F.lit("Yes"))
    )
    return rows.select(
        "event_id",
        quality.safe_cast_text(text, "int", -1).alias("as_int"),
        quality.safe_cast_text(text, "float", 0.5).alias("as_float"),
        quality.safe_cast_text(text, "bool", False).alias("as_bool"),
        quality.safe_cast_text(text, "str", "none").alias("as_str"),
    )


# --- Stored queries --------------------------------------------------------------------------------


def _over(build, source, *names: str, **options) -> None:
    """Register ``build`` over a derived table under one or more names."""
    for name in names:

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(source(spark, sf_dir), **options)

        run.__name__ = name
        query(run)


for _build in (
    analytics.total_events,
    analytics.events_by_type,
    analytics.recent_events,
    analytics.most_active_users,
    analytics.user_patterns,
    analytics.events_by_domain,
    analytics.events_per_hour,
    analytics.events_per_day,
    analytics.size_change_by_namespace,
    analytics.large_edits,
    analytics.page_frequency,
    analytics.completeness,
    analytics.daily_summary,
):
    _over(_build, views.edits, _build.__name__)
for _build in (
    analytics.total_flagged,
    analytics.flag_counts,
    analytics.recent_flagged,
    analytics.with_flag,
    analytics.users_with_flags,
    analytics.top_flagged_users,
    analytics.flag_pairs,
    analytics.flagged_totals,
    analytics.flagged_export,
):
    _over(_build, _flagged, _build.__name__)


@query
def dead_letters_by_category(spark, sf_dir):
    """Counts with samples, of which the messages are shown; a whole bad line would be too long."""
    report = analytics.dead_letters_by_category(_dead(spark, sf_dir))
    messages = F.transform("sample_errors", lambda s: F.get_json_object(s, "$[0].message"))
    return report.withColumn("sample_errors", messages)


@query
def latest_flagged_rows(spark, sf_dir):
    return analytics.latest_flagged_rows(_flagged(spark, sf_dir)).select(
        "event_id", "rule_version", "edit_type", "detection_metadata"
    )


@query
def flag_rate_by_domain(spark, sf_dir):
    return analytics.flag_rate_by_domain(views.edits(spark, sf_dir), _flagged(spark, sf_dir))


@query
def recent_failures(spark, sf_dir):
    return analytics.recent_failures(_dead(spark, sf_dir)).drop("_error_details")


@query
def events_per_minute(spark, sf_dir):
    day = F.lit("2024-01-15").cast("date")
    return analytics.events_per_minute(views.edits(spark, sf_dir), day)


@query
def flag_correlation(spark, sf_dir):
    flags = rulebook.flags_of(rulebook.RULE_SETS[rulebook.LATEST_VERSION])
    pairs = analytics.flag_correlation(_flagged(spark, sf_dir), flags)
    return pairs.withColumn("phi", F.round("phi", 9))


@query
def version_totals(spark, sf_dir):
    edits = views.edits(spark, sf_dir)
    rows = detect.with_version_flags(edits, rulebook.RULE_SETS).select(F.inline("flags_by_version"))
    return rescan.marked_totals(
        rows.select("rule_version", (F.size("flag_types") > 0).alias("is_flagged"))
    )


# --- Joins and rescans ---------------------------------------------------------------------------


@query
def pending_scan(spark, sf_dir):
    """What a rescan has left after edits are flagged and new pages are marked clean."""
    edits = views.edits(spark, sf_dir)
    flagged = _flagged(spark, sf_dir).where("edit_type = 'edit'")
    clean = edits.where("type = 'new'").select(
        F.col("evt_id").alias("event_id"), F.lit(rulebook.LATEST_VERSION).alias("rule_version")
    )
    left = rescan.pending(edits, flagged, clean, rulebook.LATEST_VERSION).select(tables.SCAN_COLUMNS)
    return left.withColumns({c: F.md5(c) for c in ("comment", "parsed_comment")})


@query
def indexed_pending(spark, sf_dir):
    """The same from stored tables, through the index of finished ids."""
    root = scratch_dir(spark, "indexed")
    edits, version = views.edits(spark, sf_dir), rulebook.LATEST_VERSION
    tables.write_table(edits, root, "edits", "load")
    tables.write_table(_flagged(spark, sf_dir).where("edit_type = 'edit'"), root, "flagged", "a")
    finished.sync(spark, root)
    new = edits.where("type = 'new'").select(
        F.col("evt_id").alias("event_id"), F.lit(version).alias("rule_version")
    )
    tables.write_table(new, root, "clean", "b")
    finished.sync(spark, root)
    stored = tables.read_table(spark, root, "edits")
    return finished.pending_ids(stored, finished.screened_ids(spark, root, version))


@query
def rescan_by_rule_totals(spark, sf_dir):
    """Two versions screened rule by rule, the second from the first's hits but for its own rules."""
    root = scratch_dir(spark, "by-rule")
    tables.ensure_tables(spark, root)
    tables.write_table(views.edits(spark, sf_dir), root, "edits", "load")
    for version in ("1.0.2", "1.0.3"):
        by_rule.rescan_changed(spark, root, version)
    return rescan.version_totals(
        tables.read_table(spark, root, "flagged"), tables.read_table(spark, root, "clean")
    )


@query
def rescan_totals(spark, sf_dir):
    """Stored edits screened under two versions; the second run of a version finds nothing."""
    root = scratch_dir(spark, "rescan-tables")
    tables.ensure_tables(spark, root)
    tables.write_table(views.edits(spark, sf_dir), root, "edits", "load")
    for version in ("1.0.2", "1.0.3", "1.0.3"):
        rescan.rescan(spark, root, version)
    return rescan.version_totals(
        tables.read_table(spark, root, "flagged"), tables.read_table(spark, root, "clean")
    )


@query
def stored_edits_by_day(spark, sf_dir):
    """Edits written to a day-partitioned table and read back for one day."""
    root = scratch_dir(spark, "stored")
    tables.write_table(views.edits(spark, sf_dir), root, "edits", "load")
    stored = tables.read_table(spark, root, "edits")
    return tables.on_day(stored, F.lit("2024-01-15").cast("date")).select(EDIT_FIELDS)


def _stored_query(build, name: str, **options) -> None:
    """A stored query over a table on disk, where the day of the user time prunes the scan."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_dir(spark, name)
        tables.write_table(views.edits(spark, sf_dir), root, "edits", "load")
        return build(tables.read_table(spark, root, "edits"), **options)

    run.__name__ = name
    query(run)


_stored_query(analytics.events_per_hour, "stored_events_per_hour")
_stored_query(analytics.events_per_day, "stored_events_per_day")
_stored_query(
    lambda edits: analytics.events_per_minute(edits, F.lit("2024-01-15").cast("date")),
    "stored_events_per_minute",
)


@query
def users_by_day_sketches(spark, sf_dir):
    """Events and edits per day and domain from stored sketches, after a batch is written again; the
    estimate of users against the exact count."""
    root = scratch_dir(spark, "sketches")
    edits = views.edits(spark, sf_dir)
    part = F.pmod(F.col("evt_id").cast("long"), F.lit(2))
    tables.write_table(edits.where(part == 0), root, "edits", "a")
    tables.write_table(edits.where(part == 0), root, "edits", "b")
    sketches.sync(spark, root)
    tables.write_table(edits.where(part == 1), root, "edits", "b")
    sketches.sync(spark, root)
    found = sketches.about_users(sketches.stored_sketches(spark, root), "user_day", "domain")
    exact = analytics.daily_summary(tables.read_table(spark, root, "edits"))
    near = F.abs(F.col("about_unique_users") - F.col("unique_users")) <= 0.05 * F.col("unique_users")
    return found.join(
        exact.select(F.col("date").alias("user_day"), "domain", "unique_users"), ["user_day", "domain"]
    ).select("user_day", "domain", "events", "edits", near.alias("near"))


@query
def table_versions(spark, sf_dir):
    """Rows by type in every version of a table: three writes, a compaction, a batch written again."""
    root = scratch_dir(spark, "versions")
    edits = views.edits(spark, sf_dir)
    part = F.pmod(F.col("evt_id").cast("long"), F.lit(3))
    for number in range(3):
        tables.write_table(edits.where(part == number), root, "edits", number)
    day = edits.agg(F.min(F.to_date("dt_server"))).first()[0]
    tables.compact_day(spark, root, "edits", str(day))
    tables.write_table(edits.where((part == 1) & (F.col("type") == "edit")), root, "edits", 3)
    found = [
        tables.read_table(spark, root, "edits", version=v).select(F.lit(v).alias("version"), "type")
        for v in snapshots.versions(spark, tables.table_path(root, "edits"))
    ]
    return reduce(DataFrame.unionAll, found).groupBy("version", "type").agg(F.count("*").alias("rows"))


@query
def compacted_edits(spark, sf_dir):
    """Edits written in three batches, of which one day is rewritten as one and read back."""
    root, day = scratch_dir(spark, "compacted"), "2024-01-15"
    edits = views.edits(spark, sf_dir)
    for part in range(3):
        tables.write_table(
            edits.where(F.pmod(F.col("evt_id").cast("long"), F.lit(3)) == part), root, "edits", part
        )
    tables.compact_day(spark, root, "edits", day)
    stored = tables.on_day(tables.read_table(spark, root, "edits"), F.lit(day).cast("date"))
    return stored.select(EDIT_FIELDS)


@query
def migrated_table(spark, sf_dir):
    """Edits stored before the log columns were declared, beside edits stored after."""
    root = scratch_dir(spark, "migrated")
    edits, others = views.edits(spark, sf_dir), views.edits_without_text(spark, sf_dir)
    older = edits.where("type <> 'log'").drop("log_type", "log_action", "log_id", "log_comment")
    tables.write_table(older, root, "edits", "older")
    tables.ensure_tables(spark, root)
    tables.write_table(others.where("type = 'log'"), root, "edits", "newer")
    return tables.read_table(spark, root, "edits").select(EDIT_FIELDS)


# --- Streams -------------------------------------------------------------------------------------


BATCHES = 3
Land = Callable[[int], None]


SPLIT_BYTES = 16 * 1024 * 1024


def _run_on_landing(spark: SparkSession, land: Land, start: Callable[[], StreamingQuery]) -> None:
    """Files of one micro-batch after the other land, and the stream takes what is there. So the
    micro-batches are the same whatever number of files they have. The files are compressed and hold
    many times their size, so a task reads one or a few of them."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    for number in range(BATCHES):
        land(number)
        spark.conf.set(key, str(SPLIT_BYTES))
        try:
            start().awaitTermination()
        finally:
            spark.conf.set(key, before)


def _stream_of_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Land]:
    """The raw lines as a stream, and what makes those of a micro-batch land. Neighbouring numbers come
    in different ones. Lines stay in the tasks that make them, and their files are compressed."""
    landed = scratch_dir(spark, "landed")
    lines = views.numbered_raw_lines(spark, sf_dir)

    def land(number: int) -> None:
        part = lines.where(F.pmod("i", F.lit(BATCHES)) == number).select("value")
        with freed_shuffles(spark):
            part.write.mode("append").options(**GZIP).text(landed)

    make_folder(spark, landed)
    return event_lines.stream_lines(spark, landed), land


def _routed_stream(spark: SparkSession, sf_dir: str) -> str:
    root, checkpoint = scratch_dir(spark, "routed"), scratch_dir(spark, "routed-checkpoint")
    tables.ensure_tables(spark, root)
    lines, land = _stream_of_files(spark, sf_dir)
    once = {"availableNow": True}
    _run_on_landing(
        spark,
        land,
        lambda: stream_ingest.start_routing(lines, root, checkpoint, name="routing", trigger=once),
    )
    return root


@query
def streamed_edits(spark, sf_dir):
    return tables.read_table(spark, _routed_stream(spark, sf_dir), "edits").select(EDIT_FIELDS)


@query
def streamed_dead_letters(spark, sf_dir):
    root = _routed_stream(spark, sf_dir)
    return tables.read_table(spark, root, "dead_letter").select(
        *EDIT_FIELDS, "_error_category", "_schema_version"
    )


@query
def streamed_progress(spark, sf_dir):
    """What became of the lines of all micro-batches, by the job's own table."""
    progress = tables.read_table(spark, _routed_stream(spark, sf_dir), "progress")
    totals = [F.sum(name).alias(name) for name in progress.columns if name not in ("at", "batch_id")]
    return progress.agg(F.count("*").alias("batches"), *totals)


@query
def streamed_flagged(spark, sf_dir):
    root = _routed_stream(spark, sf_dir)
    return tables.read_table(spark, root, "flagged").select(
        "event_id", "title", "namespace", "ai_flags", "content_sample"
    )


@query
def batch_routed_flagged(spark, sf_dir):
    """The same tables from a bounded run."""
    root = scratch_dir(spark, "routed-batch")
    configure(spark)
    routing.route_batch(views.raw_lines(spark, sf_dir), root, "load")
    return tables.read_table(spark, root, "flagged").select(
        "event_id", "title", "namespace", "ai_flags", "content_sample"
    )


def _edits_in_time(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Land, str]:
    """The edits as a stream, what makes those of a micro-batch land, in order of time, and where."""
    landed = scratch_dir(spark, "landed-edits")
    edits = views.edits(spark, sf_dir)
    first, last = edits.agg(F.min(F.unix_seconds("dt_server")), F.max(F.unix_seconds("dt_server"))).first()
    first, last = first or 0, last or 0
    part = F.floor((F.unix_seconds("dt_server") - first) * BATCHES / (last - first + 1))

    def land(number: int) -> None:
        rows = edits.where(F.coalesce(part, F.lit(0)) == number)
        with freed_shuffles(spark):
            rows.write.mode("append").option("compression", COMPRESSION).parquet(landed)

    make_folder(spark, landed)
    return spark.readStream.schema(EDIT_SCHEMA).parquet(landed), land, landed


def _rates_query(name: str, *widths: str) -> None:
    def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
        out, checkpoint = scratch_dir(spark, name), scratch_dir(spark, f"{name}-checkpoint")
        edits, land, _ = _edits_in_time(spark, sf_dir)
        writer = (
            rates.chained_rates(edits, widths)
            .writeStream.outputMode("append")
            .format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
        )
        _run_on_landing(spark, land, writer.start)
        found = spark.read.schema("window_start timestamp, event_count long").parquet(out)
        return found.select("window_start", "event_count")

    counts.__name__ = name
    query(counts)


@query
def streamed_minute_counts(spark, sf_dir):
    """All minutes, those that are still open at the end with what they hold by then."""
    out, checkpoint = scratch_dir(spark, "minute-counts"), scratch_dir(spark, "minute-counts-checkpoint")
    edits, land, landed = _edits_in_time(spark, sf_dir)
    _run_on_landing(
        spark,
        land,
        lambda: rates.start_latest(rates.chained_rates(edits, ["1 minute"]), out, checkpoint, {"availableNow": True}),
    )
    found = rates.latest_windows(spark, out).select("window_start", "event_count")
    untimed = rates.unreadable_times(spark.read.schema(EDIT_SCHEMA).parquet(landed))
    start = F.lit(None).cast("timestamp").alias("window_start")
    return found.union(untimed.groupBy(start).agg(F.count("*").alias("event_count")))


_rates_query("streamed_hour_counts", "1 minute", "1 hour")
_rates_query("streamed_day_counts", "1 minute", "1 hour", "1 day")


@query
def streamed_first_events(spark, sf_dir):
    """Copies of an id come in different micro-batches; no event is too late for this table."""
    out, checkpoint = scratch_dir(spark, "first-events"), scratch_dir(spark, "first-events-checkpoint")
    lines, land = _stream_of_files(spark, sf_dir)
    # Only what the result and the watermark need is shuffled.
    valid = validate.valid_rows(routing.flat_validated(lines)).select("evt_id", "dt_user")
    writer = (
        rates.first_in_stream(valid, late="10000 days")
        .select("evt_id")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    _run_on_landing(spark, land, writer.start)
    return spark.read.schema("evt_id string").parquet(out)


@query
def streamed_unique_events(spark, sf_dir):
    """The same against an index of ids, which knows copies of any age; the rows are a stored table."""
    root, checkpoint = scratch_dir(spark, "unique"), scratch_dir(spark, "unique-checkpoint")
    lines, land = _stream_of_files(spark, sf_dir)
    valid = validate.valid_rows(routing.flat_validated(lines))
    _run_on_landing(
        spark,
        land,
        lambda: dedup.start_dedup(
            valid,
            f"{root}/seen",
            checkpoint,
            "unique",
            lambda rows, run: tables.write_table(rows, root, "edits", run),
            trigger={"availableNow": True},
        ),
    )
    return tables.read_table(spark, root, "edits").select("evt_id")


def _waiting(spark: SparkSession, sf_dir: str, messages: int = 1) -> DataFrame:
    """Events that stand for so many messages wait as many minutes as their value says."""
    events = views.events_and_documents(spark, sf_dir)[0]
    arrivals = events.select(
        F.col("event_type").alias("source"),
        F.col("ts").cast("timestamp").alias("at"),
        "value",
        F.lit(messages).alias("messages"),
    )
    minutes = F.make_dt_interval(mins=F.floor("value").cast("int"))
    departures = arrivals.select("source", (F.col("at") + minutes).alias("at"), "messages")
    return rates.backlog(arrivals, departures)


@query
def backlog_severity(spark, sf_dir):
    """Thresholds that suit the test data."""
    severity = rates.severity(F.col("waiting"), F.lit(1), high=5, medium=3, low=1)
    return _waiting(spark, sf_dir).withColumn("severity", severity)


@query
def backlog_severity_published(spark, sf_dir):
    """The published thresholds, with events of two thousand messages."""
    severity = rates.severity(F.col("waiting"), F.lit(1))
    return _waiting(spark, sf_dir, 2_000).withColumn("severity", severity)


# --- Audits and evolution --------------------------------------------------------------------------


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.valid_rows(routing.flat_validated(views.raw_lines(spark, sf_dir)))


@query
def first_events(spark, sf_dir):
    return audit.first_per_id(_valid(spark, sf_dir)).select("evt_id", "dt_server", "title")


@query
def repeated_ids(spark, sf_dir):
    return audit.repeated_ids(_valid(spark, sf_dir))


def _contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits without their page number, so that copied documents give the same content."""
    return views.edits(spark, sf_dir).withColumns(
        {"title": F.col("domain"), "user": F.col("type")}
    )


@query
def repeated_content(spark, sf_dir):
    return audit.repeated_content(_contents(spark, sf_dir)).drop("content")


@query
def repeated_content_members(spark, sf_dir):
    return audit.repeated_content_members(_contents(spark, sf_dir)).select("evt_id", "copies")


@query
def late_events(spark, sf_dir):
    """Events that arrive in a locally shuffled order of their numbers, told in microseconds."""
    number = F.col("evt_id").cast("long").bitwiseXOR(F.lit(5))
    arrival = F.lit(1_700_000_000_000_000) + number * F.lit(86_400_000_003)
    late = audit.late_events(views.edits(spark, sf_dir), arrival, slice_rows=500)
    return late.select("evt_id", "domain", "dt_server", "latest_before")


@query
def clock_differences(spark, sf_dir):
    edits = views.edits(spark, sf_dir)
    shifted = edits.withColumn(
        "dt_server",
        F.when(F.col("bot"), F.col("dt_server") + F.expr("interval 90 seconds")).otherwise(
            F.col("dt_server")
        ),
    )
    return audit.clock_differences(shifted)


@query
def flags_per_event(spark, sf_dir):
    return audit.flags_per_event(_flagged(spark, sf_dir))


@query
def row_sizes(spark, sf_dir):
    return audit.row_sizes(views.edits(spark, sf_dir))


@query
def dead_letter_growth(spark, sf_dir):
    return audit.dead_letter_growth(_dead(spark, sf_dir))


@query
def merged_table_versions(spark, sf_dir):
    """Edits stored before the log columns existed, merged with edits stored after."""
    edits = views.edits(spark, sf_dir)
    log_columns = ["log_type", "log_action", "log_id", "log_comment"]
    older = edits.where("type <> 'log'").drop(*log_columns)
    newer = edits.where("type = 'log'").withColumn("future", F.lit(1))
    merged = evolution.conform(evolution.union_versions(older, newer), EDIT_SCHEMA)
    return merged.groupBy("type").agg(
        F.count("*").alias("rows"),
        F.count("log_id").alias("with_log_id"),
        F.count("future").alias("with_future"),
    )


@query
def schema_compatibility(spark, sf_dir):
    return evolution.compatibility_report(ingest.parse_events(views.flat_lines(spark, sf_dir)))
