"""Rescans that run only the rules a version has changed.

What a rule says of an edit depends on the rule and the edit alone. So hits are kept per rule, under a
digest of the rule itself, whatever versions it belongs to; a new version runs the rules that no version
had before, and takes the hits of all others from there.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.functions import rulebook
from editstream.functions.columns import compute_once, present_only
from editstream.functions.rules import condition
from editstream.operators.detect import SAMPLE_LENGTH, flagged_records, full_text, with_flags, with_text
from editstream.operators.phrases import phrase_hits
from editstream.plans import finished
from editstream.plans.rescan import pending_rows
from editstream.plans.routing import RuleSet, rule_set
from editstream.session import kept, sized_shuffles
from editstream.sources import snapshots, tables
from editstream.sources.tables import SCAN_COLUMNS

HITS, SCREENED = "rule_hits", "rule_hits_screened"
HIT_SCHEMA = "event_id string, rule string"
MANY_PHRASES = 200


def digest(rule: dict) -> str:
    return hashlib.sha256(json.dumps(rule, sort_keys=True).encode()).hexdigest()


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def missing(spark: SparkSession, root: str, rules: list[dict]) -> dict[tuple[snapshots.Folder, ...], list[dict]]:
    """Rules that have not seen all of the edits, by the folders that they have not seen.

    A folder made by compaction has been seen if all folders merged in it have.
    """
    seen = {f.path for f in snapshots.folders(spark, _path(root, SCREENED))}
    edits = snapshots.folders(spark, tables.table_path(root, "edits"))
    out: dict[tuple[snapshots.Folder, ...], list[dict]] = {}
    for rule in rules:
        new = tuple(f for f in edits if not f.known_in(seen, digest(rule)))
        if new:
            out.setdefault(new, []).append(rule)
    return out


def hits_of(edits: DataFrame, rules: list[dict]) -> DataFrame:
    """``event_id, rule``: which rules, by digest, fire on which edits, from one pass over the texts.

    Rules of over ``MANY_PHRASES`` phrases are looked up in an index, in a pass of their own.
    """
    large = [r for r in rules if r["kind"] == "phrases" and len(r["patterns"]) > MANY_PHRASES]
    rules = [r for r in rules if r not in large]
    found = _hits_of_few(edits, rules)
    if large:
        lines = [(digest(r), phrase) for r in large for phrase in r["patterns"]]
        book = edits.sparkSession.createDataFrame(lines, "category string, phrase string")
        hits = phrase_hits(with_text(edits), book)
        found = found.union(hits.select(F.col("evt_id").alias("event_id"), F.col("category").alias("rule")))
    return found


def _hits_of_few(edits: DataFrame, rules: list[dict]) -> DataFrame:
    if not rules:
        return edits.sparkSession.createDataFrame([], HIT_SCHEMA)
    text, folded = F.col("full_text"), F.col("folded_text")
    fired = present_only([F.when(condition(r, text, folded), F.lit(digest(r))) for r in rules])
    rows = compute_once(with_text(edits), fired=fired).where(F.size("fired") > 0)
    return rows.select(F.col("evt_id").alias("event_id"), F.explode("fired").alias("rule"))


def screen_missing(spark: SparkSession, root: str, rules: list[dict]) -> int:
    """Run what is missing of these rules and keep the hits; the number of rules that ran.

    That a rule has seen a folder is noted after its hits are in place; a run that breaks off in between
    is repeated, and hits that are there twice count once.
    """
    todo = missing(spark, root, rules)
    for folders, changed in todo.items():
        run = uuid.uuid4().hex
        edits = tables.read_folders(spark, root, "edits", list(folders))
        path = _path(root, HITS)
        hits_of(edits, changed).write.partitionBy("rule").parquet(f"{path}/run={run}")
        written = snapshots.listed(spark, f"{path}/run={run}/rule=*")
        added = [
            snapshots.Folder(f"run={run}/{s.getPath().getName()}", run) for s in written
        ]
        snapshots.commit(spark, path, lambda now: now + added)
        done = [f._replace(path=f"{digest(r)}/{f.path}", merged=()) for r in changed for f in folders]
        snapshots.commit(spark, _path(root, SCREENED), lambda now: now + done)
    return sum(map(len, todo.values()))


def known_hits(spark: SparkSession, root: str, rules: list[dict]) -> DataFrame:
    """``event_id, flag_types``: the flags these rules raise, in their order, from the kept hits."""
    order = {digest(r): r["flag"] for r in rules}
    path = _path(root, HITS)
    mine = [f.path for f in snapshots.folders(spark, path) if f.path.split("rule=")[1] in order]
    if mine:
        hits = spark.read.schema(HIT_SCHEMA).option("basePath", path).parquet(*[f"{path}/{p}" for p in mine])
    else:
        hits = spark.createDataFrame([], HIT_SCHEMA)
    fired = hits.groupBy("event_id").agg(F.collect_set("rule").alias("fired"))
    flags = [F.when(F.array_contains("fired", d), F.lit(flag)) for d, flag in order.items()]
    return fired.select("event_id", present_only(flags).alias("flag_types"))


def rescan_changed(
    spark: SparkSession,
    root: str,
    rules: str | RuleSet = rulebook.LATEST_VERSION,
    buckets: int | None = None,
) -> dict[str, int]:
    """As :func:`editstream.plans.rescan.rescan`, with the same tables after it, but only rules that
    are new or changed read the texts; all others cost a join of their hits.

    Edits without an id are screened in full each time, as nothing can be kept for them. Returns the
    numbers of scanned and flagged rows and of rules that ran.
    """
    version, chosen = rule_set(rules)
    edits = tables.read_table(spark, root, "edits").select(*SCAN_COLUMNS, "dt_user")
    finished.sync(spark, root, buckets)
    done = finished.screened_ids(spark, root, version)
    run = f"rescan-{version}-{uuid.uuid4().hex}"
    as_of = F.lit(datetime.now(timezone.utc))
    with sized_shuffles(edits):
        ran = screen_missing(spark, root, chosen)
        flags = kept(known_hits(spark, root, chosen), "known-hits")
        with pending_rows(edits, done) as todo:
            # Only what the flagged table keeps of a text goes into the join.
            cut = todo.withColumn("text_length", F.char_length(full_text()).cast("long"))
            cut = cut.withColumn("comment", F.substring("comment", 1, SAMPLE_LENGTH)).drop("parsed_comment")
            hit = cut.join(flags, cut["evt_id"] == flags["event_id"]).drop("event_id")
            nameless = with_flags(todo.where("evt_id is null"), chosen).drop("parsed_comment")
            tables.write_table(flagged_records(hit.unionByName(nameless), version, as_of), root, "flagged", run)
            ids = todo.select("evt_id").where("evt_id is not null")
            clean = ids.join(flags, ids["evt_id"] == flags["event_id"], "left_anti")
            clean = clean.unionByName(nameless.where(F.size("flag_types") == 0).select("evt_id"))
            marks = clean.select(F.col("evt_id").alias("event_id"), F.lit(version).alias("rule_version"))
            tables.write_table(marks, root, "clean", run)
    counts = {
        table: tables.read_table(spark, root, table).where(F.col("batch_id") == run).count()
        for table in ("flagged", "clean")
    }
    return {"scanned": sum(counts.values()), "flagged": counts["flagged"], "rules": ran}
