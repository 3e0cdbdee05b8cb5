"""The ready-made queries over the edit, flagged, dead-letter and clean tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editstream.functions.columns import parse_time


def _user_time() -> Column:
    return parse_time(F.col("dt_user"))


def on_user_day(edits: DataFrame, day: Column) -> DataFrame:
    """Events whose user time is on that day.

    A stored table also keeps the day as a column, and that condition reaches the Parquet scan; files
    of before it was kept have NULL there and are read.
    """
    rows = edits.where(F.to_date(_user_time()) == day)
    if "user_day" in edits.columns:
        rows = rows.where((F.col("user_day") == day) | F.col("user_day").isNull())
    return rows


def of_latest_days(edits: DataFrame, days: int) -> DataFrame:
    """Enough of a stored table for its latest ``days`` days by user time.

    The days are looked up in one narrow column first (a job of its own), so that the scan of the wide
    ones can pass over all older files. Tables without that column are taken whole.
    """
    if "user_day" not in edits.columns:
        return edits
    newest = edits.select("user_day").where("user_day is not null").distinct()
    found = newest.orderBy(F.desc("user_day")).limit(days).collect()
    if len(found) < days:
        return edits
    first = F.lit(found[-1]["user_day"])
    return edits.where((F.col("user_day") >= first) | F.col("user_day").isNull())


def _size_change() -> Column:
    return F.col("len_new") - F.col("len_old")


def counts_with_samples(
    rows: DataFrame, key: str, value: str, limit: int, count_name: str, samples_name: str
) -> DataFrame:
    """Rows per key, with the first ``limit`` distinct values of the key in sorted order.

    The rows are reduced to counted (key, value) pairs before the only wide shuffle; the count
    and the samples both read that shuffle. The filter on the row number becomes a limit inside
    every task, so no task holds all values of a key.
    """
    pairs = rows.groupBy(key, value).agg(F.count("*").alias("_rows"))
    counted = pairs.groupBy(key).agg(F.sum("_rows").alias(count_name))
    # Ordering by the count as well changes nothing, as pairs are unique, but it keeps both
    # readers on the same columns, which is what lets Spark run the shuffle only once.
    in_order = Window.partitionBy(key).orderBy(F.asc_nulls_last(value), "_rows")
    place = F.row_number().over(in_order)
    samples = (
        pairs.withColumn("_place", place)
        .where(F.col("_place") <= limit)
        .groupBy(F.col(key).alias("_key"))
        .agg(F.array_sort(F.collect_list(value)).alias(samples_name))
    )
    return counted.join(samples, counted[key].eqNullSafe(samples["_key"])).drop("_key")


# --- Basic ---------------------------------------------------------------------------------


def total_events(edits: DataFrame) -> DataFrame:
    return edits.agg(F.count("*").alias("total_events"))


def events_by_type(edits: DataFrame) -> DataFrame:
    return edits.groupBy("type").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "type")


def recent_events(edits: DataFrame, limit: int = 100) -> DataFrame:
    return (
        edits.select("evt_id", "dt_user", "type", "title", "user", "domain")
        .orderBy(F.desc("dt_user"), F.desc("evt_id"))
        .limit(limit)
    )


# --- Flags ---------------------------------------------------------------------------------


def total_flagged(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count("*").alias("ai_flagged_events"))


def flag_combinations(flagged: DataFrame) -> DataFrame:
    """Events per set of flags. There are few such sets, so all flag statistics start here."""
    return (
        flagged.where(F.col("ai_flags").isNotNull())
        .groupBy(F.array_sort(F.map_keys("ai_flags")).alias("flags"))
        .agg(F.count("*").alias("events"))
    )


def flag_counts(flagged: DataFrame) -> DataFrame:
    return (
        flag_combinations(flagged)
        .select(F.explode("flags").alias("flag_type"), "events")
        .groupBy("flag_type")
        .agg(F.sum("events").alias("count"))
        .orderBy(F.desc("count"), "flag_type")
    )


def recent_flagged(flagged: DataFrame, limit: int = 50) -> DataFrame:
    return (
        flagged.select(
            "event_id",
            "detection_timestamp",
            "user",
            "title",
            "domain",
            "ai_flags",
            "content_sample",
        )
        .orderBy(F.desc("detection_timestamp"), F.desc("event_id"))
        .limit(limit)
    )


def latest_flagged_rows(flagged: DataFrame, limit: int = 100) -> DataFrame:
    return flagged.orderBy(F.desc("detection_timestamp"), F.desc("event_id")).limit(limit)


def with_flag(flagged: DataFrame, flag: str = "chatgpt_artifacts") -> DataFrame:
    return (
        flagged.where(F.try_element_at("ai_flags", F.lit(flag)))
        .select(
            "event_id",
            "user",
            "title",
            "domain",
            "detection_timestamp",
            F.lit("true").alias(f"has_{flag}"),
        )
        .orderBy(F.desc("detection_timestamp"), F.desc("event_id"))
    )


# --- Users ---------------------------------------------------------------------------------


def most_active_users(edits: DataFrame, limit: int = 100) -> DataFrame:
    return (
        edits.groupBy("user")
        .agg(
            F.count("*").alias("edit_count"),
            F.count_if("bot").alias("bot_edits"),
            F.count_if("minor").alias("minor_edits"),
        )
        .orderBy(F.desc("edit_count"), "user")
        .limit(limit)
    )


def users_with_flags(flagged: DataFrame, more_than: int = 1, pages: int = 10) -> DataFrame:
    return (
        counts_with_samples(flagged, "user", "title", pages, "ai_flagged_count", "affected_pages")
        .where(F.col("ai_flagged_count") > more_than)
        .orderBy(F.desc("ai_flagged_count"), "user")
    )


def top_flagged_users(flagged: DataFrame, limit: int = 10) -> DataFrame:
    return (
        flagged.groupBy("user")
        .agg(F.count("*").alias("ai_flagged_count"))
        .orderBy(F.desc("ai_flagged_count"), "user")
        .limit(limit)
    )


def user_patterns(edits: DataFrame, more_than: int = 10, limit: int = 100) -> DataFrame:
    return (
        edits.where("type = 'edit'")
        .groupBy("user")
        .agg(
            F.count("*").alias("total_edits"),
            F.round(F.avg(_size_change()), 2).alias("avg_edit_size"),
            (F.count_if("minor") / F.count("*") * 100).alias("minor_edit_percentage"),
            F.count_distinct(F.to_date(_user_time())).alias("active_days"),
        )
        .where(F.col("total_edits") > more_than)
        .orderBy(F.desc("total_edits"), "user")
        .limit(limit)
    )


# --- Domains -------------------------------------------------------------------------------


def events_by_domain(edits: DataFrame) -> DataFrame:
    return (
        edits.groupBy("domain")
        .agg(
            F.count("*").alias("event_count"),
            F.count_if(F.col("type") == "edit").alias("edits"),
            F.count_if(F.col("type") == "new").alias("new_pages"),
        )
        .orderBy(F.desc("event_count"), "domain")
    )


def flag_rate_by_domain(edits: DataFrame, flagged: DataFrame, more_than: int = 100) -> DataFrame:
    """Distinct events and distinct flagged events per domain.

    The edits are reduced to the domains of each id, of which there are few, before they are
    shuffled by id; the join with the flagged ids needs no other shuffle of them. Rows without an
    id are no events.
    """
    events = edits.where("evt_id is not null").groupBy("evt_id").agg(
        F.collect_set(F.struct("domain")).alias("domains")
    )
    ids = flagged.groupBy(F.col("event_id").alias("flagged_id")).agg(F.lit(True).alias("is_flagged"))
    return (
        events.join(ids, events["evt_id"] == ids["flagged_id"], "left")
        .select("evt_id", "flagged_id", F.inline("domains"))
        .groupBy("domain")
        .agg(
            F.count("evt_id").alias("total_events"),
            F.count("flagged_id").alias("ai_events"),
        )
        .where(F.col("total_events") > more_than)
        .withColumn(
            "ai_percentage", F.round(F.col("ai_events") / F.col("total_events") * 100, 2)
        )
        .orderBy(F.desc("ai_percentage"), "domain")
    )


# --- Time ----------------------------------------------------------------------------------


def events_per_hour(edits: DataFrame, limit: int = 24) -> DataFrame:
    return (
        of_latest_days(edits, limit)
        .groupBy(F.date_trunc("HOUR", _user_time()).alias("hour"))
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("hour"))
        .limit(limit)
    )


def events_per_day(edits: DataFrame, limit: int = 30) -> DataFrame:
    return (
        of_latest_days(edits, limit)
        .groupBy(F.to_date(_user_time()).alias("day"))
        .agg(F.count("*").alias("event_count"), F.count_distinct("user").alias("unique_users"))
        .orderBy(F.desc("day"))
        .limit(limit)
    )


def events_per_minute(edits: DataFrame, day: Column | None = None) -> DataFrame:
    day = F.current_date() if day is None else day
    return (
        on_user_day(edits, day)
        .groupBy(F.date_trunc("MINUTE", _user_time()).alias("minute"))
        .agg(F.count("*").alias("events_per_minute"))
        .orderBy(F.desc("minute"))
    )


# --- Content -------------------------------------------------------------------------------


def size_change_by_namespace(edits: DataFrame) -> DataFrame:
    return (
        edits.where("type = 'edit'")
        .groupBy(F.col("ns").alias("namespace"))
        .agg(
            F.count("*").alias("edit_count"),
            F.avg(_size_change()).alias("avg_size_change"),
            F.max(_size_change()).alias("max_increase"),
            F.min(_size_change()).alias("max_decrease"),
        )
        .orderBy(F.desc("edit_count"), "namespace")
    )


def large_edits(edits: DataFrame, more_than: int = 1000, limit: int = 100) -> DataFrame:
    return (
        edits.where((F.col("type") == "edit") & (_size_change() > more_than))
        .select("evt_id", "title", "user", _size_change().alias("bytes_added"), "comment")
        .orderBy(F.desc("bytes_added"), "evt_id")
        .limit(limit)
    )


def page_frequency(edits: DataFrame, more_than: int = 5, limit: int = 100) -> DataFrame:
    return (
        edits.groupBy("title")
        .agg(
            F.count("*").alias("edit_count"),
            F.count_distinct("user").alias("unique_editors"),
            F.min(_user_time()).alias("first_edit"),
            F.max(_user_time()).alias("last_edit"),
        )
        .where(F.col("edit_count") > more_than)
        .orderBy(F.desc("edit_count"), "title")
        .limit(limit)
    )


# --- Data quality --------------------------------------------------------------------------


def dead_letters_by_category(dead: DataFrame, samples: int = 5) -> DataFrame:
    return counts_with_samples(
        dead, "_error_category", "_error_details", samples, "error_count", "sample_errors"
    ).orderBy(F.desc("error_count"), "_error_category")


def recent_failures(dead: DataFrame, limit: int = 50) -> DataFrame:
    payload = F.try_parse_json("_original_payload")
    return (
        dead.orderBy(F.desc("_validation_timestamp"), F.desc("_original_payload"))
        .limit(limit)
        .select(
            "_validation_timestamp",
            "_error_category",
            "_error_details",
            F.try_variant_get(payload, "$.type", "string").alias("event_type"),
            F.try_variant_get(payload, "$.title", "string").alias("title"),
        )
    )


def completeness(edits: DataFrame) -> DataFrame:
    def percentage(column: str) -> Column:
        return F.try_divide(F.count_if(F.col(column).isNotNull()), F.count("*")) * 100

    return edits.agg(
        percentage("title").alias("title_completeness"),
        percentage("user").alias("user_completeness"),
        percentage("comment").alias("comment_completeness"),
        percentage("len_new").alias("length_completeness"),
    )


# --- Advanced ------------------------------------------------------------------------------


def flag_pairs(flagged: DataFrame, more_than: int = 5) -> DataFrame:
    """How often two flags occur on the same event.

    The pairs are formed from the few distinct flag sets with their counts, so there is no
    self join and no row per event and pair.
    """
    pairs = F.flatten(
        F.transform(
            "flags",
            lambda first: F.transform(
                F.filter("flags", lambda second: second > first),
                lambda second: F.struct(first.alias("pattern_1"), second.alias("pattern_2")),
            ),
        )
    )
    return (
        flag_combinations(flagged)
        .select(F.inline(pairs), "events")
        .groupBy("pattern_1", "pattern_2")
        .agg(F.sum("events").alias("co_occurrence_count"))
        .where(F.col("co_occurrence_count") > more_than)
        .orderBy(F.desc("co_occurrence_count"), "pattern_1", "pattern_2")
    )


def flag_correlation(flagged: DataFrame, flags: list[str]) -> DataFrame:
    """The phi coefficient of every pair of flags over the flagged events.

    One aggregation over the distinct flag sets; NULL where a flag is on all events or none.
    """
    has = {flag: F.array_contains("flags", flag) for flag in flags}

    def events_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("events"))), F.lit(0)).cast("double")

    pairs = list(combinations(sorted(flags), 2))
    sums = flag_combinations(flagged).agg(
        F.coalesce(F.sum("events"), F.lit(0)).cast("double").alias("n"),
        *[events_where(has[flag]).alias(f"n_{flag}") for flag in flags],
        *[events_where(has[a] & has[b]).alias(f"n_{a}__{b}") for a, b in pairs],
    )

    def phi(a: str, b: str) -> Column:
        n, n_a, n_b, n_ab = (F.col(c) for c in ("n", f"n_{a}", f"n_{b}", f"n_{a}__{b}"))
        spread = F.sqrt(n_a * (n - n_a)) * F.sqrt(n_b * (n - n_b))
        return F.try_divide(n * n_ab - n_a * n_b, spread)

    rows = [
        F.struct(
            F.lit(a).alias("pattern_1"), F.lit(b).alias("pattern_2"), phi(a, b).alias("phi")
        )
        for a, b in pairs
    ]
    return sums.select(F.inline(F.array(*rows)))


def flagged_totals(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count("*").alias("total_ai_events"),
        F.count_distinct("rule_version").alias("rule_versions"),
        F.count_distinct("user").alias("unique_users"),
        F.count_distinct("domain").alias("unique_domains"),
    )


# --- Exports -------------------------------------------------------------------------------


def flagged_export(flagged: DataFrame) -> DataFrame:
    def flag_text(flag: str) -> Column:
        return F.try_element_at("ai_flags", F.lit(flag)).cast("string")

    return flagged.select(
        "event_id",
        "detection_timestamp",
        "rule_version",
        "user",
        "title",
        "domain",
        flag_text("chatgpt_artifacts").alias("has_chatgpt"),
        flag_text("markdown_syntax").alias("has_markdown"),
        flag_text("emoji_in_headings").alias("has_emojis"),
        "content_sample",
    ).orderBy(F.desc("detection_timestamp"), F.desc("event_id"))


def daily_summary(edits: DataFrame) -> DataFrame:
    return (
        edits.groupBy(F.to_date(_user_time()).alias("date"), "domain")
        .agg(
            F.count("*").alias("total_events"),
            F.count_if(F.col("type") == "edit").alias("edits"),
            F.count_if(F.col("type") == "new").alias("new_pages"),
            F.count_if("bot").alias("bot_events"),
            F.count_distinct("user").alias("unique_users"),
        )
        .orderBy(F.desc("date"), "domain")
    )
