"""Edit-shaped views of the given ``events`` and ``documents`` tables.

``edits`` is the typed table, ``raw_lines`` the nested JSON events with planned faults, and
``flat_lines`` flat JSON records with planned faults. Event ``i`` takes the whole text of
document ``i % count(documents)``.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.schemas import EDIT_FIELDS
from editstream.session import configure

SNIPPETS = [
    "",
    " see turn0search0",
    " ref utm_source=chatgpt.com",
    ' {"attribution":{"attributableIndex":"0-1"}}',
    " As an AI language model, I cannot",
    " per OpenAI use policy",
    " great 🎉",
    " plan 🧭 next",
    " [Entertainer's Name] joined",
    " [URL of source here]",
    " Up to my last training update",
    " Certainly! Let me know",
    " **bold** text",
    " **bold** with '''wiki'''",
    "\n# Heading",
    " a — b — c — d",
    " nestled and breathtaking",
    " plays a vital role",
    " a testament to courage",
    " nestled — plays a vital role **x**",
    " mark 🏻 face ☺",
    " would you like",
    " unclosed ** marker",
]


#: About how much text a task shapes. Events are narrow and their documents are not, so the sizes of the
#: files say little of what a join of the two puts out.
TASK_CHARS = 512 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_and_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    configure(spark)
    return table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")


def join_documents(
    events: DataFrame, documents: DataFrame, count: Column, parts: int | None = None, texts: bool = True
) -> DataFrame:
    """Events with their document. Both sides are cut to what the views use before the join, which
    has ``parts`` tasks if that is given. Without ``texts`` that of the document is NULL."""
    text = F.col("text") if texts else F.lit(None).cast("string")
    docs = documents.select("doc_id", "lang", "n_chars", text.alias("prose"))
    rows = events.select(
        F.col("event_id").alias("i"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        (F.col("event_id") % count).alias("doc_id"),
    )
    if parts:
        rows, docs = rows.repartition(parts, "doc_id"), docs.repartition(parts, "doc_id")
    return rows.join(docs, "doc_id").drop("doc_id")


def shape_edits(joined: DataFrame) -> DataFrame:
    """The typed edit columns of joined events, with the event number ``i``."""
    i = F.col("i")
    event_type = F.col("event_type")
    edit_type = (
        F.when(event_type.isin("click", "view"), "edit")
        .when(event_type == "signup", "new")
        .when(event_type == "purchase", "log")
        .otherwise("categorize")
    )
    is_edit, is_log = F.col("type").isin("edit", "new"), F.col("type") == "log"
    snippet = F.element_at(
        F.array(*[F.lit(s) for s in SNIPPETS]), (i % len(SNIPPETS) + 1).cast("int")
    )
    rows = joined.withColumn("type", edit_type).withColumn(
        "comment", F.when(is_edit, F.concat("prose", snippet))
    )
    domain = F.concat("lang", F.lit(".example.org"))
    return rows.select(
        "i",
        i.cast("string").alias("evt_id"),
        "type",
        F.concat(F.lit("Page "), (i % 97).cast("string")).alias("title"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user"),
        (F.col("user_id") % 10 == 0).alias("bot"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dt_user"),
        F.date_trunc("SECOND", "ts").alias("dt_server"),
        domain.alias("domain"),
        F.when(i % 10 == 0, 6).otherwise(i % 4).cast("long").alias("ns"),
        F.concat("lang", F.lit("wiki")).alias("wiki"),
        domain.alias("srv_name"),
        F.concat(F.lit("https://"), domain).alias("srv_url"),
        F.when(is_edit, i % 3 == 0).alias("minor"),
        F.when(is_edit, i % 4 == 0).alias("patrolled"),
        F.when(is_edit, F.col("n_chars")).alias("len_old"),
        F.when(is_edit, F.col("n_chars") + i * 37 % 4001 - 1500).alias("len_new"),
        F.when(is_edit, i * 2).alias("rev_old"),
        F.when(is_edit, i * 2 + 1).alias("rev_new"),
        "comment",
        F.when(
            is_edit,
            F.when(i % 5 == 0, F.concat(F.lit("<p>"), F.col("comment"), F.lit("</p>"))).otherwise(""),
        ).alias("parsed_comment"),
        F.when(is_log, "delete").alias("log_type"),
        F.when(is_log, "delete").alias("log_action"),
        F.when(is_log, i).alias("log_id"),
        F.when(is_log, "").alias("log_comment"),
    )


def numbered_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, documents = events_and_documents(spark, sf_dir)
    count = table(spark, sf_dir, "documents").agg(F.count("*")).scalar()
    return shape_edits(join_documents(events, documents, count, join_tasks(events, documents)))


def join_tasks(events: DataFrame, documents: DataFrame) -> int | None:
    """How many tasks the texts of the joined rows need, or None if the session's own number will do.

    A multiple of the cores, so that the last tasks, which are as long as all others, keep all cores busy.
    """
    told = documents.agg(F.avg("n_chars")).first()[0] or 0
    parts = int(events.count() * told / TASK_CHARS)
    cores = events.sparkSession.sparkContext.defaultParallelism
    return ceil(parts / cores) * cores if parts > cores else None


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_edits(spark, sf_dir).select(EDIT_FIELDS)


def edits_without_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`edits` that are no edits or new pages. Their text columns are NULL, so the
    documents' texts stay out of the join, which a filter on the type would not see to."""
    events, documents = events_and_documents(spark, sf_dir)
    count = table(spark, sf_dir, "documents").agg(F.count("*")).scalar()
    rows = shape_edits(join_documents(events, documents, count, texts=False))
    return rows.where(~F.col("type").isin("edit", "new")).select(EDIT_FIELDS)


def _json(column: Column) -> Column:
    """A column as a JSON value; NULL stays NULL."""
    wrapped = F.to_json(F.struct(column.alias("v")))
    # Cut as bytes: positions in a text are found by counting its characters.
    inner = F.substr(wrapped.cast("binary"), F.lit(6), F.octet_length(wrapped) - 6)
    return F.when(column.isNotNull(), inner.cast("string"))


def _member(key: str, json: Column) -> Column:
    return F.concat(F.lit(f'"{key}":'), json)


def _object(*members: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def shape_raw_lines(rows: DataFrame) -> DataFrame:
    """``value``: nested event JSON with a fault chosen by ``i % 50``; ``i`` is kept."""
    fault = F.col("i") % 50
    is_edit = F.col("type").isin("edit", "new")

    def faulty(json: Column, **faults: str | Column | None) -> Column:
        """``json``, replaced for fault ``f<n>`` by a JSON text (``None``: the key is absent)."""
        for key, replacement in faults.items():
            new = replacement if isinstance(replacement, Column) else F.lit(replacement)
            json = F.when(fault == int(key[1:]), new).otherwise(json)
        return json

    comment = F.when(
        fault == 21,
        F.expr("repeat(comment, cast(1000 div char_length(comment) + 1 as int))"),
    ).otherwise(F.col("comment"))
    previous_id = _json((F.col("i") - 1).cast("string"))
    meta = _object(
        _member("id", faulty(_json(F.col("evt_id")), f19="null", f22=previous_id)),
        _member("dt", faulty(_json(F.col("dt_user")), f3=None)),
        _member("domain", faulty(_json(F.col("domain")), f6='"canary"', f7="null")),
    )
    seconds = _json(F.unix_timestamp("dt_server"))
    length = _object(_member("old", _json(F.col("len_old"))), _member("new", _json(F.col("len_new"))))
    revision = _object(
        _member("old", _json(F.col("rev_old"))), _member("new", _json(F.col("rev_new")))
    )
    event = _object(
        _member("meta", faulty(meta, f1=None, f2='"x"')),
        _member("type", faulty(_json(F.col("type")), f4='"invalid_type"', f5="5")),
        _member("title", faulty(_json(F.col("title")), f9="123", f10="null")),
        _member("user", faulty(_json(F.col("user")), f20=None)),
        _member("bot", faulty(_json(F.col("bot")), f14="1")),
        _member(
            "timestamp",
            faulty(seconds, f15=_json(F.col("dt_user")), f23='"not a time"', f24="99999999999999"),
        ),
        _member("namespace", faulty(_json(F.col("ns")), f8='"zero"', f13="6", f16="true", f18="1.5")),
        _member("wiki", _json(F.col("wiki"))),
        _member("server_name", _json(F.col("srv_name"))),
        _member("server_url", _json(F.col("srv_url"))),
        _member("minor", F.when(is_edit, faulty(_json(F.col("minor")), f12='"false"'))),
        _member("patrolled", _json(F.col("patrolled"))),
        _member("length", faulty(F.when(is_edit, length), f11="null")),
        _member("revision", F.when(is_edit, revision)),
        _member("comment", _json(comment)),
        _member("parsedcomment", _json(F.col("parsed_comment"))),
        _member("log_type", _json(F.col("log_type"))),
        _member("log_action", _json(F.col("log_action"))),
        _member("log_id", _json(F.col("log_id"))),
        _member("log_action_comment", _json(F.col("log_comment"))),
        _member("log_params", F.when(fault == 13, '{"img_name":"x.png"}')),
        _member("future", F.when(fault == 17, "1")),
    )
    cut = F.when(fault == 0, F.substr(F.col("whole"), F.lit(1), F.length("whole") - 1))
    return rows.select("i", event.alias("whole")).select("i", cut.otherwise(F.col("whole")).alias("value"))


def numbered_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_raw_lines(numbered_edits(spark, sf_dir))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_raw_lines(spark, sf_dir).select("value")


def shape_flat_lines(rows: DataFrame) -> DataFrame:
    """``value``: flat record JSON with a fault chosen by ``i % 20``; ``i`` is kept."""
    fault = F.col("i") % 20
    members = []
    for name in EDIT_FIELDS:
        column = F.unix_timestamp("dt_server") if name == "dt_server" else F.col(name)
        json = _json(column)
        if name == "evt_id":
            json = F.when(fault == 0, None).when(fault == 1, '""').otherwise(json)
        if name == "domain":
            json = F.when(fault == 10, None).otherwise(json)
        if name == "ns":
            json = (
                F.when(fault == 4, '"5"')
                .when(fault == 6, '"123.0"')
                .when(fault == 7, '"5d"')
                .when(fault == 10, '"x"')
                .otherwise(json)
            )
        if name == "bot":
            json = F.when(fault == 5, "1").when(fault == 11, '"yes"').otherwise(json)
        if name == "title":
            json = F.when(fault == 8, F.lit('"\\t' + "t" * 600 + '"')).otherwise(json)
        members.append(_member(name, json))
    members += [F.when(fault == 9, '"a":1'), F.when(fault == 9, '"b":2')]
    value = F.when(fault == 2, "{}").when(fault == 3, "[1]").otherwise(_object(*members))
    return rows.select("i", value.alias("value"))


def numbered_flat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_flat_lines(numbered_edits(spark, sf_dir))


def flat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_flat_lines(spark, sf_dir).select("value")
