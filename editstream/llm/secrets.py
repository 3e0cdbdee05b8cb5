"""Secret scan with corpus-wide ownership of the values found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.common import same, stage, table

# Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"  # the runs that AKIA[A-Z0-9]+ finds, if of 20 characters or more
HEX = "[0-9a-f]{24,}"  # likewise
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
KINDS = ["assign", "access", "hex", "live", "example"]
MIN_ASSIGNED = 6


def matches(text: Column, kind: str) -> Column:
    """All matches of a kind as ``array<struct<at, upto, value>>``, in code points.

    Spark tells what a pattern matched, but not where; the lengths of the pieces between matches
    and of the matches add up to the places.
    """
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<at:int,upto:int,value:string>>").alias("spans"),
    )

    def step(done: Column, piece: Column) -> Column:
        at = done["at"] + F.char_length(piece["gap"])
        upto = at + F.char_length(piece["hit"])
        value = piece["hit"]
        if kind == "assign":
            value = F.regexp_extract(piece["hit"], pattern, 2)
        span = F.struct(at.alias("at"), upto.alias("upto"), value.alias("value"))
        return F.struct(
            upto.alias("at"), F.array_append(done["spans"], span).alias("spans")
        )

    pieces = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        found,
        lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")),
    )
    spans = F.aggregate(pieces, start, step, lambda done: done["spans"])
    if kind == "assign":
        spans = F.filter(spans, lambda s: F.char_length(s["value"]) >= MIN_ASSIGNED)
    return F.when(text.rlike(pattern), spans).otherwise(start["spans"])


def spelled(spans: Column) -> Column:
    """``kind:start:end`` by start, then by kind as listed, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["at"], s["upto"]),
    )
    return F.concat_ws(",", texts)


def random_looking(value: Column, min_chars: int, min_distinct: int) -> Column:
    return (
        (F.char_length(value) >= min_chars)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= min_distinct)
    )


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    example_owners: int = 3,
    min_chars: int = 16,
    min_distinct: int = 8,
) -> DataFrame:
    """Spans of secrets, and of their values that look live or are examples.

    Base spans are the matches of the patterns. A document is a repository, ``owner_col`` its owner.
    Every value found (what is assigned, or the whole match) is hashed and counted over the corpus:
    a value with ``example_owners`` owners or more is a widely copied ``example``; one with fewer,
    of at least ``min_chars`` characters, with letters, digits and ``min_distinct`` different
    characters, is ``live``. Both get a span of the value besides the base spans, which all stay.

    One row per document id and text (rows that repeat both are one row for each, and one
    repository). Null texts count as empty; a null owner or id counts as one more owner or
    repository. Returns ``doc, print, base`` and ``spans`` (arrays of ``at, kind, upto``), with
    ``n_assign, n_access, n_hex, n_live, n_example``.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    found = stage(
        docs.select(
            docs[id_col].alias("doc"),
            docs[owner_col].alias("owner"),
            F.xxhash64(text).alias("print"),
            *[matches(text, kind).alias(kind) for kind in PATTERNS],
        ),
        "secrets",
    )

    def typed(kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                s["at"].alias("at"), F.lit(KINDS.index(kind)).alias("kind"), s["upto"].alias("upto")
            ),
        )

    every = found.select(
        "doc", "owner", "print", F.explode(F.concat(*PATTERNS)).alias("span")
    ).select(
        "doc",
        "owner",
        "print",
        F.sha2("span.value", 256).alias("hash"),
        (F.col("span.upto") - F.char_length("span.value")).alias("at"),
        F.col("span.upto").alias("upto"),
        random_looking(F.col("span.value"), min_chars, min_distinct).alias("random"),
    )
    owned = (
        every.select("hash", "owner", "doc")
        .distinct()
        .groupBy("hash", "owner")
        .agg(F.count(F.lit(1)).alias("repos"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))
    )
    kind = F.when(F.col("owners") >= example_owners, KINDS.index("example")).when(
        F.col("random"), KINDS.index("live")
    )
    added = (
        every.join(owned, "hash")
        .withColumn("kind", kind)
        .where(F.col("kind").isNotNull())
        .groupBy("doc", "print")
        .agg(F.collect_set(F.struct("at", "kind", "upto")).alias("more"))
        .withColumnsRenamed({"doc": "doc_2", "print": "print_2"})
    )
    rows = found.select(
        "doc",
        "print",
        F.concat(*[typed(k) for k in PATTERNS]).alias("base"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS],
    )
    joined = rows.join(
        added,
        same(F.col("doc"), F.col("doc_2")) & (F.col("print") == F.col("print_2")),
        "left",
    )
    more = F.coalesce("more", F.array().cast("array<struct<at:int,kind:int,upto:int>>"))

    def number(kind: str) -> Column:
        return F.size(F.filter(more, lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return joined.select(
        "doc",
        "print",
        "base",
        F.concat("base", more).alias("spans"),
        *[f"n_{k}" for k in PATTERNS],
        number("live").alias("n_live"),
        number("example").alias("n_example"),
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).select(
        F.col("doc").alias("doc_id"),
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.encode(spelled(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
        "n_live",
        "n_example",
    )


SQL = r"""
WITH pats(kind, no, p) AS (VALUES
  ('assign', 0, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  ('access', 1, 'AKIA[A-Z0-9]+'),
  ('hex', 2, '[0-9a-f]{24,}')),
hits AS (
  SELECT doc_id, source, 'assign' AS kind, 0 AS no, unnest(regexp_extract_all(t, p, 0)) AS hit,
         unnest(string_split_regex(t, p)[:len(regexp_extract_all(t, p, 0))]) AS gap,
         generate_subscripts(regexp_extract_all(t, p, 0), 1) AS i
  FROM (SELECT doc_id, source, coalesce(text, '') AS t, (SELECT p FROM pats WHERE kind = 'assign') AS p FROM documents)
  UNION ALL
  SELECT doc_id, source, 'access', 1, unnest(regexp_extract_all(t, p, 0)),
         unnest(string_split_regex(t, p)[:len(regexp_extract_all(t, p, 0))]),
         generate_subscripts(regexp_extract_all(t, p, 0), 1)
  FROM (SELECT doc_id, source, coalesce(text, '') AS t, (SELECT p FROM pats WHERE kind = 'access') AS p FROM documents)
  UNION ALL
  SELECT doc_id, source, 'hex', 2, unnest(regexp_extract_all(t, p, 0)),
         unnest(string_split_regex(t, p)[:len(regexp_extract_all(t, p, 0))]),
         generate_subscripts(regexp_extract_all(t, p, 0), 1)
  FROM (SELECT doc_id, source, coalesce(text, '') AS t, (SELECT p FROM pats WHERE kind = 'hex') AS p FROM documents)),
placed AS (
  SELECT doc_id, source, kind, no, hit,
         sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, no ORDER BY i) AS upto,
         CASE WHEN no = 0 THEN regexp_extract(hit, (SELECT p FROM pats WHERE kind = 'assign'), 2) ELSE hit END AS value
  FROM hits),
base AS (
  SELECT doc_id, source, kind, no, value, (upto - length(hit))::BIGINT AS b, upto::BIGINT AS upto
  FROM placed
  WHERE (no = 0 AND length(value) >= 6) OR (no = 1 AND length(hit) >= 20) OR no = 2),
owned AS (
  SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners FROM base GROUP BY value),
more AS (
  SELECT DISTINCT doc_id, CASE WHEN owners >= 3 THEN 'example' ELSE 'live' END AS kind,
         CASE WHEN owners >= 3 THEN 4 ELSE 3 END AS no, upto - length(v.value) AS b, upto
  FROM base v JOIN owned o ON v.value = o.value
  WHERE owners >= 3 OR (length(v.value) >= 16 AND regexp_matches(v.value, '[0-9]')
    AND regexp_matches(v.value, '[A-Za-z]') AND len(list_distinct(string_split(v.value, ''))) >= 8)),
listed AS (
  SELECT doc_id, true AS base, no, kind, b, upto FROM base
  UNION ALL SELECT doc_id, false, no, kind, b, upto FROM more)
SELECT d.doc_id,
       count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || b || ':' || upto, ',' ORDER BY b, no) FILTER (base), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || b || ':' || upto, ',' ORDER BY b, no, upto), '') AS spans,
       count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (kind = 'example') AS n_example
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN listed l ON d.doc_id = l.doc_id
GROUP BY d.doc_id
"""
