"""The same queries as SQL over the given tables, written from the definitions of the views.

The raw and flat views are not parsed here: what becomes of a line is told by its number, so the
SQL does not repeat the logic it checks.
"""

from __future__ import annotations

from itertools import combinations

from editstream.functions import rulebook as R
from editstream.schemas import DECLARED, EDIT_FIELDS, REQUIRED_COLUMNS
from editstream.sources.tables import SCAN_COLUMNS
from editstream.sources.views import SNIPPETS

ORACLES: dict[str, str] = {}


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def ts_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


SNIPPET_LIST = "[" + ", ".join(text(s) for s in SNIPPETS) + "]"

EDITS = f"""
base AS (
  SELECT e.event_id AS i, e.ts, e.user_id, e.event_type, d.lang, d.n_chars,
         d.text AS prose
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
),
kinds AS (
  SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 'edit'
                 WHEN event_type = 'signup' THEN 'new'
                 WHEN event_type = 'purchase' THEN 'log'
                 ELSE 'categorize' END AS type
  FROM base
),
marked AS (
  SELECT *, type IN ('edit', 'new') AS is_edit, type = 'log' AS is_log,
         CASE WHEN type IN ('edit', 'new')
              THEN prose || list_extract({SNIPPET_LIST}, i % {len(SNIPPETS)} + 1) END AS comment
  FROM kinds
),
edits AS (
  SELECT i, CAST(i AS VARCHAR) AS evt_id, type, 'Page ' || (i % 97) AS title,
         'user' || user_id AS "user", user_id % 10 = 0 AS bot,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS dt_user,
         date_trunc('second', ts) AS dt_server, lang || '.example.org' AS domain,
         CAST(CASE WHEN i % 10 = 0 THEN 6 ELSE i % 4 END AS BIGINT) AS ns, lang || 'wiki' AS wiki,
         lang || '.example.org' AS srv_name, 'https://' || lang || '.example.org' AS srv_url,
         CASE WHEN is_edit THEN i % 3 = 0 END AS minor,
         CASE WHEN is_edit THEN i % 4 = 0 END AS patrolled,
         CASE WHEN is_edit THEN n_chars END AS len_old,
         CASE WHEN is_edit THEN n_chars + i * 37 % 4001 - 1500 END AS len_new,
         CASE WHEN is_edit THEN i * 2 END AS rev_old,
         CASE WHEN is_edit THEN i * 2 + 1 END AS rev_new,
         comment,
         CASE WHEN is_edit THEN CASE WHEN i % 5 = 0 THEN '<p>' || comment || '</p>' ELSE '' END END
           AS parsed_comment,
         CASE WHEN is_log THEN 'delete' END AS log_type,
         CASE WHEN is_log THEN 'delete' END AS log_action,
         CASE WHEN is_log THEN i END AS log_id,
         CASE WHEN is_log THEN '' END AS log_comment,
         is_edit, is_log
  FROM marked
)"""

# What the raw lines hold after decoding and flattening; `fate` is what becomes of a line.
RAW = f"""{EDITS},
raw AS (
  SELECT * REPLACE (
           CASE WHEN f = 19 THEN NULL WHEN f = 22 THEN CAST(i - 1 AS VARCHAR) ELSE evt_id END
             AS evt_id,
           CASE WHEN f IN (9, 10) THEN NULL ELSE title END AS title,
           CASE WHEN f = 20 THEN '' ELSE "user" END AS "user",
           CASE WHEN f = 14 THEN NULL ELSE bot END AS bot,
           CASE WHEN f = 7 THEN NULL ELSE domain END AS domain,
           CASE WHEN f IN (8, 18) THEN NULL WHEN f = 13 THEN 6 WHEN f = 16 THEN 1 ELSE ns END AS ns,
           CASE WHEN f = 12 AND is_edit THEN true ELSE minor END AS minor,
           CASE WHEN f IN (23, 24) THEN NULL ELSE dt_server END AS dt_server,
           CASE WHEN f = 21 THEN repeat(comment, CAST(1000 // length(comment) + 1 AS BIGINT))
                ELSE comment END AS comment
         ),
         CASE WHEN f = 0 THEN 'DECODE_ERROR' WHEN f IN (1, 2) THEN 'BAD_META'
              WHEN f = 3 THEN 'MISSING_META_FIELD' WHEN f IN (4, 5) THEN 'BAD_TYPE'
              WHEN f = 6 THEN 'CANARY' ELSE 'OK' END AS reason,
         CASE WHEN f <= 6 THEN 'dropped' WHEN f = 11 AND is_edit THEN 'malformed'
              WHEN f IN (7, 8, 9, 14, 18, 19, 23, 24) THEN 'invalid' ELSE 'valid' END AS fate
  FROM (SELECT *, i % 50 AS f, dt_server AS sent FROM edits)
)"""

FLAT = f"""{EDITS},
flat AS (SELECT *, i % 20 AS g FROM edits)"""


def any_of(phrases: list[str], column: str = "lt") -> str:
    return "(" + " OR ".join(f"contains({column}, {text(p)})" for p in phrases) + ")"


EMOJI_CLASS = (
    "["
    + "".join(
        "-".join(rf"\x{{{end}}}" for end in part.split("-")) for part in R.EMOJI_RANGES.split()
    )
    + "]"
)
DASHES = (
    f"(length(t) > 0 AND (length(t) - length(replace(t, '{R.EM_DASH}', ''))) * 1000.0"
    " / greatest(length(t), 1) > 2)"
)
PLACEHOLDER = f"regexp_matches(t, {text('(?i)' + R.PLACEHOLDER_PATTERN)})"
MARKDOWN = (
    f"(regexp_matches(t, {text('(?m)' + R.MARKDOWN_PATTERN)})"
    f" AND NOT regexp_matches(t, {text(R.MARKDOWN_EXCLUDE)}))"
)
MARKDOWN_LETTERS = "(contains(t, '**') AND NOT contains(t, ''''''''))"
EMOJI_FIXED = f"regexp_matches(t, {text(R.EMOJI_PATTERN_1_0_2)})"

CONDITIONS = {
    "1.0.3": {
        "chatgpt_artifacts": any_of(R.ARTIFACTS),
        "chatgpt_attribution": any_of(R.ATTRIBUTION),
        "prompt_refusal": any_of(R.REFUSAL),
        "emoji_in_headings": f"regexp_matches(t, '{EMOJI_CLASS}')",
        "placeholder_templates": PLACEHOLDER,
        "knowledge_cutoff_disclaimers": any_of(R.CUTOFF),
        "collaborative_communication": any_of(R.COLLABORATIVE),
        "markdown_syntax": MARKDOWN,
        "excessive_em_dashes": DASHES,
        "promotional_language": any_of(R.PROMOTIONAL),
        "importance_emphasis": any_of(R.IMPORTANCE),
    }
}
CONDITIONS["1.0.2"] = {**CONDITIONS["1.0.3"], "emoji_in_headings": EMOJI_FIXED}
CONDITIONS["1.0.0"] = {
    "chatgpt_artifacts": "(contains(lt, 'turn0search') OR contains(lt, 'oaicite:'))",
    "chatgpt_urls": "contains(lt, 'utm_source=chatgpt.com')",
    "prompt_refusal": any_of(R.REFUSAL_1_0_0),
    "markdown_syntax": MARKDOWN_LETTERS,
    "excessive_em_dashes": DASHES,
    "promotional_language": any_of(R.PROMOTIONAL),
    "importance_emphasis": any_of(R.IMPORTANCE_1_0_0),
}
CONDITIONS["1.0.1"] = {
    "chatgpt_artifacts": CONDITIONS["1.0.0"]["chatgpt_artifacts"],
    "chatgpt_urls": CONDITIONS["1.0.0"]["chatgpt_urls"],
    "prompt_refusal": any_of(R.REFUSAL_1_0_0),
    "knowledge_cutoff_disclaimers": any_of(R.CUTOFF),
    "collaborative_communication": any_of(R.COLLABORATIVE),
    "markdown_syntax": MARKDOWN_LETTERS,
    "excessive_em_dashes": DASHES,
    "promotional_language": any_of(R.PROMOTIONAL),
    "importance_emphasis": any_of(R.IMPORTANCE),
}
VERSIONS = ["1.0.0", "1.0.1", "1.0.2", "1.0.3"]


def flag_list(conditions: dict[str, str]) -> str:
    """The raised flags joined by ``|``; '' for none."""
    cases = ", ".join(f"CASE WHEN {c} THEN '{flag}' END" for flag, c in conditions.items())
    return f"concat_ws('|', {cases})"


def scanned(source: str, columns: list[str], where: str = "true") -> str:
    parts = ", ".join(f"nullif({c}, '')" for c in columns)
    return f"""
texts AS (SELECT *, concat_ws(' ', {parts}) AS t FROM {source} WHERE {where}),
scanned AS (SELECT *, lower(t) AS lt FROM texts)"""


EDIT_TEXT = ["comment", "parsed_comment", "title"]


def edit_scan(conditions: dict[str, str]) -> str:
    return f"""WITH {EDITS},{scanned('edits', EDIT_TEXT)},
flagged AS (
  SELECT * FROM (SELECT *, {flag_list(conditions)} AS flags FROM scanned) WHERE flags <> ''
)"""


FLAGGED = edit_scan(CONDITIONS["1.0.3"])
FLAG_ROWS = f"""{FLAGGED},
flag_rows AS (SELECT i, unnest(string_split(flags, '|')) AS flag FROM flagged)"""


def column_list(names: list[str] = EDIT_FIELDS, **replaced: str) -> str:
    """Select list in scalar columns: times as text."""
    items = []
    for name in names:
        value = replaced.get(name) or (ts_text(name) if name == "dt_server" else f'"{name}"')
        items.append(f'{value} AS "{name}"')
    return ", ".join(items)


# --- Ingest and projections ---------------------------------------------------------------------

_REASONS = f"WITH {RAW} SELECT reason, count(*) AS events FROM raw GROUP BY reason"
ORACLES["ingest_reject_counts"] = _REASONS
ORACLES["event_stream_payloads"] = _REASONS
# A line whose type is replaced is not seen as a log line, and stays whole.
ORACLES["decoded_bytes"] = f"""WITH {RAW}
SELECT CASE WHEN is_log AND f NOT IN (4, 5) THEN 'DECODE_ERROR' ELSE reason END AS reason,
       count(*) AS events FROM raw GROUP BY 1"""
ORACLES["media_strip"] = f"""WITH {RAW}
SELECT evt_id, false AS keeps_payload,
       10 + CASE WHEN is_edit THEN 6 WHEN is_log THEN 4 ELSE 0 END
          + CASE WHEN f = 17 OR (f = 11 AND NOT is_edit) THEN 1 WHEN f = 20 THEN -1 ELSE 0 END
          AS keys
FROM raw WHERE reason = 'OK'"""



def accepted(select: str) -> str:
    return f"WITH {RAW} SELECT {select} FROM raw WHERE reason = 'OK'"


ORACLES["core_projection"] = accepted(column_list(EDIT_FIELDS[:12]))
_BAD_LENGTH = "f = 11 AND is_edit"
_EDIT_DEFAULTS = {
    "minor": "CASE WHEN f = 12 AND is_edit THEN NULL ELSE coalesce(minor, false) END",
    "patrolled": "coalesce(patrolled, false)",
    "len_old": f"CASE WHEN {_BAD_LENGTH} THEN 0 ELSE coalesce(len_old, 0) END",
    "len_new": f"CASE WHEN {_BAD_LENGTH} THEN 0 ELSE coalesce(len_new, 0) END",
    "rev_old": "coalesce(rev_old, 0)",
    "rev_new": "coalesce(rev_new, 0)",
    "comment": "coalesce(comment, '')",
    "parsed_comment": "coalesce(parsed_comment, '')",
}
ORACLES["edit_projection"] = accepted(
    column_list(["evt_id", *EDIT_FIELDS[12:20]], **_EDIT_DEFAULTS)
)
ORACLES["log_projection"] = accepted(
    column_list(
        ["evt_id", *EDIT_FIELDS[20:]],
        log_type="coalesce(log_type, '')",
        log_action="coalesce(log_action, '')",
        log_id="coalesce(log_id, 0)",
        log_comment="coalesce(log_comment, '')",
    )
)
ORACLES["content_projection"] = accepted(
    column_list(
        ["evt_id", "comment", "parsed_comment", "title", "user", "len_old", "len_new", "minor", "bot"],
        **_EDIT_DEFAULTS,
    )
)
ORACLES["boolean_cleaning"] = f"""WITH {RAW}
SELECT type, minor, patrolled, coalesce(bot, true) AS bot, count(*) AS events
FROM raw WHERE reason = 'OK' GROUP BY ALL"""
_VALID_EDITS = f"WITH {RAW} SELECT {column_list()} FROM raw WHERE fate = 'valid'"
ORACLES["flat_edits"] = _VALID_EDITS
ORACLES["streamed_edits"] = _VALID_EDITS
_FLAT_TEXT = {
    "title": "CASE WHEN f = 9 THEN '123' ELSE title END",
    "bot": "CASE WHEN f = 14 THEN '1' ELSE CAST(bot AS VARCHAR) END",
    "ns": "CASE f WHEN 8 THEN 'zero' WHEN 16 THEN 'true' WHEN 18 THEN '1.5' ELSE CAST(ns AS VARCHAR) END",
    "dt_server": "CASE f WHEN 15 THEN dt_user WHEN 23 THEN 'not a time' WHEN 24 THEN '99999999999999'"
    " ELSE CAST(epoch(sent)::BIGINT AS VARCHAR) END",
}
_FLAT_COLUMNS = ", ".join(
    _FLAT_TEXT.get(n, f'CAST("{n}" AS VARCHAR)') + f' AS "{n}"' for n in EDIT_FIELDS
)
ORACLES["json_lines_round_trip"] = f"""WITH {RAW}
SELECT {_FLAT_COLUMNS} FROM raw WHERE fate IN ('valid', 'invalid')"""
ORACLES["published_messages"] = f"""WITH {EDITS}
SELECT evt_id, md5(comment) AS comment_md5, log_id IS NULL AS log_id_is_null FROM edits"""

# --- Rules ----------------------------------------------------------------------------------------

for _flag, _condition in CONDITIONS["1.0.3"].items():
    ORACLES[f"rule_{_flag}"] = f"""WITH {EDITS},{scanned('edits', EDIT_TEXT)}
SELECT evt_id, domain FROM scanned WHERE {_condition}"""
ORACLES["rule_emoji_fixed_class"] = f"""WITH {EDITS},{scanned('edits', EDIT_TEXT)}
SELECT evt_id, domain FROM scanned WHERE {EMOJI_FIXED}"""
for _version in VERSIONS:
    ORACLES["flags_" + _version.replace(".", "_")] = f"""{edit_scan(CONDITIONS[_version])}
SELECT evt_id, flags AS flag_types FROM flagged"""
_OWN_RULES = {
    "prompt_refusal": "contains(lt, 'as an ai language model')",
    "markdown_syntax": f"regexp_matches(t, {text('(?m)' + R.MARKDOWN_PATTERN)})",
    "excessive_em_dashes": DASHES,
    "spam_indicators":
        "(contains(lt, 'buy now') OR contains(lt, 'joined') OR contains(lt, 'guaranteed results'))",
    "self_promotion": "(contains(lt, 'visit my website') OR contains(lt, 'plan '))",
}
ORACLES["custom_rule_flags"] = f"""{edit_scan(_OWN_RULES)}
SELECT evt_id, flags AS flag_types FROM flagged"""

ORACLES["phrase_book_hits"] = f"""WITH {EDITS},{scanned('edits', EDIT_TEXT)},
book AS (
  SELECT 'item ' || item_id AS category, lower(substr(text, 1, 30)) AS phrase FROM benchmark
  UNION ALL SELECT 'short', unnest(['**', 'ü', 'vital', '☺'])
)
SELECT DISTINCT evt_id, category FROM scanned JOIN book ON contains(lt, phrase)
WHERE phrase <> ''"""

_ALL_FLAGS = sorted({flag for c in CONDITIONS.values() for flag in c})
_BY_VERSION = " UNION ALL ".join(
    f"SELECT i, '{v}' AS version, '{flag}' AS flag, {CONDITIONS[v].get(flag, 'false')} AS hit"
    " FROM scanned"
    for v in VERSIONS
    for flag in _ALL_FLAGS
)
_STEPS = ", ".join(f"('{a}', '{b}')" for a, b in zip(VERSIONS, VERSIONS[1:]))
ORACLES["rule_version_changes"] = f"""WITH {EDITS},{scanned('edits', EDIT_TEXT)},
hits AS ({_BY_VERSION}),
steps(from_version, to_version) AS (VALUES {_STEPS})
SELECT from_version, to_version, o.flag AS flag,
       CASE WHEN n.hit THEN 'gained' ELSE 'lost' END AS change, count(*) AS events
FROM steps JOIN hits o ON o.version = from_version
JOIN hits n ON n.version = to_version AND n.i = o.i AND n.flag = o.flag
WHERE o.hit <> n.hit GROUP BY ALL"""

_SAMPLE = "substr(coalesce(comment, ''), 1, 500)"
ORACLES["flagged_events"] = f"""{FLAGGED}
SELECT evt_id AS event_id, '1.0.3' AS rule_version, {ts_text('dt_server')} AS detection_timestamp,
       dt_user AS "timestamp", "user", title, domain, ns AS namespace, type AS edit_type,
       flags AS ai_flags, {_SAMPLE} AS content_sample_comment, title AS content_sample_title,
       length(t) AS content_sample_text_length,
       length(flags) - length(replace(flags, '|', '')) + 1 AS detection_metadata_total_flags,
       flags AS detection_metadata_flag_types,
       {ts_text('dt_server')} AS detection_metadata_detected_at,
       '1.0.3' AS detection_metadata_rule_version
FROM flagged"""
_RAW_FLAGGED = f"""WITH {RAW},{scanned('raw', EDIT_TEXT, "fate IN ('valid', 'invalid')")}
SELECT coalesce(evt_id, '') AS event_id, coalesce(title, '') AS title,
       coalesce(ns, 0) AS namespace, flags AS ai_flags,
       {_SAMPLE} AS content_sample_comment, coalesce(title, '') AS content_sample_title,
       length(t) AS content_sample_text_length
FROM (SELECT *, {flag_list(CONDITIONS['1.0.3'])} AS flags FROM scanned) WHERE flags <> ''"""
for _name in ("flagged_raw_events", "streamed_flagged", "batch_routed_flagged"):
    ORACLES[_name] = _RAW_FLAGGED
ORACLES["custom_rules_routed"] = f"""WITH {RAW},{scanned('raw', EDIT_TEXT, "fate IN ('valid', 'invalid')")}
SELECT coalesce(evt_id, '') AS event_id, 'own-1' AS rule_version, flags AS flag_types
FROM (SELECT *, {flag_list(_OWN_RULES)} AS flags FROM scanned) WHERE flags <> ''"""
ORACLES["routed_without_detection"] = f"""WITH {RAW}
SELECT 'edits' AS route, count(*) AS rows FROM raw WHERE fate = 'valid'
UNION ALL SELECT 'dead_letter', count(*) FROM raw WHERE fate IN ('invalid', 'malformed')
UNION ALL SELECT 'flagged', 0"""
ORACLES["flagged_json_members"] = f"""{FLAGGED}
SELECT evt_id AS event_id, array_to_string(list_sort(string_split(flags, '|')), '|') AS ai_flags,
       {_SAMPLE} AS comment, title, length(t) AS text_length,
       length(flags) - length(replace(flags, '|', '')) + 1 AS total_flags, 4 AS members,
       flags AS flag_types, {ts_text('dt_server')} AS detected_at, '1.0.3' AS rule_version
FROM flagged"""
ORACLES["flagged_json_columns"] = f"""{FLAGGED}
SELECT evt_id AS event_id,
       '{{"' || replace(flags, '|', '":true,"') || '":true}}' AS ai_flags FROM flagged"""


def text_flags(table: str, column: str, ids: str) -> str:
    return f"""WITH {scanned(table, [column])}
SELECT {ids}, flags AS flag_types, length(t) AS text_length
FROM (SELECT *, {flag_list(CONDITIONS['1.0.3'])} AS flags FROM scanned) WHERE flags <> ''"""


ORACLES["document_flags"] = text_flags("documents", "text", "doc_id")
ORACLES["conversation_flags"] = text_flags("conversations", "text", "conv_id, turn")
ORACLES["page_flags"] = text_flags("pages", "html", "page_id")

ORACLES["route_counts"] = f"""WITH {RAW},{scanned('raw', EDIT_TEXT, "fate <> 'dropped'")},
rows AS (
  SELECT fate, CASE WHEN fate <> 'malformed' THEN {flag_list(CONDITIONS['1.0.3'])} ELSE '' END
         AS flags FROM scanned
)
SELECT 'edits' AS route, count(*) AS rows FROM rows WHERE fate = 'valid'
UNION ALL SELECT 'dead_letter', count(*) FROM rows WHERE fate <> 'valid'
UNION ALL SELECT 'flagged', count(*) FROM rows WHERE flags <> ''"""

# --- Validation --------------------------------------------------------------------------------------

_FAULTS = """(VALUES
  (7, 'domain', 'STRING', 'None', 'Expected string for domain, got NoneType'),
  (8, 'ns', 'INT64', 'zero', 'Expected integer for ns, got str'),
  (9, 'title', 'STRING', '123', 'Expected string for title, got int'),
  (14, 'bot', 'BOOL', '1', 'Expected boolean for bot, got int'),
  (18, 'ns', 'INT64', '1.5', 'Expected integer for ns, got float'),
  (19, 'evt_id', 'STRING', 'None', 'Expected string for evt_id, got NoneType'),
  (23, 'dt_server', 'TIMESTAMP', 'not a time', 'Value of dt_server is no time of the years 1 to 9999'),
  (24, 'dt_server', 'TIMESTAMP', '99999999999999', 'Value of dt_server is no time of the years 1 to 9999')
) AS faults(f, field, expected_type, actual_value, message)"""
ORACLES["validation_errors"] = f"""WITH {RAW}
SELECT CASE WHEN f IN (23, 24) THEN 'VALIDATION_ERROR' ELSE 'TYPE_MISMATCH' END AS category,
       field, expected_type, actual_value, message, count(*) AS errors
FROM raw JOIN {_FAULTS} USING (f) GROUP BY ALL"""


def _dead_column(name: str) -> str:
    fill = {"STRING": "''", "INT64": "0", "BOOL": "false"}.get(
        DECLARED[name], "'1970-01-01 00:00:00'"
    )
    value = ts_text(name) if name == "dt_server" else f'"{name}"'
    absent = "fate = 'malformed'"
    if name in EDIT_FIELDS[12:20]:
        absent += " OR NOT is_edit"
    if name in EDIT_FIELDS[20:]:
        absent += " OR NOT is_log"
    return f"CASE WHEN {absent} THEN {fill} ELSE {value} END"


_DEAD = f"""WITH {RAW}
SELECT {column_list(**{name: _dead_column(name) for name in EDIT_FIELDS})},
       CASE WHEN fate = 'malformed' THEN 'OTHER' WHEN f IN (23, 24) THEN 'VALIDATION_ERROR'
            ELSE 'TYPE_MISMATCH' END AS _error_category,
       '1.0.0' AS _schema_version
FROM raw WHERE fate IN ('malformed', 'invalid')"""
ORACLES["dead_letters"] = _DEAD
ORACLES["streamed_dead_letters"] = _DEAD
ORACLES["dead_letter_details"] = f"SELECT *, category AS _error_category FROM ({ORACLES['validation_errors']})"
ORACLES["dead_letter_payloads"] = f"""WITH {RAW}
SELECT {_FLAT_COLUMNS} FROM raw WHERE fate = 'invalid'"""
ORACLES["malformed_payloads"] = f"""WITH {RAW}
SELECT evt_id, title, 'OTHER' AS _error_category, '_root' AS field, true AS whole
FROM raw WHERE fate = 'malformed'"""

_FLAT_FAULTS = """(VALUES
  (0, 'MISSING_REQUIRED_FIELD', 'evt_id', 'STRING', 'None', 'Required field evt_id is missing'),
  (2, 'MALFORMED_INPUT', '_root', 'DICT', '{}', 'Input is not a valid dictionary'),
  (3, 'MALFORMED_INPUT', '_root', 'DICT', '[1]', 'Input is not a valid dictionary'),
  (4, 'TYPE_MISMATCH', 'ns', 'INT64', '5', 'Expected integer for ns, got str'),
  (5, 'TYPE_MISMATCH', 'bot', 'BOOL', '1', 'Expected boolean for bot, got int'),
  (6, 'TYPE_MISMATCH', 'ns', 'INT64', '123.0', 'Expected integer for ns, got str'),
  (7, 'TYPE_MISMATCH', 'ns', 'INT64', '5d', 'Expected integer for ns, got str'),
  (10, 'MISSING_REQUIRED_FIELD', 'domain', 'STRING', 'None', 'Required field domain is missing'),
  (10, 'TYPE_MISMATCH', 'ns', 'INT64', 'x', 'Expected integer for ns, got str'),
  (11, 'TYPE_MISMATCH', 'bot', 'BOOL', 'yes', 'Expected boolean for bot, got str')
) AS faults(g, category, field, expected_type, actual_value, message)"""
ORACLES["flat_record_errors"] = f"""WITH {FLAT}
SELECT category, field, expected_type, actual_value, message, count(*) AS errors
FROM flat JOIN {_FLAT_FAULTS} USING (g) GROUP BY ALL"""
ORACLES["flat_record_categories"] = f"""WITH {FLAT},
judged AS (
  SELECT CASE WHEN g IN (0, 10) THEN 'MISSING_REQUIRED_FIELD' WHEN g IN (2, 3) THEN 'OTHER'
              WHEN g IN (4, 5, 6, 7, 11) THEN 'TYPE_MISMATCH' ELSE 'VALID' END AS category
  FROM flat
)
SELECT category, category = 'VALID' AS is_valid, count(*) AS records FROM judged GROUP BY ALL"""
ORACLES["required_fields"] = f"""WITH {EDITS}
SELECT field, field <> 'absent' AS column_exists,
       CASE field WHEN 'comment' THEN (SELECT count(*) FROM edits WHERE comment IS NULL)
                  WHEN 'log_id' THEN (SELECT count(*) FROM edits WHERE log_id IS NULL)
                  WHEN 'absent' THEN (SELECT count(*) FROM edits)
                  WHEN 'evt_id' THEN (SELECT count(*) FROM edits WHERE evt_id IS NULL)
                  WHEN 'type' THEN (SELECT count(*) FROM edits WHERE type IS NULL)
                  ELSE (SELECT count(*) FROM edits WHERE domain IS NULL) END
         AS rows_without_value,
       (SELECT count(*) FROM edits) AS rows
FROM (VALUES ('evt_id'), ('type'), ('domain'), ('comment'), ('log_id'), ('absent')) AS n(field)"""
ORACLES["field_type_violations"] = f"""WITH {RAW},
violations(f, edits_only, field, expected, actual) AS (VALUES
  (8, false, 'namespace', 'BIGINT', 'str'), (16, false, 'namespace', 'BIGINT', 'bool'),
  (18, false, 'namespace', 'BIGINT', 'float'), (9, false, 'title', 'STRING', 'int'),
  (10, false, 'title', 'STRING', 'NoneType'), (14, false, 'bot', 'BOOLEAN', 'int'),
  (12, true, 'minor', 'BOOLEAN', 'str'), (15, false, 'timestamp', 'BIGINT', 'str'), (23, false, 'timestamp', 'BIGINT', 'str'))
SELECT field, expected, actual, count(*) AS rows
FROM raw JOIN violations v ON raw.f = v.f AND (is_edit OR NOT edits_only) GROUP BY ALL"""

# --- Clean-up ---------------------------------------------------------------------------------------


def _cut(column: str, limit: int) -> str:
    return f"trim(substr(coalesce({column}, ''), 1, {limit}), e' \\t\\n\\r')"


_CLEAN = {
    "title": "CASE WHEN g = 8 THEN repeat('t', 499) ELSE title END",
    "bot": "CASE WHEN g IN (5, 11) THEN true ELSE bot END",
    "dt_server": "CAST(CAST(epoch(dt_server) AS BIGINT) AS VARCHAR)",
    "ns": "CASE g WHEN 4 THEN 5 WHEN 6 THEN 123 WHEN 7 THEN 0 ELSE ns END",
    "minor": "coalesce(minor, false)",
    "patrolled": "coalesce(patrolled, false)",
    "comment": _cut("comment", 1000),
    "parsed_comment": _cut("parsed_comment", 1000),
    "log_comment": "coalesce(log_comment, '')",
    "log_type": "coalesce(log_type, '')",
    "log_action": "coalesce(log_action, '')",
    **{n: f"coalesce({n}, 0)" for n in ("len_old", "len_new", "rev_old", "rev_new", "log_id")},
}
_IS_VALID = "g NOT IN (0, 1, 2, 3, 10)"


def _clean_column(name: str) -> str:
    value = _CLEAN.get(name, f'"{name}"')
    return f"CASE WHEN {_IS_VALID} THEN {value} END"


ORACLES["cleaned_records"] = f"""WITH {FLAT}
SELECT i, {column_list(**{n: _clean_column(n) for n in EDIT_FIELDS})}, {_IS_VALID} AS is_valid
FROM flat"""
_SCORED = f"""WITH {FLAT},
scored AS (
  SELECT i, domain, g, {_IS_VALID} AS is_valid,
         CASE WHEN g IN (0, 1) THEN 'Required field ''evt_id'' is missing or empty'
              WHEN g = 10 THEN 'Required field ''domain'' is missing or empty'
              WHEN g IN (2, 3) THEN 'Data cannot be empty' ELSE '' END AS errors,
         CASE WHEN g IN (2, 3) THEN '' ELSE concat_ws('|',
           CASE WHEN g = 8 THEN 'Field ''title'' truncated from 601 to 500 chars' END,
           CASE WHEN length(comment) > 1000
                THEN 'Field ''comment'' truncated from ' || length(comment) || ' to 1000 chars' END,
           CASE WHEN length(parsed_comment) > 1000 THEN 'Field ''parsed_comment'' truncated from '
                || length(parsed_comment) || ' to 1000 chars' END,
           CASE WHEN g = 9 THEN 'Unknown fields detected (schema drift): a, b' END) END AS warnings,
         CASE WHEN g IN (2, 3) THEN 0.00 ELSE 1.00
           - CASE WHEN g IN (0, 1, 10) THEN 0.30 ELSE 0.00 END
           - CASE WHEN g = 8 THEN 0.05 ELSE 0.00 END
           - CASE WHEN length(comment) > 1000 THEN 0.05 ELSE 0.00 END
           - CASE WHEN length(parsed_comment) > 1000 THEN 0.05 ELSE 0.00 END
           - CASE WHEN g = 9 THEN 0.10 ELSE 0.00 END END AS score
  FROM flat
)"""
ORACLES["quality_scores"] = f"""{_SCORED}
SELECT i, is_valid, errors, warnings, CAST(score AS DOUBLE) AS quality_score FROM scored"""
# A record without data has no domain.
ORACLES["quality_summary"] = f"""{_SCORED}
SELECT CASE WHEN is_valid THEN domain END AS domain, count(*) AS records,
       count_if(is_valid) AS valid_records,
       CAST(CAST(sum(CAST(score * 100 AS BIGINT)) AS DOUBLE) / 100 / count(*) AS DECIMAL(8, 6))::DOUBLE
         AS avg_score,
       CAST(min(score) AS DOUBLE) AS min_score,
       count_if(errors <> '') AS errors,
       CAST(sum(CASE WHEN warnings = '' THEN 0
                ELSE length(warnings) - length(replace(warnings, '|', '')) + 1 END) AS BIGINT)
         AS warnings
FROM scored GROUP BY 1"""
ORACLES["schema_drift"] = f"""WITH {FLAT}
SELECT field, count(*) AS records FROM flat, (VALUES ('a'), ('b')) AS n(field)
WHERE g = 9 GROUP BY field"""
_SANITIZED = "trim(substr(e'\\t ' || text || e' \\n', 1, 1000), e' \\t\\n\\r')"
ORACLES["sanitized_documents"] = f"""
SELECT doc_id, length({_SANITIZED}) AS chars, md5({_SANITIZED}) AS md5 FROM documents"""
ORACLES["safe_casts"] = """
SELECT event_id,
  CASE event_type WHEN 'click' THEN event_id WHEN 'view' THEN -event_id ELSE -1 END AS as_int,
  CASE event_type WHEN 'click' THEN CAST(event_id AS DOUBLE)
    WHEN 'view' THEN -(event_id + CAST(0.75 AS DOUBLE)) ELSE 0.5 END AS as_float,
  event_type = 'purchase' OR (event_type = 'click' AND event_id = 1) AS as_bool,
  CASE event_type WHEN 'click' THEN CAST(event_id AS VARCHAR)
    WHEN 'view' THEN ' -' || event_id || '.75 ' WHEN 'signup' THEN event_id || 'd'
    WHEN 'purchase' THEN 'Yes' ELSE 'none' END AS as_str
FROM events"""

# --- Stored queries ----------------------------------------------------------------------------------

_E = f"WITH {EDITS}\n"
ORACLES["total_events"] = _E + "SELECT count(*) AS total_events FROM edits"
ORACLES["events_by_type"] = _E + 'SELECT type, count(*) AS "count" FROM edits GROUP BY type'
ORACLES["recent_events"] = _E + """
SELECT evt_id, dt_user, type, title, "user", domain FROM edits
ORDER BY dt_user DESC, evt_id DESC LIMIT 100"""
ORACLES["most_active_users"] = _E + """
SELECT "user", count(*) AS edit_count, count_if(bot) AS bot_edits, count_if(minor) AS minor_edits
FROM edits GROUP BY "user" ORDER BY edit_count DESC, "user" LIMIT 100"""
ORACLES["user_patterns"] = _E + """
SELECT "user", count(*) AS total_edits, round(avg(len_new - len_old), 2) AS avg_edit_size,
       count_if(minor) / count(*) * 100 AS minor_edit_percentage,
       count(DISTINCT CAST(dt_server AS DATE)) AS active_days
FROM edits WHERE type = 'edit' GROUP BY "user" HAVING count(*) > 10
ORDER BY total_edits DESC, "user" LIMIT 100"""
ORACLES["events_by_domain"] = _E + """
SELECT domain, count(*) AS event_count, count_if(type = 'edit') AS edits,
       count_if(type = 'new') AS new_pages FROM edits GROUP BY domain"""
ORACLES["events_per_hour"] = _E + f"""
SELECT {ts_text("date_trunc('hour', dt_server)")} AS hour, count(*) AS event_count
FROM edits GROUP BY 1 ORDER BY 1 DESC LIMIT 24"""
ORACLES["events_per_day"] = _E + """
SELECT strftime(dt_server, '%Y-%m-%d') AS day, count(*) AS event_count,
       count(DISTINCT "user") AS unique_users
FROM edits GROUP BY 1 ORDER BY 1 DESC LIMIT 30"""
ORACLES["events_per_minute"] = _E + f"""
SELECT {ts_text("date_trunc('minute', dt_server)")} AS minute, count(*) AS events_per_minute
FROM edits WHERE CAST(dt_server AS DATE) = DATE '2024-01-15' GROUP BY 1"""
ORACLES["size_change_by_namespace"] = _E + """
SELECT ns AS namespace, count(*) AS edit_count, avg(len_new - len_old) AS avg_size_change,
       max(len_new - len_old) AS max_increase, min(len_new - len_old) AS max_decrease
FROM edits WHERE type = 'edit' GROUP BY ns"""
ORACLES["large_edits"] = _E + """
SELECT evt_id, title, "user", len_new - len_old AS bytes_added, comment
FROM edits WHERE type = 'edit' AND len_new - len_old > 1000
ORDER BY bytes_added DESC, evt_id LIMIT 100"""
ORACLES["page_frequency"] = _E + f"""
SELECT title, count(*) AS edit_count, count(DISTINCT "user") AS unique_editors,
       {ts_text('min(dt_server)')} AS first_edit, {ts_text('max(dt_server)')} AS last_edit
FROM edits GROUP BY title HAVING count(*) > 5 ORDER BY edit_count DESC, title LIMIT 100"""
ORACLES["completeness"] = _E + """
SELECT count(title) / count(*) * 100 AS title_completeness,
       count("user") / count(*) * 100 AS user_completeness,
       count(comment) / count(*) * 100 AS comment_completeness,
       count(len_new) / count(*) * 100 AS length_completeness FROM edits"""
ORACLES["daily_summary"] = _E + """
SELECT strftime(dt_server, '%Y-%m-%d') AS date, domain, count(*) AS total_events,
       count_if(type = 'edit') AS edits, count_if(type = 'new') AS new_pages,
       count_if(bot) AS bot_events, count(DISTINCT "user") AS unique_users
FROM edits GROUP BY 1, 2"""

ORACLES["total_flagged"] = f"{FLAGGED} SELECT count(*) AS ai_flagged_events FROM flagged"
ORACLES["flag_counts"] = f"""{FLAG_ROWS}
SELECT flag AS flag_type, count(*) AS "count" FROM flag_rows GROUP BY flag"""
ORACLES["recent_flagged"] = f"""{FLAGGED}
SELECT evt_id AS event_id, {ts_text('dt_server')} AS detection_timestamp, "user", title, domain,
       flags AS ai_flags, {_SAMPLE} AS content_sample_comment, title AS content_sample_title,
       length(t) AS content_sample_text_length
FROM flagged ORDER BY dt_server DESC, evt_id DESC LIMIT 50"""
ORACLES["latest_flagged_rows"] = f"""{FLAGGED}
SELECT evt_id AS event_id, '1.0.3' AS rule_version, type AS edit_type,
       length(flags) - length(replace(flags, '|', '')) + 1 AS detection_metadata_total_flags,
       flags AS detection_metadata_flag_types,
       {ts_text('dt_server')} AS detection_metadata_detected_at,
       '1.0.3' AS detection_metadata_rule_version
FROM flagged ORDER BY dt_server DESC, evt_id DESC LIMIT 100"""
ORACLES["with_flag"] = f"""{FLAGGED}
SELECT evt_id AS event_id, "user", title, domain, {ts_text('dt_server')} AS detection_timestamp,
       'true' AS has_chatgpt_artifacts
FROM flagged WHERE contains(flags, 'chatgpt_artifacts')"""
ORACLES["users_with_flags"] = f"""{FLAGGED},
pages AS (
  SELECT "user", title, row_number() OVER (PARTITION BY "user" ORDER BY title) AS place
  FROM (SELECT DISTINCT "user", title FROM flagged)
)
SELECT "user", ai_flagged_count,
       (SELECT string_agg(title, '|' ORDER BY title) FROM pages p
        WHERE p."user" = c."user" AND place <= 10) AS affected_pages
FROM (SELECT "user", count(*) AS ai_flagged_count FROM flagged GROUP BY "user"
      HAVING count(*) > 1) c"""
ORACLES["top_flagged_users"] = f"""{FLAGGED}
SELECT "user", count(*) AS ai_flagged_count FROM flagged GROUP BY "user"
ORDER BY ai_flagged_count DESC, "user" LIMIT 10"""
ORACLES["flag_rate_by_domain"] = f"""{FLAGGED}
SELECT m.domain, count(DISTINCT m.evt_id) AS total_events, count(DISTINCT g.evt_id) AS ai_events,
       round(count(DISTINCT g.evt_id) / count(DISTINCT m.evt_id) * 100, 2) AS ai_percentage
FROM edits m LEFT JOIN flagged g ON m.evt_id = g.evt_id
GROUP BY m.domain HAVING count(DISTINCT m.evt_id) > 100"""
ORACLES["flag_pairs"] = f"""{FLAG_ROWS}
SELECT a.flag AS pattern_1, b.flag AS pattern_2, count(*) AS co_occurrence_count
FROM flag_rows a JOIN flag_rows b ON a.i = b.i AND a.flag < b.flag
GROUP BY ALL HAVING count(*) > 5"""
_PAIRS = ", ".join(f"('{a}', '{b}')" for a, b in combinations(sorted(CONDITIONS["1.0.3"]), 2))
ORACLES["flag_correlation"] = f"""{FLAG_ROWS},
pairs(pattern_1, pattern_2) AS (VALUES {_PAIRS}),
totals AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM flagged),
singles AS (SELECT flag, CAST(count(*) AS DOUBLE) AS c FROM flag_rows GROUP BY flag),
joint AS (
  SELECT a.flag AS pattern_1, b.flag AS pattern_2, CAST(count(*) AS DOUBLE) AS c
  FROM flag_rows a JOIN flag_rows b ON a.i = b.i AND a.flag < b.flag GROUP BY ALL
)
SELECT pattern_1, pattern_2,
       round((n * coalesce(j.c, 0) - coalesce(x.c, 0) * coalesce(y.c, 0)) / nullif(
         sqrt(coalesce(x.c, 0) * (n - coalesce(x.c, 0)))
         * sqrt(coalesce(y.c, 0) * (n - coalesce(y.c, 0))), 0), 9) AS phi
FROM pairs CROSS JOIN totals LEFT JOIN joint j USING (pattern_1, pattern_2)
LEFT JOIN singles x ON x.flag = pattern_1 LEFT JOIN singles y ON y.flag = pattern_2"""
ORACLES["flagged_totals"] = f"""{FLAGGED}
SELECT count(*) AS total_ai_events, CAST(1 AS BIGINT) AS rule_versions,
       count(DISTINCT "user") AS unique_users, count(DISTINCT domain) AS unique_domains
FROM flagged"""
ORACLES["flagged_export"] = f"""{FLAGGED}
SELECT evt_id AS event_id, {ts_text('dt_server')} AS detection_timestamp, '1.0.3' AS rule_version,
       "user", title, domain,
       CASE WHEN contains(flags, 'chatgpt_artifacts') THEN 'true' END AS has_chatgpt,
       CASE WHEN contains(flags, 'markdown_syntax') THEN 'true' END AS has_markdown,
       CASE WHEN contains(flags, 'emoji_in_headings') THEN 'true' END AS has_emojis,
       {_SAMPLE} AS content_sample_comment, title AS content_sample_title,
       length(t) AS content_sample_text_length
FROM flagged"""
ORACLES["flags_per_event"] = f"""{FLAGGED}
SELECT length(flags) - length(replace(flags, '|', '')) + 1 AS flags, count(*) AS events
FROM flagged GROUP BY 1"""
ORACLES["version_totals"] = f"""WITH {EDITS},{scanned('edits', EDIT_TEXT)},
by_version AS ({" UNION ALL ".join(
    f"SELECT '{v}' AS rule_version, {flag_list(CONDITIONS[v])} AS flags FROM scanned"
    for v in VERSIONS)})
SELECT rule_version, count_if(flags <> '') AS flagged_events, count_if(flags = '') AS clean_events
FROM by_version GROUP BY rule_version"""
ORACLES["rescan_totals"] = f"""WITH {EDITS},{scanned('edits', EDIT_TEXT)},
by_version AS ({" UNION ALL ".join(
    f"SELECT '{v}' AS rule_version, {flag_list(CONDITIONS[v])} AS flags FROM scanned"
    for v in ("1.0.2", "1.0.3"))})
SELECT rule_version, count_if(flags <> '') AS flagged_events, count_if(flags = '') AS clean_events
FROM by_version GROUP BY rule_version"""
ORACLES["pending_scan"] = f"""{FLAGGED},
done AS MATERIALIZED (
  SELECT evt_id FROM flagged WHERE type = 'edit' UNION ALL SELECT evt_id FROM edits WHERE type = 'new'
)
SELECT {column_list(SCAN_COLUMNS, comment="md5(comment)", parsed_comment="md5(parsed_comment)")}
FROM edits ANTI JOIN done USING (evt_id)"""
ORACLES["indexed_pending"] = f"""{FLAGGED},
done AS MATERIALIZED (
  SELECT evt_id FROM flagged WHERE type = 'edit' UNION ALL SELECT evt_id FROM edits WHERE type = 'new'
)
SELECT evt_id FROM edits ANTI JOIN done USING (evt_id)"""
ORACLES["rescan_by_rule_totals"] = ORACLES["rescan_totals"]
ORACLES["stored_edits_by_day"] = f"""{_E}
SELECT {column_list()} FROM edits WHERE CAST(dt_server AS DATE) = DATE '2024-01-15'"""

ORACLES["compacted_edits"] = ORACLES["stored_edits_by_day"]
for _name in ("events_per_hour", "events_per_day", "events_per_minute"):
    ORACLES[f"stored_{_name}"] = ORACLES[_name]
ORACLES["users_by_day_sketches"] = _E + """
SELECT strftime(dt_server, '%Y-%m-%d') AS user_day, domain, count(*) AS events,
       count_if(type = 'edit') AS edits, true AS near
FROM edits GROUP BY 1, 2"""
ORACLES["table_versions"] = f"""{_E}
SELECT CAST(v AS BIGINT) AS version, type, count(*) AS rows
FROM edits, (SELECT unnest([0, 1, 2, 3, 4, 4]) AS v, unnest([0, 1, 2, 2, 2, 3]) AS part)
WHERE CASE WHEN part < 3 THEN i % 3 <= part ELSE i % 3 = 1 AND type = 'edit' END GROUP BY ALL"""
ORACLES["migrated_table"] = f"{_E}\nSELECT {column_list()} FROM edits"

# --- Streams over time, backlog ---------------------------------------------------------------------

# The last windows are still open: the watermark is ten minutes behind the last event.
for _unit in ("minute", "hour", "day"):
    ORACLES[f"streamed_{_unit}_counts"] = _E + f"""
SELECT {ts_text(f"date_trunc('{_unit}', dt_server)")} AS window_start, count(*) AS event_count
FROM edits GROUP BY 1, date_trunc('{_unit}', dt_server)
HAVING date_trunc('{_unit}', dt_server) + INTERVAL 1 {_unit}
    <= (SELECT max(dt_server) FROM edits) - INTERVAL 10 MINUTE"""
# Minutes are followed from batch to batch, so open ones are there, too.
ORACLES["streamed_minute_counts"] = _E + f"""
SELECT {ts_text("date_trunc('minute', dt_server)")} AS window_start, count(*) AS event_count
FROM edits GROUP BY 1"""
ORACLES["streamed_progress"] = f"""WITH {RAW},{scanned('raw', EDIT_TEXT, "fate IN ('valid', 'invalid')")},
hits AS (SELECT count(*) AS flagged FROM scanned WHERE {flag_list(CONDITIONS['1.0.3'])} <> '')
SELECT 3 AS batches, count(*) AS lines, count_if(reason = 'OK') AS accepted,
       count_if(reason = 'DECODE_ERROR') AS not_decoded, count_if(reason = 'BAD_META') AS bad_meta,
       count_if(reason = 'MISSING_META_FIELD') AS missing_meta_field,
       count_if(reason = 'BAD_TYPE') AS bad_type, count_if(reason = 'CANARY') AS canaries,
       count_if(fate = 'valid') AS valid, count_if(fate IN ('invalid', 'malformed')) AS dead_letters,
       (SELECT flagged FROM hits) AS flagged
FROM raw"""
ORACLES["streamed_first_events"] = f"""WITH {RAW}
SELECT DISTINCT evt_id FROM raw WHERE fate = 'valid'"""
ORACLES["streamed_unique_events"] = ORACLES["streamed_first_events"]


def _backlog(messages: int, high: int, medium: int, low: int) -> str:
    return f"""
WITH moves AS (
  SELECT event_type AS source, ts AS moved_at, {messages} AS arrived, 0 AS processed FROM events
  UNION ALL
  SELECT event_type, ts + to_minutes(CAST(floor(value) AS BIGINT)), 0, {messages} FROM events
),
minutes AS (
  SELECT source, date_trunc('minute', moved_at) AS minute, CAST(sum(arrived) AS BIGINT) AS arrived,
         CAST(sum(processed) AS BIGINT) AS processed
  FROM moves GROUP BY ALL
),
running AS (
  SELECT *, CAST(sum(arrived - processed) OVER (PARTITION BY source ORDER BY minute) AS BIGINT)
    AS waiting FROM minutes
)
SELECT source, {ts_text('minute')} AS minute, arrived, processed, waiting,
       CASE WHEN waiting > {high} THEN 'HIGH' WHEN waiting > {medium} THEN 'MEDIUM'
            WHEN waiting < {low} THEN 'LOW' ELSE 'NONE' END AS severity
FROM running"""


ORACLES["backlog_severity"] = _backlog(1, 5, 3, 1)
ORACLES["backlog_severity_published"] = _backlog(2_000, 10_000, 5_000, 100)

# --- Audits ------------------------------------------------------------------------------------------

ORACLES["first_events"] = f"""WITH {RAW},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY evt_id ORDER BY dt_server, dt_user, title) AS place
  FROM raw WHERE fate = 'valid'
)
SELECT evt_id, {ts_text('dt_server')} AS dt_server, title FROM placed WHERE place = 1"""
ORACLES["repeated_ids"] = f"""WITH {RAW}
SELECT evt_id, count(*) AS copies, {ts_text('min(dt_server)')} AS first_seen,
       {ts_text('max(dt_server)')} AS last_seen
FROM raw WHERE fate = 'valid' GROUP BY evt_id HAVING count(*) > 1"""
_COPIES = f"""WITH {EDITS},
copies AS (
  SELECT domain, type, comment, count(*) AS copies, min(evt_id) AS first_id, max(evt_id) AS last_id
  FROM edits GROUP BY domain, type, comment HAVING min(evt_id) <> max(evt_id)
)"""
ORACLES["repeated_content"] = f"{_COPIES} SELECT copies, first_id, last_id FROM copies"
ORACLES["repeated_content_members"] = f"""{_COPIES}
SELECT e.evt_id, c.copies FROM edits e JOIN copies c
  ON e.domain = c.domain AND e.type = c.type AND e.comment IS NOT DISTINCT FROM c.comment"""
ORACLES["late_events"] = f"""WITH {EDITS},
ordered AS (
  SELECT *, max(dt_server) OVER (PARTITION BY domain ORDER BY xor(i, 5)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before
  FROM edits
)
SELECT evt_id, domain, {ts_text('dt_server')} AS dt_server,
       {ts_text('latest_before')} AS latest_before
FROM ordered WHERE latest_before > dt_server"""
ORACLES["clock_differences"] = _E + """
SELECT domain, count(*) AS events, CAST(0 AS BIGINT) AS unreadable, count_if(bot) AS inconsistent,
       CAST(max(CASE WHEN bot THEN 90 ELSE 0 END) AS BIGINT) AS max_seconds
FROM edits GROUP BY domain"""
ORACLES["merged_table_versions"] = _E + """
SELECT type, count(*) AS rows, count_if(type = 'log') AS with_log_id,
       count_if(type = 'log') AS with_future FROM edits GROUP BY type"""

_UNFIT = {"ns": "g IN (4, 6, 7, 10)", "bot": "g IN (5, 11)"}
_ABSENT = {"evt_id": "g = 0", "domain": "g = 10"}
_FIELD_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS field, '{kind}' AS declared, "
    f"""count_if(g NOT IN (2, 3) AND "{name}" IS NOT NULL AND NOT ({_ABSENT.get(name, 'false')}))"""
    f""" AS "values", count_if(g NOT IN (2, 3) AND ({_UNFIT.get(name, 'false')})) AS unfit_values,"""
    f" {'true' if name in REQUIRED_COLUMNS else 'false'} AS required FROM flat"
    for name, kind in DECLARED.items()
)
ORACLES["schema_compatibility"] = f"""WITH {FLAT},
counted AS ({_FIELD_COUNTS}
  UNION ALL SELECT 'a', NULL, count_if(g = 9), 0, false FROM flat
  UNION ALL SELECT 'b', NULL, count_if(g = 9), 0, false FROM flat),
judged AS (
  SELECT field, declared, "values", unfit_values,
         CASE WHEN declared IS NULL THEN 'added' WHEN "values" = 0 THEN 'removed'
              WHEN unfit_values > 0 THEN 'type_change'
              WHEN required AND "values" < (SELECT count_if(g <> 3) FROM flat) THEN 'not_required'
              ELSE 'ok' END AS status
  FROM counted
)
SELECT *, status NOT IN ('ok', 'added') AS breaking FROM judged"""

# The samples are the five smallest distinct reports of a category.
_MISMATCH_SAMPLES = "|".join(
    [
        "Expected boolean for bot, got int",
        "Expected string for domain, got NoneType",
        "Expected string for evt_id, got NoneType",
        "Expected integer for ns, got float",
        "Expected integer for ns, got str",
    ]
)
_UNREADABLE_SAMPLES = "|".join(["Value of dt_server is no time of the years 1 to 9999"] * 2)
_MALFORMED_SAMPLES = "|".join(["Input is not a valid dictionary"] * 5)
ORACLES["dead_letters_by_category"] = f"""WITH {RAW}
SELECT CASE WHEN fate = 'malformed' THEN 'OTHER' WHEN f IN (23, 24) THEN 'VALIDATION_ERROR'
            ELSE 'TYPE_MISMATCH' END AS _error_category,
       count(*) AS error_count,
       CASE WHEN fate = 'malformed' THEN '{_MALFORMED_SAMPLES}'
            WHEN f IN (23, 24) THEN '{_UNREADABLE_SAMPLES}' ELSE '{_MISMATCH_SAMPLES}' END
         AS sample_errors
FROM raw WHERE fate IN ('malformed', 'invalid') GROUP BY 1, 3"""
ORACLES["recent_failures"] = f"""WITH {RAW}
SELECT {ts_text('dt_server')} AS _validation_timestamp,
       CASE WHEN fate = 'malformed' THEN 'OTHER' WHEN f IN (23, 24) THEN 'VALIDATION_ERROR'
            ELSE 'TYPE_MISMATCH' END AS _error_category,
       type AS event_type, CASE WHEN f = 9 THEN '123' ELSE title END AS title
FROM raw WHERE fate IN ('malformed', 'invalid') ORDER BY dt_server DESC LIMIT 50"""

# The patch drops the NULL columns, as the JSON of a Spark row does.
_JSON_STRUCT = ", ".join(
    f'"{n}" := ' + ("strftime(dt_server, '%Y-%m-%dT%H:%M:%S.000Z')" if n == "dt_server" else f'"{n}"')
    for n in EDIT_FIELDS
)
ORACLES["row_sizes"] = f"""WITH {EDITS},
sizes AS (
  SELECT strlen(CAST(json_merge_patch('{{}}', to_json(struct_pack({_JSON_STRUCT}))) AS VARCHAR))
    AS size FROM edits
)
SELECT count(*) AS rows, CAST(sum(size) AS BIGINT) AS total_bytes, avg(size) AS mean_bytes,
       max(size) AS max_bytes FROM sizes"""
