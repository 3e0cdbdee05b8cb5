"""Declared schemas of the tables and the constants that go with them."""

from pyspark.sql import types as T

# --- Fixed values: column names, types and order of the edit table -----------------------
EDIT_COLUMNS = [
    ("evt_id", "STRING"),
    ("type", "STRING"),
    ("title", "STRING"),
    ("user", "STRING"),
    ("bot", "BOOL"),
    ("dt_user", "STRING"),
    ("dt_server", "TIMESTAMP"),
    ("domain", "STRING"),
    ("ns", "INT64"),
    ("wiki", "STRING"),
    ("srv_name", "STRING"),
    ("srv_url", "STRING"),
    ("minor", "BOOL"),
    ("patrolled", "BOOL"),
    ("len_old", "INT64"),
    ("len_new", "INT64"),
    ("rev_old", "INT64"),
    ("rev_new", "INT64"),
    ("comment", "STRING"),
    ("parsed_comment", "STRING"),
    ("log_type", "STRING"),
    ("log_action", "STRING"),
    ("log_id", "INT64"),
    ("log_comment", "STRING"),
]
REQUIRED_COLUMNS = ["evt_id", "type", "domain"]
META_KEYS = ["id", "dt", "domain"]
EVENT_TYPES = ["edit", "new", "log", "categorize", "move"]
SCHEMA_VERSION = "1.0.0"
# -----------------------------------------------------------------------------------------

EDIT_FIELDS = [name for name, _ in EDIT_COLUMNS]
DECLARED = dict(EDIT_COLUMNS)

SPARK_TYPES = {
    "STRING": T.StringType(),
    "BOOL": T.BooleanType(),
    "INT64": T.LongType(),
    "TIMESTAMP": T.TimestampType(),
}

EDIT_SCHEMA = T.StructType(
    [T.StructField(name, SPARK_TYPES[kind], True) for name, kind in EDIT_COLUMNS]
)

DEAD_LETTER_SCHEMA = T.StructType(
    EDIT_SCHEMA.fields
    + [
        T.StructField("_validation_timestamp", T.TimestampType()),
        T.StructField("_error_category", T.StringType()),
        T.StructField("_error_details", T.StringType()),
        T.StructField("_original_payload", T.StringType()),
        T.StructField("_schema_version", T.StringType()),
    ]
)

FLAGGED_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("rule_version", T.StringType()),
        T.StructField("detection_timestamp", T.TimestampType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("namespace", T.LongType()),
        T.StructField("edit_type", T.StringType()),
        T.StructField("ai_flags", T.MapType(T.StringType(), T.BooleanType())),
        T.StructField(
            "content_sample",
            T.StructType(
                [
                    T.StructField("comment", T.StringType()),
                    T.StructField("title", T.StringType()),
                    T.StructField("text_length", T.LongType()),
                ]
            ),
        ),
        T.StructField(
            "detection_metadata",
            T.StructType(
                [
                    T.StructField("total_flags", T.IntegerType()),
                    T.StructField("flag_types", T.ArrayType(T.StringType())),
                    T.StructField("detected_at", T.TimestampType()),
                    T.StructField("rule_version", T.StringType()),
                ]
            ),
        ),
    ]
)

CLEAN_SCHEMA = T.StructType(
    [T.StructField("event_id", T.StringType()), T.StructField("rule_version", T.StringType())]
)

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        *[
            T.StructField(name, T.LongType())
            for name in (
                "lines accepted not_decoded bad_meta missing_meta_field bad_type canaries "
                "valid dead_letters flagged"
            ).split()
        ],
    ]
)

ERROR_TYPE = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("expected_type", T.StringType()),
        T.StructField("actual_value", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
