import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from editstream.session import configure  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def lines(spark):
    """Turn Python values into a DataFrame of JSON lines; text is taken as it is."""

    def build(*values):
        rows = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
        return spark.createDataFrame(rows, "value string")

    return build


@pytest.fixture
def event():
    """A nested edit event; keyword arguments replace keys, ``None`` drops them."""

    def build(**changes):
        base = {
            "meta": {"id": "e7", "dt": "2024-03-05T06:07:08Z", "domain": "fr.wiki.invalid"},
            "type": "edit",
            "title": "Lighthouses of Brittany",
            "user": "Maelle",
            "bot": False,
            "timestamp": 1709618828,
            "namespace": 0,
            "wiki": "lighthouses",
            "server_name": "fr.wiki.invalid",
            "server_url": "https://fr.wiki.invalid",
            "minor": True,
            "patrolled": False,
            "length": {"old": 812, "new": 790},
            "revision": {"old": 41, "new": 57},
            "comment": "shorter lead",
            "parsedcomment": "<i>shorter lead</i>",
        }
        base.update(changes)
        return {key: value for key, value in base.items() if value is not ...}

    return build


@pytest.fixture
def edit_rows(spark):
    """Typed edit rows from dicts; columns that are not given are NULL."""
    from editstream.schemas import EDIT_FIELDS, EDIT_SCHEMA

    def build(*rows):
        return spark.createDataFrame(
            [tuple(row.get(name) for name in EDIT_FIELDS) for row in rows], EDIT_SCHEMA
        )

    return build
