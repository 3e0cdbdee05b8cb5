import os
import random

import duckdb
import pytest

LETTERS = ["ka", "lo", "mi", "ter", "sun", "ve", "qua", "ri", "no", "be", "ost", "ed"]


@pytest.fixture
def words():
    """``words(n, seed)``: text of n invented words."""

    def build(n, seed=0):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices(LETTERS, k=rng.randint(1, 3))) for _ in range(n))

    return build


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) pairs, or (doc_id, text, lang, source)."""

    def build(*rows):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long"
        )

    return build


@pytest.fixture
def clashing(spark, words):
    """Documents with columns named like those the operators use, nulls, repeats and a long text."""
    long = " ".join([words(300, 1)] * 60)
    rows = [
        (1, words(60, 2), "en"),
        (1, words(60, 2), "en"),
        (1, words(30, 3), "en"),
        (2, None, "en"),
        (3, "", None),
        (4, "1234 !!", "fr"),
        (None, words(60, 2), None),
        (None, None, None),
        (5, long, "fr"),
        (6, "a\n\n" + "  Some LINE that is shared by many documents é \n" * 3, "fr"),
    ]
    names = (
        "row doc print pos line lines gone h1 h2 n batch again held kept bands bucket part node key "
        "class other tokens at seed item shift equal guess score ids decoded t1 t2 anchors first "
        "copies ranges low high head ROW"
    ).split()
    extra = ", ".join(f"`{n}` string" for n in names if n != "ROW")
    return spark.createDataFrame(
        [(i, t, lang, "src", len(t or ""), *[n for n in names if n != "ROW"]) for i, t, lang in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {extra}",
    )


@pytest.fixture
def compare(spark, tmp_path):
    """Write tables to a folder, run a query and its SQL on them, and compare the rows."""

    def build(query, sql, **tables):
        connection = duckdb.connect()
        for name, df in tables.items():
            df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
            files = f"{tmp_path}/{name}.parquet/*.parquet"
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
        found = query(spark, str(tmp_path))
        columns = sorted(found.columns)
        got = sorted(map(repr, (tuple(r) for r in found.select(columns).collect())))
        names = ", ".join(columns)
        want = sorted(map(repr, connection.execute(f"SELECT {names} FROM ({sql})").fetchall()))
        assert got == want
        return found

    return build


@pytest.fixture
def saved(spark, tmp_path):
    def build(**tables):
        for name, df in tables.items():
            df.write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
        return str(tmp_path)

    return build
