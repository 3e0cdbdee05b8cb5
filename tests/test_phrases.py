"""Large books of phrases give what a search for every phrase gives."""

import random

from pyspark.sql import functions as F

from editstream.operators import phrases
from editstream.operators.detect import with_text
from editstream.plans import by_rule


def texts(spark, count=400):
    rng = random.Random(8)
    parts = ["alpha", "beta ", "gam", "ma delta", "é", "ü", "— ", "x", "yz ", "🎉", "\n"]
    rows = [(str(i), "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(count)]
    return [*rows, ("none", None), (None, "alphabeta gam"), ("empty", "")], parts, rng


def test_hits_equal_a_search_for_each_phrase(spark, monkeypatch):
    rows, parts, rng = texts(spark)
    book = {("c%d" % (i % 90), "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))) for i in range(700)}
    book |= {("c1", ""), ("c2", None), ("c3", "nowhere to be found"), ("c4", "a"), ("c5", "🎉🎉🎉")}
    want = {(k, c) for k, t in rows for c, p in book if k and t is not None and p and p in t}
    df = spark.createDataFrame(rows, "evt_id string, folded_text string")
    lines = spark.createDataFrame(list(book), "category string, phrase string")
    found = phrases.phrase_hits(df, lines)
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) > 1000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    monkeypatch.setattr(phrases, "MOST_BROADCAST", 10)
    monkeypatch.setattr(phrases, "FEW_SHORT", 5)
    assert sorted(map(tuple, phrases.phrase_hits(df, lines).collect())) == sorted(want)
    assert phrases.phrase_hits(df, lines.where("false")).count() == 0
    assert phrases.phrase_hits(df.where("false"), lines).count() == 0


def test_a_phrase_is_found_at_every_place_without_a_lambda_per_byte(spark):
    phrase = "some long phrase é"
    rows = [(str(i), "x" * i + phrase + "y" * (i % 3)) for i in range(300)] + [("no", "x" * 200 + phrase[1:])]
    df = spark.createDataFrame(rows, "evt_id string, folded_text string")
    book = spark.createDataFrame([("c", phrase), ("d", "ong ph"), ("e", "x" * 13)], "category string, phrase string")
    found = phrases.phrase_hits(df, book)
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = {(k, c) for k, t in rows for c, p in (("c", phrase), ("d", "ong ph"), ("e", "x" * 13)) if p in t}
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) > 800


def test_books_between_the_two_sizes_of_an_index(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BROADCAST", 9)
    df = spark.createDataFrame([("1", "phrase number 3 and so on")], "evt_id string, folded_text string")
    for count in (1, 5, 20):
        lines = [("c%d" % i, f"phrase number {i % 10}") for i in range(count)]
        book = spark.createDataFrame(lines, "category string, phrase string")
        assert phrases.phrase_hits(df, book).count() == sum(i % 10 == 3 for i in range(count))


def test_the_plan_does_not_grow_with_the_book(spark):
    df = spark.createDataFrame([("1", "some text of no great length")], "evt_id string, folded_text string")
    sizes = []
    for count in (10, 5_000):
        lines = spark.createDataFrame([("c", f"phrase number {i}") for i in range(count)], "category string, phrase string")
        sizes.append(len(phrases.phrase_hits(df, lines)._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(sizes[1] - sizes[0]) < 50


def test_rules_of_many_phrases_use_the_index(spark, edit_rows, monkeypatch):
    monkeypatch.setattr(by_rule, "MANY_PHRASES", 3)
    rules = [
        {"flag": "many", "kind": "phrases", "patterns": ["one", "two three", "fourth", "fifth"]},
        {"flag": "few", "kind": "phrases", "patterns": ["one"]},
    ]
    edits = edit_rows(
        {"evt_id": "1", "comment": "Two Three"}, {"evt_id": "2", "title": "ONE"}, {"evt_id": "3", "comment": "x"}
    )
    names = {by_rule.digest(r): r["flag"] for r in rules}
    found = sorted((r["event_id"], names[r["rule"]]) for r in by_rule.hits_of(edits, rules).collect())
    assert found == [("1", "many"), ("2", "few"), ("2", "many")]
    assert by_rule.hits_of(edits, rules[:1]).count() == 2
    assert with_text(edits).where(F.contains("folded_text", F.lit("one"))).count() == 1
