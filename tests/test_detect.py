import json
import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from editstream.functions import rulebook
from editstream.functions.rules import any_phrase, condition, rare_tail
from editstream.operators import detect
from editstream.sources import rule_files

LATEST = rulebook.RULE_SETS[rulebook.LATEST_VERSION]


@pytest.fixture
def flags(spark):
    def run(*comments, rules=LATEST, **columns):
        rows = [
            (i, c, columns.get("parsed_comment"), columns.get("title"))
            for i, c in enumerate(comments)
        ]
        df = spark.createDataFrame(
            rows, "i int, comment string, parsed_comment string, title string"
        )
        found = detect.with_flags(df, rules).orderBy("i").collect()
        return [row["flag_types"] for row in found]

    return run


@pytest.mark.parametrize(
    "text, flag",
    [
        ("moved from ?utm_source=chatgpt.com&p=2", "chatgpt_artifacts"),
        ("left over: TURN0SEARCH7 here", "chatgpt_artifacts"),
        ('cited {"attribution":{"attributableindex":"9"}', "chatgpt_attribution"),
        ("sorry, as an AI language model there is no opinion", "prompt_refusal"),
        ("now **louder** than before", "markdown_syntax"),
        ("north — south — east — west", "excessive_em_dashes"),
        ("a breathtaking harbour", "promotional_language"),
        ("the lamp plays a vital role at night", "importance_emphasis"),
        ("thanks to [keeper's name] for the tour", "placeholder_templates"),
        ("taken from [URL of source] in May", "placeholder_templates"),
        ("height up to my last training update", "knowledge_cutoff_disclaimers"),
        ("list sorted, I hope this helps", "collaborative_communication"),
        ("lit again 🎉", "emoji_in_headings"),
    ],
)
def test_each_rule(flags, text, flag):
    assert flags(text) == [[flag]]


@pytest.mark.parametrize(
    "text",
    [
        "heights in metres",
        "",
        None,
        "comma",
        "undo",
        "== Heading ==",
        "## = no",
        "**bold** with '''wiki'''",
        "mark 🏻 face ☺",
        "[no name",
        "[a\n's name]",
        "\\[url of",
    ],
)
def test_plain_texts_raise_nothing(flags, text):
    assert flags(text) == [[]]


def test_several_flags_in_rule_order(flags):
    text = "I hope this helps, says **as an AI language model**"
    assert flags(text) == [["prompt_refusal", "collaborative_communication", "markdown_syntax"]]


def test_all_three_columns_are_read(flags):
    assert flags(None, parsed_comment="nestled") == [["promotional_language"]]
    assert flags(None, title="deeply rooted") == [["importance_emphasis"]]
    # The columns are joined by one blank, so a phrase may span two of them.
    assert flags("let me", parsed_comment="know") == [["collaborative_communication"]]


def test_dash_density_is_strictly_more_than_two_per_thousand(flags):
    at_limit = "—" * 2 + "x" * 998
    above = "—" * 2 + "x" * 997
    assert flags(at_limit, above) == [[], ["excessive_em_dashes"]]


def test_line_rules_of_markdown(flags):
    yes = ["# Heading", "a\n## Heading", "a\n---\nb"]
    no = ["a # b", "#= x", "a\r# b", "--- a", "** one\ntwo **"]
    assert flags(*yes) == [["markdown_syntax"]] * len(yes)
    assert flags(*no) == [[]] * len(no)


def test_archived_versions(flags):
    def run(version, text):
        return flags(text, rules=rulebook.RULE_SETS[version])[0]

    assert run("1.0.0", "utm_source=chatgpt.com") == ["chatgpt_urls"]
    assert run("1.0.0", "a testament to courage") == ["importance_emphasis"]
    assert run("1.0.1", "a testament to courage") == []
    assert run("1.0.0", "unclosed ** marker") == ["markdown_syntax"]
    assert run("1.0.0", "** with '''wiki'''") == []
    assert run("1.0.1", "per OpenAI use policy") == []
    assert run("1.0.2", "per OpenAI use policy") == ["prompt_refusal"]
    assert run("1.0.2", "great 🎉") == []
    assert run("1.0.2", "plan 🧭") == ["emoji_in_headings"]
    assert run("1.0.2", "red ❤️") == ["emoji_in_headings"]  # the class holds a bare U+FE0F
    assert run("1.0.3", "red ❤️") == []


def python_flags(text: str) -> list[str]:
    """The definitions of the rules, in plain Python."""
    lowered = text.lower()
    spans = [part.split("-") for part in rulebook.EMOJI_RANGES.split()]
    emoji = any(int(s[0], 16) <= ord(c) <= int(s[-1], 16) for c in text for s in spans)
    found = {
        rule["flag"]: any(p in lowered for p in rule["patterns"])
        for rule in LATEST
        if rule["kind"] == "phrases"
    }
    found["emoji_in_headings"] = emoji
    found["placeholder_templates"] = bool(
        re.search(rulebook.PLACEHOLDER_PATTERN, text, re.IGNORECASE)
    )
    found["markdown_syntax"] = bool(
        re.search(rulebook.MARKDOWN_PATTERN, text, re.MULTILINE)
    ) and not re.search(rulebook.MARKDOWN_EXCLUDE, text)
    found["excessive_em_dashes"] = bool(text) and text.count("—") / len(text) * 1000 > 2
    return [rule["flag"] for rule in LATEST if found[rule["flag"]]]


PIECES = st.sampled_from(
    ["[", "]", "'s name]", "[URL of source", "**", "*", "'''", "# ", "## ", "=", "---", "\n", "\r",
     "—", "x", "é", "日", "🎉", "🏻", "☺", "️", " ", "\x85", " Let Me Know ", "NESTLED", "ſ", "K", " "]
)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=40, max_size=80))
def test_rules_agree_with_their_definition(flags, texts):
    assert flags(*texts) == [python_flags(text) for text in texts]


def test_adversarial_texts_take_linear_time(spark):
    texts = ["[" * 300_000 + "\n's name]", "*" * 300_001 + "\n", "# " * 200_000, "'" * 300_000 + "**a**"]
    df = spark.createDataFrame([(t,) for t in texts], "comment string")
    started = time.time()
    detect.with_flags(df, LATEST, ["comment"]).select("flag_types").collect()
    assert time.time() - started < 20


def test_filter_on_flags_builds_the_text_once(spark):
    df = spark.createDataFrame([("a", None, None)], "comment string, parsed_comment string, title string")
    plan = detect.flagged_only(df, LATEST)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("concat_ws") == 1
    assert plan.count("lower(") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_flagged_record(edit_rows):
    edits = edit_rows(
        {"evt_id": "1", "type": "edit", "title": "T", "comment": "nestled " + "x" * 600, "dt_user": "d"},
        {"evt_id": "2", "type": "edit", "title": "T", "comment": "nothing"},
    )
    rows = detect.detect(edits, as_of=F.lit("2024-01-01").cast("timestamp")).collect()
    assert len(rows) == 1
    row = rows[0]
    assert row["event_id"] == "1" and row["rule_version"] == "1.0.3" and row["timestamp"] == "d"
    assert row["ai_flags"] == {"promotional_language": True}
    assert row["namespace"] == 0 and row["user"] == ""
    assert len(row["content_sample"]["comment"]) == 500
    assert row["content_sample"]["text_length"] == 610
    assert row["detection_metadata"]["flag_types"] == ["promotional_language"]
    assert row["detection_metadata"]["total_flags"] == 1


def test_rules_from_a_file(tmp_path, flags):
    path = tmp_path / "rules.json"
    path.write_text(
        json.dumps(
            {
                "version": "1.0.3-custom",
                "patterns": {
                    "spam_indicators": {"type": "phrase", "patterns": ["Buy Now"]},
                    "prompt_refusal": ["as an ai language model"],
                    "emojis": {"use_external_list": True},
                    "placeholder_templates": {"pattern": rulebook.PLACEHOLDER_PATTERN},
                    "markdown_syntax": {"pattern": "__.*__", "exclude_pattern": "nowiki"},
                },
            }
        )
    )
    version, rules = rule_files.load_rules(str(path))
    assert version == "1.0.3-custom"
    assert flags("buy now", "As an AI language model", "🎉", "[url of source", rules=rules) == [
        ["spam_indicators"], ["prompt_refusal"], ["emoji_in_headings"], ["placeholder_templates"],
    ]
    assert flags("__b__", "__b__ nowiki", rules=rules) == [["markdown_syntax"], []]


@pytest.mark.parametrize("content", [None, "{bad", '{"version": "1"}', '{"patterns": []}'])
def test_unusable_rule_files_turn_detection_off(tmp_path, flags, content):
    path = tmp_path / "rules.json"
    if content is not None:
        path.write_text(content)
    _, rules = rule_files.load_rules(str(path))
    assert rules == []
    assert flags("nestled", rules=rules) == [[]]


def test_published_phrases_are_lower_case_and_unique():
    for rule in LATEST:
        patterns = rule.get("patterns", [])
        assert patterns == [p.lower() for p in patterns]
        assert len(set(patterns)) == len(patterns)
    assert all(re.match(rulebook.VERSION_PATTERN, v) for v in rulebook.RULE_SETS)
    assert set(rulebook.CHANGES) == set(rulebook.RULE_SETS)
    points = sum(
        int(p.split("-")[-1], 16) - int(p.split("-")[0], 16) + 1
        for p in rulebook.EMOJI_RANGES.split()
    )
    assert points == 1174


def test_samples_of_human_and_generated_comments(flags):
    human = ["Fixed a typo", "Added reference to the 2010 census", "Reverted edit", "Updated infobox", "ce"]
    generated = [
        "As an AI language model, I rewrote this",
        "Certainly! Here is the text",
        "A rich cultural heritage nestled in the hills",
        "It stands as a testament to progress",
        "plain",
    ]
    assert sum(bool(f) for f in flags(*human)) <= 1
    assert sum(bool(f) for f in flags(*generated)) >= 3


def test_unknown_rule_kind(spark):
    with pytest.raises(ValueError):
        condition({"flag": "x", "kind": "magic"}, F.lit("a"), F.lit("a"))


def test_version_changes(edit_rows):
    edits = edit_rows(
        {"evt_id": "1", "comment": "a testament to courage"},
        {"evt_id": "2", "comment": "great 🎉"},
        {"evt_id": "3", "comment": "great 🎉"},
    )
    rows = {
        (r["from_version"], r["to_version"], r["flag"], r["change"]): r["events"]
        for r in detect.version_changes(edits, rulebook.RULE_SETS).collect()
    }
    assert rows == {
        ("1.0.0", "1.0.1", "importance_emphasis", "lost"): 1,
        ("1.0.2", "1.0.3", "emoji_in_headings", "gained"): 2,
    }


def test_phrases_are_searched_by_the_rare_end_of_their_bytes(spark):
    phrases = ["testament to", "a", "ütt", "watershed moment", "zz top", "ends in k", "— dash"]
    texts = ["a testament to", "testament t", "watershed momen", "the watershed moment", "zütt", "zz to", "zz top",
             "k", "ends in k", "— dash", "— das", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for phrase in phrases:
        assert phrase.endswith(rare_tail(phrase))
        found = rows.select(any_phrase(F.col("t"), [phrase])).collect()
        assert [r[0] for r in found] == [None if t is None else phrase in t for t in texts]
    assert rare_tail("breathtaking") == "king" and rare_tail("a") == "a" and rare_tail("") == ""
    assert rows.where(any_phrase(F.col("t"), [""])).count() == len(texts) - 1


def test_without_rules_no_text_is_folded(spark, edit_rows):
    rows = detect.with_flags(edit_rows({"evt_id": "1", "comment": "Some", "title": "Text"}), [])
    assert "lower(" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.columns[-2:] == ["flag_types", "text_length"]
    assert [(r["flag_types"], r["text_length"]) for r in rows.collect()] == [([], 9)]
