"""Rule sets from JSON files that name phrase lists and patterns per category."""

from __future__ import annotations

import json
import logging

from editstream.functions import rulebook

log = logging.getLogger(__name__)


def from_categories(categories: dict) -> list[dict]:
    """Rules for ``{category: phrases | {"patterns": [...]} | {"pattern": ...}}``.

    Phrase categories are matched ignoring case. Categories of the published rules take their
    place in the published order; other categories follow in the order of the file.
    """
    rules = {}
    for category, spec in categories.items():
        if isinstance(spec, dict) and "patterns" in spec:
            spec = spec["patterns"]
        if isinstance(spec, list):
            phrases = [phrase.lower() for phrase in spec]
            rules[category] = {"flag": category, "kind": "phrases", "patterns": phrases}
        elif category == "emojis":
            rules["emoji_in_headings"] = (
                rulebook.EMOJI_RULE
                if spec.get("use_external_list")
                else {
                    "flag": "emoji_in_headings",
                    "kind": "regex",
                    "pattern": spec["pattern"],
                }
            )
        else:
            rules[category] = _pattern_rule(category, spec)
    if rules:
        rules[rulebook.DASH_RULE["flag"]] = rulebook.DASH_RULE
    published = rulebook.flags_of(rulebook.RULE_SETS[rulebook.LATEST_VERSION])
    ordered = [flag for flag in published if flag in rules]
    ordered += [flag for flag in rules if flag not in published]
    return [rules[flag] for flag in ordered]


def _pattern_rule(category: str, spec: dict) -> dict:
    for known in (rulebook.PLACEHOLDER_RULE, rulebook.MARKDOWN_RULE):
        if category == known["flag"]:
            if spec["pattern"] == known["pattern"]:
                rule = dict(known)
            else:
                rule = {k: v for k, v in known.items() if k not in ("search", "needs")}
                rule["pattern"] = spec["pattern"]
            rule["exclude"] = spec.get("exclude_pattern")
            return rule
    return {
        "flag": category,
        "kind": "regex",
        "pattern": spec["pattern"],
        "exclude": spec.get("exclude_pattern"),
    }


def load_rules(path: str) -> tuple[str, list[dict]]:
    """``(version, rules)``; a missing or broken file turns detection off, not the job."""
    try:
        with open(path, encoding="utf-8") as handle:
            config = json.load(handle)
        return config.get("version", "unversioned"), from_categories(config["patterns"])
    except (OSError, ValueError, KeyError, TypeError, AttributeError) as error:
        log.warning("rules not usable, detection is off: %s", error)
        return "none", []
