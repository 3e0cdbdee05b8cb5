"""The published text rules, version by version.

A rule is a dict with a ``flag`` and one of these kinds:

* ``phrases``: any of the phrases occurs in the lower-cased text;
* ``letters``: ``any_of`` occurs and ``none_of`` does not, in the text as it is;
* ``regex``: the pattern is found, and ``exclude`` (if given) is not;
* ``code_points``: any single code point of the text is in the class;
* ``density``: the character occurs more than ``above`` times per ``per`` characters.

``needs`` lists literals one of which every match contains, ``characters`` the characters; they
let most texts skip the regex engine.
``search`` is a form of ``pattern`` that matches the same texts in time linear in the line.
"""

from __future__ import annotations

# --- Fixed values: phrases, patterns and thresholds of the rule versions ------------------

ARTIFACTS = ["turn0search", "turn0image", "oaicite:", "utm_source=chatgpt.com"]
ARTIFACTS_1_0_0 = ["turn0search", "oaicite:"]
URLS_1_0_0 = ["utm_source=chatgpt.com"]
ATTRIBUTION = ['{"attribution":{"attributableindex":']
REFUSAL = ["as an ai language model", "as a large language model", "openai use policy"]
REFUSAL_1_0_0 = ["as an ai language model", "as a large language model"]
# The capitals never occur in lower-cased text: this phrase is dead, and stays so.
REFUSAL_1_0_1 = ["as an ai language model", "as a large language model", "OpenAI use policy"]
CUTOFF = [
    "up to my last training update",
    "based on available information",
    "while specific details are limited",
    "not widely available",
    "not widely documented",
]
COLLABORATIVE = ["i hope this helps", "certainly!", "let me know", "would you like"]
PROMOTIONAL = ["rich cultural heritage", "breathtaking", "nestled", "stunning natural beauty"]
IMPORTANCE = [
    "stands as a testament",
    "serves as a testament",
    "plays a vital role",
    "plays a significant role",
    "continues to captivate",
    "watershed moment",
    "deeply rooted",
    "profound heritage",
]
IMPORTANCE_1_0_0 = ["testament to", "plays a vital role", "watershed moment"]

PLACEHOLDER_PATTERN = r"\[.*'s name\]|\[url of source|\[entertainer's name\]"
MARKDOWN_PATTERN = r"\*\*.*\*\*|^# [^=]|^## [^=]|^---$"
MARKDOWN_EXCLUDE = r"'''.*'''"
EMOJI_PATTERN_1_0_2 = "[🧠🧱🚨🧭🪷🕰️📭🌕🌀🌠📤🔌]"
EM_DASH = "—"
EM_DASH_PER = 1000
EM_DASH_ABOVE = 2

# Single code points with emoji presentation, Unicode emoji 15.1, without regional indicators
# and skin tones.
EMOJI_RANGES = """
231A-231B 23E9-23EC 23F0 23F3 25FD-25FE 2614-2615 2648-2653 267F 2693 26A1 26AA-26AB 26BD-26BE
26C4-26C5 26CE 26D4 26EA 26F2-26F3 26F5 26FA 26FD 2705 270A-270B 2728 274C 274E 2753-2755 2757
2795-2797 27B0 27BF 2B1B-2B1C 2B50 2B55 1F004 1F0CF 1F18E 1F191-1F19A 1F201 1F21A 1F22F
1F232-1F236 1F238-1F23A 1F250-1F251 1F300-1F320 1F32D-1F335 1F337-1F37C 1F37E-1F393 1F3A0-1F3CA
1F3CF-1F3D3 1F3E0-1F3F0 1F3F4 1F3F8-1F3FA 1F400-1F43E 1F440 1F442-1F4FC 1F4FF-1F53D 1F54B-1F54E
1F550-1F567 1F57A 1F595-1F596 1F5A4 1F5FB-1F64F 1F680-1F6C5 1F6CC 1F6D0-1F6D2 1F6D5-1F6D7
1F6DC-1F6DF 1F6EB-1F6EC 1F6F4-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF
1FA70-1FA7C 1FA80-1FA88 1FA90-1FABD 1FABF-1FAC5 1FACE-1FADB 1FAE0-1FAE8 1FAF0-1FAF8
"""

LATEST_VERSION = "1.0.3"
VERSION_PATTERN = r"^\d+\.\d+\.\d+$"
CHANGES = {
    "1.0.0": "first rules: artifacts, urls, refusals, markdown, dashes, promotion, importance",
    "1.0.1": "adds knowledge cutoff disclaimers and collaborative phrases",
    "1.0.2": "adds emoji, attribution objects, placeholders and line-based markdown",
    "1.0.3": "emoji rule covers the full Unicode emoji list",
}
# -----------------------------------------------------------------------------------------


def _phrases(flag: str, patterns: list[str]) -> dict:
    return {"flag": flag, "kind": "phrases", "patterns": patterns}


PLACEHOLDER_RULE = {
    "flag": "placeholder_templates",
    "kind": "regex",
    "pattern": PLACEHOLDER_PATTERN,
    # Only the first bracket of a line has to be tried: from there `.*` reaches as far.
    # The third alternative of the pattern is a case of the first.
    "search": r"(?:^|\n)[^\[\n]*\[[^\n]*'s name\]|\[url of source",
    "ignore_case": True,
    "needs": ["["],
}
MARKDOWN_RULE = {
    "flag": "markdown_syntax",
    "kind": "regex",
    "pattern": MARKDOWN_PATTERN,
    "exclude": MARKDOWN_EXCLUDE,
    "multiline": True,
    "needs": ["**", "# ", "---"],
}
MARKDOWN_LETTERS_RULE = {
    "flag": "markdown_syntax",
    "kind": "letters",
    "any_of": ["**"],
    "none_of": ["'''"],
}
EMOJI_RULE = {"flag": "emoji_in_headings", "kind": "code_points", "ranges": EMOJI_RANGES}
EMOJI_RULE_1_0_2 = {
    "flag": "emoji_in_headings",
    "kind": "regex",
    "pattern": EMOJI_PATTERN_1_0_2,
    "characters": EMOJI_PATTERN_1_0_2.strip("[]"),
}
DASH_RULE = {
    "flag": "excessive_em_dashes",
    "kind": "density",
    "character": EM_DASH,
    "per": EM_DASH_PER,
    "above": EM_DASH_ABOVE,
}


def _current(emoji_rule: dict) -> list[dict]:
    return [
        _phrases("chatgpt_artifacts", ARTIFACTS),
        _phrases("chatgpt_attribution", ATTRIBUTION),
        _phrases("prompt_refusal", REFUSAL),
        emoji_rule,
        PLACEHOLDER_RULE,
        _phrases("knowledge_cutoff_disclaimers", CUTOFF),
        _phrases("collaborative_communication", COLLABORATIVE),
        MARKDOWN_RULE,
        DASH_RULE,
        _phrases("promotional_language", PROMOTIONAL),
        _phrases("importance_emphasis", IMPORTANCE),
    ]


RULE_SETS = {
    "1.0.0": [
        _phrases("chatgpt_artifacts", ARTIFACTS_1_0_0),
        _phrases("chatgpt_urls", URLS_1_0_0),
        _phrases("prompt_refusal", REFUSAL_1_0_0),
        MARKDOWN_LETTERS_RULE,
        DASH_RULE,
        _phrases("promotional_language", PROMOTIONAL),
        _phrases("importance_emphasis", IMPORTANCE_1_0_0),
    ],
    "1.0.1": [
        _phrases("chatgpt_artifacts", ARTIFACTS_1_0_0),
        _phrases("chatgpt_urls", URLS_1_0_0),
        _phrases("prompt_refusal", REFUSAL_1_0_1),
        _phrases("knowledge_cutoff_disclaimers", CUTOFF),
        _phrases("collaborative_communication", COLLABORATIVE),
        MARKDOWN_LETTERS_RULE,
        DASH_RULE,
        _phrases("promotional_language", PROMOTIONAL),
        _phrases("importance_emphasis", IMPORTANCE),
    ],
    "1.0.2": _current(EMOJI_RULE_1_0_2),
    "1.0.3": _current(EMOJI_RULE),
}


def flags_of(rules: list[dict]) -> list[str]:
    return [rule["flag"] for rule in rules]
