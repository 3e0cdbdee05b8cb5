"""The operators in plain DataFrame functions, against SQL and by hand."""

import hashlib
import textwrap

import pytest
from editstream.llm import decontaminate, licenses, line_dedup, secrets

SHARED = "This very line is shared by a good many documents."


def test_lines_against_sql(documents, compare):
    rows = []
    for i in range(30):
        lines = [f"own line {i} " * 6, SHARED.upper() if i % 3 else f" \t{SHARED} \r", "short", ""]
        if i < 4:
            lines.append("held by four documents only, which is one too few")
        if i % 2:
            lines += ["ÀÉÎ with accents, and long enough to be a key of its own"] * 2
        rows.append((i, "\n".join(lines)))
    found = compare(
        line_dedup.op7_line_dedup, line_dedup.SQL, documents=documents(*rows, (50, None), (51, "\n\n"))
    )
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[29].n_dropped == 0 and by_id[28].n_dropped == 1 and by_id[27].n_dropped == 3
    assert (by_id[50].n_lines, by_id[51].n_lines) == (1, 3)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_runs_hold_every_hash_once(spark, batches):
    index = line_dedup.LineRuns(spark)
    for b in range(batches):
        rows = [(h, 0, 1) for h in range(b, b + 10)]
        index.add(spark.createDataFrame(rows, "h1 long, h2 long, n long"))
    held = [r.h1 for run in index.runs() for r in run.collect()]
    assert sorted(held) == list(range(batches + 9))
    assert len(index.runs()) == bin(batches).count("1")
    often = {r.h1 for r in index.counted(2).collect()}
    assert often == set(range(1, batches + 8)) if batches > 1 else not often


def test_secrets_against_sql(documents, compare):
    key = "AKIA" + "Q7XW2" * 4
    texts = [
        f'password = "hunter2hunter2X9qL0" and {key}!',
        "token: ab token=abc secret: token: abcdefgh",
        f"é API_KEY='{key}' 0123456789abcdef0123456789abcdef",
        "deadbeef" * 8 + " passwd:=x secret=======",
        "nothing",
        None,
    ]
    rows = [(i, t, None, f"s{i}") for i, t in enumerate(texts)]
    copied = [(10 + i, "example: apikey=example1234567890ab", None, f"s{i}") for i in range(4)]
    found = compare(secrets.op9_secrets, secrets.SQL, documents=documents(*rows, *copied))
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[0].spans.startswith("assign:0:31,live:12:31,access:37:61,live:37:61")
    assert by_id[4].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert all(by_id[10 + i].n_example == 1 and not by_id[10 + i].n_live for i in range(4))


def test_licenses_against_sql(documents, compare, words):
    mit = ".\n".join(licenses.SENTENCES[8:11]) + "."
    wrapped = mit.replace("free of charge, to", "free of charge,\nto")
    rows = [
        (0, words(20) + ".\nReleased under the MIT License.\n" + words(9)),
        (1, wrapped),
        (2, licenses.SENTENCES[9] + ". " + licenses.SENTENCES[8] + ". " + licenses.SENTENCES[10]),
        (3, "# Licensed under CC BY-NC 4.0\n" + words(50)),
        (4, None),
        (5, words(100)),
    ]
    found = compare(licenses.op3_licenses, licenses.SQL, documents=documents(*rows))
    named = {r.doc_id: r.licenses for r in found.collect()}
    assert named == {0: "MIT", 1: "MIT", 2: "", 3: "CC-BY-NC-4.0", 4: "", 5: ""}


GPL = (
    "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation{} either version {} of the "
    "License, or (at your option) any later version."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
NOTICES = [
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
     "copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/."),
    ("GPL-3.0-or-later", GPL.format(":", ",", 3)),
    ("GPL-3.0-or-later", GPL.format(";", ";", 3)),
    ("GPL-2.0-or-later", GPL.format(";", ";", 2)),
    ("GPL-2.0-or-later", GPL.format(":", ",", 2)),
    ("BSD-2-Clause", BSD),
    ("BSD-3-Clause", f"{BSD} 3. {licenses.SENTENCES[20]}."),
    ("MIT", f"{licenses.SENTENCES[8]}: {licenses.SENTENCES[9]}. {licenses.SENTENCES[10]}. IN NO EVENT"),
    ("Apache-2.0", f"{licenses.SENTENCES[5]}; {licenses.SENTENCES[1]}. {licenses.SENTENCES[2]} "
     f"http://www.apache.org/licenses/LICENSE-2.0 {licenses.SENTENCES[3]}. {licenses.SENTENCES[4]}."),
    *[(name, f"{licenses.SENTENCES[ids[0]]}.") for name, ids in licenses.RULES if len(ids) == 1
      and name != "MPL-2.0"],
    *[(f"LGPL-{v}-or-later", GPL.format(a, b, v).replace("program", "library").replace("General", "Lesser General"))
      for v in ("2.1", "3") for a, b in ((":", ","), (";", ";"))],
    *[("AGPL-3.0-or-later", GPL.format(a, b, 3).replace("General", "Affero General")) for a, b in ((":", ","), (";", ";"))],
    ("EPL-2.0", f"{licenses.MORE_SENTENCES[7]}"),
    # Both licences of a text count, whichever is the longer; what a rule has taken is no other's.
    ("BSD-2-Clause,BSD-3-Clause", f"{BSD} 3. {licenses.SENTENCES[20]}. And now: {BSD}"),
    ("BSD-3-Clause,MIT", f"Released under the MIT License. {BSD} 3. {licenses.SENTENCES[20]}. {BSD} 3. {licenses.SENTENCES[20]}."),
]
NOTICES = [(n.replace("LGPL-3-or", "LGPL-3.0-or"), t) for n, t in NOTICES]


def test_every_licence_is_found_by_its_published_notice(documents):
    assert {n for names, _ in NOTICES for n in names.split(",")} == {n for n, _ in licenses.ORDERED_RULES}
    rows, want = [], {}
    for i, (names, text) in enumerate(NOTICES):
        wrapped = textwrap.fill(text, 60)
        for j, form in enumerate([text, wrapped, textwrap.indent(wrapped, " * ")]):
            rows.append((3 * i + j, form))
            want[3 * i + j] = names
    found = licenses.scan_licenses(documents(*rows)).collect()
    assert {r.doc: ",".join(r.licenses) for r in found} == want


def test_notices_against_sql(documents, compare):
    rows = [(i, textwrap.fill(text, 70) if i % 2 else text) for i, (_, text) in enumerate(NOTICES)]
    found = compare(licenses.op3_licenses, licenses.SQL, documents=documents(*rows))
    named = {r.doc_id: r.licenses for r in found.collect()}
    assert all(named[i] == names for i, (names, _) in enumerate(NOTICES))


def changed(text, *places):
    out = text.split()
    for p in places:
        out[p] = "CHANGED"
    return " ".join(out)


def test_leaks_against_sql(spark, documents, compare, words):
    item, short, tiny = words(40, 11), words(14, 12), words(8, 13)
    items = spark.createDataFrame(
        [(1, item), (2, short), (3, tiny), (4, "too short to say"), (5, None), (6, item + " end")],
        "item_id long, text string",
    )
    rows = [
        (0, f"{words(30, 1)} {item} {words(30, 2)}"),
        (1, changed(item, 2, 7, 12, 17, 22, 27, 32, 37)),
        (2, changed(item, *range(0, 40, 3))),
        (3, " ".join(item.split()[5:25])),
        (4, " ".join(item.split()[5:24])),
        (5, f"x {changed(short, 4, 9)} y"),
        (6, changed(short, 0, 4, 9)),
        (7, f"{words(9, 3)}, {tiny.upper()}!"),
        (8, changed(tiny, 3)),
        (9, "too short to say " + words(200, 4)),
        (10, None),
    ]
    found = compare(
        decontaminate.op2_decontaminate,
        decontaminate.SQL,
        documents=documents(*rows),
        benchmark=items,
    )
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert {(0, 1), (1, 1), (3, 1), (5, 2), (7, 3)} <= pairs
    assert not {d for d, _ in pairs} & {2, 4, 6, 8, 9, 10}


def test_masks_find_every_window(spark, words):
    """Any four changed words of twenty leave a mask whole."""
    import itertools
    import random

    item = words(20, 21).split()
    some = random.Random(3).sample(list(itertools.combinations(range(20), 4)), 300)
    docs = spark.createDataFrame(
        [(i, changed(" ".join(item), *c)) for i, c in enumerate(some)], "doc_id long, text string"
    )
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert decontaminate.leaks(docs, items).count() == len(some)
    assert decontaminate.leaks(docs, items, block_seeds=20).count() == len(some)
