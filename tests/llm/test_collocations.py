import random
import re
from collections import Counter

import numpy as np
import pytest

from editstream.llm import collocations


def plain(rows, least, subsumed=80):
    """Every phrase of 2 to 4 words by its definition: (lang, phrase) -> (a, l, r, n, score)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[i : i + size])] += 1
    found = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= least}
    out = {}
    for (lang, words), a in found.items():
        cuts = [
            (2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k)
            for k in range(1, len(words))
        ]
        score, k = min(cuts)
        held = [
            f
            for (other, longer), f in found.items()
            if other == lang
            and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
        ]
        if not any(100 * f >= subsumed * a for f in held):
            cut = counts[lang, words[:k]], counts[lang, words[k:]]
            out[lang, " ".join(words)] = (a, *cut, totals[lang], score)
    return out


def found(df):
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def test_equals_the_definition(spark, documents):
    rng = random.Random(5)
    pick = lambda: rng.choice(["ab", "AB", "b", "é", "the", "of", "x\tof the", "y. z", "b,b", " q"])
    rows = [
        (i, " ".join(pick() for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und"]))
        for i in range(150)
    ]
    rows += [(900, None, "en"), (901, "", "fr"), (902, "...\n\n!", None), (903, "a b " * 3000, "long")]
    want = plain([(r[2], r[1]) for r in rows], 5)
    assert found(collocations.collocations(documents(*rows), least=5)) == want
    assert len(want) > 50
    assert {lang for lang, _ in want} == {"en", "fr", "und", "long"}


def test_chunks_and_cuts_change_nothing(spark, documents, monkeypatch):
    rng = random.Random(6)
    rows = [
        (i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(40)), "en")
        for i in range(200)
    ]
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 500)
    monkeypatch.setattr(collocations, "SLOT_BYTES", 400)
    got = collocations.collocations(documents(*rows), least=4)
    assert found(got) == plain([(r[2], r[1]) for r in rows], 4)


@pytest.mark.parametrize("seed", range(5))
def test_summaries_lose_no_frequent_key(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.zipf(1.3, 400).clip(max=3000).astype(np.uint64) for _ in range(20)]
    least, truth = 40, Counter(np.concatenate(parts).tolist())
    summary = collocations.Summary(8000 // least)
    for part in parts:
        summary.merge(*np.unique(part, return_counts=True))
        assert len(summary.keys) <= summary.capacity
    assert 0 < summary.error < least
    kept = set(summary.may_reach(least).tolist())
    assert {k for k, f in truth.items() if f >= least} <= kept
    assert all(f <= truth[k] for k, f in zip(summary.keys.tolist(), summary.counts.tolist()))
    assert len(kept) < len(truth) / 4


def test_ties_and_ranks(spark, documents):
    docs = documents(*[(i, "b c. a b. c d", "en") for i in range(3)], (9, "z z", "fr"))
    rows = collocations.ranked(collocations.collocations(docs, least=3), top=2).collect()
    assert [(r.lang, r.rank, r.phrase, r.a) for r in rows] == [("en", 1, "a b", 3), ("en", 2, "c d", 3)]


def test_query_and_sql(spark, documents, compare, monkeypatch):
    rows = [(i, f"The old mill, by the river {i}\nthe Old mill\tof stone", "en") for i in range(40)]
    rows += [(i, "la la la la la", None) for i in range(12)]
    got = compare(collocations.op11_collocations, collocations.SQL, documents=documents(*rows))
    assert got.count() > 3


def test_clashing_columns_and_empty(spark, clashing):
    docs = clashing.withColumns({c: clashing.text for c in ("phrase", "f", "size", "n", "slot")})
    assert collocations.collocations(docs, least=2).count() > 0
    assert collocations.collocations(docs.where("false"), least=2).count() == 0
    assert collocations.collocations(docs.where("text is null")).count() == 0
