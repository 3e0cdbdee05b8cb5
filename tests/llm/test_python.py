"""The operators with Python inside tasks, against plain versions."""

import collections
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from editstream.llm import bpe, language_id, near_dedup, neighbours, repeats, warc
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def tokenizers():
    from tokenizers import Tokenizer

    path = bpe.default_path()
    with open(path, encoding="utf-8") as file:
        return bpe.ByteBPE(file.read()), Tokenizer.from_file(path)


def ids_of(own, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]


def test_bpe_on_every_kind_of_letter(tokenizers):
    own, library = tokenizers
    points = [*range(0x2000), *random.Random(1).sample(range(0x2000, 0x110000), 4_000)]
    for first, last in bpe.NEW_LETTERS + bpe.NEW_NUMBERS:
        points += [first - 1, first, last, last + 1]
    letters = [chr(c) for c in points if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}1{c}  {c}'s{c}" for c in letters] + ["", " ", "x<|endoftext|> y", "aaaa" * 99]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(own, texts) == want
    assert [own.decode(x) for x in own.encode(texts)] == texts


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=80))
def test_bpe_equals_the_library(tokenizers, text):
    own, library = tokenizers
    assert ids_of(own, [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_bpe_rows(spark, documents):
    docs = documents((1, "one two"), (1, "one two"), (2, None), (3, "x" * 5000))
    rows = bpe.digests(docs).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == 4
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows if r.doc_id == 2] == [
        (0, empty, empty)
    ]


def test_suffix_automaton_knows_all_substrings():
    rng = random.Random(5)
    for _ in range(30):
        text = [rng.randint(2, 4) for _ in range(rng.randint(1, 40))]
        table = language_id.SuffixAutomaton(text).table(5)
        subs = {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
        for length in (1, 2, 3, 4):
            for _ in range(40):
                word = tuple(rng.randint(2, 4) for _ in range(length))
                state = 0
                for symbol in word:
                    state = table[state + symbol]
                    if state == 0:
                        break
                assert (state != 0) == (word in subs)


def test_phrases_equal_plain_parsing(words):
    known = {"a": words(40, 1), "b": words(40, 2)}
    languages = language_id.Languages(known)
    texts = [words(700, 3), words(5, 4), "x", words(40, 1)]

    def plain(text, sample):
        sample, text = languages.squeezed(sample), languages.squeezed(text)
        count = 0
        for at in range(0, len(text), language_id.BLOCK):
            block, i = text[at : at + language_id.BLOCK], 0
            while i < len(block):
                n = 1
                while i + n < len(block) and block[i : i + n + 1].tobytes() in sample.tobytes():
                    n += 1
                count += 1
                i += n
        return count

    counts, sizes = languages.phrases(texts)
    assert counts.tolist() == [[plain(t, known[n]) for n in "ab"] for t in texts]


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language_id.identify(docs.drop("lang", "source"), language_id.folds(docs))
    pairs = found.select(F.col("row.doc_id"), "lang_pred").join(docs, "doc_id")
    right = pairs.where("lang = lang_pred").count()
    assert right >= 0.97 * docs.count()


def test_shingles_of_many_texts_equal_those_of_one(words):
    odd = ["", "a", "a b c d", "a b c d e", "A b C d e F", "ΑΣ ΣΑΣ. Σ x y", "İ x İ y z İİ", "a\nb\nc d e\n"]
    odd += ["1_2 ß Ǆ 𝔘𝔫 ٣ é", "..", "\n\n", "x" * 5000 + " y" * 9, words(400, 1), words(400, 1) + " end"]
    known = {}
    for text, (hashes, counts) in zip(odd, near_dedup.all_shingles(odd)):
        found = re.findall(r"\w+", text.lower())
        width = min(5, len(found))
        plain = Counter(tuple(found[i : i + width]) for i in range(len(found) - width + 1) if found)
        assert sorted(counts.tolist()) == sorted(plain.values()) and (np.diff(hashes.view(np.int64)) != 0).all()
        alone = near_dedup.shingles(text)
        assert (alone[0] == hashes).all() and (alone[1] == counts).all()
        known[text] = set(hashes.tolist()), set(plain)
    for left, left_plain in known.values():
        for right, right_plain in known.values():
            assert len(left & right) == len(left_plain & right_plain)


def plain_classes(docs):
    counts = np.zeros(1 << near_dedup.FEATURE_BITS, dtype=np.int64)
    for _, text in docs:
        found = near_dedup.feature(near_dedup.shingles(text)[0])
        counts += np.bincount(found, minlength=len(counts))
    idf = near_dedup.inverse_frequencies(counts, len(docs))
    sets = [dict(zip(*[x.tolist() for x in near_dedup.weighted([t], idf)[0]])) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            low = sum(min(a.get(k, 0), b.get(k, 0)) for k in a.keys() | b.keys())
            high = sum(max(a.get(k, 0), b.get(k, 0)) for k in a.keys() | b.keys())
            if docs[i][1] == docs[j][1] or (high and low >= 0.8 * high):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {docs[i][0]: docs[root(i)][0] for i in range(len(docs))}


def near_texts(words, n_groups, copies, seed):
    rng, rows = random.Random(seed), []
    for g in range(n_groups):
        base = words(200, 100 + g).split()
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(len(text))] = f"w{rng.random()}"
            rows.append((len(rows), " ".join(text)))
    return rows + [(len(rows) + i, words(150, 900 + i)) for i in range(10)]


@pytest.mark.parametrize("group_docs", [2_000, 12])
def test_near_classes_against_all_pairs(spark, documents, words, monkeypatch, group_docs):
    monkeypatch.setattr(near_dedup, "GROUP_DOCS", group_docs)
    rows = near_texts(words, 4, 25, 8) + [(500, "a b"), (501, "a b"), (502, "a c"), (503, "")]
    found = near_dedup.near_classes(documents(*rows)).collect()
    smallest = {}
    for r in found:
        smallest[r["class"]] = min(r.doc, smallest.get(r["class"], r.doc))
    assert {r.doc: smallest[r["class"]] for r in found} == plain_classes(rows)


def found_classes(docs):
    found = near_dedup.near_classes(docs).collect()
    smallest = {}
    for r in found:
        smallest[r["class"]] = min(r.doc, smallest.get(r["class"], r.doc))
    return {r.doc: smallest[r["class"]] for r in found}


def test_near_copies_that_fill_a_part_each(spark, documents, words, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP_BYTES", 1_000)
    rows = [(2 * g + i, f"{words(300, g)} {'x' * i}") for g in range(8) for i in range(2)]
    assert found_classes(documents(*rows)) == {i: i - i % 2 for i, _ in rows}


def test_clusters_that_touch_in_one_text(spark, documents, words, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP_DOCS", 2)
    monkeypatch.setattr(near_dedup, "SPEAKERS", 1)
    rows = []
    for g in range(6):
        shared = words(300, g)
        for side in range(2):
            own = words(42, 100 + 2 * g + side).split()
            for i in range(12):
                # Only the last texts of the two clusters are near each other.
                tail = own[:30] if i == 11 else [*own, f"u{i}"]
                rows.append((len(rows), " ".join([shared, *tail])))
    assert len(set(plain_classes(rows).values())) == 6
    assert found_classes(documents(*rows)) == plain_classes(rows)


def test_links_across_classes_of_a_large_bucket(spark, words, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP_DOCS", 6)
    rows = []
    for c in range(5):
        base = words(100, c)
        rows += [(1, bytes([c, i]), bytes([c]), f"{base} {c} {i}") for i in range(9 + c)]
    # One text of each class is a near copy of a text of the next.
    rows += [(1, bytes([c, 99]), bytes([c]), f"{words(100, c + 1)} z") for c in range(4)]
    idf = spark.sparkContext.broadcast(np.ones(1 << near_dedup.FEATURE_BITS))
    texts = spark.createDataFrame(rows, "bucket long, node binary, class binary, text string")
    links = near_dedup.crossed(texts, idf, 0.8).collect()
    joined = {tuple(sorted((r.node[0], r.other[0]))) for r in links}
    assert joined == {(0, 1), (1, 2), (2, 3), (3, 4)}


@pytest.mark.parametrize("bits", [10, 20])
def test_document_frequencies_are_exact(spark, documents, words, monkeypatch, bits):
    monkeypatch.setattr(near_dedup, "FEATURE_BITS", bits)
    monkeypatch.setattr(near_dedup, "SHARE", 10)
    rows = [(i, f"{words(40, i % 7)} {words(60, 50 + i)}") for i in range(35)] + [(90, ""), (91, "a b")]
    sets = [near_dedup.shingles(t)[0].tolist() for _, t in rows]
    counts = collections.Counter(h for s in sets for h in s)
    found = near_dedup.document_frequencies(documents(*rows).select("text"), len(rows))
    assert found.hashes.tolist() == sorted(h for h, n in counts.items() if n >= 4)
    every = np.array(sorted(counts), dtype=np.uint64)
    seen = np.array([counts[h] for h in every.tolist()])
    want = near_dedup.inverse_frequencies(seen, len(rows))
    assert np.allclose(found.of(every)[seen >= 4], want[seen >= 4])
    assert np.allclose(found.of(every)[seen < 4], 2)


def test_weights_depend_on_the_share_of_documents_only():
    few = near_dedup.inverse_frequencies(np.array([20, 200, 2_000]), 20_000)
    many = near_dedup.inverse_frequencies(np.array([20, 200, 2_000]) * 1_000, 20_000_000)
    assert np.allclose(few, many)


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(2)
    keys = near_dedup.mixed(np.arange(300, dtype=np.uint64))
    a, b = rng.uniform(0.5, 4, 300), rng.uniform(0.5, 4, 300)
    a[:60], b[240:] = 1e-9, 1e-9
    sampler = near_dedup.Sampler(4_000)
    share = np.mean(sampler.sample(keys, a) == sampler.sample(keys, b))
    assert abs(share - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_components_of_long_and_wide_graphs(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)] + [(158, 300)]
    edges = [(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in chain + star]
    links = spark.createDataFrame(edges, "node binary, other binary")
    found = {bytes(r.node): bytes(r["class"]) for r in near_dedup.components(links).collect()}
    assert collections.Counter(int.from_bytes(c, "big") for c in found.values()) == {0: 41, 100: 61}


def plain_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(
        t[p : p + length] for _, t in texts for p in range(len(t) - length + 1)
    )
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(t), int(gone.sum()), spans, bytes(x for x, g in zip(t, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("limits", [(50_000, 50_000), (20, 50_000), (50_000, 2)])
def test_repeats_against_all_strings(spark, documents, words, monkeypatch, limits):
    monkeypatch.setattr(repeats, "BUCKET_ROWS", limits[0])
    monkeypatch.setattr(repeats, "HOT_ROWS", limits[1])
    rng, shared = random.Random(4), [words(40, 50 + i) for i in range(4)]
    rows = []
    for i in range(40):
        parts = [words(rng.randint(1, 30), 1000 + 7 * i)]
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(shared)
            begin = rng.randint(0, 60)
            parts += [part[begin : begin + rng.randint(60, 160)], words(rng.randint(0, 9), rng.random())]
        rows.append((i, rng.choice(["", "é", "\n"]).join(parts)))
    rows += [(100, rows[0][1]), (101, "ab" * 300), (102, None), (103, "x" * 79), (104, "y" * 81)]
    length = 80
    found = repeats.remove_repeats(documents(*rows), length=length).collect()
    assert sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found) == plain_repeats(rows, length)


def test_words_are_sorted_with_their_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(30):
        parts = [bytes(rng.integers(97, 99, rng.integers(0, 40)).tolist()) for _ in range(60)]
        order, shared = repeats.sorted_words(repeats.as_words(parts, 40))
        rows = [parts[i].ljust(40, b"\0") for i in order]
        assert rows == sorted(rows)
        for a, b, n in zip(rows, rows[1:], shared[1:]):
            assert n == next((i for i in range(40) if a[i] != b[i]), 40)


def test_archives_round_trip(spark, tmp_path):
    body = "<p>" + "é-" * 50_000 + "WARC/1.1\r\n\r\n</p>"
    rows = [
        (1, "http://a.example/ü\n", body),
        (2, None, body),
        (0, "http://b.example", body),
        (3, "http://c.example", "short"),
        (4, "http://c.example", "short"),
        (5, "x", None),
        (6, "x", "y" * 100),
        (6, "x", "y" * 100),
        (None, "x", "y" * 100),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/a", segment_bytes=1_000, chunk_bytes=300, records_per_file=7)
    read = warc.read_archives(spark, f"{tmp_path}/a").collect()
    found = sorted(
        (r.page_id or "", r.record_type, r.refers_to or "", r.complete, bytes(r.payload or b"").decode())
        for r in read
    )
    assert found == sorted(
        [
            ("0", "response", "", True, body),
            ("1", "revisit", "0", True, ""),
            ("2", "revisit", "0", True, ""),
            ("3", "response", "", True, "short"),
            ("4", "response", "", True, "short"),
            ("5", "response", "", True, ""),
            ("6", "response", "", True, "y" * 100),
            ("6", "response", "", True, "y" * 100),
            ("", "revisit", "6", True, ""),
        ]
    )


def test_segments_that_lack_or_repeat(spark, tmp_path):
    made = list(warc.records_of_page(1, "u", b"z" * 5_000, hashlib.sha256(b"z" * 5_000).hexdigest(), None, 700, 90))
    wrong = list(warc.records_of_page(2, "u", b"z" * 50, "0" * 64, None, 700, 90))

    def read(name, records):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part-0").write_bytes(b"".join(r + b"\r\n\r\n" for r in records))
        return [(r.page_id, r.complete) for r in warc.read_archives(spark, str(folder)).collect()]

    shuffled = random.Random(1).sample(made, len(made))
    assert read("whole", shuffled) == [("1", True)]
    assert read("twice", shuffled + made[2:4]) == [("1", True)]
    assert read("gap", made[:2] + made[3:]) == [("1", False)]
    assert read("cut", made[:-1]) == [("1", False)]
    assert read("digest", wrong) == [("2", False)]


def test_framing():
    for size in (1, 7, 100):
        assert warc.unchunked(warc.chunked(b"a\r\nb" * 30, size)) == b"a\r\nb" * 30
    for bad in (b"", b"5\r\nabc", b"x\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"-1\r\nab\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)


def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(1500, 16))
    vectors[700:760] = vectors[700]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [1.0, None])]
    rows += [(None, [1.0] * 16), (5200, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for r in neighbours.nearest(table, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.id, r.score))
    assert sorted(found) == list(range(0, 1500, 50))
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q, best in found.items():
        scores = units @ units[q]
        scores[q] = -2
        want = np.lexsort((np.arange(1500), -np.round(scores, 12)))[:5]
        hits += len({i for i, _ in best} & set(want.tolist()))
        assert np.allclose([s for _, s in best], scores[[i for i, _ in best]])
        assert best == sorted(best, key=lambda x: (-x[1], x[0])) and q not in {i for i, _ in best}
    assert [i for i, _ in found[700]] == [701, 702, 703, 704, 705]
    assert hits >= 0.9 * 5 * len(found)


@pytest.mark.parametrize("size", [1, 2, 5, 6, 12])
def test_few_vectors_find_all_others(spark, size):
    rows = [(i, [1.0 + i, 2.0, -1.0 * (i % 3)]) for i in range(size)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collections.Counter(r.query_id for r in neighbours.nearest(table, F.col("id") >= 0).collect())
    assert found == ({i: min(5, size - 1) for i in range(size)} if size > 1 else {})


def test_tiny_and_huge_vectors_and_other_lengths(spark):
    rng = np.random.default_rng(3)
    plain = rng.normal(size=(12, 4))
    scales = [1e-170, 1e-300, 1e160, 1e300, 1.0, 5e-320]
    rows = [(i, (v * scales[i % 6]).tolist()) for i, v in enumerate(plain)]
    rows += [(100 + i, [1.0, float(i)]) for i in range(3)] + [(100, [1.0, 2.0, 3.0, 4.0])]
    names = ["id", "vector", "size", "cell", "list", "block", "seconds", "score", "norm"]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    table = table.withColumns({n: F.lit("x") for n in names})
    found = collections.defaultdict(list)
    for r in neighbours.nearest(table, F.col("id") >= 0, k=20).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.id, r.score))
    units = plain / np.linalg.norm(plain, axis=1, keepdims=True)
    exact = [i for i in range(12) if i % 6 != 5]  # the others have lost digits before they came here
    for i in exact:
        scores = dict(found[i])
        assert set(scores) == {*range(12), 100} - {i}
        assert all(abs(scores[j] - units[i] @ units[j]) < 1e-12 for j in exact if j != i)
    assert {i for i, _ in found[101]} == {100, 102}
    assert {i for i, _ in found[100]} == {*range(12), 101, 102}
