"""Nulls, empty and long texts, repeated rows, empty tables and clashing names."""

import corpus_pipeline
import pytest
from editstream.llm import (
    bpe,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    near_dedup,
    neighbours,
    repeats,
    secrets,
    warc,
)


def runs(spark, docs):
    items = spark.createDataFrame(
        [(1, "unlike every other text here"), (None, None), (2, "")], "item_id long, text string"
    )
    return {
        "lines": line_dedup.dedup_lines(docs),
        "secrets": secrets.find_secrets(docs),
        "licenses": licenses.scan_licenses(docs),
        "bpe": bpe.encode_decode(docs),
        "near": near_dedup.near_classes(docs),
        "language": language_id.identify(docs, language_id.folds(docs)),
        "repeats": repeats.remove_repeats(docs),
        "leaks": decontaminate.leaks(docs, items),
    }


def test_rows_of_every_operator(spark, clashing):
    n = clashing.count()
    counts = {name: df.count() for name, df in runs(spark, clashing).items()}
    assert counts.pop("leaks") == 0
    assert set(counts.values()) == {n}, counts


def test_empty_tables(spark, clashing):
    empty = clashing.where("false")
    assert {name: df.count() for name, df in runs(spark, empty).items()} == dict.fromkeys(
        runs(spark, empty), 0
    )


@pytest.mark.parametrize("rows", [None, 0])
def test_pipeline_stages_keep_the_columns(spark, clashing, saved, rows):
    docs = clashing if rows is None else clashing.limit(0)
    benchmark = spark.createDataFrame([], "item_id long, text string")
    sf_dir = saved(benchmark=benchmark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns, name
        assert [t for _, t in kept.dtypes] == [t for _, t in docs.dtypes], name
        kept.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_stages_decide_as_told(spark, clashing, saved):
    sf_dir = saved(benchmark=spark.createDataFrame([], "item_id long, text string"))
    stages = dict(corpus_pipeline.STAGES)
    # No letter: nulls, the empty text and digits.
    assert stages["language"](spark, clashing, sf_dir).count() == 6
    # Three rows are one text under two ids, and two nulls and an empty text are another.
    kept = stages["near_copies"](spark, clashing, sf_dir).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [1, 1, 2, 4, 5, 6]


def test_empty_pages_and_vectors(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/warc")
    assert warc.read_archives(spark, f"{tmp_path}/warc").count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(vectors, vectors.vec_id > 0).count() == 0
