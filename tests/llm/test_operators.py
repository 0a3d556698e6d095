"""Every operator on rows that are odd in some way, and on none."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakeveil.llm import (
    exact_dedup,
    mixing,
    mixing_lm,
    near_dup,
    pieces,
    pseudonyms,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
)
from lakeveil.llm.parameters import labels, tokenizer_model
from lakeveil.sources import workspace

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, kept boolean,"
    " digest string, lv_file string, word string, score double, spans string"
)
LONG = "The long text repeats itself. " * 20_000
PLAIN = "One plain text of fourteen words that no other row in this small table has."
ROWS = [
    (1, "", None, "a", 0),
    (2, None, "en", None, None),
    (3, " \n\t ", "en", "a", 4),
    (4, LONG, "en", "b", len(LONG)),
    (5, PLAIN, "en", "b", None),
    (5, PLAIN, "en", "b", None),
    (6, PLAIN, "de", None, 1),
    (None, PLAIN, None, None, None),
    (None, None, None, None, None),
    (7, "word", "en", "c", 4),
    (8, "x" * 5000, "en", "c", 5000),
    (9, "nul \x00 é 漢字 \U0001f600 ▁ end", "fr", "c", 9),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, 1, True, "d", "f", "w", 0.5, "s") for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def few_labels(spark):
    return spark.createDataFrame(
        [(4, 0, 1), (5, 1, 0), (6, None, None), (None, 1, 1), (99, 0, 0)], "doc_id bigint, quality int, toxic int"
    )


OPERATORS = {
    "near": lambda d, ls: near_dup.near_duplicates(d),
    "mix": lambda d, ls: mixing.mix(d),
    "suffix": lambda d, ls: suffix_dedup.suffix_dedup(d),
    "quality": quality.judged,
    "pieces": lambda d, ls: pieces.encoded(d, tokenizer_model(), ids=True),
    "secrets": lambda d, ls: secrets.scan(d),
    "exact": lambda d, ls: exact_dedup.exact_dedup(d),
    "pseudonyms": lambda d, ls: pseudonyms.pseudonymised(d, "k"),
    "toxicity": toxicity.scored,
    "lm": lambda d, ls: mixing_lm.scored(d),
}


def by_id(df):
    rows = df.collect()
    assert len(rows) == len(ROWS)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    return rows, {r.doc_id: r for r in rows if r.doc_id is not None}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows_in_none_out(odd, few_labels, name):
    assert OPERATORS[name](odd.limit(0), few_labels).count() == 0


def test_near(odd, few_labels):
    rows, found = by_id(OPERATORS["near"](odd, few_labels))
    plain = [r for r in rows if r.class_size == 4]
    assert len(plain) == 4 and {r.class_id for r in plain} == {5} and sum(r.kept for r in plain) == 1
    assert all(r.kept and r.class_size == 1 for r in rows if r not in plain)


def test_mix(odd, few_labels):
    rows, found = by_id(OPERATORS["mix"](odd, few_labels))
    assert [found[i].size for i in (1, 2, 3, 7, 8)] == [0, 0, 0, 1, 1]
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    total = sum(r.size for r in rows)
    targets = {r.source_size: r.target for r in rows}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert found[1].source_size == 0 and found[1].target == 0


def test_suffix(odd, few_labels):
    rows, found = by_id(OPERATORS["suffix"](odd, few_labels))
    assert (found[4].n_removed, found[4].n_spans) == (len(LONG), 1)
    assert (found[8].n_bytes, found[8].n_removed) == (5000, 5000)
    assert all(r.n_removed == 0 and r.n_spans == 0 for r in rows if r.n_bytes < 200)


def test_quality(odd, few_labels):
    rows, found = by_id(OPERATORS["quality"](odd, few_labels))
    assert [found[i].base_failed for i in (1, 2, 3, 4, 5, 7, 8)] == [True, True, True, True, False, True, True]
    assert found[5].n_words == 15 and found[5].word_chars == len(PLAIN.replace(" ", ""))
    assert not any(r.kept for r in rows if r.base_failed)


def test_pieces(odd, few_labels):
    rows, found = by_id(OPERATORS["pieces"](odd, few_labels))
    assert found[1].ids == found[2].ids == [1, 2]
    assert all(len(r.ids) == r.n_tokens for r in rows)


def test_secrets(odd, few_labels):
    rows, _ = by_id(OPERATORS["secrets"](odd, few_labels))
    assert all(r.spans == "" and r.n_linked == 0 for r in rows)


def test_exact(odd, few_labels):
    rows, found = by_id(OPERATORS["exact"](odd, few_labels))
    plain = [r for r in rows if r.group_size == 4]
    assert len(plain) == 4 and {r.keep_id for r in plain} == {6} and [r.doc_id for r in plain if r.kept] == [6]
    empty = [r for r in rows if r.group_size == 3]
    assert {r.doc_id for r in empty} == {1, 2, None} and {r.keep_id for r in empty} == {2}
    assert found[1].text_sha256 == found[2].text_sha256


def test_repeated_rows_keep_one(spark):
    twice = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x"), (None, "x")], "doc_id bigint, text string")
    for kept in (exact_dedup.keep_one(twice), near_dup.keep_one(twice)):
        assert sorted(r.text for r in kept.collect()) == ["same", "x"]


def test_pseudonyms(odd, few_labels):
    rows, found = by_id(OPERATORS["pseudonyms"](odd, few_labels))
    assert found[2].text is None and found[1].text == "" and found[5].text == PLAIN
    assert all(r.n_values == 0 for r in rows)


def test_toxicity(odd, few_labels):
    rows, _ = by_id(OPERATORS["toxicity"](odd, few_labels))
    assert all(0 <= r.score <= 1 for r in rows)
    plain = {r.score for r in rows if r.doc_id in (5, 6)}
    assert len(plain) == 1


def test_lm(odd, few_labels):
    rows, found = by_id(OPERATORS["lm"](odd, few_labels))
    assert found[1].n_tokens == found[2].n_tokens == found[3].n_tokens == 1
    assert found[4].n_tokens == 100_001
    assert all(r.score < 0 and r.base_score < 0 for r in rows)


def test_stages_return_the_columns_of_their_input(spark, odd, few_labels, tmp_path):
    few_labels.write.parquet(f"{tmp_path}/labels.parquet")
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == odd.columns
        out.collect()
    last = corpus_pipeline.STAGES[-1][1](spark, odd, str(tmp_path))
    assert last.count() == len(ROWS)


def test_whole_texts_stay_in_the_mix(odd):
    whole = {r[1] for r in ROWS}
    mixed = mixing.mixed_documents(odd).collect()
    assert {r.text for r in mixed if r.doc_id in (7, 8)} <= whole
    taken = mixing.mix(odd).agg(F.sum("taken")).first()[0]
    assert sum(len(r.text.split()) for r in mixed) == taken
    assert labels  # the reader of the labels table is part of the interface


def test_pipeline_of_an_empty_table(spark, small, tmp_path):
    import corpus_pipeline

    spark.read.parquet(f"{small}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    folder = workspace.shared_folder(spark)
    before = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    # One folder a stage is left.
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left == {name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES}
