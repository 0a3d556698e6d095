"""Very long matches and words end no executor."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeveil.llm import exact_dedup, line_dedup, mixing_lm, pseudonyms, secrets

LONG = 1 << 20


def one(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id bigint, text string")


def test_long_hosts_and_addresses(spark):
    host = "a" + ".a" * (LONG // 2)
    row = secrets.scan(one(spark, f"password=abcdefghijklmnop host: {host}")).first()
    assert row.n_assign == 1 and row.n_linked == 1 and row.spans.endswith(f"endpoint:26:{32 + len(host)}")
    row = pseudonyms.pseudonymised(one(spark, f"mail x@{host}"), "k").first()
    assert row.n_values == 1 and row.kinds == "email" and len(row.text) < 50


def test_many_matches_in_one_text(spark):
    """Digits in groups match from every group; the pieces are put together in linear time."""
    numbers = " ".join(f"{i % 90 + 10} 00" for i in range(2000))
    row = pseudonyms.pseudonymised(one(spark, numbers + " x@y.org" * 1500), "k").first()
    assert row.kinds.count("email") == 1500 and row.text.endswith("@mail.invalid")


def test_social_security_numbers(spark):
    draw = random.Random(1)
    good = {f"{a:03}-{draw.randrange(1, 100):02}-{draw.randrange(1, 10000):04}" for a in range(1, 900) if a != 666}
    bad = ["000-12-3456", "666-12-3456", "900-12-3456", "123-00-3456", "123-45-0000"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*sorted(good), *bad])], "doc_id bigint, text string")
    found = {r.doc_id: (r.text, r.n_values) for r in pseudonyms.pseudonymised(df, "k").collect()}
    new = [found[i][0] for i in range(len(good))]
    assert all(found[i][1] == 1 for i in range(len(good))) and len(set(new)) == len(good)
    assert all(found[len(good) + i] == (v, 0) for i, v in enumerate(bad))
    again = spark.createDataFrame([(i, v) for i, v in enumerate(new)], "doc_id bigint, text string")
    assert pseudonyms.pseudonymised(again, "k").where("n_values = 0").isEmpty()


def test_long_words_are_scored_in_parts(monkeypatch):
    draw = random.Random(2)
    words = [bytes(draw.choice(b"abcdef") for _ in range(n)) for n in (3, 500, 1, 64, 65, 129, 7)]
    whole = [mixing_lm.bit_slots([w]) for w in words]
    monkeypatch.setattr(mixing_lm, "_LONG_WORD", 64)
    parts: dict[int, list] = {}
    for i, j, slots, bits, word, bit in mixing_lm.slot_parts(words, limit=1):
        assert j == i + 1 and not word.any()
        parts.setdefault(i, []).append((slots, bits, bit))
    for i, expected in enumerate(whole):
        for k, at in ((0, 0), (1, 1), (2, 3)):
            assert np.array_equal(np.concatenate([p[k] for p in parts[i]], axis=-1), expected[at])


def test_a_word_of_megabytes(spark):
    rows = [(1, "x" * (4 << 20)), (2, "some plain words here"), (3, "some other words here")]
    found = {r.doc_id: r for r in mixing_lm.scored(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1].n_tokens == 2 and found[1].score < 0 and found[2].n_tokens == 5


@pytest.mark.parametrize("text", ["y" * (8 << 20), "ab\n" * LONG])
def test_long_texts_and_many_lines(spark, text):
    rows = spark.createDataFrame([(1, text), (2, "short"), (3, text)], "doc_id bigint, text string")
    assert line_dedup.line_dedup(rows).agg(F.count("kept_sha256")).first()[0] == 3
    assert exact_dedup.exact_dedup(rows).where("doc_id = 1").first().keep_id == 3
