from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeveil.functions import masks
from lakeveil.functions.text import as_text


def test_doubles_print_as_python_does(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.0, 9999999.0, 1e7, 123456000.0, -123456789.125, 1e15, 1e16, 1.5e16, 1e-3, 1e-4, 1e-5, 1.5e-7,
              1e22, 1e100, float("nan"), float("inf"), float("-inf"), 99.5]
    values += [round(rng.uniform(-1e9, 1e9), 2) for _ in range(300)] + [rng.uniform(1e-6, 1e-3) for _ in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", as_text("x", T.DoubleType()).alias("t")).collect():
        expected = "0.0" if row.x == 0 else repr(row.x)
        # Older JVMs print some doubles with one digit more than needed.
        assert row.t == expected or float(row.t) == row.x


def test_other_types(spark):
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 120000)
    df = spark.createDataFrame(
        [(True, moment, moment.replace(microsecond=0), [1.5, None], ["a", None], dt.date(2024, 1, 2), None)],
        "b boolean, t timestamp, s timestamp, f array<double>, a array<string>, d date, n double",
    )
    row = df.select(*[as_text(f.name, f.dataType).alias(f.name) for f in df.schema.fields]).first()
    assert tuple(row) == (
        "True", "2024-01-02 03:04:05.120000", "2024-01-02 03:04:05", "[1.5, None]", "['a', None]", "2024-01-02", None
    )


def test_nested_types_and_bytes(spark):
    odd = ["plain", "it's", 'say "x"', "it's \"x\"", "a\\b", "tab\tline\nend\r", "\x00\x7f\x9f", "\u00a0\u200b\u2028", "é\U0001f600", ""]
    moments = [dt.datetime(2024, 1, 2, 3, 4), dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 0, 7)]
    rows = [
        (i, word.encode() + bytes([i, 255, 92, 39]), {word: 1.5e7, "k": None}, Row(a=word, b=Row(c=[1, None], d=moments[i % 3])),
         [Row(n=Decimal("1.50"), m={i: [word]}, t=dt.date(2024, 1, i + 1), z=None)], [[word, None], None, []], {})
        for i, word in enumerate(odd)
    ] + [(99, None, None, None, None, None, None), (100, b"", {}, Row(a=None, b=None), [None], [], {1: True})]
    schema = (
        "id int, bin binary, map map<string,double>, row struct<a:string,b:struct<c:array<int>,d:timestamp>>,"
        "list array<struct<n:decimal(5,2),m:map<int,array<string>>,t:date,z:binary>>, deep array<array<string>>, flag map<int,boolean>"
    )
    df = spark.createDataFrame(rows, schema)
    fields = [f for f in df.schema.fields if f.name != "id"]
    texts = {r.id: r for r in df.select("id", *[as_text(f.name, f.dataType).alias(f.name) for f in fields]).collect()}
    for row in df.collect():
        for f in fields:
            expected = None if row[f.name] is None else str(row[f.name])
            assert texts[row.id][f.name] == expected, (row.id, f.name)


MASKED = [
    # value, default, e-mail, phone, national id
    ("alice@example.com", "a" + "*" * 16, "a***@example.com", "ali************om", "ali**********.com"),
    ("a@b@c.org", "a********", "a********", "a@b****rg", "a@b**.org"),
    ("0912345678", "0*********", "0*********", "091*****78", "091***5678"),
    ("001234567890", "0***********", "0***********", "001*******90", "001*****7890"),
    ("abcd", "a***", "a***", "a***", "a***"),
    ("a\nbc", "a\n**", "a\n**", "a\n**", "a\n**"),
    ("a\r\nb\u2028c", "a\r\n*\u2028*", "a\r\n*\u2028*", "a\r\n*\u2028c", "a\r\n*\u2028*"),
    ("Đỗ Thị", "Đ*****", "Đ*****", "Đỗ *hị", "Đ*****"),
    ("", "", "", "", ""),
    (None, None, None, None, None),
]


def test_mask_values(spark):
    df = spark.createDataFrame([(m[0],) for m in MASKED], "v string")
    rows = df.select(
        "v", masks.partial_mask("v"), masks.email_mask("v"), masks.phone_mask("v"), masks.national_id_mask("v")
    ).collect()
    assert [tuple(r) for r in rows] == MASKED


def test_partial_mask_equals_the_plain_pattern(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab*$\\é\n\r\u0085 x😀 ") for _ in range(rng.randrange(0, 90))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for char, literal in (("*", "*"), ("$", "\\$"), ("\\", "\\\\"), ("ab", "ab")):
        plain = F.concat(F.substring("v", 1, 1), F.regexp_replace(F.substring("v", 2, 1000), ".", literal))
        assert df.where(masks.partial_mask("v", char) != plain).isEmpty(), char


def test_other_masks_and_types(spark):
    df = spark.createDataFrame([(5, "x"), (None, None)], "n int, `odd ``name` string")
    rows = df.select(
        masks.hash_mask("n").alias("h"),
        masks.redact_mask("n").alias("r"),
        masks.nullify_mask("n").alias("z"),
        masks.partial_mask("odd `name").alias("p"),
    )
    assert {f.dataType.simpleString() for f in rows.schema.fields} == {"string"}
    first, second = rows.collect()
    assert first.h == "ef2d127de37b942baad06145e54b0c619a1f22327b2ebbcfbec78f5564afe39d"
    assert (first.r, first.z, first.p) == ("[REDACTED]", None, "x")
    assert tuple(second) == (None, None, None, None)


@pytest.mark.parametrize("function", [None, "SHUFFLE", "NULLIFY"])
def test_unknown_function_hides(spark, function):
    df = spark.createDataFrame([("x",)], "v string")
    assert df.select(masks.mask_column("v", function, "EMAIL").alias("v")).first().v is None
