"""The detectors' decisions, case by case."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lakeveil.functions.text import as_text
from lakeveil.operators import classify, profile
from lakeveil.plans.seeds import RULES

SIX = [r for r in RULES if r.code in ("NATIONAL_ID", "PHONE", "EMAIL", "SALARY", "FULL_NAME", "ADDRESS")]

LONG_NUMBERS = [f"{700000 + i * 37:012d}" for i in range(50)]
MOBILES = [f"03{i * 12345:08d}" for i in range(50)]

# column, samples, category, confidence, method
CASES = [
    ("nationalId", [], "NATIONAL_ID", 1.0, "MANUAL"),
    ("old_cmnd_2", [], "NATIONAL_ID", 0.7, "MANUAL"),
    ("SDT", [], "PHONE", 1.0, "MANUAL"),
    ("colour", [], None, 0.0, "UNKNOWN"),
    ("net-salary", [], "SALARY", 0.7, "MANUAL"),
    ("f1", LONG_NUMBERS, "NATIONAL_ID", 1.0, "REGEX"),
    ("f2", MOBILES[:36] + ["-"] * 14, "PHONE", 0.72, "REGEX"),
    ("f3", ["q.w@mail.test"] * 11 + ["n/a"] * 9, None, 0.55, "UNKNOWN"),
    ("identity_number", LONG_NUMBERS, "NATIONAL_ID", 1.0, "HYBRID"),
    ("address", MOBILES, "PHONE", 1.0, "REGEX"),
    ("HoTen", ["Mai", "Quân"], "FULL_NAME", 1.0, "MANUAL"),
]


def _run(spark, cases, rules, **options):
    columns = spark.createDataFrame([("t", c[0]) for c in cases], "table_name string, column_name string")
    rows = [("t", c[0], i, v) for c in cases for i, v in enumerate(c[1])]
    samples = spark.createDataFrame(
        rows, "table_name string, column_name string, sample_rank int, sample_value string"
    )
    found = classify.classify(columns, samples, rules, **options).collect()
    return {r.column_name: (r.category, r.confidence, r.detection_method, r.sensitivity) for r in found}


def test_decisions(spark):
    found = _run(spark, CASES, SIX)
    for name, _, category, confidence, method in CASES:
        assert found[name][0] == category, name
        assert found[name][1] == pytest.approx(confidence, abs=1e-9), name
        assert found[name][2] == method, name


def test_rule_order_decides(spark):
    cases = [
        ("phone_number", MOBILES),
        ("company_name", []),
        ("work_location", []),
        ("c_custkey", []),
        ("hotel", []),
        ("Họ và tên", []),
        ("Email-Address", []),
        ("dob", ["12345678"] + ["x"] * 49),
    ]
    found = _run(spark, cases, RULES)
    assert found["phone_number"][:3] == ("BANK_ACCOUNT", 1.0, "REGEX")
    assert found["company_name"][:2] == ("FULL_NAME", 0.7)
    assert found["work_location"][:2] == ("ADDRESS", 0.7)
    assert found["c_custkey"][:2] == ("BANK_ACCOUNT", 0.7)
    assert found["hotel"][:2] == ("PHONE", 0.7)
    assert found["Họ và tên"][0] is None
    assert found["Email-Address"][:2] == ("EMAIL", 1.0)
    # A weak pattern of another category drops a perfect name match.
    assert found["dob"] == (None, 0.02, "UNKNOWN", None)


def test_options(spark):
    found = _run(spark, [("company_name", []), ("notes", ["id 123456789012"] * 3)], RULES, priority="best")
    assert found["company_name"][:2] == ("WORKPLACE", 1.0)
    assert found["notes"][0] == "NATIONAL_ID"
    anchored = _run(spark, [("notes", ["id 123456789012"] * 3)], RULES, match_mode="anchored")
    assert anchored["notes"][0] is None
    with pytest.raises(ValueError):
        _run(spark, [("a", [])], RULES, priority="last")


def test_hybrid_weights_and_threshold_edge(spark):
    # 0.8 * 0.625 + 0.2 * 1.0 = 0.7 passes; one match less does not.
    edge = [("email", ["a@b.co"] * 5 + ["x"] * 3), ("mail", ["a@b.co"] * 4 + ["x"] * 4)]
    found = _run(spark, edge, RULES)
    assert found["email"][0] == "EMAIL" and found["email"][2] == "HYBRID"
    assert found["mail"][0] is None and found["mail"][1] == pytest.approx(0.6)


@pytest.mark.parametrize("pattern", [r.pattern for r in RULES if r.pattern] + [r"(a|b@)c", r"x@?y", r"(07|08)?[0-9]{3}"])
def test_shortcuts_do_not_change_matches(spark, pattern):
    values = ["", "@", "a@b.co", "x a1@b-c.org y", "b@c", "ac", "xy", "x@y", "0912345678", "07123", "123", "12",
              "123456789-012", "1" * 25, "tel 0351234567.", "1234567", "12345678"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    wrong = df.where(F.expr(classify.found_sql("v", pattern)) != F.col("v").rlike(pattern))
    assert wrong.isEmpty()


def _brute(values, k):
    import hashlib

    distinct = {v for v in values if v is not None}
    return sorted(distinct, key=lambda v: (hashlib.md5(v.encode()).hexdigest(), v))[:k]


def test_samples_match_brute_force(spark):
    # One value holds a third of all rows, one column has few values, one has none.
    rows = [(f"v{i}" if i % 3 else "hot", f"f{i % 7}", None) for i in range(6000)]
    df = spark.createDataFrame(rows, "many string, few string, none string").repartition(4)
    found = {}
    for r in profile.sample_tables({"t": df}, sample_size=20).orderBy("sample_rank").collect():
        found.setdefault(r.column_name, []).append(r.sample_value)
    assert found["many"] == _brute([r[0] for r in rows], 20)
    assert found["few"] == _brute([r[1] for r in rows], 20)
    assert "none" not in found


def test_shortfall_is_read_again(spark, monkeypatch):
    rows = [(f"v{i}",) for i in range(2000)]
    df = spark.createDataFrame(rows, "a string")
    # A bound that is far too tight must not lose samples.
    monkeypatch.setattr(profile, "_digest_bounds", lambda tables, columns, k: {("t", "a"): "00" + "0" * 10})
    found = [r.sample_value for r in profile.sample_tables({"t": df}).orderBy("sample_rank").collect()]
    assert found == _brute([r[0] for r in rows], 50)


def test_quoted_column_names(spark):
    df = spark.createDataFrame([("x", 1)], ["it's `odd`", "a.b"])
    found = {(r.column_name, r.sample_value) for r in profile.sample_tables({"t": df}).collect()}
    assert found == {("it's `odd`", "x"), ("a.b", "1")}


def test_few_values_are_gathered_before_their_texts(spark, monkeypatch):
    # Every 12th text, number or time comes again and again; three columns have many values.
    df = spark.range(30_000).repartition(4).selectExpr(
        "concat('t', id % 12) as few_text", "if(id % 12 = 0, null, (id % 12 - 6) * 1e9) as few_double", "-0.0D * (id % 2) as zero",
        "cast(id % 12 as float) / 3 as few_float", "id % 2 = 0 as few_boolean", "timestamp_ntz'2020-01-01 00:00:00' +"
        " make_dt_interval(0, 0, 0, (id % 12) / 4) as few_time", "date_add(date'2020-01-01', cast(id % 500 as int)) as days",
        "array(id % 3) as few_array", "cast(null as string) as none", "id as many", "cast(id as string) as many_text", "id / 7 as many_double")
    tables, chosen = {"t": df}, {"t": df.columns}
    bounds = profile._digest_bounds(tables, chosen, 20)
    few = profile._few(tables, chosen, bounds, 20)
    assert {c for _, c in few} == {c for c in df.columns if "few" in c and "array" not in c} | {"zero", "days", "none"}
    assert {c for _, c in bounds} == {"days", "many", "many_text", "many_double"}
    # Before, each row of the table was a candidate.
    assert profile._candidates(df, "t", ["few_text"], bounds, few).count() == 12
    plain = df.select(*[as_text(c, df.schema[c].dataType).alias(c) for c in df.columns]).collect()
    for branches in (24, 2):
        monkeypatch.setattr(profile, "_BRANCHES", branches)
        found = {c: [] for c in df.columns}
        for r in profile.sample_tables(tables, sample_size=20).orderBy("sample_rank").collect():
            found[r.column_name].append(r.sample_value)
        assert found == {c: _brute([r[c] for r in plain], 20) for c in df.columns}


def test_columns_with_many_values_are_read_alone(spark, tmp_path):
    spark.range(30_000).selectExpr("id as a", "id * 2 as b", "id % 3 as c").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    bounds = profile._digest_bounds({"t": df}, {"t": df.columns}, 20)
    values = profile._candidates(df, "t", df.columns, bounds, profile._few({"t": df}, {"t": df.columns}, bounds, 20))
    plan = values._jdf.queryExecution().executedPlan().toString()
    assert all(f"ReadSchema: struct<{c}:bigint>" in plan for c in "abc")


def test_repeats_within_a_task_are_dropped_before_digests(spark):
    # 12,000 values come 40 times each, 20 times in a task; the others come once.
    df = spark.range(0, 480_000, numPartitions=2).selectExpr(
        "id % 12000 as key", "(id % 12000 - 6000) / 4 as price", "timestamp_ntz'2020-01-01 00:00:00' +"
        " make_dt_interval(0, 0, 0, (id % 12000) / 4) as moment", "id as alone", "if(id < 1000, id, null) as rare",
        "concat('f', id % 7) as few", "cast(null as boolean) as none", "id % 2 = 0 as odd", "cast(id as string) as text")
    tables, names = {"t": df}, ["key", "price", "moment"]
    bounds = profile._digest_bounds(tables, {"t": df.columns}, 20)
    values = profile._candidates(df, "t", names, bounds, profile._few(tables, {"t": df.columns}, bounds, 20))
    found = [tuple(r) for r in values.collect()]
    # Before, each of the 40 occurrences of a value under its bound was a candidate.
    assert len(found) == len(set(found)) and {c for _, c, _ in found} == set(names)
    assert {c for _, c in bounds.repeated} == set(names)
    plain = df.select(*[as_text(c, df.schema[c].dataType).alias(c) for c in df.columns]).collect()
    samples = {c: [] for c in df.columns}
    for r in profile.sample_tables(tables, sample_size=20).orderBy("sample_rank").collect():
        samples[r.column_name].append(r.sample_value)
    assert samples == {c: _brute([r[c] for r in plain], 20) for c in df.columns}
    counts = {r.column_name: r for r in profile.distinct_estimates(tables).collect()}
    assert 0.8 < counts["key"].approx_distinct / 12_000 < 1.2 and 0.8 < counts["key"].within_tasks / 24_000 < 1.2
    assert 0.9 < counts["alone"].within_tasks / 480_000 < 1.1 and 0.99 < counts["alone"].n_rows / 480_000 < 1.01
    assert set(counts) == set(df.columns) and counts["none"].approx_distinct == 0


def test_shuffle_of_a_column_without_repeats_in_its_tasks_is_left_out(spark):
    # Every value comes ten times, but in ten different tasks: distinct there would shuffle every row.
    df = spark.range(0, 400_000, numPartitions=10).selectExpr("id % 40000 as spread")
    bounds = profile._digest_bounds({"t": df}, {"t": ["spread"]}, 20)
    assert ("t", "spread") in bounds and not bounds.repeated


def _schemas(df):
    return re.findall(r"ReadSchema: struct<(.*?)>", df._jdf.queryExecution().executedPlan().toString())


def test_columns_of_files_that_cannot_be_split_are_read_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(profile, "_MANY_ROWS", 20_000)
    rows = spark.range(30_000).selectExpr(
        "id as many", "concat('m', id) as text", "id % 3 as few", "concat('f', id % 5) as tag", "if(id % 2 = 0, id % 700 / 4, null) as half")
    rows.repartition(1).write.parquet(f"{tmp_path}/t")
    one = spark.read.parquet(f"{tmp_path}/t")
    # Before, one task hashed all columns, and another gathered all those with few values.
    assert max(s.count(":") for s in _schemas(profile.distinct_estimates({"t": one}))) == 4
    bounds = profile._digest_bounds({"t": one}, {"t": one.columns}, 20)
    few = profile._few({"t": one}, {"t": one.columns}, bounds, 20)
    assert {c for _, c in few} == {"few", "tag", "half"} and bounds.narrow == {"t"}
    candidates = profile._candidates(one, "t", one.columns, bounds, few)
    assert sorted(s.split(":")[0] for s in _schemas(candidates)) == sorted(one.columns)
    # Each of the five reads ends in a shuffle of its own.
    assert candidates._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 5
    samples = {}
    for r in profile.sample_tables({"t": one}, sample_size=20).orderBy("sample_rank").collect():
        samples.setdefault(r.column_name, []).append(r.sample_value)
    plain = one.select(*[as_text(c, one.schema[c].dataType).alias(c) for c in one.columns]).collect()
    assert samples == {c: _brute([r[c] for r in plain], 20) for c in one.columns}


def test_columns_with_few_values_share_a_scan_where_tasks_fill_the_cores(spark, monkeypatch):
    monkeypatch.setattr(profile, "_MANY_ROWS", 2_000)
    cores = spark.sparkContext.defaultParallelism
    for parts, n_rows, narrow in ((cores, 60_000, set()), (cores - 1, 60_000, {"t"}), (2, 3_000, set())):
        df = spark.range(0, n_rows, numPartitions=parts).selectExpr("id", "id % 3 as few")
        found = {(r.n_tasks, r.n_rows) for r in profile.distinct_estimates({"t": df}).collect()}
        assert {n for n, _ in found} == {parts} and all(0.9 < n / n_rows < 1.1 for _, n in found)
        assert profile._digest_bounds({"t": df}, {"t": df.columns}, 20).narrow == narrow
