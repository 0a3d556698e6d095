"""Ingest, catalogue, scan and governed reads, end to end on generated tables."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from lakeveil.functions.draws import Draws
from lakeveil.operators import generate as gen
from lakeveil.operators import governed, policy, profile
from lakeveil.operators.governed import ColumnAction
from lakeveil.plans import jobs, seeds
from lakeveil.plans.schemas import SCHEMAS
from lakeveil.sources import catalog, ingest
from lakeveil.sources.store import MetadataStore
from lakeveil.sources.workspace import new_folder

AS_OF = dt.date(2026, 1, 1)
ROWS = 400


@pytest.fixture(scope="module")
def lake(spark):
    """(raw namespace, store): four tables through CSV, catalogued and scanned."""
    tag = uuid.uuid4().hex[:10]
    raw, folder = f"raw_{tag}", new_folder(spark, "csv")
    ingest.create_namespace(spark, raw, new_folder(spark, raw))
    for name in SCHEMAS:
        ingest.export_csv(gen.generate(spark, name, ROWS, as_of=AS_OF), f"{folder}/{name}.csv")
    results = ingest.ingest_all(spark, folder, SCHEMAS, raw)
    assert [(r.status, r.row_count) for r in results] == [("LOADED", ROWS)] * 4
    store = MetadataStore(spark, f"gov_{tag}").open(new_folder(spark, f"gov_{tag}"))
    assert {r.status for r in jobs.catalogue_namespace(spark, store, raw)} == {"LOADED"}
    summary, report = jobs.scan_namespace(spark, store, raw)
    assert {r.status for r in report} == {"LOADED"}
    assert summary.first().columns_scanned == sum(len(s.fields) + 1 for s in SCHEMAS.values())
    return raw, store


def test_csv_round_trip(spark, lake):
    raw, _ = lake
    for name in SCHEMAS:
        stored = spark.table(f"{raw}.{name}").drop(ingest.INGESTED_AT)
        made = gen.generate(spark, name, ROWS, as_of=AS_OF)
        # CSV does not tell an empty text from NULL.
        made = made.select(*[F.nullif(F.col(c), F.lit("")) if t == "string" else F.col(c) for c, t in made.dtypes])
        made = made.toDF(*stored.columns)
        assert stored.exceptAll(made).isEmpty() and made.exceptAll(stored).isEmpty(), name


def test_expected_classification(spark, lake):
    _, store = lake
    found = {
        f"{r.table_name}.{r.column_name}": (r.pii_category, r.detection_method)
        for r in store.read("columns_metadata").collect()
    }
    assert found["citizen_info.citizen_id"] == ("NATIONAL_ID", "MANUAL")
    assert found["citizen_info.full_name"] == ("FULL_NAME", "MANUAL")
    assert found["citizen_info.national_id"] == ("NATIONAL_ID", "HYBRID")
    assert found["citizen_info.phone_number"] == ("BANK_ACCOUNT", "REGEX")
    assert found["citizen_info.email"] == ("EMAIL", "HYBRID")
    assert found["citizen_info.birth_date"] == ("DATE_OF_BIRTH", "MANUAL")
    assert found["citizen_info.address"] == ("ADDRESS", "MANUAL")
    assert found["administrative_record.applicant_name"] == ("FULL_NAME", "MANUAL")
    assert found["administrative_record.cccd_number"] == ("NATIONAL_ID", "HYBRID")
    for name in ("hr_employee.c03", "hr_employee.c04", "hr_employee.c05", "transaction_log.source_account",
                 "transaction_log.tax_id", "transaction_log.amount", "hr_employee.c02"):
        assert found[name] == ("BANK_ACCOUNT", "REGEX"), name
    for name in ("citizen_info.occupation", "hr_employee.c01", "transaction_log.tx_type", "hr_employee._ingested_at"):
        assert found[name] == (None, "UNKNOWN"), name


def test_runs_are_idempotent(spark, lake):
    raw, store = lake
    before = [store.read(t).count() for t in ("tables_metadata", "columns_metadata", "pii_scan_record")]
    jobs.catalogue_namespace(spark, store, raw)
    unknown = store.read("columns_metadata").where("not scanned").count()
    jobs.scan_namespace(spark, store, raw)
    after = [store.read(t).count() for t in ("tables_metadata", "columns_metadata", "pii_scan_record")]
    assert after == [before[0], before[1], before[2] + unknown]
    stored = store.read("columns_metadata")
    assert stored.where(F.size("sample_values") > profile.STORED_SAMPLE_SIZE).isEmpty()


def test_new_column_is_found(spark, lake):
    raw, store = lake
    ingest.write_table(spark.range(5).select("id", F.lit("a@b.co").alias("mail")), f"{raw}.later")
    jobs.catalogue_namespace(spark, store, raw)
    ingest.write_table(spark.range(5).select("id", F.lit("a@b.co").alias("mail"), F.lit(1).alias("more")), f"{raw}.later")
    jobs.catalogue_namespace(spark, store, raw)
    names = store.read("columns_metadata").where("table_name = 'later'").orderBy("ordinal").collect()
    assert [r.column_name for r in names] == ["id", "mail", "more"]
    # A column that is gone fails its own table, and a dropped table only itself.
    ingest.write_table(spark.range(5).select("id"), f"{raw}.later")
    _, report = jobs.scan_namespace(spark, store, raw)
    assert {r.table_name for r in report if r.status == "FAILED"} == {"later"}
    spark.sql(f"DROP TABLE {raw}.later")
    _, report = jobs.scan_namespace(spark, store, raw)
    assert {r.table_name for r in report if r.status == "FAILED"} == {"later"}
    with pytest.raises(RuntimeError, match="later"):
        jobs.scan_namespace(spark, store, raw, strict=True)


def test_failing_history_leaves_columns_open(spark, monkeypatch):
    tag = uuid.uuid4().hex[:10]
    raw = f"raw_{tag}"
    ingest.create_namespace(spark, raw, new_folder(spark, raw))
    ingest.write_table(spark.range(3).select(F.lit("a@b.co").alias("email")), f"{raw}.t")
    store = MetadataStore(spark, f"gov_{tag}").open(new_folder(spark, f"gov_{tag}"))
    jobs.catalogue_namespace(spark, store, raw)

    def fail(table, rows):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(store, "append", fail)
        with pytest.raises(OSError):
            jobs.scan_namespace(spark, store, raw)
    assert store.read("columns_metadata").where("scanned").isEmpty()
    jobs.scan_namespace(spark, store, raw)
    assert store.read("columns_metadata").where("scanned").count() == 1
    assert store.read("pii_scan_record").count() == 1


def test_failing_reload_keeps_the_old_rows(spark):
    namespace = f"raw_{uuid.uuid4().hex[:10]}"
    ingest.create_namespace(spark, namespace, new_folder(spark, namespace))
    ingest.write_table(spark.range(10), f"{namespace}.t")
    with pytest.raises(Exception):
        ingest.write_table(spark.range(3).select(F.raise_error(F.lit("torn")).alias("id")), f"{namespace}.t")
    assert spark.table(f"{namespace}.t").count() == 10
    ingest.write_table(spark.range(4), f"{namespace}.t")
    assert spark.table(f"{namespace}.t").count() == 4


def test_namespaces_do_not_overwrite_each_other(spark):
    tag = uuid.uuid4().hex[:10]
    store = MetadataStore(spark, f"gov_{tag}").open(new_folder(spark, f"gov_{tag}"))
    row = ("select 'i' table_id, '{0}' namespace, '{1}' table_name, current_timestamp() created_at,"
           " current_timestamp() updated_at")
    store.append("tables_metadata", spark.sql(row.format("a", "x")).union(spark.sql(row.format("b", "y"))))
    old_a = store.read("tables_metadata").where("namespace = 'a'")
    store.replace_namespace("tables_metadata", spark.sql(row.format("b", "z")), "b")
    store.replace_namespace("tables_metadata", old_a.withColumn("table_name", F.lit("w")), "a")
    assert {(r.namespace, r.table_name) for r in store.read("tables_metadata").collect()} == {("a", "w"), ("b", "z")}


def test_many_tables_leave_nothing_cached(spark):
    tables = {f"t{i}": spark.range(3).selectExpr(f"id + {i} as v") for i in range(40)}
    assert profile.sample_tables(tables).count() == 120
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_joins_of_masked_sides(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "`k e` string, n int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "`k e` string, n int")
    inner = governed.masked_join(left, right, "k e", "k e").select(F.col("l.n"), F.col("r.n"))
    assert [tuple(r) for r in inner.collect()] == [(1, 10)]
    for how, expected in (("left", {(1, 10), (2, None), (3, None)}), ("full", {(1, 10), (2, None), (3, None), (None, 20)})):
        met = governed.masked_join(left, right, "k e", "k e", how)
        assert "lakeveil_spread" not in met.columns
        assert {tuple(r) for r in met.select(F.col("l.n"), F.col("r.n")).collect()} == expected


@pytest.mark.parametrize("role", ["ANALYST", "AUDITOR"])
def test_no_high_or_medium_value_leaks(spark, lake, role):
    raw, store = lake
    columns = store.read("columns_metadata").where("sensitivity in ('HIGH', 'MEDIUM')").collect()
    assert columns
    for table in SCHEMAS:
        seen = jobs.governed_table(spark, store, raw, table, role)
        plain = spark.table(f"{raw}.{table}")
        assert seen.columns == plain.columns
        for c in [r.column_name for r in columns if r.table_name == table]:
            shown = seen.select(F.col(c).alias("v")).where("v is not null and length(v) > 1")
            values = plain.select(F.col(c).cast("string").alias("v"))
            assert shown.join(values, "v", "left_semi").isEmpty(), (table, c)


def test_admin_sees_all(spark, lake):
    raw, store = lake
    for table in SCHEMAS:
        seen, plain = jobs.governed_table(spark, store, raw, table, "ADMIN"), spark.table(f"{raw}.{table}")
        assert seen.schema == plain.schema and seen.exceptAll(plain).isEmpty()


def test_reader_errors(spark, lake):
    raw, store = lake
    message = "no readable column"
    with pytest.raises(ValueError, match=message):
        jobs.governed_table(spark, store, raw, "citizen_info", "ANALYST", ["email", "phone", "address"])
    with pytest.raises(ValueError, match="no role named 'GUEST'"):
        jobs.governed_table(spark, store, raw, "citizen_info", "GUEST")
    with pytest.raises(ValueError, match="nothing catalogued"):
        jobs.governed_table(spark, store, raw, "nowhere", "ADMIN")
    projected = jobs.governed_table(spark, store, raw, "citizen_info", "ANALYST", ["email", "address"])
    assert projected.columns == ["email", "address"]
    assert projected.where("email not like '_***@%'").isEmpty()


def test_policy_truth_table(spark):
    columns = spark.createDataFrame(
        [("n", "t", f"c{i}", "EMAIL", level) for i, level in enumerate(["HIGH", "MEDIUM", "LOW", "NONE", None])],
        "namespace string, table_name string, column_name string, category string, sensitivity string",
    )
    custom = {"R": {"HIGH": ("DENY", None), "MEDIUM": ("MASK", "NULLIFY"), "LOW": ("MASK", None)}}
    plan = policy.access_plan(columns, seeds.access_policies(spark, custom), ["R"])
    actions = governed.collect_actions(plan)
    assert [(a.action, a.masking_function) for _, a in sorted(actions.items())] == [
        ("DENY", None), ("MASK", "NULLIFY"), ("MASK", None), ("ALLOW", None), ("ALLOW", None)
    ]
    df = spark.createDataFrame([("x",) * 6], [f"c{i}" for i in range(6)])
    assert governed.govern(df, actions).first().asDict() == {"c1": None, "c2": None, "c3": "x", "c4": "x", "c5": "x"}
    assert governed.govern(df, actions, unknown="deny").columns == ["c1", "c2", "c3", "c4"]
    for name in ("c0", "c5"):
        with pytest.raises(ValueError):
            governed.govern(df, actions, ["c3", name])


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_governed_plan_is_pruned_and_pushed(spark, small):
    df = spark.read.parquet(f"{small}/customer.parquet")
    actions = {"c_custkey": ColumnAction("c_custkey", "MASK", "HASH_MASK")}
    text = _plan(governed.govern(df, actions).where("c_mktsegment = 'BUILDING'").select("c_custkey"))
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    # A predicate on a masked column must stay above the mask.
    masked = _plan(governed.govern(df, actions).where("c_custkey = '5'").select("c_name"))
    assert "EqualTo(c_custkey" not in masked and "Python" not in masked


def test_samples_shuffle_only_candidates(spark, small):
    df = spark.read.parquet(f"{small}/lineitem.parquet")
    bounds = profile._digest_bounds({"l": df}, {"l": df.columns}, 50)
    assert ("l", "l_extendedprice") in bounds and ("l", "l_returnflag") not in bounds
    kept = profile._candidates(df, "l", ["l_extendedprice"], bounds).distinct().count()
    assert 50 <= kept < 1000


def test_interrupted_swap_is_finished(spark):
    namespace = f"gov_{uuid.uuid4().hex[:10]}"
    store = MetadataStore(spark, namespace).open(new_folder(spark, namespace))
    store.append("tables_metadata", spark.sql(
        "select 'i' table_id, 'n' namespace, 't' table_name, current_timestamp() created_at, current_timestamp() updated_at"))
    store.read("tables_metadata").write.saveAsTable(f"{namespace}.tables_metadata__next")  # as an earlier version left it
    spark.sql(f"DROP TABLE {namespace}.tables_metadata")
    assert store.open().read("tables_metadata").count() == 1


def test_ingest_details(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "hr_employee.csv").write_text(
        "employee_id,department,job_title,c01,c02,c03,c04,c05,remarks\n"
        'x,"say ""hi"", x",j,n,not a number,1,2,3,\n1,d,j,n,2.5,1,2,3,r\n', encoding="utf-8")
    df = ingest.read_typed_csv(spark, str(folder / "hr_employee.csv"), SCHEMAS["hr_employee"])
    bad, good = sorted(df.collect(), key=lambda r: r.employee_id or 0)
    assert (bad.employee_id, bad.department, bad.c02, bad.remarks) == (None, 'say "hi", x', None, None)
    assert (good.employee_id, good.c02) == (1, 2.5)
    (folder / "lines.csv").write_text('a,b\n1,"x\ny"\n', encoding="utf-8")
    lines = ingest.read_typed_csv(spark, str(folder / "lines.csv"), "a int, b string", multi_line=True)
    assert [tuple(r) for r in lines.collect()] == [(1, "x\ny")]
    result = ingest.ingest_table(spark, str(folder / "none.csv"), SCHEMAS["hr_employee"], "default.none")
    assert result.status == "SKIPPED"
    with pytest.raises(RuntimeError):
        ingest.raise_on_failure([ingest.IngestResult("t", "FAILED", error="e")])


def test_catalog_listing(spark, lake):
    raw, _ = lake
    spark.range(1).createOrReplaceTempView("a_view")
    assert catalog.table_names(spark, raw) == sorted(SCHEMAS)
    assert raw in [r.namespace for r in catalog.list_namespaces(spark).collect()]


# ------------------------------------------------------------ generation


def test_rows_do_not_depend_on_partitioning(spark):
    for name in SCHEMAS:
        one = gen.generate(spark, name, 200, 7, AS_OF)
        other = gen.generate_for(spark.range(0, 200, 1, 5), name, 7, AS_OF)
        assert one.exceptAll(other).isEmpty() and one.count() == 200
        assert not one.exceptAll(gen.generate(spark, name, 200, 8, AS_OF)).isEmpty()
    with pytest.raises(ValueError, match="no generator"):
        gen.generate(spark, "nothing")


def test_value_shapes(spark):
    citizens = gen.generate(spark, "citizen_info", 2000, as_of=AS_OF)
    assert citizens.where("national_id not rlike '^0[0-9]{11}$'").isEmpty()
    assert citizens.where("phone_number not rlike '^(03|05|07|08|09)[0-9]{8}$'").isEmpty()
    assert citizens.where("birth_date > '2008-01-01' or birth_date < '1926-01-01'").isEmpty()
    log = gen.generate(spark, "transaction_log", 5000, as_of=AS_OF)
    assert log.where("tax_id not rlike '^([0-9]{10}|[0-9]{9}-[0-9]{3})$'").isEmpty()
    assert log.where("length(source_account) not in (10, 12, 13, 14)").isEmpty()
    assert log.where("amount % 1000 <> 0 or amount < 10000 or amount > 500000000").isEmpty()
    assert log.where("tx_message like '%${%' or fraud_notes like '%${%'").isEmpty()
    share = log.selectExpr("count(fraud_notes) / count(1)").first()[0]
    assert 0.003 < share < 0.016
    plain = log.selectExpr("avg(cast(tax_id rlike '^[0-9]{10}$' as int))").first()[0]
    assert 0.65 < plain < 0.75


def test_repeated_and_unknown_placeholders(spark):
    texts = ["${email} and ${email}, not ${other}", "plain ${email}"]
    draws = Draws()
    template = gen.Template("note", texts, ["email"], draws)
    pool = spark.createDataFrame([(0, True, template.texts[0]), (1, False, template.texts[1])],
                                 "template_index bigint, contain_pii boolean, template_text string")
    rows = draws.attach(spark.range(2).toDF("row_id"), 1, "t")
    filled = template.join(rows, pool, "row_id").selectExpr("*", *template.values())
    first, second = [r.note for r in filled.selectExpr("row_id", f"{template.rendered()} as note").orderBy("row_id").collect()]
    left, rest = first.split(" and ")
    assert "@" in left and "@" in rest and left != rest.split(",")[0] and rest.endswith("not ${other}")
    assert second == "plain ${email}"
