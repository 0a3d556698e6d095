"""Replacement without gaps, namespaces side by side, views per role, audits of cells, samples that grow, scan state."""

from __future__ import annotations

import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeveil.functions import masks
from lakeveil.operators import profile
from lakeveil.plans import jobs, seeds
from lakeveil.sources import catalog, dimensions, ingest, versions, workspace
from lakeveil.sources.store import MetadataStore, merged_state
from lakeveil.sources.workspace import new_folder


def namespace_of(spark, label):
    name = f"{label}_{uuid.uuid4().hex[:10]}"
    ingest.create_namespace(spark, name, new_folder(spark, name))
    return name


def store_of(spark):
    name = f"gov_{uuid.uuid4().hex[:10]}"
    return MetadataStore(spark, name).open(new_folder(spark, name))


def people(spark, n=3):
    return spark.range(n).selectExpr(
        "concat('00123456789', id) as national_id", "concat('Lan ', id) as full_name", "concat('u', id, '@ex.org') as email",
        "id as amount_in_cents")


# ---------------------------------------------------------- gapless replacement


def test_readers_never_miss_a_table_that_is_reloaded(spark):
    table = f"{namespace_of(spark, 'raw')}.t"
    ingest.write_table(spark.range(10), table)
    stop, seen, faults = threading.Event(), set(), []

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(table).agg(F.count("id"), F.max("id")).first())
            except Exception as error:
                faults.append(str(error)[:200])

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(11, 17):
        ingest.write_table(spark.range(n), table)
    stop.set()
    reader.join()
    assert not faults, faults[:2]
    assert len(seen) > 1 and all(top == count - 1 for count, top in seen)
    folder = os.path.dirname(versions.location(spark, table).removeprefix("file:"))
    assert len([f for f in os.listdir(folder) if f.startswith("t__v")]) == 2
    ingest.write_table(spark.table(table).where("id < 5"), table)  # derived from itself
    assert spark.table(table).count() == 5


def test_reload_with_other_columns(spark):
    table = f"{namespace_of(spark, 'raw')}.t"
    ingest.write_table(spark.range(3), table)
    ingest.write_table(spark.range(4).selectExpr("id", "'x' as more"), table)
    assert [tuple(r) for r in spark.table(table).orderBy("id").collect()][3] == (3, "x")
    ingest.write_table(spark.range(2).selectExpr("cast(id as string) as id"), table)
    assert spark.table(table).dtypes == [("id", "string")] and spark.table(table).count() == 2
    for n in (3, 4, 5):
        ingest.write_table(spark.range(n).selectExpr("cast(id as string) as id"), table)
        assert spark.table(table).count() == n
        if n != 4:  # dropped by hand after one and after two versions
            spark.sql(f"DROP TABLE {table}")


# --------------------------------------------------------------- two namespaces


def test_scan_of_one_namespace_leaves_the_other_governed(spark):
    store, names = store_of(spark), [namespace_of(spark, "na"), namespace_of(spark, "nb")]
    for name in names:
        ingest.write_table(people(spark), f"{name}.people")
        jobs.catalogue_namespace(spark, store, name)
        jobs.scan_namespace(spark, store, name)
    for name in names + names:
        seen = jobs.governed_table(spark, store, name, "people", "ANALYST").collect()
        assert all(len(r.national_id) == 64 and r.email.startswith("u***@") and r.full_name[1:] == "****" for r in seen)
        jobs.scan_namespace(spark, store, names[0])
    for table in ("columns_metadata", "pii_scan_state"):
        assert {r.namespace for r in store.read(table).select("namespace").distinct().collect()} == set(names)


def test_a_registered_table_without_columns_is_an_error(spark):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    ingest.write_table(people(spark), f"{raw}.people")
    jobs.catalogue_namespace(spark, store, raw)
    store.replace_namespace("columns_metadata", store.read("columns_metadata").where("false"), raw)
    with pytest.raises(ValueError, match="registered without columns"):
        jobs.governed_table(spark, store, raw, "people", "ADMIN")
    with pytest.raises(ValueError, match="registered without columns"):
        jobs.publish_views(spark, store, raw, "ADMIN", f"{raw}_views")


def test_a_failing_update_keeps_the_old_rows(spark):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    ingest.write_table(people(spark), f"{raw}.people")
    jobs.catalogue_namespace(spark, store, raw)
    before = store.read("columns_metadata").count()
    torn = store.read("columns_metadata").withColumn("data_type", F.raise_error(F.lit("torn")))
    with pytest.raises(Exception, match="torn"):
        store.replace_namespace("columns_metadata", torn, raw)
    assert store.read("columns_metadata").count() == before > 0


# ---------------------------------------------------------------------- views


ODD = ["alice@example.com", "a@b@c.org", "0912345678", "001234567890", "abcd", "a\nbc", "", None, "x y\r\nz", "Đặng $1 \\ ''", "é", "${x}"]


def test_masks_as_text_are_the_masks(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ODD)], "i int, `v v` string")
    for function in ("PARTIAL_MASK", "HASH_MASK", "REDACT", "NULLIFY", None, "OTHER"):
        for category in ("EMAIL", "PHONE", "NATIONAL_ID", "ADDRESS", None):
            one = df.select("i", masks.mask_column("v v", function, category).alias("m"))
            other = df.selectExpr("i", f"{masks.mask_sql('`v v`', function, category)} as m")
            assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect())), (function, category)


def test_views_show_what_governed_reads_show(spark):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    ingest.write_table(people(spark, 50), f"{raw}.people")
    ingest.write_table(spark.range(4).selectExpr("id as n", "'+' as `sign of`"), f"{raw}.plain")
    jobs.catalogue_namespace(spark, store, raw)
    jobs.scan_namespace(spark, store, raw)
    for role in seeds.ROLES:
        views = f"{raw}_{role.lower()}"
        made = jobs.publish_views(spark, store, raw, role, views)
        assert {r.status for r in made} == {"LOADED"} and len(made) == 2
        for table in ("people", "plain"):
            view, seen = spark.sql(f"SELECT * FROM {views}.{table}"), jobs.governed_table(spark, store, raw, table, role)
            assert view.schema.names == seen.schema.names and view.dtypes == seen.dtypes
            assert view.exceptAll(seen).isEmpty() and seen.exceptAll(view).isEmpty()
        again = jobs.publish_views(spark, store, raw, role, views)
        assert {r.status for r in again} == {"UNCHANGED"}
    analysts = f"{raw}_analyst"
    plan = spark.sql(f"SELECT national_id FROM {analysts}.people WHERE amount_in_cents = 7")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<national_id:string,amount_in_cents:bigint>" in plan and "EqualTo(amount_in_cents,7)" in plan
    masked = spark.sql(f"SELECT full_name FROM {analysts}.people WHERE national_id = 'x'")._jdf.queryExecution().toString()
    assert "EqualTo(national_id" not in masked


def test_views_follow_the_plan_and_the_tables(spark):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    views = f"{raw}_views"
    ingest.write_table(people(spark), f"{raw}.people")
    ingest.write_table(spark.range(1), f"{raw}.other")
    jobs.catalogue_namespace(spark, store, raw)
    jobs.publish_views(spark, store, raw, "ANALYST", views)
    assert spark.table(f"{views}.people").agg(F.min("email")).first()[0] == "u0@ex.org"  # not scanned yet: no level, allowed
    jobs.scan_namespace(spark, store, raw)
    status = {r.table_name: r.status for r in jobs.publish_views(spark, store, raw, "ANALYST", views)}
    assert status == {"people": "LOADED", "other": "UNCHANGED"}
    assert spark.table(f"{views}.people").agg(F.min("email")).first()[0] == "u***@ex.org"
    # A column added later isn't in the view until it is published again.
    ingest.write_table(people(spark).withColumn("phone", F.lit("0912345678")), f"{raw}.people")
    assert "phone" not in spark.table(f"{views}.people").columns
    jobs.publish_views(spark, store, raw, "ANALYST", views)
    assert "phone" in spark.table(f"{views}.people").columns
    jobs.publish_views(spark, store, raw, "ANALYST", views, unknown="deny")
    assert "phone" not in spark.table(f"{views}.people").columns
    spark.sql(f"DROP TABLE {raw}.other")
    status = {r.table_name: r.status for r in jobs.publish_views(spark, store, raw, "ANALYST", views, unknown="deny")}
    assert status == {"people": "UNCHANGED", "other": "DROPPED"} and catalog.table_names(spark, views) == ["people"]


# --------------------------------------------------------------- audit of cells

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("Name of", T.StringType()),
    T.StructField("day", T.DateType()), T.StructField("amount", T.DoubleType()),
])


def test_cells_that_do_not_fit_are_counted_and_kept(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = ["id,Name of,day,amount", '1,"a ""b"", c",2024-01-02,1.5', "x,b,2024-01-02,2", "3,,31/12/2024,n/a", ",,,", "5,e,2024-01-02"]
    (folder / "t.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    raw = namespace_of(spark, "raw")
    [result] = ingest.ingest_all(spark, str(folder), {"t": SCHEMA}, raw, audited=True)
    assert (result.status, result.row_count) == ("LOADED", 5)
    assert result.cells_lost == {"id": 1, "Name of": 0, "day": 1, "amount": 1}
    plain = ingest.read_typed_csv(spark, str(folder / "t.csv"), SCHEMA)
    kept = spark.table(f"{raw}.t").drop(ingest.INGESTED_AT)
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))
    rejects = {r.line: r.columns for r in spark.table(f"{raw}.t__rejects").collect()}
    assert rejects == {lines[2]: ["id"], lines[3]: ["day", "amount"], lines[5]: []}
    assert {tuple(r) for r in ingest.lost_cells(spark, [result]).where("cells_lost > 0").collect()} == {
        ("t", "id", 1), ("t", "day", 1), ("t", "amount", 1)}
    # A clean file empties the rejects of the one before.
    (folder / "t.csv").write_text("\n".join(lines[:2]) + "\n", encoding="utf-8")
    [result] = ingest.ingest_all(spark, str(folder), {"t": SCHEMA}, raw, audited=True)
    assert sum(result.cells_lost.values()) == 0 and spark.table(f"{raw}.t__rejects").isEmpty()


def test_create_and_insert(spark):
    table = f"n_{uuid.uuid4().hex[:8]}.t"
    for _ in range(2):
        ingest.create_table(spark, table, "id BIGINT, name STRING")
    ingest.insert_rows(spark.range(2).selectExpr("concat('n', id) as name", "id"), table)
    ingest.insert_rows(spark.range(0).selectExpr("'x' as name", "id"), table)
    assert [tuple(r) for r in spark.table(table).orderBy("id").collect()] == [(0, "n0"), (1, "n1")]
    for bad in ("id", "id, 'x' as name, 1 as more"):
        with pytest.raises(ValueError, match="has the columns"):
            ingest.insert_rows(spark.range(1).selectExpr(*bad.split(", ")), table)


# ------------------------------------------------------------ isolation, guards


@pytest.mark.parametrize("bad", [{0}, {63}, {17}, {3, 40}, set(range(64)), set()])
def test_a_bad_table_costs_few_jobs(bad):
    calls, done = [], []

    def work(batch):
        calls.append(len(batch))
        if any(int(t) in bad for t in batch):
            raise OSError("torn")
        done.extend(batch)

    tables = [str(i) for i in range(64)]
    report = jobs.isolate_failures(work, tables)
    assert [r.table_name for r in report] == tables
    assert {int(r.table_name) for r in report if r.status == "FAILED"} == bad
    assert sorted(done, key=int) == [t for t in tables if int(t) not in bad]
    if len(bad) == 1:
        assert len(calls) - 1 <= 2 * 6
    assert jobs.isolate_failures(work, []) == []


def test_a_fault_that_passes_leaves_no_table_behind():
    """The first run fails for a reason of its own; every table is still worked on once."""
    calls, done = [], []

    def work(batch):
        calls.append(batch)
        if len(calls) == 1:
            raise OSError("lost executor")
        done.extend(batch)

    assert {r.status for r in jobs.isolate_failures(work, list("abcdefg"))} == {"LOADED"} and sorted(done) == list("abcdefg")


def test_appends_are_guarded(spark):
    store = store_of(spark)
    row = "select '{0}' table_id, 'n' namespace, '{1}' table_name, current_timestamp() created_at, current_timestamp() updated_at"
    store.append_new("tables_metadata", spark.sql(row.format("i", "x")))
    other = MetadataStore(spark.newSession(), store.namespace)
    both = row.format("i", "again") + " union all " + row.format("j", "y")
    other.append_new("tables_metadata", other.spark.sql(both))
    spark.catalog.refreshTable(f"{store.namespace}.tables_metadata")
    assert {(r.table_id, r.table_name) for r in store.read("tables_metadata").collect()} == {("i", "x"), ("j", "y")}
    with pytest.raises(Exception, match="would get a key twice"):
        store.append_new("tables_metadata", spark.sql(row.format("k", "z") + " union all " + row.format("k", "z")))
    assert store.read("tables_metadata").count() == 2


# ------------------------------------------------------------------- scan state


def test_state_equals_the_history_and_files_stay_few(spark):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    ingest.write_table(people(spark).withColumn("open", F.lit("?")), f"{raw}.people")
    jobs.catalogue_namespace(spark, store, raw)
    for _ in range(4):
        jobs.scan_namespace(spark, store, raw)
    state = store.read("pii_scan_state")
    full = merged_state(state.where("false"), store.read("pii_scan_record"), raw)
    assert sorted(map(str, state.select(*full.columns).collect())) == sorted(map(str, full.collect()))
    assert sorted(r.scans for r in state.collect()) == [1, 1, 1, 4, 4]
    before, rows = len(store.read("pii_scan_record").inputFiles()), store.read("pii_scan_record").count()
    store.compact_history(files=2)
    history = store.read("pii_scan_record")
    assert len(history.inputFiles()) <= 2 < before and history.count() == rows
    jobs.scan_namespace(spark, store, raw)
    assert store.read("pii_scan_record").count() == rows + 2
    store.rebuild_state(raw)
    assert sorted(r.scans for r in store.read("pii_scan_state").collect()) == [1, 1, 1, 5, 5]


# -------------------------------------------------------------- growing samples


def same(one, other):
    return sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def part(spark, low, high):
    return spark.range(low, high).selectExpr(
        "id", "concat('v', id % 30) as few", "cast(null as string) as none", "cast(id as double) / 7 as many",
        "if(id >= 4000, concat('late', id), null) as late")


def test_samples_grow_without_reading_old_files(spark):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    table, names = f"{raw}.t", ["id", "few", "none", "many", "late"]
    ingest.write_table(part(spark, 0, 3000), table)
    first = jobs.refresh_samples(spark, store, raw, {"t": names}, 20)
    assert same(first, profile.sample_tables({"t": spark.table(table)}, {"t": names}, 20))
    old = spark.table(table).inputFiles()
    part(spark, 3000, 6000).write.insertInto(table)
    expected = [tuple(r) for r in profile.sample_tables({"t": spark.table(table)}, {"t": names}, 20).collect()]
    for path in old:  # whoever opens an old file now fails
        with open(path.removeprefix("file://").removeprefix("file:"), "wb") as file:
            file.write(b"torn")
        side = os.path.join(os.path.dirname(path.removeprefix("file://")), f".{os.path.basename(path)}.crc")
        if os.path.exists(side):
            os.truncate(side, 0)
    grown = jobs.refresh_samples(spark, store, raw, {"t": ["id", "late", "many"]}, 20)
    assert sorted(map(tuple, grown.collect())) == sorted(r for r in expected if r[1] in ("id", "late", "many"))
    # The columns that weren't asked for were brought along.
    again = jobs.refresh_samples(spark, store, raw, {"t": names}, 20)
    assert sorted(map(tuple, again.collect())) == sorted(expected)
    fewer = jobs.refresh_samples(spark, store, raw, {"t": ["id"]}, 5)
    assert sorted(map(tuple, fewer.collect())) == sorted(r for r in expected if r[1] == "id" and r[2] <= 5)


def test_a_reload_or_a_larger_sample_reads_anew(spark):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    table = f"{raw}.t"
    ingest.write_table(part(spark, 0, 500), table)
    jobs.refresh_samples(spark, store, raw, {"t": ["id"]}, 10)
    ingest.write_table(part(spark, 9000, 9500), table)
    for k in (10, 40):
        found = jobs.refresh_samples(spark, store, raw, {"t": ["id", "few"]}, k)
        assert same(found, profile.sample_tables({"t": spark.table(table)}, {"t": ["id", "few"]}, k))
    jobs.catalogue_namespace(spark, store, raw)
    summary, report = jobs.scan_namespace(spark, store, raw, reuse_samples=True)
    assert {r.status for r in report} == {"LOADED"} and summary.first().columns_scanned == 5


def test_a_scan_after_cataloguing_reads_no_table_again(spark, monkeypatch):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    ingest.write_table(people(spark, 40), f"{raw}.people")
    jobs.catalogue_namespace(spark, store, raw, reuse_samples=True)

    def fail(*_):
        raise AssertionError("a table was read")

    monkeypatch.setattr(profile, "_candidates", fail)
    _, report = jobs.scan_namespace(spark, store, raw, reuse_samples=True)
    assert [r.status for r in report] == ["LOADED"]
    found = {r.column_name: r.pii_category for r in store.read("columns_metadata").collect()}
    assert found["email"] == "EMAIL" and found["national_id"] == "NATIONAL_ID"


def test_strict_cataloguing_raises_after_the_others_are_registered(spark):
    store, raw = store_of(spark), namespace_of(spark, "raw")
    ingest.write_table(people(spark), f"{raw}.people")
    spark.sql(f"CREATE TABLE {raw}.torn (id INT) USING parquet")
    with open(f"{versions.location(spark, f'{raw}.torn').removeprefix('file:')}/part-0.parquet", "wb") as file:
        file.write(b"torn")
    with pytest.raises(RuntimeError, match="torn"):
        jobs.catalogue_namespace(spark, store, raw, strict=True)
    assert [r.table_name for r in store.read("tables_metadata").collect()] == ["people"]


def test_intermediates_are_removed(spark):
    outer = workspace.stored(spark.range(3), "kept")
    target = workspace.new_folder(spark, "result")
    with workspace.intermediates(spark):
        inner = workspace.stored(spark.range(4), "inner")
        [file] = {f.rsplit("/", 1)[0] for f in inner.inputFiles()}
        result = workspace.stored_at(inner.where("id > 1"), target)
    assert outer.count() == 3 and result.count() == 2
    assert not os.path.exists(file.removeprefix("file://"))
    with pytest.raises(ValueError), workspace.intermediates(spark):
        path = workspace.new_folder(spark, "failed")
        spark.range(1).write.parquet(path)
        raise ValueError
    assert not os.path.exists(path)


def test_every_ward_has_one_chain(spark):
    rows = dimensions.ward_chain(spark).collect()
    assert sorted(r.ward_index for r in rows) == list(range(dimensions.WARD_COUNT))
    for r in rows:
        assert r.province_name == dimensions.PROVINCES[r.province_code]
        assert r.province_name.startswith(dimensions.UNIT_PREFIXES[r.province_unit] + " ")
        assert r.ward_name.startswith(dimensions.UNIT_PREFIXES[r.ward_unit] + " ")
    regions = {r.province_code: r.region for r in rows}
    assert regions["01"] == "Northern plain" and regions["22"] == "Northern uplands" and regions["56"] == "Central coast"
    assert regions["96"] == "Southern plain" and set(regions.values()) <= set(dimensions.REGIONS)
