"""Versions of stored tables, and refreshes that rewrite what changed."""

import pytest
from pyspark.sql import functions as F

from lagscope.plans import incremental, models
from lagscope.registry import roles
from lagscope.session import scratch_dir
from lagscope.sources import land_observed, materialize_observed
from lagscope.sources.versions import Conflict, Version, Versions, written

SF_DIR = "/root/testdata/sf0.001"


def numbers(spark, n):
    return spark.range(n).withColumnRenamed("id", "x")


def put(versions, base, n):
    folder = versions.new_folder()
    tables = {name: written(numbers(versions.spark, n), f"{folder}/{name}", versions) for name in ("a", "b")}
    return versions.commit(base, tables)


def test_readers_keep_the_version_they_took(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.latest() == Version()
    one = put(versions, versions.latest(), 1)
    seen = versions.latest()
    two = put(versions, one, 2)
    assert [v.number for v in (one, seen, two, versions.latest())] == [1, 1, 2, 2]
    for version, n in ((seen, 1), (versions.latest(), 2)):
        assert {version.read(spark, name).count() for name in ("a", "b")} == {n}


def test_one_of_two_writers_wins(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    base = put(versions, versions.latest(), 1)
    put(versions, base, 2)
    with pytest.raises(Conflict):
        put(versions, base, 3)
    assert versions.latest().read(spark, "a").count() == 2
    assert all(name.endswith(".json") or name.endswith(".crc") for name in versions.names(f"{tmp_path}/_versions"))


def test_half_a_manifest_is_no_version(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    put(versions, versions.latest(), 1)
    (tmp_path / "_versions" / "abc.part").write_text("{")
    assert versions.latest().number == 1


def test_old_versions_go_and_what_later_ones_name_stays(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    first = put(versions, versions.latest(), 1)
    second = put(versions, first, 2)
    third = versions.commit(second, {"a": first.tables["a"], "b": second.tables["b"]})
    versions.prune(1)
    assert versions.numbers() == [3]
    assert third.read(spark, "a").count() == 1 and third.read(spark, "b").count() == 2
    with pytest.raises(Exception):
        second.read(spark, "a").count()


def test_tables_by_part_and_without_rows(spark, tmp_path, rows):
    versions = Versions(spark, str(tmp_path))
    df = numbers(spark, 10).withColumn("part", (F.col("x") % 3).cast("string"))
    table = written(df, f"{tmp_path}/t", versions, "part")
    assert set(table["folders"]) == {"0", "1", "2"}
    version = versions.commit(Version(), {"t": table, "none": written(df.limit(0), f"{tmp_path}/n", versions, "part")})
    assert rows(version.read(spark, "t")) == [(i,) for i in range(10)]
    assert version.read(spark, "none").count() == 0 and version.read(spark, "none").columns == ["x"]


@pytest.fixture(scope="module")
def raw(spark):
    path = scratch_dir(spark, "raw")
    for name, make in roles.RAW_TABLES.items():
        make(spark, SF_DIR).write.parquet(f"{path}/{name}")
    return {name: spark.read.parquet(f"{path}/{name}") for name in roles.RAW_TABLES}


def with_fault(raw, month):
    wrong = F.when(F.col("date").like(f"{month}%"), F.lit("7")).otherwise(F.col("value"))
    return {n: df.withColumn("value", wrong) if n in models.RAW_OBSERVATION_TABLES else df for n, df in raw.items()}


def test_a_revision_equals_a_full_refresh_and_rewrites_its_month(spark, raw, tmp_path, rows):
    month, partly, whole = "1997-05", str(tmp_path / "partly"), str(tmp_path / "whole")
    before = incremental.refresh(spark, with_fault(raw, month), partly)
    after = incremental.refresh(spark, raw, partly, months=[month])
    full = incremental.refresh(spark, raw, whole)
    old, new = before.folders("period_states"), after.folders("period_states")
    assert set(old) == set(new) and {m for m in old if old[m] != new[m]} == {month}
    for name in ("period_states", *models.MODEL_LAYERS["mart"]):
        assert rows(after.read(spark, name)) == rows(full.read(spark, name)), name
    assert rows(before.read(spark, "fct_smh_q")) != rows(after.read(spark, "fct_smh_q"))
    expected = {n: rows(df) for n, df in models.build_models(raw).items() if not n.startswith("stg_")}
    assert {n: rows(df) for n, df in incremental.snapshot(spark, partly, raw).items()} == expected


def test_months_come_and_go(spark, raw, tmp_path):
    def without(month):
        out = {}
        for name, df in raw.items():
            inside = incremental.rows_of_months(name, df, [month])
            out[name] = df.exceptAll(inside)
        return out

    month, root = "1998-02", str(tmp_path)
    held = incremental.refresh(spark, raw, root).folders("period_states")
    gone = incremental.refresh(spark, without(month), root, months=[month]).folders("period_states")
    back = incremental.refresh(spark, raw, root, months=[month]).folders("period_states")
    assert month in held and month not in gone and month in back
    assert {m: p for m, p in back.items() if m != month} == gone == {m: p for m, p in held.items() if m != month}


def test_only_the_rows_of_the_months_are_read(spark, raw):
    text = incremental.rows_of_months("smh_prices", raw["smh_prices"], ["1997-05"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date" in text and "LessThan(date" in text
    days = incremental.rows_of_months("smh_prices", raw["smh_prices"], ["1996-12"])
    staged = models.stage("smh_prices", days)
    assert {str(r["m"]) for r in staged.select(F.trunc("date", "MM").alias("m")).distinct().collect()} == {"1996-12-01"}


def test_rows_are_observed_as_they_are_written(spark, tmp_path):
    df = spark.range(0, 100, 1, 4)
    found = land_observed(df, str(tmp_path / "t"), rows=F.count(F.lit(1)), most=F.max("id"))
    assert found == {"rows": 100, "most": 99}
    landed, found = materialize_observed(df.filter("id < 0"), "none", rows=F.count(F.lit(1)))
    assert landed.count() == 0 and found.get("rows", 0) == 0


def test_the_load_report_adds_no_job(spark, tmp_path):
    """The report of observed rows is made of literals: it reads no file."""
    from lagscope.operators import load_report

    landed, found = materialize_observed(spark.range(7), "seven", rows=F.count(F.lit(1)))
    report = load_report(landed, "seven", found["rows"])
    assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in report.collect()] == [("seven", "id", "bigint", 7)]
