"""Result tables: typed, replaced as a whole, fresh or stale by their inputs; the report scans sales once."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidewater.operators import retail
from tidewater.sources.fixtures import Fixtures
from tidewater.sources.results import ResultStore, fingerprint, shared_folder


@pytest.fixture
def store(spark, tmp_path):
    return ResultStore(spark, str(tmp_path / "results"))


def test_types_survive_and_replacement_is_whole(spark, store):
    first = spark.createDataFrame([(1, None), (2, "b")], "i int, s string").withColumn("d", F.lit(1.5).cast("decimal(7,2)")).withColumn("t", F.lit("2024-01-01").cast("date"))
    got = store.replace("typed", first)
    assert got.schema == first.schema and sorted(got.collect()) == sorted(first.collect())
    old = store.read("typed")
    store.replace("typed", first.filter("i = 2").select("s", "i"))
    assert store.read("typed").columns == ["s", "i"] and store.read("typed").count() == 1
    assert old.count() == 2  # a reader of the replaced version still ends
    for n in range(4):
        store.replace("typed", spark.range(n))
    assert store.read("typed").count() == 3
    assert len([d for d in os.listdir(f"{store.folder}/typed") if d.startswith("v0")]) == 2
    assert store.names() == ["typed"]


def test_a_write_that_fails_in_the_middle_changes_nothing(spark, store):
    store.replace("kept", spark.range(5))
    broken = spark.range(0, 100, 1, 8).select(F.when(F.col("id") < 80, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception, match="stop"):
        store.replace("kept", broken)
    assert store.read("kept").count() == 5
    with pytest.raises(Exception, match="stop"):
        store.replace("never", broken)
    assert not store.exists("never") and store.names() == ["kept"]
    with pytest.raises(KeyError):
        store.read("never")
    assert store.replace("kept", spark.range(7)).count() == 7


def test_computed_again_only_when_an_input_changed(spark, store, tmp_path):
    path, calls = str(tmp_path / "input.parquet"), []
    spark.range(3).write.parquet(path)

    def make():
        calls.append(1)
        return spark.read.parquet(path).agg(F.count("*").alias("n"))

    assert not store.is_fresh("count", [path])
    for _ in range(3):
        assert store.materialise("count", make, [path]).first().n == 3
    assert len(calls) == 1 and store.is_fresh("count", [path])
    spark.range(2).write.mode("append").parquet(path)
    assert not store.is_fresh("count", [path])
    assert store.materialise("count", make, [path]).first().n == 5 and len(calls) == 2
    store.materialise("count", make, [path], variant="other")
    assert len(calls) == 3
    with pytest.raises(FileNotFoundError):
        fingerprint(spark, [str(tmp_path / "nowhere")])


def test_drop(spark, store):
    store.drop("gone")
    with pytest.raises(KeyError):
        store.drop("gone", if_exists=False)
    store.replace("gone", spark.range(1))
    store.drop("gone")
    assert not store.exists("gone") and store.names() == []
    with pytest.raises(ValueError):
        store.replace("../up", spark.range(1))


def _scans(df):
    return sum(f"{SMALL}/{t}.parquet" in line for line in df._jdf.queryExecution().executedPlan().toString().splitlines()
               for t in ("lineitem", "orders") if "FileScan" in line)


def test_the_monthly_report_scans_the_sales_once(spark, store):
    fx = Fixtures(spark, SMALL)
    make = retail.basket_lines(retail.sales_of_month(fx.retail_sales, "1998-01"))
    lines = store.replace("month", make)
    report = retail.monthly_report(lines, fx.product_details)
    assert len(report) == 18 and sum(map(_scans, report.values())) == 0 < _scans(make) <= 2
    direct = retail.monthly_report(retail.sales_of_month(fx.retail_sales, "1998-01"), fx.product_details)
    for name in report:
        assert sorted(map(str, report[name].collect())) == sorted(map(str, direct[name].collect())), name


def test_without_a_shared_folder_each_query_computes(spark, monkeypatch):
    import tidewater.sources.fixtures as fixtures
    monkeypatch.setattr(fixtures, "has_shared_folder", lambda s: False)
    df = spark.range(3)
    assert Fixtures(spark, SMALL).shared_result("unused", lambda: df, "orders") is df


def test_shared_results_are_written_once_for_each_plan(spark, store, monkeypatch):
    import tidewater.sources.fixtures as fixtures
    monkeypatch.setattr(fixtures, "has_shared_folder", lambda s: True)
    monkeypatch.setattr(fixtures, "ResultStore", lambda s: store)
    written, replace = [], store.replace
    monkeypatch.setattr(store, "replace", lambda *a: written.append(a[0]) or replace(*a))

    def totals(least):
        fx = Fixtures(spark, SMALL)
        return fx.shared_result("shared", lambda: fx.store_orders.filter(F.col("total_amount") > least).agg(F.count("*").alias("n")), "orders").first().n

    assert totals(1000) == totals(1000) and len(written) == 1
    assert totals(200_000) < totals(1000) and len(written) == 3  # another plan, then the first again


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())
