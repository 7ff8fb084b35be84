"""CSV round trips, extract row counts, full refresh."""

import pytest
from pyspark.sql import functions as F

from shelflife.sources import files as A
from shelflife.sources.fixture import dirty_tables
from tests.conftest import rows

SMALL = {"unit": "year", "buckets": 2}     # few files for few rows


def test_csv_round_trip(spark, small):
    folder = A.scratch_path(spark, "test-csv")
    A.export_csv(small, folder, ["fact_goods_receipts", "fact_inventory_adjustments"])
    back = A.load_csv(spark, folder, ["fact_goods_receipts", "fact_inventory_adjustments"])
    for n in ("fact_goods_receipts", "fact_inventory_adjustments"):
        assert back[n].schema == small[n].schema
        assert back[n].exceptAll(small[n]).count() == 0 and small[n].exceptAll(back[n]).count() == 0


def test_file_row_counts_not_found(spark, small):
    folder = A.scratch_path(spark, "test-extract")
    A.export_csv(small, folder, ["dim_products", "fact_sales"])
    got = {r.file_name: (r.row_count, r.status) for r in A.file_row_counts(spark, folder).collect()}
    assert got["dim_products"] == (200, "OK")
    assert got["fact_sales"] == (6000, "OK")
    assert got["fact_stockout_events"] == (None, A.NOT_FOUND)
    assert got["TOTAL ROWS"] == (6200, "OK")


@pytest.fixture(scope="module")
def store(spark, small):
    root = A.scratch_path(spark, "test-store")
    A.full_refresh(spark, small, root, **SMALL)
    return root


def spoiled(t, defect):
    s, p = t["fact_sales"], t["dim_products"]
    first = s.agg(F.min("sale_id")).first()[0]
    bad = F.col("sale_id") == first
    if defect == "null":
        return t.replace(dim_products=p.withColumn("status", F.when(
            F.col("product_id") != "P000001", F.col("status"))))
    if defect == "null key":
        return t.replace(fact_sales=s.withColumn("warehouse_id", F.when(~bad, F.col("warehouse_id"))))
    if defect == "wide":
        return t.replace(dim_products=p.withColumn("status", F.repeat("status", 100)))
    if defect == "duplicate":
        return t.replace(fact_sales=s.unionByName(s.where(bad)))
    return t.replace(fact_sales=s.withColumn("product_id", F.when(bad, "nowhere").otherwise(F.col("product_id"))))


@pytest.mark.parametrize("defect,said", [
    ("null", "null dim_products status"), ("null key", "null fact_sales warehouse_id"),
    ("wide", "domain dim_products status"), ("duplicate", "duplicate key fact_sales sale_id"),
    ("orphan", "orphan fact_sales product_id")])
def test_full_refresh_rejects(spark, small, store, defect, said):
    before = A.load_current(spark, store)["fact_sales"].inputFiles()
    with pytest.raises(A.RefreshFailed) as e:
        A.full_refresh(spark, spoiled(small, defect), store, **SMALL)
    assert any(said in p for p in e.value.problems)
    # the failed load did not move the pointer
    assert A.load_current(spark, store)["fact_sales"].inputFiles() == before


def test_refresh_names_every_broken_constraint(spark, small, store):
    found = A.violations(dirty_tables(small)).collect()
    with pytest.raises(A.RefreshFailed) as e:
        A.full_refresh(spark, dirty_tables(small), store, **SMALL)
    assert len(e.value.problems) == len(found) > 3


def test_refresh_keeps_the_latest_versions(spark, small):
    root = A.scratch_path(spark, "test-keep")
    for _ in range(3):
        published = A.full_refresh(spark, small, root, validate=False, keep=2, **SMALL)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = [x.getPath().getName() for x in fs.listStatus(path) if x.getPath().getName().startswith("v-")]
    assert len(kept) == 2 and published["fact_sales"].count() == 6000


def test_no_shared_folder_on_a_cluster_is_an_error(monkeypatch, spark):
    from types import SimpleNamespace

    from shelflife.session import checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077",
                              getConf=lambda: SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=context))


def test_table_preview_order(small):
    from shelflife.operators.staging import sales_enriched
    ids = [r[0] for r in A.table_preview(sales_enriched(small), ["sale_id"], 10).select("sale_id").collect()]
    assert ids == sorted(ids) and len(ids) == 10
    assert ids[0] == small["fact_sales"].agg(F.min("sale_id")).first()[0]


def test_schema_columns(spark, small):
    got = dict(rows(A.schema_columns(small, spark)))
    assert got["fact_goods_receipts"] == 11 and got["dim_supplier_products"] == 3


def _sales_lines():
    return [",".join(x) for x in [
        ("S1", "2024-01-01", "W1", "P1", "3", "1.50", "0.00", "0"),
        ("S2", "2024-13-01", "W1", "P1", "3", "1.50", "0.00", "0"),
        ("S3", "2024-01-02", "W1", "P1", "x", "1.50", "0.00", "0"),
        ("S4", "2024-01-02", "W1", "P1", "3"),
        ("S5", "2024-01-02", '"W,1"', "P1", "3", "1.50", "0.00", "1"),
        ("S6", "2024-01-02", '"W,1"', "P1", "3", "1.50", "0.00", "1", "more"),
        ("S7", "", "W1", "P1", "", "1.50", "0.00", "0")]]


def test_tolerant_load_sets_malformed_rows_apart(spark):
    folder = A.scratch_path(spark, "test-rejects")
    head = ",".join(A.SCHEMAS["fact_sales"].names)
    spark.createDataFrame([("\n".join([head, *_sales_lines()]),)], "line string").coalesce(1).write.text(f"{folder}/in")
    good, bad = A.load_tolerant(spark, f"{folder}/in", "fact_sales", f"{folder}/staged")
    assert good.schema == A.SCHEMAS["fact_sales"]
    assert {r.sale_id: (r.warehouse_id, r.quantity_sold) for r in good.collect()} == {
        "S1": ("W1", 3), "S5": ("W,1", 3), "S7": ("W1", None)}
    got = {r.row_text.split(",")[0]: r.reason for r in bad.collect()}
    assert got == {"S2": "sale_date is not date", "S3": "quantity_sold is not int", "S4": "5 fields of 8",
                   "S6": "9 fields of 8"}
    assert {r.row_text for r in bad.collect()} <= set(_sales_lines())
    assert all("/in/" in r.file and r.table_name == "fact_sales" for r in bad.collect())
    # counts add up whatever columns are asked for
    assert good.select("sale_id").count() + bad.count() == good.select("quantity_sold").count() + 4 == 7


def test_too_many_rejects_are_an_error(spark):
    folder = A.scratch_path(spark, "test-many")
    spark.createDataFrame([(x,) for x in _sales_lines()], "line string").write.text(f"{folder}/in")
    A.load_tolerant(spark, f"{folder}/in", "fact_sales", f"{folder}/staged", header=False, max_rejects=4)
    with pytest.raises(A.RefreshFailed, match="4 rows of fact_sales"):
        A.load_tolerant(spark, f"{folder}/in", "fact_sales", f"{folder}/staged", header=False, max_rejects=3)


def test_file_checks_send_lines_without_digests(spark):
    import hashlib

    from shelflife.plans.registry import _file_checks
    rows = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), ("c", "x|y")], "k string, v string")
    got = _file_checks(rows, "t")
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "md5" in text and "md5" not in text.split("Exchange hashpartitioning")[-1]
    digest = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:12], 16)
    want = 2 * digest("a|1") + digest("b|") + digest("c|x|y")
    assert [tuple(r) for r in got.collect()] == [("t", 4, 3, want)]
    assert [tuple(r) for r in _file_checks(rows.where("false"), "t").collect()] == [("t", 0, 0, None)]


def test_file_checks_compare_lines_that_share_a_mark(spark, monkeypatch):
    """Marks that several lines share decide nothing: here all lines of a length share one."""
    from shelflife.plans import registry
    rows = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), ("c", None), ("c", "xy"), ("c", "xy"), ("d", "xyz")],
                                 "k string, v string")
    want = [tuple(r) for r in registry._file_checks(rows, "t").collect()]
    assert want[0][:3] == ("t", 7, 5)
    monkeypatch.setattr(registry.F, "xxhash64", lambda c: F.length(c).cast("long"))
    assert [tuple(r) for r in registry._file_checks(rows, "t").collect()] == want


def test_file_checks_do_not_move_lines_of_their_own_mark(spark):
    from shelflife.plans.registry import _file_checks
    got = _file_checks(spark.range(1000).select(F.sha2(F.col("id").cast("string"), 512).alias("k")), "t")
    assert [tuple(r)[1:3] for r in got.collect()] == [(1000, 1000)]
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and "hashpartitioning" not in final
