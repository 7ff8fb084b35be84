"""The derived model tables: counts of FIXTURES.md §3 and the planted defects."""

import datetime as dt

from shelflife.sources.fixture import dirty_tables

EXPECTED_SF001 = {
    "dim_products": 200, "dim_warehouses": 5, "dim_suppliers": 10,
    "dim_supplier_products": 1905, "fact_sales": 6000, "fact_goods_receipts": 1992,
    "fact_sale_batch_map": 7192, "fact_inventory_adjustments": 1326, "fact_stockout_events": 2431,
}


def test_row_counts_sf001(small):
    assert {n: small[n].count() for n in small} == EXPECTED_SF001


def test_schemas_match_declared(small):
    from shelflife.schemas import SCHEMAS
    for n, schema in SCHEMAS.items():
        got = [(f.name, f.dataType) for f in small[n].schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], n


def test_bridge_sums_to_sale_quantity(small):
    from pyspark.sql import functions as F
    b = small["fact_sale_batch_map"].groupBy("sale_id").agg(F.sum("quantity_from_batch").alias("b"))
    s = small["fact_sales"].select("sale_id", "quantity_sold")
    assert s.join(b, "sale_id").where(F.col("b") != F.col("quantity_sold")).count() == 0


def test_dirty_fixture_plants_known_defects(small):
    from pyspark.sql import functions as F
    d = dirty_tables(small)
    assert d["fact_sales"].where(F.col("quantity_sold") <= 0).count() == 7
    r = d["fact_goods_receipts"]
    assert r.where(F.col("expiry_date") <= F.col("receipt_date")).count() == 30
    assert d["fact_sale_batch_map"].where(F.col("quantity_from_batch") <= 0).count() == 12


def test_staged_tables_concurrent_first_use(spark):
    """Several threads touching a fresh staged mapping build each table once."""
    import threading

    from shelflife.sources import fixture as fx
    t = fx._staging(spark, "/root/testdata/sf0.001", None)
    out, errors = [], []

    def work():
        try:
            out.append(t["fact_stockout_events"].count())
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work) for _ in range(4)]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    assert not errors and out == [2431] * 4


def test_replace_delegates_to_original(spark):
    calls = []

    def builder(name):
        def build():
            calls.append(name)
            return spark.range(1)
        return build

    from shelflife.tables import Tables
    t = Tables({"a": builder("a"), "b": builder("b")})
    v = t.replace(b=spark.range(2))
    v["a"], t["a"], v["a"]
    assert calls == ["a"] and v["b"].count() == 2


def test_ids_are_written_as_format_string_writes_them(spark):
    from pyspark.sql import functions as F

    from shelflife.sources.fixture import _digits
    edge = [(x,) for x in (None, 0, 7, 10, -1, -7, 99999, 100000, 999999, 1000000, -12345678, 99999999, 100000000, 2147483647)]
    for kind in ("int", "bigint"):
        df = spark.createDataFrame(edge, f"a {kind}")
        for width in (1, 3, 5, 6, 8):
            got = df.select(_digits(F.col("a"), width).alias("x"), F.format_string(f"%0{width}d", "a").alias("y")).collect()
            assert [r.x for r in got] == [r.y for r in got]


def test_lots_add_up_a_line_without_multiplying_it(spark):
    from shelflife.sources.fixture import Fixture
    schema = ("l_orderkey int, l_linenumber int, rn int, l_partkey int, l_suppkey int, sd date, rk int, lot int, q int,"
              " unmet int, l_discount double")
    day = dt.date(1995, 1, 1)
    lines = [(1, 1, 1, 5, 9, day, 2, 1, 50, 0, 0.0), (1, 2, 1, 5, 8, day, 2, 0, 40, 0, 0.0), (2, 3, 1, 5, 7, day, 2, 1, 41, 0, 0.0),
             (3, 2, 1, 6, 7, day, 0, 0, None, 0, 0.0), (4, None, 1, 7, 7, day, 0, None, 60, 0, 0.0), (5, -1, 1, 8, 7, day, 0, -1, 60, 0, 0.0)]
    lots = Fixture(spark, "", line=spark.createDataFrame(lines, schema)).lots()
    # every line stays one row up to the sums; only the two lots of a (part, region) are laid out
    assert "explode" not in lots._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.l_partkey, r.rk, r.lot): (r.sold, r.sk) for r in lots.collect()}
    assert got == {(5, 2, 0): (60, 7), (5, 2, 1): (71, 7), (6, 0, 0): (None, 7), (6, 0, 1): (0, 7),
                   (7, 0, 0): (0, 7), (7, 0, 1): (0, 7), (8, 0, 0): (0, 7), (8, 0, 1): (0, 7)}


def test_a_line_meets_its_price_and_cost_once(spark):
    """Sales keep lines without a region, the bridge does not; a part with two products gives two of each."""
    from decimal import Decimal

    from shelflife.sources.fixture import Fixture
    lines = spark.createDataFrame(
        [(1, 1, 1, 5, dt.date(1995, 1, 1), 2, 50, 0.06), (2, 2, 1, 5, dt.date(1995, 1, 2), None, 7, 0.05),
         (3, -1, 1, 6, dt.date(1995, 1, 3), 0, 60, 0.0), (4, 1, 1, 7, dt.date(1995, 1, 4), 0, 9, None), (5, 4, 2, 6, None, 0, None, 0.0)],
        "l_orderkey int, l_linenumber int, rn int, l_partkey int, sd date, rk int, q int, l_discount double")
    receipts = spark.createDataFrame(
        [(5, 2, lot, Decimal(10), Decimal(7)) for lot in (0, 1)] + [(5, None, lot, Decimal(10), Decimal(8)) for lot in (0, 1)]
        + [(6, 0, lot, Decimal(price), Decimal(price)) for lot in (0, 1) for price in (20, 30)],
        "l_partkey int, rk int, lot int, base_price decimal(10,2), purchase_price_per_unit decimal(10,4)")
    sold = Fixture(spark, "", line=lines, receipts=receipts).sold_in_buckets(3)
    fx = Fixture(spark, "", sold=sold)
    sales = sorted((r.sale_id, r.warehouse_id, r.quantity_sold, float(r.selling_price_per_unit), r.promotion_flag)
                   for r in fx.fact_sales().collect() if r.quantity_sold is not None)
    assert sales == [("S00000001-1-1", "W003", 50, 9.7, 1), ("S00000002-2-1", "Wnull", 7, 9.8, 0),
                     ("S00000003--1-1", "W001", 60, 19.0, 0), ("S00000003--1-1", "W001", 60, 28.5, 0)]
    assert fx.fact_sales().where("quantity_sold is null").count() == 2
    draws = sorted(((r.sale_id, r.batch_id, r.quantity_from_batch, float(r.unit_cost_at_sale)) for r in
                    fx.fact_sale_batch_map().collect()), key=str)
    assert draws == [("S00000001-1-1", "B000005-2-0", 10, 7.0), ("S00000001-1-1", "B000005-2-1", 40, 7.0),
                     ("S00000005-4-2", "B000006-0-0", None, 20.0), ("S00000005-4-2", "B000006-0-0", None, 30.0)]


def test_sales_and_bridge_are_stored_once(spark):
    """One table holds both, bucketed: lines cross to their receipt and to their bucket, and then no more."""
    import os

    from shelflife.sources import fixture as fx
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    t = fx._staging(spark, "/root/testdata/sf0.001", 3)
    fx.stage_all(t)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    folder = os.path.dirname(t["fact_sales"].inputFiles()[0].removeprefix("file://"))
    assert {os.path.dirname(f.removeprefix("file://")) for f in t["fact_sale_batch_map"].inputFiles()} == {folder}
    assert not {"fact_sales", "fact_sale_batch_map", "fact_goods_receipts"} & set(os.listdir(os.path.dirname(folder)))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = t["fact_sales"].join(t["fact_sale_batch_map"], "sale_id")
        assert "Exchange" not in plan(joined) and plan(joined).count("Bucketed: true") == 2
        assert joined.count() == 7192
        stored = {n: spark.read.parquet(f"{os.path.dirname(folder)}/_{n}") for n in ("line", "receipts")}
        assert plan(fx.Fixture(spark, "", **stored).sold_in_buckets(3)).count("Exchange") == 3
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_shuffle_files_go_with_their_query(spark):
    """A session built elsewhere gets the setting at the load step, unless it has its own."""
    import time

    from shelflife.session import TIDY, tidy
    from shelflife.sources import fixture as fx
    fx.staged_tables(spark, "/root/testdata/sf0.001")
    assert spark.conf.get(TIDY) == "true"
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in f}
    before = files()
    t = fx._staging(spark, "/root/testdata/sf0.001", 3)
    assert t["fact_sales"].count() == 6000
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    spark.conf.set(TIDY, "false")
    tidy(spark)
    assert spark.conf.get(TIDY) == "false"
    spark.conf.set(TIDY, "true")


def test_pairs_of_suppliers_are_moved_once(spark, tmp_path):
    """Nulls are parts and suppliers of their own, repeats fold, and only the first suppliers are moved again."""
    from shelflife.sources.fixture import Fixture
    lines = [(1, 9), (1, 7), (1, 7), (2, None), (2, 3), (3, None), (None, 5), (None, 4), (None, None), (0, 6), (0, 6), (-1, 2)]
    spark.createDataFrame(lines, "l_partkey bigint, l_suppkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = Fixture(spark, str(tmp_path)).dim_supplier_products()
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text and text.count("Exchange hashpartitioning") == 3
        assert sorted(map(tuple, got.collect())) == sorted([
            ("P000001", "SUP00009", 0), ("P000001", "SUP00007", 1), ("P000002", "SUP null", 0), ("P000002", "SUP00003", 1),
            ("P000003", "SUP null", 0), ("P  null", "SUP00005", 0), ("P  null", "SUP00004", 1), ("P  null", "SUP null", 0),
            ("P000000", "SUP00006", 1), ("P-00001", "SUP00002", 1)])
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_write_offs_and_stockouts_are_not_stored_twice(spark):
    import os

    from shelflife.sources import fixture as fx
    t = fx._staging(spark, "/root/testdata/sf0.001", 3)
    fx.stage_all(t)
    for name, base in (("fact_inventory_adjustments", "_receipts"), ("fact_stockout_events", "_line")):
        folder = os.path.dirname(t[name].inputFiles()[0].removeprefix("file://"))
        assert os.path.basename(folder) == base and name not in os.listdir(os.path.dirname(folder))
        assert t[name].count() == EXPECTED_SF001[name]
        assert all(f.nullable for f in t[name].schema.fields)
