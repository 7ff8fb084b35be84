"""SQL over the registered tables and views gives the operators' results."""

from shelflife.operators import analytics as K
from shelflife.sources.catalog import ensure_database, register_all
from shelflife.sources.fixture import FIXTURE_AS_OF


def test_sql_surface_matches_operator(spark, small):
    register_all(spark, small, FIXTURE_AS_OF)
    by_sql = spark.sql("""
        SELECT category, COUNT(*) AS total_expiry_events,
               SUM(quantity_adjusted) AS total_unit_lost_to_expiry,
               CAST(SUM(quantity_adjusted * base_cost) AS DECIMAL(18,2)) AS total_cost_lost_to_expiry
        FROM vw_inventory_adjustments_enriched WHERE adjustment_type = 'Expiry'
        GROUP BY category""")
    op = K.expiry_loss_by_category(small)
    assert sorted(map(tuple, by_sql.collect())) == sorted(map(tuple, op.collect()))
    n = spark.sql("SELECT COUNT(*) FROM vw_inventory_aging").first()[0]
    assert n == spark.sql("SELECT COUNT(*) FROM vw_inventory_aging WHERE current_stock > 0").first()[0] > 0


def test_ensure_database(spark):
    ensure_database(spark, "shelflife_test_db")
    ensure_database(spark, "shelflife_test_db")
    assert spark.catalog.databaseExists("shelflife_test_db")


def test_catalog_tables_over_a_store(spark, small):
    from shelflife.sources import files as A
    from shelflife.sources.catalog import COMMENTS, create_tables, table_exists
    store = A.full_refresh(spark, small, A.scratch_path(spark, "test-catalog"), validate=False, unit="year", buckets=2)
    db = "shelflife_test_tables"
    assert not table_exists(spark, db, "fact_sales")
    assert sorted(create_tables(spark, db, store)) == sorted(small)
    assert create_tables(spark, db, store) == []        # each only if it does not exist
    for n in small:
        t = spark.table(f"{db}.{n}")
        assert t.count() == small[n].count() and t.columns[:len(small[n].columns)] == small[n].columns
        detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {db}.{n}").collect()}
        assert detail["Comment"] == COMMENTS[n]
    notes = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {db}.fact_sales").collect()}
    assert notes["sale_id"] == "primary key" and notes["product_id"] == "references dim_products.product_id"
    # the layout holds through the catalog too
    joined = spark.sql(f"""SELECT /*+ MERGE(b) */ sum(b.quantity_from_batch) FROM {db}.fact_sales s
                           JOIN {db}.fact_sale_batch_map b ON s.sale_id = b.sale_id WHERE s.period = DATE '1995-01-01'""")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(sale_id" not in plan and "PartitionFilters: [isnotnull(period" in plan
    spark.sql(f"DROP DATABASE {db} CASCADE")
    assert store["fact_sales"].count() == small["fact_sales"].count()   # the files stay
