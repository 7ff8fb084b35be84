"""The fixture derivation as plain SQL (DuckDB dialect), for the oracle.

Written independently of :mod:`shelflife.sources.fixture`; both follow the
rule in FIXTURES.md §2.  ``FIXTURE_CTES`` is a list of ``name AS (...)``
clauses that every oracle query puts in front of its own CTEs, so the oracle
reads the same driver tables the Spark side reads.
"""

from __future__ import annotations

D01 = "CAST(0.01 AS DECIMAL(3,2))"

FIXTURE_CTES = [
    f"""dim_products AS (
  SELECT printf('P%06d', p_partkey) AS product_id,
         p_name AS product_name, p_type AS category, p_brand AS unit_size,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.70 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS base_cost,
         CAST(p_retailprice AS DECIMAL(10,2)) AS base_price,
         CAST(CASE split_part(p_type, ' ', 1)
                WHEN 'ECONOMY' THEN 5 WHEN 'SMALL' THEN 6 WHEN 'MEDIUM' THEN 7
                WHEN 'LARGE' THEN 9 WHEN 'PROMO' THEN 10 ELSE 8 END AS INTEGER) AS shelf_life_days,
         CAST(DATE '1994-01-01' + CAST(p_partkey % 700 AS INTEGER) AS DATE) AS launch_date,
         CASE WHEN p_partkey % 12 = 0 THEN 'Inactive' ELSE 'Active' END AS status,
         p_partkey
  FROM part)""",
    """dim_warehouses AS (
  SELECT printf('W%03d', r_regionkey + 1) AS warehouse_id,
         r_name || ' HUB' AS warehouse_name, r_name AS city, r_name AS region,
         CAST(6000 + 1000 * r_regionkey AS INTEGER) AS storage_capacity_units,
         CAST(CASE WHEN r_regionkey = 2 THEN 0 ELSE 1 END AS INTEGER) AS cold_storage_flag
  FROM region)""",
    f"""dim_suppliers AS (
  SELECT printf('SUP%05d', s_suppkey) AS supplier_id, s_name AS supplier_name,
         n_name AS supplier_city,
         CAST(1 + s_suppkey % 3 AS INTEGER) AS average_lead_time_days,
         CAST((92 + s_suppkey % 8) * {D01} AS DECIMAL(5,2)) AS reliability_score,
         CAST(DATE '1990-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS DATE) AS contract_start_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
    """dim_supplier_products AS (
  SELECT printf('P%06d', l_partkey) AS product_id, printf('SUP%05d', l_suppkey) AS supplier_id,
         CAST(CASE WHEN l_suppkey = min(l_suppkey) OVER (PARTITION BY l_partkey) THEN 1 ELSE 0 END AS INTEGER) AS is_primary
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))""",
    """line AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_discount,
         CAST(o.o_orderdate AS DATE) AS sd, n.n_regionkey AS rk,
         CAST(l.l_quantity AS INTEGER) AS q, l.l_linenumber % 2 AS lot,
         CAST(floor(CAST(l.l_quantity AS INTEGER) * CAST(l.l_tax AS DECIMAL(5,2))) AS INTEGER) AS unmet,
         row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber
                            ORDER BY l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
                                     l.l_discount, l.l_tax, l.l_shipdate, l.l_returnflag, l.l_linestatus) AS rn
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    """alloc AS (
  SELECT l_orderkey, l_linenumber, rn, l_partkey, rk, lot,
         CASE WHEN q > 40 THEN q - 10 ELSE q END AS qty
  FROM line
  UNION ALL
  SELECT l_orderkey, l_linenumber, rn, l_partkey, rk, 1 - lot AS lot, 10 AS qty
  FROM line WHERE q > 40)""",
    """lots AS (
  SELECT k.l_partkey, k.rk, v.lot, k.d0, k.sk,
         COALESCE(a.sold, 0) AS sold,
         1 + (k.l_partkey * 7 + k.rk * 3 + v.lot) % 20 AS surplus,
         (k.l_partkey + k.rk + v.lot) % 3 AS fate
  FROM (SELECT l_partkey, rk, min(sd) AS d0, min(l_suppkey) AS sk FROM line GROUP BY l_partkey, rk) k
  CROSS JOIN (VALUES (0), (1)) v(lot)
  LEFT JOIN (SELECT l_partkey, rk, lot, sum(qty) AS sold FROM alloc GROUP BY l_partkey, rk, lot) a
    ON a.l_partkey = k.l_partkey AND a.rk = k.rk AND a.lot = v.lot)""",
    """fact_sales AS (
  SELECT printf('S%08d-%d-%d', l.l_orderkey, l.l_linenumber, l.rn) AS sale_id,
         l.sd AS sale_date, printf('W%03d', l.rk + 1) AS warehouse_id,
         printf('P%06d', l.l_partkey) AS product_id, l.q AS quantity_sold,
         CAST(p.base_price * ((96 + l.l_linenumber) * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(10,2)) AS selling_price_per_unit,
         CAST(l.l_discount AS DECIMAL(5,2)) AS discount_percent,
         CAST(CASE WHEN l.l_discount > 0.055 THEN 1 ELSE 0 END AS INTEGER) AS promotion_flag
  FROM line l JOIN dim_products p ON l.l_partkey = p.p_partkey)""",
    """receipts_keyed AS (
  SELECT x.*, CAST(x.receipt_date - 1 AS DATE) AS manufacture_date,
         CAST(x.receipt_date + x.shelf_life_days AS DATE) AS expiry_date,
         CAST(x.quantity_received * x.purchase_price_per_unit AS DECIMAL(12,2)) AS total_batch_cost
  FROM (
    SELECT lt.l_partkey, lt.rk, lt.lot, lt.surplus, lt.fate, p.shelf_life_days,
           printf('GR%06d-%d-%d', lt.l_partkey, lt.rk, lt.lot) AS receipt_id,
           printf('B%06d-%d-%d', lt.l_partkey, lt.rk, lt.lot) AS batch_id,
           printf('P%06d', lt.l_partkey) AS product_id,
           printf('SUP%05d', lt.sk) AS supplier_id,
           printf('W%03d', lt.rk + 1) AS warehouse_id,
           CAST(lt.d0 - CAST(1 + 2 * lt.lot AS INTEGER) AS DATE) AS receipt_date,
           CAST(lt.sold + lt.surplus AS INTEGER) AS quantity_received,
           CAST(p.base_cost * CASE quarter(lt.d0) WHEN 3 THEN CAST(1.05 AS DECIMAL(3,2))
                                                  WHEN 1 THEN CAST(0.96 AS DECIMAL(3,2))
                                                  ELSE CAST(1.00 AS DECIMAL(3,2)) END AS DECIMAL(10,4)) AS purchase_price_per_unit
    FROM lots lt JOIN dim_products p ON lt.l_partkey = p.p_partkey) x)""",
    """fact_goods_receipts AS (
  SELECT receipt_id, batch_id, product_id, supplier_id, warehouse_id, receipt_date,
         manufacture_date, expiry_date, quantity_received, purchase_price_per_unit, total_batch_cost
  FROM receipts_keyed)""",
    """fact_sale_batch_map AS (
  SELECT printf('S%08d-%d-%d', a.l_orderkey, a.l_linenumber, a.rn) AS sale_id,
         r.batch_id, CAST(a.qty AS INTEGER) AS quantity_from_batch,
         r.purchase_price_per_unit AS unit_cost_at_sale
  FROM alloc a JOIN receipts_keyed r ON a.l_partkey = r.l_partkey AND a.rk = r.rk AND a.lot = r.lot)""",
    """fact_inventory_adjustments AS (
  SELECT printf('ADJ%06d-%d-%d', l_partkey, rk, lot) AS adjustment_id,
         expiry_date AS adjustment_date, warehouse_id, product_id, batch_id,
         CASE WHEN fate = 0 THEN 'Expiry' ELSE 'Shrinkage' END AS adjustment_type,
         CAST(CASE WHEN fate = 0 THEN surplus ELSE 1 END AS INTEGER) AS quantity_adjusted,
         CASE WHEN fate = 0 THEN 'Batch expired' ELSE 'Routine shrinkage loss' END AS reason_notes
  FROM receipts_keyed WHERE fate < 2)""",
    """fact_stockout_events AS (
  SELECT printf('SO%08d-%d-%d', l_orderkey, l_linenumber, rn) AS stockout_id,
         sd AS stockout_date, printf('W%03d', rk + 1) AS warehouse_id,
         printf('P%06d', l_partkey) AS product_id,
         q + unmet AS quantity_demanded, q AS quantity_supplied, unmet AS shortfall
  FROM line WHERE unmet > 0)""",
]

# dim_products carries p_partkey for the joins above; queries select named columns.
PRODUCT_COLUMNS = ("product_id, product_name, category, unit_size, base_cost, base_price, "
                   "shelf_life_days, launch_date, status")


def with_fixture(*ctes: str) -> str:
    """``WITH <fixture CTEs>, <ctes...>`` — prefix for an oracle query."""
    return "WITH " + ",\n".join(list(FIXTURE_CTES) + list(ctes)) + "\n"


def sql(body: str, *ctes: str) -> str:
    return with_fixture(*ctes) + body


# The planted defects of FIXTURES.md §4, as CTEs named d_<table>.
DIRTY_CTES = [
    """d_sales0 AS (
  SELECT sale_id, sale_date,
         CASE WHEN CAST(split_part(substr(sale_id, 2), '-', 1) AS BIGINT) % 997 = 4 THEN NULL ELSE warehouse_id END AS warehouse_id,
         product_id,
         CASE WHEN CAST(split_part(substr(sale_id, 2), '-', 1) AS BIGINT) % 997 = 0 THEN 0 ELSE quantity_sold END AS quantity_sold,
         selling_price_per_unit, discount_percent, promotion_flag
  FROM fact_sales)""",
    """d_fact_sales AS (
  SELECT * FROM d_sales0
  UNION ALL SELECT * FROM d_sales0 WHERE CAST(split_part(substr(sale_id, 2), '-', 1) AS BIGINT) % 997 = 3)""",
    """d_fact_goods_receipts AS (
  SELECT receipt_id, batch_id, product_id, supplier_id, warehouse_id, receipt_date, manufacture_date,
         CASE WHEN CAST(split_part(substr(batch_id, 2), '-', 1) AS BIGINT) % 97 = 0 THEN receipt_date ELSE expiry_date END AS expiry_date,
         quantity_received,
         CAST(CASE WHEN CAST(split_part(substr(batch_id, 2), '-', 1) AS BIGINT) % 97 = 5
                   THEN purchase_price_per_unit * CAST(1.20 AS DECIMAL(3,2))
                   ELSE purchase_price_per_unit END AS DECIMAL(10,4)) AS purchase_price_per_unit,
         total_batch_cost
  FROM fact_goods_receipts)""",
    """d_fact_sale_batch_map AS (
  SELECT CASE WHEN CAST(split_part(substr(sale_id, 2), '-', 1) AS BIGINT) % 997 = 2 THEN sale_id || 'X' ELSE sale_id END AS sale_id,
         CASE WHEN CAST(split_part(substr(batch_id, 2), '-', 1) AS BIGINT) % 97 = 3 THEN batch_id || 'X' ELSE batch_id END AS batch_id,
         CASE WHEN CAST(split_part(substr(sale_id, 2), '-', 1) AS BIGINT) % 997 = 1 THEN 0 ELSE quantity_from_batch END AS quantity_from_batch,
         unit_cost_at_sale
  FROM fact_sale_batch_map)""",
]
DIRTY_TABLES = ("fact_sales", "fact_goods_receipts", "fact_sale_batch_map")

# The tables of odd_tables, as CTEs named o_<table>.
ODD_CTES = [
    """o_dim_products AS (
  SELECT * REPLACE (CASE WHEN p_partkey % 97 = 7 THEN repeat('x', 500) ELSE status END AS status)
  FROM dim_products)""",
    """o_fact_goods_receipts AS (
  SELECT * REPLACE (CASE CAST(split_part(substr(batch_id, 2), '-', 1) AS BIGINT) % 97
                      WHEN 5 THEN '123456789012345.678' WHEN 6 THEN 'n/a'
                      ELSE total_batch_cost::VARCHAR END AS total_batch_cost)
  FROM fact_goods_receipts)""",
]
ODD_TABLES = ("dim_products", "fact_goods_receipts")
