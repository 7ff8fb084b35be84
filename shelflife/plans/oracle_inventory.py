"""Oracle SQL for the stock operators (M) and the scalar rules."""

from __future__ import annotations

import datetime as dt

from shelflife.plans import sqlfn
from shelflife.plans.fixture_sql import DIRTY_CTES, PRODUCT_COLUMNS, sql
from shelflife.plans.oracle import AS_OF

# Fixture parameters of the stock operators.
FIXTURE_COLD = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")
FIXTURE_DAY = dt.date(1995, 9, 30)
REGION_FACTORS = {"AFRICA": 1.10, "ASIA": 0.90, "EUROPE": 1.20}
PROMO_BOOST = 1.5


def _left(sold: str, adj: str) -> str:
    return f"r.quantity_received - COALESCE({sold}.sold, 0) - COALESCE({adj}.adjusted, 0)"


def _base_demand(until: str | None) -> str:
    cond = f"WHERE sale_date <= {until}" if until else ""
    return f"""base AS (
  SELECT warehouse_id, product_id, CAST(SUM(u) AS DOUBLE) / COUNT(*) AS base_daily_demand
  FROM (SELECT warehouse_id, product_id, sale_date, SUM(quantity_sold) AS u
        FROM fact_sales {cond} GROUP BY warehouse_id, product_id, sale_date) d
  GROUP BY warehouse_id, product_id)"""


def _stock_on_hand(as_of: str) -> str:
    return f"""soh AS (
  SELECT r.warehouse_id, r.product_id, CAST(SUM({_left('so', 'ad')}) AS BIGINT) AS stock
  FROM fact_goods_receipts r
  LEFT JOIN (SELECT m.batch_id, SUM(m.quantity_from_batch) AS sold
             FROM fact_sale_batch_map m JOIN fact_sales s ON m.sale_id = s.sale_id
             WHERE s.sale_date <= {as_of} GROUP BY m.batch_id) so ON r.batch_id = so.batch_id
  LEFT JOIN (SELECT batch_id, SUM(quantity_adjusted) AS adjusted FROM fact_inventory_adjustments
             WHERE adjustment_date <= {as_of} GROUP BY batch_id) ad ON r.batch_id = ad.batch_id
  WHERE r.receipt_date <= {as_of} AND r.expiry_date > {as_of}
  GROUP BY r.warehouse_id, r.product_id)"""


PRIMARY = """prim AS (
  SELECT product_id, supplier_id FROM (
    SELECT product_id, supplier_id,
           row_number() OVER (PARTITION BY product_id ORDER BY is_primary DESC, supplier_id) AS rn
    FROM dim_supplier_products) x WHERE rn = 1)"""


def oracle_inventory() -> dict[str, str]:
    q: dict[str, str] = {}
    q["primary_supplier"] = sql("SELECT product_id, supplier_id FROM prim", PRIMARY)
    cold = ", ".join(f"'{c}'" for c in FIXTURE_COLD)
    q["stockable_pairs"] = sql(f"""
SELECT p.product_id, w.warehouse_id FROM dim_products p, dim_warehouses w
WHERE NOT (p.category IN ({cold}) AND w.cold_storage_flag = 0)""")
    q["active_products"] = sql(f"""
SELECT {PRODUCT_COLUMNS} FROM dim_products WHERE status = 'Active' AND launch_date <= {AS_OF}""")
    weekend = " * CAST(1.55 AS DOUBLE)" if FIXTURE_DAY.weekday() >= 5 else ""
    region = "CASE w.region " + " ".join(
        f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in REGION_FACTORS.items()) + " ELSE CAST(1.0 AS DOUBLE) END"
    q["expected_demand"] = sql(f"""
SELECT b.warehouse_id, b.product_id, b.base_daily_demand,
       CAST(GREATEST(1, CAST(round_even(b.base_daily_demand{weekend} * {region} * CAST({PROMO_BOOST} AS DOUBLE), 0) AS INTEGER)) AS INTEGER)
         AS expected_demand
FROM base b JOIN dim_warehouses w ON b.warehouse_id = w.warehouse_id""", _base_demand(f"{AS_OF} - 1"))
    std = ("CAST(p.base_cost * CASE quarter(r.receipt_date) WHEN 3 THEN CAST(1.05 AS DECIMAL(3,2)) "
           "WHEN 1 THEN CAST(0.96 AS DECIMAL(3,2)) ELSE CAST(1.00 AS DECIMAL(3,2)) END AS DECIMAL(10,4))")
    q["purchase_cost_variance"] = sql(f"""
SELECT batch_id, standard_cost, purchase_price_per_unit,
       {sqlfn.pct('purchase_price_per_unit - standard_cost', 'standard_cost', num_scale=4, den_scale=4)}
         AS variance_percent,
       CASE WHEN abs(purchase_price_per_unit - standard_cost) > standard_cost * CAST(0.08 AS DECIMAL(3,2))
            THEN 1 ELSE 0 END AS outside_band
FROM (SELECT r.batch_id, r.purchase_price_per_unit, {std} AS standard_cost
      FROM fact_goods_receipts r JOIN dim_products p ON r.product_id = p.product_id) x""")
    q["purchase_cost_variance_dirty"] = sql(
        q["purchase_cost_variance"][len(sql("")):].replace("fact_goods_receipts", "d_fact_goods_receipts"),
        *DIRTY_CTES)
    q["stock_on_hand"] = sql("SELECT * FROM soh", _stock_on_hand(AS_OF))
    q["reorder_candidates"] = sql(f"""
SELECT warehouse_id, product_id, supplier_id, coalesce(stock, 0)::BIGINT AS stock,
       coalesce(base_daily_demand, 0)::DOUBLE AS base_daily_demand,
       CASE WHEN coalesce(base_daily_demand, 0) = 0 THEN 999::DOUBLE
            ELSE coalesce(stock, 0)::DOUBLE / base_daily_demand END AS coverage_days,
       average_lead_time_days AS lead_time_days,
       (coverage_days < average_lead_time_days + 1)::INTEGER AS reorder
FROM (SELECT product_id, warehouse_id FROM dim_products p, dim_warehouses
      WHERE p.status = 'Active' AND p.launch_date <= {AS_OF}
        AND (cold_storage_flag = 1 OR p.category NOT IN ({cold})))
LEFT JOIN soh USING (warehouse_id, product_id)
LEFT JOIN base USING (warehouse_id, product_id)
JOIN prim USING (product_id)
JOIN (SELECT supplier_id, average_lead_time_days FROM dim_suppliers) USING (supplier_id)""",
                                   _stock_on_hand(AS_OF), _base_demand(AS_OF), PRIMARY)
    ledger = """
SELECT warehouse_id, product_id, ledger_date, net_change,
       CAST(SUM(net_change) OVER (PARTITION BY warehouse_id, product_id ORDER BY ledger_date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS balance
FROM (SELECT warehouse_id, product_id, ledger_date, CAST(SUM(q) AS BIGINT) AS net_change FROM (
        SELECT warehouse_id, product_id, receipt_date AS ledger_date, CAST(quantity_received AS BIGINT) AS q
        FROM fact_goods_receipts
        UNION ALL SELECT warehouse_id, product_id, sale_date, -CAST(quantity_sold AS BIGINT) FROM fact_sales
        UNION ALL SELECT warehouse_id, product_id, adjustment_date, -CAST(quantity_adjusted AS BIGINT)
        FROM fact_inventory_adjustments) m
      GROUP BY warehouse_id, product_id, ledger_date) d"""
    q["inventory_ledger"] = sql(ledger)
    q["balance_at_quarter_ends"] = sql("""
SELECT warehouse_id, product_id, period_end, balance
FROM ask ASOF LEFT JOIN led USING (warehouse_id, product_id, period_end)""", f"""led0 AS MATERIALIZED ({ledger})""",
        """led AS (SELECT * RENAME (ledger_date AS period_end) FROM led0)""",
        """ask AS (
  SELECT warehouse_id, product_id, (unnest(generate_series(a, b, INTERVAL 3 MONTH)) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS period_end
  FROM (SELECT warehouse_id, product_id, date_trunc('quarter', min(ledger_date))::TIMESTAMP AS a,
               date_trunc('quarter', max(ledger_date))::TIMESTAMP AS b
        FROM led0 GROUP BY ALL))""")
    q["csv_rejects"] = sql("""
SELECT CASE ok WHEN 1 THEN 'sale_date is not date' WHEN 2 THEN 'quantity_sold is not int'
               WHEN 3 THEN '9 fields of 8' ELSE '7 fields of 8' END AS reason,
       concat_ws(',', sale_id, CASE WHEN ok = 1 THEN strftime(sale_date, '%Y') || '-13-01' ELSE sale_date::VARCHAR END,
                 warehouse_id, product_id, CASE WHEN ok = 2 THEN 'x' ELSE '' END || quantity_sold, selling_price_per_unit,
                 discount_percent, CASE WHEN ok <> 4 THEN promotion_flag END, CASE WHEN ok = 3 THEN 9 END) AS row_text,
       1::BIGINT AS row_count, NULL::BIGINT AS units
FROM text_line WHERE ok BETWEEN 1 AND 4
UNION ALL
SELECT NULL, NULL, count(*), sum(quantity_sold)::BIGINT FROM text_line WHERE ok NOT BETWEEN 1 AND 4""",
        """text_line AS (SELECT *, split_part(substr(sale_id, 2), '-', 1)::BIGINT % 499 AS ok FROM fact_sales)""")
    q["expiry_writeoffs"] = sql(f"""
SELECT r.batch_id, r.warehouse_id, r.product_id, r.expiry_date AS adjustment_date,
       'Expiry' AS adjustment_type, CAST({_left('so', 'ad')} AS BIGINT) AS quantity_adjusted
FROM expired r
LEFT JOIN (SELECT e.batch_id, SUM(bs.quantity_from_batch) AS sold
           FROM bs JOIN expired e ON bs.batch_id = e.batch_id
           WHERE bs.sale_date < e.expiry_date GROUP BY e.batch_id) so ON r.batch_id = so.batch_id
LEFT JOIN (SELECT e.batch_id, SUM(a.quantity_adjusted) AS adjusted
           FROM fact_inventory_adjustments a JOIN expired e ON a.batch_id = e.batch_id
           WHERE a.adjustment_date < e.expiry_date GROUP BY e.batch_id) ad ON r.batch_id = ad.batch_id
WHERE {_left('so', 'ad')} > 0""",
        f"""expired AS MATERIALIZED (SELECT * FROM fact_goods_receipts WHERE expiry_date <= {AS_OF})""",
        """bs AS MATERIALIZED (SELECT m.batch_id, m.quantity_from_batch, s.sale_date
                              FROM fact_sale_batch_map m JOIN fact_sales s ON m.sale_id = s.sale_id)""")
    q["batch_allocation"] = sql("""
SELECT s.sale_id, b.batch_id,
       CAST(LEAST(s.hi, b.hi) - GREATEST(s.hi - s.q, b.hi - b.q) AS BIGINT) AS quantity_from_batch
FROM (SELECT sale_id, warehouse_id, product_id, quantity_sold AS q,
             SUM(quantity_sold) OVER (PARTITION BY warehouse_id, product_id ORDER BY sale_date, sale_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi
      FROM fact_sales WHERE quantity_sold > 0) s
JOIN (SELECT batch_id, warehouse_id, product_id, quantity_received AS q,
             SUM(quantity_received) OVER (PARTITION BY warehouse_id, product_id ORDER BY expiry_date, receipt_date, batch_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi
      FROM fact_goods_receipts WHERE quantity_received > 0) b
  ON s.warehouse_id = b.warehouse_id AND s.product_id = b.product_id
 AND s.hi - s.q < b.hi AND b.hi - b.q < s.hi""")
    # Per pair the steps (sale, lot) in (sale date, sale id, expiry, receipt, batch) order;
    # the state carries what the lots still hold and what the sale still needs.
    q["batch_allocation_dated"] = sql("""
SELECT sale_id, batch_id, took AS quantity_from_batch FROM walk WHERE took > 0""",
                                      """step AS MATERIALIZED (
  SELECT warehouse_id, product_id, sale_id, batch_id, quantity_sold AS wanted, lot_no,
         row_number() OVER (PARTITION BY warehouse_id, product_id
                            ORDER BY sale_date, sale_id, lot_no) AS step_no,
         row_number() OVER (PARTITION BY sale_id ORDER BY lot_no) = 1 AS fresh
  FROM fact_sales
  JOIN (SELECT *, row_number() OVER (PARTITION BY warehouse_id, product_id
                                     ORDER BY expiry_date, receipt_date, batch_id) AS lot_no
        FROM fact_goods_receipts WHERE quantity_received > 0) USING (warehouse_id, product_id)
  WHERE quantity_sold > 0 AND receipt_date <= sale_date AND sale_date < expiry_date)""",
                                      """held AS MATERIALIZED (
  SELECT warehouse_id, product_id, list(quantity_received ORDER BY expiry_date, receipt_date, batch_id) AS have
  FROM fact_goods_receipts WHERE quantity_received > 0 GROUP BY ALL)""",
                                      """walk AS (
  SELECT warehouse_id, product_id, 0::BIGINT AS step_no, have::BIGINT[] AS have, 0::BIGINT AS need,
         ''::VARCHAR AS sale_id, ''::VARCHAR AS batch_id, 0::BIGINT AS took FROM held
  UNION ALL
  SELECT warehouse_id, product_id, step.step_no,
         list_concat(have[:lot_no - 1], [have[lot_no] - least(have[lot_no], open_need)], have[lot_no + 1:]),
         open_need - least(have[lot_no], open_need), step.sale_id, step.batch_id,
         least(have[lot_no], open_need)
  FROM (SELECT walk.warehouse_id, walk.product_id, have, step.*,
               CASE WHEN fresh THEN wanted::BIGINT ELSE need END AS open_need
        FROM walk JOIN step ON walk.warehouse_id = step.warehouse_id
          AND walk.product_id = step.product_id AND step.step_no = walk.step_no + 1) step)""").replace(
        "WITH ", "WITH RECURSIVE ", 1)
    q["stockout_days"] = sql("""
SELECT stockout_date, warehouse_id, product_id, quantity_demanded, quantity_supplied,
       quantity_demanded - quantity_supplied AS shortfall
FROM (SELECT stockout_date, warehouse_id, product_id,
             CAST(SUM(quantity_demanded) AS BIGINT) AS quantity_demanded,
             CAST(SUM(quantity_supplied) AS BIGINT) AS quantity_supplied
      FROM (SELECT stockout_date, warehouse_id, product_id, quantity_demanded, quantity_supplied
            FROM fact_stockout_events
            UNION ALL SELECT sale_date, warehouse_id, product_id, quantity_sold, quantity_sold FROM fact_sales)
      GROUP BY stockout_date, warehouse_id, product_id) g
WHERE quantity_demanded - quantity_supplied > 0""")
    q["scalar_derivations"] = sql("""
SELECT s.sale_id,
       string_split(p.product_name, ' ')[-1] AS name_token,
       CAST(CASE WHEN isodow(s.sale_date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       CAST(quarter(s.sale_date) AS INTEGER) AS sale_quarter,
       CAST(s.sale_date + p.shelf_life_days AS DATE) AS best_before,
       LEAST(GREATEST(s.quantity_sold, 1), 40) AS clamped_units,
       CAST(round_even(s.selling_price_per_unit * (1 - s.discount_percent), 2) AS DECIMAL(10,2)) AS net_unit_price,
       s.warehouse_id || '-' || strftime(s.sale_date, '%Y%m%d') || '-' ||
         printf('T%05d', row_number() OVER (PARTITION BY s.warehouse_id, s.sale_date ORDER BY s.sale_id)) AS txn_no,
       strftime(s.sale_date, '%Y-%m-%d') AS sale_date_text,
       CASE WHEN s.discount_percent > 0 THEN 1 ELSE 0 END AS discounted
FROM fact_sales s JOIN dim_products p ON s.product_id = p.product_id""")
    return q
