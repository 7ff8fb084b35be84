"""Oracle SQL for the dashboard marts, over the cells of :mod:`shelflife.plans.oracle`."""

from __future__ import annotations

from shelflife.plans import sqlfn
from shelflife.plans.fixture_sql import sql
from shelflife.plans.oracle import (CELLS, ENRICHED_SALES, LOSS, MONTH, RECEIVED, STOCK, band, count,
                                    margin, money, of, open_lots)

# The fixture's product categories (columns of the heatmap).
FIXTURE_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def roll(kind: str, keys: str, *measures: str) -> str:
    return sql(f"SELECT {', '.join([keys, *measures])} FROM cells WHERE kind = '{kind}' GROUP BY ALL", CELLS)


def oracle_marts() -> dict[str, str]:
    sales, waste = of("S", "sum(money)"), of("X", LOSS)
    left = f"{of('B', 'sum(money)')} - {of('B', 'sum(spent)')}"
    heat = ", ".join(
        sqlfn.pct(f"sum(money - spent) FILTER (m = {m})", f"sum(money) FILTER (m = {m})",
                  num_scale=4, den_scale=2) + f" AS m{m}" for m in range(1, 13))
    listed = ", ".join(f"'{c}'" for c in FIXTURE_CATEGORIES)
    columns = [count(f"coalesce(sum(n) FILTER (category = '{c}'), 0)", f'"{c}"') for c in FIXTURE_CATEGORIES]
    columns += [count(f"coalesce(sum(n) FILTER (category IS NULL OR category NOT IN ({listed})), 0)", "other"),
                count("sum(n)", "total")]
    aging = f"""aging AS (
  SELECT open_lot.*, category, warehouse_name, {band('days_until_expiry')} AS age_band
  FROM open_lot JOIN dim_products USING (product_id) JOIN dim_warehouses USING (warehouse_id))"""
    return {
        "kpi_executive": sql(f"""
SELECT {money(sales, 'total_revenue')}, {money(waste, 'total_expiry_loss')},
       (SELECT count(*) FROM fact_stockout_events) AS total_stockout_events,
       {sqlfn.pct(money(waste), money(sales), num_scale=2, den_scale=2)} AS expiry_loss_percent_of_revenue,
       {sqlfn.pct(left, of('B', 'sum(money)'), num_scale=4, den_scale=2)} AS gross_margin_percent
FROM cells""", CELLS),
        "revenue_by_month": roll("S", MONTH, money("sum(money)", "total_revenue")),
        "revenue_by_category": roll("S", "category", money("sum(money)", "total_revenue")),
        "revenue_vs_expiry_by_warehouse": sql(f"""
SELECT warehouse_id, warehouse_name, {money(sales, 'total_revenue')},
       coalesce({money(waste)}, 0::DECIMAL(38,2)) AS total_expiry_loss
FROM cells GROUP BY ALL HAVING count(*) FILTER (kind = 'S') > 0""", CELLS),
        "expiry_loss_by_month": roll("X", "m::INTEGER AS adjustment_month",
                                     count("sum(units)", "total_units_expired"),
                                     money(LOSS, "total_expiry_loss")),
        "kpi_stockout": sql("SELECT count(*) AS total_stockout_events, "
                            "sum(shortfall)::BIGINT AS total_units_short FROM fact_stockout_events"),
        "stockouts_by_month": sql("SELECT month(stockout_date)::INTEGER AS stockout_month, "
                                  "count(*) AS total_stockout_events, "
                                  "sum(shortfall)::BIGINT AS total_units_short "
                                  "FROM fact_stockout_events GROUP BY ALL"),
        "stockout_heatmap": roll("O", "warehouse_name", *columns),
        "stockout_rate_by_category": sql(f"""
SELECT category, {count(of('O', 'sum(n)'), 'total_stockout_events')},
       {count(of('S', 'sum(n)'), 'total_sales_events')},
       {sqlfn.pct(of('O', 'sum(n)'), of('S', 'sum(n)'), num_scale=0, den_scale=0)} AS stockout_rate_percent
FROM cells GROUP BY ALL HAVING total_stockout_events > 0 AND total_sales_events > 0""", CELLS),
        "purchase_price_by_month": sql(f"""
SELECT month(receipt_date)::INTEGER AS receipt_month, count(*) AS total_batches,
       {sqlfn.avg('purchase_price_per_unit', 4)} AS avg_cost_per_unit
FROM received GROUP BY ALL""", RECEIVED),
        "supplier_reliability_vs_price": sql(f"""
SELECT supplier_id, supplier_name, reliability_score,
       {sqlfn.avg('purchase_price_per_unit', 4)} AS avg_cost_per_unit
FROM received JOIN dim_suppliers USING (supplier_id) GROUP BY ALL""", RECEIVED),
        "batch_volume_by_supplier": sql("""
SELECT supplier_id, supplier_name, count(DISTINCT batch_id) AS total_batches_received,
       sum(quantity_received)::BIGINT AS total_units_received
FROM received JOIN dim_suppliers USING (supplier_id) GROUP BY ALL""", RECEIVED),
        "margin_by_month": sql(margin("money", MONTH), CELLS),
        "margin_by_category": sql(margin("money", "category"), CELLS),
        "margin_heatmap": roll("B", "category", heat),
        "margin_by_quarter": sql(margin("money", "category", "q::INTEGER AS sale_quarter"), CELLS),
        "aging_by_band": sql(f"SELECT age_band, {STOCK} FROM aging GROUP BY ALL", *open_lots(False), aging),
        "at_risk_by_warehouse_category": sql(
            f"SELECT warehouse_name, category, {STOCK} FROM aging "
            "WHERE age_band IN ('Critical', 'Near Expiry') GROUP BY ALL", *open_lots(False), aging),
        "table_preview": sql(f"{ENRICHED_SALES} ORDER BY sale_id LIMIT 10"),
    }
