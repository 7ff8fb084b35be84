"""Profiling and checks A-E; the checks must find the planted defects."""

from decimal import Decimal

from pyspark.sql import functions as F

from shelflife.operators import quality as E
from shelflife.sources.fixture import dirty_tables
from tests.conftest import rows


def test_sales_by_warehouse_expected_w001(medium):
    r = E.sales_by_warehouse(medium).where(F.col("warehouse_id") == "W001").first()
    assert r.total_sales_transactions == 11672
    assert r.total_units_sold == 295583
    assert r.total_revenue == Decimal("280803864.72")


def test_fractional_discount_reading_lowers_revenue(small):
    as_written = E.sales_by_warehouse(small).agg(F.sum("total_revenue")).first()[0]
    fractional = E.sales_by_warehouse(small, discount_scale=1).agg(F.sum("total_revenue")).first()[0]
    assert fractional < as_written


def test_clean_checks_pass(small):
    assert all(r.passed for r in E.dq_summary(small).collect())


def test_dirty_checks_find_offenders(small):
    got = dict(rows(E.dq_summary(dirty_tables(small)), "check_id", "violations"))
    assert got == {"A": 7, "B": 30, "C": 12, "D": 9, "E": 110}


def test_row_counts(small):
    got = dict(rows(E.row_counts(small)))
    assert got["fact_sales"] == 6000 and len(got) == 9
