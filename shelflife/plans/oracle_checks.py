"""Oracle SQL for the integrity checks, quality summary and file round trips."""

from __future__ import annotations

from collections.abc import Callable

from shelflife.plans.fixture_sql import DIRTY_CTES, DIRTY_TABLES, ODD_CTES, ODD_TABLES, sql
from shelflife.schemas import (FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS, TABLE_NAMES, UNIQUE_KEYS,
                               VARCHAR_WIDTHS, decimal_columns)

Src = Callable[[str], str]


def clean(name: str) -> str:
    return name


def dirty(name: str) -> str:
    return f"d_{name}" if name in DIRTY_TABLES else name


def odd(name: str) -> str:
    return f"o_{name}" if name in ODD_TABLES else name


def pk_sql(src: Src) -> str:
    checks = list(PRIMARY_KEYS.items()) + list(UNIQUE_KEYS.items())
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, '{', '.join(k)}' AS key_columns, "
        f"(SELECT COUNT(*) FROM (SELECT {', '.join(k)} FROM {src(n)} GROUP BY {', '.join(k)} "
        f"HAVING COUNT(*) > 1)) AS duplicate_keys"
        for n, k in checks)


def not_null_sql(src: Src) -> str:
    parts = []
    for n in TABLE_NAMES:
        for f in SCHEMAS[n].fields:
            parts.append(f"SELECT '{n}' AS table_name, '{f.name}' AS column_name, "
                         f"(SELECT COUNT(*) FILTER (WHERE {f.name} IS NULL) FROM {src(n)}) AS violations")
    return "\nUNION ALL\n".join(parts)


def fk_sql(src: Src) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS child, '{col}' AS fk_column, '{p}' AS parent, "
        f"(SELECT COUNT(*) FROM {src(c)} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {src(p)} y WHERE y.{pc} = x.{col})) AS orphans"
        for c, col, p, pc in FOREIGN_KEYS)


def domain_sql(src: Src) -> str:
    parts = []
    for n in TABLE_NAMES:
        for (tn, c), w in VARCHAR_WIDTHS.items():
            if tn == n:
                parts.append(f"SELECT '{n}' AS table_name, '{c}' AS column_name, "
                             f"(SELECT COUNT(*) FILTER (WHERE length({c}) > {w}) FROM {src(n)}) AS violations")
        for c, p, s in decimal_columns(n):
            fit = f"TRY_CAST({c} AS DECIMAL({p},{s}))"
            parts.append(f"SELECT '{n}' AS table_name, '{c}' AS column_name, "
                         f"(SELECT COUNT(*) FILTER (WHERE {c} IS NOT NULL AND ({fit} IS NULL OR {fit} <> TRY_CAST({c} AS DECIMAL(38,18)))) "
                         f"FROM {src(n)}) AS violations")
    return "\nUNION ALL\n".join(parts)


# The five quality checks, their names and the rows they find.
QUALITY = {
    "A": ("Sales with zero or negative quantity", "dq_nonpositive_sales", "fact_sales",
          "quantity_sold <= 0"),
    "B": ("Batches expired before receipt date", "dq_expiry_before_receipt", "fact_goods_receipts",
          "expiry_date <= receipt_date"),
    "C": ("Zero quantities in batch map", "dq_nonpositive_batch_qty", "fact_sale_batch_map",
          "quantity_from_batch <= 0"),
    "D": ("Orphaned sale IDs in batch map", "dq_orphan_sales", "fact_sale_batch_map",
          ("fact_sales", "sale_id")),
    "E": ("Orphaned batch IDs in batch map", "dq_orphan_batches", "fact_sale_batch_map",
          ("fact_goods_receipts", "batch_id"))}


def offenders(src: Src, table: str, rule) -> str:
    """The rows of a table that break a rule: a condition, or (parent, key) without a match."""
    if isinstance(rule, str):
        return f"FROM {src(table)} WHERE {rule}"
    parent, key = rule
    return f"FROM {src(table)} ANTI JOIN {src(parent)} USING ({key})"


def dq_summary_sql(src: Src) -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS check_id, '{name}' AS check_name, count(*) AS violations, "
        f"count(*) = 0 AS passed {offenders(src, table, rule)}"
        for k, (name, _, table, rule) in QUALITY.items())


ROW_COUNTS_BODY = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in TABLE_NAMES)


def _text(table: str) -> str:
    """All columns of a row as one text."""
    return "concat_ws('|', " + ", ".join(
        f"coalesce({f.name}::VARCHAR, '')" for f in SCHEMAS[table].fields) + ")"


def oracle_checks() -> dict[str, str]:
    q = {
        "pk_violations": sql(pk_sql(clean)),
        "not_null_violations": sql(not_null_sql(clean)),
        "fk_violations": sql(fk_sql(clean)),
        "domain_violations": sql(domain_sql(clean)),
        "domain_violations_dirty": sql(domain_sql(odd), *ODD_CTES),
        "post_load_counts": sql(ROW_COUNTS_BODY),
        "pk_violations_dirty": sql(pk_sql(dirty), *DIRTY_CTES),
        "not_null_violations_dirty": sql(not_null_sql(dirty), *DIRTY_CTES),
        "fk_violations_dirty": sql(fk_sql(dirty), *DIRTY_CTES),
        "dq_summary_dirty": sql(dq_summary_sql(dirty), *DIRTY_CTES),
        # file round trips: the data must come back unchanged
        "csv_sink": sql(" UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) AS row_count, count(DISTINCT {_text(n)}) AS distinct_rows, "
            f"CAST(SUM(CAST('0x' || substr(md5({_text(n)}), 1, 12) AS BIGINT)) AS DECIMAL(38,0)) AS row_digests "
            f"FROM {n}" for n in TABLE_NAMES)),
        "csv_scan": sql(" UNION ALL ".join(
            f"SELECT '{n}' AS table_name, {_text(n)} AS row_text FROM {n}" for n in TABLE_NAMES)),
        "file_row_counts": sql(
            "SELECT table_name AS file_name, row_count, 'OK' AS status FROM rc "
            "UNION ALL SELECT 'TOTAL ROWS', CAST(SUM(row_count) AS BIGINT), 'OK' FROM rc",
            f"rc AS ({ROW_COUNTS_BODY})"),
        "full_refresh": sql(ROW_COUNTS_BODY),
    }
    q["dq_summary"] = sql(dq_summary_sql(clean))
    for _, key, table, rule in QUALITY.values():
        q[key] = sql(f"SELECT * {offenders(clean, table, rule)}")
        q[key + "_dirty"] = sql(f"SELECT * {offenders(dirty, table, rule)}", *DIRTY_CTES)
    return q
