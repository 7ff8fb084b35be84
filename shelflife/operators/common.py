"""Small shared pieces for the operators."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

EXPIRY = "Expiry"


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def products(t: Tables, *cols: str) -> DataFrame:
    """The product dimension: its key and ``cols``."""
    return t["dim_products"].select("product_id", *cols)


def warehouses(t: Tables, *cols: str) -> DataFrame:
    """The warehouse dimension.  No hint: the planner and AQE broadcast it when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``."""
    w = t["dim_warehouses"]
    return w.select(*cols) if cols else w


def expiry_rows(t: Tables) -> DataFrame:
    a = t["fact_inventory_adjustments"]
    return a.where(F.col("adjustment_type") == EXPIRY)
