"""Sales dashboard: day-to-date total and the best categories."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sparkloom.operators.ranking import category_totals, dashboard
from sparkloom.operators.windows import local_day_offset

# Categories of the generated orders.
CATEGORIES = ["女装", "男装", "图书", "家电", "洗护", "美妆", "运动", "游戏", "户外", "家具", "乐器", "办公"]
BEST = 3


def daily_dashboard(sales: DataFrame, category: str, amount: str, time: str,
                    hours_east: int = 8, decimals: int | None = None) -> DataFrame:
    """One row per local day: total and top categories."""
    totals = category_totals(sales, category, amount, time, offset=local_day_offset(hours_east),
                             decimals=decimals)
    return dashboard(totals, category, BEST)
