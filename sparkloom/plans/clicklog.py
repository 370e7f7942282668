"""Click-log warehouse: messages to wide rows, channel heat, PV and UV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions.json import parse_nested
from sparkloom.functions.numbers import pick
from sparkloom.functions.time import GRAIN_PATTERNS, format_millis, millis_to_instant
from sparkloom.operators.newness import newness
from sparkloom.operators.rows import expand_grains
from sparkloom.operators.windows import window_totals
from sparkloom.streaming import stateful

# Message layout and the values a generated click can take.
MESSAGE_SCHEMA = "count BIGINT, timeStamp BIGINT, message STRING"
CLICK_FIELDS = ["channelID", "categoryID", "produceID", "country", "province", "city", "network",
                "source", "browserType", "entryTime", "leaveTime", "userID"]
CLICK_SCHEMA = ", ".join(f"{name} STRING" for name in CLICK_FIELDS)
COUNTRIES = ["china"]
PROVINCES = ["HeNan", "HeBei"]
CITIES = ["ShiJiaZhuang", "ZhengZhou", "LuoYang"]
NETWORKS = ["电信", "移动", "联通"]
SOURCES = ["直接输入", "百度跳转", "360搜索跳转", "必应跳转"]
BROWSERS = ["火狐", "qq浏览器", "360浏览器", "谷歌浏览器"]
LEAVE_TIME = 1577898060000
ID_COUNT = 20
STAY_HOURS = 10


def click_message(seed: Column, time_ms: Column, *, channel: Column | None = None,
                  user: Column | None = None, fields: Mapping[str, Column] | None = None) -> Column:
    """A generated message as JSON text, repeatable from ``seed``; ``fields`` are given instead."""
    def number(salt: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), seed), F.lit(n))

    def one_of(salt: str, values: list[str]) -> Column:
        return pick(values, F.concat_ws(":", F.lit(salt), seed.cast("string")))

    stay = number("stay", STAY_HOURS) * 3_600_000
    click = F.struct(
        (channel if channel is not None else number("channel", ID_COUNT) + 1).alias("channelID"),
        (number("category", ID_COUNT) + 1).alias("categoryID"),
        (number("product", ID_COUNT) + 1).alias("produceID"),
        (user if user is not None else number("user", ID_COUNT) + 1).alias("userID"),
        one_of("country", COUNTRIES).alias("country"),
        one_of("province", PROVINCES).alias("province"),
        one_of("city", CITIES).alias("city"),
        one_of("network", NETWORKS).alias("network"),
        one_of("source", SOURCES).alias("source"),
        one_of("browser", BROWSERS).alias("browserType"),
        (F.lit(LEAVE_TIME) - stay).alias("entryTime"), F.lit(LEAVE_TIME).alias("leaveTime"))
    for name, value in (fields or {}).items():
        click = click.withField(name, value)
    return F.to_json(F.struct(F.lit(1).alias("count"), time_ms.alias("timeStamp"),
                              F.to_json(click).alias("message")))


def messages(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON lines to columns: the click fields, ``count``, ``timestamp`` (ms), ``ts`` (instant)."""
    parsed = parse_nested(lines, col, MESSAGE_SCHEMA, "message", CLICK_SCHEMA)
    return parsed.select("message.*", "count", F.col("timeStamp").alias("timestamp"),
                         millis_to_instant("timeStamp").alias("ts"))


def time_columns(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Address and the three period texts of a wide row."""
    return df.withColumns({
        "address": F.concat("country", "province", "city"),
        "yearMonth": format_millis("timestamp", GRAIN_PATTERNS["month"], zone),
        "yearMonthDay": format_millis("timestamp", GRAIN_PATTERNS["day"], zone),
        "yearMonthDayHour": format_millis("timestamp", GRAIN_PATTERNS["hour"], zone),
    })


def wide_rows(clicks: DataFrame, zone: str = "UTC", remember: str = "last",
              **sizes) -> DataFrame:
    """Batch wide rows, visits in order of time."""
    # The tie-break names columns, so equal times give the same result every run.
    ordered = clicks.withColumn("__tie", F.xxhash64(*CLICK_FIELDS))
    flagged = newness(ordered, ["userID", "channelID"], "ts", ["ts", "__tie"], remember=remember,
                      zone=zone, **sizes)
    return time_columns(flagged.drop("__tie"), zone)


def stream_wide_rows(clicks: DataFrame, zone: str = "UTC", remember: str = "last") -> DataFrame:
    """Wide rows of a stream; the last visit of a user to a channel is keyed state."""
    ready = clicks.withColumn("__tie", F.xxhash64(*CLICK_FIELDS))
    flagged = stateful.newness(ready, ["userID", "channelID"], "ts", "__tie", remember, zone)
    return time_columns(flagged.drop("__tie"), zone)


def channel_heat(wide: DataFrame, length: str = "10 seconds") -> DataFrame:
    """Visits per channel and window."""
    return window_totals(wide, "ts", length, ["channelID"], [F.sum("count").alias("visited")])


def channel_periods(wide: DataFrame, zone: str = "UTC") -> DataFrame:
    """Each wide row as one PV, and its newness as UV, at hour, day and month."""
    one = F.lit(1).cast("long")
    return expand_grains(
        wide, "ts",
        {grain: {"pv": one, "uv": F.col(f"is_{grain}_new").cast("long")}
         for grain in GRAIN_PATTERNS},
        keep=["channelID", "ts"], zone=zone)


def channel_pvuv(wide: DataFrame, length: str = "10 seconds", zone: str = "UTC") -> DataFrame:
    """PV and UV per channel, period and window."""
    return window_totals(channel_periods(wide, zone), "ts", length, ["channelID", "period"],
                         [F.sum("pv").alias("pv"), F.sum("uv").alias("uv")])
