"""Small inputs with known results."""

from decimal import Decimal

from pyspark.sql import functions as F

from sparkloom.functions.json import json_field, parse_nested, row_json
from sparkloom.functions.text import blank_as, pair_text, split_fields
from sparkloom.functions.time import duration_micros, format_millis, later_at_grain, window_start
from sparkloom.operators.changelog import changelog
from sparkloom.operators.joins import interval_join, last_per_key, lookup_join, window_join
from sparkloom.operators.metrics import counted
from sparkloom.operators.partitioning import (by_key, by_rule, in_place, rebalance, rescale,
                                              rows_per_partition, single, spread_random)
from sparkloom.operators.reduce import Accumulator, aggregate_by_key
from sparkloom.operators.rows import keep_any, parse_csv, route, with_partition
from sparkloom.operators.running import running_max
from sparkloom.operators.sets import map_to_common, union_all, union_distinct
from sparkloom.operators.windows import session_totals, window_totals
from sparkloom.operators.user_functions import map_with_resource
from sparkloom.plans import clicklog, etl, traffic
from sparkloom.plans.facts import facts_by_interval, facts_by_window
from sparkloom.plans.festival import daily_dashboard
from sparkloom.plans.word_count import word_count
from sparkloom.sources.generators import (GOODS, batch_ticks, click_lines, festival_sales, goods,
                                          order_items, orders, review_orders, sensor_lines,
                                          user_events)
from sparkloom.sources.literals import constants, elements, sequence
from tests.conftest import rows


def test_word_count_literal(spark):
    lines = elements(spark, ["alpha hadoop spark", "alpha hadoop spark", "alpha hadoop",
                             "alpha"], "value STRING")
    assert rows(word_count(lines)) == [("alpha", 4), ("hadoop", 3), ("spark", 2)]


def test_word_count_keeps_inner_empty_fields(spark):
    lines = elements(spark, ["a  b   ", "", "   "], "value STRING")
    got = [list(r[0]) for r in lines.select(split_fields("value")).collect()]
    assert got == [["a", "", "b"], [""], []]


def test_custom_partition(spark):
    words = elements(spark, "hadoop hello hive hello hadoop spark".split(), "word STRING")
    placed = with_partition(by_rule(words, 2, F.when(F.col("word") == "hello", 0).otherwise(1)))
    got = {(r.word, r.partition) for r in placed.collect()}
    assert got == {("hello", 0), ("hadoop", 1), ("hive", 1), ("spark", 1)}


def test_exact_lines(spark):
    lines = elements(spark, ["one", "two", "three"], "value STRING")
    assert rows(keep_any(lines, "value", ["one", "three"])) == [("one",), ("three",)]


def test_union_of_filtered_orders(spark):
    schema = "user BIGINT, product STRING, amount INT"
    a = elements(spark, [(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 12)], schema)
    b = elements(spark, [(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], schema)
    got = union_distinct(a.where("amount > 2"), b.where("amount > 1"))
    assert len(rows(got)) == 5 and (4, "beer", 1) not in rows(got)
    again = union_distinct(a, a)
    assert again.count() == 3 and union_all(a, a).count() == 6


def test_having_and_changelog(spark):
    wc = elements(spark, [(1, "hello", 1), (2, "world", 1), (3, "hello", 1)],
                  "seq INT, word STRING, frequency BIGINT")
    totals = wc.groupBy("word").agg(F.sum("frequency").alias("frequency"))
    assert rows(totals.where("frequency = 2")) == [("hello", 2)]
    log = changelog(wc, ["word"], ["seq"], "frequency").orderBy("seq", "step")
    assert [(r.is_add, r.word, r.total) for r in log.collect()] == [
        (True, "hello", 1), (True, "world", 1), (False, "hello", 1), (True, "hello", 2)]


def test_running_max_of_cities(spark):
    data = [("北京", 1), ("上海", 2), ("北京", 6), ("上海", 8), ("北京", 3), ("上海", 4)]
    df = elements(spark, [(i, c, v) for i, (c, v) in enumerate(data)],
                  "seq INT, city STRING, value BIGINT")
    got = running_max(df, ["city"], ["seq"], "value").orderBy("seq").collect()
    assert [r.running_max for r in got] == [1, 2, 6, 8, 6, 8]


def test_lookup_with_default(spark):
    students = elements(spark, [(1, "张三"), (2, "李四"), (3, "王五")], "id INT, name STRING")
    scores = elements(spark, [(1, "语文", 50), (2, "数学", 70), (3, "英文", 86), (9, "体育", 1)],
                      "id INT, subject STRING, score INT")
    got = lookup_join(scores, students, {"id": "id"}, ["name"], missing={"name": ""},
                      broadcast_rows=10).select("name", "subject", "score")
    assert rows(got) == [("", "体育", 1), ("张三", "语文", 50), ("李四", "数学", 70),
                         ("王五", "英文", 86)]
    assert lookup_join(scores, students, {"id": "id"}, ["name"], missing="inner").count() == 3


def test_unknown_key_can_fail(spark):
    dim = elements(spark, [(1, "a")], "id INT, name STRING")
    facts = elements(spark, [(1,), (2,)], "key INT")
    joined = lookup_join(facts, dim, {"key": "id"}, ["name"], missing="fail")
    try:
        joined.collect()
    except Exception as error:
        assert "no dimension row" in str(error)
    else:
        raise AssertionError("an unknown key must fail")


def test_last_duplicate_wins(spark):
    dim = elements(spark, [(1, "old", 1), (1, "new", 2)], "id INT, name STRING, line INT")
    assert rows(last_per_key(dim, ["id"], "line")) == [(1, "new", 2)]


def test_counter(spark):
    df, seen = counted(elements(spark, ["aaa", "bbb", "ccc", "ddd"], "value STRING"))
    df.collect()
    assert seen.get["rows"] == 4


def test_connected_types(spark):
    a = elements(spark, ["1", "2", "3"], "s STRING")
    b = elements(spark, [1, 2, 3], "n BIGINT")
    both = map_to_common(a, {"word": "s"}, b, {"word": F.col("n").cast("string")})
    assert rows(both.groupBy("word").count()) == [("1", 2), ("2", 2), ("3", 2)]


def test_sequence_and_parity(spark):
    parts = route(sequence(spark, 1, 100), {"even": F.col("value") % 2 == 0,
                                            "odd": F.col("value") % 2 == 1})
    assert parts["even"].count() == 50 and parts["odd"].count() == 50
    assert rows(constants(spark, 1, 2, 3, 4)) == [(1, 2, 3, 4)]


def test_rebalance(spark):
    big = sequence(spark, 1, 10_000, 1).where("value > 10")
    spread = [r.n_rows for r in rows_per_partition(rebalance(big, 8)).collect()]
    assert sum(spread) == 9990 and len(spread) == 8 and max(spread) - min(spread) < 50
    assert rows_per_partition(single(big)).count() == 1
    assert rows_per_partition(in_place(big)).count() == 1
    assert rows_per_partition(rescale(rebalance(big, 8), 2)).count() == 2
    assert rows_per_partition(rescale(big, 4, grow=True)).count() == 4
    assert rows_per_partition(spread_random(big, 4, 7, ["value"])).count() == 4
    copies = big.select(F.lit(1).alias("same"))
    even = [r.n_rows for r in rows_per_partition(spread_random(copies, 4)).collect()]
    assert max(even) - min(even) < 50
    keyed = with_partition(by_key(big.withColumn("k", F.col("value") % 5), "k", n=4))
    assert keyed.groupBy("k").agg(F.count_distinct("partition").alias("p")).where("p > 1").count() == 0


def test_click_message(spark):
    line = ('{"count":1,"message":"{\\"browserType\\":\\"qq浏览器\\",\\"categoryID\\":7,'
            '\\"channelID\\":12,\\"city\\":\\"LuoYang\\",\\"country\\":\\"china\\",'
            '\\"entryTime\\":1577876460000,\\"leaveTime\\":1577898060000,'
            '\\"network\\":\\"电信\\",\\"produceID\\":12,\\"province\\":\\"HeNan\\",'
            '\\"source\\":\\"必应跳转\\",\\"userID\\":19}","timeStamp":1611283392078}')
    clicks = clicklog.messages(elements(spark, [line], "value STRING"))
    row = clicklog.wide_rows(clicks).first()
    assert (row.channelID, row.userID, row["count"], row.timestamp) == ("12", "19", 1, 1611283392078)
    assert row.address == "chinaHeNanLuoYang" and row.yearMonthDayHour == "2021012202"
    assert (row.is_new, row.is_hour_new, row.is_day_new, row.is_month_new) == (1, 1, 1, 1)
    east = clicklog.wide_rows(clicks, "Asia/Shanghai").first()
    assert east.yearMonthDayHour == "2021012210"


def test_status_feed(spark):
    lines = elements(spark, [f'{{"user_id": "{u}", "page_id":"1", "status": "{s}"}}' for u, s in
                             [(1, "success"), (1, "success"), (2, "success"), (4, "success"),
                              (1, "fail")]], "value STRING")
    kept = etl.successes(etl.parse_feed(lines))
    assert rows(kept) == [(1, 1, "success"), (1, 1, "success"), (2, 1, "success"),
                          (4, 1, "success")]


def test_functions(spark):
    df = elements(spark, [(1611283392078, "  ", '{"a": {"b": 1}, "n": 5}')],
                  "ms BIGINT, blank STRING, js STRING")
    got = df.select(
        format_millis("ms", "yyyyMMddHH").alias("utc"),
        format_millis("ms", "yyyyMM", "Asia/Shanghai").alias("month"),
        blank_as("blank", "0").alias("zero"), json_field("js", "n", "int").alias("n"),
        pair_text("ms", "blank").alias("pair"),
        row_json(df, "ms").alias("json"),
        later_at_grain(F.timestamp_millis("ms"), F.timestamp_millis(F.lit(1611283200000)), "hour")
        .alias("same_hour"),
        window_start(F.timestamp_millis("ms"), "1 day", "-8 hours").cast("string").alias("day"),
    ).first()
    assert got.utc == "2021012202" and got.month == "202101" and got.zero == "0" and got.n == 5
    assert got.pair == "1611283392078:  " and got.json == '{"ms":1611283392078}'
    assert got.same_hour == 0 and got.day == "2021-01-21 16:00:00"
    assert duration_micros("1 hour 30 minutes") == 5_400_000_000
    nested = elements(spark, ['{"n": 1, "m": "{\\"x\\": 7}"}'], "value STRING")
    parsed = parse_nested(nested, "value", "n INT, m STRING", "m", "x STRING")
    assert parsed.select("m.x", "n").first()[:] == ("7", 1)


def test_csv_lines_and_sensor_windows(spark):
    lines = elements(spark, ["9,3", "9,2", "9,7", "4,9"], "value STRING")
    typed = parse_csv(lines, "value", "sensor STRING, count INT")
    assert rows(typed.groupBy("sensor").agg(F.sum("count"))) == [("4", 9), ("9", 12)]


def test_dashboard(spark):
    sales = elements(spark, [("a", 1.007, "2021-11-10 16:00:00"), ("b", 2.0, "2021-11-11 15:59:59"),
                             ("c", 2.0, "2021-11-11 01:00:00"), ("d", 9.0, "2021-11-11 02:00:00"),
                             ("a", 5.0, "2021-11-11 16:00:00")],
                     "category STRING, price DOUBLE, at STRING")
    sales = sales.withColumn("ts", F.col("at").cast("timestamp_ntz"))
    got = daily_dashboard(sales, "category", "price", "ts").orderBy("window_start").collect()
    assert [r.total for r in got] == [14.01, 5.0]
    assert got[0].top_categories == "d=9.00\nb=2.00\nc=2.00"


def test_interval_bounds_are_inclusive(spark):
    left = elements(spark, [("k", "2021-01-01 00:00:10")], "a STRING, at STRING") \
        .withColumn("at", F.col("at").cast("timestamp"))
    right = elements(spark, [("k", f"2021-01-01 00:00:{s:02d}") for s in range(0, 20)],
                     "b STRING, bt STRING").withColumn("bt", F.col("bt").cast("timestamp"))
    got = interval_join(left, right, {"a": "b"}, "at", "bt", "-2 seconds", "1 second")
    assert sorted(r.bt.second for r in got.collect()) == [8, 9, 10, 11]
    inside = window_join(left, right, {"a": "b"}, "at", "bt", "5 seconds")
    assert sorted(r.bt.second for r in inside.collect()) == [10, 11, 12, 13, 14]


def test_session_edges_merge_at_equal_gap(spark):
    df = elements(spark, [("a", s) for s in (0, 10, 21)], "k STRING, s INT").withColumn(
        "ts", F.timestamp_seconds(F.col("s")))
    got = session_totals(df, "ts", "10 seconds", ["k"], {"n": ("count", None)})
    assert sorted(r.n for r in got.collect()) == [1, 2]


class Mean(Accumulator):
    def create(self):
        return (0, 0)

    def add(self, acc, columns):
        return acc[0] + int(columns["v"].sum()), acc[1] + len(columns["v"])

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, acc):
        return (acc[0] / acc[1],)


def test_user_accumulator(spark):
    value = F.col("value")
    df = sequence(spark, 1, 1000, 8).select(
        F.when(value % 4 > 0, value % 4).alias("k"), (value % 2).cast("string").alias("j"),
        value.alias("v"))
    for keys in (["k"], ["k", "j"]):
        got = aggregate_by_key(df, keys, ["v"], Mean(), "mean DOUBLE", flush_keys=1)
        assert got.schema["k"].dataType.typeName() == "long"
        assert rows(got) == rows(df.groupBy(*keys).agg(F.avg("v")))


def test_generators(spark):
    ticks = batch_ticks(spark, 500, 4)
    made = orders(ticks, late_seconds=4)
    assert made.agg(F.min("user_id"), F.max("user_id")).first()[:] == (0, 2)
    assert made.agg(F.max("money")).first()[0] <= 100 and made.select("id").distinct().count() == 500
    assert rows(orders(ticks)) == rows(orders(ticks))
    assert festival_sales(ticks).select("category").distinct().count() == 12
    assert review_orders(ticks).select("user_id").distinct().count() == 5
    assert user_events(ticks).select("user_id").distinct().count() == 4
    assert parse_csv(sensor_lines(ticks), "value", "s STRING, n INT").where("n IS NULL").count() == 0
    items, shop = order_items(ticks), goods(batch_ticks(spark, 1))
    priced = items.join(shop, items.item_goods_id == shop.goods_id)
    assert shop.count() == len(GOODS) and priced.count() == 500
    total = priced.select((F.col("count") * F.col("goods_price")).alias("m")).first().m
    assert isinstance(total, Decimal)
    clicks = clicklog.messages(click_lines(ticks))
    assert clicks.where("channelID IS NULL OR userID IS NULL OR ts IS NULL").count() == 0
    heat = clicklog.channel_heat(clicks)
    assert heat.agg(F.sum("visited")).first()[0] == 500
    pvuv = clicklog.channel_pvuv(clicklog.wide_rows(clicks))
    assert pvuv.agg(F.sum("pv")).first()[0] == 1500


def test_window_totals_of_stream_and_batch_share_columns(spark):
    ticks = batch_ticks(spark, 20)
    got = window_totals(ticks, "timestamp", "10 seconds", [], [F.count(F.lit(1)).alias("n")])
    assert got.columns == ["window_start", "window_end", "n"]
    assert [r.n for r in got.collect()] == [10, 10]


def test_traffic(spark):
    lines = elements(spark, [(s, f"9,{s}") for s in (0, 3, 4, 12, 40)], "s INT, value STRING")
    read = traffic.cars(lines).withColumn("ts", F.lit(None).cast("timestamp"))
    assert read.columns == ["sensor", "count", "ts"]
    timed = lines.select(F.lit("9").alias("sensor"), F.col("s").alias("count"),
                         F.timestamp_seconds("s").alias("ts"))
    assert sorted(r["count"] for r in traffic.tumbling(timed, "ts").collect()) == [7, 12, 40]
    assert sorted(r["count"] for r in traffic.sliding(timed, "ts").collect()) == [7, 7, 12, 12, 40, 40]
    assert sorted(r["count"] for r in traffic.sessions(timed, "ts").collect()) == [19, 40]
    assert traffic.arriving(timed).agg(F.sum("count")).first()[0] == 59


def test_resource_per_task(spark, tmp_path):
    path = str(tmp_path / "opened")

    class Resource:
        def __init__(self):
            with open(path, "a") as f:
                f.write("o")

        def close(self):
            with open(path, "a") as f:
                f.write("c")

    df = sequence(spark, 1, 10, 1)
    got = map_with_resource(df, Resource, lambda r, frame: frame.assign(value=frame.value + 1),
                            "value BIGINT")
    assert rows(got) == sorted([(i,) for i in range(2, 12)], key=repr)
    assert open(path).read() == "oc"


def test_goods_facts(spark):
    shop = goods(batch_ticks(spark, 30))
    items = order_items(batch_ticks(spark, 30))
    on = {"item_goods_id": "goods_id"}
    by_window = facts_by_window(items, shop, on, "item_ts", "goods_ts", "5 seconds", "count",
                                "goods_price")
    assert by_window.count() == 150
    assert by_window.where("total_money <> count * goods_price").count() == 0
    near = facts_by_interval(items, shop, on, "item_ts", "goods_ts", "-2 seconds", "1 second",
                             "count", "goods_price")
    assert near.count() == 30 * 4 - 1 - 2 - 1
