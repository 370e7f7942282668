"""Sources and sinks that need no service."""

import bz2
import gzip
import threading
import time
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkloom.operators.lookups import UNKNOWN, service_lookup
from sparkloom.sinks import console, files, jdbc as jdbc_sink, kafka as kafka_sink
from sparkloom.sinks.keyed import ADD, REPLACE, KeyedTable
from sparkloom.sinks.rows import RowWriter, for_each_task
from sparkloom.sinks.tables import stream_into
from sparkloom.sources import catalog, kafka
from sparkloom.sources.jdbc import JdbcTable, polled
from sparkloom.sources.lines import read_lines, read_zip_lines, socket_lines, stream_lines
from sparkloom.sources.literals import elements, sequence
from sparkloom.sources.side_file import side_table, with_side_file
from sparkloom.streaming.runtime import to_files
from tests.conftest import rows


def test_text_files_and_archives(spark, tmp_path):
    lines = ["hadoop hello hive", "hello hadoop", "spark"]
    text = "\n".join(lines) + "\n"
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.txt").write_text(text)
    with gzip.open(tmp_path / "b.txt.gz", "wt") as f:
        f.write(text)
    with bz2.open(tmp_path / "c.txt.bz2", "wt") as f:
        f.write(text)
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as f:
        f.writestr("one.txt", text)
        f.writestr("two.txt", "more\n" * 10_001)
    expected = sorted((line,) for line in lines)
    for path in ("plain", "plain/a.txt", "b.txt.gz", "c.txt.bz2"):
        assert rows(read_lines(spark, str(tmp_path / path))) == expected
    zipped = read_zip_lines(spark, str(tmp_path / "d.zip"))
    assert zipped.count() == 10_004 and rows(zipped.where("value <> 'more'")) == expected
    stream = stream_lines(spark, str(tmp_path / "plain"), max_files=1)
    out = str(tmp_path / "out")
    to_files(stream, out, str(tmp_path / "ckpt"), "text").awaitTermination()
    assert rows(spark.read.text(out)) == expected
    assert socket_lines(spark, "localhost", 9999).isStreaming


def test_text_output(spark, folder):
    path = folder()
    df = sequence(spark, 1, 100, 8).select(F.col("value").cast("string").alias("value"))
    for _ in range(2):
        files.write_text(df, path, 2)
    assert spark.read.text(path).count() == 100 and len(spark.read.text(path).inputFiles()) == 2
    assert files.output_path(["--output", "/x/y"], "/d") == "/x/y"
    assert files.output_path([], "/d").startswith("/d/wordcount/output_")


def test_console(spark, capsys):
    console.show(elements(spark, [1], "v INT"), "label", n=5)
    console.show(elements(spark, [2], "v INT"), n=5, err=True)
    shown = capsys.readouterr()
    assert shown.out == "label> Row(v=1)\n" and shown.err == "Row(v=2)\n"


def test_rolling_files(spark, folder):
    source, out = folder("in"), folder("out")
    sequence(spark, 1, 100, 1).write.parquet(source)
    stream = spark.readStream.schema("value BIGINT").parquet(source)
    writer = files.file_stream(files.with_date(stream), out, folder("c"), max_rows_per_file=30,
                               partition_by=["dt"])
    writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 100 and len(got.inputFiles()) == 4 and "dt" in got.columns


def test_side_files(spark, tmp_path):
    path = tmp_path / "students.csv"
    path.write_text("1,张三\n2,李四\n")
    table = side_table(spark, str(path), "id INT, name STRING")
    assert rows(table) == [(1, "张三"), (2, "李四")]

    def add_names(frame: pd.DataFrame, local: str) -> pd.DataFrame:
        with open(local, encoding="utf-8") as f:
            names = dict(line.strip().split(",") for line in f)
        return frame.assign(name=[names.get(str(i), "") for i in frame["id"]])

    got = with_side_file(elements(spark, [1, 2, 7], "id INT"), str(path), "id INT, name STRING",
                         add_names)
    assert rows(got) == [(1, "张三"), (2, "李四"), (7, "")]


def test_service_lookup(spark):
    names = {1: "手机", 2: "电脑", 3: "服装"}

    def connect():
        active, most, lock = [0], [0], threading.Lock()

        def call(key):
            with lock:
                active[0] += 1
                most[0] = max(most[0], active[0])
            assert most[0] <= 10
            time.sleep(2.5 if key == 5 else 0.01)
            with lock:
                active[0] -= 1
            return names.get(key)
        return call

    got = service_lookup(elements(spark, [1, 2, 3, 4, 5, 1], "id INT"), "id", "name", connect,
                         timeout=1.0)
    assert rows(got) == [(1, "手机"), (1, "手机"), (2, "电脑"), (3, "服装"), (4, None), (5, UNKNOWN)]


def test_keyed_table(spark, folder):
    root = folder()
    def table():
        return KeyedTable(spark, root, "k STRING", "n BIGINT, name STRING",
                          {"n": ADD, "name": REPLACE})
    kv = table()
    schema = "k STRING, n BIGINT, name STRING, seq INT"
    kv.upsert(elements(spark, [("a", 1, "x", 1), ("a", 2, "y", 2), (None, 5, "z", 1)], schema), 0,
              order="seq")
    kv.upsert(elements(spark, [("a", 10, "w", 1), ("b", 1, "b", 1)], schema), 1)
    assert rows(kv.read()) == [("a", 13, "w"), ("b", 1, "b"), (None, 5, "z")]
    assert rows(kv.read(before=1)) == [("a", 3, "y"), (None, 5, "z")]
    kv.upsert(elements(spark, [("a", 20, "v", 1)], schema), 1)          # runs again
    assert rows(table().read()) == [("a", 23, "v"), (None, 5, "z")]
    kv.compact(1)
    kv.delete(elements(spark, ["a"], "k STRING"), 2)
    assert rows(kv.read()) == [(None, 5, "z")]
    kv.upsert(elements(spark, [("a", 7, "back", 1)], schema), 3)
    kv.compact(3)
    assert rows(table().read()) == [("a", 7, "back"), (None, 5, "z")]
    got = kv.get(elements(spark, ["a", "q"], "k STRING"), ["n"], {"n": 0})
    assert rows(got) == [("a", 7), ("q", 0)]


class FileTarget:
    def __init__(self, path):
        self.file = open(path, "a")

    def write(self, row):
        self.file.write(f"{row.value}\n")

    def close(self):
        self.file.close()


def test_row_writers(spark, tmp_path, folder):
    source = folder("in")
    sequence(spark, 1, 20, 2).write.parquet(source)
    base = str(tmp_path)
    writer = RowWriter(lambda part, epoch: FileTarget(f"{base}/stream-{part}-{epoch}.txt"))
    stream = spark.readStream.schema("value BIGINT").parquet(source)
    (stream.writeStream.foreach(writer).option("checkpointLocation", folder("c"))
     .trigger(availableNow=True).start().awaitTermination())
    written = [int(x) for p in tmp_path.glob("stream-*.txt") for x in p.read_text().split()]
    assert sorted(written) == list(range(1, 21))
    for_each_task(sequence(spark, 1, 5, 1), lambda: FileTarget(f"{base}/batch.txt"))
    assert (tmp_path / "batch.txt").read_text().split() == ["1", "2", "3", "4", "5"]


def test_stream_into_table(spark, folder):
    source, where = folder("in"), folder("table")
    sequence(spark, 1, 20, 2).write.parquet(source)
    spark.sql(f"CREATE TABLE numbers_sink (value BIGINT) USING parquet LOCATION '{where}'")
    stream = spark.readStream.schema("value BIGINT").parquet(source)
    query = stream_into(stream, "numbers_sink", folder("c"))
    query.processAllAvailable()
    query.stop()
    assert spark.table("numbers_sink").count() == 20


def test_jdbc_options(spark):
    table = JdbcTable("jdbc:x://h/db", "t_student", user="u", password="p",
                      options={"fetchsize": 100})
    assert table.connection() == {"url": "jdbc:x://h/db", "dbtable": "t_student", "user": "u",
                                  "password": "p", "fetchsize": "100"}
    cut = table.parallel("id", 0, 1000, 8)
    assert (cut["partitionColumn"], cut["lowerBound"], cut["upperBound"], cut["numPartitions"]) == (
        "id", "0", "1000", "8")
    assert jdbc_sink.write_options(table, 500, 4)["batchsize"] == "500"
    assert callable(jdbc_sink.batch_writer(table))


def test_polling_reads_again(spark, folder):
    seen, current = [], [1]

    def read():
        current[0] += 1
        return elements(spark, [current[0]], "v INT")

    query = polled(spark, read, lambda df, batch_id: seen.append(df.first().v), folder("c"),
                   every="1 second")
    try:
        for _ in range(40):
            time.sleep(0.5)
            if len(seen) >= 2:
                break
    finally:
        query.stop()
    assert seen[:2] == [2, 3]


def test_kafka_options(spark):
    assert kafka.source_options("h:9092", "t", start="earliest", group="g", max_per_batch=5) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "groupIdPrefix": "g", "maxOffsetsPerTrigger": "5"}
    assert kafka_sink.sink_options("h:9092", "t", 5000)["kafka.transaction.timeout.ms"] == "5000"
    df = elements(spark, [(1, "a")], "id INT, name STRING")
    assert rows(kafka_sink.as_records(df)) == [('{"id":1,"name":"a"}',)]
    assert rows(kafka_sink.as_records(df, key="id", text="name")) == [("1", "a")]


def test_catalog(spark):
    before = spark.catalog.currentDatabase()
    catalog.use(spark, "spark_catalog", "side_db")
    assert spark.catalog.currentDatabase() == "side_db"
    catalog.use(spark, database=before)
    spark.sql("DROP DATABASE side_db")


def test_kafka_start_needs_offsets_for_a_group():
    from sparkloom.sources.kafka import source_options
    with pytest.raises(ValueError):
        source_options("b:1", "t", start="group-offsets", group="g")
    options = source_options("b:1", "t", start={"t": {0: 7}}, group="g")
    assert options["startingOffsets"] == '{"t": {"0": 7}}'


def test_service_lookup_with_missing_and_whole_number_keys(spark):
    from sparkloom.operators.lookups import service_lookup
    df = spark.createDataFrame([(1,), (None,), (2,), (1,)], "k INT")
    got = service_lookup(df, "k", "name", lambda: lambda k: f"{type(k).__name__}{k}" if k == 1 else None)
    assert rows(got) == sorted([(1, "int1"), (None, None), (2, None), (1, "int1")], key=repr)


def test_lookup_join_refuses_a_repeated_key(spark):
    from sparkloom.operators.joins import lookup_join
    facts = spark.createDataFrame([(1,), (None,), (3,)], "k INT")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    assert rows(lookup_join(facts, dim, {"k": "id"}, ["v"])) == sorted([(1, "a"), (None, None), (3, None)], key=repr)
    with pytest.raises(Exception, match="more than one dimension row"):
        lookup_join(facts, dim.union(dim), {"k": "id"}, ["v"]).collect()
