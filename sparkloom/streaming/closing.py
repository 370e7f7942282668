"""Replays in two turns: rows that come after all others, and a last row that closes every window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkloom.session import shared_dir
from sparkloom.streaming.runtime import to_files

END = "9999-01-01 00:00:00"     # behind all rows, and behind all windows that hold one


def in_turns(spark: SparkSession, rows: DataFrame, later: DataFrame,
             run: Callable[[DataFrame], DataFrame], root: str) -> DataFrame:
    """Run a stream to its end, then go on with the rows of ``later``, from the same checkpoint.

    ``later`` is a second input that stays empty until the first run is over, however many
    micro-batches that took. ``run`` builds and runs the query over both, and returns its result.
    """
    later.where("false").write.parquet(f"{root}/later")

    def both() -> DataFrame:
        return rows.unionByName(spark.readStream.schema(rows.schema).parquet(f"{root}/later"))

    run(both())
    later.write.mode("append").parquet(f"{root}/later")
    return run(both())


def closed(spark: SparkSession, rows: DataFrame, time: str,
           plan: Callable[[DataFrame], DataFrame], bound: str, label: str) -> DataFrame:
    """Run ``plan`` in append mode over a stream and then over one row at the end of time.

    ``plan`` takes the watermarked stream; its windows and event-time timers all close, and the last
    row itself, null but for its time, is never part of a result. A filter in ``plan`` that does not
    name the time moves in front of the watermark: it must let nulls pass, or stand in ``rows``.
    ``time`` is TIMESTAMP. Returns the emitted rows as a table.
    """
    root = shared_dir(spark, label)
    last = spark.range(1).select(*[
        (F.lit(END) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in rows.schema.fields])

    def run(both: DataFrame) -> DataFrame:
        # The filter names the time, so it stays behind the watermark and the last row moves it.
        out = plan(both.withWatermark(time, bound).where(F.col(time) < F.lit(END)))
        to_files(out, f"{root}/out", f"{root}/checkpoint").awaitTermination()
        return out

    out = in_turns(spark, rows, last, run, root)
    return spark.read.schema(out.schema).parquet(f"{root}/out")
