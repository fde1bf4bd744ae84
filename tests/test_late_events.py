"""Late and repeated events of a stream that is stopped and started again."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docflow.session import scratch_path
from docflow.streaming import streams as S

SCHEMA = "id long, ts timestamp_ntz, epoch int"
T0 = datetime(2024, 3, 30, 12)


def at(hours):
    return T0 + timedelta(hours=hours)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_late_and_repeated_events_over_three_runs(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        src, out, ckpt = (scratch_path(spark, n) for n in ("ev-src", "ev-out", "ev-ckpt"))
        deliveries = [
            [(1, at(0)), (2, at(40)), (2, at(40)), (3, at(48)), (None, at(47)), (9, None)],  # latest 48, so 24 is late from here on
            [(4, at(24)), (5, at(25)), (2, at(40)), (1, at(0)), (6, at(3)), (6, at(3)), (7, at(80))],
            [(8, at(56)), (10, at(57)), (7, at(80)), (5, at(25)), (None, at(47))],
        ]
        passed = [{1, 2, 3}, {1, 2, 3, 5, 7}, {1, 2, 3, 5, 7, 10}]
        missed = [[9], [4, 6, 9], [4, 6, 8, 9]]
        for n, rows in enumerate(deliveries):
            spark.createDataFrame([(i, t, n) for i, t in rows], SCHEMA).write.mode("append").parquet(src)
            on_time = S.on_time_events(S.file_stream(spark, src, SCHEMA), "id", "ts", "24 hours", out, ckpt)
            got = [r.id for r in on_time.collect()]
            first = {i: min(k for k, d in enumerate(deliveries) if i in dict(d)) for i in got}
            assert {r.id: r.epoch for r in on_time.collect()} == first  # a column of the events, whatever its name
            assert sorted(got) == sorted(passed[n])
            late = S.late_events(spark.read.schema(SCHEMA).parquet(src), on_time, "id")
            assert sorted(r.id for r in late.where("id is not null").collect()) == missed[n]
            assert late.where("id is null").count() == (2 if n == 2 else 1)
            assert dict(on_time.dtypes) == dict(late.dtypes) == {"id": "bigint", "ts": "timestamp_ntz", "epoch": "int"}
        # started again without new files: nothing is lost or repeated
        again = S.on_time_events(S.file_stream(spark, src, SCHEMA), "id", "ts", "24 hours", out, ckpt)
        assert sorted(r.id for r in again.collect()) == sorted(passed[-1])
        assert again.where(F.col("ts").isNull()).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_no_events(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("ev-src", "ev-out", "ev-ckpt"))
    spark.createDataFrame([], SCHEMA).write.parquet(src)
    on_time = S.on_time_events(S.file_stream(spark, src, SCHEMA), "id", "ts", "24 hours", out, ckpt)
    assert on_time.isEmpty() and S.late_events(spark.read.schema(SCHEMA).parquet(src), on_time, "id").isEmpty()
