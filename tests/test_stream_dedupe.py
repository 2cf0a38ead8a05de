"""Late and repeated events over restarts."""

from __future__ import annotations

from souk.sources import io as IO
from souk.streaming import events as EV


def _events(spark, rows):
    return spark.createDataFrame([("view", u, "1", "2", (t or "")[:10], t) for u, t in rows], EV.RAW_EVENT_SCHEMA)


def test_dedupe_goes_on_after_a_restart(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    runs = [
        [("a", "2024-05-01 10:00:00"), ("a", "2024-05-01 10:00:00"), ("b", "2024-05-01 11:30:00"), ("x", "no time"), ("y", None)],
        [("b", "2024-05-01 11:30:00"), ("c", "2024-05-01 11:10:00"), ("d", "2024-05-01 15:00:00")],  # a repeat, one in time though late
        [("e", "2024-05-01 10:05:00"), ("d", "2024-05-01 15:00:00"), ("f", "2024-05-01 14:30:00")],  # too late, a repeat, in time
        [("g", "2024-05-01 12:00:00"), ("f", "2024-05-01 14:30:00")],
    ]
    for k, rows in enumerate(runs):
        _events(spark, rows).write.parquet(f"{src}/{k}")
        EV.stream_dedupe(spark, src, out, ck)
    got = sorted((r.user_id, r.event_timestamp[11:16]) for r in spark.read.parquet(out).collect())
    assert got == [("a", "10:00"), ("b", "11:30"), ("c", "11:10"), ("d", "15:00"), ("f", "14:30")]


def test_newest_file_is_found_without_reading(spark, tmp_path):
    import os

    for k, (name, body) in enumerate([("a_1.csv", "x\n1\n"), ("b_1.csv", "x\n2\n"), ("a_2.csv", "x,y\n3,4\n"), ("c.csv", "z\n5\n")]):
        (tmp_path / name).write_text(body)
        os.utime(tmp_path / name, (1_700_000_000 + k, 1_700_000_000 + k))
    folder = str(tmp_path)
    assert IO.newest_file(spark, folder, "a").endswith("/a_2.csv")
    assert [tuple(r) for r in IO.latest_file_scan(spark, folder, "a").collect()] == [("3", "4")]
    assert IO.newest_file(spark, folder, "q") is None and IO.latest_file_scan(spark, folder, "q").count() == 0
    plan = spark.read.format("binaryFile").load(folder).select("path", "modificationTime")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
