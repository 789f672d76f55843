"""Tickets by day over a stream: the cap holds, rows wait, and nothing is spent twice."""

import shutil
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from agorascope import registry
from agorascope.streaming import admission

ASKS = "row_key string, created_utc long, asked_at timestamp"


def asked(spark, folder, name, rows):
    spark.createDataFrame([(k, t, datetime.fromisoformat(at)) for k, t, at in rows], ASKS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(ASKS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def taken(spark, path):
    return sorted((str(r.day), r.ticket, r.row_key) for r in spark.read.parquet(path).select("day", "ticket", "row_key").collect())


def test_lane_shares_are_the_cap():
    assert all(sum(admission.lane_share(cap, lanes, i) for i in range(lanes)) == cap for cap in (1, 7, 64, 20000) for lanes in (1, 3, 64))


def test_tickets_days_and_a_replayed_batch(spark, tmp_path):
    given, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    run = lambda: admission.write_batches(admission.admitted(stream(spark, given), lambda lane: 2, F.lit("a")), out, check)
    asked(spark, given, "1", [("k5", 5, "2024-01-01T08:00"), ("k1", 1, "2024-01-01T08:00"), ("k3", 3, "2024-01-01T08:00"), ("k4", 4, "2024-01-01T08:00")])
    run()
    assert taken(spark, out) == [("2024-01-01", 1, "k1"), ("2024-01-01", 2, "k3")]
    asked(spark, given, "2", [("k0", 0, "2024-01-01T09:00"), ("k5", 5, "2024-01-01T09:00")])  # no ticket is left; k5 waits already
    run()
    assert len(taken(spark, out)) == 2
    shutil.copytree(check, tmp_path / "before")
    asked(spark, given, "3", [("k9", 9, "2024-01-02T00:10")])  # a new day: what waits goes first
    run()
    assert taken(spark, out)[2:] == [("2024-01-02", 1, "k0"), ("2024-01-02", 2, "k4")]
    asked(spark, given, "4", [("k10", 10, "2024-01-03T07:00"), ("k11", 11, "2024-01-04T07:00")])
    run()
    found = taken(spark, out)
    assert {k for _, _, k in found} == {"k0", "k1", "k3", "k4", "k5", "k9", "k10", "k11"} and len(found) == 8
    assert max(Counter(d for d, _, _ in found).values()) == 2 and len({(d, n) for d, n, _ in found}) == 8
    # the checkpoint of two batches before: the batches after it are run again, with the same numbers
    shutil.rmtree(check)
    shutil.copytree(tmp_path / "before", check)
    run()
    assert taken(spark, out) == found
    assert {str(r.day): r.n for r in admission.spent_by_day(spark, out).collect()} == Counter(d for d, _, _ in found)


def test_a_timer_wakes_what_waits(spark, tmp_path):
    """Another lane's requests move the time past midnight."""
    given, out = str(tmp_path / "in"), str(tmp_path / "out")
    lane = F.substring("row_key", 1, 1)
    asked(spark, given, "1", [("a1", 1, "2024-01-01T08:00"), ("a2", 2, "2024-01-01T08:00")])
    asked(spark, given, "2", [("b1", 1, "2024-01-02T08:00")])
    admission.write_batches(admission.admitted(stream(spark, given), lambda lane: 1, lane), out, str(tmp_path / "check"))
    assert taken(spark, out) == [("2024-01-01", 1, "a1"), ("2024-01-02", 1, "a2"), ("2024-01-02", 1, "b1")]


def test_one_cap_over_lanes(spark, tmp_path):
    given, out = str(tmp_path / "in"), str(tmp_path / "out")
    asked(spark, given, "1", [(f"k{i}", i, "2024-01-01T08:00") for i in range(500)])
    admission.write_batches(admission.capped(stream(spark, given), 40, 8), out, str(tmp_path / "check"))
    assert [r.n for r in admission.spent_by_day(spark, out).collect()] == [40]


def test_a_tally_counts_a_batch_once(spark, tmp_path):
    rows = spark.createDataFrame([("stickied", "2024-01-01"), ("stickied", "2024-01-01"), (None, "2024-01-01")], "reason string, at string")
    for batch in (0, 0, 1):
        found = admission.tally(spark, rows, str(tmp_path), batch, F.to_date("at"))
    assert [(str(r.day), r.reason, r.n) for r in found.collect()] == [("2024-01-01", "stickied", 4)]


def test_requests_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(admission, "write_batches", lambda *_: None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        registry._admitted_stream(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "in").glob("part-*"))) > 1
