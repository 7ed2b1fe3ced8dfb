from __future__ import annotations

import pytest

from emberwave.streaming import arrivals, notices


def test_best_by_minute(spark, tmp_path):
    rows = [(1, 20.0, 8.0, 1.0, 10, 1, "2020-01-01 00:00:10"), (1, 20.0, 9.0, 2.0, 11, 1, "2020-01-01 00:00:50"), (1, 5.0, 99.0, 3.0, 12, 1, "2020-01-01 00:00:20"), (2, 20.0, 7.5, 1.0, 10, 1, "2020-01-01 01:00:00")]
    frame = spark.createDataFrame(rows, "beam long, dm double, sn double, time double, sample long, filter_width long, arrived string").withColumn("arrived", arrivals.F.to_timestamp("arrived"))
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    best = arrivals.best_by_minute(arrivals.read_arrivals(spark, str(tmp_path / "in")))
    query = best.writeStream.format("memory").queryName("best").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {(r.beam, r.sn, r.n) for r in spark.table("best").collect()} == {(1, 9.0, 2), (2, 7.5, 1)}


def test_replayed_batches_send_nothing_twice(spark, tmp_path):
    frame = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "value string")
    frame.repartition(2).write.text(str(tmp_path / "in"))
    ledger, got = f"file://{tmp_path}/ledger", []
    stream = lambda: spark.readStream.text(str(tmp_path / "in")).where("value <> ''")
    notices.start(stream(), got.append, ledger, f"{tmp_path}/c1").awaitTermination(120)
    assert sorted(got) == ["a", "a", "b"]
    # The same checkpoint has nothing new; a lost one replays batch 0, which the ledger knows.
    notices.start(stream(), got.append, ledger, f"{tmp_path}/c1").awaitTermination(120)
    notices.start(stream(), got.append, ledger, f"{tmp_path}/c2").awaitTermination(120)
    assert sorted(got) == ["a", "a", "b"]
    # A sender that dies half way has claimed its batch.
    def dying(value):
        got.append(value)
        raise RuntimeError("gone")

    with pytest.raises(RuntimeError, match="gone"):
        notices.send_once(frame, 7, dying, ledger)
    assert notices.send_once(frame, 7, got.append, ledger) == 0 and got[3:] == ["a"]
    assert {(r.batch, r.place, r.value) for r in notices.sent(spark, ledger).where("batch = 7").collect()} == {(7, 0, "a"), (7, 1, "a"), (7, 2, "b")}
    assert notices.send_once(frame.limit(0), 8, got.append, ledger) == 0
